"""Mixing sources to target shares of the tokens.

A classifier trained on a bounded sample of labelled rows (multinomial naive
Bayes over token counts, smoothed towards the tokens of all) gives each document
posteriors over the domains, the listed sources. Its prior is the target shares
and its sharpness is the one that predicts held-out rows best, so in a collection
whose labels have the target shares the expected domain totals have them too,
as far as the posteriors are right.

Documents of one source with the same two likeliest domains, in ninths, form a
cell, of which there are at most ``9 D^3``; they share their rate of use. A
distributed pass sums, per cell, the tokens and the tokens expected of each
domain by the full posteriors. Projected-gradient least squares then fits
nonnegative rates, at most the source's ``max_repeats``, whose expected domain
totals come nearest to the targets, among those whose totals by label are the
targets: each step is projected onto these. The gradient of a cell is the sum of
its documents', so the steps on the cells' sums are those of distributed steps
with rates tied within cells, without a pass over the documents for each.

Rates become whole copies by a hash of each document's key: per source,
documents below a threshold of it get one copy more. The threshold comes from a
histogram, the greatest that stays within the tokens wanted; further passes fill
what is left with documents that fit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.tokens import encoding
from glossmill.session import materialize

#: Labelled rows per source that the classifier is fitted on, about (a hash of the key decides).
SAMPLE_PER_SOURCE = 1_000
LEVELS = 9
#: Sources at most; cells, weights and thresholds have sizes that follow from it.
MAX_DOMAINS = 64
BINS = 4_096
#: Weight that keeps the rates of one source near each other.
EVEN_WEIGHT = 1e-3
#: Passes that close what is left between the tokens reached and wanted, each with the documents that still fit.
PASSES = 5
#: Tokens of the whole that each domain is taken to have beside its own.
SMOOTHING = 300.0
#: Sharpness of the posteriors, a scale of the mean log likelihood per token, of which the best on held-out rows is taken.
SHARPNESS = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 1.0, 1.5, 2.0, 3.0, 5.0, 8.0, 12.0, 20.0, 40.0)
#: Tokens whose likelihoods are looked up at once.
CHUNK = 100_000


@dataclass
class Targets:
    sources: list[str]
    shares: np.ndarray
    caps: np.ndarray

    @staticmethod
    def of(rows) -> Targets:
        rows = list(rows)
        if len(rows) > MAX_DOMAINS:
            raise ValueError(f"more than {MAX_DOMAINS} sources")
        rows = sorted((r for r in rows if r[0] is not None and (r[1] or 0) > 0 and (r[2] or 0) > 0), key=lambda r: r[0])
        return Targets([r[0] for r in rows], np.array([float(r[1]) for r in rows]), np.array([int(r[2]) for r in rows], float))


@dataclass
class Classifier:
    """Log likelihoods of the tokens by domain, log prior and sharpness."""

    weights: np.ndarray
    prior: np.ndarray
    sharpness: float

    def posteriors(self, ids: list[np.ndarray]) -> np.ndarray:
        return softmax(self.prior + self.sharpness * mean_likelihoods(ids, self.weights))


def mean_likelihoods(ids: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The mean log likelihood of each document's tokens in each domain; 0 without tokens."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    out = np.zeros((len(ids), weights.shape[1]))
    at = np.flatnonzero(sizes)
    for part in np.split(at, np.flatnonzero(np.diff(np.cumsum(sizes[at]) // CHUNK)) + 1) if len(at) else ():
        flat = np.concatenate([ids[i] for i in part])
        out[part] = np.add.reduceat(weights[flat], np.cumsum(sizes[part]) - sizes[part], axis=0, dtype=np.float64) / sizes[part][:, None]
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def likelihoods(counts: np.ndarray) -> np.ndarray:
    """``(token, domain)`` log likelihoods from ``(domain, token)`` counts."""
    whole = counts.sum(axis=0) + 0.05
    smoothed = counts + SMOOTHING * whole / whole.sum()
    return np.log(smoothed / smoothed.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()


def fit_classifier(docs: DataFrame, targets: Targets, path: str, per_source: int = SAMPLE_PER_SOURCE) -> Classifier:
    """A classifier of ``docs (key, source, text)`` into the listed sources, from a sample of about ``per_source`` rows of each.

    Likelihoods of one half of the sample are tried on the other with each
    sharpness; the least log loss, by tokens in the target shares, decides. The
    final ones are of the whole sample. The prior is the target shares of the
    sources that have documents.
    """
    index = {s: i for i, s in enumerate(targets.sources)}
    d, vocab = len(index), encoding(path).n_vocab
    counts = {r[0]: r[1] for r in docs.groupBy("source").count().collect()}
    rate = F.element_at(F.create_map(*[F.lit(x) for s in targets.sources for x in (s, min(1.0, per_source / max(1, counts.get(s, 0))))]), F.col("source"))
    h = F.xxhash64(F.lit(7), "key")
    sample = docs.where(F.pmod(h, F.lit(1_000_000)) / 1_000_000.0 < rate).select(F.pmod(F.shiftright(h, 40), F.lit(2)).cast("int").alias("half"), "source", "text")

    def tokenize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoding(path)
        for batch in batches:
            code = pa.array([index[s] for s in batch.column(1).to_pylist()], pa.int32())
            ids = pa.array([e.encode_ordinary(t) for t in batch.column(2).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), code, ids], names=["half", "domain", "ids"])

    held = materialize(sample.mapInArrow(tokenize, "half int, domain int, ids array<int>"), "sample")

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0).to_numpy().astype(np.int64) * d + batch.column(1).to_numpy()
            sizes = batch.column(2).value_lengths().to_numpy()
            cell, n = np.unique(np.repeat(row, sizes) * vocab + batch.column(2).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], names=["cell", "n"])

    got = held.mapInArrow(counted, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(2 * d * vocab)
    table[got["cell"].to_numpy()] = got["n"].to_numpy()
    table = table.reshape(2, d, vocab)
    live = np.array([counts.get(s, 0) > 0 for s in targets.sources])
    want = np.where(live, targets.shares, 0)
    prior = np.log(np.maximum(want / max(want.sum(), 1e-300), 1e-12))
    tried = held.sparkSession.sparkContext.broadcast(likelihoods(table[0]))
    weight = want / np.maximum(table[1].sum(axis=1), 1)

    def losses(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.array(x, np.int64) for x in batch.column(1).to_pylist()]
            domain = batch.column(0).to_numpy()
            by = weight[domain] * np.fromiter(map(len, ids), np.int64, len(ids))
            mean = mean_likelihoods(ids, tried.value)
            out = [float(-(by * np.log(np.maximum(softmax(prior + s * mean)[np.arange(len(ids)), domain], 1e-12))).sum()) for s in SHARPNESS]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(SHARPNESS)), pa.int32()), pa.array(out)], names=["i", "loss"])

    found = {r[0]: r[1] for r in held.where("half = 1").select("domain", "ids").mapInArrow(losses, "i int, loss double").groupBy("i").agg(F.round(F.sum("loss"), 9)).collect()}
    best = min(found, key=lambda i: (found[i], i)) if found else SHARPNESS.index(1.0)
    return Classifier(likelihoods(table.sum(axis=0)), prior, SHARPNESS[best])


def cells_of(source: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The cell of each document: its source, its two likeliest domains and the share of the first in both, in ninths."""
    d = p.shape[1]
    if d == 1:
        return np.zeros(len(p), np.int64)
    order = np.argsort(-p, axis=1, kind="stable")[:, :2]
    first, second = order.T
    top = np.take_along_axis(p, order, axis=1)
    level = np.rint(top[:, 0] / top.sum(axis=1) * (LEVELS - 1)).astype(np.int64)
    return ((source * d + first) * d + second) * LEVELS + level


def source_of(cells: np.ndarray, d: int) -> np.ndarray:
    return cells // (LEVELS * d * d) if d > 1 else np.zeros(len(cells), np.int64)


def onto_labels(rates: np.ndarray, source: np.ndarray, tokens: np.ndarray, top: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """The nearest rates, by tokens, between 0 and ``top`` whose tokens by source are ``goal``: all of a source moved alike and clipped."""
    reach = float(np.abs(rates).max(initial=0) + top.max(initial=0)) + 1
    lo, hi = np.full(len(goal), -reach), np.full(len(goal), reach)
    for _ in range(48):
        mid = (lo + hi) / 2
        short = np.bincount(source, np.clip(rates + mid[source], 0, top) * tokens, len(goal)) < goal
        lo, hi = np.where(short, mid, lo), np.where(short, hi, mid)
    return np.clip(rates + hi[source], 0, top)


def fit_rates(source: np.ndarray, expected: np.ndarray, tokens: np.ndarray, shares: np.ndarray, caps: np.ndarray, total: float | None = None, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The rate of each cell, and the tokens wanted of each source.

    ``expected (cell, domain)`` are the tokens by posterior, whose rows sum to
    ``tokens``. Without ``total`` it is the greatest at which every source that has
    documents reaches its share within its cap; a greater one stays as asked for,
    and sources that cannot reach it give all they have. The shares of sources
    without documents are spread over the others.
    """
    d = len(shares)
    have = np.bincount(source, tokens, d)
    live = have > 0
    if not live.any():
        return np.zeros(len(tokens)), np.zeros(d)
    want = np.where(live, shares, 0)
    want = want / want.sum()
    if total is None:
        total = float(np.min((caps * have)[live & (want > 0)] / want[live & (want > 0)]))
    goal = want * total
    reach = np.minimum(goal, caps * have)
    top = caps[source]
    even = (reach / np.maximum(have, 1))[source]
    m = expected / np.maximum(tokens, 1e-300)[:, None]  # the posterior of a token of each cell
    weight = np.linalg.eigvalsh(expected.T @ m / total)[-1] + EVEN_WEIGHT
    r = ahead = even
    momentum = 1.0
    for _ in range(steps):
        gradient = m @ ((ahead @ expected - goal) / total) + EVEN_WEIGHT * (ahead - even)
        new = onto_labels(ahead - gradient / weight, source, tokens, top, reach)
        next_momentum = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / next_momentum * (new - r)
        moved = np.abs(new - r).max()
        r, momentum = new, next_momentum
        if moved < 1e-6:
            break
    return r, goal


def mix_sources(docs: DataFrame, key: str, source: str, text: str, targets: Targets, path: str, total: float | None = None, per_source: int = SAMPLE_PER_SOURCE) -> DataFrame:
    """``(<key>, <source>, n_tokens, copies, expected, wanted, posterior)``: the documents used, each with its number of copies (1 to its source's cap).

    Documents of null or unlisted sources and without tokens take no part; of a
    listed source without documents the share is spread over the others. Rows
    with the same key are documents of their own that get the same copies.
    ``expected`` is the fitted rate, ``wanted`` the tokens wanted of the source,
    ``posterior`` the domains' in the order of ``targets``. ``total`` is the size of
    the whole in tokens, see ``fit_rates``. With no documents or no targets there
    are no rows.
    """
    spark = docs.sparkSession
    kept = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("text"))
    kept = kept.where(F.col("source").isin(targets.sources) & F.col("text").isNotNull())
    classifier = spark.sparkContext.broadcast(fit_classifier(kept, targets, path, per_source) if targets.sources else None)
    index = {s: i for i, s in enumerate(targets.sources)}
    d = max(1, len(index))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoding(path)
        for batch in batches:
            ids = [np.array(e.encode_ordinary(t), np.int64) for t in batch.column(2).to_pylist()]
            p = classifier.value.posteriors(ids)
            cells = cells_of(np.array([index[s] for s in batch.column(1).to_pylist()], np.int64), p)
            sizes = np.fromiter(map(len, ids), np.int32, len(ids))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, d, dtype=np.int32)), pa.array(p.ravel().astype(np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes), pa.array(cells.astype(np.int32)), flat], names=["key", "source", "n_tokens", "cell", "posterior"])

    kind = kept.schema["key"].dataType.simpleString()
    features = materialize(kept.mapInArrow(run, f"key {kind}, source string, n_tokens int, cell int, posterior array<float>").where("n_tokens > 0"), "features")
    expected = [F.sum(F.col("n_tokens") * F.get("posterior", F.lit(i)).cast("double")).alias(f"d{i}") for i in range(d)]
    got = features.groupBy("cell").agg(F.sum("n_tokens").alias("n"), *expected).orderBy("cell").toArrow()
    cells, sums = got["cell"].to_numpy().astype(np.int64), got["n"].to_numpy().astype(float)
    by_domain = np.stack([got[f"d{i}"].to_numpy() for i in range(d)], 1).astype(float) if len(cells) else np.zeros((0, d))
    by_domain *= (sums / np.maximum(by_domain.sum(axis=1), 1e-300))[:, None]  # single precision
    of = source_of(cells, d)
    rates, goal = fit_rates(of, by_domain, sums, targets.shares, targets.caps, total) if len(cells) else (np.zeros(0), np.zeros(d))

    fitted = spark.createDataFrame(list(zip(cells.tolist(), rates.tolist(), of.tolist())), "cell int, expected double, source_no int")
    u = F.pmod(F.xxhash64(F.lit(11), "key"), F.lit(1 << 40)) / float(1 << 40)
    part = F.col("expected") - F.floor("expected")
    rated = features.join(F.broadcast(fitted), "cell").withColumns({"whole": F.floor("expected").cast("int"), "bin": F.when(part > 1e-9, F.least(F.floor(u / (u + part) * BINS), F.lit(BINS - 1)).cast("int")).otherwise(BINS)})
    more = F.lit(False)
    left = np.minimum(goal, targets.caps * np.bincount(of, sums, len(goal))) if len(cells) else goal.copy()
    for step in range(PASSES if len(cells) else 0):
        free = rated.where((F.col("bin") < BINS) & ~more)
        if step:
            fits = F.element_at(F.array(*[F.lit(float(x)) for x in left]), F.col("source_no") + 1)
            free = free.where(F.col("n_tokens") <= fits)
        else:
            left -= np.bincount(of, np.floor(rates) * sums, len(goal))
            fits = F.lit(float("inf"))
        below = _thresholds(free.groupBy("source_no", "bin").agg(F.sum("n_tokens")).collect(), left)
        more = more | ((F.col("n_tokens") <= fits) & (F.col("bin") < F.element_at(F.array(*[F.lit(int(x)) for x in below]), F.col("source_no") + 1)))
    copies = F.col("whole") + F.when(more, 1).otherwise(0)
    out = rated.withColumn("copies", copies.cast("int")).where("copies > 0")
    wanted = F.element_at(F.array(*[F.lit(float(x)) for x in goal] or [F.lit(0.0)]), F.col("source_no") + 1)
    return out.select(F.col("key").alias(key), F.col("source").alias(source), "n_tokens", "copies", F.round("expected", 6).alias("expected"), F.round(wanted, 3).alias("wanted"), "posterior")


def _thresholds(sums, left: np.ndarray) -> np.ndarray:
    """Per source the greatest bin below which the documents' tokens stay within ``left``, which is lessened by them."""
    tokens = np.zeros((len(left), BINS))
    for r in sums:
        tokens[r[0], r[1]] += r[2]
    reached = np.cumsum(tokens, axis=1)
    below = (reached <= np.maximum(left, 0)[:, None]).sum(axis=1)
    left -= np.where(below > 0, reached[np.arange(len(left)), below - 1], 0)
    return below


def share_report(mixed: DataFrame, source: str, targets: DataFrame) -> DataFrame:
    """Per listed source: documents, copies, tokens wanted and reached, the share reached by label and the share expected by posterior, beside the target.

    ``shortfall`` is what the source lacks of the tokens wanted of it.
    """
    used = F.col("n_tokens").cast("bigint") * F.col("copies")
    per = mixed.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(used).alias("tokens"), F.max("wanted").alias("wanted"))
    order = Targets.of(targets.select("source", "target_share", "max_repeats").collect()).sources
    sums = mixed.agg(F.sum(used).alias("n"), *[F.sum(used * F.get("posterior", F.lit(i)).cast("double")).alias(f"d{i}") for i in range(len(order))]).first()
    total = sums["n"] or 1
    domain = F.element_at(F.create_map(*[F.lit(x) for i, s in enumerate(order) for x in (s, float(sums[f"d{i}"] or 0) / total)]), F.col("source")) if order else F.lit(None).cast("double")
    joined = targets.select("source", "target_share", "max_repeats").join(per, "source", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("documents", "copies", "most_copies", "tokens", "wanted")}
    return joined.withColumns(zero).withColumns({"actual_share": F.round(F.col("tokens") / float(total), 6), "domain_share": F.round(domain, 6), "shortfall": F.greatest(F.col("wanted") - F.col("tokens"), F.lit(0.0))})
