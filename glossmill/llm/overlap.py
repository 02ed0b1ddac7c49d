"""Same or nearly the same records in two parts of a collection.

Records are first reduced to their distinct texts. Each text is a sequence of
units (words or characters); rolling hashes of ``k`` consecutive units are its
fingerprints, and the ``2k + 1`` minima under the order (how often train holds the
fingerprint, in powers of two; hash) are selected and joined across the parts.
One edit changes at most ``k`` fingerprints, so two texts of at most two edits
share one of these minima: the selection misses nothing, whatever the counts
say, and it avoids the fingerprints of common phrases. ``k`` is ``k_max`` for texts
of ``3 k_max`` units and falls to 1 for short ones; texts on either side of a step
carry both. Two texts of at most two units always lie within two edits and meet
under one constant key, which is dealt into parts like any frequent fingerprint.

The counts are exact sums over all train texts; only those of frequent
fingerprints are gathered, as a table whose size follows the data up to a
bound, and whose collisions can only change which minima are taken. A
fingerprint that many train texts hold is split into parts by the text, so
none of its joins is the work of one task.

A joined pair of minima is a seed, with its places in the two texts. Seeds must
lie within two diagonals, and the texts' lengths and parity signatures (one bit
per class of units, flipped by each occurrence) must allow two edits. The seeds
of a pair are chained: the greatest set that is in order in both texts and
within two diagonals. From the chain the alignment is extended over the gaps
and to both ends by furthest-reaching diagonals, which gives the edits and the
covered spans. A pair whose chain leads beyond two edits, or to two where one
might do, is aligned once more from its start, so the edits are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.llm.identity import fingerprint
from glossmill.session import materialize

EDITS = 2
#: Bits of the index into the levels of frequent fingerprints, at least and at most (one byte each), and of the filter of the eval part's fingerprints.
LEVEL_BITS, FILTER_BITS = (16, 24), (20, 26)
#: Fingerprints of a text, in train, that one part of a join holds about.
PART = 1 << 10
#: Longest units kept apart in a row's packed length and positions; beyond, they only filter less.
LONGEST = (1 << 20) - 1
K_MAX = {"word": 3, "char": 6}

_PUNCT = regex.compile(r"\p{P}+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def units(text: str, unit: str) -> list[str]:
    return text.split(" ") if unit == "word" else list(text)


def plain_units(form: str | None, unit: str) -> str | None:
    """The text's units, joined: lower case, no punctuation; None if nothing is left."""
    if form is None:
        return None
    s = _PUNCT.sub("", form.lower())
    return (" ".join(s.split()) if unit == "word" else "".join(s.split())) or None


def units_column(form: Column, unit: str) -> Column:
    @F.arrow_udf(T.StringType())
    def run(a: pa.Array) -> pa.Array:
        return pa.array([plain_units(t, unit) for t in a.to_pylist()], pa.string())

    return run(form)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def unit_codes(texts: list[str], unit: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all units of all texts, and each text's number of units."""
    if unit == "char":
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = mix(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1))
        return flat, sizes
    words = pc.split_pattern(pa.array(texts, pa.string()), " ")
    coded = words.flatten().dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return hashes[coded.indices.to_numpy(zero_copy_only=False)], words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def gram_sizes(n: int, k_max: int) -> set[int]:
    """The fingerprint lengths a text of ``n`` units carries; 0 is the constant key."""
    return {0, 1} if n <= EDITS else {max(1, min(k_max, m // 3)) for m in range(n - EDITS, n + 1)}


def grams(texts: list[str], unit: str, seed: int, every: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(k, row, position, hash)`` of the fingerprints of the texts, by ``k``: of those a text carries, or of ``every`` length up to the greatest."""
    flat, sizes = unit_codes(texts, unit)
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    k_max = K_MAX[unit]
    wanted = {n: set(range(1, k_max + 1)) if every else gram_sizes(int(n), k_max) for n in np.unique(sizes)}
    with np.errstate(over="ignore"):
        for k in sorted(set().union(*wanted.values()) if wanted else ()):
            carries = np.array([k in wanted[n] for n in sizes])
            if k == 0:
                rows = np.flatnonzero(carries)
                yield 0, rows, np.zeros(len(rows), np.int64), np.full(len(rows), mix(np.array([seed], np.uint64))[0])
                continue
            m = len(flat) - k + 1
            if m <= 0:
                continue
            h = np.zeros(m, np.uint64)
            for j in range(k):
                h = h * _BASE + flat[j : j + m]
            own = carries[row[:m]] & (pos[:m] + k <= sizes[row[:m]])
            yield k, row[:m][own], pos[:m][own], mix(h[own] + np.uint64(seed * 64 + k))


def _index(h: np.ndarray, size: int) -> np.ndarray:
    """The place of each hash in a table of ``size`` entries, a power of two."""
    return (h >> np.uint64(65 - size.bit_length())).astype(np.int64)


def select_minima(texts: list[str], unit: str, seed: int, levels: np.ndarray) -> dict[str, np.ndarray]:
    """The minima of each text: ``row, k, hash, lo, hi`` (first and last position of the fingerprint)."""
    parts: dict[str, list[np.ndarray]] = {"row": [], "k": [], "hash": [], "lo": [], "hi": []}
    for k, row, pos, h in grams(texts, unit, seed):
        if not len(row):
            continue
        order = np.lexsort((pos, h, levels[_index(h, len(levels))], row))
        row, pos, h = row[order], pos[order], h[order]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])])
        lo, hi = pos[first], pos[np.r_[first[1:] - 1, len(row) - 1]]
        row, h = row[first], h[first]
        begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        rank = np.arange(len(row)) - np.repeat(begins, np.diff(np.r_[begins, len(row)]))
        keep = rank < max(1, EDITS * k + 1)
        for name, x in (("row", row), ("k", np.full(len(row), k)), ("hash", h), ("lo", lo), ("hi", hi)):
            parts[name].append(x[keep])
    return {name: np.concatenate(x) if x else np.zeros(0, np.int64) for name, x in parts.items()}


def parity(texts: list[str], unit: str) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit signature of each text, of which an edit changes at most two bits; the numbers of units."""
    flat, sizes = unit_codes(texts, unit)
    bits = np.uint64(1) << (mix(flat) & np.uint64(63))
    return np.bitwise_xor.reduceat(bits, np.cumsum(sizes) - sizes) if len(bits) else np.zeros(0, np.uint64), sizes


Block = tuple[int, int, int]


def align(a: Sequence, b: Sequence, limit: int = EDITS) -> tuple[int, list[Block]] | None:
    """The least edits up to ``limit`` by furthest-reaching diagonals, and the equal stretches ``(place in a, place in b, units)``; None beyond."""
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    levels: list[dict[int, tuple[int, int, int]]] = []  # diagonal to: where it begins to agree, where that ends, diagonal before
    for e in range(limit + 1):
        now: dict[int, tuple[int, int, int]] = {}
        for d in range(-e, e + 1):
            if e == 0:
                tries = [(0, 0)]
            else:
                last = levels[-1]
                tries = [(last[x][1] + step, x) for x, step in ((d - 1, 0), (d + 1, 1), (d, 1)) if x in last]
            tries = [(i, x) for i, x in tries if i <= n and 0 <= i + d <= m]
            if not tries:
                continue
            begin, before = max(tries, key=lambda t: t[0])
            i = begin
            while i < n and i + d < m and a[i] == b[i + d]:
                i += 1
            now[d] = (begin, i, before)
        levels.append(now)
        if now.get(m - n, (0, -1, 0))[1] >= n:
            blocks, d = [], m - n
            for reach in reversed(levels):
                begin, end, before = reach[d]
                if end > begin:
                    blocks.append((begin, begin + d, end - begin))
                d = before
            return e, blocks[::-1]
    return None


def distance(a: Sequence, b: Sequence, limit: int = EDITS) -> int | None:
    got = align(a, b, limit)
    return None if got is None else got[0]


def chain_seeds(seeds: Iterable[Block], limit: int = EDITS) -> list[Block]:
    """The seeds ``(place in a, place in b, units)`` that cover most of ``a`` among those in order in both texts and within ``limit`` diagonals, joined where they overlap."""
    order = sorted(set(seeds))
    best: list[tuple[int, int, int, int]] = []  # units covered, least and greatest diagonal, seed before
    for x, (i, j, k) in enumerate(order):
        here = (k, j - i, j - i, -1)
        for y in range(x):
            p, q, r = order[y]
            covered, lo, hi, _ = best[y]
            lo, hi = min(lo, j - i), max(hi, j - i)
            fits = j - i == q - p if p + r > i or q + r > j else True  # overlapping seeds lie on one diagonal
            if p < i and q < j and fits and hi - lo <= limit:
                here = max(here, (covered + min(k, i + k - p - r), lo, hi, y), key=lambda t: t[0])
        best.append(here)
    out: list[Block] = []
    at = max(range(len(best)), key=lambda x: best[x][0], default=-1)
    while at >= 0:
        i, j, k = order[at]
        if out and i + k >= out[-1][0] and out[-1][0] - i == out[-1][1] - j:
            k = out[-1][0] + out[-1][2] - i
            out.pop()
        out.append((i, j, k))
        at = best[at][3]
    return out[::-1]


def extend(a: Sequence, b: Sequence, chain: list[Block], limit: int = EDITS) -> tuple[int, list[Block]] | None:
    """The alignment that goes through the chain: its gaps and both ends aligned within ``limit`` edits in all; None beyond."""
    if not chain:
        return align(a, b, limit)
    i, j, _ = chain[0]
    got = align(a[:i][::-1], b[:j][::-1], limit)
    if got is None:
        return None
    edits, blocks = got[0], [(i - x - n, j - y - n, n) for x, y, n in reversed(got[1])]
    for (i, j, n), (p, q) in zip(chain, [*((p, q) for p, q, _ in chain[1:]), (len(a), len(b))]):
        blocks.append((i, j, n))
        got = align(a[i + n : p], b[j + n : q], limit - edits)
        if got is None:
            return None
        edits += got[0]
        blocks += [(i + n + x, j + n + y, z) for x, y, z in got[1]]
    return edits, blocks


def compare(a: Sequence, b: Sequence, seeds: Iterable[Block], limit: int = EDITS) -> tuple[int, int] | None:
    """``(edits, units of a in equal stretches)`` of two different texts; None beyond ``limit`` edits.

    Of equal numbers of edits the alignment with most equal units counts.
    """
    got = extend(a, b, chain_seeds(seeds, limit), limit)
    if got is None or got[0] > 1:  # the chain may have led astray
        exact = align(a, b, limit if got is None else got[0] - 1)
        got = exact if exact is not None else got
    if got is None:
        return None
    edits, covered = got[0], sum(n for _, _, n in got[1])
    if edits == 2 and len(a) == len(b) and covered == len(a) - 2:
        lo = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
        hi = len(a) - next(i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y)
        covered += a[lo + 1 : hi] == b[lo : hi - 1] or a[lo : hi - 1] == b[lo + 1 : hi]
    return edits, covered


def _parts(corpus: pa.Array, unit_of: dict[str, str]) -> Iterator[tuple[int, str, np.ndarray]]:
    """Of each corpus of a batch a number, its unit and the rows."""
    names = np.array(corpus.to_pylist(), object)
    for seed, (name, unit) in enumerate(sorted(unit_of.items()), 1):
        if len(rows := np.flatnonzero(names == name)):
            yield seed, unit, rows


def _hashes(texts: pa.RecordBatch, unit_of: dict[str, str], every: bool = False) -> Iterator[np.ndarray]:
    for seed, unit, rows in _parts(texts.column(0), unit_of):
        for _, _, _, h in grams(texts.column(1).take(pa.array(rows)).to_pylist(), unit, seed, every):
            yield h


def gram_filter(texts: DataFrame, column: str | None, unit_of: dict[str, str], expected: int) -> np.ndarray:
    """One bit per class of fingerprints, set where ``texts (corpus, text)``, or the table's ``column``, has one; about 16 bits for each of the ``expected`` ones within bounds. A full filter only lets everything pass."""
    bits = 1 << min(max((16 * expected).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits >> 6, np.uint64)
        for batch in batches:
            for h in [batch.column(0).to_numpy().view(np.uint64)] if column else _hashes(batch, unit_of):
                at = _index(h, bits)
                np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(words[at].view(np.int64))], names=["word", "bits"])

    got = texts.select(*([column] if column else ["corpus", "text"])).mapInArrow(run, "word int, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return words


def passes(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    at = _index(h, len(words) << 6)
    return (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def gram_levels(texts: DataFrame, unit_of: dict[str, str], only, every: bool = False) -> np.ndarray:
    """How often ``texts (corpus, text)`` hold each class of fingerprints that pass ``only``, as whole binary logarithms.

    Counts are exact sums over all texts. Those below a least level are taken as
    rare; it is 2 (four texts), or the least at which the frequent ones fill an
    eighth of the largest table. Of fingerprints that share an entry the most frequent
    counts.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h in _hashes(batch, unit_of, every):
                values, n = np.unique(h[passes(h, only.value)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["gram", "n"])

    counted = texts.select("corpus", "text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).where("n >= 4")
    frequent = materialize(counted.select("gram", F.floor(F.log2("n")).cast("tinyint").alias("level")), "levels")
    sizes = sorted(((r[0], r[1]) for r in frequent.groupBy("level").count().collect()), reverse=True)
    room, least, held = 1 << LEVEL_BITS[1] - 3, 2, 0
    for level, n in sizes:
        if held + n > room:
            least = level + 1
            break
        held += n
    size = 1 << min(max((8 * held).bit_length(), LEVEL_BITS[0]), LEVEL_BITS[1])
    entry = F.shiftrightunsigned("gram", 65 - size.bit_length()).alias("entry")
    got = frequent.where(F.col("level") >= least).groupBy(entry).agg(F.max("level").alias("level")).toArrow()
    levels = np.zeros(size, np.uint8)
    levels[got["entry"].to_numpy()] = got["level"].to_numpy()
    return levels


def minima(texts: DataFrame, unit_of: dict[str, str], levels, only=None, most: int = PART) -> DataFrame:
    """``(gram, tid, sig, size, k, lo, hi)``: the selected fingerprints of ``texts (corpus, tid, text)``.

    ``levels`` and ``only`` are broadcasts. Without ``only`` a fingerprint that many
    train texts hold comes once for each of its parts; with it, in the part of
    its text, if it passes.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clip = lambda x: pa.array(np.minimum(x, LONGEST).astype(np.int32))
        for batch in batches:
            for seed, unit, rows in _parts(batch.column(0), unit_of):
                values = batch.column(2).take(pa.array(rows)).to_pylist()
                tids = batch.column(1).to_numpy()[rows]
                s = select_minima(values, unit, seed, levels.value)
                parts = np.maximum(1, (1 << levels.value[_index(s["hash"], len(levels.value))].astype(np.int64)) // most)
                if only is not None:
                    part = (mix(tids[s["row"]].astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
                else:
                    every = np.repeat(np.arange(len(parts)), parts)
                    part = np.arange(len(every)) - np.repeat(np.cumsum(parts) - parts, parts)
                    s = {name: x[every] for name, x in s.items()}
                gram = np.where(part > 0, mix(s["hash"] + part.astype(np.uint64)), s["hash"])
                if only is not None:
                    kept = passes(gram, only.value)
                    s, gram = {name: x[kept] for name, x in s.items()}, gram[kept]
                sig, sizes = parity(values, unit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(tids[s["row"]]), pa.array(sig[s["row"]].view(np.int64)), clip(sizes[s["row"]]), pa.array(s["k"].astype(np.int8)), clip(np.where(s["lo"] >= LONGEST, 0, s["lo"])), clip(s["hi"])],
                    names=["gram", "tid", "sig", "size", "k", "lo", "hi"],
                )

    return texts.select("corpus", "tid", "text").mapInArrow(run, "gram bigint, tid bigint, sig bigint, size int, k tinyint, lo int, hi int")


def occurrences(texts: DataFrame, unit_of: dict[str, str], levels, only, most: int = PART) -> DataFrame:
    """``(gram, tid, size, k, at)``: every place of every fingerprint, of any length, of ``texts (corpus, tid, text)`` that passes ``only``, in the part of its text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seed, unit, rows in _parts(batch.column(0), unit_of):
                values = batch.column(2).take(pa.array(rows)).to_pylist()
                tids, sizes = batch.column(1).to_numpy()[rows], np.array([len(units(t, unit)) for t in values], np.int32)
                for k, row, pos, h in grams(values, unit, seed, every=True):
                    parts = np.maximum(1, (1 << levels.value[_index(h, len(levels.value))].astype(np.int64)) // most).astype(np.uint64)
                    part = mix(tids[row].astype(np.uint64)) % parts
                    gram = np.where(part > 0, mix(h + part), h)
                    kept = passes(gram, only.value)
                    row, pos, gram = row[kept], pos[kept], gram[kept]
                    yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(tids[row]), pa.array(sizes[row]), pa.array(np.full(len(row), k, np.int8)), pa.array(pos.astype(np.int32))], names=["gram", "tid", "size", "k", "at"])

    return texts.select("corpus", "tid", "text").mapInArrow(run, "gram bigint, tid bigint, size int, k tinyint, at int")


def _verify(unit_of: dict[str, str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for i, (corpus, x, y, seeds) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("corpus", "text_e", "text_t", "seeds")))):
                a, b = units(x, unit_of[corpus]), units(y, unit_of[corpus])
                # a fingerprint that a text holds twice tells no place
                known = [(s["lo_e"], s["lo_t"], s["k"]) for s in seeds if s["k"] and s["lo_e"] == s["hi_e"] < LONGEST and s["lo_t"] == s["hi_t"] < LONGEST]
                got = compare(a, b, known)
                if got is not None:
                    rows.append((i, *got, len(a)))
            at, edits, covered, n = zip(*rows) if rows else ((),) * 4
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("tid_e").take(at), batch.column("tid_t").take(at), *(pa.array(x, pa.int32()) for x in (edits, covered, n))], names=["tid_e", "tid_t", "edits", "covered", "n_units"])

    return run


def near_texts(texts: DataFrame, unit_of: dict[str, str], most: int = PART) -> DataFrame:
    """``(tid_e, tid_t, edits, covered, n_units)``: pairs of different texts of ``(corpus, tid, text, in_eval, in_train)`` within two edits across the parts of a corpus.

    ``covered`` of the ``n_units`` units of the eval text stand in stretches equal
    to those of the train text. ``texts`` must be a table that gives the same
    ``tid`` each time it is read. The seeds are written down, so that the joins to
    the texts are planned by their size: few seeds are sent to the texts, not all
    texts shuffled.
    """
    context = texts.sparkSession.sparkContext
    held, train = texts.where("in_eval"), texts.where("in_train")
    expected = (held.agg(F.sum(F.length("text"))).first()[0] or 0) // 4
    any_of = context.broadcast(gram_filter(held, None, unit_of, expected))
    levels = context.broadcast(gram_levels(train, unit_of, any_of))
    named = lambda m, side: m.select("gram", *[F.col(c).alias(f"{c}_{side}") for c in ("tid", "sig", "size", "k", "lo", "hi")])
    e = materialize(minima(held, unit_of, levels, most=most), "minima")
    only = context.broadcast(gram_filter(e, "gram", unit_of, e.count()))
    e, t = named(e, "e"), named(minima(train, unit_of, levels, only, most), "t")
    near = (
        (F.abs(F.col("size_e") - F.col("size_t")) <= EDITS)
        & (F.bit_count(F.col("sig_e").bitwiseXOR(F.col("sig_t"))) <= 2 * EDITS)
        & (F.col("lo_e") <= F.col("hi_t") + EDITS)
        & (F.col("lo_t") <= F.col("hi_e") + EDITS)
        & (F.col("k_e") == F.col("k_t"))
        & (F.col("tid_e") != F.col("tid_t"))
    )
    met = e.join(t, "gram").where(near)
    # a pair meets at each of its minima at most: 2k + 1 of two lengths
    seeds = met.groupBy("tid_e", "tid_t").agg(F.collect_set(F.struct(F.col("k_e").cast("int").alias("k"), "lo_e", "hi_e", "lo_t", "hi_t")).alias("seeds"))
    seeds = materialize(seeds, "seeds")
    x = texts.select("corpus", F.col("tid").alias("tid_e"), F.col("text").alias("text_e"))
    y = texts.select(F.col("tid").alias("tid_t"), F.col("text").alias("text_t"))
    both = seeds.join(x, "tid_e").join(y, "tid_t").select("tid_e", "tid_t", "corpus", "text_e", "text_t", "seeds")
    return both.mapInArrow(_verify(unit_of), "tid_e bigint, tid_t bigint, edits int, covered int, n_units int")


def _n_units(unit_of: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(F.col("corpus") == c, F.length("text") if u == "char" else F.size(F.split("text", " "))) for c, u in unit_of.items()]).cast("int")


#: Units that a record has at least to be looked for inside longer ones, of which one in five may be edited.
LEAST, PER_EDIT = 5, 5


def reach_end(a: Sequence, b: Sequence, limit: int) -> tuple[int, int] | None:
    """The least edits up to ``limit`` that turn ``a`` into a beginning of ``b``, and how long that is; None beyond."""
    n, m = len(a), len(b)
    last: dict[int, int] = {}
    for e in range(limit + 1):
        now: dict[int, int] = {}
        for d in range(-e, e + 1):
            tries = [0] if e == 0 else [last[x] + step for x, step in ((d - 1, 0), (d + 1, 1), (d, 1)) if x in last]
            tries = [i for i in tries if i <= n and 0 <= i + d <= m]
            if tries:
                i = max(tries)
                while i < n and i + d < m and a[i] == b[i + d]:
                    i += 1
                now[d] = i
        done = [n + d for d, i in now.items() if i == n]
        if done:
            return e, min(done, key=lambda j: (abs(j - n), j))
        last = now
    return None


def find_inside(a: Sequence, b: Sequence, seeds: Iterable[tuple[int, int]], limit: int) -> tuple[int, int, int] | None:
    """``(edits, place, units)`` of the stretch of ``b`` that is nearest to ``a``, through one of ``seeds (units, place in b)``; the first of equal ones, None beyond ``limit`` edits."""
    best, tried = None, set()
    for k, j in sorted(seeds, key=lambda s: (s[1], s[0])):
        seed = b[j : j + k]
        for i in range(len(a) - k + 1):
            if (i, j) in tried or a[i : i + k] != seed:
                continue
            tried.add((i, j))
            left = reach_end(a[:i][::-1], b[max(0, j - i - limit) : j][::-1], limit)
            right = left and reach_end(a[i + k :], b[j + k : j + len(a) - i + limit], limit - left[0])
            if right:
                best = min(best or (limit + 1, 0, 0), (left[0] + right[0], j - left[1], left[1] + k + right[1]))
    return best


def _find(unit_of: dict[str, str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for i, (corpus, x, y, seeds) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("corpus", "text_e", "text_t", "seeds")))):
                a, b = units(x, unit_of[corpus]), units(y, unit_of[corpus])
                got = find_inside(a, b, [(s["k"], s["at"]) for s in seeds], min(EDITS, len(a) // PER_EDIT))
                if got is not None:
                    rows.append((i, *got, len(a)))
            at, edits, first, n, size = zip(*rows) if rows else ((),) * 5
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("tid_e").take(at), batch.column("tid_t").take(at), *(pa.array(x, pa.int32()) for x in (edits, first, n, size))], names=["tid_e", "tid_t", "edits", "first", "stretch", "n_units"])

    return run


def contained_texts(texts: DataFrame, unit_of: dict[str, str], most: int = PART) -> DataFrame:
    """``(tid_e, tid_t, edits, first, stretch, n_units)``: eval texts of five units or more that are a stretch of a train text with more units than two edits explain.

    Up to two edits, and no more than one for five units. The minima of the eval
    text are looked up among all fingerprints of the train texts: two edits
    leave one of them whole inside the stretch, so nothing is missed. From each
    place where one is found the alignment is extended to both ends of the eval text.
    """
    context = texts.sparkSession.sparkContext
    held, train = texts.where("in_eval").where(_n_units(unit_of) >= LEAST), texts.where("in_train")
    expected = (held.agg(F.sum(F.length("text"))).first()[0] or 0) // 4
    any_of = context.broadcast(gram_filter(held, None, unit_of, expected))
    levels = context.broadcast(gram_levels(train, unit_of, any_of, every=True))
    e = materialize(minima(held, unit_of, levels, most=most).where("k > 0"), "minima")
    only = context.broadcast(gram_filter(e, "gram", unit_of, e.count()))
    t = occurrences(train, unit_of, levels, only, most)
    e = e.select("gram", F.col("tid").alias("tid_e"), F.col("size").alias("size_e"), F.col("k").alias("k_e"), "lo", "hi")
    t = t.select("gram", F.col("tid").alias("tid_t"), F.col("size").alias("size_t"), F.col("k").alias("k_t"), "at")
    fits = (F.col("k_e") == F.col("k_t")) & (F.col("size_t") > F.col("size_e") + EDITS) & (F.col("at") >= F.col("lo") - EDITS) & (F.col("size_t") - F.col("at") >= F.col("size_e") - F.col("hi") - EDITS)
    seeds = e.join(t, "gram").where(fits).groupBy("tid_e", "tid_t").agg(F.collect_set(F.struct(F.col("k_t").cast("int").alias("k"), "at")).alias("seeds"))
    seeds = materialize(seeds, "inside")
    x = texts.select("corpus", F.col("tid").alias("tid_e"), F.col("text").alias("text_e"))
    y = texts.select(F.col("tid").alias("tid_t"), F.col("text").alias("text_t"))
    both = seeds.join(x, "tid_e").join(y, "tid_t").select("tid_e", "tid_t", "corpus", "text_e", "text_t", "seeds")
    return both.mapInArrow(_find(unit_of), "tid_e bigint, tid_t bigint, edits int, first int, stretch int, n_units int")


def _distinct_texts(forms: DataFrame, unit_of: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The records with their texts' digests, and the distinct texts with numbers and how many train records have them, as tables."""
    kept = forms.where(F.col("split").isin("train", "dev", "test") & F.col("rec_id").isNotNull())
    text = F.coalesce(*[F.when(F.col("corpus") == c, units_column(F.col("form"), u)) for c, u in unit_of.items()])
    rows = kept.select("corpus", "rec_id", "split", "source", text.alias("text")).where("text is not null")
    rows = materialize(rows.select("*", *fingerprint("text", "h")), "units")
    train = F.col("split") == "train"
    part = rows.groupBy("corpus", "h1", "h2").agg(F.first("text").alias("text"), F.max(~train).alias("in_eval"), F.max(train).alias("in_train"), F.sum(train.cast("bigint")).alias("copies"))
    return rows, materialize(part.withColumn("tid", F.monotonically_increasing_id()), "texts")


def contained_records(forms: DataFrame, unit_of: dict[str, str], most: int = PART) -> DataFrame:
    """``(corpus, rec_id, split, source, n_units, texts, records, edits)``: dev and test records that stand, within two edits, inside longer train records.

    One row per record, with the numbers of distinct train texts and of train
    records that hold it, and the fewest edits. Rows that make no pair in
    ``cross_split_pairs`` and records of fewer than five units are no case;
    repeated rows come once.
    """
    rows, texts = _distinct_texts(forms, unit_of)
    found = contained_texts(texts, unit_of, most).join(texts.select(F.col("tid").alias("tid_t"), "copies"), "tid_t")
    per = found.groupBy("tid_e").agg(F.count("*").alias("texts"), F.sum("copies").alias("records"), F.min("edits").alias("edits"), F.max("n_units").alias("n_units"))
    keyed = per.join(texts.select(F.col("tid").alias("tid_e"), "corpus", "h1", "h2"), "tid_e")
    held = rows.where("split <> 'train'").select("corpus", "h1", "h2", "rec_id", "split", "source").distinct()
    return held.join(keyed, ["corpus", "h1", "h2"]).select("corpus", "rec_id", "split", "source", "n_units", "texts", "records", "edits")


def cross_split_pairs(forms: DataFrame, unit_of: dict[str, str], most: int = PART) -> DataFrame:
    """``(corpus, rec_a, rec_b, rec_eval, split, source, edits, covered, n_units)``: all pairs of a train and a dev or test record within two edits.

    ``forms (corpus, rec_id, split, source, form)`` has texts in their plain
    form; ``unit_of`` names the unit of each corpus. Rows with another split, of
    another corpus, with a null id or text or with none but white space and
    punctuation make no pair; repeated rows make a pair once. Each distinct text
    is compared once; its copies are joined to the result. A fingerprint is split
    where more than about ``most`` train texts hold it.
    """
    rows, texts = _distinct_texts(forms, unit_of)
    key = ["corpus", "h1", "h2"]
    same = texts.where("in_eval and in_train").select(F.col("tid").alias("tid_e"), F.col("tid").alias("tid_t"), F.lit(0).alias("edits"), _n_units(unit_of).alias("covered"), _n_units(unit_of).alias("n_units"))
    found = materialize(same.unionByName(near_texts(texts, unit_of, most)), "found")
    ids = texts.select("tid", *key)
    e = rows.where("split <> 'train'").select(*key, F.col("rec_id").alias("rec_eval"), "split", "source")
    t = rows.where("split = 'train'").select("corpus", F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.col("rec_id").alias("rec_train"))
    keyed = found.join(ids.withColumnRenamed("tid", "tid_e"), "tid_e").join(ids.select(F.col("tid").alias("tid_t"), F.col("h1").alias("t1"), F.col("h2").alias("t2")), "tid_t")
    keyed = materialize(keyed, "keyed")
    pairs = keyed.join(e, key).join(t, ["corpus", "t1", "t2"]).where("rec_eval <> rec_train")
    return pairs.select("corpus", F.least("rec_eval", "rec_train").alias("rec_a"), F.greatest("rec_eval", "rec_train").alias("rec_b"), "rec_eval", "split", "source", "edits", "covered", "n_units").distinct()


def overlap_records(forms: DataFrame, unit_of: dict[str, str]) -> DataFrame:
    """``(corpus, rec_id, split, source, pairs, covered, n_units)`` of the dev and test records with a partner in train: how many, and how many of the record's units the partner that covers most covers."""
    pairs = cross_split_pairs(forms, unit_of)
    return pairs.groupBy("corpus", F.col("rec_eval").alias("rec_id"), "split", "source").agg(F.count("*").alias("pairs"), F.max("covered").alias("covered"), F.max("n_units").alias("n_units"))


def overlap_report(forms: DataFrame, unit_of: dict[str, str]) -> DataFrame:
    """Per corpus, split and source: records, those with a partner in train, pairs, and the covered share of the units of those records."""
    per = overlap_records(forms, unit_of).groupBy("corpus", "split", "source").agg(F.count("*").alias("overlapping"), F.sum("pairs").alias("pairs"), F.round(F.sum("covered") / F.sum("n_units"), 6).alias("coverage"))
    held = forms.where(F.col("split").isin("dev", "test")).groupBy("corpus", "split", "source").agg(F.count("*").alias("records"))
    x, y = held.alias("x"), per.alias("y")
    same = (F.col("x.corpus") == F.col("y.corpus")) & (F.col("x.split") == F.col("y.split")) & F.col("x.source").eqNullSafe(F.col("y.source"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return x.join(y, same, "left").select("x.corpus", "x.split", "x.source", "records", zero("overlapping"), zero("pairs"), "coverage")
