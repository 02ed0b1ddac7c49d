import math
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossmill.operators import bleu, chrf, multilabel, rouge

PAIRS = "g int, hyp array<string>, refs array<array<string>>"


def plain_bleu(pairs, smooth="floor", value=0.0):
    correct, total, sys_len, ref_len = [0.0] * 4, [0.0] * 4, 0, 0
    for hyp, refs in pairs:
        sys_len += len(hyp)
        ref_len += min(refs, key=lambda r: (abs(len(hyp) - len(r)), len(r))).__len__()
        for n in range(1, 5):
            grams = lambda s: Counter(tuple(s[i : i + n]) for i in range(len(s) - n + 1))  # noqa: E731, B023
            best = Counter()
            for r in refs:
                best |= grams(r)
            h = grams(hyp)
            correct[n - 1] += sum((h & best).values())
            total[n - 1] += sum(h.values())
    p, halving = [0.0] * 4, 1.0
    for n in range(4):
        if smooth == "add-k" and n > 1:
            correct[n] += value
            total[n] += value
        if total[n] == 0:
            break
        if correct[n]:
            p[n] = 100 * correct[n] / total[n]
        elif smooth == "exp":
            halving *= 2
            p[n] = 100 / (halving * total[n])
        elif smooth == "floor":
            p[n] = 100 * value / total[n]
    bp = 1.0 if sys_len >= ref_len else math.exp(1 - ref_len / sys_len) if sys_len else 0.0
    return [bp * math.exp(sum(map(math.log, p[:k])) / k) if min(p[:k]) else 0.0 for k in range(1, 5)] + [bp, sys_len, ref_len]


def run(spark, pairs, **kw):
    df = spark.createDataFrame([(0, h, r) for h, r in pairs], PAIRS).repartition(3)
    return list(bleu.bleu(df, **kw).first())


CASES = {
    "identical": [("a b c d e".split(), ["a b c d e".split()])],
    "disjoint": [("a b c d".split(), ["x y z w".split()])],
    "empty hypothesis": [([], ["a b".split()])],
    "empty reference": [("a b".split(), [[]])],
    "both empty": [([], [[]])],
    "three words": [("a b c".split(), ["a b c".split()])],
    "clipped": [("a a a a".split(), ["a a b".split()])],
    "shorter": [("a b c d".split(), ["a b c d e f".split()])],
    "longer": [("a b c d e f".split(), ["a b c d".split()])],
    "two references of a tie": [("a b c d e".split(), ["a b c d e f".split(), "a b c d".split()])],
    "no match of four": [("a b c x d e f".split(), ["a b c y d e f".split()])],
    "max over references": [("a a b c d".split(), ["a b c d".split(), "a a x c d".split()])],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("smooth,value", [("floor", 0.0), ("floor", 0.1), ("exp", 0.0), ("add-k", 1.0), ("none", 0.0)])
def test_bleu_cases(spark, name, smooth, value):
    assert run(spark, CASES[name], smooth=smooth, value=value) == pytest.approx(plain_bleu(CASES[name], smooth, value), abs=2e-6)


def test_known_values(spark):
    assert run(spark, CASES["identical"])[:4] == [100.0] * 4
    assert run(spark, CASES["clipped"])[0] == 50.0
    assert run(spark, CASES["two references of a tie"])[-1] == 4
    assert run(spark, CASES["no match of four"])[3] == 0.0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), max_size=9), st.lists(st.lists(st.sampled_from("abc"), max_size=9), min_size=1, max_size=3)), min_size=1, max_size=6))
def test_bleu_of_any_pairs(spark, pairs):
    got = run(spark, pairs)
    assert got == pytest.approx(plain_bleu(pairs), abs=2e-6)
    assert all(0 <= x <= 100 for x in got[:4])


def test_statistics_add_up_in_any_partitioning(spark):
    g = random.Random(1)
    rows = [(i % 3, [g.choice("abcd") for _ in range(g.randrange(9))], [[g.choice("abcd") for _ in range(g.randrange(9))]]) for i in range(200)]
    df = spark.createDataFrame(rows, PAIRS)
    results = [sorted(map(tuple, bleu.bleu(df.repartition(n), ["g"]).collect())) for n in (1, 4, 16)]
    assert results[0] == results[1] == results[2]
    assert len(bleu.bleu(spark.createDataFrame([], PAIRS)).collect()) == 1
    kept = spark.createDataFrame([(0, None, [["a"]]), (0, ["a"], None), (0, ["a"], [["a"]])], PAIRS)
    assert bleu.bleu(kept).first().sys_len == 1


def plain_chrf(pairs):
    sums = [[0, 0, 0] for _ in range(6)]
    for h, r in pairs:
        h, r = "".join(h.split()), "".join(r.split())
        for n in range(1, 7):
            a, b = (Counter(s[i : i + n] for i in range(len(s) - n + 1)) for s in (h, r))
            for k, c in enumerate((a, b, a & b)):
                sums[n - 1][k] += sum(c.values())
    used = [s for s in sums if s[0] and s[1]]
    if not used:
        return 0.0
    p, q = sum(c / h for h, _, c in used) / len(used), sum(c / r for _, r, c in used) / len(used)
    return 5 * p * q / (4 * p + q) if p + q else 0.0


@pytest.mark.parametrize("pairs", [[("abc", "abc")], [("ab", "abcdef")], [("  ", "a")], [("", "")], [("a b c d e f g", "abcdefg")], [("wind weht", "der wind"), ("x", "y")], [("äöü 你好", "äöü 你们")]])
def test_chrf(spark, pairs):
    df = spark.createDataFrame(pairs, "h string, r string")
    assert chrf.chrf(df, "h", "r").first()[0] == pytest.approx(plain_chrf(pairs), abs=1e-6)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(st.lists(st.sampled_from("abcd"), max_size=80), st.lists(st.sampled_from("abcd"), max_size=80))
def test_lcs(a, b):
    assert rouge.lcs_length(a, b) == plain_lcs(a, b) == rouge.lcs_length(b, a)


def test_rouge_cases(spark):
    rows = [("", [""], 1.0), ("a b c", ["a b c"], 1.0), ("a", ["b"], 0.0), ("a  b", ["a b"], None), ("a b c d", ["a b x y z w", "c"], None)]
    df = spark.createDataFrame([(h, r) for h, r, _ in rows], "h string, r array<string>")
    got = [x[0] for x in df.select(rouge.rouge_l(F.col("h"), F.col("r"))).collect()]
    for (h, refs, want), value in zip(rows, got):
        p = max(plain_lcs(r.split(" "), h.split(" ")) / len(h.split(" ")) for r in refs)
        q = max(plain_lcs(r.split(" "), h.split(" ")) / len(r.split(" ")) for r in refs)
        expected = 2.44 * p * q / (q + 1.44 * p) if p and q else 0.0
        assert value == pytest.approx(expected) and (want is None or value == pytest.approx(want))
    nulls = spark.createDataFrame([(None, ["a"]), ("a", None)], "h string, r array<string>")
    assert [x[0] for x in nulls.select(rouge.rouge_l(F.col("h"), F.col("r"))).collect()] == [None, None]
    assert rouge.mean_rouge_l(df.limit(0), "h", "r").first()[0] is None


def test_multilabel_cases(spark):
    scores = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.9), (1, 2, 0.8), (2, 0, 0.7), (2, 1, 0.2), (2, 2, 0.6)], "sample int, class_id int, score double")
    targets = spark.createDataFrame([(1, [0, 1, 1]), (2, [0, 1]), (3, [0])], "sample int, ids array<int>")
    cell = multilabel.cells(scores, targets)
    assert {tuple(r) for r in multilabel.counts(cell, ["class_id"]).collect()} == {(0, 1, 0, 1), (1, 1, 0, 1), (2, 0, 2, 0)}
    assert tuple(multilabel.micro(cell).first()) == (0.5, 0.5)
    assert tuple(multilabel.macro(cell).first()) == (0.5, pytest.approx(2 / 3, abs=1e-6))
    none = cell.where("class_id = 99")
    assert tuple(multilabel.micro(none).first()) == (None, None) and tuple(multilabel.macro(none).first()) == (None, None)


def test_losses(spark):
    cell = spark.createDataFrame([(0.9, 1), (0.1, 0), (0.0, 1), (1.0, 1)], "score double, y int")
    clamp = lambda p: min(max(p, 1e-8), 1 - 1e-8)
    want = sum(-math.log(clamp(p)) if y else -math.log(1 - clamp(p)) for p, y in [(0.9, 1), (0.1, 0), (0.0, 1), (1.0, 1)]) / 4
    assert multilabel.bce_loss(cell).first()[0] == pytest.approx(want, abs=1e-6)
    logits = {0: [1.0, 2.0, 500.0], 1: [0.5, -1.0, 0.0]}
    rows = [(p, c, x, 1, True) for p, xs in logits.items() for c, x in enumerate(xs)] + [(2, 0, 9.0, 0, False)]
    df = spark.createDataFrame(rows, "pos int, class_id int, logit double, target_id int, valid boolean")
    want = 0.0
    for xs in logits.values():
        lse = max(xs) + math.log(sum(math.exp(x - max(xs)) for x in xs))
        want += (0.9 * (lse - xs[1]) + 0.1 * sum(lse - x for x in xs) / 3) / 2
    assert multilabel.ce_loss(df, ["pos"]).first()[0] == pytest.approx(want, abs=1e-5)
    assert {tuple(r) for r in multilabel.arg_max(df.where("valid"), ["pos"], "class_id", "logit").collect()} == {(0, 2), (1, 0)}
