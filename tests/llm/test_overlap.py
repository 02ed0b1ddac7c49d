import random

import numpy as np
import pytest

from glossmill.llm import overlap


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(g, seq, alphabet, n):
    s = list(seq)
    for _ in range(n):
        at, kind = g.randrange(len(s) + 1), g.randrange(3)
        if kind == 0:
            s.insert(at, g.choice(alphabet))
        elif s and kind == 1:
            s.pop(min(at, len(s) - 1))
        elif s:
            s[min(at, len(s) - 1)] = g.choice(alphabet)
    return s


def test_distance_equals_brute_force():
    g = random.Random(1)
    for _ in range(4000):
        a = [g.choice("abc") for _ in range(g.randrange(0, 9))]
        b = edited(g, a, "abc", g.randrange(0, 4))
        d = levenshtein(a, b)
        assert overlap.distance(a, b) == (d if d <= 2 else None)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def seeds_of(a, b, k):
    at = {}
    for i in range(len(a) - k + 1):
        at.setdefault(tuple(a[i : i + k]), []).append(i)
    return [(p[0], j, k) for j in range(len(b) - k + 1) if len(p := at.get(tuple(b[j : j + k]), [])) == 1]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnop"])
def test_alignment_from_a_chain_is_exact(alphabet):
    g = random.Random(3)
    led = 0
    for _ in range(4000):
        a = [g.choice(alphabet) for _ in range(g.randrange(1, 25))]
        b = edited(g, a, alphabet, g.randrange(0, 4))
        if not b or a == b:
            continue
        d = levenshtein(a, b)
        seeds = seeds_of(a, b, g.choice([1, 2, 3, 5]))
        chain = overlap.chain_seeds(seeds)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in chain)
        assert all(i + n <= p and j + n <= q for (i, j, n), (p, q, _) in zip(chain, chain[1:]))
        through = overlap.extend(a, b, chain)
        led += through is not None and through[0] == d
        assert through is None or (d <= through[0] <= 2 and all(a[i : i + n] == b[j : j + n] for i, j, n in through[1]))
        got = overlap.compare(a, b, seeds)
        if d > 2:
            assert got is None
            continue
        assert got[0] == d
        indels = len(a) - len(b)
        assert got[1] == {1: {0: len(a) - 1, 1: len(a) - 1, -1: len(a)}, 2: {2: len(a) - 2, 1: len(a) - 2, -1: len(a) - 1, -2: len(a), 0: lcs(a, b) if lcs(a, b) == len(a) - 1 else len(a) - 2}}[d][indels]
    assert led > 1000


def test_seeds_off_the_alignment_do_not_lead_astray():
    assert overlap.chain_seeds([(0, 5, 3), (4, 4, 3), (6, 6, 3), (8, 1, 3)]) == [(4, 4, 5)]
    assert overlap.chain_seeds([]) == []
    a, b = list("xabcabcabcy"), list("xabcabcaby")
    assert overlap.compare(a, b, [(1, 3, 3)]) == (1, 10)


@pytest.mark.parametrize("unit", ["char", "word"])
def test_minima_of_two_texts_within_two_edits_meet(unit):
    g = random.Random(2)
    levels = np.random.default_rng(0).integers(0, 9, 1 << 16).astype(np.uint8)
    for trial in range(1500):
        alphabet = "ab" if trial % 3 else "abcdefghij"
        a = [g.choice(alphabet) for _ in range(g.randrange(1, 30))]
        b = edited(g, a, alphabet, 2)
        if not b:
            continue
        join = ("" if unit == "char" else " ").join
        s = overlap.select_minima([join(a), join(b)], unit, 1, levels)
        assert set(s["hash"][s["row"] == 0]) & set(s["hash"][s["row"] == 1]), (a, b)


def test_parity_changes_two_bits_per_edit_at_most():
    g = random.Random(4)
    for _ in range(500):
        a = [g.choice("abcdefg") for _ in range(g.randrange(1, 30))]
        b = edited(g, a, "abcdefg", 2)
        if b:
            sig, _ = overlap.parity(["".join(a), "".join(b)], "char")
            assert int(sig[0] ^ sig[1]).bit_count() <= 4


def brute(rows, unit_of):
    out = set()
    units = {(c, i): (s, overlap.units(t, unit_of[c])) for c, i, s, _, f in rows if c in unit_of and i is not None and (t := overlap.plain_units(f, unit_of[c]))}
    for (c, i), (s, a) in units.items():
        for (k, j), (r, b) in units.items():
            if c == k and i < j and {s == "train", r == "train"} == {True, False} and {s, r} <= {"train", "dev", "test"} and levenshtein(a, b) <= 2:
                out.add((c, i, j))
    return out


def test_pairs_equal_brute_force(spark):
    g = random.Random(7)
    rows, texts = [], {"a": [], "b": []}
    for i in range(500):
        c = g.choice("ab")
        join = ("" if c == "a" else " ").join
        if texts[c] and g.random() < 0.6:
            t = edited(g, g.choice(texts[c]), "xyzw", g.randrange(0, 4))
        else:
            t = [g.choice("xyzw" if g.random() < 0.5 else "abcdefgh") for _ in range(g.choice([1, 2, 3, 4, 5, 6, 8, 11, 12, 13, 14, 20, 30]))]
        if not t:
            continue
        texts[c].append(t)
        form = join(t)
        form = form.upper() if g.random() < 0.2 else form
        form = form + (" ." if c == "b" else "。") if g.random() < 0.3 else form
        rows.append((c, i, g.choice(["train", "train", "dev", "test", None]), g.choice(["s1", "s2", None]), form))
    rows += [("a", 901, "dev", None, None), ("a", 902, "train", None, "。"), ("b", 903, "dev", None, " ... "), ("b", None, "train", None, "x y"), ("c", 904, "dev", None, "x"), rows[0]]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "corpus string, rec_id bigint, split string, source string, form string, text string").repartition(3)
    unit_of = {"a": "char", "b": "word"}
    got = overlap.cross_split_pairs(df, unit_of)
    pairs = [(r.corpus, r.rec_a, r.rec_b) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == brute(rows, unit_of)
    report = overlap.overlap_report(df, unit_of).collect()
    assert sum(r.pairs for r in report) == len(pairs)
    assert all(r.overlapping <= r.records and (r.coverage is None or 0 <= r.coverage <= 1) for r in report)
    records = overlap.overlap_records(df, unit_of).collect()
    assert sum(r.pairs for r in records) == len(pairs) and all(0 <= r.covered <= r.n_units for r in records)
    assert overlap.cross_split_pairs(df.limit(0), unit_of).count() == 0


def test_hot_copies_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    df = spark.range(4_000).selectExpr("'b' AS corpus", "id AS rec_id", "if(id = 0, 'dev', 'train') AS split", "'s' AS source", "'viele kopien von einem satz mit wind' AS form")
    more = spark.createDataFrame([("b", 5000, "dev", "s", long), ("b", 5001, "train", "s", long.replace("w7 ", "")), ("b", 5002, "train", "s", long + " x y z")], df.schema)
    got = overlap.cross_split_pairs(df.unionByName(more), {"b": "word"})
    assert got.where("rec_a < 5000").count() == 3_999
    assert [(r.rec_a, r.rec_b, r.edits) for r in got.where("rec_a >= 5000").collect()] == [(5000, 5001, 1)]


def test_frequent_fingerprints_are_dealt_into_parts(spark):
    g = random.Random(9)
    rows = [("b", i, "dev" if i % 5 == 0 else "train", None, " ".join(["der wind", g.choice("ab"), g.choice("abcdefgh"), g.choice("abcdefgh"), "weht heute"])) for i in range(150)]
    rows += [("b", 1000 + i, "dev" if i % 3 == 0 else "train", None, f"kurz{i}") for i in range(30)]
    got = overlap.cross_split_pairs(spark.createDataFrame(rows, "corpus string, rec_id bigint, split string, source string, form string"), {"b": "word"}, most=4)
    assert {(r.corpus, r.rec_a, r.rec_b) for r in got.collect()} == brute(rows, {"b": "word"})


def nearest_inside(a, b):
    """The least edits between ``a`` and any stretch of ``b``, by the whole table."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnop"])
def test_stretches_found_from_seeds_are_the_nearest(alphabet):
    g = random.Random(12)
    hits = 0
    for _ in range(2500):
        a = [g.choice(alphabet) for _ in range(g.randrange(5, 18))]
        b = [g.choice(alphabet) for _ in range(g.randrange(0, 8))] + edited(g, a, alphabet, g.randrange(0, 4)) + [g.choice(alphabet) for _ in range(g.randrange(0, 8))]
        d = nearest_inside(a, b)
        seeds = [(1, j) for j in range(len(b))]
        got = overlap.find_inside(a, b, seeds, 2)
        assert (got and got[0]) == (d if d <= 2 else None)
        if got:
            hits += 1
            assert levenshtein(a, b[got[1] : got[1] + got[2]]) == got[0]
    assert hits > 800


def test_records_inside_longer_ones_equal_brute_force(spark):
    g = random.Random(13)
    rows, unit_of = [], {"a": "char", "b": "word"}
    for i in range(160):
        c = g.choice("ab")
        join = ("" if c == "a" else " ").join
        old = [overlap.units(r[4], unit_of[c]) for r in rows if r[0] == c]
        alphabet = "xy" if g.random() < 0.3 else "abcdefghijkl"
        t = edited(g, g.choice(old), alphabet, g.randrange(0, 4)) if old and g.random() < 0.6 else [g.choice(alphabet) for _ in range(g.randrange(2, 16))]
        if g.random() < 0.5:
            t = [g.choice(alphabet) for _ in range(g.randrange(0, 20))] + t + [g.choice(alphabet) for _ in range(g.randrange(0, 20))]
        if t:
            rows.append((c, i, g.choice(["train", "train", "dev", "test"]), None, join(t)))
    rows += [rows[0], ("a", 900, None, None, "abcdefgh"), ("a", 901, "dev", None, None), ("b", 902, "dev", None, "a b c d")]
    df = spark.createDataFrame(rows, "corpus string, rec_id bigint, split string, source string, form string").repartition(3)
    want = {}
    of = lambda r: tuple(overlap.units(r[4], unit_of[r[0]]))
    for e in {r for r in rows if r[2] in ("dev", "test") and r[4]}:
        a = of(e)
        near = [(of(t), d) for t in rows if t[2] == "train" and t[0] == e[0] and len(of(t)) > len(a) + 2 and (d := nearest_inside(a, of(t))) <= min(2, len(a) // 5)]
        if len(a) >= 5 and near:
            want[e[0], e[1]] = (len({t for t, _ in near}), min(d for _, d in near))
    got = {(r.corpus, r.rec_id): (r.texts, r.edits) for r in overlap.contained_records(df, unit_of, most=4).collect()}
    assert got == want and len(want) > 10
    assert overlap.contained_records(df.limit(0), unit_of).count() == 0
