import random
import unicodedata
from collections import Counter

import numpy as np

from glossmill.llm import terms


def brute(rows, listed, rare, common):
    records = {}
    for sentence, lemmas in rows:
        if lemmas is not None or sentence not in records:
            records[sentence] = lemmas
    n, df = Counter(), Counter()
    for lemmas in records.values():
        own = [p for t in lemmas or () if (p := terms.plain_term(t))]
        n.update(own)
        df.update(set(own))
    every = set(n) | {p for t in listed if (p := terms.plain_term(t))}
    return {t: (n[t], df[t], "rare" if df[t] < rare else "common" if n[t] / max(1, len(records)) >= common else None) for t in every}


def found(df):
    return {r.lemma: (r.n, r.n_records, r.mark) for r in df.collect()}


def test_containers_round_trip():
    g = np.random.default_rng(1)
    for size in (0, 1, 5, terms.SPARSE, terms.SPARSE + 1, 60_000):
        at = np.sort(g.choice(terms.BLOCK, size, replace=False))
        c = terms.encode(at)
        assert (terms.decode(c) == at).all() and terms.cardinality(c) == size
        other = np.sort(g.choice(terms.BLOCK, 3000, replace=False))
        assert terms.cardinality(terms.union([c, terms.encode(other)])) == len(np.union1d(at, other))


def test_against_brute_force(spark):
    g = random.Random(3)
    words = ["wind", " Wind", "WIND ", "ä", unicodedata.normalize("NFD", "Ä"), "sonne", "x", "", "  ", None, "selten"]
    rows = [(f"s{g.randrange(60)}", None) for _ in range(10)]
    fixed = {}
    for _ in range(200):
        s = f"s{g.randrange(60)}"
        rows.append((s, fixed.setdefault(s, [g.choice(words) for _ in range(g.randrange(0, 6))])))
    rows += [(None, ["wind", "wind"])]
    listed = ["neu", "NEU", "wind", None, " "]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "sentence string, lemmas array<string>, n int, lemma string").repartition(5)
    names = spark.createDataFrame([(x,) for x in listed], "lemma string")
    assert found(terms.term_frequencies(df, "sentence", "lemmas", [names], 3, 0.4)) == brute(rows, listed, 3, 0.4)


def test_blocks_close_early_and_at_their_size(spark, monkeypatch):
    rows = [(str(i), ["hot", "hot", f"t{i % 7}"]) for i in range(70_000)]
    df = spark.createDataFrame(rows, "sentence string, lemmas array<string>").coalesce(1)
    index = terms.vertical_index(df, "lemmas")
    keys = index.where("term = 'hot'").count()
    got = {r.term: (r.n, r.d) for r in terms.merge_indexes(index).groupBy("term").agg({"occurrences": "sum", "n_records": "sum"}).toDF("term", "n", "d").collect()}
    assert keys == 5 and got["hot"] == (140_000, 70_000) and got["t0"] == (10_000, 10_000)


def test_indexes_over_the_same_records_merge_by_union(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],)], "l array<string>").coalesce(1)
    index = terms.vertical_index(df, "l")
    twice = {r.term: (r.occurrences, r.n_records) for r in terms.merge_indexes(index, index).collect()}
    assert twice == {"a": (4, 2), "b": (2, 1)}


def test_no_records(spark):
    df = spark.createDataFrame([], "sentence string, lemmas array<string>")
    names = spark.createDataFrame([("Neu",)], "lemma string")
    assert found(terms.term_frequencies(df, "sentence", "lemmas", [names])) == {"neu": (0, 0, "rare")}
    assert found(terms.term_frequencies(df, "sentence", "lemmas")) == {}


def test_partial_containers_of_a_block_are_merged_by_union(spark):
    rows = [(["hot", "hot"] if i % 2 else ["hot", f"t{i % 3}"],) for i in range(20_000)]
    index = terms.vertical_index(spark.createDataFrame(rows, "lemmas array<string>").repartition(8), "lemmas").where("term is not null").cache()
    partial = {(r.term, r.key): r["count"] for r in index.groupBy("term", "key").count().collect()}
    assert len({k for _, k in partial}) == 2 and set(partial.values()) == {terms.SLICES}
    merged = terms.merge_indexes(index).collect()
    assert {(r.term, r.key) for r in merged} == set(partial)
    assert sum(r.n_records for r in merged if r.term == "hot") == 20_000 and sum(r.occurrences for r in merged if r.term == "hot") == 30_000
    assert all(terms.cardinality(bytes(r.bitmap)) == r.n_records for r in merged)
