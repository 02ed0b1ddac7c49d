import random
from collections import Counter

import numpy as np

from glossmill.llm import packing


def brute_best_fit(sizes, capacity):
    rooms, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in rooms if r >= sizes[i]]
        out[i] = capacity - min(fits) if fits else 0
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - sizes[i])
        else:
            rooms.append(capacity - sizes[i])
    return sorted(rooms)


def test_best_fit_equals_a_search_of_all_containers():
    g = random.Random(1)
    for _ in range(200):
        capacity = g.choice([1, 2, 7, 64, 100])
        sizes = [g.randrange(1, capacity + 1) for _ in range(g.randrange(0, 60))]
        at = packing.best_fit_decreasing(np.array(sizes, np.int64), capacity)
        used = Counter()
        for s, c in zip(sizes, at.tolist()):
            used[c] += s
        assert sorted(capacity - u for u in used.values()) == brute_best_fit(sizes, capacity)


def test_pack(spark):
    g = random.Random(2)
    rows = [(i, g.choice([1, 5, 17, 40, 100, 101, 250, 1000])) for i in range(500)] + [(700, None), (701, 0), (702, 200), (702, 200), (None, 3)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, n_tokens int, container int")
    packed = packing.pack(df, "doc_id", "n_tokens", 100, per_shard=200).collect()
    assert sum(r.n_tokens for r in packed) == sum(n or 0 for _, n in rows)
    used, pieces = Counter(), Counter()
    for r in packed:
        if r.container is not None:
            used[r.container] += r.n_tokens
            pieces[r.doc_id] += 1
    assert max(used.values()) <= 100
    for i, n in rows[:500]:
        assert pieces[i] == -(-n // 100)
    assert {r.doc_id: r.container for r in packed if r.container is None} == {700: None, 701: None}
    assert pieces[702] == 4 and pieces[None] == 1
    again = {tuple(r) for r in packing.pack(df, "doc_id", "n_tokens", 100, per_shard=200).collect()}
    assert again == {tuple(x) for x in packed}
    assert packing.pack(df.limit(0), "doc_id", "n_tokens", 100).count() == 0


def test_fill(spark):
    g = np.random.default_rng(0)
    sizes = np.minimum(g.geometric(1 / 90, 20_000), 512)
    df = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "k bigint, n int")
    r = packing.fill_report(packing.pack(df, "k", "n", 512), "n", 512).first()
    assert r.tokens == sizes.sum() and r.fullest <= 512 and r.fill > 0.99


def test_null_and_repeated_keys_are_dealt_evenly(spark):
    df = spark.createDataFrame([(None if i % 2 else 7, 1 + i % 9) for i in range(4_000)], "id bigint, n int")
    got = packing.pack(df, "id", "n", 20, per_shard=500)
    assert got.count() == 4_000 and got.groupBy("container").agg({"n": "sum"}).where("`sum(n)` > 20").count() == 0
    per = [r["count"] for r in got.selectExpr("container >> 32 AS shard").groupBy("shard").count().collect()]
    assert len(per) == 8 and max(per) < 700
