import numpy as np
import pytest

from glossmill.llm import mixing, tokens

PATH = tokens.DEFAULT_VOCABULARY
STYLE = {"wetter": "der wind weht über dem moor und die sonne scheint", "notes": "the camera team drops every stride of four frames", "zeichen": "今天老师在青水河屿准备了门票"}


def docs(spark, n=300):
    g = np.random.default_rng(1)
    names = list(STYLE)
    rows = []
    for i in range(n):
        s = names[0] if i % 3 == 0 else names[i % 2 + 1]
        words = STYLE[s].split(" ") if s != "zeichen" else list(STYLE[s])
        rows.append((i, s, (" " if s != "zeichen" else "").join(g.choice(words, int(g.integers(3, 40)))), 7))
    rows += [(900, None, "wind"), (901, "fremd", "wind"), (902, "notes", None), (903, "notes", "")]
    return spark.createDataFrame([(*r[:3], 7) for r in rows], "doc_id bigint, source string, text string, copies int")


def cells(g, d, n):
    source = np.r_[np.arange(d), g.integers(0, d, n - d)]
    used = g.integers(10, 1000, n).astype(float)
    return source, g.dirichlet(np.ones(d), n) * used[:, None], used, g.dirichlet(np.ones(d)), g.integers(1, 5, d).astype(float)


def test_rates_meet_targets_within_caps():
    g = np.random.default_rng(2)
    for _ in range(20):
        source, expected, used, shares, caps = cells(g, 4, 60)
        r, goal = mixing.fit_rates(source, expected, used, shares, caps)
        assert (r >= 0).all() and (r <= caps[source] + 1e-9).all()
        reached = np.bincount(source, r * used, 4)
        assert np.allclose(reached, goal, rtol=1e-4) and np.allclose(reached / reached.sum(), shares, atol=1e-4)


def test_no_other_rates_come_nearer_to_the_domain_targets():
    g = np.random.default_rng(4)
    for _ in range(5):
        source, expected, used, shares, caps = cells(g, 3, 30)
        r, goal = mixing.fit_rates(source, expected, used, shares, caps, steps=3000)
        gap = lambda x: ((x @ expected - goal) ** 2).sum()
        even = mixing.onto_labels(np.zeros(30), source, used, caps[source], goal)
        assert gap(r) < gap(even)
        for _ in range(300):
            other = mixing.onto_labels(r + g.normal(0, g.choice([0.01, 0.1, 1.0]), 30), source, used, caps[source], goal)
            assert gap(other) > gap(r) - 2 * mixing.EVEN_WEIGHT * goal.sum() ** 2


def test_the_gradient_of_a_cell_is_the_sum_of_its_documents():
    g = np.random.default_rng(5)
    n, d = 400, 4
    p, used, source = g.dirichlet(np.full(d, 0.3), n), g.integers(1, 500, n).astype(float), g.integers(0, d, n)
    cell = mixing.cells_of(source, p)
    names, at = np.unique(cell, return_inverse=True)
    assert (mixing.source_of(names, d)[at] == source).all()
    expected = np.zeros((len(names), d))
    np.add.at(expected, at, used[:, None] * p)
    rates, goal = g.random(len(names)), g.random(d) * 1000
    of_documents = (used[:, None] * p) @ ((rates[at] * used) @ p - goal)
    assert np.allclose(expected @ (rates @ expected - goal), np.bincount(at, of_documents))


def test_soft_memberships_pull_rates(spark):
    source = np.array([0, 0, 1, 1])
    soft = np.array([[1.0, 0.0], [0.2, 0.8], [0.0, 1.0], [0.8, 0.2]]) * 100
    r, _ = mixing.fit_rates(source, soft, np.full(4, 100.0), np.array([0.8, 0.2]), np.array([2.0, 2.0]), total=150.0)
    assert r[0] > r[1]


def test_a_total_out_of_reach_is_not_lowered():
    r, goal = mixing.fit_rates(np.array([0, 1]), np.eye(2) * 100, np.array([100.0, 100.0]), np.array([0.5, 0.5]), np.array([1.0, 9.0]), total=1000.0)
    assert goal.tolist() == [500.0, 500.0] and np.allclose(r, [1, 5], atol=1e-3)


def test_mix(spark):
    df = docs(spark)
    targets = mixing.Targets.of([("wetter", 0.5, 2), ("notes", 0.3, 3), ("zeichen", 0.1, 4), ("leer", 0.1, 2), (None, 0.5, 1), ("null", None, 1)])
    mixed = mixing.mix_sources(df, "doc_id", "source", "text", targets, PATH)
    rows = mixed.collect()
    caps = {"wetter": 2, "notes": 3, "zeichen": 4}
    assert rows and all(1 <= r.copies <= caps[r.source] for r in rows)
    assert not {r.doc_id for r in rows} & {900, 901, 902, 903}
    total = sum(r.n_tokens * r.copies for r in rows)
    for s, share in (("wetter", 0.5), ("notes", 0.3), ("zeichen", 0.1)):
        assert sum(r.n_tokens * r.copies for r in rows if r.source == s) / total == pytest.approx(share / 0.9, abs=0.004)
    again = {tuple(r)[:4] for r in mixing.mix_sources(df.repartition(5), "doc_id", "source", "text", targets, PATH).collect()}
    assert {r[:4] for r in again} == {tuple(r)[:4] for r in rows}
    t = spark.createDataFrame([("wetter", 0.5, 2), ("leer", 0.1, 2)], "source string, target_share double, max_repeats int")
    report = {r.source: r for r in mixing.share_report(mixed, "source", t).collect()}
    assert report["leer"].tokens == 0 and report["wetter"].most_copies <= 2
    t = spark.createDataFrame([(s, float(x), int(c)) for s, x, c in zip(targets.sources, targets.shares, targets.caps)], t.schema)
    report = mixing.share_report(mixed, "source", t).collect()
    assert sum(r.domain_share for r in report) == pytest.approx(1, abs=1e-5) and all(r.shortfall <= 60 for r in report)
    assert sum(abs(r.domain_share - r.actual_share) for r in report) < 0.05


def test_too_many_sources():
    with pytest.raises(ValueError):
        mixing.Targets.of([(str(i), 0.01, 1) for i in range(65)])


def test_small_total_and_nothing_to_mix(spark):
    df = docs(spark)
    targets = mixing.Targets.of([("wetter", 0.6, 1), ("notes", 0.4, 1)])
    rows = mixing.mix_sources(df, "doc_id", "source", "text", targets, PATH, total=800.0).collect()
    assert sum(r.n_tokens * r.copies for r in rows) == pytest.approx(800, abs=40)
    assert mixing.mix_sources(df.limit(0), "doc_id", "source", "text", targets, PATH).count() == 0
    assert mixing.mix_sources(df, "doc_id", "source", "text", mixing.Targets.of([]), PATH).count() == 0


def test_classifier_on_held_out_rows(spark):
    df = docs(spark, 600).where("text is not null").selectExpr("doc_id AS key", "source", "text").where("source in ('wetter', 'notes', 'zeichen')")
    targets = mixing.Targets.of([(s, 1 / 3, 1) for s in STYLE])
    c = mixing.fit_classifier(df.where("key < 300"), targets, PATH, per_source=50)
    e = tokens.encoding(PATH)
    held = df.where("key >= 300 and text <> ''").collect()
    p = c.posteriors([np.array(e.encode_ordinary(r.text)) for r in held])
    right = sum(targets.sources[int(i)] == r.source for i, r in zip(p.argmax(axis=1), held))
    assert right / len(held) > 0.97
    assert np.allclose(c.posteriors([np.zeros(0, np.int64)]), 1 / 3)
