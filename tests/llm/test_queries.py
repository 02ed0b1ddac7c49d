import pytest

from glossmill.llm import queries, tokens
from tests import oracle


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, name):
    oracle.same(spark, con, queries.QUERIES[name], queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, oracle.DATA).count() > 0


def test_oversized_documents_are_those_by_token_count(spark, con):
    e = tokens.encoding(tokens.DEFAULT_VOCABULARY)
    n = {i: len(e.encode_ordinary(t)) for i, t in con.sql("SELECT doc_id, text FROM documents WHERE text IS NOT NULL").fetchall()}
    assert {r[0] for r in queries.p7_found(spark, oracle.DATA).collect()} == {i for i, k in n.items() if k > 1024}
    assert sum(r.n_tokens for r in queries.p5_containers(spark, oracle.DATA).where("limit_name = 'container_small'").collect()) == sum(n.values())
