import pytest

from glossmill.llm import identity, lookalike


@pytest.fixture(scope="module")
def table(spark):
    return lookalike.lookalikes(spark)


@pytest.mark.parametrize("odd,plain", [("人ロ", "人口"), ("ニ月", "二月"), ("ハ", "八"), ("ﾛ", "口"), ("努カ", "努力"), ("ヘや", "へや"), ("ㄦ子", "儿子"), ("ㅡ个", "一个"), ("带РРТ和人ロ", "带PPT和人口")])
def test_letters_without_case(table, odd, plain):
    assert lookalike.plain_form(odd, table) == plain
    assert lookalike.plain_form(plain, table) == plain


def test_other_letters_stay(table):
    for same in ("コーヒーです", "한국어", "口囗", "שלום", "一"):
        assert lookalike.plain_form(same, table) == same


def test_sentences_with_kana_are_found(spark, table):
    texts = ["人口", "人ロ", "人囗"]
    df = spark.createDataFrame([("a", i, t, lookalike.plain_form(t, table)) for i, t in enumerate(texts)], "corpus string, rec_id bigint, raw string, form string")
    assert sorted(map(tuple, identity.lookalike_pairs(df).collect())) == [("a", 0, 1)]
