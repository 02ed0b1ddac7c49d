import random

import pytest
import regex

from glossmill.operators.packed import Dictionary, Lattice, learn_dictionary, segment, split_field, split_packed, strip_brackets, values_column

VALUE = regex.compile(r"[\p{L}\p{M}\p{Nd}⁰¹²³⁴⁵⁶⁷⁸⁹\-+:.()。？！]")


def plain_reading(field):
    """One character at a time, without automaton or regular expressions over tokens."""
    s = strip_brackets(field)
    out, i = [], 0
    while i < len(s):
        c = s[i]
        if c in "\"'" and not (i and VALUE.match(s[i - 1])):
            body, j = "", i + 1
            while j < len(s):
                if s[j] == "\\" and j + 1 < len(s):
                    body, j = body + s[j + 1], j + 2
                elif s[j] == c and s[j + 1 : j + 2] == c:
                    body, j = body + c, j + 2
                elif s[j] == c:
                    break
                else:
                    body, j = body + s[j], j + 1
            if j < len(s) and s[j] == c:
                out.append(body)
                i = j + 1
            else:
                i += 1
        elif VALUE.match(c):
            j = i
            while j < len(s) and VALUE.match(s[j]):
                j += 1
            out.append(s[i:j])
            i = j
        else:
            i += 1
    return [v for v in out if v.strip()]


CASES = {
    "": [],
    "   ": [],
    "[]": [],
    " , ; ": [],
    "A B": ["A", "B"],
    "['a', 'b']": ["a", "b"],
    "[n, v]": ["n", "v"],
    '("她(指)", "x")': ["她(指)", "x"],
    "(a) b (c)": ["(a)", "b", "(c)"],
    '"a"，"b"': ["a", "b"],
    'x;"，";y': ["x", "，", "y"],
    '["SO \\"LALA\\"", X]': ['SO "LALA"', "X"],
    '"say ""hi, you""" z': ['say "hi, you"', "z"],
    "\"GEHT'S\" A": ["GEHT'S", "A"],
    '|n|""|" "|d||': ["n", "d"],
    "'a, b": ["a", "b"],
    "GEHT'S WIND 'A B'": ["GEHT", "S", "WIND", "A B"],
    "3/4 m² loc-NORD WIE+IMMER cl:X 10.5 你。": ["3", "4", "m²", "loc-NORD", "WIE+IMMER", "cl:X", "10.5", "你。"],
}


@pytest.mark.parametrize("field", CASES)
def test_cases(field):
    known = Dictionary(("，", 'SO "LALA"', "GEHT'S", "hi, you")).automaton()
    assert split_field(field, known) == split_field(field) == plain_reading(field) == CASES[field]


def test_random_fields_equal_the_plain_reading():
    g = random.Random(5)
    words = ["WIND", "她(指)", "m²", "GEHT'S", "I/II", 'SO "LALA"', "，", "a b", "10.5", "", " ", "x\\y"]
    known = Dictionary([w for w in words if w.strip()]).automaton()
    for _ in range(3000):
        values = [g.choice(words) for _ in range(g.randrange(0, 8))]
        style, sep = g.choice("'\"n"), g.choice([", ", ",", "; ", "|", "/", "、", "，", "\t", " "])
        quoted = []
        for v in values:
            q = style if style != "n" else '"'
            if style == "n" and v and all(VALUE.match(c) for c in v):
                quoted.append(v)
            else:
                quoted.append(q + (v.replace("\\", "\\\\").replace(q, "\\" + q) if g.random() < 0.5 or "\\" in v else v.replace(q, q + q)) + q)
        field = g.choice(["{}", "[{}]", "({})", " {} "]).format(sep.join(quoted))
        want = [v for v in values if v.strip()]
        assert split_field(field, known) == want, field
        assert plain_reading(field) == want, field


def in_lists(fields, automaton=None):
    got = segment(fields, [automaton])
    out = [[] for _ in fields]
    for row, pos, v in zip(got.row, got.pos, got.items.to_pylist()):
        assert pos == len(out[row])
        out[row].append(v)
    return out


def test_random_characters_equal_the_plain_reading():
    g = random.Random(6)
    fields = ["".join(g.choice("ab\"',; \\()[]，\x00 ä") for _ in range(g.randrange(0, 14))) for _ in range(20_000)]
    for field, values in zip(fields, in_lists(fields)):
        assert values == plain_reading(field), field


def cheapest(s, words, unquoted):
    """The least cost of any way to read ``s``, by trying all."""
    best = {len(s): 0}
    written = {q + b + q for w in words for q in "\"'" for b in {w.replace("\\", "\\\\").replace(q, "\\" + q), w.replace(q, q + q)}} | (set(words) if unquoted else set())
    for i in range(len(s) - 1, -1, -1):
        starts = i == 0 or not VALUE.match(s[i - 1])
        hits = [(i + len(w), 9) for w in written if starts and s.startswith(w, i) and (s[i] in "\"'" or i + len(w) == len(s) or not VALUE.match(s[i + len(w)]))]
        if s[i] in "\"'":
            m = regex.compile(r'"(?:[^"\\]|\\.|"")*+"' if s[i] == '"' else r"'(?:[^'\\]|\\.|'')*+'", regex.S).match(s, i) if starts else None
            tries = [(m.end(), 10)] if m else []
            if hits or not m:
                tries.append((i + 1, 1000))
        else:
            j = i
            while j < len(s) and s[j] not in "\"'" and bool(VALUE.match(s[j])) == bool(VALUE.match(s[i])):
                j += 1
            tries = [(j, 10 if VALUE.match(s[i]) else 0)]
        tries += hits
        best[i] = min(c + best[j] for j, c in tries)
    return best[0]


@pytest.mark.parametrize("unquoted", [False, True])
def test_the_cover_is_the_cheapest(unquoted):
    g = random.Random(8)
    words = ("a/b", "b, a", "a'b", 'b"', "，", "a")
    known = Dictionary(words, unquoted)
    for _ in range(3000):
        s = strip_brackets("".join(g.choice(["a", "b", "a/b", "b, a", "'", '"', ", ", "/", "，", "\\"]) for _ in range(g.randrange(0, 9))))
        lattice = Lattice([s])
        start, end = lattice.cover(lattice.hits(known.automaton()))
        written = [s[i:j] for i, j in zip(start, end)]
        strays = sum(s.count(q) - sum(w.count(q) for w in written) for q in "\"'")
        forms = {q + b + q for w in words for q in "\"'" for b in {w.replace("\\", "\\\\").replace(q, "\\" + q), w.replace(q, q + q)}} | (set(words) if unquoted else set())
        assert 1000 * strays + sum(9 if w in forms else 10 for w in written) == cheapest(s, words, unquoted), s


def test_dictionary_decides_and_protects():
    trap = Dictionary(("，",)).automaton()
    assert split_field('"a"，"b"', trap) == ["a", "b"]
    assert split_field('"a/b"" c', Dictionary(("a/b",)).automaton()) == ["a/b", "c"] and split_field('"a/b"" c') == ["a", "b", "c"]
    free = Dictionary(("NEW YORK, NY", "NEW YORK", "，", "a b/"), unquoted=True)
    assert split_field("A, NEW YORK, NY, B; NEW YORK，x", free.automaton()) == ["A", "NEW YORK, NY", "B", "NEW YORK", "x"]
    assert split_field("ANEW YORK a b/ c a b/d", free.automaton()) == ["ANEW", "YORK", "a b/", "c", "a", "b", "d"]
    assert split_field("NEW YORK, NY B") == ["NEW", "YORK", "NY", "B"]


@pytest.mark.parametrize("shard_bytes", [8, 1 << 20])
def test_rounds_of_several_dictionaries_give_the_same(spark, shard_bytes):
    rows = [(i, "['I/II', 'K/L M', 'x, y']" if i % 3 == 0 else f"I/II; K/L M {i} x, y", None if i % 2 else "I/II") for i in range(60)]
    df = spark.createDataFrame(rows, "rec_id bigint, f string, g string").repartition(3)
    known = learn_dictionary([(df, ["f"]), (df, ["g"])], unquoted=True, shard_bytes=shard_bytes)
    assert (len(known) > 1) == (shard_bytes < 1000) and sorted(v for d in known for v in d.values) == ["I/II", "K/L M", "x, y"]
    got = {(r.field, r.rec_id, r.pos): r.item for r in split_packed(df, "rec_id", ["f", "g"], known).collect()}
    for i in range(60):
        want = ["I/II", "K/L M", "x, y"] if i % 3 == 0 else ["I/II", "K/L M", str(i), "x, y"]
        assert [got.pop(("f", i, k)) for k in range(len(want))] == want
        assert i % 2 or got.pop(("g", i, 0)) == "I/II"
    assert not got


def test_split_packed_keeps_order_and_reads_only_its_columns(spark):
    long = " ".join(f"W{i}" for i in range(50_000))
    rows = [(1, "a, 'b,c'", None, 9), (1, "a, 'b,c'", None, 9), (None, "x", "y", 9), (2, "", "  ", 9), (3, long, "q", 9)]
    df = spark.createDataFrame(rows, "rec_id bigint, f string, g string, pos int").repartition(3)
    got = split_packed(df, "rec_id", ["f", "g"], learn_dictionary([(df, ["f", "g"])]))
    assert got.dtypes == [("field", "string"), ("rec_id", "bigint"), ("pos", "int"), ("item", "string")]
    values = sorted(map(tuple, got.where("rec_id is null or rec_id < 3").collect()), key=str)
    assert values == sorted([("f", 1, 0, "a"), ("f", 1, 1, "b,c")] * 2 + [("f", None, 0, "x"), ("g", None, 0, "y")], key=str)
    assert got.where("rec_id = 3 and field = 'f'").count() == 50_000
    assert split_packed(df.limit(0), "rec_id", ["f", "g"]).count() == 0


def test_learned_dictionary_holds_quoted_values_with_separators(spark):
    df = spark.createDataFrame([("['I/II', 'A']",), ('"x, y" z',), ("plain / text",), ("",), (None,)], "f string")
    (known,) = learn_dictionary([(df, ["f"])])
    assert set(known.values) == {"I/II", "x, y"}
    assert [r[0] for r in df.select(values_column(df.f, known)).collect()] == [["I/II", "A"], ["x, y", "z"], ["plain", "text"], [], None]
    assert learn_dictionary([(df.limit(0), ["f"])])[0].values == ()
