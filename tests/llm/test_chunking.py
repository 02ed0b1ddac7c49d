import random

import pytest

from glossmill.llm import chunking, tokens

PATH = tokens.DEFAULT_VOCABULARY
G = random.Random(3)
GERMAN = "\n\n".join(" ".join(f"Der Wind {G.randrange(999)} weht über dem {G.choice(['Moor', 'Wald', 'Tal'])}." for _ in range(G.randrange(3, 9))) for _ in range(60))
SIGNS = "今天老师在青水河屿准备了门票再去和花金桥寻找苹果"
CHINESE = "".join("".join(G.choice(SIGNS) for _ in range(G.randrange(4, 12))) + "，" + "".join(G.choice(SIGNS) for _ in range(G.randrange(4, 12))) + G.choice("。！") for _ in range(250))
UNBROKEN = "".join(G.choice("wetterkäönsß") for _ in range(6000))
TEXTS = {"german": GERMAN, "chinese": CHINESE, "unbroken": UNBROKEN, "crlf": GERMAN.replace("\n\n", "\r\n"), "blanks": " " * 5000, "emoji": "👩‍👩‍👧 ü" * 800}


def count(text):
    return len(tokens.encoding(PATH).encode_ordinary(text))


@pytest.mark.parametrize("name", TEXTS)
@pytest.mark.parametrize("limit,overlap", [(256, 32), (1024, 64), (64, 0)])
def test_pieces_cover_the_text_within_the_limit(name, limit, overlap):
    text = TEXTS[name]
    raw = text.encode()
    got = chunking.pieces(text, limit, overlap, PATH)
    if count(text) <= limit:
        assert got == []
        return
    assert len(got) > 1 and got[0][0] == 0 and got[-1][1] == len(raw)
    for a, b, n in got:
        assert raw[a:b].decode() and n == count(raw[a:b].decode()) <= limit
    for (_, end, _), (start, _, _) in zip(got, got[1:]):
        shared = raw[start:end].decode()
        assert (start == end) if overlap == 0 else overlap <= count(shared) + 2 and count(shared) <= overlap + 8


def test_cuts_stand_at_sentence_ends_where_there_are_some():
    raw = GERMAN.encode()
    for _, end, _ in chunking.pieces(GERMAN, 256, 32, PATH)[:-1]:
        assert raw[:end].decode().rstrip(" ").endswith((".", "\n"))
    zh = CHINESE.encode()
    for _, end, _ in chunking.pieces(CHINESE, 256, 32, PATH)[:-1]:
        assert zh[:end].decode()[-1] in "。！"


def test_a_long_stretch_is_cut_off_where_it_begins():
    text = "Ein kurzer Satz. " + UNBROKEN + " Und noch einer."
    ends = [text.encode()[:b].decode() for _, b, _ in chunking.pieces(text, 256, 32, PATH)]
    assert ends[0].rstrip() == "Ein kurzer Satz." and UNBROKEN + " Und" not in ends[1]


def test_an_edit_alters_only_pieces_near_it():
    at = GERMAN.index("Moor", len(GERMAN) // 2)
    changed = GERMAN[:at] + "neuen Hochmoor am See" + GERMAN[at + 4 :]
    parts = [{t.encode()[a:b].decode() for a, b, _ in chunking.pieces(t, 128, 16, PATH)} for t in (GERMAN, changed)]
    assert len(parts[0]) > 20 and len(parts[0] - parts[1]) <= 4


def test_split_oversized(spark):
    rows = [(1, GERMAN, 0), (2, "kurz", 0), (3, None, 0), (4, "", 0), (None, CHINESE, 0), (5, "a" * 300, 0), (1, GERMAN, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, piece int")
    got = chunking.split_oversized(df, "doc_id", "text", 256, 32, PATH)
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {1, None} and len(by[1]) % 2 == 0
    source = {1: GERMAN, None: CHINESE}
    for k, rs in by.items():
        for r in rs:
            assert source[k][r.first_char : r.first_char + r.n_chars] == r.text
        assert {r.piece for r in rs} == set(range(max(r.piece for r in rs) + 1))
    assert chunking.split_oversized(df.limit(0), "doc_id", "text", 256, 32, PATH).count() == 0
    with pytest.raises(ValueError):
        chunking.split_oversized(df, "doc_id", "text", 100, 50, PATH)


def test_a_piece_that_grows_alone_is_cut_without_its_neighbours(monkeypatch):
    text = " ".join(f"wort{i}." for i in range(3000))
    path = tokens.DEFAULT_VOCABULARY
    before = chunking.pieces(text, 200, 16, path)
    grown, real = set(), chunking.encoding(path)

    class Grows:
        """Counts one piece, met a second time, as too large."""

        def encode_ordinary(self, t):
            ids = real.encode_ordinary(t)
            return ids + [0] * 200 if t in grown else ids

    raw = text.encode()
    grown.add(raw[before[3][0] : before[3][1]].decode())
    monkeypatch.setattr(chunking, "encoding", lambda _: Grows())
    after = chunking.pieces(text, 200, 16, path)
    assert len(after) == len(before) + 1 and after[:3] == before[:3] and after[5:] == before[4:]
    assert after[3][0] == before[3][0] and after[4][1] == before[3][1] and all(n <= 200 for _, _, n in after)
