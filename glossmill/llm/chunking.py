"""Splitting oversized texts at natural boundaries, by their content.

Rolling hashes over a window of tokens mark landmarks in a text. From each
cut, the first landmark between a least and a greatest size (the weakest hash
if there is none) is snapped to the nearest natural boundary in that range: the
end of a paragraph, line or sentence if the range has one, else white space or
a clause mark, else the last such boundary before the range, else the start of
any character in it. Landmarks and boundaries
depend on the text near them only, so an edit alters the pieces around it and
later cuts fall where they fell before.

Each piece begins with the last tokens of the piece before it, the overlap, at
the start of a character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.overlap import mix
from glossmill.llm.tokens import encoding, token_bytes

WINDOW = 12
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Marks that end a sentence or a clause, beside the ASCII ones.
_ENDS = np.array([int.from_bytes(c.encode(), "big") for c in "。！？…；"], np.int64)
_CLAUSES = np.array([int.from_bytes(c.encode(), "big") for c in "，、：；"], np.int64)


def boundaries(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The boundary class of each byte offset: 0 inside a character, 1 character, 2 word or clause, 3 sentence, line or paragraph."""
    n = len(buf)
    padded = np.r_[np.zeros(3, np.uint8), buf, np.uint8(32)].astype(np.int64)
    here, last, third, second = padded[at + 3], padded[at + 2], padded[at], padded[at + 1]
    triple = third << 16 | second << 8 | last
    blank = lambda c: np.isin(c, (32, 9, 10, 13))
    out = np.where((here & 0xC0) != 0x80, 1, 0)
    word = blank(here) | blank(last) | np.isin(triple, _CLAUSES)
    strong = np.isin(last, (10, 13)) | np.isin(triple, _ENDS) | (np.isin(last, (46, 33, 63)) & blank(here))
    out = np.where((out > 0) & word, 2, out)
    out = np.where((out > 0) & strong, 3, out)
    return np.where((at <= 0) | (at >= n), 3, out)


def landmarks(ids: np.ndarray) -> np.ndarray:
    """A hash for each position, of the tokens of the window before it."""
    t = mix(ids.astype(np.uint64) + np.uint64(1))
    padded = np.r_[np.zeros(WINDOW, np.uint64), t]
    h = np.zeros(len(ids) + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(WINDOW):
            h = h * _BASE + padded[j : j + len(ids) + 1]
    return mix(h)


def cuts(marks: np.ndarray, kinds: np.ndarray, least: int, most: int) -> list[int]:
    """Cut positions between tokens, the ends included; pieces have at most ``most`` tokens and, but for the last and those before a long stretch without boundary, at least ``least``."""
    n = len(marks) - 1
    found = [0]
    mask = np.uint64(max(1, (most - least) // 2))
    while n - found[-1] > most:
        lo, hi = found[-1] + least, found[-1] + most
        window, kind = marks[lo : hi + 1], kinds[lo : hi + 1]
        hit = np.flatnonzero(window % mask == 0)
        mark = int(hit[0]) if len(hit) else int(np.argmin(window))
        if kind.max() < 2 and len(early := np.flatnonzero(kinds[found[-1] + 1 : lo] >= 2)):
            found.append(found[-1] + 1 + int(early[-1]))
            continue
        best = np.flatnonzero(kind == kind.max())
        found.append(lo + int(best[np.argmin(np.abs(best - mark))]))
    return [*found, n]


def pieces(text: str, limit: int, overlap: int, path: str) -> list[tuple[int, int, int]]:
    """``(first byte, last byte, tokens)`` of each piece; nothing for a text within the limit.

    ``overlap`` must be less than a quarter of ``limit``.
    """
    raw = text.encode("utf-8", "replace")
    if len(raw) <= limit:
        return []
    e = encoding(path)
    ids = np.array(e.encode_ordinary(text), np.int64)
    if len(ids) <= limit:
        return []
    at = np.r_[0, np.cumsum(token_bytes(path)[ids])]
    buf = np.frombuffer(raw, np.uint8)
    kinds, marks = boundaries(buf, at), landmarks(ids)
    room = limit - overlap - 4
    ends, done = cuts(marks, kinds, room // 2, room), []
    for a, b in zip(ends, ends[1:]):
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            start = max(a - overlap, 0) if a else 0
            while kinds[start] == 0:
                start -= 1
            x, y = int(at[start]), int(at[b])
            n = len(e.encode_ordinary(raw[x:y].decode("utf-8", "replace")))
            # read alone, a piece can have more tokens than in its text; it is cut once more, its neighbours stay
            inner = kinds[a + 1 : b]
            if n <= limit or not len(inner) or not inner.max():
                done.append((x, y, n))
                continue
            best = np.flatnonzero(inner == inner.max())
            c = a + 1 + int(best[np.argmin(np.abs(best - len(inner) // 2))])
            todo += [(c, b), (a, c)]
    return done


def split_oversized(df: DataFrame, key: str, text: str, limit: int, overlap: int, path: str) -> DataFrame:
    """``(<key>, piece, first_char, n_chars, n_tokens, text)``: the pieces of each text of more than ``limit`` tokens.

    Pieces are numbered from 0 and cover the text; each but the first begins
    with at least ``overlap`` tokens of the one before (a few more where the
    token at that place starts inside a character). Null, empty and smaller
    texts give no row. A text has no more tokens than bytes, so texts of at
    most ``limit`` bytes are left out before they reach the tokenizer.
    """
    if not 0 <= overlap < limit / 4:
        raise ValueError("overlap must be less than a quarter of limit")
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("row", "piece", "first_char", "n_chars", "n_tokens", "text")}
            for i, t in enumerate(batch.column(1).to_pylist()):
                raw, done, chars = t.encode("utf-8", "replace"), 0, 0
                for k, (a, b, n) in enumerate(pieces(t, limit, overlap, path)):
                    chars += len(raw[done:a].decode()) if a >= done else -len(raw[a:done].decode())
                    done = a
                    part = raw[a:b].decode()
                    for name, v in zip(rows, (i, k, chars, len(part), n, part)):
                        rows[name].append(v)
            if rows["row"]:
                ints = [pa.array(rows[c], pa.int32()) for c in ("piece", "first_char", "n_chars", "n_tokens")]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows["row"])), *ints, pa.array(rows["text"], pa.string())], names=["key", "piece", "first_char", "n_chars", "n_tokens", "text"])

    large = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.octet_length("text") > limit)
    out = large.mapInArrow(run, f"key {kind}, piece int, first_char int, n_chars int, n_tokens int, text string")
    return out.withColumnRenamed("key", key)
