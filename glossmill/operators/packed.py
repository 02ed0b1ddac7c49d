"""Several values packed in one field: one row per value, with its position.

A field is read from left to right. One pair of brackets around the whole
field is taken off. A quote that opens at the start of a value (not right
behind a character of one) encloses it; inside, a quote is doubled or has a
backslash before it. Outside quotes a value is a run of letters, digits, raised
digits and the marks ``- + : . ( ) 。 ？ ！``; anything else separates. Empty and
blank values take no position.

Every field is cut by a cover. A multi-pattern automaton finds the known whole
values of a dictionary in it; the edges of the field's lattice are those hits,
quoted values, plain runs, separators and stray quotes, and dynamic programming
over the positions picks the cheapest way from its start to its end. Known values
cost less than unknown ones, so a delimiter inside a known value is protected
where the value is one of several readings; separators cost nothing, and a quote
left without partner is expensive, so a known value that only seems to stand
there (the ``"，"`` between ``"a"，"b"``) loses.

The lattices of a whole batch are solved together: the texts are one array of
characters, the edges are found by array operations, and step ``r`` of the
programme relaxes the edges of the ``r``-th position of all fields at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.session import materialize

#: Fixed values of the notation.
MARKS = "-+:.()。？！"
BRACKETS = {"[": "]", "(": ")", "{": "}", "（": "）", "【": "】"}

_RUN = r"[\p{L}\p{M}\p{Nd}⁰¹²³⁴⁵⁶⁷⁸⁹" + regex.escape(MARKS) + "]"
_TOKEN = regex.compile(rf"""({_RUN}++)|(?<!{_RUN})"((?:[^"\\]|\\.|"")*+)"|(?<!{_RUN})'((?:[^'\\]|\\.|'')*+)'""", regex.S)
_EASY = regex.compile(rf"{_RUN}++")
_UNESCAPE = {q: regex.compile(rf"\\(.)|{q}{q}", regex.S) for q in "\"'"}

#: Java pattern of quoted values, for the dictionary.
_RUN_JAVA = r"[\p{L}\p{M}\p{Nd}⁰¹²³⁴⁵⁶⁷⁸⁹\-+:.()。？！]"
_QUOTED_JAVA = rf"""(?<!{_RUN_JAVA})(?:"((?:[^"\\]|\\.|"")*+)"|'((?:[^'\\]|\\.|'')*+)')"""

#: Costs of the cover.
STRAY, PIECE, KNOWN = 1000, 10, 9
#: Bytes of dictionary text that one automaton is built of; a larger dictionary is searched in several rounds.
SHARD_BYTES = 4 << 20

_SEPARATOR, _VALUE, _DOUBLE, _SINGLE = range(4)
_BLANK = 8
_UNSEEN = 255
_KINDS = np.full(0x110000, _UNSEEN, np.uint8)


def _kinds(chars: np.ndarray) -> np.ndarray:
    """The class of each character, and ``_BLANK`` for white space; classes are looked up once per character of the process."""
    for c in np.unique(chars[_KINDS[chars] == _UNSEEN]).tolist():
        ch = chr(c)
        _KINDS[c] = {'"': _DOUBLE, "'": _SINGLE}.get(ch, _VALUE if _EASY.match(ch) else _SEPARATOR) | (_BLANK if ch.isspace() else 0)
    return _KINDS[chars]


def _unescape(body: str, quote: str) -> str:
    if "\\" not in body and quote not in body:
        return body
    return _UNESCAPE[quote].sub(lambda m: m[1] if m[1] is not None else quote, body)


def strip_brackets(field: str) -> str:
    """The field without one pair of brackets that encloses all of it."""
    s = field.strip()
    close = BRACKETS.get(s[:1])
    if len(s) < 2 or close is None or s[-1] != close:
        return s
    inner, opened = s[1:-1], s[0]
    if opened not in inner and close not in inner:
        return inner
    depth, i = 0, 0
    starts = True
    while i < len(s):
        if s[i] in "\"'" and starts and (m := _TOKEN.match(s, i)):
            i = m.end()
            starts = False
            continue
        depth += (s[i] == opened) - (s[i] == close)
        if depth == 0:
            return inner if i == len(s) - 1 else s
        starts = s[i] == opened and i == 0 or not _EASY.match(s[i])
        i += 1
    return s


@dataclass
class Dictionary:
    """Known whole values; ``unquoted`` protects them outside quotes too."""

    values: Sequence[str] = ()
    unquoted: bool = False

    def automaton(self) -> ahocorasick.Automaton | None:
        """Finds the ways in which the values are written; each hit gives its length."""
        a = ahocorasick.Automaton()
        for v in self.values:
            for q in "\"'":
                for body in {v.replace("\\", "\\\\").replace(q, "\\" + q), v.replace(q, q + q)}:
                    a.add_word(q + body + q, len(body) + 2)
            if self.unquoted:
                a.add_word(v, len(v))
        if not len(a):
            return None
        a.make_automaton()
        return a


@dataclass
class Values:
    """The values of a batch of fields: the field and position of each, and the values themselves."""

    row: np.ndarray
    pos: np.ndarray
    items: pa.Array


class Lattice:
    """The positions and readings of a batch of fields as one graph whose edges lead forward."""

    def __init__(self, fields: Sequence[str]):
        self.text = "".join(chain.from_iterable((strip_brackets(s), "\x00") for s in fields))
        self.chars = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter((len(s) for s in self.text.split("\x00")), np.int64) if self.text.count("\x00") == len(fields) else None
        if sizes is None:  # a field holds the separator itself
            sizes = np.fromiter((len(strip_brackets(s)) for s in fields), np.int64, len(fields))
        self.end = np.cumsum(sizes[: len(fields)] + 1) - 1
        self.start = np.r_[0, self.end[:-1] + 1].astype(np.int64)
        kinds = _kinds(self.chars)
        self.blank = kinds & _BLANK > 0
        self.kind = kinds & 3
        self.kind[self.end] = _SEPARATOR
        self.row = np.repeat(np.arange(len(fields)), sizes[: len(fields)] + 1)

    def quoted(self) -> tuple[np.ndarray, np.ndarray]:
        """The quotes at the start of a value that have a partner, and the place behind it.

        Quotes in a row pair up as doubled ones; a row of odd length closes.
        """
        before = np.r_[_SEPARATOR, self.kind[:-1]]
        opens, ends = [], []
        for kind in (_DOUBLE, _SINGLE):
            at = np.flatnonzero(self.kind == kind)
            if not len(at):
                continue
            first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            size = np.diff(np.r_[first, len(at)])
            stop = at[first] + size
            later = np.where(size % 2 == 1, np.arange(len(first)), len(first))
            later = np.r_[np.minimum.accumulate(later[::-1])[::-1], len(first)]
            run = np.repeat(np.arange(len(first)), size)
            odd = (stop[run] - at - 1) % 2 == 1
            closes = np.where(odd, run, later[run + 1])
            end = np.r_[stop, 0][closes]
            fine = (before[at] != _VALUE) & (closes < len(first))
            fine[fine] = self.row[at[fine]] == self.row[end[fine] - 1]
            opens.append(at[fine])
            ends.append(end[fine])
        o, e = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (opens, ends))
        escapes = np.flatnonzero(self.chars == 0x5C)
        if len(escapes):  # backslashes take the quotes behind them out; these fields are read one quote at a time
            held = np.unique(self.row[escapes])
            other = ~np.isin(self.row[o], held)
            o, e = o[other], e[other]
            q = np.flatnonzero((self.kind >= _DOUBLE) & (before != _VALUE))
            read = [(i, m.end()) for i in q[np.isin(self.row[q], held)].tolist() if (m := _TOKEN.match(self.text, i, int(self.end[self.row[i]])))]
            if read:
                o, e = np.r_[o, [a for a, _ in read]], np.r_[e, [b for _, b in read]]
        return o, e

    def hits(self, automaton: ahocorasick.Automaton | None) -> tuple[np.ndarray, np.ndarray]:
        """Where known values stand as whole values: from the start of a value to the end of one, or of a quotation."""
        if automaton is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = np.fromiter(chain.from_iterable(automaton.iter(self.text)), np.int64).reshape(-1, 2)
        end = found[:, 0] + 1
        start = end - found[:, 1]
        whole = (self.row[start] == self.row[end - 1]) & (end <= self.end[self.row[start]])
        whole &= (start == 0) | (self.kind[start - 1] != _VALUE)
        whole &= (self.kind[start] >= _DOUBLE) | (self.kind[end] != _VALUE)
        return start[whole], end[whole]

    def cover(self, hits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``(start, end)`` of the values of the cheapest cover of each field, in order, quotes included."""
        n = len(self.chars)
        quote = self.kind >= _DOUBLE
        fresh = np.r_[True, (self.kind[1:] != self.kind[:-1]) | quote[1:] | quote[:-1]]
        fresh[self.start] = True
        fresh[self.end] = True
        inside = ~fresh[hits[1]]
        stops = np.r_[np.flatnonzero(fresh), n]
        until = np.repeat(stops[1:], np.diff(stops))  # the end of the run that holds a character
        fresh[hits[1][inside]] = True
        place = np.flatnonzero(fresh)
        node = np.cumsum(fresh) - 1
        is_end = np.zeros(len(place), bool)
        is_end[node[self.end]] = True

        own = place[~is_end]
        goes = until[own]
        kind = self.kind[own]
        cost = np.where(kind == _VALUE, PIECE, np.where(kind == _SEPARATOR, 0, STRAY))
        o, e = self.quoted()
        at = np.searchsorted(own, o)
        goes[at], cost[at] = e, PIECE
        tried = np.unique(hits[0][quote[hits[0]]])
        tried = tried[np.isin(tried, o)]
        a = np.r_[own, hits[0], tried]
        b = np.r_[goes, hits[1], tried + 1]
        c = np.r_[cost, np.full(len(hits[0]), KNOWN), np.full(len(tried), STRAY)].astype(np.int64)

        src, dst = node[a], node[b]
        rank = src - node[self.start][self.row[a]]
        order = np.argsort(rank.astype(np.int32), kind="stable")
        src, dst, c = src[order], dst[order], c[order]
        cuts = np.r_[0, np.cumsum(np.bincount(rank))] if len(rank) else np.zeros(1, np.int64)
        best = np.full(len(place), 1 << 62, np.int64)  # cost, then the edge that leads here
        best[node[self.start]] = 0
        number = np.arange(len(src), dtype=np.int64)
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            np.minimum.at(best, dst[lo:hi], (((best[src[lo:hi]] >> 32) + c[lo:hi]) << 32) | number[lo:hi])
        used = np.zeros(len(src), bool)
        here, home = node[self.end], node[self.start]
        while len(here):
            on = here != home
            here, home = here[on], home[on]
            edge = best[here] & 0xFFFFFFFF
            used[edge] = True
            here = src[edge]
        taken = order[used & (c > 0) & (c < STRAY)]
        taken = taken[np.argsort(a[taken], kind="stable")]
        return a[taken], b[taken]

    def values(self, spans: tuple[np.ndarray, np.ndarray]) -> Values:
        """The values of the spans without quotes and escapes; blank ones left out."""
        a, b = spans
        quoted = self.kind[a] >= _DOUBLE
        lo, hi = a + quoted, b - quoted
        mask = np.zeros(len(self.chars) + 1, np.int8)
        np.add.at(mask, lo, 1)
        np.add.at(mask, hi, -1)
        kept = np.cumsum(mask[:-1], dtype=np.int8) > 0
        special = np.r_[0, np.cumsum((self.chars == 0x5C) | (self.kind >= _DOUBLE))]
        for i in np.flatnonzero(quoted & (special[hi] > special[lo])).tolist():
            body, q = self.text[lo[i] : hi[i]], self.text[a[i]]
            for m in _UNESCAPE[q].finditer(body):
                kept[lo[i] + m.start()] = False
        full = np.r_[0, np.cumsum(kept & ~self.blank)]
        some = full[hi] > full[lo]
        for x, y in zip(lo[~some].tolist(), hi[~some].tolist()):
            kept[x:y] = False
        lo, hi = lo[some], hi[some]
        raw = np.frombuffer(self.text.encode("utf-8", "surrogatepass"), np.uint8)
        begins = np.flatnonzero((raw & 0xC0) != 0x80)
        width = np.diff(np.r_[begins, len(raw)])
        size = np.r_[0, np.cumsum(width * kept)]
        offsets = np.r_[0, np.cumsum(size[hi] - size[lo])].astype(np.int32)
        items = pa.StringArray.from_buffers(len(lo), pa.py_buffer(offsets), pa.py_buffer(raw[np.repeat(kept, width)]))
        row = self.row[lo]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        pos = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
        return Values(row, pos.astype(np.int32), items)


def segment(fields: Sequence[str | None], automata: Sequence[ahocorasick.Automaton | None] = (), found: Sequence | None = None) -> Values:
    """The values of a batch of fields. ``found`` has, for each field, hits that were found before as ``start, end`` in turn."""
    lattice = Lattice([s or "" for s in fields])
    known = [lattice.hits(a) for a in automata]
    if found is not None and any(found):
        per = np.fromiter((len(x or ()) // 2 for x in found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(x or () for x in found), np.int64).reshape(-1, 2) + np.repeat(lattice.start, per)[:, None]
        known.append((flat[:, 0], flat[:, 1]))
    hits = tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*known)) or (np.zeros(0, np.int64),) * 2
    return lattice.values(lattice.cover(hits))


def split_field(field: str, automaton: ahocorasick.Automaton | None = None) -> list[str]:
    """The values of one field, blank ones left out."""
    return segment([field], [automaton]).items.to_pylist()


def learned_values(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(v)``: the values with separators in them that stand in quotes anywhere in the fields, as they are written, once for each row."""
    raw = F.array_distinct(F.filter(F.flatten(F.array(*[F.coalesce(F.expr(f"regexp_extract_all({f}, r'{_quote_sql(_QUOTED_JAVA)}', 0)"), F.array()) for f in fields])), lambda x: ~x.rlike(rf"""^.{_RUN_JAVA}*.$""")))
    quoted = df.where(" or ".join(f"contains({f}, '\"') or contains({f}, \"'\")" for f in fields))
    return quoted.select(F.explode(raw).alias("v"))


def learn_dictionary(tables: Sequence[tuple[DataFrame, Sequence[str]]], unquoted: bool = False, shard_bytes: int = SHARD_BYTES) -> list[Dictionary]:
    """The known whole values of the fields of the tables, those of ``learned_values``, as dictionaries of at most about ``shard_bytes`` each.

    No value is left out. One dictionary, the usual case, is sent to every
    task; of several one at a time is, in rounds.
    """
    table = materialize(reduce(DataFrame.unionByName, [learned_values(df, fields) for df, fields in tables]).distinct(), "dictionary")
    size = table.agg(F.sum(F.octet_length("v"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    dealt = table.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)))
    out = []
    for i in range(shards):
        values = sorted(dict.fromkeys(v for (w,) in dealt.where(F.col("shard") == i).select("v").collect() if (v := _unescape(w[1:-1], w[0])) and not v.isspace()))
        out.append(Dictionary(tuple(values), unquoted))
    return out


def _quote_sql(pattern: str) -> str:
    return pattern.replace("'", "\\x27")


def _relative(lattice: Lattice, automaton: ahocorasick.Automaton | None) -> list[list[int]]:
    start, end = lattice.hits(automaton)
    by = np.argsort(lattice.row[start], kind="stable")
    row = lattice.row[start][by]
    flat = np.stack([start[by], end[by]], 1) - lattice.start[row][:, None]
    return [x.ravel().tolist() for x in np.split(flat, np.searchsorted(row, np.arange(1, len(lattice.start))))]


def _found_before(df: DataFrame, key: str, names: list[str], shards: Sequence[Dictionary]) -> DataFrame:
    """``df`` with the hits of all ``shards`` beside each field, one written round for each."""
    for number, shard in enumerate(shards):

        def run(batches: Iterable[pa.RecordBatch], known=shard) -> Iterator[pa.RecordBatch]:
            automaton = known.automaton()
            for batch in batches:
                columns = []
                for f in names:
                    new = _relative(Lattice([s or "" for s in batch.column(f).to_pylist()]), automaton)
                    old = batch.column(f"_{f}").to_pylist() if f"_{f}" in batch.schema.names else [[]] * len(new)
                    columns.append(pa.array([[*x, *y] for x, y in zip(old, new)], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([batch.column(key), *[batch.column(f) for f in names], *columns], names=[key, *names, *[f"_{f}" for f in names]])

        kind = df.schema[key].dataType.simpleString()
        schema = ", ".join([f"`{key}` {kind}", *[f"`{f}` string" for f in names], *[f"`_{f}` array<int>" for f in names]])
        df = materialize(df.mapInArrow(run, schema), f"hits{number}")
    return df


def split_packed(df: DataFrame, key: str, fields: Sequence[str], dictionary: Dictionary | Sequence[Dictionary] | None = None) -> DataFrame:
    """``(field, <key>, pos, item)``: each value of each field of each row.

    Null fields, empty, blank and separator-only fields give no row; a null key
    is kept as null; repeated rows give repeated values; other columns are not
    read. An unclosed quote counts as a separator unless a known value holds it.
    Fields of any length are read whole, in the task that holds the row. With
    several dictionaries the hits of each are written beside the fields first.
    """
    shards = [dictionary] if isinstance(dictionary, Dictionary) else list(dictionary or [])
    names = list(fields)
    kept = df.select(F.col(key), *[F.col(f).cast("string") for f in names])
    before = len(shards) > 1
    if before:
        kept = _found_before(kept, key, names, shards)
    one = Dictionary() if before or not shards else shards[0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = one.automaton()
        for batch in batches:
            ids = batch.column(0)
            for code in range(len(names)):
                found = batch.column(1 + len(names) + code).to_pylist() if before else None
                got = segment(batch.column(code + 1).to_pylist(), [automaton], found)
                if len(got.row):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got.row), code, np.int32)), ids.take(pa.array(got.row)), pa.array(got.pos), got.items], names=["field", "key", "pos", "item"])

    kind = df.schema[key].dataType.simpleString()
    out = kept.mapInArrow(run, f"field int, key {kind}, pos int, item string")
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("field") + 1)
    return out.select(label.alias("field"), F.col("key").alias(key), "pos", "item")


def values_column(field: Column, dictionary: Dictionary | None = None) -> Column:
    """The values of a field as an array in the row; null of null."""
    known = dictionary or Dictionary()

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(a: pa.Array) -> pa.Array:
        got = segment(a.to_pylist(), [known.automaton()])
        offsets = np.r_[0, np.cumsum(np.bincount(got.row, minlength=len(a)))].astype(np.int32)
        valid = a.is_valid().to_numpy(zero_copy_only=False)
        lists = pa.ListArray.from_arrays(pa.array(offsets, mask=np.r_[~valid, False]), got.items)
        return lists

    return run(field)
