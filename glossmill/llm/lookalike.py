"""One form for text that looks the same but differs in its characters.

Invisible characters go; wide, narrow, compatibility and non-breaking forms
become their plain form, while raised, lowered, circled and styled ones, which
look different, stay; letters are composed; white space is one blank between
words and none outside.

Look-alike letters of other scripts are found per token. The script sets of
the letters (with the East Asian scripts that share Han letters) are
intersected: an empty intersection is a mixed-script token, and a token whose
letters all have look-alikes in the record's script is a whole-script
confusable. Either is spelled in the record's script if all its letters exist
there, else in the script that has most of its letters natively and
look-alikes of the rest. Look-alikes within one script (capital I and small l)
stay apart. Kana, Bopomofo and single Hangul letters are spelled in Han where
they have a Han look-alike, Katakana in Hiragana where they have one there: words
of these scripts mix them without blanks, so no token tells which was meant.

Which letters look alike comes from the skeletons of the ICU library that
Spark ships, grouped by equal skeleton and equal general category.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.operators.packed import _TOKEN, _unescape

#: Scripts that tokens resolve to.
SCRIPTS = (
    "Latin Greek Cyrillic Armenian Hebrew Arabic Devanagari Bengali Gurmukhi Gujarati Oriya Tamil Telugu Kannada Malayalam Sinhala "
    "Thai Lao Tibetan Myanmar Georgian Hangul Ethiopic Cherokee Khmer Mongolian Hiragana Katakana Bopomofo Han Coptic Lisu Glagolitic Gothic "
    "Adlam Bamum Canadian_Aboriginal Carian Caucasian_Albanian Cypriot Deseret Duployan Elbasan Lycian Lydian Miao Nko Ogham Old_Italic Old_Permic Osage "
    "Osmanya Runic Shavian Syriac Thaana Tifinagh Vai Vithkuqi Warang_Citi Yi"
).split()
#: Writing systems that mix scripts.
AUGMENTED = {"Han": {"Hanb", "Jpan", "Kore"}, "Hiragana": {"Jpan"}, "Katakana": {"Jpan"}, "Hangul": {"Kore"}, "Bopomofo": {"Hanb"}}

_DROP_TAGS = ("<super>", "<sub>", "<fraction>", "<circle>", "<square>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>", "<small>")
_IGNORABLE = regex.compile(r"\p{Default_Ignorable_Code_Point}")
_SCRIPT_TESTS = tuple((s, regex.compile(rf"\p{{Script_Extensions={s}}}")) for s in SCRIPTS)
_FIXED = re.compile(r"[!-~À-ÖØ-öø-ı²³°]++(?: [!-~À-ÖØ-öø-ı²³°]++)*+")
_FOREIGN = regex.compile(r"[^\P{L}\p{Latin}\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Hangul}]")
_EAST = regex.compile(r"[⺀-⿟ᄀ-ᇿ\u3040-\u318f\u31a0-\u31bf\u31f0-\u31ff\ua7f7]")
_WORD = regex.compile(r"(?:[^\P{L}\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}]\p{M}*+)++")


@lru_cache(maxsize=None)
def scripts(ch: str) -> frozenset[str]:
    """The scripts a letter is written in; empty for what all scripts share."""
    if regex.match(r"[\p{Script=Common}\p{Script=Inherited}]", ch):
        return frozenset()
    found = {s for s, test in _SCRIPT_TESTS if test.match(ch)}
    return frozenset(found | {a for s in found for a in AUGMENTED.get(s, ())})


class _Forms(dict):
    """Code point to plain form, filled as characters are met; for str.translate."""

    def __missing__(self, cp: int) -> str | None:
        self[cp] = out = self.form(chr(cp))
        return out

    @staticmethod
    def form(ch: str) -> str | None:
        if _IGNORABLE.match(ch):
            return None
        if ch.isspace():
            return " "
        tag = unicodedata.decomposition(ch)
        if tag.startswith("<") and not tag.startswith(_DROP_TAGS):
            return "".join(_Forms.form(c) or "" for c in unicodedata.normalize("NFKC", ch) if c != ch) or ch
        return "-" if ch == "‐" else ch


_FORMS = _Forms()

Table = dict[str, dict[str, str]]


def table_from_groups(groups: dict[tuple[str, str], list[str]]) -> Table:
    """Per script: the letter of that script for each letter of another script that looks like it."""
    out: Table = defaultdict(dict)
    for members in groups.values():
        by_script: dict[str, str] = {}
        for ch in members:
            for s in scripts(ch) & set(SCRIPTS):
                by_script.setdefault(s, ch)
        if len(by_script) > 1:
            for s, target in by_script.items():
                for ch in members:
                    if scripts(ch) and s not in scripts(ch):
                        out[s][ch] = target
    return {k: dict(v) for k, v in out.items()}


_TABLE: list[Table] = []


def lookalikes(spark: SparkSession) -> Table:
    """The look-alike letters of all of Unicode, from ICU's skeletons; without ICU an error."""
    if not _TABLE:
        chars = [c for c in map(chr, range(0x41, 0x110000)) if unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lo", "So", "Nl")]
        checker = getattr(spark._jvm.com.ibm.icu.text, "SpoofChecker$Builder")().build()
        skeletons = dict(zip(chars, checker.getSkeleton("\n".join(chars)).split("\n"), strict=True))
        groups: dict[tuple[str, str], list[str]] = defaultdict(list)
        radicals = {}
        for c, s in skeletons.items():
            if unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lo"):
                groups[s, unicodedata.category(c)].append(c)
            elif 0x2E80 <= ord(c) < 0x2FE0 and len(s) == 1 and scripts(s) & {"Han"}:
                radicals[c] = s
        table = table_from_groups({k: members for k, members in groups.items() if len(members) > 1})
        kana = {c: to for c, to in table.get("Hiragana", {}).items() if "Katakana" in scripts(c)}
        _TABLE.append(table | {"Han": kana | table.get("Han", {}) | radicals})
    return _TABLE[0]


def respell(text: str, table: Table, default: str = "Latin") -> str:
    """Tokens of mixed or foreign look-alike letters in the consistent script's spelling."""
    base = table.get(default, {})
    foreign = [c for c in text if scripts(c) and default not in scripts(c) and not scripts(c) & {"Hanb", "Jpan"}]
    if all(c in base for c in foreign):
        context = default
    else:
        context = Counter(s for c in text for s in scripts(c) if s in SCRIPTS and not scripts(c) & {"Hanb", "Jpan"}).most_common(1)[0][0]

    def token(m) -> str:
        word = m[0]
        sets = [scripts(c) for c in word if scripts(c)]
        if not sets:
            return word
        common = frozenset.intersection(*sets)
        if context in common:
            return word
        native = Counter(s for x in sets for s in x if s in SCRIPTS)
        order = [context] if common else [context, *sorted(native, key=lambda s: (-native[s], s))]
        for s in order:
            to = table.get(s, {})
            if all(not scripts(c) or s in scripts(c) or c in to for c in word):
                return "".join(c if not scripts(c) or s in scripts(c) else to[c] for c in word)
        return word

    return _WORD.sub(token, text)


def plain_form(text: str, table: Table, default: str = "Latin") -> str:
    """The one form of all texts that look like ``text``."""
    if _FIXED.fullmatch(text):
        return text
    s = unicodedata.normalize("NFC", text.translate(_FORMS))
    if _FOREIGN.search(s):
        s = unicodedata.normalize("NFC", respell(s, table, default))
    if (east := table.get("Han")) and _EAST.search(s):
        s = "".join(east.get(c, c) for c in s)
    return " ".join(s.split())


def list_literal(text: str) -> str:
    """The entries of a list literal, joined; text that is no list literal stays."""
    s = text.strip()
    if len(s) < 2 or s[0] not in "[(" or s[-1] not in "])":
        return s
    body = s[1:-1]
    if '"' not in body and "\\" not in body and body[:1] == "'" and body[-1:] == "'":
        joined = body[1:-1].replace("', '", "")
        if "'" not in joined:
            return joined
    return "".join(_unescape(a, '"') if a else _unescape(b, "'") for run, a, b in _TOKEN.findall(body) if not run)


def plain_column(spark: SparkSession, col: Column, literal: bool = False, default: str = "Latin") -> Column:
    """``plain_form`` of a string column (of its joined entries with ``literal``); null stays null."""
    table = lookalikes(spark)

    @F.arrow_udf(T.StringType())
    def run(a: pa.Array) -> pa.Array:
        if literal:
            return pa.array([None if t is None else plain_form(list_literal(t), table, default) for t in a.to_pylist()], pa.string())
        return pa.array([None if t is None else plain_form(t, table, default) for t in a.to_pylist()], pa.string())

    return run(col)


def joined_column(col: Column) -> Column:
    @F.arrow_udf(T.StringType())
    def run(a: pa.Array) -> pa.Array:
        return pa.array([None if t is None else list_literal(t) for t in a.to_pylist()], pa.string())

    return run(col)
