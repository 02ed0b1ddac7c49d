"""Column functions over text: tokenizers, list literals, characters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Replacements before the Western tokenizer splits, in order.
ENTITIES = [("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
#: The Western tokenizer's patterns and what replaces them, in order.
WESTERN = [
    (r"([{-~\[-` -&(-+:-@/])", " $1 "),
    (r"([^0-9])([.,])", "$1 $2 "),
    (r"([.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
#: The international tokenizer's patterns, in order.
INTERNATIONAL = [(r"([^\p{Nd}])(\p{P})", "$1 $2 "), (r"(\p{P})([^\p{Nd}])", " $1 $2"), (r"(\p{S})", " $1 ")]
#: Ranges whose characters the Chinese tokenizer isolates. The two ranges from 2001 and 2F81 stand where
#: supplementary planes were meant; they are kept as they are.
ISOLATED = [
    (0x3400, 0x4DB5),
    (0x4E00, 0x9FA5),
    (0x9FA6, 0x9FBB),
    (0xF900, 0xFA2D),
    (0xFA30, 0xFA6A),
    (0xFA70, 0xFAD9),
    (0x2001, 0x2A6D),
    (0x2F81, 0x2FA1),
    (0xFF00, 0xFFEF),
    (0x2E80, 0x2EFF),
    (0x3000, 0x303F),
    (0x31C0, 0x31EF),
    (0x2F00, 0x2FDF),
    (0x2FF0, 0x2FFF),
    (0x3100, 0x312F),
    (0x31A0, 0x31BF),
    (0xFE10, 0xFE1F),
    (0xFE30, 0xFE4F),
    (0x2600, 0x26FF),
    (0x2700, 0x27BF),
    (0x3200, 0x32FF),
    (0x3300, 0x33FF),
]

SPACES = r"(?U)\s+"


def _each(c: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, to in rules:
        c = F.regexp_replace(c, pattern, to)
    return c


def squeeze(c: Column) -> Column:
    """One blank between words, none outside."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def delete_spaces(c: Column) -> Column:
    return F.regexp_replace(c, SPACES, "")


def tokenize_13a(c: Column) -> Column:
    """Western text: punctuation apart, periods and commas inside numbers kept."""
    for old, new in ENTITIES:
        c = F.replace(c, F.lit(old), F.lit(new))
    return squeeze(_each(F.concat(F.lit(" "), c, F.lit(" ")), WESTERN))


def tokenize_intl(c: Column) -> Column:
    """Unicode punctuation and symbols apart, punctuation between digits kept."""
    return F.trim(_each(c, INTERNATIONAL))


def isolated_class() -> str:
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ISOLATED) + "]"


def tokenize_zh(c: Column) -> Column:
    """Chinese text: every East Asian character apart, the rest as Western text without entities."""
    return squeeze(_each(F.regexp_replace(F.trim(c), f"({isolated_class()})", " $1 "), WESTERN))


TOKENIZERS: dict[str, Callable[[Column], Column]] = {"none": lambda c: c, "13a": tokenize_13a, "intl": tokenize_intl, "zh": tokenize_zh}


def words(c: Column) -> Column:
    """The words between white space; none of an empty text."""
    return F.filter(F.split(c, SPACES), lambda x: x != "")


def split_blanks(c: Column) -> Column:
    """Parts between single blanks, empty ones kept."""
    return F.split(c, " ", -1)


def characters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def spaced_characters(c: Column) -> Column:
    """The characters with a blank between each, for languages written without."""
    return F.array_join(characters(c), " ")


def with_suffix(c: Column, suffix: str) -> Column:
    return F.concat(c, F.lit(suffix))


def list_literal(c: Column) -> Column:
    """The entries of a list literal; null of a null or malformed one. Nothing is evaluated."""
    return F.from_json(c, "array<string>")


def joined_literal(c: Column) -> Column:
    return F.array_join(list_literal(c), "")


def segment_text(c: Column) -> Column:
    """The text of a ``<seg>`` element, squeezed; the whole line where it has none."""
    return squeeze(F.coalesce(F.nullif(F.regexp_extract(c, r"(?is)<seg[^>]*>(.*?)</seg>", 1), F.lit("")), c))


def attribute(c: Column, name: str) -> Column:
    """The value of a markup attribute, or null."""
    return F.nullif(F.regexp_extract(c, rf'\b{name}="([^"]*)"', 1), F.lit(""))


def separated_field(c: Column, field: int, separator: str = "\t") -> Column:
    return F.get(F.split(c, separator, -1), F.lit(field))


def signature(entries: dict[str, str]) -> Column:
    """``key.value`` entries in the order of their keys, joined with a plus."""
    return F.array_join(F.array_sort(F.array(*[F.lit(f"{k}.{v}") for k, v in entries.items()])), "+")


def replace_in_order(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Each old string by its new one, one pair after the other."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def inverted(m: Column) -> Column:
    """The map from value to key; of equal values the last key wins."""
    entries = F.map_entries(m)
    values = F.transform(entries, lambda e: e["value"])
    last = F.filter(F.transform(entries, lambda e, i: F.struct(e["value"].alias("k"), e["key"].alias("v"), i.alias("i"))), lambda e: ~F.array_contains(F.slice(values, e["i"] + 2, F.greatest(F.size(values), F.lit(1))), e["k"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))
