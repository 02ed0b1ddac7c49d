"""Column functions over numbers and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_OF_ZERO = -9999999999.0


def floored_log(c: Column) -> Column:
    return F.when(c == 0, F.lit(LOG_OF_ZERO)).otherwise(F.ln(c))


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    """0 where both are 0."""
    b = beta * beta
    return F.when(precision + recall == 0, F.lit(0.0)).otherwise((1 + b) * precision * recall / (b * precision + recall))


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column, eps: float = 1e-12) -> Column:
    """The vector over its length; a zero vector stays zero."""
    n = F.greatest(norm(v), F.lit(eps))
    return F.transform(as_doubles(v), lambda x: x / n)


def cosine(a: Column, b: Column) -> Column:
    """0 if either vector is zero."""
    return dot(unit(a), unit(b))


def normalize_channels(pixels: Column, mean: list[float], std: list[float], scale: float = 255.0) -> Column:
    """``(x / scale - mean) / std`` of interleaved channels."""
    k = len(mean)
    at = lambda xs, i: F.element_at(F.array(*map(F.lit, xs)), (i % k).cast("int") + 1)
    return F.transform(as_doubles(pixels), lambda x, i: (x / scale - at(mean, i)) / at(std, i))


def denormalize_channels(values: Column, mean: list[float], std: list[float], scale: float = 255.0) -> Column:
    """The inverse, held between 0 and ``scale``."""
    k = len(mean)
    at = lambda xs, i: F.element_at(F.array(*map(F.lit, xs)), (i % k).cast("int") + 1)
    return F.transform(as_doubles(values), lambda x, i: clamp((x * at(std, i) + at(mean, i)) * scale, 0.0, scale))


def rescale_points(points: Column, shift: float, scale: float) -> Column:
    """Key points moved by ``shift``, divided by ``scale`` and put between -1 and 1."""
    return F.transform(as_doubles(points), lambda x: (x + shift) / scale * 2 - 1)


def sinusoids(position: Column, width: int, base: float = 10_000.0) -> Column:
    """The position's sine and cosine values in turn, ``width`` in all."""
    angle = lambda i: position.cast("double") / F.pow(F.lit(base), (i - i % 2).cast("double") / width)
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.when(i % 2 == 0, F.sin(angle(i))).otherwise(F.cos(angle(i))))


def sinusoid_halves(position: Column, width: int, padding: int | None = None, base: float = 10_000.0) -> Column:
    """All sines, then all cosines; a last 0 of an odd ``width``; zeros for the padding position."""
    half = width // 2
    angle = lambda j: position.cast("double") * F.pow(F.lit(base), -j.cast("double") / max(half - 1, 1))
    value = lambda i: F.when(i < half, F.sin(angle(i))).when(i < 2 * half, F.cos(angle(i - half))).otherwise(0.0)
    blank = F.lit(False) if padding is None else position == padding
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.when(blank, 0.0).otherwise(value(i)))


def rotate_by_position(v: Column, position: Column, base: float = 10_000.0) -> Column:
    """Element ``i`` of the first half and its counterpart in the second turned by an angle that falls with ``i`` and grows with the position."""
    x = as_doubles(v)
    half = F.floor(F.size(v) / 2).cast("int")

    def turned(value: Column, i: Column) -> Column:
        angle = position.cast("double") * F.pow(F.lit(base), -(i % half).cast("double") / half)
        other = F.when(i < half, -F.get(x, i + half)).otherwise(F.get(x, i - half))
        return value * F.cos(angle) + other * F.sin(angle)

    return F.transform(x, turned)
