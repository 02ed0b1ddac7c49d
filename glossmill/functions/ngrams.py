"""N-gram overlaps of many hypothesis and reference sequences at once, on whole Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa


def char_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), sizes


def word_codes(*flat: pa.Array) -> np.ndarray:
    """One number per distinct word over all arrays."""
    return pa.concat_arrays([f.cast(pa.string()) for f in flat]).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number per distinct key, by hashing, and the distinct keys."""
    return pd.factorize(keys)


def overlaps(codes: np.ndarray, sizes: np.ndarray, rows: int, ref_row: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(common, hypothesis, reference)`` counts of n-grams for each row and n up to ``order``.

    The first ``rows`` sequences are the hypotheses, the others references of
    the rows ``ref_row``. Of several references the greatest count of an n-gram
    holds. An n-gram is a number made of the shorter one's and its last unit's.
    """
    seq = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    owner = np.r_[np.arange(rows), ref_row].astype(np.int64)
    one_each = len(np.unique(ref_row)) == len(ref_row)
    common, hyp, ref = (np.zeros((rows, order), np.int64) for _ in range(3))
    gram, distinct = _numbered(codes)
    units, width = gram, max(1, len(distinct))
    for n in range(1, order + 1):
        if n > 1:
            gram, distinct = _numbered(gram[:-1] * width + units[n - 1 :] if len(gram) > 1 else gram[:0])
        if not len(gram):
            break
        span = len(distinct)
        ok = left[: len(gram)] >= n
        s, g = seq[: len(gram)][ok], gram[ok]
        is_ref = s >= rows
        split = int(len(s) - is_ref.sum())  # hypotheses come first
        if one_each:
            number, keys = _numbered(owner[s] * span + g)
            of_ref = np.bincount(number[split:], minlength=len(keys))
        else:
            number, keys = _numbered(np.r_[s[:split] * span + g[:split], owner[s[split:]] * span + g[split:]])
            per, apart = _numbered(s[split:] * span + g[split:])
            counts = np.bincount(per, minlength=len(apart))
            of_ref = np.zeros(len(keys), np.int64)
            first = np.zeros(len(apart), np.int64)
            first[per] = number[split:]
            np.maximum.at(of_ref, first, counts)
        of_hyp = np.bincount(number[:split], minlength=len(keys))
        at = keys // span
        for out, x in ((common, np.minimum(of_hyp, of_ref)), (hyp, of_hyp), (ref, of_ref)):
            out[:, n - 1] = np.bincount(at, x, rows)
    return common, hyp, ref
