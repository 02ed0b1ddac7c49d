"""Augmentation of raw frames (height x width x 3 bytes), one random transform per clip and epoch."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Channel means and deviations.
MEAN, STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)


@dataclass(frozen=True)
class Augmentation:
    """Probabilities and ranges of the training transforms; all off is evaluation."""

    size: int = 224
    rotate: float = 0.3
    degrees: float = 5.0
    scale: tuple[float, float] = (0.875, 1.0)
    ratio: tuple[float, float] = (0.9, 1.1)
    flip: float = 0.5
    jitter: float = 0.3
    strength: float = 1.0
    gray: float = 0.2

    def evaluation(self) -> Augmentation:
        return Augmentation(self.size, 0.0, 0.0, (1.0, 1.0), (1.0, 1.0), 0.0, 0.0, 0.0, 0.0)


def sample(image: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Bilinear values at fractional positions, edges repeated."""
    h, w = image.shape[:2]
    r, c = np.clip(rows, 0, h - 1), np.clip(cols, 0, w - 1)
    r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
    r1, c1 = np.minimum(r0 + 1, h - 1), np.minimum(c0 + 1, w - 1)
    fr, fc = (r - r0)[..., None], (c - c0)[..., None]
    return (image[r0, c0] * (1 - fc) + image[r0, c1] * fc) * (1 - fr) + (image[r1, c0] * (1 - fc) + image[r1, c1] * fc) * fr


def augment(image: np.ndarray, how: Augmentation, seed: int) -> np.ndarray:
    """The transformed, resized frame, values 0 to 255. The same seed gives the same transform for any frame."""
    g = np.random.default_rng(seed)
    draws = g.random(12)
    x = image.astype(np.float64)
    h, w = x.shape[:2]
    area = h * w * (how.scale[0] + draws[0] * (how.scale[1] - how.scale[0]))
    aspect = np.exp(np.log(how.ratio[0]) + draws[1] * np.log(how.ratio[1] / how.ratio[0])) * (w / h)
    ch, cw = min(h, np.sqrt(area / aspect)), min(w, np.sqrt(area * aspect))
    top, left = draws[2] * (h - ch), draws[3] * (w - cw)
    rows, cols = np.meshgrid(top + (np.arange(how.size) + 0.5) * ch / how.size - 0.5, left + (np.arange(how.size) + 0.5) * cw / how.size - 0.5, indexing="ij")
    if draws[4] < how.rotate:
        a = np.deg2rad((2 * draws[5] - 1) * how.degrees)
        dr, dc = rows - (h - 1) / 2, cols - (w - 1) / 2
        rows, cols = (h - 1) / 2 + dr * np.cos(a) - dc * np.sin(a), (w - 1) / 2 + dr * np.sin(a) + dc * np.cos(a)
    x = sample(x, rows, cols)
    if draws[6] < how.flip:
        x = x[:, ::-1]
    gray = lambda v: (v @ np.array([0.299, 0.587, 0.114]))[..., None]
    if draws[7] < how.jitter:
        s = 0.8 * how.strength
        bright, contrast, saturation = 1 + (2 * draws[8:11] - 1) * s
        x = x * bright
        x = (x - gray(x).mean()) * contrast + gray(x).mean()
        x = (x - gray(x)) * saturation + gray(x)
    if draws[11] < how.gray:
        x = np.repeat(gray(x), 3, axis=-1)
    return np.clip(x, 0, 255)


def augmented(pixels: Column, height: Column, width: Column, clip: Column, how: Augmentation, epoch: int = 0, normalize: bool = True) -> Column:
    """Channel-last values of each frame; frames of one ``clip`` share the transform. Null, and a buffer of another length than the shape's, give null."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def run(p: pa.Array, h: pa.Array, w: pa.Array, c: pa.Array) -> pa.Array:
        out = []
        for raw, rows, cols, name in zip(p.to_pylist(), h.to_pylist(), w.to_pylist(), c.to_pylist()):
            if raw is None or not rows or not cols or len(raw) != rows * cols * 3:
                out.append(None)
                continue
            x = augment(np.frombuffer(raw, np.uint8).reshape(rows, cols, 3), how, xxhash.xxh64_intdigest(f"{name}|{epoch}"))
            out.append((((x / 255 - MEAN) / STD) if normalize else x).astype(np.float32).ravel())
        return pa.array(out, pa.list_(pa.float32()))

    return run(pixels, height, width, clip)
