"""Token counts of a public byte-level tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where the vocabulary is if the session's spark.glossmill.tokenizer names no other file.
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the public pattern that byte-level vocabularies of this kind are made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary(spark: SparkSession) -> str:
    return spark.conf.get("spark.glossmill.tokenizer", DEFAULT_VOCABULARY)


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """The tokenizer of a ``.tiktoken`` file; read once per process."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("glossmill", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> np.ndarray:
    """The number of bytes of each token."""
    e = encoding(path)
    sizes = np.zeros(e.n_vocab, np.int64)
    for t in e.token_byte_values():
        sizes[e.encode_single_token(t)] = len(t)
    return sizes


def count_column(text: Column, path: str) -> Column:
    """Tokens of each text; null of a null text."""

    @F.arrow_udf(T.IntegerType())
    def run(a: pa.Array) -> pa.Array:
        e = encoding(path)
        return pa.array([None if t is None else len(e.encode_ordinary(t)) for t in a.to_pylist()], pa.int32())

    return run(text)
