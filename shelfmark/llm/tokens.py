"""Sizes in tokens of a public tokenizer whose rank file is a parameter; executors get its bytes, not its path."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

#: Default rank file (byte-level BPE for many languages).
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_built: dict[int, Tokenizer] = {}


class Tokenizer:
    def __init__(self, ranks: bytes) -> None:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.bytes_of = np.zeros(max(table.values()) + 1, np.int64)
        for k, v in table.items():
            self.bytes_of[v] = len(k)

    def encode(self, text: str) -> list[int]:
        try:
            return self.encoding.encode_ordinary(text)
        except UnicodeEncodeError:  # lone surrogates
            return self.encoding.encode_ordinary(text.encode("utf-16", "surrogatepass").decode("utf-16", "replace"))

    def starts(self, text: str, ids: list[int]) -> np.ndarray:
        """For each token, and the end: the number of characters that begin before it."""
        ends = np.append(0, np.cumsum(self.bytes_of[ids]))
        if text.isascii():
            return ends
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        begun = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
        return begun[np.minimum(ends, len(raw))]


def share(spark: SparkSession, vocabulary: str = VOCABULARY) -> Broadcast:
    """The rank file's bytes, under 1 MB, for the executors."""
    with open(vocabulary, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def tokenizer(shared: Broadcast) -> Tokenizer:
    """Built once per Python worker."""
    if id(shared) not in _built:
        _built.clear()
        _built[id(shared)] = Tokenizer(shared.value)
    return _built[id(shared)]


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``<key>, n_tokens`` of every row; null and empty texts have 0 tokens. Row by row, whole texts, without a shuffle."""
    shared = share(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(shared)
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([len(t.encode(x)) if x else 0 for x in b.column(1).to_pylist()], pa.int64())], names=[key, "n_tokens"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, n_tokens bigint")
