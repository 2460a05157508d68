"""Corpora as chunks of numbered words, and an exchange of hashes between chunks.

A chunk is a row with some megabytes of documents: their ids, their lengths in words, the chunk's distinct
words (most frequent first) and the word numbers of its text. The table is written to the shared folder, so the chunks are
the same for every later step and after any loss.

To ask a question about a hash over the whole corpus, a chunk sends its distinct hashes, sorted and cut by range, in
packets to buckets; a bucket sees all packets of its range and answers each with values in the order of the hashes.
A hash that is everywhere costs one entry per chunk, not one per occurrence. A chunk never sends more packets than it has
hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import LARGE_ROWS, Numbering, stored, words

CHUNK_BYTES = 4_000_000


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data) if data else b""


def pack_numbers(values: np.ndarray) -> bytes:
    """32-bit numbers, byte plane by byte plane: the upper planes of small numbers take no room."""
    return pack(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


@dataclass
class Chunk:
    name: str
    ids: list
    lengths: np.ndarray
    vocabulary: list[bytes]
    tokens: np.ndarray

    @classmethod
    def of(cls, name: str, ids: list, texts: list[list[bytes]]) -> Chunk:
        numbers = Numbering()
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.fromiter((n for text in texts for n in map(numbers.__getitem__, text)), np.int64, lengths.sum())
        order = np.argsort(-np.bincount(first, minlength=len(numbers)), kind="stable")
        rank = np.empty(len(numbers), np.int64)
        rank[order] = np.arange(len(numbers))
        found = list(numbers)
        return cls(name, ids, lengths, [found[i] for i in order.tolist()], rank[first])

    @classmethod
    def read(cls, row: dict) -> Chunk:
        vocabulary = unpack(row["vocabulary"]).split(b"\n") if row["vocabulary"] else []
        return cls(row["chunk"], row["ids"], unpack_numbers(row["lengths"]).astype(np.int64), vocabulary, unpack_numbers(row["tokens"]).astype(np.int64))

    def row(self) -> tuple:
        vocabulary = pack(b"\n".join(self.vocabulary)) if self.vocabulary else b""
        return self.name, self.ids, pack_numbers(self.lengths), vocabulary, pack_numbers(self.tokens)


def in_files(chunks: DataFrame) -> DataFrame:
    return stored(chunks, "chunks", **LARGE_ROWS)


def chunked(
    docs: DataFrame, lower: bool = False, key: str = "doc_id", text: str = "text", size: int = CHUNK_BYTES,
    *, kept: Callable[[DataFrame], DataFrame] = in_files,
) -> DataFrame:
    """Chunks (chunk, ids, lengths, vocabulary, tokens) of the documents, stored by ``kept``. Null texts have no words.

    Words stand between ASCII white space; ``lower`` puts A-Z in lower case.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [T.StructField("chunk", T.StringType()), T.StructField("ids", T.ArrayType(kind))]
        + [T.StructField(n, T.BinaryType()) for n in ("lengths", "vocabulary", "tokens")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, total, n = [], [], 0, 0
        kinds = None

        def made() -> pa.RecordBatch:
            row = Chunk.of(f"{TaskContext.get().partitionId()}-{n}", ids, texts).row()
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.string(), pa.list_(kinds), *[pa.binary()] * 3), strict=True)],
                names=schema.names,
            )

        for batch in batches:
            kinds = batch.schema.field(0).type
            for value, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                data = data.as_py()
                ids.append(value)
                texts.append(words(data.lower() if lower and data else data))
                total += len(data or b"") + 64
                if total >= size:
                    yield made()
                    ids, texts, total, n = [], [], 0, n + 1
        if ids:
            yield made()

    return kept(docs.select(key, text).mapInArrow(cut, schema))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that one chunk at a time is unpacked."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def ranges(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Cuts of sorted 64-bit hashes into ``buckets`` equal ranges."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges, side="left"), [len(sorted_hashes)]])


def with_replies(chunks: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """Add the array ``name`` of a chunk's (bucket, bits) replies. Their number is bounded by that of its packets."""
    gathered = replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))
    return chunks.join(gathered, "chunk", "left")


def in_order(replies: list[dict] | None) -> list[bytes]:
    return [r["bits"] for r in sorted(replies or [], key=lambda r: r["bucket"])]


def map_chunks(df: DataFrame, fn: Callable[[dict], Iterator[tuple]], schema: str, kinds: list[pa.DataType], at_once: int = 256) -> DataFrame:
    """Rows that ``fn`` makes from every chunk."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            some = []
            for out in fn(row):
                some.append(out)
                if len(some) >= at_once:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds, strict=True)], names=names)
                    some = []
            if some:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds, strict=True)], names=names)

    return df.mapInArrow(run, schema)
