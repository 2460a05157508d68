"""Removal of long passages that stand more than once, found by difference-cover anchors.

A window is ``window`` words in a row. Of all positions only those of a difference cover modulo a period are
hashed: for any two positions i and j there is a shift below the period that brings both onto cover positions. So two equal
windows share an equal anchor, a shorter run of words that starts at a cover position in both. Rounds:

1. Every chunk sends its distinct anchors; buckets answer which stand more than once (a quarter of all
   positions, one bit each).
2. Around repeated anchors the match is extended to whole windows: windows holding one are hashed (128 bits) and asked in the same way.
3. Words covered by a repeated window go.

Null and empty texts have no words. A text shorter than a window keeps all of them. Equal texts, repeated
rows and passages repeated inside one text lose the passage everywhere. All other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.chunks import Chunk, chunked, in_order, map_chunks, ranges, with_replies
from tidemart.llm.common import GOLDEN, mix64, stored

WINDOW = 35
# Perfect difference sets by their period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def period_for(window: int) -> int:
    """The largest period that leaves anchors of two fifths of a window."""
    return max(v for v in COVERS if v == 1 or window - v + 1 >= 0.4 * window)


class Runs:
    """Hashes of runs of words in a chunk; runs do not cross documents."""

    def __init__(self, chunk: Chunk):
        self.ends = np.cumsum(chunk.lengths)
        self.doc = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
        self.start = (self.ends - chunk.lengths)[self.doc] if len(self.doc) else self.doc
        self.left = self.ends[self.doc] - np.arange(len(self.doc)) if len(self.doc) else self.doc
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chunk.vocabulary), np.uint64, len(chunk.vocabulary))
        self.tokens = chunk.tokens

    def of(self, starts: np.ndarray, size: int, base: int = 0) -> np.ndarray:
        """A hash of ``size`` words from each start: a difference of running sums, scaled back to position 0."""
        n, b = len(self.tokens), BASES[base]
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), b, np.uint64)]))
        word = mix64(self.hashes + np.uint64(base * GOLDEN & (1 << 64) - 1))[self.tokens]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * power[:n], dtype=np.uint64)])
        back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), pow(b, -1, 1 << 64), np.uint64)]))
        return mix64((sums[starts + size] - sums[starts]) * back[starts] + np.uint64(size))


def anchor_starts(runs: Runs, window: int) -> tuple[np.ndarray, int]:
    """Cover positions with room for an anchor, in documents that have a window; and the anchors' size."""
    period = period_for(window)
    size = window - period + 1
    inside = np.arange(len(runs.doc)) - runs.start
    covered = np.zeros(period, bool)
    covered[list(COVERS[period])] = True
    return np.flatnonzero(covered[inside % period] & (runs.left >= size) & (runs.left + inside >= window)), size


def distinct(hashes: np.ndarray, second: np.ndarray | None = None):
    """Sorted distinct hashes, whether each stands several times here, and the place of every input among them."""
    order = np.lexsort((second, hashes)) if second is not None else np.argsort(hashes, kind="stable")
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    if second is not None:
        s = second[order]
        new[1:] |= s[1:] != s[:-1]
    heads = np.flatnonzero(new)
    several = np.diff(np.append(heads, len(h))) > 1
    place = np.empty(len(h), np.int64)
    place[order] = np.cumsum(new) - 1
    return h[heads], (s[heads] if second is not None else None), several, place


def packets(name: str, hashes: np.ndarray, second: np.ndarray | None, several: np.ndarray, buckets: int) -> Iterator[tuple]:
    cuts = ranges(hashes, buckets)
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[b], cuts[b + 1])
        yield b, name, hashes[part].tobytes(), b"" if second is None else second[part].tobytes(), np.packbits(several[part]).tobytes()


PACKET = "bucket int, chunk string, hashes binary, second binary, several binary"
PACKET_KINDS = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
REPLY = "bucket int, chunk string, bits binary"


def repeated(bucket: pa.Table) -> pa.Table:
    """For every packet of a bucket, which of its hashes stand more than once in the corpus."""
    columns = {n: bucket.column(n).to_pylist() for n in ("hashes", "second", "several")}
    parts = [np.frombuffer(h, np.uint64) for h in columns["hashes"]]
    sizes = [len(p) for p in parts]
    second = np.concatenate([np.frombuffer(s, np.uint64) for s in columns["second"]])
    own = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in zip(columns["several"], sizes, strict=True)])
    _, _, several, place = distinct(np.concatenate(parts), second if len(second) else None)
    several[place[own == 1]] = True
    bits = [np.packbits(x).tobytes() for x in np.split(several[place], np.cumsum(sizes)[:-1])]
    return pa.Table.from_arrays([bucket.column("bucket").cast(pa.int32()), bucket.column("chunk"), pa.array(bits, pa.binary())], names=["bucket", "chunk", "bits"])


def unpacked(replies: list[dict] | None, cuts: np.ndarray) -> np.ndarray:
    """The answers to a chunk's hashes, in their order."""
    sizes = [n for n in np.diff(cuts).tolist() if n]
    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(in_order(replies), sizes, strict=True)]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)


def candidate_windows(runs: Runs, replies: list[dict] | None, window: int, buckets: int) -> np.ndarray:
    """Starts of the windows that hold a repeated anchor."""
    starts, size = anchor_starts(runs, window)
    hashes, _, _, place = distinct(runs.of(starts, size))
    hit = starts[unpacked(replies, ranges(hashes, buckets))[place]]
    # An anchor at p is in the windows that start at p - (window - size) .. p.
    mark = np.zeros(len(runs.doc) + 1, np.int64)
    if len(hit):
        np.add.at(mark, np.maximum(hit - (window - size), runs.start[hit]), 1)
        np.add.at(mark, hit + 1, -1)
    return np.flatnonzero((np.cumsum(mark)[:-1] > 0) & (runs.left >= window))


def without_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept): the words left of every text, joined by single spaces."""
    chunks = chunked(docs, key=key, text=text)
    buckets = max(16, chunks.count() // 4)

    def ask_anchors(row: dict) -> Iterator[tuple]:
        runs = Runs(Chunk.read(row))
        starts, size = anchor_starts(runs, window)
        hashes, _, several, _ = distinct(runs.of(starts, size))
        yield from packets(row["chunk"], hashes, None, several, buckets)

    def ask_windows(row: dict) -> Iterator[tuple]:
        runs = Runs(Chunk.read(row))
        starts = candidate_windows(runs, row["anchors"], window, buckets)
        hashes, second, several, _ = distinct(runs.of(starts, window), runs.of(starts, window, 1))
        yield from packets(row["chunk"], hashes, second, several, buckets)

    def keep(row: dict) -> Iterator[tuple]:
        chunk = Chunk.read(row)
        runs = Runs(chunk)
        starts = candidate_windows(runs, row["anchors"], window, buckets)
        hashes, _, _, place = distinct(runs.of(starts, window), runs.of(starts, window, 1))
        starts = starts[unpacked(row["windows"], ranges(hashes, buckets))[place]]
        mark = np.zeros(len(runs.doc) + 1, np.int64)
        np.add.at(mark, starts, 1)
        np.add.at(mark, starts + window, -1)
        kept = np.cumsum(mark)[:-1] == 0
        for value, n, end in zip(chunk.ids, chunk.lengths.tolist(), runs.ends.tolist(), strict=True):
            rest = chunk.tokens[end - n : end][kept[end - n : end]]
            yield value, n, n - len(rest), b" ".join(map(chunk.vocabulary.__getitem__, rest.tolist()))

    def asked(df: DataFrame, fn, name: str) -> DataFrame:
        sent = map_chunks(df, fn, PACKET, PACKET_KINDS)
        return stored(sent.groupBy("bucket").applyInArrow(repeated, REPLY), name)

    seen = with_replies(chunks, asked(chunks, ask_anchors, "anchors"), "anchors")
    seen = with_replies(seen, asked(seen, ask_windows, "windows"), "windows")
    kind = docs.schema[key].dataType
    kinds = [pa.int64() if kind.simpleString() == "bigint" else pa.string() if kind.simpleString() == "string" else pa.int32()]
    found = map_chunks(seen, keep, f"{key} {kind.simpleString()}, n_words bigint, n_removed bigint, kept binary", [*kinds, pa.int64(), pa.int64(), pa.binary()])
    return found.withColumn("kept", F.col("kept").cast("string"))


def repeat_report(docs: DataFrame) -> DataFrame:
    """op10: what is left of every document."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
