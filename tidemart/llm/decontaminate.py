"""Benchmark decontamination by SimHash of item-sized windows.

Words are in lower case and cut at every ASCII character that is neither letter nor digit. An item of n words
is compared with every window of n words of a document: by multisets of five-word shingles (of n words, for a
shorter item), similarity being the sum of the smaller counts over the sum of the larger ones, 0.8 or more. A document
shorter than the item, but long enough to reach that, is one window as a whole.

1. A window that reaches the similarity s has at least s m of an item's m shingles. So it has one of the item's rarest
   shingles, taken until fewer than s m are left. These postings are a table; shingles of the documents are joined
   with it, after a filter of bounded size (``HashFilter``) has let through few others. This gives every text its items.
2. Of such a text, windows with too few of its items' shingles cannot reach the similarity: of m shingles,
   2 s m / (1 + s) must be shared. The others get a 64-bit SimHash: the sign, bit by bit, of the sum over shingles of
   +1 or -1.
3. Fingerprints are cut into eight blocks. If two differ in at most ``RADIUS`` = 20 bits, some block
   differs in at most two, so tables of every block value with all its neighbours at distance two
   find all items within the radius (multi-index hashing).
4. What is within the radius is verified exactly. At similarity 0.8 a bit differs with chance 0.15, so 20 of 64 are over
   three and a half deviations away for a pair right at the threshold, and more for any closer one.

Nothing is lost before step 3. Equal texts, and equal items, are looked at once. The benchmark stays a table of any size: a
task sees the items of one text, in lots of bounded size if they are many. Only texts with a posting are shuffled. Null or
empty texts and items without words match nothing. Each item is reported once per text, at its most similar window (the
first of equals); equal items under several ids are all reported, an id on several texts with the best of them. Only
``doc_id`` and ``text`` of the documents are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import cache
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import GOLDEN, WordHash, mix64, shingles, stored
from tidemart.llm.toxicity import FOLD

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 20
BLOCKS, BLOCK_BITS, NEAR = 8, 8, 2
FILTER_BITS = 26
LOT_BYTES = 2 << 20
BATCH_CHARS = 1_000_000


def split_words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(FOLD).split() if text else []


def fingerprints(signs: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """SimHash of the windows of m shingles at ``starts``; ``signs`` are running sums of the bits as +1 and -1."""
    total = signs[starts + m] - signs[starts]
    return np.packbits(total > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def running_signs(shingle: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(mix64(shingle ^ np.uint64(GOLDEN)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits.astype(np.int32) * 2 - 1, axis=0, dtype=np.int32)])


@cache
def near_values() -> np.ndarray:
    """near[a, b]: whether two block values differ in at most ``NEAR`` bits."""
    values = np.arange(1 << BLOCK_BITS)
    return np.bitwise_count(values[:, None] ^ values[None, :]) <= NEAR


class ItemIndex:
    """Fingerprints of some items by length, in tables by block."""

    def __init__(self, items: list[tuple], similarity: float = SIMILARITY):
        self.similarity = similarity
        hashed, grouped, counted = WordHash(), defaultdict(list), {}
        for item_id, text in items:
            found = np.fromiter(map(hashed.__getitem__, split_words(text)), np.uint64)
            if len(found):
                k = min(SHINGLE, len(found))
                grouped[len(found)].append((item_id, shingles(found, k)))
        self.by_size, near = {}, near_values()
        known = defaultdict(list)
        for n, group in grouped.items():
            m = len(group[0][1])
            prints = np.concatenate([fingerprints(running_signs(s), np.zeros(1, np.int64), m) for _, s in group])
            blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
            tables = [np.ascontiguousarray(near[blocks[:, b]].T) for b in range(BLOCKS)]
            self.by_size[n] = (m, prints, tables, [(i, Counter(s.tolist())) for i, s in group])
            known[min(SHINGLE, n)] += [s for _, s in group]
        self.known = {k: np.unique(np.concatenate(s)) for k, s in known.items()}

    def hits(self, shingle: np.ndarray, k: int) -> np.ndarray:
        """Which shingles are in the items."""
        values = self.known[k]
        return values[np.minimum(np.searchsorted(values, shingle), len(values) - 1)] == shingle

    def candidates(self, prints: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, item, distance) of all pairs within the radius."""
        _, own, tables, _ = self.by_size[n]
        step = max(1, 4_000_000 // len(own))
        for a in range(0, len(prints), step):
            some = prints[a : a + step]
            blocks = some.view(np.uint8).reshape(-1, BLOCKS)
            met = tables[0][blocks[:, 0]]
            for b in range(1, BLOCKS):
                met |= tables[b][blocks[:, b]]
            window, item = np.nonzero(met)
            distance = np.bitwise_count(some[window] ^ own[item])
            close = distance <= RADIUS
            yield window[close] + a, item[close], distance[close]

    def search(self, hashes: np.ndarray, shingle: dict[int, np.ndarray], hit: dict[int, np.ndarray]) -> list[dict]:
        """The best window of every item found in one document."""
        best: dict[int, tuple] = {}
        running, signs = {k: np.concatenate([[0], np.cumsum(h)]) for k, h in hit.items()}, {}
        for n, (m, _, _, items) in sorted(self.by_size.items()):
            k = min(SHINGLE, n)
            # A shorter document is one window; of two sizes, the smaller one over the larger bounds the similarity.
            size = min(m, len(shingle[k]))
            if size == 0 or size < self.similarity * m - 1e-9 or running[k][-1] == 0:
                continue
            shared = running[k][size:] - running[k][:-size]
            starts = np.flatnonzero(shared * (1 + self.similarity) >= self.similarity * (m + size) - 1e-9)
            if not len(starts):
                continue
            if k not in signs:
                signs[k] = running_signs(shingle[k])
            for windows, found, distances in self.candidates(fingerprints(signs[k], starts, size), n):
                for start, j, distance in zip(starts[windows].tolist(), found.tolist(), distances.tolist(), strict=True):
                    item_id, own = items[j]
                    theirs = Counter(shingle[k][start : start + size].tolist())
                    both = sum((own & theirs).values())
                    value = both / (m + size - both)
                    if value >= self.similarity - 1e-12 and (item_id not in best or (value, -start) > best[item_id][:2]):
                        best[item_id] = (value, -start, distance, min(n, len(hashes)))
        return [
            {"item_id": i, "start_word": -b[1], "n_words": b[3], "distance": b[2], "similarity": b[0]} for i, b in sorted(best.items())
        ]

    def search_all(self, texts: list[str | None]) -> list[list[dict]]:
        """Per text; the shingles of a batch are hashed and looked up side by side."""
        hashed, out, at = WordHash(), [], 0
        while at < len(texts):
            some, size = [], 0
            while at < len(texts) and size < BATCH_CHARS:
                some.append(split_words(texts[at]))
                size += len(texts[at] or "")
                at += 1
            lengths = np.fromiter(map(len, some), np.int64, len(some))
            flat = np.fromiter((h for words in some for h in map(hashed.__getitem__, words)), np.uint64, lengths.sum())
            ends = np.cumsum(lengths)
            every = {k: shingles(flat, k) for k in self.known}
            hit = {k: self.hits(s, k) for k, s in every.items()}
            touched = np.zeros(len(some), bool)
            for k in every:
                touched[np.searchsorted(ends, np.flatnonzero(hit[k]), side="right")] = True
            for i, (a, b) in enumerate(zip(ends - lengths, ends, strict=True)):
                if not touched[i]:
                    out.append([])
                    continue
                cut = {k: slice(a, max(a, b - k + 1)) for k in every}
                out.append(self.search(flat[a:b], {k: every[k][cut[k]] for k in every}, {k: hit[k][cut[k]] for k in every}))
        return out


def text_key(text: Column) -> Column:
    """Equal texts have equal keys; null has none."""
    return F.md5(text.cast("binary"))


POSTED = pa.schema([("item", pa.string()), ("k", pa.int32()), ("spare", pa.int64()), ("hash", pa.int64()), ("times", pa.int64())])
POSTED_DDL = "item string, k int, spare bigint, hash bigint, times bigint"


def posted(similarity: float) -> Callable:
    """Distinct shingles of each item with their counts; ``spare`` is how many of its shingles a similar window may lack."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHash()
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = np.fromiter(map(hashed.__getitem__, split_words(text)), np.uint64)
                if not len(found):
                    continue
                k = min(SHINGLE, len(found))
                every = shingles(found, k)
                values, times = np.unique(every.view(np.int64), return_counts=True)
                spare = len(every) - ceil(similarity * len(every) - 1e-9)
                columns = [[item] * len(values), [k] * len(values), [spare] * len(values), values, times]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, POSTED, strict=True)], schema=POSTED)

    return rows


def postings_of(items: DataFrame, similarity: float) -> DataFrame:
    """(item, k, hash): of each item the shingles that fewest items have, until a window without them cannot be similar."""
    every = stored(items.mapInArrow(posted(similarity), POSTED_DDL), "item-shingles")
    rarity = every.groupBy("hash").agg(F.count("*").alias("holders"))
    before = F.sum("times").over(Window.partitionBy("item").orderBy("holders", "hash")) - F.col("times")
    ranked = every.join(rarity, "hash").withColumn("before", before)
    return stored(ranked.where("before <= spare").select("item", "k", "hash"), "postings")


class HashFilter(NamedTuple):
    """Which hashes may be in a column: two bits each, by the hash's upper and its lower bits.

    There are about 256 bits a hash, but at most 2^``FILTER_BITS``; with more hashes it lets more others through.
    """

    bits: int
    words: np.ndarray

    @classmethod
    def of(cls, hashes: DataFrame) -> HashFilter:
        bits = min(FILTER_BITS, max(12, (256 * hashes.count()).bit_length()))
        (name,) = hashes.columns
        places = F.array(F.shiftrightunsigned(name, 64 - bits), F.col(name).bitwiseAND((1 << bits) - 1))
        place = hashes.select(F.explode(places).alias("place"))
        words = place.groupBy(F.shiftright("place", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("set"))
        found = words.toArrow()
        out = np.zeros(1 << (bits - 6), np.int64)
        out[found.column("word").to_numpy()] = found.column("set").to_numpy()
        return cls(bits, out)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        def hit(place: np.ndarray) -> np.ndarray:
            return (self.words[place >> 6] >> (place & 63) & 1).astype(bool)

        out = hit((hashes >> np.uint64(64 - self.bits)).astype(np.int64))
        some = np.flatnonzero(out)
        out[some] = hit((hashes[some] & np.uint64((1 << self.bits) - 1)).astype(np.int64))
        return out

    def passes(self, hashes: Column) -> Column:
        """Whether a column's hash may be there; null is not."""

        @F.arrow_udf("boolean")
        def maybe(values: pa.Array) -> pa.Array:
            return pa.array(self.has(values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)))

        return maybe(hashes)


TOUCH = pa.schema([("key", pa.string()), ("hash", pa.int64())])


def touching(ks: list[int], known: HashFilter) -> Callable:
    """The distinct shingles of each text that pass the filter."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHash()
        for batch in batches:
            keys, texts, at = batch.column("key").to_pylist(), batch.column("text").to_pylist(), 0
            while at < len(texts):
                first, lengths, flat, size = at, [], [], 0
                while at < len(texts) and size < BATCH_CHARS:
                    words = split_words(texts[at])
                    flat.extend(map(hashed.__getitem__, words))
                    lengths.append(len(words))
                    size += len(texts[at])
                    at += 1
                ends, every = np.cumsum(lengths), np.fromiter(flat, np.uint64, len(flat))
                owners, values = [], []
                for k in ks:
                    found = shingles(every, k)
                    spot = np.flatnonzero(known.has(found))
                    owner = np.searchsorted(ends, spot, side="right")
                    inside = spot + k <= ends[owner]
                    owners.append(owner[inside])
                    values.append(found[spot[inside]].view(np.int64))
                pairs = sorted(set(zip(np.concatenate(owners).tolist(), np.concatenate(values).tolist(), strict=True)))
                columns = [[keys[first + i] for i, _ in pairs], [v for _, v in pairs]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, TOUCH, strict=True)], schema=TOUCH)

    return rows


HIT = pa.schema(
    [("key", pa.string()), ("item", pa.string()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("distance", pa.int32()), ("similarity", pa.float64())]
)
HIT_DDL = "key string, item string, start_word int, n_words int, distance int, similarity double"


def searched(similarity: float) -> Callable:
    """The items of its lot that are in each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, lot in zip(*(batch.column(c) for c in ("key", "text", "lot")), strict=True):
                index = ItemIndex([(i["item"], i["text"]) for i in lot.as_py()], similarity)
                out += [{"key": key.as_py(), "item": h.pop("item_id"), **h} for h in index.search_all([text.as_py()])[0]]
            yield pa.RecordBatch.from_pylist(out, schema=HIT)

    return rows


def candidates(texts: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """(key, item) of all texts and items that have a posting in common."""
    postings = postings_of(items, similarity)
    ks = sorted(r.k for r in postings.select("k").distinct().collect())
    if not ks:
        return texts.sparkSession.createDataFrame([], "key string, item string")
    touched = texts.mapInArrow(touching(ks, HashFilter.of(postings.select("hash"))), "key string, hash bigint")
    return touched.distinct().join(postings.select("hash", "item"), "hash").select("key", "item").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(key, item_id, start_word, n_words, distance, similarity): the benchmark items in each text, named by ``text_key``."""
    named = benchmark.where("item_id is not null and text is not null").select("item_id", text_key(F.col("text")).alias("item"), "text")
    items = stored(named.groupBy("item").agg(F.min("text").alias("text")), "items")
    texts = docs.where("text <> ''").select(text_key(F.col("text")).alias("key"), "text")
    pairs = stored(candidates(texts, items, similarity), "candidates")
    sized = pairs.join(items.select("item", F.octet_length("text").alias("size")), "item")
    lots = sized.groupBy("key").agg(F.ceil(F.sum("size") / LOT_BYTES).alias("lots"))
    dealt = pairs.join(lots, "key").withColumn("part", F.pmod(F.xxhash64("item"), F.col("lots")))
    dealt = dealt.join(items, "item").groupBy("key", "part").agg(F.collect_list(F.struct("item", "text")).alias("lot"))
    keys = pairs.select(F.xxhash64("key").alias("hash")).distinct()
    met = texts.where(HashFilter.of(keys).passes(F.xxhash64("key"))).groupBy("key").agg(F.min("text").alias("text"))
    found = met.join(dealt, "key").select("key", "text", "lot").mapInArrow(searched(similarity), HIT_DDL)
    best = F.max(F.struct("similarity", (-F.col("start_word")).alias("back"), "n_words", "distance")).alias("b")
    one = found.join(named.select("item", "item_id").distinct(), "item").groupBy("key", "item_id").agg(best)
    return one.select("key", "item_id", (-F.col("b.back")).alias("start_word"), "b.n_words", "b.distance", "b.similarity")


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """op3: every pair of a document and a benchmark item that it holds."""
    found = stored(leaks(docs, benchmark), "leaks")
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    return keyed.join(found, "key").select("doc_id", *(c for c in found.columns if c != "key"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; columns stay as they are.

    Rows that a filter of the leaking texts lets through are joined with those; the others do not move.
    """
    found = stored(leaks(docs, benchmark).select(F.col("key").alias("__key")).distinct(), "leaking")
    known = HashFilter.of(found.select(F.xxhash64("__key").alias("hash")))
    keyed = docs.withColumn("__key", text_key(F.col("text")))
    keyed = keyed.withColumn("__maybe", known.passes(F.xxhash64("__key")))
    kept = keyed.where("__maybe").join(found, "__key", "left_anti").select(*docs.columns)
    return kept.union(keyed.where("not __maybe").select(*docs.columns))
