"""Scores of an n-gram model kept in Elias-Fano tries.

Tokens are the words between ASCII white space (A-Z in lower case), then one end. The model is interpolated
Witten-Bell smoothing over all training documents,

    p(w | c) = a(c w) + b(c) p(w | shorter c),   a = count(c w) / (C + T),   b = T / (C + T),

with C the occurrences of context c and T the kinds of words after it; single words have (count + 1) / (N + V + 1).
a and b are what the tries hold, one byte each.

First all words are numbered, the frequent ones low: every chunk of documents sends the hashes of its distinct words with
their counts to buckets, which add them up, put each word into a class of frequency, and answer with its place in the class and
its count. Then an n-gram belongs to the shard of its first word. Every chunk sends each shard its distinct n-grams as
numbers, with their training counts, as a nested list. The shard adds the counts up, builds its trie from n-grams that were
trained on, looks up all that were sent and answers in the same order; the chunk puts the answers together. So nothing of
the model or corpus is in one place, and what is sent grows with the corpus. Chunks are stored in buckets by their name: answers
come to them, they are not sent again.

A frequent first word is split: its n-grams are dealt over several shards by their second word, as many as its share of
all tokens asks for. Its shards know count(c w) / C only; the kinds T are added up over them, and the chunk takes both into account.
There are at most two such words for every shard, and only they are known to all tasks.

The trie blobs, and T of the split words, are returned and stored too. Null and empty texts are one end. Documents without id
are trained on. Rows that repeat are trained on as often as they stand. Words are told apart by 64 bits of hash.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.chunks import Chunk, chunked, in_order, map_chunks, pack, pack_numbers, ranges, unpack, unpack_numbers
from tidemart.llm.common import LARGE_ROWS, mix64, stored
from tidemart.llm.trie import PROBABILITY, Level, Trie
from tidemart.session import shared_dir

ORDER = 3
FOLDS, HELD = 7, 2
END = b"\n"  # no word holds a line break
CHUNKS_A_SHARD = 3
CLASSES = 64


def is_held_out(value) -> bool:
    return value is not None and zlib.crc32(str(value).encode()) % FOLDS == HELD


def pack_wide(values: np.ndarray) -> bytes:
    """64-bit numbers, byte plane by byte plane."""
    return pack(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_wide(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def spans(packed: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    """Consecutive parts of some bytes."""
    at = 0
    for size in sizes:
        yield packed[at : at + size]
        at += size


# --- numbering words ----------------------------------------------------------------------------


class Tokens:
    """A chunk's tokens, ends included, as places in its vocabulary, whose last word is the end."""

    def __init__(self, chunk: Chunk):
        self.ids, self.n = chunk.ids, chunk.lengths + 1
        self.ends = np.cumsum(self.n)
        words = [*chunk.vocabulary, END]
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        self.token = np.full(int(self.n.sum()), len(words) - 1, np.int64)
        inner = np.ones(len(self.token), bool)
        inner[self.ends - 1] = False
        self.token[inner] = chunk.tokens
        self.held_out = np.array([is_held_out(i) for i in chunk.ids], bool)
        self.trained = np.repeat(~self.held_out, self.n)

    def packets(self, name: str, buckets: int) -> Iterator[tuple]:
        """Per bucket: hashes, all counts and training counts."""
        order = np.argsort(self.hashes, kind="stable")
        every = np.bincount(self.token, minlength=len(order))[order]
        train = np.bincount(self.token[self.trained], minlength=len(order))[order]
        hashes = self.hashes[order]
        cuts = ranges(hashes, buckets)
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            part = slice(cuts[b], cuts[b + 1])
            yield b, name, hashes[part].tobytes(), pack_numbers(every[part]), pack_numbers(train[part])

    def told(self, replies: list[dict], buckets: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and training count of every word of the vocabulary."""
        order = np.argsort(self.hashes, kind="stable")
        cuts = ranges(self.hashes[order], buckets)
        numbers, counts = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        for b, data in zip(np.flatnonzero(np.diff(cuts)).tolist(), in_order(replies), strict=True):
            n = int(cuts[b + 1] - cuts[b])
            kinds, places, train = spans(np.frombuffer(unpack(data), np.uint8), [n, 8 * n, 8 * n])
            places, train = (np.ascontiguousarray(x.reshape(8, n).T).view("<i8").ravel() for x in (places, train))
            part = order[cuts[b] : cuts[b + 1]]
            numbers[part] = starts[kinds] + places * buckets + b
            counts[part] = train
        return numbers, counts


WORDS = "bucket int, chunk string, hashes binary, every binary, train binary"
WORDS_KINDS = [pa.int32(), pa.string(), *[pa.binary()] * 3]
LARGE = pa.list_(pa.struct([("class", pa.int64()), ("place", pa.int64()), ("every", pa.int64()), ("train", pa.int64())]))
# A reply has a chunk; a row without one sums its bucket up.
KNOWN = (
    "bucket int, chunk string, bits binary, classes array<bigint>, every bigint, tokens bigint, kinds bigint, "
    "large array<struct<class: bigint, place: bigint, every: bigint, train: bigint>>"
)
KNOWN_KINDS = [pa.int32(), pa.string(), pa.binary(), pa.list_(pa.int64()), *[pa.int64()] * 3, LARGE]


def known_words(shards: int):
    """Adds a bucket's words up, places each in its class, by count, and answers."""

    def count(bucket: pa.Table) -> pa.Table:
        rows = bucket.to_pylist()
        hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        unique, place = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = []
        for name in ("every", "train"):
            counts = np.concatenate([unpack_numbers(r[name]) for r in rows]).astype(np.int64)
            sums.append(np.bincount(place, counts, len(unique)).astype(np.int64))
        every, train = sums
        # Class 0 has the most frequent words; a class spans a factor of two.
        kinds = CLASSES - 1 - np.frexp(every.astype(np.float64))[1]
        order = np.lexsort((unique, -every, kinds))
        sizes = np.bincount(kinds, minlength=CLASSES)
        within = np.empty(len(unique), np.int64)
        within[order] = np.arange(len(unique)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        cuts = np.cumsum([0, *map(len, hashes)])
        out = []
        for r, a, b in zip(rows, cuts[:-1], cuts[1:], strict=True):
            at = place[a:b]
            wide = [np.ascontiguousarray(x[at].astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for x in (within, train)]
            out.append((r["bucket"], r["chunk"], pack(kinds[at].astype(np.uint8).tobytes() + b"".join(wide)), None, None, None, None, None))
        # Words that may be split: those with their share of this bucket alone, which is no more than that of all.
        large = np.flatnonzero(2 * shards * every > every.sum())
        found = [{"class": int(kinds[i]), "place": int(within[i]), "every": int(every[i]), "train": int(train[i])} for i in large.tolist()]
        summary = sizes.tolist(), int(every.sum()), int(train.sum()), int((train > 0).sum()), found
        out.append((rows[0]["bucket"], None, None, *summary))
        names = [part.split()[0].rstrip(":") for part in ("bucket", "chunk", "bits", "classes", "every", "tokens", "kinds", "large")]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), KNOWN_KINDS, strict=True)], names=names)

    return count


@dataclass
class Numbering:
    """What all tasks know of the words: where classes begin, the totals, and the split words (number, parts, train count, kinds)."""

    buckets: int
    shards: int
    starts: np.ndarray
    tokens: int
    kinds: int
    split: np.ndarray
    parts: np.ndarray
    counts: np.ndarray
    after: np.ndarray = field(default=None)

    @classmethod
    def of(cls, known: DataFrame, buckets: int, shards: int) -> Numbering:
        summary = known.where("chunk is null")
        total = summary.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("every", "tokens", "kinds")]).first()
        sizes = summary.select(F.posexplode("classes").alias("class", "n")).groupBy("class").agg(F.max("n").alias("n"))
        starts = np.zeros(CLASSES, np.int64)
        for r in sizes.collect():
            starts[r["class"]] = r["n"] * buckets
        starts = np.cumsum(starts) - starts
        large = summary.select("bucket", F.explode("large").alias("w")).select("bucket", "w.*")
        # At most 2 * shards words have such a share.
        found = large.where(F.col("every") * (2 * shards) > total[0]).collect()
        numbers = np.array([starts[r["class"]] + r["place"] * buckets + r["bucket"] for r in found], np.int64)
        every, train = (np.array([r[n] for r in found], np.int64) for n in ("every", "train"))
        order = np.argsort(numbers)
        parts = np.minimum(shards, -(-2 * shards * every // max(total[0], 1)))
        return cls(buckets, shards, starts, total[1], total[2], numbers[order], parts[order], train[order])

    def split_place(self, numbers: np.ndarray) -> np.ndarray:
        """The places of numbers among the split words, or -1."""
        if not len(self.split):
            return np.full(len(numbers), -1, np.int64)
        at = np.minimum(np.searchsorted(self.split, numbers), len(self.split) - 1)
        return np.where(self.split[at] == numbers, at, -1)

    def shard(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The shard of n-grams by their first two words."""
        start = mix64(first.astype(np.uint64))
        split = self.split_place(first)
        some = np.flatnonzero(split >= 0)
        part = mix64(mix64(second[some].astype(np.uint64)) ^ start[some]) % self.parts[split[some]].astype(np.uint64)
        # Parts follow each other, so no shard has two of them.
        out = (start % np.uint64(self.shards)).astype(np.int64)
        out[some] = (out[some] + part.astype(np.int64)) % self.shards
        return out


# --- n-grams ------------------------------------------------------------------------------------


class Grams:
    """The distinct n-grams of a chunk as nested lists, by shard.

    Level 0 has (shard, first word), level k the n-grams of k + 1 words. ``place[k]``: of each token, the number of the
    gram of level k that ends there, or -1; of level 0 ``head``, for every gram of level 1. ``parent[k]``, ``word[k]``: the gram
    above and the last word, as a place among ``numbers``. ``counts[k]``: in training documents.
    """

    def __init__(self, tokens: Tokens, numbers: np.ndarray, counts: np.ndarray, numbering: Numbering, order: int):
        by_number = np.argsort(numbers)
        rank = np.empty(len(numbers), np.int64)
        rank[by_number] = np.arange(len(numbers))
        self.numbers, self.train = numbers[by_number], counts[by_number]
        self.token = token = rank[tokens.token]
        back = np.arange(len(token)) - np.repeat(tokens.ends - tokens.n, tokens.n)
        at = np.flatnonzero(back >= 1)
        key, place = np.unique(token[at - 1] << 32 | token[at], return_inverse=True)
        first, second = key >> 32, key & 0xFFFFFFFF
        shard = numbering.shard(self.numbers[first], self.numbers[second])
        by_shard = np.argsort(shard, kind="stable")
        shard, first, second = shard[by_shard], first[by_shard], second[by_shard]
        moved = np.empty(len(key), np.int64)
        moved[by_shard] = np.arange(len(key))
        new = np.ones(len(key), bool)
        new[1:] = (shard[1:] != shard[:-1]) | (first[1:] != first[:-1])
        self.shards, shard_of_head = numbering.shards, shard[new]
        self.word, self.parent = [first[new], second], [None, np.cumsum(new) - 1]
        self.place, self.counts = [None], [None]
        self._add(at, moved[place], len(key), len(token), tokens.trained)
        for k in range(2, order):
            at = np.flatnonzero(back >= k)
            key, place = np.unique(self.place[-1][at - 1] << 32 | token[at], return_inverse=True)
            self.parent.append(key >> 32)
            self.word.append(key & 0xFFFFFFFF)
            self._add(at, place, len(key), len(token), tokens.trained)
        self.cuts = [np.searchsorted(shard_of_head, np.arange(numbering.shards + 1))]
        for parent in self.parent[1:]:
            self.cuts.append(np.searchsorted(parent, self.cuts[-1]))
        self.used = np.flatnonzero(np.diff(self.cuts[0])).tolist()
        self.split = numbering.split_place(self.numbers[self.word[0]])

    def _add(self, at: np.ndarray, place: np.ndarray, kinds: int, tokens: int, trained: np.ndarray) -> None:
        full = np.full(tokens, -1, np.int64)
        full[at] = place
        self.place.append(full)
        self.counts.append(np.bincount(place[trained[at]], minlength=kinds))

    def packets(self, name: str) -> Iterator[tuple]:
        for s in self.used:
            parts = [slice(cut[s], cut[s + 1]) for cut in self.cuts]
            words = [pack_wide(self.numbers[word[part]]) for word, part in zip(self.word, parts, strict=True)]
            heads = self.word[0][parts[0]]
            counts = [pack_wide(self.train[heads] << 1 | (self.split[parts[0]] >= 0))]
            sizes = []
            for k in range(1, len(parts)):
                above = np.arange(parts[k - 1].start, parts[k - 1].stop + 1)
                sizes.append(pack_numbers(np.diff(np.searchsorted(self.parent[k][parts[k]], above))))
                counts.append(pack_numbers(self.counts[k][parts[k]]))
            yield s, name, words, sizes, counts


PACKET = "bucket int, chunk string, words array<binary>, sizes array<binary>, counts array<binary>"
PACKET_KINDS = [pa.int32(), pa.string(), *[pa.list_(pa.binary())] * 3]
# A reply has a chunk; a row without one holds the shard's trie, and the kinds after its parts of split words.
REPLY = "bucket int, chunk string, bits binary, after array<struct<number: bigint, kinds: bigint>>"
REPLY_KINDS = [pa.int32(), pa.string(), pa.binary(), pa.list_(pa.struct([("number", pa.int64()), ("kinds", pa.int64())]))]


class Sent:
    """All packets of one shard, level by level: entries of packet after packet.

    ``counts[0]`` are the corpus's counts of the first words, twice, plus 1 for a split word.
    """

    def __init__(self, rows: list[dict]):
        self.order = len(rows[0]["words"])
        self.words, self.parent, self.counts, self.cuts = [], [None], [], []
        for k in range(self.order):
            parts = [unpack_wide(r["words"][k]) for r in rows]
            self.words.append(np.concatenate(parts))
            self.cuts.append(np.cumsum([0, *map(len, parts)]))
            read = unpack_numbers if k else unpack_wide
            self.counts.append(np.concatenate([read(r["counts"][k]) for r in rows]).astype(np.int64))
            if k:
                sizes = np.concatenate([unpack_numbers(r["sizes"][k - 1]) for r in rows]).astype(np.int64)
                self.parent.append(np.repeat(np.arange(len(sizes)), sizes))


def distinct(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in ascending order, and the place of each pair among them. However many there are, they fit."""
    span = int(word.max(initial=0)) + 1
    if (int(context.max(initial=0)) + 1) * span > 1 << 62:
        words, word = np.unique(word, return_inverse=True)
        span = len(words)
    else:
        words = None
    key, place = np.unique(context * span + word, return_inverse=True)
    rest = key % span
    return key // span, rest if words is None else words[rest], place


def build(sent: Sent) -> tuple[bytes, list[dict]]:
    """The trie of what was trained on, and the kinds of words after the split words here."""
    found, above, total, split = [], None, None, None
    for k in range(sent.order):
        context = above[sent.parent[k]] if k else np.zeros(len(sent.words[0]), np.int64)
        live = np.flatnonzero(context >= 0)
        parents, words, place = distinct(context[live], sent.words[k][live])
        if k:
            counts = np.bincount(place, sent.counts[k][live], len(words)).astype(np.int64)
        else:
            counts = np.zeros(len(words), np.int64)
            counts[place] = sent.counts[0] >> 1
            split = np.zeros(len(words), bool)
            split[place] = (sent.counts[0] & 1).astype(bool)
            split = split[counts > 0]
        kept = counts > 0
        renumbered = np.where(kept, np.cumsum(kept) - 1, -1)
        above = np.full(len(context), -1, np.int64)
        above[live] = renumbered[place]
        found.append((parents[kept], words[kept], counts[kept]))
    levels, after = [], []
    for k, (parents, words, counts) in enumerate(found):
        contexts = len(found[k - 1][1]) if k else 1
        kinds = np.bincount(parents, minlength=contexts)
        begins = np.concatenate([[0], np.cumsum(kinds)])
        chance = np.zeros(len(words))
        if k:
            # A word's occurrences as a context are those of the n-grams after it, but of a part of a split word its own count.
            sums = np.bincount(parents, counts, contexts)
            weight = np.where(sums > 0, kinds / np.maximum(sums + kinds, 1), 1.0)
            whole = sums + kinds
            if k == 1:
                whole = np.where(split, found[0][2], whole)
                after = [{"number": int(found[0][1][i]), "kinds": int(kinds[i])} for i in np.flatnonzero(split).tolist()]
            chance = counts / whole[parents]
            levels[-1].weight = weight
        levels.append(Level(words, begins, chance, np.ones(len(words))))
    return Trie.blob(levels), after


def answer(sent: Sent, trie: Trie, rows: list[dict]) -> list[bytes]:
    """Per packet: level by level coded probabilities, and weights as contexts."""
    place = [trie.find(0, np.zeros(1, np.int64), np.zeros(len(sent.words[0]), np.int64), sent.words[0])]
    codes = [(None, trie.weight(0, place[0]))]
    for k in range(1, sent.order):
        place.append(trie.find(k, place[-1], sent.parent[k], sent.words[k]))
        codes.append((trie.chance(k, place[k]), trie.weight(k, place[k]) if k < sent.order - 1 else None))
    out = []
    for i in range(len(rows)):
        parts = []
        for k, level in enumerate(codes):
            part = slice(sent.cuts[k][i], sent.cuts[k][i + 1])
            parts += [code[part].tobytes() for code in level if code is not None]
        out.append(pack(b"".join(parts)))
    return out


def learn(bucket: pa.Table) -> pa.Table:
    """Build a shard's trie, and answer its packets from it."""
    rows = bucket.to_pylist()
    sent = Sent(rows)
    blob, after = build(sent)
    out = [(rows[0]["bucket"], None, blob, after)]
    out += [(r["bucket"], r["chunk"], bits, None) for r, bits in zip(rows, answer(sent, Trie(blob), rows), strict=True)]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), REPLY_KINDS, strict=True)], names=["bucket", "chunk", "bits", "after"])


def put_together(tokens: Tokens, grams: Grams, replies: list[dict], numbering: Numbering) -> list[tuple[int, int, float, float]]:
    """(tokens, known tokens, base score, score) of every document of a chunk."""
    order = len(grams.word)
    chance = [np.zeros(len(w)) for w in grams.word]
    weight = [np.ones(len(w)) for w in grams.word]
    for s, data in zip(grams.used, in_order(replies), strict=True):
        parts = [slice(cut[s], cut[s + 1]) for cut in grams.cuts]
        n = [part.stop - part.start for part in parts]
        wanted = [(weight[0], 0)] + [pair for k in range(1, order) for pair in ((chance[k], k), (weight[k], k))][: 2 * order - 3]
        data = np.frombuffer(unpack(data), np.uint8)
        for (into, k), codes in zip(wanted, spans(data, [n[k] for _, k in wanted]), strict=True):
            into[parts[k]] = PROBABILITY[codes]
    # Split words: exact weights, and probabilities in proportion to all that follows the word.
    split = np.flatnonzero(grams.split >= 0)
    of = grams.split[split]
    seen, kinds = numbering.counts[of], numbering.after[of]
    weight[0][split] = np.where(seen > 0, kinds / np.maximum(seen + kinds, 1), 1.0)
    share = np.ones(len(weight[0]))
    share[split] = seen / np.maximum(seen + kinds, 1)
    chance[1] *= share[grams.parent[1]]
    single = (grams.train + 1) / (numbering.tokens + numbering.kinds + 1)
    p = single[grams.token]
    for k in range(1, order):
        at = np.flatnonzero(grams.place[k] >= 0)
        gram = grams.place[k][at]
        p[at] = chance[k][gram] + weight[k - 1][grams.parent[k][gram]] * p[at]
    starts = tokens.ends - tokens.n
    add = lambda x: np.add.reduceat(x, starts).tolist() if len(starts) else []
    known = (grams.train[grams.token] > 0).astype(np.int64)
    return list(zip(tokens.n.tolist(), add(known), add(np.log10(single[grams.token])), add(np.log10(p)), strict=True))


def in_buckets(chunks: DataFrame) -> DataFrame:
    """The chunks stored in buckets by name, so that joins on it leave them where they are."""
    spark, name = chunks.sparkSession, f"lm_chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = chunks.write.options(**LARGE_ROWS).bucketBy(buckets, "chunk").option("path", f"{shared_dir(spark)}/llm/{name}")
    writer.saveAsTable(name, format="parquet")
    return spark.table(name)


def with_replies(chunks: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """Add the array ``name`` of a chunk's (bucket, bits) replies."""
    gathered = replies.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))
    return chunks.join(gathered.hint("merge"), "chunk", "left")


def scores(
    docs: DataFrame, order: int = ORDER, key: str = "doc_id", text: str = "text", shards: int | None = None
) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """Scores of all documents by the model of those not held out, and that model: its tries (bucket, bits) and the
    kinds of words after split words (number, kinds)."""
    chunks = chunked(docs, lower=True, key=key, text=text, kept=in_buckets)
    shards = buckets = shards or max(16, chunks.count() // CHUNKS_A_SHARD)

    def ask_words(row: dict) -> Iterator[tuple]:
        yield from Tokens(Chunk.read(row)).packets(row["chunk"], buckets)

    sent = map_chunks(chunks, ask_words, WORDS, WORDS_KINDS, at_once=32)
    known = stored(sent.groupBy("bucket").applyInArrow(known_words(shards), KNOWN), "words", **LARGE_ROWS)
    numbering = Numbering.of(known, buckets, shards)
    told = with_replies(chunks, known, "told")

    def ask(row: dict) -> Iterator[tuple]:
        tokens = Tokens(Chunk.read(row))
        numbers, counts = tokens.told(row["told"], buckets, numbering.starts)
        yield from Grams(tokens, numbers, counts, numbering, order).packets(row["chunk"])

    sent = map_chunks(told, ask, PACKET, PACKET_KINDS, at_once=32)
    learned = stored(sent.groupBy("bucket").applyInArrow(learn, REPLY), "tries", **LARGE_ROWS)
    split = learned.where("chunk is null").select(F.explode("after").alias("w")).groupBy("w.number").agg(F.sum("w.kinds").alias("kinds"))
    after = dict(map(tuple, split.collect()))
    numbering.after = np.array([after.get(n, 0) for n in numbering.split.tolist()], np.int64)

    def score(row: dict) -> Iterator[tuple]:
        tokens = Tokens(Chunk.read(row))
        numbers, counts = tokens.told(row["told"], buckets, numbering.starts)
        found = put_together(tokens, Grams(tokens, numbers, counts, numbering, order), row["replies"], numbering)
        for value, held, rest in zip(tokens.ids, tokens.held_out.tolist(), found, strict=True):
            yield value, held, *rest

    asked = with_replies(told, learned, "replies")
    kind = docs.schema[key].dataType.simpleString()
    kinds_of = [{"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind], pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    found = map_chunks(
        asked, score, f"{key} {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double", kinds_of, at_once=4096
    )
    model = learned.where("chunk is null").select("bucket", "bits"), split
    return found.withColumn("train_tokens", F.lit(numbering.tokens).cast("long")), model


def score_report(docs: DataFrame) -> DataFrame:
    """op9: base score and model score of every document."""
    found, _ = scores(docs)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
