"""Tokens of two tokenizers over the same text, aligned by their bytes.

A text is encoded with a space in front, by a byte-level BPE (A) and by a piece model (B). Places where tokens of both end cut the
bytes into groups; within a group, an A token and a B token whose bytes overlap are linked.

Fragments are what is known of a range of bytes: the A tokens and the B tokens that begin in it, and the marks, places
where both are known to end. What comes before the first mark is the open prefix, since its group may begin
further left; groups between marks are closed; what comes after the last mark is the open suffix. Two neighbours compose
by looking for marks in the left one's suffix and the right one's prefix only. That is associative, and a range
without tokens is its identity, so fragments may be reduced in any tree.

A text of more than ``LONG`` bytes is cut into ranges of ``RANGE`` bytes, which become rows of their own that Spark spreads. Each
tokenizer is cut at the first place from there on where its encoding cannot change: for A before a space between
letters or digits, for B before a space after another character. So a range's A and B tokens begin and end at
places of their own. Rounds of grouping by ``FAN`` neighbours reduce the fragments of a text to one.

Finished texts leave as chunks of a few megabytes, stored: counts and digests per text, the chunk's distinct id pairs
with their links, and each link's pair. Pair counts over the corpus are a sum over chunks. They go back to
a chunk once per distinct pair, so a pair that is everywhere costs one row a chunk. A chunk meets its answers by itself: no
task holds several.

Texts that are null or empty, or where a tokenizer does not give the bytes back, have no tokens. Rows are independent: repeated and
null ids count as often as they stand.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Generator, Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.chunks import pack_numbers, rows_of, unpack_numbers
from tidemart.llm.common import LARGE_ROWS, stored

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LONG = 64 << 10
RANGE = 32 << 10
FAN = 8
CHUNK_BYTES = 2_000_000
PIECE_BITS = 24
HASHED_AT_ONCE = 1 << 20

# Fixed value: the pattern by which byte-level BPE cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that are letters, digits or spaces in some versions of Unicode only may lie outside these ranges.
SETTLED = re.compile("[^\x00-\u052f\u2000-\u206f\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]")
# Where an encoding cannot change by a cut in front of the space.
CUT_A = re.compile(r"(?<=[^\W_]) (?=[^\W_])")
CUT_B = re.compile(rf"(?<=[^ {MARK}]) (?=[\s\S])")


def byte_alphabet() -> dict[str, int]:
    """The character a byte-level vocabulary writes for each byte: itself where it is visible, else one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteEncoder:
    """Byte-level BPE from a tokenizer file.

    Where the file has one merge for every further id, in the order of the ids, merging by rank gives the same ids
    and is faster; texts with characters outside ``SETTLED`` still go through the file's own library, which is
    loaded at the first such text.
    """

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as source:
            spec = json.load(source)
        self.file = file
        special = {t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in entry): i for entry, i in spec["model"]["vocab"].items() if i not in special}
        self.bytes_of = [b""] * (max([*ranks.values(), *special]) + 1)
        for entry, i in ranks.items():
            self.bytes_of[i] = entry
        self.sizes = np.fromiter(map(len, self.bytes_of), np.int64, len(self.bytes_of))
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        in_order = [spec["model"]["vocab"][m] for m in merges] == list(range(256, 256 + len(merges)))
        by_words = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.ranked = None
        if in_order and by_words and spec["normalizer"] is None:
            from tiktoken import Encoding

            self.ranked = Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.file)
        made.encode_special_tokens = True
        return made

    def encode(self, text: str) -> np.ndarray:
        if self.ranked and not SETTLED.search(text):
            return np.array(self.ranked.encode_ordinary(text), np.int64)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)


class PieceEncoder:
    """A piece model that puts a space in front of a text."""

    def __init__(self, file: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.sizes = np.fromiter(map(len, self.bytes_of), np.int64, len(pieces))

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int64)


@cache
def encoders(byte_file: str, piece_file: str) -> tuple[ByteEncoder, PieceEncoder]:
    return ByteEncoder(byte_file), PieceEncoder(piece_file)


def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What two ascending arrays share."""
    if not len(x) or not len(y):
        return x[:0]
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return x[y[at] == x]


@dataclass
class Fragment:
    """Tokens and their ends, counted in bytes from the start of the text; ``whole``: they give back the bytes they stand for."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray
    marks: np.ndarray
    whole: bool = True

    @classmethod
    def nothing(cls) -> Fragment:
        return cls(*[np.zeros(0, np.int64)] * 5)

    @classmethod
    def of(cls, a_text: str, a_start: int, b_text: str, b_start: int, byte: ByteEncoder, piece: PieceEncoder) -> Fragment:
        """Of the A tokens of one stretch and the B tokens of another, both of the text with its space in front."""
        a, b = byte.encode(a_text), piece.encode(b_text[1:]) if b_text else np.zeros(0, np.int64)
        whole = all(
            b"".join(map(coder.bytes_of.__getitem__, ids.tolist())) == text.encode() for coder, ids, text in ((byte, a, a_text), (piece, b, b_text))
        )
        a_ends, b_ends = a_start + np.cumsum(byte.sizes[a]), b_start + np.cumsum(piece.sizes[b])
        return cls(a, a_ends, b, b_ends, common(a_ends, b_ends), whole)

    def compose(self, right: Fragment) -> Fragment:
        def opened(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
            suffix = mine[np.searchsorted(mine, self.marks[-1], "right") :] if len(self.marks) else mine
            prefix = other[: np.searchsorted(other, right.marks[0])] if len(right.marks) else other
            return np.concatenate([suffix, prefix])

        new = common(opened(self.a_ends, right.a_ends), opened(self.b_ends, right.b_ends))
        joined = [np.concatenate(p) for p in ((self.a, right.a), (self.a_ends, right.a_ends), (self.b, right.b), (self.b_ends, right.b_ends))]
        return Fragment(*joined, np.concatenate([self.marks, new, right.marks]), self.whole and right.whole)

    def row(self) -> tuple:
        return *[pack_numbers(x) for x in (self.a, self.a_ends, self.b, self.b_ends, self.marks)], self.whole

    @classmethod
    def read(cls, values: list) -> Fragment:
        return cls(*[unpack_numbers(v).astype(np.int64) for v in values[:5]], values[5])


def reduced(fragments: list[Fragment]) -> Fragment:
    """Neighbours composed in pairs, level by level."""
    while len(fragments) > 1:
        pairs = [fragments[i : i + 2] for i in range(0, len(fragments), 2)]
        fragments = [p[0].compose(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return fragments[0] if fragments else Fragment.nothing()


def cuts(text: str, at: re.Pattern, size: int) -> list[int]:
    """Where the ranges of ``size`` characters begin, moved on to places where the text may be cut, and the end."""
    out = [0]
    for target in range(size, len(text), size):
        found = at.search(text, max(target, out[-1])) if out[-1] < len(text) else None
        out.append(found.start() if found else len(text))
    return [*out, len(text)]


FRAGMENT = "a binary, a_ends binary, b binary, b_ends binary, marks binary, whole boolean"
FRAGMENT_NAMES = ["a", "a_ends", "b", "b_ends", "marks", "whole"]


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def arrow_schema(**kinds) -> pa.Schema:
    return pa.schema(list(kinds.items()))


FRAGMENT_KINDS = dict.fromkeys(FRAGMENT_NAMES[:5], pa.binary()) | {"whole": pa.bool_()}


def long_fragments(docs: DataFrame, byte_file: str, piece_file: str, size: int = RANGE, fan: int = FAN) -> DataFrame:
    """One fragment (id, fragment) for every row (id, text) of long texts, reduced over tasks."""
    kind = docs.schema["id"].dataType
    ranged = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("id", kind), T.StructField("place", T.LongType())]
        + [T.StructField(n, t) for n, t in (("a_start", T.LongType()), ("a_text", T.StringType()), ("b_start", T.LongType()), ("b_text", T.StringType()))]
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = {"row": pa.int64(), "id": batch.schema.field(1).type, "place": pa.int64()}
            kinds |= {"a_start": pa.int64(), "a_text": pa.string(), "b_start": pa.int64(), "b_text": pa.string()}
            for row in rows_of([batch]):
                text = " " + row["text"]
                a, b = (cuts(text, at, size) for at in (CUT_A, CUT_B))
                out, starts = [], [0, 0]
                for place in range(len(a) - 1):
                    parts = [text[c[place] : c[place + 1]] for c in (a, b)]
                    out.append((row["row"], row["id"], place, starts[0], parts[0], starts[1], parts[1]))
                    starts = [s + len(p.encode()) for s, p in zip(starts, parts, strict=True)]
                yield batch_of(out, arrow_schema(**kinds))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = encoders(byte_file, piece_file)
        for batch in batches:
            kinds = {"row": pa.int64(), "id": batch.schema.field(1).type, "place": pa.int64(), **FRAGMENT_KINDS}
            for r in rows_of([batch]):
                made = Fragment.of(r["a_text"], r["a_start"], r["b_text"], r["b_start"], *coders)
                yield batch_of([(r["row"], r["id"], r["place"], *made.row())], arrow_schema(**kinds))

    def compose(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["place"])
        made = reduced([Fragment.read([r[n] for n in FRAGMENT_NAMES]) for r in rows])
        kinds = {"row": pa.int64(), "id": group.schema.field("id").type, "place": pa.int64(), **FRAGMENT_KINDS}
        return pa.Table.from_batches([batch_of([(rows[0]["row"], rows[0]["id"], rows[0]["place"] // fan, *made.row())], arrow_schema(**kinds))])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    ranges = stored(rows.mapInArrow(spread, ranged), "ranges")
    schema = f"row bigint, id {kind.simpleString()}, place bigint, {FRAGMENT}"
    found = stored(ranges.repartition("row", "place").mapInArrow(encode, schema), "fragments", **LARGE_ROWS)
    most = (ranges.agg(F.max("place")).first()[0] or 0) + 1
    while most > 1:
        found = found.groupBy("row", F.floor(F.col("place") / fan).alias("next")).applyInArrow(compose, schema)
        most = -(-most // fan)
    return found.select("id", *FRAGMENT_NAMES)


class Chunk:
    """Finished texts, up to some megabytes, and their links."""

    def __init__(self, byte: ByteEncoder, piece: PieceEncoder):
        self.base = 2 * len(byte.bytes_of)
        self.written = [f"{i}{end}" for i in range(len(byte.bytes_of)) for end in ",|"] + [f"{i}{end}" for i in range(len(piece.bytes_of)) for end in ",;"]
        self.clear()

    def clear(self) -> None:
        self.ids, self.fragments, self.size = [], [], 0

    def add(self, value, fragment: Fragment) -> None:
        fragment = fragment if fragment.whole else Fragment.nothing()
        self.ids.append(value)
        self.fragments.append(fragment)
        self.size += 64 + (int(fragment.marks[-1]) if len(fragment.marks) else 0)

    def digest(self, codes: np.ndarray) -> str:
        if not len(codes):
            return ""
        found = hashlib.sha256()
        for at in range(0, len(codes), HASHED_AT_ONCE):
            written = "".join(map(self.written.__getitem__, codes[at : at + HASHED_AT_ONCE].tolist()))
            found.update((written if at + HASHED_AT_ONCE < len(codes) else written[:-1]).encode())
        return found.hexdigest()

    def column(self, name: str, kind: type, before: np.ndarray | None = None) -> np.ndarray:
        """One array of all fragments, moved by ``before`` each, which the fragments then let go of."""
        found = [getattr(f, name) for f in self.fragments]
        out, at = np.empty(sum(map(len, found)), kind), 0
        for i, values in enumerate(found):
            np.add(values, 0 if before is None else before[i], out=out[at : at + len(values)], casting="unsafe")
            at += len(values)
        for f in self.fragments:
            setattr(f, name, None)
        return out

    def row(self, name: int) -> tuple:
        """The chunk as a row. Its fragments are gone then: tokens and links are held once, in numbers no wider than they need."""
        parts = self.fragments
        n_a, n_b, n_groups = (np.fromiter((len(x) for x in xs), np.int64, len(parts)) for xs in ([f.a for f in parts], [f.b for f in parts], [f.marks for f in parts]))
        sizes = np.fromiter((f.marks[-1] if len(f.marks) else 0 for f in parts), np.int64, len(parts))
        before = np.cumsum(sizes) - sizes
        kind = np.int32 if sizes.sum() < 1 << 31 else np.int64
        a, b = (self.column(x, np.int32) for x in ("a", "b"))
        a_ends, b_ends, marks = (self.column(x, kind, before) for x in ("a_ends", "b_ends", "marks"))
        digests = self.digests(a, b, np.searchsorted(a_ends, marks) + 1, np.searchsorted(b_ends, marks) + 1, n_a + n_b)
        del marks
        # A link is a stretch of bytes between ends of any kind.
        ends = np.concatenate([a_ends, b_ends])
        ends.sort(kind="stable")
        ends = ends[np.concatenate([ends[1:] != ends[:-1], [True]])] if len(ends) else ends
        pair = a[np.searchsorted(a_ends, ends)].astype(np.int64)
        del a, a_ends
        pair <<= PIECE_BITS
        pair |= b[np.searchsorted(b_ends, ends)]
        del b, b_ends, ends
        pairs, links, counts = np.unique(pair, return_inverse=True, return_counts=True)
        del pair
        by_count = np.argsort(-counts, kind="stable")
        rank = np.empty(len(pairs), np.int32)
        rank[by_count] = np.arange(len(pairs))
        packed = [pack_numbers(x) for x in (n_a, n_b, n_groups, rank[links])]
        return name, self.ids, *packed, digests, pairs[by_count], counts[by_count]

    def digests(self, a: np.ndarray, b: np.ndarray, a_to: np.ndarray, b_to: np.ndarray, lengths: np.ndarray) -> list[str]:
        """Of every text, its tokens written in order: a group's A tokens, then its B tokens."""
        codes = np.empty(len(a) + len(b), np.int32)
        for mine, to, others, first in ((a, a_to, np.concatenate([[0], b_to[:-1]]), 0), (b, b_to, a_to, self.base)):
            written = first + 2 * mine
            written[to - 1] += 1
            at = np.repeat(others[: len(to)], np.diff(to, prepend=0))
            at += np.arange(len(mine))
            codes[at] = written
            del at
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return [self.digest(codes[s:e]) for s, e in zip(starts[:-1], starts[1:], strict=True)]


# A reader holds a row group's links at once, and twice that as they grow.
CHUNK_ROWS = LARGE_ROWS | {"parquet.block.size": str(8 << 20)}
CHUNK_NAMES = ["chunk", "ids", "n_a", "n_b", "n_groups", "links", "digests", "pairs", "counts"]


def chunk_kinds(kind: pa.DataType) -> pa.Schema:
    return pa.schema(list(zip(CHUNK_NAMES, (pa.int64(), pa.list_(kind), *[pa.binary()] * 4, pa.list_(pa.string()), *[pa.list_(pa.int64())] * 2), strict=True)))


def aligned_chunks(docs: DataFrame, byte_file: str, piece_file: str, long: int = LONG, size: int = RANGE) -> DataFrame:
    """Chunks of the aligned texts of all rows (id, text), stored."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"chunk bigint, ids array<{kind}>, n_a binary, n_b binary, n_groups binary, links binary, digests array<string>, pairs array<bigint>, counts array<bigint>"

    def chunks(fragments, kind: pa.DataType, sign: int, n: int) -> Generator[pa.RecordBatch, None, int]:
        """Chunks numbered from ``n`` on within the task; returns the next number."""
        chunk = Chunk(*encoders(byte_file, piece_file))
        for value, fragment in fragments:
            chunk.add(value, fragment)
            if chunk.size >= CHUNK_BYTES:
                n += 1
                yield batch_of([chunk.row(sign * ((TaskContext.get().partitionId() << 32) + n))], chunk_kinds(kind))
                chunk.clear()
        if chunk.ids:
            n += 1
            yield batch_of([chunk.row(sign * ((TaskContext.get().partitionId() << 32) + n))], chunk_kinds(kind))
        return n

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, n = encoders(byte_file, piece_file), 0
        for batch in batches:
            # One text at a time leaves Arrow.
            texts = ((i.as_py(), t.as_py()) for i, t in zip(*batch.columns, strict=True))
            made = ((i, Fragment.of(" " + t, 0, " " + t, 0, *coders) if t else Fragment.nothing()) for i, t in texts)
            n = yield from chunks(made, batch.schema.field(0).type, 1, n)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            made = ((r["id"], Fragment.read([r[n] for n in FRAGMENT_NAMES])) for r in rows_of([batch]))
            n = yield from chunks(made, batch.schema.field(0).type, -1, n)

    is_long = F.coalesce(F.octet_length("text") > long, F.lit(False))
    parts = long_fragments(docs.where(is_long), byte_file, piece_file, size)
    return stored(docs.where(~is_long).mapInArrow(short, schema).union(parts.mapInArrow(finished, schema)), "aligned", **CHUNK_ROWS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """Every id pair's links over the corpus, and whether they are the most that its B id has: (pair, links, best)."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
    counted = stored(each.agg(F.sum("x.counts").alias("links")), "pairs")
    piece = F.col("pair").bitwiseAND((1 << PIECE_BITS) - 1).alias("piece")
    most = counted.groupBy(piece).agg(F.max("links").alias("most"))
    return counted.withColumn("piece", piece).join(most, "piece").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def alignments(
    docs: DataFrame, key: str = "doc_id", text: str = "text", byte_file: str = BYTE_MODEL, piece_file: str = PIECE_MODEL, long: int = LONG, size: int = RANGE
) -> tuple[DataFrame, DataFrame]:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row, and the corpus's pair counts."""
    chunks = aligned_chunks(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), byte_file, piece_file, long, size)
    rated = stored(pair_counts(chunks), "rated")
    asked = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(rated, "pair").select(F.col("chunk").alias("asker"), "place", "links", "best")
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def report(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        column = {n: chunk.column(n)[0] for n in chunk.column_names}
        n_a, n_b, n_groups, links = (unpack_numbers(column[n].as_py()).astype(np.int64) for n in ("n_a", "n_b", "n_groups", "links"))
        n_links = n_a + n_b - n_groups
        most, is_best = np.zeros(len(links) + 1, np.int64), np.zeros(len(links) + 1, np.int64)
        place, most_links, best = (answers.column(n).to_numpy() for n in ("place", "links", "best"))
        most[place], is_best[place] = most_links, best
        ends = np.cumsum(n_links)
        sums = [np.concatenate([[0], np.cumsum(x[links])]) for x in (is_best, most)]
        n_best, total = (x[ends] - x[ends - n_links] for x in sums)
        return pa.table([column["ids"].values, *map(pa.array, (n_a, n_b, n_groups, n_links, n_best, total)), column["digests"].values], names=names)

    schema = f"{key} {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    payload = chunks.select("chunk", "ids", "n_a", "n_b", "n_groups", "links", "digests")
    # A chunk and its answers at a time are in memory, however many a task has.
    return payload.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(report, schema), rated


def alignment_report(docs: DataFrame) -> DataFrame:
    """op12: groups and links of every document."""
    return alignments(docs)[0]
