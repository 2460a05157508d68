"""SentencePiece encoding by sampling, and lossless decoding.

A text's lattice has an arc for every vocabulary piece that matches somewhere, and for a character
outside the vocabulary an arc of byte pieces. Sampling is forward filtering, backward sampling: alpha
sums the weights of all paths to a position, then the path is drawn from the end, each arc with
chance alpha(start) * weight / alpha(end). So a segmentation is drawn exactly in proportion to its weight, the
product of exp(score) ** sharpness of its pieces. The model file ranks its pieces by merges and has no
probabilities, so scores follow Zipf's law: -log(rank + 1).

No piece has the space mark after another character, nor a line break inside, so the lattice of a text
is a chain of small ones, cut before each run of space marks. Those of a batch's distinct segments are filtered
together in numpy, and all their occurrences take their backward steps together. A draw is a hash
of seed, row key, segment number and step: a row's result does not depend on its batch, task or attempt.
A repeated row key with another text gets draws of the same stream; null keys share one stream.

Null texts have null pieces, empty texts none. A literal space mark is written in bytes, so decoding always
gives the text back. A lone text takes memory in proportion to its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import GOLDEN, Numbering, mix64

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MARKED = 0x2581
# The private-use character that stands for a literal space mark inside the lattice.
LITERAL = 0x10FFFF
BATCH_CHARS = 1_000_000
DENSE = 95
SHARPNESS = 0.5


class Vocabulary:
    """Pieces, their log weights, and a trie over code points as one sorted table of (node, character)."""

    def __init__(self, model_file: str, sharpness: float):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        self.bytes_of = [b""] * n
        self.byte_ids = np.zeros(256, np.int32)
        pieces: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[piece] = i
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
                if MARK in piece.lstrip(MARK) or "\n" in piece:
                    raise ValueError(f"piece {piece!r} crosses a segment")
        ranks = np.array([model.get_score(i) for i in range(n)])
        order = np.argsort(np.argsort(-ranks, kind="stable"), kind="stable")
        self.weight = -sharpness * np.log(order + 2.0)
        self.unknown = -sharpness * (np.log(n + 2.0) + 5.0)
        nodes: dict[tuple[int, int], int] = {}
        at_node: dict[int, int] = {}
        for piece, i in pieces.items():
            node = 0
            for char in piece:
                node = nodes.setdefault((node, ord(char)), len(nodes) + 1)
            at_node[node] = i
        keys = np.array([a << 21 | c for a, c in nodes], np.int64)
        to = np.array(list(nodes.values()), np.int64)
        self.keys, self.to = keys[np.argsort(keys)], to[np.argsort(keys)]
        # Steps by the most frequent characters are in one table; column 0 is for all others.
        often, times = np.unique(self.keys & 0x1FFFFF, return_counts=True)
        often = often[np.argsort(-times, kind="stable")][:DENSE]
        self.column = np.zeros(0x110000, np.uint8)
        self.column[often] = np.arange(1, len(often) + 1)
        self.dense = np.full((len(nodes) + 1, DENSE + 1), -1, np.int32)
        self.dense[self.keys >> 21, self.column[self.keys & 0x1FFFFF]] = self.to
        self.piece_at = np.full(len(nodes) + 1, -1, np.int32)
        self.piece_at[list(at_node)] = list(at_node.values())

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The next trie node, or -1."""
        column = self.column[char]
        out = self.dense[node, column]
        rare = np.flatnonzero(column == 0)
        if len(rare):
            key = node[rare].astype(np.int64) << 21 | char[rare]
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[rare] = np.where(self.keys[i] == key, self.to[i], -1)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text; the first space is the one that encoding put there."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")[1:]


@cache
def vocabulary(model_file: str, sharpness: float) -> Vocabulary:
    return Vocabulary(model_file, sharpness)


class Lattice:
    """Arcs of many segments side by side, sorted by end, and alpha of every position.

    Segments come without their first space mark. Segment s has the positions first[s] .. last[s]; arcs join positions.
    """

    def __init__(self, segments: list[str], vocab: Vocabulary):
        chars = np.frombuffer((MARK + MARK.join(segments)).encode("utf-32-le"), np.int32)
        length = np.fromiter(map(len, segments), np.int64, len(segments)) + 1
        segment = np.repeat(np.arange(len(segments), dtype=np.int32), length)
        self.first = np.concatenate([[0], np.cumsum(length + 1)])[:-1]
        self.last = self.first + length
        position = np.arange(len(chars), dtype=np.int32) + segment
        # Grow all matches by one character at a time.
        start, node = np.arange(len(chars), dtype=np.int32), np.zeros(len(chars), np.int32)
        limit = np.cumsum(length).astype(np.int32)[segment]
        found, reach = [], 0
        single = np.zeros(len(chars), bool)
        while len(start):
            node = vocab.step(node, chars[start + reach])
            reach += 1
            keep = node >= 0
            start, node = start[keep], node[keep]
            piece = vocab.piece_at[node]
            hit = piece >= 0
            found.append((start[hit], np.full(hit.sum(), reach, np.int32), piece[hit]))
            if reach == 1:
                single[start[hit]] = True
            more = start + reach < limit[start]
            start, node = start[more], node[more]
        bare = np.flatnonzero(~single).astype(np.int32)
        found.append((bare, np.ones(len(bare), np.int32), -1 - chars[bare]))
        start, size, self.piece = (np.concatenate(x) for x in zip(*reversed(found), strict=True))
        del found, single, limit, node
        self.start = position[start]
        end = self.start + size
        weight = np.where(self.piece >= 0, vocab.weight[np.maximum(self.piece, 0)], vocab.unknown)
        # Positions at the same distance from their segment's start are filtered together; an end's longest arc comes first.
        depth = end - self.first.astype(np.int32)[segment[start]]
        order = np.lexsort((end, depth)).astype(np.int32)
        del start, size, segment, position
        self.start, self.piece, end, weight, depth = self.start[order], self.piece[order], end[order], weight[order], depth[order]
        del order
        alpha = np.full(len(chars) + len(segments), -np.inf)
        alpha[self.first] = 0.0
        heads = np.flatnonzero(np.diff(end, prepend=-1))
        size = np.diff(heads, append=len(end))
        levels = np.flatnonzero(np.diff(depth[heads], prepend=-1, append=-1))
        chance = np.empty(len(end))
        for g, h in zip(levels[:-1], levels[1:], strict=True):
            a, b = heads[g], heads[h] if h < len(heads) else len(end)
            x = alpha[self.start[a:b]] + weight[a:b]
            inner = heads[g:h] - a
            top = np.maximum.reduceat(x, inner)
            x -= np.repeat(top, size[g:h])
            np.exp(x, out=x)
            mass = np.add.reduceat(x, inner)
            alpha[end[heads[g:h]]] = top + np.log(mass)
            chance[a:b] = x / np.repeat(mass, size[g:h])
        # Running chances of the arcs into a position; the last one takes every draw.
        run = np.cumsum(chance)
        self.until = run - np.repeat(run[heads] - chance[heads], size)
        self.until[heads + size - 1] = np.inf
        self.head = np.zeros(len(alpha), np.int64)
        self.head[end[heads]] = heads
        self.alpha = alpha

    def sample(self, occurrence: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all occurrences of segments, in order, and how many each has."""
        live = np.arange(len(occurrence))
        at, stop = self.last[occurrence], self.first[occurrence]
        taken, step = [], 0
        count = np.zeros(len(occurrence), np.int64)
        while len(live):
            draw = (mix64(key[live] + np.uint64(step * GOLDEN & (1 << 64) - 1)) >> np.uint64(11)) / 2.0**53
            arc = self.head[at]
            later = np.flatnonzero(self.until[arc] <= draw)
            while len(later):
                arc[later] += 1
                later = later[self.until[arc[later]] <= draw[later]]
            taken.append((live, self.piece[arc]))
            count[live] += 1
            at = self.start[arc]
            going = at > stop[live]
            live, at = live[going], at[going]
            step += 1
        ends = np.cumsum(count)
        out = np.empty(ends[-1] if len(ends) else 0, np.int64)
        for back, (who, piece) in enumerate(taken):
            out[ends[who] - 1 - back] = piece
        return out, count


def segments_of(text: str) -> list[str]:
    """Cut before every run of space marks that follows another character; the first mark of each is left out."""
    words = text.replace(MARK, chr(LITERAL)).split(" ")
    if all(words):
        return words
    out, marks = [], 0
    for word in words:
        if word:
            out.append(MARK * marks + word)
            marks = 0
        else:
            marks += 1
    return out if not marks else [*out, MARK * (marks - 1)]


def row_key(value) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(str(value).encode("utf-8", "replace"))


def encode_texts(texts: list[str | None], keys: list, vocab: Vocabulary, seed: int) -> list[np.ndarray | None]:
    """Sampled piece ids of each text."""
    numbers = Numbering()
    parts = [np.fromiter(map(numbers.__getitem__, segments_of(t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
    if not numbers:
        return [None if t is None else np.zeros(0, np.int32) for t in texts]
    lattice = Lattice(list(numbers), vocab)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    base = np.array([row_key(k) for k in keys], np.uint64) ^ mix64(np.array([seed & (1 << 64) - 1], np.uint64))
    number = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    stream = mix64(np.repeat(base, size) + number.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    piece, count = lattice.sample(np.concatenate(parts), stream)
    text = np.repeat(np.repeat(np.arange(len(parts)), size), count)
    if (piece < 0).any():
        # Characters outside the vocabulary become their UTF-8 bytes.
        codes, which = np.unique(-1 - piece[piece < 0], return_inverse=True)
        spelled = [chr(MARKED if c == LITERAL else c).encode("utf-8", "surrogatepass") for c in codes.tolist()]
        table = vocab.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        lengths = np.fromiter(map(len, spelled), np.int64)
        begin = np.cumsum(lengths) - lengths
        copies = np.ones(len(piece), np.int64)
        copies[piece < 0] = lengths[which]
        offset = np.zeros(len(piece), np.int64)
        offset[piece < 0] = begin[which]
        inside = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        wide = np.repeat(piece, copies)
        piece = np.where(wide >= 0, wide, table[np.minimum(np.repeat(offset, copies) + inside, len(table) - 1)])
        text = np.repeat(text, copies)
    cuts = np.cumsum(np.bincount(text, minlength=len(parts)))[:-1]
    split = np.split(piece.astype(np.int32), cuts)
    return [None if t is None else ids for t, ids in zip(texts, split, strict=True)]


def batches(texts: list[str | None], keys: list) -> Iterator[tuple[list, list]]:
    some, some_keys, size = [], [], 0
    for text, key in zip(texts, keys, strict=True):
        some.append(text)
        some_keys.append(key)
        size += len(text or "")
        if size >= BATCH_CHARS:
            yield some, some_keys
            some, some_keys, size = [], [], 0
    if some:
        yield some, some_keys


ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("lossless", T.BooleanType())])


def with_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "pieces",
    model_file: str = MODEL, seed: int = 7, sharpness: float = SHARPNESS,
) -> DataFrame:
    """Add ``out`` (ids, and whether they decode to the very text); a column of that name is replaced."""

    @F.arrow_udf(ENCODED)
    def encode(texts: pa.Array, keys: pa.Array) -> pa.Array:
        vocab = vocabulary(model_file, sharpness)
        lists, same = [], []
        for some, some_keys in batches(texts.to_pylist(), keys.to_pylist()):
            ids = encode_texts(some, some_keys, vocab, seed)
            same += [None if t is None else not t and not len(i) or vocab.decode(i.tolist()) == t for t, i in zip(some, ids, strict=True)]
            size = np.array([0 if i is None else len(i) for i in ids])
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            full = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([i for i in ids if i is not None] or [np.zeros(0, np.int32)])),
                                            mask=pa.array([i is None for i in ids]))
            lists.append(full)
        made = pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))
        return pa.StructArray.from_arrays([made, pa.array(same, pa.bool_())], ["ids", "lossless"])

    return docs.withColumn(out, encode(F.col(text), F.col(key)))


def decoded(rows: DataFrame, ids: str = "ids", out: str = "text", model_file: str = MODEL) -> DataFrame:
    """Add the text of piece ids; no ids at all are the empty text."""

    @F.arrow_udf(T.StringType())
    def decode(lists: pa.Array) -> pa.Array:
        vocab = vocabulary(model_file, SHARPNESS)
        return pa.array([None if i is None else vocab.decode(i) for i in lists.to_pylist()], pa.string())

    return rows.withColumn(out, decode(F.col(ids)))


def piece_report(docs: DataFrame) -> DataFrame:
    """op2 and the pipeline's last stage: the sampled pieces of every document."""
    found = with_pieces(docs.select("doc_id", "text"))
    return found.select("doc_id", F.size("pieces.ids").cast("long").alias("n_pieces"), "pieces.ids", "pieces.lossless")
