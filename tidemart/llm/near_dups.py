"""Near-duplicates by circulant MinHash.

A document's set holds its distinct shingles of some words in a row (words between ASCII white space, A-Z in lower
case); ``Likeness`` says how many, and which part of two sets must be common. Two permutations of the 64-bit integers make its whole signature: the first shuffles the
shingles, the second is applied after a circular shift by k, and the smallest value is coordinate k (Li
and Li, C-MinHash, 2022). Coordinates are banded; documents meeting in a band are candidates. 28 bands of five miss a
pair at similarity 0.85 with chance 7e-8, 42 bands one at 0.8 with chance 6e-8.

Equal sets are one node from the start. Candidates are never written out as pairs: buckets become stars, stars
become candidate groups, and each group is verified on its full sets inside one task, or, if it is large, block by block
of bounded size. Every pair of a group is compared exactly, through an inverted index of the shingles, and a task
returns only a spanning forest of the links it confirmed. The components of these are the result.

Documents with fewer words than a shingle have the whole sequence as theirs. Without words (null, empty, white space) a
document is linked with nothing. Rows without an id are linked with nothing and have no component. Rows that share an id are
nodes of their own if their sets differ.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import GOLDEN, MIX_A, MIX_B, Forest, WordHash, components, mix64, shingles, stored, words

BANDS, ROWS = 28, 5


class Likeness(NamedTuple):
    """Words of a shingle, the least similarity in per cent, and bands that fit it."""

    shingle: int
    percent: int
    bands: int = BANDS


# What op7 asks for, and what a corpus stage without a contract of its own takes.
THREE_WORDS, FIVE_WORDS = Likeness(3, 85), Likeness(5, 80, 42)
SIGNED_AT_ONCE = 40_000
BLOCK_SHINGLES = 2_000_000


def shingle_set(text: bytes | None, hashed: WordHash, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    found = words(text.lower()) if text else []
    if not found:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashed.__getitem__, found), np.uint64, len(found))
    return np.unique(shingles(each, min(shingle, len(found))))


def set_key(shingle: np.ndarray) -> int:
    """A hash of a whole set, as a signed number."""
    salted = mix64(shingle + np.uint64(GOLDEN))
    total = salted.sum(dtype=np.uint64) ^ mix64(np.bitwise_xor.reduce(salted, keepdims=True))[0]
    return int(mix64(np.array([total + np.uint64(len(shingle))], np.uint64)).view(np.int64)[0])


def bands_of(sets: list[np.ndarray], bands: int = BANDS) -> np.ndarray:
    """Band keys (sets x bands) of non-empty sets."""
    flat = mix64(np.concatenate(sets))
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    keys = np.zeros((len(sets), bands), np.uint64)
    x, y = np.empty_like(flat), np.empty_like(flat)
    for k in range(bands * ROWS):
        # The second permutation of the shifted values: mix64, without new arrays.
        np.add(flat, np.uint64(GOLDEN + k), out=x)
        for shift, factor in ((30, MIX_A), (27, MIX_B)):
            np.right_shift(x, np.uint64(shift), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint64(factor), out=x)
        np.right_shift(x, np.uint64(31), out=y)
        np.bitwise_xor(x, y, out=x)
        band = k // ROWS
        keys[:, band] = mix64(keys[:, band] * np.uint64(3) + np.minimum.reduceat(x, starts) + np.uint64(band))
    return keys.view(np.int64)


SIGNATURE = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("node", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]
)


def signature(like: Likeness) -> Callable:
    """Size, key and band keys of each text's set; an empty set has neither key nor bands."""

    @F.arrow_udf(SIGNATURE)
    def signed(texts: pa.Array) -> pa.Array:
        hashed, n, nodes, bands, waiting = WordHash(), [], [], [], []

        def sign() -> None:
            if waiting:
                keys = bands_of([s for _, s in waiting], like.bands)
                for (i, _), row in zip(waiting, keys, strict=True):
                    bands[i] = row
                waiting.clear()

        size = 0
        for text in texts.cast(pa.binary()).to_pylist():
            found = shingle_set(text, hashed, like.shingle)
            n.append(len(found))
            nodes.append(set_key(found) if len(found) else None)
            bands.append(None)
            if len(found):
                waiting.append((len(bands) - 1, found))
                size += len(found)
            if size >= SIGNED_AT_ONCE:
                sign()
                size = 0
        sign()
        arrays = [pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(arrays, ["n", "node", "bands"])

    return signed


def candidate_stars(signed: DataFrame) -> DataFrame:
    """Edges (a, b) from every node of a bucket to the smallest one in it."""
    met = signed.where("node is not null").select("node", F.explode("bands").alias("bucket"))
    shared = met.groupBy("bucket").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b <> top").select("bucket", "b")
    # Both sides grow with the corpus, so neither is broadcast at any size.
    return met.join(shared.hint("merge"), "bucket").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def linked(sets: list[np.ndarray], left: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the exact links among the sets; with both sides present, of those across."""
    flat, sizes = np.concatenate(sets), np.fromiter(map(len, sets), np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    cuts = np.flatnonzero(np.diff(flat[order], prepend=flat[order[0]] ^ np.uint64(1)))
    frequency = np.diff(np.append(cuts, len(flat)))
    posting = owner[order]
    rank = np.empty(len(flat), np.int64)
    rank[order] = np.repeat(np.arange(len(cuts)), frequency)
    offsets, forest, out = np.cumsum(sizes) - sizes, Forest(), []
    across = left.any() and not left.all()
    for i in range(len(sets)):
        mine = rank[offsets[i] : offsets[i] + sizes[i]]
        mine = mine[frequency[mine] > 1]
        total = frequency[mine].sum()
        if not total:
            continue
        spots = np.arange(total) - np.repeat(np.cumsum(frequency[mine]) - frequency[mine], frequency[mine])
        both = np.bincount(posting[np.repeat(cuts[mine], frequency[mine]) + spots], minlength=len(sets))
        hit = 100 * both >= percent * (sizes + sizes[i] - both)
        hit[i:] = False
        if across:
            hit &= left != left[i]
        out += [(i, j) for j in np.flatnonzero(hit).tolist() if forest.join(i, j)]
    return out


EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def verify(block: pa.Table, like: Likeness) -> pa.Table:
    """Links of all candidate groups, or pairs of blocks of one, in a task's share."""
    hashed, a, b = WordHash(), [], []
    rows: dict[tuple, list[tuple[int, bool, np.ndarray]]] = {}
    columns = [block.column(c).to_pylist() for c in ("group", "i", "j", "block", "node")]
    texts = block.column("text").cast(pa.binary())
    for at, (group, i, j, own, node) in enumerate(zip(*columns, strict=True)):
        found = shingle_set(texts[at].as_py(), hashed, like.shingle)
        if len(found) and set_key(found) == node:
            rows.setdefault((group, i, j), []).append((node, own == i and i != j, found))
    for members in rows.values():
        nodes = [m[0] for m in members]
        for x, y in linked([m[2] for m in members], np.array([m[1] for m in members]), like.percent):
            a.append(nodes[x])
            b.append(nodes[y])
    return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=EDGE)


def confirmed(docs: DataFrame, nodes: DataFrame, groups: DataFrame, like: Likeness, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Edges (a, b) between nodes whose full sets are similar enough.

    ``nodes`` (node, doc_id, n) names a document for each node, ``groups`` (node, component) the candidates.
    """
    members = stored(nodes.join(groups, "node"), "candidates")
    sizes = members.groupBy("component").agg(F.sum("n").alias("total"))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("total") / block_shingles).cast("int"))
    small = sizes.where("blocks = 1").agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    bins = max(32, 2 * small // block_shingles + 1)
    placed = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("node", "doc_id", F.col("component").alias("group"), "blocks", "block", other.alias("other"))
    placed = placed.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    share = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("group"), F.lit(bins))).otherwise(F.xxhash64("group", "i", "j"))
    rows = placed.withColumn("share", share).hint("merge").join(docs.select("doc_id", "text"), "doc_id")
    rows = rows.select("share", "group", "i", "j", "block", "node", "text")
    return rows.groupBy("share").applyInArrow(lambda block: verify(block, like), "a bigint, b bigint")


def groups_of(docs: DataFrame, like: Likeness) -> DataFrame:
    """(doc_id, n_shingles, node, component_id, first) of every row; of a group, the set ``first`` of document ``component_id`` stays."""
    signed = stored(docs.select("doc_id", signature(like)("text").alias("s")).select("doc_id", "s.*"), "signatures")
    known = signed.where("node is not null and doc_id is not null")
    nodes = known.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.count("*").alias("copies"))
    nodes = stored(nodes, "nodes")
    groups = components(candidate_stars(known))
    links = components(confirmed(docs.where("doc_id is not null"), nodes.select("node", "doc_id", "n"), groups, like))
    least = nodes.join(links, "node").groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("least"))
    linked_nodes = links.join(least, "component").select("node", "least")
    # Only nodes with copies or links have another document to name.
    several = nodes.join(linked_nodes, "node", "left").where("copies > 1 or least is not null")
    several = several.select("node", F.coalesce("least.doc_id", "doc_id").alias("component_id"), F.coalesce("least.node", "node").alias("first"))
    return signed.select("doc_id", "n", "node").join(several, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "node",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce("first", "node").alias("first"),
    )


def near_duplicates(docs: DataFrame, like: Likeness = THREE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    return groups_of(docs, like).select("doc_id", "n_shingles", "component_id")


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """op7: the group of every document, and whether it is the one that stays."""
    found = near_duplicates(docs.select("doc_id", "text"), THREE_WORDS)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def set_keys(like: Likeness) -> Callable:
    """The key of each text's set, null for an empty one."""

    @F.arrow_udf(T.LongType())
    def keys(texts: pa.Array) -> pa.Array:
        hashed = WordHash()
        found = (shingle_set(t, hashed, like.shingle) for t in texts.cast(pa.binary()).to_pylist())
        return pa.array([set_key(f) if len(f) else None for f in found], pa.int64())

    return keys


def without_near_duplicates(docs: DataFrame, like: Likeness = THREE_WORDS) -> DataFrame:
    """One row of each group, and all rows without an id; columns stay as they are.

    Rows that share an id stand for themselves if their sets differ. Of rows that repeat both id and set one stays, always
    the same.
    """
    kept = groups_of(docs, like).where("doc_id = component_id and node <=> first").select(F.col("doc_id").alias("__id"), F.col("node").alias("__kept"))
    named = docs.where("doc_id is not null").withColumn("__node", set_keys(like)("text"))
    named = named.join(kept.distinct(), F.expr("doc_id = __id and __node <=> __kept"), "left_semi")
    ordered = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    one = named.groupBy("doc_id", "__node").agg(F.min_by(F.struct(*docs.columns), F.struct(*ordered)).alias("row"))
    return one.select("row.*").unionByName(docs.where("doc_id is null"))
