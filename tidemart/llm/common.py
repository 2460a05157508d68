"""Helpers the operators share: tables, word streams, 64-bit mixing, stored tables, connected components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import shared_dir

MASK = (1 << 64) - 1
# The multipliers of the splitmix64 finaliser and its increment.
MIX_A, MIX_B, GOLDEN = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a permutation of the 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_B)
    x ^= x >> np.uint64(31)
    return x


def words(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text between the six ASCII white-space bytes (0x20, 0x09-0x0D)."""
    return text.split() if text else []


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k words in a row."""
    out = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for j in range(k if len(out) else 0):
        out = mix64(out * np.uint64(3) + hashes[j : j + len(out)])
    return out


class WordHash(dict):
    """64-bit hashes of words; forgets when it is full."""

    def __init__(self, most: int = 150_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Numbering(dict):
    """Numbers keys in the order of their first look-up."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a table into the cluster's shared folder and read it back: lineage ends here, and
    no lost executor can take the rows with it."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Few, large rows: let the writer look at its buffer after every row.
LARGE_ROWS = {"parquet.block.size": str(32 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "4"}


# Edges that one task contracts at a time.
BLOCK_EDGES = 250_000


class Forest(dict):
    """Union by smallest root, over any nodes."""

    def root(self, x):
        up = self.get(x, x)
        while up != x:
            top = self.get(up, up)
            self[x] = top
            x, up = up, top
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self[max(x, y)] = min(x, y)
        return x != y


def contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """Stars (a, root) of the edges in each task, block by block of bounded size."""

    def stars(forest: Forest) -> pa.RecordBatch:
        nodes = list(forest)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(forest.root, nodes), pa.int64())], names=["a", "b"])

    def contract(batches):
        forest, n = Forest(), 0
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.join(x, y)
            n += batch.num_rows
            if n > 2 * BLOCK_EDGES:
                yield stars(forest)
                forest, n = Forest(), 0
        yield stars(forest)

    return edges.repartition(tasks).mapInArrow(contract, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); the component is its smallest node.

    Each round contracts the edges in blocks of bounded size, one to a task. While there are several blocks, large-star
    and small-star steps (Kiveris et al., 2014) follow, joins of the edges with each node's smallest neighbour; a hub
    is a skewed join key there that adaptive execution may split. Every round is written to the shared folder.
    """
    now = stored(edges.select("a", "b").where("a <> b"), "edges")
    seen = None
    while True:
        tasks = max(1, -(-now.count() // BLOCK_EDGES))
        now = stored(contracted(now, tasks), "stars")
        if tasks == 1:
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.union(down.select("a", F.col("m").alias("b"))).distinct(), "stars")
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if sums == seen:
            break
        seen = sums
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(leaves.select(F.col("component").alias("node"), "component").distinct())
