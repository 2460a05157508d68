"""Nearest neighbours by an inverted file whose lists are scanned dimension by dimension.

A bounded sample of vectors gives the list centres, the number of lists to probe (so that sample queries find ``TARGET`` of
their neighbours in the sample) and, for every query, a distance within which its probed lists hold enough neighbours. All
vectors are assigned to lists. In a list, vectors and query are rotated by a random orthogonal matrix and compared block of
columns by block of columns: after d of D columns a candidate whose partial distance, scaled by D / d, is above the bound by
the factor (1 + EPSILON / sqrt(d)) ** 2 is abandoned (Gao and Long, ADSampling, 2023). Survivors are measured on the original vectors in
double precision.

Equal vectors are searched once: only their smallest k + 1 ids can be in a result of k. Lists are cut into blocks of bounded size, and
the queries of a list into parts, so no task holds a whole popular list. Vectors that are null, empty, zero, of
another length than most, or hold null or non-finite components take no part, nor do rows without an id.
Rows that repeat an id and vector are one row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import stored

K = 10
SAMPLE_VECTORS, SAMPLE_NUMBERS = 16_384, 8_000_000
MOST_LISTS, VECTORS_A_LIST = 1_024, 16
SAMPLE_QUERIES, TARGET = 256, 0.97
COLUMNS, EPSILON = 16, 2.1
BLOCK_VECTORS, PART_QUERIES = 4_096, 2_048
SALTS = 16


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    rows = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    return rows.where(F.size("vector") == (usual.d if usual else 0))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(vector, ids): each vector with its k + 1 smallest ids, found by salts first, so that a popular vector spreads."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for keys in (["vector", "salt"], ["vector"]):
        order = Window.partitionBy(*keys).orderBy("vec_id")
        salted = salted.dropDuplicates(["vector", "vec_id"]) if "salt" in keys else salted
        salted = salted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    return salted.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None, :], 0)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass
class Lists:
    """What the sample says: centres, rotation, lists to probe; and the sample itself with its lists."""

    centres: np.ndarray
    rotation: np.ndarray
    probes: int
    sample: np.ndarray
    sample_list: np.ndarray
    sizes: np.ndarray | None = None

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        return squared(vectors, self.centres).argmin(1)

    def probed(self, vectors: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Lists for each query, nearest first and with enough vectors in them, and its bound."""
        order = np.argsort(squared(vectors, self.centres), axis=1, kind="stable")
        near = squared(vectors, self.sample)
        own = near <= 1e-12 * (1 + (vectors**2).sum(1))[:, None]
        lists, bounds = [], np.full(len(vectors), np.inf)
        for i in range(len(vectors)):
            enough = int(np.searchsorted(np.cumsum(self.sizes[order[i]]), k + 1)) + 1
            lists.append(order[i, : max(self.probes, enough)])
            inside = near[i, np.isin(self.sample_list, lists[i]) & ~own[i]]
            if len(inside) >= k:
                bounds[i] = np.partition(inside, k - 1)[k - 1]
        return lists, bounds


def fit(vectors: np.ndarray, total: int, k: int = K, seed: int = 11) -> Lists:
    """Centres by Lloyd's rounds on the sample, and the probes that reach ``TARGET`` on it."""
    rng = np.random.default_rng(seed)
    n, d = vectors.shape
    wanted = max(1, min(MOST_LISTS, n // VECTORS_A_LIST, round(np.sqrt(total))))
    centres = vectors[rng.choice(n, wanted, replace=False)]
    for _ in range(10):
        own = squared(vectors, centres).argmin(1)
        count = np.bincount(own, minlength=wanted)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    own = squared(vectors, centres).argmin(1)
    asked = rng.choice(n, min(n, SAMPLE_QUERIES), replace=False)
    near = squared(vectors[asked], vectors)
    near[np.arange(len(asked)), asked] = np.inf
    best = np.argsort(near, axis=1)[:, : min(k, n - 1)]
    order = np.argsort(np.argsort(squared(vectors[asked], centres), axis=1), axis=1)
    rank = np.take_along_axis(order, own[best], axis=1).ravel()
    probes = int(np.sort(rank)[min(len(rank) - 1, int(np.ceil(TARGET * len(rank))))]) + 1 if len(rank) else wanted
    rotation, _ = np.linalg.qr(rng.standard_normal((d, d)))
    return Lists(centres, rotation, probes, vectors, own)


def scan(turned: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Rows that stay after every block of columns."""
    d = len(query)
    alive, partial = np.arange(len(turned)), np.zeros(len(turned))
    for a in range(0, d, COLUMNS):
        part = slice(a, min(d, a + COLUMNS))
        partial += ((turned[alive, part] - query[part]) ** 2).sum(1)
        seen = part.stop
        limit = bound * (1 + 1e-9) * seen / d * (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < d else bound * (1 + 1e-9)
        keep = partial <= limit
        alive, partial = alive[keep], partial[keep]
    return alive


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def searcher(rotation: np.ndarray, k: int):
    """A function from the vectors and queries of a block to the k best of each query there."""

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if vectors.num_rows and queries.num_rows:
            d = len(rotation)
            own = matrix(vectors.column("vector").combine_chunks(), d)
            ids = vectors.column("ids").to_pylist()
            turned = own @ rotation
            asked = matrix(queries.column("vector").combine_chunks(), d)
            for i, (query_id, bound) in enumerate(zip(queries.column("query_id").to_pylist(), queries.column("bound").to_pylist(), strict=True)):
                alive = scan(turned, asked[i] @ rotation, bound)
                score = np.sqrt(((own[alive] - asked[i]) ** 2).sum(1))
                if len(alive) > k + 1:
                    few = score <= np.partition(score, k)[k]
                    alive, score = alive[few], score[few]
                each = [(s, v) for s, a in zip(score.tolist(), alive.tolist(), strict=True) for v in ids[a] if v != query_id]
                out += [(query_id, v, s) for s, v in sorted(each)[:k]]
        columns = zip(*out, strict=True) if out else ([], [], [])
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND, strict=True)], schema=FOUND)

    return search


def nearest(rows: DataFrame, is_query, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row where ``is_query`` (of vec_id) holds."""
    spark = rows.sparkSession
    good = usable(rows, key, vector)
    known = stored(distinct_vectors(good, k), "vectors")
    total = known.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    d = known.select(F.size("vector")).first()[0]
    most = max(1, min(SAMPLE_VECTORS, SAMPLE_NUMBERS // d))
    some = known.select("vector").orderBy(F.xxhash64("vector")).limit(most).toArrow()
    model = fit(matrix(some.column(0).combine_chunks(), d), total, k)

    @F.arrow_udf(T.IntegerType())
    def list_of(vectors: pa.Array) -> pa.Array:
        return pa.array(model.nearest(matrix(vectors, d)).astype(np.int32)) if len(vectors) else pa.array([], pa.int32())

    placed = stored(known.withColumn("list", list_of("vector")), "lists")
    counts = placed.groupBy("list").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).collect()
    model.sizes = np.zeros(len(model.centres), np.int64)
    for row in counts:
        model.sizes[row.list] = row.ids
    probing = T.StructType([T.StructField("lists", T.ArrayType(T.IntegerType())), T.StructField("bound", T.DoubleType())])

    @F.arrow_udf(probing)
    def probe(vectors: pa.Array) -> pa.Array:
        lists, bounds = model.probed(matrix(vectors, d), k) if len(vectors) else ([], np.zeros(0))
        return pa.StructArray.from_arrays([pa.array([x.tolist() for x in lists], pa.list_(pa.int32())), pa.array(bounds, pa.float64())], ["lists", "bound"])

    asked = good.where(is_query(F.col("vec_id"))).dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("query_id"), "vector")
    asked = asked.withColumn("p", probe("vector")).select("query_id", "vector", "p.bound", F.explode("p.lists").alias("list"))
    asked = stored(asked, "probes")
    # One row per list; lists are at most ``MOST_LISTS``.
    shape = placed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("blocks"))
    parts = asked.groupBy("list").agg(F.ceil(F.count("*") / PART_QUERIES).cast("int").alias("parts"))
    shape = F.broadcast(shape.join(parts, "list"))
    numbered = F.sequence(F.lit(0), F.col("parts") - 1)
    left = placed.join(shape, "list").select(
        "list", "vector", "ids", F.pmod(F.xxhash64("vector"), F.col("blocks")).cast("int").alias("block"), F.explode(numbered).alias("part")
    )
    right = asked.join(shape, "list").select(
        "list", "query_id", "vector", "bound", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    place = ["list", "block", "part"]
    found = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(searcher(model.rotation, k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbour_report(embeddings: DataFrame) -> DataFrame:
    """op5: the ten nearest found of every vector whose id is divisible by 100."""
    return nearest(embeddings, lambda vec_id: vec_id % 100 == 0)
