"""Languages told by string kernels.

A text is the set of its character n-grams of all lengths up to ``SPECTRUM``: letters in lower case, everything between them one
space. The blended-spectrum presence kernel of two texts is the size of the intersection of their sets over the
root of the product of their sizes. Sets are kept as ``BUCKETS`` places that grams hash to.

Ridge regression in the kernel's space, one language against the rest, goes through landmarks (Nyström): with
K the kernel between landmarks and k(x) that of a text with each landmark, the features of x are k(x) K^(-1/2). The fit
needs only the sums over its texts of the products of their k(x), so tasks send sums, not texts. Scoring is two
products a batch: presence matrix by landmark matrix, the result by the coefficients.

The fit learns from at most ``FIT_ROWS`` distinct texts and ``LANDMARKS`` landmarks, the same number for every language, which
are taken in the order of a hash of the text; of languages the ``MOST_LANGUAGES`` most frequent are learned. All these
bounds are parameters. Every text is scored whole.

Null texts and texts without a letter are ``und`` with score 0, and so is every text if nothing can be learned.
Equal languages of a tie go to the first in alphabetical order. Rows without id are learned from. Rows that repeat are
scored as often as they stand; they are learned once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import GOLDEN, stored

SPECTRUM = 4
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
FOLDS, HELD = 5, 0
FIT_ROWS = 4_096
LANDMARKS = 128
MOST_LANGUAGES = 64
RIDGE = 0.1
BATCH = 64
SLICE = 500_000
UNKNOWN = "und"
SPACE = 0x20


@cache
def folding() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case if it is a letter or mark, else a space; and whether it is a letter."""
    fold, letter = np.full(0x110000, SPACE, np.uint32), np.zeros(0x110000, bool)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LM":
            low = chr(point).lower()
            fold[point] = ord(low) if len(low) == 1 else point
            letter[point] = kind == "L"
    return fold, letter


def folded(text: str) -> np.ndarray | None:
    """Letters in lower case, single spaces around words; None without a letter."""
    fold, letter = folding()
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if not letter[points].any():
        return None
    found = np.full(len(points) + 2, SPACE, np.uint32)
    found[1:-1] = fold[points]
    gap = found == SPACE
    return found[~(gap & np.concatenate([[False], gap[:-1]]))]


def places(points: np.ndarray, spectrum: int = SPECTRUM) -> np.ndarray:
    """The places of all n-grams up to ``spectrum``, with repeats."""
    points = points.astype(np.uint64)
    out, key = [], np.zeros(len(points) + 1, np.uint64)
    for n in range(min(spectrum, len(points))):
        key = (key[: len(points) - n] + points[n:] + np.uint64(n + 1)) * np.uint64(GOLDEN)
        out.append(((key ^ (key >> np.uint64(29))) * np.uint64(GOLDEN)) >> np.uint64(64 - BUCKET_BITS))
    return np.concatenate(out).astype(np.int64)


class Presence:
    """Sets of places, by way of one reused bitmap."""

    def __init__(self):
        self.seen = np.zeros(BUCKETS, bool)

    def of(self, text: str | None) -> np.ndarray | None:
        points = folded(text) if text else None
        if points is None:
            return None
        for start in range(0, len(points), SLICE):
            self.seen[places(points[start : start + SLICE + SPECTRUM - 1])] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found.astype(np.uint32)


@dataclass
class Model:
    """``sets``: of the landmarks; ``coefficients``: landmarks by languages."""

    languages: list[str]
    sets: list[np.ndarray]
    coefficients: np.ndarray | None = None
    matrix: np.ndarray | None = field(default=None, repr=False)

    def landmarks(self) -> tuple[np.ndarray, np.ndarray]:
        """The column of every place, or -1, and columns by landmarks with entries 1 / root of the landmark's size."""
        if self.matrix is None:
            used = np.unique(np.concatenate(self.sets))
            column = np.full(BUCKETS, -1, np.int64)
            column[used] = np.arange(len(used))
            self.matrix = np.zeros((len(used), len(self.sets)), np.float32)
            for k, places_of in enumerate(self.sets):
                self.matrix[column[places_of], k] = 1 / np.sqrt(len(places_of))
            self.column = column
        return self.column, self.matrix

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernel of every set with every landmark, ``BATCH`` sets a product."""
        column, matrix = self.landmarks()
        out = np.zeros((len(sets), matrix.shape[1]))
        for at in range(0, len(sets), BATCH):
            some = sets[at : at + BATCH]
            present = np.zeros((len(some), len(matrix)), np.float32)
            for row, found in zip(present, some, strict=True):
                columns = column[found]
                row[columns[columns >= 0]] = 1
            roots = np.sqrt(np.fromiter(map(len, some), np.float64, len(some)))
            out[at : at + BATCH] = (present @ matrix) / roots[:, None]
        return out

    def solve(self, products: np.ndarray, targets: np.ndarray, ridge: float = RIDGE) -> None:
        """Ridge regression from the sums k(x)' k(x) and k(x)' y(x) over the fit's texts."""
        values, vectors = np.linalg.eigh(self.kernel(self.sets))
        sound = values > 1e-6 * values.max()
        half = vectors[:, sound] / np.sqrt(values[sound])
        features = half.T @ products @ half
        self.coefficients = half @ np.linalg.solve(features + ridge * np.eye(len(features)), half.T @ targets)

    def predict(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values = self.kernel(sets) @ self.coefficients
        best = values.argmax(axis=1)
        return best, np.clip(values[np.arange(len(best)), best], 0, 1)

    def slim(self) -> Model:
        """Without what tasks can rebuild."""
        return Model(self.languages, self.sets, self.coefficients)


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def drawn(train: DataFrame, languages: dict[str, int], each: int) -> DataFrame:
    """At most ``each`` distinct texts (lang, h, text, n) of every language, by the smallest hashes; ``n`` counts from 1.

    A bound on the hash, from the language's count, leaves few rows before any are brought together; copies
    of a text have one hash and count once.
    """
    share = {lang: min(1.0, 8 * each / count) for lang, count in languages.items()}
    bound = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]
    few = train.withColumn("h", F.xxhash64("text")).where(F.pmod("h", F.lit(1 << 30)) < bound * (1 << 30))
    once = few.groupBy("lang", "h").agg(F.min("text").alias("text"))
    by_hash = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h")
    return once.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= each)


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS, most_languages: int = MOST_LANGUAGES,
) -> Model | None:
    """A model from the rows not held out; None if no row has a language and a letter."""
    train = docs.where(~is_held_out(F.col(key)) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    train = train.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    counts = {r["lang"]: r["count"] for r in counts}
    if not counts:
        return None
    each, of_each = max(1, fit_rows // len(counts)), max(1, landmarks // len(counts))
    sample = stored(drawn(train.where(F.col("lang").isin(*counts)), counts, each), "languages")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for batch in batches:
            found = [presence.of(x) for x in batch.column(1).to_pylist()]
            found = [None if x is None else x.tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["lang", "places"])

    chosen = sample.where(F.col("n") <= of_each).select("lang", "text").mapInArrow(sets, "lang string, places binary")
    chosen = sorted(map(tuple, chosen.where("places is not null").collect()))
    if not chosen:
        return None
    model = Model(sorted(counts), [np.frombuffer(p, np.uint32) for _, p in chosen])
    m, classes = len(chosen), {name: i for i, name in enumerate(model.languages)}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence, products, targets = Presence(), np.zeros((m, m)), np.zeros((m, len(classes)))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                names, texts = (c.to_pylist() for c in batch.slice(at, BATCH).columns)
                sets = [presence.of(x) for x in texts]
                k = model.kernel([x for x in sets if x is not None])
                wanted = np.zeros((len(k), len(classes)))
                wanted[np.arange(len(k)), [classes[n] for n, x in zip(names, sets, strict=True) if x is not None]] = 1
                products += k.T @ k
                targets += k.T @ wanted
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (products, targets)], names=["products", "targets"])

    parts = sample.select("lang", "text").repartition(8).mapInArrow(sums, "products binary, targets binary").collect()
    products = sum(np.frombuffer(r["products"]).reshape(m, m) for r in parts)
    targets = sum(np.frombuffer(r["targets"]).reshape(m, len(classes)) for r in parts)
    model.solve(products, targets)
    return model.slim()


def predicted(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row."""
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                some = batch.slice(start, BATCH)
                names, scores = [UNKNOWN] * some.num_rows, np.zeros(some.num_rows)
                sets = [presence.of(x) if model else None for x in some.column(1).to_pylist()]
                live = [i for i, found in enumerate(sets) if found is not None]
                if live:
                    best, value = model.predict([sets[i] for i in live])
                    scores[live] = value
                    for i, b in zip(live, best.tolist(), strict=True):
                        names[i] = model.languages[b]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(names, pa.string()), pa.array(scores)], names=schema.names)

    return docs.select(key, text).mapInArrow(predict, schema)


def language_report(docs: DataFrame) -> DataFrame:
    """op11: the language of every document, learned from those not held out."""
    found = predicted(docs, fit(docs))
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
