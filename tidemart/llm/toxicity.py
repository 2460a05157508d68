"""Toxicity from weak supervision.

Many cheap voters look at a text: lexicons of words and of word beginnings and ends mined from labelled
rows, a short fixed lexicon, and patterns (letters spaced out, digits for letters, shouting). A
generative label model then says how far each is to be trusted: for each class it estimates how
often a voter says toxic, clean or nothing (its accuracy), and from what remains unexplained how
voters go along with each other (their correlation), so that many voters that say the same because
they look at the same words do not count as many witnesses. The human label is one more
voter. Its posterior probabilities, not the labels, train a linear classifier over the presence of words
and word parts. Only the classifier scores texts; it never sees labels, language, source or ids.

Labels are learned from rows whose crc32(doc_id as text) mod 5 is not 0. The fit takes at most
``most`` such rows (the smallest by a hash of the id; equal texts once). Scoring looks at every whole text
in parallel and needs no shuffle.

Null and empty texts have no features: they get the score of the bias. Labels other than 0 and 1 and
null ids are not learned from; a document labelled twice is learned from as toxic if either says so. With no label of
one of the classes, the fixed lexicon alone is the classifier. Of the documents only id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDS = 5
FIT_ROWS = 20_000
MINED_WORDS, MOST_FEATURES = 2_000, 4_000
PARTS = range(4, 8)
# Log likelihood ratios of a feature against chance: to be a candidate, and to be used. Some hundred thousand
# words are looked at, so a few chance finds among them must stay below the second.
CANDIDATE, SIGNIFICANT = 5.0, 14.0
HUMAN = 0.99
LEXICONS = 6
CACHED_WORDS = 100_000

# A short seed lexicon in four languages.
SEED_WORDS = """
idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting clown vermin imbecile bastard
dumbass retard filth scumbag idiota imbécil estúpido estúpida basura asqueroso inútil payaso cabrón imbécile débile
crétin connard salaud ordure minable dégoûtant abruti trottel dummkopf arschloch abschaum widerlich wertlos schwachkopf
""".split()  # fmt: skip

FOLD = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else 0x20 for c in range(256))
LEET = bytes.maketrans(b"013457@$!", b"oieastasi")


def folded(text: str) -> set[bytes]:
    """Distinct words in lower case, cut at every ASCII character that is neither letter nor digit."""
    return set(text.lower().encode("utf-8", "replace").translate(FOLD).split())


def parts_of(word: bytes) -> list[str]:
    """The word and its beginnings and ends as feature names."""
    text = word.decode("utf-8", "replace")
    cut = [k for k in PARTS if k < len(text)]
    return [f"={text}", *(f"^{text[:k]}" for k in cut), *(f"{text[-k:]}$" for k in cut)]


class Features(dict):
    """Feature numbers of each word, for the features at hand; forgets when it is full."""

    def __init__(self, numbers: dict[str, int]):
        self.numbers = numbers

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = tuple(n for n in map(self.numbers.get, parts_of(word)) if n is not None)
        return found

    def of(self, text: str | None) -> set[int]:
        return set().union(*filter(None, map(self.__getitem__, folded(text)))) if text else set()


PATTERNS = ("leet", "spaced", "shouting", "exclaims")


def patterns(text: str, seeds: frozenset[bytes]) -> list[int]:
    raw = text.lower().encode("utf-8", "replace")
    plain = raw.translate(FOLD).split()
    leet = raw.translate(LEET).translate(FOLD).split()
    single = b"".join(w if len(w) == 1 else b" " for w in plain)
    letters = sum(map(str.isalpha, text)) or 1
    return [
        int(not seeds.isdisjoint(leet) and seeds.isdisjoint(plain)),
        int(any(s in single for s in seeds)),
        int(sum(map(str.isupper, text)) > 0.6 * letters),
        int(text.count("!") * 50 > len(text)),
    ]


# --- label model -------------------------------------------------------------------------------


@dataclass
class LabelModel:
    """chances[j, v, y]: how often voter j votes v - 1 (clean, nothing, toxic) on class y."""

    prior: float
    chances: np.ndarray
    correlations: np.ndarray
    weights: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.log(self.chances[:, :, 1] / self.chances[:, :, 0]) * self.weights[:, None]
        total = np.log(self.prior / (1 - self.prior)) + sum(odds[j, votes[:, j] + 1] for j in range(votes.shape[1]))
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit_label_model(votes: np.ndarray, start: np.ndarray, human: int | None = None, rounds: int = 15) -> LabelModel:
    """Expectation maximisation from the class chances ``start``; weights follow the correlations.

    Voter ``human`` is believed beforehand to be right ``HUMAN`` of the time, as firmly as if that had been seen on as
    many rows again; the lexicons were mined from its votes, so going along with them takes no weight from it.
    """
    n, m = votes.shape
    weights, q = np.ones(m), start.clip(1e-3, 1 - 1e-3)
    model = None
    for _ in range(rounds):
        prior = float(np.clip((q.sum() + 1) / (n + 10), 1e-4, 1 - 1e-4))
        chances = np.empty((m, 3, 2))
        for y, w in ((0, 1 - q), (1, q)):
            for v in (-1, 0, 1):
                chances[:, v + 1, y] = (w @ (votes == v) + 0.5) / (w.sum() + 1.5)
        if human is not None:
            chances[human] = (chances[human] + [[HUMAN, 1 - HUMAN], [1e-4, 1e-4], [1 - HUMAN, HUMAN]]) / 2
        means = chances[:, 2] - chances[:, 0]
        rest = votes - (1 - q)[:, None] * means[:, 0] - q[:, None] * means[:, 1]
        spread = np.sqrt((rest**2).mean(0)) + 1e-9
        rho = (rest.T @ rest) / n / np.outer(spread, spread)
        np.fill_diagonal(rho, 0)
        weights = 1 / (1 + np.clip(np.abs(rho) - 0.05, 0, None).sum(1))
        if human is not None:
            weights[human] = 1
        model = LabelModel(prior, chances, rho, weights)
        q = model.posterior(votes)
    return model


# --- classifier --------------------------------------------------------------------------------


@dataclass
class Classifier:
    bias: float
    weights: dict[str, float]
    labels: LabelModel | None = field(default=None, repr=False)

    def score(self):
        """A column function: text to the probability of toxic."""
        names = list(self.weights)
        values = np.array([self.weights[n] for n in names] or [0.0])
        numbers, bias = {n: i for i, n in enumerate(names)}, self.bias

        @F.arrow_udf(T.DoubleType())
        def toxic(texts: pa.Array) -> pa.Array:
            words = Features(numbers)
            total = [bias + float(values[sorted(found)].sum()) for found in map(words.of, texts.to_pylist())]
            return pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))), pa.float64())

        return toxic


SEED_CLASSIFIER = Classifier(-3.0, {f"={w}": 6.0 for w in SEED_WORDS})


def fit_linear(rows: np.ndarray, columns: np.ndarray, n: int, m: int, target: np.ndarray, decay: float = 2e-4, steps: int = 400):
    """Logistic regression on soft targets, by gradient steps with a moving scale (Adam)."""
    w, g1, g2 = np.zeros(m + 1), np.zeros(m + 1), np.zeros(m + 1)
    w[m] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(w[m] + np.bincount(rows, w[columns], n), -30, 30)))
        error = (p - target) / n
        grad = np.append(np.bincount(columns, error[rows], m), error.sum())
        grad[:m] += decay * w[:m]
        g1, g2 = 0.9 * g1 + 0.1 * grad, 0.999 * g2 + 0.001 * grad**2
        w -= 0.1 * (g1 / (1 - 0.9**t)) / (np.sqrt(g2 / (1 - 0.999**t)) + 1e-9)
    return w[:m], w[m]


def fold_of(doc_id: str = "doc_id", folds: int = FOLDS):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def labelled(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """At most ``most`` (text, toxic) rows to learn from. The chosen ids are few enough to broadcast."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(fold_of() != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    return texts.select("text", "toxic").withColumn("place", F.xxhash64("text"))


def mined_words(rows: DataFrame, most: int = MINED_WORDS) -> list[str]:
    """Words that go with toxic labels, strongest first: documents counted by word in Spark."""
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def distinct_words(texts: pa.Array) -> pa.Array:
        return pa.array([[w.decode("utf-8", "replace") for w in folded(t)] for t in texts.to_pylist()], pa.list_(pa.string()))

    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not positive or positive == n:
        return []
    base = positive / n
    counted = rows.select(F.explode(distinct_words("text")).alias("word"), "toxic").groupBy("word").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("k")
    ).where(F.col("k") > F.col("n") * min(0.95, max(0.3, 2 * base)))
    k, rest = F.col("k"), F.col("n") - F.col("k")
    ratio = k * F.log(k / (F.col("n") * base)) + F.when(rest > 0, rest * F.log(rest / (F.col("n") * (1 - base)))).otherwise(0.0)
    strong = counted.withColumn("ratio", ratio).where(F.col("ratio") >= CANDIDATE)
    return [r.word for r in strong.orderBy(F.col("ratio").desc(), "word").limit(most).collect()]


def likelihood_ratio(k: np.ndarray, n: np.ndarray, base: float) -> np.ndarray:
    """How much better a rate of k in n explains the counts than the base rate; 0 for lower rates."""
    n, rest = np.maximum(n, 1e-9), np.maximum(n - k, 1e-9)
    ratio = k * np.log(np.maximum(k, 1e-9) / (n * base)) + rest * np.log(rest / (n * (1 - base)))
    return np.where(k > n * base, ratio, 0.0)


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Classifier:
    """The classifier learned from the labelled documents.

    It is the seed lexicon, without a label model, if labels of a class are missing, if no word goes with toxic labels
    firmly enough to be mined, or if no feature goes with the posterior labels firmly enough to be kept.
    """
    rows = labelled(docs, labels, most).persist()
    try:
        mined = mined_words(rows)
        if not mined:
            return SEED_CLASSIFIER
        names = list(dict.fromkeys([f"={w}" for w in [*SEED_WORDS, *mined]] + [p for w in mined for p in parts_of(w.encode())]))
        numbers = {n: i for i, n in enumerate(names)}
        seeds = frozenset(w.encode() for w in SEED_WORDS)
        seen = T.StructType([T.StructField("found", T.ArrayType(T.IntegerType())), T.StructField("patterns", T.ArrayType(T.IntegerType()))])

        @F.arrow_udf(seen)
        def look(texts: pa.Array) -> pa.Array:
            words, texts = Features(numbers), texts.to_pylist()
            found = pa.array([sorted(words.of(t)) for t in texts], pa.list_(pa.int32()))
            return pa.StructArray.from_arrays([found, pa.array([patterns(t, seeds) for t in texts], pa.list_(pa.int32()))], ["found", "patterns"])

        looked = rows.select("place", "toxic", look("text").alias("s")).select("place", "toxic", "s.*").toPandas()
    finally:
        rows.unpersist()
    looked = looked.sort_values(["place", "toxic"]).groupby("place", as_index=False).last()
    n, m = len(looked), len(names)
    gold = looked.toxic.to_numpy()
    row = np.repeat(np.arange(n), [len(f) for f in looked.found])
    column = np.concatenate([np.asarray(f, np.int64) for f in looked.found]) if len(row) else np.zeros(0, np.int64)

    # Voters: striped lexicons of mined words and of their parts, seeds, patterns, absences, the label.
    rank = {f"={w}": i for i, w in enumerate(mined)}
    group = np.full(m, -1)
    for name, i in numbers.items():
        if name in rank:
            group[i] = rank[name] % LEXICONS
        elif not name.startswith("="):
            group[i] = LEXICONS + i % LEXICONS
    count, mass = np.bincount(column, minlength=m), np.bincount(column, gold[row], m)
    usable = (likelihood_ratio(mass, count, gold.mean()) >= SIGNIFICANT) & (mass >= 0.5 * count)
    votes = np.zeros((n, 2 * LEXICONS + 5 + len(PATTERNS)), np.int8)
    sure = usable[column]
    for g in range(2 * LEXICONS):
        votes[row[(group[column] == g) & sure], g] = 1
    at = 2 * LEXICONS
    seed_numbers = [numbers[f"={w}"] for w in SEED_WORDS]
    votes[row[np.isin(column, seed_numbers)], at] = 1
    votes[:, at + 1] = (votes[:, :LEXICONS].max(1) > 0).astype(np.int8) - 1
    votes[:, at + 2] = (votes[:, LEXICONS : 2 * LEXICONS].max(1) > 0).astype(np.int8) - 1
    votes[:, at + 3] = (votes[:, at] > 0).astype(np.int8) - 1
    votes[:, at + 4] = 2 * gold - 1
    votes[:, at + 5 :] = np.stack(looked.patterns.to_numpy())
    model = fit_label_model(votes, np.where(gold == 1, 0.95, 0.05), human=at + 4)
    target = model.posterior(votes)

    # Features that go with the posterior labels, strongest first.
    mass, base = np.bincount(column, target[row], m), float(target.mean())
    strength = likelihood_ratio(mass, count, base)
    strength[(strength < SIGNIFICANT) | (mass < 0.3 * count)] = 0
    kept = np.argsort(-strength, kind="stable")[:MOST_FEATURES]
    kept = kept[strength[kept] > 0]
    if not len(kept):
        return SEED_CLASSIFIER
    new = np.full(m, -1)
    new[kept] = np.arange(len(kept))
    on = new[column] >= 0
    w, bias = fit_linear(row[on], new[column[on]], n, len(kept), target)
    return Classifier(float(bias), {names[i]: float(w[k]) for k, i in enumerate(kept)}, model)


def scored(docs: DataFrame, model: Classifier, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of toxic; a column of that name is replaced."""
    return docs.withColumn(out, model.score()(F.col(text)))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op4: held_out, score and prediction of every document."""
    rows = scored(docs.select("doc_id", "text"), fit(docs, labels))
    held_out = F.coalesce(fold_of() == 0, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic; columns stay as they are."""
    return docs.where(fit(docs, labels).score()(F.col("text")) < 0.5)
