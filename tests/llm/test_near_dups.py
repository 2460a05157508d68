import random
import re
from itertools import combinations

import numpy as np
from tables import ODD_TEXTS, clashing, documents, prose

from tidemart.llm import near_dups as nd


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(texts):
    sets, up = [shingle_set(t) for t in texts], list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 85 * len(sets[i] | sets[j]):
            a, b = root(i), root(j)
            up[max(a, b)] = min(a, b)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def cases():
    rng, texts = random.Random(8), []
    for g in range(12):
        base = prose(g, 120)
        for _ in range(14):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += ODD_TEXTS + ["A", "two words", "Two  Words", "É x y", "é x y"]
    rng.shuffle(texts)
    return texts


def test_components_equal_all_pairs(spark):
    texts = cases()
    rows = {r.doc_id: r for r in nd.near_duplicate_report(clashing(spark, texts)).collect()}
    assert [(rows[i].n_shingles, rows[i].component_id) for i in range(len(texts))] == brute(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.values())


def test_blocks_of_a_large_group_find_the_same(spark, monkeypatch):
    texts = cases()
    monkeypatch.setattr(nd.confirmed, "__defaults__", (700,))
    rows = {r.doc_id: r.component_id for r in nd.near_duplicate_report(documents(spark, texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == [c for _, c in brute(texts)]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    both, only = rng.integers(0, 2**63, 800, dtype=np.uint64), rng.integers(0, 2**63, 200, dtype=np.uint64)
    a, b = np.unique(np.concatenate([both, only[:100]])), np.unique(np.concatenate([both, only[100:]]))
    same = np.mean(nd.bands_of([a])[0] == nd.bands_of([b])[0])
    assert abs(same - 0.8**nd.ROWS) < 0.25 and (nd.bands_of([a]) == nd.bands_of([a])).all()


def test_repeated_ids_and_rows_without_id(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    a, b = " ".join(prose(1, 50)), " ".join(prose(2, 50))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in [(5, a), (5, a), (7, a), (7, b), (None, a), (None, None)]], schema)
    rows = sorted(map(tuple, nd.near_duplicate_report(docs).select("doc_id", "component_id").collect()), key=str)
    assert rows == [(5, 5), (5, 5), (7, 5), (7, 7), (None, None), (None, None)]
    kept = nd.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [5, 7, None, None]
    assert nd.near_duplicate_report(documents(spark, [])).count() == 0


def test_an_id_on_two_texts_loses_only_the_copy(spark):
    schema = "doc_id bigint, text string, lang string"
    texts = [" ".join(prose(i, 50)) for i in range(8)]
    rows = [(100 + i, t, "en") for i, t in enumerate(texts)]
    # Each id stands on a copy of another document and on a text of its own.
    own = [" ".join(prose(50 + i, 50)) for i in range(8)]
    rows += [(200 + i, t, "en") for i, t in enumerate(texts)] + [(200 + i, t, "en") for i, t in enumerate(own)]
    near = own[0].split()[:-1]
    rows += [(200, " ".join(near), "en"), (300, own[0] + " more", "en"), (400, None, "b"), (400, "", "a"), (400, "x y", "en")]
    kept = nd.without_near_duplicates(spark.createDataFrame(rows, schema).repartition(5)).collect()
    # Of id 200 and its two near copies of one another, either may stay, but only one.
    first = [r.text for r in kept if r.doc_id == 200]
    assert len(first) == 1 and first[0] in (own[0], " ".join(near))
    rest = sorted((r.doc_id, r.text or "") for r in kept if r.doc_id != 200)
    assert rest == sorted([(100 + i, t) for i, t in enumerate(texts)] + [(200 + i, t) for i, t in enumerate(own) if i] + [(400, ""), (400, "x y")])
