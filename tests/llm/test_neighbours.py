import numpy as np

from tidemart.llm import neighbours as nn

SCHEMA = "vec_id bigint, embedding array<float>, label int, list string, ids int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for q in np.flatnonzero(ids % 100 == 0):
        s = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, s)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((4000, 24)))]
    got, want = result(nn.neighbour_report(vectors(spark, rows))), brute(rows)
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    x = np.array([v for _, v in rows], np.float32).astype(float)
    for q, found in got.items():
        assert all(abs(np.sqrt(((x[v] - x[q]) ** 2).sum()) - s) < 1e-12 for v, s in found)


def test_popular_vectors_ties_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK_VECTORS", 16)
    monkeypatch.setattr(nn, "PART_QUERIES", 2)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((900, 4))
    x[::3] = x[0]  # a third is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = result(nn.neighbour_report(vectors(spark, rows))), brute(rows)
    exact = [q for q in want if got[q] == want[q]]
    assert {0, 300, 600} <= set(exact) and len(exact) >= 8


def test_what_takes_no_part(spark):
    good = [(i, [float(i), 1.0, 2.0]) for i in (0, 1, 2, 100)]
    bad = [(3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 1.0]), (7, [float("nan"), 1.0, 1.0]),
           (8, [float("inf"), 1.0, 1.0]), (200, [1.0]), (None, [1.0, 1.0, 2.0]), (100, [100.0, 1.0, 2.0])]
    got = result(nn.neighbour_report(vectors(spark, good + bad)))
    assert got == brute(good) and set(got) == {0, 100}
    assert nn.neighbour_report(vectors(spark, [])).count() == 0
    assert nn.neighbour_report(vectors(spark, bad[:5])).count() == 0
    assert nn.neighbour_report(vectors(spark, [(0, [1.0, 2.0])])).count() == 0
