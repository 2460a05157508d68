from collections import Counter, defaultdict
from itertools import permutations

from pyspark.sql import functions as F
from tables import ODD_TEXTS, clashing, prose

from tidemart.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int"


def brute(rows, labels):
    """Apply all orders to (doc_id, text, lang) rows one filter after the other."""
    good, toxic = defaultdict(int), defaultdict(int)
    for i, q, t in labels:
        if i is not None:
            good[i] |= q == 1
            toxic[i] |= t == 1
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    marked = []
    for i, text, lang in rows:
        text = text or ""
        words = text.encode().split()
        fails = set()
        fails |= {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else set()
        fails |= {"D"} if set(text) & set("#$%&*|") else set()
        fails |= {"E"} if i is not None and i > first[text] else set()
        marked.append((lang or "", fails, good[i] if i is not None else 0, toxic[i] if i is not None else 0))
    out, shapley = {}, Counter()
    for part in {m[0] for m in marked}:
        of = [m for m in marked if m[0] == part]
        for order in permutations("ABCDE"):
            left = list(of)
            for step, name in enumerate(order, 1):
                gone = [m for m in left if name in m[1]]
                left = [m for m in left if name not in m[1]]
                fails = sum(name in m[1] for m in of)
                alone = sum(m[1] == {name} for m in of)
                out[part, "".join(order), step] = (len(left), len(gone), fails - len(gone), alone, sum(m[2] for m in gone), sum(m[3] for m in gone))
                shapley[part, name] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    rows = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}
    assert len(rows) == df.count()
    return rows


def corpus():
    texts = [" ".join(prose(i % 25, 60 + 7 * (i % 12), 900 if i % 3 else 60)) for i in range(70)]
    texts = [t.upper() if i % 7 == 3 else t + " 5$ | x" if i % 5 == 1 else t for i, t in enumerate(texts)]
    ids = [None if i % 17 == 5 else i // 2 if i > 60 else i for i in range(len(texts))]
    langs = [["en", "de", None, ""][i % 4] for i in range(len(texts))]
    return list(zip(ids, texts, langs, strict=True)) + [(1_000 + i, t, "odd") for i, t in enumerate(ODD_TEXTS)]


def test_audit_equals_every_order_applied(spark):
    rows = corpus()
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 60, 3)] + [(3, 1, None), (None, 1, 1), (9, 0, 1), (9, 1, 0)]
    df = filter_audit.audit_report(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, LABELS))
    wanted = brute(rows, labels)
    assert len(wanted) == 600 * 4 and found(df) == wanted


def test_columns_with_names_of_results_do_not_matter(spark):
    more = clashing(spark, ["A B", "A B", None]).selectExpr("*", "'x' as part", "1 as row", "'y' as gone", "2 as removed", "3 as digest", "'z' as good")
    df = filter_audit.audit_report(more, spark.createDataFrame([(0, 1, 0)], LABELS))
    assert found(df) == brute([(0, "A B", "en"), (1, "A B", "en"), (2, None, "en")], [(0, 1, 0)])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert filter_audit.audit_report(none, spark.createDataFrame([], LABELS)).count() == 0


def test_levels_join_without_shuffling_rows(spark):
    rows = filter_audit.bucketed(spark.range(1000).selectExpr("id as row", "0 as next"), "t_rows", 4).alias("b")
    failing = filter_audit.bucketed(spark.range(0, 1000, 3).selectExpr("id as row", "id % 2 as filter"), "t_failing", 4).alias("f")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows.join(failing, F.expr("b.row = f.row and b.next - f.filter = 0"), "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
