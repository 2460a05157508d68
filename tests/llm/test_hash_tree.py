import zlib

from tables import ODD_TEXTS, clashing, documents

from tidemart.llm import hash_tree as ht


def shards_of(spark, tree, n=20_000):
    return {r.k: r.shard for r in ht.assign(spark.range(n).withColumnRenamed("id", "k"), tree, "k").collect()}


def test_shards_win_by_weight(spark):
    tree = ht.parent("root", ht.parent("a", ht.shard_node(0, 1.0), ht.shard_node(1, 3.0)), ht.parent("b", ht.shard_node(2, 4.0)))
    found = list(shards_of(spark, tree).values())
    for shard, share in ((0, 1 / 8), (1, 3 / 8), (2, 1 / 2)):
        assert abs(found.count(shard) / len(found) - share) < 0.015


def test_growth_moves_rows_only_into_the_new_shard(spark):
    tree = ht.even_tree(8)
    before, after = shards_of(spark, tree), shards_of(spark, ht.grown(tree, 8))
    moved = [k for k in before if before[k] != after[k]]
    assert {after[k] for k in moved} == {8}
    assert abs(len(moved) / len(before) - 1 / 9) < 0.01


def test_a_changed_weight_moves_rows_only_to_or_from_its_subtree(spark):
    def tree(weight):
        a = ht.parent("a", ht.parent("a/0", ht.shard_node(0), ht.shard_node(1, weight)), ht.parent("a/1", ht.shard_node(2)))
        return ht.parent("root", a, ht.parent("b", ht.shard_node(3), ht.shard_node(4)))

    before, after = shards_of(spark, tree(1.0)), shards_of(spark, tree(2.0))
    assert all(before[k] == after[k] for k in before if before[k] in (3, 4) and after[k] in (3, 4))
    assert all(after[k] in (0, 1, 2) for k in before if before[k] != after[k])
    # Inside the subtree, rows that were there leave shard 2 only for the rack that grew.
    assert all(after[k] in (0, 1) for k in before if before[k] == 2 and after[k] != 2)


def test_report(spark):
    texts = ODD_TEXTS * 20
    rows = ht.shard_report(clashing(spark, texts).unionByName(clashing(spark, texts))).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 8)
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert ht.shard_report(documents(spark, [])).count() == 0


def test_null_keys_have_a_shard(spark):
    docs = spark.createDataFrame([(None, "a"), (None, None)], "doc_id bigint, text string")
    rows = ht.shard_report(docs).collect()
    assert len({r.shard for r in rows}) == 1 and sorted(r.slot for r in rows) == [0, 1]


def test_no_python_on_the_plan(spark):
    plan = ht.shard_report(documents(spark, ["a", "b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
