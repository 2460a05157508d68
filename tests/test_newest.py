"""Corrections of details are written beside them, from one join."""

from tidemart.checks import registry


def test_details_and_their_corrections_come_from_one_join(spark, tmp_path):
    spark.sql("select 1L l_orderkey, 2L l_partkey, 3L l_suppkey, 4 l_linenumber, 5D l_quantity, 6D l_extendedprice, 0.06D l_discount, 0.02D l_tax,"
              " 'R' l_returnflag, 'F' l_linestatus, timestamp'2024-01-02' l_shipdate"
              " union all select 1L, 2L, 3L, 5, 5D, 6D, 0.01D, 0.02D, 'A', 'F', timestamp'2024-01-02'").write.parquet(f"{tmp_path}/lineitem.parquet")  # fmt: skip
    spark.sql("select 1L o_orderkey, 1L o_custkey, 'F' o_orderstatus, 1D o_totalprice, timestamp'2024-01-01' o_orderdate, '1-URGENT' o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    df = registry.queries()["order_detail_newest"](spark, str(tmp_path))
    shipped = 1_704_153_600
    assert {(r.id, r.coupon_id, r.ts) for r in df.collect()} == {("1-4-2-3", "C3-corrected", shipped + 60), ("1-5-2-3", None, shipped)}
    # Scans: details, activities, coupons, orders.
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 4
