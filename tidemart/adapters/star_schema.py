"""Order tables and an event table expressed as change log, behaviour log and config.

Everything is a projection of whole tables, so Catalyst sees through it: a slice
of the change log reads only the columns it needs of the one table behind it.
Amounts become text by way of decimals.
"""

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.constants import DATABASE
from tidemart.schemas import CONFIG_DDL
from tidemart.sources.topics import with_event_time

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
# Tasks over which the rows of a scattered table are dealt.
TASKS_PER_CORE = 4
TEXT_TIME = "date_format({}, 'yyyy-MM-dd HH:mm:ss')"


@dataclass(frozen=True)
class Tables:
    """The parquet tables of a folder, read as batch or as stream."""

    spark: SparkSession
    folder: str
    streaming: bool = False

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        batch = self.spark.read.parquet(path)
        if self.streaming:
            files = self.spark.readStream.schema(batch.schema).option("pathGlobFilter", f"{name}.parquet")
            return files.parquet(self.folder)
        return batch

    def scattered(self, name: str) -> DataFrame:
        """A table, as batch or stream, dealt out evenly over the cores before costly work on its rows.

        How many tasks of a scan have rows depends on how its files are cut into row groups.
        """
        cores, scan = self.spark.sparkContext.defaultParallelism, self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self(name).repartition(TASKS_PER_CORE * max(cores, scan.rdd.getNumPartitions()))

    def spread(self, name: str) -> DataFrame:
        """A table spread over all cores if its scan has fewer partitions than that.

        One small file is one partition; scans of larger inputs are left as they are.
        """
        df = self(name)
        cores = self.spark.sparkContext.defaultParallelism
        return df if df.isStreaming or df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _seconds(col: str) -> str:
    return f"unix_seconds(cast({col} as timestamp))"


def _text_map(values: dict[str, str] | None):
    if not values:
        return F.lit(None).cast("map<string,string>")
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.expr(v).cast("string"))])


def change(
    df: DataFrame, source: str, kind: str, data: dict[str, str], old: dict[str, str] | None = None,
    ts: str = "0", seq: str = "0",
) -> DataFrame:
    """Rows of ``df`` as changes; all arguments but ``source`` and ``kind`` are SQL expressions."""
    return df.select(
        F.lit(DATABASE).alias("database"),
        F.lit(source).alias("table"),
        F.lit(kind).alias("type"),
        _text_map(data).alias("data"),
        _text_map(old).alias("old"),
        F.expr(ts).cast("bigint").alias("ts"),
        F.expr(seq).cast("bigint").alias("seq"),
    )


def union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


Part = tuple[str, Callable[[], DataFrame]]


def part(df: DataFrame, source: str, *args: object, **kwargs: str) -> Part:
    """Changes of one kind, named by their table and made when asked for."""
    return source, lambda: change(df, source, *args, **kwargs)


def _log(parts: list[Part], only: Iterable[str] | None) -> DataFrame:
    """The change log of some tables (all by default), with event time."""
    return with_event_time(union(make() for source, make in parts if only is None or source in only))


def _order_parts(tables: Tables) -> list[Part]:
    lines = tables.spread("lineitem")
    orders = tables.spread("orders")
    line_ts, order_ts = _seconds("l_shipdate"), _seconds("o_orderdate")
    price = "cast(l_extendedprice as decimal(16,2))"
    discount = f"({price} * cast(l_discount as decimal(4,2)))"
    tax = f"({price} * cast(l_tax as decimal(4,2)))"
    next_day = TEXT_TIME.format("o_orderdate + interval 1 day")

    def moved(letter: str, old: str, new: str, later: int) -> DataFrame:
        return part(
            orders.where(F.col("o_orderstatus") == letter), "order_info", "update",
            {
                "id": "o_orderkey", "user_id": "o_custkey", "province_id": "left(o_orderpriority, 1)",
                "order_status": f"'{new}'", "operate_time": next_day,
            },
            {"order_status": f"'{old}'"}, f"{order_ts} + {later}", "o_orderkey",
        )

    return [
        part(
            lines, "order_detail", "insert",
            {
                "id": LINE_ID, "order_id": "l_orderkey", "sku_id": "l_partkey",
                "sku_name": "concat('Part#', l_partkey)", "create_time": TEXT_TIME.format("l_shipdate"),
                "source_id": "l_suppkey", "source_type": "l_linestatus",
                "sku_num": "cast(l_quantity as int)", "order_price": price,
                "split_total_amount": f"{price} - {discount}", "split_activity_amount": discount,
                "split_coupon_amount": tax,
            },
            ts=line_ts, seq="l_linenumber",
        ),
        part(
            orders, "order_info", "insert",
            {
                "id": "o_orderkey", "user_id": "o_custkey", "province_id": "left(o_orderpriority, 1)",
                "order_status": "'1001'",
            },
            ts=order_ts, seq="o_orderkey",
        ),
        part(
            lines.where("l_discount >= 0.05"), "order_detail_activity", "insert",
            {
                "order_detail_id": LINE_ID, "activity_id": "cast(l_discount as decimal(4,2))",
                "activity_rule_id": "l_linenumber",
            },
            ts=line_ts, seq="l_linenumber",
        ),
        part(
            lines.where("l_returnflag = 'R'"), "order_detail_coupon", "insert",
            {"order_detail_id": LINE_ID, "coupon_id": "concat('C', l_suppkey)"},
            ts=line_ts, seq="l_linenumber",
        ),
        moved("F", "1001", "1003", 86400),
        moved("P", "1002", "1005", 86400),
        moved("P", "1005", "1006", 172800),
        moved("O", "1001", "1002", 3600),
        part(
            lines.where("l_returnflag = 'R'"), "order_refund_info", "insert",
            {
                "id": LINE_ID, "user_id": "l_suppkey", "order_id": "l_orderkey", "sku_id": "l_partkey",
                "refund_type": "concat('R', l_linenumber)", "refund_num": "cast(l_quantity as int)",
                "refund_amount": price, "refund_reason_type": "concat('N', l_suppkey % 30)",
                "refund_reason_txt": "concat('returned ', l_linestatus)",
                "create_time": TEXT_TIME.format("l_shipdate"), "refund_status": "'0701'",
            },
            ts=line_ts, seq="l_linenumber",
        ),
        part(
            lines.where("l_returnflag = 'R' and l_linestatus = 'F'"), "order_refund_info", "update",
            {
                "order_id": "l_orderkey", "sku_id": "l_partkey", "refund_num": "cast(l_quantity as int)",
                "refund_status": "'0705'",
            },
            {"refund_status": "'0702'"}, line_ts, "l_linenumber",
        ),
        part(
            lines.where("l_returnflag = 'R'"), "refund_payment", "update",
            {
                "id": LINE_ID, "order_id": "l_orderkey", "sku_id": "l_partkey",
                "payment_type": "concat('N', l_linenumber * 4)",
                "callback_time": TEXT_TIME.format("l_shipdate + interval 2 days"), "total_amount": price,
                "refund_status": "case when l_tax < 0.06 then '1602' else '1603' end",
            },
            {"refund_status": "'1601'"}, line_ts, "l_linenumber",
        ),
    ]


def _event_parts(tables: Tables) -> list[Part]:
    events = tables.spread("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    ts = _seconds("ts")
    cart = {"id": "event_id", "user_id": "user_id", "sku_id": "k", "sku_num": "cast(floor(value) as bigint)"}
    return [
        part(events.where("event_type in ('click', 'purchase')"), "cart_info", "insert", cart, ts=ts, seq="event_id"),
        part(
            events.where("event_type in ('view', 'signup')"), "cart_info", "update", cart,
            {"sku_num": "k"}, ts, "event_id",
        ),
        part(
            events.where("event_type = 'error'"), "cart_info", "update", cart, {"is_checked": "'0'"}, ts, "event_id"
        ),
        part(
            events.where("event_type = 'purchase'"), "payment_info", "update",
            {
                "user_id": "user_id", "order_id": "user_id", "payment_type": "concat('N', k % 30)",
                "callback_time": TEXT_TIME.format("ts"), "payment_status": "'1602'",
            },
            {"payment_status": "'1601'"}, ts, "event_id",
        ),
    ]


def _comment_parts(tables: Tables) -> list[Part]:
    return [
        part(
            tables("customer"), "comment_info", "insert",
            {
                "id": "c_custkey", "user_id": "c_custkey", "sku_id": "c_nationkey * 7",
                "appraise": "concat('N', c_nationkey + c_custkey % 10)", "comment_txt": "c_name",
                "create_time": "'2024-01-01 00:00:00'",
            },
            ts="1704067200 + c_custkey", seq="c_custkey",
        )
    ]


def order_changes(tables: Tables, *only: str) -> DataFrame:
    """Changes of orders, their details and refunds; of all those tables unless some are named."""
    return _log(_order_parts(tables), only or None)


def placed_changes(tables: Tables) -> DataFrame:
    """Orders whose details, activities and coupons are logged within seconds of them.

    Cancelled orders with an even id are cancelled after ten minutes, the others after a day.
    """
    orders = tables("orders")
    lines = tables("lineitem").join(orders.select("o_orderkey", "o_orderdate"), F.expr("l_orderkey = o_orderkey"))
    at, price = _seconds("o_orderdate"), "cast(l_extendedprice as decimal(16,2))"
    discount, tax = f"({price} * cast(l_discount as decimal(4,2)))", f"({price} * cast(l_tax as decimal(4,2)))"
    placed = f"{at} + l_linenumber % 5"
    order = {"id": "o_orderkey", "user_id": "o_custkey", "province_id": "left(o_orderpriority, 1)"}
    moved = {**order, "order_status": "'1003'", "operate_time": TEXT_TIME.format("o_orderdate + interval 1 day")}
    later = "case when o_orderkey % 2 = 0 then 600 else 86400 end"
    return union([
        change(orders, "order_info", "insert", {**order, "order_status": "'1001'"}, ts=at, seq="o_orderkey"),
        change(
            orders.where("o_orderstatus = 'F'"), "order_info", "update", moved, {"order_status": "'1001'"}, f"{at} + {later}", "o_orderkey"
        ),
        change(
            lines, "order_detail", "insert",
            {
                "id": LINE_ID, "order_id": "l_orderkey", "sku_id": "l_partkey", "sku_name": "concat('Part#', l_partkey)",
                "create_time": TEXT_TIME.format("l_shipdate"), "sku_num": "cast(l_quantity as int)", "order_price": price,
                "split_total_amount": f"{price} - {discount}", "split_activity_amount": discount, "split_coupon_amount": tax,
            },
            ts=placed, seq="l_linenumber",
        ),
        change(
            lines.where("l_discount >= 0.05"), "order_detail_activity", "insert",
            {
                "order_detail_id": LINE_ID, "activity_id": "cast(l_discount as decimal(4,2))",
                "activity_rule_id": "l_linenumber",
            },
            ts=at, seq="l_linenumber",
        ),
        change(
            lines.where("l_returnflag = 'R'"), "order_detail_coupon", "insert",
            {"order_detail_id": LINE_ID, "coupon_id": "concat('C', l_suppkey)"}, ts=f"{placed} + 4", seq="l_linenumber",
        ),
    ])


def event_changes(tables: Tables, *only: str) -> DataFrame:
    """Changes of carts and payments."""
    return _log(_event_parts(tables), only or None)


def comment_changes(tables: Tables) -> DataFrame:
    """Changes of comments."""
    return _log(_comment_parts(tables), None)


def shop_changes(tables: Tables) -> DataFrame:
    """The shop's whole change log."""
    return _log(_order_parts(tables) + _event_parts(tables) + _comment_parts(tables), None)


def click_details(tables: Tables) -> DataFrame:
    """Clicks as order details keyed by user, to be matched with purchases in time."""
    clicks = tables("events").where("event_type = 'click'")
    none = "cast(null as string)"
    rows = clicks.selectExpr(
        "cast(event_id as string) id", "cast(user_id as string) order_id", "cast(user_id as string) user_id",
        "get_json_object(props, '$.k') sku_id", "event_type sku_name", f"{none} province_id",
        f"{none} activity_id", f"{none} activity_rule_id", f"{none} coupon_id",
        "date_format(ts, 'yyyy-MM-dd') date_id", f"{TEXT_TIME.format('ts')} create_time", "'1' sku_num",
        "cast(cast(value as decimal(16,2)) as string) split_original_amount",
        f"{none} split_activity_amount", f"{none} split_coupon_amount",
        "cast(cast(value as decimal(16,2)) as string) split_total_amount", f"{_seconds('ts')} ts",
    )
    return with_event_time(rows)


def dictionary(tables: Tables) -> DataFrame:
    """Nations and regions as dictionary entries."""
    nations = tables("nation").selectExpr("concat('N', n_nationkey) dic_code", "n_name dic_name")
    regions = tables("region").selectExpr("concat('R', r_regionkey) dic_code", "r_name dic_name")
    return nations.unionByName(regions)


def dimension_log(tables: Tables) -> DataFrame:
    """Changes of customers, suppliers and parts: loads, updates, deletes, re-inserts."""
    customer = tables("customer")
    acct = "cast(c_acctbal as decimal(16,2))"
    whole = {"id": "c_custkey", "name": "c_name", "nation": "c_nationkey", "acctbal": acct, "segment": "c_mktsegment"}
    parts = [
        change(customer, "customer", "bootstrap-insert", whole, ts="100", seq="1"),
        change(
            customer.where("c_acctbal < 5000"), "customer", "update",
            {
                **whole, "name": "concat(c_name, ' (renamed)')",
                "acctbal": f"case when c_mktsegment = 'BUILDING' then null else {acct} + 1 end",
            },
            {"name": "c_name"}, "200", "2",
        ),
        change(customer.where("c_nationkey < 5"), "customer", "delete", whole, ts="200", seq="3"),
        change(
            customer.where("c_nationkey < 2"), "customer", "insert",
            {"id": "c_custkey", "name": "concat(c_name, ' (back)')", "acctbal": "null"}, ts="300", seq="4",
        ),
        change(
            tables("supplier"), "supplier", "insert",
            {"id": "s_suppkey", "name": "s_name", "acctbal": "cast(s_acctbal as decimal(16,2))"}, ts="100", seq="1",
        ),
        change(
            tables("part"), "part", "update",
            {"id": "p_partkey", "name": "p_name", "brand": "p_brand", "size": "p_size"},
            {"size": "'0'"}, "100", "1",
        ),
    ]
    return union(parts)


def routing_config(spark: SparkSession) -> DataFrame:
    """Routes of the changes in :func:`dimension_log`, one per line."""
    rows = [
        ("customer", "ALL", "dim_customer", "dim", "info", "id, name,acctbal,segment", "id", None),
        ("part", "ALL", "dim_part", "dim", "info", "name,brand", "id", None),
        ("supplier", "insert", "dwd_supplier_join", "dwd", None, "id,name", None, None),
        ("part", "update", "dwd_part_change", "dwd", None, "id,brand,size", None, None),
        ("part", "insert", "dwd_part_new", "dwd", None, "id", None, None),
        ("customer", "update", "dwd_customer_change", "dwd", None, "id,name,acctbal", None, None),
    ]
    return spark.createDataFrame(rows, CONFIG_DDL)


def config_envelopes(tables: Tables) -> DataFrame:
    """Nations as config changes, in JSON envelopes.

    Every nation is loaded; some are updated, deleted, or deleted and made again.
    """
    nation = tables("nation")
    sink = "case when n_nationkey >= 20 then 'dwd' else 'dim' end"

    def row(label: str) -> str:
        return (
            "named_struct('source_table', n_name, 'source_type', 'ALL', "
            f"'sink_table', concat('{label}', n_nationkey), 'sink_type', {sink}, 'sink_family', 'info', "
            "'sink_columns', 'id,name', 'sink_row_key', 'id', 'sink_extend', cast(null as string))"
        )

    def envelope(df: DataFrame, op: str, label: str, at: int) -> DataFrame:
        image = "before" if op == "d" else "after"
        return df.selectExpr(
            f"to_json(named_struct('op', '{op}', '{image}', {row(label)}, 'ts_ms', {at}, 'seq', {at})) value",
            "cast(null as bigint) position",
        )

    return union(
        [
            envelope(nation, "r", "first_", 1),
            envelope(nation.where("n_regionkey in (1, 2)"), "u", "second_", 2),
            envelope(nation.where("n_regionkey in (2, 3)"), "d", "first_", 3),
            envelope(nation.where("n_regionkey = 3 and n_nationkey > 10"), "c", "third_", 4),
        ]
    )


def config_start(tables: Tables) -> DataFrame:
    """Regions and half of the nations as start-up config rows."""
    def rows(df: DataFrame, name: str, key: str) -> DataFrame:
        return df.selectExpr(
            f"{name} source_table", "'ALL' source_type", f"concat('start_', {key}) sink_table", "'dim' sink_type",
            "'info' sink_family", "'id,name' sink_columns", "'id' sink_row_key", "cast(null as string) sink_extend",
        )

    nation = tables("nation").where("n_nationkey < 12")
    return rows(tables("region"), "r_name", "r_regionkey").unionByName(
        rows(nation, "n_name", "n_nationkey")
    )


def log_lines(tables: Tables) -> DataFrame:
    """Events as behaviour-log lines, with broken and keyless lines among them."""
    events = tables.scattered("events").selectExpr(
        "*", "cast(get_json_object(props, '$.k') as int) k", "unix_millis(cast(ts as timestamp)) ms"
    )

    def only(kinds: str, value: str) -> str:
        return f"case when event_type in ({kinds}) then {value} end"

    record = f"""to_json(named_struct(
        'common', named_struct('mid', concat('m', user_id), 'is_new', case when k < 50 then '1' else '0' end,
                               'ch', event_type),
        'event', event_id,
        'ts', ms,
        'start', {only("'signup', 'purchase'", "named_struct('entry', 'icon', 'loading', k)")},
        'page', {only("'view', 'click', 'error', 'purchase'", "named_struct('page_id', concat('p', k))")},
        'displays', {only("'view', 'purchase'",
            "transform(sequence(0, k % 3), i -> named_struct('item', k + i, 'pos', i, 'ch', 'shadowed'))")},
        'action', {only("'click', 'purchase'",
            "array(named_struct('action_id', 'tap', 'item', k, 'ts', ms + 1))")},
        'err', {only("'error', 'purchase'", "named_struct('code', k + 1000)")}
    ))"""
    good = events.selectExpr(f"{record} value", "event_id position")
    broken = events.where("event_type = 'error'").selectExpr(
        "concat('{\"event\":', event_id, ',') value", "event_id position"
    )
    keyless = events.where("event_type = 'signup'").selectExpr(
        "to_json(named_struct('ts', ms, 'event', event_id)) value", "event_id position"
    )
    return union([good, broken, keyless])


def odd_log_lines(tables: Tables) -> DataFrame:
    """Events as behaviour-log lines with elements of lists, or values in their place, that are no objects."""
    return tables("events").selectExpr(
        """concat('{"common":{"mid":"m', user_id, '"},"ts":', event_id, ',"displays":[{"item":1},"x",null,', event_id, ',[2]],"action":',
            case when event_type = 'click' then '[{"item":1}]' when event_type = 'view' then '"none"' else 'null' end, '}') value""",
        "event_id position",
    )


def odd_config_lines(tables: Tables) -> DataFrame:
    """Config envelopes, and lines like them that are none."""
    odd = tables("nation").selectExpr(
        """case n_nationkey % 5 when 0 then concat('{"op":"c","after":{"source_table":"', n_name, '"') when 1 then concat('{"after":{"source_table":"', n_name, '"}}')
            when 2 then concat('{"op":"d","after":{"source_table":"', n_name, '"}}') when 3 then concat('[', n_nationkey, ']')
            else concat('{"op":"u","after":{"source_table":"', n_name, '"},"ts_ms":"soon"}') end value""",
        "cast(null as bigint) position",
    )
    return config_envelopes(tables).unionByName(odd)


def odd_cart_lines(tables: Tables) -> DataFrame:
    """Cart facts as JSON lines, and lines that are none."""
    return tables("events").selectExpr(
        """case event_type when 'click' then concat('{"id":"', event_id, '","sku_num":3,"ts":5}') when 'view' then concat('{"id":"', event_id, '","ts":"x"}')
            when 'error' then concat('{"id":', event_id) when 'signup' then concat('[', event_id, ']') else 'null' end value"""
    )


def change_lines(tables: Tables) -> DataFrame:
    """Cart changes as JSON lines, with broken lines among them."""
    carts = event_changes(tables, "cart_info").drop("et")
    lines = carts.select(
        F.to_json(F.struct("database", "table", "type", "data", "old", "ts", "seq")).alias("value"),
        F.lit(None).cast("bigint").alias("position"),
    )
    broken = tables("events").where("event_type = 'error'").selectExpr(
        "concat('{\"table\":\"cart_info\",\"ts\":', event_id) value", "cast(null as bigint) position"
    )
    return lines.unionByName(broken)


def visits(tables: Tables) -> DataFrame:
    """Events as visits of devices, for the new-visitor correction alone."""
    return tables("events").selectExpr(
        "concat('m', user_id) mid",
        "case when event_type = 'error' then null when event_type = 'click' then '0' else '1' end is_new",
        "unix_millis(cast(ts as timestamp)) ts",
        "event_id seq",
    )
