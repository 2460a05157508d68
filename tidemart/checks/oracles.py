"""The same results in SQL, straight from the raw tables."""

_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_PRICE = "cast(l_extendedprice as decimal(16,2))"
_DISCOUNT = f"({_PRICE} * cast(l_discount as decimal(4,2)))"
_TEXT_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_DAY = "strftime({}, '%Y-%m-%d')"
_SECONDS = "(epoch_us({}) // 1000000)"
_MILLIS = "(epoch_us({}) // 1000)"
_K = "cast(json_extract_string(props, '$.k') as int)"


def _v(expr: str) -> str:
    return f"cast({expr} as varchar)"


_DETAIL_KEYS = f"""
    {_ID} AS id, {_v('l_orderkey')} AS order_id, {_v('o_custkey')} AS user_id,
    {_v('l_partkey')} AS sku_id, 'Part#' || l_partkey AS sku_name,
    o_orderpriority[1:1] AS province_id,
    CASE WHEN l_discount >= 0.05 THEN {_v('cast(l_discount as decimal(4,2))')} END AS activity_id,
    CASE WHEN l_discount >= 0.05 THEN {_v('l_linenumber')} END AS activity_rule_id,
    CASE WHEN l_returnflag = 'R' THEN 'C' || l_suppkey END AS coupon_id"""
_DETAIL_AMOUNTS = f"""
    {_v('cast(l_quantity as int)')} AS sku_num,
    {_v(f'cast(cast(l_quantity as int) as decimal(16,2)) * {_PRICE}')} AS split_original_amount,
    {_v(_DISCOUNT)} AS split_activity_amount,
    {_v(f'({_PRICE} * cast(l_tax as decimal(4,2)))')} AS split_coupon_amount,
    {_v(f'{_PRICE} - {_DISCOUNT}')} AS split_total_amount"""
_ORDER_DETAIL = f"""
SELECT {_DETAIL_KEYS}, {_DAY.format('l_shipdate')} AS date_id,
    {_TEXT_TIME.format('l_shipdate')} AS create_time, {_DETAIL_AMOUNTS},
    {_SECONDS.format('l_shipdate')} AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_PLACED = _ORDER_DETAIL.replace(
    "\nFROM lineitem", f",\n    {_SECONDS.format('o_orderdate')} + l_linenumber % 5 AS placed\nFROM lineitem"
)

_DICTIONARY = """dic AS (
    SELECT 'N' || n_nationkey AS code, n_name AS name FROM nation
    UNION ALL SELECT 'R' || r_regionkey, r_name FROM region)"""


def _payment(before: int) -> str:
    return f"""
WITH {_DICTIONARY},
od AS (SELECT *, {_K} AS k, {_SECONDS.format('ts')} AS s FROM events WHERE event_type = 'click'),
pi AS (SELECT *, {_K} AS k, {_SECONDS.format('ts')} AS s FROM events WHERE event_type = 'purchase')
SELECT {_v('od.event_id')} AS order_detail_id, {_v('od.user_id')} AS order_id, {_v('od.user_id')} AS user_id,
    {_v('od.k')} AS sku_id, 'click' AS sku_name, cast(NULL AS varchar) AS province_id,
    cast(NULL AS varchar) AS activity_id, cast(NULL AS varchar) AS activity_rule_id,
    cast(NULL AS varchar) AS coupon_id, 'N' || (pi.k % 30) AS payment_type_code, name AS payment_type_name,
    {_TEXT_TIME.format('pi.ts')} AS callback_time, '1' AS sku_num,
    {_v('cast(od.value as decimal(16,2))')} AS split_original_amount,
    cast(NULL AS varchar) AS split_activity_amount, cast(NULL AS varchar) AS split_coupon_amount,
    {_v('cast(od.value as decimal(16,2))')} AS split_payment_amount, pi.s AS ts
FROM pi JOIN od ON pi.user_id = od.user_id AND od.s >= pi.s - {before} AND od.s <= pi.s + 5
JOIN dic ON code = 'N' || (pi.k % 30)"""


_CART = f"""
SELECT {_v('event_id')} AS id, {_v('user_id')} AS user_id, {_v(_K)} AS sku_id,
    cast(CASE WHEN event_type IN ('click', 'purchase') THEN floor(value) ELSE floor(value) - {_K} END AS int) AS sku_num,
    {_SECONDS.format('ts')} AS ts
FROM events
WHERE event_type IN ('click', 'purchase') OR (event_type IN ('view', 'signup') AND floor(value) > {_K})"""

_ACCT = "cast(c_acctbal as decimal(16,2))"
_CUSTOMER = f"""
SELECT {_v('c_custkey')} AS row_key, {_v('c_custkey')} AS id,
    CASE WHEN c_nationkey < 2 THEN c_name || ' (back)' WHEN c_acctbal < 5000 THEN c_name || ' (renamed)'
         ELSE c_name END AS name,
    CASE WHEN c_nationkey < 2 THEN NULL
         WHEN c_acctbal < 5000 AND c_mktsegment <> 'BUILDING' THEN {_v(f'{_ACCT} + 1')}
         ELSE {_v(_ACCT)} END AS acctbal,
    CASE WHEN c_nationkey < 2 THEN NULL ELSE c_mktsegment END AS segment
FROM customer WHERE c_nationkey < 2 OR c_nationkey >= 5"""


def _log(output: str, select: str, kinds: str, extra: str = "") -> str:
    """Log records of some event kinds, with is_new corrected."""
    quoted = ", ".join(f"'{k}'" for k in kinds.split())
    return f"""
WITH numbered AS (
    SELECT *, {_K} AS k, {_MILLIS.format('ts')} AS ms,
        row_number() OVER (PARTITION BY user_id ORDER BY {_MILLIS.format('ts')}, event_id) AS rn
    FROM events),
{output} AS (
    SELECT 'm' || user_id AS mid, CASE WHEN k < 50 AND rn = 1 THEN '1' ELSE '0' END AS is_new,
        event_type AS ch, event_id, ms, k
    FROM numbered WHERE event_type IN ({quoted}))
SELECT {select} FROM {output} {extra}"""


_WHOLE = f"mid, is_new, ch, {_v('event_id')} AS event, {_v('ms')} AS ts"
_HAS_DISPLAYS = "cast(ch IN ('view', 'purchase') AS int) AS has_displays"

_VISITS = f"""WITH visits AS (
    SELECT 'm' || user_id AS mid,
        CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN '0' ELSE '1' END AS is_new,
        {_MILLIS.format('ts')} AS ts, event_id AS seq
    FROM events)"""

_CONFIG_FIELDS = """'ALL' AS source_type, {sink} AS sink_table, 'dim' AS sink_type, 'info' AS sink_family,
    'id,name' AS sink_columns, 'id' AS sink_row_key, cast(NULL AS varchar) AS sink_extend"""


def _counted(source: str, table: str, kind: str, fact: bool = True) -> list[str]:
    """Accepted counts of one kind of change, for dimensions and for facts."""
    plain = "insert" if kind == "bootstrap-insert" else kind
    out = [f"SELECT '{table}' AS \"table\", '{plain}' AS \"type\", 'dim' AS accepted_by, count(*) AS n FROM {source}"]
    if fact:
        out.append(f"SELECT '{table}', '{kind}', 'fact', count(*) FROM {source}")
    return out


def _change_validity() -> str:
    kinds = [
        ("lineitem", "order_detail", "insert", True),
        ("orders", "order_info", "insert", True),
        ("lineitem WHERE l_discount >= 0.05", "order_detail_activity", "insert", True),
        ("lineitem WHERE l_returnflag = 'R'", "order_detail_coupon", "insert", True),
        ("orders WHERE o_orderstatus IN ('F', 'O')", "order_info", "update", True),
        ("orders WHERE o_orderstatus = 'P'", "order_info", "update", True),
        ("orders WHERE o_orderstatus = 'P'", "order_info", "update", True),
        ("lineitem WHERE l_returnflag = 'R'", "order_refund_info", "insert", True),
        ("lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'", "order_refund_info", "update", True),
        ("lineitem WHERE l_returnflag = 'R'", "refund_payment", "update", True),
        ("events WHERE event_type IN ('click', 'purchase')", "cart_info", "insert", True),
        ("events WHERE event_type NOT IN ('click', 'purchase')", "cart_info", "update", True),
        ("events WHERE event_type = 'purchase'", "payment_info", "update", True),
        ("customer", "comment_info", "insert", True),
        ("customer", "customer", "bootstrap-insert", False),
        ("customer WHERE c_acctbal < 5000", "customer", "update", True),
        ("customer WHERE c_nationkey < 5", "customer", "delete", False),
        ("customer WHERE c_nationkey < 2", "customer", "insert", True),
        ("supplier", "supplier", "insert", True),
        ("part", "part", "update", True),
    ]
    parts = " UNION ALL ".join(s for k in kinds for s in _counted(*k))
    return f'SELECT "table", "type", accepted_by, cast(sum(n) AS bigint) AS n FROM ({parts}) GROUP BY ALL HAVING sum(n) > 0'


def oracle_sql() -> dict[str, str]:
    newest = f"""
WITH d AS ({_ORDER_DETAIL}),
both_versions AS (
    SELECT * FROM d
    UNION ALL BY NAME
    SELECT * REPLACE (ts + 60 AS ts, coupon_id || '-corrected' AS coupon_id) FROM d WHERE coupon_id IS NOT NULL)
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, activity_id DESC NULLS LAST) AS rn
    FROM both_versions)
WHERE rn = 1"""
    cancel = f"""
SELECT {_DETAIL_KEYS}, {_DAY.format('o_orderdate + INTERVAL 1 DAY')} AS date_id,
    {_TEXT_TIME.format('o_orderdate + INTERVAL 1 DAY')} AS cancel_time, {_DETAIL_AMOUNTS},
    {_SECONDS.format('o_orderdate')} + 86400 AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'"""
    placed = f"SELECT * EXCLUDE (placed) REPLACE (placed AS ts) FROM ({_PLACED})"
    placed_cancel = f"""
SELECT * EXCLUDE (o_orderstatus, o_orderkey) FROM (
    SELECT {_DETAIL_KEYS}, {_DAY.format('o_orderdate + INTERVAL 1 DAY')} AS date_id,
        {_TEXT_TIME.format('o_orderdate + INTERVAL 1 DAY')} AS cancel_time, {_DETAIL_AMOUNTS},
        {_SECONDS.format('o_orderdate')} + 600 AS ts, o_orderstatus, o_orderkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0"""
    complete = f"""
SELECT CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0 THEN 'joined' ELSE 'alone' END AS kind,
    'main' AS side, {_ID} AS id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT 'late', 'cancel', {_v('o_orderkey')} FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 10 = 0"""
    refund = f"""
WITH {_DICTIONARY}
SELECT {_ID} AS id, {_v('l_suppkey')} AS user_id, {_v('l_orderkey')} AS order_id, {_v('l_partkey')} AS sku_id,
    o_orderpriority[1:1] AS province_id, {_DAY.format('l_shipdate')} AS date_id,
    {_TEXT_TIME.format('l_shipdate')} AS create_time, d1.code AS refund_type_code, d1.name AS refund_type_name,
    d2.code AS refund_reason_type_code, d2.name AS refund_reason_type_name,
    'returned ' || l_linestatus AS refund_reason_txt, {_v('cast(l_quantity as int)')} AS refund_num,
    {_v(_PRICE)} AS refund_amount, {_SECONDS.format('l_shipdate')} AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN dic d1 ON d1.code = 'R' || l_linenumber JOIN dic d2 ON d2.code = 'N' || (l_suppkey % 30)
WHERE l_returnflag = 'R' AND o_orderstatus = 'P'"""
    refund_payment = f"""
WITH {_DICTIONARY}
SELECT concat_ws('-', a.l_orderkey, a.l_linenumber, a.l_partkey, a.l_suppkey) AS id, {_v('o_custkey')} AS user_id,
    {_v('a.l_orderkey')} AS order_id, {_v('a.l_partkey')} AS sku_id, o_orderpriority[1:1] AS province_id,
    code AS payment_type_code, name AS payment_type_name,
    {_DAY.format('a.l_shipdate + INTERVAL 2 DAY')} AS date_id,
    {_TEXT_TIME.format('a.l_shipdate + INTERVAL 2 DAY')} AS callback_time,
    {_v('cast(b.l_quantity as int)')} AS refund_num,
    {_v('cast(a.l_extendedprice as decimal(16,2))')} AS refund_amount, {_SECONDS.format('a.l_shipdate')} AS ts
FROM lineitem a
JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey
JOIN orders ON a.l_orderkey = o_orderkey JOIN dic ON code = 'N' || (a.l_linenumber * 4)
WHERE a.l_returnflag = 'R' AND a.l_tax < 0.06 AND b.l_returnflag = 'R' AND b.l_linestatus = 'F'
  AND o_orderstatus = 'P'"""
    comment = f"""
SELECT {_v('c_custkey')} AS id, {_v('c_custkey')} AS user_id, {_v('c_nationkey * 7')} AS sku_id,
    'N' || n_nationkey AS appraise, n_name AS appraise_name, c_name AS comment_txt, 1704067200 + c_custkey AS ts
FROM customer JOIN nation ON n_nationkey = c_nationkey + c_custkey % 10"""
    cart_messages = f"""
SELECT '{{"id":"' || id || '","user_id":"' || user_id || '","sku_id":"' || sku_id || '","sku_num":'
    || sku_num || ',"ts":' || ts || '}}' AS value FROM ({_CART})"""
    dim_merge = f"""
WITH customers AS ({_CUSTOMER})
SELECT 'dim_customer' AS sink_table, row_key, 'id' AS name, id AS value FROM customers
UNION ALL SELECT 'dim_customer', row_key, 'name', name FROM customers
UNION ALL SELECT 'dim_customer', row_key, 'acctbal', acctbal FROM customers WHERE acctbal IS NOT NULL
UNION ALL SELECT 'dim_customer', row_key, 'segment', segment FROM customers WHERE segment IS NOT NULL
UNION ALL SELECT 'dim_part', {_v('p_partkey')}, 'name', p_name FROM part
UNION ALL SELECT 'dim_part', {_v('p_partkey')}, 'brand', p_brand FROM part"""
    fact_route = f"""
SELECT 'dwd_supplier_join' AS topic, '{{"id":"' || s_suppkey || '","name":"' || s_name || '"}}' AS value FROM supplier
UNION ALL SELECT 'dwd_part_change',
    '{{"id":"' || p_partkey || '","brand":"' || p_brand || '","size":"' || p_size || '"}}' FROM part
UNION ALL SELECT 'dwd_customer_change', '{{"id":"' || c_custkey || '","name":"' || c_name || ' (renamed)"'
    || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',"acctbal":"' || ({_ACCT} + 1) || '"' END || '}}'
    FROM customer WHERE c_acctbal < 5000"""
    config_state = f"""
SELECT n_name AS source_table, {_CONFIG_FIELDS.format(sink="""CASE
        WHEN n_regionkey = 3 THEN 'third_' || n_nationkey
        WHEN n_regionkey = 1 THEN 'second_' || n_nationkey ELSE 'first_' || n_nationkey END""")}
FROM nation WHERE n_nationkey < 20 AND (n_regionkey NOT IN (2, 3) OR (n_regionkey = 3 AND n_nationkey > 10))
UNION ALL SELECT r_name, {_CONFIG_FIELDS.format(sink="'start_' || r_regionkey")} FROM region"""
    visitor = f"""
{_VISITS}
SELECT mid, CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid ORDER BY ts, seq) > 1 THEN '0'
    ELSE is_new END AS is_new, ts, seq FROM visits"""
    visitor_day = f"""
{_VISITS},
firsts AS (SELECT mid, first(CASE WHEN is_new = '1' THEN ts ELSE ts - 86400000 END ORDER BY ts, seq) AS visit
    FROM visits GROUP BY mid)
SELECT mid, CASE WHEN is_new = '1' AND visit // 86400000 <> ts // 86400000 THEN '0' ELSE is_new END AS is_new, ts, seq
FROM visits JOIN firsts USING (mid)"""
    log_quarantine = f"""
SELECT '{{"event":' || event_id || ',' AS value, 'not a JSON object' AS reason FROM events WHERE event_type = 'error'
UNION ALL SELECT '{{"ts":' || {_MILLIS.format('ts')} || ',"event":' || event_id || '}}', 'no device id'
FROM events WHERE event_type = 'signup'"""
    shown = {"start": "signup purchase", "display": "view purchase", "action": "click purchase", "err": "error purchase", "page": "view click error purchase"}
    positions = {"display": ", unnest(range(k % 3 + 1)) AS positions(pos)"}
    log_outputs = " UNION ALL ".join(
        f"SELECT * FROM ({_log('found', f'{chr(39)}{name}{chr(39)} AS output, mid, is_new, count(*) AS n', kinds, positions.get(name, '') + ' GROUP BY mid, is_new')})"
        for name, kinds in shown.items()
    )
    element_quarantine = """
SELECT 'm' || user_id AS mid, event_id AS ts, 'displays' AS key, unnest(['"x"', 'null', CAST(event_id AS VARCHAR), '[2]']) AS value FROM events
UNION ALL SELECT 'm' || user_id, event_id, 'action', '"none"' FROM events WHERE event_type = 'view'"""
    config_quarantine = """
SELECT CASE n_nationkey % 5 WHEN 0 THEN '{"op":"c","after":{"source_table":"' || n_name || '"' WHEN 1 THEN '{"after":{"source_table":"' || n_name || '"}}'
    WHEN 2 THEN '{"op":"d","after":{"source_table":"' || n_name || '"}}' WHEN 3 THEN '[' || n_nationkey || ']'
    ELSE '{"op":"u","after":{"source_table":"' || n_name || '"},"ts_ms":"soon"}' END AS value
FROM nation"""
    fact_quarantine = """
SELECT CASE WHEN event_type = 'click' THEN 'kept' ELSE 'rejected' END AS kind,
    CASE event_type WHEN 'click' THEN CAST(event_id AS VARCHAR) WHEN 'view' THEN '{"id":"' || event_id || '","ts":"x"}'
        WHEN 'error' THEN '{"id":' || event_id WHEN 'signup' THEN '[' || event_id || ']' ELSE 'null' END AS value
FROM events"""
    config_handover = f"SELECT * FROM ({config_state}) WHERE source_table IN (SELECT n_name FROM nation)"
    date_ids = f"""
SELECT event_id, {_DAY.format('ts')} AS "day", {_TEXT_TIME.format('ts')} AS "text",
    {_SECONDS.format('ts')} * 1000 - 28800000 AS millis, {_TEXT_TIME.format('ts')} AS event_time,
    CASE WHEN event_type <> 'error' THEN {_DAY.format('ts')} END AS day_of_text
FROM events"""
    sql = {
        "order_detail": _ORDER_DETAIL,
        "order_detail_salted": _ORDER_DETAIL,
        "order_detail_newest": newest,
        "order_cancel": cancel,
        "payment_success": _payment(1800),
        "payment_success_6h": _payment(6 * 3600),
        "order_refund": refund,
        "refund_payment": refund_payment,
        "comment_lookup": comment,
        "cart_add": _CART,
        "cart_add_from_json": _CART,
        "cart_add_messages": cart_messages,
        "change_quarantine": (
            "SELECT '{\"table\":\"cart_info\",\"ts\":' || event_id AS value FROM events WHERE event_type = 'error'"
        ),
        "change_validity": _change_validity(),
        "dim_merge": dim_merge,
        "dim_customer": _CUSTOMER,
        "fact_route": fact_route,
        "config_state": config_state,
        "new_visitor": visitor,
        "new_visitor_same_day": visitor_day,
        "log_start": _log(
            "starts",
            f"{_WHOLE}, 'icon' AS entry, {_v('k')} AS loading, cast(ch = 'purchase' AS int) AS has_displays, "
            "cast(ch = 'purchase' AS int) AS has_action, cast(ch = 'purchase' AS int) AS has_err",
            "signup purchase",
        ),
        "log_display": _log(
            "shown", f"mid, is_new, ch, {_v('k + pos')} AS item, {_v('ms')} AS ts, {_v('pos')} AS pos",
            "view purchase", ", unnest(range(k % 3 + 1)) AS positions(pos)",
        ),
        "log_action": _log(
            "acted", f"mid, is_new, ch, {_v('k')} AS item, {_v('ms + 1')} AS ts, 'tap' AS action_id", "click purchase",
        ),
        "log_err": _log(
            "failed",
            f"{_WHOLE}, {_v('k + 1000')} AS code, cast(ch = 'purchase' AS int) AS has_displays, "
            "0 AS has_action, 1 AS has_page",
            "error purchase",
        ),
        "log_page": _log(
            "paged", f"{_WHOLE}, 'p' || k AS page_id, {_HAS_DISPLAYS}, 0 AS has_action, 0 AS has_err",
            "view click error purchase",
        ),
        "log_quarantine": log_quarantine,
        "date_ids": date_ids,
    }
    streamed = (
        "payment_success order_detail order_refund refund_payment comment_lookup cart_add log_page log_display log_action "
        "new_visitor new_visitor_same_day dim_customer fact_route"
    )
    sql |= {
        "new_visitor_weekly": visitor,
        "new_visitor_same_day_weekly": visitor_day,
        "dim_compacted": _CUSTOMER,
        "log_outputs": log_outputs,
        "stream_log_outputs": log_outputs,
        "log_outputs_daily": log_outputs,
        "element_quarantine": element_quarantine,
        "config_quarantine": config_quarantine,
        "fact_quarantine": fact_quarantine,
        "config_handover": config_handover,
        "stream_config_state": config_state,
        "stream_order_detail_backlog": placed,
        "stream_order_detail_updating": placed,
        "stream_order_cancel": placed_cancel,
        "stream_order_cancel_complete": complete,
    }
    return {**sql, **{f"stream_{name}": sql[name] for name in streamed.split()}}
