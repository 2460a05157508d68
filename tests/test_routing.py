"""Validity, routing and config state."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from logs import bag, change, changes_df

from tidemart.operators.changes import dimension_changes, fact_changes, rejected_changes
from tidemart.operators.routing import current_config, fact_messages, route_dimensions, route_facts
from tidemart.schemas import CONFIG_COLUMNS, CONFIG_DDL
from tidemart.sinks.keyed import keyless

KINDS = ["insert", "update", "delete", "bootstrap-insert", "bootstrap-start", None]


def test_validity(spark):
    rows = [change("t", kind, {"id": "bootstrap-insert"}) for kind in KINDS]
    rows += [change("t", "insert", None), change("t", "insert", {}), change("t", "insert", {"id": "1"}, database="other"),
             change("t", "insert", {"id": "1"}, database=None)]
    changes = changes_df(spark, rows)
    dims = dimension_changes(changes)
    assert bag(dims.selectExpr("type", "data['id']")) == {
        ("insert", "bootstrap-insert"): 2, ("update", "bootstrap-insert"): 1, ("delete", "bootstrap-insert"): 1,
    }
    assert bag(fact_changes(changes).select("type")) == {("insert",): 1, ("update",): 1}
    assert rejected_changes(changes).count() == len(rows) - 4


def config(spark, *rows):
    names = ["source_table", "source_type", "sink_table", "sink_type", "sink_columns", "sink_row_key"]
    full = [{c: dict(zip(names, row, strict=True)).get(c) for c in CONFIG_COLUMNS} for row in rows]
    return spark.createDataFrame([tuple(r.values()) for r in full], CONFIG_DDL)


def test_dimension_routes_cover_all_kinds_and_prune(spark):
    routes = config(spark, ("user", "ALL", "dim_user", "dim", "id, name", "key"), ("order", "insert", "x", "dim", "id", "id"))
    rows = [change("user", kind, {"id": "1", "name": "n", "phone": "p", "key": "k"}) for kind in KINDS[:4]]
    rows += [change("order", "insert", {"id": "1"}), change("other", "insert", {"id": "1"}),
             change("user", "insert", {"id": "2", "name": None})]
    routed = route_dimensions(changes_df(spark, rows), routes)
    flat = routed.selectExpr("sink_table", "row_key", "op_type", "to_json(map_from_entries(array_sort(map_entries(data))))")
    whole = '{"id":"1","name":"n"}'
    assert bag(flat) == {
        ("dim_user", "k", "insert", whole): 2, ("dim_user", "k", "update", whole): 1, ("dim_user", "k", "delete", whole): 1,
        ("dim_user", None, "insert", '{"id":"2","name":null}'): 1,
    }
    assert keyless(routed).count() == 1


def test_fact_routes_match_table_and_kind(spark):
    routes = config(spark, ("cart", "insert", "dwd_cart", "dwd", "id,n", None), ("cart", "update", "dwd_cart_u", "dwd", "n", None))
    rows = [change("cart", "insert", {"n": None, "id": "1", "z": "z"}), change("cart", "update", {"id": "1", "n": "2"}),
            change("cart", "delete", {"id": "1"}), change("cart", "bootstrap-insert", {"id": "1"})]
    assert bag(fact_messages(route_facts(changes_df(spark, rows), routes))) == {
        ("dwd_cart", '{"id":"1"}'): 1, ("dwd_cart_u", '{"n":"2"}'): 1,
    }


def test_config_too_large_to_broadcast_routes_the_same(spark, monkeypatch):
    from tidemart.operators import joins

    routes = config(spark, *[(f"t{i}", "ALL", f"d{i}", "dim", "id", "id") for i in range(9)])
    changes = changes_df(spark, [change(f"t{i % 12}", "insert", {"id": str(i)}) for i in range(50)])
    small = bag(route_dimensions(changes, routes).selectExpr("sink_table", "row_key"))
    monkeypatch.setattr(joins.is_small, "__defaults__", (2, 10))
    assert bag(route_dimensions(changes, routes).selectExpr("sink_table", "row_key")) == small


ops = st.lists(
    st.tuples(st.sampled_from("ab"), st.sampled_from(["ALL", "insert"]), st.sampled_from("rcud"), st.sampled_from(["dim", "dwd"])),
    max_size=12,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(history=ops, start=st.sets(st.sampled_from("abc")))
def test_config_state_against_a_dictionary(spark, history, start):
    state = {(t, "ALL"): f"start-{t}" for t in start}
    for i, (table, kind, op, sink_type) in enumerate(history):
        if sink_type != "dim":
            continue
        if op == "d":
            state.pop((table, kind), None)
        else:
            state[table, kind] = f"sink-{i}"
    rows = [(t, k, f"sink-{i}", s, None, "id", "id", None, op, i // 3, i) for i, (t, k, op, s) in enumerate(history)]
    changes = spark.createDataFrame(rows, CONFIG_DDL + ", op string, ts_ms bigint, seq bigint")
    snapshot = config(spark, *[(t, "ALL", f"start-{t}", "dim", "id", "id") for t in sorted(start)])
    got = current_config(changes, "dim", snapshot).select("source_table", "source_type", "sink_table").collect()
    assert {(r.source_table, r.source_type): r.sink_table for r in got} == state
