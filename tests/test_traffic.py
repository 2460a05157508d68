"""New-visitor correction and the five log outputs."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from logs import lines_df

from tidemart.operators.split import log_messages
from tidemart.operators.visitors import ARRIVAL, SAME_DAY, correct_visitors
from tidemart.plans.traffic import split_log

DAY = 86_400_000
VISITS = "mid string, is_new string, ts bigint, seq bigint"


def corrected(spark, visits, mode):
    df = spark.createDataFrame([(m, n, t, i) for i, (m, n, t) in enumerate(visits)], VISITS)
    return [r.is_new for r in correct_visitors(df, mode).orderBy("seq").collect()]


@pytest.mark.parametrize(
    "visits,arrival,same_day",
    [
        ([("1", 0), ("1", 1)], ["1", "0"], ["1", "1"]),
        ([("1", 0), ("1", DAY)], ["1", "0"], ["1", "0"]),
        ([("0", 0), ("1", 1)], ["0", "0"], ["0", "0"]),
        ([(None, 0), ("1", 1), (None, 2)], [None, "0", None], [None, "0", None]),
        ([("1", 5), ("1", 5)], ["1", "0"], ["1", "1"]),
        ([("1", 9), ("1", 5)], ["0", "1"], ["1", "1"]),
    ],
)
def test_visitor_cases(spark, visits, arrival, same_day):
    rows = [("m", flag, 20 * DAY + ts) for flag, ts in visits]
    assert corrected(spark, rows, ARRIVAL) == arrival
    assert corrected(spark, rows, SAME_DAY) == same_day


def test_repeated_lines_count_once(spark):
    """Lines alike in device, time and order are one first visit and later ones."""
    rows = [("m", "1", DAY, 5)] * 3 + [("n", "1", DAY, 5), ("n", "0", DAY + 1, 6)] + [("o", "0", DAY, 1)] * 2
    df = spark.createDataFrame(rows, VISITS)
    got = sorted((r.mid, r.is_new) for r in correct_visitors(df, ARRIVAL).collect())
    assert got == [("m", "0"), ("m", "0"), ("m", "1"), ("n", "0"), ("n", "1"), ("o", "0"), ("o", "0")]
    assert {r.is_new for r in correct_visitors(df.where("mid = 'm'"), SAME_DAY).collect()} == {"1"}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        corrected(spark, [("m", "1", 1)], "other")


visits = st.lists(
    st.tuples(st.sampled_from("ab"), st.sampled_from(["1", "0", None]), st.integers(DAY, 4 * DAY)), max_size=15
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(history=visits)
def test_visitors_against_a_loop(spark, history):
    for mode in (ARRIVAL, SAME_DAY):
        seen, expected = {}, [None] * len(history)
        for i in sorted(range(len(history)), key=lambda i: (history[i][2], i)):
            mid, flag, ts = history[i]
            known = mid in seen
            if not known:
                seen[mid] = ts // DAY if flag == "1" else ts // DAY - 1
            new_day = mode == SAME_DAY and seen[mid] == ts // DAY
            expected[i] = "0" if flag == "1" and known and not new_day else flag
        assert corrected(spark, history, mode) == expected


def outputs(spark, *records, **options):
    lines = lines_df(spark, [json.dumps(r) for r in records])
    return {
        name: [json.loads(r.value) for r in log_messages(df).collect()]
        for name, df in split_log(lines, **options).items()
    }


COMMON = {"mid": "m1", "is_new": "1", "ch": "store", "n": 3, "flag": True}
FULL = {
    "common": COMMON, "ts": 100, "start": {"entry": "icon"}, "page": {"page_id": "home"}, "err": {"code": 7},
    "displays": [{"item": "a", "ch": "shadowed", "ts": 1}, {"item": "b", "price": 1.25}],
    "action": [{"action_id": "tap", "ts": 101}], "extra": [1, {"x": None}],
}


def test_one_record_in_all_outputs(spark):
    out = outputs(spark, FULL)
    without = {k: v for k, v in FULL.items() if k != "action"}
    assert out["start"] == [FULL]
    assert sorted(out["display"], key=lambda d: d["item"]) == [
        {"item": "a", **COMMON, "ts": 100}, {"item": "b", "price": 1.25, **COMMON, "ts": 100},
    ]
    assert out["action"] == [{"action_id": "tap", "ts": 101, **COMMON}]
    assert out["err"] == [without]
    assert out["page"] == [{k: v for k, v in without.items() if k != "err"}]


def test_options(spark):
    renamed = {**FULL, "actions": FULL["action"]}
    out = outputs(spark, renamed, drop_displays=True, action_key="actions")
    assert all("displays" not in row for name in ("start", "err", "page") for row in out[name])
    assert len(out["action"]) == 1
    assert "actions" not in out["page"][0] and "action" in out["page"][0]


def test_nulls_are_absent(spark):
    record = {"common": COMMON, "ts": 1, "start": None, "page": None, "err": None, "displays": None, "action": None}
    assert outputs(spark, record) == {"start": [], "display": [], "action": [], "err": [], "page": []}
    out = outputs(spark, {"common": COMMON, "ts": 1, "page": {"p": 1}, "x": None, "displays": [], "action": [None]})
    assert out["page"] == [{"common": COMMON, "ts": 1, "page": {"p": 1}, "displays": []}]
    assert out["display"] == [] and out["action"] == []


def test_corrected_flag_reaches_every_output(spark):
    second = {**FULL, "ts": 200}
    out = outputs(spark, FULL, second)
    assert [r["common"]["is_new"] for r in sorted(out["page"], key=lambda r: r["ts"])] == ["1", "0"]
    assert sorted((r["ts"], r["is_new"]) for r in out["display"]) == [(100, "1")] * 2 + [(200, "0")] * 2
    assert sorted(r["is_new"] for r in out["action"]) == ["0", "1"]


def test_numeric_flag(spark):
    first = {"common": {"mid": "m", "is_new": 1}, "ts": 1, "page": {}}
    out = outputs(spark, first, {**first, "ts": 2})
    assert [r["common"]["is_new"] for r in sorted(out["page"], key=lambda r: r["ts"])] == [1, "0"]
