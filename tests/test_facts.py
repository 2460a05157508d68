"""J2-J8 on a small change log, with expected rows written by hand."""

import pytest
from logs import bag, change, changes_df
from shop import DICTIONARY, HISTORY, T0, detail, payment

from tidemart.plans import facts
from tidemart.schemas import FACT_COLUMNS, fact_schema
from tidemart.sources.topics import with_event_time


@pytest.fixture(scope="module")
def changes(spark):
    return changes_df(spark, HISTORY)


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame(DICTIONARY, "dic_code string, dic_name string")


def _head(key, order, sku, act=None, rule=None, cou=None):
    return (key, order, f"u{order}", sku, f"sku {sku}", "7", act, rule, cou)


_TAIL = ("3", "59.7000", "9.70", None, "50.00")
_DAY = ("2023-11-14", "2023-11-14 22:13:20")


def test_order_detail(changes):
    assert bag(facts.order_detail(changes)) == {
        (*_head("d1", "o1", "s1"), *_DAY, *_TAIL, T0): 1,
        (*_head("d2", "o1", "s2", "a-d2", "r1"), *_DAY, *_TAIL, T0 + 1): 1,
        (*_head("d3", "o1", "s3", "a-d3", "r1", "c-d3"), *_DAY, *_TAIL, T0): 1,
        (*_head("d4", "o2", "s1"), None, "junk", *_TAIL, T0 + 10): 1,
        (*_head(None, "o2", "s7"), *_DAY, "abc", None, "9.70", None, "50.00", T0 + 10): 1,
    }


@pytest.mark.parametrize("salts", [2, 7])
def test_order_detail_salted_is_the_same(changes, salts):
    assert bag(facts.order_detail(changes, salts=salts)) == bag(facts.order_detail(changes))


def test_order_cancel(changes):
    details = with_event_time(facts.order_detail(changes))
    day = ("2023-11-15", "2023-11-15 01:00:00")
    assert bag(facts.order_cancel(details, changes)) == {
        (*_head("d4", "o2", "s1"), *day, *_TAIL, T0 + 900): 1,
        (*_head(None, "o2", "s7"), *day, "abc", None, "9.70", None, "50.00", T0 + 900): 1,
    }


def test_payment_success(changes, dictionary):
    details = with_event_time(facts.order_detail(changes))
    paid = ("1101", "card", "2023-11-14 22:20:00")
    assert bag(facts.payment_success(details, changes, dictionary)) == {
        (*_head("d4", "o2", "s1"), *paid, *_TAIL, T0 + 101): 1,
        (*_head(None, "o2", "s7"), *paid, "abc", None, "9.70", None, "50.00", T0 + 101): 1,
    }


def test_payment_window_edges(spark, dictionary):
    offsets = {-1800: True, -1801: False, 5: True, 6: False, 0: True, -900: True}
    rows, inside = [], set()
    for base in (T0, T0 + 777, T0 + 1804):
        for offset, joins in offsets.items():
            key = f"{base}:{offset}"
            rows += [
                change("order_info", "insert", {"id": key, "user_id": "u", "province_id": "1"}, ts=base),
                detail(key, key, "s", base + offset),
                payment(key, base),
            ]
            if joins:
                inside.add(key)
    changes = changes_df(spark, rows)
    details = with_event_time(facts.order_detail(changes))
    for salts in (1, 3):
        found = facts.payment_success(details, changes, dictionary, salts=salts)
        assert sorted(r.order_id for r in found.collect()) == sorted(inside)


def test_order_refund(changes, dictionary):
    assert bag(facts.order_refund(changes, dictionary)) == {
        (
            "r1", "ru", "o1", "s1", "7", "2023-11-15", "2023-11-15 10:00:00", "1301", "return", "1401", "broken",
            "cracked", "2", "39.80", T0 + 1000,
        ): 1
    }


def test_refund_payment(changes, dictionary):
    expected = {
        (key, "uo1", "o1", sku, "7", "1101", "card", None, "junk", "2", "39.80", T0 + 2000): 1
        for key, sku in (("p1", "s1"), ("p2", "s2"))
    }
    assert bag(facts.refund_payment(changes, dictionary)) == expected
    assert bag(facts.refund_payment(changes, dictionary, salts=3)) == expected


def test_comment_info(changes, dictionary):
    assert bag(facts.comment_info(changes, dictionary)) == {
        ("k1", "cu", "s1", "1201", "good", "text k1", T0): 1
    }


def test_cart_add(changes):
    assert bag(facts.cart_add(changes)) == {
        ("b1", "cu", "s1", 2, T0): 1,
        ("b1", "cu", "s1", 3, T0): 1,
        ("b3", "cu", "s1", None, T0): 1,
    }


def test_output_contracts(changes, dictionary):
    details = with_event_time(facts.order_detail(changes))
    made = {
        "comment": facts.comment_info(changes, dictionary),
        "cart_add": facts.cart_add(changes),
        "order_detail": facts.order_detail(changes),
        "order_cancel": facts.order_cancel(details, changes),
        "payment_success": facts.payment_success(details, changes, dictionary),
        "order_refund": facts.order_refund(changes, dictionary),
        "refund_payment": facts.refund_payment(changes, dictionary),
    }
    for fact, df in made.items():
        assert df.columns == FACT_COLUMNS[fact]
        assert [f.dataType for f in df.schema] == [f.dataType for f in fact_schema(fact)]


def test_lookup_beyond_the_broadcast_bound(spark, changes, dictionary, monkeypatch):
    from tidemart.operators import joins

    expected = bag(facts.order_refund(changes, dictionary))
    monkeypatch.setattr(joins.is_small, "__defaults__", (2, 10))
    df = facts.order_refund(changes, dictionary)
    assert bag(df) == expected
