"""Fact plans (J2-J8). The same functions run on batch and streaming input.

``changes`` is the parsed change log with event time ``et``, or a function that gives one table's part. ``bound`` is the
event-time distance up to which changes still join; a stream needs one to let
go of its state, a batch run joins everything and leaves it out.

Facts with dictionary names come in two steps, the join and the naming. A stream
names each micro-batch with the dictionary as it stands then.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.constants import (
    DATABASE,
    INSERT,
    ORDER_CANCELLED,
    ORDER_PLACED,
    ORDER_REFUND_REQUESTED,
    ORDER_REFUNDED,
    PAYMENT_DONE,
    PAYMENT_WINDOW_AFTER,
    PAYMENT_WINDOW_BEFORE,
    REFUND_DONE,
    UPDATE,
)
from tidemart.functions.numbers import product_text
from tidemart.functions.times import day_of_text
from tidemart.operators.changes import Changes, Slice, added, added_amount, of_table
from tidemart.operators.joins import inner_join, inner_join_by_key, interval_join, is_small, left_join, lookup, spread_key
from tidemart.schemas import DICTIONARY_COLUMNS, FACT_COLUMNS

COMMENT = Slice(
    "ci", "comment_info", (INSERT,), ("id", "user_id", "sku_id", "appraise", "comment_txt"),
)
ORDER_DETAIL = Slice(
    "od", "order_detail", (INSERT,),
    (
        "id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price",
        "split_total_amount", "split_activity_amount", "split_coupon_amount",
    ),
)
ORDER = Slice("oi", "order_info", (INSERT,), ("id", "user_id", "province_id"))
ACTIVITY = Slice(
    "act", "order_detail_activity", (INSERT,), ("order_detail_id", "activity_id", "activity_rule_id"),
)
COUPON = Slice("cou", "order_detail_coupon", (INSERT,), ("order_detail_id", "coupon_id"))
CANCEL = Slice(
    "oc", "order_info", (UPDATE,), ("id", "operate_time"),
    moved=("order_status", ORDER_CANCELLED, ORDER_PLACED),
)
PAYMENT = Slice(
    "pi", "payment_info", (UPDATE,), ("order_id", "payment_type", "callback_time"),
    moved=("payment_status", PAYMENT_DONE, None),
)
REFUND_REQUEST = Slice(
    "ri", "order_refund_info", (INSERT,),
    (
        "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
        "refund_reason_type", "refund_reason_txt", "create_time",
    ),
)
REFUND_ORDER = Slice(
    "oi", "order_info", (UPDATE,), ("id", "province_id"),
    moved=("order_status", ORDER_REFUND_REQUESTED, None),
)
REFUND_PAYMENT = Slice(
    "rp", "refund_payment", (UPDATE,),
    ("id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"),
    moved=("refund_status", PAYMENT_DONE, None),
)
REFUND_CLOSED = Slice(
    "ori", "order_refund_info", (UPDATE,), ("order_id", "sku_id", "refund_num"),
    moved=("refund_status", REFUND_DONE, None),
)
REFUNDED_ORDER = Slice(
    "oi", "order_info", (UPDATE,), ("id", "user_id", "province_id"),
    moved=("order_status", ORDER_REFUNDED, None),
)


def _fact(df: DataFrame, fact: str, *more: str, **columns) -> DataFrame:
    """Select sink columns of a fact in order, each from its source, then ``more``; names to look up are left out."""
    picked = [(columns[name], name) for name in FACT_COLUMNS[fact] if name in columns]
    return df.select(*[(F.col(e) if isinstance(e, str) else e).alias(name) for e, name in picked], *more)


def _named(df: DataFrame, dictionary: DataFrame, fact: str, **codes: str) -> DataFrame:
    """Look up the names of codes; ``codes`` maps name columns to code columns."""
    dictionary = dictionary.select(*DICTIONARY_COLUMNS)
    small = is_small(dictionary)
    for name, code in codes.items():
        df = lookup(df, dictionary, code, name, small)
    return df.select(*FACT_COLUMNS[fact])


def rated_comments(changes: Changes, database: str = DATABASE) -> DataFrame:
    """Comments before their rating is named."""
    return _fact(
        COMMENT.read(changes, database), "comment", id="ci_id", user_id="ci_user_id", sku_id="ci_sku_id",
        appraise="ci_appraise", comment_txt="ci_comment_txt", ts="ci_ts",
    )


def name_comments(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    return _named(comments, dictionary, "comment", appraise_name="appraise")


def comment_info(changes: Changes, dictionary: DataFrame, database: str = DATABASE) -> DataFrame:
    """Comments with the name of their rating."""
    return name_comments(rated_comments(changes, database), dictionary)


def cart_add(changes: Changes, database: str = DATABASE) -> DataFrame:
    """Items put into a cart; a raised quantity counts with its increase."""
    kept = of_table(changes, "cart_info", database).where(added("sku_num"))
    data = F.col("data")
    return _fact(
        kept, "cart_add", id=data["id"], user_id=data["user_id"], sku_id=data["sku_id"],
        sku_num=added_amount("sku_num"), ts="ts",
    )


def order_detail(
    changes: Changes, database: str = DATABASE, bound: str | None = None, salts: int = 1, among: DataFrame | None = None
) -> DataFrame:
    """Ordered items with their order, activity and coupon (J4), of all orders or those whose ids are the column of ``among``.

    Both left joins come first: they share the partitioning by detail id, and
    the inner join filters the same rows wherever it stands. Without a bound a
    batch joins the orders to ids only and brings them to the details, so whole
    details are shuffled once.
    """
    detail = ORDER_DETAIL.read(changes, database).withColumn(
        "od_key", spread_key("od_id", "od_order_id", "od_sku_id", "od_create_time", "od_ts")
    )
    order = ORDER.read(changes, database).drop("oi_ts")
    if among is not None:
        order = order.join(among, F.col("oi_id") == F.col(among.columns[0]), "left_semi")
    once = bound is None and not detail.isStreaming
    # An id that is its own key need not be shuffled twice.
    left = detail.withColumn("od_named", F.col("od_id").isNotNull()).drop("od_id") if once else detail
    with_activity = left_join(
        left, ACTIVITY.read(changes, database).drop("act_ts"), ("od_key", "act_order_detail_id"),
        times=("od_et", "act_et"), bound=bound,
    )
    with_coupon = left_join(
        with_activity, COUPON.read(changes, database).drop("cou_ts"), ("od_key", "cou_order_detail_id"),
        times=("od_et", "cou_et"), bound=bound,
    )
    if once:
        joined = inner_join_by_key(with_coupon, detail, order.drop("oi_et"), "od_key", ("od_order_id", "oi_id"), salts)
        return detail_fact(joined.withColumn("od_id", F.when(F.col("od_named"), F.col("od_key"))))
    joined = inner_join(
        with_coupon, order, [("od_order_id", "oi_id")], times=("od_et", "oi_et"), bound=bound, salts=salts,
    )
    return detail_fact(joined)


def order_detail_by_id(changes: Changes, database: str = DATABASE) -> DataFrame:
    """The same for a batch that goes on by detail id: orders are joined first, so that the result stays partitioned by id."""
    joined = inner_join(
        ORDER_DETAIL.read(changes, database), ORDER.read(changes, database).drop("oi_ts"), [("od_order_id", "oi_id")],
        times=("od_et", "oi_et"),
    )
    for side, key in ((ACTIVITY, "act"), (COUPON, "cou")):
        rows = side.read(changes, database).drop(f"{key}_ts")
        joined = left_join(joined, rows, ("od_id", f"{key}_order_detail_id"), times=("od_et", f"{key}_et"))
    return detail_fact(joined)


def detail_fact(joined: DataFrame, *more: str) -> DataFrame:
    """Sink columns of details with their order, activity and coupon."""
    return _fact(
        joined, "order_detail", *more, id="od_id", order_id="od_order_id", user_id="oi_user_id",
        sku_id="od_sku_id", sku_name="od_sku_name", province_id="oi_province_id",
        activity_id="act_activity_id", activity_rule_id="act_activity_rule_id",
        coupon_id="cou_coupon_id", date_id=day_of_text(F.col("od_create_time")),
        create_time="od_create_time", sku_num="od_sku_num",
        split_original_amount=product_text(F.col("od_sku_num"), F.col("od_order_price")),
        split_activity_amount="od_split_activity_amount",
        split_coupon_amount="od_split_coupon_amount",
        split_total_amount="od_split_total_amount", ts="od_ts",
    )


def cancelled_orders(changes: Changes, database: str = DATABASE) -> DataFrame:
    """Ids of orders that were cancelled."""
    return CANCEL.read(changes, database).select("oc_id")


def order_cancel(
    details: DataFrame, changes: Changes, database: str = DATABASE, bound: str | None = None, salts: int = 1
) -> DataFrame:
    """Ordered items whose order was cancelled (J5). ``details`` carries ``et``."""
    joined = inner_join(
        details, CANCEL.read(changes, database), [("order_id", "oc_id")],
        times=("et", "oc_et"), bound=bound, salts=salts,
    )
    return cancel_fact(joined)


def cancel_fact(joined: DataFrame) -> DataFrame:
    """Sink columns of details with the cancel of their order."""
    same = {c: c for c in FACT_COLUMNS["order_cancel"]}
    return _fact(
        joined, "order_cancel",
        **{
            **same,
            "date_id": day_of_text(F.col("oc_operate_time")),
            "cancel_time": "oc_operate_time",
            "ts": "oc_ts",
        },
    )


def paid_details(
    details: DataFrame,
    changes: Changes,
    database: str = DATABASE,
    before: int = PAYMENT_WINDOW_BEFORE,
    after: int = PAYMENT_WINDOW_AFTER,
    salts: int = 1,
) -> DataFrame:
    """Ordered items paid within the payment window, before the payment type is named.

    ``details`` carries ``et``.
    """
    joined = interval_join(
        details, PAYMENT.read(changes, database), ("order_id", "pi_order_id"), times=("et", "pi_et"),
        before=before, after=after, salts=salts,
    )
    same = {c: c for c in FACT_COLUMNS["payment_success"] if c != "payment_type_name"}
    return _fact(
        joined, "payment_success",
        **{
            **same,
            "order_detail_id": "id",
            "payment_type_code": "pi_payment_type",
            "callback_time": "pi_callback_time",
            "split_payment_amount": "split_total_amount",
            "ts": "pi_ts",
        },
    )


def name_payments(paid: DataFrame, dictionary: DataFrame) -> DataFrame:
    return _named(paid, dictionary, "payment_success", payment_type_name="payment_type_code")


def payment_success(
    details: DataFrame,
    changes: Changes,
    dictionary: DataFrame,
    database: str = DATABASE,
    before: int = PAYMENT_WINDOW_BEFORE,
    after: int = PAYMENT_WINDOW_AFTER,
    salts: int = 1,
) -> DataFrame:
    """Ordered items paid within the payment window."""
    return name_payments(paid_details(details, changes, database, before, after, salts), dictionary)


def requested_refunds(
    changes: Changes, database: str = DATABASE, bound: str | None = None, salts: int = 1
) -> DataFrame:
    """Requested refunds with their order, before kind and reason are named."""
    joined = inner_join(
        REFUND_REQUEST.read(changes, database), REFUND_ORDER.read(changes, database).drop("oi_ts"),
        [("ri_order_id", "oi_id")], times=("ri_et", "oi_et"), bound=bound, salts=salts,
    )
    return _fact(
        joined, "order_refund", id="ri_id", user_id="ri_user_id", order_id="ri_order_id",
        sku_id="ri_sku_id", province_id="oi_province_id",
        date_id=day_of_text(F.col("ri_create_time")), create_time="ri_create_time",
        refund_type_code="ri_refund_type", refund_reason_type_code="ri_refund_reason_type",
        refund_reason_txt="ri_refund_reason_txt", refund_num="ri_refund_num",
        refund_amount="ri_refund_amount", ts="ri_ts",
    )


def name_refunds(refunds: DataFrame, dictionary: DataFrame) -> DataFrame:
    return _named(
        refunds, dictionary, "order_refund",
        refund_type_name="refund_type_code", refund_reason_type_name="refund_reason_type_code",
    )


def order_refund(
    changes: Changes, dictionary: DataFrame, database: str = DATABASE, bound: str | None = None, salts: int = 1
) -> DataFrame:
    """Requested refunds with their order and the names of kind and reason."""
    return name_refunds(requested_refunds(changes, database, bound, salts), dictionary)


def paid_refunds(
    changes: Changes, database: str = DATABASE, bound: str | None = None, salts: int = 1
) -> DataFrame:
    """Paid-out refunds with their request and order, before the payment type is named."""
    with_request = inner_join(
        REFUND_PAYMENT.read(changes, database), REFUND_CLOSED.read(changes, database).drop("ori_ts"),
        [("rp_order_id", "ori_order_id"), ("rp_sku_id", "ori_sku_id")],
        times=("rp_et", "ori_et"), bound=bound, salts=salts,
    )
    joined = inner_join(
        with_request, REFUNDED_ORDER.read(changes, database).drop("oi_ts"), [("rp_order_id", "oi_id")],
        times=("rp_et", "oi_et"), bound=bound, salts=salts,
    )
    return _fact(
        joined, "refund_payment", id="rp_id", user_id="oi_user_id", order_id="rp_order_id",
        sku_id="rp_sku_id", province_id="oi_province_id", payment_type_code="rp_payment_type",
        date_id=day_of_text(F.col("rp_callback_time")), callback_time="rp_callback_time",
        refund_num="ori_refund_num", refund_amount="rp_total_amount", ts="rp_ts",
    )


def name_paid_refunds(refunds: DataFrame, dictionary: DataFrame) -> DataFrame:
    return _named(refunds, dictionary, "refund_payment", payment_type_name="payment_type_code")


def refund_payment(
    changes: Changes, dictionary: DataFrame, database: str = DATABASE, bound: str | None = None, salts: int = 1
) -> DataFrame:
    """Paid-out refunds with their request, order and payment type."""
    return name_paid_refunds(paid_refunds(changes, database, bound, salts), dictionary)
