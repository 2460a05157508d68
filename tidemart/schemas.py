"""Schemas of the inputs and column contracts of the outputs."""

from pyspark.sql import types as T

CHANGE_DDL = (
    "database string, table string, type string, "
    "data map<string,string>, old map<string,string>, ts bigint, seq bigint"
)

CONFIG_COLUMNS = [
    "source_table",
    "source_type",
    "sink_table",
    "sink_type",
    "sink_family",
    "sink_columns",
    "sink_row_key",
    "sink_extend",
]
CONFIG_DDL = ", ".join(f"{name} string" for name in CONFIG_COLUMNS)
ENVELOPE_DDL = (
    f"op string, before struct<{', '.join(f'{c}: string' for c in CONFIG_COLUMNS)}>, "
    f"after struct<{', '.join(f'{c}: string' for c in CONFIG_COLUMNS)}>, ts_ms bigint, seq bigint"
)

DICTIONARY_COLUMNS = ["dic_code", "dic_name"]

_DETAIL_HEAD = [
    "id",
    "order_id",
    "user_id",
    "sku_id",
    "sku_name",
    "province_id",
    "activity_id",
    "activity_rule_id",
    "coupon_id",
]
_SPLIT_AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount"]

# Sink column order of every fact; all are strings except those in NON_STRING.
FACT_COLUMNS = {
    "comment": ["id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts"],
    "cart_add": ["id", "user_id", "sku_id", "sku_num", "ts"],
    "order_detail": [
        *_DETAIL_HEAD, "date_id", "create_time", "sku_num", *_SPLIT_AMOUNTS, "split_total_amount", "ts",
    ],
    "order_cancel": [
        *_DETAIL_HEAD, "date_id", "cancel_time", "sku_num", *_SPLIT_AMOUNTS, "split_total_amount", "ts",
    ],
    "payment_success": [
        "order_detail_id", *_DETAIL_HEAD[1:], "payment_type_code", "payment_type_name",
        "callback_time", "sku_num", *_SPLIT_AMOUNTS, "split_payment_amount", "ts",
    ],
    "order_refund": [
        "id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time",
        "refund_type_code", "refund_type_name", "refund_reason_type_code",
        "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts",
    ],
    "refund_payment": [
        "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code",
        "payment_type_name", "date_id", "callback_time", "refund_num", "refund_amount", "ts",
    ],
}
NON_STRING = {("cart_add", "sku_num"): T.IntegerType()}


def fact_schema(fact: str) -> T.StructType:
    """Schema of a fact output, in sink column order."""
    return T.StructType(
        [
            T.StructField(c, T.LongType() if c == "ts" else NON_STRING.get((fact, c), T.StringType()))
            for c in FACT_COLUMNS[fact]
        ]
    )
