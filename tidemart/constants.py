"""Names and codes shared by all jobs."""

# Topic names, change kinds and status codes that the input data
# and the consumers of the outputs rely on.
TOPIC_CHANGES = "ods_db"
TOPIC_BEHAVIOUR = "ods_log"
TOPIC_TRAFFIC_START = "dwd_traffic_start"
TOPIC_TRAFFIC_ERR = "dwd_traffic_err"
TOPIC_TRAFFIC_PAGE = "dwd_traffic_page"
TOPIC_TRAFFIC_ACTION = "dwd_traffic_action"
TOPIC_TRAFFIC_DISPLAY = "dwd_traffic_display"
TOPIC_COMMENT = "dwd_interaction_comment_info"
TOPIC_CART_ADD = "dwd_trade_cart_add"
TOPIC_ORDER_DETAIL = "dwd_trade_order_detail"
TOPIC_ORDER_CANCEL = "dwd_trade_order_cancel"
TOPIC_PAYMENT_SUCCESS = "dwd_trade_order_payment_success"
TOPIC_ORDER_REFUND = "dwd_trade_order_refund"
TOPIC_REFUND_PAYMENT = "dwd_trade_refund_payment_success"
DIM_DICTIONARY = "dim_base_dic"

INSERT = "insert"
UPDATE = "update"
DELETE = "delete"
BOOTSTRAP_INSERT = "bootstrap-insert"
ANY_TYPE = "ALL"
SINK_DIM = "dim"
SINK_FACT = "dwd"

ORDER_PLACED = "1001"
ORDER_CANCELLED = "1003"
ORDER_REFUND_REQUESTED = "1005"
ORDER_REFUNDED = "1006"
PAYMENT_DONE = "1602"
REFUND_DONE = "0705"

PAYMENT_WINDOW_BEFORE = 30 * 60  # seconds an order may precede its payment
PAYMENT_WINDOW_AFTER = 5  # seconds an order may follow its payment
WATERMARK = "3 seconds"
TRIGGER = "3 seconds"
# Event-time distance within which two changes still join in a stream.
BOUND_ORDER_DETAIL = "5 seconds"
BOUND_ORDER_CANCEL = "1805 seconds"
BOUND_REFUND_PAYMENT = "5 seconds"
BOUND_ORDER_REFUND = "1 day"
# The same for joins that keep account of every row, in seconds.
SECONDS_ORDER_DETAIL = 5
SECONDS_ORDER_CANCEL = 1805

# The shop database whose changes are processed unless a job names another.
DATABASE = "shop"
