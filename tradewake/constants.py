"""Topic names, keyword sources and business codes."""

from __future__ import annotations

# Topics that link the layers.
TOPIC_RAW_LOG = "baselog"
TOPIC_CDC = "basedb"
TOPIC_START_LOG = "dwd_start_log"
TOPIC_DISPLAY_LOG = "dwd_display_log"
TOPIC_PAGE_LOG = "dwd_page_log"
TOPIC_QUARANTINE = "dwd_quarantine"
TOPIC_ORDER_INFO = "dwd_order_info"
TOPIC_ORDER_DETAIL = "dwd_order_detail"
TOPIC_PAYMENT_INFO = "dwd_payment_info"
TOPIC_FAVOR_INFO = "dwd_favor_info"
TOPIC_CART_INFO = "dwd_cart_info"
TOPIC_REFUND_INFO = "dwd_order_refund_info"
TOPIC_COMMENT_INFO = "dwd_comment_info"
TOPIC_UNIQUE_VISIT = "dwm_unique_visit"
TOPIC_USER_JUMP = "dwm_user_jump_detail"
TOPIC_ORDER_WIDE = "dwm_order_wide"
TOPIC_PAYMENT_WIDE = "dwm_payment_wide"
TOPIC_VISITOR_STATS = "dws_visitor_stats"
TOPIC_PRODUCT_STATS = "dws_product_stats"

# Pages and display items that carry products or searches.
PAGE_SEARCH = "good_list"
PAGE_DETAIL = "good_detail"
DISPLAY_SKU = "sku_id"

# Sink types of the routing table.
SINK_DIM = "hbase"
SINK_FACT = "kafka"
SINK_STATS = "clickhouse"

# Keyword sources.
KEYWORD_SEARCH = "SEARCH"
KEYWORD_CLICK = "CLICK"
KEYWORD_CART = "CART"
KEYWORD_ORDER = "ORDER"

# Fixed values: (code, domain, label).
CODES = [
    ("1001", "order_status", "unpaid"),
    ("1002", "order_status", "paid"),
    ("1003", "order_status", "cancelled"),
    ("1004", "order_status", "finished"),
    ("1005", "order_status", "refunding"),
    ("1006", "order_status", "refunded"),
    ("1101", "payment_type", "alipay"),
    ("1102", "payment_type", "wechat"),
    ("1103", "payment_type", "unionpay"),
    ("1201", "appraise", "good"),
    ("1202", "appraise", "fair"),
    ("1203", "appraise", "bad"),
    ("1204", "appraise", "automatic"),
    ("1301", "refund_reason", "quality problem"),
    ("1302", "refund_reason", "differs from description"),
    ("1303", "refund_reason", "out of stock"),
    ("1304", "refund_reason", "wrong size"),
    ("1305", "refund_reason", "ordered by mistake"),
    ("1306", "refund_reason", "no longer wanted"),
    ("1307", "refund_reason", "other"),
    ("1401", "coupon_status", "unused"),
    ("1402", "coupon_status", "in use"),
    ("1403", "coupon_status", "used"),
    ("1501", "refund_type", "money only"),
    ("1502", "refund_type", "money and goods"),
    ("2401", "source_type", "user query"),
    ("2402", "source_type", "promotion"),
    ("2403", "source_type", "recommendation"),
    ("2404", "source_type", "campaign"),
    ("3101", "activity_rule", "amount off"),
    ("3102", "activity_rule", "quantity discount"),
    ("3103", "activity_rule", "discount"),
    ("3201", "coupon_type", "amount off"),
    ("3202", "coupon_type", "quantity discount"),
    ("3203", "coupon_type", "voucher"),
    ("3301", "coupon_range", "category"),
    ("3302", "coupon_range", "trademark"),
    ("3303", "coupon_range", "product"),
]
APPRAISE_GOOD = "1201"
