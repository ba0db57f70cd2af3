"""Record layouts on the wire (fixed values: field names, order and types)."""

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

PAGE_VIEW = StructType([
    StructField("user_id", StringType()),
    StructField("product_id", StringType()),
    StructField("ts_ms", LongType()),
    StructField("late", BooleanType()),
])

PURCHASE = StructType([
    StructField("user_id", StringType()),
    StructField("product_id", StringType()),
    StructField("amount_usd", DoubleType()),
    StructField("ts_ms", LongType()),
    StructField("fraud_hint", BooleanType()),
])

WINDOW_RESULT = StructType([
    StructField("kind", StringType()),
    StructField("window_start_ms", LongType()),
    StructField("window_end_ms", LongType()),
    StructField("count", LongType()),
    StructField("user_id", StringType()),
])

TOPK_RESULT = StructType([
    StructField("window_start_ms", LongType()),
    StructField("window_end_ms", LongType()),
    StructField("top", ArrayType(StructType([
        StructField("product_id", StringType()),
        StructField("count", LongType()),
    ]))),
])

MATCH = StructType([
    StructField("user_id", StringType()),
    StructField("product_id_viewed", StringType()),
    StructField("product_id_purchased", StringType()),
    StructField("view_ts", LongType()),
    StructField("purchase_ts", LongType()),
    StructField("delta_ms", LongType()),
    StructField("amount_usd", DoubleType()),
])

ALERT = StructType([
    StructField("user_id", StringType()),
    StructField("purchase_count", IntegerType()),
    StructField("total_amount_usd", DoubleType()),
    StructField("first_ts", LongType()),
    StructField("last_ts", LongType()),
    StructField("span_ms", LongType()),
])

# topic of a result stream -> message type shown to readers (fixed values)
RESULT_TOPICS = {
    "results.topk": "topk",
    "results.windows.tumbling": "tumbling",
    "results.windows.sliding": "sliding",
    "results.windows.sessions": "session",
    "results.joins": "join",
    "results.fraud": "fraud",
}
