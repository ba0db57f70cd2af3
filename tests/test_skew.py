"""One user or product with a third of all rows: same results, and the work is split."""

import pytest
from pyspark.sql import Window, functions as F

from tests.helpers import rows
from wakeline.operators import joins, patterns, windows
from wakeline.sources import activity as src

SF = "/root/testdata/sf0.01"
HOT = "7"
TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def tight(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    before = {key: spark.conf.get(key) for key in TIGHT}
    for key, value in TIGHT.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def hot(df):
    user = F.when(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0, F.lit(HOT)).otherwise(F.col("user_id"))
    return df.repartition(6).withColumn("user_id", user)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_one_large_cell_is_split_at_run_time(tight):
    # all events in one time cell, so that one user is one join key
    views = hot(src.page_views(tight, SF)).withColumn("ts", F.timestamp_millis(F.unix_millis("ts") % 10))
    bought = hot(src.purchases(tight, SF)).withColumn("ts", F.timestamp_millis(F.unix_millis("ts") % 10))
    joined = joins.interval_join(views, bought, 5, 5)
    totals = joined.agg(F.count("*"), F.sum("view_ts"), F.sum("purchase_ts"), F.sum(F.expr("cast(amount_usd AS decimal(18,2))")))
    got = totals.collect()
    assert "skew=true" in final_plan(totals)
    plain = views.alias("v").join(bought.alias("p"), F.expr(
        "v.user_id = p.user_id AND abs(unix_millis(p.ts) - unix_millis(v.ts)) <= 5"))
    assert got == plain.agg(F.count("*"), F.sum(F.unix_millis("v.ts")), F.sum(F.unix_millis("p.ts")),
                            F.sum(F.expr("cast(p.amount_usd AS decimal(18,2))"))).collect()
    assert got[0][0] > 100_000


@pytest.mark.parametrize("salts", [1, 4])
def test_hot_user_joins(tight, salts):
    views, bought = hot(src.page_views(tight, SF)), hot(src.purchases(tight, SF))
    got = joins.interval_join(views, bought, 60_000, 600_000, salts)
    plain = views.alias("v").join(bought.alias("p"), F.expr(
        "v.user_id = p.user_id AND unix_millis(p.ts) - unix_millis(v.ts) BETWEEN -60000 AND 600000"))
    assert got.count() == plain.count() > 50


def test_hot_user_sessions_and_bursts(tight):
    views, bought = hot(src.page_views(tight, SF)), hot(src.purchases(tight, SF))
    gap = 1_800_000
    builtin = (views.groupBy("user_id", F.session_window("ts", f"{gap} milliseconds").alias("w"))
               .agg(F.count("*").alias("count"), F.count_distinct("product_id").alias("products"))
               .select("user_id", F.unix_millis("w.start").alias("window_start_ms"), "count", "products"))
    got = windows.session_metrics(views, gap).select(*builtin.columns)
    assert rows(got, "*") == rows(builtin, "*")
    within = 3_600_000
    alerts = patterns.rapid_purchases(bought, 3, within)
    ranked = bought.withColumn("rn", F.row_number().over(
        Window.partitionBy("user_id").orderBy("ts", "product_id", "amount_usd"))).withColumn("t", F.unix_millis("ts"))
    pairs = ranked.alias("a").join(ranked.alias("b"), F.expr(
        f"a.user_id = b.user_id AND b.rn >= a.rn + 2 AND b.t - a.t < {within}")).select("a.user_id", "a.t", "b.t")
    assert rows(alerts, "user_id", "first_ts", "last_ts") == rows(pairs, "*")
    assert alerts.count() > 50
