"""The registered queries as plain SQL over the stored tables, written without the library's
pre-aggregation, bucketing and chunking so that they check it."""

from __future__ import annotations

HOUR = 3_600_000
DAY = 24 * HOUR

_ACT = """act AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
         'product_' || regexp_extract(props, '"k": *([0-9]+)', 1) AS product_id,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
         value AS amount_usd, epoch_us(ts) // 1000 AS ts_ms
  FROM events),
v AS (SELECT * FROM act WHERE event_type = 'view'),
p AS (SELECT * FROM act WHERE event_type = 'purchase')"""


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((_ACT,) + ctes) + "\n" + body


def _tumbling(source: str, size: int, key: str = "") -> str:
    cols = f", {key}" if key else ""
    return (f"SELECT ts_ms // {size} * {size} AS window_start_ms, ts_ms // {size} * {size} + {size} AS window_end_ms"
            f"{cols}, count(*) AS count FROM {source} GROUP BY ALL")


def _sliding(source: str, size: int, slide: int, key: str = "") -> str:
    cols = f", {key}" if key else ""
    return (f"SELECT ts_ms // {slide} * {slide} - i * {slide} AS window_start_ms, "
            f"ts_ms // {slide} * {slide} - i * {slide} + {size} AS window_end_ms{cols}, count(*) AS count "
            f"FROM {source} CROSS JOIN range({size // slide}) r(i) GROUP BY ALL")


def _board(counts: str, k: int = 10) -> str:
    return (f"SELECT * FROM (SELECT window_start_ms, window_end_ms, CAST(row_number() OVER (PARTITION BY window_start_ms "
            f"ORDER BY count DESC, product_id) AS INTEGER) AS rank, product_id, count FROM ({counts})) WHERE rank <= {k}")


_GAP = 6 * HOUR
_SESSIONS = f"""sess_rows AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS sid FROM (
    SELECT *, CASE WHEN ts_ms - lag(ts_ms) OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) <= {_GAP}
              THEN 0 ELSE 1 END AS opens FROM v)),
sess AS (
  SELECT min(ts_ms) AS window_start_ms, max(ts_ms) + {_GAP} AS window_end_ms, user_id, count(*) AS count,
         max(ts_ms) - min(ts_ms) AS duration_ms, count(DISTINCT product_id) AS products
  FROM sess_rows GROUP BY user_id, sid)"""

_TUMBLING = "tumbling AS (" + _tumbling("v", HOUR) + ")"
_SLIDING = "sliding AS (" + _sliding("v", 3 * HOUR, HOUR) + ")"
_UNION = """unioned AS (
  SELECT 'tumbling' AS kind, window_start_ms, window_end_ms, count, CAST(NULL AS VARCHAR) AS user_id FROM tumbling
  UNION ALL SELECT 'sliding', window_start_ms, window_end_ms, count, NULL FROM sliding
  UNION ALL SELECT 'session', window_start_ms, window_end_ms, count, user_id FROM sess)"""
_BOARD = "board AS (" + _board(_tumbling("v", DAY, "product_id")) + ")"


def _match(before: int, after: int) -> str:
    return f"""matches AS (
  SELECT v.user_id, v.product_id AS product_id_viewed, p.product_id AS product_id_purchased, v.ts_ms AS view_ts,
         p.ts_ms AS purchase_ts, p.ts_ms - v.ts_ms AS delta_ms, p.amount_usd
  FROM v JOIN p ON v.user_id = p.user_id AND p.ts_ms BETWEEN v.ts_ms - {before} AND v.ts_ms + {after})"""


def _alerts(where: str = "true", name: str = "alerts") -> str:
    return f"""ranked AS (
  SELECT *, row_number() OVER w AS rn, sum(CAST(amount_usd AS DECIMAL(38, 9))) OVER w AS cum
  FROM p WHERE {where} WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, event_id)),
{name} AS (
  SELECT b.user_id, CAST(b.rn - a.rn + 1 AS INTEGER) AS purchase_count,
         CAST(b.cum - a.cum + CAST(a.amount_usd AS DECIMAL(38, 9)) AS DOUBLE) AS total_amount_usd,
         a.ts_ms AS first_ts, b.ts_ms AS last_ts, b.ts_ms - a.ts_ms AS span_ms
  FROM ranked a JOIN ranked b ON a.user_id = b.user_id AND b.rn >= a.rn + 2 AND b.ts_ms < a.ts_ms + {DAY})"""


_LOG = f"""log AS (
  SELECT event_id, user_id, product_id, k % 4 AS part, event_id // 50 AS batch, ts_ms AS arrival_ms,
         CASE WHEN event_id % 5 = 0 THEN ts_ms - event_id * 7919 % 21600000 ELSE ts_ms END AS ts_ms
  FROM act),
marks AS (
  SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {HOUR} AS watermark_ms
  FROM (SELECT batch, max(ts_ms) AS top FROM log GROUP BY batch)),
replay AS (
  SELECT log.*, watermark_ms, coalesce(ts_ms < watermark_ms, false) AS is_late,
         CASE WHEN watermark_ms IS NOT NULL THEN greatest(0, arrival_ms - watermark_ms) END AS lag_ms,
         ts_ms // {HOUR} * {HOUR} AS window_start_ms, ts_ms // {HOUR} * {HOUR} + {HOUR} AS window_end_ms
  FROM log JOIN marks USING (batch))"""

_TOP_JSON = """SELECT '{"window_start_ms":' || window_start_ms || ',"window_end_ms":' || window_end_ms || ',"top":['
  || string_agg('{"product_id":"' || product_id || '","count":' || count || '}', ',' ORDER BY rank)
  || ']}' AS value FROM board GROUP BY window_start_ms, window_end_ms"""
_WINDOW_JSON = """SELECT kind, '{"kind":"' || kind || '","window_start_ms":' || window_start_ms || ',"window_end_ms":'
  || window_end_ms || ',"count":' || count || ',"user_id":' || coalesce('"' || user_id || '"', 'null') || '}' AS value
  FROM unioned"""
_FEED = f"""SELECT 'topk' AS type, value AS payload FROM ({_TOP_JSON})
UNION ALL SELECT kind, value FROM ({_WINDOW_JSON})
UNION ALL SELECT 'join', '{{"user_id":"' || user_id || '","product_id_viewed":"' || product_id_viewed
  || '","product_id_purchased":"' || product_id_purchased || '","view_ts":' || view_ts || ',"purchase_ts":' || purchase_ts
  || ',"delta_ms":' || delta_ms || ',"amount_usd":' || amount_usd || '}}' FROM matches
UNION ALL SELECT 'fraud', '{{"user_id":"' || user_id || '","purchase_count":' || purchase_count || ',"total_amount_usd":'
  || total_amount_usd || ',"first_ts":' || first_ts || ',"last_ts":' || last_ts || ',"span_ms":' || span_ms || '}}'
  FROM alerts"""

_PLACED = r"""typed AS (
  SELECT type, CAST(regexp_extract(payload, '"(window_end_ms|purchase_ts|last_ts)":([0-9]+)', 2) AS BIGINT) AS result_ms,
         CAST(regexp_extract(payload, '"(window_start_ms|view_ts|first_ts)":([0-9]+)', 2) AS BIGINT) AS start_ms,
         nullif(regexp_extract(payload, '"user_id":"([^"]*)"', 1), '') AS user_id, payload FROM feed),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY result_ms DESC, start_ms DESC, user_id, payload) AS INTEGER)
            AS position FROM typed)"""

_CONVERSION = """SELECT count(*) AS matches, CAST(coalesce(sum(CAST(same AS INTEGER)), 0) AS BIGINT) AS same_product,
  CAST(sum(CAST(same AS INTEGER)) AS DOUBLE) / count(*) * 100 AS conversion_pct
FROM (SELECT product_id_viewed = product_id_purchased AS same FROM matches {tail})"""

_FEED_PARTS = (_BOARD, _SESSIONS, _TUMBLING, _SLIDING, _UNION, _match(HOUR, 6 * HOUR), _alerts(), f"feed AS ({_FEED})", _PLACED)

ORACLES: dict[str, str] = {
    "decode_page_views": _with("SELECT user_id, product_id, ts_ms, event_id % 5 = 0 AS late FROM v"),
    "decode_purchases": _with("SELECT user_id, product_id, amount_usd, ts_ms, amount_usd > 200 AS fraud_hint FROM p"),
    "event_time_fallback": _with(
        "SELECT user_id, product_id, CASE WHEN event_id % 10 = 0 THEN 0 ELSE ts_ms END AS ts_ms, ts_ms AS event_ms FROM v"),
    "encode_results": _with(
        "SELECT value FROM (" + _WINDOW_JSON + ") WHERE kind = 'session'", _SESSIONS, _TUMBLING, _SLIDING, _UNION),
    "results_union": _with("SELECT kind AS type, * FROM unioned", _SESSIONS, _TUMBLING, _SLIDING, _UNION),
    "tumbling_by_product": _with(_tumbling("v", DAY, "product_id")),
    "tumbling_by_product_salted": _with(_tumbling("v", DAY, "product_id")),
    "tumbling_count": _with(_tumbling("v", HOUR)),
    "sliding_count": _with(_sliding("v", 3 * HOUR, HOUR)),
    "session_count": _with("SELECT window_start_ms, window_end_ms, user_id, count FROM sess", _SESSIONS),
    "session_metrics": _with("SELECT * FROM sess", _SESSIONS),
    "gmv_per_window": _with(
        f"""SELECT ts_ms // {HOUR} * {HOUR} AS window_start_ms, ts_ms // {HOUR} * {HOUR} + {HOUR} AS window_end_ms,
            CAST(sum(CAST(amount_usd AS DECIMAL(38, 9))) AS DOUBLE) AS gmv_usd, count(*) AS purchases FROM p GROUP BY ALL"""),
    "gmv_sliding": _with(
        f"""SELECT ts_ms // {HOUR} * {HOUR} - i * {HOUR} AS window_start_ms,
            ts_ms // {HOUR} * {HOUR} - i * {HOUR} + {3 * HOUR} AS window_end_ms,
            CAST(sum(CAST(amount_usd AS DECIMAL(38, 9))) AS DOUBLE) AS gmv_usd, count(*) AS purchases
            FROM p CROSS JOIN range(3) r(i) GROUP BY ALL"""),
    "window_aggregate": _with(
        f"""SELECT ts_ms // {DAY} * {DAY} - i * {DAY} AS window_start_ms,
            ts_ms // {DAY} * {DAY} - i * {DAY} + {3 * DAY} AS window_end_ms, product_id,
            min(amount_usd) AS smallest, max(amount_usd) AS largest, count(DISTINCT user_id) AS buyers
            FROM p CROSS JOIN range(3) r(i) GROUP BY ALL"""),
    "dashboard_counters": _with(
        """SELECT count(*) AS total, count(*) FILTER (event_id % 5 = 0) AS late,
           count(*) FILTER (event_type = 'purchase') AS purchases,
           count(*) FILTER (event_type = 'purchase' AND amount_usd > 200) AS flagged
           FROM act WHERE event_type IN ('view', 'purchase')"""),
    "topk_products": _with("SELECT * FROM board", _BOARD),
    "topk_products_nested": _with(_TOP_JSON, _BOARD),
    "topk_sql": _with("SELECT * FROM board", _BOARD),
    "topk_sliding": _with(_board(_sliding("v", 3 * DAY, DAY, "product_id"))),
    "topk_approx": _with("SELECT *, CAST(0 AS BIGINT) AS unlisted_max FROM board", _BOARD),
    "topk_two_level": _with("SELECT * FROM board", _BOARD),
    "rank_movement": _with(
        """SELECT b.window_start_ms, b.rank, b.product_id, q.rank AS prev_rank, q.rank - b.rank AS movement
           FROM board b JOIN prev USING (window_start_ms)
           LEFT JOIN board q ON q.window_start_ms = prev.prev_ms AND q.product_id = b.product_id""", _BOARD,
        """prev AS (SELECT window_start_ms, lag(window_start_ms) OVER (ORDER BY window_start_ms) AS prev_ms
           FROM (SELECT DISTINCT window_start_ms FROM board))"""),
    "share_of_max": _with(
        """SELECT *, CAST(count AS DOUBLE) / greatest(max(count) OVER (PARTITION BY window_start_ms), 1) AS share
           FROM c""", "c AS (" + _tumbling("v", DAY, "product_id") + ")"),
    "key_skew": _with(
        """SELECT product_id, count, CAST(count AS DOUBLE) / CAST(sum(count) OVER () AS BIGINT) AS share,
           CAST(count AS DOUBLE) / max(count) OVER () AS heat
           FROM (SELECT product_id, count(*) AS count FROM v GROUP BY product_id)"""),
    "key_skew_latest": _with(
        f"""SELECT product_id, count, CAST(count AS DOUBLE) / CAST(sum(count) OVER () AS BIGINT) AS share,
            CAST(count AS DOUBLE) / max(count) OVER () AS heat
            FROM (SELECT product_id, count(*) AS count FROM v
                  WHERE ts_ms // {DAY} = (SELECT max(ts_ms // {DAY}) FROM v) GROUP BY product_id)"""),
    "page_views_in_range": _with(
        """SELECT event_id, user_id, product_id, ts_ms FROM v
           WHERE ts_ms >= epoch_ms(TIMESTAMP '2024-01-10') AND ts_ms < epoch_ms(TIMESTAMP '2024-01-20')"""),
    "interval_join": _with("SELECT * FROM matches", _match(HOUR, 6 * HOUR)),
    "same_product_conversion": _with(_CONVERSION.format(tail=""), _match(DAY, 3 * DAY)),
    "same_product_conversion_latest": _with(
        _CONVERSION.format(tail="ORDER BY purchase_ts DESC, view_ts DESC, user_id, product_id_viewed, product_id_purchased LIMIT 12"), _match(DAY, 3 * DAY)),
    "window_join": _with(
        f"""SELECT v.ts_ms // {6 * HOUR} * {6 * HOUR} AS window_start_ms,
            v.ts_ms // {6 * HOUR} * {6 * HOUR} + {6 * HOUR} AS window_end_ms, v.user_id,
            v.product_id AS product_id_viewed, p.product_id AS product_id_purchased, v.ts_ms AS view_ts,
            p.ts_ms AS purchase_ts, p.amount_usd
            FROM v JOIN p ON v.user_id = p.user_id AND v.ts_ms // {6 * HOUR} = p.ts_ms // {6 * HOUR}"""),
    "funnel": _with(
        f"""SELECT count(*) AS views, CAST(sum(CAST(hit AS INTEGER)) AS BIGINT) AS converted,
            CAST(sum(CAST(hit AS INTEGER)) AS DOUBLE) / count(*) AS rate
            FROM (SELECT EXISTS (SELECT 1 FROM p WHERE p.user_id = v.user_id AND p.ts_ms BETWEEN v.ts_ms AND v.ts_ms + {6 * HOUR})
                  AS hit FROM v)"""),
    "rapid_purchases": _with("SELECT * FROM alerts", _alerts()),
    "rapid_purchase_filtered": _with("SELECT * FROM alerts", _alerts("amount_usd >= 20")),
    "custom_quantile": _with(
        f"""SELECT ts_ms // {DAY} * {DAY} AS window_start_ms, ts_ms // {DAY} * {DAY} + {DAY} AS window_end_ms,
            quantile_disc(amount_usd, 0.9) AS value, count(amount_usd) AS n FROM p GROUP BY 1, 2"""),
    "rapid_purchase_staged": _with(
        f"""SELECT a.user_id, CAST(1 + count(*) AS INTEGER) AS purchase_count,
            CAST(CAST(a.amount_usd AS DECIMAL(38, 9)) + sum(CAST(m.amount_usd AS DECIMAL(38, 9))) AS DOUBLE) AS total_amount_usd,
            a.ts_ms AS first_ts, b.ts_ms AS last_ts, b.ts_ms - a.ts_ms AS span_ms
            FROM e a JOIN e b ON b.user_id = a.user_id AND b.rn > a.rn AND b.ts_ms - a.ts_ms < {DAY} AND b.amount_usd >= 10
            JOIN e m ON m.user_id = a.user_id AND m.rn > a.rn AND m.rn <= b.rn AND m.amount_usd >= 10
            WHERE a.amount_usd < 20
            GROUP BY a.user_id, a.rn, b.rn, a.amount_usd, a.ts_ms, b.ts_ms HAVING count(*) >= 2""",
        "e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, product_id, amount_usd) AS rn FROM p)"),
    "threshold_anomaly": _with(
        f"""SELECT ts_ms // {DAY} * {DAY} AS window_start_ms, ts_ms // {DAY} * {DAY} + {DAY} AS window_end_ms, user_id,
            count(*) AS purchases, CAST(sum(CAST(amount_usd AS DECIMAL(38, 9))) AS DOUBLE) AS spent_usd
            FROM p GROUP BY 1, 2, 3 HAVING sum(CAST(amount_usd AS DECIMAL(38, 9))) > 150"""),
    "new_account_burst": _with(
        f"""SELECT alerts.*, first_ts - first_seen AS account_age_ms FROM alerts
            JOIN (SELECT user_id, min(ts_ms) AS first_seen FROM act GROUP BY user_id) USING (user_id)
            WHERE first_ts - first_seen <= {7 * DAY}""", _alerts()),
    "watermark_replay": _with(
        "SELECT event_id, batch, ts_ms AS event_ms, watermark_ms, is_late, lag_ms FROM replay", _LOG),
    "min_watermark": _with(
        f"""SELECT batch, CASE WHEN count(top) = 4 THEN min(top) - {HOUR} END AS min_watermark_ms,
            max(top) - {HOUR} AS max_watermark_ms
            FROM (SELECT b.batch, q.part,
                         (SELECT max(l.ts_ms) FROM log l WHERE l.part = q.part AND l.batch <= b.batch) AS top
                  FROM (SELECT DISTINCT batch FROM log) b CROSS JOIN range(4) q(part))
            GROUP BY batch""", _LOG),
    "late_counts": _with("SELECT is_late, count(*) AS count FROM replay GROUP BY is_late", _LOG),
    "late_side_output": _with(
        """SELECT event_id, user_id, product_id, ts_ms, window_end_ms, watermark_ms FROM replay
           WHERE window_end_ms <= watermark_ms""", _LOG),
    "late_dropped_windows": _with(
        """SELECT window_start_ms, window_end_ms, count(*) AS dropped FROM replay
           WHERE window_end_ms <= watermark_ms GROUP BY ALL""", _LOG),
    "allowed_lateness": _with(
        f"""SELECT window_start_ms, window_end_ms, count(*) AS count,
            count(*) FILTER (watermark_ms IS NULL OR window_end_ms > watermark_ms) AS on_time,
            count(*) FILTER (window_end_ms <= watermark_ms) AS refired FROM replay
            WHERE watermark_ms IS NULL OR window_end_ms > watermark_ms - {2 * HOUR} GROUP BY ALL""", _LOG),
    "watermark_lag_bands": _with(
        f"""SELECT CASE WHEN lag_ms < {2 * HOUR} THEN 'ok' WHEN lag_ms < {4 * HOUR} THEN 'slow' ELSE 'stuck' END AS band,
            count(*) AS count FROM replay WHERE watermark_ms IS NOT NULL GROUP BY 1""", _LOG),
    "event_vs_arrival": _with(
        f"""SELECT window_start_ms, window_start_ms + {HOUR} AS window_end_ms,
            coalesce(e, 0) AS by_event_time, coalesce(a, 0) AS by_arrival
            FROM (SELECT ts_ms // {HOUR} * {HOUR} AS window_start_ms, count(*) AS e FROM log GROUP BY 1)
            FULL JOIN (SELECT arrival_ms // {HOUR} * {HOUR} AS window_start_ms, count(*) AS a FROM log GROUP BY 1)
            USING (window_start_ms)""", _LOG),
    "result_feed": _with(_FEED, _BOARD, _SESSIONS, _TUMBLING, _SLIDING, _UNION, _match(HOUR, 6 * HOUR), _alerts()),
    "latest_per_type": _with("SELECT * EXCLUDE position FROM placed WHERE position = 1", *_FEED_PARTS),
    "recent_n": _with("SELECT * FROM placed WHERE position <= 50", *_FEED_PARTS),
    "dedup_windows": _with(
        """SELECT * EXCLUDE nth FROM (
             SELECT *, row_number() OVER (PARTITION BY kind, window_start_ms, user_id ORDER BY seq) AS nth FROM arrivals)
           WHERE nth = 1""", _SESSIONS, _TUMBLING, _SLIDING, _UNION,
        f"""arrivals AS (
          SELECT *, CAST(2 AS BIGINT) AS seq FROM unioned
          UNION ALL SELECT kind, window_start_ms, window_end_ms, count + 1, user_id,
                           CASE WHEN window_start_ms % {2 * HOUR} = 0 THEN 1 ELSE 3 END FROM unioned)"""),
    "recent_windows": _with(
        """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY kind ORDER BY window_start_ms DESC, user_id)
           AS INTEGER) AS position FROM unioned) WHERE position <= 30""", _SESSIONS, _TUMBLING, _SLIDING, _UNION),
    "recent_span": _with(
        "SELECT kind, min(window_start_ms) AS start_ms, max(window_end_ms) AS end_ms FROM unioned GROUP BY kind",
        _SESSIONS, _TUMBLING, _SLIDING, _UNION),
    "max_concurrent_sessions": _with(
        """SELECT CAST(max(open) AS BIGINT) AS max_concurrent FROM (
             SELECT sum(d) OVER (ORDER BY at_ms, d ROWS UNBOUNDED PRECEDING) AS open FROM (
               SELECT window_start_ms AS at_ms, 1 AS d FROM sess UNION ALL SELECT window_end_ms, -1 FROM sess))""",
        _SESSIONS),
}

# The flush at the end of a bounded stream closes every window, so streams give the rows of the table.
ORACLES |= {"stream_" + name: ORACLES[name] for name in (
    "tumbling_count", "sliding_count", "session_count", "topk_products", "interval_join", "rapid_purchases")}
ORACLES["stream_window_stats"] = _with("SELECT * FROM unioned", _SESSIONS, _TUMBLING, _SLIDING, _UNION)
ORACLES["stream_session_lateness"] = ORACLES["session_count"]
# Pieces by time of arrival; a window is closed for a piece when the largest time of the pieces before, less an hour, is past it.
ORACLES["stream_allowed_lateness"] = _with(
    f"""SELECT window_start_ms, window_start_ms + {HOUR} AS window_end_ms, CAST(arg_min(n, g) AS BIGINT) AS first_count,
        CAST(sum(n) AS BIGINT) AS count, count(*) AS firings
        FROM (SELECT ts_ms // {HOUR} * {HOUR} AS window_start_ms, count(*) AS n,
                     CASE WHEN ts_ms // {HOUR} * {HOUR} + {HOUR} <= mark THEN piece ELSE -1 END AS g
              FROM fed LEFT JOIN marks USING (piece) GROUP BY 1, 3) GROUP BY 1""",
    f"""timed AS (SELECT v.*, v.ts_ms + CASE WHEN event_id % 10 = 0 THEN {6 * HOUR} ELSE 0 END AS arrival, low, high
                  FROM v, (SELECT min(ts_ms) AS low, max(ts_ms) AS high FROM act))""",
    "fed AS (SELECT *, least(5, floor((arrival - low) * 6 / (high - low + 1))) AS piece FROM timed)",
    f"""marks AS (SELECT piece, max(max(ts_ms)) OVER (ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {HOUR} AS mark
                  FROM fed GROUP BY piece)""")
ORACLES["stream_topk_approx"] = _with(
    f"""SELECT board.*, CAST(floor(n * 3.5 / 16384) AS BIGINT) AS error_max
        FROM board JOIN (SELECT ts_ms // {DAY} * {DAY} AS window_start_ms, count(*) AS n FROM v GROUP BY 1) USING (window_start_ms)""", _BOARD)
ORACLES["stream_funnel"] = ORACLES["funnel"]
ORACLES["stream_rapid_purchase_staged"] = ORACLES["rapid_purchase_staged"]
ORACLES["stream_rapid_purchases_timers"] = ORACLES["rapid_purchases"]
ORACLES["stream_rank_movement"] = ORACLES["rank_movement"]
ORACLES["stream_new_account_burst"] = ORACLES["new_account_burst"]
ORACLES["stream_concurrent_sessions"] = _with(
    """SELECT at_ms, CAST(sum(sum(d)) OVER (ORDER BY at_ms) AS BIGINT) AS open
       FROM (SELECT window_start_ms AS at_ms, 1 AS d FROM sess UNION ALL SELECT window_end_ms, -1 FROM sess) GROUP BY at_ms""", _SESSIONS)
