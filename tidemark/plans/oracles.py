"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

# Epoch milliseconds, floored (epoch_ms would round).
_MS = "(epoch_us(ts) // 1000)"
_VOLUME = "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)"
_ID_PARTS = f"event_type, CAST(value AS VARCHAR), CAST({_VOLUME} AS VARCHAR), CAST({_MS} AS VARCHAR)"
_TICK_ID = f"sha256(concat_ws(chr(31), CAST(event_id AS VARCHAR), '0', {_ID_PARTS}))"
_TRADE_ID = f"sha256(concat_ws(chr(31), CAST(event_id AS VARCHAR), {_ID_PARTS}))"

_TICKS = f"""
SELECT event_type AS symbol, value AS price, {_VOLUME} AS volume, {_MS} AS timestamp
FROM events
"""

_TRADES = f"""
SELECT {_TRADE_ID} AS id, event_type AS symbol, value AS price, {_VOLUME} AS volume,
       {_MS} AS trade_timestamp, date_trunc('hour', ts) AS ingestion_time
FROM events
"""

_SINCE = "TIMESTAMP '2024-01-02 12:00:00'"
_NOW = "TIMESTAMP '2024-01-30 12:00:00'"
_BETWEEN = f"ingestion_time > {_SINCE} AND ingestion_time < {_NOW}"


def _stats(size: str) -> str:
    start = f"time_bucket(INTERVAL {size}, ts)"
    return f"""
SELECT {start} AS window_start, {start} + INTERVAL {size} AS window_end, event_type AS symbol,
       round(avg(value), 8) AS avg_price, count(*) AS trade_count
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3
"""


_FIVE_SECONDS = _stats("5 SECONDS")
_HOURLY = _stats("1 HOUR")

_TOTALS = f"""
SELECT symbol, CAST(sum(trade_count) AS BIGINT) AS total_trades
FROM ({_HOURLY})
WHERE window_start > {_SINCE} AND window_start < {_NOW} AND symbol IS NOT NULL
GROUP BY symbol
"""

_LATEST = f"""
SELECT symbol, arg_max(price, (trade_timestamp, ingestion_time, price)) AS latest_price
FROM ({_TRADES}) WHERE ingestion_time >= {_SINCE} AND symbol IS NOT NULL GROUP BY symbol
"""

_VOLUMES = f"""
SELECT ingestion_time AS time, symbol, coalesce(sum(volume), 0) AS total_volume
FROM ({_TRADES}) WHERE {_BETWEEN} AND symbol IS NOT NULL GROUP BY 1, 2
"""

_BY_EVENT_MS = """
SELECT CAST(make_timestamp((epoch_us(l_shipdate) // 1000) * 1000) AS VARCHAR) AS id,
       l_returnflag AS symbol, l_extendedprice AS price, l_quantity AS volume
FROM lineitem WHERE l_shipdate IS NOT NULL
QUALIFY row_number() OVER (
    PARTITION BY epoch_us(l_shipdate) // 1000
    ORDER BY l_returnflag DESC, l_extendedprice DESC, l_quantity DESC) = 1
"""

_EXACT = f"""
SELECT {_TICK_ID} AS id, event_type AS symbol, value AS price, {_VOLUME} AS volume,
       {_MS} AS trade_timestamp
FROM events
"""

_FLOORED = f"""
SELECT CAST(make_timestamp({_MS} * 1000) AS VARCHAR) AS id, event_type AS symbol,
       value AS price, {_VOLUME} AS volume, ({_MS} // 1000) * 1000 AS trade_timestamp
FROM events
"""

ORACLES = {
    "tumbling_stats": _FIVE_SECONDS,
    "tumbling_stats_hourly": _HOURLY,
    "envelope_parse": _TICKS,
    "envelope_parse_multi": """
SELECT l_orderkey, 0 AS position, l_returnflag AS symbol, l_extendedprice AS price,
       l_quantity AS volume, epoch_us(l_shipdate) // 1000 AS timestamp
FROM lineitem
UNION ALL
SELECT l_orderkey, 1, l_linestatus, l_discount, l_quantity, epoch_us(l_shipdate) // 1000
FROM lineitem
""",
    "envelope_heartbeats": f"""
SELECT event_id, event_type AS symbol, value AS price, {_VOLUME} AS volume, {_MS} AS timestamp
FROM events WHERE event_type IS DISTINCT FROM 'error'
""",
    "envelope_encode": """
SELECT event_id, 1 AS tick_count, event_type AS first_symbol, 'trade' AS message_type
FROM events
""",
    "symbol_allow_list": f"SELECT * FROM ({_TICKS}) WHERE symbol IN ('purchase', 'view')",
    "event_time": f"SELECT event_id, make_timestamp({_MS} * 1000) AS event_time FROM events",
    "trade_timestamp_v2": f"""
SELECT event_id, ({_MS} // 1000) * 1000 AS trade_timestamp, {_MS} AS exact_timestamp FROM events
""",
    "stable_trade_id": f"SELECT event_id, {_TICK_ID} AS id FROM events",
    "trades_by_event_ms": _BY_EVENT_MS,
    "quarantine_null_keys": """
SELECT nullif(event_type, 'error') IS NOT NULL AND ts IS NOT NULL AS valid,
       count(*) AS row_count
FROM events GROUP BY 1
""",
    "batch_row_counts": """
SELECT date_trunc('hour', ts) AS ingestion_time, count(*) AS row_count FROM events GROUP BY 1
""",
    "upsert_latest_version": """
SELECT date_trunc('day', l_shipdate) AS window_start,
       date_trunc('day', l_shipdate) + INTERVAL 1 DAY AS window_end, l_returnflag AS symbol,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 8) AS avg_price,
       count(*) AS trade_count
FROM lineitem GROUP BY 1, 2, 3
""",
    "raw_trades_v1": _EXACT,
    "raw_trades_v2": _FLOORED,
    "window_stats_append": f"""
SELECT * FROM ({_FIVE_SECONDS})
WHERE window_end <= (
    SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 SECONDS FROM events)
""",
    "window_stats_upsert": _FIVE_SECONDS,
    "window_stats_delta": _FIVE_SECONDS,
    "feed_ticks": """
SELECT event_type AS symbol, value AS price, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
       epoch_us(ts) // 1000 AS trade_timestamp
FROM events
""",
    "state_windows": _FIVE_SECONDS,
    "state_handover": _FIVE_SECONDS,
    "offset_gaps": """
WITH numbers AS (SELECT 'trades:' || (event_id % 4) AS stream, event_id // 4 AS pos FROM events),
stored AS (
  SELECT stream, pos, 'first' AS writer,
         unnest(range(CASE WHEN pos % 50 < 2 THEN 2 WHEN pos % 211 = 5 THEN 3 ELSE 1 END))
  FROM numbers WHERE NOT (pos % 101 < 3 OR pos BETWEEN 1000 AND 1200)
  UNION ALL SELECT stream, pos, 'second', 0 FROM numbers WHERE pos BETWEEN 300 AND 450
),
ends AS (SELECT stream, max(pos) AS last FROM numbers GROUP BY 1),
every AS (SELECT stream, unnest(range(0, last + 1)) AS pos FROM ends),
counted AS (
  SELECT every.stream, every.pos, count(writer) AS n,
         CASE WHEN count(writer) = 0 THEN 'missing' WHEN count(DISTINCT writer) > 1 THEN 'overlap'
              WHEN count(writer) > 1 THEN 'repeated' END AS kind
  FROM every LEFT JOIN stored ON stored.stream = every.stream AND stored.pos = every.pos GROUP BY 1, 2
),
marked AS (
  SELECT *, pos - row_number() OVER (PARTITION BY stream, kind ORDER BY pos) AS island
  FROM counted WHERE kind IS NOT NULL
)
SELECT stream, kind, min(pos) AS first, max(pos) AS last, count(*) AS messages, sum(n)::BIGINT AS rows
FROM marked GROUP BY stream, kind, island
""",
    "late_corrections": f"""
SELECT * FROM ({_FIVE_SECONDS})
WHERE window_end <= (
    SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 SECONDS FROM events)
""",
    "raw_trades_v2_keyed": _BY_EVENT_MS,
    "trades_lookback": "SELECT event_type AS symbol, count(*) AS total_trades FROM events GROUP BY 1",
    "aggregations_lookback": _TOTALS,
    "upsert_after_reset": _HOURLY,
    "rewritten_stats": _HOURLY,
    "published_trades": _FLOORED,
    "published_stats": _HOURLY,
    "backfill_then_stream": _FIVE_SECONDS,
    "compacted_stats": _HOURLY,
    "compacted_trades": _EXACT,
    "trades_by_id": f"SELECT * FROM ({_TRADES}) ORDER BY trade_timestamp, id LIMIT 10",
    "bucketed_newest": _TRADES,
    "bucketed_latest_row": f"""
SELECT * FROM ({_TRADES}) WHERE symbol IS NOT NULL
QUALIFY row_number() OVER (
    PARTITION BY symbol ORDER BY trade_timestamp DESC, ingestion_time DESC, id DESC) = 1
""",
    "view_trade_count": """
SELECT strftime(ts, '%Y-%m-%d') AS window_day, event_type AS symbol, count(*) AS total_trades
FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY 1, 2
""",
    "bad_messages": "SELECT event_id, event_type AS symbol FROM events WHERE event_id % 10 = 3",
    "trade_count_by_symbol": _TOTALS,
    "trade_count_share": f"""
SELECT symbol, total_trades,
       CAST(total_trades AS DOUBLE) / CAST(sum(total_trades) OVER () AS DOUBLE) AS share
FROM ({_TOTALS})
""",
    "latest_price": _LATEST,
    "latest_trade_row": f"""
SELECT * FROM ({_TRADES}) WHERE ingestion_time >= {_SINCE} AND symbol IS NOT NULL
QUALIFY row_number() OVER (
    PARTITION BY symbol ORDER BY trade_timestamp DESC, ingestion_time DESC, id DESC) = 1
""",
    "latest_price_label": f"""
SELECT symbol, 'Latest Price for ' || symbol AS caption,
       '$' || printf('%.2f', latest_price) AS rounded_text,
       '$' || CAST(latest_price AS VARCHAR) AS full_text
FROM ({_LATEST})
""",
    "clock_label": "SELECT event_id, strftime(ts, '%H:%M:%S') AS clock FROM events",
    "trends": f"""
SELECT ingestion_time AS time, symbol, count(*) AS trade_count,
       coalesce(sum(volume), 0) AS total_volume, round(avg(price), 8) AS price
FROM ({_TRADES}) WHERE {_BETWEEN} AND symbol IS NOT NULL GROUP BY 1, 2
""",
    "trade_count_trend": f"""
SELECT ingestion_time AS time, symbol, count(*) AS trade_count
FROM ({_TRADES}) WHERE {_BETWEEN} AND symbol IS NOT NULL GROUP BY 1, 2
""",
    "volume_trend": _VOLUMES,
    "volume_stacked": f"""
SELECT time, symbol, total_volume,
       sum(total_volume) OVER (
           PARTITION BY time ORDER BY symbol
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stacked_volume
FROM ({_VOLUMES})
""",
    "price_trend": f"""
SELECT ingestion_time AS time, symbol, round(avg(price), 8) AS price
FROM ({_TRADES}) WHERE {_BETWEEN} AND symbol IS NOT NULL GROUP BY 1, 2
""",
    "rollup_totals": f"""
SELECT symbol, count(*) AS trade_count, coalesce(sum(volume), 0) AS total_volume, round(avg(price), 8) AS price
FROM ({_TRADES}) WHERE {_BETWEEN} AND symbol IS NOT NULL GROUP BY 1
""",
    "trades_peek": f"SELECT * FROM ({_TRADES}) ORDER BY trade_timestamp, id LIMIT 10",
    "aggregations_peek": f"SELECT * FROM ({_HOURLY}) ORDER BY window_start, symbol LIMIT 10",
}
