"""Independent DuckDB formulations of the registered queries.

They start from the raw tables (``events``, ``conversations``, ``pages``,
``documents``) and recompute every step in SQL: frame text, parse, windows,
watermark closing rule, first-write-wins insert.  Timestamps are UTC
wall-clock ``TIMESTAMP`` values; Gold metrics are cast to DECIMAL(20,8).
"""

from __future__ import annotations

from ticklake.plans.catalog import (
    BROKEN_FRAMES,
    DASHBOARD_FROM,
    DASHBOARD_SYMBOLS,
    DASHBOARD_TO,
    DELAYED_SYMBOL,
    ODD_DATA,
    REPLAY_CUT,
    REPLAY_FROM,
    REPLAY_SPEED,
    SHORT_SYMBOL,
    SUBSCRIBED_SYMBOLS,
    SUBSCRIBED_TYPES,
)
from ticklake.operators.envelope import stream_names

_M = """m AS (
  SELECT event_id, ts,
         date_trunc('milliseconds', ts) AS ts_ms,
         epoch_us(ts) // 1000 AS event_ms,
         upper(event_type) AS symbol,
         CAST(value AS DECIMAL(20,8)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(20,8)) AS qty,
         user_id
  FROM events)"""

_FRAMES = """f AS (
  SELECT CAST(json_object('stream', lower(symbol) || '@aggTrade',
           'data', json_object('e', 'aggTrade', 'E', event_ms, 's', symbol, 'a', event_id,
                               'p', CAST(price AS VARCHAR), 'q', CAST(qty AS VARCHAR),
                               'f', event_id, 'l', event_id, 'T', event_ms,
                               'm', event_id % 2 = 0, 'M', true)) AS VARCHAR) AS frame,
         ts AS received_at, symbol, 'aggTrade' AS stream_type, event_id * 3 AS seq
  FROM m
  UNION ALL
  SELECT CAST(json_object('stream', lower(symbol) || '@bookTicker',
           'data', json_object('u', event_id, 's', symbol,
                               'b', CAST(price AS VARCHAR), 'B', CAST(qty AS VARCHAR),
                               'a', CAST(CAST(price + qty * 0.01 AS DECIMAL(20,8)) AS VARCHAR),
                               'A', CAST(user_id AS VARCHAR))) AS VARCHAR),
         ts, symbol, 'bookTicker', event_id * 3 + 1
  FROM m
  UNION ALL
  SELECT CAST(json_object('stream', lower(symbol) || '@depth10',
           'data', json_object('lastUpdateId', max(event_id),
             'bids', coalesce(list([CAST(price AS VARCHAR), CAST(qty AS VARCHAR)] ORDER BY event_id)
                              FILTER (WHERE event_id % 2 = 0), []::VARCHAR[][]),
             'asks', coalesce(list([CAST(price AS VARCHAR), CAST(qty AS VARCHAR)] ORDER BY event_id)
                              FILTER (WHERE event_id % 2 = 1), []::VARCHAR[][]))) AS VARCHAR),
         max(ts), symbol, 'depth10', max(event_id) * 3 + 2
  FROM m GROUP BY symbol, event_id // 20)"""

_TRADES = """trades AS (
  SELECT symbol, ts AS ingestion_timestamp, 'aggTrade' AS event_type, ts_ms AS event_timestamp,
         event_id AS agg_trade_id, price, qty AS quantity,
         event_id AS first_trade_id, event_id AS last_trade_id, ts_ms AS trade_timestamp,
         event_id % 2 = 0 AS is_buyer_maker, true AS is_best_match
  FROM m)"""

_QUOTES = """quotes AS (
  SELECT symbol, ts AS ingestion_timestamp, event_id AS update_id,
         price AS best_bid_price, qty AS best_bid_quantity,
         CAST(price + qty * 0.01 AS DECIMAL(20,8)) AS best_ask_price,
         CAST(user_id AS DECIMAL(20,8)) AS best_ask_quantity
  FROM m)"""

_LEVELS = """levels AS (
  SELECT symbol,
         max(ts) OVER snap AS ingestion_timestamp,
         max(event_id) OVER snap AS last_update_id,
         CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side,
         CAST(row_number() OVER (PARTITION BY symbol, event_id // 20, event_id % 2
                                 ORDER BY event_id) - 1 AS INTEGER) AS level,
         price, qty AS quantity
  FROM m
  WINDOW snap AS (PARTITION BY symbol, event_id // 20))"""


def _sql_list(texts) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in texts) + "]"


# Valid frames without usable payload.
_ODD = f"""odd AS (
  SELECT '{{"stream":"' || lower(role) || '@' || stream_type || '"' || {_sql_list(ODD_DATA)}[turn % {len(ODD_DATA)} + 1] || '}}' AS frame,
         CAST(NULL AS TIMESTAMP) AS received_at, upper(role) AS symbol, stream_type, CAST(NULL AS BIGINT) AS seq,
         turn % {len(ODD_DATA)} >= 2 AS parses
  FROM (SELECT *, ['aggTrade', 'bookTicker', 'depth10'][conv_id % 3 + 1] AS stream_type FROM conversations)),
all_frames AS (SELECT frame, received_at, symbol, stream_type, seq FROM f
               UNION ALL SELECT frame, received_at, symbol, stream_type, seq FROM odd)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _wstart(col: str) -> str:
    return f"time_bucket(INTERVAL '5 minutes', {col})"


def _gold_sql(table: str, src: str) -> str:
    if table == "gold_volatility":
        t = "trade_timestamp"
        return f"""SELECT {_wstart(t)} AS window_start, {_wstart(t)} + INTERVAL '5 minutes' AS window_end, symbol,
       CAST(avg(price) AS DECIMAL(20,8)) AS avg_price,
       CAST(stddev_samp(price) AS DECIMAL(20,8)) AS stddev_price,
       CAST(sum(quantity) AS DECIMAL(20,8)) AS total_volume,
       count(symbol) AS trade_count
FROM {src} GROUP BY 1, 2, 3"""
    t = "ingestion_timestamp"
    if table == "gold_spread":
        return f"""SELECT {_wstart(t)} AS window_start, {_wstart(t)} + INTERVAL '5 minutes' AS window_end, symbol,
       CAST(avg(best_ask_price - best_bid_price) AS DECIMAL(20,8)) AS avg_spread,
       CAST(min(best_ask_price - best_bid_price) AS DECIMAL(20,8)) AS min_spread,
       CAST(max(best_ask_price - best_bid_price) AS DECIMAL(20,8)) AS max_spread,
       CAST(avg((best_bid_price + best_ask_price) / 2) AS DECIMAL(20,8)) AS avg_mid_price
FROM {src} GROUP BY 1, 2, 3"""
    return f"""SELECT {_wstart(t)} AS window_start, {_wstart(t)} + INTERVAL '5 minutes' AS window_end, symbol, side,
       CAST(avg(quantity) AS DECIMAL(20,8)) AS avg_depth_quantity
FROM {src} GROUP BY 1, 2, 3, 4"""


_SILVER_CTE = {"gold_volatility": ("trades", _TRADES), "gold_spread": ("quotes", _QUOTES), "gold_liquidity": ("levels", _LEVELS)}
_TIME_COL = {"gold_volatility": "trade_timestamp", "gold_spread": "ingestion_timestamp", "gold_liquidity": "ingestion_timestamp"}


def _gold(table: str) -> str:
    name, cte = _SILVER_CTE[table]
    return _with(_M, cte) + _gold_sql(table, name)


def _gold_stream(table: str) -> str:
    name, cte = _SILVER_CTE[table]
    t = _TIME_COL[table]
    # Append mode emits a window once the watermark (max event time, in ms,
    # minus 10 minutes) reaches its end.
    return (
        _with(_M, cte, f"g AS ({_gold_sql(table, name)})")
        + f"SELECT * FROM g WHERE window_end <= (SELECT date_trunc('milliseconds', max({t})) FROM {name}) - INTERVAL '10 minutes'"
    )


def _late_trades(select: str = "SELECT * FROM g WHERE window_end <= (SELECT max({t}) FROM replayed) - INTERVAL '10 minutes'") -> str:
    # Batch 1 = every symbol but the delayed one up to the cut; batch 2 = the
    # delayed one up to there; batch 3 = the rest.
    # A batch-2 row is dropped when its window already ended at or before
    # the watermark left by batch 1 (max event time - 10 min); a window is
    # emitted once the final watermark (over all rows seen) reaches its end.
    t = "trade_timestamp"
    cut = f"TIMESTAMP '{REPLAY_CUT.isoformat(sep=' ')}'"
    start = f"TIMESTAMP '{REPLAY_FROM.isoformat(sep=' ')}'"
    return _with(
        _M,
        _TRADES,
        f"""replayed AS (
  SELECT * REPLACE ({start} + to_milliseconds(CAST(floor((epoch_ms({t}) - epoch_ms({start})) / {REPLAY_SPEED}) AS BIGINT)) AS {t})
  FROM trades)""",
        f"b1 AS (SELECT * FROM replayed WHERE {t} < {cut} AND symbol <> '{DELAYED_SYMBOL}')",
        f"b2 AS (SELECT * FROM replayed WHERE {t} < {cut} AND symbol = '{DELAYED_SYMBOL}')",
        f"b3 AS (SELECT * FROM replayed WHERE {t} >= {cut})",
        f"wm1 AS (SELECT max({t}) - INTERVAL '10 minutes' AS wm FROM b1)",
        f"kept AS (SELECT * FROM b1 UNION ALL SELECT * FROM b3 UNION ALL SELECT b2.* FROM b2, wm1 WHERE {_wstart(t)} + INTERVAL '5 minutes' > wm1.wm)",
        f"g AS ({_gold_sql('gold_volatility', 'kept')})",
    ) + select.format(t=t, window=_wstart(t))


def _insert_delta(table: str) -> str:
    # The target is first seeded from Gold over every other row, then the full
    # Gold is inserted where its key is absent: seeded keys keep their first values.
    name, cte = _SILVER_CTE[table]
    keys = {"gold_volatility": ("symbol", "window_start"), "gold_spread": ("symbol", "window_start"), "gold_liquidity": ("symbol", "side", "window_start")}[table]
    cond = " AND ".join(f"s.{k} = g.{k}" for k in keys)
    seeded = {"gold_volatility": "agg_trade_id", "gold_spread": "update_id", "gold_liquidity": "level"}[table]
    return _with(
        _M,
        cte,
        f"seed AS ({_gold_sql(table, f'(SELECT * FROM {name} WHERE {seeded} % 2 = 0)')})",
        f"full_gold AS ({_gold_sql(table, name)})",
    ) + f"SELECT * FROM seed UNION ALL SELECT g.* FROM full_gold g WHERE NOT EXISTS (SELECT 1 FROM seed s WHERE {cond})"


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _checked() -> str:
    types = _in_list(("aggTrade", "bookTicker", "depth10"))
    return _with(
        _M,
        _FRAMES,
        _ODD,
        f"""feed AS (
  SELECT frame, received_at FROM all_frames
  UNION ALL
  SELECT CAST(json_object('stream', role || '@chat', 'data', json_object('conv', conv_id, 'turn', turn)) AS VARCHAR),
         CAST(NULL AS TIMESTAMP) FROM conversations
  UNION ALL
  SELECT {_sql_list(BROKEN_FRAMES)}[turn % {len(BROKEN_FRAMES)} + 1], CAST(NULL AS TIMESTAMP) FROM conversations
  UNION ALL
  SELECT CAST(json_object('stream', url) AS VARCHAR), CAST(NULL AS TIMESTAMP) FROM pages
  UNION ALL
  SELECT text, CAST(NULL AS TIMESTAMP) FROM documents)""",
        """parsed AS (
  SELECT frame, received_at,
         CASE WHEN json_valid(frame) THEN json_type(frame) = 'OBJECT' ELSE false END AS valid,
         CASE WHEN json_valid(frame) THEN json_extract_string(frame, '$.stream') END AS stream
  FROM feed)""",
        f"""checked AS (
  SELECT received_at, frame,
         CASE WHEN frame IS NULL THEN 'null_frame'
              WHEN NOT valid THEN 'invalid_json'
              WHEN stream IS NULL THEN 'missing_stream'
              WHEN len(string_split(stream, '@')) <> 2 THEN 'bad_stream_name'
              WHEN string_split(stream, '@')[2] NOT IN ({types}) THEN 'unknown_stream_type'
         END AS reason
  FROM parsed)""",
    )


def _strict_quotes() -> str:
    required = ("symbol", "ingestion_timestamp", "best_bid_price", "best_ask_price")
    missing = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in required)
    any_null = " OR ".join(f"{c} IS NULL" for c in required)
    return _with(
        _M,
        """q AS (
  SELECT symbol, ts AS ingestion_timestamp, event_id AS update_id,
         price AS best_bid_price, qty AS best_bid_quantity,
         CAST(price + qty * 0.01 AS DECIMAL(20,8)) AS best_ask_price,
         CAST(user_id AS DECIMAL(20,8)) AS best_ask_quantity
  FROM m
  UNION ALL
  SELECT upper(role), CAST(NULL AS TIMESTAMP), turn,
         TRY_CAST(text AS DECIMAL(20,8)), TRY_CAST(CAST(turn AS VARCHAR) AS DECIMAL(20,8)),
         TRY_CAST(text AS DECIMAL(20,8)), TRY_CAST(CAST(conv_id AS VARCHAR) AS DECIMAL(20,8))
  FROM conversations)""",
    ) + f"SELECT *, concat_ws(',', {missing}) AS missing_fields FROM q WHERE {any_null}"


def _bronze_rows(where: str = "") -> str:
    return _with(_M, _FRAMES, _ODD) + f"""SELECT received_at AS ingestion_timestamp, symbol, stream_type, frame AS raw_payload,
       CAST(ascii(symbol) % 3 AS INTEGER) AS "partition", seq AS "offset", received_at AS kafka_timestamp
FROM all_frames {where}"""


def oracle_sql() -> dict[str, str]:
    envelope = _with(_M, _FRAMES, _ODD) + (
        "SELECT received_at AS ingestion_timestamp, symbol, stream_type, frame AS raw_payload FROM all_frames"
    )
    types = ", ".join(f"('{t}')" for t in SUBSCRIBED_TYPES)
    semi = _with(_M, _FRAMES, _ODD) + f"""SELECT frame, received_at, seq FROM all_frames
WHERE json_extract_string(frame, '$.stream') IN (
  SELECT lower(event_type) || '@' || t FROM events, (VALUES {types}) v(t) WHERE length(event_type) <= {SHORT_SYMBOL})"""
    streams = _in_list(stream_names(SUBSCRIBED_SYMBOLS, SUBSCRIBED_TYPES))
    subscription = _with(_M, _FRAMES) + (
        f"SELECT frame, received_at, seq FROM f WHERE json_extract_string(frame, '$.stream') IN ({streams})"
    )
    span = f"window_start >= TIMESTAMP '{DASHBOARD_FROM.isoformat(sep=' ')}' AND window_start < TIMESTAMP '{DASHBOARD_TO.isoformat(sep=' ')}'"
    dash = f"symbol IN ({_in_list(DASHBOARD_SYMBOLS)}) AND {span}"
    return {
        "envelope_from_frames": envelope,
        "quarantine_frames": _checked() + "SELECT received_at, frame, reason FROM checked WHERE reason IS NOT NULL",
        "split_frames": _checked() + "SELECT frame, CASE WHEN reason IS NULL THEN 'envelope' ELSE 'quarantine' END AS side FROM checked",
        "subscription_filter": subscription,
        "subscription_semi": semi,
        "strict_silver_quotes": _strict_quotes(),
        "kafka_round_trip": _bronze_rows(),
        "bronze_all": _bronze_rows(),
        "bronze_partitioned": _bronze_rows("WHERE stream_type = 'depth10'"),
        "bronze_lineage": _with(_M, _FRAMES, _ODD) + "SELECT symbol, stream_type, frame AS raw_payload, true AS frame_found, true AS file_found FROM all_frames",
        "silver_agg_trade": _with(_M, _FRAMES, _ODD, _TRADES) + "SELECT * FROM trades UNION ALL BY NAME SELECT symbol FROM odd WHERE parses AND stream_type = 'aggTrade'",
        "silver_book_ticker": _with(_M, _FRAMES, _ODD, _QUOTES) + "SELECT * FROM quotes UNION ALL BY NAME SELECT symbol FROM odd WHERE parses AND stream_type = 'bookTicker'",
        "silver_depth10": _with(_M, _LEVELS) + "SELECT * FROM levels",
        "gold_volatility": _gold("gold_volatility"),
        "gold_spread": _gold("gold_spread"),
        "gold_liquidity": _gold("gold_liquidity"),
        "gold_volatility_stream": _gold_stream("gold_volatility"),
        "gold_spread_stream": _gold_stream("gold_spread"),
        "gold_liquidity_stream": _gold_stream("gold_liquidity"),
        "gold_after_replay": _gold_stream("gold_volatility"),
        "silver_after_replay": _with(_M, _TRADES) + "SELECT * FROM trades",
        "silver_quality": _with(_M, _FRAMES, _ODD, _LEVELS).rstrip()
        + """, named AS (
  SELECT 'silver_' || CASE stream_type WHEN 'aggTrade' THEN 'agg_trade' WHEN 'bookTicker' THEN 'book_ticker' ELSE 'depth10' END AS layer,
         stream_type, 1 AS frame, CASE WHEN stream_type = 'depth10' THEN 0 ELSE 1 END AS made, 0 AS empty FROM f
  UNION ALL
  SELECT 'silver_' || CASE stream_type WHEN 'aggTrade' THEN 'agg_trade' WHEN 'bookTicker' THEN 'book_ticker' ELSE 'depth10' END,
         stream_type, 1, CASE WHEN parses AND stream_type <> 'depth10' THEN 1 ELSE 0 END, CASE WHEN parses AND stream_type <> 'depth10' THEN 1 ELSE 0 END FROM odd
  UNION ALL SELECT 'silver_depth10', 'depth10', 0, 1, 0 FROM levels),
counted AS (SELECT layer, sum(frame)::BIGINT AS frames, sum(made)::BIGINT AS rows, sum(empty)::BIGINT AS empty FROM named GROUP BY layer)
SELECT layer, 'frames' AS name, frames AS total FROM counted
UNION ALL SELECT layer, 'rows', rows FROM counted
UNION ALL SELECT layer, 'empty', empty FROM counted""",
        "late_trades_stream": _late_trades(),
        "gold_open_windows": _late_trades("SELECT * FROM g WHERE window_end > (SELECT max({t}) FROM replayed) - INTERVAL '10 minutes'"),
        "late_trades_dropped": _late_trades(
            "SELECT 'gold_volatility' AS layer, count(DISTINCT {window}) AS rows_dropped FROM b2, wm1 WHERE {window} + INTERVAL '5 minutes' <= wm1.wm"
        ),
        "insert_delta_volatility": _insert_delta("gold_volatility"),
        "insert_delta_spread": _insert_delta("gold_spread"),
        "insert_delta_liquidity": _insert_delta("gold_liquidity"),
        "sync_twice": _gold("gold_volatility"),
        "sync_spread": _gold("gold_spread"),
        "sync_liquidity": _gold("gold_liquidity"),
        "sync_recovered": _gold("gold_volatility"),
        "dash_symbols": _with(_M, _TRADES, f"g AS ({_gold_sql('gold_volatility', 'trades')})")
        + "SELECT DISTINCT symbol FROM g ORDER BY symbol",
        "dash_volatility": _with(_M, _TRADES, f"g AS ({_gold_sql('gold_volatility', 'trades')})")
        + f"SELECT window_start AS time, symbol, stddev_price FROM g WHERE {dash} ORDER BY window_start",
        "dash_spread": _with(_M, _QUOTES, f"g AS ({_gold_sql('gold_spread', 'quotes')})")
        + f"SELECT window_start AS time, symbol, avg_spread FROM g WHERE {dash} ORDER BY window_start",
        "dash_liquidity": _with(_M, _LEVELS, f"g AS ({_gold_sql('gold_liquidity', 'levels')})")
        + f"SELECT window_start AS time, CONCAT(symbol, ' - ', side) AS metric, avg_depth_quantity FROM g WHERE {dash} ORDER BY window_start",
    }
