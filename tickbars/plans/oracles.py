"""The same queries as ANSI SQL for an independent engine, over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_TICKS = """ticks AS (
    SELECT event_id, ts, epoch_ns(ts) AS ns, event_type AS ticker, value AS price,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity
    FROM events
)"""


def _bars(minutes: int, order: str = "event_id", name: str = "bars") -> str:
    return f"""{name} AS (
    SELECT ticker,
           time_bucket(INTERVAL '{minutes} minutes', ts) AS window_start,
           time_bucket(INTERVAL '{minutes} minutes', ts) + INTERVAL '{minutes} minutes'
               AS window_end,
           arg_min(price, {order}) AS open_price,
           max(price) AS high_price,
           min(price) AS low_price,
           arg_max(price, {order}) AS close_price,
           CAST(sum(quantity) AS BIGINT) AS volume
    FROM ticks
    GROUP BY ALL
)"""


# The stream's watermark once every event has come: whole seconds, less two.
_WATERMARK = "(SELECT date_trunc('second', max(ts)) - INTERVAL '2 seconds' FROM events)"


def _means(periods: int, source: str = "bars") -> str:
    return f"""
    SELECT ticker, window_end AS snapshot_time,
           round(avg(close_price) OVER (
               PARTITION BY ticker ORDER BY window_end
               ROWS BETWEEN {periods - 1} PRECEDING AND CURRENT ROW), 6) AS ema_value
    FROM {source}"""


_CLOSED = f"closed AS (SELECT * FROM bars WHERE window_end <= {_WATERMARK})"

# --- Ticks -----------------------------------------------------------------------------

ORACLES["parse_timestamp"] = """
SELECT event_id,
       epoch_ns(CASE WHEN event_type = 'purchase' THEN date_trunc('second', ts) ELSE ts END)
           + CASE WHEN event_type = 'error' THEN 123 ELSE 0 END AS ts_ns
FROM events"""

ORACLES["event_time"] = "SELECT event_id, date_trunc('second', ts) AS event_time FROM events"

ORACLES["tick_csv_scan"] = f"""
WITH {_TICKS}
SELECT strftime(ts, '%Y-%m-%d') AS "Date", ns AS "Timestamp", 'TRADE' AS "EventType",
       ticker AS "Ticker", price AS "Price", quantity AS "Quantity",
       '' AS "Exchange", '' AS "Conditions"
FROM ticks
WHERE strftime(ts, '%Y%m%d') BETWEEN '20240105' AND '20240124'
  AND ticker IN ('click', 'view', 'purchase')"""

ORACLES["tick_parquet_scan"] = ORACLES["tick_csv_scan"]

ORACLES["tick_convert_by_day"] = f"""
WITH {_TICKS}
SELECT strftime(ts, '%Y-%m-%d') AS "Date", ns AS "Timestamp", ticker AS "Ticker",
       price AS "Price", quantity AS "Quantity", event_id
FROM ticks"""

ORACLES["tick_csv_bars"] = f"""
WITH {_TICKS}, {_bars(60, "(ts, event_id)")}
SELECT * FROM bars
WHERE strftime(window_start, '%Y%m%d') BETWEEN '20240105' AND '20240124'
  AND ticker IN ('click', 'view', 'purchase')"""

ORACLES["time_order"] = """
SELECT event_id, row_number() OVER (ORDER BY ts, event_type, event_id) AS position
FROM events"""

ORACLES["ticker_counts"] = """
SELECT upper(event_type) AS ticker, count(*) AS ticks FROM events GROUP BY 1"""

ORACLES["ticker_filter"] = f"""
WITH {_TICKS}, {_bars(5)}
SELECT * FROM bars WHERE ticker IN ('click', 'error')"""

# --- Bars and indicators ---------------------------------------------------------------

for _minutes in (5, 60, 1440):
    ORACLES[f"ohlc_{_minutes}m"] = f"WITH {_TICKS}, {_bars(_minutes)} SELECT * FROM bars"
ORACLES["ohlc_60m_time_order"] = (
    f"WITH {_TICKS}, {_bars(60, 'row(ts, event_id)')} SELECT * FROM bars"
)

ORACLES["rolling_mean_9"] = f"WITH {_TICKS}, {_bars(5)} {_means(9)}"
ORACLES["rolling_mean_12"] = f"WITH {_TICKS}, {_bars(5)} {_means(12)}"
ORACLES["rolling_mean_9_60m"] = f"WITH {_TICKS}, {_bars(60)} {_means(9)}"

ORACLES["tick_csv_checked"] = f"""
WITH {_TICKS}
SELECT strftime(ts, '%Y-%m-%d') AS "Date", ns AS "Timestamp", 'TRADE' AS "EventType",
       ticker AS "Ticker", price AS "Price", quantity AS "Quantity",
       '' AS "Exchange", '' AS "Conditions"
FROM ticks WHERE ticker NOT IN ('error', 'signup')"""

ORACLES["tick_csv_rejects"] = f"""
WITH {_TICKS}
SELECT CASE ticker WHEN 'error' THEN 'Price' ELSE 'Timestamp' END AS reason,
       strftime(ts, '%Y-%m-%d') AS date, ticker, quantity
FROM ticks WHERE ticker IN ('error', 'signup')"""

ORACLES["tick_rolling_mean_9"] = """
SELECT event_type AS ticker, date_trunc('second', ts) AS snapshot_time, event_id,
       round(avg(value) OVER (
           PARTITION BY event_type ORDER BY date_trunc('second', ts), event_id
           ROWS BETWEEN 8 PRECEDING AND CURRENT ROW), 6) AS ema_value
FROM events"""

ORACLES["stream_tick_mean_9"] = ORACLES["tick_rolling_mean_9"]

ORACLES["tick_rolling_mean_9_by_range"] = ORACLES["tick_rolling_mean_9"]

_CHANGES = """changes AS (
    SELECT *, lag(close_price) OVER w AS previous, row_number() OVER w AS place
    FROM bars
    WINDOW w AS (PARTITION BY ticker ORDER BY window_end)
)"""
_CHANGE_COLUMNS = """
       CASE WHEN place = 1 THEN 0.0 ELSE close_price - previous END AS change,
       CASE WHEN place = 1 OR previous = 0 THEN 0.0
            ELSE (close_price - previous) / previous * 100 END AS percent_change"""

for _name in ("tick_rolling_mean_1000", "tick_rolling_mean_1000_by_block"):
    ORACLES[_name] = """
SELECT event_type AS ticker, date_trunc('second', ts) AS snapshot_time, event_id,
       avg(CAST(round(value * 100) AS BIGINT)) OVER (
           PARTITION BY event_type ORDER BY date_trunc('second', ts), event_id
           ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS ema_value
FROM events"""

ORACLES["bar_price_change"] = f"""
WITH {_TICKS}, {_bars(60)}, {_CHANGES}
SELECT ticker, window_end, close_price, {_CHANGE_COLUMNS}
FROM changes"""

ORACLES["candle_direction"] = f"""
WITH {_TICKS}, {_bars(60)}
SELECT ticker, window_end,
       CASE WHEN close_price >= open_price THEN 'up' ELSE 'down' END AS direction
FROM bars"""

ORACLES["latest_bar_snapshot"] = f"""
WITH {_TICKS}, {_bars(5)}, {_CHANGES}, means AS ({_means(9)}),
newest AS (SELECT ticker, max(window_end) AS time FROM bars GROUP BY ticker)
SELECT c.ticker, c.window_end AS time, c.close_price AS close, {_CHANGE_COLUMNS},
       c.high_price AS high, c.low_price AS low, c.volume, m.ema_value AS ema
FROM changes c
JOIN newest n ON c.ticker = n.ticker AND c.window_end = n.time
JOIN means m ON m.ticker = n.ticker AND m.snapshot_time = n.time"""


def _newest(count: int) -> str:
    return f"""
WITH {_TICKS}, {_bars(5)}
SELECT * FROM bars
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY window_end DESC) <= {count}"""


ORACLES["latest_60"] = _newest(60)
ORACLES["keep_last_1000"] = _newest(1000)
ORACLES["latest_1200"] = _newest(1200)

ORACLES["latest_60_ticks"] = """
SELECT event_type AS "Ticker", event_id, value AS "Price"
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 60"""

ORACLES["served_entry_range"] = f"""
WITH {_TICKS}, {_bars(5)}
SELECT ticker, epoch_ms(window_end) AS entry_id, close_price AS close
FROM bars
WHERE ticker = 'click'
  AND window_end BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'
ORDER BY window_end
LIMIT 200"""

# --- Messages and serving --------------------------------------------------------------

ORACLES["parse_bars_json"] = f"""
WITH {_TICKS}, {_bars(5)}
SELECT * REPLACE (strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
                  strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end)
FROM bars"""

ORACLES["parse_indicators_json"] = f"""
WITH {_TICKS}, {_bars(60)}, means AS ({_means(9)})
SELECT 'OHLC_60M_EMA_9' AS topic, ticker, epoch_ms(snapshot_time) AS entry_id,
       ema_value AS ema, snapshot_time AS timestamp
FROM means"""

ORACLES["route_messages"] = """
SELECT event_id,
       CASE event_type WHEN 'click' THEN 'OHLC' WHEN 'view' THEN 'EMA'
                       WHEN 'purchase' THEN 'EMA' ELSE 'OHLC' END AS kind,
       CASE event_type WHEN 'click' THEN 'OHLC_5M:click'
                       WHEN 'view' THEN 'ohlc_5m_ema_9:view'
                       WHEN 'purchase' THEN 'Ema:purchase'
                       ELSE 'ohlc:signup' END AS key
FROM events
WHERE event_type IN ('click', 'view', 'purchase', 'signup')"""

ORACLES["serve_bars"] = f"""
WITH {_TICKS}, {_bars(60)}
SELECT 'OHLC_60M' AS topic, ticker, epoch_ms(window_end) AS entry_id,
       open_price AS open, high_price AS high, low_price AS low, close_price AS close,
       CASE WHEN ticker = 'click' THEN CAST(volume AS DOUBLE) END AS volume,
       window_end AS timestamp
FROM bars
WHERE ticker IN ('click', 'purchase')"""

ORACLES["coerce_numbers"] = """
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN value END AS number
FROM events"""

ORACLES["served_times"] = """
SELECT event_id,
       CASE WHEN event_type <> 'error' THEN date_trunc('milliseconds', ts) END
           AS indicator_time,
       CASE WHEN event_type <> 'error' THEN date_trunc('milliseconds', ts) END AS bar_time
FROM events"""

ORACLES["served_id_range"] = f"""
WITH {_TICKS}, {_bars(5)}, newest AS (
    SELECT ticker, epoch_ms(snapshot_time) AS entry_id, ema_value AS ema
    FROM ({_means(9)}) WHERE ticker = 'click'
    ORDER BY entry_id DESC LIMIT 1000
)
SELECT * FROM newest WHERE entry_id BETWEEN 1704412800000 AND 1705708800000"""

ORACLES["served_header"] = f"""
SELECT * FROM ({ORACLES['latest_bar_snapshot']}) WHERE ticker = 'click'"""

# --- Streams ---------------------------------------------------------------------------

ORACLES["stream_ohlc_5m"] = f"WITH {_TICKS}, {_bars(5)}, {_CLOSED} SELECT * FROM closed"
ORACLES["stream_ohlc_60m"] = f"WITH {_TICKS}, {_bars(60)}, {_CLOSED} SELECT * FROM closed"
ORACLES["stream_rolling_mean_9"] = (
    f"WITH {_TICKS}, {_bars(60)}, {_CLOSED} {_means(9, 'closed')}"
)
ORACLES["stream_replay_60m"] = ORACLES["stream_rolling_mean_9"]
ORACLES["stream_supervised_means"] = ORACLES["stream_rolling_mean_9"]
ORACLES["stream_job_messages"] = ORACLES["stream_rolling_mean_9"]
ORACLES["stream_job_means"] = f"""
WITH {_TICKS}, {_bars(5)}, {_CLOSED}
SELECT *, 'OHLC_5M_EMA_9' AS metric FROM ({_means(9, 'closed')})
UNION ALL
SELECT *, 'OHLC_5M_EMA_12' AS metric FROM ({_means(12, 'closed')})"""

ORACLES["publish_stream_bars"] = (
    f"WITH {_TICKS}, {_bars(60, '(ts, event_id)')}, {_CLOSED} SELECT * FROM closed"
)

ORACLES["stream_late_rows"] = f"""
WITH all_{_TICKS}, first_part AS (
    SELECT date_trunc('second', max(ts)) - INTERVAL '2 seconds' AS watermark
    FROM events WHERE event_type <> 'error'
), ticks AS (
    SELECT t.* FROM all_ticks t, first_part f
    WHERE t.ticker <> 'error'
       OR time_bucket(INTERVAL '60 minutes', t.ts) + INTERVAL '60 minutes' > f.watermark
), {_bars(60)}, {_CLOSED}
SELECT * FROM closed"""

ORACLES["stream_open_bars"] = f"""
WITH {_TICKS}, {_bars(60)}
SELECT * FROM bars WHERE window_end > {_WATERMARK}"""

ORACLES["stream_serving"] = f"""
WITH {_TICKS}, {_bars(5)}, entries AS (
    SELECT 'OHLC_5M' AS topic, ticker, window_end AS time,
           round(close_price, 6) AS number FROM bars
    UNION ALL
    SELECT 'OHLC_5M_EMA_9', ticker, snapshot_time, ema_value FROM ({_means(9)})
)
SELECT topic, ticker, epoch_ms(time) AS entry_id, number
FROM entries
QUALIFY row_number() OVER (PARTITION BY topic, ticker ORDER BY time DESC) <= 1000"""

ORACLES["stream_bars_on_bars"] = ORACLES["stream_ohlc_60m"]

_COUNTED = """counts AS (
    SELECT ticker, time_bucket(INTERVAL '60 minutes', ts) AS window_start, count(*) AS ticks
    FROM ticks GROUP BY ALL
)"""

ORACLES["stream_idle_bars"] = f"""
WITH {_TICKS}, {_bars(60)}, {_COUNTED}
SELECT * FROM bars JOIN counts USING (ticker, window_start)"""

ORACLES["stream_late_table"] = f"""
WITH late AS (
    SELECT *, time_bucket(INTERVAL '60 minutes', ts) AS window_start
    FROM events WHERE event_type = 'error'
), first_part AS (
    SELECT date_trunc('second', max(ts)) - INTERVAL '2 seconds' AS watermark
    FROM events WHERE event_type <> 'error'
)
SELECT event_type AS ticker, window_start,
       window_start + INTERVAL '60 minutes' AS window_end,
       epoch_us(ts) * 1000 AS "Timestamp", value AS "Price",
       CAST(props ->> '$.k' AS BIGINT) AS "Quantity", event_id
FROM late, first_part
WHERE window_start + INTERVAL '60 minutes' <= watermark"""

# --- Bars from bars --------------------------------------------------------------------

ORACLES["merged_bars"] = " UNION ALL ".join(
    f"SELECT *, {m} AS minutes FROM ({ORACLES[f'ohlc_{m}m']})" for m in (5, 60, 1440)
)
ORACLES["rewritten_bars"] = ORACLES["ohlc_1440m"]
ORACLES["late_file_bars"] = f"""
WITH {_TICKS}, {_bars(60)}
SELECT * FROM bars
WHERE ticker = 'error' OR CAST(window_start AS DATE) BETWEEN '2024-01-10' AND '2024-01-19'"""

# --- Models: least squares by the normal equations, eliminated one feature at a time ----


def _regression(source: str) -> str:
    return f"""moments AS (
    SELECT avg(open_price) AS m1, avg(high_price) AS m2, avg(low_price) AS m3,
           avg(volume) AS m4, avg(close_price) AS my,
           var_pop(open_price) AS a11, covar_pop(open_price, high_price) AS a12,
           covar_pop(open_price, low_price) AS a13, covar_pop(open_price, volume) AS a14,
           var_pop(high_price) AS a22, covar_pop(high_price, low_price) AS a23,
           covar_pop(high_price, volume) AS a24, var_pop(low_price) AS a33,
           covar_pop(low_price, volume) AS a34, var_pop(volume) AS a44,
           covar_pop(open_price, close_price) AS b1,
           covar_pop(high_price, close_price) AS b2,
           covar_pop(low_price, close_price) AS b3, covar_pop(volume, close_price) AS b4
    FROM {source}
), step1 AS (
    SELECT *, a22 - a12 * a12 / a11 AS c22, a23 - a12 * a13 / a11 AS c23,
           a24 - a12 * a14 / a11 AS c24, a33 - a13 * a13 / a11 AS c33,
           a34 - a13 * a14 / a11 AS c34, a44 - a14 * a14 / a11 AS c44,
           b2 - a12 * b1 / a11 AS d2, b3 - a13 * b1 / a11 AS d3, b4 - a14 * b1 / a11 AS d4
    FROM moments
), step2 AS (
    SELECT *, c33 - c23 * c23 / c22 AS e33, c34 - c23 * c24 / c22 AS e34,
           c44 - c24 * c24 / c22 AS e44, d3 - c23 * d2 / c22 AS f3, d4 - c24 * d2 / c22 AS f4
    FROM step1
), solved4 AS (
    SELECT *, (f4 - e34 * f3 / e33) / (e44 - e34 * e34 / e33) AS w4 FROM step2
), solved3 AS (
    SELECT *, (f3 - e34 * w4) / e33 AS w3 FROM solved4
), solved2 AS (
    SELECT *, (d2 - c23 * w3 - c24 * w4) / c22 AS w2 FROM solved3
), weights AS (
    SELECT *, (b1 - a12 * w2 - a13 * w3 - a14 * w4) / a11 AS w1 FROM solved2
)"""


_PREDICTION = """round(my + w1 * (open_price - m1) + w2 * (high_price - m2)
             + w3 * (low_price - m3) + w4 * (volume - m4), 4) AS prediction"""

ORACLES["linear_model_predictions"] = f"""
WITH {_TICKS}, {_bars(5)}, {_regression('bars')}
SELECT ticker, window_end, {_PREDICTION} FROM bars, weights"""

ORACLES["train_job_predictions"] = f"""
WITH {_TICKS}, {_bars(5)}, clicks AS (SELECT * FROM bars WHERE ticker = 'click'),
{_regression('clicks')}
SELECT ticker, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, {_PREDICTION}
FROM clicks, weights"""


def _trained(ticker: str) -> str:
    return f"""
SELECT * FROM (
    WITH {_TICKS}, {_bars(60)}, own AS (SELECT * FROM bars WHERE ticker = '{ticker}'),
    {_regression('own')}
    SELECT ticker, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, {_PREDICTION}
    FROM own, weights)"""


ORACLES["train_job_topics"] = f"{_trained('click')} UNION ALL {_trained('view')}"

ORACLES["train_job_by_ticker"] = " UNION ALL ".join(
    _trained(t) for t in ("click", "view", "purchase", "signup", "error")
)

# At the means of its features, a least-squares fit says the mean of its label.
ORACLES["grouped_model_weights"] = f"""
WITH {_TICKS}, {_bars(60)}
SELECT ticker, count(*) AS rows, round(avg(close_price), 4) AS prediction
FROM bars GROUP BY ticker"""

ORACLES["prediction_head"] = f"""
{ORACLES['train_job_predictions']}
ORDER BY window_end DESC LIMIT 10"""

# --- Company facts ---------------------------------------------------------------------

_FACTS = """facts AS (
    SELECT c_custkey AS ticker, c_acctbal AS "currentPrice",
           c_acctbal - c_nationkey AS "previousClose", c_acctbal * 1000000.0 AS "marketCap",
           c_acctbal * 1000.0 AS "totalRevenue", c_acctbal * 100.0 AS "netIncomeToCommon",
           c_nationkey / 2.0::DOUBLE AS "trailingPE",
           c_nationkey / 100.0::DOUBLE AS "dividendYield",
           c_nationkey / 10.0::DOUBLE AS beta, c_nationkey / 50.0::DOUBLE AS "profitMargins",
           c_nationkey / 40.0::DOUBLE AS "returnOnEquity",
           c_nationkey / 30.0::DOUBLE AS "grossMargins",
           c_nationkey / 60.0::DOUBLE AS "operatingMargins",
           c_acctbal * 1.5 AS "targetMeanPrice", c_acctbal * 2.0 AS "targetHighPrice",
           c_acctbal * 0.5 AS "targetLowPrice",
           c_nationkey / 5.0::DOUBLE AS "recommendationMean",
           c_nationkey AS "numberOfAnalystOpinions"
    FROM customer
)"""

ORACLES["company_snapshot"] = f"""
WITH {_FACTS}, balance AS (
    SELECT o_custkey, o_totalprice AS total_assets, o_totalprice * 0.25 AS total_debt,
           o_totalprice * 0.5 AS cash
    FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
), cashflow AS (
    SELECT user_id, value AS operating_cash_flow, value * 0.5 AS free_cash_flow,
           abs(value * -2.0) AS capital_expenditure
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
)
SELECT f.*, "currentPrice" - "previousClose" AS price_change,
       CASE WHEN "previousClose" <> 0
            THEN ("currentPrice" - "previousClose") / "previousClose" * 100 END
           AS price_change_pct,
       CASE WHEN "currentPrice" <> 0
            THEN ("targetMeanPrice" - "currentPrice") / "currentPrice" * 100 END AS upside,
       total_assets, total_debt, cash,
       operating_cash_flow, free_cash_flow, capital_expenditure
FROM facts f
LEFT JOIN balance b ON f.ticker = b.o_custkey
LEFT JOIN cashflow c ON f.ticker = c.user_id"""

ORACLES["latest_statement"] = """
SELECT o_custkey AS ticker, o_orderdate AS date, o_totalprice AS total_assets
FROM orders
QUALIFY row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

ORACLES["fact_price_change"] = f"""
WITH {_FACTS}
SELECT ticker, "currentPrice" - "previousClose" AS change,
       CASE WHEN "previousClose" <> 0
            THEN ("currentPrice" - "previousClose") / "previousClose" * 100 END AS percent
FROM facts"""

ORACLES["target_upside"] = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_extendedprice <> 0
            THEN (l_extendedprice * (1 + l_tax) - l_extendedprice) / l_extendedprice * 100
       END AS upside
FROM lineitem"""

ORACLES["rating_band"] = """
SELECT p_partkey,
       CASE WHEN p_size <= 15 THEN 'Strong Buy' WHEN p_size <= 25 THEN 'Buy'
            WHEN p_size <= 35 THEN 'Hold' WHEN p_size <= 45 THEN 'Sell'
            ELSE 'Strong Sell' END AS band
FROM part"""

ORACLES["amount_text"] = """
WITH amounts AS (
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice * 10000000.0
                                WHEN '2-HIGH' THEN o_totalprice * 10000.0
                                WHEN '3-MEDIUM' THEN o_totalprice * -1.0
                                WHEN '4-NOT SPECIFIED' THEN o_totalprice / 1024.0
                                ELSE o_totalprice * 10.0 END AS amount
    FROM orders
)
SELECT o_orderkey,
       CASE WHEN amount IS NULL OR amount = 0 THEN 'N/A'
            WHEN abs(amount) >= 1e12 THEN printf('$%.2fT', amount / 1e12)
            WHEN abs(amount) >= 1e9 THEN printf('$%.2fB', amount / 1e9)
            WHEN abs(amount) >= 1e6 THEN printf('$%.2fM', amount / 1e6)
            WHEN abs(amount) >= 1e3 THEN printf('$%.2fK', amount / 1e3)
            ELSE printf('$%.2f', amount) END AS amount
FROM amounts"""

ORACLES["percent_text"] = """
SELECT l_orderkey, l_linenumber,
       printf('%.2f', (l_discount * l_tax - l_quantity / 64.0::DOUBLE) * 100) || '%' AS percent
FROM lineitem"""

ORACLES["shorten_text"] = """
SELECT doc_id, substring(coalesce(text, ''), 1, 260)
       || CASE WHEN length(coalesce(text, '')) > 260 THEN '...' ELSE '' END AS summary
FROM documents"""

ORACLES["news_head"] = """
SELECT doc_id, source, substring(coalesce(text, ''), 1, 260)
       || CASE WHEN length(coalesce(text, '')) > 260 THEN '...' ELSE '' END AS summary
FROM documents ORDER BY doc_id LIMIT 10"""

ORACLES["facts_csv_scan"] = "SELECT doc_id, source, md5(text) AS digest FROM documents"
