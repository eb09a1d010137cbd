"""Independent SQL for the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

_TRADES = """
t AS (
  SELECT event_id AS trade_id, ts AS time, event_type AS product, value AS price,
         CAST(CAST(json_extract_string(props, '$.k') AS INT) / 100.0 AS DOUBLE) AS size,
         CASE WHEN event_id % 11 = 0 THEN ' BUY ' WHEN event_id % 13 = 0 THEN 'unknown'
              WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         ts + to_milliseconds(CAST((event_id * 37) % 5000 AS INT)) AS processed_at,
         CASE WHEN event_id % 3 = 0 THEN CAST((event_id * 13) % 900 AS DOUBLE) END AS latency_ms
  FROM events
)"""

_SANE = """price > 0 AND price >= CASE product WHEN 'click' THEN 1 WHEN 'error' THEN 5 WHEN 'purchase' THEN 0.5
    WHEN 'signup' THEN 2 ELSE 0 END
  AND price <= CASE product WHEN 'click' THEN 200 WHEN 'error' THEN 150 WHEN 'purchase' THEN 300
    WHEN 'signup' THEN 250 ELSE 1000000 END"""

_NORMAL = """
n AS (SELECT trade_id, time, product, price, size, lower(trim(side)) AS side,
             coalesce(latency_ms, 0) AS latency_ms, processed_at FROM t WHERE price > 0)"""

_VALID = f"""
v AS (SELECT * FROM n WHERE {_SANE})"""


def _total(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(38,8))) AS DOUBLE)"


def _mean(x: str) -> str:
    return f"({_total(x)} / count({x}))"


def _round(x: str, digits: int) -> str:
    return f"(floor(({x}) * 1e{digits} + 0.5) / 1e{digits})"


_SUMMARY = f"""
b AS (
  SELECT product, count(*) AS total_trades, {_round(_total('price') + ' / count(*)', 2)} AS average_price,
         {_round('max(price)', 2)} AS maximum_price, {_round('min(price)', 2)} AS minimum_price,
         {_round(_total('size'), 4)} AS total_volume,
         count(*) FILTER (side = 'buy') AS buy_trades, count(*) FILTER (side = 'sell') AS sell_trades,
         coalesce({_total('CASE WHEN latency_ms > 0 THEN latency_ms END')}
                  / nullif(count(*) FILTER (latency_ms > 0), 0), 0) AS avg_latency_ms
  FROM v GROUP BY product
)"""

_WINDOW_STATS = f"""count(*) AS trade_count, {_round(_total('price') + ' / count(*)', 2)} AS avg_price,
         {_round('max(price)', 2)} AS max_price, {_round('min(price)', 2)} AS min_price,
         {_round(_total('size'), 4)} AS total_volume,
         count(*) FILTER (side = 'buy') AS buy_count, count(*) FILTER (side = 'sell') AS sell_count"""

_WINDOWS = f"""
e AS (
  SELECT t.*, time_bucket(INTERVAL 10 MINUTE, time) - to_minutes(CAST(10 * i AS INT)) AS window_start
  FROM t, range(6) r(i)
),
w AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, product, {_WINDOW_STATS}
  FROM e GROUP BY window_start, product
)"""

_LATE = """
arrived AS (
  SELECT *, (row_number() OVER (PARTITION BY trade_id % 10 = 0 ORDER BY time, trade_id) - 1) // 4000 AS poll FROM t),
clocks AS (SELECT poll, max(time) AS newest FROM arrived GROUP BY poll),
until AS (
  SELECT p.poll, max(c.newest) - INTERVAL 1 DAY AS closed
  FROM (SELECT DISTINCT poll FROM arrived) p LEFT JOIN clocks c ON c.poll < p.poll GROUP BY p.poll)"""


def _late_windows() -> str:
    apart = _WINDOWS.replace("FROM t, range(6)", "FROM (SELECT * FROM arrived JOIN until USING (poll)) t, range(6)")
    kept = "FROM e WHERE coalesce(window_start + INTERVAL 1 HOUR > closed, true) GROUP"
    return _LATE + "," + apart.replace("FROM e GROUP", kept)


_NEWEST_WINDOWS = """
l AS (
  SELECT w.*, row_number() OVER (PARTITION BY product ORDER BY window_start DESC) AS recency FROM w
)"""

_RECENT_DAY = f"""
f AS (
  SELECT product, count(*) AS trades, {_round(_mean('price'), 2)} AS avg_price,
         {_round(_total('size'), 4)} AS volume,
         {_round(_mean('coalesce(latency_ms, 0)'), 0)} AS avg_latency
  FROM (
    SELECT *, count(*) FILTER (recent) OVER (PARTITION BY product) AS recents,
           row_number() OVER (PARTITION BY product ORDER BY processed_at DESC, trade_id DESC) AS rn
    FROM (SELECT *, processed_at >= (SELECT max(processed_at) FROM t) - INTERVAL 1 DAY AS recent FROM t)
  ) WHERE recent OR (recents = 0 AND rn <= 30)
  GROUP BY product
)"""

_RUNS = f"""
r AS (
  SELECT product AS name, [1, 2, 4, 8][trade_id % 4 + 1] AS workers, (trade_id // 4) % 5 AS iteration,
         {_mean('price')} AS time_ms
  FROM t GROUP BY 1, 2, 3
),
s AS (
  SELECT name, workers, count(*) AS runs, avg(time_ms) AS avg_ms, min(time_ms) AS min_ms, max(time_ms) AS max_ms,
         string_agg(printf('%.6f', time_ms), ' ' ORDER BY iteration) AS times
  FROM r GROUP BY name, workers
),
p AS (
  SELECT name, workers, first_value(avg_ms) OVER (PARTITION BY name ORDER BY workers) / avg_ms AS speedup,
         first_value(avg_ms) OVER (PARTITION BY name ORDER BY workers) / avg_ms / workers * 100 AS efficiency,
         avg_ms AS time_ms
  FROM s
)"""

_FLUSHES = """
numbered AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY time, trade_id) AS place FROM t),
later AS (
  SELECT a.product, a.place, min(b.place) AS place_later
  FROM numbered a JOIN numbered b ON a.product = b.product AND b.place > a.place AND b.place < a.place + 20
       AND b.time >= a.time + INTERVAL 6 HOUR GROUP BY ALL),
steps AS (
  SELECT product, place, coalesce(place_later, place + 20) AS stop, CASE WHEN place_later IS NULL AND place + 20 <= most + 1
         THEN 'count' ELSE 'time' END AS reason
  FROM numbered LEFT JOIN later USING (product, place) JOIN (SELECT product, max(place) AS most FROM numbered GROUP BY 1) USING (product)),
hops AS (
  SELECT product, 0::BIGINT AS flush, place AS start, stop, reason FROM steps WHERE place = 1
  UNION ALL
  SELECT h.product, h.flush + 1, s.place, s.stop, s.reason FROM hops h JOIN steps s ON s.product = h.product AND s.place = h.stop)"""

_POOL = """
pool AS (
  SELECT trade_id, product, time, latency_ms AS latency FROM t WHERE latency_ms IS NOT NULL
  UNION ALL
  SELECT trade_id, product, time, (epoch_us(processed_at) - epoch_us(time)) / 1000.0 FROM t
)"""

_BY_RATE = f"""
rate AS (SELECT date_trunc('hour', time) AS at, count(*) AS rate FROM t GROUP BY 1),
q AS (
  SELECT CAST(CASE WHEN rate <= 10 THEN 10 WHEN rate <= 50 THEN 50 WHEN rate <= 100 THEN 100
              WHEN rate <= 200 THEN 200 ELSE 500 END AS INT) AS rate_bucket,
         count(*) AS samples, {_mean('latency')} AS avg_latency,
         quantile_cont(latency, 0.95) AS p95_latency, quantile_cont(latency, 0.99) AS p99_latency
  FROM pool JOIN rate ON date_trunc('hour', pool.time) = rate.at GROUP BY 1
)"""

_TICKS = f"""
k AS (
  SELECT product AS fleet, date_trunc('hour', time) AS ts, trade_id % 7 AS instance_id,
         arg_max(price, time) FILTER (trade_id % 9 <> 0) AS cpu
  FROM t GROUP BY 1, 2, 3
),
ticks AS (
  SELECT fleet, ts, coalesce({_mean('cpu')}, 0) AS cpu, count(cpu) AS instances_with_data, count(*) AS instances,
         CAST(count(*) % 3 + 1 AS INT) AS level
  FROM k GROUP BY fleet, ts
)"""

_ALERTS = f"""
lows AS (
  SELECT *, level > 1 AND cpu < 45 AS low,
         sum(CASE WHEN level > 1 AND cpu < 45 THEN 0 ELSE 1 END)
           OVER (PARTITION BY fleet ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run
  FROM ticks
),
held AS (
  SELECT *, low AND epoch(ts) - epoch(min(ts) FILTER (low) OVER (PARTITION BY fleet, run)) > 7200 AS down,
         level < 3 AND cpu > 60 AS up
  FROM lows
),
able AS (SELECT *, CASE WHEN up THEN 'scale_up' ELSE 'scale_down' END AS action FROM held WHERE up OR down),
hop AS MATERIALIZED (
  SELECT a.fleet, a.ts, b.ts AS next
  FROM (SELECT *, ts + to_seconds(10800 + CASE WHEN up THEN 16 ELSE 1 END) AS ready FROM able) a
  ASOF JOIN able b ON a.fleet = b.fleet AND a.ready < b.ts
),
act AS (
  SELECT fleet, min(ts) AS ts FROM able GROUP BY fleet
  UNION ALL
  SELECT act.fleet, hop.next FROM act JOIN hop ON hop.fleet = act.fleet AND hop.ts = act.ts
)"""

_TOP = """
x AS (
  SELECT window_start, product, row_number() OVER (
           PARTITION BY product, window_start ORDER BY size DESC, processed_at, trade_id) AS rank,
         trade_id, price, size, side
  FROM e
)"""

_SNAPSHOTS = f"""
o AS (
  SELECT *, date_trunc('hour', processed_at) AS slot FROM t
),
a AS (
  SELECT *, row_number() OVER (PARTITION BY product, slot ORDER BY processed_at, trade_id) AS arrival,
         count(*) OVER last AS trade_count,
         CAST(sum(CAST(price AS DECIMAL(38,8))) OVER last AS DOUBLE) AS price_sum,
         max(price) OVER last AS max_p, min(price) OVER last AS min_p,
         CAST(sum(CAST(size AS DECIMAL(38,8))) OVER last AS DOUBLE) AS size_sum,
         CAST(sum(CASE WHEN side = 'buy' THEN 1 ELSE 0 END) OVER last AS BIGINT) AS buy_count,
         CAST(sum(CASE WHEN side = 'sell' THEN 1 ELSE 0 END) OVER last AS BIGINT) AS sell_count,
         list({{'a': -size, 'b': processed_at, 'c': trade_id}}) OVER last AS held
  FROM o
  WINDOW last AS (PARTITION BY product ORDER BY processed_at, trade_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
)"""

_DEFAULT_SNAPSHOTS = (
    _SNAPSHOTS.replace("date_trunc('hour', processed_at)", "time_bucket(INTERVAL 10 SECOND, processed_at)")
    .replace("ROWS BETWEEN 9 PRECEDING", "ROWS BETWEEN 9999 PRECEDING")
    .replace("list({'a': -size, 'b': processed_at, 'c': trade_id}) OVER last", "NULL")
)

_SNAPSHOT_ROWS = f"""
SELECT product, trade_count, {_round('price_sum / trade_count', 2)} AS avg_price,
       {_round('max_p', 2)} AS max_price, {_round('min_p', 2)} AS min_price,
       {_round('size_sum', 4)} AS total_volume, buy_count, sell_count, processed_at AS generated_at,
       trade_id AS emitted_by, slot AS window_start,
       array_to_string(list_transform(list_slice(list_sort(held), 1, 5), lambda h: h.c), ' ') AS top_ids
FROM a WHERE arrival = 1"""

_THROTTLE_HOP = """
hop AS MATERIALIZED (
  SELECT a.{key}, a.time, b.time AS next
  FROM t a ASOF JOIN t b ON a.{key} = b.{key} AND a.time + INTERVAL 300 SECOND <= b.time
),
kept AS (
  SELECT {key}, min(time) AS time FROM t GROUP BY {key}
  UNION ALL
  SELECT kept.{key}, hop.next FROM kept JOIN hop ON hop.{key} = kept.{key} AND hop.time = kept.time
)
SELECT t.product, t.trade_id, t.time FROM kept JOIN t ON t.{key} = kept.{key} AND t.time = kept.time"""

_METRIC_ROWS = f"""
SELECT product, metric, value FROM (
  SELECT product, CAST(count(*) AS DOUBLE) AS "count", {_total('price')} AS price_sum, max(price) AS price_max,
         min(price) AS price_min, {_total('size')} AS volume,
         {_total('CASE WHEN latency_ms > 0 THEN latency_ms END')} AS latency_sum,
         CAST(nullif(count(*) FILTER (latency_ms > 0), 0) AS DOUBLE) AS latency_count,
         CAST(nullif(count(*) FILTER (side = 'buy'), 0) AS DOUBLE) AS buy_count,
         CAST(nullif(count(*) FILTER (side = 'sell'), 0) AS DOUBLE) AS sell_count
  FROM v GROUP BY product
) UNPIVOT (value FOR metric IN ("count", price_sum, price_max, price_min, volume, latency_sum, latency_count,
                                buy_count, sell_count))"""


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE" if recursive else "WITH") + ",".join(parts)


_T = _with(_TRADES)
_V = _with(_TRADES, _NORMAL, _VALID)
_B = _with(_TRADES, _NORMAL, _VALID, _SUMMARY)
_W = _with(_TRADES, _WINDOWS)
_L = _with(_TRADES, _WINDOWS, _NEWEST_WINDOWS)
_S = _with(_TRADES, _RUNS)
_WINDOW_COLUMNS = (
    "window_start, window_end, product, trade_count, avg_price, max_price, min_price, total_volume, "
    "buy_count, sell_count"
)
_TRADE_COLUMNS = "trade_id, time, product, price, size, side, processed_at, latency_ms"
_ABSENT = "Batch processing not yet run. Please run batch processor."
_SERVED = {
    "trades": "total_trades",
    "avg_price": "average_price",
    "max_price": "maximum_price",
    "min_price": "minimum_price",
    "volume": "total_volume",
    "buys": "buy_trades",
    "sells": "sell_trades",
    "avg_latency": "avg_latency_ms",
}
_FLAT = "m AS (SELECT product, " + ", ".join(
    [f"coalesce(f.{c}, 0) AS speed_{c}" for c in ("trades", "avg_price", "volume", "avg_latency")]
    + [f"coalesce(b.{c}, 0) AS batch_{name}" for name, c in _SERVED.items()]
    + [f"CASE WHEN b.product IS NULL THEN '{_ABSENT}' ELSE 'batch_available' END AS status"]
) + " FROM f FULL JOIN b USING (product))"


def _dedup() -> str:
    return """
SELECT product, trade_id, price, size, processed_at FROM (
  SELECT product, trade_id // 3 AS trade_id, price, size, processed_at,
         row_number() OVER (PARTITION BY product, trade_id // 3
                            ORDER BY processed_at DESC, time DESC, price DESC, size DESC, side DESC) AS rn
  FROM t
) WHERE rn = 1"""


def _throughput(order: str) -> str:
    return f"""{_T}
SELECT strftime(minute, '%Y-%m-%d %H:%M') AS "timestamp", trades_per_minute, avg_price, volume FROM (
  SELECT date_trunc('minute', coalesce(processed_at, time)) AS minute, count(*) AS trades_per_minute,
         {_mean('price')} AS avg_price, {_total('size')} AS volume
  FROM t GROUP BY 1 ORDER BY 1 {order} LIMIT 30)"""


_SERIES = f"""
h AS (SELECT date_trunc('hour', processed_at) AS at, count(*) AS n FROM t GROUP BY 1),
z AS (
  SELECT max(n) AS peak_throughput, {_round('avg(n)', 6)} AS avg_throughput, CAST(sum(n) AS BIGINT) AS total_trades,
         {_round('(SELECT avg(avg_latency) FROM q)', 6)} AS avg_latency,
         {_round('(SELECT max(speedup) FROM p)', 6)} AS best_speedup,
         {_round('(SELECT max(efficiency) FROM p)', 6)} AS best_efficiency,
         {_round('(SELECT min(time_ms) FROM p)', 6)} AS fastest_time
  FROM h
)"""
_Z = _with(_TRADES, _POOL, _BY_RATE, _RUNS, _SERIES)

ORACLE: dict[str, str] = {
    "parse_matches": f"""{_T}
SELECT time, product, price, size, side, trade_id, processed_at AS received_at FROM t WHERE trade_id % 5 <> 0""",
    "scan_json_arrays": f"{_T} SELECT {_TRADE_COLUMNS} FROM t",
    "scan_speed_store": f"""{_T}
SELECT trade_id, time, product, price, size, side FROM (
  SELECT *, row_number() OVER (PARTITION BY product ORDER BY processed_at DESC, trade_id DESC) AS rn FROM t
) WHERE rn <= 200""",
    "scan_window_store": f"{_W} SELECT {_WINDOW_COLUMNS} FROM w WHERE product = 'click'",
    "lookup_batch_summary": f"""{_B}
SELECT product, {', '.join(f'{c} AS {name}' for name, c in _SERVED.items())} FROM b WHERE product = 'click'""",
    "stream_trades": f"{_T} SELECT {_TRADE_COLUMNS} FROM t",
    "sql_catalog": f"""{_T}
SELECT product, side, count(*) AS trade_count, {_total('size')} AS total_volume FROM t GROUP BY product, side""",
    "sink_keyed_stream": f"{_T} SELECT {_TRADE_COLUMNS} FROM t",
    "sink_raw_batches": f"{_T} SELECT {_TRADE_COLUMNS} FROM t",
    "sink_speed_upsert": _T + _dedup(),
    "sink_merged_store": _T + _dedup(),
    "scan_broken_arrays": f"{_T} SELECT {_TRADE_COLUMNS} FROM t WHERE trade_id // 500 % 7 <> 3",
    "scan_reject_report": f"""{_T}
SELECT trade_id // 500 AS file_no, count(*) FILTER (trade_id // 500 % 7 <> 3) AS records,
       CASE WHEN trade_id // 500 % 7 = 3 THEN 1 ELSE 0 END::BIGINT AS rejects,
       CASE WHEN trade_id // 500 % 7 = 3 THEN 'malformed json' ELSE '' END AS reasons
FROM t GROUP BY trade_id // 500""",
    "sink_window_summary": f"{_W} SELECT {_WINDOW_COLUMNS} FROM w",
    "sink_batch_json": f"{_B} SELECT * FROM b",
    "sink_batch_csv": f"{_B} SELECT * FROM b",
    "sink_report_csv": f"""{_S}
SELECT name, workers, {_round('avg_ms', 6)} AS avg_ms, runs, {_round('max_ms', 6)} AS max_ms,
       {_round('min_ms', 6)} AS min_ms, times FROM s""",
    "sink_report_json": f"""{_S}
SELECT (SELECT string_agg(r, ' ' ORDER BY r)
        FROM (SELECT concat_ws(':', name, workers, printf('%.6f', avg_ms)) AS r FROM s)) AS results,
       (SELECT count(*) FROM s) AS result_rows, count(*) AS speedup_rows,
       {_round('max(speedup)', 6)} AS best_speedup, {_round('max(efficiency)', 6)} AS best_efficiency,
       {_round('min(time_ms)', 6)} AS fastest_time
FROM p""",
    "price_sanity_filter": f"{_T} SELECT trade_id, product, price FROM t WHERE {_SANE}",
    "sanity_counters": f"""{_T}
SELECT count(*) FILTER ({_SANE}) AS valid, count(*) FILTER (NOT ({_SANE})) AS skipped, 0::BIGINT AS rejected FROM t""",
    "normalize_trades": f"{_with(_TRADES, _NORMAL)} SELECT trade_id, product, price, size, side, latency_ms FROM n",
    "require_product": f"""{_T}
SELECT trade_id, product FROM t WHERE trade_id % 10 <> 0 AND trade_id % 7 <> 0""",
    "recent_trades": f"""{_T}
SELECT trade_id, product, CASE WHEN trade_id % 50 = 0 THEN 'junk'
         ELSE strftime(processed_at, '%Y-%m-%dT%H:%M:%S.%fZ') END AS processed_at
FROM t WHERE trade_id % 50 = 0
  OR processed_at >= (SELECT max(processed_at) FROM t WHERE trade_id % 50 <> 0) - INTERVAL 1 DAY""",
    "recent_or_last_n": f"""{_T}
SELECT trade_id, product, price, size FROM (
  SELECT *, count(*) FILTER (recent) OVER (PARTITION BY product) AS recents,
         row_number() OVER (PARTITION BY product ORDER BY processed_at DESC, trade_id DESC) AS rn
  FROM (SELECT *, processed_at >= (SELECT max(processed_at) FROM t) - INTERVAL 5 MINUTE AS recent FROM t)
) WHERE recent OR (recents = 0 AND rn <= 30)""",
    "sql_conjunct_filter": f"""{_T}
SELECT trade_id, product, price FROM t
WHERE product = 'click' AND processed_at >= (SELECT max(processed_at) FROM t) - INTERVAL 5 DAY""",
    "event_time_fallback": f"""{_T}
SELECT trade_id, CASE WHEN trade_id % 7 <> 0 THEN processed_at ELSE time END AS event_time
FROM t WHERE trade_id % 14 <> 0""",
    "latency_per_trade": f"{_with(_TRADES, _POOL)} SELECT trade_id, latency FROM pool",
    "stamp_processed": f"{_T} SELECT trade_id, time + INTERVAL 1 SECOND AS processed_at FROM t",
    "default_fill": f"""{_W}
SELECT product, window_start, window_end, trade_count, CASE WHEN trade_count > 1 THEN avg_price ELSE 0 END AS avg_price,
       max_price, min_price, total_volume, buy_count, sell_count FROM w""",
    "safe_number_format": f"""{_T}
SELECT trade_id, printf('$%.2f', CASE WHEN trade_id % 9 = 0 THEN 0.0::DOUBLE ELSE price END) AS money,
       printf('%.4f', size) AS volume FROM t""",
    "merged_view": f"""{_with(_TRADES, _NORMAL, _VALID, _SUMMARY, _RECENT_DAY, _WINDOWS, _NEWEST_WINDOWS, _FLAT)}
SELECT m.*, coalesce(c.window_rows, 0) AS window_rows, c.newest_window, c.newest_count,
       coalesce(c.windows, '') AS windows
FROM m LEFT JOIN (SELECT product, count(*) AS window_rows, max(window_start) AS newest_window,
                         max(trade_count) FILTER (recency = 1) AS newest_count,
                         string_agg(concat_ws(':', CAST(epoch(window_start) AS BIGINT), trade_count, buy_count, sell_count,
                           CAST(floor(avg_price * 100 + 0.5) AS BIGINT), CAST(floor(max_price * 100 + 0.5) AS BIGINT),
                           CAST(floor(min_price * 100 + 0.5) AS BIGINT), CAST(floor(total_volume * 10000 + 0.5) AS BIGINT)),
                           ' ' ORDER BY recency) AS windows
                  FROM l WHERE recency <= 10 GROUP BY product) c USING (product)""",
    "batch_lookup_or_zero": f"""{_B}
SELECT product, {', '.join(f'coalesce({c}, 0) AS {name}' for name, c in _SERVED.items())},
       CASE WHEN total_trades IS NULL THEN '{_ABSENT}' ELSE 'batch_available' END AS status
FROM (SELECT product FROM t UNION SELECT n_name FROM nation) LEFT JOIN b USING (product)""",
    "latency_by_rate": f"""{_with(_TRADES, _POOL, _BY_RATE)}
SELECT rate_bucket, samples, {', '.join(f'{_round(c, 6)} AS {c}' for c in ('avg_latency', 'p95_latency', 'p99_latency'))}
FROM q""",
    "relative_to_baseline": f"""{_S}
SELECT name, workers, {', '.join(f'{_round(c, 6)} AS {c}' for c in ('speedup', 'efficiency', 'time_ms'))} FROM p""",
    "speed_vs_batch_delta": f"""{_with(_TRADES, _NORMAL, _VALID, _SUMMARY, _RECENT_DAY, _FLAT)}
SELECT product, speed_trades, batch_trades, speed_trades - batch_trades AS trades_delta,
       {', '.join(f'{_round(f"speed_{c} - batch_{c}", 6)} AS {c}_delta' for c in ('avg_price', 'volume', 'avg_latency'))}
FROM m""",
    "batch_summary": f"{_B} SELECT * FROM b",
    "metric_pairs": f"""{_V}
SELECT product, metric, count(*) AS pairs FROM (
  SELECT product, unnest(['count', 'price_sum', 'price_max', 'price_min', 'volume']) AS metric FROM v
  UNION ALL SELECT product, unnest(['latency_sum', 'latency_count']) FROM v WHERE latency_ms > 0
  UNION ALL SELECT product, side || '_count' FROM v WHERE side IN ('buy', 'sell')
) GROUP BY product, metric""",
    "reduce_by_metric": _V + _METRIC_ROWS,
    "reduce_pairs": _V + _METRIC_ROWS,
    "pivot_metrics": f"""{_V}
SELECT product, CAST(count(*) AS DOUBLE) AS "count", {_total('price')} AS price_sum, max(price) AS price_max,
       min(price) AS price_min, {_total('size')} AS volume,
       coalesce({_total('CASE WHEN latency_ms > 0 THEN latency_ms END')}, 0) AS latency_sum,
       CAST(count(*) FILTER (latency_ms > 0) AS DOUBLE) AS latency_count,
       CAST(count(*) FILTER (side = 'buy') AS DOUBLE) AS buy_count,
       CAST(count(*) FILTER (side = 'sell') AS DOUBLE) AS sell_count
FROM v GROUP BY product""",
    "avg_latency_by_product": f"""{_V}
SELECT product, {_mean('CASE WHEN latency_ms > 0 THEN latency_ms END')} AS avg_latency_ms FROM v GROUP BY product""",
    "product_stats_raw": f"""{_T}
SELECT product, count(*) AS "count", {_total('price')} AS price_sum, max(price) AS price_max, min(price) AS price_min,
       {_total('size')} AS volume, count(*) FILTER (side = 'buy') AS buy_count,
       count(*) FILTER (side = 'sell') AS sell_count
FROM t GROUP BY product""",
    "product_sums": f"""{_T}
SELECT product, count(*) AS "count", {_total('price')} AS sum_price, {_total('size')} AS sum_size
FROM t GROUP BY product""",
    "partial_final_agg": f"{_B} SELECT * FROM b",
    "recent_summary": f"{_with(_TRADES, _RECENT_DAY)} SELECT * FROM f",
    "throughput_per_minute": _throughput("ASC"),
    "throughput_last_minutes": _throughput("DESC"),
    "minute_of_day_history": f"""{_T}
SELECT strftime(processed_at, '%H:%M') AS minute, count(*) AS trades, {_round(_mean('price'), 2)} AS price,
       {_round(_total('size'), 4)} AS volume
FROM t GROUP BY 1 ORDER BY 1 DESC LIMIT 20""",
    "sql_recent_totals": f"""{_T}
SELECT count(*) AS trade_count, {_mean('price')} AS avg_price, {_total('size')} AS total_volume
FROM t WHERE processed_at >= (SELECT max(processed_at) FROM t) - INTERVAL 1440 MINUTE""",
    "sql_recent_count": f"""{_T}
SELECT count(*) AS trade_count FROM t
WHERE product = 'click' AND processed_at >= (SELECT max(processed_at) FROM t) - INTERVAL 7200 MINUTE""",
    "latency_avg_p95": f"""{_T}
SELECT {_round(_mean('latency_ms'), 6)} AS avg_latency,
       {_round('quantile_cont(latency_ms, 0.95)', 6)} AS p95_latency
FROM t WHERE processed_at >= (SELECT max(processed_at) FROM t) - INTERVAL 7200 MINUTE""",
    "latency_sketch_rollup": f"""{_with(_TRADES, _POOL)},
r AS (SELECT product, latency, row_number() OVER (PARTITION BY product ORDER BY latency) AS place,
             count(*) OVER (PARTITION BY product) AS n FROM pool)
SELECT product, count(*) AS samples, max(latency) AS max_latency, {_round(_mean('latency'), 6)} AS avg_latency,
       {', '.join(f"{_round(f'max(latency) FILTER (place = ceil({p} * n))', 6)} AS p{c}_latency" for p, c in ((0.5, 50), (0.95, 95), (0.99, 99)))}
FROM r GROUP BY product""",
    "latency_sketch_error": f"""{_with(_TRADES, _POOL)}
SELECT product, count(*) AS samples, true AS p50_latency_within, true AS p95_latency_within, true AS p99_latency_within
FROM pool GROUP BY product""",
    "latency_pool_avg": f"""{_with(_TRADES, _POOL)}
SELECT count(*) AS samples, {_mean('latency')} AS avg_latency FROM pool""",
    "run_stats": f"""{_S}
SELECT name, workers, runs, {', '.join(f'{_round(c, 6)} AS {c}' for c in ('avg_ms', 'min_ms', 'max_ms'))}, times FROM s""",
    "series_summary": f"{_Z} SELECT * FROM z",
    "scaling_tier": f"""{_Z}
SELECT best_speedup, peak_throughput,
       CASE WHEN best_speedup > 3 THEN 'excellent' WHEN best_speedup > 1.5 THEN 'good' ELSE 'limited' END AS scaling_tier,
       CASE WHEN peak_throughput > 50 THEN 'high' WHEN peak_throughput > 30 THEN 'moderate' ELSE 'low' END
         AS throughput_tier
FROM z""",
    "trend_line": f"""{_with(_TRADES, '''
d AS (SELECT product, date_trunc('day', time)::TIMESTAMP AS day, count(*) AS trades FROM t GROUP BY 1, 2),
i AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY day) - 1 AS idx FROM d),
g AS (SELECT product, regr_slope(trades, idx) AS slope, regr_intercept(trades, idx) AS intercept FROM i GROUP BY 1)''')}
SELECT product, day, trades, {_round('slope', 6)} AS slope, {_round('intercept', 6)} AS intercept,
       {_round('intercept + slope * idx', 6)} AS fitted
FROM i JOIN g USING (product)""",
    "best_parallel": f"""{_S}
SELECT name, arg_min(workers, avg_ms) FILTER (workers > 1) AS best_workers,
       {_round('min(avg_ms) FILTER (workers = 1)', 6)} AS sequential_ms,
       {_round('min(avg_ms) FILTER (workers > 1)', 6)} AS best_ms,
       {_round('min(avg_ms) FILTER (workers = 1) / min(avg_ms) FILTER (workers > 1)', 6)} AS speedup
FROM s GROUP BY name""",
    "fleet_average": f"""{_with(_TRADES, _TICKS)}
SELECT fleet, ts, cpu, instances_with_data, instances FROM ticks""",
    "batch_counters": f"""{_V}
SELECT (SELECT count(*) FROM t) AS rows_read, (SELECT count(*) FROM t WHERE {_SANE}) AS valid_rows,
       count(*) AS mapped_rows,
       CAST(sum(5 + CASE WHEN latency_ms > 0 THEN 2 ELSE 0 END + CASE WHEN side IN ('buy', 'sell') THEN 1 ELSE 0 END)
            AS BIGINT) AS pair_count,
       (SELECT count(*) FROM t WHERE {_SANE}) = 0 AS is_empty
FROM v""",
    "observed_counters": f"""{_V}
SELECT (SELECT count(*) FROM t) AS rows_read, (SELECT count(*) FROM t WHERE {_SANE}) AS valid_rows,
       count(*) AS mapped_rows,
       CAST(sum(5 + CASE WHEN latency_ms > 0 THEN 2 ELSE 0 END + CASE WHEN side IN ('buy', 'sell') THEN 1 ELSE 0 END)
            AS BIGINT) AS pair_count,
       (SELECT count(*) FROM t WHERE {_SANE}) = 0 AS is_empty
FROM v""",
    "stream_observed_counters": f"""{_V}
SELECT (SELECT count(*) FROM t) AS rows_read, (SELECT count(*) FROM t WHERE {_SANE}) AS valid_rows,
       count(*) AS mapped_rows,
       CAST(sum(5 + CASE WHEN latency_ms > 0 THEN 2 ELSE 0 END + CASE WHEN side IN ('buy', 'sell') THEN 1 ELSE 0 END)
            AS BIGINT) AS pair_count
FROM v""",
    "rolling_last_n_snapshot": _with(_TRADES, _SNAPSHOTS) + _SNAPSHOT_ROWS,
    "rolling_last_n_default": _with(_TRADES, _DEFAULT_SNAPSHOTS)
    + _SNAPSHOT_ROWS[: _SNAPSHOT_ROWS.index(",\n       array_to_string")]
    + "\nFROM a WHERE arrival = 1",
    "slot_first_emission": f"""{_with(_TRADES, _SNAPSHOTS)}
SELECT product, slot AS slot_start, trade_id, processed_at AS emitted_at FROM a WHERE arrival = 1""",
    "window_label": f"""{_with(_TRADES, _SNAPSHOTS)}
SELECT product, slot AS window_start, slot + INTERVAL 60 SECOND AS window_end, count(*) AS trades_in_slot
FROM o GROUP BY product, slot""",
    "sliding_window_summary": f"{_W} SELECT {_WINDOW_COLUMNS} FROM w",
    "sliding_window_default": _with(
        _TRADES,
        _WINDOWS.replace("INTERVAL 10 MINUTE", "INTERVAL 10 SECOND")
        .replace("to_minutes(", "to_seconds(")
        .replace("INTERVAL 1 HOUR", "INTERVAL 60 SECOND"),
    )
    + f" SELECT {_WINDOW_COLUMNS} FROM w",
    "top_k_trades_per_window": f"{_with(_TRADES, _WINDOWS, _TOP)} SELECT * FROM x WHERE rank <= 5",
    "latest_windows": f"{_L} SELECT * FROM l WHERE recency <= 10",
    "window_history": f"""{_L}
SELECT product, recency, strftime(window_start, '%H:%M:%S') AS "timestamp", trade_count, avg_price,
       total_volume AS volume
FROM l WHERE recency <= 10""",
    "first_n_by_key": f"""{_T}
SELECT 'speed/' || trade_id || '.json' AS key, trade_id, product, price FROM t ORDER BY key LIMIT 500""",
    "union_pages": f"""{_T}
SELECT trade_id, product, price, CASE WHEN trade_id % 3 <> 1 THEN latency_ms END AS latency_ms FROM t""",
    "dedup_by_trade_id": _T + _dedup(),
    "throttle_min_gap": _with(_TRADES, _THROTTLE_HOP.format(key="product"), recursive=True),
    "throttle_all_products": _with(
        _TRADES.replace("SELECT event_id", "SELECT 0 AS feed, event_id"),
        _THROTTLE_HOP.format(key="feed"),
        recursive=True,
    ),
    "stream_throttle_all": _with(
        _TRADES.replace("SELECT event_id", "SELECT 0 AS feed, event_id"),
        _THROTTLE_HOP.format(key="feed"),
        recursive=True,
    ),
    "stream_throttle": _with(_TRADES, _THROTTLE_HOP.format(key="product"), recursive=True),
    "stream_sliding_windows": f"{_W} SELECT {_WINDOW_COLUMNS} FROM w",
    "stream_windows_and_late": f"""{_with(_TRADES, _late_windows())}
SELECT {_WINDOW_COLUMNS} FROM w WHERE window_end <= (SELECT max(time) - INTERVAL 1 DAY FROM t)""",
    "stream_late_rows": f"""{_with(_TRADES, _late_windows())}
SELECT product, trade_id, time, count(*) AS missed
FROM e WHERE window_start + INTERVAL 1 HOUR <= closed GROUP BY ALL""",
    "stream_shard_polls": f"""{_T},
numbered AS (
  SELECT *, trade_id % 16 AS shard, row_number() OVER (PARTITION BY trade_id % 16 ORDER BY time, trade_id) - 1 AS number FROM t),
start AS (SELECT shard, least(count(*), (SELECT count(*) // 32 FROM t)) AS first_number FROM numbered GROUP BY shard)
SELECT shard, number, trade_id, price, (number - first_number) // 200 AS poll
FROM numbered JOIN start USING (shard) WHERE number >= first_number""",
    "stream_dead_letters": f"""{_T}
SELECT CAST(trade_id AS VARCHAR) AS trade_id, CASE WHEN trade_id % 10 <> 0 THEN product END AS product,
       CASE WHEN trade_id % 21 = 0 THEN 'broken' ELSE CAST(price AS VARCHAR) END AS price,
       CASE WHEN trade_id % 21 = 0 THEN 'price is not a number' ELSE 'product is missing' END AS reason, 2::BIGINT AS records
FROM t WHERE trade_id % 10 = 0 OR trade_id % 21 = 0""",
    "stream_rolling_last_n": _with(_TRADES, _SNAPSHOTS) + _SNAPSHOT_ROWS,
    "stream_enrich_dedup": f"""{_T}
SELECT trade_id, product, price, size, time, time + INTERVAL 2 SECOND AS processed_at
FROM t WHERE trade_id % 10 <> 0 AND trade_id % 21 <> 0""",
    "micro_batch_refresh": f"{_B} SELECT * FROM b",
    "flush_count_or_time": f"""{_with(_TRADES, _FLUSHES, recursive=True)}
SELECT product, flush, reason, count(*) AS rows, min(trade_id) AS first_id, max(time) AS last_time
FROM hops JOIN numbered USING (product) WHERE place >= start AND place < stop GROUP BY ALL""",
    "flush_file_sizes": f"{_T} SELECT count(*) AS rows, 0::BIGINT AS oversized_files FROM t",
}

_EVENTS = f"""
SELECT fleet, ts AS "timestamp", action, level AS old_capacity,
       CAST(level + CASE WHEN up THEN 1 ELSE -1 END AS INT) AS new_capacity,
       CASE WHEN up THEN 'CPU ' || printf('%.1f', {_round('cpu', 1)}) || '% > 60%'
            ELSE 'CPU ' || printf('%.1f', {_round('cpu', 1)}) || '% < 45% for 7200s' END AS reason
FROM act JOIN able USING (fleet, ts)"""
ORACLE["hysteresis_alerts"] = _with(_TRADES, _TICKS, _ALERTS, recursive=True) + _EVENTS
ORACLE["stream_hysteresis_alerts"] = ORACLE["hysteresis_alerts"]
