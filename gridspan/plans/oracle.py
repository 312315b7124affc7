"""DuckDB twins of the registered queries, over the same tables."""

from __future__ import annotations

from gridspan import schemas
from gridspan.plans.standins import EVENT_TYPES

STAMP = "TIMESTAMP '2025-01-02 03:04:05'"
STAMP_DATE = "DATE '2025-01-02'"

ORACLE: dict[str, str] = {}

# Hourly shapes shared by many queries

_SUMS = ",\n".join(
    f"""round(sum(value) FILTER (WHERE event_type = '{t}'), 4) AS "{zone}" """
    for zone, t in zip(schemas.ZONES, EVENT_TYPES)
)
_COUNTS = ",\n".join(
    f"""CAST(nullif(count(value) FILTER (WHERE event_type = '{t}'), 0) AS DOUBLE) AS "{zone}" """
    for zone, t in zip(schemas.ZONES[5:], EVENT_TYPES)
)
_HOURLY = f"""
slots AS (
  SELECT CAST(ts AS DATE) AS "Date", CAST(hour(ts) + 1 AS INTEGER) AS "Hour",
    round(coalesce(sum(value) FILTER (WHERE event_type <> 'error'), 0.0), 4) AS "Ontario_Demand",
    {_SUMS}, {_COUNTS},
    round(sum(value) + count(value), 4) AS "Zone_Total"
  FROM events GROUP BY 1, 2),
hourly AS (
  SELECT *, round("Zone_Total" - "Ontario_Demand", 4) AS "Diff" FROM slots)
"""
_ZONE_LIST = ", ".join(f'"{z}"' for z in schemas.ZONES)
_LONG = f"""
SELECT "Date", "Hour", "Modified_DT", "Ontario_Demand", "Zone_Total", "Diff", "Zone", "Value"
FROM (SELECT *, {STAMP} AS "Modified_DT" FROM hourly)
UNPIVOT INCLUDE NULLS ("Value" FOR "Zone" IN ({_ZONE_LIST}))
"""
_DATED = """
dated AS (
  SELECT CAST(ts AS DATE) AS "Date", event_id, user_id, event_type, value FROM events),
newest AS (SELECT max("Date") AS d FROM dated)
"""


_MANY = """
  SELECT l_suppkey || '-' || l_returnflag AS series, l_shipdate AS "timestamp",
    round(sum(l_quantity), 4) AS "Ontario_Demand"
  FROM lineitem GROUP BY 1, 2"""


def _series(by_type: bool, rows: str = "") -> str:
    name = "event_type" if by_type else "'total'"
    rows = rows or f"""
  SELECT {name} AS series, date_trunc('hour', ts) AS "timestamp",
    round(sum(value), 4) AS "Ontario_Demand"
  FROM events GROUP BY 1, 2"""
    return f"""
series AS ({rows}),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY "timestamp") AS pos,
    count(*) OVER (PARTITION BY series) AS n FROM series),
split AS (
  SELECT *, CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS train_size FROM placed)
"""


def _fit(p: int) -> str:
    """Least squares by Gauss-Jordan elimination, one CTE per pivot."""
    lags = range(1, p + 1)
    columns = range(1, p + 2)
    lagged = ", ".join(
        f"lag(d, {k}) OVER (PARTITION BY series ORDER BY pos) AS l{k}" for k in lags
    )
    products = ", ".join(
        f"sum(l{i} * {'d' if j == p + 1 else f'l{j}'}) AS m{i}_{j}"
        for i in lags
        for j in columns
    )
    ctes = [
        """diffs AS (
  SELECT series, pos, train_size, "Ontario_Demand" AS y, "Ontario_Demand" -
    lag("Ontario_Demand") OVER (PARTITION BY series ORDER BY pos) AS d
  FROM split WHERE pos <= train_size)""",
        f"lagged AS (SELECT *, {lagged} FROM diffs)",
        f"pivot0 AS (SELECT series, {products} FROM lagged WHERE l{p} IS NOT NULL GROUP BY 1)",
    ]
    for k in lags:
        cells = ", ".join(
            f"m{k}_{j} / m{k}_{k} AS m{k}_{j}"
            if i == k
            else f"m{i}_{j} - m{i}_{k} * m{k}_{j} / m{k}_{k} AS m{i}_{j}"
            for i in lags
            for j in columns
        )
        ctes.append(f"pivot{k} AS (SELECT series, {cells} FROM pivot{k - 1})")
    solved = ", ".join(f"m{i}_{p + 1} AS a{i}" for i in lags)
    ctes.append(f"fitted AS (SELECT series, {solved} FROM pivot{p})")
    return ",\n".join(ctes)


def _path(p: int, steps: str) -> str:
    """The forecast recursion, `steps` hours past the train part of each series."""
    lags = range(1, p + 1)
    recent = ", ".join(["d AS r1", *[f"l{k} AS r{k + 1}" for k in range(1, p)]])
    move = " + ".join(f"a{k} * r{k}" for k in lags)
    shifted = "".join(f", r{k}" for k in range(1, p))
    coefs = ", ".join(f"a{k}" for k in lags)
    return f"""
path AS (
  SELECT series, CAST(0 AS BIGINT) AS step, y, {recent}, {steps} AS steps, {coefs}
  FROM lagged JOIN fitted USING (series)
    JOIN (SELECT DISTINCT series, n FROM split) USING (series)
  WHERE pos = train_size
  UNION ALL
  SELECT series, step + 1, y + ({move}), {move}{shifted}, steps, {coefs}
  FROM path WHERE step < steps)
"""


def _holdout(p: int, by_type: bool, rows: str = "") -> str:
    return f"""WITH RECURSIVE {_series(by_type, rows)}, {_fit(p)}, {_path(p, "n - train_size")},
holdout AS (
  SELECT s.series, CAST(path.step AS BIGINT) AS step, s."timestamp", s."Ontario_Demand",
    path.y AS yhat
  FROM split s JOIN path ON path.series = s.series AND path.step = s.pos - s.train_size
  WHERE s.pos > s.train_size)
"""


def _solved(name: str, system: str, unknowns: int) -> str:
    """Gauss-Jordan over a table (i, j, v), j = 0 being the right-hand side, pivot by q."""
    return f"""
{name} AS (
  SELECT 1 AS k, i, j, v FROM {system}
  UNION ALL
  SELECT m.k + 1, m.i, m.j,
    CASE WHEN m.i = m.k THEN m.v / q.v ELSE m.v - f.v * r.v / q.v END
  FROM {name} m
    JOIN {name} r ON r.i = m.k AND r.j = m.j
    JOIN {name} f ON f.i = m.i AND f.j = m.k
    JOIN {name} q ON q.i = m.k AND q.j = m.k
  WHERE m.k <= {unknowns}),
{name}_x AS (SELECT i, v FROM {name} WHERE k = {unknowns + 1} AND j = 0)
"""


def _weekly(steps: str) -> str:
    """ARIMA(p, 1, 1): long AR of order p + 1, its residuals, then both regressions in one."""
    p = schemas.WEEKLY_ORDER[0]
    long = p + 1
    return f"""WITH RECURSIVE {_series(False)},
diffs AS (
  SELECT pos - 1 AS t, d, y, n, train_size FROM (
    SELECT *, "Ontario_Demand" AS y,
      "Ontario_Demand" - lag("Ontario_Demand") OVER (ORDER BY pos) AS d FROM split)
  WHERE pos <= train_size AND pos > 1),
lags AS (SELECT CAST(k AS INTEGER) AS k FROM range(0, {long + 2}) r(k)),
lagged AS (
  SELECT now.t, k, past.d AS v FROM diffs now, lags JOIN diffs past ON past.t = now.t - k
  WHERE now.t >= {long + 2}),
g AS (
  SELECT a.k AS i, b.k AS j, sum(a.v * b.v) AS v
  FROM lagged a JOIN lagged b USING (t) GROUP BY 1, 2),
long_system AS (SELECT * FROM g WHERE i BETWEEN 1 AND {long} AND j <= {long}),
{_solved("long_fit", "long_system", long)},
whiten AS (SELECT 0 AS i, CAST(1 AS DOUBLE) AS w UNION ALL SELECT i, -v FROM long_fit_x),
shocked AS (SELECT j, sum(w * v) AS v FROM whiten JOIN g ON g.i = whiten.i + 1 GROUP BY j),
shock_power AS (SELECT sum(w * v) AS v FROM whiten JOIN shocked ON shocked.j = whiten.i + 1),
arma_system AS (
  SELECT i, j, v FROM g WHERE i BETWEEN 1 AND {p} AND j <= {p}
  UNION ALL SELECT {long}, j, v FROM shocked WHERE j <= {p}
  UNION ALL SELECT j, {long}, v FROM shocked WHERE j BETWEEN 1 AND {p}
  UNION ALL SELECT {long}, {long}, v FROM shock_power),
{_solved("arma", "arma_system", long)},
ending AS (SELECT max(t) AS t, max_by(y, t) AS y, any_value({steps}) AS steps FROM diffs),
start AS (
  SELECT ending.y, ending.steps,
    (SELECT list(v ORDER BY i) FROM arma_x WHERE i <= {p}) AS ar,
    (SELECT v FROM arma_x WHERE i = {long}) AS ma,
    (SELECT list(d ORDER BY t DESC) FROM diffs) AS recent,
    (SELECT sum(w * d) FROM whiten, ending e JOIN diffs ON diffs.t = e.t - whiten.i) AS shock
  FROM ending),
path AS (
  SELECT CAST(0 AS BIGINT) AS step, y, recent[1:{p}] AS recent, shock, steps, ar, ma FROM start
  UNION ALL
  SELECT step + 1, y + move, list_prepend(move, recent[1:{p - 1}]), 0.0, steps, ar, ma
  FROM (SELECT *, list_inner_product(ar, recent) + ma * shock AS move FROM path)
  WHERE step < steps)
"""


# Slices, ranges, typing

ORACLE["latest_slice_events"] = """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
"""

ORACLE["batch_date_range"] = """
SELECT event_type, min(ts) AS first_date, max(ts) AS last_date, count(*) AS row_count
FROM events GROUP BY event_type
"""

ORACLE["coerce_typed"] = """
WITH raw AS (
  SELECT l_orderkey, l_partkey, l_linenumber,
    CASE l_linenumber
      WHEN 2 THEN strftime(l_shipdate, '%Y-%-m-%-d')
      WHEN 3 THEN strftime(l_shipdate, '%Y%m%d')
      WHEN 4 THEN ' ' || strftime(l_shipdate, '%Y-%m-%d')
      WHEN 5 THEN strftime(l_shipdate, '%Y-13-%d')
      ELSE strftime(l_shipdate, '%Y-%m-%d') END AS d,
    CAST(CAST(l_quantity + l_discount AS DECIMAL(18, 2)) AS VARCHAR) AS h,
    CASE WHEN l_returnflag = 'N'
        THEN CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) || 'd'
      WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'nan'
      WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN '1,000'
      WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN
        (['1e308', '1.5e308', '0.001e310', '1e309', 'Infinity', '-inf'])[l_partkey % 6 + 1]
      ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) END AS v
  FROM lineitem),
typed AS (
  SELECT l_orderkey, l_partkey, l_linenumber,
    CASE WHEN regexp_full_match(d, '\\d{4}-\\d{1,2}-\\d{1,2}')
      THEN CAST(try_strptime(d, '%Y-%m-%d') AS DATE) END AS "Date",
    CASE WHEN TRY_CAST(h AS DOUBLE) = floor(TRY_CAST(h AS DOUBLE))
      THEN CAST(TRY_CAST(h AS DOUBLE) AS INTEGER) END AS "Hour",
    CASE WHEN v = '0.001e310' THEN 1e307 WHEN v = '1e309' THEN NULL
      WHEN v IN ('Infinity', '-inf') THEN CAST(v AS DOUBLE)
      WHEN NOT isnan(TRY_CAST(v AS DOUBLE)) THEN TRY_CAST(v AS DOUBLE) END AS "Market_Demand"
  FROM raw)
SELECT * FROM typed WHERE "Date" IS NOT NULL
"""

ORACLE["strict_numbers"] = """
SELECT l_orderkey, l_partkey, l_linenumber,
  CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END AS output,
  CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS energy,
  CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0.0 END AS energy_or_zero
FROM lineitem
"""

ORACLE["free_form_dates"] = """
SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS order_date FROM orders
"""

ORACLE["load_stamps"] = """
SELECT event_id,
  CAST(timezone('America/Toronto', timezone('UTC', ts)) AS DATE) AS load_date,
  date_trunc('second', timezone('America/Toronto', timezone('UTC', ts))) AS load_second
FROM events
"""

ORACLE["text_hour_order"] = """
SELECT CAST(hour(ts) AS VARCHAR) AS hour_text, count(*) AS row_count,
  row_number() OVER (ORDER BY hour(ts)) AS pos
FROM events GROUP BY hour(ts)
"""

# Reshape, alignment, de-duplication

ORACLE["hourly_wide"] = f"""WITH {_HOURLY} SELECT * FROM hourly"""

_ITEM_ZONES = ", ".join(
    f'sum(l_quantity) FILTER (WHERE l_partkey % {len(schemas.ZONES)} = {i}) AS "{zone}"'
    for i, zone in enumerate(schemas.ZONES)
)
ORACLE["wide_to_long_items"] = f"""
WITH wide AS (
  SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", {_ITEM_ZONES}
  FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, "Date", "Zone", "Value"
FROM wide UNPIVOT INCLUDE NULLS ("Value" FOR "Zone" IN ({_ZONE_LIST}))
"""
ORACLE["demand_items_load"] = f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date",
  CAST(l_suppkey % 24 + 1 AS INTEGER) AS "Hour",
  CASE WHEN l_partkey % 11 <> 0
    THEN CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) END AS "Market_Demand",
  l_quantity AS "Ontario_Demand", {STAMP_DATE} AS "Modified_DT"
FROM lineitem WHERE l_linenumber <> 7
"""
ORACLE["wide_to_long"] = f"""WITH {_HOURLY} {_LONG}"""

_FUEL = """
SELECT CAST(ts AS DATE) AS "Date", CAST(hour(ts) + 1 AS INTEGER) AS hour,
  event_type AS fuel_type,
  CASE WHEN event_type <> 'error'
    THEN CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) END AS output
FROM events GROUP BY 1, 2, 3
"""
ORACLE["xml_fuel_flatten"] = _FUEL

_LAST_BY_FLAG = "l_shipdate DESC, l_orderkey DESC, l_partkey DESC, l_quantity DESC"
ORACLE["align_measures"] = f"""
WITH last AS (
  SELECT l_suppkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_suppkey, l_linenumber, l_returnflag ORDER BY {_LAST_BY_FLAG}) = 1),
a AS (SELECT * FROM last WHERE l_returnflag = 'A'),
n AS (SELECT * FROM last WHERE l_returnflag = 'N'),
r AS (SELECT * FROM last WHERE l_returnflag = 'R')
SELECT l_suppkey, l_linenumber,
  coalesce(a.l_quantity, 0.0) AS "OutputEnergy",
  coalesce(n.l_quantity, 0.0) AS "CapabilityEnergy",
  coalesce(r.l_quantity, 0.0) AS "AvailCapacity"
FROM a FULL JOIN n USING (l_suppkey, l_linenumber) FULL JOIN r USING (l_suppkey, l_linenumber)
"""

ORACLE["key_union"] = """
SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A'
UNION SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'N'
UNION SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'
"""

ORACLE["last_wins"] = """
SELECT user_id, event_type, ts, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""

# Report files, end to end

_DEMAND = f"""
SELECT "Date", "Hour", "Zone_Total" AS "Market_Demand", "Ontario_Demand",
  {STAMP_DATE} AS "Modified_DT" FROM hourly
"""
ORACLE["demand_csv_ingest"] = f"""WITH {_HOURLY} {_DEMAND}
WHERE "Date" = (SELECT max("Date") FROM hourly)
"""

ORACLE["demand_full_load"] = f"""WITH {_HOURLY} {_DEMAND}"""

ORACLE["archive_csv"] = f"""WITH {_HOURLY}
SELECT "Date", "Hour", "Essa" AS "Market_Demand", "West" AS "Ontario_Demand" FROM hourly
WHERE "Essa" IS NOT NULL AND "West" IS NOT NULL
"""

ORACLE["series_csv_items"] = f"""
SELECT series, CAST("timestamp" AS TIMESTAMP) AS "timestamp", "Ontario_Demand" FROM ({_MANY}) ORDER BY 1, 2
"""
ORACLE["series_csv_sorted"] = f"""WITH {_series(False)}
SELECT "timestamp", "Ontario_Demand" FROM series ORDER BY "timestamp"
"""

ORACLE["zonal_csv_to_primary"] = f"""WITH {_HOURLY} {_LONG}"""

ORACLE["fuel_xml_ingest"] = f"""
WITH fuel AS ({_FUEL}) SELECT * FROM fuel WHERE "Date" = (SELECT max("Date") FROM fuel)
"""

def _last_of(flag: str) -> str:
    return (
        "coalesce(last(l_quantity ORDER BY l_orderkey, l_partkey, l_quantity) "
        f"FILTER (WHERE l_returnflag = '{flag}'), 0.0)"
    )


# The last entry of a slot counts; entries without energy are planted at every tenth part.
ORACLE["capability_xml_scan"] = f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", l_partkey % 24 + 1 AS "Hour",
  'G' || l_suppkey AS "GeneratorName", 'F' || (l_suppkey % 5) AS "FuelType",
  {_last_of("A")} AS "OutputEnergy", {_last_of("N")} AS "CapabilityEnergy",
  {_last_of("R")} AS "AvailCapacity"
FROM lineitem WHERE l_partkey % 10 <> 0 GROUP BY ALL
"""
_ITEM_FUEL = """
SELECT *, CASE WHEN flag <> 'N' OR hour % 5 <> 0 THEN total END AS output FROM (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", CAST(l_partkey % 24 + 1 AS INTEGER) AS hour,
    l_returnflag || '-' || l_suppkey AS fuel_type, l_returnflag AS flag,
    CAST(sum(CAST(round(l_quantity * 100) AS BIGINT)) AS BIGINT) AS total
  FROM lineitem GROUP BY 1, 2, 3, 4)
"""
ORACLE["fuel_items_load"] = f"""SELECT "Date", hour, fuel_type, output FROM ({_ITEM_FUEL})"""
_HALVES, _EMPTY = "flag = 'A' AND hour = 4", "flag = 'R' AND hour = 6"


def _rejects(faulty: str) -> str:
    return f"""
SELECT "Date", hour, fuel_type, CASE WHEN NOT ({faulty} AND ({_HALVES} OR {_EMPTY})) THEN output END AS output,
  CASE WHEN {faulty} AND ({_HALVES} OR {_EMPTY}) THEN 'output' END AS field,
  CASE WHEN {faulty} AND {_HALVES} THEN total || '.5' WHEN {faulty} AND {_EMPTY} THEN '' END AS text
FROM ({_ITEM_FUEL})
"""


ORACLE["fuel_rejects"] = _rejects("true")
ORACLE["stream_tolerant"] = _rejects("""month("Date") % 3 = 0""")
_WRONG = f"""
SELECT DISTINCT "Date" FROM ({_ITEM_FUEL}) WHERE month("Date") % 3 = 0 AND ({_HALVES} OR {_EMPTY})
"""
ORACLE["stream_bad_numbers"] = f"""
SELECT "Date", hour, fuel_type, output, (SELECT count(*) FROM ({_WRONG})) AS rejected
FROM ({_ITEM_FUEL}) WHERE "Date" NOT IN ({_WRONG}) OR year("Date") = 1995
"""
ORACLE["stream_empty_report"] = f"""
SELECT "Date", hour, fuel_type, output, CAST(1 AS BIGINT) AS rejected FROM ({_ITEM_FUEL})
"""


def _good_last_of(flag: str) -> str:
    good = "l_partkey % 10 NOT IN (3, 7)"
    return (
        f"coalesce(last(CASE WHEN {good} THEN l_quantity ELSE 0.0 END ORDER BY l_orderkey, l_partkey, l_quantity) "
        f"FILTER (WHERE l_returnflag = '{flag}'), 0.0)"
    )


ORACLE["capability_rejects"] = f"""
WITH items AS (
  SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", 'G' || l_suppkey AS "GeneratorName"
  FROM lineitem WHERE l_partkey % 10 <> 0),
wrong AS (
  SELECT "Date", "GeneratorName", count(*) AS wrong_values FROM items WHERE l_partkey % 10 IN (3, 7) GROUP BY ALL)
SELECT "Date", l_partkey % 24 + 1 AS "Hour", "GeneratorName", 'F' || (l_suppkey % 5) AS "FuelType",
  {_good_last_of("A")} AS "OutputEnergy", {_good_last_of("N")} AS "CapabilityEnergy",
  {_good_last_of("R")} AS "AvailCapacity", any_value(wrong_values) AS wrong_values
FROM items LEFT JOIN wrong USING ("Date", "GeneratorName") GROUP BY 1, 2, 3, 4
"""
_DAILY = """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", CAST(l_suppkey % 24 + 1 AS INTEGER) AS "Hour",
  CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) AS "Market_Demand", l_quantity AS "Ontario_Demand"
FROM lineitem
"""
ORACLE["demand_rejects"] = f"""
WITH daily AS ({_DAILY})
SELECT "Date", count(*) FILTER ("Ontario_Demand" % 10 <> 0) AS taken,
  round(sum("Market_Demand") FILTER ("Ontario_Demand" % 10 <> 0), 2) AS "Market_Demand",
  nullif(count(*) FILTER ("Ontario_Demand" % 10 = 0), 0) AS apart
FROM daily GROUP BY "Date" HAVING count(*) FILTER ("Ontario_Demand" % 10 <> 0) > 0
"""


def _raised(condition: str, more: int) -> str:
    return f"""WHEN {condition} THEN CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) + {more} AS DOUBLE)"""


_LAST_YEAR = "year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem)"
_LAST_MONTH = "date_trunc('month', l_shipdate) = (SELECT max(date_trunc('month', l_shipdate)) FROM lineitem)"
ORACLE["stream_rewritten_report"] = f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", CAST(l_suppkey % 24 + 1 AS INTEGER) AS "Hour",
  CASE {_raised(_LAST_MONTH, 2000)} {_raised(_LAST_YEAR, 1000)} {_raised("true", 0)} END AS "Market_Demand",
  l_quantity AS "Ontario_Demand", {STAMP_DATE} AS "Modified_DT"
FROM lineitem
"""
ORACLE["stream_items"] = f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", CAST(l_suppkey % 24 + 1 AS INTEGER) AS "Hour",
  CASE {_raised(_LAST_YEAR, 1000)} {_raised("true", 0)} END AS "Market_Demand",
  l_quantity AS "Ontario_Demand", {STAMP_DATE} AS "Modified_DT"
FROM lineitem
"""
_ZONAL_ITEMS = f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", CAST(l_suppkey % 24 + 1 AS INTEGER) AS "Hour",
  {STAMP} AS "Modified_DT", CAST(l_suppkey AS DOUBLE) AS "Ontario_Demand", sum(l_quantity) AS "Zone_Total",
  sum(l_quantity) - l_suppkey AS "Diff", {_ITEM_ZONES}
FROM lineitem GROUP BY l_suppkey, 1
"""


def _zonal_long(total: str) -> str:
    return f"""
SELECT "Date", "Hour", "Modified_DT", "Ontario_Demand", {total} AS "Zone_Total", "Diff", "Zone", "Value"
FROM ({_ZONAL_ITEMS}) UNPIVOT INCLUDE NULLS ("Value" FOR "Zone" IN ({_ZONE_LIST}))
"""


ORACLE["wide_to_long_missing_id"] = f"""
SELECT "Date", "Ontario_Demand", "Zone_Total", "Zone", "Value",
  'the wide table lacks [''Diff'', ''Hour'', ''Modified_DT'']' AS refused
FROM ({_ZONAL_ITEMS}) UNPIVOT INCLUDE NULLS ("Value" FOR "Zone" IN ({_ZONE_LIST}))
"""
ORACLE["demand_validated"] = f"""
SELECT *, {STAMP_DATE} AS "Modified_DT", 'no table to check; hour_range failed on Hour' AS stopped FROM ({_DAILY})
"""
ORACLE["zonal_items_to_primary"] = _zonal_long('"Zone_Total"')
ORACLE["stream_primary_from_register"] = _zonal_long(
    '"Zone_Total" + CASE year("Date") WHEN 1996 THEN 2000 WHEN 1997 THEN 3000 ELSE 1000 END'
)
ORACLE["capability_one_document"] = f"""
SELECT (SELECT CAST(max(date_trunc('month', l_shipdate)) AS DATE) FROM lineitem) AS "Date",
  "Hour", "GeneratorName" || '-' || strftime("Date", '%Y-%m') AS "GeneratorName", "FuelType",
  "OutputEnergy", "CapabilityEnergy", "AvailCapacity"
FROM ({ORACLE["capability_xml_scan"]})
"""
ORACLE["capability_ingest"] = f"""
WITH scanned AS ({ORACLE["capability_xml_scan"]})
SELECT "Date", "Hour", "GeneratorName", "FuelType",
  CASE WHEN "Date" = (SELECT max("Date") FROM scanned) THEN "OutputEnergy"
    ELSE 0.0 END AS "OutputEnergy", "CapabilityEnergy", "AvailCapacity"
FROM scanned
"""

# Tables and register

_CORRECTION = f"""{_DATED},
history AS (
  SELECT "Date", event_id, user_id, event_type,
    CASE WHEN "Date" = (SELECT d FROM newest) THEN 0.0 ELSE value END AS value FROM dated),
batch AS (
  SELECT "Date", event_id, user_id, event_type, round(value + 1, 2) AS value FROM dated
  WHERE "Date" >= (SELECT d - 1 FROM newest))
"""
_LATEST = f"""WITH {_CORRECTION}
SELECT * FROM history WHERE "Date" <> (SELECT d FROM newest)
UNION ALL SELECT * FROM batch WHERE "Date" = (SELECT d FROM newest)
"""
_ALL_DATES = f"""WITH {_CORRECTION}
SELECT * FROM history ANTI JOIN batch USING ("Date") UNION ALL SELECT * FROM batch
"""
ORACLE["upsert_latest"] = _LATEST
ORACLE["upsert_all_dates"] = _ALL_DATES
ORACLE["upsert_as_query"] = _ALL_DATES
ORACLE["upsert_as_query_latest"] = _LATEST

_UNDATED = f"""WITH {_CORRECTION},
undated AS (
  SELECT CASE WHEN event_id % 10 <> 0 THEN "Date" END AS "Date", * EXCLUDE ("Date") FROM history),
corrected AS (
  SELECT CASE WHEN event_id % 7 <> 0 THEN "Date" END AS "Date", * EXCLUDE ("Date") FROM batch)
"""
ORACLE["upsert_undated"] = ORACLE["upsert_undated_as_query"] = f"""{_UNDATED}
SELECT * FROM undated WHERE "Date" IS NULL OR "Date" NOT IN (
  SELECT "Date" FROM corrected WHERE "Date" IS NOT NULL)
UNION ALL SELECT * FROM corrected WHERE "Date" IS NOT NULL
"""
ORACLE["replace_slice"] = _LATEST

_SKETCHED = """kept AS (
  SELECT "Date", nullif(event_type, 'error') AS event_type, (user_id % 100)::VARCHAR AS "user",
    (event_id % 7)::VARCHAR AS value_class,
    CASE WHEN day("Date") <= 15 THEN 'first' ELSE 'second' END AS half
  FROM dated WHERE "Date" < (SELECT d - 1 FROM newest) OR event_id % 2 = 0)
"""
ORACLE["profile_sketches"] = f"WITH {_CORRECTION}, {_SKETCHED}" + " UNION ALL ".join(
    f"""SELECT half, '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS row_count,
  CAST(coalesce(sum(n) FILTER (v IS NULL), 0) AS BIGINT) AS null_count, count(v) AS "distinct",
  max(n) FILTER (v IS NOT NULL) AS top
FROM (SELECT half, "{c}" AS v, count(*) AS n FROM kept GROUP BY ALL) GROUP BY half"""
    for c in ("event_type", "user", "value_class")
)
ORACLE["date_counts"] = f"""WITH {_CORRECTION}
SELECT "Date", count(*) AS row_count FROM dated
WHERE "Date" < (SELECT d - 1 FROM newest) OR event_id % 4 = 0 GROUP BY "Date"
"""
ORACLE["register_append"] = """
WITH counted AS (SELECT count(*) AS c FROM events)
SELECT 1735805045678000 + (i - 1) * 3600000000 AS id, 'events' AS "TABLE_NAME", 'raw' AS "TABLE_SCHEMA",
  DATE '2025-01-02' AS "MODIFIED_DT",
  TIMESTAMP '2025-01-02 03:04:05.678' + (i - 1) * INTERVAL 1 HOUR AS "MODIFIED_TIME",
  c AS "ROW_COUNT",
  TIMESTAMP '2025-01-02 03:04:05.678' + (i - 1) * INTERVAL 1 HOUR AS created_at
FROM counted, range(1, 3) r(i)
"""

_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
ORACLE["register_snapshot"] = (
    'SELECT "TABLE_NAME", "TABLE_SCHEMA", "MODIFIED_DT", "ROW_COUNT" FROM ('
    + " UNION ALL ".join(
        f"SELECT {i} AS id, '{name}' AS \"TABLE_NAME\", 'raw' AS \"TABLE_SCHEMA\", "
        f'{STAMP_DATE} AS "MODIFIED_DT", count(*) AS "ROW_COUNT" FROM {name}'
        for i, name in enumerate(_TABLES, start=1)
    )
    + ") ORDER BY id DESC LIMIT 10"
)

# Checks and profiles


def _rules(*rules: tuple[int, str, str, str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST({step} AS INTEGER) AS step, '{rule}' AS rule, '{severity}' AS severity,
  '{column}' AS "column", CAST({violations} AS BIGINT) AS violations,
  ({violations}) = 0 AS passed FROM checked"""
        for step, rule, severity, column, violations in rules
    )


ORACLE["validate_demand"] = """WITH checked AS (
  SELECT CAST(ts AS DATE) AS "Date", hour(ts) AS "Hour", round(value - 20, 2) AS market,
    CASE WHEN event_type <> 'error' THEN value END AS ontario FROM events)
""" + _rules(
    (1, "min_rows", "error", "*", "greatest(1 - count(*), 0)"),
    (2, "required_columns", "error", "*", "count(*) * 0"),
    (3, "not_null", "warning", "Date", 'count(*) - count("Date")'),
    (4, "not_null", "warning", "Hour", 'count(*) - count("Hour")'),
    (5, "not_null", "warning", "Market_Demand", "count(*) - count(market)"),
    (6, "not_null", "warning", "Ontario_Demand", "count(*) - count(ontario)"),
    (8, "hour_range", "error", "Hour", 'count(*) FILTER (WHERE "Hour" < 1 OR "Hour" > 24)'),
    (9, "non_negative", "error", "Market_Demand", "count(*) FILTER (WHERE market < 0)"),
    (10, "non_negative", "error", "Ontario_Demand", "count(*) FILTER (WHERE ontario < 0)"),
)

ORACLE["validate_failing"] = """WITH checked AS (
  SELECT CAST(ts AS DATE) AS "Date", round(value - 20, 2) AS market,
    CASE WHEN event_type <> 'error' THEN value END AS ontario FROM events)
""" + _rules(
    (1, "min_rows", "error", "*", "greatest(1000000000000 - count(*), 0)"),
    (2, "required_columns", "error", "Hour", "count(*) * 0 + 1"),
    (3, "not_null", "warning", "Date", 'count(*) - count("Date")'),
    (4, "not_null", "warning", "Market_Demand", "count(*) - count(market)"),
    (5, "not_null", "warning", "Ontario_Demand", "count(*) - count(ontario)"),
    (7, "non_negative", "error", "Market_Demand", "count(*) FILTER (WHERE market < 0)"),
    (8, "non_negative", "error", "Ontario_Demand", "count(*) FILTER (WHERE ontario < 0)"),
)

ORACLE["validate_zonal"] = """WITH checked AS (
  SELECT CASE WHEN event_type <> 'signup' THEN CAST(ts AS DATE) END AS "Date",
    hour(ts) + 3 AS "Hour" FROM events)
""" + _rules(
    (1, "min_rows", "error", "*", "greatest(1 - count(*), 0)"),
    (2, "required_columns", "error", "*", "count(*) * 0"),
    (3, "not_null", "warning", "Date", 'count(*) - count("Date")'),
    (4, "not_null", "warning", "Hour", 'count(*) - count("Hour")'),
    (6, "hour_range", "error", "Hour", 'count(*) FILTER (WHERE "Hour" < 1 OR "Hour" > 24)'),
)

ORACLE["validate_generator"] = """WITH checked AS (
  SELECT CAST(ts AS DATE) AS "Date", hour(ts) + 1 AS "Hour",
    CASE event_type WHEN 'click' THEN '' WHEN 'view' THEN '  ' WHEN 'error' THEN NULL
      ELSE event_type END AS fuel FROM events)
""" + _rules(
    (1, "min_rows", "error", "*", "greatest(1 - count(*), 0)"),
    (2, "required_columns", "error", "*", "count(*) * 0"),
    (3, "not_null", "warning", "Date", 'count(*) - count("Date")'),
    (4, "not_null", "warning", "fuel_type", "count(*) - count(fuel)"),
    (5, "no_duplicates", "warning", "*",
     'count(*) * 0 + (SELECT sum(c - 1) FROM '
     '(SELECT count(*) AS c FROM checked GROUP BY "Date", "Hour", fuel))'),
    (6, "not_blank", "warning", "fuel_type", "count(*) FILTER (WHERE trim(fuel) = '')"),
)

ORACLE["duplicate_rows"] = """
SELECT CAST(sum(c - 1) AS BIGINT) AS duplicates, CAST(sum(c) AS BIGINT) AS row_count
FROM (SELECT count(*) AS c FROM documents GROUP BY text)
"""

_PROFILED = [
    ("doc_id", "bigint", "count(doc_id) * 8"),
    ("text", "string", "coalesce(sum(octet_length(encode(text))), 0)"),
    ("lang", "string", "coalesce(sum(octet_length(encode(lang))), 0)"),
    ("source", "string", "coalesce(sum(octet_length(encode(source))), 0)"),
    ("n_chars", "bigint", "count(n_chars) * 8"),
    ("quality", "int", "count(quality) * 4"),
    ("toxic", "int", "count(toxic) * 4"),
]
ORACLE["profile_nulls"] = "WITH joined AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) " + (
    " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column_name,
  '{kind}' AS data_type, count(*) AS row_count, CAST(7 AS INTEGER) AS column_count,
  count(*) - count({name}) AS null_count,
  CAST({size} AS BIGINT) AS data_bytes FROM joined"""
        for i, (name, kind, size) in enumerate(_PROFILED, start=1)
    )
)

ORACLE["profile_distinct"] = """
SELECT event_type, count(DISTINCT user_id) AS distinct_user_id,
  count(DISTINCT CAST(ts AS DATE)) AS "distinct_Date", count(DISTINCT props) AS distinct_props
FROM events GROUP BY event_type
"""

ORACLE["distinct_fuels"] = """
SELECT nullif(event_type, 'error') AS fuel_type, count(*) AS row_count FROM events GROUP BY 1
"""

ORACLE["head_tail"] = """
SELECT * FROM (
  SELECT 'head' AS part, o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
  ORDER BY o_orderdate, o_orderkey LIMIT 5)
UNION ALL SELECT * FROM (
  SELECT 'tail' AS part, o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
  ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5)
"""

# Series

_MANY_SERIES = _series(True, _MANY)
ORACLE["time_split_many"] = f"""WITH {_MANY_SERIES}
SELECT series, "timestamp", "Ontario_Demand", pos, n, train_size, pos <= train_size AS is_train
FROM split
"""
ORACLE["lag_features_many"] = f"""WITH {_MANY_SERIES},
changes AS (
  SELECT series, "timestamp", pos, "Ontario_Demand" -
    lag("Ontario_Demand") OVER (PARTITION BY series ORDER BY pos) AS d FROM placed)
SELECT series, "timestamp", pos, round(d, 4) + 0.0 AS diff,
  round(lag(d, 1) OVER (PARTITION BY series ORDER BY pos), 4) + 0.0 AS lag_1
FROM changes
"""
ORACLE["time_split"] = f"""WITH {_series(True)}
SELECT series, "timestamp", "Ontario_Demand", pos, n, train_size, pos <= train_size AS is_train
FROM split
"""

ORACLE["lag_features"] = f"""WITH {_series(False)},
changes AS (
  SELECT series, "timestamp", pos, "Ontario_Demand" -
    lag("Ontario_Demand") OVER (PARTITION BY series ORDER BY pos) AS d FROM placed)
SELECT series, "timestamp", pos, round(d, 4) + 0.0 AS diff,
  {", ".join(
      f"round(lag(d, {k}) OVER (PARTITION BY series ORDER BY pos), 4) + 0.0 AS lag_{k}"
      for k in range(1, 6)
  )}
FROM changes
"""

_ROWS = 'SELECT series, step, "timestamp", "Ontario_Demand", round(yhat, 4) AS yhat FROM holdout'
ORACLE["forecast_ar1"] = _holdout(1, by_type=False) + _ROWS
ORACLE["forecast_many"] = _holdout(1, by_type=True, rows=_MANY) + _ROWS
ORACLE["forecast_ar5"] = _holdout(5, by_type=True) + _ROWS

_MSE = 'avg(power("Ontario_Demand" - yhat, 2))'
ORACLE["forecast_error"] = _holdout(1, by_type=True) + f"""
SELECT series, count(*) AS n, round({_MSE}, 4) AS mse, round(sqrt({_MSE}), 4) AS rmse
FROM holdout GROUP BY series
"""

ORACLE["forecast_runs"] = _holdout(5, by_type=True) + f"""
SELECT h.series, CAST(5 AS INTEGER) AS p, CAST(1 AS INTEGER) AS d, CAST(0 AS INTEGER) AS q,
  s.train_size, s.n - s.train_size AS test_size,
  'fitted' AS status, round({_MSE}, 4) AS mse, round(sqrt({_MSE}), 4) AS rmse
FROM holdout h JOIN (SELECT DISTINCT series, n, train_size FROM split) s ON s.series = h.series
GROUP BY h.series, s.n, s.train_size
"""

ORACLE["model_coefficients"] = f"WITH {_series(True)}, {_fit(5)} " + " UNION ALL ".join(
    f"""SELECT series, 'ar' AS term, CAST({k} AS INTEGER) AS lag, round(a{k}, 6) AS value
FROM fitted"""
    for k in range(1, 6)
)

ORACLE["forecast_arma_weekly"] = _weekly("n - train_size") + """
SELECT series, step, "timestamp", "Ontario_Demand", round(y, 4) AS yhat
FROM path JOIN split ON pos = train_size + step WHERE step > 0
"""

ORACLE["forecast_720"] = _weekly("720") + """
SELECT 'total' AS series, step,
  (SELECT max("timestamp") FROM series) + CAST(step AS INTEGER) * INTERVAL 1 HOUR AS "timestamp",
  round(y, 4) AS yhat
FROM path WHERE step > 0
"""

ORACLE["future_hours"] = f"""WITH {_series(True)}
SELECT series, CAST(k AS BIGINT) AS step, last + k * INTERVAL 1 HOUR AS "timestamp"
FROM (SELECT series, max("timestamp") AS last FROM series GROUP BY 1), range(1, 721) r(k)
"""

ORACLE["actual_vs_forecast"] = (
    f"""WITH RECURSIVE {_series(False)}, {_fit(1)}, {_path(1, "720")}
SELECT series, 'actual' AS kind, "timestamp", round("Ontario_Demand", 4) AS "Ontario_Demand"
FROM split WHERE pos > train_size
UNION ALL
SELECT path.series, 'forecast', last + CAST(step AS INTEGER) * INTERVAL 1 HOUR, round(y, 4)
FROM path JOIN (SELECT series, max("timestamp") AS last FROM series GROUP BY 1) l
  ON l.series = path.series
WHERE step > 0
"""
)

# Streams

ORACLE["stream_pickup"] = f"""WITH {_HOURLY}
SELECT "Date", "Hour",
  CASE WHEN "Date" >= (SELECT max("Date") - 1 FROM hourly)
    THEN "Zone_Total" + 1000 ELSE "Zone_Total" END AS "Market_Demand",
  "Ontario_Demand", {STAMP_DATE} AS "Modified_DT"
FROM hourly
"""

# Each report lies in several files of equal age; its name tells which is the later one.
ORACLE["stream_multipart_reports"] = f"""WITH {_HOURLY}
SELECT "Date", "Hour", "Zone_Total" + 1000 AS "Market_Demand", "Ontario_Demand",
  {STAMP_DATE} AS "Modified_DT"
FROM hourly
"""

ORACLE["stream_bad_file"] = f"""WITH {_HOURLY}
SELECT "Date", "Hour", "Zone_Total" AS "Market_Demand", "Ontario_Demand",
  {STAMP_DATE} AS "Modified_DT", CAST(1 AS BIGINT) AS rejected
FROM hourly WHERE day("Date") % 2 = 1 OR "Date" = (SELECT max("Date") FROM hourly)
"""

ORACLE["stream_fuel"] = _FUEL
ORACLE["stream_capability"] = ORACLE["capability_xml_scan"]

ORACLE["stream_late_dates"] = f"""WITH {_HOURLY}
SELECT "Date", "Hour", "Zone_Total" + 1000 AS "Market_Demand", "Ontario_Demand",
  {STAMP_DATE} AS "Modified_DT"
FROM hourly
"""

ORACLE["stream_latest_to_primary"] = f"""WITH {_HOURLY},
later AS (
  SELECT max("Date") AS d FROM hourly
  GROUP BY CAST(floor(date_diff('day', DATE '1970-01-01', "Date") / 2) AS BIGINT))
SELECT * FROM ({_LONG}) WHERE "Date" IN (SELECT d FROM later)
"""
