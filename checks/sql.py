"""The same results in SQL over the given tables, written without the library."""

from __future__ import annotations

RIDES = """
rides AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ride_id,
         CAST(o_custkey AS VARCHAR) AS user_id,
         COALESCE(CAST(supplier_key AS VARCHAR), 'n/a') AS driver_id,
         CAST(o_orderdate AS DATE) AS ride_date,
         o_orderpriority AS pick_up_state,
         CAST(o_totalprice AS DECIMAL(18,2)) AS fare
  FROM orders LEFT JOIN (
    SELECT l_orderkey, MIN(l_suppkey) AS supplier_key FROM lineitem GROUP BY l_orderkey
  ) AS first_supplier ON o_orderkey = l_orderkey
)"""

RAW_TIPS = """
raw_tips AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tip_id,
         CAST(l_orderkey AS VARCHAR) AS ride_id,
         CAST(l_quantity AS DECIMAL(18,2)) AS tip_amount,
         CAST(l_shipdate AS DATE) AS tipped_on
  FROM lineitem WHERE l_returnflag = 'R'
)"""

TIPS = RAW_TIPS + """,
tips AS (
  SELECT tip_id, ride_id, tip_amount FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY tip_id ORDER BY tipped_on DESC, tip_amount DESC) AS rn
    FROM raw_tips) AS versions
  WHERE rn = 1
),
last_tip AS (
  SELECT ride_id, tip_amount FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY ride_id ORDER BY tip_id DESC) AS rn
    FROM tips) AS ranked
  WHERE rn = 1
),
tip_sum AS (SELECT ride_id, SUM(tip_amount) AS tip_amount FROM tips GROUP BY ride_id)"""

DRIVERS = """
drivers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS driver_id, s_name AS name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""


def _facts(tips: str, first_day: str = "1995-01-01") -> str:
    return f"""
facts AS (
  SELECT driver_id, r.ride_id, fare, COALESCE(t.tip_amount, 0) AS tip_amount,
         fare + COALESCE(t.tip_amount, 0) AS total_amount, ride_date,
         CAST(STRFTIME(ride_date, '%Y%m%d') AS BIGINT) AS earning_date_key
  FROM rides r LEFT JOIN {tips} t ON r.ride_id = t.ride_id
  WHERE ride_date BETWEEN DATE '{first_day}' AND DATE '2025-01-01'
)"""


FACT_COLUMNS = """
SELECT driver_id, ride_id, CAST(fare AS DOUBLE) AS fare, CAST(tip_amount AS DOUBLE) AS tip_amount,
       CAST(total_amount AS DOUBLE) AS total_amount, earning_date_key
FROM facts"""

RIDE_COLUMNS = """ride_id, user_id, driver_id, STRFTIME(ride_date, '%Y-%m-%d') AS ride_date,
       pick_up_state, CAST(fare AS DOUBLE) AS fare"""
STORED_COLUMNS = RIDE_COLUMNS + """,
       CAST(YEAR(ride_date) AS BIGINT) AS year, CAST(MONTH(ride_date) AS BIGINT) AS month,
       CAST(DAY(ride_date) AS BIGINT) AS day"""

CHANGE_COLUMNS = """event_id, STRFTIME(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type,
       value, CAST(props ->> '$.k' AS BIGINT) AS k,
       CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _stored_rides(where: str = "TRUE") -> str:
    return _with(RIDES) + f" SELECT {STORED_COLUMNS} FROM rides WHERE {where}"


def _user_state(partition: str) -> str:
    return f"""
SELECT user_id, event_type AS state, STRFTIME(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_id, value, props
FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY {partition} ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS ranked
WHERE rn = 1"""


def _sliced_facts(cuts: tuple[str, ...]) -> str:
    """Facts of the two-branch refresh when the last slice holds tips only.

    A ride gets the tips of its own slice; the tips of the last slice then
    re-price every ride they name.
    """
    slice_of = " + ".join(f"CASE WHEN {{day}} >= DATE '{c}' THEN 1 ELSE 0 END" for c in cuts)
    last = len(cuts)
    return f"""{RIDES},{RAW_TIPS},
versions AS (
  SELECT *, {slice_of.format(day='tipped_on')} AS slice FROM raw_tips
),
slice_tips AS (
  SELECT slice, ride_id, tip_id, tip_amount FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY slice, tip_id ORDER BY tipped_on DESC, tip_amount DESC) AS rn
    FROM versions) AS v
  WHERE rn = 1
),
slice_last_tip AS (
  SELECT slice, ride_id, tip_amount FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY slice, ride_id ORDER BY tip_id DESC) AS rn
    FROM slice_tips) AS v
  WHERE rn = 1
),
priced AS (
  SELECT r.*, COALESCE(late.tip_amount, own.tip_amount, 0) AS tip_amount
  FROM rides r
  LEFT JOIN slice_last_tip own
    ON own.ride_id = r.ride_id AND own.slice = {slice_of.format(day='r.ride_date')}
  LEFT JOIN slice_last_tip late ON late.ride_id = r.ride_id AND late.slice = {last}
),
facts AS (
  SELECT driver_id, ride_id, fare, tip_amount, fare + tip_amount AS total_amount,
         CAST(STRFTIME(ride_date, '%Y%m%d') AS BIGINT) AS earning_date_key
  FROM priced
)"""


ALL_FACTS = ",".join([RIDES, TIPS, _facts("last_tip")])

GOLD_MONTH = """
SELECT d.driver_id, d.name AS driver_name, CAST(MONTH(ride_date) AS BIGINT) AS month,
       CAST(YEAR(ride_date) AS BIGINT) AS year, CAST(SUM(total_amount) AS DOUBLE) AS total_earnings
FROM facts f JOIN drivers d ON f.driver_id = d.driver_id
GROUP BY d.driver_id, d.name, MONTH(ride_date), YEAR(ride_date)"""
GOLD_YEAR = """
SELECT d.name AS driver_name, CAST(YEAR(ride_date) AS BIGINT) AS year,
       CAST(SUM(total_amount) AS DOUBLE) AS total_earnings
FROM facts f JOIN drivers d ON f.driver_id = d.driver_id
GROUP BY d.name, YEAR(ride_date)"""
GOLD_TIPS = """
SELECT d.driver_id, d.name AS driver_name, CAST(SUM(tip_amount) AS DOUBLE) AS total_tips
FROM facts f JOIN drivers d ON f.driver_id = d.driver_id
GROUP BY d.driver_id, d.name"""
GOLD_RIDES = """
SELECT CAST(YEAR(ride_date) AS BIGINT) AS year, CAST(MONTH(ride_date) AS BIGINT) AS month,
       CAST(COUNT(ride_id) AS BIGINT) AS ride_count
FROM rides GROUP BY YEAR(ride_date), MONTH(ride_date)"""


_NEWEST_LINES = """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       STRFTIME(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC) AS rn
      FROM lineitem) AS versions
WHERE rn = 1"""


def registered() -> dict[str, str]:
    gold = _with(ALL_FACTS, DRIVERS)
    views = gold + f""",
g1 AS ({GOLD_MONTH}), g2 AS ({GOLD_YEAR}), g3 AS ({GOLD_TIPS}), g4 AS ({GOLD_RIDES})
SELECT 'gold_driver_earning_month_year' AS view_name, COUNT(*) AS n,
       CAST(SUM(CAST(total_earnings AS DECIMAL(18,2))) AS DOUBLE) AS total FROM g1
UNION ALL SELECT 'gold_driver_earning_year', COUNT(*),
       CAST(SUM(CAST(total_earnings AS DECIMAL(18,2))) AS DOUBLE) FROM g2
UNION ALL SELECT 'gold_driver_who_made_most_money_on_tips', COUNT(*),
       CAST(SUM(CAST(total_tips AS DECIMAL(18,2))) AS DOUBLE) FROM g3
UNION ALL SELECT 'gold_rides_month_year', COUNT(*), CAST(SUM(ride_count) AS DOUBLE) FROM g4"""
    # without the old rides of low priority
    fewer = _with(
        RIDES.replace("rides AS", "all_rides AS", 1),
        """
rides AS (
  SELECT * FROM all_rides
  WHERE NOT (pick_up_state = '5-LOW' AND ride_date < DATE '1998-01-01')
)""",
        TIPS, _facts("last_tip"), DRIVERS,
    )
    ride_slices = """CASE WHEN ride_date >= DATE '2000-01-01' THEN 3
                          WHEN ride_date >= DATE '1998-01-01' THEN 2 ELSE 1 END"""
    return {
        "date_dim": """
WITH bounds AS (
  SELECT CAST(MIN(d) AS DATE) AS lo, CAST(MAX(d) AS DATE) AS hi FROM (
    SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem) AS days
),
days AS (
  SELECT CAST(UNNEST(GENERATE_SERIES(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds
),
ridden AS (
  SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1
)
SELECT CAST(STRFTIME(days.d, '%Y%m%d') AS BIGINT) AS date_key,
       CAST(YEAR(days.d) AS BIGINT) AS year, CAST(MONTH(days.d) AS BIGINT) AS month,
       CAST(DAY(days.d) AS BIGINT) AS day, CAST(QUARTER(days.d) AS VARCHAR) AS quarter,
       DAYNAME(days.d) AS weekday, CAST(ISODOW(days.d) - 1 AS BIGINT) AS weekday_number,
       CAST(COALESCE(n, 0) AS BIGINT) AS rides
FROM days LEFT JOIN ridden ON days.d = ridden.d""",
        "date_keys": """
SELECT o_orderkey, CAST(STRFTIME(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
       STRFTIME(o_orderdate, '%Y-%m-%d') AS from_key,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE STRFTIME(o_orderdate, '%Y-%m-%d') END
         AS from_text
FROM orders""",
        "cdc_encode": """
WITH images AS (
  SELECT c_mktsegment AS segment, '"c_custkey":{"N":"' || c_custkey || '"}' AS id,
         '{"c_custkey":{"N":"' || c_custkey || '"},"c_name":{"S":"' || c_name
         || '"},"c_nationkey":{"N":"' || c_nationkey || '"},"c_acctbal":{"N":"' || c_acctbal
         || '"},"c_mktsegment":{"S":"' || c_mktsegment || '"},"in_debt":{"BOOL":' || (c_acctbal < 0)
         || '},"warned_as":{' || CASE WHEN c_acctbal < 0 THEN '"S":"' || c_mktsegment || '"'
                                      ELSE '"NULL":true' END
         || '},"home":{"M":{"nation":{"N":"' || c_nationkey || '"},"name":{"S":"' || c_name
         || '"}}},"tags":{"L":[{"S":"' || c_mktsegment || '"},{"S":"' || c_name || '"}]}}' AS image
  FROM customer
)
SELECT '{"eventName":"' || CASE segment WHEN 'BUILDING' THEN 'INSERT' WHEN 'MACHINERY' THEN 'REMOVE'
                                        ELSE 'MODIFY' END
       || '","dynamodb":{"' || CASE segment WHEN 'MACHINERY' THEN 'Old' ELSE 'New' END || 'Image":'
       || image || ',"Keys":{' || id || '}}}' AS value
FROM images""",
        "cdc_decode": f"SELECT {CHANGE_COLUMNS} FROM events",
        "cdc_latest_state": f"""
SELECT {CHANGE_COLUMNS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) AS ranked
WHERE rn = 1 AND event_type <> 'error'""",
        "cdc_apply_batch": f"""
SELECT {CHANGE_COLUMNS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) AS ranked
WHERE rn = 1 AND event_type <> 'error'""",
        "cdc_out_of_order": f"""
SELECT {CHANGE_COLUMNS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) AS ranked
WHERE rn = 1 AND event_type <> 'error'""",
        "cdc_outcomes": """
SELECT CASE WHEN reason = 'landed' THEN 'landed' WHEN reason IN ('other_event', 'no_image') THEN 'ignored' ELSE 'quarantined' END AS outcome,
       reason, COUNT(*) AS lines, COUNT(*) AS stored,
       CAST(SUM(CASE WHEN reason = 'landed' THEN event_id ELSE 0 END) AS BIGINT) AS ids
FROM (SELECT event_id, CASE event_id % 16 WHEN 0 THEN 'malformed' WHEN 1 THEN 'other_event' WHEN 2 THEN 'malformed'
        WHEN 3 THEN 'malformed' WHEN 4 THEN 'no_key' WHEN 5 THEN 'no_image' WHEN 6 THEN 'no_event' ELSE 'landed' END AS reason
      FROM events) AS lines GROUP BY reason""",
        "cdc_new_attribute": """
SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN UPPER(event_type) END AS channel,
       CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN value * 2 END AS weight,
       CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN event_type || ',x' END AS tags,
       CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op
FROM events""",
        "raw_land_and_scan": f"SELECT {CHANGE_COLUMNS} FROM events",
        "stream_land": f"SELECT {CHANGE_COLUMNS} FROM events",
        "stream_ingest": _stored_rides(),
        "stream_start": _with(RIDES) + f"""
SELECT {STORED_COLUMNS}, 'oldest' AS start FROM rides
UNION ALL SELECT {STORED_COLUMNS}, 'next' FROM rides WHERE ride_date >= DATE '2000-01-01'""",
        "silver_null_fill": _with(RIDES) + f" SELECT {RIDE_COLUMNS} FROM rides",
        "silver_clean": """
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id,
       CASE WHEN text IS NULL OR text IN ('None', 'null', '') THEN 'n/a' ELSE text END AS text,
       CASE WHEN lang IS NULL OR lang IN ('None', 'null', '') THEN 'n/a' ELSE lang END AS lang,
       CASE WHEN source IS NULL OR source IN ('None', 'null', '') THEN 'n/a' ELSE source END
         AS source,
       COALESCE(CAST(n_chars AS VARCHAR), 'n/a') AS n_chars,
       CASE WHEN quality = 1 THEN 'good' ELSE 'n/a' END AS quality,
       'n/a' AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
        "flatten_struct": _with(RIDES) + """
SELECT ride_id, CAST(fare AS DOUBLE) AS ride_fare, user_id AS ride_rider_user_id,
       c_name AS ride_rider_name, n_name AS ride_rider_home_state, driver_id
FROM rides JOIN customer ON user_id = CAST(c_custkey AS VARCHAR)
JOIN nation ON c_nationkey = n_nationkey""",
        "sql_transformer_partitions": _stored_rides(),
        "surrogate_key": """
SELECT 'user' AS kind, c_name AS name, SHA256(c_name) AS id FROM customer
UNION ALL SELECT 'driver', s_name, SHA256(s_name) FROM supplier""",
        "upsert_global": _user_state("user_id"),
        "upsert_partition_scoped": _user_state("event_type, user_id"),
        "upsert_bucketed": _NEWEST_LINES,
        "upsert_composite_key": _NEWEST_LINES,
        "hard_delete": """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name, n_name AS state,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey <> 7 AND CAST(c_acctbal AS DECIMAL(18,2)) >= 0""",
        "incremental_read": _stored_rides("ride_date >= DATE '1998-01-01'"),
        "incremental_resume": _with(RIDES) + """
SELECT ride_id, CAST(fare AS DOUBLE) AS fare,
       CAST(CASE WHEN ride_date < DATE '2000-01-01' THEN 1 ELSE 2 END AS BIGINT) AS run
FROM rides""",
        "as_of_savepoint": _stored_rides("ride_date < DATE '2000-01-01'"),
        "commit_list": _with(RIDES) + f"""
SELECT CAST({ride_slices} AS BIGINT) AS "commit", COUNT(*) AS upserts, CAST(0 AS BIGINT) AS deletes
FROM rides GROUP BY 1
UNION ALL SELECT 4, 0, COUNT(*) FROM rides WHERE driver_id = 'n/a' HAVING COUNT(*) > 0""",
        "savepoint_list": _with(RIDES) + f"""
SELECT CAST(c AS BIGINT) AS "commit", 'commit_' || CAST(c AS VARCHAR) AS savepoint,
       COUNT(*) AS rows_then
FROM rides JOIN (VALUES (1), (3)) AS s(c) ON {ride_slices} <= c
GROUP BY c""",
        "clustered_snapshot": _stored_rides(),
        "vacuumed_snapshot": _stored_rides(),
        "catalog_view": _stored_rides(),
        "catalog_view_pending": _stored_rides("pick_up_state <> '5-LOW'"),
        "earnings_batch": _with(ALL_FACTS) + FACT_COLUMNS,
        "earnings_join_buckets": _with(ALL_FACTS) + FACT_COLUMNS,
        "earnings_sum_tips": _with(RIDES, TIPS, _facts("tip_sum")) + FACT_COLUMNS,
        "earnings_default_calendar": (
            _with(RIDES, TIPS, _facts("last_tip", "2000-01-01")) + FACT_COLUMNS
        ),
        "earnings_incremental": _with(ALL_FACTS) + FACT_COLUMNS,
        "earnings_incremental_reference": (
            _with(_sliced_facts(("1998-01-01", "2000-01-01", "2001-08-02"))) + FACT_COLUMNS
        ),
        "earnings_tips_only": _with(_sliced_facts(("2001-08-02",))) + FACT_COLUMNS,
        "earnings_streamed": _with(ALL_FACTS) + FACT_COLUMNS,
        "gold_driver_month_year": gold + GOLD_MONTH,
        "gold_driver_year": gold + GOLD_YEAR,
        "gold_tips_by_driver": gold + GOLD_TIPS,
        "gold_top5_tips": gold + GOLD_TIPS + " ORDER BY total_tips DESC, d.driver_id LIMIT 5",
        "gold_rides_month_year": _with(RIDES) + GOLD_RIDES,
        "gold_views": views,
        "gold_catalog_views": views,
        "pipeline_cdc_to_gold": fewer + GOLD_MONTH,
        "gold_by_differences": fewer + f""",
g1 AS ({GOLD_MONTH}), g2 AS ({GOLD_YEAR}), g3 AS ({GOLD_TIPS}), g4 AS ({GOLD_RIDES})
SELECT view_name, driver_id, driver_name, CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month, total FROM (
SELECT 'gold_driver_earning_month_year' AS view_name, driver_id, driver_name, year, month, total_earnings AS total FROM g1
UNION ALL SELECT 'gold_driver_earning_year', NULL, driver_name, year, NULL, total_earnings FROM g2
UNION ALL SELECT 'gold_driver_who_made_most_money_on_tips', driver_id, driver_name, NULL, NULL, total_tips FROM g3
UNION ALL SELECT 'gold_rides_month_year', NULL, NULL, year, month, CAST(ride_count AS DOUBLE) FROM g4)""",
    }
