"""The registered queries in plain SQL, written independently of the Spark code."""

from __future__ import annotations

from tripmart.checks.roles import FHV, GREEN, NATION_ZONES, SUPPLIER_ZONES, YELLOW, select_sql

LABEL = """CASE {code} WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
    WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' END"""


def time_text(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def key_time(col: str, suffix: str = "+00") -> str:
    return (
        f"CASE WHEN date_trunc('second', {col}) = {col} THEN strftime({col}, '%Y-%m-%d %H:%M:%S') "
        f"ELSE {time_text(col)} END || '{suffix}'"
    )


def number(col: str) -> str:
    return f"CAST(CAST({col} AS DECIMAL(38,9)) AS DOUBLE)"


def surrogate(key: str, time: str, suffix: str = "+00") -> str:
    return f"md5(coalesce(CAST({key} AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' || {key_time(time, suffix)})"


GREEN_RAW = f"SELECT {select_sql(GREEN)} FROM lineitem"
YELLOW_RAW = f"SELECT {select_sql(YELLOW)} FROM orders"
FHV_RAW = f"SELECT {select_sql(FHV)} FROM events"
NATION_ZONE_ROWS = f"SELECT {select_sql(NATION_ZONES)} FROM nation JOIN region ON n_regionkey = r_regionkey"
SUPPLIER_ZONE_ROWS = f"""SELECT {select_sql(SUPPLIER_ZONES)} FROM supplier
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def staged_taxi(raw: str, prefix: str, trip_type: str, ehail_fee: str, extra_order: str) -> str:
    pickup, dropoff = f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"
    return f"""
    SELECT {surrogate("VendorID", pickup)} AS tripid,
        CAST(VendorID AS BIGINT) AS vendorid, CAST(RatecodeID AS BIGINT) AS ratecodeid,
        CAST(PULocationID AS BIGINT) AS pickup_locationid, CAST(DOLocationID AS BIGINT) AS dropoff_locationid,
        {time_text(pickup)} AS pickup_datetime, {time_text(dropoff)} AS dropoff_datetime,
        store_and_fwd_flag, CAST(passenger_count AS BIGINT) AS passenger_count,
        {number("trip_distance")} AS trip_distance, {trip_type} AS trip_type,
        {number("fare_amount")} AS fare_amount, {number("extra")} AS extra, {number("mta_tax")} AS mta_tax,
        {number("tip_amount")} AS tip_amount, {number("tolls_amount")} AS tolls_amount,
        {ehail_fee} AS ehail_fee, {number("improvement_surcharge")} AS improvement_surcharge,
        {number("total_amount")} AS total_amount, CAST(payment_type AS BIGINT) AS payment_type,
        {LABEL.format(code="payment_type")} AS payment_type_description,
        {number("congestion_surcharge")} AS congestion_surcharge
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY VendorID, {pickup}
            ORDER BY RatecodeID, PULocationID, DOLocationID, {dropoff}, store_and_fwd_flag, passenger_count,
                trip_distance, {extra_order} fare_amount, extra, mta_tax, tip_amount, tolls_amount,
                improvement_surcharge, total_amount, payment_type, congestion_surcharge
        ) AS row_num
        FROM ({raw}) WHERE VendorID IS NOT NULL
    ) WHERE row_num = 1"""


STG_A = staged_taxi(GREEN_RAW, "lpep", "CAST(trip_type AS BIGINT)", number("ehail_fee"), "trip_type,")
STG_B = staged_taxi(YELLOW_RAW, "tpep", "CAST(1 AS BIGINT)", "CAST(0 AS DOUBLE)", "")
STG_C = f"""
    SELECT {surrogate("dispatching_base_num", "pickup_datetime")} AS tripid,
        affiliated_base_number, dispatching_base_num,
        CAST(DOlocationID AS BIGINT) AS dropoff_locationid, CAST(round(PUlocationID) AS BIGINT) AS pickup_locationid,
        {time_text("dropOff_datetime")} AS dropoff_datetime, {time_text("pickup_datetime")} AS pickup_datetime,
        CAST(round(SR_Flag) AS BIGINT) AS sr_flag
    FROM ({FHV_RAW})"""
UNION = f"SELECT *, 'Green' AS service_type FROM ({STG_A}) UNION ALL SELECT *, 'Yellow' AS service_type FROM ({STG_B})"


def dim(zones: str) -> str:
    return f"""SELECT locationid, borough, zone, replace(service_zone, 'Boro', 'Green') AS service_zone
    FROM ({zones})"""


def fact(trips: str) -> str:
    return f"""
    WITH zones AS (SELECT * FROM ({dim(NATION_ZONE_ROWS)}) WHERE borough <> 'Unknown')
    SELECT t.*, p.borough AS pickup_borough, p.zone AS pickup_zone,
        d.borough AS dropoff_borough, d.zone AS dropoff_zone
    FROM ({trips}) t
    JOIN zones p ON t.pickup_locationid = p.locationid
    JOIN zones d ON t.dropoff_locationid = d.locationid"""


HALF_LOSSY = "l_quantity / 2 <> floor(l_quantity / 2)"


def report_month(month: int, flag: str, status: str, n_bad: str) -> str:
    return f"""SELECT 'green_tripdata_2023-{month:02d}.parquet' AS file_name, '{status}' AS status,
        count(*) AS n_rows, CAST({n_bad} AS BIGINT) AS n_bad
    FROM lineitem WHERE l_returnflag = '{flag}'"""


ORACLE: dict[str, str] = {
    "scan_parquet": f"""
        SELECT l_orderkey, l_linenumber, l_quantity, {time_text("l_shipdate")} AS l_shipdate FROM lineitem""",
    "register_external": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, {time_text("o_orderdate")} AS o_orderdate FROM orders""",
    "seed_csv": SUPPLIER_ZONE_ROWS,
    "surrogate_key": f"""
        SELECT o_orderkey, {surrogate("o_custkey", "o_orderdate", "")} AS tripid FROM orders""",
    "surrogate_key_nulls": f"""
        SELECT o_orderkey, {surrogate("nullif(o_custkey, 899)", "o_orderdate", "")} AS tripid FROM orders""",
    "case_code_label": f"""
        SELECT l_orderkey, l_linenumber, {LABEL.format(code="l_linenumber")} AS label FROM lineitem""",
    "replace_literal": "SELECT c_custkey, replace(c_name, 'Customer', 'Green') AS name FROM customer",
    "cast_integer": """
        SELECT l_orderkey, l_linenumber, CAST(round(l_quantity / 2) AS BIGINT) AS half,
            CAST(round(-(l_quantity / 2)) AS BIGINT) AS minus_half FROM lineitem""",
    "cast_numeric": """
        SELECT l_returnflag,
            CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(38,9))) AS DECIMAL(38,9)) AS VARCHAR) AS price,
            CAST(CAST(sum(CAST(l_discount AS DECIMAL(38,9))) AS DECIMAL(38,9)) AS VARCHAR) AS discount,
            count(*) AS n_rows
        FROM lineitem GROUP BY l_returnflag""",
    "cast_timestamp": f"SELECT event_id, {time_text('ts')} AS at FROM events",
    "conform_constants": """
        SELECT o_orderkey, CAST(1 AS BIGINT) AS trip_type, CAST(0 AS DOUBLE) AS ehail_fee FROM orders""",
    "filter_not_null": """
        SELECT o_orderkey, o_orderpriority AS priority FROM orders
        WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL""",
    "dim_filter_neq": f"SELECT * FROM ({SUPPLIER_ZONE_ROWS}) WHERE borough <> 'Unknown'",
    "dedup_row_number": f"""
        SELECT * EXCLUDE (l_shipdate, row_num), {time_text("l_shipdate")} AS l_shipdate FROM (
            SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate
                ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS row_num
            FROM lineitem
        ) WHERE row_num = 1""",
    "tag_union_all": UNION,
    "role_playing_join": f"""
        WITH zones AS (SELECT * FROM ({NATION_ZONE_ROWS}) WHERE borough <> 'Unknown')
        SELECT l_orderkey, l_linenumber, l_extendedprice, c_nationkey, s_nationkey,
            p.borough AS pickup_borough, p.zone AS pickup_zone, d.borough AS dropoff_borough, d.zone AS dropoff_zone
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN zones p ON c_nationkey = p.locationid JOIN zones d ON s_nationkey = d.locationid""",
    "stg_feed_a": STG_A,
    "stg_feed_b": STG_B,
    "stg_feed_c": STG_C,
    "dim_zones": dim(SUPPLIER_ZONE_ROWS),
    "fact_trips": fact(UNION),
    "fact_passthrough": fact(STG_C),
    "write_day_partitioned": f"""
        SELECT event_id, {time_text("ts")} AS pickup_datetime, user_id, event_type, value, props,
            strftime(ts, '%Y-%m-%d') AS pickup_date FROM events""",
    "materialize_table": f"SELECT *, substr(pickup_datetime, 1, 10) AS pickup_date FROM ({fact(STG_C)})",
    "sample_limit": f"""
        SELECT least(count(*), 10) AS n_rows, least(count(DISTINCT tripid), 10) AS n_trips,
            least(count(vendorid), 10) AS n_vendors FROM ({STG_A})""",
    "extract_links": r"""
        SELECT DISTINCT url FROM (
            SELECT unnest(regexp_extract_all(html, 'href="([^"''<>\s]*)"', 1)) AS url FROM pages
        )""",
    "url_basename": "SELECT page_id, split_part(url, '/', -1) AS name FROM pages",
    "normalize_run_id": """
        SELECT page_id, replace(regexp_replace(url, '[_:T+]', '-', 'g'), '--', '-') AS run_id FROM pages""",
    "date_parts": "SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month FROM events",
    "publication_month": """
        SELECT o_orderkey, CAST(year(o_orderdate - INTERVAL 2 MONTH) AS INT) AS year,
            CAST(month(o_orderdate - INTERVAL 2 MONTH) AS INT) AS month FROM orders""",
    "coalesce_default": "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'F') AS status FROM orders",
    "manifest": """
        WITH runs AS (
            SELECT DISTINCT o_orderstatus AS vehicle_type, CAST(year(o_orderdate) AS INT) AS year,
                max(o_orderdate) OVER (PARTITION BY o_orderstatus) AS as_of
            FROM orders
        ), months AS (
            SELECT vehicle_type, year, CAST(unnest(generate_series(1, CASE
                WHEN year < year(as_of) THEN 12
                WHEN year = year(as_of - INTERVAL 2 MONTH) THEN month(as_of - INTERVAL 2 MONTH)
                ELSE 0 END)) AS INT) AS month
            FROM runs
        )
        SELECT vehicle_type, year, month,
            format('{}_tripdata_{}-{:02d}.parquet', vehicle_type, year, month) AS file_name
        FROM months""",
    "manifest_valid": """
        SELECT l_orderkey AS orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "manifest_invalid": """
        SELECT l_orderkey AS orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "safe_cast_check": f"""
        SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER ({HALF_LOSSY}) AS n_bad
        FROM lineitem GROUP BY l_returnflag""",
    "ingest_enforced": f"""
        SELECT * REPLACE ({time_text("lpep_pickup_datetime")} AS lpep_pickup_datetime,
                {time_text("lpep_dropoff_datetime")} AS lpep_dropoff_datetime),
            CAST(2023 AS INT) AS year
        FROM (SELECT {select_sql(GREEN)}, CAST(CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS INT) AS month
            FROM lineitem)""",
    "ingest_passthrough": f"SELECT * REPLACE ({time_text('ts')} AS ts) FROM events",
    "ingest_report": f"""
        {report_month(1, "A", "landed", "0")}
        UNION ALL {report_month(2, "N", "failed", f"count(*) FILTER ({HALF_LOSSY})")}
        UNION ALL {report_month(3, "R", "failed", "0")}
        UNION ALL SELECT 'green_tripdata_2023-04.parquet', 'missing', NULL, 0""",
    "ingest_rerun": """
        WITH months AS (
            SELECT CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS INT) AS month, count(*) AS n_rows
            FROM lineitem GROUP BY 1
        )
        SELECT month, format('green_tripdata_2023-{:02d}.parquet', month) AS file_name,
            CASE month WHEN 1 THEN 'unchanged' ELSE 'landed' END AS status, n_rows,
            'landed' AS ledger_status, n_rows AS ledger_rows, n_rows AS landed_rows
        FROM months""",
    "ingest_local": """
        SELECT CAST(l_suppkey AS VARCHAR) AS VendorID, CAST(l_quantity AS BIGINT) AS passenger_count,
            l_extendedprice AS fare_amount, CAST(CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS INT) AS month
        FROM lineitem""",
    "refresh_days": f"SELECT *, substr(pickup_datetime, 1, 10) AS pickup_date FROM ({fact(STG_C)})",
    "sample_build": f"""
        SELECT * FROM ({STG_A}) JOIN (
            SELECT DISTINCT {surrogate("VendorID", "lpep_pickup_datetime")} AS tripid FROM ({GREEN_RAW})
            WHERE substr({surrogate("VendorID", "lpep_pickup_datetime", "")}, 1, 4) < '199a'
        ) USING (tripid)""",
    "read_days": f"""
        SELECT event_id, {time_text("ts")} AS pickup_datetime, event_type FROM events
        WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:30:00'""",
    "manifest_marked": """
        SELECT nullif(l_orderkey, 7) AS orderkey, l_linenumber, l_partkey, coalesce(nullif(l_orderkey, 7) IN (
            SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'), false) AS available
        FROM lineitem""",
    "manifest_grid": """
        WITH newest AS (SELECT max(o_orderdate) - INTERVAL 2 MONTH AS last FROM orders),
        feeds AS (SELECT DISTINCT o_orderstatus AS vehicle_type FROM orders),
        years AS (SELECT DISTINCT year(o_orderdate) AS year FROM orders),
        asked AS (
            SELECT 'years' AS asked, vehicle_type, year, unnest(generate_series(1, 12)) AS month FROM feeds, years
            UNION ALL SELECT 'month', vehicle_type, year, 3 FROM feeds, years
            UNION ALL SELECT 'newest', vehicle_type, year(last), month(last) FROM feeds, newest
        )
        SELECT a.asked, a.vehicle_type, CAST(a.year AS INT) AS year, CAST(a.month AS INT) AS month,
            format('{}_tripdata_{}-{:02d}.parquet', a.vehicle_type, a.year, a.month) AS file_name, n_orders
        FROM asked a JOIN newest ON a.asked <> 'years' OR a.year < year(last)
            OR a.year = year(last) AND a.month <= month(last)
        LEFT JOIN (SELECT o_orderstatus AS vehicle_type, year(o_orderdate) AS year, month(o_orderdate) AS month,
            count(*) AS n_orders FROM orders GROUP BY ALL) p
        ON a.vehicle_type = p.vehicle_type AND a.year = p.year AND a.month = p.month""",
}
