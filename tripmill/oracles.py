"""The results of ``queries.py`` as SQL for an independent engine.

Written from the meaning of each operator, not from how Spark runs it: an upsert is one full outer join here,
and the row kept per key is a ``row_number``.
"""

from __future__ import annotations

from textwrap import dedent


def _feed(status: str, prefix: str) -> str:
    return f"""
        SELECT CAST(l_suppkey % 2 + 1 AS INTEGER) AS VendorID,
               CAST(l_quantity AS INTEGER) % 7 AS passenger_count,
               l_discount * 100 AS trip_distance,
               l_shipdate AS {prefix}_pickup_datetime,
               l_shipdate + to_seconds(l_linenumber * 450) AS {prefix}_dropoff_datetime,
               CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_partkey % 5 + 1 AS INTEGER) END AS PUlocationID,
               CASE WHEN l_partkey % 40 <> 0 THEN CAST(l_orderkey % 5 + 1 AS INTEGER) END AS DOlocationID,
               CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS RatecodeID,
               l_extendedprice AS total_amount,
               CASE WHEN l_orderkey % 10 <> 0 THEN CAST(l_orderkey % 5 + 1 AS INTEGER) END AS payment_type
        FROM lineitem WHERE l_linestatus = '{status}'"""


_RENAMED = """VendorID, passenger_count AS PassengerCount, trip_distance AS TripDistance,
               {p}_pickup_datetime AS PickupTime, {p}_dropoff_datetime AS DropTime,
               PUlocationID AS PickupLocationId, DOlocationID AS DropLocationId, RatecodeID,
               total_amount AS TotalAmount, payment_type AS PaymentType"""

_CONFORMED = f"""
    green AS ({_feed("O", "lpep")}),
    yellow AS ({_feed("F", "tpep")}),
    conformed AS (
        SELECT {_RENAMED.format(p="lpep")}, 'Green' AS TripMode FROM green
        UNION ALL
        SELECT {_RENAMED.format(p="tpep")}, 'Yellow' AS TripMode FROM yellow
    )"""

_TYPE = "CASE WHEN {code} = 6 THEN 'SharedTrip' ELSE 'SoloTrip' END"
_KEYS = (
    "PickupTime, DropTime, PickupLocationId, DropLocationId, PaymentType, VendorID, PassengerCount, "
    "TripType, TripMode"
)


def _keyed(where: str = "true") -> str:
    return f"""
    keyed AS (
        SELECT VendorID, PassengerCount, TripDistance, PickupTime, DropTime, PickupLocationId,
               DropLocationId, TotalAmount, coalesce(PaymentType, 5) AS PaymentType,
               {_TYPE.format(code="coalesce(RatecodeID, 1)")} AS TripType, TripMode
        FROM conformed WHERE {where}
    )"""


def _first_row(order_by: str, keys: str = _KEYS) -> str:
    return f"""
    one_per_key AS (
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order_by}) AS place FROM keyed
        ) WHERE place = 1
    )"""


_LATEST = "PickupTime DESC NULLS LAST, TripDistance DESC NULLS LAST, TotalAmount DESC NULLS LAST"
_CHEAPEST = "TotalAmount ASC NULLS FIRST, TripDistance ASC NULLS FIRST"
_WHOLE = "PassengerCount > 0 AND TripDistance > 0.0 AND PickupLocationId IS NOT NULL"


def _parts(column: str, prefix: str) -> str:
    return ", ".join(
        f"CAST({part}({column}) AS INTEGER) AS {prefix}{part.title()}" for part in ("year", "month", "day")
    )


_MINUTES = "round((epoch({end}) - epoch({start})) / 60)"


def _trips(where: str = _WHOLE, order_by: str = _LATEST) -> str:
    minutes = _MINUTES.format(start="PickupTime", end="DropTime")
    return f"""{_CONFORMED},{_keyed(where)},{_first_row(order_by)},
    trips AS (
        SELECT *, {_parts("PickupTime", "Trip")}, {minutes} AS TripTimeInMinutes FROM one_per_key
    )"""


_TRIP_COLUMNS = [
    "VendorID", "PassengerCount", "TripDistance", "PickupTime", "DropTime", "PickupLocationId",
    "DropLocationId", "TotalAmount", "PaymentType", "TripYear", "TripMonth", "TripDay", "TripTimeInMinutes",
    "TripType", "TripMode",
]
_MERGE_KEYS = ["TripYear", *_KEYS.split(", ")]
_ANY_CHANGE = " OR ".join(f"t.{column} <> s.{column}" for column in _TRIP_COLUMNS)


def _merge(target: str, equal: str, changed: str = _ANY_CHANGE, more: str = "") -> str:
    """One upsert of ``src`` into ``target``."""
    on = " AND ".join(f"t.{key} {equal} s.{key}" for key in _MERGE_KEYS)
    take = f"t.here IS NULL OR (s.here IS NOT NULL AND coalesce({changed}, false))"
    values = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in _TRIP_COLUMNS)
    return f"""
        SELECT {values}{more}
        FROM (SELECT *, 1 AS here FROM {target}) t FULL OUTER JOIN (SELECT *, 1 AS here FROM src) s ON {on}"""


_SIDES = f"""{_trips()},
    trg AS (SELECT * FROM trips WHERE TripYear <= 1999),
    src AS (
        SELECT * REPLACE (TotalAmount + CASE WHEN VendorID = 1 THEN 1.0 ELSE 0.0 END AS TotalAmount)
        FROM trips WHERE TripYear >= 1999
    )"""


def _upserted(equal: str, runs: int) -> str:
    steps = ["trg"]
    sql = f"WITH {_SIDES}"
    for run in range(runs):
        sql += f", run{run} AS ({_merge(steps[-1], equal)})"
        steps.append(f"run{run}")
    return f"{sql} SELECT * FROM {steps[-1]}"


_REPORT = f"""WITH {_SIDES}, pairs AS (
    SELECT coalesce({" OR ".join(f"t.{c} <> s.{c}" for c in _TRIP_COLUMNS)}, false) AS changed
    FROM trg t JOIN src s ON {" AND ".join(f"t.{key} = s.{key}" for key in _MERGE_KEYS)}
)
SELECT (SELECT count(*) FROM src) AS source_rows,
       (SELECT count(*) FROM pairs) AS matched,
       (SELECT count(*) FROM pairs WHERE changed) AS updated,
       (SELECT count(*) FROM src) - (SELECT count(*) FROM pairs) AS inserted"""

_DIRTY = """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber
               WHEN 2 THEN '2025-13-45'
               WHEN 3 THEN 'xx' || strftime(l_shipdate, '%Y-%m-%d') || 'yy'
               WHEN 4 THEN strftime(l_shipdate, '%Y-%m-%d')
               WHEN 5 THEN 'XQDS'
               WHEN 6 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '.123'
               WHEN 7 THEN NULL
               ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
           END AS PickupTime,
           strftime(l_shipdate + to_seconds(l_partkey % 5000 - 100), '%Y-%m-%d %H:%M:%S') AS DropTime
    FROM lineitem"""

_DATE = (
    "CASE WHEN regexp_matches(PickupTime, '[0-9]{4}-[0-9]{2}-[0-9]{2}') "
    "THEN TRY_CAST(left(PickupTime, 10) AS DATE) END"
)
_FULL_TIME = "CASE WHEN regexp_full_match({c}, '[0-9-]{{10}} [0-9:]{{8}}') THEN TRY_CAST({c} AS TIMESTAMP) END"

# Columns of the green feed that come as text, and whether they hold whole numbers.
_DIRTY_NUMBERS = {"passenger_count": True, "payment_type": True, "trip_distance": False}


def _dirty_number(column: str) -> str:
    return f"""CASE coalesce(RatecodeID, 0) % 5
                   WHEN 1 THEN CAST(CAST(trunc({column}) AS INTEGER) AS VARCHAR) || '.0'
                   WHEN 2 THEN 'x' WHEN 3 THEN '' ELSE CAST({column} AS VARCHAR) END AS {column}"""


def _read_number(column: str, whole: bool) -> str:
    return f"TRY_CAST(TRY_CAST({column} AS DOUBLE) AS INTEGER) AS {column}" if whole else f"TRY_CAST({column} AS DOUBLE) AS {column}"


_ORACLES = {
    "table_scan_filter": "SELECT * FROM region WHERE r_regionkey = 0",
    "csv_roundtrip": 'SELECT o_orderdate, o_orderkey, o_orderpriority, o_totalprice AS "O_TotalPrice" FROM orders',
    "csv_inferred_types": "SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "feeds_by_header": "SELECT c_name, c_custkey, c_acctbal FROM customer",
    "dirty_lines": """
        WITH lines AS (
            SELECT *, (l_orderkey + l_linenumber) % 10 AS kind, CAST(trunc(l_quantity) AS INTEGER) AS quantity,
                   CAST(l_shipdate AS DATE) AS day
            FROM lineitem
        ), texts AS (
            SELECT *, l_orderkey || ',' || l_linenumber || ',' || CASE WHEN kind = 1 THEN 'many' ELSE CAST(quantity AS VARCHAR) END
                   || CASE kind WHEN 2 THEN '' WHEN 4 THEN ',2025-13-45' ELSE ',' || CAST(day AS VARCHAR) END
                   || CASE WHEN kind = 3 THEN ',x' ELSE '' END AS line
            FROM lines
        )
        SELECT CASE WHEN kind NOT BETWEEN 1 AND 4 THEN l_orderkey END AS l_orderkey,
               CASE WHEN kind NOT BETWEEN 1 AND 4 THEN CAST(l_linenumber AS INTEGER) END AS l_linenumber,
               CASE WHEN kind NOT BETWEEN 1 AND 4 THEN quantity END AS l_quantity,
               CASE WHEN kind NOT BETWEEN 1 AND 4 THEN CAST(day AS TIMESTAMP) END AS l_shipdate,
               CASE WHEN kind BETWEEN 1 AND 4 THEN line END AS line,
               CASE kind WHEN 1 THEN 'value of l_quantity' WHEN 2 THEN 'fields' WHEN 3 THEN 'fields'
                         WHEN 4 THEN 'value of l_shipdate' END AS reason
        FROM texts""",
    "table_overwrite": "SELECT * FROM customer",
    "partitioned_table_read": f"""
        WITH years AS (SELECT *, {_parts("o_orderdate", "Order")} FROM orders)
        SELECT * FROM years
        WHERE OrderYear IN (SELECT OrderYear FROM years WHERE o_orderdate >= '2000-06-01')""",
    "surrogate_key": """
        SELECT row_number() OVER (ORDER BY o_orderkey) AS sk_order, o_orderkey, o_totalprice FROM orders""",
    "renamed_columns": """
        SELECT l_orderkey, l_linenumber AS line, l_tax AS l_discount, l_discount AS l_tax FROM lineitem""",
    "constant_columns": """
        SELECT o_orderkey, 'abc' AS col1, CAST(999 AS INTEGER) AS col2, '2040-01-01' AS col3, true AS col4,
               CAST(0.01 AS DOUBLE) AS col5
        FROM orders""",
    "read_feeds_union": f"WITH {_CONFORMED} SELECT * FROM conformed",
    "union_by_position": """
        SELECT c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey FROM customer
        UNION ALL SELECT s_name, s_acctbal FROM supplier""",
    "clean_trips": f"""
        WITH {_CONFORMED}
        SELECT DISTINCT * REPLACE (coalesce(PaymentType, 5) AS PaymentType, coalesce(RatecodeID, 1) AS RatecodeID)
        FROM conformed WHERE {_WHOLE}""",
    "clean_trips_both_locations": f"""
        WITH {_CONFORMED}
        SELECT DISTINCT * REPLACE (coalesce(payment_type, 5) AS payment_type, coalesce(RatecodeID, 1) AS RatecodeID)
        FROM (
            SELECT *, 'Green' AS TripMode FROM green
            UNION ALL
            SELECT * RENAME (
                tpep_pickup_datetime AS lpep_pickup_datetime, tpep_dropoff_datetime AS lpep_dropoff_datetime
            ), 'Yellow' AS TripMode FROM yellow
        )
        WHERE passenger_count > 0 AND trip_distance > 0.0
          AND PUlocationID IS NOT NULL AND DOlocationID IS NOT NULL""",
    "dirty_feeds": f"""
        WITH {_CONFORMED}, texts AS (
            SELECT lpep_pickup_datetime, RatecodeID, {", ".join(_dirty_number(c) for c in _DIRTY_NUMBERS)} FROM (
                SELECT * FROM green
                UNION ALL
                SELECT * RENAME (
                    tpep_pickup_datetime AS lpep_pickup_datetime, tpep_dropoff_datetime AS lpep_dropoff_datetime
                ) FROM yellow
            )
        )
        SELECT lpep_pickup_datetime, RatecodeID,
               {", ".join(_read_number(c, whole) for c, whole in _DIRTY_NUMBERS.items())},
               {" + ".join(f"CASE WHEN {c} <> '' AND TRY_CAST({c} AS DOUBLE) IS NULL THEN 1 ELSE 0 END" for c in _DIRTY_NUMBERS)}
               AS unreadable
        FROM texts""",
    "distinct_rows": "SELECT DISTINCT user_id, event_type FROM events",
    "calendar_parts": f"""
        SELECT o_orderkey, o_orderdate, {_parts("o_orderdate", "Order")} FROM orders""",
    "calendar_parts_dirty_text": f"""
        WITH dirty AS ({_DIRTY})
        SELECT l_orderkey, l_linenumber, PickupTime, {_parts(_DATE, "Trip")} FROM dirty""",
    "trip_duration": f"""
        WITH {_CONFORMED}
        SELECT PickupTime, DropTime, {_MINUTES.format(start="PickupTime", end="DropTime")} AS TripTimeInMinutes
        FROM conformed""",
    "trip_duration_dirty_text": f"""
        WITH dirty AS ({_DIRTY})
        SELECT *, {_MINUTES.format(start=_FULL_TIME.format(c="PickupTime"), end=_FULL_TIME.format(c="DropTime"))}
               + 0.0 AS TripTimeInMinutes
        FROM dirty""",
    "trip_type": f"""
        WITH {_CONFORMED}
        SELECT TripMode, PickupTime, {_TYPE.format(code="RatecodeID")} AS TripType FROM conformed""",
    "trips_by_key": f"WITH {_CONFORMED},{_keyed()},{_first_row(_LATEST)} SELECT * FROM one_per_key",
    "trips_by_key_asc": f"WITH {_CONFORMED},{_keyed()},{_first_row(_CHEAPEST)} SELECT * FROM one_per_key",
    "trips_by_key_per_feed": " UNION ALL ".join(
        f"(WITH {_CONFORMED},{_keyed(f"TripMode = '{mode}'")},{_first_row(_LATEST, _KEYS.replace(', TripMode', ''))}"
        " SELECT * FROM one_per_key)"
        for mode in ("Green", "Yellow")
    ),
    "busiest_key": "",
    "upsert_trips": _upserted("=", runs=1),
    "upsert_trips_rerun": _upserted("=", runs=2),
    "upsert_null_safe": _upserted("IS NOT DISTINCT FROM", runs=1),
    "upsert_null_safe_rerun": _upserted("IS NOT DISTINCT FROM", runs=2),
    "upsert_sliced": _upserted("=", runs=1),
    "upsert_mapped": f"WITH {_SIDES}" + _merge("trg", "=", "t.TotalAmount < s.TotalAmount AND s.PaymentType <> 1"),
    "upsert_numbered": f"WITH {_SIDES}"
    + _merge("trg", "IS NOT DISTINCT FROM", more=", t.here IS NULL AS is_new, true AS number_ok"),
    "upsert_report": _REPORT,
    "merged_partitions": f"WITH {_trips()} SELECT DISTINCT TripYear FROM trips",
    "conformed_trips": f"WITH {_trips()} SELECT * FROM trips",
    "conformed_trips_both_locations": f"""
        WITH {_trips(_WHOLE + " AND DropLocationId IS NOT NULL", _CHEAPEST)} SELECT * FROM trips""",
    "monthly_run": f"WITH {_trips()} SELECT * FROM trips",
}

_BUSIEST = ", ".join(
    f"{column} DESC NULLS LAST"
    for column in (
        "TotalAmount", "PickupTime", "VendorID", "PassengerCount", "TripDistance", "DropTime",
        "PickupLocationId", "DropLocationId", "PaymentType",
    )
)
_ORACLES["busiest_key"] = (
    f"WITH {_CONFORMED},{_keyed()},{_first_row(_BUSIEST, 'TripMode, TripType')} SELECT * FROM one_per_key"
)

ORACLES = {name: dedent(sql).strip() for name, sql in _ORACLES.items()}
