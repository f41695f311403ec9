"""The results of the queries, stated in SQL for DuckDB."""

from __future__ import annotations

import math

from checks.incidents import incidents_sql
from checks.queries import END, START
from cinderlake.schemas import INCIDENT_SCHEMA, MEASURES, RAW_RENAMES, UNIQUE_FIELDS, names
from cinderlake.sources import synthetic as syn

CALENDAR = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_dim_id,
       d AS date_actual,
       CAST(epoch(d) AS BIGINT) AS epoch,
       CAST(day(d) AS VARCHAR) || CASE
           WHEN day(d) IN (11, 12, 13) THEN 'th'
           WHEN day(d) % 10 = 1 THEN 'st'
           WHEN day(d) % 10 = 2 THEN 'nd'
           WHEN day(d) % 10 = 3 THEN 'rd'
           ELSE 'th' END AS day_suffix,
       dayname(d) AS day_name,
       CAST(isodow(d) AS INTEGER) AS day_of_week,
       CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(date_diff('day', date_trunc('quarter', d), d) + 1 AS INTEGER) AS day_of_quarter,
       CAST(dayofyear(d) AS INTEGER) AS day_of_year,
       CAST((day(d) - 1) // 7 + 1 AS INTEGER) AS week_of_month,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       CAST(isoyear(d) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0')
           || '-' || CAST(isodow(d) AS VARCHAR) AS week_of_year_iso,
       CAST(month(d) AS INTEGER) AS month_actual,
       monthname(d) AS month_name,
       strftime(d, '%b') AS month_name_abbreviated,
       CAST(quarter(d) AS INTEGER) AS quarter_actual,
       ['First', 'Second', 'Third', 'Fourth'][quarter(d)] AS quarter_name,
       CAST(year(d) AS INTEGER) AS year_actual,
       CAST(d - CAST(isodow(d) - 1 AS INTEGER) AS DATE) AS first_day_of_week,
       CAST(d + CAST(7 - isodow(d) AS INTEGER) AS DATE) AS last_day_of_week,
       CAST(date_trunc('month', d) AS DATE) AS first_day_of_month,
       last_day(d) AS last_day_of_month,
       CAST(date_trunc('quarter', d) AS DATE) AS first_day_of_quarter,
       CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last_day_of_quarter,
       make_date(year(d), 1, 1) AS first_day_of_year,
       make_date(year(d), 12, 31) AS last_day_of_year,
       strftime(d, '%m%Y') AS mmyyyy,
       strftime(d, '%m%d%Y') AS mmddyyyy,
       isodow(d) IN (6, 7) AS weekend_indr
FROM (SELECT CAST(DATE '1970-01-01' + CAST(n AS INTEGER) AS DATE) AS d FROM range(29220) r(n))
"""

_INCIDENTS = incidents_sql()
_TAB = "chr(9)"
_BLANKS = f"' ' || {_TAB} || chr(10)"


def _clean(column: str) -> str:
    return f"trim(upper({column}), {_BLANKS})"


def _acronym(column: str) -> str:
    return (
        f"list_aggregate(list_transform(string_split({column}, ' '),"
        " lambda w: CASE WHEN length(w) > 2 THEN w[1] ELSE w END), 'string_agg', '')"
    )


_FACT = ", ".join(
    f"coalesce({c if c != 'num_alarms' else 'number_of_alarms'}, 0) AS {c}" for c in MEASURES
)

# Surrogate keys of the second load come after those of the first.
_STAR = f"""
WITH incidents AS ({_INCIDENTS}),
staged AS (
    SELECT *, {_clean('battalion')} AS b, {_clean('neighborhood_district')} AS d,
           {_clean('city')} AS c, incident_date < TIMESTAMP '1998-01-01' AS early
    FROM incidents
),
battalions AS (
    SELECT b, row_number() OVER (ORDER BY CASE WHEN early THEN 0 ELSE 1 END, b) AS sk
    FROM (SELECT b, bool_or(early) AS early FROM staged WHERE b IS NOT NULL GROUP BY b)
),
district_rows AS (
    SELECT d, c, early, row_number() OVER
        (PARTITION BY d ORDER BY CASE WHEN early THEN 0 ELSE 1 END, id, city) AS rank
    FROM staged WHERE d IS NOT NULL
),
districts AS (
    SELECT d, c, row_number() OVER (ORDER BY CASE WHEN early THEN 0 ELSE 1 END, d) AS sk
    FROM district_rows WHERE rank = 1
)
SELECT incident_number, id, incident_date, battalions.sk AS dim_battalion_sk,
       districts.sk AS dim_district_sk, {_FACT},
       battalions.b AS battalion, districts.d AS neighborhood_district,
       districts.c AS city, {_acronym('districts.c')} AS city_cleaned
FROM staged
LEFT JOIN battalions ON staged.b = battalions.b
LEFT JOIN districts ON staged.d = districts.d
"""

_COUNTS = f"""
WITH incidents AS ({_INCIDENTS}),
staged AS (
    SELECT {_clean('battalion')} AS b, {_clean('neighborhood_district')} AS d,
           incident_date < TIMESTAMP '1998-01-01' AS early
    FROM incidents
),
held AS (
    SELECT count(*) AS f1, count(DISTINCT b) AS b1, count(DISTINCT d) AS d1 FROM staged WHERE early
),
whole AS (
    SELECT count(*) AS f2, count(DISTINCT b) AS b2, count(DISTINCT d) AS d2 FROM staged
)
SELECT CAST(load_number AS INTEGER) AS load_number, table_name, CAST(rows_gained AS BIGINT) AS rows_gained
FROM held, whole, LATERAL (VALUES
    (1, 'raw_fact_fire_department', f1), (1, 'dim_battalion', b1), (1, 'dim_district', d1),
    (1, 'fact_fire_department_injuries', f1),
    (2, 'raw_fact_fire_department', f2), (2, 'dim_battalion', b2 - b1), (2, 'dim_district', d2 - d1),
    (2, 'fact_fire_department_injuries', f2 - f1),
    (3, 'raw_fact_fire_department', f2), (3, 'dim_battalion', 0), (3, 'dim_district', 0),
    (3, 'fact_fire_department_injuries', 0)
) v(load_number, table_name, rows_gained)
"""

_RAW = ", ".join(
    "CAST(NULL AS VARCHAR) AS mutual_aid" if c == "mutual_aid" else f"{c} AS {RAW_RENAMES.get(c, c)}"
    for c in names(INCIDENT_SCHEMA)
)


def _synthetic(row: str = "o_orderkey", rows: str = "orders") -> str:
    """One synthetic incident per order, as the same draws in SQL, numbered by ``row`` of ``rows``."""
    single = [
        *UNIQUE_FIELDS, *syn.TIMES, *syn.LOSSES, *syn.COORDINATES, "numbers", "choices", "address"
    ]
    bits = ", ".join(
        f"CAST('0x' || substring(md5('7|{n}|' || CAST({row} AS VARCHAR)), 1, 15) AS BIGINT) AS _{n}"
        for n in single
    )

    def digits(drawn: str, counts: list[int]) -> list[str]:
        steps = [math.prod(counts[:n]) for n in range(len(counts))]
        return [f"(({drawn} // {s}) % {c})" for s, c in zip(steps, counts)]

    def degrees(drawn: str, limit: int) -> str:
        half = limit * 10**15
        steps = f"({drawn} % {2 * half + 1} - {half})"
        return (
            f"CAST(CAST(CAST({steps} AS DECIMAL(19,0)) * CAST('0.000000000000001' AS DECIMAL(16,15))"
            " AS DECIMAL(20,16)) AS VARCHAR)"
        )

    seconds = int((END - START).total_seconds()) + 1
    fields = {f: f"_{f} % drawn + max_{f} + 1" for f in UNIQUE_FIELDS}
    fields |= {f: f"TIMESTAMP '{START}' + to_seconds(_{f} % {seconds})" for f in syn.TIMES}
    fields |= {
        f: f"CAST(_{f} AS DOUBLE) / {float(2**60)!r} * {float(syn.MAX_LOSS)!r}" for f in syn.LOSSES
    }
    numbers = digits("_numbers", list(syn.COUNTS.values()))
    fields |= {f: f"{d} + {low}" for (f, (low, _)), d in zip(syn.INTEGER_RANGES.items(), numbers)}
    chosen = digits("_choices", [len(o) for o in syn.CHOICES.values()])
    for (f, options), digit in zip(syn.CHOICES.items(), chosen):
        fields[f] = "[" + ", ".join(f"'{o}'" for o in options) + f"][{digit} + 1]"
    house, zipcode = digits("_address", [syn.HOUSES, syn.ZIPCODES])
    fields |= {
        "address": f"CAST({house} + 1 AS VARCHAR) || ' ' || {fields['street']} || ' ' || {fields['street_kind']}",
        "city": "'SF'",
        "zipcode": f"lpad(CAST({zipcode} AS VARCHAR), 5, '0')",
        "number_of_alarms": "1",
        "mutual_aid": "'None'",
        "point": f"'POINT (' || {degrees('_lon', 180)} || ' ' || {degrees('_lat', 90)} || ')'",
    }
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    columns = []
    for f in INCIDENT_SCHEMA.fields:
        blank = "'-'" if f.dataType.typeName() == "string" else "0"
        kind = kinds[f.dataType.simpleString()]
        columns.append(f"CAST({fields.get(f.name, blank)} AS {kind}) AS {f.name}")
    maxima = ", ".join(f"max({f}) AS max_{f}" for f in UNIQUE_FIELDS)
    return (
        f"SELECT {row} AS _draw, {', '.join(columns)} FROM (SELECT {row}, {bits} FROM {rows}),"
        f" (SELECT {maxima} FROM ({_INCIDENTS})), (SELECT count(*) AS drawn FROM orders)"
    )


_LONE = " AND ".join(f"count(*) OVER (PARTITION BY {f}) = 1" for f in UNIQUE_FIELDS)
_COLUMNS = ", ".join(names(INCIDENT_SCHEMA))

ORACLE_SQL: dict[str, str] = {
    "dim_date_full": f"""
        SELECT c.*, count(o_orderkey) AS incident_count
        FROM ({CALENDAR}) c LEFT JOIN orders ON o_orderdate = date_actual
        GROUP BY ALL""",
    "incidents_by_weekday": f"""
        SELECT day_name, count(*) AS incident_count
        FROM orders JOIN ({CALENDAR}) ON o_orderdate = date_actual GROUP BY 1""",
    "avg_by_month": f"""
        SELECT month_name, sum(l_quantity) / count(*) AS avg_alarms
        FROM lineitem JOIN ({CALENDAR}) ON l_shipdate = date_actual GROUP BY 1""",
    "total_by_quarter": f"""
        SELECT quarter_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_property_loss
        FROM orders JOIN ({CALENDAR}) ON o_orderdate = date_actual GROUP BY 1""",
    "count_avg_by_year": f"""
        SELECT year_actual, count(*) AS incident_count,
               CAST(sum(l_partkey + l_suppkey + l_linenumber) AS DOUBLE) / count(*) AS avg_personnel_response
        FROM lineitem JOIN ({CALENDAR}) ON l_shipdate = date_actual GROUP BY 1""",
    "rate_by_weekend": f"""
        SELECT weekend_indr,
               CAST(count(*) FILTER (l_returnflag = 'R') + count(*) FILTER (l_linestatus = 'F') AS DOUBLE)
                   / count(*) * 100 AS percentage_fatalities
        FROM lineitem JOIN ({CALENDAR}) ON l_shipdate = date_actual GROUP BY 1""",
    "top5_days_avg": f"""
        SELECT date_actual, sum(l_quantity) / count(*) AS avg_alarms
        FROM lineitem JOIN ({CALENDAR}) ON l_shipdate = date_actual
        GROUP BY 1 ORDER BY avg_alarms DESC, date_actual LIMIT 5""",
    "events_by_weekday_by_day": f"""
        SELECT day_name, count(*) AS incident_count
        FROM events JOIN ({CALENDAR}) ON CAST(ts AS DATE) = date_actual GROUP BY 1""",
    "latest_rows": "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "clean_and_acronym": f"""
        SELECT p_partkey, name, upper(p_brand) AS brand, {_acronym('name')} AS acronym
        FROM (SELECT *, {_clean(f"' ' || {_TAB} || p_name || ' of ' || p_type || chr(10)")} AS name FROM part)""",
    "fill_missing": """
        SELECT o_orderkey, coalesce(c_acctbal, 0) AS c_acctbal, coalesce(c_nationkey, 0) AS c_nationkey,
               c_mktsegment
        FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) ON o_custkey = c_custkey""",
    "normalize_rename": """
        SELECT o_orderkey AS "order", o_custkey AS customer, o_orderstatus AS status, o_totalprice AS price,
               o_orderdate AS placed, o_orderpriority AS priority
        FROM orders""",
    "distinct_pairs": "SELECT DISTINCT p_name, p_brand FROM part",
    "first_row_per_key": """
        SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1""",
    "insert_if_absent_fact": """
        SELECT * FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM lineitem h WHERE h.l_shipdate < TIMESTAMP '1997-01-01'
                          AND h.l_orderkey = l.l_orderkey AND h.l_linenumber = l.l_linenumber)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                     l_linestatus, l_shipdate) = 1""",
    "null_key_insert": """
        WITH keyed AS (
            SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer, o_orderkey, o_totalprice
            FROM orders
        )
        SELECT * FROM keyed WHERE customer IS NULL
        UNION ALL
        SELECT * FROM (
            SELECT * FROM keyed WHERE customer IS NOT NULL
            AND keyed.customer NOT IN (SELECT c_custkey FROM customer c WHERE c_nationkey = 5)
            QUALIFY row_number() OVER (PARTITION BY customer ORDER BY o_orderkey) = 1)""",
    "surrogate_keys": """
        SELECT 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk,
               o_orderdate, o_orderkey, o_totalprice
        FROM orders""",
    "drop_colliding": """
        SELECT * FROM lineitem
        QUALIFY count(*) OVER (PARTITION BY l_orderkey) = 1 AND count(*) OVER (PARTITION BY l_extendedprice) = 1""",
    "repeated_values": """
        SELECT 'l_orderkey' AS field, CAST(l_orderkey AS VARCHAR) AS "value", count(*) AS "count"
        FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
        UNION ALL
        SELECT 'l_partkey', CAST(l_partkey AS VARCHAR), count(*)
        FROM lineitem GROUP BY l_partkey HAVING count(*) > 1""",
    "field_maxima": """
        SELECT max(o_orderkey) AS o_orderkey, max(o_custkey) AS o_custkey, max(o_totalprice) AS o_totalprice
        FROM orders""",
    "constraints": """
        SELECT 'unique' AS "constraint", 'l_orderkey,l_linenumber' AS columns, count(*) AS violations
        FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        UNION ALL
        SELECT 'unique', 'l_orderkey,l_partkey,l_suppkey', count(*)
        FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey HAVING count(*) > 1)
        UNION ALL
        SELECT 'not_null', 'l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
        UNION ALL
        SELECT 'not_null', 'l_tax', count(*) FILTER (l_tax = 0) FROM lineitem""",
    "csv_round_trip": "SELECT *, 'combined_data_20240107_123000.csv' AS snapshot FROM orders",
    "csv_round_trip_text": """
        SELECT * REPLACE (nullif(text, '') AS text), 'combined_data_20240107_123000.csv' AS snapshot
        FROM documents""",
    "append_load": """
        SELECT c_custkey AS account, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
               c_mktsegment AS segment
        FROM customer
        UNION ALL
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier""",
    "latest_of_nothing": """
        SELECT *, CAST(NULL AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS city,
               CAST(NULL AS TIMESTAMP) AS incident_date
        FROM orders""",
    "medallion_load": _STAR,
    "medallion_counts": _COUNTS,
    "medallion_raw": f"SELECT {_RAW}, 'first' AS load_id FROM ({_INCIDENTS})",
    "medallion_marts": f"""
        SELECT CAST(year(incident_date) AS INTEGER) AS year_actual, count(*) AS incident_count,
               CAST(sum(coalesce(suppression_personnel, 0) + ems_personnel + coalesce(other_personnel, 0)) AS DOUBLE)
                   / count(*) AS avg_personnel_response
        FROM ({_INCIDENTS}) GROUP BY 1""",
    "streaming_load": _STAR,
    "streaming_order": _STAR.replace(
        f"WITH incidents AS ({_INCIDENTS})",
        f"""WITH given AS ({_INCIDENTS}),
incidents AS (
    SELECT * REPLACE (
        CASE WHEN incident_date < TIMESTAMP '1998-01-01' THEN incident_number + 1000000000
             ELSE incident_number END AS incident_number,
        CASE WHEN incident_date < TIMESTAMP '1998-01-01' THEN city || 'and more' ELSE city END AS city)
    FROM given
)""",
    ),
    "synthetic_rows": _synthetic(),
    "snapshot_growth": f"""
        WITH incidents AS ({_INCIDENTS}), drawn AS ({_synthetic()})
        SELECT {_COLUMNS} FROM incidents
        UNION ALL
        SELECT {_COLUMNS} FROM (SELECT * FROM drawn QUALIFY {_LONE})""",
    "grown_snapshot": f"""
        WITH incidents AS ({_INCIDENTS}),
        numbers AS (SELECT row_number() OVER () - 1 AS n FROM orders),
        drawn AS ({_synthetic("n", "numbers")})
        SELECT {_COLUMNS} FROM incidents
        UNION ALL
        SELECT {_COLUMNS} FROM (SELECT * FROM drawn QUALIFY {_LONE})""",
}

_LOOKUP = """
    SELECT o_orderkey, c_custkey + 500 AS customer_sk, priority_sk
    FROM orders
    LEFT JOIN (SELECT * FROM customer WHERE c_nationkey <> 7) ON o_orderstatus <> 'F' AND o_custkey = c_custkey
    JOIN (SELECT o_orderpriority AS p, min(o_orderkey) AS priority_sk FROM orders GROUP BY 1) ON o_orderpriority = p"""
ORACLE_SQL |= {"lookup_keys": _LOOKUP, "lookup_keys_hot": _LOOKUP}


_REPEATED = ["l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice"]


def _ranked_repeats(field: str) -> str:
    return f"""(
        SELECT {field}, count(*) AS {field}_count,
               row_number() OVER (ORDER BY count(*) DESC, {field}) AS place
        FROM lineitem GROUP BY {field} HAVING count(*) > 1)"""


_SIDE_BY_SIDE = f"SELECT * EXCLUDE (place) FROM {_ranked_repeats(_REPEATED[0])} " + " ".join(
    f"FULL JOIN {_ranked_repeats(f)} USING (place)" for f in _REPEATED[1:]
)

_FAULTY = """
    WITH given AS (
        SELECT *, o_orderkey AS k,
            CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS key_text,
            CASE WHEN o_orderkey % 7 = 0 THEN 'c' ELSE '' END || o_custkey AS customer_text,
            CASE WHEN o_orderkey % 5 = 0 THEN 'NA' WHEN o_orderkey % 21 = 0 THEN 'much'
                 ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS price_text,
            CASE WHEN o_orderkey % 17 = 0 THEN '1996-02-30 00:00:00'
                 ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS date_text
        FROM orders
    ), lines AS (
        SELECT *, concat_ws(',', key_text, customer_text, o_orderstatus, price_text, date_text,
                            o_orderpriority) AS line,
            k % 11 = 0 OR k % 13 = 0 AS torn
        FROM given
    ), faults AS (
        SELECT k, CASE WHEN k % 11 = 0 THEN line || ',more'
                       ELSE concat_ws(',', key_text, customer_text, o_orderstatus) END AS line,
            CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS "value",
            'malformed line' AS reason
        FROM lines WHERE torn
        UNION ALL
        SELECT k, line, 'o_orderkey', NULL, 'missing value' FROM lines WHERE NOT torn AND k % 101 = 0
        UNION ALL
        SELECT k, line, 'o_custkey', customer_text, 'not a bigint' FROM lines WHERE NOT torn AND k % 7 = 0
        UNION ALL
        SELECT k, line, 'o_totalprice', price_text, 'not a double' FROM lines
        WHERE NOT torn AND price_text = 'much'
        UNION ALL
        SELECT k, line, 'o_orderdate', date_text, 'not a timestamp_ntz' FROM lines
        WHERE NOT torn AND k % 17 = 0
    )"""


def _mart(name: str, place: str, label: str, number: str, value: str) -> str:
    numbers = ["incident_count", "avg_alarms", "total_property_loss", "avg_personnel_response",
               "percentage_fatalities"]
    given = dict(zip(number.split(), value.split(";")))
    columns = ", ".join(
        f"{given.get(n, 'NULL')}::{'BIGINT' if n == 'incident_count' else 'DOUBLE'} AS {n}" for n in numbers
    )
    return f"""
        SELECT '{name}' AS mart, {place} AS place, {label} AS label, {columns}
        FROM days GROUP BY ALL"""


_RESPONSE = "(sum(l_partkey + l_suppkey + l_linenumber)::DOUBLE / count(*))"
_KILLED = (
    "((count(*) FILTER (l_returnflag = 'R') + count(*) FILTER (l_linestatus = 'F'))::DOUBLE / count(*) * 100)"
)
_ALL_MARTS = "WITH days AS (SELECT * FROM lineitem WHERE l_shipdate = CAST(l_shipdate AS DATE))" + (
    " UNION ALL ".join(
        [
            _mart("incidents_by_weekday", "isodow(l_shipdate)::INTEGER", "dayname(l_shipdate)",
                  "incident_count", "count(*)"),
            _mart("average_alarms_by_month", "month(l_shipdate)::INTEGER", "monthname(l_shipdate)",
                  "avg_alarms", "(sum(l_quantity)::DOUBLE / count(*))"),
            _mart("property_loss_by_quarter", "quarter(l_shipdate)::INTEGER",
                  "['First', 'Second', 'Third', 'Fourth'][quarter(l_shipdate)]",
                  "total_property_loss", "sum(CAST(l_extendedprice AS DECIMAL(18, 2)))"),
            _mart("response_by_year", "year(l_shipdate)::INTEGER", "year(l_shipdate)::VARCHAR",
                  "incident_count avg_personnel_response", f"count(*);{_RESPONSE}"),
            _mart("fatality_rate_by_weekend", "(isodow(l_shipdate) > 5)::INTEGER",
                  "(isodow(l_shipdate) > 5)::VARCHAR", "percentage_fatalities", _KILLED),
        ]
    )
)


def _permutation(value: str, count: str, seed: int, name: str) -> str:
    """The permuted number of each row of ``numbered`` (value), for a power of two ``block`` up to ``count``."""
    sql = f"""WITH size AS (
        SELECT {count} AS n, CAST(floor(log2({count})) AS INTEGER) AS width
    ), step0 AS (
        SELECT numbered.*, {value} AS x, n, width, (1::BIGINT << width) AS block, width // 2 AS low
        FROM numbered, size
    )"""
    for step in range(8):
        given = "x & ((1::BIGINT << low) - 1)" if step % 2 else "x >> low"
        free = "(block - 1) - ((1::BIGINT << low) - 1)" if step % 2 else "(1::BIGINT << low) - 1"
        drawn = f"('0x' || substr(md5('{seed}|{name}|{step}|' || ({given})), 1, 15))::BIGINT"
        turned = "(y + n // 3) % n" if step % 2 else "y"
        sql += f""", step{step + 1} AS (
        SELECT * EXCLUDE (x, y), {turned} AS x FROM (
            SELECT *, CASE WHEN x < block THEN xor(x, {drawn} & ({free})) ELSE x END AS y FROM step{step}))"""
    return sql


ORACLE_SQL |= {
    "repeats_laid_side_by_side": _SIDE_BY_SIDE,
    "checked_rows": f"""{_FAULTY}
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN k % 5 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM lines WHERE k NOT IN (SELECT k FROM faults)""",
    "rejected_rows": f"""{_FAULTY}
        SELECT * EXCLUDE (k), (SELECT count(DISTINCT k) FROM faults) AS rejected_lines FROM faults""",
    "marts_in_one_scan": _ALL_MARTS,
    "marts_after_loads": _ALL_MARTS,
    "top_days_after_loads": ORACLE_SQL["top5_days_avg"],
    "bucketed_insert": """
        SELECT *, 0::BIGINT AS gained_again FROM lineitem
        WHERE l_shipdate < TIMESTAMP '1997-01-01'
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ALL_COLUMNS) = 1
        UNION ALL
        SELECT *, 0 FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM lineitem h WHERE h.l_shipdate < TIMESTAMP '1997-01-01'
                          AND h.l_orderkey = l.l_orderkey AND h.l_linenumber = l.l_linenumber)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ALL_COLUMNS) = 1""".replace(
        "ALL_COLUMNS",
        "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate",
    ),
    "keys_without_collisions": _permutation("rn - 1", "(SELECT count(*) FROM orders)", 7, "id").replace(
        "WITH size", "WITH numbered AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders), size", 1
    )
    + " SELECT o_orderkey, x + 1 + (SELECT max(o_orderkey) FROM orders) AS id FROM step8",
    "streaming_insert": """
        SELECT o_custkey AS customer, o_orderkey, o_orderdate FROM orders
        WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 5)
        QUALIFY row_number() OVER (PARTITION BY o_custkey
            ORDER BY (o_orderdate < TIMESTAMP '1996-01-01')::INTEGER, o_orderkey) = 1""",
    "sql_functions": f"""
        SELECT {_clean("p_name")} AS what, {_acronym("p_name")} AS short, count(*) AS things
        FROM part GROUP BY ALL
        UNION ALL
        SELECT dayname(d), ['First', 'Second', 'Third', 'Fourth'][quarter(d)], count(o_orderkey)
        FROM (SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '1992-01-01' + 2556, INTERVAL 1 DAY)) AS DATE) AS d)
        LEFT JOIN orders ON o_orderdate = d GROUP BY ALL""",
}
ORACLE_SQL["incident_source"] = f"""
    WITH numbers AS (SELECT row_number() OVER () - 1 AS n FROM orders)
    SELECT {_COLUMNS} FROM ({_synthetic("n", "numbers")})"""
ORACLE_SQL["latest_of_many_snapshots"] = """
    SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year,
           year(o_orderdate) || '/orders_of_' || year(o_orderdate) || '.csv' AS snapshot
    FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)"""
