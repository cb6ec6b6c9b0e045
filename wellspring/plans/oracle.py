"""DuckDB oracle SQL, one statement per registered query (same column names)."""

from __future__ import annotations

from ..functions.geo import utm_to_lonlat_sql

ORACLE: dict[str, str] = {}


def replaced(sql: str, *changes: tuple[str, str]) -> str:
    """``sql`` with each old text replaced; an old text that it lacks is an error, not a statement left as it was."""
    for old, new in changes:
        if old not in sql:
            raise ValueError(f"not in the statement: {old!r}")
        sql = sql.replace(old, new)
    return sql


ORACLE["sensor_stats"] = """
SELECT user_id AS sensor_id, event_type AS parameter,
       min(ts) AS datetime_min, max(ts) AS datetime_max,
       round(min(value), 6) AS "min",
       round(quantile_cont(value, 0.1), 6) AS q10,
       round(avg(value), 6) AS mean,
       round(quantile_cont(value, 0.5), 6) AS median,
       round(quantile_cont(value, 0.9), 6) AS q90,
       round(max(value), 6) AS "max",
       count(*) AS number_of_samples,
       row_number() OVER (ORDER BY user_id, event_type) AS rn
FROM events GROUP BY user_id, event_type
"""

ORACLE["overall_period"] = """
SELECT min(ts) AS datetime_min, max(ts) AS datetime_max, count(*) AS number_of_samples FROM events
"""

ORACLE["sensor_long"] = """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS parameter, l_quantity AS messwert FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'l_extendedprice' AS parameter, l_extendedprice AS messwert FROM lineitem
"""

ORACLE["since_installation"] = """
SELECT event_id, user_id AS sensor_id, event_type AS parameter,
       ts - INTERVAL 1 HOUR AS datum_uhrzeit, value AS messwert
FROM events WHERE ts - INTERVAL 1 HOUR >= TIMESTAMP '2024-01-15 00:00:00'
"""

ORACLE["null_implausible"] = """
SELECT event_id, event_type AS parameter,
       CASE WHEN event_type = 'purchase' AND value > 250 THEN NULL ELSE value END AS messwert
FROM events
"""

_WELL = """
WITH w AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS bwb_datum, c_nationkey AS well, o_totalprice AS menge
  FROM orders LEFT JOIN customer ON o_custkey IS NOT DISTINCT FROM c_custkey)
"""

ORACLE["well_daily"] = _WELL + """
SELECT CAST(bwb_datum AS TIMESTAMP) AS bwb_datum, CAST(well AS DOUBLE) AS well, count(*) AS n,
       round(coalesce(sum(menge), 0), 6) AS volume
FROM w GROUP BY bwb_datum, well
"""

_BOTH = _WELL + """
, d AS (
  SELECT bwb_datum, well, count(*) AS n, coalesce(sum(menge), 0) AS volume,
         grouping(well) = 1 AS is_field
  FROM w GROUP BY GROUPING SETS ((bwb_datum, well), (bwb_datum)))
"""

ORACLE["field_daily"] = _BOTH + """
SELECT CAST(bwb_datum AS TIMESTAMP) AS bwb_datum, CAST(well AS DOUBLE) AS well, n,
       round(volume, 6) AS volume, is_field FROM d
"""

ORACLE["rolling_7_10"] = _BOTH + """
SELECT is_field, CAST(well AS DOUBLE) AS well, CAST(bwb_datum AS TIMESTAMP) AS bwb_datum,
  round(volume, 6) AS volume,
  round(CASE WHEN count(*) OVER w7 = 7 AND count(volume) OVER w7 = 7 THEN avg(volume) OVER w7 END, 6) AS roll_7,
  round(CASE WHEN count(*) OVER w10 = 10 AND count(volume) OVER w10 = 10 THEN avg(volume) OVER w10 END, 6) AS roll_10
FROM d
WINDOW w7 AS (PARTITION BY is_field, well ORDER BY bwb_datum ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w10 AS (PARTITION BY is_field, well ORDER BY bwb_datum ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
"""

ORACLE["meta_join"] = """
SELECT s.*, n.n_name, n.n_regionkey
FROM supplier s LEFT JOIN nation n ON s.s_nationkey IS NOT DISTINCT FROM n.n_nationkey
"""

ORACLE["file_join"] = """
SELECT o_orderkey, o_custkey, c_nationkey, c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey IS NOT DISTINCT FROM c_custkey
"""

ORACLE["natural_join"] = """
SELECT l.orderkey, l.l_linenumber, l.l_quantity, o.o_orderpriority, o.o_orderstatus
FROM (SELECT l_orderkey AS orderkey, l_linenumber, l_quantity FROM lineitem) l
LEFT JOIN (SELECT o_orderkey AS orderkey, o_orderpriority, o_orderstatus FROM orders) o
  ON l.orderkey IS NOT DISTINCT FROM o.orderkey
"""

ORACLE["map_parameters"] = """
WITH lp AS (SELECT CAST(p_partkey AS VARCHAR) AS VariableName_org,
                   CASE WHEN p_size <= 25 THEN p_size END AS para_id FROM part),
     pm AS (SELECT DISTINCT p_size AS para_id, 'size_' || CAST(p_size AS VARCHAR) AS para_kurzname FROM part),
     lk AS (SELECT lp.VariableName_org, lp.para_id, pm.para_kurzname
            FROM lp LEFT JOIN pm ON lp.para_id IS NOT DISTINCT FROM pm.para_id
            WHERE lp.para_id IS NOT NULL)
SELECT l_orderkey, l_linenumber, lk.VariableName_org, lk.para_id, lk.para_kurzname
FROM lineitem JOIN lk ON CAST(l_partkey AS VARCHAR) = lk.VariableName_org
"""

ORACLE["unmapped_template"] = """
SELECT VariableName_org, CAST(NULL AS VARCHAR) AS para_id,
       row_number() OVER (ORDER BY VariableName_org) AS rn
FROM (SELECT DISTINCT l_returnflag || '-' || l_linestatus AS VariableName_org FROM lineitem)
"""

ORACLE["yearly_mean_abstraction"] = _WELL + """
, m AS (SELECT s_nationkey AS werk, year(l_shipdate) AS "year", avg(l_extendedprice) AS mean_value
        FROM lineitem LEFT JOIN supplier ON l_suppkey IS NOT DISTINCT FROM s_suppkey
        GROUP BY 1, 2),
  v AS (SELECT well AS werk, year(bwb_datum) AS "year", sum(menge) AS foerdermenge FROM w GROUP BY 1, 2)
SELECT m.werk, m."year", round(m.mean_value, 6) AS mean_value, round(v.foerdermenge, 6) AS foerdermenge
FROM m LEFT JOIN v ON m.werk IS NOT DISTINCT FROM v.werk AND m."year" IS NOT DISTINCT FROM v."year"
"""

ORACLE["sampling_stats"] = """
WITH j AS (SELECT o_orderpriority, c_nationkey, CAST(o_orderdate AS DATE) AS d
           FROM orders LEFT JOIN customer ON o_custkey IS NOT DISTINCT FROM c_custkey)
SELECT o_orderpriority, c_nationkey, CAST(min(d) AS TIMESTAMP) AS date_min, CAST(max(d) AS TIMESTAMP) AS date_max,
       count(*) AS number_of_samples,
       CAST(date_diff('day', min(d), max(d)) AS BIGINT) AS period_days,
       CAST(round_even(date_diff('day', min(d), max(d)) / count(*), 0) AS DOUBLE) AS mean_sampling_interval_days
FROM j GROUP BY o_orderpriority, c_nationkey
"""

ORACLE["new_files"] = """
SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'
EXCEPT
SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A'
"""

ORACLE["union_fill"] = """
SELECT c_custkey AS "key", c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment, 'customer' AS source FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS "key", s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       'supplier' AS source FROM supplier
"""

ORACLE["remap_synonyms"] = """
SELECT d.doc_id, d.lang,
       coalesce(l.quality, CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END) AS quality,
       coalesce(l.toxic, CASE WHEN d.lang = 'en' THEN 0 ELSE 1 END) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id IS NOT DISTINCT FROM l.doc_id
"""

ORACLE["duplicates"] = """
SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
"""

ORACLE["duplicate_marks"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) > 1 AS is_duplicate
FROM lineitem
"""

ORACLE["distinct_keys"] = "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer"

ORACLE["latest_rows"] = """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
"""

ORACLE["labels_units"] = """
SELECT p_type, count(DISTINCT p_brand) AS n_brands,
       string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands
FROM part WHERE p_brand IS NOT NULL GROUP BY p_type
"""

ORACLE["projection"] = """
SELECT 'lab_A' AS labor, 'crew_1' AS probenahme, l_orderkey AS item_orderkey, l_partkey AS item_part,
       l_quantity AS item_quantity, l_extendedprice AS item_extendedprice, l_discount AS item_discount
FROM lineitem
"""

ORACLE["predicates"] = """
SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority FROM orders
WHERE NOT coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false)
  AND o_totalprice < 300000
  AND NOT regexp_matches(o_orderstatus, 'P')
  AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'
"""

ORACLE["german_csv"] = """
SELECT o_orderkey, replace(printf('%.2f', o_totalprice), '.', ',') AS totalprice_de FROM orders
"""

ORACLE["period_label"] = """
SELECT event_type AS parameter,
       strftime(min(ts) + INTERVAL 1 HOUR, '%Y%m%d-%H%M%S') || 'TZ+01' AS period_start,
       strftime(max(ts) + INTERVAL 1 HOUR, '%Y%m%d-%H%M%S') || 'TZ+01' AS period_end
FROM events GROUP BY event_type
"""

ORACLE["utc_text"] = r"""
WITH t AS (
  SELECT event_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_type = 'error' THEN '' ELSE 'Z' END AS utc_text
  FROM events)
SELECT event_id, utc_text,
       CASE WHEN regexp_matches(utc_text, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$')
            THEN strptime(utc_text, '%Y-%m-%dT%H:%M:%SZ') END AS datum_uhrzeit,
       coalesce(regexp_matches(utc_text, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$'), false) AS is_valid
FROM t
"""

ORACLE["numbers"] = r"""
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'F' THEN printf('%.2f', o_totalprice)
              WHEN o_orderstatus = 'O' THEN printf('%.2f', o_totalprice) || 'd'
              WHEN o_orderpriority = '5-LOW' THEN 'NaN'
              ELSE ' ' || printf('%.2f', o_totalprice) || ' ' END AS txt
  FROM orders)
SELECT o_orderkey, txt,
       CASE WHEN regexp_matches(txt, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')
            THEN TRY_CAST(trim(txt) AS DOUBLE) END AS number
FROM t
"""

ORACLE["first_date"] = """
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d.%m.%Y') END AS datum_text,
         CASE WHEN year(o_orderdate) < 2000 THEN strftime(o_orderdate, '%y/%m/%d') END AS survey_text
  FROM orders)
SELECT o_orderkey, datum_text, survey_text,
       CAST(coalesce(CAST(try_strptime(datum_text, '%d.%m.%Y') AS DATE),
                     CAST(try_strptime('19' || survey_text, '%Y/%m/%d') AS DATE)) AS TIMESTAMP) AS datum,
       CAST(year(coalesce(CAST(try_strptime(datum_text, '%d.%m.%Y') AS DATE),
                          CAST(try_strptime('19' || survey_text, '%Y/%m/%d') AS DATE))) AS DOUBLE) AS "year"
FROM t
"""

ORACLE["clean_rows"] = """
WITH raw AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 1 THEN 'Datum'
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS datum,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'O' THEN '' ELSE l_returnflag END AS comment,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS qty
  FROM lineitem)
SELECT * FROM raw
WHERE NOT (datum IS NULL AND comment IS NULL AND qty IS NULL)
  AND datum <> 'Datum'
  AND coalesce(length(comment), 0) > 0
  AND qty IS NOT NULL
"""

_LON, _LAT = utm_to_lonlat_sql("easting", "northing")
ORACLE["utm_to_wgs84"] = f"""
WITH s AS (SELECT s_suppkey, 350000.0 + s_acctbal * 20 AS easting,
                  5750000.0 + s_nationkey * 2000.0 + s_suppkey AS northing FROM supplier)
SELECT s_suppkey, round({_LON}, 7) AS lon, round({_LAT}, 7) AS lat FROM s
"""
