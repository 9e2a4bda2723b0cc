"""The same results in SQL, written by hand for a second engine."""

from __future__ import annotations

import zlib

_BALANCES = """(SELECT *, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer)"""

_LINE_ORDER = "lineitem l INNER JOIN orders o ON l.l_orderkey = o.o_orderkey"

_ORDER_TEXTS = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d,
       CAST(o_orderkey * 1000000 AS VARCHAR) AS big,
       CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'n' END AS flag, ' ' AS blank
FROM orders"""

# Types inferred from a relation "s" of (column_name, v).
_INFER = """
t AS (SELECT column_name, trim(v) AS v FROM s),
n AS (SELECT DISTINCT column_name FROM s),
a AS (
  SELECT column_name,
    bool_and(lower(v) IN ('true','false','1','0','yes','no','y','n')) AS b,
    bool_and(regexp_full_match(v, '-?[0-9]+')) AS i,
    bool_and(regexp_full_match(v, '-?[0-9]+(\\.[0-9]+)?')) AS d,
    bool_and(regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}')) AS d1,
    bool_and(regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}')) AS t1,
    min(TRY_CAST(v AS BIGINT)) AS lo, max(TRY_CAST(v AS BIGINT)) AS hi, max(length(v)) AS len
  FROM t WHERE v <> '' GROUP BY 1)
SELECT n.column_name, CASE WHEN a.len IS NULL THEN 'TEXT' WHEN b THEN 'BOOLEAN'
  WHEN i AND lo >= -2147483648 AND hi <= 2147483647 THEN 'INTEGER' WHEN i THEN 'BIGINT'
  WHEN d THEN 'DECIMAL' WHEN d1 THEN 'DATE' WHEN t1 THEN 'TIMESTAMP'
  WHEN len <= 50 THEN 'VARCHAR(50)' WHEN len <= 100 THEN 'VARCHAR(100)'
  WHEN len <= 255 THEN 'VARCHAR(255)' WHEN len <= 500 THEN 'VARCHAR(500)' ELSE 'TEXT' END AS inferred
FROM n LEFT JOIN a USING (column_name)"""

_SQLSERVER_NAMES = """['int', 'bigint', 'smallint', 'tinyint', 'decimal', 'numeric', 'money',
 'smallmoney', 'float', 'real', 'bit', 'char', 'nchar', 'varchar', 'nvarchar', 'text', 'ntext',
 'sysname', 'xml', 'binary', 'varbinary', 'image', 'rowversion', 'timestamp', 'uniqueidentifier',
 'sql_variant', 'date', 'time', 'datetime', 'smalldatetime', 'datetime2', 'datetimeoffset',
 'geometry', 'geography', 'hierarchyid', 'VARCHAR', 'cursor']"""
_POSTGRES_NAMES = """['smallint', 'integer', 'bigint', 'numeric', 'decimal', 'real',
 'double precision', 'smallserial', 'serial', 'bigserial', 'money', 'character varying', 'varchar',
 'character', 'char', 'text', 'citext', 'boolean', 'bool', 'date', 'time',
 'time without time zone', 'time with time zone', 'timestamp', 'timestamp without time zone',
 'timestamp with time zone', 'interval', 'json', 'jsonb', 'uuid', 'USER-DEFINED', 'point', 'bytea']"""
_POSTGRES_DECLARED = "['numeric(', 'character varying(', 'timestamp(', 'bit(', 'time (', 'uuid(']"

# The given tables: columns in order, each with the first letter of its type name.
_TABLES = {
    "region": "r_regionkey:n r_name:s",
    "nation": "n_nationkey:n n_name:s n_regionkey:n",
    "customer": "c_custkey:n c_name:s c_nationkey:n c_acctbal:n c_mktsegment:s",
    "supplier": "s_suppkey:n s_name:s s_nationkey:n s_acctbal:n",
    "part": "p_partkey:n p_name:s p_brand:s p_type:s p_size:n p_retailprice:n",
    "orders": "o_orderkey:n o_custkey:n o_orderstatus:s o_totalprice:n o_orderdate:D "
    "o_orderpriority:s",
    "lineitem": "l_orderkey:n l_partkey:n l_suppkey:n l_linenumber:n l_quantity:n "
    "l_extendedprice:n l_discount:n l_tax:n l_returnflag:s l_linestatus:s l_shipdate:D",
    "events": "event_id:n ts:D user_id:n event_type:s value:n props:s",
    "documents": "doc_id:n text:s lang:s source:s n_chars:n",
    "embeddings": "vec_id:n embedding:a label:n",
    "pages": "page_id:n url:s html:s",
    "benchmark": "item_id:n text:s",
    "labels": "doc_id:n quality:n toxic:n",
    "conversations": "conv_id:n turn:n role:s text:s",
}
_KINDS = {"n": "number", "s": "string", "D": "Date", "a": "number[]"}


def _described() -> str:
    """One row per column of each table; text columns with their greatest length."""
    rows = []
    for table, columns in _TABLES.items():
        for position, entry in enumerate(columns.split(), 1):
            name, kind = entry.split(":")
            length = f"(SELECT max(length({name})) FROM {table})" if kind == "s" else "NULL"
            rows.append(
                f"SELECT '{table}' AS table_name, {position} AS position, '{name}' AS name, "
                f"'{_KINDS[kind]}' AS type, CAST({length} AS INTEGER) AS length"
            )
    return " UNION ALL ".join(rows)


def _stats(table: str, texts: dict[str, str]) -> str:
    """Counts and ends of columns, each with the text form of its values."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) - count({name}) AS nulls, "
        f"count(DISTINCT {name}) AS distincts, {text.format(f'min({name})')} AS lo, "
        f"{text.format(f'max({name})')} AS hi FROM {table}"
        for name, text in texts.items()
    )


ORDER_STATS = {
    "o_orderkey": "CAST({} AS VARCHAR)",
    "o_custkey": "CAST({} AS VARCHAR)",
    "o_orderstatus": "{}",
    "o_totalprice": "CAST({} AS VARCHAR)",
    "o_orderdate": "strftime({}, '%Y-%m-%d %H:%M:%S')",
    "o_orderpriority": "{}",
}

ORACLES = {
    "scan_full": "SELECT * FROM supplier",
    "scan_split_counts": """
WITH b AS (SELECT min(o_orderkey) lo, max(o_orderkey) hi FROM orders)
SELECT CAST(least(3, (o_orderkey - lo) * 4 // (hi - lo + 1)) AS BIGINT) AS split, count(*) AS n
FROM orders, b GROUP BY 1""",
    "scan_batches": "SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem",
    "page_filtered_text": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'F' ORDER BY orders.o_orderkey LIMIT 50 OFFSET 100""",
    "page_raw": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100",
    "page_deep": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 12000",
    "page_next": """
SELECT * FROM orders WHERE o_custkey > 700 OR (o_custkey = 700 AND o_orderkey > 0)
ORDER BY o_custkey, o_orderkey LIMIT 50""",
    "page_walk": """
WITH r AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS nation, c_custkey FROM customer)
SELECT nation, c_custkey, 'offset' AS how FROM r UNION ALL SELECT nation, c_custkey, 'after' FROM r""",
    "page_walk_filtered": """
WITH r AS (SELECT o_orderkey, o_custkey, o_orderstatus,
    row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS place, count(*) OVER () // 6 + 1 AS size
  FROM orders WHERE o_orderstatus IN ('F', 'P'))
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(place // size AS INTEGER) AS page FROM r""",
    "reload_versions": """
SELECT CAST(step AS BIGINT) AS step, o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM orders JOIN (VALUES (1, 'F'), (2, 'O'), (3, 'P'), (4, 'F')) v(step, status) ON o_orderstatus = status
GROUP BY step, o_orderstatus""",
    "preview": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus LIMIT 100",
    "count_filtered": """
SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000""",
    "min_max_date": """
SELECT min(o_orderdate) AS min_val, max(o_orderdate) AS max_val FROM orders
WHERE o_orderdate IS NOT NULL""",
    # filter payloads
    "f_contains": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'",
    "f_not_contains": "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE '%ring%'",
    "f_starts_with": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'",
    "f_ends_with": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt'",
    "f_contains_wildcard": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%r_d%'",
    "f_matches": """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red|blue) .*t$')""",
    "f_not_matches": """
SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, '^(red|blue) .*t$')""",
    "f_matches_class": """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^[a-z]{3} [^ ]+t$')""",
    "f_matches_lines": """
SELECT doc_id FROM documents WHERE regexp_matches(text, '[.].\\p{Lu}[a-z]+.$', 's')""",
    "f_eq": "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'",
    "f_ne": "SELECT o_orderkey FROM orders WHERE o_orderpriority != '1-URGENT'",
    "f_gt": "SELECT o_orderkey FROM orders WHERE o_totalprice > 400000",
    "f_lt": "SELECT o_orderkey FROM orders WHERE o_totalprice < 50000",
    "f_ge": "SELECT p_partkey FROM part WHERE p_size >= 40",
    "f_le": "SELECT p_partkey FROM part WHERE p_size <= 5",
    "f_between": "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20",
    "f_not_between": "SELECT p_partkey, p_size FROM part WHERE p_size NOT BETWEEN 10 AND 20",
    "f_in": """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "f_not_in": """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""",
    "f_is_null": f"SELECT c_custkey FROM {_BALANCES} WHERE bal IS NULL",
    "f_is_not_null": f"SELECT c_custkey FROM {_BALANCES} WHERE bal IS NOT NULL",
    "f_skip_invalid": "SELECT p_partkey FROM part WHERE p_size > 45",
    # query specs
    "sel_star": "SELECT * FROM customer",
    "sel_alias": "SELECT c_custkey AS customer_id, c_name AS full_name FROM customer",
    "sel_array_text": r"""
SELECT doc_id, '{' || array_to_string(list_transform(string_split(source, 'c'), lambda x: CASE
    WHEN x = '' THEN '""' ELSE x END), ',') || '}' AS parts,
  '{' || array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE
    WHEN x = '' OR upper(x) = 'NULL' OR regexp_matches(x, '[{},"\\\s]')
    THEN '"' || replace(replace(x, '\', '\\'), '"', '\"') || '"' ELSE x END), ',') || '}' AS lines
FROM documents""",
    "w_list_contains": """
SELECT doc FROM (SELECT doc_id AS doc, string_split(source, 'c') AS parts FROM documents)
WHERE '7' = ANY(parts)""",
    "w_list_not_contains": """
SELECT doc FROM (SELECT doc_id AS doc, string_split(source, 'c') AS parts FROM documents)
WHERE NOT ('7' = ANY(parts))""",
    "w_and_or_precedence": """
SELECT o_orderkey FROM orders
WHERE o_orderstatus = 'F' OR o_orderstatus = 'O' AND o_totalprice > 400000""",
    "w_inverted": f"SELECT c_custkey FROM {_BALANCES} WHERE NOT (bal > 5000)",
    "w_in_number": """
SELECT p_partkey FROM part
WHERE p_size IN (3, 5, 8) AND p_brand NOT IN ('Brand#1', 'Brand#2')""",
    "w_like": """
SELECT p_partkey FROM part WHERE p_name LIKE '%g' AND p_brand LIKE 'Brand%'
AND p_brand NOT LIKE '%#1%' OR p_name LIKE '%et%'""",
    "w_regex": """
SELECT p_partkey FROM part
WHERE regexp_matches(p_brand, '^Brand#[1-3]$') AND NOT regexp_matches(p_name, '[gt]$')""",
    "w_null": f"""
SELECT c_custkey FROM {_BALANCES} WHERE bal IS NULL OR bal IS NOT NULL AND c_nationkey < 5""",
    "w_dates": """
SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN '1996-02-01' AND '1996-04-30'
AND o_orderdate != '1996-03-01 00:00:00'""",
    "w_column_compare": f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate FROM {_LINE_ORDER}
WHERE l.l_shipdate < o.o_orderdate""",
    "w_column_arith": """
SELECT o.o_orderkey, c.c_custkey FROM orders o INNER JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_totalprice - c.c_acctbal > 400000""",
    "w_date_year_diff": f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey FROM {_LINE_ORDER}
WHERE (year(l.l_shipdate) - year(o.o_orderdate)) >= 5""",
    "w_date_month_diff": f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey FROM {_LINE_ORDER}
WHERE ((year(l.l_shipdate) - year(o.o_orderdate)) * 12
       + (month(l.l_shipdate) - month(o.o_orderdate))) = 2""",
    "w_date_day_diff": f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey FROM {_LINE_ORDER}
WHERE (CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) = 7""",
    "j_inner": """
SELECT o.o_orderkey, c.c_name FROM orders o INNER JOIN customer c ON o.o_custkey = c.c_custkey""",
    "j_left": """
SELECT c.c_custkey, s.s_suppkey FROM customer c LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey""",
    "j_right": """
SELECT s.s_suppkey, c.c_custkey FROM supplier s RIGHT JOIN customer c ON s.s_suppkey = c.c_custkey""",
    "j_theta": """
SELECT s.s_suppkey, n.n_nationkey FROM supplier s
INNER JOIN nation n ON s.s_nationkey > n.n_nationkey""",
    "j_theta_large": """
SELECT e.event_id, o.o_orderkey FROM events e JOIN orders o
ON o.o_orderkey BETWEEN e.event_id * 3 AND e.event_id * 3 + 2 WHERE e.event_id % 7 <> 0""",
    "j_theta_left": """
SELECT e.event_id, o.o_orderkey FROM events e LEFT JOIN orders o
ON o.o_orderkey BETWEEN e.event_id * 3 AND e.event_id * 3 + 2 AND e.event_id % 7 <> 0""",
    "j_theta_mixed": """
SELECT o.o_orderkey, l.l_orderkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "j_compound_and": """
SELECT o.o_orderkey, l.l_linenumber, l.l_partkey FROM orders o
INNER JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND o.o_orderdate < l.l_shipdate""",
    "j_compound_or": """
SELECT o.o_orderkey, c.c_custkey FROM orders o
INNER JOIN customer c ON o.o_custkey = c.c_custkey OR o.o_orderkey = c.c_custkey""",
    "j_left_or": """
SELECT o.o_orderkey, s.s_suppkey FROM orders o
LEFT JOIN supplier s ON o.o_custkey = s.s_suppkey OR o.o_orderkey = s.s_suppkey""",
    "j_right_chain": """
SELECT p.p_brand, count(l.l_orderkey) AS lines, count(DISTINCT o.o_custkey) AS buyers
FROM lineitem l INNER JOIN orders o ON l.l_orderkey = o.o_orderkey
RIGHT JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_brand""",
    "j_star": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_orderpriority, s.s_name FROM lineitem l
INNER JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN supplier s ON l.l_partkey = s.s_suppkey WHERE l.l_quantity > 45""",
    "a_count_col": f"SELECT c_mktsegment, count(bal) AS n FROM {_BALANCES} GROUP BY c_mktsegment",
    "a_count_all": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "a_count_distinct": """
SELECT o_orderstatus, count(DISTINCT o_custkey) AS n FROM orders GROUP BY o_orderstatus""",
    "a_distinct": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "a_sum": """
SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority""",
    "a_avg": """
SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY o_orderpriority""",
    "a_min_max": """
SELECT o_orderpriority, min(o_totalprice) AS lo, max(o_orderdate) AS hi FROM orders
GROUP BY o_orderpriority""",
    "a_global": "SELECT count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem",
    "a_global_having": """
SELECT count(*) AS n FROM orders HAVING count(*) > 10 AND max(o_totalprice) > 1000""",
    "a_having_hidden": """
SELECT o_custkey FROM orders GROUP BY o_custkey
HAVING count(*) > 15 AND sum(o_totalprice) > 4000000""",
    "a_having_count_distinct": """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey
HAVING count(DISTINCT o_orderpriority) >= 5 OR count(*) BETWEEN 1 AND 3""",
    "flagship_spec": """
SELECT p.p_brand, count(*) AS n, count(DISTINCT o.o_custkey) AS buyers,
       round(sum(l.l_extendedprice), 2) AS revenue
FROM lineitem l INNER JOIN orders o ON l.l_orderkey = o.o_orderkey
INNER JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_orderstatus = 'F' AND p.p_size BETWEEN 5 AND 40
GROUP BY p.p_brand HAVING count(*) > 100""",
    # change data capture
    "delta_latest": """
SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-29'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""",
    "delta_composite": """
SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15'
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1""",
    "delta_ties": """
WITH log AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS op_date FROM events)
SELECT * FROM log a WHERE a.op_date > DATE '2024-01-15' AND a.op_date = (
  SELECT max(b.op_date) FROM log b
  WHERE b.user_id = a.user_id AND b.op_date > DATE '2024-01-15')""",
    "delta_page": """
SELECT * FROM (SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
ORDER BY user_id LIMIT 20 OFFSET 40""",
    "delta_snapshot_page": """
SELECT * FROM (SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
ORDER BY user_id LIMIT 20 OFFSET 40""",
    "delta_stream": """
SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""",
    "delta_merged": """
WITH late AS (SELECT * FROM events WHERE event_id % 3 IN (1, 2)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1),
stream AS (SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
SELECT *, 'late' AS how FROM late WHERE event_type <> 'error'
UNION ALL SELECT *, 'stream' FROM stream WHERE event_type <> 'error'""",
    # targets
    "part_range_year": """
SELECT CASE WHEN o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01' THEN '1996'
            WHEN o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01' THEN '1997'
            ELSE 'default' END AS part, count(*) AS n FROM orders GROUP BY 1""",
    "part_range_month": """
SELECT CASE WHEN o_orderdate >= DATE '1996-12-01' AND o_orderdate < DATE '1997-01-01' THEN '1996_12'
            WHEN o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1997-02-01' THEN '1997_01'
            ELSE 'default' END AS part, count(*) AS n FROM orders GROUP BY 1""",
    "part_list": """
SELECT coalesce(CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus END, 'default') AS part,
       count(*) AS n FROM orders GROUP BY 1""",
    "part_list_odd": f"""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'a-b'
  WHEN o_orderstatus = 'O' THEN 'a_b' ELSE 'default' END AS odd FROM orders)
SELECT o_orderkey, odd, CASE odd WHEN 'a-b' THEN 'a_b' WHEN 'a_b' THEN 'a_b_{zlib.crc32(b"a_b"):08x}'
  WHEN 'default' THEN 'default_{zlib.crc32(b"default"):08x}' ELSE 'default' END AS part FROM r""",
    "part_range_read": """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= DATE '1996-11-15' AND o_orderdate < DATE '1997-02-01'""",
    "part_hash_roundtrip": "SELECT o_orderkey, o_custkey FROM orders",
    "key_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "load_violations": """
WITH b AS (SELECT CAST(floor(event_id * 1.5) AS BIGINT) AS number, count(*) AS in_batch FROM events GROUP BY 1),
t AS (SELECT o_orderkey AS number, count(*) AS n FROM orders GROUP BY 1)
SELECT number, in_batch, coalesce(n, 0) AS in_target FROM b LEFT JOIN t USING (number) WHERE in_batch > 1 OR n > 0""",
    "unique_index_violations": """
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer
WHERE c_mktsegment IS NOT NULL AND c_nationkey IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
    "column_stats": _stats("orders", ORDER_STATS),
    "column_stats_loads": "WITH s AS ("
    + _stats("orders", ORDER_STATS)
    + """)
SELECT column_name, (SELECT count(*) FROM orders) AS rows, nulls, lo, hi, true AS distincts_near,
       CASE WHEN column_name = 'o_totalprice' THEN true END AS middle_near FROM s""",
    "layout_curve": """
SELECT layout, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS by_date, layout = 'curve' AS by_customer
FROM orders, (VALUES ('sorted'), ('curve')) v(layout) GROUP BY layout""",
    "layout_roundtrip": "SELECT * FROM orders",
    "layout_order": """
SELECT count(*) AS n, CAST(0 AS BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS overlaps FROM orders""",
    "reload_roundtrip": "SELECT * FROM customer",
    "truncate_and_reload": """
SELECT c_custkey, c_name, CAST(0 AS BIGINT) AS left_after_truncate FROM customer WHERE c_custkey % 2 = 0""",
    "create_table_insert": "SELECT c_custkey AS id, c_name AS name, 'n/a' AS note FROM customer",
    # schemas and types
    "infer_types": f"""
WITH texts AS ({_ORDER_TEXTS}),
s AS (SELECT name AS column_name, value AS v FROM (UNPIVOT texts ON COLUMNS(*) INTO NAME name VALUE value)),
{_INFER}""",
    "infer_document_types": f"""
WITH s AS (SELECT 'doc_id' AS column_name, CAST(doc_id AS VARCHAR) AS v FROM documents
  UNION ALL SELECT 'text', text FROM documents UNION ALL SELECT 'lang', lang FROM documents
  UNION ALL SELECT 'source', source FROM documents
  UNION ALL SELECT 'n_chars', CAST(n_chars AS VARCHAR) FROM documents),
{_INFER}""",
    "apply_types": """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""",
    "rejected_values": f"""
WITH t AS ({_ORDER_TEXTS})
SELECT 'o_orderkey' AS column_name, 'INTEGER' AS type,
       count(*) FILTER (TRY_CAST(o_orderkey AS INTEGER) IS NULL) AS rejected FROM t
UNION ALL SELECT 'o_orderstatus', 'INTEGER',
       count(*) FILTER (TRY_CAST(o_orderstatus AS INTEGER) IS NULL) FROM t
UNION ALL SELECT 'big', 'INTEGER', count(*) FILTER (TRY_CAST(big AS INTEGER) IS NULL) FROM t
UNION ALL SELECT 'd', 'DATE', count(*) FILTER (TRY_CAST(d AS DATE) IS NULL) FROM t""",
    "stringify": """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts, CAST(user_id AS VARCHAR) AS user_id,
       event_type, CAST(value AS VARCHAR) AS value, props FROM events""",
    "stringify_lists": r"""
WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, string_split(source, 'c') AS parts,
  string_split(text, chr(10)) AS lines FROM documents)
SELECT doc_id, '[' || array_to_string(list_transform(parts, lambda x: '''' || x || ''''), ', ')
    || ']' AS parts,
  '[' || array_to_string(list_transform(list_transform(lines, lambda x:
      replace(replace(replace(x, '\', '\\'), chr(13), '\r'), chr(9), '\t')), lambda x: CASE
      WHEN contains(x, '''') AND NOT contains(x, '"') THEN '"' || x || '"'
      ELSE '''' || replace(x, '''', '\''') || '''' END), ', ') || ']' AS lines
FROM d""",
    "apply_inferred_orders": """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d,
       o_orderkey * 1000000 AS big, o_orderstatus = 'F' AS flag FROM orders""",
    "apply_inferred_rejects": """
SELECT CAST(doc_id AS INTEGER) AS id, text,
       '1234567890123' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS large,
       CASE WHEN doc_id % 2 = 0 THEN '13/02/2024' ELSE '02/13/2024' END AS day,
       CAST(n_chars AS VARCHAR) || '.1234567890123456789012' AS fine FROM documents""",
    "bytes_as_text": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS body FROM documents",
    "dedupe_columns": "SELECT c_custkey, c_name FROM customer",
    "list_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}"
        for name in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
        )
    ),
    "describe_columns": _described(),
    "schema_sqlserver": f"""
WITH c AS (
  SELECT p_brand AS table_name, CAST(p_partkey AS INTEGER) AS position,
    CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name,
    ({_SQLSERVER_NAMES})[p_partkey % 37 + 1] AS data_type,
    CASE WHEN p_size % 5 = 0 THEN -1 ELSE p_size END AS length,
    CASE WHEN p_partkey % 3 = 0 THEN 'NO' ELSE 'YES' END AS nullable,
    CASE WHEN p_partkey % 4 = 0 THEN '((0))' END AS "default"
  FROM part
  QUALIFY row_number() OVER (PARTITION BY p_brand, lower(p_name) ORDER BY p_partkey) = 1)
SELECT table_name, position, name, CASE
  WHEN length = -1 AND data_type IN ('varbinary', 'image') THEN 'BYTEA'
  WHEN length = -1 AND data_type = 'xml' THEN 'XML'
  WHEN length = -1 THEN 'TEXT'
  WHEN data_type IN ('int', 'integer') THEN 'INTEGER'
  WHEN data_type = 'bigint' THEN 'BIGINT'
  WHEN data_type IN ('smallint', 'tinyint') THEN 'SMALLINT'
  WHEN data_type IN ('decimal', 'numeric') THEN 'NUMERIC'
  WHEN data_type IN ('money', 'smallmoney') THEN 'MONEY'
  WHEN data_type = 'float' THEN 'DOUBLE PRECISION'
  WHEN data_type = 'real' THEN 'REAL'
  WHEN data_type = 'bit' THEN 'BOOLEAN'
  WHEN data_type IN ('char', 'nchar') THEN 'CHAR'
  WHEN data_type IN ('varchar', 'nvarchar') THEN 'VARCHAR'
  WHEN data_type = 'xml' THEN 'XML'
  WHEN data_type IN ('binary', 'varbinary', 'image', 'rowversion', 'timestamp') THEN 'BYTEA'
  WHEN data_type = 'uniqueidentifier' THEN 'UUID'
  WHEN data_type = 'sql_variant' THEN 'JSONB'
  WHEN data_type = 'date' THEN 'DATE'
  WHEN data_type = 'time' THEN 'TIME'
  WHEN data_type IN ('datetime', 'smalldatetime', 'datetime2') THEN 'TIMESTAMP'
  WHEN data_type = 'datetimeoffset' THEN 'TIMESTAMPTZ'
  WHEN data_type = 'geometry' THEN 'GEOMETRY'
  WHEN data_type = 'geography' THEN 'GEOGRAPHY'
  WHEN data_type = 'hierarchyid' THEN 'LTREE'
  ELSE 'TEXT' END AS type, length, nullable, "default" FROM c""",
    "schema_informix": """
WITH c AS (SELECT o_orderpriority AS table_name, CAST(o_orderkey AS INTEGER) AS position,
  'c' || o_orderkey AS name, CAST(o_orderkey % 4201 AS INTEGER) AS code FROM orders)
SELECT table_name, position, name, CASE
  WHEN code % 256 = 1 THEN 'SMALLINT'
  WHEN code % 256 IN (2, 25) THEN 'INTEGER'
  WHEN code % 256 = 3 THEN 'DOUBLE PRECISION'
  WHEN code % 256 = 4 THEN 'REAL'
  WHEN code % 256 = 5 THEN 'DECIMAL'
  WHEN code % 256 = 6 THEN 'SERIAL'
  WHEN code % 256 = 8 THEN 'NUMERIC'
  WHEN code % 256 IN (17, 26, 52) THEN 'BIGINT'
  WHEN code % 256 IN (18, 53) THEN 'BIGSERIAL'
  WHEN code % 256 IN (0, 15) THEN 'CHAR'
  WHEN code % 256 IN (13, 16, 27, 40, 43) THEN 'VARCHAR'
  WHEN code % 256 = 7 THEN 'DATE'
  WHEN code % 256 = 10 THEN 'TIMESTAMP'
  WHEN code % 256 = 14 THEN 'INTERVAL'
  WHEN code % 256 IN (28, 32, 41, 45) THEN 'BOOLEAN'
  WHEN code % 256 IN (11, 31, 36) THEN 'BYTEA'
  WHEN code % 256 IN (19, 20, 21) THEN 'TEXT[]'
  WHEN code % 256 IN (22, 23, 24) THEN 'JSONB'
  ELSE 'TEXT' END AS type,
  CASE WHEN (code & 256) = 256 THEN 'NO' ELSE 'YES' END AS nullable FROM c""",
    "schema_postgres": f"""
SELECT p_brand AS table_name, CAST(p_partkey AS INTEGER) AS position, p_name AS name,
  upper(({_POSTGRES_DECLARED})[p_partkey % 6 + 1] || p_size || ')') AS type,
  CASE WHEN p_partkey % 3 = 0 THEN 'NO' ELSE 'YES' END AS nullable,
  CASE WHEN p_partkey % 2 = 0 THEN '''' || p_type || '''::text' ELSE '' END AS "default"
FROM part""",
    "view_columns": """
SELECT p_name || p_partkey AS name,
  (['numeric', 'character varying', 'timestamp', 'bit', 'time', 'uuid'])[p_partkey % 6 + 1] AS base_type,
  (['number', 'string', 'Datetime', 'any', 'string', 'string'])[p_partkey % 6 + 1] AS type
FROM part""",
    "api_types": f"""
WITH k AS (SELECT o_orderkey, o_orderkey // 3 AS number,
    (['informix', 'postgres', 'sqlserver'])[o_orderkey % 3 + 1] AS dialect FROM orders),
c AS (SELECT o_orderkey, dialect, number % 4201 AS code, CASE dialect
    WHEN 'informix' THEN CAST(number % 4201 AS VARCHAR)
    WHEN 'postgres' THEN ({_POSTGRES_NAMES})[number % 33 + 1]
    ELSE ({_SQLSERVER_NAMES})[number % 37 + 1] END AS type FROM k)
SELECT o_orderkey, dialect, type, CASE dialect
  WHEN 'informix' THEN CASE
    WHEN code IN (1, 2, 3, 4, 5, 6, 8, 17, 18, 25, 26, 52, 53, 262) THEN 'number'
    WHEN code IN (0, 12, 13, 14, 15, 16, 27, 35, 37, 40, 42, 43, 256, 258, 269, 2061) THEN 'string'
    WHEN code IN (7, 10, 263) THEN 'Date'
    WHEN code IN (28, 32, 41, 45) THEN 'boolean'
    WHEN code IN (11, 31, 36) THEN 'binary'
    WHEN code IN (19, 20, 21) THEN 'string[]'
    WHEN code = 23 THEN 'any[]'
    WHEN code IN (22, 24, 4117, 4118) THEN 'Record<string, any>'
    WHEN code = 9 THEN 'null' ELSE 'unknown' END
  WHEN 'postgres' THEN CASE
    WHEN type IN ('smallint', 'integer', 'bigint', 'numeric', 'decimal', 'real', 'smallserial',
      'serial', 'bigserial', 'double precision') THEN 'number'
    WHEN type IN ('money', 'character varying', 'varchar', 'character', 'char', 'text', 'citext',
      'interval', 'uuid', 'USER-DEFINED') OR type LIKE 'time' OR type LIKE 'time with%' THEN 'string'
    WHEN type IN ('boolean', 'bool') THEN 'boolean'
    WHEN type = 'date' THEN 'Date'
    WHEN type LIKE 'timestamp%' THEN 'Datetime' ELSE 'any' END
  ELSE CASE
    WHEN type IN ('int', 'bigint', 'smallint', 'tinyint', 'decimal', 'numeric', 'float', 'real',
      'money', 'smallmoney') THEN 'number'
    WHEN type = 'bit' THEN 'boolean'
    WHEN type IN ('hierarchyid', 'geography', 'geometry', 'sql_variant', 'VARCHAR', 'cursor') THEN 'any'
    WHEN type = 'date' THEN 'Date'
    WHEN type IN ('datetime', 'smalldatetime') THEN 'Datetime' ELSE 'string' END
  END AS api_type FROM c""",
}
