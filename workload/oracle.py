"""Plain SQL for the queries of :mod:`workload.queries`, for DuckDB."""

from __future__ import annotations

from .settings import CHAIN_SIZES, DAYS, SEGMENTS

SQL: dict[str, str] = {}

# ------------------------------------------------------------ sources and sinks

SQL["s1_csv_scan"] = "SELECT * FROM orders"

SQL["s2_many_tables"] = """
SELECT 0 AS place, 'lineitem' AS name, count(*) AS rows FROM lineitem
UNION ALL SELECT 1, 'customer', count(*) FROM customer
UNION ALL SELECT 2, 'orders', count(*) FROM orders
"""

SQL["s2_texts"] = "FROM documents UNION ALL BY NAME FROM conversations"
SQL["s3_csv_sink"] = SQL["s4_parquet_sink"] = "FROM customer UNION ALL BY NAME FROM supplier"

SQL["s3_csv_texts"] = "SELECT * FROM documents"

SQL["s5_result_sink"] = """
SELECT orders.*, lineitem.*, f.format
FROM orders JOIN lineitem ON o_orderkey = l_orderkey,
     (VALUES ('csv'), ('parquet')) AS f(format)
"""

X1 = """
SELECT * FROM customer
LEFT JOIN orders ON c_custkey = o_custkey
RIGHT JOIN lineitem ON o_orderkey = l_orderkey
"""
SQL["s6_job_output"] = X1

# ------------------------------------------------- projection, types and renaming

SQL["p1_typed_scan"] = """
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders
"""

SQL["p2_cast_joined"] = """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderstatus, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(l_quantity AS INTEGER) AS l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
"""

SQL["p3_clash_names"] = """
SELECT o_orderkey AS orderkey, o_totalprice AS orders__price,
       l_extendedprice AS lineitem__price, o_orderdate AS orders__day,
       l_shipdate AS lineitem__day
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
"""

SQL["p4_suffix_to_prefix"] = """
SELECT o_orderkey AS orderkey, o_totalprice AS orders__price, o_orderdate AS orders__day
FROM orders
"""

SQL["p5_shared_columns"] = """
SELECT l_orderkey AS orderkey, l_extendedprice AS price, l_shipdate AS day FROM lineitem
"""

# ---------------------------------------------------------------------- filters

SQL["f1_filter_joined"] = """
SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE l_extendedprice > CAST(0.1 AS DOUBLE) * o_totalprice AND o_orderstatus <> 'P'
"""

SQL["f2_filter_between"] = """
WITH first AS (
  SELECT * FROM customer LEFT JOIN orders ON c_custkey = o_custkey
  WHERE c_acctbal > 0 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
)
SELECT c_custkey, c_name, o_orderkey, o_orderpriority,
       l_orderkey, l_partkey, l_linenumber, l_quantity
FROM first RIGHT JOIN lineitem ON o_orderkey = l_orderkey
"""

# ------------------------------------------------------------------------ joins

FINISHED = "(SELECT * FROM orders WHERE o_orderstatus = 'F') AS o"
RETURNED = "(SELECT * FROM lineitem WHERE l_returnflag = 'R') AS l"

SQL["j1_inner"] = "SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
SQL["j2_left"] = "SELECT * FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"
SQL["j2_left_mostly_unmatched"] = "SELECT * FROM documents LEFT JOIN labels USING (doc_id)"
SQL["j3_right"] = "SELECT * FROM orders RIGHT JOIN lineitem ON o_orderkey = l_orderkey"
SQL["j4_full"] = "SELECT * FROM labels FULL JOIN conversations ON doc_id = conv_id"
SQL["j4_hot_full"] = SQL["j4_full"]
SQL["j2_hot_left"] = "SELECT * FROM labels LEFT JOIN conversations ON doc_id = conv_id"
SQL["j5_same_name_key"] = """
SELECT coalesce(doc_id, conv_id) AS id, l.* EXCLUDE (doc_id), c.* EXCLUDE (conv_id)
FROM labels l FULL JOIN conversations c ON doc_id = conv_id
"""
SQL["j6_two_name_key"] = "SELECT * FROM customer LEFT JOIN orders ON c_custkey = o_custkey"

NULL_ZERO = """
WITH c AS (SELECT * REPLACE (nullif(c_nationkey, 0) AS c_nationkey) FROM customer),
     n AS (SELECT * REPLACE (nullif(n_nationkey, 0) AS n_nationkey) FROM nation)
"""
SQL["j7_null_matches_null"] = (
    NULL_ZERO + "SELECT * FROM c JOIN n ON c_nationkey IS NOT DISTINCT FROM n_nationkey"
)
SQL["j7_null_matches_nothing"] = (
    NULL_ZERO + "SELECT * FROM c FULL JOIN n ON c_nationkey = n_nationkey"
)
SQL["j8_chain"] = """
SELECT * FROM region
LEFT JOIN nation ON r_regionkey = n_regionkey
JOIN customer ON n_nationkey = c_nationkey
FULL JOIN orders ON c_custkey = o_custkey
"""
SQL["j8_star_left"] = """
SELECT * FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
"""
SQL["j8_hot_chain"] = """
SELECT * FROM supplier
RIGHT JOIN nation ON s_nationkey = n_nationkey
FULL JOIN region ON n_regionkey = r_regionkey
"""
SQL["x1_example_job"] = X1

# ----------------------------------------------------------- counting and checks
# Each check is one row: check, table, column, expected, actual, violations.


def row(check: str, table: str, column: str, body: str) -> str:
    """``body`` selects expected, actual and violations."""
    return f"""
SELECT '{check}' AS "check", '{table}' AS "table", '{column}' AS "column",
       CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual,
       CAST(violations AS BIGINT) AS violations
FROM ({body})"""


def rows(*parts: str) -> str:
    return "\nUNION ALL".join(parts)


def row_count(table: str, size: int) -> str:
    return row("row count", table, "*", f"""
SELECT {size} AS expected, count(*) AS actual, abs(count(*) - {size}) AS violations FROM {table}""")


def passing(check: str, table: str, column: str, fails: str, source: str | None = None) -> str:
    return row(check, table, column, f"""
SELECT count(*) AS expected, count(*) - count(*) FILTER (WHERE {fails}) AS actual,
       count(*) FILTER (WHERE {fails}) AS violations
FROM {source or table}""")


def at_least(check: str, tables: str, column: str, size: int, actual: str) -> str:
    """``actual`` selects one column n."""
    return row(check, tables, column, f"""
SELECT {size} AS expected, n AS actual, greatest({size} - n, 0) AS violations FROM ({actual})""")


def exactly(check: str, tables: str, column: str, size: int, actual: str) -> str:
    return row(check, tables, column, f"""
SELECT {size} AS expected, n AS actual, abs({size} - n) AS violations FROM ({actual})""")


def distinct(check: str, table: str, column: str, counted: str) -> str:
    return row(check, table, column, f"""
SELECT count(*) AS expected, {counted} AS actual, count(*) - {counted} AS violations
FROM {table}""")


SQL["c1_row_count"] = rows(
    row_count("orders", 15000), row_count("lineitem", 60001), row_count("nation", 25)
)

SQL["j8_hot_derived"] = """
WITH priorities AS (
  SELECT o_orderpriority AS priority, count(*) AS orders FROM orders GROUP BY ALL
  UNION ALL SELECT 'none', count(*) FROM orders
)
SELECT * FROM customer LEFT JOIN orders ON c_custkey = o_custkey
FULL JOIN priorities ON o_orderpriority = priority
"""
SQL["c2_chain_with_filters"] = """
WITH one AS (
  SELECT * FROM events LEFT JOIN orders ON user_id = o_custkey
  WHERE (o_totalprice > 100000 OR o_orderkey IS NULL) AND event_type <> 'view' AND value * 1000 < o_totalprice
), two AS (
  SELECT * FROM one RIGHT JOIN customer ON user_id = c_custkey
  WHERE c_mktsegment <> 'BUILDING' OR user_id IS NULL
)
SELECT 1 AS step, count(*) AS rows FROM one UNION ALL SELECT 2, count(*) FROM two
"""
SQL["c2_join_cardinality"] = rows(
    exactly("join cardinality", "join 1", "c_custkey, o_custkey", CHAIN_SIZES[0],
            "SELECT count(*) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey"),
    exactly("join cardinality", "join 2", "o_orderkey, l_orderkey", CHAIN_SIZES[1],
            f"SELECT count(*) AS n FROM ({X1})"),
)


def shared(left: str, a: str, right: str, b: str) -> str:
    return f"SELECT {a} AS v FROM {left} INTERSECT SELECT {b} FROM {right}"


def overlap(check: str, left: str, a: str, right: str, b: str, size: int) -> str:
    compare = exactly if check == "key overlap" else at_least
    values = f"SELECT count(v) AS n FROM ({shared(left, a, right, b)})"
    return compare(check, f"{left}, {right}", f"{a}, {b}", size, values)


KEYS = ("orders", "o_orderkey", "lineitem", "l_orderkey")
SQL["c3_key_overlap"] = rows(
    overlap("key overlap", *KEYS, 14743),
    overlap("key overlap", "events", "user_id", "customer", "c_custkey", 100),
)

SQL["c4_range"] = rows(
    passing("range", "part", "p_size", "NOT p_size BETWEEN 1 AND 40"),
    passing("range", "lineitem", "l_discount",
            "NOT l_discount BETWEEN CAST(0.02 AS DOUBLE) AND CAST(0.08 AS DOUBLE)"),
    passing("range", "orders", "o_orderdate",
            f"NOT o_orderdate BETWEEN DATE '{DAYS[0]}' AND DATE '{DAYS[1]}'"),
)

LISTED = ", ".join(f"'{s}'" for s in SEGMENTS)
SQL["c5_domain"] = rows(
    passing("domain", "orders", "o_orderstatus", "o_orderstatus NOT IN ('O', 'F')"),
    passing("domain", "customer", "c_mktsegment", f"c_mktsegment NOT IN ({LISTED})"),
    passing("domain", "orders", "o_custkey",
            "o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')"),
)

PAIR = "l_orderkey, l_linenumber"
SQL["c5_domain_null"] = rows(
    passing("domain", "orders", "o_orderstatus", "o_orderstatus NOT IN ('O', 'F')"),
    passing("domain", "orders", "o_orderpriority", "o_orderpriority <> '1-URGENT'"),
    passing("domain", "lineitem", "l_quantity", "l_quantity NOT BETWEEN 2 AND 201"),
    passing("domain", "lineitem", "l_quantity", "l_quantity NOT BETWEEN 2 AND 202"),
)
SQL["c6_unique"] = rows(
    distinct("unique", "lineitem", PAIR, f"count(DISTINCT ({PAIR}))"),
    distinct("unique", "orders", "o_orderkey", "count(DISTINCT o_orderkey)"),
)
SQL["c6_repeated_keys"] = f"""
SELECT {PAIR}, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
"""


def pattern(table: str, column: str, regex: str) -> str:
    return passing("pattern", table, column, f"NOT regexp_full_match({column}, '{regex}')")


PRIORITY = pattern("orders", "o_orderpriority", "[0-9]-[A-Z]{6}")
SQL["c7_line_break"] = passing(
    "pattern", "orders", "o_orderpriority",
    "o_orderstatus = 'F' OR NOT regexp_full_match(o_orderpriority, '[0-9]-[A-Z]{6}')",
)
SQL["c7_pattern"] = rows(
    PRIORITY,
    pattern("nation", "n_name", "[A-Z]{6}_[0-9]"),
    pattern("events", "event_type", "[a-z]{5}"),
)


def capacity(table: str, column: str, room: str) -> str:
    return row("capacity", table, column, f"""
SELECT count(*) AS expected, {room} AS actual, greatest(count(*) - ({room}), 0) AS violations
FROM {table}""")


SQL["c8_other_types"] = rows(
    capacity("part", "p_size", "max(p_size) - min(p_size) + 1"),
    capacity("customer", "c_acctbal", "(max(round(c_acctbal)) - min(round(c_acctbal))) * 10 + 1"),
)
SQL["c8_capacity"] = rows(
    capacity("orders", "o_orderkey", "max(o_orderkey) - min(o_orderkey) + 1"),
    capacity("orders", "o_orderdate", "datediff('day', min(o_orderdate), max(o_orderdate)) + 1"),
    capacity("part", "p_size", "50"),
    capacity("lineitem", "l_partkey", "max(l_partkey) - min(l_partkey) + 1"),
    capacity("customer", "c_acctbal", "count(*)"),
)

DAYS_SHARED = at_least(
    "range overlap", "orders, lineitem", "o_orderdate, l_shipdate", 2000, """
SELECT datediff('day', greatest((SELECT min(o_orderdate) FROM orders),
                                (SELECT min(l_shipdate) FROM lineitem)),
                       least((SELECT max(o_orderdate) FROM orders),
                             (SELECT max(l_shipdate) FROM lineitem))) + 1 AS n""")
SQL["c9_range_overlap"] = rows(
    DAYS_SHARED,
    at_least("range overlap", "customer, part", "c_custkey, p_partkey", 1800, """
SELECT least((SELECT max(c_custkey) FROM customer), (SELECT max(p_partkey) FROM part))
     - greatest((SELECT min(c_custkey) FROM customer), (SELECT min(p_partkey) FROM part)) + 1
     AS n"""),
    at_least("range overlap", "part, orders", "p_size, o_custkey", 20,
             "SELECT least(max(p_size), 9999) - greatest(min(p_size), 41) + 1 AS n FROM part"),
)

SQL["c10_shared_values"] = "SELECT user_id FROM events INTERSECT SELECT c_custkey FROM customer"
SQL["c10_value_overlap"] = rows(
    overlap("value overlap", "orders", "o_custkey", "part", "p_partkey", 1000),
    overlap("value overlap", "customer", "c_nationkey", "supplier", "s_nationkey", 26),
)


def inside(left: str, a: str, right: str, b: str, size: int) -> str:
    return at_least("values in range", f"{left}, {right}", f"{a}, {b}", size, f"""
SELECT count(DISTINCT {a}) AS n FROM {left}
WHERE {a} BETWEEN (SELECT min({b}) FROM {right}) AND (SELECT max({b}) FROM {right})""")


SQL["c11_values_in_range"] = rows(
    inside("part", "p_size", "lineitem", "l_quantity", 60),
    inside("orders", "o_custkey", "part", "p_partkey", 100),
    at_least("values in range", "part, part", "p_size", 10,
             "SELECT count(DISTINCT p_size) AS n FROM part WHERE p_size BETWEEN 10 AND 19"),
)

SQL["c12_list_length"] = rows(
    distinct("list length", "part", "p_brand", "count(DISTINCT p_brand)"),
    distinct("list length", "nation", "n_name", "count(DISTINCT n_name)"),
)

SQL["c13_same_type"] = rows(
    passing("type of supplier", "part", "code", "TRY_CAST(p_brand AS BIGINT) IS NULL"),
    passing("type of supplier", "part", "size",
            "TRY_CAST(CAST(p_size AS VARCHAR) AS INTEGER) IS NULL"),
)

SQL["c14_not_null"] = rows(
    passing("not null", "customer", "c_custkey", "c_custkey IS NULL"),
    passing("not null", "customer", "c_nationkey", "nullif(c_nationkey, 0) IS NULL"),
    passing("not null", "customer", "c_mktsegment", "c_mktsegment IS NULL"),
    passing("not null", "nation", "n_nationkey", "nullif(n_nationkey, 0) IS NULL"),
)

SQL["c15_report"] = rows(
    row_count("orders", 15000),
    passing("not null", "orders", "o_custkey", "o_custkey IS NULL"),
    passing("domain", "orders", "o_orderstatus", "o_orderstatus NOT IN ('O', 'F', 'P')"),
    passing("range", "orders", "o_totalprice", "NOT o_totalprice BETWEEN 1000 AND 400000"),
    distinct("unique", "orders", "o_orderkey", "count(DISTINCT o_orderkey)"),
    passing("range", "lineitem", "l_quantity", "NOT l_quantity BETWEEN 1 AND 45"),
    passing("not null", "lineitem", "l_shipdate", "l_shipdate IS NULL"),
    capacity("lineitem", "l_suppkey", "max(l_suppkey) - min(l_suppkey) + 1"),
    PRIORITY,
    distinct("list length", "customer", "c_name", "count(DISTINCT c_name)"),
    passing("type", "part", "p_brand", "TRY_CAST(p_brand AS INTEGER) IS NULL"),
    overlap("key overlap", *KEYS, 14743),
    DAYS_SHARED,
    inside("part", "p_size", "lineitem", "l_quantity", 50),
)

# -------------------------------------------------------------------- comparison

CHANGED = """
kept AS (
  SELECT * FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
),
changed AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
                         THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
  FROM kept
  UNION ALL SELECT * FROM kept WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
)
"""
SQL["d1_row_difference"] = SQL["d2_column_order"] = f"""
WITH {CHANGED},
missing AS (SELECT * FROM orders EXCEPT ALL SELECT * FROM changed),
unexpected AS (SELECT * FROM changed EXCEPT ALL SELECT * FROM orders)
SELECT *, 'left' AS side, count(*) AS copies FROM missing GROUP BY ALL
UNION ALL
SELECT *, 'right' AS side, count(*) AS copies FROM unexpected GROUP BY ALL
"""
SQL["d1_reserved_names"] = """
SELECT o_orderkey, o_custkey AS copies, o_orderstatus AS side, o_totalprice AS rows, o_orderdate,
       o_orderpriority, 'left' AS side_, 1 AS copies_
FROM orders WHERE o_orderstatus = 'F'
"""
SQL["d1_equal_tables"] = """
SELECT (SELECT count(*) FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM lineitem))
       AS missing,
       (SELECT count(*) FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM lineitem))
       AS unexpected
"""
SQL["d3_cell_difference"] = """
WITH changed AS (
  SELECT * REPLACE (CASE WHEN p_type = 'ECONOMY' THEN p_size + 1 ELSE p_size END AS p_size,
                    nullif(p_brand, 'Brand#7') AS p_brand)
  FROM part WHERE p_name <> 'small ring'
),
pair AS (
  SELECT a.p_partkey, a.p_size AS a_size, b.p_size AS b_size,
         a.p_brand AS a_brand, b.p_brand AS b_brand
  FROM part a JOIN changed b USING (p_partkey)
)
SELECT p_partkey, 'p_size' AS "column", CAST(a_size AS VARCHAR) AS left_value,
       CAST(b_size AS VARCHAR) AS right_value
FROM pair WHERE a_size IS DISTINCT FROM b_size
UNION ALL
SELECT p_partkey, 'p_brand', a_brand, b_brand FROM pair WHERE a_brand IS DISTINCT FROM b_brand
UNION ALL
SELECT p_partkey, NULL, 'present', NULL FROM part
WHERE p_partkey NOT IN (SELECT p_partkey FROM changed)
"""
SQL["d3_repeated_key"] = """
SELECT l_orderkey, 'l_linenumber' AS "column", CAST(l_linenumber AS VARCHAR) AS left_value,
       CAST(l_linenumber + 100 AS VARCHAR) AS right_value
FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45
UNION ALL
SELECT l_orderkey, NULL, 'present', NULL FROM lineitem WHERE l_returnflag = 'A' AND l_quantity = 50
"""
SQL["d3_by_place"] = """
WITH changed AS (
  SELECT * REPLACE (p_partkey + 1 AS p_partkey, CASE WHEN p_size > 45 THEN NULL ELSE p_size END AS p_size)
  FROM part
  UNION ALL SELECT * REPLACE (p_partkey + 1000000 AS p_partkey) FROM part WHERE p_size = 50
), a AS (
  SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS place FROM part
), b AS (
  SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS place FROM changed
)
SELECT place, 'p_partkey' AS "column", CAST(a.p_partkey AS VARCHAR) AS left_value,
       CAST(b.p_partkey AS VARCHAR) AS right_value
FROM a JOIN b USING (place)
UNION ALL
SELECT place, 'p_size', CAST(a.p_size AS VARCHAR), CAST(b.p_size AS VARCHAR)
FROM a JOIN b USING (place) WHERE a.p_size IS DISTINCT FROM b.p_size
UNION ALL
SELECT place, NULL, NULL, 'present' FROM b WHERE place >= (SELECT count(*) FROM part)
"""
SQL["d4_verify_jobs"] = f"""
WITH expected AS ({X1}),
wrong AS (
  SELECT * FROM customer
  LEFT JOIN orders ON c_custkey = o_custkey
  LEFT JOIN lineitem ON o_orderkey = l_orderkey
),
n AS (
  SELECT (SELECT count(*) FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM wrong)) AS lacks,
         (SELECT count(*) FROM (SELECT * FROM wrong EXCEPT ALL SELECT * FROM expected)) AS extra
)
SELECT 'right' AS job, true AS passed, 0 AS missing, 0 AS unexpected, NULL AS reason
UNION ALL
SELECT 'wrong', lacks = 0 AND extra = 0, lacks, extra,
       CASE WHEN lacks + extra > 0 THEN 'rows differ' END
FROM n
"""

# --------------------------------------------------------------------- generation
# What must hold of the generated values, whatever they are.

SQL["g1_integers"] = "SELECT *, true AS inside, 1 AS times FROM orders"
SQL["g2_booleans"] = "SELECT *, true AS balanced FROM customer"
SQL["g3_doubles"] = "SELECT o_orderkey, o_totalprice, true AS inside, 1 AS times FROM orders"
SQL["g4_dates"] = "SELECT *, true AS inside, 1 AS times FROM supplier"
SQL["g5_strings"] = "SELECT o_orderkey, o_custkey, true AS fits, true AS varied FROM orders"
SQL["g6_own_bounds"] = """
SELECT *, true AS size_inside, true AS price_inside, true AS code_fits,
       true AS sizes_varied, true AS prices_differ, true AS codes_varied FROM part
"""
SQL["g7_value_list"] = """
SELECT * FROM orders
UNION ALL BY NAME SELECT count(DISTINCT p_brand) AS o_orderkey FROM part
"""
SQL["g8_without_replacement"] = """
SELECT count(*) AS rows, count(*) AS customers, count(*) AS orders FROM customer
"""
SQL["g9_not_unique"] = """
SELECT l_orderkey, l_linenumber, l_partkey, true AS inside, true AS all_drawn FROM lineitem
"""
SQL["g10_filler_rows"] = """
SELECT count(*) AS rows, count(*) AS keys FROM orders UNION ALL SELECT 0, 0
"""
SQL["g11_correlated_pair"] = """
SELECT * FROM customer ORDER BY c_custkey LIMIT (SELECT count(*) // 2 FROM customer)
"""
SQL["g12_next_table"] = """
SELECT * FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD')
ORDER BY c_custkey LIMIT (SELECT count(*) // 4 FROM customer)
"""
SQL["g12_string_key"] = """
WITH n AS (SELECT count(*) // 4 AS matched FROM customer)
SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_name) <= (SELECT matched FROM n) AS BIGINT) AS times,
       CAST(row_number() OVER (ORDER BY c_name) <= (SELECT matched FROM n) AS BIGINT) AS names,
       true AS fits
FROM customer
UNION ALL
SELECT NULL, (SELECT count(*) FROM orders) - matched, (SELECT count(*) FROM orders) - matched, true FROM n
"""
SQL["g12_repeated_key"] = """
SELECT 'join' AS of, count(*) // 3 AS rows FROM lineitem
UNION ALL SELECT 'table', count(*) FROM orders
UNION ALL SELECT 'keys', count(*) FROM orders
"""
SQL["g13_expected_result"] = "SELECT true AS passed, 0 AS missing, 0 AS unexpected"
SQL["g13_chain"] = """
WITH n AS (SELECT count(*) // 8 AS matched FROM customer),
     first AS (SELECT * FROM customer ORDER BY c_custkey LIMIT (SELECT matched FROM n))
SELECT * FROM first
UNION ALL
SELECT first.* FROM range((SELECT count(*) FROM part) - (SELECT matched FROM n)) LEFT JOIN first ON false
"""
SQL["g14_chain_with_filter"] = """
WITH bought AS (
  SELECT * FROM customer ORDER BY c_custkey LIMIT (SELECT count(*) // 2 FROM customer)
), kept AS (
  SELECT * FROM bought WHERE c_acctbal > 0 AND c_mktsegment <> 'BUILDING'
)
SELECT true AS customer, count(*) AS rows, CAST(sum(c_custkey) AS BIGINT) AS keys FROM kept
UNION ALL
SELECT false, (SELECT count(*) FROM part) - (SELECT count(*) // 8 FROM customer), NULL
"""
SQL["g15_first_days"] = """
SELECT * FROM events ORDER BY ts, event_id LIMIT (SELECT count(*) // 10 FROM events)
"""
SQL["g15_first_rows"] = """
SELECT * FROM orders ORDER BY o_orderkey LIMIT (SELECT count(*) // 10 FROM orders)
"""
