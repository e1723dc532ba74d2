"""What each query should give, as SQL over the same tables."""

_LETTERS = """CASE WHEN {c} < 26 THEN chr(65 + {c})
  WHEN {c} < 702 THEN chr(65 + ({c} - 26) // 26) || chr(65 + ({c} - 26) % 26)
  ELSE chr(65 + ({c} - 702) // 676) || chr(65 + (({c} - 702) // 26) % 26) || chr(65 + ({c} - 702) % 26) END"""

_ISO = """rtrim(rtrim(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%g'), '0'), '.')"""

_TRIM = r"regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
_CLEAN = f"regexp_replace(regexp_replace({_TRIM}, '[+\\\\._, \\n]+', '_', 'g'), '_$', '')"


def _type(column: str, position: int, expression: str, where: str = "true") -> str:
    return (
        f"SELECT {position} AS position, CASE WHEN count(DISTINCT t) = 1 THEN any_value(t) ELSE 'string' END AS type "
        f"FROM (SELECT {expression} AS t FROM events WHERE {where})"
    )


def _types(mixed: str, where: str = "true") -> str:
    columns = [
        ("id", "'double'"), ("at", "'timestamp'"), ("is_click", "'boolean'"), ("mixed", mixed),
        ("nothing", "CAST(NULL AS VARCHAR)"), ("kind", "'string'"),
        ("holes", "CASE WHEN event_type <> 'error' THEN 'double' END"),
    ]
    return " UNION ALL ".join(_type(c, i, e, where) for i, (c, e) in enumerate(columns))


def _sampled(n: int) -> str:
    mixed = "CASE WHEN event_id >= 150 THEN 'string' ELSE 'double' END"
    where = f"event_id < {n}" if n else "true"
    return f"SELECT {n} AS sampled, position, type FROM ({_types(mixed, where)})"


def _clamp(value: str, low: int, high: int, kind: str) -> str:
    return (
        f"CAST(CASE WHEN {value} >= {high}::DOUBLE THEN {high} WHEN {value} <= {low}::DOUBLE THEN {low} "
        f"ELSE CAST(trunc({value}) AS {kind}) END AS {kind})"
    )


def _int(value: str) -> str:
    return _clamp(value, -(2**31), 2**31 - 1, "INTEGER")


def _long(value: str) -> str:
    return _clamp(value, -(2**63), 2**63 - 1, "BIGINT")


_CUSTOMER_FILE = "'book-' || lpad(CAST(c_custkey // 1000 AS VARCHAR), 8, '0') || '.xlsx'"

ORACLES = {
    "flagship": """
        SELECT strftime(o_orderdate, '%Y') AS sheet_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total
        FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY 1""",
    "sheet_default": """
        SELECT CAST(event_id AS DOUBLE) AS event_id, CAST(user_id AS DOUBLE) AS user_id, value, props FROM events
        WHERE event_type = (SELECT min(event_type) FROM events)""",
    "sheet_pattern": """
        SELECT event_type AS sheet_name, event_id, value FROM events
        WHERE regexp_full_match(event_type, 'clic|sign.*|v[a-z]ew')""",
    "anchor_offset": """
        SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS DOUBLE) AS p_size,
               p_retailprice FROM part""",
    "table_width": "SELECT CAST(p_partkey AS DOUBLE) AS key, p_name AS name, p_brand AS brand FROM part",
    "merged_fill": "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem",
    "merged_fill_2d": """
        SELECT CAST(c_custkey AS DOUBLE) AS "Key_id", c_name AS "Key_name", CAST(v AS DOUBLE) AS "Money_nation",
               CAST(v AS DOUBLE) AS "Money_balance", c_mktsegment AS "_SheetName"
        FROM (SELECT *, first_value(c_nationkey) OVER (PARTITION BY c_mktsegment, n // 3 ORDER BY n) AS v
              FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS n FROM customer))""",
    "header_multirow": """
        WITH years AS (SELECT y, row_number() OVER (ORDER BY y) AS i FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders))
        SELECT 0 AS position, 'Priority' AS name
        UNION ALL SELECT CAST(2 * i - 1 AS INTEGER), y || '_Orders' FROM years
        UNION ALL SELECT CAST(2 * i AS INTEGER), y || '_Total_gross' FROM years""",
    "clean_names": f"""
        SELECT doc_id, length(name) AS name_length, md5(name) AS name_md5 FROM (
          SELECT doc_id, coalesce(nullif({_CLEAN}, ''), 'col_' || doc_id) AS name FROM documents)""",
    "blank_headers": """
        SELECT CAST(s_suppkey AS DOUBLE) AS col_0, s_name AS col_1, CAST(s_nationkey AS DOUBLE) AS s_nationkey,
               s_acctbal AS col_3 FROM supplier""",
    "headerless": """
        SELECT CAST(s_suppkey AS DOUBLE) AS col_0, s_name AS col_1, CAST(s_nationkey AS DOUBLE) AS col_2,
               s_acctbal AS col_3 FROM supplier""",
    "infer_types": _types("CASE WHEN event_type = 'view' THEN 'string' ELSE 'double' END"),
    "infer_sampled": " UNION ALL ".join(_sampled(n) for n in (100, 150, 151, 0)),
    "header_only": """
        SELECT sheet_name, greatest(n, 1) AS records, n AS orders FROM (
          SELECT o_orderpriority || '/' || o_orderstatus AS sheet_name,
                 count(*) FILTER (WHERE o_orderstatus <> 'P') AS n FROM orders GROUP BY 1)""",
    "gap_rows": """
        SELECT CAST(o.o_orderkey AS DOUBLE) AS o_orderkey, o.o_totalprice, o.o_orderstatus, o.o_orderkey IS NOT NULL AS ok
        FROM generate_series(0, (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus <> 'P')) g(k)
        LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON o.o_orderkey = g.k""",
    "multi_sheet_union": """
        SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, o_totalprice, o_orderpriority AS sheet_name FROM orders""",
    "coerce_int": f"""
        SELECT l_orderkey, l_partkey, {_int('l_extendedprice * (0.5::DOUBLE - l_discount * 10)')} AS cut,
               {_int('l_extendedprice * 1e5::DOUBLE')} AS clamped FROM lineitem""",
    "coerce_long": f"""
        SELECT l_orderkey, l_partkey, {_long('l_extendedprice * -1000')} AS cut,
               {_long('l_extendedprice * 1e15::DOUBLE')} AS clamped FROM lineitem""",
    "coerce_float": """
        SELECT l_orderkey, l_partkey, CAST(l_discount AS FLOAT) AS f, CAST(NULL AS FLOAT) AS not_a_number FROM lineitem""",
    "coerce_string": """
        SELECT l_orderkey, l_partkey, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.0' AS number,
               CASE WHEN l_discount > 0.05::DOUBLE THEN 'true' ELSE 'false' END AS truth,
               strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS day, l_returnflag AS text, CAST(NULL AS VARCHAR) AS broken
        FROM lineitem""",
    "coerce_bool": """
        SELECT doc_id, quality = 1 AS good, true AS toxic_lost, false AS ok FROM labels""",
    "serial_dates": """
        SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS at, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
               CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS INTEGER) AS serial FROM orders""",
    "serial_times": f"""
        SELECT event_id, date_trunc('milliseconds', ts) AS at, {_ISO.format(ts="date_trunc('milliseconds', ts)")} AS iso
        FROM events""",
    "null_token": """
        SELECT o_orderkey, CASE WHEN lower(o_orderpriority) <> '3-medium' THEN o_orderpriority END AS o_orderpriority
        FROM orders""",
    "schema_match": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value, event_type, event_type <> 'error' AS ok
        FROM events""",
    "prune_with_flag": "SELECT event_type <> 'error' AS ok, count(*) AS n FROM events GROUP BY 1",
    "a1_addresses": f"""
        SELECT o_orderkey, {_LETTERS.format(c='c')} || (o_orderkey + 1) AS address, CAST(o_orderkey AS INTEGER) AS r, c
        FROM (SELECT o_orderkey, CAST(o_custkey % 16384 AS INTEGER) AS c FROM orders)""",
    "resolve_strings": """
        SELECT doc_id, 0 AS col, lang AS text FROM documents UNION ALL SELECT doc_id, 1, source FROM documents""",
    "classify_dates": """
        SELECT event_id, user_id, user_id % 10 IN (1, 2, 4, 6, 8, 9) AND value >= 0 AS is_date FROM events""",
    "formula_text": """
        SELECT l_orderkey, l_partkey, l_linenumber || '*B' || (l_partkey + 2) AS formula FROM lineitem""",
    "formula_result": "SELECT l_orderkey, l_partkey, l_quantity * l_extendedprice AS result FROM lineitem",
    "shared_formula": """
        SELECT o_orderkey, chr(CAST(65 + o_orderkey % 3 AS INTEGER)) || r || '*$B$1+SUM(' ||
               chr(CAST(66 + o_orderkey % 3 AS INTEGER)) || r || ':$C' || r || ')' AS formula
        FROM (SELECT o_orderkey, (o_orderkey + 1) % 1048576 + 1 AS r FROM orders)""",
    "roundtrip_xlsx": """
        SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_acctbal,
               c_mktsegment FROM customer""",
    "roundtrip_dates": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate,
               o_orderpriority FROM orders""",
    "roundtrip_merged": "SELECT c_nationkey, c_custkey, c_acctbal, true AS ok FROM customer",
    "partitioned_files": """
        SELECT c_custkey, c_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "sheet_catalog": f"""
        SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY sheet_name) - 1 AS INTEGER) AS sheet_idx, sheet_name
        FROM (SELECT DISTINCT {_CUSTOMER_FILE} AS file, c_mktsegment AS sheet_name FROM customer)""",
    "sheets_of_files": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS sheet_name FROM customer
        WHERE regexp_full_match(c_mktsegment, '[A-G].*')""",
    "sql_view": """
        SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1""",
    "corrupt_files": """
        SELECT CASE k % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'corrupt' ELSE 'encrypted' END AS status, count(*) AS files
        FROM (SELECT DISTINCT c_custkey // 100 AS k FROM customer) GROUP BY 1""",
    "skip_corrupt": "SELECT c_custkey, c_name FROM customer WHERE (c_custkey // 1000) % 10 = 0",
    "files_glob": """
        SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_acctbal,
               c_mktsegment FROM customer""",
    "files_partitioned": """
        SELECT c_custkey, c_name, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "files_view": """
        SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1""",
    "files_stream": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "merged_overlap": """
        SELECT coalesce(t.o_orderkey, o.o_orderkey) AS a, coalesce(t.o_orderkey, o.o_custkey) AS b, o.o_orderkey AS c
        FROM orders o LEFT JOIN orders t ON t.o_orderkey % 4 = 0 AND o.o_orderkey IN (t.o_orderkey, t.o_orderkey + 1)""",
    "header_typed": """
        SELECT CAST(p_partkey AS DOUBLE) AS "2021_5", p_size > 25 AS "TRUE", CAST(p_size AS DOUBLE) AS "01-Jan-2021" FROM part""",
    "header_only_inferred": """
        SELECT sheet_name, position, CASE WHEN sheet_name = 'P' THEN 'string' ELSE type END AS type
        FROM (SELECT DISTINCT o_orderstatus AS sheet_name FROM orders), (VALUES (0, 'double'), (1, 'double'), (2, 'string')) AS c(position, type)""",
    "large_files": "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders",
    "flag_inferred": "SELECT CAST(s_suppkey AS DOUBLE) AS s_suppkey, s_name, true AS ok, 2 AS flag_at FROM supplier",
    "flag_not_null": "SELECT event_id, event_id % 3 > 0 AS ok FROM events",
    "stream_ingest": "SELECT event_id, user_id, event_type, value FROM events",
}
