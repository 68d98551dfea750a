"""Equivalent SQL per query, for an independent engine on the same tables."""

from __future__ import annotations

from starfold.functions.headers import PINNED_NAMES

SALES = """
wide_sales AS (
  SELECT 'LI' AS domain_code, 'Line items' AS domain,
    CAST(n_nationkey AS VARCHAR) AS area_code,
    concat('''', lpad(CAST(n_nationkey AS VARCHAR), 3, '0')) AS area_code_m49,
    n_name AS area_label, CAST(p_partkey AS VARCHAR) AS item_code, p_name AS item_label,
    CASE l_returnflag WHEN 'A' THEN '5510' WHEN 'N' THEN '5312' ELSE '5910' END AS element_code,
    CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'New' ELSE 'Returned' END AS element_label,
    CAST(year(l_shipdate) AS VARCHAR) AS year_code, CAST(year(l_shipdate) AS VARCHAR) AS year,
    't' AS unit, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value, l_linestatus AS flag_code
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""

TRADE = """
wide_trade AS (
  SELECT CAST(cn.n_nationkey AS VARCHAR) AS reporter_country_code, cn.n_name AS reporter_country_label,
    CAST(sn.n_nationkey AS VARCHAR) AS partner_country_code, sn.n_name AS partner_country_label,
    p_brand AS item_code, concat('Brand family ', p_brand) AS item_label,
    concat('C', CAST(r_regionkey AS VARCHAR)) AS iso_currency_code, r_name AS iso_currency_label,
    CAST(year(l_shipdate) AS VARCHAR) AS year_code, CAST(year(l_shipdate) AS VARCHAR) AS year,
    CAST(l_discount AS VARCHAR) AS value, l_linestatus AS flag_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region ON cn.n_regionkey = r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

ORDERS = """
wide_orders AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS area_code, n_name AS area_label,
    concat('P', substr(o_orderpriority, 1, 1)) AS item_code, o_orderpriority AS item_label,
    CASE WHEN o_orderkey % 50 = 0 THEN '1995-1997' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
    CASE WHEN o_orderkey % 97 = 0 THEN '<0.1' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS value,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS flag_code
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

ORDERS_BROKEN = """
broken AS (
  SELECT area_code, area_label, item_code,
    CASE WHEN length(value) % 5 = 0 THEN concat(item_label, chr(10), '"second, line"') ELSE item_label END AS item_label,
    year, value, flag_code
  FROM wide_orders
)"""

HEADERS = """
headers AS (
  SELECT concat('P', CAST(p_partkey AS VARCHAR)) AS dataset_code, i AS ordinal, names[i] AS raw_name
  FROM (
    SELECT p_partkey, unnest(range(1, 17))::INTEGER AS i,
      ['Area Code', 'Area Code (M49)', '  Area ', concat(p_type, ' Code'),
       concat(p_type, ' (', p_brand, ')'), 'Reporter Country Code', 'Reporter Countries',
       'Year Code', 'Year', 'Unit', 'Value', 'Value',
       concat('Value ', CAST(p_size % 3 AS VARCHAR)), 'Value', 'Flag', upper(p_name)] AS names
    FROM part
  )
), based AS (
  SELECT *, CASE lower(trim(raw_name)) {pins}
    ELSE trim(regexp_replace(lower(regexp_replace(trim(raw_name), '\\(([^)]*)\\)', ' \\1', 'g')), '[^0-9a-z]+', '_', 'g'), '_')
    END AS base_name
  FROM headers
)""".replace("{pins}", " ".join(f"WHEN '{raw}' THEN '{name}'" for raw, name in PINNED_NAMES.items()))

SUFFIXED = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY dataset_code, base_name ORDER BY ordinal) - 1 AS n FROM based
), named AS (
  SELECT dataset_code, ordinal, raw_name, base_name,
    CASE WHEN n = 0 THEN base_name ELSE concat(base_name, '_', CAST((
      -- the n-th suffix that no header of the dataset bears as its own name
      SELECT min(k) FROM (
        SELECT k, row_number() OVER (ORDER BY k) AS place
        FROM (SELECT unnest(range(1, 40)) AS k)
        WHERE numbered.base_name <> 'value' OR k <> numbered.taken
      ) WHERE place = n) AS VARCHAR)) END AS column_name
  FROM (
    SELECT *, coalesce(max(CASE WHEN base_name IN ('value_1', 'value_2') THEN CAST(right(base_name, 1) AS INTEGER) END)
      OVER (PARTITION BY dataset_code), -1) AS taken
    FROM numbered
  ) AS numbered
)"""

ROLE = """CASE WHEN {c} IN ('value', 'year') THEN {c} WHEN {c} = 'flag_code' THEN 'flag'
    WHEN {c} LIKE '%\\_code' ESCAPE '\\' THEN 'code' WHEN {c} LIKE '%\\_label' ESCAPE '\\' THEN 'label' ELSE 'attribute' END"""

MEMBERS = """
members AS (
  SELECT l_orderkey AS archive, l_linenumber AS member_index, l_partkey AS part, l_suppkey AS supplier,
    concat('dir/', CAST(l_partkey AS VARCHAR), CASE WHEN l_linestatus = 'F' THEN '_E_Flags' ELSE '_E_All_Data' END,
      CASE WHEN l_returnflag = 'R' THEN '.txt' ELSE '.CSV' END) AS name,
    CAST(l_quantity AS BIGINT) AS size
  FROM lineitem
)"""

LOG = """
log AS (
  SELECT user_id AS dataset_code, event_id AS line,
    CASE event_type WHEN 'purchase' THEN 'imported' WHEN 'click' THEN 'downloaded' WHEN 'view' THEN 'zip_invalid' ELSE 'failed' END AS state,
    CASE WHEN event_id % 3 <> 0 THEN value END AS expected_size
  FROM events
)"""

INVENTORY = """
inventory AS (
  SELECT concat('p', CAST(p_partkey AS VARCHAR)) AS dataset_code,
    concat(CAST(p_size AS VARCHAR), CASE p_partkey % 5 WHEN 0 THEN 'KB' WHEN 1 THEN ' MB' WHEN 2 THEN '.5kb' WHEN 3 THEN '' ELSE ' parsecs' END) AS file_size,
    CASE WHEN p_partkey % 4 <> 0 THEN p_partkey * 10 END AS file_rows,
    concat('https://example.org/bulk/', replace(p_name, ' ', '_'), CASE p_partkey % 3 WHEN 0 THEN '.zip' WHEN 1 THEN '.ZIP/' ELSE '/data' END) AS url,
    CASE p_partkey % 5 WHEN 0 THEN p_size * 1024 WHEN 1 THEN p_size * 1048576 WHEN 2 THEN p_size * 1024 + 512 WHEN 3 THEN p_size END::BIGINT AS size_bytes
  FROM part
)"""

LOOKUP = """
lookup AS (
  SELECT CASE WHEN n_nationkey % 2 = 0 THEN upper(n_name) ELSE concat(' ', n_name, '  ') END AS area_name,
    n_nationkey % 3 <> 0 AS is_country,
    CASE WHEN n_nationkey % 4 = 0 THEN n_nationkey + 1990 END::INTEGER AS valid_from,
    CASE WHEN n_nationkey % 7 = 0 THEN n_nationkey + 2000 END::INTEGER AS valid_to
  FROM nation WHERE n_nationkey % 5 <> 0
)"""

CLASSIFIED = """
areas AS (
  SELECT DISTINCT area_code, area_label FROM wide_sales
  UNION
  SELECT area_code, CASE WHEN CAST(area_code AS INTEGER) % 2 = 1 THEN concat(area_label, ' (former)') ELSE area_label END FROM wide_orders
), classified AS (
  SELECT CAST(area_code AS INTEGER) AS area_code,
    coalesce(max(area_label) FILTER (WHERE area_name IS NOT NULL), max(area_label)) AS area_label,
    bool_or(is_country) AS is_country,
    CAST(NULL AS INTEGER) AS valid_from, CAST(NULL AS INTEGER) AS valid_to
  FROM areas LEFT JOIN lookup ON lower(trim(area_label)) = lower(trim(area_name))
  GROUP BY area_code
)"""

VALID = """
valid AS (
  SELECT c.area_code, c.area_label, c.is_country, l.valid_from, l.valid_to
  FROM classified c LEFT JOIN lookup l ON lower(trim(c.area_label)) = lower(trim(l.area_name))
    AND (l.valid_from IS NOT NULL OR l.valid_to IS NOT NULL)
)"""

PROVENANCE = """
provenance AS (
  SELECT concat('O', CAST(o_orderkey AS VARCHAR)) AS dataset_code,
    coalesce(lines, 0) + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS file_rows_declared,
    coalesce(lines, 0) - CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS rows_imported,
    coalesce(lines, 0) AS source_csv_rows, o_orderkey % 4 = 0 AS is_filtered,
    CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'imported' END AS import_status,
    strftime(o_orderdate, '%Y-%m-%d') AS date_update
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
)"""

SALES_FACT = """SELECT CAST(area_code AS INTEGER) AS area_code, CAST(item_code AS INTEGER) AS item_code,
    CAST(element_code AS INTEGER) AS element_code, CAST(year AS INTEGER) AS year,
    {value} AS value, flag_code FROM wide_sales"""

SALES_TYPED = """SELECT domain_code, domain, CAST(area_code AS INTEGER) AS area_code, {m49} AS area_code_m49, area_label,
    CAST(item_code AS INTEGER) AS item_code, item_label, CAST(element_code AS INTEGER) AS element_code, element_label,
    CAST(year_code AS INTEGER) AS year_code, CAST(year AS INTEGER) AS year, unit, CAST(value AS INTEGER) AS value, flag_code
  FROM wide_sales"""

SALES_VIEW = """SELECT 'LI' AS dataset_code, CAST(area_code AS INTEGER) AS area_code, CAST(item_code AS INTEGER) AS item_code,
    CAST(element_code AS INTEGER) AS element_code, CAST(year AS INTEGER) AS year, CAST(value AS INTEGER) AS value, flag_code,
    substr(area_code_m49, 2) AS area_code_m49, area_label, item_label, element_label, year_code FROM wide_sales"""

DIM_MEMBERS = """
  SELECT DISTINCT 'domain' AS stem, 'LI' AS dataset_code, domain_code AS member_key, domain AS attributes FROM wide_sales
  UNION ALL SELECT DISTINCT 'area', 'LI', area_code, concat(substr(area_code_m49, 2), '|', area_label) FROM wide_sales
  UNION ALL SELECT DISTINCT 'item', 'LI', item_code, item_label FROM wide_sales
  UNION ALL SELECT DISTINCT 'element', 'LI', element_code, element_label FROM wide_sales
  UNION ALL SELECT DISTINCT 'year', 'LI', year, year_code FROM wide_sales"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _value(expression: str) -> str:
    return SALES_FACT.replace("{value}", expression)


NUMBER_OK = "regexp_full_match(value, '-?[0-9]+(\\.[0-9]+)?')"
INT_VALUE = "CAST(value AS INTEGER)"

# Types of the three sources, as the type rule of the reference data gives them.
_TYPES = {
    "LI": {
        "int": ["area_code", "item_code", "element_code", "year_code", "year", "value"],
        "string": ["domain_code", "domain", "area_code_m49", "area_label", "item_label", "element_label", "unit", "flag_code"],
    },
    "TR": {
        "int": ["reporter_country_code", "partner_country_code", "year_code", "year"],
        "double": ["value"],
        "string": [
            "reporter_country_label", "partner_country_label", "item_code", "item_label",
            "iso_currency_code", "iso_currency_label", "flag_code",
        ],
    },
    "OR": {
        "int": ["area_code"],
        "string": ["area_label", "item_code", "item_label", "year", "value", "flag_code"],
    },
}
_SOURCE_OF = {"LI": "wide_sales", "TR": "wide_trade", "OR": "wide_orders"}


def _type_sql() -> str:
    """Types by trying casts on every cell."""
    rows = []
    for code, kinds in _TYPES.items():
        for names in kinds.values():
            for name in names:
                cell = f"nullif({name}, '')"
                plain = "regexp_full_match({c}, '-?(0|[1-9][0-9]*)')".format(c=cell)
                number = "regexp_full_match({c}, '-?((0|[1-9][0-9]*)(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')".format(c=cell)
                rows.append(
                    f"""SELECT '{code}' AS dataset_code, '{name}' AS column_name,
                    CASE WHEN count({cell}) = 0 THEN 'string'
                      WHEN bool_and({plain} AND TRY_CAST({cell} AS INTEGER) IS NOT NULL) THEN 'int'
                      WHEN bool_and({plain} AND TRY_CAST({cell} AS BIGINT) IS NOT NULL) THEN 'bigint'
                      WHEN bool_and({number}) THEN 'double' ELSE 'string' END AS type_name
                    FROM {_SOURCE_OF[code]}"""
                )
    return _with(SALES, TRADE, ORDERS) + "\nUNION ALL ".join(rows)


def _marker_sql() -> str:
    names = [name for kinds in _TYPES["LI"].values() for name in kinds]
    return _with(SALES) + "\nUNION ALL ".join(
        f"SELECT '{n}' AS column_name, count({n}) AS non_null, count(*) FILTER (WHERE {n} LIKE '''%') AS marked FROM wide_sales"
        for n in names
    )


def _constant_sql() -> str:
    kept = ["domain_code", "area_code", "item_code", "element_code", "unit", "flag_code"]
    return _with(SALES) + "\nUNION ALL ".join(
        f"""SELECT '{n}' AS column_name, min({n}) AS constant_value FROM wide_sales
        HAVING count(DISTINCT {n}) = 0 OR (count(DISTINCT {n}) = 1 AND count({n}) = count(*))"""
        for n in kept
    )


ORACLES: dict[str, str] = {
    "csv_scan": _with(ORDERS, ORDERS_BROKEN) + "SELECT * FROM broken",
    "encoding_audit": """SELECT r_name AS region,
        CASE r_regionkey % 3 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'latin-1' ELSE 'utf-16' END AS encoding, count(*) AS physical_rows
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "archive_audit": """SELECT concat('p', CAST(p_partkey AS VARCHAR), '.zip') AS archive, p_partkey % 7 NOT IN (1, 2) AS ok,
        CASE WHEN p_partkey % 7 = 2 THEN 'data.csv' END AS bad_member,
        CASE p_partkey % 7 WHEN 1 THEN 'bad zip' WHEN 2 THEN 'crc mismatch' END AS reason,
        CASE WHEN p_partkey % 7 NOT IN (1, 2) THEN true END AS right_hash FROM part""",
    "size_check": """SELECT p_partkey AS dataset_code, p_partkey * 3 + 100 AS length,
        CASE WHEN p_partkey % 4 <> 0 THEN p_partkey * 3 + 100 + (p_partkey % 3) * 50 END AS declared_bytes,
        CASE WHEN p_partkey % 4 = 0 THEN true ELSE (p_partkey % 3) * 50 <= (p_partkey * 3 + 100 + (p_partkey % 3) * 50) * CAST(0.1 AS DOUBLE) END AS size_ok
        FROM part""",
    "pick_main_member": _with(MEMBERS) + """SELECT archive, member_index, part, supplier, name, size FROM (
        SELECT *, row_number() OVER (PARTITION BY archive ORDER BY size DESC, member_index, part, supplier, name) AS rn
        FROM members WHERE lower(name) LIKE '%.csv') WHERE rn = 1""",
    "pick_flag_member": _with(MEMBERS) + """SELECT archive, member_index, part, supplier, name, size FROM (
        SELECT *, row_number() OVER (PARTITION BY archive ORDER BY size, member_index, part, supplier, name) AS rn
        FROM members WHERE lower(name) LIKE '%.csv' AND lower(name) LIKE '%flag%') WHERE rn = 1""",
    "latest_state": _with(LOG) + """SELECT dataset_code, max_by(state, line) AS state,
        max_by(expected_size, line) FILTER (WHERE expected_size IS NOT NULL) AS expected_size FROM log GROUP BY dataset_code""",
    "flag_legend": """SELECT 'OR' AS dataset_code, o_orderstatus AS flag_code, min(concat(o_orderstatus, ' ', o_orderpriority)) AS flag_description
        FROM orders WHERE o_orderkey % 11 <> 0 GROUP BY o_orderstatus""",
    "fact_replace": _with(SALES) + _value(INT_VALUE),
    "raw_copy": _with(SALES) + SALES_TYPED.replace("{m49}", "area_code_m49"),
    "compact_table": _with(ORDERS) + "SELECT count(*) AS row_count, CAST(sum(length(value)) AS BIGINT) AS value_chars, true AS not_larger FROM wide_orders",
    "table_counts": _with(SALES, ORDERS) + f"""SELECT 'data_li' AS table_name, count(*) AS row_count FROM wide_sales
        UNION ALL SELECT 'data_or', count(*) FROM wide_orders
        UNION ALL SELECT 'dim_area', (SELECT count(*) FROM (SELECT DISTINCT area_code, area_code_m49, area_label FROM wide_sales))
          + (SELECT count(*) FROM (SELECT DISTINCT area_code, area_label FROM wide_orders))
        UNION ALL SELECT 'dim_item', (SELECT count(*) FROM (SELECT DISTINCT item_code, item_label FROM wide_sales))
          + (SELECT count(*) FROM (SELECT DISTINCT item_code, item_label FROM wide_orders))
        UNION ALL SELECT concat('dim_', stem), count(*) FROM ({DIM_MEMBERS}) WHERE stem IN ('domain', 'element', 'year') GROUP BY stem
        UNION ALL SELECT 'meta_column_mapping', (SELECT count(*) FROM (DESCRIBE SELECT * FROM wide_sales)) + (SELECT count(*) FROM (DESCRIBE SELECT * FROM wide_orders))
        UNION ALL SELECT 'meta_constant_column', (SELECT (count(DISTINCT domain_code) = 1)::INT + (count(DISTINCT unit) = 1)::INT FROM wide_sales)""",
    "rename_project": _with(ORDERS) + "SELECT * FROM wide_orders",
    "normalize_headers": _with(HEADERS) + "SELECT * FROM based",
    "dedupe_headers": _with(HEADERS, SUFFIXED) + "SELECT * FROM named",
    "header_roles": _with(HEADERS) + "SELECT dataset_code, ordinal, base_name, " + ROLE.replace("{c}", "base_name") + " AS role FROM based",
    "dimension_groups": _with(HEADERS, SUFFIXED) + """, stems AS (
          SELECT DISTINCT dataset_code, left(column_name, length(column_name) - 5) AS stem FROM named WHERE column_name LIKE '%\\_code' ESCAPE '\\'
        ), owned AS (
          SELECT n.dataset_code, n.column_name, max_by(s.stem, length(s.stem)) AS stem
          FROM named n JOIN stems s ON n.dataset_code = s.dataset_code AND (n.column_name = s.stem OR starts_with(n.column_name, concat(s.stem, '_')))
          GROUP BY ALL
        ), keyed AS (
          SELECT *, CASE WHEN stem = 'year' AND bool_or(column_name = 'year') OVER (PARTITION BY dataset_code, stem) THEN 'year' ELSE concat(stem, '_code') END AS key_column FROM owned
        )
        SELECT dataset_code, stem, key_column, column_name AS attribute_column FROM keyed WHERE column_name <> key_column""",
    "column_mapping": _with(HEADERS, SUFFIXED) + "SELECT dataset_code, concat('data_', lower(dataset_code)) AS table_name, raw_name AS original_column_name, column_name AS normalized_column_name, " + ROLE.replace("{c}", "column_name") + " AS inferred_role FROM named",
    "year_filter": _with(ORDERS) + "SELECT * FROM wide_orders WHERE year IN ('1995', '1997')",
    "year_filter_open": _with(ORDERS) + "SELECT * FROM wide_orders WHERE TRY_CAST(year AS BIGINT) = 1995 OR TRY_CAST(year AS BIGINT) >= 1999",
    "select_include": _with(INVENTORY) + "SELECT dataset_code, file_size FROM inventory WHERE upper(dataset_code) IN ('P1', 'P17', 'P150')",
    "select_exclude": _with(INVENTORY) + "SELECT dataset_code, file_size FROM inventory WHERE upper(dataset_code) NOT IN ('P1', 'P17', 'P150')",
    "needs_refetch": _with(LOG) + """SELECT p_partkey AS dataset_code,
        NOT (p_partkey % 7 <> 0 AND coalesce(state IN ('downloaded', 'zip_valid', 'importing', 'imported'), false)) AS needs_fetch
        FROM part LEFT JOIN (SELECT dataset_code, max_by(state, line) AS state FROM log GROUP BY dataset_code) s ON p_partkey = s.dataset_code""",
    "fact_reduced": _with(SALES) + _value(INT_VALUE),
    "strip_marker": _with(SALES) + """SELECT item_code, CASE WHEN flag_code = 'F' THEN substr(area_code_m49, 2) END AS area_code_m49,
        CASE WHEN flag_code = 'F' THEN concat('''', area_label) ELSE area_label END AS area_label, value FROM wide_sales""",
    "labelled_view": _with(SALES) + SALES_VIEW,
    "archive_to_star": """
        WITH rows AS (
          SELECT concat('R', CAST(n_regionkey AS VARCHAR)) AS dataset_code, n_name AS area_label,
            o_orderpriority AS item_label, CAST(year(o_orderdate) AS INTEGER) AS year,
            CASE WHEN o_orderkey % 11 <> 0 THEN concat('Status ', o_orderstatus) END AS flag_description,
            CAST(floor(o_totalprice) AS BIGINT) AS value
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
        noted AS (
          SELECT dataset_code, count(*) FILTER (year >= 1995) AS rows_imported,
            count(*) AS file_rows_declared, count(*) FILTER (year = 1995) AS raw_rows
          FROM rows GROUP BY dataset_code)
        SELECT dataset_code, area_label, item_label, year, flag_description, count(*) AS n,
          CAST(sum(value) AS BIGINT) AS total, rows_imported, file_rows_declared, raw_rows
        FROM rows JOIN noted USING (dataset_code) WHERE year >= 1995 GROUP BY ALL""",
    "import_dataset": _with(SALES) + SALES_VIEW,
    "labelled_trade": _with(TRADE) + """SELECT 'TR' AS dataset_code, CAST(reporter_country_code AS INTEGER) AS reporter_country_code,
        CAST(partner_country_code AS INTEGER) AS partner_country_code, item_code, iso_currency_code, CAST(year AS INTEGER) AS year,
        CAST(value AS DOUBLE) AS value, flag_code, reporter_country_label, partner_country_label, item_label, iso_currency_label, year_code FROM wide_trade""",
    "manual_dim_join": _with(SALES) + """SELECT area_label, item_label, CAST(year AS INTEGER) AS year, CAST(value AS DOUBLE) AS value, flag_code,
        CASE WHEN flag_code = 'F' THEN 'Final' END AS flag_description FROM wide_sales""",
    "hetero_key_join": _with(SALES, TRADE) + """SELECT 'LI' AS dataset_code, item_code, item_label, count(*) AS n FROM wide_sales GROUP BY ALL
        UNION ALL SELECT 'TR', item_code, item_label, count(*) FROM wide_trade GROUP BY ALL""",
    "classify_areas": _with(SALES, ORDERS, LOOKUP, CLASSIFIED) + "SELECT * FROM classified",
    "validity_fill": _with(SALES, ORDERS, LOOKUP, CLASSIFIED, VALID) + "SELECT * FROM valid",
    "validity_coverage": _with(SALES, ORDERS, LOOKUP, CLASSIFIED, VALID) + "SELECT count(*) FILTER (WHERE valid_from IS NOT NULL OR valid_to IS NOT NULL) AS dated_areas FROM valid",
    "dim_append": _with(SALES) + """, stored AS (SELECT DISTINCT item_code, item_label FROM wide_sales WHERE year <= '1995')
        SELECT 'LI' AS dataset_code, item_code, item_label FROM stored
        UNION ALL SELECT DISTINCT 'LI', item_code, upper(item_label) FROM wide_sales WHERE year > '1995' AND item_code NOT IN (SELECT item_code FROM stored)""",
    "infer_types": _type_sql(),
    "marker_profile": _marker_sql(),
    "constant_columns": _constant_sql(),
    "rowcount_audit": _with(ORDERS) + """, marked AS (
          SELECT area_code, CAST(area_code AS INTEGER) % 2 = 1 AND length(value) % 5 = 0 AS broken FROM wide_orders)
        SELECT area_code AS dataset_code, count(*) AS imported, count(*) AS source_rows,
          CASE WHEN bool_or(broken) THEN 'quote-parity' ELSE 'line-count' END AS method FROM marked GROUP BY area_code""",
    "lossless_verdict": _with(PROVENANCE) + """SELECT dataset_code, rows_imported, source_csv_rows,
        is_filtered OR rows_imported = source_csv_rows AS is_lossless, rows_imported - file_rows_declared AS declared_difference FROM provenance""",
    "build_summary": _with(PROVENANCE) + """SELECT (SELECT count(*) FROM provenance WHERE import_status = 'imported') AS datasets_imported,
        (SELECT count(*) FROM provenance WHERE import_status <> 'imported') AS datasets_failed, build_id, completed_at
        FROM (SELECT concat('B', CAST(o_orderkey AS VARCHAR)) AS build_id, strftime(o_orderdate, '%Y-%m-%d') AS completed_at FROM orders)
        ORDER BY completed_at DESC, build_id DESC LIMIT 1""",
    "validate_facts": _with(ORDERS) + "SELECT 'data_em' AS table_name, 'empty' AS problem FROM (SELECT count(*) AS n FROM wide_orders WHERE year = '1800') WHERE n = 0",
    "selection_estimate": _with(INVENTORY) + "SELECT count(*) AS datasets, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_bytes, CAST(coalesce(sum(file_rows), 0) AS BIGINT) AS total_rows FROM inventory",
    "incoming_years": _with(ORDERS) + "SELECT DISTINCT TRY_CAST(year AS BIGINT) AS year FROM wide_orders WHERE TRY_CAST(year AS BIGINT) IS NOT NULL ORDER BY year",
    "rows_per_dataset": "SELECT concat('O', CAST(l_orderkey AS VARCHAR)) AS dataset_code, count(*) AS n FROM lineitem GROUP BY l_orderkey",
    "recent_datasets": _with(PROVENANCE) + "SELECT dataset_code, date_update FROM provenance ORDER BY date_update DESC, dataset_code LIMIT 10",
    "dim_extract": _with(SALES) + DIM_MEMBERS,
    "dim_replace": _with(SALES, ORDERS) + """SELECT DISTINCT 'LI' AS dataset_code, area_code, lower(area_label) AS area_label FROM wide_sales WHERE flag_code = 'F'
        UNION ALL SELECT DISTINCT 'OR', area_code, area_label FROM wide_orders""",
    "dim_widen": _with(SALES, TRADE) + """SELECT DISTINCT 'LI' AS dataset_code, item_code, item_label, CAST(NULL AS VARCHAR) AS item_family FROM wide_sales
        UNION ALL SELECT DISTINCT 'TR', item_code, item_label, substr(item_code, 1, 5) FROM wide_trade""",
    "upsert_dataset": _with(PROVENANCE) + """, changes AS (
          SELECT concat('O', CAST(o_orderkey + CASE WHEN o_orderkey % 10 = 0 THEN 100000000 ELSE 0 END AS VARCHAR)) AS dataset_code,
            CAST(-1 AS BIGINT) AS rows_imported, 'refreshed' AS import_status FROM orders WHERE o_orderkey % 10 < 3)
        SELECT dataset_code, rows_imported, import_status FROM provenance WHERE dataset_code NOT IN (SELECT dataset_code FROM changes)
        UNION ALL SELECT * FROM changes""",
    "build_record": "SELECT concat('build-', o_orderstatus) AS build_id, count(*) AS datasets_imported, min(o_orderkey) AS first_key FROM orders GROUP BY o_orderstatus",
    "year_merge": _with(SALES) + _value("CAST(value AS INTEGER) + CASE WHEN year >= '1998' THEN 1000 ELSE 0 END"),
    "year_merge_idempotent": _with(SALES) + _value("CAST(value AS INTEGER) + CASE WHEN year IN ('1996', '1999') THEN 1000 ELSE 0 END"),
    "merge_constant_restore": _with(SALES) + """SELECT CAST(area_code AS INTEGER) AS area_code, CAST(item_code AS INTEGER) AS item_code,
        CAST(element_code AS INTEGER) AS element_code, CAST(year AS INTEGER) AS year, CAST(value AS INTEGER) AS value, flag_code,
        CASE WHEN year >= '1998' AND flag_code = 'F' THEN 'kg' ELSE 't' END AS unit
        FROM wide_sales WHERE year >= '1998' OR element_code = '5510'""",
    "unified_long": _with(SALES, TRADE, ORDERS) + """SELECT 'LI' AS dataset_code, area_code, item_code, element_code, year, value, flag_code FROM wide_sales
        UNION ALL SELECT 'TR', NULL, item_code, NULL, year, value, flag_code FROM wide_trade
        UNION ALL SELECT 'OR', area_code, item_code, NULL, year, value, flag_code FROM wide_orders""",
    "rehydrate": _with(SALES) + SALES_TYPED.replace("{m49}", "substr(area_code_m49, 2)"),
    "label_search": _with(SALES) + "SELECT DISTINCT CAST(item_code AS INTEGER) AS item_code, item_label FROM wide_sales WHERE regexp_matches(item_label, 'RING|bolt', 'i')",
    "series_one": _with(SALES) + """SELECT CAST(year AS INTEGER) AS year, CAST(item_code AS INTEGER) AS item_code, item_label, CAST(value AS INTEGER) AS value, flag_code
        FROM wide_sales WHERE area_label = 'NATION_3' AND element_label = 'New' ORDER BY year""",
    "series_many": _with(SALES) + """SELECT area_label, CAST(year AS INTEGER) AS year, CAST(value AS DOUBLE) AS value FROM wide_sales
        WHERE area_label IN ('NATION_3', 'NATION_4', 'NATION_20')""",
    "value_safe_cast": _with(ORDERS) + "SELECT area_code, year, value, TRY_CAST(value AS DOUBLE) AS number FROM wide_orders",
    "content_hash": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "parse_sizes": _with(INVENTORY) + "SELECT dataset_code, file_size, size_bytes FROM inventory",
    "archive_names": _with(INVENTORY) + """SELECT dataset_code, url, CASE WHEN lower(rtrim(url, '/')) LIKE '%.zip'
        THEN regexp_extract(rtrim(url, '/'), '[^/]*$') ELSE concat(dataset_code, '.zip') END AS archive_name FROM inventory""",
    "inventory_scan": """SELECT concat('p', CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 3 = 1 THEN 'b' ELSE '' END) AS dataset_code,
        p_name AS dataset_name, CASE WHEN p_partkey % 3 <> 1 AND p_partkey % 6 <> 0 THEN p_type END AS topic,
        CASE WHEN p_partkey % 3 <> 1 THEN concat('https://example.org/p', CAST(p_partkey AS VARCHAR)) END AS file_location,
        CASE WHEN p_partkey % 3 <> 1 THEN concat(CAST(p_size AS VARCHAR), 'KB') END AS file_size,
        CASE WHEN p_partkey % 3 = 1 THEN CAST(p_size AS BIGINT) WHEN p_partkey % 4 <> 0 THEN p_partkey * 7 END AS file_rows,
        CASE WHEN p_partkey % 3 = 1 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS kept_field,
        concat('doc/', CAST(p_partkey AS VARCHAR)) AS source_url FROM part""",
}
