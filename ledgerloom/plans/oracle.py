"""Independent SQL statements of every registered query (DuckDB dialect).

They restate each query over the driver's tables with plain SQL, sharing
only the adapter mapping (same fixed values as ``sources.tables``). The
correctness gate runs them next to the Spark DataFrames at sf0.01.
"""

from __future__ import annotations

from ledgerloom.schemas import FALSE_TOKENS, TRUE_TOKENS
from ledgerloom.sources.tables import SEGMENT_ACTIVE_TEXT, STATUS_MAP


def _case(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


PRICE = (
    "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_discount >= 0.05 "
    "THEN -l_extendedprice ELSE l_extendedprice END"
)

HEADS = f"""heads AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderpriority AS channel,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at,
         {_case('o_orderstatus', STATUS_MAP)} AS payment_status
  FROM orders)"""

ITEMS = f"""items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         l_linenumber AS item_pos,
         CASE WHEN l_linenumber % 2 <> 1 THEN l_quantity END AS item_qty,
         CASE WHEN l_linenumber % 2 = 1 THEN l_quantity END AS item_quantity,
         CASE WHEN l_linenumber % 2 <> 1 THEN {PRICE} END AS item_unit_price,
         CASE WHEN l_linenumber % 2 = 1 THEN {PRICE} END AS item_price
  FROM lineitem)"""

LINES = """lines AS (
  SELECT * FROM items JOIN heads USING (order_id))"""

NORM = """norm AS (
  SELECT order_id, item_pos, customer_id, channel, created_at, payment_status,
         TRY_CAST(COALESCE(item_qty, item_quantity) AS DECIMAL(18,4)) AS item_qty,
         TRY_CAST(COALESCE(item_unit_price, item_price) AS DECIMAL(18,4)) AS item_unit_price
  FROM lines)"""

PAID_NORM = """paid AS (SELECT * FROM norm WHERE payment_status = 'paid')"""

GOOD = """good AS (SELECT * FROM paid WHERE item_unit_price >= 0)"""

REJECTS = """rejects AS (SELECT * FROM paid WHERE item_unit_price < 0)"""

FIRST = """kept AS (
  SELECT * FROM good
  QUALIFY row_number() OVER (
    PARTITION BY order_id
    ORDER BY created_at NULLS LAST, item_pos NULLS LAST, customer_id NULLS LAST,
             channel NULLS LAST, payment_status NULLS LAST, item_qty NULLS LAST,
             item_unit_price NULLS LAST) = 1)"""

ALL_GOOD = """kept AS (SELECT * FROM good)"""

PER_ORDER = """per_order AS (
  SELECT order_id, customer_id, channel, created_at,
         SUM(item_qty) AS items_sold,
         SUM(item_qty * item_unit_price) AS gross_revenue_eur
  FROM kept GROUP BY order_id, customer_id, channel, created_at)"""


def _sql_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def active_sql(x: str) -> str:
    t = f"lower(trim(CAST({x} AS VARCHAR)))"
    return (
        f"CASE WHEN {t} IN ({_sql_list(TRUE_TOKENS)}) THEN true "
        f"WHEN {t} IN ({_sql_list(FALSE_TOKENS)}) THEN false "
        f"ELSE COALESCE(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') "
        f"THEN TRY_CAST({t} AS DECIMAL(38,0)) <> 0 END, false) END"
    )


def date_sql(x: str) -> str:
    t = f"trim({x})"
    layouts = ["%Y/%m/%d", "%m/%d/%Y", "%m/%d/%Y %H:%M:%S", "%Y/%m/%d %H:%M", "%Y%m%d", "%B %d, %Y", "%d-%b-%Y"]
    layouts += ["%d %B %Y", "%b %d, %Y %I:%M %p", "%m.%d.%Y", "%a, %d %b %Y %H:%M:%S GMT", "%Y%m%d%H%M%S"]
    tries = ", ".join(f"CAST(TRY_STRPTIME({t}, '{f}') AS DATE)" for f in layouts)
    return f"COALESCE(TRY_CAST({t} AS DATE), {tries})"


def dbl(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,4)) AS DOUBLE)"


CUST_RAW = f"""cust_raw AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, n_name AS city,
         {_case('c_mktsegment', SEGMENT_ACTIVE_TEXT)} AS is_active
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

CUST = f"""cust AS (
  SELECT * FROM (SELECT customer_id, city, {active_sql('is_active')} AS is_active FROM cust_raw)
  QUALIFY row_number() OVER (PARTITION BY customer_id
                             ORDER BY city NULLS LAST, is_active NULLS LAST) = 1)"""

ACTIVE = """active AS (SELECT customer_id, city FROM cust WHERE is_active)"""

REFUNDS_RAW = """refunds_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS amount,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at
  FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.08)"""

REFUND_SUMS = """refund_sums AS (
  SELECT order_id, SUM(COALESCE(TRY_CAST(amount AS DECIMAL(18,4)), 0)) AS refunds_eur
  FROM refunds_raw GROUP BY order_id)"""

ENRICHED = f"""enriched AS (
  SELECT p.order_id, p.customer_id, p.channel, p.created_at, p.items_sold, p.gross_revenue_eur,
         COALESCE(r.refunds_eur, 0) AS refunds_eur, a.city,
         {date_sql('p.created_at')} AS order_date
  FROM per_order p
  LEFT JOIN refund_sums r ON p.order_id = r.order_id
  JOIN active a ON p.customer_id = a.customer_id)"""

REPORT_SELECT = f"""
SELECT order_date AS date, city, channel,
       COUNT(DISTINCT order_id) AS orders_count,
       COUNT(DISTINCT customer_id) AS unique_customers,
       {dbl('SUM(items_sold)')} AS items_sold,
       {dbl('SUM(gross_revenue_eur)')} AS gross_revenue_eur,
       {dbl('SUM(refunds_eur)')} AS refunds_eur,
       {dbl('SUM(gross_revenue_eur) - SUM(refunds_eur)')} AS net_revenue_eur
FROM enriched GROUP BY order_date, city, channel"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


LINE_CHAIN = [HEADS, ITEMS, LINES, NORM, PAID_NORM, GOOD]
ENRICH_CHAIN = [PER_ORDER, CUST_RAW, CUST, ACTIVE, REFUNDS_RAW, REFUND_SUMS, ENRICHED]
REPORT = f"report AS ({REPORT_SELECT})"

# The month of the file-based queries.
MONTH_FIRST, MONTH_LAST = "1997-03-01", "1997-03-31"

IN_MONTH = f"TRY_CAST(created_at AS DATE) BETWEEN DATE '{MONTH_FIRST}' AND DATE '{MONTH_LAST}'"

# Position of a line inside its (sorted) document array, 0-based.
EXPLODED = """ex AS (
  SELECT h.order_id, h.customer_id, h.channel, h.created_at, h.payment_status,
         CASE WHEN i.order_id IS NULL THEN NULL ELSE CAST(row_number() OVER (
           PARTITION BY h.order_id
           ORDER BY i.item_pos, COALESCE(i.item_qty, i.item_quantity),
                    COALESCE(i.item_unit_price, i.item_price)) - 1 AS INTEGER) END AS item_pos,
         i.item_pos AS item_line_no, i.item_qty, i.item_quantity, i.item_unit_price, i.item_price
  FROM heads h {join} items i ON h.order_id = i.order_id)"""

N_ITEMS = """doc_rows AS (
  SELECT h.order_id, h.customer_id, h.channel, h.created_at, h.payment_status,
         CAST(COALESCE(n.n, 0) AS BIGINT) AS n_items
  FROM heads h LEFT JOIN (SELECT order_id, COUNT(*) AS n FROM items GROUP BY order_id) n
       ON h.order_id = n.order_id)"""

SIX = f"""SELECT order_id, customer_id, channel, created_at,
       {dbl('item_qty')} AS item_qty, {dbl('item_unit_price')} AS item_unit_price"""


def money(x: str) -> str:
    return f"COALESCE(printf('%.2f', CAST(ROUND(CAST({x} AS DECIMAL(38,8)), 2) AS DOUBLE)), '')"


CSV_LINE = (
    "concat_ws(';', strftime(date, '%Y-%m-%d'), COALESCE(city, ''), COALESCE(channel, ''), "
    "CAST(orders_count AS VARCHAR), CAST(unique_customers AS VARCHAR), "
    + ", ".join(money(c) for c in ("items_sold", "gross_revenue_eur", "refunds_eur", "net_revenue_eur"))
    + ")"
)


def statements() -> dict[str, str]:
    line_report = with_ctes(*LINE_CHAIN, FIRST, *ENRICH_CHAIN)
    out = {
        "scan_csv_customers": with_ctes(CUST_RAW) + " SELECT customer_id, city, is_active FROM cust_raw",
        "scan_csv_parts": with_ctes(CUST_RAW)
        + """ SELECT customer_id, CASE WHEN customer_id LIKE '%7' THEN '"new"' || chr(10) || city ELSE city END AS city, is_active
              FROM cust_raw""",
        "scan_csv_refunds": with_ctes(REFUNDS_RAW) + f" SELECT order_id, {dbl('amount')} AS amount, created_at FROM refunds_raw",
        "scan_json_month": with_ctes(HEADS, ITEMS, N_ITEMS)
        + f" SELECT *, substr(created_at, 1, 7) AS order_month FROM doc_rows WHERE {IN_MONTH}",
        "scan_json_month_files": with_ctes(HEADS, ITEMS, N_ITEMS)
        + f" SELECT *, 'orders_' || CAST(TRY_CAST(created_at AS DATE) AS VARCHAR) || '.json' AS source_file"
        f" FROM doc_rows WHERE {IN_MONTH}",
        "open_schema_lines": with_ctes(HEADS, ITEMS, EXPLODED.format(join="JOIN"))
        + f""" SELECT order_id, customer_id, 'note of ' || customer_id AS note, item_pos, item_line_no AS line_no,
                 {dbl('TRY_CAST(COALESCE(item_qty, item_quantity) AS DECIMAL(18,4))')} AS item_qty,
                 {dbl('TRY_CAST(COALESCE(item_unit_price, item_price) AS DECIMAL(18,4))')} AS item_unit_price
               FROM ex WHERE {IN_MONTH}""",
        "union_evolving": with_ctes(ITEMS)
        + " SELECT order_id, item_pos, item_qty, item_unit_price FROM items WHERE item_qty IS NOT NULL"
        " UNION ALL BY NAME"
        " SELECT order_id, item_pos, item_quantity, item_price FROM items WHERE item_quantity IS NOT NULL",
        "paid_orders": with_ctes(HEADS) + " SELECT * FROM heads WHERE payment_status = 'paid'",
        "explode_lines": with_ctes(HEADS, ITEMS, EXPLODED.format(join="JOIN")) + " SELECT * FROM ex",
        "explode_lines_outer": with_ctes(HEADS, ITEMS, EXPLODED.format(join="LEFT JOIN")) + " SELECT * FROM ex",
        "coalesce_alternates": with_ctes(HEADS, ITEMS, EXPLODED.format(join="JOIN"))
        + f""" SELECT order_id, item_pos,
                 {dbl('TRY_CAST(COALESCE(item_qty, item_quantity) AS DECIMAL(18,4))')} AS item_qty,
                 {dbl('TRY_CAST(COALESCE(item_unit_price, item_price) AS DECIMAL(18,4))')} AS item_unit_price
               FROM ex""",
        "lines_good": with_ctes(*LINE_CHAIN) + f" {SIX} FROM good",
        "lines_rejected": with_ctes(*LINE_CHAIN[:-1], REJECTS) + f" {SIX} FROM rejects",
        "rejects_file": with_ctes(*LINE_CHAIN[:-1], REJECTS) + f" {SIX} FROM rejects",
        "normalize_active": with_ctes(CUST_RAW)
        + f" SELECT customer_id, city, is_active AS is_active_text, {active_sql('is_active')} AS is_active FROM cust_raw",
        "safe_numeric": f"""
WITH t AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_linenumber = 6 THEN ''
              WHEN l_linenumber = 4 THEN '9' || lpad(CAST(l_orderkey AS VARCHAR), 14, '0') || '.25'
              ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS VARCHAR)
                   || CASE WHEN l_linenumber = 5 THEN '37' ELSE '' END
         END AS amount_text
  FROM lineitem)
SELECT order_id, amount_text,
       TRY_CAST(amount_text AS DOUBLE) AS amount,
       COALESCE(TRY_CAST(amount_text AS DOUBLE), 0) AS amount_or_zero
FROM t""",
        "parse_dates": f"""
WITH t AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CASE o_orderkey % 17
           WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
           WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
           WHEN 3 THEN strftime(o_orderdate, '%m/%d/%Y')
           WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d')
           WHEN 5 THEN strftime(o_orderdate, '%-m/%-d/%Y')
           WHEN 6 THEN strftime(o_orderdate, '%m/%d/%Y %H:%M:%S')
           WHEN 7 THEN strftime(o_orderdate, '%Y%m%d')
           WHEN 8 THEN strftime(o_orderdate, '%B %-d, %Y')
           WHEN 9 THEN strftime(o_orderdate, '%d-%b-%Y')
           WHEN 10 THEN strftime(o_orderdate, '%Y/%m/%d %H:%M')
           WHEN 11 THEN strftime(o_orderdate, '%-d %B %Y')
           WHEN 12 THEN strftime(o_orderdate, '%b %-d, %Y %-I:%M %p')
           WHEN 13 THEN strftime(o_orderdate, '%m.%d.%Y')
           WHEN 14 THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S GMT')
           WHEN 15 THEN strftime(o_orderdate, '%Y%m%d%H%M%S')
           ELSE 'week of ' || strftime(o_orderdate, '%Y%m%d') END AS created_text
  FROM orders)
SELECT order_id, created_text, {date_sql('created_text')} AS order_date FROM t""",
        "first_line_per_order": with_ctes(*LINE_CHAIN, FIRST)
        + f""" SELECT order_id, item_pos, customer_id, channel, created_at, payment_status,
                 {dbl('item_qty')} AS item_qty, {dbl('item_unit_price')} AS item_unit_price FROM kept""",
        "first_order_document": with_ctes(HEADS, ITEMS)
        + f""",
docs AS (
  SELECT DISTINCT i.order_id, (i.item_qty IS NULL) AS odd,
         CASE WHEN i.item_qty IS NULL THEN substr(h.created_at, 1, 10) || ' 12:00:00' ELSE h.created_at END AS created_at
  FROM items i JOIN heads h ON i.order_id = h.order_id),
first_doc AS (
  SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY created_at, odd) = 1),
doc_lines AS (
  SELECT f.order_id, f.created_at,
         CAST(row_number() OVER (PARTITION BY f.order_id
              ORDER BY i.item_pos, COALESCE(i.item_qty, i.item_quantity),
                       COALESCE(i.item_unit_price, i.item_price)) - 1 AS INTEGER) AS item_pos,
         TRY_CAST(COALESCE(i.item_qty, i.item_quantity) AS DECIMAL(18,4)) AS item_qty,
         TRY_CAST(COALESCE(i.item_unit_price, i.item_price) AS DECIMAL(18,4)) AS item_unit_price
  FROM first_doc f JOIN items i ON f.order_id = i.order_id AND f.odd = (i.item_qty IS NULL))
SELECT order_id, created_at, item_pos, {dbl('item_qty')} AS item_qty, {dbl('item_unit_price')} AS item_unit_price
FROM doc_lines""",
        "unique_customers_dim": with_ctes(CUST_RAW)
        + f""",
both_lists AS (
  SELECT customer_id, city, is_active FROM cust_raw
  UNION ALL SELECT customer_id, lower(city), is_active FROM cust_raw),
typed AS (SELECT customer_id, city, {active_sql('is_active')} AS is_active FROM both_lists)
SELECT * FROM typed
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY city NULLS LAST, is_active NULLS LAST) = 1""",
        "line_gross": with_ctes(*LINE_CHAIN)
        + f""" SELECT order_id, item_pos, {dbl('item_qty')} AS item_qty, {dbl('item_unit_price')} AS item_unit_price,
                 {dbl('item_qty * item_unit_price')} AS line_gross FROM good""",
        "per_order": with_ctes(*LINE_CHAIN, FIRST, PER_ORDER)
        + f""" SELECT order_id, customer_id, channel, created_at, {dbl('items_sold')} AS items_sold,
                 {dbl('gross_revenue_eur')} AS gross_revenue_eur FROM per_order""",
        "per_order_active": with_ctes(*LINE_CHAIN, FIRST, PER_ORDER, CUST_RAW, CUST, ACTIVE)
        + f""" SELECT p.customer_id, p.order_id, p.channel, p.created_at, {dbl('p.items_sold')} AS items_sold,
                 {dbl('p.gross_revenue_eur')} AS gross_revenue_eur, a.city
               FROM per_order p JOIN active a ON p.customer_id = a.customer_id""",
        "refunds_per_order": with_ctes(REFUNDS_RAW, REFUND_SUMS)
        + f" SELECT order_id, {dbl('refunds_eur')} AS refunds_eur FROM refund_sums",
        "per_order_refunds": with_ctes(*LINE_CHAIN, FIRST, PER_ORDER, REFUNDS_RAW, REFUND_SUMS)
        + f""" SELECT p.order_id, p.customer_id, p.channel, p.created_at, {dbl('p.items_sold')} AS items_sold,
                 {dbl('p.gross_revenue_eur')} AS gross_revenue_eur,
                 {dbl('COALESCE(r.refunds_eur, 0)')} AS refunds_eur
               FROM per_order p LEFT JOIN refund_sums r ON p.order_id = r.order_id""",
        "orders_clean": line_report
        + f""" SELECT order_id, customer_id, city, channel, order_date, {dbl('items_sold')} AS items_sold,
                 {dbl('gross_revenue_eur')} AS gross_revenue_eur FROM enriched""",
        "daily_city_sales": line_report + REPORT_SELECT,
        "daily_city_sales_all_lines": with_ctes(*LINE_CHAIN, ALL_GOOD, *ENRICH_CHAIN) + REPORT_SELECT,
        "report_dates": with_ctes(*LINE_CHAIN, FIRST, *ENRICH_CHAIN, REPORT)
        + " SELECT DISTINCT date, last_day(date) AS month_end FROM report WHERE date IS NOT NULL",
        "daily_csv_export": with_ctes(*LINE_CHAIN, FIRST, *ENRICH_CHAIN, REPORT)
        + f""" SELECT 'day' AS target, strftime(date, '%Y%m%d') AS day, {CSV_LINE} AS line
               FROM report WHERE date IS NOT NULL
               UNION ALL
               SELECT 'all' AS target, CAST(NULL AS VARCHAR) AS day, {CSV_LINE} AS line FROM report""",
        "sorted_csv_lines": with_ctes(*LINE_CHAIN, FIRST, *ENRICH_CHAIN, REPORT)
        + f""" SELECT CAST(row_number() OVER (ORDER BY date NULLS FIRST, city NULLS FIRST, channel NULLS FIRST) AS BIGINT) AS line_no,
                 {CSV_LINE} AS line FROM report""",
        "union_clashing": """
SELECT CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE 'o' END || CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(l_linenumber AS BIGINT) AS line_no,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS qty,
       CASE WHEN l_orderkey % 2 <> 0 THEN l_linestatus END AS status
FROM lineitem""",
        "quality_counters": with_ctes(*LINE_CHAIN, FIRST)
        + """ SELECT 'orders_loaded' AS metric, CAST(COUNT(*) AS BIGINT) AS value FROM heads
              UNION ALL SELECT 'orders_paid', COUNT(*) FROM heads WHERE payment_status = 'paid'
              UNION ALL SELECT 'lines_paid', COUNT(*) FROM paid
              UNION ALL SELECT 'lines_rejected', COUNT(*) FROM paid WHERE item_unit_price < 0
              UNION ALL SELECT 'lines_null_price', COUNT(*) FROM paid WHERE item_unit_price IS NULL
              UNION ALL SELECT 'lines_kept', COUNT(*) FROM kept""",
        "month_job": with_ctes(
            HEADS.replace("FROM orders)", "FROM orders) , month_heads AS (SELECT * FROM heads WHERE " + IN_MONTH + ")"),
            ITEMS,
            LINES.replace("JOIN heads", "JOIN month_heads"),
            *LINE_CHAIN[3:],
            FIRST,
            *ENRICH_CHAIN,
        )
        + REPORT_SELECT,
        "landed_orders": with_ctes(HEADS, ITEMS, N_ITEMS) + " SELECT * FROM doc_rows",
    }
    # the staged month holds one malformed line
    out["month_job_counters"] = (
        with_ctes(
            HEADS.replace("FROM orders)", "FROM orders) , month_heads AS (SELECT * FROM heads WHERE " + IN_MONTH + ")"),
            ITEMS,
            LINES.replace("JOIN heads", "JOIN month_heads"),
            *LINE_CHAIN[3:],
            FIRST,
            *ENRICH_CHAIN,
        )
        + """ SELECT 'orders_corrupt' AS metric, CAST(1 AS BIGINT) AS value
              UNION ALL SELECT 'orders_loaded', COUNT(*) FROM month_heads
              UNION ALL SELECT 'orders_paid', COUNT(*) FROM month_heads WHERE payment_status = 'paid'
              UNION ALL SELECT 'lines_paid', COUNT(*) FROM paid
              UNION ALL SELECT 'lines_rejected', COUNT(*) FROM paid WHERE item_unit_price < 0
              UNION ALL SELECT 'lines_null_price', COUNT(*) FROM paid WHERE item_unit_price IS NULL
              UNION ALL SELECT 'lines_good', COUNT(*) FROM good
              UNION ALL SELECT 'lines_kept', COUNT(*) FROM kept
              UNION ALL SELECT 'orders_enriched', COUNT(*) FROM enriched"""
    )
    # E1 gives the same report whichever input layout it reads
    out["month_job_daily_files"] = out["month_job"]
    return out
