"""SQL text shared by the oracles: the invoice view and the cleaned lines."""

from tillroll.schema import NON_SALES_CODES

INVOICES = """
invoices AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS invoice,
         CASE WHEN l_partkey % 97 = 0 THEN 'POST' WHEN l_partkey % 97 = 1 THEN 'D'
              ELSE CAST(l_partkey AS VARCHAR) END AS stock_code,
         p_name AS description, l_quantity AS quantity,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS invoice_date,
         l_extendedprice / l_quantity AS price,
         CASE WHEN o_orderkey % 23 <> 0 THEN o_custkey END AS customer_id,
         n_name AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'C' || CAST(o_orderkey AS VARCHAR),
         CASE WHEN l_partkey % 97 = 0 THEN 'POST' WHEN l_partkey % 97 = 1 THEN 'D'
              ELSE CAST(l_partkey AS VARCHAR) END,
         p_name, -l_quantity, l_shipdate, l_extendedprice / l_quantity,
         CASE WHEN o_orderkey % 23 <> 0 THEN o_custkey END, n_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE l_returnflag = 'R')"""

SALES_CODES = "(" + ",".join(f"'{code}'" for code in NON_SALES_CODES) + ")"
CUSTOMER_CODES = SALES_CODES[:-1] + ",'D')"


def kept(name, codes):
    """Lines with a customer and a countable code."""
    return f"""
{name} AS (SELECT * FROM invoices WHERE customer_id IS NOT NULL AND stock_code NOT IN {codes})"""


def purchases(name, source):
    """Purchases of ``source`` that no cancellation follows within 14 whole days."""
    return f"""
{name}_cancelled AS (
  SELECT stock_code, abs(quantity) AS size, price, customer_id, list(DISTINCT invoice_date) AS moments
  FROM {source} WHERE invoice LIKE 'C%' GROUP BY ALL),
{name} AS (
  SELECT p.* FROM {source} p LEFT JOIN {name}_cancelled c ON c.stock_code = p.stock_code
    AND c.size = abs(p.quantity) AND c.price = p.price AND c.customer_id = p.customer_id
  WHERE invoice NOT LIKE 'C%' AND coalesce(len(list_filter(moments,
    lambda m: m >= p.invoice_date AND m < p.invoice_date + INTERVAL 15 DAY)), 0) = 0)"""


def with_ctes(*ctes):
    return "WITH " + ",".join(ctes) + "\n"


SALES = (INVOICES, kept("sales_kept", SALES_CODES), purchases("sales_lines", "sales_kept"))
CUSTOMER = (INVOICES, kept("customer_kept", CUSTOMER_CODES), purchases("customer_lines", "customer_kept"))
