"""Queries and oracles for reading, cleaning and weekly sales."""

from pyspark.sql import functions as F

from tillroll.catalog.oracle_base import CUSTOMER, CUSTOMER_CODES, INVOICES, SALES, kept, with_ctes
from tillroll.catalog.registry import query
from tillroll.functions.amounts import abs_quantity, line_total
from tillroll.functions.dates import normalize_invoice_date, parse_invoice_date, quarter_bounds
from tillroll.operators import cleaning, sales
from tillroll.schema import COLUMN_NAMES, NON_CUSTOMER_CODES
from tillroll.session import new_path
from tillroll.sources.invoices import order_invoice_lines, scan_invoices


def lines(spark, sf_dir, **columns):
    return order_invoice_lines(spark, sf_dir, **columns)


def text_time(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def text_day(column):
    return F.col(column).cast("string").alias(column)


LINE_SQL = """invoice, stock_code, quantity, strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date,
       price, customer_id"""


def line_columns(df):
    return df.select("invoice", "stock_code", "quantity", text_time("invoice_date"), "price", "customer_id")


@query(
    "scan_invoices",
    with_ctes(INVOICES)
    + f"""SELECT {LINE_SQL}, 'the "' || description || '", ' || stock_code AS description, country FROM invoices""",
)
def scan(spark, sf_dir):
    """All lines written as CSV files, columns in another order and texts with quotes and commas, and read back."""
    df = lines(spark, sf_dir, description=True, country=True)
    told = F.concat(F.lit('the "'), "description", F.lit('", '), "stock_code")
    df = df.withColumn("invoice_date", text_time("invoice_date")).withColumn("description", told)
    headers = {new: old for old, new in COLUMN_NAMES.items() if old != "CustomerID"}
    path = new_path(spark, "lines")
    df.select(*[F.col(c).alias(headers[c]) for c in reversed(df.columns)]).write.csv(path, header=True, quote='"', escape='"')
    return scan_invoices(spark, path).withColumn("quantity", F.col("quantity").cast("double"))


@query(
    "drop_missing_customers",
    with_ctes(INVOICES) + f"SELECT {LINE_SQL} FROM invoices WHERE customer_id IS NOT NULL",
)
def drop_missing(spark, sf_dir):
    return line_columns(cleaning.drop_missing_customers(lines(spark, sf_dir)))


@query(
    "exclude_stock_codes",
    with_ctes(INVOICES) + f"SELECT {LINE_SQL} FROM invoices WHERE stock_code NOT IN {CUSTOMER_CODES}",
)
def exclude_codes(spark, sf_dir):
    return line_columns(cleaning.exclude_stock_codes(lines(spark, sf_dir), NON_CUSTOMER_CODES))


@query(
    "remove_cancellations",
    with_ctes(INVOICES) + f"SELECT {LINE_SQL} FROM invoices WHERE invoice NOT LIKE 'C%'",
)
def no_cancellations(spark, sf_dir):
    return line_columns(cleaning.remove_cancellations(lines(spark, sf_dir)))


@query(
    "split_cancellations",
    with_ctes(INVOICES)
    + f"""SELECT CASE WHEN invoice LIKE 'C%' THEN 'cancellation' ELSE 'purchase' END AS side, {LINE_SQL}
FROM invoices""",
)
def split(spark, sf_dir):
    cancellations, purchases = cleaning.split_cancellations(lines(spark, sf_dir))
    return line_columns(cancellations).withColumn("side", F.lit("cancellation")).unionByName(
        line_columns(purchases).withColumn("side", F.lit("purchase"))
    )


@query(
    "match_cancellations",
    with_ctes(INVOICES, kept("kept", CUSTOMER_CODES))
    + """SELECT p.stock_code, abs(p.quantity) AS quantity, p.price, p.customer_id,
       strftime(p.invoice_date, '%Y-%m-%d %H:%M:%S') AS purchase_date,
       strftime(c.invoice_date, '%Y-%m-%d %H:%M:%S') AS cancel_date,
       CAST(min(date_sub('day', p.invoice_date, c.invoice_date)) AS INTEGER) AS days_between,
       count(*) AS matched_lines
FROM kept p JOIN kept c ON c.stock_code = p.stock_code AND abs(c.quantity) = abs(p.quantity)
  AND c.price = p.price AND c.customer_id = p.customer_id
WHERE p.invoice NOT LIKE 'C%' AND c.invoice LIKE 'C%' AND c.invoice_date >= p.invoice_date
  AND date_sub('day', p.invoice_date, c.invoice_date) <= 14
GROUP BY ALL""",
)
def match(spark, sf_dir):
    kept_lines = cleaning.exclude_stock_codes(
        cleaning.drop_missing_customers(lines(spark, sf_dir)), NON_CUSTOMER_CODES
    )
    return (
        cleaning.match_cancellations(kept_lines)
        .withColumn("matched_lines", F.col("purchase_lines") * F.col("cancel_lines"))
        .withColumn("purchase_date", text_time("purchase_date"))
        .withColumn("cancel_date", text_time("cancel_date"))
        .drop("purchase_lines", "cancel_lines")
    )


@query(
    "remove_instant_cancellations",
    with_ctes(*CUSTOMER)
    + f"""SELECT {LINE_SQL} FROM customer_lines
UNION ALL SELECT {LINE_SQL} FROM customer_kept WHERE invoice LIKE 'C%'""",
)
def no_instant(spark, sf_dir):
    kept_lines = cleaning.exclude_stock_codes(
        cleaning.drop_missing_customers(lines(spark, sf_dir)), NON_CUSTOMER_CODES
    )
    return line_columns(cleaning.remove_instant_cancellations(kept_lines))


@query("clean_sales_lines", with_ctes(*SALES) + f"SELECT {LINE_SQL} FROM sales_lines")
def sales_lines(spark, sf_dir):
    return line_columns(cleaning.clean_sales_lines(lines(spark, sf_dir)))


@query(
    "clean_customer_lines",
    with_ctes(*CUSTOMER)
    + """SELECT invoice, stock_code, quantity, CAST(CAST(invoice_date AS DATE) AS VARCHAR) AS invoice_date,
       price, customer_id FROM customer_lines""",
)
def customer_lines(spark, sf_dir):
    cleaned = cleaning.clean_customer_lines(lines(spark, sf_dir), normalize_dates=True)
    return cleaned.withColumn("invoice_date", text_day("invoice_date"))


@query(
    "line_total",
    with_ctes(*SALES)
    + """SELECT invoice, stock_code, CAST(CAST(quantity * price AS DECIMAL(18,2)) AS DOUBLE) AS total_price
FROM sales_lines""",
)
def totals(spark, sf_dir):
    cleaned = cleaning.clean_sales_lines(lines(spark, sf_dir))
    total = line_total(F.col("quantity"), F.col("price")).cast("double")
    return cleaned.select("invoice", "stock_code", total.alias("total_price"))


@query(
    "abs_quantity",
    with_ctes(INVOICES) + "SELECT invoice, stock_code, abs(quantity) AS quantity FROM invoices",
)
def absolute(spark, sf_dir):
    return lines(spark, sf_dir).select("invoice", "stock_code", abs_quantity(F.col("quantity")).alias("quantity"))


@query(
    "parse_invoice_date",
    with_ctes(INVOICES)
    + """SELECT invoice, stock_code, CAST(hour(CAST(strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)) AS INTEGER)
  AS invoice_hour, strftime(invoice_date, '%d.%m.%Y') AS invoice_day FROM invoices""",
)
def parse(spark, sf_dir):
    written = lines(spark, sf_dir).select("invoice", "stock_code", text_time("invoice_date"))
    moment = parse_invoice_date(F.col("invoice_date"))
    return written.select(
        "invoice",
        "stock_code",
        F.hour(moment).alias("invoice_hour"),
        F.date_format(moment, "dd.MM.yyyy").alias("invoice_day"),
    )


@query(
    "normalize_invoice_date",
    with_ctes(INVOICES)
    + "SELECT invoice, stock_code, CAST(CAST(invoice_date AS DATE) AS VARCHAR) AS invoice_day FROM invoices",
)
def normalize(spark, sf_dir):
    day = normalize_invoice_date(F.col("invoice_date")).cast("string")
    return lines(spark, sf_dir).select("invoice", "stock_code", day.alias("invoice_day"))


@query(
    "quarter_bounds",
    with_ctes(INVOICES, "days AS (SELECT DISTINCT CAST(invoice_date AS DATE) AS day FROM invoices)")
    + """SELECT CAST(day AS VARCHAR) AS day,
  CAST(CAST(q - INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS previous_begin,
  CAST(CAST(q - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS previous_end,
  CAST(CAST(q AS DATE) AS VARCHAR) AS current_begin,
  CAST(CAST(q + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS current_end,
  CAST(CAST(q + INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS next_begin,
  CAST(CAST(q + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS next_end
FROM (SELECT day, date_trunc('quarter', day) AS q FROM days)""",
)
def bounds(spark, sf_dir):
    day = normalize_invoice_date(F.col("invoice_date")).alias("day")
    framed = quarter_bounds(lines(spark, sf_dir).select(day).distinct(), "day")
    return framed.select(*[text_day(c) for c in framed.columns])


def weekly_sql(by):
    names = [f"{b}, " for b in by]
    keys = "".join(names)
    match_by = "".join(f" AND s.{b} = w.{b}" for b in by)
    return f"""
sums AS (
  SELECT {keys}CAST(CAST(date_trunc('week', invoice_date) AS DATE) + 6 AS DATE) AS week_end,
         sum(CAST(quantity * price AS DECIMAL(18,2))) AS total
  FROM sales_lines GROUP BY ALL),
spine AS (
  SELECT {keys}CAST(unnest(range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 7 DAY)) AS DATE) AS week_end
  FROM (SELECT {keys}min(week_end) AS lo, max(week_end) AS hi FROM sums GROUP BY ALL)),
weekly AS (
  SELECT {"".join(f"w.{b}, " for b in by)}w.week_end, COALESCE(CAST(total AS DOUBLE), 0.0) AS total_price
  FROM spine w LEFT JOIN sums s ON s.week_end = w.week_end{match_by})"""


WEEKLY = (*SALES, weekly_sql([]))
COUNTRY_WEEKLY = (*SALES, weekly_sql(["country"]))


def country_weekly(spark, sf_dir):
    return sales.weekly_sales(cleaning.clean_sales_lines(lines(spark, sf_dir, country=True)), ["country"])


@query(
    "weekly_sales",
    with_ctes(*WEEKLY) + "SELECT CAST(week_end AS VARCHAR) AS week_end, total_price FROM weekly",
)
def weekly(spark, sf_dir):
    result = sales.weekly_sales(cleaning.clean_sales_lines(lines(spark, sf_dir)))
    return result.withColumn("week_end", text_day("week_end"))


@query(
    "weekly_sales_by_country",
    with_ctes(*COUNTRY_WEEKLY)
    + "SELECT country, CAST(week_end AS VARCHAR) AS week_end, total_price FROM weekly",
)
def weekly_by_country(spark, sf_dir):
    return country_weekly(spark, sf_dir).withColumn("week_end", text_day("week_end"))


@query(
    "zero_sales_weeks",
    with_ctes(*COUNTRY_WEEKLY)
    + "SELECT country, CAST(week_end AS VARCHAR) AS week_end, total_price FROM weekly WHERE total_price < 1",
)
def zero_weeks(spark, sf_dir):
    return sales.zero_sales_weeks(country_weekly(spark, sf_dir)).withColumn("week_end", text_day("week_end"))


@query(
    "preview",
    with_ctes(*WEEKLY)
    + "SELECT CAST(week_end AS VARCHAR) AS week_end, total_price FROM weekly ORDER BY week_end LIMIT 8",
)
def first_weeks(spark, sf_dir):
    result = sales.weekly_sales(cleaning.clean_sales_lines(lines(spark, sf_dir)))
    return sales.preview(result, ["week_end"]).withColumn("week_end", text_day("week_end"))
