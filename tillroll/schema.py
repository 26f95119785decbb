"""Input schema and the fixed values that decide which lines count."""

from pyspark.sql import types as T

INVOICE_SCHEMA = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Customer ID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

# file header -> column name used everywhere else
COLUMN_NAMES = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "price",
    "Customer ID": "customer_id",
    "CustomerID": "customer_id",
    "Country": "country",
}

# Stock codes that are not products. Discounts ("D") change sales
# totals, so only the customer list drops them.
NON_SALES_CODES = [
    "ADJUST", "ADJUST2", "BANK CHARGES", "C2", "CRUK",
    "DOT", "M", "POST", "TEST001", "TEST002",
]
NON_CUSTOMER_CODES = NON_SALES_CODES + ["D"]

CANCELLATION_PREFIX = "C"
CANCELLATION_DAYS = 14

FEATURES = [
    "recency",
    "frequency",
    "diff_purchase_t_1",
    "diff_purchase_t_2",
    "purchase_subsequent_quarters",
]
