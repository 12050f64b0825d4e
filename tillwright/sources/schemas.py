"""Logical tables and their column types."""

from pyspark.sql import types as T

TEXT, DAY, LONG, INT = T.StringType(), T.DateType(), T.LongType(), T.IntegerType()
MONEY, AMOUNT, PRICE = T.DecimalType(12, 2), T.DecimalType(14, 2), T.DecimalType(12, 4)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PRODUCTS = _struct(product_id=LONG, product_name=TEXT, category=TEXT, cost_price=MONEY, retail_price=MONEY)
STORES = _struct(store_id=LONG, store_location=TEXT, monthly_rent=MONEY)
SALES = _struct(sale_id=LONG, product_id=LONG, store_id=LONG, sale_date=DAY, quantity=INT, total_amount=AMOUNT)
CATEGORY_ORDERS = _struct(order_id=LONG, customer_id=LONG, category=TEXT, amount=LONG, order_date=DAY)
TRANSACTIONS = _struct(
    InvoiceNo=TEXT, StockCode=TEXT, Description=TEXT, Quantity=INT,
    InvoiceDate=T.TimestampType(), UnitPrice=PRICE, CustomerID=LONG,
)
