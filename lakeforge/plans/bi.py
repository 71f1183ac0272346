"""The ten BI queries on Bronze.

Each query aggregates the large side on its join key *before* joining the
smaller side (Catalyst does not push an aggregate below a join), so the
shuffle carries one partial row per key and map task; a hot key collapses
in the map-side partial aggregate.  Top-k queries end in ``orderBy().limit``
(``TakeOrderedAndProject``) with a unique tie-break column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .gold import warehouse


def _bronze(spark: SparkSession, d: str, table: str, *cols: str) -> DataFrame:
    """Columns of the stored day-1 Bronze table."""
    return warehouse(spark, d).bronze(table).select(*cols)


def bi_product_list(spark: SparkSession, d: str) -> DataFrame:
    """B1: every product with its category name (inner join)."""
    p = _bronze(spark, d, "product", "ProductCategoryID", "Name", "ProductNumber", "ListPrice")
    pc = _bronze(spark, d, "product_category", "ProductCategoryID", "Name")
    return p.alias("p").join(pc.alias("pc"), "ProductCategoryID").select(
        F.col("pc.Name").alias("ProductCategory"),
        F.col("p.Name").alias("ProductName"),
        F.col("p.ProductNumber").alias("ProductNumber"),
        F.col("p.ListPrice").alias("ListPrice"))


def bi_orders_per_customer(spark: SparkSession, d: str) -> DataFrame:
    """B2: orders per customer, customers without orders count 0."""
    c = _bronze(spark, d, "customer", "CustomerID", "FirstName", "LastName")
    per_cust = (_bronze(spark, d, "sales_order_header", "CustomerID", "SalesOrderID")
                .groupBy("CustomerID").agg(F.count("SalesOrderID").alias("n")))
    return (c.join(per_cust, "CustomerID", "left")
            .select(F.col("CustomerID").alias("Customer"), "FirstName", "LastName",
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("TotalOrders"))
            .orderBy(F.col("TotalOrders").desc(), F.col("Customer")))


def bi_top5_products(spark: SparkSession, d: str) -> DataFrame:
    """Five highest list prices (tie-break: product id)."""
    p = _bronze(spark, d, "product", "ProductID", "Name", "ListPrice")
    return (p.orderBy(F.col("ListPrice").desc(), F.col("ProductID")).limit(5)
            .select("Name", "ListPrice"))


def bi_on_sale_products(spark: SparkSession, d: str) -> DataFrame:
    """Products without a sell end date, by list price."""
    p = _bronze(spark, d, "product", "ProductID", "Name", "ListPrice", "SellEndDate")
    return (p.filter(F.col("SellEndDate").isNull())
            .orderBy(F.col("ListPrice").desc(), F.col("ProductID"))
            .select("Name", "ListPrice", "SellEndDate"))


def bi_global_revenue(spark: SparkSession, d: str) -> DataFrame:
    """Total of all order totals."""
    h = _bronze(spark, d, "sales_order_header", "TotalDue")
    return h.agg(F.sum("TotalDue").cast("decimal(38,4)").alias("GlobalRevenue"))


def bi_orders_by_region(spark: SparkSession, d: str) -> DataFrame:
    """Orders per state/province of the bill-to address."""
    per_addr = (_bronze(spark, d, "sales_order_header", "BillToAddressID", "SalesOrderID")
                .groupBy("BillToAddressID").agg(F.count("SalesOrderID").alias("n")))
    a = _bronze(spark, d, "address", "AddressID", "StateProvince")
    return (a.join(per_addr, a.AddressID == per_addr.BillToAddressID)
            .groupBy("StateProvince").agg(F.sum("n").cast("long").alias("OrderCount"))
            .orderBy("StateProvince"))


def bi_products_per_category(spark: SparkSession, d: str) -> DataFrame:
    """Number of products per category name."""
    per_cat = (_bronze(spark, d, "product", "ProductCategoryID", "ProductID")
               .groupBy("ProductCategoryID").agg(F.count("ProductID").alias("n")))
    pc = _bronze(spark, d, "product_category", "ProductCategoryID", "Name")
    return (pc.join(per_cat, "ProductCategoryID")
            .groupBy(F.col("Name").alias("CategoryName"))
            .agg(F.sum("n").cast("long").alias("ProductCount")))


def bi_top3_customers(spark: SparkSession, d: str) -> DataFrame:
    """Three customers with the highest revenue (grouped by id, id not shown)."""
    per_cust = (_bronze(spark, d, "sales_order_header", "CustomerID", "TotalDue")
                .groupBy("CustomerID").agg(F.sum("TotalDue").alias("rev")))
    c = _bronze(spark, d, "customer", "CustomerID", "FirstName", "LastName")
    return (c.join(per_cust, "CustomerID")
            .select("CustomerID", "FirstName", "LastName",
                    F.col("rev").cast("decimal(38,4)").alias("TotalRevenue"))
            .orderBy(F.col("TotalRevenue").desc(), F.col("CustomerID")).limit(3)
            .select("FirstName", "LastName", "TotalRevenue"))


def bi_revenue_per_category(spark: SparkSession, d: str) -> DataFrame:
    """Line revenue per category name (line ⋈ product ⋈ category)."""
    per_prod = (_bronze(spark, d, "sales_order_detail", "ProductID", "LineTotal")
                .groupBy("ProductID").agg(F.sum("LineTotal").alias("rev")))
    p = _bronze(spark, d, "product", "ProductID", "ProductCategoryID")
    pc = _bronze(spark, d, "product_category", "ProductCategoryID", "Name")
    return (per_prod.join(p, "ProductID").join(pc, "ProductCategoryID")
            .groupBy(F.col("Name").alias("CategoryName"))
            .agg(F.sum("rev").cast("decimal(38,6)").alias("Revenue"))
            .orderBy(F.col("Revenue").desc(), F.col("CategoryName")))


def bi_top_discount_product(spark: SparkSession, d: str) -> DataFrame:
    """Product with the largest SUM(discount fraction * quantity)."""
    per_prod = (_bronze(spark, d, "sales_order_detail", "ProductID", "UnitPriceDiscount", "OrderQty")
                .groupBy("ProductID")
                .agg(F.sum(F.col("UnitPriceDiscount") * F.col("OrderQty")).alias("disc")))
    p = _bronze(spark, d, "product", "ProductID", "Name")
    return (p.join(per_prod, "ProductID")
            .select("ProductID", "Name", F.col("disc").cast("decimal(38,4)").alias("TotalDiscountAmount"))
            .orderBy(F.col("TotalDiscountAmount").desc(), F.col("ProductID")).limit(1)
            .select("Name", "TotalDiscountAmount"))


QUERIES = {
    "bi_product_list": bi_product_list,
    "bi_orders_per_customer": bi_orders_per_customer,
    "bi_top5_products": bi_top5_products,
    "bi_on_sale_products": bi_on_sale_products,
    "bi_global_revenue": bi_global_revenue,
    "bi_orders_by_region": bi_orders_by_region,
    "bi_products_per_category": bi_products_per_category,
    "bi_top3_customers": bi_top3_customers,
    "bi_revenue_per_category": bi_revenue_per_category,
    "bi_top_discount_product": bi_top_discount_product,
}
