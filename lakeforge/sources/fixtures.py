"""Source-shaped (PascalCase, "Bronze") frames derived from the given
tables, and the day-2 snapshot rules.

All natural ids are the given key + 1, because natural key 0 belongs to the
unknown member.  Every frame is a lazy DataFrame over the given parquet
tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import SILVER
from ..operators.keys import assign_keys, number_and_deal
from .tables import read_table

# --- fixed values: fixture timestamps and load times ---------------------
D0 = "2020-01-01 00:00:00"
D1 = "2024-01-01 00:00:00"
D2 = "2024-01-02 00:00:00"
LOAD_1 = "2024-01-01 06:00:00"
LOAD_2 = "2024-01-02 06:00:00"


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _rowguid(table: str, *keys: str) -> Column:
    parts = [F.lit(table)]
    for k in keys:
        parts += [F.lit(":"), F.col(k).cast("string")]
    return F.md5(F.concat(*parts))


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _finish(df: DataFrame, table: str) -> DataFrame:
    """Cast to the source types of the contract, in contract order."""
    spec = SILVER[table]
    return df.selectExpr(*[f"CAST({src} AS {typ}) AS {src}" for src, _, typ in spec.columns])


def src_address(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # nation/region are fixed-size reference tables (25 and 5 rows).
    n = F.broadcast(read_table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey"))
    r = F.broadcast(read_table(spark, d, "region", "r_regionkey", "r_name"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    out = j.select(
        (k + 1).alias("AddressID"),
        F.concat(F.lit("Street "), F.col("c_name")).alias("AddressLine1"),
        _null_if(k % 3 == 0, F.col("c_mktsegment")).alias("AddressLine2"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("StateProvince"),
        F.col("r_name").alias("CountryRegion"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("PostalCode"),
        ts(D1).alias("ModifiedDate"),
    ).withColumn("rowguid", _rowguid("address", "AddressID"))
    return _finish(out, "address")


def src_customer(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    cid = (k + 1).cast("string")
    out = c.select(
        (k + 1).alias("CustomerID"),
        (k % 2 == 0).alias("NameStyle"),
        _null_if(k % 4 == 0, F.lit("Mr.")).alias("Title"),
        F.col("c_mktsegment").alias("FirstName"),
        F.lit(None).cast("string").alias("MiddleName"),
        F.col("c_name").alias("LastName"),
        F.lit(None).cast("string").alias("Suffix"),
        F.concat(F.lit("Company "), (k % 50).cast("string")).alias("CompanyName"),
        F.concat(F.lit("rep"), (k % 9).cast("string")).alias("SalesPerson"),
        F.concat(F.lit("customer"), cid, F.lit("@example.com")).alias("EmailAddress"),
        F.concat(F.lit("555-"), F.lpad(cid, 7, "0")).alias("Phone"),
        F.md5(F.concat(F.lit("hash:"), cid)).alias("PasswordHash"),
        F.substring(F.md5(F.concat(F.lit("salt:"), cid)), 1, 8).alias("PasswordSalt"),
        ts(D1).alias("ModifiedDate"),
    ).withColumn("rowguid", _rowguid("customer", "CustomerID"))
    return _finish(out, "customer")


def src_customeraddress(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", "c_custkey")
    k = F.col("c_custkey")
    out = c.select(
        (k + 1).alias("CustomerID"),
        (k + 1).alias("AddressID"),
        F.when(k % 5 == 0, "Shipping").otherwise("Main Office").alias("AddressType"),
        ts(D1).alias("ModifiedDate"),
    ).withColumn("rowguid", _rowguid("customer_address", "CustomerID", "AddressID"))
    return _finish(out, "customer_address")


def src_salesorderheader(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_totalprice", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    odate = F.col("o_orderdate").cast("timestamp_ntz")
    total = F.col("o_totalprice").cast("decimal(19,4)")
    out = o.select(
        (k + 1).alias("SalesOrderID"),
        F.lit(1).alias("RevisionNumber"),
        odate.alias("OrderDate"),
        (odate + F.expr("INTERVAL 12 DAYS")).alias("DueDate"),
        _null_if(k % 4 == 0, odate + F.expr("INTERVAL 7 DAYS")).alias("ShipDate"),
        F.when(F.col("o_orderstatus") == "F", 5).when(F.col("o_orderstatus") == "P", 2)
        .otherwise(1).alias("Status"),
        (k % 2 == 0).alias("OnlineOrderFlag"),
        F.concat(F.lit("SO"), (k + 1).cast("string")).alias("SalesOrderNumber"),
        F.lit(None).cast("string").alias("PurchaseOrderNumber"),
        F.lit(None).cast("string").alias("AccountNumber"),
        (F.col("o_custkey") + 1).alias("CustomerID"),
        (F.col("o_custkey") + 1).alias("ShipToAddressID"),
        (F.col("o_custkey") + 1).alias("BillToAddressID"),
        F.col("o_orderpriority").alias("ShipMethod"),
        F.lit(None).cast("string").alias("CreditCardApprovalCode"),
        total.alias("SubTotal"),
        F.lit(0).alias("TaxAmt"),
        F.lit(0).alias("Freight"),
        total.alias("TotalDue"),
        F.lit(None).cast("string").alias("Comment"),
        ts(D1).alias("ModifiedDate"),
    ).withColumn("rowguid", _rowguid("sales_order_header", "SalesOrderID"))
    return _finish(out, "sales_order_header")


# Order of the per-order line number (the given line number is not unique).
DETAIL_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def src_salesorderdetail(spark: SparkSession, d: str) -> DataFrame:
    return _order_lines(spark, d)[0]


def _order_lines(spark: SparkSession, d: str) -> tuple[DataFrame, bool]:
    """The order lines, and whether they lie in ranges of their order."""
    li = read_table(spark, d, "lineitem", "l_orderkey", *DETAIL_ORDER)
    # line number per order; a hot order is split over tasks at scale
    li, dealt = number_and_deal(li, ["l_orderkey"], DETAIL_ORDER, "SalesOrderDetailID")
    price = F.col("l_extendedprice")
    out = li.select(
        (F.col("l_orderkey") + 1).alias("SalesOrderID"),
        "SalesOrderDetailID",
        F.col("l_quantity").alias("OrderQty"),
        (F.col("l_partkey") + 1).alias("ProductID"),
        price.cast("decimal(19,4)").alias("UnitPrice"),
        F.col("l_discount").cast("decimal(19,4)").alias("UnitPriceDiscount"),
        (price.cast("decimal(15,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
        .cast("decimal(38,6)").alias("LineTotal"),
        ts(D1).alias("ModifiedDate"),
    ).withColumn("rowguid", _rowguid("sales_order_detail", "SalesOrderID", "SalesOrderDetailID"))
    return _finish(out, "sales_order_detail"), dealt


def _dense_ids(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Dense rank over the distinct values of ``cols`` without NULLs."""
    return assign_keys(df.select(*cols).na.drop().distinct(), cols, key)


def _first_child(spark: SparkSession, d: str) -> Column:
    """Categories of types are numbered from 1; those of brands follow."""
    return read_table(spark, d, "part", "p_type").agg(F.count_distinct("p_type")).scalar()


# Parent of the categories whose parent is missing; no category has this id.
NO_PARENT = -1


def src_productcategory(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part", "p_type", "p_brand")
    roots = _dense_ids(p, ["p_type"], "root_id")
    kids = _dense_ids(p, ["p_type", "p_brand"], "kid_rank")
    root_rows = roots.select(
        F.col("root_id").alias("ProductCategoryID"),
        F.lit(None).cast("int").alias("ParentProductCategoryID"),
        F.col("p_type").alias("Name"))
    numbered = kids.join(roots, "p_type").withColumn("kid_id", _first_child(spark, d) + F.col("kid_rank"))
    kid_rows = numbered.select(
        F.col("kid_id").alias("ProductCategoryID"),
        F.when(F.col("kid_id") % 29 == 0, F.lit(NO_PARENT)).otherwise(F.col("root_id")).alias("ParentProductCategoryID"),
        F.concat_ws(" ", "p_type", "p_brand").alias("Name"))
    out = root_rows.unionByName(kid_rows).withColumn("ModifiedDate", ts(D1)) \
        .withColumn("rowguid", _rowguid("product_category", "ProductCategoryID"))
    return _finish(out, "product_category")


def _models(spark: SparkSession, d: str) -> DataFrame:
    return _dense_ids(read_table(spark, d, "part", "p_name"), ["p_name"], "model_id")


def src_productmodel(spark: SparkSession, d: str) -> DataFrame:
    m = _models(spark, d)
    out = m.select(
        F.col("model_id").alias("ProductModelID"),
        F.col("p_name").alias("Name"),
        _null_if(F.col("model_id") % 2 == 0, F.concat(F.lit("Catalog of "), F.col("p_name")))
        .alias("CatalogDescription"),
        ts(D1).alias("ModifiedDate"),
    ).withColumn("rowguid", _rowguid("product_model", "ProductModelID"))
    return _finish(out, "product_model")


def _model_cultures(spark: SparkSession, d: str) -> DataFrame:
    m = _models(spark, d)
    en = m.select("model_id", "p_name", F.lit(1).alias("k"), F.lit("en").alias("Culture"))
    fr = m.select("model_id", "p_name", F.lit(2).alias("k"), F.lit("fr").alias("Culture"))
    return en.unionByName(fr).withColumn("ProductDescriptionID", F.col("model_id") * 10 + F.col("k"))


def src_productdescription(spark: SparkSession, d: str) -> DataFrame:
    mc = _model_cultures(spark, d)
    out = mc.select(
        "ProductDescriptionID",
        F.concat(F.col("Culture"), F.lit(": "), F.col("p_name")).alias("Description"),
        ts(D1).alias("ModifiedDate"),
    ).withColumn("rowguid", _rowguid("product_description", "ProductDescriptionID"))
    return _finish(out, "product_description")


def src_productmodelproductdescription(spark: SparkSession, d: str) -> DataFrame:
    mc = _model_cultures(spark, d)
    out = mc.select(
        F.col("model_id").alias("ProductModelID"), "ProductDescriptionID", "Culture",
        ts(D1).alias("ModifiedDate"),
    ).withColumn("rowguid", _rowguid("product_model_product_description",
                                      "ProductModelID", "ProductDescriptionID", "Culture"))
    return _finish(out, "product_model_product_description")


def src_product(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size",
                   "p_retailprice")
    kids = _dense_ids(p, ["p_type", "p_brand"], "kid_rank")
    models = _models(spark, d)
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(19,4)")
    # kids/models are bounded by the distinct (type, brand) and name values;
    # AQE turns these joins into broadcasts at run time when they are small.
    j = (p.join(kids, ["p_type", "p_brand"], "left").join(models, "p_name", "left")
         .withColumn("kid_id", _first_child(spark, d) + F.col("kid_rank")))
    out = j.select(
        (k + 1).alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.concat(F.col("p_brand"), F.lit("-"), k.cast("string")).alias("ProductNumber"),
        _null_if(k % 7 == 0, F.split(F.col("p_name"), " ").getItem(0)).alias("Color"),
        price.alias("StandardCost"),
        price.alias("ListPrice"),
        F.col("p_size").cast("string").alias("Size"),
        _null_if(k % 5 == 0, F.col("p_size")).alias("Weight"),
        F.col("kid_id").alias("ProductCategoryID"),
        F.col("model_id").alias("ProductModelID"),
        ts(D0).alias("SellStartDate"),
        F.when(k % 4 == 0, ts(D1)).alias("SellEndDate"),
        F.when(k % 11 == 0, ts(D1)).alias("DiscontinuedDate"),
        F.lit(None).cast("binary").alias("ThumbNailPhoto"),
        F.lit(None).cast("string").alias("ThumbnailPhotoFileName"),
        ts(D1).alias("ModifiedDate"),
    ).withColumn("rowguid", _rowguid("product", "ProductID"))
    return _finish(out, "product")


SOURCES = {
    "address": src_address,
    "customer": src_customer,
    "customer_address": src_customeraddress,
    "sales_order_header": src_salesorderheader,
    "sales_order_detail": src_salesorderdetail,
    "product_category": src_productcategory,
    "product_model": src_productmodel,
    "product_description": src_productdescription,
    "product_model_product_description": src_productmodelproductdescription,
    "product": src_product,
}


# --- fixed values: day-2 snapshot rules -----------------------------------
# id = first source key column (day-1 value).  Deleted: id % 17 = 0;
# re-keyed: id % 19 = 5 -> id + the table's largest id; updated: id % 10 = 3
# (one attribute, ModifiedDate = D2); NULL filled: id % 23 = 7 (ModifiedDate
# unchanged).
DELETE_MOD, REKEY_MOD, REKEY_REM = 17, 19, 5
UPDATE_MOD, UPDATE_REM, FILL_MOD, FILL_REM = 10, 3, 23, 7

# table -> (updated column, SQL expression of its new value)
DAY2_UPDATE = {
    "address": ("PostalCode", "'12345'"),
    "customer": ("Phone", "'555-0000000'"),
    "customer_address": ("AddressType", "'Billing'"),
    "sales_order_header": ("ShipMethod", "'CARGO'"),
    "sales_order_detail": ("OrderQty", "OrderQty + 1"),
    "product_category": ("Name", "Name || ' v2'"),
    "product_description": ("Description", "Description || ' (rev)'"),
    "product_model": ("Name", "Name || ' v2'"),
    "product_model_product_description": ("rowguid", "md5('rev:' || rowguid)"),
    "product": ("ListPrice", "ListPrice + 1"),
}
# table -> (nullable column, value it gets where NULL)
DAY2_FILL = {
    "address": ("AddressLine2", "'Suite 100'"),
    "customer": ("Title", "'Dr.'"),
    "sales_order_header": ("Comment", "'checked'"),
    "product_category": ("ParentProductCategoryID", "1"),
    "product_model": ("CatalogDescription", "'Catalog'"),
    "product": ("Color", "'Silver'"),
}


def day2_snapshot(day1: DataFrame, table: str) -> DataFrame:
    """Apply the day-2 rules (delete, re-key, update, NULL fill) to a day-1
    source frame; every rule reads the day-1 id and deletion wins."""
    spec = SILVER[table]
    key = spec.source_key
    types = {src: typ for src, _, typ in spec.columns}
    df = day1.filter(f"{key} % {DELETE_MOD} != 0")
    ucol, uexpr = DAY2_UPDATE[table]
    upd = f"{key} % {UPDATE_MOD} = {UPDATE_REM}"
    cols = {c: c for c in df.columns}
    cols[ucol] = f"CASE WHEN {upd} THEN CAST({uexpr} AS {types[ucol]}) ELSE {ucol} END"
    cols["ModifiedDate"] = f"CASE WHEN {upd} THEN TIMESTAMP_NTZ '{D2}' ELSE ModifiedDate END"
    if table in DAY2_FILL:
        fcol, fexpr = DAY2_FILL[table]
        cols[fcol] = (f"CASE WHEN {key} % {FILL_MOD} = {FILL_REM} AND {fcol} IS NULL "
                      f"THEN CAST({fexpr} AS {types[fcol]}) ELSE {cols[fcol]} END")
    cols[key] = (f"CAST(CASE WHEN {key} % {REKEY_MOD} = {REKEY_REM} THEN {key} + _lf_top "
                 f"ELSE {key} END AS {types[key]})")
    names = df.columns
    top = day1.agg(F.max(key).cast("long")).scalar()
    return df.withColumn("_lf_top", top).selectExpr(*[f"{cols[c]} AS {c}" for c in names])


def dealt_snapshot(spark: SparkSession, d: str, table: str) -> tuple[DataFrame, bool]:
    """The day-1 frame of ``table``, and whether its rows lie in contiguous
    ranges of its first key column without a key that occurs twice."""
    return _order_lines(spark, d) if table == "sales_order_detail" else (SOURCES[table](spark, d), False)


def snapshot(spark: SparkSession, d: str, table: str, day: int = 1) -> DataFrame:
    """Source-shaped frame of ``table`` for load day 1 or 2."""
    df = SOURCES[table](spark, d)
    return df if day == 1 else day2_snapshot(df, table)
