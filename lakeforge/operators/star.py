"""Star-schema key lookup: the fact projection.

The lookup chain line ⟕ header ⟕ customer ⟕ dim_customer, header ⟕ address
⟕ dim_geography, line ⟕ dim_product is evaluated header-side first: the two
header lookups only read header columns, so they are resolved on the
(smaller) header table.  The lines get their product key first and then meet
the enriched headers in one shuffle join on the order id, so that no lookup
carries the columns of the others.  Customer and address go through their
*current* Silver rows (a closed customer maps to -9 on the next run, G6);
the product joins the dimension directly.  Order id and date key come from
the header side: a line without a current header gets NULL for both (G7)
unless ``fix_orphans`` takes the order id from the line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import UNKNOWN_KEY, VALID_TO
from ..functions.dates import date_key
from ..session import cut_lineage

#: Rows of a lookup table that Spark may broadcast.
BROADCAST_ROWS = 100_000


def lookup_side(table: DataFrame) -> DataFrame:
    """``table``, stored, as the right side of a lookup.  Spark plans a broadcast
    by the size of compressed files, of which a few MB hold millions of keys, and
    keeps to it when the rows turn out to be many; all of them pass through the
    driver.  So the rows are counted (Parquet files have the figure), and more
    than ``BROADCAST_ROWS`` of them are met in a sort-merge join."""
    return table if table.count() <= BROADCAST_ROWS else table.hint("merge")


def lost_keys(rows: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    """Values of ``key`` in ``rows`` that no row of ``dim`` has, stored, as column
    ``_lf_lost_<key>``; NULL is none.  Only distinct keys are shuffled.  Rows meet
    these values in a lookup, which is small unless very many are lost, rather
    than the whole dimension."""
    lost = f"_lf_lost_{key}"
    known = lookup_side(dim.select(F.col(key).alias("_lf_known")))
    used = rows.select(F.col(key).alias(lost)).na.drop().distinct()
    return cut_lineage(used.join(known, F.col(lost) == F.col("_lf_known"), "left_anti"))


def _current(df: DataFrame) -> DataFrame:
    return df.filter(F.col(VALID_TO).isNull())


def fact_sales_projection(lines: DataFrame, headers: DataFrame, customers: DataFrame,
                          addresses: DataFrame, dim_customer: DataFrame,
                          dim_geography: DataFrame, dim_product: DataFrame,
                          fix_orphans: bool = False) -> DataFrame:
    """Fact rows (grain: current order line) with dimension keys and measures.
    Silver inputs are whole histories; only current versions are used (the
    filter sits on each side *before* its outer join)."""
    cust_key = (_current(customers).select("customer_id")
                .join(lookup_side(dim_customer.select(F.col("cust_customer_id").alias("customer_id"),
                                                      "_tf_dim_customer_id")), "customer_id"))
    geo_key = (_current(addresses).select(F.col("address_id").alias("bill_to_address_id"))
               .join(lookup_side(dim_geography.select(F.col("geo_address_id").alias("bill_to_address_id"),
                                                      "_tf_dim_geography_id")), "bill_to_address_id"))
    hdr = (_current(headers)
           .select(F.col("sales_order_id").alias("_lf_hid"), "order_date", "customer_id",
                   "bill_to_address_id")
           .join(cust_key, "customer_id", "left")
           .join(geo_key, "bill_to_address_id", "left")
           .select("_lf_hid", "order_date", "_tf_dim_customer_id", "_tf_dim_geography_id"))
    prod_key = dim_product.select(F.col("prod_product_id").alias("product_id"), "_tf_dim_product_id")
    sod = _current(lines).select("sales_order_id", "sales_order_detail_id", "product_id",
                                 "order_qty", "unit_price", "unit_price_discount", "line_total")
    j = (sod.join(lookup_side(prod_key), "product_id", "left").drop("product_id")
         .join(hdr, F.col("sales_order_id") == F.col("_lf_hid"), "left"))
    order_id = F.coalesce(F.col("_lf_hid"), F.col("sales_order_id")) if fix_orphans else F.col("_lf_hid")
    unknown = F.lit(UNKNOWN_KEY).cast("long")
    return j.select(
        order_id.cast("int").alias("sales_order_id"),
        F.col("sales_order_detail_id").cast("int").alias("sales_order_detail_id"),
        date_key(F.col("order_date")).alias("_tf_dim_calendar_id"),
        F.coalesce(F.col("_tf_dim_customer_id"), unknown).alias("_tf_dim_customer_id"),
        F.coalesce(F.col("_tf_dim_geography_id"), unknown).alias("_tf_dim_geography_id"),
        F.coalesce(F.col("_tf_dim_product_id"), unknown).alias("_tf_dim_product_id"),
        F.coalesce(F.col("order_qty").try_cast("smallint"), F.lit(0).cast("smallint"))
        .alias("sales_order_qty"),
        F.coalesce(F.col("unit_price").try_cast("decimal(19,4)"), F.lit(0).cast("decimal(19,4)"))
        .alias("sales_unit_price"),
        F.coalesce(F.col("unit_price_discount").try_cast("decimal(19,4)"),
                   F.lit(0).cast("decimal(19,4)")).alias("sales_unit_price_discount"),
        F.coalesce(F.col("line_total").try_cast("decimal(38,6)"), F.lit(0).cast("decimal(38,6)"))
        .alias("sales_line_total"))
