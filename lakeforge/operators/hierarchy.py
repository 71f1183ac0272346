"""Two-level category hierarchy flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import UNKNOWN_TEXT


def flatten_categories(categories: DataFrame, id_col: str = "product_category_id",
                       parent_col: str = "parent_product_category_id",
                       name_col: str = "name") -> DataFrame:
    """Child → parent self left join on the *current* categories.

    Root (parent NULL or 0): level 1 = itself, level 2 = (0, 'N/A').
    Child: level 1 = parent, level 2 = itself.  A child whose parent is not a
    current category gets level-1 id NULL but name 'N/A' (kept as is).
    Output columns are the conformed dimension attributes.
    """
    parent = categories.select(F.col(id_col).alias("_lf_pid"), F.col(name_col).alias("_lf_pname"))
    j = categories.join(parent, F.col(parent_col) == F.col("_lf_pid"), "left")
    pid = F.col(parent_col)
    is_root = pid.isNull() | (pid == 0)
    name = F.coalesce(F.col(name_col).try_cast("string"), F.lit(UNKNOWN_TEXT))
    return j.select(
        F.col(id_col).cast("int").alias("prod_cat_category_id"),
        name.alias("prod_cat_name"),
        F.coalesce(pid.try_cast("int"), F.lit(0)).alias("prod_cat_parent_category_id"),
        F.when(is_root, F.col(id_col).cast("int")).otherwise(F.col("_lf_pid").cast("int"))
        .alias("prod_cat_level_1_id"),
        F.when(is_root, name)
        .otherwise(F.coalesce(F.col("_lf_pname").try_cast("string"), F.lit(UNKNOWN_TEXT)))
        .alias("prod_cat_level_1_name"),
        F.when(~is_root, F.col(id_col).cast("int")).otherwise(F.lit(0)).alias("prod_cat_level_2_id"),
        F.when(~is_root, name).otherwise(F.lit(UNKNOWN_TEXT)).alias("prod_cat_level_2_name"))
