"""Independent SQL (DuckDB dialect) for every query with an oracle.

The fixture frames are re-stated as CTEs over the pre-registered views, and
each operator is re-stated in plain SQL (joins, NOT EXISTS, window
row_number), not by translating the Spark plan.
"""

from __future__ import annotations

from ..contracts import SILVER
from ..sources.fixtures import (D0, D1, D2, DAY2_FILL, DAY2_UPDATE, DELETE_MOD, FILL_MOD,
                                FILL_REM, NO_PARENT, REKEY_MOD, REKEY_REM, UPDATE_MOD,
                                UPDATE_REM)

_DUCK_TYPES = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB"}


def duck_type(t: str) -> str:
    return _DUCK_TYPES.get(t, t.upper())


def tsl(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def _guid(table: str, *keys: str) -> str:
    parts = " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5('{table}:' || {parts})"


_RAW = {
    "address": f"""
SELECT c_custkey + 1 AS AddressID, 'Street ' || c_name AS AddressLine1,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS AddressLine2,
  n_name AS City, r_name AS StateProvince, r_name AS CountryRegion,
  lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS PostalCode,
  {_guid('address', 'c_custkey + 1')} AS rowguid, {tsl(D1)} AS ModifiedDate
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "customer": f"""
SELECT c_custkey + 1 AS CustomerID, c_custkey % 2 = 0 AS NameStyle,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Mr.' END AS Title, c_mktsegment AS FirstName,
  NULL AS MiddleName, c_name AS LastName, NULL AS Suffix,
  'Company ' || CAST(c_custkey % 50 AS VARCHAR) AS CompanyName,
  'rep' || CAST(c_custkey % 9 AS VARCHAR) AS SalesPerson,
  'customer' || CAST(c_custkey + 1 AS VARCHAR) || '@example.com' AS EmailAddress,
  '555-' || lpad(CAST(c_custkey + 1 AS VARCHAR), 7, '0') AS Phone,
  md5('hash:' || CAST(c_custkey + 1 AS VARCHAR)) AS PasswordHash,
  substr(md5('salt:' || CAST(c_custkey + 1 AS VARCHAR)), 1, 8) AS PasswordSalt,
  {_guid('customer', 'c_custkey + 1')} AS rowguid, {tsl(D1)} AS ModifiedDate
FROM customer""",
    "customer_address": f"""
SELECT c_custkey + 1 AS CustomerID, c_custkey + 1 AS AddressID,
  CASE WHEN c_custkey % 5 = 0 THEN 'Shipping' ELSE 'Main Office' END AS AddressType,
  {_guid('customer_address', 'c_custkey + 1', 'c_custkey + 1')} AS rowguid,
  {tsl(D1)} AS ModifiedDate
FROM customer""",
    "sales_order_header": f"""
SELECT o_orderkey + 1 AS SalesOrderID, 1 AS RevisionNumber, o_orderdate AS OrderDate,
  o_orderdate + INTERVAL 12 DAY AS DueDate,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate + INTERVAL 7 DAY END AS ShipDate,
  CASE WHEN o_orderstatus = 'F' THEN 5 WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS Status,
  o_orderkey % 2 = 0 AS OnlineOrderFlag, 'SO' || CAST(o_orderkey + 1 AS VARCHAR) AS SalesOrderNumber,
  NULL AS PurchaseOrderNumber, NULL AS AccountNumber, o_custkey + 1 AS CustomerID,
  o_custkey + 1 AS ShipToAddressID, o_custkey + 1 AS BillToAddressID,
  o_orderpriority AS ShipMethod, NULL AS CreditCardApprovalCode,
  CAST(o_totalprice AS DECIMAL(19,4)) AS SubTotal, 0 AS TaxAmt, 0 AS Freight,
  CAST(o_totalprice AS DECIMAL(19,4)) AS TotalDue, NULL AS Comment,
  {_guid('sales_order_header', 'o_orderkey + 1')} AS rowguid, {tsl(D1)} AS ModifiedDate
FROM orders""",
    "sales_order_detail": f"""
SELECT SalesOrderID, SalesOrderDetailID, OrderQty, ProductID, UnitPrice, UnitPriceDiscount,
  LineTotal, {_guid('sales_order_detail', 'SalesOrderID', 'SalesOrderDetailID')} AS rowguid,
  {tsl(D1)} AS ModifiedDate
FROM (SELECT l_orderkey + 1 AS SalesOrderID,
    ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
      l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus)
      AS SalesOrderDetailID,
    l_quantity AS OrderQty, l_partkey + 1 AS ProductID,
    CAST(l_extendedprice AS DECIMAL(19,4)) AS UnitPrice,
    CAST(l_discount AS DECIMAL(19,4)) AS UnitPriceDiscount,
    CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
      AS DECIMAL(38,6)) AS LineTotal
  FROM lineitem) x""",
    "product_category": f"""
SELECT ProductCategoryID, ParentProductCategoryID, Name,
  {_guid('product_category', 'ProductCategoryID')} AS rowguid, {tsl(D1)} AS ModifiedDate
FROM (
  SELECT DENSE_RANK() OVER (ORDER BY p_type) AS ProductCategoryID,
    CAST(NULL AS INT) AS ParentProductCategoryID, p_type AS Name
  FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL) r
  UNION ALL
  SELECT roots + kid_rank AS ProductCategoryID,
    CASE WHEN (roots + kid_rank) % 29 = 0 THEN {NO_PARENT} ELSE root_id END, p_type || ' ' || p_brand
  FROM (SELECT p_type, p_brand, DENSE_RANK() OVER (ORDER BY p_type, p_brand) AS kid_rank,
               (SELECT COUNT(DISTINCT p_type) FROM part) AS roots, root_id
        FROM (SELECT DISTINCT p_type, p_brand FROM part WHERE p_type IS NOT NULL AND p_brand IS NOT NULL) k
        JOIN (SELECT p_type, DENSE_RANK() OVER (ORDER BY p_type) AS root_id
              FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL) x) r USING (p_type)) k2) u""",
    "product_model": f"""
SELECT model_id AS ProductModelID, p_name AS Name,
  CASE WHEN model_id % 2 = 0 THEN NULL ELSE 'Catalog of ' || p_name END AS CatalogDescription,
  {_guid('product_model', 'model_id')} AS rowguid, {tsl(D1)} AS ModifiedDate
FROM (SELECT p_name, DENSE_RANK() OVER (ORDER BY p_name) AS model_id
      FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL) n) m""",
    "product_description": f"""
SELECT model_id * 10 + k AS ProductDescriptionID, culture || ': ' || p_name AS Description,
  {_guid('product_description', 'model_id * 10 + k')} AS rowguid, {tsl(D1)} AS ModifiedDate
FROM (SELECT p_name, DENSE_RANK() OVER (ORDER BY p_name) AS model_id
      FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL) n) m,
     (VALUES (1, 'en'), (2, 'fr')) AS c(k, culture)""",
    "product_model_product_description": f"""
SELECT model_id AS ProductModelID, model_id * 10 + k AS ProductDescriptionID,
  culture AS Culture,
  {_guid('product_model_product_description', 'model_id', 'model_id * 10 + k', 'culture')}
    AS rowguid, {tsl(D1)} AS ModifiedDate
FROM (SELECT p_name, DENSE_RANK() OVER (ORDER BY p_name) AS model_id
      FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL) n) m,
     (VALUES (1, 'en'), (2, 'fr')) AS c(k, culture)""",
    "product": f"""
SELECT p_partkey + 1 AS ProductID, p.p_name AS Name,
  p.p_brand || '-' || CAST(p_partkey AS VARCHAR) AS ProductNumber,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE split_part(p.p_name, ' ', 1) END AS Color,
  CAST(p_retailprice AS DECIMAL(19,4)) AS StandardCost,
  CAST(p_retailprice AS DECIMAL(19,4)) AS ListPrice, CAST(p_size AS VARCHAR) AS Size,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS Weight,
  (SELECT COUNT(DISTINCT p_type) FROM part) + k.kid_rank AS ProductCategoryID, m.model_id AS ProductModelID,
  {tsl(D0)} AS SellStartDate,
  CASE WHEN p_partkey % 4 = 0 THEN {tsl(D1)} END AS SellEndDate,
  CASE WHEN p_partkey % 11 = 0 THEN {tsl(D1)} END AS DiscontinuedDate,
  CAST(NULL AS BLOB) AS ThumbNailPhoto, NULL AS ThumbnailPhotoFileName,
  {_guid('product', 'p_partkey + 1')} AS rowguid, {tsl(D1)} AS ModifiedDate
FROM part p
LEFT JOIN (SELECT p_type, p_brand, DENSE_RANK() OVER (ORDER BY p_type, p_brand) AS kid_rank
      FROM (SELECT DISTINCT p_type, p_brand FROM part WHERE p_type IS NOT NULL AND p_brand IS NOT NULL) x) k
  ON p.p_type = k.p_type AND p.p_brand = k.p_brand
LEFT JOIN (SELECT p_name, DENSE_RANK() OVER (ORDER BY p_name) AS model_id
      FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL) n) m ON p.p_name = m.p_name""",
}


def _typed(table: str, inner: str) -> str:
    spec = SILVER[table]
    cols = ",\n  ".join(f"CAST({src} AS {duck_type(typ)}) AS {src}" for src, _, typ in spec.columns)
    return f"SELECT\n  {cols}\nFROM ({inner}) raw"


def src_sql(table: str, day: int = 1) -> str:
    """SELECT producing the source-shaped snapshot of ``table`` on ``day``."""
    base = _typed(table, _RAW[table])
    if day == 1:
        return base
    spec = SILVER[table]
    key = spec.source_key
    types = {src: typ for src, _, typ in spec.columns}
    ucol, uexpr = DAY2_UPDATE[table]
    upd = f"{key} % {UPDATE_MOD} = {UPDATE_REM}"
    sel = []
    for src, _, typ in spec.columns:
        e = src
        if src == ucol:
            e = f"CASE WHEN {upd} THEN CAST({uexpr} AS {duck_type(typ)}) ELSE {src} END"
        if src == "ModifiedDate":
            e = f"CASE WHEN {upd} THEN {tsl(D2)} ELSE ModifiedDate END"
        if table in DAY2_FILL and src == DAY2_FILL[table][0]:
            fexpr = DAY2_FILL[table][1]
            e = (f"CASE WHEN {key} % {FILL_MOD} = {FILL_REM} AND {src} IS NULL "
                 f"THEN CAST({fexpr} AS {duck_type(typ)}) ELSE {e} END")
        if src == key:
            e = (f"CAST(CASE WHEN {key} % {REKEY_MOD} = {REKEY_REM} THEN {key} + (SELECT MAX({key}) FROM ({base}) m) "
                 f"ELSE {key} END AS {duck_type(types[key])})")
        sel.append(f"{e} AS {src}")
    cols = ",\n  ".join(sel)
    return f"SELECT\n  {cols}\nFROM ({base}) d1\nWHERE {key} % {DELETE_MOD} <> 0"


def with_sources(body: str, tables: list[str], days=(1,)) -> str:
    """``WITH src_<table>_d<day> AS (...) ... body``."""
    ctes = [f"src_{t}_d{d} AS (\n{src_sql(t, d)}\n)" for t in tables for d in days]
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- BI queries (B1–B10) ----------------------------------------------------
BI_SQL = {
    "bi_product_list": with_sources("""
, category AS (SELECT map_from_entries(list((ProductCategoryID, Name))) AS names FROM src_product_category_d1)
SELECT * FROM (
  SELECT (SELECT names FROM category)[ProductCategoryID] AS ProductCategory, Name AS ProductName,
         ProductNumber, ListPrice FROM src_product_d1) listed
WHERE ProductCategory IS NOT NULL
""", ["product", "product_category"]),
    "bi_orders_per_customer": with_sources("""
SELECT CustomerID AS Customer, FirstName, LastName,
       (SELECT COUNT(*) FROM src_sales_order_header_d1 placed WHERE placed.CustomerID = buyer.CustomerID) AS TotalOrders
FROM src_customer_d1 buyer
""", ["customer", "sales_order_header"]),
    "bi_top5_products": with_sources("""
SELECT Name, ListPrice FROM src_product_d1
QUALIFY row_number() OVER (ORDER BY ListPrice DESC, ProductID) <= 5
""", ["product"]),
    "bi_on_sale_products": with_sources("""
SELECT Name, ListPrice, SellEndDate FROM src_product_d1 WHERE SellEndDate IS NULL
""", ["product"]),
    "bi_global_revenue": with_sources("""
SELECT CAST(SUM(TotalDue) AS DECIMAL(38,4)) AS GlobalRevenue FROM src_sales_order_header_d1
""", ["sales_order_header"]),
    "bi_orders_by_region": with_sources("""
, billed AS (
  SELECT (SELECT max(StateProvince) FROM src_address_d1 WHERE AddressID = BillToAddressID) AS StateProvince,
         EXISTS (SELECT 1 FROM src_address_d1 WHERE AddressID = BillToAddressID) AS known
  FROM src_sales_order_header_d1)
SELECT StateProvince, COUNT(*) AS OrderCount FROM billed WHERE known GROUP BY StateProvince
""", ["address", "sales_order_header"]),
    "bi_products_per_category": with_sources("""
, sizes AS (SELECT ProductCategoryID AS id, COUNT(*) AS members FROM src_product_d1 GROUP BY id)
SELECT Name AS CategoryName, CAST(SUM(members) AS BIGINT) AS ProductCount
FROM sizes, src_product_category_d1 WHERE id = ProductCategoryID GROUP BY CategoryName
""", ["product_category", "product"]),
    "bi_top3_customers": with_sources("""
, spent AS (SELECT CustomerID AS id, SUM(TotalDue) AS total FROM src_sales_order_header_d1 GROUP BY id),
best AS (
  SELECT id, total FROM spent WHERE id IN (SELECT CustomerID FROM src_customer_d1)
  QUALIFY row_number() OVER (ORDER BY total DESC, id) <= 3)
SELECT (SELECT any_value(FirstName) FROM src_customer_d1 WHERE CustomerID = id) AS FirstName,
       (SELECT any_value(LastName) FROM src_customer_d1 WHERE CustomerID = id) AS LastName,
       CAST(total AS DECIMAL(38,4)) AS TotalRevenue FROM best
""", ["customer", "sales_order_header"]),
    "bi_revenue_per_category": with_sources("""
, sold AS (SELECT ProductID AS id, SUM(LineTotal) AS total FROM src_sales_order_detail_d1 GROUP BY id),
placed AS (
  SELECT (SELECT any_value(ProductCategoryID) FROM src_product_d1 WHERE ProductID = id) AS category, total FROM sold),
named AS (
  SELECT (SELECT any_value(Name) FROM src_product_category_d1 WHERE ProductCategoryID = category) AS CategoryName, total
  FROM placed)
SELECT CategoryName, CAST(SUM(total) AS DECIMAL(38,6)) AS Revenue FROM named
WHERE CategoryName IS NOT NULL GROUP BY CategoryName
""", ["product_category", "product", "sales_order_detail"]),
    "bi_top_discount_product": with_sources("""
, given AS (
  SELECT ProductID AS id, SUM(UnitPriceDiscount * OrderQty) AS total FROM src_sales_order_detail_d1 GROUP BY id),
best AS (
  SELECT id, total FROM given WHERE id IN (SELECT ProductID FROM src_product_d1)
  QUALIFY row_number() OVER (ORDER BY total DESC NULLS LAST, id) = 1)
SELECT (SELECT any_value(Name) FROM src_product_d1 WHERE ProductID = id) AS Name,
       CAST(total AS DECIMAL(38,4)) AS TotalDiscountAmount FROM best
""", ["sales_order_detail", "product"]),
}


# --- composition helpers -------------------------------------------------------
def compose(ctes: list[tuple[str, str]], body: str) -> str:
    """``WITH`` over named CTEs (first definition of a name wins) + body."""
    seen, parts = set(), []
    for name, sql in ctes:
        if name not in seen:
            seen.add(name)
            parts.append(f"{name} AS (\n{sql}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + body


def source_ctes(table: str, days=(1, 2)) -> list[tuple[str, str]]:
    return [(f"src_{table}_d{d}", src_sql(table, d)) for d in days]


# --- Silver (SCD2) ----------------------------------------------------------------
HIST_TAIL = ["_tf_valid_from", "_tf_valid_to", "_tf_create_date", "_tf_update_date"]


def silver_src_cte(table: str, day: int) -> tuple[str, str]:
    spec = SILVER[table]
    cols = ", ".join(f"CAST({s} AS {duck_type(t)}) AS {d}" for s, d, t in spec.columns)
    return f"sv_{table}_d{day}", f"SELECT {cols} FROM src_{table}_d{day}"


def _keys_match(table: str, a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in SILVER[table].keys)


def _unchanged(table: str, t: str, s: str, null_safe: bool) -> str:
    spec = SILVER[table]
    if null_safe:
        terms = " OR ".join(f"{t}.{c} IS DISTINCT FROM {s}.{c}" for c in spec.tracked)
    else:
        terms = " OR ".join(f"{t}.{c} <> {s}.{c}" for c in spec.tracked)
    return f"NOT COALESCE({terms}, FALSE)"


def hist_initial_sql(table: str, src: str, load: str) -> str:
    spec = SILVER[table]
    cols = ", ".join(spec.silver_columns)
    keys = ", ".join(spec.keys)
    return (f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {keys}) AS BIGINT) AS _tf_id, {cols}, "
            f"{tsl(load)} AS _tf_valid_from, CAST(NULL AS TIMESTAMP) AS _tf_valid_to, "
            f"{tsl(load)} AS _tf_create_date, {tsl(load)} AS _tf_update_date FROM {src}")


def hist_next_sql(table: str, prev: str, src: str, load: str, null_safe: bool = False,
                  with_open: bool = True) -> str:
    """History after loading ``src`` into ``prev``: closed history, kept,
    closed and (optionally) opened versions, as four independent SELECTs."""
    spec = SILVER[table]
    cols = spec.silver_columns
    tcols = ", ".join(f"t.{c}" for c in cols)
    scols = ", ".join(f"s.{c}" for c in cols)
    keys = ", ".join(f"s.{k}" for k in spec.keys)
    same = f"{_keys_match(table, 't', 's')} AND {_unchanged(table, 't', 's', null_safe)}"
    parts = [
        f"SELECT * FROM {prev} WHERE _tf_valid_to IS NOT NULL",
        f"SELECT t._tf_id, {tcols}, t._tf_valid_from, t._tf_valid_to, t._tf_create_date, "
        f"t._tf_update_date FROM {prev} t WHERE t._tf_valid_to IS NULL "
        f"AND EXISTS (SELECT 1 FROM {src} s WHERE {same})",
        f"SELECT t._tf_id, {tcols}, t._tf_valid_from, {tsl(load)}, t._tf_create_date, "
        f"{tsl(load)} FROM {prev} t WHERE t._tf_valid_to IS NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {src} s WHERE {same})",
    ]
    if with_open:
        parts.append(
            f"SELECT CAST((SELECT COALESCE(MAX(_tf_id), 0) FROM {prev} WHERE _tf_id >= 1) "
            f"+ ROW_NUMBER() OVER (ORDER BY {keys}) AS BIGINT), {scols}, {tsl(load)}, "
            f"CAST(NULL AS TIMESTAMP), {tsl(load)}, {tsl(load)} FROM {src} s "
            f"WHERE NOT EXISTS (SELECT 1 FROM {prev} t WHERE t._tf_valid_to IS NULL AND {same})")
    return "\nUNION ALL\n".join(parts)


LOAD_SQL = {1: "2024-01-01 06:00:00", 2: "2024-01-02 06:00:00", 3: "2024-01-03 06:00:00"}


def silver_chain(table: str, days: int = 2, null_safe: bool = False) -> tuple[list, str]:
    """CTEs building the Silver history of ``table`` after ``days`` loads."""
    tag = "_ns" if null_safe else ""
    ctes = source_ctes(table, tuple(range(1, days + 1)))
    prev = None
    for day in range(1, days + 1):
        ctes.append(silver_src_cte(table, day))
        name = f"h_{table}{tag}_d{day}"
        sv = f"sv_{table}_d{day}"
        sql = (hist_initial_sql(table, sv, LOAD_SQL[day]) if prev is None
               else hist_next_sql(table, prev, sv, LOAD_SQL[day], null_safe))
        ctes.append((name, sql))
        prev = name
    return ctes, prev


def _silver_sql() -> dict[str, str]:
    out = {}
    ctes, h1 = silver_chain("address", 1)
    out["scd2_initial_address"] = compose(ctes, f"SELECT * FROM {h1}")
    ctes, h1 = silver_chain("address", 1)
    ctes = source_ctes("address", (1, 2)) + ctes + [silver_src_cte("address", 2)]
    out["scd2_close_address"] = compose(
        ctes, "SELECT * FROM (" + hist_next_sql("address", h1, "sv_address_d2", LOAD_SQL[2],
                                                 with_open=False) + ") x")
    ctes2, h2 = silver_chain("address", 2)
    out["scd2_open_address"] = compose(ctes2, f"SELECT * FROM {h2}")
    for t in SILVER:
        c, h = silver_chain(t, 2)
        out[f"scd2_{t}"] = compose(c, f"SELECT * FROM {h}")
    out["scd2_noop_rerun"] = compose(
        ctes2, "SELECT * FROM (" + hist_next_sql("address", h2, "sv_address_d2", LOAD_SQL[3]) + ") x")
    c, h = silver_chain("address", 2, null_safe=True)
    out["scd2_null_safe"] = compose(c, f"SELECT * FROM {h}")
    out["scd2_null_blind"] = compose(ctes2, f"""
SELECT t.address_id, s.address_line2 AS source_address_line2, t._tf_id, t._tf_valid_from
FROM {h2} t JOIN sv_address_d2 s ON t.address_id = s.address_id
WHERE t._tf_valid_to IS NULL AND t.address_line2 IS NULL AND s.address_line2 IS NOT NULL""")
    return out


SILVER_SQL = _silver_sql()


# --- Gold ------------------------------------------------------------------------
from ..contracts import (CUSTOMER, FACT_COMPARED, FACT_KEYS, GEOGRAPHY,  # noqa: E402
                         PRODUCT, PRODUCT_CATEGORY, PRODUCT_PREVIEW, DimSpec)

INIT_SQL = D1

CALENDAR_SQL = """
WITH b AS (SELECT make_date(year(min(o_orderdate)), 1, 1) AS s,
                  greatest(CAST(max(o_orderdate) AS DATE), DATE '2030-01-01') AS e FROM orders),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS _tf_dim_calendar_id,
  d AS cal_date, CAST(year(d) AS INT) AS cal_year, CAST(month(d) AS INT) AS cal_month,
  CAST(day(d) AS INT) AS calendar_day_of_month,
  strftime(d, '%A %B %d %Y') AS cal_date_full, strftime(d, '%A') AS cal_day_name,
  CAST(d - CAST(isodow(d) - 1 AS INT) AS DATE) AS cal_week_start,
  CAST(d - CAST(isodow(d) - 1 AS INT) + 6 AS DATE) AS cal_week_end,
  CAST(isodow(d) AS INT) AS cal_week_day, CAST(weekofyear(d) AS INT) AS cal_week_of_year,
  strftime(d, '%B %Y') AS cal_month_year, strftime(d, '%B') AS cal_month_name,
  CAST(date_trunc('month', d) AS DATE) AS cal_first_day_of_month,
  CAST(last_day(d) AS DATE) AS cal_last_day_of_month,
  CAST(quarter(d) AS INT) AS cal_fiscal_quarter,
  CAST(year(d + 89) AS INT) AS cal_fiscal_year,
  TIMESTAMP '""" + INIT_SQL + """' AS _tf_create_date, TIMESTAMP '""" + INIT_SQL + """' AS _tf_update_date
FROM days"""


def _lit(v, typ: str) -> str:
    return f"CAST({v!r} AS {duck_type(typ)})" if isinstance(v, str) else f"CAST({v} AS {duck_type(typ)})"


def seed_sql(spec: DimSpec) -> str:
    cols = [f"CAST(-9 AS BIGINT) AS {spec.surrogate}", f"CAST(0 AS INT) AS {spec.natural_key}"]
    cols += [f"{_lit(default, typ)} AS {c}" for c, typ, default in spec.attributes]
    cols += [f"TIMESTAMP '{INIT_SQL}' AS _tf_create_date", f"TIMESTAMP '{INIT_SQL}' AS _tf_update_date"]
    return "SELECT " + ", ".join(cols)


def upsert_sql(prev: str, src: str, surrogate: str, keys: list[str], compared: list[str],
               load: str) -> str:
    """SCD1 upsert as three SELECTs: updated, unchanged/target-only, new."""
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    diff = "COALESCE(" + " OR ".join(f"t.{c} <> s.{c}" for c in compared) + ", FALSE)"
    data = keys + [c for c in compared if c not in keys]
    scols = ", ".join(f"s.{c}" for c in data)
    # rows with a NULL in their key are numbered by a digest of all their columns
    text = ", ".join(f"coalesce(CAST(s.{c} AS VARCHAR), '-')" for c in data)
    null = " OR ".join(f"s.{k} IS NULL" for k in keys)
    order = ", ".join(f"s.{k} NULLS FIRST" for k in keys) + (
        f", CASE WHEN {null} THEN CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS BIGINT) ELSE 0 END")
    return "\nUNION ALL\n".join([
        f"SELECT t.{surrogate} AS {surrogate}, {scols}, t._tf_create_date AS _tf_create_date, "
        f"{tsl(load)} AS _tf_update_date FROM {prev} t JOIN {src} s ON {match} WHERE {diff}",
        f"SELECT t.{surrogate}, " + ", ".join(f"t.{c}" for c in data) +
        f", t._tf_create_date, t._tf_update_date FROM {prev} t "
        f"WHERE NOT EXISTS (SELECT 1 FROM {src} s WHERE {match} AND {diff})",
        f"SELECT CAST((SELECT COALESCE(MAX({surrogate}), 0) FROM {prev} WHERE {surrogate} >= 1) "
        f"+ ROW_NUMBER() OVER (ORDER BY {order}) AS BIGINT), {scols}, {tsl(load)}, {tsl(load)} "
        f"FROM {src} s WHERE NOT EXISTS (SELECT 1 FROM {prev} t WHERE {match})",
    ])


def _cur(h: str) -> str:
    return f"(SELECT * FROM {h} WHERE _tf_valid_to IS NULL)"


def _na(c: str) -> str:
    return f"COALESCE(CAST({c} AS VARCHAR), 'N/A')"


def dim_src_sql(spec: DimSpec, day: int) -> str:
    if spec is GEOGRAPHY:
        cols = ["address_line1", "address_line2", "city", "state_province", "country_region",
                "postal_code"]
        return (f"SELECT CAST(address_id AS INT) AS geo_address_id, " +
                ", ".join(f"{_na(s)} AS {d}" for s, d in zip(cols, spec.compared)) +
                f" FROM {_cur(f'h_address_d{day}')} x")
    if spec is CUSTOMER:
        cols = ["title", "first_name", "middle_name", "last_name", "suffix", "company_name",
                "sales_person", "email_address", "phone"]
        return (f"SELECT CAST(customer_id AS INT) AS cust_customer_id, " +
                ", ".join(f"{_na(s)} AS {d}" for s, d in zip(cols, spec.compared)) +
                f" FROM {_cur(f'h_customer_d{day}')} x")
    if spec is PRODUCT_CATEGORY:
        # Roots and children apart; a child's parent comes from a keyed lookup.
        return f"""WITH live AS (
  SELECT CAST(product_category_id AS INT) AS id, CAST(parent_product_category_id AS INT) AS up, {_na('name')} AS label
  FROM {_cur(f'h_product_category_d{day}')} now),
child AS (
  SELECT id, up, label, (SELECT any_value(struct_pack(a := b.id, n := b.label)) FROM live b WHERE b.id = live.up) AS par
  FROM live WHERE up <> 0)
SELECT id AS prod_cat_category_id, label AS prod_cat_name, 0 AS prod_cat_parent_category_id, id AS prod_cat_level_1_id,
  label AS prod_cat_level_1_name, 0 AS prod_cat_level_2_id, 'N/A' AS prod_cat_level_2_name
FROM live WHERE coalesce(up, 0) = 0
UNION ALL
SELECT id, label, up, par.a, coalesce(par.n, 'N/A'), id, label FROM child"""
    facts = [("prod_name", "name"), ("prod_product_number", "product_number"), ("prod_color", "color"), ("prod_size", "size")]
    money = [("prod_standard_cost", "standard_cost"), ("prod_list_price", "list_price"), ("prod_weight", "weight")]
    texts = ", ".join(f"{_na(src)} AS {dst}" for dst, src in facts)
    sums = ", ".join(f"CAST(ifnull({src}, 0) AS DECIMAL(19,4)) AS {dst}" for dst, src in money)
    # One row per model and per category first, then two keyed lookups.
    return f"""WITH model AS (
  SELECT product_model_id AS m, any_value(struct_pack(n := name, d := catalog_description)) AS v
  FROM {_cur(f'h_product_model_d{day}')} models GROUP BY m),
category AS (
  SELECT prod_cat_category_id AS c, any_value(_tf_dim_product_category_id) AS k FROM dim_product_category_d{day} GROUP BY c)
SELECT CAST(product_id AS INT) AS prod_product_id, {texts}, {sums},
  CAST(ifnull((SELECT k FROM category WHERE c = product_category_id), -9) AS BIGINT) AS _tf_dim_product_category_id,
  CAST(ifnull(product_model_id, 0) AS INT) AS prod_product_model_id,
  ifnull((SELECT v.n FROM model WHERE m = product_model_id), 'N/A') AS prod_product_model_name,
  ifnull((SELECT v.d FROM model WHERE m = product_model_id), 'N/A') AS prod_product_model_catalog_description
FROM {_cur(f'h_product_d{day}')} items"""


_DIM_TABLES = {GEOGRAPHY.name: ["address"], CUSTOMER.name: ["customer"],
               PRODUCT_CATEGORY.name: ["product_category"],
               PRODUCT.name: ["product", "product_model", "product_category"]}


def dim_chain(spec: DimSpec, days: int = 2) -> tuple[list, str]:
    ctes: list = []
    for t in _DIM_TABLES[spec.name]:
        ctes += silver_chain(t, days)[0]
    if spec is PRODUCT:
        ctes += dim_chain(PRODUCT_CATEGORY, days)[0]
    ctes.append((f"{spec.name}_d0", seed_sql(spec)))
    for day in range(1, days + 1):
        ctes.append((f"{spec.name}_src_d{day}", dim_src_sql(spec, day)))
        ctes.append((f"{spec.name}_d{day}", upsert_sql(
            f"{spec.name}_d{day - 1}", f"{spec.name}_src_d{day}", spec.surrogate,
            [spec.natural_key], spec.compared, LOAD_SQL[day])))
    return ctes, f"{spec.name}_d{days}"


def _key_of(dim: str, surrogate: str, natural: str, value: str) -> str:
    """Surrogate of a natural key, -9 where the dimension has none."""
    return f"CAST(ifnull((SELECT max({surrogate}) FROM {dim} WHERE {natural} = {value}), -9) AS BIGINT) AS {surrogate}"


def fact_projection_sql(day: int) -> str:
    """Order headers resolve their keys once; lines then look up their header."""
    kept = [("sales_order_qty", "order_qty", "SMALLINT"), ("sales_unit_price", "unit_price", "DECIMAL(19,4)"),
            ("sales_unit_price_discount", "unit_price_discount", "DECIMAL(19,4)"), ("sales_line_total", "line_total", "DECIMAL(38,6)")]
    measures = ", ".join(f"ifnull(TRY_CAST(line.{src} AS {typ}), 0) AS {dst}" for dst, src, typ in kept)
    # A header counts for a dimension only through a current customer or address.
    buyer = f"(SELECT max(customer_id) FROM {_cur(f'h_customer_d{day}')} x WHERE x.customer_id = head.customer_id)"
    place = f"(SELECT max(address_id) FROM {_cur(f'h_address_d{day}')} x WHERE x.address_id = head.bill_to_address_id)"
    return f"""WITH head_ids AS (
  SELECT sales_order_id AS order_id, CAST(strftime(order_date, '%Y%m%d') AS INT) AS _tf_dim_calendar_id,
    {buyer} AS buyer, {place} AS place FROM {_cur(f'h_sales_order_header_d{day}')} head),
heads AS (
  SELECT order_id, _tf_dim_calendar_id, {_key_of(f'dim_customer_d{day}', '_tf_dim_customer_id', 'cust_customer_id', 'buyer')},
    {_key_of(f'dim_geography_d{day}', '_tf_dim_geography_id', 'geo_address_id', 'place')} FROM head_ids)
SELECT CAST(order_id AS INT) AS sales_order_id, CAST(sales_order_detail_id AS INT) AS sales_order_detail_id,
  _tf_dim_calendar_id, ifnull(_tf_dim_customer_id, -9) AS _tf_dim_customer_id,
  ifnull(_tf_dim_geography_id, -9) AS _tf_dim_geography_id,
  {_key_of(f'dim_product_d{day}', '_tf_dim_product_id', 'prod_product_id', 'line.product_id')}, {measures}
FROM heads RIGHT JOIN {_cur(f'h_sales_order_detail_d{day}')} line ON order_id = line.sales_order_id"""


FACT_EMPTY_SQL = ("SELECT CAST(NULL AS BIGINT) AS _tf_fact_sales_id, CAST(NULL AS INT) AS sales_order_id, "
                  "CAST(NULL AS INT) AS sales_order_detail_id, " +
                  ", ".join(f"CAST(NULL AS {duck_type(t)}) AS {c}" for c, t in FACT_COMPARED) +
                  ", CAST(NULL AS TIMESTAMP) AS _tf_create_date, CAST(NULL AS TIMESTAMP) AS _tf_update_date "
                  "WHERE FALSE")


def fact_chain(days: int = 2, upsert: bool = True) -> tuple[list, str]:
    ctes: list = []
    for t in ("sales_order_detail", "sales_order_header", "customer", "address"):
        ctes += silver_chain(t, days)[0]
    for spec in (CUSTOMER, GEOGRAPHY, PRODUCT):
        ctes += dim_chain(spec, days)[0]
    ctes.append(("fact_d0", FACT_EMPTY_SQL))
    for day in range(1, days + 1):
        ctes.append((f"fact_src_d{day}", fact_projection_sql(day)))
        if upsert:
            ctes.append((f"fact_d{day}", upsert_sql(
                f"fact_d{day - 1}", f"fact_src_d{day}", "_tf_fact_sales_id", list(FACT_KEYS),
                [c for c, _ in FACT_COMPARED], LOAD_SQL[day])))
    return ctes, (f"fact_d{days}" if upsert else f"fact_src_d{days}")


def _gold_sql() -> dict[str, str]:
    out = {"dim_calendar": CALENDAR_SQL}
    for spec in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT):
        c, last = dim_chain(spec)
        out[spec.name] = compose(c, f"SELECT * FROM {last}")
    c, last = fact_chain(upsert=False)
    out["fact_projection"] = compose(c, f"SELECT * FROM {last}")
    c, last = fact_chain()
    out["fact_upsert"] = compose(c, f"SELECT * FROM {last}")
    return out


GOLD_SQL = _gold_sql()


# --- checks (Q1–Q11, S12, S17) and DML ------------------------------------------------------
def _checks_sql() -> dict[str, str]:
    out = {}
    ctes, h = silver_chain("sales_order_detail", 2)
    k = "sales_order_id, sales_order_detail_id"
    out["hist_updated_versions"] = compose(ctes, f"""
SELECT sales_order_id, sales_order_detail_id, order_qty, unit_price, _tf_valid_from, _tf_valid_to,
       _tf_create_date, _tf_update_date
FROM {h} QUALIFY COUNT(*) OVER (PARTITION BY {k}) > 1""")
    # Keys by their number of open versions, then every closed version by lookup.
    ctes = ctes + [
        ("open_count", f"SELECT {k}, COUNT(*) FILTER (_tf_valid_to IS NULL) AS n_open, COUNT(*) AS n_all, "
                       f"MIN(_tf_valid_from) AS born, MAX(_tf_valid_to) AS died, "
                       f"MAX(_tf_valid_from) FILTER (_tf_valid_to IS NULL) AS since FROM {h} GROUP BY {k}"),
        ("gone", f"SELECT v.* FROM {h} v JOIN open_count USING ({k}) WHERE n_open = 0 AND _tf_valid_to IS NOT NULL "
                 f"UNION ALL SELECT * FROM {h} WHERE _tf_valid_to IS NOT NULL "
                 f"AND (sales_order_id IS NULL OR sales_order_detail_id IS NULL)")]
    out["hist_closed_deleted"] = compose(
        ctes, f"SELECT {k}, order_qty, product_id, _tf_valid_from, _tf_valid_to, _tf_update_date FROM gone")
    out["hist_rekeyed"] = compose(ctes, f"""
SELECT gone.sales_order_id AS old_sales_order_id, gone.sales_order_detail_id AS old_sales_order_detail_id,
  _tf_valid_to AS switched_at, came.a AS new_sales_order_id, came.b AS new_sales_order_detail_id
FROM gone JOIN (SELECT sales_order_id AS a, sales_order_detail_id AS b, rowguid, _tf_valid_from AS at_time FROM {h}) came
  ON came.rowguid = gone.rowguid AND at_time = gone._tf_valid_to""")
    out["hist_version_stats"] = compose(ctes, f"""
SELECT {k}, n_all AS nb_versions, born AS first_version, since AS current_version, died AS last_closing FROM open_count
WHERE n_all > 1 QUALIFY row_number() OVER (ORDER BY n_all DESC, {k}) <= 20""")
    out["hist_duplicate_active"] = compose(
        ctes, f"SELECT {k}, n_open AS nb_current_versions FROM open_count WHERE n_open > 1")
    out["hist_active_listing"] = compose(ctes, f"""
SELECT {k}, order_qty, product_id, unit_price, unit_price_discount, line_total, _tf_valid_from,
       _tf_create_date FROM {h} WHERE _tf_valid_to IS NULL ORDER BY {k} LIMIT 50""")
    out["hist_interval_overlaps"] = compose(ctes, f"""
SELECT * EXCLUDE (nxt) FROM (SELECT *, LEAD(_tf_valid_from) OVER (PARTITION BY {k}
  ORDER BY _tf_valid_from) AS nxt FROM {h}) z
WHERE nxt IS NOT NULL AND (_tf_valid_to IS NULL OR nxt < _tf_valid_to)""")
    actes, ah = silver_chain("address", 2)
    out["hist_as_of"] = compose(actes, f"""
SELECT * FROM {ah} WHERE _tf_valid_from <= TIMESTAMP '2024-01-01 12:00:00'
  AND (_tf_valid_to IS NULL OR TIMESTAMP '2024-01-01 12:00:00' < _tf_valid_to)""")
    sc = source_ctes("sales_order_detail", (1,)) + [silver_src_cte("sales_order_detail", 1)]
    out["source_preview"] = compose(sc, f"""
(SELECT {k}, order_qty, product_id, unit_price, 'first' AS preview FROM sv_sales_order_detail_d1
 ORDER BY {k} LIMIT 5)
UNION ALL
(SELECT {k}, order_qty, product_id, unit_price, 'last' AS preview FROM sv_sales_order_detail_d1
 ORDER BY sales_order_id DESC, sales_order_detail_id DESC LIMIT 5)""")

    def first_rows(table: str, order: str, columns: str) -> str:
        return f"SELECT {columns} FROM {table} QUALIFY row_number() OVER (ORDER BY {order}) <= 20"

    pc_ctes, pc = dim_chain(PRODUCT_CATEGORY)
    names = [PRODUCT_CATEGORY.surrogate, PRODUCT_CATEGORY.natural_key, *PRODUCT_CATEGORY.compared]
    out["star_category_preview"] = compose(pc_ctes, first_rows(pc, PRODUCT_CATEGORY.natural_key, ", ".join(names)))
    p_ctes, p = dim_chain(PRODUCT)
    out["star_product_preview"] = compose(p_ctes, first_rows(p, "prod_product_id", ", ".join(PRODUCT_PREVIEW)))
    # Level names by surrogate key, looked up once per row that is shown.
    p_ctes = p_ctes + [("level_names", f"SELECT _tf_dim_product_category_id AS k, any_value(struct_pack(c := prod_cat_name, "
                        f"l1 := prod_cat_level_1_name, l2 := prod_cat_level_2_name)) AS v FROM {pc} GROUP BY k")]
    shown = "(SELECT v FROM level_names WHERE k = _tf_dim_product_category_id)"
    out["star_product_category"] = compose(p_ctes, f"""
SELECT prod_product_id, prod_name, prod_list_price, v.c AS category_name, v.l1 AS level_1, v.l2 AS level_2 FROM (
  SELECT *, {shown} AS v FROM ({first_rows(p, 'prod_product_id', '*')}) top)""")
    f_ctes, f = fact_chain()
    out["star_fact_product_category"] = compose(f_ctes + p_ctes, f"""
SELECT sales_order_id, sales_order_detail_id, sales_order_qty, sales_line_total, prod_name, prod_list_price,
  v.l1 AS category_level_1, v.l2 AS category_level_2
FROM (SELECT * FROM ({first_rows(f, 'sales_order_id, sales_order_detail_id', '*')}) top
      LEFT JOIN (SELECT _tf_dim_product_id AS pk, prod_name, prod_list_price, {shown} AS v FROM {p}) named
      ON pk = _tf_dim_product_id)""")
    fk = []
    fk.append(f"""SELECT sales_order_id, sales_order_detail_id, '_tf_dim_calendar_id' AS foreign_key,
  CAST(_tf_dim_calendar_id AS BIGINT) AS key_value FROM {f}
WHERE NOT EXISTS (SELECT 1 FROM (SELECT CAST(unnest(generate_series(DATE '2000-01-01',
  DATE '2030-01-01', INTERVAL 1 DAY)) AS DATE) AS d) c
  WHERE CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) = {f}._tf_dim_calendar_id)""")
    for spec in (CUSTOMER, GEOGRAPHY, PRODUCT):
        fk.append(f"""SELECT sales_order_id, sales_order_detail_id, '{spec.surrogate}' AS foreign_key,
  CAST({spec.surrogate} AS BIGINT) AS key_value FROM {f} x
WHERE NOT EXISTS (SELECT 1 FROM {spec.name}_d2 y WHERE y.{spec.surrogate} = x.{spec.surrogate})""")
    out["fact_orphan_keys"] = compose(f_ctes, "\nUNION ALL\n".join(fk))
    ku_ctes = list(f_ctes)
    parts = []
    for spec in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT):
        ku_ctes += dim_chain(spec)[0]
        parts.append((spec.name, f"{spec.name}_d2", spec.surrogate))
    parts.append(("fact_sales", f, "_tf_fact_sales_id"))
    out["key_uniqueness"] = compose(ku_ctes, "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows, COUNT(DISTINCT {c}) AS n_keys, "
        f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null_keys, "
        f"CAST(SUM(CASE WHEN {c} = -9 THEN 1 ELSE 0 END) AS BIGINT) AS n_unknown_members FROM {t}"
        for n, t, c in parts))

    out["key_violations"] = compose(ku_ctes, "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, COUNT(*) FILTER (c > 1) AS n_repeated_keys, "
        f"CAST(coalesce(SUM(c) FILTER ({key} IS NULL), 0) AS BIGINT) AS n_null_keys, "
        f"CAST(coalesce(SUM(missing), 0) AS BIGINT) AS n_null_required "
        f"FROM (SELECT {key}, COUNT(*) AS c, COUNT(*) FILTER ({need} IS NULL) AS missing FROM {t} GROUP BY {key}) g"
        for n, t, key, need in [(sp.name, f"{sp.name}_d2", sp.surrogate, sp.natural_key)
                                for sp in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT)]
        + [("fact_sales", f, "_tf_fact_sales_id", "_tf_dim_calendar_id")]))
    fixed = CALENDAR_SQL[CALENDAR_SQL.index("days AS"):].replace(
        "generate_series(s, e, INTERVAL 1 DAY)", "generate_series(DATE '2000-01-01', DATE '2030-01-01', INTERVAL 1 DAY)").replace(
        "AS d FROM b)", "AS d)")
    out["calendar_orders"] = compose(source_ctes("sales_order_header", (1,)), f"""
SELECT *, (SELECT COUNT(*) FROM src_sales_order_header_d1 WHERE CAST(OrderDate AS DATE) = cal_date) AS n_orders
FROM (WITH {fixed}) cal""")
    pv = source_ctes("address", (1,)) + [silver_src_cte("address", 1)]
    out["source_preview_city"] = compose(pv, """
SELECT address_id, city, state_province, postal_code, unnest(shown) AS preview FROM (
  SELECT *, list_filter([CASE WHEN row_number() OVER (ORDER BY city, address_id) <= 10 THEN 'city' END,
                         CASE WHEN row_number() OVER (ORDER BY address_id DESC) <= 10 THEN 'last' END],
                        lambda x: x IS NOT NULL) AS shown FROM sv_address_d1) ranked""")
    out["dml_insert_values"] = compose(pv, """
SELECT address_id, address_line1, city FROM sv_address_d1
UNION ALL VALUES (-1, '1 Inserted Road', 'Testville'), (-2, '2 Inserted Road', NULL)""")
    dsrc = source_ctes("sales_order_detail", (1,)) + [silver_src_cte("sales_order_detail", 1)]
    spec = SILVER["sales_order_detail"]
    cols = []
    for c in spec.silver_columns:
        if c == "order_qty":
            cols.append("CASE WHEN unit_price_discount > 0 THEN CAST(order_qty + 1 AS SMALLINT) "
                        "ELSE order_qty END AS order_qty")
        elif c == "unit_price":
            cols.append("CASE WHEN unit_price_discount > 0 THEN CAST(unit_price * 1.1 AS DECIMAL(19,4)) "
                        "ELSE unit_price END AS unit_price")
        else:
            cols.append(c)
    out["dml_update"] = compose(dsrc, f"SELECT {', '.join(cols)} FROM sv_sales_order_detail_d1")
    rk = [("CASE WHEN unit_price_discount = 0.1 THEN sales_order_detail_id + 1000000 "
           "ELSE sales_order_detail_id END AS sales_order_detail_id")
          if c == "sales_order_detail_id" else c for c in spec.silver_columns]
    out["dml_rekey"] = compose(dsrc, f"SELECT {', '.join(rk)} FROM sv_sales_order_detail_d1")
    asrc = source_ctes("address", (1,)) + [silver_src_cte("address", 1)]
    out["dml_delete"] = compose(asrc, "SELECT * FROM sv_address_d1 "
                                      "WHERE NOT COALESCE(state_province = 'EUROPE', FALSE)")
    seeds = []
    all_ctes: list = []
    for spec_ in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT):
        all_ctes += dim_chain(spec_)[0]
        seeds.append(f"SELECT '{spec_.name}' AS dimension, {spec_.surrogate} AS surrogate_key, "
                     f"{spec_.natural_key} AS natural_key FROM {spec_.name}_d2 WHERE {spec_.surrogate} = -9")
    out["dml_insert_seed"] = compose(all_ctes, "\nUNION ALL\n".join(seeds))
    return out


CHECKS_SQL = _checks_sql()


# --- sources, sinks and the layered run ------------------------------------------------------
def content_sql(layer: str, name: str, table: str, columns: list[str]) -> str:
    """Row count and order-free checksum of a table's non-binary columns."""
    values = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in sorted(columns))
    return (f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS n_rows, "
            f"CAST(coalesce(SUM(CAST('0x' || substr(md5(concat_ws('|', {values})), 1, 8) AS BIGINT)), 0) AS BIGINT) AS checksum "
            f"FROM {table}")


def _bronze_content(table: str, day: int) -> str:
    columns = [src for src, _, typ in SILVER[table].columns if typ != "binary"]
    return content_sql("bronze", table, f"src_{table}_d{day}", columns)


def _run_sql() -> dict[str, str]:
    out = {}
    ctes = [c for t in SILVER for c in source_ctes(t, (1,))]
    out["bronze_snapshot"] = compose(ctes, "\nUNION ALL\n".join(_bronze_content(t, 1) for t in SILVER))
    out["csv_round_trip"] = compose(source_ctes("address", (1,)), "SELECT * FROM src_address_d1")
    out["csv_inferred"] = compose(source_ctes("product", (1,)), """
SELECT ProductID, Name, CAST(ListPrice AS DOUBLE) AS ListPrice, CAST(Size AS INTEGER) AS Size FROM src_product_d1""")
    all_ctes: list = []
    parts = []
    for t in SILVER:
        c, h = silver_chain(t, 2)
        all_ctes += c
        parts.append(_bronze_content(t, 2))
        columns = [dst for _, dst, typ in SILVER[t].columns if typ != "binary"]
        parts.append(content_sql("silver", t, h, ["_tf_id", *columns, *HIST_TAIL]))
    for spec in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT):
        c, last = dim_chain(spec)
        all_ctes += c
        parts.append(content_sql("gold", spec.name, last, spec.columns))
    c, f = fact_chain()
    all_ctes += c
    parts.append(content_sql("gold", "fact_sales", f, ["_tf_fact_sales_id", *FACT_KEYS, *[c for c, _ in FACT_COMPARED],
                                                       "_tf_create_date", "_tf_update_date"]))
    out["layered_run"] = out["catalog_tables"] = compose(all_ctes, "\nUNION ALL\n".join(parts))

    f_ctes, f = fact_chain(1)
    checks = [(spec.name, f"{c} is NULL", f"SELECT COUNT(*) FROM {spec.name}_d1 WHERE {c} IS NULL")
              for spec in (GEOGRAPHY, CUSTOMER, PRODUCT) for c in (spec.surrogate, spec.natural_key)]
    days = """(SELECT CAST(strftime(unnest(generate_series(DATE '2000-01-01', DATE '2030-01-01', INTERVAL 1 DAY)), '%Y%m%d') AS INT)
  AS _tf_dim_calendar_id)"""
    for c, dim in [("_tf_dim_calendar_id", days), *((spec.surrogate, f"{spec.name}_d1") for spec in (GEOGRAPHY, CUSTOMER, PRODUCT))]:
        checks.append(("fact_sales", f"{c} has no row in its dimension",
                       f"SELECT COUNT(*) FROM {f} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {dim})"))
        checks.append(("fact_sales", f"{c} is NULL", f"SELECT COUNT(*) FROM {f} WHERE {c} IS NULL"))
    counts = "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, '{c}' AS \"constraint\", ({sql}) AS n_rows" for t, c, sql in checks)
    out["write_checks"] = compose(f_ctes, f"SELECT *, SUM(n_rows) OVER (PARTITION BY table_name) = 0 AS committed FROM ({counts}) x")
    return out


RUN_SQL = _run_sql()


# --- machine learning (oracle-expressible parts) ---------------------------------------------
ML_PREPARED = r"""SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, d.doc_id AS id_num,
  CAST(CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE d.n_chars END AS DOUBLE) AS n_chars,
  CAST(CASE WHEN d.doc_id % 7 = 0 THEN NULL
       ELSE len(string_split_regex(trim(d.text), '\s+')) END AS DOUBLE) AS n_words,
  CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE d.lang END AS lang, d.source,
  CAST(l.toxic AS INT) AS toxic, CAST(l.quality AS INT) AS quality
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

# The decision tree from its definition: thresholds of a number lie between
# distinct values about n/32 rows apart (all of them if there are at most 31), an
# indicator is split at 0.5; a node with two classes takes the split of largest
# entropy gain (first feature, then smallest threshold, of equals) that leaves 10
# rows on either side, three levels deep; a node whose leaves agree is a leaf.
_THRESHOLDS = """
SELECT feature, threshold FROM (
  WITH RECURSIVE counted AS (
    SELECT feature, value, COUNT(*) AS n, lead(value) OVER (PARTITION BY feature ORDER BY value) AS above,
      row_number() OVER (PARTITION BY feature ORDER BY value) AS i, COUNT(*) OVER (PARTITION BY feature) AS n_values
    FROM seen WHERE feature < 2 GROUP BY feature, value),
  summed AS (SELECT *, SUM(n) OVER (PARTITION BY feature ORDER BY i) AS before, SUM(n) OVER (PARTITION BY feature) AS n_rows FROM counted),
  walk AS (
    SELECT feature, CAST(0 AS BIGINT) AS i, CAST(n_rows AS DOUBLE) / 32 AS target, CAST(NULL AS DOUBLE) AS threshold FROM summed WHERE i = 1
    UNION ALL
    SELECT s.feature, s.i, CASE WHEN hit THEN target + CAST(n_rows AS DOUBLE) / 32 ELSE target END,
      CASE WHEN hit THEN (s.value + s.above) / 2 END
    FROM (SELECT w.feature, w.target, s.i, s.value, s.above, s.n_rows,
            s.n_values > 32 AND abs(s.before - w.target) < abs(t.before - w.target) AS hit
          FROM walk w JOIN summed s ON s.feature = w.feature AND s.i = w.i + 1
          JOIN summed t ON t.feature = s.feature AND t.i = s.i + 1) s)
  SELECT feature, threshold FROM walk WHERE threshold IS NOT NULL
  UNION ALL SELECT feature, (value + above) / 2 FROM summed WHERE n_values <= 32 AND above IS NOT NULL) numbers
UNION ALL SELECT feature, 0.5 FROM slots"""
_H = "(CASE WHEN {a} IN (0, {n}) THEN 0 ELSE -({a} / {n}) * ln({a} / {n}) / ln(2) - (1 - {a} / {n}) * ln(1 - {a} / {n}) / ln(2) END)"


def _tree_ctes() -> list[tuple[str, str]]:
    def entropy(a, n):
        return _H.format(a=f"CAST({a} AS DOUBLE)", n=f"CAST({n} AS DOUBLE)")

    ctes = [
        ("every", ML_PREPARED.replace("JOIN labels", "LEFT JOIN labels")),
        ("slots", """
SELECT column_name, value, CAST(category_index + 2 + CASE column_name WHEN 'lang' THEN 0 WHEN 'source' THEN n_lang
  ELSE n_lang + n_source END AS INT) AS feature, column_name || '_is_' || value AS name
FROM idx, (SELECT max(n_labels) FILTER (column_name = 'lang') AS n_lang, max(n_labels) FILTER (column_name = 'source') AS n_source FROM idx)
WHERE value IS NOT NULL"""),
        ("classes", "SELECT quality, row_number() OVER (ORDER BY COUNT(*) DESC, quality) - 1 AS class FROM train GROUP BY quality"),
        ("x", """
SELECT doc_id, 0 AS feature, ifnull(n_chars, (SELECT avg(n_chars) FROM train)) AS value FROM every
UNION ALL SELECT doc_id, 1, ifnull(n_words, (SELECT avg(n_words) FROM train)) FROM every
UNION ALL SELECT doc_id, s.feature, CASE WHEN v.value = s.value THEN 1.0 ELSE 0.0 END FROM slots s JOIN (
  SELECT doc_id, 'lang' AS column_name, lang AS value FROM every UNION ALL SELECT doc_id, 'source', source FROM every
  UNION ALL SELECT doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM every) v USING (column_name)"""),
        ("seen", "SELECT x.*, class FROM x JOIN train USING (doc_id) JOIN classes USING (quality)"),
        ("thresholds", _THRESHOLDS),
        ("at0", "SELECT doc_id, '' AS node FROM every")]
    for k in range(3):
        ctes += [
            (f"tried{k}", f"""
SELECT node, feature, threshold, COUNT(*) AS n, SUM(class) AS a, COUNT(*) FILTER (value <= threshold) AS nl,
  coalesce(SUM(class) FILTER (value <= threshold), 0) AS al
FROM seen JOIN at{k} USING (doc_id) JOIN thresholds USING (feature) GROUP BY node, feature, threshold"""),
            (f"split{k}", f"""
SELECT * FROM (SELECT node, feature, threshold, n, {entropy('a', 'n')} - CAST(nl AS DOUBLE) / n * {entropy('al', 'nl')}
    - CAST(n - nl AS DOUBLE) / n * {entropy('(a - al)', '(n - nl)')} AS gain
  FROM tried{k} WHERE nl >= 10 AND n - nl >= 10) g
WHERE gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 12) DESC, feature, threshold) = 1"""),
            (f"at{k + 1}", f"""
SELECT doc_id, node || CASE WHEN value <= threshold THEN 'L' ELSE 'R' END AS node
FROM at{k} JOIN split{k} USING (node) JOIN x USING (doc_id, feature)""")]
    ctes += [
        ("places", " UNION ALL ".join(f"SELECT * FROM at{k}" for k in range(4))),
        ("splits", " UNION ALL ".join(f"SELECT * FROM split{k}" for k in range(3))),
        ("tree", """
SELECT node, [COUNT(*) FILTER (class = 0), COUNT(*) FILTER (class = 1), 0] AS class_rows,
  CASE WHEN COUNT(*) FILTER (class = 1) > COUNT(*) FILTER (class = 0) THEN 1.0 ELSE 0.0 END AS prediction
FROM places JOIN train USING (doc_id) JOIN classes USING (quality) GROUP BY node"""),
        # a node is a leaf if all ends below it predict the same: then merging them goes up to it
        ("ends", "SELECT t.* FROM tree t WHERE node NOT IN (SELECT node FROM splits)"),
        ("agree", """
SELECT t.node FROM tree t JOIN ends e ON starts_with(e.node, t.node) GROUP BY t.node HAVING COUNT(DISTINCT e.prediction) = 1"""),
        ("leaves", """
SELECT t.* FROM tree t JOIN agree a USING (node) WHERE NOT EXISTS (
  SELECT 1 FROM agree u WHERE u.node <> t.node AND starts_with(t.node, u.node))"""),
        ("scored", """
SELECT p.doc_id, l.prediction, list_transform(class_rows, lambda c: CAST(c AS DOUBLE) / list_sum(class_rows)) AS probability
FROM places p JOIN leaves l USING (node)"""),
        ("test", "SELECT * FROM every WHERE quality IS NULL OR id_num % 5 = 0")]
    return ctes


def _ml_sql() -> dict[str, str]:
    out = {}
    out["ml_prepare"] = compose([("p", ML_PREPARED)],
                                "SELECT doc_id, n_chars, n_words, lang, source, toxic, quality FROM p")
    tr = [("p", ML_PREPARED), ("train", "SELECT * FROM p WHERE id_num % 5 <> 0")]
    out["ml_mean_impute"] = compose(tr, """
SELECT doc_id, round(COALESCE(n_chars, (SELECT avg(n_chars) FROM train)), 6) AS n_chars_imputed,
       round(COALESCE(n_words, (SELECT avg(n_words) FROM train)), 6) AS n_words_imputed FROM train""")
    freq = tr + [("vals", """
SELECT 'lang' AS column_name, lang AS value FROM train
UNION ALL SELECT 'source', source FROM train
UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR) FROM train"""),
                 ("freq", """SELECT column_name, value, COUNT(*) AS n FROM vals
WHERE value IS NOT NULL GROUP BY column_name, value"""),
                 ("idx", """
SELECT column_name, value,
  CAST(ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n DESC, value) - 1 AS INT) AS category_index,
  COUNT(*) OVER (PARTITION BY column_name) AS n_labels FROM freq
UNION ALL
SELECT column_name, NULL, CAST((SELECT COUNT(*) FROM freq f WHERE f.column_name = v.column_name) AS INT),
  (SELECT COUNT(*) FROM freq f WHERE f.column_name = v.column_name)
FROM (SELECT DISTINCT column_name FROM vals WHERE value IS NULL) v""")]
    out["ml_category_index"] = compose(freq, "SELECT column_name, value, category_index FROM idx")
    out["ml_one_hot_slots"] = compose(freq, """
SELECT column_name, value,
  CASE WHEN category_index < n_labels THEN category_index END AS one_hot_slot,
  CAST(n_labels AS INT) AS one_hot_size FROM idx""")
    # Feature vector: filled numbers, then an indicator per label of each category.
    vector = freq + [("means", "SELECT avg(n_chars) AS a, avg(n_words) AS b FROM train")]
    flags = " || ".join(
        f"list_transform(range((SELECT max(n_labels) FROM idx WHERE column_name = '{c}')), lambda i: "
        f"CASE WHEN i = {c}_at THEN 1.0 ELSE 0.0 END::DOUBLE)" for c in ("lang", "source", "toxic"))
    places = ", ".join(f"(SELECT any_value(category_index) FROM idx WHERE column_name = '{c}' AND value = CAST(train.{c} AS VARCHAR)) "
                       f"AS {c}_at" for c in ("lang", "source", "toxic"))
    out["ml_assemble"] = compose(vector, f"""
SELECT doc_id, [round(ifnull(n_chars, a), 6), round(ifnull(n_words, b), 6)] || {flags} AS features
FROM (SELECT *, {places} FROM train) t, means""")
    out["ml_feature_names"] = compose(freq, """
SELECT CAST(row_number() OVER (ORDER BY block, slot) - 1 AS INT) AS position, feature FROM (
  SELECT 0 AS block, 0 AS slot, 'n_chars_filled' AS feature UNION ALL SELECT 0, 1, 'n_words_filled'
  UNION ALL SELECT list_position(['lang', 'source', 'toxic'], column_name), category_index, column_name || '_is_' || value
  FROM idx WHERE value IS NOT NULL) named""")
    out["ml_fold_sizes"] = compose(tr, """
SELECT CAST(CAST('0x' || substr(md5(doc_id), 1, 8) AS BIGINT) % 5 AS INT) AS fold, COUNT(*) AS n_rows,
  CAST(SUM(quality) AS BIGINT) AS n_good FROM train GROUP BY fold""")
    out["ml_fold_statistics"] = compose(tr, """
SELECT CAST(k AS INT) AS fold, column_name, value, COUNT(*) AS n, round(avg(number), 6) AS mean
FROM (SELECT *, CAST('0x' || substr(md5(doc_id), 1, 8) AS BIGINT) % 5 AS own FROM train) t JOIN range(5) f(k) ON k <> own,
  LATERAL (VALUES ('n_chars', NULL, n_chars, n_chars IS NOT NULL), ('n_words', NULL, n_words, n_words IS NOT NULL),
    ('lang', lang, NULL, lang IS NOT NULL), ('source', source, NULL, source IS NOT NULL),
    ('toxic', CAST(toxic AS VARCHAR), NULL, toxic IS NOT NULL), ('quality', CAST(quality AS VARCHAR), NULL, TRUE)) c(column_name, value, number, there)
WHERE there GROUP BY k, column_name, value""")
    tree = freq + _tree_ctes()
    out["ml_tree_predict"] = compose(tree, """
SELECT doc_id, CAST(class AS DOUBLE) AS label, prediction, probability FROM train JOIN classes USING (quality) JOIN scored USING (doc_id)""")
    out["ml_score_saved_model"] = out["ml_score_by_paths"] = compose(
        tree, "SELECT doc_id, prediction, probability FROM test JOIN scored USING (doc_id)")
    out["ml_submission"] = compose(tree, """
SELECT doc_id, CAST(c.quality AS VARCHAR) AS predicted_quality FROM test JOIN scored USING (doc_id) JOIN classes c ON c.class = prediction""")
    out["ml_submission_csv"] = compose(tree, """
SELECT CAST(doc_id AS INT) AS doc_id, CAST(c.quality AS INT) AS predicted_quality
FROM test JOIN scored USING (doc_id) JOIN classes c ON c.class = prediction""")
    out["ml_tree_rules"] = compose(tree, """
SELECT CAST(dense_rank() OVER (ORDER BY l.node) - 1 AS INT) AS leaf, coalesce(any_value(s.name), CASE g.feature WHEN 0 THEN 'n_chars_filled' ELSE 'n_words_filled' END) AS feature,
  round(max(threshold) FILTER (substr(l.node, length(g.node) + 1, 1) = 'R'), 6) AS low,
  round(min(threshold) FILTER (substr(l.node, length(g.node) + 1, 1) = 'L'), 6) AS high, any_value(class_rows) AS class_rows,
  any_value(prediction) AS prediction, any_value(round(w.importance, 9)) AS importance
FROM leaves l JOIN splits g ON starts_with(l.node, g.node) AND l.node <> g.node LEFT JOIN slots s ON s.feature = g.feature
JOIN (SELECT feature, SUM(gain * n) / (SELECT SUM(gain * n) FROM splits WHERE node NOT IN (SELECT node FROM agree)) AS importance
      FROM splits WHERE node NOT IN (SELECT node FROM agree) GROUP BY feature) w ON w.feature = g.feature
GROUP BY l.node, g.feature""")
    return out


ML_SQL = _ml_sql()
