"""Table contracts: source→Silver column mappings, natural keys, tracked
columns and the Silver/Gold schemas.  Data only, no logic.

Fixed values that must equal the warehouse being reproduced (table names,
column names, key and tracked-column sets, unknown-member defaults) are
stated here plainly and together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: technical column names --------------------------------
ID = "_tf_id"
VALID_FROM = "_tf_valid_from"
VALID_TO = "_tf_valid_to"
CREATE_DATE = "_tf_create_date"
UPDATE_DATE = "_tf_update_date"
HISTORY_COLS = [VALID_FROM, VALID_TO, CREATE_DATE, UPDATE_DATE]
AUDIT_COLS = [CREATE_DATE, UPDATE_DATE]

# --- fixed values: unknown member ----------------------------------------
UNKNOWN_KEY = -9
UNKNOWN_TEXT = "N/A"


@dataclass(frozen=True)
class SilverTable:
    """One Silver history table: source name, ordered (source, silver, type)
    columns, natural key and the tracked columns of the change test."""

    name: str
    source: str
    columns: tuple[tuple[str, str, str], ...]
    keys: tuple[str, ...]
    tracked: tuple[str, ...]

    @property
    def mapping(self) -> dict[str, str]:
        return {src: dst for src, dst, _ in self.columns}

    @property
    def silver_columns(self) -> list[str]:
        return [dst for _, dst, _ in self.columns]

    @property
    def types(self) -> dict[str, str]:
        return {dst: typ for _, dst, typ in self.columns}

    @property
    def source_keys(self) -> list[str]:
        return [src for src, dst, _ in self.columns if dst in self.keys]

    @property
    def source_key(self) -> str:
        """First source key column (the id the day-2 fixture rules read)."""
        return next(src for src, dst, _ in self.columns if dst == self.keys[0])


def _cols(spec: str) -> tuple[tuple[str, str, str], ...]:
    out = []
    for line in spec.strip().splitlines():
        src, dst, typ = line.split()
        out.append((src, dst, typ))
    return tuple(out)


#: Columns of hexadecimal text; merges shuffle it as bytes, at half the size.
HEX_TEXT = ("rowguid", "password_hash", "PasswordHash")

# --- fixed values: the ten Silver tables ---------------------------------
# (source column, silver column, Spark SQL type); rowguid and ModifiedDate
# close every table and are always tracked.
SILVER: dict[str, SilverTable] = {}


def _register(name, source, spec, keys, tracked):
    SILVER[name] = SilverTable(name, source, _cols(spec), tuple(keys), tuple(tracked))


_register("address", "Address", """
AddressID address_id int
AddressLine1 address_line1 string
AddressLine2 address_line2 string
City city string
StateProvince state_province string
CountryRegion country_region string
PostalCode postal_code string
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["address_id"],
    ["address_line1", "address_line2", "city", "state_province", "country_region",
     "postal_code", "rowguid", "modified_date"])

_register("customer", "Customer", """
CustomerID customer_id int
NameStyle name_style boolean
Title title string
FirstName first_name string
MiddleName middle_name string
LastName last_name string
Suffix suffix string
CompanyName company_name string
SalesPerson sales_person string
EmailAddress email_address string
Phone phone string
PasswordHash password_hash string
PasswordSalt password_salt string
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["customer_id"],
    ["name_style", "title", "first_name", "middle_name", "last_name", "suffix",
     "company_name", "sales_person", "email_address", "phone", "password_hash",
     "password_salt", "rowguid", "modified_date"])

_register("sales_order_header", "SalesOrderHeader", """
SalesOrderID sales_order_id int
RevisionNumber revision_number smallint
OrderDate order_date timestamp_ntz
DueDate due_date timestamp_ntz
ShipDate ship_date timestamp_ntz
Status status smallint
OnlineOrderFlag online_order_flag boolean
SalesOrderNumber sales_order_number string
PurchaseOrderNumber purchase_order_number string
AccountNumber account_number string
CustomerID customer_id int
ShipToAddressID ship_to_address_id int
BillToAddressID bill_to_address_id int
ShipMethod ship_method string
CreditCardApprovalCode credit_card_approval_code string
SubTotal sub_total decimal(19,4)
TaxAmt tax_amt decimal(19,4)
Freight freight decimal(19,4)
TotalDue total_due decimal(19,4)
Comment comment string
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["sales_order_id"],
    ["revision_number", "order_date", "due_date", "ship_date", "status",
     "online_order_flag", "sales_order_number", "purchase_order_number",
     "account_number", "customer_id", "ship_to_address_id", "bill_to_address_id",
     "ship_method", "credit_card_approval_code", "sub_total", "tax_amt", "freight",
     "total_due", "comment", "rowguid", "modified_date"])

_register("sales_order_detail", "SalesOrderDetail", """
SalesOrderID sales_order_id int
SalesOrderDetailID sales_order_detail_id int
OrderQty order_qty smallint
ProductID product_id int
UnitPrice unit_price decimal(19,4)
UnitPriceDiscount unit_price_discount decimal(19,4)
LineTotal line_total decimal(38,6)
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["sales_order_id", "sales_order_detail_id"],
    ["order_qty", "product_id", "unit_price", "unit_price_discount", "line_total",
     "rowguid", "modified_date"])

_register("customer_address", "CustomerAddress", """
CustomerID customer_id int
AddressID address_id int
AddressType address_type string
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["customer_id", "address_id"], ["address_type", "rowguid", "modified_date"])

_register("product_category", "ProductCategory", """
ProductCategoryID product_category_id int
ParentProductCategoryID parent_product_category_id int
Name name string
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["product_category_id"],
    ["parent_product_category_id", "name", "rowguid", "modified_date"])

_register("product_description", "ProductDescription", """
ProductDescriptionID product_description_id int
Description description string
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["product_description_id"], ["description", "rowguid", "modified_date"])

_register("product_model", "ProductModel", """
ProductModelID product_model_id int
Name name string
CatalogDescription catalog_description string
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["product_model_id"], ["name", "catalog_description", "rowguid", "modified_date"])

_register("product_model_product_description", "ProductModelProductDescription", """
ProductModelID product_model_id int
ProductDescriptionID product_description_id int
Culture culture string
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["product_model_id", "product_description_id", "culture"], ["rowguid", "modified_date"])

_register("product", "Product", """
ProductID product_id int
Name name string
ProductNumber product_number string
Color color string
StandardCost standard_cost decimal(19,4)
ListPrice list_price decimal(19,4)
Size size string
Weight weight decimal(19,4)
ProductCategoryID product_category_id int
ProductModelID product_model_id int
SellStartDate sell_start_date timestamp_ntz
SellEndDate sell_end_date timestamp_ntz
DiscontinuedDate discontinued_date timestamp_ntz
ThumbNailPhoto thumbnail_photo binary
ThumbnailPhotoFileName thumbnail_photo_file_name string
rowguid rowguid string
ModifiedDate modified_date timestamp_ntz
""", ["product_id"],
    ["name", "product_number", "color", "standard_cost", "list_price", "size", "weight",
     "product_category_id", "product_model_id", "sell_start_date", "sell_end_date",
     "discontinued_date", "thumbnail_photo", "thumbnail_photo_file_name", "rowguid",
     "modified_date"])


# --- fixed values: Gold dimension conforming rules -------------------------
@dataclass(frozen=True)
class DimSpec:
    """Gold SCD1 dimension: surrogate column, natural key, ordered
    (gold column, type, default) attributes that are compared and upserted."""

    name: str
    surrogate: str
    natural_key: str
    attributes: tuple[tuple[str, str, object], ...] = field(default_factory=tuple)

    @property
    def compared(self) -> list[str]:
        return [c for c, _, _ in self.attributes]

    @property
    def columns(self) -> list[str]:
        return [self.surrogate, self.natural_key, *self.compared, *AUDIT_COLS]


GEOGRAPHY = DimSpec("dim_geography", "_tf_dim_geography_id", "geo_address_id", (
    ("geo_address_line_1", "string", UNKNOWN_TEXT),
    ("geo_address_line_2", "string", UNKNOWN_TEXT),
    ("geo_city", "string", UNKNOWN_TEXT),
    ("geo_state_province", "string", UNKNOWN_TEXT),
    ("geo_country_region", "string", UNKNOWN_TEXT),
    ("geo_postal_code", "string", UNKNOWN_TEXT),
))

CUSTOMER = DimSpec("dim_customer", "_tf_dim_customer_id", "cust_customer_id", (
    ("cust_title", "string", UNKNOWN_TEXT),
    ("cust_first_name", "string", UNKNOWN_TEXT),
    ("cust_middle_name", "string", UNKNOWN_TEXT),
    ("cust_last_name", "string", UNKNOWN_TEXT),
    ("cust_suffix", "string", UNKNOWN_TEXT),
    ("cust_company_name", "string", UNKNOWN_TEXT),
    ("cust_sales_person", "string", UNKNOWN_TEXT),
    ("cust_email_address", "string", UNKNOWN_TEXT),
    ("cust_phone", "string", UNKNOWN_TEXT),
))

PRODUCT_CATEGORY = DimSpec("dim_product_category", "_tf_dim_product_category_id",
                           "prod_cat_category_id", (
    ("prod_cat_name", "string", UNKNOWN_TEXT),
    ("prod_cat_parent_category_id", "int", 0),
    ("prod_cat_level_1_id", "int", 0),
    ("prod_cat_level_1_name", "string", UNKNOWN_TEXT),
    ("prod_cat_level_2_id", "int", 0),
    ("prod_cat_level_2_name", "string", UNKNOWN_TEXT),
))

PRODUCT = DimSpec("dim_product", "_tf_dim_product_id", "prod_product_id", (
    ("prod_name", "string", UNKNOWN_TEXT),
    ("prod_product_number", "string", UNKNOWN_TEXT),
    ("prod_color", "string", UNKNOWN_TEXT),
    ("prod_standard_cost", "decimal(19,4)", 0),
    ("prod_list_price", "decimal(19,4)", 0),
    ("prod_size", "string", UNKNOWN_TEXT),
    ("prod_weight", "decimal(19,4)", 0),
    ("_tf_dim_product_category_id", "bigint", UNKNOWN_KEY),
    ("prod_product_model_id", "int", 0),
    ("prod_product_model_name", "string", UNKNOWN_TEXT),
    ("prod_product_model_catalog_description", "string", UNKNOWN_TEXT),
))

DIMS = {d.name: d for d in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT)}

# Fact table: grain = order line.
FACT_SURROGATE = "_tf_fact_sales_id"
FACT_KEYS = ("sales_order_id", "sales_order_detail_id")
FACT_COMPARED = (
    ("_tf_dim_calendar_id", "int"),
    ("_tf_dim_customer_id", "bigint"),
    ("_tf_dim_geography_id", "bigint"),
    ("_tf_dim_product_id", "bigint"),
    ("sales_order_qty", "smallint"),
    ("sales_unit_price", "decimal(19,4)"),
    ("sales_unit_price_discount", "decimal(19,4)"),
    ("sales_line_total", "decimal(38,6)"),
)
FACT_COLUMNS = [FACT_SURROGATE, *FACT_KEYS, *(c for c, _ in FACT_COMPARED), *AUDIT_COLS]

# Columns of the product preview.
PRODUCT_PREVIEW = ("_tf_dim_product_id", "prod_product_id", "prod_name", "prod_product_number", "prod_color",
                   "prod_list_price", "_tf_dim_product_category_id", "prod_product_model_name")
