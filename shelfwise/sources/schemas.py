"""Schemas of raw files and tables, and the cast to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SHOP_PAGE = """id bigint, title string, handle string, body_html string, published_at string, created_at string, vendor string,
product_type string, tags array<string>, variants array<struct<id:bigint,title:string,featured_image:struct<src:string>,
available:boolean,price:string,compare_at_price:string,grams:bigint,created_at:string,updated_at:string>>"""
#: Fields of a stock record as they arrive: all text.
STOCK_FIELDS = (
    "Id ManufacturerName PlasticName ModelName AdditionalInputTitle ModelLink StockWeight AvailableStock ColorName StockPrice "
    "StockImage ModelDescription"
).split()
STOCK_PAGE = f"recordsTotal bigint, data array<struct<{', '.join(f'{f}: string' for f in STOCK_FIELDS)}>>"
CRAWL = """source string, start_url string, sitemap_url string, fetched_at string, products array<struct<url:string,fetched_at:string,html:string>>,
skipped_urls array<struct<url:string,error:string,kind:string,fetched_at:string>>"""
STORES = "URL string, API_URL string, IsShopify bigint, UseUnpagedProductsJson bigint"

#: Columns of a variant; its row hash is over all but the first three.
VARIANT = (
    "id product_id variant_id title vendor product_link store store_url image variant_title price weight_g in_stock variant_image "
    "high_price low_price tags IsDistanceDriver IsFairwayDriver IsMidrange IsPutter BodyHtml product_type"
).split()
FLAGS = ("IsDistanceDriver", "IsFairwayDriver", "IsMidrange", "IsPutter")
_NUMBERS = {"price": "double", "weight_g": "bigint", "in_stock": "boolean", "high_price": "double", "low_price": "double"}
#: The snapshot view's types, and those of what is hashed and logged.
VIEW_TYPES = {c: _NUMBERS.get(c, "bigint" if c in FLAGS else "string") for c in VARIANT}
LOG_TYPES = {c: "boolean" if c == "in_stock" or c in FLAGS else "string" for c in VARIANT}
VARIANT_STATE = ", ".join(f"{c} {t}" for c, t in LOG_TYPES.items()) + ", row_hash string, last_seen_at timestamp"
VARIANT_CHANGES = (
    "batch_run_id string, batch_run_ts timestamp, operation string, "
    + ", ".join(f"{c} {t}" for c, t in LOG_TYPES.items())
    + ", row_hash string, change_ts timestamp"
)
STOCK = (
    "Id bigint, ManufacturerName string, PlasticName string, ModelName string, AdditionalInputTitle string, ModelLink string, "
    "StockWeight bigint, AvailableStock bigint, ColorName string, StockPrice double, StockImage string, ModelDescription string, "
    "record_timestamp timestamp"
)
TABLE_SHOP = (
    "ProductId bigint, VariationId bigint, ProductName string, Sku string, ProductLink string, ProductUrl string, CanonicalUrl string, "
    "ImageUrl string, Description string, ManufacturerName string, DiscTypeName string, ColorName string, PlasticName string, "
    "StampFoil string, Weight string, ScaledWeight string, Flatness string, Stiffness string, StockPrice double, Currency string, "
    "StockText string, AvailableStock bigint, IsOutOfStock boolean, VariantAttributesJson string, Speed double, Glide double, "
    "Turn double, Fade double, record_timestamp timestamp"
)
OPTION_SHOP = (
    "ProductId bigint, ProductName string, Sku string, ProductLink string, ProductUrl string, CanonicalUrl string, ImageUrl string, "
    "Description string, Availability string, StockStatusText string, IsOutOfStock boolean, ListPrice double, SalePrice double, "
    "Currency string, ProductWeightValue double, ProductWeightUnits string, ProductWeightText string, ManufacturerSlug string, "
    "ManufacturerName string, PlasticSlug string, PlasticName string, ProductSlug string, CategoryPath string, "
    "CatalogWeightSummary string, record_timestamp timestamp, VariantLabel string, VariantOptionId string, VariantOptionLabel string, "
    "VariantWeightGrams string"
)
INDEX_RUNS = (
    "batch_run_id string, status string, started_at timestamp, completed_at timestamp, rows_seen bigint, upserts bigint, deletes bigint, "
    "unknown_ops bigint, upsert_batches bigint, delete_batches bigint, error_message string, updated_at timestamp"
)
RUN_AUDIT = (
    "run_id string, command string, status string, started_at timestamp, completed_at timestamp, stores_planned bigint, "
    "stores_succeeded bigint, stores_failed bigint, pages_saved bigint, http_error_events bigint, request_exception_events bigint, "
    "successful_retry_pages bigint, empty_page_events bigint, page1_failures bigint, error_count bigint, http_status_summary string, "
    "error_summary string, failed_store_summary string, failed_request_summary string, output_mode string, log_file string, "
    "updated_at timestamp"
)


def struct(schema: str) -> StructType:
    """Columns as the type of one value."""
    return StructType.fromDDL(schema)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of schema in order, cast; missing ones null. A value that can't be cast fails the query."""
    wanted = StructType.fromDDL(schema)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])
