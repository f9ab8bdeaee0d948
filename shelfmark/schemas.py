"""Declared schemas. No production path infers a schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
TIME, DATE, MONEY = T.TimestampType(), T.DateType(), T.DecimalType(18, 2)

PRODUCTS = _struct(
    item_id=LONG, name=TEXT, created_time=TIME, updated_time=TIME,
    primary_category=INT, status=TEXT, created_date=DATE,
)
SKUS = _struct(
    item_id=LONG, sku_id=LONG, seller_sku=TEXT, shop_sku=TEXT, status=TEXT, quantity=INT,
    available=INT, price=MONEY, special_price=MONEY, created_date=DATE,
)
IMAGES = _struct(item_id=LONG, image_url=TEXT, created_date=DATE)
ATTRIBUTES = _struct(item_id=LONG, brand=TEXT, description=TEXT, created_date=DATE)

PRICE_POINTS = _struct(item_id=LONG, name=TEXT, price=T.DoubleType(), quantity=INT, timestamp=TIME)

# Message shapes. The SKU keys are those of the marketplace documents.
MESSAGE_SKUS = T.ArrayType(_struct(
    SkuId=LONG, SellerSku=TEXT, ShopSku=TEXT, Status=TEXT, quantity=INT, Available=INT,
    price=MONEY, special_price=MONEY,
))
MESSAGE_ATTRIBUTES = _struct(name=TEXT, brand=TEXT, description=TEXT)

# A product with very many children comes in `parts` messages under one header.
ENVELOPE_V1 = _struct(
    timestamp=TEXT,
    data=_struct(
        id=TEXT, name=TEXT, created_time=TEXT, updated_time=TEXT, primary_category=INT,
        status=TEXT, images=T.ArrayType(TEXT), skus=MESSAGE_SKUS, attributes=MESSAGE_ATTRIBUTES,
    ),
    part=INT, parts=INT,
)
ENVELOPE_V0 = _struct(
    product=_struct(item_id=LONG, name=TEXT, created_time=TIME, updated_time=TIME,
                    primary_category=INT, status=TEXT),
    skus=T.ArrayType(_struct(item_id=LONG, sku_id=LONG, seller_sku=TEXT, shop_sku=TEXT, status=TEXT,
                             quantity=INT, available=INT, price=MONEY, special_price=MONEY)),
    images=T.ArrayType(_struct(item_id=LONG, image_url=TEXT)),
    attributes=_struct(item_id=LONG, brand=TEXT, description=TEXT),
)
API_PRODUCT = _struct(
    created_time=TEXT, updated_time=TEXT, images=T.ArrayType(TEXT), skus=MESSAGE_SKUS,
    item_id=LONG, primary_category=INT, attributes=MESSAGE_ATTRIBUTES, status=TEXT,
)
API_PAGE = _struct(
    data=_struct(total_products=INT, products=T.ArrayType(API_PRODUCT)), _corrupt_record=TEXT,
)

FLAT_STREAM = [
    "item_id", "name", "created_time", "updated_time", "primary_category", "status",
    "price", "quantity", "image_url", "brand", "description", "processing_time",
]
FULL_PRODUCTS = [
    "item_id", "name", "created_time", "updated_time", "primary_category", "status",
    "sku_id", "seller_sku", "shop_sku", "sku_status", "quantity", "available",
    "price", "special_price", "brand", "description", "image_url",
]

# Keys and text limits of the four tables.
KEYS = {
    "products": ["item_id"],
    "skus": ["item_id", "sku_id"],
    "images": ["item_id", "image_url"],
    "attributes": ["item_id"],
}
LENGTH_LIMITS = {
    "products": {"name": 255, "status": 50},
    "skus": {"seller_sku": 100, "shop_sku": 100, "status": 50},
    "images": {},
    "attributes": {"brand": 100},
}

TABLES = {"products": PRODUCTS, "skus": SKUS, "images": IMAGES, "attributes": ATTRIBUTES}


@dataclass(frozen=True)
class Catalog:
    """The four related tables; `item_id` links the last three to the first."""

    products: DataFrame
    skus: DataFrame
    images: DataFrame
    attributes: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project a frame onto a declared schema: column order and types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
