"""Product messages to flat rows; the same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.columns import first_element
from shelfmark.schemas import ENVELOPE_V0, ENVELOPE_V1, FLAT_STREAM

VERSIONS = ("auto", "v1", "v0")


def parse_messages(df: DataFrame, version: str = "auto", value: str = "value") -> DataFrame:
    """Adds `v1`, `v0` and `matched`, the envelope a message fits (`v1`, `v0`) or NULL."""
    if version not in VERSIONS:
        raise ValueError(f"version must be one of {VERSIONS}")
    text = F.col(value).cast("string")
    mode = {"mode": "PERMISSIVE"}
    is_v1 = F.col("v1.data.id").try_cast("bigint").isNotNull() & F.lit(version != "v0")
    is_v0 = F.col("v0.product.item_id").isNotNull() & F.lit(version != "v1")
    # Only a message that is not of the first shape is parsed a second time.
    out = df.withColumn("v1", F.from_json(text, ENVELOPE_V1, mode))
    out = out.withColumn("v0", F.from_json(F.when(~F.coalesce(is_v1, F.lit(False)), text), ENVELOPE_V0, mode))
    return out.withColumn("matched", F.when(is_v1, F.lit("v1")).when(is_v0, F.lit("v0")))


def flatten_stream(df: DataFrame, version: str = "auto", value: str = "value",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Twelve flat columns per message with the first SKU and the first image.

    Messages of neither shape are left to `unmatched`; continuation parts repeat a product whose
    first SKU and image came with part 0, so they give no row. `keep` names input columns to carry.
    """
    parsed = parse_messages(df, version, value).filter(F.col("matched").isNotNull())
    parsed = parsed.filter(F.coalesce("v1.part", F.lit(0)) == 0)

    def either(v1: Column, v0: Column, name: str) -> Column:
        return F.when(F.col("matched") == "v1", v1).otherwise(v0).alias(name)

    c = F.col
    sku1, sku0 = first_element("v1.data.skus"), first_element("v0.skus")
    flat = parsed.select(
        either(c("v1.data.id").try_cast("bigint"), c("v0.product.item_id"), "item_id"),
        either(c("v1.data.name"), c("v0.product.name"), "name"),
        either(c("v1.data.created_time").try_cast("timestamp"), c("v0.product.created_time"), "created_time"),
        either(c("v1.data.updated_time").try_cast("timestamp"), c("v0.product.updated_time"), "updated_time"),
        either(c("v1.data.primary_category"), c("v0.product.primary_category"), "primary_category"),
        either(c("v1.data.status"), c("v0.product.status"), "status"),
        either(sku1["price"], sku0["price"], "price"),
        either(sku1["quantity"], sku0["quantity"], "quantity"),
        either(first_element("v1.data.images"), first_element("v0.images")["image_url"], "image_url"),
        either(c("v1.data.attributes.brand"), c("v0.attributes.brand"), "brand"),
        either(c("v1.data.attributes.description"), c("v0.attributes.description"), "description"),
        F.current_timestamp().alias("processing_time"),
        c("v1.timestamp").try_cast("timestamp").alias("message_time"),
        *keep,
    )
    return flat.select(*FLAT_STREAM, *(k for k in keep if k not in FLAT_STREAM))


def unmatched(df: DataFrame, version: str = "auto", value: str = "value") -> DataFrame:
    """Messages that fit neither envelope, for counting or quarantine."""
    return parse_messages(df, version, value).filter(F.col("matched").isNull()).drop("v1", "v0", "matched")
