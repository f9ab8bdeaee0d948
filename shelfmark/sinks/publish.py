"""Messages out: product documents and table snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.columns import iso_text
from shelfmark.plans.documents import document_json
from shelfmark.schemas import Catalog


def publish(messages: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """Write a `value` column to a topic, or as text lines to `path`."""
    writer = messages.write.format(fmt).options(**options)
    (writer.mode("overwrite") if fmt == "text" else writer).save()


def publish_products(docs: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """One message per product document; batching is left to the sink."""
    publish(document_json(docs), fmt, options)


def snapshot_messages(catalog: Catalog) -> DataFrame:
    """One JSON message per table row, tagged with its table. Dates as ISO text, decimals as numbers."""
    def plain(df: DataFrame, field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = iso_text(column)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        return column.alias(field.name)

    out = None
    for name, df in catalog.tables().items():
        body = F.to_json(F.struct(*[plain(df, f) for f in df.schema.fields]), {"ignoreNullFields": "false"})
        rows = df.select(F.lit(name).alias("table"), body.alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def publish_snapshot(catalog: Catalog, fmt: str, options: dict[str, str]) -> None:
    tagged = snapshot_messages(catalog)
    message = F.concat(F.lit('{"table":"'), F.col("table"), F.lit('","row":'), F.col("value"), F.lit("}"))
    publish(tagged.select(message.alias("value")), fmt, options)
