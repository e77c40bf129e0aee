"""JSON properties of events, parsed once into a variant and shredded to typed columns.

A text that is no JSON is kept apart, not dropped and not an error; a field that is missing,
JSON null or of a kind that its type can't take is null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shredded(events: DataFrame, fields: dict[str, str], column: str = "props") -> DataFrame:
    """``events`` without ``column`` and with one column per entry of ``fields`` (name: type) and
    ``json_kind``: the schema of the value (as ``OBJECT<k: BIGINT>``), ``BAD`` if the text is no JSON, null
    if there is no text."""
    rest = [c for c in events.columns if c != column]
    clash = [f for f in (*fields, "json_kind") if f in rest]
    if clash:
        raise ValueError(f"columns {clash} exist already")
    parsed = events.withColumn("_v", F.try_parse_json(column))
    kind = F.when(F.col(column).isNull(), F.lit(None)).when(F.col("_v").isNull(), "BAD").otherwise(F.schema_of_variant("_v"))
    return parsed.select(*rest, *[F.try_variant_get("_v", f"$.{name}", t).alias(name) for name, t in fields.items()], kind.alias("json_kind"))


def bad_rows(events: DataFrame, column: str = "props") -> DataFrame:
    """The rows whose text is no JSON, as they came."""
    return events.where(F.col(column).isNotNull() & F.try_parse_json(column).isNull())


def kinds(shreds: DataFrame) -> DataFrame:
    """How many rows have each kind: shows fields of mixed types."""
    return shreds.groupBy("json_kind").agg(F.count(F.lit(1)).alias("n_rows"))
