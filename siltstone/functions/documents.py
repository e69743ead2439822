"""Fields of landed JSON documents, read through VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_document(raw: Column) -> Column:
    """JSON text as VARIANT; unreadable text becomes NULL."""
    return F.try_parse_json(raw)


def field_or(doc: Column, path: str, default: str) -> Column:
    """Field as text. A missing key gives the default, an explicit null stays NULL.

    Whether the key is there at all is looked up only for fields without text.
    """
    missing = F.try_variant_get(doc, path, "variant").isNull()
    return F.coalesce(
        F.try_variant_get(doc, path, "string"), F.when(missing, F.lit(default))
    )


def required_field(doc: Column, path: str) -> Column:
    """Field as text; a document without the key fails the query."""
    present = F.try_variant_get(doc, path, "variant").isNotNull()
    return F.when(present, F.try_variant_get(doc, path, "string")).otherwise(
        F.raise_error(F.lit(f"a document has no {path}")).cast("string")
    )


def collection(doc: Column) -> Column:
    """Elements of the document's `collection` array; NULL if there is none."""
    return F.try_variant_get(doc, "$.collection", "array<variant>")
