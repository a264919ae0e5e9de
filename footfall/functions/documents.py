"""Reading fields out of variant columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def document_text(document: Column | str, path: str) -> Column:
    """Field at `path` (for example `$.labels[0]`) as text, NULL if absent."""
    return F.try_variant_get(document, path, "string")
