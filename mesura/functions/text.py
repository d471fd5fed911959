"""Text normalisation used by name-keyed joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(c: Column) -> Column:
    """Join key for municipality names: trimmed, blanks removed, compared by a
    collation that ignores case and accents of every script; a null name is
    the empty string."""
    key = F.coalesce(F.regexp_replace(F.trim(c.cast("string")), " ", ""), F.lit(""))
    return F.collate(key, "UNICODE_CI_AI")
