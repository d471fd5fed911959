"""Code cleaning and code-to-label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mesura.schemas import AGE_BANDS, UNKNOWN


def label(c: Column, mapping: dict, default: str | None = UNKNOWN) -> Column:
    """Code -> label as one CASE; unknown codes and null get ``default``."""
    out = None
    for code, text in mapping.items():
        out = F.when(c == F.lit(code), F.lit(text)) if out is None else out.when(c == F.lit(code), F.lit(text))
    return out.otherwise(F.lit(default)) if default is not None else out


def lenient_long(c: Column) -> Column:
    """Numeric parse to a nullable long: unparsable -> null, "3.0" -> 3.

    Read as a decimal, so integers keep all their digits. A non-integral value
    (e.g. "3.7") cannot be a count or a code; it becomes null here, where the
    surveyed pipeline stops with an error (``clean.coerce_types`` counts them).
    """
    d = F.trim(c.cast("string")).try_cast("decimal(38,10)")
    return F.when(d % 1 == 0, d.try_cast("long"))


def null_text(c: Column) -> Column:
    """String cast where the text "nan" means missing."""
    s = c.cast("string")
    return F.when(s == "nan", F.lit(None).cast("string")).otherwise(s)


def norm_code(c: Column, width: int = 5) -> Column:
    """Territory code: drop a trailing ".0", left-pad with zeros to ``width``
    (never truncating longer codes), and null the padded forms of nan/NA."""
    s = F.regexp_replace(c.cast("string"), r"\.0$", "")
    padded = F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)
    bad = [("0" * width + "nan")[-width:], ("0" * width + "na")[-width:], "nan"]
    return F.when(padded.isin(*bad), F.lit(None).cast("string")).otherwise(padded)


def age_band(age: Column, missing: str | None = None) -> Column:
    """Five-year band by ordered upper-bound tests (negatives fall in the
    first band); a null age gives ``missing``."""
    out = F.when(age.isNull(), F.lit(missing))
    for upper, text in AGE_BANDS:
        out = out.when(age <= upper, F.lit(text)) if upper is not None else out.otherwise(F.lit(text))
    return out


def age_order(age: Column) -> Column:
    """Position 1..17 of the band of ``age``; null age -> null."""
    out = F.when(age.isNull(), F.lit(None).cast("long"))
    for i, (upper, _) in enumerate(AGE_BANDS, start=1):
        out = out.when(age <= upper, F.lit(i).cast("long")) if upper is not None else out.otherwise(F.lit(i).cast("long"))
    return out
