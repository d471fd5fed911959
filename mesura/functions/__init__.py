"""Column-level helpers (all JVM-side expressions; no Python UDF)."""

from mesura.functions.blank import (blank_count, blank_sub, div, div0, pct1, selected_value,
                                    distinct_count_with_blank)
from mesura.functions.labels import age_band, age_order, label, lenient_long, null_text, norm_code
from mesura.functions.text import normalise_name

__all__ = [
    "blank_count", "blank_sub", "div", "div0", "pct1", "selected_value",
    "distinct_count_with_blank", "age_band", "age_order", "label", "lenient_long",
    "null_text", "norm_code", "normalise_name",
]
