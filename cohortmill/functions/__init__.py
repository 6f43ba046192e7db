"""Column -> Column helpers; all of them stay inside whole-stage codegen."""

from cohortmill.functions.casts import strict_date, strict_int
from cohortmill.functions.measures import (
    clip_enrollment,
    fill_duration,
    has_status,
    open_duration_days,
    rate_pct,
    text_or_unknown,
)
from cohortmill.functions.text import (
    clean_phase,
    lower_trim,
    normalize_registry_code,
    upper_trim,
)

__all__ = [
    "clean_phase",
    "clip_enrollment",
    "fill_duration",
    "has_status",
    "lower_trim",
    "normalize_registry_code",
    "open_duration_days",
    "rate_pct",
    "strict_date",
    "strict_int",
    "text_or_unknown",
    "upper_trim",
]
