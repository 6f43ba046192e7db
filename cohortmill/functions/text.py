"""String standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortmill.schemas import SILVER_PHASES

# Labels that contain another label are looked for before it; a text that holds
# several labels takes the first of these, wherever it stands in the text.
COMPOUND_PHASES = ["early phase 1", "phase 1/phase 2", "phase 2/phase 3"]
_NO_PHASE = "n/a"


def lower_trim(column: Column) -> Column:
    return F.lower(F.trim(column))


def upper_trim(column: Column) -> Column:
    return F.upper(F.trim(column))


def clean_phase(column: Column) -> Column:
    """The standard phase a free text names, or `n/a` for none, blank or null."""
    simple = [p for p in SILVER_PHASES if p not in COMPOUND_PHASES and p != _NO_PHASE]
    text = F.lower(column)
    named = [F.when(text.contains(label), label) for label in COMPOUND_PHASES + simple]
    return F.coalesce(*named, F.lit(_NO_PHASE))


def normalize_registry_code(column: Column) -> Column:
    """Registry codes (`EARLY_PHASE1`, `PHASE1`, `NA`) in the wording `clean_phase` reads.

    `clean_phase` itself maps an un-spaced code to `n/a`; apply this first where
    the source sends codes. Other text is left alone but for the spacing.
    """
    spaced = F.regexp_replace(F.replace(column, F.lit("_"), F.lit(" ")), r"(?i)\bphase(\d)", "Phase $1")
    return F.when(F.upper(F.trim(column)) == "NA", "N/A").otherwise(spaced)
