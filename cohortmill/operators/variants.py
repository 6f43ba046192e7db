"""Studies as VARIANT: each text is parsed once, into a binary tree that keeps every field.

`envelope` reads a message with a fixed schema and the study inside again with another; fields that
the schemas don't name are lost, and a study is parsed twice. Here a message is parsed when it comes, bronze keeps the
study as a VARIANT column, and paths are read from that. `drift` tells where studies depart from what
is expected of them, day by day.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.operators.envelope import scalar_fields
from cohortmill.schemas import RAW_STUDY, STUDY_PATHS

# Columns of a study that are lists.
LISTS = ("phases", "conditions", "keywords", "location_countries", "primary_outcome_measures")


def parse_messages(bus: DataFrame, at: Column | None = None) -> DataFrame:
    """Bus rows with their fields and the study as VARIANT, good and bad ones alike; see `envelope.parse_messages`.

    The parsed message is unfolded by a generator, so that no filter parses it again.
    """
    at = F.current_timestamp() if at is None else at
    parsed = F.struct(F.try_parse_json("value").alias("message"))
    rows = bus.select("value", "timestamp", F.inline(F.array(parsed)))

    def text(name: str) -> Column:
        return F.try_variant_get("message", f"$.{name}", "string")

    return rows.select(
        text("nctId").alias("nct_id"),
        text("overallStatus").alias("overall_status"),
        text("briefTitle").alias("brief_title"),
        text("lastUpdatePostDate").alias("last_update_post_date"),
        F.try_variant_get("message", "$.raw", "variant").alias("raw"),
        F.col("timestamp").alias("kafka_timestamp"),
        at.alias("ingest_timestamp"),
        at.cast("date").alias("ingest_date"),
        "value",
        (F.col("message").isNull() & F.col("value").isNotNull()).alias("is_corrupt"),
    )


def _at(study: str, path: str, is_list: bool) -> Column:
    """What lies at a path: a text, or a list of texts, of the elements' field if the path goes on behind the list."""
    if not is_list:
        return F.try_variant_get(study, f"$.{path}", "string")
    head, name = path.rsplit(".", 1)
    whole = F.try_variant_get(study, f"$.{path}", "array<string>")
    elements = F.try_variant_get(study, f"$.{head}", "array<variant>")
    return F.coalesce(whole, F.transform(elements, lambda x: F.try_variant_get(x, f"$.{name}", "string")))


def to_raw_trials(bronze: DataFrame, paths: dict[str, str] = STUDY_PATHS, registry_codes: bool = False) -> DataFrame:
    """Staging input from bronze with VARIANT studies; fields of the envelope win, as in `envelope.bronze_to_raw_trials`."""
    fields = {name: _at("raw", path, name in LISTS).alias(name) for name, path in paths.items()}
    fields |= {name: F.col(name) for name in ("nct_id", "overall_status")}
    return scalar_fields(bronze.select("ingest_date", "ingest_timestamp", *fields.values()), registry_codes)


# --- drift -----------------------------------------------------------------------
def expected_paths(kind: T.DataType = RAW_STUDY, path: str = "$") -> Iterator[tuple[str, T.DataType]]:
    """All paths of a schema with their types; `[*]` stands for the elements of a list."""
    if path != "$":
        yield path, kind
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from expected_paths(field.dataType, f"{path}.{field.name}")
    elif isinstance(kind, T.ArrayType):
        yield from expected_paths(kind.elementType, f"{path}[*]")


def _values(study: str, path: str) -> Column:
    """All values at a path, as a list of VARIANT without nulls."""
    head, *rest = path.split("[*]")
    if not rest:
        return F.filter(F.array(F.try_variant_get(study, head, "variant")), _is_there)
    values = F.try_variant_get(study, head, "array<variant>")
    for i, step in enumerate(rest):
        inner = "array<variant>" if i < len(rest) - 1 else "variant"
        if step or inner != "variant":
            values = _each(values, f"${step}", inner)
        if inner != "variant":
            values = F.flatten(F.filter(values, lambda x: x.isNotNull()))
    return F.filter(F.coalesce(values, F.array().cast("array<variant>")), _is_there)


def _each(values: Column, path: str, kind: str) -> Column:
    return F.transform(values, lambda x: F.try_variant_get(x, path, kind))


def _any_misfit(values: Column, kind: T.DataType) -> Column:
    return F.exists(values, lambda v: ~_fits(v, kind))


def _named(names: Column, path: str, change: str) -> Column:
    return F.transform(names, lambda name: F.struct(F.concat(F.lit(f"{path}."), name).alias("path"), F.lit(change).alias("change")))


def _is_there(value: Column) -> Column:
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a value is of the kind that is expected: an object, a list, or a text."""
    shape = F.schema_of_variant(value)
    if isinstance(kind, T.StructType):
        return shape.startswith("OBJECT")
    if isinstance(kind, T.ArrayType):
        return shape.startswith("ARRAY")
    return shape == kind.simpleString().upper()


def drift(bronze: DataFrame, day: str = "ingest_date", study: str = "raw", schema: T.StructType = RAW_STUDY) -> DataFrame:
    """(day, path, change, n): how a day's studies depart from the schema.

    `new`: a field that isn't in the schema, under an object that is; n studies have it. `retyped`: a value
    of another type, in n studies. `gone`: a path that no study of the day has, n is the day's studies.

    Studies are grouped by day and shape (`schema_of_variant`) first: all of one shape depart alike, so one of them
    is looked at for all, and few rows leave a task.
    """
    shape = F.schema_of_variant(study).alias("shape")
    bronze = bronze.groupBy(F.col(day).alias(day), shape).agg(F.any_value(study).alias(study), F.count("*").alias("studies"))
    expected = list(expected_paths(schema))
    found = []
    for path, kind in [("$", schema), *expected]:
        values = _values(study, path) if path != "$" else F.filter(F.array(F.col(study)), _is_there)
        if path != "$":
            seen = F.size(values) > 0
            wrong = _any_misfit(values, kind)
            found.append(F.array(F.struct(F.lit(path).alias("path"), F.when(seen, "seen").otherwise("absent").alias("change"))))
            found.append(F.when(wrong, F.array(F.struct(F.lit(path).alias("path"), F.lit("retyped").alias("change")))))
        if isinstance(kind, T.StructType):
            known = F.array(*(F.lit(f.name) for f in kind.fields))
            keys = F.transform(values, lambda v: F.map_keys(F.try_variant_get(v, "$", "map<string, variant>")))
            others = F.array_except(F.array_distinct(F.flatten(F.filter(keys, lambda k: k.isNotNull()))), known)
            found.append(_named(others, path, "new"))
    none = F.array().cast("array<struct<path:string,change:string>>")
    shown = F.flatten(F.array(*(F.coalesce(x, none) for x in found)))
    counts = (
        bronze.select(F.col(day).alias("day"), "studies", F.explode(shown).alias("x"))
        .groupBy("day", "x.path", "x.change")
        .agg(F.sum("studies").alias("n"))
    )
    # A path is gone if it is absent from as many studies as the day has: never seen.
    seen = counts.filter("change = 'seen'").select(F.col("day").alias("d"), F.col("path").alias("p"))
    gone = counts.filter("change = 'absent'").join(
        seen, F.col("day").eqNullSafe(F.col("d")) & (F.col("path") == F.col("p")), "left_anti"
    )
    changed = counts.filter(F.col("change").isin("new", "retyped"))
    return changed.unionByName(gone.withColumn("change", F.lit("gone")))
