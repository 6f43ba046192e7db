"""Secret scans with an incremental ledger of blobs.

A history is a table of paths and contents, a row for each version of a file. Contents are
addressed by their SHA-256, so equal ones are one blob. The ledger is a Parquet folder with a
row for each blob and version of a rule set that has been scanned, findings or none. A scan
takes the pairs not in the ledger, reads the text of one path for each blob, appends
what it finds, and joins the findings back to all paths. A changed rule set has a new
version and is scanned over all blobs again; the others are left alone.

Everything is DataFrame functions. Places of matches: the text is split at the matches, and a
match begins after all pieces and matches before it. Texts are shuffled once, one copy
each; all else that is shuffled is digests and findings.

Defined cases: null content is the empty blob. Null paths and repeated rows are paths
like others and get their blob's findings. Matches of a kind don't overlap, those of
different kinds may. An append that was interrupted may be repeated: rows of a pair are equal
and count once. Columns that the operator doesn't name are ignored; an empty history gives
an empty result. Places count code points, the end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortmill.llm.common import sha256_of, stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of `pattern` whose group has at least `least` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


@dataclass(frozen=True)
class RuleSet:
    name: str
    version: int
    rules: tuple[Rule, ...]

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The patterns. Runs are matched only from their least length on where
# that gives the same matches.
BASE = RuleSet(
    "base",
    1,
    (
        Rule(
            "assign",
            r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            least=6,
            group=2,
        ),
        Rule("access", r"AKIA[A-Z0-9]{16,}"),
        Rule("hex", r"[0-9a-f]{24,}"),
    ),
)
MARKED = RuleSet(
    "marked",
    1,
    (
        Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
        Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
        Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
        Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    ),
)
RULE_SETS = (BASE, MARKED)

SPAN = "struct<start:bigint,kind_order:int,kind:string,end:bigint>"
LEDGER = f"blob string, rules string, spans array<{SPAN}>"


def read_ledger(spark, path: str) -> DataFrame:
    """All rows of a ledger; none if there is no ledger yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def find(texts: DataFrame, rule_sets: tuple[RuleSet, ...] = RULE_SETS) -> DataFrame:
    """(blob, rules, kind_order, kind, start, end) in `texts` (blob, text, todo).

    `todo` names the rule sets to apply to a text. Texts without a match end in the first step.
    """
    numbered = [(order, rules.key, rule) for order, (rules, rule) in enumerate((s, r) for s in rule_sets for r in s.rules)]
    tried = [
        F.struct(
            F.lit(order).alias("kind_order"),
            F.when(F.array_contains("todo", key), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))).alias("hits"),
        )
        for order, key, rule in numbered
    ]
    hit = texts.select(
        "blob", "text", F.explode(F.filter(F.array(*tried), lambda x: F.size(x["hits"]) > 0)).alias("x")
    ).select("blob", "text", "x.kind_order", "x.hits")

    def by_kind(value):
        """CASE over the kinds, so that each pattern is compiled once."""
        first, *rest = [(F.col("kind_order") == order, value(key, rule)) for order, key, rule in numbered]
        return reduce(lambda case, other: case.when(*other), rest, F.when(*first))

    between = by_kind(lambda key, rule: F.split("text", rule.pattern, -1))
    each = hit.select(
        "blob",
        "kind_order",
        F.posexplode(F.arrays_zip("hits", F.transform(between, F.length).alias("before"))).alias("number", "x"),
    ).filter("x.hits is not null")
    upto = W.partitionBy("blob", "kind_order").orderBy("number")
    length = F.length("x.hits")
    end = F.sum((F.col("x.before") + length).cast("bigint")).over(upto)
    core = by_kind(lambda key, rule: F.length(F.regexp_extract("hit", rule.pattern, rule.group)) >= rule.least)
    return (
        each.distinct()  # a text that came by several rows of one path
        .select("blob", "kind_order", F.col("x.hits").alias("hit"), end.alias("end"), length.alias("length"))
        .filter(core)
        .select(
            "blob",
            by_kind(lambda key, rule: F.lit(key)).alias("rules"),
            "kind_order",
            by_kind(lambda key, rule: F.lit(rule.kind)).alias("kind"),
            (F.col("end") - F.col("length")).alias("start"),
            "end",
        )
    )


# Rows of about 200 bytes that are sent to all executors.
FEW = 20_000


def unseen(read: DataFrame, todo: DataFrame) -> DataFrame:
    """(blob, text, todo): the rows of `read` whose blob has something to do, by one path each.

    Where a few blobs are new, as in most scans after the first, these are counted and broadcast, and no
    text is moved; otherwise the texts meet them in a shuffle, `todo` being hashed.
    """
    t = todo.select(F.col("blob").alias("t_blob"), F.col("path").alias("t_path"), "todo")
    t = F.broadcast(t) if todo.count() <= FEW else t.hint("shuffle_hash")
    met = read.join(t, (F.col("blob") == F.col("t_blob")) & F.col("path").eqNullSafe(F.col("t_path")))
    return met.select("blob", "text", "todo")


def scan(
    history: DataFrame,
    ledger: str,
    path: str = "doc_id",
    content: str = "text",
    rule_sets: tuple[RuleSet, ...] = RULE_SETS,
) -> DataFrame:
    """(path, blob, spans) of each row of `history`, after the ledger has been brought up to date."""
    spark = history.sparkSession
    wanted = [s.key for s in rule_sets]
    read = history.select(F.col(path).alias("path"), F.coalesce(F.col(content), F.lit("")).alias("text"))
    read = read.withColumn("blob", sha256_of(F.col("text")))
    paths = stored(read.select("path", "blob"), "paths")
    pairs = (
        paths.groupBy("blob")
        .agg(F.min("path").alias("path"))
        .withColumn("rules", F.explode(F.array(*map(F.lit, wanted))))
    )
    todo = (
        pairs.join(read_ledger(spark, ledger).select("blob", "rules"), ["blob", "rules"], "left_anti")
        .groupBy("blob", "path")
        .agg(F.collect_set("rules").alias("todo"))
    )
    todo = stored(todo, "todo")
    found = (
        find(unseen(read, todo), rule_sets)
        .groupBy("blob", "rules")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind_order", "kind", "end"))).alias("spans"))
    )
    (
        todo.select("blob", F.explode("todo").alias("rules"))
        .join(found, ["blob", "rules"], "left")
        .select("blob", "rules", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))
        .write.mode("append")
        .parquet(ledger)
    )
    return _by_path(paths, read_ledger(spark, ledger), wanted)


def _by_path(paths: DataFrame, ledger: DataFrame, wanted: list[str]) -> DataFrame:
    """The paths with the findings of the rule sets wanted; only blobs with findings take part in the join."""
    hits = (
        ledger.filter(F.col("rules").isin(wanted) & (F.size("spans") > 0))
        .dropDuplicates(["blob", "rules"])
        .groupBy("blob")
        .agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    )
    none = F.array().cast(f"array<{SPAN}>")
    return paths.join(hits, "blob", "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))
