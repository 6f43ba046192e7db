"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortmill.llm import (
    chat,
    decontaminate,
    licenses,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secret_ledger,
    simhash,
    toxicity,
)
from cohortmill.llm.common import stored
from cohortmill.session import scratch

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "kept string, host string, hash bigint, removed string, fp double, path string, __row bigint, root int, `a.b` string, __key_kept int, c0 string"
)
PROSE = " ".join(f"word{i}" for i in range(70))
LONG = " ".join(f"w{i % 997} token{i}" for i in range(60_000))


def _row(doc_id, text, lang="en", source="a", n_chars=1):
    return (doc_id, text, lang, source, n_chars, "kept?", "host?", 1, "removed?", 0.5, "path?", 9, 3, "dot", 4, "c")


ROWS = [
    _row(1, None),
    _row(2, ""),
    _row(3, " \n\t\n"),
    _row(None, PROSE),
    _row(None, None, None, None, None),
    _row(4, PROSE, None, None, None),
    _row(5, PROSE + "\n" + PROSE.upper()),
    _row(6, "same " + PROSE, "de", "b"),
    _row(6, "same " + PROSE, "de", "b"),
    _row(6, "another text of the same id " + PROSE[::-1], "de", "b"),
    _row(7, LONG, "fr", "c", 10),
    _row(8, "é́ \U0001f600 <|endoftext|> \x00 \x1c", "es", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return stored(spark.createDataFrame(ROWS, SCHEMA), "edge-docs")


@pytest.fixture(scope="module")
def none(spark):
    return stored(spark.createDataFrame([], SCHEMA), "no-docs")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, PROSE), (2, None), (3, ""), (None, "four words only here"), (1, PROSE)]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 1), (2, 0, 0), (4, 1, 0), (5, None, None), (None, 1, 1), (6, 0, 1), (6, 1, 0), (6, 1, 0), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def ids(df, name="doc_id"):
    return sorted((r[0] for r in df.select(name).collect()), key=lambda x: (x is None, x))


ALL = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))


def test_quality_rules(docs, none):
    profile = quality_rules.profiles(docs)
    got = quality_rules.judge(profile)
    assert ids(got) == ALL
    by = {r["doc_id"]: r for r in got.filter("doc_id < 6 or doc_id > 6").collect()}
    assert [by[i]["n_words"] for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 70, 140]
    assert by[1]["base_failed"] and not by[1]["kept"] and by[4]["kept"]
    assert by[7]["n_words"] == 120_000 and by[7]["kept"]
    kept = quality_rules.clean(docs)
    assert kept.columns == docs.columns
    assert ids(kept) == [4, 5, 6, 6, 6, 7, None]
    assert quality_rules.judge(quality_rules.profiles(none)).count() == 0
    assert quality_rules.clean(none).count() == 0


def test_rows_of_one_id_are_judged_by_their_text(spark):
    rows = [(1, PROSE, "a"), (1, "short", "a"), (1, PROSE, None)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "one-id")
    assert sorted(map(tuple, quality_rules.clean(docs).collect()), key=repr) == sorted([rows[0], rows[2]], key=repr)


def test_line_dedup(docs, none):
    got = line_dedup.dedup_lines(docs)
    assert got.columns == docs.columns
    # Two pages of host "a" and two of "b" have a line in common; the one that the upper-case copy repeats, too.
    def left(row):
        text = {("a", PROSE): "", ("a", PROSE + "\n" + PROSE.upper()): "", ("b", "same " + PROSE): ""}.get((row[3], row[1]), row[1])
        return (row[0], text, *row[2:])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(left, ROWS), key=repr)
    assert line_dedup.dedup_lines(none).count() == 0


def test_hosts_of_few_pages(spark):
    """A banner on every page goes from two pages on; a lone page has no boilerplate."""
    rows = [(n, i, f"banner\nown line {n} {i}", f"host {n}") for n in range(1, 6) for i in range(n)]
    docs = spark.createDataFrame(rows, "n int, doc_id bigint, text string, source string")
    for r in line_dedup.dedup_lines(docs).collect():
        own = f"own line {r['n']} {r['doc_id']}"
        assert r["text"] == (f"banner\n{own}" if r["n"] == 1 else own)


def test_copies_count_as_documents(spark):
    """Eleven copies are over the limit of ten documents, ten are not."""
    rows = [(100 * n + i, f"{PROSE} {n}\nown {n} {i} {PROSE[::-1]}" if i else f"{PROSE} {n}", "h") for n in (10, 11) for i in range(n)]
    rows += [(2000 + i, f"{PROSE} 12", "h") for i in range(11)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "copies")
    got = {r["doc_id"]: r for r in quality_rules.judge(quality_rules.profiles(docs)).collect()}
    assert {r["removed_words"] for i, r in got.items() if 1000 <= i < 1010} == {0}
    assert {r["removed_words"] for i, r in got.items() if 1100 <= i < 1111} == {71}
    assert not any(got[2000 + i]["kept"] for i in range(11))


def test_a_second_scan_leaves_seen_texts_where_they_are(spark, plan):
    docs = stored(spark.range(3000).selectExpr("id AS doc_id", "concat('password=abcdef', id) AS text"), "ledger-docs")
    ledger = scratch(spark, "second-ledger")
    first = secret_ledger.scan(docs, ledger)
    more = docs.union(spark.createDataFrame([(9000 + i, f"token: zzzzzz{i}") for i in range(10)], docs.schema))
    second = secret_ledger.scan(stored(more, "more-docs"), ledger)
    assert second.filter("size(spans) > 0").count() == 3010
    assert second.filter("path < 9000").exceptAll(first).count() == 0
    assert spark.read.parquet(ledger).groupBy("blob", "rules").count().filter("count > 1").count() == 0
    # Few unseen blobs are sent to the texts, many meet them in a shuffle.
    todo = spark.createDataFrame([("x", 1, ["base"])], "blob string, path bigint, todo array<string>")
    read = docs.selectExpr("doc_id AS path", "text", "sha2(text, 256) AS blob")
    assert "BroadcastHashJoin" in plan(secret_ledger.unseen(read, todo))
    assert "Exchange hashpartitioning" not in plan(secret_ledger.unseen(read, todo))


def test_secret_ledger(docs, none, spark):
    got = secret_ledger.scan(docs, scratch(spark, "edge-ledger"))
    assert ids(got, "path") == ALL
    assert secret_ledger.scan(none, scratch(spark, "none-ledger")).count() == 0


def test_toxicity(docs, none, labels):
    got = toxicity.score(docs, labels)
    assert ids(got) == ALL
    assert got.filter("score is null or score < 0 or score > 1 or held_out is null").count() == 0
    assert toxicity.score(none, labels).count() == 0
    assert toxicity.score(docs, labels.limit(0)).filter("score <> 0").count() == 0


def test_quality_classifier(docs, none, labels):
    got = quality_classifier.score(docs, labels)
    assert ids(got) == ALL
    assert got.filter("score is null or isnan(score) or score < 0 or score > 1").count() == 0
    assert quality_classifier.score(none, labels).count() == 0
    assert quality_classifier.score(docs, labels.limit(0)).filter("score <> 0.5 or not kept").count() == 0


def test_simhash(docs, none):
    got = simhash.near_duplicates(docs)
    assert ids(got) == ALL
    by = {(r["doc_id"], r["text_key"]): r for r in got.collect()}
    empty = [r for r in by.values() if r["fp"] == 0]
    assert {r["component_id"] for r in empty} == {1}  # null and empty texts, null ids among them
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns
    assert one.count() == len({r["root"] for r in by.values()})
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_a_component_without_ids(spark):
    docs = stored(spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id bigint, text string"), "no-ids")
    assert [r["component_id"] for r in simhash.near_duplicates(docs).collect()] == [None, None]
    assert simhash.keep_one(docs).count() == 1


def test_chat(spark):
    rows = [
        (1, 0, "user", None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, None, "first"), (None, 0, "assistant", "x"),
        (2, 0, "assistant", LONG), (2, 1, "odd\nrole<|im_sep|>", "<|im_end|>"),
    ]
    conversations = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("ids", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.turns(conversations)).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 4, 2: 2, None: 1}
    assert got[2]["loss_chars"] == len(LONG) and got[1]["loss_chars"] == 0
    assert chat.read_back(chat.turns(conversations.limit(0))).count() == 0


def test_chat_ties_agree_with_sql(spark, tmp_path):
    from oracle_check import compare, connect

    from cohortmill.llm import queries
    from cohortmill.llm.oracles import ORACLES

    turns = [None, 0, 0, 1, None, 1, 0]
    rows = [(c, t, r, x) for c in (1, 2, None) for i, t in enumerate(turns) for r, x in (("user", f"b{i % 3}"), ("assistant", None), (None, "<|x"), ("user", "é"))]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(f"{tmp_path}/conversations.parquet")
    assert compare(queries.op6_chat_formatting(spark, str(tmp_path)), connect(str(tmp_path)), ORACLES["op6_chat_formatting"]) == []


def test_packing(docs, none):
    got = packing.pack(docs)
    assert set(ids(got)) == set(ALL)
    first = got.filter("start = 0").groupBy("doc_id").count()
    assert {r["doc_id"]: r["count"] for r in first.collect()} == {i: ALL.count(i) for i in set(ALL)}
    assert got.filter("doc_id in (1, 2, 3)").filter("doc_tokens <> 1").count() == 0
    assert packing.pack(none).count() == 0


def test_decontamination(docs, none, items):
    got = decontaminate.matches(docs, items)
    # The passage is whole in one text twice; two equal items give their match each.
    assert ids(got) == [4, 4, 5, 5, 6, 6, 6, 6, None, None]
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert ids(left) == [1, 2, 3, 6, 7, 8, None]
    assert decontaminate.clean(docs, items.limit(0)).count() == len(ROWS)
    assert decontaminate.matches(none, items).count() == 0 and decontaminate.clean(none, items).count() == 0


def test_licenses(docs, none):
    got = licenses.labelled(licenses.scan(docs))
    assert ids(got) == ALL
    assert got.filter("score <> 0 or labels <> ''").count() == 0
    assert licenses.scan(none).count() == 0


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, docs, none, sf_dir, name, empty):
    got = dict(corpus_pipeline.STAGES)[name](spark, none if empty else docs, sf_dir)
    assert got.count() == 0 if empty else got.count() > 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert got.columns == docs.columns
        assert [f.dataType for f in got.schema.fields] == [f.dataType for f in docs.schema.fields]
