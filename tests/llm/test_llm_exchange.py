"""Token alignment, bundles of records and repair of turns against plain recomputations."""

from __future__ import annotations

import hashlib
import io
import os
import random
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from cohortmill.llm import queries, token_alignment, turn_repair, warc_bundles
from cohortmill.llm.chat import id_bytes

# ---- 11


def plain_alignment(texts):
    """(n_a, n_b, groups, links) of each text by comparing all offsets; none where bytes differ."""
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = token_alignment.default_tokenizers()
    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    bytes_a = id_bytes(a)

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts = [bytes_a[i] for i in ids[0]], [bytes_b(i) for i in ids[1]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            out.append(None)
            continue
        ends = []
        for p in parts:
            ends.append([sum(map(len, p[: i + 1])) for i in range(len(p))] if len(p) < 500 else None)
            if ends[-1] is None:
                at, ends[-1] = 0, []
                for x in p:
                    ends[-1].append(at := at + len(x))
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, links, before = [], [], 0
        groups_a, groups_b = defaultdict(list), defaultdict(list)
        import bisect

        for side, held in ((0, groups_a), (1, groups_b)):
            for i, end in zip(ids[side], ends[side]):
                held[common[bisect.bisect_left(common, end)]].append(i)
        for end in common:
            groups.append(",".join(map(str, groups_a[end])) + "|" + ",".join(map(str, groups_b[end])))
            links.append((groups_a[end][-1], groups_b[end][-1]))
        out.append((len(ids[0]), len(ids[1]), ";".join(groups), links))
    return out


def expected_alignment(texts):
    found = plain_alignment(texts)
    counts = Counter(link for f in found if f for link in f[3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_best = sum(counts[x] == best[x[1]] for x in f[3])
        total = sum(counts[x] for x in f[3])
        rows.append((f[0], f[1], len(f[3]), len(f[3]), n_best, total, hashlib.sha256(f[2].encode()).hexdigest()))
    return rows, counts, best


ODD = [
    None, "", " ", "a", "a  b", " a b", "a b ", "a \n b", "a\n b\n\n c", "a\t b\n \nc", "it's we'll 'tis", "<|endoftext|> x",
    "a▁b c", " x  y", "x  y", "İstanbul ﬁne ½ café", "\U0001f600 \U0001f468‍\U0001f469", "\x00 \x1c \x85 z", "a <0x41> <s> </s> <unk>",
    "12345 67,8.9", "\r\nline one\r\nline two", "same words same words same words", "same words same words same words",
]


def test_alignment_equals_plain_counting(spark, sf_dir, rows):
    held = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    texts = ODD + held
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, counts, best = expected_alignment(texts)
    for slot_records in (token_alignment.SLOT_RECORDS, 50):
        got = token_alignment.align(docs, slot_records=slot_records).orderBy("doc_id").select("doc_id", *columns).collect()
        assert [tuple(r) for r in got] == [(i, *w) for i, w in enumerate(want)]
    links = {(r["a_id"], r["b_id"]): (r["n"], r["best"]) for r in token_alignment.links(docs).collect()}
    assert links == {x: (n, n == best[x[1]]) for x, n in counts.items()}


def test_alignment_of_long_words_repeats_and_no_rows(spark):
    long = "ab" * 60_000 + " " + " ".join(f"w{i}" for i in range(20_000))
    texts = [long, long, "x y", None]
    docs = spark.createDataFrame(
        [(i if i < 3 else None, t, "b?", 1.5) for i, t in enumerate(texts)], "doc_id bigint, text string, bucket string, batch double"
    )
    got = {r["doc_id"]: r for r in token_alignment.align(docs).collect()}
    want, _, _ = expected_alignment(texts)
    for i in (0, 1, 2):
        assert (got[i]["n_a"], got[i]["n_best"], got[i]["count_sum"], got[i]["groups_sha256"]) == (want[i][0], *want[i][4:])
    assert (got[None]["n_a"], got[None]["count_sum"], got[None]["groups_sha256"]) == (0, 0, "")
    assert token_alignment.align(docs.limit(0)).collect() == []


def test_slots_bound_a_common_pair(spark):
    """One word in all documents: its records are dealt to slots, none of which has them all."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the").alias("text")).repartition(16)
    runs = token_alignment.spilled(docs).filter("bucket IS NOT NULL")
    dealt = token_alignment.slotted(runs, 500).groupBy("bucket", "slot").agg(F.sum("records").alias("n")).collect()
    assert sum(r["n"] for r in dealt) == 4000 and max(r["n"] for r in dealt) < 2000 and len(dealt) > 3


# ---- 12

PAGES = [
    (1, "http://a/1?q=%20x", "<p>" + "x" * 1200), (2, "http://a/\r\nX: y", "<p>" + "x" * 1200), (7, None, "<p>" + "x" * 1200),
    (3, "http://b/ü", None), (4, "", ""), (5, "http://c", "small"), (6, "http://c", "small"), (None, "http://d", "<p>" + "x" * 1200),
    (8, "http://e", "é" * 500), (9, "http://e", "é" * 500), (10, "http://f", "y" * 999), (11, "http://f", "y" * 999),
    (12, "http://g", "z" * 3_000_000), (12, "http://g", "z" * 3_000_000), (13, "http://h", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (None, "http://i", "n" * 2000), (None, "http://i", "n" * 2000),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "k", i) for i, p in enumerate(PAGES)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, same string, size int").repartition(3)


@pytest.fixture(scope="module")
def index(spark, pages):
    return warc_bundles.write(pages, warc_bundles.new_folder(spark))


def test_bundles_give_all_pages_back(index):
    got = sorted(
        ((r["page_id"] is None, r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
         for r in warc_bundles.read(index).collect()), key=repr)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
        top = max(same, default=None) if len(data) >= 1000 else None
        again = top is not None and page != top
        want.append((page is None, page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    assert got == sorted(want, key=repr)


def test_payloads_and_urls_come_back(index):
    records = {(r["page_id"], r["record_type"]): r for r in warc_bundles.read(index).collect()}
    assert bytes(records[13, "response"]["payload"]) == PAGES[14][2].encode()
    assert records[2, "revisit"]["payload"] is None and records[2, "revisit"]["url"] == "http://a/%0D%0AX:%20y"
    assert records[1, "revisit"]["url"] == "http://a/1?q=%20x" and records[7, "response"]["url"] is None
    assert records[3, "response"]["url"] == "http://b/%C3%BC" and records[4, "response"]["url"] == ""


def test_a_bundle_is_plain_zstd_and_seekable(index):
    rows = index.collect()
    for bundle in {r["bundle"] for r in rows}:
        files, path = warc_bundles.place_of(bundle)
        with files.open_input_file(path) as source:
            data = source.read()
            table = warc_bundles.seek_table(source)
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert len(whole) == sum(size for _, _, size in table)
        begins = [sum(size for _, _, size in table[:i]) for i in range(len(table))]
        for r in rows:
            if r["bundle"] == bundle:
                at = begins[r["frame"]] + r["offset"]
                record = whole[at : at + r["length"]]
                assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
                assert f"WARC-Record-ID: <{r['record_id']}>".encode() in record


def test_lookup_reads_the_asked_records(spark, index):
    one = index.filter("record_id LIKE 'urn:page:13:%' OR record_id LIKE 'urn:page:2:%'").select("record_id")
    got = {r["page_id"]: r["record_type"] for r in warc_bundles.lookup(index, one.union(one)).collect()}
    assert got == {13: "response", 2: "revisit"}


def test_frames_are_bounded_and_leftovers_are_not_read(spark, index):
    sizes = [r["size"] for r in warc_bundles.frames(index).collect()]
    assert max(sizes) > 3_000_000 and sum(s > warc_bundles.FRAME_BYTES for s in sizes) == 2  # long records alone
    bundle = index.first()["bundle"]
    files, path = warc_bundles.place_of(bundle)
    with files.open_output_stream(f"{os.path.dirname(path)}/lost.warc.zst", compression=None) as lost:
        lost.write(b"half a bundle")
    assert warc_bundles.read(index).count() == len(PAGES)


def test_a_changed_payload_is_noticed():
    data = warc_bundles.encode_record(1, "u", b"abc", hashlib.sha1(b"abd").hexdigest(), 3)
    with pytest.raises(ValueError):
        list(warc_bundles.decode_records(data))


def test_no_pages(spark, pages):
    index = warc_bundles.write(pages.limit(0), warc_bundles.new_folder(spark))
    assert index.count() == 0 and warc_bundles.read(index).count() == 0


# ---- 13


def plain_repair(kinds):
    """Least cost and ASCII-least audit, by keeping the best string of each state after each turn."""
    nxt = {0: 2, 1: 2, 2: 3, 3: 2}
    ways = {0: {(0, "")}}
    for kind in kinds:
        initial, fate = kind[0], int(kind[1])
        new = defaultdict(set)
        for s, held in ways.items():
            for cost, audit in held:
                state = s
                for k in range(4):
                    c, a = cost + 5 * k, audit + "I" * k
                    new[state].add((c + 2, a + "D"))
                    if fate != 2:
                        more = 5 if fate == 1 else 0
                        new[nxt[state]].add((c + 1 + more, a + "R"))
                        if initial == "s" and state == 0:
                            new[1].add((c + more, a + "K"))
                        if initial == ("a" if state == 2 else "u"):
                            new[nxt[state]].add((c + more, a + "K"))
                    state = nxt[state]
        ways = {s: {min(held)} for s, held in new.items()}
    ends = {0: 0, 1: 2, 2: 1, 3: 0}
    return min((c + 5 * ends[s], a + "I" * ends[s]) for s, held in ways.items() for c, a in held)


def exhaustive_repair(kinds):
    """All edit sequences with up to three inserts between turns."""
    found = []

    def go(i, state, cost, audit, run):
        if cost > 2 * len(kinds):
            return  # deleting all is cheaper
        if i == len(kinds) and state in (0, 3):
            found.append((cost, audit))
        if run < 3:
            go(i, {2: 3}.get(state, 2), cost + 5, audit + "I", run + 1)
        if i < len(kinds):
            for letter, more, after in turn_repair._moves(kinds[i][0], int(kinds[i][1]), state):
                go(i + 1, after, cost + more, audit + letter, 0)

    go(0, 0, 0, "", 0)
    return min(found)


def random_kinds(rng, n):
    return [rng.choice("suaua-") + rng.choice("000012") for _ in range(n)]


def test_repair_is_the_cheapest_and_least():
    rng = random.Random(5)
    for case in range(400):
        kinds = random_kinds(rng, rng.randrange(0, 7))
        cost, edits = turn_repair.repaired_audit(kinds)
        assert (cost, "".join(edits)) == exhaustive_repair(kinds) == plain_repair(kinds), kinds
    for case in range(60):
        kinds = random_kinds(rng, rng.randrange(50, 300))
        cost, edits = turn_repair.repaired_audit(kinds)
        assert (cost, "".join(edits)) == plain_repair(kinds), kinds


def test_tables_of_blocks_make_that_of_the_whole():
    rng = random.Random(6)
    for _ in range(50):
        kinds = random_kinds(rng, 60)
        parts = [turn_repair.table_of(turn_repair.Turns(kinds[i : i + 7])) for i in range(0, 60, 7)]
        assert turn_repair.table_of(turn_repair.Tables(parts)) == turn_repair.table_of(turn_repair.Turns(kinds))


def test_blocks_and_levels_change_nothing(spark, rows):
    rng = random.Random(7)
    turns = [
        (c, i if rng.random() > 0.05 else None, rng.choice(["user", "assistant", "system", "tool", "", None]),
         rng.choice([f"text {rng.randrange(40)}.", f"cut {i}", "", "same!", " \t", None]))
        for c, n in ((1, 300), (2, 9), (None, 40), (3, 1)) for i in range(n)
    ]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    whole = rows(turn_repair.summary(df))
    assert rows(turn_repair.summary(df.repartition(7), bits=2)) == whole
    assert len(whole) == 4


def test_repaired_turns_are_right(spark):
    rng = random.Random(8)
    turns = [(c, i, rng.choice(["user", "assistant", "system"]), f"t{rng.randrange(9)}.") for c in range(20) for i in range(15)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    ordered = turn_repair.ordered(df)
    _, edits = turn_repair.solve(turn_repair.faults(ordered), bits=3)
    by_conv = defaultdict(list)
    for r in turn_repair.repaired(ordered, edits, bits=3).orderBy("conv_id", "ord", "step").collect():
        by_conv[r["conv_id"]].append(r["role"][0])
    for initials in by_conv.values():
        said = "".join(initials).removeprefix("s")
        assert said and said == "ua" * (len(said) // 2)


def test_repair_edges(spark, rows):
    schema = "conv_id bigint, turn bigint, role string, text string, ord string, fault int, first string"
    df = spark.createDataFrame([(1, 0, "user", "x.", "o", 1, "f"), (1, 1, None, None, "o", 1, "f"), (2, 5, "user", "cut", "o", 1, "f")], schema)
    ids = spark.createDataFrame([(1,), (9,), (None,), (9,)], "conv_id bigint")
    got = {r["conv_id"]: r for r in turn_repair.summary(df, ids=ids).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert set(got) == {1, 2, 9, None}
    assert (got[1]["blank"], got[1]["cost"], got[1]["audit"]) == (1, 4, "DD")
    assert (got[2]["truncated"], got[2]["cost"], got[2]["audit"], got[2]["repaired_sha256"]) == (1, 2, "D", nothing)
    for absent in (9, None):
        assert tuple(got[absent])[1:] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert rows(turn_repair.summary(df.limit(0))) == []


def test_damaged_rows_and_ties_against_sql(spark, tmp_path):
    from oracle_check import compare, connect

    from cohortmill.llm.oracles import ORACLES

    rng = random.Random(9)
    data = [
        (rng.choice([*range(40), None]), rng.choice([*range(8), None]), rng.choice(["user", "assistant", "system", "", None]),
         rng.choice(["a. b", "a. b.", "", "  ", "c?", "c", "한!\x0b", None]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op13_turn_repair(spark, str(tmp_path))
    assert compare(got, connect(str(tmp_path)), ORACLES["op13_turn_repair"]) == []
