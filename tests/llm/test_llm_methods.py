"""The operators against brute force, exact round trips and held-out rows."""

from __future__ import annotations

import hashlib
import inspect
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
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
from cohortmill.llm.common import split_words, stored
from cohortmill.llm.license_templates import TEMPLATES
from cohortmill.session import scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def test_words_are_those_of_the_pattern():
    odd = ["".join(map(chr, range(300))) + "  a b ", "", " x", "é  b\x1cc\x85d\x0b\x0ce", "\t\n"]
    offsets, words = split_words(pa.array(odd, pa.large_string()))
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(offsets, offsets[1:])] == [WORD.findall(t) for t in odd]


# --- quality rules -----------------------------------------------------------
def test_lines_above_the_limits(spark):
    body = lambda i: " ".join(f"d{i}x{j}" for j in range(60))
    rows = [(i, "a", f"Share  THIS page\n{body(i)}") for i in range(12)]  # in all texts of its host
    rows += [(100 + i, "b", f"share this page\n{body(100 + i)}") for i in range(10)]  # at the limit of texts
    rows += [(200 + i, "c", f"{body(7777)}\n{i}") for i in range(30)]  # depleted: one long line everywhere
    rows += [(300 + i, "d", body(8888)) for i in range(30)]  # copies count as documents
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), "limits")
    got = {r["doc_id"]: r for r in quality_rules.judge(quality_rules.profiles(docs)).collect()}
    assert all(got[i]["removed_words"] == 3 and got[i]["kept"] for i in range(12))
    assert all(got[100 + i]["removed_words"] == 0 and got[100 + i]["kept"] for i in range(10))
    assert not any(got[200 + i]["kept"] or got[200 + i]["base_failed"] for i in range(30))
    assert not any(got[300 + i]["kept"] for i in range(30))
    texts = {r["doc_id"]: r["text"] for r in quality_rules.clean(docs).collect()}
    assert texts[3] == body(3) and texts[103].startswith("share this page\n") and 200 not in texts


# --- line dedup --------------------------------------------------------------
def test_the_ratio_is_relative_to_the_host(spark):
    rows = [(i, "small", f"Cookie  notice\nown {i}") for i in range(5)]
    rows += [(100 + i, "large", f"{'cookie NOTICE' if i < 8 else 'other'} \nown {i}") for i in range(100)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), "sites")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, max_ratio=0.08, min_pages=5).collect()}
    assert got[3] == "own 3"
    assert got[103] == "cookie NOTICE \nown 3"  # 8 of 100 pages are not above the ratio
    assert got[150] == "own 50"


# --- SimHash -----------------------------------------------------------------
def plain_fingerprint(text, size=3):
    words = WORD.findall(lowered(text or ""))
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(max(1, len(words) - size + 1))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    """Smallest number reachable, for a dict of number to fingerprint."""
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(prints)
    for n, i in enumerate(order):
        for j in order[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in prints}


def test_simhash_agrees_with_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    assert {i: r["fp"] % (1 << 64) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(prints)


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_no_pair_within_the_radius_escapes_the_keys(radius):
    rng = random.Random(radius)
    masks = simhash.key_masks(radius)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, radius)):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)
        pair = np.array([a], np.uint64), np.array([b], np.uint64)
        assert len(simhash.within(*pair, radius)) == 1


def test_large_groups_are_dealt_to_tiles_without_losing_a_link(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 400:  # a dense group, its parts several steps apart
        start = rng.choice(sorted(prints)) if rng.random() < 0.5 else centre
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            start ^= 1 << bit
        prints.add(start)
    numbered = dict(enumerate(sorted(prints)))
    want = plain_components(numbered)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in numbered.items()]
    marked = stored(spark.createDataFrame(rows, "doc_id bigint, fp bigint"), "dense")
    got = simhash.resolve(marked, 3, tile_rows=20)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}


# --- secrets -----------------------------------------------------------------
def test_places_of_secrets(spark):
    texts = [
        "é token = 'abcdef' password:x secret=\"0123456789abcdef01234567\"",
        "AKIA" + "A" * 16 + "AKIAABC api-key=zzzzzzzz API_KEY=zzzzzz apikey : zzzzzzz",
        "token=token:abcdefgh token==token=abcdef",
        "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["path"]: r["spans"] for r in secret_ledger.scan(docs, scratch(spark, "places")).collect()}
    rules = [r for rules in secret_ledger.RULE_SETS for r in rules.rules]
    for i, text in enumerate(texts):
        want = sorted(
            (m.start(), order, rule.kind, m.end())
            for order, rule in enumerate(rules)
            for m in re.finditer(rule.pattern, text, re.ASCII)
            if len(m[rule.group]) >= rule.least
        )
        assert [tuple(s) for s in got[i]] == want, text


def test_only_unseen_pairs_are_scanned(spark):
    ledger = scratch(spark, "incremental")
    one = (secret_ledger.BASE,)
    history = spark.createDataFrame([("a", "token=abcdef"), ("b", "plain"), ("c", "token=abcdef")], "path string, content string")
    scan = lambda h, sets: secret_ledger.scan(h, ledger, "path", "content", sets)
    rows = lambda: secret_ledger.read_ledger(spark, ledger).count()
    first = {r["path"]: len(r["spans"]) for r in scan(history, one).collect()}
    assert first == {"a": 1, "b": 0, "c": 1} and rows() == 2  # one row for each blob
    more = history.union(spark.createDataFrame([("a", "AKIA" + "B" * 16)], history.schema))
    assert sorted(len(r["spans"]) for r in scan(more, one).collect()) == [0, 1, 1, 1] and rows() == 3
    scan(more, one).collect()
    assert rows() == 3  # nothing new
    scan(more, secret_ledger.RULE_SETS).collect()
    assert rows() == 6  # another rule set, over all blobs
    # What the ledger says is believed: a blob known as clean isn't read again.
    changed = secret_ledger.RuleSet("base", 2, (secret_ledger.Rule("word", "plain"),))
    assert {r["path"]: len(r["spans"]) for r in scan(history, (changed,)).collect()} == {"a": 0, "b": 1, "c": 0}


# --- toxicity ----------------------------------------------------------------
def test_string_kernel():
    s = toxicity.strings(["stupid", "stuXpid", "xqzwvk"])
    k = toxicity.kernel(s, s)
    assert np.allclose(k, k.T)
    assert k[0, 0] > k[0, 1] > 0.3 * k[0, 0] and abs(k[0, 2]) < 1e-9

    def plain(a, b):
        def parts(n):
            letters = s.letters[s.begin[n] : s.begin[n] + s.size[n]].tolist()
            out = Counter()
            for x in range(len(letters)):
                for y in range(x + 1, len(letters)):
                    for z in range(y + 1, len(letters)):
                        if z - x <= 4:
                            out[letters[x], letters[y], letters[z]] += toxicity.DECAY ** (z - x + 1)
            return out

        p, q = parts(a), parts(b)
        return sum(p[u] * q[u] for u in p) * np.prod(toxicity.scale(s.size[[a, b]]))

    assert np.isclose(k[0, 1], plain(0, 1)) and np.isclose(k[0, 0], plain(0, 0))


def test_letters():
    word = lambda t: toxicity.strings([t])
    for text in ("s t u p i d", "s.t.u.p.i.d", "STU-PID", "$tup1d"):
        assert word(text).letters.tolist() == word("stupid").letters.tolist(), text
    long = toxicity.strings(["a" * 100, "", "b"])
    assert set(long.owner.tolist()) == {0, 2} and long.size.max() <= toxicity.WINDOW


def plain_words(text):
    """Words of a text, each step by itself: letters, joined single ones, marks, windows."""
    code = lambda c: toxicity.codes_of(c)[0] if len(toxicity.codes_of(c)) else 0
    words, run = [], []
    for part in re.split(r"\s+", text.lower()):
        letters = [int(code(c)) for c in part if code(c) != 0]
        if not letters:
            continue
        if len(letters) == 1 and run:
            run.append(letters[0])
            continue
        if run:
            words.append(run)
            run = []
        if len(letters) == 1:
            run = letters
        else:
            words.append(letters)
    words += [run] if run else []
    out = []
    for word in words:
        word = [toxicity.FIRST, *word, toxicity.LAST]
        starts = range(0, max(1, len(word) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        out += [word[i : i + toxicity.WINDOW] for i in starts]
    return out


def plain_features(word):
    """Weights of all three-letter subsequences that span at most five letters, over the word's length."""
    out, norm = Counter(), 0.0
    for x in range(len(word)):
        for y in range(x + 1, len(word)):
            for z in range(y + 1, min(len(word), x + 5)):
                weight = toxicity.DECAY ** (z - x + 1)
                out[word[x], word[y], word[z]] += weight
                norm += weight**2
    scale = 1 / np.sqrt(max(norm, toxicity.DECAY**6))
    return {k: v * scale for k, v in out.items()}


def test_toxicity_agrees_with_brute_force():
    rng = random.Random(3)
    syllables = ["ba", "mo", "ti", "re", "su", "lo", "ka", "ne"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(2, 4)))
    insults = ["grotz", "blixen", "vrumpf"]

    def text(toxic):
        said = [" ".join(word() for _ in range(12)) for _ in range(4)]
        if toxic:
            said[rng.randrange(4)] += " " + rng.choice(insults)
        return ". ".join(said) + "."

    sample = [(text(i % 3 == 0), int(i % 3 == 0)) for i in range(150)]
    model = toxicity.train(sample)
    # Whole texts: the best word's sum of weights, and its probability.
    odd = ["", "g r o t z", "gr0tz", "grXotz you", "a" * 60, "x", "  \n", "GROTZ! ba-mo", "b l i x e n and more"]
    for t in odd + [text(True), text(False)]:
        sums = [sum(v * model.table[(x * 64 + y) * 64 + z] for (x, y, z), v in plain_features(w).items()) for w in plain_words(t)]
        margin = max([model.bias, *(s + model.bias for s in sums)])
        assert abs(model.margins([t])[0] - margin) < 1e-9, t
        want = 1 / (1 + np.exp(-(model.slope * margin + model.offset)))
        assert abs(model.scores([t])[0] - want) < 1e-9
    assert min(model.scores([f"{i} you" for i in insults])) > 0.5 > max(model.scores(["bamo tire", "", "sulo"]))
    # The table is the expansion over landmarks: k(x) K^(-1/2) w by kernels of pairs.
    own = toxicity.strings([" ".join({word() for _ in range(30)})])
    marks = toxicity.chosen(own, toxicity.unlike(own, np.arange(len(own.begin)), 8))
    plain = [[plain_features(s.letters[a : a + n].tolist()) for a, n in zip(s.begin, s.size)] for s in (own, marks)]
    dot = lambda p, q: sum(p[u] * q.get(u, 0.0) for u in p)
    k, among = ([[dot(p, q) for q in plain[1]] for p in side] for side in plain)
    assert np.allclose(toxicity.kernel(own, marks), k) and np.allclose(toxicity.kernel(marks, marks), among)
    alike = np.array(among) / np.sqrt(np.outer(np.diag(among), np.diag(among)))
    assert (alike - np.eye(len(alike))).max() <= toxicity.ALIKE
    values, vectors = np.linalg.eigh(np.array(among))
    w = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T @ np.linspace(-1, 1, len(among))
    at, keys, weights = toxicity.features(marks)
    table = np.zeros(toxicity.LETTERS**3)
    np.add.at(table, keys, weights * w[at])
    assert np.allclose(toxicity.expand(own, table), np.array(k) @ w)


def test_toxicity_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").join(labels.select("doc_id"), "doc_id")
    got = toxicity.score(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = np.mean([r["predicted"] == r["toxic"] for r in got])
    found = np.mean([r["predicted"] for r in got if r["toxic"]])
    # Some insults of this table differ from ordinary words by an ending only.
    assert len(got) > 500 and right >= 0.95 and found >= 0.75
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_toxicity_trains_on_the_whole_sample():
    assert inspect.signature(toxicity.score).parameters["sample"].default >= 1200


# --- quality classifier ------------------------------------------------------
def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").join(labels.select("doc_id"), "doc_id")
    got = quality_classifier.score(docs, labels).join(labels, "doc_id")
    got = [r for r in got.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(got) > 500
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in got]) >= 0.97
    assert np.mean([r["kept"] for r in got if r["quality"] == 1]) >= 0.98


def test_views_teach_each_other():
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 2, 3000)
    views = [truth[:, None] * 2.0 + rng.normal(0, 0.7, (3000, 1)), truth[:, None] * 2.0 + rng.normal(0, 0.7, (3000, 1))]
    known = np.arange(60)
    calibrates = known % 2 == 0
    part = [v[known] for v in views]
    pool = [v[60:2000] for v in views]
    models = quality_classifier.co_train(part, truth[known].astype(float), calibrates, pool, per_round=200)
    total = sum(m.logit(v[2000:]) for m, v in zip(models, views))
    # One view alone tells 92 % at best.
    assert np.mean((total > 0) == truth[2000:]) > 0.935
    # A view of noise is never sure, so it hands nothing on.
    noise = rng.normal(0, 1, (3000, 1))
    models = quality_classifier.co_train([views[0][known], noise[known]], truth[known].astype(float), calibrates, [views[0][60:2000], noise[60:2000]])
    assert np.mean((models[0].logit(views[0][2000:]) > 0) == truth[2000:]) > 0.85


def test_all_unlabelled_documents_are_the_pool(spark):
    def text(i, good):
        return " ".join(f"word{i * j % 91}" for j in range(80)) if good else "BUY!!! $$$ | " * 30

    # 300 labelled rows of two sources that tell a little; the others are unlabelled, 2 each of two rare sources.
    rows = [(i, text(i, i % 2), f"common {i % 2 if i % 5 else 1 - i % 2}") for i in range(3000)]
    rows += [(3000 + i, text(i, i % 2), "good" if i % 2 else "bad") for i in range(4)]
    docs = spark.createDataFrame([(*r, "en", 500) for r in rows], "doc_id bigint, text string, source string, lang string, n_chars bigint")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, quality int")
    table = quality_classifier.features(docs, "doc_id", "text", "source", "lang", "n_chars")
    assert quality_classifier.unlabelled(table, labels).rows == 2704
    scores = quality_classifier.score(docs, labels, sample=240).filter("doc_id >= 3000").collect()
    good, bad = ({r["meta_score"] for r in scores if r["doc_id"] % 2 == k} for k in (1, 0))
    # Only the text view could tell the metadata view about them.
    assert min(good) > 0.7 and max(bad) < 0.3, (good, bad)


def test_a_pool_in_tasks_trains_as_one_in_memory(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels").select("doc_id", "quality")
    kept = quality_classifier.features(docs, "doc_id", "text", "source", "lang", "n_chars")
    pool = quality_classifier.unlabelled(kept, labels)
    rows = kept.join(labels, "doc_id").filter("quality is not null").orderBy("doc_id").collect()
    y = np.array([r["quality"] for r in rows], dtype=float)
    calibrates = np.arange(len(y)) % 4 == 0
    views = quality_classifier._views(rows)
    models = quality_classifier.co_train(views, y, calibrates, pool)
    batch = pa.Table.from_batches(pool.table.toArrow().to_batches()).combine_chunks().to_batches()[0]
    here = quality_classifier.ArrayPool(quality_classifier._pool_views(batch), batch["luck"].to_numpy())
    same = quality_classifier.co_train(views, y, calibrates, here)
    assert pool.rows == here.rows and all(np.allclose(a.logit(x), b.logit(x), atol=1e-3) for a, b, x in zip(models, same, views))


def plain_co_training(views, y, calibrates, pool, rounds=4, sure=0.95):
    """Co-training with all sure rows handed on, each step written out; calibrated logits of `pool`'s rows."""

    def newton(x, y, ridge=1.0):
        mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
        penalty, w = np.append(np.full(x.shape[1], ridge), 1e-6), np.zeros(x.shape[1] + 1)
        for _ in range(200):
            p = 1 / (1 + np.exp(-z @ w))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
            w = w + step / max(1.0, np.abs(step).max())
        return lambda x: np.column_stack([(x - mean) / spread, np.ones(len(x))]) @ w

    labels = [dict(), dict()]
    for turn in range(rounds + 1):
        logits = []
        for view, x in enumerate(views):
            rows = sorted(labels[view])
            fit = newton(np.vstack([x[~calibrates], pool[view][rows]]), np.append(y[~calibrates], [labels[view][r] for r in rows]))
            own, t = fit(x[calibrates]), y[calibrates]
            platt = newton(own[:, None], (t * len(t) + 1) / (len(t) + 2), 1e-3)
            logits.append(platt(fit(pool[view])[:, None]))
        if turn == rounds:
            return logits
        least = np.log(sure / (1 - sure))
        for view in (0, 1):
            for row, value in enumerate(logits[view].tolist()):
                if abs(value) >= least:
                    labels[1 - view].setdefault(row, int(value > 0))


def test_co_training_agrees_with_brute_force():
    rng = np.random.default_rng(4)
    truth = rng.integers(0, 2, 260)
    views = [truth[:, None] * s + rng.normal(0, 0.8, (260, 2)) for s in (2.0, 1.6)]
    known, calibrates = np.arange(60), np.arange(60) % 3 == 0
    part, pool = [v[known] for v in views], [v[60:] for v in views]
    models = quality_classifier.co_train(part, truth[known].astype(float), calibrates, pool, per_round=10_000)
    want = plain_co_training(part, truth[known].astype(float), calibrates, pool)
    for model, x, logits in zip(models, pool, want):
        assert np.allclose(model.logit(x), logits, atol=2e-2)
        assert np.abs(logits).max() > 2


def test_what_reaches_the_driver_does_not_grow_with_tasks(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels").select("doc_id").limit(50)
    kept = quality_classifier.features(docs, "doc_id", "text", "source", "lang", "n_chars")
    rows = quality_classifier.unlabelled(kept, labels).table.drop(*quality_classifier.HANDED)
    count = lambda views, labels: np.array([float(len(labels[0])), views[0].sum()])
    found = {}
    for tasks in (4, 400):
        spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # each file is a task
        pool = quality_classifier.TablePool(rows.repartition(tasks))
        assert pool.table.rdd.getNumPartitions() == tasks
        assert pool.parts(count).count() <= quality_classifier.SUMS
        found[tasks] = pool.total(count)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert np.allclose(found[4], found[400])


def test_an_index_is_built_once_for_a_worker(monkeypatch):
    from types import SimpleNamespace

    built = []
    monkeypatch.setattr(decontaminate, "Benchmark", lambda block: built.append(block) or len(built))
    monkeypatch.setattr(decontaminate, "_LOADED", {})
    one, two = [(1, "a b c d e")], [(2, "f g h i j")]
    for block in (one, one, two, two, one):
        decontaminate.loaded(decontaminate._key(block), SimpleNamespace(value=block))
    assert built == [one, two, one] and len(decontaminate._LOADED) == 1


# --- chat --------------------------------------------------------------------
def test_chat_round_trip():
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|x<\\\\|", "", "日本 é\U0001f600\n", "<|endoftext|>", "<|im_sep|>\\"]
    assert all(chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t) for t in texts)
    tokenizer = chat._tokenizer(chat.default_tokenizer())
    roles = ["user", "assistant", "assistant", "odd\nrole", "", "assistant"]
    ids, loss = chat.assemble(roles, texts, tokenizer)
    reader = chat._Reader(1, chat.id_bytes(tokenizer))
    for a, b in zip(ids, loss):
        assert a.tolist().count(chat.END) == 1 and len(a) == len(b)
        reader.add(a, b)
    whole = "".join(f"{r}\n{t}\n" for r, t in zip(roles, texts))
    spoken = "".join(t for r, t in zip(roles, texts) if r == "assistant")
    assert reader.row()[1:5] == (
        6, hashlib.sha256(whole.encode()).hexdigest(), len(spoken), hashlib.sha256(spoken.encode()).hexdigest(),
    )


# --- packing -----------------------------------------------------------------
ODD = [
    "", " ", "<|endoftext|> hi", "<|ENDOFTEXT|> Hi", "It's a'S. x.' don't!!! ABC..,? 'll.", "H̱. é, Straße",
    "a\x01b \x01 c", " x y.", "日本語。テスト, 12.5% ①.", "İI. ΑΣ. Σ", "...", "x" * 5000, "\x1c\x1d a\x85b", "ñ, ñ. ñ'", " a, ",
]


def test_ids_are_the_tokenizers(spark, sf_dir, monkeypatch):
    texts = ODD + [r["text"] for r in table(spark, sf_dir, "documents").limit(50).collect()]
    tokens = packing.WordTokens(packing.default_tokenizer())
    want = [e.ids for e in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in tokens.encode(pa.array(texts, pa.large_string()))] == want
    monkeypatch.setattr(packing, "CACHE_WORDS", 500)  # the cache forgets in between
    for _ in range(2):
        assert [x.tolist() for x in tokens.encode(pa.array(texts, pa.large_string()))] == want


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 500, 1024, 1025, 2000, 2047, 2048, 2049, 10_000])
def test_cut(n):
    lengths = packing.cut(n)
    assert sum(lengths) == n and all(0 < x <= packing.CAPACITY for x in lengths)
    for x in lengths:
        assert x <= packing.WHOLE or x * (packing.CAPACITY // x) >= packing.LEAST_FILL * packing.CAPACITY


def test_sequences(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = packing.pack(docs).toPandas()
    tokens = packing.WordTokens(packing.default_tokenizer())
    for r in docs.limit(20).collect():
        own = got[got["doc_id"] == r["doc_id"]].sort_values("start")
        ids = np.concatenate([np.frombuffer(b, "<u4") for b in own["ids"]]).tolist()
        want = tokens.tokenizer.encode(r["text"], add_special_tokens=False).ids + [packing.END_ID]
        assert ids == want and set(own["doc_tokens"]) == {len(want)}
        assert own["start"].tolist() == (own["length"].cumsum() - own["length"]).tolist()
    ordered = got.sort_values(["sequence_id", "offset"])
    groups = ordered.groupby("sequence_id")["length"]
    assert (groups.cumsum() - ordered["length"] == ordered["offset"]).all()
    sizes = groups.sum()
    assert sizes.max() <= packing.CAPACITY
    assert (packing.CAPACITY - sizes).sum() < 0.01 * sizes.sum()
    # Whole sequences of a class hold its number of pieces.
    kinds = ordered[ordered["sequence_id"] % (packing.CAPACITY + 1) > 0].groupby("sequence_id").size()
    assert (kinds == kinds.index % (packing.CAPACITY + 1)).all()


# --- decontamination ---------------------------------------------------------
def plain_matches(docs, items):
    """Pairs of which some window of the item's size has a weighted similarity of at least 0.8."""
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", lowered(t or ""))
    shingles = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    out = set()
    for item, text in items:
        want = words(text)
        own = shingles(want)
        for doc, body in docs:
            have = words(body)
            for s in range(max(1, len(have) - len(want) + 1)):
                window = shingles(have[s : s + len(want)])
                both = sum((window & own).values())
                if both and both >= 0.8 * (sum(window.values()) + sum(own.values()) - both):
                    out.add((doc, item))
                    break
    return out


def test_short_items_are_found_inside_longer_texts(spark):
    docs = [(1, "so we say Answer: forty two, answer forty two again"), (2, "answer forty"), (3, "two answer"), (4, "Forty-two")]
    items = [(1, "answer forty two"), (2, "forty two"), (3, "two"), (4, "a longer item that no document here holds at all")]
    got = decontaminate.matches(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    found = sorted((r["doc_id"], r["item_id"], r["start"], r["length"]) for r in got.collect())
    assert found == [(1, 1, 3, 3), (1, 2, 4, 2), (1, 3, 5, 1), (3, 3, 0, 1), (4, 2, 0, 2), (4, 3, 1, 1)]


def test_decontamination_agrees_with_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(8, 60)))) for i in range(30)]
    docs = []
    for d in range(150):
        body = rng.choices(vocabulary, k=rng.randint(0, 120))
        if d % 2:
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):  # edited, cut at an end
                passage[rng.randrange(len(passage))] = "edited"
            passage = passage[rng.randint(0, 4) :]
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() + "," for w in passage]
        docs.append((d, " ".join(body)))
    want = plain_matches(docs, items)
    assert len(want) > 20
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (decontaminate.BLOCK_BYTES, 1000):  # in one block of items and in several
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.matches(d, i).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
        assert sorted(r["doc_id"] for r in decontaminate.clean(d, i).collect()) == sorted(
            {n for n, _ in docs} - {n for n, _ in want}
        )


def test_block_index_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 30), False)) for _ in prints], np.uint64)
    queries = prints ^ flips
    query, item, distance = decontaminate.BlockIndex(prints).search(queries)
    want = np.bitwise_count(queries[:, None] ^ prints[None, :])
    assert {*zip(query.tolist(), item.tolist())} == {*zip(*(x.tolist() for x in np.nonzero(want <= decontaminate.RADIUS)))}
    assert (want[query, item] == distance).all()


# --- licenses ----------------------------------------------------------------
def _text(markup, whole):
    """The template's wording with or without its optional regions."""
    if not whole:
        while "<<begin>>" in markup:
            markup = re.sub(r"<<begin>>((?!<<begin>>).)*?<<end>>", "", markup, flags=re.S)
    markup = re.sub(r"<<(begin|end|unless [^>]*)>>", "", markup)
    return re.sub(r"<<var (\d+)-(\d+)>>", lambda m: " ".join(["acme"] * int(m[1 if whole else 2])), markup)


@pytest.mark.parametrize("label,name,markup", TEMPLATES)
@pytest.mark.parametrize("whole", [True, False])
def test_templates(label, name, markup, whole):
    automata = licenses.compiled()
    text = _text(markup, whole)
    found = licenses.find(f"Some words, {text} and more".encode(), automata)[2]
    assert {"label": label, "name": name, "start": 2} in [{k: v for k, v in f.items() if k != "end"} for f in found]
    words = text.split()
    for i in range(0, len(words), 7):  # a mandatory word more
        changed = " ".join([*words[: i + 1], "oops", "oops", *["oops"] * 12, *words[i + 1 :]])
        mandatory = not any(k in " ".join(words[max(0, i - 13) : i + 13]) for k in ("acme",))
        if mandatory and i + 1 < len(words) and whole is False:
            assert name not in [f["name"] for f in licenses.find(changed.encode(), automata)[2]], (i, changed)


def test_another_licenses_suffix_is_refused(spark, tmp_path):
    from oracle_check import compare, connect

    from cohortmill.llm import queries
    from cohortmill.llm.oracles import ORACLES

    cases = {
        "Licensed under CC BY-NC 4.0": "cc-by-nc", "Licensed under the CC BY-NC": "cc-by-nc", "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa",
        "Licensed under the CC BY-NC-ND 4.0 and more": "cc-by-nc-nd", "Licensed under CC BY-NC san": "cc-by-nc", "Licensed under CC BY-NC s": "cc-by-nc",
        "GNU General Public License v3.0 or later": "gpl-3", "Licensed under CC BY-NC SA": "cc-by-nc-sa",
    }
    for text, label in cases.items():
        assert {f["label"] for f in licenses.find(text.encode(), licenses.compiled())[2]} == {label}, text
    texts = [*cases, "nothing", None, *(_text(markup, True) for _, _, markup in TEMPLATES)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    assert compare(queries.op10_license_scan(spark, str(tmp_path)), connect(str(tmp_path)), ORACLES["op10_license_scan"]) == []


def test_each_mandatory_word_counts():
    """With any one mandatory word of a full text changed, its template is refused."""
    for label, name, markup in TEMPLATES:
        text = _text(markup, False)
        if len(text.split()) < 20:
            continue
        words = text.split()
        for i in range(1, len(words), 11):
            if words[i] != "acme" and licenses.words_of(words[i].encode()):
                changed = " ".join([*words[:i], "changed", *words[i + 1 :]])
                assert name not in [f["name"] for f in licenses.find(changed.encode(), licenses.compiled())[2]], (name, words[i])


def test_bsd_needs_its_last_sentence():
    text = _text(next(markup for _, name, markup in TEMPLATES if name == "bsd-text"), True)
    names = lambda t: [f["name"] for f in licenses.find(t.encode(), licenses.compiled())[2]]
    end = "POSSIBILITY OF SUCH DAMAGE."
    assert text.endswith(end) and "bsd-text" in names(text)
    assert "bsd-text" not in names(text.replace(end, "POSSIBILITY OF ANY DAMAGE."))
    assert "bsd-text" not in names(text[: text.index("DISCLAIMED.") + len("DISCLAIMED.")])


def test_phrases(spark):
    text = "Under the MIT license; under the mit License! Apache License, Version 2.0 CC-BY NC under the mit licenses"
    row = licenses.labelled(licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))).first()
    assert sorted((p["label"], p["start"]) for p in row["phrases"]) == [
        ("apache-2", 8), ("cc-by-nc", 13), ("mit", 0), ("mit", 4),
    ]
    assert row["base_labels"] == "apache-2,cc-by-nc,mit" and row["score"] == licenses.PHRASE_SCORE


# --- pipeline ----------------------------------------------------------------
def test_pipeline_agrees_with_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["source"] or "", r["text"] or "") for r in table(spark, sf_dir, "documents").collect()]
    norm = lambda line: " ".join(WORD.findall(lowered(line)))
    has_word = lambda line: bool(WORD.search(line))

    def without(text, gone):
        return "\n".join(x for x in text.split("\n") if not has_word(x) or norm(x) not in gone)

    # Quality rules.
    texts, hosts = {}, {}
    for _, host, text in docs:
        hosts.setdefault(host, []).append(text)
        for line in {norm(x) for x in text.split("\n") if has_word(x)}:
            texts.setdefault((host, line), []).append(text)
    often = {
        key for key, own in texts.items()
        if len(own) > quality_rules.MIN_DOCS and len(own) > quality_rules.MAX_SHARE * len(hosts[key[0]])
    }
    kept = []
    for i, host, text in docs:
        words = WORD.findall(text)
        grams = Counter(zip(words, words[1:], words[2:]))
        repeated = {k + s for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for s in range(3)}
        gone = {line for h, line in often if h == host}
        lost = sum(len(WORD.findall(x)) for x in text.split("\n") if has_word(x) and norm(x) in gone)
        fails = len(words) < quality_rules.MIN_WORDS or 100 * len(repeated) > 50 * len(words)
        if not fails and len(words) - lost >= quality_rules.MIN_LEFT * len(words):
            kept.append((i, host, without(text, gone)))
    # Line dedup.
    pages, lines = Counter(h for _, h, _ in kept), Counter()
    for _, host, text in kept:
        lines.update({(host, norm(x)) for x in text.split("\n") if has_word(x)})
    gone = {
        key for key, n in lines.items()
        if n >= line_dedup.MIN_PAGES and n > line_dedup.MAX_RATIO * pages[key[0]]
    }
    kept = [(i, without(text, {line for h, line in gone if h == host})) for i, host, text in kept]
    # Near duplicates, then the benchmark.
    parts = plain_components({i: plain_fingerprint(t) for i, t in kept})
    kept = [(i, t) for i, t in kept if parts[i] == i]
    leaks = plain_matches(kept, [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()])
    kept = [(i, t) for i, t in kept if i not in {d for d, _ in leaks}]
    # Packing.
    tokenizer = packing.WordTokens(packing.default_tokenizer()).tokenizer
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [packing.END_ID] for i, t in kept}
    got = corpus_pipeline.run(spark, sf_dir).orderBy("doc_id", "start").collect()
    have = {}
    for r in got:
        have.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert have == want
    assert len(want) < len(docs)


def test_the_rest_imports_nothing_of_llm():
    import pathlib

    import cohortmill

    for path in pathlib.Path(cohortmill.__file__).parent.rglob("*.py"):
        if path.parent.name != "llm":
            assert not re.search(r"\bllm\b", path.read_text()), path


@pytest.mark.parametrize("column", ["text"])
def test_long_text_is_whole(spark, column):
    """What stands at the end of a text of a million words is found."""
    tail = "Released under the MIT License token=abcdefgh you idiot"
    docs = stored(spark.createDataFrame([(1, "w " * 1_000_000 + tail)], f"doc_id bigint, {column} string"), "long")
    assert licenses.scan(docs).first()["phrases"][0]["start"] == 1_000_001
    assert secret_ledger.scan(docs, scratch(spark, "long")).select(F.size("spans")).first()[0] == 1
