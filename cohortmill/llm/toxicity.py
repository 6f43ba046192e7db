"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

Kernel. A string's features are its subsequences of three letters that span at most five,
each occurrence weighing DECAY ** span; so a letter put in between, or one left out, still
leaves most features. Strings are the words of a text in lower case, digits and signs that
stand for letters read as these, other signs inside a word dropped, single letters in a row
joined (s t u p i d), with a mark before and after. Beyond 16 letters a word counts as windows of 16. Features
are scaled by the word's length, which keeps the kernel a kernel.

Model. Landmarks are words of the sample; the Nyström map of a word x is K^(-1/2) k(x) with the
kernel among landmarks K and with them k(x). A linear SVM (squared hinge) is trained on
words of labelled sentences: labels are those of documents, so a toxic document's sentences only
hold an insult somewhere. Those count whose best word, by how much more often toxic documents
have it, tells about as much as the document's best. Each round takes as witnesses the best
words of these sentences by the last round's model, also with a letter put in, and as counter-examples the words
of clean documents, the worst first. A text scores as its best word; Platt scaling
on sampled documents makes that a probability.

As the features are finite, the trained expansion over the landmarks is one table of weights
by three letters. Scoring looks letters up in it, over whole texts and without a shuffle.

Training takes a bounded sample: about `SAMPLE` toxic documents and twice as
many others, of at most `SAMPLE_CHARS` characters, chosen by a hash of the id. Everything else covers all rows.

Defined cases: null and empty texts have no word and get the model's score for none, below
0.5. Null ids and labels don't train; of repeated labels the toxic one counts. With labels of
one kind or none every score is 0. Repeated rows each get their score. Columns that the
operator doesn't name are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import mapped, sampled, texts

DECAY = 0.75
# First and second step of each subsequence that spans at most five letters.
STEPS = [(1, 1), (1, 2), (2, 1), (1, 3), (2, 2), (3, 1)]
LETTERS = 64
FIRST, LAST = 62, 63
WINDOW, STRIDE = 16, 8
SAMPLE = 1200
SAMPLE_CHARS = 20_000
LANDMARKS = 160
ALIKE = 0.6
PURE = 1.5
RUNS, RUN_PURE = (5, 7, 9), 4.0
SIGNIFICANT = 4.0
ROUNDS = 4
FOLDS = 5
CHUNK = 1 << 20

# Signs that stand for letters.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _letter_codes() -> np.ndarray:
    """Code of each character below 0x250: 0 for signs, -1 for white space, letters from 1."""
    codes = np.zeros(0x250, dtype=np.int8)
    for c in range(0x250):
        char = SIGNS.get(chr(c), chr(c))
        if "a" <= char <= "z":
            codes[c] = ord(char) - 96
        elif char.isalpha():
            codes[c] = 27 + c % 35
        elif char.isspace():
            codes[c] = -1
    return codes


_CODES = _letter_codes()


def codes_of(text: str) -> np.ndarray:
    """The text's letters as codes, words parted by -1."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(points < len(_CODES), _CODES[np.minimum(points, len(_CODES) - 1)], 27 + (points % 35).astype(np.int8))
    return codes[codes != 0]


@dataclass
class Strings:
    """Letters of many words in a row and where each word begins; `owner` is the text of each word."""

    letters: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    owner: np.ndarray


def strings(column: list[str]) -> Strings:
    """The words of all texts: single letters joined, long words as windows."""
    parts = [codes_of(t) for t in column]
    lengths = [len(p) + 1 for p in parts]
    flat = np.full(sum(lengths), -1, dtype=np.int8)
    ends = np.cumsum(lengths)
    for p, end in zip(parts, ends.tolist()):
        flat[end - len(p) - 1 : end - 1] = p
    row = np.repeat(np.arange(len(parts)), lengths)
    letter = flat >= 0
    first = letter & np.concatenate([[True], ~letter[:-1]])
    letters, row, first = flat[letter], row[letter], first[letter]
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(letters)))
    owner = row[begin]
    # Single letters in a row are one word.
    same = np.concatenate([[False], (size[1:] == 1) & (size[:-1] == 1) & (owner[1:] == owner[:-1])]) if len(begin) else np.zeros(0, bool)
    begin, owner = begin[~same], owner[~same]
    size = np.diff(np.append(begin, len(letters)))
    # A mark before and after each word.
    word = np.repeat(np.arange(len(begin)), size)
    marked = np.empty(len(letters) + 2 * len(begin), dtype=np.int8)
    marked[np.arange(len(letters)) + 2 * word + 1] = letters
    begin = begin + 2 * np.arange(len(begin))
    size = size + 2
    marked[begin], marked[begin + size - 1], letters = FIRST, LAST, marked
    # Windows of long words.
    extra = np.maximum(0, -(-(size - WINDOW) // STRIDE))
    number = np.repeat(np.arange(len(begin)), extra + 1)
    step = np.arange(len(number)) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
    start = begin[number] + step * STRIDE
    return Strings(letters, start, np.minimum(WINDOW, begin[number] + size[number] - start), owner[number])


def chosen(s: Strings, numbers: np.ndarray) -> Strings:
    """Some of the words, with their letters alone."""
    size = s.size[numbers]
    begin = np.cumsum(size) - size
    place = np.arange(size.sum()) + np.repeat(s.begin[numbers] - begin, size)
    return Strings(s.letters[place], begin, size, np.arange(len(numbers)))


def scale(size: np.ndarray) -> np.ndarray:
    """Length of the feature vector of a word of so many letters, no three of them alike."""
    total = np.zeros(len(size))
    for a, b in STEPS:
        total += np.maximum(0, size - a - b) * DECAY ** (2 * (a + b + 1))
    return 1 / np.sqrt(np.maximum(total, DECAY**6))


def features(s: Strings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, three letters, weight) of each subsequence."""
    words, keys, weights = [], [], []
    for a, b in STEPS:
        n = np.maximum(0, s.size - a - b)
        word = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + s.begin[word]
        x = s.letters.astype(np.int32)
        keys.append((x[place] * LETTERS + x[place + a]) * LETTERS + x[place + a + b])
        words.append(word)
        weights.append(np.full(len(word), DECAY ** (a + b + 1)))
    word = np.concatenate(words)
    return word, np.concatenate(keys), np.concatenate(weights) * scale(s.size)[word]


def expand(s: Strings, table: np.ndarray) -> np.ndarray:
    """Sum of each word's features times the table's weights."""
    total = np.zeros(len(s.begin))
    x = s.letters.astype(np.int32)
    for a, b in STEPS:
        if len(x) <= a + b:
            continue
        key = (x[: -a - b] * LETTERS + x[a : len(x) - b]) * LETTERS + x[a + b :]
        sums = np.concatenate([[0.0], np.cumsum(table[key] * DECAY ** (a + b + 1))])
        n = np.maximum(0, s.size - a - b)
        low = np.minimum(s.begin, len(sums) - 1)
        total += sums[np.minimum(low + n, len(sums) - 1)] - sums[low]
    return total * scale(s.size)


def kernel(s: Strings, landmarks: Strings) -> np.ndarray:
    """Kernel values of words and landmarks."""
    word, key, weight = features(landmarks)
    out = np.empty((len(s.begin), len(landmarks.begin)))
    for j in range(out.shape[1]):
        table = np.zeros(LETTERS**3)
        np.add.at(table, key[word == j], weight[word == j])
        out[:, j] = expand(s, table)
    return out


def with_insertions(s: Strings) -> Strings:
    """Each word twice, with a letter put in at different places."""
    parts = []
    for i, (a, n) in enumerate(zip(s.begin.tolist(), s.size.tolist())):
        word = s.letters[a : a + n]
        for turn, at in enumerate((n // 2, 2 + n // 3)):
            parts.append(np.insert(word, min(at, n - 1), 1 + (7 * i + 11 * turn + n) % 26))
    size = np.array([len(p) for p in parts], dtype=np.int64)
    return Strings(np.concatenate(parts), np.cumsum(size) - size, size, np.arange(len(parts)))


def unlike(s: Strings, ordered: np.ndarray, n: int) -> np.ndarray:
    """The first `n` of the words given in order that have no much alike word before them."""
    ordered = ordered[: 4 * n]
    alike = kernel(chosen(s, ordered), chosen(s, ordered))
    own = np.sqrt(np.maximum(np.diag(alike), 1e-12))
    alike = alike / own[:, None] / own
    kept: list[int] = []
    for i in range(len(ordered)):
        if len(kept) < n and not (alike[i, kept] > ALIKE).any():
            kept.append(i)
    return ordered[kept]


def linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.03) -> tuple[np.ndarray, float]:
    """Squared-hinge SVM by Newton steps on its support; y is -1 or 1."""
    x = np.column_stack([x, np.ones(len(x))])
    w, before = np.zeros(x.shape[1]), None
    penalty = ridge * np.eye(x.shape[1]) * weight.sum() / 100
    penalty[-1, -1] *= 1e-3
    for _ in range(30):
        active = y * (x @ w) < 1
        if before is not None and (active == before).all():
            break
        before, xa = active, x[active] * weight[active, None]
        w = np.linalg.solve(xa.T @ x[active] + penalty, xa.T @ y[active])
    return w[:-1], w[-1]


def platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, by Newton steps with smoothed labels."""
    positive = label.sum()
    target = np.where(label == 1, (positive + 1) / (positive + 2), 1 / (len(label) - positive + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        x = np.column_stack([margin, np.ones(len(margin))])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (target - p))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass
class Model:
    table: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, column: list[str]) -> np.ndarray:
        """The best word's margin of each text, over some texts at a time."""
        part = np.cumsum([len(t) for t in column], dtype=np.int64) // CHUNK
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(column)]
        best = np.full(len(column), self.bias)
        for a, b in zip(edges, edges[1:]):
            s = strings(column[a:b])
            np.maximum.at(best, s.owner + a, expand(s, self.table) + self.bias)
        return best

    def scores(self, column: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(column) + self.offset, -35, 35)))


def sentences(text: str) -> list[str]:
    return [s for s in re.split(r"[.!?]+\s|\n", text) if s.strip()]


def distinct(sample: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The sample without near copies of the same label: half of the 16 smallest word hashes alike."""
    kept, seen = [], {}
    for text, toxic in sorted(set(sample)):
        sketch = sorted({zlib.crc32(w.encode()) for w in text.lower().split()})[:16]
        alike = Counter(other for h in sketch for other in seen.get((toxic, h), ()))
        if alike and max(alike.values()) * 2 >= len(sketch):
            continue
        for h in sketch:
            seen.setdefault((toxic, h), []).append(len(kept))
        kept.append((text, toxic))
    return kept


def association(doc: np.ndarray, item: np.ndarray, n: int, label: np.ndarray) -> tuple[np.ndarray, ...]:
    """Clean documents of each item, its log odds of toxic ones, and how far their share is above chance."""
    toxic, clean = (np.bincount(item, label[doc] == x, minlength=n) for x in (1, 0))
    odds = np.log((toxic + 0.5) / (label.sum() + 1)) - np.log((clean + 0.5) / ((1 - label).sum() + 1))
    share, total = label.mean(), toxic + clean
    return clean, odds, (toxic - share * total) / np.sqrt(np.maximum(total * share * (1 - share), 1e-9))


def runs(s: Strings, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, letters as a number) of each run of so many letters, by word."""
    n = np.maximum(0, s.size - length + 1)
    word = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + s.begin[word]
    key = np.zeros(len(word), dtype=np.int64)
    for i in range(length):
        key = key * LETTERS + s.letters[place + i]
    return word, key


def train(sample: list[tuple[str, int]], n_landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Model | None:
    """The model of (text, label) rows; None if they have one label only."""
    sample = distinct(sample)
    label = np.array([toxic for _, toxic in sample], dtype=np.int64)
    if len(set(label.tolist())) < 2:
        return None
    # Each sentence once, with a document that has it: one that any clean document has is clean.
    owner: dict[str, int] = {}
    for doc in np.argsort(label, kind="stable").tolist():
        for sentence in sentences(sample[doc][0]):
            owner.setdefault(sentence, doc)
    split = list(owner)
    doc_of = np.array(list(owner.values()), dtype=np.int64)
    side_of = label[doc_of]
    s = strings(split)
    packed = [s.letters[a : a + n].tobytes() for a, n in zip(s.begin.tolist(), s.size.tolist())]
    number: dict[bytes, int] = {}
    said = np.array([number.setdefault(p, len(number)) for p in packed], dtype=np.int64)
    sizes = np.array([len(p) for p in number], dtype=np.int64)
    words = Strings(np.frombuffer(b"".join(number), np.int8), np.cumsum(sizes) - sizes, sizes, np.arange(len(sizes)))
    pair = np.unique(doc_of[s.owner] * len(sizes) + said)
    doc, word = pair // len(sizes), pair % len(sizes)
    clean, odds, lift = association(doc, word, len(sizes), label)
    # A word is also as telling as a run of its letters that hardly any clean document has.
    for length in RUNS:
        run_of, run = runs(words, length)
        known, run = np.unique(run, return_inverse=True)
        begins = np.searchsorted(run_of, np.arange(len(sizes) + 1))
        many = np.diff(begins)[word]
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begins[word], many)
        pair = np.unique(np.repeat(doc, many) * len(known) + run[place])
        _, run_odds, run_lift = association(pair // len(known), pair % len(known), len(known), label)
        np.maximum.at(lift, run_of, np.where(run_odds > RUN_PURE, run_lift, -np.inf)[run])
    able = sizes >= 4
    top = np.flatnonzero(able & (odds > 0))
    common = np.flatnonzero(able & (odds <= 0))
    half = n_landmarks // 2
    marks = np.concatenate([
        unlike(words, top[np.argsort(-lift[top], kind="stable")], half),
        unlike(words, common[np.argsort(-clean[common], kind="stable")], half),
    ])
    landmarks = chosen(words, marks)
    among = kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    inverse = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    mark_word, mark_key, mark_weight = features(landmarks)

    def table_of(w: np.ndarray) -> np.ndarray:
        table = np.zeros(LETTERS**3)
        np.add.at(table, mark_key, mark_weight * (inverse @ w)[mark_word])
        return table

    def pick(numbers: np.ndarray) -> np.ndarray:
        return kernel(chosen(words, numbers), landmarks) @ inverse

    # Sentences of toxic documents whose best word is no chance, and at least half of the document's best.
    value = np.where(able, lift, -np.inf)
    spoken, heard = s.owner[side_of[s.owner] == 1], said[side_of[s.owner] == 1]
    best, most = np.full(len(split), -np.inf), np.full(len(sample), -np.inf)
    np.maximum.at(best, spoken, value[heard])
    np.maximum.at(most, doc_of, best)
    telling = best[spoken] >= np.maximum(SIGNIFICANT, most[doc_of[spoken]] / 2)
    spoken, heard = spoken[telling], heard[telling]
    is_clean = np.flatnonzero((clean > 0) & able)
    against = is_clean[np.argsort(-clean[is_clean], kind="stable")[:3000]]
    for _ in range(rounds):
        best = np.full(len(split), -np.inf)
        np.maximum.at(best, spoken, value[heard])
        witness, times = np.unique(heard[value[heard] >= best[spoken]], return_counts=True)
        # A witness that clean sentences have too says little.
        good = (odds[witness] > PURE) & able[witness]
        witness, times = witness[good], times[good]
        if not len(witness):
            return None
        varied = kernel(with_insertions(chosen(words, witness)), landmarks) @ inverse
        x = np.concatenate([pick(witness), varied, pick(against)])
        y = np.concatenate([np.ones(3 * len(witness)), -np.ones(len(against))])
        weight = np.concatenate([np.sqrt(times), np.repeat(np.sqrt(times), 2) / 2, np.ones(len(against))])
        weight[y > 0] *= weight[y < 0].sum() / weight[y > 0].sum()
        w, bias = linear_svm(x, y, weight)
        table = table_of(w)
        value = np.where(able, expand(words, table) + bias, -np.inf)
        worst = is_clean[np.argsort(-value[is_clean], kind="stable")[:1500]]
        against = np.unique(np.concatenate([against, worst]))
    model = Model(table, float(bias), 1.0, 0.0)
    model.slope, model.offset = platt(model.margins([text for text, _ in sample]), label)
    return model


def fold(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, size: int) -> list[tuple[str, int]]:
    """About `size` toxic texts and twice as many others, of the folds that may train, by a hash of their id."""
    known = (
        labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .filter(fold(F.col("doc_id")) != 0)
    )
    chosen = sampled(known.filter("toxic = 1"), size, "doc_id").union(
        sampled(known.filter("toxic = 0"), 2 * size, "doc_id")
    )
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).filter(
        F.length("text") <= SAMPLE_CHARS
    )
    # About three times `size` ids and numbers; one text for each id, however often it is repeated.
    rows = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return [(r["text"], r["toxic"]) for r in rows.orderBy("doc_id").collect()]


def score(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of `docs`."""
    model = train(labelled_sample(docs, labels, doc_id, text, label, sample))

    def work(batch: pa.RecordBatch) -> dict:
        column = texts(batch["text"]).to_pylist()
        scores = model.scores(column) if model else np.zeros(len(column))
        return {"doc_id": batch["doc_id"], "score": pa.array(scores, pa.float64())}

    needed = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return mapped(needed, work, "doc_id bigint, score double").select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
