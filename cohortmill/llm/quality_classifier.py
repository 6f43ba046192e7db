"""Quality by co-training a text view and a metadata view.

Text view: shares and averages of a text's characters, words and lines. Metadata view:
source, language and length of the page as given, source and language hashed into a fixed
number of columns. Each view is a logistic regression. In each round each view
labels the unlabelled pool, and what it is sure of (its calibrated probability of either side at
least `SURE`) becomes training rows of the other view, as many of each side as the labelled
rows' shares say. A view that can tell nothing is never sure and hands nothing on. A round hands on
the surest rows, by a bound found from counts, up to an equal share of the pool: after the last
round each view can have handed on all of it.

Each view is then calibrated by Platt scaling on labelled rows that trained neither, and a
document's score is the product of both calibrated odds over the prior's.

The features of all rows are computed once and stored. All unlabelled documents are the pool. It
stays a table: tasks label it and sum gradients and Hessians, the driver adds the labelled rows and
makes Newton's steps. Of the labelled documents about `SAMPLE` are taken, chosen by a hash of the
id. All rows are scored.

Defined cases: null and empty texts have zero features; null source, language and length are
values of their own. Null ids and labels don't train; of repeated labels the larger
share counts, a tie as good. With labels of one kind or none every score is 0.5.
Repeated rows each get their score. A score of 0.5 is kept. Columns that the operator
doesn't name are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import code_words, mapped, sampled, split_words, stored, texts

TEXT_FEATURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "marks", "exclamations", "bars", "wide",
    "distinct_words", "distinct_lines", "words_per_line", "short_words", "longest_word", "spaces",
)
SOURCE_COLUMNS, LANG_COLUMNS = 64, 16
SAMPLE = 15_000
ROUNDS = 4
SURE = 0.95
FOLDS = 5
STEPS = 25
# Rows of sums that the driver gets at most in a pass.
SUMS = 64
HANDED = ("label_text", "label_meta")
# Steps between `SURE` and the largest logit in which the pool's rows are counted.
BINS = 1_024
MAX_LOGIT = 20

FEATURES = "doc_id bigint, text_view array<float>, source string, lang string, n_chars bigint"


def _byte_classes() -> np.ndarray:
    classes = np.zeros((256, 8), dtype=bool)
    for b in range(256):
        c = chr(b)
        classes[b] = [
            "A" <= c <= "Z", c.isascii() and c.isalpha(), c.isascii() and c.isdigit(), c in "#*$%&<>{}[]=_~^\\",
            c in ".,;:?!'\"()-", c == "!", c == "|", b >= 128,
        ]
    return classes


_CLASSES = _byte_classes()


def text_view(column: pa.Array) -> np.ndarray:
    """The text features of each text."""
    offsets, words = split_words(column)
    codes, distinct = code_words(words)
    sizes = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), len(TEXT_FEATURES)), dtype=np.float32)
    for i, text in enumerate(column.cast(pa.large_binary()).to_pylist()):
        own = codes[offsets[i] : offsets[i + 1]]
        if not len(own):
            continue
        upper, letters, digits, symbols, marks, calls, bars, wide = (
            np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES
        )
        lines = [line for line in text.split(b"\n") if line.strip()]
        length, size = sizes[own], len(text)
        out[i] = (
            np.log1p(len(own)), length.mean(), upper / max(1, letters), digits / size, symbols / size, marks / size,
            calls / len(own), bars / len(own), wide / size, len(np.unique(own)) / len(own),
            len(set(lines)) / len(lines), np.log1p(len(own) / len(lines)), (length <= 2).mean(),
            np.log1p(length.max()), 1 - length.sum() / size,
        )
    return out


def _hashed(value: str | None, columns: int) -> int:
    return zlib.crc32(b"null" if value is None else b"=" + value.encode()) % columns


def meta_view(source: list, lang: list, n_chars: list) -> np.ndarray:
    """The metadata features of each row."""
    return _meta_columns(
        np.array([_hashed(s, SOURCE_COLUMNS) for s in source], dtype=np.int64),
        np.array([_hashed(x, LANG_COLUMNS) for x in lang], dtype=np.int64),
        np.array([np.nan if n is None else n for n in n_chars], dtype=np.float64),
    )


def _meta_columns(source: np.ndarray, lang: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
    """The metadata features by the columns that source and language fall into."""
    out = np.zeros((len(source), SOURCE_COLUMNS + LANG_COLUMNS + 3))
    rows = np.arange(len(source))
    out[rows, source] = 1
    out[rows, SOURCE_COLUMNS + lang] = 1
    known = ~np.isnan(n_chars)
    size = np.log1p(np.maximum(0, np.where(known, n_chars, 0)))
    out[:, -3:] = np.column_stack([known, size / 10, (size / 10) ** 2])
    return out


@dataclass
class Logistic:
    """Ridge logistic regression on standardised columns, with a Platt scale of its own."""

    ridge: float = 1.0
    slope: float = 1.0
    offset: float = 0.0
    w: np.ndarray = field(default_factory=lambda: np.zeros(0))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.mean, self.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        x = np.column_stack([(x - self.mean) / self.spread, np.ones(len(x))])
        penalty = self.ridge * np.eye(x.shape[1])
        penalty[-1, -1] = 1e-6
        self.w = np.zeros(x.shape[1])
        for _ in range(25):
            p = sigmoid(x @ self.w)
            step = np.linalg.solve(
                (x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ self.w
            )
            self.w = self.w + step
            if np.abs(step).max() < 1e-6:
                break
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.w[:-1] + self.w[-1]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        inner = Logistic(ridge=1e-3).fit(self.margin(x)[:, None], (y * len(y) + 1) / (len(y) + 2))
        self.slope = float(inner.w[0] / inner.spread[0])
        self.offset = float(inner.w[1] - inner.w[0] * inner.mean[0] / inner.spread[0])
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.margin(x) + self.offset, -MAX_LOGIT, MAX_LOGIT)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


# What one view hands to the other in a round: (view, its model, [(side, bound, part)]). Rows in a bin
# above `bound` are handed on, of those in it a `part`.
Handed = tuple[int, Logistic, list[tuple[int, int, float]]]


def _luck(luck: np.ndarray, turn: int) -> np.ndarray:
    """A number from 0 to 1 for each row, another one each turn."""
    mixed = (luck.astype(np.uint64) ^ np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(11)) / float(1 << 53)


def _bins(logits: np.ndarray, side: int, sure: float) -> np.ndarray:
    """The bin of each row that the model is sure of on a side, of others -1."""
    least = np.log(sure / (1 - sure))
    above = ((logits if side else -logits) - least) / (MAX_LOGIT - least)
    return np.where(above < 0, -1, np.minimum(above * BINS, BINS - 1)).astype(np.int64)


def _hand_on(views, luck, labels: list[np.ndarray], turn: int, handed: list[Handed], sure: float) -> list[np.ndarray]:
    """The label each view has been handed for each row after a turn, or -1."""
    labels = [own.copy() for own in labels]
    drawn = _luck(luck, turn)
    for view, model, limits in handed:
        free, logits = labels[1 - view] < 0, model.logit(views[view])
        for side, bound, part in limits:
            bins = _bins(logits, side, sure)
            labels[1 - view][free & ((bins > bound) | ((bins == bound) & (drawn < part)))] = side
    return labels


def _counts(views, labels: list[np.ndarray], models: list[Logistic], sure: float) -> np.ndarray:
    """Rows by view that is sure of them, side and bin; without those it has handed on."""
    out = np.zeros((2, 2, BINS))
    for view, model in enumerate(models):
        logits = model.logit(views[view])[labels[1 - view] < 0]
        for side in (0, 1):
            bins = _bins(logits, side, sure)
            out[view, side] = np.bincount(bins[bins >= 0], minlength=BINS)
    return out.ravel()


def _sums(x: np.ndarray, y: np.ndarray, base: tuple[np.ndarray, np.ndarray], w: np.ndarray) -> np.ndarray:
    """Rows, loss, gradient, Hessian, sums and squares in the scale of `base`, where `w` are the weights."""
    x = np.column_stack([(x - base[0]) / base[1], np.ones(len(x))])
    margin = x @ w
    p = sigmoid(margin)
    loss = np.logaddexp(0, margin).sum() - y @ margin
    hessian = (x * (p * (1 - p))[:, None]).T @ x
    return np.concatenate([[len(x), loss], x.T @ (y - p), hessian.ravel(), x.sum(axis=0), (x * x).sum(axis=0)])


def _pool_sums(views, labels: list[np.ndarray], bases: list, weights: list) -> np.ndarray:
    parts = []
    for x, label, base, w in zip(views, labels, bases, weights):
        parts.append(_sums(x[label >= 0], label[label >= 0].astype(np.float64), base, w))
    return np.concatenate(parts)


class ArrayPool:
    """Unlabelled rows of both views in memory."""

    def __init__(self, views: list[np.ndarray], luck: np.ndarray | None = None) -> None:
        self.views = views
        self.rows = len(views[0])
        self.luck = np.arange(self.rows) if luck is None else luck
        self.labels = [np.full(self.rows, -1, dtype=np.int8) for _ in views]

    def total(self, work: Callable, *given) -> np.ndarray | float:
        return work(self.views, self.labels, *given)

    def hand_on(self, *given) -> None:
        self.labels = _hand_on(self.views, self.luck, self.labels, *given)


def _added(parts: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"sums": [sum(np.frombuffer(x) for x in parts["sums"]).tobytes()]})


class TablePool:
    """Unlabelled rows as a stored table, with the labels handed on so far; each task gives the sum over its rows."""

    def __init__(self, table: DataFrame) -> None:
        self.table = stored(table.withColumns({name: F.lit(-1).cast("tinyint") for name in HANDED}), "quality-pool")
        self.rows = self.table.count()

    def parts(self, work: Callable, *given) -> DataFrame:
        """Sums over some of the rows each, `SUMS` rows at most."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = 0.0
            for batch in batches:
                if batch.num_rows:
                    out = out + work(_pool_views(batch), _pool_labels(batch), *given)
            if np.ndim(out):
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

        parts = self.table.mapInArrow(run, "sums binary")
        if self.table.rdd.getNumPartitions() > SUMS:
            # Added up in tasks first, so that what the driver sees doesn't grow with the table.
            slot = F.pmod(F.spark_partition_id(), F.lit(SUMS)).alias("slot")
            parts = parts.select(slot, "sums").groupBy("slot").applyInPandas(_added, "sums binary")
        return parts

    def total(self, work: Callable, *given) -> np.ndarray | float:
        # Rows of 60 KB.
        return sum(np.frombuffer(r["sums"]) for r in self.parts(work, *given).collect())

    def hand_on(self, *given) -> None:
        """Store the labels of a turn, so that no pass applies earlier models again."""
        names = self.table.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    labels = _hand_on(_pool_views(batch), batch["luck"].to_numpy(), _pool_labels(batch), *given)
                    own = dict(zip(HANDED, labels))
                    arrays = [pa.array(own[n], pa.int8()) if n in own else batch[n] for n in names]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

        self.table = stored(self.table.mapInArrow(run, self.table.schema), "quality-pool")


def _pool_labels(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch[name].to_numpy() for name in HANDED]


def _pool_views(batch: pa.RecordBatch) -> list[np.ndarray]:
    text = batch["text_view"].flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, len(TEXT_FEATURES))
    n_chars = pc.cast(batch["n_chars"], pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    return [text, _meta_columns(batch["source"].to_numpy(), batch["lang"].to_numpy(), n_chars)]


class _Newton:
    """The fit of one view from sums over its rows, wherever they lie."""

    def __init__(self, x: np.ndarray) -> None:
        spread = x.std(axis=0)
        self.base = (x.mean(axis=0), np.where(spread < 1e-6, 1, spread))
        self.w = np.zeros(x.shape[1] + 1)
        self.begin()

    def begin(self) -> None:
        self.done, self.last, self.model = False, None, None

    def step(self, sums: np.ndarray, ridge: float = 1.0) -> None:
        """One step, or half of the last one if that led away. `w` is in the scale of `base`."""
        d = len(self.w)
        n, loss, gradient, rest = sums[0], sums[1], sums[2 : 2 + d], sums[2 + d :]
        hessian, total, squares = rest[: d * d].reshape(d, d), rest[d * d : -d][:-1], rest[-d:][:-1]
        mean = total / n
        spread = np.maximum(np.sqrt(np.maximum(squares / n - mean**2, 0)), 1e-6)
        # From the scale of `base` to columns of mean 0 and spread 1, in which the ridge holds.
        scale = np.diag(np.append(1 / spread, 1.0))
        scale[:-1, -1] = -mean / spread
        w = np.append(self.w[:-1] * spread, self.w[-1] + mean @ self.w[:-1])
        penalty = np.append(np.full(d - 1, ridge), 1e-6)
        loss += penalty @ w**2 / 2
        if self.last is not None and loss > self.last[0] + 1e-9 * abs(self.last[0]):
            step = self.last[2] / 2
            self.last = (self.last[0], self.last[1], step)
        else:
            step = np.linalg.solve(scale @ hessian @ scale.T + np.diag(penalty), scale @ gradient - penalty * w)
            self.last = (loss, w, step)
        w = self.last[1] + step
        self.w = scale.T @ w
        self.done = bool(np.abs(step).max() < 1e-4)
        self.model = Logistic(w=w, mean=self.base[0] + self.base[1] * mean, spread=self.base[1] * spread)


def _limit(counts: np.ndarray, quota: float) -> tuple[int, float]:
    """The bin from which on up to `quota` rows lie, and the part taken of that bin's own."""
    above = np.cumsum(counts[::-1])[::-1]
    if above[0] <= quota:
        return 0, 1.0
    bound = int(np.flatnonzero(above > quota)[-1])
    return bound, float((quota - (above[bound] - counts[bound])) / counts[bound])


def co_train(
    views: list[np.ndarray],
    y: np.ndarray,
    calibrates: np.ndarray,
    pool: list[np.ndarray] | ArrayPool | TablePool,
    rounds: int = ROUNDS,
    sure: float = SURE,
    per_round: float | None = None,
) -> list[Logistic]:
    """Both views' models; `calibrates` marks the labelled rows kept for calibration.

    A view hands on `per_round` rows of the pool in a round at most, if not given an equal share of it.
    """
    pool = ArrayPool(pool) if isinstance(pool, list) else pool
    per_round = pool.rows / rounds if per_round is None else per_round
    trains = ~calibrates
    fits = [_Newton(x[trains]) for x in views]
    sizes = [2 + d + d * d + 2 * d for d in (len(fit.w) for fit in fits)]
    models: list[Logistic] = []
    for turn in range(rounds + 1):
        for fit in fits:
            fit.begin()
        for _ in range(STEPS):
            bases, weights = [fit.base for fit in fits], [fit.w for fit in fits]
            given = pool.total(_pool_sums, bases, weights) if turn else np.zeros(sum(sizes))
            for fit, x, sums in zip(fits, views, np.split(given, [sizes[0]])):
                if not fit.done:
                    fit.step(sums + _sums(x[trains], y[trains], fit.base, fit.w))
            if all(fit.done for fit in fits):
                break
        models = [fit.model.calibrate(x[calibrates], y[calibrates]) for fit, x in zip(fits, views)]
        if turn == rounds or not pool.rows:
            break
        counts = np.reshape(pool.total(_counts, models, sure), (2, 2, BINS))
        if not counts.any():
            break
        shares = (1 - y.mean(), y.mean())
        handed = [
            (view, model, [(side, *_limit(counts[view, side], per_round * shares[side])) for side in (0, 1)])
            for view, model in enumerate(models)
        ]
        pool.hand_on(turn, handed, sure)
    return models


def features(docs: DataFrame, doc_id: str, text: str, source: str, lang: str, n_chars: str) -> DataFrame:
    """Text features and metadata of each row, stored."""

    def work(batch: pa.RecordBatch) -> dict:
        view = text_view(texts(batch["text"]))
        return {
            **{name: batch[name] for name in ("doc_id", "source", "lang", "n_chars")},
            "text_view": pa.array(list(view), pa.list_(pa.float32())),
        }

    needed = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.col(source).alias("source"),
        F.col(lang).alias("lang"),
        F.col(n_chars).cast("bigint").alias("n_chars"),
    )
    return stored(mapped(needed, work, FEATURES), "quality-features")


def unlabelled(table: DataFrame, known: DataFrame) -> TablePool:
    """One row of each id that isn't in `known`."""
    row = F.min(F.struct("text_view", "source", "lang", "n_chars")).alias("row")
    ids = table.filter("doc_id is not null").groupBy("doc_id").agg(row).join(known, "doc_id", "left_anti")

    def column(name: str, columns: int) -> F.Column:
        text = F.coalesce(F.concat(F.lit("="), F.col(f"row.{name}")), F.lit("null"))
        return (F.crc32(text.cast("binary")) % columns).alias(name)

    pool = ids.select(
        F.xxhash64("doc_id").alias("luck"),
        "row.text_view",
        column("source", SOURCE_COLUMNS),
        column("lang", LANG_COLUMNS),
        "row.n_chars",
    )
    return TablePool(pool)


def _views(rows: list) -> list[np.ndarray]:
    text = np.array([r["text_view"] for r in rows], dtype=np.float64).reshape(len(rows), len(TEXT_FEATURES))
    return [text, meta_view(*([r[c] for r in rows] for c in ("source", "lang", "n_chars")))]


def score(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    n_chars: str = "n_chars",
    label: str = "quality",
    sample: int = SAMPLE,
) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of each row of `docs`."""
    table = features(docs, doc_id, text, source, lang, n_chars)
    known = (
        labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("double").alias("y"))
        .filter("doc_id is not null and y is not null")
        .groupBy("doc_id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )
    # One fold trains nothing and tells how well the rest does; one calibrates.
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    known = known.withColumn("fold", fold).filter("fold <> 0")
    # One row for each id, however often it is repeated.
    row = F.min(F.struct("text_view", "source", "lang", "n_chars")).alias("row")
    chosen = table.join(sampled(known, sample, "doc_id"), "doc_id").groupBy("doc_id", "y", "fold").agg(row)
    marked = chosen.orderBy("doc_id").select("row.*", "y", "fold").collect()
    y = np.array([r["y"] for r in marked], dtype=np.float64)
    calibrates = np.array([r["fold"] == 1 for r in marked], dtype=bool)
    able = len(y) and all(len(set(part.tolist())) == 2 for part in (y[calibrates], y[~calibrates]))
    models = co_train(_views(marked), y, calibrates, unlabelled(table, known)) if able else None
    prior = float(np.log(y.mean() / (1 - y.mean()))) if able else 0.0

    def work(batch: pa.RecordBatch) -> dict:
        logits = [np.zeros(batch.num_rows)] * 2
        if models:
            logits = [model.logit(x) for model, x in zip(models, _views(batch.to_pylist()))]
        total = sigmoid(logits[0] + logits[1] - prior)
        return {
            "doc_id": batch["doc_id"],
            "text_score": pa.array(sigmoid(logits[0])),
            "meta_score": pa.array(sigmoid(logits[1])),
            "score": pa.array(total),
            "kept": pa.array(total >= 0.5),
        }

    return mapped(table, work, "doc_id bigint, text_score double, meta_score double, score double, kept boolean")
