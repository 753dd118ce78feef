"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a logistic model whose score estimates the probability that a text is
good. The risk is the non-negative unbiased one: prior * loss(positive as 1) + max(0, loss(unlabelled as 0) - prior *
loss(positive as 0)); where the second term is negative, its gradient is turned round. The class prior (share of good
texts among the unlabelled) is estimated from the same two samples: a first model tells positives from unlabelled texts,
and over score thresholds the least ratio of the unlabelled share to the positive share above it, both with a margin of
confidence, bounds the prior.

The inputs are measures of the whole text (``FEATURES``) and their squares. The fit sees at most ``sample`` positives and
``sample`` unlabelled texts, those whose identifiers' hashes are smallest (a uniform sample that doesn't depend on
partitions); the unlabelled shares of the class prior are counted over all unlabelled texts, and every text is scored.

Cases: null and empty texts have all measures 0 and the score that these get. Labels that are null or repeated: a
document is a positive if any row of its labels says so. Repeated documents get equal scores. Extra columns of documents
are not used. Without positives or without texts the score is 0.5 for all. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh
from .shingles import WordHashes, windows

FEATURES = ("log_words", "symbols", "others", "capitals", "digits", "marks", "bars", "repeats", "same_words", "dup_lines", "word_length", "short_words", "line_words", "stops")
SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

_CLASS = np.zeros(256, np.int64)
for _chars, _k in ((b"#*$%&<>", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3), (b"!?", 4), (b"|", 5), (b"abcdefghijklmnopqrstuvwxyz", 6), (b".,;:'\"()-", 7), (b" \t\r\x0b\x0c\n", 8)):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _k
_CLASS[128:] = 6  # letters of other scripts, byte by byte


def held_out(key: Column) -> Column:
    """Whether a row belongs to the fold that no label is learned from; a null key does not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def measures(text: str | None, memo: WordHashes) -> np.ndarray:
    out = np.zeros(len(FEATURES))
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    n = len(words)
    if not n:
        return out
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9)
    chars = max(1, int(kinds.sum() - kinds[8]))
    hashes = memo.of(words)
    repeats = 0.0
    if n >= 3:
        w = windows(hashes, 3)
        _, at, times = np.unique(w, return_inverse=True, return_counts=True)
        repeats = float((times[at] > 1).mean())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    out[:] = (
        np.log1p(n), kinds[1] / n, kinds[0] / chars, kinds[2] / chars, kinds[3] / chars, kinds[4] / n, kinds[5] / n, repeats,
        1 - len(np.unique(hashes)) / n, 1 - len(set(lines)) / max(1, len(lines)), min(30.0, lengths.mean()), float((lengths <= 3).mean()), np.log1p(n / max(1, len(lines))), kinds[7] / n,
    )
    return out


def _vectors(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key columns, measures) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            rows = [measures(t.as_py(), memo).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=[key, "measures"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text_col).mapInArrow(run, f"`{key}` {kind}, measures array<double>")


class Model:
    """Standardised measures and squares, weights and bias."""

    def __init__(self, x: np.ndarray):
        raw = self._spread(x)
        self.mean, self.scale = raw.mean(0), raw.std(0) + 1e-6
        self.weights, self.bias = np.zeros(raw.shape[1]), 0.0

    @staticmethod
    def _spread(x: np.ndarray) -> np.ndarray:
        return np.hstack([x, x**2])

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((self._spread(x) - self.mean) / self.scale, -8, 8)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(x) @ self.weights + self.bias, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Least non-negative unbiased risk with the logistic loss, by full-batch Adam."""
    model = Model(np.vstack([positive, unlabelled]))
    p, u = model.inputs(positive), model.inputs(unlabelled)
    theta = np.zeros(p.shape[1] + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def gradient(x: np.ndarray, target: float) -> tuple[float, np.ndarray]:
        z = np.clip(x @ theta[:-1] + theta[-1], -30, 30)
        s = 1 / (1 + np.exp(-z))
        loss = float(np.log1p(np.exp(-z if target else z)).mean())
        g = (s - target) / len(x)
        return loss, np.append(x.T @ g, g.sum())

    for t in range(1, rounds + 1):
        _, gp = gradient(p, 1.0)
        lu, gu = gradient(u, 0.0)
        lp, gn = gradient(p, 0.0)
        negative = gu - prior * gn
        g = prior * gp + negative if lu - prior * lp >= 0 else -negative
        g[:-1] += decay * theta[:-1]
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        theta = theta - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    model.weights, model.bias = theta[:-1], float(theta[-1])
    return model


def thresholds(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[Model, np.ndarray, np.ndarray, int]:
    """(model, scores, share of positives at or above each, how many these are of) of a model of one half, on the other half's positives."""
    half_p, half_u = len(positive) // 2, len(unlabelled) // 2
    model = fit(positive[:half_p] if half_p else positive, unlabelled[:half_u] if half_u else unlabelled, 0.5)
    p = np.sort(model.score(positive[half_p:]))
    at = np.quantile(p, np.linspace(0.0, 0.9, 91))
    return model, at, 1 - np.searchsorted(p, at, "left") / len(p), len(p)


def counts_above(texts: DataFrame, text_col: str, model: Model, at: np.ndarray) -> np.ndarray:
    """How many texts there are, and how many score at or above each of ``at``: over all rows, added up on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, total = WordHashes(), np.zeros(len(at) + 1, np.int64)
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                x = np.array([measures(t.as_py(), memo) for t in whole.slice(k, 1000).column(0)]).reshape(-1, len(FEATURES))
                if len(x):
                    total[0] += len(x)
                    total[1:] += len(x) - np.searchsorted(np.sort(model.score(x)), at, "left")
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(total)), pa.int32()), "n": pa.array(total, pa.int64())})

    rows = texts.select(text_col).mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()  # one for each threshold
    out = np.zeros(len(at) + 1, np.int64)
    for r in rows:
        out[r["place"]] = r["n"]
    return out


def class_prior(above: np.ndarray, positives_above: np.ndarray, n_positive: int) -> float:
    """Share of positives among the unlabelled: the least of (share of unlabelled above a score) / (share of positives above it), with margins."""
    n = max(1, int(above[0]))
    share = above[1:] / n
    margin = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(n_positive) + 1 / np.sqrt(n))
    best = int(np.argmin((share + margin) / positives_above))
    return float(np.clip(share[best] / positives_above[best], 0.05, 0.95))


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[Model | None, float]:
    """Model and prior from documents outside the held-out fold; of labels only those with quality 1 are used."""
    seed = F.xxhash64(F.col(id_col).cast("string"), F.lit(20_011))
    trusted = labels.where((F.col("quality") == 1) & ~held_out(F.col(id_col))).select(id_col).distinct().withColumn("order", seed).orderBy("order", id_col).limit(sample).select(id_col)
    chosen = F.broadcast(trusted)  # at most ``sample`` identifiers
    texts = documents.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(id_col, text_col)
    total = texts.select(F.count("*")).first()[0]
    share = min(1.0, 2.0 * sample / max(1, total))
    rare = texts.where(F.pmod(seed, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).join(chosen, id_col, "left_anti")
    key = F.xxhash64(id_col)
    p = _vectors(texts.join(chosen, id_col, "left_semi"), id_col, text_col).orderBy(key, id_col).limit(2 * sample).select("measures").collect()
    u = _vectors(rare, id_col, text_col).orderBy(key, id_col).limit(sample).select("measures").collect()
    if not p or not u:
        return None, 0.5
    p, u = np.array([r[0] for r in p]), np.array([r[0] for r in u])
    half, at, above, n = thresholds(p, u)
    unlabelled = texts.join(chosen, id_col, "left_anti")
    prior = class_prior(counts_above(unlabelled, text_col, half, at), above, n)
    return fit(p, u, prior), prior


def score(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (the identifier, if none are named) and ``score`` (``score_2`` and so on if that is one of them) of every row."""
    keep = [id_col] if keep is None else list(dict.fromkeys(keep))
    columns = list(dict.fromkeys([*keep, text_col]))
    name = fresh(documents.select(*keep), "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                texts = batch.column(batch.schema.get_field_index(text_col))
                x = np.array([measures(t.as_py(), memo) for t in texts]).reshape(len(texts), len(FEATURES))
                s = model.score(x) if model is not None else np.full(len(x), 0.5)
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(s, pa.float64())], names=[*keep, name])

    picked = documents.select(*columns)
    return picked.mapInArrow(run, T.StructType([*(picked.schema[c] for c in keep), T.StructField(name, T.DoubleType())]))
