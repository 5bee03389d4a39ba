"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are complete and kept as flat arrays, so scoring walks all rows level by level in numpy.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.batches import map_texts
from cellweave.llm.textkit import Texts, duplicate_lines, repeated, window_words

#: Labelled rows used for fitting, at most; those with the smallest hash of their key are taken.
FIT_ROWS = 12_000
FOLDS, HELD_OUT = 5, 0
CUT = 0.3

FEATURES = (
    "log_words", "word_length", "symbols", "upper", "digits", "bangs", "bars", "other_punctuation",
    "commas_stops", "duplicate_lines", "distinct_words", "adjacent_words", "repeat_3", "repeat_8",
    "line_words", "non_ascii", "long_words", "spaces",
)


def features(texts: list[str | None]) -> np.ndarray:
    """Statistics of a batch of texts, one row each; a null or empty text has zeros."""
    t = Texts(texts)
    b = t.bytes
    words = t.word_hash()
    n = t.n_words
    many = np.maximum(n, 1)
    table = np.zeros(256, np.uint8)
    for i, group in enumerate((b"#*$%&<>", bytes(range(65, 91)), bytes(range(48, 58)), b"!", b"|", b"\"'()-:;=?@[]_{}~/\\^`+", b",."), 1):
        table[list(group)] = i
    kind = table[b]
    count = [t.per_text(kind == i) for i in range(1, 8)]
    size = np.maximum(t.ends - t.starts - 1, 1)
    n_lines, later = duplicate_lines(t)
    _, seen = repeated(words, t.word_text)
    same = np.zeros(len(words), bool)
    if len(words) > 1:
        same[1:] = (words[1:] == words[:-1]) & (t.word_text[1:] == t.word_text[:-1])

    def over_words(flags: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(flags)])
        return running[t.last] - running[t.first]

    lengths = t.word_end - t.word_start
    return np.column_stack([
        np.log1p(n), over_words(lengths) / many, count[0] / size, count[1] / size, count[2] / size, count[3] / many,
        count[4] / many, count[5] / size, count[6] / many, later / np.maximum(n_lines, 1), 1 - over_words(seen) / many,
        over_words(same) / many, window_words(t, words, 3) / many, window_words(t, words, 8) / many,
        n / np.maximum(n_lines, 1), t.per_text(b >= 128) / size, over_words(lengths > 24) / many,
        (t.per_text(t.separator) - 1) / size,
    ]).astype(np.float64)


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: feature and threshold of inner nodes, values of leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 48, ridge: float = 2.0) -> Trees:
    """Boost logistic loss; splits are searched over histograms of quantile bins."""
    inner = 2**depth - 1
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), float(np.log(share / (1 - share))))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    start = float(np.log(y.mean() / (1 - y.mean())))
    raw = np.full(len(y), start)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(width)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                slot = local * (len(e) + 1) + code[:, f]
                g = np.bincount(slot, gradient, width * (len(e) + 1)).reshape(width, -1).cumsum(axis=1)
                h = np.bincount(slot, hessian, width * (len(e) + 1)).reshape(width, -1).cumsum(axis=1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge) - whole_g**2 / (whole_h + ridge)
                gain = np.where((h > 1) & (whole_h - h > 1), gain, 0)[:, :-1]
                at = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(width), at] > best + 1e-9):
                    best[k], feature[first + k], threshold[first + k] = gain[k, at[k]], f, e[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        place = node - inner
        g, h = np.bincount(place, gradient, inner + 1), np.bincount(place, hessian, inner + 1)
        leaf = rate * g / (h + ridge)
        raw += leaf[place]
        out.append((feature, threshold, leaf))
    return Trees(*(np.array(a) for a in zip(*out, strict=True)), start)


def fold(key: str = "doc_id", folds: int = FOLDS):
    """crc32 of the key as text, modulo the number of folds; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled documents outside the held-out fold.

    Only the bounded sample's statistics reach the driver. Labels that are null are left out; of
    several texts of one id the least is taken, so the bound holds.
    """
    sample = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold() != HELD_OUT)
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text")
    got = map_texts(texts, "text", lambda batch: {"x": list(features(batch))}, "x array<double>", keep=["label"]).toPandas()
    x = np.array(got["x"].tolist()).reshape(-1, len(FEATURES))
    order = np.lexsort([got["label"].to_numpy(), *x.T])  # whatever the order of arrival
    return fit(x[order], got["label"].to_numpy()[order].astype(float))


def score(docs: DataFrame, model: Trees, text: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``keep`` columns (all, if None) and the score of every whole text.

    Repeated rows get repeated scores; a null or empty text is scored as one without words; very
    long texts are read whole; an empty table gives no rows. ``name`` must not be among ``keep``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, text, lambda texts: {name: shared.value.score(features(texts))}, f"{name} double", keep)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of each row of ``docs`` by trees learnt from ``labels`` outside the held-out fold.

    As :func:`score`; only ``doc_id`` and ``text`` are read, so other columns' names do not matter.
    """
    scored = score(docs, train(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows of ``docs`` predicted to be good, learnt from the labels in ``sf_dir``.

    The score is computed where the row is, so no text is shuffled. Null and empty texts are scored
    as texts without words; rows that repeat, or have no id, are each judged by their text;
    long texts are read whole; an empty table stays empty. All columns are handed on; the name
    ``_cw_score`` is taken.
    """
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, name="_cw_score").where(F.col("_cw_score") >= CUT).drop("_cw_score")


def crc_fold(value: object, folds: int = FOLDS) -> int:
    """The same fold in plain Python, for tests."""
    return zlib.crc32(str(value).encode()) % folds
