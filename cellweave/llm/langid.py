"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are runs of two to four bytes of the lower-cased text, other characters than letters
read as one space. Embeddings and softmax are trained by stochastic gradient descent in numpy;
a temperature fitted on a part of the sample calibrates the probabilities, and a threshold
chosen there marks predictions to be rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.batches import map_texts
from cellweave.llm.quality import fold

#: Documents used for fitting, at most; those with the smallest hash of their key are taken.
FIT_ROWS = 3_000
#: Texts longer than this are not learnt from.
FIT_CHARS = 50_000
FOLDS, HELD_OUT = 4, 2
BUCKETS_LOG2 = 15
GRAMS = (2, 3, 4)
UNKNOWN = "und"

_BLANK = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def subwords(texts: list[str | None], log2: int = BUCKETS_LOG2) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each subword of a batch of texts, and where each text's subwords start.

    A text's bytes are framed by spaces, so every text has subwords and none spans two texts.
    """
    raw = [b"   " + t.lower().encode("utf-8", "surrogatepass").translate(_BLANK) + b"   " if isinstance(t, str) else b"      " for t in texts]
    data = np.frombuffer(b"".join(raw) + b"    ", np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    n = int(sizes.sum())
    out = np.empty((n, len(GRAMS)), np.uint16 if log2 <= 16 else np.uint32)
    gram = data[:n].copy()
    for width in range(1, max(GRAMS)):
        gram |= data[width : n + width] << np.uint32(8 * width)
        if width + 1 in GRAMS:
            key = (gram.astype(np.uint64) + np.uint64((width + 1) << 40)) * _MULTIPLIER
            out[:, GRAMS.index(width + 1)] = key >> np.uint64(64 - log2)
    return out, np.cumsum(sizes) - sizes


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # buckets x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    reject_under: float

    def logits(self, texts: list[str | None]) -> np.ndarray:
        buckets, start = subwords(texts)
        sums = np.zeros((len(buckets), len(self.languages)), np.float32)
        for column in range(buckets.shape[1]):
            sums += self.table[buckets[:, column]]
        total = np.add.reduceat(sums, start, axis=0, dtype=np.float64)
        size = np.diff(np.append(start, len(buckets)))[:, None] * buckets.shape[1]
        return total / size + self.bias

    def predict(self, texts: list[str | None]) -> dict[str, list | np.ndarray]:
        """Language, probability and whether it is accepted, for each text."""
        p = _softmax(self.logits(texts) / self.temperature)
        best = p.argmax(axis=1)
        known = np.array([has_letter(t) for t in texts], bool)
        score = np.where(known, p[np.arange(len(p)), best], 0.0)
        return {
            "lang_pred": [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
            "score": score, "accepted": known & (score >= self.reject_under),
        }


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str], width: int = 12, epochs: int = 4, rate: float = 8.0, seed: int = 7) -> Model:
    """Train on whole texts; every fifth text only calibrates."""
    languages = tuple(sorted(set(langs)))
    if not languages:
        return Model((UNKNOWN,), np.zeros((1 << BUCKETS_LOG2, 1), np.float32), np.zeros(1), 1.0, 0.0)
    target = np.array([languages.index(x) for x in langs])
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (1 << BUCKETS_LOG2, width))
    weight, bias = rng.normal(0, 0.1, (width, len(languages))), np.zeros(len(languages))
    bags = []
    for text in texts:
        ids, count = np.unique(subwords([text])[0].ravel(), return_counts=True)
        bags.append((ids, count / count.sum()))
    fitted = [i for i in range(len(texts)) if i % 5] or list(range(len(texts)))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(fitted):
            ids, share = bags[i]
            mean = share @ embedding[ids]
            p = _softmax((mean @ weight + bias)[None])[0]
            p[target[i]] -= 1
            back = weight @ p
            weight -= 0.1 * step * np.outer(mean, p)
            bias -= 0.01 * step * p
            # the gradient is share x back; each row's step is over the root of its share, so that
            # long texts, whose shares are small, move their embeddings too
            embedding[ids] -= 0.05 * step * np.outer(share / np.sqrt(share), back)
    table = (embedding @ weight).astype(np.float32)
    held = [i for i in range(len(texts)) if i % 5 == 0]
    logits = np.array([bags[i][1] @ table[bags[i][0]] + bias for i in held]).reshape(len(held), -1)
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(held)), target[held]] + 1e-12).mean() for t in grid] if held else [0.0]
    temperature = float(grid[int(np.argmin(loss))]) if held else 1.0
    p = _softmax(logits / temperature) if held else np.ones((1, 1))
    right = p.argmax(axis=1) == target[held] if held else np.ones(1, bool)
    # the smallest score from which on at least 99 in 100 calibration texts are right
    order = np.argsort(p.max(axis=1))[::-1]
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(share >= 0.99)
    reject = float(p.max(axis=1)[order[enough[-1]]]) if len(enough) else 1.0
    return Model(languages, table, bias, temperature, reject)


def train(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` whole documents with text and language outside the held-out fold.

    Texts of more than ``FIT_CHARS`` characters take no part, and a row that repeats another
    counts once, so what the driver holds is bounded by ``rows * FIT_CHARS`` characters.
    """
    whole = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    usable = whole.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(fold(folds=FOLDS) != HELD_OUT)
    usable = usable.where(F.length("text") <= FIT_CHARS).withColumn("text_hash", F.xxhash64("text", "lang"))
    key = ["doc_id", "text_hash"]
    chosen = usable.select(key).distinct().orderBy(F.xxhash64("doc_id"), *key).limit(rows)
    sample = usable.join(F.broadcast(chosen), key, "left_semi").dropDuplicates(key).drop("text_hash").toPandas()
    sample = sample.sort_values(["doc_id", "lang", "text"])
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if None), the language of each whole text, its probability and acceptance.

    A text that is null, empty or has no letter is ``und`` with score 0; repeated rows get repeated
    results; very long texts are read whole; an empty table gives no rows. The result's columns
    must not be among ``keep``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, "text", lambda texts: shared.value.predict(texts), "lang_pred string, score double, accepted boolean", keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, train(docs), keep=["doc_id"])
    return found.select("doc_id", (fold(folds=FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "accepted")
