"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, a posterior decides."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.batches import map_texts
from cellweave.llm.textkit import Texts, duplicate_lines, window_words
from cellweave.session import written

#: Fixed by the contract: symbols that count, and the window of repeated words.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

GOOD, BAD, ABSTAIN = "+", "-", "0"
#: Least posterior probability of quality of a document that is kept.
CUT = 0.5
#: Each rule: name, measure, votes good at or under the first bound, bad over the second.
RULES = (
    ("symbols", "symbol_ratio", 0.02, 0.10),
    ("symbol_words", "symbol_word_ratio", 0.02, 0.20),
    ("letters", "other_ratio", 0.15, 0.22),
    ("duplicate_lines", "line_ratio", 0.10, 0.30),
    ("repetition", "repeat_ratio", 0.10, 0.30),
    ("adjacent", "adjacent_ratio", 0.05, 0.20),
    ("shouting", "upper_ratio", 0.20, 0.60),
    ("long_words", "long_ratio", 0.10, 0.35),
    ("exclamation", "bang_ratio", 0.10, 0.50),
)

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, votes string"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])


def measure(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Base statistics and votes of a batch of texts (null: no words)."""
    t = Texts(texts)
    words = t.word_hash()
    lead = (t.bytes & 0xC0) != 0x80
    n = t.n_words
    out = {"n_words": n}
    out["word_chars"] = t.per_text(lead & ~t.separator)
    out["n_symbols"] = t.per_text(_SYMBOL[t.bytes])
    n_lines, out["n_dup_lines"] = duplicate_lines(t)
    out["n_repeat_words"] = window_words(t, words, WINDOW)
    out["base_failed"] = (n < 20) | (100 * out["n_repeat_words"] > 30 * n)
    many = np.maximum(n, 1)
    same = np.zeros(len(words), np.int64)
    if len(words) > 1:
        same[1:] = (words[1:] == words[:-1]) & (t.word_text[1:] == t.word_text[:-1])
    running = np.concatenate([[0], np.cumsum(same)])
    marks = np.concatenate([[0], np.cumsum(_SYMBOL[t.bytes])])
    marked = np.concatenate([[0], np.cumsum(marks[t.word_end] > marks[t.word_start])])
    other = t.per_text((t.bytes < 128) & ~_LETTER[t.bytes] & ~t.separator)
    long_words = np.concatenate([[0], np.cumsum(t.word_end - t.word_start > 24)])
    upper = t.per_text((t.bytes >= 65) & (t.bytes <= 90))
    lower = t.per_text((t.bytes >= 97) & (t.bytes <= 122))
    values = {
        "symbol_ratio": out["n_symbols"] / many,
        "symbol_word_ratio": (marked[t.last] - marked[t.first]) / many,
        "other_ratio": other / np.maximum(out["word_chars"], 1),
        "line_ratio": out["n_dup_lines"] / np.maximum(n_lines, 1),
        "repeat_ratio": out["n_repeat_words"] / many,
        "adjacent_ratio": (running[t.last] - running[t.first]) / many,
        "upper_ratio": upper / np.maximum(upper + lower, 1),
        "long_ratio": (long_words[t.last] - long_words[t.first]) / many,
        "bang_ratio": t.per_text(t.bytes == 33) / many,
    }
    votes = np.full(len(t), "", dtype=object)
    for _, name, good, bad in RULES:
        x = np.asarray(values[name])
        votes = votes + np.where(x > bad, BAD, np.where(x <= good, GOOD, ABSTAIN)).astype(object)
    out["votes"] = np.where(n == 0, ABSTAIN * len(RULES), votes)
    return out


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its key, the base statistics and one vote for each rule."""
    return map_texts(docs, text, measure, STATS, keep=[key])


def fit_votes(patterns: dict[str, int], rounds: int = 50, prior: float = 0.85) -> dict[str, float]:
    """Posterior probability of quality of each vote pattern, by expectation-maximisation.

    Given the class, rules vote independently; each rule has its chances of voting good,
    bad or abstaining under either class. Counts of one and the starting accuracies act as
    the prior, so a rule that never fires stays neutral.
    """
    if not patterns:
        return {}
    keys = sorted(patterns)
    weight = np.array([patterns[k] for k in keys], float)
    code = np.array([[{GOOD: 0, BAD: 1, ABSTAIN: 2}[c] for c in k] for k in keys])
    one_hot = np.eye(3)[code]  # patterns x rules x outcomes
    n_rules = code.shape[1]
    start = np.array([[0.1, 0.6, 0.3], [0.85, 0.02, 0.13]])  # bad, good
    chance = np.repeat(start[:, None, :], n_rules, axis=1)
    pull = chance * max(10.0, 0.01 * weight.sum())
    share = np.array([1 - prior, prior])
    for _ in range(rounds):
        log = np.log(share)[:, None] + np.einsum("pro,cro->cp", one_hot, np.log(chance))
        log -= log.max(axis=0)
        post = np.exp(log)
        post /= post.sum(axis=0)
        counts = np.einsum("cp,p,pro->cro", post, weight, one_hot) + pull
        chance = counts / counts.sum(axis=2, keepdims=True)
        share = np.clip((post * weight).sum(axis=1) / weight.sum(), 0.01, 0.99)
        share /= share.sum()
    return dict(zip(keys, post[1].tolist(), strict=True))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Quality verdict for each row of ``docs``.

    Statistics and votes are computed on Spark over all texts. Votes form at most
    3 ** len(RULES) patterns, whose counts over the whole corpus are all that EM needs.
    A null or empty text has no words and fails the base rule; repeated rows get
    repeated results; the key may be null; very long texts are read whole; an empty table gives
    no rows. Only key and text are read, so other columns' names do not matter.
    """
    stats = written(with_statistics(docs, key, text), "rules")
    spark = stats.sparkSession
    counts = {r["votes"]: r["n"] for r in stats.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior = spark.createDataFrame(list(fit_votes(counts).items()), "votes string, posterior double")
    judged = stats.join(F.broadcast(posterior), "votes", "left")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= CUT))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior", "votes",
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Pipeline stage: rows of ``docs`` that the rules keep, with all their columns.

    Votes are counted in one pass and cast again in a second one, so no text is shuffled. Null and
    empty texts fail the base rule and go; rows that repeat, or have no id, are each judged by their
    text; texts with the same votes share a verdict; long texts are read whole; an empty table
    stays empty. All columns are handed on; the name ``_cw_kept`` is taken.
    """
    counts = {r["votes"]: r["n"] for r in with_statistics(docs).groupBy("votes").agg(F.count("*").alias("n")).collect()}
    good = {k for k, p in fit_votes(counts).items() if p >= CUT}

    def verdict(texts: list[str | None]) -> dict:
        stats = measure(texts)
        return {"_cw_kept": ~stats["base_failed"] & np.array([v in good for v in stats["votes"]], bool)}

    return map_texts(docs, "text", verdict, "_cw_kept boolean").where("_cw_kept").drop("_cw_kept")
