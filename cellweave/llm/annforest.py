"""Approximate nearest neighbours by forests of hash prefixes.

In every tree a vector has a hash string: cross-polytope symbols (which axis of a random
projection the vector is closest to, and on which side) written one after another. Rows are
dealt into blocks, and each block holds a forest: for every tree its strings in a sorted array.
A query descends to its longest prefixes in all trees of a block and ascends in all of them at
the same time, bit by bit, until together they hold enough rows of the block under its
prefixes. What lies there is scored exactly, and the best of all blocks are merged.

Vectors with equal components are one entry; only as many of their ids are kept as one result
can name, which loses nothing since equal scores go to the smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.session import prepare, written

TREES = 512
#: Symbols of a hash string and bits of a symbol: 2 ** 6 axes with two sides each.
SYMBOLS, SYMBOL_BITS = 2, 7
BITS = SYMBOLS * SYMBOL_BITS
STORED = np.uint16 if BITS <= 16 else np.uint32
#: Shortest prefix that an ascent ends at.
SHORTEST = 3
#: Rows that an ascent asks for, counted once a tree, as a share of all rows ...
EFFORT = 0.05
#: ... and this many more for each tree; each block gives its share of both.
LEAST = 4
NEAREST = 5
EVERY = 50
#: Entries in a block, and queries that meet a block in one task.
BLOCK = 4096


def projections(width: int, seed: int = 99) -> np.ndarray:
    """For each tree and symbol a random projection of ``width`` to 64 dimensions."""
    rng = np.random.default_rng(seed)
    return rng.standard_normal((TREES, SYMBOLS, width, 1 << (SYMBOL_BITS - 1))).astype(np.float32)


def hash_strings(unit: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """(vectors x trees) hash strings of ``BITS`` bits as whole numbers."""
    out = np.zeros((len(unit), len(turned)), np.uint32)
    every = np.arange(len(unit))
    for t, symbols in enumerate(turned):
        for projection in symbols:
            image = unit @ projection
            high, low = image.argmax(axis=1), image.argmin(axis=1)
            side = image[every, high] > -image[every, low]
            out[:, t] = out[:, t] << SYMBOL_BITS | np.where(side, high, low) << 1 | side
    return out


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(vec_id, v) of vectors that can be compared: no nulls inside, all finite, not zero."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & F.col("vec_id").isNotNull() & fine)


def _entries(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(entry, v) of distinct vectors, an entry's name being its smallest id, and (entry, vec_id)
    of the ``most`` smallest ids of each."""
    order = Window.partitionBy("h1", "h2", "v").orderBy("vec_id")
    hashed = rows.select("vec_id", "v", F.xxhash64("v").alias("h1"), F.hash("v").alias("h2")).distinct()
    ranked = hashed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    ranked = ranked.withColumn("entry", F.min("vec_id").over(Window.partitionBy("h1", "h2", "v")))
    ranked = written(ranked.select("entry", "vec_id", "v"), "entries")
    return ranked.where("entry = vec_id").select("entry", "v"), ranked.select("entry", "vec_id")


def hashed(entries: DataFrame, width: int) -> DataFrame:
    """(entry, v, strings): the entries with their hash strings in all trees."""
    shared = entries.sparkSession.sparkContext.broadcast(projections(width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                v = np.array(part.column(1).to_pylist(), np.float64)
                unit = (v / np.abs(v).max(axis=1, keepdims=True)).astype(np.float32)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                strings = [row.astype(STORED).tobytes() for row in hash_strings(unit, shared.value)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(strings, pa.binary())], names=["entry", "v", "strings"])

    return entries.select("entry", "v").mapInArrow(run, "entry long, v array<double>, strings binary")


class Forest:
    """The sorted arrays of one block."""

    def __init__(self, strings: np.ndarray):
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def ranges(self, strings: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries x trees) first and last place under the prefixes where each ascent ends."""
        first = np.zeros(strings.shape, np.int64)
        last = np.zeros(strings.shape, np.int64)
        climbing = np.arange(len(strings))
        for length in range(BITS, SHORTEST - 1, -1):
            drop = np.uint32(BITS - length)
            prefix = strings[climbing] >> drop
            for t in range(strings.shape[1]):
                column = self.sorted[:, t]
                first[climbing, t] = np.searchsorted(column, prefix[:, t] << drop, "left")
                last[climbing, t] = np.searchsorted(column, (prefix[:, t] + np.uint32(1)) << drop, "left")
            climbing = climbing[(last[climbing] - first[climbing]).sum(axis=1) < enough]
            if not len(climbing):
                break
        return first, last

    def under(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rows of the block that lie in any of one query's ranges."""
        size = last - first
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
        held = np.zeros(len(self.order), bool)
        held[self.order[at, np.repeat(np.arange(len(size)), size)]] = True
        return np.flatnonzero(held)


def wanted_share(n: int, effort: float = EFFORT) -> float:
    """What an ascent asks of each block of a table of ``n`` entries, as a share of the block."""
    return effort + LEAST * TREES / max(n, 1)


def cosines(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``v`` and ``q``, in double precision; scaled first against overflow."""
    v, q = v / np.abs(v).max(axis=1, keepdims=True), q / np.abs(q).max()
    return np.einsum("ij,j->i", v, q) / np.sqrt(np.einsum("ij,ij->i", v, v) * np.einsum("i,i->", q, q))


def search(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", nearest: int = NEAREST, every: int = EVERY, effort: float = EFFORT) -> DataFrame:
    """The ``nearest`` other rows by cosine of each row whose id ``every`` divides.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    rows without an id or of another width than the most frequent one. Rows that repeat id and
    vector count once. Equal cosines go to the smaller id. The stated queries meet all blocks, and
    in each what their prefixes hold. Only the two named columns are read; an empty table gives no rows.
    """
    spark = prepare(vectors.sparkSession)
    rows = usable(vectors, key, column)
    widths = rows.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("w")).first()
    if widths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = widths["w"]
    rows = written(rows.where(F.size("v") == width), "vectors")
    entries, members = _entries(rows, nearest + 1)
    made = written(hashed(entries, width), "forest")
    # each query id is asked through its vector's entry
    asking = rows.where(F.col("vec_id") % every == 0).distinct()
    asking = written(asking.join(made.select("entry", "v"), "v").select(F.col("vec_id").alias("query_id"), "entry"), "queries")
    queries = made.join(asking.select("entry").distinct(), "entry", "left_semi").select(F.col("entry").alias("query"), F.col("v").alias("q"), F.col("strings").alias("asked"))
    n_entries, n_asking = made.count(), asking.count()
    blocks, query_blocks = (max(1, math.ceil(n / BLOCK)) for n in (n_entries, n_asking))
    share = wanted_share(n_entries, effort)

    def dealt(name: str, n: int):
        return F.pmod(F.xxhash64(name), F.lit(n))

    def every_one(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))

    left = queries.select("query", "q", "asked", dealt("query", query_blocks).alias("qblock"), every_one(blocks).alias("block"))
    right = made.select("entry", "v", "strings", dealt("entry", blocks).alias("block"), every_one(query_blocks).alias("qblock"))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The best of one block for each query; ties at the end of the list all stay."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            names, v = right["entry"].to_numpy(), np.array(right["v"].tolist(), np.float64)
            strings = [np.frombuffer(b"".join(side), STORED).reshape(-1, TREES).astype(np.uint32) for side in (right["strings"], left["asked"])]
            trees = Forest(strings[0])
            first, last = trees.ranges(strings[1], math.ceil(share * len(names)))
            for i, (query, q) in enumerate(zip(left["query"], left["q"], strict=True)):
                at = trees.under(first[i], last[i])
                cosine = cosines(v[at], np.asarray(q, np.float64))
                if len(at):
                    good = cosine >= np.sort(cosine)[-min(nearest + 1, len(at))]
                    out.append((np.full(good.sum(), query), names[at][good], cosine[good]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0)] * 3
        return pd.DataFrame(dict(zip(("query", "entry", "score"), columns, strict=True))).astype({"query": "int64", "entry": "int64", "score": "float64"})

    scored = left.groupBy("block", "qblock").cogroup(right.groupBy("block", "qblock")).applyInPandas(score, "query long, entry long, score double")
    # entries beyond the rank that one result can name are never needed
    best = Window.partitionBy("query").orderBy(F.desc("score"))
    scored = scored.withColumn("place", F.rank().over(best)).where(F.col("place") <= nearest + 1).drop("place")
    each = asking.withColumnRenamed("entry", "query").join(scored, "query").join(members, "entry").where(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
