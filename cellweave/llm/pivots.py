"""Exact search for the largest inner products, through an index of distances from pivots.

Every vector is keyed by its nearest pivot and its distance from it, so that the sorted table
is a row of rings around each pivot; a block is a piece of one pivot's rings. A query at distance
d from that pivot is at least |d - r| away from whatever lies at distance r (triangle
inequality), and since ``2 <q, x> = |q|^2 + |x|^2 - |q - x|^2``, that and the longest vector of
a ring bound every product inside it. Rings are opened best bound first, outwards from where
the query itself lies; a query stops at the first ring that cannot hold a product as large as the
smallest of its best so far. Bounds carry a margin for their own rounding, products are exact.

On Spark: queries lie in groups of a bounded number, vectors in blocks of a bounded number. Per
round each group meets the blocks with the best bounds that it has not met, eight times as many as
in the round before; blocks that no query of a group needs are never met. To find them a group
sees the summaries of blocks, a few numbers each, page by page.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.session import prepare, written

#: Fixed by the contract.
NEAREST, EVERY, SCALE = 5, 50, 256
#: Vectors in a block, in a ring of it, and queries in a group.
BLOCK, RING, GROUP = 2048, 128, 512
#: Blocks that a group meets in the first round, and how many times as many in each later one.
FIRST, MORE = 4, 8
#: Pivots, and the sample that they are chosen from.
PIVOTS, SAMPLE = 32, 2048
#: Summaries of blocks in a page.
PAGE = 1 << 16
MOST = (1 << 63) - 1


def whole(vectors: DataFrame, key: str, column: str, scale: int) -> DataFrame:
    """(vec_id, v): components times ``scale``, rounded down, of vectors without null or not finite
    components; those beyond 64 bits are the nearest 64-bit number."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & F.col("vec_id").isNotNull() & fine)
    return kept.select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v")).distinct()


class Pivots:
    """For each width the pivots of that width: the origin, and vectors of a sample far from one another."""

    def __init__(self, sample: list[list[int]], most: int = PIVOTS):
        self.of: dict[int, np.ndarray] = {}
        by_width: dict[int, list[list[int]]] = {}
        for v in sample:
            by_width.setdefault(len(v), []).append(v)
        if by_width:
            width, rows = max(by_width.items(), key=lambda x: (len(x[1]), x[0]))
            at = np.array(rows, np.float64)
            chosen = [np.zeros(width)]
            gap = np.linalg.norm(at, axis=1)
            while len(chosen) <= most and gap.max() > 0:
                chosen.append(at[int(gap.argmax())])
                gap = np.minimum(gap, np.linalg.norm(at - chosen[-1], axis=1))
            self.of[width] = np.stack(chosen)

    def distances(self, v: np.ndarray) -> np.ndarray:
        """(vectors x pivots of their width)."""
        at = self.of.get(v.shape[1], np.zeros((1, v.shape[1])))
        return np.stack([np.linalg.norm(v - p, axis=1) for p in at], axis=1)


def bounds(q: np.ndarray, way: np.ndarray, low: np.ndarray, high: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """(queries x rings) no less than any product of a query and a vector of a ring.

    ``q``: lengths of the queries; ``way``: (queries x rings) their distances from the rings'
    pivots; ``low``, ``high``: least and largest distance of a ring's vectors from its pivot;
    ``longest``: their largest length.
    """
    gap = np.maximum(0, np.maximum(way - high, low - way))
    size = q[:, None] ** 2 + longest[None, :] ** 2
    return (size - gap**2) / 2 + 1e-9 * (size + way**2 + high[None, :] ** 2) + 1


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact, and at most the largest long."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    size = max(int(q.max()), -int(q.min())) * max(int(x.max()), -int(x.min())) * q.shape[1]
    if size < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if size <= MOST:
        return q.astype(np.int64) @ x.astype(np.int64).T
    return np.clip(q.astype(object) @ x.astype(object).T, -MOST, MOST).astype(np.int64)


def _packed(v: np.ndarray) -> tuple[bytes, int]:
    """Whole numbers in as few bytes each as hold all of them, and how many these are."""
    most = max(int(v.max()), -int(v.min())) if v.size else 0
    size = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return v.astype(f"<i{size}").tobytes(), size


_BLOCK = pa.schema([("number", pa.int64()), ("width", pa.int32()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("longest", pa.float64()),
                    ("ids", pa.binary()), ("way", pa.binary()), ("v", pa.binary()), ("bytes", pa.int32())])
_BLOCK_DDL = "number long, width int, pivot int, low double, high double, longest double, ids binary, way binary, v binary, bytes int"


def keyed(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """``rows`` with ``width``, the nearest pivot's number and the distance from it (``way``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(1)
            widths = np.diff(listed.offsets.to_numpy())
            values = listed.flatten().to_numpy(zero_copy_only=False)
            first = np.cumsum(widths) - widths
            pivot, way = np.zeros(len(widths), np.int32), np.zeros(len(widths))
            for w in np.unique(widths):
                at = np.flatnonzero(widths == w)
                distance = pivots.distances(values[first[at, None] + np.arange(w)].astype(np.float64))
                pivot[at] = distance.argmin(axis=1)
                way[at] = distance.min(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), listed, pa.array(widths, pa.int32()), pa.array(pivot), pa.array(way)], names=["vec_id", "v", "width", "pivot", "way"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<long>, width int, pivot int, way double")


def blocks(rows: DataFrame, most: int, by_pivot: bool = True) -> DataFrame:
    """Sorted pieces of ``most`` keyed vectors at most, one row each; of one pivot, if ``by_pivot``, and of one width always."""
    order = ["width", "pivot", "way", "vec_id"]
    parted = ["width", "pivot"] if by_pivot else ["width"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        base, made = TaskContext.get().partitionId() << 32, 0

        def closed() -> pa.RecordBatch:
            nonlocal held, made
            width = held[0][0][0]
            way, ids = (np.concatenate([x[k] for x in held]) for k in (2, 1))
            v = np.concatenate([x[3] for x in held]).reshape(len(ids), width)
            data, size = _packed(v)
            longest = float(np.linalg.norm(v.astype(np.float64), axis=1).max())
            row = [base + made, width, held[0][0][-1] if by_pivot else 0, way.min(), way.max(), longest, ids.astype("<i8").tobytes(), way.astype("<f8").tobytes(), data, size]
            made, held = made + 1, []
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK, strict=True)], schema=_BLOCK)

        for batch in batches:
            ids, way = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("vec_id", "way"))
            keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in parted], 1)
            listed = batch.column(batch.schema.get_field_index("v"))
            offsets, values = listed.offsets.to_numpy() - listed.offsets[0].as_py(), listed.flatten().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                key = tuple(keys[low].tolist())
                while low < high:
                    inside = sum(len(x[1]) for x in held)
                    if held and (held[0][0] != key or inside == most):
                        yield closed()
                        inside = 0
                    upto = min(high, low + most - inside)
                    held.append((key, ids[low:upto], way[low:upto], values[offsets[low] : offsets[upto]]))
                    low = upto
        if held:
            yield closed()

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _BLOCK_DDL)


def _opened(ids: bytes, v: bytes, size: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    return names, np.frombuffer(v, f"<i{size}").reshape(len(names), width)


def _rings(way: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First place, least and largest distance, and largest length of each ring of a sorted block."""
    first = np.arange(0, len(way), RING)
    length = np.linalg.norm(v.astype(np.float64), axis=1)
    return first, way[first], np.maximum.reduceat(way, first), np.maximum.reduceat(length, first)


def best_of_block(asked: tuple[np.ndarray, np.ndarray, np.ndarray], distance: np.ndarray, ids: np.ndarray, way: np.ndarray, v: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query's place, id, product) of what a block adds to the best of a group, and how many products were made.

    ``asked``: the group's ids, vectors and least products still wanted; ``distance``: the queries' from the block's pivot.
    """
    own, q, least = asked
    first, low, high, longest = _rings(way, v)
    bound = bounds(np.linalg.norm(q.astype(np.float64), axis=1), np.broadcast_to(distance[:, None], (len(q), len(first))), low, high, longest)
    order = np.argsort(-bound, axis=1, kind="stable")
    least = least.copy()
    score = np.full((len(q), nearest), -MOST - 1, np.int64)
    name = np.full((len(q), nearest), MOST, np.int64)
    open_, made = np.arange(len(q)), 0
    for step in range(len(first)):
        ring = order[open_, step]
        going = bound[open_, ring] >= least[open_]
        open_, ring = open_[going], ring[going]
        if not len(open_):
            break
        for r in np.unique(ring):
            who = open_[ring == r]
            part = slice(first[r], first[r] + RING)
            found = products(q[who], v[part])
            made += found.size
            found[ids[part][None, :] == own[who, None]] = -MOST - 1
            some = found.max(axis=1) >= np.maximum(least[who], -MOST)
            who, found = who[some], found[some]
            scores = np.concatenate([score[who], found], axis=1)
            names = np.concatenate([name[who], np.broadcast_to(ids[part], found.shape)], axis=1)
            top = np.lexsort((names, -np.maximum(scores, -MOST)), axis=1)[:, : nearest + found.shape[1]]
            sunk = np.take_along_axis(scores, top, axis=1) < -MOST  # places without a vector come last
            top = np.take_along_axis(top, np.argsort(sunk, axis=1, kind="stable"), axis=1)[:, :nearest]
            score[who], name[who] = np.take_along_axis(scores, top, axis=1), np.take_along_axis(names, top, axis=1)
            least[who] = np.maximum(least[who], score[who, -1])
    who, place = np.nonzero((score >= -MOST) & (score >= asked[2][:, None]))
    return who, name[who, place], score[who, place], made


_SCORED = pa.schema([("number", pa.int64()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _scored(visits: DataFrame, pivots: Pivots, nearest: int) -> DataFrame:
    """(number, place, vec_id, score) from rows that hold a group (``q_`` columns) and a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, v = _opened(r["ids"], r["v"], r["bytes"], r["width"])
                own, q = _opened(r["q_ids"], r["q_v"], r["q_bytes"], r["width"])
                distance = pivots.distances(q.astype(np.float64))[:, r["pivot"]]
                who, name, score, _ = best_of_block((own, q, np.frombuffer(r["least"], "<i8")), distance, ids, np.frombuffer(r["way"], "<f8"), v, nearest)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), r["q_number"])), pa.array(who, pa.int32()), pa.array(name), pa.array(score)], schema=_SCORED)

    return visits.mapInArrow(run, "number long, place int, vec_id long, score long")


def _wanted(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """(q_number, number, bound) of the blocks of a page that a group needs, from rows that hold a group and a page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own, q = _opened(r["q_ids"], r["q_v"], r["q_bytes"], r["q_width"])
                length, distance = np.linalg.norm(q.astype(np.float64), axis=1), pivots.distances(q.astype(np.float64))
                least = np.frombuffer(r["least"], "<i8").astype(np.float64)
                page = [x for x in r["page"] if x["width"] == r["q_width"]]
                for at in range(0, len(page), 1024):
                    part = page[at : at + 1024]
                    pivot, low, high, longest = (np.array([x[c] for x in part]) for c in ("pivot", "low", "high", "longest"))
                    bound = bounds(length, distance[:, pivot], low, high, longest)
                    need = np.flatnonzero((bound >= least[:, None]).any(axis=0))
                    best = np.where(bound >= least[:, None], bound, -np.inf).max(axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(need), r["q_number"])), pa.array(np.array([x["number"] for x in part], np.int64)[need]), pa.array(best[need])], names=["q_number", "number", "bound"])

    return rows.mapInArrow(run, "q_number long, number long, bound double")


def _with_least(groups: DataFrame, best: DataFrame | None, nearest: int) -> DataFrame:
    """Groups with ``least``: the product that each of their queries has to reach, as 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for r in batch.select(["q_ids", "full"]).to_pylist():
                least = np.full(len(r["q_ids"]) // 8, -MOST, np.int64)
                for x in r["full"] or ():
                    least[x["place"]] = x["score"]
                made.append(least.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.binary())], names=[*batch.schema.names[:-1], "least"])

    if best is None:
        full = groups.withColumn("full", F.lit(None).cast("array<struct<place:int,score:long>>"))
    else:
        last = best.where(F.col("rank") == nearest).groupBy(F.col("number").alias("q_number")).agg(F.collect_list(F.struct("place", "score")).alias("full"))
        full = groups.join(last, "q_number", "left")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema)
    return full.select(*groups.columns, "full").mapInArrow(run, f"{schema}, least binary")


def search(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", nearest: int = NEAREST, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` other rows by inner product of each row whose id ``every`` divides.

    Vectors that are null or hold null or not finite components take no part, nor do rows
    without an id. Rows that repeat id and vector count once; of rows with one id and different
    vectors each is searched for and found by itself (``query_row`` tells them apart), but none
    finds another of its own id. Vectors meet those of their own width. Equal products go to
    the smaller id. Fewer candidates give fewer rows, an empty table none; other columns are
    not looked at. Products beyond 64 bits count as the largest or smallest long.
    """
    spark = prepare(vectors.sparkSession)
    rows = written(whole(vectors, key, column, scale), "vectors")
    pivots = Pivots([list(r["v"]) for r in rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(SAMPLE).select("v").collect()])
    index = written(keyed(rows, pivots), "keyed")
    entries = written(blocks(index, BLOCK), "index")
    groups = written(blocks(index.where(F.col("vec_id") % every == 0), GROUP, by_pivot=False), "groups")
    groups = groups.select(*(F.col(c).alias(f"q_{c}") for c in ("number", "width", "ids", "v", "bytes")))
    n_groups, n_blocks = groups.count(), entries.count()
    if not n_groups:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long, query_row long")
    pages = math.ceil(n_blocks / PAGE)
    summary = entries.select("number", "width", "pivot", "low", "high", "longest")
    # a page goes to as many places as there are groups, or 200: each place sees some of the groups
    places = min(n_groups, 200)
    paged = summary.groupBy(F.pmod(F.xxhash64("number"), F.lit(pages)).alias("p")).agg(F.collect_list(F.struct(*summary.columns)).alias("page"))
    paged = written(paged.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(places - 1)))), "pages")

    met, best, take = None, None, FIRST
    while True:
        asking = written(_with_least(groups, best, nearest), "asking")
        spread = asking.withColumns({"s": F.pmod(F.xxhash64("q_number"), F.lit(places)).cast("int"), "p": F.explode(F.sequence(F.lit(0), F.lit(pages - 1)).cast("array<bigint>"))})
        wanted = _wanted(spread.join(paged, ["s", "p"]), pivots)
        if met is not None:
            wanted = wanted.join(met, ["q_number", "number"], "left_anti")
        order = Window.partitionBy("q_number").orderBy(F.desc("bound"), "number")
        chosen = written(wanted.withColumn("at", F.row_number().over(order)).where(F.col("at") <= take).select("q_number", "number"), "visits")
        if chosen.isEmpty():
            break
        visits = chosen.join(asking, "q_number").join(entries, "number")
        found = _scored(visits.select("q_number", "q_ids", "q_v", "q_bytes", "least", "width", "pivot", "ids", "way", "v", "bytes"), pivots, nearest)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        top = Window.partitionBy("number", "place").orderBy(F.desc("score"), "vec_id")
        best = written(found.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= nearest), "best")
        met = chosen if met is None else written(met.unionByName(chosen), "met")
        take *= MORE
    if best is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long, query_row long")
    return _named(groups, best)


def _named(groups: DataFrame, best: DataFrame) -> DataFrame:
    """Results under their queries' ids instead of places in groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names = np.frombuffer(ids, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), number)), pa.array(np.arange(len(names)), pa.int32()), pa.array(names)], names=["number", "place", "query_id"])

    names = groups.select("q_number", "q_ids").mapInArrow(run, "number long, place int, query_id long")
    found = names.join(best, ["number", "place"])
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.shiftleft("number", 10).bitwiseOR(F.col("place").cast("long")).alias("query_row"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("query_row")


ORACLE_SQL = f"""WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0)
 SELECT query_id, CAST(r AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= {NEAREST}"""
