"""Centroid clustering in whole numbers, by Orchard's search.

Every centroid has the list of the others by distance from it. A vector starts at a centroid
and walks down that one's list; whenever a centroid of the list is closer, the walk goes on in
the closer one's list, leaving out what it has seen. What lies strictly beyond twice the
present distance cannot be closer, nor as close, so there the walk ends: far centroids are
never compared. Squared distances are whole numbers, so ties and sums are exact at any size.

Each round is one pass over the written vectors: every task adds up its own vectors by
centroid, and only these sums are shuffled. Centroids, which the caller's ``k`` bounds, are all
that reaches the driver or is sent out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.session import prepare, written

#: Fixed by the contract.
K, ROUNDS, SCALE, WIDTH, SEED = 8, 10, 1024, 64, "3:"
#: Components under this keep four times a squared distance of up to 64 of them inside 64 bits.
SMALL = 1 << 26
MOST = (1 << 63) - 1


def whole(vectors: DataFrame, key: str, column: str, width: int, scale: int) -> DataFrame:
    """(vec_id, q): components times ``scale``, rounded down, of vectors with ``width`` components,
    none null or not finite. Components beyond 64 bits are the nearest 64-bit number."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where((F.size("v") == width) & fine).select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("q"))


def _exact(*arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays as they are where 64 bits hold all that is made of them, else of Python's numbers."""
    if all(a.size == 0 or (a.max() < SMALL and a.min() > -SMALL and a.shape[1] <= 64) for a in arrays):
        return arrays
    return tuple(a.astype(object) for a in arrays)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


class Centroids:
    """Centroids with each one's list of the others by distance, then number."""

    def __init__(self, rows: list[list[int]]):
        self.rows = rows
        self.at = np.array(rows, dtype=np.int64)
        (at,) = _exact(self.at)
        self.gap = np.stack([squared(at, c) for c in at])
        n = len(rows)
        self.lists = np.array([[j for _, j in sorted((self.gap[c, j], j) for j in range(n) if j != c)] for c in range(n)], np.int64).reshape(n, n - 1)

    def nearest(self, vectors: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each vector's nearest centroid, of equally near ones the first.

        ``start``: the centroid in whose list each walk begins.
        """
        x, at = _exact(vectors, self.at)
        gap = self.gap if x.dtype == self.gap.dtype else self.gap.astype(object)
        now = start.astype(np.int64).copy()
        distance = squared(x, at[now])
        seen = np.zeros((len(x), len(at)), bool)
        seen[np.arange(len(x)), now] = True
        place = np.zeros(len(x), np.int64)
        walking = np.arange(len(x)) if len(at) > 1 else np.zeros(0, np.int64)
        while len(walking):
            other = self.lists[now[walking], place[walking]]
            within = (gap[now[walking], other] <= 4 * distance[walking]).astype(bool)
            walking, other = walking[within], other[within]
            place[walking] += 1
            fresh = ~seen[walking, other]
            who, other = walking[fresh], other[fresh]
            seen[who, other] = True
            d = squared(x[who], at[other])
            closer = ((d < distance[who]) | ((d == distance[who]) & (other < now[who]))).astype(bool)
            who = who[closer]
            now[who], distance[who], place[who] = other[closer], d[closer], 0
            walking = walking[place[walking] < len(at) - 1]
        return now, distance


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def assigned(rows: DataFrame, centroids: Centroids, width: int) -> DataFrame:
    """``rows`` (vec_id, q, start) with ``cluster`` and ``distance`` (at most the largest long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            now, distance = centroids.nearest(_numbers(batch.column(1), width), batch.column(2).to_numpy())
            capped = pa.array([min(int(d), MOST) for d in distance] if distance.dtype == object else distance, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(now.astype(np.int32)), capped], names=["vec_id", "q", "cluster", "distance"])

    return rows.select("vec_id", "q", "start").mapInArrow(run, "vec_id long, q array<long>, cluster int, distance long")


_SUMS = pa.schema([("cluster", pa.int32()), ("part", pa.int32()), ("total", pa.decimal128(38, 0)), ("n", pa.int64())])


def moved(rows: DataFrame, centroids: Centroids, width: int) -> Centroids:
    """The means, rounded down, of the vectors nearest to each centroid; one without vectors stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids.rows)
        total, n = np.zeros((k, width), object), np.zeros(k, np.int64)
        for batch in batches:
            q = _numbers(batch.column(0), width)
            now, _ = centroids.nearest(q, batch.column(1).to_numpy())
            (exact,) = _exact(q)  # a batch's sums of such components stay inside 64 bits
            for c in np.unique(now):
                total[c] += exact[now == c].sum(axis=0).astype(object)
            n += np.bincount(now, minlength=k)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(held, width), pa.int32()), pa.array(np.tile(np.arange(width), len(held)), pa.int32()),
            pa.array(total[held].ravel().tolist(), pa.decimal128(38, 0)), pa.array(np.repeat(n[held], width)),
        ], schema=_SUMS)

    sums = rows.select("q", "start").mapInArrow(run, "cluster int, part int, total decimal(38,0), n long").groupBy("cluster", "part").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    made = [list(c) for c in centroids.rows]
    for r in sums.collect():  # k times width rows
        made[r["cluster"]][r["part"]] = int(r["total"]) // r["n"]
    return Centroids(made)


def cluster(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = K, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: str = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every vector that :func:`whole` keeps, and the final centroids.

    Centroids start as the ``k`` vectors whose ids have the smallest SHA-256 of ``seed`` and id, in
    that order; fewer vectors give fewer centroids, an empty table none and no rows. Rows that
    repeat are clustered, and may start centroids, each by itself, rows of one id by their
    components. Rows without an id are clustered but start a centroid only where ids run out.
    Other columns of ``vectors`` are not looked at. A squared distance beyond 64 bits is
    compared exactly and given as the largest long.
    """
    spark = prepare(vectors.sparkSession)
    kept = whole(vectors, key, column, width, scale)
    hashed = kept.select(F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")).cast("binary"), 256).alias("h"), "q")
    first = [list(r["q"]) for r in hashed.orderBy(F.col("h").asc_nulls_last(), "q").limit(k).collect()]
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    centroids = Centroids(first)
    # walks begin at what was nearest at first, which for most vectors stays near
    rows = written(assigned(kept.withColumn("start", F.lit(0)), centroids, width).select("vec_id", "q", F.col("cluster").alias("start")), "vectors")
    for _ in range(rounds):
        centroids = moved(rows, centroids, width)
    return assigned(rows, centroids, width).drop("q"), centroids.rows


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns; sums of distances are at most the largest long."""
    found, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    found = written(found, "clusters")
    sums = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}

    def by_cluster(values: dict, kind: str):
        return F.coalesce(F.lit(None).cast(kind), *(F.when(F.col("cluster") == c, F.lit(v).cast(kind)) for c, v in values.items()))

    digest = {c: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for c, row in enumerate(centroids)}
    return found.select(
        "vec_id", "cluster", "distance", by_cluster({c: min(s, MOST) for c, s in sums.items()}, "long").alias("cluster_inertia"),
        F.lit(min(sum(sums.values()), MOST)).cast("long").alias("inertia"), by_cluster(digest, "string").alias("centroid_sha256"),
    )


def _sql() -> str:
    """The same by plain comparison of every vector with every centroid, round by round."""
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rowid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
 WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q FROM (SELECT sha256('{SEED}' || vec_id) AS h, q FROM v ORDER BY h, q LIMIT {K}))",
    ]
    near = "SELECT v.rowid AS i, any_value(v.vec_id) AS vec_id, any_value(v.q) AS q, min(struct_pack(d := list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c := c.c)) AS best FROM v, c{r} c GROUP BY v.rowid"
    for r in range(ROUNDS + 1):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(r=r)})")
        if r < ROUNDS:
            mean = f"SELECT c, list(m ORDER BY i) AS q FROM (SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM (SELECT best.c AS c, unnest(range(1, {WIDTH + 1})) AS i, unnest(q) AS x FROM a{r}) GROUP BY c, i) GROUP BY c"
            parts.append(f"m{r} AS MATERIALIZED ({mean})")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m ON m.c = c.c)")
    last = f"""SELECT vec_id, CAST(best.c AS INT) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
 CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.c = a.best.c"""
    return "WITH " + ",\n".join(parts) + "\n" + last


ORACLE_SQL = _sql()
