"""Joins that deal a key held by many rows over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more rows than this is dealt over several tasks ...
SPLIT = 1024
#: ... but at most so many keys are, whatever their number of rows: the largest ones.
KEYS = 1 << 16


def split_join(rows: DataFrame, one: DataFrame, key: list[str], n: str) -> DataFrame:
    """``rows`` joined with ``one``, which has a row for each key and in ``n`` how many of ``rows`` it has at most.

    Rows of a key with more than ``SPLIT`` rows go to a tile each, and that key's row of ``one`` to
    all its tiles. Such a key has a ``KEYS``-th of all rows at least, so there are ``KEYS`` of them
    at most: small enough to be sent to every task. Null keys match nothing. ``one`` is read
    more than once, so it should be a written table.
    """
    size = one.agg(F.sum(n).alias("rows"), F.max(n).alias("most")).first()
    least = max(SPLIT, (size["rows"] or 0) // KEYS)
    if (size["most"] or 0) <= least:
        return rows.join(one, key)
    found = F.broadcast(one.where(F.col(n) > least).select(*key, F.ceil(F.col(n) / least).cast("int").alias("tiles")))
    dealt = rows.join(found, key, "left").withColumn("_tile", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("tiles")).cast("int"), F.lit(0))).drop("tiles")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1))
    copied = one.join(found, key, "left").withColumn("_tile", every).drop("tiles")
    return dealt.join(copied, [*key, "_tile"]).drop("_tile")
