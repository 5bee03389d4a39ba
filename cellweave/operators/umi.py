"""UMI error correction: edit-distance graphs within (ref, cb, gx, gn) and their clusters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.sequences import deletions, divergence_keys, free_divergence, free_divergence_within_one, hamming
from cellweave.operators.components import components
from cellweave.operators.matrix import exploded
from cellweave.operators.skew import split_join
from cellweave.session import written

GROUP = ["ref", "cb", "gx", "gn"]
#: What tells which of two alignments comes first.
PLACE = ("pos", "is_reverse", "align_ordinal")
#: UMIs with their groups that are sent to every task, at most.
SENT = 1 << 17


def umi_counts(alignments: DataFrame) -> DataFrame:
    """Alignments and first place of each raw UMI of each group, both mates and all features.

    The place is the position; where alignments have ``is_reverse`` and ``align_ordinal`` (a
    record's number in the file), it is a struct of all that they have, in this order.
    """
    place = [c for c in PLACE if c in alignments.columns]
    rows = exploded(alignments.select("ref", "cb", "ur", "gx", "gn", *place))
    return rows.groupBy(*GROUP, "ur").agg(F.count("*").alias("cnt"), F.min(F.struct(*place) if len(place) > 1 else "pos").alias("ord"))


def _rule(distance: str, most: int) -> tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]:
    """Keys of which two near UMIs share one, and whether two UMIs are near."""
    if distance == "freediv":
        within = free_divergence_within_one if most == 1 else lambda a, b: free_divergence(a, b, most) >= 0
        return lambda s: divergence_keys(s, most), within
    if distance == "levenshtein":
        return lambda s: deletions(s, most), lambda a, b: F.levenshtein(a, b, most) >= 0
    if distance == "hamming":
        return lambda s: deletions(s, most), lambda a, b: hamming(a, b) <= most
    raise ValueError("distance must be one of freediv, levenshtein, hamming")


def _near(counts: DataFrame, distance: str, most: int, kept: Callable[[Column, Column], Column]) -> DataFrame:
    """(group, a, b) of UMIs of one group, as nodes (c, o, u) that sort by falling count, then
    place, then text, within ``most`` edits and as ``kept`` wants them; once for each pair.

    Candidates share a key made by deletions, an equi-join that misses no pair, so that a group
    with many UMIs is not paired with itself: how many share a key depends on the UMIs' length.
    """
    keys, within = _rule(distance, most)
    node = F.struct((-F.col("cnt")).alias("c"), F.col("ord").alias("o"), F.col("ur").alias("u"))
    posted = counts.select(*GROUP, node.alias("a"), F.explode(keys(F.col("ur"))).alias("key"))
    pairs = posted.join(posted.withColumnRenamed("a", "b"), [*GROUP, "key"]).where(kept(F.col("a"), F.col("b"))).select(*GROUP, "a", "b")
    # dealt by the UMI that later steps group by, so that dropping repeated pairs moves nothing more
    return pairs.repartition(*GROUP, "a").distinct().where(within(F.col("a.u"), F.col("b.u")))


def edges(counts: DataFrame, distance: str = "freediv", most: int = 1) -> DataFrame:
    """Pairs (a, b), a before b as text, of UMIs of one group within ``most`` edits."""
    near = _near(counts, distance, most, lambda a, b: a["u"] < b["u"])
    return near.select(*GROUP, F.col("a.u").alias("a"), F.col("b.u").alias("b"))


def parents(counts: DataFrame, distance: str = "freediv", most: int = 1) -> DataFrame:
    """(group, ur, parent): of the neighbours that come before a UMI by count and place and have at
    least twice its count less one, the first; UMIs without one are left out. UMIs of equal count
    and place are ordered as text, so one of any two comes before the other."""
    near = _near(counts, distance, most, lambda a, b: (b < a) & (-b["c"] >= -2 * a["c"] - 1))
    first = near.groupBy(*GROUP, "a").agg(F.min("b").alias("b"))
    return first.select(*GROUP, F.col("a.u").alias("ur"), F.col("b.u").alias("parent"))


def corrected(counts: DataFrame, distance: str = "freediv", most: int = 1, counted: bool = False) -> DataFrame:
    """(group, ur, ub): each UMI and the root of its tree of parents; with ``counted`` its ``cnt`` too.

    Pointers jump to their targets' targets, so the number of rounds is the logarithm of the
    deepest tree. An empty table gives no rows.
    """
    counts = written(counts, "umi-counts")
    jump = written(parents(counts, distance, most), "umi-parents")
    while True:
        onward = jump.select(*GROUP, F.col("ur").alias("parent"), F.col("parent").alias("next"))
        moved = jump.join(onward, [*GROUP, "parent"], "left").select(*GROUP, "ur", F.coalesce("next", "parent").alias("parent"), F.col("next").isNotNull().alias("moved"))
        moved = written(moved, "umi-parents")
        jump = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    kept = ["ur", "cnt"] if counted else ["ur"]
    return counts.select(*GROUP, *kept).join(jump, [*GROUP, "ur"], "left").select(*GROUP, *kept, F.coalesce("parent", "ur").alias("ub"))


def undirected(counts: DataFrame, distance: str = "freediv", most: int = 1) -> DataFrame:
    """(group, ur, ub): components of the graph, each named by its most frequent, then first UMI."""
    counts = written(counts, "umi-counts")
    near = _near(counts, distance, most, lambda a, b: b < a)
    found = components(near.select(*GROUP, F.col("a").alias("v"), F.col("b").alias("u")), GROUP)
    named = found.select(*GROUP, F.col("v.u").alias("ur"), F.col("u.u").alias("ub"))
    return counts.select(*GROUP, "ur").join(named, [*GROUP, "ur"], "left").select(*GROUP, "ur", F.coalesce("ub", "ur").alias("ub"))


def apply(alignments: DataFrame, mapping: DataFrame) -> DataFrame:
    """Alignments with ``ub`` by their first feature; those without features go.

    Where ``mapping`` has each UMI's ``cnt`` in these alignments, those of one that very many reads
    have are dealt over several tasks; a mapping of few UMIs is sent to the alignments instead, which then
    are not moved. What the mapping does not have gets a null ``ub``.
    """
    first = {f"f_{n}": F.substring_index(n, ";", 1) for n in ("gx", "gn")}
    keyed = alignments.where("gx IS NOT NULL AND gn IS NOT NULL").withColumns(first)
    key, counted = ["ref", "cb", "f_gx", "f_gn", "ur"], "cnt" in mapping.columns
    names = mapping.select("ref", "cb", F.col("gx").alias("f_gx"), F.col("gn").alias("f_gn"), "ur", "ub", *(["cnt"] if counted else []))
    if not counted:
        return keyed.join(names, key, "left").drop("f_gx", "f_gn")
    names = written(names, "umi-names")
    if names.count() <= SENT:
        return keyed.join(F.broadcast(names.drop("cnt")), key, "left").drop("f_gx", "f_gn")
    empty = F.exists(F.array(*(F.col(c).isNull() for c in key)), lambda x: x)
    joined = split_join(keyed.where(~empty), names, key, "cnt").drop("cnt")
    return joined.unionByName(keyed.where(empty).withColumn("ub", F.lit(None).cast("string"))).drop("f_gx", "f_gn")
