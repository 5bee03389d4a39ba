"""Whitelist decoding, read pairs, thresholds, read names and tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.sequences import decoder_input, deletions, divergence_keys, free_divergence, free_divergence_within_one, hamming, without_positions

SAMPLE = 10_000  # the last record number of the threshold sample


def decode(raws: DataFrame, whitelist: DataFrame, most: int = 1, distance: str = "levenshtein") -> DataFrame:
    """(raw, decoded): members decode to themselves, others to the one nearest barcode within
    ``most`` edits, or to null if there is none or a tie.

    ``raws``: (raw); ``whitelist``: (barcode). Works on distinct raw barcodes; fuzzy candidates
    share a key made by deletions, so neither side is broadcast or crossed. By free divergence
    all that is not a member is one edit away at least.
    """
    raw = raws.select("raw").distinct().withColumn("want", decoder_input(F.col("raw")))
    listed = whitelist.select("barcode").distinct()
    exact = raw.join(listed, raw["want"] == listed["barcode"]).select("raw", "barcode", F.lit(0).alias("d"))
    rest = raw.join(listed, raw["want"] == listed["barcode"], "left_anti")
    keys = divergence_keys if distance == "freediv" else deletions
    pairs = (
        rest.select("raw", "want", F.explode(keys(F.col("want"), most)).alias("key"))
        .join(listed.select("barcode", F.explode(keys(F.col("barcode"), most)).alias("key")), "key")
        .select("raw", "want", "barcode").distinct()
    )
    if distance == "freediv" and most == 1:
        near = pairs.where(free_divergence_within_one(F.col("want"), F.col("barcode"))).select("raw", "barcode", F.lit(1).alias("d"))
    elif distance == "freediv":
        near = pairs.select("raw", "barcode", free_divergence(F.col("want"), F.col("barcode"), most).alias("d")).where("d >= 0").withColumn("d", F.greatest("d", F.lit(1)))
    else:
        near = pairs.select("raw", "barcode", F.levenshtein("want", "barcode", most).alias("d")).where("d >= 0")
    best = exact.unionByName(near).groupBy("raw", "d").agg(F.count("*").alias("ties"), F.min("barcode").alias("barcode"))
    best = best.groupBy("raw").agg(F.min_by(F.struct("ties", "barcode"), "d").alias("b"))
    return raw.select("raw").join(best, "raw", "left").select("raw", F.when(F.col("b.ties") == 1, F.col("b.barcode")).alias("decoded"))


def hamming_pairs(barcodes: DataFrame, most: int = 2) -> DataFrame:
    """(a, b, d) of barcodes of one length with at most ``most`` mismatches.

    Cut into ``most + 1`` parts, such a pair has one part in common: an equi-join.
    """
    size = F.length("barcode")
    parts = [F.substr(F.col("barcode"), F.floor(size * i / (most + 1)) + 1, F.floor(size * (i + 1) / (most + 1)) - F.floor(size * i / (most + 1))) for i in range(most + 1)]
    posted = barcodes.select("barcode").distinct().select("barcode", size.alias("size"), F.posexplode(F.array(*parts)).alias("part", "key"))
    pairs = posted.withColumnRenamed("barcode", "a").join(posted.withColumnRenamed("barcode", "b"), ["size", "part", "key"]).where("a < b")
    return pairs.select("a", "b").distinct().withColumn("d", hamming(F.col("a"), F.col("b"))).where(F.col("d") <= most)


def pair_reads(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mates by place in their files: (file_pair, rec_idx, columns of both); the longer file's rest goes."""
    named = [df.select("file_pair", "rec_idx", *(F.col(c).alias(f"{c}_{i}") for c in df.columns if c not in ("file_pair", "rec_idx"))) for i, df in ((1, first), (2, second))]
    return named[0].join(named[1], ["file_pair", "rec_idx"])


def score_thresholds(scores: DataFrame, last: int = SAMPLE) -> DataFrame:
    """(file_pair, threshold): mean less two population standard deviations of each file's first records."""
    sample = scores.where(F.col("rec_idx") <= last).groupBy("file_pair")
    return sample.agg((F.avg("score") - 2 * F.stddev_pop("score")).alias("threshold"))


def judged(scores: DataFrame, last: int = SAMPLE, thresholds: DataFrame | None = None) -> DataFrame:
    """Records with ``passes``: whether they reach their file's threshold; a file without a sample lets all pass.

    There is one threshold for each pair of files, which is what is sent to every task. Sums of
    many scores are not exact: a score that misses the threshold by a billionth passes, so that
    scores that are all equal do. ``thresholds``: those of :func:`score_thresholds`, where they are known.
    """
    known = score_thresholds(scores, last) if thresholds is None else thresholds
    found = scores.join(F.broadcast(known), "file_pair", "left")
    return found.withColumn("passes", F.col("threshold").isNull() | (F.col("score") >= F.col("threshold") - 1e-9)).drop("threshold")


def passing(scores: DataFrame, last: int = SAMPLE) -> DataFrame:
    """Records that reach their file's threshold."""
    return judged(scores, last).where("passes").drop("passes")


def annotate(alignments: DataFrame, tags: DataFrame, positions: list[int] | dict[int, list[int]]) -> DataFrame:
    """Alignments with the tags of their read: an equi-join on names without the mate positions.

    ``tags``: (read_id, tag columns). A read may have several alignments. Pairs of files whose
    mates' names differ at places of their own give ``positions`` for each ``file_pair``, which
    both sides then have.
    """
    if isinstance(positions, list):
        keyed = tags.withColumn("name_key", without_positions(F.col("read_id"), positions)).drop("read_id")
        return alignments.withColumn("name_key", without_positions(F.col("query_name"), positions)).join(keyed, "name_key").drop("name_key")

    def key(name: str) -> Column:
        by_places: dict[tuple[int, ...], list[int]] = {}
        for pair, places in positions.items():
            by_places.setdefault(tuple(places), []).append(pair)
        return F.coalesce(F.lit(None).cast("string"), *(F.when(F.col("file_pair").isin(pairs), without_positions(F.col(name), list(p))) for p, pairs in by_places.items()))

    keyed = tags.withColumn("name_key", key("read_id")).drop("read_id")
    return alignments.withColumn("name_key", key("query_name")).join(keyed, ["file_pair", "name_key"]).drop("name_key")


def format_tags(reads: DataFrame) -> DataFrame:
    """(line) of a tag file from (read_id, cb, cr, fl, ur)."""
    tag = [F.concat(F.lit(f"{n.upper()}:{k}:"), F.col(n).cast("string")) for n, k in (("cb", "Z"), ("cr", "Z"), ("fl", "i"), ("ur", "Z"))]
    return reads.select(F.concat_ws("\t", "read_id", *tag).alias("line"))


def parse_tags(lines: DataFrame) -> DataFrame:
    """(read_id, cb, cr, fl, ur) from the lines of a tag file; values may hold colons."""
    parts = F.split("line", "\t")
    tags = F.map_from_entries(F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda t: F.struct(F.split(t, ":", 3)[0], F.split(t, ":", 3)[2])))
    found = lines.select(F.get(parts, F.lit(0)).alias("read_id"), tags.alias("tags"))
    value = [F.try_element_at("tags", F.lit(n.upper())).alias(n) for n in ("cb", "cr", "fl", "ur")]
    return found.select("read_id", *value).withColumn("fl", F.col("fl").cast("int"))


def merge_tags(first: DataFrame, second: DataFrame) -> DataFrame:
    """Tags of both mates as one row: strings dot-joined, linker lengths added."""
    both = first.alias("x").join(second.alias("y"), "read_id")
    text = [F.concat_ws(".", f"x.{n}", f"y.{n}").alias(n) for n in ("cb", "cr", "ur")]
    return both.select("read_id", *text, (F.coalesce("x.fl", F.lit(0)) + F.coalesce("y.fl", F.lit(0))).alias("fl"))
