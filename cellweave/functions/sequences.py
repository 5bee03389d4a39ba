"""Column functions on sequences and read names; all stay inside Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """Reverse complement over A, C, G, T; other letters stay."""
    return F.translate(F.reverse(seq), "ACGT", "TGCA")


def decoder_input(raw: Column) -> Column:
    """Raw barcode as decoders want it: upper case, N read as A."""
    return F.translate(F.upper(raw), "N", "A")


def hamming(a: Column, b: Column) -> Column:
    """Mismatches of two strings of one length; null where lengths differ."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(pairs, F.lit(0), lambda s, x: s + x))


def free_divergence_within_one(a: Column, b: Column) -> Column:
    """Whether one edit at most lets either string be used up, the other's rest being free.

    Lengths may differ by one. After a common prefix, what follows a mismatch, an extra letter
    left or one right must be a prefix of the other side's rest.
    """

    def prefixes(x: Column, y: Column) -> Column:
        return F.startswith(x, y) | F.startswith(y, x)

    def after(k: Column) -> Column:
        rest = [F.substr(s, k + 1) for s in (a, b)]
        tail = [F.substr(s, k + 2) for s in (a, b)]
        same = F.substr(a, F.lit(1), k) == F.substr(b, F.lit(1), k)
        used = (F.length(a) == k) | (F.length(b) == k)
        return same & (used | prefixes(tail[0], tail[1]) | prefixes(tail[0], rest[1]) | prefixes(rest[0], tail[1]))

    upto = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    return (F.abs(F.length(a) - F.length(b)) <= 1) & F.exists(upto, after)


def deletions(seq: Column, most: int) -> Column:
    """The string and all that up to ``most`` single deletions make of it, each once."""
    out = F.array(seq)
    for _ in range(most):
        cut = F.flatten(F.transform(out, lambda s: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
            lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)),
        )))
        out = F.array_union(out, cut)
    return out


def free_divergence(a: Column, b: Column, most: int) -> Column:
    """The fewest edits that let either string be used up, the other's rest being free; -1 if
    more than ``most`` or if lengths differ by more than that."""

    def upto(x: Column, y: Column) -> list[Column]:
        # a prefix that much shorter than lengths allow needs more edits than ``most``
        return [F.levenshtein(x, F.substr(y, F.lit(1), F.length(y) - i), most) for i in range(2 * most + 1)]

    every = [F.when(d >= 0, d) for d in upto(a, b) + upto(b, a)]
    return F.when(F.abs(F.length(a) - F.length(b)) <= most, F.coalesce(F.least(*every), F.lit(-1))).otherwise(-1)


def divergence_keys(seq: Column, most: int = 1) -> Column:
    """Keys of which two strings within ``most`` free-divergence edits share one at least.

    For one edit, deletions and their prefixes by a letter; for more, deletions of all prefixes
    that could be the part of a string which the other uses up.
    """
    if most == 1:
        shorter = deletions(seq, 1)
        return F.array_union(shorter, F.transform(shorter, lambda d: F.substr(d, F.lit(1), F.length(d) - 1)))
    return F.array_distinct(F.concat(*(deletions(F.substr(seq, F.lit(1), F.length(seq) - i), most) for i in range(2 * most + 1))))


def without_positions(name: Column, positions: list[int]) -> Column:
    """The name without the characters at these 0-based places, so that mates get one name."""
    parts, start = [], 0
    for p in sorted(positions):
        parts.append(F.substr(name, F.lit(start + 1), F.lit(p - start)))
        start = p + 1
    return F.concat(*parts, F.substr(name, F.lit(start + 1)))


def features(gx: Column, gn: Column) -> Column:
    """Array of (gx, gn) from ``;``-separated lists, as long as the shorter; empty if either is null."""
    left, right = F.split(gx, ";"), F.split(gn, ";")
    n = F.least(F.size(left), F.size(right))
    pairs = "array<struct<gx:string,gn:string>>"
    return F.coalesce(F.slice(F.arrays_zip(left, right).cast(pairs), F.lit(1), n), F.array().cast(pairs))
