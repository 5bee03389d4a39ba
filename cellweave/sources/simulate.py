"""Reads with known barcodes, as column expressions.

Every draw is the digest of the seed and of what is drawn, so any task, and any other engine
that knows the digest, draws the same. A block's errors are one edit script over its letters:
each letter, by draws of its own, stays, is exchanged, gets a letter before it, or goes.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.sequences import reverse_complement
from cellweave.operators.extract import Block, Layout
from cellweave.session import prepare

LETTERS = "ATGC"
#: Mean number of letters after the barcodes. Fixed value.
TAIL = 20
#: Draws are whole numbers under this.
DRAWS = 1 << 32


def _digest(*parts: Column | str | int) -> Column:
    return F.md5(F.concat_ws(".", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts)))


def draw(*parts: Column | str | int) -> Column:
    """A whole number from 0 to ``DRAWS`` - 1: the first eight digits of the parts' digest."""
    return F.conv(F.substring(_digest(*parts), 1, 8), 16, 10).cast("long")


def letters(most: int, *parts: Column | str | int) -> Column:
    """``most`` letters."""
    digits = F.concat(*(_digest(*parts, k) for k in range(-(-most // 32)))) if most else F.lit("")
    return F.translate(F.substring(digits, 1, most), "0123456789abcdef", LETTERS * 4)


def mutated(text: Column, most: int, error: float, substitution: float, insertion: float, *parts: Column | str | int) -> Column:
    """``text`` after its edit script: errors at each letter by chance, or at ``most`` letters (all, if it
    has fewer) where ``error`` is not positive."""
    spelt = F.filter(F.split(text, ""), lambda c: c != "")
    chance = lambda p: int(min(max(p, 0), 1) * DRAWS)
    if error > 0:
        hit = lambda i: draw(*parts, i, "e") < chance(error)
    else:
        ranked = F.array_sort(F.transform(spelt, lambda c, i: F.struct(draw(*parts, i, "r").alias("r"), i.alias("i"))))
        chosen = F.transform(F.slice(ranked, 1, most), lambda x: x["i"]) if most > 0 else F.array().cast("array<int>")
        hit = lambda i: F.array_contains(chosen, i)

    def script(c: Column, i: Column) -> Column:
        place = F.instr(F.lit(LETTERS), c)
        other = F.substr(F.lit(LETTERS * 2), (place + 1 + draw(*parts, i, "s") % 3).cast("int"), F.lit(1))
        more = F.concat(F.substr(F.lit(LETTERS), (1 + draw(*parts, i, "l") % 4).cast("int"), F.lit(1)), c)
        change = F.when(draw(*parts, i, "k") < chance(substitution), other).when(draw(*parts, i, "n") < chance(insertion), more).otherwise("")
        return F.when(hit(i), change).otherwise(c)

    return F.array_join(F.transform(spelt, script), "")


def _tail(*parts: Column | str | int) -> Column:
    """Letters, a Poisson number of them: as many as there are sums of its chances under the draw."""
    sums, term = [], math.exp(-TAIL)
    for k in range(4 * TAIL):
        sums.append((sums[-1] if sums else 0.0) + term)
        term *= TAIL / (k + 1)
    size = F.size(F.filter(F.array(*(F.lit(int(s * DRAWS)) for s in sums)), lambda s: s <= draw(*parts, "size")))
    return F.substr(letters(4 * TAIL, *parts, "tail"), F.lit(1), size)


def label(block: Block, names: list[str], seed: int, row: Column, mate: int, place: int, pool: int) -> tuple[Column, Column]:
    """A block's name in the read's name, and its letters before errors."""
    if block.blocktype == "randomBarcode":
        of = F.when(row < pool, row).otherwise(draw(seed, row, mate, place, "of") % max(pool, 1))
        made = letters(block.length, seed, of, mate, place)
        return made, made
    which = draw(seed, row, mate, place, "which") % len(block.sequence)
    return tuple(F.array(*map(F.lit, x))[which.cast("int")] for x in (names, block.sequence))  # type: ignore[return-value]


def reads_of(
    rows: DataFrame, structs: list[dict], n: int, either_strand: bool = False, unique: float = 0.5, seed: int = 42,
    error: float = 0.1, substitution: float = 0.7, insertion: float = 0.5,
) -> DataFrame:
    """(rec_idx, mate, read_id, description, seq, qual): a read of each struct for each row's ``rec_idx``, of ``n`` from 0 on.

    Rows up to ``unique * n`` draw new UMIs; later ones copy one of those with errors. The name
    holds the row and the true block names. With ``either_strand`` half of all rows' reads are turned.
    """
    pool, row, sides = min(int(unique * n) + 1, n), F.col("rec_idx"), []
    for mate, struct in enumerate(structs):
        made, named = [], [row.cast("string")]
        for place, (block, given) in enumerate(zip(Layout.of(struct).blocks, struct["blocks"], strict=True)):
            name, text = label(block, given.get("name") or given.get("sequence", []), seed, row, mate, place, pool)
            changed = mutated(text, block.maxerrors, error, substitution, insertion, seed, row, mate, place)
            named.append(name)
            made.append(F.when(row < pool, text).otherwise(changed) if block.blocktype == "randomBarcode" else changed)
        sides.append(rows.select("rec_idx", F.lit(mate + 1).alias("mate"), F.concat_ws("_", *named).alias("read_id"), F.concat(*made, _tail(seed, row, mate)).alias("seq")))
    reads = reduce(DataFrame.unionByName, sides)
    if either_strand:
        reads = reads.withColumn("seq", F.when(draw(seed, row, "turned") % 2 == 1, reverse_complement(F.col("seq"))).otherwise(F.col("seq")))
    return reads.select("rec_idx", "mate", "read_id", F.col("read_id").alias("description"), "seq", F.repeat(F.lit("E"), F.length("seq")).alias("qual"))


def simulated(spark: SparkSession, structs: list[dict], n: int, *rest, **named) -> DataFrame:  # type: ignore[no-untyped-def]
    """:func:`reads_of` for rows 0 to ``n`` - 1."""
    return reads_of(prepare(spark).range(n).withColumnRenamed("id", "rec_idx"), structs, n, *rest, **named)
