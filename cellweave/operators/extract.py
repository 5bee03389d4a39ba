"""Barcodes and UMIs out of reads: alignment to the layout, decoding, realignment, tags, trimming.

Alignment runs in Arrow batches; barcodes are decoded by joins on the distinct raw ones, so a
whitelist is never held by a task, and everything else is built-in expressions.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.alignment import PREFIX, align, banded, boundaries, encoded, upright, widened
from cellweave.functions.sequences import reverse_complement
from cellweave.operators.reads import decode
from cellweave.operators.skew import split_join
from cellweave.session import written
from cellweave.sources.files import read_text

BATCH = 2000
#: Bytes of reads that one task aligns, where reads are dealt out; the most such tasks for a core.
FEW, TASKS = 8 << 20, 32
#: More bytes than any table has: what the planner says of sources that do not tell their size.
UNKNOWN = 1 << 50
#: Raw pieces of one list, decoded, that are sent to every task, at most.
SENT = 1 << 17


@dataclass(frozen=True)
class Block:
    blocktype: str
    blockfunction: str
    sequence: tuple[str, ...] = ()
    length: int = 0
    maxerrors: int = 1

    @property
    def alternatives(self) -> tuple[str, ...]:
        if self.blocktype == "constantRegion":
            return self.sequence
        return ("N" * (len(self.sequence[0]) if self.blocktype == "barcodeList" else self.length),)


@dataclass(frozen=True)
class Layout:
    """Blocks of a read in order; two at least, barcodes of one list of one length."""

    blocks: tuple[Block, ...]

    def __post_init__(self) -> None:
        if len(self.blocks) < 2:
            raise ValueError("a layout has two blocks at least")
        for b in self.blocks:
            if b.blocktype not in ("constantRegion", "barcodeList", "randomBarcode"):
                raise ValueError(f"unknown block type {b.blocktype}")
            if b.blocktype == "barcodeList" and len({len(s) for s in b.sequence}) != 1:
                raise ValueError("barcodes of a list have one length")
            if not all(b.alternatives) or not b.alternatives:
                raise ValueError("a block is not empty")

    @classmethod
    def of(cls, struct: dict) -> Layout:
        return cls(tuple(Block(b["blocktype"], b["blockfunction"], tuple(b.get("sequence", ())), b.get("length", 0), b.get("maxerrors", 1)) for b in struct["blocks"]))

    @property
    def variants(self) -> list[tuple[str, ...]]:
        """Template pieces for each choice of constants, the last block's varying fastest."""
        return list(itertools.product(*(b.alternatives for b in self.blocks)))

    def places(self, *types: str) -> list[int]:
        return [i for i, b in enumerate(self.blocks) if b.blocktype in types]

    def distance(self, place: int) -> str:
        """Free divergence for the last list where what follows it has no fixed letters."""
        last = place == self.places("barcodeList")[-1]
        open_end = place == len(self.blocks) - 1 or self.blocks[place + 1].blocktype == "randomBarcode"
        return "freediv" if last and open_end else "levenshtein"


def read_config(path: str) -> dict:
    """A JSON configuration of any file system, gzipped or not."""
    return json.loads(read_text(path))


def _cut(read: str, bounds: list[int]) -> list[str]:
    return [read[a:b] for a, b in itertools.pairwise((0, *bounds))]


def _spread(reads: DataFrame) -> DataFrame:
    """``reads`` dealt over tasks of few bytes each where the planner knows how many bytes they are; others as they come.

    A small file of columns may hold very many reads, which aligning takes far longer than dealing them out.
    """
    cores = reads.sparkSession.sparkContext.defaultParallelism
    known = int(reads._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return reads.repartition(min(max(2 * cores, known // FEW), TASKS * cores)) if known < UNKNOWN else reads


def aligned(reads: DataFrame, layout: Layout, either_strand: bool = False, seq: str = "seq") -> DataFrame:
    """``reads`` with ``oriented``, ``score``, ``aligned``, ``variant``, ``pieces`` and ``end_pos``.

    The best variant's alignment wins, ties by pieces, then end; ``variant`` is the first of the
    best score. The other strand is taken only for a better score. A read whose boundaries are
    undefined has ``aligned`` false and null pieces; a null read counts as empty.
    """
    strands = [F.coalesce(seq, F.lit(""))] + ([reverse_complement(F.coalesce(seq, F.lit("")))] if either_strand else [])
    prepared = _spread(reads).select(*reads.columns, F.array(*strands).alias("_strands"))
    variants, sides = layout.variants, len(strands)
    ends = [list(itertools.accumulate(map(len, pieces))) for pieces in variants]

    def best(strands: list[list[str]]) -> list[list]:
        """Of each read: text of its strand, score, aligned, variant, pieces, end.

        Ways without a gap come first. Only reads of which a way with gaps may reach the best score so found
        are aligned near the diagonal, first to the variants that may score most; the whole matrix is for
        those alone that may yet reach the best.
        """
        rows, tried = len(strands[0]), []
        for texts in strands:
            letters, lengths = encoded(texts, max(int(PREFIX * e[-1]) for e in ends))
            for pieces in variants:
                template = np.frombuffer("".join(pieces).encode(), np.uint8)
                most = int(PREFIX * len(template))
                given = np.repeat(template[None], rows, 0), letters[:, :most], np.minimum(lengths, most)
                tried.append((len(template), given, np.repeat(np.arange(1, len(template) + 1)[None], rows, 0)))
        plain = [upright(*given) for _, given, _ in tried]
        scores, bounds = np.array([s for s, _ in plain]), np.array([m for _, m in plain])
        sizes = np.array([size for size, _, _ in tried])[:, None]
        may, waiting = bounds / 10 / sizes, scores <= bounds
        for first in (True, False):
            now = waiting & (may >= (scores / 10 / sizes).max(axis=0)) & ((may == may.max(axis=0)) | (not first))
            for k, (_, given, paths) in enumerate(tried):
                if len(at := np.flatnonzero(now[k])):
                    near = banded(*(x[at] for x in given))
                    scores[k, at], paths[at] = near[:2]
                    bounds[k, at] = np.minimum(bounds[k, at], near[2])
            waiting &= ~now
            far = now if first else far | now
        least = (scores / 10 / sizes).max(axis=0)
        for k, (size, given, paths) in enumerate(tried):
            wanted = far[k] & (bounds[k] / 10 / size >= least) & (scores[k] <= bounds[k])
            if wanted.any():
                widened(*given, scores[k], paths, wanted)
        per = (scores / 10 / sizes).reshape(len(strands), len(variants), rows)
        strand = per.max(axis=1).argmax(axis=0)  # the first of those that score alike
        own = per[strand, :, np.arange(rows)]
        score = own.max(axis=1)
        first, ties = own.argmax(axis=1), (own == score[:, None]).sum(axis=1)
        texts = [strands[s][r] for r, s in enumerate(strand.tolist())]
        won: list = [None] * rows
        alike = own == score[:, None]
        for k, (_, _, paths) in enumerate(tried):
            s, v = divmod(k, len(variants))
            at = np.flatnonzero((strand == s) & alike[:, v])
            if not len(at):
                continue
            cuts, ok = boundaries(paths[at], ends[v])
            for r, bound, good, n in zip(at.tolist(), cuts.tolist(), ok.tolist(), ties[at].tolist(), strict=True):
                if good and (n == 1 or won[r] is None or (_cut(texts[r], bound), bound[-1]) > won[r]):
                    won[r] = _cut(texts[r], bound), bound[-1]
        return [texts, score, [w is not None for w in won], first, [w and w[0] for w in won], [w and w[1] for w in won]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH):
                batch = whole.slice(low, BATCH)
                flat = batch.column(batch.num_columns - 1).flatten().to_pylist()
                columns = best([flat[i::sides] for i in range(sides)])
                types = pa.string(), pa.float64(), pa.bool_(), pa.int32(), pa.list_(pa.string()), pa.int32()
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                    names=[*batch.schema.names[:-1], "oriented", "score", "aligned", "variant", "pieces", "end_pos"],
                )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reads.schema)
    return prepared.mapInArrow(run, f"{kept}, oriented string, score double, aligned boolean, variant int, pieces array<string>, end_pos int")


def _decoded(rows: DataFrame, layout: Layout) -> DataFrame:
    """``rows`` (written, with ``_id`` and ``pieces``) with a column d<place> for each list block.

    Decoded pieces that are few are sent to the reads. To others only ids and raw pieces are moved; a
    piece that many reads have is dealt over several tasks, and whole reads are moved once, by their ids.
    """
    lists = layout.places("barcodeList")
    named = rows.where("aligned").select("_id", *(F.col("pieces")[i].alias(f"p{i}") for i in lists))
    moved = False
    for i in lists:
        block = layout.blocks[i]
        listed = rows.sparkSession.createDataFrame([(s,) for s in block.sequence], "barcode string")
        raws = written(named.groupBy(F.col(f"p{i}").alias("raw")).agg(F.count("*").alias("n")).where("raw IS NOT NULL"), "raws")
        found = decode(raws, listed, block.maxerrors, layout.distance(i)).join(raws, "raw")
        found = written(found.select(F.col("raw").alias(f"p{i}"), F.col("decoded").alias(f"d{i}"), "n"), "decoded")
        if found.count() <= SENT:
            sent = F.broadcast(found.drop("n"))
            rows = rows.withColumn(f"p{i}", F.when(F.col("aligned"), F.col("pieces")[i])).join(sent, f"p{i}", "left").drop(f"p{i}")
        else:
            named, moved = split_join(named, found, [f"p{i}"], "n").drop("n"), True
    return rows.join(named.drop(*(f"p{i}" for i in lists)), "_id", "left") if moved else rows


def _realigned(rows: DataFrame, layout: Layout) -> DataFrame:
    """``rows`` with ``final``: pieces by a template of the decoded barcodes and chosen constants.

    Null where ``_whole`` is false or the boundaries are undefined.
    """
    variants, lists = layout.variants, layout.places("barcodeList")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH):
                batch = whole.slice(low, BATCH)
                texts = batch.column("oriented").to_pylist()
                chosen = np.where(batch.column("_whole").to_numpy(zero_copy_only=False), batch.column("variant").to_numpy(zero_copy_only=False), -1)
                decoded = [batch.column(f"d{i}").to_pylist() for i in lists]
                out: list = [None] * len(texts)
                for k in np.unique(chosen[chosen >= 0]).astype(int):
                    at = np.flatnonzero(chosen == k).tolist()
                    pieces, ends = variants[k], list(itertools.accumulate(map(len, variants[k])))
                    made = np.repeat(np.frombuffer("".join(pieces).encode(), np.uint8)[None], len(at), 0)
                    for i, words in zip(lists, decoded, strict=True):
                        made[:, ends[i] - len(pieces[i]) : ends[i]] = encoded([words[r] for r in at])[0]
                    letters, lengths = encoded([texts[r] for r in at], int(PREFIX * ends[-1]))
                    bounds, ok = boundaries(align(made, letters, lengths)[1], ends)
                    for r, bound, good in zip(at, bounds.tolist(), ok.tolist(), strict=True):
                        out[r] = _cut(texts[r], bound) if good else None
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.string()))], names=[*batch.schema.names, "final"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kept}, final array<string>")


def extract(reads: DataFrame, layout: Layout, either_strand: bool = False) -> DataFrame:
    """``reads`` (seq and any columns) with score, cb, cr, fl, ur, end_pos and trimmed.

    Reads that cannot be aligned or decoded have null tags; they stay, since thresholds are
    taken over all scores. ``cb`` and ``cr`` dot-join the barcodes, ``ur`` the UMIs, ``fl`` adds
    the lengths of the template's constants; blocks to discard take no part in any.
    """
    rows = written(aligned(reads, layout, either_strand).withColumn("_id", F.monotonically_increasing_id()), "aligned")
    lists, random = layout.places("barcodeList"), layout.places("randomBarcode")
    rows = _decoded(rows, layout) if lists else rows
    decoded = F.col("aligned")
    for i in lists:
        decoded = decoded & F.col(f"d{i}").isNotNull()
    if random:
        rows = _realigned(rows.withColumn("_whole", decoded), layout)
        decoded = F.col("_whole") & F.col("final").isNotNull()
    used = [i for i, b in enumerate(layout.blocks) if b.blockfunction != "discard"]
    cells = [i for i in used if i in lists or (i in random and layout.blocks[i].blockfunction != "UMI")]
    umis = [i for i in used if layout.blocks[i].blockfunction == "UMI" and i in lists + random]
    right = lambda i: F.col("final")[i] if i in random else F.col(f"d{i}")
    raw = lambda i: F.col("final")[i] if i in random else F.col("pieces")[i]
    cells = [i for i in cells if i not in umis]
    linker = F.lit(0)
    for i in (i for i in used if layout.blocks[i].blocktype == "constantRegion"):
        linker = linker + F.array(*(F.lit(len(v[i])) for v in layout.variants))[F.col("variant")]
    tags = {"cb": [right(i) for i in cells], "cr": [raw(i) for i in cells], "ur": [raw(i) for i in umis]}
    named = [F.when(decoded, F.concat_ws(".", *parts)).alias(n) if parts else F.lit(None).cast("string").alias(n) for n, parts in tags.items()]
    trimmed = F.when(decoded, F.substr("oriented", F.col("end_pos") + 1)).alias("trimmed")
    return rows.select(*reads.columns, "score", *named, F.when(decoded, linker).alias("fl"), F.when(decoded, F.col("end_pos")).alias("end_pos"), trimmed)
