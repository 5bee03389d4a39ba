"""Alignments from SAM text or BAM files, and back to either in coordinate order.

BAM files are shares of bytes, which tasks open by themselves: each finds the first record of its
share by its form, and makes sure that the share after it begins where its own ends. Of a file
with an index, and of a folder whose manifest tells which places each part holds, a region is
read without opening the rest. ``align_ordinal`` orders records as the files
are given and as they hold them.
"""

from __future__ import annotations

import io
import json
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from cellweave.session import prepare
from cellweave.sources import bam, bgzf
from cellweave.sources.files import exists, located, opened, read_text, write_text

#: Bits of a record's flag. Fixed values.
PAIRED, UNMAPPED, MATE_UNMAPPED, REVERSE, READ1, READ2 = 0x1, 0x4, 0x8, 0x10, 0x40, 0x80
TAGS = ("gx", "gn", "cb", "cr", "ur", "ub", "fl")
#: Compressed bytes of a share of a file.
SHARE = 64 << 20
#: In a written folder: what its parts are, once all are there; and where they lie until then.
MANIFEST, STAGED = "_MANIFEST", "_staged"
FAR = 1 << 62


def _tag(name: str) -> Column:
    # two letters, a type's letter and two colons come before the value
    return F.substr(F.get(F.filter("tags", lambda t: F.startswith(t, F.lit(f"{name.upper()}:"))), F.lit(0)), F.lit(6))


def _typed(rows: DataFrame, unmapped: bool) -> DataFrame:
    """Records with flags and tags as columns; a missing tag is null, what other tags there are stay in ``tags``."""
    bit = lambda b: F.col("flag").bitwiseAND(b) != 0
    flags = {"is_paired": bit(PAIRED), "is_read1": bit(READ1), "is_read2": bit(READ2), "mate_is_unmapped": bit(MATE_UNMAPPED), "is_reverse": bit(REVERSE)}
    kept = rows if unmapped else rows.where(~bit(UNMAPPED) & (F.col("ref") != "*"))
    found = kept.withColumns(flags | {n: _tag(n) for n in TAGS})
    known = [n.upper() for n in TAGS]
    return found.withColumns({"fl": F.col("fl").cast("int"), "tags": F.filter("tags", lambda t: ~F.substr(t, F.lit(1), F.lit(2)).isin(known))})


def read_sam(spark: SparkSession, path: str | list[str], unmapped: bool = False) -> DataFrame:
    """Mapped records (all, if ``unmapped``) of SAM text; files are split, and parsing is built-in expressions only.

    ``path_no`` tells which of the given paths a record is from; order among paths is as given,
    within a path by file name.
    """
    part = F.split("value", "\t")
    field = lambda i: F.get(part, F.lit(i))
    columns = {n: field(i) for n, i in {"query_name": 0, "ref": 2, "cigar": 5, "seq": 9, "qual": 10}.items()}
    columns |= {n: field(i).cast("int") for n, i in {"flag": 1, "mapq": 4, "template_length": 8}.items()}
    columns |= {"pos": field(3).cast("long") - 1, "mate_pos": field(7).cast("long") - 1, "mate_ref": F.when(field(6) == "=", field(2)).otherwise(field(6))}
    columns["tags"] = F.slice(part, F.lit(12), F.greatest(F.size(part) - 11, F.lit(0)))
    found = None
    for number, one in enumerate([path] if isinstance(path, str) else path):
        # lines of one block of a file keep their order in a task
        place = F.struct(F.lit(number).alias("path"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
        lines = spark.read.text(one).select("value", place.alias("align_ordinal"), F.lit(number).alias("path_no"))
        found = lines if found is None else found.unionByName(lines)
    if found is None:
        raise ValueError("no alignments")
    lines = found.where("value <> '' AND NOT value RLIKE '^@[A-Za-z][A-Za-z]\t'")
    return _typed(lines.select(*(columns[n].alias(n) for n in bam.SCHEMA.names), "align_ordinal", "path_no"), unmapped)


# ---------------------------------------------------------------- BAM

_PLACE = pa.struct([("path", pa.int32()), ("file", pa.int32()), ("place", pa.int64())])
_READ = pa.schema([*bam.SCHEMA, ("align_ordinal", _PLACE), ("path_no", pa.int32())])


@dataclass(frozen=True)
class Region:
    """Names of references (None: all) and places from ``begin`` up to ``end``."""

    refs: tuple[str, ...] | None = None
    begin: int = 0
    end: int = FAR

    @property
    def whole(self) -> bool:
        return self.refs is None and self.begin <= 0 and self.end >= FAR

    def may_hold(self, spans: list | None) -> bool:
        """Whether a part that holds [reference, first place, last place] for each of its references may have a match.

        Records without a place (-1) are in no region, but in the whole.
        """
        return self.whole or spans is None or any((self.refs is None or r in self.refs) and low < self.end and high >= self.begin for r, low, high in spans)


@dataclass(frozen=True)
class BamFile:
    path: str
    size: int
    path_no: int
    file_no: int
    indexed: bool = False
    spans: list | None = None


def _info(path: str) -> tuple[int, bool]:
    store, name = located(path)
    file, index = store.get_file_info([name, f"{name}.bai"])
    if not file.is_file:
        raise FileNotFoundError(path)
    return file.size, index.is_file


def bam_files(paths: list[str]) -> list[BamFile]:
    """The files of ``paths``, by listing alone. A folder that a killed run left unfinished is an error."""
    out = []
    for number, path in enumerate(paths):
        store, name = located(path)
        if not exists(path) or store.get_file_info(name).is_file:
            size, indexed = _info(path)
            out.append(BamFile(path, size, number, 0, indexed))
            continue
        scheme = path.split("://")[0] + "://" if "://" in path else ""
        listed = {i.base_name: i for i in store.get_file_info(pa.fs.FileSelector(name))}
        if MANIFEST in listed:
            parts = json.loads(read_text(f"{path}/{MANIFEST}"))["parts"]
            out += [BamFile(f"{scheme}{listed[p['name']].path}", listed[p["name"]].size, number, k, f"{p['name']}.bai" in listed, p["spans"]) for k, p in enumerate(parts)]
        elif STAGED in listed:
            raise ValueError(f"{path} is unfinished")
        else:
            named = sorted(n for n in listed if n.endswith(".bam"))
            out += [BamFile(f"{scheme}{listed[n].path}", listed[n].size, number, k, f"{n}.bai" in listed) for k, n in enumerate(named)]
    return out


class _Share(InputPartition):
    pass


class BamReader(DataSourceReader):
    """A share for every ``share`` bytes of a file; what a region rules out is not planned, or not opened."""

    def __init__(self, files: list[list], share: int, region: Region):
        self.files, self.share, self.region = [BamFile(*f) for f in files], share, region

    def partitions(self) -> list[InputPartition]:
        # a reader has to have a partition
        kept = [f for f in self.files if self.region.may_hold(f.spans)]
        return [_Share((f, at)) for f in kept for at in range(0, max(f.size, 1), self.share)] or [_Share(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            yield from share_of(*partition.value, self.share, self.region)


def _batch(columns: list[pa.Array], file: BamFile, places: np.ndarray) -> pa.RecordBatch:
    same = lambda x: pa.array(np.full(len(places), x, np.int32))
    place = pa.StructArray.from_arrays([same(file.path_no), same(file.file_no), pa.array(places, pa.int64())], fields=list(_PLACE))
    return pa.RecordBatch.from_arrays([*columns, place, same(file.path_no)], schema=_READ)


def share_of(file: BamFile, at: int, share: int, region: Region) -> Iterator[pa.RecordBatch]:
    """Records that begin in the blocks of bytes ``at`` to ``at + share`` of a file, as far as a region may hold them.

    A file that is gzipped in another way than in blocks is read as a whole by its first share.
    """
    store, name = located(file.path)
    with store.open_input_file(name) as f:
        raw = io.BufferedReader(f, 1 << 20)
        if not bgzf.block_size(raw.peek(64)[:64]):
            if at == 0:
                yield from _unblocked(file)
            return
        with opened(file.path) as stream:
            refs, left = bam.header(stream)
        names = pa.array([n for n, _ in refs] + ["*"], pa.string())
        begin, end = bgzf.first_block(raw, at, file.size) if at else 0, bgzf.first_block(raw, at + share, file.size)
        if begin >= min(end, file.size):
            return
        last = end == file.size
        if file.indexed and not region.whole:
            with opened(f"{file.path}.bai") as stream:
                index = stream.read()
            wanted = [n for n, _ in refs] if region.refs is None else region.refs
            numbers = [k for k, (n, _) in enumerate(refs) if n in wanted]
            for low, high in sorted(c for k in numbers for c in bam.chunks_of(index, k, max(region.begin, 0), region.end)):
                low, high = max(low, begin << 16), min(high, bgzf.END if last else end << 16)
                # a chunk that reaches in from the share before begins with a record of that share
                if low < high:
                    found = bam.Records(raw, low >> 16, high, len(refs), -1 if low == begin << 16 and at else low & 0xFFFF)
                    for data, start, size, places in found:
                        yield _batch(bam.decoded(data, start, size, names), file, places)
            return
        inner = -1
        if at == 0:
            window = bgzf.Window(raw, 0)
            window.has(left + 1)
            place = window.place(left)
            if place == bgzf.END or place >> 16 >= end:
                return
            begin, inner = place >> 16, place & 0xFFFF
        found = bam.Records(raw, begin, bgzf.END if last else end << 16, len(refs), inner)
        if found.begin == bgzf.END or (not last and found.begin >> 16 >= end):
            return
        for data, start, size, places in found:
            yield _batch(bam.decoded(data, start, size, names), file, places)
        if not last and (next_ := bam.Records(raw, end, bgzf.END, len(refs)).begin) != found.after:
            raise ValueError(f"{file.path}: a share ends at {found.after}, the next one begins at {next_}; read the file with a share as large as the file")


def _unblocked(file: BamFile) -> Iterator[pa.RecordBatch]:
    with opened(file.path) as stream:
        refs, _ = bam.header(stream)
        names = pa.array([n for n, _ in refs] + ["*"], pa.string())
        number, data, starts, sizes = 0, bytearray(), [], []
        while True:
            head = stream.read(4)
            if starts and (not head or len(data) >= bam.CHUNK):
                yield _batch(bam.decoded(bytes(data), np.array(starts), np.array(sizes), names), file, np.arange(number, number + len(starts)))
                number, data, starts, sizes = number + len(starts), bytearray(), [], []
            if not head:
                return
            (n,) = struct.unpack("<i", head)
            starts.append(len(data))
            sizes.append(n)
            data += stream.read(n)
            if len(data) != starts[-1] + n:
                raise ValueError("the file ends inside a record")


def header_text(references: list[tuple[str, int]]) -> str:
    return "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{x}\n" for n, x in references)


@dataclass
class _Wrote(WriterCommitMessage):
    path: str
    number: int
    spans: list


class _BamWriter(DataSourceArrowWriter):
    """A whole file with its index for each task, staged; files are named, and the manifest written, once every task is done."""

    def __init__(self, folder: str, references: list) -> None:
        self.folder, self.references = folder, references

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        text = header_text(self.references).encode()
        head = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.references))
        for name, length in self.references:
            head += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
        refs = [n for n, _ in self.references]
        store, folder = located(self.folder)
        number = TaskContext.get().partitionId()
        path = f"{folder}/{STAGED}/{number:05d}-{uuid.uuid4().hex}.bam"
        spans: dict[int, list[int]] = {}
        with store.open_output_stream(path, compression=None) as out:
            made = _Blocks(out, bam.Index(len(refs)), head)
            for batch in iterator:
                for low in range(0, batch.num_rows, 2000):
                    data, begin, ref, pos, end = bam.encoded(batch.slice(low, 2000), refs)
                    made.add(data, begin, ref, pos, end)
                    for r in np.unique(ref):
                        own = ref == r
                        known = spans.setdefault(int(r), [int(pos[own].min()), -1])
                        known[:] = [min(known[0], int(pos[own].min())), max(known[1], int(pos[own].max()))]
            index = made.close()
        if index is not None:
            with store.open_output_stream(f"{path}.bai", compression=None) as out:
                out.write(index)
        return _Wrote(path, number, [[refs[r] if r >= 0 else "*", *s] for r, s in sorted(spans.items())])

    def commit(self, messages: list) -> None:
        store, folder = located(self.folder)
        parts = []
        for i, m in enumerate(sorted(messages, key=lambda m: m.number)):
            name = f"part-{i:05d}.bam"
            for ending in ("", ".bai"):
                if store.get_file_info(m.path + ending).is_file:
                    store.move(m.path + ending, f"{folder}/{name}{ending}")
            parts.append({"name": name, "spans": m.spans})
        write_text(f"{self.folder}/{MANIFEST}", json.dumps({"parts": parts}))
        store.delete_dir(f"{folder}/{STAGED}")

    def abort(self, messages: list) -> None:
        store, _ = located(self.folder)
        for m in messages:
            for ending in ("", ".bai") if m is not None else ():
                if store.get_file_info(m.path + ending).is_file:
                    store.delete_file(m.path + ending)


class _Blocks:
    """Records cut into blocks, and the index of what is written."""

    def __init__(self, out, index: bam.Index, head: bytes):
        self.out, self.index, self.left, self.at, self.done = out, index, head, 0, 0
        self.begins, self.offsets = [], []  # of blocks that records not yet in the index may lie in
        self.waiting: list[list[np.ndarray]] = []

    def add(self, data: bytes, begin: np.ndarray, ref: np.ndarray, pos: np.ndarray, end: np.ndarray) -> None:
        first = self.done + len(self.left) + begin
        self.waiting.append([ref, pos, end, first, np.append(first[1:], self.done + len(self.left) + len(data))])
        self.left += data
        self._flush(False)

    def _flush(self, all_: bool) -> None:
        view, at = self.left, 0
        while len(view) - at >= bgzf.FULL or (all_ and at < len(view)):
            block = bgzf.compressed(view[at : at + bgzf.FULL])
            self.begins.append(self.done)
            self.offsets.append(self.at)
            self.out.write(block)
            self.at += len(block)
            self.done += min(bgzf.FULL, len(view) - at)
            at += bgzf.FULL
        self.left = view[at:]
        if all_:  # where the last record ends, the empty block begins
            self.begins.append(self.done)
            self.offsets.append(self.at)
        while self.waiting and (all_ or self.waiting[0][4][-1] < self.done):
            *fixed, first, after = self.waiting.pop(0)
            self.index.add(*fixed, self._places(first), self._places(after))
            keep = int(np.searchsorted(self.begins, after[-1], "right")) - 1
            del self.begins[:keep], self.offsets[:keep]

    def _places(self, at: np.ndarray) -> np.ndarray:
        block = np.searchsorted(self.begins, at, "right") - 1
        return (np.array(self.offsets, np.int64)[block] << 16) + at - np.array(self.begins, np.int64)[block]

    def close(self) -> bytes | None:
        """Ends the file; the index, if the format can hold it."""
        self._flush(True)
        self.out.write(bgzf.compressed(b""))
        return self.index.written() if self.index.fits else None


class BamSource(DataSource):
    """``files``: a JSON list of what :class:`BamFile` takes; ``share``: bytes of a share; ``region``: what is to be read. Writing: ``path``, ``references``."""

    @classmethod
    def name(cls) -> str:
        return "cellweave_bam"

    def schema(self) -> str:
        return bam.DDL + (", align_ordinal struct<path:int,file:int,place:long>, path_no int" if "files" in self.options else "")

    def reader(self, schema) -> BamReader:
        refs, begin, end = json.loads(self.options["region"])
        return BamReader(json.loads(self.options["files"]), int(self.options["share"]), Region(None if refs is None else tuple(refs), begin, end))

    def writer(self, schema, overwrite: bool) -> _BamWriter:
        return _BamWriter(self.options["path"], json.loads(self.options["references"]))


def read_bam(spark: SparkSession, paths: list[str], share: int = SHARE, unmapped: bool = False, region: Region | None = None) -> DataFrame:
    """Mapped records (all, if ``unmapped``) of BAM files, or those that begin in ``region``, in the columns of :func:`read_sam`.

    A folder stands for the BAM files in it. ``path_no`` tells which of the given paths a record
    is from, and orders before files and places in them do. The driver sees names and sizes of files.
    """
    prepare(spark).dataSource.register(BamSource)
    region = region or Region()
    files = [[f.path, f.size, f.path_no, f.file_no, f.indexed, f.spans] for f in bam_files(paths)]
    asked = json.dumps([region.refs, region.begin, region.end])
    rows = spark.read.format("cellweave_bam").options(files=json.dumps(files), share=str(share), region=asked).load()
    if region.refs is not None:
        rows = rows.where(F.col("ref").isin(list(region.refs)))
    if not region.whole:
        rows = rows.where((F.col("pos") >= region.begin) & (F.col("pos") < region.end))
    return _typed(rows, unmapped)


def _all_tags(rows: DataFrame) -> Column:
    """Tags as ``NAME:type:value``: those with columns, null ones left out, then what else ``tags`` has."""
    own = [F.when(F.col(n).isNotNull(), F.concat(F.lit(f"{n.upper()}:{'i' if n == 'fl' else 'Z'}:"), F.col(n).cast("string"))) for n in TAGS if n in rows.columns]
    known = [n.upper() for n in TAGS if n in rows.columns]
    named = F.filter(F.array(*own), lambda t: t.isNotNull()) if own else F.array().cast("array<string>")
    if "tags" not in rows.columns:
        return named
    return F.concat(named, F.coalesce(F.filter("tags", lambda t: ~F.substr(t, F.lit(1), F.lit(2)).isin(known)), F.array().cast("array<string>")))


def _with_mates(rows: DataFrame) -> DataFrame:
    """``rows`` with the fields of mates that they lack, undefined."""
    given = {"mate_ref": F.lit("*"), "mate_pos": F.lit(-1).cast("long"), "template_length": F.lit(0)}
    return rows.withColumns({n: c for n, c in given.items() if n not in rows.columns})


def coordinate_sorted(rows: DataFrame) -> DataFrame:
    """Rows by reference, position, strand and their order before: ranges of them are what a task holds."""
    order = [c for c in ("ref", "pos", "is_reverse", "align_ordinal", "query_name", "flag") if c in rows.columns]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def write_bam(rows: DataFrame, folder: str, references: list[tuple[str, int]]) -> None:
    """``folder/part-*.bam`` in coordinate order, each a file of its own with the whole header and an index beside it.

    ``references``: name and length of each, in the order that sorts them too; records without a
    reference (``*``) come last. Mate fields and ``tags`` are written where ``rows`` have them, with
    their types. Files are staged until all are there, and ``_MANIFEST`` is written last: a run
    that was ended leaves nothing that :func:`read_bam` takes for a whole. An existing folder is an error.
    """
    spark = prepare(rows.sparkSession)
    spark.dataSource.register(BamSource)
    if exists(folder):
        raise FileExistsError(folder)
    store, name = located(folder)
    store.create_dir(f"{name}/{STAGED}", recursive=True)
    number = F.create_map(*(x for i, (n, _) in enumerate(references) for x in (F.lit(n), F.lit(i)))) if references else F.create_map().cast("map<string,int>")
    full = _with_mates(rows).withColumn("tags", _all_tags(rows))
    placed = full.withColumns({"_name": F.col("ref"), "ref": F.coalesce(F.try_element_at(number, "ref"), F.lit(len(references)))})
    ordered = coordinate_sorted(placed).drop("ref").withColumnRenamed("_name", "ref").select(*bam.SCHEMA.names)
    ordered.write.format("cellweave_bam").option("references", json.dumps(references)).mode("append").save(folder)


def write_sam(rows: DataFrame, folder: str, references: list[tuple[str, int]] | None = None) -> None:
    """SAM text in coordinate order, ranges of which are what a task writes.

    With ``references`` (name and length) the first part is the header. Mate fields and ``tags``
    are written where ``rows`` have them; whole numbers of any size get type ``i``, null tags are
    left out. An existing folder is an error.
    """
    text = lambda c: F.col(c).cast("string")
    full = _with_mates(rows)
    whole = F.transform(_all_tags(rows), lambda t: F.regexp_replace(t, "^(..):[cCsSI]:", "$1:i:"))
    line = F.concat_ws(
        "\t", "query_name", text("flag"), "ref", (F.col("pos") + 1).cast("string"), text("mapq"), "cigar", F.when((F.col("mate_ref") == F.col("ref")) & (F.col("ref") != "*"), F.lit("=")).otherwise(F.coalesce("mate_ref", F.lit("*"))),
        (F.coalesce("mate_pos", F.lit(-1)) + 1).cast("string"), F.coalesce(text("template_length"), F.lit("0")), "seq", "qual", F.array_join(whole, "\t"),
    )
    lines = coordinate_sorted(full).select(F.rtrim(line, F.lit("\t")).alias("value"))
    if references:
        head = rows.sparkSession.createDataFrame([(header_text(references).rstrip("\n"),)], "value string").coalesce(1)
        lines = head.unionByName(lines)
    lines.write.mode("errorifexists").text(folder)
