"""Reads from FASTQ files, and reads back into such files.

A read file is a file or a folder of parts. Files that are not gzipped, or gzipped in blocks, are
split by byte ranges, so one file is read by many tasks. Records are numbered by their place in
the file, which is what pairs mates: where a file has several shares, their records are counted
first. One mate, or first records, are read without opening what lies beyond them.
"""

from __future__ import annotations

import io
import itertools
import json
import sys
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cellweave.session import prepare
from cellweave.sources import bgzf
from cellweave.sources import files as names
from cellweave.sources.files import located, opened

SCHEMA = "file_pair int, mate int, rec_idx long, read_id string, description string, seq string, qual string"
_ARROW = pa.schema([("file_pair", pa.int32()), ("mate", pa.int32()), ("rec_idx", pa.int64()), *((n, pa.string()) for n in ("read_id", "description", "seq", "qual"))])
ROWS, BYTES = 2000, 8 << 20
#: Bytes of a share of a file.
SHARE = 64 << 20
#: Neighbouring shares are one task's up to so many bytes: what a task costs by itself is more than reading a small share.
RUN = 16 << 20
#: Records of a written part, at most; and so many record numbers for each record where numbers lie close.
PART, DENSE = 200_000, 4


def records(lines: BinaryIO) -> Iterator[tuple[str, str, str]]:
    """(title, letters, qualities); both may run over several lines. A broken record is an error."""
    title = ""
    for raw in lines:
        title = raw.decode().rstrip("\r\n")
        if not title:
            continue
        if not title.startswith("@"):
            raise ValueError(f"a record starts with @, not with {title[:40]!r}")
        letters: list[str] = []
        for raw in lines:
            line = raw.decode().rstrip("\r\n")
            if line.startswith("+"):
                break
            letters.append(line)
        else:
            raise ValueError(f"the file ends in record {title[:40]!r}")
        seq, qual = "".join(letters), ""
        while len(qual) < len(seq) and (raw := lines.readline()):
            qual += raw.decode().rstrip("\r\n")
        if len(qual) != len(seq):
            raise ValueError(f"letters and qualities differ in number in {title[:40]!r}")
        if not seq:
            lines.readline()
        yield title[1:], seq, qual


def _plain(lines: list[bytes]) -> bool:
    """Whether lines begin with a record of four lines."""
    cut = [x.rstrip(b"\r\n") for x in lines[:4]]
    return len(cut) == 4 and cut[0][:1] == b"@" and cut[2][:1] == b"+" and len(cut[1]) == len(cut[3])


def first_record(stream: BinaryIO, start: int) -> int:
    """Where the first record of four lines that begins at ``start`` or later begins.

    A quality line may begin with ``@`` too, but then the line two after it is letters.
    """
    stream.seek(max(0, start - 1))
    at = start
    if start:
        at += len(stream.readline()) - 1
    window: list[bytes] = []
    while True:
        while len(window) < 4 and (line := stream.readline()):
            window.append(line)
        if len(window) < 4:
            return at + sum(map(len, window))
        if _plain(window):
            return at
        at += len(window.pop(0))


def _in_range(stream: BinaryIO, start: int, end: int) -> Iterator[tuple[str, str, str]]:
    """Records that begin in [start, end)."""
    at, beyond = first_record(stream, start), first_record(stream, end)
    stream.seek(at)
    return records(io.BufferedReader(_Limited(stream, beyond - at), max(1, min(beyond - at, 1 << 20))))


class _Limited(io.RawIOBase):
    """The next ``size`` bytes of a stream."""

    def __init__(self, stream: BinaryIO, size: int) -> None:
        self.stream, self.left = stream, size

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:  # type: ignore[override]
        data = self.stream.read(min(len(buffer), self.left))
        buffer[: len(data)] = data
        self.left -= len(data)
        return len(data)


class _Blocks(io.RawIOBase):
    """What the blocks from one at ``start`` on hold, read forward; ``place`` is where the next byte lies."""

    def __init__(self, raw: io.BufferedReader, start: int) -> None:
        self._blocks, self._data, self._at, self._offset = bgzf.blocks(raw, start), b"", 0, start

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:  # type: ignore[override]
        if not self._fill():
            return 0
        n = min(len(buffer), len(self._data) - self._at)
        buffer[:n] = self._data[self._at : self._at + n]
        self._at += n
        return n

    def _fill(self) -> bool:
        while self._at == len(self._data):
            found = next(self._blocks, None)
            if found is None:
                return False
            (self._offset, self._data), self._at = found, 0
        return True

    def line(self) -> bytes:
        """The next line with its end."""
        out = b""
        while self._fill():
            end = self._data.find(b"\n", self._at) + 1 or len(self._data)
            out, self._at = out + self._data[self._at : end], end
            if out.endswith(b"\n"):
                break
        return out

    @property
    def place(self) -> int:
        return (self._offset << 16) + self._at if self._fill() else bgzf.END


def _first_of_blocks(raw: io.BufferedReader, start: int, size: int) -> int:
    """Virtual offset of the first record that begins after the first line end in the blocks from ``start`` on.

    Where a line begins is known only behind a line's end, so a record at the very beginning of
    the blocks belongs to the share before. At the file's own start it is the first record.
    """
    if start >= size:
        return bgzf.END
    stream = _Blocks(raw, start)
    if start:
        stream.line()
    places, window = [stream.place], []
    while True:
        while len(window) < 4 and (line := stream.line()):
            window.append(line)
            places.append(stream.place)
        if len(window) < 4:
            return bgzf.END
        if _plain(window):
            return places[0]
        window.pop(0)
        places.pop(0)


def _in_blocks(raw: io.BufferedReader, start: int, end: int, size: int) -> Iterator[tuple[str, str, str]]:
    """Records of a file of blocks that belong to the bytes [start, end)."""
    first, beyond = (bgzf.first_block(raw, at, size) if at else 0 for at in (start, end))
    if first >= beyond:
        return
    at, stop = _first_of_blocks(raw, first, size), _first_of_blocks(raw, beyond, size)
    if at >= stop:
        return
    stream = _Blocks(raw, at >> 16)
    stream.read(at & 0xFFFF)
    while stream.place < stop and (line := stream.line()):
        if line.strip():
            yield next(records(io.BufferedReader(io.BytesIO(b"".join([line, *(stream.line() for _ in range(3))])))))


class _Run(InputPartition):
    """Neighbouring shares of a file; the first one's number is ``place`` and its first record's ``base`` in its mate."""

    def __init__(self, path: str, cuts: list[int], size: int, pair: int, mate: int, place: int, base: int) -> None:
        super().__init__((path, cuts, size, pair, mate, place, base))


def _runs(shares: list[tuple]) -> list[list]:
    """What :class:`_Run` takes, of shares as :class:`Reads` has them. ``cuts``: where the first share begins and where each ends."""
    out: list[list] = []
    for path, start, end, size, pair, mate, place, base in shares:
        if out:
            path_, cuts, _, *mate_, place_, _ = out[-1]
            if (path_, mate_) == (path, [pair, mate]) and cuts[-1] == start and place_ + len(cuts) - 1 == place and end - cuts[0] <= RUN:
                cuts.append(end)
                continue
        out.append([path, [start, end], size, pair, mate, place, base])
    return out


def _shares(pairs: list[tuple[str, ...]], share: int) -> list[tuple]:
    """(path, start, end, size, file_pair, mate, place): the shares of each mate in order, by the files' sizes alone."""
    out = []
    for pair, both in enumerate(pairs):
        for mate, file in enumerate(both, 1):
            place = 0
            for path in names.parts(file):
                size = names.size(path)
                for start in range(0, max(size, 1), share):
                    out.append((path, start, min(start + share, size), size, pair, mate, place))
                    place += 1
    return out


def _of_share(path: str, start: int, end: int, size: int) -> Iterator[tuple[str, str, str]]:
    """The records that belong to a byte range. Files that cannot be split are the first range's."""
    for found in _of_shares(path, [start, end], size):
        yield from found


def _of_shares(path: str, cuts: list[int], size: int) -> Iterator[Iterator[tuple[str, str, str]]]:
    """The records of each of the byte ranges that begin and end at ``cuts``, to be read in turn."""
    store, name = located(path)
    with store.open_input_file(name) as file:
        raw = io.BufferedReader(file, 1 << 20)  # type: ignore[arg-type]
        head = raw.read(1 << 16)
        if cuts[0] == 0 and cuts[1] >= size:
            kind = "whole"
        elif bgzf.block_size(head[:64]):
            opening = _Blocks(raw, 0)
            kind = "blocks" if _plain([opening.line() for _ in range(4)]) else "whole"
        else:
            kind = "bytes" if head[:2] != names.GZIP and _plain(head.split(b"\n")) else "whole"
        if kind != "whole":
            for start, end in itertools.pairwise(cuts):
                yield _in_blocks(raw, start, end, size) if kind == "blocks" else _in_range(raw, start, end)  # type: ignore[arg-type]
            return
    for start in cuts[:-1]:
        if start:
            yield iter(())
        else:
            with opened(path) as stream:
                yield records(stream)


class Reader(DataSourceReader):
    """Runs of shares of files, records of which are given up to number ``last``, or only counted share by share."""

    def __init__(self, shares: list[list], only_count: bool, last: int) -> None:
        self.shares, self.only_count, self.last = shares, only_count, last

    def partitions(self) -> list[InputPartition]:
        return [_Run(*s) for s in self.shares] or [InputPartition(None)]  # a reader has to have a partition

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        path, cuts, whole, pair, mate, place, base = partition.value
        shares = _of_shares(path, cuts, whole)
        if self.only_count:
            yield self._batch([(pair, mate, sum(1 for _ in found), str(i), "", "", "") for i, found in enumerate(shares, place)])
            return
        found = itertools.chain.from_iterable(shares)
        rows: list[tuple] = []
        size = 0
        for i, (title, seq, qual) in enumerate(itertools.islice(found, min(max(self.last - base + 1, 0), sys.maxsize)), base):
            rows.append((pair, mate, i, title.split(None, 1)[0] if title.strip() else "", title, seq, qual))
            size += len(title) + 2 * len(seq)
            if len(rows) == ROWS or size > BYTES:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


class FastqSource(DataSource):
    """``shares``: a JSON list of what :class:`_Run` takes; with ``count`` their sizes are all that is given; ``last``: greatest record number."""

    @classmethod
    def name(cls) -> str:
        return "cellweave_fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(json.loads(self.options["shares"]), "count" in self.options, int(self.options.get("last", 1 << 62)))


class Reads:
    """Pairs of read files whose shares are numbered, to be read as a whole or in part.

    No files at all are an error. The driver sees the files' sizes, and one count for each share of
    a mate that has several; what kind a file is, tasks see.
    """

    def __init__(self, spark: SparkSession, pairs: list[tuple[str, ...]], share: int = SHARE) -> None:
        self.spark = prepare(spark)
        spark.dataSource.register(FastqSource)
        shares = _shares(pairs, share)
        if not shares:
            raise ValueError("no read files")
        base = [0] * len(shares)
        several = [i for i, s in enumerate(shares) if s[6]]
        if several:
            mates = {shares[i][4:6] for i in several}
            counted = self._load([(*s, 0) for s in shares if s[4:6] in mates], count="1")
            found = {(r["file_pair"], r["mate"], int(r["read_id"])): r["rec_idx"] for r in counted.select("file_pair", "mate", "read_id", "rec_idx").collect()}
            for i in several:
                pair, mate, place = shares[i][4:]
                base[i] = base[i - 1] + found[pair, mate, place - 1]
        self.shares = [(*s, b) for s, b in zip(shares, base, strict=True)]

    def _load(self, shares: list[tuple], **options: str) -> DataFrame:
        return self.spark.read.format("cellweave_fastq").option("shares", json.dumps(_runs(shares))).options(**options).load()

    def planned(self, pair: int | None = None, mate: int | None = None, last: int | None = None) -> list[tuple]:
        """The shares that may hold what is asked for."""
        return [s for s in self.shares if (pair is None or s[4] == pair) and (mate is None or s[5] == mate) and (last is None or s[7] <= last)]

    def rows(self, pair: int | None = None, mate: int | None = None, last: int | None = None) -> DataFrame:
        """(file_pair, mate, rec_idx, read_id, description, seq, qual) of one pair of files, one mate, or
        records up to number ``last``: other shares are not opened, and none is read beyond it.

        Mates are numbered from 1; files without records give no rows.
        """
        return self._load(self.planned(pair, mate, last), **({} if last is None else {"last": str(last)}))


def read(spark: SparkSession, pairs: list[tuple[str, ...]], share: int = SHARE) -> DataFrame:
    """All rows of :class:`Reads`."""
    return Reads(spark, pairs, share).rows()


def entry() -> Column:
    """The four lines of a record (description, seq, qual)."""
    return F.concat_ws("\n", F.concat(F.lit("@"), "description"), "seq", F.lit("+"), "qual")


def _ranged(reads: DataFrame, name: str) -> DataFrame:
    """``reads`` in partitions that are ranges of each file's records, in the files' order.

    Where record numbers lie close, as those of files do, ranges are so many numbers each: names and numbers alone are looked at
    for it. Spark's own ranges, for which it makes every row twice, are for others. The driver sees names and numbers of records.
    """
    sizes = reads.groupBy(F.col(name).alias("_file")).agg(F.min("rec_idx").alias("low"), F.max("rec_idx").alias("high"), F.count("*").alias("n")).orderBy("_file").collect()
    if any(r["_file"] is None or r["low"] is None or r["high"] - r["low"] >= DENSE * r["n"] for r in sizes):
        return reads.repartitionByRange(name, "rec_idx")
    cores = reads.sparkSession.sparkContext.defaultParallelism
    step = min(max(-(-sum(r["n"] for r in sizes) // (2 * cores)), ROWS), PART)
    parts = [(r["high"] - r["low"]) // step + 1 for r in sizes]
    firsts = [(r["_file"], r["low"], before) for r, before in zip(sizes, itertools.accumulate(parts, initial=0), strict=False)]
    known = reads.sparkSession.createDataFrame(firsts, "_file string, _low long, _part long")
    placed = reads.join(F.broadcast(known), F.col(name) == F.col("_file"))
    part = F.col("_part") + F.floor((F.col("rec_idx") - F.col("_low")) / step)
    return placed.repartitionById(max(sum(parts), 1), part.cast("int")).drop("_file", "_low", "_part")


def write(reads: DataFrame, folder: str, name: str = "name", compression: str = "none") -> None:
    """Read files ``folder/name=.../part-*`` that hold, in the order of their names, records by ``rec_idx``.

    Such a folder can be read by :func:`cellweave.sources.files.paired` and :func:`read`.
    Ranges of records, not whole files, are what a task writes. An existing folder is an error.
    """
    ranged = _ranged(reads, name).sortWithinPartitions(name, "rec_idx")
    ranged.select(F.col(name), entry().alias("value")).write.partitionBy(name).mode("errorifexists").option("compression", compression).text(folder)
