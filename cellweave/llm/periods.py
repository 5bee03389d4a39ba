"""Periodic runs of words: stretches that repeat with a period, found on a harmonic grid.

A stretch of period q and 3 q words or more holds, for one of every 2 q places i, word i and
word i + q both. So for every period those places are tried that are multiples of its step (the
harmonic grid: about n log n places in all), and a pair of equal words is extended to both
sides. How far two places agree is answered by an index over a difference cover: of all
suffixes only those that begin at places of the cover (4 of every 13) are sorted; any two
places reach two such suffixes at the same distance of at most 12 words, which are compared one
by one, and a sparse table over the sorted suffixes' common lengths gives the rest at once.

A batch of texts is one sequence of numbers in which a number of its own ends each text, so no
agreement crosses texts. The index is built for texts only in which some pair agrees for more
than a few words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.batches import map_texts

#: Fixed by the contract: least length of a run, and how often its period fits at least.
SHORTEST, TIMES = 24, 3
#: Every distance modulo PERIOD is a difference of two members of COVER.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Pairs of places held at a time.
PAIRS = 1 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _cover_tables() -> tuple[np.ndarray, np.ndarray]:
    """Number of a residue among the cover's (-1: none); least way from two residues to the cover."""
    slot = np.full(PERIOD, -1)
    slot[list(COVER)] = np.arange(len(COVER))
    way = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            way[a, b] = next(d for d in range(PERIOD) if slot[(a + d) % PERIOD] >= 0 and slot[(b + d) % PERIOD] >= 0)
    return slot, way


_SLOT, _WAY = _cover_tables()


def agreement(seq: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray | int, step: int = 1) -> np.ndarray:
    """Equal words from places i and j on (back from them, if ``step`` is -1), ``most`` at most."""
    out = np.zeros(len(i), np.int64)
    limit = np.broadcast_to(most, len(i))
    going = np.flatnonzero(limit > 0)
    t = 0
    while len(going):
        a, b = i[going] + step * t, j[going] + step * t
        inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(seq))
        going, a, b = going[inside], a[inside], b[inside]
        going = going[seq[a] == seq[b]]
        t += 1
        out[going] = t
        going = going[limit[going] > t]
    return out


class Extensions:
    """Common lengths of any two suffixes of a sequence in which no two suffixes are equal."""

    def __init__(self, seq: np.ndarray):
        self.seq = seq
        places = np.arange(-(-len(seq) // PERIOD) * PERIOD).reshape(-1, PERIOD)[:, list(COVER)].ravel()
        n = len(places)
        padded = np.concatenate([seq, np.full(2 * PERIOD, -1, seq.dtype)])
        begun = np.minimum(places, len(seq))  # places beyond the end are suffixes without words
        columns = [padded[begun + k] for k in range(PERIOD - 1, -1, -1)]
        levels = [self._ranked(np.lexsort(columns), columns)]
        shift = len(COVER)
        while levels[-1].max(initial=-1) + 1 < n - self._beyond(places, len(seq)) and shift < n:
            second = np.full(n, -1, np.int64)
            second[: n - shift] = levels[-1][shift:]
            pair = [second, levels[-1]]
            levels.append(self._ranked(np.lexsort(pair), pair))
            shift *= 2
        self.order = np.argsort(levels[-1], kind="stable")
        self.rank = np.empty(n, np.int64)
        self.rank[self.order] = np.arange(n)
        self.table = self._sparse(self._neighbours(places, levels))

    @staticmethod
    def _beyond(places: np.ndarray, n: int) -> int:
        """Places beyond the end of the sequence, less one: they all rank alike."""
        return max(0, int((places >= n).sum()) - 1)

    @staticmethod
    def _ranked(order: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        new = np.zeros(len(order), bool)
        for c in columns:
            new[1:] |= c[order[1:]] != c[order[:-1]]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _neighbours(self, places: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common length of each suffix in the order and the one before it, by the ranks of blocks."""
        a, b = self.order[1:].copy(), self.order[:-1].copy()
        shared = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            blocks = len(COVER) << k
            inside = np.maximum(a, b) < len(places)
            same = np.zeros(len(a), bool)
            same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
            same &= (places[np.minimum(np.maximum(a, b), len(places) - 1)] < len(self.seq))
            a, b = a + same * blocks, b + same * blocks
            shared += same * (PERIOD << k)
        first = places[self.order[1:]] + shared
        second = places[self.order[:-1]] + shared
        return shared + agreement(self.seq, first, second, PERIOD - 1)

    @staticmethod
    def _sparse(shared: np.ndarray) -> list[np.ndarray]:
        table = [shared]
        while (half := 1 << (len(table) - 1)) * 2 <= len(shared):
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def lengths(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common length of the suffixes from places i and j (not the same place); 0 at the end."""
        way = _WAY[i % PERIOD, j % PERIOD]
        out = agreement(self.seq, i, j, way)
        rest = np.flatnonzero((out == way) & (np.maximum(i, j) + way < len(self.seq)))
        a, b = i[rest] + way[rest], j[rest] + way[rest]
        ranks = [self.rank[p // PERIOD * len(COVER) + _SLOT[p % PERIOD]] for p in (a, b)]
        low, high = np.minimum(*ranks), np.maximum(*ranks)
        depth = np.frexp(high - low)[1].astype(np.int64) - 1
        for k in np.unique(depth):
            at = depth == k
            row = self.table[k]
            out[rest[at]] += np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return out


def _grid(first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, i, period, step) of the grid's places of all periods, about ``PAIRS`` at a time."""
    periods = np.where(size >= SHORTEST, size // TIMES, 0)
    text = np.repeat(np.arange(len(size)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(SHORTEST, TIMES * period) - period
    places = -(-(size[text] - period) // step)
    upto = np.cumsum(places)
    low = 0
    while low < len(text):
        done = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
        which = np.repeat(np.arange(low, high), places[low:high])
        number = np.arange(len(which)) - (upto[which] - places[which] - done)
        yield text[which], first[text[which]] + number * step[which], period[which], step[which]
        low = high


def _starts(size: np.ndarray) -> np.ndarray:
    """Where each text begins in a sequence in which one number ends each text."""
    return np.cumsum(size + 1) - (size + 1)


def _long_enough(text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """(text, start, length, period) rows of stretches that count as runs."""
    good = length >= np.maximum(SHORTEST, TIMES * period)
    return np.unique(np.stack([text[good], start[good], length[good], period[good]], 1), axis=0)


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period, by text, start and period.

    A stretch of three or more periods q has no other smallest period than a divisor of q, and
    is found with that too, since what extends the one extends the other.
    """
    rows = np.unique(rows, axis=0) if len(rows) else rows
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def runs(seq: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(text, start, length, period) of all runs of a batch, start counted within the text.

    ``seq``: the words' numbers of all texts, a number of its own after each; ``size``: words of each text.
    """
    first = _starts(size)
    found, deep = [np.zeros((0, 4), np.int64)], np.zeros(len(size), bool)
    for text, i, period, step in _grid(first, size):
        equal = np.flatnonzero(seq[i] == seq[i + period])
        text, i, period, step = text[equal], i[equal], period[equal], step[equal]
        after = agreement(seq, i, i + period, PERIOD)
        before = agreement(seq, i - 1, i + period - 1, PERIOD, -1)
        more = (after == PERIOD) | (before == PERIOD)
        deep[text[more]] = True
        near = ~more & (after + before >= step)
        found.append(_long_enough(text[near], (i - before - first[text])[near], (after + before + period)[near], period[near]))
    which = np.flatnonzero(deep)
    if len(which):
        some = np.concatenate([seq[first[d] : first[d] + size[d] + 1] for d in which])
        begun = _starts(size[which])
        forward, backward = Extensions(some), Extensions(some[::-1].copy())
        for k, i, period, step in _grid(begun, size[which]):
            equal = np.flatnonzero(some[i] == some[i + period])
            k, i, period, step = k[equal], i[equal], period[equal], step[equal]
            before = np.zeros(len(i), np.int64)
            inner = i > 0
            before[inner] = backward.lengths(len(some) - i[inner], len(some) - i[inner] - period[inner])
            whole = before + forward.lengths(i, i + period)
            long = whole >= step
            found.append(_long_enough(which[k[long]], (i - before - begun[k])[long], (whole + period)[long], period[long]))
    return _smallest(np.concatenate(found))


def numbered(texts: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as one sequence of numbers, each text ended by a number of its own; words of each text."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    number = {w: i for i, w in enumerate(set().union(*texts))}
    seq = np.empty(int(size.sum()) + len(size), np.int64)
    for d, (at, words) in enumerate(zip(_starts(size), texts, strict=True)):
        seq[at : at + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        seq[at + len(words)] = len(number) + d
    return seq, size


def find(texts: list[str | None]) -> dict[str, Sequence]:
    """Number of words, runs, and the words that no run repeats, joined by spaces, of each text."""
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    seq, size = numbered(split)
    rows = runs(seq, size)
    bounds = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    kept = []
    for d, words in enumerate(split):
        own = rows[bounds[d] : bounds[d + 1]]
        if len(own):
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, own[:, 1] + own[:, 3], 1)
            np.add.at(edge, own[:, 1] + own[:, 2], -1)
            words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
        kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
    listed = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in (1, 2, 3)], fields=list(RUN))
    return {"n_words": size, "runs": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), listed), "collapsed": kept}


def periodic_runs(df: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (all, if None) with ``n_words``, ``runs`` and ``collapsed`` of each row's text.

    ``runs``: (start, length, period) by start, then period, of every maximal stretch of at least
    ``SHORTEST`` words and ``TIMES`` times its smallest period. ``collapsed``: the words outside
    the repetitions (a run's first period stays), joined by single spaces. Words are what lies
    between ASCII white space. Null and empty texts have no words, no runs and an empty
    ``collapsed``; rows that repeat stay; an empty table stays empty. Columns of ``keep`` may
    not have the three names given here: leave such columns out. A text is worked on as a whole
    in memory that grows with its length, however often it repeats.
    """
    return map_texts(df, text, find, FOUND, keep)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): for one document in ten, by its id's checksum, its words from some place on
    are those of one period again and again, as the query's contract has it. Rows without an id
    or words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    rows = rows.withColumns({"n": F.size("w"), "g": F.floor(F.col("h") / 10)}).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    a, p, n = (F.col(c).cast("int") for c in "apn")
    cycles = F.array_repeat(F.slice("w", a + 1, p), (F.floor((F.col("n") - F.col("a")) / F.col("p")) + 1).cast("int"))
    made = F.array_join(F.slice(F.concat(F.slice("w", F.lit(1), a), F.flatten(cycles)), F.lit(1), n), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of ``doc_id``, ``runs`` and ``collapsed``."""

    def stronger(x, y):
        """Greater length by period first, then smaller start, then smaller period."""
        left, right = x["length"] * y["period"], y["length"] * x["period"]
        by = [(left > right, -1), (left < right, 1), (x["start"] < y["start"], -1), (x["start"] > y["start"], 1), (x["period"] < y["period"], -1), (x["period"] > y["period"], 1)]
        out = F.when(by[0][0], by[0][1])
        for test, value in by[1:]:
            out = out.when(test, value)
        return out.otherwise(0)

    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    best = F.get(F.array_sort("runs", stronger), F.lit(0))
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{n}").alias(n) for n in ("start", "length", "period")),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return digests(periodic_runs(docs, keep=["doc_id"]))
