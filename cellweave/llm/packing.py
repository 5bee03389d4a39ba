"""Pack token sequences into as few fixed-size sequences as can be.

Lengths of all pieces form a histogram of at most ``size`` rows. A configuration linear program
over it (how often to use each multiset of lengths that fits one sequence) is solved by
multiplicative weights with a knapsack dynamic program as its pricing, which also gives a lower
bound. The solution is rounded down, and what is left goes best-fit by decreasing length, on the
histogram. Pieces find their places through their rank among pieces of one length, so no piece
list ever passes through the driver or one task.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.textkit import chunks
from cellweave.session import prepare, written

SIZE = 2048
END = 0  # the id that follows each document

# ---------------------------------------------------------------- tokens and pieces


def tokenizer(name: str = "byte_bpe_50k", path: Callable[[str], str] | None = None) -> Callable[[str], np.ndarray]:
    """An encoder for one text: the byte-level vocabulary, special strings in the text included.

    The rank file and the JSON file hold one vocabulary; the rank encoder is the faster, and the
    JSON one takes over for texts on which its pattern matcher gives up.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path
    import public_tokenizers as vocabulary
    import tiktoken

    with open(path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=vocabulary.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})
    slow = []

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as error:  # the matcher reports its limits as a panic, not as an Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(path(f"{name}.json")))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def cut(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids; only the first may be shorter than ``size``."""
    first = (n - 1) % size + 1
    return [(0, first), *((at, size) for at in range(first, n, size))]


def pieces(docs: DataFrame, size: int = SIZE, encoder: Callable[[], Callable[[str], np.ndarray]] = tokenizer, with_ids: bool = False) -> DataFrame:
    """One row for each piece of each row of ``docs`` (null text: empty), numbered in its task.

    ``task`` and ``local`` are the task and the count of earlier pieces of this length in it.
    """
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        task = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in chunks(texts):
                rows: list[tuple] = []
                ids_out: list[np.ndarray] = []
                for i in range(low, high):
                    ids = np.append(encode(texts[i] or ""), END).astype("<u4")
                    for piece, (start, length) in enumerate(cut(len(ids), size)):
                        part = ids[start : start + length]
                        rows.append((i, piece, start, length, zlib.crc32(part.tobytes()), task, int(seen[length])))
                        seen[length] += 1
                        if with_ids:
                            ids_out.append(part.astype(np.int32))
                columns = list(zip(*rows, strict=True))
                made = [batch.column(0).take(pa.array(columns[0])), pa.array(columns[1], pa.int32())]
                made += [pa.array(c, pa.int64()) for c in columns[2:5]]
                made += [pa.array(columns[5], pa.int32()), pa.array(columns[6], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "local"]
                if with_ids:
                    made.append(pa.array(ids_out, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(made, names=names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, local long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


# ---------------------------------------------------------------- the plan


def knapsack(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each room the greatest value of a multiset of lengths that fits, and a length in it (0: a place left empty).

    ``value[x]`` is the price of length x, -inf where there is none; each length may be used any
    number of times.
    """
    size = len(value) - 1
    best, took = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for room in range(1, size + 1):
        total = best[room - 1 :: -1][:room] + value[1 : room + 1]
        x = int(total.argmax())
        if total[x] > best[room - 1]:
            best[room], took[room] = total[x], x + 1
        else:
            best[room] = best[room - 1]
    return best, took


def _contents(took: np.ndarray, room: int) -> dict[int, int]:
    out: dict[int, int] = {}
    while room > 0:
        x = int(took[room])
        if x:
            out[x] = out.get(x, 0) + 1
        room -= x or 1
    return out


def configuration_lp(histogram: dict[int, int], size: int = SIZE, rounds: int = 10, steps: int = 16, rate: float = 5.0, near: float = 0.03) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Configurations (length -> times) with how often to use each, and a lower bound of the optimum.

    Multiplicative weights: a length's price is its size times a weight that falls exponentially
    with the share of its pieces covered. In each round every length is to be covered by one more
    ``rounds``-th of its pieces. A dynamic program prices the best configuration, alone and with
    each single length in it; those worth nearly as much are used, the least covered lengths'
    first, until one of their lengths is a round ahead, which then has no value for the round's
    next pricings. Prices over the best configuration's worth are a feasible dual solution, so
    the pieces' total price over it bounds the optimum. It ends early where no length can be
    covered further.
    """
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[x] for x in lengths], float)
    place = np.zeros(size + 1, np.int64)
    place[lengths] = np.arange(len(lengths))
    covered = np.zeros(len(lengths))
    used: dict[tuple, float] = {}
    bound = 0.0
    for turn in range(1, rounds + 1):
        goal, most = demand * turn / rounds, np.minimum(demand, demand * (turn + 1) / rounds)
        for step in range(steps):
            open_ = most - covered > 1e-9 * demand
            if not (covered < goal * (1 - 1e-9)).any():
                break
            price = lengths * np.exp(rate * (turn / rounds - covered / demand))
            value = np.full(size + 1, -np.inf)
            value[lengths[open_]] = price[open_]
            best, took = knapsack(value)
            if step == 0 and open_.all():
                bound = max(bound, float(demand @ price / best[size]))
            good = np.flatnonzero(open_ & (covered < goal) & (price + best[size - lengths] >= best[size] * (1 - near)))
            moved = False
            for i in good[np.argsort((covered / demand)[good], kind="stable")]:
                if covered[i] >= goal[i]:
                    continue
                contents = _contents(took, size - int(lengths[i]))
                contents[int(lengths[i])] = contents.get(int(lengths[i]), 0) + 1
                at, times = place[list(contents)], np.array(list(contents.values()))
                amount = float(((most[at] - covered[at]) / times).min())
                if amount > 1e-9:
                    covered[at] += times * amount
                    key = tuple(sorted(contents.items()))
                    used[key] = used.get(key, 0.0) + amount
                    moved = True
            if not moved:
                break
    return [(dict(k), x) for k, x in used.items()], bound


def best_fit(histogram: dict[int, int], size: int = SIZE, opened: list[tuple[dict[int, int], int]] | None = None) -> list[tuple[dict[int, int], int]]:
    """Best-fit by decreasing length, on counts: sequences with equal contents are one entry.

    ``opened`` sequences are there from the start, and are filled like all others.
    """
    room: dict[int, dict[tuple, int]] = {}
    for contents, count in opened or []:
        at = room.setdefault(size - sum(x * n for x, n in contents.items()), {})
        key = tuple(sorted(contents.items()))
        at[key] = at.get(key, 0) + count
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            fits = [r for r in room if r >= length]
            if not fits:
                each = size // length
                full, rest = divmod(left, each)
                for times, count in ((each, full), (rest, 1)):
                    if times and count:
                        at = room.setdefault(size - times * length, {})
                        at[((length, times),)] = at.get(((length, times),), 0) + count
                break
            r = min(fits)
            contents, count = room[r].popitem()
            if not room[r]:
                del room[r]
            take = min(count, left)
            if count > take:
                room.setdefault(r, {})[contents] = count - take
            grown = dict(contents)
            grown[length] = grown.get(length, 0) + 1
            key = tuple(sorted(grown.items()))
            at = room.setdefault(r - length, {})
            at[key] = at.get(key, 0) + take
            left -= take
    return [(dict(k), n) for at in room.values() for k, n in at.items()]


#: A configuration of the program is kept where it fills this share of a sequence; the least of the plans is taken.
FILLS = (1.0, 0.996, 0.0)
#: Rounds of the program, and pricings in each, one solution after another; and the share of the bound that is near enough.
FINER = ((10, 16), (20, 32), (40, 64), (80, 64))
GAP = 0.0002


@dataclass(frozen=True)
class Plan:
    """Configurations and whole counts that hold every piece of the histogram exactly once."""

    configurations: list[tuple[dict[int, int], int]]
    #: Sequences that the linear program begins, and a lower bound of their least number.
    from_program: int
    bound: int

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.configurations)


def _rounded(histogram: dict[int, int], configurations: list[tuple[dict[int, int], float]], size: int, bound: int) -> list[Plan]:
    """Plans that begin with the program's configurations, their numbers rounded down, and end by best fit."""
    plans = []
    for least in FILLS:
        left, begun = dict(histogram), []
        for contents, times in sorted(configurations, key=lambda c: -c[1]):
            whole = min([int(times + 1e-9), *(left[x] // n for x, n in contents.items())])
            if whole and sum(x * n for x, n in contents.items()) >= least * size:
                begun.append((contents, whole))
                for x, n in contents.items():
                    left[x] -= n * whole
        filled = best_fit({x: n for x, n in left.items() if n}, size, begun)
        plans.append(Plan(filled, sum(n for _, n in begun), bound))
    return plans


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """The linear program's solution rounded down, with what is left placed by best fit, in its gaps too.

    The program is solved in finer and finer rounds, until the plan is within ``GAP`` of the lower
    bound or a finer solution makes it no smaller. Rounding and approximation may cost more than the program gains
    where best fit alone is nearly optimal, so that is the last of the plans compared. None uses
    more sequences than it.
    """
    if not histogram:
        return Plan([], 0, 0)
    by = lambda p: (p.sequences, -p.from_program)
    bound, best = -(-sum(x * n for x, n in histogram.items()) // size), Plan(best_fit(histogram, size), 0, 0)
    for rounds, steps in FINER:
        configurations, dual = configuration_lp(histogram, size, rounds, steps)
        bound = max(bound, int(np.ceil(dual * (1 - 1e-9))))
        before, best = best.sequences, min([*_rounded(histogram, configurations, size, bound), best], key=by)
        if best.sequences <= bound * (1 + GAP) or (rounds != FINER[0][0] and best.sequences >= before):
            break
    return replace(best, bound=bound)


@dataclass(frozen=True)
class Places:
    """For each length, runs of ranks: first rank, first sequence, offset, pieces a sequence."""

    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            first, start, base, times = self.runs[int(x)]
            run = np.searchsorted(first, rank[at], "right") - 1
            inner = rank[at] - first[run]
            sequence[at] = start[run] + inner // times[run]
            offset[at] = base[run] + inner % times[run] * x
        return sequence, offset


def places(configurations: list[tuple[dict[int, int], int]]) -> Places:
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    next_rank: dict[int, int] = {}
    sequence = 0
    for contents, count in configurations:
        offset = 0
        for length in sorted(contents, reverse=True):
            times = contents[length]
            rank = next_rank.get(length, 0)
            rows.setdefault(length, []).append((rank, sequence, offset, times))
            next_rank[length] = rank + times * count
            offset += times * length
        sequence += count
    return Places({x: tuple(np.array(c) for c in zip(*r, strict=True)) for x, r in rows.items()})


def pack(made: DataFrame, size: int = SIZE) -> DataFrame:
    """``sequence_id`` and ``offset`` for each row of written ``pieces``.

    The driver sees one count for each length; the configurations it sends back depend on the
    histogram's support only. Ranks come from counts by task and length, so a length that a
    third of all pieces share is ranked by many tasks. Spark sends these counts to every task
    only where they are smaller than its broadcast limit; else both sides are dealt by length
    and task, which splits the hot length too.
    """
    spark = made.sparkSession
    counts = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = written(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(places(plan(histogram, size).configurations))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = made.join(first, ["length", "task"]).withColumn("rank", F.col("first") + F.col("local")).drop("task", "local", "first")
    names = ranked.columns
    length_at, rank_at = names.index("length"), names.index("rank")
    kept = [i for i in range(len(names)) if i != rank_at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = shared.value.find(batch.column(length_at).to_numpy(), batch.column(rank_at).to_numpy())
            columns = [batch.column(i) for i in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*(names[i] for i in kept), "sequence_id", "offset"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank"]
    return ranked.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Pack the tokens of every whole text; ``with_ids`` returns the ids of each piece too.

    Repeated rows are packed each for itself; a null or empty text is the end id alone; an
    empty table gives no rows. A null id stays null. Very long texts are cut into pieces of the
    full size. Only ``doc_id`` and ``text`` are read, so other columns' names do not matter.
    """
    made = written(pieces(docs, size, with_ids=with_ids), "pieces")
    packed = pack(made, size)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def packed_stage(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Pipeline stage: pieces of ``docs`` and their places.

    Null and empty texts are one piece of one id each; texts longer than a sequence are cut; rows
    that repeat, or have no id, are packed each; pieces of one length are alike to the plan; an
    empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    return pack_documents(docs)
