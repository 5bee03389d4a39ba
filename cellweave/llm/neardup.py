"""Near-duplicates through an inverted join of MinHash signature coordinates.

Every distinct shingle set has a signature. A set is posted under each coordinate-value pair of
its prefix: its ``K - T + 12`` rarest pairs, in one order for all sets, so that two signatures
that agree on ``T`` coordinates meet in 12 posting lists at least, and a set that shares fewer
with any others is done with. Lists are merged in two steps. First
each set meets a few hubs of its lists only; sets that turn out linked through hubs share a
component and need not meet again, which keeps a group of many near copies linear. Sets of
lists that still hold several components are posted anew under their rarest shingles, and all
pairs that meet there in different components are merged. Pairs met under coordinates skip on
when fewer than ``T`` agree; all others are confirmed on their full sets.

Texts with equal sets are one class from the start, so copies are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.batches import map_texts
from cellweave.llm.textkit import Texts, chunks, mixed
from cellweave.session import prepare, written

WORDS = 5
#: Links: 100 * intersection >= SHARE * union.
SHARE = 75
#: Coordinates of a signature, and how many must agree. At a similarity of exactly 0.75 fewer
#: than 76 of 128 agree in 3.5 of 100,000 pairs, which are lost unless the pair's component is
#: found through others; above it sooner never.
K, T = 128, 76
#: Signatures that agree on T coordinates have so many pairs in common among their first PREFIX.
SHARED = 12
PREFIX = K - T + SHARED
#: Frequencies of coordinate-value pairs are counted in so many buckets (their order only
#: decides how long the lists in use are, not which pairs are found).
SKETCH_LOG2 = 16
#: Bits of the map that tells tasks which texts' sets are wanted (2 MB).
MARKS_LOG2 = 24
#: Hubs of each list in the first round, of the few lists in later ones, hubs tried for each set, and rounds at most.
HUBS, LATER_HUBS, ROUNDS = 4, 8, 6
#: Steps towards stars between two rounds, and pairs left for each set at which the last round begins:
#: its work grows as the sets do.
BETWEEN, FEW = 1, 16

_rng = np.random.default_rng(1234577)
_SCALE = _rng.integers(0, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 2**63, K, dtype=np.uint64)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased.

    A text with fewer than ``WORDS`` words has all its words as its one shingle; one without
    words has none.
    """
    t = Texts(texts, lower=True)
    words = t.word_hash()
    keys, first = t.windows(words, WORDS)
    low = np.searchsorted(first, t.first)
    high = np.searchsorted(first, t.last)
    out = []
    for i, n in enumerate(t.n_words):
        if n >= WORDS or n == 0:
            out.append(np.unique(keys[low[i] : high[i]]))
        else:
            own = words[t.first[i] : t.last[i]]
            total = np.uint64(n)
            for j, w in enumerate(own):
                total = mixed(np.array([total ^ w + np.uint64(j)], np.uint64))[0]
            out.append(np.array([total], np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of K permutations, folded to 32 bits."""
    least = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[at : at + 1024, None] * _SCALE + _SHIFT
        np.minimum(least, part.min(axis=0), out=least)
    return (mixed(least) >> np.uint64(32)).astype(np.uint32)


def _signed(texts: list[str | None]) -> dict[str, list]:
    out: dict[str, list] = {"n_shingles": [], "set_a": [], "set_b": [], "signature": []}
    for shingles in shingle_sets(texts):
        out["n_shingles"].append(len(shingles))
        # two 64-bit digests of the set name the class
        spread = mixed(shingles)
        out["set_a"].append(np.add.reduce(spread, dtype=np.uint64).astype(np.int64) if len(shingles) else 0)
        out["set_b"].append(np.add.reduce(mixed(spread ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64).astype(np.int64) if len(shingles) else 0)
        out["signature"].append(signature(shingles).tobytes() if len(shingles) else None)
    return out


def _signatures(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint32).reshape(-1, K)


def _pair_keys(signatures: np.ndarray) -> np.ndarray:
    return np.arange(K, dtype=np.int64) << 32 | signatures.astype(np.int64)


def _bucket(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys.astype(np.uint64)) >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64)


def frequency_sketch(classes: DataFrame) -> np.ndarray:
    """How many coordinate-value pairs of all signatures fall into each of a fixed number of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_LOG2, np.int64)
        for batch in batches:
            total += np.bincount(_bucket(_pair_keys(_signatures(batch.column(0)))).ravel(), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = classes.select("signature").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    sketch = np.zeros(1 << SKETCH_LOG2, np.int64)
    sketch[rows["bucket"]] = rows["n"]
    return sketch


def postings(classes: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(key, id, n) for the rarest pairs of each signature, from (id, n, signature)."""
    shared = classes.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _pair_keys(_signatures(batch.column(2)))
            # ties of frequency go by the key's own hash, the same for all sets
            order = np.lexsort((mixed(keys.astype(np.uint64)), shared.value[_bucket(keys)]), axis=1)[:, :PREFIX]
            chosen = np.take_along_axis(keys, order, axis=1)
            at = np.repeat(np.arange(len(keys)), PREFIX)
            yield pa.RecordBatch.from_arrays([pa.array(chosen.ravel()), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))], names=["key", "id", "n"])

    return classes.select("id", "n", "signature").mapInArrow(run, "key long, id long, n long")


def _size_fits(a: str, b: str):
    return (F.col(a) * 100 >= F.col(b) * SHARE) & (F.col(b) * 100 >= F.col(a) * SHARE)


def agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of class ids whose signatures agree on T coordinates at least."""
    own = classes.select("id", "signature")
    both = (
        pairs.join(own.select(F.col("id").alias("a"), F.col("signature").alias("sa")), "a")
        .join(own.select(F.col("id").alias("b"), F.col("signature").alias("sb")), "b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_signatures(batch.column(2)) == _signatures(batch.column(3))).sum(axis=1)
                yield batch.select(["a", "b"]).filter(pa.array(same >= T))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _marks(ids: np.ndarray) -> np.ndarray:
    return (mixed(ids.astype(np.uint64)) >> np.uint64(64 - MARKS_LOG2)).astype(np.int64)


def class_sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shingles) of the ``texts`` (id, text) named in ``ids``, and perhaps of a few more.

    The ids travel to the texts, not the texts to the ids: as a bit map of fixed size. Where it
    is crowded it lets more texts through, which costs time and changes no result.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << (MARKS_LOG2 - 5), np.int64)
        for batch in batches:
            at = _marks(batch.column(0).to_numpy())
            np.bitwise_or.at(words, at >> 5, np.int64(1) << (at & 31))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], names=["word", "bits"])

    rows = ids.select("id").mapInArrow(mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(1 << (MARKS_LOG2 - 5), np.uint32)
    words[rows["word"]] = rows["bits"]
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _marks(batch.column(0).to_numpy())
            batch = batch.filter(pa.array((shared.value[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool)))
            strings = batch.column(1).to_pylist()
            for low, high in chunks(strings):
                made = [x.tobytes() for x in shingle_sets(strings[low:high])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(made, pa.binary())], names=["id", "shingles"])

    return texts.select("id", "text").mapInArrow(run, "id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    both = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for sa, sb in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (sa, sb))
                if len(a) > len(b):
                    a, b = b, a
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                shared = int((b[at] == a).sum())
                good.append(100 * shared >= SHARE * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def stars(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Edges (a, b), b before a, that join what ``edges`` (a, b) join, as stars around the smallest ids.

    Alternates two steps until nothing changes, or ``rounds`` times: every vertex hands its
    smallest neighbour to its larger ones, then to its smaller ones. Trees flatten in few rounds,
    whatever their shape, and minima are pre-aggregated, so a hub's neighbours are never gathered.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u <> v").distinct(), "edges")
    state, turn = None, 0
    while rounds is None or turn < rounds:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("v", "m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u <> v")
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = small.select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(least.select("v", F.col("m").alias("u")))
        edges, turn = written(small.where("u <> v").distinct(), "stars"), turn + 1
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("v").alias("a"), F.col("u").alias("b"))


def labelled(star_edges: DataFrame) -> DataFrame:
    """(id, component) by the smallest id that each is joined with; ids joined with smaller ones only."""
    return star_edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for each id of ``edges`` (a, b) that is linked to a smaller one: the smallest id reachable."""
    return labelled(stars(edges))


def _open(lists: DataFrame, found: DataFrame | None) -> tuple[DataFrame, int, int]:
    """Lists that still hold sets of several components, their number and their pairs of such sets."""
    if found is None:
        current = lists.withColumn("component", F.col("id"))
    else:
        current = lists.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    members = current.groupBy("key", "component").agg(F.count("*").alias("m"))
    per_key = members.groupBy("key").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("mm"), F.count("*").alias("parts")).where("parts > 1")
    per_key = written(per_key.select("key", ((F.col("m") * F.col("m") - F.col("mm")) / 2).cast("long").alias("pairs")), "open-lists")
    total = per_key.agg(F.sum("pairs").alias("pairs"), F.count("*").alias("n")).first()
    return written(current.join(per_key.select("key"), "key", "left_semi"), "open-postings"), total["n"], total["pairs"] or 0


def _busy(lists: DataFrame) -> DataFrame:
    """Rows of the sets that are still in as many lists as a partner shares with them."""
    return lists.join(lists.groupBy("id").agg(F.count("*").alias("m")).where(F.col("m") >= SHARED).select("id"), "id", "left_semi")


def _several(lists: DataFrame) -> DataFrame:
    """Rows of lists that hold more than one set."""
    return lists.join(lists.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key"), "key", "left_semi")


def _enough(support: str, a: str, b: str):
    """Whether ``support`` shared shingles can link sets of these sizes."""
    return (100 + SHARE) * F.col(support) >= SHARE * (F.col(a) + F.col(b))


def _possible(pairs: DataFrame) -> DataFrame:
    return pairs.where(_size_fits("na", "nb") & _enough("pa", "na", "nb") & _enough("pb", "na", "nb"))


def _best_met(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of each set with the hubs that it met most often, ``HUBS`` at most.

    A hub round only has to link what it can; pairs left out meet in the last round, unless
    their components are one by then.
    """
    counted = _possible(met).groupBy("id", "hub").agg(F.count("*").alias("met"))
    best = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("met"), "hub"))
    return counted.withColumn("best", best).where(F.col("best") <= HUBS).select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))


def rare_postings(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Posting lists of the sets in open lists, now under their own rarest shingles.

    A large group of edited copies leaves many sets that are near to all others, though to none
    near enough; signatures of T in K cannot tell. Shingles are counted among these sets and put
    in one order, rarest first, those no other set has before all. A set is posted under the
    first of them, as far as a partner could still share the rest; ``support`` is how many
    shingles there are from there on, the most a partner that it first meets there can share.
    """
    ids = lists.select("id").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys = np.frombuffer(x.as_buffer(), np.int64)
                made = [pa.array(keys), pa.array(np.full(len(keys), i)), pa.array(np.full(len(keys), len(keys)))]
                yield pa.RecordBatch.from_arrays(made, names=["key", "id", "n"])

    rows = sets.join(ids, "id", "left_semi").select("id", "shingles").mapInArrow(run, "key long, id long, n long")
    several = rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    own = Window.partitionBy("id")
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("m", "key")) - 1
    placed = rows.join(several, "key").withColumn("place", place).where(100 * F.col("place") <= (100 - SHARE) * F.col("n"))
    placed = placed.select("key", "id", "n", (F.col("n") - F.col("place")).alias("support"))
    least = placed.groupBy("key").agg(F.min("n").alias("least"))
    return placed.join(least, "key").where(_enough("support", "n", "least")).drop("least")


def links(classes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """(id, component) of all classes that are linked to others; None if none are.

    ``classes``: (id, n, signature), n the size of the set; ``texts``: (id, text).
    """
    made = postings(classes, frequency_sketch(classes))
    lists = written(_several(made), "shared-postings")
    lists = written(_several(_busy(lists)).withColumn("support", F.col("n")), "shared-postings")
    sets = written(class_sets(texts, lists.select("id").distinct()), "sets")
    edges: DataFrame | None = None
    found: DataFrame | None = None
    before: int | None = None
    few = classes.count()
    for turn in range(ROUNDS + 1):
        current, n, pairs_left = _open(lists, found)
        if n and turn == 1:
            current, n, pairs_left = _open(rare_postings(_busy(current), sets), found)
        if not n:
            break
        lists = current.drop("component")
        last = turn == ROUNDS or (turn > 0 and (pairs_left <= max(8 * n, FEW * few) or (before is not None and pairs_left > 0.9 * before)))
        before = pairs_left if turn else None
        if last:
            left = current.select("key", F.col("id").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("support").alias("pa"))
            right = current.select("key", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("support").alias("pb"))
            pairs = left.join(right, "key").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")))
        else:
            of_list = range(HUBS if turn == 0 else LATER_HUBS)
            hubs = current.groupBy("key").agg(*(
                F.min_by(F.struct("id", "n", "component", "support"), F.xxhash64(F.col("id"), F.lit(100 * turn + i))).alias(f"h{i}") for i in of_list
            ))
            hubs = hubs.select("key", F.explode(F.array_distinct(F.array(*(f"h{i}" for i in of_list)))).alias("hub"))
            met = current.join(hubs, "key").where((F.col("id") != F.col("hub.id")) & (F.col("component") != F.col("hub.component")))
            pairs = _best_met(met.select("id", F.col("hub.id").alias("hub"), F.col("n").alias("na"), F.col("hub.n").alias("nb"), F.col("support").alias("pa"), F.col("hub.support").alias("pb")))
        if last:
            pairs = _possible(pairs).select("a", "b")
        pairs = pairs.distinct()
        # pairs from rarest shingles are judged on their sets alone: nearly all of their signatures agree
        good = written(confirmed(agreeing(pairs, classes) if turn == 0 else pairs, sets), "links")
        if last:
            edges = good if edges is None else edges.unionByName(good)
            break
        if not good.isEmpty():
            # between rounds one step towards stars is enough: equal labels are one component, though
            # sets of one component may still have several, and meet again
            edges = stars(good if edges is None else edges.unionByName(good), BETWEEN)
            found = written(labelled(edges), "components")
    return None if edges is None else written(components(edges), "components")


def _judged(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for each row of ``docs``."""
    spark = prepare(docs.sparkSession)
    whole = F.col(text).cast("string")
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("text_hash"))
    made = written(map_texts(narrow, "text", _signed, "n_shingles long, set_a long, set_b long, signature binary", keep=["doc_id", "text_hash"]), "signatures")
    usable = made.where("doc_id IS NOT NULL AND n_shingles > 0")
    named = usable.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("id"))
    named = written(named, "classes")
    keyed = named.select(F.col("id").alias("doc_id"), "set_a", "set_b", "n_shingles")
    on = ["doc_id", "set_a", "set_b", "n_shingles"]
    classes = written(usable.join(keyed, on, "left_semi").dropDuplicates(["doc_id", "set_a", "set_b"]).select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "signature"), "class-signatures")
    found = links(classes, narrow.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text"))
    labelled = named.withColumn("component_id", F.col("id"))
    if found is not None:
        labelled = named.join(found, "id", "left").withColumn("component_id", F.coalesce("component", "id"))
    labelled = labelled.select("set_a", "set_b", "n_shingles", "component_id")
    out = made.drop("signature").join(labelled, ["set_a", "set_b", "n_shingles"], "left")
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(component)
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Documents with equal sets are linked; a null or empty text or one without words is linked
    with nothing. Very long texts are taken whole. Rows that repeat a key get the same results
    each if their texts are equal; a row with a null key is its own component under a null id and
    is kept. An empty table gives no rows. Only key and text are read, so other columns' names do
    not matter.
    """
    return _judged(docs, key, text).drop("text_hash")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates the document with the smallest id stays, once.

    Rows are told apart by id and text. Documents without words, and without an id, all stay; of rows
    that repeat id and text one stays. Texts are compared whole; an empty table stays empty. All
    columns are handed on; the name ``_text_hash`` is taken.
    """
    on = ["doc_id", "_text_hash"]
    judged = written(_judged(docs, "doc_id", "text").withColumnRenamed("text_hash", "_text_hash"), "judged")
    dropped = judged.where("NOT kept").select(on).distinct()
    again = judged.where("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy(on).agg(F.count("*").alias("n")).where("n > 1").select(on)
    left = docs.withColumn("_text_hash", F.xxhash64(F.col("text").cast("string"))).join(dropped, on, "left_anti")
    if again.isEmpty():
        return left.select(docs.columns)
    once = left.join(again, on, "left_anti").unionByName(left.join(again, on, "left_semi").dropDuplicates(on))
    return once.select(docs.columns)
