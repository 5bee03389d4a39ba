"""Secrets in texts, and who owns them: widely copied examples against owner-specific credentials.

DataFrame functions only. Each pattern is matched together with the characters before it, so
the lengths of gaps and matches give places in code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.skew import split_join
from cellweave.session import prepare, written

#: Fixed by the contract: kind, pattern, group that holds the secret, least length of that group.
PATTERNS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 8),
    ("access", r"AKIA[A-Z0-9]+", False, 16),
    ("hex", r"[0-9a-f]+", False, 32),
)
#: What a text must hold for the pattern to give a match long enough.
NEEDS = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}"}
#: A candidate seen with so many owners, or in so many repositories, is a copied example.
OWNERS, REPOSITORIES = 3, 20
LIVE = "live"
#: What the pipeline puts in the place of a live secret, and of a copied example.
MASK, COPIED_MASK = "[SECRET]", "[EXAMPLE]"

_SPAN = "struct<start:bigint,end:bigint,value:string>"
#: Code points of a block of a text.
BLOCK = 4096


def folded(items: Column, first: Column, state: str, made: str, step: Callable[[Column, Column], tuple[Column, Column, Column]]) -> Column:
    """(made, state) after ``step`` has gone over an array: it gives the next state, whether something is made, and what.

    A fold copies what it has made whenever it adds to it. So parts of about the square root of
    the array's length are folded one after another, and their results joined once: an array of a
    hundred thousand is copied some hundred times, not a hundred thousand times.
    """
    inner = f"struct<s:{state},found:array<{made}>>"
    outer = f"struct<done:array<array<{made}>>,last:{inner}>"
    none = F.array().cast(f"array<{made}>")

    def one(acc: Column, x: Column) -> Column:
        following, is_made, what = step(acc["s"], x)
        found = F.when(is_made, F.concat(acc["found"], F.array(what.cast(made)))).otherwise(acc["found"])
        return F.struct(following.cast(state).alias("s"), found.alias("found")).cast(inner)

    def part(acc: Column, chunk: Column) -> Column:
        begun = F.struct(acc["last"]["s"].alias("s"), none.alias("found")).cast(inner)
        return F.struct(F.concat(acc["done"], F.array(acc["last"]["found"])).alias("done"), F.aggregate(chunk, begun, one).alias("last")).cast(outer)

    def whole(z: Column) -> Column:
        size = (F.floor(F.sqrt(F.size(z))) + 1).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), F.floor(F.size(z) / size).cast("int")), lambda k: F.slice(z, k * size + 1, size))
        begun = F.struct(F.array().cast(f"array<array<{made}>>").alias("done"), F.struct(first.cast(state).alias("s"), none.alias("found")).alias("last")).cast(outer)
        return F.aggregate(chunks, begun, part, lambda acc: F.struct(F.flatten(F.concat(acc["done"], F.array(acc["last"]["found"]))).alias("made"), acc["last"]["s"].alias("state")))

    return _bound(items, whole)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _matches(text: Column, kind: str, pattern: str, grouped: bool, least: int) -> Column:
    """Start, end and secret of the matches of one kind whose secret is long enough."""
    # the last alternative takes the rest of the text, so that no place is tried twice;
    # short runs of hexadecimal digits are left in the gaps, where they come to the same
    body = {"hex": r"[0-9a-f]{32,}", "access": r"AKIA[A-Z0-9]{12,}"}.get(kind, pattern)
    if kind == "hex":
        gap = r"(?s)((?:[^0-9a-f]++|[0-9a-f]{1,31}+(?![0-9a-f]))*+)"
    else:
        gap = r"(?s)(.*?)"
    whole = F.lit(f"{gap}({body}|\\z)")
    parts = [F.regexp_extract_all(text, whole, F.lit(i)) for i in ((1, 2, 3) if grouped else (1, 2, 2))]
    zipped = F.arrays_zip(*(p.alias(n) for p, n in zip(parts, ("gap", "hit", "value"), strict=True)))

    def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
        begin = at + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        return end, F.length(x["value"]) >= least, F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"))

    found = folded(zipped, F.lit(0), "bigint", _SPAN, step)["made"]
    return F.when(text.rlike(NEEDS[kind]), found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _named(found: Column, kind: str, order: int) -> Column:
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), F.lit(order).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"),
    ))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def base_spans(text: Column) -> Column:
    """Array of (start, rank, end, kind, value) of the base patterns; a null text has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.flatten(F.array(*(_named(_matches(text, kind, pattern, grouped, least), kind, i) for i, (kind, pattern, grouped, least) in enumerate(PATTERNS))))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories, n_rows, copied) of rows (hash, owner, repository).

    Equal pairs are merged before they are moved, so a secret that a third of all rows hold
    is one row a task.
    """
    owners = candidates.select("hash", "owner").distinct().groupBy("hash").agg(F.count("owner").alias("n_owners"))
    repositories = candidates.select("hash", "repository").distinct().groupBy("hash").agg(F.count("repository").alias("n_repositories"))
    both = owners.join(repositories, "hash").join(candidates.groupBy("hash").agg(F.count("*").alias("n_rows")), "hash")
    return both.withColumn("copied", (F.col("n_owners") >= OWNERS) | (F.col("n_repositories") >= REPOSITORIES))


def _found(docs: DataFrame, key: str, text: str, owner: str, repository: str) -> DataFrame:
    """(doc_id, owner, repository, text_hash, spans) of each row."""
    return docs.select(
        F.col(key).alias("doc_id"), F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"),
        F.xxhash64(F.col(text).cast("string")).alias("text_hash"), base_spans(F.col(text)).alias("spans"),
    )


def _known(found: DataFrame) -> DataFrame:
    """(hash, doc_id, text_hash, s, n_owners, n_repositories, n_rows, copied): each span with its secret's verdict.

    Spans of a secret that many rows hold are dealt over several tasks.
    """
    each = found.where(F.size("spans") > 0).select("doc_id", "text_hash", "owner", "repository", F.explode("spans").alias("s"))
    each = each.withColumn("hash", F.sha2(F.col("s.value"), 256))
    owned = written(ownership(each.select("hash", "owner", "repository")), "secret-owners")
    return split_join(each.select("doc_id", "text_hash", "s", "hash").distinct(), owned, ["hash"], "n_rows")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Secrets of each row of ``docs``.

    Base spans of every row stay as they are; a span ``live`` is added at each secret that is
    specific to few owners and repositories in the whole corpus. Rows that repeat key and text
    get the same results each; null keys, owners and repositories are allowed and count as no
    owner or repository. Null and empty texts have no spans, an empty table no rows. Texts are
    taken whole, and work grows with their length and their number of spans. Only the four
    named columns are read, so other columns' names do not matter.
    """
    prepare(docs.sparkSession)
    found = written(_found(docs, key, text, owner, repository), "secret-spans")
    known = _known(found)
    live = F.struct(
        (F.col("s.end") - F.length("s.value")).alias("start"), F.lit(len(PATTERNS)).alias("rank"), F.col("s.end").alias("end"), F.lit(LIVE).alias("kind"), F.col("s.value").alias("value"),
    )
    added = known.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.when(~F.col("copied"), live)).alias("live"),
        F.count_if("copied").alias("n_copied"), F.max("n_owners").alias("most_owners"),
    )
    added = added.withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_text_hash"})
    out = found.join(added, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash")), "left")
    kinds = [_count("spans", kind).alias(f"n_{kind}") for kind, *_ in PATTERNS]
    every = F.when(F.col("live").isNull(), F.col("spans")).otherwise(F.concat("spans", "live"))
    return out.select(
        "doc_id", *kinds, F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"), _listed(every).alias("spans"),
        F.coalesce(F.size("live"), F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
        F.coalesce("most_owners", F.lit(0)).cast("long").alias("most_owners"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def masked(text: Column, spans: Column) -> Column:
    """The text with each of its ``spans`` (start, end, copied) replaced; overlapping spans are replaced together.

    A replaced place that holds a live secret gets ``MASK``, any other ``COPIED_MASK``. Texts are
    cut into blocks once, since a place in a long text is found by counting from its start.
    """

    def made(z: Column) -> Column:
        def between(begin: Column, end: Column) -> Column:
            def piece(b: Column) -> Column:
                low = F.greatest(begin - b * BLOCK, F.lit(0))
                return F.substr(F.get(z["blocks"], b.cast("int")), (low + 1).cast("int"), (F.least(end - b * BLOCK, F.lit(BLOCK)) - low).cast("int"))

            every = F.sequence(F.floor(begin / BLOCK), F.floor((end - 1) / BLOCK))
            return F.when(end > begin, F.array_join(F.transform(every, piece), "")).otherwise("")

        def step(state: Column, x: Column) -> tuple[Column, Column, Column]:
            apart = x["start"] >= state["at"]
            live = ~x["copied"] | (~apart & (state["mark"] == MASK))
            after = F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.when(live, F.lit(MASK)).otherwise(F.lit(COPIED_MASK)).alias("mark"))
            return after, apart, F.concat(state["mark"], between(state["at"], x["start"]))

        first = F.struct(F.lit(0).alias("at"), F.lit("").alias("mark"))
        found = folded(F.array_sort(z["spans"]), first, "struct<at:bigint,mark:string>", "string", step)
        return _bound(found, lambda f: F.concat(F.array_join(f["made"], ""), f["state"]["mark"], between(f["state"]["at"], z["n"])))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return _bound(F.struct(blocks.alias("blocks"), spans.alias("spans"), F.length(text).cast("bigint").alias("n")), made)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Pipeline stage: every document stays, its secrets masked and its length brought up to date.

    What owners and repositories in all of ``docs`` say of a secret decides its mark: nothing
    that looks like a secret stays, and live secrets are told from copied examples. Spans are found
    once and written beside the rows; only documents that hold a secret are moved.

    Null and empty texts stay as they are; null keys and sources count as no repository and
    owner; rows that repeat stay, each masked; an empty table stays empty. Other columns are handed
    on, but names that begin with ``_cw_`` are taken. Work grows with a text's length and its number
    of spans.
    """
    spans, text_hash = base_spans(F.col("text")), F.xxhash64(F.col("text").cast("string"))
    rows = written(docs.withColumns({"_cw_spans": spans, "_cw_hash": text_hash}), "secret-rows")
    holds = F.size("_cw_spans") > 0
    found = rows.where(holds).select(
        "doc_id", F.col("source").cast("string").alias("owner"), F.col("doc_id").cast("string").alias("repository"),
        F.col("_cw_hash").alias("text_hash"), F.col("_cw_spans").alias("spans"),
    )
    verdict = F.struct("s.start", "s.rank", "s.end", "copied")
    judged = _known(found).groupBy(F.col("doc_id").alias("_cw_id"), F.col("text_hash").alias("_cw_text")).agg(F.collect_set(verdict).alias("_cw_judged"))
    held = rows.where(holds).join(judged, F.col("doc_id").eqNullSafe(F.col("_cw_id")) & (F.col("_cw_hash") == F.col("_cw_text")))
    out = held.withColumn("text", masked(F.col("text"), F.col("_cw_judged"))).select(docs.columns).unionByName(rows.where(~holds).select(docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
