"""Queries over the driver's tables for the library's own operators, and SQL for each."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.sequences import reverse_complement
from cellweave.operators import extract, matrix, reads, umi
from cellweave.sources.bridge import ALIGNMENTS, LINKER, READS, alignments
from cellweave.sources.bridge import reads as bridge_reads

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

_MATE_POSITION = "length(query_name)"
_COUNTABLE = "(NOT is_paired OR is_read1 OR (is_read2 AND mate_is_unmapped))"


def _ctes(*more: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([f"aln AS ({ALIGNMENTS})", *more]) + "\n"


_FEATURES = """feat AS (SELECT a.*, string_split(gx,';')[i] AS fx, string_split(gn,';')[i] AS fn, i
 FROM aln a, unnest(range(1, least(len(string_split(gx,';')), len(string_split(gn,';'))) + 1)) AS u(i) WHERE gx IS NOT NULL AND gn IS NOT NULL)"""
_COUNTS = "cnts AS (SELECT ref, cb, fx AS gx, fn AS gn, ur, count(*) AS cnt, min({'p': pos, 'r': is_reverse, 'o': align_ordinal}) AS ord FROM feat GROUP BY ALL)"
_PC = "(starts_with({0},{1}) OR starts_with({1},{0}))"


def _near(a: str, b: str) -> str:
    pc = _PC.format
    tail, rest = [f"substr({x},k+2)" for x in (a, b)], [f"substr({x},k+1)" for x in (a, b)]
    inner = f"substr({a},1,k)=substr({b},1,k) AND (length({a})=k OR length({b})=k OR {pc(tail[0], tail[1])} OR {pc(tail[0], rest[1])} OR {pc(rest[0], tail[1])})"
    return f"(abs(length({a})-length({b}))<=1 AND len(list_filter(range(0, least(length({a}),length({b}))+1), lambda k: {inner}))>0)"


def _divergence(a: str, b: str, most: int) -> str:
    """Fewest edits that let either string be used up, as far as ``most`` edits can tell."""
    every = [f"levenshtein({x}, left({y}, greatest(length({y})-{i}, 0)))" for x, y in ((a, b), (b, a)) for i in range(2 * most + 1)]
    return f"CASE WHEN abs(length({a})-length({b}))<={most} THEN least({', '.join(every)}) ELSE 99 END"


_SAME = "a.ref=b.ref AND a.cb=b.cb AND a.gx=b.gx AND a.gn=b.gn"
def _parents(near: str) -> str:
    return f"""par AS (SELECT ref, cb, gx, gn, ur, parent FROM (
 SELECT a.ref, a.cb, a.gx, a.gn, a.ur, b.ur AS parent, row_number() OVER (PARTITION BY a.ref, a.cb, a.gx, a.gn, a.ur ORDER BY b.cnt DESC, b.ord) AS place
 FROM cnts a JOIN cnts b ON {_SAME} AND a.ur<>b.ur AND (b.cnt>a.cnt OR (b.cnt=a.cnt AND b.ord<a.ord)) AND b.cnt>=2*a.cnt-1 AND {near}) WHERE place=1)"""


_PARENTS = _parents(_near("a.ur", "b.ur"))
_ROOTS = """walk AS (SELECT ref, cb, gx, gn, ur, ur AS at FROM cnts UNION ALL
 SELECT w.ref, w.cb, w.gx, w.gn, w.ur, p.parent FROM walk w JOIN par p ON w.ref=p.ref AND w.cb=p.cb AND w.gx=p.gx AND w.gn=p.gn AND w.at=p.ur),
ubs AS (SELECT w.ref, w.cb, w.gx, w.gn, w.ur, w.at AS ub FROM walk w LEFT JOIN par p ON w.ref=p.ref AND w.cb=p.cb AND w.gx=p.gx AND w.gn=p.gn AND w.at=p.ur WHERE p.ur IS NULL)"""
_WHITELIST = "wl AS (SELECT DISTINCT cb AS barcode FROM aln), raws AS (SELECT DISTINCT cr AS raw FROM aln)"


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLE_SQL[name] = sql
        return query

    return keep


def _mapped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = alignments(spark, sf_dir)
    return rows, umi.corrected(umi.umi_counts(rows))


@_query("umi_matrix", _ctes(_FEATURES, _COUNTS, _PARENTS, _ROOTS) + f""", mol AS (
 SELECT f.ref, f.cb, f.fx, f.fn, u.ub, count(*) AS n FROM feat f JOIN feat g ON f.read_no=g.read_no AND g.i=1
 JOIN ubs u ON u.ref=g.ref AND u.cb=g.cb AND u.gx=g.fx AND u.gn=g.fn AND u.ur=g.ur WHERE {_COUNTABLE.replace("is_", "f.is_").replace("mate_f.is", "f.mate_is")} GROUP BY ALL)
 SELECT fx AS gx, fn AS gn, cb, cast(sum(n) as bigint) AS n_reads, count(*) AS n_umis FROM mol GROUP BY ALL""")  # fmt: skip
def umi_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.umi_matrix(umi.apply(*_mapped(spark, sf_dir)))


@_query("read_matrix", _ctes(_FEATURES) + f"SELECT fx AS gx, fn AS gn, cb, count(*) AS n_reads FROM feat WHERE {_COUNTABLE} GROUP BY ALL")
def read_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.read_matrix(alignments(spark, sf_dir))


@_query("umi_matrix_raw", _ctes(_FEATURES) + f""", mol AS (SELECT ref, cb, fx, fn, ur, count(*) AS n FROM feat WHERE {_COUNTABLE} GROUP BY ALL)
 SELECT fx AS gx, fn AS gn, cb, cast(sum(n) as bigint) AS n_reads, count(*) AS n_umis FROM mol GROUP BY ALL""")  # fmt: skip
def umi_matrix_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.umi_matrix(alignments(spark, sf_dir), "ur")


@_query("matrix_axes", _ctes(_FEATURES) + "SELECT 'barcode' AS axis, cb AS label FROM aln UNION SELECT 'feature', fx || chr(9) || fn FROM feat")
def matrix_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.axes(alignments(spark, sf_dir))


@_query("feature_explode", _ctes(_FEATURES) + "SELECT read_no, fx AS gx, fn AS gn FROM feat")
def feature_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.exploded(alignments(spark, sf_dir)).select("read_no", "gx", "gn")


@_query("umi_counts", _ctes(_FEATURES, _COUNTS) + "SELECT * EXCLUDE ord, ord.p AS pos, ord.r AS is_reverse, ord.o AS align_ordinal FROM cnts")
def umi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.umi_counts(alignments(spark, sf_dir)).select(*umi.GROUP, "ur", "cnt", "ord.*")


def _edge_sql(condition: str) -> str:
    return _ctes(_FEATURES, _COUNTS) + f"SELECT a.ref, a.cb, a.gx, a.gn, a.ur AS a, b.ur AS b FROM cnts a JOIN cnts b ON {_SAME} AND a.ur<b.ur AND {condition}"


@_query("umi_edges_freediv", _edge_sql(_near("a.ur", "b.ur")))
def umi_edges_freediv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.edges(umi.umi_counts(alignments(spark, sf_dir)))


@_query("umi_edges_levenshtein", _edge_sql("levenshtein(a.ur, b.ur)<=1"))
def umi_edges_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.edges(umi.umi_counts(alignments(spark, sf_dir)), "levenshtein")


@_query("umi_edges_hamming", _edge_sql("length(a.ur)=length(b.ur) AND hamming(a.ur, b.ur)<=1"))
def umi_edges_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.edges(umi.umi_counts(alignments(spark, sf_dir)), "hamming")


@_query("umi_parents_directional", _ctes(_FEATURES, _COUNTS, _PARENTS) + "SELECT * FROM par")
def umi_parents_directional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.parents(umi.umi_counts(alignments(spark, sf_dir)))


@_query("umi_corrected", _ctes(_FEATURES, _COUNTS, _PARENTS, _ROOTS) + "SELECT * FROM ubs")
def umi_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir)[1]


@_query("umi_edges_freediv_2", _edge_sql(f"{_divergence('a.ur', 'b.ur', 2)}<=2"))
def umi_edges_freediv_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.edges(umi.umi_counts(alignments(spark, sf_dir)), "freediv", 2)


@_query("umi_corrected_2", _ctes(_FEATURES, _COUNTS, _parents("levenshtein(a.ur, b.ur)<=2"), _ROOTS) + "SELECT * FROM ubs")
def umi_corrected_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.corrected(umi.umi_counts(alignments(spark, sf_dir)), "levenshtein", 2)


@_query("umi_undirected", _ctes(_FEATURES, _COUNTS, f"""reach AS (SELECT ref, cb, gx, gn, ur, ur AS at FROM cnts UNION
 SELECT a.ref, a.cb, a.gx, a.gn, a.ur, b.ur FROM reach a JOIN cnts b ON {_SAME} AND a.at<>b.ur AND {_near("a.at", "b.ur")})""")
 + """SELECT r.ref, r.cb, r.gx, r.gn, r.ur, arg_min(c.ur, {'c': -c.cnt, 'o': c.ord, 'u': c.ur}) AS ub FROM reach r
 JOIN cnts c ON c.ref=r.ref AND c.cb=r.cb AND c.gx=r.gx AND c.gn=r.gn AND c.ur=r.at GROUP BY ALL""")  # fmt: skip
def umi_undirected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.undirected(umi.umi_counts(alignments(spark, sf_dir)))


def _decode_sql(within: str, distance: str) -> str:
    return _ctes(_WHITELIST) + f""", near AS (SELECT raw, barcode, CASE WHEN raw=barcode THEN 0 ELSE {distance} END AS d FROM raws, wl WHERE {within}),
 best AS (SELECT raw, min(d) AS d FROM near GROUP BY raw),
 pick AS (SELECT n.raw, CASE WHEN count(*)=1 THEN min(barcode) END AS decoded FROM near n JOIN best b ON n.raw=b.raw AND n.d=b.d GROUP BY n.raw)
 SELECT r.raw, p.decoded FROM raws r LEFT JOIN pick p ON r.raw=p.raw"""


def _decoded(spark: SparkSession, sf_dir: str, distance: str, most: int = 1) -> DataFrame:
    rows = alignments(spark, sf_dir)
    return reads.decode(rows.select(F.col("cr").alias("raw")), rows.select(F.col("cb").alias("barcode")), most, distance)


@_query("whitelist_levenshtein", _decode_sql("levenshtein(raw, barcode)<=1", "levenshtein(raw, barcode)"))
def whitelist_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "levenshtein")


@_query("whitelist_freediv", _decode_sql(_near("raw", "barcode"), "1"))
def whitelist_freediv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "freediv")


@_query("whitelist_levenshtein_2", _decode_sql("levenshtein(raw, barcode)<=2", "levenshtein(raw, barcode)"))
def whitelist_levenshtein_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "levenshtein", 2)


@_query("whitelist_freediv_2", _decode_sql(f"{_divergence('raw', 'barcode', 2)}<=2", f"greatest(1, {_divergence('raw', 'barcode', 2)})"))
def whitelist_freediv_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "freediv", 2)


@_query("whitelist_exact", _ctes(_WHITELIST) + "SELECT raw FROM raws WHERE raw IN (SELECT barcode FROM wl)")
def whitelist_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir)
    return rows.select(F.col("cr").alias("raw")).distinct().join(rows.select(F.col("cb").alias("raw")).distinct(), "raw", "left_semi")


@_query("hamming_pairs", _ctes("b AS (SELECT DISTINCT cr AS s FROM aln)") + "SELECT x.s AS a, y.s AS b, cast(hamming(x.s, y.s) as int) AS d FROM b x JOIN b y ON x.s<y.s AND length(x.s)=length(y.s) AND hamming(x.s,y.s)<=2")
def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.hamming_pairs(alignments(spark, sf_dir).select(F.col("cr").alias("barcode")), 2)


@_query("score_threshold", _ctes() + "SELECT file_pair, round(avg(score) - 2*stddev_pop(score), 6) AS threshold FROM aln WHERE read_no//4<=10000 GROUP BY 1")
def score_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir).withColumn("rec_idx", F.expr("read_no div 4"))
    return reads.score_thresholds(rows).select("file_pair", F.round("threshold", 6).alias("threshold"))


def _tags(rows: DataFrame) -> DataFrame:
    return rows.where("NOT is_read2").select(F.col("query_name").alias("read_id"), "cb", "cr", F.lit(11).alias("fl"), "ur")


_NAME = f"substr(query_name,1,{_MATE_POSITION}-1)"


@_query("name_key_join", _ctes() + f"SELECT a.read_no, t.cb, t.ur FROM aln a JOIN aln t ON {_NAME.replace('query_name', 'a.query_name')}={_NAME.replace('query_name', 't.query_name')} AND NOT t.is_read2")
def name_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir)
    # names differ in length, so the mate's place is counted from the end
    turned = rows.select("read_no", F.reverse("query_name").alias("query_name"))
    tags = _tags(rows).select(F.reverse("read_id").alias("read_id"), "cb", "ur")
    return reads.annotate(turned, tags, [0]).select("read_no", "cb", "ur")


_LINE = "query_name || chr(9) || 'CB:Z:' || cb || chr(9) || 'CR:Z:' || cr || chr(9) || 'FL:i:11' || chr(9) || 'UR:Z:' || ur"


@_query("tag_format", _ctes() + f"SELECT {_LINE} AS line FROM aln WHERE NOT is_read2")
def tag_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.format_tags(_tags(alignments(spark, sf_dir)))


@_query("tag_parse", _ctes() + "SELECT query_name AS read_id, cb, cr, 11 AS fl, ur FROM aln WHERE NOT is_read2")
def tag_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.parse_tags(reads.format_tags(_tags(alignments(spark, sf_dir))))


@_query("tag_merge", _ctes() + "SELECT query_name AS read_id, cb || '.' || cr AS cb, cr || '.' || cb AS cr, ur || '.' || ur AS ur, 22 AS fl FROM aln WHERE NOT is_read2")
def tag_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _tags(alignments(spark, sf_dir))
    second = first.select("read_id", F.col("cr").alias("cb"), F.col("cb").alias("cr"), "fl", "ur")
    return reads.merge_tags(first, second)


@_query("revcomp", _ctes() + "SELECT read_no, translate(reverse(cb || ur),'ACGT','TGCA') AS rc FROM aln")
def revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(spark, sf_dir).select("read_no", reverse_complement(F.concat("cb", "ur")).alias("rc"))


@_query("pair_zip_join", _ctes() + "SELECT cast(x.file_pair//2 as int) AS file_pair, cast(x.read_no//4 as bigint) AS rec_idx, x.cb AS seq_1, y.ur AS seq_2 FROM aln x JOIN aln y ON x.read_no//4=y.read_no//4 AND x.file_pair%2=0 AND y.file_pair=x.file_pair+1")
def pair_zip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir).withColumn("rec_idx", F.expr("read_no div 4"))
    pair = F.expr("cast(file_pair div 2 as int)").alias("file_pair")
    first = rows.where("file_pair % 2 = 0").select(pair, "rec_idx", F.col("cb").alias("seq"))
    second = rows.where("file_pair % 2 = 1").select(pair, "rec_idx", F.col("ur").alias("seq"))
    return reads.pair_reads(first, second)


_LAYOUT = extract.Layout((
    extract.Block("barcodeList", "cellBarcode", tuple("".join("ACGT"[int(c, 16) % 4] for c in hashlib.md5(str(i).encode()).hexdigest()[:8]) for i in range(16))),
    extract.Block("constantRegion", "linker", (LINKER,)),
    extract.Block("randomBarcode", "UMI", length=6),
))
_ALL = " UNION ALL ".join(f"SELECT '{s}' AS barcode" for s in dict.fromkeys(_LAYOUT.blocks[0].sequence))


@_query("barcode_extract", _ctes(f"rd AS ({READS.replace('as string', 'as varchar')})", f"wl AS ({_ALL})") + f""", raws AS (SELECT DISTINCT substr(seq,1,8) AS raw FROM rd),
 near AS (SELECT raw, barcode, levenshtein(raw, barcode) AS d FROM raws, wl WHERE levenshtein(raw, barcode)<=1),
 best AS (SELECT raw, min(d) AS d FROM near GROUP BY raw),
 pick AS (SELECT n.raw, CASE WHEN count(*)=1 THEN min(barcode) END AS cb FROM near n JOIN best b ON n.raw=b.raw AND n.d=b.d GROUP BY n.raw)
 SELECT rec_idx, cast(0.44 as double) AS score, cb, CASE WHEN cb IS NOT NULL THEN substr(seq,1,8) END AS cr, CASE WHEN cb IS NOT NULL THEN 11 END AS fl,
 CASE WHEN cb IS NOT NULL THEN substr(seq,20,6) END AS ur, CASE WHEN cb IS NOT NULL THEN substr(seq,26) END AS trimmed FROM rd LEFT JOIN pick ON raw=substr(seq,1,8)""")  # fmt: skip
def barcode_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(bridge_reads(spark, sf_dir), _LAYOUT)
    return found.select("rec_idx", F.round("score", 6).alias("score"), "cb", "cr", "fl", "ur", "trimmed")
