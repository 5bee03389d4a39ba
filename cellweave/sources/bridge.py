"""Alignment records derived from the ``events`` table, by SQL that other engines read too.

Sequences come from digests, so that any engine derives the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def dna(expression: str, n: int) -> str:
    """SQL for ``n`` letters that depend on an expression's value."""
    return f"translate(substr(md5(cast({expression} as string)),1,{n}),'0123456789abcdef','ACGTACGTACGTACGT')"


_UR = dna("event_id % 40", 6)
_CB = dna("user_id % 16", 8)

#: One alignment for each event: some UMIs and barcodes with a letter exchanged, some reads with
#: two features, none, or lists of unequal length, mates mapped and unmapped. Many alignments
#: share a position and UMIs share counts, so strands and ordinals decide ties.
ALIGNMENTS = f"""
SELECT event_id AS read_no,
  'run.' || cast(event_id as string) || '/' || CASE WHEN event_id % 4 = 2 THEN '2' ELSE '1' END AS query_name,
  'chr' || cast(event_id % 3 as string) AS ref, cast(floor(event_id / 50) as bigint) % 4 AS pos, cast(floor(event_id / 7) as bigint) % 3 = 1 AS is_reverse, event_id AS align_ordinal,
  event_id % 2 = 0 AS is_paired, event_id % 4 = 0 AS is_read1, event_id % 4 = 2 AS is_read2, event_id % 8 = 2 AS mate_is_unmapped,
  {_CB} AS cb,
  CASE WHEN event_id % 9 = 0 THEN substr({_CB},1,3) || translate(substr({_CB},4,1),'ACGT','CGTA') || substr({_CB},5) ELSE {_CB} END AS cr,
  CASE WHEN event_id % 7 = 0 THEN translate(substr({_UR},1,1),'ACGT','CGTA') || substr({_UR},2)
       WHEN event_id % 11 = 0 THEN substr({_UR},1,5) ELSE {_UR} END AS ur,
  CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 5 = 0 THEN event_type || ';extra;more' ELSE event_type END AS gx,
  CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 5 = 0 THEN upper(event_type) || ';EXTRA' ELSE upper(event_type) END AS gn,
  cast(event_id % 4 as int) AS file_pair, value AS score
FROM events
"""


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value")
    return spark.sql(ALIGNMENTS.replace("FROM events", "FROM {events}"), events=events)


LINKER = "GATTACAGATC"

#: One read for each event: raw barcode, linker, a UMI of six letters, and more letters.
READS = f"SELECT read_no AS rec_idx, file_pair, cr || '{LINKER}' || ur || {dna('read_no', 30)} AS seq FROM aln"


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(READS.replace("FROM aln", "FROM {aln}"), aln=alignments(spark, sf_dir))


#: A second constant, of another length, and barcodes of a second list.
OTHER_LINKER = "CCGTTGGACCATG"
_SECOND = f"({dna('(event_id % 13) + 1000', 3)} || 'CAGTC')"

#: Two mates for each event, in two pairs of files. ``kind`` tells what was done to the parts: 0
#: nothing, 1 a letter of the linker gone, 2 one put into it, 3 a letter of the barcode gone, 4
#: the other linker, 5 (in the table of mates also 6 to 9: nothing) a letter of the linker exchanged.
KINDS = f"""
SELECT read_no, cast(read_no % 2 as int) AS file_pair, cast(floor(read_no / 2) as bigint) AS rec_idx, 'r' || lpad(cast(read_no as string), 12, '0') AS name, kind, cb, cr, ur, second, seconds,
  CASE WHEN kind = 3 THEN substr(cr,1,3) || substr(cr,5) ELSE cr END AS raw,
  CASE kind WHEN 1 THEN 'GATTAAGATC' WHEN 2 THEN 'GATCTACAGATC' WHEN 4 THEN '{OTHER_LINKER}' WHEN 5 THEN 'GATTATAGATC' ELSE '{LINKER}' END AS linker,
  {dna("read_no", 30)} AS tail, {dna("read_no + 77777", 25)} AS other
FROM (SELECT read_no, cb, cr, CASE WHEN length(ur) = 6 THEN ur ELSE ur || 'C' END AS ur, read_no % 10 AS kind,
  {_SECOND.replace("event_id", "read_no")} AS second,
  CASE WHEN read_no % 5 = 0 THEN substr({_SECOND.replace("event_id", "read_no")},1,2) || substr({_SECOND.replace("event_id", "read_no")},4) ELSE {_SECOND.replace("event_id", "read_no")} END AS seconds
  FROM aln)
"""


def kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(KINDS.replace("FROM aln", "FROM {aln}"), aln=alignments(spark, sf_dir))
