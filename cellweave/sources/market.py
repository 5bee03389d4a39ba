"""Count matrices as Matrix Market text with their axes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.matrix import axes
from cellweave.session import written
from cellweave.sources.files import exists, write_text

DONE = "_COMPLETE"


def numbered(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` (distinct in ``by``) with ``place``: 1 for the least, without gaps.

    Rows are dealt by range; only the number of rows of each range meets in one place.
    """
    ranged = written(rows.repartitionByRange(by).withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("part").orderBy(by))
    return ranged.join(sizes.select("part", before.alias("before")), "part").withColumn("place", (own + F.col("before")).cast("long")).drop("part", "before")


def lines(counts: DataFrame, value: str, features: DataFrame, barcodes: DataFrame) -> DataFrame:
    """(row, column, n) of ``counts`` (gx, gn, cb, value) by the axes' places."""
    labelled = counts.select(F.concat_ws("\t", "gx", "gn").alias("feature"), "cb", F.col(value).alias("n"))
    placed = labelled.join(features.select(F.col("label").alias("feature"), F.col("place").alias("row")), "feature")
    return placed.join(barcodes.select(F.col("label").alias("cb"), F.col("place").alias("column")), "cb").select("row", "column", "n")


def write(counts: dict[str, DataFrame], alignments: DataFrame, folder: str, value: dict[str, str]) -> None:
    """For each name a folder with matrix.mtx.gz, barcodes.tsv.gz and features.tsv.gz.

    Each is a folder of gzipped parts whose concatenation, by name, is the file: no task or
    driver holds a whole matrix. A matrix with its ``_COMPLETE`` mark is left as it is; one
    without is what a broken run left, and is written anew.
    """
    counts = {n: rows for n, rows in counts.items() if not exists(f"{folder}/{n}/{DONE}")}
    if not counts:
        return
    every = written(axes(alignments), "axes")
    features = written(numbered(every.where("axis = 'feature'").select("label"), "label"), "features")
    barcodes = written(numbered(every.where("axis = 'barcode' AND label IS NOT NULL").select("label"), "label"), "barcodes")
    n_rows, n_columns = features.count(), barcodes.count()
    spark = alignments.sparkSession
    for name, rows in counts.items():
        found = written(lines(rows, value[name], features, barcodes), "entries")
        head = spark.createDataFrame([(0, 0, f"%%MatrixMarket matrix coordinate integer general\n%\n{n_rows} {n_columns} {found.count()}")], "column long, row long, value string")
        body = found.select("column", "row", F.concat_ws(" ", F.col("row").cast("string"), F.col("column").cast("string"), F.col("n").cast("string")).alias("value"))
        texts = {
            "matrix.mtx.gz": head.unionByName(body).repartitionByRange("column", "row").sortWithinPartitions("column", "row"),
            "barcodes.tsv.gz": barcodes.select("place", F.col("label").alias("value")).repartitionByRange("place").sortWithinPartitions("place"),
            "features.tsv.gz": features.select("place", F.concat("label", F.lit("\tGene Expression")).alias("value")).repartitionByRange("place").sortWithinPartitions("place"),
        }
        for file, text in texts.items():
            text.select("value").write.mode("overwrite").option("compression", "gzip").text(f"{folder}/{name}/{file}")
        write_text(f"{folder}/{name}/{DONE}", "")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(gx, gn, cb, n) of a matrix that :func:`write` wrote; one without its mark is an error."""
    if not exists(f"{folder}/{DONE}"):
        raise FileNotFoundError(f"{folder} is unfinished")

    def axis(file: str) -> DataFrame:
        lines = spark.read.text(f"{folder}/{file}").withColumn("part", F.col("_metadata.file_name")).withColumn("line", F.monotonically_increasing_id())
        sizes = lines.groupBy("part").agg(F.count("*").alias("size"))
        before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        own = F.row_number().over(Window.partitionBy("part").orderBy("line"))
        return lines.join(sizes.select("part", before.alias("before")), "part").select("value", (own + F.col("before")).cast("long").alias("place"))

    # after its comment the first line has the matrix's sizes, in the part that sorts first
    entry = F.split("value", " ")
    rows = spark.read.text(f"{folder}/matrix.mtx.gz").where("value RLIKE '^[0-9]+ [0-9]+ [0-9]+$'").withColumns({"part": F.col("_metadata.file_name"), "line": F.monotonically_increasing_id()})
    rows = rows.select("part", "line", entry[0].cast("long").alias("row"), entry[1].cast("long").alias("column"), entry[2].cast("long").alias("n"))
    first = rows.agg(F.min(F.struct("part", "line")).alias("f")).select("f.*")
    rows = rows.join(F.broadcast(first), ["part", "line"], "left_anti")
    features = axis("features.tsv.gz").select(F.split("value", "\t").alias("f"), F.col("place").alias("row"))
    cells = axis("barcodes.tsv.gz").select(F.col("value").alias("cb"), F.col("place").alias("column"))
    return rows.join(features, "row").join(cells, "column").select(F.col("f")[0].alias("gx"), F.col("f")[1].alias("gn"), "cb", "n")
