"""Records of quoted CSV files whose fields hold line breaks, found without reading a
file in one task.

A line starts a record if an even number of quotes comes before it in its file, escaped
quotes being pairs.  The quotes are summed per block of a file, the sums of the blocks are
added up along the file, and then each block finds its own records.  Only what crosses the
border of two blocks, at most two pieces a block, is put together afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.sources.tables import write_scratch


def _joined(pieces):
    return F.array_join(F.transform(F.sort_array(pieces), lambda x: x["text"]), "\n")


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first) for each record under ``path``; ``first`` marks the first of a file.

    Lines end in ``\\n`` or ``\\r\\n``; blank lines between records are skipped.  An empty
    file has no records.  A file with an odd number of quotes is an error, since its records
    cannot be told apart; quotes belong around fields or in pairs inside of them.

    The lines are written once, so that all steps see the same blocks; the pieces are
    written once too, since both kinds of them are read."""
    lines = write_scratch(
        spark.read.option("lineSep", "\n").text(path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            F.col("value").alias("text"),
            (F.length("value") - F.length(F.translate("value", '"', ""))).alias("quotes"),
        ),
        "csv-lines",
    )
    whole = Window.partitionBy("file")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("n")).select(
        "file", "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        (F.sum("n").over(whole) % 2 == 1).alias("broken"),
    )
    along = Window.partitionBy("file", "block").orderBy("line")
    above = F.coalesce(F.sum("quotes").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ~F.col("inside")
    marked = (
        lines.join(blocks, ["file", "block"])
        .withColumn("inside", (F.col("before") + above) % 2 == 1)
        .filter(F.col("inside") | ~F.col("text").isin("", "\r"))
        .withColumn("no", F.sum(starts.cast("long")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    )
    # number 0 is the end of a record of an earlier block; an open record goes on in the next
    pieces = write_scratch(
        marked.groupBy("file", "block", "no").agg(
            _joined(F.collect_list(F.struct("line", "text"))).alias("text"),
            ((F.col("no") == 0) | (F.sum("quotes") % 2 == 1)).alias("loose"),
            F.max("broken").alias("broken"),
        ),
        "csv-pieces",
    )
    order = whole.orderBy("block", "no").rowsBetween(Window.unboundedPreceding, 0)
    glued = (
        pieces.filter("loose")
        .withColumn("home", F.sum((F.col("no") > 0).cast("long")).over(order))
        .groupBy("file", "home")
        .agg(
            _joined(F.collect_list(F.struct("block", "no", "text"))).alias("text"),
            F.min(F.struct("block", "no")).alias("at"),
            F.max("broken").alias("broken"),
        )
        .select("file", "at.block", "at.no", "text", "broken")
    )
    found = pieces.filter("not loose").select(glued.columns).union(glued)
    odd = F.raise_error(F.concat(F.lit("odd number of quotes in "), F.col("file"))).cast("string")
    return found.select(
        F.when(F.col("broken"), odd).otherwise(F.regexp_replace("text", "\r\\z", "")).alias("record"),
        ((F.col("block") == 0) & (F.col("no") == 1)).alias("first"),
    )
