"""CSV with line breaks inside quoted values, read by as many tasks as the file has blocks.

Whether a line break ends a record depends on the quotes before it in the file: an even number means it does. Each
block counts its own quotes, a running sum over the blocks of a file tells every block how it begins, and a line then
needs the lines of its own block only. Lines that are a record each stay where they are; the others are put together
by the position of their first line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_FILE = ["file", "block"]
_DIALECT = {"quote": '"', "escape": '"', "multiLine": "true"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: file, block, number within the block, and the quotes of the block before them."""
    read = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    counted = read.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    in_block = Window.partitionBy(*_FILE).orderBy("id")
    before = F.coalesce(F.sum("quotes").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted.withColumns({"line": F.row_number().over(in_block), "before": before})


def _blocks(lines: DataFrame) -> DataFrame:
    """How each block begins: inside a value or not, and the line that opened the record it continues."""
    own = lines.groupBy(*_FILE).agg(
        F.sum("quotes").alias("quotes"),
        F.max(F.when(F.col("before") % 2 == 0, F.col("line"))).alias("opened_if_even"),
        F.max(F.when(F.col("before") % 2 == 1, F.col("line"))).alias("opened_if_odd"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    opened = F.when(F.col("odd") == 0, F.col("opened_if_even")).otherwise(F.col("opened_if_odd"))
    place = F.when(opened.isNotNull(), F.struct("block", opened.alias("line")))
    return own.withColumn("odd", odd).select(*_FILE, "odd", F.last(place, ignorenulls=True).over(earlier).alias("open"))


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, equal to the multi-line reader of Spark on well-formed files.

    A blank or missing value is empty text. The first record of every file is its header; files have the same columns.
    Line breaks inside values are kept. A quote that never closes makes one record of the rest of its file, as it does
    in any reader; everything else is bounded by a block.
    """
    columns = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=True).columns
    schema = ", ".join(f"`{name}` string" for name in columns)
    lines = _lines(spark, path)
    in_block = Window.partitionBy(*_FILE).orderBy("id")
    starts = (F.col("before") + F.col("odd")) % 2 == 0
    started = F.last(F.when(starts, F.struct("block", "line")), ignorenulls=True).over(in_block)
    placed = lines.join(_blocks(lines), _FILE).withColumns({"starts": starts, "record": F.coalesce(started, "open")})
    header = (F.col("record.block") == 0) & (F.col("record.line") == 1)
    body = placed.where(~header)
    alone = F.col("starts") & (F.col("quotes") % 2 == 0)
    pieces = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = body.where(~alone).groupBy("file", "record").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value"))
    records = body.where(alone).select("value").unionByName(joined.select("value"))
    texts = records.select(F.regexp_replace("value", "\r$", "").alias("value")).where("value <> ''")
    parsed = texts.select(F.from_csv("value", schema, _DIALECT).alias("r"))
    return parsed.select("r.*").na.fill("")
