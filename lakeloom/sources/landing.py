"""Landing zone: CSV extracts read as text only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.sources import paths


def landing_tables(spark: SparkSession, landing: str, wanted: Iterable[str]) -> list[str]:
    """The wanted names, or every extract in the folder for ``all``."""
    wanted = list(wanted)
    if "all" not in wanted:
        return wanted
    return [name.removesuffix(".csv") for name in paths.names(spark, f"{landing}/*.csv")]


# Extracts without free text: no value holds a line break, so Spark may split their files.
ONE_LINE_A_ROW = {"customers", "sellers", "products", "categories", "geolocation", "orders", "order_items", "payments"}


def read_landing(spark: SparkSession, landing: str, table: str, line_breaks: bool | None = None) -> DataFrame:
    """All columns as text: ``NA`` is text, quoted line breaks stay inside their value.

    A file that may hold line breaks inside values is one task; Spark splits large files of extracts known
    to have none, or those that ``line_breaks`` says have none.
    """
    line_breaks = table not in ONE_LINE_A_ROW if line_breaks is None else line_breaks
    path = f"{landing}/{table}.csv"
    if not paths.exists(spark, path):
        raise FileNotFoundError(path)
    extract = spark.read.csv(path, header=True, inferSchema=False, multiLine=line_breaks, quote='"', escape='"')
    return extract.na.fill("")  # a blank is text too; silver decides that it means nothing


def write_landing(df: DataFrame, landing: str, table: str) -> None:
    """CSV extract in the dialect ``read_landing`` expects."""
    df.write.mode("overwrite").csv(
        f"{landing}/{table}.csv",
        header=True,
        quote='"',
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
