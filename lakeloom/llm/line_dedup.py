"""Line dedup by site-relative frequency.

Pages are grouped by host. The pages that contain a line, divided by the pages of the host, give the line's
ratio; a line beyond the boilerplate ratio is dropped from every page of that host.

Only two hash numbers a distinct line and page are shuffled, summed up before; texts stay where they are.
What is dropped comes back as one list a host. Its length is bounded: with r the ratio and d the mean number of
distinct lines a page of that host, no more than d / r lines can pass. The lists are written first, so Spark
knows their size and broadcasts them only below its threshold; beyond it the join by host is one whose
hot hosts adaptive execution splits.

Lines are compared without the white space around them, by 128 bits of hash. Lines of white space alone are
never counted or dropped. A line that a page repeats counts once for the page.

Defined results: a NULL text stays NULL and counts as a page; a NULL host has no site to be relative to,
so its pages are left as they are. Repeated rows are pages of their own. A page of dropped lines only
becomes an empty text. An empty table gives an empty result. Extra columns are kept; one of the name
of a counter goes on with an underscore before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import SPACE_CHARS, beside, free_name, written

# Where shared passages are; lines that only copies of one page have in common stay below it.
MAX_RATIO = 0.01
# A line on fewer pages than this is never boilerplate: the ratio of a small site says too little.
MIN_PAGES = 5


def _stripped(line: Column) -> Column:
    return F.trim(line, F.lit(SPACE_CHARS))


def _key(line: Column) -> Column:
    """128 bits of a line; NULL for one of white space."""
    bare = _stripped(line)
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b")))


def boilerplate(
    df: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, pages, lines): by host the hashes of its boilerplate lines; hosts without any are absent."""
    pages = df.select(F.col(host).alias("host"), F.col(text).alias("text")).where(F.col("host").isNotNull())
    keys = F.array_distinct(F.transform(F.split("text", "\n"), _key))
    lines = pages.select("host", F.explode(keys).alias("line")).where(F.col("line").isNotNull())
    counts = lines.select("host", "line.a", "line.b").groupBy("host", "a", "b").agg(F.count("*").alias("with_line"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    return (
        counts.where(F.col("with_line") >= min_pages)
        .join(totals, "host")
        .where(F.col("with_line") > max_ratio * F.col("pages"))
        .groupBy("host", "pages")
        .agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("lines"))
    )


def drop_boilerplate(
    df: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    counters: tuple[str, str] | None = None,
) -> DataFrame:
    """The rows with their texts cleaned; ``counters`` names two more columns, lines before and lines dropped."""
    names = {k: free_name(df.columns, f"__{k}") for k in ("host", "found", "parts", "shared", "left")}
    found = written(boilerplate(df, host, text, max_ratio, min_pages), "boilerplate")
    found = found.select(F.col("host").alias(names["host"]), F.col("lines").alias(names["found"]))
    parts, shared, left, listed = (F.col(names[k]) for k in ("parts", "shared", "left", "found"))
    # What a page shares with the list of its host: for most pages nothing, and then its text stays as it is.
    # Being asked for twice, it is computed once and not again for each line.
    has_some = F.coalesce(F.size(shared) > 0, F.lit(False))
    own = F.filter(parts, lambda line: ~F.coalesce(F.array_contains(shared, _key(line)), F.lit(False)))
    rows = (
        df.join(found, F.col(host) == F.col(names["host"]), "left")
        .withColumn(names["parts"], F.split(F.col(text), "\n"))
        .withColumn(names["shared"], F.array_intersect(F.transform(parts, _key), listed))
        .withColumn(names["left"], F.when(has_some, own))
    )
    cleaned = F.coalesce(F.array_join(left, "\n"), F.col(text))
    kept = zip(beside(df.columns, counters or ()), df.columns, strict=True)
    out = [(cleaned if c == text else df[c]).alias(name) for name, c in kept]
    if counters:
        lines = F.greatest(F.size(parts), F.lit(0)).cast("long")
        dropped = F.when(left.isNotNull(), lines - F.size(left)).otherwise(0).cast("long")
        out += [lines.alias(counters[0]), dropped.alias(counters[1])]
    return rows.select(*out)
