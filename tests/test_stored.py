"""Split extracts, deliveries, stored distinct counts and medians."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import stored
from lakeloom.plans import requirements as R
from lakeloom.sources import deliveries, landing, split_csv

AWKWARD = [
    'plain,"one, two",3',
    '"line\nbreak","say ""hi""",',
    '"","\n\n","a\r\nb"',
    '"""\n""",x,y',
    "",
    '"' + "long line\n" * 400 + '",after,it',
    "NA, padded ,é",
]


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_split_file_equals_the_multi_line_reader(spark, tmp_path, small_blocks, end):
    folder = tmp_path / "reviews.csv"
    folder.mkdir()
    for part in range(3):
        body = end.join(["a,b,c", *(row.replace("plain", f"plain{part}.{i}") for i in range(60) for row in AWKWARD)])
        (folder / f"part{part}.csv").write_bytes((body + end * part).encode())
    whole = landing.read_landing(spark, str(tmp_path), "reviews")
    split = split_csv.read_split(spark, str(folder))
    assert split.columns == whole.columns
    assert spark.read.text(str(folder), lineSep="\n").rdd.getNumPartitions() > 8
    # The multi-line reader of Spark writes line breaks inside values as \n, this one as they are.
    plain = [F.replace(c, F.lit("\r\n"), F.lit("\n")).alias(c) for c in "abc"]
    assert sorted_rows(split.select(plain)) == sorted_rows(whole.select(plain))


def test_a_split_file_of_a_header_alone_is_empty(spark, tmp_path):
    (tmp_path / "x.csv").write_text('"a\nb",c\n')
    assert split_csv.read_split(spark, str(tmp_path / "x.csv")).count() == 0


def deliver(folder, name, rows, header="id,v"):
    os.makedirs(folder / "landing" / "orders", exist_ok=True)
    (folder / "landing" / "orders" / name).write_text("\n".join([header, *rows]) + "\n")


def run(spark, folder):
    return deliveries.ingest_new(spark, f"{folder}/landing", f"{folder}/bronze", "orders", f"{folder}/checkpoint")


def test_files_are_taken_once_under_their_own_names(spark, tmp_path):
    deliver(tmp_path, "monday.csv", ["1,a", "2,"])
    assert run(spark, tmp_path) == 1
    deliver(tmp_path, "tuesday.csv", ["1,b"])
    assert run(spark, tmp_path) == 2
    assert run(spark, tmp_path) == 2
    bronze = spark.read.parquet(f"{tmp_path}/bronze/orders")
    named = bronze.select("id", "v", "load", F.substring_index("_source_file", "/", -1))
    assert sorted_rows(named) == [("1", "a", 0, "monday.csv"), ("1", "b", 1, "tuesday.csv"), ("2", "", 0, "monday.csv")]
    assert bronze.where("_ingested_at < _delivered_at or _ingested_at is null").isEmpty()


def test_a_load_that_died_after_writing_is_repeated_in_place(spark, tmp_path):
    deliver(tmp_path, "monday.csv", ["1,a"])
    run(spark, tmp_path)
    taken = spark.read.parquet(f"{tmp_path}/bronze/orders").first()["_ingested_at"]
    for mark in ("0", ".0.crc"):
        if os.path.exists(tmp_path / "checkpoint" / "commits" / mark):
            os.remove(tmp_path / "checkpoint" / "commits" / mark)
    assert run(spark, tmp_path) == 1
    assert [r["_ingested_at"] for r in spark.read.parquet(f"{tmp_path}/bronze/orders").collect()] == [taken]


def test_a_delivery_with_other_columns_stops_the_run(spark, tmp_path):
    deliver(tmp_path, "monday.csv", ["1,a"])
    run(spark, tmp_path)
    deliver(tmp_path, "tuesday.csv", ["b,1"], header="v,id")
    with pytest.raises(Exception, match="(?i)header"):
        run(spark, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/bronze/orders").count() == 1


def test_freshness_takes_the_first_moment_of_a_day(spark):
    audited = spark.sql(
        """select timestamp(at) as _ingested_at from values ('2026-01-02 06:00:00'), ('2026-01-02 09:00:00'),
           ('2026-01-03 07:30:00'), (null) as t(at)"""
    )
    days = spark.sql("select explode(sequence(date '2026-01-01', date '2026-01-03')) as day")
    assert R.freshness(days, deliveries.load_moments(audited)).first()[:3] == ("2026-Q1", 3, 1)


def test_members_keep_their_numbers_and_later_days_only_add(spark, tmp_path):
    def day(n, first, last):
        return spark.range(first, last).select(F.lit(n).alias("day"), F.col("id").cast("string").alias("who"))

    def saved(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    nobody = spark.sql("select 3 as day, cast(null as string) as who")
    first, second = day(1, 0, 50_000), day(2, 40_000, 90_000).unionByName(nobody)
    members = saved(stored.new_members(first, "who"), "members1")
    more = saved(stored.new_members(second, "who", members), "members2")
    everyone = members.unionByName(more)
    assert everyone.count() == everyone.select("who").distinct().count() == everyone.select(stored.NUMBER).distinct().count() == 90_000
    days = saved(stored.member_bitmaps(first, ["day"], "who", members), "days1").unionByName(
        saved(stored.member_bitmaps(second, ["day"], "who", everyone), "days2")
    )
    assert sorted_rows(stored.distinct_members(days, ["day"], "n")) == [(1, 50_000), (2, 50_000), (3, 0)]
    assert stored.distinct_members(days.withColumn("all", F.lit(0)), ["all"], "n").first()["n"] == 90_000
    assert days.count() < 40  # dense numbers, few bitmaps


def test_merged_medians_are_exact_when_few_and_bounded_when_many(spark):
    few = spark.range(1, 101).select((F.col("id") % 7).alias("day"), F.lit(0).alias("all"), F.col("id").alias("v"))
    empty = spark.sql("select 9 as day, 1 as all, cast(null as bigint) as v")
    sketches = stored.value_sketches(few.unionByName(empty), ["all", "day"], F.col("v"))
    assert sorted_rows(stored.merged_median(sketches, ["all"], "median")) == [(0, 50.0), (1, None)]
    n = 500_000
    skewed = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("day"), F.lit(0).alias("all"), F.col("id").alias("v"))
    found = stored.merged_median(stored.value_sketches(skewed, ["all", "day"], F.col("v")), ["all"], "m").first()["m"]
    assert abs(found - n / 2) <= stored.RANK_ERROR * n
