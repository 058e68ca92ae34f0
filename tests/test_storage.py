"""Landing, bronze, publishing and serving."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeloom.plans.build import build_layer, retire_layers, serve
from lakeloom.plans.star import GIVEN_TABLES, Star, names_of
from lakeloom.session import shared_folder
from lakeloom.sources import bronze, jdbc, landing, tables


def orders(spark, n, status="a"):
    return spark.range(n).select(F.col("id").cast("string").alias("order_id"), F.lit(status).alias("status"))


def test_publish_keeps_versions_and_reads_the_last(spark, tmp_path):
    root = str(tmp_path)
    assert tables.publish(orders(spark, 5), root, "t", ["order_id"]) == 5
    assert tables.publish(orders(spark, 7, "b"), root, "t", ["order_id"]) == 7
    assert tables.read_table(spark, root, "t").where("status = 'b'").count() == 7


def test_old_versions_are_retired_and_later_ones_stay(spark, tmp_path):
    root = str(tmp_path)
    assert tables.retire(spark, root, "t") == []
    for n in range(1, 4):
        tables.publish(orders(spark, n), root, "t", ["order_id"])
    with pytest.raises(tables.KeyViolation):
        tables.publish(orders(spark, 2).unionByName(orders(spark, 2)), root, "t", ["order_id"])
    tables.publish(orders(spark, 5), root, "t", ["order_id"])
    tables.stage(orders(spark, 6), root, "t", ["order_id"])
    assert tables.retire(spark, root, "t", keep=1) == [1, 2, 3, 4]
    assert tables.read_table(spark, root, "t").count() == 5
    assert sorted(f.name for f in (tmp_path / "t").iterdir() if f.is_dir()) == ["version=5", "version=6"]
    with pytest.raises(ValueError, match="cannot be retired"):
        tables.retire(spark, root, "t", keep=0)


def test_layers_keep_their_last_versions(star, tmp_path):
    own = Star(star.raw, GIVEN_TABLES, root=str(tmp_path))
    for _ in range(3):
        own.publish("sellers")
    assert retire_layers(own) == {"sellers": [1]}


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(orders(spark, 5), root, "t", ["order_id"])
    tables.publish(tables.read_table(spark, root, "t").where("order_id < '3'"), root, "t", ["order_id"])
    assert tables.read_table(spark, root, "t").count() == 3


@pytest.mark.parametrize("fault", ["duplicate", "null"])
def test_broken_key_leaves_the_last_good_version(spark, tmp_path, fault):
    root = str(tmp_path)
    good = orders(spark, 5)
    tables.publish(good, root, "t", ["order_id"])
    extra = good.limit(1) if fault == "duplicate" else good.limit(1).withColumn("order_id", F.lit(None).cast("string"))
    with pytest.raises(tables.KeyViolation):
        tables.publish(good.unionByName(extra), root, "t", ["order_id"])
    assert tables.read_table(spark, root, "t").count() == 5
    assert tables.publish(orders(spark, 6), root, "t", ["order_id"]) == 6


def test_schema_drift_fails_unless_asked_for(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(orders(spark, 5), root, "t", ["order_id"])
    wider = orders(spark, 5).withColumn("more", F.lit(1))
    with pytest.raises(tables.SchemaDrift):
        tables.publish(wider, root, "t", ["order_id"])
    tables.publish(wider, root, "t", ["order_id"], overwrite_schema=True)
    assert tables.read_table(spark, root, "t").columns == ["order_id", "status", "more"]


def test_unpublished_table_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="never published"):
        tables.read_table(spark, str(tmp_path), "t")


def test_bronze_days_are_separate_and_repeatable(spark, tmp_path):
    root = str(tmp_path)
    first, second = date(2026, 8, 1), date(2026, 8, 2)
    bronze.write_bronze(orders(spark, 5), root, "o", first)
    bronze.write_bronze(orders(spark, 3), root, "o", second)
    bronze.write_bronze(orders(spark, 4), root, "o", first)
    assert bronze.ingestion_dates(spark, root, "o") == [first, second]
    assert bronze.read_bronze(spark, root, "o", first).count() == 4
    assert bronze.read_bronze(spark, root, "o").count() == 3
    with pytest.raises(ValueError, match="no snapshot"):
        bronze.resolve_ingestion_date(spark, root, "o", date(2026, 8, 3))
    with pytest.raises(ValueError, match="never ingested"):
        bronze.resolve_ingestion_date(spark, root, "missing")


def test_landing_keeps_every_character(spark, tmp_path):
    folder = str(tmp_path)
    texts = ['two\nlines, "quoted"', "NA", "null", "", "  padded  ", "back\\slash", "a,b", "007"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    landing.write_landing(df, folder, "texts")
    found = landing.read_landing(spark, folder, "texts")
    assert [r.text for r in found.orderBy("id").collect()] == texts
    assert {f.dataType.simpleString() for f in found.schema.fields} == {"string"}
    assert landing.landing_tables(spark, folder, ["all"]) == ["texts"]
    assert landing.landing_tables(spark, folder, ["x", "y"]) == ["x", "y"]
    with pytest.raises(FileNotFoundError):
        landing.read_landing(spark, folder, "missing")


def test_from_landing_files_to_marts(spark, star, tmp_path):
    """CSV files, bronze, silver, gold and marts end where the direct way ends."""
    moment = datetime(2026, 8, 1, 6, 30)
    for name in bronze.SOURCES:
        landing.write_landing(getattr(star.raw, name), f"{tmp_path}/landing", name)
        free_text = name == "reviews"
        bronze.ingest(spark, f"{tmp_path}/landing", f"{tmp_path}/bronze", name, moment, line_breaks=free_text)
    ingested = Star(bronze.BronzeDay(spark, f"{tmp_path}/bronze"), GIVEN_TABLES, f"{tmp_path}/warehouse")
    written = {layer: build_layer(ingested, layer) for layer in ("silver", "gold", "marts")}
    assert list(written["marts"]) == names_of("marts")
    for name in ("customers", "orders", "reviews", "dim_seller", "fct_order_items", *names_of("marts")):
        left, right = ingested.table(name), star.table(name)
        assert left.count() == right.count() > 0
        assert left.exceptAll(right.select(*left.columns)).isEmpty()


def test_build_stops_at_the_first_failure(spark, star, tmp_path):
    class Doubled:
        spark = star.spark
        folder = "doubled"

        def __getattr__(self, name):
            found = getattr(star.raw, name)
            return found.union(found) if name == "products" else found

    broken = Star(Doubled(), GIVEN_TABLES, str(tmp_path))
    with pytest.raises(tables.KeyViolation):
        build_layer(broken, "silver")
    assert tables.table_exists(spark, f"{tmp_path}/silver", "sellers")
    assert not tables.table_exists(spark, f"{tmp_path}/silver", "products")
    assert not tables.table_exists(spark, f"{tmp_path}/silver", "orders")


def test_unknown_table_is_an_attribute_error(star):
    with pytest.raises(AttributeError):
        star.no_such_table


class SessionStub:
    """Just what ``shared_folder`` asks a session for."""

    def __init__(self, configured=None, context_dir=None, master="local[2]"):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self._configured, self._dir = configured, context_dir

    def get(self, key, default=None):
        return self._configured if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


def test_shared_folder_is_the_one_the_cluster_names():
    assert shared_folder(SessionStub(configured="hdfs:///shared/", master="yarn")) == "hdfs:///shared"
    assert shared_folder(SessionStub(context_dir="hdfs:///other", master="yarn")) == "hdfs:///other"


def test_shared_folder_is_never_local_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(SessionStub(master="spark://host:7077"))
    assert "lakeloom-" in shared_folder(SessionStub(master="local[2]"))


class RecordingWriter:
    """Stands in for a database: takes the rows where a JDBC write would."""

    def __init__(self, df, calls):
        self._df, self._calls, self._options = df, calls, {}

    def mode(self, value):
        self._options["mode"] = value
        return self

    def option(self, key, value):
        self._options[key] = value
        return self

    def jdbc(self, url, table, properties):
        self._df.write.format("noop").mode("overwrite").save()
        self._calls.append((url, table, properties, self._options))


def test_serving_replaces_rows_and_counts_them_on_the_way(spark, star, monkeypatch):
    calls = []

    class Observed:
        def __init__(self, df):
            self.write = RecordingWriter(df, calls)

    class Table:
        def __init__(self, df):
            self._df = df

        def observe(self, *args):
            return Observed(self._df.observe(*args))

    assert jdbc.copy_to_jdbc(Table(star.dim_geography), "jdbc:x", "gold.g", {"user": "u"}) == star.dim_geography.count()
    assert calls == [
        ("jdbc:x", "gold.g", {"user": "u"}, {"mode": "overwrite", "truncate": "true", "batchsize": "10000", "numPartitions": "8"})
    ]
    monkeypatch.setattr(jdbc, "copy_to_jdbc", lambda df, url, target, properties, connections: target)
    served = serve(star, "jdbc:x", "gold", {})
    assert list(served.values())[0] == "gold.dim_date" and len(served) == 9
