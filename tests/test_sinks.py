import threading
from pathlib import Path
from types import SimpleNamespace
from unittest import mock
from urllib.parse import urlparse

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from pricelab import fixed_values as V
from pricelab.plans.feeds import source_tables, write_series
from pricelab.plans.staging import staging_scope, new_folder, release_staged, stage, staging_root
from pricelab.schemas import UNIFIED_SERIES
from pricelab.sinks.tables import FolderTarget, JdbcTarget, fan_out


def frame(spark, n=3):
    return spark.range(n).select(F.col("id").cast("string").alias("zip_code"))


def test_folder_modes(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    target.write(frame(spark), "t")
    with pytest.raises(AnalysisException):
        target.write(frame(spark), "t")
    target.write(frame(spark), "t", "append")
    assert target.read(spark, "t").count() == 6
    target.write(frame(spark), "t", "ignore")
    assert target.read(spark, "t").count() == 6
    target.write(frame(spark, 2), "t", "overwrite")
    assert target.read(spark, "t").count() == 2


def test_jdbc_call(spark, monkeypatch):
    monkeypatch.setenv("PRICELAB_DB_USER", "writer")
    monkeypatch.setenv("PRICELAB_DB_PASSWORD", "secret")
    target = JdbcTarget("db.example.org", "zip_code_data", extra={"isolationLevel": "SERIALIZABLE"})
    assert "secret" not in repr(target)
    with mock.patch.object(DataFrameWriter, "jdbc", autospec=True) as jdbc, mock.patch.object(
        DataFrameWriter, "mode", autospec=True, side_effect=lambda writer, mode: writer
    ) as mode:
        target.write(frame(spark), "allHomesMD")
        target.write(frame(spark), "allHomesMD", "append")
    assert [c.args[1] for c in mode.call_args_list] == ["errorifexists", "append"]
    (_, url, table), options = jdbc.call_args
    assert (url, table) == ("jdbc:postgresql://db.example.org:5432/zip_code_data", "allHomesMD")
    assert options["properties"] == {
        "driver": "org.postgresql.Driver",
        "batchsize": "10000",
        "numPartitions": "16",
        "isolationLevel": "SERIALIZABLE",
        "user": "writer",
        "password": "secret",
    }


def test_output_tables():
    assert set(source_tables(V.ASSESSOR)) == {"allHomesMD", "allHomesBySFMD"}
    assert set(source_tables(V.LISTING)) == {"allHomesRDC", "allHomesBySFRDC"}
    assert set(source_tables(V.PROVIDER)) == {"allHomesQZ", "condosBySFQZ", "allHomesBySFQZ", "sfHomesBySFQZ"}
    assert set(source_tables(V.LEDGER)) == {
        "allHomesNYC", "allHomesBySFNYC", "condosNYC", "condosBySFNYC", "sfHomesNYC", "sfHomesBySFNYC",
    }


def test_fan_out_can_be_repeated(spark, tmp_path):
    rows = [
        ("NYC", segment, measure, "10301", None, float(i))
        for i, (segment, measure) in enumerate(
            (s, m) for s in ("allHomes", "condos", "sfHomes") for m in ("price", "price_sf")
        )
    ]
    target = FolderTarget(str(tmp_path))
    for _ in range(2):
        write_series(spark.createDataFrame(rows, UNIFIED_SERIES), V.LEDGER, target)
    for i, name in enumerate(source_tables(V.LEDGER)):
        got = target.read(spark, name)
        assert got.columns == ["zip_code", "date", "price"]
        assert [r.price for r in got.collect()] == [float(i)]


def test_each_table_reads_its_own_rows(spark, tmp_path):
    rows = [("1", None, 1.0), ("2", None, 2.0), ("3", None, 3.0), ("4", None, None)]
    series = spark.createDataFrame(rows, "zip_code string, date date, price double")
    plans, target = [], FolderTarget(str(tmp_path))
    keeping = SimpleNamespace(
        write=lambda df, table, mode: (
            plans.append(df._jdf.queryExecution().executedPlan().toString()),
            target.write(df, table, mode),
        )
    )
    price = F.col("price")
    left = fan_out(series, keeping, {"low": price < 3, "two": price == 2, "none": price > 9})
    assert left == 2
    assert sorted(r.price for r in target.read(spark, "low").collect()) == [1.0, 2.0]
    assert [r.zip_code for r in target.read(spark, "two").collect()] == ["2"]
    assert target.read(spark, "none").count() == 0
    assert len(plans) == 3 and all("PartitionFilters: [isnotnull(_table" in p for p in plans)


def session_with(master="local[2]", checkpoints=None, **settings):
    """A stand-in for a session of some other cluster."""
    option = SimpleNamespace(isDefined=lambda: checkpoints is not None, get=lambda: checkpoints)
    scala = SimpleNamespace(getCheckpointDir=lambda: option)
    context = SimpleNamespace(
        applicationId="test-app", master=master, _jsc=SimpleNamespace(sc=lambda: scala)
    )
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_staging_uses_the_folder_of_the_cluster():
    named = session_with("yarn", **{"spark.checkpoint.dir": "hdfs://shared/folder/"})
    assert staging_root(named) == "hdfs://shared/folder"
    assert new_folder(named, "x").startswith("hdfs://shared/folder/pricelab/x-")
    assert staging_root(session_with("yarn", "hdfs://set/on/context")) == "hdfs://set/on/context"


def test_only_a_local_master_falls_back_to_a_local_folder():
    unnamed = session_with()
    assert staging_root(unnamed) == staging_root(unnamed) != ""
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging_root(session_with(master))


def test_scope_deletes_what_was_staged_inside(spark):
    outer = stage(frame(spark), "outer")
    with staging_scope(spark):
        inner = stage(frame(spark), "inner")
        path = Path(urlparse(inner.inputFiles()[0]).path).parent
        assert inner.count() == 3 and path.exists()
    assert not path.exists()
    assert outer.count() == 3


def test_staged_table_keeps_rows_and_cuts_lineage(spark):
    staged = stage(frame(spark).repartition(2), "x")
    assert staged.count() == 3
    assert "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_release_deletes_only_what_was_staged(spark, tmp_path):
    stage(frame(spark), "x")
    folder = Path(urlparse(staging_root(spark)).path) / "pricelab"
    other = folder / "kept-by-others"
    other.mkdir(exist_ok=True)
    before = set(folder.iterdir())
    assert release_staged(spark) > 0
    assert release_staged(spark) == 0
    after = set(folder.iterdir())
    assert other in after and len(after) < len(before)


def test_scopes_of_two_threads_are_apart(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path

    def there(df):
        folder = path(df.inputFiles()[0]).getParent()
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    inside, leave = threading.Event(), threading.Event()

    def other():
        with staging_scope(spark):
            seen.append(stage(spark.range(3), "other"))
            inside.set()
            leave.wait(60)

    seen = []
    thread = threading.Thread(target=other)
    with staging_scope(spark):
        thread.start()
        assert inside.wait(60)
        own = stage(spark.range(3), "own")
        with staging_scope(spark):
            inner = stage(spark.range(3), "inner")
        assert there(own) and not there(inner)
    assert not there(own) and there(seen[0])
    leave.set()
    thread.join()
    assert not there(seen[0])
