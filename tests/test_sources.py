from pathlib import Path
from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest
from conftest import at
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stallbook import sources
from stallbook.plans import staging
from stallbook.sources import schemas
from stallbook.sources.jdbc import connection_properties

URL = "jdbc:example:shop"


def reader():
    """The JDBC paths are checked by the options they pass: no database is started for a test."""
    return SimpleNamespace(read=MagicMock())


def test_jdbc_whole_table(monkeypatch):
    monkeypatch.setenv("STALLBOOK_JDBC_USER", "u")
    monkeypatch.setenv("STALLBOOK_JDBC_PASSWORD", "from-env")
    spark = reader()
    sources.read_jdbc(spark, URL, "orders", {"password": "given"})
    spark.read.jdbc.assert_called_once_with(
        URL, "orders", properties={"fetchsize": "10000", "user": "u", "password": "given"}
    )
    assert connection_properties()["password"] == "from-env"


def test_jdbc_parallel_read():
    spark = reader()
    sources.read_jdbc(spark, URL, "orders", partition_column="order_id", bounds=(1, 9), num_partitions=4)
    options = spark.read.jdbc.call_args.kwargs
    assert (options["column"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("order_id", 1, 9, 4)
    sources.read_jdbc(spark, URL, "orders", predicates=["a < 1", "a >= 1"])
    assert spark.read.jdbc.call_args.kwargs["predicates"] == ["a < 1", "a >= 1"]


def test_jdbc_rejects_half_given_partitioning():
    with pytest.raises(ValueError):
        sources.read_jdbc(reader(), URL, "orders", partition_column="order_id")
    with pytest.raises(ValueError):
        sources.read_jdbc(reader(), URL, "orders", partition_column="order_id", predicates=["a < 1"])


@pytest.mark.parametrize(("mode", "truncate"), [("overwrite", "true"), ("append", "false")])
def test_jdbc_write_keeps_the_table_definition(monkeypatch, mode, truncate):
    frame = MagicMock()
    monkeypatch.setattr("stallbook.sources.jdbc.stage", lambda given, label: given)
    writer = frame.write.mode.return_value
    writer.option.return_value = writer
    sources.write_jdbc(frame, URL, "gold_abc", mode=mode)
    frame.write.mode.assert_called_once_with(mode)
    options = dict(call.args for call in writer.option.call_args_list)
    assert options == {"batchsize": "10000", "numPartitions": "16", "truncate": truncate}
    writer.jdbc.assert_called_once()


def test_documents_round_trip(spark, shop, tmp_path):
    path = str(tmp_path / "clicks")
    shop.clicks.write.json(path)
    read = sources.read_documents(spark, path, schemas.CLICKS)
    assert read.schema == shop.clicks.schema
    assert read.agg(F.sum("metadata.session_duration_sec")).first()[0] == 80
    inferred = sources.read_documents(spark, path)
    assert "metadata" in inferred.columns


def test_document_options_belong_to_one_read():
    spark = reader()
    chain = spark.read.format.return_value
    chain.options.return_value = chain.option.return_value = chain
    sources.read_documents(spark, source="mongodb", options={"database": "lake"}, collection="support_tickets")
    spark.read.format.assert_called_once_with("mongodb")
    chain.options.assert_called_once_with(database="lake")
    chain.option.assert_called_once_with("collection", "support_tickets")


def test_recent_documents(spark):
    data = [(i, at(f"2024-01-01 10:{i:02d}:00")) for i in range(10)]
    docs = spark.createDataFrame(data, "event_id int, timestamp timestamp")
    assert [r["event_id"] for r in sources.recent_documents(docs).collect()] == [9, 8, 7, 6, 5, 4]
    assert [r["event_id"] for r in sources.recent_documents(docs, n=2).collect()] == [9, 8]


def test_tables(spark, tmp_path):
    frame = sources.frame_from_rows(spark, [(1, "a"), (2, "b")], "k int, v string")
    sources.write_table(frame, "small_table")
    assert sources.load_table(spark, "small_table").count() == 2
    missing = sources.load_table(spark, "no_such_table", "k int")
    assert missing.columns == ["k"] and missing.count() == 0
    loaded = sources.load_serving_tables(spark)
    assert tuple(loaded) == sources.SERVING_TABLES and len(loaded) == 17
    assert sources.schema_text(frame) == "k int, v string"
    assert sources.preview(frame, 1).count() == 1
    written = sources.write_all(
        {"x": frame, "y": frame}, lambda f, n: sources.write_table(f, n, path=str(tmp_path / n), partition_by=["k"])
    )
    assert written == ["x", "y"] and spark.read.parquet(str(tmp_path / "y")).count() == 2


def test_broken_table_is_not_hidden(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_bytes(b"junk")
    spark.sql(f"CREATE TABLE broken_table (k INT) USING parquet LOCATION '{tmp_path}/broken'")
    with pytest.raises(Exception, match="broken|Parquet|parquet|FAILED_READ"):
        sources.load_table(spark, "broken_table").collect()


def test_unknown_columns_fail_early(spark):
    with pytest.raises(AnalysisException):
        sources.frame_from_rows(spark, [(1,)], "k int").select("other")


@pytest.mark.parametrize(
    ("named", "set_before", "expected"),
    [("/shared/", None, "/shared"), (None, "/kept", "/kept"), (None, None, "/tables/stallbook-work")],
)
def test_work_folder(named, set_before, expected):
    context = MagicMock()
    context.getCheckpointDir.return_value = set_before
    settings = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "/tables/"}
    spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: settings[key]))
    assert staging.work_folder(spark) == expected


def test_temporary_stages_are_removed(spark):
    with staging.temporary_stages(spark) as area:
        assert staging.stage(spark.range(5), "gone").count() == 5
    assert len(area) == 1 and not Path(area[0]).exists()
