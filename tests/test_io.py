import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter

from emberwall import session, sinks, sources


@pytest.fixture
def small(spark):
    return spark.createDataFrame([(1, "a"), (2, None)], "id long, x string")


def test_parquet_round_trip(spark, small, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(small, path)
    assert sorted(sources.read_table(spark, path).collect()) == sorted(small.collect())
    with pytest.raises(AnalysisException):
        sinks.write_parquet(small, path)
    sinks.write_parquet(small, path, mode="overwrite")


def test_csv_round_trip(spark, small, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_csv(small, path)
    again = spark.read.csv(path, header=True, schema="id long, x string")
    assert sorted(again.collect()) == sorted(small.collect())


@pytest.mark.parametrize("mode", ["parquet", "anything", None])
def test_other_write_modes_are_parquet(spark, small, tmp_path, mode):
    path = str(tmp_path / "t")
    sinks.write_table(small, path, write_mode=mode)
    assert sources.read_table(spark, path).count() == 2


def test_database_mode_replaces_the_table_over_jdbc(small, monkeypatch):
    """No database is started here; the call that would write is recorded."""
    calls, options = [], []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, **kw: calls.append(kw))
    plain_option = DataFrameWriter.option
    monkeypatch.setattr(
        DataFrameWriter,
        "option",
        lambda self, key, value: options.append((key, value)) or plain_option(self, key, value),
    )
    sinks.write_table(
        small, "ip4", "database", "jdbc:x://host/db", {"user": "u"}, connections=16
    )
    assert calls == [
        {"url": "jdbc:x://host/db", "table": "ip4", "mode": "overwrite",
         "properties": {"user": "u"}}
    ]
    assert options == [("numPartitions", 16)]


def test_port_names(spark, tmp_path):
    path = tmp_path / "ports.csv"
    path.write_text("port,name\n22,ssh\n443,https\n443,quic\n")
    df = sources.read_port_names(spark, str(path))
    assert df.dtypes == [("port", "int"), ("name", "string")]
    assert df.collect() == [(22, "ssh"), (443, "https"), (443, "quic")]


def test_blocklist_skips_its_banner(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("#" * 20 + "\n# banner\n192.0.2.1 \n\n192.0.2.2,seen\n# end\n")
    df = sources.read_blocklist(spark, str(path), "bots")
    assert df.collect() == [("192.0.2.1", "bots"), ("192.0.2.2", "bots")]


def test_lookup_tables(spark, tmp_path):
    geo = tmp_path / "geo.csv"
    geo.write_text("ip,country_code,status\na,DE,ok\nb,,timeout\n")
    assert sources.read_geo(spark, str(geo)).collect() == [
        ("a", "DE", "ok"), ("b", None, "timeout"),
    ]
    meta = tmp_path / "meta.csv"
    meta.write_text(
        "ip,org,city,country,region,postal,hostname,location,timezone\na,o,,DE,,,,,\n"
    )
    assert sources.read_metadata(spark, str(meta)).first()[:4] == ("a", "o", None, "DE")


def test_store_uses_the_shared_folder(spark, small):
    stored = session.store(small, "small")
    [file, *_] = stored.inputFiles()
    assert session.shared_folder(spark) in file.replace("file://", "")
    assert stored.dtypes == small.dtypes
    assert sorted(stored.collect()) == sorted(small.collect())


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError):
        session.shared_folder(Session())
