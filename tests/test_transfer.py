import json
import os
from functools import partial
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tests.helpers import at, plan, rows, same

from tablejobs.plans.transfer import extract, extract_then_load, load_cells
from tablejobs.session import scratch_dir
from tablejobs.sources.cells import latest_cells, read_mapping, send_cells, to_cells, to_cells_mapped
from tablejobs.sources.tables import read_parquet, write_hub, write_parquet


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "ann", 5.5), (2, None, 7.0)], "id int, name string, size double")


def test_cells(people):
    assert rows(to_cells(people, "id", ["name", "size"])) == [
        (bytearray(b"1"), "cf1", "name", bytearray(b"ann")),
        (bytearray(b"1"), "cf1", "size", bytearray(b"5.5")),
        (bytearray(b"2"), "cf1", "size", bytearray(b"7.0")),
    ]


def test_mapped_cells(people):
    mapping = read_mapping('{"name": "who:full:name", "size": "extent"}')
    got = rows(to_cells_mapped(people, mapping, "id").select("family", "qualifier").distinct())
    assert got == [("cf1", "extent"), ("who", "full:name")]
    with pytest.raises(ValueError, match="mapping"):
        read_mapping('["name"]')


def test_a_row_without_key_is_an_error(spark):
    df = spark.createDataFrame([(None, "ann")], "id int, name string")
    with pytest.raises(PySparkException, match="has no key"):
        to_cells(df, "id", ["name"]).collect()


def test_cells_plan_shuffles_nothing(people, capsys):
    assert "Exchange" not in plan(to_cells(people, "id", ["name", "size"]), capsys)


def test_upsert_is_idempotent_and_keeps_the_latest(spark, tmp_path):
    folder = str(tmp_path / "store")
    old = spark.createDataFrame([(1, "a", at("2024-01-01")), (2, "b", at("2024-01-01"))], "id int, name string, v timestamp")
    new = spark.createDataFrame([(1, "c", at("2024-01-02"))], "id int, name string, v timestamp")
    for df in (new, old, old, new):
        load_cells(df, "id", ["name"], version="v", path=folder)
    stored = read_parquet(spark, folder)
    assert stored.count() == 6
    assert rows(latest_cells(stored).select(F.decode("row_key", "UTF-8"), F.decode("value", "UTF-8"))) == [
        ("1", "c"),
        ("2", "b"),
    ]


def test_a_failed_write_leaves_no_cells(spark, people, tmp_path):
    folder = tmp_path / "store"
    cells = to_cells(people.repartition(2), "id", ["name", "size"])
    bad = cells.withColumn("value", F.when(F.col("qualifier") == "size", F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.col("value")))
    with pytest.raises(PySparkException):
        send_cells(bad, path=str(folder))
    assert not [f for f in folder.glob("*") if f.suffix == ".parquet"]


class JsonClient:
    """A client of another store: one file per partition."""

    def __init__(self, options):
        self.file = open(os.path.join(options["target"], f"{os.getpid()}-{id(self)}.json"), "w")

    def write(self, batch):
        for cell in batch.to_pylist():
            self.file.write(json.dumps([cell["row_key"].decode(), cell["qualifier"], cell["value"].decode()]) + "\n")

    def close(self):
        self.file.close()


def test_other_clients_are_opened_per_partition(spark, people, tmp_path):
    spark.sparkContext.addPyFile(__file__)
    send_cells(to_cells(people.repartition(2), "id", ["name", "size"]), client="test_transfer:JsonClient", target=str(tmp_path))
    lines = [json.loads(line) for name in os.listdir(tmp_path) for line in open(tmp_path / name)]
    assert sorted(lines) == [["1", "name", "ann"], ["1", "size", "5.5"], ["2", "size", "7.0"]]


def test_cells_cannot_be_overwritten(spark, people, tmp_path):
    send_cells(to_cells(people, "id", ["name"]), path=str(tmp_path / "a"))
    cells = to_cells(people, "id", ["name"])
    with pytest.raises(PySparkException, match="upserted"):
        cells.withColumn("written_at", F.current_timestamp()).write.format("cells").mode("overwrite").option(
            "path", str(tmp_path / "a")
        ).save()


def test_extract_replaces_the_folder(spark, sf, tmp_path):
    folder = str(tmp_path / "out")
    write_parquet(spark.range(3), folder)
    extract(spark, "parquet", "nation", folder, path=f"{sf}/nation.parquet")
    assert same(read_parquet(spark, folder), read_parquet(spark, f"{sf}/nation.parquet"))


def test_extract_then_load(spark, sf, tmp_path):
    run = partial(
        extract_then_load, spark, "parquet", "nation", str(tmp_path / "out"), "n_nationkey", {"n_name": "names:n"},
        connector={"path": f"{sf}/nation.parquet"}, path=str(tmp_path / "store"),
    )
    run()
    run()
    cells = latest_cells(read_parquet(spark, str(tmp_path / "store")))
    assert cells.count() == 25 and cells.select("family").distinct().first()[0] == "names"


def test_hub_table_keeps_other_partitions(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS hubs LOCATION '{tmp_path}/hubs'")
    rows_of = lambda *records: spark.createDataFrame(list(records), "v int, source_system_cd string, active_ym string")
    try:
        write_hub(rows_of((1, "PIMS", "202401"), (2, "PIMS", "202402")), "hubs.things")
        write_hub(rows_of((3, "PIMS", "202402")).select("active_ym", "source_system_cd", "v"), "hubs.things")
        assert rows(spark.table("hubs.things").select("v", "active_ym")) == [(1, "202401"), (3, "202402")]
    finally:
        spark.sql("DROP DATABASE hubs CASCADE")
    with pytest.raises(ValueError, match="either"):
        write_hub(rows_of((1, "a", "b")))


def test_scratch_folder_follows_the_session():
    def session_with(folder):
        known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "hdfs://shared/warehouse"}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: known[key] or default))

    first, second = (scratch_dir(session_with("/shared/x/"), "a") for _ in range(2))
    assert first.startswith("/shared/x/a-") and first != second
    assert scratch_dir(session_with(None), "b").startswith("hdfs://shared/warehouse/scratch/b-")


@pytest.mark.parametrize("warehouse", ["hdfs://shared/warehouse", "file:/tmp/warehouse", "/tmp/warehouse"])
def test_scratch_folder_of_a_cluster_is_in_a_store(warehouse):
    known = {"spark.master": "yarn", "spark.sql.warehouse.dir": warehouse}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: known.get(key, default)))
    if warehouse.startswith("hdfs"):
        assert scratch_dir(session, "c").startswith("hdfs://shared/warehouse/scratch/c-")
    else:
        with pytest.raises(ValueError, match="checkpoint"):
            scratch_dir(session, "c")
