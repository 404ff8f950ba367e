"""Streams under a data contract."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators.contracts import ColumnContract, DataContract
from tallyline.sources import topics
from tallyline.streaming import checked

CONTRACT = DataContract("stream", [
    ColumnContract("id", "Int64", nullable=False), ColumnContract("amount", "Float64", min_value=-100, max_value=100),
    ColumnContract("kind", "Utf8", allowed_values=["a", "b"])])
SCHEMA = "id BIGINT, amount DOUBLE, kind STRING"
GOOD, BAD = [(1, 5.0, "a"), (2, -5.0, "b")], [(3, 500.0, "a"), (None, 1.0, "c"), (5, 1.0, "c")]


@pytest.fixture()
def source(spark, tmp_path):
    path = str(tmp_path / "in")
    for rows in (GOOD, BAD, GOOD):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return topics.read_folder(spark, path, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)


def test_a_bad_batch_is_set_aside_with_one_result_row(spark, source, tmp_path):
    out = str(tmp_path / "out")
    query = checked.start_checked(source, CONTRACT, "checked", out, str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert query.exception() is None
    rows = checked.results(spark, out).orderBy("batch_id").collect()
    assert [(r.contract, r.valid, r.row_count) for r in rows] == [("stream", True, 2), ("stream", False, 3), ("stream", True, 2)]
    assert rows[1].errors == CONTRACT.validate(spark.createDataFrame(BAD, SCHEMA)).errors and len(rows[1].errors) == 3
    assert rows[0].errors == [] and rows[0].timestamp < rows[2].timestamp
    assert spark.read.parquet(f"{out}/data").count() == 4
    assert {tuple(r) for r in spark.read.parquet(f"{out}/rejected").drop("batch_id").collect()} == set(BAD)


def test_a_broken_contract_stops_the_query(spark, source, tmp_path):
    out = str(tmp_path / "out")
    query = checked.start_checked(source, CONTRACT, "stopped", out, str(tmp_path / "cp"), stop=True)
    with pytest.raises(Exception, match="outside range"):
        query.awaitTermination(120)
    assert [r.valid for r in checked.results(spark, out).orderBy("batch_id").collect()] == [True, False]
    assert spark.read.parquet(f"{out}/data").count() == 2


def test_a_batch_that_runs_again_and_a_wrong_schema(spark, tmp_path):
    out = str(tmp_path / "out")
    write = checked.write_checked(CONTRACT, out)
    for rows in (BAD, GOOD):                               # the second time the batch is whole
        write(spark.createDataFrame(rows, SCHEMA), 0)
    write(spark.createDataFrame(GOOD, SCHEMA).withColumn("more", F.lit(1)), 1)
    write(spark.createDataFrame([], SCHEMA), 2)
    rows = checked.results(spark, out).orderBy("batch_id").collect()
    assert [(r.valid, r.row_count) for r in rows] == [(True, 2), (False, 2), (True, 0)] and rows[1].errors == ["Extra columns: ['more']"]
    assert spark.read.parquet(f"{out}/data/batch_id=0").count() == 2
    assert spark.read.parquet(f"{out}/rejected").select("batch_id").distinct().count() == 1
