"""The pipeline against its stages applied plainly, and the registered queries against SQL."""

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from tallyline.llm.oracle import ORACLE
from tallyline.llm.queries import QUERIES
from tests.llm import docs, plain
from tests.llm.test_similar import linked


def test_every_operator_is_registered_once():
    names = entry_module.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, name):
    found = QUERIES[name](spark, small).toPandas()
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    expected = connection.execute(ORACLE[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    docs.same(found[sorted(found.columns)].astype(str).values, expected[sorted(found.columns)].astype(str).values)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with all that the stages act on, and the tables beside them."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs.frame(spark).write.parquet(f"{path}/documents.parquet")
    passage = docs.texts()[9][100:400]
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(k, 1, int(k % 9 == 0)) for k in range(0, 200, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    columns = table.columns
    steps = dict(corpus_pipeline.STAGES)
    calm = steps["toxicity"](spark, table, folder)
    assert calm.columns == columns and set(docs.pairs(calm)) <= set(docs.pairs(table))

    single = steps["near_duplicates"](spark, table, folder).collect()
    rows = docs.pairs(table)
    roots = linked(rows)[1]
    lowest = {}
    for (i, _), root in zip(rows, roots):
        lowest[root] = min(i, lowest.get(root, i)) if i is not None else lowest.get(root, 1 << 60)
    assert sorted(r.doc_id for r in single if r.doc_id is not None) == sorted(i for i in lowest.values() if i < 1 << 60)

    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = steps["decontamination"](spark, table, folder)
    docs.same(docs.pairs(clean), [row for row, hit in zip(rows, plain.phrase_rows(rows, items)) if not hit[-1]])

    masked = steps["personal_data"](spark, table, folder)
    assert masked.columns == columns
    for r in masked.collect():
        assert not any(plain.base_spans(r.text).values()) and (r.text is None or r.n_chars == len(r.text))
    plain_ids = {i for i, t in rows if not any(plain.base_spans(t).values())}
    docs.same([(i, t) for i, t in docs.pairs(masked) if i in plain_ids], [(i, t) for i, t in rows if i in plain_ids])


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    table = spark.read.parquet(f"{folder}/documents.parquet")
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in table.collect()}
    assert len({r.doc_id for r in rows if r.doc_id is not None}) == len([r for r in rows if r.doc_id is not None])


def test_run_on_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    docs.frame(spark, []).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
    for name, query in QUERIES.items():
        assert query(spark, path).collect() == [], name
