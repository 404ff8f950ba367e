"""Versions of stored tables, and summaries kept up to date by appends."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators import reports, star
from tallyline.plans import batch, jobs, views, warehouse
from tallyline.sources import files, tables
from tallyline.sources.versions import Conflict, Versions
from tests.helpers import as_set
from tests.test_plans import plan_of


class Killed(BaseException):
    pass


def dies_at(monkeypatch, target, name, call):
    """Ends the run at the n-th call of a function."""
    real, seen = getattr(target, name), []

    def run(*args, **kwargs):
        seen.append(1)
        if len(seen) > call:
            raise Killed
        return real(*args, **kwargs)

    monkeypatch.setattr(target, name, run)


def test_the_newest_complete_manifest_counts(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.current().number == 0 and versions.current().paths == {}
    first = versions.commit({"t": "a"})
    assert versions.commit({"t": "b"}, {"note": "x"}).number == first.number + 1
    # A writer that stopped inside its manifest leaves a number that readers pass over and writers do not reuse.
    (tmp_path / "manifests" / f"{3:012d}").write_text('{"paths": {"t": "c"}, "no')
    assert versions.current().paths == {"t": "b"} and versions.current().notes == {"note": "x"}
    assert versions.commit({"t": "d"}).number == 4 and versions.current().paths == {"t": "d"}


def test_two_writers_from_one_version(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    base = versions.commit({"t": "a"})
    versions.commit({"t": "b"}, after=base)
    with pytest.raises(Conflict):
        versions.commit({"t": "c"}, after=base)
    assert versions.current().paths == {"t": "b"}


def test_a_taken_number_is_never_overwritten(spark, tmp_path, monkeypatch):
    versions = Versions(spark, str(tmp_path))
    versions.commit({"t": "a"})
    seen = []
    real = versions._numbers
    monkeypatch.setattr(versions, "_numbers", lambda: seen.append(1) or ([] if len(seen) == 1 else real()))
    assert versions.commit({"t": "b"}).number == 2          # the first try asked for number 1
    assert versions._read(1).paths == {"t": "a"}


def test_retention_keeps_what_kept_versions_name_and_what_is_young(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    folders = []
    for k in range(4):
        folder = versions.begin()
        spark.range(k + 1).write.parquet(folder)
        folders.append(folder)
        versions.commit({"t": folder, "old": folders[0]})
    spark.range(1).write.parquet(versions.begin())         # of a run that never came to its end
    assert versions.retain(2) == [] and len(list((tmp_path / "data").iterdir())) == 5
    removed = versions.retain(2, grace=-1000)
    kept = {p.name for p in (tmp_path / "data").iterdir()}
    assert kept == {Path(f).name for f in (folders[0], folders[2], folders[3])} and len(removed) == 2
    assert spark.read.parquet(versions.current().paths["t"]).count() == 4


@pytest.mark.parametrize("call", [0, 1, 3, 5])
def test_a_star_build_that_dies_between_writes_leaves_the_old_one(spark, small, tmp_path, monkeypatch, call):
    book, out = tables.ledger(spark, small), str(tmp_path)
    warehouse.build_star_tables(spark, book.limit(50), out)
    before = warehouse.star_tables(spark, out)
    dies_at(monkeypatch, files, "write_layer", call)
    with pytest.raises(Killed):
        warehouse.build_star_tables(spark, book, out)
    assert warehouse.star_tables(spark, out) == before
    assert all(spark.read.parquet(path).count() for path in before.values())


def test_a_star_build_that_dies_in_its_manifest_leaves_the_old_one(spark, small, tmp_path, monkeypatch):
    book, out = tables.ledger(spark, small), str(tmp_path)
    warehouse.build_star_tables(spark, book.limit(50), out)
    before = warehouse.star_tables(spark, out)

    def half(self, stream, text):
        stream.write(bytearray(text[: len(text) // 2].encode()))
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(Versions, "_write", half)
        with pytest.raises(Killed):
            warehouse.build_star_tables(spark, book, out)
    assert warehouse.star_tables(spark, out) == before
    warehouse.build_star_tables(spark, book, out)
    assert spark.read.parquet(warehouse.star_tables(spark, out)["fact_transactions"]).count() == book.count()


def test_a_batch_whose_contract_breaks_leaves_the_last_layers(spark, small, tmp_path, monkeypatch):
    raw, out = tables.raw_ledger(spark, small), str(tmp_path)
    before = batch.run_batch(spark, raw.limit(100), None, out)
    dies_at(monkeypatch, batch.contracts, "silver_contract", 0)
    with pytest.raises(Killed):
        batch.run_batch(spark, raw, None, out)
    assert batch.layers(spark, out) == before
    assert spark.read.parquet(before["silver/transactions"]).count() > 0


def test_a_saved_table_changes_as_a_whole(spark, tmp_path, monkeypatch):
    files.save_table(spark.range(3), "versioned_table")
    dies_at(monkeypatch, Versions, "commit", 0)
    with pytest.raises(Killed):
        files.save_table(spark.range(5), "versioned_table")
    assert spark.table("versioned_table").count() == 3
    monkeypatch.undo()
    files.save_table(spark.range(5), "versioned_table")
    assert spark.table("versioned_table").count() == 5
    assert files.read_or_empty(spark, "no_such_table", schemas.BUDGET).count() == 0


@pytest.fixture(scope="module")
def wide(spark, small):
    return star.warehouse(tables.ledger(spark, small))


def test_appends_equal_a_full_refresh(spark, wide, tmp_path):
    path, whole = str(tmp_path / "parts"), str(tmp_path / "whole")
    cut = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    for k in range(3):                                     # every batch touches most months
        jobs.append_to_monthly_summary(wide.filter(cut == k), path, f"batch {k}")
    jobs.append_to_monthly_summary(wide.filter(cut == 1), path, "batch 1")
    jobs.append_to_monthly_summary(wide.limit(0), path, "nothing")
    jobs.refresh_monthly_summary(wide, whole)
    assert as_set(jobs.read_monthly_summary(spark, path)) == as_set(jobs.read_monthly_summary(spark, whole))
    assert as_set(jobs.read_monthly_summary(spark, whole)) == as_set(reports.monthly_financial_summary(wide).select(
        jobs.read_monthly_summary(spark, whole).columns))


def test_an_append_writes_only_the_months_it_touches(spark, wide, tmp_path):
    path = str(tmp_path)
    view = jobs.monthly_view(spark, path)
    jobs.refresh_monthly_summary(wide, path)
    before = view.versions.current().paths
    jobs.append_to_monthly_summary(wide.filter("year = 2000 AND month IN (3, 4)"), path, "again")
    after = view.versions.current().paths
    assert {part for part in after if after[part] != before.get(part)} == {"2000-03", "2000-04"} and after.keys() == before.keys()


def test_an_append_that_dies_changes_nothing(spark, wide, tmp_path, monkeypatch):
    path = str(tmp_path)
    jobs.refresh_monthly_summary(wide.filter("year < 2000"), path)
    before = as_set(jobs.read_monthly_summary(spark, path))
    for call in (0, 1):
        with monkeypatch.context() as patch:
            dies_at(patch, files, "write_layer", call)
            with pytest.raises(Killed):
                jobs.append_to_monthly_summary(wide.filter("year >= 2000"), path, "late")
        assert as_set(jobs.read_monthly_summary(spark, path)) == before
    jobs.append_to_monthly_summary(wide.filter("year >= 2000"), path, "late")
    jobs.refresh_monthly_summary(wide, str(tmp_path / "whole"))
    assert as_set(jobs.read_monthly_summary(spark, path)) == as_set(jobs.read_monthly_summary(spark, str(tmp_path / "whole")))


def test_answers_come_from_the_summary_where_it_covers_them(spark, wide, tmp_path):
    base = spark.createDataFrame(wide.limit(400).collect(), wide.schema)
    base.write.parquet(str(tmp_path / "base_rows"))
    base = spark.read.parquet(str(tmp_path / "base_rows"))
    path = str(tmp_path / "summary")
    jobs.refresh_monthly_summary(base, path)
    view = jobs.monthly_view(spark, path)
    covered = [
        jobs.expenses_of(2000),
        views.Aggregate(("account_type",), {"n": views.Measure("count"), "last": views.Measure("max", "date_key")}),
        views.Aggregate((), {"net": views.Measure("sum", "amount")}, (("year", ">=", 1999), ("category_group", "=", "Dining"))),
        views.Aggregate(("year",), {"first": views.Measure("min", "date_key"), "income": views.Measure("sum", "amount", "amount > 0")}),
    ]
    for wanted in covered:
        got = views.answer(wanted, base, [view])
        assert "base_rows" not in plan_of(got) and "summary" in str(got.inputFiles())
        assert as_set(got) == as_set(wanted.from_rows(base))
    others = [
        views.Aggregate(("account",), {"n": views.Measure("count")}),                                     # another key
        views.Aggregate(("year",), {"n": views.Measure("count", "*", "amount < -5")}),                    # another measure
        views.Aggregate(("year",), {"n": views.Measure("count")}, (("date_key", "<", dt.date(2000, 1, 5)),)),   # another filter
    ]
    for wanted in others:
        got = views.answer(wanted, base, [view])
        assert "base_rows" in str(got.inputFiles()) and as_set(got) == as_set(wanted.from_rows(base))
    assert as_set(views.answer(covered[0], base, [jobs.monthly_view(spark, str(tmp_path / "none"))])) == as_set(covered[0].from_rows(base))


def test_the_smallest_covering_summary_answers(spark, wide, tmp_path):
    small = views.SummaryView(spark, str(tmp_path / "small"), ("year",), {"n": views.Measure("count")}, "year")
    large = jobs.monthly_view(spark, str(tmp_path / "large"))
    small.refresh(wide)
    large.refresh(wide)
    got = views.answer(views.Aggregate(("year",), {"n": views.Measure("count")}), wide, [large, small])
    assert all("/small/" in f for f in got.inputFiles())
