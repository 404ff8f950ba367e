"""Stored summaries kept up to date by what is appended, and aggregates answered from them.

A summary holds mergeable partial aggregates (count, sum, min, max) by some keys, in one
folder for each part, such as a month. Appended rows are aggregated alone; only the parts
they touch are read, merged and written anew, the other folders are named by the next
version as they are. A batch that is appended again under its name changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sources import files
from tallyline.sources.versions import Version, Versions

PART = "_part"
#: How a partial aggregate is made from rows, and how two of them are merged.
MAKE = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Measure:
    """``kind`` of a column, over the rows where a condition holds (default: all)."""

    kind: str
    column: str = "*"
    where: str = ""

    def of_rows(self) -> Column:
        value = F.lit(1) if self.column == "*" else F.expr(self.column)
        return MAKE[self.kind](F.when(F.expr(self.where), value) if self.where else value)

    def merged(self, name: str) -> Column:
        return MERGE[self.kind](name)


@dataclass(frozen=True)
class Aggregate:
    """Measures by keys, over the rows for which the conditions on columns hold."""

    keys: tuple[str, ...]
    measures: dict[str, Measure]
    #: (column, comparison, value); the comparison is one of =, <, <=, >, >=.
    where: tuple[tuple[str, str, object], ...] = ()
    #: Leave out groups in which every measure is NULL.
    filled: bool = False

    def condition(self) -> Column:
        found = F.lit(True)
        for column, sign, value in self.where:
            c, v = F.col(column), F.lit(value)
            found = found & {"=": c == v, "<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v}[sign]
        return found

    def from_rows(self, rows: DataFrame) -> DataFrame:
        return self._finish(rows.filter(self.condition()).groupBy(*self.keys).agg(*[m.of_rows().alias(n) for n, m in self.measures.items()]))

    def _finish(self, df: DataFrame) -> DataFrame:
        if not self.filled:
            return df
        some = F.lit(False)
        for name, measure in self.measures.items():
            some = some | (F.col(name) > 0 if measure.kind == "count" else F.col(name).isNotNull())
        return df.filter(some)


@dataclass
class SummaryView:
    """A stored summary below ``root``; ``part`` is an expression of the keys."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    measures: dict[str, Measure]
    part: str

    @property
    def versions(self) -> Versions:
        return Versions(self.spark, self.root)

    def partials(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[m.of_rows().alias(n) for n, m in self.measures.items()]).withColumn(PART, F.expr(self.part))

    def _write(self, partials: DataFrame, folder: str) -> dict[str, str]:
        """Writes the parts and gives their folders, as found in the file system."""
        files.write_layer(partials, folder, [PART])
        return self.versions.folders(folder, f"{PART}=")

    def refresh(self, rows: DataFrame, since: str | None = None) -> Version:
        """Computes the summary from ``rows``; with ``since`` these replace all parts from there on."""
        old = self.versions.current()
        made = self._write(self.partials(rows), self.versions.begin())
        kept = {part: path for part, path in old.paths.items() if since is not None and part < since}
        return self.versions.commit({**kept, **made}, {} if since is None else old.notes, after=old)

    def append(self, rows: DataFrame, batch: str) -> Version:
        """Merges the aggregates of appended ``rows`` into the parts they touch."""
        old = self.versions.current()
        if old.notes.get(f"batch {batch}"):
            return old
        fresh = self.versions.begin()
        touched = self._write(self.partials(rows), f"{fresh}/appended")
        before = [old.paths[part] for part in touched if part in old.paths]
        both = self._read([*touched.values(), *before])
        if both is None:
            made = {}
        else:
            merged = both.groupBy(*self.keys).agg(*[m.merged(n).cast(both.schema[n].dataType).alias(n) for n, m in self.measures.items()])
            made = self._write(merged.withColumn(PART, F.expr(self.part)), f"{fresh}/merged")
        return self.versions.commit({**old.paths, **made}, {**old.notes, f"batch {batch}": "done"}, after=old)

    def _read(self, paths: list[str]) -> DataFrame | None:
        return self.spark.read.parquet(*sorted(paths)) if paths else None

    def read(self) -> DataFrame:
        """The partial aggregates of the current version."""
        found = self._read(list(self.versions.current().paths.values()))
        if found is None:
            raise ValueError(f"{self.root}: no version yet")
        return found

    def covers(self, wanted: Aggregate) -> bool:
        """Whether keys, conditions and measures of an aggregate can be had from the summary."""
        return (set(wanted.keys) <= set(self.keys) and {c for c, _, _ in wanted.where} <= set(self.keys)
                and set(wanted.measures.values()) <= set(self.measures.values()) and self.versions.current().number > 0)

    def answer(self, wanted: Aggregate) -> DataFrame:
        """The aggregate, rolled up from the summary."""
        names = {m: n for n, m in self.measures.items()}
        sums = self.read().filter(wanted.condition()).groupBy(*wanted.keys).agg(
            *[m.merged(names[m]).alias(n) for n, m in wanted.measures.items()])
        return wanted._finish(sums)


def answer(wanted: Aggregate, base: DataFrame, views: list[SummaryView]) -> DataFrame:
    """The aggregate from the covering summary with the fewest keys, else from the base rows."""
    covering = sorted((v for v in views if v.covers(wanted)), key=lambda v: len(v.keys))
    return covering[0].answer(wanted) if covering else wanted.from_rows(base)
