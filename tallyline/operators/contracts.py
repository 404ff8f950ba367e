"""Data contracts: column rules checked in one aggregate over the data."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import asdict, dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names used in stored contracts -> Spark types accepted for them.
TYPE_NAMES: dict[str, tuple[type[T.DataType], ...]] = {
    "Int64": (T.LongType,),
    "Int32": (T.IntegerType,),
    "Float64": (T.DoubleType,),
    "Decimal": (T.DecimalType,),
    "Utf8": (T.StringType,),
    "Date": (T.DateType,),
    "Datetime": (T.TimestampType, T.TimestampNTZType),
    "Boolean": (T.BooleanType,),
}


class ContractViolation(ValueError):
    """Raised when data must satisfy a contract and does not."""

    def __init__(self, result: ContractResult):
        super().__init__("; ".join(result.errors))
        self.result = result


@dataclass(frozen=True)
class ColumnContract:
    name: str
    dtype: str
    nullable: bool = True
    min_value: Any = None
    max_value: Any = None
    allowed_values: list[Any] | None = None


@dataclass(frozen=True)
class Rule:
    """A row-level rule: rows for which ``broken`` holds are counted."""

    column: str
    name: str
    broken: Column
    message: str


@dataclass(frozen=True)
class ContractResult:
    contract: str
    timestamp: str
    valid: bool
    errors: list[str]
    row_count: int


@dataclass(frozen=True)
class DataContract:
    contract_name: str
    columns: list[ColumnContract]
    require_both_bounds: bool = False
    created_at: str = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).isoformat())

    # --- schema, checked on the driver without touching data --------------------

    def schema_errors(self, df: DataFrame) -> list[str]:
        # Wording of the errors, also that of the rules below.
        expected, actual = [c.name for c in self.columns], df.columns
        errors = []
        if missing := sorted(set(expected) - set(actual)):
            errors.append(f"Missing columns: {missing}")
        if extra := sorted(set(actual) - set(expected)):
            errors.append(f"Extra columns: {extra}")
        for c in self._present(df):
            dtype = df.schema[c.name].dataType
            if not isinstance(dtype, TYPE_NAMES.get(c.dtype, ())):
                errors.append(f"Column '{c.name}' has type {dtype.simpleString()}, "
                              f"expected {c.dtype}")
        return errors

    def _present(self, df: DataFrame) -> list[ColumnContract]:
        return [c for c in self.columns if c.name in df.columns]

    # --- rules over rows -----------------------------------------------------------

    def rules(self, df: DataFrame) -> list[Rule]:
        rules = []
        for c in self._present(df):
            value = F.col(c.name)
            if not c.nullable:
                rules.append(Rule(c.name, "not_null", value.isNull(),
                                  f"Column '{c.name}' has null values but should not"))
            low, high = c.min_value, c.max_value
            if self.require_both_bounds and (low is None or high is None):
                low = high = None
            if low is not None or high is not None:
                broken = F.lit(False)
                if low is not None:
                    broken = broken | (value < low)
                if high is not None:
                    broken = broken | (value > high)
                rules.append(Rule(c.name, "range", broken,
                                  f"Column '{c.name}' values outside range [{low}, {high}]"))
            if c.allowed_values:
                rules.append(Rule(c.name, "allowed_values", _not_allowed(c),
                                  f"Column '{c.name}' has invalid values"))
        return rules

    def report(self, df: DataFrame) -> DataFrame:
        """One row per rule with the number of rows that break it; one pass."""
        return count_rules(df, self.rules(df))

    def offenders(self, df: DataFrame, column: str) -> DataFrame:
        """Every value the contract does not allow, with its row count."""
        contract = next(c for c in self.columns if c.name == column)
        return (df.filter(_not_allowed(contract)).groupBy(column)
                .agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), column))

    def all_offenders(self, df: DataFrame) -> DataFrame:
        """(column_name, value, rows) of every value that an allowed list does not hold."""
        listed = [c.name for c in self._present(df) if c.allowed_values]
        empty = df.sparkSession.createDataFrame([], "column_name STRING, value STRING, rows BIGINT")
        parts = [self.offenders(df, name).select(F.lit(name).alias("column_name"),
                                                 F.col(name).cast("string").alias("value"), "rows") for name in listed]
        return reduce(DataFrame.unionByName, parts, empty)

    def metrics(self, df: DataFrame) -> list[Column]:
        """Row count and broken rows of every rule, as aggregates that may ride on another pass."""
        return [F.count(F.lit(1)).alias("rows"), *[F.count_if(r.broken).alias(f"rule_{k}") for k, r in enumerate(self.rules(df))]]

    def result(self, df: DataFrame, counts: dict[str, int]) -> ContractResult:
        """What the ``metrics`` of ``df`` say about it."""
        errors = self.schema_errors(df)
        for k, rule in enumerate(self.rules(df)):
            broken = counts[f"rule_{k}"]
            if broken:
                errors.append(f"{rule.message} in {broken} rows" if rule.name == "allowed_values" else rule.message)
        return ContractResult(self.contract_name, dt.datetime.now(dt.timezone.utc).isoformat(),
                              not errors, errors, counts["rows"])

    def validate(self, df: DataFrame) -> ContractResult:
        """Check schema and rules in one aggregate. ``all_offenders`` lists the values."""
        return self.result(df, df.agg(*self.metrics(df)).first().asDict())

    def enforce(self, df: DataFrame) -> DataFrame:
        """Pass valid data on, or stop the run."""
        result = self.validate(df)
        if not result.valid:
            raise ContractViolation(result)
        return df

    # --- storage ------------------------------------------------------------------

    def to_json(self) -> str:
        return json.dumps({"contract_name": self.contract_name, "created_at": self.created_at,
                           "columns": [asdict(c) for c in self.columns]}, indent=2)

    @classmethod
    def from_json(cls, text: str) -> DataContract:
        body = json.loads(text)
        more = {"created_at": body["created_at"]} if "created_at" in body else {}
        return cls(body["contract_name"], [ColumnContract(**c) for c in body["columns"]], **more)


def _not_allowed(contract: ColumnContract) -> Column:
    value = F.col(contract.name)
    allowed = [v for v in contract.allowed_values if v is not None]
    outside = value.isNotNull() & ~value.isin(*allowed)
    # A missing value offends unless NULL itself is listed.
    return outside if None in contract.allowed_values else outside | value.isNull()


def count_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(column_name, rule, failing_rows, valid) from a single aggregate row."""
    counts = df.agg(*[F.count_if(r.broken).alias(f"c{i}") for i, r in enumerate(rules)])
    lines = F.array(*[
        F.struct(F.lit(r.column).alias("column_name"), F.lit(r.name).alias("rule"),
                 F.col(f"c{i}").alias("failing_rows"), (F.col(f"c{i}") == 0).alias("valid"))
        for i, r in enumerate(rules)])
    return counts.select(F.inline(lines))


# Categories the ledger contract allows.
KNOWN_CATEGORIES = ["Salary", "Shopping", "Transport", "Restaurant", "Coffee", "Utilities",
                    "Entertainment"]


def ledger_contract(low: float = -10_000, high: float = 100_000) -> DataContract:
    return DataContract("transactions_contract", [
        ColumnContract("id", "Int64", nullable=False),
        ColumnContract("date", "Date", nullable=False),
        ColumnContract("amount", "Decimal", nullable=False, min_value=low, max_value=high),
        ColumnContract("category", "Utf8", nullable=False, allowed_values=KNOWN_CATEGORIES),
        ColumnContract("account", "Utf8", nullable=False),
    ])


def silver_contract() -> DataContract:
    return DataContract("silver_transactions_contract", [
        ColumnContract("transaction_id", "Utf8", nullable=False),
        ColumnContract("amount", "Float64", nullable=False),
        ColumnContract("date", "Date", nullable=False),
        ColumnContract("category", "Utf8"),
        ColumnContract("account_id", "Utf8", nullable=False),
    ])
