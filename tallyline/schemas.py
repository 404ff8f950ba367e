"""Schemas of the stored tables and streams."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# The ledger every operator works on: negative amount = expense, positive = income.
LEDGER = _struct(id=T.LongType(), date=T.DateType(), amount=MONEY,
                 category=T.StringType(), account=T.StringType())

# Bank statement files carry no id and their dates may be text.
STATEMENT = _struct(date=T.DateType(), amount=MONEY,
                    category=T.StringType(), account=T.StringType())

NEWS_RAW = _struct(timestamp=T.StringType(), headline=T.StringType(), sentiment=T.DoubleType())

# Body of a bank API answer: one document holds many transactions.
PAYLOAD = T.StructType([T.StructField("transactions", T.ArrayType(_struct(
    id=T.LongType(), date=T.StringType(), amount=T.DoubleType(),
    description=T.StringType(), account=T.StringType())))])

# Value of a message on the transaction topic.
STREAM_TRANSACTION = _struct(
    transaction_id=T.StringType(), account_id=T.StringType(), amount=T.DoubleType(),
    category=T.StringType(), merchant=T.StringType(), timestamp=T.StringType(),
    location=T.StringType(), is_fraudulent=T.BooleanType(), description=T.StringType())

# Value of a message on the balance-change topic.
BALANCE_CHANGE = _struct(
    account=T.StringType(), transaction_id=T.LongType(), transaction_date=T.StringType(),
    transaction_amount=T.DoubleType(), new_balance=T.DoubleType(),
    change_type=T.StringType(), change_timestamp=T.StringType())

BUDGET = _struct(year=T.IntegerType(), month=T.IntegerType(),
                 category_group=T.StringType(), budget_amount=T.DecimalType(10, 2))

HIERARCHY = _struct(category_id=T.LongType(), category_name=T.StringType(),
                    parent_category_id=T.LongType(), level=T.IntegerType())

LINEAGE = _struct(timestamp=T.StringType(), source=T.StringType(),
                  transformation=T.StringType(), destination=T.StringType(),
                  row_count=T.LongType())
