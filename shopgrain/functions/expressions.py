"""Column helpers shared by the builders. All of them are built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType

MONEY = DecimalType(18, 2)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, 0.0 unless the denominator is positive."""
    return F.when(
        denominator > 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))


def moment(frame: DataFrame, name: str) -> Column:
    """A timestamp column; text that is no timestamp becomes null instead of failing the job."""
    if isinstance(frame.schema[name].dataType, StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name)


def day(frame: DataFrame, name: str) -> Column:
    """A date column; unreadable text becomes null."""
    if isinstance(frame.schema[name].dataType, StringType):
        return F.col(name).try_cast("date")
    return F.col(name).cast("date")


def date_key(when: Column) -> Column:
    """20240301 for 2024-03-01."""
    return (F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)).cast("int")


def month_number(when: Column) -> Column:
    """202403 for a day in March 2024."""
    return F.year(when) * 100 + F.month(when)


def month_text(number: Column) -> Column:
    """`2024-03` for 202403."""
    digits = number.cast("string")
    return F.concat(F.left(digits, F.lit(4)), F.lit("-"), F.right(digits, F.lit(2)))


def status_in(status: Column, values: Iterable[str], ignore_case: bool = False) -> Column:
    wanted = list(values)
    if ignore_case:
        return F.lower(status).isin([value.lower() for value in wanted])
    return status.isin(wanted)


def money_if(condition: Column, amount: Column) -> Column:
    """The amount where the condition holds, a typed zero where it is false or null."""
    return F.when(condition, amount).otherwise(F.lit(0).cast(MONEY)).cast(MONEY)


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def round_money(amount: Column) -> Column:
    return F.round(amount, 2).cast(MONEY)


def loaded_now() -> Column:
    return F.current_timestamp()


def upper_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[name.upper() for name in frame.columns])


def padded_code(prefix: str, number: Column, width: int) -> Column:
    """`SKU-000042` for prefix `SKU-`, 42 and width 6. Longer numbers keep all digits."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))
