"""Dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions.expressions import date_key, day, loaded_now
from shopgrain.rules import LOADED_AT, TABLES, BusinessRules


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from start to end, both included."""
    return calendar_days(
        spark.range(1).select(
            F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
        )
    )


def calendar_covering(frame: DataFrame, column: str) -> DataFrame:
    """The whole calendar years that contain the dates of a column."""
    bounds = frame.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return calendar_days(
        bounds.select(
            F.trunc("lo", "year").alias("first_day"),
            F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("last_day"),
        )
    )


def calendar_days(span: DataFrame) -> DataFrame:
    """Date dimension for a one-row frame `(first_day, last_day)`; weekdays count from Monday."""
    days = span.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        loaded_now().alias(LOADED_AT),
    )


def dim_date(spark: SparkSession, rules: BusinessRules = BusinessRules()) -> DataFrame:
    return calendar(spark, rules.calendar_start, rules.calendar_end)


def _dimension(table: str, frame: DataFrame, **computed) -> DataFrame:
    """Project `frame` to the contract columns of `table`; computed ones replace or add."""
    given = {LOADED_AT: loaded_now(), **computed}
    return frame.select(
        *[given.get(name, F.col(name)).alias(name) for name in TABLES[table].columns]
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    return _dimension(
        "dim_customers",
        customers,
        customer_key=F.col("customer_id"),
        signup_date=day(customers, "signup_date"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    return _dimension("dim_products", products, product_key=F.col("product_id"))


def dim_country(customers: DataFrame) -> DataFrame:
    """One row per country code, under the alphabetically first of its names."""
    countries = customers.groupBy("country_code").agg(F.min("country_name").alias("country_name"))
    return _dimension("dim_country", countries, country_key=F.col("country_code"))
