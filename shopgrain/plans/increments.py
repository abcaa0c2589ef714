"""Gold tables brought up to date from the silver months that changed since the last run.

Facts are divided by the months of their silver tables, and two tables of state are kept beside
them, divided the same way:

* `customer_months`: a row for each customer and month, from the orders;
* `order_lines`: a row for each order, product and month of the lines, with the order's month and
  whether it is completed, divided by the order's month.

A run compares the part folders of the silver tables with those the last run read. Facts of months
that differ are made anew, then their state, and then only the groups those months can have
changed: their days, the customers seen in them before or after, the months in which such a
customer was or is new, and the products' totals by order month. Groups without rows vanish.
Facts of other months are not read. What was read is written down last, so a run cut short is
made up for by the next.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions.expressions import count_where, month_number
from shopgrain.operators.lookup import lookup_join
from shopgrain.plans import facts, marts
from shopgrain.rules import MONTH_OF, BusinessRules
from shopgrain.runtime import for_each_table, written
from shopgrain.sources import snapshots
from shopgrain.sources.files import delete, join, names, read_text, write_text
from shopgrain.sources.snapshots import MONTH, MONTH_FORMAT

NONE = "none"
FACTS = {"fct_orders": "orders", "fct_order_items": "order_items", "fct_payments": "payments"}
_REVENUE = ("gross_revenue", "net_revenue")


@dataclass(frozen=True)
class Places:
    """Where things are: silver tables by entity, gold tables by name, and the folder of state."""

    silver: Callable[[str], str]
    gold: Callable[[str], str]
    state: str

    def kept(self, name: str) -> str:
        return join(self.state, name)


def _last_read(spark: SparkSession, places: Places) -> dict:
    """What the last run read and wrote; empty before the first, or when a fact was since replaced."""
    folder = places.kept("read")
    found = sorted(name for name in names(spark, folder) if name.endswith(".json"))
    if not found:
        return {}
    entry = json.loads(read_text(spark, join(folder, found[-1])))
    for table, number in entry["facts"].items():
        version = snapshots.current_version(spark, places.gold(table))
        if version is None or version.number != number:
            return {}
    return entry["silver"]


def _note_read(spark: SparkSession, places: Places, read: dict[str, dict[str, str]]) -> None:
    folder = places.kept("read")
    found = sorted(name for name in names(spark, folder) if name.endswith(".json"))
    number = int(found[-1][1:9]) + 1 if found else 1
    entry = {
        "silver": read,
        "facts": {t: snapshots.current_version(spark, places.gold(t)).number for t in FACTS},
    }
    write_text(spark, join(folder, f"r{number:08d}.json"), json.dumps(entry, sort_keys=True))
    for name in found[:-1]:
        delete(spark, join(folder, name))


def _differing(before: dict[str, str], now: dict[str, str]) -> set[str]:
    return {m for m in before.keys() | now.keys() if before.get(m) != now.get(m)}


def _month_of(moment: Column) -> Column:
    return F.coalesce(F.date_format(moment, MONTH_FORMAT), F.lit(NONE))


def _without(spark: SparkSession, path: str, full: bool, keep: Column) -> DataFrame | None:
    """The stored rows of a table that stay as they are; none when everything is made anew."""
    if full or not snapshots.has_snapshot(spark, path):
        return None
    return snapshots.read_snapshot(spark, path).where(keep)


def _store(path: str, fresh: DataFrame, stays: DataFrame | None) -> DataFrame:
    rows = fresh if stays is None else stays.unionByName(fresh)
    state = snapshots.overwrite(rows, path)
    return rows if state is None else state


def refresh(
    spark: SparkSession, places: Places, dimensions: dict[str, DataFrame], folder: str,
    rules: BusinessRules = BusinessRules(),
) -> tuple[dict[str, DataFrame], dict[str, set[str]]]:
    """(facts and marts, silver months that had changed) after bringing all of them up to date.

    `dimensions` holds the customers and products as they are now. What is staged goes below
    `folder`. Month names and counts are all that reaches the driver.
    """
    last = _last_read(spark, places)
    full = not last
    read = {e: snapshots.month_parts(spark, places.silver(e)) for e in FACTS.values()}
    touched = {
        entity: set(parts) if full else _differing(last.get(entity, {}), parts)
        for entity, parts in read.items()
    }
    if full:
        for name in ("customer_months", "order_lines", "product_months", "customers"):
            delete(spark, places.kept(name))
    tables: dict[str, DataFrame] = {}

    # State as it was, for the customers that are about to lose rows.
    affected = None
    months = touched["orders"]
    if not full:
        old = snapshots.read_months(spark, places.kept("customer_months"), months)
        affected = written(old.select("customer_key").distinct(), "customers-before", under=folder)

    def fact(table: str) -> DataFrame:
        entity = FACTS[table]
        if full:
            delete(spark, places.gold(table))
        if touched[entity]:
            rows = snapshots.read_months(spark, places.silver(entity), touched[entity])
            made = facts.fct_order_items(rows, (MONTH,)) if table == "fct_order_items" else (
                getattr(facts, table)(rows, rules, (MONTH,))
            )
            return snapshots.replace_months(made, places.gold(table), touched[entity])
        return snapshots.read_snapshot(spark, places.gold(table))

    tables |= dict(zip(FACTS, for_each_table(spark, fact, FACTS)))

    def fact_months(table: str, wanted: set[str]) -> DataFrame:
        return snapshots.read_months(spark, places.gold(table), wanted)

    def daily() -> DataFrame:
        days = touched["orders"] | touched["payments"]
        path = places.gold("mart_daily_sales")
        fresh = marts.mart_daily_sales(
            fact_months("fct_orders", days), fact_months("fct_payments", days)
        )
        stays = _without(spark, path, full, ~_month_of(F.col("sale_date")).isin(list(days)))
        return _store(path, fresh, stays)

    def customers() -> DataFrame:
        """The state of customers, one row each: those affected are added up from their months."""
        path = places.kept("customer_months")
        if months:
            fresh = fact_months("fct_orders", months).groupBy(MONTH, "customer_key").agg(
                *[F.sum(name).alias(name) for name in _REVENUE],
                F.count("order_key").alias("order_count"),
                count_where(F.col("is_cancelled")).alias("cancelled_orders"),
                F.min("order_timestamp").alias("first_order_date"),
                F.max("order_timestamp").alias("last_order_date"),
            )
            snapshots.replace_months(fresh, path, months)
        kept = snapshots.read_snapshot(spark, path)
        mine = kept
        stays = None
        if not full:
            now = snapshots.read_months(spark, path, months).select("customer_key")
            changed = written(affected.union(now).distinct(), "customers-changed", under=folder)
            same = F.col("customer_key").eqNullSafe(F.col("_key"))
            key = changed.select(F.col("customer_key").alias("_key"))
            mine = kept.join(key, same, "left_semi")
            stays = snapshots.read_snapshot(spark, places.kept("customers")).join(
                key, same, "left_anti"
            )
        totals = mine.groupBy("customer_key").agg(
            *[F.sum(n).alias(n) for n in (*_REVENUE, "order_count", "cancelled_orders")],
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
        )
        return _store(places.kept("customers"), totals, stays)

    def monthly(totals: DataFrame, before: DataFrame | None) -> DataFrame:
        path = places.gold("mart_monthly_revenue")
        debut = _month_of(F.col("first_order_date"))
        known = F.col("customer_key").isNotNull()
        new = totals.where(known).groupBy(debut.alias(MONTH)).agg(
            F.count(F.lit(1)).alias("new_customers")
        )
        wanted = set(months)
        if before is not None:
            # Months whose count of new customers differs; one row a month.
            was = before.where(known).groupBy(debut.alias(MONTH)).agg(
                F.count(F.lit(1)).alias("was")
            )
            moved = new.join(was, MONTH, "full").where(~F.col("new_customers").eqNullSafe(F.col("was")))
            wanted |= {row[0] for row in moved.select(MONTH).collect()}
        dated = F.col(MONTH) != NONE
        fresh = snapshots.read_months(spark, places.kept("customer_months"), wanted).groupBy(
            MONTH
        ).agg(
            *[F.sum(n).alias(n) for n in (*_REVENUE, "order_count")],
            count_where(known).alias("monthly_active_customers"),
            F.min(month_number(F.col("first_order_date"))).alias("month"),
        ).join(new, MONTH, "left").withColumns({
            "new_customers": F.when(dated, F.coalesce("new_customers", F.lit(0))).otherwise(F.lit(0)),
        }).withColumn(
            "returning_customers",
            F.when(dated, F.col("monthly_active_customers") - F.col("new_customers")).otherwise(
                F.lit(0)
            ),
        )
        label = F.coalesce(F.concat(F.lit("m"), F.col("year_month")), F.lit(NONE))
        return _store(path, marts.months_of(fresh), _without(
            spark, path, full, ~label.isin(list(wanted))
        ))

    def products() -> DataFrame:
        path, lines_path = places.kept("product_months"), places.kept("order_lines")
        lines_touched = touched["order_items"]
        if months or lines_touched:
            fresh = fact_months("fct_order_items", lines_touched).groupBy(
                "order_key", "product_key", F.col(MONTH).alias("line_month")
            ).agg(F.sum("quantity").alias("quantity"), F.sum("line_total").alias("line_total"))
            fresh = written(fresh, "lines", under=folder)
            wanted = months | {NONE}
            if full:
                wanted |= set(read["orders"])
            elif lines_touched:
                order_months = tables["fct_orders"].select("order_key", _month_of(
                    F.col("order_timestamp")).alias("m"))
                lying = lookup_join(fresh.select("order_key").distinct(), order_months,
                                    ["order_key"], under=folder).select("m")
                lay = snapshots.read_months(
                    spark, lines_path, set(snapshots.months(spark, lines_path))
                ).where(F.col("line_month").isin(list(lines_touched))).select(MONTH)
                # Month names.
                wanted |= {row[0] for row in lying.union(lay).distinct().collect()}
            columns = fresh.columns
            if not full:
                old = snapshots.read_months(spark, lines_path, wanted)
                fresh = old.where(~F.col("line_month").isin(list(lines_touched))).select(
                    *columns
                ).unionByName(fresh)
            orders = fact_months("fct_orders", wanted).select(
                "order_key", F.col(MONTH), F.coalesce("is_completed", F.lit(False)).alias("completed")
            )
            placed = lookup_join(fresh, orders, ["order_key"], "left", under=folder)
            snapshots.replace_months(
                placed.withColumn(MONTH, F.coalesce(MONTH, F.lit(NONE))), lines_path, wanted
            )
            totals = snapshots.read_months(spark, lines_path, wanted).where(
                F.col("completed").isNotNull()
            ).groupBy(MONTH, "product_key", "order_key").agg(
                F.sum("quantity").alias("quantity"), F.sum("line_total").alias("line_total"),
                F.max("completed").alias("completed"),
            ).groupBy(MONTH, "product_key").agg(
                F.sum("quantity").alias("total_quantity_sold"),
                F.sum("line_total").alias("gross_revenue"),
                F.sum(F.when(F.col("completed"), F.col("line_total")).otherwise(F.lit(0))).alias(
                    "net_revenue"
                ),
                F.count(F.lit(1)).alias("order_count"),
            )
            snapshots.replace_months(totals, path, wanted)
        added = snapshots.read_snapshot(spark, path).groupBy("product_key").agg(*[
            F.sum(n).alias(n) for n in ("total_quantity_sold", *_REVENUE, "order_count")
        ])
        return _store(
            places.gold("mart_product_performance"),
            marts.products_of(added, dimensions["dim_products"].select(
                "product_key", "product_id", "category", "subcategory", "product_name"
            )), None,
        )

    def by_customer() -> dict[str, DataFrame]:
        before = None
        if not full:
            before = written(
                snapshots.read_snapshot(spark, places.kept("customers")).select(
                    "customer_key", "first_order_date"
                ), "debuts-before", under=folder,
            )
        totals = customers()
        return {
            "mart_monthly_revenue": monthly(totals, before),
            "mart_customer_lifetime_value": _store(
                places.gold("mart_customer_lifetime_value"), marts.lifetime_of(totals), None
            ),
            "mart_customer_segments": _store(
                places.gold("mart_customer_segments"),
                marts.segments_of(totals.where("customer_key is not null"),
                                  dimensions["dim_customers"]), None,
            ),
        }

    made = for_each_table(spark, lambda work: work(), [
        lambda: {"mart_daily_sales": daily()}, by_customer,
        lambda: {"mart_product_performance": products()},
    ])
    for part in made:
        tables |= part
    _note_read(spark, places, read)
    return tables, touched
