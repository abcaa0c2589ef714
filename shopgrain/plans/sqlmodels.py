"""The curated layer again as Spark SQL: staging and intermediate views, mart tables.

`create_views` registers temporary views over curated tables; each is one query, so a mart is planned
as a whole. `ratio` and the status test are written out by two small helpers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopgrain.rules import LOADED_AT, TABLES

STAGED = (
    "dim_country",
    "dim_customers",
    "dim_date",
    "dim_products",
    "fct_order_items",
    "fct_orders",
    "fct_payments",
)


def sql_ratio(numerator: str, denominator: str) -> str:
    """Quotient as double, 0 unless the denominator is positive."""
    return (
        f"if({denominator} > 0, cast({numerator} as double) / cast({denominator} as double), "
        "cast(0 as double))"
    )


def sql_status_in(column: str, values: tuple[str, ...]) -> str:
    """Case-insensitive status test."""
    listed = ", ".join("'" + value.lower().replace("'", "''") + "'" for value in values)
    return f"lower({column}) in ({listed})"


def _columns(table: str, alias: str = "", skip: tuple[str, ...] = ()) -> str:
    prefix = f"{alias}." if alias else ""
    return ", ".join(prefix + name for name in TABLES[table].columns if name not in skip)


def staging_sql(table: str, source: str) -> str:
    return f"select {_columns(table)} from {source}"


# View name -> query, in dependency order.
INTERMEDIATE: dict[str, str] = {
    "int_orders_enriched": f"""
        select {_columns("fct_orders")},
               customer_segment, country_code, country_name, city
        from stg_fct_orders
        join (select customer_key, customer_segment, country_code, country_name, city
              from stg_dim_customers) using (customer_key)
    """,
    "int_order_items_enriched": """
        with header as (
            select order_key, is_completed, gross_revenue as order_gross_revenue,
                   net_revenue as order_net_revenue
            from stg_fct_orders
        ), product as (
            select product_key, product_id, category, subcategory, product_name
            from stg_dim_products
        )
        select order_item_key, order_key, product_key, quantity, unit_price, discount_pct,
               line_total, is_completed, order_gross_revenue, order_net_revenue, product_id,
               category, subcategory, product_name, gold_loaded_at
        from stg_fct_order_items join header using (order_key) join product using (product_key)
    """,
    "int_orders_daily": """
        select date(order_timestamp) as sale_date,
               sum(gross_revenue) as gross_revenue,
               sum(net_revenue) as net_revenue,
               count(order_key) as order_count,
               count(*) filter (where is_cancelled) as cancelled_order_count,
               count(*) filter (where is_refunded) as refunded_order_count
        from stg_fct_orders
        group by date(order_timestamp)
    """,
    "int_payments_daily": """
        select date(payment_timestamp) as sale_date,
               count(*) filter (where is_failed) as payment_failure_count,
               count(payment_key) as payment_attempt_count
        from stg_fct_payments
        group by date(payment_timestamp)
    """,
    "int_customer_first_order": """
        select customer_key, min(order_timestamp) as first_order_timestamp
        from stg_fct_orders
        group by customer_key
    """,
    "int_customer_segment_orders": """
        select order_key, customer_key, order_timestamp, order_status, is_completed, is_cancelled,
               is_refunded, gross_revenue, net_revenue, customer_segment, country_code,
               country_name
        from int_orders_enriched
    """,
}

MARTS: dict[str, str] = {
    "sql_mart_daily_sales": f"""
        select sale_date, gross_revenue, net_revenue, order_count, cancelled_order_count,
               refunded_order_count,
               nvl(payment_failure_count, 0) as payment_failure_count,
               nvl(payment_attempt_count, 0) as payment_attempt_count,
               {sql_ratio("net_revenue", "order_count")} as average_order_value,
               {sql_ratio("payment_failure_count", "payment_attempt_count")}
                   as payment_failure_rate,
               {sql_ratio("cancelled_order_count", "order_count")} as cancellation_rate,
               now() as {LOADED_AT}
        from int_orders_daily left join int_payments_daily using (sale_date)
    """,
    "sql_mart_monthly_revenue": f"""
        with activity as (
            select customer_key, date_format(order_timestamp, 'yyyy-MM') as year_month,
                   sum(gross_revenue) as gross_revenue, sum(net_revenue) as net_revenue,
                   count(order_key) as order_count
            from stg_fct_orders
            group by customer_key, date_format(order_timestamp, 'yyyy-MM')
        ), debut as (
            select customer_key, date_format(first_order_timestamp, 'yyyy-MM') as first_month
            from int_customer_first_order
        ), months as (
            select year_month, sum(gross_revenue) as gross_revenue,
                   sum(net_revenue) as net_revenue, sum(order_count) as order_count,
                   count(customer_key) as monthly_active_customers,
                   count(customer_key) filter (where first_month = year_month) as new_customers,
                   count(customer_key) filter (where first_month <> year_month)
                       as returning_customers
            from activity left join debut using (customer_key)
            group by year_month
        )
        select *, {sql_ratio("net_revenue", "order_count")} as average_order_value,
               now() as {LOADED_AT}
        from months
    """,
    "sql_mart_customer_lifetime_value": f"""
        with totals as (
            select customer_key, count(order_key) as total_orders,
                   sum(gross_revenue) as total_revenue, sum(net_revenue) as net_revenue,
                   min(order_timestamp) as first_order_date,
                   max(order_timestamp) as last_order_date
            from stg_fct_orders
            group by customer_key
        )
        select *, {sql_ratio("net_revenue", "total_orders")} as avg_order_value,
               if(total_orders > 1, 1d, 0d) as repeat_purchase_rate, now() as {LOADED_AT}
        from totals
    """,
    "sql_mart_product_performance": f"""
        with lines as (
            select /*+ repartition(order_key) */ order_key, product_key, quantity, line_total
            from stg_fct_order_items
        ), pairs as (
            select order_key, product_key, sum(quantity) as quantity, sum(line_total) as total
            from lines
            group by order_key, product_key
        ), totals as (
            select product_key, sum(quantity) as total_quantity_sold,
                   sum(total) as gross_revenue,
                   nvl(sum(total) filter (where is_completed), 0) as net_revenue,
                   count(*) as order_count
            from pairs join (select order_key, is_completed from stg_fct_orders) using (order_key)
            group by product_key
        )
        select product_id, category, subcategory, product_name, total_quantity_sold,
               gross_revenue, net_revenue, order_count,
               {sql_ratio("net_revenue", "total_quantity_sold")} as avg_unit_revenue,
               now() as {LOADED_AT}
        from totals join stg_dim_products using (product_key)
    """,
    "sql_mart_customer_segments": f"""
        with per_customer as (
            select customer_key, sum(gross_revenue) as gross_revenue,
                   sum(net_revenue) as net_revenue, count(order_key) as orders,
                   count(*) filter (where is_cancelled) as cancelled
            from stg_fct_orders
            group by customer_key
        ), placed as (
            select customer_segment, country_code, country_name, count(*) as customer_count,
                   sum(gross_revenue) as total_revenue, sum(net_revenue) as net_revenue,
                   sum(orders) as order_count, sum(cancelled) as cancelled_orders,
                   count(*) filter (where orders > 1) as repeaters
            from per_customer join stg_dim_customers using (customer_key)
            group by customer_segment, country_code, country_name
        ), by_code as (
            select customer_segment, country_code, sum(repeaters) as repeat_customers,
                   sum(customer_count) as customers_with_orders
            from placed
            group by customer_segment, country_code
        )
        select customer_segment, country_code, country_name, customer_count, total_revenue,
               net_revenue, order_count, cancelled_orders,
               customer_count as ordering_customers,
               nvl(repeat_customers, 0) as repeat_customers,
               nvl(customers_with_orders, 0) as customers_with_orders,
               {sql_ratio("net_revenue", "order_count")} as avg_order_value,
               {sql_ratio("repeat_customers", "customers_with_orders")} as repeat_purchase_rate,
               {sql_ratio("cancelled_orders", "order_count")} as cancellation_rate,
               now() as {LOADED_AT}
        from placed left join by_code using (customer_segment, country_code)
    """,
}


def create_views(
    spark: SparkSession, curated: dict[str, DataFrame], only: str | None = None
) -> list[str]:
    """Register staging, intermediate and mart views over the curated tables, as temporary views.

    Views whose tables are not in `curated` are left out; `only` registers one view and those
    it reads.
    """
    wanted = None if only is None else {only, *_all_reads(only)}
    created = []
    for table in STAGED:
        name = f"stg_{table}"
        if table not in curated or (wanted is not None and name not in wanted):
            continue
        curated[table].createOrReplaceTempView(f"raw_{table}")
        _view(spark, name, staging_sql(table, f"raw_{table}"))
        created.append(name)
    for name, query in {**INTERMEDIATE, **MARTS}.items():
        if wanted is not None and name not in wanted:
            continue
        if all(part in created for part in _reads(query)):
            _view(spark, name, query)
            created.append(name)
    return created


def tables_behind(name: str) -> list[str]:
    """Curated tables a view is built from."""
    return [table for table in STAGED if f"stg_{table}" in {name, *_all_reads(name)}]


def _all_reads(name: str) -> set[str]:
    direct = _reads({**INTERMEDIATE, **MARTS}.get(name, ""))
    return direct.union(*[_all_reads(part) for part in direct])


def materialise_marts(spark: SparkSession, database: str) -> list[str]:
    """Save the mart views as tables of a database; staging and intermediate stay views."""
    spark.sql(f"create database if not exists {database}")
    saved = []
    for name in MARTS:
        table = f"{database}.{name.removeprefix('sql_')}"
        spark.table(name).write.mode("overwrite").saveAsTable(table)
        saved.append(table)
    return saved


def _view(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"create or replace temporary view {name} as {query}")


def _reads(query: str) -> set[str]:
    known = [f"stg_{table}" for table in STAGED] + list(INTERMEDIATE)
    words = set(query.replace("(", " ").replace(")", " ").split())
    return {name for name in known if name in words}
