"""DuckDB SQL for the registered queries, written independently of the Spark plans."""

from __future__ import annotations

# --- the entities in DuckDB SQL -----------------------------------------------------------------

BASE: dict[str, str] = {
    "e_customers": """
        select c_custkey as customer_id, lower(replace(c_name,'#','.'))||'@example.test' as email,
               'Customer' as first_name, split_part(c_name,'#',2) as last_name,
               'N'||lpad(cast(c_nationkey as varchar),2,'0') as country_code,
               n_name as country_name, r_name as city,
               case when c_mktsegment in ('AUTOMOBILE','BUILDING') then 'budget'
                    when c_mktsegment in ('FURNITURE','HOUSEHOLD') then 'standard'
                    else 'premium' end as customer_segment,
               date '1995-01-01' + cast(c_custkey % 365 as int) as signup_date,
               c_acctbal > 0 as is_active
        from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey
    """,
    "e_products": """
        select p_partkey as product_id, 'SKU-'||lpad(cast(p_partkey as varchar),6,'0') as sku,
               p_name as product_name, p_type as category, split_part(p_name,' ',2) as subcategory,
               p_brand as brand, cast(p_retailprice as decimal(12,2)) as unit_price,
               cast(cast(p_retailprice as decimal(12,2))*0.6 as decimal(12,2)) as unit_cost,
               p_size > 2 as is_active
        from part
    """,
    "e_orders": """
        select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_date,
               case when o_orderstatus='O' and o_orderpriority='5-LOW' then 'cancelled'
                    when o_orderstatus='O' and o_orderpriority='4-NOT SPECIFIED' then 'refunded'
                    when o_orderstatus='O' then 'pending'
                    when o_orderstatus='P' and o_orderpriority='1-URGENT' then 'failed'
                    else 'completed' end as order_status,
               'N'||lpad(cast(o_custkey % 25 as varchar),2,'0') as shipping_country,
               cast(cast(o_totalprice as decimal(18,2))
                    - cast(cast(o_totalprice as decimal(18,2))*0.08 as decimal(18,2))
                    - 4.99 as decimal(18,2)) as subtotal_amount,
               cast(0 as decimal(18,2)) as discount_amount,
               cast(4.99 as decimal(18,2)) as shipping_amount,
               cast(cast(o_totalprice as decimal(18,2))*0.08 as decimal(18,2)) as tax_amount,
               cast(o_totalprice as decimal(18,2)) as total_amount,
               o_orderdate as updated_at
        from orders
    """,
    "e_payments": """
        select order_id as payment_id, order_id,
               order_date + to_minutes(cast(order_id % 119 + 1 as int)) as payment_date,
               case cast(order_id % 5 as int) when 0 then 'credit_card' when 1 then 'debit_card'
                    when 2 then 'paypal' when 3 then 'bank_transfer' else 'gift_card' end
                   as payment_method,
               case when order_status='failed' then 'failed'
                    when order_status='cancelled'
                        then case when order_id % 10 < 7 then 'failed' else 'pending' end
                    when order_status='refunded' then 'refunded'
                    when order_status='pending'
                        then case when order_id % 10 < 8 then 'pending' else 'succeeded' end
                    else case when order_id % 100 < 7 then 'failed' else 'succeeded' end end
                   as payment_status,
               total_amount as amount
        from e_orders
    """,
    "e_items": """
        select l_orderkey*10+l_linenumber as order_item_id, l_orderkey as order_id,
               l_partkey as product_id, cast(l_quantity as int) as quantity,
               l_extendedprice/l_quantity as unit_price,
               cast(l_discount as decimal(5,4)) as discount_pct,
               cast(cast(l_extendedprice as decimal(18,2))*(1-cast(l_discount as decimal(5,2)))
                    as decimal(14,2)) as line_total,
               l_shipdate
        from lineitem
    """,
    "e_events": """
        select cast(event_id as varchar) as event_id,
               case event_type when 'view' then 'page_view' when 'click' then 'product_view'
                    when 'signup' then 'checkout_start' else event_type end as event_type,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as event_timestamp, user_id as customer_id,
               'sess_'||lpad(cast(user_id as varchar),6,'0')||'_'||cast(cast(ts as date) as varchar)
                   as session_id,
               case when event_type='purchase' then value end as order_value
        from events
    """,
    "e_updates": """
        select p_partkey as update_id, p_partkey as product_id,
               'SKU-'||lpad(cast(p_partkey as varchar),6,'0') as sku,
               'price_change' as update_type, '2024-02-01T00:00:00' as effective_at,
               cast(cast(p_retailprice as decimal(12,2)) as varchar) as old_value,
               cast(cast(cast(p_retailprice as decimal(12,2))*1.1 as decimal(12,2)) as varchar)
                   as new_value
        from part
    """,
    "f_orders": """
        select order_id as order_key, customer_id as customer_key,
               cast(strftime(order_date,'%Y%m%d') as int) as order_date_key,
               order_date as order_timestamp, order_status, shipping_country, subtotal_amount,
               discount_amount, shipping_amount, tax_amount, total_amount,
               order_status='completed' as is_completed, order_status='cancelled' as is_cancelled,
               order_status='refunded' as is_refunded,
               cast(case when order_status in ('completed','refunded') then total_amount else 0 end
                    as decimal(18,2)) as gross_revenue,
               cast(case when order_status='completed' then total_amount else 0 end
                    as decimal(18,2)) as net_revenue
        from e_orders
    """,
    "f_payments": """
        select payment_id as payment_key, order_id as order_key,
               cast(strftime(payment_date,'%Y%m%d') as int) as payment_date_key,
               payment_date as payment_timestamp, payment_method, payment_status, amount,
               payment_status='succeeded' as is_successful, payment_status='failed' as is_failed
        from e_payments
    """,
    "f_items": """
        select order_item_id as order_item_key, order_id as order_key, product_id as product_key,
               quantity, unit_price, discount_pct, cast(line_total as decimal(18,2)) as line_total
        from e_items
    """,
    "m_daily": """
        select o.*, coalesce(payment_failure_count,0) as payment_failure_count,
               coalesce(payment_attempt_count,0) as payment_attempt_count
        from (select cast(order_timestamp as date) as sale_date, sum(gross_revenue) as gross_revenue,
                     sum(net_revenue) as net_revenue, count(*) as order_count,
                     cast(sum(case when is_cancelled then 1 else 0 end) as bigint)
                         as cancelled_order_count,
                     cast(sum(case when is_refunded then 1 else 0 end) as bigint)
                         as refunded_order_count
              from f_orders group by 1) o
        left join (select cast(payment_timestamp as date) as sale_date,
                          cast(sum(case when is_failed then 1 else 0 end) as bigint)
                              as payment_failure_count,
                          count(*) as payment_attempt_count
                   from f_payments group by 1) p on o.sale_date=p.sale_date
    """,
    "m_monthly": """
        with visits as (
            select customer_key, strftime(order_timestamp,'%Y-%m') as year_month,
                   sum(gross_revenue) as gross, sum(net_revenue) as net, count(*) as orders,
                   min(strftime(order_timestamp,'%Y-%m')) over (partition by customer_key) as debut
            from f_orders group by customer_key, order_timestamp
        ), customer_months as (
            select customer_key, year_month, debut, sum(gross) as gross, sum(net) as net,
                   sum(orders) as orders
            from visits group by all
        )
        select year_month, sum(gross) as gross_revenue, sum(net) as net_revenue,
               cast(sum(orders) as bigint) as order_count,
               count(customer_key) as monthly_active_customers,
               count(customer_key) filter (where year_month = debut) as new_customers,
               count(customer_key) filter (where year_month > debut) as returning_customers
        from customer_months group by year_month
    """,
    "m_clv": """
        select customer_key, count(*) as total_orders, sum(gross_revenue) as total_revenue,
               sum(net_revenue) as net_revenue, min(order_timestamp) as first_order_date,
               max(order_timestamp) as last_order_date
        from f_orders group by 1
    """,
    "m_products": """
        select product_id, category, subcategory, product_name,
               cast(sum(quantity) as bigint) as total_quantity_sold,
               sum(line_total) as gross_revenue,
               sum(case when is_completed then line_total else 0 end) as net_revenue,
               count(distinct i.order_key) as order_count
        from f_items i join f_orders o on i.order_key=o.order_key
        join e_products p on i.product_key=p.product_id
        group by 1,2,3,4
    """,
    "m_segments": """
        with buyers as (
            select customer_key, count(*) as orders, sum(gross_revenue) as gross,
                   sum(net_revenue) as net, count(*) filter (where is_cancelled) as cancelled
            from f_orders group by customer_key
        )
        select customer_segment, country_code, country_name,
               count(*) as customer_count, count(*) as ordering_customers,
               sum(gross) as total_revenue, sum(net) as net_revenue,
               cast(sum(orders) as bigint) as order_count,
               cast(sum(cancelled) as bigint) as cancelled_orders,
               cast(sum(count(*) filter (where orders > 1)) over same_code as bigint)
                   as repeat_customers,
               cast(sum(count(*)) over same_code as bigint) as customers_with_orders
        from buyers join e_customers on customer_id = customer_key
        group by customer_segment, country_code, country_name
        window same_code as (partition by customer_segment, country_code)
    """,
    "m_daily_out": """
        select sale_date, cast(gross_revenue as double) as gross_revenue,
               cast(net_revenue as double) as net_revenue, order_count, cancelled_order_count,
               refunded_order_count, payment_failure_count, payment_attempt_count,
               cast(net_revenue as double)/order_count as average_order_value,
               case when payment_attempt_count>0
                    then cast(payment_failure_count as double)/payment_attempt_count
                    else 0 end as payment_failure_rate,
               cast(cancelled_order_count as double)/order_count as cancellation_rate
        from m_daily
    """,
    "m_monthly_out": """
        select year_month, cast(gross_revenue as double) as gross_revenue,
               cast(net_revenue as double) as net_revenue, order_count, monthly_active_customers,
               new_customers, returning_customers,
               cast(net_revenue as double)/order_count as average_order_value
        from m_monthly
    """,
    "m_clv_out": """
        select customer_key, total_orders, cast(total_revenue as double) as total_revenue,
               cast(net_revenue as double) as net_revenue, first_order_date, last_order_date,
               cast(net_revenue as double)/total_orders as avg_order_value,
               case when total_orders>1 then cast(1 as double) else 0 end as repeat_purchase_rate
        from m_clv
    """,
    "m_products_out": """
        select product_id, category, subcategory, product_name, total_quantity_sold,
               cast(gross_revenue as double) as gross_revenue,
               cast(net_revenue as double) as net_revenue, order_count,
               case when total_quantity_sold>0
                    then cast(net_revenue as double)/total_quantity_sold else 0 end
                   as avg_unit_revenue
        from m_products
    """,
    "m_segments_out": """
        select customer_segment, country_code, country_name, customer_count,
               cast(total_revenue as double) as total_revenue,
               cast(net_revenue as double) as net_revenue, order_count, cancelled_orders,
               ordering_customers, repeat_customers, customers_with_orders,
               cast(net_revenue as double)/order_count as avg_order_value,
               cast(repeat_customers as double)/customers_with_orders
                   as repeat_purchase_rate,
               cast(cancelled_orders as double)/order_count as cancellation_rate
        from m_segments
    """,
}


def sql(body: str, **replaced: str) -> str:
    """`body` with the base queries it needs in front; `replaced` swaps single ones."""
    parts = {**BASE, **replaced}
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in parts:
            if name in text and name not in needed:
                needed.add(name)
                pending.append(parts[name])
    ctes = [f"{name} as ({parts[name]})" for name in parts if name in needed]
    return f"with {', '.join(ctes)} {body}" if ctes else body


_ORDERS_OUT = """
    order_key, customer_key, order_date_key, order_timestamp, order_status, shipping_country,
    cast(subtotal_amount as double) as subtotal_amount,
    cast(discount_amount as double) as discount_amount,
    cast(shipping_amount as double) as shipping_amount, cast(tax_amount as double) as tax_amount,
    cast(total_amount as double) as total_amount, is_completed, is_cancelled, is_refunded,
    cast(gross_revenue as double) as gross_revenue, cast(net_revenue as double) as net_revenue
"""
_CUSTOMERS_OUT = """
    customer_id as customer_key, customer_id, email, first_name, last_name, country_code,
    country_name, city, customer_segment, signup_date, is_active
"""

# Spark keeps -0.0 out of decimals; a plain double cast of a decimal zero is +0.0 here as well.
_ITEM_REASON = """
    nullif(concat_ws('|',
        case when quantity <= 0 then 'below_min_exclusive_quantity' end,
        case when unit_price <= 0 then 'below_min_exclusive_unit_price' end,
        case when discount_pct < 0 then 'below_min_discount_pct' end,
        case when discount_pct > 1 then 'above_max_discount_pct' end,
        case when line_total < 0 then 'below_min_line_total' end,
        case when count(*) over (partition by order_item_id) > 1
             then 'duplicate_order_item_id' end), '')
"""

DIM_DATE = """
    select cast(strftime(d,'%Y%m%d') as int) as date_key, cast(d as date) as full_date,
           cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
           cast(month(d) as int) as month, monthname(d) as month_name, cast(day(d) as int) as day,
           cast(isodow(d) as int) as day_of_week, dayname(d) as day_name,
           cast(weekofyear(d) as int) as week_of_year, isodow(d) >= 6 as is_weekend
    from (select unnest(generate_series(date_trunc('year', min(o_orderdate)),
                 date_trunc('year', max(o_orderdate)) + interval 1 year - interval 1 day,
                 interval 1 day)) as d from orders)
"""

_FINISHED = {
    "dim_date": DIM_DATE,
    "dim_customers": sql(f"select {_CUSTOMERS_OUT} from e_customers"),
    "dim_products": sql(
        "select product_id as product_key, product_id, sku, product_name, category, subcategory, "
        "brand, cast(unit_price as double) as unit_price, cast(unit_cost as double) as unit_cost, "
        "is_active from e_products"
    ),
    "dim_country": sql(
        "select distinct country_code as country_key, country_code, country_name from e_customers"
    ),
    "fct_orders": sql(f"select {_ORDERS_OUT} from f_orders"),
    "fct_order_items": sql(
        "select order_item_key, order_key, product_key, quantity, unit_price, "
        "cast(discount_pct as double) as discount_pct, cast(line_total as double) as line_total "
        "from f_items"
    ),
    "fct_payments": sql(
        "select payment_key, order_key, payment_date_key, payment_timestamp, payment_method, "
        "payment_status, cast(amount as double) as amount, is_successful, is_failed "
        "from f_payments"
    ),
}
_MARTS = {
    "mart_daily_sales": "m_daily_out",
    "mart_monthly_revenue": "m_monthly_out",
    "mart_customer_lifetime_value": "m_clv_out",
    "mart_product_performance": "m_products_out",
    "mart_customer_segments": "m_segments_out",
}

ORACLES: dict[str, str] = dict(_FINISHED)
for _name, _cte in _MARTS.items():
    ORACLES[_name] = ORACLES[f"sql_{_name}"] = sql(f"select * from {_cte}")
for _name, _text in _FINISHED.items():
    ORACLES[f"stg_{_name}"] = _text

ORACLES["category_revenue_rollup"] = sql("""
    select category, subcategory, cast(grouping(category, subcategory) as int) as level,
           cast(sum(gross_revenue) as double) as gross_revenue,
           cast(sum(net_revenue) as double) as net_revenue,
           cast(sum(total_quantity_sold) as bigint) as total_quantity_sold
    from m_products group by rollup(category, subcategory)
""")
ORACLES["segment_country_revenue_cube"] = sql("""
    select customer_segment, country_code,
           cast(grouping(customer_segment, country_code) as int) as level,
           cast(sum(total_revenue) as double) as total_revenue,
           cast(sum(net_revenue) as double) as net_revenue,
           cast(sum(customer_count) as bigint) as customer_count,
           cast(sum(order_count) as bigint) as order_count
    from m_segments group by cube(customer_segment, country_code)
""")
ORACLES["orders_by_status_any_case"] = sql("""
    select s as order_status, count(*) filter (where s='completed') as exact_matches,
           count(*) filter (where lower(s)='completed') as any_case_matches,
           count(*) filter (where lower(s)='completed') as sql_matches
    from (select case when total_amount > 100000 then upper(order_status) else order_status end as s
          from e_orders) group by 1
""")
ORACLES["fct_orders_null_status"] = sql("""
    select case when order_status<>'pending' then is_completed end as is_completed,
           case when order_status<>'pending' then is_cancelled end as is_cancelled,
           case when order_status<>'pending' then is_refunded end as is_refunded,
           count(*) as order_count, cast(sum(gross_revenue) as double) as gross_revenue,
           cast(sum(net_revenue) as double) as net_revenue
    from f_orders group by 1,2,3
""")

# --- intermediate -------------------------------------------------------------------------------

ORACLES["int_orders_enriched"] = ORACLES["sql_int_orders_enriched"] = sql(
    f"select {_ORDERS_OUT}, customer_segment, country_code, country_name, city "
    "from f_orders join e_customers on customer_key=customer_id"
)
ORACLES["int_order_items_enriched"] = ORACLES["sql_int_order_items_enriched"] = sql("""
    select order_item_key, i.order_key, product_key, quantity, i.unit_price,
           cast(discount_pct as double) as discount_pct, cast(line_total as double) as line_total,
           is_completed, cast(gross_revenue as double) as order_gross_revenue,
           cast(net_revenue as double) as order_net_revenue, product_id, category, subcategory,
           product_name
    from f_items i join f_orders o on i.order_key=o.order_key
    join e_products on product_key=product_id
""")
ORACLES["int_orders_daily"] = sql("""
    select sale_date, cast(gross_revenue as double) as gross_revenue,
           cast(net_revenue as double) as net_revenue, order_count, cancelled_order_count,
           refunded_order_count from m_daily
""")
ORACLES["int_payments_daily"] = sql("""
    select cast(payment_timestamp as date) as sale_date,
           count(*) filter (where is_failed) as payment_failure_count,
           count(*) as payment_attempt_count from f_payments group by 1
""")
ORACLES["int_customer_first_order"] = sql(
    "select customer_key, min(order_timestamp) as first_order_timestamp from f_orders group by 1"
)
ORACLES["int_customer_segment_orders"] = sql("""
    select order_key, customer_key, order_timestamp, order_status, is_completed, is_cancelled,
           is_refunded, cast(gross_revenue as double) as gross_revenue,
           cast(net_revenue as double) as net_revenue, customer_segment, country_code, country_name
    from f_orders join e_customers on customer_key=customer_id
""")
ORACLES["mart_parity"] = sql(
    "select distinct sale_date from m_daily where sale_date >= date '2001-01-01'"
)
ORACLES["mart_parity_all"] = " union all ".join(
    f"select '{name}' as check_name, cast(0 as bigint) as violations" for name in _MARTS
)

# --- quality ------------------------------------------------------------------------------------

ORACLES["dq_reasons_order_items"] = sql(f"""
    select order_item_id, product_id, quantity, cast(line_total as double) as line_total,
           {_ITEM_REASON} as rejection_reason from e_items
""")
ORACLES["dq_reasons_orders"] = sql("""
    select order_id, nullif(concat_ws('|',
        case when subtotal_amount < 0 then 'below_min_subtotal_amount' end,
        case when discount_amount < 0 then 'below_min_discount_amount' end,
        case when shipping_amount < 0 then 'below_min_shipping_amount' end,
        case when tax_amount < 0 then 'below_min_tax_amount' end,
        case when total_amount < 0 then 'below_min_total_amount' end), '') as rejection_reason
    from e_orders
""")
ORACLES["dq_reasons_customers"] = sql(
    "select customer_id, case when not is_active then 'null_email' end as rejection_reason "
    "from e_customers"
)
ORACLES["dq_reasons_payments"] = sql("""
    select payment_id, m as payment_method,
           case when m='wallet' then 'invalid_payment_method' end as rejection_reason
    from (select payment_id, case when payment_method='paypal' then 'wallet' else payment_method end
                 as m from e_payments)
""")
ORACLES["dq_reasons_product_updates"] = sql("""
    select update_id, new_value, 'duplicate_update_id' as rejection_reason from e_updates
    union all
    select update_id, new_value, 'duplicate_update_id' as rejection_reason from e_updates
""")
ORACLES["dq_null_keys"] = sql("""
    select case when not is_active then 'null_customer_id' ||
                case when (select count(*) from e_customers where not is_active) > 1
                     then '|duplicate_customer_id' else '' end end as rejection_reason,
           count(*) as row_count, min(email) as first_email
    from e_customers group by 1
""")
ORACLES["dq_invalid_events"] = sql("""
    select event_id, event_type, session_id, 'invalid_event_type' as rejection_reason
    from e_events where event_type not in
        ('page_view','product_view','add_to_cart','checkout_start','purchase','search')
""")
ORACLES["dq_missing_column"] = (
    "select p_partkey as product_id, 'missing_unit_cost' as rejection_reason from part"
)
ORACLES["dq_bounds_all"] = sql("""
    select product_id, cast(unit_price as double) as unit_price,
           cast(unit_cost as double) as unit_cost, nullif(concat_ws('|',
        case when unit_price < 1000 then 'below_min_unit_price' end,
        case when unit_price >= 1500 then 'above_max_exclusive_unit_price' end,
        case when unit_cost <= 620 then 'below_min_exclusive_unit_cost' end,
        case when unit_cost > 850 then 'above_max_unit_cost' end), '') as rejection_reason
    from e_products
""")
ORACLES["dq_scope_all_batches"] = """
    with n as (select count(*) as row_count from part)
    select 'a' as batch_id, cast(null as varchar) as rejection_reason, row_count, 'batch' as scope from n
    union all select 'b', null, row_count, 'batch' from n
    union all select 'a', 'duplicate_product_id', row_count, 'all' from n
    union all select 'b', 'duplicate_product_id', row_count, 'all' from n
"""
_KNOWN = "(select customer_id from e_customers where is_active)"
ORACLES["fk_orphans"] = sql(f"""
    select order_id, customer_id, case when subtotal_amount < 0 then 'below_min_subtotal_amount'
           else 'orphan_customer_id_references_customers.customer_id' end as rejection_reason
    from e_orders where subtotal_amount < 0 or customer_id not in {_KNOWN}
""")
ORACLES["fk_valid"] = sql(f"""
    select order_id, customer_id, cast(null as varchar) as rejection_reason
    from e_orders where subtotal_amount >= 0 and customer_id in {_KNOWN}
""")
ORACLES["fk_every_orphan"] = sql("""
    select order_item_id, product_id, cast(line_total as double) as line_total,
           nullif(concat_ws('|',
             case when order_id not in
                  (select order_id from e_orders where order_status='completed')
                  then 'orphan_order_id_references_orders.order_id' end,
             case when product_id not in (select product_id from e_products where is_active)
                  then 'orphan_product_id_references_products.product_id' end), '')
               as rejection_reason
    from e_items
""")
ORACLES["dedupe_latest"] = sql("""
    select order_item_id, l_shipdate, product_id, quantity, cast(line_total as double) as line_total
    from (select *, row_number() over (partition by order_item_id
              order by l_shipdate desc, product_id desc, quantity desc, line_total desc,
                       unit_price desc) as rn from e_items) where rn=1
""")
ORACLES["dedupe_latest_batch"] = sql("""
    select product_id, cast(unit_price + 1 as double) as unit_price, 'retail_second' as batch_id
    from e_products
""")

# --- writes -------------------------------------------------------------------------------------

ORACLES["upsert_snapshot"] = sql("""
    with u as (select p.*, p_size > 25 as big from e_products p join part on product_id=p_partkey),
    shown as (
      select product_id, sku, product_name, category, subcategory, brand,
             cast(case when big then unit_price+5 else unit_price end as double) as unit_price,
             cast(unit_cost as double) as unit_cost, is_active from u
      union all
      select product_id*1000000, sku||'-NEW', product_name, category, subcategory, brand,
             cast(unit_price+5 as double), cast(unit_cost as double), is_active from u where big)
    select * from shown
""".replace("with u as", "select * from (with u as") + ")")
ORACLES["upsert_by_month"] = sql("""
    select order_id, case when order_status='refunded' and month(order_date)=12
                          then order_date + interval 40 days else order_date end as order_date,
           case when order_status='refunded' then 'closed' else order_status end as order_status
    from e_orders
""")
ORACLES["upsert_by_directory"] = sql("""
    select order_id, customer_id,
           case when customer_id = 4 then order_date + interval 1 day
                when order_status='refunded' and month(order_date)=12
                then order_date + interval 40 days else order_date end as order_date,
           case when customer_id = 4 then 'held'
                when order_status='refunded' then 'closed' else order_status end as order_status
    from e_orders
""")
ORACLES["upsert_newest_only"] = sql("""
    select order_id, case when order_status='completed' then order_status else 'restored' end
               as order_status,
           case when order_status='completed' then updated_at else updated_at + interval 1 day end
               as updated_at
    from e_orders
""")
ORACLES["quarantine_append"] = sql("""
    select event_id, event_type, 'invalid_event_type' as rejection_reason,
           '2024-01-01' as ingestion_date, 'retail_first' as batch_id
    from e_events where event_type = 'error'
    union all
    select cast(order_id as varchar), order_status, 'below_min_subtotal_amount', '2024-01-02',
           'retail_second'
    from e_orders where subtotal_amount < 0
""")
ORACLES["landing_roundtrip"] = sql("""
    select order_id, order_status, cast(total_amount as double) as total_amount,
           'retail_second' as batch_id, 'retail_postgres' as source_system,
           'orders' as source_file, '2024-01-02T02:00:00+00:00' as ingested_at,
           '2024-01-02' as ingestion_date
    from e_orders
""")
ORACLES["csv_feed"] = sql("""
    select update_id, product_id, sku, update_type, effective_at, old_value, new_value,
           true as names_its_file, 'retail_first' as batch_id,
           'retail_product_feed' as source_system, '2024-01-01' as ingestion_date
    from e_updates
""")
ORACLES["csv_tables_by_name"] = sql("select * from e_customers")
ORACLES["json_feed_array_and_lines"] = sql("""
    select event_id, event_type, event_timestamp, customer_id, session_id, order_value,
           cast(null as varchar) as search_query
    from e_events
""")
ORACLES["events_as_json_lines"] = sql(
    "select event_id, event_type, order_value, order_value is not null as has_value from e_events"
)
ORACLES["standardised_products"] = sql(
    "select product_id, sku, brand, category, cast(null as varchar) as rejection_reason "
    "from e_products"
)
ORACLES["watermark_extract"] = sql("""
    select order_id, order_status, cast(total_amount as double) as total_amount, updated_at
    from e_orders where updated_at > timestamp '1998-06-01 00:00:00'
""")
ORACLES["order_amounts_from_lines"] = sql("""
    with s as (select l_orderkey,
                      sum(cast(cast(l_extendedprice as decimal(18,2))
                               *(1-cast(l_discount as decimal(5,2))) as decimal(14,2))) as net,
                      sum(cast(l_extendedprice as decimal(18,2))) as listed
               from lineitem group by 1),
    h as (select order_id, customer_id, shipping_amount, coalesce(net,0) as net,
                 coalesce(listed,0) as listed
          from e_orders left join s on order_id=l_orderkey)
    select order_id, customer_id, cast(shipping_amount as double) as shipping_amount,
           cast(net as double) as subtotal_amount,
           cast(greatest(listed-net,0) as double) as discount_amount,
           cast(cast(net*0.08 as decimal(18,2)) as double) as tax_amount,
           cast(net + shipping_amount + cast(net*0.08 as decimal(18,2)) as double) as total_amount
    from h
""".replace("with s as", "select * from (with s as") + ")")

# --- table tests --------------------------------------------------------------------------------


def _checks(rows: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as check_name, cast(({text}) as bigint) as violations"
        for name, text in rows.items()
    )


def _source_checks(customers: str, products: str, orders: str, email: str) -> str:
    return sql(_checks({
        "orphan_orders": f"select count(*) from {orders} o left join {customers} c "
                         "on o.customer_id=c.customer_id where c.customer_id is null",
        "orphan_order_items_orders": f"select count(*) from e_items i left join {orders} o "
                                     "on i.order_id=o.order_id where o.order_id is null",
        "orphan_order_items_products": f"select count(*) from e_items i left join {products} p "
                                       "on i.product_id=p.product_id where p.product_id is null",
        "orphan_payments": f"select count(*) from e_payments p left join {orders} o "
                           "on p.order_id=o.order_id where o.order_id is null",
        "negative_order_totals": f"select count(*) from {orders} o "
                                 "where total_amount<0 or subtotal_amount<0",
        "duplicate_customer_emails": f"select count(*) from (select {email} from {customers} c "
                                     f"group by {email} having count(*)>1)",
        "orders_without_items": f"select count(*) from {orders} o left join e_items i "
                                "on o.order_id=i.order_id where i.order_item_id is null",
    }))


ORACLES["source_checks"] = _source_checks("e_customers", "e_products", "e_orders", "email")
ORACLES["source_checks_with_faults"] = _source_checks(
    "(select * from e_customers where is_active)",
    "(select * from e_products where is_active)",
    "(select * from e_orders where order_status<>'failed')",
    "city",
)
ORACLES["table_counts"] = " union all ".join(
    f"select '{name}' as table_name, count(*) as row_count from {table}"
    for name, table in (("customers", "customer"), ("products", "part"), ("orders", "orders"),
                        ("order_items", "lineitem"), ("payments", "orders"))
)
_DUPLICATES = "select count(*) from (select {0} from {1} group by {0} having count(*)>1)"
ORACLES["test_unique"] = sql(_checks({
    "orders": _DUPLICATES.format("order_key", "f_orders"),
    "order_items": _DUPLICATES.format("order_item_key", "f_items"),
    "customers": _DUPLICATES.format("customer_id", "e_customers"),
    "customer_cities": _DUPLICATES.format("city", "e_customers"),
}))
ORACLES["test_not_null"] = sql(_checks({
    "orders": "select count(*) from f_orders where order_key is null",
    "event_order_value": "select count(*) from e_events where order_value is null",
    "customers": "select count(*) from e_customers where customer_id is null",
}))
ORACLES["test_relationships"] = sql(_checks({
    "orders": f"select count(*) from f_orders where customer_key not in {_KNOWN}",
    "null_child": f"select count(*) from f_orders where is_completed and customer_key not in {_KNOWN}",
    "items": "select count(*) from f_items where order_key not in "
             "(select order_key from f_orders where not is_completed)",
    "payments": "select count(*) from f_payments where order_key not in "
                "(select order_key from f_orders where not is_completed)",
}))
ORACLES["test_unique_combination"] = sql(_checks({
    "products": _DUPLICATES.format("product_id,category,subcategory", "m_products"),
    "segments": _DUPLICATES.format("customer_segment,country_code", "m_segments"),
    "lines": _DUPLICATES.format("l_orderkey,l_linenumber", "lineitem"),
}))


def _curated_tests() -> str:
    rows = {}
    keys = {"dim_date": "date_key", "dim_country": "country_key", "dim_customers": "customer_key",
            "dim_products": "product_key", "fct_orders": "order_key",
            "fct_order_items": "order_item_key", "fct_payments": "payment_key"}
    for table, key in keys.items():
        text = "select 0"
        if table == "fct_order_items":
            text = _DUPLICATES.format("order_item_key", "f_items")
        rows[f"unique_{table}_{key}"] = text
        rows[f"not_null_{table}_{key}"] = "select 0"
    for table, key in (("fct_orders", "customer_key"), ("fct_order_items", "order_key"),
                       ("fct_payments", "order_key")):
        rows[f"not_null_{table}_{key}"] = "select 0"
        rows[f"relationships_{table}_{key}"] = "select 0"
    rows["relationships_fct_orders_customer_key"] = (
        "select count(*) from e_orders where customer_id not in (select customer_id from e_customers)"
    )
    rows["relationships_fct_order_items_order_key"] = (
        "select count(*) from e_items where order_id not in (select order_id from e_orders)"
    )
    rows["unique_mart_daily_sales_sale_date"] = _DUPLICATES.format("sale_date", "m_daily")
    for column in ("sale_date", "gross_revenue", "net_revenue"):
        rows[f"not_null_mart_daily_sales_{column}"] = (
            f"select count(*) from m_daily where {column} is null"
        )
    rows["unique_mart_monthly_revenue_year_month"] = _DUPLICATES.format("year_month", "m_monthly")
    rows["not_null_mart_monthly_revenue_year_month"] = "select 0"
    rows["unique_mart_customer_lifetime_value_customer_key"] = (
        _DUPLICATES.format("customer_key", "m_clv")
    )
    rows["not_null_mart_customer_lifetime_value_customer_key"] = "select 0"
    rows["unique_mart_product_performance_product_id_category_subcategory"] = (
        _DUPLICATES.format("product_id,category,subcategory", "m_products")
    )
    rows["not_null_mart_product_performance_product_id"] = "select 0"
    rows["unique_mart_customer_segments_customer_segment_country_code"] = (
        _DUPLICATES.format("customer_segment,country_code", "m_segments")
    )
    rows["not_null_mart_customer_segments_customer_segment"] = "select 0"
    rows["not_null_mart_customer_segments_country_code"] = "select 0"
    return sql(_checks(rows))


ORACLES["curated_tests"] = _curated_tests()

_ACTIVE = "(select count(*) from customer where c_acctbal > 0)"
_ALL_CUSTOMERS = "(select count(*) from customer)"
_ALL_ORDERS = "(select count(*) from orders)"
ORACLES["layer_counts"] = f"""
    select 'source' as layer, 'customers' as entity, {_ALL_CUSTOMERS} as row_count, 'ok' as status
    union all select 'source', 'orders', {_ALL_ORDERS}, 'ok'
    union all select 'bronze', 'customers', {_ACTIVE}, 'ok'
    union all select 'bronze', 'orders', {_ALL_ORDERS}, 'ok'
    union all select 'bronze', 'payments', null, 'missing'
"""
ORACLES["layer_mismatch"] = f"""
    select 'customers' as entity,
           'customers: source=' || {_ALL_CUSTOMERS} || ' bronze=' || {_ACTIVE} as issue
    union all select 'products', 'products: bronze count unavailable'
    union all select 'products', 'products: missing '
"""
ORACLES["latest_manifest"] = f"""
    select 'retail_second' as batch_id, 'customers' as table_name, {_ALL_CUSTOMERS} as row_count,
           cast(0 as bigint) as rejected_count, {_ALL_CUSTOMERS} + {_ALL_ORDERS} as total_rows,
           cast(3 as bigint) as total_rejected_rows
    union all
    select 'retail_second', 'orders', {_ALL_ORDERS}, 3, {_ALL_CUSTOMERS} + {_ALL_ORDERS}, 3
"""


def _schema_check() -> str:
    counts = {
        "dim_date": f"select count(*) from ({DIM_DATE})",
        "dim_country": "select count(distinct country_code) from e_customers",
        "dim_customers": "select count(*) from customer",
        "dim_products": "select count(*) from part",
        "fct_orders": "select count(*) from orders",
        "fct_order_items": "select count(*) from lineitem",
        "fct_payments": "select count(*) from orders",
        "mart_daily_sales": "select count(*) from m_daily",
        "mart_monthly_revenue": "select count(*) from m_monthly",
        "mart_customer_lifetime_value": "select count(*) from m_clv",
        "mart_product_performance": "select count(*) from m_products",
        "mart_customer_segments": "select count(*) from m_segments",
    }
    return sql(" union all ".join(
        f"select '{name}' as table_name, "
        f"'{'order_timestamp' if name == 'fct_orders' else ''}' as missing_columns, "
        f"({text}) as row_count, {'false' if name == 'fct_orders' else 'true'} as passed"
        for name, text in counts.items()
    ))


ORACLES["schema_check"] = _schema_check()
ORACLES["silver_schema_check"] = f"""
    select 'customers' as table_name, '' as missing_columns, {_ALL_CUSTOMERS} as row_count,
           true as passed
    union all select 'orders', '', {_ALL_ORDERS}, true
    union all select 'products', 'sku,unit_cost', (select count(*) from part), false
"""
ORACLES["published_matches_curated"] = f"""
    select 'dim_products' as table_name, (select count(*) from part) as left_rows,
           2*(select count(*) from part) as right_rows, false as passed
    union all select 'fct_payments', {_ALL_ORDERS}, {_ALL_ORDERS}, true
"""
ORACLES["published_tables"] = sql("""
    select 'dim_country' as table_name, 2*count(distinct country_code) as row_count from e_customers
    union all select 'dim_customers', count(*) from customer
    union all select 'fct_payments', count(*) from orders
""")
ORACLES["published_customers"] = sql("""
    select customer_id as "CUSTOMER_KEY", customer_id as "CUSTOMER_ID", email as "EMAIL",
           first_name as "FIRST_NAME", last_name as "LAST_NAME", country_code as "COUNTRY_CODE",
           country_name as "COUNTRY_NAME", city as "CITY", customer_segment as "CUSTOMER_SEGMENT",
           signup_date as "SIGNUP_DATE", is_active as "IS_ACTIVE"
    from e_customers
""")

# --- whole jobs ---------------------------------------------------------------------------------
# Silver keeps orders with a non-negative subtotal and their payments. Payments follow the orders
# that are kept, since their foreign key points there.

ORACLES["daily_run_sales"] = sql(
    "select * from m_daily_out",
    f_orders="select * from (" + BASE["f_orders"] + ") where subtotal_amount >= 0",
    f_payments="select * from (" + BASE["f_payments"] + ") where order_key in "
               "(select order_id from e_orders where subtotal_amount >= 0)",
)
_KEPT = "(select * from e_orders where subtotal_amount >= 0)"
_KEPT_ITEMS = f"""(select * from
    (select *, count(*) over (partition by order_item_id) as copies from e_items)
    where copies = 1 and order_id in (select order_id from {_KEPT}))"""
_RUN_COUNTS = {
    ("bronze", "customers"): ("select count(*) from customer", "select 0"),
    ("bronze", "products"): ("select count(*) from part", "select 0"),
    ("bronze", "orders"): ("select count(*) from orders", "select 0"),
    ("bronze", "order_items"): ("select count(*) from lineitem", "select 0"),
    ("bronze", "payments"): ("select count(*) from orders", "select 0"),
    ("silver", "customers"): ("select count(*) from customer", "select 0"),
    ("silver", "products"): ("select count(*) from part", "select 0"),
    ("silver", "orders"): (
        f"select count(*) from {_KEPT}",
        "select count(*) from e_orders where subtotal_amount < 0",
    ),
    ("silver", "order_items"): (
        f"select count(*) from {_KEPT_ITEMS}",
        f"select (select count(*) from lineitem) - (select count(*) from {_KEPT_ITEMS})",
    ),
    ("silver", "payments"): (
        f"select count(*) from {_KEPT}",
        "select count(*) from e_orders where subtotal_amount < 0",
    ),
    ("gold", "dim_country"): ("select count(distinct country_code) from e_customers", "select 0"),
    ("gold", "dim_customers"): ("select count(*) from customer", "select 0"),
    ("gold", "dim_products"): ("select count(*) from part", "select 0"),
    ("gold", "fct_orders"): (f"select count(*) from {_KEPT}", "select 0"),
    ("gold", "fct_order_items"): (f"select count(*) from {_KEPT_ITEMS}", "select 0"),
    ("gold", "fct_payments"): (f"select count(*) from {_KEPT}", "select 0"),
    ("gold", "mart_daily_sales"): (
        f"select count(distinct cast(order_date as date)) from {_KEPT}", "select 0"),
    ("gold", "mart_monthly_revenue"): (
        f"select count(distinct strftime(order_date,'%Y-%m')) from {_KEPT}", "select 0"),
    ("gold", "mart_customer_lifetime_value"): (
        f"select count(distinct customer_id) from {_KEPT}", "select 0"),
    ("gold", "mart_product_performance"): (
        f"select count(distinct product_id) from {_KEPT_ITEMS}", "select 0"),
    ("gold", "mart_customer_segments"): (
        "select count(*) from (select distinct customer_segment, country_code, country_name "
        f"from e_customers where customer_id in (select customer_id from {_KEPT}))", "select 0"),
}
ORACLES["daily_run_counts"] = sql(" union all ".join(
    f"select '{layer}' as layer, '{table}' as table_name, cast(({rows}) as bigint) as row_count, "
    f"cast(({rejected}) as bigint) as rejected_count"
    for (layer, table), (rows, rejected) in _RUN_COUNTS.items()
))
_LATE = "order_date >= date '1995-03-01' and order_date < date '1995-05-01'"
_CHANGED = f"""(
    select order_id, total_amount,
        case when {_LATE} and order_id % 3 = 0 then 1 else customer_id end as customer_id,
        case when {_LATE} and day(order_date) = 15 then order_date + interval 20 days
             else order_date end as order_date,
        case when {_LATE} and order_id % 2 = 0 then 'refunded' else order_status end as order_status
    from {_KEPT} k)"""
ORACLES["incremental_marts"] = sql(f"""
    select m.mart, m.item, cast(m.gross as double) as gross_revenue,
           cast(m.net as double) as net_revenue, cast(m.n as bigint) as order_count,
           cast(m.more as bigint) as measure
    from (
        with o as (
            select *, case when order_status in ('completed', 'refunded') then total_amount else 0 end
                       as gross,
                   case when order_status = 'completed' then total_amount else 0 end as net,
                   strftime(order_date, '%Y-%m') as month
            from {_CHANGED} c
        ),
        debut as (select customer_id, min(month) as month from o group by 1),
        fails as (
            select cast(p.payment_date as date) as d, count(*) filter (
                where p.payment_status = 'failed'
                   or (p.payment_date < date '1995-06-01' and p.payment_id % 11 = 0)) as n
            from e_payments p where p.order_id in (select order_id from {_KEPT} k) group by 1
        ),
        own as (
            select customer_id, count(*) as n, sum(gross) as gross, sum(net) as net from o group by 1
        )
        select 'mart_daily_sales' as mart, cast(cast(order_date as date) as varchar) as item,
               sum(gross) as gross, sum(net) as net, count(*) as n,
               coalesce(max(fails.n), 0) as more
        from o left join fails on fails.d = cast(order_date as date) group by 2
        union all
        select 'mart_monthly_revenue', month, sum(gross), sum(net), count(*),
               (select count(*) from debut where debut.month = o.month) from o group by month
        union all
        select 'mart_customer_lifetime_value', cast(customer_id as varchar), gross, net, n,
               case when n > 1 then 1 else 0 end from own
        union all
        select 'mart_product_performance', cast(product_id as varchar), sum(line_total),
               sum(case when order_status = 'completed' then line_total else 0 end),
               count(distinct i.order_id), sum(quantity)
        from {_KEPT_ITEMS} i join o on o.order_id = i.order_id group by product_id
        union all
        select 'mart_customer_segments', customer_segment || '/' || country_code, sum(gross),
               sum(net), sum(n), count(*) filter (where n > 1)
        from own join e_customers using (customer_id) group by customer_segment, country_code
    ) m
""")
ORACLES["daily_run_issues"] = f"""
    select 'customers' as entity,
           'customers: source=' || {_ALL_CUSTOMERS} || ' bronze=' || {_ACTIVE} as issue
    union all select 'gold', 'gold: missing no manifest'
"""
ORACLES["daily_run_quarantine"] = sql(f"""
    select order_id, customer_id, case when subtotal_amount < 0 then 'below_min_subtotal_amount'
           else 'orphan_customer_id_references_customers.customer_id' end as rejection_reason,
           'retail_first' as batch_id, '2024-01-01' as ingestion_date
    from e_orders where subtotal_amount < 0 or customer_id not in {_KNOWN}
""")
ORACLES["landed_matches_source"] = f"""
    select 'customers' as table_name, {_ALL_CUSTOMERS} as left_rows, {_ACTIVE} as right_rows,
           {_ALL_CUSTOMERS} = {_ACTIVE} as same_rows, '' as missing_columns
    union all select 'orders', {_ALL_ORDERS}, {_ALL_ORDERS}, true, 'source_file'
"""
_OUTCOME = """case when subtotal_amount < 0 then 'below_min_subtotal_amount' else 'accepted' end"""
ORACLES["backlog_run"] = sql(f"""
    select order_id, case when order_id % 2 = 1 then 'retail_second' else 'retail_first' end
               as batch_id, {_OUTCOME} as outcome
    from e_orders
""")
_OWNED = f"(select * from e_orders where subtotal_amount >= 0 and customer_id in {_KNOWN})"
_OWNED_ITEMS = f"""(select * from
    (select *, count(*) over (partition by order_item_id) as copies from e_items)
    where copies = 1 and order_id in (select order_id from {_OWNED} k))"""
ORACLES["partial_silver"] = sql(f"""
    select 'customers' as entity, {_ACTIVE} as accepted_rows, cast(0 as bigint) as rejected_rows
    union all select 'products', (select count(*) from part), 0
    union all select 'orders', (select count(*) from {_OWNED} k),
        {_ALL_ORDERS} - (select count(*) from {_OWNED} k)
    union all select 'order_items', (select count(*) from {_OWNED_ITEMS} k),
        (select count(*) from lineitem) - (select count(*) from {_OWNED_ITEMS} k)
    union all select 'payments', (select count(*) from {_OWNED} k),
        {_ALL_ORDERS} - (select count(*) from {_OWNED} k)
""")
ORACLES["replayed_batch"] = sql("""
    select order_id, case when order_id % 3 = 0 then 'retail_second' else 'retail_first' end
               as batch_id,
           cast(total_amount + case when order_id % 3 = 0 then 1 else 0 end as double)
               as total_amount
    from e_orders where subtotal_amount >= 0
""")
ORACLES["late_parent"] = sql(
    f"select order_id, 'retail_first' as batch_id, {_OUTCOME} as outcome from e_orders"
)
ORACLES["quarantine_rerun"] = sql(
    f"select order_id, '007' as batch_id, {_OUTCOME} as outcome from e_orders"
)
ORACLES["upsert_new_column"] = sql("""
    select order_id, order_status,
           case when order_status = 'refunded' and month(order_date) = 5
                then 'refund of ' || order_id end as note
    from e_orders
""")
ORACLES["csv_line_breaks"] = sql("""
    select update_id, sku, old_value, new_value || chr(10) || 'per piece, "net"' as new_value
    from e_updates
""")
ORACLES["json_corrupt_records"] = sql("""
    select case when event_type <> 'checkout_start' then event_id end as event_id,
           cast(case when event_type = 'checkout_start' then 40 end as bigint) as kept_text,
           case event_type when 'checkout_start' then 'corrupt_record'
                           when 'error' then 'invalid_event_type' end as first_reason
    from e_events
""")
_EVENT_REASON = f"""case when event_type = 'error' then 'invalid_event_type'
    when customer_id not in {_KNOWN} then 'orphan_customer_id_references_customers.customer_id' end"""
ORACLES["feeds_through_jobs"] = sql(f"""
    select 'website_events' as entity, event_id as id,
           coalesce({_EVENT_REASON}, 'accepted') as outcome
    from e_events
    union all select 'product_updates', cast(update_id as varchar), 'accepted' from e_updates
""")
ORACLES["event_stream_orphans"] = sql(
    f"select event_id, event_type, {_EVENT_REASON} as rejection_reason from e_events"
)
ORACLES["layer_counts_unreadable"] = f"""
    select 'source' as layer, 'customers' as entity, cast(null as bigint) as row_count,
           'error' as status
    union all select 'source', 'orders', {_ALL_ORDERS}, 'ok'
    union all select 'source', 'products', 0, 'empty'
    union all select 'silver', 'customers', {_ALL_CUSTOMERS}, 'ok'
    union all select 'silver', 'orders', 0, 'empty'
"""
ORACLES["silver_gold_issues"] = sql(f"""
    select 'dim_customers' as entity, 'dim_customers: silver state=' || {_ALL_CUSTOMERS}
           || ' gold=' || {_ACTIVE} as issue
    union all
    select 'fct_orders', 'fct_orders: silver state=' || (select count(*) from {_KEPT}) || ' gold='
           || (select count(*) from {_KEPT} where customer_id in {_KNOWN})
""")
_GOLD_PLACES = ("dim_date", "dim_country", "dim_customers", "dim_products", "fct_orders",
                "fct_order_items", "fct_payments", "mart_daily_sales", "mart_monthly_revenue",
                "mart_customer_lifetime_value", "mart_product_performance",
                "mart_customer_segments")
ORACLES["published_run"] = sql(" union all ".join(
    f"select '{table}' as table_name, cast(({rows}) as bigint) as row_count, "
    f"{_GOLD_PLACES.index(table)} as place"
    for (layer, table), (rows, _) in _RUN_COUNTS.items() if layer == "gold"
))
# A run's curated tables hold no fault: every declared test finds nothing.
ORACLES["sql_models_of_run"] = f"select check_name, cast(0 as bigint) as violations from ({ORACLES['curated_tests']})"
ORACLES["report_of_run"] = f"""
    with counts as (
        select 'source' as layer, 'customers' as entity, {_ACTIVE} as row_count
        union all select 'source', 'products', (select count(*) from part)
        union all select 'bronze', 'customers', {_ALL_CUSTOMERS}
        union all select 'bronze', 'products', (select count(*) from part)
        union all select 'silver', 'customers', {_ALL_CUSTOMERS}
        union all select 'silver', 'products', (select count(*) from part)
    )
    select false as passed, 2 as n_issues, * from counts
"""
ORACLES["missing_curated"] = f"""
    select 'dim_customers' as table_name, {_ALL_CUSTOMERS} as row_count, cast(9 as bigint) as missing
    union all select 'dim_products', (select count(*) from part), 9
    union all select 'fct_orders', {_ALL_ORDERS}, 9
"""
ORACLES["order_amounts_by_quantity"] = sql("""
    select * from (with lines as (
        select l_orderkey, cast(l_quantity as int) as quantity,
               cast(cast(l_tax as decimal(5,2)) + 12.34 as decimal(18,2)) as price,
               1 - cast(l_discount as decimal(5,2)) as kept
        from lineitem
    ), s as (
        select l_orderkey, sum(price * quantity) as listed,
               sum(cast(price * quantity * kept as decimal(14,2))) as net
        from lines group by 1
    ), h as (
        select order_id, customer_id, shipping_amount, coalesce(net, 0) as net,
               coalesce(listed, 0) as listed
        from e_orders left join s on order_id = l_orderkey
    )
    select order_id, customer_id, cast(shipping_amount as double) as shipping_amount,
           cast(net as double) as subtotal_amount,
           cast(greatest(listed - net, 0) as double) as discount_amount,
           cast(cast(net * 0.08 as decimal(18,2)) as double) as tax_amount,
           cast(net + shipping_amount + cast(net * 0.08 as decimal(18,2)) as double)
               as total_amount
    from h)
""")
ORACLES["event_stream_correction"] = sql("""
    select event_id, event_type,
           case when event_type = 'error' then 'invalid_event_type' end as rejection_reason
    from e_events
    union all
    select event_id, 'unheard_of', 'invalid_event_type' from e_events where event_type <> 'error'
""")
ORACLES["event_stream_retimed"] = sql("""
    select event_id, event_type,
           case when event_type = 'purchase' then '2031' || substr(event_timestamp, 5)
                else event_timestamp end as event_timestamp,
           case when event_type = 'error' then 'invalid_event_type' end as rejection_reason
    from e_events
""")
ORACLES["event_stream_repeats"] = sql("""
    select event_id, event_type,
           case when event_type = 'purchase' then '2031' || substr(event_timestamp, 5)
                else event_timestamp end as event_timestamp,
           case when event_type = 'error' then 'invalid_event_type' end as rejection_reason,
           event_type = 'purchase' as stored_again
    from e_events
""")
ORACLES["event_stream_dedupe"] = sql("""
    select event_id, event_type,
           case when event_type='error' then 'invalid_event_type' end as rejection_reason
    from e_events
""")

# --- rows that differ, active customers, late commits, publishing in one step -------------------

ORACLES["differing_rows"] = sql("""
    select order_id as order_key, case when order_id % 101 = 0 then 'left_only' else 'changed' end
               as difference
    from e_orders where order_id % 101 = 0 or order_id % 97 = 0
    union all select -order_id - 1, 'right_only' from e_orders where order_id % 101 = 0
""")
ORACLES["active_customers_by_window"] = sql("""
    select cast(d.day as date) as activity_date, c.customer_segment,
           cast(w.n as integer) as window_days, count(distinct o.customer_id) as active_customers
    from (select unnest(generate_series(min(order_date)::date, max(order_date)::date,
                                        interval 1 day)) as day from e_orders) d
    cross join (values (7), (30), (90)) w(n)
    join e_orders o on cast(o.order_date as date) <= d.day
        and cast(o.order_date as date) > d.day - to_days(w.n)
    join e_customers c using (customer_id)
    group by 1, 2, 3
""")
ORACLES["late_commits"] = sql("""
    select order_id, case when order_id % 20 <> 0 then 'retail_first' else 'retail_second' end
               as batch_id
    from e_orders where order_id % 20 <> 0 or updated_at >
        (select max(updated_at) - interval 60 days from e_orders where order_id % 20 <> 0)
""")
ORACLES["duplicates_across_batches"] = sql("""
    select order_id, 'retail_second' as batch_id, 'retail_first' as other_batch
    from e_orders where order_id % 10 = 0
    union all
    select order_id, 'retail_first', 'retail_second' from e_orders where order_id % 20 = 0
    union all
    select order_id, 'retail_third', 'retail_first' from e_orders where order_id % 12 = 0
    union all
    select order_id, 'retail_third', 'retail_second'
    from e_orders where order_id % 3 = 0 and (order_id % 2 = 1 or order_id % 10 = 0)
""")
ORACLES["interrupted_publish"] = " union all ".join(
    f"select '{name}' as table_name, true as stopped, cast(0 as bigint) as differing_rows"
    for name in (
        "dim_date", "dim_country", "dim_customers", "dim_products", "fct_orders",
        "fct_order_items", "fct_payments", "mart_daily_sales", "mart_monthly_revenue",
        "mart_customer_lifetime_value", "mart_product_performance", "mart_customer_segments",
    )
)
