"""SQL texts of the inputs: raw extracts, silver entities, gold tables.

They state the same data as the DataFrame code in another dialect and by other means (window
ranking instead of aggregation, lag/lead history instead of merging), so that agreement of the two
is evidence. Each text is a common table expression; a query gets those it mentions.
"""

from __future__ import annotations

import re

STATES = (
    "['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA',"
    "'PB','PE','PI','PR','RJ','RN','RO','RR','RS','SC','SE','SP','TO']"
)


def clean_text(c: str) -> str:
    return rf"nullif(lower(trim(regexp_replace({c}, '\s+', ' ', 'g'))), '')"


def clean_code(c: str) -> str:
    return f"nullif(upper(trim({c})), '')"


def as_ts(c: str) -> str:
    return f"try_strptime({c}, '%Y-%m-%d %H:%M:%S')"


def as_int(c: str) -> str:
    return f"cast(trunc(try_cast({c} as decimal(20,4))) as int)"


def as_money(c: str) -> str:
    return f"try_cast({c} as decimal(12,2))"


def blank_null(c: str) -> str:
    return f"case when trim({c}) <> '' then {c} end"


def date_sk(c: str) -> str:
    return f"coalesce(cast(strftime({c}, '%Y%m%d') as int), -1)"


def exact_avg(c: str) -> str:
    return f"cast(sum({c}) as double) / count({c})"


INPUTS = {
    "raw_orders": """
        select cast(o_orderkey as varchar) as order_id,
               o_custkey || '-' || o_orderkey as customer_id,
               case when o_orderkey % 89 = 0 then '  ' when o_orderstatus = 'F' then ' delivered'
                    when o_orderstatus = 'O' then 'Shipped ' else 'canceled' end as order_status,
               case when o_orderkey % 401 = 0 then '' else cast(bought as varchar) end as order_purchase_timestamp,
               case when o_orderkey % 17 = 0 then 'n/a'
                    else cast(bought + to_hours(o_orderkey % 5) as varchar) end as order_approved_at,
               case when o_orderstatus in ('F', 'O') then cast(bought + to_days(cast(1 + o_orderkey % 3 as int)) as varchar)
                    else '' end as order_delivered_carrier_date,
               case when o_orderstatus = 'F' and o_orderkey % 71 <> 0
                    then cast(bought + to_days(cast(o_orderkey % 30 as int)) + to_hours(o_orderkey % 24) as varchar)
                    else '' end as order_delivered_customer_date,
               cast(cast(cast(bought as date) as timestamp) + to_days(cast(10 + o_custkey % 15 as int)) as varchar)
                    as order_estimated_delivery_date
        from (select *, o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) as bought from orders)
    """,
    "raw_customers": f"""
        select case when o_custkey % 97 = 0 then 'lost-' else '' end || o_custkey || '-' || o_orderkey as customer_id,
               cast(o_custkey as varchar) as customer_unique_id,
               lpad(cast(c_nationkey as varchar), 5, '0') as customer_zip_code_prefix,
               case when o_custkey % 13 = 0 then '   ' else '  ' || c_mktsegment || '  ' || chr(9) || (o_orderkey % 5) end
                    as customer_city,
               lower({STATES}[c_nationkey + 1]) || ' ' as customer_state
        from orders join customer on o_custkey = c_custkey
    """,
    "raw_items": """
        select cast(l_orderkey as varchar) as order_id, ' ' || l_linenumber as order_item_id,
               case when l_orderkey % 151 = 0 then 'x' else '' end || min(l_partkey) as product_id,
               cast(min(l_suppkey) as varchar) as seller_id,
               cast(max(l_shipdate) as varchar) as shipping_limit_date,
               cast(sum(cast(l_extendedprice as decimal(12,2))) as varchar) as price,
               case when l_orderkey % 211 = 0 then 's/d' else cast(sum(cast(l_quantity as decimal(12,2))) as varchar) end
                    as freight_value
        from lineitem group by l_orderkey, l_linenumber
    """,
    "raw_payments": """
        select cast(o_orderkey as varchar) as order_id, cast(n as varchar) as payment_sequential,
               ['Credit_Card', ' boleto', 'VOUCHER  ', 'debit  card'][1 + o_orderkey % 4] as payment_type,
               case when o_orderkey % 23 = 0 then '' else cast(1 + o_orderkey % 12 as varchar) end as payment_installments,
               cast(cast(o_totalprice as decimal(12,2)) as varchar) as payment_value
        from (select *, unnest(range(1, 2 + o_orderkey % 3)) as n from orders)
    """,
    "raw_reviews": """
        select 'r' || (doc_id // 2) as review_id, cast(doc_id * 7 as varchar) as order_id,
               cast(1 + doc_id * 7 % 5 as varchar) as review_score,
               case when doc_id % 3 = 0 then '   ' else lang end as review_comment_title,
               text as review_comment_message,
               cast(created as varchar) as review_creation_date,
               case when doc_id % 37 = 0 then ''
                    else cast(created + to_hours(n_chars % 100) + to_minutes(doc_id % 60) as varchar) end
                    as review_answer_timestamp
        from (select *, timestamp '1995-06-01' + to_days(cast(doc_id % 2000 as int)) as created,
                     unnest(range(case when doc_id % 50 = 0 then 2 else 1 end)) as copy
              from documents)
    """,
    "raw_products": """
        select cast(p_partkey as varchar) as product_id,
               case when p_partkey % 50 = 0 then ' ' else ' ' || p_type end as product_category_name,
               cast(length(p_name) as varchar) as product_name_lenght,
               cast(length(p_brand) as varchar) as product_description_lenght,
               case when p_partkey % 19 = 0 then '' else cast(p_size % 5 as varchar) end as product_photos_qty,
               case when p_partkey % 41 = 0 then '?' when p_partkey % 3 = 0 then (p_size * 100) || '.0'
                    else cast(p_size * 100 as varchar) end as product_weight_g,
               cast(p_size as varchar) as product_length_cm,
               cast(p_size + 1 as varchar) as product_height_cm,
               cast(p_size + 2 as varchar) as product_width_cm
        from part
    """,
    "raw_categories": """
        select distinct p_type as product_category_name,
               'EN  ' || p_type || ' ' || (p_size % 2) as product_category_name_english
        from part where p_type <> 'SMALL'
    """,
    "raw_sellers": f"""
        select cast(s_suppkey as varchar) as seller_id, lpad(cast(s_nationkey as varchar), 5, '0') as seller_zip_code_prefix,
               n_name || '   city ' as seller_city, lower({STATES}[s_nationkey + 1]) as seller_state
        from supplier join nation on s_nationkey = n_nationkey
    """,
    "raw_geo": f"""
        select lpad(cast(c_nationkey as varchar), 5, '0') as geolocation_zip_code_prefix,
               case when c_custkey % 31 = 0 then '' else cast(cast(c_acctbal as decimal(12,2)) as varchar) end
                    as geolocation_lat,
               cast(cast(-c_acctbal as decimal(12,2)) as varchar) as geolocation_lng,
               case when c_custkey % 11 = 0 then ' ' else ' ' || c_mktsegment end as geolocation_city,
               {STATES}[c_nationkey + 1] as geolocation_state
        from customer
    """,
    "clicks": """
        select event_id, user_id, ts,
               case event_type when 'view' then 'view' when 'click' then 'cart' when 'signup' then 'checkout'
                    when 'purchase' then 'payment' end as step,
               value, props
        from events
    """,
    "s_customers": f"""
        select customer_unique_id, customer_zip_code_prefix, {clean_text("customer_city")} as customer_city,
               {clean_code("customer_state")} as customer_state
        from raw_customers left join
             (select customer_id, {as_ts("order_purchase_timestamp")} as purchased_at from raw_orders) using (customer_id)
        qualify row_number() over (partition by customer_unique_id
                                   order by purchased_at desc nulls last, customer_id desc) = 1
    """,
    "s_sellers": f"""
        select seller_id, seller_zip_code_prefix, {clean_text("seller_city")} as seller_city,
               {clean_code("seller_state")} as seller_state
        from raw_sellers
    """,
    "s_categories": f"""
        select {clean_text("product_category_name")} as product_category_name,
               min({clean_text("product_category_name_english")}) as product_category_name_english
        from raw_categories group by 1
    """,
    "s_products": f"""
        select product_id, product_category_name, product_category_name_english, product_name_length,
               product_description_length, product_photos_qty, product_weight_g, product_length_cm,
               product_height_cm, product_width_cm
        from (select product_id, {clean_text("product_category_name")} as product_category_name,
                     {as_int("product_name_lenght")} as product_name_length,
                     {as_int("product_description_lenght")} as product_description_length,
                     {as_int("product_photos_qty")} as product_photos_qty,
                     {as_int("product_weight_g")} as product_weight_g,
                     {as_int("product_length_cm")} as product_length_cm,
                     {as_int("product_height_cm")} as product_height_cm,
                     {as_int("product_width_cm")} as product_width_cm
              from raw_products) left join s_categories using (product_category_name)
    """,
    "geo_points": f"""
        select geolocation_zip_code_prefix as zip_code_prefix, try_cast(geolocation_lat as double) as lat,
               try_cast(geolocation_lng as double) as lng, {clean_text("geolocation_city")} as city,
               {clean_code("geolocation_state")} as state
        from raw_geo
    """,
    "geo_mode": """
        select zip_code_prefix, city, state
        from (select zip_code_prefix, city, state, count(*) as n from geo_points group by all)
        qualify row_number() over (partition by zip_code_prefix
                                   order by n desc, city nulls first, state nulls first) = 1
    """,
    "s_geolocation": """
        select zip_code_prefix, latitude, longitude, city, state
        from (select zip_code_prefix, quantile_disc(lat, 0.5) as latitude, quantile_disc(lng, 0.5) as longitude
              from geo_points group by 1) left join geo_mode using (zip_code_prefix)
    """,
    "s_orders": f"""
        select order_id, customer_id, customer_unique_id, {clean_code("order_status")} as order_status,
               {as_ts("order_purchase_timestamp")} as order_purchase_timestamp,
               {as_ts("order_approved_at")} as order_approved_at,
               {as_ts("order_delivered_carrier_date")} as order_delivered_carrier_date,
               {as_ts("order_delivered_customer_date")} as order_delivered_customer_date,
               {as_ts("order_estimated_delivery_date")} as order_estimated_delivery_date
        from raw_orders left join
             (select customer_id, min(customer_unique_id) as customer_unique_id from raw_customers group by 1)
             using (customer_id)
    """,
    "s_items": f"""
        select order_id, {as_int("order_item_id")} as order_item_id, product_id, seller_id,
               {as_ts("shipping_limit_date")} as shipping_limit_date, {as_money("price")} as price,
               {as_money("freight_value")} as freight_value
        from raw_items
    """,
    "s_payments": f"""
        select order_id, {as_int("payment_sequential")} as payment_sequential, {clean_text("payment_type")} as payment_type,
               {as_int("payment_installments")} as payment_installments, {as_money("payment_value")} as payment_value
        from raw_payments
    """,
    "s_reviews": f"""
        select distinct review_id, order_id, {as_int("review_score")} as review_score,
               {blank_null("review_comment_title")} as review_comment_title,
               {blank_null("review_comment_message")} as review_comment_message,
               {as_ts("review_creation_date")} as review_creation_date,
               {as_ts("review_answer_timestamp")} as review_answer_timestamp
        from raw_reviews
    """,
    "d_date": """
        select cast(d as date) as full_date, cast(strftime(d, '%Y%m%d') as int) as date_sk,
               cast(year(d) as int) as year, cast(quarter(d) as int) as quarter, cast(month(d) as int) as month,
               strftime(d, '%B') as month_name, cast(weekofyear(d) as int) as week_of_year,
               cast(day(d) as int) as day_of_month, cast(dayofweek(d) + 1 as int) as day_of_week,
               strftime(d, '%A') as day_name, dayofweek(d) in (0, 6) as is_weekend, strftime(d, '%Y-%m') as year_month,
               year(d) || '-Q' || quarter(d) as year_quarter
        from generate_series(timestamp '1995-01-01', timestamp '2002-12-31', interval 1 day) as days(d)
        union all by name
        select cast(null as date) as full_date, -1 as date_sk, 'Unknown' as month_name, 'Unknown' as day_name,
               'Unknown' as year_month, 'Unknown' as year_quarter
    """,
    "first_purchases": """
        select customer_unique_id, min(order_purchase_timestamp) as first_purchase_date,
               strftime(min(order_purchase_timestamp), '%Y-%m') as cohort_year_month
        from s_orders group by 1
    """,
    "d_customer": """
        select customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, first_purchase_date,
               cohort_year_month, sha256(customer_unique_id) as customer_sk
        from s_customers left join first_purchases using (customer_unique_id)
        union all
        select 'Unknown', 'Unknown', 'Unknown', 'Unknown', null, 'Unknown', '-1'
    """,
    "d_product": """
        select *, cast(product_length_cm as bigint) * product_height_cm * product_width_cm as product_volume_cm3,
               case when product_weight_g < 500 then 'ligero' when product_weight_g <= 2000 then 'medio'
                    when product_weight_g > 2000 then 'pesado' end as weight_bucket,
               sha256(product_id) as product_sk
        from s_products
        union all by name
        select 'Unknown' as product_id, 'Unknown' as product_category_name, 'Unknown' as product_category_name_english,
               'Unknown' as weight_bucket, '-1' as product_sk
    """,
    "d_geography": """
        select sha256(zip_code_prefix) as geography_sk, zip_code_prefix, city, state,
               case when state in ('AC','AP','AM','PA','RO','RR','TO') then 'Norte'
                    when state in ('AL','BA','CE','MA','PB','PE','PI','RN','SE') then 'Nordeste'
                    when state in ('DF','GO','MT','MS') then 'Centro-Oeste'
                    when state in ('ES','MG','RJ','SP') then 'Sudeste'
                    when state in ('PR','RS','SC') then 'Sul' end as region,
               latitude, longitude
        from s_geolocation
        union all
        select '-1', 'Unknown', 'Unknown', 'Unknown', 'Unknown', null, null
    """,
    "snapshot_dates": """
        select unnest([date '1997-01-01', date '1998-01-01', date '1999-01-01', date '2000-01-01', date '2001-01-01'])
               as as_of
    """,
    "seller_snapshots": """
        select as_of, seller_id, seller_zip_code_prefix, seller_city, seller_state,
               case when seller_id = '-1' then 'Unknown' when gmv_window > 5200000 then 'Gold'
                    when gmv_window >= 4500000 then 'Silver' else 'Bronze' end as seller_segment, gmv_window
        from (select as_of, s.*, coalesce(gmv, 0) as gmv_window
              from (select * from s_sellers
                    union all select '-1', 'Unknown', 'Unknown', 'Unknown') s
              cross join snapshot_dates
              left join (select as_of, seller_id, sum(price) as gmv
                         from s_items join s_orders using (order_id)
                         join snapshot_dates on order_purchase_timestamp between as_of - 365 and as_of
                         group by all) using (as_of, seller_id))
    """,
    "d_seller": """
        select case when seller_id = '-1' then '-1' else sha256(seller_id || '|' || valid_from) end as seller_sk,
               seller_id, seller_zip_code_prefix, seller_city, seller_state, seller_segment, gmv_window,
               valid_from, valid_to, valid_to = date '9999-12-31' as is_current
        from (select *, case when as_of = date '1997-01-01' then date '1900-01-01' else as_of end as valid_from,
                     coalesce(lead(as_of) over (partition by seller_id order by as_of) - 1, date '9999-12-31') as valid_to
              from (select * from seller_snapshots
                    window w as (partition by seller_id order by as_of)
                    qualify row_number() over w = 1
                         or seller_zip_code_prefix is distinct from lag(seller_zip_code_prefix) over w
                         or seller_city is distinct from lag(seller_city) over w
                         or seller_state is distinct from lag(seller_state) over w
                         or seller_segment is distinct from lag(seller_segment) over w))
    """,
    "order_keys": f"""
        select o.order_id, o.order_purchase_timestamp, {date_sk("o.order_purchase_timestamp")} as purchase_date_sk,
               coalesce(c.customer_sk, '-1') as customer_sk, coalesce(g.geography_sk, '-1') as geography_sk
        from s_orders o left join d_customer c using (customer_unique_id)
             left join d_geography g on g.zip_code_prefix = c.customer_zip_code_prefix
    """,
    "f_orders": f"""
        select k.purchase_date_sk, {date_sk("o.order_delivered_customer_date")} as delivered_date_sk,
               {date_sk("o.order_estimated_delivery_date")} as estimated_date_sk, k.customer_sk, k.geography_sk,
               o.order_id, o.order_status,
               cast(date_diff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) as int)
                    as days_to_delivery,
               cast(date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date) as int) as days_late,
               cast(o.order_status = 'DELIVERED' as int) as is_delivered,
               coalesce(cast(o.order_delivered_customer_date > o.order_estimated_delivery_date as int), 0) as is_late,
               coalesce(n, 0) as order_item_count, coalesce(total, 0) as order_value, 1 as order_count
        from s_orders o join order_keys k using (order_id)
             left join (select order_id, count(*) as n, sum(price + freight_value) as total from s_items group by 1)
             using (order_id)
    """,
    "f_items": """
        select coalesce(k.purchase_date_sk, -1) as date_sk, coalesce(k.customer_sk, '-1') as customer_sk,
               coalesce(v.seller_sk, '-1') as seller_sk, coalesce(p.product_sk, '-1') as product_sk,
               coalesce(k.geography_sk, '-1') as geography_sk, i.order_id, i.order_item_id, i.price, i.freight_value,
               i.price + i.freight_value as gross_revenue, 1 as item_count
        from s_items i left join order_keys k using (order_id) left join d_product p using (product_id)
             left join d_seller v on v.seller_id = i.seller_id
                  and cast(k.order_purchase_timestamp as date) between v.valid_from and v.valid_to
    """,
    "f_payments": """
        select coalesce(k.purchase_date_sk, -1) as date_sk, coalesce(k.customer_sk, '-1') as customer_sk, order_id,
               payment_sequential, payment_type, payment_value, payment_installments, 1 as payment_count
        from s_payments left join order_keys k using (order_id)
    """,
    "f_reviews": f"""
        select {date_sk("review_creation_date")} as date_sk, coalesce(k.customer_sk, '-1') as customer_sk, review_id,
               order_id, review_score, cast(review_score <= 2 as int) as is_negative,
               cast(review_score >= 4 as int) as is_positive,
               cast((epoch(review_answer_timestamp) - epoch(review_creation_date)) / 3600 as decimal(10,2))
                    as response_time_hours, 1 as review_count
        from s_reviews left join order_keys k using (order_id)
    """,
    "activity": """
        select cohort_year_month, customer_sk, order_value,
               cast((year(full_date) - year(first_purchase_date)) * 12 + month(full_date) - month(first_purchase_date) as int)
                    as relative_month
        from f_orders join d_customer using (customer_sk) join d_date on purchase_date_sk = date_sk
        where date_sk <> -1 and customer_sk <> '-1'
    """,
    "m_cohortes": """
        select cohort_year_month, count(distinct customer_sk) as clientes_cohorte,
               count(distinct customer_sk) filter (where relative_month between 1 and 3) as recompra_3m,
               count(distinct customer_sk) filter (where relative_month between 1 and 6) as recompra_6m,
               count(distinct customer_sk) filter (where relative_month between 1 and 12) as recompra_12m,
               sum(order_value) as gmv_acumulado, sum(order_value) filter (where relative_month = 0) as gmv_primera_compra
        from activity group by 1
    """,
    "m_satisfaccion": f"""
        select year_month, case when is_late = 0 then 'a tiempo' when days_late <= 3 then '1-3 dias'
                                when days_late <= 7 then '4-7 dias' else '>7 dias' end as tramo_retraso,
               cast(sum(review_count) as bigint) as reviews, cast(sum(is_negative) as bigint) as reviews_negativas,
               cast(sum(is_positive) as bigint) as reviews_positivas, {exact_avg("review_score")} as score_medio,
               {exact_avg("response_time_hours")} as tiempo_respuesta_medio_h,
               {exact_avg("days_late")} as retraso_medio_dias
        from f_orders join f_reviews using (order_id) join d_date on purchase_date_sk = d_date.date_sk
        where d_date.date_sk <> -1 and is_delivered = 1 group by 1, 2
    """,
    "m_categoria": """
        select year_month, year, coalesce(product_category_name_english, 'Sin categoria') as product_category,
               sum(price) as gmv, sum(freight_value) as ingreso_flete, sum(gross_revenue) as ingreso_bruto,
               sum(price) - sum(freight_value) as margen_contribucion,
               cast(sum(item_count) as bigint) as items_vendidos, count(distinct order_id) as ordenes
        from f_items join d_product using (product_sk) join d_date using (date_sk)
        where date_sk <> -1 group by 1, 2, 3
    """,
    "m_segmento": """
        select year_month, seller_segment, sum(price) as gmv, count(order_item_id) as items_vendidos,
               count(distinct order_id) as ordenes
        from f_items join d_seller using (seller_sk) join d_date using (date_sk)
        where date_sk <> -1 group by 1, 2
    """,
}

_NAME = re.compile(r"\b(" + "|".join(INPUTS) + r")\b")


def with_inputs(text: str) -> str:
    """The query with the inputs it mentions, directly or through others, in order."""
    needed: set[str] = set()
    todo = [text]
    while todo:
        for name in _NAME.findall(todo.pop()):
            if name not in needed:
                needed.add(name)
                todo.append(INPUTS[name])
    if not needed:
        return text
    parts = [f"{name} as ({body})" for name, body in INPUTS.items() if name in needed]
    text = text.strip()
    own = text.startswith("with ")
    return "with " + ",\n".join(parts) + (",\n" if own else "\n") + (text[5:] if own else text)
