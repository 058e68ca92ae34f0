"""Data checks, on the clean tables and on the same tables with faults put in."""

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.constants import UNKNOWN_KEY
from lakeloom.functions.keys import batch_id
from lakeloom.operators import quality as Q
from lakeloom.operators.history import history_violations
from lakeloom.plans import contracts, silver
from lakeloom.plans import requirements as R
from lakeloom.plans.dimensions import SELLER_HISTORY
from lakeloom.registry import query
from lakeloom.registry import oracle as sql
from lakeloom.session import working_folder
from lakeloom.sources.tables import key_profile, publish, read_staged, read_table, stage

PROCESSED = datetime(2026, 8, 1, 6, 30)


@query("D1_unique", "select customer_sk, count(*) as occurrences from d_customer group by 1 having count(*) > 1")
def unique(star):
    return Q.duplicated(star.dim_customer, "customer_sk")


@query(
    "D1_unique_faults",
    """select l_orderkey, l_linenumber, count(*) as occurrences from lineitem group by 1, 2 having count(*) > 1""",
)
def unique_faults(star):
    """The given order lines are not unique by their number."""
    return Q.duplicated(star.raw.given("lineitem"), "l_orderkey", "l_linenumber")


@query("D2_not_null", "select * from m_segmento where year_month is null or seller_segment is null or gmv is null")
def not_null(star):
    return Q.missing(star.mart_segmento_vendedor, "year_month", "seller_segment", "gmv")


@query("D2_not_null_faults", "select order_id, order_item_id, price from s_items where freight_value is null")
def not_null_faults(star):
    return Q.missing(star.order_items, "freight_value").select("order_id", "order_item_id", "price")


@query(
    "D3_accepted_values",
    """select 'seller_segment' as checked, seller_segment as value, count(*) as occurrences from d_seller
       where seller_segment not in ('Bronze', 'Silver', 'Gold', 'Unknown') group by all
       union all select 'region', region, count(*) from d_geography
       where region not in ('Norte', 'Nordeste', 'Centro-Oeste', 'Sudeste', 'Sul', 'Unknown') group by all
       union all select 'tramo_retraso', tramo_retraso, count(*) from m_satisfaccion
       where tramo_retraso not in ('a tiempo', '1-3 dias', '4-7 dias', '>7 dias') group by all""",
)
def accepted_values(star):
    checks = [
        (star.dim_seller, "seller_segment", contracts.SEGMENTS),
        (star.dim_geography, "region", contracts.REGIONS),
        (star.mart_satisfaccion, "tramo_retraso", contracts.DELAYS),
    ]
    found = [
        Q.unaccepted(df, column, values).select(
            F.lit(column).alias("checked"), F.col(column).alias("value"), "occurrences"
        )
        for df, column, values in checks
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "D3_accepted_values_faults",
    """select order_status, count(*) as occurrences from s_orders
       where order_status not in ('DELIVERED', 'SHIPPED') group by 1""",
)
def accepted_values_faults(star):
    return Q.unaccepted(star.orders, "order_status", ["DELIVERED", "SHIPPED"])


@query(
    "D4_relationships",
    """select order_id, seller_sk from f_items where seller_sk is not null and seller_sk not in (select seller_sk from d_seller)
       union all select order_id, customer_sk from f_orders
       where customer_sk is not null and customer_sk not in (select customer_sk from d_customer)""",
)
def relationships(star):
    sellers = Q.orphans(star.fct_order_items, "seller_sk", star.dim_seller, "seller_sk").select("order_id", "seller_sk")
    customers = Q.orphans(star.fct_orders, "customer_sk", star.dim_customer, "customer_sk")
    return sellers.union(customers.select("order_id", "customer_sk"))


@query(
    "D4_relationships_faults",
    "select order_id, seller_sk from f_items where seller_sk not in (select seller_sk from d_seller where is_current)",
)
def relationships_faults(star):
    """Items that point at a version that is no longer current."""
    current = star.dim_seller.where("is_current")
    return Q.orphans(star.fct_order_items, "seller_sk", current, "seller_sk").select("order_id", "seller_sk")


@query("D5_singular", "select cohort_year_month from m_cohortes where recompra_3m > clientes_cohorte or recompra_6m > recompra_12m")
def singular(star):
    return Q.cohort_violations(star.mart_cohortes).select("cohort_year_month")


@query(
    "D5_singular_faults",
    """select cohort_year_month, clientes_cohorte, recompra_3m, recompra_12m as recompra_6m, recompra_6m as recompra_12m
       from m_cohortes where recompra_12m > recompra_6m or recompra_12m > clientes_cohorte""",
)
def singular_faults(star):
    """Two windows of the mart swapped."""
    swapped = star.mart_cohortes.withColumns(
        {"recompra_6m": F.col("recompra_12m"), "recompra_12m": F.col("recompra_6m")}
    )
    return Q.cohort_violations(swapped)


@query(
    "D6_key_gate",
    """select 'order_items' as table_name, count(*) as row_count, count(distinct (order_id, order_item_id)) as distinct_keys
       from s_items
       union all select 'lineitem', count(*), count(distinct (l_orderkey, l_linenumber)) from lineitem""",
)
def key_gate(star):
    """A table the gate lets through and one it stops."""
    lines = star.raw.given("lineitem")
    profiles = {
        "order_items": key_profile(star.order_items, ["order_id", "order_item_id"]),
        "lineitem": key_profile(lines, ["l_orderkey", "l_linenumber"]),
    }
    named = [df.select(F.lit(name).alias("table_name"), "*") for name, df in profiles.items()]
    return reduce(DataFrame.unionByName, named)


ITEM_ERRORS = {"freight_missing": "freight is not a number", "product_unknown": "no such product"}


def _checked_items(star):
    known = star.products.select("product_id", F.lit(True).alias("_known"))
    return star.raw.order_items.join(known, "product_id", "left")


def _split_items(star):
    rules = {
        "freight_missing": silver.to_money("freight_value").isNull(),
        "product_unknown": F.col("_known").isNull(),
    }
    audit = {
        "processed_at": F.lit(PROCESSED),
        "source_file": F.lit("order_items.csv"),
        "batch_id": F.lit(batch_id("order_items", PROCESSED.date())),
    }
    return Q.split_quarantine(_checked_items(star), rules, ITEM_ERRORS, audit)


_BAD_FREIGHT = f"{sql.as_money('freight_value')} is null"
_BAD_PRODUCT = "product_id not in (select product_id from s_products)"


@query(
    "X8_quarantine",
    f"""select order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value, rule_id,
        error_text, timestamp '{PROCESSED}' as processed_at, 'order_items.csv' as source_file,
        '{batch_id("order_items", PROCESSED.date())}' as batch_id
        from (select *, 'freight_missing' as rule_id, 'freight is not a number' as error_text from raw_items
              where {_BAD_FREIGHT}
              union all select *, 'product_unknown', 'no such product' from raw_items where {_BAD_PRODUCT})""",
)
def quarantine(star):
    _, bad = _split_items(star)
    return bad.drop("_known")


@query("X8_accepted", f"select * from raw_items where not ({_BAD_FREIGHT}) and not ({_BAD_PRODUCT})")
def accepted(star):
    good, _ = _split_items(star)
    return good.drop("_known")


# Each extract, and of each rule the condition in SQL and the error.
_NO_STATE = "coalesce(upper(trim({0})) not in (select unnest({1})), true)"
_QUARANTINED = {
    "customers": ("raw_customers", {
        "city_missing": (f"{sql.clean_text('customer_city')} is null", "no city"),
        "state_unknown": (_NO_STATE.format("customer_state", sql.STATES), "no such state"),
        "order_missing": ("customer_id not in (select customer_id from raw_orders)", "no order of this customer id"),
    }),
    "sellers": ("raw_sellers", {
        "city_missing": (f"{sql.clean_text('seller_city')} is null", "no city"),
        "state_unknown": (_NO_STATE.format("seller_state", sql.STATES), "no such state"),
        "never_sold": ("seller_id not in (select seller_id from s_items)", "no item of this seller"),
    }),
    "products": ("raw_products", {
        "category_missing": (f"{sql.clean_text('product_category_name')} is null", "no category"),
        "weight_unreadable": (f"trim(product_weight_g) <> '' and {sql.as_int('product_weight_g')} is null", "weight is not a number"),
        "photos_missing": (f"{sql.as_int('product_photos_qty')} is null", "no number of photos"),
    }),
    "geolocation": ("raw_geo", {
        "city_missing": (f"{sql.clean_text('geolocation_city')} is null", "no city"),
        "state_unknown": (_NO_STATE.format("geolocation_state", sql.STATES), "no such state"),
        "latitude_missing": ("try_cast(geolocation_lat as double) is null", "no latitude"),
        "off_the_map": ("abs(try_cast(geolocation_lat as double)) > 90", "latitude out of bounds"),
    }),
    "orders": ("raw_orders", {
        "status_missing": (f"{sql.clean_code('order_status')} is null", "no status"),
        "purchase_missing": (f"{sql.as_ts('order_purchase_timestamp')} is null", "no moment of purchase"),
        "approval_unreadable": (f"trim(order_approved_at) <> '' and {sql.as_ts('order_approved_at')} is null", "moment of approval cannot be read"),
        "customer_unknown": ("customer_id not in (select customer_id from raw_customers)", "no such customer"),
    }),
    "order_items": ("raw_items", {
        "freight_missing": (_BAD_FREIGHT, "freight is not a number"),
        "order_unknown": ("order_id not in (select order_id from s_orders)", "no such order"),
        "product_unknown": (_BAD_PRODUCT, "no such product"),
        "seller_unknown": ("seller_id not in (select seller_id from s_sellers)", "no such seller"),
    }),
    "payments": ("raw_payments", {
        "installments_missing": (f"{sql.as_int('payment_installments')} is null", "no number of installments"),
        "order_unknown": ("order_id not in (select order_id from s_orders)", "no such order"),
    }),
    "reviews": ("raw_reviews", {
        "score_out_of_range": (f"coalesce({sql.as_int('review_score')} not between 1 and 5, true)", "score is not one to five"),
        "answer_missing": (f"{sql.as_ts('review_answer_timestamp')} is null", "no moment of the answer"),
        "order_unknown": ("order_id not in (select order_id from s_orders)", "no such order"),
    }),
}


def _quarantine_sql(entity: str) -> str:
    extract, rules = _QUARANTINED[entity]
    parts = [f"select *, '{rule}' as rule_id, '{error}' as error_text from {extract} where {bad}" for rule, (bad, error) in rules.items()]
    return f"select *, '{entity}.csv' as source_file, 'given' as batch_id, count(*) as occurrences from ({' union all '.join(parts)}) group by all"


for _entity in _QUARANTINED:
    query(f"X8_quarantine_{_entity}", _quarantine_sql(_entity))(
        lambda star, entity=_entity: star.table(f"quarantine_{entity}").drop("quarantine_id")
    )


@query(
    "X8_quarantine_report",
    " union all ".join(
        f"select '{entity}' as entity, rule_id, sum(occurrences) as rows from ({_quarantine_sql(entity)}) group by rule_id" for entity in _QUARANTINED
    ),
)
def quarantine_report(star):
    """Rows in quarantine by entity and rule."""
    counted = [
        star.table(f"quarantine_{entity}").groupBy(F.lit(entity).alias("entity"), "rule_id").agg(F.sum("occurrences").alias("rows"))
        for entity in _QUARANTINED
    ]
    return reduce(DataFrame.unionByName, counted)


@query(
    "X9_referential_integrity",
    """select 'items without order' as relation, count(*) as orphans from s_items where order_id not in (select order_id from s_orders)
       union all select 'items without product', count(*) from s_items where product_id not in (select product_id from s_products)
       union all select 'items without seller', count(*) from s_items where seller_id not in (select seller_id from s_sellers)
       union all select 'payments without order', count(*) from s_payments where order_id not in (select order_id from s_orders)
       union all select 'reviews without order', count(*) from s_reviews where order_id not in (select order_id from s_orders)
       union all select 'orders without items', count(*) from s_orders where order_id not in (select order_id from s_items)""",
)
def referential_integrity(star):
    pairs = {
        "items without order": (star.order_items, "order_id", star.orders),
        "items without product": (star.order_items, "product_id", star.products),
        "items without seller": (star.order_items, "seller_id", star.sellers),
        "payments without order": (star.payments, "order_id", star.orders),
        "reviews without order": (star.reviews, "order_id", star.orders),
        "orders without items": (star.orders, "order_id", star.order_items),
    }
    counted = [
        Q.orphans(child, key, parent, key).agg(F.lit(name).alias("relation"), F.count("*").alias("orphans"))
        for name, (child, key, parent) in pairs.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query(
    "X10_volume",
    """select cast(order_purchase_timestamp as date) as bought_on, count(*) as lost from s_orders
       where order_status = 'DELIVERED' and order_id not in (select order_id from f_orders) group by 1""",
)
def volume(star):
    """Every delivered order of the source is in the fact table."""
    source = silver.orders(star.raw.orders, star.raw.customers).where("order_status = 'DELIVERED'")
    dated = source.select("order_id", F.to_date("order_purchase_timestamp").alias("bought_on"))
    return R.volume_gaps(dated, star.fct_orders, "order_id", "bought_on")


@query(
    "X10_gate",
    """select (select count(*) from f_orders) as visible, count(*) as staged,
              (select count(*) from s_orders where order_status = 'DELIVERED' and order_id not in (select order_id from s_items)) as lost
       from f_orders where order_id in (select order_id from s_items)""",
)
def gate(star):
    """A build of the order fact that lost orders without items: it is staged and found out, readers keep the good one."""
    root, key = working_folder(star.spark, "gate"), ["order_id"]
    publish(star.fct_orders, root, "fct_orders", key)
    folder, staged = stage(star.fct_orders.join(star.order_items, "order_id", "left_semi"), root, "fct_orders", key)
    source = star.orders.where("order_status = 'DELIVERED'")
    dated = source.select("order_id", F.to_date("order_purchase_timestamp").alias("bought_on"))
    lost = R.volume_gaps(dated, read_staged(star.spark, folder), "order_id", "bought_on")
    visible = read_table(star.spark, root, "fct_orders").agg(F.count("*").alias("visible"), F.lit(staged).cast("long").alias("staged"))
    return visible.join(lost.agg(F.coalesce(F.sum("lost"), F.lit(0)).alias("lost")))


@query(
    "X10_volume_faults",
    """select cast(order_purchase_timestamp as date) as bought_on, count(*) as lost from s_orders
       where order_status = 'DELIVERED' and order_id not in (select order_id from s_items) group by 1""",
)
def volume_faults(star):
    """The gap an inner join of orders and items would leave."""
    source = star.orders.where("order_status = 'DELIVERED'")
    dated = source.select("order_id", F.to_date("order_purchase_timestamp").alias("bought_on"))
    return R.volume_gaps(dated, star.order_items, "order_id", "bought_on")


CRITICAL = {
    "orders": ["order_id", "customer_unique_id", "order_delivered_carrier_date", "order_delivered_customer_date",
               "order_estimated_delivery_date"],
    "order_items": ["order_id", "price"],
}


@query(
    "X12_critical_nulls",
    " union all ".join(
        f"""select '{t}' as table_name, '{c}' as column_name, count(*) filter (where {c} is null) as nulls, count(*) as row_count,
                   count(*) filter (where {c} is null) / count(*) as null_rate,
                   count(*) filter (where {c} is null) / count(*) < 0.005 as met
            from {"s_orders" if t == "orders" else "s_items"}"""
        for t, columns in CRITICAL.items()
        for c in columns
    ),
)
def critical_nulls(star):
    rates = [R.critical_nulls(star.table(t), columns).withColumn("table_name", F.lit(t)) for t, columns in CRITICAL.items()]
    return reduce(DataFrame.unionByName, rates)


_STEPS = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")


def _out_of_order(table: str) -> str:
    """Every pair of moments in the wrong order."""
    pairs = [(a, b) for i, b in enumerate(_STEPS) for a in _STEPS[:i]]
    return " union ".join(f"select order_id, '{b}_too_early' as rule_id from {table} where {b} < {a}" for a, b in pairs)


@query("X13_temporal_coherence", _out_of_order("s_orders"))
def temporal_coherence(star):
    return _too_early(star.orders)


def _too_early(orders):
    tagged = Q.tag_violations(orders, R.temporal_rules())
    return tagged.select("order_id", F.explode("violations").alias("rule_id"))


@query(
    "X13_behind_a_gap",
    _out_of_order("""(select * replace (null::timestamp as order_approved_at, null::timestamp as order_delivered_carrier_date,
                      order_purchase_timestamp - interval 5 day as order_delivered_customer_date) from s_orders)"""),
)
def behind_a_gap(star):
    """Deliveries before the purchase, with nothing known in between."""
    none = F.lit(None).cast("timestamp")
    early = F.col("order_purchase_timestamp") - F.expr("interval 5 days")
    return _too_early(
        star.orders.withColumns(
            {"order_approved_at": none, "order_delivered_carrier_date": none, "order_delivered_customer_date": early}
        )
    )


@query(
    "X14_domain_checks",
    """select zip_code_prefix, rule_id, count(*) as points from (
         select zip_code_prefix, 'latitude_out_of_bounds' as rule_id from geo_points where lat < 0 or lat > 9000
         union all select zip_code_prefix, 'longitude_out_of_bounds' from geo_points where lng < -9900 or lng > 0
         union all select zip_code_prefix, 'latitude_missing' from geo_points where lat is null
         union all select zip_code_prefix, 'state_out_of_domain' from geo_points
         where state not in ('SP', 'RJ', 'MG', 'ES')) group by all""",
)
def domain_checks(star):
    rules = {
        "latitude_out_of_bounds": ~F.col("lat").between(0, 9000),
        "longitude_out_of_bounds": ~F.col("lng").between(-9900, 0),
        "latitude_missing": F.col("lat").isNull(),
        "state_out_of_domain": ~F.col("state").isin("SP", "RJ", "MG", "ES"),
    }
    tagged = Q.tag_violations(silver.geolocation_points(star.raw.geolocation), rules)
    broken = tagged.select("zip_code_prefix", F.explode("violations").alias("rule_id"))
    return broken.groupBy("zip_code_prefix", "rule_id").agg(F.count("*").alias("points"))


@query(
    "X14_score_domain",
    """select review_id, order_id, review_score + 2 as review_score from s_reviews where review_score + 2 not between 1 and 5""",
)
def score_domain(star):
    """Scores are 1 to 5; here all are two too high."""
    high = star.reviews.withColumn("review_score", F.col("review_score") + 2)
    return high.where(~F.col("review_score").between(1, 5)).select("review_id", "order_id", "review_score")


@query(
    "X15_history_integrity",
    """select seller_id, count(*) filter (where is_current) as current_rows, count(*) filter (where valid_to < valid_from) as inverted,
              count(*) filter (where following <= valid_to) as overlapping
       from (select *, lead(valid_from) over (partition by seller_id order by valid_from, valid_to) as following from d_seller)
       group by 1 having current_rows <> 1 or inverted > 0 or overlapping > 0""",
)
def history_integrity(star):
    return history_violations(star.dim_seller, SELLER_HISTORY)


@query(
    "X15_history_integrity_faults",
    """select seller_id, count(*) filter (where is_current) as current_rows,
       count(*) filter (where valid_to < valid_from) as inverted, count(*) filter (where following <= valid_to) as overlapping
       from (select *, lead(valid_from) over (partition by seller_id order by valid_from, valid_to) as following
             from (select seller_id, valid_from, is_current or seller_id like '%3' as is_current,
                          case when seller_id like '%5' then valid_to + 40 when seller_id like '%7' then valid_from - 1
                               else valid_to end as valid_to
                   from (select * replace (least(valid_to, date '9000-01-01') as valid_to) from d_seller)))
       group by 1 having current_rows <> 1 or inverted > 0 or overlapping > 0""",
)
def history_integrity_faults(star):
    """Closed rows marked current, ranges stretched over the next one, ranges turned round."""
    seller, until = F.col("seller_id"), F.least("valid_to", F.lit(date(9000, 1, 1)))
    faulty = star.dim_seller.where(seller.isNotNull()).withColumns(
        {
            "is_current": F.col("is_current") | seller.endswith("3"),
            "valid_to": F.when(seller.endswith("5"), F.date_add(until, 40))
            .when(seller.endswith("7"), F.date_sub("valid_from", 1))
            .otherwise(until),
        }
    )
    return history_violations(faulty, SELLER_HISTORY)


@query("X15_one_current_per_seller", "select seller_id from d_seller group by 1 having count(*) filter (where is_current) <> 1")
def one_current_per_seller(star):
    members = star.dim_seller.where(F.col("seller_id") != UNKNOWN_KEY)
    return members.groupBy("seller_id").agg(F.count_if("is_current").alias("n")).where("n <> 1").select("seller_id")


_SQL_NAMES = {
    "dim_date": "d_date", "dim_customer": "d_customer", "dim_product": "d_product", "dim_geography": "d_geography",
    "dim_seller": "d_seller", "fct_orders": "f_orders", "fct_order_items": "f_items", "mart_cohortes": "m_cohortes",
    "mart_satisfaccion": "m_satisfaccion", "mart_ventas_categoria": "m_categoria", "mart_segmento_vendedor": "m_segmento",
}


def _declared_sql() -> str:
    """One counting SELECT per declared check."""
    name = _SQL_NAMES

    def counting(check: str, rows: str) -> str:
        return f"select '{check}' as check_name, count(*) as violations from ({rows})"

    def listed(values):
        return ", ".join(f"'{v}'" for v in values)

    parts = [
        counting(f"unique {t}.{c}", f"select {c} from {name[t]} group by 1 having count(*) > 1")
        for t, c in contracts.UNIQUE.items()
    ]
    parts += [
        counting(f"not_null {t}.{c}", f"select 1 from {name[t]} where {c} is null")
        for t, columns in contracts.NOT_NULL.items()
        for c in columns
    ]
    parts += [
        counting(f"accepted_values {t}.{c}", f"select distinct {c} from {name[t]} where {c} not in ({listed(v)})")
        for (t, c), v in contracts.ACCEPTED.items()
    ]
    parts += [
        counting(f"relationships {t}.{c}", f"select 1 from {name[t]} where {c} not in (select {c} from {name[p]})")
        for (t, c), p in contracts.RELATIONSHIPS.items()
    ]
    parts.append(counting("repurchase within cohort", "select 1 from m_cohortes where recompra_12m > clientes_cohorte"))
    parts.append(
        counting("one current version", "select 1 from d_seller group by seller_id having sum(is_current::int) <> 1")
    )
    parts.append(counting("no inverted range", "select 1 from d_seller where valid_to < valid_from"))
    parts.append(
        counting(
            "no overlap",
            """select 1 from d_seller a join d_seller b using (seller_id)
               where a.valid_from < b.valid_from and b.valid_from <= a.valid_to""",
        )
    )
    return " union all ".join(parts)


@query("D_declared_checks", _declared_sql())
def declared_checks(star):
    """All declared tests of gold and marts with the number of violations each finds."""
    return contracts.check_report(star, contracts.declared_checks())
