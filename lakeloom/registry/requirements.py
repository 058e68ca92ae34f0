"""Business questions and service levels that are documented beyond the star schema."""

from datetime import date

from pyspark.sql import functions as F

from lakeloom.functions.constants import SESSION_GAP_MINUTES
from lakeloom.functions.keys import key_date
from lakeloom.operators import sessions as S
from lakeloom.operators.incremental import upsert
from lakeloom.plans import marts
from lakeloom.plans import requirements as R
from lakeloom.registry import query
from lakeloom.session import working_folder
from lakeloom.sources import tables
from lakeloom.streaming import funnel as streaming

# Exchange rates: one quote per weekday with sales, the number of orders giving the decimals.
QUOTES = """(select cast(o_orderdate as date) as quoted_on, cast(4 + (count(*) % 100) / 100 as decimal(10,4)) as rate
             from orders where dayofweek(o_orderdate) not in (0, 6) group by 1)"""


def _quotes(star):
    traded = star.raw.given("orders").where(F.weekday("o_orderdate") < 5)
    rate = (4 + F.count("*") % 100 / 100).cast("decimal(10,4)")
    return traded.groupBy(F.to_date("o_orderdate").alias("quoted_on")).agg(rate.alias("rate")).withColumn(
        "currency", F.lit("USD")
    )


def _late_quotes(star):
    return _quotes(star).where(F.col("quoted_on") >= date(1998, 1, 1))


_LATE_QUOTES = f"(select * from {QUOTES} where quoted_on >= date '1998-01-01')"

def _rates(star, quotes):
    return R.daily_rates(quotes, star.dim_date)


@query(
    "X1_gmv_in_currency",
    f"""with sold as (select year_month, rate, sum(price) as gmv, count(*) as n from f_items left join d_date using (date_sk)
            asof left join {QUOTES} q on d_date.full_date >= q.quoted_on group by 1, 2)
        select year_month, cast(sum(gmv) as decimal(28,2)) as gmv,
               cast(round(sum(cast(gmv as double) / cast(rate as double)), 0) as bigint) as gmv_converted,
               cast(coalesce(sum(n) filter (where rate is null), 0) as bigint) as unconverted from sold group by 1""",
)
def gmv_in_currency(star):
    sales = R.sales_in_currency(star.fct_order_items, _rates(star, _quotes(star)), star.dim_date, "USD")
    return _whole(sales, "gmv_converted")


def _whole(df, *amounts):
    """Converted amounts in whole units, as engines round quotients in different places."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), 0).cast("long") for c in amounts})


@query(
    "X1_gmv_before_the_first_quote",
    f"""select year_month, cast(sum(price) as decimal(28,2)) as gmv,
               count(*) filter (where full_date is null or full_date < (select min(quoted_on) from {_LATE_QUOTES})) as unconverted
        from f_items left join d_date using (date_sk) group by 1""",
)
def gmv_before_the_first_quote(star):
    """Sales before any quote are in the total and counted as not converted."""
    sales = R.sales_in_currency(star.fct_order_items, _rates(star, _late_quotes(star)), star.dim_date, "USD")
    return sales.drop("gmv_converted")


@query(
    "X1_category_margin",
    f"""with sold as (
            select year_month, coalesce(product_category_name_english, 'Sin categoria') as category, rate, sum(price) as gmv,
                   sum(freight_value) as freight, count(*) as n
            from f_items left join d_product using (product_sk) left join d_date using (date_sk)
            asof left join {QUOTES} q on d_date.full_date >= q.quoted_on group by 1, 2, 3)
        select year_month, category, cast(sum(gmv) as decimal(28,2)) as gmv,
               cast(round(sum(cast(gmv as double) / cast(rate as double)), 0) as bigint) as gmv_converted,
               cast(coalesce(sum(n) filter (where rate is null), 0) as bigint) as unconverted,
               cast(sum(freight) as decimal(28,2)) as freight,
               cast(round(sum(cast(gmv - coalesce(freight, 0) as double) / cast(rate as double)), 0) as bigint) as margin_converted
        from sold group by 1, 2""",
)
def category_margin(star):
    rates = _rates(star, _quotes(star))
    return _whole(
        R.category_margin(star.fct_order_items, star.dim_product, rates, star.dim_date, "USD"), "gmv_converted", "margin_converted"
    )


@query(
    "X1_daily_rates",
    f"""select 'USD' as currency, rate, cast(d as date) as rate_date
        from (select unnest(generate_series((select min(quoted_on)::timestamp from {QUOTES}), timestamp '2002-12-31',
                                            interval 1 day)) as d) days
        asof join {QUOTES} q on cast(days.d as date) >= q.quoted_on""",
)
def daily_rates(star):
    return _rates(star, _quotes(star))


# Weather: one nested report per event, spread over regions and days, its number as rainfall.
WEATHER = """(select ['Norte','Nordeste','Centro-Oeste','Sudeste','Sul'][1 + user_id % 5] as region,
                     date '1995-01-01' + cast(event_id % 2600 as int) as day,
                     max(cast(cast(json_extract(props, '$.k') as int) >= 97 as int)) as severe
              from events group by 1, 2)"""


def _weather_reports(star):
    """Events as nested JSON reports of a weather service."""
    regions = F.array(*[F.lit(r) for r in ("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul")])
    day = F.date_add(F.lit(date(1995, 1, 1)), (F.col("event_id") % 2600).cast("int"))
    rain = F.get_json_object("props", "$.k").cast("int")
    report = F.struct(
        F.element_at(regions, (1 + F.col("user_id") % 5).cast("int")).alias("region"),
        F.array(F.struct(day.alias("day"), rain.alias("rain_mm"))).alias("daily"),
    )
    return star.raw.given("events").select(F.to_json(report).alias("payload"))


@query("X2_weather_days", f"select * from {WEATHER}")
def weather_days(star):
    return R.weather_days(_weather_reports(star), "payload", 97)


@query(
    "X2_late_in_severe_weather",
    f"""select region, count(*) as late, count(*) filter (where hit) as late_in_severe_weather,
        count(*) filter (where hit) / count(*) as share
        from (select region, order_id, exists (select 1 from {WEATHER} w where w.severe = 1 and w.region = o.region
                                               and w.day between o.bought_on and o.delivered_on) as hit
              from (select order_id, region, cast(order_purchase_timestamp as date) as bought_on,
                           cast(order_delivered_customer_date as date) as delivered_on
                    from f_orders join s_orders using (order_id) join d_geography using (geography_sk)
                    where is_late = 1) o)
        group by 1""",
)
def late_in_severe_weather(star):
    # Published like any source, so that the nested reports are parsed once.
    root = working_folder(star.spark, "weather")
    tables.publish(R.weather_days(_weather_reports(star), "payload", 97), root, "weather", ["region", "day"])
    weather = tables.read_table(star.spark, root, "weather")
    so_far = R.severe_days_so_far(weather, star.dim_date)
    # The fact has both days as keys, so no table of orders has to be joined again.
    late = star.fct_orders.where("is_late = 1").select(
        "geography_sk", "is_late", key_date("purchase_date_sk").alias("bought_on"), key_date("delivered_date_sk").alias("delivered_on")
    )
    placed = late.join(star.dim_geography.select("geography_sk", "region"), "geography_sk")
    return R.late_in_severe_weather(placed, so_far)


@query(
    "X3_segment_moves",
    """with ranked as (select seller_id, valid_from, case seller_segment when 'Bronze' then 1 when 'Silver' then 2 else 3 end as r
                       from d_seller where seller_id <> '-1'),
            moves as (select *, lag(r) over (partition by seller_id order by valid_from) as before from ranked)
       select year(valid_from) || '-Q' || quarter(valid_from) as year_quarter,
              count(*) filter (where r > before) as promoted, count(*) filter (where r < before) as demoted,
              cast((select count(*) from s_sellers) as bigint) as sellers_before,
              count(*) filter (where r > before) / (select count(*) from s_sellers) as promotion_rate,
              count(*) filter (where r < before) / (select count(*) from s_sellers) as demotion_rate
       from moves where before is not null group by 1, 4""",
)
def segment_moves(star):
    return R.segment_moves(star.dim_seller)


@query(
    "X4_retention_matrix",
    """select cohort_year_month, relative_month, count(distinct customer_sk) as customers, count(*) as orders,
       sum(order_value) as gmv from activity group by 1, 2""",
)
def retention_matrix(star):
    return R.retention_matrix(marts.order_activity(star.fct_orders, star.dim_customer, star.dim_date))


GAP = f"interval {SESSION_GAP_MINUTES} minute"
SESSIONS = f"""(select user_id, min(ts) as session_start, max(ts) as session_end, count(*) as events,
                       min(ts) filter (where step = 'view') as first_view, min(ts) filter (where step = 'cart') as first_cart,
                       min(ts) filter (where step = 'checkout') as first_checkout,
                       min(ts) filter (where step = 'payment') as first_payment
                from (select *, sum(opens) over (partition by user_id order by ts, event_id) as session
                      from (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) > {GAP}
                                           then 1 else 0 end as opens from clicks))
                group by user_id, session)"""


@query("X5_sessions", f"select * from {SESSIONS}")
def sessions(star):
    return S.sessions(star.raw.clicks)


@query(
    "X5_funnel",
    f"""with f as (select count(*) as sessions, count(first_view) as view,
                   count(*) filter (where first_cart >= first_view) as cart,
                   count(*) filter (where first_cart >= first_view and first_checkout >= first_cart) as checkout,
                   count(*) filter (where first_cart >= first_view and first_checkout >= first_cart
                                      and first_payment >= first_checkout) as payment from {SESSIONS})
        select 1 as position, 'view' as step, view as reached, view / nullif(sessions, 0) as conversion from f
        union all select 2, 'cart', cart, cart / nullif(view, 0) from f
        union all select 3, 'checkout', checkout, checkout / nullif(cart, 0) from f
        union all select 4, 'payment', payment, payment / nullif(checkout, 0) from f""",
)
def funnel(star):
    return S.funnel(S.sessions(star.raw.clicks))


DELAY_MINUTES = 3
CLOSED = f"""(select * from {SESSIONS}
              where session_end + {GAP} <= (select max(ts) from events) - interval {DELAY_MINUTES} minute)"""


def _streamed(star):
    stored = star.spark.read.parquet(f"{star.raw.folder}/events.parquet").schema
    stream = streaming.read_clicks(star.spark, star.raw.folder, "events.parquet", stored)
    return streaming.closed_sessions(star.raw.as_clicks(stream), DELAY_MINUTES)


@query("X6_streaming_sessions", f"select * from {CLOSED}")
def streaming_sessions(star):
    return streaming.run_available(_streamed(star), working_folder(star.spark, "sessions"))


@query(
    "X6_funnel_steps",
    """select time_bucket(interval 5 minute, ts) as window_start, step, count(*) as clicks from clicks
       where step is not null group by 1, 2""",
)
def funnel_steps(star):
    """Counts that a dashboard sees one trigger after the click."""
    stored = star.spark.read.parquet(f"{star.raw.folder}/events.parquet").schema
    clicks = star.raw.as_clicks(streaming.read_clicks(star.spark, star.raw.folder, "events.parquet", stored))
    target = working_folder(star.spark, "steps")
    streaming.start_updates(streaming.step_counts(clicks.where("step is not null")), target, availableNow=True).awaitTermination()
    return streaming.latest_counts(star.spark, target)


@query(
    "X7_abandoned_carts",
    f"select user_id, session_start, first_cart from {CLOSED} where first_cart is not null and first_payment is null",
)
def abandoned_carts(star):
    recover = S.abandoned(_streamed(star)).select("user_id", "session_start", "first_cart")
    return streaming.run_available(recover, working_folder(star.spark, "carts"))


@query(
    "X7_recovery",
    f"""select user_id, ts as cart_at, ts + interval {streaming.PATIENCE_MINUTES} minute as due_at from clicks c
        where step = 'cart' and ts + interval {streaming.PATIENCE_MINUTES} minute
                                <= (select max(ts) from events) - interval {DELAY_MINUTES} minute
          and not exists (select 1 from clicks p where p.user_id = c.user_id and p.step = 'payment'
                          and p.ts >= c.ts and p.ts < c.ts + interval {streaming.PATIENCE_MINUTES} minute)""",
)
def recovery(star):
    """Carts that a recovery mail is due for, as they come out of the stream."""
    stored = star.spark.read.parquet(f"{star.raw.folder}/events.parquet").schema
    clicks = star.raw.as_clicks(streaming.read_clicks(star.spark, star.raw.folder, "events.parquet", stored))
    return streaming.run_available(streaming.recovery_triggers(clicks, DELAY_MINUTES), working_folder(star.spark, "recovery"))


@query(
    "X7_abandonment_rate",
    f"""select count(*) as carts, count(*) filter (where first_payment is null) as abandoned,
        count(*) filter (where first_payment is null) / count(*) as abandonment_rate
        from {SESSIONS} where first_cart is not null""",
)
def abandonment_rate(star):
    return S.abandonment_rate(S.sessions(star.raw.clicks))


@query(
    "X11_freshness",
    """with loads as (select cast(o_orderdate as date) as day, max(o_orderkey) % 9 as h from orders
                      where dayofweek(o_orderdate) <> 0 group by 1),
            days as (select cast(unnest(generate_series(min(o_orderdate)::timestamp, max(o_orderdate)::timestamp, interval 1 day)) as date)
                     as day from orders)
       select year(day) || '-Q' || quarter(day) as year_quarter, count(*) as days, count(*) filter (where h <= 7) as on_time,
       count(*) filter (where h <= 7) / count(*) as rate, count(*) filter (where h <= 7) / count(*) >= 0.99 as met
       from days left join loads using (day) group by 1""",
)
def freshness(star):
    """Load moments stand in as an hour of the next morning taken from the last order of the day; none come on Sundays."""
    orders = star.raw.given("orders").select(F.to_date("o_orderdate").alias("day"), "o_orderkey")
    hour = (F.max("o_orderkey") % 9).cast("int")
    daily = orders.where(F.weekday("day") != 6).groupBy("day").agg(hour.alias("hour"))
    loaded = F.date_add("day", 1).cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("hour"))
    ends = orders.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    days = ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day"))
    return R.freshness(days, daily.select("day", loaded.alias("loaded_at")))


@query(
    "X16_upsert",
    """select order_id, case when order_status = 'SHIPPED' then 'DELIVERED' else order_status end as order_status,
       case when order_status = 'SHIPPED' then order_estimated_delivery_date else order_delivered_customer_date end
            as order_delivered_customer_date
       from s_orders
       union all select order_id || '-again', 'APPROVED', cast(null as timestamp) from s_orders where order_status = 'CANCELED'""",
)
def upsert_orders(star):
    """Shipped orders arrive, reported twice with different times, and canceled ones are placed again.

    A report that is older than what is known of delivered orders comes late and changes nothing.
    """
    base = star.orders.select("order_id", "order_status", "order_delivered_customer_date", F.lit(0).alias("reported"))
    late = star.orders.where("order_status = 'DELIVERED'").select(
        "order_id", F.lit("SHIPPED").alias("order_status"), F.lit(None).cast("timestamp").alias("order_delivered_customer_date"),
        F.lit(-1).alias("reported"),
    )
    promised = F.col("order_estimated_delivery_date")
    shipped = star.orders.where("order_status = 'SHIPPED'").withColumn("report", F.explode(F.array(F.lit(1), F.lit(2))))
    arrived = shipped.select(
        "order_id",
        F.lit("DELIVERED").alias("order_status"),
        F.when(F.col("report") == 2, promised).alias("order_delivered_customer_date"),
        F.col("report").alias("reported"),
    )
    again = star.orders.where("order_status = 'CANCELED'").select(
        F.concat("order_id", F.lit("-again")).alias("order_id"),
        F.lit("APPROVED").alias("order_status"),
        F.lit(None).cast("timestamp").alias("order_delivered_customer_date"),
        F.lit(1).alias("reported"),
    )
    changes = arrived.unionByName(again).unionByName(late)
    return upsert(base, changes, ["order_id"], ["reported"]).drop("reported")


@query(
    "X16_upsert_items",
    """select order_id, order_item_id, case when order_item_id = 1 then price + 1 else price end as price from s_items""",
)
def upsert_items(star):
    """The first item of every order is reported again with a corrected price."""
    base = star.order_items.select("order_id", "order_item_id", "price", F.lit(0).alias("reported"))
    corrected = base.where("order_item_id = 1").select(
        "order_id", "order_item_id", (F.col("price") + 1).cast("decimal(12,2)").alias("price"), F.lit(1).alias("reported")
    )
    late = base.where("order_item_id = 2").withColumns({"price": F.lit(0).cast("decimal(12,2)"), "reported": F.lit(-1)})
    changes = corrected.unionByName(late)
    return upsert(base, changes, ["order_id", "order_item_id"], ["reported"]).drop("reported")


@query(
    "X17_unusual_days",
    """with seen as (select order_status, cast(order_purchase_timestamp as date) as day, count(*) as volume
                     from s_orders where order_purchase_timestamp is not null group by all),
            spans as (select order_status, min(day)::timestamp as lo, (select max(day) from seen)::timestamp as hi from seen group by 1),
            days as (select order_status, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as day from spans),
            v as (select order_status, day, coalesce(volume, 0) as volume from days left join seen using (order_status, day)),
            m as (select *, count(volume) over w as n, sum(volume) over w as total, sum(volume * volume) over w as squares
                  from v window w as (partition by order_status order by day rows between 28 preceding and 1 preceding))
       select order_status, day, volume, cast(total as double) / n as mean,
              sqrt(cast(squares * n - total * total as double) / (n * (n - 1))) as deviation
       from m where n = 28 and abs(volume - cast(total as double) / n)
                               > 3 * sqrt(cast(squares * n - total * total as double) / (n * (n - 1)))""",
)
def unusual_days(star):
    return R.unusual_days(R.daily_volume(star.orders, "order_status", "order_purchase_timestamp"), "order_status")
