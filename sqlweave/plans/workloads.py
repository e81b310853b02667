"""Sample workload jobs: the ETL statements the reference only parses,
run as DataFrame jobs on the test tables. Mapping: user -> customer, order/clue facts ->
orders, study status -> lineitem keyed (order, line number), city tier -> nation/region,
channel -> o_orderpriority, active detail -> events, run date -> a parameter."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType

from sqlweave.operators.reporting import first_last_per_key, money, total
from sqlweave.session import scratch_path
from sqlweave.sources.tables import read_table

RUN_DATE = "1999-01-01"          # the '%task_date' of the orders jobs
EVENTS_RUN_DATE = "2024-01-15"   # the '%task_date' of the events jobs

# Nation tiers of the CASE/IN job (W14), in tier order.
TIER_1 = ("NATION_0", "NATION_1", "NATION_2", "NATION_3")
TIER_2 = ("NATION_4", "NATION_5", "NATION_6", "NATION_7", "NATION_8", "NATION_9", "NATION_10",
          "NATION_11", "NATION_12")
TIER_3 = ("NATION_13", "NATION_14", "NATION_15", "NATION_16", "NATION_17", "NATION_18", "NATION_19")


def _t(spark, sf, name, *cols):
    return read_table(spark, sf, name).select(*cols)


def _city_dims(spark, sf) -> DataFrame:
    """Dimension dedup by GROUP BY (W2): nation -> region name as 'city level'. Both tables
    are small, so the planner broadcasts them."""
    reg = _t(spark, sf, "region", "r_regionkey", "r_name")
    nat = _t(spark, sf, "nation", "n_nationkey", "n_regionkey")
    return (nat.join(reg, nat.n_regionkey == reg.r_regionkey)
            .select("n_nationkey", "r_name").distinct())


def _user_dims(spark, sf) -> DataFrame:
    """Dimension dedup by GROUP BY (W2): customer -> nation."""
    return _t(spark, sf, "customer", "c_custkey", "c_nationkey").distinct()


def _with_city(spark, sf, facts: DataFrame) -> DataFrame:
    """Facts (with o_custkey) left join users left join city levels; nvl to 'OTHER'."""
    users = _user_dims(spark, sf)
    out = facts.join(users, facts.o_custkey == users.c_custkey, "left")
    out = out.join(_city_dims(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.withColumn("city_level", F.coalesce(F.col("r_name"), F.lit("OTHER")))


def _study_flags(spark, sf) -> DataFrame:
    """W4 re-planned: the four left joins on (order, line 1..4, status) to the same deduped
    table become one conditional aggregate (map-side reduced) and one join."""
    li = _t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_linestatus")
    return li.groupBy("l_orderkey", "l_linestatus").agg(
        *[F.max((F.col("l_linenumber") == k).cast("int")).alias(f"s{k}") for k in (1, 2, 3, 4)])


def _orders_with_study(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    fl = _study_flags(spark, sf)
    j = o.join(fl, (o.o_orderkey == fl.l_orderkey) & (o.o_orderstatus == fl.l_linestatus), "left")
    return j.select(*o.columns, *[F.coalesce(F.col(f"s{k}"), F.lit(0)).alias(f"s{k}") for k in (1, 2, 3, 4)])


# ---------------------------------------------------------------------------------------
def first_row_per_key(spark, sf):
    """First and last order of every customer."""
    o = _t(spark, sf, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    r = first_last_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderdate", "o_orderkey"])
    return r.select("o_custkey", F.col("first_o_orderkey").alias("first_orderkey"),
                    F.to_date("first_o_orderdate").alias("first_date"),
                    F.col("last_o_orderkey").alias("last_orderkey"),
                    F.to_date("last_o_orderdate").alias("last_date"))


def dim_dedup_left_join(spark, sf):
    """W2+W3: orders left join deduped user and city dimensions, grouped by city level."""
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey")
    return _with_city(spark, sf, o).groupBy("city_level").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers"))


def multi_key_left_joins(spark, sf):
    """Presence of study lines 1..4 per order, on three keys (order, line, status)."""
    return _orders_with_study(spark, sf).select("o_orderkey", "s1", "s2", "s3", "s4")


def if_arithmetic(spark, sf):
    """count(distinct case when if(..)+if(..)+if(..)+if(..) >= 2 then user end)."""
    j = _orders_with_study(spark, sf)
    valid = (F.col("s1") + F.col("s2") + F.col("s3") + F.col("s4")) >= 2
    return j.groupBy("o_orderpriority").agg(
        F.count_distinct(F.when(valid, F.col("o_custkey"))).alias("term_valid_num"))


def inner_joins(spark, sf):
    """Inner joins on one key (customer) and two keys (order, status); lineitem is
    pre-aggregated on the join keys before it is shuffled."""
    li = (_t(spark, sf, "lineitem", "l_orderkey", "l_linestatus", "l_quantity")
          .groupBy("l_orderkey", "l_linestatus")
          .agg(F.count(F.lit(1)).alias("n"), F.sum(money("l_quantity")).alias("q")))
    o = _t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    c = _t(spark, sf, "customer", "c_custkey", "c_mktsegment")
    j = (li.join(o, (li.l_orderkey == o.o_orderkey) & (li.l_linestatus == o.o_orderstatus))
         .join(c, F.col("o_custkey") == c.c_custkey))
    return j.groupBy("c_mktsegment", "o_orderpriority").agg(
        F.sum("n").alias("n_lines"), F.sum("q").cast("double").alias("sum_qty"))


def conditional_count_distinct(spark, sf):
    """Customers of each priority, those with an order still open, and those with an order above
    200,000: one row per (priority, customer) with flags, then sums; no Expand."""
    o = _t(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    each = o.where("o_custkey IS NOT NULL").groupBy("o_orderpriority", "o_custkey").agg(
        F.max((F.col("o_orderstatus") != "F").cast("long")).alias("still_open"), F.max((F.col("o_totalprice") > 200000).cast("long")).alias("large"))
    return each.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("customers"), F.coalesce(F.sum("still_open"), F.lit(0)).alias("with_open"),
                                               F.coalesce(F.sum("large"), F.lit(0)).alias("with_large"))


def conditional_sum(spark, sf):
    """sum(case when .. then x else null end) per group."""
    o = _t(spark, sf, "orders", "o_orderpriority", "o_orderstatus", "o_totalprice")
    p = money("o_totalprice")
    return o.groupBy("o_orderpriority").agg(
        total(p).alias("total_fee"),
        total(F.when(F.col("o_orderstatus") == "F", p)).alias("finished_fee"),
        total(F.when(F.col("o_orderstatus") != "F", p)).alias("open_fee"))


def month_report(spark, sf):
    """W7+W19: per month, what customers paid on the first day they ever ordered, later, and from
    which segment; orders are summed per (customer, day) before a customer's first day is looked up."""
    o = _t(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    daily = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).alias("paid"), F.count(F.lit(1)).alias("n"))
    start = o.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("start"))
    machines = _t(spark, sf, "customer", "c_custkey", "c_mktsegment").where(F.col("c_mktsegment") == "MACHINERY").select("c_custkey").distinct()
    j = daily.join(start, "o_custkey", "left").join(machines, F.col("o_custkey") == F.col("c_custkey"), "left")
    opening = F.col("day") == F.col("start")
    return j.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.sum("n").alias("orders"), total(F.col("paid")).alias("revenue"), total(F.when(opening, F.col("paid"))).alias("opening_revenue"),
        total(F.when(F.col("c_custkey").isNotNull(), F.col("paid"))).alias("machinery_revenue"))


def two_level_agg(spark, sf):
    """Customers per (day, priority, region): an inner row per customer with flags, then counts.
    One shuffle by the inner keys; flags are maxima, so there is neither explode nor Expand."""
    o = _with_city(spark, sf, _orders_with_study(spark, sf))
    lines = F.col("s1") + F.col("s2") + F.col("s3") + F.col("s4")
    keys = ["day", "priority", "region"]
    inner = (o.select(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority"), F.col("city_level").alias("region"),
                      "o_custkey", (F.col("o_orderstatus") == "F").cast("long").alias("done"), (lines >= 2).cast("long").alias("two"))
             .groupBy(*keys, "o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("done").alias("done"), F.max("two").alias("two")))
    return inner.groupBy(*keys).agg(F.count(F.lit(1)).alias("customers"), F.sum((F.col("n") > 1).cast("long")).alias("with_several_orders"),
                                    F.sum("done").alias("with_finished_order"), F.sum("two").alias("with_two_matching_lines"))


def _first_days(o: DataFrame) -> DataFrame:
    """One row per customer, pre-reduced by the map side: what its first order is (by date, then key)."""
    return (o.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("m"))
            .select(F.col("o_custkey").alias("customer"), F.col("m.o_orderdate").alias("first_ts"), F.col("m.o_orderkey").alias("first_key")))


def first_order_customers(spark, sf):
    """Customers of each priority, those with an order still open, those with an order above 200,000, those whose first order has
    that priority, and those with a later or a finished order in it: one row per (priority, customer) with flags and its smallest and
    largest order, which tell with the customer's first order whether that is among them; then sums. No Expand, no join of all orders."""
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice").where("o_custkey IS NOT NULL")
    place = F.struct("o_orderdate", "o_orderkey")
    each = o.groupBy("o_orderpriority", "o_custkey").agg(
        F.max((F.col("o_orderstatus") != "F").cast("long")).alias("still_open"), F.max((F.col("o_totalprice") > 200000).cast("long")).alias("large"),
        F.max((F.col("o_orderstatus") == "F").cast("long")).alias("finished"), F.min(place).alias("lo"), F.max(place).alias("hi"))
    j = each.join(_first_days(o), F.col("o_custkey") == F.col("customer"))
    start = F.struct(F.col("first_ts").alias("o_orderdate"), F.col("first_key").alias("o_orderkey"))
    later = (F.col("hi") > start) | (F.col("finished") == 1)
    return j.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("customers"), F.coalesce(F.sum("still_open"), F.lit(0)).alias("with_open"), F.coalesce(F.sum("large"), F.lit(0)).alias("with_large"),
        F.sum((F.col("lo") == start).cast("long")).alias("newcomers"), F.sum(F.coalesce(later, F.lit(False)).cast("long")).alias("with_later_or_finished"))


def opening_month_report(spark, sf):
    """W7+W19: per month, what customers paid on the first day they ever ordered, later, and from which segment and how urgently;
    orders are summed per (customer, day, urgent) before a customer's first day is looked up."""
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    daily = (o.groupBy("o_custkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").like("%URGENT%").alias("urgent"))
             .agg(F.sum(money("o_totalprice")).alias("paid"), F.count(F.lit(1)).alias("n")))
    start = _first_days(o).select("customer", F.to_date("first_ts").alias("start"))
    machines = _t(spark, sf, "customer", "c_custkey", "c_mktsegment").where(F.col("c_mktsegment") == "MACHINERY").select("c_custkey").distinct()
    j = daily.join(start, F.col("o_custkey") == F.col("customer"), "left").join(machines, F.col("o_custkey") == F.col("c_custkey"), "left")
    opening, machinery = F.col("day") == F.col("start"), F.col("c_custkey").isNotNull()
    return j.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.sum("n").alias("orders"), total(F.col("paid")).alias("revenue"), total(F.when(opening, F.col("paid"))).alias("opening_revenue"),
        total(F.when(machinery, F.col("paid"))).alias("machinery_revenue"),
        total(F.when(F.col("day") != F.col("start"), F.col("paid"))).alias("returning_revenue"),
        total(F.when(opening & ~F.col("urgent") & machinery, F.col("paid"))).alias("opening_machinery_revenue"),
        total(F.when(opening & ~F.col("urgent") & ~machinery, F.col("paid"))).alias("opening_other_revenue"),
        total(F.when(opening & F.col("urgent"), F.col("paid"))).alias("opening_urgent_revenue"))


def two_level_union(spark, sf):
    """An outer aggregate per (day, priority, region) over the union of two inner ones: customers by what their orders are, and customers
    whose first order has two matching lines. One row per customer and keys with flags (maxima) comes before both branches, and the customer's
    first order is looked up for that row; no explode, no Expand."""
    o = _with_city(spark, sf, _orders_with_study(spark, sf))
    lines = F.col("s1") + F.col("s2") + F.col("s3") + F.col("s4")
    keys = ["day", "priority", "region"]
    place = F.struct("o_orderdate", "o_orderkey")
    each = (o.select(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority"), F.col("city_level").alias("region"),
                     "o_custkey", "o_orderdate", "o_orderkey", (F.col("o_orderstatus") == "F").cast("long").alias("done"), (lines >= 2).cast("long").alias("two"))
            .groupBy(*keys, "o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("done").alias("done"), F.max("two").alias("two"),
                                             F.min(F.struct("o_orderdate", "o_orderkey", "two")).alias("lo"), F.max(place).alias("hi")))
    firsts = _first_days(_t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate"))
    j = each.join(firsts, F.col("o_custkey") == F.col("customer"), "left")
    opens = F.coalesce(F.col("lo.o_orderkey") == F.col("first_key"), F.lit(False))
    later = (F.col("done") == 1) | (F.col("n") > 1) | ~opens
    visits = j.groupBy(*keys).agg(F.count(F.lit(1)).alias("customers"), F.sum((F.col("n") > 1).cast("long")).alias("with_several_orders"),
                                  F.sum("done").alias("with_finished_order"), F.sum("two").alias("with_two_matching_lines"),
                                  F.sum(opens.cast("long")).alias("newcomers"), F.sum(later.cast("long")).alias("with_later_or_finished"),
                                  F.lit(0).cast("long").alias("newcomers_with_two_lines"))
    starts = j.where(opens).groupBy(*keys).agg(*[F.lit(0).cast("long").alias(c) for c in visits.columns[3:-1]],
                                               F.sum("lo.two").alias("newcomers_with_two_lines"))
    return visits.unionByName(starts).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in visits.columns[3:]])


def union_all_branches(spark, sf):
    """Four top-level branches, the first two each over an inner union."""
    o = _t(spark, sf, "orders", "o_orderpriority", "o_orderstatus")
    li = _t(spark, sf, "lineitem", "l_returnflag", "l_linestatus")
    ev = _t(spark, sf, "events", "event_type")
    cu = _t(spark, sf, "customer", "c_mktsegment")

    def cnt(df, src, k):
        return df.groupBy(F.lit(src).alias("src"), F.col(k).alias("k")).agg(F.count(F.lit(1)).alias("n"))

    b1 = (cnt(o.where(F.col("o_orderstatus") == "F"), "orders", "o_orderpriority")
          .unionAll(cnt(o.where(F.col("o_orderstatus") != "F"), "orders", "o_orderpriority"))
          .groupBy("src", "k").agg(F.sum("n").alias("n")))
    b2 = (cnt(li.where(F.col("l_linestatus") == "F"), "lineitem", "l_returnflag")
          .unionAll(cnt(li.where(F.col("l_linestatus") != "F"), "lineitem", "l_returnflag"))
          .groupBy("src", "k").agg(F.sum("n").alias("n")))
    return b1.unionAll(b2).unionAll(cnt(ev, "events", "event_type")).unionAll(cnt(cu, "customer", "c_mktsegment"))


def union_distinct_ctas(spark, sf):
    """Create table .. as select .. union select .. union select ..; the table is
    written to the shared folder and read back."""
    k = (_t(spark, sf, "customer", F.col("c_nationkey").alias("k"))
         .union(_t(spark, sf, "supplier", F.col("s_nationkey").alias("k")))
         .union(_t(spark, sf, "supplier", F.col("s_nationkey").alias("k"))).distinct())
    path = scratch_path(spark, "ctas")
    k.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def nested_collect_struct(spark, sf):
    """collect_set(named_struct(..)) per user over an inner (user, sku) aggregate with
    sum, count(*) and a decimal(20,2) cast; the set is shown sorted as text."""
    li = _t(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey")
    d = (li.where((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")) & (F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp")))
         .join(o, F.col("l_orderkey") == F.col("o_orderkey")))
    inner = d.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("sku_id")).agg(
        F.sum("l_quantity").cast("long").alias("sku_num"), F.count(F.lit(1)).alias("order_count"),
        F.sum(money("l_extendedprice")).cast("decimal(20,2)").alias("order_amount"))
    s = F.struct("sku_id", "sku_num", "order_count", "order_amount")
    outer = inner.groupBy("user_id").agg(F.array_sort(F.collect_set(s)).alias("order_stats"))
    show = F.transform("order_stats", lambda x: F.concat_ws(":", *[x[c].cast("string") for c in
                                                                  ("sku_id", "sku_num", "order_count", "order_amount")]))
    return outer.select("user_id", F.array_join(show, ";").alias("order_stats"))


def partition_overwrite(spark, sf):
    """Dynamic partition overwrite. All years are written, then year 1999 is written
    again with other numbers; the other partitions must stay as they were."""
    o = _t(spark, sf, "orders", "o_orderdate", "o_orderpriority", "o_orderstatus")
    dt = F.date_format("o_orderdate", "yyyy").alias("dt")
    path = scratch_path(spark, "dyn")
    (o.groupBy(dt, "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path))
    (o.where((F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp")) & (F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp")) & (F.col("o_orderstatus") == "F"))
     .groupBy(dt, "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path))
    r = spark.read.parquet(path)
    return r.select(F.col("dt").cast("string").alias("dt"), "o_orderpriority", "n")


def orc_roundtrip(spark, sf):
    """Snappy-compressed ORC sink, read back."""
    li = _t(spark, sf, "lineitem", "l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    path = scratch_path(spark, "orc")
    li.write.mode("overwrite").format("orc").option("compression", "snappy").save(path)
    r = spark.read.orc(path)
    return r.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("l_quantity")).cast("double").alias("sum_qty"))


def case_tiering(spark, sf):
    """CASE .. IN (..) tiers, grouped by the CASE expression."""
    c = _t(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    n = _t(spark, sf, "nation", "n_nationkey", "n_name")
    name = F.col("n_name")
    tier = (F.when(name.isin(*TIER_1), "tier1").when(name.isin(*TIER_2), "tier2")
            .when(name.isin(*TIER_3), "tier3").otherwise("other"))
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return j.groupBy(tier.alias("city_level")).agg(
        F.count(F.lit(1)).alias("n_customers"), total(money("c_acctbal")).alias("total_acctbal"))


def sum_of_differences(spark, sf):
    """sum(a) - sum(b) - sum(c) - sum(d) grouped by five keys."""
    e = _t(spark, sf, "events", "ts", "user_id", "event_type", "value", "props")
    v = money("value")
    keys = [F.to_date("ts").alias("dt"), (F.hour("ts") % 4).alias("hr"), "user_id", "event_type",
            (F.get_json_object("props", "$.k").cast("int") % 3).alias("kb")]
    diff = (F.sum(v) - F.sum(F.when(F.col("event_type") == "error", v).otherwise(0))
            - F.sum(F.when(F.col("event_type") == "click", v).otherwise(0))
            - F.sum(F.when(F.col("value") < 5, v).otherwise(0)))
    return e.groupBy(*keys).agg(diff.cast("double").alias("term_valid_num"))


def conditional_predicate(spark, sf):
    """if(dt = run date, data_date <= dt, data_date = date_sub(dt, 7)) as a filter."""
    e = _t(spark, sf, "events", "ts", "user_id", "event_type")
    dt = F.to_date("ts")
    e = e.select(dt.alias("dt"), F.date_sub(dt, (F.col("user_id") % 10).cast("int")).alias("data_date"), "event_type")
    cond = (F.when(F.col("dt") == F.lit(EVENTS_RUN_DATE).cast("date"), F.col("data_date") <= F.col("dt"))
            .otherwise(F.col("data_date") == F.date_sub("dt", 7)))
    return e.where(cond).groupBy("dt", "event_type").agg(F.count(F.lit(1)).alias("n"))


def predicates_scalars(spark, sf):
    """W18+W19: the predicate and scalar-function set of the sample scripts."""
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
           "o_orderdate", "o_orderpriority")
    pr = F.col("o_orderpriority")
    cond = ((pr != "5-LOW") & F.col("o_orderstatus").isin("F", "O") & ~F.col("o_custkey").isin(1, 2, 3)
            & F.col("o_totalprice").between(1000, 400000)
            & (pr.like("1%") | ~pr.like("%MEDIUM%")) & F.col("o_orderdate").isNotNull()
            & (F.col("o_totalprice") >= 1500) & (F.col("o_totalprice") <= 450000))
    d = F.to_date("o_orderdate")
    return o.where(cond).select(
        "o_orderkey",
        F.coalesce(F.lit(None).cast("int"), F.lit(0)).alias("nvl_zero"),
        d.alias("d"), F.date_sub(d, 1).alias("prev_d"),
        F.substring(pr, 1, 1).alias("p1"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_f"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.lit(None).cast("string").alias("empty_col"), F.lit("66").alias("const_col"))


def run_date_param(spark, sf, task_date: str = RUN_DATE):
    """The run date as a named SQL parameter (never pasted into the text)."""
    orders = _t(spark, sf, "orders", "o_orderdate", "o_orderpriority", "o_totalprice")
    return spark.sql(
        """SELECT o_orderpriority, count(*) AS n_orders,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) AS total
           FROM {orders}
           WHERE to_date(o_orderdate) BETWEEN date_sub(to_date(:task_date), 32)
                                          AND date_sub(to_date(:task_date), 1)
           GROUP BY o_orderpriority""", args={"task_date": task_date}, orders=orders)


@F.pandas_udf(StringType())
def url_host(url: pd.Series) -> pd.Series:
    """A vectorised (Arrow-batched) UDF, registered for SQL use."""
    return url.str.extract(r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)", expand=False).fillna("")


def udf_surface(spark, sf):
    """UDF registration surface: spark.udf.register + use from SQL."""
    spark.udf.register("url_host", url_host)
    pages = _t(spark, sf, "pages", "url")
    return spark.sql("SELECT url_host(url) AS host, count(*) AS n FROM {pages} GROUP BY url_host(url)",
                     pages=pages)


def _as_text(fn):
    """Registered form of a job: dates shown as ISO text and decimals as plain text, so the
    oracle compare does not depend on how each engine hands such values to the client."""
    def run(spark, sf):
        df = fn(spark, sf)
        cols = []
        for f in df.schema.fields:
            if isinstance(f.dataType, DateType):
                cols.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
            elif isinstance(f.dataType, DecimalType):
                cols.append(F.col(f.name).cast("string").alias(f.name))
            else:
                cols.append(F.col(f.name))
        return df.select(*cols)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {f.__name__: _as_text(f) for f in (
    first_row_per_key, dim_dedup_left_join, multi_key_left_joins, if_arithmetic, inner_joins,
    conditional_count_distinct, conditional_sum, month_report, two_level_agg,
    first_order_customers, opening_month_report, two_level_union, union_all_branches,
    union_distinct_ctas, nested_collect_struct, partition_overwrite, orc_roundtrip, case_tiering,
    sum_of_differences, conditional_predicate, predicates_scalars, run_date_param, udf_surface)}
