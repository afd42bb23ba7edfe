"""Joins, keys, grids, unions and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import reshape as S
from ..operators.counts import rounded_mean
from ..operators.ranks import group_rank
from . import query


@query(
    "join_inner",
    """select c_custkey, c_name, c_mktsegment, o_orderkey, o_totalprice
       from customer join orders on c_custkey = o_custkey""",
)
def _(t):
    facts = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return J.spread_join(facts, t.customer.select("c_custkey", "c_name", "c_mktsegment"), ["c_custkey"])


@query(
    "join_using_grouped",
    """select n_name, n as num_customers, sign(s) * ((2 * abs(s) + n) // (2 * n)) / 100.0 as avg_balance
       from (select n_name, count(*) as n, sum(round(c_acctbal * 100)::bigint)::bigint as s
             from customer join nation on c_nationkey = n_nationkey group by 1)""",
)
def _(t):
    # counted per key before the join: a nation is one row in it, however many customers it has
    per_key = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("num_customers"), rounded_mean("c_acctbal").alias("avg_balance")
    )
    joined = per_key.join(t.nation.select("n_nationkey", "n_name"), ["n_nationkey"])
    return joined.select("n_name", "num_customers", "avg_balance")


@query(
    "join_left_same_name",
    """select c_custkey, c_name, n_orders from customer
       left join (select o_custkey as c_custkey, count(*) as n_orders from orders
                  where o_custkey % 3 <> 0 group by 1) using (c_custkey)""",
)
def _(t):
    some = t.orders.filter(F.col("o_custkey") % 3 != 0)
    counted = some.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    return t.customer.select("c_custkey", "c_name").join(counted, ["c_custkey"], "left")


@query(
    "join_left_other_name",
    """select s_suppkey, s_name, n_nationkey, n_name from supplier
       left join (select * from nation where n_regionkey <> 2) on s_nationkey = n_nationkey""",
)
def _(t):
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = t.nation.filter(F.col("n_regionkey") != 2).select("n_nationkey", "n_name")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").drop("s_nationkey")


@query(
    "scenario_grid",
    """select product || ' ' || cast(c_custkey * months as varchar) as label, c_custkey * months as sales
       from customer, (values ('Product A'), ('Product B')) p(product), (values (1), (3), (12)) v(months)""",
)
def _(t):
    base = t.customer.select("c_custkey")
    grid = J.scenario_grid(base, product=["Product A", "Product B"], months=[1, 3, 12])
    sales = F.col("c_custkey") * F.col("months")
    return grid.select(F.concat_ws(" ", "product", sales.cast("string")).alias("label"), sales.alias("sales"))


@query(
    "aligned_ratio",
    """select year, round(f.n / a.n, 9) as ratio from
         (select year(o_orderdate)::int as year, count(*) as n from orders group by 1) a full join
         (select year(o_orderdate)::int as year, count(*) as n from orders
          where o_orderstatus = 'F' and year(o_orderdate) <> 1999 group by 1) f using (year)""",
)
def _(t):
    years = t.orders.withColumn("year", F.year("o_orderdate"))
    every = years.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    some = years.filter((F.col("o_orderstatus") == "F") & (F.col("year") != 1999))
    part = some.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    return J.aligned_ratio(part, every, ["year"], "n").withColumn("ratio", F.round("ratio", 9))


@query(
    "orphan_keys",
    """select l_orderkey, count(*) as n_rows from lineitem
       where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P') group by 1""",
)
def _(t):
    parents = t.orders.filter(F.col("o_orderstatus") != "P").select("o_orderkey")
    return J.orphans(t.lineitem, parents, "l_orderkey", "o_orderkey")


@query(
    "cascade_delete",
    """select o_orderkey, o_custkey from orders
       where o_custkey not in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def _(t):
    deleted = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return J.cascade_delete(t.orders.select("o_orderkey", "o_custkey"), deleted, "o_custkey", "c_custkey")


@query(
    "union_by_name",
    """select c_custkey as id, c_name as name, c_mktsegment as segment, null::int as nation from customer
       union all select s_suppkey, s_name, null, s_nationkey from supplier""",
)
def _(t):
    a = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    b = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return S.union_by_name(a, b)


@query(
    "append_rows",
    "select s_suppkey, s_name from supplier union all select -1, 'Intercept'",
)
def _(t):
    return S.append_rows(t.supplier.select("s_suppkey", "s_name"), [(-1, "Intercept")])


@query(
    "melt",
    """select o_orderkey, 'o_totalprice' as variable, o_totalprice as value from orders
       union all select o_orderkey, 'o_custkey', o_custkey from orders""",
)
def _(t):
    wide = t.orders.select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"))
    return S.melt(wide, ["o_orderkey"], ["o_totalprice", "o_custkey"])


@query(
    "unstack",
    """select o_orderpriority, max(case when o_orderstatus = 'F' then n end) as "F",
              max(case when o_orderstatus = 'O' then n end) as "O" from
       (select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2) group by 1""",
)
def _(t):
    counted = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return S.unstack(counted, ["o_orderpriority"], "o_orderstatus", ["F", "O"], "n")


AVG_RANK = "rank() over (order by {v}) + (count(*) over (partition by {v}) - 1) / 2.0"


@query(
    "global_rank",
    f"select o_orderkey, ({AVG_RANK.format(v='o_totalprice')})::double as rank from orders",
)
def _(t):
    return group_rank(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice").select("o_orderkey", "rank")


@query(
    "group_rank",
    """select event_id, (rank() over (partition by event_type order by value)
          + (count(*) over (partition by event_type, value) - 1) / 2.0)::double as rank from events""",
)
def _(t):
    e = t.events.select("event_id", "event_type", "value")
    return group_rank(e, "value", ["event_type"]).select("event_id", "rank")


@query(
    "group_dense_rank",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag,
              dense_rank() over (partition by l_returnflag order by l_quantity) as place from lineitem""",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    return group_rank(lines, "l_quantity", ["l_returnflag"], "dense", "place")
