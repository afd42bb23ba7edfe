"""One-hot and ordinal encoding, binning and imputation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import bins as B
from ..operators import encode as E
from ..operators.columns import schema_report
from ..operators.impute import Impute, column_roles, impute_by_role
from . import query

# fixed values: the levels of the order priority, in order
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def orders(t):
    return t.orders.select("o_orderkey", "o_orderpriority")


ONE_HOT = """(o_orderpriority = '1-URGENT')::int as o_orderpriority_1_urgent,
   (o_orderpriority = '2-HIGH')::int as o_orderpriority_2_high,
   (o_orderpriority = '3-MEDIUM')::int as o_orderpriority_3_medium,
   (o_orderpriority = '4-NOT SPECIFIED')::int as o_orderpriority_4_not_specified,
   (o_orderpriority = '5-LOW')::int as o_orderpriority_5_low"""


@query("one_hot", f"select o_orderkey, {ONE_HOT} from orders")
def _(t):
    o = orders(t)
    return E.OneHot(["o_orderpriority"]).fit(o).transform(o)


@query(
    "one_hot_drop_first",
    """select c_custkey, (c_mktsegment = 'BUILDING')::int as c_mktsegment_building,
              (c_mktsegment = 'FURNITURE')::int as c_mktsegment_furniture,
              (c_mktsegment = 'HOUSEHOLD')::int as c_mktsegment_household,
              (c_mktsegment = 'MACHINERY')::int as c_mktsegment_machinery from customer""",
)
def _(t):
    c = t.customer.select("c_custkey", "c_mktsegment")
    return E.OneHot(["c_mktsegment"], drop_first=True).fit(c).transform(c)


@query("one_hot_check", "select 1 as min_sum, 1 as max_sum, count(*) as total from orders")
def _(t):
    o = orders(t)
    enc = E.OneHot(["o_orderpriority"]).fit(o)
    return E.check_one_hot(enc.transform(o), enc.column_names())


@query(
    "ordered_levels",
    """select o_orderkey, rank_no, rank_no >= 2 as at_least_medium from (
         select o_orderkey, case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2
                when '4-NOT SPECIFIED' then 3 end as rank_no from orders)""",
)
def _(t):
    known = PRIORITIES[:4]
    return orders(t).select(
        "o_orderkey",
        E.ordinal("o_orderpriority", known).alias("rank_no"),
        E.at_least("o_orderpriority", "3-MEDIUM", known).alias("at_least_medium"),
    )


@query(
    "ordered_level_filter",
    """select o_orderkey, o_orderpriority from orders
       where o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')""",
)
def _(t):
    return orders(t).filter(E.at_least("o_orderpriority", "3-MEDIUM", PRIORITIES))


@query(
    "category_codes",
    """select c_custkey, c_mktsegment, case c_mktsegment when 'AUTOMOBILE' then 0 when 'BUILDING' then 1
          when 'FURNITURE' then 2 when 'HOUSEHOLD' then 3 else 4 end as c_mktsegment_code from customer""",
)
def _(t):
    c = t.customer.select("c_custkey", "c_mktsegment")
    return E.CategoryCodes(["c_mktsegment"]).fit(c).transform(c)


@query(
    "dictionary_codes",
    """select l_orderkey, l_linenumber, l_partkey, dense_rank() over (order by l_partkey) - 1 as l_partkey_code,
              dense_rank() over (order by l_returnflag) - 1 as l_returnflag_code from lineitem""",
)
def _(t):
    """Codes of any number of levels, by a join with a table of levels."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return E.DictionaryCodes(["l_partkey", "l_returnflag"]).fit(lines).transform(lines).drop("l_returnflag")


@query(
    "sparse_one_hot",
    """select l_orderkey, l_linenumber, l_partkey, (dense_rank() over (order by l_returnflag) - 1) || ' '
              || (dense_rank() over (order by l_orderkey) - 1 + (select count(distinct l_returnflag) from lineitem)) as places from lineitem""",
)
def _(t):
    """The places of each row's ones among 0/1 columns for all levels of two columns."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    found = E.DictionaryCodes(["l_returnflag", "l_orderkey"]).fit(lines).sparse(lines).drop("l_returnflag")
    return found.withColumn("places", F.array_join("places", " "))


@query(
    "cut_fixed",
    """select l_orderkey, l_linenumber, l_quantity, case when l_quantity > 1 and l_quantity <= 10 then 'few'
         when l_quantity > 10 and l_quantity <= 30 then 'some' when l_quantity > 30 and l_quantity <= 45 then 'many'
         end as size from lineitem""",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return B.cut(lines, "l_quantity", [1, 10, 30, 45], ["few", "some", "many"], out="size")


@query(
    "cut_to_max",
    """select s_suppkey, case when s_acctbal > 0 and s_acctbal <= 4000 then 'low'
          when s_acctbal > 4000 and s_acctbal <= 8000 then 'mid'
          when s_acctbal > 8000 and s_acctbal <= (select max(s_acctbal) from supplier) then 'top' end as class
       from supplier""",
)
def _(t):
    cut = B.cut(t.supplier, "s_acctbal", [0, 4000, 8000, "max"], ["low", "mid", "top"], out="class")
    return cut.select("s_suppkey", "class")


@query(
    "cut_equal_width",
    """select p_partkey, bin, cast(round_even((lo + bin * w - (case when bin = 0 then (hi - lo) * 0.001 else 0 end)
                + lo + (bin + 1) * w) / 2, 0) as int) as bin_mid
       from (select p_partkey, lo, hi, (hi - lo) / 7 as w,
               ((x > lo + 1 * ((hi - lo) / 7))::int + (x > lo + 2 * ((hi - lo) / 7))::int
              + (x > lo + 3 * ((hi - lo) / 7))::int + (x > lo + 4 * ((hi - lo) / 7))::int
              + (x > lo + 5 * ((hi - lo) / 7))::int + (x > lo + 6 * ((hi - lo) / 7))::int) as bin
             from (select p_partkey, p_retailprice as x from part),
                  (select min(p_retailprice) as lo, max(p_retailprice) as hi from part))""",
)
def _(t):
    return B.cut_equal(t.part, "p_retailprice", 7, out="bin").select("p_partkey", "bin", "bin_mid")


QCUT = """select o_orderkey, case when o_totalprice <= a then 0 when o_totalprice <= b then 1
   when o_totalprice <= c then 2 else 3 end as price_q from orders,
   (select quantile_cont(o_totalprice, 0.25) a, quantile_cont(o_totalprice, 0.5) b,
           quantile_cont(o_totalprice, 0.75) c from orders)"""


@query("cut_quantiles", QCUT)
def _(t):
    return B.qcut(t.orders, "o_totalprice", 4, out="price_q").select("o_orderkey", "price_q")


def both_bins(t):
    """Every order with its exact and its approximate bin."""
    exact = B.qcut(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 4, out="exact_q")
    return B.qcut(exact, "o_totalprice", 4, out="price_q", approx=True)


def bins_compared(both):
    """Rows per exact bin, and whether the approximate edges move at most a thousandth of all rows."""
    moved = F.count_if(F.col("exact_q") != F.col("price_q"))
    found = both.groupBy("exact_q").agg(F.count(F.lit(1)).alias("n_exact"), moved.alias("moved"))
    every = F.sum("n_exact").over(Window.partitionBy())
    return found.select("exact_q", "n_exact", (F.col("moved") * 1000 <= every).alias("within"))


@query("cut_quantiles_approx")
def _(t):
    """Every row with its approximate bin, next to the exact one, the rows of that and whether both cuts agree."""
    both = both_bins(t)
    compared = bins_compared(both).withColumnRenamed("exact_q", "_bin")
    out = both.join(F.broadcast(compared), F.col("exact_q").eqNullSafe(F.col("_bin")))
    return out.select("o_orderkey", "o_totalprice", "price_q", "exact_q", "n_exact", "within")


@query(
    "cut_quantiles_approx_gap",
    f"""select price_q, count(*) as n_exact, true as within from ({QCUT}) group by 1""",
)
def _(t):
    return bins_compared(both_bins(t)).withColumnRenamed("exact_q", "price_q")


@query(
    "decade",
    """select o_orderkey, case when y > 1989 and y <= 1999 then 1990 when y > 1999 and y <= 2009 then 2000 end
          as by_edges, (y // 10 * 10)::int as by_number from (select o_orderkey, year(o_orderdate) as y from orders)""",
)
def _(t):
    o = t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"))
    return o.select(
        "o_orderkey",
        B.bin_label("y", [1989, 1999, 2009], [1990, 2000]).alias("by_edges"),
        B.decade("y").alias("by_number"),
    )


@query(
    "above_median",
    """select o_orderkey, (o_totalprice > (select quantile_cont(o_totalprice, 0.5) from orders))::int as target
       from orders""",
)
def _(t):
    return B.above_median(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice").drop("o_totalprice")


def gappy_orders(t):
    k = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        F.when(k % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.when(k % 5 != 0, F.col("o_orderpriority")).alias("grade"),
        F.when(k % 3 != 0, F.month("o_orderdate")).alias("month_opened"),
        F.when(k % 2 != 0, 1).alias("flag_f"),
    )


GAPPY = """gaps as (select o_orderkey, case when o_orderkey % 7 <> 0 then o_totalprice end as price,
     case when o_orderkey % 5 <> 0 then o_orderpriority end as grade,
     case when o_orderkey % 3 <> 0 then month(o_orderdate)::int end as month_opened,
     case when o_orderkey % 2 <> 0 then 1 end as flag_f from orders),
   top_grade as (select grade from gaps where grade is not null group by 1 order by count(*) desc, 1 limit 1),
   top_month as (select month_opened from gaps where month_opened is not null group by 1
                 order by count(*) desc, 1 limit 1)"""


@query(
    "impute_mode",
    f"with {GAPPY} select o_orderkey, coalesce(grade, (select grade from top_grade)) as grade from gaps",
)
def _(t):
    g = gappy_orders(t).select("o_orderkey", "grade")
    return Impute({"grade": "mode"}).fit(g).transform(g)


@query(
    "impute_mean",
    f"""with {GAPPY} select o_orderkey, round(coalesce(price, (select avg(price) from gaps)), 6) as price
        from gaps""",
)
def _(t):
    g = gappy_orders(t).select("o_orderkey", "price")
    return Impute({"price": "mean"}).fit(g).transform(g).withColumn("price", F.round("price", 6))


@query(
    "impute_by_role",
    f"""with {GAPPY} select o_orderkey, round(coalesce(price, (select avg(price) from gaps)), 6) as price,
          coalesce(grade, (select grade from top_grade)) as grade,
          coalesce(month_opened, (select month_opened from top_month)) as month_opened,
          coalesce(flag_f, 0) as flag_f from gaps""",
)
def _(t):
    g = gappy_orders(t)
    filled = impute_by_role(g, ["flag_"], "o_orderkey").transform(g)
    return filled.withColumn("price", F.round("price", 6))


@query(
    "column_roles",
    f"""with {GAPPY} select column_name, role, filled from
          (select count(price) as a, count(grade) as b, count(month_opened) as c, count(flag_f) as d from gaps),
          lateral (values ('price', 'numeric', a), ('grade', 'categorical', b), ('month_opened', 'date part', c),
                          ('flag_f', 'one-hot', d)) v(column_name, role, filled)""",
)
def _(t):
    """Role of every column next to how many rows it fills."""
    g = gappy_orders(t)
    roles = column_roles(g, ["flag_"], "o_orderkey")
    rows = [(c, "one-hot") for c in roles.one_hot] + [(c, "date part") for c in roles.date_parts]
    rows += [(c, "numeric") for c in roles.numeric] + [(c, "categorical") for c in roles.categorical]
    named = t.spark.createDataFrame(rows, "column_name string, role string")
    filled = schema_report(g).select("column_name", F.col("non_null").alias("filled"))
    return named.join(filled, ["column_name"])
