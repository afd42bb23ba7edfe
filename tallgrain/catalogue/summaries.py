"""Aggregates, counts, shares and the numbers behind plots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as C
from ..operators import counts as K
from ..operators import describe as D
from ..operators.ranks import exact_quantiles
from ..operators.bins import cut_equal, decade
from ..operators.reshape import melt
from . import query


@query(
    "industry_footprint",
    """select p_type as industry, count(distinct l_suppkey) as num_companies,
              cast(round(sum(l_extendedprice::decimal(18, 2)), 1) as double) as total_footprint
       from lineitem join part on l_partkey = p_partkey
       where l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '1998-01-01'
       group by p_type order by total_footprint desc, industry limit 6""",
)
def _(t):
    """Companies and summed footprint per industry in one year, the six largest."""
    year = F.col("l_shipdate")
    lines = t.lineitem.filter(
        (year >= F.to_timestamp_ntz(F.lit("1997-01-01 00:00:00")))
        & (year < F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00")))
    )
    # first per part and supplier: only these sums meet the part table, so a part that
    # holds a third of the lines is a few rows in the join
    per_part = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s")
    )
    typed = per_part.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    found = (
        typed.groupBy(F.col("p_type").alias("industry"), "l_suppkey")
        .agg(F.sum("s").alias("s"))
        .groupBy("industry")
        .agg(
            F.count("l_suppkey").alias("num_companies"),
            F.round(F.sum("s"), 1).cast("double").alias("total_footprint"),
        )
    )
    return C.top_k(found, "total_footprint", 6, ["industry"])


@query(
    "groups_having_count",
    """select l_suppkey, count(*) as num_rows,
              ((200 * sum(l_quantity::bigint) + count(*)) // (2 * count(*)))::bigint / 100.0 as avg_quantity
       from lineitem group by l_suppkey having count(*) > 4
       order by avg_quantity desc, l_suppkey limit 10""",
)
def _(t):
    found = K.having_more(t.lineitem, ["l_suppkey"], {"avg_quantity": K.rounded_mean("l_quantity")}, 4)
    return C.top_k(found, "avg_quantity", 10, ["l_suppkey"])


@query(
    "column_stats",
    """select round(sum(o_totalprice), 2) as sum, min(o_totalprice) as min, max(o_totalprice) as max,
              count(o_totalprice) as count, round(avg(o_totalprice), 6) as mean,
              round(quantile_cont(o_totalprice, 0.5), 6) as median from orders""",
)
def _(t):
    return D.column_stats(t.orders, "o_totalprice").select(
        F.round("sum", 2).alias("sum"),
        "min",
        "max",
        "count",
        F.round("mean", 6).alias("mean"),
        F.round("median", 6).alias("median"),
    )


@query(
    "idx_extremes",
    """select (select s_suppkey from supplier order by s_acctbal desc, s_suppkey limit 1) as idxmax,
              (select s_suppkey from supplier order by s_acctbal, s_suppkey limit 1) as idxmin""",
)
def _(t):
    return K.idx_extremes(t.supplier, "s_suppkey", "s_acctbal")


@query(
    "n_unique",
    """select count(distinct o_custkey) as o_custkey, count(distinct o_orderstatus) as o_orderstatus,
              count(distinct o_orderpriority) as o_orderpriority from orders""",
)
def _(t):
    return K.n_unique(t.orders, ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("distinct_values", "select distinct p_size from part order by p_size")
def _(t):
    return K.distinct_values(t.part, "p_size")


GAPPY = "(select case when o_orderkey % 10 = 0 then null else o_orderpriority end as grade from orders)"


def gappy_grades(t):
    return t.orders.select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("grade"))


@query("value_counts", f"select grade, count(*) as count from {GAPPY} where grade is not null group by 1")
def _(t):
    return K.value_counts(gappy_grades(t), "grade")


@query("value_counts_with_null", f"select grade, count(*) as count from {GAPPY} group by 1")
def _(t):
    return K.value_counts(gappy_grades(t), "grade", dropna=False)


@query("value_counts_by_key", "select p_size, count(*) as count from part group by 1 order by 1")
def _(t):
    return K.value_counts(t.part, "p_size", by="key")


@query(
    "value_counts_many",
    """select 'o_orderstatus' as column_name, o_orderstatus as value, count(*) as count from orders group by 2
       union all select 'grade', case when o_orderkey % 10 = 0 then null else o_orderpriority end, count(*)
       from orders group by 2""",
)
def _(t):
    grade = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("grade")
    return K.value_counts_all(t.orders.select("o_orderstatus", grade), ["o_orderstatus", "grade"])


@query(
    "top_value",
    """select hour, count(*) as count from (select strftime(ts, '%H') as hour from events)
       group by 1 order by 2 desc, 1 limit 1""",
)
def _(t):
    return K.top_value(t.events.select(F.date_format("ts", "HH").alias("hour")), "hour")


@query(
    "top_in_group",
    """select event_type, user_id, count from (
         select event_type, user_id, count(*) as count,
                row_number() over (partition by event_type order by count(*) desc, user_id) as rn
         from events group by 1, 2) where rn = 1""",
)
def _(t):
    return K.top_in_group(t.events, "event_type", "user_id")


@query(
    "peak_night_area",
    """select area, count(*) as count from (
         select event_type as area, cast(strftime(ts, '%H%M') as int) as n from events)
       where (case when n < 400 then n + 2400 else n end) > 2159 group by 1 order by 2 desc, 1 limit 1""",
)
def _(t):
    from ..functions.dates import past_midnight
    from ..operators.bins import cut

    # fixed values: edges and names of the parts of a day
    edges, names = [359, 959, 1559, 2159, 2759], ["Morning", "Afternoon", "Evening", "Night"]
    clock = F.date_format("ts", "HHmm").cast("int")
    timed = t.events.select(F.col("event_type").alias("area"), past_midnight(clock).alias("n"))
    night = cut(timed, "n", edges, names, out="moment").filter(F.col("moment") == "Night")
    return K.top_value(night, "area")


@query(
    "repeat_winners",
    """select o_custkey, count(*) as count from orders group by 1 having count(*) > 1""",
)
def _(t):
    return K.repeated_values(t.orders, "o_custkey")


@query(
    "count_by_two_keys",
    """select (year(o_orderdate) // 10 * 10)::int as decade, o_orderpriority, count(o_orderkey) as count
       from orders group by 1, 2""",
)
def _(t):
    o = t.orders.select(decade(F.year("o_orderdate")).alias("decade"), "o_orderpriority", "o_orderkey")
    return o.groupBy("decade", "o_orderpriority").agg(F.count("o_orderkey").alias("count"))


@query(
    "share_by_keys",
    """select year(o_orderdate)::int as year, o_orderpriority,
              round(avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end), 9) as share, count(*) as n
       from orders group by 1, 2""",
)
def _(t):
    o = t.orders.withColumn("year", F.year("o_orderdate"))
    found = K.share_by(o, F.col("o_orderstatus") == "F", ["year", "o_orderpriority"])
    return found.withColumn("share", F.round("share", 9))


@query(
    "best_share",
    """select year, o_orderpriority, share from (
         select year(o_orderdate)::int as year, o_orderpriority,
                round(avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end), 9) as share
         from orders group by 1, 2) order by share desc, year, o_orderpriority limit 1""",
)
def _(t):
    o = t.orders.withColumn("year", F.year("o_orderdate"))
    found = K.share_by(o, F.col("o_orderstatus") == "F", ["year", "o_orderpriority"])
    return K.argmax(found.withColumn("share", F.round("share", 9)), "share", ["year", "o_orderpriority"])


@query(
    "crosstab",
    """select p_type, count(*) filter (p_size <= 10) as s, count(*) filter (p_size > 10 and p_size <= 30) as m,
              count(*) filter (p_size > 30) as l from part group by 1""",
)
def _(t):
    from ..operators.bins import cut

    sized = cut(t.part, "p_size", [0, 10, 30, 50], ["s", "m", "l"], out="size_group")
    return K.crosstab(sized, "p_type", "size_group", ["s", "m", "l"])


DESCRIBED = """count(value) as count, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std,
   min(value) as min, round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50,
   round(quantile_cont(value, 0.75), 6) as q75, max(value) as max"""


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query(
    "describe",
    f"""select "column", {DESCRIBED} from
        (unpivot (select l_quantity, l_extendedprice, l_discount from lineitem)
         on l_quantity, l_extendedprice, l_discount into name "column" value value) group by 1""",
)
def _(t):
    found = D.describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(found, ["mean", "std", "q25", "q50", "q75"])


@query(
    "describe_by_group",
    f"""select event_type, 'value' as "column", {DESCRIBED} from events group by 1""",
)
def _(t):
    return rounded(D.describe(t.events, ["value"], ["event_type"]), ["mean", "std", "q25", "q50", "q75"])


@query(
    "collapse_by_key",
    """select l_orderkey, round(avg(l_extendedprice), 6) as l_extendedprice, max(is_returned) as is_returned,
              strftime(min(l_shipdate), '%Y-%m-%d') as l_shipdate,
              min_by(l_partkey, (l_shipdate, l_partkey)) as l_partkey
       from (select *, (l_returnflag = 'R')::int as is_returned from lineitem) group by 1""",
)
def _(t):
    lines = t.lineitem.withColumn("is_returned", (F.col("l_returnflag") == "R").cast("int"))
    found = D.collapse_by_key(
        lines,
        "l_orderkey",
        ["l_extendedprice"],
        ["is_returned"],
        ["l_shipdate"],
        ["l_partkey"],
        ["l_shipdate", "l_partkey"],
    )
    found = found.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return rounded(found, ["l_extendedprice"])


@query(
    "mean_with_interval",
    """select l_linenumber, round(m, 6) as mean, round(m - h, 6) as ci_low, round(m + h, 6) as ci_high, n from (
         select l_linenumber, avg(l_discount) as m, count(*) as n,
                1.959963984540054 * stddev_samp(l_discount) / sqrt(count(*)) as h from lineitem group by 1)""",
)
def _(t):
    return rounded(D.mean_by(t.lineitem, "l_discount", ["l_linenumber"]), ["mean", "ci_low", "ci_high"])


@query("max_by_group", "select p_brand, max(p_retailprice) as top_price from part group by 1")
def _(t):
    return t.part.groupBy("p_brand").agg(F.max("p_retailprice").alias("top_price"))


@query(
    "count_plot",
    """select o_orderstatus, o_orderpriority, year(o_orderdate)::int as year, count(*) as count
       from orders group by all""",
)
def _(t):
    o = t.orders.withColumn("year", F.year("o_orderdate"))
    return K.count_by(o, ["o_orderstatus", "o_orderpriority", "year"])


@query(
    "box_stats",
    """select event_type, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
              round(q3 - q1, 6) as iqr,
              min(value) filter (value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_low,
              max(value) filter (value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_high,
              count(*) filter (not value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as outliers
       from events join (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
                                quantile_cont(value, 0.75) as q3 from events group by 1) using (event_type)
       group by event_type, q1, median, q3""",
)
def _(t):
    return rounded(D.box_stats(t.events, "value", ["event_type"]), ["q1", "median", "q3", "iqr"])


BIN_EDGES = """(select min(value) as lo, max(value) as hi from events)"""


@query(
    "histogram_by_group",
    f"""select event_type, bin, mid, count(*) as count from (
         select event_type, bin, cast(round_even(
                  (lo + bin * w - (case when bin = 0 then (hi - lo) * 0.001 else 0 end) + lo + (bin + 1) * w) / 2, 0)
                  as int) as mid
         from (select event_type, lo, hi, (hi - lo) / 7 as w,
                      ((value > lo + 1 * (hi - lo) / 7)::int + (value > lo + 2 * ((hi - lo) / 7))::int
                     + (value > lo + 3 * ((hi - lo) / 7))::int + (value > lo + 4 * ((hi - lo) / 7))::int
                     + (value > lo + 5 * ((hi - lo) / 7))::int + (value > lo + 6 * ((hi - lo) / 7))::int) as bin
               from events, {BIN_EDGES}))
       group by all""",
)
def _(t):
    binned = cut_equal(t.events, "value", 7, out="bin").withColumnRenamed("bin_mid", "mid")
    return K.count_by(binned, ["event_type", "bin", "mid"])


@query(
    "averaged_tables_difference",
    """select year, l.n_lines, o.n_orders, l.avg_qty, o.avg_price, round(l.avg_qty - o.avg_price, 2) as diff from
         (select year(l_shipdate)::int as year, count(*) as n_lines, ((200 * sum(l_quantity::bigint) + count(*)) // (2 * count(*)))::bigint / 100.0 as avg_qty
          from lineitem group by 1) l join
         (select year(o_orderdate)::int as year, count(*) as n_orders, ((2 * sum(round(o_totalprice * 100)::bigint) + 1000 * count(*)) // (2000 * count(*)))::bigint / 100.0 as avg_price
          from orders group by 1) o using (year)
       where avg_qty > 25.4 or avg_price > 120 order by year""",
)
def _(t):
    lines = t.lineitem.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n_lines"), K.rounded_mean("l_quantity").alias("avg_qty")
    )
    orders = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        K.rounded_mean("o_totalprice", per=1000).alias("avg_price"),
    )
    both = lines.join(orders, ["year"]).filter((F.col("avg_qty") > 25.4) | (F.col("avg_price") > 120))
    return both.withColumn("diff", F.round(F.col("avg_qty") - F.col("avg_price"), 2)).orderBy("year")


PROFILED = ["l_orderkey", "l_suppkey", "l_quantity", "l_returnflag"]


def profile_compared(t):
    """The profile, with the exact distinct count and whether the approximate one is within a tenth of it."""
    exact = t.lineitem.agg(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("n_distinct")) for c in PROFILED]).alias("x")
    ).select(F.inline("x"))
    both = D.approx_profile(t.lineitem, PROFILED).join(exact, "column_name")
    gap = F.abs(F.col("approx_distinct") - F.col("n_distinct"))
    return both.withColumn("within", gap * 10 <= F.col("n_distinct"))


@query("approx_profile")
def _(t):
    """The profile with its approximate distinct counts, next to the exact ones and whether they agree."""
    return profile_compared(t).select(
        "column_name", "approx_distinct", "n_distinct", "within", "non_null", "smallest", "largest"
    )


@query(
    "approx_profile_gap",
    " union all ".join(
        f"""select '{c}' as column_name, count(distinct {c}) as n_distinct, true as within, count({c}) as non_null,
                   min({c})::varchar as smallest, max({c})::varchar as largest from lineitem"""
        for c in PROFILED
    ),
)
def _(t):
    return profile_compared(t).select("column_name", "n_distinct", "within", "non_null", "smallest", "largest")


@query(
    "quantiles_of_large_integers",
    """with v as (select o_orderstatus, 9007199254740993 + o_orderkey * 7 + o_custkey as x from orders),
       r as (select *, row_number() over (partition by o_orderstatus order by x) - 1 as place,
               count(*) over (partition by o_orderstatus) as n from v),
       p as (select o_orderstatus, n, prob, floor((n - 1) * prob)::bigint as low, (n - 1) * prob - floor((n - 1) * prob) as part
             from (select distinct o_orderstatus, n from r), (select unnest([0.1, 0.25, 0.5, 0.9]::double[]) as prob))
       select p.o_orderstatus, prob, (a.x + ((b.x - a.x) * part::decimal(10,9)))::decimal(38,6)::varchar as quantile
       from p join r a on a.o_orderstatus = p.o_orderstatus and a.place = low
              join r b on b.o_orderstatus = p.o_orderstatus and b.place = least(low + 1, p.n - 1)""",
)
def _(t):
    """Integers above 2^53, whose quantiles as doubles would be off."""
    large = (F.lit(9007199254740993) + F.col("o_orderkey") * 7 + F.col("o_custkey")).alias("x")
    found = exact_quantiles(t.orders.select("o_orderstatus", large), ["x"], [0.1, 0.25, 0.5, 0.9], ["o_orderstatus"], decimal=True)
    return found.select("o_orderstatus", "prob", F.col("quantile").cast("string").alias("quantile"))


@query(
    "mean_median_by_moment",
    """select o_orderstatus, moment, round(avg(score), 6) as mean, round(quantile_cont(score, 0.5), 6) as median
       from (select o_orderstatus, 'pre' as moment, o_totalprice as score from orders
             union all select o_orderstatus, 'post', o_totalprice + o_custkey from orders) group by 1, 2""",
)
def _(t):
    wide = t.orders.select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_totalprice").alias("pre"),
        (F.col("o_totalprice") + F.col("o_custkey")).alias("post"),
    )
    long = melt(wide, ["o_orderkey", "o_orderstatus"], ["pre", "post"], "moment", "score")
    return rounded(D.mean_median_by(long, "score", ["o_orderstatus", "moment"]), ["mean", "median"])


@query(
    "quantiles_by_group",
    " union all ".join(
        f"""select event_type, 'value' as "column", {p}::double as prob,
                   round(quantile_cont(value, {p}), 6) as quantile from events group by 1"""
        for p in (0.1, 0.5, 0.9)
    ),
)
def _(t):
    from ..operators.ranks import exact_quantiles

    return rounded(exact_quantiles(t.events, ["value"], [0.1, 0.5, 0.9], ["event_type"]), ["quantile"])
