"""Cleaning and recoding of values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as fd
from ..functions import text as ft
from ..operators import dateparts as P
from ..operators import recode as R
from ..operators import reshape as S
from ..sources.synth import sample_with_ids
from . import query


def date_text(t):
    """Order dates as text with a time behind them; every eleventh is no date."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")
    return t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, text).otherwise("unknown").alias("opened")
    )


DATE_TEXT = """(select o_orderkey, case when o_orderkey % 11 <> 0
   then strftime(o_orderdate, '%Y-%m-%dT%H:%M') else 'unknown' end as opened from orders)"""


@query("date_from_text", f"select o_orderkey, strftime(try_cast(substr(opened, 1, 10) as date), '%d.%m.%Y') as opened from {DATE_TEXT}")
def _(t):
    dated = P.to_date10(date_text(t), ["opened"])
    return dated.withColumn("opened", F.date_format("opened", "dd.MM.yyyy"))


@query(
    "date_by_pattern",
    "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders",
)
def _(t):
    text = F.date_format("o_orderdate", "dd/MM/yyyy")
    day = fd.parse_date(text, "dd/MM/yyyy")
    return t.orders.select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"))


@query(
    "date_parts",
    f"""select o_orderkey, day(d)::int as day_opened, month(d)::int as month_opened, year(d)::int as year_opened
        from (select o_orderkey, try_cast(substr(opened, 1, 10) as date) as d from {DATE_TEXT})""",
)
def _(t):
    dated = P.to_date10(date_text(t), ["opened"]).withColumn("closed", F.lit(None).cast("date"))
    return P.date_parts(dated, ["opened", "closed"])


@query(
    "month_and_weekday",
    """select o_orderkey, month(o_orderdate)::int as month_value, (isodow(o_orderdate) - 1)::int as weekday
       from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.month("o_orderdate").alias("month_value"),
        fd.weekday("o_orderdate").alias("weekday"),
    )


@query(
    "percent_to_double",
    """select l_orderkey, l_linenumber, try_cast(replace(trim(rate), '%', '') as double) as rate from
       (select *, case when l_orderkey % 13 = 0 then 'n/a' else ' ' || cast((l_discount * 100)::int as varchar) || '%' end
          as rate from lineitem)""",
)
def _(t):
    text = F.when(F.col("l_orderkey") % 13 == 0, "n/a").otherwise(
        F.format_string(" %d%%", F.round(F.col("l_discount") * 100).cast("int"))
    )
    return R.clean_percent(t.lineitem.select("l_orderkey", "l_linenumber", text.alias("rate")), "rate")


@query(
    "term_to_months",
    """select o_orderkey, try_cast(nullif(regexp_extract(term, '([0-9]+)', 1), '') as int) as term_in_months from
       (select o_orderkey, case o_orderkey % 3 when 0 then ' 36 months' when 1 then '60 months' else 'open' end
          as term from orders)""",
)
def _(t):
    k = F.col("o_orderkey") % 3
    term = F.when(k == 0, " 36 months").when(k == 1, "60 months").otherwise("open")
    return R.term_to_months(t.orders.select("o_orderkey", term.alias("term")), "term")


@query(
    "normalize_text",
    "select doc_id, replace(strip_accents(lower(text)), ' ', '_') as text from documents",
)
def _(t):
    return t.documents.select("doc_id", ft.normalize_text("text").alias("text"))


@query(
    "trim_values",
    "select o_orderkey, trim(' ' || o_orderpriority || '  ') as grade from orders",
)
def _(t):
    padded = F.concat(F.lit(" "), "o_orderpriority", F.lit("  "))
    return t.orders.select("o_orderkey", F.trim(padded).alias("grade"))


@query(
    "recode_single",
    "select l_orderkey, case l_linenumber when 4 then 0 else l_linenumber end as l_linenumber from lineitem",
)
def _(t):
    return R.recode(t.lineitem.select("l_orderkey", "l_linenumber"), "l_linenumber", {4: 0})


@query(
    "recode_keep_unmapped",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 'now' when '5-LOW' then 'later'
         else o_orderpriority end as o_orderpriority from orders""",
)
def _(t):
    some = t.orders.select("o_orderkey", "o_orderpriority")
    return R.recode(some, "o_orderpriority", {"1-URGENT": "now", "5-LOW": "later"})


@query(
    "recode_unmapped_null",
    """select o_orderkey, case o_orderstatus when 'F' then 1 when 'O' then 0 end as o_orderstatus from orders""",
)
def _(t):
    some = t.orders.select("o_orderkey", "o_orderstatus")
    return R.recode(some, "o_orderstatus", {"F": 1, "O": 0}, unmapped="null")


@query(
    "range_flags",
    """select p_partkey, (p_size between 1 and 14)::int as reason_1, (p_size between 15 and 17)::int as reason_2,
              (p_size between 18 and 21)::int as reason_3, (p_size >= 22)::int as reason_4 from part""",
)
def _(t):
    # fixed values: the four groups of reason codes
    groups = {"reason_1": (1, 14), "reason_2": (15, 17), "reason_3": (18, 21), "reason_4": (22, None)}
    return R.range_flags(t.part.select("p_partkey", "p_size"), "p_size", groups)


@query(
    "fill_constant",
    """select event_id, coalesce(case when event_id % 7 <> 0 then value end, 0) as gappy from events""",
)
def _(t):
    gappy = F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("gappy")
    return R.fill_constant(t.events.select("event_id", gappy), 0, ["gappy"])


@query(
    "hour_and_late_time",
    """select event_id, substr(strftime(ts, '%H%M'), 1, 2) as hour,
         case when cast(strftime(ts, '%H%M') as int) < 400 then cast(strftime(ts, '%H%M') as int) + 2400
              else cast(strftime(ts, '%H%M') as int) end as clock from events""",
)
def _(t):
    text = F.date_format("ts", "HHmm")
    return t.events.select(
        "event_id",
        fd.hour_text(text).alias("hour"),
        fd.past_midnight(text.cast("int")).alias("clock"),
    )


@query(
    "array_length",
    """select vec_id, case when vec_id % 5 = 0 then null else len(embedding)::int end as n from embeddings""",
)
def _(t):
    some = F.when(F.col("vec_id") % 5 != 0, F.col("embedding"))
    return t.embeddings.select("vec_id", F.cardinality(some).alias("n"))


@query(
    "distinct_rows",
    "select distinct l_suppkey, l_linenumber, l_returnflag from lineitem",
)
def _(t):
    return S.distinct_rows(t.lineitem.select("l_suppkey", "l_linenumber", "l_returnflag"))


@query("shuffle_rows", "select o_orderkey, o_totalprice from orders")
def _(t):
    return S.shuffle_rows(t.orders.select("o_orderkey", "o_totalprice"), 7)


HASHED = "('0x' || substr(md5(concat_ws('|', '{seed}', cast({key} as varchar), '{label}')), 1, 8))::bigint"


@query(
    "sample_with_ids",
    f"""select 'CL' || lpad(cast(rn as varchar), greatest(3, length(cast(rn as varchar)))::int, '0') as o_orderkey, o_totalprice, o_orderstatus
        from (select *, row_number() over (order by {HASHED.format(seed=11, key='o_orderkey', label='sample')},
                                                    o_orderkey) as rn from orders) where rn <= 1000""",
)
def _(t):
    some = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    return sample_with_ids(some, 1000, "o_orderkey", prefix="CL", seed=11)


@query(
    "strip_control_characters",
    r"select doc_id, regexp_replace(text, '[\x00-\x1F\x7F]', '', 'g') as text from documents",
)
def _(t):
    return t.documents.select("doc_id", ft.strip_control("text").alias("text"))
