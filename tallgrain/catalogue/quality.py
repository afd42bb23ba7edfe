"""Constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..checks import constraints as Q
from ..operators.columns import with_default
from . import query


@query(
    "primary_key",
    """select sum(n)::bigint as n_rows, 0::bigint as n_null_key, count(*) filter (n > 1) as n_repeated_keys,
              coalesce(sum(n) filter (n > 1), 0)::bigint as n_rows_repeated
       from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)""",
)
def _(t):
    return Q.check_pk(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "foreign_key",
    """select count(distinct l_orderkey) as n_orphan_keys, count(*) as n_orphan_rows from lineitem
       where l_orderkey not in (select o_orderkey from orders where o_orderkey % 4 <> 0)""",
)
def _(t):
    parents = t.orders.filter(F.col("o_orderkey") % 4 != 0)
    return Q.check_fk(t.lineitem, parents, "l_orderkey", "o_orderkey")


def gappy_customers(t):
    return t.customer.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("segment"),
        "c_acctbal",
        "c_name",
    )


CUSTOMERS = """(select c_custkey, case when c_custkey % 9 <> 0 then c_mktsegment end as segment, c_acctbal, c_name
   from customer)"""


@query(
    "constraint_report",
    f"""select rule, n as n_rows, b as n_broken, b = 0 as passed from (select count(*) as n,
           count(*) filter (c_custkey is null) as a1, count(*) filter (segment is null) as a2,
           count(*) filter (c_acctbal < 0 or c_acctbal > 9000) as a3,
           count(*) filter (segment not in ('BUILDING', 'FURNITURE', 'MACHINERY')) as a4,
           count(*) filter (length(c_name) > 17) as a5 from {CUSTOMERS}),
         lateral (values ('not_null(c_custkey)', a1), ('not_null(segment)', a2), ('range(c_acctbal)', a3),
                         ('member(segment)', a4), ('length(c_name)', a5)) v(rule, b)""",
)
def _(t):
    return Q.validate(
        gappy_customers(t),
        [
            Q.not_null("c_custkey"),
            Q.not_null("segment"),
            Q.in_range("c_acctbal", 0, 9000),
            Q.member("segment", ["BUILDING", "FURNITURE", "MACHINERY"]),
            Q.max_length("c_name", 17),
        ],
    )


@query(
    "column_default",
    f"select c_custkey, coalesce(segment, 'NONE') as segment from {CUSTOMERS}",
)
def _(t):
    return gappy_customers(t).select("c_custkey", with_default("segment", "NONE").alias("segment"))
