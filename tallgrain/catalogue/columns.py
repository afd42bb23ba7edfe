"""Projection, naming, typing, filtering and positional access."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as C
from ..operators import names as N
from ..operators.ranks import row_slice
from . import query


@query(
    "drop_columns",
    """select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag from lineitem""",
)
def _(t):
    return C.drop_columns(
        t.lineitem,
        ["l_partkey", "l_suppkey", "l_discount", "l_tax", "l_linestatus", "l_shipdate", "not_there"],
    )


@query("select_reorder", "select o_totalprice, o_orderkey, o_orderstatus from orders")
def _(t):
    return t.orders.select("o_totalprice", "o_orderkey", "o_orderstatus")


@query("first_columns", "select o_orderkey, o_custkey, o_orderstatus from orders")
def _(t):
    return C.first_columns(t.orders, "o_orderkey", 3)


@query("rename_positional", "select s_suppkey as id, s_name as label from supplier")
def _(t):
    return N.rename_all(t.supplier.select("s_suppkey", "s_name"), ["id", "label"])


@query(
    "rename_map",
    "select s_suppkey as supplier_id, s_name, s_nationkey as nation_id, s_acctbal from supplier",
)
def _(t):
    return N.rename(t.supplier, {"s_suppkey": "supplier_id", "s_nationkey": "nation_id"})


@query(
    "normalize_names",
    """select p_partkey as id_del_producto, p_brand as ano_fabricacion, p_size as tamano_cm,
              p_retailprice as precio from part""",
)
def _(t):
    raw = t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return N.normalize_names(raw.toDF("ID del Producto", "Año - Fabricación", "Tamaño (cm)", "PRECIO"))


@query(
    "collapse_and_restore_names",
    "select c_custkey as cliente_id, c_acctbal as annual_inc, c_name as nombre from customer",
)
def _(t):
    raw = t.customer.select("c_custkey", "c_acctbal", "c_name")
    spelled = raw.toDF("c_l_i_e_n_t_e_i_d", "a_n_n_u_a_l_i_n_c", "nombre")
    return N.restore_names(N.collapse_names(spelled), ["cliente_id", "annual_inc"])


@query(
    "check_columns",
    """select expected, found_as, present, filled from
         (select count(c_custkey) as a, count(case when c_custkey % 4 <> 0 then c_name end) as b from customer),
         lateral (values ('c_custkey', 'C_CustKey', true, a), ('c_name', 'c name', true, b),
                         ('c_phone', null, false, null)) v(expected, found_as, present, filled)""",
)
def _(t):
    """Expected columns under whatever spelling, and how many rows they fill."""
    name = F.when(F.col("c_custkey") % 4 != 0, F.col("c_name"))
    raw = t.customer.select(F.col("c_custkey").alias("C_CustKey"), name.alias("c name"))
    filled = C.schema_report(raw).select(
        F.col("column_name").alias("found_as"), F.col("non_null").alias("filled")
    )
    return N.check_columns(raw, ["c_custkey", "c_name", "c_phone"]).join(filled, ["found_as"], "left")


@query(
    "clean_column_names",
    """select c_custkey as cliente_id, c_name as "ciudad_Bogotá D.C.", c_nationkey as tasa_interes,
              c_acctbal as tasa_interes_1 from customer""",
)
def _(t):
    raw = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    raw = raw.toDF("cliente_id", "ciudad_Bogotá D.C.", "tasa (interes)", "tasa/interes")
    return raw.toDF(*N.clean_column_names(raw.columns, ["cliente_id"], ["ciudad_"]))


@query(
    "cast_to_double",
    """select o_orderkey, try_cast(case when o_orderkey % 5 = 0 then 'n/a'
              else cast(o_custkey as varchar) end as double) as cust_number from orders""",
)
def _(t):
    text = F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.col("o_custkey").cast("string"))
    return C.to_number(t.orders.select("o_orderkey", text.alias("cust_number")), ["cust_number"])


@query(
    "compact_types",
    """select cast(l_orderkey as int) as l_orderkey, cast(l_quantity as int) as l_quantity,
              cast(l_discount as float) as l_discount,
              cast(l_linenumber % 2 as boolean) as odd_line, l_returnflag from lineitem""",
)
def _(t):
    raw = t.lineitem.select(
        "l_orderkey",
        "l_quantity",
        "l_discount",
        (F.col("l_linenumber") % 2).alias("odd_line"),
        "l_returnflag",
    )
    return C.compact_types(
        raw,
        {
            "l_orderkey": "int32",
            "l_quantity": "int32",
            "l_discount": "float16",
            "odd_line": "bool",
            "l_returnflag": "category",
        },
    )


@query("text_to_boolean", "select o_orderkey, o_orderstatus = 'F' as o_orderstatus from orders")
def _(t):
    from ..operators.recode import text_is

    return text_is(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "F")


@query(
    "row_filters",
    """select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem
       where l_returnflag = 'R' and l_quantity > 30 and l_discount >= 0.05 and l_linestatus <> 'F'
          or l_tax = 0.08""",
)
def _(t):
    strict = (
        (F.col("l_returnflag") == "R")
        & (F.col("l_quantity") > 30)
        & (F.col("l_discount") >= 0.05)
        & (F.col("l_linestatus") != "F")
    )
    kept = t.lineitem.filter(strict | (F.col("l_tax") == 0.08))
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query(
    "exclude_members",
    """select o_orderkey, grade from (select o_orderkey,
         case when o_orderkey % 11 = 0 then null else o_orderpriority end as grade from orders)
       where grade is null or grade not in ('1-URGENT', '5-LOW')""",
)
def _(t):
    grade = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("grade")
    return C.exclude(t.orders.select("o_orderkey", grade), "grade", ["1-URGENT", "5-LOW"])


@query(
    "column_arithmetic",
    """select l_orderkey, l_linenumber, round(l_extendedprice - l_quantity, 2) as diff,
              round(l_discount + l_tax, 2) as both_rates from lineitem""",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.col("l_extendedprice") - F.col("l_quantity"), 2).alias("diff"),
        F.round(F.col("l_discount") + F.col("l_tax"), 2).alias("both_rates"),
    )


@query(
    "odd_cubes",
    """select p_partkey, case when p_partkey % 2 <> 0
         then cast(p_size::bigint * p_size * p_size as varchar) else 'even' end as cubed from part""",
)
def _(t):
    size = F.col("p_size").cast("bigint")
    return t.part.select("p_partkey", C.alternate("p_partkey", size * size * size, F.lit("even")).alias("cubed"))


@query(
    "rows_by_position",
    """select o_orderkey, o_orderstatus from
        (select *, row_number() over (order by o_orderkey) as rn from orders) where rn > 5 and rn <= 105""",
)
def _(t):
    return row_slice(t.orders, "o_orderkey", 5, 105, [0, 2])


@query("rows_by_label", "select s_suppkey, s_name from supplier where s_suppkey in (3, 7, 11)")
def _(t):
    return C.by_label(t.supplier, "s_suppkey", [3, 7, 11], ["s_suppkey", "s_name"])


@query(
    "schema_report",
    """select v.position, v.column_name, v.type, v.non_null, n as n_rows from
       (select count(*) n, count(event_id) a, count(event_type) b, count(value) c,
               count(case when event_id % 7 <> 0 then value end) d from events) s,
       lateral (values (0, 'event_id', 'bigint', a), (1, 'event_type', 'string', b),
                       (2, 'value', 'double', c), (3, 'gappy', 'double', d))
               v(position, column_name, type, non_null)""",
)
def _(t):
    gappy = F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("gappy")
    return C.schema_report(t.events.select("event_id", "event_type", "value", gappy))


@query(
    "report_lines",
    """select o_orderkey, 'Expected sales for a period of ' || (o_orderkey % 12 + 1) || ' month(s) for '
         || o_orderpriority || ': $' || o_custkey as line from orders""",
)
def _(t):
    line = F.format_string(
        "Expected sales for a period of %d month(s) for %s: $%d",
        F.col("o_orderkey") % 12 + 1,
        "o_orderpriority",
        "o_custkey",
    )
    return t.orders.select("o_orderkey", line.alias("line"))


@query(
    "sort_with_missing_last",
    """select o_orderkey, price from (select o_orderkey,
         case when o_orderkey % 9 = 0 then null else o_totalprice end as price from orders)
       order by price desc nulls last, o_orderkey""",
)
def _(t):
    price = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("price")
    return C.order(t.orders.select("o_orderkey", price), ["price", "o_orderkey"], [False, True])


@query("sort_by_index", "select s_suppkey, s_acctbal from supplier order by s_suppkey")
def _(t):
    return t.supplier.select("s_suppkey", "s_acctbal").orderBy("s_suppkey")


@query(
    "top_k",
    """select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10""",
)
def _(t):
    return C.top_k(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 10, ["o_orderkey"])


@query(
    "head_and_tail",
    """(select 'head' as part, o_orderkey, o_totalprice from orders order by o_orderkey limit 5)
       union all
       (select 'tail', o_orderkey, o_totalprice from orders order by o_orderkey desc limit 5)""",
)
def _(t):
    o = t.orders.select("o_orderkey", "o_totalprice")
    first = C.head(o, 5, ["o_orderkey"]).select(F.lit("head").alias("part"), "*")
    return first.unionByName(C.tail(o, 5, ["o_orderkey"]).select(F.lit("tail").alias("part"), "*"))


@query(
    "first_in_order",
    """select o_custkey, o_orderpriority from orders where o_orderstatus = 'F'
       order by o_orderdate, o_orderkey limit 1""",
)
def _(t):
    some = t.orders.filter(F.col("o_orderstatus") == "F")
    return C.first_by(some, ["o_orderdate", "o_orderkey"], ["o_custkey", "o_orderpriority"])


@query(
    "string_functions",
    """select doc_id, substr(text, 1, 10) as head, regexp_extract(source, '([0-9]+)', 1) as source_no,
              replace(lang, 'e', '_') as swapped, lpad(cast(doc_id as varchar), 8, '0') as padded,
              upper(lang[1:1]) || lower(lang[2:]) as titled, lang || ' ' || source as joined,
              replace(strip_accents(lower(text)), ' ', '_') as normal_text
       from documents""",
)
def _(t):
    from ..functions.text import normalize_text

    return t.documents.select(
        "doc_id",
        F.substring("text", 1, 10).alias("head"),
        F.regexp_extract("source", "([0-9]+)", 1).alias("source_no"),
        F.regexp_replace("lang", "e", "_").alias("swapped"),
        F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("padded"),
        F.initcap("lang").alias("titled"),
        F.concat_ws(" ", "lang", "source").alias("joined"),
        normalize_text("text").alias("normal_text"),
    )


@query(
    "date_functions",
    """select o_orderkey, day(o_orderdate)::int as d, month(o_orderdate)::int as m, year(o_orderdate)::int as y,
              (isodow(o_orderdate) - 1)::int as wd,
              strftime(o_orderdate::date + (o_orderkey % 30)::int, '%Y-%m-%d') as later from orders""",
)
def _(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.dayofmonth(day).alias("d"),
        F.month(day).alias("m"),
        F.year(day).alias("y"),
        F.weekday(day).alias("wd"),
        F.date_format(F.date_add(day, (F.col("o_orderkey") % 30).cast("int")), "yyyy-MM-dd").alias("later"),
    )


@query(
    "math_functions",
    """select p_partkey, round(exp(p_size / 50.0), 9) as e, round(ln(p_size), 9) as l, round(sqrt(p_size), 9) as s,
              abs(p_size - 25) as a, p_size % 7 as m, round(pow(p_size, 3), 3) as cube,
              round(pow(2 + 5 * pow(p_size, 4), 2) / pow(p_size + 3, 3) / 1e6, 6) as ratio from part""",
)
def _(t):
    x = F.col("p_size")
    ratio = F.pow(2 + 5 * F.pow(x, F.lit(4)), F.lit(2)) / F.pow(x + 3, F.lit(3)) / 1e6
    return t.part.select(
        "p_partkey",
        F.round(F.exp(x / 50.0), 9).alias("e"),
        F.round(F.log(x), 9).alias("l"),
        F.round(F.sqrt(x), 9).alias("s"),
        F.abs(x - 25).alias("a"),
        (x % 7).alias("m"),
        F.round(F.pow(x, F.lit(3)), 3).alias("cube"),
        F.round(ratio, 6).alias("ratio"),
    )


@query(
    "array_functions",
    """select vec_id, len(embedding) as size,
         list_position(list_transform(embedding, lambda x: abs(x)),
                       list_max(list_transform(embedding, lambda x: abs(x)))) - 1 as strongest,
         array_to_string(list_transform([0, 1, 2, 3, 4], lambda j: j || '+' || (label + j)), ',') as nested,
         array_to_string(flatten(list_transform([0, label], lambda i: list_transform([0, 1, 2, 3, 4], lambda j: i + j))), ',') as flat
       from embeddings""",
)
def _(t):
    strengths = F.transform("embedding", lambda x: F.abs(x))
    zero_to_four = F.sequence(F.lit(0), F.lit(4))
    return t.embeddings.select(
        "vec_id",
        F.size("embedding").cast("bigint").alias("size"),
        (F.array_position(strengths, F.array_max(strengths)) - 1).cast("bigint").alias("strongest"),
        F.array_join(
            F.transform(zero_to_four, lambda j: F.concat_ws("+", j.cast("string"), (F.col("label") + j).cast("string"))),
            ",",
        ).alias("nested"),
        F.array_join(
            F.flatten(
                F.transform(
                    F.array(F.lit(0), "label"),
                    lambda i: F.transform(zero_to_four, lambda j: (i + j).cast("string")),
                )
            ),
            ",",
        ).alias("flat"),
    )
