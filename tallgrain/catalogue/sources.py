"""Readers, writers, scripts, generators and incremental loads over the given tables."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import files as S
from ..sources.script import run_script
from ..sources.synth import synth_products
from ..sources.tables import ensure_database, table_or_empty, write_table
from ..streaming.ingest import ingest_counts, ingest_new, read_counts
from . import query
from .cleaning import HASHED


@query("read_csv", "select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment from customer")
def _(t):
    """Without a schema every column is text."""
    path = shared_dir(t.spark, "csv")
    S.write_csv(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    good, _ = S.split_corrupt(S.read_csv(t.spark, path))
    return good


@query(
    "read_csv_typed",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_totalprice from orders""",
)
def _(t):
    """Chosen delimiter, dates by pattern and forced types."""
    path = shared_dir(t.spark, "csv")
    text = t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("o_orderdate"), "o_totalprice"
    )
    S.write_csv(text, path, sep=";")
    back = S.read_csv(
        t.spark,
        path,
        sep=";",
        dates={"o_orderdate": "MM/dd/yyyy"},
        dtypes={"o_orderkey": "bigint", "o_totalprice": "double"},
    )
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return back.drop(S.CORRUPT).withColumn("o_orderdate", text)


@query(
    "read_csv_titled",
    "select s_suppkey, s_name, s_acctbal from supplier",
)
def _(t):
    """Two title lines stand above the header of every file."""
    path = shared_dir(t.spark, "titled")
    lines = t.supplier.select(F.concat_ws(",", "s_suppkey", "s_name", "s_acctbal").alias("value"))

    def titled(batches):
        top = ["Suppliers", "printed by the office", "s_suppkey,s_name,s_acctbal"]
        yield pd.DataFrame({"value": top})
        yield from batches

    lines.mapInPandas(titled, "value string").write.text(path)
    back = S.read_csv(
        t.spark, path, schema="s_suppkey bigint, s_name string, s_acctbal double", skip_rows=2
    )
    return back.drop(S.CORRUPT)


@query("read_json", "select event_id, event_type, value from events")
def _(t):
    path = shared_dir(t.spark, "json")
    t.events.select("event_id", "event_type", "value").write.json(path)
    good, _ = S.split_corrupt(
        S.read_json(t.spark, path, "event_id bigint, event_type string, value double")
    )
    return good


@query(
    "split_corrupt_lines",
    """select count(*) filter (event_id % 10 <> 0) as n_good, count(*) filter (event_id % 10 = 0) as n_corrupt
       from events""",
)
def _(t):
    """Every tenth line is cut in the middle."""
    path = shared_dir(t.spark, "broken")
    whole = F.to_json(F.struct("event_id", "event_type", "value"))
    line = F.when(F.col("event_id") % 10 == 0, F.substring(whole, 1, 12)).otherwise(whole)
    t.events.select(line.alias("value")).write.text(path)
    raw = S.read_json(t.spark, path, "event_id bigint, event_type string, value double")
    return raw.agg(
        F.count_if(F.col(S.CORRUPT).isNull() & F.col("event_id").isNotNull()).alias("n_good"),
        F.count_if(F.col(S.CORRUPT).isNotNull()).alias("n_corrupt"),
    )


@query("write_table", "select * exclude (o_orderdate) from orders")
def _(t):
    """External Parquet table in a database made on demand, written twice."""
    root, name = shared_dir(t.spark, "db"), f"tallgrain_{uuid.uuid4().hex}"
    ensure_database(t.spark, name, f"{root}/db")
    table = write_table(t.orders, name, "orders", f"{root}/orders")
    write_table(t.orders, name, "orders", f"{root}/orders")
    return t.spark.table(table).drop("o_orderdate")


@query("table_or_empty", "select c_custkey, c_name, c_acctbal from customer")
def _(t):
    """A table that exists, and one that does not and gives no rows."""
    root, name = shared_dir(t.spark, "db"), f"tallgrain_{uuid.uuid4().hex}"
    ensure_database(t.spark, name, f"{root}/db")
    some = t.customer.select("c_custkey", "c_name", "c_acctbal")
    table = write_table(some, name, "customer", f"{root}/customer")
    there = table_or_empty(t.spark, table, some.schema)
    return there.unionByName(table_or_empty(t.spark, f"{name}.missing", some.schema))


@query(
    "write_result_both_ways",
    "select s_suppkey, s_name from supplier union all select s_suppkey, s_name from supplier",
)
def _(t):
    base = shared_dir(t.spark, "result")
    S.write_result(t.supplier.select("s_suppkey", "s_name"), base)
    schema = "s_suppkey bigint, s_name string"
    first = S.read_csv(t.spark, f"{base}_csv", schema).drop(S.CORRUPT)
    return first.unionByName(S.read_json(t.spark, f"{base}_json", schema).drop(S.CORRUPT))


@query(
    "run_script",
    """select c_custkey, c_name, c_mktsegment as "kind;quoted", o_orderkey, o_totalprice as balance
       from customer join orders on c_custkey = o_custkey order by c_custkey, o_orderkey""",
)
def _(t):
    """Tables made, filled and joined by one script; only the last result comes back."""
    root, name = shared_dir(t.spark, "script"), f"tallgrain_{uuid.uuid4().hex}"
    text = f"""
        -- clients and products; the semicolon in this comment ends nothing
        CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}';
        CREATE TABLE {name}.clients (c_custkey BIGINT, c_name STRING, c_mktsegment STRING) USING parquet;
        CREATE TABLE {name}.products (o_orderkey BIGINT, o_custkey BIGINT, balance DOUBLE) USING parquet;
        INSERT INTO {name}.clients SELECT c_custkey, c_name, c_mktsegment FROM script_customer;
        INSERT INTO {name}.products SELECT o_orderkey, o_custkey, o_totalprice FROM script_orders
            WHERE ';' <> 'x';
        /* the join; again with a semicolon */
        SELECT c.c_custkey, c.c_name, c.c_mktsegment AS `kind;quoted`, p.o_orderkey, p.balance
        FROM {name}.clients c INNER JOIN {name}.products p ON c.c_custkey = p.o_custkey
        ORDER BY c.c_custkey, p.o_orderkey;
    """
    return run_script(t.spark, text, {"script_customer": t.customer, "script_orders": t.orders})


@query(
    "literal_table",
    """select c_custkey, months, c_nationkey * months as total from customer,
         (values ('BUILDING', 1), ('MACHINERY', 3), ('MACHINERY', 12)) v(segment, months)
       where c_mktsegment = segment""",
)
def _(t):
    """A small table written out in the program, joined to a given one."""
    literal = [("BUILDING", 1), ("MACHINERY", 3), ("MACHINERY", 12)]
    months = t.spark.createDataFrame(literal, "c_mktsegment string, months int")
    joined = t.customer.join(F.broadcast(months), ["c_mktsegment"])
    return joined.select("c_custkey", "months", (F.col("c_nationkey") * F.col("months")).alias("total"))


@query(
    "synth_products",
    f"""with drawn as (select c_custkey from (select c_custkey, row_number() over (order by
             {HASHED.format(seed=3, key='c_custkey', label='drawn')}, c_custkey) as rn from customer) where rn <= 300),
        each as (select c_custkey, unnest(range(1, ({HASHED.format(seed=3, key='c_custkey', label='count')} % 2 + 3)::int)) as no
                 from drawn),
        p as (select c_custkey, c_custkey || '-' || no as p from each)
        select 'PR' || p as producto_id, c_custkey,
          ['Cuenta Ahorros', 'Tarjeta Crédito', 'Cuenta Corriente', 'Préstamo Personal', 'Inversión']
            [({HASHED.format(seed=3, key='p', label='kind')} % 5 + 1)::int] as tipo_producto,
          (({HASHED.format(seed=3, key='p', label='balance')} % 2900001 + 100000) / 100.0)::double as saldo,
          strftime(date '2020-01-01' + ({HASHED.format(seed=3, key='p', label='opened')} % 1827)::int, '%Y-%m-%d') as fecha_apertura,
          ['Activo', 'Inactivo'][({HASHED.format(seed=3, key='p', label='state')} % 2 + 1)::int] as estado
        from p""",
)
def _(t):
    """Two or three products for 300 clients drawn from the customers."""
    made = synth_products(t.customer, 300, seed=3, key="c_custkey")
    opened = F.date_format("fecha_apertura", "yyyy-MM-dd")
    return made.withColumns({"saldo": F.col("saldo").cast("double"), "fecha_apertura": opened})


@query("ingest_new_files", "select * replace (epoch_us(ts) as ts) from events")
def _(t):
    """New files only: load half, load again, add the other half, load again."""
    root = shared_dir(t.spark, "ingest")
    source, target, mark = f"{root}/in", f"{root}/out", f"{root}/checkpoint"
    events, schema = t.events, t.events.schema
    odd = F.col("event_id") % 2 == 1
    events.filter(~odd).write.mode("append").parquet(source)
    ingest_new(t.spark, source, target, mark, schema)
    ingest_new(t.spark, source, target, mark, schema)
    events.filter(odd).write.mode("append").parquet(source)
    ingest_new(t.spark, source, target, mark, schema)
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    micros = F.timestamp_diff("MICROSECOND", start, F.col("ts"))
    return t.spark.read.parquet(target).withColumn("ts", micros)


@query("ingest_counts", "select event_type, count(*) as n from events where value > 1 group by 1")
def _(t):
    """Counts of new files only, over several batches and three runs."""
    root = shared_dir(t.spark, "counts")
    source, target, mark = f"{root}/in", f"{root}/out", f"{root}/checkpoint"
    events, keys = t.events, ["event_type"]
    odd = F.col("event_id") % 2 == 1

    def load():
        ingest_counts(
            t.spark,
            source,
            target,
            mark,
            events.schema,
            keys,
            prepare=lambda rows: rows.filter(F.col("value") > 1),
            max_files=1,
        )

    events.filter(~odd).write.mode("append").parquet(source)
    load()
    load()
    events.filter(odd).write.mode("append").parquet(source)
    load()
    return read_counts(t.spark, target, keys)
