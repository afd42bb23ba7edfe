"""Whole jobs on stand-ins made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..learn.logreg import LogisticModel
from ..learn.scaler import ColumnScaler
from ..learn.scoring import ScoringModel
from ..operators.joins import spread_join
from ..plans import absence as A
from ..plans import bank as B
from ..plans import customer360 as C
from ..plans import experiment as X
from ..plans import staging as G
from ..session import shared_dir
from ..sources.files import write_csv
from . import query
from .cleaning import HASHED
from .learning import descent_sql
from .statistics import f_tail_sql, measured, normal_tail_sql, t_tail_sql
from .summaries import rounded


def client_id(c):
    text = F.col(c).cast("string")
    return F.concat(F.lit("CL"), F.lpad(text, F.greatest(F.lit(3), F.length(text)), "0"))


def pick(c, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(c) % len(values) + 1).cast("int"))


CITY = ["Bogotá", "Medellín", "Cali", "Barranquilla"]
HOME = ["Propia", "Arrendada", "Familiar"]
KIND = ["Cuenta Ahorros", "Tarjeta Crédito", "Inversión"]


def loans(t):
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    return t.orders.select(
        F.lit("x").alias("member_id"),
        k.alias("id"),
        price.cast("string").alias("loan_amnt"),
        price.cast("string").alias("funded_amnt"),
        price.cast("string").alias("funded_amnt_inv"),
        F.when(k % 2 == 0, " 36 months").otherwise(" 60 months").alias("term"),
        F.format_string(" %d%%", k % 25).alias("int_rate"),
        (k % 900).cast("string").alias("installment"),
        F.col("o_orderpriority").alias("grade"),
        F.lit("y").alias("emp_length"),
        F.lit("own").alias("home_ownership"),
        F.when(k % 13 != 0, (k % 500 * 100).cast("string")).otherwise("n/a").alias("annual_inc"),
        F.lit("z").alias("verification_status"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("issue_d"),
    )


def demographics(t):
    k = F.col("c_custkey")
    return t.customer.select(
        client_id("c_custkey").alias("cliente_id"),
        F.lit("CO").alias("pais"),
        F.col("c_nationkey").cast("string").alias("codigo_postal"),
        (k % 120).cast("string").alias("antiguedad_empleo_meses"),
        F.when(k % 17 != 0, (k % 4).cast("string")).alias("hijos"),
        (k % 3).cast("string").alias("vehiculos"),
        F.when(k % 7 != 0, pick("c_nationkey", CITY)).alias("ciudad"),
        F.col("c_mktsegment").alias("empleador"),
        F.when(k % 11 != 0, pick("c_custkey", HOME)).alias("propiedad_vivienda"),
    )


def behaviour(t):
    per_user = t.events.groupBy("user_id").agg(
        F.count_distinct("event_type").cast("int").alias("dispositivos_activos"),
        F.count(F.lit(1)).cast("int").alias("frecuencia_login_mensual"),
        F.max_by("event_type", F.struct("ts", "event_id")).alias("preferencia_canal"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm").alias("ultima_actividad"),
        F.array_sort(F.collect_set("event_type")).alias("servicios_contratados"),
    )
    mail = F.concat_ws("@", F.col("user_id").cast("string"), F.lit("example.com")).alias("email")
    return per_user.select(client_id("user_id").alias("cliente_id"), mail, "*").drop("user_id")


def products(t):
    k = F.col("o_orderkey")
    raw = t.orders.select(
        client_id("o_custkey"),
        F.lit("n"),
        F.lit("a"),
        F.lit("c"),
        (k % 700 * 50).cast("string"),
        (k % 550 + 300).cast("string"),
        F.concat(F.lit("PR"), k.cast("string")),
        pick("o_orderkey", KIND),
        F.col("o_totalprice").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.when(F.col("o_orderstatus") == "F", "Activo").otherwise("Inactivo"),
    )
    return raw.toDF(
        "Cliente ID", "Nombre", "Apellido", "Ciudad", "a_n_n_u_a_l_i_n_c", "Score Crediticio",
        "Producto-ID", "Servicios Contratados", "Saldo Servicio", "Fecha Apertura Servicio",
        "Estado Servicio",
    )


ID = "'CL' || lpad({0}::varchar, greatest(3, length({0}::varchar))::int, '0')"

LOANS = f"""loans as (select {ID.format('rn')} as id, o_totalprice::double as loan_amnt, (o_orderkey % 25)::double as int_rate,
      (o_orderkey % 900)::double as installment,
      case when o_orderkey % 13 <> 0 then (o_orderkey % 500 * 100)::double end as annual_inc,
      day(o_orderdate)::int as day_issue_d, month(o_orderdate)::int as month_issue_d, year(o_orderdate)::int as year_issue_d,
      case when o_orderkey % 2 = 0 then 36 else 60 end as term_in_months
   from (select *, row_number() over (order by {HASHED.format(seed=5, key='o_orderkey', label='sample')}, o_orderkey) as rn
         from orders))"""

PEOPLE = f"""raw_people as (select {ID.format('c_custkey')} as cliente_id, (c_custkey % 120)::double as antiguedad_empleo_meses,
      case when c_custkey % 17 <> 0 then (c_custkey % 4)::double end as hijos, (c_custkey % 3)::double as vehiculos,
      case when c_custkey % 7 <> 0 then ['Bogotá', 'Medellín', 'Cali', 'Barranquilla'][c_nationkey % 4 + 1] end as ciudad,
      c_mktsegment as empleador,
      case when c_custkey % 11 <> 0 then ['Propia', 'Arrendada', 'Familiar'][c_custkey % 3 + 1] end as propiedad from customer),
   m1 as (select ciudad as v from raw_people where ciudad is not null group by 1 order by count(*) desc, 1 limit 1),
   m2 as (select propiedad as v from raw_people where propiedad is not null group by 1 order by count(*) desc, 1 limit 1),
   people as (select cliente_id, antiguedad_empleo_meses, hijos, vehiculos, empleador,
      coalesce(ciudad, (select v from m1)) as ciudad, coalesce(propiedad, (select v from m2)) as propiedad from raw_people)"""

PEOPLE_FLAGS = """(ciudad = 'Barranquilla')::int as ciudad_barranquilla, (ciudad = 'Bogotá')::int as ciudad_bogota,
   (ciudad = 'Cali')::int as ciudad_cali, (ciudad = 'Medellín')::int as ciudad_medellin,
   (empleador = 'AUTOMOBILE')::int as empleador_automobile, (empleador = 'BUILDING')::int as empleador_building,
   (empleador = 'FURNITURE')::int as empleador_furniture, (empleador = 'HOUSEHOLD')::int as empleador_household,
   (empleador = 'MACHINERY')::int as empleador_machinery, (propiedad = 'Arrendada')::int as propiedad_vivienda_arrendada,
   (propiedad = 'Familiar')::int as propiedad_vivienda_familiar, (propiedad = 'Propia')::int as propiedad_vivienda_propia"""

BEHAVIOUR = f"""last as (select user_id, count(distinct event_type)::int as n_types, count(*)::int as n,
      max(ts)::date as d, max_by(event_type, (ts, event_id)) as canal from events group by 1),
   behaviour as (select {ID.format('user_id')} as cliente_id, n_types::double as dispositivos_activos,
      n::double as frecuencia_login_mensual, n_types as num_servicios_contratados,
      day(d)::int as day_ultima_actividad, month(d)::int as month_ultima_actividad, year(d)::int as year_ultima_actividad,
      canal from last)"""

CHANNEL_FLAGS = ", ".join(
    f"(canal = '{c}')::int as preferencia_canal_{c}" for c in ("click", "error", "purchase", "signup", "view")
)

PRODUCTS = f"""raw_products as (select {ID.format('o_custkey')} as cliente_id, (o_orderkey % 700 * 50)::double as annual_inc,
      (o_orderkey % 550 + 300)::double as score_crediticio, o_orderkey % 3 as kind, o_totalprice::double as saldo_servicio,
      o_orderdate as d, o_orderstatus = 'F' as active from orders),
   products as (select cliente_id, avg(annual_inc) as annual_inc, avg(score_crediticio) as score_crediticio,
      avg(saldo_servicio) as saldo_servicio, max((kind = 0)::int) as servicios_contratados_cuenta_ahorros,
      max((kind = 2)::int) as servicios_contratados_inversion, max((kind = 1)::int) as servicios_contratados_tarjeta_credito,
      max(active::int) as estado_servicio_activo, max((not active)::int) as estado_servicio_inactivo,
      year(min(d))::int as year_fecha_apertura_servicio, month(min(d))::int as month_fecha_apertura_servicio,
      day(min(d))::int as day_fecha_apertura_servicio from raw_products group by 1)"""


@query("prepare_loans", f"with {LOANS} select * from loans")
def _(t):
    return C.prepare_loans(loans(t), seed=5)


@query(
    "prepare_demographics",
    f"""with {PEOPLE} select cliente_id, antiguedad_empleo_meses, hijos, vehiculos, {PEOPLE_FLAGS} from people""",
)
def _(t):
    return C.prepare_demographics(demographics(t))


@query("prepare_behaviour", f"with {BEHAVIOUR} select * exclude (canal), {CHANNEL_FLAGS} from behaviour")
def _(t):
    return C.prepare_behaviour(behaviour(t))


@query(
    "prepare_products",
    f"""with {PRODUCTS} select * replace (round(annual_inc, 6) as annual_inc, round(score_crediticio, 6) as score_crediticio,
        round(saldo_servicio, 6) as saldo_servicio) from products""",
)
def _(t):
    return rounded(C.prepare_products(products(t)), C.PRODUCT_NUMBERS)


MEANS = [
    "antiguedad_empleo_meses", "hijos", "vehiculos", "dispositivos_activos", "frecuencia_login_mensual",
    "num_servicios_contratados", "loan_amnt", "int_rate", "installment", "annual_inc", "term_in_months",
    "score_crediticio", "saldo_servicio",
]
DATE_PARTS = [
    f"{p}_{c}" for c in ("ultima_actividad", "issue_d", "fecha_apertura_servicio") for p in ("day", "month", "year")
]
FLAG_COLUMNS = [
    *(f"ciudad_{c}" for c in ("barranquilla", "bogota", "cali", "medellin")),
    *(f"empleador_{c}" for c in ("automobile", "building", "furniture", "household", "machinery")),
    *(f"propiedad_vivienda_{c}" for c in ("arrendada", "familiar", "propia")),
    *(f"preferencia_canal_{c}" for c in ("click", "error", "purchase", "signup", "view")),
    *(f"servicios_contratados_{c}" for c in ("cuenta_ahorros", "inversion", "tarjeta_credito")),
    *(f"estado_servicio_{c}" for c in ("activo", "inactivo")),
]
CUSTOMER360 = f"""with {LOANS}, {PEOPLE}, {BEHAVIOUR}, {PRODUCTS},
   wide as (select p.* exclude (ciudad, empleador, propiedad), {PEOPLE_FLAGS}, b.* exclude (cliente_id, canal),
                   {CHANNEL_FLAGS}, l.* exclude (id)
            from people p left join behaviour b using (cliente_id) left join loans l on p.cliente_id = l.id),
   every as (select * from wide union all by name select * from products)
   select distinct cliente_id,
     {", ".join(f"round(coalesce({c}, (select avg({c}) from every))::double, 6) as {c}" for c in MEANS)},
     {", ".join(f"coalesce({c}, (select {c} from every where {c} is not null group by 1 order by count(*) desc, 1 limit 1)) as {c}" for c in DATE_PARTS)},
     {", ".join(f"coalesce({c}, 0) as {c}" for c in FLAG_COLUMNS)} from every"""


@query("customer360", CUSTOMER360)
def _(t):
    found = C.customer360(C.Sources(loans(t), demographics(t), behaviour(t), products(t)), seed=5)
    return rounded(found, MEANS)


def raw_sources(t, root: str) -> dict[str, G.Source]:
    """The four sources as files below a folder."""
    for name, df in (("loans", loans(t)), ("demographics", demographics(t)), ("products", products(t))):
        write_csv(df, f"{root}/{name}.csv")
    behaviour(t).write.json(f"{root}/behaviour.json")
    kinds = {"loans": "csv", "demographics": "csv", "products": "csv", "behaviour": "json"}
    return {n: G.Source(f"{root}/{n}.{k}", k, G.BEHAVIOUR_SCHEMA if k == "json" else None) for n, k in kinds.items()}


@query("bank_job", CUSTOMER360)
def _(t):
    """Files to staged tables to the merged table, which is read back by its name; run twice."""
    root = shared_dir(t.spark, "bank")
    sources, database = raw_sources(t, root), "bank_" + root.rsplit("-", 1)[-1]
    for seed in (1, 5):  # the second run replaces the first
        done = B.run_bank_job(t.spark, sources, f"{root}/out", database, seed=seed)
    return rounded(t.spark.table(done.table), MEANS)


@query(
    "staged_people",
    """select 'CL' || lpad(c_custkey::varchar, greatest(3, length(c_custkey::varchar))::int, '0') as cliente_id, 'CO' as pais,
         c_nationkey::varchar as codigo_postal, (c_custkey % 120)::varchar as antiguedad_empleo_meses,
         case when c_custkey % 17 <> 0 then (c_custkey % 4)::varchar end as hijos, (c_custkey % 3)::varchar as vehiculos,
         case when c_custkey % 7 <> 0 then ['Bogotá', 'Medellín', 'Cali', 'Barranquilla'][c_nationkey % 4 + 1] end as ciudad,
         c_mktsegment as empleador, case when c_custkey % 11 <> 0 then ['Propia', 'Arrendada', 'Familiar'][c_custkey % 3 + 1] end
           as propiedad_vivienda from customer""",
)
def _(t):
    """The rows of a staged table."""
    root = shared_dir(t.spark, "staged")
    write_csv(demographics(t), f"{root}/people.csv")
    source = {"people": G.Source(f"{root}/people.csv", "csv")}
    done = G.stage_all(t.spark, source, f"{root}/out", "staged_" + root.rsplit("-", 1)[-1])
    return t.spark.table(done["people"].table)


@query(
    "stage_all",
    """select * from (select 'loans' as source, count(*) as n_rows, 0::bigint as n_corrupt from orders
       union all select 'demographics', count(*), 0 from customer
       union all select 'behaviour', count(distinct user_id), 0 from events
       union all select 'missing', 0, 0)""",
)
def _(t):
    """CSV and JSON sources to tables; one source does not exist and gives an empty table."""
    root = shared_dir(t.spark, "staging")
    write_csv(loans(t), f"{root}/loans.csv")
    write_csv(demographics(t), f"{root}/demographics.csv")
    behaviour(t).write.json(f"{root}/behaviour.json")
    database = "staged_" + root.rsplit("-", 1)[-1]
    done = G.stage_all(
        t.spark,
        {
            "loans": G.Source(f"{root}/loans.csv", "csv"),
            "demographics": G.Source(f"{root}/demographics.csv", "csv"),
            "behaviour": G.Source(f"{root}/behaviour.json", "json", G.BEHAVIOUR_SCHEMA),
            "missing": G.Source(f"{root}/nothing.json", "json", G.BEHAVIOUR_SCHEMA),
        },
        f"{root}/out",
        database,
    )
    counts = None
    for name, s in done.items():
        line = t.spark.table(s.table).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("source"), "n_rows", F.lit(s.n_corrupt).cast("bigint").alias("n_corrupt")
        )
        counts = line if counts is None else counts.unionByName(line)
    return counts


@query(
    "client_products",
    """select c_custkey as cliente_id, c_name as nombre, c_acctbal as annual_inc, o_orderkey as producto_id,
              o_totalprice as saldo_servicio, strftime(o_orderdate, '%Y-%m-%d') as fecha_apertura, o_orderstatus as estado
       from customer join orders on c_custkey = o_custkey where c_acctbal > 0 order by 1, 4""",
)
def _(t):
    people = t.customer.filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("cliente_id"), F.col("c_name").alias("nombre"), F.col("c_acctbal").alias("annual_inc")
    )
    owned = t.orders.select(
        F.col("o_custkey").alias("cliente_id"),
        F.col("o_orderkey").alias("producto_id"),
        F.col("o_totalprice").alias("saldo_servicio"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha_apertura"),
        F.col("o_orderstatus").alias("estado"),
    )
    return spread_join(owned, people, ["cliente_id"]).orderBy("cliente_id", "producto_id")


def absences(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    reason = (c % 29).cast("int")
    hours = (k % 7 + F.when(reason.between(1, 14), 6).otherwise(0) + F.when(c % 4 == 0, 2).otherwise(0)).cast("int")
    return t.orders.select(
        k.alias("ID"),
        reason.alias("Reason for Absence"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date"),
        (k % 271 + 118).cast("int").alias("Transportation Expense"),
        (c % 48 + 5).cast("int").alias("Distance to Work"),
        (c % 32 + 27).cast("int").alias("Age"),
        (F.col("o_totalprice") / 1000).alias("Daily Work Load Average"),
        (k % 20 + 19).cast("int").alias("Body Mass Index"),
        (c % 4 + 1).cast("int").alias("Education"),
        (k % 5).cast("int").alias("Children"),
        (c % 6).cast("int").alias("Pets"),
        hours.alias(A.HOURS),
    )


@query(
    "absence_features",
    """select o_orderkey as "ID", (o_custkey % 29 between 1 and 14)::int as "Reason_1", (o_custkey % 29 between 15 and 17)::int as "Reason_2",
         (o_custkey % 29 between 18 and 21)::int as "Reason_3", (o_custkey % 29 >= 22)::int as "Reason_4",
         month(o_orderdate)::int as "Month_value", (isodow(o_orderdate) - 1)::int as "Day of the Week",
         (o_orderkey % 271 + 118)::int as "Transportation Expense", (o_custkey % 48 + 5)::int as "Distance to Work",
         (o_custkey % 32 + 27)::int as "Age", o_totalprice / 1000 as "Daily Work Load Average",
         (o_orderkey % 20 + 19)::int as "Body Mass Index", (o_custkey % 4 > 0)::int as "Education",
         (o_orderkey % 5)::int as "Children", (o_custkey % 6)::int as "Pets",
         (o_orderkey % 7 + (case when o_custkey % 29 between 1 and 14 then 6 else 0 end)
            + (case when o_custkey % 4 = 0 then 2 else 0 end))::int as "Absenteeism Time in Hours" from orders""",
)
def _(t):
    return A.absence_features(absences(t), ["ID"])


FLAGS = ["Reason_1", "Reason_2", "Reason_3", "Reason_4"]
SCALED = ["Reason_4", "Month_value", "Transportation Expense", "Age", "Body Mass Index", "Children", "Pets"]
PLAIN = ["Reason_1", "Reason_2", "Reason_3", "Education"]

# The features that the model uses, and its fit by gradient steps instead of Newton's.
ABSENCE_ROWS = """(select o_orderkey as "ID", (o_custkey % 29 between 1 and 14)::int as "Reason_1",
      (o_custkey % 29 between 15 and 17)::int as "Reason_2", (o_custkey % 29 between 18 and 21)::int as "Reason_3",
      (o_custkey % 29 >= 22)::int as "Reason_4", month(o_orderdate)::int as "Month_value",
      (o_orderkey % 271 + 118)::int as "Transportation Expense", (o_custkey % 32 + 27)::int as "Age",
      (o_orderkey % 20 + 19)::int as "Body Mass Index", (o_custkey % 4 > 0)::int as "Education",
      (o_orderkey % 5)::int as "Children", (o_custkey % 6)::int as "Pets",
      o_orderkey % 7 + (case when o_custkey % 29 between 1 and 14 then 6 else 0 end)
        + (case when o_custkey % 4 = 0 then 2 else 0 end) as hours from orders)"""
ABSENCE_FIT = (
    descent_sql(
        f"""rows as (select * from {ABSENCE_ROWS}),
   stats as (select median(hours) as middle, {", ".join(f'avg("{c}") as m{i}, stddev_pop("{c}") as s{i}' for i, c in enumerate(SCALED))} from rows),
   data as (select [1.0::double, {", ".join(f'"{c}"::double' for c in PLAIN)}, {", ".join(f'("{c}" - m{i}) / s{i}' for i, c in enumerate(SCALED))}] as x,
              (hours > middle)::int::double as y, * from rows, stats)""",
        12,
        2000,
        3,
        0.97,
    )
    + ", found as (select *, 1 / (1 + exp(-list_inner_product(w, x))) as p from walk, data where step = 2000)"
)


@query(
    "absence_scores",
    f"""{ABSENCE_FIT} select "ID", {", ".join(f'"{c}"' for c in [*PLAIN, *SCALED])}, round(p, 5) as "Probability", (p > 0.5)::int as "Prediction" from found""",
)
def _(t):
    """Train, score the raw rows, and keep their key."""
    model = A.train_absence(A.absence_features(absences(t)))
    return rounded(A.score_absence(absences(t), model, ["ID"]), ["Probability"], 5)


@query(
    "absence_report",
    f"""{ABSENCE_FIT} select "Age", round(avg(p), 5) as mean_probability, {", ".join(f'max("{c}") as "max_{c}"' for c in FLAGS)},
          count(*) as n_rows from found where "Age" not in (30, 58) group by 1""",
)
def _(t):
    """Train, score and report by age, with all four flags and two ages left out."""
    model = A.train_absence(A.absence_features(absences(t)))
    scored = A.score_absence(absences(t), model, ["ID"])
    return rounded(A.absence_report(scored, FLAGS, [30, 58]), ["mean_probability"], 5)


def known_absence_model():
    scaler = ColumnScaler(["Reason_4", "Month_value", "Transportation Expense", "Age", "Body Mass Index", "Children", "Pets"])
    scaler.stats = {
        "Reason_4": (0.6, 0.5),
        "Month_value": (6.5, 3.5),
        "Transportation Expense": (220.0, 67.0),
        "Age": (36.0, 6.5),
        "Body Mass Index": (27.0, 4.25),
        "Children": (1.0, 1.0),
        "Pets": (0.75, 1.25),
    }
    weights = [2.8, 0.9, 3.1, 0.8, 0.16, 0.6, -0.17, 0.27, -0.21, 0.35, -0.28]
    return ScoringModel(scaler, LogisticModel(A.MODEL_FEATURES, [0.0, 1.0], [-1.6], [weights]))


ABSENCE_SCORES = """(select *, 1 / (1 + exp(-(-1.6 + 2.8 * "Reason_1" + 0.9 * "Reason_2" + 3.1 * "Reason_3"
     + 0.8 * ("Reason_4" - 0.6) / 0.5 + 0.16 * ("Month_value" - 6.5) / 3.5 + 0.6 * ("Transportation Expense" - 220) / 67
     - 0.17 * ("Age" - 36) / 6.5 + 0.27 * ("Body Mass Index" - 27) / 4.25 - 0.21 * "Education"
     + 0.35 * ("Children" - 1) / 1 - 0.28 * ("Pets" - 0.75) / 1.25))) as p
   from (select o_orderkey as "ID", (o_custkey % 29 between 1 and 14)::int as "Reason_1",
      (o_custkey % 29 between 15 and 17)::int as "Reason_2", (o_custkey % 29 between 18 and 21)::int as "Reason_3",
      (o_custkey % 29 >= 22)::int as "Reason_4", month(o_orderdate)::int as "Month_value",
      (o_orderkey % 271 + 118)::int as "Transportation Expense", (o_custkey % 32 + 27)::int as "Age",
      (o_orderkey % 20 + 19)::int as "Body Mass Index", (o_custkey % 4 > 0)::int as "Education",
      (o_orderkey % 5)::int as "Children", (o_custkey % 6)::int as "Pets" from orders))"""


@query(
    "absence_scores_known_model",
    f"""select * exclude (p), round(p, 9) as "Probability", (p > 0.5)::int as "Prediction" from {ABSENCE_SCORES}""",
)
def _(t):
    """Raw records to features, probability and prediction with given coefficients."""
    return rounded(A.score_absence(absences(t), known_absence_model(), ["ID"]), ["Probability"], 9)


@query(
    "absence_report_known_model",
    f"""select "Age", round(avg(p), 9) as mean_probability, max("Reason_1") as "max_Reason_1", count(*) as n_rows
        from {ABSENCE_SCORES} group by 1""",
)
def _(t):
    scored = A.score_absence(absences(t), known_absence_model(), ["ID"])
    return rounded(A.absence_report(scored), ["mean_probability"], 9)


DOMAINS = {"control": ("k", "value"), "flexibility": ("half", "value")}


def experiment(t):
    return measured(t).withColumn("half", F.col("k") / 2)


@query("experiment_report")
def _(t):
    return X.experiment_report(experiment(t), "event_type", DOMAINS, "purchase", "error")


SCORES = """(select event_type as "group", 'control' as domain, k::double as pre, value as post from e
             union all select event_type, 'flexibility', k / 2.0, value from e)"""


EXPERIMENT = """with e as (select *, cast(json_extract_string(props, '$.k') as int) as k from events),
   l as (select domain, "group" as g, pre, post, post - pre as d from """ + SCORES + """),
   two as (select * from l where g in ('purchase', 'error')),
   paired as (select domain, g, count(*) as n, avg(d) / stddev_samp(d) * sqrt(count(*)) as s from l group by 1, 2),
   linear as (select domain, g, count(*) as n, corr(pre, post) as s from l group by 1, 2),
   ranked as (select domain, g, rank() over (partition by domain, g order by pre)
                + (count(*) over (partition by domain, g, pre) - 1) / 2.0 as a,
              rank() over (partition by domain, g order by post)
                + (count(*) over (partition by domain, g, post) - 1) / 2.0 as b from l),
   monotone as (select domain, g, count(*) as n, corr(a, b) as s from ranked group by 1, 2),
   logs as (select domain, g, ln(d) as x from l where d > 0 and d <> 1),
   signed as (select domain, g, x, rank() over (partition by domain, g order by abs(x))
                + (count(*) over (partition by domain, g, abs(x)) - 1) / 2.0 as r from logs),
   wilcoxon as (select domain, g, count(*) as n, sum(r) filter (x > 0) as s from signed group by 1, 2),
   moments as (select domain, count(*) filter (g = 'purchase') as na, count(*) filter (g = 'error') as nb,
                 avg(d) filter (g = 'purchase') as ma, avg(d) filter (g = 'error') as mb,
                 var_samp(d) filter (g = 'purchase') as va, var_samp(d) filter (g = 'error') as vb from two group by 1),
   student as (select domain, na + nb as n, (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)
                 * (1 / na + 1 / nb)) as s from moments),
   steps as (select domain, d, count(*) filter (g = 'purchase') as a, count(*) filter (g = 'error') as b from two group by 1, 2),
   walk as (select *, sum(a) over w as ca, sum(b) over w as cb, sum(a) over (partition by domain) as na,
              sum(b) over (partition by domain) as nb from steps window w as (partition by domain order by d)),
   whitney as (select domain, sum(a + b)::bigint as n, sum(a * (cb - b + b / 2.0)) as s from walk group by 1),
   smirnov as (select domain, sum(a + b)::bigint as n, max(abs(ca / na - cb / nb)) as s from walk group by 1),
   places as (select domain, g, d, rank() over (partition by domain order by d)
                + (count(*) over (partition by domain, d) - 1) / 2.0 as r,
              count(*) over (partition by domain, d) as t from l),
   sums as (select domain, g, count(*)::double as n, sum(r) as r, sum(t * t - 1.0) as ties from places group by 1, 2),
   wallis as (select domain, sum(n)::bigint as n, (12 / (sum(n) * (sum(n) + 1)) * sum(r * r / n) - 3 * (sum(n) + 1))
                / (1 - sum(ties) / (pow(sum(n), 3) - sum(n))) as s from sums group by 1),
   middle as (select domain, median(d) as m from two group by 1),
   cells as (select domain, count(*) filter (g = 'purchase' and d > m) as aa, count(*) filter (g = 'error' and d > m) as ab,
               count(*) filter (g = 'purchase' and d < m) as ba, count(*) filter (g = 'error' and d < m) as bb
             from two join middle using (domain) group by 1),
   fisher as (select domain, aa + ab + ba + bb as n, aa * bb / (ba * ab) as s from cells),
   own as (select domain, g, median(d) as m from two group by 1, 2),
   gaps as (select domain, g, abs(d - m) as z from two join own using (domain, g)),
   each as (select domain, g, count(*) as n, avg(z) as m, var_pop(z) as v from gaps group by 1, 2),
   grand as (select domain, sum(n * m) / sum(n) as mm from each group by 1),
   shape as (select domain, g, measure, count(x) as n, avg(pow(x - m, 3)) / pow(avg(pow(x - m, 2)), 1.5) as s
             from (select *, avg(x) over (partition by domain, g, measure) as m
                   from (select domain, g, unnest(['pre', 'post', 'diff']) as measure, unnest([pre, post, d]) as x from l))
             group by 1, 2, 3),
   slope as (select domain, g, count(*) as n, regr_slope(post, pre) as s from l group by 1, 2),
   mood as (select domain, n, n * pow(greatest(abs(aa * bb - ab * ba) - n / 2, 0), 2)
              / ((aa + ab) * (ba + bb) * (aa + ba) * (ab + bb)::double) as s
            from (select *, aa + ab + ba + bb as n from cells)),
   levene as (select domain, sum(n)::bigint as n, (sum(n) - 2) * sum(n * pow(m - mm, 2)) / sum(n * v) as s
              from each join grand using (domain) group by 1),
   lines as (select domain, 'paired_t' as test, g as about, n, s from paired
     union all select domain, 'pearson_pre_post', g, n, s from linear
     union all select domain, 'spearman_pre_post', g, n, s from monotone
     union all select domain, 'wilcoxon_log', g, n, s from wilcoxon
     union all select domain, 'independent_t', 'purchase / error', n, s from student
     union all select domain, 'mann_whitney', 'purchase / error', n, s from whitney
     union all select domain, 'kolmogorov_smirnov', 'purchase / error', n, s from smirnov
     union all select domain, 'fisher_median', 'purchase / error', n, s from fisher
     union all select domain, 'levene', 'purchase / error', n, s from levene
     union all select domain, 'mood_median', 'purchase / error', n, s from mood
     union all select domain, 'skewness_' || measure, g, n, s from shape
     union all select domain, 'line_pre_post', g, n, s from slope
     union all select domain, 'kruskal_wallis', 'all groups', n, s from wallis)
   select domain, test, about, n::bigint as n, round(s::double, 6) as statistic from lines"""


@query("experiment_statistics", EXPERIMENT)
def _(t):
    """The report's statistics; those of the normality test have a query of their own."""
    report = X.experiment_report(experiment(t), "event_type", DOMAINS, "purchase", "error")
    some = report.filter(~F.col("test").startswith("shapiro"))
    return rounded(some, ["statistic"]).select("domain", "test", "about", "n", "statistic")


PAIRS = f"""with e as (select *, cast(json_extract_string(props, '$.k') as int) as k from events),
   l as (select domain, "group" as g, post - pre as d from {SCORES}),
   asked as (select x.g as a, y.g as b from (select distinct g from l) x, (select distinct g from l) y where x.g < y.g),
   two as (select domain, a, b, g, d from asked join l on g = a or g = b),
   steps as (select domain, a, b, d, count(*) filter (g = a) as x, count(*) filter (g = b) as y from two group by all),
   walk as (select *, sum(x) over w as cx, sum(y) over w as cy, sum(x) over p as na, sum(y) over p as nb
            from steps window w as (partition by domain, a, b order by d), p as (partition by domain, a, b)),
   ranks as (select domain, a, b, max(na)::double as na, max(nb)::double as nb, sum(x * (cy - y + y / 2.0)) as u,
               sum(pow(x + y, 3) - (x + y)) as ties, max(abs(cx / na - cy / nb)) as d from walk group by 1, 2, 3),
   whitney as (select *, (greatest(u, na * nb - u) - na * nb / 2 - 0.5)
                 / sqrt(na * nb / 12 * ((na + nb + 1) - ties / ((na + nb) * (na + nb - 1)))) as z from ranks),
   moments as (select domain, a, b, count(*)::double as n, count(*) filter (g = a)::double as na, count(*) filter (g = b)::double as nb,
                 avg(d) filter (g = a) - avg(d) filter (g = b) as gap, var_samp(d) filter (g = a) as va,
                 var_samp(d) filter (g = b) as vb, median(d) as m, median(d) filter (g = a) as am, median(d) filter (g = b) as bm
               from two group by 1, 2, 3),
   student as (select *, gap / sqrt(((na - 1) * va + (nb - 1) * vb) / (n - 2)) as c, n - 2 as nu from moments),
   tested as (select *, c / sqrt(1 / na + 1 / nb) as t from student),
   cells as (select domain, a, b, count(*) filter (g = a and d > m) as aa, count(*) filter (g = b and d > m) as ab,
               count(*) filter (g = a and d < m) as ba, count(*) filter (g = b and d < m) as bb
             from two join moments using (domain, a, b) group by 1, 2, 3),
   sums as (select *, aa + ab as mk, aa + ba as dr, aa + ab + ba + bb as n from cells),
   mood as (select *, n * pow(greatest(abs(aa * bb - ab * ba) - n / 2, 0), 2)
              / ((aa + ab) * (ba + bb) * (aa + ba) * (ab + bb)::double) as chi from sums),
   fisher as (select domain, a, b, sum(exp(lgamma(mk + 1.0) - lgamma(i + 1.0) - lgamma(mk - i + 1.0) + lgamma(n - mk + 1.0)
                - lgamma(dr - i + 1.0) - lgamma(n - mk - dr + i + 1.0) - lgamma(n + 1.0) + lgamma(dr + 1.0) + lgamma(n - dr + 1.0))) as p
              from sums, lateral (select unnest(range(aa, least(mk, dr) + 1)) as i) group by 1, 2, 3),
   gaps as (select domain, a, b, g, abs(d - case when g = a then am else bm end) as z from two join moments using (domain, a, b)),
   each as (select domain, a, b, g, count(*)::double as n, avg(z) as m, var_pop(z) as v from gaps group by 1, 2, 3, 4),
   grand as (select domain, a, b, sum(n * m) / sum(n) as mm from each group by 1, 2, 3),
   levene as (select domain, a, b, sum(n) as n, (sum(n) - 2) * sum(n * pow(m - mm, 2)) / sum(n * v) as w, sum(n) - 2 as nu
              from each join grand using (domain, a, b) group by 1, 2, 3),
   lines as (
     select domain, a, b, 'mann_whitney' as test, na + nb as n, u as s, 2 * u / (na * nb) - 1 as effect, least(1, 2 * {normal_tail_sql("z")}) as p from whitney
     union all select domain, a, b, 'kolmogorov_smirnov', na + nb, d, d, null from ranks
     union all select domain, a, b, 'independent_t', n, t, c, 2 * {t_tail_sql("t", "nu")} from tested
     union all select domain, a, b, 'fisher_median', n, aa * bb / (ba * ab), aa * bb / (ba * ab), p from sums join fisher using (domain, a, b)
     union all select domain, a, b, 'mood_median', n, chi, null, 2 * {normal_tail_sql("sqrt(chi)")} from mood
     union all select domain, a, b, 'levene', n, w, null, {f_tail_sql("w", "1", "nu")} from levene)
   select domain, test, a || ' / ' || b as about, n::bigint as n, round(s::double, 6) as statistic,
     round(effect::double, 6) as effect, round(p::double, 5) as p_value from lines"""


@query("experiment_pairs", PAIRS)
def _(t):
    """Every pair of groups: statistics, effects and p-values (the distance test's has a query of its own)."""
    report = X.experiment_report(experiment(t), "event_type", DOMAINS)
    some = report.where(F.col("about").contains(" / "))
    p = F.when(F.col("test") != "kolmogorov_smirnov", F.round("p_value", 5))
    return rounded(some.withColumn("p_value", p), ["statistic", "effect"]).select(
        "domain", "test", "about", "n", "statistic", "effect", "p_value"
    )


@query(
    "experiment_change",
    f"""with e as (select *, cast(json_extract_string(props, '$.k') as int) as k from events),
        l as (select domain, "group", 'pre' as moment, pre as score from {SCORES}
              union all select domain, "group", 'post', post from {SCORES})
        select domain, "group", moment, round(avg(score), 6) as mean, round(median(score), 6) as median
        from l group by all""",
)
def _(t):
    return rounded(X.change_table(experiment(t), "event_type", DOMAINS), ["mean", "median"])


@query(
    "experiment_summary",
    f"""with e as (select *, cast(json_extract_string(props, '$.k') as int) as k from events),
        l as (select domain, "group", 'pre' as "column", pre as value from {SCORES}
              union all select domain, "group", 'post', post from {SCORES}
              union all select domain, "group", 'diff', post - pre from {SCORES})
        select domain, "group", "column", count(value) as count, round(avg(value), 6) as mean,
               round(stddev_samp(value), 6) as std, round(min(value), 6) as min, round(quantile_cont(value, 0.25), 6) as q25,
               round(quantile_cont(value, 0.5), 6) as q50, round(quantile_cont(value, 0.75), 6) as q75,
               round(max(value), 6) as max from l group by all""",
)
def _(t):
    found = X.experiment_summary(experiment(t), "event_type", DOMAINS)
    return rounded(found, ["mean", "std", "min", "q25", "q50", "q75", "max"])
