"""One row per client from loans, demographics, digital behaviour and bank products.

Every data-dependent choice (levels, modes, empty dates, means) is one aggregation over all
columns concerned, so the number of Spark jobs does not grow with the number of columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_text
from ..operators.columns import drop_columns, first_columns, to_number
from ..operators.dateparts import DateParts, date_parts, to_date10
from ..operators.describe import collapse_by_key
from ..operators.encode import OneHot
from ..operators.impute import Impute, impute_by_role
from ..operators.names import clean_column_names, collapse_names, normalize_names, restore_names
from ..operators.recode import clean_percent, term_to_months
from ..operators.reshape import distinct_rows, union_by_name
from ..session import shared_dir
from ..sources.synth import sample_with_ids, with_ids

# fixed values: columns of the sources and name prefixes of their encoded columns
LOAN_DROP = [
    "member_id", "funded_amnt", "funded_amnt_inv", "grade", "subgrade",
    "verification_status", "emp_length", "home_ownership",
]
LOAN_NUMBERS = ["loan_amnt", "installment", "annual_inc"]
PERSON_LEVELS = ["ciudad", "empleador", "propiedad_vivienda"]
PERSON_NUMBERS = ["antiguedad_empleo_meses", "hijos", "vehiculos"]
PRODUCT_KEYS = [
    "servicios_contratados", "cliente_id", "annual_inc", "score_crediticio",
    "producto_id", "saldo_servicio", "fecha_apertura_servicio", "estado_servicio",
]
PRODUCT_LEVELS = ["servicios_contratados", "estado_servicio"]
PRODUCT_NUMBERS = ["annual_inc", "score_crediticio", "saldo_servicio"]
PREFIXES = [
    "ciudad_", "empleador_", "propiedad_vivienda_", "preferencia_canal_",
    "servicios_contratados_", "estado_servicio_",
]


@dataclass
class Sources:
    loans: DataFrame
    demographics: DataFrame
    behaviour: DataFrame
    products: DataFrame


def prepare_loans(df: DataFrame, sample: int | None = None, seed: int = 0) -> DataFrame:
    """Every loan under a running id in a seeded order; ``sample`` keeps only that many."""
    chosen = first_columns(df, "id", 17)
    if sample is None:
        some = with_ids(chosen, "id", "CL", seed)
    else:
        some = sample_with_ids(chosen, sample, "id", "CL", seed)
    clean = clean_percent(drop_columns(some, LOAN_DROP), "int_rate")
    dated = to_date10(to_number(clean, LOAN_NUMBERS), ["issue_d"])
    # without a sample the rows are those of the source, which needs no numbering to be looked at
    dates = DateParts(["issue_d"]).fit(to_date10(chosen, ["issue_d"]) if sample is None else dated)
    return term_to_months(dates.transform(dated), "term")


def prepare_demographics(df: DataFrame) -> DataFrame:
    clean = to_number(drop_columns(df, ["pais", "codigo_postal"]), PERSON_NUMBERS)
    full = Impute({c: "mode" for c in PERSON_LEVELS}).fit(clean).transform(clean)
    return OneHot(PERSON_LEVELS).fit(full).transform(full)


def prepare_behaviour(df: DataFrame) -> DataFrame:
    counted = df.withColumn("num_servicios_contratados", F.size("servicios_contratados"))
    clean = drop_columns(counted, ["servicios_contratados", "email"])
    clean = to_number(clean, ["dispositivos_activos", "frecuencia_login_mensual"])
    dated = date_parts(to_date10(clean, ["ultima_actividad"]), ["ultima_actividad"])
    return OneHot(["preferencia_canal"]).fit(dated).transform(dated)


def prepare_products(df: DataFrame) -> DataFrame:
    """Clean names and values, then one row per client.

    Numbers are averaged, flags take their maximum and the date is that of the earliest
    product; its parts are taken after the rows have been collapsed.
    """
    named = restore_names(collapse_names(normalize_names(df)), PRODUCT_KEYS)
    clean = drop_columns(named, ["nombre", "apellido", "ciudad", "producto_id"])
    opened = "fecha_apertura_servicio"
    clean = to_number(to_date10(clean, [opened]), PRODUCT_NUMBERS)
    clean = clean.withColumn("servicios_contratados", normalize_text("servicios_contratados"))
    # a date that no product has no client has either: learnt before the rows are collapsed
    dates = DateParts([opened]).fit(clean)
    encoder = OneHot(PRODUCT_LEVELS).fit(clean)
    coded, flags = encoder.transform(clean), encoder.column_names()
    rest = [c for c in coded.columns if c not in ("cliente_id", opened, *flags, *PRODUCT_NUMBERS)]
    one = collapse_by_key(
        coded, "cliente_id", PRODUCT_NUMBERS, flags, [opened], rest, [opened, *rest]
    )
    return dates.transform(one)


def merge(loans: DataFrame, people: DataFrame, behaviour: DataFrame, products: DataFrame) -> DataFrame:
    """Left joins around the people, then the product rows below them."""
    wide = people.join(behaviour, ["cliente_id"], "left")
    wide = wide.join(loans, F.col("cliente_id") == F.col("id"), "left")
    tables = [
        t.toDF(*clean_column_names(t.columns, PRODUCT_KEYS, PREFIXES)) for t in (wide, products)
    ]
    return drop_columns(union_by_name(*tables), ["id"])


def customer360(sources: Sources, sample: int | None = None, seed: int = 0) -> DataFrame:
    merged = merge(
        prepare_loans(sources.loans, sample, seed),
        prepare_demographics(sources.demographics),
        prepare_behaviour(sources.behaviour),
        prepare_products(sources.products),
    )
    # the merged table is needed three times (means, modes, result): written once, so that
    # the joins are not repeated and a lost executor costs a file read
    spark = merged.sparkSession
    path = shared_dir(spark, "merged")
    merged.write.parquet(path)
    stored = spark.read.schema(merged.schema).parquet(path)
    return distinct_rows(impute_by_role(stored, PREFIXES, "cliente_id").transform(stored))
