"""Readers, scripts, staging and incremental loads."""

import datetime

import pytest

from tallgrain.plans.bank import run_bank_job
from tallgrain.plans.staging import BEHAVIOUR_SCHEMA, Source, stage_all
from tallgrain.session import shared_root
from tallgrain.sources import files, script, tables
from tallgrain.streaming.ingest import ingest_counts, ingest_new, read_counts

from .conftest import rows


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_is_text_and_short_lines_are_corrupt(spark, tmp_path):
    path = put(tmp_path / "a.csv", "id,name\n1,x\n2\n3,y,z\n4,w\n")
    raw = files.read_csv(spark, path)
    assert dict(raw.dtypes)["id"] == "string"
    good, watch = files.split_corrupt(raw, "csv")
    assert rows(good) == [("1", "x"), ("4", "w")]
    assert watch.get == {"n_rows": 4, "n_corrupt": 2}
    assert len(files.corrupt_rows(raw).collect()) == 2


def test_csv_dates_types_and_delimiter(spark, tmp_path):
    path = put(tmp_path / "a.csv", "d;n\n02/28/2020;5\n13/01/2020;x\n")
    got = files.read_csv(spark, path, sep=";", dates={"d": "MM/dd/yyyy"}, dtypes={"n": "int"})
    assert rows(got.select("d", "n")) == [(None, None), (datetime.date(2020, 2, 28), 5)]


def test_titled_csv(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'Title, of 2024\nid,"the name"\n1,"a, b"\n2,c\n\n')
    got = files.read_csv(spark, path, skip_rows=1).drop(files.CORRUPT)
    assert got.columns == ["id", "the name"] and rows(got) == [("1", "a, b"), ("2", "c")]
    typed = files.read_csv(spark, path, "id int, name string", skip_rows=1).drop(files.CORRUPT)
    assert rows(typed) == [(1, "a, b"), (2, "c")]
    with pytest.raises(ValueError, match="no header"):
        files.read_csv(spark, put(tmp_path / "e.csv", "one\n"), skip_rows=3)


def test_json_corrupt(spark, tmp_path):
    path = put(tmp_path / "a.json", '{"a": 1}\n{"a": \n{"a": 3}\n')
    good, watch = files.split_corrupt(files.read_json(spark, path, "a int"))
    assert rows(good) == [(1,), (3,)] and watch.get["n_corrupt"] == 1
    inferred, _ = files.split_corrupt(files.read_json(spark, path))
    assert rows(inferred) == [(1,), (3,)]


def test_script_splitting():
    text = """-- a; comment
        select 'x;y', "n;m" /* b; */ , `k;l`;;
        select 'it''s; fine' - 1 / 2
    """
    got = script.statements(text)
    assert len(got) == 2 and "'x;y'" in got[0] and "b;" not in got[0]
    assert got[1] == "select 'it''s; fine' - 1 / 2"


def test_script_result(spark, tmp_path):
    text = f"""
        create database if not exists s_test location '{tmp_path}/s';
        create table s_test.t (a int, b string) using parquet;
        insert into s_test.t values (1, 'x;'), (2, null);
        select count(*) as n from s_test.t;
        select b from s_test.t where a = 1;
    """
    assert rows(script.run_script(spark, text)) == [("x;",)]
    assert script.run_script(spark, "drop table s_test.t") is None


def test_table_write_and_fallback(spark, tmp_path):
    tables.ensure_database(spark, "w_test", f"{tmp_path}/db")
    tables.ensure_database(spark, "w_test")
    for n in (3, 5):
        tables.write_table(spark.range(n), "w_test", "t", f"{tmp_path}/t")
    assert spark.table("w_test.t").count() == 5
    assert tables.table_or_empty(spark, "w_test.t", "id bigint").count() == 5
    none = tables.table_or_empty(spark, "w_test.none", "id bigint")
    assert none.columns == ["id"] and none.count() == 0


def test_result_both_ways(spark, tmp_path):
    df = spark.sql("select 1 as a, date'2024-01-01' as d, cast(2.5 as decimal(12,2)) as m")
    files.write_result(df, f"{tmp_path}/r")
    schema = "a int, d date, m decimal(12,2)"
    assert rows(files.read_csv(spark, f"{tmp_path}/r_csv", schema).drop(files.CORRUPT)) == rows(df)
    assert rows(files.read_json(spark, f"{tmp_path}/r_json", schema).drop(files.CORRUPT)) == rows(df)


def test_ingest_loads_each_file_once(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{d}" for d in ("in", "out", "mark"))
    spark.range(100).write.parquet(src)
    assert ingest_new(spark, src, out, mark, "id bigint") == 100
    assert ingest_new(spark, src, out, mark, "id bigint") == 0
    spark.range(100, 150).write.mode("append").parquet(src)
    prepared = ingest_new(
        spark, src, out, mark, "id bigint", prepare=lambda d: d.filter("id % 2 = 0"), max_files=1
    )
    assert prepared == 50
    assert spark.read.parquet(out).count() == 125


def test_ingest_counts_in_batches(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{d}" for d in ("in", "out", "mark"))
    spark.range(0, 90, 1, 3).selectExpr("id % 2 as k").write.parquet(src)
    ingest_counts(spark, src, out, mark, "k bigint", ["k"], max_files=1)
    ingest_counts(spark, src, out, mark, "k bigint", ["k"], max_files=1)
    spark.range(7).selectExpr("id % 2 as k").write.mode("append").parquet(src)
    ingest_counts(spark, src, out, mark, "k bigint", ["k"])
    assert rows(read_counts(spark, out, ["k"])) == [(0, 49), (1, 48)]


def test_staging(spark, tmp_path):
    people = put(tmp_path / "people.csv", "cliente_id,pais\nCL001,CO\nbroken\n")
    done = stage_all(
        spark,
        {
            "people": Source(people, "csv"),
            "behaviour": Source(f"{tmp_path}/none.json", "json", BEHAVIOUR_SCHEMA),
        },
        f"{tmp_path}/out",
        "staging_test",
    )
    assert (done["people"].n_rows, done["people"].n_corrupt) == (2, 1)
    assert rows(spark.table(done["people"].table)) == [("CL001", "CO")]
    assert spark.table(done["behaviour"].table).count() == 0
    with pytest.raises(FileNotFoundError):
        stage_all(spark, {"x": Source(f"{tmp_path}/none.csv", "csv")}, f"{tmp_path}/o2", "staging_test")


def test_shared_root_is_the_session_setting(spark):
    class Named:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.checkpoint.dir": "s3a://b/c/"}.get(key, default))

    assert shared_root(Named) == "s3a://b/c"
    assert shared_root(spark) == shared_root(spark)


def test_titled_csv_drops_top_lines_by_place_only(spark, tmp_path):
    for name, title in (("a.csv", "Total"), ("b.csv", "Other")):
        (tmp_path / name).write_text(f"{title}\nid,name\n1,a\n{title}\nid,name\n2,b\n")
    got = files.read_csv(spark, str(tmp_path), skip_rows=1)
    assert sorted(r["id"] for r in got.collect()) == ["1", "1", "2", "2", "Other", "Total", "id", "id"]


def test_ingest_counts_all_batches(spark, tmp_path):
    spark.range(130).repartition(130).write.parquet(str(tmp_path / "in"))
    n = ingest_new(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), "id long", max_files=1
    )
    assert n == 130 == spark.read.parquet(str(tmp_path / "out")).count()


def test_a_table_is_swapped_for_another(spark, tmp_path):
    tables.ensure_database(spark, "swap_test", f"{tmp_path}/swap_test.db")
    name = tables.swap_table(spark.range(3), "swap_test", "t", str(tmp_path))
    before = spark.table(name)
    assert before.count() == 3
    grown = spark.table(name).unionByName(spark.range(10, 12))  # reads what it replaces
    assert tables.swap_table(grown, "swap_test", "t", str(tmp_path)) == name
    assert rows(spark.table(name)) == [(0,), (1,), (10,), (11,), (2,)]
    tables.swap_table(spark.range(1).selectExpr("id", "'x' as y"), "swap_test", "t", str(tmp_path))
    assert spark.table(name).columns == ["id", "y"] and spark.table(name).count() == 1
    with pytest.raises(Exception, match="no_such_column"):
        tables.swap_table(spark.range(2).selectExpr("no_such_column"), "swap_test", "t", str(tmp_path))
    assert spark.table(name).count() == 1


def test_bank_job_needs_its_sources(spark, tmp_path):
    with pytest.raises(ValueError, match="products"):
        run_bank_job(spark, {"loans": Source("x", "csv"), "demographics": Source("x", "csv"), "behaviour": Source("x", "csv")}, str(tmp_path))
