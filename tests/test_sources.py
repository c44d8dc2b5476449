from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from gearyard.operators import needs, views
from gearyard.session import scratch_dir
from gearyard.sources import exports
from gearyard.sources import tables as tb
from gearyard.sources.sample import AS_OF, sample_tables
from tests.compare import spark_rows
from tests.fixtures import values

FOLDER = "/root/testdata/sf0.001"


def test_stored_tables_give_the_same_needs(spark, tmp_path):
    sample = sample_tables(spark, FOLDER)
    tb.save_tables(sample, str(tmp_path))
    stored = tb.load_tables(spark, str(tmp_path))
    assert spark_rows(needs.needs_items(stored, AS_OF)) == spark_rows(needs.needs_items(sample, AS_OF))


def test_colocated_tables_join_items_without_a_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS yard LOCATION '{tmp_path / 'yard'}'")
    sample = sample_tables(spark, FOLDER)
    tb.save_colocated(sample, "yard", 4)
    stored = tb.load_colocated(spark, "yard", sample)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.unsold_items(stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert views.unsold_items(stored).count() == views.unsold_items(sample).count()


def test_ingest_replaces_and_reports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "tbl Réceptions.csv").write_text('a,b\n1,"x ""y"", z"\n2, kept \n', encoding="utf-8")
    (tmp_path / "in" / "aux.csv").write_text("c\n1.5\n", encoding="utf-8")
    (tmp_path / "in" / "notes.txt").write_text("no")
    for _ in range(2):
        got = exports.ingest_exports(spark, str(tmp_path / "in"), str(tmp_path / "out"), {"aux": "c double"})
        assert values(got, "table_name", "n_rows", "n_columns") == [("aux", 1, 1), ("tbl_Receptions", 2, 2)]
    stored = spark.read.parquet(str(tmp_path / "out" / "tbl_Receptions"))
    assert sorted(values(stored, "a", "b")) == [(1, 'x "y", z'), (2, " kept ")]


def test_ingest_of_an_empty_folder_fails(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        exports.ingest_exports(spark, str(tmp_path), str(tmp_path / "out"))


@pytest.mark.parametrize("header", ["Type moteur", " TYPE_MOTEUR ", "typeMoteur"])
def test_catalogue_header_spellings(spark, header):
    rows = spark.createDataFrame([("a", 1), (None, 2)], f"`{header}` string, price int")
    assert values(exports.catalogue_from(rows), "type_text", "price") == [("a", 1)]


def test_missing_columns_fail(spark):
    rows = spark.createDataFrame([(1,)], "other int")
    with pytest.raises(ValueError):
        exports.catalogue_from(rows)
    with pytest.raises(ValueError):
        exports.items_export_from(rows)


def test_csv_round_trip_keeps_quotes_and_spaces(spark, tmp_path):
    rows = spark.createDataFrame([(' "a", b ', 1)], "Type_Moteur string, n int")
    exports.write_csv(rows, str(tmp_path / "csv"))
    assert values(exports.read_catalogue(spark, str(tmp_path / "csv")), "type_text", "n") == [(' "a", b ', "1")]


def test_csv_keeps_empty_text_and_null_apart(spark, tmp_path):
    rows = spark.createDataFrame([("", 1, None), (None, None, 0.1)], "a string, b int, c double")
    exports.write_csv(rows, str(tmp_path / "csv"))
    back = exports.read_written_csv(spark, str(tmp_path / "csv"), rows.schema)
    assert sorted(values(back, "a", "b", "c"), key=str) == [("", 1, None), (None, None, 0.1)]


def test_csv_keeps_line_breaks_and_quotes(spark, tmp_path):
    rows = spark.createDataFrame([("a\nb", 1), ('c "d"\r\ne', 2), ("f", 3)], "type_moteur string, n int")
    exports.write_csv(rows, str(tmp_path / "in" / "x.csv"))
    back = exports.read_written_csv(spark, str(tmp_path / "in" / "x.csv"), rows.schema)
    assert len(back.collect()) == 3 and ("a\nb", 1) in values(back, "type_moteur", "n")
    assert exports.read_catalogue(spark, str(tmp_path / "in" / "x.csv")).count() == 3
    got = exports.ingest_exports(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert got.first().n_rows == 3


def test_ingest_finds_columns_by_name_and_refuses_what_does_not_fit(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text("b,a\n1,2\n")
    exports.ingest_exports(spark, str(tmp_path / "in"), str(tmp_path / "out"), {"x": "a int, b int"})
    row = spark.read.parquet(str(tmp_path / "out" / "x")).first()
    assert (row.a, row.b) == (2, 1)
    with pytest.raises(ValueError):
        exports.ingest_exports(spark, str(tmp_path / "in"), str(tmp_path / "out"), {"x": "a int, c int"})
    (tmp_path / "in" / "A b.csv").write_text("a\n1\n")
    (tmp_path / "in" / "A_b.csv").write_text("a\n2\n")
    with pytest.raises(ValueError):
        exports.ingest_exports(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def test_every_line_of_an_item_is_a_dispatch(spark):
    sample = sample_tables(spark, FOLDER)
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_orderkey")
    owned = lines.join(sample["items"], lines["l_orderkey"] == sample["items"]["item_id"], "left_semi").count()
    assert sample["dispatches"].count() == owned
    for rule in (views.LATEST, views.EXISTS):
        assert views.live_stock(sample, rule=rule).count() > 0


def test_a_query_cannot_write(spark, tmp_path):
    spark.createDataFrame([(1,)], "n int").write.mode("overwrite").format("parquet").saveAsTable("wt")
    with pytest.raises(Exception):
        tb.run_query(spark, "WITH q AS (SELECT 5 AS n) INSERT INTO wt SELECT n FROM q")
    assert spark.table("wt").count() == 1
    assert tb.run_query(spark, "SELECT 2 AS n -- the end").first().n == 2
    assert tb.run_query(spark, "SELECT 2 AS n;").first().n == 2


def test_only_reads_are_allowed(spark):
    views.register_views(sample_tables(spark, FOLDER))
    for text in ("DROP TABLE items", "", "insert into x values (1)"):
        with pytest.raises(ValueError):
            tb.run_query(spark, text)
    got = tb.run_query(spark, "with t as (select :n as n) select n from t", {"n": 3})
    assert got.first().n == 3


def test_select_existing(spark):
    assert tb.select_existing(spark.range(1), ["x", "id"]).columns == ["id"]


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_stored_dispatches_are_clustered_by_time(spark, tmp_path):
    sample = sample_tables(spark, FOLDER)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tb.save_tables(sample, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    stored = spark.read.parquet(str(tmp_path / "dispatches"))
    spans = stored.filter("validated_at is not null").groupBy(F.input_file_name()).agg(
        F.min("validated_at").alias("low"), F.max("validated_at").alias("high")
    ).orderBy("low").collect()
    assert len(spans) > 1
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))


def test_peek(spark):
    assert tb.table_peek(spark.range(9)).count() == 5
    assert [r.id for r in tb.table_peek(spark.range(9), ["id"], 2).collect()] == [0, 1]


def test_readers_take_other_formats(spark, tmp_path):
    spark.createDataFrame([("a",)], "typemoteur string").write.parquet(str(tmp_path / "c"))
    assert exports.read_catalogue(spark, str(tmp_path / "c"), "parquet").count() == 1
    spark.createDataFrame([(1, "a")], "N_TypeMoteur int, CodeMoteur string").write.parquet(str(tmp_path / "i"))
    assert exports.read_items_export(spark, str(tmp_path / "i"), "parquet").columns == ["type_id", "code"]
