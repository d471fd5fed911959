"""Kept tables: row groups, bitmaps, yearly bases, export by runs."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from mesura import table_queries as TQ
from mesura.operators import export
from mesura.plans.context import FilterContext
from mesura.plans.distinct import distinct_by_sets
from mesura.plans.evaluate import evaluate, q, rounded
from mesura.plans.prefix import Scratch
from mesura.plans.yearly import YearlyBases
from mesura.sources import footers
from mesura.sources.tables import TABLES
from mesura.sources.survey import fact

SF = "/root/testdata/sf0.001"


def test_row_groups_equal_the_footers(spark, tmp_path):
    many = str(tmp_path / "many")
    (spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") * 0.5).alias("x"), F.lit(None).cast("int").alias("none"),
                                F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("day"), F.col("id").cast("string").alias("name"))
     .repartition(3).write.option("parquet.block.size", 30_000).option("parquet.block.size.row.check.min", 100).parquet(many))
    tables = {t: f"{SF}/{t}.parquet" for t in TABLES} | {"many": many}
    got = footers.row_groups(spark, tables).select("table_name", "file", "row_group", "row_count", "total_bytes", F.explode("columns").alias("c"))
    got = {(r["table_name"], os.path.basename(r["file"]), r["row_group"], r["c"]["column_name"].replace(".", ", ")):
           (r["row_count"], r["total_bytes"], r["c"]["null_count"], r["c"]["compressed_bytes"], r["c"]["low_number"], r["c"]["high_number"]) for r in got.collect()}
    want = {}
    for t, path in tables.items():
        for r in duckdb.sql(f"""SELECT file_name, row_group_id, path_in_schema, row_group_num_rows, row_group_bytes, stats_null_count, total_compressed_size,
                CASE WHEN type IN ('INT64', 'DOUBLE') THEN TRY_CAST(stats_min AS DOUBLE) END, CASE WHEN type IN ('INT64', 'DOUBLE') THEN TRY_CAST(stats_max AS DOUBLE) END
                FROM parquet_metadata('{path if path.endswith('.parquet') else path + '/*.parquet'}')""").fetchall():
            want[(t, os.path.basename(r[0]), r[1], r[2])] = r[3:]
    assert set(got) == set(want) and len({k[2] for k in got if k[0] == "many"}) > 1
    for k, w in want.items():
        assert got[k][:2] == w[:2] and got[k][3] == w[3], k
        assert w[2] is None or got[k][2] == w[2], k
        if w[4] is not None and got[k][4] is not None:
            assert got[k][4:] == pytest.approx(w[4:]), k
    facts = {r["column_name"]: tuple(r)[2:] for r in footers.number_facts(footers.row_groups(spark, {"many": many})).collect()}
    assert facts == {"id": (20_000, 0, 0.0, 19_999.0), "x": (20_000, 6_667, 0.5, 9_999.5), "none": (20_000, 20_000, None, None)}


def test_row_groups_of_no_files(spark, tmp_path):
    os.makedirs(tmp_path / "none")
    assert footers.row_groups(spark, {"none": str(tmp_path / "none")}).count() == 0


def test_bitmaps_merge(spark):
    rows = [(None if k % 7 == 0 else k % 7, "xy"[k % 2], None if k % 11 == 0 else (k * 7919) % 90_000 - 40_000, 1 if k % 5 else None) for k in range(3_000)] + [(9, "z", None, None)]
    df = spark.createDataFrame(rows, "a int, b string, i long, j long")
    sets = [["a", "b"], ["a"], ["b"], []]
    got = {(r["a"], r["a_total"], r["b"], r["b_total"]): (r["i"], r["j"]) for r in distinct_by_sets(df, sets, {"i": q("i"), "j": q("j")}, Scratch(spark, "t")).collect()}
    want: dict = {}
    for a, b, i, j in rows:
        for s in sets:
            own = want.setdefault((a if "a" in s else None, "a" not in s, b if "b" in s else None, "b" not in s), (set(), set()))
            own[0].update([i] if i is not None else [])
            own[1].update([j] if j is not None else [])
    assert got == {k: (len(i), len(j)) for k, (i, j) in want.items()}
    none = distinct_by_sets(df.limit(0), [["a"], []], {"i": q("i")}, Scratch(spark, "t")).collect()
    assert [tuple(r) for r in none] == [(None, True, 0)]


@pytest.fixture(scope="module")
def by_year(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("yearly"))
    f = fact(spark, SF)
    f.filter("anio in (1995, 1997)").write.partitionBy("anio").parquet(f"{folder}/fact")
    return folder, f


def test_adding_a_year_reads_that_year(spark, by_year, monkeypatch):
    folder, f = by_year
    bases = YearlyBases(spark, f"{folder}/fact", f.schema, f"{folder}/bases")
    read = []
    rows = YearlyBases.rows
    monkeypatch.setattr(YearlyBases, "rows", lambda self, year: read.extend(rows(self, year).inputFiles()) or rows(self, year))
    assert bases.table().count() == 0
    assert bases.refresh() == ["1995", "1997"] and bases.refresh() == []
    f.filter("anio = 1999").write.mode("append").partitionBy("anio").parquet(f"{folder}/fact")
    read.clear()
    assert bases.refresh() == ["1999"]
    assert read and all("/anio=1999/" in file for file in read)
    f.filter("anio = 1997").limit(5).write.mode("append").partitionBy("anio").parquet(f"{folder}/fact")  # a year that changes
    assert bases.refresh() == ["1997"]
    whole = spark.read.schema(f.schema).option("basePath", f"{folder}/fact").parquet(f"{folder}/fact")
    names = [n for n in TQ.YEARLY_MEASURES]
    for keys, ctx in ((["anio", "Subregion"], None), (["Municipio"], FilterContext.of(Subregion=["ASIA", "EUROPE"])), ([], FilterContext.of(anio=1997))):
        assert bases.answers(keys, names, ctx)
        got, want = (sorted(map(tuple, rounded(x).collect()), key=str) for x in (bases.evaluate(keys, names, ctx), evaluate(whole, keys, names, ctx)))
        assert got == want
    bases.vacuum()
    assert bases.refresh() == [] and len(os.listdir(f"{folder}/bases/anio=1997")) == 1


def test_other_questions_go_to_the_fact(spark, by_year):
    folder, f = by_year
    bases = YearlyBases(spark, f"{folder}/fact", f.schema, f"{folder}/bases")
    assert not bases.answers(["grupo_sisben"], ["persons"])
    assert not bases.answers(["anio"], ["mean_rooms"]) and not bases.answers(["anio"], ["distinct_classes"])
    assert not bases.answers(["anio"], ["persons"], FilterContext.of(Zona="Rural"))
    whole = spark.read.schema(f.schema).option("basePath", f"{folder}/fact").parquet(f"{folder}/fact")
    got, want = (sorted(map(tuple, rounded(x).collect()), key=str) for x in (bases.evaluate(["grupo_sisben"], ["persons", "mean_rooms"]), evaluate(whole, ["grupo_sisben"], ["persons", "mean_rooms"])))
    assert got == want


def test_export_rewrites_by_municipality(spark, tmp_path):
    out = str(tmp_path / "out")
    schema = "cod_mpio string, v long"
    first = spark.createDataFrame([("05001", k) for k in range(40)] + [("05002", 1), ("05003", 2), (None, 3), ("5-4", 4)], schema)
    names = {"05001": "San José", "05002": "La Ceja"}
    assert export.written_files(spark, out).count() == 0 and export.read_extract(spark, out, first.schema).count() == 0
    export.write_extract(spark, first, names, out, max_records=30)
    before = {r["file_name"]: r["path"] for r in export.written_files(spark, out).collect()}
    assert {"mpio_05001_SAN_JOSE_ultimo_anio.csv", "mpio_05002_LA_CEJA_ultimo_anio.csv", "mpio_05003_COD05003_ultimo_anio.csv", "sin_municipio_ultimo_anio.csv"} <= set(before)
    assert sorted(map(tuple, export.read_extract(spark, out, first.schema).collect()), key=str) == sorted(map(tuple, first.collect()), key=str)

    again = spark.createDataFrame([("05001", 100), ("05002", 200), (None, 300)], schema)
    export.write_extract(spark, again, names, out)
    after = {r["file_name"]: r["path"] for r in export.written_files(spark, out).collect()}
    assert after["mpio_05003_COD05003_ultimo_anio.csv"] == before["mpio_05003_COD05003_ultimo_anio.csv"]
    assert not any("05001" in f and "parte" in f for f in after)  # a second file of the first run is gone with the first
    got = sorted(map(tuple, export.read_extract(spark, out, first.schema).collect()), key=str)
    assert got == sorted([("05001", 100), ("05002", 200), ("05003", 2), (None, 300), ("5-4", 4)], key=str)

    export.write_run(spark, spark.createDataFrame([("05003", 9)], schema), names, out)  # breaks off before its manifest
    assert {r["file_name"]: r["path"] for r in export.written_files(spark, out).collect()} == after
    assert sorted(map(tuple, export.read_extract(spark, out, first.schema).collect()), key=str) == got
    with pytest.raises(OSError):  # another run took the number
        export.publish(spark, again.select("cod_mpio", F.lit("x").alias("file_name"), F.lit("x").alias("path")), out, 1)
    export.remove_unlisted(spark, out)
    assert sorted(map(tuple, export.read_extract(spark, out, first.schema).collect()), key=str) == got
    assert len([d for d in os.listdir(out) if d.startswith("run-")]) == 2 and os.listdir(f"{out}/_manifest").count("2") == 1
