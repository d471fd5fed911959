"""Header rules, typing, file sources, projections, export and the composed
survey ETL on hand-made files."""

import os

import pytest
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.operators import clean, etl, export, projections, quality, territory
from mesura.sources.files import parquet_facts, read_population_csv
from mesura.sources.survey import SURVEY_COLUMNS


def test_survey_headers():
    names = ["IND_DISCAP_BA?ARSE", "tip_cuidado_niÃ±os", "NUM_EVENTO_VENDAVAL", "ind_evento_vendaval", "Edad"]
    assert clean.canonical_names(names, S.SURVEY_HEADERS) == {
        "IND_DISCAP_BA?ARSE": "ind_discap_bañarse", "tip_cuidado_niÃ±os": "tip_cuidado_niños", "NUM_EVENTO_VENDAVAL": "Num_evento_vendaval"}
    with pytest.raises(ValueError, match="bañarse"):
        clean.canonical_names(["ind_discap_bañarse", "ind_discap_ba?arse"], S.SURVEY_HEADERS)


def test_population_headers():
    names = ["DPMP", "A?O", "GENERO", "ÁREA GEOGRÁFICA", "EDAD_NUM", "POB", "OTHER"]
    assert clean.canonical_names(names, S.POPULATION_HEADERS) == {
        "A?O": "AÑO", "GENERO": "Genero", "ÁREA GEOGRÁFICA": "AREA_TXT", "EDAD_NUM": "Edad_Num", "POB": "Pob"}


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
def test_population_csv_in_either_encoding(spark, tmp_path, encoding):
    file = tmp_path / "pob.csv"
    file.write_bytes("DPMP,AÑO,GENERO,ÁREA GEOGRÁFICA,EDAD_NUM,POB\n5001,2021,Hombres,Cabecera Municipal,3,10\n5001,2021,Mujeres,Rural,,5\n5001,2020,Mujeres,Rural,4,5\n".encode(encoding))
    raw = read_population_csv(spark, str(file))
    assert "AÑO" in raw.columns
    got = projections.population_by_band(raw, [2021]).collect()
    assert sorted((r["cod_mpio"], r["Cod_clase"], r["sexo_persona"], r["Rango_Edad"], r["Poblacion_Proyectada"]) for r in got) == [
        ("05001", 1, 1, "00-04", 10), ("05001", 3, 2, S.UNKNOWN, 5)]


def test_unreadable_population_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("AÑO\n1\n".encode("ISO-8859-1"))
    with pytest.raises(ValueError, match="no encoding"):
        read_population_csv(spark, str(tmp_path / "x.csv"), ("UTF-8",))


def test_projection_years_come_from_the_sheet(spark):
    wide = spark.createDataFrame([("5", "5001.0", "Cabecera", 1.5, 2.5, None), ("8", "8001", "Total", 1.0, 1.0, 1.0)],
                                 "cod_dpto string, cod_mpio string, Area string, `2018` double, `2042` double, `2043` double")
    got = projections.wide_to_long(wide, "v", "05", range(2018, 2050)).collect()
    assert sorted(tuple(r) for r in got) == [("05001", 2018, 1, 2), ("05001", 2042, 1, 2)]


def test_crosstab_counts_every_row(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "x"), (1, None), (2, "a")], "k long, m string")
    got = {r["k"]: tuple(r)[1:] for r in quality.crosstab_wide(df, "k", "m", ["a", "b"]).collect()}
    assert got == {1: (1, 1, 2), 2: (1, None, None)}


def test_schema_conformance_and_footer_facts(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x"), (2, "y")], "A long, extra string").write.parquet(path)
    got = {(r["expected"], r["actual"], r["status"]) for r in quality.schema_conformance(spark, ["a", "gone"], path).collect()}
    assert got == {("a", "A", "case"), ("gone", None, "missing"), (None, "extra", "extra")}
    assert {tuple(r) for r in parquet_facts(spark, path).collect()} == {("A", "bigint", 0, 2), ("extra", "string", 1, 2)}


def test_name_join_is_deterministic(spark):
    dim = spark.createDataFrame([("05001", "Medellín"), ("05002", "Nowhere"), ("05003", "El Peñol")], "cod_mpio string, nom_mpio string")
    files = spark.createDataFrame([("ELPENOL b",), ("DISTRITO ESPECIAL DE CIENCIA, TECNOLOGIA E INNOVACION DE MEDELLIN",), ("El  penol",), ("EL PENOL",)], "file_name string")
    got = {r["cod_mpio"]: r["matched_file"] for r in territory.normalised_name_join(dim, files, spark).collect()}
    assert got == {"05001": "DISTRITO ESPECIAL DE CIENCIA, TECNOLOGIA E INNOVACION DE MEDELLIN", "05002": "", "05003": "EL PENOL"}


def test_export_writes_the_linked_files(spark, tmp_path):
    rows = [("05001", 2020, k) for k in range(50)] + [("05002", 2020, k) for k in range(3)] + [("05003", 2020, 1), ("05001", 2019, 9)]
    df = spark.createDataFrame(rows, "cod_mpio string, anio long, v long").where("anio = 2020")
    out = str(tmp_path / "export")
    export.write_extract(spark, df, {"05001": "San José", "05002": "La Ceja"}, out, max_records=20)
    files = {r["file_name"]: r["path"] for r in export.written_files(spark, out).collect()}
    assert {"mpio_05001_SAN_JOSE_ultimo_anio.csv", "mpio_05002_LA_CEJA_ultimo_anio.csv", "mpio_05003_COD05003_ultimo_anio.csv"} <= set(files)
    assert sum("05001" in f for f in files) >= 3  # a large municipality has several files
    cat = {r["cod_mpio"]: r for r in export.catalogue(export.written_files(spark, out), "https://x/").collect()}
    assert [cat[k]["nom_mpio"] for k in sorted(cat)] == ["SAN JOSE", "LA CEJA", "COD05003"]
    for r in cat.values():
        name = r["Url_Descarga"].removeprefix("https://x/").removesuffix("?download=1")
        head = open(f"{out}/{files[name]}", encoding="utf-8").readline().strip()
        assert head == "cod_mpio,anio,v"
    back = spark.read.option("header", True).csv(f"{out}/run-*/mpio_*.csv")
    assert back.count() == 54 and back.where("cod_mpio = '05001'").count() == 50
    assert cat["05001"]["Url_Informe"] == "informe_05001_SAN_JOSE.pdf?download=1"


def test_survey_etl(spark, tmp_path):
    names = [n for n, _, _ in SURVEY_COLUMNS if n != "Source.Name"]
    damaged = {"ind_discap_bañarse": "ind_discap_ba?arse", "tip_cuidado_niños": "TIP_CUIDADO_NI?OS", "Num_evento_vendaval": "num_evento_vendaval"}
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, rows, drop=()):
        cols = [c for c in names if c not in drop]
        with open(folder / name, "w", encoding="utf-8") as f:
            f.write(";".join(damaged.get(c, c) for c in cols) + "\n")
            for r in rows:
                f.write(";".join(str(r.get(c, "")) for c in cols) + "\n")

    write("a.csv", [{"cod_mpio": "5001.0", "anio": "2020", "Edad": "3.7", "I1": "nan", "Clasificacion": "A1", "tip_vivienda": "1.0", "ind_discap_bañarse": "2"},
                    {"cod_mpio": "5001", "anio": "2021", "Edad": "30", "I1": "x", "Clasificacion": "nan", "tip_vivienda": "7"}])
    write("b.csv", [{"cod_mpio": "nan", "anio": "2021", "Edad": "", "tip_parentesco": "1", "sexo_persona": "2", "Num_evento_vendaval": "4"}])
    out = str(tmp_path / "out")
    report = etl.run_survey_etl(spark, str(folder), out, names)
    assert sorted(map(tuple, report.collect())) == [("a.csv", 2, 2), ("b.csv", 1, 0)]
    got = spark.read.parquet(out).orderBy("anio", "cod_mpio").collect()
    assert [(r["cod_mpio"], r["anio"], r["Edad"], r["I1"], r["Clasificacion"], r["tip_vivienda"]) for r in got] == [
        ("05001", 2020, None, None, "A1", 1), (None, 2021, None, None, None, None), ("05001", 2021, 30, None, None, 7)]
    assert got[0]["ind_discap_bañarse"] == 2 and got[1]["Num_evento_vendaval"] == 4 and got[1]["Sexo_Jefe_Label"] == "Mujer jefe"
    assert got[0]["Tipo_Vivienda_txt"] == "Casa" and got[2]["Rango_Edad"] == "30-34"
    assert sorted(d for d in os.listdir(out) if d.startswith("anio=")) == ["anio=2020", "anio=2021"]


def test_two_streams_do_not_share_a_log(spark, tmp_path):
    from mesura.sources.survey import survey_view
    from mesura.streaming.incremental import enrich_stream
    view = survey_view(spark, "/root/testdata/sf0.001").limit(20)
    for k in ("x", "y"):
        view.write.parquet(f"{tmp_path}/in_{k}")
        enrich_stream(spark, f"{tmp_path}/in_{k}", f"{tmp_path}/out_{k}", view.schema).awaitTermination(120)
        assert spark.read.parquet(f"{tmp_path}/out_{k}").agg(F.count("*")).first()[0] == 20
