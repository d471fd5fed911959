"""S4 CSV folder round trip and header coercion."""

import gzip
import tempfile

import pytest

from mesura.operators.clean import coerce_types
from mesura.sources import files
from mesura.sources.files import read_csv_folder


def test_csv_folder_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="mesura-csv-")
    rows = [("5001.0", "3.0", "nan"), ("05002", "x", "B2"), (None, "7", "C1")]
    df = spark.createDataFrame(rows, "cod_mpio string, tip_vivienda string, Clasificacion string")
    df.coalesce(1).write.option("header", True).option("sep", ";").csv(f"{d}/a")
    df.coalesce(1).write.option("header", True).option("sep", ";").csv(f"{d}/b")
    got = read_csv_folder(spark, f"{d}/*")
    assert got.count() == 6
    assert all(r["Source.Name"].endswith(".csv") for r in got.collect())
    typed = coerce_types(got, ["tip_vivienda"]).orderBy("cod_mpio").collect()
    vals = sorted((r["cod_mpio"], r["tip_vivienda"], r["Clasificacion"]) for r in typed
                  if r["cod_mpio"] is not None)
    assert vals[0] == ("05001", 3, None) and vals[-1] == ("05002", None, "B2")


def test_csv_files_of_unlike_headers_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("cod_mpio;anio;Edad\n00001;2021;30\n")
    (tmp_path / "b.csv").write_text("﻿cod_mpio;Edad;anio;estado\n00002;31;2022;50\n;;2022;\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("ANIO;COD_MPIO;;anio\n2023;00003;x;y\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "_ignored.csv").write_text("q\n1\n")
    with gzip.open(tmp_path / "d.csv.gz", "wt") as f:
        f.write("Edad;cod_mpio;anio\n40;00004;2024\n")
    got = files.read_csv_folder(spark, str(tmp_path))
    rows = {r["cod_mpio"]: (r["anio"], r["Edad"], r["estado"], r["Source.Name"]) for r in got.collect()}
    assert rows == {"00001": ("2021", "30", None, "a.csv"), "00002": ("2022", "31", "50", "b.csv"), None: ("2022", None, None, "b.csv"),
                    "00003": ("2023", None, None, "c.csv"), "00004": ("2024", "40", None, "d.csv.gz")}
    assert {"_c2", "anio3"} <= set(got.columns)
    assert len(files.csv_headers(spark, str(tmp_path))) == 4


def test_a_folder_without_files_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_csv_folder(spark, str(tmp_path))
