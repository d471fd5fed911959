"""Column helpers and derived columns on hand-made frames (every listed
code, an unknown code and null)."""

from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.functions.blank import blank_count, blank_sub, div, div0, selected_value, distinct_count_with_blank
from mesura.functions.labels import age_band, age_order, label, lenient_long, norm_code, null_text
from mesura.functions.text import normalise_name
from mesura.operators.derive import enrich


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_lenient_long(spark):
    vals = ["nan", "12.0", "x", "3.7", "5", None, "inf", "-4.0", " 7 ", "", "9007199254740993", "9223372036854775808"]
    out = one(spark, lenient_long(F.col("v")), [(v,) for v in vals], "v string")
    assert out == [None, 12, None, None, 5, None, None, -4, 7, None, 9007199254740993, None]


def test_null_text(spark):
    out = one(spark, null_text(F.col("v")), [("nan",), ("None",), ("<NA>",), (None,), ("A1",)], "v string")
    assert out == [None, "None", "<NA>", None, "A1"]


def test_norm_code(spark):
    out = one(spark, norm_code(F.col("v")), [("5001",), ("5001.0",), ("05001",), (None,), ("nan",), ("123456",)],
              "v string")
    assert out == ["05001", "05001", "05001", None, None, "123456"]


def test_age_bands(spark):
    ages = [-1, 0, 4, 5, 79, 80, None, 200]
    bands = one(spark, age_band(F.col("a")), [(a,) for a in ages], "a long")
    orders = one(spark, age_order(F.col("a")), [(a,) for a in ages], "a long")
    assert bands == ["00-04", "00-04", "00-04", "05-09", "75-79", "80+", None, "80+"]
    assert orders == [1, 1, 1, 2, 16, 17, None, 17]


def test_label_texts():
    """Literal texts of each label column, apart from the module that holds them."""
    assert S.DWELLING_TYPE[1] == "Casa" and S.DWELLING_TYPE[2] == "Apartamento" and S.DWELLING_TYPE[3] == "Cuarto"
    assert S.WALL_MATERIAL[0] == "Sin paredes" and S.WALL_MATERIAL[1] == "Bloque, ladrillo, piedra, madera pulida"
    assert S.SERVICE == {1: "Sí tiene servicio", 2: "No tiene servicio"}
    assert S.AREA_CLASS == {1: "Urbano", 2: "Urbano", 3: "Rural"}
    assert S.SANITARY[1] == "Con conexión a alcantarillado" and S.SANITARY[2] == "Con conexión a pozo séptico"
    assert S.HEAD_SEX == {1: "Hombre jefe", 2: "Mujer jefe"}
    assert S.FLOOR_MATERIAL[1] == "Alfombra o tapete, mármol, parqué, madera pulida y lacada"
    assert S.TENURE[1] == "Arriendo o subarriendo" and S.TENURE[2] == "Propia pagando" and S.TENURE[3] == "Propia pagada"
    assert S.HEALTH_REGIME == {0: "Ninguno", 1: "Contributivo", 2: "Especial", 3: "Subsidiado", 9: "No sabe"}
    assert S.AGE_BANDS[0] == (4, "00-04") and S.AGE_BANDS[-1] == (None, "80+") and len(S.AGE_BANDS) == 17
    assert S.HOUSING_QUALITY == ("Sin privaciones", "Privación moderada", "Privación alta") and S.UNKNOWN == "Sin información"
    assert len(S.INTEGER_COLUMNS) == len(set(S.INTEGER_COLUMNS)) == 142 and len(S.RELATIONSHIPS) == 10


def test_label_default(spark):
    out = one(spark, label(F.col("c"), S.SERVICE), [(1,), (2,), (7,), (None,)], "c long")
    assert out == [S.SERVICE[1], S.SERVICE[2], S.UNKNOWN, S.UNKNOWN]


def test_blank_rules(spark):
    df = spark.createDataFrame([(1, 0, None), (2, 4, 1)], "a long, b long, n long")
    r = df.select(div(F.col("a"), F.col("b")).alias("d"), div0(F.col("a"), F.col("b")).alias("d0"),
                  div0(F.col("n"), F.col("b")).alias("dn"),
                  blank_sub(F.col("n"), F.col("n")).alias("bb"),
                  blank_sub(F.col("a"), F.col("n")).alias("ab")).collect()
    assert r[0]["d"] is None and r[0]["d0"] == 0.0 and r[0]["dn"] == 0.0 and r[0]["bb"] is None
    assert r[1]["d"] == 0.5 and r[1]["d0"] == 0.5 and r[1]["dn"] == 0.25 and r[1]["ab"] == 1


def test_blank_count_and_single_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (2, "b")], "g long, v string")
    r = {x["g"]: x for x in df.groupBy("g").agg(
        blank_count(F.col("v") == "z").alias("c"), selected_value(F.col("v")).alias("s"),
        distinct_count_with_blank(F.col("v")).alias("d")).collect()}
    assert r[1]["c"] is None and r[1]["d"] == 2
    assert r[2]["s"] == "b" and r[2]["d"] == 1


def test_normalise_name(spark):
    pairs = [(" Medellín ", "MEDELLIN"), ("El Peñol", "elpenol"), (None, ""), ("Łódź Ū", "łódzu"), ("Ağrı", "agrı"), ("Medellin", "Medelin")]
    df = spark.createDataFrame(pairs, "a string, b string")
    out = df.select((normalise_name(F.col("a")) == normalise_name(F.col("b"))).alias("x")).collect()
    assert [r["x"] for r in out] == [True, True, True, True, True, False]


def test_enrich_rules(spark):
    from mesura.sources.survey import SURVEY_COLUMNS
    cols = [n for n, _, _ in SURVEY_COLUMNS]
    types = {n: ("string" if t == "string" else "long") for n, _, t in SURVEY_COLUMNS}
    base = {c: None for c in cols}
    rows = []
    for i, (cls, rooms, persons, parent, sex, age) in enumerate(
            [("A1", 0, 3, 1, 2, -1), ("D3", 1, 3, 1, 1, 80), (None, 1, 4, 2, 2, None), ("Z9", None, 2, None, 1, 5)]):
        r = dict(base)
        r.update({"Clasificacion": cls, "num_cuartos_vivienda": rooms, "num_personas_hogar": persons,
                  "tip_parentesco": parent, "sexo_persona": sex, "Edad": age,
                  "I11": 1 if i == 0 else None, "I12": 1, "I13": 1 if i < 2 else 0, "tip_mat_paredes": i,
                  "tip_vivienda": [1, 5, 9, None][i]})
        rows.append(tuple(r[c] for c in cols))
    schema = ", ".join(f"`{c}` {types[c]}" for c in cols)
    out = enrich(spark.createDataFrame(rows, schema)).collect()
    assert [r["orden_clasificacion"] for r in out] == [1, 4, 99, 99]
    assert [r["Personas_por_Cuarto"] for r in out] == [None, 3.0, 4.0, None]
    assert [r["Cat_Hacinamiento"] for r in out] == [S.UNKNOWN, S.NOT_CROWDED, S.CROWDED, S.UNKNOWN]
    assert [r["Es_Jefe"] for r in out] == [1, 1, 0, None]
    assert [r["Sexo_Jefe"] for r in out] == [2, 1, None, None]
    assert [r["Sexo_Jefe_Label"] for r in out] == [S.HEAD_SEX[2], S.HEAD_SEX[1], None, None]
    assert [r["Privaciones_Vivienda"] for r in out] == [3, 2, 1, 1]
    assert [r["Nivel_Calidad_Vivienda"] for r in out] == [S.HOUSING_QUALITY[2], S.HOUSING_QUALITY[1],
                                                          S.HOUSING_QUALITY[1], S.HOUSING_QUALITY[1]]
    assert [r["Rango_Edad"] for r in out] == ["00-04", "80+", None, "05-09"]
    assert [r["Tipo_Vivienda_txt"] for r in out] == [S.DWELLING_TYPE[1], S.DWELLING_TYPE[5], S.UNKNOWN, S.UNKNOWN]
    assert [r["Orden_Paredes"] for r in out] == [0, 1, 2, 3]
    assert list(out[0].asDict())[-24:] == S.DERIVED_COLUMNS
