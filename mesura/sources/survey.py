"""The survey fact: one person row per ``lineitem`` row.

The columns are defined as SQL expressions over the aliases ``l`` (lineitem),
``o`` (orders), ``c`` (customer), ``n`` (nation = municipality) and ``r``
(region = subregion); the same text runs in Spark SQL and in the DuckDB
oracle. ``build_fact`` joins the tables (small side first, lineitem shuffled
once), applies the derived columns and ``fact`` materialises the result once
as a Parquet table partitioned by year in the shared checkpoint folder, as
the surveyed ETL does with its enriched Parquet file.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.session import ensure_checkpoint_dir, input_signature, join_path, path_exists
from mesura.sources.files import write_parquet
from mesura.sources.tables import read_table

FACT_VERSION = "5"
#: Order of the rows in each file of the fact; the year is its partition.
FACT_ORDER = ["anio", "cod_mpio"]

def _columns() -> list[tuple[str, str, str]]:
    """(name, SQL expression, type) in the order of the semantic model."""
    ind_j = iter(range(2, 100))
    tip_j = iter(range(1, 100))
    val_j = iter(range(2, 100))

    def ind():
        return f"(l.l_orderkey + {next(ind_j)}) % 7 % 2 + 1"

    def tip():
        j = next(tip_j)
        return f"case when (l.l_orderkey + {j}) % 13 = 0 then null else (l.l_orderkey + {j}) % 6 end"

    def num_event():
        return f"(l.l_orderkey + {next(val_j)}) % 6"

    def expense():
        j = next(val_j)
        return f"cast(floor(l.l_extendedprice) as bigint) % (1000 * ({j} + 1))"

    def deprivation(k: int) -> str:
        return (f"case when (l.l_partkey + {k}) % 41 = 0 then null "
                f"when (l.l_partkey + {k} * l.l_suppkey) % {k + 2} = 0 then 1 else 0 end")

    L, S = "bigint", "string"
    cols: list[tuple[str, str, str]] = [
        ("cod_mpio", "lpad(cast(c.c_nationkey as string),5,'0')", S),
        ("Cod_clase", "l.l_orderkey % 4", L),
        ("NOM_BARRIO", "o.o_orderpriority", S),
        ("tip_vivienda", tip(), L),
        ("tip_mat_paredes", "case when l.l_orderkey % 13 = 0 then null else l.l_orderkey % 9 end", L),
        ("tip_mat_pisos", "l.l_orderkey % 8", L),
        ("ind_tiene_energia", "(l.l_orderkey + 1) % 7 % 2 + 1", L),
        ("ind_tiene_alcantarillado", ind(), L),
        ("ind_tiene_gas", ind(), L),
        ("ind_tiene_recoleccion", ind(), L),
        ("ind_tiene_acueducto", ind(), L),
        ("num_cuartos_vivienda", "l.l_partkey % 4", L),
        ("num_hogares_vivienda", "l.l_orderkey % 3 + 1", L),
        ("ide_hogar", "l.l_orderkey % 3 + 1", L),
        ("tip_ocupa_vivienda", tip(), L),
        ("num_cuartos_dormir", "l.l_partkey % 4 + 1", L),
        ("tip_sanitario", tip(), L),
        ("tip_ubi_sanitario", tip(), L),
        ("tip_uso_sanitario", tip(), L),
        ("tip_origen_agua", tip(), L),
        ("ind_agua_llega_7dias", ind(), L),
        ("ind_agua_llega_24horas", ind(), L),
        ("tip_uso_agua_beber", tip(), L),
        ("tip_elimina_basura", tip(), L),
        ("ind_tiene_cocina", ind(), L),
        ("tip_prepara_alimentos", tip(), L),
        ("tip_uso_cocina", tip(), L),
        ("tip_energia_cocina", tip(), L),
    ]
    for a in ("nevera", "lavadora", "pc", "internet", "moto", "tractor", "carro", "bien_raiz"):
        cols.append((f"ind_tiene_{a}", ind(), L))
    cols += [("ind_gasto_alimento", ind(), L),
             ("vlr_gasto_alimento", "cast(floor(l.l_extendedprice) as bigint)", L)]
    for e in ("transporte", "educacion", "salud", "serv_publicos", "celular", "arriendo", "otros"):
        cols += [(f"ind_gasto_{e}", ind(), L), (f"vlr_gasto_{e}", expense(), L)]
    expense_cols = ["vlr_gasto_alimento"] + [f"vlr_gasto_{e}" for e in
                                             ("transporte", "educacion", "salud", "serv_publicos",
                                              "celular", "arriendo", "otros")]
    exprs = dict((n, x) for n, x, _ in cols)
    cols.append(("vlr_total_gastos", " + ".join(f"({exprs[c]})" for c in expense_cols), L))
    cols += [("ind_evento_inundacion", "l.l_orderkey % 5 % 2 + 1", L),
             ("num_evento_inundacion", "l.l_orderkey % 6", L)]
    for ev in ("avalancha", "terremoto", "incendio"):
        cols += [(f"ind_evento_{ev}", ind(), L), (f"num_evento_{ev}", num_event(), L)]
    cols += [("ind_evento_vendaval", ind(), L),
             ("ind_evento_hundimiento", ind(), L), ("num_evento_hundimiento", num_event(), L)]
    cols += [("num_personas_hogar", "l.l_orderkey % 9 + 1", L),
             ("sexo_persona", "l.l_suppkey % 2 + 1", L),
             ("tip_parentesco", "cast(l.l_linenumber as bigint)", L)]
    for d in ("ver", "oir", "hablar", "moverse", "bañarse", "salir", "entender", "ninguna"):
        cols.append((f"ind_discap_{d}", ind(), L))
    cols += [("tip_seg_social", tip(), L), ("ind_acudio_salud", ind(), L),
             ("ind_fue_atendido_salud", ind(), L), ("tip_cuidado_niños", tip(), L),
             ("ind_recibe_comida", ind(), L), ("ind_leer_escribir", ind(), L),
             ("ind_estudia", ind(), L), ("niv_educativo", "l.l_partkey % 8", L),
             ("grado_alcanzado", "l.l_partkey % 12", L), ("ind_fondo_pensiones", ind(), L),
             ("tip_actividad_mes", tip(), L),
             ("H_5", "case when (l.l_partkey + c.c_nationkey) % (3 + c.c_nationkey % 4) = 0 "
                     "then 1 else 0 end", L)]
    cols.append(("I1", "case when (l.l_partkey + 1) % 41 = 0 then null "
                       "when (l.l_partkey + 1 * l.l_suppkey) % 3 = 0 then 1 else 0 end", L))
    for k in range(2, 15):
        cols.append((f"I{k}", deprivation(k), L))
    cols.append(("I15", "case when (l.l_partkey + 15) % 41 = 0 then null "
                        "when (l.l_partkey + 15 * l.l_suppkey) % 17 = 0 then 1 else 0 end", L))
    cols += [
        ("Clasificacion", "case when l.l_partkey % 31 = 0 then null else "
                          "concat(substring('ABCD',cast(l.l_partkey % 4 as int)+1,1), "
                          "cast(l.l_suppkey % 5 + 1 as string)) end", S),
        ("anio", "cast(year(o.o_orderdate) as bigint)", L),
        ("grupo_sisben", "case when l.l_partkey % 31 = 0 then null else "
                         "substring('ABCD',cast(l.l_partkey % 4 as int)+1,1) end", S),
        ("Fec_digitacion", "cast(cast(o.o_orderdate as date) as string)", S),
        ("Edad", "case when l.l_partkey % 29 = 0 then null else "
                 "cast(l.l_quantity as bigint) * 2 - 2 end", L),
        ("marca", "case l.l_partkey % 4 when 0 then '0' when 1 then '1' when 2 then '10' else '20' end", S),
        ("estado", "case when l.l_partkey % 37 = 0 then null when l.l_partkey % 3 > 0 then '0' "
                   "else cast(50 + l.l_suppkey % 20 as string) end", S),
        ("Source.Name", "concat('file_', l.l_returnflag)", S),
        ("Num_evento_vendaval", num_event(), L),
        # territory attributes and the household key carried on the fact
        ("Municipio", "n.n_name", S),
        ("Subregion", "r.r_name", S),
        ("household_key", "l.l_orderkey", L),
    ]
    return cols


SURVEY_COLUMNS = _columns()
BASE_COLUMNS = [n for n, _, _ in SURVEY_COLUMNS]


def quote_spark(name: str) -> str:
    return f"`{name}`"


def quote_sql(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def view_select_sql(quote=quote_sql) -> str:
    """SELECT list of the survey view for an SQL engine."""
    return ",\n  ".join(f"cast({x} as {t}) as {quote(n)}" for n, x, t in SURVEY_COLUMNS)


VIEW_FROM_SQL = ("lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
                 "JOIN customer c ON o.o_custkey = c.c_custkey "
                 "JOIN nation n ON c.c_nationkey = n.n_nationkey "
                 "JOIN region r ON n.n_regionkey = r.r_regionkey")


def survey_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined source rows, columns of the base tables as they are.

    No partitioning is asked for: the planner places the exchanges, so AQE can
    coalesce them, split a hot key's partition or broadcast a small side.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    line = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    oc = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
           .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return line.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))


def _struct_rows(rows: DataFrame) -> DataFrame:
    """Joined source rows with each table's columns under its alias too."""
    for alias, prefix in (("l", "l_"), ("o", "o_"), ("c", "c_"), ("n", "n_"), ("r", "r_")):
        rows = rows.withColumn(alias, F.struct(*[F.col(x) for x in rows.columns if x.startswith(prefix)]))
    return rows


def survey_columns(rows: DataFrame) -> DataFrame:
    """The survey's base columns over joined source rows. A base column that
    ``rows`` already has (``sorted_rows``) is taken as it is."""
    ready = set(rows.columns)
    return _struct_rows(rows).select(*[F.col(nm) if nm in ready else F.expr(f"cast({x} as {t})").alias(nm) for nm, x, t in SURVEY_COLUMNS])


def sorted_rows(rows: DataFrame) -> DataFrame:
    """Joined source rows with the base columns of ``FACT_ORDER``, rebalanced by
    year (an exchange that AQE sizes and splits) and sorted in each partition."""
    order = [F.expr(f"cast({x} as {t})").alias(nm) for nm, x, t in SURVEY_COLUMNS if nm in FACT_ORDER]
    rows = _struct_rows(rows).select(*rows.columns, *order)
    return rows.sparkSession.sql("SELECT /*+ REBALANCE(anio) */ * FROM {rows}", rows=rows).sortWithinPartitions(*FACT_ORDER)


def survey_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw survey view (base columns, no derived ones)."""
    return survey_columns(survey_rows(spark, sf_dir))


def build_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched fact. The narrow joined rows are rebalanced and sorted
    before the 135 columns are computed, so a year's rows meet in files of
    bounded size and the wide rows cross no network and fill no sort: the
    writer finds them in the order of the partitions it writes."""
    from mesura.operators.derive import enrich
    return enrich(survey_columns(sorted_rows(survey_rows(spark, sf_dir))))


_SCHEMAS: dict[tuple[str, str], object] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha1(FACT_VERSION.encode())
    for t in ("lineitem", "orders", "customer", "nation", "region"):
        h.update(input_signature(spark, f"{sf_dir.rstrip('/')}/{t}.parquet").encode())
    return h.hexdigest()[:16]


def fact_path(spark: SparkSession, sf_dir: str) -> str:
    return join_path(ensure_checkpoint_dir(spark), "mesura_fact", _fingerprint(spark, sf_dir))


def materialise_fact(spark: SparkSession, sf_dir: str, path: str | None = None) -> str:
    """Write the enriched fact once (Parquet, snappy, partitioned by year,
    sorted by municipality inside each file for row-group pruning).

    The write is the lineage cut: later queries read files from the shared
    folder, so a lost executor re-reads a file instead of recomputing joins.
    """
    path = path or fact_path(spark, sf_dir)
    if not path_exists(spark, join_path(path, "_SUCCESS")):
        write_parquet(build_fact(spark, sf_dir), path, ["anio"])
    return path


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched survey fact, read from its materialised Parquet table.
    Replaced inputs have another fingerprint, hence another table."""
    path = materialise_fact(spark, sf_dir)
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = build_fact(spark, sf_dir).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)
