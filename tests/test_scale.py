"""What the plans must hold at scale: year pruning, exchanges that AQE owns,
bounded files, inputs that change under the same path."""

import glob
import re
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mesura.operators.derive import enrich
from mesura.plans.evaluate import q
from mesura.session import ensure_checkpoint_dir
from mesura.sources import survey
from mesura.sources.files import write_parquet

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().toString() if mode == "all" else df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", ["latest_year_extract", "share_of_selection"])
def test_latest_year_prunes_partitions(spark, name):
    text = plan(E.queries()[name](spark, SF))
    filters = re.findall(r"PartitionFilters: \[(.*)\]", text)
    assert any("Subquery" in f or "subquery" in f for f in filters), filters


@pytest.mark.parametrize("name", ["select_sanitary", "select_axis", "select_material", "select_household", "label_columns", "share_fixed_base"])
def test_one_pass_without_expand_or_nested_loops(spark, name):
    text = plan(E.queries()[name](spark, SF), "simple")
    assert "Expand" not in text and "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    # the fixed base needs one pass over all years and one over the latest (with its subquery)
    assert len(re.findall(r"FileScan parquet", text)) <= (3 if name == "share_fixed_base" else 1)


def test_fact_build_leaves_exchanges_to_the_planner(spark):
    text = plan(survey.build_fact(spark, SF), "simple")
    assert "REPARTITION_BY" not in text and "REBALANCE_PARTITIONS_BY_COL" in text


def logical_nodes(plan):
    """A logical plan's nodes, from the top down."""
    children = plan.children()
    return [plan] + [n for k in range(children.size()) for n in logical_nodes(children.apply(k))]


@pytest.mark.parametrize("name", ["event_shares", "event_means", "coverage_in_context", "select_household", "accumulated_measures"])
def test_fact_is_sorted_before_it_is_wide(spark, tmp_path, monkeypatch, name):
    """The query's fact reaches the writer in the order that it needs (which
    adds no sort of its own then), from a sort of the joined source rows."""
    written = []

    def keep(df, path, partition_by=None, **more):
        written.append(df)
        write_parquet(df, path, partition_by, **more)

    monkeypatch.setattr(survey, "write_parquet", keep)
    monkeypatch.setattr(survey, "ensure_checkpoint_dir", lambda _: str(tmp_path))
    assert E.queries()[name](spark, SF).count() > 0
    [df] = written
    plan = df._jdf.queryExecution().optimizedPlan()
    sorts = [n.output().size() for n in logical_nodes(plan) if n.nodeName() == "Sort"]
    assert len(df.columns) > 130 and sorts and max(sorts) < 20
    assert re.match(r"List\(anio#\d+L ASC NULLS FIRST, cod_mpio#\d+ ASC NULLS FIRST", plan.outputOrdering().toString())


def test_fact_rows_are_those_of_the_view_in_order(spark, tmp_path):
    """Orders without a date, repeated lines and customers: every row of the
    view is written, under its year, by municipality in each file."""
    orders = [(k, k % 3, None if k % 5 == 0 else datetime(1995 + k % 3, 2, 1), "1-URGENT") for k in range(40)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    customers = [(0, 1), (1, 2), (1, 0), (2, None)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, f"N{k}", 0) for k in range(3)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "ASIA")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    line = [(k % 40, None if k % 7 == 0 else k, k % 9, 1 + k % 2, float(k % 50), 10.5 * k, "R") for k in range(200)]
    kinds = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
    spark.createDataFrame(line * 2, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    sf = str(tmp_path)
    rows = survey.fact(spark, sf)
    want = enrich(survey.survey_view(spark, sf)).select(*map(q, rows.columns))
    assert rows.count() == want.count() == 400 and rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
    assert rows.where("anio is null").count() > 0
    for file in [r[0] for r in rows.select("_metadata.file_path").distinct().collect()]:
        places = [r[0] for r in spark.read.parquet(file).select("cod_mpio").collect()]
        assert places == sorted(places)


def test_files_of_a_year_are_bounded(spark):
    path = survey.materialise_fact(spark, SF).removeprefix("file:")
    assert max(len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/anio=*")) <= 2


def test_a_hot_key_is_split(spark, tmp_path):
    """The build's join on a table whose order key is hot: AQE splits it."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "8"}
    for t in ("orders", "customer", "nation", "region"):
        shutil.copyfile(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    line = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = line.select(F.min("l_orderkey")).first()[0]
    line.withColumn("l_orderkey", F.when(F.xxhash64("l_partkey", "l_linenumber", "l_orderkey") % 5 != 0, hot).otherwise(F.col("l_orderkey"))).repartition(8).write.parquet(f"{tmp_path}/lineitem.parquet")
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = survey.survey_rows(spark, str(tmp_path))
        assert len(df.collect()) == line.count()
        assert "skew=true" in plan(df, "simple")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_replaced_input_is_seen(spark, tmp_path):
    for t in ("lineitem", "orders", "customer", "nation", "region"):
        shutil.copyfile(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    before = survey.fact(spark, str(tmp_path)).count()
    spark.read.parquet(f"{SF}/lineitem.parquet").limit(100).coalesce(1).write.parquet(f"{tmp_path}/new")
    shutil.copyfile(glob.glob(f"{tmp_path}/new/part-*.parquet")[0], f"{tmp_path}/lineitem.parquet")
    assert before > 100 and survey.fact(spark, str(tmp_path)).count() == 100


def test_checkpoint_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, _conf = "spark://host:7077", Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
