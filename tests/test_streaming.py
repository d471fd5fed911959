"""The incremental ETL picks up two drops of survey files exactly once."""

import tempfile

from mesura.sources.survey import survey_view
from mesura.streaming.incremental import enrich_stream

SF = "/root/testdata/sf0.001"


def test_incremental_enrich(spark):
    root = tempfile.mkdtemp(prefix="mesura-stream-")
    view = survey_view(spark, SF)
    years = sorted(r[0] for r in view.select("anio").distinct().collect())
    first, rest = years[:1], years[1:]
    view.where(view.anio.isin(first)).write.parquet(f"{root}/in/a")
    q = enrich_stream(spark, f"{root}/in/*", f"{root}/out", view.schema, name="t" + root[-6:])
    q.awaitTermination(120)
    n1 = spark.read.parquet(f"{root}/out").count()
    view.where(view.anio.isin(rest)).write.parquet(f"{root}/in/b")
    q = enrich_stream(spark, f"{root}/in/*", f"{root}/out", view.schema, name="t" + root[-6:])
    q.awaitTermination(120)
    out = spark.read.parquet(f"{root}/out")
    assert n1 == view.where(view.anio.isin(first)).count()
    assert out.count() == view.count()
    assert "Rango_Edad" in out.columns
