"""Yearly accumulation: a table of additive bases, rebuilt by changed years.

The fact grows by yearly cuts. A year's bases by municipality are one small
folder, named by the state of the fact's files of that year (names, lengths,
times); a year whose files are as they were is not read again, and a folder
without its mark of success is no folder. No file is replaced, so a reader and
a broken-off refresh disturb each other in nothing: a year has its new numbers
once its new folder is whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesura.plans.context import FilterContext
from mesura.plans.evaluate import evaluate, q
from mesura.plans.measures import BASES, MEASURES
from mesura.session import input_signature, join_path, path_exists

YEAR = "anio"
PLACE = ["cod_mpio", "Municipio", "Subregion"]
#: Bases that are no sums but merge all the same.
EXTREMES = {"MAX_YEAR": F.max, "MAX_AGE": F.max, "MIN_AGE": F.min}
MERGED = [b.name for b in BASES.values() if b.additive or b.name in EXTREMES]


@dataclass
class YearlyBases:
    """Bases of the fact at ``fact_path`` (Parquet, partitioned by year), kept
    under ``root``. ``schema`` is the fact's."""

    spark: SparkSession
    fact_path: str
    schema: T.StructType
    root: str

    def years(self) -> dict[str, str]:
        """Year folders of the fact and the folder that holds their bases now."""
        jvm = self.spark._jvm
        base = jvm.org.apache.hadoop.fs.Path(self.fact_path)
        found = [x.getPath().getName() for x in base.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(base) if x.isDirectory()]
        version = hashlib.sha1(",".join(MERGED).encode()).hexdigest()
        out = {}
        for name in sorted(n for n in found if n.startswith(f"{YEAR}=")):
            state = input_signature(self.spark, join_path(self.fact_path, name))
            out[name] = join_path(self.root, name, "state=" + hashlib.sha1(f"{version}\n{state}".encode()).hexdigest()[:16])
        return out

    def rows(self, year: str) -> DataFrame:
        """The fact's rows of one year folder; no other is listed or read."""
        return self.spark.read.schema(self.schema).option("basePath", self.fact_path).parquet(join_path(self.fact_path, year))

    def refresh(self) -> list[str]:
        """Builds the bases of the years whose files changed; returns these years."""
        built = []
        for year, folder in self.years().items():
            if not path_exists(self.spark, join_path(folder, "_SUCCESS")):
                bases = self.rows(year).groupBy(*map(q, PLACE)).agg(*[BASES[b].make().alias(b) for b in MERGED])
                bases.write.mode("overwrite").parquet(folder)
                built.append(year.partition("=")[2])
        return built

    def vacuum(self) -> None:
        """Removes the folders of earlier states. For times without readers."""
        jvm = self.spark._jvm
        now = set(self.years().values())
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for year in fs.listStatus(root) if fs.exists(root) else []:
            for state in fs.listStatus(year.getPath()):
                if join_path(self.root, year.getPath().getName(), state.getPath().getName()) not in now:
                    fs.delete(state.getPath(), True)

    def table(self) -> DataFrame:
        """The bases of all years, as of the last refresh of each."""
        folders = [f for f in self.years().values() if path_exists(self.spark, join_path(f, "_SUCCESS"))]
        kinds = self.spark.createDataFrame([], self.schema).agg(*[BASES[b].make().alias(b) for b in MERGED]).schema
        own = T.StructType([*[self.schema[k] for k in PLACE], *kinds.fields, T.StructField(YEAR, self.schema[YEAR].dataType)])
        if not folders:
            return self.spark.createDataFrame([], own)
        return self.spark.read.schema(own).option("basePath", self.root).parquet(*folders).select(*map(q, own.names))

    def answers(self, keys: Sequence[str], names: Sequence[str], ctx: FilterContext | None = None) -> bool:
        """Whether the bases suffice: keys and filters on year and place, and
        measures made of bases that merge and that no key or filter replaces."""
        touched = set(keys) | (ctx or FilterContext()).columns()
        bases = [BASES[b] for n in names for b in MEASURES[n].needs]
        return touched <= {YEAR, *PLACE} and all(b.name in MERGED and not touched & set(b.filter_cols) for b in bases)

    def evaluate(self, keys: Sequence[str], names: Sequence[str], ctx: FilterContext | None = None) -> DataFrame:
        """``plans.evaluate.evaluate``: from the bases where they suffice, from
        the fact where not. Merged sums of blanks are blank, as counts of no
        row are."""
        if not self.answers(keys, names, ctx):
            years = [join_path(self.fact_path, y) for y in self.years()]
            rows = self.spark.read.schema(self.schema).option("basePath", self.fact_path).parquet(*years)
            return evaluate(rows, keys, names, ctx)
        need = list(dict.fromkeys(b for n in names for b in MEASURES[n].needs))
        merged = [EXTREMES.get(b, F.sum)(q(b)).alias(b) for b in need]
        out = (ctx or FilterContext()).apply(self.table()).groupBy(*map(q, keys)).agg(*merged)
        return out.select(*map(q, keys), *[MEASURES[n].value(q).alias(n) for n in names])
