"""mesura: household-survey analytics on Spark.

Layout
------
sources/    readers and writers: driver tables, the survey fact, CSV folders,
            partitioned exports, literal dimension tables
functions/  Column helpers: BLANK-aware counts and division, code labels, text
operators/  DataFrame -> DataFrame transforms: cleaning, derived columns,
            projection ETLs, territory dimension, quality audits, exports
plans/      the measure layer: filter context, measure registry, fused
            evaluation, context removal, ranks, Pareto, year on year, selectors
streaming/  incremental (file-triggered) form of the enrichment ETL
"""

__all__ = ["session"]
