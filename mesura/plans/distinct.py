"""Distinct counts that merge: exact bitmaps of integer ids.

A distinct count of a coarser group is no sum of those of finer ones, but the
union of their bitmaps. Ids are dealt to buckets of 32,768; a group's bitmap of
a bucket has 4 KB, whatever number of its ids occur. The finest grain is built
in one scan (partial bitmaps before the shuffle, so a hot group sends one
bitmap a task and bucket), written, and every coarser set is united from it.

Bitmaps pay where a group holds many ids of a bucket (above 512, they are
smaller than the ids), as with ids numbered by place. Counts are exact in any
case.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesura.plans.evaluate import q
from mesura.plans.prefix import Scratch
from mesura.plans.totals import total_mark


def bitmaps(rows: DataFrame, keys: Sequence[str], ids: Mapping[str, Column]) -> DataFrame:
    """A row (keys, ``id_name``, ``id_bucket``, ``id_bits``) for each bucket of
    each of ``ids`` (name -> integer column) in each group. Null ids have no
    bit; a group whose ids are all null has one row, of bucket null."""
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("id_name"), c.cast("long").alias("id")) for n, c in ids.items()]))
    long = rows.select(*map(q, keys), names.alias("__id")).select(*map(q, keys), "__id.*")
    long = long.withColumns({"id_bucket": F.bitmap_bucket_number("id"), "__bit": F.bitmap_bit_position("id")})
    return long.groupBy(*map(q, keys), "id_name", "id_bucket").agg(F.bitmap_construct_agg("__bit").alias("id_bits"))


def united(fine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``fine`` (of ``bitmaps``) over some of its keys alone."""
    return fine.groupBy(*map(q, keys), "id_name", "id_bucket").agg(F.bitmap_or_agg("id_bits").alias("id_bits"))


def counted(maps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct ids of each group, one column for each name; 0 if it has none."""
    own = F.when(q("id_bucket").isNotNull(), F.bitmap_count("id_bits"))
    return maps.groupBy(*map(q, keys)).agg(*[F.coalesce(F.sum(F.when(q("id_name") == n, own)), F.lit(0)).cast("long").alias(n) for n in names])


def distinct_by_sets(rows: DataFrame, sets: Sequence[Sequence[str]], ids: Mapping[str, Column], scratch: Scratch) -> DataFrame:
    """One row for each member of each of the key ``sets``: the keys (null where
    the set lacks the key), a mark ``<key>_total`` for each key, and the
    distinct count of each of ``ids``. ``rows`` are scanned once; each set is
    united from the smallest one already united that has its keys. A set
    without keys gives one row, also for no rows."""
    keys = list(dict.fromkeys(k for s in sets for k in s))
    held: dict[tuple[str, ...], DataFrame] = {tuple(keys): scratch.write(bitmaps(rows, keys, ids), "bitmaps")}
    parts = []
    for own in sorted(dict.fromkeys(tuple(s) for s in sets), key=len, reverse=True):
        if own not in held:
            finer = min((k for k in held if set(own) <= set(k)), key=len)
            coarse = united(held[finer], own)
            # read again by a set below it, so written; the last ones are counted at once
            below = any(set(s) < set(own) for s in sets)
            held[own] = scratch.write(coarse, "bitmaps") if below else coarse
        marks = [F.lit(k not in own).alias(total_mark(k)) for k in keys]
        kept = [q(k) if k in own else F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in keys]
        parts.append(counted(held[own], own, list(ids)).select(*kept, *marks, *map(q, ids)))
    return reduce(DataFrame.unionByName, parts)
