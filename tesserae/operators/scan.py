"""Ordered scans and exact order statistics of long series, without a task that holds a whole one.

A series (the rows of one key) can be most of a table.  Rows are dealt by ranges of (key, order), so that a long series spans
many ranges; a scan runs within each part of a series and what comes before a part is carried to it from the parts' totals, a
row for each key and range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .coords import durable

#: A series of no more rows than this is sorted in one task.
SHORT = 10_000
#: Percentiles that a pass of the selection takes, and their accuracy: errors are far below the distance of two of them.
CELLS, ACCURACY = 64, 2_000
_RANGE = "__range"


def ranged(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with the number of their range, written once: sampled again, the ranges could differ."""
    return durable(rows.repartitionByRange(key, *order).withColumn(_RANGE, F.spark_partition_id()))


def _carried(at: DataFrame, key: str, order: list[str], told: dict[str, Column], total: list[Column], carry: dict[str, Column]) -> DataFrame:
    """``at`` with the columns ``told`` of a scan within each part, and ``carry``, made of the parts' totals in their order."""
    within = Window.partitionBy(key, _RANGE).orderBy(*order)
    parts = at.groupBy(key, _RANGE).agg(*total)
    before = parts.select(F.col(key).alias("__key"), F.col(_RANGE).alias("__part"), *[c.over(Window.partitionBy(key).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)).alias(n) for n, c in carry.items()])
    scanned = at.withColumns({n: c.over(within.rowsBetween(Window.unboundedPreceding, 0) if n.startswith("__sum") else within) for n, c in told.items()})
    return scanned.join(before, (F.col(_RANGE) == F.col("__part")) & F.col(key).eqNullSafe(F.col("__key"))).drop("__key", "__part", _RANGE)


def running(rows: DataFrame, key: str, order: list[str], sums: dict[str, str], tops: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with running totals and running maxima (name: value) in the order of their series, each row itself included;
    nulls count nothing."""
    tops = tops or {}
    all_ = {n: (F.sum, v) for n, v in sums.items()} | {n: (F.max, v) for n, v in tops.items()}
    told = {f"__sum_{n}": f(v) for n, (f, v) in all_.items()}
    out = _carried(ranged(rows, key, order), key, order, told, [f(v).alias(f"__part_{n}") for n, (f, v) in all_.items()], {f"__base_{n}": f(f"__part_{n}") for n, (f, v) in all_.items()})
    own, base = (lambda n: F.col(f"__sum_{n}")), (lambda n: F.col(f"__base_{n}"))
    total = lambda n: F.when(own(n).isNull(), base(n)).otherwise(own(n) + F.coalesce(base(n), F.lit(0)))
    return out.select(*rows.columns, *[total(n).alias(n) for n in sums], *[F.greatest(own(n), base(n)).alias(n) for n in tops])


def prefix_sums(rows: DataFrame, key: str, order: list[str], values: list[str], names: list[str]) -> DataFrame:
    """``rows`` with the running total of each value, itself included, in the order of its series; nulls count nothing."""
    return running(rows, key, order, dict(zip(names, values, strict=True)))


def previous(rows: DataFrame, key: str, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the value of the row before, in the order of the series; null for the first."""
    last = F.max_by(F.struct(value), F.struct(*order)).alias("__last")
    out = _carried(ranged(rows, key, order), key, order, {"__own": F.lag(value), "__place": F.row_number()}, [last], {"__border": F.last("__last")})
    return out.select(*rows.columns, F.when(F.col("__place") > 1, F.col("__own")).otherwise(F.col(f"__border.{value}")).alias(name))


def medians(rows: DataFrame, key: str, value: str, short: int = SHORT) -> DataFrame:
    """key, med: the exact median of each series, the mean of the two middle values of an even one; nulls are left out.

    Long series are narrowed down: approximate percentiles, which add up over tasks, bracket the two middle ranks; exact
    counts below, on and between the brackets' ends tell the ranks, and the rows strictly between go on to the next pass,
    about a sixteenth of those before however they are spread.  What is short enough is sorted.
    """
    open_ = durable(rows.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(F.col(key).alias("k"), F.col(value).cast("double").alias("v")))
    n = F.count("*")
    # r, s: the middle ranks among the rows that are left, m their number
    state = durable(open_.groupBy("k").agg(n.alias("m")).select("k", "m", F.floor((F.col("m") - 1) / 2).alias("r"), F.floor(F.col("m") / 2).alias("s")))
    found = None
    while True:
        few = open_.join(state.where(F.col("m") <= short), "k").groupBy("k", "r", "s").agg(F.sort_array(F.collect_list("v")).alias("all"))
        at = lambda rank: F.element_at("all", (F.col(rank) + 1).cast("int"))
        some = few.select("k", ((at("r") + at("s")) / 2).alias("med"))
        found = some if found is None else found.union(some)
        long = state.where(F.col("m") > short)
        if long.isEmpty():
            return found.select(F.col("k").alias(key), "med")
        grid = open_.join(long, "k").groupBy("k", "m", "r", "s").agg(F.percentile_approx("v", [i / CELLS for i in range(CELLS + 1)], ACCURACY).alias("p"))
        cell = lambda rank, move: F.element_at("p", F.greatest(F.lit(0), F.least(F.lit(CELLS), F.floor(F.col(rank) * CELLS / F.col("m")) + move)).cast("int") + 1)
        ends = durable(grid.select("k", "m", "r", "s", cell("r", -1).alias("lo"), cell("s", 2).alias("hi")))
        v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
        count = lambda which: F.count(F.when(which, 1))
        inside = (v > lo) & (v < hi)
        told = open_.join(ends, "k").groupBy("k", "m", "r", "s", "lo", "hi").agg(count(v < lo).alias("below"), count(v == lo).alias("on"), count(inside).alias("mid"), F.min(F.when(v > lo, v)).alias("next"), F.max(F.when(v < hi, v)).alias("prior"))
        told = durable(told.withColumn("first", F.col("below") + F.col("on")).withColumn("end", F.col("first") + F.col("mid")))
        both = (F.col("r") >= F.col("first")) & (F.col("s") < F.col("end"))
        lost = F.raise_error(F.lit("a percentile is further off than its accuracy says")).cast("double")
        low = F.when(F.col("r") < F.col("below"), lost).when(F.col("r") < F.col("first"), lo).when(F.col("r") < F.col("end"), F.col("prior")).otherwise(hi)
        high = F.when(F.col("s") < F.col("first"), lo).when(F.col("s") < F.col("end"), F.col("next")).otherwise(hi)
        found = found.union(told.where(~both).select("k", ((low + high) / 2).alias("med")))
        state = told.where(both).select("k", F.col("mid").alias("m"), (F.col("r") - F.col("first")).alias("r"), (F.col("s") - F.col("first")).alias("s"), "lo", "hi")
        open_ = durable(open_.join(state.select("k", "lo", "hi"), "k").where(inside).select("k", "v"))
        state = state.drop("lo", "hi")
