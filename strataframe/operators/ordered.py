"""Running sums, ranks, neighbours and runs in order within groups, none of which puts a whole group into one task.

Positions are cut into cells at quantiles of all rows (``CELLS`` of them; where the cuts lie changes balance only). Rows
are ordered inside (group, cell); what a cell gets from those before it is carried over by a table of one row for each
group and cell.

Cases: a null position comes before all others. Null groups are groups of their own. Empty tables give empty tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 64


def cell_of(df: DataFrame, position: str, cells: int = CELLS) -> Column:
    """Number of the cell that a position falls into, ascending with it."""
    cuts = [k / cells for k in range(1, cells)]
    found = df.agg(F.percentile_approx(position, cuts, 1000)).first()[0] or []  # at most ``cells`` values
    bounds = sorted(set(found))
    if not bounds:
        return F.lit(0)
    return F.coalesce(reduce(lambda a, b: a + b, [(F.col(position) > F.lit(b)).cast("int") for b in bounds]), F.lit(0))


def on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join in which nulls are equal; the right side's keys are dropped."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(named, condition, how).drop(*[f"_r_{k}" for k in keys])


def running_sum(df: DataFrame, group: list[str], position: str, value: str, name: str, ties: list[str] = (), cells: int = CELLS) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the group before this one."""
    rows = df.withColumn("_cell", cell_of(df, position, cells))
    inside = Window.partitionBy(*group, "_cell").orderBy(position, *ties).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*group, "_cell").agg(F.sum(value).alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    rows = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return on_keys(rows, sums, [*group, "_cell"]).withColumn(name, F.col("_inside") + F.col("_before")).drop("_cell", "_inside", "_before")


def ranked(df: DataFrame, group: list[str], position: str, name: str, ties: list[str] = (), cells: int = CELLS) -> DataFrame:
    """Adds ``name``: the place of a row in its group, from 0."""
    return running_sum(df.withColumn("_one", F.lit(1).cast("long")), group, position, "_one", name, list(ties), cells).drop("_one")


def with_previous(df: DataFrame, group: list[str], position: str, values: list[str], suffix: str = "_before", cells: int = CELLS) -> DataFrame:
    """Adds the ``values`` of the row before in the group (null for the first)."""
    rows = df.withColumn("_cell", cell_of(df, position, cells))
    inside = Window.partitionBy(*group, "_cell").orderBy(position)
    before = Window.partitionBy(*group).orderBy("_cell")
    packed = F.struct(*values)
    last = rows.groupBy(*group, "_cell").agg(F.max_by(packed, F.struct(position)).alias("_last"))
    carried = last.select(*group, "_cell", F.lag("_last").over(before).alias("_carried"))
    rows = rows.withColumn("_own", F.lag(packed).over(inside))
    out = on_keys(rows, carried, [*group, "_cell"]).withColumn("_prior", F.coalesce("_own", "_carried"))
    return out.withColumns({f"{v}{suffix}": F.col(f"_prior.{v}") for v in values}).drop("_cell", "_own", "_carried", "_prior")


def spans(df: DataFrame, group: list[str], position: str, batch: int, cells: int = CELLS) -> DataFrame:
    """Runs of consecutive positions (whole numbers, each once in a group), of at most ``batch`` members: first, last, members."""
    rows = with_previous(df.select(*group, position), group, position, [position], "_prev", cells)
    begins = F.coalesce(F.col(position) - F.col(f"{position}_prev") != 1, F.lit(True))
    rows = rows.withColumn("_begin", F.when(begins, F.col(position))).withColumn("_cell", cell_of(df, position, cells))
    inside = Window.partitionBy(*group, "_cell").orderBy(position)
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*group, "_cell").agg(F.max("_begin").alias("_begin")).withColumn("_carried", F.max("_begin").over(before)).drop("_begin")
    rows = on_keys(rows.withColumn("_own", F.max("_begin").over(inside)), carried, [*group, "_cell"])
    start = F.coalesce("_own", "_carried")
    cell = F.floor((F.col(position) - start) / batch)
    return rows.groupBy(*group, start.alias("_start"), cell.alias("_part")).agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("members")).drop("_start", "_part")


def nearest_rank(df: DataFrame, keys: list[str], value: str, percents: tuple[int, ...] = (0, 25, 50, 75, 95, 100), cells: int = CELLS) -> DataFrame:
    """Element ``min(n - 1, q * n div 100)`` of the sorted values for each q: values are counted, then their counts are summed in order."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = running_sum(counted, keys, value, "_n", "_at", cells=cells)
    whole = counted.groupBy(*keys).agg(F.sum("_n").alias("_whole"))
    placed = on_keys(placed, whole, keys) if keys else placed.join(F.broadcast(whole))
    target = lambda q: F.least(F.col("_whole") - 1, F.floor(F.lit(q) * F.col("_whole") / 100))
    hit = lambda q: (F.col("_at") <= target(q)) & (target(q) < F.col("_at") + F.col("_n"))
    return placed.groupBy(*keys).agg(*[F.max(F.when(hit(q), F.col(value))).alias(f"q{q}") for q in percents])
