"""Inventory operators: rollups, latest-state queries, reconciliation joins, rule ladders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.operators import ordered


def first_match(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first rule that holds; null conditions don't hold."""
    out = None
    for condition, label in rules:
        out = F.when(condition, F.lit(label)) if out is None else out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def rollup(df: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """Count and total size by keys."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(size).cast("long").alias("total_bytes"))


def share(df: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """Rollup with percent of the whole; the total is one row, joined by broadcast."""
    by = rollup(df, keys, size)
    whole = df.agg(F.sum(size).cast("long").alias("_whole"))
    return by.join(F.broadcast(whole)).withColumn("percent", F.round(100.0 * F.col("total_bytes") / F.nullif("_whole", F.lit(0)), 4)).drop("_whole")


def modal(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """Most frequent non-zero value by keys; of equally frequent ones that seen first."""
    counted = df.where(F.col(value) != 0).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(position).alias("_at"))
    return counted.groupBy(*keys).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("_at"))).alias("m")).select(*keys, F.col(f"m.{value}").alias("modal_value"), F.col("m.n").alias("modal_count"))


def pooled_ratio(df: DataFrame, keys: list[str], source: Column, output: Column) -> DataFrame:
    """Sum of sources over sum of outputs, not the mean of ratios."""
    return df.groupBy(*keys).agg(F.round(F.sum(source) / F.greatest(F.sum(output), F.lit(1)), 6).alias("ratio"))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row of each key by ``order`` (which should be unique), as one aggregation without a window's sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_seen(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Rows without later repeats of their keys."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(position)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def remaining(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose keys are not done."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, present: str) -> DataFrame:
    """Each key's state between two snapshots: disappeared, brand_new, newly_present, still_out or unchanged."""
    o = old.select(F.col(key), F.col(present).alias("_old"), F.lit(True).alias("_was"))
    n = new.select(F.col(key), F.col(present).alias("_new"), F.lit(True).alias("_is"))
    state = first_match([
        (F.col("_is").isNull(), "disappeared"),
        (F.col("_was").isNull(), "brand_new"),
        (F.col("_new") & ~F.col("_old"), "newly_present"),
        (~F.col("_new"), "still_out"),
    ], "unchanged")
    return o.join(n, key, "full").select(key, state.alias("state"))


def running_offset(df: DataFrame, group: list[str], position: str, length: str, header: int = 0) -> DataFrame:
    """Adds ``offset`` of each member: header plus the lengths before it."""
    return ordered.running_sum(df, group, position, length, "offset").withColumn("offset", F.col("offset") + F.lit(header))


def acquisition_order(df: DataFrame, group: list[str], name: str, storage: str) -> DataFrame:
    """Adds ``acq_idx``: rank of the trailing number of the name; null for the whole group if one lacks it or two share it.

    Whether a group is numbered comes from counts, joined back; ranks come from ordered cells of the numbers.
    """
    number = F.expr(f"try_cast(regexp_extract({name}, '([0-9]+)(\\\\.[A-Za-z0-9]+)?$', 1) as bigint)")
    numbered = df.withColumn("_n", number)
    counted = numbered.groupBy(*group, "_n").agg(F.count("*").alias("_times")).groupBy(*group).agg((F.max("_times") == 1).alias("_once"), (F.count("*") == F.count("_n")).alias("_all"))
    rows = ordered.ranked(numbered, group, "_n", "acq_idx", [storage])
    rows = ordered.on_keys(rows, counted, group)
    return rows.withColumn("acq_idx", F.when(F.col("_once") & F.col("_all"), F.col("acq_idx")).cast("long")).drop("_n", "_once", "_all")


def same_multiset(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Values whose counts differ; empty exactly if one is a permutation of the other."""
    x = a.groupBy(column).agg(F.count("*").alias("n_a"))
    y = b.groupBy(column).agg(F.count("*").alias("n_b"))
    return x.join(y, column, "full").select(column, F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b")).where("n_a <> n_b")


def siblings(df: DataFrame, group: list[str], key: str, name: str) -> DataFrame:
    """(key, ``name``): how many other rows of the group there are; groups with a null have none. Counted, not paired."""
    n = df.groupBy(*group).agg((F.count("*") - 1).alias(name))
    return df.join(n, group, "left").select(key, F.coalesce(name, F.lit(0)).alias(name))


def conditional_counts(df: DataFrame, keys: list[str], **conditions: Column) -> DataFrame:
    """Count by keys, and of the rows for which each condition holds."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def in_scope(df: DataFrame, kinds: tuple[str, list[str]] | None = None, size: str | None = None, least: float = 0, most: float | None = None) -> DataFrame:
    """Rows of the wanted kinds whose size is above 0 and from ``least`` to ``most``."""
    out = df if kinds is None else df.where(F.col(kinds[0]).isin(kinds[1]))
    if size is not None:
        out = out.where((F.col(size) > 0) & (F.col(size) >= least))
        out = out if most is None else out.where(F.col(size) <= most)
    return out


def all_of(groups: DataFrame, members: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """(key, ``name``): whether a group has members and the condition holds for all of them; null counts as not."""
    held = members.groupBy(key).agg(F.bool_and(F.coalesce(condition, F.lit(False))).alias(name))
    return groups.join(held, key, "left").select(key, F.coalesce(name, F.lit(False)).alias(name))


def presence(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """(n, present, percent): how many rows have a companion."""
    rows = with_companion(df, other, key, "_there")
    return rows.agg(F.count("*").alias("n"), F.count_if("_there").alias("present")).withColumn("percent", F.round(100.0 * F.col("present") / F.nullif("n", F.lit(0)), 4))


def with_companion(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """Adds whether ``other`` has a row of that key; a null key has none. ``other`` is reduced to its keys first."""
    there = other.select(key).distinct().withColumn(name, F.lit(True))
    return df.join(there, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def slots(df: DataFrame, position: str, first: int, stop: int) -> DataFrame:
    """Rows of the range [first, stop) with the slot each is written to."""
    return df.where((F.col(position) >= first) & (F.col(position) < stop)).withColumn("slot", F.col(position) - first)


def first_break(df: DataFrame, group: list[str], position: str, broken: Column) -> DataFrame:
    """The first position of each group at which ``broken`` holds; null if at none."""
    return df.groupBy(*group).agg(F.min(F.when(broken, F.col(position))).alias("first_break"))


def member_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has: (key, only_b, only_a)."""
    x, y = a.select(key).distinct().withColumn("_a", F.lit(True)), b.select(key).distinct().withColumn("_b", F.lit(True))
    both = x.join(y, key, "full").where("_a is null or _b is null")
    return both.select(key, F.col("_a").isNull().alias("only_b"), F.col("_b").isNull().alias("only_a"))


def corrected_total(df: DataFrame, size: str, left_out: Column, name: str) -> DataFrame:
    """Total without the rows that are left out, in one pass."""
    return df.agg(F.sum(F.when(~F.coalesce(left_out, F.lit(False)), F.col(size))).cast("long").alias(name))


def distinct_sizes(df: DataFrame, group: list[str], size: str, shown: int = 4) -> DataFrame:
    """(group, sizes, uniform, some): how many sizes there are, whether it is one at most, and up to ``shown`` of them."""
    sizes = df.where(F.col(size).isNotNull()).select(*group, size).distinct()
    return sizes.groupBy(*group).agg(F.count("*").alias("sizes"), (F.count("*") <= 1).alias("uniform"), F.slice(F.sort_array(F.collect_list(size)), 1, shown).alias("some"))


def distinct_counts(df: DataFrame, keys: list[str], **columns: str) -> DataFrame:
    """How many different values each column has by keys; nulls count nothing."""
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(name) for name, c in columns.items()])
