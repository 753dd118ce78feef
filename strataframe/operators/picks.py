"""Choosing rows: seeded samples, one of each stratum under caps, uncovered strata, cumulative limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.operators import ordered


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows without replacement, the same ones for a seed wherever rows lie: those whose keys' hashes are smallest."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string"))), key).limit(n)


def cumulative_stop(df: DataFrame, position: str, size: str, limit: float, ties: list[str] = ()) -> DataFrame:
    """Rows in order up to the first that brings the total of ``size`` to ``limit`` or above, that one included."""
    return ordered.running_sum(df, [], position, size, "_before", list(ties)).where(F.col("_before") < limit).drop("_before") if df.columns else df


def smallest(df: DataFrame, by: str, ties: list[str] = ()) -> DataFrame:
    """The row with the least ``by``: one aggregation, no sort."""
    row = F.min_by(F.struct(*df.columns), F.struct(by, *ties))
    return df.agg(row.alias("m")).where("m is not null").select("m.*")


def stratified_pick(df: DataFrame, strata: list[str], key: str, size: str, most: int, most_bytes: int, first: str | None = None) -> DataFrame:
    """Up to ``most`` rows and less than ``most_bytes`` in all: the smallest row of each stratum, strata with the smallest first, then the
    smallest of the rest (rows for which ``first``, a condition, holds before others). A row that would break a cap is skipped.

    Whether a row is skipped depends on those taken before it, so the last step is a loop on the driver; only rows that can
    still be taken get there: one for each of the ``most`` smallest strata and the ``2 * most`` smallest others.
    """
    heads = df.groupBy(*strata).agg(F.min_by(F.struct(*df.columns), F.struct(size, key)).alias("m")).select("m.*")
    taken, total = [], 0
    for r in heads.orderBy(size, key).toLocalIterator():  # ends with the first row that can't be taken any more: sizes ascend
        if len(taken) == most or total + r[size] >= most_bytes:
            break
        taken.append(r)
        total += r[size]
    if len(taken) < most:
        rest = df.where(~F.col(key).isin([r[key] for r in taken])) if taken else df
        preferred = F.expr(first).cast("boolean") if first else F.lit(True)
        for wanted in (True, False) if first else (True,):
            pool = rest.where(F.coalesce(preferred, F.lit(False)) == F.lit(wanted)).orderBy(size, key).limit(most)
            for r in pool.collect():  # at most ``most`` rows
                if len(taken) < most and total + r[size] < most_bytes:
                    taken.append(r)
                    total += r[size]
    return df.sparkSession.createDataFrame(taken, df.schema) if taken else df.limit(0)


def coverage_pick(df: DataFrame, chosen: DataFrame, strata: list[str], key: str, size: str, most: int) -> DataFrame:
    """The smallest row of each stratum that ``chosen`` has none of, smallest first, so that chosen and picked are at most ``most`` rows."""
    heads = df.groupBy(*strata).agg(F.min_by(F.struct(*df.columns), F.struct(size, key)).alias("m")).select("m.*")
    return heads.join(chosen.select(*strata).distinct(), strata, "left_anti").select(*df.columns).orderBy(size, key).limit(max(0, most - chosen.count()))


def missing_strata(whole: DataFrame, part: DataFrame, strata: list[str]) -> DataFrame:
    """Strata of ``whole`` that ``part`` has no row of."""
    return whole.select(*strata).distinct().join(part.select(*strata).distinct(), strata, "left_anti")


def top(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order`` (a column with - before it descends), by a heap in each task."""
    return df.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]).limit(n)


def stride_sample(df: DataFrame, position: str, stride: int, n: int) -> DataFrame:
    """Every ``stride``-th position, up to ``n`` of them."""
    return df.where(F.col(position) % stride == 0).orderBy(position).limit(n)
