"""References to records that do not exist, kept by signed counts.

Every change is a delta on a key: a reference is ``refs +1``, a load of a record is
``loads +1, live +1``, a deletion ``live -1``. Summed up to a moment the deltas say
whether the key existed then. ``apply_deltas`` keeps the sums as a state table that later
deltas are added to; ``orphan_report`` replays the deltas and judges every reference at
its own moment.

A key may hold any share of the rows: references are summed per (table, key, moment)
before the first shuffle, the running sums are taken per (key, day), and each day starts
from a carried-over sum, so that no task needs the whole history of a key in one group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from manualmill.functions.ids import base_id, canonical_form

NEVER = 2**61  # microseconds; stands for an unknown moment
DAY = 86_400_000_000


def _micros(c: Column) -> Column:
    return F.coalesce(F.unix_micros(c.cast("timestamp")), F.lit(NEVER))


def month_of(micros: Column) -> Column:
    """``YYYY-MM`` in UTC, whatever the session's zone; null for an unknown moment."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(micros / F.lit(DAY)).cast("int"))
    return F.when(micros < NEVER, F.date_format(day, "yyyy-MM"))


def reference_deltas(name: str, df: DataFrame, key: Column, at: Column) -> DataFrame:
    """(table_name, key, at, refs, loads, live); null and blank keys are no references."""
    return (
        df.select(canonical_form(key).alias("key"), _micros(at).alias("at"))
        .filter("key IS NOT NULL")
        .groupBy("key", "at")
        .agg(F.count(F.lit(1)).alias("refs"))
        .select(F.lit(name).alias("table_name"), "key", "at", "refs", F.lit(0).cast("long").alias("loads"), F.lit(0).cast("long").alias("live"))
    )


def record_deltas(df: DataFrame, key: str, loaded: str, deleted: str) -> DataFrame:
    """A record counts for its own id and, if that has a suffix ``_vN``, for the id without it."""
    keys = F.array_distinct(F.array(F.col(key), base_id(F.col(key))))
    up, down = _micros(F.col(loaded)), F.greatest(_micros(F.col(loaded)), _micros(F.col(deleted)))
    one = lambda at, loads, live: F.struct(at.alias("at"), F.lit(loads).cast("long").alias("loads"), F.lit(live).cast("long").alias("live"))
    changes = F.when(F.col(deleted).isNull(), F.array(one(up, 1, 1))).otherwise(F.array(one(up, 1, 1), one(down, 0, -1)))
    return (
        df.filter(F.col(key).isNotNull())
        .select(F.explode(keys).alias("key"), changes.alias("c"))
        .select("key", F.explode("c").alias("c"))
        .groupBy("key", F.col("c.at").alias("at"))
        .agg(F.sum("c.loads").alias("loads"), F.sum("c.live").alias("live"))
        .select(F.lit(None).cast("string").alias("table_name"), "key", "at", F.lit(0).cast("long").alias("refs"), "loads", "live")
    )


def apply_deltas(state: DataFrame | None, deltas: DataFrame) -> DataFrame:
    """The state (table_name, key, refs, loads, live) after the deltas; order of arrival does not matter.

    Existence deltas have no table_name and form one row per key; reference deltas one per table and key.
    """
    d = deltas.select("table_name", "key", "refs", "loads", "live")
    return (d if state is None else state.unionByName(d)).groupBy("table_name", "key").agg(*(F.sum(c).alias(c) for c in ("refs", "loads", "live")))


def current_orphans(state: DataFrame) -> DataFrame:
    """Keys with positive references and zero existence now: (table_name, ref_key, refs, reason missing/deleted)."""
    refs = state.filter("refs > 0").select("table_name", "key", "refs")
    there = state.filter("table_name IS NULL").select("key", "loads", "live")
    return (
        refs.join(there, "key", "left")
        .filter("coalesce(live, 0) <= 0")
        .select("table_name", F.col("key").alias("ref_key"), "refs", F.when(F.coalesce("loads", F.lit(0)) > 0, "deleted").otherwise("missing").alias("reason"))
    )


def orphan_report(references: list[DataFrame], records: DataFrame) -> DataFrame:
    """One row per table, month, key and reason: (table_name, period, ref_key, reason, refs).

    A reference at moment t is an orphan if the live count of its key is zero then; deltas
    at the same moment come first. reason: ``missing`` if no record ever had the key,
    ``late`` if all were loaded after t, else ``deleted``. Defined for dirty input: a
    reference without a moment is judged by the final state and has period null; a record
    without a load moment is not missing, but live only for references without one; a deletion before the load
    makes a record that is never live.
    """
    day = F.floor(F.col("at") / F.lit(DAY))
    deltas = reduce(DataFrame.unionByName, [*references, records]).withColumn("day", day)
    # one row per key and day: bounded by the calendar, not by the rows of a key
    daily = deltas.groupBy("key", "day").agg(F.sum("loads").alias("loads"), F.sum("live").alias("live"))
    past = Window.partitionBy("key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("key")
    carried = daily.select(
        F.lit(None).cast("string").alias("table_name"), "key", F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("refs"),
        F.coalesce(F.sum("loads").over(past), F.lit(0)).alias("loads"), F.coalesce(F.sum("live").over(past), F.lit(0)).alias("live"), "day",
        F.sum("loads").over(every).alias("ever"),
    )
    now = Window.partitionBy("key", "day").orderBy("at", F.col("table_name").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = deltas.withColumn("ever", F.lit(0).cast("long")).unionByName(carried)
    judged = seen.select(
        "table_name", "key", "at", "refs", F.sum("loads").over(now).alias("loads"), F.sum("live").over(now).alias("live"), F.sum("ever").over(now).alias("ever")
    ).filter("table_name IS NOT NULL AND live <= 0")
    reason = F.when(F.col("ever") == 0, "missing").when(F.col("loads") == 0, "late").otherwise("deleted")
    return judged.groupBy("table_name", month_of(F.col("at")).alias("period"), F.col("key").alias("ref_key"), reason.alias("reason")).agg(F.sum("refs").alias("refs"))
