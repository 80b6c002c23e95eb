"""Documented relational semantics around machines: serial ranges, codes, operations, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def serial_match(vin: Column, low: Column, high: Column) -> Column:
    """Whether a serial lies in a masked range: ``*`` in the lower bound hides that position in all three.

    A trailing `` -`` of the lower bound is dropped. Null where a bound is missing or the text
    ``NULL``, or the lengths differ.
    """
    low = F.regexp_replace(F.trim(low), r"\s*-$", "")
    keep = lambda c: F.array_join(F.filter(F.zip_with(F.split(c, ""), F.split(low, ""), lambda x, m: F.when(m != "*", x)), lambda x: x.isNotNull()), "")
    usable = vin.isNotNull() & low.isNotNull() & high.isNotNull() & (F.upper(high) != "NULL") & (F.upper(low) != "NULL") & (F.length(vin) == F.length(low)) & (F.length(low) == F.length(high))
    return F.when(usable, (keep(vin) >= keep(low)) & (keep(vin) <= keep(high)))


def taxonomy(code: Column) -> dict[str, Column]:
    """Split at the first ``-``: left levels and right levels as arrays; empty if missing."""
    left, right = F.regexp_extract(code, r"^([^-]*)", 1), F.regexp_extract(code, r"^[^-]*-(.*)$", 1)
    levels = lambda c: F.filter(F.split(c, r"\."), lambda x: x != "")
    return {"left": levels(left), "right": levels(right)}


def series_code(*levels: Column) -> Column:
    """Levels joined by dots; null if one is missing."""
    whole = F.concat_ws(".", *levels)
    ok = levels[0].isNotNull()
    for c in levels[1:]:
        ok = ok & c.isNotNull()
    return F.when(ok, whole)


def shard(vin: Column) -> Column:
    """One of 256 shards: the first byte of the hash of the last eight characters, as two hex digits."""
    return F.substring(F.sha2(F.right(vin, F.lit(8)), 256), 1, 2)


def included_operations(parents: DataFrame, children: DataFrame) -> DataFrame:
    """(parent, includes sorted distinct, time) over children with status ``I``."""
    return parents.join(children.filter("status = 'I'"), "link").groupBy("parent").agg(F.array_sort(F.collect_set("child")).alias("includes"), F.sum("time").alias("time"))


def title_of(xml_title: Column, table_title: Column, unit: Column) -> Column:
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(blank(xml_title), blank(table_title), unit)


def long_serial(machines: DataFrame, pairs: DataFrame) -> DataFrame:
    """Machines (vin) with the 17-character form of pairs (short, long); a vin without one stays as it is."""
    return machines.join(pairs.withColumnRenamed("short", "vin"), "vin", "left").withColumn("long", F.coalesce("long", "vin"))


def machine_types(serials: DataFrame, types: DataFrame, products: DataFrame) -> DataFrame:
    """(vin, tt_id, product columns): serials (vin, tt_code) to active types (tt_id, tt_code, status, low, high) whose range holds the vin, to products.

    Ranges that cannot be judged do not exclude a type.
    """
    near = serials.join(types.filter(F.col("status").cast("string") == "1"), "tt_code")
    return near.filter(F.coalesce(serial_match(F.col("vin"), F.col("low"), F.col("high")), F.lit(True))).select("vin", "tt_id").distinct().join(products, "tt_id")


def type_operations(types: DataFrame, times: DataFrame) -> DataFrame:
    """Operations per type: types (tt_id, srt_code, column_number), times (srt_code, column_number, part ids p1..p4, units); the id has four dotted parts."""
    return types.join(times, ["srt_code", "column_number"]).select("tt_id", F.concat_ws(".", "p1", "p2", "p3", "p4").alias("operation"), "units").distinct()
