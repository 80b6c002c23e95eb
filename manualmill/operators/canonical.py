"""Exact deduplication and version-aware canonicalisation.

All choices that depend on an order name that order, so results do not depend on how the
input is partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from manualmill.functions.text import jaccard, normalised_xml, raw_token_set, sha256


def exact_duplicates(df: DataFrame, content: str, unit: str, kind: str, series: str, path: str) -> DataFrame:
    """One row per content: hash, first unit and kind by (series, path), appearances in that order, all ids of the content."""
    src = df.filter(F.col(content).isNotNull()).select(sha256(F.col(content)).alias("hash"), F.struct(F.col(series).alias("series"), F.col(path).alias("filepath")).alias("at"), F.col(unit).alias("unit"), F.col(kind).alias("kind"))
    return src.groupBy("hash").agg(
        F.min_by("unit", F.struct("at", "unit")).alias("unit"),
        F.min_by("kind", F.struct("at", "unit")).alias("kind"),
        F.sort_array(F.collect_list("at")).alias("appearances"),
        F.sort_array(F.collect_set("unit")).alias("units"),
    )


def variants(df: DataFrame, unit: str, content: str, appearances: Column) -> DataFrame:
    """(unit, hash, content, n_appearances), one row per unit and content; contents that are null share the hash null."""
    return df.select(F.col(unit).alias("unit"), sha256(F.col(content)).alias("hash"), F.col(content).alias("content"), appearances.alias("n")).groupBy("unit", "hash").agg(F.first("content").alias("content"), F.sum("n").alias("n"))


def variant_pairs(v: DataFrame) -> DataFrame:
    """(unit, hash_a, hash_b, jaccard) of the variants of one unit, on token sets of the raw text."""
    side = lambda x: v.filter("content IS NOT NULL").select("unit", F.col("hash").alias(f"hash_{x}"), raw_token_set(F.col("content")).alias(f"t{x}"))
    return side("a").join(side("b"), "unit").filter("hash_a < hash_b").select("unit", "hash_a", "hash_b", jaccard(F.col("ta"), F.col("tb")).alias("jaccard"))


def resolve(v: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Canonical records of variants: canonical_id, raw_hash, resolution, variant_count, n_appearances.

    ``single``: one content. ``unfetchable``: no content at all; the variant with most
    appearances stands. ``trivial``: contents agree once normalised; the one with most
    appearances stands. ``version_merge``: all normalised contents are pairwise similar; the
    longest stands. ``major_split``: all stay, longest first, as ``<unit>_v1`` and so on.
    Variants without content count, but never stand where another has content.
    """
    n = v.withColumn("norm", sha256(normalised_xml(F.col("content")))).withColumn("length", F.length("content"))
    unit = Window.partitionBy("unit")
    n = n.withColumn("variant_count", F.count(F.lit(1)).over(unit)).withColumn("all_n", F.sum("n").over(unit))
    norms = n.groupBy("unit", "norm").agg(
        F.max_by(F.struct("hash", "content", "length"), F.struct("n", "hash")).alias("top"), F.sum("n").alias("n"), F.first("variant_count").alias("variant_count"), F.first("all_n").alias("all_n")
    )
    have = norms.filter("norm IS NOT NULL")
    pairs = variant_pairs(have.select("unit", F.col("norm").alias("hash"), F.col("top.content").alias("content")))
    alike = pairs.groupBy("unit").agg(F.min("jaccard").alias("least"))
    counted = norms.withColumn("groups", F.count("norm").over(unit)).join(alike, "unit", "left")
    counted = counted.filter("norm IS NOT NULL OR groups = 0")
    size = Window.partitionBy("unit").orderBy(F.desc("top.length"), F.desc("n"), "top.hash")
    ranked = counted.withColumn("rank", F.row_number().over(size))
    kind = (
        F.when(F.col("groups") == 0, "unfetchable").when(F.col("variant_count") == 1, "single").when(F.col("groups") == 1, "trivial").when(F.col("least") >= threshold, "version_merge").otherwise("major_split")
    )
    kept = ranked.withColumn("resolution", kind).filter((F.col("resolution") == "major_split") | (F.col("rank") == 1))
    split = F.col("resolution") == "major_split"
    return kept.select(
        F.when(split, F.concat("unit", F.lit("_v"), F.col("rank").cast("string"))).otherwise(F.col("unit")).alias("canonical_id"),
        F.col("top.hash").alias("raw_hash"), "resolution", F.col("variant_count").cast("int").alias("variant_count"), F.when(split, F.col("n")).otherwise(F.col("all_n")).alias("n_appearances"),
    )


def first_per_key(df: DataFrame, key: str, *order: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """The first row of each key by ``order``, then by the hash of the columns in ``ties``; pre-limited in each map partition. Rows equal in all of these may stand for each other."""
    w = Window.partitionBy(key).orderBy(*order, *([F.xxhash64(*ties)] if ties else []))
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def documents(df: DataFrame) -> DataFrame:
    """Wrapper documents: the first entry by (loaded_at, series), and all series in which the document appears."""
    first = first_per_key(df, "document_id", "loaded_at", "series", "doc_name").select("document_id", "series", "doc_name", "iu_ids", F.size("iu_ids").alias("num_ius"))
    series = df.select("document_id", F.explode(F.array_union(F.coalesce("appearances", F.array()), F.array("series"))).alias("s")).groupBy("document_id").agg(F.sort_array(F.collect_set("s")).alias("appearances"))
    return first.join(series, "document_id")
