"""Which units apply to which product types.

A rule names a unit, a series, a model code and a type code; a null code matches all. The
condition ``(model IS NULL OR model IN codes) AND (type IS NULL OR type IN codes)`` has no
equality to join on, so it is split by which codes are null into four branches of equality
joins, whose union has no row twice once it is made distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active(types: DataFrame, status: str) -> DataFrame:
    """Types with status 1, whether it is kept as a number or as text."""
    return types.filter(F.col(status).cast("string") == "1")


def product_sets(products: DataFrame) -> DataFrame:
    """(series, tt_id, model_codes, tt_codes), null codes dropped."""
    return products.groupBy("series", "tt_id").agg(F.collect_set("model_code").alias("model_codes"), F.collect_set("tt_code").alias("tt_codes"))


def applicable_pairs(rules: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct (unit, tt_id). rules: unit, series, app_mod, app_tt; products: series, tt_id, model_code, tt_code.

    Rules and products are made distinct first. Model and type memberships are independent:
    a rule may match the model of one product row and the type of another of the same tt_id.
    """
    rules = rules.filter("unit IS NOT NULL AND series IS NOT NULL").distinct()
    base = products.select("series", "tt_id").distinct()
    model = products.filter("model_code IS NOT NULL").select("series", "tt_id", F.col("model_code").alias("app_mod")).distinct()
    kind = products.filter("tt_code IS NOT NULL").select("series", "tt_id", F.col("tt_code").alias("app_tt")).distinct()
    any_any = rules.filter("app_mod IS NULL AND app_tt IS NULL").select("unit", "series").distinct().join(base, "series")
    mod_any = rules.filter("app_mod IS NOT NULL AND app_tt IS NULL").join(model, ["series", "app_mod"])
    any_tt = rules.filter("app_mod IS NULL AND app_tt IS NOT NULL").join(kind, ["series", "app_tt"])
    both = rules.filter("app_mod IS NOT NULL AND app_tt IS NOT NULL").join(model, ["series", "app_mod"]).join(kind, ["series", "app_tt", "tt_id"])
    out = None
    for part in (any_any, mod_any, any_tt, both):
        part = part.select("unit", "tt_id")
        out = part if out is None else out.unionByName(part)
    return out.distinct()
