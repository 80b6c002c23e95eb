"""Turns of a conversation as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUESTION = "array<struct<id:string,text:string>>"
ANSWER = "array<struct<question_id:string,selected:array<string>,number:double,text:string>>"


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content) of turns (conv_id, turn, role, text, questions, answers).

    A user's answers carry the text of the question asked in the preceding assistant turn
    (its id if that is unknown); an answer's own text comes before its selection, that before
    its number. A user turn with nothing in it reads ``(no response)``.
    """
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    asked = F.last(F.when(F.col("role") == "assistant", F.coalesce("questions", F.array().cast(QUESTION))), ignorenulls=True).over(w)
    x = turns.withColumn("asked", F.map_from_entries(F.array_distinct(F.transform(F.coalesce(asked, F.array().cast(QUESTION)), lambda q: F.struct(q["id"], q["text"])))))
    number = lambda a: F.when(a["number"] == F.floor(a["number"]), F.format_string("%d", a["number"].cast("long"))).otherwise(a["number"].cast("string"))
    said = lambda a: F.coalesce(F.nullif(F.trim(a["text"]), F.lit("")), F.nullif(F.array_join(F.coalesce(a["selected"], F.array()), ", "), F.lit("")), number(a), F.lit("(no response)"))
    lines = F.transform(F.coalesce("answers", F.array().cast(ANSWER)), lambda a: F.concat(F.coalesce(F.try_element_at("asked", a["question_id"]), a["question_id"], F.lit("?")), F.lit(": "), said(a)))
    user = F.array_join(F.filter(F.concat(F.array(F.coalesce(F.trim("text"), F.lit(""))), lines), lambda s: s != ""), "\n")
    content = F.when(F.col("role") == "user", F.coalesce(F.nullif(user, F.lit("")), F.lit("(no response)"))).otherwise(F.coalesce("text", F.lit("")))
    return x.select("conv_id", "turn", "role", content.alias("content"))
