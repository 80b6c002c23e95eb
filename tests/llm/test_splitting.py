from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from manualmill.llm.splitting import Limits, split, split_text

WORDS = st.lists(st.sampled_from(["# head\n", "word ", "A sentence. ", "\n\n", "\n", "- item\n", "| a | b |\n", "```\n", "ünïcödé", "x" * 70]), max_size=200).map("".join)


@settings(max_examples=150, deadline=None)
@given(WORDS, st.integers(5, 60), st.integers(0, 120))
def test_pieces_tile_the_text_and_fit(text, tokens, overlap):
    limits = Limits(tokens, overlap)
    parts = split_text(text, limits)
    assert "".join(text[c:e] for _, c, e, _ in parts) == text
    assert all(e - s <= limits.max_chars and s <= c for s, c, e, _ in parts)
    assert parts[0][0] == 0 and all(c - s <= overlap for s, c, _, _ in parts)


def test_cuts_prefer_headings_and_keep_code_whole():
    body = "Sentence one is here. " * 20
    text = f"# a\n{body}\n# b\n{body}\n"
    (_, _, end, _), (_, core, _, kind) = split_text(text, Limits(150, 0))
    assert text[core:].startswith("# b") and kind == 6 and end == core
    code = "x\n\n" * 30
    text = f"{body}\n```\n{code}```\n{body}"
    assert all(text[c : c + 3] != "x\n\n" for _, c, _, _ in split_text(text, Limits(160, 0))[1:])


def test_no_boundary_at_all():
    parts = split_text("x" * 1000, Limits(50, 20))
    assert len(parts) == 6 and all(e - s <= 203 for s, _, e, _ in parts)


def test_rows(spark):
    rows = [("a", "short"), ("a", "short"), ("b", None), (None, ""), ("c", "word " * 100)]
    df = spark.createDataFrame(rows, "id string, t string").withColumn("text", F.lit("clash")).withColumn("piece", F.lit(1))
    out = split(df, F.col("id"), F.col("t"), Limits(50, 10)).collect()
    assert sorted((r.item_id or "", r.pieces) for r in out if r.piece == 0) == [("", 1), ("a", 1), ("c", 3)]
    assert "".join(r.text[r.core_start - r.start :] for r in sorted(out, key=lambda r: r.piece) if r.item_id == "c") == "word " * 100
    assert split(df.limit(0), F.col("id"), F.col("t")).count() == 0
