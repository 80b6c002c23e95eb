import pytest
from pyspark.sql import functions as F

from manualmill.llm import markup as M

MD = {
    "plain **bold** [x](y) <https://a.invalid> R&D, 3 < 5, $40 and $50, \\*x\\*, C:\\new\\item1, x_{2} x^2": [],
    "`<b>` and\n```\n<b>&nbsp;\n```\n| a | b |\n|---|---|\n| 1 | 2 |": [],
    "a <b>c</b>": ["html"], "broken </p here": ["html"], '<td align="left"  x': ["html"], "<!-- c --> x": ["html"], "<?Pub x?>": ["html"],
    "30&deg;C": ["entity"], "&#8211;": ["entity"], "[[A|b]] '''c'''": ["wiki"], "{| class=x\n|-\n|}": ["wiki"], "== H ==\nx": ["wiki"], "{{note|x}}": ["wiki"],
    "\\textbf{x}": ["latex"], "$\\frac{a}{b}$": ["latex"], "\\begin{itemize}": ["latex"],
}
HTML = {
    "<p>R&amp;D 5 &lt; 6 <!-- c --> #24 screw 5 * 3 [24] $4 and $5</p>": [], "<pre># x **y** <foo></pre><code>&amp;lt;</code>": [], "<ul><li>a</li></ul>": [],
    "<p>**x** y</p>": ["markdown"], "<p>\n## x</p>": ["markdown"], "<p>[a](b:c)</p>": ["markdown"], "<Torque_Value>3</Torque_Value>": ["unknown tag"], "<p><?Pub x?></p>": ["instruction"],
    "<p>a &amp;nbsp; b</p>": ["escaped"], "<p>&lt;b&gt;x&lt;/b&gt;</p>": ["escaped"], "<p>[[A|b]]</p>": ["wiki"], "<p>\\textit{x}</p>": ["latex"],
}


@pytest.mark.parametrize("text", MD)
def test_markdown(text):
    assert M.in_markdown(text) == MD[text]
    assert M.in_markdown(M.clean_markdown(text)) in ([], ["latex"])  # formulas stay


@pytest.mark.parametrize("text", HTML)
def test_html(text):
    assert M.in_html(text) == HTML[text]


def test_cleaning_keeps_structure():
    got = M.clean_html("<h2>T &amp; x</h2><p>a <b>b</b></p><ol><li>one</li><li>two<ul><li>in</li></ul></li></ol><table><tr><th>h</th><th>i</th></tr><tr><td>1</td><td>2</td></tr></table><pre>x &lt; y\n  z</pre><p>$\\frac{1}{2}$</p>")
    assert got.startswith("## T & x") and "1. one\n2. two" in got and "  - in" in got and "| h | i |\n|---|---|\n| 1 | 2 |" in got and "```\nx < y\n  z\n```" in got and "$\\frac{1}{2}$" in got
    md = M.clean_markdown("# H\n\nx <span class='a'>y</span>&nbsp;z [[U|v]] \\SI{4}{\\mm}\n\n\\begin{itemize}\n\\item q\n\\end{itemize}\n\n```\n<keep>\n```\n")
    assert md.startswith("# H") and "x y\xa0z v 4 mm" in md and "- q" in md and "```\n<keep>\n```" in md and M.clean_markdown(md) == md


def test_marks_of_any_length():
    long = "a" * 5000
    assert M.in_markdown(f"$x^{{{long}}}$") == M.in_markdown(f"\\({long}\\)") == ["latex"] and M.in_markdown(f"[[{long}|b]]") == M.in_markdown(f"''{long}''") == ["wiki"]
    assert M.in_html(f"<p>&lt;b class={long}&gt;</p>") == ["escaped"] == M.in_html(f"<p>&lt;!-- {long} --&gt;</p>")
    formula = f"\\begin{{equation}}\\frac{{{long}}}{{2}}\\end{{equation}}"
    assert M.clean_markdown(f"x {formula} y") == f"x {formula} y" and "\\[x^{2}\\]" in M.clean_markdown("so \\[x^{2}\\] holds")


def test_patterns_stay_linear():
    for t in ("$x_" * 60_000, "\\(" * 60_000, "\\[^" * 40_000, "[[a" * 60_000, "''a" * 60_000, "&lt;b " * 40_000, "\\begin{math}" * 20_000, "{{a" * 60_000):
        M.in_markdown(t), M.in_html(t), M.clean_markdown(t)


def test_long_and_odd_rows(spark):
    rows = [("a", "x <b>y</b> " * 50_000, "<p>" * 50_000), ("b", None, ""), (None, "<b>", "<x>"), ("c", "", None), ("a", "x <b>y</b> " * 50_000, None)]
    df = spark.createDataFrame(rows, "id string, md string, h string").withColumn("field", F.lit("clash")).withColumn("notations", F.lit(1))
    fields = {"md": "markdown", "h": "html"}
    assert {(r.item_id, r.field) for r in M.residue(df, "id", fields).collect()} == {("a", "md")}
    assert M.residue(df, "id", fields, clean=True).count() == 5 and M.residue(df.limit(0), "id", fields).count() == 0
