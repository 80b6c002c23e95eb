"""Markup residue: which foreign notations a text holds, and the clean text.

The notation of a field is given; everything whole or broken of another notation is
residue. Code, inline or in blocks, is set aside first and kept as it is. Scanning looks
for single marks before any pattern runs, so texts without them cost one pass. Cleaning
keeps headings, lists, tables, code and formulas, and drops or resolves the rest; its
output has one notation: ``#`` headings, ``-`` and ``1.`` items, ``|`` tables, fenced code
and ``$`` formulas.

Both work on one text at a time in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manualmill.session import unpacked


# fixed values: the elements of HTML
HTML_TAGS = frozenset(
    "a abbr acronym address area article aside audio b base bdi bdo big blockquote body br button canvas caption center cite code col colgroup "
    "data datalist dd del details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html i iframe img input ins kbd label legend li link main map mark menu meta meter nav noscript object ol optgroup "
    "option output p param picture pre progress q rp rt ruby s samp script search section select slot small source span strike strong style sub "
    "summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr".split()
)
# fixed values: commands that are LaTeX without an argument too
_COMMANDS = "begin|end|item|textbf|textit|texttt|emph|underline|frac|sqrt|SI|si|unit|qty|section|subsection|subsubsection|paragraph|chapter|cite|ref|label|footnote|caption|includegraphics|hline|centering|mathrm|mathbf|times|cdot|pm|leq|geq|approx|alpha|beta|mu|Omega|circ|degree|sum|int|left|right|quad|newline|noindent|documentclass|usepackage"
_LATEX = re.compile(rf"\\(?:[A-Za-z]+\*?\s?[{{\[]|(?<![\w:.]\\)(?:{_COMMANDS})(?![A-Za-z]))|\$(?![\s$])[^$\n\\^_{{]*[\\^_{{][^$\n]*(?<!\s)\$|\$\$[^$]+\$\$|\\\((?:(?!\\[()])[^\n])+\\\)")
_WIKI = re.compile(r"\[\[[^\[\]|\n]+(?:\]\]|\||$)|(?<!\{)\{\{[^{}\n]|^\s*\{\|.*$|^\s*\|\}|^\s*\|-\s*$|'''|(?<![\w'])''(?=\w)[^'\n]+''(?!')|^={2,6}\s?[^=\n]+?\s?={2,6}\s*$|__(?:NO)?TOC__", re.MULTILINE)
_TAG = re.compile(r"</?[A-Za-z][\w:.-]*(?:\s[^<>\n]*)?/?>|<[A-Za-z][\w:.-]*\s+[\w:.-]+\s*=\s*[\"']|</[A-Za-z]|<!--|-->|<![A-Za-z\[]|<\?|\?>")
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|&(?:nbsp|amp|lt|gt|quot|deg|mdash|ndash)\b")
_AUTOLINK = re.compile(r"<(?:[A-Za-z][A-Za-z0-9+.-]{1,31}:[^\s<>]*|[\w.+-]+@[\w.-]+)>")
_FENCE = re.compile(r"^[ \t]*(`{3,}|~{3,})[^\n]*\n.*?(?:^[ \t]*\1[`~]*[ \t]*$|\Z)|(?<!`)(`+)(?!`)(?:[^\n]|\n(?!\n))+?(?<!`)\2(?!`)", re.MULTILINE | re.DOTALL)
_MARKDOWN = re.compile(r"\*\*[^\s*]|__\w[^\n_]*__|^[ \t]*#{1,6}[ \t]+\S|!\[[^\]\n]*\]|\]\([^()\s]+\)|^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\||\|[ \t]*:?-{3,}:?[ \t]*\||`[^`\n]+`|```|~~\w[^~\n]*~~|^[ \t]*(?:[-*+]|\d{1,3}[.)])[ \t]+\S|^[ \t]*>[ \t]+\S|(?<![\w*\\])\*\w[^*\n]*\w\*(?![\w*])", re.MULTILINE)
_HTML_CODE = re.compile(r"<(pre|code|kbd|samp|script|style)\b.*?</\1\s*>", re.IGNORECASE | re.DOTALL)
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)
_NAME = re.compile(r"</?([A-Za-z][\w:.-]*)")
_ANY_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_TWICE = re.compile(r"&amp;(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|&lt;(?:/?[A-Za-z][\w:.-]*(?:\s(?:(?!&[lg]t;)[^\n])*)?/?|[!?](?:(?!&[lg]t;)[^\n])*)&gt;")
_INLINE = frozenset("a abbr b big cite code dfn em font i kbd mark q s samp small span strong sub sup tt u var".split())


def in_markdown(text: str) -> list[str]:
    """Foreign notations in a Markdown text: html, entity, wiki, latex."""
    if not any(c in text for c in "<&\\$[{'=_>"):
        return []
    t = _FENCE.sub(" ", text) if "`" in text or "~~~" in text else text
    out = []
    if ("<" in t or ">" in t) and _TAG.search(_AUTOLINK.sub(" ", t)):
        out.append("html")
    if "&" in t and _ENTITY.search(t):
        out.append("entity")
    if ("[[" in t or "{" in t or "''" in t or "==" in t or "|}" in t or "|-" in t or "__" in t) and _WIKI.search(_without_tables(t)):
        out.append("wiki")
    if ("\\" in t or "$" in t) and _LATEX.search(t):
        out.append("latex")
    return out


def _without_tables(t: str) -> str:
    """Without the rows of Markdown tables, whose marks wiki tables share."""
    return re.sub(r"^[ \t]*\|(?![-}][ \t]*$).*\|[ \t]*$", " ", t, flags=re.MULTILINE) if "|" in t else t


def in_html(text: str) -> list[str]:
    """Foreign notations in an HTML text: unknown tags, processing instructions, escaped, markdown, wiki, latex. Comments are HTML."""
    t = _COMMENT.sub(" ", text) if "<!--" in text else text
    low = t.lower() if "<pre" in t or "<code" in t or "<PRE" in t or "<CODE" in t or "<kbd" in t or "<samp" in t or "<script" in t or "<style" in t else ""
    if low:
        t = _HTML_CODE.sub(" ", t)
    out = []
    if not {x.lower() for x in _NAME.findall(t)} <= HTML_TAGS:
        out.append("unknown tag")
    if "<?" in t or "?>" in t:
        out.append("instruction")
    if ("&amp;" in t or "&lt;" in t) and _TWICE.search(t):
        out.append("escaped")
    if any(m in t for m in ("**", "__", "#", "![", "](", "---", "`", "~~", "* ", "- ", "+ ", "*", ". ", ") ", "'''", "''", "[[", "{{", "{|", "|}", "==", "\\", "$", "&gt;")):
        s = _ANY_TAG.sub(_gap, t)
        if _MARKDOWN.search(s) or "&gt; " in s and re.search(r"^[ \t]*&gt;[ \t]+[A-Za-z]", s, re.MULTILINE):
            out.append("markdown")
        if ("[[" in s or "{" in s or "''" in s or "==" in s or "|" in s or "__" in s) and _WIKI.search(s):
            out.append("wiki")
        if ("\\" in s or "$" in s) and _LATEX.search(s):
            out.append("latex")
    return out


def _gap(m: re.Match) -> str:
    name = m.group().strip("</> \n").split(None, 1)[0].rstrip("/").lower() if len(m.group()) > 3 else m.group().strip("</>").lower()
    return "" if name in _INLINE else "\n"


# ---------------------------------------------------------------- cleaning

_LATEX_RULES = [
    (re.compile(r"\\begin\{[^}\n]*\}(?:\[[^\]\n]*\])?|\\end\{[^}\n]*\}"), "\n"),
    (re.compile(r"[ \t]*\\item\b[ \t]*"), "\n- "),
    (re.compile(r"\\(?:SI|qty)\{([^{}\n]*)\}\{\\?([^{}\n]*)\}"), r"\1 \2"),
    (re.compile(r"\\(?:section|chapter)\*?\{([^{}\n]*)\}"), r"\n# \1\n"),
    (re.compile(r"\\sub(?:sub)?section\*?\{([^{}\n]*)\}"), r"\n## \1\n"),
    (re.compile(r"\\[A-Za-z]+\*?\{([^{}\n]*)\}"), r"\1"),
    (re.compile(rf"\\(?:{_COMMANDS})(?![A-Za-z])[ \t]*"), ""),
]
_WIKI_RULES = [
    (re.compile(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]*)\]\]"), r"\1"),
    (re.compile(r"\{\{(?:[^{}|\n]*\|)?([^{}\n]*)\}\}"), r"\1"),
    (re.compile(r"^[ \t]*(?:\{\|.*|\|\}|\|-+)[ \t]*$\n?", re.MULTILINE), ""),
    (re.compile(r"^={2,6}\s?([^=\n]+?)\s?={2,6}[ \t]*$", re.MULTILINE), r"## \1"),
    (re.compile(r"'{2,5}"), ""),
    (re.compile(r"__(?:NO)?TOC__"), ""),
]
# fixed values: environments that hold a formula
_ENVIRONMENTS = "equation|align|gather|multline|eqnarray|math|displaymath"
_MATH = re.compile(
    rf"\$\$[^$]+\$\$|\$(?![\s$])[^$\n\\^_{{]*[\\^_{{][^$\n]*(?<!\s)\$|\\\((?:(?!\\[()])[^\n])+\\\)|\\\[(?:(?!\\[\[\]]).)*[\\^_{{](?:(?!\\[\[\]]).)*\\\]|\\begin\{{(?P<kind>(?:{_ENVIRONMENTS})\*?)\}}(?:(?!\\(?:begin|end)\{{).)*\\end\{{(?P=kind)\}}",
    re.DOTALL,
)
_EMPHASIS = re.compile(r"(?<![\w*\\])(\*{1,3}|_{1,3})(?=\S)([^*_\n]+?)(?<=\S)\1(?![\w*])")
_LINK = re.compile(r"!?\[([^\[\]\n]*)\]\([^()\n]*\)")
_BLOCK_OPEN = re.compile(r"<(?:br|p|div|tr|li|ul|ol|table|h[1-6])\b[^<>\n]*>|</(?:p|div|tr|li|ul|ol|table|h[1-6])>", re.IGNORECASE)
_SPACE = re.compile(r"[ \t]+\n|\n{3,}")


def _strip_foreign(t: str) -> str:
    """A stretch without code: foreign notations resolved or dropped."""
    for _ in range(2):  # what was escaped once too often is markup after the first turn
        if "<" in t or "?>" in t:
            t = re.sub(r"<!--.*?(?:-->|\Z)|<\?.*?(?:\?>|$)|<![A-Za-z\[][^>\n]*>|-->|\?>", "", _AUTOLINK.sub(lambda m: m.group()[1:-1], t), flags=re.DOTALL | re.MULTILINE)
            t = _BLOCK_OPEN.sub("\n", t)
            t = re.sub(r"</?[A-Za-z][\w:.-]*(?:\s[^<>\n]*)?/?>|</[A-Za-z][\w:.-]*|<[A-Za-z][\w:.-]*(?:\s+[\w:.-]+\s*=\s*(?:\"[^\"\n]*\"|'[^'\n]*'))+\s*", "", t)
        if "&" not in t:
            break
        t = html.unescape(t)
    formulas: list[str] = []
    if "$" in t or "\\" in t:
        t = _MATH.sub(lambda m: formulas.append(m.group()) or f"\0{len(formulas) - 1}\0", t)
    if "\\" in t:
        for _ in range(2):
            for rule, by in _LATEX_RULES:
                t = rule.sub(by, t)
    for rule, by in _WIKI_RULES:
        t = rule.sub(by, t)
    t = _LINK.sub(r"\1", t)
    t = _EMPHASIS.sub(r"\2", _EMPHASIS.sub(r"\2", t))
    return re.sub("\0(\\d+)\0", lambda m: formulas[int(m.group(1))], t)


def clean_markdown(text: str) -> str:
    """Clean text of a Markdown document; cleaning it again changes no heading, item, table, code or formula."""
    out, at = [], 0
    for m in _FENCE.finditer(text):
        out += [_strip_foreign(text[at : m.start()]), m.group()]
        at = m.end()
    out.append(_strip_foreign(text[at:]))
    return _SPACE.sub(lambda m: "\n\n" if m.group().count("\n") > 1 else "\n", "".join(out)).strip()


_TOKEN = re.compile(r"<(/?)([A-Za-z][\w:.-]*)[^<>]*?(/?)>")
_ALT = re.compile(r"\balt\s*=\s*[\"']([^\"']*)", re.IGNORECASE)


def clean_html(text: str) -> str:
    """Clean text of an HTML document, in the notation of ``clean_markdown``."""
    blocks: list[str] = []

    def code(m: re.Match) -> str:
        if m.group(1).lower() in ("script", "style"):
            return ""
        body = html.unescape(_ANY_TAG.sub("", m.group()))
        blocks.append(f"\n```\n{body.strip(chr(10))}\n```\n" if m.group(1).lower() == "pre" else f"`{body}`")
        return f"\1{len(blocks) - 1}\1"

    t = _HTML_CODE.sub(code, _COMMENT.sub("", text))
    out: list[str] = []
    lists: list[list] = []
    cells, at = 0, 0
    head = False
    for m in _TOKEN.finditer(t):
        out.append(re.sub(r"\s*\n\s*", " ", t[at : m.start()]) if cells else t[at : m.start()])
        at = m.end()
        closing, name = bool(m.group(1)), m.group(2).lower()
        if name in ("ul", "ol"):
            lists.pop() if closing and lists else None
            lists.append([name, 0]) if not closing else None
            out.append("\n")
        elif name == "li":
            if not closing:
                if lists:
                    lists[-1][1] += 1
                depth = "  " * max(0, len(lists) - 1)
                out.append(f"\n{depth}{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else f"\n{depth}- ")
        elif name == "tr":
            out.append("\n" if not closing else (" |" if cells else ""))
            if closing and head and cells:
                out.append("\n|" + "---|" * cells)
            cells, head = (0, False) if not closing or not cells else (0, False)
        elif name in ("td", "th"):
            if not closing:
                cells += 1
                head |= name == "th"
                out.append("| " if cells == 1 else " | ")
        elif len(name) == 2 and name[0] == "h" and name[1] in "123456":
            out.append("\n\n" if closing else "\n\n" + "#" * int(name[1]) + " ")
        elif name == "img":
            alt = _ALT.search(m.group())
            out.append(alt.group(1) if alt else "")
        elif name not in _INLINE:
            out.append(" " if cells else "\n")
    out.append(t[at:])
    flat = _strip_foreign("".join(out))
    flat = re.sub("\1(\\d+)\1", lambda m: blocks[int(m.group(1))], flat)
    return _SPACE.sub(lambda m: "\n\n" if m.group().count("\n") > 1 else "\n", flat).strip()


KINDS = {"markdown": (in_markdown, clean_markdown), "html": (in_html, clean_html)}


def residue(df: DataFrame, item: str, fields: dict[str, str], clean: bool = False) -> DataFrame:
    """(item_id, field, notations[, clean]) for each item and field with residue, or with ``clean`` for every text that is not null.

    fields: column -> its own notation, ``markdown`` or ``html``. Null items and texts give no row; repeated rows give repeated rows.
    """
    item_type = dict(df.dtypes)[item]
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, cols = b.column(0), []
            rows: dict[str, list] = {"item": [], "field": [], "notations": [], "clean": []}
            for k, name in enumerate(names):
                scan, tidy = KINDS[fields[name]]
                for i, t in zip(range(b.num_rows), b.column(k + 1)):
                    t = t.as_py()
                    if t is None:
                        continue
                    found = scan(t)
                    if found or clean:
                        rows["item"].append(ids[i].as_py()), rows["field"].append(name), rows["notations"].append(found)
                        rows["clean"].append(tidy(t) if clean else None)
            cols = [pa.array(rows["item"], b.schema.field(0).type), pa.array(rows["field"], pa.string()), pa.array(rows["notations"], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(rows["clean"], pa.string())] if clean else []), names=["item_id", "field", "notations", "clean"][: 3 + clean])

    src = df.filter(F.col(item).isNotNull()).select(F.col(item).alias("item_id"), *(F.col(n).alias(f"text_{k}") for k, n in enumerate(names)))
    return unpacked(src).mapInArrow(run, f"item_id {item_type}, field string, notations array<string>" + (", clean string" if clean else ""))
