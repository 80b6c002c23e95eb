"""Unit XML to HTML by declarative rules, and HTML to Markdown.

A rule says what becomes of an element: ``unwrap`` it, ``strip`` it with all it holds, turn
it into an HTML element, or leave it to a handler. Rules come from the full table in
``tag_map.yaml``, which the caller may override by one of their own; names outside it fall
to the names and families below. Elements without a rule are unwrapped and counted.
"""

from __future__ import annotations

import html
import pkgutil
import re
import xml.etree.ElementTree as ET
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP, DASH = " ", "–"


@dataclass(frozen=True)
class Rule:
    tag: str = "div"
    unwrap: bool = False
    strip: bool = False
    attrs: dict = field(default_factory=dict)
    attrs_from: dict = field(default_factory=dict)
    prefix: str = ""
    suffix: str = ""
    list_context: str = ""
    handler: str = ""


def _note(name: str) -> Rule:
    return Rule("blockquote", attrs={"class": name.lower()}, prefix=f"<b>{name}:</b> ")


# fixed values: element names of the unit format and what they become
NAMED = {
    **{n: Rule(n) for n in ("table", "thead", "tbody", "tfoot", "hr", "sub", "sup")},
    "row": Rule("tr"), "tgroup": Rule(handler="tgroup"), "entry": Rule(handler="entry"), "colspec": Rule(strip=True), "spanspec": Rule(strip=True),
    "Full_Title": Rule("h2"), "Title": Rule("h3"), "Header": Rule("h3"), "Sub_Title": Rule("h4"), "Op_Title": Rule("h4"), "Sub_Sub_Title": Rule("h5"), "Table_Title": Rule("caption"), "table-title": Rule("caption"),
    "Para": Rule("p"), "Paragraph": Rule("p"), "chapter": Rule("section"), "context": Rule("div"), "List": Rule(handler="list"), "Ordered_List": Rule("ol"), "Unordered_List": Rule("ul"), "List_Item": Rule("li"), "Item": Rule("li"),
    **{n: _note(n) for n in ("Note", "Important", "Warning", "Caution", "Danger", "Notice", "Attention")},
    "Image": Rule(handler="image"), "Icon": Rule(handler="icon"),
    "Physical_Data": Rule(handler="physical"), "Physical_Data_MI": Rule(handler="physical_mi"), "Torque_Value": Rule(handler="physical"), "Range": Rule(handler="range"), "Range_MI": Rule(handler="range_mi"), "Tolerance": Rule(handler="tolerance"), "Imperial": Rule(strip=True),
    "Fault_Code_Reference": Rule("span", attrs={"class": "fault-code"}, attrs_from={"data-code": "code", "data-ecid": "ecid"}),
    "Part_Reference": Rule("span", attrs={"class": "part"}), "Tool_Reference": Rule("span", attrs={"class": "tool"}), "Consumable_Reference": Rule("span", attrs={"class": "consumable"}, attrs_from={"data-csid": "csid"}),
    "Warranty_Code": Rule("div", attrs={"class": "warranty"}, attrs_from={"data-code": "code", "data-time": "time"}),
    "IU_IFS_Link": Rule("a", attrs={"class": "iu-link"}, attrs_from={"data-icecode": "icecode", "data-ifsid": "ifsid"}), "IU_Reference": Rule("a", attrs={"class": "iu-link"}, attrs_from={"data-icecode": "icecode", "data-ifsid": "ifsid"}),
    "Configuration": Rule("div", attrs_from={"data-configuration": "configdata"}), "Bookmark": Rule(strip=True), "Metadata": Rule(strip=True), "Keyword": Rule(strip=True),
}
FAMILIES = [
    (re.compile(r".*_IU$"), Rule(unwrap=True)),
    (re.compile(r".*_Config$"), Rule(strip=True)),
    (re.compile(r".*Title$"), Rule("h4")),
    (re.compile(r"(?:.*_)?Instruction$"), Rule("li", list_context="ol")),
    (re.compile(r"(?:.*_)?Bullet(?:_Item)?$"), Rule("li", list_context="ul")),
    (re.compile(r"(?:Fault|Test|Symptom|Trouble|Failure)\w*$"), Rule("div")),
    (re.compile(r".*(?:Keywords?|Metadata|Speaker_Note)$"), Rule(strip=True)),
]


def _rules(text: str | bytes) -> dict[str, Rule]:
    import yaml

    raw = yaml.safe_load(text) or {}
    return {n: Rule(**{("tag" if k == "html_tag" else k): v for k, v in (r or {}).items()}) for n, r in raw.items()}


def load_rules(path: str) -> dict[str, Rule]:
    """A table of rules in YAML: element name -> html_tag, unwrap, strip, attrs, attrs_from, prefix, suffix, list_context, handler."""
    with open(path) as f:
        return _rules(f.read())


@cache
def table_rules() -> dict[str, Rule]:
    """The table shipped with the package; its ``**`` marks are bold elements in HTML."""
    rules = _rules(pkgutil.get_data("manualmill.operators", "tag_map.yaml"))
    return {n: replace(r, prefix=re.sub(r"\*\*(.+?)\*\*", r"<b>\1</b>", r.prefix)) for n, r in rules.items()}


class Converter:
    def __init__(self, rules: dict[str, Rule] | None = None):
        self.rules = {**NAMED, **table_rules(), **(rules or {})}
        self.unknown: Counter = Counter()
        self.handlers: dict[str, Callable[[ET.Element], str]] = {n[4:]: getattr(self, n) for n in dir(self) if n.startswith("_on_")}

    def rule(self, name: str) -> Rule | None:
        return self.rules.get(name) or next((r for p, r in FAMILIES if p.match(name)), None)

    def document(self, text: str) -> str:
        """HTML of an XML text; fragments are wrapped, hopeless text gives an error comment."""
        bare = re.sub(r"<\?Pub.*?\?>", "", text, flags=re.DOTALL)
        for candidate in (bare, f"<root>{bare}</root>"):
            try:
                return self.element(ET.fromstring(candidate))
            except ET.ParseError as x:
                error = x
        return f"<!-- parse error: {html.escape(str(error))} -->"

    def element(self, e: ET.Element) -> str:
        if not isinstance(e.tag, str):
            return ""
        r = self.rule(e.tag)
        if r is None:
            self.unknown[e.tag] += 1
            return self.inside(e)
        if r.strip:
            return ""
        if r.handler and r.handler in self.handlers:
            return self.handlers[r.handler](e)
        if r.unwrap:
            return self.inside(e)
        return f"<{r.tag}{self.attributes(r.attrs, {k: e.get(v) for k, v in r.attrs_from.items()})}>{r.prefix}{self.inside(e)}{r.suffix}</{r.tag}>"

    @staticmethod
    def attributes(*groups: dict) -> str:
        return "".join(f' {k}="{html.escape(str(v))}"' for g in groups for k, v in g.items() if v)

    def inside(self, e: ET.Element) -> str:
        """Own text, children and their tails. Neighbouring items of one list kind share a list; up to three other elements may stand between two items."""
        out, kids, i = [html.escape(e.text or "", quote=False)], list(e), 0
        kind = [self._list_kind(k) for k in kids]
        while i < len(kids):
            if not kind[i]:
                out += [self.element(kids[i]), html.escape(kids[i].tail or "", quote=False)]
                i += 1
                continue
            last = i
            while (nxt := next((j for j in range(last + 1, min(last + 5, len(kids))) if kind[j] == kind[i]), None)) is not None and not any(kind[j] not in ("", kind[i]) for j in range(last + 1, nxt)):
                last = nxt
            out += [f"<{kind[i]}>", *(self.element(k) for k in kids[i : last + 1]), f"</{kind[i]}>", html.escape(kids[last].tail or "", quote=False)]
            i = last + 1
        return "".join(out)

    def _list_kind(self, e: ET.Element) -> str:
        r = self.rule(e.tag) if isinstance(e.tag, str) else None
        return r.list_context if r is not None and not r.strip else ""

    # handlers
    def _on_tgroup(self, e: ET.Element) -> str:
        names = [c.get("colname") or str(i + 1) for i, c in enumerate(e.iter("colspec"))]
        for part in e:
            for entry in part.iter("entry"):
                entry.set("__head", "1" if part.tag == "thead" else "")
                if entry.get("namest") in names and entry.get("nameend") in names:
                    entry.set("__span", str(names.index(entry.get("nameend")) - names.index(entry.get("namest")) + 1))
        return self.inside(e)

    def _on_entry(self, e: ET.Element) -> str:
        span, rows = e.get("__span", ""), e.get("morerows", "")
        style = "; ".join(s for s in (f"text-align: {e.get('align')}" if e.get("align") else "", f"vertical-align: {e.get('valign')}" if e.get("valign") else "") if s)
        tag = "th" if e.get("__head") else "td"
        return f"<{tag}{self.attributes({'colspan': span if span not in ('', '1') else '', 'rowspan': str(int(rows) + 1) if rows.isdigit() and rows != '0' else '', 'style': style})}>{self.inside(e)}</{tag}>"

    def _on_list(self, e: ET.Element) -> str:
        tag = "ol" if e.get("ordered") == "yes" or e.get("labeltype") in ("number", "arabic", "roman") else "ul"
        return f"<{tag}>{self.inside(e)}</{tag}>"

    def _picture(self, e: ET.Element) -> tuple[str, str]:
        inner = [x.get("fileref") for x in e if isinstance(x.tag, str) and x.tag.endswith("_Config")] + [x.get("fileref") for k in e for x in k if x.tag == "Icon"]
        ref = next((r for r in reversed(inner) if r), None) or e.get("fileref") or ""
        named = [x.get("name") for x in e if isinstance(x.tag, str) and x.tag.endswith("_Config") and x.get("name")]
        return ref, e.get("name") or next(reversed(named), None) or ref or "image"

    def _on_image(self, e: ET.Element) -> str:
        ref, alt = self._picture(e)
        return f"<img{self.attributes({'src': ref, 'alt': alt})}/>" if ref else "<!-- image without file -->"

    def _on_icon(self, e: ET.Element) -> str:
        ref, alt = self._picture(e)
        return f"<img{self.attributes({'src': ref, 'alt': alt})}/>" if ref else ""

    @staticmethod
    def _plain(e: ET.Element | None) -> str:
        return "" if e is None else html.escape(" ".join("".join(e.itertext()).split()), quote=False)

    def _on_physical(self, e: ET.Element) -> str:
        value, unit = self._plain(e.find(".//Value")), self._plain(e.find(".//Unit"))
        return f"{value}{NBSP}{unit}" if value and unit else value or self._plain(e)

    def _metric(self, e: ET.Element) -> ET.Element:
        return next((x for x in e if isinstance(x.tag, str) and ("Metric" in x.tag or x.tag in ("Physical_Data_M", "Range_M"))), e)

    def _on_physical_mi(self, e: ET.Element) -> str:
        m = self._metric(e)
        return self._on_range(m) if m.tag == "Range_M" else self._on_physical(m)

    def _on_range(self, e: ET.Element) -> str:
        first = lambda *names: next((x for x in map(e.find, (f".//{n}" for n in names)) if x is not None), None)
        low, high, unit = self._plain(first("Min_Value", "Min")), self._plain(first("Max_Value", "Max")), self._plain(first("Unit"))
        span = DASH.join(x for x in (low, high) if x) or self._plain(e)
        return f"{span}{NBSP}{unit}" if unit and (low or high) else span

    def _on_range_mi(self, e: ET.Element) -> str:
        return self._on_range(self._metric(e))

    def _on_range_m(self, e: ET.Element) -> str:
        return self._on_range(e)

    _on_list_tag, _on_physical_data, _on_physical_data_mi, _on_physical_data_value, _on_range_value = _on_list, _on_physical, _on_physical_mi, _on_physical, _on_range_m

    def _on_tolerance(self, e: ET.Element) -> str:
        return " ".join(filter(None, map(self._plain, e))) or self._plain(e)


CONVERTED = "struct<content_html:string,content_md:string,md_length:int,unknown_tags:map<string,int>,error:string>"


def convert(xml: Column, rules: dict[str, Rule] | None = None) -> Column:
    """HTML, Markdown, its length and the unknown elements of each text, from one parse; null and malformed text give an error and length 0."""

    @F.pandas_udf(CONVERTED)
    def run(s: pd.Series) -> pd.DataFrame:
        rows = []
        for t in s:
            try:
                c = Converter(rules)
                h = c.element(ET.fromstring(re.sub(r"<\?Pub.*?\?>", "", t, flags=re.DOTALL)))
                md = to_markdown(h)
                rows.append((h, md, len(md), dict(c.unknown), None))
            except Exception as x:
                rows.append((None, None, 0, {}, f"{type(x).__name__}: {x}"))
        return pd.DataFrame(rows, columns=["content_html", "content_md", "md_length", "unknown_tags", "error"])

    return run(xml)


_PIECE = re.compile(r"<!--.*?-->|<(/?)([A-Za-z][\w:.-]*)([^<>]*?)(/?)>", re.DOTALL)
_ATTR = re.compile(r"([\w:-]+)\s*=\s*\"([^\"]*)\"")


def to_markdown(text: str) -> str:
    """Markdown with ATX headings of the HTML that ``Converter`` writes."""
    out: list[str] = []
    lists: list[list] = []
    stack: list[str] = []
    at, cells, head_cells, quote_from = 0, 0, 0, []
    marks = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}
    for m in _PIECE.finditer(text):
        out.append(html.unescape(" ".join(text[at : m.start()].split("\n"))))
        at = m.end()
        if m.group(2) is None:
            continue
        closing, tag, attrs = bool(m.group(1)), m.group(2).lower(), dict(_ATTR.findall(m.group(3)))
        if re.fullmatch(r"h[1-6]", tag):
            out.append("\n\n" if closing else "\n\n" + "#" * int(tag[1]) + " ")
        elif tag in marks:
            out.append(marks[tag])
        elif tag in ("ul", "ol"):
            if closing and lists:
                lists.pop()
            elif not closing:
                lists.append([tag, 0])
            out.append("\n" if lists else "\n\n")
        elif tag == "li" and not closing:
            if lists:
                lists[-1][1] += 1
            out.append("\n" + "  " * max(0, len(lists) - 1) + (f"{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "- "))
        elif tag in ("td", "th"):
            cells, head_cells = cells + (not closing), head_cells + (not closing and tag == "th")
            out.append("" if closing else "| ")
            out.append(" " if closing else "")
        elif tag == "tr":
            out.append("|" if closing and cells else "\n" if not closing else "")
            if closing and head_cells:
                out.append("\n|" + "---|" * cells)
            if closing:
                cells = head_cells = 0
        elif tag == "blockquote":
            if closing and quote_from:
                i = quote_from.pop()
                body = "".join(out[i:]).strip()
                out[i:] = ["\n\n" + "\n".join(f"> {x}".rstrip() for x in body.split("\n")) + "\n\n"]
            elif not closing:
                quote_from.append(len(out))
        elif tag == "img":
            out.append(f"![{html.unescape(attrs.get('alt', ''))}]({attrs.get('src', '')})")
        elif tag == "a":
            if closing and stack:
                href = stack.pop()
                out.append(f"]({href})" if href else "")
            elif not closing:
                stack.append(attrs.get("href", ""))
                out.append("[" if attrs.get("href") else "")
        elif tag in ("p", "div", "section", "table", "caption", "hr", "br"):
            out.append("\n" if tag == "br" else "\n\n---\n\n" if tag == "hr" else "\n\n")
    out.append(html.unescape(text[at:]))
    flat = re.sub(r"[ \t]+\n", "\n", "".join(out))
    return re.sub(r"\n{3,}", "\n\n", flat).strip()
