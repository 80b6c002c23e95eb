"""Metadata of unit documents: one parse per document, one struct out.

Parsing happens in an Arrow UDF, since malformed XML must become an error of its row and
not of the job.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FAULT = "struct<code:string,ecid:string,description:string>"
METADATA = (
    f"struct<root:string,fault_codes:array<{FAULT}>,part_numbers:array<string>,tool_references:array<struct<part_number:string,name:string>>,"
    "consumable_references:array<struct<csid:string,description:string>>,warranty_codes:array<struct<code:string,time:string>>,"
    "iu_cross_references:array<struct<icecode:string,ifsid:string,text:string>>,configuration:array<string>,"
    f"fcr_chains:array<struct<fault_code:{FAULT},ccm:string,possible_failures:array<string>,tests:array<struct<number:string,testid:string,instruction:string,results:array<struct<result:string,action:string>>>>,schematics:array<string>>>,"
    "error:string>"
)


def inner_text(e: ET.Element | None) -> str:
    return "" if e is None else "".join(e.itertext()).strip()


def _distinct(items: Iterable[dict], key: Callable[[dict], object]) -> list[dict]:
    """The first of each key, in order."""
    out: dict = {}
    for x in items:
        out.setdefault(key(x), x)
    return list(out.values())


def _fault(e: ET.Element) -> dict:
    return {"code": e.get("code", ""), "ecid": e.get("ecid", ""), "description": inner_text(e)}


def _chain(e: ET.Element) -> dict:
    """One fault resolution; members that are not found stay null."""
    fault, ccm = e.find(".//Fault_Code_Reference"), e.find(".//CCM")
    tests = []
    for t in e.iter("Test"):
        said = [inner_text(x) for x in t if x.tag in ("Instruction", "Instruction_Text")]
        results = [{"result": inner_text(r.find("Result")), "action": inner_text(r.find("Action"))} for r in t.iter("Result_Action")]
        tests.append({"number": t.get("number"), "testid": t.get("testid"), "instruction": " ".join(filter(None, said)) or None, "results": results or None})
    failures = [x for x in map(inner_text, e.iter("Possible_Failure_Mode")) if x]
    links = [x for x in (s.get("id") or inner_text(s) for s in e.iter("Schematic_Link")) if x]
    return {"fault_code": _fault(fault) if fault is not None else None, "ccm": inner_text(ccm) or None, "possible_failures": failures or None, "tests": tests or None, "schematics": links or None}


def metadata(root: ET.Element) -> dict:
    """All fields of a unit; lists keep the first of each key in document order, links before references."""
    each = root.iter
    refs = [e for tag in ("IU_IFS_Link", "IU_Reference") for e in each(tag)]
    return {
        "root": root.tag,
        "fault_codes": _distinct(map(_fault, each("Fault_Code_Reference")), lambda x: (x["code"], x["ecid"])),
        "part_numbers": list(dict.fromkeys(t for t in map(inner_text, each("Part_Reference")) if t)),
        "tool_references": _distinct(({"part_number": inner_text(e), "name": e.get("STName", "")} for e in each("Tool_Reference") if inner_text(e)), lambda x: x["part_number"]),
        "consumable_references": _distinct(({"csid": e.get("csid"), "description": inner_text(e)} for e in each("Consumable_Reference") if e.get("csid")), lambda x: x["csid"]),
        "warranty_codes": _distinct(({"code": e.get("code", ""), "time": e.get("time", "")} for e in each("Warranty_Code")), lambda x: (x["code"], x["time"])),
        "iu_cross_references": _distinct(({"icecode": e.get("icecode", ""), "ifsid": e.get("ifsid", ""), "text": inner_text(e)} for e in refs), lambda x: (x["icecode"], x["ifsid"])),
        "configuration": list(dict.fromkeys(c for e in each("Configuration") if (c := e.get("configdata")))),
        "fcr_chains": [_chain(e) for e in each("Fault_Code_Resolution")],
        "error": None,
    }


_EMPTY = dict.fromkeys("root fault_codes part_numbers tool_references consumable_references warranty_codes iu_cross_references configuration fcr_chains error".split())


def extract(xml: Column) -> Column:
    """The metadata struct; null for null, and only ``error`` filled for text that is no XML."""

    @F.pandas_udf(METADATA)
    def run(s: pd.Series) -> pd.DataFrame:
        def one(t):
            if t is None:
                return _EMPTY
            try:
                return metadata(ET.fromstring(t))
            except ET.ParseError as x:
                return {**_EMPTY, "error": f"ParseError: {x}"}

        return pd.DataFrame(list(map(one, s)), columns=list(_EMPTY))

    return run(xml)


def unit_references(xml: Column) -> Column:
    """Ordered ids that a wrapper document refers to, repeats kept, and its name; error for malformed text."""

    @F.pandas_udf("struct<doc_name:string,iu_ids:array<string>,error:string>")
    def run(s: pd.Series) -> pd.DataFrame:
        rows = []
        for t in s:
            try:
                root = ET.fromstring(t)
                rows.append((root.get("Name", ""), [i for e in root.iter("Master_IU_Ref") if (i := e.get("miuid"))], None))
            except (ET.ParseError, TypeError) as x:
                rows.append((None, None, f"{type(x).__name__}: {x}"))
        return pd.DataFrame(rows, columns=["doc_name", "iu_ids", "error"])

    return run(xml)
