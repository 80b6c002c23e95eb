"""Relational dumps: one INSERT header, then one parenthesised tuple per line, in UTF-16BE.

``lex_row`` is a small scanner over one line; ``read_dump`` applies it to whole files as a
table function in Arrow batches. Values have no declared type: unquoted ones keep the kind
their spelling shows, so ``'1'`` and ``1`` can be told apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_HEADER = re.compile(r"^\s*insert\b[^(]*\(([^)]*)\)", re.IGNORECASE)
_ESCAPES = {"n": "\n", "r": "\r", "t": "\t"}
# one value: a quoted string with backslash escapes, or a bare word up to the next comma
_VALUE = re.compile(r"\s*(?:'((?:[^'\\]|\\.)*)'|([^,']*?))\s*(,|$)", re.DOTALL)
_INT, _FLOAT = re.compile(r"^[+-]?\d+$"), re.compile(r"^[+-]?(?:\d+\.\d*|\.?\d+)(?:[eE][+-]?\d+)?$")
ROW = "file string, line long, names array<string>, kinds array<string>, vals array<string>"


def decode(data: bytes) -> str:
    text = data.decode("utf-16-be", errors="replace")
    return text[1:] if text[:1] == "﻿" else text


def lex_row(line: str) -> list[tuple[str, str | None]] | None:
    """(kind, text) per value, kind of string, null, int, float or word; None if the line is no whole tuple."""
    line = line.strip().rstrip(",;").rstrip()
    if not (line.startswith("(") and line.endswith(")")):
        return None
    body, at, out = line[1:-1], 0, []
    while True:
        m = _VALUE.match(body, at)
        if m is None:
            return None
        if m.group(1) is not None:
            out.append(("string", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e.group(1), e.group(1)), m.group(1), flags=re.DOTALL)))
        else:
            word = m.group(2).strip()
            kind = "null" if word.lower() == "null" else "int" if _INT.match(word) else "float" if _FLOAT.match(word) else "word"
            out.append((kind, None if kind == "null" else word))
        at = m.end()
        if m.group(3) == "":
            return out


def rows_of(text: str) -> Iterator[tuple[int, list[str], list[tuple[str, str | None]]]]:
    """(line number, column names, values) of the tuples after the header; rows of another length are left out."""
    names: list[str] | None = None
    for number, line in enumerate(text.splitlines()):
        if names is None:
            if m := _HEADER.match(line):
                names = [c.strip().strip("`\"[]").upper() for c in m.group(1).split(",")]
            continue
        if line.lstrip().startswith("("):
            values = lex_row(line)
            if values is not None and len(values) == len(names):
                yield number, names, values


def read_dump(files: DataFrame) -> DataFrame:
    """Typed rows of files (file, content): file, line, names, kinds, vals. Files without header give no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["file"], b["content"]):
                block = []
                for number, names, values in rows_of(decode(content)):
                    block.append((file, number, names, [k for k, _ in values], [v for _, v in values]))
                    if len(block) == 5000:
                        yield pd.DataFrame(block, columns=["file", "line", "names", "kinds", "vals"])
                        block = []
                yield pd.DataFrame(block, columns=["file", "line", "names", "kinds", "vals"])

    return files.filter("content IS NOT NULL").select("file", "content").mapInPandas(run, ROW)


def project(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Named columns of dump rows, whatever the case of their names; columns that a file lacks are null."""
    at = lambda c: F.expr(f"try_element_at(vals, cast(nullif(array_position(names, '{c.upper()}'), 0) AS INT))")
    return rows.select("file", "line", *(at(c).alias(c) for c in columns))


class _Part(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PerfsqlSource(DataSource):
    """``spark.read.format("perfsql").option("columns", "A,B").load(path)``: one partition per file, every value as text."""

    @classmethod
    def name(cls) -> str:
        return "perfsql"

    def _columns(self) -> list[str]:
        return [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in self._columns())

    def reader(self, schema):
        return _Reader(self.options["path"], self._columns())


class _Reader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def partitions(self):
        import glob
        import os

        return [_Part(p) for p in (sorted(glob.glob(os.path.join(self.path, "**/*.perfsql"), recursive=True)) if os.path.isdir(self.path) else sorted(glob.glob(self.path)))]

    def read(self, partition):
        with open(partition.path, "rb") as f:
            text = decode(f.read())
        for _, names, values in rows_of(text):
            where = {n: i for i, n in enumerate(names)}
            yield tuple(values[where[c.upper()]][1] if c.upper() in where else None for c in self.columns)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PerfsqlSource)
