"""Members of zip archives as rows, through a pluggable codec.

Archives are listed by ``binaryFile`` and opened inside the tasks; a member that cannot be
read gives a row with its error instead of failing the scan. Archives of any number spread
over the cluster; one archive is one task's work.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBER = "archive string, series string, path string, content binary, error string"


def unpad(data: bytes, block: int = 8) -> bytes:
    """Without PKCS#5 padding, if that is valid; otherwise unchanged."""
    n = data[-1] if data else 0
    return data[:-n] if 1 <= n <= block and len(data) >= n and data.endswith(bytes([n]) * n) else data


def identity(data: bytes) -> bytes:
    return data


def zlib_codec(data: bytes) -> bytes:
    return zlib.decompress(unpad(data))


def read_members(archives: DataFrame, prefix: str = "", suffix: str = "", codec: Callable[[bytes], bytes] = identity) -> DataFrame:
    """(archive, series, path, content, error) of (path, content): members by name, decoded; series is the archive's folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["archive", "series", "path", "content", "error"]
        for b in batches:
            for name, data in zip(b["path"], b["content"]):
                series = name.rstrip("/").split("/")[-2] if "/" in name else None
                try:
                    z = zipfile.ZipFile(io.BytesIO(data))
                except Exception as x:
                    yield pd.DataFrame([(name, series, None, None, f"{type(x).__name__}: {x}")], columns=columns)
                    continue
                for info in z.infolist():
                    if info.is_dir() or not info.filename.startswith(prefix) or not info.filename.endswith(suffix):
                        continue
                    try:
                        row = (name, series, info.filename, codec(z.read(info)), None)
                    except Exception as x:
                        row = (name, series, info.filename, None, f"{type(x).__name__}: {x}")
                    yield pd.DataFrame([row], columns=columns)

    return archives.select("path", "content").mapInPandas(run, MEMBER)


def scan(spark: SparkSession, pattern: str, prefix: str = "", suffix: str = ".xml", codec: Callable[[bytes], bytes] = identity) -> DataFrame:
    return read_members(spark.read.format("binaryFile").load(pattern), prefix, suffix, codec)


def as_text(content: Column) -> Column:
    """UTF-8 with replacement of what is invalid."""

    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else bytes(b).decode("utf-8", errors="replace"))

    return decode(content)


def non_blank_lines(spark: SparkSession, path: str) -> DataFrame:
    """One query per non-blank line of a text file."""
    return spark.read.text(path).filter(F.trim("value") != "").select(F.trim("value").alias("query"))
