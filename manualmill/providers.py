"""What the flow asks of models and outside services, with deterministic offline stand-ins."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Embedder(Protocol):
    dim: int

    def __call__(self, texts: list[str]) -> np.ndarray: ...


@dataclass(frozen=True)
class HashEmbedder:
    """Feature hashing of lower-case tokens with signs, to unit length; the same text always gives the same vector."""

    dim: int = 64

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = xxhash.xxh64_intdigest(w)
                out[i, h % self.dim] += 1.0 if h >> 63 else -1.0
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n == 0, 1, n)


def embed(df: DataFrame, item: str, text: str, embedder: Embedder = HashEmbedder()) -> DataFrame:
    """(doc, v) of the rows with a text, in Arrow batches."""
    item_type = dict(df.dtypes)[item]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc": b["doc"], "v": list(embedder(list(b["text"])))})

    return df.filter(F.col(text).isNotNull()).select(F.col(item).alias("doc"), F.col(text).alias("text")).mapInPandas(run, f"doc {item_type}, v array<float>")


@dataclass(frozen=True)
class Retrying:
    """A call that is made again after a failure, after waits that double; the last failure is raised."""

    call: Callable
    attempts: int = 5
    first_wait: float = 1.0
    most_wait: float = 60.0
    wait: Callable[[float], None] = time.sleep

    def __call__(self, *args):
        for n in range(1, self.attempts + 1):
            try:
                return self.call(*args)
            except Exception:
                if n == self.attempts:
                    raise
                self.wait(min(self.most_wait, self.first_wait * 2 ** (n - 1)))


def token_matches(given: Column, secret: str) -> Column:
    """Whether the token of a request is the service's own, compared by digest; null or blank tokens never are, and without a secret all are."""
    if not secret:
        return F.lit(True)
    own = hashlib.sha256(secret.encode()).hexdigest()
    return F.coalesce((F.trim(given) != "") & (F.sha2(given, 256) == F.lit(own)), F.lit(False))


def expansions(raw: Column, most: int = 3) -> Column:
    """The first non-blank lines of a model's answer."""
    return F.slice(F.filter(F.transform(F.split(raw, "\n"), lambda x: F.trim(x)), lambda x: x != ""), 1, most)


def no_expansion(query: str) -> str:
    return ""


def expanded(requests: DataFrame, model: Callable[[str], str] = no_expansion) -> DataFrame:
    """(query_id, variant, text): the query itself as variant 0, then what the model adds."""

    @F.pandas_udf("string")
    def ask(s: pd.Series) -> pd.Series:
        return s.map(lambda q: None if q is None else model(q))

    lines = F.concat(F.array(F.col("query")), F.coalesce(expansions(ask(F.col("query"))), F.array()))
    return requests.select("query_id", F.posexplode(lines).alias("variant", "text")).filter("text IS NOT NULL")


def identify(requests: DataFrame, service: Callable[[str], int | None], at_once: int = 8) -> DataFrame:
    """(identifier, tt_id, failure) of the distinct identifiers of requests, asked of a service that gives a type or nothing; each is asked once, ``at_once`` of them together in a task.

    A failed call leaves its message and does not end the batch; wrap the service in ``Retrying`` for more attempts.
    """

    def ask(name: str) -> tuple:
        try:
            return name, service(name), None
        except Exception as x:
            return name, None, f"{type(x).__name__}: {x}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(at_once) as pool:
            for b in batches:
                out = pd.DataFrame(list(pool.map(ask, b["identifier"])), columns=["identifier", "tt_id", "failure"])
                yield out.astype({"tt_id": "Int32"})

    return requests.select("identifier").filter("trim(identifier) <> ''").distinct().mapInPandas(run, "identifier string, tt_id int, failure string")


def resolved(requests: DataFrame, identifiers: DataFrame, types: DataFrame) -> DataFrame:
    """Requests with tt_id, tt_name, series_icecode and an error where an identifier is unknown; without identifier nothing is looked up."""
    known = identifiers.join(types.select("tt_id", "tt_name", "series_icecode"), "tt_id", "left")
    x = requests.join(known, "identifier", "left")
    return x.withColumn("error", F.when(F.col("identifier").isNotNull() & F.col("tt_id").isNull(), F.concat(F.lit("unknown identifier "), "identifier")))


def prompt(question: Column, machine: Column, context: Column) -> Column:
    """The text a generator is given."""
    return F.concat_ws("\n\n", F.concat(F.lit("Question: "), question), F.when(machine.isNotNull(), F.concat(F.lit("Machine: "), machine)), F.concat(F.lit("Sources:\n"), F.coalesce(context, F.lit("(none)"))))


# fixed value: the public splitting pattern of the byte-pair vocabularies in rank files
TOKEN_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODINGS: dict = {}


def token_counts(df: DataFrame, item: str, text: str, vocabulary: str) -> DataFrame:
    """(doc, tokens) by a byte-pair vocabulary in a rank file; null texts have none. The encoder is loaded once a worker."""
    item_type = dict(df.dtypes)[item]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64

        import tiktoken

        if vocabulary not in _ENCODINGS:
            with open(vocabulary, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _ENCODINGS[vocabulary] = tiktoken.Encoding("ranks", pat_str=TOKEN_PATTERN, mergeable_ranks=ranks, special_tokens={})
        enc = _ENCODINGS[vocabulary]
        for b in batches:
            yield pd.DataFrame({"doc": b["doc"], "tokens": [0 if t is None else len(enc.encode_ordinary(t)) for t in b["text"]]})

    return df.select(F.col(item).alias("doc"), F.col(text).alias("text")).mapInPandas(run, f"doc {item_type}, tokens int")
