"""Batch-first retrieval: many requests in, sources and context out, in one plan."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.functions.ids import base_id, canonical_form
from manualmill.functions.text import chunk_owner, estimated_tokens
from manualmill.operators import bm25, context, fusion, vector
from manualmill.providers import Embedder, HashEmbedder, embed, expanded, no_expansion
from manualmill.session import materialise, shared_dir

PARTS = ("texts", "vectors", "types", "series", "parents")
REQUEST = "query_id bigint, query string, series string, series_only boolean, tt_id int, tt_only boolean"


@dataclass
class Engine:
    """chunks: chunk_id, chunk_index, text, content_type. units: canonical_id, title, content_type, appearances. applicability: iu_miuid, tt_id. vectors: doc, v (made by the embedder if not given).

    ``warm`` writes what every batch needs (texts, vectors, parents, type and series lists,
    keyword index) once under a folder; ``opened`` starts from such a folder without reading
    the tables again. An engine that is not warm warms itself in the shared folder at its
    first batch.
    """

    chunks: DataFrame
    units: DataFrame
    applicability: DataFrame
    vectors: DataFrame | None = None
    embedder: Embedder = field(default_factory=HashEmbedder)
    expand: Callable[[str], str] = no_expansion
    depth: int = fusion.WIDE

    def __post_init__(self) -> None:
        self._parts: dict[str, DataFrame] | None = None
        self._index: bm25.Index | None = None

    def _plans(self) -> dict[str, DataFrame]:
        own = chunk_owner(F.col("chunk_id"))
        texts = self.chunks.filter("text IS NOT NULL").select(F.col("chunk_id").alias("doc"), own.alias("unit"), F.col("chunk_index").alias("idx"), estimated_tokens(F.col("text")).alias("tokens"), "text", F.col("content_type").alias("kind"))
        vectors = embed(self.chunks, "chunk_id", "text", self.embedder) if self.vectors is None else self.vectors
        types = self.applicability.select(canonical_form(F.col("iu_miuid")).alias("base"), "tt_id").filter("base IS NOT NULL AND tt_id IS NOT NULL").distinct()
        series = self.units.select(F.col("canonical_id").alias("unit"), F.explode("appearances.series").alias("series")).filter("series IS NOT NULL").distinct()
        parents = self.units.groupBy(F.col("canonical_id").alias("unit")).agg(F.min_by("title", F.coalesce("title", F.lit(""))).alias("title"), F.min("content_type").alias("kind"))
        return {"texts": texts, "vectors": vectors, "types": types, "series": series, "parents": parents}

    def warm(self, path: str | None = None) -> Engine:
        """Writes the parts under ``path``, by default in the shared folder, and uses them from then on."""
        spark = self.chunks.sparkSession
        path = path or f"{shared_dir(spark)}/engine-{uuid.uuid4().hex}"
        for name, df in self._plans().items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        self._parts = {name: spark.read.parquet(f"{path}/{name}") for name in PARTS}
        self._index = bm25.Index.build(self._parts["texts"].select("doc", "text"), f"{path}/index")
        return self

    @classmethod
    def opened(cls, spark: SparkSession, path: str, **how) -> Engine:
        """An engine over the parts that ``warm`` wrote; how: embedder, expand, depth."""
        parts = {name: spark.read.parquet(f"{path}/{name}") for name in PARTS}
        e = cls(parts["texts"], parts["parents"], parts["types"], parts["vectors"], **how)
        e._parts, e._index = parts, bm25.Index.open(spark, f"{path}/index")
        return e

    def part(self, name: str) -> DataFrame:
        if self._parts is None:
            self.warm()
        return self._parts[name]

    def health(self) -> dict[str, int | bool]:
        """Rows of each part, and whether all that a batch needs is there: every text has a vector of the embedder's length."""
        rows = {name: self.part(name).count() for name in PARTS}
        missing = self.part("texts").join(vector.usable(self.part("vectors"), "v", self.embedder.dim), "doc", "left_anti").count()
        return rows | {"without_vector": missing, "ok": rows["texts"] > 0 and missing == 0}

    @classmethod
    def of(cls, spark: SparkSession, requests: list[tuple]) -> DataFrame:
        return spark.createDataFrame(requests, REQUEST)

    def rank(self, requests: DataFrame, most: int = context.MOST_CHUNKS) -> DataFrame:
        """(query_id, pos, doc, score, in_series, in_type). Hard type and series filters narrow the keyword leg before its top k."""
        asked = expanded(requests, self.expand).select(F.concat_ws(":", F.col("query_id").cast("string"), F.col("variant").cast("string")).alias("query_id"), "text")
        whose = F.split_part("query_id", F.lit(":"), F.lit(1)).cast("bigint")
        series, types = self.part("series"), self.part("types")
        scored = self._index.scores(asked)
        own = chunk_owner(F.col("doc"))
        owned = {"unit": own, "base": base_id(own)}
        scored = scored.select(F.col("query_id").alias("variant"), whose.alias("query_id"), "doc", "score").withColumns(owned)
        scored = fusion.masked(scored, requests, series, types).withColumn("query_id", F.col("variant"))
        words = bm25.top(scored.select("query_id", "doc", "score"), self.depth)
        near = vector.nearest(embed(asked, "query_id", "text", self.embedder).withColumnRenamed("doc", "query_id"), self.part("vectors"), self.depth, self.embedder.dim)
        flat = lambda x: x.select(whose.alias("query_id"), "doc", "rank")
        fused = materialise(fusion.reciprocal_rank([flat(words), flat(near)]), "fused")
        return fusion.ranked(fusion.boosted(fused.withColumns(owned), requests, series, types), most)

    def query(self, requests: DataFrame) -> DataFrame:
        """(query_id, context, sources) of the requests that found something; sources in order with unit, title, type, applicability and score."""
        ranking = materialise(self.rank(requests), "ranking")
        return self.answer(ranking)

    def answer(self, ranking: DataFrame) -> DataFrame:
        """Context and sources of a ranking, also of a replayed one."""
        packed = materialise(context.pack(ranking.select("query_id", "doc", "pos"), self.part("texts")), "packed")
        parents = self.part("parents")
        text = context.blocks(packed, self.part("texts"), parents)
        flag = F.when(F.col("tt_known"), F.col("in_type")).otherwise(F.col("in_series")) if "tt_known" in ranking.columns else F.lit(None).cast("boolean")
        s = packed.select("query_id", "doc").join(ranking.withColumn("applies", flag), ["query_id", "doc"]).withColumn("unit", chunk_owner(F.col("doc"))).join(parents, "unit", "left")
        record = F.struct("pos", "doc", "unit", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("kind", F.lit("unknown")).alias("kind"), "applies", "score")
        return text.join(s.groupBy("query_id").agg(F.sort_array(F.collect_list(record)).alias("sources")), "query_id")
