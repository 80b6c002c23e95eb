"""Chunking, XML, dump, token and stream queries; round trips have the table itself as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.functions.text import estimated_tokens, root_tag
from manualmill.operators.canonical import first_per_key
from manualmill.operators.chunking import chunks
from manualmill.operators.convert import convert
from manualmill.operators.extract import extract, unit_references
from manualmill.plans.corpus_queries import UNITS
from manualmill.operators.evaluate import request_packing
from manualmill.providers import token_counts
from manualmill.session import table
from manualmill.sources.perfsql import project, read_dump
from manualmill.streaming.ingest import file_stream, new_items, run_available, tumbling_counts


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _units(spark: SparkSession, d: str) -> DataFrame:
    return first_per_key(table(spark, d, "canonical_ius_enriched"), "canonical_id", "loaded_at")


def _escape(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _each(array: str, one) -> Column:
    return F.coalesce(F.array_join(F.transform(array, one), ""), F.lit(""))


def _xml(units: DataFrame, *more: Column) -> DataFrame:
    """Unit documents written from the enriched fields."""
    body = F.concat(
        F.lit("<Service_IU><Title>"), _escape(F.col("title")), F.lit("</Title>"),
        _each("fault_codes", lambda f: F.concat(F.lit('<Para>Code <Fault_Code_Reference code="'), _escape(f["code"]), F.lit('" ecid="'), _escape(f["ecid"]), F.lit('">'), _escape(f["description"]), F.lit("</Fault_Code_Reference></Para>"))),
        _each("part_numbers", lambda p: F.concat(F.lit("<Instruction>Fit <Part_Reference>"), _escape(p), F.lit("</Part_Reference></Instruction>"))),
        _each("iu_cross_references", lambda r: F.concat(F.lit('<IU_Reference icecode="'), _escape(r["icecode"]), F.lit('" ifsid="'), _escape(r["ifsid"]), F.lit('">'), _escape(r["text"]), F.lit("</IU_Reference>"))),
        _each("configuration", lambda c: F.concat(F.lit('<Configuration configdata="'), _escape(c), F.lit('"/>'))),
        *more, F.lit("</Service_IU>"),
    )
    return units.select("canonical_id", body.alias("xml"))


def xml_round_trip(spark, d):
    """Fields written as XML and extracted again."""
    m = _xml(_units(spark, d)).select("canonical_id", root_tag(F.col("xml")).alias("root"), extract(F.col("xml")).alias("m"))
    return m.select("canonical_id", "root", F.size("m.fault_codes").alias("faults"), F.array_join(F.array_sort("m.part_numbers"), ",").alias("parts"), F.size("m.iu_cross_references").alias("refs"), F.size("m.configuration").alias("configurations"), "m.error")


def xml_lists_round_trip(spark, d):
    """Tools, consumables, warranty codes and failure chains written as XML and extracted again: first of each key, in order."""
    tag = lambda name, inner, **a: F.concat(F.lit(f"<{name}"), *(x for k, v in a.items() for x in (F.lit(f' {k}="'), _escape(v), F.lit('"'))), F.lit(">"), inner, F.lit(f"</{name}>"))
    fault = lambda f: tag("Fault_Code_Reference", _escape(f["description"]), code=f["code"], ecid=f["ecid"])
    failures = lambda c: F.coalesce(F.array_join(F.transform(c["possible_failures"], lambda p: tag("Possible_Failure_Mode", _escape(p))), ""), F.lit(""))
    body = F.concat(
        F.lit("<Service_IU>"), _each("tool_references", lambda t: tag("Tool_Reference", _escape(t["part_number"]), STName=t["name"])), _each("consumable_references", lambda c: tag("Consumable_Reference", _escape(c["description"]), csid=c["csid"])),
        _each("warranty_codes", lambda w: tag("Warranty_Code", F.lit(""), code=w["code"], time=w["time"])), _each("fcr_chains", lambda c: tag("Fault_Code_Resolution", F.concat(fault(c["fault_code"]), tag("CCM", _escape(c["ccm"])), failures(c)))), F.lit("</Service_IU>"),
    )
    m = _units(spark, d).select("canonical_id", extract(body).alias("m"))
    text = lambda c: F.coalesce(c, F.lit(""))
    pairs = lambda c, a, b: F.array_join(F.transform(c, lambda x: F.concat(text(x[a]), F.lit("="), text(x[b]))), ";")
    chain = lambda c: F.concat_ws("|", text(c["fault_code"]["code"]), text(c["fault_code"]["ecid"]), text(c["fault_code"]["description"]), text(c["ccm"]), F.array_join(F.coalesce(c["possible_failures"], F.array().cast("array<string>")), ","))
    return m.select("canonical_id", pairs("m.tool_references", "part_number", "name").alias("tools"), pairs("m.consumable_references", "csid", "description").alias("consumables"), pairs("m.warranty_codes", "code", "time").alias("warranties"), F.array_join(F.transform("m.fcr_chains", chain), ";").alias("chains"))


def xml_conversion(spark, d):
    """Also over lists, notes, wrappers and stripped elements of the rules table."""
    tools = _each("tool_references", lambda t: F.concat(F.lit("<ListItem><Text_Config>"), _escape(t["name"]), F.lit("</Text_Config><Image_Annotation>a</Image_Annotation></ListItem>")))
    size = F.concat(F.lit("<Safety_Message><Legal_Note><Variable_NumMI><Physical_Data_M><Value>"), F.coalesce("md_length", F.lit(0)).cast("string"), F.lit("</Value><Unit>mm</Unit></Physical_Data_M><Physical_Data_I>in</Physical_Data_I></Variable_NumMI></Legal_Note></Safety_Message>"))
    c = _xml(_units(spark, d), F.lit("<Non_Ordered_List>"), tools, F.lit("</Non_Ordered_List>"), size).select("canonical_id", convert(F.col("xml")).alias("c"))
    return c.select("canonical_id", "c.content_md", "c.md_length", F.size("c.unknown_tags").alias("unknown"), "c.error")


def wrapper_references(spark, d):
    """Wrapper documents written as XML and read again: ordered ids, repeats kept."""
    first = first_per_key(table(spark, d, "document_structure"), "document_id", "loaded_at", "series", "doc_name")
    x = first.select("document_id", F.concat(F.lit('<Doc Name="'), _escape(F.col("doc_name")), F.lit('">'), _each("iu_ids", lambda i: F.concat(F.lit('<Master_IU_Ref miuid="'), _escape(i), F.lit('"/>'))), F.lit("</Doc>")).alias("xml"))
    r = x.select("document_id", unit_references(F.col("xml")).alias("r"))
    return r.select("document_id", "r.doc_name", F.array_join("r.iu_ids", ",").alias("iu_ids"))


def chunk_units(spark, d):
    return chunks(_units(spark, d), "canonical_id", "content_md", ["content_type"])


def chunk_counts(spark, d):
    """Chunks per unit that fits whole: exactly one; units over the limit: more."""
    c = chunks(_units(spark, d), "canonical_id", "content_md").groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    size = _units(spark, d).select(F.col("canonical_id").alias("unit"), (estimated_tokens(F.col("content_md")) > 2000).alias("large"))
    return c.join(size, "unit").groupBy("large").agg(F.count(F.lit(1)).alias("units"), F.min("n").alias("fewest"))


def perfsql_round_trip(spark, d):
    """The type table written as dump files and read again."""
    quote = lambda c: F.when(F.col(c).isNull(), "NULL").otherwise(F.concat(F.lit("'"), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'")))
    cols = ["tt_code", "brand_name", "model_name", "sn_min"]
    line = F.concat(F.lit("("), F.col("tt_id").cast("string"), *(F.concat(F.lit(", "), quote(c)) for c in cols), F.lit("),"))
    files = table(spark, d, "technical_types").groupBy("brand_name").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))  # 300 types
    head = f"-- dump\n\nINSERT INTO Types (TT_ID, {', '.join(c.upper() for c in cols)}) VALUES\n"
    files = files.select(F.col("brand_name").alias("file"), F.encode(F.concat(F.lit(head), F.col("lines"), F.lit("\n(1, 'short row'),\n")), "UTF-16BE").alias("content"))
    out = project(read_dump(files), ["tt_id", *cols])
    return out.select(F.col("tt_id").cast("int").alias("tt_id"), *cols)


def unknown_tags(spark, d):
    """Elements without a rule over all converted units."""
    c = _xml(_units(spark, d)).select(convert(F.replace(F.col("xml"), F.lit("Part_Reference"), F.lit("Strange_Part"))).alias("c"))
    return c.select(F.explode("c.unknown_tags").alias("tag", "n")).groupBy("tag").agg(F.sum("n").alias("times"), F.count(F.lit(1)).alias("units"))


def exact_tokens(spark, d):
    """Tokens by a public vocabulary beside the estimate, per content type."""
    u = _units(spark, d).filter("content_md IS NOT NULL")
    n = token_counts(u, "canonical_id", "content_md", VOCABULARY)
    x = u.select(F.col("canonical_id").alias("doc"), "content_type", estimated_tokens(F.col("content_md")).alias("estimate")).join(n, "doc")
    return x.groupBy("content_type").agg(F.count(F.lit(1)).alias("units"), F.sum("estimate").alias("estimated"), F.sum("tokens").alias("tokens"))


def embedding_plan(spark, d):
    """What embedding all chunks would take: requests, their sizes, cost at 0.02 a million tokens, bytes of vectors."""
    c = first_per_key(table(spark, d, "chunks"), "chunk_id", "loaded_at").filter("text IS NOT NULL").select("chunk_id", estimated_tokens(F.col("text")).alias("tokens"))
    packed = request_packing(c, "chunk_id", "tokens", F.pmod(F.xxhash64("chunk_id"), F.lit(64)))
    r = packed.groupBy("shard", "request").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("inputs"))
    one = r.agg(F.count(F.lit(1)).alias("requests"), F.sum("inputs").alias("inputs"), F.sum("tokens").alias("tokens"), F.min("tokens").alias("smallest"), F.max("tokens").alias("largest"))
    return one.select("requests", "inputs", "tokens", "smallest", "largest", F.round(F.col("tokens") * 0.02 / 1e6, 6).alias("cost"), (F.col("inputs") * 64 * 4).alias("vector_bytes"))


def stream_windows(spark, d):
    """Extension: hourly windows over the event stream."""
    e = file_stream(spark, f"{d}/events.parquet")
    out = run_available(tumbling_counts(e, "ts", "event_type", "value"), "complete", "windows")
    return out.select(F.unix_seconds("start").alias("start"), "event_type", "events", F.round("total", 2).alias("total"))


def stream_new_documents(spark, d):
    """Extension: documents as they arrive, each once."""
    s = file_stream(spark, f"{d}/chunks.parquet").select("chunk_id", "loaded_at", F.length("text").alias("chars"))
    return run_available(new_items(s, "chunk_id", "loaded_at"), "append", "documents").select("chunk_id", "chars")


_DISTINCT = "len(list_distinct(list_filter(coalesce({0}, []), lambda x: {1})))"
QUERIES = {f.__name__: f for f in (xml_round_trip, xml_lists_round_trip, xml_conversion, wrapper_references, chunk_units, chunk_counts, perfsql_round_trip, unknown_tags, exact_tokens, embedding_plan, stream_windows, stream_new_documents)}
_T = "trim(coalesce({}, ''))"
_FIRSTS = "coalesce(array_to_string(list_transform(list_filter({list}, lambda x, i: {ok} AND list_position(list_transform({list}, lambda y: {keys}), {key}) = i), lambda x: {out}), ';'), '')"


def _firsts(column: str, ok: str, key: str, out: str) -> str:
    """The first member of each key, in order, as text."""
    return _FIRSTS.format(list=f"coalesce({column}, [])", ok=ok, key=key, keys=key.replace("x.", "y."), out=out)


SQL = {
    "xml_lists_round_trip": f"""SELECT canonical_id, {_firsts("tool_references", _T.format("x.part_number") + " <> ''", _T.format("x.part_number"), _T.format("x.part_number") + " || '=' || coalesce(x.name, '')")} AS tools,
      {_firsts("consumable_references", "coalesce(x.csid, '') <> ''", "coalesce(x.csid, '')", "x.csid || '=' || " + _T.format("x.description"))} AS consumables,
      {_firsts("warranty_codes", "true", "coalesce(x.code, '') || chr(1) || coalesce(x.time, '')", "coalesce(x.code, '') || '=' || coalesce(x.time, '')")} AS warranties,
      coalesce(array_to_string(list_transform(coalesce(fcr_chains, []), lambda x: coalesce(x.fault_code.code, '') || '|' || coalesce(x.fault_code.ecid, '') || '|' || trim(coalesce(x.fault_code.description, '')) || '|' || trim(coalesce(x.ccm, '')) || '|' || coalesce(array_to_string(list_filter(list_transform(coalesce(x.possible_failures, []), lambda p: trim(coalesce(p, ''))), lambda p: p <> ''), ','), '')), ';'), '') AS chains FROM {UNITS}""",
    "xml_round_trip": f"""SELECT canonical_id, 'Service_IU' AS root, CAST(len(list_distinct(list_transform(coalesce(fault_codes, []), lambda f: coalesce(f.code, '') || chr(1) || coalesce(f.ecid, '')))) AS INTEGER) AS faults,
      coalesce(array_to_string(list_sort(list_distinct(list_filter(list_transform(coalesce(part_numbers, []), lambda p: trim(p)), lambda p: p <> ''))), ','), '') AS parts,
      CAST(len(list_distinct(list_transform(coalesce(iu_cross_references, []), lambda r: coalesce(r.icecode, '') || chr(1) || coalesce(r.ifsid, '')))) AS INTEGER) AS refs,
      CAST(len(list_distinct(list_filter(coalesce(configuration, []), lambda c: c <> ''))) AS INTEGER) AS configurations, CAST(NULL AS VARCHAR) AS error FROM {UNITS}""",
    "unknown_tags": f"WITH p AS (SELECT canonical_id, unnest(part_numbers) AS x FROM {UNITS}) SELECT 'Strange_Part' AS tag, count(*) AS times, count(DISTINCT canonical_id) AS units FROM p WHERE x IS NOT NULL HAVING count(*) > 0",
    "wrapper_references": "SELECT document_id, coalesce(doc_name, '') AS doc_name, coalesce(array_to_string(list_filter(iu_ids, lambda i: i <> ''), ','), '') AS iu_ids FROM document_structure QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY loaded_at, series, doc_name) = 1",
    "chunk_counts": f"SELECT length(content_md) // 4 > 2000 AS large, count(*) AS units, CAST(CASE WHEN length(content_md) // 4 > 2000 THEN 2 ELSE 1 END AS BIGINT) AS fewest FROM {UNITS} WHERE length(content_md) // 4 >= 10 AND trim(content_md) <> '' GROUP BY ALL",
    "perfsql_round_trip": "SELECT tt_id, tt_code, brand_name, model_name, sn_min FROM technical_types",
    "stream_windows": "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start, event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "stream_new_documents": "SELECT chunk_id, any_value(CAST(length(text) AS INTEGER)) AS chars FROM chunks GROUP BY chunk_id",
}
