"""Queries by name: each takes (spark, directory of tables) and returns a DataFrame. ``oracles`` has the SQL for the same rows.

The tables hold no questions, so responses come from the deterministic stub responder. Chunks are 1,000 characters with an
overlap of 100 here, so that documents have several.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.config import Chunking, Settings
from loomspark.functions import html_tables, models
from loomspark.functions import text as T
from loomspark.operators import chunking, context, dedup, embedding, extraction, graph, ingest, pages, prompts, questions, vectors
from loomspark.sources import store
from loomspark.sources.tables import read_table, settled, shared_dir
from loomspark.streaming import ingest as stream

from .oracles import SQL  # noqa: F401
from .pipeline import questions_of

SIZE, OVERLAP = 1000, 100


def _table(spark: SparkSession, at: str, name: str) -> DataFrame:
    return read_table(spark, at, name)


def _docs(spark: SparkSession, at: str) -> DataFrame:
    return _table(spark, at, "documents").select("doc_id", "text")


def _lines(spark: SparkSession, at: str) -> DataFrame:
    """Lines of documents as candidate questions, dealt by document: what follows works within documents."""
    rows = _docs(spark, at).repartition("doc_id").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "x"))
    return rows.select("doc_id", (F.col("p") + 1).alias("rn"), F.trim("x").alias("content")).where(F.length("content") >= T.LEAST_QUESTION)


def _chunks(spark: SparkSession, at: str) -> DataFrame:
    return chunking.char_chunks(_docs(spark, at), SIZE, OVERLAP)


def _responses(spark: SparkSession, at: str, kind: str = "numbered") -> DataFrame:
    text = F.col("text")
    said = {"numbered": models.stub_response(text), "listed": models.stub_response(text, False)}
    said["mixed"] = F.when(F.col("doc_id") % 2 == 0, said["numbered"]).otherwise(said["listed"])
    return _docs(spark, at).select("doc_id", said[kind].alias("response"))


def _mentions(spark: SparkSession, at: str) -> DataFrame:
    """Read from a table, as queries use them more than once."""
    return graph.mentions(settled(graph.extracted(_chunks(spark, at))))


def _relations(spark: SparkSession, at: str) -> DataFrame:
    return graph.extracted_relations(_chunks(spark, at))


def _md5(column: str) -> Column:
    return F.md5(F.col(column).cast("binary"))


def q_dedup_greedy(spark: SparkSession, at: str) -> DataFrame:
    return dedup.greedy_dedup(_lines(spark, at), "doc_id", "content")


def q_dedup_exact(spark: SparkSession, at: str) -> DataFrame:
    rows = _lines(spark, at).withColumn("normal", T.dedup_normalise(F.col("content")))
    return rows.groupBy("doc_id", "normal").agg(F.min("rn").alias("rn")).select("doc_id", "rn", _md5("normal").alias("hash"))


def q_jaccard_pairs(spark: SparkSession, at: str) -> DataFrame:
    rows = _lines(spark, at).select("doc_id", "rn", T.dedup_normalise(F.col("content")).alias("t"))
    return dedup.similar_pairs(rows, "doc_id", 0.85).select("doc_id", "earlier", "rn")


def q_dedup_stats(spark: SparkSession, at: str) -> DataFrame:
    total = _lines(spark, at).agg(F.count("*").alias("questions"))
    kept = q_dedup_greedy(spark, at).agg(F.count("*").alias("kept"))
    both = total.select("questions", F.lit(None).cast("long").alias("kept")).unionByName(kept.select(F.lit(None).cast("long").alias("questions"), "kept"))
    return both.agg(F.max("questions").alias("questions"), F.max("kept").alias("kept")).withColumn("removed", F.col("questions") - F.col("kept"))


def q_markdown_to_plain(spark: SparkSession, at: str) -> DataFrame:
    return _table(spark, at, "pages").select("page_id", T.markdown_to_plain(F.col("html")).alias("plain")).select("page_id", F.length("plain").alias("n_chars"), _md5("plain").alias("plain_md5"))


def q_markdown_to_plain_docs(spark: SparkSession, at: str) -> DataFrame:
    return _docs(spark, at).select("doc_id", T.markdown_to_plain(F.col("text")).alias("plain")).select("doc_id", F.length("plain").alias("n_chars"), _md5("plain").alias("plain_md5"))


def q_assemble_sections(spark: SparkSession, at: str) -> DataFrame:
    whole = T.assemble_document(F.lit(""), F.col("html"), F.array(F.concat(F.lit("| "), F.col("url"), F.lit(" |"))), F.array(T.image_text(F.col("url"), F.lit(" a \n\n b "))))
    return _table(spark, at, "pages").select("page_id", whole.alias("whole")).select("page_id", F.length("whole").alias("n_chars"), _md5("whole").alias("text_md5"))


def q_clean_think(spark: SparkSession, at: str) -> DataFrame:
    return _responses(spark, at).select("doc_id", T.clean_think(F.col("response")).alias("r")).select("doc_id", F.length("r").alias("n_chars"), _md5("r").alias("response_md5"))


def q_strip_answer(spark: SparkSession, at: str) -> DataFrame:
    lines = _responses(spark, at).select("doc_id", F.posexplode(F.split("response", "\n")).alias("line", "x"))
    return lines.select("doc_id", "line", T.strip_answer(F.col("x")).alias("content"))


def q_char_chunks(spark: SparkSession, at: str) -> DataFrame:
    return _chunks(spark, at).select("doc_id", "chunk_index", "total_chunks", "start_position", "end_position", _md5("content").alias("content_md5"))


def q_token_chunks(spark: SparkSession, at: str) -> DataFrame:
    rows = chunking.token_chunks(_docs(spark, at), models.WhitespaceTokenizer(), 200, 20)
    return rows.select("doc_id", "chunk_index", "total_chunks", "start_position", "end_position", _md5("content").alias("content_md5"))


def q_chunk_ids(spark: SparkSession, at: str) -> DataFrame:
    return _chunks(spark, at).select("doc_id", "chunk_index", "chunk_id")


def q_shared_chunks(spark: SparkSession, at: str) -> DataFrame:
    return _chunks(spark, at).groupBy("chunk_id").agg(F.countDistinct("doc_id").alias("n_docs")).where("n_docs > 1")


def q_valid_questions(spark: SparkSession, at: str) -> DataFrame:
    rows = _responses(spark, at).select("doc_id", F.posexplode(questions.numbered_questions(T.clean_think(F.col("response")))).alias("ord", "x"))
    return rows.select("doc_id", "ord", T.is_valid_question(F.col("x.content")).alias("accepted"))


def q_reject_reasons(spark: SparkSession, at: str) -> DataFrame:
    rows = _responses(spark, at).select(F.explode(questions.numbered_questions(T.clean_think(F.col("response")))).alias("x")).select("x.content")
    return rows.agg(F.count("*").alias("questions"), *[F.count_if(~rule).alias(f"not_{name}") for name, rule in T.question_rules(F.col("content")).items()])


def q_parse_questions(spark: SparkSession, at: str) -> DataFrame:
    return questions.parse_responses(_responses(spark, at), ["doc_id"])


def q_fallback_parse(spark: SparkSession, at: str) -> DataFrame:
    return questions.parse_responses(_responses(spark, at, "listed"), ["doc_id"])


def q_parse_with_fallback(spark: SparkSession, at: str) -> DataFrame:
    return questions.parse_responses(_responses(spark, at, "mixed"), ["doc_id"])


def q_extract_entities(spark: SparkSession, at: str) -> DataFrame:
    return _docs(spark, at).select("doc_id", T.extract_entities(F.col("text")).alias("e")).select("doc_id", F.size("e").alias("n_entities"), F.array_join("e", "|").alias("entities"))


def q_entity_nodes(spark: SparkSession, at: str) -> DataFrame:
    return graph.nodes(_mentions(spark, at))


def q_relation_edges(spark: SparkSession, at: str) -> DataFrame:
    return graph.edges(_relations(spark, at))


def q_unknown_endpoints(spark: SparkSession, at: str) -> DataFrame:
    """Nodes are only the entities that open a chunk, so most endpoints have none."""
    nodes = graph.nodes(_mentions(spark, at).where("pos = 0"))
    edges = graph.canonical(_relations(spark, at)).withColumn("description", F.concat_ws(" beside ", "a", "b"))
    return graph.unknown_endpoints(nodes, edges)


def q_node_merge(spark: SparkSession, at: str) -> DataFrame:
    """Descriptions of an entity over all documents: the languages it is named in."""
    docs = _table(spark, at, "documents").select("doc_id", "lang")
    return graph.merged(_mentions(spark, at).join(docs, "doc_id").select("name", F.concat(F.lit("term in "), "lang").alias("description")), ["name"], ["description"])


def q_full_entities(spark: SparkSession, at: str) -> DataFrame:
    return graph.document_entities(_mentions(spark, at)).select("doc_id", F.col("count").alias("n"), F.array_join("entity_names", "|").alias("entity_names"))


def q_full_relations(spark: SparkSession, at: str) -> DataFrame:
    joined = F.array_join(F.transform("relation_pairs", lambda x: F.array_join(x, ">")), "|")
    return graph.document_relations(_relations(spark, at)).select("doc_id", F.col("count").alias("n"), joined.alias("relation_pairs"))


def q_relation_chunks(spark: SparkSession, at: str) -> DataFrame:
    return graph.relation_chunks(_relations(spark, at)).select("doc_id", "pair", F.col("count").alias("n"), F.array_join("chunk_ids", "|").alias("chunk_ids"))


def q_context_entities(spark: SparkSession, at: str) -> DataFrame:
    return context.context_entities(_mentions(spark, at)).drop("chunk_id")


def q_context_relations(spark: SparkSession, at: str) -> DataFrame:
    return context.context_relations(_relations(spark, at))


def q_related_chunks(spark: SparkSession, at: str) -> DataFrame:
    found = _mentions(spark, at)
    return context.related_chunks(context.context_entities(found), found)


def q_snippets(spark: SparkSession, at: str) -> DataFrame:
    chunks, found = _chunks(spark, at), _mentions(spark, at)
    return context.snippets(context.related_chunks(context.context_entities(found), found), chunks)


def q_prompt_context(spark: SparkSession, at: str) -> DataFrame:
    rows = context.chunk_contexts(_chunks(spark, at))
    return rows.select("doc_id", "chunk_index", _md5("prompt_context").alias("context_md5"), F.array_join("related_entities", "|").alias("entities"), F.array_join("related_chunk_ids", "|").alias("chunk_ids"))


def q_token_budget(spark: SparkSession, at: str) -> DataFrame:
    """Lines of documents as three sections, cut at their budgets of words: 40, 30 and what is left of 100."""
    rows = _lines(spark, at).select("doc_id", "rn", (F.col("rn") % 3).cast("int").alias("kind"), context.words(F.col("content")).alias("tokens"))
    return context.budgeted(rows, ["doc_id"], ["rn"], {0: 40, 1: 30}, 100).select("doc_id", "rn", "kind", "tokens")


def q_render_prompt(spark: SparkSession, at: str) -> DataFrame:
    rows = prompts.chunk_prompts(_chunks(spark, at).withColumn("prompt_context", F.concat(F.lit("at "), F.col("chunk_index").cast("string"))), "Ask {questions_per_chunk} about {document_id}: {text} [{prompt_context}]", "You ask questions.", 10)
    return rows.select("doc_id", "chunk_index", F.length("prompt").alias("n_chars"), _md5("prompt").alias("prompt_md5"))


def q_history_flatten(spark: SparkSession, at: str) -> DataFrame:
    return prompts.flatten_history(_table(spark, at, "conversations"), "go on").select("conv_id", F.length("prompt").alias("n_chars"), _md5("prompt").alias("prompt_md5"))


def q_parse_source_ids(spark: SparkSession, at: str) -> DataFrame:
    raw = F.concat_ws("; ", F.concat_ws(" ,", "lang", "source"), F.concat(F.lit("| "), F.col("doc_id").cast("string"), F.lit(" ;")))
    return _table(spark, at, "documents").select("doc_id", T.parse_source_ids(raw).alias("x")).select("doc_id", F.size("x").alias("n"), F.array_join("x", "/").alias("ids"))


def q_questions_jsonl(spark: SparkSession, at: str) -> DataFrame:
    parsed = questions.parse_responses(_responses(spark, at), ["doc_id"])
    rows = parsed.select(F.col("doc_id").cast("string").alias("document_id"), F.concat(F.lit("chunk-"), F.col("doc_id").cast("string")).alias("source_chunk_id"), "question_index", "content", F.array(F.lit("Base")).alias("base_entities"), F.array().cast("array<string>").alias("base_chunk_ids"))
    meta = F.col("metadata")
    return questions.question_records(rows).select("content", "source_document", "source_chunk_id", "question_index", meta["has_answer"].alias("has_answer"), meta["lightrag_chunk_id"].alias("chunk"), F.array_join(meta["related_entities"], "|").alias("entities"), F.array_join(meta["related_chunk_ids"], "|").alias("chunk_ids"), meta["knowledge_context_used"].alias("context_used"))


def q_doc_status(spark: SparkSession, at: str) -> DataFrame:
    docs = _docs(spark, at)
    return ingest.doc_status(docs, chunking.char_chunks(docs, SIZE, OVERLAP)).withColumn("chunks_list", F.array_join("chunks_list", "|"))


def q_incremental_ingest(spark: SparkSession, at: str) -> DataFrame:
    return ingest.not_yet_ingested(_docs(spark, at), _table(spark, at, "labels")).select("doc_id", F.length("text").alias("n_chars"))


def q_list_domains(spark: SparkSession, at: str) -> DataFrame:
    docs = _table(spark, at, "documents")
    return ingest.stage_domains({"raw": docs.select(F.col("lang").alias("domain")), "processed": docs.select(F.col("source").alias("domain"))}).select("stage", F.array_join("domains", "|").alias("domains"))


def _fitted(spark: SparkSession, at: str, dim: int) -> DataFrame:
    rows = _table(spark, at, "embeddings").select("vec_id", vectors.fit_dimension(F.col("embedding"), dim).alias("v"))
    return rows.select("vec_id", F.size("v").alias("dim"), F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 6).alias("total"), F.element_at("v", -1).alias("last"))


def q_embedding_pad(spark: SparkSession, at: str) -> DataFrame:
    return _fitted(spark, at, 80)


def q_embedding_truncate(spark: SparkSession, at: str) -> DataFrame:
    return _fitted(spark, at, 24)


def q_cosine_topk(spark: SparkSession, at: str) -> DataFrame:
    rows = _table(spark, at, "embeddings")
    return vectors.cosine_top_k(rows.where("vec_id % 20 = 0"), rows, 20, 0.2).withColumn("score", F.round("score", 6))


def q_fallback_embedding(spark: SparkSession, at: str) -> DataFrame:
    rows = _docs(spark, at).select("doc_id", models.fallback_embeddings(F.col("text"), 16).alias("v"))
    return rows.select("doc_id", F.array_join(F.transform("v", lambda x: F.round(x, 6).cast("string")), ",").alias("embedding"))


def q_html_tables(spark: SparkSession, at: str) -> DataFrame:
    """Pages have no tables, so one is added to the whole html of each."""
    cell = lambda c: F.concat(F.lit("<td> "), F.col(c).cast("string"), F.lit("\n</td>"))
    table = F.concat(F.lit("<TABLE border=1><tr><th>key</th><th>address</th></tr><tr>"), cell("page_id"), cell("url"), F.lit("</tr><tr><td>last</td></tr></table>y"))
    rows = _table(spark, at, "pages").select("page_id", html_tables.render_tables(F.concat("html", table)).alias("text"))
    return rows.select("page_id", F.length("text").alias("n_chars"), _md5("text").alias("text_md5"))


def _tabled(html: Column, key: Column, url: Column) -> Column:
    """Whole html with a table behind it, in one of five forms: ends of rows and cells left out; cells that span rows, and columns;
    a table in a cell; and a bar in a cell, beside a table that isn't ended."""
    cat, k = F.concat, F.pmod(key, F.lit(5))
    said = key.cast("string")
    spanned = cat(F.lit("<table><tr><th>k</th><th>v</th></tr><tr><td rowspan='2'>"), said, F.lit("</td><td>x</td></tr><tr><td>"), url, F.lit("</td></tr></table>"))
    wide = cat(F.lit("<TABLE><TR><TH colspan=2>"), said, F.lit("</TH></TR><TR><TD>l</TD><TD>"), url, F.lit("</TD></TR></TABLE>"))
    nested = cat(F.lit("<table><tr><td>"), said, F.lit("</td><td>in <table><tr><td>one</td><td>two</td></tr></table> out</td></tr></table>"))
    barred = cat(F.lit("<table><tr><td>p|q</td></tr><tr><td>"), said, F.lit("</td></tr></table><table><tr><td>open"))
    short = cat(F.lit("<table class=x><tr><th>key<th>address<tr><td>"), said, F.lit("<td>"), url, F.lit("</table>"))
    return cat(html, F.when(k == 0, short).when(k == 1, spanned).when(k == 2, wide).when(k == 3, nested).otherwise(barred), F.lit(" end"))


def q_table_grid(spark: SparkSession, at: str) -> DataFrame:
    rows = _table(spark, at, "pages").select("page_id", html_tables.render_tables(_tabled(F.col("html"), F.col("page_id"), F.col("url"))).alias("text"))
    return rows.select("page_id", F.length("text").alias("n_chars"), _md5("text").alias("text_md5"))


def q_markdown_tables(spark: SparkSession, at: str) -> DataFrame:
    """Cleaning of markdown that holds tables: they are laid out before tags go."""
    rows = _table(spark, at, "pages").select("page_id", T.markdown_to_plain(_tabled(F.col("html"), F.col("page_id"), F.col("url"))).alias("plain"))
    return rows.select("page_id", F.length("plain").alias("n_chars"), _md5("plain").alias("plain_md5"))


def q_store_view(spark: SparkSession, at: str) -> DataFrame:
    """Documents that were added to a store in two runs, between which a run with others failed before its commit."""
    docs, where = _docs(spark, at), f"{shared_dir(spark)}/loomspark-stores/{uuid.uuid4().hex}"
    chunker = lambda some: chunking.char_chunks(some, SIZE, OVERLAP)
    store.add(docs.where("doc_id % 2 = 0"), where, chunker, with_graph=False)
    lost = store.Batch(spark, where)
    lost.write("doc_status", ingest.doc_status(docs, lost.write("chunks", chunker(docs.where("doc_id % 2 = 1")))))
    store.add(docs, where, chunker, with_graph=False)
    counts = store.stored(spark, where, "chunks").groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.sum(F.length("content")).alias("chunk_chars"))
    zero = F.lit(0).cast("long")
    return store.stored(spark, where, "doc_status").join(counts, "doc_id", "left").select("doc_id", "status", F.coalesce("n_chunks", zero).alias("n_chunks"), F.coalesce("chunk_chars", zero).alias("chunk_chars"))


def _records(spark: SparkSession, at: str) -> DataFrame:
    """Records of the stub's answers about the entities of each chunk."""
    named = graph.extracted(_chunks(spark, at))
    return settled(extraction.parse_records(named.select("doc_id", "chunk_index", "chunk_id", extraction.stub_records(F.col("e")).alias("response"))))


def q_record_nodes(spark: SparkSession, at: str) -> DataFrame:
    rows = extraction.record_nodes(_records(spark, at))
    return rows.select("doc_id", "entity_id", "entity_type", "description", _md5("source_id").alias("sources_md5"), "first_chunk", "first_pos")


def q_record_edges(spark: SparkSession, at: str) -> DataFrame:
    rows = extraction.record_edges(_records(spark, at))
    return rows.select("doc_id", "source", "target", "weight", _md5("description").alias("description_md5"), "keywords", _md5("source_id").alias("sources_md5"), "first_chunk")


def q_bad_records(spark: SparkSession, at: str) -> DataFrame:
    return _records(spark, at).where("reason IS NOT NULL").groupBy("doc_id", "reason").agg(F.count("*").alias("n"))


class _Hashed:
    """The offline embedder."""

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [models.fallback_embedding(x, 8) for x in texts]


def q_vector_store(spark: SparkSession, at: str) -> DataFrame:
    """Vectors of a store that documents came to in two runs: how many chunks and texts have one, and how many texts each of three
    runs embedded; the third has nothing left to do."""
    docs, where = _docs(spark, at), f"{shared_dir(spark)}/loomspark-stores/{uuid.uuid4().hex}"
    chunker = lambda some: chunking.char_chunks(some, SIZE, OVERLAP)
    made = []
    for some in (docs.where("doc_id % 2 = 0"), docs, docs):
        store.add(some, where, chunker, with_graph=False)
        made.append(embedding.sync(spark, where, _Hashed(), 8))
    rows = embedding.vectors(spark, where, "chunk")
    counts = rows.agg(F.count("*").alias("n_chunks"), F.sum(F.size("embedding")).alias("n_values"))
    return counts.select("n_chunks", "n_values", *(F.lit(n).cast("long").alias(f"embedded_{k + 1}") for k, n in enumerate(made)))


def q_concat_pages(spark: SparkSession, at: str) -> DataFrame:
    text = F.when(F.col("page_id") % 4 == 0, "").otherwise(F.col("html"))
    rows = _table(spark, at, "pages").select((F.col("page_id") % 10).alias("document"), F.col("page_id").alias("page"), text.alias("text"))
    return pages.concat_pages(rows, ["document"], ["text"]).select("document", F.col("n_pages").alias("pages"), _md5("text").alias("text_md5"))


def q_layout_tables(spark: SparkSession, at: str) -> DataFrame:
    """Blocks that say their html in different members, with an empty one in each list."""
    k, none = F.col("page_id") % 4, F.lit(None).cast("string")
    block = lambda a, b, c: F.struct(a.alias("res_html"), b.alias("html"), c.alias("cell_html"))
    cell = F.concat(F.lit("c"), "url")
    first = F.when(k == 0, block(F.col("html"), cell, cell)).when(k == 1, block(F.lit(""), F.col("url"), cell)).when(k == 2, block(none, F.lit(""), cell)).otherwise(block(none, none, none))
    blocks = F.array(first, block(none, F.lit(""), F.lit("")), block(none, F.col("url"), none))
    rows = _table(spark, at, "pages").select("page_id", T.layout_tables(blocks).alias("x"))
    return rows.select("page_id", F.size("x").alias("n"), F.array_join("x", "|").alias("tables"))


def q_markdown_string(spark: SparkSession, at: str) -> DataFrame:
    k, text = F.col("page_id") % 5, F.when(F.col("page_id") % 5 == 0, F.col("html"))
    entry = lambda key, head: F.create_map(F.lit(key), F.concat(F.lit(head), "url"))
    members = F.when(k == 1, F.map_concat(entry("md", "m"), entry("text", "no"))).when(k == 2, entry("text", "t")).when(k == 3, F.create_map(F.lit("other"), F.lit("x")))
    return _table(spark, at, "pages").select("page_id", T.markdown_string(text, members).alias("m")).select("page_id", _md5("m").alias("markdown_md5"))


def q_node_names(spark: SparkSession, at: str) -> DataFrame:
    k, own = F.col("doc_id") % 3, F.col("doc_id")
    said = lambda when, head, by: F.when(when, F.concat(F.lit(head), (own % by).cast("string")))
    rows = _table(spark, at, "documents").where("doc_id % 11 <> 2").select(F.col("lang").alias("chunk_id"), F.when(k == 0, F.col("source")).otherwise("").alias("entity_id"), said(k == 1, "n", 5).alias("entity_name"), said(k >= 1, "i", 7).alias("id"))
    return graph.named_nodes(rows).select("chunk_id", "name")


def q_source_members(spark: SparkSession, at: str) -> DataFrame:
    joined = F.concat_ws(T.SOURCE_SEPARATOR, "lang", "source", F.when(F.col("lang") != F.col("source"), F.concat(F.lit("x"), (F.col("doc_id") % 3).cast("string"))))
    return graph.with_sources(_table(spark, at, "documents").select("doc_id", joined.alias("source_id"))).select("doc_id", "chunk_id", "source_pos")


def q_store_stats(spark: SparkSession, at: str) -> DataFrame:
    k = F.col("doc_id") % 3
    name = F.concat(F.lit("/store/f"), F.col("doc_id").cast("string"), F.when(k == 0, ".json").when(k == 1, ".graphml").otherwise(".txt"))
    rows = ingest.store_stats(_table(spark, at, "documents").select(name.alias("path"), F.col("n_chars").alias("length")))
    return rows.select("file_count", F.md5(F.array_join("files", "|").cast("binary")).alias("files_md5"), F.round("size_mb", 6).alias("size_mb"))


def q_run_summary(spark: SparkSession, at: str) -> DataFrame:
    steps = _table(spark, at, "nation").select(F.col("n_name").alias("step"), (F.col("n_regionkey") < 3).alias("ok"))
    return ingest.run_summary(steps).withColumn("failed", F.array_join("failed", "|"))


def q_upsert(spark: SparkSession, at: str) -> DataFrame:
    labels = _table(spark, at, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
    new = _docs(spark, at).where("doc_id % 7 = 0").select("doc_id", F.lit(9).alias("quality"), F.lit(9).alias("toxic"))
    return ingest.upsert(labels, new, ["doc_id"])


def q_event_counts(spark: SparkSession, at: str) -> DataFrame:
    return stream.event_counts(_table(spark, at, "events").select("ts", "event_type")).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


def q_embedding_float(spark: SparkSession, at: str) -> DataFrame:
    total = F.aggregate(F.col("embedding").cast("array<float>").cast("array<double>"), F.lit(0.0), lambda s, x: s + x)
    return _table(spark, at, "embeddings").select("vec_id", F.round(total, 6).alias("total"))


def q_chunk_lookup(spark: SparkSession, at: str) -> DataFrame:
    """Texts of chunks by their ids, as a store of texts gives them."""
    chunks = _chunks(spark, at)
    texts = chunks.groupBy("chunk_id").agg(F.min("content").alias("content"))
    return chunks.where("chunk_index = 0").select("doc_id", "chunk_id").join(texts, "chunk_id").select("doc_id", "chunk_id", _md5("content").alias("content_md5"))


def q_graph_context(spark: SparkSession, at: str) -> DataFrame:
    """Contexts from the stored form of the graph, whole: its entities are those that are derived from the chunks, its relations have
    the direction in which a document has them first."""
    chunks = _chunks(spark, at)
    short = settled(graph.extracted(chunks))
    nodes, edges = graph.node_table(graph.mentions(short)), graph.edge_table(graph.extracted_relations(short))
    rows = context.graph_contexts(chunks, settled(nodes), settled(edges))
    part = F.regexp_extract("prompt_context", r"(?s)^(【相关实体信息】.*?)(?:\n\n【|$)", 1)
    names = F.filter(F.split(F.regexp_replace(part, "(?m)^- 实体 (.*?)（类型：.*$", "$1"), "\n"), lambda x: ~x.startswith("【") & (x != ""))
    return rows.select("doc_id", "chunk_index", F.array_join(names, "|").alias("entities"), F.md5(part.cast("binary")).alias("entities_md5"), _md5("prompt_context").alias("context_md5"), F.array_join("related_chunk_ids", "|").alias("chunk_ids"))


def q_pipeline_e2e(spark: SparkSession, at: str) -> DataFrame:
    """Documents to questions: chunks, context, prompts, stub responses, parsing, records, removal of near duplicates."""
    settings = Settings(chunking=Chunking(use_token_chunking=False, max_chunk_size=SIZE, overlap_size=OVERLAP))
    return questions_of(_docs(spark, at), settings).select("source_document", "source_chunk_id", "question_index", "content")


QUERIES = {name: query for name, query in list(globals().items()) if name.startswith("q_")}
