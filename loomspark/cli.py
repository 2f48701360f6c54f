"""Command line: python -m loomspark.cli [--config F] [--domain D] [--step N ...] [--list-domains] [--no-dedup]

Step 1 extracts texts of PDF files (by the extractor named in --extractor, module:object), step 2 adds what is new in the texts
to the store of chunks and graph tables, step 3 writes questions with contexts from that store, or from a GraphML file or
another store named in --graph. --responder and --embedder name the models of steps 2 and 3; without, patterns and a stub serve. A step that fails doesn't stop the later ones; the exit code then is 1.
"""

from __future__ import annotations

import argparse
import importlib
import logging
import os
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.config import Settings, load_settings
from loomspark.functions import calls, html_tables, models
from loomspark.functions import text as T
from loomspark.operators import chunking, embedding, extraction, ingest, pages
from loomspark.operators.questions import stamped
from loomspark.plans.pipeline import call_settings, questions_of
from loomspark.sources import files, store
from loomspark.sources.tables import settled


def domains_of(root: str) -> list[str]:
    """Sorted child directories, those of the engine's own tables left out."""
    found = [p.name for p in Path(root).iterdir() if p.is_dir() and not p.name.startswith(("_", "."))] if Path(root).is_dir() else []
    return sorted(x.removeprefix("domain=") for x in found)


def resolve(explicit: str | None, root: str, domain: str | None) -> str:
    """An explicit path goes before a domain's directory, that before the stage's root."""
    if explicit or not domain:
        return explicit or root
    written = os.path.join(root, f"domain={domain}")  # by a first step over all domains
    return written if os.path.isdir(written) else os.path.join(root, domain)


def extract_texts(spark: SparkSession, source: str, out: str, extractor: str, recursive: bool = True, by_domain: bool = False) -> None:
    """Texts as files under ``out``, by domain where ``out`` isn't one's already, and all that was read as a table."""
    if os.path.isfile(source) and not source.lower().endswith(".pdf"):
        raise ValueError(f"{source} is no PDF file")
    if not extractor:
        raise ValueError("name an extractor: --extractor module:object")
    name, _, attribute = extractor.partition(":")
    found = files.with_domain(files.pdf_files(spark, source, recursive))

    def rows(batches):
        import pandas as pd

        pages_of = getattr(importlib.import_module(name), attribute).pages
        for batch in batches:
            out = []
            for domain, document, content in zip(batch.domain, batch.document_id, batch.content, strict=True):
                for k, p in enumerate(pages_of(content)):
                    tables = [html_tables.table_markdown(x) if "<" in x else x for x in models.table_htmls(p.get("tables"))]
                    out.append((domain, document, k, p.get("plain") or "", models.markdown_of(p.get("markdown")), tables, p.get("images") or []))
            yield pd.DataFrame(out, columns=["domain", "document_id", "page", "plain", "markdown", "tables", "images"])

    read = found.mapInPandas(rows, "domain string, document_id string, page int, plain string, markdown string, tables array<string>, images array<string>")
    docs = pages.concat_pages(read, ["domain", "document_id"], ["plain", "markdown"], ("tables", "images"))
    docs = settled(docs.withColumn("text", T.assemble_document(F.col("plain"), F.col("markdown"), F.col("tables"), F.col("images"))))
    files.write_texts(docs if by_domain else docs.drop("domain"), out)
    docs.write.mode("overwrite").parquet(os.path.join(out, "_markdown"))


def read_texts(spark: SparkSession, source: str, recursive: bool) -> DataFrame:
    docs = files.text_documents(spark, source, recursive).withColumnRenamed("document_id", "doc_id")
    if docs.isEmpty():
        raise FileNotFoundError(f"no texts under {source}")
    return docs.select("doc_id", "text")


def model_graph(settings: Settings, responder: models.Responder, answers_at: str) -> Callable[[DataFrame, store.Batch], None]:
    """What writes the graph tables of chunks from a model's records; answers are kept, so that a run after a failure asks for the
    rest only."""
    how, x = call_settings(settings.graph_calls), settings.extraction

    def ask(prompts: DataFrame) -> DataFrame:
        return calls.answered(prompts, responder, answers_at, calls=how, model=settings.graph_calls.model)

    def tables(chunks: DataFrame, batch: store.Batch) -> None:
        said = settled(ask(extraction.extraction_prompts(chunks.select("doc_id", "chunk_index", "chunk_id", "content"), x.entity_types)))
        lost = said.where("error IS NOT NULL")
        if n := lost.count():
            logging.warning("%d calls for records failed, such as: %s", n, lost.first().error)
        records = batch.write("records", extraction.parse_records(said.where("error IS NULL")))
        if n := records.where("reason IS NOT NULL").count():
            logging.warning("%d records can't be read", n)
        named = F.col("entity_id")
        nodes = extraction.shortened(settled(extraction.record_nodes(records)), ["doc_id", "entity_id"], named, ask, x.max_description_chars, x.descriptions_per_summary)
        pair = F.concat_ws(", ", "source", "target")
        edges = extraction.shortened(settled(extraction.record_edges(records)), ["doc_id", "source", "target"], pair, ask, x.max_description_chars, x.descriptions_per_summary)
        batch.write("nodes", nodes)
        batch.write("edges", edges)
        batch.write("failed_calls", lost.select("doc_id", "chunk_index", "chunk_id", "error"))

    return tables


def build_tables(spark: SparkSession, source: str, out: str, settings: Settings, recursive: bool = True, responder: str = "", embedder: str = "") -> int:
    """Adds new documents; with a responder graph tables are of its records, with an embedder vectors are brought up to date."""
    graph_of = model_graph(settings, models.load_object(responder), os.path.join(out, "_answers")) if responder else store.graph_tables
    added = store.add(read_texts(spark, source, recursive), out, lambda docs: chunking.chunks_of(docs, settings.chunking), graph_of=graph_of)
    if embedder:
        logging.info("%d texts embedded", embedding.sync(spark, out, models.load_object(embedder), settings.vectors.dim))
    return added


def read_graph(spark: SparkSession, at: str) -> tuple[DataFrame, DataFrame] | None:
    """Nodes and edges of a GraphML file or of a store; none where there is no graph."""
    if at.lower().endswith(".graphml"):
        return files.graphml(spark, at)
    nodes, edges = store.stored(spark, at, "nodes"), store.stored(spark, at, "edges")
    return None if nodes is None or edges is None else (nodes, edges)


def write_questions(spark: SparkSession, source: str, out: str, settings: Settings, dedup: bool, graph_at: str = "", recursive: bool = True, responder: str = "") -> None:
    """Questions as files; with a responder answers are kept under ``_answers``, and chunks whose call failed are in ``_failed``."""
    docs, lost = read_texts(spark, source, recursive), os.path.join(out, "_failed")

    def failed(rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(lost)
        if n := spark.read.parquet(lost).count():
            logging.warning("%d calls for questions failed: see %s", n, lost)

    graph_tables = read_graph(spark, graph_at) if graph_at else None
    asked = models.load_object(responder) if responder else None
    records = settled(questions_of(docs, settings, asked, dedup and settings.enable_deduplication, graph_tables, os.path.join(out, "_answers") if responder else "", failed))
    files.write_questions(stamped(records), out)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="loomspark", description=__doc__)
    p.add_argument("--config", "-c")
    p.add_argument("--domain", "-d")
    p.add_argument("--step", "-s", type=int, choices=(1, 2, 3), action="append")
    p.add_argument("--input", "-i")
    p.add_argument("--output", "-o")
    p.add_argument("--graph", "-g", help="GraphML file or store that contexts come from")
    p.add_argument("--recursive", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--no-dedup", action="store_true")
    p.add_argument("--extractor", default="")
    p.add_argument("--responder", default="", help="module:object that answers prompts in steps 2 and 3")
    p.add_argument("--embedder", default="", help="module:object that embeds texts in step 2")
    p.add_argument("--list-domains", action="store_true")
    p.add_argument("--log-level", default="INFO")
    a = p.parse_args(argv)
    logging.basicConfig(level=a.log_level.upper())
    s = load_settings(a.config)
    whole = lambda path: path if not path or "://" in path else os.path.abspath(path)
    base = whole(s.paths.working_dir)
    a.input, a.output, a.graph = whole(a.input), whole(a.output), whole(a.graph)
    root = lambda stage: os.path.join(base, stage)
    if a.list_domains:
        for stage in (s.paths.raw_dir, s.paths.processed_dir, s.paths.graph_dir, s.paths.output_dir):
            print(f"{stage}: {', '.join(domains_of(root(stage)))}")
        return 0
    spark = SparkSession.builder.appName("loomspark").getOrCreate()
    graph_at = resolve(None, root(s.paths.graph_dir), a.domain)
    asked = sorted(set(a.step or (1, 2, 3)))
    own, last = 1 not in asked, asked[-1]  # --input and --output are those of the first and of the last step
    steps = {
        1: lambda: extract_texts(spark, resolve(a.input, root(s.paths.raw_dir), a.domain), resolve(a.output if last == 1 else None, root(s.paths.processed_dir), a.domain), a.extractor, a.recursive, a.domain is None),
        2: lambda: build_tables(spark, resolve(a.input if own else None, root(s.paths.processed_dir), a.domain), resolve(a.output if last == 2 else None, root(s.paths.graph_dir), a.domain), s, a.recursive, a.responder, a.embedder),
        3: lambda: write_questions(spark, resolve(a.input if own else None, root(s.paths.processed_dir), a.domain), resolve(a.output, root(s.paths.output_dir), a.domain), s, not a.no_dedup, a.graph or graph_at, a.recursive, a.responder),
    }
    done = []
    for n in asked:
        try:
            steps[n]()
            done.append((n, True))
        except Exception:
            logging.exception("step %d failed", n)
            done.append((n, False))
    summary = ingest.run_summary(spark.createDataFrame(done, "step int, ok boolean")).first()
    logging.info("%d of %d steps succeeded; failed: %s", summary.succeeded, summary.total, summary.failed)
    return int(bool(summary.failed))


if __name__ == "__main__":
    sys.exit(main())
