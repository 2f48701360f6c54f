"""Files as tables: listings, whole texts, graph and key-value stores, domains; and the question sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import named_files


def text_documents(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """document_id, path and text of the .txt files, whole; blank files are left out. The id is the file's stem, percent-decoded, or
    the name of its directory ``document_id=``."""
    rows = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.txt").option("recursiveFileLookup", recursive).load(path)
    file = F.col("_metadata.file_path")
    named = F.url_decode(F.regexp_extract(file, r"/document_id=([^/]*)/[^/]*$", 1))
    own = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # metadata say names as parts of a URI
    stem = F.regexp_replace(own, r"\.[^.]*$", "")
    for c in "/\x00._%":  # as ``write_texts`` says them
        stem = F.replace(stem, F.lit(f"%{ord(c):02X}"), F.lit(c))
    out = rows.select(F.when(named != "", named).otherwise(stem).alias("document_id"), file.alias("path"), F.col("value").alias("text"))
    return out.where(F.regexp_replace("text", r"(?U)^\s+|\s+\z", "") != "")


def pdf_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """path, document_id, length and content of the .pdf files of a directory (lower-case extension), or of one file, whose
    extension may be in any case."""
    if path.lower().endswith(".pdf"):
        rows = spark.read.format("binaryFile").load(path)
    else:
        rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", recursive).load(path)
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return rows.select("path", stem.alias("document_id"), "length", "content")


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """path and length of the files directly under ``path``."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def with_domain(files: DataFrame, path_col: str = "path") -> DataFrame:
    """The name of the directory that holds each file as its domain."""
    return files.withColumn("domain", F.element_at(F.split(path_col, "/"), -2))


_KEYS = "map<string,string>"


def graphml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a GraphML file, their data elements as columns named by the file's keys."""
    data = T.ArrayType(T.StructType([T.StructField("_key", T.StringType()), T.StructField("_VALUE", T.StringType())]))
    read = lambda tag, *own: spark.read.format("xml").option("rowTag", tag).schema(T.StructType([*(T.StructField(f"_{c}", T.StringType()) for c in own), T.StructField("data", data)])).load(path)
    keys = spark.read.format("xml").option("rowTag", "key").schema("_id string, _for string, `_attr.name` string").load(path)
    names = {(k._for, k._id): k["_attr.name"] for k in keys.collect()}  # the header: a few rows whatever the graph's size

    def wide(rows: DataFrame, kind: str, own: dict[str, str]) -> DataFrame:
        entries = F.map_from_entries(F.transform("data", lambda x: F.struct(x["_key"], x["_VALUE"])))
        typed = rows.withColumn("m", F.coalesce(entries, F.create_map().cast(_KEYS)))
        columns = [F.element_at("m", i).alias(name) for (k, i), name in sorted(names.items(), key=lambda x: x[0][1]) if k == kind]
        return typed.select(*[F.col(f"_{c}").alias(a) for c, a in own.items()], *columns)

    return wide(read("node", "id"), "node", {"id": "node_id"}), wide(read("edge", "source", "target"), "edge", {"source": "source", "target": "target"})


def key_value_store(spark: SparkSession, path: str, value: str) -> DataFrame:
    """key and the fields of ``value`` (a struct type) of a JSON file that is one map."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "v"))
    return rows.select("key", "v.*")


#: The value types of the key-value stores.
STORES = {
    "doc_status": "struct<status:string,chunks_count:int,chunks_list:array<string>,content_summary:string,content_length:int,created_at:string,updated_at:string,file_path:string,track_id:string,metadata:struct<processing_start_time:bigint,processing_end_time:bigint>>",
    "full_entities": "struct<entity_names:array<string>,count:int,create_time:bigint,update_time:bigint>",
    "full_relations": "struct<relation_pairs:array<array<string>>,count:int,create_time:bigint,update_time:bigint>",
    "relation_chunks": "struct<chunk_ids:array<string>,count:int,create_time:bigint,update_time:bigint>",
    "text_chunks": "struct<content:string>",
}


def _folder(rows: DataFrame, *names: str) -> list:
    """The folders of a file, those of ``names`` that ``rows`` has: domains by name, parts (sub-folders) as they are."""
    return [F.concat(named_files.file_name(F.col(c)) if c != "part" else F.col(c), F.lit("/")) for c in names if c in rows.columns]


def write_questions(records: DataFrame, path: str) -> None:
    """JSON lines, a file ``{document}_questions.jsonl`` for each source document, below its domain where it has one; empty members
    are left out. A file that is there is replaced as a whole; those of other documents stay."""
    own = [c for c in records.columns if c != "domain"]
    file = F.concat(*_folder(records, "domain"), named_files.file_name(F.col("source_document")), F.lit("_questions.jsonl"))
    line = F.concat(F.to_json(F.struct(*own)), F.lit("\n"))
    named_files.write_files(records, path, file, line, [F.col(c) for c in ("question_index", "source_chunk_id", "content") if c in own])


def write_texts(documents: DataFrame, path: str) -> None:
    """Texts as files ``{document_id}.txt``, below their domain and sub-directory where they have them."""
    file = F.concat(*_folder(documents, "domain", "part"), named_files.file_name(F.col("document_id")), F.lit(".txt"))
    named_files.write_files(documents, path, file, F.coalesce("text", F.lit("")))


def write_images(images: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Embedded images (document_id, name, content, text) as a table of binaries with what was read from them."""
    images.write.mode(mode).parquet(path)
