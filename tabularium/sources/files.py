"""Files in and out. Paths go to Spark's own readers and writers, so any store that Spark knows will do."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.text import not_blank, strip

HINT = (
    "struct<id:string,kind:string,title:string,description:string,schemaGuess:map<string,string>,recordCountApprox:double,isContinuation:boolean,continuesPrevious:string>"
)


def _number(path) -> F.Column:
    return F.coalesce(F.regexp_extract(F.substring_index(path, "/", -1), r"(\d+)", 1).try_cast("int"), F.lit(0))


def _folder(path) -> F.Column:
    return F.element_at(F.split(path, "/"), -2)


def page_images(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, page, png)`` of ``<path>/<doc>/page-001.png`` and so on, in numeric page order wherever it is sorted."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").option("recursiveFileLookup", "true").load(path)
    return files.select(_folder(F.col("path")).alias("doc_id"), _number(F.col("path")).alias("page"), F.col("content").alias("png"))


def page_html(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, page, html)`` of ``<path>/<doc>/page-001.html`` and so on."""
    files = spark.read.option("pathGlobFilter", "*.html").option("recursiveFileLookup", "true").text(path, wholetext=True)
    at = F.col("_metadata.file_path")
    return files.select(_folder(at).alias("doc_id"), _number(at).alias("page"), F.col("value").alias("html"))


def page_hints(spark: SparkSession, path: str) -> DataFrame:
    """The hints of ``<path>/<doc>/*.json``, a row each; files that are no such JSON are passed over, a missing page number is read from the name."""
    files = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").text(path, wholetext=True)
    at = F.col("_metadata.file_path")
    rows = files.select(_folder(at).alias("doc_id"), _number(at).alias("named"), F.from_json("value", f"page int, structuredHints array<{HINT}>").alias("v"))
    rows = rows.where("v is not null").select("doc_id", F.coalesce("v.page", "named").alias("page"), F.posexplode("v.structuredHints").alias("place", "h"))
    return rows.select(
        "doc_id", "page", "place", "h.id", "h.kind", "h.title", "h.description", F.col("h.schemaGuess").alias("schema_guess"),
        F.col("h.recordCountApprox").alias("record_count"), F.col("h.isContinuation").alias("is_continuation"), F.col("h.continuesPrevious").alias("continues_previous"),
    )


def preferred_fields(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, name, description, aliases, type)`` of a JSON array of names or of objects with a name; anything else raises."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.posexplode(F.from_json("value", "array<string>")).alias("pos", "item"))
    obj = F.from_json("item", "name string, description string, aliases array<string>, type string")
    rows = rows.select("pos", "item", F.when(F.rlike("item", F.lit(r"^\s*\{")), obj).alias("o"))
    name = F.when(F.col("o").isNull(), F.col("item")).otherwise(F.col("o.name"))
    checked = F.when(name.isNull(), F.raise_error(F.concat(F.lit("a preferred field lacks a name, at "), F.col("pos").cast("string")))).otherwise(name)
    return rows.select("pos", checked.alias("name"), "o.description", "o.aliases", "o.type")


def field_list(value: F.Column) -> F.Column:
    """The names of a comma-separated list, stripped, without empty ones."""
    return F.filter(F.transform(F.split(value, ","), strip), lambda v: v != "")


def record_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, ord, rec)`` of JSON files that hold an array of records, or an object with one under ``records``; a file with neither gives no row."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    bare = F.from_json("value", "array<map<string,string>>")
    within = F.from_json("value", "records array<map<string,string>>")["records"]
    listed = F.when(F.rlike("value", F.lit(r"^\s*\[")), bare).otherwise(within)
    return files.select("file", F.posexplode(listed).alias("ord", "rec")).where("rec is not null")


def verified_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, ord, rec, verification)`` as the verification program writes them, a line each."""
    found = "struct<confidence:string,matched_name:string,matched_address:string,evidence:string>"
    return spark.read.schema(f"file string, ord int, rec map<string,string>, verification {found}").json(path)


def final_documents(spark: SparkSession, path: str, title: str | None = None, summary: str | None = None) -> DataFrame:
    """``(file, group_name, title, summary)`` of final-output files; given values win over those in the file."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    v = F.from_json("value", "groupName string, title string, recommendation struct<summary:string>")
    own = lambda given, found: F.coalesce(not_blank(F.lit(given).cast("string")), found)
    return files.select("file", v["groupName"].alias("group_name"), own(title, v["title"]).alias("title"), own(summary, v["recommendation"]["summary"]).alias("summary"))


def write_json(frame: DataFrame, path: str, mode: str = "errorifexists") -> None:
    frame.write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_ledger(ledger: DataFrame, path: str) -> None:
    """Add usage rows to a JSON-lines ledger."""
    ledger.write.mode("append").json(path)


def write_texts(frame: DataFrame, text_col: str, path: str, by: str = "doc_id") -> None:
    """One folder of text files per document."""
    frame.select(by, F.col(text_col).alias("value")).write.partitionBy(by).text(path)


def write_features(features: DataFrame, path: str) -> None:
    """Features as a GeoJSON text sequence, one a line, so that no task holds the collection."""
    features.select(F.col("feature").alias("value")).write.text(path)


def write_feature_collection(features: DataFrame, path: str, files: int | None = None) -> None:
    """Features as GeoJSON, each file a whole FeatureCollection: one for each partition, or ``files``; without features there is none. A task passes its features on as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = lambda texts: pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])
        yield line(['{"type":"FeatureCollection","features":['])
        comma = ""
        for batch in batches:
            for text in batch.column("feature").to_pylist():
                yield line([comma + text])
                comma = ","
        yield line(["]}"])

    rows = features.select("feature")
    (rows if files is None else rows.repartition(files)).mapInArrow(run, "value string").write.text(path)
