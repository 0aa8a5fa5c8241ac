"""Sources: listings, spans, tables, finished documents, overrides."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixed values: document types and their folders
DOC_TYPES = {"act": ("v0s",), "amendment": ("amendments", "ammendments")}


class NoInputError(ValueError):
    """Nothing to read."""


def listing(spark: SparkSession, root: str, pattern: str = "*.pdf", recursive: bool = True) -> DataFrame:
    """Path, modificationTime, length of files, each once, in order of path."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return r.load(root).select("path", "modificationTime", "length").dropDuplicates(["path"]).orderBy("path")


def first(paths: DataFrame, count: int = 0) -> DataFrame:
    """S3: the first so many in order of path; 0: all."""
    if isinstance(count, bool) or not isinstance(count, int) or count < 0:
        raise ValueError("count must be a whole number, 0 or more")
    return paths.orderBy("path").limit(count) if count else paths


def spans(spark: SparkSession, path: str, doc_type: str | None = None) -> DataFrame:
    """The table of spans; doc_type prunes where it is a partition."""
    d = spark.read.parquet(path)
    return d.where(F.col("doc_type") == doc_type) if doc_type else d


def raw_tables(spark: SparkSession, path: str) -> DataFrame:
    """S5."""
    return spark.read.parquet(path).where(F.size("rows") >= 2)


def finished(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (file name) and xml of stored documents, verbatim."""
    d = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").text(path, wholetext=True)
    return d.select(F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.xml\z", "").alias("doc_id"), F.col("value").alias("xml"))


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """Stored documents, newest first, with their size in KB."""
    return listing(spark, root, "*.xml").withColumn("kb", F.bround(F.col("length") / 1024).cast("long")).orderBy(F.desc("modificationTime"), "path")


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """Key, values of a JSON object of objects; of an absent file none."""
    try:
        text = spark.read.text(path, wholetext=True)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "key string, values map<string,string>")
    m = F.from_json("value", "map<string,map<string,string>>")
    return text.select(F.explode(m).alias("key", "values"))


def with_schema(spark: SparkSession, path: str, row_tag: str, xsd: str) -> DataFrame:
    """Rows of XML checked against a schema; bad ones stand in _corrupt_record."""
    return spark.read.format("xml").option("rowTag", row_tag).option("rowValidationXSDPath", xsd).option("mode", "PERMISSIVE").load(path)


def safe_path(root: str, relative: str) -> str:
    """A path below root; ValueError for one that leaves it."""
    path = posixpath.normpath(posixpath.join(root, relative))
    if relative.startswith("/") or not path.startswith(posixpath.normpath(root) + "/"):
        raise ValueError("path leaves the root")
    return path


def source_catalog(types: DataFrame, files: DataFrame) -> DataFrame:
    """doc_type and its files; a type without files has one row with none."""
    return types.join(files, "doc_type", "left")
