"""Directories of files as rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Bytes of a file that a task holds at once where files come in parts.
PART_BYTES = 4 << 20

# MIME types by file extension.
MIME_TYPES = {
    "txt": "text/plain",
    "md": "text/markdown",
    "html": "text/html",
    "csv": "text/csv",
    "json": "application/json",
    "pdf": "application/pdf",
    "png": "image/png",
    "jpg": "image/jpeg",
    "parquet": "application/vnd.apache.parquet",
}


def mime_of(path: Column) -> Column:
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    table = F.create_map(*[F.lit(x) for pair in MIME_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, extension), F.lit("application/octet-stream"))


def _on_disk(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open the files of a path themselves."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return found.getUri().getScheme() == "file"


def _in_parts(listed: DataFrame, part_bytes: int) -> DataFrame:
    """``(path, part, content, md5, modificationTime)`` of listed local files, read from begin to end by a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, modified in zip(batch.column("path").to_pylist(), batch.column("modificationTime")):
                digest, part = hashlib.md5(), 0
                with open("/" + name.removeprefix("file:").lstrip("/"), "rb") as file:
                    while content := file.read(part_bytes):
                        digest.update(content)
                        row = [pa.array([name]), pa.array([part], pa.int32()), pa.array([content]), pa.array([digest.hexdigest()])]
                        yield pa.RecordBatch.from_arrays([*row, pa.array([modified], modified.type)], names)
                        part += 1

    names = ["path", "part", "content", "md5", "modificationTime"]
    schema = "path string, part int, content binary, md5 string, modificationTime timestamp"
    return listed.select("path", "modificationTime").mapInArrow(read, schema)


def import_directory(
    spark: SparkSession, path: str, pattern: str | None = None, part_bytes: int | None = None
) -> DataFrame:
    """``(key, value, mime_type, modified_at)`` of every file below a path.

    The key is the path relative to the directory. Each file is one row, so
    the reader splits the work by file.

    With ``part_bytes`` a file of any size comes as rows of at most as many
    bytes, which also have its ``path``, the number of the ``part`` from 0, and
    the ``md5`` of the file up to the part's end, so that of the last part is
    the file's. Files of another scheme than ``file`` are read by Spark's
    reader, which has whole files only; there each is one part. Empty files are
    no rows either way.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files, of_parts = reader.load(path), []
    if part_bytes:
        whole = files.withColumns({"part": F.lit(0), "md5": F.md5("content")})
        files, of_parts = _in_parts(files, part_bytes) if _on_disk(spark, path) else whole, ["path", "part", "md5"]
    base = path.rstrip("/") + "/"
    name = F.regexp_replace(F.substring_index(F.col("path"), base, -1), "^/+", "")
    return files.select(
        name.alias("key"),
        F.col("content").alias("value"),
        mime_of(F.col("path")).alias("mime_type"),
        F.col("modificationTime").alias("modified_at"),
        *of_parts,
    )


def import_texts(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """``(content, metadata)`` of text files, one document per file."""
    files = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
    )
    return files.select(
        F.col("value").alias("content"),
        F.to_json(F.struct(F.col("_metadata.file_path").alias("source"))).alias("metadata"),
    )
