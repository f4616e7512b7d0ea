"""File discovery and raw JSON reads (SRC3, SRC4, SRC8, FLT2, FLT3, SRT4).

Discovery is a Spark scan of file metadata (``binaryFile`` without its
content column), recursive and filtered by a case-insensitive suffix glob at
listing time -- the driver never walks the tree itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Case-insensitive ``*.json``: glob character classes, one per letter.
JSON_GLOB = "*.[jJ][sS][oO][nN]"
#: The same, compressed.
GZIP_GLOB = JSON_GLOB + ".[gG][zZ]"


def list_files(spark: SparkSession, root: str, glob: str = JSON_GLOB) -> DataFrame:
    """SRC3/SRT4: every matching file under ``root`` -> (path, length, modificationTime), sorted."""
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob)
            .load(root)
            .select("path", "length", "modificationTime")
            .orderBy("path"))


def newer_than(files: DataFrame, mark: str | None, col: str = "path") -> DataFrame:
    """FLT2: paths strictly greater than a high-water mark (reference semantics;
    the streaming file source tracks every file instead, see D3).

    On a read whose ``col`` is ``_metadata.file_path`` Spark filters the files
    themselves by it: older ones are listed, not read."""
    return files if not mark else files.where(F.col(col) > F.lit(mark))


def read_raw_json(spark: SparkSession, root: str, multiline: bool = True,
                  glob: str = JSON_GLOB) -> DataFrame:
    """SRC4: raw JSON text with its source path -> (RawJson, source_path).

    ``multiline``: one document per file (whole file is one value); otherwise
    JSON lines (one document per line).  The text is kept exactly as read.
    """
    reader = (spark.read.format("text")
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob))
    if multiline:
        reader = reader.option("wholetext", "true")
    df = reader.load(root)
    return df.select(F.col("value").alias("RawJson"), F.col("_metadata.file_path").alias("source_path"))


def read_json_typed(spark: SparkSession, root: str, schema: T.StructType, multiline: bool = True,
                    glob: str = JSON_GLOB) -> DataFrame:
    """SRC4: parsed JSON with an explicit schema (no inference pass over the files)."""
    return (spark.read.schema(schema)
            .option("multiLine", "true" if multiline else "false")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob)
            .json(root))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on its (Hadoop-compatible) file system?"""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def landing_has(spark: SparkSession, path: str) -> bool:
    """SRC8: is the raw file already in the landing zone? (no download is built)."""
    return path_exists(spark, path)
