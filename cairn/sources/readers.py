"""Scans: CSV as typed snapshots, Parquet with provenance, facts about files."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.text import coverage, snake, source_id, strip

LARGE_FILE = 1 << 30


def csv(spark: SparkSession, path: str, sep: str = ",", quote: str = '"') -> DataFrame:
    """All columns as text: types are the contract's business."""
    return spark.read.csv(path, header=True, sep=sep, quote=quote, encoding="UTF-8", inferSchema=False)


def typed_snapshot(raw: DataFrame, columns: list[tuple[str, str, str]], year: str, start: int, cutoff: int) -> DataFrame:
    """(raw name, name, Spark type) projection, cut to years from start to cutoff.  The year column is tried, all others
    must cast."""
    cast = lambda raw_name, t, c: F.col(f"`{raw_name}`").try_cast(t) if c == year else F.col(f"`{raw_name}`").cast(t)
    return raw.select(*(cast(r, t, c).alias(c) for r, c, t in columns)).where(F.col(year).between(start, cutoff))


def _files_of(spark: SparkSession, path: str) -> list[str]:
    """The names that Spark gives to a file, or to the files below a folder (URIs, escaped)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    f = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, listed = [], f.listFiles(p, True)
    while listed.hasNext():
        found.append(listed.next().getPath().toUri().toString())
    return found


def parquet_inputs(spark: SparkSession, inputs: list[dict], run_id: str) -> DataFrame | None:
    """All inputs ({file_path, content_hash}) stacked, each row with its file, content hash and run; None without inputs.

    A row finds its input by its file's name, as Spark gives it; the list, which the driver holds as it is, is sent along."""
    if not inputs:
        return None
    plain = lambda c: F.regexp_replace(c, "^file:/*", "/")
    rows = [(name, i["content_hash"]) for i in inputs for name in _files_of(spark, i["file_path"])]
    by_hash = spark.createDataFrame(rows, "_p string, _content_hash string").withColumn("_p", plain("_p"))
    df = spark.read.option("mergeSchema", True).parquet(*(i["file_path"] for i in inputs)).withColumn("_bronze_file", F.col("_metadata.file_path"))
    return df.join(F.broadcast(by_hash), plain("_bronze_file") == F.col("_p"), "left").drop("_p").withColumn("_ingest_run_id", F.lit(run_id))


def file_facts(spark: SparkSession, root: str, pattern: str = "*.parquet", large_file: int = LARGE_FILE) -> DataFrame:
    """file_path, file_size, content_hash (SHA-256), source_id, coverage of every file below ``root``.  Files beyond
    ``large_file`` are hashed in pieces by the workers; no content reaches the driver.  A file that goes or cannot be read
    meanwhile does not fail the others: it has no hash, and error says why."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    facts = [F.col("path").alias("file_path"), F.col("length").alias("file_size")]

    def pieces(batches):
        from pyarrow import fs

        for pdf in batches:
            hashes, errors = [], []
            for p in pdf["file_path"]:
                try:
                    f, at = fs.FileSystem.from_uri(p) if "://" in p else (fs.LocalFileSystem(), p.removeprefix("file:"))
                    running = hashlib.sha256()
                    with f.open_input_stream(at) as s:
                        while piece := s.read(1 << 20):
                            running.update(piece)
                    hashes.append(running.hexdigest())
                    errors.append(None)
                except OSError as e:
                    hashes.append(None)
                    errors.append(f"unreadable: {type(e).__name__}")
            yield pdf.assign(content_hash=hashes, unread=errors)

    small = files.where(F.col("length") <= large_file).select(*facts, F.sha2("content", 256).alias("content_hash"), F.lit(None).cast("string").alias("unread"))
    large = files.where(F.col("length") > large_file).select(*facts).mapInPandas(pieces, "file_path string, file_size long, content_hash string, unread string")
    both = small.unionByName(large).withColumn("c", coverage(F.col("file_path")))
    told = [F.col("c.start").alias("coverage_start"), F.col("c.end").alias("coverage_end"), F.col("c.grain").alias("grain")]
    return both.select("file_path", "file_size", "content_hash", source_id(F.col("file_path")).alias("source_id"), *told, F.coalesce("unread", "c.error").alias("error"))


def country_dimension(raw: DataFrame, names: dict[str, str], iso: str = "iso_country", key: str = "country_id") -> DataFrame:
    """A dimension from text: names mapped or in snake case, cells stripped, codes in capitals and checked, keys 1..N
    in the order of the codes."""
    df = raw.toDF(*(snake(c, names) for c in raw.columns))
    df = df.select(*(strip(F.col(c)).alias(c) for c in df.columns)).withColumn(iso, F.upper(iso))
    bad = df.where(~F.coalesce(F.rlike(iso, F.lit("^[A-Z]{3}$")), F.lit(False))).limit(5).collect()
    if bad:
        raise ValueError(f"codes that are not three letters: {[r[iso] for r in bad]}")
    from pyspark.sql import Window

    return df.withColumn(key, F.row_number().over(Window.orderBy(iso)).cast("int")).select(key, *df.columns)  # some 250 rows
