"""Landing tables with the downloaded pages.

``list_pages``  board_id, page_id, url, html, fetched_at
``post_pages``  url, html, fetched_at; a URL may occur with several snapshots

Post pages are a plain folder of Parquet files, or a store, which is filled by
:func:`write_post_pages` in batches:

    pages/batch-…     the pages, sorted by ranges of their URL's hash
    index/batch-…     file, low, high: between which hashes a file's URLs lie
    arrivals/batch-…  url; written last, so what a stream sees there can be looked up
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boardpulse.sinks.tables import exists, make_folder

LIST_PAGES = "board_id INT, page_id BIGINT, url STRING, html STRING, fetched_at TIMESTAMP"
POST_PAGES = "url STRING, html STRING, fetched_at TIMESTAMP"
INDEX = "folder STRING, file STRING, low BIGINT, high BIGINT"

#: Characters of URLs and HTML that a file of a store holds at most, more or less.
RANGE_BYTES = 512 << 20
#: Files are smaller, down to this, where cores would have none to sort, write and parse otherwise.
LEAST_BYTES = 8 << 20
FILES_PER_CORE = 4


def read_list_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LIST_PAGES).parquet(path)


def url_hash(url: Column) -> Column:
    return F.xxhash64(url)


def write_post_pages(
    post_pages: DataFrame, path: str, range_bytes: int = RANGE_BYTES, least_bytes: int = LEAST_BYTES
) -> None:
    """Adds a batch of pages to a store.

    The pages are sorted by ranges of hashes, as many as their bytes and the session's cores ask for, so that a
    file holds neighbours and its least and largest hash tell which URLs cannot be in it. Very many
    snapshots of one URL are dealt by their time. The pages are read three times: to be
    measured, to find the ranges, and to be written.
    """
    spark = post_pages.sparkSession
    size = F.octet_length("url") + F.octet_length(F.coalesce("html", F.lit("")))
    total = post_pages.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    files = max(-(-total // range_bytes), min(-(-total // least_bytes), FILES_PER_CORE * spark.sparkContext.defaultParallelism), 1)
    folder = f"batch-{uuid.uuid4().hex}"
    hashed = post_pages.select("url", "html", "fetched_at", url_hash(F.col("url")).alias("url_hash"))
    ranged = hashed.repartitionByRange(files, "url_hash", "fetched_at").sortWithinPartitions("url_hash")
    ranged.write.parquet(f"{path}/pages/{folder}")
    written = spark.read.schema(f"{POST_PAGES}, url_hash BIGINT").parquet(f"{path}/pages/{folder}")
    index = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("url_hash").alias("low"), F.max("url_hash").alias("high"))
    index.select(F.lit(folder).alias("folder"), "file", "low", "high").write.parquet(f"{path}/index/{folder}")
    written.select("url").distinct().write.parquet(f"{path}/arrivals/{folder}")


def _cell(value: Column, bits: Column) -> Column:
    """Number of the interval of 2 ** bits hashes that a hash lies in."""
    return F.call_function("shiftright", value, bits)


@dataclass(frozen=True)
class PostStore:
    """Post pages in files by ranges of hashes."""

    spark: SparkSession
    path: str

    def index(self) -> DataFrame:
        """(folder, file, low, high) of all files."""
        if not exists(self.spark, f"{self.path}/index"):
            return self.spark.createDataFrame([], INDEX)
        return self.spark.read.schema(INDEX).option("recursiveFileLookup", "true").parquet(f"{self.path}/index")

    def pages(self) -> DataFrame:
        """All pages of the store."""
        return self._read(self.index())

    def files_for(self, urls: DataFrame) -> DataFrame:
        """(folder, file) of the files that can hold one of ``urls(url)``, by a join of hashes and ranges.

        A range is as wide as some power of two of hashes, and so meets three intervals of that
        width at most. Files are matched by (width, interval) in an equal join; a hash has a row for each width
        that occurs, 64 at most. No pair of a hash and a file is made beyond those.
        """
        width = F.col("high").cast("double") - F.col("low").cast("double") + 1
        bits = F.least(F.lit(63), F.ceil(F.log2(width))).cast("int")
        ranges = self.index().withColumn("bits", bits)
        widths = [r["bits"] for r in ranges.select("bits").distinct().collect()]
        if not widths:
            return ranges.select("folder", "file")
        low, high = _cell(F.col("low"), F.col("bits")), _cell(F.col("high"), F.col("bits"))
        cells = ranges.withColumn("cell", F.explode(F.sequence(low, high)))
        hashes = urls.select(url_hash(F.col("url")).alias("hash")).distinct()
        wanted = hashes.withColumn("bits", F.explode(F.array(*map(F.lit, widths)))).withColumn("cell", _cell(F.col("hash"), F.col("bits")))
        met = cells.join(wanted, ["bits", "cell"]).where("hash BETWEEN low AND high")
        return met.select("folder", "file").distinct()

    def pages_for(self, urls: DataFrame) -> DataFrame:
        """The pages of the files that can hold one of ``urls(url)``."""
        return self._read(self.files_for(urls))

    def _read(self, files: DataFrame) -> DataFrame:
        found = [f"{self.path}/pages/{r['folder']}/{r['file']}" for r in files.collect()]  # what the scan lists anyway
        if not found:
            return self.spark.createDataFrame([], POST_PAGES)
        return self.spark.read.schema(POST_PAGES).parquet(*found)


def read_post_pages(spark: SparkSession, path: str) -> DataFrame | PostStore:
    """Post pages of a plain folder, or the store that lies there."""
    return PostStore(spark, path) if is_store(spark, path) else spark.read.schema(POST_PAGES).parquet(path)


def is_store(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/arrivals")


def pages_for(post_pages: DataFrame | PostStore, refs: DataFrame) -> DataFrame:
    """Pages among which those of the references' URLs are; all pages of a plain folder."""
    return post_pages.pages_for(refs) if isinstance(post_pages, PostStore) else post_pages


def stream_list_pages(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """New files of the landing folder as a stream."""
    reader = spark.readStream.schema(LIST_PAGES).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_page_urls(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """URLs of new post pages as a stream, without their HTML."""
    folder = f"{path}/arrivals" if is_store(spark, path) else path
    make_folder(spark, folder)
    reader = spark.readStream.schema("url STRING").option("maxFilesPerTrigger", files_per_batch)
    return reader.option("recursiveFileLookup", "true").parquet(folder)


def latest_rows(
    snapshots: DataFrame, columns: Sequence[str], digest: Column | None = None, keys: Sequence[str] = ("url",)
) -> DataFrame:
    """(keys, columns) of the newest of ``snapshots(keys, fetched_at, columns)`` of each URL, or of all ``keys``.

    The newest time comes from a hash aggregate over keys and times alone, combined before the
    shuffle; ``columns`` are read and moved once, and what follows on the same keys finds them in
    place. Among snapshots of the same time the one with the largest digest counts, a hash of ``columns``
    if not given; equal ones are one row. No time comes first.
    """
    micros = F.coalesce(F.unix_micros(F.col("fetched_at").cast("timestamp")), F.lit(-(1 << 62)))
    newest = snapshots.select(*keys, micros.alias("at")).groupBy(*keys).agg(F.max("at").alias("newest"))
    tie = (F.xxhash64(*columns) if digest is None else digest).bitwiseAND(F.lit((1 << 63) - 1))
    rows = snapshots.select(*keys, *columns, micros.alias("at"), tie.alias("tie"))
    # No row is newer. Written so, as an equality would become a key of the join, and what follows would be moved again.
    found = rows.join(newest, list(keys)).where(F.col("at") >= F.col("newest"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("tie"))))
    return ranked.where("rank = 1").select(*keys, *columns)


def latest_list_pages(list_pages: DataFrame) -> DataFrame:
    """List pages without older snapshots of the same URL; of several of the same time all stay."""
    newest = list_pages.groupBy("url").agg(F.max("fetched_at").alias("newest_at"))
    return list_pages.join(newest, "url").where("fetched_at <=> newest_at").select(*list_pages.columns)
