"""References and post pages: host check, lookup by URL, reasons of rejection.

The lookup is one left join on the URL, which gives posts and rejects alike. A
pinned post may be linked from every list page, so one URL can hold a large share
of the references. Such URLs are found first, by a sketch, and joined on (url, salt),
their page being repeated once per salt; every other URL has the one salt 0. There is
one plan for all sizes.

Pages without a reference are left out where they are read, by bits of hashes. A page that
passes by chance finds no reference in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardpulse.config import BoardConfig
from boardpulse.functions.urls import url_authority

HOST_NOT_ALLOWED = "host_not_allowed"
BAD_POST_ID = "bad_post_id"
PAGE_MISSING = "page_missing"

# A salt serves at least this many references of a URL, ...
LEAST_ROWS_PER_SALT = 100_000
# ... and so many that no more URLs than this can need several: their list is broadcast.
MOST_HOT_URLS = 10_000
# URLs that a sketch tracks. It misses none with more than 7 / TRACKED of the references, less than one in MOST_HOT_URLS.
TRACKED = 1 << 17
# Sketches of tasks are merged in so many groups before the last merge.
SKETCH_GROUPS = 64
# Bits for each key of a filter, in words of 64: few at first, and 8 MB at most, which lets more keys pass by chance.
BITS_PER_KEY = 16
MOST_WORDS = 1 << 20
# Words of a filter come in arrays of so many.
CHUNK_WORDS = 1 << 10


def is_allowed_url(url: Column, config: BoardConfig = BoardConfig()) -> Column:
    """True if the network location is exactly one of the allowed hosts."""
    return url_authority(url).isin(*config.allowed_hosts)


def refused_reason(config: BoardConfig = BoardConfig()) -> Column:
    """Why a reference is not looked up at all; NULL if it is."""
    return F.when(F.col("post_id").isNull(), F.lit(BAD_POST_ID)).when(
        ~is_allowed_url(F.col("url"), config), F.lit(HOST_NOT_ALLOWED)
    )


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """Word and bit of a key in a filter."""
    key_hash = F.xxhash64(key)
    word = F.shiftrightunsigned(key_hash, 6).bitwiseAND(F.lit(words - 1))
    return word, F.call_function("shiftleft", F.lit(1).cast("long"), key_hash.bitwiseAND(F.lit(63)).cast("int"))


def maybe_among(key: Column, keys: DataFrame, count: int) -> Column:
    """True if ``key`` is in the one column of ``keys``; true by chance for few others. Of the kind of a key, not NULL.

    The bits of the hashes of ``keys``, some ``count`` rows, are set by hash aggregates, so keys do not move,
    and reach the tasks as one value of bounded size. The type of ``key`` must be that of ``keys``.
    """
    words = min(MOST_WORDS, max(CHUNK_WORDS, 1 << (count * BITS_PER_KEY // 64).bit_length()))
    word, bit = _place(F.col(keys.columns[0]), words)
    every = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    by_word = keys.select(word.alias("word"), bit.alias("bit")).unionAll(every).groupBy("word").agg(F.bit_or("bit").alias("bit"))

    def in_order(name: str, value: str) -> Column:
        return F.array_sort(F.collect_list(F.struct(name, value))).getField(value)

    chunks = by_word.groupBy(F.floor(F.col("word") / CHUNK_WORDS).alias("chunk")).agg(in_order("word", "bit").alias("bits"))
    bits = chunks.agg(in_order("chunk", "bits").alias("bits")).scalar()  # words / CHUNK_WORDS rows
    word, bit = _place(key, words)
    chunk = F.shiftright(word, CHUNK_WORDS.bit_length() - 1).cast("int")
    found = F.get(F.get(bits, chunk), word.bitwiseAND(F.lit(CHUNK_WORDS - 1)).cast("int"))
    return key.isNotNull() & (found.bitwiseAND(bit) != 0)


def with_references(pages: DataFrame, refs: DataFrame, count: int) -> DataFrame:
    """The pages that a reference has, and few others; ``refs`` are some ``count`` rows."""
    return pages.where(maybe_among(F.col("url"), refs.where("url IS NOT NULL").select("url"), count))


def hot_urls(refs: DataFrame, rows_per_salt: int) -> DataFrame:
    """(url, salts) of the URLs with more than ``rows_per_salt`` references, the MOST_HOT_URLS largest at most.

    A sketch of frequent items is filled where the references are read, so sketches move and no URLs. Its
    counts are never too low; it has all URLs above its bound of error, see ``TRACKED``. What it
    misses has one salt, which changes no result.
    """
    read = refs.where("url IS NOT NULL").select("url", F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part"))
    sketches = read.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(url, {TRACKED})").alias("sketch"))
    # A group of its own, as a merge of no sketches at all fails.
    top = sketches.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {TRACKED}), {MOST_HOT_URLS})").alias("top"))
    counts = top.select(F.inline("top")).select(F.col("item").alias("url"), F.col("count").alias("n")).where(F.col("n") > rows_per_salt)
    return counts.select("url", F.ceil(F.col("n") / rows_per_salt).cast("int").alias("salts"))


def salted_urls(refs: DataFrame, rows_per_salt: int | None = None, count: int | None = None) -> DataFrame:
    """(url, salts) of the URLs that need several; :func:`hot_urls` by what the number of references asks for, if not given."""
    if rows_per_salt is not None:
        return hot_urls(refs, rows_per_salt)
    rows_per_salt = max(LEAST_ROWS_PER_SALT, -(-(refs.count() if count is None else count) // MOST_HOT_URLS))
    return F.broadcast(hot_urls(refs, rows_per_salt))  # at most MOST_HOT_URLS rows


def with_salts(pages: DataFrame, hot: DataFrame) -> DataFrame:
    """Pages with ``salt``, those of a hot URL once for each of its salts."""
    each = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    return pages.join(hot, "url", "left").withColumn("salt", each).drop("salts")


def attached(refs: DataFrame, salted: DataFrame, hot: DataFrame, config: BoardConfig = BoardConfig()) -> DataFrame:
    """References with the columns of ``salted(url, salt, ...)``, a row per URL and salt, and ``reason``.

    ``reason`` is NULL where the reference may be used and its page is there. A
    reference listed twice gives two rows.
    """
    row = F.xxhash64(*[F.col(c) for c in refs.columns])
    salt = F.pmod(row, F.coalesce("salts", F.lit(1))).cast("int")
    keyed = refs.join(hot, "url", "left").withColumn("salt", salt).drop("salts")
    missing = F.when(F.col("found").isNull(), F.lit(PAGE_MISSING))
    joined = keyed.join(salted.withColumn("found", F.lit(True)), ["url", "salt"], "left")
    return joined.withColumn("reason", F.coalesce(refused_reason(config), missing)).drop("salt", "found")


def with_pages(
    refs: DataFrame, pages: DataFrame, config: BoardConfig = BoardConfig(), rows_per_salt: int | None = None
) -> DataFrame:
    """:func:`attached` for ``pages(url, ...)``, a row per URL.

    The references are read three times: to count them, to find hot URLs, and to join; pass a stored table.
    """
    hot = salted_urls(refs, rows_per_salt)
    return attached(refs, with_salts(pages, hot), hot, config)
