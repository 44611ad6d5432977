r"""Benchmark decontamination by a broadcast hash set of n-grams, in column expressions.

A window is 13 consecutive words of a benchmark item; a shorter item is one
window. Ten consecutive places of a document always hold one of the places 1, 11,
21, ..., so a 13-word window covers a whole 4-word seed that starts there. Each
document therefore gives a tenth of its 4-word seeds, with the words around
them, to a join with the benchmark's seeds; shorter windows have seeds and steps
of their own. Every place around a seed found is then compared with the windows
word by word, so hits are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardpulse.llm.common import lower_ascii, matched, scratch_folder, stored

#: What stands between words; it has A-Z, as texts are in lower case before.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: Seeds of the benchmark that are broadcast at most; more are joined by a shuffle.
MAX_BROADCAST_SEEDS = 1_000_000


def item_words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def _seed(length: int) -> tuple[int, int]:
    """(words of a seed, step): any window of that length covers a seed at some step."""
    words = 4 if length >= 8 else (length + 1) // 2
    return words, length - words + 1


def _windows(benchmark: DataFrame) -> DataFrame:
    """(len, window, items): each window once, with the ids of its items."""
    words = benchmark.select("item_id", item_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(WINDOW))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.array_join(F.slice("w", i, length), " "))
    return (
        words.select(F.col("item_id").cast("string").alias("item"), length.alias("len"), F.explode(grams).alias("window"))
        .groupBy("len", "window")
        .agg(F.collect_set("item").alias("items"))
    )


def _seeds(windows: DataFrame, lengths: list[int]) -> DataFrame:
    parts = F.split("window", " ")
    found = F.lit(None)
    for length in lengths:
        words, _ = _seed(length)
        grams = F.array(*(F.xxhash64(F.slice(parts, i, words)) for i in range(1, length - words + 2)))
        found = F.when(F.col("len") == length, grams).otherwise(found)
    return windows.select("len", F.explode(found).alias("seed")).distinct()


def _probes(lengths: list[int]) -> Column:
    """What a document (with words ``w``) is asked for: seeds, and the words around each."""

    def probe_at(length: int, words: int, step: int) -> Callable[[Column], Column]:
        def probe(i: Column) -> Column:
            start = F.greatest(i - (step - 1), F.lit(1))
            around = F.array_join(F.slice("w", start, i - start + length), " ")
            seed = F.xxhash64(F.slice("w", i, words))
            return F.struct(F.lit(length).alias("len"), seed.alias("seed"), start.alias("start"), around.alias("around"))

        return probe

    every = []
    for length in lengths:
        words, step = _seed(length)
        places = F.sequence(F.lit(1), F.greatest(F.size("w") - words + 1, F.lit(1)), F.lit(step))
        found = F.transform(places, probe_at(length, words, step))
        none = F.array().cast("array<struct<len:int,seed:bigint,start:int,around:string>>")
        every.append(F.when(F.size("w") >= length, found).otherwise(none))
    return F.concat(*every)


def _union_length(spans: Column) -> Column:
    """Places covered by sorted spans (start, len)."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, span: Column) -> Column:
        end = span.start + span.len
        return F.struct(
            F.greatest(state.end, end).alias("end"), (state.n + F.greatest(end - F.greatest(state.end, span.start), F.lit(0))).alias("n")
        )

    return F.aggregate(spans, zero, add, lambda s: s.n)


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items, contaminated), a row for each document row.

    A document is contaminated if it has a hit word and 20 * n_hit >= n_words.
    Null and empty texts have no words, and items without words no window. Repeated
    rows each get the same result. An item whose id is null marks words but is not
    counted; repeated items count once by id. Extra columns are ignored.
    """
    spark = documents.sparkSession
    folder = scratch_folder(spark)
    windows = stored(_windows(benchmark.select("item_id", "text")), "windows", folder)
    lengths = sorted(r.len for r in windows.select("len").distinct().collect())  # 13 values at most
    read = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), item_words(F.col("text")).alias("w"))
    counted = read.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"))
    if lengths:
        seeds = stored(_seeds(windows, lengths), "seeds", folder)
        if seeds.count() <= MAX_BROADCAST_SEEDS:
            seeds = F.broadcast(seeds)
        probes = read.select("doc_id", "text_hash", F.explode(_probes(lengths)).alias("p")).select("doc_id", "text_hash", "p.*")
        near = probes.join(seeds, ["len", "seed"], "left_semi").withColumn("a", F.split("around", " "))
        places = F.transform(
            F.sequence(F.lit(1), F.size("a") - F.col("len") + 1),
            lambda i: F.struct((F.col("start") + i - 1).alias("at"), F.array_join(F.slice("a", i, F.col("len")), " ").alias("window")),
        )
        tried = near.where("size(a) >= len").select("doc_id", "text_hash", "len", F.explode(places).alias("x"))
        met = tried.select("doc_id", "text_hash", "len", "x.at", "x.window").join(windows, ["len", "window"])
        found = met.groupBy("doc_id", "text_hash").agg(
            F.sort_array(F.collect_set(F.struct(F.col("at").alias("start"), "len"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        hits = stored(found.select("doc_id", "text_hash", _union_length(F.col("spans")).alias("n_hit"), "items"), "hits", folder)
    else:
        hits = spark.createDataFrame([], "doc_id long, text_hash long, n_hit long, items array<string>")
    hits = hits.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "n_hit", "items")
    joined = counted.join(hits, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "text_hash",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without its contaminated rows, all columns as they were."""
    bad = contamination(documents, benchmark).where("contaminated").select("doc_id", "text_hash").distinct()
    return matched(documents, stored(bad, "contaminated"), "left_anti")
