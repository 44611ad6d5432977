"""A scorer learnt from labelled texts by grouped counts, and applied as a sparse product.

A text is a bag of tokens, each hashed to one of a fixed number of buckets. For
every bucket and class the weight is the logarithm of the bucket's share among
the tokens of the class's texts, smoothed by one, against the mean over the
classes. The outputs of a text are the means of its tokens' weights, stretched.
Weights are whole millionths, so their sums do not depend on the order.

Learning is one aggregate over the buckets, combined before the shuffle. Scoring
multiplies the sparse matrix of texts and buckets by the table of weights: the table is
one broadcast row of arrays, joined to every text, and a text's tokens are looked up in
it and summed where the text was read. Nothing is moved but the table, whatever the
number and length of the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardpulse.config import LABELS
from boardpulse.functions.text import let
from boardpulse.sinks.tables import stored

BUCKETS = 4096  # a power of two
UNIT = 1_000_000
STRETCH = 20.0


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[ \t-\r]+"), "")


def bucket_of(token: Column) -> Column:
    """Number of a token's bucket, by a checksum that any engine has or can count out."""
    return F.crc32(token.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1).cast("bigint")).cast("int")


def token_buckets(text: Column) -> Column:
    """Buckets of a text's tokens, repeats included, in order of their numbers: less to move than the text."""
    return F.sort_array(F.transform(tokens(text), lambda token: bucket_of(token).cast("smallint")))


@dataclass(frozen=True)
class TokenWeights:
    """``table``: bucket and a weight for each label, all buckets being there."""

    table: DataFrame

    def __call__(self, frame: DataFrame, text: str) -> DataFrame:
        """The frame with ``logits``, the outputs (neg, neu, pos) for a text column; zeros for a text without tokens."""
        summed = self.sums(frame, text, "token_sums")
        return summed.withColumn("logits", self.outputs(F.col("token_sums"))).drop("token_sums")

    def sums(self, frame: DataFrame, text: str, name: str) -> DataFrame:
        """The frame with ``name``: sums of the weights (neg, neu, pos) of a text's tokens, and the number of tokens.

        A text is summed in its own row, so neither it nor the columns beside it are moved. Sums of texts
        with white space between them add up to those of the whole.
        """
        rows = F.array_sort(F.collect_list(F.struct("bucket", *(F.col(name).cast("int").alias(name) for name in LABELS))))  # BUCKETS rows
        weights = self.table.agg(rows.alias("rows")).select(*(F.col("rows").getField(name).alias(f"weights_{name}") for name in LABELS))

        def total(buckets: Column, label: str) -> Column:
            # Buckets are counted from 0 and all there, as are the places of the array.
            return F.aggregate(buckets, F.lit(0).cast("bigint"), lambda sum, bucket: sum + F.get(f"weights_{label}", bucket))

        def totals(buckets: Column) -> Column:
            return F.array(*(total(buckets, label) for label in LABELS), F.size(buckets).cast("bigint"))

        buckets = F.transform(tokens(F.col(text)), bucket_of)
        joined = frame.join(F.broadcast(weights))
        return joined.withColumn(name, let(buckets, totals)).drop(*weights.columns)

    def outputs(self, sums: Column) -> Column:
        """The outputs for sums of :meth:`sums`: the means of the weights, stretched."""
        count = self.count(sums)
        means = [F.get(sums, F.lit(k)).cast("double") / (count * F.lit(UNIT)) * F.lit(STRETCH) for k in range(len(LABELS))]
        return F.when(count > 0, F.array(*means)).otherwise(F.array(*(F.lit(0.0) for _ in LABELS)))

    def count(self, sums: Column) -> Column:
        """The number of tokens among the sums."""
        return F.get(sums, F.lit(len(LABELS)))


def learn_weights(texts: DataFrame, folder: str) -> TokenWeights:
    """Weights from ``texts(text, label)`` over all its rows, written below ``folder``; nulls and unknown labels are left out.

    In place of the text a row may have ``buckets``, by :func:`token_buckets`: what a join with the labels should move.
    """
    buckets = F.col("buckets") if "buckets" in texts.columns else token_buckets(F.col("text"))
    known = texts.where(F.col("label").isin(*LABELS))
    each = known.select("label", F.explode_outer(buckets).alias("bucket")).where("bucket IS NOT NULL")
    counts = each.groupBy(F.col("bucket").cast("int").alias("bucket")).agg(*(F.count_if(F.col("label") == name).alias(name) for name in LABELS))
    every = texts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    smoothed = every.join(counts, "bucket", "left").select("bucket", *((F.coalesce(name, F.lit(0)) + 1.0).alias(name) for name in LABELS))
    whole = Window.partitionBy()  # over BUCKETS rows
    logs = smoothed.select("bucket", *(F.log(F.col(name) / F.sum(name).over(whole)).alias(name) for name in LABELS))
    mean = sum((F.col(name) for name in LABELS[1:]), F.col(LABELS[0])) / len(LABELS)
    weights = logs.select("bucket", *(F.round((F.col(name) - mean) * UNIT).cast("bigint").alias(name) for name in LABELS))
    return TokenWeights(stored(weights, f"{folder}/weights"))
