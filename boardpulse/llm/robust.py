r"""Quality rules by robust multivariate outliers, in column expressions.

Four counts of a text become a vector of four ratios. For each language and
source a minimum-covariance-determinant estimate says where most vectors lie:
from medians and spreads, concentration steps take the three quarters of the
rows nearest to the estimate and compute mean and covariance of those. A row
whose Mahalanobis distance is too large is rejected.

Every step is one grouped aggregate over a narrow table, combined before the
shuffle, so a source with a third of all rows costs no more than others.
Estimates of small groups come from the language, then from all rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardpulse.llm.common import scratch_folder, split_words, stored

SYMBOLS = "#*$%&|<>"
#: Words of the windows whose repetition counts.
REPEAT = 5
#: Share of the rows that a concentration step keeps, and number of such steps.
KEPT, STEPS = 0.75, 3
#: Rows that a group needs for an estimate of its own.
LEAST_ROWS = 100
#: A standard deviation is never taken as smaller; in the order of the vector.
FLOORS = (0.06, 0.08, 0.04, 0.08)
#: Median of the chi-squared distribution with four degrees of freedom, and the squared distance that is too large.
CHI2_MEDIAN, TOO_FAR = 3.3567, 36.0
#: Groups whose estimates are broadcast at most; more are joined by a shuffle.
MAX_BROADCAST_GROUPS = 50_000
#: What an estimate is for.
GROUP = ["level", "lang", "source"]
_X = tuple(f"x{i}" for i in range(4))


def _repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that are found twice or more in the same text."""
    places = F.sequence(F.lit(1), F.size(words) - REPEAT + 1)
    plain = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, REPEAT)))
    return F.when(F.size(words) > REPEAT, plain).otherwise(F.array().cast("array<bigint>"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where the value is computed once even if it is used for each element."""
    return F.get(F.transform(F.array(value), use), 0)


def _covered(hashes: Column) -> Column:
    """Words covered by those windows whose hash occurs more than once."""

    def places(marked: Column) -> Column:
        # The first and the last of equal hashes stand beside an equal one.
        def beside(m: Column, k: Column, step: int) -> Column:
            return F.coalesce(F.get(marked, k + step).h == m.h, F.lit(False))

        twice = F.filter(marked, lambda m, k: beside(m, k, -1) | beside(m, k, 1))
        return F.sort_array(F.transform(twice, lambda m: m.i))

    at = _bound(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places)
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(s: Column, i: Column) -> Column:
        return F.struct((i + REPEAT).alias("end"), (s.n + i + REPEAT - F.greatest(s.end, i)).alias("n"))

    return F.aggregate(at, state, add, lambda s: s.n)


def counted(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words and the four base counts) of each whole text; a null text has none."""
    whole = F.coalesce("text", F.lit(""))
    words = documents.select("doc_id", "lang", "source", whole.alias("text"), split_words(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    read = words.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        _bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _repeated_words(F.col("words")).alias("hashes"),
    )
    none_twice = F.size(F.array_distinct("hashes")) == F.size("hashes")
    repeated = F.when(none_twice, F.lit(0).cast("long")).otherwise(_covered(F.col("hashes")))
    return read.withColumn("n_repeat_words", repeated).drop("hashes")


def with_vector(frame: DataFrame) -> DataFrame:
    """Mean word length as a logarithm, and roots of three rates per word."""
    words = F.greatest("n_words", F.lit(1))
    return frame.withColumns(
        {
            "x0": F.log((F.col("word_chars") + 1) / words),
            "x1": F.sqrt(F.col("n_symbols") / words),
            "x2": F.sqrt(F.col("n_dup_lines") / words),
            "x3": F.sqrt(F.col("n_repeat_words") / words),
        }
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of x0..x3 by means m0.. and the inverse root w00..w33."""
    moved = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(_X)]
    rows = [reduce(Column.__add__, (F.col(f"w{i}{j}") * moved[j] for j in range(i + 1))) for i in range(4)]
    return reduce(Column.__add__, (r * r for r in rows))


def _inverse_root(frame: DataFrame) -> DataFrame:
    """Adds the inverse of the Cholesky factor of the covariances c00..c33, spreads never below the floors."""
    for i in range(4):
        for j in range(i + 1):
            so_far = reduce(Column.__sub__, (F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.col(f"c{i}{j}"))
            value = F.sqrt(F.greatest(so_far + F.lit(FLOORS[i] ** 2), F.lit(FLOORS[i] ** 2))) if i == j else so_far / F.col(f"l{j}{j}")
            frame = frame.withColumn(f"l{i}{j}", value)
    for i in range(4):
        frame = frame.withColumn(f"w{i}{i}", 1 / F.col(f"l{i}{i}"))
        for j in range(i):
            total = reduce(Column.__add__, (F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)))
            frame = frame.withColumn(f"w{i}{j}", -total / F.col(f"l{i}{i}"))
    return frame


_ESTIMATE = [f"m{i}" for i in range(4)] + [f"w{i}{j}" for i in range(4) for j in range(i + 1)]


def _sized(frame: DataFrame) -> DataFrame:
    """A stored table of groups, to be broadcast if it is known to be small."""
    return F.broadcast(frame) if frame.count() <= MAX_BROADCAST_GROUPS else frame


def _group(level: int) -> Column:
    """The group of a row at a level, the names that do not count being empty."""
    names = [F.col(n) if level <= at else F.lit("") for n, at in (("lang", 1), ("source", 0))]
    return F.struct(F.lit(level).alias("level"), names[0].alias("lang"), names[1].alias("source"))


def _first_estimate(rows: DataFrame) -> DataFrame:
    """Medians, and spreads from quartiles without correlations."""
    quartiles = rows.groupBy(*GROUP).agg(*(F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, x in enumerate(_X)))
    moved = {f"m{i}": F.col(f"q{i}")[1] for i in range(4)}
    spread = {f"c{i}{j}": (((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349) ** 2 if i == j else F.lit(0.0)) for i in range(4) for j in range(i + 1)}
    return _inverse_root(quartiles.withColumns(moved | spread)).select(*GROUP, *_ESTIMATE)


def _next_estimate(near: DataFrame) -> DataFrame:
    means = [F.avg(x).alias(f"m{i}") for i, x in enumerate(_X)]
    products = [F.covar_pop(_X[i], _X[j]).alias(f"c{i}{j}") for i in range(4) for j in range(i + 1)]
    return _inverse_root(near.groupBy(*GROUP).agg(*means, *products)).select(*GROUP, *_ESTIMATE)


def estimates(rows: DataFrame, folder: str) -> DataFrame:
    """Minimum-covariance-determinant estimates of ``rows(level, lang, source, x0..x3)`` for each group.

    ``scale`` makes the median squared distance that of the chi-squared distribution.
    """
    now = _sized(stored(_first_estimate(rows), "estimate-0", folder))
    for step in range(1, STEPS + 1):
        far = rows.join(now, GROUP).withColumn("d", _distance())
        cut = far.groupBy(*GROUP).agg(F.percentile_approx("d", KEPT, 1000).alias("cut"))
        cut = _sized(stored(cut, f"cut-{step}", folder))
        near = far.select(*GROUP, *_X, "d").join(cut, GROUP).where("d <= cut")
        now = _sized(stored(_next_estimate(near), f"estimate-{step}", folder))
    far = rows.join(now, GROUP).withColumn("d", _distance())
    scale = F.greatest(F.percentile_approx("d", 0.5, 1000) / CHI2_MEDIAN, F.lit(1.0))
    return now.join(far.groupBy(*GROUP).agg(scale.alias("scale"), F.count("*").alias("n")), GROUP)


def quality_verdicts(documents: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, distance, kept), a row for each document row.

    ``base_failed``: fewer than ten words, or over a fifth of the words in
    repeated windows. Such rows are rejected and take no part in the estimates.
    Null or empty texts fail so. A null language or source counts as an empty
    one. Where no group, language or table has enough rows, ``distance`` is null
    and the row is kept. Repeated rows count each; extra columns are ignored.
    """
    folder = scratch_folder(documents.sparkSession)
    named = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = stored(with_vector(counted(named)).withColumn("base_failed", failed), "counts", folder)
    # Level 0 groups by both names, level 1 by the language, level 2 has all rows; the finest with enough rows counts.
    every = rows.where("not base_failed").select(F.explode(F.array(*(_group(k) for k in range(3)))).alias("g"), *_X).select("g.*", *_X)
    found = estimates(every, folder).where(F.col("n") >= LEAST_ROWS)
    found = _sized(stored(found.select(*GROUP, F.struct(*_ESTIMATE, "scale").alias("e")), "estimates", folder))
    joined = rows
    for k in range(3):
        own = found.where(F.col("level") == k).select(F.struct(*GROUP).alias(f"g{k}"), F.col("e").alias(f"e{k}"))
        joined = joined.withColumn(f"g{k}", _group(k)).join(own, f"g{k}", "left")
    joined = joined.select(*rows.columns, F.coalesce("e0", "e1", "e2").alias("e")).select(*rows.columns, "e.*")
    distance = _distance() / F.col("scale")
    return joined.select(
        "doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"),
        distance.alias("distance"),
        (~F.col("base_failed") & F.coalesce(distance <= TOO_FAR, F.lit(True))).alias("kept"),
    )
