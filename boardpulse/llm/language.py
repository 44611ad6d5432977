"""Language of texts by fusing evidence in Bayes' way.

Four kinds of evidence are multiplied: the likelihood of the text's letter
triples under each language, the language that the markup declares, the suffix
of the address, and a prior of the host. Triples are counted over all documents
per declared language; host priors are counted from the texts' own verdicts and
smoothed over three levels, host, domain and all, by grouped aggregates. A class
``und`` stands for no language: each triple alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardpulse.llm.batches import by_text_size, map_batches
from boardpulse.llm.common import matched, scratch_folder, stored

#: Country suffixes that speak for a language. Fixed values.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en"}
#: No language.
UND = "und"
BUCKETS = 1 << 16
#: Rows of priors that are broadcast at most; more hosts are joined by a shuffle.
MAX_BROADCAST_HOSTS = 100_000
#: Letters turn a text into these bytes; all else of ASCII separates words.
_TO_LETTERS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Settings:
    #: Used where no language is declared often enough; else those declared are.
    languages: tuple[str, ...] = ("de", "en", "es", "fr")
    #: A declared value counts as a language from so many texts on.
    least_declared: int = 5
    #: How often a declaration or a suffix names the true language.
    declared_right: float = 0.9
    suffix_right: float = 0.7
    #: Prior of no language, and pseudo-counts by which a level leans on the one above.
    und: float = 0.01
    weight: float = 20.0
    #: Overlapping triples repeat their evidence.
    temper: float = 1 / 3
    #: A document is accepted from this probability on.
    least: float = 0.6


def triples(text: str | None) -> np.ndarray:
    """Buckets of the text's letter triples, words bounded by blanks; none without letters."""
    raw = b" ".join((text or "").lower().encode().translate(_TO_LETTERS).split())
    if not raw:
        return np.empty(0, np.uint32)
    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    return (((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)


def declared_languages(texts: DataFrame, settings: Settings = Settings()) -> Settings:
    """The settings with the languages that enough rows of ``texts(text, declared)`` declare."""
    counts = texts.where("text is not null and declared <> ''").groupBy("declared").agg(F.count("*").alias("n"))
    found = sorted(r.declared for r in counts.where(F.col("n") >= settings.least_declared).toLocalIterator() if r.declared != UND)
    return replace(settings, languages=tuple(found)) if found else settings


def triple_counts(texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(declared, bucket, n) over all rows of ``texts(text, declared)`` that declare a known language."""
    known = texts.where(F.col("declared").isin(*settings.languages) & F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {x: np.zeros(BUCKETS, np.int64) for x in settings.languages}
        for batch in by_text_size(batches, "text"):
            found: dict[str, list[np.ndarray]] = {}
            for text, declared in zip(batch.column("text").to_pylist(), batch.column("declared").to_pylist(), strict=True):
                found.setdefault(declared, []).append(triples(text))
            for declared, own in found.items():
                counts[declared] += np.bincount(np.concatenate(own), minlength=BUCKETS)
        for declared, n in counts.items():
            some = np.flatnonzero(n)
            columns = [pa.array([declared] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(n[some])]
            yield pa.RecordBatch.from_arrays(columns, ["declared", "bucket", "n"])

    found = map_batches(known.select("text", "declared"), run, "declared string, bucket int, n long")
    return found.groupBy("declared", "bucket").agg(F.sum("n").alias("n"))


def log_likelihoods(counts: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """A row for each language and one for none: logarithms per bucket. At most languages x buckets rows are read."""
    table = np.full((len(settings.languages), BUCKETS), 0.5)
    for row in counts.toLocalIterator():
        table[settings.languages.index(row["declared"]), row["bucket"]] += row["n"]
    table = np.log(table / table.sum(axis=1, keepdims=True))
    return np.vstack([table, np.full(BUCKETS, -np.log(BUCKETS))]).astype(np.float32)


def text_scores(texts: list[str | None], model: np.ndarray, temper: float) -> np.ndarray:
    """Tempered logarithms of the likelihoods, a row per text; a text without letters speaks for no language alone."""
    out = np.zeros((len(texts), len(model)))
    for i, text in enumerate(texts):
        found = triples(text)
        if len(found):
            out[i] = temper * model[:, found].sum(axis=1, dtype=np.float64)
        else:
            out[i, :-1] = -50.0
    return out


def _with_votes(frame: DataFrame, model: np.ndarray, settings: Settings) -> DataFrame:
    """(host, domain, vote) by the texts alone."""
    names = [*settings.languages, UND]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_text_size(batches, "text"):
            best = text_scores(batch.column("text").to_pylist(), model, settings.temper).argmax(axis=1)
            columns = [batch.column("host"), batch.column("domain"), pa.array([names[i] for i in best], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["host", "domain", "vote"])

    return map_batches(frame.select("text", "host", "domain"), run, "host string, domain string, vote string")


def host_priors(votes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(host, domain, prior) of ``votes(host, domain, vote)``; ``prior`` is an array in the order of the languages."""
    w, k = settings.weight, len(settings.languages)
    each = [F.sum(F.when(F.col("vote") == x, 1).otherwise(0)).cast("double") for x in settings.languages]
    hosts = votes.groupBy("host", "domain").agg(F.array(*each).alias("n"))
    added = [F.sum(F.col("n")[i]) for i in range(k)]
    domains = hosts.groupBy("domain").agg(F.array(*added).alias("n"))
    every = domains.agg(F.array(*(F.coalesce(s, F.lit(0.0)) for s in added)).alias("n"))

    def shares(n: Column, above: Column | None) -> Column:
        total = F.aggregate(n, F.lit(0.0), lambda s, x: s + x)
        parent = (lambda i: F.lit(1.0 / k)) if above is None else (lambda i: F.get(above, i))
        return F.transform(n, lambda x, i: (x + w * parent(i)) / (total + w))

    top = every.select(shares(F.col("n"), None).alias("top"))
    middle = domains.crossJoin(F.broadcast(top)).select(F.col("domain").alias("d"), shares(F.col("n"), F.col("top")).alias("above"))
    return hosts.join(middle, F.col("domain").eqNullSafe(F.col("d"))).select("host", "domain", shares(F.col("n"), F.col("above")).alias("prior"))


def _named_evidence(values: list[str | None], names: tuple[str, ...], right: float) -> np.ndarray:
    """Logarithms for a declared language per text; unknown or missing ones say nothing."""
    out = np.zeros((len(values), len(names) + 1))
    other = np.log((1 - right) / max(1, len(names) - 1))
    for i, value in enumerate(values):
        if value in names:
            out[i, :-1] = other
            out[i, names.index(value)] = np.log(right)
            out[i, -1] = -np.log(len(names))
    return out


def fuse(scores: np.ndarray, declared: list[str | None], suffixes: list[str | None], priors: np.ndarray, settings: Settings) -> np.ndarray:
    """Probabilities of each language and of none, a row per text."""
    names = settings.languages
    total = scores + np.log(np.hstack([(1 - settings.und) * priors, np.full((len(priors), 1), settings.und)]))
    total += _named_evidence(declared, names, settings.declared_right)
    total += _named_evidence([SUFFIXES.get(s or "") for s in suffixes], names, settings.suffix_right)
    total = np.exp(total - total.max(axis=1, keepdims=True))
    return total / total.sum(axis=1, keepdims=True)


def identified(
    texts: DataFrame,
    text: Column,
    declared: Column,
    host: Column,
    domain: Column,
    suffix: Column,
    keep: list[Column],
    settings: Settings = Settings(),
) -> DataFrame:
    """The ``keep`` columns with language, probability and accepted, a row for each row of ``texts``.

    The languages are those that enough rows declare. Missing evidence of any kind (null, or an unknown name) says nothing. A null
    text, and one without letters, is ``und`` and not accepted. Regions of a
    declared language (``en-GB``) and its case do not count. Long texts are read
    whole. Repeated rows stay; an empty table gives an empty table.
    """
    folder = scratch_folder(texts.sparkSession)
    main = F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]+)", 1))
    evidence = [text.alias("text"), main.alias("declared"), host.alias("host"), domain.alias("domain"), F.lower(suffix).alias("suffix")]
    kept = [c.alias(f"k{i}") for i, c in enumerate(keep)]
    read = texts.select(*evidence, *kept)
    settings = declared_languages(read, settings)
    model = log_likelihoods(stored(triple_counts(read, settings), "triples", folder), settings)
    priors = stored(host_priors(_with_votes(read, model, settings), settings), "priors", folder)
    if priors.count() <= MAX_BROADCAST_HOSTS:
        priors = F.broadcast(priors)
    priors = priors.select(F.col("host").alias("h"), F.col("domain").alias("d"), "prior")
    joined = read.join(priors, F.col("host").eqNullSafe(F.col("h")) & F.col("domain").eqNullSafe(F.col("d")), "left")
    fields = [f.simpleString().split(":", 1) for f in read.select(*(f"k{i}" for i in range(len(keep)))).schema.fields]
    schema = ", ".join([*(f"`{n}` {t}" for n, t in fields), "language string, probability double, accepted boolean"])
    names = [*settings.languages, UND]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        even = [1 / len(settings.languages)] * len(settings.languages)
        for batch in by_text_size(batches, "text"):
            scores = text_scores(batch.column("text").to_pylist(), model, settings.temper)
            prior = np.array([p or even for p in batch.column("prior").to_pylist()])
            chances = fuse(scores, batch.column("declared").to_pylist(), batch.column("suffix").to_pylist(), prior, settings)
            best = chances.argmax(axis=1)
            most = chances[np.arange(len(best)), best]
            columns = [batch.column(n) for n, _ in fields]
            columns += [pa.array([names[i] for i in best], pa.string()), pa.array(most), pa.array((best < len(names) - 1) & (most >= settings.least))]
            yield pa.RecordBatch.from_arrays(columns, [*(n for n, _ in fields), "language", "probability", "accepted"])

    return map_batches(joined.select("text", "declared", "suffix", "prior", *(n for n, _ in fields)), run, schema)


def document_languages(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, text_hash, language, probability, accepted): ``lang`` is what is declared, ``source`` the host."""
    none = F.lit(None).cast("string")
    found = identified(documents, F.col("text"), F.col("lang"), F.col("source"), none, none, [F.col("doc_id"), F.xxhash64("text")], settings)
    return found.select(F.col("k0").alias("doc_id"), F.col("k1").alias("text_hash"), "language", "probability", "accepted")


def page_languages(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(page_id, language, probability, accepted): what the markup declares, and host, domain and suffix of the address."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1))
    parts = F.split(host, r"\.")
    markup = F.regexp_extract("html", r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>|&[a-zA-Z0-9#]+;", " ")
    domain = F.array_join(F.slice(parts, -2, 2), ".")
    wide = F.when(F.size(parts) > 1, domain).otherwise(host)
    found = identified(pages, text, markup, host, wide, F.element_at(parts, -1), [F.col("page_id")], settings)
    return found.withColumnRenamed("k0", "page_id")


def without_rejected(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``documents`` without the rows that are not accepted, all columns as they were."""
    bad = document_languages(documents, settings).where("not accepted").select("doc_id", "text_hash").distinct()
    return matched(documents, stored(bad, "rejected"), "left_anti")
