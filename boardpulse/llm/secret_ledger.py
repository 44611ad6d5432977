"""Secrets in texts, by a ledger of blobs: every text is scanned once per version of a rule.

A row of a history is one version of one path. Its text is a blob, named by the
SHA-256 of its bytes, so that equal texts of any paths and times are one blob. The
ledger is a folder with a sub-folder per run:

    findings/run=…   blob, rule, start, end   what a rule found in a blob
    scans/run=…      blob, rules              which rules have been tried on it

``scan_new`` scans only the pairs of blob and rule that no finished run has, and
``findings_of`` joins the findings back to all rows that hold the blob. A run counts
once its scans are written, which come last: one that is lost midway is done anew.

Everything is column expressions. Places come from cutting the text at the
matches: a match starts after the lengths of all gaps and matches before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boardpulse.llm.common import remove_folder, scratch_folder, stored


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of a Java pattern that do not overlap, kept if ``group`` has ``least`` characters.

    A change of anything else here needs a new version, by which the ledger knows
    what it has to scan again.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


#: In the order in which findings of the same start are listed. A run of letters is tried once, from its first one.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}+"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+"),
)
RULES = (
    *BASE_RULES,
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?"),
    Rule("web_token", r"(?<![\w-])eyJ[\w-]{5,}+\.[\w-]{8,}+\.[\w-]{8,}+"),
    Rule("host_token", r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("upper_hex", r"(?<![0-9A-F])(?=[A-F]*+[0-9])[0-9A-F]{40,}+"),
)

#: Bytes of blob names that may be broadcast, and what one takes there.
BROADCAST_BYTES = 64 << 20
_NAME_BYTES = 128


def blob_name(text: Column) -> Column:
    """SHA-256 of the text's bytes; a null is an empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _runs(spark: SparkSession, ledger: str) -> list[str]:
    """Runs whose scans are written to the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/scans")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(x.getPath().getName() for x in files.listStatus(path) if files.exists(done(x.getPath(), "_SUCCESS")))


def _seen(spark: SparkSession, ledger: str) -> DataFrame | None:
    """(blob, rules) that finished runs have scanned; none before the first run."""
    runs = _runs(spark, ledger)
    if not runs:
        return None
    scans = spark.read.schema("blob binary, rules array<string>").parquet(*(f"{ledger}/scans/{r}" for r in runs))
    return scans.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))


def _pieces(text: Column, rule: Rule) -> Column:
    """For each match the length of the gap before it, its own, and whether it is kept; null without a match."""
    sizes = F.zip_with(
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
        F.split(text, rule.pattern, -1),
        lambda match, gap: F.struct(
            F.char_length(gap).alias("gap"),
            F.char_length(match).alias("size"),
            (F.char_length(F.regexp_extract(match, rule.pattern, rule.group) if rule.group else match) >= rule.least).alias("kept"),
        ),
    )
    return F.when(text.rlike(rule.pattern), sizes)


def _unseen_texts(history: DataFrame, blobs: DataFrame, seen: DataFrame | None, keys: Column, folder: str) -> DataFrame:
    """(blob, text, rules): each blob once that lacks some rules. Copies go before the exchange, so a hot blob is small."""
    texts = history.select(blob_name(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    if seen is None:
        return texts.groupBy("blob").agg(F.first("text").alias("text")).withColumn("rules", keys)
    rules = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
    missing = blobs.join(seen, "blob", "left").select("blob", rules.alias("rules")).where(F.size("rules") > 0)
    missing = stored(missing, "missing", folder)
    if missing.count() * _NAME_BYTES <= BROADCAST_BYTES:
        new = texts.join(F.broadcast(missing), "blob")
        return new.groupBy("blob").agg(F.first("text").alias("text"), F.first("rules").alias("rules"))
    return texts.groupBy("blob").agg(F.first("text").alias("text")).join(missing, "blob")


def addresses(history: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(row, blob) for each version: the kept columns as one struct, and the name of its text."""
    return history.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), blob_name(F.col("text")).alias("blob"))


def scan_new(history: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> int:
    """Scans the blobs of a history for the rules that the ledger does not have yet; gives the number of blobs scanned.

    ``history`` has a column ``text``; others are not read. A null is an empty text. Equal
    texts are one blob however many rows hold them. Without rows or rules nothing is scanned.
    """
    if not rules:
        return 0
    spark = history.sparkSession
    folder, run = scratch_folder(spark), f"run={uuid.uuid4().hex}"
    keys = F.array(*(F.lit(r.key) for r in rules))
    seen = _seen(spark, ledger)
    blobs = history.select(blob_name(F.col("text")).alias("blob")).distinct()
    new = _unseen_texts(history, blobs, seen, keys, folder)
    found = [
        F.struct(
            F.lit(r.key).alias("rule"),
            F.when(F.array_contains("rules", r.key), _pieces(F.col("text"), r)).alias("pieces"),
        )
        for r in rules
    ]
    hits = F.filter(F.array(*found), lambda x: x.pieces.isNotNull())
    raw = stored(new.select("blob", "rules", hits.alias("hits")), "raw", folder)
    _located(raw).write.mode("overwrite").parquet(f"{ledger}/findings/{run}")
    raw.select("blob", "rules").write.mode("overwrite").parquet(f"{ledger}/scans/{run}")
    count = raw.count()
    remove_folder(spark, folder)
    return count


def _located(raw: DataFrame) -> DataFrame:
    """(blob, rule, start, end) of the kept matches, in characters; only lengths are moved, a window per blob and rule."""
    each = raw.select("blob", F.explode("hits").alias("hit")).select("blob", "hit.rule", F.posexplode("hit.pieces").alias("n", "piece"))
    before = Window.partitionBy("blob", "rule").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("piece.gap").cast("long") + F.coalesce("piece.size", F.lit(0))).over(before)
    return each.select("blob", "rule", "piece.size", "piece.kept", end.alias("end")).where("kept").select(
        "blob", "rule", (F.col("end") - F.col("size")).alias("start"), "end"
    )


_FINDING = "array<struct<start:bigint,place:int,kind:string,end:bigint>>"


def findings_of(history: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(row, blob, findings) for each version in a history, from the ledger alone.

    ``row`` is a struct of the kept columns, so that no name can clash. ``findings`` has
    (start, place, kind, end) in the order of start and place in ``rules``; starts and ends count
    characters, an end is exclusive. It is empty for a blob without findings, and null for one
    that the ledger has not been scanned for by all of the rules. Repeated rows stay repeated.
    """
    spark = history.sparkSession
    folder = scratch_folder(spark)
    rows = stored(addresses(history, keep), "addresses", folder)
    empty = F.array().cast(_FINDING)
    runs = _runs(spark, ledger)
    if not runs or not rules:
        return rows.withColumn("findings", F.lit(None).cast(_FINDING) if rules else empty)
    schema = "blob binary, rule string, start bigint, end bigint"
    known = spark.read.schema(schema).parquet(*(f"{ledger}/findings/{r}" for r in runs))
    keys = {r.key: (i, r.name) for i, r in enumerate(rules)}
    place = F.create_map(*(F.lit(x) for k, (i, _) in keys.items() for x in (k, i)))
    name = F.create_map(*(F.lit(x) for k, (_, n) in keys.items() for x in (k, n)))
    one = F.struct("start", place[F.col("rule")].alias("place"), name[F.col("rule")].alias("kind"), "end")
    # Two runs at a time may have scanned the same pair.
    per_blob = known.where(F.col("rule").isin(list(keys))).distinct().groupBy("blob").agg(F.array_sort(F.collect_list(one)).alias("found"))
    scanned = _seen(spark, ledger).where(F.size(F.array_except(F.array(*map(F.lit, keys)), "seen")) == 0).select("blob")
    # Written, so that the join below is the only one and reads plain exchanges, whose large keys can be split.
    by_blob = stored(scanned.join(per_blob, "blob", "left").select("blob", F.coalesce("found", empty).alias("findings")), "by_blob", folder)
    return rows.join(by_blob, "blob", "left").select("row", "blob", "findings")


def spans_text(findings: Column) -> Column:
    """``kind:start:end`` of findings, joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f.kind, f.start.cast("string"), f.end.cast("string"))), ",")


def secret_digests(documents: DataFrame) -> DataFrame:
    """One row for each row of documents: counts and digest of the base rules' findings, and all spans.

    Null and empty texts have none. The ledger is a new one, as the result is that of all texts.
    """
    ledger = f"{scratch_folder(documents.sparkSession)}/ledger"
    scan_new(documents, ledger)
    found = findings_of(documents, ledger)
    base = F.filter("findings", lambda f: f.kind.isin([r.name for r in BASE_RULES]))
    kinds = F.transform("findings", lambda f: f.kind)
    counts = [F.size(F.filter(kinds, F.lit(r.name).__eq__)).cast("long").alias(f"n_{r.name}") for r in BASE_RULES]
    return found.select(
        "row.doc_id", *counts, F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("findings")).alias("spans")
    )
