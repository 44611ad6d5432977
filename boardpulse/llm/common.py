"""What the operators of this subpackage share: scratch tables and small column expressions."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a character class of a regular expression.
BLANKS = r"[ \t-\r]+"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared one that ``spark.checkpoint.dir`` names.

    Where that setting is missing (in tests), the warehouse folder takes its place.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str = "table", folder: str | None = None) -> DataFrame:
    """The frame written as a shared table and read again.

    It cuts the lineage, survives lost executors, and lets the planner know the size.
    """
    spark = frame.sparkSession
    path = f"{folder or scratch_folder(spark)}/{name}"
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes one of the scratch folders made here."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def matched(docs: DataFrame, keys: DataFrame, kind: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id and text are (``left_semi``) or are not (``left_anti``) among ``keys(doc_id, text_hash)``.

    The sides go by aliases, so that columns of any name pass through.
    """
    same_id = F.col(f"docs_side.{id_column}").eqNullSafe(F.col("keys_side.doc_id"))
    same_text = F.xxhash64(f"docs_side.{text_column}") == F.col("keys_side.text_hash")
    return docs.alias("docs_side").join(keys.alias("keys_side"), same_id & same_text, kind)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and all else as it was.

    ``lower`` does it for pure ASCII texts, where bytes and characters are as many.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def split_words(text: Column) -> Column:
    """Words between ASCII white space; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")
