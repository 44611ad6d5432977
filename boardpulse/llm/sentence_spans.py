"""Substring dedup by sliding runs of sentences.

A text is cut into sentences, and long ones into parts: after end marks and line ends,
and before every word whose hash is the least of its neighbours', ties included. The
last rule makes any text be cut alike wherever it stands, except at its ragged ends.
From every part on, the shortest run of at least two with at least ``WORDS`` words
together is hashed, in lower case and without regard to white space. Runs are joined
over all documents; every occurrence but the first (by document id, then by place)
marks its parts, and marked parts are removed.

Hashes that occur twice are found by a count of 64 bits a run, combined before the
shuffle. They fill a bit filter of fixed size, and a second pass over the texts moves
only runs that it lets through, with 128 bits and the characters they span: the filter
spares work and decides nothing. Occurrences are joined with their first place, which
is written before, so a passage that a third of the documents share is a large key of
a plain join, which Spark can split. Within a batch, words, cuts and hashes are
computed for all characters at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardpulse.llm.batches import by_text_size, map_batches
from boardpulse.llm.common import scratch_folder, stored

#: A run has so many parts and words at least.
PARTS, WORDS = 2, 24
#: Words on either side that a content-defined cut looks at.
AROUND = 3
#: What ends a sentence as the last character of a word.
MARKS = ".!?;:,…。！？|"
#: Bytes of text that are worked on at once.
PIECE_BYTES = 1 << 18
#: Bits of the filter, a power of two: 8 MB are broadcast, whatever the input.
FILTER_BITS = 1 << 26

_U = np.uint64
_SPACE, _MARK, _LINE = 1, 2, 4


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _numbers(seed: int, count: int) -> np.ndarray:
    """Fixed odd numbers of 64 bits, by position."""
    return _mixed(np.arange(1, count + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its kind, and a number of 64 bits for its lower case."""
    kinds, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=_U)
    for c in map(chr, range(0x20000)):  # no character beyond has a case or is white space
        kinds[ord(c)] = c.isspace()
        small = c.lower()
        if small != c and len(small) == 1:
            lower[ord(c)] = ord(small)
    kinds[[ord(c) for c in MARKS]] |= _MARK
    kinds[ord("\n")] |= _LINE
    return kinds, _mixed(lower + _U(1))


@dataclass
class Words:
    """Words of some texts: where they start, the hashes of each, and the texts and parts they belong to."""

    starts: np.ndarray  # characters of the joined texts
    text: np.ndarray
    hashes: list[np.ndarray]
    begins: np.ndarray  # words that begin a part, ending with the number of words
    offsets: np.ndarray  # where each text starts, ending with where a further one would


def cut(texts: list[str], rows: int = 1) -> Words:
    """Words and parts of texts, with ``rows`` independent hashes of 64 bits a word."""
    kinds_of, numbers = _characters()
    joined = "\n".join([*texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    kinds = kinds_of[points]
    inside = np.flatnonzero(kinds & _SPACE == 0)
    if not len(inside):
        none = np.empty(0, np.int64)
        return Words(none, none, [none.astype(_U)] * rows, np.zeros(1, np.int64), offsets)
    first = np.flatnonzero(np.r_[True, np.diff(inside) > 1])  # within ``inside``
    sizes = np.diff(np.r_[first, len(inside)])
    starts, lasts = inside[first], inside[first + sizes - 1]
    place = np.arange(len(inside)) - np.repeat(first, sizes)
    values = numbers[points[inside]]
    hashes = [_mixed(np.add.reduceat(values * _numbers(seed, int(sizes.max()))[place], first)) for seed in range(rows)]
    text = np.searchsorted(offsets, starts, side="right") - 1
    lines = np.cumsum(kinds & _LINE != 0)
    cuts = np.ones(len(starts), bool)
    cuts[1:] = (kinds[lasts[:-1]] & _MARK != 0) | (lines[starts[1:]] > lines[lasts[:-1]])
    middle = slice(AROUND, len(starts) - AROUND)
    if len(starts) > 2 * AROUND:
        near = [hashes[0][k : len(starts) - 2 * AROUND + k] for k in range(2 * AROUND + 1)]
        cuts[middle] |= (near[AROUND] == np.minimum.reduce(near)) & (text[: -2 * AROUND] == text[2 * AROUND :])
    return Words(starts, text, hashes, np.append(np.flatnonzero(cuts), len(starts)), offsets)


@dataclass
class Runs:
    """Runs of some texts: the text, the hashes, and the characters [begin, end) of it that a run spans."""

    text: np.ndarray
    hashes: list[np.ndarray]
    begin: np.ndarray
    end: np.ndarray


def runs(words: Words) -> Runs:
    """From every part on, the shortest run with enough parts and words of its text."""
    count = len(words.starts)
    begins = words.begins
    parts = len(begins) - 1
    text = words.text[begins[:-1]]
    stop = np.maximum(np.searchsorted(begins, begins[:-1] + WORDS, side="left"), np.arange(parts) + PARTS)
    # The part after the last one of a text begins the next text, or is the end.
    after = np.searchsorted(text, text, side="right")
    kept = np.flatnonzero(stop <= after)
    a, stop, text, after = begins[:-1][kept], stop[kept], text[kept], after[kept]
    e = begins[stop]
    hashes = []
    for seed, of_words in enumerate(words.hashes):
        step = int(_numbers(101 + seed, 1)[0])
        up, down = (np.cumprod(np.r_[_U(1), np.full(count, x, _U)]) for x in (step, pow(step, -1, 1 << 64)))
        sums = np.r_[_U(0), np.cumsum(of_words * up[:count])]
        hashes.append(_mixed((sums[e] - sums[a]) * down[a] + (e - a).astype(_U)))
    offset = words.offsets[text]
    first = np.r_[True, words.text[begins[1:-1]] != words.text[begins[:-2]]][kept] if parts else kept.astype(bool)
    begin = np.where(first, 0, words.starts[a] - offset)
    following = words.starts[np.minimum(e, count - 1)] if count else e
    end = np.where(stop == after, words.offsets[text + 1] - 1, following) - offset
    return Runs(text, hashes, begin, end)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _repeated_hashes(documents: DataFrame) -> DataFrame:
    """(hash): the runs' 64 bits that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_text_size(batches, "text", PIECE_BYTES):
            yield pa.RecordBatch.from_arrays([_signed(runs(cut(batch.column("text").to_pylist())).hashes[0])], ["hash"])

    read = documents.select("text").where("text is not null")
    return map_batches(read, run, "hash long").groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")


def _filter(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes, as words of 64; at most FILTER_BITS come to the driver."""
    word = F.shiftright("hash", 6).bitwiseAND(F.lit(FILTER_BITS // 64 - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("hash").bitwiseAND(F.lit(63)).cast("int"))
    found = hashes.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, _U)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(_U)
    return bits


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    word = (hashes >> _U(6)) & _U(FILTER_BITS // 64 - 1)
    return (bits[word.astype(np.int64)] >> (hashes & _U(63))) & _U(1) != 0


def _occurrences(documents: DataFrame, bits: np.ndarray) -> DataFrame:
    """(hash, more, doc_id, text_hash, begin, end) of the runs that the filter lets through."""
    sent = documents.sparkSession.sparkContext.broadcast(bits)
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_text_size(batches, "text", PIECE_BYTES):
            found = runs(cut(batch.column("text").to_pylist(), 2))
            kept = np.flatnonzero(_passes(sent.value, found.hashes[0]))
            rows = pa.array(found.text[kept])
            columns = {
                "hash": _signed(found.hashes[0][kept]),
                "more": _signed(found.hashes[1][kept]),
                "doc_id": batch.column("doc_id").take(rows),
                "text_hash": batch.column("text_hash").take(rows),
                "begin": pa.array(found.begin[kept].astype(np.int32)),
                "end": pa.array(found.end[kept].astype(np.int32)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    read = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").where("text is not null")
    return map_batches(read, run, f"hash long, more long, doc_id {id_type}, text_hash long, begin int, end int")


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans): the characters [begin, end) to remove from each document that has some."""
    folder = scratch_folder(documents.sparkSession)
    hashes = stored(_repeated_hashes(documents), "hashes", folder)
    every = stored(_occurrences(documents, _filter(hashes)), "runs", folder)
    place = F.struct("doc_id", "text_hash", "begin")
    twice = every.groupBy("hash", "more").agg(F.min(place).alias("original"), F.count("*").alias("n")).where("n > 1")
    twice = stored(twice.select("hash", "more", "original"), "twice", folder)
    again = every.join(twice, ["hash", "more"]).where(~(place.eqNullSafe(F.col("original"))))
    spans = again.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    return stored(spans, "spans", folder)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters of some spans, which may overlap."""
    kept, at = [], 0
    for begin, end in sorted(spans):
        if begin > at:
            kept.append(text[at:begin])
        at = max(at, end)
    return "".join([*kept, text[at:]])


def without_repeats(documents: DataFrame) -> DataFrame:
    """``documents`` without their repeated spans; ``n_chars``, where it is a column, follows the text.

    Null texts stay null, and a text that consists of repeats becomes empty: no
    row is dropped. Rows equal in id and text are one document and get the same
    result. Null ids are first in the order. Other columns stay as they are, whatever their names.
    """
    spans = repeated_spans(documents)
    schema = documents.schema
    whole = documents.select(F.struct(*(F.col(f"`{c}`") for c in schema.names)).alias("row"))
    on = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_hash"))
    joined = whole.join(spans, on, "left").select("row", F.col("row.text").alias("text"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_text_size(batches, "text"):
            rows, found = batch.column("row"), batch.column("spans")
            columns = dict(zip(schema.names, rows.flatten(), strict=True))
            texts = columns["text"].to_pylist()
            for row in np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False)).tolist():
                texts[row] = without_spans(texts[row], [(s["begin"], s["end"]) for s in found[row].as_py()])
            columns["text"] = pa.array(texts, columns["text"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    done = map_batches(joined, run, schema)
    if "n_chars" in schema.names:
        done = done.withColumn("n_chars", F.char_length("text").cast(schema["n_chars"].dataType))
    return done
