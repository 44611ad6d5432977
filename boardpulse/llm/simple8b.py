"""Token ids as binary blocks: Simple-8b words with escapes, decoded by array operations.

A 64-bit word holds a selector of 4 bits and as many ids of one width as fit in
60 bits. Ids that need more than 20 bits are escaped: their place holds 20 ones,
and the id follows in the block's list of escapes. A block is a row of the
written table: ids of consecutive documents, where each begins, and the number of
ids in the shard before the block. Shards are ranges of ascending document ids.

Files are written by Spark as Parquet with the blocks as binary columns, so
they lie in any store, and a lost task leaves no half file.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from boardpulse.llm.batches import by_text_size, map_batches
from boardpulse.llm.common import scratch_folder, stored

#: Ids per word and bits per id, by selector. Fixed values of the format.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20)
#: What a place holds whose id is escaped.
ESCAPED = (1 << 20) - 1
#: A block ends with the document that makes it this long.
BLOCK_IDS = 1 << 16


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of some ids; the last word is filled up with zeros."""
    ids = ids.astype(np.uint64)
    large = ids >= ESCAPED
    values = np.where(large, np.uint64(ESCAPED), ids)
    size = len(values)
    bits = np.zeros(size + 2 * COUNTS[0], np.uint8)  # zeros after the end fill the last word
    bits[:size] = np.frexp(values.astype(np.float64))[1]
    # The most bits among the next values, for longer and longer runs of them.
    most, run = np.maximum(bits[:-1], bits[1:]), 2
    chosen = np.zeros(size, np.uint8)
    for selector in range(len(COUNTS) - 1, -1, -1):
        more = COUNTS[selector] - run
        most, run = np.maximum(most[: len(most) - more], most[more:]), COUNTS[selector]
        fits = most[:size] <= WIDTHS[selector]
        if not fits.any():
            break  # nor do longer runs of narrower values fit
        np.copyto(chosen, selector, where=fits)
    steps = np.array(COUNTS)[chosen]
    hops, starts, at = steps.tolist(), [], 0
    while at < size:
        starts.append(at)
        at += hops[at]
    starts_of = np.array(starts, np.int64)
    selectors = chosen[starts_of].astype(np.int64)
    words = selectors.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(240, np.uint64)])
    for selector in np.unique(selectors):
        here, width = np.flatnonzero(selectors == selector), WIDTHS[selector]
        own, at = words[here], starts_of[here]
        for k in range(COUNTS[selector] if width else 0):
            own |= padded[at + k] << np.uint64(width * k)
        words[here] = own
    return words, ids[large]


def unpack(words: np.ndarray, escapes: np.ndarray, size: int) -> np.ndarray:
    """The ids of a block."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(np.array(COUNTS)[selectors])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for selector in np.unique(selectors):
        count, width = COUNTS[selector], WIDTHS[selector]
        if width:
            here = selectors == selector
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(width)
            at = (ends[here] - count)[:, None] + np.arange(count)
            out[at] = (words[here][:, None] >> shifts) & np.uint64((1 << width) - 1)
    out = out[:size]
    out[out == ESCAPED] = escapes
    return out


#: A text of these characters alone is cut by array operations into the words of the tokenizer's own pattern.
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ɏ]*")
#: Another text is cut where a blank stands before one of these: a word starts there in any case.
_STARTS = "!-~À-ɏ"
_SEGMENTS = re.compile(rf"(?:\A[^ ]+| [{_STARTS}][^ ]*)(?: (?![{_STARTS}])[^ ]*)*|\A(?: (?![{_STARTS}])[^ ]*)+")
#: Kinds of bytes in plain texts: end of a text, white space, letter, digit, other.
_KINDS = np.array([0 if c == 0 else 1 if c in b"\t\n\r " else 3 if 48 <= c < 58 else 2 if c > 127 or chr(c).isalpha() else 4 for c in range(256)], np.uint8)
#: A worker that keeps the ids of more segments than this goes on with those of the texts at hand.
KEPT_SEGMENTS = 400_000


def word_starts(raw: np.ndarray) -> np.ndarray:
    """Where the tokenizer's words start in plain texts that each end with a zero byte; the zero bytes are words too."""
    kind = _KINDS[raw]
    start = np.ones(len(raw), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 0)
    # The last of the white space before a word stands alone, or is the word's first character if it is a blank.
    last = np.flatnonzero((kind[:-1] == 1) & (kind[1:] > 1))
    start[last] = True
    start[last[raw[last] == 32] + 1] = False
    quotes = np.flatnonzero(raw == 39)
    quotes = quotes[start[quotes]]
    one, two = raw[quotes + 1], raw[np.minimum(quotes + 2, len(raw) - 1)]
    short = quotes[np.isin(one, np.frombuffer(b"stmd", np.uint8))]
    r, v, ell, e = b"rvle"
    long = quotes[((one == r) & (two == e)) | ((one == v) & (two == e)) | ((one == ell) & (two == ell))]
    for at, size in ((short, 2), (long, 3)):
        start[at + 1] = False
        start[at + size] = True
    return np.flatnonzero(start)


class SegmentEncoder:
    """Ids of whole texts by the tokenizers library, which is asked once for each segment kept.

    The ids of all kept segments lie in one array, so that those of a text's segments are gathered
    by array operations. A segment's number is its place there; 0 is the end of a text, named None.
    """

    def __init__(self, spec: bytes, end_id: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core already
        self.tokenizer = Tokenizer.from_buffer(spec)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = list(added.values())
        # A token of the vocabulary has a character for each byte.
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(token) for token in vocabulary]
        for i, content in added.items():
            self.bytes_of[i] = len(content.encode())
        self.numbers: dict[str | None, int] = {None: 0}
        self.ids, self.ends = np.array([end_id], np.uint32), np.array([1])

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some segments one after the other, and where each one's end."""
        sizes = np.diff(self.ends, prepend=0)[numbers]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.ends[numbers] - ends, sizes) + np.arange(ends[-1])], ends

    def _asked(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :func:`_gathered`, from the library. Each segment is a word of its own, so none joins another."""
        found = self.tokenizer.encode_batch_fast([segments], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(found.ids, np.uint32)
        read = np.cumsum(self.bytes_of[ids])
        wanted = np.cumsum(pc.binary_length(pa.array(segments, pa.large_string())).to_numpy())
        ends = np.searchsorted(read, wanted, side="right")
        if not ends.all() or not np.array_equal(read[ends - 1], wanted) or ends[-1] != len(ids):
            raise RuntimeError("the ids of the tokenizer do not hold the bytes of its words")
        return ids, ends

    def _numbered(self, segments: list[str | None]) -> np.ndarray:
        """Numbers of different segments; those not kept yet are added."""
        if len(self.numbers) > KEPT_SEGMENTS:
            kept = [None, *(s for s in segments if s is not None and s in self.numbers)]
            self.ids, self.ends = self._gathered(np.array([self.numbers[s] for s in kept]))
            self.numbers = {s: n for n, s in enumerate(kept)}
        known = self.numbers.get
        found = np.array([known(s, -1) for s in segments])
        gaps = np.flatnonzero(found < 0)
        if len(gaps):
            missing, new = [segments[i] for i in gaps.tolist()], range(len(self.numbers), len(self.numbers) + len(gaps))
            ids, ends = self._asked(missing)
            self.numbers.update(zip(missing, new, strict=True))
            self.ends = np.concatenate([self.ends, ends + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
            found[gaps] = new
        return found

    def _texts(self, numbers: np.ndarray) -> list[np.ndarray]:
        """Ids of texts that are given by their segments, the last of each being the end."""
        ids, ends = self._gathered(numbers)
        return np.split(ids, ends[numbers == 0][:-1])

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        raw = "\0".join([*texts, ""]).encode()
        starts = word_starts(np.frombuffer(raw, np.uint8))
        offsets = np.append(starts, len(raw)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        names = words.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist
        names[names.index("\0")] = None
        return self._texts(self._numbered(names)[words.indices.to_numpy()])

    def _other(self, texts: list[str]) -> list[np.ndarray]:
        cut = [s for t in texts for s in (*_SEGMENTS.findall(t), None)]
        names = list(dict.fromkeys(cut))
        number = dict(zip(names, self._numbered(names).tolist(), strict=True))
        return self._texts(np.array([number[s] for s in cut]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with the end id."""
        plain = [bool(_PLAIN.fullmatch(t)) and not any(x in t for x in self.special) for t in texts]
        of_kind = [iter(use([t for p, t in zip(plain, texts, strict=True) if p == k]) if k in plain else []) for k, use in ((False, self._other), (True, self._plain))]
        return [next(of_kind[p]) for p in plain]


_ENCODERS: dict[int, SegmentEncoder] = {}


def _encoder(spec: bytes, end_id: int) -> SegmentEncoder:
    """One per Python worker."""
    key = hash((spec, end_id))
    if key not in _ENCODERS:
        _ENCODERS[key] = SegmentEncoder(spec, end_id)
    return _ENCODERS[key]


_BLOCK = "shard int, block int, start long, n_ids long, doc_ids array<bigint>, begins array<bigint>, words binary, escapes binary"


def _block(shard: int, block: int, start: int, docs: list[int | None], ids: list[np.ndarray]) -> pa.RecordBatch:
    every = np.concatenate(ids)
    words, escapes = pack(every)
    begins = np.cumsum([0, *(len(x) for x in ids[:-1])])
    values = {
        "shard": pa.array([shard], pa.int32()),
        "block": pa.array([block], pa.int32()),
        "start": pa.array([start], pa.int64()),
        "n_ids": pa.array([len(every)], pa.int64()),
        "doc_ids": pa.array([docs], pa.list_(pa.int64())),
        "begins": pa.array([begins.tolist()], pa.list_(pa.int64())),
        "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
        "escapes": pa.array([escapes.astype("<u8").tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(values.values()), list(values))


def write_ids(documents: DataFrame, spec: bytes, path: str, end_id: int = 0) -> None:
    """Writes the ids of all whole texts, in ascending ``doc_id`` order, as blocks below ``path``.

    ``spec`` is the tokenizer's file. Each document ends with ``end_id``; a null
    or empty text has that alone. Null ids come first; rows of equal id go by a
    hash of their text. Other columns are ignored.
    """
    ordered = (
        documents.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(spec, end_id), TaskContext.get().partitionId()
        docs, ids, size, start, block = [], [], 0, 0, 0
        for batch in by_text_size(batches, "text"):
            found = encoder.encode(batch.column("text").to_pylist())
            for doc, one in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                docs.append(doc)
                ids.append(one)
                size += len(one)
                if size >= BLOCK_IDS:
                    yield _block(shard, block, start, docs, ids)
                    docs, ids, size, start, block = [], [], 0, start + size, block + 1
        if docs:
            yield _block(shard, block, start, docs, ids)

    map_batches(ordered, run, _BLOCK).write.mode("overwrite").parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, pa.Array], np.ndarray, np.ndarray]]:
    """For each block: columns that name its documents, where each begins (and the last ends), and all ids."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            ids = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["escapes"], "<u8"), row["n_ids"])
            bounds, count = np.array([*row["begins"], len(ids)]), len(row["doc_ids"])
            columns = {
                "shard": pa.array(np.full(count, row["shard"], np.int32)),
                "block": pa.array(np.full(count, row["block"], np.int32)),
                "place": pa.array(np.arange(count, dtype=np.int32)),
                "start": pa.array(bounds[:-1] + row["start"]),
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
            }
            yield columns, bounds, ids


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, place, start in the shard, doc_id, ids) of the written documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, bounds, ids in _decoded(batches):
            columns["ids"] = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    blocks = spark.read.schema(_BLOCK).parquet(path)
    return map_batches(blocks, run, "shard int, block int, place int, start long, doc_id long, ids array<bigint>")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_ids`, with the number of ids and the CRC-32 of their bytes (32 bits each) in place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, bounds, ids in _decoded(batches):
            raw = memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds.tolist(), bounds.tolist()[1:], strict=False)]
            columns |= {"n_tokens": pa.array(np.diff(bounds)), "ids_crc32": pa.array(sums, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    blocks = spark.read.schema(_BLOCK).parquet(path)
    return map_batches(blocks, run, "shard int, block int, place int, start long, doc_id long, n_tokens long, ids_crc32 long")


def id_digests(documents: DataFrame, spec: bytes, end_id: int = 0) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files written and read back."""
    spark = documents.sparkSession
    folder = scratch_folder(spark)
    write_ids(documents, spec, f"{folder}/ids", end_id)
    # A row per shard: their number is that of the partitions, not of the documents.
    totals = spark.read.parquet(f"{folder}/ids").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases", folder)
    found = read_checksums(spark, f"{folder}/ids").join(bases, "shard")
    return found.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
