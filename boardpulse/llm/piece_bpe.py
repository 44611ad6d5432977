"""Merge-type sentence pieces: encoding by a score-ordered agenda of adjacent pairs, and decoding.

The symbols of a text are its characters, blanks written as U+2581 and one put in
front. An agenda holds the adjacent pairs whose join is a piece; the pair with
the best score is joined first, the leftmost of equals, and its new neighbours
enter the agenda. What is no piece in the end becomes bytes.

Two characters that stand side by side in no piece never join, so a text is cut
between them (before a blank, around line ends, before most marks), and each
segment is encoded alone. The segments of an Arrow batch are cut and numbered by
array operations; each is looked up or encoded once. A Python worker keeps the
segments that it has met last. Each new segment is checked against the library;
a difference stops the job.
"""

from __future__ import annotations

import codecs
from array import array
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from boardpulse.llm.batches import by_text_size, lists, map_batches, replaced

BLANK = "▁"
#: Segments that a worker keeps, in each of two generations.
KEPT_SEGMENTS = 100_000
#: Characters of a segment whose agenda is scanned rather than kept as a heap.
SCANNED = 32
#: Rows that are decoded at once.
DECODED = 1000
#: The cost of a pair that is no piece.
NEVER = float("inf")


def _each_bad_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("piece-bytes", _each_bad_byte)


class PieceModel:
    """Pieces and scores of a model, read through the library."""

    def __init__(self, proto: bytes):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=proto)
        every = range(lib.get_piece_size())
        special = {i for i in every if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)}
        names = [lib.id_to_piece(i) for i in every]
        self.ids = {names[i]: i for i in every if i not in special}
        # A pair with a better score comes first, so scores are negated; equal ones go by place.
        self.costs = {p: -lib.get_score(i) for p, i in self.ids.items() if len(p) > 1}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.shown = [b"" if i in special else names[i].replace(BLANK, " ").encode() for i in every]
        self.shown[lib.unk_id()] = " ⁇ ".encode()
        for b, i in enumerate(self.byte_ids):
            self.shown[i] = bytes([b])
        self.control = {i for i in every if lib.is_control(i)}
        self.blank_first = {i for p, i in self.ids.items() if p[0] == BLANK}
        self.joins = self._side_by_side()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _side_by_side(self) -> np.ndarray:
        """For each two bytes, whether they stand side by side in a piece, blanks being spaces.

        Inside a character they always count as such.
        """
        joins = np.zeros((256, 256), bool)
        joins[:, 0x80:0xC0] = True
        for piece in self.costs:
            raw = np.frombuffer(piece.replace(BLANK, " ").encode(), np.uint8)
            joins[raw[:-1], raw[1:]] = True
        return joins.reshape(-1)

    def agenda(self, segment: str) -> bytes:
        """Ids of a segment, as the bytes of 32-bit integers, so that a text's ids are their join."""
        segment = segment.replace(" ", BLANK)
        parts = self._scanned(segment) if len(segment) <= SCANNED else self._popped(segment)
        out: list[int] = []
        for p in parts:
            if p:
                found = self.ids.get(p)
                if found is None:
                    out.extend(self.byte_ids[b] for b in p.encode())
                else:
                    out.append(found)
        return array("i", out).tobytes()

    def _scanned(self, segment: str) -> list[str]:
        """The agenda as a plain list in the order of the text, for short segments: the first minimum is next."""
        cost, parts = self.costs.get, list(segment)
        agenda = [cost(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while agenda and (best := min(agenda)) is not NEVER:
            at = agenda.index(best)
            parts[at] = joined = parts[at] + parts[at + 1]
            del parts[at + 1], agenda[at]
            if at < len(agenda):
                agenda[at] = cost(joined + parts[at + 1], NEVER)
            if at:
                agenda[at - 1] = cost(parts[at - 1] + joined, NEVER)
        return parts

    def _popped(self, segment: str) -> list[str]:
        """The agenda as a heap; joins leave empty parts and stale pairs behind."""
        costs, size = self.costs, len(segment)
        parts: list[str] = list(segment)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        pairs = [(costs[p], i, p) for i in range(size - 1) if (p := segment[i : i + 2]) in costs]
        heapify(pairs)
        while pairs:
            _, left, joined = heappop(pairs)
            right = after[left]
            # The pair is stale if either side has been joined with something else.
            if not parts[left] or right >= size or len(parts[left]) + len(parts[right]) != len(joined):
                continue
            parts[left], parts[right] = joined, ""
            after[left] = following = after[right]
            if following < size:
                before[following] = left
                p = joined + parts[following]
                if p in costs:
                    heappush(pairs, (costs[p], left, p))
            prior = before[left]
            if prior >= 0:
                p = parts[prior] + joined
                if p in costs:
                    heappush(pairs, (costs[p], prior, p))
        return parts

    def _checked(self, new: list[str]) -> None:
        """Compares segments with the library, behind a line end, which joins nothing."""
        skip = len(self.library.encode("\n"))
        for segment, ids in zip(new, self.library.encode(["\n" + s for s in new], num_threads=1), strict=True):
            if array("i", ids[skip:]).tobytes() != self.young[segment]:
                raise RuntimeError(f"ids differ from the library's for {segment!r}")

    def _known(self, segments: set[str], check: bool) -> dict[str, bytes]:
        """The kept segments, with all of these among them."""
        if len(self.young) > KEPT_SEGMENTS:
            self.young, self.old = {}, self.young
        young = self.young
        for segment in segments.difference(young).intersection(self.old):
            young[segment] = self.old[segment]
        new = list(segments.difference(young))
        young.update((s, self.agenda(s)) for s in new)
        if check and new:
            self._checked(new)
        return young

    def encode(self, texts: Sequence[str | None], check: bool = True) -> list[np.ndarray]:
        """Ids of each text; none for a null or empty one."""
        raws = [(" " + t.replace(BLANK, " ")).encode() if t else b"" for t in texts]
        joined = b"".join(raws)
        if not joined:
            return [np.empty(0, np.int32) for _ in texts]
        ends = np.cumsum([len(r) for r in raws])
        raw = np.frombuffer(joined, np.uint8)
        start = np.ones(len(raw), bool)
        start[1:] = ~self.joins[(raw[:-1].astype(np.uint16) << 8) | raw[1:]]
        start[ends[ends < len(raw)]] = True  # a text does not join the one before
        starts = np.flatnonzero(start)
        offsets = np.append(starts, len(raw)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined)).dictionary_encode()
        names, which = words.dictionary.to_pylist(), words.indices.to_numpy()
        known = self._known(set(names), check)
        parts = [known[n] for n in names]
        sizes = np.array([len(p) for p in parts]) // 4
        begins = np.cumsum(sizes) - sizes
        own = sizes[which]
        after = np.cumsum(own)
        ids = np.frombuffer(b"".join(parts), np.int32)[np.repeat(begins[which] - after + own, own) + np.arange(after[-1])]
        # A text ends with its last segment.
        before = np.concatenate(([0], after))[np.searchsorted(starts, ends[:-1], side="left")]
        return np.split(ids, before)

    def _text(self, raw: bytes, first: int | None) -> str:
        """The blank in front goes, and bytes that are no text become U+FFFD each."""
        return (raw[1:] if first in self.blank_first else raw).decode(errors="piece-bytes")

    def decode(self, ids: Sequence[int]) -> str:
        """The text of some ids."""
        return self._text(b"".join([self.shown[i] for i in ids]), next((i for i in ids if i not in self.control), None))

    def decode_all(self, ids: pa.ListArray) -> list[str]:
        """The texts of lists of ids; an empty one for a null."""
        pieces = pa.array(self.shown, pa.binary()).take(ids.flatten())
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        raws = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pieces), b"").to_pylist()
        flat = ids.flatten().to_numpy()
        out = []
        for raw, a, b in zip(raws, offsets, offsets[1:], strict=False):
            while a < b and int(flat[a]) in self.control:
                a += 1
            out.append(self._text(raw, int(flat[a]) if a < b else None))
        return out


_MODELS: dict[int, PieceModel] = {}


def _model(proto: bytes) -> PieceModel:
    """One model per Python worker."""
    key = hash(proto)
    if key not in _MODELS:
        _MODELS[key] = PieceModel(proto)
    return _MODELS[key]


def with_ids(frame: DataFrame, proto: bytes, text_column: str = "text", check: bool = True) -> DataFrame:
    """The frame with ``ids`` (array of int) in place of the text, which is read whole.

    Null and empty texts have no ids. Rows and other columns stay as they are.
    """
    kept = [f for f in frame.schema.fields if f.name != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(proto)
        for batch in by_text_size(batches, text_column):
            ids = model.encode(batch.column(text_column).to_pylist(), check)
            yield replaced(batch, text_column, {"ids": lists(ids, pa.int32())})

    return map_batches(frame, run, StructType([*kept, StructField("ids", ArrayType(IntegerType()))]))


def with_text(frame: DataFrame, proto: bytes, ids_column: str = "ids") -> DataFrame:
    """The frame with ``decoded``, the text of its ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(proto)
        for whole in batches:
            for at in range(0, whole.num_rows, DECODED):
                batch = whole.slice(at, DECODED)
                texts = pa.array(model.decode_all(batch.column(ids_column)), pa.string())
                columns = [batch.column(i) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*columns, texts], [*batch.schema.names, "decoded"])

    return map_batches(frame, run, StructType([*frame.schema.fields, StructField("decoded", StringType())]))


def round_trip(frame: DataFrame, proto: bytes, text_column: str = "text", check: bool = True) -> DataFrame:
    """The frame with ``ids`` and ``decoded`` in place of the text, as by :func:`with_ids` and
    :func:`with_text`, in one pass, so that each task needs one Python worker."""
    kept = [f for f in frame.schema.fields if f.name != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(proto)
        for batch in by_text_size(batches, text_column):
            ids = lists(model.encode(batch.column(text_column).to_pylist(), check), pa.int32())
            yield replaced(batch, text_column, {"ids": ids, "decoded": pa.array(model.decode_all(ids), pa.string())})

    schema = [*kept, StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]
    return map_batches(frame, run, StructType(schema))
