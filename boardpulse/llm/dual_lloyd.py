"""Codes for vectors by product quantisation, with Lloyd's rounds over two trees.

Components become integers, vectors are cut into equal parts, and each part position
has a codebook. A block of vectors holds a tree per part position, made once and
written: an order of its vectors in which every node is a range, and for each node
the box around its parts and their sum. A round puts a tree over each codebook and
walks both together: the least and the most distance between a node's box and a box of
entries rule combinations out, a node with a single entry left is assigned whole by its
cached sum, and only parts in leaves with several entries left are compared one by one.

All arithmetic is in integers, so that results do not depend on order or on how
vectors are dealt to blocks. A block with components too large for 64 bits is kept
apart and compared without trees, in Python's integers.

Between rounds a row per entry and component leaves each task; codebooks, whose
size is that of ``entries`` vectors, are all that the driver sees.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardpulse.llm.batches import map_batches
from boardpulse.llm.common import scratch_folder, stored

#: Vectors of a block, and the most parts of a tree's leaf.
BLOCK, LEAF = 4096, 8
#: Combinations of parts and entries that are compared at once.
AT_ONCE = 1 << 18
#: Bits of one piece of a large sum.
_PIECE_BITS = 40


@dataclass(frozen=True)
class Settings:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


#: By part and entry, the components.
Codebooks = list[list[tuple[int, ...]]]


def _largest(length: int) -> int:
    """Components up to which a squared distance fits in 62 bits."""
    return math.isqrt((1 << 62) // max(1, length)) // 2


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as 64-bit integers if all are small enough, else as Python's."""
    scaled = np.floor(values * float(scale))
    if not len(values) or np.abs(scaled).max() <= _largest(values.shape[1]):
        return scaled.astype(np.int64)
    exact = [[math.floor(Fraction(x) * scale) for x in row] for row in values.tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


# Trees. Node j of level l is the range [j n / 2^l, (j + 1) n / 2^l) of the order.


def _bounds(n: int, level: int) -> np.ndarray:
    return (np.arange((1 << level) + 1, dtype=np.int64) * n) >> level


def depth_for(n: int, leaf: int) -> int:
    level = 0
    while (n >> level) > leaf:
        level += 1
    return level


@dataclass
class Tree:
    """Per part position: the order, and boxes and sums of all nodes, level after level (node j of level l at 2^l - 1 + j)."""

    order: np.ndarray  # parts x n
    low: np.ndarray  # parts x nodes x width
    high: np.ndarray
    sums: np.ndarray
    depth: int


def build_tree(points: np.ndarray, leaf: int) -> Tree:
    """Trees over ``points`` (parts x n x width); a node is halved where it is widest."""
    parts, n, width = points.shape
    depth = depth_for(n, leaf)
    nodes = (2 << depth) - 1
    order = np.tile(np.arange(n), (parts, 1))
    low, high, sums = (np.empty((parts, nodes, width), np.int64) for _ in range(3))
    for level in range(depth + 1):
        bounds = _bounds(n, level)
        at = slice((1 << level) - 1, (2 << level) - 1)
        for p in range(parts):
            now = points[p][order[p]]
            low[p, at] = np.minimum.reduceat(now, bounds[:-1])
            high[p, at] = np.maximum.reduceat(now, bounds[:-1])
            sums[p, at] = np.add.reduceat(now, bounds[:-1])
            if level < depth:
                node = np.repeat(np.arange(1 << level), np.diff(bounds))
                widest = (high[p, at] - low[p, at]).argmax(axis=1)
                order[p] = order[p][np.lexsort((now[np.arange(n), widest[node]], node))]
    return Tree(order, low, high, sums, depth)


def _expanded(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges, which one each item belongs to, and the item."""
    which = np.repeat(np.arange(len(count)), count)
    ends = np.cumsum(count)
    return which, np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(first, count)


@dataclass
class Assigned:
    codes: np.ndarray  # parts x n
    sums: np.ndarray  # parts x entries x width
    counts: np.ndarray  # parts x entries
    compared: int  # combinations of a part and an entry that were compared one by one


def assign(points: np.ndarray, tree: Tree, books: np.ndarray) -> Assigned:
    """The nearest entry of each part, ties to the lower index, with sums and counts per entry, by both trees."""
    parts, n, width = points.shape
    entries = books.shape[1]
    over = build_tree(books, 1)
    codes = np.zeros((parts, n), np.int64)
    sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    part = np.arange(parts)
    node, entry = np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    level = entry_level = 0
    while True:
        a, b = (1 << level) - 1 + node, (1 << entry_level) - 1 + entry
        low, high, e_low, e_high = tree.low[part, a], tree.high[part, a], over.low[part, b], over.high[part, b]
        least = (np.maximum(0, np.maximum(e_low - high, low - e_high)) ** 2).sum(axis=1)
        most = (np.maximum(np.abs(e_high - low), np.abs(high - e_low)) ** 2).sum(axis=1)
        key = (part << level) + node
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[begin, len(key)])
        # An entry in the box with the least of the most distances is nearer than all of a box that begins beyond it.
        near = least <= np.repeat(np.minimum.reduceat(most, begin), size)
        part, node, entry = part[near], node[near], entry[near]
        key = key[near]
        if entry_level == over.depth:
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[begin, len(key)])
            e_first, e_last = _bounds(entries, entry_level)[entry], _bounds(entries, entry_level)[entry + 1]
            sure = begin[(size == 1) & (e_last[begin] - e_first[begin] == 1)]
            _assign_whole(tree, level, part[sure], node[sure], over.order[part[sure], e_first[sure]], codes, sums, counts)
            left = np.ones(len(key), bool)
            left[sure] = False
            part, node, entry = part[left], node[left], entry[left]
        if not len(part) or (level == tree.depth and entry_level == over.depth):
            break
        if level < tree.depth:
            part, node, entry = np.repeat(part, 2), np.repeat(node * 2, 2), np.repeat(entry, 2)
            node[1::2] += 1
            level += 1
        if entry_level < over.depth:
            part, node, entry = np.repeat(part, 2), np.repeat(node, 2), np.repeat(entry * 2, 2)
            entry[1::2] += 1
            entry_level += 1
        by = np.lexsort((entry, node, part))
        part, node, entry = part[by], node[by], entry[by]
    compared = _compare(points, tree, over, books, part, node, entry, codes, sums, counts) if len(part) else 0
    return Assigned(codes, sums, counts, compared)


def _assign_whole(tree: Tree, level: int, part, node, entry, codes, sums, counts) -> None:
    """Whole nodes to an entry each, by their cached sums."""
    bounds = _bounds(tree.order.shape[1], level)
    count = bounds[node + 1] - bounds[node]
    which, place = _expanded(bounds[node], count)
    codes[part[which], tree.order[part[which], place]] = entry[which]
    np.add.at(sums, (part, entry), tree.sums[part, (1 << level) - 1 + node])
    np.add.at(counts, (part, entry), count)


def _compare(points, tree: Tree, over: Tree, books, part, node, entry, codes, sums, counts) -> int:
    """Parts of uncertain leaves with the entries that are left for them, in blocks of ``AT_ONCE`` combinations."""
    n, entries = points.shape[1], books.shape[1]
    e_bounds, bounds = _bounds(entries, over.depth), _bounds(n, tree.depth)
    which, place = _expanded(e_bounds[entry], e_bounds[entry + 1] - e_bounds[entry])
    part, node, entry = part[which], node[which], over.order[part[which], place]
    by = np.lexsort((entry, node, part))
    part, node, entry = part[by], node[by], entry[by]
    leaf = (part << tree.depth) + node
    begin = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
    tried = np.diff(np.r_[begin, len(leaf)])  # entries for each leaf
    held = (bounds[1:] - bounds[:-1])[node[begin]]  # parts in it
    ends = np.cumsum(tried * held)
    at = 0
    while at < len(begin):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + AT_ONCE, side="right")))
        one = slice(at, end)
        of_leaf, spot = _expanded(bounds[node[begin[one]]], held[one])  # the parts
        p = part[begin[one]][of_leaf]
        point = tree.order[p, spot]
        of_part, choice = _expanded(begin[one][of_leaf], tried[one][of_leaf])  # the entries for each
        far = ((points[p, point][of_part] - books[p[of_part], entry[choice]]) ** 2).sum(axis=1)
        first = np.r_[0, np.cumsum(tried[one][of_leaf])[:-1]]
        nearest = np.minimum.reduceat(far, first)
        found = np.minimum.reduceat(np.where(far == nearest[of_part], choice, len(entry)), first)
        chosen = entry[found]
        codes[p, point] = chosen
        np.add.at(sums, (p, chosen), points[p, point])
        np.add.at(counts, (p, chosen), 1)
        at = end
    return int(ends[-1])


def assign_plainly(points: np.ndarray, books: np.ndarray) -> Assigned:
    """The same without trees, in integers of any size."""
    parts, n, width = points.shape
    codes = np.zeros((parts, n), np.int64)
    sums = np.zeros((parts, books.shape[1], width), object)
    counts = np.zeros((parts, books.shape[1]), np.int64)
    for p in range(parts):
        for i in range(n):
            far = [sum((int(x) - int(y)) ** 2 for x, y in zip(points[p, i], e, strict=True)) for e in books[p]]
            codes[p, i] = k = far.index(min(far))
            sums[p, k] += points[p, i]
            counts[p, k] += 1
    return Assigned(codes, sums, counts, parts * n * books.shape[1])


# Blocks as rows.

_FIELDS = "exact boolean, length int, vec_ids array<bigint>, places array<bigint>, points binary, orders binary, low binary, high binary, sums binary"


def _small(array: np.ndarray) -> bytes:
    """Integers in the fewest bytes that hold all of them; the first byte tells how many."""
    for size in (1, 2, 4, 8):
        kind = np.dtype(f"<i{size}")
        if not array.size or (array.min() >= np.iinfo(kind).min and array.max() <= np.iinfo(kind).max):
            return bytes([size]) + array.astype(kind).tobytes()
    raise ValueError("integers of more than 64 bits")


def _large(raw: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw[0]}", offset=1).astype(np.int64).reshape(shape)


def _block(ids: list, places: list, values: np.ndarray, settings: Settings, kinds: pa.Schema) -> pa.RecordBatch:
    n, length = values.shape
    components = whole(values, settings.scale)
    exact = components.dtype == np.int64
    if exact:
        points = np.ascontiguousarray(components.reshape(n, settings.parts, -1).transpose(1, 0, 2))
        tree = build_tree(points, LEAF)
        stored_tree = [_small(x) for x in (points, tree.order, tree.low, tree.high, tree.sums)]
    else:
        stored_tree = [values.astype("<f8").tobytes(), b"", b"", b"", b""]
    row = [exact, length, ids, places, *stored_tree]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, kinds, strict=True)], schema=kinds)


_KINDS = pa.schema(
    [
        ("exact", pa.bool_()),
        ("length", pa.int32()),
        ("vec_ids", pa.list_(pa.int64())),
        ("places", pa.list_(pa.int64())),
        *((n, pa.binary()) for n in ("points", "orders", "low", "high", "sums")),
    ]
)


def _write_blocks(rows: DataFrame, settings: Settings, path: str) -> DataFrame:
    """Blocks of ``rows(vec_id, place, values)``, with their trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, places, values, held = [], [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                ids += some.column("vec_id").to_pylist()
                places += some.column("place").to_pylist()
                values.append(some.column("values").flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1))
                held += some.num_rows
                if held >= BLOCK:
                    yield _block(ids, places, np.concatenate(values), settings, _KINDS)
                    ids, places, values, held = [], [], [], 0
        if held:
            yield _block(ids, places, np.concatenate(values), settings, _KINDS)

    map_batches(rows.select("vec_id", "place", "values"), run, _FIELDS).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(_FIELDS).parquet(path)


@dataclass
class Block:
    vec_ids: list
    places: list
    points: np.ndarray
    found: Assigned
    small: bool  # distances fit in 64 bits


def _assigned(batches: Iterator[pa.RecordBatch], books: Codebooks, settings: Settings) -> Iterator[Block]:
    """Each block of the batches with its assignment to the codebooks."""
    parts = settings.parts
    size = max(max(abs(c) for e in book for c in e) for book in books)
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            n, length = len(row["vec_ids"]), row["length"]
            width = length // parts
            if row["exact"]:
                points = _large(row["points"], parts, n, width)
            else:
                values = np.frombuffer(row["points"], "<f8").reshape(n, length)
                points = whole(values, settings.scale).reshape(n, parts, width).transpose(1, 0, 2)
            small = row["exact"] and size <= _largest(length)
            if small:
                nodes = (2 << depth_for(n, LEAF)) - 1
                boxes = [_large(row[k], parts, nodes, width) for k in ("low", "high", "sums")]
                tree = Tree(_large(row["orders"], parts, n), *boxes, depth_for(n, LEAF))
                found = assign(points, tree, np.array(books, dtype=np.int64).reshape(parts, -1, width))
            else:
                found = assign_plainly(points.astype(object), np.array(books, dtype=object).reshape(parts, -1, width))
            yield Block(row["vec_ids"], row["places"], points, found, small)


def _pieces(value: int) -> Iterator[tuple[int, int]]:
    """A whole number of any size as (number of the piece, signed piece)."""
    sign, value, k = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield k, sign * (value & ((1 << _PIECE_BITS) - 1))
        value, k = value >> _PIECE_BITS, k + 1


def _next_books(blocks: DataFrame, books: Codebooks, settings: Settings) -> Codebooks:
    """Each entry replaced by the floored mean of the parts that are nearest to it; unused entries stay."""
    width = len(books[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}
        for block in _assigned(batches, books, settings):
            counts = block.found.counts
            for p, e in zip(*(x.tolist() for x in np.nonzero(counts)), strict=True):
                for c, value in enumerate([*block.found.sums[p, e].tolist(), int(counts[p, e])]):
                    total[p, e, c] = total.get((p, e, c), 0) + value
        rows = [(p, e, c, k, piece) for (p, e, c), value in total.items() for k, piece in _pieces(value)]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(columns, kinds, strict=True)], ["part", "entry", "component", "piece", "value"])

    sums = map_batches(blocks, run, "part int, entry int, component int, piece int, value long")
    key = ["part", "entry", "component", "piece"]
    # Parts x entries x (width + 1) rows, times the pieces of a large number.
    rows = sums.groupBy(*key).agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    total: dict[tuple[int, int, int], int] = {}
    for r in rows:
        at = r["part"], r["entry"], r["component"]
        total[at] = total.get(at, 0) + (int(r["value"]) << (_PIECE_BITS * r["piece"]))

    def entry(p: int, e: int, old: tuple[int, ...]) -> tuple[int, ...]:
        count = total.get((p, e, width), 0)
        return tuple(total.get((p, e, c), 0) // count for c in range(width)) if count else old

    return [[entry(p, e, old) for e, old in enumerate(book)] for p, book in enumerate(books)]


def usable(column: str = "embedding"):
    """True for a vector without null or non-finite components."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.col(column).isNotNull() & finite


def first_books(rows: DataFrame, settings: Settings) -> Codebooks:
    """The parts of the vectors with the smallest ids, nulls last; of several vectors of an id, the least counts."""
    ids = rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(settings.entries)
    chosen = rows.join(F.broadcast(ids.withColumnRenamed("vec_id", "id")), F.col("vec_id").eqNullSafe(F.col("id")))  # ``entries`` ids at most
    found = chosen.groupBy("vec_id").agg(F.min("values").alias("values")).orderBy(F.col("vec_id").asc_nulls_last()).collect()
    vectors = [whole(np.array([r["values"]], dtype=float), settings.scale)[0].tolist() for r in found]
    width = len(vectors[0]) // settings.parts if vectors else 0
    return [[tuple(v[p * width : (p + 1) * width]) for v in vectors] for p in range(settings.parts)]


@dataclass
class Encoded:
    """``codes``: place, vec_id, code (two hex digits a part) and error (null beyond 64 bits). ``books``: the final entries."""

    codes: DataFrame
    books: Codebooks
    length: int


def encode(rows: DataFrame, settings: Settings, folder: str) -> Encoded:
    """Codes of ``rows(place, vec_id, values)``, vectors of one length that the number of parts divides.

    ``place`` is carried along, to join by. Fewer vectors than entries give smaller codebooks.
    """
    if not 0 < settings.entries <= 256:
        raise ValueError("codes have two hexadecimal digits a part")
    books = first_books(rows, settings)
    length = len(books[0][0]) * settings.parts if books[0] else 0
    if not length:
        none = rows.select("place", "vec_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return Encoded(none.limit(0), books, 0)
    blocks = _write_blocks(rows, settings, f"{folder}/blocks")
    for _ in range(settings.rounds):
        books = _next_books(blocks, books, settings)
    final = books

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _assigned(batches, final, settings):
            codes = block.found.codes
            n, width = codes.shape[1], block.points.shape[2]
            kind = np.int64 if block.small else object
            chosen = np.array(final, dtype=kind).reshape(len(final), -1, width)[np.arange(len(final))[:, None], codes]
            far = ((block.points.astype(kind) - chosen) ** 2).sum(axis=(0, 2)).tolist()
            errors = [e if e < 1 << 63 else None for e in far]
            digits = codes.T.astype(np.uint8).tobytes().hex()
            step = 2 * len(final)
            texts = [digits[i * step : (i + 1) * step] for i in range(n)]
            columns = [pa.array(block.places, pa.int64()), pa.array(block.vec_ids, pa.int64()), pa.array(texts), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "vec_id", "code", "error"])

    return Encoded(map_batches(blocks, run, "place long, vec_id long, code string, error long"), final, length)


def books_digest(books: Codebooks) -> str:
    """SHA-256 of all components, by part, entry and place, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()


def vector_codes(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of ``vectors(vec_id, embedding, label)``.

    Rows whose vector is null or holds a null or non-finite component are dropped. Codebooks are made
    from the vectors of the commonest length that the number of parts divides (of several, the shortest);
    a vector of another length stays with null code and errors. ``label_error`` sums the errors of a label,
    nulls being one, and is null beyond 64 bits, as ``error`` is. Repeated rows stay; other columns are ignored.
    """
    spark = vectors.sparkSession
    folder = scratch_folder(spark)
    kept = vectors.where(usable()).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("values"))
    kept = kept.withColumns({"length": F.size("values"), "place": F.monotonically_increasing_id()})
    # Labels by place are written: the place must not change between the two sides of the join below.
    kept = stored(kept, "kept", folder)
    fit = (F.col("length") > 0) & (F.col("length") % settings.parts == 0)
    common = kept.where(fit).groupBy("length").count().orderBy(F.desc("count"), "length").first()
    length = common["length"] if common else 0
    coded = encode(kept.where(F.col("length") == length), settings, folder)
    labels = kept.select(F.col("place").alias("at"), F.col("vec_id").alias("id"), "label")
    errors = stored(labels.join(coded.codes.drop("vec_id"), F.col("at") == F.col("place"), "left").select("id", "label", "code", "error"), "errors", folder)
    whole_sum = F.sum(F.col("error").cast("decimal(38,0)"))
    known = F.count_if(F.col("code").isNotNull() & F.col("error").isNull()) == 0
    sums = errors.groupBy("label").agg(F.when(known, whole_sum).try_cast("long").alias("label_error"))
    sums = stored(sums.withColumnRenamed("label", "of"), "sums", folder)
    joined = errors.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select(
        F.col("id").alias("vec_id"),
        "code",
        "error",
        F.when(F.col("code").isNotNull(), F.col("label_error")).alias("label_error"),
        F.lit(books_digest(coded.books)).alias("codebooks_sha256"),
    )
