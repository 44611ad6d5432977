"""SimHash near-duplicates, found by a hierarchical index in Gray order.

1. A fingerprint per text, in Arrow batches: a bit is set if it is set in more
   than half of the hashes of the word shingles.
2. Equal fingerprints become one class by a grouped minimum.
3. The 64 bits are cut into ``max_diff + 2`` blocks. Two fingerprints with at
   most ``max_diff`` differing bits agree in two blocks at least, so for each
   pair of blocks one copy of the fingerprint, with that pair moved to the top,
   is sorted by its Gray rank over the whole cluster (a range exchange). Equal
   block pairs then stand together, and large groups are cut by rank into even
   partitions, whatever their size.
4. Each partition is read as pages of consecutive fingerprints. A page is an
   index of two levels: nodes with the bits that all their fingerprints share
   and a mask of those bits. Pairs of nodes that differ in too many shared bits
   are dropped with all they hold; the rest is compared bit by bit.
5. A group that goes over a page's end leaves a fragment, itself a node. Joined
   fragments of a group are pruned by their masks, then compared.
6. Links of a page go out as a star per connected set, so that a group of n
   copies gives fewer than n links. Connected components make the classes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from boardpulse.llm.batches import map_batches
from boardpulse.llm.common import matched, scratch_folder, stored
from boardpulse.llm.components import connected_components

BITS = 64
#: Fingerprints of a page, and of a node in it.
PAGE, NODE = 2048, 32
#: Hashes that are counted at once.
HASHES_AT_ONCE = 1 << 18
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of the text's shingles, repeats included; a shorter text is one shingle."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined, width = b" ".join(parts), min(words, len(parts))
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate(([0], ends[:-1]))
    spans = zip(starts[: len(parts) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans), np.uint64)


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """One fingerprint for each array of hashes; zero for an empty one."""
    out = np.zeros(len(hashes), np.uint64)
    sizes = np.array([len(h) for h in hashes], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    every = np.concatenate([hashes[i] for i in full])
    ends = np.cumsum(sizes[full])
    # Eight counters of a byte stand in one number, so at most 255 hashes are added up at a time.
    blocks = [np.arange(end - size, end, 255) for end, size in zip(ends, sizes[full], strict=True)]
    firsts = np.concatenate(([0], np.cumsum([len(b) for b in blocks])[:-1]))
    at = np.concatenate(blocks)
    for bit in range(8):
        sums = np.add.reduceat((every >> np.uint64(bit)) & _LANES, at).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(sums.astype(np.int64), firsts, axis=0)
        over = (2 * counts > sizes[full][:, None]).astype(np.uint64)
        for byte in range(8):
            out[full] |= over[:, byte] << np.uint64(8 * byte + bit)
    return out


def fingerprints(texts: Iterable[str | None], words: int) -> np.ndarray:
    """Fingerprints of the texts, which are read whole."""
    done, held, size = [], [], 0
    for text in texts:
        held.append(shingle_hashes(text, words))
        size += len(held[-1])
        if size > HASHES_AT_ONCE:
            done.append(majority_bits(held))
            held, size = [], 0
    return np.concatenate([*done, majority_bits(held)])


def with_fingerprints(frame: DataFrame, text_column: str, words: int) -> DataFrame:
    """The frame with ``fp`` in place of the text column."""
    kept = [f for f in frame.schema.fields if f.name != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            prints = fingerprints((s.as_py() for s in batch.column(at)), words)
            rest = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(prints.view(np.int64))], [*names, "fp"])

    return map_batches(frame, run, StructType([*kept, StructField("fp", LongType())]))


def _blocks(max_diff: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each block."""
    edges = [BITS * i // (max_diff + 2) for i in range(max_diff + 3)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _top_first(fp: np.ndarray, blocks: list[tuple[int, int]], first: tuple[int, int]) -> np.ndarray:
    """The fingerprints with two of their blocks moved to the top."""
    out, free = np.zeros_like(fp), BITS
    for i in [*first, *(i for i in range(len(blocks)) if i not in first)]:
        low, width = blocks[i]
        free -= width
        out |= ((fp >> np.uint64(low)) & np.uint64((1 << width) - 1)) << np.uint64(free)
    return out


def gray_rank(code: np.ndarray) -> np.ndarray:
    """The place of a code word in the Gray sequence: each bit xor all above it."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code ^ (code >> np.uint64(step))
    return code


def _ranked(max_diff: int):
    blocks = _blocks(max_diff)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for combo, pair in enumerate(combinations(range(len(blocks)), 2)):
                rank = gray_rank(_top_first(fp, blocks, pair))
                columns = [np.full(len(fp), combo, np.int32), rank.view(np.int64), fp.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["combo", "rank", "fp"])

    return run


def shared_bits(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask, pattern) for each run of codes: the bits that all of the run agree in."""
    every, some = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    mask = ~(every ^ some)
    return mask, every & mask


def close_pairs(left: np.ndarray, right: np.ndarray, max_diff: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) with left[i] and right[j] at most ``max_diff`` bits apart.

    Nodes of consecutive codes are compared first, in the bits that all codes of
    either node share; what differs there differs in all their pairs.
    """
    at_l, at_r = np.arange(0, len(left), NODE), np.arange(0, len(right), NODE)
    mask_l, pattern_l = shared_bits(left, at_l)
    mask_r, pattern_r = shared_bits(right, at_r)
    apart = np.bitwise_count((pattern_l[:, None] ^ pattern_r[None, :]) & mask_l[:, None] & mask_r[None, :])
    found_l, found_r = [], []
    for a, row in enumerate(apart <= max_diff):
        if not row.any():
            continue
        own = left[at_l[a] : at_l[a] + NODE]
        places = np.flatnonzero(np.repeat(row, NODE)[: len(right)])
        i, j = np.nonzero(np.bitwise_count(own[:, None] ^ right[places][None, :]) <= max_diff)
        found_l.append(i + at_l[a])
        found_r.append(places[j])
    if not found_l:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_l), np.concatenate(found_r)


def star_links(codes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Pairs of places as stars: (member, root) of each connected set, flat."""
    label = np.arange(len(codes))
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, label[i], low)
        np.minimum.at(after, label[j], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = np.flatnonzero(label != np.arange(len(codes)))
    return np.stack([codes[moved], codes[label[moved]]], axis=1).reshape(-1)


_PAGES = StructType(
    [
        StructField("combo", IntegerType()),
        StructField("bucket", LongType()),
        StructField("place", LongType()),
        StructField("mask", LongType()),
        StructField("pattern", LongType()),
        StructField("codes", ArrayType(LongType())),
        StructField("near", ArrayType(LongType())),
    ]
)


def _page_rows(combo: int, key: np.uint64, codes: np.ndarray, ranks: np.ndarray, max_diff: int) -> Iterator[dict]:
    """The links of a page, and the groups that may go on before or after it."""
    i, j = close_pairs(codes, codes, max_diff)
    near = star_links(codes, i, j)
    groups = codes & key
    first, last = groups == groups[0], groups == groups[-1]
    for k, here in enumerate([first] if first[-1] else [first, last]):
        own = codes[here]
        mask, pattern = shared_bits(own, np.array([0]))
        yield {
            "combo": combo,
            "bucket": int(groups[here][0].astype(np.int64)),
            "place": int(ranks[here][0]),
            "mask": int(mask.astype(np.int64)[0]),
            "pattern": int(pattern.astype(np.int64)[0]),
            "codes": own.view(np.int64),
            "near": near.view(np.int64) if k == 0 else near[:0].view(np.int64),
        }


def _pages(keys: list[int], max_diff: int):
    masks = np.array(keys, np.uint64)

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        kinds = {f.name: pa.int32() if f.name == "combo" else pa.list_(pa.int64()) if f.name in ("codes", "near") else pa.int64() for f in _PAGES}
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kind) for n, kind in kinds.items()], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, np.int64)] * 3
        rows: list[dict] = []
        for batch in _with_end(batches):
            if batch is not None:
                new = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("combo", "rank", "fp")]
                held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            at, size = 0, len(held[0])
            while at < size and (batch is None or size - at > PAGE):
                end = min(at + PAGE, size)
                combo = held[0][at]
                if held[0][end - 1] != combo:  # a page holds one order only
                    end = at + int(np.searchsorted(held[0][at:end], combo, side="right"))
                rows += _page_rows(int(combo), masks[combo], held[2][at:end].view(np.uint64), held[1][at:end], max_diff)
                at = end
                if len(rows) >= 64:
                    yield batch_of(rows)
                    rows = []
            held = [x[at:].copy() for x in held]
        if rows:
            yield batch_of(rows)

    return run


def _with_end(items: Iterable) -> Iterator:
    yield from items
    yield None


def _between(max_diff: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for left, right in zip(batch.column("codes"), batch.column("others"), strict=True):
                a = left.values.to_numpy().view(np.uint64)
                b = right.values.to_numpy().view(np.uint64)
                i, j = close_pairs(a, b, max_diff)
                out.append(star_links(np.concatenate([a, b]), i, j + len(a)).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], ["near"])

    return run


def gray_links(prints: DataFrame, max_diff: int) -> DataFrame:
    """Links (a, b) that connect what ``max_diff`` differing bits connect.

    ``prints(fp)`` has each fingerprint once. Pairs are not listed one by one: a
    linked set of a page is given as a star.
    """
    blocks = _blocks(max_diff)
    keys = [sum(((1 << blocks[i][1]) - 1) << blocks[i][0] for i in pair) for pair in combinations(range(len(blocks)), 2)]
    ranked = map_batches(prints.select("fp"), _ranked(max_diff), "combo int, rank long, fp long")
    ordered = ranked.repartitionByRange("combo", "rank").sortWithinPartitions("combo", "rank")
    pages = stored(map_batches(ordered, _pages(keys, max_diff), _PAGES), "pages")
    right = pages.select(
        "combo", "bucket", *(F.col(c).alias(f"{c}2") for c in ("place", "mask", "pattern")), F.col("codes").alias("others")
    )
    met = (
        pages.join(right, ["combo", "bucket"])
        .where("place < place2 and bit_count((pattern ^ pattern2) & mask & mask2) <= " + str(max_diff))
        .select("codes", "others")
    )
    between = map_batches(met, _between(max_diff), "near array<long>")
    flat = pages.select("near").union(between).where(F.size("near") > 0)
    steps = F.transform(
        F.sequence(F.lit(0), F.size("near") - 1, F.lit(2)),
        lambda k: F.struct(F.get("near", k).alias("a"), F.get("near", k + 1).alias("b")),
    )
    return flat.select(F.inline(steps)).distinct()


def near_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4, max_diff: int = 4) -> DataFrame:
    """(doc id, text_hash, fp, root, component_id), a row for each row of ``docs``.

    ``root`` names the class by a fingerprint; ``component_id`` is the smallest
    id in it. Null and blank texts have fingerprint zero and are linked like any
    other. Null ids are kept and never the smallest; a class of null ids only has
    a null ``component_id``. Repeated rows stay, each with its class; extra
    columns are ignored; an empty table gives an empty table.
    """
    folder = scratch_folder(docs.sparkSession)
    read = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    prints = stored(with_fingerprints(read, "text", words), "prints", folder)
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes", folder)
    roots = stored(connected_components(gray_links(classes.select("fp"), max_diff)), "roots", folder)
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.where("root is not null").groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(rooted.select("fp", "root").join(least, "root"), "named", folder)
    return prints.join(named.select("fp", "root", "component_id"), "fp")


def fingerprint_text(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4, max_diff: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate class, its columns as they were.

    The row with the smallest id stays, ties by the hash of its text; rows equal in
    both are repeated rows, of which any one stays.
    """
    classes = near_classes(docs, id_column, text_column, words, max_diff)
    folder = scratch_folder(docs.sparkSession)
    rows = stored(classes.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n")), "rows", folder)
    # Written, so that the join below reads plain exchanges, whose large keys can be split.
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best"))
    best = stored(best, "best", folder)
    judged = rows.join(best, "root").select(
        "doc_id",
        "text_hash",
        "n",
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))).alias("stays"),
    )
    judged = stored(judged.where("not stays or n > 1"), "judged", folder)
    again = matched(docs, judged.where("stays"), "left_semi", id_column, text_column)
    others = matched(docs, judged, "left_anti", id_column, text_column)
    return others.unionByName(again.dropDuplicates([id_column, text_column]))
