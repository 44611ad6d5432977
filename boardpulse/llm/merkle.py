"""Merkle manifest of a dataset: a tree per language, and one over their roots, by time-forward processing.

Nodes are labelled (tree, level, place) and handled in that order. A handled node
sends its digest to its parent, where it waits in a priority queue ordered by label:
Spark's sorted exchange between rounds, a heap for the few levels inside a round. A
round climbs a few levels in chunks of neighbouring nodes, so a
tree of any size, and one with all rows, is many small tasks; the rounds are as many
as the logarithm of the rows. A reversed sweep then goes down the same rounds: each
chunk gets the proof of its top node as one message, sorted before its nodes, and
sends longer ones down, until the leaves have the siblings all the way up.

Digests are SHA-256; a node is that of its children's hexadecimal digests. The order
of leaves is (tree, doc_id, digest), nulls first, so that repeated rows are leaves of
their own whose order changes nothing.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardpulse.llm.batches import map_batches
from boardpulse.llm.common import lower_ascii, scratch_folder, stored

FAN = 8
#: Levels of a round, if not said otherwise; a chunk of 8 ** 4 nodes takes about a megabyte.
LEVELS = 4
#: The tree over the roots of the others.
TOP = -1


def row_digest(*columns: Column) -> Column:
    """Digest of a row: each value with its length in bytes before it, so that no two rows run together."""
    texts = [c.cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def depth(leaves: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def _last_round(leaves: int, levels: int = LEVELS) -> int:
    return max(0, -(-depth(leaves) // levels) - 1)


def sweep(digests: list[bytes], levels: int) -> list[list[bytes]]:
    """Nodes of all levels above neighbours that start at a multiple of the chunk, in hexadecimal.

    Messages to a parent wait in a queue in the order of labels.
    """
    nodes = [digests, *([] for _ in range(levels))]
    queue = [(1, at // FAN, at, digest) for at, digest in enumerate(digests)] if levels else []
    while queue:
        level, place = queue[0][:2]
        node = hashlib.sha256()
        while queue and queue[0][:2] == (level, place):
            node.update(heapq.heappop(queue)[3])
        digest = node.hexdigest().encode()
        nodes[level].append(digest)
        if level < levels:
            heapq.heappush(queue, (level + 1, place // FAN, place, digest))
    return nodes


class Step(NamedTuple):
    """One level of a proof: the place in the run, and the siblings' digests from left to right."""

    place: int
    siblings: list[bytes]


def step_of(nodes: list[bytes], place: int) -> Step:
    first = place - place % FAN
    run = nodes[first : first + FAN]
    return Step(place - first, run[: place - first] + run[place - first + 1 :])


def fold(digest: bytes, proof: list[Step]) -> bytes:
    """The root that a digest and its proof give."""
    for place, siblings in proof:
        digest = hashlib.sha256(b"".join([*siblings[:place], digest, *siblings[place:]])).hexdigest().encode()
    return digest


def pack_proof(proof: list[Step]) -> bytes:
    """Per level a byte for the place, one for the number of siblings, and 32 for each of them."""
    return b"".join(bytes([s.place, len(s.siblings)]) + bytes.fromhex(b"".join(s.siblings).decode()) for s in proof)


def unpack_proof(packed: bytes) -> list[Step]:
    proof, at = [], 0
    while at < len(packed):
        place, count = packed[at], packed[at + 1]
        end = at + 2 + 32 * count
        proof.append(Step(place, [packed[i : i + 32].hex().encode() for i in range(at + 2, end, 32)]))
        at = end
    return proof


@dataclass(frozen=True)
class Chunk:
    """Neighbouring nodes of one round, the message with the proof of their top, and the columns that leaves carry."""

    tree: int
    at: int
    leaves: int
    digests: list[bytes]
    proof: list[Step] | None
    carried: dict[str, list]


def _chunks(batches: Iterator[pa.RecordBatch], carried: tuple[str, ...]) -> Iterator[Chunk]:
    """Chunks of rows that come ordered by (tree, chunk, place); a message has the place -1."""

    def rows() -> Iterator[tuple]:
        names = ("tree", "chunk", "leaves", "place", "digest", "proof", *carried)
        for batch in batches:
            yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)

    for (tree, at), group in groupby(rows(), key=lambda r: r[:2]):
        proof, nodes = None, []
        for row in group:
            if row[3] < 0:
                proof = unpack_proof(row[5])
            else:
                nodes.append(row)
        digests = [r[4].hex().encode() for r in nodes]
        yield Chunk(tree, at, nodes[0][2], digests, proof, {n: [r[6 + k] for r in nodes] for k, n in enumerate(carried)})


def _by_chunk(nodes: DataFrame, levels: int, proofs: DataFrame | None = None) -> DataFrame:
    """Nodes of a round, and the messages to their chunks, in the order of labels; chunks go to tasks by their hash."""
    chunk = F.expr(f"place div {FAN**levels}")
    rows = nodes.withColumns({"chunk": chunk, "proof": F.lit(None).cast("binary")})
    if proofs is not None:
        sent = proofs.select("tree", "leaves", F.lit(-1).cast("long").alias("place"), F.col("place").alias("chunk"), "proof")
        rows = rows.unionByName(sent, allowMissingColumns=True)
    return rows.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "place")


_NODES = "tree long, leaves long, place long, digest binary"
_PROOFS = "tree long, leaves long, place long, proof binary"


def _climb(chunk: Chunk, turn: int, levels: int) -> list[list[bytes]]:
    return sweep(chunk.digests, min(levels, depth(chunk.leaves) - levels * turn))


def _climbed(nodes: DataFrame, turn: int, levels: int) -> DataFrame:
    """The top node of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunks(batches, ()):
            (top,) = _climb(c, turn, levels)[-1]
            values = [[c.tree], [c.leaves], [c.at], [bytes.fromhex(top.decode())]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                ["tree", "leaves", "place", "digest"],
            )

    return map_batches(_by_chunk(nodes.select("tree", "leaves", "place", "digest"), levels), run, _NODES)


# Makes a row of a node: its chunk, its place in it and in its tree, and its whole proof.
Emit = Callable[[Chunk, int, int, list[Step]], tuple]


def _descended(
    nodes: DataFrame, proofs: DataFrame, turn: int, levels: int, emit: Emit, schema: str, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Rows that ``emit`` makes of the nodes of a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _arrow(schema)
        for c in _chunks(batches, carried):
            nodes_of = _climb(c, turn, levels)
            rows = []
            for place in range(len(c.digests)):
                inner = [step_of(nodes_of[k], place // FAN**k) for k in range(len(nodes_of) - 1)]
                rows.append(emit(c, place, c.at * FAN**levels + place, inner + c.proof))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, kinds, strict=True)], schema=kinds)

    return map_batches(_by_chunk(nodes, levels, proofs), run, schema)


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([pa.field(n, _KINDS[t]) for n, t in (field.split() for field in schema.split(", "))])


class Manifest(NamedTuple):
    """Written tables of the trees.

    ``leaves``: tree, leaves (of the tree), place, digest and the carried columns. ``trees``: tree, its
    name, its number of leaves and its root. ``rounds`` and ``top_rounds`` have the nodes from which
    each round of ``levels`` levels started; ``root`` is the digest above all trees, null without rows.
    """

    leaves: DataFrame
    trees: DataFrame
    rounds: list[DataFrame]
    top_rounds: list[DataFrame]
    root: str | None
    levels: int
    folder: str


def _numbered(rows: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Leaves with the number of their tree and their place in it, and (tree, name, leaves).

    The order is one of ranges, so that a tree with most of the rows is spread like the others;
    equal rows are dealt by where they were read. What is counted in windows is a row per range.
    """
    dealt = rows.withColumn("tie", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("name", "doc_id", "digest", "tie")]
    ranged = dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    ranged = stored(ranged.withColumns({"shard": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "ranged", folder)
    parts = ranged.groupBy("shard", "name").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    parts = stored(parts, "parts", folder)
    trees = parts.groupBy("name").agg(F.min("shard").alias("shard"), F.sum("n").alias("leaves"))
    trees = trees.withColumn("in_shard", F.row_number().over(Window.partitionBy("shard").orderBy(F.col("name").asc_nulls_first())))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = trees.groupBy("shard").agg(F.count("*").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    trees = trees.join(begins, "shard").select((F.col("begin") + F.col("in_shard") - 1).alias("tree"), "name", "leaves")
    trees = stored(trees, "trees", folder)
    earlier = Window.partitionBy("name").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    named = trees.withColumnRenamed("name", "tree_name")
    bases = bases.join(named, F.col("name").eqNullSafe(F.col("tree_name"))).select("shard", F.col("name").alias("of"), "tree", "leaves", "base")
    bases = stored(bases, "bases", folder).withColumnRenamed("shard", "in_shard")
    # Rows of one shard and tree are part of one range, so no key is large.
    placed = ranged.join(bases, (F.col("shard") == F.col("in_shard")) & F.col("name").eqNullSafe(F.col("of")))
    placed = placed.withColumn("place", F.col("base") + F.col("at")).drop("shard", "at", "in_shard", "of", "base", "name")
    return stored(placed, "leaves", folder), trees


def _rounds(nodes: DataFrame, most: int, levels: int, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """Nodes from which each round starts, and (tree, leaves, digest) of the roots."""
    rounds, roots = [], None
    last = _round_of(F.col("leaves"), levels)
    for turn in range(_last_round(most, levels) + 1):
        rounds.append(nodes)
        tops = stored(_climbed(nodes, turn, levels), f"tops-{turn}", folder)
        ended = tops.where(last == turn).select("tree", "leaves", "digest")
        roots = ended if roots is None else roots.union(ended)
        nodes = tops.where(last > turn)
    return rounds, roots


def _round_of(leaves: Column, levels: int) -> Column:
    """The last round of a tree, as ``_last_round`` has it."""
    sizes = [FAN ** (levels * turn) for turn in range(1, 21 // levels + 1)]
    return sum(((leaves > F.lit(n)).cast("int") for n in sizes if n < 1 << 63), F.lit(0))


def build(rows: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of ``rows(name, doc_id, digest, ...)``: a tree per name, nulls being one; other columns are carried.

    Without rows there are no trees and no root.
    """
    folder = scratch_folder(rows.sparkSession)
    leaves, trees = _numbered(rows, folder)
    sizes = trees.agg(F.max("leaves"), F.count("*")).first()
    if not sizes[1]:
        return Manifest(leaves, trees.withColumn("root", F.lit(None).cast("binary")), [], [], None, levels, folder)
    nodes = leaves.select("tree", "leaves", "place", "digest")
    rounds, roots = _rounds(nodes, sizes[0], levels, f"{folder}/up")
    roots = stored(roots.select("tree", F.col("digest").alias("root")), "roots", folder)
    over = roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(sizes[1]).alias("leaves"), F.col("tree").alias("place"), F.col("root").alias("digest"))
    top_rounds, top = _rounds(over, sizes[1], levels, f"{folder}/top")
    return Manifest(leaves, trees.join(roots, "tree"), rounds, top_rounds, top.first()["digest"].hex(), levels, folder)


def _pass_on(chunk: Chunk, at: int, place: int, proof: list[Step]) -> tuple:
    return chunk.tree, chunk.leaves, place, pack_proof(proof)


def _proofs_of_chunks(manifest: Manifest) -> DataFrame:
    """(tree, leaves, place, proof): the proof of the top of each chunk of leaves, by the reversed sweep."""
    spark, folder = manifest.leaves.sparkSession, f"{manifest.folder}/down"
    count, levels = manifest.trees.count(), manifest.levels
    above = spark.createDataFrame([(TOP, count, 0, b"")], _PROOFS)
    for turn in reversed(range(len(manifest.top_rounds))):
        above = stored(_descended(manifest.top_rounds[turn], above, turn, levels, _pass_on, _PROOFS), f"top-{turn}", folder)
    sizes = manifest.trees.select("tree", "leaves")
    starts = above.select(F.col("place").alias("tree"), "proof").join(sizes, "tree")
    starts = stored(starts.select("tree", "leaves", F.lit(0).cast("long").alias("place"), "proof"), "starts", folder)
    below = None
    for turn in reversed(range(len(manifest.rounds))):
        here = starts.where(_round_of(F.col("leaves"), levels) == turn)
        below = here if below is None else here.union(below)
        if turn:
            below = stored(_descended(manifest.rounds[turn], below, turn, levels, _pass_on, _PROOFS), f"down-{turn}", folder)
    return below


def proofs(manifest: Manifest) -> DataFrame:
    """(tree, place, doc_id, digest, proof) of every leaf; ``unpack_proof`` and ``fold`` read a proof."""
    if manifest.root is None:
        return manifest.leaves.select("tree", "place", "doc_id", "digest", F.lit(None).cast("binary").alias("proof"))

    def emit(chunk: Chunk, at: int, place: int, proof: list[Step]) -> tuple:
        return chunk.tree, place, chunk.carried["doc_id"][at], bytes.fromhex(chunk.digests[at].decode()), pack_proof(proof)

    schema = "tree long, place long, doc_id long, digest binary, proof binary"
    return _descended(manifest.leaves, _proofs_of_chunks(manifest), 0, manifest.levels, emit, schema, ("doc_id",))


_VERIFIED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verified(manifest: Manifest) -> DataFrame:
    """For every leaf whether ``shown``, the digest of the row as it is now, still leads to the root.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified). A null in the carried column ``shown``
    means that the row is as it was.
    """
    if manifest.root is None:
        return manifest.leaves.sparkSession.createDataFrame([], _VERIFIED)
    root = manifest.root

    def emit(chunk: Chunk, at: int, place: int, proof: list[Step]) -> tuple:
        leaf, shown = chunk.digests[at], chunk.carried["shown"][at]
        siblings = hashlib.sha256(b"".join(d for s in proof for d in s.siblings)).hexdigest()
        folded = fold(shown.hex().encode() if shown else leaf, proof).decode()
        subroot = chunk.carried.get("subroot") or fold(leaf, proof[: depth(chunk.leaves)]).decode()
        chunk.carried["subroot"] = subroot  # one for the whole chunk
        return chunk.carried["doc_id"][at], leaf.decode(), subroot, root, siblings, folded, folded == root

    return _descended(manifest.leaves, _proofs_of_chunks(manifest), 0, manifest.levels, emit, _VERIFIED, ("doc_id", "shown"))


def document_rows(documents: DataFrame) -> DataFrame:
    """(name, doc_id, digest, shown): a leaf per row, in the tree of its language.

    ``shown`` is the digest after tampering: where 3 divides the CRC-32 of the id's digits, the text's A-Z in
    lower case; elsewhere null. A null id is never tampered with. Other columns are ignored.
    """
    columns = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = row_digest(*map(F.col, columns), lower_ascii(F.col("text")))
    return documents.select(
        F.col("lang").alias("name"), "doc_id", row_digest(*map(F.col, columns), F.col("text")).alias("digest"), F.when(tampered, changed).alias("shown")
    )


def document_manifest(documents: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of all documents. Digests are written first: texts are read once and never moved."""
    return build(stored(document_rows(documents), "rows"), levels)
