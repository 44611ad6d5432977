import hashlib
import string
import zlib

import pytest
from llm.cases import SCHEMA

from boardpulse.llm import merkle

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha(*found[-1][i : i + 8]) for i in range(0, len(found[-1]), 8)])
    return found


def slow(rows):
    """What the manifest says of every row, from whole lists."""
    rows = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    names = sorted({r["lang"] for r in rows}, key=lambda n: (n is not None, (n or "").encode()))
    groups = [[r for r in rows if r["lang"] == n] for n in names]
    trees = [levels([leaf(r, r["text"]) for r in g]) for g in groups]
    top = levels([t[-1][0] for t in trees])
    found = []
    for number, (group, tree) in enumerate(zip(groups, trees, strict=True)):
        for place, row in enumerate(group):
            digest = tree[0][place]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
                digest = leaf(row, row["text"] and row["text"].translate(LOWER))
            proof = []
            for of, at in ((tree, place), (top, number)):
                for nodes in of[:-1]:
                    run, mine = nodes[at // 8 * 8 :][:8], at % 8
                    proof += run[:mine] + run[mine + 1 :]
                    digest, at = sha(*run[:mine], digest, *run[mine + 1 :]), at // 8
            root = top[-1][0]
            found.append((row["doc_id"], tree[0][place], tree[-1][0], root, sha(*proof), digest, digest == root))
    return found


def key(row):
    return tuple(map(str, row))


def check(spark, rows, levels=merkle.LEVELS):
    others = [field.split()[0] for field in SCHEMA.split(", ")]
    full = [{**dict.fromkeys(others, "z"), **r} for r in rows]
    frame = spark.createDataFrame(full, SCHEMA).repartition(3)
    found = merkle.verified(merkle.document_manifest(frame, levels)).collect()
    assert sorted(map(key, found)) == sorted(map(key, slow(rows)))


def row(i, lang="en", text="Some Text", source="s"):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": 9}


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 8, 64, 65], [513, 1, 70]])
def test_equals_brute_force(spark, sizes):
    check(spark, [row(1000 * k + 7 * i, f"l{k}", f"Text {i}") for k, n in enumerate(sizes) for i in range(n)])


@pytest.mark.parametrize("levels", [1, 2])
def test_several_rounds(spark, levels):
    """Rounds of few levels, so that chunks, messages and trees of other depths meet often."""
    check(spark, [row(i, lang) for lang, n in ((None, 1), ("a", 75), ("é", 9), ("", 8), ("z", 2)) for i in range(n)], levels)
    check(spark, [row(i, f"l{i % 70}") for i in range(150)], levels)


def test_odd_rows(spark, odd, nothing):
    rows = [r.asDict() for r in odd.collect()]
    assert sorted(map(key, merkle.verified(merkle.document_manifest(odd)).collect())) == sorted(map(key, slow(rows)))
    assert merkle.verified(merkle.document_manifest(nothing)).collect() == []
    check(spark, [row(None, None, None, None), row(None, None, None, None), row(None, "", "", ""), row(3, None, "A:1"), *[row(5, "a", "Same")] * 20])


def test_proofs_lead_to_the_root(spark, odd):
    manifest = merkle.document_manifest(odd)
    rows = merkle.proofs(manifest).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert merkle.fold(r.digest.hex().encode(), merkle.unpack_proof(r.proof)).decode() == manifest.root
        assert merkle.pack_proof(merkle.unpack_proof(r.proof)) == r.proof
    assert {r.doc_id for r in merkle.verified(manifest).where("verified").collect()} >= {1, 2, 4}


def test_depths():
    assert [merkle.depth(n) for n in (1, 2, 8, 9, 64, 65, 8**5, 8**5 + 1)] == [0, 1, 1, 2, 2, 3, 5, 6]
    assert [merkle._last_round(n) for n in (1, 4096, 4097, 8**8, 8**8 + 1)] == [0, 0, 1, 1, 2]
