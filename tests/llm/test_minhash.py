"""Near duplicates by MinHash against all pairs of full sets."""

import itertools
import random
import re

import numpy as np
import pytest
from helpers import awkward, documents, sentence

from stratavox.llm import minhash


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of every row, by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    names = [least.get(find(i)) if s else rows[i][0] for i, s in enumerate(sets)]
    return sorted(((r[0], len(s), c, r[0] == c) for r, s, c in zip(rows, sets, names, strict=True)), key=repr)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = awkward(seed)
    for i in range(150):  # copies on both sides of the threshold
        words = rows[rng.randrange(60)][1].split(" ")
        for _ in range(max(1, len(words) // rng.choice([10, 15, 20, 30, 50]))):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        rows.append((2000 + i, " ".join(words), "a"))
    rows += [(None, rows[3][1], "a"), (None, "nothing is like this", "b"), (None, None, "b")]
    assert found(minhash.near_duplicates(documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("block", [minhash.BLOCK, 16])
def test_chain_and_crowd(spark, monkeypatch, block):
    """A chain in which only neighbours link, and a crowd of copies of one text of which many are just not similar enough."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    if block == 16:
        monkeypatch.setattr(minhash, "MOST_NEAR", 0)
    rng = random.Random(5)
    words = sentence(rng, 400).split(" ")
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words), "a"))
        for j in rng.sample(range(len(words)), 12):
            words[j] = f"new{i}x{j}"
    base = sentence(rng, 300).split(" ")
    for i in range(150):
        copy = list(base)
        for j in rng.sample(range(300), rng.choice([10, 14, 18, 24])):
            copy[j] = f"w{i}x{j}"
        rows.append((100 + i, " ".join(copy), "a"))
        if i % 10 == 0:  # a copy of a copy, which links with it alone
            for j in rng.sample(range(300), 10):
                copy[j] = f"y{i}x{j}"
            rows.append((400 + i, " ".join(copy), "a"))
    rows.append((999, " ".join(base), "a"))
    assert found(minhash.near_duplicates(documents(spark, rows))) == brute(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(minhash.near_duplicates(docs)) == brute(rows)


def test_template_without_links(spark):
    """Texts that share more than half of their words meet in the same keys, and none may be linked."""
    rng = random.Random(6)
    base = sentence(rng, 120)
    rows = [(i, base + " " + " ".join(f"v{i}x{j}" for j in range(60)), "a") for i in range(120)]
    assert {r[2] for r in found(minhash.near_duplicates(documents(spark, rows)))} == set(range(120))


def test_empty(spark):
    assert minhash.near_duplicates(documents(spark, [])).collect() == []
    assert found(minhash.near_duplicates(documents(spark, [(1, "", "a"), (2, None, "a")]))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_every_pair_within_sure_meets():
    """Signatures that differ in SURE components, however these lie, have a key in common."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, minhash.MINIMA, np.uint16)
        b = a.copy()
        b[rng.permutation(minhash.MINIMA)[: minhash.SURE]] ^= np.uint16(1 << rng.integers(16))
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([a.tobytes(), b.tobytes()])], ["set_id", "signature"])
        (out,) = minhash.key_rows(iter([batch]))
        keys = out.column("key").to_numpy()
        assert len(keys) == 2 * minhash.MINIMA and set(keys[: minhash.MINIMA]) & set(keys[minhash.MINIMA :])
    worst = a.copy()
    worst.reshape(minhash.CHUNKS, -1)[:, : minhash.ERRORS + 1] ^= np.uint16(1)  # SURE + 1 errors, two in each chunk
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([a.tobytes(), worst.tobytes()])], ["set_id", "signature"])
    (out,) = minhash.key_rows(iter([batch]))
    assert len(set(out.column("key").to_pylist())) == 2 * minhash.MINIMA


def test_components_that_differ(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(0, 4, (200, minhash.MINIMA)).astype(np.uint16) << 14
    b = rng.integers(0, 4, (200, minhash.MINIMA)).astype(np.uint16) << 14
    df = spark.createDataFrame([(bytearray(x.tobytes()), bytearray(y.tobytes())) for x, y in zip(a, b, strict=True)], "p binary, q binary")
    apart = df.select(*minhash._words("p", "w"), *minhash._words("q", "v")).select(minhash._apart("w", "v").alias("n"))
    assert [r.n for r in apart.collect()] == (a != b).sum(axis=1).tolist()


def test_minima_estimate_similarity():
    rng = np.random.default_rng(8)
    a = rng.integers(0, 1 << 56, 1000, np.int64).astype(np.uint64) << np.uint64(8)
    b = np.concatenate([a[:889], rng.integers(0, 1 << 56, 111, np.int64).astype(np.uint64) << np.uint64(8)])
    same = [(x[0] == x[1]).mean() for x in (minhash.signatures(np.concatenate([a[i:], a[:i], b]) ^ np.uint64(i << 20), np.array([0, 1000])) for i in range(200))]
    assert abs(np.mean(same) - 889 / 1111) < 0.01
