"""Near duplicates by MinHash: a multi-index join of signatures under a Hamming threshold, links confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.llm.common import batch_of, buffer, configure, drop, materialise, mix64, pieces, table, text_of
from stratavox.llm.jaccard import LEAST, fits, joined, named, shingle_sets

#: Words in a shingle.
SHINGLE = 2
#: A signature has CHUNKS * COMPONENTS minima of BITS bits each. Its chunks may differ in ERRORS components.
CHUNKS, COMPONENTS, ERRORS, BITS = 12, 5, 1, 16
MINIMA = CHUNKS * COMPONENTS
#: All pairs of signatures that differ in up to SURE components meet: were each chunk to differ in more than ERRORS, the whole would differ in SURE + 1.
SURE = CHUNKS * (ERRORS + 1) - 1
#: Pairs that meet are left out if they differ in more components; of 60, a pair of similarity 0.8 does so once in about 1.2e6.
MOST = 28
#: Sets that may have links are broadcast (three numbers each) up to so many, so that texts stay where they are; beyond that texts are shuffled to them.
MOST_NEAR = 500_000
#: Sets of a block, two of which are compared in one task.
BLOCK = 1024
SETS = "doc_id long, hash long, n_shingles long, set_id long, signature binary"
KEYS = "set_id long, key long"
FULL = "set_id long, hashes binary"

_random = np.random.default_rng(20).integers(0, 1 << 63, (2, MINIMA), np.int64).view(np.uint64)
FLIPS, FACTORS = _random[0], _random[1] | np.uint64(1)


def signatures(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The minima of sets h[start:next start], of at least one hash each: a row of MINIMA numbers for each set."""
    out = np.empty((len(starts), MINIMA), np.uint16)
    for k in range(MINIMA):
        least = np.minimum.reduceat((h ^ FLIPS[k]) * FACTORS[k], starts)
        out[:, k] = mix64(least) >> np.uint64(64 - BITS)
    return out


def signed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, hash, text): SETS rows."""
    for batch in batches:
        data, offsets = buffer(batch.column(2))
        for a, b in pieces(offsets):
            h, row, count, set_id = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SHINGLE)
            some = np.flatnonzero(count)
            sign = [None] * (b - a)
            if len(some):
                by_row = h[np.argsort(row, kind="stable")]
                for i, x in zip(some, signatures(by_row, (np.cumsum(count) - count)[some]), strict=True):
                    sign[i] = x.tobytes()
            yield batch_of(SETS, batch.column(0)[a:b], batch.column(1)[a:b], count, set_id.view(np.int64), sign)


def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (set_id, signature): a key for each chunk and each choice of the components that may differ.

    With ERRORS = 1, a chunk gives a key for each component that is left out: two chunks that differ in one component or
    none agree in one of them.
    """
    rest = np.array([[i for i in range(COMPONENTS) if i != e] for e in range(COMPONENTS)])
    for batch in batches:
        sign = np.frombuffer(buffer(batch.column(1))[0].tobytes(), "<u2").reshape(-1, CHUNKS, COMPONENTS)
        packed = np.ascontiguousarray(sign[:, :, rest]).view("<u8")[..., 0]  # set, chunk, component left out
        which = mix64(np.arange(1, MINIMA + 1, dtype=np.uint64)).reshape(CHUNKS, COMPONENTS)
        keys = mix64(packed ^ which).reshape(-1)
        row = pa.array(np.repeat(np.arange(len(sign)), MINIMA))
        yield batch_of(KEYS, batch.column(0).take(row), keys.view(np.int64))


def full_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (set_id, text): the sorted shingles of each text, 48 bits of each."""
    for batch in batches:
        data, offsets = buffer(batch.column(1))
        for a, b in pieces(offsets):
            h, row, count, _ = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SHINGLE)
            short = np.ascontiguousarray((h >> np.uint64(16))[np.argsort(row, kind="stable")]).view(np.uint8).reshape(-1, 8)[:, :6]
            upto = np.concatenate([[0], np.cumsum(count)])
            yield batch_of(FULL, batch.column(0)[a:b], [short[i:j].tobytes() for i, j in zip(upto[:-1], upto[1:], strict=True)])


def _hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffer(column)
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = data.reshape(-1, 6)
    return wide.view("<u8").ravel(), offsets // 6


def linked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (a, b, hashes_a, hashes_b): the pairs whose full sets are similar enough."""
    for batch in batches:
        (x, at_x), (y, at_y) = _hashes(batch.column(2)), _hashes(batch.column(3))
        linked = np.zeros(len(batch), bool)
        for i in range(len(batch)):
            p, q = x[at_x[i] : at_x[i + 1]], y[at_y[i] : at_y[i + 1]]
            at = np.searchsorted(q, p)
            overlap = int((q[np.minimum(at, len(q) - 1)] == p).sum()) if len(q) else 0
            linked[i] = 100 * overlap >= LEAST * (len(p) + len(q) - overlap)
        keep = pa.array(np.flatnonzero(linked))
        yield batch_of("a long, b long", batch.column(0).take(keep), batch.column(1).take(keep))


def overlaps(own: np.ndarray, many: list[np.ndarray]) -> np.ndarray:
    """How many hashes each of many sets has in common with a sorted one."""
    every = np.concatenate(many)
    at = np.searchsorted(own, every)
    hit = own[np.minimum(at, len(own) - 1)] == every
    return np.add.reduceat(hit, np.cumsum([0] + [len(x) for x in many[:-1]]), dtype=np.int64)


def tile_links(table_: pa.Table) -> pa.Table:
    """For applyInArrow by tile: links (a, b) between different parts of its sets, at most one less than there are sets.

    A tile has two blocks of sets, or one. Signatures are compared all with all; sets of pairs within MOST of each other whose parts
    aren't joined yet are compared in full.
    """
    head, links = table_.slice(0, 1).to_pylist()[0], []
    ids, part = table_["set_id"].to_numpy(), np.unique(table_["part"].to_numpy(), return_inverse=True)[1]
    first = table_["first"].to_numpy(zero_copy_only=False)
    x, at = _hashes(table_["hashes"].combine_chunks())
    sets, n = [x[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], np.diff(at)
    sign = np.frombuffer(buffer(table_["signature"])[0].tobytes(), "<u2").reshape(-1, MINIMA)
    within = not head["other"] and head["i"] == head["j"]
    right = np.flatnonzero(~first) if not within else np.arange(len(ids))
    for k in np.flatnonzero(first):
        near = right[right > k] if within else right
        near = near[(part[near] != part[k]) & (100 * np.minimum(n[near], n[k]) >= LEAST * np.maximum(n[near], n[k]))]
        near = near[(sign[near] != sign[k]).sum(axis=1) <= MOST]
        for block in np.array_split(near, -(-len(near) // 256)) if len(near) else ():
            same = overlaps(sets[k], [sets[j] for j in block])
            for j in block[100 * same >= LEAST * (n[block] + n[k] - same)]:
                if part[j] != part[k]:
                    links.append((ids[k], ids[j]))
                    part[part == part[j]] = part[k]
    return pa.Table.from_batches([batch_of("a long, b long", *(map(list, zip(*links, strict=True)) if links else [[]] * 2))])


def tiles(homed: DataFrame) -> DataFrame:
    """Rows of sets (set_id, home, part, hub, ...) by tile of their home: home, i, other and j, and whether a row is of the tile's first block.

    Sets of the hub's part are compared with those of other parts only, and these with each other too; either are dealt to
    blocks of about BLOCK sets by a hash. A home whose sets are all of one part gives no tiles.
    """
    known = homed.groupBy("home").agg(F.count_if("inner").alias("_c"), F.count_if(~F.col("inner")).alias("_u")).filter("_u > 0 and _c + _u > 1")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    mine = homed.join(known, "home").withColumns({"_nu": blocks("_u"), "_nc": blocks("_c")})
    own = F.pmod(F.xxhash64("set_id", F.lit(3)), F.when(F.col("inner"), F.col("_nc")).otherwise(F.col("_nu"))).cast("int")
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    tile = lambda i, other, j, first: F.struct(i.alias("i"), F.lit(other).alias("other"), j.alias("j"), first.alias("first"))
    inner = F.transform(upto("_nu"), lambda i: tile(i, True, F.col("_b"), F.lit(False)))
    outer = F.concat(
        F.transform(upto("_nu"), lambda j: tile(F.least(F.col("_b"), j), False, F.greatest(F.col("_b"), j), F.col("_b") <= j)),
        F.transform(upto("_nc"), lambda j: tile(F.col("_b"), True, j, F.lit(True))),
    )
    dealt = mine.withColumn("_b", own).withColumn("_t", F.explode(F.when(F.col("inner"), inner).otherwise(outer)))
    return dealt.select("home", "_t.*", "set_id", "part")


def confirmed(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that are linked. A hub a may be in many pairs, so it is joined last, where skew can be split."""
    side = lambda x: full.select(F.col("set_id").alias(x), F.col("hashes").alias(f"hashes_{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "hashes_a", "hashes_b").mapInArrow(linked_rows, "a long, b long")


def _words(signature: str, prefix: str) -> list[Column]:
    """A signature as numbers of 64 bits, four components each."""
    hexed = F.hex(signature)
    return [F.conv(F.substring(hexed, 16 * i + 1, 16), 16, -10).cast("long").alias(f"{prefix}{i}") for i in range(MINIMA * BITS // 64)]


def _apart(x: str, y: str) -> Column:
    """In how many components two signatures differ: each lane of 16 bits is folded to one that says whether any is set."""
    total = F.lit(0)
    for i in range(MINIMA * BITS // 64):
        w = F.col(f"{x}{i}").bitwiseXOR(F.col(f"{y}{i}"))
        for s in (8, 4, 2, 1):
            w = w.bitwiseOR(F.shiftrightunsigned(w, s))
        total = total + F.bit_count(w.bitwiseAND(F.lit(0x0001000100010001)))
    return total


def set_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SETS rows of docs, and set_id and part, its component, of the sets that may have links.

    Equal sets are one set. Sets meet where a chunk of their signatures differs in ERRORS components at most, so that all
    pairs within SURE of each other meet. A set is heavy if many sets have its keys, as an original's are had by its copies.
    First each set is compared with one hub: of those that are the heaviest of a key of its own, the one that it shares the
    most keys with. Then sets are at home with the heaviest of all these, and those of one home that are in different
    components are compared in tiles of two blocks, signatures first. Last, by key and bands of close sizes, pairs of
    different homes and components. None that meet and could join two components is left out, and a large group of near
    copies that are just not similar enough makes no rows of pairs.
    """
    text = text_of(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    sets = materialise(rows.mapInArrow(signed_rows, SETS), "minhash-sets")
    least = F.struct(F.col("doc_id").isNull().alias("null"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("hash").alias("hash"))
    one = sets.filter("n_shingles > 0").groupBy("set_id").agg(F.first("n_shingles").alias("n"), F.min(least).alias("least"), F.first("signature").alias("signature"))
    one = materialise(one, "minhash-one")
    every = one.select("set_id", "signature").mapInArrow(key_rows, KEYS)
    often = every.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    found = materialise(every.join(often, "key"), "minhash-found")
    heavy = found.groupBy("set_id").agg(F.sum("m").alias("weight"))
    near = materialise(one.join(heavy, "set_id"), "minhash-near")
    few = F.broadcast if near.count() <= MOST_NEAR else lambda df: df
    keys = materialise(found.select("key", "set_id").join(few(near.select("set_id", "n", "weight")), "set_id"), "minhash-keys")
    drop(one, found)
    where = few(near.select("set_id", "least.*"))
    row = rows.select(F.col("doc_id").isNull().alias("null"), F.coalesce("doc_id", F.lit(0)).alias("id"), "hash", "text")
    own = row.join(where, ["null", "id", "hash"]).select("set_id", "text")
    full = materialise(own.mapInArrow(full_rows, FULL).dropDuplicates(["set_id"]), "minhash-full")
    parts = materialise(near.select("set_id", F.col("set_id").alias("part")), "minhash-parts")
    hub = F.struct("weight", "set_id", "n", "part")
    hubs = lambda placed: placed.groupBy("key").agg(F.max(hub).alias("hub"), F.min("part").alias("_a"), F.max("part").alias("_b")).filter("_a < _b")
    placed = keys.join(parts, "set_id")
    offers = placed.join(hubs(placed), "key").filter((F.col("part") != F.col("hub.part")) & fits(F.col("n"), F.col("hub.n")))
    counted = offers.groupBy(F.col("set_id").alias("b"), F.col("hub.set_id").alias("a")).agg(F.count("*").alias("k"))
    best = counted.groupBy("b").agg(F.max(F.struct("k", "a")).alias("best"))
    tried = materialise(best.select("b", F.col("best.a").alias("a")), "minhash-pairs")
    parts = joined(parts, confirmed(tried, full))
    placed = keys.join(parts, "set_id")
    home = placed.join(hubs(placed), "key").groupBy("set_id", "part").agg(F.max("hub").alias("hub"))
    home = materialise(home.select("set_id", F.col("hub.set_id").alias("home"), "part", (F.col("part") == F.col("hub.part")).alias("inner")), "minhash-homes")
    whole = tiles(home).join(near.select("set_id", "signature"), "set_id").join(full, "set_id")
    parts = joined(parts, whole.groupBy("home", "i", "other", "j").applyInArrow(tile_links, "a long, b long"))
    placed = keys.drop("weight").join(parts, "set_id").join(home.select("set_id", "home"), "set_id")
    open_ = placed.groupBy("key").agg(F.min("part").alias("_a"), F.max("part").alias("_b"), F.min("home").alias("_h"), F.max("home").alias("_i"), F.count("*").alias("_m"), F.sum(F.xxhash64("set_id").cast("decimal(38,0)")).alias("_who")).filter("_a != _b and _h != _i")
    open_ = open_.groupBy("_m", "_who").agg(F.min("key").alias("key"))  # keys of the same sets give the same pairs
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / LEAST)) + 1e-9).cast("int")
    left = placed.join(open_, "key", "left_semi").join(near.select("set_id", "signature"), "set_id")
    left = materialise(left.select("key", "set_id", "n", "part", "home", band.alias("band"), *_words("signature", "w")), "minhash-open")
    names = {"set_id": "b", "n": "nb", "part": "part_b", "home": "home_b"} | {f"w{i}": f"v{i}" for i in range(MINIMA * BITS // 64)}
    other = left.select("key", F.explode(F.array("band", F.col("band") - 1)).alias("band"), *[F.col(k).alias(v) for k, v in names.items()])
    ordered = F.struct("n", "set_id") < F.struct("nb", "b")
    again = left.join(other, ["key", "band"]).filter(ordered & (F.col("part") != F.col("part_b")) & (F.col("home") != F.col("home_b")) & fits(F.col("n"), F.col("nb")) & (_apart("w", "v") <= MOST))
    side = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    more = again.select(F.col("set_id").alias("a"), "b").select(*side).distinct()
    parts = joined(parts, confirmed(more, full))
    drop(near, keys, full, left, home, tried)
    return sets.drop("signature"), parts


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs.

    Documents link when the shared part of their sets of 2-word shingles is 80 hundredths of both together; component_id is
    the smallest doc_id that links reach, kept says whether it is the row's own. Documents without words have no shingles
    and no links; one word alone is a shingle. Repeated rows and equal sets are linked and each has a row. A null text is
    empty; a null doc_id names a component only if nothing else is in it, and is kept then. An empty table gives no
    rows. Other columns are ignored. Every link that is given is exact but for hashes of 48 bits; of pairs that are just
    similar enough (0.8), one in about 1.1e6 is missed.
    """
    return named(*set_links(docs)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_minhash(spark, sf_dir: str) -> DataFrame:
    """All of `documents`, linked."""
    configure(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))
