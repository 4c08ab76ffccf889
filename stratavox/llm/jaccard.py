"""Documents linked by the Jaccard similarity of their word shingles: an exact join, and its connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm.common import WORD, batch_of, buffer, configure, drop, materialise, mix64, pieces, ranges, table, text_of
from stratavox.llm.packed import BATCH, FAN, PACKED, Fan, batch_number, block_of, buckets_for, by_bucket, press, press_sorted, shared, unpress, unpress_sorted, with_salt
from stratavox.llm.packing import word_hashes, words
from stratavox.operators.ccl import contract

#: Words in a shingle, and the least similarity of a link in hundredths.
SHINGLE, LEAST = 5, 80
#: Bits of a set's signature, records that a task gathers before it packs them, and rounds of comparing with hubs.
BITS, GATHER, ROUNDS = 4096, 1 << 21, 3
#: Parts of the buckets that are counted one after the other, so that only one part's hashes are in shuffle files at a time.
TURNS = 3
SETS = "doc_id long, hash long, n_shingles long, set_id long"
MEMBERS = "block long, sets binary, sizes binary, row binary, hashes binary, counts binary"
KEYS = "set_id long, n long, n_keys long, rank long, key long"
SKETCH = "set_id long, n long, prefix binary, hashes binary, bits binary"

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (hash, row) pairs of all rows' shingles of so many words; then each row's count and the id of its set."""
    n = len(offsets) - 1
    low = _lower[data]
    starts, ends, n_words = words(low, offsets)
    w = word_hashes(low, starts, ends)
    take = np.minimum(n_words, width)
    n_grams = np.where(n_words > 0, n_words - take + 1, 0)
    first = ranges(np.cumsum(n_words) - n_words, n_grams)
    row = np.repeat(np.arange(n, dtype=np.int32), n_grams)
    h = mix64(take[row].astype(np.uint64))
    for j in range(width):
        own = w[np.minimum(first + j, max(len(w) - 1, 0))] if len(w) else w
        h = np.where(j < take[row], mix64(h ^ own) + np.uint64(j), h)
    h &= ~np.uint64(255)  # 56 bits: of two documents of 500 shingles, two differing ones agree once in 3e11 pairs
    order = np.argsort(h, kind="stable")
    h, row = h[order], row[order]
    new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[: len(h)]
    h, row = h[new], row[new]
    count = np.bincount(row, minlength=n)
    by_row = np.argsort(row.astype(np.int32), kind="stable")
    sums = np.zeros((n, 2), np.uint64)
    has = count > 0
    at = (np.cumsum(count) - count)[has]
    if len(at):
        mixed = mix64(h[by_row] ^ np.uint64(0x5851F42D4C957F2D))
        sums[has, 0], sums[has, 1] = np.add.reduceat(mixed, at), np.bitwise_xor.reduceat(h[by_row], at)
    set_id = mix64(sums[:, 0] ^ mix64(sums[:, 1] + count.astype(np.uint64)))
    return h, row, count, set_id


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffer(batch.column(2))
        for a, b in pieces(offsets):
            _, _, count, set_id = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield batch_of(SETS, batch.column(0)[a:b], batch.column(1)[a:b], count, set_id.view(np.int64))


def shingle_rows(buckets: int):
    """For mapInArrow over (text): PACKED rows, the payload being which set each shingle is of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = 0
        for batch in batches:
            data, offsets = buffer(batch.column(0))
            for a, b in pieces(offsets, BATCH):
                h, row, count, set_id = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                _, keep, same = np.unique(set_id, return_index=True, return_inverse=True)
                one = np.zeros(b - a, bool)
                one[keep] = True  # of equal sets one is enough
                h, row = h[one[row]], same[row][one[row]].astype(np.uint32)
                sets, sizes = set_id[keep], count[keep].astype(np.uint32)
                number, out = batch_number(k), []
                for bucket, i, j in by_bucket(h, buckets):
                    cuts = np.flatnonzero(np.append(True, h[i + 1 : j] != h[i : j - 1]))
                    times = np.diff(np.append(cuts, j - i)).astype(np.uint32)
                    used, place = np.unique(row[i:j], return_inverse=True)
                    payload = [press(sets[used]), press(sizes[used]), press(place.astype(np.uint32))]
                    head = np.array([len(x) for x in payload], "<i8").tobytes()
                    out.append((bucket, number, press_sorted(h[i:j][cuts]), press(times), head + b"".join(payload)))
                k += 1
                if out:
                    yield batch_of(PACKED, *map(list, zip(*out, strict=True)))

    return run


def member_batch(found: list, blocks: int) -> pa.RecordBatch:
    """MEMBERS rows of lists of (set, size, hash, count) arrays, a row for each block of set ids."""
    ids, sizes, h, n = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((h, block_of(ids, blocks)))
    ids, sizes, h, n = ids[order], sizes[order], h[order], n[order]
    block = block_of(ids, blocks)
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    out = []
    for i, j in zip(cuts, np.append(cuts[1:], len(ids)), strict=True):
        used, at, row = np.unique(ids[i:j], return_index=True, return_inverse=True)
        out.append((block[i], press(used), press(sizes[i:j][at]), press(row.astype(np.uint32)), press_sorted(h[i:j]), press(n[i:j])))
    return batch_of(MEMBERS, *map(list, zip(*out, strict=True)))


def members_again(blocks: int):
    """For applyInArrow by coarse block and group: MEMBERS rows of fine blocks."""

    def run(table_: pa.Table) -> pa.Table:
        found = []
        for x in table_.to_pylist():
            row = unpress(x["row"], np.uint32)
            found.append((unpress(x["sets"], np.uint64)[row], unpress(x["sizes"], np.uint32)[row], unpress_sorted(x["hashes"]), unpress(x["counts"], np.uint16)))
        return pa.Table.from_batches([member_batch(found, blocks)])

    return run


def member_rows(blocks: int):
    """For mapInArrow over answered batches: the shared shingles of sets, packed by block of set ids.

    What a task has read is gathered first, so that a task gives one row for each block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            cols = batch.to_pydict()
            for counts_raw, payload, at_raw, hashes_raw, total_raw in zip(cols["counts0"], cols["payload"], cols["at"], cols["hashes"], cols["counts"], strict=True):
                a, b, c = np.frombuffer(payload[:24], "<i8")
                sets, sizes = unpress(payload[24 : 24 + a], np.uint64), unpress(payload[24 + a : 24 + a + b], np.uint32)
                place = unpress(payload[24 + a + b : 24 + a + b + c], np.uint32)
                times = unpress(counts_raw, np.uint32).astype(np.int64)
                at, hashes, total = unpress_sorted(at_raw).astype(np.int64), unpress_sorted(hashes_raw), unpress(total_raw, np.uint16)
                if not len(at):
                    continue
                own = place[ranges((np.cumsum(times) - times)[at], times[at])]
                found.append((sets[own], sizes[own], np.repeat(hashes, times[at]), np.repeat(total, times[at])))
                held += len(own)
                if held > GATHER:
                    yield member_batch(found, blocks)
                    found, held = [], 0
        if found:
            yield member_batch(found, blocks)

    return run


def least_overlap(n: np.ndarray) -> np.ndarray:
    """The fewest shingles that a set of n shares with one it links to."""
    return (LEAST * n + 99) // 100


def sketches(members: pa.Table) -> pa.Table:
    """For applyInArrow by block: for sets that may have links, SKETCH rows.

    Shingles are ordered by how many sets have them, then by hash; the prefix is what is left of the first
    n - least_overlap(n) + 1 once those of no other set are set aside. Linked sets share a shingle of their prefixes.
    """
    parts = members.to_pydict()
    sets = np.concatenate([unpress(x, np.uint64) for x in parts["sets"]])
    sizes = np.concatenate([unpress(x, np.uint32) for x in parts["sizes"]]).astype(np.int64)
    ids, where, inverse = np.unique(sets, return_index=True, return_inverse=True)
    size, row, first = sizes[where], [], 0
    for s, r in zip(parts["sets"], parts["row"], strict=True):
        n = len(unpress(s, np.uint64))
        row.append(inverse[first + unpress(r, np.uint32)])
        first += n
    row = np.concatenate(row)
    h = np.concatenate([unpress_sorted(x) for x in parts["hashes"]])
    df = np.concatenate([unpress(x, np.uint16) for x in parts["counts"]])
    order = np.lexsort((h, df, row))
    row, h = row[order], h[order]
    new = np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1]))
    row, h = row[new], h[new]
    common = np.bincount(row, minlength=len(ids))
    prefix = size - least_overlap(size) + 1 - (size - common)
    begin = np.cumsum(common) - common
    out = []
    for i in np.flatnonzero(prefix > 0):
        own = h[begin[i] : begin[i] + common[i]]
        bits = np.zeros(BITS, np.uint8)
        bits[own >> np.uint64(20) & np.uint64(BITS - 1)] = 1
        out.append((ids[i].view(np.int64), size[i], own[: prefix[i]].tobytes(), np.sort(own).tobytes(), np.packbits(bits).tobytes()))
    return pa.Table.from_batches([batch_of(SKETCH, *(map(list, zip(*out, strict=True)) if out else [[]] * 5))])


def prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffer(batch.column(2))
        count = np.diff(offsets) // 8
        row = pa.array(np.repeat(np.arange(len(count)), count))
        yield batch_of(KEYS, batch.column(0).take(row), batch.column(1).take(row), np.repeat(count, count), ranges(np.zeros(len(count), np.int64), count), np.frombuffer(data.tobytes(), np.int64))


def linked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over pairs of sketches: the pairs that are linked. Bit counts bound the overlap before it is counted."""
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        need = (LEAST * (na + nb) + 99 + LEAST) // (100 + LEAST)
        bits = [np.frombuffer(buffer(batch.column(c))[0].tobytes(), np.uint64).reshape(-1, BITS // 64) for c in ("bits_a", "bits_b")]
        (da, oa), (db, ob) = buffer(batch.column("hashes_a")), buffer(batch.column("hashes_b"))
        da, db, oa, ob = np.frombuffer(da.tobytes(), np.uint64), np.frombuffer(db.tobytes(), np.uint64), oa // 8, ob // 8
        most = np.minimum(np.diff(oa) - np.bitwise_count(bits[0] & ~bits[1]).sum(axis=1), np.diff(ob) - np.bitwise_count(bits[1] & ~bits[0]).sum(axis=1))
        linked = np.zeros(len(a), bool)
        for i in np.flatnonzero(most >= (LEAST * (na + nb)) // (100 + LEAST)):
            x, y = da[oa[i] : oa[i + 1]], db[ob[i] : ob[i + 1]]
            at = np.searchsorted(y, x)
            overlap = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
            linked[i] = 100 * overlap >= LEAST * (na[i] + nb[i] - overlap)
        yield batch_of("a long, b long", a[linked], b[linked])


def verified(pairs: DataFrame, sketch: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets whose similarity is at least LEAST hundredths."""
    side = lambda x: sketch.select(F.col("set_id").alias(x), F.col("n").alias(f"n{x}"), F.col("hashes").alias(f"hashes_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "na", "nb", "bits_a", "bits_b", "hashes_a", "hashes_b").mapInArrow(linked_rows, "a long, b long")


def fits(a, b):
    return (100 * F.least(a, b) >= LEAST * F.greatest(a, b)) & (a > 0)


def set_links(docs: DataFrame, fan_out: int = FAN) -> tuple[DataFrame, DataFrame]:
    """SETS rows of docs, and set_id and part, its component, of the sets that may have links.

    Equal sets are one set. Every set's shingles are counted over all sets; sets that share a prefix shingle and whose
    sizes are close are candidates. First each set is compared with one hub, in a few rounds: of the sets that share a
    shingle with it, the one with the longest prefix, as an original has next to its edited copies; then,
    tile by tile of close sizes, those that are not yet in one component. So a large group of near copies costs about one
    comparison for each of its sets, and no pair that could join two components is left out. Of a linked pair, the first
    shingle that both have leaves as many of either set behind it as the pair must share. The smaller set must share
    8/9 of its own with any that is not smaller; so copies with more edits than that meet larger sets only.
    """
    text = text_of(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    sets = materialise(rows.mapInArrow(set_rows, SETS), "jaccard-sets")
    fan = Fan(buckets_for(8 * (sets.agg(F.sum("n_shingles")).first()[0] or 0)), fan_out)
    packed = materialise(rows.select("text").mapInArrow(shingle_rows(fan.coarse), PACKED), "jaccard-packed")
    answers = [materialise(shared(packed.filter(F.col("bucket") % TURNS == turn), fan), "jaccard-answer") for turn in range(TURNS)]
    payload = materialise(packed.select("bucket", "batch", F.col("counts").alias("counts0"), "payload"), "jaccard-payload")
    drop(packed)
    own = payload.join(reduce(DataFrame.unionByName, answers), ["bucket", "batch"])
    members = own.select("counts0", "payload", "at", "hashes", "counts").mapInArrow(member_rows(fan.coarse), MEMBERS)
    if fan.per > 1:
        members = members.withColumn("group", fan.group("sets")).groupBy("block", "group").applyInArrow(members_again(fan.fine), MEMBERS)
    sketch = materialise(members.groupBy("block").applyInArrow(sketches, SKETCH), "jaccard-sketch")
    drop(payload, *answers)
    keys = materialise(sketch.select("set_id", "n", "prefix").mapInArrow(prefix_rows, KEYS), "jaccard-keys")
    parts = materialise(sketch.select("set_id", F.col("set_id").alias("part")), "jaccard-parts")
    tried = []
    for _ in range(ROUNDS):
        own = keys.join(parts, "set_id")
        hub = F.max(F.struct("n_keys", "set_id", "n", "part"))
        hubs = own.groupBy("key").agg(hub.alias("hub"), F.min("part").alias("_a"), F.max("part").alias("_b")).filter("_a < _b")
        offers = own.join(hubs, "key").filter((F.col("part") != F.col("hub.part")) & fits(F.col("n"), F.col("hub.n")))
        best = offers.groupBy(F.col("set_id").alias("b")).agg(F.max(F.struct("hub.n_keys", "hub.set_id")).alias("best"))
        tried.append(materialise(best.select("b", F.col("best.set_id").alias("a")), "jaccard-pairs"))
        parts = joined(parts, verified(tried[-1], sketch))
    labelled = keys.join(parts, "set_id")
    open_ = labelled.groupBy("key").agg(F.min("part").alias("_a"), F.max("part").alias("_b"), F.count("*").alias("_m"), F.sum("rank").alias("_ranks"), F.sum(F.xxhash64("set_id").cast("decimal(38,0)")).alias("_who")).filter("_a != _b")
    open_ = open_.groupBy("_m", "_who").agg(F.min_by("key", "_ranks").alias("key"))  # shingles of the same sets give the same pairs; the first has the lowest ranks
    behind = F.col("n_keys") + F.floor((LEAST * F.col("n") + 99) / 100) - 1 - F.col("rank")  # a set's shared shingles from this one on
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / LEAST)) + 1e-9).cast("int")
    left = materialise(labelled.join(open_, "key", "left_semi").select("key", "set_id", "n", "part", behind.cast("long").alias("behind"), band.alias("band")), "jaccard-open")
    enough = lambda x, total: (100 + LEAST) * F.col(x) >= LEAST * total
    small = left.filter(enough("behind", 2 * F.col("n")))
    other = left.select("key", F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("part").alias("part_b"), F.col("behind").alias("behind_b"), F.explode(F.array("band", F.col("band") - 1)).alias("band"))
    both = F.col("n") + F.col("nb")
    ordered = F.struct("n", "set_id") < F.struct("nb", "b")
    again = small.join(other, ["key", "band"]).filter(ordered & (F.col("part") != F.col("part_b")) & fits(F.col("n"), F.col("nb")) & enough("behind", both) & enough("behind_b", both))
    side = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    before = reduce(DataFrame.unionByName, tried).select(*side)
    more = again.select(F.col("set_id").alias("a"), "b").select(*side).distinct().join(before, ["a", "b"], "left_anti")
    parts = joined(parts, verified(more, sketch))
    drop(sketch, keys, left, *tried)
    return sets, parts


def joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """parts (set_id, part) after links (a, b) between sets; only links between different parts take part in the rounds."""
    found = materialise(links, "jaccard-links")
    side = lambda x: parts.select(F.col("set_id").alias(x), F.col("part").alias(f"part_{x}"))
    between = found.join(side("a"), "a").join(side("b"), "b").filter("part_a != part_b").select(F.col("part_a").alias("a"), F.col("part_b").alias("b"))
    roots = contract(between).select(F.col("node").alias("part"), "root")
    after = materialise(parts.join(roots, "part", "left").select("set_id", F.coalesce("root", "part").alias("part")), "jaccard-parts")
    drop(found, parts)
    return after


def cells(sets: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For SETS rows and the parts of sets: the rows with a salt; the least row of each set and salt; the least row of each part, with its sets.

    A row is less than another by doc_id, nulls last, then by the hash of its text. The salt splits sets that many rows have.
    """
    sets = with_salt(sets, "doc_id", "hash")
    least = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("doc_id"), F.col("hash").alias("hash"))
    lows = sets.filter("n_shingles > 0").groupBy("set_id", "salt").agg(F.min(least).alias("least"))
    groups = lows.groupBy("set_id").agg(F.min("least").alias("least")).join(parts, "set_id", "left").withColumn("part", F.coalesce("part", "set_id"))
    lowest = groups.groupBy("part").agg(F.min("least").alias("least"))
    return sets, lows, groups.select("set_id", "part").join(lowest, "part")


def named(sets: DataFrame, parts: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of SETS rows."""
    sets, lows, least = cells(sets, parts)
    names = lows.select("set_id", "salt").join(least.select("set_id", F.col("least.doc_id").alias("component_id")), "set_id")
    whole = sets.withColumn("set_id", F.when(F.col("n_shingles") > 0, F.col("set_id"))).join(names, ["set_id", "salt"], "left")
    return whole.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def link_documents(docs: DataFrame, fan_out: int = FAN) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs.

    component_id is the smallest doc_id that links reach. A document without words has no shingles and no links; one of
    fewer than five words has its words as one shingle. Repeated rows are kept and linked like others; a null doc_id is
    never a component's name unless nothing else is in it. Other columns are ignored. Sets go by a 64-bit id.
    fan_out is what FAN of packed says; it changes the route alone.
    """
    return named(*set_links(docs, fan_out))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of linked documents, all columns kept: that of the smallest doc_id, nulls last, then of the least text hash.

    Of repeated rows one stays. Rows without words are linked with nothing and stay.
    """
    least = cells(*set_links(docs))[2].select("least.*").distinct()
    kept = materialise(least.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("null").alias("_null"), F.col("hash").alias("_hash")), "jaccard-kept")
    text, own = text_of(docs), F.col("doc_id").cast("long")
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.coalesce(own, F.lit(0)).alias("_id"), own.isNull().alias("_null"), F.xxhash64(text).alias("_hash"), text.rlike(WORD).alias("_words"))
    one = row.filter("_words").join(kept, ["_id", "_null", "_hash"], "left_semi").dropDuplicates(["_id", "_null", "_hash"])
    return one.select("_row.*").unionByName(row.filter("not _words").select("_row.*"))


def op6_jaccard(spark, sf_dir: str) -> DataFrame:
    configure(spark)
    return link_documents(table(spark, sf_dir, "documents"))
