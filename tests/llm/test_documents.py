"""The operators on documents against brute force, on awkward tables."""

import hashlib
import random
import re
import zlib

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, awkward, documents, sentence

from stratavox.llm import digest, jaccard, media, mixing, packed, packing, personal, quality, suffix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize(("hot", "fan_out"), [(suffix.HOT, packed.FAN), (0, packed.FAN), (suffix.HOT, 8), (3, 50)])
def test_repeats_are_removed(docs, rows, hot, fan_out, monkeypatch):
    monkeypatch.setattr(packed, "MERGED", 1)  # several groups
    first, expected = {}, {}
    for i, text in sorted({(i, t or "") for i, t, _ in rows}):
        raw = text.encode()
        gone = bytearray(len(raw))
        for j in range(len(raw) - 49):
            if first.setdefault(raw[j : j + 50], i) < i:
                gone[j : j + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        expected[i] = (len(raw), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest(), kept)
    found = suffix.remove_repeats(docs, hot=hot, fan_out=fan_out).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, *_ in rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in found} == expected


def test_runs_come_back_in_any_order_of_blocks():
    rng, blocks, fine = random.Random(4), 12, 6
    passages = [sentence(rng, 25) for _ in range(40)]
    out = []
    for block in range(blocks):
        rows = np.arange(block, 10 * blocks, blocks)
        texts = [" ".join([sentence(rng, 5), *rng.sample(passages, 3)]).encode() for _ in rows]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        row, start, count, place, h = suffix.anchors(data, offsets)
        notes = suffix.note_batch([(rows[row], h, start.astype(np.uint32), count.astype(np.uint8), place.astype(np.uint8), np.zeros(len(h), np.uint8))], blocks)
        left = pa.table({"block": [block] * len(rows), "row": rows, "doc_id": rows, "text": texts})
        out.append(suffix.segment_rows(1)(left, pa.Table.from_batches([notes])))
    one = pa.concat_tables(out).append_column("group", pa.array([7] * blocks, pa.int64()))
    removals = lambda runs: sorted((b, *map(int, x)) for b, raw in zip(runs["block"].to_pylist(), runs["runs"].to_pylist(), strict=True) for x in zip(*suffix.unbundle(raw, np.uint32, np.int64, np.uint8, np.uint8), strict=True))
    expected = removals(suffix.find_repeats(one))
    assert len({b for b, *_ in expected}) == blocks
    cut = suffix.segments_again(fine)(one)
    found = [suffix.find_repeats(cut.filter(pa.array(cut["bucket"].to_numpy() == b))) for b in sorted(set(cut["bucket"].to_pylist()))]
    found = pa.concat_tables(found).rename_columns(["fine", "group", "runs"])
    for order in (np.arange(blocks), np.arange(blocks)[::-1], np.random.default_rng(0).permutation(blocks)):
        assert removals(suffix.runs_back(fine)(one.take(pa.array(order)), found)) == expected


def test_suffixes_sort_like_strings():
    rng = np.random.default_rng(0)
    block = rng.integers(97, 100, 90).astype(np.uint8)
    text = np.concatenate([block] * 20 + [rng.integers(97, 99, 500).astype(np.uint8), np.zeros(64, np.uint8)])
    text[: 90 * 20 : 131] = 120
    for step in range(8):  # one residue at a time, as ties of unlike residues may stand in any order
        starts = np.arange(step, len(text) - 120, 8)
        order, new = suffix.sort_suffixes(text, starts)
        strings = [text[s : s + 50].tobytes() for s in starts]
        groups = np.cumsum(new)
        by_group = defaultdict(set)
        for k, g in zip(order, groups, strict=True):
            by_group[g].add(strings[k])
        assert all(len(x) == 1 for x in by_group.values()) and len(by_group) == len(set(strings))
        assert [strings[k] for k in order] == sorted(strings)


def test_cover_has_every_difference():
    assert {(a - b) % suffix.PERIOD for a in suffix.COVER for b in suffix.COVER} == set(range(suffix.PERIOD))


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t, _ in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(a), root(i)) for i, a in sets}


def test_links_match_all_pairs(docs, rows):
    found = jaccard.link_documents(docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, *_ in rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows)


def test_links_by_two_levels(docs, monkeypatch):
    """An exchange cut to few rows a batch, merged and cut again, gives the same links."""
    whole = sorted(map(repr, jaccard.link_documents(docs).collect()))
    monkeypatch.setattr(packed, "MERGED", 1)
    assert packed.Fan(64, 8).groups > 1
    for fan_out in (8, 50):
        assert sorted(map(repr, jaccard.link_documents(docs, fan_out).collect())) == whole


def test_rows_of_a_batch_are_bounded(monkeypatch):
    """However many buckets there are, a batch is cut into FAN rows at most, and coarse buckets hold whole fine ones."""
    for module in (jaccard, suffix):
        monkeypatch.setattr(module, "batch_number", lambda k: k)
    rng = np.random.default_rng(2)
    text = " ".join(sentence(random.Random(1), 10) for _ in range(3000))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["row", "text"])
    for buckets in (128, 5_000, 200_000, 1 << 20):
        fan = packed.Fan(buckets)
        assert fan.fine >= buckets and fan.per <= packed.FAN
        for rows in (jaccard.shingle_rows(fan.coarse)(iter([batch.select(["text"])])), suffix.anchor_rows(fan.coarse)(iter([batch]))):
            assert sum(len(x) for x in rows) <= packed.FAN
        h = rng.integers(0, 1 << 63, 10_000, np.int64).view(np.uint64) * np.uint64(3)
        assert (packed.bucket_of(h, fan.fine) // fan.per == packed.bucket_of(h, fan.coarse)).all()
        assert (packed.block_of(h.view(np.int64), fan.fine) % fan.coarse == packed.block_of(h.view(np.int64), fan.coarse)).all()


def test_links_in_chains_and_crowds(spark):
    import random

    rng = random.Random(5)
    base = sentence(rng, 60).split(" ")
    rows = []
    for i in range(120):  # near copies that drift away, so that distant ones link only through others
        base = list(base)
        base[rng.randrange(len(base))] = f"w{i}"
        rows.append((500 - i, " ".join(base), "a"))
    crowd = sentence(rng, 40)
    rows += [(1000 + i, crowd + " " + sentence(rng, 3 + i % 40), "b") for i in range(80)]  # one passage in all of them
    found = jaccard.link_documents(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows)


def test_one_of_a_group_stays(docs, rows):
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted({i for i, (_, c) in brute_components(rows).items() if i == c})


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}
            if good[kind]:
                spans.append((m.start(), rank, m.end(), kind))
    return sorted(spans)


PERSONAL = [
    "write to a.b+c@x-1.example.org, or a@b.c_d@e.f now é 1.2.3.4 and 256.1.1.1 and 1.2.3.4.5.6.7.8",
    "card 4539 1488 0343 6467 or 4539148803436467, not 4539148803436468; 1-2 3 4539-1488-0343-6467 9",
    "+1 (555) 123-4567 and +12 and +123456789012345678 (+49 30 1234567)",
    "@@ a@ @b a@b a@b. .@..c x@y.z.. 0001.002.03.4 999999999999999999999.1.1.1",
    "7" * 70_000,
    "a" * 70_000 + "@b.c",
    "1 " * 5_000,
    "",
    None,
    "é" * 10 + "x@y.zz\n10.0.0.1",
]


def test_base_spans_match_the_patterns(spark):
    found = personal.find_personal(documents(spark, [(i, t, "a") for i, t in enumerate(PERSONAL)]))
    for r in found.collect():
        assert [(s.start, s.rank, s.end, s.kind) for s in r.base] == base_spans(PERSONAL[r.doc_id] or ""), r.doc_id


def test_contexts_find_what_patterns_do_not(spark):
    rows = [(i, f"text {i} and reach me under pager: user{i}@host{i}.example.org today", "a") for i in range(20)]
    rows += [(100, "reach me under pager: bob@intranet today", "a"), (101, "the number 12345678 of things", "a"), (102, "at 55 of them", "b")]
    found = {r.doc_id: r.found for r in personal.find_personal(documents(spark, rows)).collect()}
    assert [(s.start, s.end, s.kind) for s in found[100]] == [(22, 34, "email")]
    assert not found[101] and not found[102] and not found[0]


def test_words_with_digits_are_context(spark):
    rows = [(i, f"call {i}a desk{i % 9} user{i}@host{i}.example.org 4u", "a") for i in range(20)]
    rows += [(100, "call 77a desk3 bob@intranet 5u", "a"), (101, "the 3 12345678 9 of things", "a")]
    found = {r.doc_id: r.found for r in personal.find_personal(documents(spark, rows)).collect()}
    assert [(s.start, s.end, s.kind) for s in found[100]] == [(15, 27, "email")]
    assert not found[101] and not found[0]


def test_contexts_name_secrets(spark):
    rng = __import__("random").Random(4)
    hexed = lambda: hashlib.sha1(str(rng.random()).encode()).hexdigest()
    rows, planted = [], {}
    for i in range(30):
        head = sentence(rng, rng.randint(0, 40)) + ' key: "'
        planted[i] = (len(head), len(head) + 40, "secret")
        rows.append((i, head + hexed() + '"!! ' + sentence(rng, 9), "a"))
    rows += [(100, 'so key: "Zq81-99x0-7" here', "a"), (101, f"commit {hexed()} of it", "a"), (102, "an order 12345678 and 555 1234 5678 9", "a")]
    rows += [(103, " ".join(f"{k} {k * 7919}" for k in range(20_000)), "a"), (104, "w" * 300_000 + " 1234567 " + "." * 200_000, "a")]
    found = {r.doc_id: [tuple((s.start, s.end, s.kind)) for s in r.found] for r in personal.find_personal(documents(spark, rows)).collect()}
    assert {i: [x] for i, x in planted.items()} == {i: found[i] for i in planted}
    assert found[100] == [(9, 20, "secret")] and not any(found[i] for i in (101, 102, 103, 104))


def test_redacted_texts(spark):
    rows = [(1, "mail x@y.zz and 10.0.0.1.", "a"), (2, None, "a"), (3, "clean", "b"), (3, "clean", "b"), (4, "ab@c.de", None)]
    out = personal.redact(documents(spark, rows))
    assert out.columns == documents(spark, rows).columns
    assert sorted((r.doc_id, r.text or "-") for r in out.collect()) == [(1, "mail [EMAIL] and [IP]."), (2, "-"), (3, "clean"), (3, "clean"), (4, "[EMAIL]")]


def test_texts_without_spans_pass_redaction_unmoved(spark):
    rows = [(1, "1.2.3.4", "a"), (2, "a\n@b.c", "a"), (3, "12 34 no", "a"), (4, "x" * 50, "a"), (5, "+1 (2) 3456-789", "b"), (6, None, "b")]
    out = personal.redact(documents(spark, rows))
    assert {r.doc_id: r.text for r in out.collect()} == {1: "[IP]", 2: "a\n@b.c", 3: "12 34 no", 4: "x" * 50, 5: "[PHONE]", 6: None}
    below = out._jdf.queryExecution().analyzed().toString()
    assert below.startswith("Union") and "Join" not in below[below.rindex("Filter NOT") :]


def test_hashes_are_counted_in_turns(docs, monkeypatch):
    seen = []

    def kept(df, name, write=jaccard.materialise):
        out = write(df, name)
        if name == "jaccard-answer":
            seen.append({r.bucket for r in out.select("bucket").collect()})
        return out

    monkeypatch.setattr(jaccard, "materialise", kept)
    jaccard.link_documents(docs).collect()
    assert len(seen) > 1 and sum(map(len, seen)) == len(set().union(*seen)) > max(map(len, seen))


def test_media_round_trip(docs, rows):
    stored = media.encode_media(docs)
    found = media.media_features(stored).collect()
    texts = {i: (t or "").encode() for i, t, _ in rows}
    for r in found:
        raw = texts[r.doc_id]
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    blocks = media.decode_media(stored.filter("doc_id in (1006, 1008)")).collect()
    for i in (1006, 1008):
        own = sorted((r.sample_offset, bytes(r.pcm), r.n_samples) for r in blocks if r.doc_id == i)
        assert b"".join(x[1] for x in own).rstrip(b"\0") == texts[i] and all(len(p) == n for _, p, n in own)
        assert [o for o, *_ in own] == list(np.cumsum([0] + [n for *_, n in own])[:-1])


@pytest.mark.parametrize("seed", range(4))
def test_flac_frames(seed):
    rng = np.random.default_rng(seed)
    rows = [rng.integers(0, 256, int(rng.integers(1, 60)) * 64, dtype=np.uint8) for _ in range(5)]
    rows += [np.full(2048, 7, np.uint8), (np.cumsum(rng.integers(-2, 3, 3200)) + 128).astype(np.uint8), np.tile(np.arange(256, dtype=np.uint8), 9), np.where(rng.random(1024) < 0.01, 255, 128).astype(np.uint8)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    payload = np.concatenate(rows)
    streams = media.encode(payload, offsets)
    samples, found, sizes, counts = media.decode(streams)
    assert (samples == payload).all() and (found == offsets).all()
    for k, at in enumerate((60, len(streams[0]) // 2, len(streams[0]) - 1)):
        broken = bytearray(streams[0])
        broken[max(at, 70)] ^= 1 << k
        with pytest.raises((media.Corrupt, ValueError, IndexError)):
            media.decode([bytes(broken)])


def test_mix_follows_targets(spark):
    import random

    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randint(0, 60)) if i % 9 else None, rng.choice(["a"] * 6 + ["b", "c", "é", None])) for i in range(1500)]
    drawn = mixing.draw(documents(spark, rows)).select("_row.doc_id", "_row.source", "_row.size", mixing.F.col("size").alias("words"), "source_size", "target", "copies").collect()
    again = mixing.draw(documents(spark, rows)).select("_row.doc_id", "copies").collect()
    assert sorted((r.doc_id, r.copies) for r in drawn) == sorted((r.doc_id, r.copies) for r in again)
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, full, rest = {}, set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            full.add(s)
            target[s] = 2 * sizes[s]
            rest -= target[s]
    taken = Counter()
    for r in drawn:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target) and 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.words
    assert all(abs(taken[s] - target[s]) <= 130 for s in sizes)


def test_mix_repeats_whole_rows(docs, nothing):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == mixing.draw(docs).agg({"copies": "sum"}).first()[0]
    assert mixing.mixed(nothing).count() == 0


def test_pieces_hold_each_id_once(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    found = packing.pack(docs).collect()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t, _ in rows}
    total = sum(len(ids[i]) for i, *_ in rows)
    ends = Counter()
    for r in found:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        ends[r.doc_id] += r.length
    assert ends == Counter({i: len(ids[i]) * k for i, k in Counter(i for i, *_ in rows).items()})
    spots = sorted((r.sequence_id * 4096 + r.offset, r.length) for r in found)
    assert [s for s, _ in spots] == list(np.cumsum([0] + [n for _, n in spots])[:-1]) and spots[-1][0] + spots[-1][1] == total


def test_words_with_the_mark_and_odd_spaces():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encode = packing.Encoder(path)
    for text in ("a • b •c• d", "x y z Σας İstanbul é ﬁ 12.5 don't", "<|endoftext|> <|startoftext|>x", "\x00 \x0b q"):
        raw = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = packing.words(raw, np.array([0, len(raw)]))
        ids, _ = encode(raw, starts, ends)
        assert ids.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_end_and_start_marks_in_a_text_are_their_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    text = "one<|endoftext|>two <|startoftext|> <|ENDOFTEXT|> three•<|endoftext|>"
    want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids
    assert want.count(49407) == 2 and want.count(49406) == 1
    (r,) = packing.pack(documents(spark, [(1, text, "a")])).collect()
    assert r.doc_tokens == len(want) + 1 and r.ids_crc32 == zlib.crc32(np.array([*want, 2], "<u4").tobytes())


def test_edited_fingerprints(docs, rows):
    whole = sorted({(i, t or "") for i, t, _ in rows}, reverse=True)
    repeated = [rows[0][0]]
    found = {r.doc_id: r for r in digest.edited_fingerprints(docs).collect()}
    for k, (i, text) in enumerate(whole):
        after = whole[(k + 1) % len(whole)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[i]
        assert r.n_chars == len(text) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if i not in repeated and whole[(k + 1) % len(whole)][0] not in repeated:
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if text == after:
            assert r.near_next == 1
    by_text = defaultdict(set)
    for i, text in whole:
        by_text[text].add(found[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_likeness_is_bounded_and_ordered():
    import random

    rng = random.Random(1)
    a, b = sentence(rng, 300), sentence(rng, 300)
    mixed = a[: len(a) * 3 // 4] + b[: len(b) // 4]
    d = digest.text_digests([x.encode() for x in (a, mixed, b, a, "")])
    near = lambda i, j: float(digest.likeness(d[i : i + 1], d[j : j + 1])[0])
    assert near(0, 3) == 1 and near(0, 1) > near(0, 2) and all(0 <= near(i, j) <= 1 for i in range(5) for j in range(5))


def test_quality_learns_lines(spark):
    import random

    rng = random.Random(3)
    rows = []
    for i in range(400):
        lines = [sentence(rng, 12).capitalize() + "." for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            lines[-1:] = ["BUY!! NOW!! " * 6] * 3
        rows.append((i, "\n".join(lines), "a"))
    rows += [(900, None, "a"), (901, "", "a"), (902, "\n \n", None), (903, "x" * 90_000, "a")]
    table_ = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(400)] + [(0, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r.score for r in quality.score_quality(table_, labels).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((found[i] >= 0.5) == (i % 3 != 0) for i in held) >= 0.97 * len(held)
    assert found[900] == found[901] == found[902] == 0 and all(0 <= s <= 1 for s in found.values())
    kept = quality.keep_good(table_, labels)
    assert kept.columns == table_.columns and sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(i for i, s in found.items() if s >= 0.5)
    assert {r.score for r in quality.score_quality(table_, labels.limit(0)).collect()} == {0.0, 0.5}
    again = quality.fit(table_.unionByName(table_.filter("doc_id < 50")), labels)  # repeated documents don't enlarge the sample
    assert again.values() == quality.fit(table_, labels).values()
    assert quality.fit(table_, labels, most=60) is not None


def test_sample_features_come_in_pieces():
    texts = ["a line of words\nand another one\n" * (1 + i % 5) for i in range(40)] + ["", "x" * (3 << 20), "one line"]
    one = lambda some: [r for b in quality.sample_rows(iter([pa.record_batch([pa.array(range(len(some))), pa.array([1] * len(some), pa.int32()), pa.array(some)], ["d", "q", "t"])])) for r in b.to_pylist()]
    together, apart = one(texts), [r for x in texts for r in one([x])]
    assert [(r["n_lines"], r["sizes"], r["features"]) for r in together] == [(r["n_lines"], r["sizes"], r["features"]) for r in apart]


def test_marginals_match_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    counts = np.array([3, 0, 1, 4])
    score, turn = rng.normal(size=8), rng.normal(size=(2, 2))
    found = quality.marginals(score, turn, counts)
    at = 0
    for n in counts:
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(score[at + k] for k in range(n) if y[k]) + sum(turn[y[k], y[k + 1]] for k in range(n - 1)))
            total += w
            good += w * np.array(y)
        assert np.allclose(found[at : at + n], good / total)
        at += n


@pytest.mark.parametrize("run", [lambda d: suffix.remove_repeats(d), lambda d: jaccard.link_documents(d), lambda d: jaccard.keep_first(d), lambda d: personal.find_personal(d), lambda d: personal.redact(d), lambda d: media.media_features(media.encode_media(d)), lambda d: packing.pack(d), lambda d: digest.edited_fingerprints(d), lambda d: digest.fingerprints(d)])
def test_empty_tables(nothing, run):
    assert run(nothing).count() == 0


def test_null_ids(spark):
    rows = [(None, "some words that are here in this text of nobody", None), (None, None, None), (3, "some words that are here in this text of nobody", "a")]
    table_ = documents(spark, rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffix.remove_repeats(table_).collect()) == [("3", 47, 0), ("None", 0, 0), ("None", 47, 0)]
    assert sorted(str(r.component_id) for r in jaccard.link_documents(table_).collect()) == ["3", "3", "None"]
    assert sorted(str(r.doc_id) for r in jaccard.keep_first(table_).collect()) == ["3", "None"]
    assert personal.find_personal(table_).count() == 3 and mixing.draw(table_).count() == 3
    assert packing.pack(table_).count() == 3 and digest.edited_fingerprints(table_).count() == 3
    assert media.media_features(media.encode_media(table_)).count() == 3


def test_rows_of_one_id_are_judged_apart(spark):
    shared, own = "x" + "these words stand in all of the texts of this table, each of them " * 2, "and this one has more words of its own "
    rows = [(5, shared, "a"), (5, own + shared, "a"), (5, shared, "a"), (7, shared, "b"), (None, shared, "b"), (9, own * 3, "b")]
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffix.remove_repeats(documents(spark, rows)).collect())
    n, m = len(shared), len(own)
    assert found == sorted([("5", n, 0), ("5", n + m, 0), ("5", n, 0), ("7", n, n), ("None", n, 0), ("9", 3 * m, 0)])
    kept = jaccard.keep_first(documents(spark, [(5, shared, "a"), (5, shared + "more", "a"), (None, shared, "a"), (None, shared, "a"), (None, None, "a")]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "None"]
