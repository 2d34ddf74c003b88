"""The corpus operators against brute force, on small tables with nulls, empty texts, ties, repeated rows and more."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from isohyet.llm import common, components, counting, fingerprints, media, mixing, packing, quality, sharding, simhash, sstable, suffixes, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = tokens.vocabulary_path("word_bpe_49k.json")


def _texts(n: int, seed: int = 1) -> list[str]:
    """Prose with passages that repeat, near copies, other scripts and a very long text."""
    rng = random.Random(seed)
    words = ["rain", "Wind", "the", "of", "nuage", "Été", "straße", "cañón", "data,", "index.", "a", "1998", "it's", "x|y"]
    passage = " ".join(rng.choice(words) for _ in range(60))
    out = []
    for k in range(n):
        text = " ".join(rng.choice(words) + rng.choice(["", "a", "zz", "q9"]) for _ in range(rng.randint(1, 120)))
        if k % 5 == 0:
            text = text[: len(text) // 2] + "\n" + passage[rng.randint(0, 40) :] + " " + text[len(text) // 2 :]
        if k % 11 == 3 and out:
            text = rng.choice(out)
        if k % 13 == 4 and out:
            text = rng.choice(out) + " more"
        out.append(text)
    out[1] = "日本語 の 文章。 Σίσυφος \x1c\x85 ﻿ <|endoftext|> ́é" * 3
    out[2] = " ".join(rng.choice(words) for _ in range(30_000))
    return out


@pytest.fixture(scope="module")
def rows():
    texts = _texts(120)
    docs = [(k * 3, t, "en" if k % 3 else None, "hot" if k % 3 == 0 else f"s{k % 4}" if k % 7 else None, len(t)) for k, t in enumerate(texts)]
    docs += [(1000, None, "fr", "s1", None), (1001, "", None, None, 0), (1002, "   \n\t ", "de", "s2", 6), (1003, "x", "en", "hot", 1)]
    random.Random(7).shuffle(docs)
    return docs


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows and columns whose names clash with those that operators add."""
    rows = [(None, "no id " * 40, "en", "a", 1), (None, "no id " * 40, "en", "a", 1), (5, "same row " * 30, None, None, 2), (5, "same row " * 30, None, None, 2), (7, None, "en", None, None)]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as size", "2 as shard", "3 as block", "4 as fp", "5 as root", "6 as start", "7 as bucket", "8 as digest", "9 as form", "10 as component_id", "11 as score", "12 as mark")


def _ids(text: str | None) -> np.ndarray:
    from tokenizers import Tokenizer

    _ids.tokenizer = getattr(_ids, "tokenizer", None) or Tokenizer.from_file(WORD)
    return np.array([*_ids.tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


def test_ids_are_the_librarys():
    coder = tokens.PreTokenEncoder(WORD)
    rng = random.Random(3)
    for text in [*_texts(30), *("".join(chr(rng.randrange(256)) for _ in range(40)) for _ in range(300)), *("".join(chr(rng.choice([rng.randrange(0x250), rng.randrange(0x3000)])) for _ in range(20)) for _ in range(300))]:
        assert coder.encode(text) == _ids(text)[:-1].tobytes(), repr(text)


# --- packing ---------------------------------------------------------------------------------------------------------


def _check_packed(found, want: Counter):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    got = Counter()
    for doc, rs in pieces.items():
        for r in rs:
            got[doc, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    expected = Counter()
    for (doc, text), n in want.items():
        ids, at = _ids(text), 0
        for length in packing.cut(len(ids), packing.CAPACITY):
            expected[doc, at, length, zlib.crc32(ids[at : at + length].tobytes()), len(ids)] += n
            at += length
        assert at == len(ids)
    assert got == expected
    return sequences


def test_packing(docs, rows, odd, empty):
    sequences = _check_packed(packing.pack(docs, WORD).collect(), Counter((r[0], r[1]) for r in rows))
    total = sum(r.length for rs in sequences.values() for r in rs)
    assert len(sequences) == -(-total // packing.CAPACITY)
    _check_packed(packing.pack(odd, WORD).collect(), Counter((r.doc_id, r.text) for r in odd.collect()))
    assert packing.pack(empty, WORD).count() == 0


def test_cuts_fill_their_bins():
    for n in [*range(1, 300), 4095, 4096, 4097, 100_003]:
        parts = packing.cut(n, 4096)
        assert sum(parts) == n and all(4096 % p < max(1, 4096 // p) or p * p <= 4096 for p in parts)
        assert all((4096 - 4096 // p * p) <= 64 for p in parts)


# --- media -----------------------------------------------------------------------------------------------------------


def test_media(spark, docs, rows, odd, empty):
    for table in (docs, odd):
        manifest = media.store(table, common.new_folder(spark, "test-media")).collect()
        found = media.describe(media.read_archives(spark, [r.path for r in manifest], 2000)).collect()
        want = []
        for r in table.collect():
            raw = (r.text or "").encode()
            full = raw + bytes(-len(raw) % 64 if raw else 64)
            image = media.to_png(full)
            want.append((r.doc_id, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]), len(image), hashlib.sha256(image).hexdigest(), media.feature(full)))
        assert Counter(map(tuple, found)) == Counter(want)
    assert media.store(empty, common.new_folder(spark, "test-media")).count() == 0
    assert media.describe(media.read_archives(spark, [])).count() == 0


def test_many_archives(spark):
    """A thousand archives: the reader's ranges come from the line's length alone; a damaged member fails by itself."""
    texts = [f"text {k} " * (k % 7 + 1) for k in range(1000)]
    table = spark.createDataFrame([(k, t, None, None, 0) for k, t in enumerate(texts)], SCHEMA).repartition(8)
    manifest = media.store(table, common.new_folder(spark, "test-media"), archive_bytes=1)
    assert manifest.count() == 1000
    for step in (100, 1_000_000):
        found = media.read_archives(spark, manifest, step)
        assert sorted((r.doc_id, r.n_bytes) for r in media.describe(found).collect()) == sorted((k, len(t)) for k, t in enumerate(texts))
    assert found.rdd.getNumPartitions() == 1
    source = media._Reader({"manifest": "nowhere", "totalbytes": "1000", "rangebytes": "300"})
    assert [(p.low, p.high) for p in source.partitions()] == [(0, 300), (300, 600), (600, 900), (900, 1000)]
    large = media._Reader({"manifest": "nowhere", "totalbytes": str(10**14)}).partitions()
    assert len(large) == media.RANGES and large[0].low == 0 and large[-1].high == 10**14
    assert all(p.high == q.low for p, q in zip(large, large[1:]))
    bad = manifest.first().path
    fs, inner = common.open_fs(bad)
    with fs.open_input_file(inner) as file:
        raw = bytearray(file.read())
    raw[60] ^= 255
    with fs.open_output_stream(inner) as file:
        file.write(bytes(raw))
    with pytest.raises(Exception, match="no member at 0"):
        media.read_archives(spark, [bad]).collect()
    others = manifest.filter(F.col("path") != bad)
    assert media.read_archives(spark, others).count() == 999


def test_members_are_read_again_by_offset(tmp_path):
    data, calls = b"header" * 10, []
    (tmp_path / "a.zip").write_bytes(b"")
    archive = media._Archive(f"file://{tmp_path}/a.zip")
    archive.add("1_1_1.png", data)
    archive.add("2_2_2.png", data[::-1])
    archive.close()
    raw = (tmp_path / "a.zip").read_bytes()

    class Flaky:
        def __init__(self, bad):
            import io

            self.file, self.bad = io.BytesIO(raw), bad

        def seek(self, at):
            self.file.seek(at)

        def read(self, n=-1):
            got = self.file.read(n)
            return got[:-1] if self.bad and n > 30 else got

    listed = list(media.members(Flaky(False), len(raw)))
    assert [m[0] for m in listed] == ["1_1_1.png", "2_2_2.png"]
    name, start, stored, crc = listed[1]
    assert media.read_member(lambda anew: calls.append(anew) or Flaky(not anew), start, stored, crc) == data[::-1]
    assert calls == [False, True]
    with pytest.raises(OSError):
        media.read_member(lambda anew: Flaky(True), start, stored, crc)


# --- fingerprints ----------------------------------------------------------------------------------------------------


def test_fingerprints(docs, rows, odd, empty):
    found = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    ordered = sorted(rows)
    assert len(found) == len(rows)
    for (doc, text, *_), (_, following, *_) in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        text, following = text or "", following or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = found[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        form = fingerprints.canonical
        assert r.digest == xxhash.xxh3_128_hexdigest(form(text)) and r.edited_digest == xxhash.xxh3_128_hexdigest(form(edited))
        assert (r.near_edited, r.near_next) == (float(form(text) == form(edited)), float(form(text) == form(following)))
    buckets = Counter(r.digest for r in found.values())
    assert max(buckets.values()) > 1 and all((r.form is not None) == (buckets[r.digest] > 1) for r in found.values())
    assert fingerprints.edited_fingerprints(odd).count() == odd.count()
    assert fingerprints.edited_fingerprints(empty).count() == 0
    assert fingerprints.canonical("Ｆull  WIDTH ﬁ\n") == b"full width fi"


@pytest.mark.parametrize("bits", [4, 128])
def test_forced_collisions(docs, rows, bits):
    """Fingerprints, edited ones among them, are equal exactly where canonical forms are, however many share a digest."""
    ordered = sorted(rows)
    by_form: dict = defaultdict(set)
    by_print: dict = defaultdict(set)
    found = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs, bits).collect()}
    for (doc, text, *_), (_, following, *_) in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        text, following = text or "", following or ""
        cut = len(text) // 4
        for form, value in ((text, found[doc].fingerprint), (text[: len(text) - cut] + following[:cut], found[doc].edited_fingerprint)):
            by_form[fingerprints.canonical(form)].add(value)
            by_print[value].add(fingerprints.canonical(form))
    assert all(len(x) == 1 for x in (*by_form.values(), *by_print.values()))
    assert len({p.split("-")[0] for p in by_print}) == (16 if bits == 4 else len(by_form))


def test_one_row_follows_itself(spark):
    one = spark.createDataFrame([(1, "abcdefgh", "en", "a", 8)], SCHEMA)
    r = fingerprints.edited_fingerprints(one).first()
    assert (r.near_edited, r.near_next) == (0.0, 1.0) and r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_collisions_are_told_apart(spark):
    forms = spark.createDataFrame([("d", b"one"), ("d", b"one"), ("d", b"two"), ("e", b"x"), ("e", b"x")], "digest string, form binary")
    assert [(r.digest, bytes(r.form), r.ordinal) for r in fingerprints.resolve(forms).collect()] == [("d", b"two", 1)]


# --- mixing ----------------------------------------------------------------------------------------------------------


def _targets(sizes: dict, weights=(3, 1, 2), share=1.5, top=2.0) -> dict:
    keys = sorted(sizes, key=lambda k: (k is None, (k or "").encode()))
    weight = {k: weights[i % len(weights)] for i, k in enumerate(keys)}
    fixed, left = {}, share * sum(sizes.values())
    while True:
        free = [k for k in keys if k not in fixed]
        if not free:
            return fixed
        rest = left - sum(fixed.values())
        level = rest / sum(weight[k] for k in free)
        over = [k for k in free if level * weight[k] > top * sizes[k]]
        if not over:
            return {**fixed, **{k: level * weight[k] for k in free}}
        fixed.update({k: top * sizes[k] for k in over})


def test_mixing(docs, rows, odd, empty):
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size[r[0]]
    want = _targets(sizes)
    found = mixing.mix(docs, shards=6).collect()
    assert len(found) == len(rows)
    source = {r[0]: r[3] for r in rows}
    taken, largest = Counter(), Counter()
    for r in found:
        key = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sizes[key] and r.target == pytest.approx(want[key])
        assert len(r.shards) <= 2 and all(0 <= s < 6 for s in r.shards)
        taken[key] += r.size * len(r.shards)
        largest[key] = max(largest[key], r.size)
    assert all(abs(taken[k] - want[k]) <= largest[k] / 2 + 1e-6 for k in sizes)
    again = mixing.mix(docs.repartition(3), shards=6).collect()
    assert sorted((r.doc_id, r.shards) for r in again) == sorted((r.doc_id, r.shards) for r in found)
    copies = mixing.materialise(docs, mixing.mix(docs, shards=6))
    assert Counter(r.doc_id for r in copies.collect()) == Counter({r.doc_id: len(r.shards) for r in found if r.shards})
    narrow = docs.withColumn("doc_id", docs.doc_id.cast("int"))
    assert mixing.materialise(narrow, mixing.mix(narrow, shards=6)).count() == copies.count()
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(empty).count() == 0


def test_tree_meets_quotas(spark):
    tickets = spark.range(1000).selectExpr("case when id < 300 then 'a' when id < 900 then 'b' end as source", "id as block", "1 as copy")
    for shards in (1, 5, 8):
        counts = {r.shard: r["count"] for r in mixing.split(tickets, shards).groupBy("shard").count().collect()}
        assert set(counts) == set(range(shards)) and max(counts.values()) - min(counts.values()) <= 3


# --- counts ----------------------------------------------------------------------------------------------------------


def test_longest_match(docs, rows, odd, empty):
    pieces = counting.model_pieces(tokens.vocabulary_path("piece_bpe_32k.model"))
    known, longest = set(pieces), max(map(len, pieces))
    found = {r.doc_id: r for r in counting.count_pieces(docs, tokens.vocabulary_path("piece_bpe_32k.model")).collect()}
    for doc, text, *_ in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        counts = [counting.greedy_count(known, longest, counting.WORD_START + w) for w in words]
        assert (found[doc].n_words, found[doc].n_pieces, found[doc].max_word_pieces) == (len(words), sum(counts), max(counts, default=0))
    assert counting.count_pieces(odd, tokens.vocabulary_path("piece_bpe_32k.model")).count() == odd.count()
    assert counting.count_pieces(empty, tokens.vocabulary_path("piece_bpe_32k.model")).count() == 0


def test_automaton_on_random_vocabularies():
    rng = random.Random(5)
    for _ in range(30):
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(25)]
        match, known = counting.LongestMatch(pieces), set(pieces)
        for _ in range(50):
            word = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 25)))
            assert match.count(word) == counting.greedy_count(known, 6, word)


# --- sharding --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve(spark, dims, bits):
    cells = spark.range(1 << dims * bits).select(*((F.shiftright("id", k * bits).bitwiseAND(F.lit((1 << bits) - 1))).cast("int").alias(f"c{k}") for k in range(dims)))
    path = [r[:-1] for r in sorted(cells.select("*", sharding.hilbert_index([F.col(f"c{k}") for k in range(dims)], bits).alias("at")).collect(), key=lambda r: r[-1])]
    assert len(set(path)) == 1 << dims * bits
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_sharding(docs, rows, odd, empty, law):
    found = sharding.shard_rows(docs, 7, law).collect()
    text = {r[0]: (r[1] or "").encode() for r in rows}
    shards = defaultdict(list)
    for r in found:
        assert (r["size"], r.text_crc32) == (len(text[r.doc_id]) + 16, zlib.crc32(text[r.doc_id]))
        shards[r.shard].append(r)
    assert len(found) == len(rows)
    for rs in shards.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    if law == "rows":
        counts = [len(rs) for rs in shards.values()]
        assert len(counts) == 7 and max(counts) - min(counts) <= 1
    else:
        each = sum(len(t) + 16 for t in text.values()) / 7
        assert all(abs(sum(r["size"] for r in rs) - each) <= max(map(len, text.values())) + 16 for rs in shards.values())
    order = [r.curve for r in sorted(found, key=lambda r: r.rank)]
    assert order == sorted(order)
    assert sharding.shard_rows(odd, 3, law).count() == odd.count() and sharding.shard_rows(empty, 3, law).count() == 0


# --- suffixes --------------------------------------------------------------------------------------------------------


def _brute_repeats(ordered: list[tuple]) -> dict:
    seen, out = set(), {}
    for doc, text in ordered:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            w = raw[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out[doc] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(docs, rows, odd, empty):
    found = {r.doc_id: tuple(r)[1:] for r in suffixes.repeat_report(docs).collect()}
    want = _brute_repeats([(r[0], r[1]) for r in sorted(rows, key=lambda r: r[0])])
    assert found == want and sum(v[1] for v in want.values()) > 1000
    got = sorted(r.n_removed for r in suffixes.repeat_report(odd).collect())
    assert len(got) == odd.count()
    assert suffixes.repeat_report(empty).count() == 0
    cut = {r.doc_id: r for r in suffixes.cut_repeats(docs).collect()}
    for doc, text, *_ in rows:
        assert (cut[doc].text is None) == (text is None)
        assert text is None or len(text.encode()) - len(cut[doc].text.encode()) <= want[doc][1]


@pytest.mark.parametrize(
    "files, limits",
    [
        (3, suffixes.Limits()),  # all contexts are sorted
        (3, suffixes.Limits(given=10)),  # hot in every file: contexts are dealt by themselves, then windows
        (9, suffixes.Limits(given=15, sorted=20)),  # hot in no file, but over all
        (9, suffixes.Limits(given=25, files=2)),  # several groups of files: hot in some, found by others
        (9, suffixes.Limits(given=1000, files=3)),
    ],
)
def test_hot_anchors(spark, files, limits):
    """A passage between different words in every document: its edges stand in as many contexts."""
    rng = random.Random(12)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(90, 200))) + passage[: rng.randint(150, 200)] + "".join(rng.choice("xyz ") for _ in range(150)) for _ in range(130)]
    texts += rng.sample(texts, 20)
    table = spark.createDataFrame([(k, t, None, None, 0) for k, t in enumerate(texts)], SCHEMA).repartition(files)
    assert {r.doc_id: tuple(r)[1:] for r in suffixes.repeat_report(table, limits).collect()} == _brute_repeats(list(enumerate(texts)))


def test_levels_of_buckets(spark, monkeypatch):
    """Several groups of files and very many buckets: the first grouping takes fewer, and results are the same."""
    monkeypatch.setattr(suffixes, "PER_BUCKET", 40)
    rng = random.Random(13)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 120))) for _ in range(150)]
    texts += [rng.choice(texts)[20:] + " " + rng.choice(texts) for _ in range(50)]
    table = spark.createDataFrame([(k, t, None, None, 0) for k, t in enumerate(texts)], SCHEMA).repartition(9)
    want = _brute_repeats(list(enumerate(texts)))
    for limits in (suffixes.Limits(), suffixes.Limits(files=2), suffixes.Limits(files=4, given=3)):
        assert {r.doc_id: tuple(r)[1:] for r in suffixes.repeat_report(table, limits).collect()} == want


def test_what_goes_on_is_packed_by_bucket():
    """A row for each bucket of the second grouping, not for each file, and nothing is lost on the way."""
    rng = np.random.default_rng(4)
    x = np.zeros(3000, dtype=suffixes._ANCHOR)
    x["h"], x["ctx"], x["doc"], x["lo"] = rng.integers(0, 1 << 62, 3000), rng.integers(0, 1 << 62, 3000), np.arange(3000), 3
    rows = [(0, f, suffixes._SORTED, b"".join(np.ascontiguousarray(x[f::100][c]).tobytes() for c in x.dtype.names)) for f in range(100)]
    (found,) = suffixes._group_anchors(iter([suffixes._found(rows)]), False, suffixes.Limits(), 7)
    assert found.column("bucket").to_pylist() == list(range(7)) and set(found.column("kind").to_pylist()) == {suffixes._ON}
    seen = set()
    for bucket, blob, files in zip(*(found.column(c).to_pylist() for c in ("bucket", "blob", "files"))):
        own = suffixes._unpack(blob, suffixes._ANCHOR)
        assert (own["h"] % np.uint64(7) == bucket).all()
        seen |= set(zip(np.frombuffer(files, "<u4").tolist(), own["doc"].tolist()))
    assert seen == {(k % 100, k) for k in range(3000)}


def test_many_contexts_are_dealt(spark):
    """What a piece and a group give for one anchor stays within the limits, and says so where it would not."""
    rng = np.random.default_rng(3)
    x = np.zeros(600, dtype=suffixes._ANCHOR)
    x["h"], x["ctx"], x["doc"], x["lo"] = np.repeat([5, 6, 7], 200), rng.integers(0, 1 << 62, 600), np.arange(600), 3
    rows = [(0, f, suffixes._SORTED, b"".join(np.ascontiguousarray(x[f::4][c]).tobytes() for c in x.dtype.names)) for f in range(4)] + [(0, 9, suffixes._HOT, np.array([6], dtype="<u8").tobytes())]

    def kinds(last, limits):
        (found,) = suffixes._group_anchors(iter([suffixes._found(rows)]), last, limits)
        out = defaultdict(int)
        for kind, blob in zip(found.column("kind").to_pylist(), found.column("blob").to_pylist()):
            out[kind] += len(blob)
        return dict(out)

    edge, anchor = suffixes._EDGE.itemsize, suffixes._ANCHOR.itemsize
    assert kinds(True, suffixes.Limits()) == {suffixes._SORTED: 400 * edge, suffixes._DEALT: 200 * edge}
    assert kinds(True, suffixes.Limits(sorted=100)) == {suffixes._DEALT: 600 * edge}
    assert kinds(False, suffixes.Limits(given=200)) == {suffixes._DEALT: 200 * edge, suffixes._ON: 400 * anchor, suffixes._HOT_ON: 8}
    assert kinds(False, suffixes.Limits(given=199)) == {suffixes._DEALT: 600 * edge, suffixes._HOT_ON: 24}


def test_periodic_texts(spark):
    """Texts whose every window has equal ones nearby, in long runs."""
    texts = ["ab" * 150, "ab" * 90 + "c" + "ab" * 90, "a" * 400, "a" * 99, "a" * 100, "xyz" * 200 + "w" * 200, "w" * 150 + "xyz" * 100]
    df = spark.createDataFrame([(k, t, None, None, 0) for k, t in enumerate(texts)], SCHEMA).repartition(4)
    assert {r.doc_id: tuple(r)[1:] for r in suffixes.repeat_report(df).collect()} == _brute_repeats(list(enumerate(texts)))


def test_long_texts_are_cut_with_an_overlap(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    rng = random.Random(9)
    body = "".join(rng.choice("abcdef ") for _ in range(3000))
    texts = [body, body[500:2600] + "!" + body[:900], body[::-1]]
    arrays = [np.frombuffer(t.encode(), dtype=np.uint8) for t in texts]
    whole = suffixes.anchors(arrays[0], np.array([3000]))
    parts = [suffixes.anchors(arrays[0][b : b + 700 + 99], np.array([len(arrays[0][b : b + 700 + 99])])) for b in range(0, 2901, 700)]
    # every window has one anchor, whether the text is cut or not
    cover = lambda found, base: {base + s: int(h) for h, _, _, lo, hi in zip(*found) for s in range(lo, hi + 1)}
    cut = {}
    for k, found in enumerate(parts):
        cut.update(cover(found, 700 * k))
    assert cut == cover(whole, 0)


def test_merge_sort_by_hashes():
    rng = np.random.default_rng(6)
    lengths = rng.integers(0, 40, 500)
    chars = rng.integers(97, 100, (500, 40)).astype(np.uint8)
    chars[np.arange(40) >= lengths[:, None]] = 0
    starts = np.array([0, 1, 3, 200, 201])
    order, common_n = suffixes.sorted_suffixes(chars, lengths, starts)
    text = [bytes(chars[k, : lengths[k]]) for k in range(500)]
    for a, b in zip(starts, [*starts[1:], 500]):
        assert [text[k] for k in order[a:b]] == sorted(text[a:b])
    for k in range(1, 500):
        if k not in starts:
            x, y = text[order[k - 1]], text[order[k]]
            assert common_n[k] == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


# --- near duplicates -------------------------------------------------------------------------------------------------


def _brute_components(fps: dict, near) -> dict:
    parent = {k: k for k in fps}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if near(fps[a], fps[b]) and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: root(k) for k in keys}


def _slow_fingerprint(text: str | None, n: int) -> int:
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + n]), 42) for k in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(docs, rows, odd, empty):
    found = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    fps = {r[0]: _slow_fingerprint(r[1], 4) for r in rows}
    want = _brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    assert {k: (r.fp % (1 << 64), r.component_id) for k, r in found.items()} == {k: (fps[k], want[k]) for k in fps}
    assert simhash.near_duplicates(odd).count() == odd.count() and simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("n, radius", [(1, 4), (300_000, 4), (200_000_000, 4), (1, 2)])
def test_tables_miss_no_pair(n, radius):
    masks, rng = simhash.tables(n, radius), random.Random(1)
    for _ in range(300):
        flipped = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not flipped & m for m in masks)


@pytest.mark.parametrize("words", [1, 4])
def test_bit_slices_count_distances(words, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE", 100)
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 64, (6, words), dtype=np.uint64)
    fps = centres[rng.integers(0, 6, 400)] ^ (np.uint64(1) << rng.integers(0, 64, (400, words)).astype(np.uint64))
    group = np.sort(rng.integers(0, 4, 400))
    group[:150] = 0
    group.sort()
    radius = 2 * words
    pairs = simhash.bucket_links(fps, group, radius)
    got = simhash._local_roots(400, pairs)
    distance = lambda a, b: sum(int(x ^ y).bit_count() for x, y in zip(a, b))
    want = _brute_components({k: (group[k], fps[k]) for k in range(400)}, lambda a, b: a[0] == b[0] and distance(a[1], b[1]) <= radius)
    assert got.tolist() == [want[k] for k in range(400)]


def test_buckets_stay_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "BATCH_ROWS", 20)
    rng = np.random.default_rng(1)
    a, b = np.sort(rng.integers(0, 6, 200)), np.zeros(200, dtype=np.int64)
    b[:] = np.concatenate([np.sort(rng.integers(0, 9, n)) for n in np.bincount(a)])
    batches = [pa.RecordBatch.from_arrays([pa.array(x[k : k + 7]) for x in (a, b, np.arange(200))], names=["a", "b", "c"]) for k in range(0, 200, 7)]
    parts = list(simhash._whole_buckets(iter(batches), 2))
    assert np.concatenate([p[2] for p in parts]).tolist() == list(range(200)) and len(parts) > 5
    buckets = [set(zip(p[0].tolist(), p[1].tolist())) for p in parts]
    assert sum(map(len, buckets)) == len(set.union(*buckets))
    assert list(simhash._whole_buckets(iter([]), 2)) == []


def test_components_of_a_long_chain(spark):
    n = 400
    order = list(range(n))
    random.Random(4).shuffle(order)
    links = spark.createDataFrame([(order[k], order[k + 1]) for k in range(n - 1)] + [(1000, 1001)], "a long, b long")
    found = {r.node: r.root for r in components.components(links).collect()}
    assert found == {**{k: 0 for k in range(1, n)}, 1001: 1000}
    assert components.components(links.limit(0)).count() == 0


def test_similar_documents(spark, odd, empty):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows, group = [], {}
    for k in range(40):
        base = words(rng.choice([60, 400]))
        for c in range(3):
            copy = list(base)
            if c:
                copy[rng.randrange(len(copy) // 2)] = "changed"
            group[len(rows)] = k
            rows.append((len(rows), " ".join(copy), None, None, 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r.component_id for r in simhash.similar_documents(docs).collect()}
    for k in found:
        assert group[found[k]] == group[k]  # different texts stay apart
    shingles = {r[0]: {tuple(r[1].split()[i : i + 5]) for i in range(len(r[1].split()) - 4)} for r in rows}
    near = [(a, b) for a in found for b in range(a) if group[a] == group[b] and len(shingles[a] & shingles[b]) >= 0.85 * len(shingles[a] | shingles[b])]
    missed = [p for p in near if found[p[0]] != found[p[1]]]
    assert len(near) > 60 and len(missed) <= len(near) // 50
    assert simhash.similar_documents(odd).count() == odd.count() and simhash.similar_documents(empty).count() == 0


# --- shards of tokens ------------------------------------------------------------------------------------------------


def test_token_shards(spark, docs, rows, odd, empty):
    manifest = sstable.write_shards(docs, common.new_folder(spark, "test-shards"), WORD)
    found = sorted(sstable.read_shards(manifest).collect(), key=lambda r: r.start)
    at, want = 0, []
    for doc, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = _ids(text)
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert [tuple(r)[:4] for r in found] == want
    for r in manifest.collect():
        fs, inner = common.open_fs(r.path)
        with fs.open_input_file(inner) as file:
            reader = sstable.Reader(file, file.size())
            assert (reader.entries, reader.ids) == (r.n_documents, r.n_ids)
            keys = {sstable.id_of(k) for k, _ in reader.scan()}
            for doc, text, *_ in rows:
                got = reader.get(sstable.key_of(doc))
                assert (got is not None) == (doc in keys)
                assert got is None or got.tolist() == _ids(text).tolist()
            assert reader.get(sstable.key_of(999_999)) is None and reader.get(b"") is None
    again = sstable.read_shards(sstable.write_shards(odd, common.new_folder(spark, "test-shards"), WORD)).collect()
    assert len(again) == odd.count() and sorted(r.start for r in again)[0] == 0
    assert sstable.read_shards(sstable.write_shards(empty, common.new_folder(spark, "test-shards"), WORD)).count() == 0


def test_shard_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(sstable, "BLOCK_BYTES", 200)
    keys = sorted([*range(-50, 50), 7, 7, 7], key=lambda k: k)
    with (tmp_path / "x").open("wb") as out:
        writer = sstable.Writer(out, 2)
        for k in [None, *keys]:
            writer.add(sstable.key_of(k), np.arange(abs(k or 3) % 9, dtype="<u2").tobytes())
        writer.close()
        with pytest.raises(ValueError):
            writer.add(sstable.key_of(-60), b"")
    size = (tmp_path / "x").stat().st_size
    with (tmp_path / "x").open("rb") as file:
        reader = sstable.Reader(file, size)
        assert len(reader.index) > 3 and [sstable.id_of(k) for k, _ in reader.scan()] == [None, *keys]
        for k in [None, *range(-60, 60)]:
            got = reader.get(sstable.key_of(k))
            assert (got is not None) == (k is None or -50 <= k < 50) and (got is None or len(got) == abs(k or 3) % 9)
        assert sum(reader.may_have(sstable.key_of(k)) for k in range(1000, 3000)) < 100


# --- quality ---------------------------------------------------------------------------------------------------------


def test_quality(spark, odd, empty):
    good = _texts(300, 5)
    rows = [(k, t if k % 3 else " ".join(w.upper() + "!!" for w in t.split()), "en", "a", 0) for k, t in enumerate(good)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(300)] + [(None, 1, 0), (5, None, 0), (99999, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model).collect()
    held = [r for r in scored if quality.held_out(r.doc_id)]
    assert np.mean([(r.quality_score >= 0.5) == (r.doc_id % 3 > 0) for r in held]) > 0.9
    again = quality.fit(docs.repartition(7), labels.repartition(3))
    assert [t.tolist() for t in again.tables] == [t.tolist() for t in model.tables]
    out = quality.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.quality_score <= 1 for r in out)
    assert quality.score(empty, model).count() == 0
    nothing = quality.fit(docs, labels.limit(0))
    assert {r.quality_score for r in quality.score(docs, nothing).collect()} == {0.5}


def test_pair_tables_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.train(x, y)
    assert np.mean((model.score(x) > 0.5) == (y > 0.5)) > 0.95
    assert (model.pairs[0][0], model.pairs[0][1]) == (1, 0)
