"""Each opN_ query, as registered, against brute force written from its contract, on given and on odd documents."""

from __future__ import annotations

import hashlib
import re
import tempfile
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from isohyet.llm import counting, fingerprints, media, queries, quality, tokens
from tests.llm.test_corpus import SCHEMA, _brute_components, _brute_repeats, _check_packed, _ids, _slow_fingerprint, _targets, _texts
from tests.llm.test_pipeline import TAKEN
from tests.llm.test_units import brute_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _odd() -> list[tuple]:
    """Nulls in every column but the id, empty and blank texts, copies, ties, other scripts, a negative id, a very long text."""
    texts = _texts(60, 4)
    rows = [(k * 7 - 20, t, [None, "en", "fr"][k % 3], [None, "a", "B", "é"][k % 4], len(t)) for k, t in enumerate(texts)]
    rows += [(2000 + k, texts[5], "en", "a", 1) for k in range(12)]
    rows += [(3000, None, None, None, None), (3001, "", "en", "a", 0), (3002, " \n\t", "en", None, 3), (3003, None, "fr", "B", 0), (3004, "x", None, "B", 1), (3005, "long " * 200_000, "en", "B", 1)]
    return rows


@pytest.fixture(scope="module", params=["given", "odd"])
def folder(request, spark, sf_dir):
    if request.param == "given":
        return sf_dir
    path = tempfile.mkdtemp(prefix="isohyet-odd-")
    docs = spark.createDataFrame(_odd(), SCHEMA).select("*", *(F.lit(k).alias(name) for k, name in enumerate(TAKEN)))
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], k % 2, 0) for k, r in enumerate(_odd())] + [(None, 1, 0), (7, None, 1), (-1, 1, 1), (1, 1, 0), (1, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def texts(spark, folder):
    """Texts by id, in ascending order of ids; a null text is an empty one."""
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()}


def _run(spark, folder, name, columns):
    found = queries.QUERIES[name](spark, folder)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields][: len(columns.split(", "))] == columns.split(", ")
    return found.collect()


def test_op1(spark, folder, texts):
    found = _run(spark, folder, "op1_harmonic_packing", "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
    sequences = _check_packed(found, Counter(texts.items()))
    total = sum(r.length for r in found)
    assert set(sequences) == set(range(len(sequences))) and total >= 0.99 * 4096 * (len(sequences) - 1)


def test_op2(spark, folder, texts):
    found = _run(spark, folder, "op2_archived_media", "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")
    want = []
    for doc, text in texts.items():
        raw = text.encode()
        full = raw + bytes(64 if not raw else -len(raw) % 64)
        image = media.to_png(full)
        assert media.from_png(image) == full
        want.append((doc, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]), len(image), hashlib.sha256(image).hexdigest(), media.feature(full)))
    assert sorted(map(tuple, found)) == sorted(want)


def test_op3(spark, folder, texts):
    found = {r.doc_id: r for r in _run(spark, folder, "op3_canonical_digests", "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")}
    ids = list(texts)
    form = fingerprints.canonical
    for doc, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, following = texts[doc], texts[after]
        edited = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        prints = [xxhash.xxh3_128_hexdigest(form(x)) for x in (text, edited)]
        near = [float(form(text) == form(x)) for x in (edited, following)]
        assert tuple(found.pop(doc)) == (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), *prints, *near)
    assert not found


def test_op4(spark, folder, texts):
    found = _run(spark, folder, "op4_source_mixing", "doc_id bigint, size bigint, source_size bigint, target double, taken bigint")
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source").collect()}
    sizes, taken, largest = Counter(), Counter(), Counter()
    for doc, text in texts.items():
        sizes[source[doc]] += len(WORD.findall(text))
    want = _targets(sizes)
    for r in found:
        key = source[r.doc_id]
        assert (r["size"], r.source_size) == (len(WORD.findall(texts[r.doc_id])), sizes[key]) and r.target == pytest.approx(want[key])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[key] += r.taken
        largest[key] = max(largest[key], r["size"])
    assert sorted(r.doc_id for r in found) == list(texts)
    assert all(abs(taken[k] - want[k]) <= largest[k] / 2 + 1e-6 for k in sizes)
    again = _run(spark, folder, "op4_source_mixing", "doc_id bigint")
    assert sorted(map(tuple, (r[:5] for r in again))) == sorted(map(tuple, (r[:5] for r in found)))


def test_op5(spark, folder, texts):
    found = {r.doc_id: tuple(r)[1:] for r in _run(spark, folder, "op5_token_counts", "doc_id bigint, n_words bigint, n_pieces bigint, max_word_pieces bigint")}
    pieces = counting.model_pieces(tokens.vocabulary_path("piece_bpe_32k.model"))
    known, longest, seen = set(pieces), max(map(len, pieces)), {}
    for doc, text in texts.items():
        words = [w.encode() for w in WORD.findall(text)]
        for w in words:
            seen.setdefault(w, None)
            if seen[w] is None:
                seen[w] = counting.greedy_count(known, longest, counting.WORD_START + w)
        assert found.pop(doc) == (len(words), sum(seen[w] for w in words), max((seen[w] for w in words), default=0))
    assert not found


def test_op6(spark, folder, texts):
    found = _run(spark, folder, "op6_hilbert_sharding", "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int")
    shards = defaultdict(list)
    for r in found:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
        shards[r.shard].append(r.slot)
    assert sorted(r.doc_id for r in found) == list(texts) and set(shards) == set(range(40))
    counts = [len(x) for x in shards.values()]
    assert max(counts) - min(counts) <= 1 and all(sorted(x) == list(range(len(x))) for x in shards.values())


def test_op7(spark, folder, texts):
    found = {r.doc_id: tuple(r)[1:] for r in _run(spark, folder, "op7_suffix_dedup", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")}
    assert found == _brute_repeats(list(texts.items()))


def test_op8(spark, folder, texts):
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in _run(spark, folder, "op8_simhash_groups", "doc_id bigint, fingerprint string, component_id bigint")}
    prints = {d: _slow_fingerprint(t, 4) for d, t in texts.items()}
    roots = _brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert found == {d: (f"{prints[d]:016x}", roots[d]) for d in texts}


def test_op9(spark, folder, texts):
    found = {r.doc_id: tuple(r)[1:4] for r in _run(spark, folder, "op9_token_shards", "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")}
    at = 0
    for doc, text in texts.items():
        ids = _ids(text)
        assert found.pop(doc) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not found


def test_op10(spark, folder, texts):
    found = _run(spark, folder, "op10_quality_scores", "doc_id bigint, held_out boolean, score double, predicted int")
    assert sorted(r.doc_id for r in found) == list(texts)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    by_text = defaultdict(set)
    for r in found:
        by_text[texts[r.doc_id]].add(r.score)
    assert all(len(x) == 1 for x in by_text.values())  # nothing but the text decides


def test_op10_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(r.score, labels[r.doc_id]) for r in queries.QUERIES["op10_quality_scores"](spark, folder).collect() if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = (np.array([s for s, q in held if q == k]) for k in (1, 0))
    area = np.mean((good[:, None] > bad) + 0.5 * (good[:, None] == bad))
    assert len(held) > 60 and area > 0.97 and np.mean(good >= quality.THRESHOLD) > 0.97 and np.mean(bad < quality.THRESHOLD) > 0.8


def test_op11(spark, folder, texts):
    found = {r.doc_id: tuple(r)[1:] for r in _run(spark, folder, "op11_fill_in_middle", "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string")}
    for doc, text in texts.items():
        h = hashlib.sha256(f"1:{doc}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
        n = len(text)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        plain = not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90
        form = "plain" if plain else "spm" if h4 % 100 < 20 else "psm"
        out = {"plain": text, "psm": f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", "spm": f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"}[form]
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert found.pop(doc) == (n, form, None if plain else a, None if plain else b - a, digest(out), digest(text))
    assert not found


def test_op12(spark, folder):
    found = _run(spark, folder, "op12_source_divergence", "lang string, source string, part string, item string, value bigint, rank int")
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("lang", "source", "text").collect()
    assert sorted(map(tuple, found)) == brute_audit(rows)


def test_op13(spark, folder, texts):
    found = {r.doc_id: tuple(r)[1:] for r in _run(spark, folder, "op13_sentencepiece", "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")}
    model = sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary_path("piece_bpe_32k.model"))
    for doc, text in texts.items():
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert found.pop(doc) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest())
    assert not found


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    got, want = queries.QUERIES[name](spark, sf_dir), con.sql(queries.ORACLE_SQL[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr) == sorted(want.project(", ".join(order)).fetchall(), key=repr)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name


def test_null_ids(spark, tmp_path):
    """Rows without an id, copies among them, are in every query's result; the rows with one are as they would be alone."""
    some = [r for r in _odd() if len(r[1] or "") < 10_000][:40]
    nameless = [(None, some[5][1], "en", "a", 1), (None, some[5][1], "en", "a", 1), (None, "without an id", None, None, 1), (None, None, "fr", "B", None)]
    for part, rows in (("named", some), ("all", some + nameless)):
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/{part}/documents.parquet")
        spark.createDataFrame([(r[0], k % 2, 0) for k, r in enumerate(some)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{part}/labels.parquet")
    for name, query in queries.QUERIES.items():
        found = query(spark, f"{tmp_path}/all").collect()
        number = int(re.match(r"op(\d+)_", name).group(1))
        if number == 1:
            tokens_of = Counter()
            for r in found:
                tokens_of[r.doc_id] += r.length
            alone = Counter()
            for r in query(spark, f"{tmp_path}/named").collect():
                alone[r.doc_id] += r.length
            assert {k: v for k, v in tokens_of.items() if k is not None} == alone and tokens_of[None] > 4, name
        elif number != 12:  # groups, not documents
            assert len(found) == len(some) + len(nameless), name
            assert Counter(r.doc_id for r in found) == Counter(r[0] for r in some + nameless), name
        if number in (2, 5, 11, 13):  # what these say of a document depends on it alone
            own = {r.doc_id: r for r in query(spark, f"{tmp_path}/named").collect()}
            assert all(r == own[r.doc_id] for r in found if r.doc_id is not None), name
