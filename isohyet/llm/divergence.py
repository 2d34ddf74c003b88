"""How far the sources of a language differ in the words they use, exactly.

1. Tasks count words by language and source; counts are summed by (language, source, term).
2. The sums are sorted by (language, term) in ranges. Along a range the terms that enough documents have are cut into
   chunks: a sorted array of kept terms, whose places are the terms' ids. A row's id is found by searchsorted, and each
   source's counts become one dense vector by bincount. Ids keep the order of the bytes, so ties need no strings.
3. Chunks meet blocks of sources. Shares are divided out of the vectors in whole numbers; each tile of a chunk and two
   blocks gives the part of the distances that lies in the chunk, and the best terms of each source in it.

No step holds a language whole: a task has a chunk of terms for two blocks of sources.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Documents of a language that a kept term is in, at least.
LEAST_DOCUMENTS = 30
#: What is added to each count, the scale of shares, and the terms told of each source.
SMOOTHING, TOP_TERMS = 5, 50
#: Terms of a chunk; rows after which a chunk of many sources ends sooner; sources of a block.
CHUNK_TERMS, CHUNK_ROWS, BLOCK = 8192, 1 << 20, 256
#: Distinct terms by source that a task counts before it hands them on.
HELD_TERMS = 250_000

#: Upper-case ASCII letters become lower-case ones; other ASCII that is no letter becomes a blank; other bytes stay.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNTED = "lang string, source string, term binary, n long, docs long"
_COUNTED_SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])


def words_of(data: bytes) -> list[bytes]:
    """Runs of letters and of bytes that are not ASCII, in lower case as to ASCII."""
    return data.translate(_FOLDED).split()


class _Tally:
    """Occurrences and documents of each term, by language and source. The empty term tells a group's documents."""

    def __init__(self):
        self.by_group: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.held = 0

    def add(self, group: tuple[str, str], data: bytes) -> None:
        if group not in self.by_group:
            self.by_group[group] = (Counter(), Counter())
        occurrences, documents = self.by_group[group]
        before, found = len(occurrences), words_of(data)
        occurrences.update(found)
        documents.update(set(found))
        documents[b""] += 1
        self.held += len(occurrences) - before + 1

    def flush(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in self.by_group.items():
            terms = list(documents)
            for k in range(0, len(terms), 50_000):
                some = terms[k : k + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(some)), pa.repeat(pa.scalar(source, pa.string()), len(some)), pa.array(some, pa.binary()), pa.array([occurrences[t] for t in some], pa.int64()), pa.array([documents[t] for t in some], pa.int64())],
                    schema=_COUNTED_SCHEMA,
                )
        self.by_group, self.held = {}, 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = _Tally()
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.utf8(batch.column(2)).cast(pa.large_binary()), strict=True):
            tally.add((lang, source), text.as_py())
            if tally.held >= HELD_TERMS:
                yield from tally.flush()
    yield from tally.flush()
    common.give_back()


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term (binary), n (occurrences), docs; a row with an empty term for each group of documents."""
    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = read.mapInArrow(_count, _COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


_CHUNKS = "lang string, chunk long, source string, size long, total long, vector binary, terms array<binary>"
_CHUNKS_SCHEMA = pa.schema([("lang", pa.string()), ("chunk", pa.int64()), ("source", pa.string()), ("size", pa.int64()), ("total", pa.int64()), ("vector", pa.binary()), ("terms", pa.list_(pa.binary()))])


class _Chunk:
    """Kept terms of one language in order, and the rows of their sources."""

    def __init__(self, lang: str):
        self.lang = lang
        self.terms: list[bytes] = []
        self.rows: list[tuple[np.ndarray, list[bytes], np.ndarray]] = []
        self.n_rows = 0

    def batches(self, number: int) -> Iterator[pa.RecordBatch]:
        """Dense vectors of counts: the language's (no source; with the terms), then each source's."""
        kept = np.empty(len(self.terms), dtype=object)
        kept[:] = self.terms
        sources = np.concatenate([r[0] for r in self.rows])
        queries = np.empty(self.n_rows, dtype=object)
        queries[:] = [t for r in self.rows for t in r[1]]
        counts = np.concatenate([r[2] for r in self.rows])
        ids = np.searchsorted(kept, queries)

        def row(source: str | None, these: np.ndarray | slice) -> tuple:
            vector = np.bincount(ids[these], weights=counts[these], minlength=len(kept)).astype("<i8")  # exact up to 2^53
            return self.lang, number, source, len(kept), int(vector.sum()), vector.tobytes(), self.terms if source is None else None

        out, held = [row(None, slice(None))], 0
        order = np.argsort(sources, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], sources[order][1:] != sources[order][:-1]]))
        for at, stop in zip(starts, [*starts[1:], len(order)], strict=True):
            out.append(row(sources[order[at]], order[at:stop]))
            held += len(out[-1][5])
            if held >= 16_000_000:
                yield _table(out, _CHUNKS_SCHEMA)
                out, held = [], 0
        if out:
            yield _table(out, _CHUNKS_SCHEMA)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _chunks(batches: Iterator[pa.RecordBatch], least: int, chunk_terms: int, chunk_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows lang, term, source, n, docs of one range, sorted by the first two."""
    part, made = TaskContext.get().partitionId(), 0
    chunk: _Chunk | None = None
    waiting: pa.Table | None = None  # rows of the last term, which the next batch may go on with

    def closed() -> Iterator[pa.RecordBatch]:
        nonlocal chunk, made
        if chunk is not None and chunk.terms:
            yield from chunk.batches(part << 32 | made)
            made += 1
        chunk = None

    def take(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Whole terms: all rows of each."""
        nonlocal chunk
        langs, terms, sources = rows["lang"].to_pylist(), rows["term"].to_pylist(), rows["source"].to_numpy()
        counts, documents = rows["n"].to_numpy(), rows["docs"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], _changes(rows)]))
        ends = np.concatenate([starts[1:], [len(terms)]])
        enough = np.add.reduceat(documents, starts) >= least
        for at, stop in zip(starts[enough].tolist(), ends[enough].tolist(), strict=True):
            term = terms[at]
            if not term:
                continue
            if chunk is not None and (chunk.lang != langs[at] or len(chunk.terms) >= chunk_terms or chunk.n_rows >= chunk_rows):
                yield from closed()
            if chunk is None:
                chunk = _Chunk(langs[at])
            chunk.terms.append(term)
            chunk.rows.append((sources[at:stop], terms[at:stop], counts[at:stop]))
            chunk.n_rows += stop - at

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if waiting is not None:
            rows = pa.concat_tables([waiting, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        last = np.flatnonzero(_changes(rows))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield from take(rows.slice(0, cut))
        waiting = rows.slice(cut)
    if waiting is not None and waiting.num_rows:
        yield from take(waiting)
    yield from closed()
    common.give_back()


def _changes(rows: pa.Table) -> np.ndarray:
    """Whether each row but the first has another language or term than the one before."""
    n = rows.num_rows
    differs = [pc.not_equal(rows[c].slice(1), rows[c].slice(0, n - 1)) for c in ("lang", "term")] if n > 1 else [pa.array([], pa.bool_())]
    return np.logical_or.reduce([d.to_numpy(zero_copy_only=False) if isinstance(d, pa.Array) else d.to_numpy() for d in differs])


def chunks_of(totals: DataFrame, least: int = LEAST_DOCUMENTS, chunk_terms: int = CHUNK_TERMS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Dense vectors of counts: lang, chunk, source (null: the whole language), size, total, vector, terms (with the language's).

    totals: what count_terms() gives, stored, since ranges are cut by a sample of it. A term's rows, one a source, are in one range.
    """
    ranges = totals.select("lang", "term", "source", "n", "docs").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return ranges.mapInArrow(partial(_chunks, least=least, chunk_terms=chunk_terms, chunk_rows=chunk_rows), _CHUNKS)


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), exactly: long division, three decimal digits at a time.

    Nothing overflows below 9e15 occurrences in a group.
    """
    divisor = total + SMOOTHING * kept
    rest = counts + SMOOTHING
    found = np.zeros_like(rest)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, divisor)
        found = found * 1000 + digits
    return found + 1


_FOUND = "lang string, part string, ordinal int, other int, item binary, value long"
_FOUND_SCHEMA = pa.schema([("lang", pa.string()), ("part", pa.string()), ("ordinal", pa.int32()), ("other", pa.int32()), ("item", pa.binary()), ("value", pa.int64())])


def _tile(table: pa.Table, top: int, block_size: int) -> pa.Table:
    """One chunk of terms for two blocks of sources: distances of pairs, and the best terms of each source of a single block.

    A row without an ordinal is the head: totals of the sources of both blocks, and of the language. A source that has no
    vector has none of the terms.
    """
    rows = table.to_pylist()
    head = next(r for r in rows if r["ordinal"] is None)
    a, b, kept = head["a"], head["b"], head["kept"]
    size = len(head["terms"] or ())
    vectors = {r["ordinal"]: np.frombuffer(r["vector"], dtype="<i8") for r in rows if r["ordinal"] is not None}
    nothing = np.zeros(size, dtype=np.int64)

    def block(number: int, totals: list[int]) -> np.ndarray:
        found = np.zeros((len(totals), size), dtype=np.int64)
        for k, total in enumerate(totals):
            if size:
                found[k] = shares(vectors.get(number * block_size + k, nothing), total, kept)
        return found

    first = block(a, head["totals_a"])
    second = first if a == b else block(b, head["totals_b"])
    pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k in range(len(first)):
        start = k + 1 if a == b else 0
        away = np.abs(second[start:] - first[k]).sum(axis=1)
        others = np.arange(start, len(second)) + b * block_size
        pairs.append((np.full(len(others), k + a * block_size), others, away))
    left, right, value = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (zip(*pairs, strict=True) if pairs else ((), (), ())))
    n = len(value)
    found = [pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(head["lang"], pa.string()), n), pa.repeat(pa.scalar("pair", pa.string()), n), pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.nulls(n, pa.binary()), pa.array(value, pa.int64())], schema=_FOUND_SCHEMA)]
    if a == b and size:
        whole = shares(np.frombuffer(head["vector"], dtype="<i8"), head["lang_total"], kept)
        for k in range(len(first)):
            more = first[k] - whole
            above = np.flatnonzero((vectors.get(k + a * block_size, nothing) > 0) & (more > 0))
            best = above[np.lexsort((above, -more[above]))][:top]  # ids are in the order of the terms
            if len(best):
                found.append(_table([(head["lang"], "term", k + a * block_size, None, head["terms"][i], int(more[i])) for i in best.tolist()], _FOUND_SCHEMA))
    return pa.Table.from_batches(found)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, chunk_terms: int = CHUNK_TERMS, chunk_rows: int = CHUNK_ROWS, block: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: distances between the sources of a language, and what each source says more.

    Part "pair": every other source of the language and the sum of the differences of shares over all kept terms. Part
    "term": the terms whose share is above the language's, the `top` most. A kept term is in at least `least` documents of
    its language. Equal values are ranked by the bytes of the item.

    Null languages, sources and texts are empty strings. Texts without words make their group occur all the same. Repeated
    rows are documents of their own. An empty table gives no rows; only lang, source and text are read, whatever other
    columns are called. Very long texts are counted whole, one at a time.

    A language's sources, one row each, are numbered by one task; the result has a row for each pair of them in any case.
    """
    totals = common.stored(count_terms(docs), "terms")
    chunks = common.stored(chunks_of(totals, least, chunk_terms, chunk_rows), "chunks")
    sums = chunks.groupBy("lang", "source").agg(F.sum("total").alias("total"), F.sum("size").alias("size"))
    langs = sums.filter("source is null").select("lang", F.col("total").alias("lang_total"), F.col("size").alias("kept"))
    named = totals.filter(F.octet_length("term") == 0).select("lang", "source")
    numbered = named.withColumn("ordinal", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = common.durable(numbered.join(sums.filter("source is not null"), ["lang", "source"], "left").select("lang", "source", "ordinal", F.coalesce("total", F.lit(0)).alias("total")))
    in_order = F.array_sort(F.collect_list(F.struct("ordinal", "total")))
    blocks = groups.groupBy("lang", (F.col("ordinal") / block).cast("int").alias("block")).agg(F.transform(in_order, lambda x: x["total"]).alias("totals"))
    one, two = (blocks.select("lang", F.col("block").alias(x), F.col("totals").alias(f"totals_{x}")) for x in "ab")
    tiles = one.join(two, "lang").filter("a <= b").join(langs, "lang", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    wholes = chunks.filter("source is null").select("lang", "chunk", "vector", "terms")
    heads = tiles.join(wholes, "lang", "left").withColumn("chunk", F.coalesce("chunk", F.lit(-1))).withColumn("ordinal", F.lit(None).cast("int"))
    count = groups.groupBy("lang").agg(((F.max("ordinal") / block).cast("int") + 1).alias("blocks"))
    placed = chunks.filter("source is not null").join(groups.select("lang", "source", "ordinal"), ["lang", "source"]).join(count, "lang").withColumn("own", (F.col("ordinal") / block).cast("int"))
    # a vector goes to every tile that its block is in
    dealt = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("lang", "chunk", F.least("own", "with").alias("a"), F.greatest("own", "with").alias("b"), "ordinal", "vector")
    stacked = heads.unionByName(dealt, allowMissingColumns=True)

    def tile(table: pa.Table) -> pa.Table:
        return _tile(table, top, block)

    found = common.stored(stacked.groupBy("lang", "chunk", "a", "b").applyInArrow(tile, _FOUND), "divergence")
    distances = found.filter("part = 'pair'").groupBy("lang", "ordinal", "other").agg(F.sum("value").alias("value"))
    both = distances.unionByName(distances.select("lang", F.col("other").alias("ordinal"), F.col("ordinal").alias("other"), "value"))
    names = groups.select("lang", "ordinal", "source")
    others = groups.select("lang", F.col("ordinal").alias("other"), F.col("source").alias("item"))
    pairs = both.join(others, ["lang", "other"]).select("lang", "ordinal", F.lit("pair").alias("part"), "item", "value")
    terms = found.filter("part = 'term'").select("lang", "ordinal", "part", F.col("item").cast("string").alias("item"), "value")
    ranking = Window.partitionBy("lang", "ordinal").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(ranking))
    every = ranked(pairs).unionByName(ranked(terms).filter(F.col("rank") <= top))
    return every.join(names, ["lang", "ordinal"]).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(common.documents(spark, sf_dir))


#: The letters whose case is folded.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP12_SQL = rf"""
with docs as (
    select row_number() over () as row_id, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as text from documents
), words as (
    select row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), kept as (
    select lang, term from words group by lang, term having count(distinct row_id) >= {LEAST_DOCUMENTS}
), sources as (
    select distinct lang, source from docs
), counts as (
    select lang, source, term, count(*) as n from words group by lang, source, term
), every as (
    select s.lang, s.source, k.term, coalesce(c.n, 0)::hugeint as n
    from sources s join kept k on s.lang = k.lang left join counts c on c.lang = s.lang and c.source = s.source and c.term = k.term
), own as (
    select lang, source, term, n, 1 + (1000000000 * (n + {SMOOTHING})) // (sum(n) over g + {SMOOTHING} * count(*) over g) as p from every window g as (partition by lang, source)
), whole as (
    select lang, term, 1 + (1000000000 * (n + {SMOOTHING})) // (sum(n) over g + {SMOOTHING} * count(*) over g) as q
    from (select lang, term, sum(n) as n from every group by lang, term) window g as (partition by lang)
), apart as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from own a join own b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
    select a.lang, a.source, b.source as item, coalesce(v.value, 0)::bigint as value
    from sources a join sources b on a.lang = b.lang and a.source <> b.source left join apart v on v.lang = a.lang and v.source = a.source and v.item = b.source
), terms as (
    select lang, source, term as item, (p - q)::bigint as value from own join whole using (lang, term) where n > 0 and p > q
)
select lang, source, 'pair' as part, item, value, (row_number() over (partition by lang, source order by value desc, item))::int as rank from pairs
union all
select * from (select lang, source, 'term' as part, item, value, (row_number() over (partition by lang, source order by value desc, item))::int as rank from terms) where rank <= {TOP_TERMS}
"""
