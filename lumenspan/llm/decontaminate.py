"""Benchmark decontamination by a distributed positional inverted index.

:func:`build_index` stores the postings of all training tokens: a row for each
shard (a bounded number of documents) with its terms (64-bit hashes, sorted),
and for each term the ascending positions in the shard.  The index is
partitioned by documents, so a frequent term is spread over all shards and no
key is hot, and it is read column by column: counting terms reads no positions.

A query phrase (a window of a benchmark item) is answered from its rarest term
by the counts of the whole index: that term's postings, shifted by its offset,
are the candidate starts; they are intersected with the shifted postings of the
next rarest term, and so on.  Proximity matches start from the postings of the
rarest term as well and take the nearest postings of the terms before and after
it, in order; they hold if that needs at most ``slop`` words beside the phrase's.

The benchmark is taken in blocks of at most ``block_terms`` words, each a pass
over the stored postings whose hits are stored, so what a task holds does not
grow with the benchmark.

Defined cases: null, empty and word-less texts have no words and no hits; null
or word-less items have no window; repeated items count once per ``item_id``;
repeated documents are each judged; an empty table gives an empty result; of
clashing columns the operator's replace those of the input, others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _common as C

WINDOW = 10
#: Words of benchmark items that one pass broadcasts.
BLOCK_TERMS = 2_000_000
#: Candidate starts that a task expands at once.
CANDIDATES = 1 << 18
#: Documents and bytes of a shard (a longer text is a shard of its own).
SHARD_ROWS, SHARD_BYTES = 128, 1 << 20
#: Row groups and pages of the index are closed by size at any row: the usual writer looks after 100 rows, which are far larger here.
INDEX_FILES = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
#: Documents with hits that a join may broadcast.
BROADCAST_HITS = 500_000

#: Bytes of a text with A-Z lower-cased and all that parts words as blanks.
_WORD_BYTES = bytes((b + 32) if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"


def terms_of(text: str | None) -> np.ndarray:
    """The hashed words of a text."""
    return C.hashed_words((text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES))[0]


@dataclass
class Shard:
    """Postings of some documents: ``positions[edges[i]:edges[i + 1]]`` are those of ``terms[i]``.

    Positions count words, with a gap between documents; ``starts`` has each document's first.
    """

    terms: np.ndarray
    edges: np.ndarray
    positions: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Shard:
        data = [t.encode("utf-8", "surrogatepass").translate(_WORD_BYTES) for t in texts]
        hashes, at = C.hashed_words(b" ".join(data))
        first_byte = np.concatenate(([0], np.cumsum([len(d) + 1 for d in data])))[:-1]
        doc = np.searchsorted(first_byte, at, side="right") - 1
        n = np.bincount(doc, minlength=len(texts))
        starts = np.concatenate(([0], np.cumsum(n + 1)))[: len(texts)]
        by = np.argsort(hashes, kind="stable")
        terms, edges = np.unique(hashes[by], return_index=True)
        return cls(terms, np.append(edges, len(hashes)), (np.arange(len(hashes)) + doc)[by], starts)

    def keys(self) -> np.ndarray:
        """Postings as one ascending list: number of the term times the span, plus position."""
        return np.repeat(np.arange(len(self.terms)), np.diff(self.edges)) * self.span() + self.positions

    def span(self) -> int:
        return int(self.positions.max(initial=0)) + 2 * WINDOW + 2

    def term(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term, -1 if the shard lacks it."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        k = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[k] == hashes, k, -1)

    def doc(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, position, side="right") - 1

    def candidates(self, q: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, position of its rarest term) of all postings of rarest terms, in chunks."""
        k = np.searchsorted(q.anchors, self.terms)
        own = np.flatnonzero((k < len(q.anchors)) & (q.anchors[np.minimum(k, len(q.anchors) - 1)] == self.terms)) if len(q.anchors) else []
        phrases, places, held = [], [], 0
        for t in own:
            listed = self.positions[self.edges[t] : self.edges[t + 1]]
            of = q.by_anchor[q.anchor_edges[k[t]] : q.anchor_edges[k[t] + 1]]
            step = max(1, CANDIDATES // len(of))
            for i in range(0, len(listed), step):
                part = listed[i : i + step]
                phrases.append(np.repeat(of, len(part)))
                places.append(np.tile(part, len(of)))
                held += len(phrases[-1])
                if held >= CANDIDATES:
                    yield np.concatenate(phrases), np.concatenate(places)
                    phrases, places, held = [], [], 0
        if held:
            yield np.concatenate(phrases), np.concatenate(places)

    def find(self, q: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, start) of all exact occurrences: shifted postings intersected from the rarest term on."""
        keys, span = self.keys(), self.span()
        for phrase, place in self.candidates(q):
            start = place - q.order[phrase, 0]
            for j in range(1, q.order.shape[1]):
                more = j < q.length[phrase]
                offset = q.order[phrase, j]
                t = self.term(q.tokens[q.first[phrase] + np.where(more, offset, 0)])
                want = t * span + start + offset
                at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                keep = ~more | ((t >= 0) & (start >= 0) & (keys[at] == want))
                phrase, start = phrase[keep], start[keep]
                if not len(phrase):
                    break
            if len(phrase):
                yield phrase, start

    def near(self, q: Phrases, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(phrase, first, last): the tightest run of all terms in order around a posting of the rarest, in one document."""
        keys, span = self.keys(), self.span()
        for phrase, place in self.candidates(q):
            ends = {}
            for side in (-1, 1):
                at, anchor = place.copy(), q.order[phrase, 0]
                alive = np.ones(len(phrase), bool)
                for j in range(1, q.order.shape[1]):
                    offset = anchor + side * j
                    more = alive & (offset >= 0) & (offset < q.length[phrase])
                    t = self.term(q.tokens[q.first[phrase] + np.where(more, offset, 0)])
                    k = np.searchsorted(keys, t * span + at, side="right") if side > 0 else np.searchsorted(keys, t * span + at, side="left") - 1
                    found = keys[np.clip(k, 0, len(keys) - 1)]
                    ok = (t >= 0) & (k >= 0) & (k < len(keys)) & (found // span == t)
                    alive &= ~more | ok
                    at = np.where(more & ok, found - t * span, at)
                ends[side] = at, alive
            (first, left), (last, right) = ends[-1], ends[1]
            keep = left & right & (last - first < q.length[phrase] + slop) & (self.doc(first) == self.doc(last))
            if keep.any():
                yield phrase[keep], first[keep], last[keep]


@dataclass
class Phrases:
    """Query phrases over hashed terms; ``order`` lists each phrase's offsets from the rarest term on."""

    items: list[str]
    of_item: np.ndarray
    length: np.ndarray
    tokens: np.ndarray
    first: np.ndarray
    order: np.ndarray
    anchors: np.ndarray
    by_anchor: np.ndarray
    anchor_edges: np.ndarray


def phrases(rows: list[tuple], window: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(items, of_item, length, tokens, first): the distinct windows of every item."""
    items, of_item, length, tokens, first, seen, at = [], [], [], [], [], set(), 0
    for item, text in rows:
        own = terms_of(text)
        if not len(own):
            continue
        items.append(str(item))
        n = min(window, len(own))
        for k in range(len(own) - n + 1):
            if (key := (items[-1], own[k : k + n].tobytes())) not in seen:
                seen.add(key)
                of_item.append(len(items) - 1)
                length.append(n)
                first.append(at + k)
        tokens.append(own)
        at += len(own)
    return items, np.array(of_item, np.int64), np.array(length, np.int64), np.concatenate(tokens) if tokens else np.zeros(0, np.uint64), np.array(first, np.int64)


def ranked(rows: list[tuple], window: int, count) -> Phrases | None:
    """The phrases of some items, the rarest terms first by ``count`` (distinct terms to frequencies); None without any."""
    items, of_item, length, tokens, first = phrases(rows, window)
    if not len(length):
        return None
    distinct, number = np.unique(tokens, return_inverse=True)
    frequency = count(distinct)[number]
    order = np.zeros((len(length), int(length.max())), np.int32)
    for i, (at, n) in enumerate(zip(first, length, strict=True)):
        order[i, :n] = np.argsort(frequency[at : at + n], kind="stable")
    rarest = tokens[first + order[:, 0]]
    by = np.argsort(rarest, kind="stable")
    anchors, edges = np.unique(rarest[by], return_index=True)
    return Phrases(items, of_item, length, tokens, first, order, anchors, by, np.append(edges, len(by)))


def blocks(benchmark: DataFrame, block_terms: int) -> Iterator[list[tuple]]:
    """Item texts in blocks of bounded size, fetched one after another."""
    block, n = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null and item_id is not null").toLocalIterator():
        size = len(row.text) // 2 + 1
        if block and n + size > block_terms:
            yield block
            block, n = [], 0
        block.append((row.item_id, row.text))
        n += size
    if block:
        yield block


INDEX = "ids array<bigint>, keys array<bigint>, starts binary, terms binary, edges binary, positions binary"


def _key(doc_id: str = "doc_id") -> Column:
    """What tells a document's rows apart: a hash of its id and text."""
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(doc_id).isNull(), F.coalesce("text", F.lit("")))


def build_index(docs: DataFrame) -> DataFrame:
    """The stored postings of all tokens of (doc_id, text): a row for each shard."""
    C.prepare(docs.sparkSession)

    def shards(batch) -> Iterator[tuple[slice, list[str]]]:
        texts, at, size = C.texts(batch), 0, 0
        for i, t in enumerate(texts):
            if i > at and (i - at == SHARD_ROWS or size + len(t) > SHARD_BYTES):
                yield slice(at, i), texts[at:i]
                at, size = i, 0
            size += len(t)
        if texts:
            yield slice(at, len(texts)), texts[at:]

    def run(batches):
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("key")
            for own, texts in shards(batch):
                s = Shard.of(texts)
                parts = (s.starts.astype(np.int64), s.terms, s.edges.astype(np.int32), s.positions.astype(np.int32))
                listed = [pa.array([x[own].to_pylist()], pa.list_(pa.int64())) for x in (ids, keys)]
                yield pa.RecordBatch.from_arrays([*listed, *[pa.array([x.tobytes()], pa.binary()) for x in parts]], ["ids", "keys", "starts", "terms", "edges", "positions"])

    return C.stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _key().alias("key"), "text").mapInArrow(run, INDEX), **INDEX_FILES)


def _read(batch, i: int) -> Shard:
    get = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
    return Shard(get("terms", np.uint64), get("edges", np.int32).astype(np.int64), get("positions", np.int32).astype(np.int64), get("starts", np.int64))


def frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How often each of the (ascending) terms occurs in the index."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column("terms")[i].as_buffer(), np.uint64)
                n = np.diff(np.frombuffer(batch.column("edges")[i].as_buffer(), np.int32))
                k = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
                hit = wanted[k] == own
                total[k[hit]] += n[hit]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int32()), "n": pa.array(total[at])})

    out = np.zeros(len(terms), np.int64)
    for row in index.select("terms", "edges").mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row.term] = row.n
    shared.destroy()
    return out


def _searched(index: DataFrame, benchmark: DataFrame, window: int, block_terms: int, schema: str, search) -> DataFrame | None:
    """The stored rows that ``search(shard, ids, keys, phrases)`` finds for all blocks of the benchmark."""
    out = None
    for rows in blocks(benchmark, block_terms):
        q = ranked(rows, window, lambda terms: frequencies(index, terms))
        if q is None:
            continue
        shared = index.sparkSession.sparkContext.broadcast(q)

        def run(batches, shared=shared):
            for batch in batches:
                for i in range(batch.num_rows):
                    found = search(_read(batch, i), batch.column("ids")[i].as_py(), batch.column("keys")[i].as_py(), shared.value)
                    if found is not None:
                        yield found

        part = C.stored(index.mapInArrow(run, schema))
        shared.destroy()
        out = part if out is None else out.unionByName(part)
    return out


MATCHES = "doc_id bigint, item_id string, kind string, start bigint, stop bigint"


def matches(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, slop: int | None = None, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Occurrences of benchmark windows as (doc_id, item_id, kind, start, stop) in words, stop exclusive.

    ``kind`` is 'phrase'; with ``slop``, also 'proximity' for windows whose terms
    occur in order with at most that many words between them.
    """

    def search(shard, ids, keys, q):
        rows = set()
        for phrase, start in shard.find(q):
            for p, s, d in zip(phrase.tolist(), start.tolist(), shard.doc(start).tolist(), strict=True):
                rows.add((ids[d], q.items[q.of_item[p]], "phrase", int(s - shard.starts[d]), int(s - shard.starts[d] + q.length[p])))
        if slop is not None:
            for phrase, first, last in shard.near(q, slop):
                for p, s, e, d in zip(phrase.tolist(), first.tolist(), last.tolist(), shard.doc(first).tolist(), strict=True):
                    row = (int(s - shard.starts[d]), int(e + 1 - shard.starts[d]))
                    if (ids[d], q.items[q.of_item[p]], "phrase", *row) not in rows:
                        rows.add((ids[d], q.items[q.of_item[p]], "proximity", *row))
        if not rows:
            return None
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "item_id", "kind", "start", "stop"])

    index = build_index(docs)
    found = _searched(index, benchmark, window, block_terms, MATCHES, search)
    C.dropped(index)
    return docs.sparkSession.createDataFrame([], MATCHES) if found is None else found


def _hits(shard, ids, keys, q):
    """(key, items, runs): of every document with occurrences the items and the covered runs of words."""
    found: dict[int, set[int]] = {}
    spans: dict[int, list[np.ndarray]] = {}
    for phrase, start in shard.find(q):
        doc = shard.doc(start)
        for d in np.unique(doc).tolist():
            own = doc == d
            found.setdefault(d, set()).update(np.unique(q.of_item[phrase[own]]).tolist())
            spans.setdefault(d, []).append(np.stack([start[own], start[own] + q.length[phrase[own]]], 1) - shard.starts[d])
    if not found:
        return None
    runs = []
    for d in found:
        own = np.unique(np.concatenate(spans[d]), axis=0)
        fresh = np.concatenate(([True], own[1:, 0] > np.maximum.accumulate(own[:, 1])[:-1]))
        last = np.append(np.flatnonzero(fresh)[1:], len(own)) - 1
        runs.append([{"start": int(a), "stop": int(b)} for a, b in zip(own[fresh, 0], np.maximum.accumulate(own[:, 1])[last], strict=True)])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([keys[d] for d in found], pa.int64()), pa.array([sorted({q.items[i] for i in own}) for own in found.values()], pa.list_(pa.string())), pa.array(runs, kind)], ["key", "items", "runs"]
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_items (sorted array of item ids) and contaminated.

    A word is hit when it lies inside an occurrence of a window.
    """
    made = ("n_words", "n_hit", "hit_items", "contaminated")
    keep = [c for c in docs.columns if c not in made]
    index = build_index(docs)
    found = _searched(index, benchmark, window, block_terms, "key bigint, items array<string>, runs array<struct<start:bigint,stop:bigint>>", _hits)
    C.dropped(index)
    base = docs.select(*keep, F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_WORD)).cast("bigint").alias("n_words"))
    if found is None:
        n_hit, items = F.lit(0).cast("bigint"), F.array().cast("array<string>")
        return base.select(*keep, "n_words", n_hit.alias("n_hit"), items.alias("hit_items"), F.lit(False).alias("contaminated"))
    # Rows of one key (equal rows, several blocks) become one.
    merged = found.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_items"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("runs")))).alias("_runs"))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    covered = F.aggregate("_runs", zero, lambda s, x: F.struct((s.n + F.greatest(F.lit(0).cast("bigint"), x.stop - F.greatest(x.start, s.end))).alias("n"), F.greatest(s.end, x.stop).alias("end")))
    merged = C.stored(merged.select(F.col("key").alias("_key"), "_items", covered.n.alias("_n")))
    C.dropped(found)
    hits = F.broadcast(merged) if merged.count() <= BROADCAST_HITS else merged
    met = base.withColumn("_own", _key()).join(hits, F.col("_own") == F.col("_key"), "left")
    return met.select(*keep, "n_words", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("_items", F.array().cast("array<string>")).alias("hit_items"), F.col("_n").isNotNull().alias("contaminated"))


def query(spark, sf_dir: str) -> DataFrame:
    """``op4_decontaminate``: the contract's digest of every document."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, C.table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), "contaminated",
    )


#: The same digest in DuckDB SQL: windows as joined words, matched at every start.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w),10) AS n, array_to_string(w[i:i+least(len(w),10)-1],' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w)-least(len(w),10)+2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i+n-1],' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w)-n+2)) AS i FROM d, ns WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw USING (n, s)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i+n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit,0)::BIGINT AS n_hit, coalesce(n_items,0)::BIGINT AS n_items,
  sha256(coalesce(l,'')) AS items_sha256, coalesce(n_hit,0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""
