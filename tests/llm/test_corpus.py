"""Corpus operators against brute force, libraries and held-out labels, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare
from lumenspan.llm import bpe, components, decontaminate, fingerprint, langid, license_scan, license_texts, near_dedup, pii, queries, token_count, toxicity, url_filter

SF = "/root/testdata/sf0.001"
TRICKY = [
    None, "", " ", "a", "\n\n", "Ünïcödé ß 😀 " * 3, "x" * 60_000, "one two three four five six seven eight nine ten", "one two three four five six seven eight nine ten", "١٢٣ 日本語 한국어",
    "mail bob.x@y.example.com or +1 (212) 555-8457, 10.0.0.1, 4111 1111 1111 1111", "Licensed under the Apache License, Version 2.0.", "<|endoftext|> <s> it's", "a\u0000b \u200b id\u0456ot",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, None, None, 1, "c") for i, t in enumerate(TRICKY)]
    rows += [rows[7], (None, "null id text here", "en", "s", 1, 2, "d"), (None, None, None, None, None, None, None)]
    # Extra columns carry names that the operators use for their own results.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int, n_tokens string").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 0, int(i == 13)) for i in range(14)] + [(13, 0, 0), (None, 0, 1), (99, 1, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "ONE two, three four five six seven eight nine ten"), (2, None), (3, "..."), (4, "Bob"), (1, "mail")], "item_id long, text string")


def empty(df):
    return df.limit(0)


def sizes(df, n):
    got = df.collect()
    assert len(got) == n
    return got


def test_edge_cases_of_every_operator(spark, docs, labels, benchmark):
    n = docs.count()
    none = empty(docs)
    vocab, piece = bpe.vocabulary("word_bpe_49k.json"), bpe.vocabulary("piece_bpe_32k.model")
    model = langid.fit(docs.select("text", "lang"))
    tox = toxicity.fit(docs, labels)
    for own, k in ((docs, n), (none, 0)):
        sizes(license_scan.scan(own), k)
        sizes(langid.identify(own, model), k)
        sizes(bpe.decode(bpe.encode(own, vocab), vocab), k)
        sizes(decontaminate.decontaminate(own, benchmark), k)
        sizes(decontaminate.decontaminate(own, empty(benchmark)), k)
        sizes(pii.sanitise(own), k)
        sizes(token_count.count_tokens(own, piece), k)
        sizes(fingerprint.compare(own), k)
        sizes(fingerprint.fingerprints(own), k)
        sizes(toxicity.score(own, tox), k)
        sizes(near_dedup.near_duplicates(own), k)
    assert langid.fit(none.select("text", "lang")).langs == []
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(none)).collect()} == {"und"}
    assert toxicity.fit(docs, empty(labels)).weights == {}
    assert {r.toxicity for r in toxicity.score(docs, toxicity.ToxicityModel({})).collect()} == {0.0}
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 8").count() == 0


def test_fingerprint_of_one_and_of_equal_rows(spark):
    one = spark.createDataFrame([(5, "abc def")], "doc_id long, text string")
    r = fingerprint.compare(one).first()
    assert r.near_next == 1.0 and r.n_chars == 7
    same = spark.createDataFrame([(1, "q w e"), (1, "q w e"), (2, "")], "doc_id long, text string")
    assert len({r.fingerprint for r in fingerprint.compare(same).where("doc_id = 1").collect()}) == 1


def _paragraphs(text):
    """The rule of fingerprint.paragraphs, word by word."""
    words, own, out = re.findall(r"[^ \t\n\x0b\f\r]+|\n", text), [], []
    for i, w in enumerate(words, 1):
        own.append(w)
        if w == "\n" or xxhash.xxh64_intdigest(w.encode(), 42) % fingerprint.CUT == 0 or i in fingerprint.FIRST or i == len(words) or len(own) == fingerprint.MOST:
            out.append(" ".join(own).rstrip(" \n"))
            own = []
    return [x for x in out if x]


def test_paragraphs_follow_the_content(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randint(0, 50)}" for _ in range(n)) for n in (0, 1, 2, 5, 9, 200, 500)] + ["same " * 200, "a\nb\n\nc d", "\n", " x\ty "]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fingerprint.paragraphs(F.col("t")).alias("p")).collect()
    assert {r.i: r.p for r in got} == {i: _paragraphs(t) for i, t in enumerate(texts)}
    # A word put in changes the paragraph around it and those of the first words.
    long = " ".join(f"w{rng.randint(0, 500)}" for _ in range(600))
    assert len(set(_paragraphs(long)) - set(_paragraphs(long[:1500] + " new" + long[1500:]))) <= 3


def test_stuck_tables_are_exact(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "LOAD", 200)
    monkeypatch.setattr(fingerprint, "DEPTH", 1)
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(400))) for i in range(4)]
    got = {r.doc_id: r.near_next for r in fingerprint.compare(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        a, b = set(_paragraphs(t)), set(_paragraphs(rows[i - 1][1]))
        assert abs(got[i] - len(a & b) / len(a | b)) < 1e-9


def test_fingerprint_against_sets(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    rows[7] = (7, rows[8][1])
    got = {r.doc_id: r for r in fingerprint.compare(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    pieces = lambda t: set(_paragraphs(t))
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    down = rows[::-1]
    for i, (k, t) in enumerate(down):
        nxt = down[(i + 1) % len(down)][1]
        q = len(t) // 3
        edited = t[: len(t) - q] + nxt[:q]
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors = abs(got[k].near_edited - like(pieces(t), pieces(edited))), abs(got[k].near_next - like(pieces(t), pieces(nxt)))
        assert max(errors) < 1e-9
    assert got[8].fingerprint == got[7].fingerprint and got[8].near_next == 1.0


def test_next_document_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_ROWS", 7)
    ids = [*range(0, 90, 3), 1000, 2000, 2001]
    got = {r.doc_id: r.next_text for r in fingerprint.with_next(spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string")).collect()}
    assert got == {i: str(ids[k - 1]) for k, i in enumerate(ids)}
    # Rows without an id follow, by the hash of their text, in ranges of their own.
    rows = [(i, str(i)) for i in ids] + [(None, f"n{k}") for k in range(40)]
    got = {r.text: r.next_text for r in fingerprint.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    bare = sorted((t for i, t in rows if i is None), key=lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - (xxhash.xxh64_intdigest(t.encode(), 42) >> 63 << 64))
    order = [str(i) for i in sorted(ids, reverse=True)] + bare
    assert got == {t: order[(k + 1) % len(order)] for k, t in enumerate(order)}


def test_binary_search_of_edges(spark):
    edges = [5, -3, 5000, 77, 12]
    got = spark.range(-10, 6000, 7).select("id", fingerprint._above(edges, F.col("id")).alias("n")).collect()
    assert all(r.n == sum(e > r.id for e in edges) for r in got)


def test_peeling_recovers_digests(spark):
    df = spark.createDataFrame([([1 << 40, -5, 77], [77, 9, 1 << 40])], "x array<long>, y array<long>")
    hashed = lambda c: F.transform(c, lambda k: F.xxhash64(k))
    r = df.select(fingerprint.peel(fingerprint.subtract(fingerprint.cells(hashed("x")), fingerprint.cells(hashed("y")))).alias("p"), F.xxhash64(F.lit(-5).cast("long")).alias("a"), F.xxhash64(F.lit(9).cast("long")).alias("b")).first()
    assert r.p.ok and {(d.k, d.s) for d in r.p.only} == {(r.a, 1), (r.b, -1)}


def test_bpe_and_counts_against_the_libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    rng = random.Random(1)
    alphabets = ("ab'sté ▁<>|\n日本😀 1", "abc theinr", " a")
    texts = [t or "" for t in TRICKY] + ["".join(rng.choice(a) for _ in range(rng.randint(0, 80))) for a in alphabets for _ in range(700)] + ["".join(map(chr, range(256))) + "".join(f"a{chr(i)}b{chr(i)}1" for i in range(256)), "ΑΣ ΣΑΣ ς İı", "<|startoftext|>a<|endoftext|>"]
    own, theirs = bpe.WordBpe(bpe.vocabulary("word_bpe_49k.json")), Tokenizer.from_file(bpe.vocabulary("word_bpe_49k.json"))
    want = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert own.encode_batch(texts) == want
    assert [own.decode(i) for i in want] == [theirs.decode(i, skip_special_tokens=False) for i in want]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert own.digest_batch(texts) == [(len(i), sha(" ".join(map(str, i))), sha(theirs.decode(i, skip_special_tokens=False))) for i in want]
    path = bpe.vocabulary("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    assert token_count.PieceBpe(path).count_batch(texts) == [len(sp.encode(t)) for t in texts]


def test_other_vocabularies_are_refused(tmp_path):
    import json

    spec = json.loads(Path(bpe.vocabulary("word_bpe_49k.json")).read_text())
    for change in ({"normalizer": None}, {"pre_tokenizer": {"type": "Sequence", "pretokenizers": spec["pre_tokenizer"]["pretokenizers"][1:]}}, {"model": spec["model"] | {"dropout": 0.1}}):
        (tmp_path / "x.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError, match="another pipeline"):
            bpe.WordBpe(str(tmp_path / "x.json"))


def test_bpe_cache_restarts(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    monkeypatch.setattr(token_count, "CACHE", 3)
    b = bpe.WordBpe(bpe.vocabulary("word_bpe_49k.json"))
    fresh = bpe.WordBpe(bpe.vocabulary("word_bpe_49k.json"))
    for t in ("a b c d", "c d e f g", "a g"):
        assert b.encode_batch([t]) == fresh.encode_batch([t])
        assert b.digest_batch([t]) == fresh.digest_batch([t])
    p = token_count.PieceBpe(bpe.vocabulary("piece_bpe_32k.model"))
    assert [p.count_batch([t])[0] for t in ("a b c d", "c d e f g")] == [4, 5]


def test_base_spans_against_plain_patterns():
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def brute(t):
        for kind, p in plain.items():
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m[0])
                ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and pii.luhn(d), "phone": 8 <= len(d) <= 15}
                if ok[kind]:
                    yield kind, *m.span()

    rng = random.Random(3)
    for a in ("a1.@-+ 12()é", "12 -41111", "0.125@x"):
        for _ in range(8000):
            t = "".join(rng.choice(a) for _ in range(rng.randint(0, 44)))
            assert pii.base_spans(t) == list(brute(t)), t


def test_disclosing_terms(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(7))
    rows = [" ".join(word() for _ in range(30)) for _ in range(300)]
    rows += [f"{word()} {word()} codename Zebrastar ann@x.example.com {word()} {word()}" for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = pii.sanitise(df).where("size(term_spans) > 0").collect()
    assert len(found) == 5 and all("[TERM] [TERM] [EMAIL]" in r.redacted for r in found)
    assert pii.sanitise(df).where("size(base_spans) = 0 and text <> redacted").count() == 0


def test_disclosing_terms_anywhere(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(7))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [text(60) for _ in range(300)]
    # Titles 40 words before the address, the name of two letters, the same words next to every address.
    rows += [f"Zebrastar report {i}. {text(40)} please write to us in time at ann@x.example.com for all news {text(30)} Ng, zebrastar" for i in range(4)]
    rows += ["Zebrastar report without an address", rows[-1]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.sanitise(df).collect()}
    for i in (300, 301, 302, 303, 305):
        t = found[i].redacted
        assert t.startswith("[TERM] ") and t.endswith("[TERM], [TERM]") and "[EMAIL]" in t, t
    assert found[304].redacted == rows[304] and not any(found[i].term_spans for i in range(300))
    # Three copies are one document: nothing is known of their entity.
    few = spark.createDataFrame([(i, f"{rows[300]}") for i in range(3)] + [(9, rows[0])], "doc_id long, text string")
    assert pii.sanitise(few).where("size(term_spans) > 0").count() == 0


def _closure(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_link_bucket_against_all_pairs():
    rng = np.random.default_rng(1)
    base = np.arange(20, dtype=np.uint64)
    for _ in range(400):
        n = int(rng.integers(1, 25))
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(12, 20), replace=False), rng.choice(np.arange(100, 103, dtype=np.uint64), rng.integers(0, 2))])) for _ in range(n)]
        roots = np.where(rng.random(n) < 0.3, 0, np.arange(n))
        given = [(int(np.flatnonzero(roots == r)[0]), int(i)) for r in set(roots.tolist()) for i in np.flatnonzero(roots == r)]
        percent = int(rng.integers(60, 95))
        pairs = [(i, j) for i in range(n) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))]
        got = near_dedup.link_bucket(np.arange(n), roots, sets, percent)
        assert all((max(x), min(x)) in pairs for x in got)
        assert _closure(n, pairs + given) == _closure(n, got + given)


def _mutated(rng, n_groups, size):
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    out = []
    for _ in range(n_groups):
        base = [word() for _ in range(60)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(60)] = word()
            out.append(" ".join(own))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [1024, 8])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = _mutated(random.Random(7), 12, 20) + ["", "a b", "A  b", "lone words"]
    sets = [near_dedup.shingles(t, 3) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i]) and len(sets[j]) and 100 * (k := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (len(sets[i]) + len(sets[j]) - k)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), k=3, percent=85).collect()}
    assert [got[i] for i in range(len(texts))] == _closure(len(texts), pairs)


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(1, 2**63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2400], rng.integers(1, 2**63, 600, dtype=np.uint64)])
    same = (near_dedup.superminhash(a, 512) == near_dedup.superminhash(b, 512)).mean()
    assert abs(same - 2400 / 3600) < 0.06
    assert (near_dedup.superminhash(a[:3], 64) < 64).all()


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(chain).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components.components(empty(chain)).count() == 0


def test_matches_and_blocks(spark, docs, benchmark):
    whole = decontaminate.decontaminate(docs, benchmark).select("doc_id", "n_words", "n_hit", "hit_items")
    parts = decontaminate.decontaminate(docs, benchmark, block_terms=1).select("doc_id", "n_words", "n_hit", "hit_items")
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    hit = {r.doc_id: (r.n_hit, r.hit_items) for r in whole.collect()}
    assert hit[7] == (10, ["1"]) and hit[10] == (2, ["1", "4"]) and hit[0] == (0, [])
    near = spark.createDataFrame([(1, "one big two and three four five six seven eight nine ten")], "doc_id long, text string")
    assert [r.kind for r in decontaminate.matches(near, benchmark.where("text like 'ONE%'"), slop=3).collect()] == ["proximity"]
    assert [(r.start, r.stop) for r in decontaminate.matches(docs.where("doc_id = 7"), benchmark).distinct().collect()] == [(0, 10)]


def test_proximity_against_brute_force(spark):
    rng = random.Random(12)
    word = lambda: rng.choice("abcdefgh")
    docs = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(40)]
    items = [" ".join(word() for _ in range(rng.randint(1, 6))) for _ in range(12)]

    def tightest(words, own):
        best = None
        for at in range(len(words)):
            if words[at] == own[0]:
                last = at
                for w in own[1:]:
                    last = next((k for k in range(last + 1, len(words)) if words[k] == w), None)
                    if last is None:
                        break
                else:
                    best = min(best or 10**9, last - at + 1)
        return best

    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for block_terms in (decontaminate.BLOCK_TERMS, 5):
        got = decontaminate.matches(d, b, window=4, slop=2, block_terms=block_terms).collect()
        exact, near = defaultdict(set), set()
        for i, t in enumerate(docs):
            w = t.split()
            for j, x in enumerate(items):
                own = x.split()
                n = min(4, len(own))
                for k in range(len(own) - n + 1):
                    part = own[k : k + n]
                    exact[i, j] |= {(s, s + n) for s in range(len(w) - n + 1) if w[s : s + n] == part}
                    span = tightest(w, part)
                    if span is not None and span <= n + 2:
                        near.add((i, str(j)))
        assert {(r.doc_id, r.item_id, r.start, r.stop) for r in got if r.kind == "phrase"} == {(i, str(j), *x) for (i, j), found in exact.items() for x in found}
        assert {(r.doc_id, r.item_id) for r in got} == near


def test_shards_hold_the_postings():
    texts = ["One two, one", "", "TWO\tthree ... one"]
    s = decontaminate.Shard.of(texts)
    assert s.starts.tolist() == [0, 4, 5]
    of = lambda w: s.positions[s.edges[k] : s.edges[k + 1]].tolist() if (k := int(s.term(decontaminate.terms_of(w))[0])) >= 0 else []
    assert of("one") == [0, 2, 7] and of("two") == [1, 5] and of("three") == [6] and of("four") == []


def test_index_is_read_in_bounded_pieces(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(25_000)) for i in range(60)]
    index = decontaminate.build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1))
    files = [pq.ParquetFile(f.removeprefix("file:")) for f in index.inputFiles()]
    groups = [f.metadata.row_group(i).total_byte_size for f in files for i in range(f.metadata.num_row_groups)]
    bound = 8 << 20  # 4 MB and the shard that exceeds them
    assert sum(groups) > 2 * bound and max(groups) < bound

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    assert max(r.n for r in index.mapInArrow(held, "n long").collect()) < bound
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512


def test_url_rules(spark):
    urls = [None, "nothing", "http://A.Example.ORG/en/17?x", "https://example.org/es/", "https://notexample.org/es/", "http://a.b.com/de/1", "http://com", "x://h.com/fr/#q", "http://u@example.org:80/es/", "a://b://example.org/es/"]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)] + [(None, None, None)], "page_id long, url string, rule string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rules_frame(spark, url_filter.RULES)).collect()}
    assert got[2] == ("example.org/en/1", "block") and got[3] == ("example.org/es/", "block") and got[4] == ("org/", "allow")
    assert got[5] == ("com/de/", "block") and got[6] == (None, "allow") and got[7] == ("com/fr/", "allow") and got[0] == got[1] == (None, "allow")
    assert url_filter.judge(empty(pages), url_filter.rules_frame(spark, [])).count() == 0


UNSEEN = ("You can redistribute this under {0} terms.", "This code base uses the {0} (see COPYING)", "Copyright (c) 2021 J. Doe, {0}")


def test_license_families(spark):
    m = license_scan.model()
    texts = [(f, t) for f, t in license_texts.wordings(UNSEEN)]
    right = [f == p[0] and p[2] for f, t in texts for p in [m.predict(t)]]
    assert np.mean(right) > 0.98
    strange = [*license_texts.foreign(("Oscorp", "Tyrell Corp", "Weyland"), license_texts.HELD_FORMS + license_texts.FORMS), *license_texts.ORDINARY]
    assert not any(m.predict(t)[2] for t in strange)
    probes = {
        "SPDX-License-Identifier: ISC": "isc", "SPDX-License-Identifier: EPL-2.0": "epl", "Licensed under CC BY-ND 4.0.": "cc-by-nd", "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa",
        "Distributed under the terms of the MIT license.": "mit", "All rights reserved.": "proprietary", "SPDX-License-Identifier: Foo-1.0": "unknown", "the of and": "unknown", "Released under the MIT Licence": "mit",
    }
    got = {r.doc_id: r.license for r in license_scan.scan(spark.createDataFrame([(i, f"before\n{t}\nafter") for i, t in enumerate(probes)], "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(probes))] == list(probes.values())
    lines = [t for _, t in license_texts.templates()] + strange[::40] + list(probes)
    native = license_scan.paragraphs(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).collect()
    assert len(native) > 150
    for r in native:
        f, p, c = m.predict(lines[r.paragraph])
        assert (r.family, r.confirmed) == (f, c) and abs(r.probability - p) < 1e-6


def test_wrapped_notices(spark):
    gpl = (
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\n"
        "You should have received a copy of the GNU General Public License\nalong with this program.  If not, see <https://www.gnu.org/licenses/>."
    )
    mit = (
        'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\n'
        "The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software."
    )
    lesser = gpl.replace("General Public License", "Lesser General Public\nLicense").replace("program", "library")
    comment = lambda t, mark: "\n".join(f"{mark}{x}".rstrip() for x in t.split("\n"))
    texts = {
        gpl: (2, "gpl", "gpl"), comment(gpl, "# ") + "\n\nimport os\n": (2, "gpl", "gpl"), "/*\n" + comment(mit, " * ") + "\n */\nint x;\n": (2, "mit", "mit"), comment(lesser, "-- "): (2, "lgpl", "lgpl"),
        # Lines that are notices themselves count once, in a block or not.
        "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.\nReleased under the MIT License.": (3, "mit", "apache,mit"),
        "The copyright of songs is old.\nMany rights exist in the law.\nSeats were reserved for all.": (0, "unknown", ""),
    }
    got = {r.doc_id: (r.n_notices, r.license, r.licenses) for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_fold_and_exceptions():
    m = toxicity.ToxicityModel({"idiot": 5.0, "trash": 5.0, "vequ*": 4.0}, coefficients=(-3.0, 1.0, 1.0))
    for t in ("IDIOT", "id1ot", "1d10t", "іdiоt", "i\u200bdiot", "ｉｄｉｏｔ", "vequabc"):
        assert len(m.hits(toxicity.fold(t))) == 1, t
    for t in ("idiots", "trash can", "vequ", "xvequab", "10 1", "Trash  cans", "trash-can", "TRASH\ncollection"):
        assert not m.hits(toxicity.fold(t)), t
    assert m.score(m.measures("you idiot")[:2]) > 0.5 > m.score(m.measures("you")[:2])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = langid.query(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    rows = toxicity.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.75
    assert sum(r.predicted for r in rows if not r.toxic) <= 1


def test_hits_against_a_naive_matcher():
    rng = random.Random(2)
    weights = {"abc": 1.0, "ab*": 2.0, "bca": 1.5, "c*": 0.5, "abca*": 3.0}
    m = toxicity.ToxicityModel(weights, ("abc bc",), (0.0, 1.0, 1.0))
    for _ in range(1500):
        text = "".join(rng.choice("abc  -") for _ in range(rng.randint(0, 30)))
        excepted = [x.span() for x in re.finditer(r"(?<![a-z])abc[\W_]+bc(?:s|es)?(?![a-z])", text)]
        want = []
        for w in re.finditer("[a-z]+", text):
            fit = [(len(e.rstrip("*")), v) for e, v in weights.items() if (w[0].startswith(e[:-1]) and len(w[0]) > len(e) - 1 if e.endswith("*") else w[0] == e)]
            if fit:
                n, v = max(fit)
                if not any(a <= w.start() and w.start() + n <= b for a, b in excepted):
                    want.append((w.start(), w.start() + n, v))
        assert m.hits(text) == want, text


def _languages():
    con = duckdb.connect()
    rows = con.execute("SELECT text, lang FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL AND lang IS NOT NULL ORDER BY doc_id").fetchall()
    langs = sorted({x for _, x in rows})
    counts = np.zeros((1 << langid.BITS, len(langs)))
    for t, x in rows[:600]:
        counts[:, langs.index(x)] += np.bincount(langid.trigrams(t), minlength=1 << langid.BITS)
    p = (counts + 0.05) / (counts + 0.05).sum(0)
    return langid.LanguageModel(langs, np.log(p).astype(np.float32)), {x: [t for t, y in rows[600:] if y == x and len(t) > 800] for x in langs}


def test_language_mixtures():
    model, texts = _languages()
    rng = random.Random(4)
    for n in (2, 3, 4):
        right, errors = 0, []
        for _ in range(40):
            own = rng.sample(model.langs, n)
            sizes = {x: rng.choice((500, 700, 900)) for x in own}
            mixed = " ".join((rng.choice(texts[x]) * 2)[:k] for x, k in sizes.items())
            lang, score, shares = langid.infer([mixed], model)[0]
            right += set(shares) == set(own)
            errors.append(max(abs(shares.get(x, 0) - k / sum(sizes.values())) for x, k in sizes.items()))
            assert abs(sum(shares.values()) - 1) < 1e-3 and score == shares[lang] == max(shares.values())
        assert right >= 38 and np.mean(errors) < 0.08, (n, right, np.mean(errors))


def test_language_sets_against_all_subsets():
    from itertools import combinations

    model, texts = _languages()
    rng = random.Random(5)
    same = 0
    for _ in range(60):
        own = rng.sample(model.langs, rng.randint(1, 4))
        text = " ".join(rng.choice(texts[x])[: rng.choice((60, 200, 600))] for x in own)
        c = np.bincount(langid.trigrams(text), minlength=1 << langid.BITS)
        k = np.flatnonzero(c)
        p, n = np.exp(model.log_p[k].astype(float)), c[k]
        price, best = 0.5 * np.log(n.sum()) / langid.INDEPENDENT, (-np.inf, ())
        for size in range(1, 5):
            for subset in combinations(range(4), size):
                pi = np.full(size, 1 / size)
                for _ in range(60):
                    joint = p[:, subset] * pi
                    pi = (joint * (n / joint.sum(1))[:, None]).sum(0) / n.sum()
                best = max(best, (float((n * np.log((p[:, subset] * pi).sum(1))).sum()) - (size - 1) * price, subset))
        same += {model.langs[j] for j in best[1]} == set(langid.infer([text], model)[0][2])
    assert same >= 57, same


def test_groups_of_texts_do_not_matter(monkeypatch):
    model, texts = _languages()
    own = [t for x in model.langs for t in texts[x][:8]] + ["", "1"]
    whole = langid.infer(own, model)
    monkeypatch.setattr(langid, "GROUP", 3000)
    for a, b in zip(whole, langid.infer(own, model), strict=True):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-3


@pytest.mark.parametrize(("outside", "rounds", "block"), [(0, 1, 8), (0, 3, 8), (2, 2, 1024)])
def test_open_buckets_are_exact(spark, monkeypatch, outside, rounds, block):
    monkeypatch.setattr(near_dedup, "OUTSIDE", outside)
    monkeypatch.setattr(near_dedup, "ROUNDS", rounds)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "SALT_ROWS", 5)
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**62, 60)
    sets = [np.unique(np.concatenate([rng.choice(base, 56, replace=False), rng.integers(0, 2**62, rng.integers(0, 4))])) for _ in range(60)]
    pairs = [(i, j) for i in range(60) for j in range(i) if 100 * (k := len(np.intersect1d(sets[i], sets[j]))) >= 88 * (len(sets[i]) + len(sets[j]) - k)]
    listed = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(sets)], "rep long, elements array<long>")
    members = spark.createDataFrame([(7, i, len(x), 60, i % 13, 60) for i, x in enumerate(sets)], "key long, rep long, size int, n long, salt int, weight long")
    got = {r.node: r.root for r in near_dedup.verified(members, listed, 88).collect()}
    assert [got.get(i, i) for i in range(60)] == _closure(60, pairs)


def test_members_are_placed_twice_at_most(spark, monkeypatch):
    """Six groups in one bucket, each found by a pivot of its own, and a bucket that the first pivot settles."""
    monkeypatch.setattr(near_dedup, "OUTSIDE", 0)
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(base, 58, replace=False)) for base in (rng.integers(0, 2**62, 60) for _ in range(7)) for _ in range(8)]
    listed = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(sets)], "rep long, elements array<long>")
    rows = [(7, i, 58, 48, 0, 48 - i) for i in range(48)] + [(8, i, 58, 8, 0, 8) for i in range(48, 56)]
    members = spark.createDataFrame(rows, "key long, rep long, size int, n long, salt int, weight long")
    placed, open_buckets = [], near_dedup._open
    monkeypatch.setattr(near_dedup, "_open", lambda m, u: placed.append(m.count()) or open_buckets(m, u))
    got = {r.node: r.root for r in near_dedup.verified(members, listed, 88).collect()}
    assert got == {i: i // 8 * 8 for i in range(56)}
    assert placed == [56, 48]


def _brute_disclosure(texts):
    """(entity, term) pairs at the threshold, counted document by document."""
    found = []
    for t in texts:
        base = pii.base_spans(t or "")
        found.append(({pii._entity(k, t[s:e]) for k, s, e in base}, {w for w, _, _ in pii._outside(t or "", base)}, set(pii._WORD.findall((t or "").lower()))))
    df = defaultdict(int)
    for _, _, words in found:
        for w in words:
            df[w] += 1
    out, n = set(), len(texts)
    for e in set().union(*[x[0] for x in found]):
        own = [x for x in found if e in x[0]]
        if len({tuple(sorted(x[1])) for x in own}) < pii.MIN_CONTEXTS:
            continue
        for w in set().union(*[x[1] for x in own]):
            held = [x for x in own if w in x[1]]
            if len({tuple(sorted(x[1])) for x in held}) >= pii.MIN_CONTEXTS:
                pmi = np.log2(len(held) / len(own) * n / max(df[w], len(held)))
                if pmi / max(np.log2(n / len(own)), 1e-9) >= pii.DISCLOSURE:
                    out.add((e, w))
    return out


def test_disclosure_against_counting(spark, monkeypatch):
    monkeypatch.setattr(pii, "VOCABULARY", 50)
    rng = random.Random(11)
    names = ["ann@x.example.com", "bob@y.example.org", "10.1.2.3"]
    texts = [None, ""] + [" ".join([rng.choice(["zeta", "omega"]) if k else "", rng.choice(names) if rng.random() < 0.4 else "", *(f"{rng.choice('abcdefgh')}{rng.choice('klmn')}" for _ in range(12))]) for k in range(120)]
    texts += [f"zebra {names[0]} {i}x{'abcdefgh'[i]}" for i in range(6)]
    texts += texts[-2:]  # copies count as documents, not as contexts
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = _brute_disclosure(texts)
    assert want and {(r.entity, r.term) for r in pii.disclosing(df).collect()} == want


def test_secrets():
    hexa = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    for t in (f'token = "{hexa}"', hexa.upper(), "key:AKza9/Sd83Kf02mNq71PzX_c"):
        assert [k for k, _, _ in pii.secrets(t, [])] == ["secret"], t
    for t in ("a" * 50, "1" * 40, "x" * 30 + "1", "internationalization of things", "0123456789", f"me.{hexa}@example.com"):
        assert not pii.secrets(t, pii.base_spans(t)), t


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    said = compare(spark, con, name, queries.QUERIES[name], queries.ORACLES.get(name), SF)
    assert "FAIL" not in said and ": 0 rows" not in said, said


def test_bands_follow_the_threshold(spark, monkeypatch):
    used = []
    signatures = near_dedup.signatures
    monkeypatch.setattr(near_dedup, "signatures", lambda docs, k, bands, rows: used.append((bands, rows)) or signatures(docs, k, bands, rows))
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "h i j k l")], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()} == {1, 3}
    near_dedup.near_duplicates(docs, k=3, percent=85).count()
    for (bands, rows), likeness in zip(used, (0.8, 0.85), strict=True):
        assert (1 - likeness**rows) ** bands <= 1e-5 < (1 - likeness**rows) ** (bands - 1)


def test_pipeline_looks_for_short_items(spark, tmp_path):
    spark.createDataFrame([(1, "Which river crosses Paris"), (2, " ".join(f"word{i}" for i in range(20)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["He asks: which river crosses Paris? None.", "which river crosses the town", " ".join(f"word{i}" for i in range(5, 15)), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()} == {1, 3}


def test_stages_keep_columns_and_empty_input(spark, docs):
    clash = docs.select("doc_id", "text", *[F.lit(-5).alias(c) for c in ("n_words", "predicted", "toxicity", "contaminated", "base_spans", "redacted", "_own_n_words", "n_hit", "kept", "component_id")], F.lit(7).cast("bigint").alias("n_chars"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, clash, SF)
        assert got.columns == clash.columns, name
        rows = got.collect()
        assert rows and all(r[c] == -5 for r in rows for c in clash.columns[2:-1]), name
        assert any(r.text is None for r in rows) and any(r.text == "" for r in rows) and any(r.doc_id is None for r in rows), name
        assert stage(spark, empty(clash), SF).count() == 0
    out = corpus_pipeline.encode(spark, clash, SF)
    assert out.columns == [*clash.columns, "token_ids", "n_tokens"]
    assert all((r.n_tokens == 0) == (not (r.text or "").strip()) for r in out.collect())
    assert corpus_pipeline.encode(spark, empty(clash), SF).count() == 0


def test_pipeline_against_its_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    left = {i: t for i, t in rows.items() if model.score(model.measures(t)[:2]) < toxicity.THRESHOLD}
    sets = {i: near_dedup.shingles(t, 5) for i, t in left.items()}
    ids = sorted(left)
    pairs = [(a, b) for a in range(len(ids)) for b in range(a) if len(x := sets[ids[a]]) and len(y := sets[ids[b]]) and 100 * (k := len(np.intersect1d(x, y))) >= 80 * (len(x) + len(y) - k)]
    roots = _closure(len(ids), pairs)
    left = {ids[i]: left[ids[i]] for i in range(len(ids)) if roots[i] == i}
    found = defaultdict(set)
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    for (item,) in [(r.text,) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]:
        if w := words(item):
            n = min(10, len(w))
            found[n] |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    leaks = lambda t: any(tuple(w[k : k + n]) in s for w in [words(t)] for n, s in found.items() for k in range(len(w) - n + 1))
    left = {i: t for i, t in left.items() if not leaks(t)}
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[: len(docs.columns)] == docs.columns
    out = got.collect()
    assert {r.doc_id for r in out} == set(left)
    b = bpe.WordBpe(bpe.vocabulary("word_bpe_49k.json"))
    assert all(r.token_ids == e for r, e in zip(out, b.encode_batch([r.text for r in out]), strict=True))
    reveals = _brute_disclosure(list(left.values()))

    def clean(t):
        base = pii.base_spans(t)
        terms = {w for e, w in reveals if e in {pii._entity(k, t[s:e]) for k, s, e in base}}
        spans = sorted(base + pii.secrets(t, base) + [("term", s, e) for w, s, e in pii._outside(t, base + pii.secrets(t, base)) if w in terms], key=lambda x: (x[1], -x[2]))
        made, at = "", 0
        for kind, s, e in spans:
            if s >= at:
                made += t[at:s] + f"[{kind.upper()}]"
            at = max(at, e)
        return made + t[at:]

    assert all(r.text == clean(left[r.doc_id]) for r in out)
    assert all(r.n_chars == len(r.text) for r in out)
