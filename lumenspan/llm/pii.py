"""Personal data: base patterns and information-theoretic sanitisation.

Base spans are e-mail and IP addresses, card and phone numbers.  Beyond them,
corpus statistics tell which terms give a protected entity away: for an entity
e (a found value) and a term t (a word outside the base spans, of any length),

    pmi(t, e) = log2(p(t | e) / p(t)),  disclosure(t, e) = pmi(t, e) / -log2 p(e)

where p(t | e) is the share of e's documents that hold t anywhere, p(t) the
share of all documents that hold t, and p(e) the share of documents with e; all
three count documents, copies included.  A term whose disclosure reaches
``DISCLOSURE`` and that stands with e in at least ``MIN_CONTEXTS`` documents
that differ outside their base spans becomes a span of kind ``term`` wherever it
occurs in a document with e.  Tokens that carry much information by themselves
(``SECRET_LENGTH`` characters or more, letters and digits, at least
``SECRET_BITS`` bits a character) are spans of kind ``secret``.  ``redact``
removes base spans and secrets in favour of their kind and generalises terms to
``[TERM]``.

Counts cover all documents and meet in joins: term frequencies with the terms of
protected entities, revealing terms with the texts that hold their entities, and
those with the documents by the hash of their text.

Defined cases: a null text is an empty one and has no spans (and stays null
when redacted); documents with the same words outside their base spans
(copies) count once, repeated rows are each judged; a run of letters is one
word, also in scripts without spaces; overlapping spans of different kinds are
all reported, and redacted once, as the kind that starts first; further columns
are carried along.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C

MIN_CONTEXTS = 3
DISCLOSURE = 0.75
#: Least length of a secret, and bits of information of each of its characters.
SECRET_LENGTH, SECRET_BITS = 20, 3.0
#: Distinct words that a task counts before it hands them on.
VOCABULARY = 200_000
#: Texts with revealing terms that a join may broadcast.
BROADCAST_TEXTS = 200_000
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is only entered at its start: its later digits fail where the first does.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]+")


def emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, kinds as listed, then by start; code points, end exclusive."""
    out = [("email", s, e) for s, e in emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _value(kind: str, found: str) -> str:
    """What makes two findings the same entity: numbers by their digits."""
    return f"{kind}:{found.lower() if kind in ('email', 'ip') else _NOT_DIGIT.sub('', found)}"


def _entity(kind: str, found: str) -> int:
    return int.from_bytes(hashlib.blake2b(_value(kind, found).encode(), digest_size=8).digest(), "big", signed=True)


def _outside(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The words (lower-cased, start, end) that no base span touches."""
    covered = bytearray(len(text))
    for _, s, e in base:
        covered[s:e] = b"\1" * (e - s)
    return [(m[0].lower(), *m.span()) for m in _WORD.finditer(text) if covered.find(1, *m.span()) < 0]


def secrets(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """High-entropy tokens that no base span touches, as ('secret', start, end)."""
    out = []
    if not _DIGIT.search(text):
        return out
    for m in _TOKEN.finditer(text):
        n = m.end() - m.start()
        if n < SECRET_LENGTH or any(s < m.end() and m.start() < e for _, s, e in base):
            continue
        counts = Counter(m[0])
        digits = sum(k for c, k in counts.items() if c.isdigit())
        letters = sum(k for c, k in counts.items() if c.isalpha())
        if min(digits, letters) * 8 >= n and -sum(k / n * math.log2(k / n) for k in counts.values()) >= SECRET_BITS:
            out.append(("secret", *m.span()))
    return out


FINDINGS = "hash bigint, n bigint, context bigint, entities array<bigint>, terms array<string>"


def _hashed(docs: DataFrame) -> DataFrame:
    """``docs`` with _hash, that of the text."""
    return docs.withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def findings(docs: DataFrame) -> DataFrame:
    """Stored (hash, n, context, entities, terms) of the distinct texts with base spans.

    ``n`` counts rows, ``hash`` is that of the text, ``context`` that of its terms.
    """
    C.prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            rows: dict[int, list] = {}
            for text, own in zip(C.texts(batch), batch.column("_hash").to_pylist(), strict=True):
                if own in rows:
                    rows[own][1] += 1
                elif base := base_spans(text):
                    terms = sorted({t for t, _, _ in _outside(text, base)})
                    key = int.from_bytes(hashlib.blake2b(" ".join(terms).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
                    rows[own] = [own, 1, key, sorted({_entity(kind, text[s:e]) for kind, s, e in base}), terms]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))
            columns = list(zip(*rows.values(), strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["hash", "n", "context", "entities", "terms"])

    found = _hashed(docs).select("text", "_hash").mapInArrow(run, FINDINGS)
    return C.stored(found.groupBy("hash").agg(F.sum("n").alias("n"), F.first("context").alias("context"), F.first("entities").alias("entities"), F.first("terms").alias("terms")))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df): how many of all documents hold each word; counted in the tasks first."""

    def count(batches):
        total: Counter = Counter()

        def handed():
            return pa.RecordBatch.from_pydict({"term": pa.array(list(total), pa.string()), "df": pa.array(list(total.values()), pa.int64())})

        for batch in batches:
            for text in C.texts(batch):
                total.update(set(_WORD.findall(text.lower())))
                if len(total) > VOCABULARY:
                    yield handed()
                    total.clear()
        yield handed()

    return docs.select("text").mapInArrow(count, "term string, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def disclosing(docs: DataFrame, found: DataFrame | None = None, *, threshold: float = DISCLOSURE, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """Stored (entity, term, disclosure) of the terms that reveal a protected entity; ``found`` are the :func:`findings` of ``docs``."""
    own = findings(docs) if found is None else found
    # Documents of one context and the same entities count once as contexts, and each as a document.
    contexts = own.groupBy("context", "entities").agg(F.first("terms").alias("terms"), F.sum("n").alias("n"))
    contexts = C.stored(contexts.select("context", F.explode("entities").alias("entity"), "terms", "n"))
    sizes = C.stored(contexts.groupBy("entity").agg(F.count_distinct("context").alias("k"), F.sum("n").alias("n_e")).where(F.col("k") >= min_contexts).drop("k"))
    kept = contexts.join(sizes.select("entity"), "entity", "left_semi")
    per = kept.select("entity", "context", "n", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count_distinct("context").alias("k"), F.sum("n").alias("n_te"))
    together = C.stored(per.where(F.col("k") >= min_contexts).drop("k"))
    if together.isEmpty():
        out = docs.sparkSession.createDataFrame([], "entity bigint, term string, disclosure double")
    else:
        n = docs.count()
        pmi = F.log2(F.col("n_te") / F.col("n_e") * F.lit(float(n)) / F.greatest("df", F.col("n_te")))
        whole = F.greatest(F.log2(F.lit(float(max(n, 1))) / F.col("n_e")), F.lit(1e-9))
        met = together.join(document_frequencies(docs), "term").join(sizes, "entity")
        out = C.stored(met.select("entity", "term", (pmi / whole).alias("disclosure")).where(F.col("disclosure") >= threshold))
    for old in (contexts, sizes, together, *([own] if found is None else [])):
        C.dropped(old)
    return out


def _term_spans(text: str, base: list[tuple[str, int, int]], terms: set[str]) -> list[tuple[str, int, int]]:
    """Every occurrence of the ``terms`` outside the base spans."""
    return [("term", a, b) for t, a, b in _outside(text, base) if t in terms] if terms else []


def _redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


def sanitise(docs: DataFrame, revealing: DataFrame | None = None) -> DataFrame:
    """``docs`` with base_spans and term_spans (arrays of kind:start:end) and redacted (the text without them).

    ``term_spans`` lists secrets, then terms.  ``revealing`` is the result of
    :func:`disclosing`, by default that of ``docs``.
    """
    found = findings(docs)
    revealing = disclosing(docs, found) if revealing is None else revealing
    by_entity = revealing.groupBy("entity").agg(F.collect_set("term").alias("_terms"))
    held = found.select("hash", F.explode("entities").alias("entity")).join(by_entity, "entity")
    held = C.stored(held.groupBy(F.col("hash").alias("_text")).agg(F.array_distinct(F.flatten(F.collect_list("_terms"))).alias("_terms")))
    C.dropped(found)
    made = ("base_spans", "term_spans", "redacted")
    keep = [c for c in docs.columns if c not in made]
    base = _hashed(docs.select(*keep)).join(F.broadcast(held) if held.count() <= BROADCAST_TEXTS else held, F.col("_hash") == F.col("_text"), "left").select(*keep, "_terms")
    schema = C.extended(docs.select(*keep), "base_spans array<string>, term_spans array<string>, redacted string")
    kinds = (pa.list_(pa.string()), pa.list_(pa.string()), pa.string())

    def run(batches):
        for batch in batches:
            made = []
            for text, terms in zip(batch.column("text").to_pylist(), batch.column("_terms").to_pylist(), strict=True):
                own = base_spans(text or "")
                more = secrets(text or "", own)
                more += _term_spans(text or "", own + more, set(terms or ()))
                made.append(([f"{k}:{s}:{e}" for k, s, e in own], [f"{k}:{s}:{e}" for k, s, e in more], None if text is None else _redacted(text, own + more)))
            columns = list(zip(*made, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)]], schema.names)

    return base.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """``op5_pii``: counts, base digest and all spans of every document."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sanitise(docs)

    def number(kind: str):
        return F.size(F.filter("base_spans", lambda x: F.startswith(x, F.lit(f"{kind}:")))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, KINDS), F.sha2(F.concat_ws(",", "base_spans"), 256).alias("base_sha256"), F.concat_ws(",", F.concat("base_spans", "term_spans")).alias("spans")
    )
