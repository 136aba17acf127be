"""Language identification of mixed texts by expectation-maximisation.

Training: hashed character trigram counts of each language, over at most
``MAX_DOCS`` documents a language (a bounded, hashed sample of the labelled
rows).  Prediction: a document's trigrams are taken as draws from a mixture of
languages, whose proportions EM estimates.  The language set starts with the
likeliest language and grows as long as its penalised likelihood does, by the
language in whose direction the likelihood rises most; a set may hold all
languages.  The log likelihood is concave in the proportions, so that rise also
bounds what any further language can gain: documents whose bound is below the
price of a language are settled without another EM.

``score`` is the share of the predicted language in the selected set, as in
``lang_shares``.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
no languages; so is every text if nothing could be learned; rows with a null
language or text teach nothing; repeated rows are each judged; ties go to the
alphabetically first language; further columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _common as C

#: Labelled documents that a language is learned from, about.
MAX_DOCS = 1500
BITS = 15
#: EM steps over each candidate set.
STEPS = 8
#: Trigrams overlap, so each counts as this share of an independent observation.
INDEPENDENT = 1 / 3
#: Distinct trigrams times languages that are held at once (a longer text is a group of its own).
GROUP = 4_000_000

_LETTER: list[np.ndarray] = []
_A, _B, _D = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


def trigrams(text: str | None) -> np.ndarray:
    """Hashed trigrams of the lower-cased letters, other runs as one blank; empty without a letter."""
    if not _LETTER:
        _LETTER.append(np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), bool))
    code = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTER[0][code]
    if not letter.any():
        return np.zeros(0, np.uint32)
    code = np.where(letter, code, np.uint32(32))
    code = code[letter | np.concatenate(([True], letter[:-1]))]
    h = code[:-2] * _A + code[1:-1] * _B + code[2:] * _D
    return ((h ^ (h >> np.uint32(15))) * _A) >> np.uint32(32 - BITS)


@dataclass
class LanguageModel:
    """Log probabilities of hashed trigrams, a row for each trigram and a column for each language."""

    langs: list[str]
    log_p: np.ndarray


def fit(docs: DataFrame, *, max_docs: int = MAX_DOCS) -> LanguageModel:
    """Learn from (text, lang) of ``docs``; at most about ``max_docs`` rows of each language are read into it."""
    C.prepare(docs.sparkSession)
    known = docs.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32))
    langs = sorted(sizes)
    share = F.element_at(F.create_map(*[F.lit(x) for g in langs for x in (g, min(1.0, max_docs / sizes[g]))]), F.col("lang"))
    sample = known.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < share * 1_000_003).repartition(16)

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                own = total.setdefault(lang, np.zeros(1 << BITS, np.int64))
                own += np.bincount(trigrams(text), minlength=1 << BITS)
        for lang, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at)), "gram": pa.array(at, pa.int32()), "n": pa.array(own[at])})

    counts = np.zeros((1 << BITS, len(langs)))
    for r in sample.mapInArrow(count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["gram"], langs.index(r["lang"])] = r["n"]
    p = (counts + 0.05) / (counts + 0.05).sum(0)
    return LanguageModel(langs, np.log(p).astype(np.float32))


def _em(p: np.ndarray, n: np.ndarray, edges: np.ndarray, sizes: np.ndarray, pi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixture proportions of each document after ``STEPS`` steps, and the likelihood of each of its trigrams."""
    total = np.add.reduceat(n, edges)[:, None]
    for _ in range(STEPS):
        joint = p * np.repeat(pi, sizes, 0)
        joint *= (n / joint.sum(1))[:, None]
        pi = np.add.reduceat(joint, edges, 0) / total
    return pi, (p * np.repeat(pi, sizes, 0)).sum(1)


def _shares(log_p: np.ndarray, n: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Proportions (a row for each document) of the selected languages of documents with ``sizes`` trigrams of counts ``n``."""
    edges = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    p = np.exp(log_p - log_p.max(1, keepdims=True))
    first = np.add.reduceat(n[:, None] * log_p, edges, 0).argmax(1)
    out = np.zeros((len(sizes), p.shape[1]), np.float32)
    out[np.arange(len(sizes)), first] = 1
    open_ = np.arange(len(sizes))
    mix = p[np.arange(len(p)), np.repeat(first, sizes)]
    for _ in range(p.shape[1] - 1):
        total = np.add.reduceat(n, edges)
        price = 0.5 * np.log(np.maximum(total, 2)) / INDEPENDENT
        rise = np.add.reduceat(p * (n / np.maximum(mix, 1e-30))[:, None], edges, 0)
        rise[out[open_] > 0] = -np.inf
        able = rise.max(1) - total > price
        if not able.any():
            break
        rows = np.repeat(able, sizes)
        p, n, mix, open_, rise, price, sizes = p[rows], n[rows], mix[rows], open_[able], rise[able], price[able], sizes[able]
        edges = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        added = rise.argmax(1)
        k = (out[open_] > 0).sum(1)
        start = out[open_] * (k / (k + 1))[:, None].astype(np.float32)
        start[np.arange(len(open_)), added] = 1 / (k + 1)
        pi, new = _em(p, n, edges, sizes, start)
        gain = np.add.reduceat(n * (np.log(np.maximum(new, 1e-30)) - np.log(np.maximum(mix, 1e-30))), edges)
        better = gain > price
        out[open_[better]] = pi[better]
        rows = np.repeat(better, sizes)
        p, n, mix, open_, sizes = p[rows], n[rows], new[rows], open_[better], sizes[better]
        if not len(open_):
            break
        edges = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    return out


def infer(texts: list[str], model: LanguageModel) -> list[tuple[str, float, dict[str, float]]]:
    """(language, its share, shares of the selected set) of every text."""
    out: list[tuple[str, float, dict[str, float]]] = [("und", 0.0, {})] * len(texts)
    n_langs = len(model.langs)
    if not n_langs:
        return out
    group: list[tuple[int, np.ndarray, np.ndarray]] = []
    held = 0

    def settle() -> None:
        if not group:
            return
        log_p = model.log_p[np.concatenate([g for _, g, _ in group])]
        counts = np.concatenate([c for _, _, c in group]).astype(np.float32)
        for (i, _, _), shares in zip(group, _shares(log_p, counts, np.array([len(g) for _, g, _ in group])), strict=True):
            k = int(shares.argmax())
            out[i] = (model.langs[k], float(min(1.0, max(0.0, shares[k]))), {model.langs[j]: float(shares[j]) for j in np.flatnonzero(shares > 0)})
        group.clear()

    for i, text in enumerate(texts):
        t = trigrams(text)
        if len(t):
            c = np.bincount(t, minlength=1 << BITS)
            k = np.flatnonzero(c)
            if held + len(k) * n_langs > GROUP:
                settle()
                held = 0
            group.append((i, k, c[k]))
            held += len(k) * n_langs
    settle()
    return out


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred, score (the language's share of the text) and lang_shares (of the selected set)."""
    spark = docs.sparkSession
    C.prepare(spark)
    base = docs.select(*[c for c in docs.columns if c not in {"lang_pred", "score", "lang_shares"}])
    schema = C.extended(base, "lang_pred string, score double, lang_shares map<string,double>")
    shared = spark.sparkContext.broadcast(model)
    arrays = (pa.string(), pa.float64(), pa.map_(pa.string(), pa.float64()))

    def run(batches):
        for batch in batches:
            made = infer(C.texts(batch), shared.value)
            columns = [[m[0] for m in made], [m[1] for m in made], [list(m[2].items()) for m in made]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, t) for c, t in zip(columns, arrays, strict=True)]], schema.names)

    return base.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    return C.crc_mod(doc_id, 5) == 0


def query(spark, sf_dir: str) -> DataFrame:
    """``op2_langid``: learned from the documents that are not held out, applied to all."""
    docs = C.table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()).select("text", "lang"))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", F.to_json("lang_shares").alias("lang_shares")
    )
