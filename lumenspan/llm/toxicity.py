"""Toxicity by a weighted lexicon and an Aho-Corasick automaton.

Texts are folded first: compatibility forms, case, zero-width characters,
homoglyphs of Latin letters, and digits or signs that stand for letters inside
a word.  One automaton finds all lexicon entries (whole words, and stems that
words begin with) and the first words of all exception phrases, whose other
words may be parted by blanks, hyphens or other signs and of which the last may
be a plural; hits inside an exception phrase don't count, and of entries that
start together the longest counts.  The hits' weights, in sum and by the text's
length, go through a logistic calibration.

Learning: entries are words and word beginnings that are significantly more
frequent in toxic documents (likelihood ratio over document frequencies), with
their smoothed log odds as weights.  Fitted on at most about ``MAX_ROWS``
labelled documents, a hashed sample of the labels.

Defined cases: null and empty texts have no hits and score like any text
without hits; without usable labels the score is 0; a document with several
labels is toxic if one of them says so; repeated rows are each scored; further
columns are carried along.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C

#: Labelled documents that the model is fitted on, about.
MAX_ROWS = 12_000
STEMS = (4, 5, 6)
#: Least likelihood ratio (G squared) and log odds of an entry.
MIN_G, MIN_ODDS = 20.0, 1.5
#: Largest share of a stem's evidence that one word may have.
MAX_SHARE = 0.6
THRESHOLD = 0.3

# Characters that look like a Latin letter, and the letter.
HOMOGLYPHS = {
    "а": "a", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "х": "x", "у": "y",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ո": "n", "օ": "o", "ս": "u", "ց": "g",
}
# Digits and signs used for letters inside words.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
#: Phrases in which a lexicon word is harmless, unless a model is given others.
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "clown fish", "circus clown", "pond scum")

_ZERO = dict.fromkeys((0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD))
_GLYPHS = str.maketrans(HOMOGLYPHS)
_ODD = re.compile("[" + "".join(HOMOGLYPHS) + "​‌‍⁠﻿­]")
_SIGNS = re.compile("(?:(?<=[^\\W\\d_])[0134578@$!]+(?=[^\\W\\d_]))|(?:(?<![^\\W_])[0134578@$]+(?=[^\\W\\d_]))|(?:(?<=[^\\W\\d_])[0134578]+(?![^\\W_]))")
_SUBSTITUTED = str.maketrans(SUBSTITUTES)
_WORD = re.compile(r"[^\W\d_]+")


def _latin(m: re.Match) -> str:
    """A disguised word in Latin letters: one that mixes them with others, or of four letters or more that all look like them."""
    word = m[0]
    if word.isascii():
        return word
    disguised = re.search("[a-z]", word) or (len(word) >= 4 and all(c in HOMOGLYPHS for c in word))
    return word.translate(_GLYPHS) if disguised else word


def _phrase(words: list[str]) -> re.Pattern:
    """The words of an exception phrase, parted by anything but letters, the last one possibly a plural."""
    return re.compile(r"[\W_]+".join(map(re.escape, words)) + r"(?:s|es)?(?![^\W\d_])")


def fold(text: str | None) -> str:
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii() and _ODD.search(text):
        text = text.translate(_ZERO)
        text = _WORD.sub(_latin, text)
    return _SIGNS.sub(lambda m: m[0].translate(_SUBSTITUTED), text)


def features(text: str) -> set[str]:
    words = set(_WORD.findall(text))
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}


@dataclass
class ToxicityModel:
    """Entry weights (a trailing ``*`` marks a stem), exception phrases and the calibration's coefficients."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    coefficients: tuple[float, ...] | None = None
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            entries: dict[str, list] = {}
            for entry, weight in self.weights.items():
                stem = entry.endswith("*")
                entries.setdefault(entry.rstrip("*"), []).append((stem, weight))
            for phrase in self.exceptions:
                if words := _WORD.findall(fold(phrase)):
                    entries.setdefault(words[0], []).append(_phrase(words))
            self._automaton = ahocorasick.Automaton()
            for text, kinds in entries.items():
                self._automaton.add_word(text, (len(text), kinds))
            if entries:
                self._automaton.make_automaton()
        return self._automaton

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """(start, stop, weight) of the counted entries in a folded text."""
        automaton = self.automaton()
        if not len(automaton):
            return []
        found: dict[int, tuple[int, float]] = {}
        excepted = []
        for last, (n, kinds) in automaton.iter(text):
            start, stop = last - n + 1, last + 1
            if start and text[start - 1].isalpha():
                continue
            inside = stop < len(text) and text[stop].isalpha()
            for kind in kinds:
                if isinstance(kind, re.Pattern):
                    if m := kind.match(text, start):
                        excepted.append(m.span())
                elif kind[0] == inside and (start not in found or found[start][0] < stop):
                    found[start] = (stop, kind[1])
        return [(s, e, w) for s, (e, w) in sorted(found.items()) if not any(a <= s and e <= b for a, b in excepted)]

    def measures(self, text: str | None) -> tuple[float, float, list[tuple[int, int, float]]]:
        """The calibration's two inputs: weight in sum and by length, both on a log scale."""
        folded = fold(text)
        hits = self.hits(folded)
        total = sum(w for _, _, w in hits)
        if not total:
            return 0.0, 0.0, hits
        words = max(1, len(folded) // 6)
        return float(np.log1p(total)), float(np.log1p(100 * total / words)), hits

    def score(self, measures: tuple[float, float]) -> float:
        if self.coefficients is None:
            return 0.0
        a, b, c = self.coefficients
        return float(1 / (1 + np.exp(-np.clip(a + b * measures[0] + c * measures[1], -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton steps of a ridge logistic regression; the intercept is hardly held."""
    w = np.zeros(x.shape[1])
    hold = np.diag([1e-3, *[ridge] * (x.shape[1] - 1)])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (y - p) - hold @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicityModel:
    """Learn from the texts of ``docs`` that ``labels`` (doc_id, toxic) marks."""
    spark = docs.sparkSession
    C.prepare(spark)
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    n = marked.count()
    if n > max_rows:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < 1_000_003 * max_rows / n)
    # Bounded by max_rows, so are the ids that are broadcast and the texts that are moved.
    sample = C.stored(docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").repartition(16))
    size = {r["_toxic"]: r["n"] for r in sample.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = size.get(0, 0), sum(v for k, v in size.items() if k)
    if not n0 or not n1:
        C.dropped(sample)
        return ToxicityModel({}, exceptions)

    def count(batches):
        total = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(C.texts(batch), batch.column("_toxic").to_pylist(), strict=True):
                total[int(y > 0)].update(features(fold(text)))
        listed = sorted(total[0].keys() | total[1].keys())
        yield pa.RecordBatch.from_pydict({"entry": pa.array(listed, pa.string()), "n0": pa.array([total[0][x] for x in listed], pa.int64()), "n1": pa.array([total[1][x] for x in listed], pa.int64())})

    counts = sample.mapInArrow(count, "entry string, n0 bigint, n1 bigint").groupBy("entry").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b"))
    a, b = F.col("a"), F.col("b")
    expected = (a + b) * n1 / (n0 + n1)
    g = 2 * (b * F.log(b / expected) + F.when(a > 0, a * F.log(a / ((a + b) * n0 / (n0 + n1)))).otherwise(0.0))
    odds = F.log((b + 0.5) / (n1 + 1) / ((a + 0.5) / (n0 + 1)))
    # A stem stands for several words: none of them may carry most of its evidence.
    words = counts.where("b > 0 and not endswith(entry, '*')")
    shares = words.select(F.explode(F.array(*[F.concat(F.substring("entry", 1, k), F.lit("*")) for k in STEMS])).alias("entry"), "b").groupBy("entry").agg(F.max("b").alias("most"))
    counts = counts.where("b > 2").join(shares, "entry", "left").where(~F.endswith("entry", F.lit("*")) | (F.col("most") <= MAX_SHARE * b))
    rows = counts.select("entry", g.alias("g"), odds.alias("w")).where((F.col("g") >= MIN_G) & (F.col("w") >= MIN_ODDS)).collect()
    model = ToxicityModel({r["entry"]: r["w"] for r in sorted(rows, key=lambda r: r["entry"])}, exceptions)
    shared = spark.sparkContext.broadcast(model)

    def measure(batches):
        for batch in batches:
            made = [shared.value.measures(t) for t in C.texts(batch)]
            yield pa.RecordBatch.from_pydict({"x": pa.array([m[0] for m in made], pa.float64()), "z": pa.array([m[1] for m in made], pa.float64()), "y": batch.column("_toxic")})

    seen = np.array([(r["x"], r["z"], r["y"] > 0) for r in sample.mapInArrow(measure, "x double, z double, y int").collect()], float)
    fitted = _logistic(np.column_stack([np.ones(len(seen)), seen[:, :2]]), seen[:, 2])
    model.coefficients = tuple(float(v) for v in fitted)
    C.dropped(sample)
    return model


def score(docs: DataFrame, model: ToxicityModel, *, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with toxicity (0 to 1), toxic_hits (number of counted entries) and predicted (1 from ``threshold`` on)."""
    spark = docs.sparkSession
    C.prepare(spark)
    base = docs.select(*[c for c in docs.columns if c not in {"toxicity", "toxic_hits", "predicted"}])
    schema = C.extended(base, "toxicity double, toxic_hits int, predicted int")
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            own = shared.value
            made = [own.measures(t) for t in C.texts(batch)]
            values = [own.score(m[:2]) for m in made]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64()), pa.array([len(m[2]) for m in made], pa.int32()), pa.array([int(v >= threshold) for v in values], pa.int32())], schema.names
            )

    return base.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """``op9_toxicity``: learned from the labels that are not held out, applied to all documents."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = C.crc_mod("doc_id", 4) == 2
    model = fit(docs, C.table(spark, sf_dir, "labels").where(~out).select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", out.alias("held_out"), F.col("toxicity").alias("score"), "predicted", "toxic_hits")
