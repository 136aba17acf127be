"""License scans: a trained paragraph classifier in DataFrame functions.

Paragraphs are single lines and, for notices that are wrapped, blocks of lines
up to a line without letters and digits.  A paragraph becomes its content words:
those of the model's vocabulary, which holds the words of the licence texts
without function words.  Its features are these words and the word bigrams among
neighbours (at most ``GAP`` words apart).  A multinomial logistic regression over
these sparse features gives a probability for each licence family and for
``unknown``, which learns from ordinary sentences that use licence words and from
licences of other names.  The temperature is calibrated on wordings, foreign
names and sentences that the training texts don't have, and a family needs
``MIN_PROBABILITY``.

A comparison with templates (names, identifier lines and notices of all
families) then confirms the prediction.  Features weigh by how few families use
them; the paragraph must hold ``MIN_CONTAINMENT`` of the weight of one of the
family's templates (of its bigrams for a block, so that words scattered over it
don't count), and no template of another family that it holds may match with
more weight: a NonCommercial notice also holds the plain one, with less.  A block
counts as a notice unless one of its lines is one of the same family.

The model is trained on the driver on the fixed list of :mod:`.license_texts`,
so its size is constant.  Texts meet it in broadcast joins with its vocabulary and
weights (a few thousand rows); only paragraphs with several content words move.

Defined cases: null and empty texts have no paragraph; a paragraph without
vocabulary words is unknown and not listed; repeated rows are each scanned
(rows are told apart by doc_id and the text's hash, equal rows give one
result); ties between families go to the alphabetically first; further columns
are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _common as C
from .license_texts import FAMILIES, FOREIGN, FORMS, HELD_FOREIGN, HELD_FORMS, NOTICES, ORDINARY, foreign, templates, wordings

GAP = 3
MIN_PROBABILITY = 0.5
MIN_CONTAINMENT = 0.6
#: Content words that a paragraph needs to be looked at.
MIN_WORDS = 2
UNKNOWN = "unknown"

#: Function words, which no feature uses (fixed values).
STOP = frozenset(
    "a an and are as at be by can for from has have if in into is it its may no not of on one or over should that the their this to under was were which will with you your all any along via part".split()
)
_SPLIT = r"[^\p{L}\p{N}]+"
#: One or more lines without letters and digits, between two blocks.
_BLANK = r"\n[^\p{L}\p{N}]*\n"


def tokens(text: str) -> list[tuple[int, str]]:
    """(position, word) of a paragraph; the same rule as :func:`words`."""
    found = [w for w in re.split(r"[\W_]+", text.lower().replace("licence", "license"))]
    return [(i, w) for i, w in enumerate(found) if w and w not in STOP]


@cache
def vocabulary() -> dict[str, int]:
    texts = [t for _, t in templates()] + [t for _, t in wordings(FORMS)]
    return {w: i for i, w in enumerate(sorted({w for t in texts for _, w in tokens(t)}))}


def features(pairs: list[tuple[int, str]]) -> set[int]:
    """Feature ids of (position, word) pairs: words, and bigrams of neighbours."""
    known, v = vocabulary(), len(vocabulary())
    ids = [(p, known[w]) for p, w in pairs if w in known]
    return {i for _, i in ids} | {v + a * v + b for (p, a), (q, b) in zip(ids, ids[1:], strict=False) if q - p <= GAP}


class LicenseModel:
    """Class names, weights (feature id to a row of class weights), intercepts, and the templates' weighted features."""

    def __init__(self) -> None:
        self.classes = [*sorted(FAMILIES), UNKNOWN]
        place = {c: i for i, c in enumerate(self.classes)}
        unknown = place[UNKNOWN]
        known = [(features(tokens(t)), place[f]) for f, t in wordings(FORMS)]
        for f, texts in NOTICES.items():
            for text in texts:
                pairs = tokens(text)
                # The text itself, leading and trailing parts.
                known += [(features(x), place[f]) for x in (pairs, pairs[: max(2, len(pairs) * 3 // 4)], pairs[len(pairs) // 4 :])]
        strange = [(features(tokens(t)), unknown) for t in [*foreign(FOREIGN, FORMS), *(t for k, t in enumerate(ORDINARY) if k % 3)]]
        strange += [(features([(0, w)]), unknown) for w in vocabulary()]  # single words say nothing
        held = [(features(tokens(t)), place[f]) for f, t in wordings(HELD_FORMS)]
        held += [(features(tokens(t)), unknown) for t in [*foreign(HELD_FOREIGN, HELD_FORMS), *ORDINARY[::3]]]
        rows: Counter = Counter()
        for own, c in known + strange:
            rows[frozenset(own), c] = 1  # texts of the same features count once
        self._used = {f: i for i, f in enumerate(sorted(set().union(*[f for f, _ in rows])))}
        fitted = self._fit(self._matrix([f for f, _ in rows]), np.eye(len(self.classes), dtype=np.float32)[[c for _, c in rows]])
        scores, truth = self._matrix([f for f, _ in held]) @ fitted, np.array([c for _, c in held])
        grid = np.geomspace(0.05, 5, 60)
        # One more wrong text than there are: without errors, ever sharper probabilities would look best.
        slip = 1 / (len(truth) + 2)
        sure = [np.clip(self._softmax(scores / t)[np.arange(len(truth)), truth].astype(float), 1e-9, 1 - 1e-9) for t in grid]
        loss = [-((1 - slip) * np.log(p) + slip * np.log(1 - p)).mean() for p in sure]
        self.temperature = float(grid[int(np.argmin(loss))])
        fitted /= self.temperature
        self.weights = {f: fitted[i] for f, i in self._used.items()}
        self.intercepts = fitted[-1]
        listed = [(place[f], features(tokens(t))) for f, t in templates()]
        families: dict[int, set[int]] = defaultdict(set)
        for c, own in listed:
            for f in own:
                families[f].add(c)
        weight = {f: float(np.log((1 + len(FAMILIES)) / (1 + len(c))) + 0.01) for f, c in families.items()}
        self.templates = [(t, c, {f: weight[f] for f in own}) for t, (c, own) in enumerate(listed)]

    def _matrix(self, rows: list) -> np.ndarray:
        x = np.zeros((len(rows), len(self._used) + 1), np.float32)
        x[:, -1] = 1
        for r, own in enumerate(rows):
            x[r, [self._used[f] for f in own if f in self._used]] = 1
        return x

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def _fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 0.02, steps: int = 200) -> np.ndarray:
        """Accelerated gradient descent on the ridge multinomial loss."""
        w = ahead = np.zeros((x.shape[1], y.shape[1]), np.float32)
        rate = 1 / (0.5 * np.linalg.eigvalsh(x.T @ x)[-1] + ridge)
        for k in range(steps):
            new = ahead - rate * (x.T @ (self._softmax(x @ ahead) - y) + ridge * ahead)
            w, ahead = new, new + k / (k + 3) * (new - w)
        return w.astype(float)

    def predict(self, paragraph: str) -> tuple[str, float, bool]:
        """The plain form of the scan for one paragraph: (family, probability, confirmed)."""
        own = features(tokens(paragraph))
        p = self._softmax((sum((self.weights[f] for f in own if f in self.weights), np.zeros(len(self.classes))) + self.intercepts)[None])[0]
        c = int(p.argmax())
        best: dict[int, float] = defaultdict(float)
        for _, k, weights in self.templates:
            matched = sum(w for f, w in weights.items() if f in own)
            if matched >= (MIN_CONTAINMENT - 1e-9) * sum(weights.values()):
                best[k] = max(best[k], matched)
        ok = c in best and best[c] >= max(best.values()) - 1e-9
        return self.classes[c], float(p[c]), bool(c < len(self.classes) - 1 and p[c] >= MIN_PROBABILITY and ok)


@cache
def model() -> LicenseModel:
    return LicenseModel()


def _local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


def _lower() -> Column:
    """The text in lower case, with one spelling of the licence's name."""
    return F.replace(F.lower("text"), F.lit("licence"), F.lit("license"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, paragraph, family, probability, confirmed) of all lines with content words enough."""
    base = docs.where("text is not null").select(F.col("doc_id"), F.xxhash64("text").alias("doc_hash"), F.posexplode(F.split(_lower(), "\n")).alias("paragraph", "line"))
    return _judged(base, ["doc_id", "doc_hash", "paragraph"], F.lit(False))


def blocks(docs: DataFrame) -> DataFrame:
    """The same for every line of every block, and as paragraph 0 for a block of several lines as a whole."""
    base = docs.where("text is not null").select(F.col("doc_id"), F.xxhash64("text").alias("doc_hash"), F.posexplode(F.split(_lower(), _BLANK)).alias("block", "whole"))
    lines = F.split("whole", "\n")
    parts = F.concat(F.array(F.when(F.size(lines) > 1, F.col("whole")).otherwise("")), lines)
    return _judged(base.select("doc_id", "doc_hash", "block", F.posexplode(parts).alias("paragraph", "line")), ["doc_id", "doc_hash", "block", "paragraph"], F.col("paragraph") == 0)


def _judged(base: DataFrame, key: list[str], joined: Column) -> DataFrame:
    """``key`` with family, probability, containment and confirmed of the texts in ``line``; ``joined`` tells several lines."""
    spark, m = base.sparkSession, model()
    words = _local(spark, list(vocabulary().items()), "w string, id int")
    v, classes = len(vocabulary()), m.classes
    seen = base.select(*key, F.posexplode(F.split("line", _SPLIT)).alias("pos", "w")).join(words, "w")
    found = seen.groupBy(*key).agg(F.array_sort(F.collect_set(F.struct("pos", "id"))).alias("own")).where(F.size("own") >= MIN_WORDS)
    ahead = F.slice(F.col("own"), F.lit(2), F.size("own"))
    bigrams = F.filter(F.zip_with(F.slice("own", F.lit(1), F.size("own") - 1), ahead, lambda a, b: F.when(b.pos - a.pos <= GAP, v + a.id * v + b.id)), lambda x: x.isNotNull())
    listed = found.select(*key, F.explode(F.array_distinct(F.concat(F.transform("own", lambda x: x.id), bigrams))).alias("f"))
    weights = _local(spark, [(int(f), *map(float, w)) for f, w in m.weights.items()], "f int, " + ", ".join(f"w{i} double" for i in range(len(classes))))
    held: dict[int, list[tuple[int, float, float, float]]] = defaultdict(list)
    for t, _, own in m.templates:
        whole, pairs = sum(own.values()), sum(w for f, w in own.items() if f >= v)
        for f, w in own.items():
            held[f].append((t, w / whole, w / pairs if f >= v else 0.0, w))
    shares = _local(spark, [(int(f), *x) for f, each in held.items() for x in each], "f int, t int, s double, s2 double, w double")
    logits = listed.join(weights, "f", "left").groupBy(*key).agg(
        F.array(*[F.coalesce(F.sum(f"w{i}"), F.lit(0.0)) + F.lit(float(b)) for i, b in enumerate(m.intercepts)]).alias("z")
    )
    top = F.array_max("z")
    scored = logits.select(*key, F.array_position("z", top).cast("int").alias("c"), (F.lit(1.0) / F.aggregate("z", F.lit(0.0), lambda s, z: s + F.exp(z - top))).alias("probability"))
    by_class = _local(spark, [(t, c + 1) for t, c, _ in m.templates], "t int, c int")
    share = F.when(joined, F.col("s2")).otherwise(F.col("s"))
    matched = listed.join(shares, "f").groupBy(*key, "t").agg(F.sum(share).alias("s"), F.sum("w").alias("w")).where(F.col("s") >= MIN_CONTAINMENT - 1e-9)
    contained = matched.join(by_class, "t").groupBy(*key, "c").agg(F.max("w").alias("w"), F.max("s").alias("s"))
    contained = contained.groupBy(*key).agg(F.max("w").alias("best"), F.map_from_entries(F.collect_list(F.struct("c", F.struct("w", "s").alias("x")))).alias("by"))
    same = [scored[k].eqNullSafe(contained[k]) for k in key]
    own = F.try_element_at("by", "c")
    joint = scored.join(contained, same, "left").select(*[scored[k] for k in key], "c", "probability", F.coalesce(own.w, F.lit(0.0)).alias("matched"), F.coalesce(own.s, F.lit(0.0)).alias("containment"), "best")
    names = F.array(*map(F.lit, classes))
    confirmed = (F.col("c") < len(classes)) & (F.col("probability") >= MIN_PROBABILITY) & F.coalesce((F.col("matched") > 0) & (F.col("matched") >= F.col("best") - 1e-9), F.lit(False))
    return joint.select(*key, F.element_at(names, F.col("c")).alias("family"), "probability", "containment", confirmed.alias("confirmed"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_notices, license, licenses, score) of every row: the most frequent confirmed family and all of them."""
    hits = blocks(docs).where("confirmed")
    # A block as a whole is a notice unless one of its lines is one of the same family.
    in_block = hits.groupBy("doc_id", "doc_hash", "block", "family").agg(F.greatest(F.sum((F.col("paragraph") > 0).cast("int")), F.lit(1)).alias("n"), F.max("probability").alias("probability"))
    by = in_block.groupBy("doc_id", "doc_hash", "family").agg(F.sum("n").alias("n"), F.max("probability").alias("p"))
    found = by.groupBy("doc_id", "doc_hash").agg(
        F.sum("n").alias("n_notices"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "family"))).alias("by"), F.array_sort(F.collect_set("family")).alias("licenses"), F.max("p").alias("score"),
    )
    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    return rows.join(found, rows._id.eqNullSafe(found.doc_id) & (rows._hash == found.doc_hash), "left").select(
        F.col("_id").alias("doc_id"), F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"), F.coalesce(F.get("by", F.lit(0)).family, F.lit(UNKNOWN)).alias("license"),
        F.array_join(F.coalesce("licenses", F.array().cast("array<string>")), ",").alias("licenses"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """``op1_license_scan``: the licences of every document."""
    return scan(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
