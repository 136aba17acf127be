"""Cleaning of the documents table: toxicity, near-duplicates, benchmark passages, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept.  All but the last return the columns of documents as they came, also
further ones and those that carry the name of an operator's result.

Defined cases, for all stages: a null or empty text is a document like any
other (not toxic, no duplicate, not contaminated, nothing to redact, no
tokens); repeated rows are each judged alike; rows without a doc_id are judged
by their text; an empty table gives an empty one.  Texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenspan.llm import _common, bpe, decontaminate, near_dedup, pii, toxicity


def _beside(docs: DataFrame, made: tuple[str, ...]) -> tuple[DataFrame, list]:
    """``docs`` with the columns that an operator would replace under other names, and the selection that restores them."""
    other = {}
    for c in docs.columns:
        if c in made:
            name = f"_own_{c}"
            while name in docs.columns:
                name = f"_{name}"
            other[c] = name
    return docs.withColumnsRenamed(other), [F.col(other.get(c, c)).alias(c) for c in docs.columns]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model (learned from all labels) rejects go; without usable labels all stay."""
    labels = _common.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    own, columns = _beside(docs, ("toxicity", "toxic_hits", "predicted"))
    return toxicity.score(own, model).where("predicted = 0").select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id: five-word shingles, similarity of 0.8 or more.

    Documents without a word are in no group; rows that repeat a doc_id stay or go together.
    """
    return near_dedup.deduplicated(docs, k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of any benchmark item go; an item of fewer words than a window is one window."""
    own, columns = _beside(docs, ("n_words", "n_hit", "hit_items", "contaminated"))
    return decontaminate.decontaminate(own, _common.table(spark, sf_dir, "benchmark")).where("not contaminated").select(*columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose their personal data; n_chars, if there, follows; a null text stays null."""
    own, columns = _beside(docs, ("base_spans", "term_spans", "redacted"))
    found = pii.sanitise(own)
    changed = {"text": F.col("redacted"), "n_chars": F.char_length("redacted").cast("bigint")}
    return found.select(*[changed[c].alias(c) if c in changed else column for c, column in zip(docs.columns, columns, strict=True)])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with token_ids and n_tokens, which replace columns of these names; a null text has none and 0."""
    encoded = bpe.encode(docs, bpe.vocabulary("word_bpe_49k.json"))
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("bigint"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("bpe", encode),
]

#: The learned and hashed stages have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; what a stage wrote goes when the next has read it."""
    docs, before = _common.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = _common.stored(stage(spark, docs, sf_dir))
        if before is not None:
            _common.dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
