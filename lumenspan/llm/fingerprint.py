"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

Built from DataFrame functions only.  A text's paragraphs become a set of
64-bit digests.  A paragraph ends with its line, and within a line at words
whose hash says so (about one in ``CUT``), so that an inserted word changes only
the paragraph around it; ``MOST`` words end it anyway, and the first words of a
text are paragraphs by themselves, so that short texts have several.

A fingerprint is a table of 24 cells (count, xor of digests, xor of check
sums); each digest is in one cell of each of the ``HASHES`` parts of the table.
Two fingerprints subtract cell by cell, digests of both versions vanish, and
peeling pure cells recovers the digests that only one version has.  Where
peeling fails the sketch is retried larger: the digests are dealt to so many
tables that each should hold few differences, and a table that fails again is
split into ``SPLIT`` with other hashes, down to ``DEPTH``; the few digests of a
table that is stuck even then are compared as they are, so the result is exact.

The likeness of two versions is the Jaccard coefficient of their paragraph
sets, from the sizes and the recovered differences.

The next document is found without a global sort: documents are dealt into
ranges of ids (quantiles; those without an id by the hash of their text), each
range's first document is also dealt to the range before it, and a window within
each range looks ahead.  A range holds about ``RANGE_ROWS`` rows, or more where
that would make over ``MOST_RANGES`` of them; windows spill.

Defined cases: a null text is an empty one, which has no digests (two empty
sets are alike by 1); rows with equal doc_id follow each other by the hash of
their text; null ids come last; a single row is its own next document; an
empty table gives an empty result; further columns are ignored by ``compare``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import _common as C

#: One word in ``CUT`` ends a paragraph, by its hash; ``MOST`` words end it in any case.
CUT, MOST = 32, 96
#: Numbers of words after which a text's first paragraphs end.
FIRST = (1, 3, 8)
#: Parts of a table, and the binary logarithm of a part's cells: in a fingerprint, in the tables of retries.
HASHES, PART_BITS, RETRY_BITS = 3, 3, 4
#: Digests (of both versions) that a table of the first retry holds on average.
LOAD = 24
#: Rounds that peeling takes at most; a table that needs more counts as failed.
ROUNDS = 12
SPLIT, DEPTH = 4, 2
#: Rows of an id range, about, and the number of ranges that the driver handles.
RANGE_ROWS, MOST_RANGES = 2000, 50_000


def paragraphs(text: Column) -> Column:
    """A text's paragraphs: lines, cut at words by their hash; words are parted by one blank."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\s]++|\n"), F.lit(0))

    def cut(w: Column) -> Column:
        n = F.size(w)
        ends = lambda i: (F.get(w, i - 1) == "\n") | (F.xxhash64(F.get(w, i - 1)).bitwiseAND(F.lit(CUT - 1)) == 0) | i.isin(*FIRST) | (i == n)
        at = F.filter(F.sequence(F.lit(1), n), ends)
        pairs = lambda e: F.zip_with(F.concat(F.array(F.lit(0)), F.slice(e, F.lit(1), F.size(e) - 1)), e, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        most = lambda x: F.transform(F.sequence(x.a, x.b - 1, F.lit(MOST)), lambda a: F.struct(a.alias("a"), F.least(a + MOST, x.b).alias("b")))
        parts = F.flatten(F.transform(_bind(at, pairs), most))
        return F.when(n > 0, F.transform(parts, lambda x: F.rtrim(F.array_join(F.slice(w, x.a + 1, x.b - x.a), " "), F.lit(" \n")))).otherwise(F.array().cast("array<string>"))

    return F.filter(_bind(found, cut), lambda p: p != "")


def digests(text: Column) -> Column:
    """The sorted distinct digests of a text's paragraphs."""
    return F.array_sort(F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p))))


def _check(key: Column) -> Column:
    return F.hash(key, F.lit(7))


def _bits(key: Column, at: int, mask) -> Column:
    """Some bits of a digest, which are as good as another hash of it."""
    return F.shiftrightunsigned(key, at).bitwiseAND(F.lit(mask).cast("bigint") if isinstance(mask, int) else mask.cast("bigint"))


def _place(key: Column, part: int, seed: int) -> Column:
    """The cell of ``part`` that holds a digest; seeds use bits of their own."""
    bits = RETRY_BITS if seed else PART_BITS
    return _bits(key, 4 * (seed * HASHES + part), (1 << bits) - 1)


def _placed(keys: Column, seed: int) -> Column:
    """Signed digests, structs of (k, s), with their check sum and places."""
    return F.transform(keys, lambda x: F.struct(x.k.alias("k"), x.s.alias("s"), _check(x.k).alias("h"), *[_place(x.k, j, seed).alias(f"p{j}") for j in range(HASHES)]))


def _table(keys: Column, seed: int) -> Column:
    """The cells of signed digests."""

    def cell(inside: Column) -> Column:
        return F.aggregate(
            inside,
            F.struct(F.lit(0).alias("c"), F.lit(0).cast("bigint").alias("k"), F.lit(0).alias("h")),
            lambda a, x: F.struct((a.c + x.s).alias("c"), a.k.bitwiseXOR(x.k).alias("k"), a.h.bitwiseXOR(x.h).alias("h")),
        )

    def part(own: Column, j: int) -> Column:
        return F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << (RETRY_BITS if seed else PART_BITS)) - 1).cast("bigint")), lambda i: cell(F.filter(own, lambda x: x[f"p{j}"] == i)))

    return _bind(_placed(keys, seed), lambda own: F.concat(*[part(own, j) for j in range(HASHES)]))


def _signed(keys: Column, sign: int) -> Column:
    return F.transform(keys, lambda k: F.struct(k.alias("k"), F.lit(sign).alias("s")))


def cells(keys: Column, seed: int = 0) -> Column:
    """The sketch of a set of digests: structs of count, xor of digests and xor of check sums."""
    return _table(_signed(keys, 1), seed)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x.c - y.c).alias("c"), x.k.bitwiseXOR(y.k).alias("k"), x.h.bitwiseXOR(y.h).alias("h")))


def peel(table: Column, seed: int = 0) -> Column:
    """struct(ok, na, nb, only): numbers and signed digests of the recovered differences of a subtracted table.

    Every round takes all pure cells at once; ``ok`` says that nothing is left.
    """
    start = F.struct(table.alias("t"), F.lit(False).alias("done"), F.array().cast("array<struct<k:bigint,s:int>>").alias("only"))

    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state.t, lambda x: (F.abs(x.c) == 1) & (x.h == _check(x.k)))
        found = F.array_distinct(F.transform(pure, lambda x: F.struct(x.k.alias("k"), x.c.alias("s"))))

        def take(own: Column) -> Column:
            stop = F.struct(state.t.alias("t"), F.lit(True).alias("done"), state.only.alias("only"))
            return F.when(F.size(own) == 0, stop).otherwise(
                F.struct(subtract(state.t, _table(own, seed)).alias("t"), F.lit(False).alias("done"), F.concat(state.only, own).alias("only"))
            )

        return F.when(state.done, state).otherwise(_bind(found, take))

    def finish(state: Column) -> Column:
        left = F.exists(state.t, lambda x: (x.c != 0) | (x.k != 0))
        own = lambda sign: F.size(F.filter(state.only, lambda x: x.s == sign))
        return F.struct((~left).alias("ok"), own(1).alias("na"), own(-1).alias("nb"), state.only.alias("only"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, finish)


def _numbers(result: Column) -> Column:
    return F.struct(result.na.alias("na"), result.nb.alias("nb"))


def _sum(parts: Column) -> Column:
    zero = F.struct(F.lit(0).alias("na"), F.lit(0).alias("nb"))
    return F.aggregate(parts, zero, lambda s, x: F.struct((s.na + x.na).alias("na"), (s.nb + x.nb).alias("nb")))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _decode(pair: Column, depth: int) -> Column:
    """Differences of struct(x, y) of digest arrays; a table that can't be peeled is split with other hashes."""
    result = peel(_table(F.concat(_signed(pair.x, 1), _signed(pair.y, -1)), depth), seed=depth)

    def use(r: Column) -> Column:
        if depth == DEPTH:
            left = F.struct(F.size(F.array_except(pair.x, pair.y)).alias("na"), F.size(F.array_except(pair.y, pair.x)).alias("nb"))
            return F.when(r.ok, _numbers(r)).otherwise(left)
        deal = lambda k: _bits(k, 48 + 2 * depth, SPLIT - 1)
        smaller = F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.lit(SPLIT - 1).cast("bigint")),
            lambda s: _decode(F.struct(F.filter(pair.x, lambda k: deal(k) == s).alias("x"), F.filter(pair.y, lambda k: deal(k) == s).alias("y")), depth + 1),
        )
        return F.when(r.ok, _numbers(r)).otherwise(_sum(smaller))

    return _bind(result, use)


def _dealt(keys: Column, n: Column) -> Column:
    """Sorted digests in n * n groups by hash, in two steps of n, so that the work grows as the size to the power 1.5."""
    rough = lambda k: F.pmod(F.shiftrightunsigned(k, 1), n)
    fine = lambda k: F.pmod(F.shiftrightunsigned(F.hash(k, F.lit(52)), 1), n)
    steps = F.sequence(F.lit(0).cast("bigint"), n - 1)
    return F.flatten(F.transform(steps, lambda i: _bind(F.filter(keys, lambda k: rough(k) == i), lambda own: F.transform(steps, lambda j: F.filter(own, lambda k: fine(k) == j)))))


def likeness(x: Column, y: Column, fx: Column, fy: Column) -> Column:
    """Jaccard coefficient of two digest sets with fingerprints ``fx`` and ``fy``, by peeling."""
    first = peel(subtract(fx, fy))
    n = F.greatest(F.lit(1), F.ceil(F.sqrt((F.size(x) + F.size(y)) / F.lit(LOAD)))).cast("bigint")

    def larger(n_: Column) -> Column:
        pairs = F.zip_with(_dealt(x, n_), _dealt(y, n_), lambda a, b: F.struct(a.alias("x"), b.alias("y")))
        return _sum(F.transform(pairs, lambda p: _decode(p, 1)))

    numbers = _bind(first, lambda r: F.when(r.ok, _numbers(r)).otherwise(_bind(n, larger)))
    return _bind(
        numbers,
        lambda d: F.when(F.size(x) + F.size(y) == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.size(x) - d.na).cast("double") / (F.size(x) + d.nb)))),
    )


def text_of(fingerprint: Column, n: Column) -> Column:
    """A fingerprint as a string: the number of digests and every cell in hexadecimal."""
    return F.concat(n.cast("string"), F.lit(":"), F.array_join(F.transform(fingerprint, lambda x: F.concat_ws(".", F.hex(x.c.cast("bigint")), F.hex(x.k), F.hex(x.h))), ","))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with fingerprint, the sketch of its text's paragraphs as a string."""
    keep = [c for c in docs.columns if c != "fingerprint"]
    return docs.select(*keep, digests(F.col("text")).alias("_keys")).select(*keep, text_of(cells(F.col("_keys")), F.size("_keys")).alias("fingerprint"))


def _above(edges: list[int], value: Column) -> Column:
    """How many of the ``edges`` lie above ``value``, by binary search."""
    if not edges:
        return F.lit(0)
    down = F.split(F.lit(",".join(map(str, sorted(edges, reverse=True)))), ",").cast("array<bigint>")
    steps = [1 << k for k in range(len(edges).bit_length() - 1, -1, -1)]
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, s: F.when(F.get(down, at + s - 1) > value, at + s).otherwise(at))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, keys, next_text, next_keys): every document beside the next one by descending doc_id."""
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    n, known = ids.agg(F.count("*"), F.count("doc_id")).first()
    cut = max(1, min(MOST_RANGES, known // RANGE_ROWS))
    marks = ids.where("doc_id is not null").agg(F.percentile_approx("doc_id", [i / cut for i in range(1, cut)], 10 * MOST_RANGES).alias("m")).first().m if cut > 1 else []
    edges = sorted(set(marks or []))
    # Ranges are numbered from the largest ids on; rows without an id follow, in ranges of their text's hash.
    rest = max(1, min(MOST_RANGES, (n - known) // RANGE_ROWS))
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    by_tie = F.least(F.floor((F.col("tie") / F.lit(2.0**64) + 0.5) * rest), F.lit(rest - 1)).cast("int")
    own = F.when(F.col("doc_id").isNull(), F.lit(len(edges) + 1) + by_tie).otherwise(_above(edges, F.col("doc_id")))
    base = base.withColumn("range", own)
    # The first document of each range, by (doc_id descending, tie): few and thin.
    heads = sorted(base.groupBy("range").agg(F.max_by(F.struct("doc_id", "tie"), F.struct("doc_id", F.bitwise_not("tie"))).alias("h")).collect(), key=lambda r: r["range"])
    before = [(r["range"], r["h"]["doc_id"], r["h"]["tie"], heads[k - 1]["range"]) for k, r in enumerate(heads)]  # the first wraps to the last
    listed = F.broadcast(spark.createDataFrame(before, "range int, _id bigint, _tie bigint, _for int"))
    base = base.join(listed, "range", "left")
    is_head = F.col("tie").eqNullSafe(F.col("_tie")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    for_range = F.col("_for")
    row = lambda r, h: F.struct(r.cast("int").alias("range"), F.lit(h).alias("halo"))
    copies = F.when(is_head, F.array(row(F.col("range"), False), row(for_range, True))).otherwise(F.array(row(F.col("range"), False)))
    dealt = base.withColumn("_c", F.explode(copies)).select("doc_id", "text", "tie", "_c.range", "_c.halo").repartition(F.col("range")).withColumn("keys", digests(F.col("text")))
    # A halo row ends its range; within a range ids descend.  Repeated heads give repeated halo rows, of which the first is met.
    order = Window.partitionBy("range").orderBy(F.col("halo"), F.col("doc_id").desc_nulls_last(), F.col("tie"))
    ahead = dealt.select("*", F.lead("text").over(order).alias("next_text"), F.lead("keys").over(order).alias("next_keys"))
    return ahead.where("not halo").select("doc_id", "text", "keys", "next_text", "next_keys")


def compare(docs: DataFrame) -> DataFrame:
    """The contract's row of every document: digests, fingerprints and likenesses to its edited text and the next document."""
    pairs = with_next(docs)
    n = F.char_length("text")
    k = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - k), F.substr("next_text", F.lit(1), k))
    rows = pairs.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "keys", "next_keys")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "keys", digests(F.col("edited")).alias("edited_keys"), "next_keys")
    made = F.struct(cells(F.col("keys")).alias("own"), cells(F.col("edited_keys")).alias("edited"), cells(F.col("next_keys")).alias("next"))
    out = F.transform(
        F.array(made),
        lambda f: F.struct(
            text_of(f.own, F.size("keys")).alias("fingerprint"), text_of(f.edited, F.size("edited_keys")).alias("edited_fingerprint"),
            likeness(F.col("keys"), F.col("edited_keys"), f.own, f.edited).alias("near_edited"), likeness(F.col("keys"), F.col("next_keys"), f.own, f.next).alias("near_next"),
        ),
    )
    return rows.select("doc_id", "n_chars", "edited_sha256", F.explode(out).alias("o")).select("doc_id", "n_chars", "edited_sha256", "o.fingerprint", "o.edited_fingerprint", "o.near_edited", "o.near_next")


def query(spark, sf_dir: str) -> DataFrame:
    """``op8_fingerprint``: every document against its edited text and the next document."""
    return compare(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
