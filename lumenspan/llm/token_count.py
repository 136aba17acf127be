"""Token counts by rank-synchronous merging of ragged arrays.

The distinct unseen pre-tokens of a batch are held as one flat numpy array of
symbols with row edges.  In every step each row finds its lowest-rank pair and
all rows apply theirs at once; rows without a pair are done and leave.  The
surviving symbols are counted, one outside the vocabulary as its UTF-8 bytes.

A row merges all occurrences of its lowest rank in one step where that equals
merging them one by one, that is where no pair made on the way ranks as low;
else it merges the leftmost only.

Defined cases: a null text is an empty one and has no tokens; control strings
inside a text are plain text; repeated rows are each counted; further columns
are carried along.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _common as C

CACHE = 600_000
LIMIT = 4096
_META = "▁"  # stands for a space
_NONE = np.int32(2**31 - 1)


class PieceBpe:
    """A SentencePiece BPE model with byte fallback and without text normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only BPE models without normalisation are supported")
        # Types: 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte.
        if not spec.trainer_spec.byte_fallback or any(p.type not in (1, 2, 3, 6) for p in spec.pieces):
            raise ValueError("only byte fallback, and no user-defined or unused pieces, are supported")
        self.dummy = norm.add_dummy_prefix
        normal = [(p.piece, p.score) for p in spec.pieces if p.type == 1]
        if any(re.search(f"[^{_META}]{_META}", p) for p, _ in normal):
            raise ValueError("a piece crosses the start of a word")
        scores = sorted({s for _, s in normal}, reverse=True)
        rank = {s: i for i, s in enumerate(scores)}
        self.ids = {p: i for i, (p, _) in enumerate(normal)}
        n = len(normal)
        pairs = {}
        for piece, score in normal:
            for k in range(1, len(piece)):
                a, b = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = (rank[score], self.ids[piece])
        self.n = n
        self._hash(np.array(list(pairs), np.int64), np.array([r for r, _ in pairs.values()], np.int32), np.array([i for _, i in pairs.values()], np.int32))
        self.words = re.compile(f"{_META}*[^{_META}]+|{_META}+")
        self.cache: dict[str, int] = {}

    def _hash(self, keys: np.ndarray, rank: np.ndarray, made: np.ndarray) -> None:
        """Open addressing table; ``longest`` probes find any key."""
        bits = int(np.ceil(np.log2(len(keys) * 4 + 16)))
        self.shift = np.uint64(64 - bits)
        size = 1 << bits
        self.keys, self.rank, self.made = np.full(size, -1, np.int64), np.full(size, _NONE), np.zeros(size, np.int32)
        self.mask = size - 1
        self.longest = 1
        for key, slot, r, m in zip(keys.tolist(), self._slot(keys).tolist(), rank.tolist(), made.tolist(), strict=True):
            k = 0
            while self.keys[(slot + k) & self.mask] >= 0:
                k += 1
            at = (slot + k) & self.mask
            self.keys[at], self.rank[at], self.made[at] = key, r, m
            self.longest = max(self.longest, k + 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Table slots of the pairs, -1 for pairs that no merge makes."""
        keys = a.astype(np.int64) * self.n + b
        keys[(a < 0) | (b < 0)] = -2
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, slot, -1)
        todo = np.flatnonzero((out < 0) & (self.keys[slot] >= 0) & (keys >= 0))
        for k in range(1, self.longest):
            if not len(todo):
                break
            at = (slot[todo] + k) & self.mask
            hit = self.keys[at] == keys[todo]
            out[todo[hit]] = at[hit]
            todo = todo[~hit & (self.keys[at] >= 0)]
        return out

    def split(self, text: str) -> list[str]:
        """Pre-tokens: runs of spaces with the word that follows; no piece crosses their edges."""
        if not text:
            return []
        text = text.replace(" ", _META)
        return self.words.findall(_META + text if self.dummy else text)

    def learn(self, words: list[str]) -> None:
        counts = self.merge(words)
        self.cache.update(zip(words, counts.tolist(), strict=True))

    def merge(self, words: list[str]) -> np.ndarray:
        get = self.ids.get
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = "".join(words)
        sym = np.fromiter((get(c, -1) for c in text), np.int32, len(text))
        # A code point outside the vocabulary never merges and ends as its bytes.
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n_bytes = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        weight = np.where(sym < 0, n_bytes, 1).astype(np.int64)
        row = np.repeat(np.arange(len(words)), lengths)
        counts = np.zeros(len(words), np.int64)
        while len(sym):
            n = len(sym)
            slot = np.full(n, -1, np.int64)
            if n > 1:
                slot[:-1] = self.find(sym[:-1], sym[1:])
                slot[:-1][row[:-1] != row[1:]] = -1
            rank = np.where(slot >= 0, self.rank[slot], _NONE)
            edges = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            sizes = np.diff(np.append(edges, n))
            low = np.minimum.reduceat(rank, edges)
            done = np.repeat(low == _NONE, sizes)
            if done.any():
                np.add.at(counts, row[done], weight[done])
                keep = ~done
                sym, weight, row, slot, rank = sym[keep], weight[keep], row[keep], slot[keep], rank[keep]
                low, sizes = low[low != _NONE], sizes[low != _NONE]
                n = len(sym)
                if not n:
                    break
                edges = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            best = np.repeat(low, sizes)
            hit = rank == best
            # Of overlapping occurrences every second one merges, from the left of each run.
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(hit & ~np.concatenate(([False], hit[:-1])), at, 0))
            pick = np.flatnonzero(hit & ((at - start) % 2 == 0))
            new = self.made[slot[pick]]
            # Pairs that merging one by one would make, with the neighbours as they are or as they become.
            became = sym.copy()
            became[pick] = new
            risk = np.zeros(len(pick), bool)
            for other, near in ((pick + 2, sym), (pick + 2, became)):
                inside = (other < n) & (row[np.minimum(other, n - 1)] == row[pick])
                s = np.full(len(pick), -1, np.int64)
                s[inside] = self.find(new[inside], near[other[inside]])
                risk |= (s >= 0) & (self.rank[s] <= best[pick])
            merged_left = np.zeros(n + 2, np.int64)
            merged_left[pick + 2] = np.arange(1, len(pick) + 1)  # what stands left of a position after the merges
            left = np.where(merged_left[pick] > 0, new[merged_left[pick] - 1], sym[np.maximum(pick - 1, 0)])
            inside = (pick > 0) & (row[np.maximum(pick - 1, 0)] == row[pick])
            s = np.full(len(pick), -1, np.int64)
            s[inside] = self.find(left[inside], new[inside])
            risk |= (s >= 0) & (self.rank[s] <= best[pick])
            if risk.any():
                risky = np.isin(row[pick], row[pick[risk]])
                first = np.concatenate(([True], row[pick[1:]] != row[pick[:-1]]))
                chosen = ~risky | first
                pick, new = pick[chosen], new[chosen]
            sym[pick] = new
            alive = np.ones(n, bool)
            alive[pick + 1] = False
            sym, weight, row = sym[alive], weight[alive], row[alive]
        return counts

    def count_batch(self, batch: list[str]) -> list[int]:
        split = [self.split(t) for t in batch]
        known = self.cache
        unseen = list({w for words in split for w in words if w not in known})
        if len(known) + len(unseen) > CACHE:
            known.clear()
            unseen = list({w for words in split for w in words})
        if unseen:
            self.learn(unseen)
        return [sum(map(known.__getitem__, words)) for words in split]


_LOADED: dict[str, PieceBpe] = {}


def load(path: str) -> PieceBpe:
    if path not in _LOADED:
        _LOADED[path] = PieceBpe(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, path: str, *, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit."""
    C.prepare(docs.sparkSession)
    base = docs.select(*[c for c in docs.columns if c not in {"n_bytes", "n_tokens", "over_limit"}])
    schema = C.extended(base, "n_bytes bigint, n_tokens bigint, over_limit boolean")

    def run(batches):
        bpe = load(path)
        for batch in batches:
            rows = C.texts(batch)
            n = bpe.count_batch(rows)
            size = [len(t.encode("utf-8", "surrogatepass")) for t in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], schema.names)

    return base.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """``op7_token_count``: token counts of every document."""
    import public_tokenizers

    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
