"""Word-level BPE encoding and decoding with a pair occurrence index.

The unseen pre-tokens of a batch are laid out in one doubly linked symbol
sequence.  An index maps each adjacent pair to all its positions in it; active
ranks are taken in ascending order from a heap, all live positions of a rank's
pair are merged from left to right, and the lists of the neighbouring pairs
are updated.  A merge's parts always have lower ranks than the merge itself
(checked when the vocabulary is loaded), so no lower rank can become active
again and the result is that of merging each pre-token by itself.

Encoded pre-tokens are kept in a worker's table of at most ``CACHE`` entries.

Defined cases: a null text is an empty one and has no tokens; special strings
in a text become their special ids; any code point is encodable (bytes);
repeated rows are each encoded; further columns are carried along.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
import unicodedata
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C

#: Pre-tokens a worker remembers; beyond it long ones are forgotten.
CACHE = 400_000
# The pipeline of a vocabulary file that this module follows (fixed values).
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Length of the pre-tokens that are kept when the table is full.
SHORT = 9
# Classes of lower-cased Latin-1 texts.
_BLANK, _LETTERS, _NUMBERS = r"\t-\r \x85\xa0", "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"


def byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A word BPE vocabulary read from a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self._refuse_others(spec)
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: s for s, i in (self.vocab | self.special).items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        made: dict[int, int] = {}
        for rank, (a, b) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]):
            left, right, new = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if max(made.get(left, -1), made.get(right, -1)) >= rank:
                raise ValueError(f"merge {rank} uses a symbol that a later merge makes")
            made.setdefault(new, rank)
            self.merges[left, right] = (rank, new)
        symbols = byte_symbols()
        self.inner = [self.vocab[s] for s in symbols]
        self.final = [self.vocab[s + self.suffix] for s in symbols]
        self.pattern = regex.compile(SPLIT)
        self.latin = re.compile(SPLIT.replace(r"[^\s\p{L}\p{N}]", f"[^{_BLANK}{_LETTERS}{_NUMBERS}]").replace(r"[\p{L}]", f"[{_LETTERS}]").replace(r"[\p{N}]", f"[{_NUMBERS}]"))
        self.id_texts = list(map(str, range(max(self.names) + 1)))
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.cache: dict[str, tuple[int, ...]] = {}
        # For digests, by pre-token: number of ids, ids as text, decoded text.
        self.numbers: dict[str | int, int] = {}
        self.joined: dict[str | int, str] = {}
        self.decoded: dict[str | int, str] = {}

    @staticmethod
    def _refuse_others(spec: dict) -> None:
        """A file with another normaliser, pre-tokeniser or kind of model would be encoded wrongly."""
        model, own = spec["model"], (spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {})
        plain = not (model.get("dropout") or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"))
        odd = any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in spec["added_tokens"])
        if model["type"] != "BPE" or not plain or odd or own[0].get("normalizers") != NORMALIZERS or own[1].get("pretokenizers") != PRE_TOKENIZERS:
            raise ValueError("the vocabulary file asks for another pipeline than this one")

    def parts(self, text: str) -> list[str | int]:
        """Pre-tokens of a text, special strings as ids."""
        if self.special_pattern is None or "<|" not in text:
            return self._words(text)
        out: list[str | int] = []
        at = 0
        for m in self.special_pattern.finditer(text):
            out += self._words(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self._words(text[at:])

    def _words(self, text: str) -> list[str]:
        # White space only separates, so its runs need no replacing.
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = unicodedata.normalize("NFC", text)
            return self.pattern.findall(text.replace("Σ", "σ").lower())  # the library lowers each character by itself
        return self.latin.findall(text.lower())  # such texts are in NFC

    def merged(self, words: set[str]) -> list[tuple[str, list[int]]]:
        """The ids of every one of ``words``."""
        sym: list[int] = []
        edges = [0]
        listed = list(words)
        inner, final = self.inner, self.final
        for w in listed:
            data = w.encode("utf-8", "surrogatepass")
            sym += map(inner.__getitem__, data[:-1])
            sym.append(final[data[-1]])
            edges.append(len(sym))
        n = len(sym)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for e in edges[1:]:
            following[e - 1] = -1
        for e in edges[:-1]:
            if e < n:
                before[e] = -1
        merges = self.merges
        index: dict[tuple[int, int], list[int]] = {}
        for p, pair in enumerate(zip(sym, sym[1:], strict=False)):
            if pair in index:
                index[pair].append(p)
            elif pair in merges:
                index[pair] = [p]
        active = [(merges[pair][0], pair) for pair in index]
        heapq.heapify(active)
        while active:
            _, pair = heapq.heappop(active)
            a, b = pair
            new = merges[pair][1]
            positions = index.pop(pair)
            positions.sort()
            for p in positions:
                q = following[p]
                if q < 0 or sym[p] != a or sym[q] != b:
                    continue
                after = following[q]
                sym[p], sym[q], following[p] = new, -1, after
                if after >= 0:
                    before[after] = p
                    made = (new, sym[after])
                    if made in index:
                        index[made].append(p)
                    elif made in merges:
                        index[made] = [p]
                        heapq.heappush(active, (merges[made][0], made))
                left = before[p]
                if left >= 0:
                    made = (sym[left], new)
                    if made in index:
                        index[made].append(left)
                    elif made in merges:
                        index[made] = [left]
                        heapq.heappush(active, (merges[made][0], made))
        return [(w, [s for s in sym[at:to] if s >= 0]) for w, at, to in zip(listed, edges, edges[1:], strict=False)]

    def _split(self, batch: list[str], known: dict) -> tuple[list[list[str | int]], set[str], set[str | int]]:
        """Pre-tokens of every text; those that ``known`` lacks; and what must be forgotten to make room for them."""
        split = [self.parts(t) for t in batch]
        needed = {w for words in split for w in words}
        unseen = {w for w in needed if w not in known and w.__class__ is str}
        gone: set[str | int] = set()
        if len(known) + len(unseen) > CACHE:  # short pre-tokens are the likeliest to come back
            stay = set(islice((w for w in known if w.__class__ is str and len(w) <= SHORT), CACHE // 2)) | needed
            gone = known.keys() - stay
        return split, unseen, gone

    def encode_batch(self, batch: list[str]) -> list[list[int]]:
        known = self.cache
        split, unseen, gone = self._split(batch, known)
        for w in gone:
            del known[w]
        known.update((w, tuple(ids)) for w, ids in self.merged(unseen))
        return [[i for w in words for i in (known[w] if w.__class__ is str else (w,))] for words in split]

    def digest_batch(self, batch: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text) of every text, joined from its pre-tokens' parts."""
        numbers, joined, decoded, id_texts, names = self.numbers, self.joined, self.decoded, self.id_texts, self.names
        split, unseen, gone = self._split(batch, numbers)
        for w in gone:
            del numbers[w], joined[w], decoded[w]
        for w, ids in [*self.merged(unseen), *((i, [i]) for i in self.special.values())]:
            numbers[w], joined[w], decoded[w] = len(ids), " ".join(map(id_texts.__getitem__, ids)), " ".join(map(names.__getitem__, ids))
        return [(sum(map(numbers.__getitem__, words)), _sha256(" ".join(map(joined.__getitem__, words))), _sha256(" ".join(map(decoded.__getitem__, words)))) for words in split]

    def decode(self, ids: list[int]) -> str:
        """As a tokenizer without a decoder does: token strings joined by a space."""
        return " ".join(map(self.names.__getitem__, ids))


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The vocabulary at ``path``, read once a worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def _mapped(docs: DataFrame, path: str, make, names: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """``docs`` with the columns ``names``, rows of which ``make(vocabulary, texts)`` gives."""
    C.prepare(docs.sparkSession)
    base = docs.select(*[c for c in docs.columns if c not in {n for n, _, _ in names}])
    schema = C.extended(base, ", ".join(f"{name} {kind}" for name, kind, _ in names))
    columns = [*base.columns, *[n for n, _, _ in names]]

    def run(batches):
        bpe = load(path)
        gc.disable()  # encoding makes no cycles, and collections would walk its large tables
        try:
            for batch in batches:
                made = list(zip(*make(bpe, C.texts(batch)), strict=True)) or [[] for _ in names]
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x, t) for x, (_, _, t) in zip(made, names, strict=True)]], columns)
        finally:
            gc.enable()

    return base.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with token_ids (array<int>) of its text."""
    return _mapped(docs, path, lambda bpe, batch: [(ids,) for ids in bpe.encode_batch(batch)], [("token_ids", "array<int>", pa.list_(pa.int32()))])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with decoded, the text of its token_ids; null ids decode to an empty text."""
    C.prepare(encoded.sparkSession)
    base = encoded.select(*[c for c in encoded.columns if c != "decoded"])
    columns = [*base.columns, "decoded"]

    def run(batches):
        bpe = load(path)
        for batch in batches:
            made = [bpe.decode(ids or []) for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], columns)

    return base.mapInArrow(run, C.extended(base, "decoded string"))


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with n_tokens and SHA-256 of the ids and of the decoded text; the ids stay in the worker."""
    return _mapped(docs, path, WordBpe.digest_batch, [("n_tokens", "bigint", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())])


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark, sf_dir: str) -> DataFrame:
    """``op3_bpe``: digests of every document's encoding and decoding."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, vocabulary("word_bpe_49k.json")).select("doc_id", F.col("n_tokens"), "ids_sha256", "decoded_sha256")
