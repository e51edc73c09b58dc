"""BPE encoding and decoding with a public vocabulary file, in batched numpy merge rounds.

The symbols of all new words of a block of documents stand in one flat array. A round looks all adjacent pairs up by
binary search over the sorted pair keys, finds each word's lowest rank and merges that pair wherever it occurs in the
word; words without a pair left drop out. Tokenizing is a map over the documents without any shuffle.

Nulls count as empty text and give no ids. Empty text, repeated rows and texts of any length need no special handling.
Of equal ranks in a word the leftmost pair is merged first. An empty table gives an empty one.
All columns of the input are kept; an input column named like an output column is replaced.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from creditmart.llm.common import pieces, with_arrays

#: Characters of text that a block of documents holds at most, but for single longer documents.
BLOCK_CHARS = 500_000
#: Strings between white space whose ids a task remembers, but for a block that has more.
REMEMBERED = 150_000
NONE = np.iinfo(np.int64).max
#: Control characters that str.split() takes for white space and the vocabulary's rules do not.
SEPARATORS = re.compile("[\x1c-\x1f]")
NO_SPACE = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself where it is printable in Latin-1, else one from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """Tables of a BPE vocabulary file whose words end in a suffix; read on the driver and sent to the tasks."""

    tokens: list[str]
    first: np.ndarray  # symbol of each byte inside a word
    last: np.ndarray  # symbol of each byte at the end of a word
    keys: np.ndarray  # sorted pair keys
    ranks: np.ndarray  # rank of each pair key
    merged: np.ndarray  # symbol that each pair key becomes
    joins: np.ndarray  # 256 x 256: whether some token holds these two bytes side by side
    pattern: str
    special: dict[str, int]
    remembered: dict[str, bytes] = field(default_factory=dict)
    rules: tuple | None = None

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab, alphabet = model["vocab"], byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        tokens = [""] * size
        for text, i in [*vocab.items(), *special.items()]:
            tokens[i] = text
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        byte_of = {c: b for b, c in enumerate(alphabet)}
        joins = np.zeros((256, 256), dtype=bool)
        for text in vocab:
            bare = text.removesuffix(suffix)
            for a, b in zip(bare, bare[1:]):
                joins[byte_of[a], byte_of[b]] = True
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        return cls(
            tokens=tokens,
            first=np.array([vocab[c] for c in alphabet], dtype=np.int64),
            last=np.array([vocab[c + suffix] for c in alphabet], dtype=np.int64),
            keys=keys[order], ranks=order.astype(np.int64), merged=merged[order], joins=joins,
            pattern=pattern, special=special,
        )

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words' token ids one after another, and how many each word has. No word is empty."""
        size = len(self.tokens)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths) - 1
        symbols = self.first[flat]
        symbols[ends] = self.last[flat[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        # No merge crosses two bytes that no token holds side by side: each part between them is merged on its own.
        opens = np.ones(len(flat), dtype=bool)
        opens[1:] = ~self.joins[flat[:-1], flat[1:]] | (word[1:] != word[:-1])
        part = np.cumsum(opens) - 1
        owner = word[opens]
        done_parts, done_symbols = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            key = symbols[:-1] * size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(symbols), NONE)
            rank[:-1] = np.where((self.keys[at] == key) & (part[1:] == part[:-1]), self.ranks[at], NONE)
            lowest = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(symbols)))
            low = np.repeat(lowest, counts)
            over = low == NONE
            if over.any():
                done_parts.append(part[over])
                done_symbols.append(symbols[over])
            hit = (rank == low) & ~over
            # A symbol that repeats makes the same pair overlap with itself: every second one counts, from the left.
            doubled = hit.copy()
            doubled[0] = False
            doubled[1:] &= hit[:-1]
            if doubled.any():
                places = np.arange(len(hit))
                begun = np.maximum.accumulate(np.where(hit & ~doubled, places, 0))
                hit &= (places - begun) % 2 == 0
            at_hit = np.flatnonzero(hit)
            symbols[at_hit] = self.merged[at[at_hit]]
            stay = ~over
            stay[at_hit + 1] = False
            symbols, part = symbols[stay], part[stay]
        parts, out = np.concatenate(done_parts), np.concatenate(done_symbols)
        order = np.argsort(parts, kind="stable")
        return out[order].astype("<u4"), np.bincount(owner[parts], minlength=len(words))

    def words_of(self, folded: str) -> list[bytes]:
        """The words, in UTF-8, of a string in lower case without white space."""
        _, plain, _, split = self.rules
        if folded.isascii():
            return [w.encode() for w in plain.findall(folded)]
        # letters and digits by the Unicode tables of the library to be matched
        return [w.encode() for w, _ in split.pre_tokenize_str(folded)]

    def prepare(self) -> tuple:
        """What finds special tokens, splits ASCII strings, folds strings, and splits any string."""
        from tokenizers import Regex, normalizers, pre_tokenizers

        marks = "|".join(map(re.escape, self.special)) or "(?!)"
        plain = self.pattern.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\s\p{L}\p{N}", "a-z0-9")
        fold = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        split = pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True)
        return re.compile(f"({marks})"), re.compile(plain), fold, split

    def learn(self, chunks: list[str]) -> None:
        """Encode these strings without white space and remember their ids."""
        self.rules = self.rules or self.prepare()
        marks, _, fold, _ = self.rules
        special = {i: np.uint32(n).astype("<u4").tobytes() for i, n in self.special.items()}
        mixed = {c: p for c in chunks if "<|" in c and len(p := [x for x in marks.split(c) if x]) + (c in special) > 1}
        parts = list({x for p in mixed.values() for x in p if x not in special}.union(c for c in chunks if c not in mixed))
        folded = fold.normalize_str("\n".join(parts)).split("\n") if parts else []
        split = {f: self.words_of(f) for f in set(folded)}
        words = list({w for p in split.values() for w in p})
        ids: dict[bytes, bytes] = {}
        if words:
            flat, counts = self.merge(words)
            whole, ends = flat.tobytes(), (np.cumsum(counts) * 4).tolist()
            ids = {w: whole[a:b] for w, a, b in zip(words, [0, *ends[:-1]], ends)}
        packed = {f: ids[p[0]] if len(p) == 1 else b"".join([ids[w] for w in p]) for f, p in split.items()}
        own = special | {x: packed[f] for x, f in zip(parts, folded)}
        self.remembered.update(own)
        self.remembered.update({c: b"".join([own[x] for x in p]) for c, p in mixed.items()})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids, packed as little-endian unsigned 32-bit integers."""
        out = []
        for a, b in pieces(texts, lambda t: len(t or ""), BLOCK_CHARS):
            split = [NO_SPACE.findall(t) if SEPARATORS.search(t) else t.split() for t in (t or "" for t in texts[a:b])]
            used = set().union(*split)
            new = used.difference(self.remembered)
            if len(self.remembered) + len(new) > REMEMBERED:  # what this block needs again stays
                self.remembered = {c: self.remembered[c] for c in used.difference(new)}
            if new:
                collecting = gc.isenabled()
                gc.disable()  # many small objects and no cycles: collecting garbage meanwhile takes half the time
                self.learn(list(new))
                if collecting:
                    gc.enable()
            get = self.remembered.__getitem__
            out += [b"".join(map(get, chunks)) for chunks in split]
        return out

    def decode(self, packed: list[bytes | None]) -> list[str]:
        """The tokens' own text with a space between any two, which is what a vocabulary without decoding rules gives."""
        token = self.tokens.__getitem__
        return [" ".join(map(token, np.frombuffer(p or b"", dtype="<u4").tolist())) for p in packed]


def _mapped(docs: DataFrame, added: list[T.StructField], of) -> DataFrame:
    """The frame with columns that `of(batch)` gives."""
    names = {f.name.lower() for f in added}
    schema = T.StructType([f for f in docs.schema.fields if f.name.lower() not in names] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = pa.schema([(f.name, pa.null()) for f in schema.fields])
            yield with_arrays(batch, order, of(batch))

    return docs.mapInArrow(run, schema)


IDS = [T.StructField("n_tokens", T.LongType(), False), T.StructField("ids", T.BinaryType(), False)]
DECODED = T.StructField("decoded", T.StringType(), False)


def _ids(vocabulary: Vocabulary, batch: pa.RecordBatch, text: str) -> tuple[list[bytes], dict[str, pa.Array]]:
    packed = vocabulary.encode(batch.column(text).to_pylist())
    return packed, {"n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()), "ids": pa.array(packed, pa.binary())}


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The documents with `n_tokens` and `ids` (packed little-endian unsigned 32-bit integers)."""
    vocabulary = Vocabulary.load(path)
    return _mapped(docs, IDS, lambda batch: _ids(vocabulary, batch, text)[1])


def decode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The documents with `decoded`, the text of their packed ids; null ids decode to empty text."""
    vocabulary = Vocabulary.load(path)
    return _mapped(docs, [DECODED], lambda b: {"decoded": pa.array(vocabulary.decode(b.column(ids).to_pylist()), pa.string())})


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`encode` and `decode` in one pass over the documents."""
    vocabulary = Vocabulary.load(path)

    def of(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        packed, arrays = _ids(vocabulary, batch, text)
        return arrays | {"decoded": pa.array(vocabulary.decode(packed), pa.string())}

    return _mapped(docs, [*IDS, DECODED], of)
