"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all
ways to cut it into pieces, which a forward pass gives; a text's is the product over its words. The probabilities are
fitted by expectation-maximisation on all labelled documents: word counts per language are taken once and stored, and each
round computes expected piece counts on them in a distributed pass.

Of the vocabulary, pieces of up to 8 letters are used (all but about one in twelve; the longer ones are left out), so the ways
to cut a word are those into such pieces. Words are runs of letters in lower case. Runs of over 32 letters are cut every 32
letters, so that no product underflows. Texts of any length are read whole.
Text that is null or has no letter is `und` with score 0. Rows with a null language teach nothing. Ties go to the language
that sorts first. With no labelled row at all, every document is `und`. Rows are mapped one by one, so repeated rows and
extra columns change nothing; an input column named like an output column is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.llm.common import pieces, stored, with_arrays

UNKNOWN = "und"
LONGEST_RUN = 32
#: Letters that a piece has at most; the first piece of a word also has a mark for the word's start.
LONGEST_PIECE = 8
#: Probability of a letter that no piece holds.
FLOOR = 1e-9
START = "▁"
BLOCK_CHARS = 4_000_000
REMEMBERED = 250_000
RUN = re.compile(r"[^\W\d_]+")


def read_pieces(path: str) -> list[str]:
    """The plain pieces of a sentencepiece model, in lower case, each once; read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p.lower() for p in plain if 0 < len(p.lower().lstrip(START)) <= LONGEST_PIECE or p == START})


def runs(text: str) -> list[str]:
    """The runs of letters of text in lower case, long ones cut."""
    found = [text] if text.isalpha() else RUN.findall(text)
    if not all(map(str.isalpha, found)):  # fractions and raised digits stand among the pattern's word characters
        found = ["".join(g) for r in found for letters, g in groupby(r, str.isalpha) if letters]
    if any(len(r) > LONGEST_RUN for r in found):
        found = [r[i : i + LONGEST_RUN] for r in found for i in range(0, len(r), LONGEST_RUN)]
    return found


#: Multiplier of the hash of a run of letters, and the first value of a piece that starts a word.
BASE, AT_START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x51ED270B27B4F3CF)
MASK = np.uint64((1 << 22) - 1)


def spread(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Index:
    """Numbers of pieces by the 64-bit hash of their letters."""

    keys: np.ndarray
    numbers: np.ndarray
    present: np.ndarray  # by the hash's low bits: whether a piece may have it

    @classmethod
    def of(cls, piece_list: list[str]) -> Index:
        found = {}
        for n, p in enumerate(piece_list):
            bare = p.removeprefix(START)
            h = np.array([AT_START if p.startswith(START) else 0], dtype=np.uint64)
            for c in bare:
                h = h * BASE + np.uint64(ord(c))
            if bare:
                found[int(spread(h)[0])] = n + 2
        keys = np.array(sorted(found), dtype=np.uint64)
        present = np.zeros(1 << 22, dtype=bool)
        present[(keys & MASK).astype(np.int64)] = True
        return cls(keys, np.array([found[k] for k in keys.tolist()], dtype=np.int32), present)

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Number of the piece of each hash, or 0."""
        h, out = spread(h), np.zeros(h.shape, dtype=np.int32)
        maybe = self.present[(h & MASK).astype(np.int64)]
        some = h[maybe]
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == some, self.numbers[at], 0)
        return out


@dataclass
class Pieces:
    """Piece probabilities by language: `table[p, g]`, where piece 0 is none and piece 1 an unknown letter."""

    index: Index
    langs: list[str]
    table: np.ndarray
    remembered: dict[str, int] = field(default_factory=dict)
    scores: list = field(default_factory=list)

    def lattice(self, words: list[str]) -> np.ndarray:
        """For words of one length: the piece that ends after letter i and is k letters long, at [word, i, k - 1]."""
        length = len(words[0])
        letters = np.array(words, dtype=f"<U{length}").view(np.uint32).reshape(len(words), length).astype(np.uint64)
        out = np.zeros((len(words), length + 1, LONGEST_PIECE), dtype=np.int32)
        inner, first = np.zeros((len(words), length + 1), dtype=np.uint64), np.full(len(words), AT_START)
        for k in range(1, min(length, LONGEST_PIECE) + 1):
            first = first * BASE + letters[:, k - 1]
            inner[:, k:] = inner[:, k - 1 : -1] * BASE + letters[:, k - 1 :]
            out[:, k + 1 :, k - 1] = self.index.look_up(inner[:, k + 1 :])
            out[:, k, k - 1] = self.index.look_up(first)
        single = out[:, 1:, 0]
        single[single == 0] = 1
        return out

    def forward(self, ids: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Summed probability of all segmentations of the first i letters, at [i]; table is indexed by piece first."""
        length = ids.shape[1] - 1
        alpha = [np.ones((len(ids), *table.shape[1:]))]
        for i in range(1, length + 1):
            alpha.append(sum(alpha[i - k] * table[ids[:, i, k - 1]] for k in range(1, min(i, LONGEST_PIECE) + 1)))
        return np.stack(alpha)

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language."""
        out = np.empty((len(words), len(self.langs)))
        by_length: dict[int, list[int]] = {}
        for n, w in enumerate(words):
            by_length.setdefault(len(w), []).append(n)
        for numbers in by_length.values():
            for a in range(0, len(numbers), 20_000):
                some = numbers[a : a + 20_000]
                out[some] = np.log(self.forward(self.lattice([words[n] for n in some]), self.table)[-1])
        return out

    def expected(self, words: list[str], lang: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in each language, for words of one length."""
        ids, groups, total = self.lattice(words), len(self.langs), np.zeros(self.table.size)
        length = ids.shape[1] - 1
        at = ids * groups + lang[:, None, None]
        flat = self.table.reshape(-1)[:, None]
        alpha = self.forward(at, flat)[..., 0]
        beta = [None] * length + [np.ones(len(words))]
        for i in range(length - 1, -1, -1):
            beta[i] = sum(beta[i + k] * flat[at[:, i + k, k - 1], 0] for k in range(1, min(length - i, LONGEST_PIECE) + 1))
        scale = count / alpha[length]
        for i in range(1, length + 1):
            for k in range(1, min(i, LONGEST_PIECE) + 1):
                use = alpha[i - k] * flat[at[:, i, k - 1], 0] * beta[i] * scale
                total += np.bincount(at[:, i, k - 1], weights=use, minlength=self.table.size)
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores, groups = [], [], len(self.langs)
        for a, b in pieces(texts, lambda t: len(t or ""), BLOCK_CHARS):
            split = [(t or "").lower().split() for t in texts[a:b]]
            every = set().union(*split)
            new = every.difference(self.remembered)
            if len(self.remembered) + len(new) > REMEMBERED:
                self.remembered, self.scores, new = {}, [], every
            if new and groups:
                self.learn(list(new))
            table = np.concatenate(self.scores) if self.scores else np.zeros((0, groups + 1))
            self.scores = [table]
            for chunks in split:
                at = np.fromiter(map(self.remembered.__getitem__, chunks), dtype=np.int64, count=len(chunks)) if groups else []
                total = table[at].sum(axis=0) if len(at) else np.zeros(groups + 1)
                if total[-1] == 0:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                else:  # the posterior, with the evidence of n words counted as that of sqrt(n)
                    z = (total[:-1] - total[:-1].max()) / np.sqrt(total[-1])
                    best = int(np.argmax(z))
                    langs.append(self.langs[best])
                    scores.append(float(1 / np.exp(z).sum()))
        return langs, scores

    def learn(self, chunks: list[str]) -> None:
        """Remember the log-probabilities and the number of words of these strings without white space."""
        found = list(map(runs, chunks))
        words = list({w for r in found for w in r})
        number = {w: n for n, w in enumerate(words)}
        own = np.concatenate([self.log_probabilities(words), np.ones((len(words), 1))], axis=1)
        flat = np.fromiter((number[w] for r in found for w in r), dtype=np.int64)
        owner = np.repeat(np.arange(len(found)), [len(r) for r in found])
        sums = np.stack([np.bincount(owner, weights=own[flat, g], minlength=len(found)) for g in range(own.shape[1])], axis=1)
        base = sum(map(len, self.scores))
        self.remembered.update({c: base + n for n, c in enumerate(chunks)})
        self.scores.append(sums)


COUNTS = "lang string, word string, n long"


def word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """How often each word occurs in each language: counted in every task first, then shuffled and summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for g, c in counts.items():
                words: Counter = Counter()
                for chunk, n in c.items():
                    for w in runs(chunk):
                        words[w] += n
                keys = list(words)
                for a in range(0, len(keys), 50_000):
                    some = keys[a : a + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([g] * len(some)), pa.array(some), pa.array([words[w] for w in some], pa.int64())], names=["lang", "word", "n"])
            counts.clear()

        for batch in batches:
            for t, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(g, Counter()).update(t.lower().split())
            if sum(map(len, counts.values())) > REMEMBERED:
                yield from given()
        yield from given()

    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text), F.col(lang))
    return known.mapInArrow(run, COUNTS).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, piece_list: list[str], text: str = "text", lang: str = "lang", rounds: int = 2) -> Pieces:
    """Piece probabilities of every language of these documents.

    What comes to the driver is one number for each piece and language, whatever the size of the documents.
    """
    index = Index.of(piece_list)
    counts = stored(word_counts(docs, text, lang))
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    number = {g: n for n, g in enumerate(langs)}
    model = Pieces(index, langs, _normal(np.ones((len(piece_list) + 2, len(langs)))))
    for _ in range(rounds if langs else 0):

        def run(batches: Iterator[pa.RecordBatch], model: Pieces = model) -> Iterator[pa.RecordBatch]:
            total = np.zeros(model.table.size)
            for batch in batches:
                by_length: dict[int, list] = {}
                for g, w, n in zip(*(c.to_pylist() for c in batch.columns)):
                    by_length.setdefault(len(w), []).append((w, number[g], n))
                for rows in by_length.values():
                    words, lang, n = zip(*rows)
                    total += model.expected(list(words), np.array(lang), np.array(n, dtype=float))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["at", "uses"])

        sums = counts.mapInArrow(run, "at long, uses double").groupBy("at").agg(F.sum("uses").alias("uses")).collect()
        table = np.zeros(model.table.size)
        for r in sums:
            table[r.at] = r.uses
        model = Pieces(index, langs, _normal(table.reshape(model.table.shape)))
    return model


def _normal(uses: np.ndarray) -> np.ndarray:
    """Probabilities from the uses of each piece, smoothed by a tenth of a use each."""
    table = (uses + 0.1) / (uses + 0.1).sum(axis=0, keepdims=True) if uses.size else uses
    table[0] = 0
    table[1] = FLOOR
    return table


def predict(docs: DataFrame, model: Pieces, text: str = "text") -> DataFrame:
    """The documents with `lang_pred` and `score` (0 to 1)."""
    added = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)]
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("lang_pred", "score")]
    schema = T.StructType(kept + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = model.predict(batch.column(text).to_pylist())
            order = pa.schema([(f.name, pa.null()) for f in schema.fields])
            yield with_arrays(batch, order, {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    return docs.mapInArrow(run, schema)
