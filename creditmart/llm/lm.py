"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is predicted from the two tokens before it and the two after it, itself masked; the sum of these conditional
log-probabilities scores a document. Tokens are words in (Unicode's simple) lower case. The network embeds each context
position, sums, squashes, and predicts a class of tokens and then the token within its class. Its tokens are the most frequent
words of the corpus, each on its own, and hashed groups of all others.

A word of a group has the group's probability times the word's share of the group's occurrences in the corpus learnt from, so
every word has a probability of its own, at any size of the vocabulary. All words are counted. Counts of up to `SENT` most
frequent words go to the tasks; the others stay a table, which grows with the corpus, and tokens beyond the sent words are
joined to it. A word that the corpus does not have counts like one seen once. The network itself does not grow: what it
learns of a rarer word's context it learns of the word's group.

Training runs where the data are: in each round every task takes the network of the last round, goes once over its documents
of that round by stochastic gradient steps in numpy, and gives out the rows of its parameters that it has changed. Spark
averages them, weighted by how often each was changed. Every document is learnt from once. The driver holds one network and
the sent words.

Null and empty texts have no tokens: log-probability 0, perplexity 1. Texts of any length are read whole, in blocks. An empty
table teaches nothing and gives no rows. Tokens beyond a text's ends are a padding token.
Repeated rows are scored alike. Columns of the input are kept, but for those named like an added one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.llm.common import free_name, pieces, stored, with_arrays

CLASSES, WITHIN = 48, 48
TOKENS = CLASSES * WITHIN
#: Tokens that are groups of all rarer words.
GROUPS = 64
WIDTH = 16
CONTEXT = (-2, -1, 1, 2)
BATCH = 8_192
BLOCK_CHARS = 4_000_000
REMEMBERED = 400_000
#: Words whose counts are sent to the tasks, at most.
SENT = 200_000
EMBEDDING_ROWS = len(CONTEXT) * (TOKENS + 1)
#: Rows of the network: embeddings, then classes, then tokens; the last column is a bias.
ROWS = EMBEDDING_ROWS + CLASSES + TOKENS


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after another, and how many each text has."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(texts.fill_null("")))
    words = split.flatten()
    real = pc.not_equal(words, "")  # blanks at a text's ends split off empty strings
    before = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    return words.filter(real), np.diff(before[offsets])


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    lengths = pc.binary_length(texts).fill_null(0).to_pylist()
    for a, b in pieces(lengths, lambda n: n, BLOCK_CHARS):
        yield texts[a:b]


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(`word`, `n`) of all words of all documents, counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = [], 0

        def summed() -> pa.Table:
            table = pa.concat_tables(counts).group_by("word").aggregate([("n", "sum")])
            return table.rename_columns({"n_sum": "n"}).select(["word", "n"])

        for batch in batches:
            for some in blocks(batch.column(0)):
                found = pc.value_counts(words_of(some)[0])
                counts.append(pa.table({"word": found.field(0), "n": found.field(1)}))
                held += len(found)
            if held > 3 * REMEMBERED:
                counts = [summed()]
                held = len(counts[0])
                if held > REMEMBERED:
                    yield from counts[0].to_batches(50_000)
                    counts, held = [], 0
        if counts:
            yield from summed().to_batches(50_000)

    counted = docs.select(text).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, n: int = TOKENS - GROUPS) -> dict[str, int]:
    """The n most frequent words with their counts; ties by the word."""
    return {r.word: r.n for r in counts.orderBy(F.desc("n"), "word").limit(n).collect()}


def group_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(GROUPS)).cast("int")


@dataclass(frozen=True)
class Lexicon:
    """What the tasks know of words: the sent ones with token numbers and logarithms of their shares of their tokens, and for
    each group the logarithm of the share of a word seen once."""

    words: pa.Array
    tokens: np.ndarray
    shares: np.ndarray
    once: np.ndarray

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token numbers of the words, logarithms of their shares, and which of them are not among the sent words."""
        coded = words.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.words).fill_null(-1).to_numpy()
        other = np.flatnonzero(at < 0)
        tokens, shares = np.append(self.tokens, 0)[at], np.append(self.shares, 0.0)[at]
        group = np.array([xxhash.xxh64_intdigest(w, 42) % GROUPS for w in coded.dictionary.take(other).cast(pa.binary()).to_pylist()], dtype=np.int64)
        tokens[other], shares[other] = TOKENS - GROUPS + group, self.once[group]
        codes = coded.indices.to_numpy()
        return tokens[codes], shares[codes], (at < 0)[codes]


class Vocabulary(list):
    """The words that are tokens of their own, with the lexicon for the tasks and the counts of the words that occur more than
    once but are not sent (None: there are none)."""

    def __init__(self, own: list[str] | dict[str, int], sent: list[tuple[str, int, int]] = (), totals: dict[int, int] | None = None, more: DataFrame | None = None):
        """`sent`: other words with their group and count; `totals`: occurrences in each group. `own` may name counts too."""
        super().__init__(own)
        self.more = more
        own_counts = list(own.values()) if isinstance(own, dict) else [0] * len(own)
        # Words that the corpus lacks share one place more in each group.
        occurrences = np.array([(totals or {}).get(g, 0) + 1 for g in range(GROUPS)], dtype=np.float64)
        self.counts = np.concatenate([own_counts, np.zeros(TOKENS - GROUPS - len(own)), occurrences])
        groups = np.array([g for _, g, _ in sent], dtype=np.int64)
        tokens = np.concatenate([np.arange(len(own)), TOKENS - GROUPS + groups]).astype(np.int32)
        shares = np.concatenate([np.zeros(len(own)), np.log(np.array([n for _, _, n in sent], dtype=np.float64) / occurrences[groups])])
        self.lexicon = Lexicon(pa.array([*own, *[w for w, _, _ in sent]], pa.string()), tokens, shares, -np.log(occurrences))

    @classmethod
    def of(cls, docs: DataFrame, text: str = "text", sent: int = SENT) -> Vocabulary:
        counts = stored(word_counts(docs, text))
        own = frequent_words(counts)
        rest = counts.filter(~F.col("word").isin(list(own)))
        rest = rest.withColumn("group", group_of(F.col("word")))
        totals = {r.group: r.n for r in rest.groupBy("group").agg(F.sum("n").alias("n")).collect()}
        # The lowest count that no more than `sent` words reach.
        least, reached = None, 0
        for r in rest.groupBy("n").count().orderBy(F.desc("n")).limit(sent + 1).collect():
            if reached + r["count"] > sent:
                break
            least, reached = r.n, reached + r["count"]
        if least is None:
            return cls(own, [], totals, rest.filter("n > 1").select("word", "n") if totals else None)
        chosen = sorted((r.word, r.group, r.n) for r in rest.filter(F.col("n") >= least).collect())
        return cls(own, chosen, totals, rest.filter(F.col("n").between(2, least - 1)).select("word", "n") if least > 2 else None)


@dataclass
class Network:
    words: list[str]
    table: np.ndarray  # ROWS x (WIDTH + 1)

    @classmethod
    def new(cls, words: list[str], seed: int = 5) -> Network:
        table = np.random.default_rng(seed).normal(0, 0.1, (ROWS, WIDTH + 1)).astype(np.float32)
        table[:, -1] = 0
        return cls(words, table)

    def with_shares(self) -> Network:
        """The network whose biases are the shares of the classes and of their tokens in the corpus."""
        counts = self.words.counts.reshape(CLASSES, WITHIN) + 1
        table = self.table.copy()
        classes = counts.sum(axis=1)
        table[EMBEDDING_ROWS:, -1] = np.concatenate([np.log(classes / classes.mean()), np.log(counts / classes.mean() * CLASSES).ravel()])
        return Network(self.words, table)

    @staticmethod
    def windows(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of the context's embeddings of each token, and the tokens, over all texts; texts do not overlap."""
        lengths = [len(t) for t in tokens]
        return Network.windows_of(np.concatenate([np.zeros(0, np.int32), *tokens]), np.array(lengths, dtype=np.int64))

    @staticmethod
    def windows_of(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of all texts' tokens, one after another, and the texts' lengths."""
        reach = max(CONTEXT)
        at = np.arange(len(tokens)) + reach * (1 + np.repeat(np.arange(len(lengths)), lengths))
        flat = np.full(len(tokens) + reach * (1 + len(lengths)), TOKENS, dtype=np.int32)
        flat[at] = tokens
        return np.stack([flat[at + c] + k * (TOKENS + 1) for k, c in enumerate(CONTEXT)], axis=1), tokens

    def forward(self, context: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, ...]:
        """Hidden values, and scores of the classes; then for the tokens ordered by class: the order, where each class begins
        there, and the scores within it. A last hidden value of one goes with the bias."""
        hidden = np.take(self.table, context[:, 0], axis=0)
        for k in range(1, context.shape[1]):
            hidden += np.take(self.table, context[:, k], axis=0)
        np.tanh(hidden, out=hidden)
        hidden[:, -1] = 1
        classes = hidden @ self.table[EMBEDDING_ROWS : EMBEDDING_ROWS + CLASSES].T
        kind = (target // WITHIN).astype(np.uint8)
        order = np.argsort(kind, kind="stable")
        bounds = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        by_class, within = hidden[order], np.empty((len(target), WITHIN), dtype=hidden.dtype)
        for c, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b:
                np.matmul(by_class[a:b], self._within(c).T, out=within[a:b])
        return hidden, classes, order, bounds, by_class, within

    def _within(self, c: int) -> np.ndarray:
        return self.table[EMBEDDING_ROWS + CLASSES + c * WITHIN : EMBEDDING_ROWS + CLASSES + (c + 1) * WITHIN]

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        out = np.empty(len(target))
        for a in range(0, len(target), BATCH):
            t = target[a : a + BATCH]
            _, classes, order, _, _, within = self.forward(context[a : a + BATCH], t)
            every, part = np.arange(len(t)), np.empty(len(t))
            part[order] = within[every, t[order] % WITHIN] - _log_sum(within)
            out[a : a + BATCH] = classes[every, t // WITHIN] - _log_sum(classes) + part
        return np.maximum(out, np.log(1e-30))

    def train(self, context: np.ndarray, target: np.ndarray, changed: np.ndarray, rate: float) -> None:
        """Gradient steps on batches; `changed` counts the uses of each row. A row's step is scaled by its share of uses."""
        for first in range(0, len(target), BATCH):
            c, t = context[first : first + BATCH], target[first : first + BATCH]
            hidden, classes, order, bounds, by_class, within = self.forward(c, t)
            every = np.arange(len(t))
            classes, within = _softmax(classes), _softmax(within)
            classes[every, t // WITHIN] -= 1
            within[every, t[order] % WITHIN] -= 1
            own = self.table[EMBEDDING_ROWS : EMBEDDING_ROWS + CLASSES]
            back = classes @ own
            own -= rate / np.sqrt(len(t)) * (classes.T @ hidden)
            changed[EMBEDDING_ROWS : EMBEDDING_ROWS + CLASSES] += len(t) / CLASSES
            inner = np.empty_like(by_class)
            for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if a < b:
                    own = self._within(k)
                    np.matmul(within[a:b], own, out=inner[a:b])
                    own -= rate / np.sqrt(b - a) * (within[a:b].T @ by_class[a:b])
                    lo = EMBEDDING_ROWS + CLASSES + k * WITHIN
                    changed[lo : lo + WITHIN] += (b - a) / WITHIN
            back[order] += inner
            back *= 1 - hidden**2  # nothing goes back to the bias, whose hidden value is one
            rows = c.astype(np.uint16).ravel()  # sorted by radix
            order = np.argsort(rows, kind="stable")
            rows = rows[order]
            starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
            counts = np.diff(np.append(starts, len(rows)))
            rows = rows[starts]
            self.table[rows] -= rate * np.add.reduceat(back[order // c.shape[1]], starts, axis=0) / np.sqrt(counts).astype(back.dtype)[:, None]
            changed[rows] += counts


def _softmax(z: np.ndarray) -> np.ndarray:
    np.exp(z - z.max(axis=1, keepdims=True), out=z)
    z /= (z @ np.ones(z.shape[1], dtype=z.dtype))[:, None]
    return z


def _log_sum(z: np.ndarray) -> np.ndarray:
    top = z.max(axis=1)
    return np.log(np.exp(z - top[:, None]) @ np.ones(z.shape[1], dtype=z.dtype)) + top


def fit(docs: DataFrame, text: str = "text", rounds: int = 2, rate: float = 0.05, sent: int = SENT) -> Network:
    """A network trained once over all documents, which are dealt to the rounds by the hash of their text."""
    network = Network.new(Vocabulary.of(docs, text, sent)).with_shares()
    lexicon = network.words.lexicon
    fields = [f"v{i}" for i in range(WIDTH + 1)]
    schema = "row int, n double, " + ", ".join(f"{f} float" for f in fields)
    for number in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], start: np.ndarray = network.table) -> Iterator[pa.RecordBatch]:
            own, changed = Network([], start.copy()), np.zeros(ROWS)
            for batch in batches:
                for some in blocks(batch.column(0)):
                    words, lengths = words_of(some)
                    own.train(*own.windows_of(lexicon.find(words)[0], lengths), changed, rate)
            rows = np.flatnonzero(changed)
            weighted = own.table[rows] * changed[rows, None].astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array(changed[rows]), *[pa.array(weighted[:, i]) for i in range(WIDTH + 1)]], names=["row", "n", *fields])

        mine = docs.select(text).filter(F.pmod(F.xxhash64(F.col(text)), F.lit(rounds)) == number)
        mean = mine.mapInArrow(run, schema).groupBy("row").agg(F.sum("n").alias("n"), *[F.sum(f).alias(f) for f in fields])
        table = network.table.copy()
        for r in mean.collect():
            table[r.row] = np.array(r[2:], dtype=np.float64) / r.n
        network = Network(network.words, table)
    return network


def score(docs: DataFrame, network: Network, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with `n_tokens`, `log_probability` (summed), and `perplexity`.

    Where the vocabulary has words that are not sent, the scores by the sent ones are stored with the other tokens of each
    document, and the logarithms of these tokens' counts, by a join, added to them.
    """
    added = [T.StructField("n_tokens", T.LongType(), False), T.StructField("log_probability", T.DoubleType(), False)]
    names = [f.name for f in added]
    kept = [f for f in docs.schema.fields if f.name.lower() not in (*names, "perplexity") and (keep_text or f.name.lower() != text.lower())]
    row, others = free_name(docs, "_row"), free_name(docs, "_others")
    extra = [T.StructField(row, T.LongType(), False), T.StructField(others, T.ArrayType(T.StringType()), False)]
    words = network.words if isinstance(network.words, Vocabulary) else Vocabulary(network.words)
    plain, lexicon, joined = Network([], network.table), words.lexicon, words.more is not None
    schema = T.StructType(kept + added + (extra if joined else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            counts, sums, rest, ends = [], [], [], []
            for some in blocks(batch.column(text)):
                found, lengths = words_of(some)
                tokens, shares, other = lexicon.find(found)
                p = np.concatenate(([0.0], np.cumsum(plain.log_probabilities(*plain.windows_of(tokens, lengths)) + shares)))
                last = np.cumsum(lengths)
                counts.append(lengths)
                sums.append(p[last] - p[last - lengths])
                if joined:
                    rest.append(found.filter(pa.array(other)))
                    ends.append(np.diff(np.concatenate(([0], np.cumsum(other)))[np.concatenate(([0], last))]))
            n, total = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((counts, np.int64), (sums, np.float64)))
            arrays = {"n_tokens": pa.array(n), "log_probability": pa.array(total)}
            if joined:
                offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *ends]))]).astype(np.int32)
                arrays[row] = pa.array(np.arange(number, number + len(n)))
                arrays[others] = pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays([pa.array([], pa.string()), *rest]))
                number += len(n)
            yield with_arrays(batch, pa.schema([(f.name, pa.null()) for f in schema.fields]), arrays)

    scored = docs.mapInArrow(run, schema)
    if joined:
        scored = stored(scored)
        tokens = scored.select(row, F.explode(others).alias("word")).join(words.more, "word")
        sums = tokens.groupBy(row).agg(F.sum(F.log(F.col("n").cast("double"))).alias(others))
        scored = scored.drop(others).join(sums, row, "left")
        scored = scored.withColumn("log_probability", F.col("log_probability") + F.coalesce(others, F.lit(0.0))).drop(row, others)
    per_token = -F.col("log_probability") / F.greatest("n_tokens", F.lit(1))
    return scored.withColumn("perplexity", F.exp(per_token))
