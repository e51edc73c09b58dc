"""Benchmark decontamination by templates.

A text's words become template tokens: numbers, units after a number and capitalised words turn into typed slots, all other
words stand as they are in lower case without outer punctuation. Windows of template tokens are joined by hash with those of
the benchmark's items, so a question with other numbers and names still meets its original. Along one alignment, the slots
must be filled consistently: equal slots of the item by equal values in the document, different ones by different values.
Windows that go against the most frequent filling do not count, the others do. A document is contaminated by an item if consistent windows cover enough of the item's windows.

Null and empty texts have no windows and contaminate nothing. Items of fewer words than a window are one window. Windows
that are mostly slots say little and are left out, as long as the item has other ones; else they count if their slots are
literally equal. Repeated documents each count;
a null doc_id is a document of its own by its text. Texts of any length are read whole. Without documents or items nothing is
contaminated. Columns other than ids and texts are not read; `clean` keeps all of a document's, whatever their names. Ties do not arise: all items that reach the share are reported.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import free_name

WIDTH = 8
#: Words that stand as they are which a window of the full width has at least.
LITERAL = 4
#: Item windows up to which their hashes are sent to the tasks, to leave windows of documents out before the join.
SENT_UP_TO = 2_000_000
REMEMBERED = 300_000
OUTER = " \t\r\n.,;:!?'\"()[]{}<>*#$%&|/\\+=_~`^@-–—“”‘’«»…¿¡"
NUMBER = re.compile(r"[-+$€£]?\d[\d.,:/]*[a-z%°]{0,3}$", re.IGNORECASE)
# Number words and units.
NUMBER_WORDS = frozenset("two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
UNITS = frozenset("km m cm mm kg g mg lb lbs oz l ml ft feet inch inches mile miles meter meters metre metres gram grams kilogram kilograms liter liters litre litres hour hours minute minutes second seconds day days week weeks month months year years dollar dollars cent cents euro euros pound pounds percent degrees".split())
PLAIN, NUM, UNIT, NAME, SKIP = range(5)
#: Multiplier of the windows' polynomial hash.
BASE = np.uint64(0x9E3779B97F4A7C15)
CODES = np.array([xxhash.xxh64_intdigest(f"<{k}>", 7) for k in ("", "number", "unit", "name")], dtype=np.uint64)


def token(raw: str) -> tuple[int, int, str]:
    """Kind, 64-bit code and value of a string between white space."""
    bare = raw.strip(OUTER)
    if not bare:
        return SKIP, 0, ""
    lower = bare.lower()
    if NUMBER.match(bare) or lower in NUMBER_WORDS:
        kind = NUM
    elif bare[0].isupper() and (len(bare) == 1 or not bare.isupper()):
        kind = NAME
    else:
        kind = UNIT if lower in UNITS else PLAIN
    return kind, xxhash.xxh64_intdigest(lower, 7), lower


class Reader:
    """Turns texts into template tokens; remembers the tokens seen so far."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}
        self.values: list[str] = []
        self.tables = np.zeros(1024, dtype=np.int8), np.zeros(1024, dtype=np.uint64)

    def learn(self, words: list[str]) -> None:
        found, n = list(map(token, words)), len(self.values)
        self.seen.update(zip(words, range(n, n + len(words))))
        self.values += [f[2] for f in found]
        while len(self.values) > len(self.tables[0]):
            self.tables = tuple(np.concatenate([t, np.zeros_like(t)]) for t in self.tables)
        for table, column in zip(self.tables, (0, 1)):
            table[n : n + len(words)] = [f[column] for f in found]

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code, kind and number of each token of a text, names as slots."""
        return self.coded(self.numbers(text), True)

    def numbers(self, text: str) -> np.ndarray:
        if len(self.values) > REMEMBERED:
            self.__init__()
        words = text.split()
        new = set(words).difference(self.seen)
        if new:
            self.learn(list(new))
        return np.fromiter(map(self.seen.__getitem__, words), dtype=np.int64, count=len(words))

    def coded(self, at: np.ndarray, names: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code, kind and number of each token. Without names, capitalised words stand as they are."""
        kind_of, code_of = self.tables
        kinds = kind_of[at]
        at, kinds = at[kinds != SKIP], kinds[kinds != SKIP].copy()
        if not names:
            kinds[kinds == NAME] = PLAIN
        unit = kinds == UNIT  # a unit is a slot after a number only
        kinds[unit & ~np.concatenate(([False], kinds[:-1] == NUM))[: len(kinds)]] = PLAIN
        return np.where(kinds == PLAIN, code_of[at], CODES[kinds]), kinds, at


def window_hashes(codes: np.ndarray, kinds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of this width, and how many plain words it has."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    h = np.full(n, np.uint64(width))
    for i in range(width):
        h = (h ^ codes[i : i + n]) * BASE
        h ^= h >> np.uint64(29)
    plain = np.concatenate(([0], np.cumsum(kinds == PLAIN)))
    return h, plain[width:] - plain[:-width]


def _forms(reader: Reader, text: str, widths: list[int], of_items: bool) -> list[tuple]:
    """Codes, kinds, numbers, width, and which windows to look at, for each way to cut a text into windows.

    Names are slots first and words then. Windows without a name are the same both times and looked at once.
    """
    numbers, out = reader.numbers(text), []
    slots = reader.coded(numbers, True)
    if not len(slots[0]):
        return out
    named = np.concatenate(([0], np.cumsum(slots[1] == NAME)))
    forms = [slots, reader.coded(numbers, False)] if named[-1] else [slots]
    for width in [min(len(slots[0]), widths[-1])] if of_items else [w for w in widths if w <= len(slots[0])]:
        everywhere = np.ones(len(named) - width, dtype=bool)
        for form, look in zip(forms, (everywhere, named[width:] > named[:-width])):
            out.append((*form, width, look))
    return out


COLUMNS = "hash long, pos int, exact boolean, slots array<string>"


def _windows(batches, widths: list[int], wanted: np.ndarray | None, of_items: bool) -> Iterator[pa.RecordBatch]:
    """Windows of (id, text) rows, both with names as slots and with names as words, for copies in capitals or without any. Of
    items: one that is shorter than the widest window is one window, and windows that are mostly slots are left out unless
    neither form has any other; these are `exact`, for their slots say what their words do not.
    """
    reader, mask = Reader(), None
    if wanted is not None:
        mask = np.zeros(1 << 22, dtype=bool)
        mask[(wanted & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
    for batch in batches:
        rows: dict[str, list] = {"n": [], "hash": [], "pos": [], "exact": [], "slots": []}
        for n, text in enumerate(batch.column(1).to_pylist()):
            forms = [(*form, *window_hashes(*form[:2], form[3])) for form in _forms(reader, text or "", widths, of_items)]
            literal = any(((plain >= LITERAL) & look).any() for _, _, _, _, look, _, plain in forms)
            for codes, kinds, at, width, keep, h, plain in forms:
                few = (plain < LITERAL) & (width == WIDTH)
                if of_items and literal:
                    keep = keep & ~few
                elif mask is not None:
                    keep = keep & mask[(h & np.uint64((1 << 22) - 1)).astype(np.int64)]
                    some = h[keep]
                    keep[keep] = wanted[np.minimum(np.searchsorted(wanted, some), len(wanted) - 1)] == some
                for p in np.flatnonzero(keep).tolist():
                    rows["n"].append(n)
                    rows["hash"].append(int(h[p].view(np.int64)))
                    rows["pos"].append(p)
                    rows["exact"].append(bool(few[p]))
                    rows["slots"].append([reader.values[at[p + j]] for j in range(width) if kinds[p + j] != PLAIN])
        out = [batch.column(0).take(pa.array(rows["n"], pa.int64())), pa.array(rows["hash"], pa.int64()), pa.array(rows["pos"], pa.int32()), pa.array(rows["exact"], pa.bool_()), pa.array(rows["slots"], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(out, names=["id", "hash", "pos", "exact", "slots"])


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(`id`, `hash`, `pos`, `slots`) for all windows of the items."""
    rows = benchmark.select(F.col(item_id).alias("id"), F.col(text))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lambda b: _windows(b, [WIDTH], None, True), f"id {kind}, {COLUMNS}")


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = 0.3) -> DataFrame:
    """(`doc_id`, `item_id`, `n_windows`, `covered`) for each document and item whose consistent windows cover at least
    `share` of the item's windows. Documents are named by doc_id and the hash of their text, so repeated ids are kept apart;
    equal rows give one result.
    """
    items = item_windows(benchmark).dropDuplicates(["id", "hash", "pos"])
    hashes = items.select("hash").distinct()
    widths_of = benchmark.select(F.col("text")).mapInArrow(_lengths, "width int")
    widths = sorted({r.width for r in widths_of.distinct().collect()} | {WIDTH})
    # what is sent to the tasks is bounded; a larger benchmark is met by the join alone
    some = hashes.limit(SENT_UP_TO + 1)
    wanted = None
    if 0 < some.count() <= SENT_UP_TO:
        wanted = np.unique(np.array([r.hash for r in some.collect()], dtype=np.int64).view(np.uint64))
    rows = docs.select(F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash")).alias("id"), F.col(text))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(lambda b: _windows(b, widths, wanted, False), f"id {kind}, {COLUMNS}")
    total = items.groupBy("id").agg(F.countDistinct("pos").alias("n_windows")).withColumnRenamed("id", "item_id")
    theirs = items.select(F.col("id").alias("item_id"), "hash", F.col("pos").alias("at"), "exact", F.col("slots").alias("theirs"))
    met = found.drop("exact").join(theirs, "hash").filter(~F.col("exact") | (F.col("theirs") == F.col("slots"))).withColumn("shift", F.col("pos") - F.col("at"))
    aligned = met.groupBy("id", "item_id", "shift").agg(F.collect_set(F.struct("at", "theirs", "slots")).alias("windows"))
    of_item = aligned.schema["item_id"].dataType.simpleString()
    agreed = aligned.select("id", "item_id", "windows").mapInArrow(_agreed, f"id {kind}, item_id {of_item}, at array<int>")
    covered = agreed.select("id", "item_id", F.explode("at").alias("at")).groupBy("id", "item_id").agg(F.countDistinct("at").alias("covered"))
    full = covered.join(total, "item_id").filter(F.col("covered") >= F.col("n_windows") * share)
    return full.select(F.col("id.doc_id").alias("doc_id"), F.col("id.text_hash").alias("text_hash"), "item_id", "n_windows", (F.col("covered") / F.col("n_windows")).alias("covered"))


def consistent(windows: list[tuple[int, list[str], list[str]]]) -> list[int]:
    """Places of an alignment's windows (place, the item's slots, the document's) that agree with one filling of the slots.

    The filling takes pairs of values one to one, the most frequent pairs first; windows with equal slots always count.
    """
    counts = Counter(pair for _, theirs, slots in windows for pair in zip(theirs, slots))
    filled: dict[str, str] = {}
    used: set[str] = set()
    for value, other in sorted(counts, key=lambda p: (-counts[p], p[0] != p[1], p)):
        if value not in filled and other not in used:
            filled[value] = other
            used.add(other)
    return sorted({at for at, theirs, slots in windows if theirs == slots or all(filled.get(v) == w for v, w in zip(theirs, slots))})


def _agreed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = [consistent([(w["at"], w["theirs"], w["slots"]) for w in ws]) for ws in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.list_(pa.int32()))], names=["id", "item_id", "at"])


def _lengths(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        reader = Reader()
        found = {min(len(reader.read(t or "")[0]), WIDTH) for t in batch.column(0).to_pylist()} - {0}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], names=["width"])


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = 0.3) -> DataFrame:
    """The documents that no item contaminates."""
    key, bad_id = free_name(docs, "text_hash"), free_name(docs, "bad_id")
    bad = contaminated(docs, benchmark, doc_id, text, share).select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(key)).distinct()
    same = F.col(doc_id).eqNullSafe(F.col(bad_id)) & (F.xxhash64(F.col(text)) == F.col(key))
    return docs.join(bad, same, "left_anti")
