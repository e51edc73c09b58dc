"""A Merkle manifest of a dataset: a leaf for each row, a subroot for each group, one root, and a proof for each leaf.

A leaf's place in its group is its rank by id, found without sorting the group. Each group's ids are a compressed bitmap: one
row for each 64-bit word that has any bit, merged from all tasks by OR, with the number of rows under it. A directory of
popcounts is laid over the words, a level for every ten further bits of the id, and says how many rows come before a word
under each of its ancestors; no window of it holds more than 1,024 rows. A leaf's rank is what its words' ancestors count
before it, and the bits below its own. Parents gather their children's hashes by slot (rank mod 8) level by level. Proofs go
down again: a node has its own siblings and its parent's, so the texts of the siblings of all levels are put together once
for eight leaves.

All hashes are lower-case hex of SHA-256, and what is hashed again are their hex texts. A null or missing group is a group of
its own and comes first; groups are ordered by the bytes of their UTF-8 text. A null id comes first in its group. Rows of one
id are ordered by their leaf hash; equal rows take places of their own, one after the other. Null fields are `-`, empty texts
`0:`, and texts of any length are hashed whole. An empty table gives no rows. Columns other than the fields and the group are
neither hashed nor returned, so no name can clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.common import stored

#: Children of a node, a power of two.
FAN_BITS = 3
FAN = 1 << FAN_BITS
#: Bits of an id under a word of the bitmap, and under each level of the directory.
WORD, LEVELS = 6, (16, 26, 36, 46, 56)


def no_hash() -> Column:
    return F.lit(None).cast("string")


def field(c: Column) -> Column:
    """A value as its number of UTF-8 bytes, a colon and its text; `-` if null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _place(doc_id: Column) -> Column:
    return F.pmod(doc_id, F.lit(64)).cast("int")


def own_bit(doc_id: Column) -> Column:
    """The id's bit in its word of the bitmap."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), _place(doc_id))


def bits_below(doc_id: Column, bits: Column) -> Column:
    """How many bits of the id's word stand for smaller ids: the others are shifted out."""
    return F.bit_count(F.shiftleft(F.call_function("shiftleft", bits, 63 - _place(doc_id)), 1))


def leaves(rows: DataFrame, fields: dict[str, Column], doc_id: str, group: str) -> DataFrame:
    """(`id`, `grp`, `leaf`) of each row, and `other`: the leaf with the values that `fields` gives in place of columns.

    `fields` names the hashed columns in order, each with the value it has after tampering. `grp` is empty for a null group,
    else `+` and its text. `other` is null where nothing is different.
    """
    original, changed = digest(*[field(F.col(c)) for c in fields]), digest(*[field(v) for v in fields.values()])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(v) for c, v in fields.items()])
    return rows.select(
        F.col(doc_id).cast("long").alias("id"),
        F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("grp"),
        original.alias("leaf"),
        F.when(~same, changed).otherwise(no_hash()).alias("other"),
    )


def directory(rows: DataFrame) -> DataFrame:
    """(`grp`, `word`, `bits`, `n`, `before`): each group's bitmap of ids by words of 64 bits, the rows under a word and before it."""
    bit = own_bit(F.col("id"))
    known = rows.filter(F.col("id").isNotNull()).select("grp", F.shiftright("id", WORD).alias("word"), bit.alias("bit"))
    words = stored(known.groupBy("grp", "word").agg(F.bit_or("bit").alias("bits"), F.count("*").alias("n")))
    none = rows.filter(F.col("id").isNull()).groupBy("grp").agg(F.count("*").alias("none"))
    # from the words upward: what the nodes of a level hold, and what comes before them under one parent
    at, levels = words.select("grp", F.col("word").alias("node"), "n"), []
    for low, high in zip((WORD, *LEVELS), (*LEVELS, 64)):
        parent = F.shiftright("node", high - low) if high < 64 else F.lit(0).cast("long")
        under = Window.partitionBy("grp", "parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        level = at.withColumn("parent", parent).withColumn("before", F.coalesce(F.sum("n").over(under), F.lit(0)))
        levels.append(level.select("grp", "node", "parent", "before"))
        at = level.groupBy("grp", F.col("parent").alias("node")).agg(F.sum("n").alias("n"))
    # downward again: sums along the path
    total = none.select("grp", F.lit(0).cast("long").alias("parent"), F.col("none").alias("above"))
    for level in reversed(levels):
        joined = level.join(total, ["grp", "parent"], "left")
        total = joined.select("grp", F.col("node").alias("parent"), (F.col("before") + F.coalesce("above", F.lit(0))).alias("above"))
    return words.join(total.select("grp", F.col("parent").alias("word"), F.col("above").alias("before")), ["grp", "word"])


def placed(rows: DataFrame) -> DataFrame:
    """The leaves with `pos`, their rank in the group from 0.

    Words in which an id repeats, and null ids, cannot be ranked by bits: their rows are counted by id and the first digits
    of the leaf, so that an id with very many rows is split; only equal rows stay together.
    """
    words = stored(directory(rows))
    keyed = rows.withColumn("word", F.shiftright("id", WORD))
    ranked = keyed.join(words, ["grp", "word"])
    once = ranked.filter(F.col("n") == F.bit_count("bits"))
    once = once.select("id", "grp", "leaf", "other", (F.col("before") + bits_below(F.col("id"), F.col("bits"))).alias("pos"))
    again = ranked.filter(F.col("n") > F.bit_count("bits")).select("id", "grp", "leaf", "other", "word", "before")
    again = again.union(keyed.filter(F.col("id").isNull()).select("id", "grp", "leaf", "other", "word", F.lit(0).cast("long")))
    again = again.withColumn("start", F.substring("leaf", 1, 3))
    counts = again.groupBy("grp", "word", "id", "start").agg(F.count("*").alias("n"), F.first("before").alias("before"))
    earlier = Window.partitionBy("grp", "word").orderBy("id", "start").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    own = Window.partitionBy("grp", "word", "id", "start").orderBy("leaf")
    numbered = again.withColumn("nth", F.row_number().over(own) - 1)
    counts = counts.select(*[F.col(c).alias(f"c_{c}") for c in ("grp", "word", "id", "start")], "base")
    on = [numbered[c].eqNullSafe(F.col(f"c_{c}")) for c in ("grp", "word", "id", "start")]
    repeats = numbered.join(counts, on).select("id", "grp", "leaf", "other", (F.col("base") + F.col("nth")).alias("pos"))
    return once.union(repeats)


def numbered(groups: DataFrame) -> DataFrame:
    """The groups with their place in the order of names, by ranges, so that no task has all of them."""
    local = (1 << 33) - 1
    ordered = groups.repartitionByRange("grp").sortWithinPartitions("grp").withColumn("at", F.monotonically_increasing_id())
    ordered = stored(ordered.withColumn("part", F.shiftright("at", 33)))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = ordered.groupBy("part").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return ordered.join(starts, "part").select(*groups.columns, (F.col("start") + F.col("at").bitwiseAND(F.lit(local))).alias("pos"))


def levels_of(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """For nodes (`grp`, `pos`, `hash`, `id`, `other`) the runs of every level, lowest first, and the top node of each group
    with its `height`, the number of levels under it.

    A run is (`grp`, `parent`, `kids`): up to eight nodes by slot. Places are without gaps, so that a run at place 0 with one
    node is all that its group has left, and goes no further.
    """
    runs, tops, at = [], [], nodes
    while True:
        slot = F.struct(F.pmod("pos", F.lit(FAN)).alias("slot"), "hash", "id", "other")
        run = at.groupBy("grp", F.shiftright("pos", FAN_BITS).alias("parent")).agg(F.sort_array(F.collect_list(slot)).alias("kids"))
        run = stored(run)
        last = (F.col("parent") == 0) & (F.size("kids") == 1)
        tops.append(run.filter(last).select("grp", F.lit(len(runs)).alias("height"), F.inline("kids")).drop("slot"))
        rest = run.filter(~last)
        if rest.isEmpty():
            return runs, reduce(DataFrame.union, tops)
        runs.append(rest)
        joined = digest(F.array_join("kids.hash", ""))
        at = rest.select("grp", F.col("parent").alias("pos"), joined.alias("hash"), F.lit(None).cast("long").alias("id"), no_hash().alias("other"))


def paths(runs: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes (`grp`, `pos`, `hash`, `id`, `other`) that the lowest runs hold, with `subroot` and `path`: the texts of the
    siblings left and right of a node, then of the node over it, and so on.

    `above` has (`grp`, `height`, `subroot`, `path`): what follows over each group's top.
    """
    known = None
    for level, run in reversed(list(enumerate(runs))):
        tops = above.filter(F.col("height") == level + 1).select("grp", F.lit(0).cast("long").alias("pos"), "subroot", "path")
        known = tops if known is None else known.select(*tops.columns).union(tops)
        joined = run.join(known.select("grp", F.col("pos").alias("parent"), "subroot", "path"), ["grp", "parent"])
        one = joined.select("grp", "parent", "kids.hash", "subroot", "path", F.inline("kids").alias("slot", "own", "id", "other"))
        slot = F.col("slot").cast("int")
        left = F.array_join(F.slice("hash", F.lit(1), slot), "").alias("l")
        right = F.array_join(F.slice("hash", slot + 2, F.lit(FAN)), "").alias("r")
        path = F.concat(F.array(F.struct(left, right)), F.col("path"))
        known = one.select("grp", (F.col("parent") * FAN + slot).alias("pos"), F.col("own").alias("hash"), "id", "other", "subroot", path.alias("path"))
    return known


def manifest(rows: DataFrame, fields: dict[str, Column], doc_id: str = "doc_id", group: str = "lang") -> DataFrame:
    """(`doc_id`, `group`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root`, `verified`) of each row.

    `proof_sha256` is the hash of the siblings of all levels, from left to right. `folded_root` is computed from the row as
    `fields` changes it (see `leaves`) and its siblings; it equals the root where nothing has been changed.
    """
    at = placed(stored(leaves(rows, fields, doc_id, group)))
    runs, tops = levels_of(at.select("grp", "pos", F.col("leaf").alias("hash"), "id", "other"))
    tops = stored(tops)
    groups = stored(numbered(tops.select("grp", "hash", "height")))
    up, top = levels_of(groups.select(F.lit("").alias("grp"), "pos", "hash", F.col("height").cast("long").alias("id"), F.col("grp").alias("other")))
    root = top.first()
    # each group's subroot, and its siblings among the subroots
    none = F.array().cast("array<struct<l:string,r:string>>").alias("path")
    over = paths(up, top.select("grp", "height", no_hash().alias("subroot"), none)) if up else top.withColumn("path", none)
    over = stored(over.select(F.col("other").alias("grp"), F.col("id").alias("height"), F.col("hash").alias("subroot"), "path"))
    alone = tops.filter("height = 0").join(over.drop("height"), "grp")
    out = alone.select("hash", "id", "other", "grp", "subroot", "path")
    if runs:
        out = out.union(paths(runs, over).select(*out.columns))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    fold = F.aggregate("path", F.coalesce("other", "hash"), lambda acc, s: F.sha2(F.concat(s["l"], acc, s["r"]), 256))
    out = out.withColumns({"root": F.lit(root and root["hash"]).cast("string"), "folded_root": fold})
    return out.select(
        F.col("id").alias("doc_id"), F.when(F.col("grp") != "", F.expr("substring(grp, 2)")).alias("group"), F.col("hash").alias("leaf"),
        "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
