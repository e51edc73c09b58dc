"""LSH forest, Merkle manifest and lexical search against brute force, and on odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditmart.llm import forest, lexical, merkle
from creditmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, very long and repeated texts, null ids and languages."""
    rows = [
        (1001, None, "en", "a", 0), (1002, "", None, None, 0), (1003, "  \n\t ", "en", "a", 5), (1004, "word " * 30_000, "en", "a", 1),
        (1004, "word " * 30_000, "en", "a", 1), (1004, "Another text", "en", None, 1), (1005, "x" * 50_000, "zz", "b", 1), (None, "a null id", "en", "b", 1),
        (None, "a null id", "en", "b", 1), (None, "A  Null ID", "", "b", 1), (-6, "12 34 !!", "en", "b", 1), (1 << 60, "É漢字 ΑΣ don't \x1c x_y", "fr", "b", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# LSH forest


def words_of(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_classes(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    top = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = top[i], top[j]
                top = [b if t == a else t for t in top]
    least = {}
    for (d, _), t in zip(rows, top):
        least[t] = min((x for x in (d, least.get(t)) if x is not None), default=None)
    return Counter((d, len(s), least[t], d == least[t]) for (d, _), s, t in zip(rows, sets, top))


def edited(rng, words, share):
    return [rng.choice(words) + "x" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies around the threshold, chains, and many texts that share a long passage but are not alike."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, passage = [], rng.choices(vocabulary, k=60)
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.randint(30, 200))
        rows += [" ".join(edited(rng, base, 0.018)) for _ in range(rng.randint(2, 15))]
    chain = rng.choices(vocabulary, k=120)
    for i in range(25):
        chain = chain[3:] + rng.choices(vocabulary, k=3)
        rows.append(" ".join(chain))
    rows += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(120)]
    rows += [" ".join(passage).upper(), "  " + "\n".join(passage), "two words", "two  WORDS", "two words more"]
    return [(2000 + i, t) for i, t in enumerate(rows)]


def test_forest_equals_brute_force(spark, copies, odd, monkeypatch):
    rows = copies + [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("mine")).withColumn("region", F.lit(1))
    want = plain_classes(rows)
    assert Counter(map(tuple, forest.near_duplicates(frame).collect())) == want
    monkeypatch.setattr(forest, "BLOCK_SETS", 7)  # many blocks to a region, and components that fill blocks of their own
    assert Counter(map(tuple, forest.near_duplicates(frame).collect())) == want


def test_forest_settles_what_neighbours_leave(spark, copies, monkeypatch):
    """Without any candidate from the orders, the regions alone give the same components."""
    frame = spark.createDataFrame(copies, "doc_id long, text string")
    monkeypatch.setattr(forest, "neighbours", lambda met: met.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b")))
    assert Counter(map(tuple, forest.near_duplicates(frame).collect())) == plain_classes(copies)


def test_forest_query_equals_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert Counter(map(tuple, QUERIES["op11_minhash"](spark, SF).collect())) == plain_classes(rows)


def test_forest_on_an_empty_table(spark, empty):
    out = forest.near_duplicates(empty)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0


def test_common_counts(monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_SHINGLES", 5)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(20)]
    got = forest.common_counts(sets[:8], sets[8:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[8:]] for a in sets[:8]]
    assert forest.common_counts([np.array([1], np.uint64)], [np.array([2], np.uint64)]).tolist() == [[0]]


# Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    def leaf(r, text):
        fields = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    def build(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def proof(levels, i):
        out = []
        for nodes in levels[:-1]:
            a = i // 8 * 8
            out.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + 8])))
            i //= 8
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append({**r, "leaf": leaf(r, r["text"])})
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
    trees = {g: build([r["leaf"] for r in groups[g]]) for g in order}
    top = build([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path, text = proof(trees[g], i) + proof(top, k), r["text"]
            if text is not None and zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            acc = leaf(r, text)
            for a, b in path:
                acc = sha(a + acc + b)
            out.append((r["doc_id"], r["leaf"], trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), acc, acc == top[-1][0]))
    return Counter(out)


def manifest_of(spark, frame, tmp_path):
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    return Counter(map(tuple, QUERIES["op12_merkle"](spark, str(tmp_path)).collect()))


def test_manifest_equals_brute_force(spark, docs):
    assert Counter(map(tuple, QUERIES["op12_merkle"](spark, SF).collect())) == plain_manifest([r.asDict() for r in docs.collect()])


def test_manifest_on_odd_rows(spark, docs, odd, tmp_path):
    rows = docs.union(odd.select(docs.columns)).union(odd.select(docs.columns).filter("lang = 'fr'"))
    rows = rows.withColumn("lang", F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("l"), "doc_id")).otherwise(F.col("lang"))).withColumn("grp", F.lit(0)).withColumn("pos", F.lit(1))
    rows = rows.cache()
    assert manifest_of(spark, rows, tmp_path) == plain_manifest([r.asDict() for r in rows.collect()])


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65])
def test_manifest_of_one_group(spark, tmp_path, n):
    rows = spark.createDataFrame([(i * i * 977 - 5000, f"Text {i}", None, "s", i) for i in range(n)], SCHEMA)
    assert manifest_of(spark, rows, tmp_path) == plain_manifest([r.asDict() for r in rows.collect()])


def test_manifest_of_random_ids(spark, tmp_path):
    rng = random.Random(1)
    rows = spark.createDataFrame([(rng.randint(-(1 << 63), (1 << 63) - 1), "T", rng.choice("ab"), "s", i) for i in range(300)], SCHEMA)
    assert manifest_of(spark, rows, tmp_path) == plain_manifest([r.asDict() for r in rows.collect()])


def test_ranks_without_gaps(spark):
    """Ids that repeat are placed by their leaves, and no place is taken twice."""
    rows = [(i % 7 if i % 3 else None, "+a", f"{i % 11:064d}", None) for i in range(200)]
    placed = merkle.placed(spark.createDataFrame(rows, "id long, grp string, leaf string, other string")).orderBy("pos").collect()
    assert [r.pos for r in placed] == list(range(200))
    assert [(r.id, r.leaf) for r in placed] == sorted(((r[0], r[2]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


# Lexical search


def plain_search(docs, items, k=10):
    def terms(text):
        out = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if ord(c) > 127 or c.isalnum() else " " for c in text or "")
        return [t for t in out.split(" ") if t]

    found = [(d, Counter(terms(t))) for d, t in docs]
    n, total = sum(bool(c) for _, c in found), sum(c.total() for _, c in found)
    out = []
    for item, text in set(items):
        scores = []
        for d, c in found:
            score, m = 0, 10 + 90 * c.total() * n // max(total, 1)
            for t in set(terms(text)) & c.keys():
                df = sum(t in x for _, x in found)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(scores[:k])]
    return Counter(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    vocabulary = [f"{'Term' if i % 2 else 'é'}{i}" for i in range(60)]
    docs = [(i, ", ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(150)]
    docs += [(7, docs[7][1]), (None, docs[8][1]), (None, None), (200, "- _ !"), (201, "term1 " * 5000), (202, "unique1"), (203, "UNIQUE1")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25)))) for i in range(40)]
    return docs, items + [(50, None), (51, "!"), (52, "nowhere at all"), (3, items[3][1]), (3, "Term5"), (None, "Term7 Term9"), (53, "unique1 unique1")]


def test_search_equals_brute_force(spark, texts, monkeypatch):
    docs, items = texts
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("item", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("mine"))
    want = plain_search(docs, items)
    assert Counter(map(tuple, lexical.search(d.repartition(3), i, 10).collect())) == want
    monkeypatch.setattr(lexical, "ITEMS", 9)  # several blocks of items
    assert Counter(map(tuple, lexical.search(d, i, 10).collect())) == want
    assert Counter(map(tuple, lexical.search(d, i, 2).collect())) == plain_search(docs, items, 2)
    assert lexical.search(d.limit(0), i, 3).count() == 0 and lexical.search(d, i.limit(0), 3).count() == 0


def test_shared_sums_are_the_items_sums():
    rng = random.Random(3)
    items = [{b"%d" % rng.randint(0, 30) for _ in range(rng.randint(0, 20))} for _ in range(50)]
    plan = lexical.Plan(items)
    values = np.random.default_rng(1).integers(0, 1 << 40, (len(plan.words), 5))
    number = {w: i for i, w in enumerate(plan.words)}
    assert plan.scores(values).tolist() == [values[[number[w] for w in item]].sum(axis=0).tolist() for item in items]
    assert len(plan.pairs) > 1 and sum(map(len, plan.pairs)) + len(plan.refs) < sum(map(len, items))


def test_best_keeps_ties_of_smaller_ids():
    best = lexical.Best(1, 2)
    for ids in ([5, 4], [3, 9], [1, 8]):
        best.add(np.full((1, 2), 7), np.array(ids), np.zeros(2, dtype=np.int64))
        best.merge()
    assert best.held[3].tolist() == [1, 3]


# Near duplicates of the pipeline


def linked_groups(texts, share):
    """Groups of different texts whose sets of five-word shingles are alike to the share or more, through an inverted index."""
    from creditmart.llm.simhash import shingles

    sets, holders, top = [set(shingles(t.encode(), 5)) for t in texts], {}, list(range(len(texts)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, s in enumerate(sets):
        for j, common in Counter(j for x in s for j in holders.get(x, ())).items():
            if common >= share * (len(s) + len(sets[j]) - common):
                top[root(i)] = root(j)
        for x in s:
            holders.setdefault(x, []).append(i)
    return {texts[i]: root(i) for i in range(len(texts))}


def same_groups(got, want):
    """Both put the same texts together."""
    by = {}
    for t, g in want.items():
        by.setdefault(g, set()).add(got.get(t, t))
    return all(len(s) == 1 for s in by.values()) and len({next(iter(s)) for s in by.values()}) == len(by)


@pytest.mark.parametrize("near", [1, 3])
def test_pipeline_groups_equal_brute_force(spark, monkeypatch, near):
    """All groups of the 0.1 documents, however little the first pass links."""
    from creditmart.llm import simhash

    monkeypatch.setattr(simhash, "NEAREST", near)
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    texts = [r.text for r in rows.distinct().collect()]
    named = rows.distinct().select("text", F.xxhash64("text").alias("hash"))
    got = {r.text: r.root for r in named.join(simhash.similar_groups(rows), "hash").collect()}
    assert same_groups(got, linked_groups(texts, 0.8))
    assert len(got) > 50
