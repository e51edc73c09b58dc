"""The text operators against brute force, and on nulls, empty and long texts, ties, repeated rows and clashing columns."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditmart.llm import bpe, components, decontam, langid, licenses, linededup, lm, quality, sharding, simhash, topk
from creditmart.llm.queries import BPE_FILE, PIECE_FILE

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, very long and repeated texts, null ids, and no letters."""
    rows = [
        (1, None, "en", "a", 0), (2, "", None, None, 0), (3, "  \n\t ", "en", "a", 5), (4, "word " * 30_000, "en", "a", 1),
        (4, "word " * 30_000, "en", "a", 1), (5, "x" * 50_000, "en", "b", 1), (None, "a null id", "en", "b", 1),
        (None, "a null id", "en", "b", 1), (6, "12 34 !!", "en", "b", 1), (7, "É漢字 <|endoftext|> ΑΣ don't \x1c x", "fr", "b", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# BPE


def test_bpe_equals_the_library(docs, odd):
    library = Tokenizer.from_file(BPE_FILE)
    for frame in (docs, odd):
        for r in bpe.round_trip(frame, BPE_FILE).collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            assert np.frombuffer(r.ids, dtype="<u4").tolist() == ids and r.n_tokens == len(ids)
            assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_on_random_strings():
    library, own = Tokenizer.from_file(BPE_FILE), bpe.Vocabulary.load(BPE_FILE)
    rng = np.random.default_rng(3)
    signs = np.array(list("abAB'stre12３²½ \n\t\x1c\x85　éÉßΣσİ!#<|>漢́👍🏽한") + ["<|startoftext|>", "<|endoftext|>", "'ll"])
    texts = ["".join(rng.choice(signs, rng.integers(0, 50))) for _ in range(2000)] + ["a" * 5000, "ab" * 3000]
    packed = own.encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_bpe_empty_table_and_clashing_columns(spark, empty):
    assert bpe.round_trip(empty, BPE_FILE).count() == 0
    clash = spark.createDataFrame([("hi", "mine", 7)], "text string, ids string, other int")
    row = bpe.decode(bpe.encode(clash, BPE_FILE), BPE_FILE).first()
    assert row.other == 7 and row.decoded == "hi</w>" and len(row.ids) == 4


def test_bpe_memory_stays_small_with_many_different_words():
    library, own = Tokenizer.from_file(BPE_FILE), bpe.Vocabulary.load(BPE_FILE)
    words = ["".join(w) + str(n) for n, w in enumerate(np.random.default_rng(3).choice(list("abcdefghij"), (200_000, 7)))]
    texts = [" ".join(words[a : a + 1000]) for a in range(0, len(words), 1000)]
    texts += texts[:2]  # forgotten by now
    tracemalloc.start()
    packed = own.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6 and len(own.remembered) <= bpe.REMEMBERED
    for t, p in [*zip(texts, packed)][::40] + [*zip(texts, packed)][-2:]:
        assert np.frombuffer(p, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


# Language


def test_language_forward_sums_all_segmentations():
    model = langid.Pieces(langid.Index.of(["▁a", "b", "ab", "▁ab", "c", "bc"]), ["x"], np.zeros((8, 1)))
    model.table[:, 0] = [0, 1e-9, 0.1, 0.2, 0.05, 0.15, 0.3, 0.02]
    expected = 0.1 * 0.2 * 0.3 + 0.15 * 0.3 + 0.1 * 0.02
    assert np.exp(model.log_probabilities(["abc"])[0, 0]) == pytest.approx(expected)
    uses = model.expected(["abc"], np.array([0]), np.array([1.0]))
    assert uses[2] == pytest.approx((0.1 * 0.2 * 0.3 + 0.1 * 0.02) / expected)
    assert langid.runs("ab½c") == ["ab", "c"] and langid.runs("½²") == [] and langid.runs("a_b1é") == ["a", "b", "é"]


def test_language_held_out_and_undetermined(docs, odd, empty):
    pieces = langid.read_pieces(PIECE_FILE)
    model = langid.fit(docs.filter("doc_id % 3 <> 1"), pieces)
    right = langid.predict(docs.filter("doc_id % 3 = 1"), model).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    found = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(odd, model).collect()]
    assert all((g == "und") == (s == 0.0) == (i in (1, 2, 3, 6)) and 0 <= s <= 1 for i, g, s in found)
    assert langid.predict(empty, model).count() == 0
    nothing = langid.fit(empty, pieces)
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}


# Quality


def test_quality_ranks_held_out_documents(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(["the", "house", "river", "walks"], 40)) if i % 4 else "### $$$ buy " * 20, int(i % 4 > 0)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.learn(frame.select("doc_id", "text"), frame.filter("doc_id % 5 > 0").select("doc_id", "quality"))
    scored = quality.score(frame.filter("doc_id % 5 = 0"), model).collect()
    assert all(r.predicted == r.quality == int(r.score >= 0.3) for r in scored)


def test_quality_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (4, None), (None, 0), (5, 0), (99, 1)], "doc_id long, quality int")
    model = quality.learn(odd, labels)
    assert all(0 <= r.score <= 1 for r in quality.score(odd, model).collect())
    alone = quality.learn(empty, labels)
    assert all(r.score == pytest.approx(0.3) for r in quality.score(odd, alone).collect())
    assert quality.score(empty, model).count() == 0


# SimHash


def plain_fingerprint(text):
    words = text.encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hashes) * 2 > len(hashes))


def plain_components(numbers, linked):
    root = {n: n for n in numbers}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_simhash_classes_equal_brute_force(spark, docs):
    prints = {r.doc_id: r.fp for r in simhash.fingerprints(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert all(v & (2**64 - 1) == plain_fingerprint(texts[i]) for i, v in prints.items())
    rng = np.random.default_rng(2)
    fps = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 40)]
    fps += [f ^ (1 << int(rng.integers(0, 63))) for f in fps for _ in range(3)] + fps[:10]
    fps += [fps[0] ^ sum(1 << 2 * j for j in range(k)) for k in range(1, 20)]  # a chain of single steps
    frame = spark.createDataFrame(list(enumerate(fps)), "doc_id long, fp long")
    linked = [(i, j) for i in range(len(fps)) for j in range(i) if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= 2]
    assert {r.doc_id: r.component_id for r in simhash.classes(frame).collect()} == plain_components(range(len(fps)), linked)


def test_simhash_odd_rows(odd, empty):
    got = simhash.classes(simhash.fingerprints(odd)).collect()
    assert len(got) == 10 and {r.component_id for r in got if r.fp == 0} == {1}
    assert simhash.classes(simhash.fingerprints(empty)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    roots = {r.node: r.root for r in components.components(edges).collect()}
    assert all(roots[i] == 0 for i in range(301)) and roots[1001] == 1000


def test_components_of_a_path_in_random_order(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "stored_at", lambda df, store=components.stored_at: written.append(1) or store(df))
    at = np.random.default_rng(8).permutation(2_000)
    edges = spark.createDataFrame(list(zip(at[:-1].tolist(), at[1:].tolist())), "a long, b long")
    assert {(r.node, r.root) for r in components.components(edges).collect()} == {(n, 0) for n in range(2_000)}
    assert len(written) < 2 * 15  # two tables a round
    assert components.components(edges.limit(0)).count() == 0


def test_keep_one_of_each_group(spark, odd):
    rng = np.random.default_rng(4)
    make = lambda: ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    rows, base = [], make()
    for i in range(12):  # near copies: two words changed, still alike to 0.8 or more
        words = list(base)
        for _ in range(2):
            words[int(rng.integers(0, 300))] = "changed%d" % i
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(base)) for i in range(5)] + [(200 + i, " ".join(make())) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_one(frame).collect()} == {0, *range(200, 220)}
    kept = simhash.keep_one(odd.withColumn("text_hash", F.lit(1)).withColumn("place", F.lit(2)))
    assert kept.columns == [*odd.columns, "text_hash", "place"]
    assert sorted(kept.select(F.coalesce("doc_id", F.lit(-1))).toPandas().iloc[:, 0]) == [-1, 1, 4, 5, 6, 7]


def test_similarity_near_the_threshold_is_exact(spark):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 7))
    rows, jaccard = [], {}
    for n in range(120):  # pairs of texts on both sides of 0.8
        one = [word() for _ in range(250)]
        other = list(one)
        for at in rng.choice(250, int(rng.integers(3, 12)), replace=False):
            other[at] = word()
        texts = [" ".join(t) for t in (one, other)]
        a, b = (set(simhash.shingles(t.encode(), 5)) for t in texts)
        jaccard[2 * n + 1] = len(a & b) / len(a | b)
        rows += [(2 * n, texts[0]), (2 * n + 1, texts[1])]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert kept >= {2 * n for n in range(120)} | {i for i, s in jaccard.items() if s < 0.8}
    alike = {i for i, s in jaccard.items() if s >= 0.8}
    assert 20 < len(alike) < 100 and len(alike & kept) <= 0.03 * len(alike)


def test_block_edits_are_met(spark):
    """Passages appended, cut off at the end or exchanged, so that 0.8 to 0.9 of the shingles are shared."""
    rng = np.random.default_rng(7)
    some = lambda n: ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]
    rows, jaccard, kinds = [], {}, ("appended", "cut", "exchanged")
    for n in range(240):
        one, share = some(int(rng.integers(60, 300))), rng.uniform(0.81, 0.9)
        size = len(one)
        other = {"appended": one + some(int(size / share) - size), "cut": one[: int(np.ceil(size * share)) + 1]}.get(kinds[n % 3])
        if other is None:
            gone = int(size * (1 - share) / (1 + share)) - 3
            other = one[:20] + some(max(1, gone)) + one[20 + max(1, gone) :]
        texts = [" ".join(t) for t in (one, other)]
        a, b = (set(simhash.shingles(t.encode(), 5)) for t in texts)
        jaccard[2 * n + 1] = len(a & b) / len(a | b)
        rows += [(2 * n, texts[0]), (2 * n + 1, texts[1])]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert kept >= {2 * n for n in range(240)} | {i for i, s in jaccard.items() if s < 0.8}
    for k in range(3):
        alike = {i for i, s in jaccard.items() if s >= 0.8 and i // 2 % 3 == k}
        assert len(alike) > 50 and len(alike & kept) <= 0.03 * len(alike), kinds[k]


def test_links_beyond_the_first_checks_are_settled(spark):
    """A text that is like one member of a group only, while all the others are just below the threshold."""
    rng = np.random.default_rng(9)
    some = lambda n: ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]
    rows = []
    for n in range(24):
        base, block = some(400), some(42)
        texts = [base[:100] + block[:39] + base[139:]]  # shingles alike to 0.804
        for i in range(14):  # to 0.792
            own = list(block)
            own[3 + i] = some(1)[0]
            texts.append(base[:100] + own + base[142:])
        texts.append(base)
        rows += [(100 * n + i, " ".join(t)) for i, t in enumerate(texts)]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert kept == {100 * n for n in range(24)}


def test_second_pass_compares_blocks_all_with_all():
    rng = np.random.default_rng(10)
    longs = rng.integers(0, 2**63, (8, simhash.LONG_WORDS), dtype=np.uint64)
    longs[5:] = longs[:3]  # texts 5, 6, 7 surely like 0, 1, 2
    ids, keys, roots = np.arange(8), np.full(8, 77), np.array([0, 1, 2, 3, 4, 5, 6, 2])
    pairs = lambda second: {(int(a[0]), int(b[0]), s) for a, b, s in simhash.apart(ids, keys, roots, longs, second, 77, 0.8)}
    assert pairs(np.zeros(8, dtype=bool)) == pairs(ids > 4) == {(0, 5, True), (1, 6, True)}
    assert pairs(ids > 5) == {(1, 6, True)}


# Decontamination

ITEM = "A farmer named Anders sells 12 kg of apples to Maria and keeps 5 kg for the winter while the rest of the 12 kg harvest goes to the old mill near the river"


def test_decontamination_of_copies_and_new_parameters(spark):
    other = "completely different words about ships sailing over calm water towards harbours where lamps burn all night long"
    filled = ITEM.replace("Anders", "Tomas").replace("Maria", "Elena").replace("12", "30").replace("5", "7")
    broken = "A farmer named Anders sells 1 kg of apples to Maria and keeps 2 kg for the winter while the rest of the 3 kg harvest goes to the old mill near the river"
    rows = [(1, other), (2, f"{other} {ITEM} {other}"), (3, filled), (4, ITEM.upper()), (5, broken), (6, None), (7, ""), (None, ITEM), (2, f"{other} {ITEM} {other}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bad_id", F.lit(3))
    bench = spark.createDataFrame([(9, ITEM), (10, "short one here"), (11, None), (12, "")], "item_id long, text string")
    found = decontam.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} >= {(2, 9), (3, 9), (4, 9), (None, 9)}
    whole = {r.doc_id: r.covered for r in found.filter("item_id = 9").collect()}
    assert whole[3] == 1.0 and whole.get(5, 0) < whole[3]  # 12 becomes 1 here and 3 there
    clean = decontam.clean(docs, bench)
    assert clean.columns == docs.columns and {1, 6, 7} <= {r.doc_id for r in clean.collect()} and 2 not in {r.doc_id for r in clean.collect()}
    assert decontam.contaminated(docs.limit(0), bench).count() == 0 and decontam.clean(docs, bench.limit(0)).count() == 9


def test_decontamination_drops_conflicting_windows_only(spark):
    altered = ITEM.replace("the 12 kg harvest", "the 99 kg harvest")
    merged = ITEM.replace("5 kg", "12 kg")
    rest = " while all of them wait near the old mill for rain and talk about the long road home in autumn"
    starts = "The farmer sells apples near the mill. The winter is long over there. The river" + rest
    docs = spark.createDataFrame([(1, altered), (2, merged), (3, starts.replace("The winter", "Every winter")), (4, rest)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, ITEM), (10, starts)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.covered for r in decontam.contaminated(docs, bench).collect()}
    assert {(1, 9), (2, 9), (3, 10)} <= found.keys() and all(found[k] < 1 for k in ((1, 9), (2, 9), (3, 10)))
    windows = [(0, ["a"], ["x"]), (1, ["a"], ["x"]), (2, ["a"], ["y"]), (3, ["b"], ["x"]), (4, ["c"], ["c"]), (5, [], [])]
    assert decontam.consistent(windows) == [0, 1, 4, 5]


def test_decontamination_of_items_full_of_slots(spark):
    title = "The Old Man And The Sea Was Written By Ernest Hemingway In Cuba While He Lived Near Havana With Many Cats"
    sums = "Add 3 4 15 9 2 6 5 35 8 97 93 23 84 62 64 33 83 27 95 total"
    names = "Anna Berg met Carl Dorn and Emil Falk with Gerd Hahn near Ines Jung or Karl Lang by Maja Nord"
    other = "Add 1 2 33 4 5 6 7 88 9 10 11 12 13 14 15 16 17 18 19 total"
    bench = spark.createDataFrame(list(enumerate((title, sums, names))), "item_id int, text string")
    docs = spark.createDataFrame(list(enumerate((title, sums, names, other, title.lower()))), "doc_id int, text string")
    found = {(r.doc_id, r.item_id): r.covered for r in decontam.contaminated(docs, bench).collect()}
    assert found == {(0, 0): 1.0, (1, 1): 1.0, (2, 2): 1.0, (4, 0): 1.0}


def test_decontamination_without_sent_hashes(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    usual = {tuple(r) for r in decontam.contaminated(docs, bench).collect()}
    monkeypatch.setattr(decontam, "SENT_UP_TO", 10)
    assert {tuple(r) for r in decontam.contaminated(docs, bench).collect()} == usual != set()


# Sharding


def test_shards_hold_all_records_once(spark, docs, odd, tmp_path):
    rows = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    written = sharding.write(rows, str(tmp_path / "s"), 7, bucket_bytes=20_000)
    out = sharding.slots(written).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(map(tuple, rows.collect()))
    for shard in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    moved = rows.select(sharding.shard_of(F.col("doc_id"), 7).alias("a"), sharding.shard_of(F.col("doc_id"), 8).alias("b")).collect()
    assert all(r.a == r.b or r.b == 7 for r in moved) and any(r.b == 7 for r in moved)
    again = sharding.slots(sharding.write(rows, str(tmp_path / "t"), 7, bucket_bytes=20_000)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    for n in (1, 5):  # neither the input's order nor its partitions matter
        other = rows.orderBy(F.rand(n)).repartition(n)
        dealt = sharding.slots(sharding.write(other, str(tmp_path / f"n{n}"), 7, bucket_bytes=20_000)).collect()
        assert Counter((r.shard, r.slot, r.doc_id, r.text) for r in dealt) == Counter((r.shard, r.slot, r.doc_id, r.text) for r in out)
    clash = rows.withColumns({"shard": F.lit("mine"), "Bucket": F.lit(1), "slot": F.lit(2)})
    kept = sharding.in_shared_folder(clash, 7, bucket_bytes=20_000)
    assert set(kept.columns) == {"doc_id", "text", "shard", "Bucket", "slot", "shard_", "bucket_", "slot_"}
    assert kept.count() == rows.count() and {r.shard for r in kept.collect()} == {"mine"}
    assert sharding.slots(sharding.write(rows.limit(0), str(tmp_path / "v"), 7)).count() == 0


def test_fisher_yates_is_uniform():
    rng, seen = np.random.default_rng(0), Counter()
    for _ in range(6000):
        x = np.arange(3)
        sharding.fisher_yates(x, rng)
        seen[tuple(x)] += 1
    assert len(seen) == 6 and min(seen.values()) > 850


# Search


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 37)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(5)
    vectors = [[float(x) for x in rng.integers(-2, 3, 6) / 4] for _ in range(200)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(500, None), (501, [None, 1.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (None, vectors[0]), (7, vectors[7]), (504, [1.0] * 3), (505, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("vec_id", topk.quantized(F.col("embedding")).alias("weights"))
    got = topk.search(frame, frame.filter("vec_id % 20 = 0"), 10).collect()
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for q, v in whole:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:10]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.search(frame, frame.limit(0), 10).count() == 0 and topk.search(frame.limit(0), frame, 10).count() == 0


# Lines


def test_lines_over_the_ratio_go(spark):
    rows = [(i, "h" if i < 10 else None, f"menu\nown line {i}\n \n menu \nfooter {i % 2}") for i in range(14)] + [(20, "h", None), (21, "h", "")]
    pages = spark.createDataFrame(rows, "id long, host string, text string").withColumn("page_key", F.lit(1))
    out = {r.id: r for r in linededup.drop_boilerplate(pages, "id", "host", "text", 0.5, 3).collect()}
    assert out[3].text == "own line 3\n \nfooter 1" and (out[3].n_lines, out[3].n_dropped) == (4, 2)
    assert out[12].text == "own line 12\n \nfooter 0" and out[20].text is None and out[21].text == ""
    whole = {r.id: r for r in linededup.drop_boilerplate(pages, "id", "host", "text", 0.5, 3, most=0.1).collect()}
    assert whole[3].text == rows[3][2] and whole[3].n_dropped == 0
    assert linededup.drop_boilerplate(pages.limit(0), "id", "host", "text").count() == 0
    assert "Python" not in linededup.drop_boilerplate(pages, "id", "host", "text")._jdf.queryExecution().executedPlan().toString()


def test_pages_of_boilerplate_only_stay_whole(spark):
    rows = [(i, "h", "menu\nfooter\nown %d" % i) for i in range(9)] + [(9, "h", "menu\n\nfooter")]
    pages = spark.createDataFrame(rows, "id long, host string, text string")
    out = {r.id: r for r in linededup.drop_boilerplate(pages, "id", "host", "text", 0.5, 3, whole=True).collect()}
    assert out[3].text == "own 3" and out[9].text == "menu\n\nfooter" and out[9].n_dropped == 0
    assert {r.text for r in linededup.drop_boilerplate(pages, "id", "host", "text", 0.5, 3).filter("id = 9").collect()} == {""}


# Licences


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    joined = " " + "".join(w + " " for w in words)
    starts, base = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        found = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        starts += found
        base |= {label} if found else set()
    places = {(m.start(), m.end(), rank, label) for label, _, rank, rule in licenses.rules() for m in re.finditer(licenses.bounded(rule), joined)}
    kept = {p for p in places if not any(o != p and o[0] <= p[0] and p[1] <= o[1] and (o[2] < p[2] or o[2] == p[2] and (o[0], o[1]) != (p[0], p[1])) for o in places)}
    first = {}
    for p in sorted(kept):  # of one place and rank, the first label counts
        first.setdefault(p[:3], p[3])
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(first.values())))


def test_licences_equal_brute_force(spark, docs, odd, empty):
    texts = [
        "Licensed under the Apache License, Version 2.0 or CC BY-NC-SA 4.0; released under the MIT License.", "under the mit license under the MIT license",
        "GNU General Public License, version 3 or later", "GNU Lesser General Public License v2.1", "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "mit license style, bsd 3 clause license; the artistic license 2.0", "All rights reserved. Copyright (c) 2019 2020", "cc by nc cc by nc cc by nc", "no licence at all", "Creative Commons Attribution-NonCommercial 4.0 International License",
    ]
    texts += ["released under the Expat License", "X Consortium License", "Q Public License version 1.0", "Creative Commons Zero", "public domain and mit license " * 700]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    frame = docs.select("doc_id", "text").union(odd.select("doc_id", "text")).union(extra).withColumn("scan_n", F.lit(1)).withColumn("labels", F.lit("mine"))
    for r in licenses.scan(frame).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == plain_scan(r.text), r.text[:100]
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert licenses.scan(empty).count() == 0
    assert "Python" not in licenses.scan(frame)._jdf.queryExecution().executedPlan().toString()


def branches(parsed):
    """Texts of a parsed expression: each alternative of every choice at least once, with and without what is optional."""
    from re import _constants as k

    out = [""]
    for op, arg in parsed:
        if op is k.LITERAL:
            one = [chr(arg)]
        elif op is k.IN:
            first = arg[0]
            one = [chr(first[1] if first[0] is k.LITERAL else first[1][0])]
        elif op is k.BRANCH:
            one = [t for b in arg[1] for t in branches(b)]
        elif op is k.SUBPATTERN:
            one = branches(arg[3])
        elif op in (k.MAX_REPEAT, k.MIN_REPEAT):
            low, _, body = arg
            one = [t * max(low, 1) for t in branches(body)] + [""] * (low == 0)
        else:
            raise AssertionError(op)
        wide = [a + b for a in out[:1] for b in one] + [a + one[0] for a in out[1:]] + [a + one[-1] for a in out]
        out = list(dict.fromkeys(wide))
    return out


def test_every_alternative_holds_its_key():
    for label, key, _, rule in licenses.rules():
        if key == "cc by" or key == "creative commons":
            continue  # one rule, listed under both of its keys
        for text in branches(re._parser.parse(rule)):
            assert re.fullmatch(rule, text) and key in f" {text} ", (label, key, text)
            assert any(c in f" {text} " for c in licenses.COMMON_KEYS), (label, text)
    keyless = [t for _, k, _, r in licenses.rules() if k == "cc by" for t in branches(re._parser.parse(r)) if not ("cc by" in t or "creative commons" in t)]
    assert keyless == []


@pytest.mark.parametrize("text, label", [("released under the Expat License", "mit"), ("X Consortium License", "x11"), ("Q Public License version 1.0", "qpl-1.0"), ("Creative Commons Zero", "cc0")])
def test_alternatives_pass_the_prefilter(spark, text, label):
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert label in row.labels.split(",") and row.score > 0


def test_every_rule_is_behind_the_prefilter():
    table = licenses.rules()
    assert len(table) > 200 and {r for _, _, r, _ in table} == {0, 1, 2}
    for _, key, _, rule in table:
        assert "licen" in rule and ")?" not in rule.split(licenses.WORD_LICENSE)[-1][:2] or any(c.strip() in key for c in licenses.COMMON_KEYS), rule


# Language model


def test_lm_learns_and_scores(spark, docs, odd, empty):
    network = lm.fit(docs)
    scored = lm.score(docs, network).collect()
    fresh = lm.score(docs, lm.Network.new(network.words)).collect()
    assert sum(r.log_probability for r in scored) > 0.85 * sum(r.log_probability for r in fresh)
    assert all(r.n_tokens == len(r.text.split()) for r in scored)
    got = lm.score(odd, network).collect()
    assert all(r.log_probability == 0 and r.perplexity == 1 for r in got if r.doc_id in (1, 2, 3))
    assert lm.score(empty, lm.fit(empty)).count() == 0


def test_lm_scores_every_word_by_its_own_share(spark, docs):
    """Made-up words are less likely than real ones; sent and joined counts give the same scores, those of the formula."""
    rng = np.random.default_rng(3)
    made = [(i, " ".join("".join(rng.choice(list("qxzjk"), 7)) for _ in range(60))) for i in range(40)]
    strings = spark.createDataFrame(made + [(-1, None)], "doc_id long, text string")
    scores = []
    for sent in (lm.SENT, 300, 0):
        network = lm.fit(docs, sent=sent)
        assert (network.words.more is None) == (sent == lm.SENT)
        real = {r.doc_id: r for r in lm.score(docs, network).collect()}
        assert min(r.perplexity for r in lm.score(strings, network).collect() if r.n_tokens) > np.quantile([r.perplexity for r in real.values()], 0.95)
        scores.append({i: r.log_probability for i, r in real.items()})
    assert scores[1] == pytest.approx(scores[0], rel=1e-3) and scores[2] == pytest.approx(scores[0], rel=1e-3)
    texts = {r.doc_id: r.text.lower().split() for r in docs.collect()}
    n = Counter(w for t in texts.values() for w in t)
    group = {w: xxhash.xxh64_intdigest(w.encode(), 42) % lm.GROUPS for w in n}
    total = Counter()
    for w in set(n) - set(network.words):
        total[group[w]] += n[w]
    number = {w: i for i, w in enumerate(network.words)}
    for i in list(texts)[:20]:
        tokens = np.array([number.get(w, lm.TOKENS - lm.GROUPS + group[w]) for w in texts[i]], dtype=np.int32)
        shares = sum(np.log(n[w] / (total[group[w]] + 1)) for w in texts[i] if w not in number)
        assert scores[2][i] == pytest.approx(network.log_probabilities(*network.windows([tokens])).sum() + shares, rel=1e-5)


def test_lm_gradient():
    rng = np.random.default_rng(0)
    net = lm.Network.new(["a", "b"])
    net.table = net.table.astype(np.float64)
    context, target = net.windows([rng.integers(0, lm.TOKENS, 50).astype(np.int32)])
    before = net.log_probabilities(context, target).sum()
    moved = lm.Network(net.words, net.table.copy())
    moved.train(context, target, np.zeros(lm.ROWS), 0.05)
    assert moved.log_probabilities(context, target).sum() > before
    # each token's probabilities sum up to one
    total = sum(np.exp(net.log_probabilities(context[:1], np.array([t]))[0]) for t in range(lm.TOKENS))
    assert total == pytest.approx(1, abs=1e-4)


def test_quality_learns_from_text_ids(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    plain = quality.learn(docs, labels)
    named = quality.learn(docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), labels.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))
    a, b = ({r.doc_id: r.score for r in quality.score(docs, m).collect()} for m in (plain, named))
    assert max(abs(a[i] - b[i]) for i in a) < 0.2


def test_quality_learns_from_all_labelled_pairs(spark):
    """Loss and gradient are those of all pairs made one by one, and the threshold parts as many rows as have label 0."""
    rng = np.random.default_rng(1)
    texts = [(i, " ".join(rng.choice(["a", "of", "Word", "42", "!!", "longer"], rng.integers(1, 40)))) for i in range(300)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(len(t) + 40 * rng.normal() > 60)) for i, t in texts], "doc_id long, quality int")
    model = quality.learn(frame, labels)
    label = np.array([r.quality for r in labels.collect()])
    x = quality.matrix([t.encode() for _, t in texts])
    raised = quality._raised(x, model.steps)
    of_labels = [x, x[label == (0 if 2 * label.sum() > len(label) else 1)]]
    cuts = np.concatenate([np.quantile(v, np.linspace(0, 1, quality.STEPS + 1), axis=0).T for v in of_labels], axis=1)
    assert model.steps == pytest.approx(np.sort(cuts, axis=1))
    stored = spark.createDataFrame([(v.tolist(), int(n)) for v, n in zip(x, label)], "x array<double>, label int")
    pairs = quality.Pairs(stored, model.steps, 1e-3)

    def brute(w):
        difference = (raised[label == 1][:, None] - raised[label == 0][None]).reshape(-1, len(w))
        z = difference @ w
        return np.logaddexp(0, -z).mean() + 5e-4 * w @ w, -(difference / (1 + np.exp(z))[:, None]).mean(axis=0) + 1e-3 * w

    for w in (model.weights, rng.normal(0, 0.2, len(model.weights))):
        spread = pairs.spread(w)
        loss, gradient = brute(w)
        assert pairs.loss(w, spread) == pytest.approx(loss, abs=1e-5)
        assert pairs.gradient(w, spread) == pytest.approx(gradient, abs=1e-5)
    assert np.linalg.norm(brute(model.weights)[1]) < 0.01
    assert (model.strength(x) <= model.cut).sum() == (label == 0).sum()
