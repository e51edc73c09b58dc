"""The operators as named queries over the given tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.llm import bpe, decontam, forest, langid, lexical, licenses, linededup, lm, merkle, quality, sharding, simhash, topk
from creditmart.llm.common import remainder, stored, table

#: Where the vocabulary files lie; read on the driver only.
BPE_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 40
LINE_RATIO, LINE_PAGES = 0.3, 3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), BPE_FILE)
    return docs.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query()
def op2_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, lm.fit(docs), keep_text=False)


@query()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.filter(~held_out), langid.read_pieces(PIECE_FILE))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = quality.learn(docs, labels.filter(~held_out))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stored(simhash.fingerprints(table(spark, sf_dir, "documents")))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return simhash.classes(prints).select("doc_id", hexed.alias("fingerprint"), "component_id")


@query()
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "covered")


@query()
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sharding.in_shared_folder(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
    return records.select(
        "doc_id",
        sharding.size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.shard_of(F.col("doc_id"), SHARDS + 1).alias("grown_shard"),
    )


@query(
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
    ), r AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
    )
    SELECT * FROM r WHERE rank <= 10
    """
)
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantized(F.col("embedding")).alias("weights"))
    return topk.search(rows, rows.filter(F.col("vec_id") % 100 == 0), 10)


@query(
    rf"""
    WITH p AS (
        SELECT page_id, lower(regexp_extract(url, '{linededup.HOST}', 1)) AS host,
            regexp_replace(regexp_replace(regexp_replace(html, '{linededup.HIDDEN}', ' ', 'g'), '{linededup.BLOCKS}', chr(10), 'g'), '{linededup.TAGS}', '', 'g') AS t
        FROM pages
    ), e AS (
        SELECT page_id, host, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t FROM p
    ), x AS (
        SELECT page_id, host, string_split(trim(regexp_replace(regexp_replace(t, '[ \t\r\f]{{2,}}|[\t\r\f]', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)), chr(10)) AS lines FROM e
    ), l AS (
        SELECT page_id, host, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM x
    ), c AS (
        SELECT host, trim(line) AS line, count(DISTINCT page_id) AS n FROM l WHERE trim(line) <> '' GROUP BY ALL
    ), h AS (SELECT host, count(*) AS pages FROM x GROUP BY host),
    b AS (SELECT c.host, c.line FROM c JOIN h USING (host) WHERE n > pages * {LINE_RATIO} AND n >= {LINE_PAGES})
    SELECT l.page_id, l.host, coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE b.line IS NULL), '') AS text,
        count(*) FILTER (WHERE trim(l.line) <> '') AS n_lines, count(*) FILTER (WHERE b.line IS NOT NULL) AS n_dropped
    FROM l LEFT JOIN b ON l.host = b.host AND trim(l.line) = b.line GROUP BY l.page_id, l.host
    """
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", linededup.host_of(F.col("url")).alias("host"), linededup.text_of(F.col("html")).alias("text"))
    pages = stored(pages)  # three passes read the text, and taking it out of the markup is most of the work
    return linededup.drop_boilerplate(pages, "page_id", "host", "text", LINE_RATIO, LINE_PAGES)


@query()
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query()
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "documents"), 85)


@query()
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(remainder(F.col("doc_id"), 3) == 0, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))
    fields = {**{c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars")}, "text": tampered}
    return merkle.manifest(docs, fields).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query(
    rf"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
            regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents WHERE text IS NOT NULL
    ), t AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0),
    i AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), p AS (
        SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
        WHERE term IN (SELECT term FROM i) GROUP BY ALL
    ), w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, t GROUP BY term, docs),
    c AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))) AS part FROM p JOIN w USING (term), t),
    s AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM i JOIN c USING (term) GROUP BY ALL HAVING sum(part) > 0),
    k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s)
    SELECT * FROM k WHERE rank <= 10
    """
)
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return lexical.search(docs, items, 10)
