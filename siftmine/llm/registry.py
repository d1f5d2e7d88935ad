"""The operators as queries over whole tables, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmine.llm import byte_bpe, exact_dedup, exact_topk, language_id, license_scan, mixing, near_dedup, packing
from siftmine.llm import quality, ranked_search, resampling, sharding, token_counts
from siftmine.sources.readers import read_table as table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SHARDS = 8


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_exact_topk(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return exact_topk.top_k(vectors, F.col("vec_id") % 100 == 0)


@query
def op2_language_id(spark, folder):
    docs = table(spark, folder, "documents").withColumn("held_out", language_id.held_out())
    model = language_id.fit(docs.filter("not held_out"))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query
def op3_exact_dedup(spark, folder):
    return exact_dedup.deduplicate(table(spark, folder, "documents"))


@query
def op4_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, table(spark, folder, "labels"))
    return judged.select("doc_id", "lang", "perplexity", "max_perplexity", "kept")


@query
def op5_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op6_source_mix(spark, folder):
    order = mixing.mix_order(table(spark, folder, "documents"))
    return order.withColumn("rate", F.round("rate", 9))


@query
def op7_near_duplicates(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


@query
def op8_uniform_shards(spark, folder):
    docs = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", mixing.document_size(F.col("text")).alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.uniform_shards(rows, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_best_fit_packing(spark, folder):
    pieces = packing.token_pieces(table(spark, folder, "documents"))
    digested = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digested, ["doc_id", "piece"])


@query
def op10_license_scan(spark, folder):
    found = license_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", *[c.alias(n) for n, c in license_scan.label_columns().items()])


@query
def op11_ranked_search(spark, folder):
    index = ranked_search.build_index(table(spark, folder, "documents"))
    return ranked_search.search(index, table(spark, folder, "benchmark")).drop("item")


@query
def op12_byte_bpe(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = byte_bpe.decode(byte_bpe.encode(docs))
    shown = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(shown, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_target_resampling(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    gain = resampling.gains(docs, table(spark, folder, "benchmark"))
    drawn = resampling.draw(resampling.weigh(docs, gain).drop("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE: dict[str, str] = {
    "op1_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, vec_id, score,
               row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
        FROM s QUALIFY rank <= 10
    """,
    "op3_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, h AS text_sha256
        FROM d WINDOW g AS (PARTITION BY h)
    """,
    "op6_source_mix": f"""
        WITH d AS (
            SELECT doc_id, source, coalesce(strlen(text), 0) + 1 AS size,
                   (('0x' || substr(md5('{mixing.SEED}|' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE)
                       / 4503599627370496::DOUBLE AS u
            FROM documents
        ),
        s AS (SELECT source, sum(size)::DOUBLE AS size FROM d GROUP BY source),
        t AS (SELECT sum(size) AS size, sum(pow(size, {mixing.TEMPERATURE})) AS weight FROM s),
        r AS (
            SELECT source, t.size / t.weight * pow(s.size, {mixing.TEMPERATURE}) / s.size AS rate FROM s, t
        ),
        p AS (
            SELECT source, rate, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1)))
                       OVER (PARTITION BY source ORDER BY k) AS at_most
            FROM r, (SELECT unnest(range(0, 200)) AS k)
            WHERE k <= ceil(rate + 12 * sqrt(rate) + 40)
        ),
        c AS (
            SELECT doc_id, d.source, any_value(rate) AS rate, count(*) FILTER (at_most < u) AS copies
            FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source GROUP BY doc_id, d.source
        ),
        e AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM c)
        SELECT doc_id, source, round(rate, 9) AS rate, copies::INT AS copies, copy::INT AS copy,
               row_number() OVER (ORDER BY md5('{mixing.SEED + 1}|' || doc_id || '|' || copy), doc_id, copy) - 1
                   AS position
        FROM e
    """,
    "op11_ranked_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents WHERE doc_id IS NOT NULL
        ),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
        cells AS (
            SELECT doc_id, term, count(*) AS tf FROM words
            WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
        ),
        weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM cells, total GROUP BY term, docs
        ),
        scored AS (
            SELECT item_id, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN cells USING (term) JOIN sizes USING (doc_id), total
            GROUP BY item_id, doc_id
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 50
    """,
}
