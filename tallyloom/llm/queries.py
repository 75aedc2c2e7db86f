"""Named queries over the training-data operators, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import chunked_bpe, divergence, exact, minhash, packing, periodic, planes, rlz, simhash, sketches, suffixes, toxicity, warc
from tallyloom.sources.shared import shared_path


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.dedup(_table(spark, folder, "documents"))


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    planes.write_tokens(_table(spark, folder, "documents"), path, vocabulary("byte_bpe_50k.json"))
    read = planes.read_documents(spark, path).select("doc_id", "shard", "first", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return read.join(planes.shard_starts(spark, path), "shard").select("doc_id", (F.col("first") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def archive(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "archive")
    warc.write_archive(_table(spark, folder, "pages"), path)
    return warc.parsed(warc.read_records(spark, path))


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(_table(spark, folder, "documents"))


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = rlz.removed(_table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def encoded_and_decoded(spark: SparkSession, folder: str) -> DataFrame:
    out = chunked_bpe.encode_decode(_table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def toxic_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.scores(docs, toxicity.learn_without_held_out(docs, _table(spark, folder, "labels")))


def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.removed(_table(spark, folder, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.fingerprints(_table(spark, folder, "documents")).drop("sketch", "edited_sketch")


def source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


def periodic_columns(docs: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of the runs of documents, of which a tenth gets a periodic end."""
    found = periodic.collapsed(docs, rewrite=periodic.planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    out = found.withColumns({"top": longest, "length": -longest["less"]})
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "length",
        "top.period",
        F.call_function("div", 1000 * F.col("length"), F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_columns(_table(spark, folder, "documents"))


def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(_table(spark, folder, "documents"))


QUERIES = {
    "op1_packing": packed_sequences,
    "op2_exact_dedup": exact_dedup,
    "op3_simhash": near_dedup,
    "op4_substring_dedup": substring_dedup,
    "op5_token_files": token_files,
    "op6_bpe": encoded_and_decoded,
    "op7_warc": archive,
    "op8_toxicity": toxic_scores,
    "op9_suffix_dedup": suffix_dedup,
    "op10_fingerprints": document_fingerprints,
    "op11_divergence": source_divergence,
    "op12_periodic_runs": periodic_runs,
    "op13_minhash": near_copies,
}

SQL = {
    "op2_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n""",
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS n FROM pages),
             w AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS win FROM p)
        SELECT page_id, n AS payload_bytes, sha1(t) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> win THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> win THEN win END AS refers_to
        FROM w""",
    "op11_divergence": """
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
             t AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
             kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
             c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
             g AS (SELECT DISTINCT lang, source FROM d),
             f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN kept k ON k.lang = g.lang
                   LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
             p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p FROM f WINDOW w AS (PARTITION BY lang, source)),
             l AS (SELECT lang, term, sum(n) AS n FROM f GROUP BY lang, term),
             q AS (SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS q FROM l WINDOW w AS (PARTITION BY lang)),
             b AS (SELECT a.lang, a.source AS x, b.source AS y, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY 1, 2, 3),
             pairs AS (SELECT a.lang, a.source, 'pair' AS part, o.source AS item, coalesce(b.value, 0) AS value FROM g a JOIN g o ON o.lang = a.lang AND o.source <> a.source
                       LEFT JOIN b ON b.lang = a.lang AND b.x = a.source AND b.y = o.source),
             terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
             ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
