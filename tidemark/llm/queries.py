"""The operators as queries over the supplied tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, langid, merkle, mixing, perfect_hash, quality, shared_search, simhash, suffix, token_counts, topk, warc


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies on this machine; every machine of the cluster has it there."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer products of every 20th vector with all others."""
    scaled = F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("double"))
    # floor() of what is not finite is a number: such components stay as they are, for the operator to refuse.
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.when(~odd, scaled).alias("embedding"))
    found = topk.top_products(vectors, vectors.where("vec_id % 20 = 0"), k=20)
    return found.withColumn("score", F.col("score").cast("long"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every text, over the pieces of a public vocabulary."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_path("piece_bpe_32k.model"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two bits or fewer."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_components(docs, shingle=3, max_bits=2).select("doc_id", "fingerprint", "component_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes outside all repeated 200-byte strings, as counts and a digest."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.digests(suffix.remove_repeats(docs, length=200))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages, learnt from three quarters of the documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out")
    folded = docs.select("*", held_out)
    model = langid.train(folded.where(~F.col("held_out")))
    found = langid.identify(folded.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through seekable bundles and back."""
    back = warc.round_trip(_table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document; sources weigh 1, 2, 3, repeating."""
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.round("mix_target", 6).alias("target"),
        F.col("mix_taken").alias("taken"),
    )


def quality_fold() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learnt from two thirds of the labels."""
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~quality_fold()))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", quality_fold().alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_label").alias("predicted")
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text and their decoding, as counts and digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json"), digests_only=True)


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found of every 100th vector."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(ann.build_index(vectors), vectors.where("vec_id % 100 = 0"), k=10)


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are the same but for A-Z: the row with the largest id stays."""
    found = perfect_hash.exact_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proof for every document; where 2 divides the checksum of the id, the text has lost its line feeds."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(_table(spark, sf_dir, "documents"), tampered, F.replace("text", F.lit("\n"), F.lit("")))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return shared_search.search(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    f.__name__: f
    for f in (
        op1_topk,
        op2_token_counts,
        op3_simhash,
        op4_suffix_dedup,
        op5_language,
        op6_warc,
        op7_mixing,
        op8_quality,
        op9_bpe,
        op10_ann,
        op11_exact,
        op12_merkle,
        op13_search,
    )
}

ORACLE = {
    "op1_topk": """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), products AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(generate_series(1, len(q.e)), lambda i: q.e[i] * c.e[i])) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM products
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 20
""",
    "op7_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1 AS rk
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(rk % 3 + 1 AS DOUBLE) AS w, 3.0 * CAST(source_size AS DOUBLE) AS stop FROM ranked
), leveled AS (
  SELECT *, stop / w AS ratio,
         (sum(source_size) OVER () - coalesce(sum(stop) OVER (ORDER BY stop / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY stop / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM weighed
), targets AS (
  SELECT source, source_size, least(stop, w * (SELECT arg_min(lev, rk + ratio * 0) FILTER (WHERE lev <= ratio AND ratio = m)
         FROM leveled, (SELECT min(ratio) AS m FROM leveled WHERE lev <= ratio))) AS target
  FROM leveled
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(least(size, greatest(0, floor(target - o))) + least(size, greatest(0, floor(target - o - source_size)))
            + least(size, greatest(0, floor(target - o - 2 * source_size))) AS BIGINT) AS taken
FROM placed
""",
    "op11_exact": """
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, h AS text_sha256
FROM hashed
""",
    "op12_merkle": r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text, replace(text, chr(10), '') AS cut,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         -- CRC-32, bit by bit
         list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
           lambda x, b: list_reduce([xor(x, b)] || [0, 0, 0, 0, 0, 0, 0, 0],
             lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)) % 2 = 1 AS even
  FROM documents
), leaves AS (
  SELECT doc_id, even, coalesce('=' || source, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) AS other
  FROM fields
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, idx, n, leaf AS digest FROM numbered
  UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 3, n
), subroots AS (
  SELECT tree, level AS low, digest, row_number() OVER (ORDER BY tree COLLATE "binary") - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, place AS idx, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 3, n
), every AS (
  SELECT tree, level, idx, digest FROM nodes WHERE n > 1
  UNION ALL
  SELECT s.tree, t.level + s.low, t.idx, t.digest FROM subroots s, tops t WHERE t.n > 1
), steps AS (
  SELECT o.tree, o.level, o.idx, coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx < o.idx), '') AS l,
         coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx > o.idx), '') AS r
  FROM every o JOIN every s ON s.tree = o.tree AND s.level = o.level AND s.idx // 3 = o.idx // 3 GROUP BY 1, 2, 3
), up AS (
  SELECT d.tree, d.idx AS leaf_idx, 0 AS level, CASE WHEN s.low = 0 THEN s.place ELSE d.idx END AS idx, '' AS proof,
         CASE WHEN d.even THEN d.other ELSE d.leaf END AS folded
  FROM numbered d JOIN subroots s USING (tree)
  UNION ALL
  SELECT u.tree, u.leaf_idx, u.level + 1, CASE WHEN u.level + 1 = h.low THEN h.place ELSE u.idx // 3 END,
         u.proof || s.l || s.r, sha256(s.l || u.folded || s.r)
  FROM up u JOIN steps s ON s.tree = u.tree AND s.level = u.level AND s.idx = u.idx JOIN subroots h ON h.tree = u.tree
), root AS (
  SELECT digest, level FROM tops WHERE n = 1
)
SELECT d.doc_id, d.leaf, s.digest AS subroot, root.digest AS root, sha256(u.proof) AS proof_sha256, u.folded AS folded_root,
       u.folded = root.digest AS verified
FROM numbered d JOIN subroots s USING (tree) JOIN root ON true
JOIN up u ON u.tree = d.tree AND u.leaf_idx = d.idx AND u.level = s.low + root.level
""",
    "op13_search": r"""
WITH found AS (
  SELECT doc_id, row_number() OVER () AS d,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), docs AS (
  SELECT d, doc_id, CAST(len(t) AS BIGINT) AS n, t FROM found WHERE len(t) > 0
), total AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM docs
), postings AS (
  SELECT d, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, unnest(t) AS term FROM docs) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * (SELECT docs FROM total) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings GROUP BY term
), items AS (
  SELECT row_number() OVER () AS i, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), asked AS (
  SELECT i, item_id, term, CAST(count(*) AS BIGINT) AS times FROM (SELECT i, item_id, unnest(t) AS term FROM items) GROUP BY ALL
), scored AS (
  SELECT a.i, a.item_id, x.d, d.doc_id,
         CAST(sum(a.times * w.w * ((1000000000 * x.tf) // (1000 * x.tf + 8 * (25 + (75 * d.n * (SELECT docs FROM total)) // (SELECT words FROM total))))) AS BIGINT) AS score
  FROM asked a JOIN weights w USING (term) JOIN postings x USING (term) JOIN docs d USING (d) GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
