"""Registered queries of the operators (one each, over whole tables) and their DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.llm import bpe, embeddings, fillmiddle, htmlcrf, linededup, packing, quality, repeats, secrets, sharding, simhash, urls, whitening
from tripgauge.llm.runtime import small_batches
from tripgauge.session import drop_stages, materialize, table_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


def _joined(spans) -> F.Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("secret_spans", lambda s: s["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in kinds),
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secret_spans")).alias("spans"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only the measures are written between the two passes, not the texts.
    return quality.judge(_read(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


#: FIXED VALUES: the rules of the contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(_read(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM parts, rules
  WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY page_id)
SELECT parts.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN best ON parts.page_id = best.page_id
"""


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(_read(spark, sf_dir, "documents"), _tokenizer_path(), keep=["doc_id"])
    return bpe.decode(encoded, _tokenizer_path()).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmlcrf.extract_main_text(_read(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = packing.pieces(_read(spark, sf_dir, "documents"), _tokenizer_path())
    return packing.pack(items).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    made: list[str] = []
    # Each half is written as its few columns, inside small batches; the tables it was read from go then.
    with small_batches(spark):
        # A further column: words in passages of over 50 words that are also elsewhere; many of those are shorter than 400 bytes.
        held = repeats.passages(docs, made=made).filter("n_passage_words > 0").select("doc_id", "text_hash", "n_passage_words").distinct()
        held = materialize(held, "passage_words")
        drop_stages(spark, made)
        cut = repeats.remove_repeats(docs, made=made).select("doc_id", "text_hash", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
        cut = materialize(cut, "cut_digests")
        drop_stages(spark, made)
    both = cut.join(held, cut["doc_id"].eqNullSafe(held["doc_id"]) & (cut["text_hash"] == held["text_hash"]), "left")
    return both.select(cut["doc_id"], "n_bytes", "n_removed", "n_spans", "kept_sha256", F.coalesce("n_passage_words", F.lit(0)).cast("long").alias("n_passage_words"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, top IS NOT NULL AND doc_id <> top AS gone FROM keyed LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_read(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON e.vec_id = least.vec_id LEFT JOIN counts ON e.vec_id = counts.vec_id
"""


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    placed = sharding.shard_documents(docs.withColumn("text_crc32", crc), 24, keep=["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = fillmiddle.fill_in_middle(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return fillmiddle.restore(moved).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                                            F.sha2("restored", 256).alias("restored_sha256"))


OP12_SQL = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
lines AS (
  SELECT *, string_split(text, chr(10)) AS l, CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4 FROM docs),
counted AS (SELECT *, len(l) - CASE WHEN l[-1] = '' THEN 1 ELSE 0 END AS n FROM lines),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM counted),
places AS (
  SELECT *, least(length(text), a + coalesce(list_sum(list_transform(l[1:a], lambda x: length(x))), 0)) AS p,
         least(length(text), b + coalesce(list_sum(list_transform(l[1:b], lambda x: length(x))), 0)) AS q FROM cuts),
parts AS (
  SELECT *, substr(text, 1, CAST(p AS BIGINT)) AS pre, substr(text, CAST(p AS BIGINT) + 1, CAST(q - p AS BIGINT)) AS mid, substr(text, CAST(q AS BIGINT) + 1) AS suf,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM places)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(p AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(q - p AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                        ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, scale=64, shift=1_000_000, most=32).select(
        "vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")


def queries() -> dict:
    return {"op1_secret_scans": op1_secret_scans, "op2_quality_rules": op2_quality_rules, "op3_url_filters": op3_url_filters, "op4_bpe": op4_bpe, "op5_html_extraction": op5_html_extraction,
            "op6_best_fit_packing": op6_best_fit_packing,
            "op7_suffix_array_dedup": op7_suffix_array_dedup, "op8_simhash_near_dedup": op8_simhash_near_dedup, "op9_line_dedup": op9_line_dedup,
            "op10_embedding_near_dedup": op10_embedding_near_dedup, "op11_sharding": op11_sharding, "op12_fill_in_middle": op12_fill_in_middle,
            "op13_embedding_whitening": op13_embedding_whitening}


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filters": OP3_SQL, "op9_line_dedup": OP9_SQL, "op10_embedding_near_dedup": OP10_SQL,
            "op12_fill_in_middle": OP12_SQL}
