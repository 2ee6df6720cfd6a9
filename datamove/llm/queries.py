"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from datamove.llm import bpe, decontaminate, hard_negatives, html_text, language, licenses, near_sets, neighbours, pieces, quality, target, toxicity, urlfilter
from datamove.llm.arrow import fold


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), ["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = fold("doc_id") != 1
    model = toxicity.learn_toxicity(docs.where(learnt), _read(spark, sf_dir, "labels").where(learnt))
    scored = toxicity.score_toxicity(docs, model, ["doc_id"])
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the addresses that pages of several spellings lead to, as crawlers meet them without end."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    address = urlfilter.canonical(*urlfilter.url_parts(F.col("url")))
    spelled = pages.groupBy(address.alias("address")).agg(F.min("url").alias("url"), F.max("url").alias("other"))
    return urlfilter.judge_urls(pages, spelled.where("address IS NOT NULL AND url <> other"), ["page_id"])


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_sets.near_copies(_read(spark, sf_dir, "documents"), shingle=3, threshold=0.9)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(_read(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def tokenized(docs: DataFrame, keep: list[str]) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode_texts(docs, keep, ranks=ranks, pattern=public_tokenizers.PATTERN)
    decoded = bpe.decode_ids(encoded, [*keep, "ids"], ranks=ranks)
    return decoded.select(
        *keep,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized(_read(spark, sf_dir, "documents"), ["doc_id"])


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_read(spark, sf_dir, "documents"), ["doc_id"])
    return found.withColumns({c: F.concat_ws(",", c) for c in ("base_labels", "labels")}).drop("matches")


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn_languages(docs.where(fold("doc_id") != 1))
    told = language.tell_languages(docs, model, ["doc_id"])
    return told.select("doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.resample(docs, _read(spark, sf_dir, "labels"), ["doc_id"])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


def op12_target_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target.resample_to(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = pieces.encode_pieces(_read(spark, sf_dir, "documents"), ["doc_id"], model=model)
    spanned = F.aggregate(F.zip_with("starts", "ends", lambda x, y: y - x), F.lit(0).cast("long"), lambda total, n: total + n)
    digests = encoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        spanned.alias("n_spanned"),
    )
    decoded = pieces.decode_pieces(digests, ["doc_id", "n_tokens", "ids_sha256", "n_spanned"], model=model)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "n_spanned")


_ALL = (
    op1_decontaminate,
    op2_toxicity,
    op3_url_filter,
    op4_ngram_jaccard,
    op5_html_text,
    op6_bpe,
    op7_neighbours,
    op8_license_scan,
    op9_language_mixture,
    op10_importance_resample,
    op11_hard_negatives,
    op12_target_resample,
    op13_sentencepiece,
)

QUERIES = {f.__name__: f for f in _ALL}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = _LOWER.format("coalesce(text, '')")
_ALNUM = rf"regexp_extract_all({_TEXT}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
# crc32 of a word: a register of 32 bits, moved on by each byte through a table made here.
_CRC_STEP = "list_reduce(range(8), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, {})"
_CRC = (
    "xor(4294967295, list_reduce(list_transform(range(1, len(hex(encode({0}))) // 2 + 1),"
    " lambda i: CAST('0x' || substr(hex(encode({0})), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT)),"
    " lambda r, b: xor(r >> 8, crc_table[(xor(r, b) & 255) + 1]), CAST(4294967295 AS BIGINT)))"
)
_SOLID = rf"regexp_extract_all({_TEXT}, '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op1_decontaminate": f"""
        WITH items AS (SELECT item_id, {_ALNUM} AS w FROM benchmark WHERE item_id IS NOT NULL),
        docs AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
        sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item_id, n, w[i:i + n - 1] AS part FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
        places AS (
            SELECT r, n, i, w[i:i + n - 1] AS part
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)),
        hits AS (SELECT r, i, n, item_id FROM places JOIN windows USING (n, part)),
        covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
        named AS (
            SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
    """,
    "op3_url_filter": rf"""
        WITH p AS (
            SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        s AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS front FROM p),
        h AS (
            SELECT page_id, {_LOWER.format('front')} AS host, regexp_extract(substr(rest, length(front) + 1), '^[^?#]*') AS path FROM s),
        r AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
                CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') END AS canonical
            FROM h),
        listed AS (SELECT canonical FROM r JOIN pages USING (page_id) WHERE canonical IS NOT NULL GROUP BY canonical HAVING min(url) <> max(url))
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
        FROM r
    """,
    "op4_ngram_jaccard": f"""
        WITH RECURSIVE docs AS (SELECT doc_id, {_SOLID} AS w FROM documents),
        sets AS (
            SELECT doc_id, unnest(list_distinct(CASE
                WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
            FROM docs),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT doc_id, y FROM reached JOIN both_ways ON other = x)
        SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
        FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
        placed AS (
            SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
            FROM positives JOIN scored USING (anchor_id)
            WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM placed WHERE rank <= 3
    """,
    "op12_target_resample": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
        words AS (SELECT r, unnest(w) AS word FROM docs),
        aims AS (SELECT unnest({_ALNUM}) AS word FROM benchmark),
        tables AS (SELECT list_transform(range(256), lambda b: {_CRC_STEP.format('CAST(b AS BIGINT)')}) AS crc_table),
        named AS (
            SELECT word, {_CRC.format('word')} % 10000 AS bucket
            FROM (SELECT word FROM words UNION SELECT word FROM aims) CROSS JOIN tables),
        source AS (SELECT bucket, count(*) AS s FROM words JOIN named USING (word) GROUP BY bucket),
        target AS (SELECT bucket, count(*) AS t FROM aims JOIN named USING (word) GROUP BY bucket),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln(
                CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM words) + 10000)
                / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM aims) + 10000)))) AS BIGINT) AS gain
            FROM source FULL JOIN target USING (bucket)),
        sums AS (SELECT r, count(*) AS n, sum(gain) AS total FROM words JOIN named USING (word) JOIN gains USING (bucket) GROUP BY r),
        scored AS (
            SELECT r, doc_id, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT) ELSE 0 END AS weight,
                   CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS noise
            FROM docs LEFT JOIN sums USING (r)),
        placed AS (
            SELECT r, row_number() OVER (ORDER BY weight + noise DESC, doc_id, n_features) AS place, count(*) OVER () AS many
            FROM scored WHERE n_features >= 20 AND doc_id IS NOT NULL)
        SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN place <= many * 10 // 100 THEN place END AS rank
        FROM scored LEFT JOIN placed USING (r)
    """,
}
