"""Registered queries of the text operators, one per operator, over whole
tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    bag_search,
    bpe,
    decontaminate,
    html_extract,
    licenses,
    line_dedup,
    lm_scoring,
    near_dedup,
    quality,
    repeats,
    url_rules,
    warc,
    whitening,
)
from salesmart.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Rules of the url query: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pre_token_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@register("op1_lm_scoring")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@register("op2_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer("byte_bpe_50k.tiktoken"), pre_token_pattern()
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern)
    return bpe.decode(encoded, ranks, pattern).select(
        "doc_id", "n_tokens",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op3_url_filters", r"""
    WITH parts AS (
      SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
      FROM pages),
    split AS (
      SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
      FROM parts),
    rules(rule_verdict, rhost, rpath) AS (VALUES
      ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
      ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
    SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
    FROM split LEFT JOIN LATERAL (
      SELECT rhost || rpath AS rule, rule_verdict FROM rules
      WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      ORDER BY length(rhost || rpath) DESC LIMIT 1) ON true
""")
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def contamination_digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        F.expr("n_hit > 0 and 20 * n_hit >= n_words").alias("contaminated"))


@register("op4_decontamination", r"""
    WITH d AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
    b AS (
      SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
    win AS (
      SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
      FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS t(i) WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT n FROM win),
    hit AS (
      SELECT doc_id, i, win.n, item_id
      FROM d, sizes, unnest(range(1, len(w) - sizes.n + 2)) AS t(i)
      JOIN win ON win.n = sizes.n AND win.s = array_to_string(w[i:i + sizes.n - 1], ' ')),
    covered AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
    items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return contamination_digest(found)


@register("op6_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min(F.col("phrases.first_word")).alias("first_word"),
        F.array_max(F.col("phrases.first_word")).alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels"), "score")


@register("op10_quality_rules")
def quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "rules.*")


@register("op7_near_dedup", r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
      FROM documents),
    s AS (
      SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS k1, md5_number_lower(array_to_string(w[i:i + 4], ' ')) AS k2
      FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    links AS MATERIALIZED (
      SELECT a.doc_id AS a, b.doc_id AS b
      FROM s a JOIN s b ON a.k1 = b.k1 AND a.k2 = b.k2 AND a.doc_id <> b.doc_id
      JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
    reach AS (
      SELECT doc_id AS node, doc_id AS root FROM n
      UNION
      SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node WHERE reach.root < links.b)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id,
           d.doc_id = coalesce(r.root, d.doc_id) AS kept
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) r ON r.node = d.doc_id
""")
def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@register("op8_warc", r"""
    WITH p AS (
      SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex FROM pages),
    digit AS (
      SELECT page_id, octet_length(body) AS n, hex, max(page_id) OVER (PARTITION BY hex) AS last,
             list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               CAST((CAST('0x' || substr(hex, 5 * (k // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31 AS BIGINT) + 1, 1)) AS letters
      FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, array_to_string(letters, '') AS payload_digest,
           CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> last THEN last END AS refers_to
    FROM digit
""")
def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), target)
    return warc.read_warc(spark, target).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op9_line_dedup")
def line_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "lines.n_lines", "lines.n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@register("op5_suffix_dedup", r"""
    WITH d AS (
      SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    block AS (
      SELECT doc_id, base, substr(h, 2 * base + 1, 2 * (512 + 49)) AS part
      FROM d, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 49, 512)) AS b(base)),
    win AS (
      SELECT doc_id, base + j AS i, hash(substr(part, 2 * j + 1, 100)) AS k1, md5_number_lower(substr(part, 2 * j + 1, 100)) AS k2
      FROM block, unnest(range(0, least(512, CAST(length(part) / 2 AS BIGINT) - 49))) AS w(j)),
    low AS (SELECT k1, k2, min(doc_id) AS first_doc FROM win GROUP BY k1, k2 HAVING min(doc_id) < max(doc_id)),
    hit AS (
      SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
      FROM win JOIN low USING (k1, k2) WHERE doc_id > first_doc),
    runs AS (
      SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END)
               OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
    spans AS (SELECT doc_id, min(i) AS s, max(i) + 50 AS e FROM runs GROUP BY doc_id, run),
    edges AS (
      SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS kept_from,
             lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS next FROM spans),
    parts AS (
      SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last,
             string_agg(substr(h, 2 * kept_from + 1, 2 * (s - kept_from)), '' ORDER BY s) AS head
      FROM edges JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
           sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN parts USING (doc_id)
""")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.find_repeats(table(spark, sf_dir, "documents"))
    return repeats.remove_repeats(found).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op12_lexical_search", r"""
    WITH d AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
    q AS (
      SELECT item_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term FROM benchmark),
    totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
    factor AS (
      SELECT doc_id, w, 25 + (75 * CAST(len(w) AS BIGINT) * docs) // terms AS m FROM d, totals WHERE len(w) > 0),
    tf AS (
      SELECT doc_id, m, term, CAST(count(*) AS BIGINT) AS n
      FROM (SELECT doc_id, m, unnest(w) AS term FROM factor) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    weight AS (
      SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, totals GROUP BY term, docs),
    scored AS (
      SELECT item_id, doc_id, CAST(sum(weight.w * ((1000000000 * n) // (1000 * n + 8 * m))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN weight USING (term) GROUP BY item_id, doc_id)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
          FROM scored WHERE score > 0)
    WHERE rank <= 10
""")
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register("op11_html_extraction")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))
