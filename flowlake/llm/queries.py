"""The operators as queries on whole tables. ``SQL`` holds their oracle texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.llm import (
    bpe, chat, decontamination, divergence, interpolation, language, licenses, merkle, near_dups, outliers, site_style, token_counts,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_offset_attribution(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document, encoded as whole documents."""
    return token_counts.section_counts(table(spark, folder, "documents").select("doc_id", "text"), BYTE_RANKS)


@query
def op2_perspective_rotation(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation from the perspective of each of its speakers."""
    found = chat.perspectives(table(spark, folder, "conversations"))
    spans = F.transform("mask", lambda m: F.concat(m["start"], F.lit("-"), m["end"]))
    return found.withColumn("mask", F.concat_ws(",", spans))


SQL["op2_perspective_rotation"] = f"""
WITH turns AS (
  SELECT conv_id, coalesce(CAST(floor(turn / {chat.SEGMENT}.0) AS BIGINT), -1) AS segment, turn, coalesce(role, 'unknown') AS role,
    replace(coalesce(text, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10) AS body, coalesce(text, '') AS text
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role <> 'system'),
pieces AS (
  SELECT t.conv_id, t.segment, s.perspective, t.turn, t.role, t.text, t.body, t.role = s.perspective AS own,
    '<|im_start|>' || CASE WHEN t.role = s.perspective THEN 'assistant' WHEN t.role = 'system' THEN 'system' ELSE 'user name=' || t.role END || chr(10) AS head
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, row_number() OVER w AS k, CAST(sum(length(head) + length(body)) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM pieces WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY segment, turn NULLS FIRST, role, text))
SELECT conv_id, perspective, segment, CAST(min(upto - length(head) - length(body)) AS BIGINT) AS start, CAST(count(*) AS INTEGER) AS n_turns, string_agg(head || body, '' ORDER BY k) AS text,
  coalesce(string_agg(CAST(upto - length(body) AS VARCHAR) || '-' || CAST(upto - 1 AS VARCHAR), ',' ORDER BY k) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, segment, perspective
"""


@query
def op3_segmentation_unigrams(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = language.fit(docs.filter(~held_out), "text", "lang", PIECES)
    found = language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op4_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules, and outliers per language and source under robust covariances."""
    return outliers.judge(table(spark, folder, "documents"))


@query
def op5_bottom_k_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are equal to 85 per cent."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = near_dups.near_duplicates(docs, size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


@query
def op6_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows of ten words in every document, from a stored positional index."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op7_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a bigram model, learned from four fifths of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    found = interpolation.score_documents(docs, "doc_id", "text", ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op8_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, and decoded from its ids."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, BYTE_BPE)
    return both.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op9_positional_rare_words(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels"), "score",
    )


@query
def op10_site_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = site_style.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


#: Site rules of the URL query (fixed values of its contract), and words in names of sites whose URLs are listed.
RULES = [
    url_filters.Rule("block", "net"), url_filters.Rule("allow", "example.net", "/en/"),
    url_filters.Rule("block", "example.com", "/de/"), url_filters.Rule("allow", "org", "/fr/"),
]
LISTED_SITES = "(^|[.-])(adult|casino|pills|spam)([.-]|\\z)"


@query
def op11_blocked_bloom(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL judged by the rules, else by the list: the URLs of sites with a word of ``LISTED_SITES`` in their name."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    host, _ = url_filters.host_and_path(F.col("url"))
    listed = pages.filter(host.rlike(LISTED_SITES)).select("url")
    found = url_filters.judge(pages, listed, RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "canonical_url", "listed")


def replaced(value: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        value = f"regexp_replace({value}, '{pattern}', '{to}', 'g')"
    return value


SQL["op11_blocked_bloom"] = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id, rest, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{url_filters.UPPER}', '{url_filters.LOWER}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
forms AS (
  SELECT page_id, host, path, {replaced("host", url_filters.HOST_STEPS)} AS site, {replaced("path", url_filters.PATH_STEPS)} AS place,
    list_sort(list_filter(string_split(coalesce(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), ''), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '{url_filters.TRACKING}'))) AS given
  FROM parts),
canon AS (
  SELECT page_id, host, path,
    CASE WHEN site <> '' THEN site || place || CASE WHEN len(given) > 0 THEN '?' || array_to_string(given, '&') ELSE '' END END AS canonical_url
  FROM forms),
listed AS (SELECT DISTINCT canonical_url FROM canon WHERE regexp_matches(host, '{LISTED_SITES}')),
rules(verdict, rule, rhost, rpath) AS (
  VALUES {", ".join(f"('{r.verdict}', '{r.name}', '{r.host}', '{r.path}')" for r in RULES)}),
ruled AS (
  SELECT c.*, (SELECT struct_pack(rule := r.rule, verdict := r.verdict) FROM rules r
    WHERE (c.host = r.rhost OR ends_with(c.host, '.' || r.rhost)) AND starts_with(c.path, r.rpath)
    ORDER BY length(r.rule) DESC, r.verdict DESC, r.rule LIMIT 1) AS found
  FROM canon c)
SELECT r.page_id, r.host, r.path, r.found.rule AS rule,
  coalesce(r.found.verdict, CASE WHEN l.canonical_url IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
  r.canonical_url, l.canonical_url IS NOT NULL AS listed
FROM ruled r LEFT JOIN listed l ON r.canonical_url = l.canonical_url
"""


@query
def op12_run_length_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Differences of every two sources of a language, and each source's most overused terms."""
    return divergence.audit(table(spark, folder, "documents").select("lang", "source", "text"))


SQL["op12_run_length_audit"] = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
single AS (SELECT d, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM single GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
langs AS (SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM single JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counted c USING (lang, source) GROUP BY g.lang, g.source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (l.n + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(v.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) v
  ON v.lang = a.lang AND v.source = a.source AND v.other = b.source),
terms AS (SELECT lang, source, term AS item, CAST(p - q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q),
found AS (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms),
placed AS (
  SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM placed WHERE part = 'pair' OR rank <= 50
"""


@query
def op13_slot_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of all documents; where 2 divides the id's crc32, the text is presented without its line feeds."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    leaf = lambda text: merkle.digest(*[merkle.field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)])
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False)) & F.col("text").contains("\n")
    shown = F.when(tampered, leaf(F.replace("text", F.lit("\n"), F.lit(""))))
    return merkle.manifest(docs, "source", "doc_id", leaf(F.col("text")), shown)


#: One step of the shift register of crc32, and eight of them.
_SHIFT = "CASE WHEN {c} & 1 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"

SQL["op13_slot_pivot"] = f"""
WITH RECURSIVE register AS (
  SELECT i AS entry, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT entry, {_SHIFT.format(c="c")}, k + 1 FROM register WHERE k < 8),
steps AS (SELECT list(c ORDER BY entry) AS after FROM register WHERE k = 8),
docs AS (
  SELECT doc_id, source, replace(text, chr(10), '') AS cut, text,
    coalesce(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(a >> 8, after[CAST(1 + (xor(a, b) & 255) AS BIGINT)])) & 1 = 1, false) AS tampered,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents, steps),
leaves AS (
  SELECT doc_id, source, leaf, CASE WHEN tampered AND text IS NOT NULL THEN sha256(head || strlen(cut) || ':' || cut) ELSE leaf END AS shown,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf FROM docs)),
lower AS (
  SELECT source, 0 AS level, pos, leaf AS hash, n FROM leaves
  UNION ALL SELECT source, level + 1, pos // 3, sha256(string_agg(hash, '' ORDER BY pos)), any_value((n + 2) // 3)
  FROM lower WHERE n > 1 GROUP BY source, level, pos // 3),
subroots AS (
  SELECT source, level, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lower WHERE n = 1),
upper AS (
  SELECT 0 AS level, pos, hash, n FROM subroots
  UNION ALL SELECT level + 1, pos // 3, sha256(string_agg(hash, '' ORDER BY pos)), any_value((n + 2) // 3)
  FROM upper WHERE n > 1 GROUP BY level, pos // 3),
nodes AS (
  SELECT 'l' AS part, source, level, pos, hash, n FROM lower UNION ALL SELECT 'u', NULL, level, pos, hash, n FROM upper),
beside AS (
  SELECT a.part, a.source, a.level, a.pos, coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
    coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS behind
  FROM nodes a JOIN nodes b ON a.part = b.part AND a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY a.part, a.source, a.level, a.pos),
climb AS (
  SELECT l.doc_id, l.source, l.leaf, s.hash AS subroot, s.pos AS top, l.pos AS start, 'l' AS part, 0 AS level, l.pos, l.n, l.shown AS folded, '' AS proof
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT c.doc_id, c.source, c.leaf, c.subroot, c.top, c.start,
    CASE WHEN c.n = 1 THEN 'u' ELSE c.part END, CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.n = 1 THEN c.top ELSE c.pos // 3 END, CASE WHEN c.n = 1 THEN (SELECT max(n) FROM subroots) ELSE (c.n + 2) // 3 END,
    CASE WHEN c.n = 1 THEN c.folded ELSE sha256(b.before || c.folded || b.behind) END,
    CASE WHEN c.n = 1 THEN c.proof ELSE c.proof || b.before || b.behind END
  FROM climb c LEFT JOIN beside b
    ON c.part = b.part AND (c.part = 'u' OR c.source IS NOT DISTINCT FROM b.source) AND c.level = b.level AND c.pos = b.pos
  WHERE c.n > 1 OR c.part = 'l')
SELECT c.doc_id, c.leaf, c.subroot, u.hash AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = u.hash AS verified
FROM climb c CROSS JOIN (SELECT hash FROM upper WHERE n = 1) u WHERE c.part = 'u' AND c.n = 1
"""
