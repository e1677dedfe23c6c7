"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lexical_search
from .conversation_trie import prefix_trie, rebuild
from .decontaminate import build_index, search
from .embedding_dedup import near_duplicate_vectors
from .html_extraction import extract
from .language_id import document_evidence, fit, identify, page_evidence
from .line_dedup import remove_boilerplate
from .minhash_dedup import near_duplicates
from .packing import pack
from .token_counts import edit_aware_counts
from .token_ids import token_ids
from .url_filter import host_of, judge, path_of
from .warc import archive_pages

#: The rules of the URL filter query.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_aware_counts(_read(spark, sf_dir, "documents"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(_read(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, pages = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "pages")
    model = fit(documents)
    found = identify(document_evidence(documents), model).dropDuplicates(["key"])
    named = documents.select("doc_id", F.lit(None).cast("long").alias("page_id"), F.xxhash64("doc_id", "lang", "source", "text").alias("key"))
    keyed = pages.withColumn("row", F.xxhash64("page_id", "url", "html"))
    found_pages = identify(page_evidence(keyed, "row"), model).dropDuplicates(["key"])
    named_pages = keyed.select(F.lit(None).cast("long").alias("doc_id"), "page_id", F.col("row").alias("key"))
    return named.join(found, "key").unionByName(named_pages.join(found_pages, "key")).drop("key")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(page_evidence(_read(spark, sf_dir, "pages")), fit(_read(spark, sf_dir, "documents")))
    return found.withColumnRenamed("key", "page_id")


def blocked_keys(pages: DataFrame) -> DataFrame:
    """The block list of the query: an eighth of all hosts and a sixteenth of all addresses, by the first digit of their MD5."""
    rows = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("host <> ''")
    digit = lambda c: F.substring(F.md5(c), 1, 1)
    hosts = rows.where(digit(F.col("host")).isin("0", "1")).select(F.col("host").alias("key"))
    whole = rows.select(F.concat("host", "path").alias("key"))
    return hosts.unionByName(whole.where(digit(F.col("key")) == "0")).distinct()


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return judge(pages, URL_RULES, blocked_keys(pages))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = remove_boilerplate(_read(spark, sf_dir, "documents"))
    return clean.select("doc_id", "lines_before", "lines_removed", F.length("text").cast("long").alias("chars_after"), F.md5("text").alias("text_md5"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_read(spark, sf_dir, "documents")).drop("ids")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_read(spark, sf_dir, "embeddings"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(build_index(_read(spark, sf_dir, "documents")), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_pages(_read(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), width=4)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuild(_read(spark, sf_dir, "conversations")))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_read(spark, sf_dir, "pages"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(lexical_search.build_index(_read(spark, sf_dir, "documents")), _read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_token_ids": op2_token_ids,
    "op3_language_id": op3_language_id,
    "op4_url_filter": op4_url_filter,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_html_extraction": op12_html_extraction,
    "op13_lexical_search": op13_lexical_search,
    "language_id_pages": language_id_pages,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_RULES = ", ".join(f"('{kind}', '{rule.split('/', 1)[0]}', '/{rule.split('/', 1)[1]}', '{rule}')" for kind, rule in URL_RULES)

ORACLE_SQL: dict[str, str] = {
    "op4_url_filter": f"""
WITH p AS (
  SELECT page_id,
         CASE WHEN position('://' IN url) > 0 THEN translate(regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*'), '{_UPPER}', '{_LOWER}') ELSE '' END AS host,
         CASE WHEN position('://' IN url) > 0 THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(kind, owner, below, rule) AS (VALUES {_RULES}),
keys AS (
  SELECT page_id, unnest(list_distinct(list_append([array_to_string(labels[i:], '.') FOR i IN range(1, len(labels) + 1)], host || path))) AS key
  FROM (SELECT *, string_split(host, '.') AS labels FROM p WHERE host <> '')),
blocked AS (
  SELECT host AS key FROM p WHERE host <> '' AND substr(md5(host), 1, 1) IN ('0', '1')
  UNION SELECT host || path FROM p WHERE host <> '' AND substr(md5(host || path), 1, 1) = '0'),
fit AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(kind, length(rule)) AS kind
  FROM p JOIN rules ON (host = owner OR ends_with(host, '.' || owner)) AND starts_with(path, below)
  GROUP BY page_id),
hit AS (SELECT DISTINCT page_id FROM keys SEMI JOIN blocked USING (key))
SELECT p.page_id, host, path, fit.rule, coalesce(kind, CASE WHEN hit.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict, hit.page_id IS NOT NULL AS listed
FROM p LEFT JOIN fit USING (page_id) LEFT JOIN hit USING (page_id)""",
    "op5_line_dedup": """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
bad AS (
  SELECT trim(line) AS line FROM lines WHERE trim(line) <> '' GROUP BY trim(line) HAVING count(DISTINCT source) >= 10),
kept AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (bad.line IS NOT NULL) AS removed,
         coalesce(string_agg(lines.line, chr(10) ORDER BY place) FILTER (bad.line IS NULL), '') AS text
  FROM lines LEFT JOIN bad ON trim(lines.line) = bad.line GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS lines_before, coalesce(removed, 0) AS lines_removed,
       CAST(length(CASE WHEN d.text IS NULL THEN NULL ELSE kept.text END) AS BIGINT) AS chars_after,
       md5(CASE WHEN d.text IS NULL THEN NULL ELSE kept.text END) AS text_md5
FROM documents d LEFT JOIN kept USING (doc_id)""",
    "op7_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op8_decontamination": f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT item, array_to_string(w[i:i + 9], ' ') AS win, least(10, len(w)) AS k
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
runs AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, sizes WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, runs.k, item FROM runs JOIN win ON runs.win = win.win AND runs.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op9_warc": f"""
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
       array_to_string([{" || ".join(f"substr('{_BASE32}', CAST((v >> {bits}) & 31 AS INT) + 1, 1)" for bits in (15, 10, 5, 0))}
                        FOR v IN [CAST('0x' || substr(digest, 5 * g + 1, 5) AS BIGINT) FOR g IN range(8)]], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f""",
    "op10_minhash_dedup": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM d JOIN comp ON comp.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op11_conversation_trie": """
WITH tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                                          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), tab),
parts AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND pos < h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND pos >= h),
seqs AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, pos) AS s FROM parts GROUP BY conv_id),
full_seqs AS (SELECT conv_id, coalesce(s, []) AS s FROM convs LEFT JOIN seqs USING (conv_id)),
members AS (SELECT conv_id, d AS depth, s[1:d] AS pre, len(s) = d AS ends FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM full_seqs)),
nodes AS (
  SELECT depth, pre, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends,
         CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(pre[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS words
  FROM members GROUP BY depth, pre),
kids AS (SELECT depth - 1 AS depth, pre[1:depth - 1] AS pre, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
named AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, pre)),
sums AS (
  SELECT m.depth, m.pre, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
  FROM named b JOIN members m ON m.conv_id = b.conv_id AND m.depth <= b.depth GROUP BY 1, 2)
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM named a JOIN sums USING (depth, pre) LEFT JOIN named up ON up.depth = a.depth - 1 AND up.pre = a.pre[1:a.depth - 1]""",
    "op13_lexical_search": f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY 1, 2),
sums AS (SELECT count(*) FILTER (len(t) > 0) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d),
m AS (SELECT doc_id, t, 25 + (75 * len(t) * n) // greatest(l, 1) AS m FROM d, sums),
posts AS (SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(t) AS term FROM m) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM posts, sums GROUP BY term),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN posts USING (term) JOIN weights USING (term) GROUP BY 1, 2)
SELECT item_id, CAST(place AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0) WHERE place <= 10""",
}
