"""One query per dealt operator, with production parameters over whole tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from heatherd.llm import (
    mixing, ngram_join, packing, prefix_trie, projections, quality, revisits, spelling, suffix_dedup, token_counts, token_files, topk, wrappers,
)
from heatherd.session import ship_by_value

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_wrapper_text(spark, sf_dir):
    return wrappers.extract_text(table(spark, sf_dir, "pages"))


@query
def op2_count_vector_join(spark, sf_dir):
    return ngram_join.jaccard_groups(table(spark, sf_dir, "documents"))


ORACLE["op2_count_vector_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= 80 * (p.n + q.n - common)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""


@query
def op3_orc_tokens(spark, sf_dir):
    return token_files.tokenize_to_files(table(spark, sf_dir, "documents"))


@query
def op4_counted_projections(spark, sf_dir):
    return projections.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op5_revisits(spark, sf_dir):
    records = revisits.records_from_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return revisits.resolve_revisits(records).select(
        "record_id", "canonical", F.col("at").alias("seen_at"), "response_id", "response_at", "outcome", F.size("headers").alias("n_headers"),
        F.col("headers")["expires"].alias("expires"), F.col("headers")["content-type"].alias("content_type"),
        F.sha2("body", 256).alias("body_sha256"), F.length("body").cast("long").alias("body_chars"))


ORACLE["op5_revisits"] = r"""
WITH timed AS (
  SELECT *, 1700000000 + (page_id * 7919) % 2592000 AS seen_at, '"' || substr(md5(html), 1, 16) || '"' AS tag,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages
), parts AS (
  SELECT *, regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', '') AS host,
    regexp_extract(rest, '^[^/?]*([^?]*)', 1) AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda x: x <> '')), '&') AS query FROM timed
), named AS (
  SELECT page_id, seen_at, tag, html, page_id % 7 = 0 AS no_tag,
    host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical FROM parts
), seen AS (
  SELECT page_id * 3 + k AS record_id, canonical, seen_at + k * 3600 * (1 + page_id % 48) AS seen_at,
    CASE WHEN no_tag THEN NULL WHEN page_id % 5 = 0 AND k = 2 THEN '"new"' ELSE tag END AS tag,
    CASE WHEN page_id % 5 = 0 AND k = 2 THEN 'later' ELSE 'day ' || (page_id % 400) END AS modified
  FROM named, (VALUES (1), (2)) AS twice(k)
), ranked AS (
  SELECT s.*, n.page_id, n.seen_at AS response_at, n.html, CASE WHEN NOT n.no_tag THEN n.tag END AS old_tag, 'day ' || (n.page_id % 400) AS old_modified,
    row_number() OVER (PARTITION BY s.record_id ORDER BY n.seen_at DESC NULLS LAST, n.page_id DESC) AS rank
  FROM seen s LEFT JOIN named n ON s.canonical = n.canonical AND n.seen_at < s.seen_at
), judged AS (
  SELECT *, CASE WHEN page_id IS NULL THEN 'no_response'
    WHEN old_tag IS NOT NULL AND tag IS NOT NULL THEN CASE WHEN old_tag = tag THEN 'resolved' ELSE 'changed' END
    WHEN old_modified = modified THEN 'resolved' ELSE 'changed' END AS outcome
  FROM ranked WHERE rank = 1
)
SELECT record_id, canonical, CAST(seen_at AS BIGINT) AS seen_at, page_id * 3 AS response_id, CAST(response_at AS BIGINT) AS response_at, outcome,
  CASE WHEN outcome = 'resolved' THEN 4 END AS n_headers, CASE WHEN outcome = 'resolved' THEN 'soon' END AS expires,
  CASE WHEN outcome = 'resolved' THEN 'text/html' END AS content_type,
  CASE WHEN outcome = 'resolved' THEN sha256(html) END AS body_sha256,
  CASE WHEN outcome = 'resolved' THEN CAST(length(html) AS BIGINT) END AS body_chars
FROM judged
"""


@query
def op6_source_mix(spark, sf_dir):
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE["op6_source_mix"] = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3.0::DOUBLE * sum(size) AS cap,
    [5.0::DOUBLE, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT cap / weight AS ratio,
    (SELECT CAST(sum(source_size) AS DOUBLE) FROM sources) - coalesce(sum(cap) OVER before, 0) AS rest,
    (SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER before, 0) AS weights
  FROM sources WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max(CASE WHEN rest / weights < ratio THEN rest / weights END) AS level FROM levels
), targets AS (
  SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target FROM sources, level
), rates AS (
  SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0) ELSE 0 END AS rate,
    CAST(CAST('0x' || substr(md5('20240601|' || coalesce(s.source, chr(1) || 'null') || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
      AS DOUBLE) / 4503599627370496 AS drawn
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates
"""


@query
def op7_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_repetition_coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(docs).drop("text", "dup_gram_chars")


@query
def op9_longest_match_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op10_tiered_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op11_lcp_extents(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


# unsigned crc32 of a list of bytes: the table of the reflected polynomial, then one step a byte
CRC_TABLE = """
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
"""
CRC = "xor(list_reduce([4294967295::BIGINT] || {bytes}, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"

ORACLE["op11_lcp_extents"] = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c.conv_id, c.conv_id - c.conv_id % 5 AS family,
    {CRC.format(bytes="list_transform(string_split(CAST(c.conv_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns) c, crc
), seqs AS (
  SELECT c.conv_id, k AS d, role, text FROM convs c JOIN turns t ON t.conv_id = c.family AND k <= h
  UNION ALL
  SELECT c.conv_id, k - h + least(h, coalesce((SELECT max(k) FROM turns b WHERE b.conv_id = c.family), 0)), role, text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND k > h
), paths AS (
  SELECT conv_id, d, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY d) AS path, strlen(text) AS bytes FROM seqs
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), nodes AS (
  SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM paths GROUP BY path
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND starts_with(c.path, n.path)) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND starts_with(n.path, p.path)
), ends AS (
  SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(path, d) AS path FROM paths GROUP BY conv_id) GROUP BY path
)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, x.parent_conv_id, x.n_convs, x.n_children,
  CAST(count(*) FILTER (y.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum((y.n_convs - 1) * y.bytes) AS BIGINT) AS saved_tokens,
  sha256(coalesce(any_value(e.ids), '')) AS ends_sha256
FROM linked x JOIN linked y ON starts_with(y.path, x.path) LEFT JOIN ends e ON e.path = x.path
GROUP BY x.path, x.conv_id, x.depth, x.parent_conv_id, x.n_convs, x.n_children
"""


@query
def op12_histogram_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


ORACLE["op12_histogram_topk"] = r"""
WITH usable AS (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op13_trie_frontier(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLE["op13_trie_frontier"] = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), marked AS (
  SELECT run, n, {CRC.format(bytes="flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda ch: CASE WHEN ord(ch) < 128 "
                             "THEN [CAST(ord(ch) AS BIGINT)] ELSE [195::BIGINT, CAST(ord(ch) - 64 AS BIGINT)] END))")} AS h FROM counted, crc
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM marked
), vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), holes AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS hole FROM (SELECT *, unnest(range(length(word))) AS i FROM vocabulary)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.hole = b.hole AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN vocabulary b ON a.hole = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN vocabulary b ON a.hole = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word
), judged AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * v.n THEN other END AS form,
    CASE WHEN other_n >= 10 * v.n THEN other_n END AS form_n
  FROM vocabulary v LEFT JOIN best b ON b.word = v.word
), follow AS (
  SELECT word, coalesce(form, word) AS root FROM judged
  UNION SELECT f.word, j.form FROM follow f JOIN judged j ON j.word = f.root WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, f.root, j.n, j.n_near, j.form_n FROM judged j JOIN follow f ON f.word = j.word
JOIN judged r ON r.word = f.root WHERE r.form IS NULL
"""


ship_by_value(__name__)
