"""The operators applied to the whole given tables, under the names of the catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_digests
from .divergence import SourceAudit
from .html_text import main_text
from .lexical import LexicalIndex
from .line_dedup import drop_common_lines
from .near_dedup import near_copies
from .positional_index import PositionalIndex
from .quality import fit_quality, score_quality
from .secret_scan import find_secrets, secret_digests
from .shared import shared_folder
from .sharding import range_shards
from .token_store import TokenStore
from .top_k import top_k
from .warc import Archive


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the documents' token shards and index, then fetch every document by its key."""
    docs = table(spark, sf_dir, "documents")
    store = TokenStore.write(docs, shared_folder(spark, "tokens"), vocabulary(), end_id=2)
    return store.fetch(docs, "doc_id").withColumnRenamed("key", "doc_id")


def op2_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text(table(spark, sf_dir, "pages"))


def op3_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies on sets of 2-word shingles."""
    return near_copies(table(spark, sf_dir, "documents"), words=2)


def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more in 5 documents or more stay in the last one only."""
    kept = drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold passages of the benchmark."""
    index = PositionalIndex(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    found = index.contamination()
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated")


def op6_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back through the merged index."""
    return Archive.write(table(spark, sf_dir, "pages"), shared_folder(spark, "warc")).digests()


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text, learned from labels outside the held-out third."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = fit_quality(docs, labels.filter(~held_out))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return score_quality(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op8_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), vocabulary())


def op9_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(docs.text, F.lit(""))
    shards = range_shards(docs, 40, carry={"text_crc32": F.crc32(text)})
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of each 50th vector."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of known shapes and stretches of high entropy in every whole text."""
    return secret_digests(find_secrets(table(spark, sf_dir, "documents")))


def op12_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    folder = shared_folder(spark, "lexical")
    index = LexicalIndex.write(table(spark, sf_dir, "documents"), f"{folder}/index")
    found = index.search(table(spark, sf_dir, "benchmark"), f"{folder}/search")
    return found.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, and the terms that each one overuses."""
    return SourceAudit(table(spark, sf_dir, "documents")).report()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_page_differencing": op2_page_differencing,
    "op3_signature_join": op3_signature_join,
    "op4_line_runs": op4_line_runs,
    "op5_positional_index": op5_positional_index,
    "op6_warc_merge": op6_warc_merge,
    "op7_compression_quality": op7_compression_quality,
    "op8_forced_boundary_bpe": op8_forced_boundary_bpe,
    "op9_histogram_shards": op9_histogram_shards,
    "op10_kd_top_k": op10_kd_top_k,
    "op11_entropy_secrets": op11_entropy_secrets,
    "op12_block_max_search": op12_block_max_search,
    "op13_source_audit": op13_source_audit,
}

LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS dropped FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words
), classes AS (
  SELECT min(doc_id) AS rep, list_sort(s) AS s, len(s) AS n FROM shingled WHERE len(s) > 0 GROUP BY list_sort(s), len(s)
), posted AS (
  SELECT rep, n, unnest(s) AS t FROM classes
), times AS (
  SELECT t, count(*) AS c FROM posted GROUP BY t
), ranked AS (
  SELECT rep, n, posted.t, row_number() OVER (PARTITION BY rep ORDER BY c, posted.t) AS r FROM posted JOIN times USING (t)
), prefixes AS (  -- sets as similar meet within this many of their rarest shingles
  SELECT * FROM ranked WHERE r <= n - (80 * n + 99) // 100 + 1
), pairs AS (
  SELECT DISTINCT a.rep AS a, b.rep AS b FROM prefixes a JOIN prefixes b ON a.t = b.t AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), links AS (
  SELECT a, b FROM pairs JOIN classes x ON a = x.rep JOIN classes y ON b = y.rep
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))
), reach AS (
  SELECT rep AS node, rep AS other FROM classes
  UNION
  SELECT r.node, CASE WHEN l.a = r.other THEN l.b ELSE l.a END FROM reach r JOIN links l ON r.other = l.a OR r.other = l.b
), joined AS (
  SELECT node, min(other) AS component FROM reach GROUP BY node
)
SELECT doc_id, CAST(len(sh.s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
       coalesce(component, doc_id) = doc_id AS kept
FROM shingled sh LEFT JOIN classes c ON list_sort(sh.s) = c.s LEFT JOIN joined ON c.rep = node"""

PHRASES_SQL = r"""
WITH both_texts AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
  UNION ALL SELECT 'i', CAST(item_id AS VARCHAR), text FROM benchmark
), words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM both_texts
), windows AS (
  SELECT DISTINCT id AS item, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS phrase
  FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM words WHERE kind = 'i' AND len(w) > 0)
), lengths AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT id AS doc, n, s, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM words, lengths WHERE kind = 'd' AND len(w) >= n)
), hits AS (
  SELECT doc, item, s, places.n FROM places JOIN windows USING (n, phrase)
), hit_words AS (
  SELECT doc, count(DISTINCT p) AS n_hit FROM (SELECT doc, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc
), hit_items AS (
  SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc, item FROM hits) GROUP BY doc
)
SELECT CAST(id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words h ON h.doc = id LEFT JOIN hit_items i ON i.doc = id WHERE kind = 'd'"""

WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
  SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)"""

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5"""

SECRETS_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), shapes(kind, place, pattern, tail, least) AS (VALUES  -- tail: what the length is asked of
  ('assign', 1, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+', '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 8),
  ('access', 2, 'AKIA[A-Z0-9]+', '^(.*)$', 16),
  ('hex', 3, '[0-9a-f]{32,}', '^(.*)$', 32)
), matched AS (  -- pieces between the matches give the places
  SELECT row, kind, place, least, tail, text, regexp_extract_all(text, pattern) AS m, string_split_regex(text, pattern) AS p
  FROM docs, shapes WHERE regexp_matches(text, pattern)
), placed AS (
  SELECT row, kind, place, least, tail, text, unnest(m) AS found, unnest(range(1, len(m) + 1)) AS i, list_transform(m, lambda x: length(x)) AS ml, list_transform(p, lambda x: length(x)) AS pl FROM matched
), base AS (
  SELECT row, kind, place, CAST(list_sum(pl[1:i]) + coalesce(list_sum(ml[1:i - 1]), 0) AS BIGINT) AS a, a + length(found) AS b
  FROM placed WHERE length(regexp_extract(found, tail, 1)) >= least
), classes(kind, place, pattern, size, bits) AS (VALUES
  ('hex_entropy', 4, '[0-9A-Fa-f]{24,}', 24, 3.2), ('base64_entropy', 5, '[A-Za-z0-9+/_=-]{24,}', 24, 4.0)
), runs AS (
  SELECT row, kind, place, size, bits, text, regexp_extract_all(text, pattern) AS m, string_split_regex(text, pattern) AS p
  FROM docs, classes WHERE regexp_matches(text, pattern)
), listed AS (
  SELECT row, kind, place, size, bits, text, unnest(m) AS run, unnest(range(1, len(m) + 1)) AS i, list_transform(m, lambda x: length(x)) AS ml, list_transform(p, lambda x: length(x)) AS pl FROM runs
), candidates AS (
  SELECT row, kind, place, size, bits, text, run, CAST(list_sum(pl[1:i]) + coalesce(list_sum(ml[1:i - 1]), 0) AS BIGINT) AS origin
  FROM listed
), windows AS (
  SELECT *, unnest(range(0, length(run) - size + 1)) AS s FROM candidates WHERE NOT regexp_matches(run, '^(?i:sha1|sha224|sha256|sha384|sha512|md5)[=_-]')
), letters AS (
  SELECT row, kind, place, size, bits, origin, s, unnest(string_split(run[s + 1:s + size], '')) AS letter FROM windows
), counted AS (
  SELECT row, kind, place, size, bits, origin, s, letter, count(*) AS c FROM letters GROUP BY ALL
), hot AS (
  SELECT row, kind, place, size, origin, s FROM counted GROUP BY row, kind, place, size, bits, origin, s
  HAVING sum(CAST(round(c * log2(c) * 1000000) AS BIGINT)) <= floor(size * (log2(size) - bits) * 1000000)
), islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY row, kind, origin ORDER BY s) AS island
  FROM (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY row, kind, origin ORDER BY s) + size THEN 0 ELSE 1 END AS fresh FROM hot)
), spans AS (
  SELECT row, kind, place, origin, origin + min(s) AS a, origin + max(s) + any_value(size) AS b FROM islands GROUP BY row, kind, place, origin, island
), judged AS (
  SELECT row, kind, place, a, b, text[a + 1:b] AS found, text[greatest(origin - 200, 0) + 1:origin] AS before FROM spans JOIN docs USING (row)
), added AS (
  SELECT * FROM judged j WHERE NOT regexp_full_match(found, '[0-9+/_=-]+') AND NOT regexp_full_match(found, '[A-Za-z]+([+/_=-]+[A-Za-z]+)+')
    AND NOT regexp_full_match(found, '[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}')
    AND NOT regexp_matches(found, '(?i:example|sample|dummy|placeholder|changeme|xxxxxx|your_|abcdefghij|0123456789)')
    AND NOT regexp_matches(before, '://[^ \t\r\n]*$') AND NOT regexp_matches(before, '(?i:sha1|sha224|sha256|sha384|sha512|md5)[ ]?[:=-][ ]?$') AND NOT regexp_matches(before, ';base64,$')
    AND NOT EXISTS (FROM base WHERE base.row = j.row AND base.a <= j.a AND j.b <= base.b)
), every AS (
  SELECT row, kind, place, a, b FROM base UNION ALL SELECT row, kind, place, a, b FROM added
), told AS (
  SELECT row, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) FILTER (WHERE place <= 3) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) AS spans
  FROM every GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (row)"""

RANKED_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id AS id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'i', row_number() OVER (), item_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') FROM benchmark
), terms AS (
  SELECT kind, row, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM words
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM words WHERE kind = 'd' AND len(w) > 0
), asked AS (
  SELECT row AS item, term, count(*) AS times FROM terms WHERE kind = 'i' GROUP BY ALL
), found AS (
  SELECT row AS doc, term, count(*) AS tf FROM terms WHERE kind = 'd' AND term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM found, corpus GROUP BY term, docs
), masses AS (
  SELECT row AS doc, id AS doc_id, 100 - 25 + ((25 * len(w) * docs) // total) AS m FROM words, corpus WHERE kind = 'd' AND len(w) > 0
), scored AS (
  SELECT item, doc, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN found USING (term) JOIN weights USING (term) JOIN masses USING (doc) GROUP BY item, doc
), ranked AS (
  SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored JOIN masses USING (doc) WHERE score > 0
)
SELECT id AS item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN words ON kind = 'i' AND row = item WHERE rank <= 20"""

DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), terms AS (
  SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs
), kept AS (
  SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), sizes AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM terms JOIN kept USING (lang, term) GROUP BY ALL
), sources AS (
  SELECT DISTINCT lang, source FROM docs
), filled AS (
  SELECT s.lang, s.source, k.term, coalesce(c, 0) AS c, v, sum(coalesce(c, 0)) OVER (PARTITION BY s.lang, s.source) AS n
  FROM sources s JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN counts USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (n + 5 * v) AS p FROM filled
), usual AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 5)) // (n + 5 * v) AS q
  FROM (SELECT lang, term, sum(c) AS c, any_value(v) AS v, sum(sum(c)) OVER (PARTITION BY lang) AS n FROM filled GROUP BY lang, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(d), 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS d FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source GROUP BY ALL
), over_used AS (
  SELECT lang, source, term AS item, p - q AS value FROM shares JOIN usual USING (lang, term) WHERE c > 0 AND p > q
), parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM over_used
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 50"""

ORACLES: dict[str, str] = {
    "op3_signature_join": NEAR_SQL,
    "op4_line_runs": LINES_SQL,
    "op5_positional_index": PHRASES_SQL,
    "op6_warc_merge": WARC_SQL,
    "op10_kd_top_k": TOP_K_SQL,
    "op11_entropy_secrets": SECRETS_SQL,
    "op12_block_max_search": RANKED_SQL,
    "op13_source_audit": DIVERGENCE_SQL,
}
