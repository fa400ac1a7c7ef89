"""The operators as registered queries, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.llm import bpe, decontaminate, html, importance, lines, minhash, quality, search, secrets, substring, toxicity, urls, warc
from clickforge.llm.common import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL where there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated passages removed; brute force in the tests."""
    out = substring.remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("removed").alias("n_spans"))


WINDOWS_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hit AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, p)),
cover AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query(WINDOWS_SQL)
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that benchmark windows cover."""
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query()
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate texts; brute force in the tests."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85, shingle=5).select("doc_id", "n_shingles", "component_id", "kept")


LINES_SQL = r"""
WITH l AS (SELECT doc_id, line, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
                 FROM documents WHERE text IS NOT NULL) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, pos, line, lead(line, 1) OVER s AS l2, lead(line, 2) OVER s AS l3, lead(pos, 2) OVER s AS until
      FROM l WINDOW s AS (PARTITION BY doc_id ORDER BY seq)),
f AS (SELECT *, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, pos) AS nth FROM w WHERE until IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, until + 1)) AS pos FROM f WHERE nth > 1),
every AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
          FROM documents WHERE text <> ''),
per AS (SELECT doc_id, count(*) AS n_lines, count(g.pos) AS n_removed, string_agg(line, chr(10) ORDER BY pos) FILTER (g.pos IS NULL) AS kept
        FROM every LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN per USING (doc_id)
"""


@query(LINES_SQL)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of three or more lines."""
    out = lines.drop_repeated_lines(table(spark, sf_dir, "documents"), min_lines=3)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


PASSAGES_SQL = r"""
WITH l AS (SELECT doc_id, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
                 FROM documents WHERE text IS NOT NULL) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, pos, line, n, lead(line, 1) OVER s AS l2, lead(line, 2) OVER s AS l3, n + lead(n, 1) OVER s AS n2,
             lead(pos, 1) OVER s AS u2, lead(pos, 2) OVER s AS u3
      FROM l WINDOW s AS (PARTITION BY doc_id ORDER BY seq)),
f AS (SELECT doc_id, pos, pos AS until, n >= 13 AS fits, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth FROM w
      UNION ALL SELECT doc_id, pos, u2, n2 >= 13, row_number() OVER (PARTITION BY line, l2 ORDER BY doc_id, pos) FROM w WHERE u2 IS NOT NULL
      UNION ALL SELECT doc_id, pos, u3, true, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, pos) FROM w WHERE u3 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, until + 1)) AS pos FROM f WHERE nth > 1 AND fits),
every AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
          FROM documents WHERE text <> ''),
per AS (SELECT doc_id, count(*) AS n_lines, count(g.pos) AS n_removed, string_agg(line, chr(10) ORDER BY pos) FILTER (g.pos IS NULL) AS kept
        FROM every LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN per USING (doc_id)
"""


@query(PASSAGES_SQL)
def op10_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of three or more lines or of 13 or more words on fewer lines."""
    out = lines.drop_repeated_lines(table(spark, sf_dir, "documents"), min_lines=3, min_words=13)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdicts of all documents; brute force in the tests."""
    return quality.quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed", ",").alias("failed"))


def tokenizer() -> tuple[str, str]:
    """The path of the vocabulary and the splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all texts and their round trip; held against the tokenizer's own library in the tests."""
    path, pattern = tokenizer()
    ranks = bpe.load_ranks(spark, path)
    both = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern, decoded=True)
    made = both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
    return stored(made, "digests")[0]


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a classifier that never saw the held-out labels; held-out accuracy in the tests."""
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held))
    return model.score(docs).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query()
def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and template purities of all urls; brute force in the tests."""
    return urls.judged_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "template")


#: Named references as a DuckDB map.
NAMED_SQL = "MAP {" + ", ".join("'%s': '%s'" % (k, v.replace("'", "''")) for k, v in warc.NAMED.items()) + "}"
WARC_SQL = r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS body FROM pages),
h AS (SELECT *, sha1(body) AS digest, md5(coalesce(CAST(page_id AS VARCHAR), '') || ' ' || uri || ' ' || sha1(body)) AS h FROM u),
r AS (SELECT *, '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>' AS id FROM h),
bare AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(body,
 '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'),
 '(?i)<(/?(p|div|li|ul|ol|h[1-6]|article|nav|footer|header|title|tr|table)|br)[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS b FROM r),
refs AS (SELECT *, list_transform(regexp_extract_all(b, '@REFERENCE'), lambda x: CASE
   WHEN x[2] <> '#' THEN coalesce(@NAMED[x[2:-2]], x)
   WHEN lower(x[3]) = 'x' THEN CAST('0x' || x[4:-2] AS INTEGER)::VARCHAR ELSE CAST(x[3:-2] AS INTEGER)::VARCHAR END) AS f,
   list_transform(regexp_extract_all(b, '@REFERENCE'), lambda x: x[2] = '#') AS coded FROM bare),
chars AS (SELECT *, list_transform(range(1, len(f) + 1), lambda i: CASE WHEN NOT coded[i] THEN f[i] WHEN CAST(f[i] AS INTEGER) = 160 THEN ' '
   WHEN CAST(f[i] AS INTEGER) BETWEEN 1 AND 55295 OR CAST(f[i] AS INTEGER) BETWEEN 57344 AND 1114111 THEN chr(CAST(f[i] AS INTEGER)) ELSE chr(65533) END) AS c,
   string_split_regex(b, '@REFERENCE') AS p FROM refs),
t AS (SELECT page_id, uri, id, digest, 'conversion' AS type, 'text/plain' AS mime, trim(regexp_replace(regexp_replace(
  CASE WHEN len(c) = 0 THEN b ELSE array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || coalesce(c[i], '')), '') END,
  '[ \t\r\f]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS block FROM chars
 UNION ALL
 SELECT page_id, uri, id, digest, 'metadata', 'application/json', '{"http_status":200,"http_headers":{"Content-Type":"text/html; charset=utf-8","Content-Length":"'
  || octet_length(encode(body)) || '"},"payload_digest":"sha1:' || digest || '","title":' || to_json(trim(regexp_extract(body, '(?is)<title[^>]*>(.*?)</title>', 1)))
  || ',"links":' || to_json(list_transform(regexp_extract_all(body, '@LINK', 1), lambda x: CASE WHEN x[1] IN (chr(34), chr(39)) THEN x[2:-2] ELSE x END)) || '}' FROM r),
n AS (SELECT *, md5(type || ' ' || id) AS h, octet_length(encode(block))::BIGINT AS n_bytes, 'sha1:' || sha1(block) AS block_digest FROM t),
k AS (SELECT *, '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>' AS record_id FROM n)
SELECT page_id, type, record_id, id AS refers_to, uri, '2024-01-01T00:00:00Z' AS date, 'sha1:' || digest AS source_digest, block_digest, n_bytes,
  sha256(array_to_string(['WARC/1.0', 'WARC-Type: ' || type, 'WARC-Target-URI: ' || uri, 'WARC-Date: 2024-01-01T00:00:00Z', 'WARC-Record-ID: ' || record_id,
    'WARC-Refers-To: ' || id, 'WARC-Block-Digest: ' || block_digest, 'WARC-Source-Payload-Digest: sha1:' || digest, 'Content-Type: ' || mime,
    'Content-Length: ' || n_bytes], chr(13) || chr(10)) || chr(13) || chr(10) || chr(13) || chr(10) || block || chr(13) || chr(10) || chr(13) || chr(10)) AS record_sha256
FROM k
""".replace("@REFERENCE", warc.REFERENCE).replace("@LINK", warc.LINK.replace("'", "''")).replace("@NAMED", NAMED_SQL)


@query(WARC_SQL)
def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of all pages, each with the digest of its whole bytes."""
    made = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return made.select(
        "page_id", "type", "record_id", "refers_to", "uri", "date", F.col("payload_digest").alias("source_digest"), "block_digest",
        F.octet_length("block").cast("long").alias("n_bytes"), F.sha2("record", 256).alias("record_sha256"))


@query()
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages; brute force and hand-made pages in the tests."""
    return html.main_texts(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


#: The crc32 of a feature is a fold over its bytes, eight steps each: a byte joins at its first step, the others have 0.
RESAMPLE_SQL = r"""
WITH w AS (SELECT 'd' AS side, doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 'b', NULL, 0, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS (SELECT side, r, unnest(w) AS feature FROM w
      UNION ALL SELECT side, r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
c AS (SELECT side, r, feature, count(*) AS n FROM f GROUP BY ALL),
b AS (SELECT feature, xor(list_reduce(flatten(list_transform(range(0, octet_length(encode(feature))),
        lambda i: [CAST('0x' || substr(hex(encode(feature)), 2 * i + 1, 2) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
        lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)), 4294967295), 4294967295) % 10000 AS bucket
      FROM (SELECT DISTINCT feature FROM c)),
n AS (SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t FROM c JOIN b USING (feature) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000e0 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce(sum(s) OVER (), 0) + 10000)::DOUBLE
        / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(sum(t) OVER (), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM n),
p AS (SELECT r, sum(n)::BIGINT AS n_features, CAST(floor(sum(n * gain)::DOUBLE / sum(n)) AS BIGINT) AS weight
      FROM c JOIN b USING (feature) JOIN g USING (bucket) WHERE side = 'd' GROUP BY r),
h AS (SELECT r, doc_id, len(w) AS n_words, CAST('0x' || sha256('7:' || doc_id)[1:8] AS BIGINT) AS h FROM w WHERE side = 'd'),
z AS (SELECT r, doc_id, n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000e0 * ln(-ln((h + 0.5e0) / 4294967296e0))) AS BIGINT) AS score FROM h LEFT JOIN p USING (r)),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS eligible FROM z WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * eligible // 100 THEN place END AS rank FROM z LEFT JOIN o USING (r)
"""


@query(RESAMPLE_SQL)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their weight towards the benchmark, and the drawn quarter's ranks."""
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, min_words=20, seed=7)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS texts, sum(len(w))::BIGINT AS length FROM d),
t AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
x AS (SELECT item_id, r, doc_id, sum(CAST(floor(1000 * ln((2 * texts + 2)::DOUBLE / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * texts) // length))))::BIGINT AS score
      FROM q JOIN t USING (term) JOIN f USING (term), s GROUP BY ALL),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place, doc_id, score FROM x WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM o WHERE place <= 10
"""


@query(SEARCH_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


#: Matches and the texts between them give the places: as many code points as stand before.
SECRETS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
pattern(k, kind, pat, least) AS (VALUES
  (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+', 8),
  (1, 'access', 'AKIA[A-Z0-9]+', 16), (2, 'hex', '[0-9a-f]{32,}', 32), (3, 'owned', '[A-Za-z0-9+_=-]{20,}', 20)),
m AS (SELECT r, doc_id, owner, k, kind, least, regexp_extract_all(t, pat) AS m, string_split_regex(t, pat) AS p FROM d, pattern WHERE regexp_matches(t, pat)),
e AS (SELECT r, doc_id, owner, k, kind, least, m[i] AS s, list_sum(list_transform(p[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS a
      FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM m)),
c AS (SELECT *, a + len(s) AS z FROM (SELECT *, CASE WHEN k = 0 THEN regexp_extract(s, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?(.*)$', 1) ELSE s END AS v FROM e) WHERE len(v) >= least),
b AS (SELECT * FROM c WHERE k < 3),
f AS (SELECT * FROM b UNION ALL SELECT * FROM c WHERE k = 3 AND len(list_distinct(string_split(s, ''))) >= 10
        AND len(regexp_extract_all(s, '[0-9][A-Za-z]|[A-Za-z][0-9]')) >= 3
        AND NOT EXISTS (SELECT 1 FROM b WHERE b.r = c.r AND b.a < c.z AND b.z > c.a)),
o AS (SELECT v, count(DISTINCT owner) AS owners FROM f GROUP BY v),
j AS (SELECT r, k, kind, a, z, owners > 2 AS example, kind || ':' || CAST(a AS BIGINT) || ':' || CAST(z AS BIGINT) AS span FROM f JOIN o USING (v)),
g AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
        string_agg(span, ',' ORDER BY a, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY a, k) FILTER (k < 3 OR NOT example) AS spans,
        count(*) FILTER (NOT example) AS n_live, count(*) FILTER (example AND k < 3) AS n_examples FROM j GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_examples, 0)::BIGINT AS n_examples
FROM d LEFT JOIN g USING (r)
"""


@query(SECRETS_SQL)
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of all documents, with drawn-looking runs of few owners, and how many are live-looking or copied examples."""
    out = secrets.secret_spans(table(spark, sf_dir, "documents"), owner="source", repository="doc_id", max_owners=2)
    n = lambda test: F.size(F.filter("spans", test)).cast("long")
    of = lambda kind: n(lambda s: s["kind"] == kind).alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "owned")
    return out.select(
        "doc_id", *[of(kind) for kind in secrets.KINDS[:3]],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
        n(lambda s: ~s["example"]).alias("n_live"), n(lambda s: s["example"]).alias("n_examples"))
