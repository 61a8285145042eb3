"""The dealt operators as named queries over the driver tables, with the SQL each must agree with where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabeval.llm import ann, centroids, decontam, htmlwrap, langid, licenses, neardup, pieces, pii, runs, substring, urlfilter, warc
from tabeval.llm.stages import PII_KEY, PIECES_MODEL

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_language_id")
def op1(spark, folder):
    return langid.identify_languages(table(spark, folder, "documents"))


OP2_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), both_ AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM both_ JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), e AS (SELECT x, y FROM link UNION SELECT y, x FROM link
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x
), lab AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN lab ON lab.x = d.doc_id
"""


@query("op2_minhash_near_dedup", OP2_SQL)
def op2(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents"), words=4)


@query("op3_sentencepiece")
def op3(spark, folder):
    done = pieces.encode(table(spark, folder, "documents"), PIECES_MODEL)
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")


OP4_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query("op4_warc", OP4_SQL)
def op4(spark, folder):
    return warc.archived(table(spark, folder, "pages")).drop("payload")


OP5_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i AS s, array_to_string(ws[i:i+19], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)
), later AS (
  SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1
), gone AS (SELECT DISTINCT doc_id, s + j AS p FROM later, (SELECT unnest(range(0, 20)) AS j)
), words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), left_ AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_ USING (doc_id)
"""


@query("op5_substring_dedup", OP5_SQL)
def op5(spark, folder):
    done = substring.remove_repeats(table(spark, folder, "documents"), size=20)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_pii_surrogates")
def op6(spark, folder):
    return pii.pseudonymise(table(spark, folder, "documents"), PII_KEY).select("doc_id", "text", "n_entities")


URL_RULES = [  # fixed values: host, path, verdict
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
]

OP7_SQL = """
WITH place AS (
  SELECT page_id, translate(coalesce(regexp_extract(r, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS r FROM pages)
), rules(rh, rp, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), spot AS (SELECT DISTINCT host, path FROM place
), best AS (
  SELECT host, path, arg_max(rh || rp, len(rh || rp)) AS rule, arg_max(verdict, len(rh || rp)) AS verdict
  FROM spot JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM place LEFT JOIN best USING (host, path)
"""


@query("op7_url_filter", OP7_SQL)
def op7(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, folder, "pages"), rules)


@query("op8_nearest_neighbours")
def op8(spark, folder):
    rows = table(spark, folder, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 100 = 0"), k=10)


OP9_SQL = """
WITH item AS (
  SELECT item_id, ws, len(ws) AS n, least(5, len(ws)) AS k, len(ws) - least(5, len(ws)) + 1 AS span FROM (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0
), ishingle AS (
  SELECT item_id, k, s, count(*) AS c FROM (SELECT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, span + 1)) AS i FROM item)) GROUP BY ALL
), doc AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), dshingle AS (
  SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS s FROM (
    SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM doc, (SELECT DISTINCT k FROM item))
), win AS (
  SELECT DISTINCT doc_id, item_id, p - j AS a FROM (
    SELECT d.doc_id, i.item_id, d.p, unnest(range(0, span)) AS j FROM dshingle d JOIN ishingle s USING (k, s) JOIN item i USING (item_id))
), fits AS (
  SELECT win.* FROM win JOIN doc USING (doc_id) JOIN item USING (item_id) WHERE a >= 1 AND a + n - 1 <= len(doc.ws)
), bag AS (
  SELECT fits.doc_id, fits.item_id, a, i.span, d.s, i.k, count(*) AS c FROM fits JOIN item i USING (item_id)
  JOIN dshingle d ON d.doc_id = fits.doc_id AND d.k = i.k AND d.p BETWEEN a AND a + span - 1 GROUP BY ALL
), score AS (
  SELECT doc_id, item_id, a, both_ / (2 * span - both_) AS best FROM (
    SELECT b.doc_id, b.item_id, a, span, sum(least(b.c, s.c)) AS both_ FROM bag b JOIN ishingle s USING (item_id, k, s) GROUP BY ALL)
), hit AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id)) AS items, max(best) AS best FROM score WHERE best >= 0.8 GROUP BY doc_id
)
SELECT documents.doc_id, hit.doc_id IS NOT NULL AS contaminated, coalesce(items, []) AS items, coalesce(best, 0.0)::DOUBLE AS best
FROM documents LEFT JOIN hit USING (doc_id)
"""


@query("op9_decontamination", OP9_SQL)
def op9(spark, folder):
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op10_html_extraction")
def op10(spark, folder):
    return htmlwrap.extract_text(table(spark, folder, "pages"))


@query("op11_periodic_runs")
def op11(spark, folder):
    done = runs.collapse_runs(table(spark, folder, "documents"), loop_tails=True)
    # the longest run; of equally long ones the first, then the one with the smallest period
    order = F.transform("runs", lambda r: F.struct(-r["length"], r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    lines = F.transform("runs", lambda r: F.concat(F.array_join(F.array(r["start"], r["length"], r["period"]).cast("array<string>"), ","), F.lit("\n")))
    told = done.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.array_min(order).alias("top"), F.array_join(lines, "").alias("lines"), "collapsed")
    return told.select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.floor(F.lit(1000) * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_sql(rounds: int = 10, k: int = 8) -> str:
    """Every round as two tables: vectors with their nearest centroid, centroids moved to floors of means."""
    parts = [f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), comp AS MATERIALIZED (SELECT vec_id, unnest(range(1, 65)) AS j, unnest(v) AS x FROM kept
), c0 AS MATERIALIZED (
  SELECT no, unnest(range(1, 65)) AS j, unnest(v) AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR)) - 1 AS no, v FROM kept QUALIFY no < {k})
)"""]
    for r in range(rounds + 1):
        parts.append(f"""
, d{r} AS MATERIALIZED (
  SELECT vec_id, (arg_min(no, dist * {k} + no))::INTEGER AS no, min(dist)::BIGINT AS dist FROM (
    SELECT vec_id, no, sum((comp.x - c.x) * (comp.x - c.x))::BIGINT AS dist FROM comp JOIN c{r} c USING (j) GROUP BY vec_id, no) GROUP BY vec_id
)""")
        if r < rounds:
            parts.append(f"""
, m{r} AS (
  SELECT no, j, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM comp JOIN d{r} USING (vec_id) GROUP BY no, j
), c{r + 1} AS MATERIALIZED (
  SELECT c.no, c.j, coalesce(CASE WHEN s % n < 0 THEN s // n - 1 ELSE s // n END, c.x)::BIGINT AS x FROM c{r} c LEFT JOIN m{r} USING (no, j)
)""")
    parts.append(f"""
SELECT vec_id, no AS cluster, dist AS distance, (sum(dist) OVER (PARTITION BY no))::BIGINT AS cluster_inertia,
  (sum(dist) OVER ())::BIGINT AS inertia, centroid_sha256
FROM d{rounds} JOIN (SELECT no, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY no) USING (no)
""")
    return "".join(parts)


@query("op12_centroid_clusters", op12_sql())
def op12(spark, folder):
    done = centroids.cluster(table(spark, folder, "embeddings"), k=8, rounds=10, seed=3)
    return done.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroids.digest(F.col("centroid")).alias("centroid_sha256"))


def op13_sql() -> str:
    """Every fit of a template by counting the words in place for all words, without an index of rare ones."""
    shapes = ", ".join(
        f"({t}, '{label}', '{passage}', {len(passage.split())}, {len(passage.split()) - licenses.misses(len(passage.split()), licenses.SHARE)})"
        for t, (label, passage, _) in enumerate(licenses.TEMPLATES)
    )
    keys = ", ".join(f"({t}, ' {key} ')" for t, (_, _, phrases) in enumerate(licenses.TEMPLATES) for key in phrases)
    bases = ", ".join(f"('{phrase}', '{label}', {len(phrase.split())})" for phrase, label in licenses.BASE_PHRASES.items())
    return f"""
WITH shape(t, label, passage, n, least) AS (VALUES {shapes}), key(t, phrase) AS (VALUES {keys}), base(phrase, label, k) AS (VALUES {bases}
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), word AS (SELECT doc_id, unnest(ws) AS w, unnest(range(0, len(ws))) AS i FROM doc
), shape_word AS (SELECT t, unnest(string_split(passage, ' ')) AS w, unnest(range(0, n)) AS j FROM shape
), fit AS (
  SELECT doc_id, t, i - j AS o, count(*) AS same FROM word JOIN shape_word USING (w) GROUP BY ALL
), near_ AS (
  SELECT fit.doc_id, t, label, same / n AS share, ' ' || array_to_string(ws[greatest(o, 0) + 1:o + n], ' ') || ' ' AS stretch
  FROM fit JOIN shape USING (t) JOIN doc USING (doc_id) WHERE same >= least
), found AS (
  SELECT doc_id, label, share FROM near_
  WHERE NOT EXISTS (SELECT 1 FROM key WHERE key.t = near_.t AND NOT contains(near_.stretch, key.phrase))
), place AS (
  SELECT doc_id, i, base.label FROM word JOIN base ON w = string_split(phrase, ' ')[1] JOIN doc USING (doc_id) WHERE array_to_string(ws[i + 1:i + k], ' ') = phrase
), b AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM place GROUP BY doc_id
), l AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM place UNION ALL SELECT doc_id, label FROM found) GROUP BY doc_id
), s AS (SELECT doc_id, max(share) AS best FROM found GROUP BY doc_id)
SELECT doc.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, (CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END)::DOUBLE AS score
FROM doc LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN s USING (doc_id)
"""


@query("op13_license_scan", op13_sql())
def op13(spark, folder):
    done = licenses.scan(table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
