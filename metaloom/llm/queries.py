"""The registered queries of the operators, and SQL where it can say the same."""

from pyspark.sql import functions as F

from metaloom.llm import backoff, centroids, exact_dedup, extraction, hard_negatives, line_dedup, mixing, packing, projections, quality_rules, superminhash, toxicity, warc
from metaloom.llm.common import table

QUERIES, ORACLES = {}, {}


def query(sql=None):
    def register(plan):
        QUERIES[plan.__name__] = plan
        if sql is not None:
            ORACLES[plan.__name__] = sql
        return plan
    return register


@query()
def op1_html_extraction(spark, folder):
    """The main text of every page."""
    return extraction.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query(r"""
WITH lines AS (
  SELECT doc_id, coalesce(source, chr(1)) AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS key FROM lines),
spread AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT site) >= 3),
m AS (SELECT k.*, spread.key IS NOT NULL AND row_number() OVER (PARTITION BY k.key ORDER BY doc_id, pos) > 1 AS gone
      FROM k LEFT JOIN spread ON k.key = spread.key)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text,
       CAST(coalesce(t.removed, 0) AS INT) AS lines_removed
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS text, count(*) FILTER (gone) AS removed
  FROM m GROUP BY doc_id) t USING (doc_id)""")
def op2_line_dedup(spark, folder):
    """Every document without later occurrences of lines on three sources or more."""
    found = line_dedup.drop_spread_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "text", "lines_removed")


@query()
def op3_backoff(spark, folder):
    """Log-probabilities of all documents; a seventh of them is held out of training."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return backoff.score(table(spark, folder, "documents"), held_out)


@query()
def op4_projections(spark, folder):
    """Near-duplicates of all embeddings within their labels."""
    return projections.near_duplicates(table(spark, folder, "embeddings"))


@query()
def op5_packing(spark, folder):
    """Every document's pieces and their places in sequences of 4096 tokens."""
    from public_tokenizers import path

    return packing.pack(table(spark, folder, "documents"), path("word_bpe_49k.json"))


@query()
def op6_mixing(spark, folder):
    """What the mix takes of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op7_superminhash(spark, folder):
    """Near-duplicates of all documents by shingles of four words."""
    return superminhash.near_duplicates(table(spark, folder, "documents"), words=4)


@query()
def op8_toxicity(spark, folder):
    """Every document's toxicity, learned from two thirds of the labels."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    held_out = F.coalesce(~toxicity.learns_from("doc_id"), F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query(r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents),
g AS (SELECT s, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY s)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(s) AS text_sha256
FROM t JOIN g USING (s)""")
def op9_exact_dedup(spark, folder):
    """Groups of equal texts over all documents."""
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


@query()
def op10_warc(spark, folder):
    """Archives every page and reads the archives back."""
    archives, index = warc.write(table(spark, folder, "pages"))
    return warc.read(archives, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _failed(rule):
    value = rule.measure if rule.of is None else f"{rule.measure}::DOUBLE / nullif({rule.of}, 0)"
    bounds = [f"{value} < {rule.low}"] * (rule.low is not None) + [f"{value} > {rule.high}"] * (rule.high is not None)
    return f"coalesce({' OR '.join(bounds)}, false)"


_STOPS = ", ".join(f"'{word}'" for word in quality_rules.STOP_WORDS)


@query(rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS s FROM documents),
l AS (SELECT doc_id, s, regexp_extract_all(s, '[^\x20\x09-\x0D]+') AS w,
             [x FOR x IN string_split(s, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
             regexp_extract_all(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?()"' || chr(39), 'abcdefghijklmnopqrstuvwxyz          '),
                                '[^\x20\x09-\x0D]+') AS plain FROM t),
win AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, unnest([array_to_string(w[i:i + 7], ' ') FOR i IN range(1, len(w) - 6)]) AS x FROM l),
c AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, x) AS n FROM win),
r AS (SELECT doc_id, least(8, coalesce(lead(p) OVER (PARTITION BY doc_id ORDER BY p) - p, 8)) AS more FROM c WHERE n > 1),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(s, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(s) - length(regexp_replace(s, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len([x FOR x IN plain IF x IN ({_STOPS})]) AS n_stop_words,
             len([x FOR x IN list_zip(w, w[2:]) IF x[1] = x[2]]) AS n_echoed_words,
             CAST(coalesce((SELECT sum(more) FROM r WHERE r.doc_id = l.doc_id), 0) AS BIGINT) AS n_repeat_words,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             len([x FOR x IN lines IF regexp_matches(x, '^ *(- |\* |•|‣|◦)')]) AS n_bullet_lines,
             len([x FOR x IN lines IF regexp_matches(x, '(\.\.\.|…) *$')]) AS n_cut_lines FROM l),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(map(_failed, quality_rules.RULES))}) AS kept FROM b""")
def op13_quality_rules(spark, folder):
    """Measures and verdict of every document."""
    found = quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text"))
    base_failed = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"))


def _round(i):
    """Assignment i and the centroids after it."""
    return f"""
s{i} AS MATERIALIZED (SELECT vec_id, c, d2 FROM (
  SELECT q.vec_id, c{i}.c, sum((q.x - c{i}.x) * (q.x - c{i}.x))::BIGINT AS d2 FROM q JOIN c{i} USING (d) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d2, c) = 1),
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, c{i}.d, coalesce(m.x, c{i}.x) AS x FROM c{i} LEFT JOIN (
    SELECT s{i}.c, q.d, CAST((sum(q.x) - ((sum(q.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
    FROM s{i} JOIN q USING (vec_id) GROUP BY s{i}.c, q.d) m USING (c, d)),"""


@query(rf"""
WITH v AS (SELECT vec_id, embedding AS e FROM embeddings WHERE len(embedding) = 64
           AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
q AS MATERIALIZED (SELECT vec_id, unnest(range(1, 65)) AS d, unnest([floor(256 * x::DOUBLE)::BIGINT FOR x IN e]) AS x FROM v),
c0 AS MATERIALIZED (SELECT r.c, q.d, q.x FROM q JOIN (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM v) r USING (vec_id) WHERE r.c < 40),
{"".join(map(_round, range(5)))}
s5 AS MATERIALIZED (SELECT vec_id, c, d2 FROM (
  SELECT q.vec_id, c5.c, sum((q.x - c5.x) * (q.x - c5.x))::BIGINT AS d2 FROM q JOIN c5 USING (d) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d2, c) = 1)
SELECT vec_id, c::INT AS cluster, d2 AS distance, (sum(d2) OVER (PARTITION BY s5.c))::BIGINT AS cluster_inertia,
       (sum(d2) OVER ())::BIGINT AS inertia, h.sha AS centroid_sha256
FROM s5 JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS sha FROM c5 GROUP BY c) h USING (c)""")
def op11_centroids(spark, folder):
    """Forty clusters of all vectors of 64 components, after five rounds."""
    found = centroids.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"), dimensions=64)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query(r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.q) = len(c.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 5""")
def op12_cover_tree(spark, folder):
    """Hard negatives of every hundredth vector; every seventh vector's label is moved on first."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)
