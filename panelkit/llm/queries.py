"""The operators' queries and their SQL, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_bpe(spark, sf_dir):
    """Digest of the ids and of the decoded text of every document."""
    from panelkit.llm.bpe import encode_decode

    out = encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op10_token_counts(spark, sf_dir, limit: int = 2048):
    from panelkit.llm.tokcount import token_counts

    out = token_counts(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

@query
def op2_substring_dedup(spark, sf_dir, window: int = 50):
    from panelkit.llm.substr import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents"), window)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op4_simhash(spark, sf_dir, shingle: int = 3, max_bits: int = 3):
    from panelkit.llm.simhash import near_duplicates

    out = near_duplicates(table(spark, sf_dir, "documents"), shingle, max_bits)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_quality(spark, sf_dir):
    from panelkit.llm.quality import score_quality

    out = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", F.round("p_quality", 6).alias("p_quality"), F.round("p_toxic", 6).alias("p_toxic"), F.col("keep").alias("kept"))


@query
def op8_language_id(spark, sf_dir):
    from panelkit.llm.langid import fit, identify, training_rows

    docs = table(spark, sf_dir, "documents")
    out = identify(docs, fit(docs.where(training_rows())))
    return out.select("doc_id", (~training_rows()).alias("held_out"), "lang_pred", "score", "entropy", "rejected")


@query
def op7_embedding_dedup(spark, sf_dir, threshold: float = 0.93):
    from panelkit.llm.lattice import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold)


@query
def op9_decontamination(spark, sf_dir, similarity: float = 0.8, radius: int = 19):
    from panelkit.llm.decontam import find_leaks

    out = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), similarity=similarity, radius=radius)
    return out.select("doc_id", (F.size("matches") > 0).alias("contaminated"), F.array_sort(F.col("matches.item")).alias("item_ids"),
                      F.round(F.array_max(F.col("matches.similarity")), 6).alias("similarity"))


@query
def op5_html_extraction(spark, sf_dir):
    from panelkit.llm.htmlx import extract

    out = extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op6_lm_scores(spark, sf_dir):
    from panelkit.llm.maxent import score_texts

    return score_texts(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


@query
def op11_source_mixing(spark, sf_dir):
    from panelkit.llm.mixing import mixture

    out = mixture(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


@query
def op12_centroids(spark, sf_dir):
    from panelkit.llm.centroids import cluster, report

    return report(cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, seed=3))


@query
def op13_fill_in_middle(spark, sf_dir):
    from panelkit.llm.fim import digests, pieces, restore

    return digests(restore(pieces(table(spark, sf_dir, "documents"), seed=42, share=50, spm_share=80)))


ORACLES["op2_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS p FROM w WHERE len(ws) >= 50),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS s FROM p),
f AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 49)) AS i FROM win JOIN f USING (s) WHERE m < doc_id),
x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) FILTER (g.i IS NULL) AS kept, count(g.i) AS n_removed FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.i = g.i GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id"""

ORACLES["op7_embedding_dedup"] = """
WITH RECURSIVE u AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r(node, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""

ORACLES["op11_source_mixing"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST(CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))), 1, 13) AS BIGINT) AS DOUBLE) / CAST(4503599627370496 AS DOUBLE) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
r(k, words, weight) AS (SELECT 0, CAST(sum(source_size) AS HUGEINT), CAST(sum(w) AS HUGEINT) FROM s
  UNION ALL
  SELECT k + 1, CAST(sum(CASE WHEN 3 * source_size * weight <= w * words THEN -2 * source_size ELSE source_size END) AS HUGEINT),
    CAST(sum(CASE WHEN 3 * source_size * weight <= w * words THEN 0 ELSE w END) AS HUGEINT) FROM r, s WHERE k < 60 AND weight > 0 GROUP BY k),
e AS (SELECT arg_max(words, k) AS words, arg_max(weight, k) AS weight FROM r WHERE weight > 0),
t AS (SELECT source, source_size, CASE WHEN 3 * source_size * weight <= w * words THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(w AS DOUBLE) * CAST(words AS DOUBLE) / CAST(weight AS DOUBLE) END AS target FROM s, e),
u AS (SELECT *, least(coalesce(target / nullif(CAST(source_size AS DOUBLE), 0), 0), 3) AS rate FROM t)
SELECT doc_id, size, source_size, target, size * c AS taken, CAST(c AS INTEGER) AS copies FROM (
  SELECT d.*, source_size, target, CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS c FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)"""

_ROUND = """
g{n} AS MATERIALIZED (SELECT id, d, c FROM (SELECT x.id, m.c, sum((x.x - m.x) * (x.x - m.x)) AS d, row_number() OVER (PARTITION BY x.id ORDER BY sum((x.x - m.x) * (x.x - m.x)), m.c) AS p
  FROM x JOIN m{n} m USING (i) GROUP BY x.id, m.c) WHERE p = 1)"""
_MOVE = """,
m{to} AS MATERIALIZED (SELECT m.c, m.i, coalesce(s.x, m.x) AS x FROM m{n} m LEFT JOIN (
  SELECT g.c, x.i, CAST((sum(x.x) - ((sum(x.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM g{n} g JOIN x USING (id) GROUP BY g.c, x.i) s ON s.c = m.c AND s.i = m.i),"""
ORACLES["op12_centroids"] = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda y: CAST(floor(1024 * CAST(y AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y) OR abs(y) > 131072)) = 0),
x AS MATERIALIZED (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
m0 AS MATERIALIZED (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM v) WHERE c < 8),""" + "".join(
    _ROUND.format(n=n) + (_MOVE.format(n=n, to=n + 1) if n < 10 else "") for n in range(11)) + """
SELECT v.vec_id, CAST(g.c AS INTEGER) AS cluster, CAST(g.d AS BIGINT) AS distance, CAST(sum(g.d) OVER (PARTITION BY g.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(g.d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM v JOIN g10 g USING (id) JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM m10 GROUP BY c) h ON h.c = g.c"""

ORACLES["op13_fill_in_middle"] = r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
  sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
n AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
    WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(u[greatest(a, b) + 1:], '') AS suffix FROM n)
SELECT doc_id, n, form, CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars, CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM p"""


def all_queries() -> dict:
    from corpus_pipeline import run

    return QUERIES | {"pipeline": run}


def all_oracles() -> dict[str, str]:
    from corpus_pipeline import ORACLE_SQL

    return ORACLES | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
