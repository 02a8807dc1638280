"""Queries of the duplicate stages."""

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import dedup as D
from corpusmill.plans.registry import COMPONENTS, EXACT, EXACT_CTE, TOKENS, docs, query, table
from corpusmill.scratch import cut

T_NEAR = 0.5


@query(f"WITH {EXACT_CTE} SELECT doc_id, canonical_doc_id, doc_id <> canonical_doc_id AS is_duplicate, 'exact_text_hash' AS match_type, hash FROM exact")
def exact_dedup_report(spark, sf_dir):
    return D.exact_report(docs(spark, sf_dir))


@query(f"""WITH {EXACT_CTE} SELECT count(*) AS documents_scanned, count(*) FILTER (doc_id = canonical_doc_id) AS unique_documents,
count(*) FILTER (doc_id <> canonical_doc_id) AS duplicate_documents, count(DISTINCT CASE WHEN doc_id <> canonical_doc_id THEN canonical_doc_id END) AS duplicate_groups FROM exact""")
def exact_dedup_summary(spark, sf_dir):
    return D.exact_summary(D.exact_report(docs(spark, sf_dir)))


@query(f"WITH {EXACT_CTE} SELECT doc_id, lang, source FROM survivors")
def exact_dedup_survivors(spark, sf_dir):
    return D.exact_survivors(docs(spark, sf_dir)).select("doc_id", "lang", "source")


@query(f"SELECT doc_id, sha256({EXACT}) AS hash FROM documents")
def normalize_exact_hash(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.sha2(T.exact_form(F.col("text")), 256).alias("hash"))


@query(f"WITH t AS (SELECT doc_id, {TOKENS} AS t FROM documents) SELECT doc_id, len(t)::INT AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM t")
def near_tokens(spark, sf_dir):
    t = docs(spark, sf_dir).select("doc_id", T.tokens(T.near_form(F.col("text"))).alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ").cast("binary")).alias("tokens_md5"))


SHINGLES = f"""t AS (SELECT doc_id, {TOKENS} AS t FROM survivors),
s AS (SELECT DISTINCT doc_id, array_to_string(t[i:i + 4], ' ') AS s FROM (SELECT doc_id, t, unnest(range(1, len(t) - 3)) AS i FROM t WHERE len(t) >= 5))"""


@query(f"WITH {EXACT_CTE}, {SHINGLES} SELECT t.doc_id, len(t.t)::INT AS n_tokens, coalesce(n, 0)::INT AS n_shingles FROM t LEFT JOIN (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id) c ON c.doc_id = t.doc_id")
def shingle_counts(spark, sf_dir):
    return D.shingles_of(D.exact_survivors(docs(spark, sf_dir))).select("doc_id", "n_tokens", F.size("shingles").alias("n_shingles"))


def pairs_sql(t: float) -> str:
    return f"""{EXACT_CTE}, {SHINGLES},
long AS (SELECT s.* FROM s JOIN t USING (doc_id) WHERE len(t.t) >= 30),
n AS (SELECT doc_id, count(*) AS n FROM long GROUP BY doc_id),
shared AS (SELECT a.doc_id AS l, b.doc_id AS r, count(*) AS k FROM long a JOIN long b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
pairs AS (SELECT l, r, k / (x.n + y.n - k) AS sim FROM shared JOIN n x ON x.doc_id = l JOIN n y ON y.doc_id = r WHERE k / (x.n + y.n - k) >= {t})"""


def near_sets(spark, sf_dir):
    return D.shingles_of(D.exact_survivors(docs(spark, sf_dir)))


def long_pairs(sets, t=T_NEAR):
    return D.jaccard_pairs(sets.filter("n_tokens >= 30 and size(shingles) > 0"), t)


@query(f"WITH {pairs_sql(T_NEAR)} SELECT l AS left_id, r AS right_id, round_even(sim, 6) AS jaccard FROM pairs")
def near_pairs_jaccard(spark, sf_dir):
    return long_pairs(near_sets(spark, sf_dir)).select("left_id", "right_id", T.half_even(F.col("similarity"), 6).alias("jaccard"))


BEST = "best AS (SELECT doc_id, arg_max(other, sim) AS x, max(sim) AS sim FROM (SELECT l AS doc_id, r AS other, sim FROM pairs UNION ALL SELECT r, l, sim FROM pairs) GROUP BY doc_id),\nbest2 AS (SELECT b.doc_id, min(p.other) AS candidate_doc_id, any_value(b.sim) AS sim FROM best b JOIN (SELECT l AS doc_id, r AS other, sim FROM pairs UNION ALL SELECT r, l, sim FROM pairs) p ON p.doc_id = b.doc_id AND p.sim = b.sim GROUP BY b.doc_id)"


@query(f"WITH {pairs_sql(T_NEAR)}, {BEST} SELECT doc_id, candidate_doc_id, round_even(sim, 6) AS jaccard FROM best2")
def near_best_match(spark, sf_dir):
    sets = near_sets(spark, sf_dir)
    return D.best_matches(cut(long_pairs(sets)), sets.select("doc_id", "doc_pos")).select("doc_id", "candidate_doc_id", T.half_even(F.col("similarity"), 6).alias("jaccard"))


@query(f"WITH RECURSIVE {pairs_sql(T_NEAR)}, {COMPONENTS} SELECT t.doc_id, coalesce(canonical, t.doc_id) AS canonical_doc_id FROM t LEFT JOIN roots USING (doc_id)")
def near_components(spark, sf_dir):
    sets = near_sets(spark, sf_dir)
    return D.near_components(sets, cut(long_pairs(sets)))


def near_report_sql(t: float) -> str:
    return f"""WITH RECURSIVE {pairs_sql(t)}, {BEST}, {COMPONENTS},
report AS (SELECT t.doc_id, coalesce(canonical, t.doc_id) AS canonical_doc_id, coalesce(canonical, t.doc_id) <> t.doc_id AS is_duplicate,
CASE WHEN len(t.t) < 30 THEN 'skipped_short_document' ELSE 'minhash_lsh_jaccard' END AS match_type, candidate_doc_id, round_even(sim, 6) AS jaccard_similarity, {t}::DOUBLE AS threshold
FROM t LEFT JOIN roots USING (doc_id) LEFT JOIN best2 USING (doc_id))"""


@query(near_report_sql(T_NEAR) + " SELECT * FROM report")
def near_dedup_report(spark, sf_dir):
    return D.near_report(docs(spark, sf_dir), threshold=T_NEAR)


@query(near_report_sql(0.85) + " SELECT * FROM report")
def near_dedup_report_085(spark, sf_dir):
    return D.near_report(docs(spark, sf_dir))


@query(near_report_sql(T_NEAR) + """ SELECT count(*) AS documents_scanned, count(*) FILTER (match_type = 'skipped_short_document') AS documents_skipped_short,
count(*) FILTER (is_duplicate) AS duplicate_documents, count(DISTINCT CASE WHEN is_duplicate THEN canonical_doc_id END) AS duplicate_groups,
(SELECT count(*) FROM pairs) AS candidate_pairs_evaluated, 5 AS shingle_size, 128 AS num_perm, 0.5::DOUBLE AS threshold FROM report""")
def near_dedup_summary(spark, sf_dir):
    return D.near_stage(D.exact_survivors(docs(spark, sf_dir)), threshold=T_NEAR)[1]


@query()
def near_lsh_candidates(spark, sf_dir):
    return D.lsh_candidates(near_sets(spark, sf_dir).filter("n_tokens >= 30"))


def vectors(spark, sf_dir):
    """embeddings as vectors of documents; the number of tokens is made from the id."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("vec_id").alias("doc_pos"), (F.col("vec_id") % 60 + 30).cast("int").alias("n_tokens"), F.col("embedding").cast("array<double>").alias("vector"))


KNN = """v AS (SELECT vec_id AS id, (vec_id % 60 + 30)::INT AS n_tokens, embedding::DOUBLE[] AS v FROM embeddings {where}),
sim AS (SELECT a.id AS src, b.id AS dst, round(list_cosine_similarity(a.v, b.v), 9) AS s FROM v a JOIN v b ON a.id <> b.id),
knn AS (SELECT src, dst, s, row_number() OVER (PARTITION BY src ORDER BY s DESC, dst) AS rank FROM sim QUALIFY rank <= 10),
mutual AS (SELECT x.src AS l, x.dst AS r, x.s AS sim FROM knn x JOIN knn y ON x.src = y.dst AND x.dst = y.src WHERE x.src < x.dst)"""


@query(f"WITH {KNN.format(where='')} SELECT src, dst, round(s, 6) AS cosine, rank::INT AS rank FROM knn")
def knn_topk(spark, sf_dir):
    return D.nearest(vectors(spark, sf_dir)).select("src", "dst", F.round("similarity", 6).alias("cosine"), "rank")


@query(f"WITH {KNN.format(where='')} SELECT l AS a, r AS b FROM mutual")
def mutual_knn(spark, sf_dir):
    return D.mutual(D.nearest(vectors(spark, sf_dir)))


@query(f"WITH {KNN.format(where='')} SELECT l AS left_id, r AS right_id, round(sim, 6) AS cosine FROM mutual JOIN v a ON a.id = l JOIN v b ON b.id = r WHERE least(a.n_tokens, b.n_tokens) / greatest(a.n_tokens, b.n_tokens) >= 0.7 AND sim >= 0.3")
def semantic_pairs(spark, sf_dir):
    return D.semantic_pairs(vectors(spark, sf_dir), threshold=0.3).select("left_id", "right_id", F.round("similarity", 6).alias("cosine"))


@query(f"""WITH RECURSIVE {KNN.format(where='WHERE vec_id % 60 + 30 >= 50')},
pairs AS (SELECT l, r, sim FROM mutual JOIN v a ON a.id = l JOIN v b ON b.id = r WHERE least(a.n_tokens, b.n_tokens) / greatest(a.n_tokens, b.n_tokens) >= 0.7 AND sim >= 0.3),
{BEST}, {COMPONENTS}
SELECT vec_id AS doc_id, coalesce(canonical, vec_id) AS canonical_doc_id, coalesce(canonical, vec_id) <> vec_id AS is_duplicate,
CASE WHEN vec_id % 60 + 30 < 50 THEN 'skipped_short_document' ELSE 'semantic_embedding_cosine' END AS match_type, candidate_doc_id, round_even(sim, 6) AS semantic_similarity, 0.3::DOUBLE AS threshold
FROM embeddings e LEFT JOIN roots ON roots.doc_id = e.vec_id LEFT JOIN best2 ON best2.doc_id = e.vec_id""")
def semantic_dedup_report(spark, sf_dir):
    return D.semantic_report(vectors(spark, sf_dir), threshold=0.3)


@query("""WITH x AS (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
SELECT label, (i - 1)::INT AS at, round(avg(x), 6) AS mean FROM x GROUP BY label, i""")
def vector_average(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("vector"))
    return D.average_vectors(v, "label").select("label", F.posexplode("avg_vector").alias("at", "m")).select("label", "at", F.round("m", 6).alias("mean"))


@query(f"""WITH t AS (SELECT doc_id, {TOKENS} AS t FROM documents)
SELECT doc_id, i::INT AS chunk, md5(array_to_string(t[200 * i + 1:200 * i + 200], ' ')) AS chunk_md5 FROM (SELECT doc_id, t, unnest(range(0, (len(t) + 199) // 200)) AS i FROM t)""")
def chunk_tokens(spark, sf_dir):
    t = docs(spark, sf_dir).select("doc_id", T.tokens(T.near_form(F.col("text"))).alias("t"))
    return t.select("doc_id", F.posexplode(T.chunks(F.col("t"), 200)).alias("chunk", "c")).select("doc_id", "chunk", F.md5(F.col("c").cast("binary")).alias("chunk_md5"))
