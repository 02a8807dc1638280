"""Queries of the semantic stage from texts, and of the whole way through cleaning and all stages."""

from pyspark.sql import functions as F

from corpusmill.operators import dedup as D
from corpusmill.operators import process as P
from corpusmill.operators import semantic as S
from corpusmill.operators.clean import clean
from corpusmill.plans.clean import SOURCE, joiner_sql, noise_sql, punctuation_sql, source, space_sql
from corpusmill.plans.dedup import BEST, SHINGLES
from corpusmill.plans.registry import COMPONENTS, EXACT, EXACT_CTE, TOKENS, WORDS, docs, query, strip

T_SEMANTIC = 0.92


def vectors_sql(src: str) -> str:
    """CTEs from src (doc_id, text) to sem (mutual neighbours of like length that reach the threshold)."""
    return f"""tk AS (SELECT doc_id, {TOKENS} AS t FROM {src}),
hit AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 2))::INT AS b, count(*) AS c FROM (SELECT doc_id, unnest(t) AS w FROM tk WHERE len(t) >= 50) GROUP BY 1, 2),
vec AS (SELECT tk.doc_id, any_value(len(tk.t)) AS n, list(coalesce(hit.c, 0)::DOUBLE / ((len(tk.t) + 199) // 200) ORDER BY r.b) AS v
  FROM tk CROSS JOIN range(256) r(b) LEFT JOIN hit ON hit.doc_id = tk.doc_id AND hit.b = r.b WHERE len(tk.t) >= 50 GROUP BY tk.doc_id),
sim AS (SELECT a.doc_id AS src, b.doc_id AS dst, round(list_cosine_similarity(a.v, b.v), 9) AS s, least(a.n, b.n) / greatest(a.n, b.n) AS ratio FROM vec a JOIN vec b ON a.doc_id <> b.doc_id),
knn AS (SELECT src, dst, s, ratio FROM sim QUALIFY row_number() OVER (PARTITION BY src ORDER BY s DESC, dst) <= 10),
mutual AS (SELECT x.src AS l, x.dst AS r, x.s AS sim, x.ratio FROM knn x JOIN knn y ON x.src = y.dst AND x.dst = y.src WHERE x.src < x.dst)"""


def prefixed(sql: str, p: str) -> str:
    """COMPONENTS and BEST over a table of pairs of another name."""
    for name in ("pairs", "sym", "reach", "roots", "best2", "best"):
        sql = sql.replace(f"{name} AS", f"{p}_{name} AS").replace(f"FROM {name}", f"FROM {p}_{name}").replace(f"JOIN {name}", f"JOIN {p}_{name}").replace(f"{name}.", f"{p}_{name}.")
    return sql


SEMANTIC = f"""{vectors_sql('survivors')},
pairs AS (SELECT l, r, sim FROM mutual WHERE ratio >= 0.7 AND sim >= {T_SEMANTIC}), {BEST}, {COMPONENTS},
report AS (SELECT tk.doc_id, coalesce(canonical, tk.doc_id) AS canonical_doc_id, coalesce(canonical, tk.doc_id) <> tk.doc_id AS is_duplicate,
  CASE WHEN len(tk.t) < 50 THEN 'skipped_short_document' ELSE 'semantic_embedding_cosine' END AS match_type, candidate_doc_id, round_even(sim, 6) AS semantic_similarity, {T_SEMANTIC}::DOUBLE AS threshold
  FROM tk LEFT JOIN roots USING (doc_id) LEFT JOIN best2 USING (doc_id))"""


def stage(spark, sf_dir):
    return S.semantic_from_text(D.exact_survivors(docs(spark, sf_dir)), S.TokenHashes(), threshold=T_SEMANTIC)


@query(f"WITH RECURSIVE {EXACT_CTE}, {SEMANTIC} SELECT * FROM report")
def semantic_from_text_report(spark, sf_dir):
    return stage(spark, sf_dir)[0]


@query(f"""WITH RECURSIVE {EXACT_CTE}, {SEMANTIC} SELECT count(*) AS documents_scanned, count(*) FILTER (match_type = 'skipped_short_document') AS documents_skipped_short,
(SELECT count(*) FROM mutual) AS candidate_pairs_evaluated, count(*) FILTER (is_duplicate) AS duplicate_documents,
count(DISTINCT CASE WHEN is_duplicate THEN canonical_doc_id END) AS duplicate_groups, 'token-hashes-256' AS model_name, 10 AS top_k, {T_SEMANTIC}::DOUBLE AS threshold FROM report""")
def semantic_dedup_summary(spark, sf_dir):
    return stage(spark, sf_dir)[1]


CLEANED = f"""{SOURCE}, pre AS (SELECT doc_id, {space_sql(noise_sql('text'))} AS text FROM src), {joiner_sql('pre')},
cleaned AS (SELECT doc_id, {punctuation_sql('text')} AS text FROM joined)"""

STAGES = f"""{CLEANED},
good AS (SELECT doc_id, text FROM cleaned WHERE length({strip('text')}) >= 100),
h AS (SELECT doc_id, text, sha256({EXACT}) AS hash FROM good),
exact AS (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY hash) AS canonical_doc_id FROM h),
survivors AS (SELECT doc_id, text FROM exact WHERE doc_id = canonical_doc_id), {SHINGLES},
long AS (SELECT s.* FROM s JOIN t USING (doc_id) WHERE len(t.t) >= 30),
size AS (SELECT doc_id, count(*) AS n FROM long GROUP BY doc_id),
shared AS (SELECT a.doc_id AS l, b.doc_id AS r, count(*) AS k FROM long a JOIN long b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
near_pairs AS (SELECT l, r, k / (x.n + y.n - k) AS sim FROM shared JOIN size x ON x.doc_id = l JOIN size y ON y.doc_id = r WHERE k / (x.n + y.n - k) >= 0.85),
{prefixed(COMPONENTS, 'near')},
kept AS (SELECT doc_id, text FROM survivors WHERE doc_id NOT IN (SELECT doc_id FROM near_roots WHERE canonical <> doc_id)),
{vectors_sql('kept')},
sem_pairs AS (SELECT l, r, sim FROM mutual WHERE ratio >= 0.7 AND sim >= {T_SEMANTIC}), {prefixed(COMPONENTS, 'sem')},
fate AS (SELECT c.doc_id, CASE WHEN c.text IS NULL THEN 'missing' WHEN g.doc_id IS NULL THEN 'short' WHEN e.doc_id <> e.canonical_doc_id THEN 'exact' WHEN k.doc_id IS NULL THEN 'near'
  WHEN coalesce(m.canonical, c.doc_id) <> c.doc_id THEN 'semantic' ELSE 'kept' END AS fate, CASE WHEN g.doc_id IS NOT NULL THEN {WORDS.replace('text', 'c.text')} END::INT AS word_count
  FROM cleaned c LEFT JOIN good g USING (doc_id) LEFT JOIN exact e USING (doc_id) LEFT JOIN kept k USING (doc_id) LEFT JOIN sem_roots m USING (doc_id))"""


def whole(spark, sf_dir):
    """documents and the cleaning fixtures as articles; their texts are plain, so cleaning starts behind the markup step."""
    articles = source(spark, sf_dir).select(F.col("doc_id"), F.col("doc_id").alias("doc_pos"), F.col("doc_id").cast("string").alias("url_slug"), F.col("text").alias("content"))
    return articles, P.process(articles, text_of=clean, semantic_threshold=T_SEMANTIC)


@query(f"WITH RECURSIVE {STAGES} SELECT doc_id, fate, word_count FROM fate")
def process_report(spark, sf_dir):
    """What becomes of each article: missing, short, a duplicate of a stage, or kept."""
    articles, p = whole(spark, sf_dir)
    gone = lambda df, name: df.filter("is_duplicate").select("doc_id", F.lit(name).alias("stage"))
    stages = gone(p.exact, "exact").union(gone(p.near, "near")).union(gone(p.semantic, "semantic"))
    counts = p.metadata.select("doc_id", "word_count", F.lit(True).alias("good")).join(stages, "doc_id", "left")
    fate = F.when(F.col("content").isNull(), "missing").when(F.col("good").isNull(), "short").otherwise(F.coalesce("stage", F.lit("kept")))
    return articles.select("doc_id", "content").join(counts, "doc_id", "left").select("doc_id", fate.alias("fate"), "word_count")


@query(f"WITH RECURSIVE {STAGES} SELECT fate, count(*) AS articles, sum(word_count)::BIGINT AS words FROM fate GROUP BY fate")
def process_summary(spark, sf_dir):
    return process_report(spark, sf_dir).groupBy("fate").agg(F.count("*").alias("articles"), F.sum("word_count").alias("words"))
