"""Queries of the corpus metrics."""

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import metrics as M
from corpusmill.plans.registry import WORDS, docs, query, table

STOP = ", ".join(f"'{w}'" for w in M.SPANISH_STOPWORDS)
ES = f"es AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-záéíóúüñ]+'), lambda w: length(w) >= 3 AND w NOT IN ({STOP})) AS t FROM documents WHERE lang = 'es')"


def spanish(spark, sf_dir):
    return docs(spark, sf_dir).filter("lang = 'es'")


def top_sql(n: int, label: str, top: int) -> str:
    return f"""WITH {ES}, g AS (SELECT doc_id, i, array_to_string(t[i:i + {n - 1}], ' ') AS {label} FROM (SELECT doc_id, t, unnest(range(1, len(t) - {n - 2})) AS i FROM es WHERE len(t) >= {n})),
c AS (SELECT {label}, count(*) AS count, min(doc_id * 1000000 + i) AS first FROM g GROUP BY 1)
SELECT {label}, count, round_even(count * 100.0 / (SELECT sum(count) FROM c), 3) AS pct FROM c ORDER BY count DESC, first LIMIT {top}"""


@query(top_sql(1, "word", 50))
def top_words(spark, sf_dir):
    return M.frequencies(spanish(spark, sf_dir), M.spanish_tokens(F.col("text")), "word", 50)


@query(top_sql(2, "ngram", 20))
def top_bigrams(spark, sf_dir):
    return M.frequencies(spanish(spark, sf_dir), M.spanish_tokens(F.col("text")), "ngram", 20, 2)


@query(top_sql(3, "ngram", 20))
def top_trigrams(spark, sf_dir):
    return M.frequencies(spanish(spark, sf_dir), M.spanish_tokens(F.col("text")), "ngram", 20, 3)


TFIDF = f"""{ES}, b AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest(t) AS term FROM es) GROUP BY 1, 2),
v AS (SELECT term, sum(c) AS total, count(*) AS df FROM b GROUP BY 1 ORDER BY total DESC, term LIMIT 5000),
w AS (SELECT doc_id, b.term, (1 + ln(c)) * (ln((1 + (SELECT count(*) FROM es)) / (1 + df)) + 1) AS w FROM b JOIN v ON v.term = b.term),
f AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM w),
top AS (SELECT term, round_even(sum(tfidf) / (SELECT count(*) FROM es), 5) AS mean_tfidf FROM f GROUP BY 1 ORDER BY mean_tfidf DESC, term DESC LIMIT 30)"""


@query(f"WITH {TFIDF} SELECT * FROM top")
def tfidf_top_terms(spark, sf_dir):
    d = spanish(spark, sf_dir)
    return M.top_terms(d, M.tfidf(d, M.spanish_tokens(F.col("text"))))


@query(f"""WITH {TFIDF}, s AS (SELECT doc_id FROM es ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 40)
SELECT s.doc_id, top.term, round(coalesce(f.tfidf, 0), 5) AS tfidf FROM s CROSS JOIN top LEFT JOIN f ON f.doc_id = s.doc_id AND f.term = top.term""")
def tfidf_heatmap_sample(spark, sf_dir):
    d = spanish(spark, sf_dir)
    weights = M.tfidf(d, M.spanish_tokens(F.col("text")))
    sample = d.select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(40)
    grid = sample.crossJoin(F.broadcast(M.top_terms(d, weights).select("term")))  # 40 x 30 rows
    return grid.join(weights, ["doc_id", "term"], "left").select("doc_id", "term", F.round(F.coalesce("tfidf", F.lit(0.0)), 5).alias("tfidf"))


PROFILE = f"p AS (SELECT doc_id, {WORDS} AS word_count, length(text) AS char_count FROM documents)"


@query(f"WITH {PROFILE} SELECT doc_id, word_count::INT AS word_count, char_count::INT AS char_count, CASE WHEN word_count > 0 THEN round_even(char_count / word_count * 100, 0) / 100 END AS chars_per_word FROM p")
def meta_enriched(spark, sf_dir):
    return M.profile(docs(spark, sf_dir))


@query(f"WITH {PROFILE} SELECT count(*) AS documents, sum(word_count)::BIGINT AS words, sum(char_count)::BIGINT AS chars, (SELECT count(DISTINCT source) FROM documents) AS sources FROM p")
def corpus_overview(spark, sf_dir):
    d = docs(spark, sf_dir).select("source", T.word_count(F.col("text")).alias("w"), F.length("text").alias("c"))
    return d.agg(F.count("*").alias("documents"), F.sum("w").alias("words"), F.sum("c").alias("chars"), F.count_distinct("source").alias("sources"))


@query(f"""WITH {PROFILE} SELECT count(*) AS count, round(avg(word_count), 1) AS mean, round(stddev_samp(word_count), 1) AS std, min(word_count)::INT AS min,
round(quantile_cont(word_count, 0.25), 1) AS q25, round(quantile_cont(word_count, 0.5), 1) AS q50, round(quantile_cont(word_count, 0.75), 1) AS q75, max(word_count)::INT AS max FROM p""")
def describe_counts(spark, sf_dir):
    return M.describe(M.profile(docs(spark, sf_dir)), "word_count")


@query(f"""WITH {PROFILE}, q AS (SELECT quantile_cont(word_count, 0.5) AS median, quantile_cont(word_count, 0.95) AS p95 FROM p)
SELECT median, p95, count(*) FILTER (word_count > p95) AS beyond FROM p, q GROUP BY median, p95""")
def p95_clipped(spark, sf_dir):
    return M.beyond_p95(M.profile(docs(spark, sf_dir)), "word_count")


@query(f"""WITH {PROFILE}, k AS (SELECT word_count::DOUBLE AS x FROM p WHERE word_count <= (SELECT quantile_cont(word_count, 0.95) FROM p)),
s AS (SELECT min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr, count(*) AS n FROM k),
b AS (SELECT *, CASE WHEN iqr > 0 THEN greatest(1, ceil((hi - lo) / (2 * iqr / pow(n, 1 / 3)))) ELSE 1 END AS bins FROM s)
SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / (hi - lo) * bins), bins - 1) END::BIGINT AS bin, count(*) AS rows FROM k, b GROUP BY 1""")
def length_histogram(spark, sf_dir):
    return M.histogram(M.profile(docs(spark, sf_dir)), "word_count")


@query(f"WITH {PROFILE}, t AS (SELECT doc_id, word_count FROM p ORDER BY word_count, doc_id LIMIT 10) SELECT doc_id, word_count::INT AS word_count, row_number() OVER (ORDER BY word_count, doc_id)::INT AS rank FROM t")
def quality_shortest(spark, sf_dir):
    return M.extremes(M.profile(docs(spark, sf_dir)).select("doc_id", "word_count"))


@query(f"WITH {PROFILE}, t AS (SELECT doc_id, word_count FROM p ORDER BY word_count DESC, doc_id DESC LIMIT 10) SELECT doc_id, word_count::INT AS word_count, row_number() OVER (ORDER BY word_count, doc_id)::INT AS rank FROM t")
def quality_longest(spark, sf_dir):
    return M.extremes(M.profile(docs(spark, sf_dir)).select("doc_id", "word_count"), longest=True)


@query("SELECT doc_id, source, n_chars FROM documents WHERE source IN ('src1', 'src2')")
def selection_filter(spark, sf_dir):
    from corpusmill.sources.files import select_documents

    d = docs(spark, sf_dir).withColumn("domain", F.col("source"))
    return select_documents(d, "domain", ["src1", "src2"]).select("doc_id", "source", "n_chars")


@query(f"WITH {ES} SELECT doc_id, len(t)::INT AS kept, md5(array_to_string(t, ' ')) AS kept_md5 FROM es")
def stopword_filter(spark, sf_dir):
    d = spanish(spark, sf_dir).select("doc_id", M.spanish_tokens(F.col("text")).alias("t"))
    return d.select("doc_id", F.size("t").alias("kept"), F.md5(F.array_join("t", " ").cast("binary")).alias("kept_md5"))


@query(r"""WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents), c AS (SELECT lang, word, count(*) AS c FROM w GROUP BY 1, 2)
SELECT word, lang, round(log10(c / (sum(c) OVER (PARTITION BY lang)) * 1e9), 2) AS zipf FROM c""")
def lexicon_zipf(spark, sf_dir):
    return M.lexicon(table(spark, sf_dir, "documents"))


@query("SELECT quality, toxic, count(*) AS documents, sum(n_chars)::BIGINT AS chars FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2")
def quality_label_join(spark, sf_dir):
    """Extension: the labels have no counterpart among the corpus operators."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    return d.groupBy("quality", "toxic").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))


@query(f"WITH {PROFILE} SELECT coalesce(round_even(avg(CASE WHEN word_count > 0 THEN round_even(char_count / word_count * 100, 0) / 100 END), 2), 0) AS mean FROM p")
def mean_chars_per_word(spark, sf_dir):
    return M.mean_ratio(M.profile(docs(spark, sf_dir)))


@query(f"""WITH {PROFILE}, {TFIDF}, k AS (SELECT word_count FROM p WHERE word_count <= (SELECT quantile_cont(word_count, 0.95) FROM p))
SELECT (SELECT count(*) FROM p) AS documents, (SELECT count(*) FROM top) AS terms, (SELECT count(*) >= 2 FROM p) AS distributions,
(SELECT count(*) >= 2 FROM p) AND (SELECT count(*) >= 1 FROM top) AS heatmap, (SELECT count(DISTINCT word_count) > 1 FROM k) AS density""")
def plot_gates(spark, sf_dir):
    d = spanish(spark, sf_dir)
    return M.gates(M.profile(docs(spark, sf_dir)), M.top_terms(d, M.tfidf(d, M.spanish_tokens(F.col("text")))))


@query(f"""WITH {PROFILE}, x AS (SELECT round_even(char_count / word_count * 100, 0) / 100 AS x FROM p WHERE word_count > 0), s AS (SELECT min(x) AS lo, max(x) AS hi FROM x)
SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / (hi - lo) * 40), 39) END::BIGINT AS bin, count(*) AS rows FROM x, s GROUP BY 1""")
def chars_per_word_histogram(spark, sf_dir):
    return M.histogram(M.profile(docs(spark, sf_dir)), "chars_per_word", bins=40, clipped=False)


@query(f"SELECT * FROM ({top_sql(1, 'word', 50)}) ORDER BY count DESC, word LIMIT 15")
def top_words_head(spark, sf_dir):
    """The first 15 rows of the report of 50."""
    return M.head(M.frequencies(spanish(spark, sf_dir), M.spanish_tokens(F.col("text")), "word", 50), 15, F.desc("count"), "word")
