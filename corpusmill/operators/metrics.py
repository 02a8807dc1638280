"""Corpus metrics: word and n-gram frequencies, TF-IDF, length statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import text as T
from corpusmill.scratch import cut

# fixed values
SPANISH_STOPWORDS = (
    "al algo algunas algunos ante antes como con contra cual cuando de del desde donde durante el ella ellas ellos en entre era eran eres es esa esas ese eso esos esta estaba estado están estar estas este esto estos está fue fueron ha han hasta hay la las le les lo los me mi mis mucho muchos muy más ni no nos o os otra otras otro otros para pero poco por porque que quien qué se sea ser si sin sobre son su sus sí también tanto te tiene todo todos tu tus un una unas uno unos y ya yo él"
).split()


def spanish_tokens(c: Column) -> Column:
    """Alphabetic words of three letters or more, lower-cased, without stopwords."""
    words = F.regexp_extract_all(F.lower(c), F.lit("([a-záéíóúüñ]+)"), F.lit(1))
    return F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(SPANISH_STOPWORDS))


def frequencies(docs: DataFrame, tokens: Column, label: str, top: int, n: int = 1) -> DataFrame:
    """label, count, pct: the most frequent runs of n tokens of docs (doc_pos, ...), with their share of all runs.

    Equal counts: the one that comes first.  Runs never cross documents; no tokens give no rows."""
    runs = tokens if n == 1 else T.runs(tokens, n)
    flat = docs.select("doc_pos", F.posexplode(runs).alias("at", label))
    counted = flat.groupBy(label).agg(F.count("*").alias("count"), F.min(F.struct("doc_pos", "at")).alias("first"))
    total = counted.agg(F.sum("count").alias("total"))
    best = counted.orderBy(F.desc("count"), "first").limit(top)
    return best.crossJoin(F.broadcast(total)).select(label, "count", T.half_even(F.col("count") * 100.0 / F.col("total"), 3).alias("pct"))


def tfidf(docs: DataFrame, tokens: Column, max_features: int = 5000) -> DataFrame:
    """doc_id, term, tfidf: 1 + ln(count), times ln((1 + N) / (1 + df)) + 1, rows scaled to length 1, over the most frequent terms."""
    base = docs.select("doc_id", F.explode(tokens).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("c"))
    stats = base.groupBy("term").agg(F.sum("c").alias("total"), F.count("*").alias("df")).orderBy(F.desc("total"), "term").limit(max_features)
    n = docs.agg(F.count("*").alias("n"))
    idf = stats.crossJoin(F.broadcast(n)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    w = base.join(F.broadcast(idf), "term").select("doc_id", "term", ((1 + F.log("c")) * F.col("idf")).alias("w"))  # max_features rows
    norm = w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, "doc_id").select("doc_id", "term", (F.col("w") / F.col("norm")).alias("tfidf"))


def top_terms(docs: DataFrame, weights: DataFrame, top: int = 30) -> DataFrame:
    """term, mean_tfidf over all documents, those without the term included."""
    n = docs.agg(F.count("*").alias("n"))
    mean = weights.groupBy("term").agg(F.sum("tfidf").alias("s")).crossJoin(F.broadcast(n)).select("term", T.half_even(F.col("s") / F.col("n"), 5).alias("mean_tfidf"))
    return mean.orderBy(F.desc("mean_tfidf"), F.desc("term")).limit(top)


def profile(docs: DataFrame) -> DataFrame:
    """doc_id, word_count, char_count, chars_per_word (2 digits, half even; null without words)."""
    return docs.select("doc_id", T.word_count(F.col("text")).alias("word_count"), F.length("text").alias("char_count")).withColumn("chars_per_word", F.rint(F.try_divide("char_count", "word_count") * 100) / 100)


def describe(df: DataFrame, column: str) -> DataFrame:
    values = narrow(df, column)
    n, x, rows = F.sum("rows"), F.col("value"), F.col("rows")
    mean = F.sum(x * rows) / n
    q = lambda p, name: F.round(quantile(p), 1).alias(name)
    s = values.agg(n.alias("count"), mean.alias("m"), F.min(x).alias("min"), q(0.25, "q25"), q(0.5, "q50"), q(0.75, "q75"), F.max(x).alias("max"))
    # deviations from the mean, so that large counts keep their digits
    spread = values.crossJoin(F.broadcast(s.select("m", "count"))).agg(F.sqrt(F.sum((x - F.col("m")) ** 2 * rows) / F.nullif(F.max("count") - 1, F.lit(0))).alias("sd"))
    kind = dict(df.dtypes)[column]
    return s.crossJoin(F.broadcast(spread)).select("count", F.round("m", 1).alias("mean"), F.round("sd", 1).alias("std"), F.col("min").cast(kind).alias("min"), "q25", "q50", "q75", F.col("max").cast(kind).alias("max"))


def beyond_p95(df: DataFrame, column: str) -> DataFrame:
    """median, p95 and the number of rows beyond it."""
    values = narrow(df, column)
    q = values.agg(quantile(0.5).alias("median"), quantile(0.95).alias("p95"))
    return values.crossJoin(F.broadcast(q)).groupBy("median", "p95").agg(F.coalesce(F.sum(F.when(F.col("value") > F.col("p95"), F.col("rows"))), F.lit(0)).alias("beyond"))


def narrow(df: DataFrame, column: str) -> DataFrame:
    """value, rows: how often each value occurs, written once.  Counts have few values; what follows reads no text again."""
    return cut(df.groupBy(F.col(column).cast("double").alias("value")).agg(F.count("*").alias("rows")).filter("value is not null"))


def quantile(p: float):
    return F.percentile("value", p, F.col("rows"))


def histogram(df: DataFrame, column: str, bins: int | None = None, clipped: bool = True) -> DataFrame:
    """bin, rows: equal bins over the values up to the 95th percentile (all values if not clipped); the last one is closed.

    Without a number of bins their width is 2 IQR / n^(1/3)."""
    values = narrow(df, column)
    kept = values
    if clipped:
        kept = values.crossJoin(F.broadcast(values.agg(quantile(0.95).alias("p95")))).filter("value <= p95")
    s = kept.agg(F.min("value").alias("lo"), F.max("value").alias("hi"), (quantile(0.75) - quantile(0.25)).alias("iqr"), F.sum("rows").alias("n"))
    by_width = F.when(F.col("iqr") > 0, F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo")) / (2 * F.col("iqr") / F.pow("n", F.lit(1 / 3)))))).otherwise(F.lit(1))
    s = s.withColumn("bins", (F.lit(bins) if bins else by_width).cast("long"))
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("bins")), F.col("bins") - 1))
    return kept.crossJoin(F.broadcast(s)).groupBy(at.cast("long").alias("bin")).agg(F.sum("rows").alias("rows"))


def mean_ratio(df: DataFrame, column: str = "chars_per_word") -> DataFrame:
    """mean: of the values that are not null, 0 if there are none; 2 digits, half even."""
    return df.agg(F.coalesce(T.half_even(F.avg(column), 2), F.lit(0.0)).alias("mean"))


def gates(df: DataFrame, terms: DataFrame, column: str = "word_count") -> DataFrame:
    """documents, terms, and whether there is enough for distributions (two documents), a heat map (and a term) and a density
    curve (two distinct values up to the 95th percentile)."""
    values = narrow(df, column)
    below = values.crossJoin(F.broadcast(values.agg(quantile(0.95).alias("p95")))).filter("value <= p95").agg((F.count("*") > 1).alias("density"))
    counts = df.agg(F.count("*").alias("documents")).crossJoin(F.broadcast(terms.agg(F.count("*").alias("terms")))).crossJoin(F.broadcast(below))
    enough = F.col("documents") >= 2
    return counts.select("documents", "terms", enough.alias("distributions"), (enough & (F.col("terms") >= 1)).alias("heatmap"), "density")


def head(df: DataFrame, n: int = 15, *order) -> DataFrame:
    """The first n rows of a report in an order of columns."""
    return df.orderBy(*order).limit(n)


def pivoted(weights: DataFrame, terms: list[str], stems: DataFrame) -> DataFrame:
    """stem and a column for each of terms: the weights (doc_id, term, tfidf), 0 where a document lacks a term; stems:
    (doc_id, filename), labels without the suffix."""
    named = weights.join(stems.select("doc_id", F.regexp_replace("filename", r"\.[^.]*\z", "").alias("stem")), "doc_id")
    wide = named.groupBy("stem").pivot("term", terms).agg(F.first("tfidf"))
    return wide.fillna(0.0, terms)


def extremes(df: DataFrame, n: int = 10, longest: bool = False) -> DataFrame:
    """The n rows of fewest (most) words, in ascending order."""
    w = Window.orderBy("word_count", "doc_id")
    if longest:
        df = df.orderBy(F.desc("word_count"), F.desc("doc_id")).limit(n)
        return df.withColumn("rank", F.row_number().over(w))
    return df.orderBy("word_count", "doc_id").limit(n).withColumn("rank", F.row_number().over(w))


def lexicon(docs: DataFrame) -> DataFrame:
    """word, lang, zipf: log10 of occurrences in a billion words of the language, 2 digits."""
    flat = docs.select("lang", F.explode(T.tokens(F.lower("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("c"))
    total = flat.groupBy("lang").agg(F.sum("c").alias("t"))
    return flat.join(F.broadcast(total), "lang").select("word", "lang", F.round(F.log10(F.col("c") / F.col("t") * 1e9), 2).alias("zipf"))
