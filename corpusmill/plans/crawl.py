"""Queries of the crawl operators, over pages."""

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import crawl as C
from corpusmill.plans.registry import query, table

BASE = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
DOMAIN = r"regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^www\.', '')"
SLUG = f"replace(replace(url, {BASE} || '/', ''), '/', '_')"
EXCLUDED = "(" + " OR ".join("regexp_matches(url, '{}')".format(p) for p in C.EXCLUDE) + ")"


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query(rf"""SELECT page_id, {DOMAIN} AS domain, {BASE} AS base_url, {SLUG} AS url_slug, substring(regexp_replace(url, '[^\p{{L}}\p{{N}}_.\-]', '_', 'g'), 1, 100) AS safe_filename,
replace({DOMAIN}, '.', '_') AS domain_slug FROM pages""")
def url_parts(spark, sf_dir):
    u = F.col("url")
    return pages(spark, sf_dir).select("page_id", T.domain(u).alias("domain"), T.base_url(u).alias("base_url"), T.url_slug(u).alias("url_slug"), T.safe_filename(u).alias("safe_filename"), F.translate(T.domain(u), ".", "_").alias("domain_slug"))


@query(f"SELECT page_id, url FROM pages WHERE NOT {EXCLUDED} AND regexp_matches(url, '/(en|fr)/')")
def url_filter_exclude(spark, sf_dir):
    return C.filter_urls(pages(spark, sf_dir).select("page_id", "url"), include=["/(en|fr)/"])


@query(f"SELECT page_id, NOT {EXCLUDED} AND url NOT LIKE '%#%' AND NOT regexp_matches(url, '\\.(jpg|png|gif|jpeg)$') AND url <> {BASE} || '/en/' AND replace(url, {BASE} || '/', '') <> '' AS article FROM pages")
def article_url_filter(spark, sf_dir):
    u = F.col("url")
    return pages(spark, sf_dir).select("page_id", C.is_article(u, F.concat(T.base_url(u), F.lit("/en/")), T.base_url(u)).alias("article"))


@query(f"SELECT page_id, url NOT LIKE '%)' AND NOT contains(replace(url, {BASE}, ''), {DOMAIN}) AS valid FROM pages")
def url_validity(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", C.is_valid(F.col("url"), T.base_url(F.col("url"))).alias("valid"))


MARK = "'[a](' || b || '/x/1) (' || b || '/y) ]' || b || '/z) [a](' || b || '/x/1) [o](http://other.org/q) (' || b || '/t \"title\") ' || url"


@query(rf"""WITH m AS (SELECT page_id, url, {BASE} AS b FROM pages), t AS (SELECT page_id, b, {MARK} AS md FROM m),
l AS (SELECT page_id, unnest(list_concat(regexp_extract_all(md, '\((' || regexp_escape(b) || '/[^)]+)\)', 1), regexp_extract_all(md, '\](' || regexp_escape(b) || '/[^)]+)\)', 1))) AS link FROM t)
SELECT DISTINCT page_id, link FROM l""")
def link_extract(spark, sf_dir):
    b = T.base_url(F.col("url"))
    parts = [F.lit("[a]("), b, F.lit("/x/1) ("), b, F.lit("/y) ]"), b, F.lit("/z) [a]("), b, F.lit("/x/1) [o](http://other.org/q) ("), b, F.lit('/t "title") '), F.col("url")]
    return pages(spark, sf_dir).select("page_id", F.explode(C.links(F.concat(*parts), b)).alias("link"))


EDGES = f"""e AS (SELECT DISTINCT url AS src, CASE WHEN h LIKE '/%' THEN {BASE} || h ELSE h END AS dst FROM (SELECT url, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]+)"', 1)) AS h FROM pages))"""


@query(f"""WITH {EDGES}, s AS (SELECT url FROM pages WHERE page_id < 5), l1 AS (SELECT DISTINCT dst AS url FROM s JOIN e ON e.src = s.url),
l2 AS (SELECT DISTINCT dst AS url FROM l1 JOIN e ON e.src = l1.url WHERE dst NOT IN (SELECT url FROM l1))
SELECT url, 1 AS depth FROM l1 UNION ALL SELECT url, 2 FROM l2""")
def link_frontier_bfs(spark, sf_dir):
    p = pages(spark, sf_dir)
    edges = p.select(F.col("url").alias("src"), F.explode(C.hrefs(F.col("html"), F.col("url"))).alias("dst")).distinct()
    return C.discover(p.filter("page_id < 5").select("url"), edges, 2)


@query("SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def skip_existing_antijoin(spark, sf_dir):
    p = pages(spark, sf_dir).select("page_id", "url")
    return C.skip_existing(p, p.filter("page_id % 3 = 0"))


@query(f"""WITH x AS (SELECT {DOMAIN} AS category, CASE WHEN html IS NULL THEN 'failed' WHEN page_id % 3 = 0 THEN 'skipped' ELSE 'scraped' END AS o FROM pages)
SELECT category, count(*) FILTER (o = 'scraped') AS scraped, count(*) FILTER (o = 'failed') AS failed, count(*) FILTER (o = 'skipped') AS skipped, count(*) AS discovered FROM x GROUP BY ROLLUP (category)""")
def crawl_counters(spark, sf_dir):
    o = F.when(F.col("html").isNull(), "failed").when(F.col("page_id") % 3 == 0, "skipped").otherwise("scraped")
    return C.counters(pages(spark, sf_dir).select(T.domain(F.col("url")).alias("category"), o.alias("outcome")))


@query(f"""SELECT printf('%04d', row_number() OVER (ORDER BY url)) AS doc_id, 'Unknown Title' AS title, url, {DOMAIN} AS domain, {SLUG} AS url_slug, length(html)::INT AS char_count FROM pages""")
def article_records(spark, sf_dir):
    return C.articles(pages(spark, sf_dir).select("url", F.col("html").alias("content"), F.col("page_id").alias("doc_pos"))).select("doc_id", "title", "url", "domain", "url_slug", "char_count")


BROKEN = "'[a](' || b || '/x/' || b || '/again) [b](' || b || '/fine) ]' || b || '/p' || page_id || '/' || d || ') tail'"


@query(rf"""WITH m AS (SELECT page_id, url, {BASE} AS b, {DOMAIN} AS d FROM pages), t AS (SELECT url, b, d, {BROKEN} AS md FROM m),
l AS (SELECT url AS source_url, 1 AS pattern, b, d, md, unnest(regexp_extract_all(md, '\](' || regexp_escape(b) || '/[^)]+)\)', 1)) AS url FROM t
  UNION ALL SELECT url, 2, b, d, md, unnest(regexp_extract_all(md, '\((' || regexp_escape(b) || '/[^)]+)\)', 1)) FROM t)
SELECT source_url, pattern::INT AS pattern, url, substring(md, greatest(strpos(md, url) - 100, 1), strpos(md, url) - greatest(strpos(md, url) - 100, 1) + length(url) + 100) AS context FROM l
WHERE url LIKE '%)' OR contains(replace(url, b, ''), d)""")
def malformed_links(spark, sf_dir):
    """Audit of links with the domain inside their path."""
    u, b = F.col("url"), T.base_url(F.col("url"))
    md = F.concat(F.lit("[a]("), b, F.lit("/x/"), b, F.lit("/again) [b]("), b, F.lit("/fine) ]"), b, F.lit("/p"), F.col("page_id").cast("string"), F.lit("/"), T.domain(u), F.lit(") tail"))
    return C.malformed_links(pages(spark, sf_dir).select("url", md.alias("markdown"), b.alias("base")))
