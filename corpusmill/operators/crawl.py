"""Crawling over a table of pages: link extraction, URL filters, bounded discovery, records of articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.scratch import cut

# fixed values
EXCLUDE = [
    "wp-content", "wp-json", "xmlrpc", "feed", "comments", r"\.(jpg|jpeg|png|gif|svg|webp|ico|xlsx|xls|sav)$",
    r"facebook\.com", r"instagram\.com", r"youtube\.com", r"pinterest\.com", r"twitter\.com", "#",
]
IMAGES = (".jpg", ".png", ".gif", ".jpeg")


def matches_any(url: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | url.rlike(p.replace("$", r"\z") if p.endswith("$") else p)
    return out


def filter_urls(urls: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Rows whose url no exclude pattern hits and, if there are include patterns, one of them does; in url order."""
    out = urls.filter(~matches_any(F.col("url"), EXCLUDE if exclude is None else exclude))
    return (out.filter(matches_any(F.col("url"), include)) if include else out).orderBy("url")


def is_article(url: Column, section: Column, base: Column, exclude: list[str] | None = None) -> Column:
    image = F.lit(False)
    for x in IMAGES:
        image = image | url.endswith(x)
    path = F.replace(url, F.concat(base, F.lit("/")), F.lit(""))
    return ~image & ~url.contains("#") & (url != section) & ~matches_any(url, EXCLUDE if exclude is None else exclude) & (path != "")


def is_valid(url: Column, base: Column) -> Column:
    """No closing bracket at the end, and the domain not again behind the base.  Only observed: such links are kept."""
    return ~url.endswith(")") & ~F.contains(F.replace(url, base, F.lit("")), T.domain(base))


# fixed values: what stands before and behind a link's base, in the order of the patterns
LINK_PATTERNS = [(r"\](", r"/[^)]+)\)"), (r"\((", r"/[^)]+)\)")]


def links_by_pattern(markdown: Column, base: Column) -> list[Column]:
    """Links below base that each pattern finds: ]base/...) without an opening bracket, and (base/...) in round brackets."""
    quoted = F.concat(F.lit(r"\Q"), base, F.lit(r"\E"))
    return [F.regexp_extract_all(markdown, F.concat(F.lit(a), quoted, F.lit(b)), F.lit(1)) for a, b in LINK_PATTERNS]


def links(markdown: Column, base: Column) -> Column:
    """Distinct links below base that the patterns find."""
    return F.array_union(*links_by_pattern(markdown, base))


def malformed_links(pages: DataFrame, around: int = 100) -> DataFrame:
    """Audit of pages (url, markdown, base): source_url, pattern, url and its context, a row for each match that isn't valid."""

    def numbered(urls: Column, pattern: int) -> Column:
        return F.transform(urls, lambda u: F.struct(F.lit(pattern).alias("pattern"), u.alias("url")))

    found = F.array(*[numbered(x, i) for i, x in enumerate(links_by_pattern(F.col("markdown"), F.col("base")), 1)])
    rows = pages.select(F.col("url").alias("source_url"), "markdown", "base", F.explode(F.flatten(found)).alias("m"))
    rows = rows.select("source_url", F.col("m.pattern").alias("pattern"), F.col("m.url").alias("url"), "markdown", "base").filter(~is_valid(F.col("url"), F.col("base")))
    return rows.select("source_url", "pattern", "url", link_context(F.col("markdown"), F.col("url"), around).alias("context"))


def discovered(pages: DataFrame, section: str | None = None, include: list[str] | None = None, exclude: list[str] | None = None, filtered: bool = True) -> DataFrame:
    """src, dst: links found on pages (url, markdown, base).

    With a section the links of articles (is_article), else those that filter_urls leaves, or all of them if not filtered."""
    flat = pages.select(F.col("url").alias("src"), "base", F.explode(links(F.col("markdown"), F.col("base"))).alias("url"))
    if section is not None:
        flat = flat.filter(is_article(F.col("url"), F.lit(section), F.col("base"), exclude))
    elif filtered:
        flat = flat.filter(~matches_any(F.col("url"), EXCLUDE if exclude is None else exclude))
        flat = flat.filter(matches_any(F.col("url"), include)) if include else flat
    return flat.select("src", F.col("url").alias("dst")).distinct()


def link_context(markdown: Column, url: Column, around: int = 100) -> Column:
    """Up to `around` characters on both sides of the url's first place."""
    at = F.instr(markdown, url)
    start = F.greatest(at - around, F.lit(1))
    return F.when(at > 0, F.substring(markdown, start, at - start + F.length(url) + around))


def hrefs(html: Column, url: Column) -> Column:
    """Absolute targets of the anchors of a page; relative ones below its base."""
    found = F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"]+)"'), F.lit(1))
    return F.array_distinct(F.transform(found, lambda h: F.when(h.startswith("/"), F.concat(T.base_url(url), h)).otherwise(h)))


def discover(seeds: DataFrame, edges: DataFrame, max_depth: int = 2) -> DataFrame:
    """url, depth reached from seeds (url) over edges (src, dst) in at most max_depth levels.

    A seed counts as found only if a link leads to it.  Each level is a join and an anti-join, written before the next one
    reads it; pages met before aren't read again."""
    edges = cut(edges.select("src", "dst"))
    frontier, found = seeds.select("url").distinct(), None
    for depth in range(1, max_depth + 1):
        level = frontier.join(edges, frontier.url == edges.src).select(F.col("dst").alias("url")).distinct()
        frontier = cut(level if found is None else level.join(found, "url", "left_anti"))
        now = frontier.withColumn("depth", F.lit(depth))
        found = now if found is None else found.union(now)
        if frontier.isEmpty():
            break
    return found if found is not None else seeds.select("url").limit(0).withColumn("depth", F.lit(0))


def skip_existing(urls: DataFrame, known: DataFrame) -> DataFrame:
    return urls.join(known.select("url").distinct(), "url", "left_anti")


def articles(pages: DataFrame, start: int = 0) -> DataFrame:
    """Records of scraped pages (url, content and, if there, title, description and doc_pos); ids of four digits or more go on
    from start in url order, pages of one url in that of doc_pos."""
    url = F.col("url")
    title = F.coalesce("title", F.lit("Unknown Title")) if "title" in pages.columns else F.lit("Unknown Title")
    text = F.coalesce("description", F.lit("")) if "description" in pages.columns else F.lit("")
    out = pages.select(
        title.alias("title"), text.alias("description"), "url", T.url_slug(url).alias("url_slug"), T.domain(url).alias("domain"),
        T.word_count(F.col("content")).alias("word_count"), F.length("content").alias("char_count"), "content",
        *(["doc_pos"] if "doc_pos" in pages.columns else []),
    )
    return with_ids(out, start, ties=["doc_pos"]).drop("doc_pos") if "doc_pos" in out.columns else with_ids(out, start)


def with_ids(df: DataFrame, start: int = 0, order: str = "url", ties: list[str] | None = None) -> DataFrame:
    """doc_id in the order of a column, equal ones by `ties`, then by a hash of the row; without one task for all rows.

    The sorted rows are written first, so that partitions are the same when they are counted and when they are numbered."""
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sorted_ = cut(df.orderBy(order, *(ties or []), tie).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()))
    sizes = sorted_.groupBy("_p").agg(F.count("*").alias("n"), F.min("_m").alias("_lo"))
    # a row for each partition
    first = sizes.selectExpr("_p", "_lo", "coalesce(sum(n) over (order by _p rows between unbounded preceding and 1 preceding), 0) as _f")
    number = F.col("_f") + F.col("_m") - F.col("_lo") + 1 + start
    return sorted_.join(F.broadcast(first), "_p").withColumn("doc_id", F.format_string("%04d", number)).drop("_p", "_m", "_lo", "_f")


def last_id(metadata: DataFrame, order: str = "doc_pos") -> int:
    """Number of the last row's doc_id, 0 if there is none; new ids go on from it."""
    last = metadata.agg(F.max_by(F.col("doc_id").cast("long"), F.col(order)).alias("n")).first().n
    return int(last or 0)


def file_name(doc_id: Column, domain: Column, slug: Column, suffix: str = "md") -> Column:
    return F.concat(F.concat_ws("_", doc_id, F.translate(domain, ".", "_"), slug), F.lit(f".{suffix}"))


def counters(log: DataFrame) -> DataFrame:
    """scraped, failed, skipped, discovered by category, of log (category, outcome); the row of a null category is the total."""
    is_ = lambda x: F.count_if(F.col("outcome") == x)
    return log.rollup("category").agg(is_("scraped").alias("scraped"), is_("failed").alias("failed"), is_("skipped").alias("skipped"), F.count("*").alias("discovered"))


def retry(attempt, most: int = 3, pause=lambda: None):
    """attempt() until it gives something, `most` times, with the same pause in between."""
    for i in range(most):
        try:
            if (out := attempt()) is not None:
                return out
        except OSError:
            pass
        if i + 1 < most:
            pause()
    return None


class TablePages:
    """Page provider that reads a table of pages (url, content and, if there, title and description) instead of the web."""

    def __init__(self, pages: DataFrame) -> None:
        self.pages = pages

    def fetch(self, urls: DataFrame) -> DataFrame:
        """The pages of urls (url) that there are."""
        return self.pages.join(urls.select("url").distinct(), "url", "left_semi")


def crawl(provider, seed: str, *, name: str | None = None, max_depth: int = 2, known: DataFrame | None = None, start: int = 0, include: list[str] | None = None, exclude: list[str] | None = None, skip: bool = True) -> tuple[DataFrame, DataFrame]:
    """Discover pages from seed and scrape them: (articles with content and category, log of url, category, outcome).

    provider.fetch(urls) gives url, content (Markdown) and perhaps title and description.  A level is one join; pages that an
    earlier level met aren't read again.  known: metadata whose urls are skipped.  outcome: scraped, failed, skipped."""
    spark = (known.sparkSession if known is not None else None) or provider.pages.sparkSession
    one = spark.createDataFrame([(seed,)], "url string").select("url", T.base_url(F.col("url")).alias("base"), T.category(F.col("url")).alias("category"))
    base, category = one.select("base", "category").first()
    category = T.safe_name(name or category)
    frontier, met, found = one.select("url"), one.select("url"), None
    for _ in range(max(1, max_depth)):
        pages = provider.fetch(frontier).filter(F.coalesce("content", F.lit("")) != "").select("url", F.col("content").alias("markdown"), F.lit(base).alias("base"))
        level = cut(discovered(pages, include=include, exclude=exclude).select(F.col("dst").alias("url")).distinct())
        found = level if found is None else cut(found.union(level).distinct())
        frontier = cut(level.join(met, "url", "left_anti"))
        if frontier.isEmpty():
            break
        met = met.union(frontier)
    wanted = skip_existing(found, known) if skip and known is not None else found
    pages = cut(provider.fetch(wanted).filter(F.coalesce("content", F.lit("")) != ""))
    outcome = F.when(F.col("scraped"), "scraped").when(F.col("wanted"), "failed").otherwise("skipped")
    flags = found.join(wanted.select("url", F.lit(True).alias("wanted")), "url", "left").join(pages.select("url", F.lit(True).alias("scraped")).distinct(), "url", "left").fillna(False, ["wanted", "scraped"])
    return articles(pages, start).withColumn("category", F.lit(category)), flags.select("url", F.lit(category).alias("category"), outcome.alias("outcome"))
