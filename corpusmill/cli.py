"""Commands: scrape, process, dedup-exact, dedup-near, dedup-semantic, compare, remove-frontmatter.

Exit codes: 0 done, 1 an error or failed pages, 130 interrupted.  Tables are Parquet below a folder that Spark reads."""

from __future__ import annotations

import argparse
import logging
import sys
import traceback

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import config as C
from corpusmill import logs
from corpusmill.operators import compare, crawl, dedup, process, semantic
from corpusmill.scratch import cut
from corpusmill.sources import files

logger = logging.getLogger("corpusmill.cli")
ARTICLES, PROCESSED, EXACT, NEAR, SEMANTIC = "articles", "metadata_plaintext", "dedup_stage_01_exact", "dedup_stage_02_near_duplicate", "dedup_stage_03_semantic"


def table(spark: SparkSession, root: str, name: str, hint: str) -> DataFrame:
    if not files.exists(spark, f"{root}/{name}"):
        raise FileNotFoundError(f"{root}/{name} is not there; {hint}")
    return spark.read.parquet(f"{root}/{name}")


def save(df: DataFrame, root: str, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(f"{root}/{name}")


def report(values: dict, title: str) -> None:
    print(title)
    for k, v in values.items():
        print(f"  {k.replace('_', ' ').capitalize()}: {v}")


def known_articles(spark: SparkSession, root: str) -> DataFrame | None:
    return spark.read.parquet(f"{root}/{ARTICLES}") if files.exists(spark, f"{root}/{ARTICLES}") else None


def save_articles(spark: SparkSession, found: DataFrame, root: str) -> None:
    """Append articles with ids that go on from those there are."""
    found = found.withColumn("doc_pos", F.col("doc_id").cast("long")).withColumn("scraped_at", F.current_timestamp().cast("timestamp_ntz"))
    save(found, root, ARTICLES, "append")


def scrape(spark: SparkSession, args: argparse.Namespace, provider=None) -> int:
    provider = provider or crawl.TablePages(spark.read.parquet(args.pages))
    if args.urls:
        with logs.new_session(spark, "scrape_url"):
            wanted = spark.createDataFrame([(u,) for u in args.urls], "url string")
            pages = cut(provider.fetch(wanted).filter(F.coalesce("content", F.lit("")) != ""))
            known = known_articles(spark, args.output)
            save_articles(spark, crawl.articles(pages, crawl.last_id(known) if known is not None else 0).withColumn("category", F.lit(None).cast("string")), args.output)
            done = pages.count()
            report({"successful": done, "failed": len(args.urls) - done}, "Scraping completed:")
            logs.log_event(logger, "scrape_completed_from_args", success_count=done, failed_count=len(args.urls) - done)
            return int(done < len(args.urls))
    path = args.urls_file or args.registry
    text = files.read_text_file(spark, path)
    registry = files.read_registry(spark, text)
    # driver-side: a registry is a hand-written list
    entries = files.unprocessed(registry, args.force).collect()
    skipped = registry.count() - len(entries)
    if skipped:
        print(f"Skipping {skipped} already-processed URLs")
    if not entries:
        print("No URLs to process; --force takes all of them")
        return 0
    totals = dict.fromkeys(("discovered", "scraped", "skipped", "failed"), 0)
    for e in entries:
        with logs.new_session(spark, "crawl_category", category_url=e.url):
            known = known_articles(spark, args.output)
            settings = C.resolve(args.config or {}, {}, e.url)
            filters = (settings.filters.to_dict() if settings.filters else {}) if args.config else {}
            articles, log = crawl.crawl(provider, e.url, name=e.name, max_depth=e.max_depth, known=known, start=crawl.last_id(known) if known is not None else 0, include=filters.get("include_patterns"), exclude=filters.get("exclude_patterns"))
            save_articles(spark, articles, args.output)
            counts = {r.outcome: r.n for r in log.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
            counts["discovered"] = sum(counts.values())
            for k in totals:
                totals[k] += counts.get(k, 0)
            report({k: counts.get(k, 0) for k in totals}, f"{e.name or e.url}:")
            if not args.no_update:
                text = files.update_registry(text, e.url)
                files.write_text_file(spark, path, text)
    report({"urls_processed": len(entries), **totals}, "Scraping session completed:")
    logs.log_event(logger, "scrape_session_completed", urls_processed=len(entries), **{f"total_{k}": v for k, v in totals.items()})
    return int(totals["failed"] > 0)


def process_command(spark: SparkSession, args: argparse.Namespace) -> int:
    articles = table(spark, args.input, ARTICLES, "run scrape first")
    done = process.process(articles, min_chars=args.min_chars, neighbours=dedup.nearest_bucketed if args.neighbours == "bucketed" else dedup.nearest)
    save(done.metadata, args.output, PROCESSED)
    files.write_texts(done.metadata.select("filename", "text"), f"{args.output}/texts")
    for name, stage, summary in ((EXACT, done.exact, done.exact_summary), (NEAR, done.near, done.near_summary), (SEMANTIC, done.semantic, done.semantic_summary)):
        save(stage, args.output, name)
        report(files.write_summary(summary, f"{args.output}/{name}_summary.json"), f"{name}:")
    report({r.status: r.articles for r in done.counts.collect()}, "Articles:")
    return 0


def dedup_exact(spark: SparkSession, args: argparse.Namespace) -> int:
    found = cut(dedup.exact_report(table(spark, args.input, PROCESSED, "run process first")))
    save(found, args.input, EXACT)
    report(files.write_summary(dedup.exact_summary(found), f"{args.input}/{EXACT}_summary.json"), "Stage 1, exact duplicates:")
    return 0


def left_by(spark: SparkSession, root: str, *stages: str) -> DataFrame:
    out = files.last_wins(table(spark, root, PROCESSED, "run process first"))
    for name in stages:
        gone = table(spark, root, name, "run the stage before first").filter(F.coalesce("is_duplicate", F.lit(False))).select("doc_id")
        out = out.join(gone, "doc_id", "left_anti")
    return out


def dedup_near(spark: SparkSession, args: argparse.Namespace) -> int:
    found, summary = dedup.near_stage(left_by(spark, args.input, EXACT))
    save(found, args.input, NEAR)
    report(files.write_summary(summary, f"{args.input}/{NEAR}_summary.json"), "Stage 2, near duplicates:")
    return 0


def dedup_semantic(spark: SparkSession, args: argparse.Namespace) -> int:
    provider = semantic.HttpEmbeddings(args.model, args.address) if args.address else semantic.TokenHashes()
    neighbours = dedup.nearest_bucketed if args.neighbours == "bucketed" else dedup.nearest
    found, summary = semantic.semantic_from_text(left_by(spark, args.input, EXACT, NEAR), provider, neighbours=neighbours)
    save(found, args.input, SEMANTIC)
    report(files.write_summary(summary, f"{args.input}/{SEMANTIC}_summary.json"), "Stage 3, semantic duplicates:")
    return 0


def compare_command(spark: SparkSession, args: argparse.Namespace) -> int:
    pairs = cut(compare.requested_pairs(files.read_texts(spark, args.raw), files.read_texts(spark, args.processed), args.ids).drop("requested_id"))
    save(compare.side_by_side(pairs), args.output, "side_by_side")
    save(compare.rendered(compare.side_by_side(pairs)), args.output, "html")
    compare.pair_stats(pairs).show(truncate=False)
    return 0


def frontmatter(spark: SparkSession, args: argparse.Namespace) -> int:
    if not files.exists(spark, args.path):
        raise FileNotFoundError(f"no folder {args.path}")
    changes = cut(compare.frontmatter_changes(files.read_texts(spark, args.path, "*.md"), args.limit))
    n = changes.agg(F.count("*").alias("examined"), F.count_if("changed").alias("removed")).first()
    if args.dry_run:
        for r in changes.filter("changed").orderBy("filename").select("filename", "before", "after").limit(20).collect():
            print(f"[dry run] {r.filename}\n--- before ---\n{r.before}--- after ---\n{r.after}")
    else:
        # driver-side, file by file: Spark's writers can't replace single files
        for r in changes.filter("changed").select("filename", "text").toLocalIterator():
            files.write_text_file(spark, f"{args.path}/{r.filename}", r.text)
    report({"examined": n.examined, "frontmatter removed": n.removed}, "Dry run, no file modified:" if args.dry_run else "Done:")
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusmill", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command")

    def command(name: str, run, **arguments) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for key, default in arguments.items():
            p.add_argument(f"--{key.replace('_', '-')}", default=default, type=type(default) if default is not None else str)
        p.set_defaults(run=run)
        return p

    p = command("scrape", scrape, urls_file=None, registry="config/urls.yml", pages="data/pages", output="data/raw")
    p.add_argument("urls", nargs="*")
    p.add_argument("--force", action="store_true")
    p.add_argument("--no-update", action="store_true")
    p.set_defaults(config=None)
    command("process", process_command, input="data/raw", output="data/processed", min_chars=100, neighbours="exact")
    for name, run in (("dedup-exact", dedup_exact), ("dedup-near", dedup_near)):
        command(name, run, input="data/processed")
    command("dedup-semantic", dedup_semantic, input="data/processed", model="", address="", neighbours="exact")
    command("compare", compare_command, raw="data/raw", processed="data/processed/texts", output="reports/comparison").add_argument("--ids", required=True)
    command("remove-frontmatter", frontmatter, path="data/raw", limit=0).add_argument("--dry-run", action="store_true")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = parser()
    args = p.parse_args(argv)
    if not args.command:
        p.print_help()
        return 1
    try:
        return args.run(spark or SparkSession.builder.appName("corpusmill").getOrCreate(), args)
    except (ValueError, FileNotFoundError) as e:
        print(e, file=sys.stderr)
        return 1
    except KeyboardInterrupt:
        print("interrupted", file=sys.stderr)
        return 130
    except Exception:
        traceback.print_exc()
        return 1
