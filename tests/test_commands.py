"""Semantic stage, whole process, comparison, files, crawling, logs and commands on small fixtures."""

import json
import logging
import re

import pytest
from pyspark.sql import functions as F

from corpusmill import cli, logs, schemas, scratch
from corpusmill.functions import text as T
from corpusmill.operators import compare, crawl, dedup, metrics, process, semantic
from corpusmill.sources import files, tables


def docs(spark, texts):
    return spark.createDataFrame([(f"{i:04d}", i, t) for i, t in enumerate(texts, 1)], "doc_id string, doc_pos long, text string")


WORDS = "uno dos tres cuatro cinco seis".split()


def semantic_case(spark, vectors, texts=None, **options):
    texts = texts or [" ".join([*WORDS, f"w{i}"]) for i in range(len(vectors))]
    provider = semantic.Lookup(dict(zip(texts, vectors, strict=True)))
    d = docs(spark, texts)
    unique = dedup.exact_survivors(d)
    near, _ = dedup.near_stage(unique)
    left = unique.join(near.filter("not is_duplicate").select("doc_id"), "doc_id", "left_semi")
    report, summary = semantic.semantic_from_text(left, provider, **({"min_tokens": 5, "chunk_tokens": 100, "threshold": 0.95} | options))
    return {r.doc_id: r for r in report.collect()}, summary.first()


def test_semantic_stage_links_like_vectors(spark):
    rows, summary = semantic_case(spark, [(1, 0), (0.99, 0.01)])
    assert rows["0002"].is_duplicate and rows["0002"].canonical_doc_id == "0001" and rows["0001"].candidate_doc_id == "0002"
    assert summary.asDict() == {
        "documents_scanned": 2, "documents_skipped_short": 0, "candidate_pairs_evaluated": 1, "duplicate_documents": 1, "duplicate_groups": 1,
        "model_name": "lookup", "top_k": 10, "threshold": 0.95,
    }


def test_semantic_stage_leaves_others(spark):
    rows, summary = semantic_case(spark, [(1, 0), (0.6, 0.8)])
    assert not any(r.is_duplicate for r in rows.values()) and summary.candidate_pairs_evaluated == 1


def test_semantic_stage_makes_groups(spark):
    rows, summary = semantic_case(spark, [(1, 0), (0.96, 0.04), (0.92, 0.08)], threshold=0.9)
    assert {r.canonical_doc_id for r in rows.values()} == {"0001"} and summary.duplicate_groups == 1


def test_semantic_stage_skips_short(spark):
    rows, summary = semantic_case(spark, [(1, 0), (1, 0)], ["uno dos tres cuatro", "uno dos tres otro"], min_tokens=20)
    assert {r.match_type for r in rows.values()} == {"skipped_short_document"} and summary.documents_skipped_short == 2


def test_chunks_are_averaged_and_ragged_vectors_raise(spark):
    class Sizes:
        name = "sizes"

        def embed(self, texts):
            return [[float(len(t.split(" "))), 1.0] for t in texts]

    class Ragged:
        name = "ragged"

        def embed(self, texts):
            return [[1.0] * (1 + len(t) % 2) for t in texts]

    d = docs(spark, ["a b c d e"])
    counts, vectors = semantic.document_vectors(d, Sizes(), min_tokens=1, chunk_tokens=2)
    assert counts.first().n_tokens == 5 and vectors.first().vector == pytest.approx([5 / 3, 1])
    with pytest.raises(Exception, match="different lengths"):
        semantic.document_vectors(docs(spark, ["aa b cccc"]), Ragged(), min_tokens=1, chunk_tokens=1)[1].collect()
    empty = spark.createDataFrame([("x", [])], "doc_id string, vector array<double>")
    with pytest.raises(Exception, match="no vectors"):
        dedup.average_vectors(empty, "doc_id").collect()


def test_bucketed_neighbours_are_the_exact_ones(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 16))
    rows = [(i, i, (centres[i % 60] + 0.1 * rng.standard_normal(16)).tolist()) for i in range(900)]
    vectors = spark.createDataFrame(rows, "doc_id long, doc_pos long, vector array<double>")
    pairs = lambda df: {(r.src, r.dst) for r in df.collect()}
    exact, found = pairs(dedup.nearest(vectors, 5)), pairs(dedup.nearest_bucketed(vectors, 5, bucket=64))
    assert len(exact & found) >= 0.9 * len(exact)


def test_min_hashes_find_near_copies(spark):
    import random

    rng = random.Random(5)
    texts = []
    for _ in range(60):
        w = [f"w{rng.randrange(5000)}" for _ in range(300)]
        texts += [" ".join(w), " ".join([*w[:-4], "x", "y", "z", "u"])]
    sets = dedup.shingles_of(docs(spark, texts))
    assert {len(r.signature) for r in dedup.minhash_signatures(sets).collect()} == {128}
    exact = {(r.left_id, r.right_id) for r in dedup.jaccard_pairs(sets, 0.85).collect()}
    found = {tuple(sorted((r.left_id, r.right_id))) for r in dedup.lsh_candidates(sets).collect()}
    assert len(exact) == 60 and len(exact & found) >= 0.9 * len(exact)


def test_common_texts_have_one_canonical(spark, monkeypatch):
    monkeypatch.setattr(dedup, "COMMON_ROWS", 5)
    r = {x.doc_id: x.canonical_doc_id for x in dedup.exact_report(docs(spark, [*["same"] * 9, "two", "two", "one", None, None])).collect()}
    assert [r[k] for k in sorted(r)] == [*["0001"] * 9, "0010", "0010", "0012", "0013", "0014"]


def test_process_runs_all_stages(spark):
    long = " ".join(f"palabra{i}" for i in range(60))
    near = " ".join([f"palabra{i}" for i in range(59)] + ["otra"])
    contents = [f"# Titulo\n\n{long}.\n", f"# Titulo\n\n{long}.", f"# Titulo\n\n{near}.", "short", None, " ".join(f"distinta{i}" for i in range(60))]
    rows = [(f"{i:04d}", i, f"a/b {i}", c, None if i == 6 else "x.org") for i, c in enumerate(contents, 1)]
    p = process.process(spark.createDataFrame(rows, "doc_id string, doc_pos long, url_slug string, content string, domain string"))
    assert {r.status: r.articles for r in p.counts.collect()} == {"processed": 4, "short": 1, "missing": 1}
    meta = {r.doc_id: r for r in p.metadata.collect()}
    assert meta["0001"].filename == "0001_x_org_a_b_1.txt" and meta["0001"].source_md.endswith(".md") and meta["0006"].domain == "unknown" and meta["0001"].word_count == 61
    assert (p.exact_summary.first().duplicate_documents, p.near_summary.first().duplicate_documents) == (1, 1)
    assert {r.doc_id for r in p.survivors().collect()} == {"0001", "0006"} and p.semantic_summary.first().documents_scanned == 2


def test_comparison(spark):
    assert compare.normalize_ids(" 1, ,Ab,2 ") == ["1", "Ab", "2"]
    for bad in ("", " , ", "a,A"):
        with pytest.raises(ValueError):
            compare.normalize_ids(bad)
    make = lambda rows: spark.createDataFrame(rows, "filename string, text string")
    raw = make([("0001_a.md", "one\n<two>\n\nfour\n"), ("0002_b.md", "x"), ("0003_c.md", "x")])
    done = make([("0001_a.txt", "one"), ("0002_z.txt", "x"), ("0003_c.txt", " ")])
    pair = compare.requested_pairs(raw, done, "0001")
    sides = compare.side_by_side(pair, 3).orderBy("block", "place").collect()
    assert [(r.block, r.place, r.raw_number, r.raw_line, r.processed_number, r.processed_line) for r in sides] == [
        (0, 0, 1, "one", 1, "one"), (0, 1, 2, "<two>", None, None), (0, 2, 3, "", None, None), (1, 0, 4, "four", None, None),
    ]
    page = compare.rendered(compare.side_by_side(pair, 32)).first().html
    assert "&lt;two&gt;" in page and page.count("<tr>") == 4 and "<td>3</td><td>&nbsp;</td>" in page
    for ids, why in (("0002", "same stem"), ("0009", "no .md file"), ("0003", "File is empty"), ("a", "no .md file")):
        with pytest.raises(Exception, match=why):
            compare.requested_pairs(raw, done, ids).collect()
    lines = spark.createDataFrame([("a\r\nb\rc\n",), ("",), ("\n",), ("x\n\n",)], "t string").select(T.split_lines(F.col("t")).alias("l"))
    assert [r.l for r in lines.collect()] == [x.splitlines() for x in ("a\r\nb\rc\n", "", "\n", "x\n\n")]
    front = {r.filename: r for r in compare.frontmatter_changes(make([("a.md", "---\nt: 1\n---\n\nBody"), ("b.md", "Body"), ("c.md", "---\n---\nx")]), 2).collect()}
    assert set(front) == {"a.md", "b.md"} and front["a.md"].changed and front["a.md"].after == "Body" and not front["b.md"].changed


def test_files_round_trip(spark, tmp_path):
    root = str(tmp_path)
    texts = spark.createDataFrame([("a.txt", "eins\nzwei"), ("b.txt", "")], "filename string, text string")
    files.write_texts(texts, f"{root}/t")
    assert {r.filename: r.text for r in files.read_text_folders(spark, f"{root}/t").collect()} == {"a.txt": "eins\nzwei", "b.txt": ""}
    assert files.write_summary(spark.createDataFrame([("ä", 2)], "k string, n int"), f"{root}/s.json") == {"k": "ä", "n": 2}
    assert json.loads((tmp_path / "s.json").read_text()) == {"k": "ä", "n": 2}
    with pytest.raises(FileNotFoundError, match="top50_words.csv"):
        files.read_metrics(spark, root)
    for name, schema in schemas.METRICS.items():
        files.write_csv(spark.createDataFrame([], schema), f"{root}/{name}")
    assert files.read_metrics(spark, root)["top50_words.csv"].columns == ["word", "count", "pct"]
    for d in ("site/a_org", "site/_x", "site/b_c_de"):
        (tmp_path / d).mkdir(parents=True)
    (tmp_path / "site" / "file").write_text("")
    assert files.available_sites(spark, f"{root}/site") == ["a.org", "b.c.de"] and files.available_sites(spark, f"{root}/none") == []
    (tmp_path / "md").mkdir()
    for name in ("2.md", "1.md", "3.txt"):
        (tmp_path / "md" / name).write_text(name)
    assert [r.filename for r in files.read_texts(spark, f"{root}/md", "*.md", 1).collect()] == ["1.md"]
    (tmp_path / "bad.jsonl").write_text('{"url": 1}\n{broken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_jsonl(spark, f"{root}/bad.jsonl", schemas.REGISTRY, strict=True).collect()
    files.write_jsonl(texts, f"{root}/j")
    files.write_jsonl(texts, f"{root}/j", append=True)
    assert files.read_jsonl(spark, f"{root}/j", texts.schema).count() == 4
    assert files.metrics_dir(root + "/", "Mi Corpus!") == f"{root}/mi_corpus" and files.label_column(texts) == "filename"
    meta = spark.createDataFrame([("1", 1, "a"), ("1", 2, "b"), ("2", 3, "c")], "doc_id string, doc_pos long, title string")
    assert sorted((r.doc_id, r.title) for r in files.last_wins(meta).collect()) == [("1", "b"), ("2", "c")]


def test_selection(spark):
    meta = spark.createDataFrame([("1", "x.org")], "doc_id string, domain string")
    assert files.validate_selection({"mode": " DOMAIN ", "values": [" a ", ""], "label": "Ä b"}) == ("domain", ["a"], "b")
    assert files.select_documents(meta, "domain", ["x.org"]).count() == 1
    for mode, values, why in (("domain", ["y"], "selects no rows"), ("urls", ["y"], "lacks columns"), ("domain", [], "needs values"), ("other", ["y"], "unknown mode"), ("domain", "y", "must be a list")):
        with pytest.raises(ValueError, match=why):
            files.select_documents(meta, mode, values)
    with pytest.raises(ValueError, match="letter or digit"):
        files.validate_selection({"label": "!!"})


def test_registry_is_written_back():
    text = "# sites\n\nurls:\n- url: http://a.org/\n  domain: a.org\n- url: http://b.org/\n  domain: b.org\n- url: http://a.org/\n  domain: again\n"
    new = files.update_registry(text, "http://a.org/")
    assert new.startswith("# sites\n\n") and new.count("processed: true") == 1 and new.index("processed: true") < new.index("b.org")
    with pytest.raises(ValueError):
        files.update_registry(text, "http://c.org/")


def web(spark):
    page = lambda *links: "Texto " * 30 + " ".join(f"[x](http://a.org/{x})" for x in links)
    rows = [("http://a.org/s", page("1", "2", "p.jpg")), ("http://a.org/1", page("3", "s")), ("http://a.org/2", page("1")), ("http://a.org/3", page("4")), ("http://a.org/4", page())]
    return spark.createDataFrame(rows, "url string, content string")


def test_crawl_levels_skips_and_ids(spark):
    known = spark.createDataFrame([("0007", 7, "http://a.org/2")], "doc_id string, doc_pos long, url string")
    articles, log = crawl.crawl(crawl.TablePages(web(spark)), "http://a.org/s", name="Mi sección", max_depth=2, known=known, start=crawl.last_id(known))
    got = {r.url: r for r in articles.collect()}
    assert set(got) == {"http://a.org/1", "http://a.org/3", "http://a.org/s"} and {r.doc_id for r in got.values()} == {"0008", "0009", "0010"}
    assert {r.category for r in got.values()} == {"Mi_sección"} and crawl.last_id(known.limit(0)) == 0
    assert {r.url: r.outcome for r in log.collect()} == {"http://a.org/1": "scraped", "http://a.org/2": "skipped", "http://a.org/3": "scraped", "http://a.org/s": "scraped"}
    pages = web(spark).select("url", F.col("content").alias("markdown"), F.lit("http://a.org").alias("base"))
    found = lambda **k: {r.dst for r in crawl.discovered(pages.filter("url like '%/s'"), **k).collect()}
    assert found(section="http://a.org/1", exclude=[]) == {"http://a.org/2"} and found(filtered=False) == {"http://a.org/1", "http://a.org/2", "http://a.org/p.jpg"} and found(include=["/2"]) == {"http://a.org/2"}
    same = crawl.with_ids(spark.createDataFrame([("u", i) for i in range(50)], "url string, n int").repartition(5))
    assert sorted(r.doc_id for r in same.collect()) == [f"{i:04d}" for i in range(1, 51)]


def test_log_lines(capsys, tmp_path, monkeypatch):
    assert logs.event_line("e", {"a": "x", "b": 1, "c": None}) == 'e a="x" b=1'
    record = logging.LogRecord("n" * 50, logging.INFO, "", 0, "hello %s", ("w",), None)
    record.event_fields = {"session_id": "abc"}
    line = logs.LineFormatter().format(record)
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}[+-]\d\d:\d\d  INFO \[abc\] \d+ --- n{40} : hello w", line)
    assert logs.LineFormatter(True).format(record).count(logs.RESET) == 5
    with logs.new_session(kind="k", url="u") as outer:
        assert len(outer) == 8
        with logs.session(extra=1) as inner:
            assert inner == outer
    monkeypatch.setenv("APP_ENV", "prod")
    before = logging.getLogger().handlers[:], logging.getLogger().level
    try:
        logs.setup(log_file=str(tmp_path / "x" / "l.log"))
        with logs.session(session_id="s1"):
            logs.log_event(logging.getLogger("a"), "done", n=2)
        assert (tmp_path / "x" / "l.log").read_text().rstrip().endswith('[s1] {} --- {} : done session_id="s1" n=2'.format(__import__("os").getpid(), "a".ljust(40)))
    finally:
        logging.getLogger().handlers[:], logging.getLogger().level = before


def test_commands(spark, tmp_path, capsys):
    root = str(tmp_path)
    web(spark).write.parquet(f"{root}/pages")
    registry = tmp_path / "urls.yml"
    registry.write_text("urls:\n- url: http://a.org/s\n  domain: a.org\n  name: s\n  max_depth: 2\n")
    run = lambda *a: cli.main(list(a), spark)
    scrape = ("scrape", "--registry", str(registry), "--pages", f"{root}/pages", "--output", f"{root}/raw")
    assert run(*scrape, "--no-update") == 0 and "processed: true" not in registry.read_text()
    assert run(*scrape) == 0 and "processed: true" in registry.read_text()
    assert "Skipped: 4" in capsys.readouterr().out
    assert run(*scrape) == 0 and "No URLs to process" in capsys.readouterr().out
    assert run(*scrape, "--force") == 0
    assert run("scrape", "http://a.org/4", "http://a.org/none", *scrape[1:]) == 1
    assert sorted(r.doc_id for r in spark.read.parquet(f"{root}/raw/articles").collect()) == ["0001", "0002", "0003", "0004", "0005"]
    assert run("process", "--input", f"{root}/raw", "--output", f"{root}/done") == 0
    assert json.loads((tmp_path / "done" / "dedup_stage_03_semantic_summary.json").read_text())["model_name"] == "token-hashes-256"
    for name in ("dedup-exact", "dedup-near", "dedup-semantic"):
        assert run(name, "--input", f"{root}/done") == 0
    assert run("dedup-semantic", "--input", f"{root}/done", "--neighbours", "bucketed") == 0
    assert json.loads((tmp_path / "done" / "dedup_stage_01_exact_summary.json").read_text())["documents_scanned"] == files.read_text_folders(spark, f"{root}/done/texts").count()
    assert run("process", "--input", f"{root}/nowhere") == 1 and run() == 1 and run("scrape", "--registry", f"{root}/none.yml", "--pages", f"{root}/pages") == 1
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "0001_a.md").write_text("---\nt: 1\n---\n\nBody")
    (tmp_path / "md" / "0001_a.txt").write_text("Body")
    assert run("remove-frontmatter", "--path", f"{root}/md", "--dry-run") == 0 and (tmp_path / "md" / "0001_a.md").read_text().startswith("---")
    assert run("remove-frontmatter", "--path", f"{root}/md") == 0 and (tmp_path / "md" / "0001_a.md").read_text() == "Body"
    assert run("compare", "--ids", "0001", "--raw", f"{root}/md", "--processed", f"{root}/md", "--output", f"{root}/cmp") == 0
    assert run("compare", "--ids", "0009", "--raw", f"{root}/md", "--processed", f"{root}/md", "--output", f"{root}/cmp") == 1


def test_metrics_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id string, word_count int, chars_per_word double")
    assert metrics.mean_ratio(empty).first().mean == 0.0 and metrics.histogram(empty, "word_count").collect() == []
    one = spark.createDataFrame([("a", 5, None)], "doc_id string, word_count int, chars_per_word double")
    gates = metrics.gates(one, one).first()
    assert (gates.documents, gates.distributions, gates.heatmap, gates.density) == (1, False, False, False)
    assert metrics.histogram(one, "word_count").collect() == [(0, 1)] and metrics.describe(one, "word_count").first()["std"] is None
    weights = spark.createDataFrame([("1", "x", 0.5), ("2", "y", 0.25)], "doc_id string, term string, tfidf double")
    stems = spark.createDataFrame([("1", "0001_a.txt"), ("2", "0002_b.txt")], "doc_id string, filename string")
    assert sorted(map(tuple, metrics.pivoted(weights, ["x", "y"], stems).collect())) == [("0001_a", 0.5, 0.0), ("0002_b", 0.0, 0.25)]
    tf = metrics.tfidf(spark.createDataFrame([], "doc_id string, doc_pos long, text string"), metrics.spanish_tokens(F.col("text")))
    assert tf.collect() == []


def test_schemas():
    assert schemas.QUEUE_JOB["id"].nullable is False and schemas.QUEUE_JOB["lock"].nullable and schemas.QUEUE_GROUP["ttl"].dataType == schemas.L
    assert schemas.QUEUE_BACKLOG.fieldNames()[-1] == "times_out_at" and schemas.QUEUE_FINISHED == schemas.QUEUE_JOB


def test_small_tables_are_dealt_out(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(100).coalesce(1).write.parquet(path)
    assert tables.read_table(spark, path).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tables, "SMALL", 0)
    assert tables.read_table(spark, path).rdd.getNumPartitions() == 1 and tables.read_table(spark, path).count() == 100


def test_vector_store(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "doc_id string, doc_pos long, vector array<double>")
    store = tables.VectorStore(spark, str(tmp_path / "v")).create().add(make([("a", 1, [1.0, 0.0]), ("b", 2, [0.9, 0.1])]))
    assert [(r.src, r.dst) for r in store.add(make([("c", 3, [0.0, 1.0])])).nearest(1).orderBy("src").collect()] == [("a", "b"), ("b", "a"), ("c", "b")]
    for bad in ([1.0], [], None):
        with pytest.raises(ValueError):
            store.add(make([("d", 4, bad)]))
    assert store.vectors().count() == 3 and store.create().vectors().count() == 0


def test_scratch_needs_a_shared_folder():
    class Conf:
        def get(self, key):
            return None

    class Context:
        master = "spark://host:7077"
        getConf, getCheckpointDir = Conf, lambda self: None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch.shared_dir(Session())
