"""Unit tests on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from corpusmill import config
from corpusmill.functions import text as T
from corpusmill.operators import clean, crawl, dedup, graph, markup
from corpusmill.operators import queue as Q
from corpusmill.sources import files
from corpusmill.streaming import jobs


def docs(spark, texts):
    return spark.createDataFrame([(f"{i:04d}", i, t) for i, t in enumerate(texts, 1)], "doc_id string, doc_pos long, text string")


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_exact_first_wins(spark):
    r = rows(dedup.exact_report(docs(spark, ["Texto igual\n", "Texto igual\r\n", "Texto distinto\n"])))
    assert [r[k].canonical_doc_id for k in sorted(r)] == ["0001", "0001", "0003"]
    s = dedup.exact_summary(dedup.exact_report(docs(spark, ["a", "a", "b"]))).first()
    assert (s.documents_scanned, s.unique_documents, s.duplicate_documents, s.duplicate_groups) == (3, 2, 1, 1)


def test_near_threshold_is_inclusive(spark):
    words = [f"n{i}" for i in range(31)]
    other = words[:28] + ["x", "y", "z"]
    r = rows(dedup.near_report(docs(spark, [" ".join(words), " ".join(other)]), threshold=0.8))
    assert r["0002"].canonical_doc_id == "0001" and r["0002"].is_duplicate and r["0002"].jaccard_similarity == 0.8


def test_near_component_of_three_and_short(spark):
    a = [f"a{i}" for i in range(1, 33)]
    texts = [" ".join(a), " ".join(a[:28] + ["p", "q", "r", "s"]), " ".join(a[:24] + list("abcdefgh")), "too short"]
    r = rows(dedup.near_report(docs(spark, texts), threshold=0.5))
    assert {r[k].canonical_doc_id for k in ("0001", "0002", "0003")} == {"0001"}
    assert r["0004"].match_type == "skipped_short_document" and r["0004"].candidate_doc_id is None


def test_semantic_mutual_neighbours(spark):
    v = spark.createDataFrame([("0001", 1, 60, [1.0, 0.0]), ("0002", 2, 60, [0.96, 0.04]), ("0003", 3, 60, [0.92, 0.08]), ("0004", 4, 10, [1.0, 0.0])], "doc_id string, doc_pos long, n_tokens int, vector array<double>")
    r = rows(dedup.semantic_report(v, threshold=0.9))
    assert {r[k].canonical_doc_id for k in ("0001", "0002", "0003")} == {"0001"}
    assert r["0004"].match_type == "skipped_short_document"


def test_neighbours_of_many_blocks_equal_brute_force_with_ties(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(8)
    x = np.vstack([np.round(rng.standard_normal((240, 3)), 1), np.ones((50, 3)), np.zeros((5, 3))])
    pos = rng.permutation(len(x))
    v = spark.createDataFrame([(f"d{i}", int(p), r.tolist()) for i, (p, r) in enumerate(zip(pos, x, strict=True))], "doc_id string, doc_pos long, vector array<double>")
    monkeypatch.setattr(dedup, "BLOCK_BYTES", 900)  # eight blocks
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = x / np.where(norm == 0, 1, norm)
    sim = np.round(u @ u.T, 9)
    np.fill_diagonal(sim, -np.inf)
    want = {(f"d{i}", f"d{j}", r) for i, s in enumerate(sim) for r, j in enumerate(np.lexsort((pos, -s))[:10], 1)}
    found = dedup.nearest(v, 10).cache()
    assert {(r.src, r.dst, r["rank"]) for r in found.collect()} == want
    listed = {w[:2] for w in want}
    assert {(r.a, r.b) for r in dedup.mutual(found).collect()} == {(a, b) for a, b in listed if a < b and (b, a) in listed}


@pytest.mark.parametrize("small", [0, 1_000_000])
def test_components_equal_union_find(spark, monkeypatch, small):
    monkeypatch.setattr(graph, "SMALL", small)
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    parent = list(range(60))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(find(n) == root for n, root in got.items())
    assert {n for e in edges if e[0] != e[1] for n in e} == set(got)
    path = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(50)] + [("x", None)]
    assert {r.root for r in graph.components(spark.createDataFrame(path, "u string, v string")).collect()} == {"n000"}
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_clean_examples(spark):
    def run(text):
        return spark.createDataFrame([(text,)], "t string").select(clean.clean(F.col("t"))).first()[0]

    assert run("Saltar a la navegación principal\nIn English\nSALTAR A:\nmostrar ↓\nContenido") == ""
    assert "*" not in run("Por **Nombre**".replace("**Nombre**", "** Nombre **") + "\n** - Revisado: hoy")
    assert run("una línea\nque sigue\ny otra") == "una línea que sigue\ny otra"
    assert run("") == ""


def test_english_words(spark):
    d = spark.createDataFrame([(1, "Esta receta tiene rice and beans. OK, eso esta bien.\n\nand the")], "doc_id int, text string")
    lex = spark.createDataFrame([("rice", "en", 4.5), ("beans", "en", 4.2), ("receta", "es", 4.0), ("tiene", "es", 5.0), ("eso", "es", 5.0), ("esta", "es", 5.0), ("bien", "es", 5.0)], "word string, lang string, zipf double")
    out = clean.drop_english(d, lex).first().text
    assert out == "Esta receta tiene. OK, eso esta bien.\n"


def test_markdown():
    out = markup.markdown_text("# T\n\ntexto **negrita** [enlace](http://x.y/z)\n\n| A | B |\n|---|---|\n| 1 | 2 |\n")
    assert out.split("\n")[0] == "T" and {"negrita", "enlace", "A", "B", "1", "2"} <= set(out.split("\n")) and "|" not in out


def test_links_and_context(spark):
    md = "[t](http://a.com/x) ]http://a.com/y) (http://b.com/z) [i](http://a.com/p.png)"
    d = spark.createDataFrame([(md, "http://a.com")], "m string, b string")
    assert sorted(d.select(crawl.links(F.col("m"), F.col("b"))).first()[0]) == ["http://a.com/p.png", "http://a.com/x", "http://a.com/y"]
    assert d.select(crawl.link_context(F.col("m"), F.lit("http://a.com/y"), 2)).first()[0] == " ]http://a.com/y) "


def test_queue_requeues_then_fails(spark):
    j = spark.createDataFrame([(1, "active", 3), (2, "active", 9), (3, "queued", None)], "id int, status string, stalls int").selectExpr("*", "'l' lock", "timestamp_ntz'2024-01-01' locked_at")
    out = {r.id: r for r in Q.reap(j, F.expr("timestamp_ntz'2024-01-02'")).collect()}
    assert [(out[i].status, out[i].stalls, out[i].lock) for i in (1, 2, 3)] == [("queued", 4, None), ("failed", 10, None), ("queued", None, "l")]


def test_config():
    assert config.merge({"a": [1], "b": {"c": 1}, "d": 1}, {"a": [2], "b": {"e": 2}, "d": 3}) == {"a": [1, 2], "b": {"c": 1, "e": 2}, "d": 3}
    c = config.resolve({"filters": {"x": 1}}, {"a.com": {"filters": {"y": 2}}}, "https://www.a.com/p")
    assert c.filters.y == 2 and c.missing is None and c.base_url == "https://www.a.com" and c.domain_slug == "a_com"


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("1", None), ("2", "é")], "a string, b string")
    files.write_jsonl(df, str(tmp_path / "j"))
    assert sorted(files.read_jsonl(spark, str(tmp_path / "j"), "a string, b string").collect()) == sorted(df.collect())
    (tmp_path / "0001_x.txt").write_text("hola\n")
    texts = files.read_texts(spark, str(tmp_path), "*.txt")
    assert files.by_prefix(texts, "0001", ".txt").first().text == "hola\n"
    with pytest.raises(ValueError):
        files.by_prefix(texts, "0002", ".txt")
    reg = files.read_registry(spark, "urls:\n- url: http://a.com\n- url: http://b.com\n  processed: true\n")
    assert files.unprocessed(reg).count() == 1 and files.unprocessed(files.mark_processed(reg, reg.select("url"))).count() == 0


def test_retry():
    tries = iter([None, OSError(), "x"])

    def attempt():
        v = next(tries)
        if isinstance(v, OSError):
            raise v
        return v

    assert crawl.retry(attempt) == "x"


def test_streaming_counts(spark, tmp_path):
    spark.sql("SELECT timestamp'2024-01-01 00:10:00' t, 'a' s UNION ALL SELECT timestamp'2024-01-01 00:20:00', 'a' UNION ALL SELECT timestamp'2024-01-01 03:00:00', 'b'").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, s string").parquet(str(tmp_path / "in"))
    q = jobs.state_counts(stream, "t", "s").writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r.s, r["rows"]) for r in spark.table("counts").collect()) == [("a", 2), ("b", 1)]


def test_streams_see_rows_once_and_clean_them(spark, tmp_path):
    rows = [("a", "2026-01-01 00:00:00", "x  y"), ("a", "2026-01-01 00:01:00", "z"), ("b", "2026-01-01 00:02:00", "In English\nq")]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "k string, t string, text string").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t timestamp, text string").json(str(tmp_path / "in"))
    for name, out in (("firsts", jobs.first_seen(stream, "k", "t")), ("texts", jobs.cleaned(stream))):
        q = out.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert sorted(r.k for r in spark.table("firsts").collect()) == ["a", "b"]
    assert sorted(r.text for r in spark.table("texts").collect()) == ["q", "x y", "z"]


def test_text_helpers(spark):
    d = spark.createDataFrame([("https://www.a.com:80/x/y?q=1",)], "u string")
    u = F.col("u")
    assert tuple(d.select(T.domain(u), T.base_url(u), T.url_slug(u), T.category(u), T.safe_label(F.lit("__A b!"))).first()) == ("a.com:80", "https://www.a.com:80", "x_y?q=1", "x_y", "a_b")


def test_words_and_tokens_are_counted_in_arrow_slices(spark):
    odd = [None, "", " \u2003x\x1cy\x85\r\n\rz \u3000", "a_1 Ñandú½x—٣", "w " * 500, "\r\r\n", "\x1f"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, t string").coalesce(1)
    out = d.select("t", T.word_count(F.col("t")).alias("n"), T.tokens(F.lower("t")).alias("k"), T.strip(F.col("t")).alias("s"), T.rstrip(F.col("t")).alias("r"), T.fold_newlines(F.col("t")).alias("f"))
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        if r.t is None:
            assert (r.n, r.k, r.s, r.r, r.f) == (-1, None, None, None, None)
        else:
            assert (r.n, r.s, r.r, r.f) == (len(r.t.split()), r.t.strip(), r.t.rstrip(), r.t.replace("\r\n", "\n").replace("\r", "\n"))
            assert r.k == "".join(c if c.isalnum() or c == "_" else " " for c in r.t.lower()).split()
    assert max(len(b) for b in T.sliced(len, T.pa.int32())(iter([T.pa.array(["ab"] * 200)]))) == 200


def test_pairs_of_many_parts_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    sets = [set(rng.sample(range(40), rng.randrange(1, 12))) | ({97, 98, 99} if i % 2 else set()) for i in range(90)] + [set()]
    rows = [(f"d{i}", 1000 - i, len(s), sorted(x * 0x9E3779B97F4A7C15 % 2**64 - 2**63 for x in s)) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "doc_id string, doc_pos long, n_tokens int, shingles array<long>")
    monkeypatch.setattr(dedup, "MEMBERS", 100)  # a part for so many members
    for t in (0.5, 0.85):
        want = {(f"d{j}", f"d{i}"): len(a & sets[j]) / len(a | sets[j]) for i, a in enumerate(sets) for j in range(i + 1, len(sets)) if a and len(a & sets[j]) / len(a | sets[j]) >= t}
        assert {(r.left_id, r.right_id): r.similarity for r in dedup.jaccard_pairs(df, t).collect()} == pytest.approx(want)


def test_pages_of_one_url_are_numbered_by_position(spark):
    p = spark.createDataFrame([("http://a.com/x", f"text {i}", i) for i in range(40, 0, -1)] + [("http://a.com/a", "", 99)], "url string, content string, doc_pos long").repartition(6)
    got = [(r.doc_id, r.content) for r in crawl.articles(p).orderBy("doc_id").collect()]
    assert got == [("0001", "")] + [(f"{i + 1:04d}", f"text {i}") for i in range(1, 41)]


def test_english_words_are_dropped_without_a_shuffle_of_texts(spark):
    d = spark.createDataFrame([(1, "la Rice rice, ( the ) x\x1crice ñrice\n \t\nthe and"), (2, None), (3, "")], "doc_id int, text string")
    lex = spark.createDataFrame([("rice", "en", 4.5), ("rice", "es", 3.4), ("la", "en", 6.0), ("la", "es", 7.0)], "word string, lang string, zipf double")
    out = clean.drop_english(d, lex)
    assert {r.doc_id: r.text for r in out.collect()} == {1: "la Rice, () x \x1c ñrice\n \t", 3: ""}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_text_shards_are_few_files(spark, tmp_path):
    texts = {f"{i:04d}.md": f"<p>\u2028é\r\n\"{i}\\\x00\n" for i in range(200)} | {"e.md": ""}
    files.write_text_shards(spark.createDataFrame(list(texts.items()), "filename string, text string").repartition(3), str(tmp_path / "t"))
    assert len(list((tmp_path / "t").rglob("part-*"))) == 3
    assert {r.filename: r.text for r in files.read_text_shards(spark, str(tmp_path / "t")).collect()} == texts
