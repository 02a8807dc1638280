"""Queries of the cleaning operators."""

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import clean as C
from corpusmill.operators import markup as M
from corpusmill.plans.registry import NSP, SP, docs, fold, query, strip, table

# fixed texts that the driver's tables have no case of
FIXTURES = [
    (-1, "Saltar a la navegación principal\nIn English\nSALTAR A:\nmostrar ↓\nContenido\nTexto útil\n---\n• • \n———\n \nFin"),
    (-2, "Una línea\n\ncontinúa aquí\ny sigue\n- lista\n1. otra\nfin (\ncerrado\n, coma\n\n\n\nNueva frase.\nOtra"),
    (-3, "  Por **Nombre** ** - Revisado:   hoy ** __ x\t\ty \r\nz  \r\r\n\n\n\nw"),
    (-4, ""),
    (-5, "***\nskip to content\nSKIP TO: x\nshow more ▼ now\nEspañol\nenglish lesson\n─────"),
]
VALUES = ", ".join("({}, '{}')".format(i, t.replace("'", "''").replace("\r", "' || chr(13) || '").replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '")) for i, t in FIXTURES)
SOURCE = f"src AS (SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES {VALUES}) f(doc_id, text))"


def source(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", "text").union(spark.createDataFrame(FIXTURES, "doc_id long, text string"))


def noise_sql(x: str) -> str:
    b = strip("l")
    bad = " OR ".join(
        f"regexp_full_match({b}, '{p}', 's')"
        for p in (
            r"(?i)(saltar a|saltar al|skip to)([^\p{L}\p{N}_].*)?", r"(?i)(in english|en español|english|español)", r"(?i)(saltar a:|skip to:|contenido|table of contents)",
            r"(?i)(mostrar|show)([^\p{L}\p{N}_].*)?[↓▲▼].*", r"[-*•]+", r"[—–―‑─]{2,}",
        )
    )
    return f"array_to_string(list_filter(string_split({x}, chr(10)), lambda l: {b} = '' OR NOT ({bad})), chr(10))"


def space_sql(x: str) -> str:
    x = f"regexp_replace({fold(x)}, '[ \\t]+', ' ', 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(f"array_to_string(list_transform(string_split({x}, chr(10)), lambda l: regexp_replace(l, '{SP}+$', '')), chr(10))")


def punctuation_sql(x: str) -> str:
    one = rf"'(^|{SP})[*_`]+({SP}|$)', '\1\2', 'g'"
    x = f"regexp_replace(regexp_replace({x}, {one}), {one})"
    x = f"regexp_replace({x}, ' {{2,}}', ' ', 'g')"
    return strip(f"array_to_string(list_transform(string_split({x}, chr(10)), lambda l: {strip('l')}), chr(10))")


def joiner_sql(src: str) -> str:
    """CTEs that end in joined (doc_id, text): of each run of lines that go on, every second link from its start is taken."""
    listed = rf"'^{SP}*([-*•]|\d+\.){SP}+'"
    return rf"""l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {src}),
nb AS (SELECT *, lead(i) OVER w AS ni, lead(line) OVER w AS nl FROM l WHERE {strip('line')} <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT doc_id, i, ni, line, nl, regexp_replace(line, '{SP}+$', '') AS a, regexp_replace(nl, '^{SP}+', '') AS b FROM nb),
g AS (SELECT *, coalesce(ni - i <= 2 AND CASE WHEN regexp_matches(a, {listed}) OR regexp_matches(b, {listed}) OR regexp_matches(a, '[.!?]$') THEN false
  WHEN regexp_matches(b, '^[,.;:!?)\]}}]') OR regexp_matches(a, '[(\[{{]$') THEN true
  WHEN ni - i = 2 THEN regexp_matches(b, '^[a-záéíóúñü]') ELSE regexp_matches(b, '(?i)^[a-záéíóúñü]') END, false) AS go FROM k),
r AS (SELECT *, row_number() OVER w AS rn, sum(CASE WHEN go THEN 0 ELSE 1 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS isl FROM g WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
took AS (SELECT *, go AND (row_number() OVER (PARTITION BY doc_id, coalesce(isl, 0) ORDER BY i)) % 2 = 1 AS take FROM r),
eaten AS (SELECT doc_id, unnest(range(i + 1, ni + 1)) AS i FROM took WHERE take),
o AS (SELECT l.doc_id, l.i, CASE WHEN took.take THEN took.a || ' ' || {strip('took.nl')} ELSE regexp_replace(l.line, '{SP}+$', '') END AS x
  FROM l LEFT JOIN took ON took.doc_id = l.doc_id AND took.i = l.i LEFT JOIN eaten e ON e.doc_id = l.doc_id AND e.i = l.i WHERE e.i IS NULL),
joined AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS text FROM o GROUP BY doc_id)"""


@query(f"WITH {SOURCE} SELECT doc_id, {noise_sql('text')} AS out FROM src")
def noise_filter_lines(spark, sf_dir):
    return source(spark, sf_dir).select("doc_id", C.drop_noise(F.col("text")).alias("out"))


@query(f"WITH {SOURCE} SELECT doc_id, {space_sql('text')} AS out FROM src")
def whitespace_normalize(spark, sf_dir):
    return source(spark, sf_dir).select("doc_id", C.normalize_space(F.col("text")).alias("out"))


@query(f"WITH {SOURCE} SELECT doc_id, {punctuation_sql('text')} AS out FROM src")
def inline_punct_cleanup(spark, sf_dir):
    return source(spark, sf_dir).select("doc_id", C.tidy_punctuation(F.col("text")).alias("out"))


@query(f"WITH {SOURCE}, {joiner_sql('src')} SELECT doc_id, text AS out FROM joined")
def line_joiner(spark, sf_dir):
    return source(spark, sf_dir).select("doc_id", C.join_wrapped(F.col("text")).alias("out"))


@query(f"WITH {SOURCE}, pre AS (SELECT doc_id, {space_sql(noise_sql('text'))} AS text FROM src), {joiner_sql('pre')} SELECT doc_id, {punctuation_sql('text')} AS out FROM joined")
def clean_pipeline_text(spark, sf_dir):
    return source(spark, sf_dir).select("doc_id", C.clean(F.col("text")).alias("out"))


@query(f"SELECT doc_id, text FROM documents WHERE length({strip('text')}) >= 100")
def min_length_filter(spark, sf_dir):
    return docs(spark, sf_dir).filter(F.length(T.strip(F.col("text"))) >= 100).select("doc_id", "text")


@query(f"""SELECT printf('%04d', doc_id) AS doc_id, coalesce(source, 'unknown') AS domain, printf('%04d', doc_id) || '_' || replace(coalesce(source, 'unknown'), '.', '_') || '_' || lang || '.txt' AS filename,
len(regexp_extract_all(text, '{NSP}+'))::INT AS word_count, length(text)::INT AS char_count FROM documents WHERE length({strip('text')}) >= 100""")
def processed_metadata(spark, sf_dir):
    d = docs(spark, sf_dir).filter(F.length(T.strip(F.col("text"))) >= 100)
    key, domain = F.format_string("%04d", "doc_id"), F.coalesce("source", F.lit("unknown"))
    name = F.concat(F.concat_ws("_", key, F.translate(domain, ".", "_"), F.col("lang")), F.lit(".txt"))
    return d.select(key.alias("doc_id"), domain.alias("domain"), name.alias("filename"), T.word_count(F.col("text")).alias("word_count"), F.length("text").alias("char_count"))


@query(f"SELECT CASE WHEN text IS NULL THEN 'missing' WHEN length({strip('text')}) < 100 THEN 'short' ELSE 'processed' END AS status, count(*) AS documents FROM documents GROUP BY 1")
def process_status_counts(spark, sf_dir):
    status = F.when(F.col("text").isNull(), "missing").when(F.length(T.strip(F.col("text"))) < 100, "short").otherwise("processed")
    return docs(spark, sf_dir).groupBy(status.alias("status")).agg(F.count("*").alias("documents"))


FRONT = [(-1, "---\ntitle: x\n---\n\nBody\n---\nmore"), (-2, "---\nunclosed\nBody"), (-3, "no\n---\nx\n---\n"), (-4, "---\na: 1\n  ---  \nBody"), (-5, "---\n---\nBody"), (-6, "---\na\n---")]
FRONT_VALUES = ", ".join("({}, '{}')".format(i, t.replace("\n", "' || chr(10) || '")) for i, t in FRONT)


FRONT_SOURCE = f"f AS (SELECT doc_id AS id, text FROM documents UNION ALL SELECT * FROM (VALUES {FRONT_VALUES}) v(id, text))"


@query(f"""WITH {FRONT_SOURCE},
l AS (SELECT id, text, string_split(text, chr(10)) AS l FROM f),
c AS (SELECT id, text, l, list_position(list_transform(l[2:], lambda x: trim(x)), '---') AS k FROM l)
SELECT id, CASE WHEN l[1] = '---' AND len(l) > 1 AND k > 0 THEN regexp_replace(array_to_string(l[k + 2:], chr(10)), '^\\n', '') ELSE text END AS out FROM c""")
def frontmatter_strip(spark, sf_dir):
    """documents and the fixtures, which have negative ids."""
    return docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "text").union(spark.createDataFrame(FRONT, "id long, text string")).select("id", T.strip_frontmatter(F.col("text")).alias("out"))


@query(f"WITH {FRONT_SOURCE}, l AS (SELECT id, text, string_split(text, chr(10)) AS l FROM f) SELECT id, array_to_string(l[1:12], chr(10)) || CASE WHEN len(l) > 12 THEN chr(10) ELSE '' END AS preview FROM l")
def text_preview(spark, sf_dir):
    return docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "text").union(spark.createDataFrame(FRONT, "id long, text string")).select("id", T.preview(F.col("text")).alias("preview"))


def html_sql(x: str) -> str:
    for pattern, to in (("(?s)<!--.*?-->", "''"), ("(?is)<script[^>]*>.*?</script>", "''"), ("(?is)<style[^>]*>.*?</style>", "''"), ("<[^>]*>", "chr(10)"), (r"\n+", "chr(10)")):
        x = f"regexp_replace({x}, '{pattern}', {to}, 'g')"
    for k, v in M.ENTITIES.items():
        x = f"replace({x}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return rf"regexp_replace({x}, '^\n|\n$', '', 'g')"


@query(f"SELECT page_id, {html_sql('html')} AS text FROM pages")
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", M.html_text(F.col("html")).alias("text"))


@query(f"""WITH p AS (SELECT page_id, html AS raw, {html_sql('html')} AS txt FROM pages)
SELECT page_id, length(raw) AS raw_chars, length(txt) AS text_chars, len(string_split(raw, chr(10))) AS raw_lines, len(string_split(txt, chr(10))) AS text_lines,
CASE WHEN length(raw) = 0 THEN 0.0 ELSE round((length(raw) - length(txt)) / length(raw) * 100, 1) END AS reduction FROM p""")
def page_raw_vs_text_stats(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("raw"), M.html_text(F.col("html")).alias("txt"))
    n = lambda c: F.length(c).cast("long")
    cut = F.when(n("raw") == 0, 0.0).otherwise(F.round((n("raw") - n("txt")) / n("raw") * 100, 1))
    return p.select("page_id", n("raw").alias("raw_chars"), n("txt").alias("text_chars"), F.size(T.lines(F.col("raw"))).cast("long").alias("raw_lines"), F.size(T.lines(F.col("txt"))).cast("long").alias("text_lines"), cut.alias("reduction"))


#: Signs that could be Markdown, entities or escapes, and lines that could be list items, rules or tables.
MARKUP = r"[*_`#>|&<!~\[\]()+=\\-]|\t|  |\d[.)]"


def plain_sql(x: str) -> str:
    return rf"NOT regexp_matches({x}, '[*_`#>|&<!~\[\]()+=\\-]|\t|  |\d[.)]')"


def markdown_sql(x: str) -> str:
    return f"array_to_string(list_filter(list_transform(string_split({x}, chr(10)), lambda l: {strip('l')}), lambda l: l <> ''), chr(10))"


MARKDOWN = [(-1, "# Titulo\n\nTexto con **negrita** y [enlace](http://x.com/a).\n\n- uno\n- dos\n\n---\n\n| A | B |\n|---|---|\n| c1 | c2 |\n"), (-2, "> cita\n\n```\ncode *x*\n```\n![pic](a.png) fin &amp; ya")]


#: What the fixtures above must give.
MARKDOWN_TEXT = ["Titulo\nTexto con \nnegrita\n y \nenlace\n.\nuno\ndos\nA\nB\nc1\nc2", "cita\ncode *x*\n fin & ya"]
MARKDOWN_VALUES = ", ".join("({}, '{}')".format(i, t.replace("'", "''").replace("\n", "' || chr(10) || '")) for (i, _), t in zip(MARKDOWN, MARKDOWN_TEXT, strict=True))


@query(f"SELECT * FROM (VALUES {MARKDOWN_VALUES}) v(id, out) UNION ALL SELECT doc_id AS id, {markdown_sql('text')} AS out FROM documents WHERE {plain_sql('text')}")
def markdown_to_text(spark, sf_dir):
    """The fixtures, and all documents whose text has no sign that is Markdown: there the text nodes are the paragraphs."""
    fixtures = spark.createDataFrame(MARKDOWN, "id long, text string")
    plain = docs(spark, sf_dir).filter(~F.col("text").rlike(MARKUP)).select(F.col("doc_id").alias("id"), "text")
    return fixtures.union(plain).select("id", M.markdown(F.col("text")).alias("out"))


ENGLISH = ", ".join(f"'{w}'" for w in C.ENGLISH_STOPWORDS)


@query(rf"""WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS word FROM documents WHERE lang IN ('en', 'es')),
c AS (SELECT lang, word, count(*) AS c FROM w GROUP BY 1, 2),
z AS (SELECT word, lang, round(log10(c / (sum(c) OVER (PARTITION BY lang)) * 1e9), 2) AS zipf FROM c),
x AS (SELECT word, coalesce(max(zipf) FILTER (lang = 'en'), 0) AS en, coalesce(max(zipf) FILTER (lang = 'es'), 0) AS es FROM z GROUP BY word),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents WHERE lang = 'es'),
p AS (SELECT doc_id, ln, line, {strip('line')} = '' AS blank, CASE WHEN {strip('line')} <> '' THEN regexp_extract_all(line, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]') ELSE [] END AS k FROM l),
t AS (SELECT doc_id, ln, pos, k[pos] AS token FROM (SELECT doc_id, ln, k, unnest(range(1, len(k) + 1)) AS pos FROM p)),
kept AS (SELECT t.doc_id, t.ln, array_to_string(list(token ORDER BY pos), ' ') AS joined FROM t LEFT JOIN x ON x.word = lower(t.token)
  WHERE CASE WHEN NOT regexp_matches(token, '^[\p{{L}}\p{{N}}_]') THEN true WHEN lower(token) IN ({ENGLISH}) THEN false WHEN length(token) <= 2 THEN true
    WHEN regexp_matches(token, '^\p{{Lu}}') OR regexp_matches(token, '[áéíóúñüÁÉÍÓÚÑÜ]') OR coalesce(es, 0) >= 3.5 THEN true
    ELSE NOT (coalesce(en, 0) >= 2.5 AND coalesce(en, 0) - coalesce(es, 0) >= 1.0) END GROUP BY t.doc_id, t.ln),
o AS (SELECT p.doc_id, p.ln, CASE WHEN blank THEN line WHEN {strip("coalesce(joined, '')")} <> '' THEN
  regexp_replace(regexp_replace(regexp_replace(joined, '\s+([.,;:!?)])', '\1', 'g'), '([¿¡(])\s+', '\1', 'g'), ' {{2,}}', ' ', 'g') END AS out
  FROM p LEFT JOIN kept ON kept.doc_id = p.doc_id AND kept.ln = p.ln)
SELECT doc_id, coalesce(string_agg(out, chr(10) ORDER BY ln), '') AS text FROM o GROUP BY doc_id""")
def english_filter_tokens(spark, sf_dir):
    from corpusmill.operators.metrics import lexicon

    d = table(spark, sf_dir, "documents")
    return C.drop_english(d.filter("lang = 'es'").select("doc_id", "text"), lexicon(d.filter("lang in ('en', 'es')")))
