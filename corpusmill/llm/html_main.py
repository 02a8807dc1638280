"""HTML extraction: equivalence-class template deduction over pages of a host.

Pages of a host are dealt out in groups of about `group` pages (hosts of any size, so none meets in one task).  In a group,
every token (a tag with its class and path, or a text with its path) has an occurrence vector: how often it stands in
each page.  Tokens that share a vector and occur in most pages form an equivalence class; a class is valid if its tokens
follow each other in the same order, once or again and again, in all of its pages.  Valid classes nest by their gaps, in
which tokens get vectors of their own, and make the template.  What is left, text in the gaps between template tokens,
fills slots: a slot is the gap behind a template token of a class, and the path of the text in it.

Slots are decided for a whole group, by what all of its pages show of them.  A slot inside menus, headers, footers, sidebars,
notices, adverts, forms and comments goes.  If letters of a slot stand in an article or main element on most pages, it is
a main slot.  A page that has main slots keeps these, template texts among them (an article that several pages carry is text
all the same).  A page without keeps all slots that are left, however short, and template texts only at paths where most pages
have text of their own."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import partitions, shared_dir, small_batches

RESULT = "page_id long, url string, text string, n_chars long"

# fixed values
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
AWAY = set("aside button canvas dialog footer form head header iframe input label menu nav noscript object option script select style svg template textarea title".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = {"ul", "ol", "dl", "table", "select"}
ROLES = set("banner navigation contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_AWAY_NAME = re.compile(  # anywhere in a class or id
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|copyright|disqus|footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|overlay|pager|pagination|popup|promo\w*|related|replies|reply|respond|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])"
)
_AWAY_IN_MAIN = re.compile(  # a whole class or id, but for words of layout around it: a chapter on social history is text
    r"(?:^|\s)(?:(?:article|block|box|entry|inner|main|page|post|site|top)[_-])*(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|copyright|disqus|footer|gdpr|login|menu|modal|nav|navbar|navigation|newsletter|notice|overlay|pager|pagination|popup|promo\w*|related|replies|respond|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|toolbar|widget)"
    r"(?:[_-](?:area|articles?|banner|bar|block|bottom|box|buttons?|card|container|content|footer|form|header|icons?|inline|inner|items?|left|links?|list|message|module|news|panel|posts?|right|row|section|slot|stories|text|title|top|unit|widget|wrap|wrapper|\d+))*(?:$|\s)"
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([a-z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.IGNORECASE)
_SPACE = re.compile(r"\s+")


def parse(page: str | None) -> list[tuple[int, str, int, bool, bool, int]]:
    """Tokens of a page: (key, text, block, away, main, path); text is empty for tags, the key 0 for white space.

    A path is a hash of its tags and names, so that deep pages take no more room than flat ones."""
    out: list[tuple[int, str, int, bool, bool, int]] = []
    if not page:
        return out
    stack: list[tuple[str, bool, bool, int]] = [("", False, False, 1)]  # tag, away, main, path
    open_: Counter = Counter()  # tags of the stack: what is not open is not looked for
    block, at = 0, 0

    def text(raw: str) -> None:
        if raw:
            _, away, main, path = stack[-1]
            # character references first: they can stand for white space
            out.append((hash((path, raw)) if not raw.isspace() else 0, html.unescape(raw), block, away, main, path))

    def close(depth: int) -> None:
        nonlocal block
        for tag, *_ in stack[depth:]:
            block += tag in BLOCKS
            open_[tag] -= 1
        del stack[depth:]

    def innermost(tags: set[str], stop: set[str] = frozenset()) -> int:
        """Depth of the innermost open one of tags, none of stop inside it; 0 if there is none."""
        if any(open_[t] > 0 for t in tags):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in tags:
                    return i
                if stack[i][0] in stop:
                    break
        return 0

    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if m[2]:
            if i := innermost({tag}):
                close(i)
            else:
                block += tag in BLOCKS
            continue
        if tag == "br":
            text(" ")
            continue
        # a block ends an open paragraph of the same container, an item the one before it, a body the head
        if tag in BLOCKS and (i := innermost({"p"}, BLOCKS - {"p"})):
            close(i)
        if tag in CLOSES and (i := innermost(CLOSES[tag], LISTS)):
            close(i)
        if tag == "body" and (i := innermost({"head"})):
            close(i)
        block += tag in BLOCKS
        attributes = {a.lower(): html.unescape(x or y or z or "") for a, x, y, z in _ATTRIBUTE.findall(m[4])} if m[4].strip() else {}
        name = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().strip()
        _, away, main, path = stack[-1]
        is_main = tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article")
        comment = re.search(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies))(?:$|[\s_-])", name) is not None
        marked = attributes.get("role", "").lower() in ROLES or attributes.get("aria-hidden") == "true" or bool(m[4] and _HIDDEN.search(m[4]))
        if is_main and not comment and not (main and away):
            away, main = False, True
        elif tag in AWAY or marked or name and (_AWAY_IN_MAIN if main else _AWAY_NAME).search(name):
            away = True
        elif tag in HEADINGS and main and away and stack[-1][0] == "header" and not stack[-2][1]:
            away = False  # the title in an article's own header
        here = hash((path, tag, name, marked))
        out.append((here, "", block, away, main, here))
        if tag not in VOID and not m[4].rstrip().endswith("/"):
            stack.append((tag, away, main, here))
            open_[tag] += 1
    tail = page[at:]
    text(tail)
    return out


def template(pages: list[list[tuple]], least: int = 3) -> list[dict[int, int]]:
    """Per page, the places of its tokens that stand in valid equivalence classes, and each one's class.

    A class cuts each of its spans into gaps: before its first token, between two that follow each other, and behind its last.
    The gaps between the same two tokens, over all pages and repetitions, are searched for classes of their own."""
    out: list[dict[int, int]] = [{} for _ in pages]
    common = Counter(key for tokens in pages for key in {t[0] for t in tokens if t[0]})
    common = {key for key, n in common.items() if n >= least and 2 * n >= len(pages)}
    todo, number = [[(i, [j for j, t in enumerate(tokens) if t[0] in common]) for i, tokens in enumerate(pages)]], 0
    while todo:
        spans = [(i, at) for i, at in todo.pop() if at]
        vectors: dict[int, dict[int, int]] = defaultdict(dict)
        for n, (i, at) in enumerate(spans):
            for key, times in Counter(pages[i][j][0] for j in at).items():
                vectors[key][n] = times
        classes: dict[tuple, list[int]] = defaultdict(list)
        for key, vector in vectors.items():
            if 2 * (on := len({spans[n][0] for n in vector})) >= len(pages) and on >= least:
                classes[tuple(vector.items())].append(key)
        for vector, keys in sorted(classes.items(), key=lambda x: -len(x[0]) * len(x[1])):
            if gaps := cut(pages, [spans[n] for n, _ in vector], set(keys), number, out):
                held = {n for n, _ in vector}
                todo += [*gaps, [x for n, x in enumerate(spans) if n not in held]]
                number += 1
                break
    return out


def cut(pages: list[list[tuple]], spans: list[tuple[int, list[int]]], keys: set[int], number: int, out: list[dict[int, int]]) -> list[list[tuple[int, list[int]]]]:
    """The gaps of a class, its places added to out; none if its tokens don't follow each other in one order everywhere."""
    found = [[n for n, j in enumerate(at) if pages[i][j][0] in keys] for i, at in spans]
    order = [pages[spans[0][0]][spans[0][1][n]][0] for n in found[0][: len(keys)]]
    if any([pages[i][at[n]][0] for n in mine] != order * (len(mine) // len(order)) for (i, at), mine in zip(spans, found, strict=True)):
        return []
    gaps: list[list[tuple[int, list[int]]]] = [[] for _ in range(len(order) + 2)]
    for (i, at), mine in zip(spans, found, strict=True):
        out[i].update((at[n], number) for n in mine)
        gaps[0].append((i, at[: mine[0]]))
        gaps[-1].append((i, at[mine[-1] + 1 :]))
        for x, (n, after) in enumerate(zip(mine, mine[1:], strict=False)):
            gaps[1 + x % len(order)].append((i, at[n + 1 : after]))
    return gaps


def filled(tokens: list[tuple], fixed: dict[int, int]) -> Iterator[tuple[int, tuple, bool]]:
    """(place, slot, whether it is template text) of a page's texts; a template text is a slot of its own."""
    gap: tuple = ()
    for place, token in enumerate(tokens):
        if (which := fixed.get(place)) is not None:
            gap = (which, token[0])
        if token[1]:
            yield place, gap if which is not None else (*gap, token[5]), which is not None


def extract(pages: list[str | None]) -> list[str]:
    """Main texts of a group of pages of one host."""
    parsed = [parse(p) for p in pages]
    slots = [list(filled(tokens, mine)) for tokens, mine in zip(parsed, template(parsed), strict=True)]
    letters: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0])  # of each slot: away, in a main element, elsewhere
    varied: Counter = Counter()  # pages with text of their own at a path
    for tokens, texts in zip(parsed, slots, strict=True):
        for place, slot, _ in texts:
            _, text, _, away, main, _ = tokens[place]
            letters[slot][0 if away else 1 if main else 2] += len(text)
        varied.update({tokens[place][5] for place, _, fixed in texts if not fixed and not tokens[place][1].isspace()})
    gone = {slot for slot, n in letters.items() if n[0] > n[1] + n[2]}
    main_slots = {slot for slot, n in letters.items() if n[1] >= max(1, n[0], n[2])}
    out = []
    for tokens, texts in zip(parsed, slots, strict=True):
        has_main = any(slot in main_slots and tokens[place][0] for place, slot, _ in texts)
        blocks: dict[int, list[str]] = defaultdict(list)
        for place, slot, fixed in texts:
            _, text, block, _, _, path = tokens[place]
            if slot in main_slots if has_main else slot not in gone and (not fixed or 2 * varied[path] >= len(pages)):
                blocks[block].append(text)
        lines = (_SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
        out.append("\n".join(x for x in lines if x))
    return out


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (host, part); groups stream by."""
    key, rows = None, []

    def flush() -> pa.RecordBatch:
        texts = extract([r[2] for r in rows])
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    for batch in batches:
        for host, part, page_id, url, page in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if (host, part) != key:
                if rows:
                    yield flush()
                key, rows = (host, part), []
            rows.append((page_id, url, page))
    if rows:
        yield flush()


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group: int = 64, most_broadcast: int = 100_000) -> DataFrame:
    """page_id, url, text, n_chars per row of pages; text is empty if there is none.

    Null and empty pages give an empty text.  Pages with a null url share a host of no name; rows that repeat are pages like others
    and null ids stay null; an empty table gives no rows; other columns are ignored.  Blocks are block elements; a line
    break is white space."""
    spark = pages.sparkSession
    small_batches(spark)
    shared_dir(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.withColumn("host", F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), F.lit("")))
    # smaller hosts are one group each; the list of the others is broadcast if it is short, so that pages are shuffled once
    sizes = rows.groupBy("host").agg(F.count("*").alias("n")).filter(F.col("n") > 4 * group).select("host", F.ceil(F.col("n") / group).alias("parts")).checkpoint()
    sizes = F.broadcast(sizes) if sizes.count() <= most_broadcast else sizes
    dealt = rows.join(sizes, "host", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("page_id", "url"), F.col("parts")), F.lit(0)))
    dealt = dealt.select("host", "part", "page_id", "url", "html").repartition(partitions(spark), "host", "part").sortWithinPartitions("host", "part", "page_id", "url")
    return dealt.mapInArrow(by_group, RESULT)


def op10_html_main(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
