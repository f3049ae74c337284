"""Main text of web pages by a site style tree.

The element trees of all pages of a host are merged: a node is a path of block elements with their classes.
For every node two entropies over the host's pages are computed, of its content and of its presentation (the
sequence of its children), each as a share of the most it could be. Menus, notices and the like look and read the
same on every page, so their importance is low and the branch is removed from each page; articles differ.
A host of few pages leans on the same path at all hosts. This decides inside articles as well as outside.

Names lean the decision. An article or main element raises the importance of what it holds. A class or id such as
``related``, or a place outside the page's article, makes a branch doubted: it goes unless the host's pages show that
it differs. Elements for navigation and forms go whatever their importance, and so do adverts and comments, which
differ on every page as content does.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopspan.llm.urlfilter import host_of
from shopspan.sources.staging import staged

#: Branches of less importance go.
LEAST_IMPORTANCE = 0.2
#: Pages that the importance at all hosts counts for at each host.
PRIOR_PAGES = 8.0

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title".split())
SKIPPED = frozenset("noscript template iframe svg math select button object audio video canvas".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog".split())
MAIN = frozenset("article main".split())
VOID = frozenset("br hr img input link meta area base col embed source track wbr".split())
#: A start of the first name closes an open element of these names.
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
#: Words in classes and ids of branches that are mostly beside the content.
ASIDE_NAMES = frozenset(
    "sponsor promo promotion banner cookie cookies consent notice notices alert popup modal overlay nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside widget header masthead footer foot copyright share sharing social related "
    "recommended newsletter subscribe signup login search form replies respond discussion toolbar pagination pager "
    "tags".split()
)
#: Adverts and comments differ from page to page, so entropies cannot tell them from content.
ADVERT_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsored".split())
COMMENT_NAMES = frozenset("comment comments reply disqus".split())
#: A class or id with one of these (``page-with-comments``) tells what a wrapper holds, not what it is.
HOLDER_WORDS = frozenset("with without has no".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: The only ids of sections inside an article that count; others are made from heading texts.
COMMENT_IDS = frozenset("comment comments respond disqus_thread".split())
#: Elements that hold no page, so an article inside them is not the page's.
HOLDS_NO_PAGE = OUTSIDE - {"header", "form"}
#: How a branch stands to the content. The last two always go; an article inside the last one goes too.
CONTENT, DOUBTED, BESIDE, CLOSED = 0, 1, 2, 3
#: Where a block is: outside, inside a main element, inside an article.
IN_MAIN, IN_ARTICLE = 1, 2

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])([^\s\"'=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_PART = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _names(attributes: str, name: str, main: int) -> list[list[str]]:
    """Words of every class, id and role; ids of headings, and of sections in an article, are anchors and no names."""
    if "=" not in attributes:
        return []
    out = []
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "id" and (name in HEADINGS or name == "section" and main and value.lower() not in COMMENT_IDS):
            continue
        if key in ("class", "id", "role"):
            out += [_PART.findall(_CAMEL.sub(" ", x).lower()) for x in value.split()]
    return out


def _place(name: str, names: list[list[str]], beside: int, main: int) -> int:
    """How an element stands to the content, from its own names and from where it is."""
    if name in ("html", "body"):
        return beside
    own = {w for n in names if HOLDER_WORDS.isdisjoint(n) for w in n}
    if not COMMENT_NAMES.isdisjoint(own):
        return CLOSED
    if name in MAIN:
        return beside if beside == CLOSED or main == IN_ARTICLE else CONTENT
    if main:
        own.discard("header")
    if name in OUTSIDE and not (name == "header" and main):
        return max(beside, CLOSED if name in HOLDS_NO_PAGE else BESIDE)
    if not ADVERT_NAMES.isdisjoint(own):
        return max(beside, BESIDE)
    return max(beside, CONTENT if ASIDE_NAMES.isdisjoint(own) else DOUBTED)


def blocks(page: str) -> Iterator[tuple[str, str, int, int]]:
    """(path, text, standing to the content, in main or article) of each block with text, in order."""
    stack: list[tuple[str, str, int, int]] = [("", "", CONTENT, 0)]
    text: list[str] = []
    at, size = 0, len(page)

    def flush():
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if whole:
                _, path, beside, main = stack[-1]
                yield path, whole, beside, main

    while at < size:
        found = _TAG.search(page, at)
        if found is None:
            text.append(page[at:])
            break
        if found.start() > at:
            text.append(page[at: found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name in RAW or name in SKIPPED:
            if not found[1] and not found[0].endswith("/>"):
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size if name in RAW else at
            continue
        if name not in BLOCKS:
            if name == "br":
                text.append(" ")
            continue
        yield from flush()
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in VOID:
            continue
        closed = CLOSES.get(name, {"p"})
        while stack[-1][0] in closed:
            stack.pop()
        _, path, beside, main = stack[-1]
        names = _names(found[3], name, main)
        words = sorted({w for n in names for w in n})
        within = IN_ARTICLE if name == "article" else max(main, IN_MAIN if name == "main" else 0)
        stack.append((name, ".".join([f"{path}/{name}", *words]), _place(name, names, beside, main), within))
    yield from flush()


def judged_blocks(page: str) -> list[tuple[str, str, bool, int]]:
    """(path, text, doubted, in main or article) of the blocks that the style tree decides on."""
    found = [b for b in blocks(page) if b[2] < BESIDE]
    article = any(main and not beside for _, _, beside, main in found)
    return [(path, text, bool(beside or article and not main), main) for path, text, beside, main in found]


def main_text(page: str, unimportant: frozenset[str] | set[str] = frozenset(),
              important: frozenset[str] | set[str] = frozenset()) -> str:
    """The kept blocks, joined by an empty line: doubted ones only if important, others unless unimportant.

    An article that the host repeats as a whole is a copy, not a menu: if none of its blocks would stay, those not
    doubted do. Nothing kept: the page has no text.
    """
    found = judged_blocks(page)
    kept = [path in important if doubted else path not in unimportant for path, _, doubted, _ in found]
    if not any(k for k, b in zip(kept, found) if b[3]):
        kept = [k or bool(main) and not doubted for k, (_, _, doubted, main) in zip(kept, found)]
    return "\n\n".join(b[1] for k, b in zip(kept, found) if k)


def _nodes(batches):
    for batch in batches:
        hosts, paths, contents, shapes, inside, doubts = [], [], [], [], [], []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            merged: dict[str, list[str]] = {}
            shape: dict[str, list[str]] = {}
            standing: dict[str, tuple[bool, bool]] = {}
            for path, text, doubted, main in judged_blocks(page):
                merged.setdefault(path, []).append(text)
                parent, _, label = path.rpartition("/")
                shape.setdefault(path, []).append("text")
                shape.setdefault(parent, []).append(label)
                standing[path] = (bool(main), doubted or standing.get(path, (False, False))[1])
            for path, texts in merged.items():
                hosts.append(host)
                paths.append(path)
                contents.append("\n".join(texts))
                shapes.append(" ".join(shape[path]))
                inside.append(standing[path][0])
                doubts.append(standing[path][1])
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.string()) for x in (hosts, paths, contents, shapes)), pa.array(inside, pa.bool_()),
             pa.array(doubts, pa.bool_())], ["host", "path", "content", "shape", "inside", "doubted"]
        )


def _entropies(nodes: DataFrame, value: str) -> DataFrame:
    """Entropy of ``value`` over a node's pages as a share of the logarithm of their number; one page: 1."""
    counts = nodes.groupBy("host", "path", F.xxhash64(value).alias("v")).agg(
        F.count(F.lit(1)).cast("double").alias("c"), F.max("inside").alias("inside"), F.max("doubted").alias("doubted")
    )
    sums = counts.groupBy("host", "path").agg(
        F.sum("c").alias("pages"), F.sum(F.col("c") * F.log("c")).alias("s"), F.max("inside").alias("inside"),
        F.max("doubted").alias("doubted"),
    )
    share = (F.log("pages") - F.col("s") / F.col("pages")) / F.log("pages")
    return sums.select("host", "path", "pages", "inside", "doubted", F.when(F.col("pages") > 1, share).otherwise(1.0).alias(value))


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, pages, content, shape, importance, doubted, shown of every node. ``pages`` has host and html.

    ``importance`` leans on the path at all hosts, inside an article also on PRIOR_PAGES pages of full importance.
    ``doubted``: the branch is so on some page; there ``shown`` decides, which leans on no importance and takes a
    host's first page for no evidence.
    """
    nodes = staged(
        pages.mapInArrow(
            _nodes, "host string, path string, content string, shape string, inside boolean, doubted boolean"
        ).select("host", "path", F.xxhash64("content").alias("content"), F.xxhash64("shape").alias("shape"), "inside", "doubted"),
        "nodes",
    )
    tree = _entropies(nodes, "content").join(
        _entropies(nodes, "shape").drop("pages", "inside", "doubted"), ["host", "path"]
    )
    tree = tree.withColumn("own", (F.col("content") + F.col("shape")) / 2)
    own, pages, more = F.col("own"), F.col("pages"), F.col("pages") - 1
    everywhere = tree.groupBy("path").agg(
        (F.sum(own * pages) / F.sum(pages)).alias("prior"),
        (F.sum(own * more) / (F.sum(more) + PRIOR_PAGES)).alias("doubt"),
    )
    lean = F.when(F.col("inside"), PRIOR_PAGES).otherwise(0.0)
    return tree.join(everywhere, "path").select(
        "host", "path", "pages", "content", "shape",
        ((own * pages + F.col("prior") * PRIOR_PAGES + lean) / (pages + PRIOR_PAGES + lean)).alias("importance"),
        "doubted", ((own * more + F.col("doubt") * PRIOR_PAGES) / (more + PRIOR_PAGES)).alias("shown"),
    )


def _extract(batches):
    for batch in batches:
        texts = [
            main_text(page, set(low or ()), set(high or ()))
            for page, low, high in zip(*(batch.column(c).to_pylist() for c in ("html", "low", "high")))
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row.

    Needs page_id, url and html; other columns are not read. Blocks follow page order, white space inside a
    block is one space, an empty line stands between blocks; character references are decoded. A null or empty
    page has an empty text; null URLs share the empty host; null ids and repeated rows stay. A path exactly at the
    threshold is kept. An empty table gives an empty result.

    Scale: pages are parsed where they lie. Contents leave a task as hashes, are counted per host and path
    with partial sums, and only paths of low importance, and doubted ones that are shown, meet the pages again, one
    row a host.
    """
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.coalesce("url", F.lit(""))).alias("host")
    )
    is_low, is_shown = F.col("importance") < LEAST_IMPORTANCE, F.col("doubted") & (F.col("shown") >= LEAST_IMPORTANCE)
    decided = staged(
        style_tree(rows.select("host", "html")).where(is_low | is_shown).groupBy("host").agg(
            F.collect_list(F.when(is_low, F.col("path"))).alias("low"),
            F.collect_list(F.when(is_shown, F.col("path"))).alias("high"),
        ), "decided",
    )
    return rows.join(decided, "host", "left").select("page_id", "url", "html", "low", "high").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
