"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of presentation: a node is the chain of block elements (tag, class, id) that leads
to a block. Two entropies rate a node over the k pages that have it. Presentation: how evenly its child sequences vary. Content:
a text on j of the pages carries log j / log k of entropy, so what repeats everywhere says nothing and unique text says most.
The rating is evidence for or against a branch, EVIDENCE * (1 - 1 / k) * (importance - 1/2), and adds to a prior by place: a
block directly in an article or main element, deeper in it, outside of the page's articles, or on a page without one. Branches
whose sum is negative are removed from every page, inside an article as well as outside: main text beside a teaser article
stays, a box that repeats in the articles of nine pages goes. Menus, headers, footers, adverts, forms and comments, by element or
name, have a prior that no evidence outweighs, as the adverts and footers of real pages often carry unique text; a name, form
or label around over half of the text in articles (of all text, on pages without one) is the page's own frame and not taken
as noise. A page of which nothing would be left, such as one of a host of copies, keeps what the priors leave.

All tree nodes are counted by aggregations over (host, node, text), combined before the shuffle; a host is never gathered in
one task, and the pages are joined with their host's list of rated nodes by Spark's own size check.

Defined results: NULL or empty html gives an empty text; a NULL url is a host of its own; repeated rows count as pages of their own;
markup that breaks off is read as far as it goes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import batches, written

#: Log odds of a block by its place, and the weight of the tree's evidence for or against it.
DIRECT, INSIDE, OUTSIDE, ALONE = 3.0, 2.0, -1.5, 1.0
EVIDENCE = 7.0
# fixed values: elements and names of HTML pages
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
            "thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set("nav footer aside form menu dialog button select option datalist label iframe noscript template svg math object "
              "canvas audio video head".split())
RAW = "script|style|title|textarea|xmp|noframes"
NOISE = set("nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts "
            "advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal "
            "overlay newsletter subscribe signup login share sharing social related recommended widget comment comments reply "
            "replies respond disqus form search pagination pager toolbar skip copyright".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_MARK = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9]*)"
    r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>|<[!?][^>]*>", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


class Block:
    """A run of text with the chain of block elements around it."""

    __slots__ = ("path", "noise", "article", "direct", "text")

    def __init__(self, path: str, noise: bool, article: bool, direct: bool, text: str) -> None:
        self.path, self.noise, self.article, self.direct, self.text = path, noise, article, direct, text


def blocks(page: str | None) -> list[Block]:
    """The page's blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, str, int]] = []  # tag, label, number of a noise element (0: it is none, -1: one that never frames a page)
    around: list[tuple[list[int], list[int]]] = []  # per block: numbers of noise around its article, of that inside
    frames = 0
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            tags = [t for t, _, _ in stack]
            place = max((k for k, t in enumerate(tags) if t in ("article", "main")), default=-1)
            out.append(Block("/".join(x for _, x, _ in stack), False, place >= 0,
                             place >= 0 and len(stack) - place <= 2, text))
            cut = place if place >= 0 else len(stack)
            around.append(([n for _, _, n in stack[:cut] if n], [n for _, _, n in stack[cut:] if n]))

    last = 0
    page = page or ""
    for mark in _MARK.finditer(page):
        if mark.start() > last:
            held.append(html.unescape(page[last:mark.start()]))
        last = mark.end()
        tag = (mark[3] or "").lower()
        if not tag:
            continue
        if tag not in BLOCK and tag not in DROPPED:
            if tag == "br":
                held.append(" ")
            continue
        flush()
        if mark[2]:
            if any(t == tag for t, _, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag in VOID:
            continue
        if stack and stack[-1][0] == "p" and tag in BLOCK:
            stack.pop()
        if tag in CLOSES:
            lists = ("ul", "ol", "dl", "table")
            while stack and stack[-1][0] in CLOSES[tag] and stack[-1][0] not in lists:
                stack.pop()
        if not mark[4].rstrip().endswith("/"):
            names = " ".join(v.strip("\"'") for _, v in _NAMES.findall(mark[4])).lower()
            inside = any(t in ("article", "main") for t, _, _ in stack)
            noise = 0
            if tag in DROPPED and tag not in ("form", "label") or tag == "header" and not inside:
                noise = -1
            elif (tag in DROPPED or not NOISE.isdisjoint(re.split(r"[^a-z]+", names))
                  and tag not in ("html", "body", "article", "main")):
                frames += 1
                noise = frames
            stack.append((tag, f"{tag}.{re.sub(r'[0-9]+', '#', names)}" if names else tag, noise))
    if last < len(page):
        held.append(html.unescape(re.sub(r"<[a-zA-Z/!][^>]*\Z", "", page[last:])))
    flush()
    some = any(b.article for b in out)
    held_by: Counter = Counter()
    total = 0
    for block, (outer, _) in zip(out, around):
        if block.article or not some:
            total += len(block.text)
            held_by.update({n: len(block.text) for n in outer if n > 0})
    framing = {n for n, size in held_by.items() if 2 * size > total}
    for block, (outer, inner) in zip(out, around):
        block.noise = bool(inner) or any(n not in framing for n in outer)
    return out


def host(column: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(column), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def _nodes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tree nodes of pages: (host, node, kind, feature, pages), summed inside the batch.

    kind 0: a page has the node (feature 0); 1: a text under it; 2: its sequence of children. Blocks known as noise are no part
    of the tree.
    """
    for batch in batches(rows):
        total: Counter = Counter()
        for site, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            children: dict[str, list[str]] = {}
            texts: dict[str, set[int]] = {}
            for block in (b for b in blocks(page) if not b.noise):
                texts.setdefault(block.path, set()).add(xxhash.xxh3_64_intdigest(block.text) >> 1)
                parent, _, own = block.path.rpartition("/")
                children.setdefault(parent, []).append(own)
            for path, found in texts.items():
                total[site, path, 0, 0] += 1
                for feature in found:
                    total[site, path, 1, feature] += 1
            for path, own in children.items():
                total[site, path, 2, xxhash.xxh3_64_intdigest("\n".join(own)) >> 1] += 1
        if total:
            columns = list(zip(*total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.int64()), pa.array(list(total.values()), pa.int64())],
                names=["host", "node", "kind", "feature", "pages"])


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance): the entropy rating of each node that holds text, from 0 to 1; 1 on a single page."""
    rows = pages.select(host().alias("host"), "html").mapInArrow(
        _nodes, "host string, node string, kind int, feature long, pages long")
    counts = rows.groupBy("host", "node", "kind", "feature").agg(F.sum("pages").alias("k"))
    seen = lambda kind: F.col("kind") == kind
    sums = counts.groupBy("host", "node").agg(
        F.sum(F.when(seen(0), F.col("k"))).alias("pages"),
        F.sum(F.when(seen(1), F.col("k"))).alias("texts"),
        F.sum(F.when(seen(1), F.col("k") * F.log("k"))).alias("text_bits"),
        F.sum(F.when(seen(2), F.col("k"))).alias("shapes"),
        F.sum(F.when(seen(2), F.col("k") * F.log("k"))).alias("shape_bits")).filter("pages is not null")
    log_m = F.log(F.greatest("pages", F.lit(2)))
    content = F.when(F.col("pages") > 1, F.greatest(F.lit(0.0), 1 - F.col("text_bits") / (F.col("texts") * log_m))).otherwise(1.0)
    # entropy of the child sequences: log n - sum(k log k) / n, over log m
    shape = F.when(F.col("shapes") > 1, F.least(F.lit(1.0), (F.log("shapes") - F.col("shape_bits") / F.col("shapes")) / log_m))
    rating = F.when(shape.isNull(), content).otherwise(F.greatest(content, (content + shape) / 2))
    return sums.select("host", "node", "pages", rating.alias("importance"))


def main_text(page: str | None, evidence) -> str:
    """The blocks of a page that their priors and the evidence for their nodes (node to log odds, or none) leave."""
    found, known = blocks(page), dict(evidence or ())
    has_article = any(b.article for b in found)

    def odds(block: Block) -> float:
        place = DIRECT if block.direct else INSIDE if block.article else OUTSIDE if has_article else ALONE
        return place + known.get(block.path, 0.0)

    own = [b for b in found if not b.noise]
    kept = [b for b in own if odds(b) >= 0]
    if not kept and known:
        kept = [b for b in own if b.article or not has_article]
    return "\n".join(b.text for b in kept)


def evidence_of(pages: DataFrame) -> DataFrame:
    """(host, node, odds) of the nodes whose evidence can turn a prior: one of their templates' repeated or telling branches."""
    odds = F.lit(EVIDENCE) * (1 - 1 / F.col("pages")) * (F.col("importance") - 0.5)
    in_article = F.col("node").rlike(r"(^|/)(article|main)[./]")
    rated = style_tree(pages).select("host", "node", odds.alias("odds"), in_article.alias("in_article"))
    turns = F.when(F.col("in_article"), F.col("odds") < -INSIDE).otherwise(
        (F.col("odds") < -ALONE) | (F.col("odds") >= -OUTSIDE))
    return rated.filter(turns).select("host", "node", "odds")


def extracted(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    turning = F.map_from_entries(F.collect_list(F.struct("node", "odds"))).alias("evidence")
    lists = written(evidence_of(pages).groupBy("host").agg(turning))  # nodes of one site's templates
    joined = pages.select("page_id", "url", "html").withColumn("host", host()).join(lists, "host", "left")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            text = [main_text(p, r) for p, r in
                    zip(batch.column("html").to_pylist(), batch.column("evidence").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.select(F.col("page_id").cast("long"), "url", "html", "evidence").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
