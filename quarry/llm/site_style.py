"""Operator 10 — main text of web pages by site style trees.

Each page is parsed once into a tolerant DOM (comments, scripts and styles
skipped, unclosed and implied tags handled).  Its text blocks — the runs of
text between block-level borders — carry the path of their elements (tag, id,
classes), which is the node of the site style tree they belong to.  The trees
of all pages of a host are merged by Spark as counts per (host, node):

* presentation: how many pages show a node with which child style (the run of
  child tags); the importance of an inner node is the entropy of its styles
  over the pages that have it;
* content: how many pages repeat the same text at a node; the importance of a
  leaf is one minus the mean entropy of its texts over the pages.  Distinct
  pages only: exact copies of a page say nothing about its layout.

The importance of a branch combines its own presentation with the content
importance of the leaves below (``GAMMA`` per level of depth in the paper,
here one step).  Branches below ``THRESHOLD`` are removed from every page.
Declarations are a prior.  Navigation, page headers and footers, asides, forms,
scripts and elements whose role, id or class says advert, menu, notice, sidebar
or comments are noise; ``article`` and ``main`` hold the main text, and a page that
has them has none elsewhere.  Two things overturn them:

* an article below an element that only a layout word (``SOFT_WORDS``) calls noise, an article that
  itself bears a noise word, and layout-worded parts of an article are second choice: they
  are the main text of a page that has no other;
* the tree prunes inside articles: a branch below the article with importance under ``INSIDE``, or a
  content node (one text at one node) on ``REPEATED`` of the pages that have the node, goes, if
  ``INSIDE_PAGES`` distinct pages of the host have the node and the article as a whole is important
  there (a host of copies says nothing).  No page loses its whole article this way.

Defined results: null or textless html gives an empty text; null URLs form one
host; white space inside a block (``br`` included) is one space; repeated
page_ids get a row each.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.shared import table, written

THRESHOLD = 0.5
GAMMA = 0.9
MIN_PAGES = 3  # a host's node seen on fewer distinct pages says nothing
INSIDE, REPEATED, INSIDE_PAGES = 0.1, 0.9, 10  # against a declared article the tree must be sure

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea select svg math iframe object".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
NOISE = frozenset("nav aside form button head title footer menu dialog".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
MAIN = frozenset(("article", "main"))
#: Words of an id or class that declare a branch to be no main text; "with-sidebar" says that something has one.
_BORDER = r"(?:^|[-_\s])(?<!with[-_])(?<!without[-_])(?<!has[-_])(?<!no[-_])"
_HARD = r"ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|cookies?|consent|popup|modal|newsletter|subscribe|comments?|replies|disqus"
_SOFT = r"promo(?:tion)?|banner|nav(?:bar|igation)?|menu|breadcrumbs?|sidebar|footer|masthead|topbar|notice|share|social|related|widget|pager|pagination"
NOISE_WORDS = re.compile(rf"{_BORDER}(?:{_HARD}|{_SOFT})(?:$|[-_\s])")
HARD_WORDS = re.compile(rf"{_BORDER}(?:{_HARD})(?:$|[-_\s])")
#: Verdicts: noise, main text, second choice (main text if the page has no other), noise by a layout word; None is open.
DROP, MAIN_TEXT, SECOND, SOFT = 0, 1, 2, 3
#: Start tags that end an open paragraph, and those that end an open element of their own kind.
CLOSES_P = BLOCK - {"body", "html", "head", "title", "option", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "summary"}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "p": ("p",)}
STOP_AT = frozenset("ul ol dl table select article section div main body nav aside footer header form blockquote".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")


class _Page:
    """Blocks ``(path, verdict, depth of the outermost article, text)`` and inner nodes ``(path, child tags)`` of one page."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int | None, int, str]] = []
        self.styles: dict[str, list[str]] = {}
        self.stack: list[tuple[str, str, int | None, int]] = []  # tag, path, verdict, depth of the article (0: none)
        self.text: list[str] = []
        self._parse(source)
        self._flush()

    def _top(self) -> tuple[str, int | None, int]:
        return self.stack[-1][1:] if self.stack else ("", None, 0)

    def _flush(self) -> None:
        if self.text:
            text = " ".join(html_lib.unescape("".join(self.text)).split())
            if text:
                path, verdict, main = self._top()
                self.blocks.append((path, DROP if verdict == SOFT else verdict, main, text))
            self.text = []

    def _open(self, tag: str, attributes: str) -> None:
        path, verdict, main = self._top()
        found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
        names = f"{found.get('id', '')} {found.get('class', '')}".strip()
        if verdict != DROP:
            words = names.lower() if tag not in ("html", "body") else ""
            named = bool(words) and bool(NOISE_WORDS.search(words))
            if tag in MAIN or found.get("role") == "main":
                verdict = SECOND if named or verdict in (SECOND, SOFT) else MAIN_TEXT
                main = main or path.count("/") + 1
            elif tag in NOISE or (tag == "header" and not main) or found.get("role") in NOISE_ROLES or "hidden" in found or (named and HARD_WORDS.search(words)):
                verdict = DROP
            elif named:
                verdict = SECOND if main else SOFT
        here = f"{path}/{tag}" + (f"[{' '.join(sorted(names.replace('/', ' ').split()))}]" if names else "")
        if path in self.styles:
            if not self.styles[path] or self.styles[path][-1] != tag:
                self.styles[path].append(tag)
        self.styles.setdefault(here, [])
        self.stack.append((tag, here, verdict, main))

    def _close(self, tag: str) -> None:
        if any(x[0] == tag for x in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def _imply(self, tag: str) -> None:
        if tag in CLOSES_P and any(x[0] == "p" for x in self.stack):
            for t, *_ in reversed(self.stack):
                if t == "p":
                    self._close("p")
                    break
                if t in STOP_AT:
                    break
        for t, *_ in reversed(self.stack):
            if t in SIBLINGS.get(tag, ()):
                self._close(t)
                break
            if t in STOP_AT:
                break

    def _parse(self, source: str) -> None:
        at = 0
        while True:
            m = TOKEN.search(source, at)
            if m is None:
                self.text.append(source[at:])
                return
            self.text.append(source[at : m.start()])
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if tag == "br":
                self.text.append(" ")
            elif tag in RAW:
                if not m[1] and not m[3].rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                    at = end.end() if end else len(source)
            elif tag in BLOCK:
                self._flush()
                if m[1]:
                    self._close(tag)
                elif tag not in VOID:
                    self._imply(tag)
                    self._open(tag, m[3])
            elif not m[1] and tag not in VOID and "=" in m[3] and NOISE_WORDS.search(m[3].lower().replace('"', " ").replace("'", " ").replace("=", " ")):
                # an inline element declared as noise: a branch of its own
                self._flush()
                self._open(tag, m[3])
            elif m[1] and self.stack and self.stack[-1][0] == tag:
                self._flush()
                self.stack.pop()


PAGE = "blocks array<struct<path:string,verdict:int,main:int,text:string,feature:bigint>>, styles array<struct<path:string,feature:bigint>>"


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, digest, blocks, styles) per row, stored with a row_id; noise keeps the digest of its text only."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))
    slim = pages.select("html", "page_id", "url", host.alias("host"), F.xxhash64("html").alias("digest"))
    page_type = slim.schema["page_id"].dataType.simpleString()
    block_type = pa.list_(pa.struct([("path", pa.string()), ("verdict", pa.int32()), ("main", pa.int32()), ("text", pa.string()), ("feature", pa.int64())]))
    style_type = pa.list_(pa.struct([("path", pa.string()), ("feature", pa.int64())]))

    def feature(text: str) -> int:
        return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [_Page(source or "") for source in part.column(0).to_pylist()]
                blocks = pa.array([[{"path": p, "verdict": v, "main": m, "text": t if v != DROP else None, "feature": feature(t)} for p, v, m, t in x.blocks] for x in found], block_type)
                styles = pa.array([[{"path": p, "feature": feature(" ".join(s))} for p, s in x.styles.items()] for x in found], style_type)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], blocks, styles], names=[*part.schema.names[1:], "blocks", "styles"])

    out = slim.mapInArrow(run, f"page_id {page_type}, url string, host string, digest long, {PAGE}")
    return written(out.withColumn("row_id", F.monotonically_increasing_id()), "op10-pages")


def _branches(path: str) -> Column:
    """All nodes from the root's child down to ``path`` itself."""
    return F.expr(f"transform(sequence(2, size(split({path}, '/'))), i -> substring_index({path}, '/', i))")


def _evenness(n_log_n: Column, times: Column, pages: Column) -> Column:
    """1 - sum(n log n) / (times log pages); 1 for a single page."""
    return 1 - F.coalesce(F.try_divide(n_log_n, times * F.log(pages)), F.lit(0.0))


def site_tree(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, path, pages, importance) of every node of the site style trees, and (host, path, feature) of repeated content nodes.

    With n_i of m pages in way i, the entropy to base m is 1 - sum(n_i log n_i) / (m log m), and a text on
    n of m pages has entropy log n / log m over them; both need sums only, so nothing is joined before it is summed.
    """

    def spread(column: str) -> DataFrame:
        """(host_key, path_key, n, feature, ways): how many features a node has on n distinct pages; rare ones unnamed, keys are digests."""
        each = pages.select(F.xxhash64("host").alias("host_key"), "digest", F.explode(column).alias("x"))
        each = each.select("host_key", F.xxhash64("x.path").alias("path_key"), "digest", "x.feature").distinct()
        counted = each.groupBy("host_key", "path_key", "feature").agg(F.count("*").alias("n"))
        named = F.when(F.col("n") >= INSIDE_PAGES, F.col("feature")).alias("feature")
        return counted.groupBy("host_key", "path_key", "n", named).agg(F.count("*").alias("ways"))

    def summed(counts: DataFrame) -> DataFrame:
        sums = [F.sum(F.col("ways") * F.col("n")).alias("times"), F.sum(F.col("ways") * F.col("n") * F.log("n")).alias("n_log_n")]
        return counts.groupBy("host_key", "path_key").agg(*sums)

    names = pages.select("host", F.explode("styles.path").alias("path")).union(pages.select("host", F.explode("blocks.path").alias("path"))).distinct()
    names = written(names.select("host", "path", F.xxhash64("host").alias("host_key"), F.xxhash64("path").alias("path_key")), "op10-names")
    nodes = summed(spread("styles")).join(names, ["host_key", "path_key"])
    nodes = nodes.select("host", "path", F.col("times").alias("pages"), _evenness(F.col("n_log_n"), F.col("times"), F.col("times")).alias("presentation"))
    nodes = written(nodes, "op10-nodes")

    counts = written(spread("blocks"), "op10-counts")
    texts = summed(counts).join(names, ["host_key", "path_key"]).drop("host_key", "path_key")
    texts = texts.join(nodes.select("host", "path", "pages"), ["host", "path"])
    content = written(texts.select("host", "path", "times", _evenness(F.col("n_log_n"), F.col("times"), F.col("pages")).alias("content")), "op10-content")

    # content importance of a branch: the mean over the texts of its leaves
    above = _branches("path")
    branch = content.where("path <> ''").select("host", F.explode(above).alias("path"), "content", "times")
    branch = branch.groupBy("host", "path").agg((F.sum(F.col("content") * F.col("times")) / F.sum("times")).alias("content"))
    joined = nodes.join(branch, ["host", "path"], "left")
    own = F.when(F.col("content").isNull(), F.col("presentation")).otherwise((1 - F.lit(GAMMA)) * F.col("presentation") + GAMMA * F.col("content"))
    importance = F.when(F.col("pages") < MIN_PAGES, F.lit(1.0)).otherwise(own)

    often = counts.where(F.col("feature").isNotNull()).join(names, ["host_key", "path_key"]).join(nodes, ["host", "path"])
    often = often.where(F.col("n") >= REPEATED * F.col("pages")).select("host", "path", "feature")
    return joined.select("host", "path", "pages", importance.alias("importance")), often


def node_importance(pages: DataFrame) -> DataFrame:
    return site_tree(pages)[0]


def main_text(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    rows = parsed(pages)
    nodes, often = site_tree(rows)
    sure = (F.col("pages") >= INSIDE_PAGES) & (F.col("importance") < min(INSIDE, threshold))
    low = written(nodes.where(F.col("importance") < threshold).select("host", "path", sure.alias("sure")), "op10-low")

    # a low branch takes all below it: the leaves of a host that have one, each once
    leaves = rows.select("host", F.explode("blocks").alias("b")).where("b.text is not null and b.path <> ''").select("host", F.col("b.path").alias("leaf"), "b.main").distinct()
    leaves = written(leaves, "op10-leaves")
    branches = leaves.select("host", "leaf", "main", F.posexplode(_branches("leaf")).alias("at", "path")).withColumn("level", F.col("at") + 1)
    met = branches.join(low, ["host", "path"]).groupBy("host", "leaf", "main").agg(
        F.bool_or(F.col("main") == 0).alias("outside"), F.bool_or((F.col("level") > F.col("main")) & F.col("sure")).alias("inside"), F.bool_or(F.col("level") == F.col("main")).alias("copies")
    )
    met = written(met, "op10-met")
    pruned = met.where("outside or (inside and not copies)").select("host", F.col("leaf").alias("path"), "main")
    articles = leaves.where("main > 0").join(met.where("copies"), ["host", "leaf", "main"], "left_anti")
    repeated = articles.withColumnRenamed("leaf", "path").join(written(often, "op10-often"), ["host", "path"]).select("host", "path", "main", "feature")
    drops = written(pruned.withColumn("feature", F.lit(None).cast("long")).union(repeated), "op10-drops")

    each = rows.select("row_id", "host", F.posexplode("blocks").alias("at", "b")).where("b.text is not null")
    each = each.select("row_id", "host", "at", "b.path", "b.main", "b.feature")
    whole = each.join(drops.where("feature is null").drop("feature"), ["host", "path", "main"], "left_semi")
    single = each.join(drops.where("feature is not null"), ["host", "path", "main", "feature"], "left_semi")
    dropped = whole.select("row_id", "at").union(single.select("row_id", "at")).groupBy("row_id").agg(F.collect_set("at").alias("dropped"))
    joined = rows.join(written(dropped, "op10-dropped"), "row_id", "left")

    def chosen(verdict: int) -> Column:
        return F.filter("blocks", lambda b: F.coalesce(b["verdict"] == verdict, F.lit(False)))

    gone = F.coalesce("dropped", F.array().cast("array<int>"))
    left = F.filter("blocks", lambda b, at: ~F.array_contains(gone, at))
    joined = joined.withColumn("verdict", F.when(F.size(chosen(MAIN_TEXT)) > 0, MAIN_TEXT).when(F.size(chosen(SECOND)) > 0, SECOND))
    kept = F.filter(left, lambda b: b["verdict"].eqNullSafe(F.col("verdict")))
    whole_article = F.filter("blocks", lambda b: b["verdict"] == F.col("verdict"))
    keep = F.when(F.col("verdict").isNotNull() & (F.size(kept) == 0), whole_article).otherwise(kept)
    text = F.array_join(F.transform(keep, lambda b: b["text"]), "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
