import html
import math
import re
from collections import defaultdict

from pyspark.sql import functions as F

from quarry.llm.site_style import GAMMA, MIN_PAGES, main_text, node_importance, parsed
from tests.llm.helpers import SMALL, prose

PAGES = "page_id long, url string, html string"


def texts(spark, rows):
    df = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("clash")).withColumn("blocks", F.lit(1))
    return {r.page_id: r.text for r in main_text(df).collect()}


def test_articles_of_the_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in main_text(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", b) if "<br>" in b else re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
        want = "\n".join(b for b in blocks if b)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_a_site_without_declarations_loses_its_repeated_branches(spark):
    def page(k):
        own = "".join(f"<p>{' '.join(prose(100 * k + j, 20))}</p>" for j in range(4))
        return f"<html><body><div id=x1><ul><li>Home<li>News</ul></div><div id=x2><h2>{' '.join(prose(9000 + k, 4))}</h2>{own}</div><div id=x3>All rights reserved</div></body></html>"

    got = texts(spark, [(k, f"https://user@Site.example:80/{k}", page(k)) for k in range(12)])
    for k, text in got.items():
        assert "Home" not in text and "reserved" not in text
        assert text.split("\n") == [" ".join(prose(9000 + k, 4))] + [" ".join(prose(100 * k + j, 20)) for j in range(4)]


def test_declared_noise_and_markup(spark):
    source = """<!DOCTYPE html><title>no</title><header>Top</header><div class="cookie-notice">We use</div><main><header><h1>A &amp; B&nbsp;c</h1></header>
    <script>if (a < b) x("<p>no</p>")</script><style>p{}</style><!-- <p>no</p> --><p>one<br>two <b>th</b>ree<p>four<form>name</form>
    <aside>see also</aside><section id="comments"><p>first!</p></section><ul><li>x<li>y</ul><table><tr><td>c1<td>c2</table>a &lt;tag&gt;</main><footer>end</footer>"""
    assert texts(spark, [(1, "http://h/", source)])[1] == "A & B c\none two three\nfour\nx\ny\nc1\nc2\na <tag>"


def test_the_tree_prunes_inside_articles_and_outweighs_layout_words(spark):
    def own(k):
        return [" ".join(prose(700 + 10 * k + j, 25)) for j in range(3)]

    def page(k, shape):
        body = "".join(f"<p>{x}</p>" for x in own(k))
        block = "<div class=q7><p>Read the full series in our archive</p></div>"
        return {
            "branch": f"<article>{body}{block}</article>",
            "content": f"<article>{body}<p>Read the full series in our archive</p></article>",
            "wrapper": f"<div class='page-with-sidebar'><div class='banner wide'><article>{body}</article></div></div><div class=sidebar>Side</div>",
            "history": f"<article><div class='social-history'>{body}</div></article>",
            "comment": f"<main>{body}<div class=comments><article class=comment><p>first {k}</p></article></div></main>",
            "related": f"<article>{body}</article><article class=related-card>See {k}</article>",
        }[shape]

    rows = [(100 * n + k, f"http://{shape}/{k}", page(k, shape)) for n, shape in enumerate(("branch", "content", "wrapper", "history", "comment", "related")) for k in range(40)]
    got = texts(spark, rows)
    assert len(got) == 240
    for page_id, text in got.items():
        assert text.split("\n") == own(page_id % 100), page_id


def test_hosts_of_copies_and_small_hosts_keep_their_articles(spark):
    body = "<p>the same passage</p><p>and one more</p>"
    rows = [(k, "http://copies/", f"<nav>{k}</nav><article>{body}</article>") for k in range(40)]
    rows += [(100 + k, "http://small/", f"<article><h1>t{k}</h1><div class=x>again</div></article>") for k in range(9)]
    got = texts(spark, rows)
    assert all(got[k] == "the same passage\nand one more" for k in range(40))
    assert all(got[100 + k] == f"t{k}\nagain" for k in range(9))


def test_edges(spark):
    same = "<article><p>mirror</p></article>"
    rows = [(1, None, None), (2, "", ""), (3, "u", "plain text"), (4, "http://h/", "<p>unclosed <b>tags"), (5, "http://h/", "<article>" + "word " * 200_000), (6, "http://h/", "<<<>>> < b"), (None, "http://h/", "<p>x")]
    rows += [(100 + k, "http://m/", same) for k in range(40)] + [(100, "http://m/", same)]
    df = spark.createDataFrame(rows, PAGES)
    got = main_text(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert (by[1], by[2], by[3], by[4], by[None]) == ("", "", "plain text", "unclosed tags", "x")
    assert len(by[5]) == 999_999 and by[139] == "mirror"
    assert main_text(df.limit(0)).collect() == []


def test_importance_of_the_tree(spark):
    # menu: one text on all pages; body: a text of its own on each page; 8 pages
    rows = [(k, "http://h/", f"<div id=m>menu</div><div id=b>text {k}</div>") for k in range(8)]
    got = {r.path: r.importance for r in node_importance(parsed(spark.createDataFrame(rows, PAGES))).collect()}
    assert abs(got["/div[m]"] - 0.0) < 1e-9 and abs(got["/div[b]"] - 0.9) < 1e-9


def brute_importance(rows):
    """{(host, path): importance} from parsed rows, by the definition: entropy to base m over the m pages that have a node."""
    pages = {(r.host, r.digest): r for r in rows}.values()
    shown, styles, texts = defaultdict(set), defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set))
    for r in pages:
        for x in r.styles:
            shown[r.host, x.path].add(r.digest)
            styles[r.host, x.path][x.feature].add(r.digest)
        for x in r.blocks:
            texts[r.host, x.path][x.feature].add(r.digest)

    def mean_entropy(ways, m):  # weighted by occurrence; a way on n of m pages has entropy log n / log m
        n = [len(v) for v in ways.values()]
        return sum(k * math.log(k) for k in n) / (sum(n) * math.log(m)) if m > 1 else 0.0

    out = {}
    for (host, path), seen in shown.items():
        m = len(seen)
        if m < MIN_PAGES:
            out[host, path] = 1.0
            continue
        presentation = -sum(c / m * math.log(c / m, m) for c in (len(v) for v in styles[host, path].values()))
        below = [(1 - mean_entropy(w, len(shown[host, p])), sum(map(len, w.values()))) for (h, p), w in texts.items() if h == host and p and (p + "/").startswith(path + "/")]
        total = sum(n for _, n in below)
        out[host, path] = presentation if not below else (1 - GAMMA) * presentation + GAMMA * sum(c * n for c, n in below) / total
    return out


def test_importances_equal_brute_force(spark):
    rows = []
    for k in range(30):
        side = f"<div id=s>{'offer ' * (k % 4)}</div>" if k % 3 else ""
        rows.append((k, f"http://h{k % 2}/", f"<div id=m><ul><li>a<li>b</ul></div>{side}<article><h1>t {k // 2}</h1><p>{k % 5}<p>x</article>"))
    rows.append((31, "http://h0/", rows[0][2]))
    page_rows = parsed(spark.createDataFrame(rows, PAGES))
    got = {(r.host, r.path): r.importance for r in node_importance(page_rows).collect()}
    want = brute_importance(page_rows.collect())
    assert got.keys() == want.keys() and len(got) == 14
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
