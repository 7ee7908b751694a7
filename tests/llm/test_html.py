from pyspark.sql import functions as F

from cardwatch.llm import html_extract as h
from cardwatch.llm import queries

SF0001 = "/root/testdata/sf0.001"


def test_parts_that_are_not_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">menu</a></ul></nav><div class="cookie-notice">We use cookies</div><div id="sidebar"><p>side text that is rather long, and on</p></div>
<main><div class="post p-12"><h1>Head &amp; line</h1><p>First  para<b>graph</b>.<br>Second<script>var x="</p>"</script> line &lt;x&gt; &#233;&eacute;</p>
<form><input>search</form><aside>see also</aside><div class="ad">Buy!</div><p>Third<p>Fourth</div></main>
<section class="comments"><p>Great article, I have read it all and much enjoyed it, thanks for it all</p></section><footer>&copy; x</footer></body></html>"""
    assert h.main_text(page) == "Head & line First paragraph. Second line <x> éé Third Fourth"


def test_classes_that_say_how_a_part_is_set_up():
    for part in ("article class='post comments-open'", "div class='content has-sidebar'", "main class='with-footer sidebar'", "div class='no-ads'"):
        assert h.main_text(f"<div class='sidebar'>side</div><{part}><p>the text</p></{part.split()[0]}>") == "the text", part
    for part in ("article class='comment'", "div class='has-image sidebar'", "div id='comments'", "section class='post-comments'"):
        assert h.main_text(f"<article><p>the text</p></article><{part}><p>other text</p></{part.split()[0]}>") == "the text", part


def test_title_and_lead_outside_the_best_container():
    lead, body = "lead " * 20, "body " * 200
    for page in (f"<div class=post><h1>T</h1><div class=lead><p>{lead}</p></div><div class=body><p>{body}</p></div></div>",
                 f"<article><header><h1>T</h1></header><p>{lead}</p><div><div><div class=content><p>{body}</p></div></div></div></article>"):
        text = h.main_text(f"<body><div class=teaser><p>other</p></div>{page}</body>")
        assert text == " ".join(f"T {lead} {body}".split())


def test_topics_builder_classes_and_anchors_mark_no_boilerplate():
    for part in ("div class='elementor-widget elementor-widget-text-editor'", "article class='post category-social tag-advertising category-login'",
                 "div class='post type-post category-comments'", "h2 id='share-prices'"):
        assert h.main_text(f"<body><div><{part}>the text</{part.split()[0]}></div></body>") == "the text", part
    for part in ("div class='category-menu'", "div class='elementor-widget elementor-widget-sidebar'", "div class='elementor-share-buttons'",
                 "article class='post comment category-news'", "h2 class='widget-title'"):
        assert h.main_text(f"<body><div><{part}>other</{part.split()[0]}></div></body>") == "", part


def test_edges():
    for page in (None, "", "   ", "<", "<!--", "<p", "</p></div>", "<script>never closed", "&amp;"):
        assert h.main_text(page) in ("", "&", "<", "<p")
    assert h.main_text("just text") == "just text"
    assert h.main_text("<article><p>a<p>b") == "a b"
    assert h.main_text("<article><p title='x>y'>a <i>b</i>\n\tc</p></article>") .endswith("a b c")
    assert h.main_text("<article><p>" + "w " * 50000 + "</p></article>") == ("w " * 50000).strip()
    assert h.main_text("<div>" * 30000 + "deep") == "deep"
    assert h.main_text("<article><h1>T &am</h1><p>x &amp y</p></article>") == "T &am x & y"


def test_what_belongs_to_an_article_stays():
    work = "<section id='related-work'><h2>Related work</h2><p>Others did it before.</p></section>"
    assert h.main_text(f"<article><p>the text</p>{work}</article>") == "the text Related work Others did it before."
    links = "<section id='related-articles'><h2>Related articles</h2><p><a href=x>One thing</a></p><p><a href=y>Another thing</a></p></section>"
    assert h.main_text(f"<article><p>the text</p>{links}</article>") == "the text"
    assert h.main_text("<article><header class='page-header'><h1>Title</h1></header><p>the text</p></article>") == "Title the text"
    assert h.main_text("<header class='page-header'><h1>Site</h1></header><article><p>the text</p></article>") == "the text"
    assert h.main_text("<article><p>so <math><mi>x</mi><mo>+</mo><msup><mi>y</mi><mn>2</mn></msup><annotation>tex</annotation></math> is</p></article>") == "so x+y2 is"
    assert h.main_text("<article><p>super<wbr>cali a<img src=x>b c <img> d<br>e</p></article>") == "supercali ab c d e"


def test_sibling_sections_without_a_heading():
    a, b = "first part of it " * 5, "the second and longer part " * 9
    for outer in ("body", "div"):
        page = f"<{outer}><section class=intro><p>{a}</p></section><section class=rest><p>{b}</p></section></{outer}>"
        assert h.main_text(page) == " ".join((a + b).split())
    teasers = f"<body><div class=more><p>{a}</p></div><div class=rest><p>{b}</p></div></body>"
    assert h.main_text(teasers) == b.strip()
    nav = f"<body><section class=x><p><a href=1>{a}</a></p></section><section class=rest><p>{b}</p></section></body>"
    assert h.main_text(nav) == b.strip()


def test_memory_follows_the_length_of_a_page_and_not_its_depth():
    import tracemalloc

    tracemalloc.start()
    deep = "<div class='level'>" * 200_000 + "deep"
    assert h.main_text(deep) == "deep"
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert h.main_text("<div>" * 50_000 + "<p>x" + "</p></b></li></td>" * 50_000 + "<header>" * 50_000) == "x"


def _page(body, aside):
    return f"<body><div class='story-{len(body) % 7}'><p>{body}</p></div><div class='recirc'><p>{aside}</p></div></body>"


def test_host_consensus_decides_a_page_that_looks_otherwise(spark):
    usual = [(i, "http://a.org/x", _page("word " * (40 + i), "short")) for i in range(6)]
    teaser = "a long teaser about many other things "
    odd = [(10, "http://a.org/y", _page("brief", f"<a href='/z'>{teaser * 9}</a> of them")), (11, None, _page("brief", "longer teaser " * 9)),
           (12, "http://b.org/", "<article><p>alone</p></article>"), (13, "http://b.org/", None), (12, "http://b.org/", "<article><p>alone</p></article>"),
           (14, "http://a.org/z", _page("brief", teaser * 9))]
    df = spark.createDataFrame(usual + odd, "page_id long, url string, html string").withColumn("winner", F.lit(1)).withColumn("host", F.lit(1))
    got = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in h.extract(df).collect()]
    by = {r[0]: r for r in got}
    assert len(got) == len(usual + odd)
    assert by[10][2] == "brief" and by[11][2].startswith("longer teaser")
    assert by[14][2] == (teaser * 9).strip()  # most of the page's text is elsewhere
    assert by[12][2] == "alone" and by[13][2:] == ("", 0)
    assert h.extract(df.where("false")).collect() == []


def test_votes_and_winners_by_counting(spark):
    import collections
    import random

    rng = random.Random(8)
    tags = ["div", "section", "div class=a", "div class='b 12'", "main", "article"]
    rows = [(i, f"http://h{rng.randrange(4)}.org/{i}", "<body>" + "".join(
        f"<{t}><p>{'word ' * rng.randrange(30)}</p>" + (f"<a href=x>{'link ' * rng.randrange(9)}</a>" if rng.random() < .5 else "") + f"</{t.split()[0]}>"
        for t in rng.choices(tags, k=3)) + "</body>") for i in range(120)]
    votes, scores = collections.Counter(), collections.Counter()
    for _, url, source in rows:
        if top := h.Page(source).best():
            votes[url.split("/")[2], top[0]] += 1
            scores[url.split("/")[2], top[0]] += int(top[1] // 1)
    want = {}
    for (host, path), n in votes.items():
        want[host] = max(want.get(host, (0, 0, "")), (n, scores[host, path], path))
    got = {r["host"]: (r["winner"], r["votes"]) for r in h.host_paths(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {host: (path, n) for host, (n, _, path) in want.items()}
    # each page's text by its host's winner, or by itself where that holds under half of the page's text
    texts = {r["page_id"]: r["text"] for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, url, source in rows:
        page = h.Page(source)
        winner = page.text_at(got[url.split("/")[2]][0])
        own = page.best()
        assert texts[i] == (winner if winner and 2 * len(winner) >= page.size() else page.text_at(own[0]) if own else winner), i


def test_query_returns_the_article_of_every_page(spark):
    """The pages' articles, taken out by their markers and stripped by plain replacement."""
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in queries.op4_html_extract(spark, SF0001).collect()}
    assert got.keys() == pages.keys()
    for k, source in pages.items():
        body = source[source.index("<article>"):source.index("</article>")]
        blocks = re.split(r"</?(?:article|h1|p|br)>", re.sub(r"</?b>", "", body))
        want = " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
        assert got[k]["text"] == want and got[k]["n_chars"] == len(want)
