from opinionlens.sources.pages import ArticleSelectors, Selector, article_rows, extract_articles
from opinionlens.sources.posts import cap_per_source, collect_by_keyword, post_comment_pairs

FULL = """<html><head><title>x</title><style>b{}</style></head><body>
<h2 class="rich_media_title" id="t"> A &amp; <b>B</b> </h2><em id="post-date">2024-01-02</em>
<a class="rich_media_meta rich_media_meta_link rich_media_meta_nickname" href="#">Place &eacute;&#20013;</a>
<DIV class="wide" id="js_content" style="x"><div>one<!-- no --> two</div><script>var a='<div>';</script>
<p>three &amp;lt; <b>four</b></p><div><div>five</div></div></DIV>
<div>after</div>
<div class="rich_media_comment_list"><ul><li class="comment_item"><span class="comment_content"> good </span></li>
<li class="x comment_item"><i>u</i><span class="comment_content">b<b>a</b>d&nbsp;</span></li></ul></div></body></html>"""

NO_BODY = "<html><h2 class='rich_media_title'>t</h2></html>"
NO_TITLE = '<div id="js_content">text</div>'
BARE = '<h2 class=rich_media_title>t</h2><div id=js_content>open <p>end'


def test_article_fields(spark):
    pages = [(1, "u1", FULL), (2, "u2", NO_BODY), (3, "u3", NO_TITLE), (4, "u4", BARE)]
    articles, rejects = extract_articles(spark.createDataFrame(pages, "page_id int, url string, html string"))
    rows = {r["page_id"]: r for r in articles.collect()}
    assert set(rows) == {1, 4}
    one = rows[1]
    assert one["title"] == "A &B" and one["time"] == "2024-01-02" and one["place"] == one["source"] == "Place é中"
    assert [t.strip() for t in one["content"].split("\n") if t.strip()] == ["one", "two", "three &lt;", "four", "five"]
    assert one["comments"] == ["good", "bad"]
    assert (rows[4]["content"], rows[4]["time"], rows[4]["comments"]) == ("open \nend", "N/A", [])
    assert {(r["page_id"], r["reason"]) for r in rejects.collect()} == {(2, "no body"), (3, "no title")}
    flat = {r["Time"]: r for r in article_rows(articles).collect()}
    assert flat["2024-01-02"]["Comments"] == "good\nbad"


def test_selectors_without_attributes(spark):
    sel = ArticleSelectors(body=Selector("article"), title=Selector("h1"))
    page = "<articles>no</articles><article><h1>T</h1><article>in</article>out</article>rest"
    df = spark.createDataFrame([(1, "u", page)], "page_id int, url string, html string")
    row = extract_articles(df, sel)[0].first()
    assert (row["title"], row["content"]) == ("T", "T\nin\nout")


def test_posts(spark):
    posts = spark.createDataFrame([(i, f"p{i}") for i in range(8)], "post_id int, post_text string")
    comments = spark.createDataFrame(
        [(p, c, f"c{p}-{c}") for p in range(8) for c in range(30 if p == 1 else 2)], "post_id int, pos int, comment string"
    )
    got = post_comment_pairs(posts, comments).collect()
    assert {r["post_id"] for r in got} == {0, 1, 2, 3, 4}
    assert sorted(r["pos"] for r in got if r["post_id"] == 1) == list(range(20))
    assert post_comment_pairs(posts, comments, max_posts=None, max_comments=None).count() == 44


def test_caps_and_keyword(spark):
    df = spark.createDataFrame([(i, "s" if i < 40 else "t", f"text {i}") for i in range(45)], "doc_id int, source string, text string")
    got = cap_per_source(df).collect()
    assert len(got) == 35 and max(r["page"] for r in got) == 2 and max(r["place"] for r in got) == 15
    assert collect_by_keyword(df, "text 44").count() == 1
    assert collect_by_keyword(df, "none").count() == 0
