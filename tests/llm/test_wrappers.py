"""Main text of pages on sites of several layouts, and tree matching against all matchings."""

import itertools
import random

from opinionlens.llm.wrappers import Node, content_region, extract_text, match_trees, parse, reference_tree

SCHEMA = "page_id bigint, url string, html string"


def words(r, n):
    return " ".join("".join(r.choices("etaoinshrdlu", k=r.randrange(2, 9))) for _ in range(n))


def blog(r, i):
    """A site of divisions without an article element; the menu, the notices and the footer vary."""
    paragraphs = [words(r, r.randrange(20, 60)) for _ in range(r.randrange(2, 8))]
    title = words(r, 6)
    menu = "".join(f"<li><a href='/{x}'>{x}</a>" for x in words(r, 5).split())
    page = f"""<!doctype html><HTML><head><title>{title}</title><meta name=x><script>if (a < b) document.write("<p>no</p>")</script></head>
      <body class="with-sidebar"><div id=top><ul>{menu}</ul></div><div class="cookie-notice">We use {words(r, 8)}</div>
      <div id="wrap"><div class='post'><h1>{title}</h1><p class=lead>{"<p>".join(paragraphs)}<div>Read more of our stories</div></div>
      <div class="sidebar"><p>{words(r, 30)}</div></div>
      <div class=comments><p>{words(r, 25)}</p></div><form><label>Your mail {words(r, 3)}</label><input></form>
      <div id="foot">{words(r, 9)}<br>&copy; 2020</div></body></html>"""
    return page, "\n".join([title, *paragraphs])


def news(r, i):
    """A site with an article element, inline markup, a table, references of characters and a constant line."""
    one, two, three = (words(r, 25) for _ in range(3))
    page = f"""<body><header><h2>{words(r, 2)}</h2></header><nav>{words(r, 4)}</nav><main><article><header><h1>Caf&eacute; &#x2014; {one}</h1></header>
      <p>{two.replace(" ", " <b>bold</b> ", 1)}<br/>new&nbsp;\t line &amp;lt; <!-- no > --> 1 < 2 <table><tr><td>{three}<td>a{i}<td> <tr><td>b{i}</table>
      <aside>{words(r, 9)}</aside><p>Share this page</p></article><footer>{words(r, 5)}</footer></main><style>p {{}}</style>"""
    bold = two.replace(" ", " bold ", 1)
    return page, f"Café — {one}\n{bold} new line &lt; 1 < 2\n{three}\na{i}\nb{i}"


def test_sites(spark):
    r = random.Random(6)
    rows, expect = [], {}
    for n, (host, make) in enumerate((("blog.example.org", blog), ("News.example.org:80", news))):
        for i in range(40):
            page, text = make(r, i)
            rows.append((100 * n + i, f"https://{host}/a/{i}?x=1", page))
            expect[100 * n + i] = text
    got = {x.page_id: x for x in extract_text(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()}
    assert {k: v.text for k, v in got.items()} == expect
    assert all(v.n_chars == len(v.text) for v in got.values())


def test_small_hosts_copies_and_edge_cases(spark):
    r = random.Random(7)
    rows = [(i, f"http://h{i}.example.net/", news(r, i)[0]) for i in range(30)]
    copy = "<html><body><nav>menu</nav><article><h1>Same</h1><p>one text that all pages of this host have</article></body>"
    rows += [(100 + i, "http://copies.example.net/x", copy) for i in range(50)]
    rows += [(200, None, None), (201, "no host", ""), (202, "http://copies.example.net/y", "plain words &amp; more"), (203, "http://h1.example.net", "<p>")]
    rows += [(204, "http://h2.example.net", "<p>" + "<b>" * 3000 + "deep " * 50_000 + "<unclosed 'quote"), (205, None, "<div>" * 400 + "in" + "</div>" * 400)]
    df = spark.createDataFrame([(*x, "old", 1) for x in rows], SCHEMA + ", text string, n_chars int").repartition(3)
    got = {x.page_id: x.text for x in extract_text(df).collect()}
    assert len(got) == len(rows)
    assert {got[100 + i] for i in range(50)} == {"Same\none text that all pages of this host have"}
    assert [got[k] for k in (200, 201, 202, 203, 205)] == ["", "", "plain words & more", "", "in"]
    assert got[204].startswith("deep deep") and got[204].count("deep") == 50_000
    assert all(got[i].startswith("Café — ") for i in range(30))
    assert extract_text(df.limit(0)).collect() == []


def all_matchings(a, b):
    """Size of the best matching by trying all order-preserving choices of children."""
    if a.label != b.label:
        return 0
    left, right = list(a.children.values()), list(b.children.values())
    best = 0
    for k in range(min(len(left), len(right)) + 1):
        for x in itertools.combinations(left, k):
            for y in itertools.combinations(right, k):
                sizes = [all_matchings(p, q) for p, q in zip(x, y)]
                if all(sizes):
                    best = max(best, sum(sizes))
    return best + 1


def test_matching_is_largest():
    r = random.Random(8)

    def tree(depth, numbers):
        node = Node(r.choice("ab") if depth < 3 else "a", number=next(numbers))
        if depth:
            for label in r.sample("abcde", r.randrange(0, 5)):
                child = tree(depth - 1, numbers)
                child.label = label
                node.children[label] = child
        return node

    for _ in range(200):
        a, b = tree(3, itertools.count()), tree(3, itertools.count())
        size, pairs = match_trees(a, b)
        assert size == all_matchings(a, b) == len(pairs) and len(set(pairs)) == size


def test_region_goes_no_further_than_a_heading():
    tree = reference_tree(["", ["body", ["div.x", ["h1"], ["div.y", ["p"]]], ["div.z"]]])
    places = {n.label: n.number for n in tree.nodes}
    assert content_region(tree, {places["p"]: 1000, places["div.z"]: 20}) == places["div.y"]
    assert content_region(tree, {places["p"]: 1000, places["h1"]: 5}) == places["div.x"]
    assert content_region(tree, {}) == -1
    assert [t for _, t in parse("<ul><li>a<li>b<ul><li>c</ul>d</ul>e").blocks] == ["a", "b", "c", "d", "e"]
