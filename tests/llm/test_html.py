import random
import time
from collections import defaultdict

from linkloom.llm import html


def test_blocks():
    page = '<!DOCTYPE html><title>t</title><nav>n</nav><div class="x ad-box">ad</div><article><header><h1>A &amp; B</h1></header><p>one\n two<br>three<p>four <b>five<!-- c --></b><script>"</p>"</script><div class="comments"><p>c</p></div></article><footer>f</footer>'
    assert html.text_of(page) == "A & B\n\none two three\n\nfour five"
    assert html.text_of("<p>open <b>end &lt") == "open end <"
    assert html.text_of(None) == html.text_of("") == html.text_of("<!-- x") == html.text_of("<script>x") == ""
    assert html.text_of("a < b <3") == "a < b <3"
    assert html.text_of("<div>" * 20000 + "deep") == "deep"


def test_templates_are_deleted(spark):
    rows = []
    for i in range(12):
        same = "<div><p>All rights reserved</p><p>Call us</p></div>"
        rows.append((i, f"https://a.example/{i}?q", f"<body><div>{same}<section><p>Body {i}</p><p>Shared line {i // 2}</p></section></div></body>", "x"))
    rows += [(100 + i, f"http://b.example:80/{i}", "<article><h1>Copy</h1><p>Same story</p></article>", "x") for i in range(6)]
    rows += [(200, None, "<p>x</p>", None), (201, "nourl", None, None), (201, "nourl", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = [(r.page_id, r.text, r.n_chars) for r in html.extract(df).collect()]
    assert len(got) == len(rows)
    found = {p: t for p, t, _ in got}
    assert all(found[i] == f"Body {i}\n\nShared line {i // 2}" for i in range(12))
    assert all(found[100 + i] == "Copy\n\nSame story" for i in range(6))
    assert found[200] == "x" and found[201] == "" and all(len(t) == n for _, t, n in got)
    assert html.extract(df.limit(0)).count() == 0


def test_copies_are_content(spark):
    story = "<article><div class=body><p>One story</p><p>told twice</p></div></article>"
    rows = [(i, f"https://a.example/{i}", story) for i in range(6)] + [(10 + i, f"https://a.example/x{i}", f"<article><p>Own text {i}</p></article>") for i in range(9)]
    rows += [(30 + i, f"https://b.example/{i}", "<div><p>No article here</p><p>only blocks</p></div>") for i in range(6)]
    rows += [(50 + i, f"https://c.example/{i}", f"<article><h1>Copy {i}</h1><div><p>A long story that is told again</p></div></article>") for i in range(6)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {got[i] for i in range(6)} == {"One story\n\ntold twice"} and got[10] == "Own text 0"
    assert {got[30 + i] for i in range(6)} == {"No article here\n\nonly blocks"}
    assert all(got[50 + i] == f"Copy {i}\n\nA long story that is told again" for i in range(6))


def test_templates_of_a_large_host(spark, monkeypatch):
    notice = "<div><p>Prices without tax</p></div>"
    rows = [(i, f"https://a.example/{i}", f"<body>{notice if i % 6 == 0 else ''}<section><p>Own text {i} of this page</p><table><tr><td>Yes<td>{i}</table></section></body>") for i in range(360)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for most in (html.BROADCAST, 0):
        monkeypatch.setattr(html, "BROADCAST", most)
        got = {r.page_id: r.text for r in html.extract(df.where("page_id < 360")).collect()}
        assert not any("Prices" in t for t in got.values())
        assert all(t.startswith(f"Own text {i} of this page") for i, t in got.items())
    few = html.extract(df.where("page_id % 6 = 0 OR page_id % 6 = 1 AND page_id < 100")).collect()
    assert not any("Prices" in r.text for r in few)
    mixed = spark.createDataFrame([(i, f"https://b.example/{i}", f"<table><tr><td>Own {i}</td><td>{'Yes' if i % 6 == 0 else f'No {i}'}</td></tr></table>") for i in range(360)], "page_id long, url string, html string")
    assert sum("Yes" in r.text for r in html.extract(mixed).collect()) == 60


def test_marks_are_whole_names():
    page = """<article><h1>T</h1><p>first</p><div id="search-results">r</div><p class="social-history">s</p><div class="related-work">w</div><p class="notice">n</p>
    <div class="related-posts">x</div><div class=adBox>x</div><p class="ad">x</p><ol class="comments"><li>c</li></ol><aside>x</aside><footer>x</footer></article><div class="cookie-notice">x</div>"""
    assert html.text_of(page) == "T\n\nfirst\n\nr\n\ns\n\nw\n\nn"
    assert html.text_of('<form><div><p>A page inside a form</p></div></form>') == "A page inside a form"
    assert html.text_of('<body><p>A long enough text of its own</p><form>Name <input></form></body>') == "A long enough text of its own"
    assert html.text_of("<nav>n<article>teaser</article></nav><div><p>text</p></div>") == "text"
    assert html.text_of('<head><title>t<body><main><p>x</p></main>') == ""  # an unclosed title holds the rest
    assert html.text_of('<head><meta a=b><body><p>x</p>') == "x"


def test_recurrence_comes_before_names(spark):
    """Unnamed boilerplate of a host goes, also inside named elements and around articles; the same markup on single pages stays."""
    rows = []
    for i in range(12):
        page = f"<body><div class=top><b>Site of all</b><div><a href=/>Home</a></div></div><article><h1>Title {i}</h1><div><p>Own words {i} of this page</p></div><div>Like us everywhere</div></article><section>Made in {i}</section><div>Same end</div></body>"
        rows.append((i, f"https://a.example/{i}", page))
        rows.append((100 + i, f"https://b{i}.example/", page))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = [r.host for r in html.templates(df).collect()]
    assert found == ["a.example"] * 4
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert all(got[i] == f"Title {i}\n\nOwn words {i} of this page" for i in range(12))
    assert all(got[100 + i] == f"Title {i}\n\nOwn words {i} of this page\n\nLike us everywhere" for i in range(12))


def test_counts_match_plain_counting(spark):
    rng = random.Random(4)
    parts = [f"<div><p>part {k}</p></div>" for k in range(8)]
    rows = [(i, f"https://h{rng.randrange(2)}.example/{i}", "<body>" + "".join(rng.sample(parts, 3)) + f"<section><p>{rng.randrange(30)}</p></section></body>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen, pages = defaultdict(set), defaultdict(set)
    for _, url, page in rows:
        root = html.parse(page)
        every = html.hashes(root)
        text = "\n\n".join(html.blocks(root))
        pages[url.split("/")[2]].add(text)
        for h in every:
            seen[url.split("/")[2], h].add(text)
    want = {(host, h) for (host, h), own in seen.items() if len(own) >= html.MANY and len(own) >= html.SHARE * len(pages[host])}
    assert want and sorted(map(tuple, html.templates(df).collect())) == sorted(want)


def test_time_is_linear():
    for page in ("<b>{n}</i>", "<i><td>{n}", "<nav>{n}</p>", "<article>{n}", "<p><b>{n}", "<ul><li>{n}</li>"):
        head, tail = page.split("{n}")
        began = time.time()
        html.text_of(head * 40_000 + tail * 40_000)
        assert time.time() - began < 8
