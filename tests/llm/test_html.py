import time

import pytest

from panelmart.llm.html import Page, extract

CASES = [
    ("<p>a &amp; b</p><p>c&nbsp;\n d<b>e</b></p>", "a & b\nc de"),
    ("<nav>menu</nav><article><h1>T</h1><p>x<p>y<div class='ad'>buy</div></article><footer>f</footer>", "T\nx\ny"),
    ("<article><p>x</p><section id=comments><p>reader</p></section><form>f</form></article><p>other</p>", "x"),
    ("<body><div class='sidebar'><p>s</p></div><p>one<br>two</p><script>var t='</p>';</script><!-- <p>no</p> -->", "one two"),
    ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a\nb\n1\n2"),
    ("a < b and <p class='x>y'>q</p>", "a < b and\nq"),
    ("", ""), (None, ""), ("   ", ""), ("<", "<"), ("<p", ""),
]


@pytest.mark.parametrize("source,text", CASES)
def test_blocks(source, text):
    assert "\n".join(Page(source or "").result()[0]) == text


def test_hostile_pages_end_soon():
    began = time.time()
    for bad in ("<div>" * 20_000 + "x", "<p>" * 20_000 + "x", "'\"<" * 5_000, "<!--", "<script>x", "</div>" * 20_000,
                "<div><p>x" * 5_000):
        Page(bad).result()
    assert time.time() - began < 30


def page(host, n, body):
    return (n, f"https://{host}/p/{n}", f"<html><body><div><p>Site of {host}</p><p>All rights</p></div>{body}</body></html>")


def test_templates_go_and_articles_stay(spark):
    rows = [page("a.example", i, f"<div><p>text {i}</p></div>") for i in range(8)]
    rows += [page("b.example", 100, "<div><p>only page</p></div>")]
    rows += [(200 + i, "https://c.example/", f"<article><p>shared</p><p>own {i}</p></article>") for i in range(8)]
    rows += [(300 + i, "https://d.example/", "<div><p>a copied page</p></div>") for i in range(8)]
    rows += [(None, None, "<p>no url</p>"), (400, "relative/path", None), rows[0]]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {}
    for r in out:
        text.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    assert len(out) == len(rows)
    assert all(text[i] == [f"text {i}"] for i in range(1, 8)) and text[0] == ["text 0"] * 2
    assert text[100] == ["Site of b.example\nAll rights\nonly page"]
    assert all(text[200 + i] == [f"shared\nown {i}"] for i in range(8))
    assert all(text[300 + i] == ["a copied page"] for i in range(8))
    assert text[None] == ["no url"] and text[400] == [""]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string, host int, blocks int")).count() == 0


def texts(spark, rows):
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in out}


def words_of(i, n=60):
    return " ".join(f"w{i}x{j}" for j in range(n))


def test_counts_reach_into_articles(spark):
    rows = [(i, f"https://a.example/{i}", f"<article><h1>Title {i}</h1><p>Read our other offers today</p>"
             f"<p>{words_of(i)}</p></article>") for i in range(8)]
    rows += [(100, "https://b.example/1", f"<div><h1>T</h1><p>{words_of(100)}</p></div><article><p>a teaser</p></article>")]
    text = texts(spark, rows)
    assert all(text[i] == f"Title {i}\n{words_of(i)}" for i in range(8))
    assert words_of(100) in text[100]


def test_copies_keep_what_they_share(spark):
    # near copies at addresses of their own, without article tags
    shared = "".join(f"<p>{words_of(k, 30)}</p>" for k in range(10))
    rows = [(i, f"https://a.example/{i}", f"<div><h2>Copy {i}</h2>{shared}<p>edit {i}</p></div>") for i in range(8)]
    rows += [(100 + i, f"https://a.example/o/{i}", f"<div><p>{words_of(100 + i)}</p></div>") for i in range(4)]
    text = texts(spark, rows)
    assert all(text[i].count("\n") == 11 for i in range(8))


@pytest.mark.parametrize("value", [
    "content has-sidebar", "post no-comments", "type-post comments-open", "layout-right-sidebar", "search-result-body",
    "social-science", "article-header"])
def test_parts_of_names_drop_nothing(value):
    for source in (f"<div class='{value}'><h1>T</h1><p>text</p></div>",
                   f"<article><div class='{value}'><h1>T</h1></div><p>text</p></article>"):
        assert Page(source).result()[0] == ["T", "text"]


def test_names_do_not_drop_most_of_a_page():
    whole = f"<div class='content sidebar'><article><header><h1>T</h1></header><p>{words_of(1)}</p></article></div>"
    assert Page(f"{whole}<p>else</p>").result()[0] == ["T", words_of(1)]
    assert Page(f"<form><p>{words_of(1)}</p><div class=ad>buy</div></form>").result()[0] == [words_of(1)]
    assert Page("<div class='x sidebar'><p>s</p></div><div class='site-footer'>f</div><p>a b</p>").result()[0] == ["a b"]


def test_large_hosts_keep_short_blocks(spark):
    copied = "".join(f"<p>{words_of(k, 30)}</p>" for k in range(10))
    rows = [(i, f"https://a.example/{i}", "<div><p>Site menu</p></div>" + ("<h2>Introduction</h2>" if i % 25 == 0 else "")
             + f"<table><tr><td>n{i}</td><td>{0 if i % 20 == 0 else i}</td></tr></table><p>{words_of(i)}</p>")
            for i in range(1000, 1400)]
    rows += [(i, f"https://a.example/c/{i}", f"<div><p>Site menu</p></div><div>{copied}<p>edit {i}</p></div>")
             for i in range(2000, 2060)]
    text = texts(spark, rows)
    assert text[1000] == f"Introduction\nn1000\n0\n{words_of(1000)}"
    assert text[1001] == f"n1001\n1001\n{words_of(1001)}"
    assert all(text[i].count("\n") == 10 and "menu" not in text[i] for i in range(2000, 2060))


def naive(rows, min_pages=5, share=0.1, **options):
    """Every page against every other of its host, every subtree counted."""
    from panelmart.llm.html import choose
    seen = []
    for page_id, url, source in rows:
        host = url.split("/")[2].lower() if url and "//" in url else ""
        taken, blocks, elements = Page(source or "").result(**options)
        w = "\n".join(taken).lower().split()
        sh = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        seen.append((page_id, host, url, "\n".join(taken), sh, blocks, elements))
    label = list(range(len(seen)))
    for i, a in enumerate(seen):
        for j in range(i):
            b = seen[j]
            near = a[4] and b[4] and 100 * len(a[4] & b[4]) >= 80 * len(a[4] | b[4])
            if a[1] == b[1] and (a[3] == b[3] or near or (a[2] is not None and a[2] == b[2])):
                label = [label[j] if x == label[i] else x for x in label]
    pages, counts = {}, {}
    for x, (_, host, *_, elements) in zip(label, seen, strict=True):
        pages.setdefault(host, set()).add(x)
        for h in elements["hashes"]:
            counts.setdefault((host, h), set()).add(x)
    out = {}
    for page_id, host, *_, blocks, elements in seen:
        gone = frozenset(h for (on, h), n in counts.items() if on == host and len(n) >= min_pages and len(n) >= share * len(pages[host]))
        out[page_id] = "\n".join(b["text"] for b in choose(blocks, elements, gone, **options))
    return out


def site(seed, n):
    import random
    r = random.Random(seed)
    rows = []
    for i in range(n):
        host = r.choice(["a.example", "b.example", "c.example", "d.example"])
        part = lambda k, s: f"<div class=x{k}><p>{' '.join(r.choice(s) for _ in range(3))}</p></div>"
        body = "".join(r.choice([part(k, ["menu", "home"]), part(k, ["alpha", "beta", "gamma", "delta"]), f"<p>{words_of(i, 25)}</p>",
                                 f"<section><h2>Part {k}</h2><p>{words_of(r.randint(0, 9), 12)}</p></section>",
                                 f"<article><p>{words_of(i + 1000, 15)}</p></article>"]) for k in range(r.randint(1, 6)))
        url = f"https://{host}/{r.randint(0, 2 * n)}" if r.random() < 0.9 else r.choice([None, "no/host"])
        rows.append((i, url, f"<body>{body}</body>"))
    return rows


@pytest.mark.parametrize("options", [{}, {"min_pages": 2, "share": 0.3}, {"min_pages": 8, "share": 0.0, "inside": 0.9}])
def test_against_a_naive_recount(spark, options):
    rows = site(5, 150)
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string"), **options).collect()
    want = naive(rows, **options)
    assert {r.page_id: r.text for r in out} == want
    plain = {r[0]: "\n".join(Page(r[2]).result()[0]) for r in rows}
    assert sum(want[i] != plain[i] for i in want) >= 5  # the counts decide something


def test_both_sides_of_the_numbers(spark):
    same = "<p>the same on some</p>"
    rows = lambda n: [(i, f"https://a.example/{i}", (same if i < n else "") + f"<p>{words_of(i)}</p>") for i in range(60)]
    make = lambda n: spark.createDataFrame(rows(n), "page_id long, url string, html string")
    kept = lambda n, **o: sum("same on" in r.text for r in extract(make(n), **o).collect())
    assert kept(6) == 0 and kept(5) == 5                            # a tenth of 60 pages
    assert kept(4, share=0.01) == 4 and kept(5, share=0.01) == 0    # five pages
    named = f"<div class=sidebar><p>{words_of(1, 30)}</p></div><p>{{}}</p>"
    few, many = named.format(words_of(2, 29)), named.format(words_of(2, 30))
    assert words_of(1, 30) in Page(few).result()[0] and Page(many).result()[0] == [words_of(2, 30)]
    small = "<div class=sidebar><p>{}</p></div><p>a b</p>".format
    assert Page(small(words_of(1, 24))).result()[0] == ["a b"] and len(Page(small(words_of(1, 25))).result()[0]) == 2
    beside = "<div><p>{}</p></div><article><p>{}</p></article>".format
    assert Page(beside(words_of(1, 10), words_of(2, 10))).result()[0] == [words_of(2, 10)]
    assert len(Page(beside(words_of(1, 11), words_of(2, 10))).result()[0]) == 2


def test_inline_parts_do_not_split_a_block():
    assert Page("<p>Let <math><mi>x</mi> = 1</math> be <svg><text>v</text></svg>.</p>").result()[0] == ["Let x = 1 be v."]
    assert Page("<p>a <button>go <b>now</b></button>b <select><option>1<option>2</select>c</p>").result()[0] == ["a b c"]
    assert Page("<p>one <span class='ad'>buy <i>this</i></span> two</p>").result()[0] == ["one two"]
    assert Page("<p>a <label>b</label> <span hidden>c</span> <i style='display:none'>d</i></p>").result()[0] == ["a b c d"]


def test_what_leads_up_to_an_article_stays():
    source = "<h1>T</h1><p>lead</p><div><p>teaser</p></div><div><article><p>a b c d e f</p></article></div><p>after</p>"
    assert Page(source).result()[0] == ["T", "lead", "a b c d e f"]


def test_deep_nesting_keeps_its_subtrees(spark):
    deep = lambda x: "<div>" * 3000 + x + "</div>" * 3000
    rows = [(i, f"https://a.example/{i}", "<article><p>t</p></article>" + deep(f"<article><p>{words_of(i)}</p></article><p>Site menu</p>"))
            for i in range(6)]
    text = texts(spark, rows)
    assert all(text[i] == words_of(i) for i in range(6))
