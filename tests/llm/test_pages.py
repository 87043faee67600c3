import base64
import hashlib

from causeway.llm import html, warc

PAGES = "page_id bigint, url string, html string, key string, digest string, path string, host int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", "d", "p", 1) for r in rows], PAGES)


def hard_pages():
    long = "<article>" + "".join(f"<p>Paragraph {i} of a long page &amp; more.</p>" for i in range(5000)) + "</article>"
    return [
        (1, "http://a.example/x", "<p>same</p>"), (2, "http://b.example/y", "<p>same</p>"), (2, "http://b.example/y", "<p>same</p>"), (3, None, None), (4, "", ""), (5, "http://a.example/é?q=1\r\nx", "é\r\n\r\n日本"),
        (None, "not a url", "<p>null id</p>"), (None, None, "<p>null id</p>"), (6, "http://A.Example:8080/x", long), (7, "http://[bad", "<<<>>"), (8, "http://a.example/x", "<p>other</p>"),
    ]


def archived(rows, least=0):
    out, first = [], {}
    for i, (page, _, body) in enumerate(rows):
        data = (body or "").encode()
        if len(data) >= least:
            rank = (page is None, page or 0, i)
            first[data] = min(first.get(data, rank), rank)
    for i, (page, _, body) in enumerate(rows):
        data = (body or "").encode()
        f = first.get(data)
        again = f is not None and f[2] != i
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", (None if f[0] else f[1]) if again else None))
    return sorted(out, key=str)


def test_archive_round_trip(spark):
    rows = hard_pages()
    df = pages(spark, rows).coalesce(1)
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=str) == archived(rows)
    assert sorted(map(tuple, warc.round_trip(df, min_bytes=15).collect()), key=str) == archived(rows, 15)
    assert warc.round_trip(pages(spark, [])).collect() == []


def test_look_up_by_url(spark, tmp_path):
    rows = [(i, f"http://h{i % 7}.example/p{i % 40}", f"<p>{i}</p>") for i in range(900)] + [(i, "http://hot.example/", f"<p>{i}</p>") for i in range(900, 1500)]
    uri = f"file://{tmp_path}/archive"
    archives = warc.write(pages(spark, rows), uri, block=16)
    top = warc.top_table(archives)
    for url in ("http://h3.example/p10", "http://h0.example/p0", "http://h6.example/p39", "http://nowhere.example/", "http://h3.example/p99", "http://hot.example/"):
        found = {r["payload"].decode() for r in warc.look_up(uri, top, url)}
        assert found == {h for _, u, h in rows if u == url}
    some = spark.createDataFrame([(warc.url_key(u),) for u in ("http://hot.example/", "http://h3.example/p10", "http://none.example/")], "key string")
    found = warc.read(archives, uri, some).collect()
    assert sorted(r.page_id for r in found) == sorted(i for i, u, _ in rows if u in ("http://hot.example/", "http://h3.example/p10"))


def test_long_keys_are_found(spark, tmp_path):
    long = "http://l.example/" + "x" * 400
    rows = [(i, f"{long}{i:03d}", f"<p>{i}</p>") for i in range(200)]
    uri = f"file://{tmp_path}/archive"
    top = warc.top_table(warc.write(pages(spark, rows), uri, block=8))
    assert all([r["payload"].decode() for r in warc.look_up(uri, top, f"{long}{i:03d}")] == [f"<p>{i}</p>"] for i in (0, 7, 8, 111, 199))


def test_a_repeated_task_writes_the_same_bytes(spark, tmp_path):
    """Files of two attempts may be mixed: they hold the same bytes."""
    rows = hard_pages()
    bytes_of = []
    for attempt in ("a", "b"):
        archives = warc.write(pages(spark, rows).repartition(1 + len(bytes_of)), f"file://{tmp_path}/{attempt}")
        names = [r.archive for r in archives.orderBy("first_key").collect()]
        bytes_of.append([tuple((tmp_path / attempt / f"{n}.{kind}").read_bytes() for kind in ("warc.gz", "cdx", "dir")) for n in names])
    assert bytes_of[0] == bytes_of[1]


def test_records_hold_what_the_format_asks(spark, tmp_path):
    rows = hard_pages()
    uri = f"file://{tmp_path}/archive"
    archives = warc.write(pages(spark, rows), uri)
    folder, found = warc.Folder(uri), []
    for name in (r.archive for r in archives.collect()):
        for first, last, start, length in warc.read_directory(folder, name):
            keys, places = warc.read_lines(folder, name, start, length)
            assert keys == sorted(keys) and (first, last) == (keys[0], keys[-1])
            found += warc.read_captures(folder, name, start, length, sorted(set(keys)))
    assert len(found) == len(rows)
    ids = {r["WARC-Record-ID"]: r for r in found}
    assert len(ids) == len(rows)
    for r in found:
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "Content-Type"} <= set(r)
        if r["WARC-Type"] == "revisit":
            target = ids[r["WARC-Refers-To"]]
            assert target["WARC-Type"] == "response" and target["WARC-Payload-Digest"] == r["WARC-Payload-Digest"] and target.get("WARC-Target-URI") == r.get("WARC-Refers-To-Target-URI")


def test_url_keys():
    assert warc.url_key("http://www.Example.com:8080/a?b=1") == "com,example,www:8080)/a?b=1"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="main-content"><article><h1>Heading &amp; more</h1><div class="ad-box">Buy this</div><p><b>First<br><p>Second   line
of text with a <a href="/x">link</a> and &eacute;&nbsp;&#8212; signs.</p><ul><li>one<li>two</ul><form><p>Subscribe</p><input></form><aside>More</aside></article>
<div class="comments"><p>A reader says a lot of things in this comment, more than the article has.</p></div></div><div class="sidebar2"><p>Popular</p></div>
<script>document.write("<p>no</p>")</script><footer>&copy; Site</footer></body></html>"""
TEXT = "Heading & more\nFirst\nSecond line of text with a link and é — signs.\none\ntwo"


def test_main_text(spark):
    rows = [(i, "http://a.example/1", ARTICLE) for i in range(3)] + [(10 + i, *r[1:]) for i, r in enumerate(hard_pages())] + [(90, "http://a.example/2", ARTICLE.split("<footer>")[0])]
    out = {r.page_id: r for r in html.extract(pages(spark, rows)).collect()}
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out.values())
    assert {out[i].text for i in (0, 1, 2, 90)} == {TEXT}
    assert out[13].text == out[14].text == ""
    assert out[18].text.count("\n") == 4999 and out[18].text.startswith("Paragraph 0 of a long page & more.")
    assert html.extract(pages(spark, [])).collect() == []


def test_the_host_decides(spark):
    """Most pages of a host have their text in one place; a page with a longer container elsewhere follows them."""
    usual = [(i, "http://h.example/", f'<body><div class="story7"><p>{"text of the page " * 20}{i}</p></div><div class="box"><p>teaser</p></div></body>') for i in range(10)]
    odd = (99, "http://h.example/", f'<body><div class="story8"><p>{"its own story here " * 10}</p></div><div class="box"><p>{"a teaser that runs on " * 14}</p></div></body>')
    out = {r.page_id: r.text for r in html.extract(pages(spark, [*usual, odd])).collect()}
    assert out[99] == ("its own story here " * 10).strip() and out[3].endswith("3")


def test_broken_markup():
    for source, want in (("", ""), ("<p>just", "just"), ("plain text", "plain text"), ("<div><p>a<", "a<"), ("<article><header><h1>Head</h1><p>by me</p></header><p>Body</p></article>", "Head\nBody"), ("<!-- x", ""), ("<p>a<!-- b -->c</p>", "ac")):
        assert html.Page(source).extract(None) == want
    assert html.Page("<div>" * 2000 + "deep").extract(None) == "deep"


def test_names_of_layout_do_not_drop_the_article():
    text = "A long line of the article that tells its story. " * 4
    for opened in ('class="content with-sidebar"', 'id="main" class="no-sidebar"', 'class="post print"', 'class="sidebar-layout"', 'class="print content"'):
        page = f'<body><div {opened}><article><h2 id="search">Search</h2><p>{text}</p><h3 id="related-work">Related work</h3><p>{text}</p></article></div><div class="sidebar"><p>Popular</p></div></body>'
        assert html.Page(page).extract(None).split("\n") == ["Search", text.strip(), "Related work", text.strip()], opened
    plain = f'<body><div class="print content"><p>{text}</p></div><div class="footer content"><p>Site</p></div><div class="comments"><p>{text}</p></div></body>'
    assert html.Page(plain).extract(None) == text.strip()
    both = f'<body><main><p>{text}</p></main><div class="sidebar"><article><p>{text} teaser</p></article></div><div id="comments" class="content"><p>x</p></div></body>'
    assert html.Page(both).extract(None) == text.strip()


def test_no_article_text_is_lost_to_a_deeper_container(spark):
    text = "A long line of the article that tells its story. "
    title = "A title of some sixty characters that belongs to the article"
    post = [(i, "http://p.example/", f'<body><div class="post"><h1>{title}</h1><div class="content"><p>{text * n}</p></div></div></body>') for i, n in enumerate((5, 300, 400, 500))]
    wrap = [(10 + i, "http://w.example/", f'<body><div class="wrap"><div class="text"><p>{text * 77}</p></div><div class="rest"><p>{text * 23}</p></div></div></body>') for i in range(4)]
    usual = [(20 + i, "http://u.example/", f'<body><div class="wrap"><div class="story"><p>{text * 9}</p></div></div></body>') for i in range(4)]
    more = (30, "http://u.example/", f'<body><div class="wrap"><div class="story"><p>{text * 4}</p></div><div class="second"><p>{text * 8}</p></div></div></body>')
    out = {r.page_id: r.text.split("\n") for r in html.extract(pages(spark, [*post, *wrap, *usual, more])).collect()}
    assert all(out[i] == [title, (text * n).strip()] for i, n in enumerate((5, 300, 400, 500)))
    assert all(out[10 + i] == [(text * 77).strip(), (text * 23).strip()] for i in range(4))
    assert out[30] == [(text * 4).strip(), (text * 8).strip()] and out[20] == [(text * 9).strip()]
