import base64
import hashlib
import html
import random
import re
import time
import zipfile

import pyarrow as pa
import pytest

from terrafold.llm import html_template, warc_zip


def test_articles_of_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in html_template.main_text(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body.replace("<br>", " ")))
        want = "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


PAGES = {
    "<p>a &amp; b&nbsp;c<p>d<br>e</p><div class='cookie-notice'>x</div>": "a & b c\n\nd e",
    None: "",
    "": "",
    "plain <b>t</b>ext": "plain text",
    "<main><header><h1>T</h1></header><p>x</p><form>f</form></main><footer>z</footer>": "T\n\nx",
    "<ul><li>one<li>two</ul><table><tr><td>1<td>2</table><script>var a='<p>no</p>'</script><!-- c -->": "one\n\ntwo\n\n1\n\n2",
    "<article><p>t</p><section id=comments><p>hm</p></section></article><aside>s</aside>": "t",
    "<p>open <b>bold<p>next</b> end<!-- never closed": "open bold\n\nnext end",
    "<article>" + "<p>w</p>" * 3000: "\n\n".join(["w"] * 3000),
    "<p title='a>b'>q</p><p style='display:none'>h</p>&copy; &lt;p&gt;": "q\n\n© <p>",
}


INLINE_PAGES = {
    '<body><a class="skip-link" href="#x">Skip</a><article><p>one</p><p>two</p></article></body>': "one\n\ntwo",
    '<a class="skip-link">Skip</a><p>one</p><div>two</div>': "one\n\ntwo",
    '<p><i class="fa" aria-hidden="true"></i> text</p>': "text",
    '<p>a <span class="notice">x</span> b</p><p>c</p>': "a b\n\nc",
    '<p>a <span class="notice">x <span>y</span> z</span> <b hidden>h</b>b</p><p>c d</p>': "a b\n\nc d",
    '<div><a class="promo"><div>x</div>y</a>z <b>bold</b> end</div>': "z bold end",
    '<p>a <span class="notice">x</p><p>b</span> c</p>': "a\n\nb c",
}


def test_bare_inline_elements_end_at_their_end_tags():
    for page, want in INLINE_PAGES.items():
        batch = pa.RecordBatch.from_pydict({"_id": [1], "_url": ["http://h/"], "_html": [page]})
        (out,) = html_template.parse_pages(iter([batch]))
        assert "\n\n".join(b["text"] for b in out.column("blocks")[0].as_py()) == want


NAMED_PAGES = {
    '<div class="content-sidebar-wrap"><main><p>a</p></main><div class="sidebar">x</div></div>': "a",
    '<div class="sidebar-left"><p>x</p><article><p>a</p></article></div>': "x\n\na",
    '<div class="has-sidebar"><p>a</p></div><p>b</p><p>c</p><div class="no-sidebar">d</div>': "a\n\nb\n\nc\n\nd",
    '<article class="post social-news"><p id="share-prices">a</p><p>b</p></article>': "a\n\nb",
    '<article class="promo"><p>a</p></article><div class="ad">x</div>': "a",
    '<div id="social"><p>most of the words</p></div><p>b</p>': "most of the words\n\nb",
    '<p title="the hidden cost">a</p><p class="hidden lg:block">b</p><p data-hidden="1">c</p><p hidden>x</p>': "a\n\nb\n\nc",
    '<p title="role=\'menu\' class=ad">a</p><p HIDDEN="">x</p><p class=\'top-ad-300x250\'>x</p><p>b</p>': "a\n\nb",
    '<div class="ad">x y z</div><article>a<div id="post-comments">x y z</div></article>': "a",
    '<div class="ad">the only text</div>': "the only text",
    '<div><p>the whole body</p></div><article><p>teaser</p></article>': "the whole body\n\nteaser",
    '<nav><main>x</main></nav><div class="menu"><article hidden>x</article>y</div><p>a</p>': "a",
}


def test_names_bar_no_articles():
    for page, want in NAMED_PAGES.items():
        batch = pa.RecordBatch.from_pydict({"_id": [1], "_url": ["http://h/"], "_html": [page]})
        (out,) = html_template.parse_pages(iter([batch]))
        assert "\n\n".join(b["text"] for b in out.column("blocks")[0].as_py()) == want


def test_pages_of_edge_cases(spark):
    rows = [(i, f"http://h{i}.example/", page) for i, page in enumerate(PAGES)] + [(None, None, "<p>x</p>")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS text")
    got = html_template.main_text(pages).collect()
    assert {r.page_id: r.text for r in got} == {**dict(enumerate(PAGES.values())), None: "x"}
    assert len(got) == len(rows) and html_template.main_text(pages.limit(0)).count() == 0


def test_recurring_subtrees_go_and_articles_stay(spark):
    chrome = "<div><p>All our offers</p><span>Call now</span></div>"
    rows = [(i, "http://shop.example/p", f"<body>{chrome}<div><p>Text number {i}</p></div></body>") for i in range(8)]
    rows += [(20 + i, "http://other.example/p", f"<body>{chrome}<p>Only {i}</p></body>") for i in range(2)]
    same = "<article><p>Shared words</p><div><p>Subscribe now</p></div><p>Own {}</p></article>"
    rows += [(40 + i, "http://news.example/p", same.format(i)) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_template.main_text(pages).collect()}
    assert got[3] == "Text number 3"
    # Two pages are no site.
    assert got[21] == "All our offers\n\nCall now\n\nOnly 1"
    assert got[42] == "Shared words\n\nOwn 2"


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    page = "<body><div><p>Notice number {}</p></div><div><p>Text number {}</p></div></body>"
    # Each of 15 notices is on 4 pages of 60, a fifteenth of them; null ids and equal pages, too.
    rows = [(i, "http://big.example/p", page.format(i % 15, i)) for i in range(60)]
    rows += [(None, "http://big.example/q", page.format("0", 0))] * 30
    rows += [(100, "http://big.example/r", page.format("alone", 100)), (101, "http://big.example/s", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_template.main_text(pages).collect()
    assert sorted((r.page_id for r in got), key=str) == sorted((r[0] for r in rows), key=str)
    want = {i: (f"Text number {i}", 1) for i in range(60)}
    want |= {None: ("Text number 0", 1), 100: ("Notice number alone\n\nText number 100", 0), 101: ("", 0)}
    assert {r.page_id: (r.text, r.n_template_blocks) for r in got} == want


COMMENTS = " ".join(["so true"] * 30)
ALWAYS_PAGES = {
    f'<div class="post"><p>one</p></div><div class="comments">{COMMENTS}</div>': "one",
    f'<p>one</p><div class="comment-list"><p>{COMMENTS}</p></div>': "one",
    f'<p>one</p><div id="sidebar">{COMMENTS}</div><ul class="nav-menu"><li>{COMMENTS}</li></ul>': "one",
    f'<div class="comments">{COMMENTS}</div>': "",
    '<form id="aspnetForm"><div class="sidebar">x</div><article><p>one</p></article><input></form>': "one",
    "<form><p>x</p><article hidden>y</article></form><p>one</p>": "one",
    "<article><p>one</p><form><p>x</p></form></article>": "one",
}


def test_comments_go_whatever_their_size_and_forms_keep_articles():
    for page, want in ALWAYS_PAGES.items():
        batch = pa.RecordBatch.from_pydict({"_id": [1], "_url": ["http://h/"], "_html": [page]})
        (out,) = html_template.parse_pages(iter([batch]))
        assert "\n\n".join(b["text"] for b in out.column("blocks")[0].as_py()) == want


def test_few_pages_of_a_large_host_share_by_chance(spark):
    shared = "<h2>References</h2><p>He was born in Rome.</p>"
    rows = [(i, "http://big.example/p", f"<body><div><p>All offers</p></div><div>{shared if i < 4 else ''}<p>Text {i}</p></div></body>") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_template.main_text(pages).collect()}
    assert got == {i: ("References\n\nHe was born in Rome.\n\n" if i < 4 else "") + f"Text {i}" for i in range(400)}


def test_templates_are_counted_as_plainly(spark):
    """Subtrees of every page counted in plain Python, page by page."""
    rng, pages = random.Random(3), []
    for i in range(300):
        host = rng.choice(["a", "a", "a", "b", "c"])
        parts = [f"<div><p>{rng.choice('uvw')}{rng.randint(0, rng.choice([3, 30, 300]))}</p><span>{rng.randint(0, 9)}</span></div>" for _ in range(rng.randint(0, 5))]
        pages.append((i, f"http://{host}.example/", f"<body>{''.join(parts)}<section><p>own {rng.randint(0, 250)}</p></section></body>"))
    parsed, bodies, seen = [], {}, {}
    for key, url, page in pages:
        blocks, nodes = html_template.parse(page)
        digests, ups = html_template._subtrees(blocks, nodes)
        body = "\n".join(t for t, _, bare in blocks if not bare)
        parsed.append((key, url, blocks, digests, ups))
        bodies.setdefault(url, {}).setdefault(body, set()).add(tuple(sorted(set(digests))))
    for url, found in bodies.items():
        for forms in found.values():
            # Pages with one text count by one form; here equal texts have equal forms.
            assert len(forms) == 1
            for digest in next(iter(forms)):
                seen[url, digest] = seen.get((url, digest), 0) + 1
    want = {}
    for key, url, blocks, digests, ups in parsed:
        kept = []
        for text, at, bare in blocks:
            place, gone = at.place, bare
            while place >= 0:
                gone = gone or seen[url, digests[place]] >= max(4, len(bodies[url]) ** (1 / 3) - 1e-9)
                place = ups[place]
            if not gone:
                kept.append(text)
        want[key] = "\n\n".join(kept)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_template.main_text(df).collect()} == want
    assert len(set(want.values())) > 100


HEAVY_PAGES = [
    '<a b=" ' * 80_000, '<a b=" ' * 80_000 + ">", "<div>" * 100_000 + "x", "<div>" * 50_000 + "</p></li></b>" * 50_000,
    "<div>" * 30_000 + "<li>x</li>" * 30_000, "<!" * 200_000, "<a " * 200_000, "<a b=\"'>" * 60_000, "<ul>" * 50_000, "<div><p>w</p>" * 40_000,
]


def test_heavy_pages_take_linear_time():
    for page in HEAVY_PAGES:
        batch = pa.RecordBatch.from_pydict({"_id": [1], "_url": ["http://h/"], "_html": [page]})
        start = time.process_time()
        (out,) = html_template.parse_pages(iter([batch]))
        columns = [out.column(c) for c in ("_id", "_url", "digests", "ups", "blocks")]
        none = pa.array([None], pa.list_(pa.int64()))
        (kept,) = html_template.without_templates(iter([pa.RecordBatch.from_arrays([*columns, none], ["_id", "_url", "digests", "ups", "blocks", "templates"])]))
        assert time.process_time() - start < 30
        assert len(kept.column("text")[0].as_py()) <= len(page)


def rows_of(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def archived(rows):
    tops = {}
    for key, page in rows:
        tops.setdefault(page or "", []).append(key)
    out = []
    for key, page in rows:
        data = (page or "").encode()
        top = max((k for k in tops[page or ""] if k is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), digest, *(("response", None) if key == top else ("revisit", top))))
    return sorted(out, key=str)


def test_archives_of_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert rows_of(warc_zip.archived_pages(pages)) == archived([(r.page_id, r.html) for r in pages.collect()])


def test_archives_of_edge_cases(spark):
    rows = [(1, "é\r\n\r\nx"), (2, None), (3, ""), (4, "a"), (4, "a"), (2, "a"), (None, "a"), (None, "z"), (9, "y" * 300_000)]
    pages = spark.createDataFrame([(k, "http://x y/\n", p) for k, p in rows], "page_id long, url string, html string")
    pages = pages.selectExpr("*", "1 AS payload", "2 AS path")
    assert rows_of(warc_zip.archived_pages(pages)) == archived(rows)
    assert warc_zip.archived_pages(pages.limit(0)).count() == 0
    whole = warc_zip.archived_pages(pages, least=2).filter("payload_bytes < 2")
    assert {r.record_type for r in whole.collect()} == {"response"}


def test_small_packages_hold_the_payloads(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * 50) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    manifest = warc_zip.write_packages(pages, package_bytes=1000)
    assert manifest.count() > 3 and manifest.agg({"records": "sum"}).first()[0] == 40
    got = {r.record_id: bytes(r.payload).decode() for r in warc_zip.read_packages(manifest).collect()}
    assert got == {str(i): page for i, _, page in rows}
    path = manifest.first().path.removeprefix("file:")
    with zipfile.ZipFile(path) as package:
        assert package.testzip() is None and set(package.namelist()) == {warc_zip.ARCHIVE, warc_zip.INDEX}
        members = list(warc_zip.Package(path).members())
        with open(path, "rb") as file:
            for name, method, begin, size in members:
                file.seek(begin)
                assert method == 0 and file.read(size) == package.read(name)


def test_zip64_directories(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    path, bodies = str(tmp_path / "big.zip"), {f"archive/{i}": bytes([65 + i]) * (90 + 40 * i) for i in range(6)}
    with zipfile.ZipFile(path, "w") as package:
        for name, body in bodies.items():
            package.writestr(name, body)
        package.comment = b"PK comment"
    data = open(path, "rb").read()
    assert b"PK\x06\x07" in data
    assert {n: data[b : b + s] for n, _, b, s in warc_zip.Package(path).members()} == bodies


def test_damaged_packages_are_named(tmp_path):
    path = tmp_path / "cut.zip"
    path.write_bytes(b"PK\x03\x04 no directory")
    with pytest.raises(ValueError, match="cut.zip"):
        list(warc_zip.Package(str(path)).members())
