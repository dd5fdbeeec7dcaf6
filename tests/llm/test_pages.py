"""Operators on web pages against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tagweave.llm import html_text, urls, warc
from tagweave.storage import scratch_path

SCHEMA = "page_id long, url string, html string, id string, host string, text string, size long"


@pytest.fixture(scope="module")
def rows():
    long = "<p>" + "word " * 60_000 + "</p>"
    body = "<article><h1>T &amp; t</h1><p>" + "many words " * 100 + "</p></article>"
    return [
        (1, None, None), (2, "", ""), (3, "http://a.net", body), (4, "http://a.net/x", body), (5, "no scheme", body), (5, "HTTP://B.Net/en/\r\nX: y", body),
        (6, "https://u.example.net/en/1?q=/", long), (7, "https://example.com/de/", "short"), (8, "x://org/fr/a#b", "short"), (None, "http://www.org/fr", body),
    ]


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame([(*r, "z", "z", "z", 1) for r in rows], SCHEMA).repartition(3)


def verdict(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def test_urls(spark, pages, rows):
    rules = urls.RULES + [("a.net", "/x", "block"), ("net", "", "allow"), ("com", "/d", "allow")]
    for some in (urls.RULES, rules):
        found = urls.judge(pages, urls.rule_table(spark, some))
        assert Counter(map(tuple, found.collect())) == Counter((i, *verdict(u, some)) for i, u, _ in rows)
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in urls.judge(pages, empty).collect()} == {"allow"}
    assert urls.judge(pages.filter("page_id < 0"), empty).count() == 0


def test_archive(spark, pages, rows):
    path = scratch_path(spark, "warc")
    warc.write_archive(pages, path)
    found = warc.read_archive(spark, path).collect()
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    expected = Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        last = max((x for x in groups[h or ""] if x is not None), default=None)
        revisit = len(body) >= 1000 and i != last
        expected[(i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", last if revisit else None, body)] += 1
    assert Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in found) == expected
    for r in found:
        header, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        assert header + b"\r\n\r\n" == bytes(r.header) and header.startswith(b"WARC/1.1\r\n") and b"\nX: y" not in header
        assert rest == (b"" if r.record_type == "revisit" else bytes(r.payload)) + b"\r\n\r\n"
        assert r.said_digest == r.payload_digest and r.said_bytes == r.payload_bytes
    assert spark.read.parquet(f"{path}/payloads").count() == len(groups)
    empty = scratch_path(spark, "empty")
    warc.write_archive(pages.filter("page_id < 0"), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_a_changed_payload_fails_the_read(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write_archive(pages, path)
    changed = spark.read.parquet(f"{path}/payloads").selectExpr("address", "cast('x' as binary) as payload", "size", "sha1", "n", "keep")
    changed.write.parquet(f"{path}-2/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}-2/records")
    with pytest.raises(Exception, match="does not fit its address"):
        warc.read_archive(spark, f"{path}-2").collect()


def test_a_changed_header_fails_the_read(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write_archive(pages, path)
    for k, change in enumerate(("replace(header, 'Content-Length: ', 'Content-Length: 9')", "regexp_replace(header, 'sha1:.', 'sha1:x')")):
        records = spark.read.parquet(f"{path}/records").selectExpr("id", "cast(header as string) header", "address")
        records.selectExpr("id", f"cast({change} as binary) header", "address").write.parquet(f"{path}-{k}/records")
        spark.read.parquet(f"{path}/payloads").write.parquet(f"{path}-{k}/payloads")
        for columns in (["payload"], ["payload_digest"], ["record"]):
            with pytest.raises(Exception, match="does not fit its header"):
                warc.read_archive(spark, f"{path}-{k}").filter("record_type = 'response'").select("id", *columns).collect()


def test_a_changed_payload_fails_a_read_of_its_digest(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write_archive(pages, path)
    changed = spark.read.parquet(f"{path}/payloads").selectExpr("address", "cast('x' as binary) as payload", "size", "sha1", "n", "keep")
    changed.write.parquet(f"{path}-2/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}-2/records")
    with pytest.raises(Exception, match="does not fit its address"):
        warc.read_archive(spark, f"{path}-2").select("id", "payload_bytes", "payload_digest").collect()


def test_blocks():
    page = """<html><head><title>x</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>menu</li></ul></nav>
      <div class="cookie-notice">We use cookies</div><main><article><header><h1>A &lt; B</h1></header><p>one<br>two&nbsp; three<p>four <b>bold
      <p>five</p><aside>side</aside><div class="ad">buy</div><script>if (a < b) { x }</script><form>f<input></form>
      <section class="comments"><p>nice post</p></section></article></main><footer>foot</footer></body>"""
    assert html_text.blocks(page) == ("article", ["A < B", "one two three", "four bold", "five"])
    assert html_text.blocks("<body><div>a</div></div><p>b") == ("open", ["a", "b"])
    assert html_text.blocks("")[1] == [] and html_text.blocks("<<p>x & y &am")[1][-1].endswith("x & y &am")


@pytest.mark.parametrize(
    "page",
    [
        '<div class="content"><p>text</p></div><article class="comment-body"><p>nice</p></article>',
        '<div class="content"><p>text</p></div><div id="comments"><article><p>nice</p></article></div>',
        "<main></main><div><p>text</p></div>",
        '<!-- <article> --><script>"<main"</script><div><p>text</p></div>',
        '<div class="no-sidebar"><article><p>text</p></article></div>',
        '<div class="has-sidebar"><p>text</p></div>',
        '<div class="content-with-menu"><main><p>text</p></main></div>',
        '<div class="sidebar"><p>links</p><article><p>text</p></article></div>',
        '<div id="comments"><main><p>text</p></main></div>',
        '<main><p>text</p><div class="related"><article><p>other</p></article></div></main>',
        '<div class="site-footer">foot</div><div class="cookie-notice">we use</div><div class="ad-slot-1">buy</div><p>text</p>',
    ],
)
def test_no_main_text_is_lost(page):
    assert html_text.blocks(f"<html><body>{page}</body></html>")[1] == ["text"]


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ('<article><p>before <span class="ad"><div>buy</div></span> after</p></article>', ["before after"]),
        ("<article><p>before <button><div>buy</div></button> after</p></article>", ["before after"]),
        ("<article><p>before <noscript><p>turn it on</p></noscript>after</p></article>", ["before after"]),
        ("<article><p>before <svg><title>t</title></svg>after</article>", ["before after"]),
        ("<article><p>before <label><div>name</div></label>after</p><p>next</p></article>", ["before after", "next"]),
        ('<article><p>one <span class="ad">buy<p>two</p><p>three</p></article>', ["one", "two", "three"]),
        ('<article><p>one<aside><p>side</p></aside>two<p>three</article>', ["one", "two", "three"]),
        ("<article><p>a</p></article><!-- open <p>b", ["a"]),
        ('<script>"<!--"</script><article><p>a</p></article>', ["a"]),
        ('<article><p>teaser</p></article><article><p>more</p></article><div><p>the real text of the page</p></div>', ["the real text of the page"]),
        ('<article class="post related"><p>other things to read</p></article><article><p>text</p></article>', ["text"]),
        ('<article class="post sponsored"><p>the only one</p></article>', ["the only one"]),
        ("<main>bare <b>words</b><div>block</div>tail</main>", ["bare words", "block", "tail"]),
    ],
)
def test_hidden_parts_take_nothing_with_them(page, expected):
    assert html_text.blocks(f"<html><body>{page}")[1] == expected


def test_repeats_decide_between_a_short_article_and_open_text(spark):
    """The same long text beside the article of every page of a host is boilerplate; a page's own text is not."""
    random.seed(6)
    words = lambda n: " ".join("".join(random.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    foot, texts = words(60), [words(20) for _ in range(12)]
    rows = [(i, f"http://h.example/{i}", f"<article><p>{t}</p></article><div><p>{foot}</p></div>") for i, t in enumerate(texts)]
    rows += [(100 + i, f"http://own.example/{i}", f"<article><p>teaser {i}</p></article><div><p>{t} {words(40)}</p></div>") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.id: r.text for r in html_text.extract(df).collect()}
    assert all(found[i] == t for i, t in enumerate(texts))
    assert all(found[100 + i].startswith(t) and "teaser" not in found[100 + i] for i, t in enumerate(texts))


def test_extract(pages, rows):
    found = Counter((r.id, r.url, r.text) for r in html_text.extract(pages).collect())
    assert found == Counter((i, u, "\n\n".join(html_text.blocks(h or "")[1])) for i, u, h in rows)
    assert html_text.extract(pages.filter("page_id < 0")).count() == 0


@pytest.mark.parametrize("most", [1, 64])
def test_repeats_of_a_host_go(spark, monkeypatch, most):
    monkeypatch.setattr(html_text, "MOST_UNITS", most)
    random.seed(2)
    words = lambda n: " ".join("".join(random.choice("abcdefghijklmno") for _ in range(7)) for _ in range(n))
    foot = "Contact us in the main street of the town, all rights reserved by the company"
    parts = [(i, "a.example" if i < 40 else f"h{i}.example", words(30), words(10)) for i in range(60)]
    rows = [(i, f"http://{h}/{i}", f"<body><div>{a}</div><div>{foot}</div><div>{b}</div></body>") for i, h, a, b in parts]
    found = {r.id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, h, a, b in parts:
        assert found[i] == "\n\n".join([a, b] if h == "a.example" else [a, foot, b])


def made(n):
    return " ".join("".join(random.choice("abcdefghijklmno") for _ in range(7)) for _ in range(n))


@pytest.mark.parametrize("group", [16, 512])
def test_the_host_is_judged_inside_articles(spark, monkeypatch, group):
    """What most of a host's articles share is the host's; what some of them share, or a small host's do, is the articles'."""
    monkeypatch.setattr(html_text, "GROUP", group)
    random.seed(11)
    call, credit, short = made(12), made(12), ["Share", "Print it", "Tell a friend", "Write to the author", "Back to the top"]
    rows, expected = [], {}
    for i in range(130):
        host, a, b = ("big.example" if i < 120 else f"small{i % 2}.example"), made(30), made(20 + i % 5)
        blocks = [a, credit if i % 3 == 0 else call, b, *short]
        page = "<article>" + "".join(f"<p>{x}</p>" for x in blocks) + "</article>"
        # Copies of an article count once.
        rows += [(i, f"http://{host}/{i}", page)] * (40 if i == 3 else 1)
        own = blocks if i >= 120 else [a, credit, b] if i % 3 == 0 else [a, b]
        expected[i] = "\n\n".join(own)
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.text == expected[r.id], r.id


def test_versions_of_one_article_stay_whole(spark):
    random.seed(12)
    shared = [made(15) for _ in range(6)]
    texts = ["\n\n".join([*shared[:3], made(12), *shared[3:]]) for _ in range(40)]
    rows = [(i, f"http://a.example/{i}", "<article><p>" + t.replace("\n\n", "</p><p>") + "</p></article>") for i, t in enumerate(texts)]
    found = {r.id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == dict(enumerate(texts))


def test_open_text_of_all_pages_shows_what_repeats(spark):
    """Beside a teaser the host's foot goes, though no other page with that foot has more open text than article."""
    random.seed(13)
    foot, main = made(12), made(40)
    rows = [(0, "http://a.example/0", f"<article><p>teaser</p></article><div><p>{main}</p><p>{foot}</p></div>")]
    rows += [(i, f"http://a.example/{i}", f"<article><p>{made(50)}</p></article><div><p>{foot}</p></div>") for i in range(1, 4)]
    found = {r.id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[0] == main
    assert all(foot not in found[i] for i in range(1, 4))


def test_strings_of_an_article_against_plain_python(spark, monkeypatch):
    """Byte ranges of one host's texts against all strings of all texts, with odd ones among them."""
    random.seed(14)
    some = [made(3), made(4)]
    texts = {" ".join(random.choice(some) for _ in range(random.randint(1, 12))) + random.choice(["", "\n\né ", "x"]) for _ in range(60)} | {"", "a"}
    monkeypatch.setattr(html_text, "GROUP", 1000)
    df = spark.createDataFrame([("h", i, t) for i, t in enumerate(sorted(texts))], "host string, mark long, marked string")
    size = html_text.REPEATED
    data = [t.encode() for t in sorted(texts)]
    count = Counter(s for d in data for s in {d[p : p + size] for p in range(len(d) - size + 1)})
    usual = {s for s, n in count.items() if 2 * n > len(data) - 1}  # the empty text is none
    assert usual
    found = {r.mark: {p for s in r.spans for p in range(s.first, s.upto)} for r in html_text.host_spans(df).collect()}
    for i, d in enumerate(data):
        places = {p + k for p in range(len(d) - size + 1) if d[p : p + size] in usual for k in range(size)}
        assert found.get(i, set()) == places
