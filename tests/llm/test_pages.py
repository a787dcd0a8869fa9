"""Operators on pages and vectors against brute force."""

import base64
import io
import os
import shutil
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from publicspend.llm import main_text, url_reputation, vector_search, warc

PAGES = "page_id bigint, url string, html string, host string, payload binary, sha1 string"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "long text " * 6_000
    rows = [
        (1, "https://a.example.net/en/x?q=1#f", "<p>one</p>"),
        (2, "HTTP://Sub.Example.COM/de/y", "<p>one</p>"),
        (2, "HTTP://Sub.Example.COM/de/y", "<p>one</p>"),
        (3, "http://host.org/fr/", None),
        (4, None, ""),
        (5, "no scheme.net/en/", "WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"),
        (6, "http://x.net", big),
        (7, "http://x.net?", big),
        (8, "ftp://bad\r\nname.org/fr/ü", "é" * 70),
        (None, "http://example.net/en/", "<p>one</p>"),
        (9, "http://é.Ünet.net:80/", "&lt;b&gt;"),
    ]
    return spark.createDataFrame([(*r, "h", b"p", "s") for r in rows], PAGES).repartition(3)


def response_of(rows):
    best = {}
    for page_id, html in rows:
        if page_id is not None:
            best[html] = max(best.get(html, page_id), page_id)
    return best


@pytest.mark.parametrize("compression", ["none", "gzip"])
@pytest.mark.parametrize("least", [0, 50])
def test_warc_round_trip(spark, pages, compression, least):
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    best = response_of(rows)
    expected = []
    for page_id, payload in rows:
        first = best.get(payload)
        revisit = len(payload) >= least and first is not None and page_id != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "revisit" if revisit else "response"
        expected.append((page_id, len(payload), digest, kind, first if revisit else None))
    found = [tuple(r) for r in warc.round_trip(pages, least, compression).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_warc_of_an_empty_table(spark, pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("split", [900, 20_000, 1 << 30])
def test_warc_splits_and_filters(spark, pages, split):
    path = warc.scratch(spark, "test")
    warc.write_archive(warc.records_of(pages), path, mark_bytes=300)
    warc.write_archive(warc.records_of(pages.where("page_id = 8")), path)  # a second part
    warc.register(spark)

    def read(payload="true"):
        options = {"splitBytes": split, "payload": payload}
        return spark.read.format("warc").options(**options).load(path)

    assert read().count() == pages.count() + 1
    ids = [r.record_id for r in read().where("record_type = 'revisit'").collect()]
    assert len(ids) == read().where("record_type <> 'response'").count() > 0
    some = read().where(F.col("record_id").isin("<urn:page:6>", "<urn:page:8>"))
    assert sorted(r.payload is None for r in some.collect()) == [False, False, True]  # 6 revisits 7
    assert read().where("refers_to IS NOT NULL").count() == len(ids)
    assert read("false").where("payload IS NOT NULL").isEmpty()
    assert read("false").count() == pages.count() + 1


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc_payloads_that_quote_records(spark, compression):
    """Chains of whole records in a payload are never read as records, wherever files are cut."""
    quoted = b"".join(
        warc.record_bytes(
            {
                "record_type": "response", "record_id": f"<urn:page:{90 + i}>", "target_uri": "u",
                "refers_to": None, "payload_digest": None, "payload_length": 150, "payload": b"q" * 150,
            }
        )
        for i in range(4)
    )
    bodies = {1: b"x" * 700, 2: b"\r\n\r\n" + quoted, 3: quoted * 3, 4: b"end" * 400, 5: b""}
    rows = [(i, "u", body.decode()) for i, body in bodies.items()]
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    path = warc.scratch(spark, "quoted")
    warc.write_archive(warc.records_of(docs), path, compression, mark_bytes=100)
    counts = set()
    for split in (1, 300, 600, 900, 2500, 1 << 30):
        table = warc.read_archive(spark, path, split_bytes=split)
        counts.add(table.rdd.getNumPartitions())
        found = {r.record_id: bytes(r.payload) for r in table.collect()}
        assert found == {f"<urn:page:{i}>": body for i, body in bodies.items()}
    assert len(counts) > 2 and max(counts) >= 4
    # the same files without their list, as others write them
    (name,) = [f for f in os.listdir(path) if ".warc" in f]
    other = warc.scratch(spark, "foreign")
    os.makedirs(other)
    shutil.copy(f"{path}/{name}", f"{other}/{name}")
    assert warc.read_archive(spark, other, split_bytes=300).count() == len(bodies)
    assert warc.read_archive(spark, f"{path}/{name}", split_bytes=300).count() == len(bodies)


def test_warc_headers_without_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MOST_HEADER_BYTES", 1 << 10)
    reader = warc._Buffered(io.BytesIO(b"WARC/1.1\r\nA: " + b"x" * 5000), 0)
    with pytest.raises(ValueError, match="headers at byte 0 do not end"):
        reader.headers()


def test_warc_reads_of_the_query_are_filtered(spark, pages, monkeypatch):
    seen = []
    pushed = warc._Reader.pushFilters

    def push(self, filters):
        kept = list(pushed(self, filters))
        seen.append((self.with_payload, dict(self.wanted)))
        return iter(kept)

    reader = warc._Reader({"path": "/nowhere", "payload": "false"})
    monkeypatch.setattr(warc._Reader, "pushFilters", push)
    from pyspark.sql.datasource import EqualTo

    list(reader.pushFilters([EqualTo(("record_type",), "revisit")]))
    assert seen == [(False, {"warc-type": frozenset(["revisit"])})]
    plan = warc.round_trip(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "record_type" in plan and "Filter (record_type" not in plan.replace("#", "")


def test_warc_filters_reach_the_reader(spark, pages):
    reader = warc._Reader({"path": "/nowhere"})
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    kept = list(
        reader.pushFilters(
            [
                EqualTo(("record_type",), "response"),
                In(("record_id",), ("a", "b")),
                GreaterThan(("content_length",), 5),
            ]
        )
    )
    assert [type(f) for f in kept] == [GreaterThan]
    assert reader._passes({"warc-type": "response", "warc-record-id": "b"})
    assert not reader._passes({"warc-type": "response", "warc-record-id": "c"})


def judged(url):
    """Host, path and rule by the words of the rules."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[: min(ends, default=len(rest))]
    path = rest[len(host) :]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        r
        for r in url_reputation.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


def test_urls(spark, pages):
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 1), (99, 1)], "page_id bigint, bad int")
    rows = url_reputation.judge_urls(pages, labels).collect()
    expected = []
    for page in pages.collect():
        host, path, rule = judged(page.url)
        expected.append((page.page_id, host, path, rule and rule.text))
        assert rule is None or [r.verdict for r in rows if (r.host, r.path) == (host, path)][0] == rule.verdict
    found = [(r.page_id, r.host, r.path, r.rule) for r in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert url_reputation.judge_urls(pages.limit(0), labels).count() == 0
    assert url_reputation.judge_urls(pages, labels, rules=()).where("rule IS NOT NULL").isEmpty()


def test_hosts_are_blocked_by_their_pages(spark):
    """End to end: junk pages block their host, and a small host of a bad domain with it."""
    junk, prose = "<p>" + "buy%%% now### $$$ " * 20 + "</p>", "<p>plain words, and more of them</p>"
    rows = [("bad.spam.com", junk)] * 60 + [("bad.spam.com", prose)] * 4
    rows += [(f"h{i}.spam.com", junk) for i in range(40)] + [("new.spam.com", None)]
    rows += [("good.fine.com", prose)] * 60 + [("good.fine.com", junk)] * 3 + [("one.fine.com", junk)]
    rows += [("a.example.net", junk)] * 5 + [("b.example.net", prose)] * 5
    pages = spark.createDataFrame(
        [(i, f"http://{host}/{'en' if i % 2 else 'de'}/p", html) for i, (host, html) in enumerate(rows)],
        "page_id bigint, url string, html string",
    )
    outcome = pages.withColumn("bad", url_reputation.junk(F.col("html")))
    found = url_reputation.judge_urls(outcome)
    by_host = {r.host: set(r.verdicts) for r in found.groupBy("host").agg(F.collect_set("verdict").alias("verdicts")).collect()}
    assert by_host["bad.spam.com"] == {"block"} and by_host["good.fine.com"] == {"allow"}
    assert by_host["h7.spam.com"] == by_host["new.spam.com"] == {"block"}
    assert by_host["one.fine.com"] == {"allow"}  # one page does not condemn it
    assert {(r.host, r.verdict) for r in found.where("rule = 'net/'").collect()} == {
        ("a.example.net", "block"), ("b.example.net", "block"),
    }
    # the same from labels by page
    labels = outcome.select("page_id", "bad")
    again = url_reputation.judge_urls(pages.select("page_id", "url"), labels)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, found.collect()), key=repr)


def shrunk(levels, rules):
    """Posterior mean and lower bound of each host, by plain loops."""
    n, bad = (sum(x[i] for x in levels.values()) for i in (0, 1))
    parents = {(): (bad + 0.5) / (n + 1)}
    for depth in (1, 2, 3):
        counts = {}
        for names, (count, wrong) in levels.items():
            old = counts.get(names[:depth], (0, 0))
            counts[names[:depth]] = old[0] + count, old[1] + wrong
        excess = room = 0.0
        for names, (count, wrong) in counts.items():
            m = parents[names[:-1]]
            if count and 0 < m < 1:
                excess += count * (wrong / count - m) ** 2 - m * (1 - m)
                room += m * (1 - m) * (count - 1)
        strength = rules.weakest
        if room:
            r = excess / room
            strength = min(max(1 / r - 1 if r > 0 else rules.strongest, rules.weakest), rules.strongest)
        posterior = {}
        for names, (count, wrong) in counts.items():
            m = parents[names[:-1]]
            posterior[names] = m * strength + wrong, (1 - m) * strength + count - wrong
        parents = {names: a / (a + b) for names, (a, b) in posterior.items()}
    return {
        names[2]: (
            a / (a + b),
            a / (a + b) - rules.deviations * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5,
        )
        for names, (a, b) in posterior.items()
    }


def test_reputation_by_hand(spark):
    rng, rules = random.Random(2), url_reputation.Reputation()
    levels = {}
    for domain, share in (("spam.com", 0.9), ("fine.com", 0.1), ("odd.org", 0.5), ("few.co.uk", 0.6)):
        for i in range(6):
            n = rng.randrange(0, 40)
            suffix = domain.split(".", 1)[1]
            levels[suffix, domain, f"h{i}.{domain}"] = n, sum(rng.random() < share for _ in range(n))
    outcomes = [(h, int(i < bad)) for (_, _, h), (n, bad) in levels.items() for i in range(n)]
    hosts = spark.createDataFrame([(h,) for _, _, h in levels], "host string")
    found = url_reputation.host_reputation(
        spark.createDataFrame(outcomes, "host string, bad int"), hosts, rules
    ).collect()
    expected = shrunk(levels, rules)
    assert {r.host for r in found} == set(expected)
    for r in found:
        assert (r.mean, r.lower) == pytest.approx(expected[r.host])
    assert any(r.lower > 0.5 for r in found) and any(r.lower < 0.5 for r in found)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p>";</script>
</head><body><nav><ul><li><a href="/a">Menu</a></li><li>Two</li></ul></nav><!-- note <p>no</p> -->
<div class="ad">Buy it now, it is very cheap and good for you and all others.</div>
<div id="cookie-notice"><p>We use cookies to make this site better for everyone who comes here.</p></div>
{article}<aside><p>Other news that is long enough to look like an article, or nearly so.</p></aside>
<section class="comments"><p>Great article, I read all of it and will come back for more.</p></section>
<form><p>Sign up for our letter, which comes every week and is free of charge.</p><input></form>
<footer>&copy; us</footer></body></html>"""
ARTICLE = """<h1>A &amp; B</h1><p><b>First paragraph, which goes on
  for a while &lt;tag&gt;.<br><p>Second one with <a href="x">a link</a>, also of some length, as it must be.
<p>Tiny.</p><blockquote>And a last one that closes the article with some words to spare.</blockquote>"""
TEXT = """A & B
First paragraph, which goes on for a while <tag>.
Second one with a link, also of some length, as it must be.
Tiny.
And a last one that closes the article with some words to spare."""


@pytest.mark.parametrize("tag", ["article", "main", "div", 'div class="content"', 'article class="post"'])
def test_main_text(tag):
    page = PAGE.format(article=f"<{tag}>{ARTICLE}</{tag.split()[0]}>")
    assert main_text.main_text(page) == TEXT
    assert main_text.main_text(page.replace("</nav>", "")) in (TEXT, "")
    assert main_text.main_text(page[: page.index("<aside>")]) == TEXT


def test_containers_do_not_decide_alone():
    body = "".join(f"<p>Paragraph {i} of the text, which is long enough to be one by itself.</p>" for i in range(9))
    cards = '<article><h2>More</h2><p>Short teaser.</p></article><article><a href="x">Another, in a link</a></article>'
    found = main_text.main_text(f"<body><div>{body}</div>{cards}</body>")
    assert found.split("\n") == [f"Paragraph {i} of the text, which is long enough to be one by itself." for i in range(9)]
    both = main_text.main_text(f"<body><div>Our site</div><article><h1>T</h1>{body}<p>End.</p></article></body>")
    assert both.split("\n") == ["T", *found.split("\n"), "End."]
    assert main_text.main_text('<nav>Menu</nav><main><a href="x">All in a link</a></main>') == "All in a link"


@pytest.mark.parametrize(
    "name",
    "comment-list comments-area post-comments related-posts ad-container share-buttons cookie-banner "
    "newsletter-signup socialShare js-comment_item entry__related".split(),
)
def test_compound_classes_in_articles(name):
    text = "A long paragraph of the article, which goes on for a good while and says a lot. " * 3
    page = (
        f"<article><h1>Title</h1><p>{text}</p><div class='x {name}'><p>Not this, said a reader.</p>"
        f"<div class='inner'><p>Nor this.</p></div></div><p>{text}</p></article>"
    )
    assert main_text.main_text(page) == "\n".join(["Title", text.strip(), text.strip()])


@pytest.mark.parametrize("name", ["no-sidebar", "has-ads", "with_menu", "sidebar-layout", "page-widget"])
def test_names_of_a_layout_do_not_drop_the_text(name):
    text = "A long paragraph of the article, which goes on for a good while and says a lot. " * 3
    page = (
        f"<article><h1>Title</h1><div class='{name}'><p>{text}</p><nav>menu</nav>"
        f"<div class='comments'><p>a reader</p></div><p>{text}</p></div></article>"
    )
    assert main_text.main_text(page) == "\n".join(["Title", text.strip(), text.strip()])


def test_short_blocks_stay_with_their_text():
    long = "A paragraph that is long enough to be the text of a page by itself, and then some more of it."
    wrapped = ["A title", "By someone", "1 May", long, "A cell", "Another cell", long, "The end."]
    for block in ("<div><p>{}</p></div>", "<p>{}</p>", "<table><tr><td><div>{}</div></td></tr></table>"):
        page = "".join(block.format(text) for text in wrapped)
        assert main_text.main_text(f"<body><div>{page}</div></body>").split("\n") == wrapped
    kept = '<h2 id="social-security">Social</h2><p id="search">One</p><div id="comment-on-ads">Two</div>'
    kept += '<div class="navigation-systems">Three</div>'
    page = f'<article><p>{long}</p>{kept}<div class="box related">No</div><section role="search">No</section></article>'
    assert main_text.main_text(page).split("\n") == [long, "Social", "One", "Two", "Three"]


def test_broken_pages():
    for page in (None, "", "   ", "<p>", "<!-- open <p>x</p>", "<script>x", "<a <b \"> '", "<" * 2000):
        assert isinstance(main_text.main_text(page), str)
    assert main_text.main_text("just text, no markup, nothing") == "just text, no markup, nothing"
    assert main_text.main_text("<article><p>short</article>") == "short"


def test_extract(spark, pages):
    rows = main_text.extract(pages).collect()
    assert sorted((r.page_id, r.url) for r in rows if r.page_id) == sorted(
        (r.page_id, r.url) for r in pages.collect() if r.page_id
    )
    by_id = {r.page_id: r for r in rows}
    assert by_id[3].text == "" and by_id[4].n_chars == 0 and by_id[9].text == "<b>"
    assert by_id[6].n_chars == len(" ".join(["long text"] * 6_000))
    assert main_text.extract(pages.limit(0)).count() == 0


def best(rows, k):
    """The k best of all, by comparing all with all."""
    out = []
    whole = [
        (n, i, [int(np.floor(np.float64(x) * 256)) for x in v])
        for n, (i, v) in enumerate(rows)
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    for n, i, v in whole:
        if i % 5 == 0:
            scores = [
                (-sum(a * b for a, b in zip(v, w, strict=True)), j)
                for m, j, w in whole
                if m != n and len(w) == len(v)
            ]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("rules", [{}, {"shard": 16, "leaf": 2, "block": 3}, {"shard": 40, "k": 70}])
def test_top_k(spark, rules):
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(i, [rng.choice([0.5, -0.5]) for _ in range(6)]) for i in range(150, 200)]  # ties
    rows += [(5, rows[5][1]), (5, rows[5][1]), (201, [0.0] * 6), (205, [1.0, 2.0]), (206, [3.0, 1.0])]
    rows += [(210, None), (215, []), (220, [1.0, None]), (225, [float("nan")] * 6), (None, [1.0] * 6)]
    rows += [(230, [float("inf")] + [0.0] * 5), (235, [1.0] * 3)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, row int, shard int")
    rules = vector_search.SearchRules(**rules)
    found = vector_search.top_k(df.repartition(3), F.col("vec_id") % 5 == 0, rules)
    assert sorted(tuple(r) for r in found.collect()) == best(rows, rules.k)
    assert vector_search.top_k(df.limit(0), F.col("vec_id") % 5 == 0, rules).count() == 0


def test_large_components_stay_exact():
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.normal(size=(60, 4)) * 2.0**40)
    tree = vector_search.build(np.arange(60), np.arange(60), vectors, 4)
    block = {"rows": np.arange(60).tobytes(), "ids": np.arange(60).tobytes(), "vectors": vectors.tobytes(), "known": None}
    found = {}
    for query, _, score, vec_id, _ in vector_search.search_block(tree, block, 3):
        found.setdefault(query, []).append((-score, vec_id))
    for i in range(60):
        scores = sorted(
            (-vector_search._whole(vectors[i], vectors[j]), j) for j in range(60) if j != i
        )
        assert sorted(found[i]) == scores[:3]


def test_trees_prune():
    """A box that cannot reach the k-th score is never opened."""
    vectors = np.concatenate([np.full((500, 2), 1.0), np.full((500, 2), -100.0), np.full((5, 2), 90.0)])
    vectors += np.arange(1005)[:, None] % 7
    tree = vector_search.build(np.arange(1005), np.arange(1005), vectors, 8)
    query = np.array([1.0, 1.0])
    bounds = np.maximum(query, 0) @ tree.high.T + np.minimum(query, 0) @ tree.low.T

    class Counted(np.ndarray):
        opened = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Counted.opened += 1
            return super().__getitem__(key)

    tree.vectors = tree.vectors.view(Counted)
    vector_search.search(tree, query, -1, bounds, -np.inf, 5, True)
    assert Counted.opened < 6
