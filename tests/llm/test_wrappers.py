import functools
import random
import time

import pytest

from medalake.llm import wrappers

SCHEMA = "page_id bigint, url string, html string"


def page(body, k=0):
    return f"<html><head><title>t{k}</title><style>p{{}}</style></head><body>{body}</body></html>"


def alone(html):
    keys, texts = wrappers.read_page(html)
    return wrappers.extract(keys, texts, wrappers.page_items(keys, [None] * len(texts)), 1)


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<article><p>a&nbsp;b\n c<br>d</article>", "a b c\nd"),
    ("<nav>n</nav><article><h1>T</h1><p>1<p>2<div class='share-bar'>s</div></article><footer>f", "T\n1\n2"),
    ("<article>a<aside>x</aside>b<form><p>y</p></form></article>", "a\nb"),
    ("<main><p>m</p><section id=comments><article class=comment>c</article></section></main>", "m"),
    ("<body><header>h</header><p>one <b>bold</b> end</p><div class='cookie-notice'>x</div>tail", "one bold end\ntail"),
    ("<article>5 &lt; 6 &amp;amp; &copy; &#233; <!-- x --> y <script>var a='</p>'</script>z</article>", "5 < 6 &amp; © é y z"),
    ("<article>cut <p>off</article", "cut\noff"), ("<article>a<!-- never ends", "a"),
    ("<div hidden>h</div><div style='display: none'>n</div><p>v</p>", "v"),
    ("<article><div class='post-content with-sidebar'>kept</div></article>", "kept"),
    ("<ARTICLE><P>UP</P></ARTICLE>", "UP"), ("<article>" + "<p>x</p>" * 500 + "</article>", "\n".join(["x"] * 500)),
    ("<article>1 < 2 <3 <</article>", "1 < 2 <3 <"),
])
def test_one_page(html, text):
    assert alone(html) == text


def test_wrapper_of_a_host():
    """Texts that differ become slots, runs groups, and what some pages lack optional."""
    def items(html):
        keys, texts = wrappers.read_page(html)
        return wrappers.page_items(keys, texts)

    a = items("<div>Site</div><ul><li>x</li><li>y</li></ul><p>one</p><h2>extra</h2>")
    b = items("<div>Site</div><ul><li>z</li></ul><p>two</p>")
    got = {(x.key.replace("\x1f", " "), x.optional, x.text) for x in wrappers.align(a, b)}
    assert ("(li #b /li)+", False, None) in got
    assert ("#b", False, "Site") in got and ("#b", False, None) in got
    assert ("h2", True, None) in got and ("#b", True, "extra") in got


def test_constant_texts_of_a_host_are_not_content(spark, frame):
    rows = [
        (i, "http://h/", page(f"<div>My site</div><p>story {i}</p><div>Call us</div>", i))
        for i in range(5)
    ]
    rows += [(10, "http://one/", page("<div>All</div><p>alone</p>")), (None, None, None),
             (11, "nonsense", ""), (10, "http://one/", page("<div>All</div><p>alone</p>")),
             (12, "HTTP://user@H:80/x", page("<div>My site</div><p>other port</p><div>Call us</div>"))]
    got = sorted(map(tuple, wrappers.main_text(frame(rows, SCHEMA)).collect()), key=repr)
    want = [(i, "http://h/", f"story {i}") for i in range(5)]
    want += [(10, "http://one/", "All\nalone")] * 2 + [(None, None, ""), (11, "nonsense", "")]
    want += [(12, "HTTP://user@H:80/x", "other port")]
    assert got == sorted(want, key=repr)


def test_wrappers_meet_pages_in_a_join_beyond_the_bound(frame, monkeypatch):
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 0)
    rows = [(i, f"http://h{i % 3}/", page(f"<article>{i}</article>")) for i in range(20)]
    got = wrappers.main_text(frame(rows, SCHEMA)).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(i, str(i)) for i in range(20)]


def test_empty_table(frame):
    assert wrappers.main_text(frame([], SCHEMA)).count() == 0


def texts_of(frame, rows):
    return {r.page_id: r.text for r in wrappers.main_text(frame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize("part", ["article", "main"])
def test_constant_texts_in_an_article_are_not_content(frame, part):
    """A notice of its own markup and one among the paragraphs, neither of a listed class."""
    body = "<{0}><h1>T{1}</h1><p>Read us</p><p>a{1}</p><p>b{1}</p><div class=z>Buy</div><p>c{1}</p></{0}>"
    rows = [(i, "http://h/", page(body.format(part, i))) for i in range(4)]
    rows += [(10, "http://two/", page(body.format(part, 0))), (11, "http://two/", page(body.format(part, 1)))]
    got = texts_of(frame, rows)
    assert [got[i] for i in range(4)] == [f"T{i}\na{i}\nb{i}\nc{i}" for i in range(4)]
    assert got[10] == "T0\nRead us\na0\nb0\nBuy\nc0"


def test_another_wrapper_gives_another_text():
    def whole(notice):
        streams = [wrappers.read_page(f"<article><p>{i}</p><div>{notice}</div></article>") for i in range(3)]
        return wrappers._merged([(wrappers.page_wrapper(*s), 1) for s in streams])

    keys, texts = wrappers.read_page("<article><p>x</p><div>Buy</div></article>")
    assert wrappers.extract(keys, texts, *whole("Buy")) == "x"
    assert wrappers.extract(keys, texts, *whole("Sell")) == "x\nBuy"


def test_copies_of_a_page_keep_their_text(frame):
    long = page("<article><h1>L</h1><p>one</p><h2>x</h2><ul><li>y</li></ul></article>")
    rows = [(i, "http://h/", long) for i in range(5)]
    rows += [(5 + i, "http://h/", page(f"<article><h1>{i}</h1><p>{i}</p></article>")) for i in range(3)]
    got = texts_of(frame, rows)
    assert {got[i] for i in range(5)} == {"L\none\nx\ny"} and got[6] == "1\n1"


def test_a_text_of_one_page_stays(frame):
    bodies = ["<p>a0</p><h2>extra</h2><p>b0</p><div>Call us</div>"]
    bodies += [f"<p>a{i}</p><p>b{i}</p><div>Call us</div>" for i in (1, 2)]
    got = texts_of(frame, [(i, "http://h/", page(b)) for i, b in enumerate(bodies)])
    assert got == {0: "a0\nextra\nb0", 1: "a1\nb1", 2: "a2\nb2"}


def test_texts_of_a_host_beyond_the_bound_of_positions(monkeypatch):
    monkeypatch.setattr(wrappers, "MAX_ITEMS", 10)
    tags = ["h1", "p", "h2", "div", "h3", "pre", "h4", "section", "h5", "blockquote"]
    def body(i):
        parts = "".join(f"<{t}>{t}{i}</{t}>" for t in tags)
        return page(parts + (f"<ul>u{i}</ul>" if i % 2 else "<ol>o</ol>") + "<h6>Call us</h6>")

    def items(i):
        return wrappers.page_wrapper(*wrappers.read_page(body(i)))

    whole, pages = wrappers._merged([(items(i), 1) for i in range(4)])
    got = wrappers.extract(*wrappers.read_page(body(1)), whole, pages)
    assert got == "\n".join([f"{t}1" for t in tags] + ["u1"])


def test_a_heading_of_a_section_stays(frame):
    body = (
        "<article><h1>T{0}</h1><h2>Summary</h2><p>a{0}</p><h2>Read us</h2><p>every day</p><h2>Facts</h2>"
        "<h3>Size</h3><p>{0}</p><dl><dt>By</dt><dt>With</dt><dd>n{0}</dd></dl><h2>End</h2></article>"
    )
    got = texts_of(frame, [(i, "http://h/", page(body.format(i))) for i in range(4)])
    assert got[1] == "T1\nSummary\na1\nFacts\nSize\n1\nBy\nWith\nn1"


def odd_pages(n):
    """Pages of one host in many structures, some of them copies."""
    rng = random.Random(4)
    parts = ["<h2>More</h2>", "<div>Buy</div>", "<ul><li>x{0}</li></ul>", "<p>p{0}</p>", "<pre>Call</pre>",
             "<blockquote>q{0}</blockquote>", "<ol><li>a</li><li>b{0}</li></ol>"]
    bodies = []
    for i in range(n):
        some = "".join(rng.choices(parts, k=rng.randrange(1, 9))).format(i % 17)
        bodies.append(page(f"<article><h1>T{i % 17}</h1><div>Buy</div>{some}<p>Read us</p></article>"))
    return [(i, "http://h/", b) for i, b in enumerate(bodies)]


def test_tasks_and_batches_decide_nothing(spark, frame):
    rows = odd_pages(150) + [(1000 + i, f"http://g{i % 2}/", r[2]) for i, r in enumerate(odd_pages(9))]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(size), []
    try:
        for tasks, batch, order in ((1, 10_000, 1), (7, 10_000, -1), (40, 3, 1)):
            spark.conf.set(size, batch)
            df = frame(rows[::order], SCHEMA).repartition(tasks)
            seen.append({r.page_id: r.text for r in wrappers.main_text(df).collect()})
    finally:
        spark.conf.set(size, before)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == len(rows)


def test_pages_of_one_structure_meet_in_any_order():
    items = [wrappers.page_wrapper(*wrappers.read_page(f"<p>{i % 5}</p><ul><li>a<li>{i}</ul>")) for i in range(9)]
    one = functools.reduce(wrappers._met, items)
    other = functools.reduce(wrappers._met, items[4:][::-1])
    assert wrappers._dump(one, 9) == wrappers._dump(wrappers._met(other, functools.reduce(wrappers._met, items[:4])), 9)


def test_long_streams_align_by_numbered_keys(monkeypatch):
    rng = random.Random(6)
    for full in (0, wrappers.FULL_PRODUCT):
        monkeypatch.setattr(wrappers, "FULL_PRODUCT", full)
        for _ in range(200):
            a, b = ([wrappers.Item(rng.choice("abcd#")) for _ in range(rng.randrange(12))] for _ in "ab")
            pairs = list(wrappers._pairs(a, b))
            assert [p for p, _ in pairs if p] == a and [q for _, q in pairs if q] == b
            assert all(p.key == q.key for p, q in pairs if p and q)


def test_long_broken_pages_take_time_in_proportion():
    tags = ["h3", "p", "div", "pre", "h4", "section", "blockquote", "li"]
    rng = random.Random(7)

    def long():
        return "<div>" * 20_000 + "</article>" * 20_000 + "".join(
            f"<{t}>{i}</{t}>" for i, t in enumerate(rng.choices(tags, k=20_000))
        )

    began = time.monotonic()
    a, b = (wrappers.page_wrapper(*wrappers.read_page(long())) for _ in range(2))
    whole = wrappers.align(a, b)
    assert len(whole) >= wrappers.MAX_ITEMS / 2 and time.monotonic() - began < 20


def test_texts_at_positions_that_were_let_go_are_counted(frame):
    rng = random.Random(12)
    tags = ["h2", "div", "h3", "pre", "h4", "section", "h5", "blockquote"]
    rows, want = [], {}
    for structure in range(90):
        notices = rng.choices(tags, k=60)
        for copy in range(3):
            i = 3 * structure + copy
            parts = [f"<{t}>always {t}</{t}>" for t in notices]
            parts[20:20] = [f"<p>first {i}</p>"]
            rows.append((i, "http://h/", page("".join(parts) + f"<p>last {i}</p>")))
            want[i] = f"first {i}\nlast {i}"
    rows += [(1000 + i, f"http://g{i}/", rows[i][2]) for i in range(2)] + [(2000, "http://h/", rows[0][2])]
    read = [wrappers.page_wrapper(*wrappers.read_page(r[2])) for r in rows[:270]]
    whole, _ = wrappers._merged([(w, 3) for w in read[::3]])
    assert whole.cut and wrappers._load(wrappers._dump(whole, 270))[0].cut
    got = texts_of(frame, rows)
    assert {i: got[i] for i in want} == want and got[2000] == want[0]
    # A host of one page keeps all.
    assert got[1000].count("always") == 60
