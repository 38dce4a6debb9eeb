"""Main text of web pages by union-free wrappers.

A page is a stream of structural tags and texts. Streams of one host are aligned one after another
into a wrapper, a regular expression without alternatives: runs of equal parts become repeated
groups, parts that some pages lack become optional, and texts that differ become slots. Tags and
names say which part of a page may be content (article, main part or body); in that part the
wrapper decides: a text that never changes where it stands is the host's own and left out, but for
headings of a section that is not.

Wrappers depend on the set of pages alone, not on how tasks share them: pages of one structure meet
position by position in any order, and different structures are aligned in an order of their own.
A wrapper that grew too long is cut; what stands where on its host is then counted over all pages.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from hashlib import md5
from html import unescape
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from medalake.llm.common import stage, table

# How HTML elements and usual names mark parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp".split())
LEFT_OUT = frozenset(
    "head nav header footer aside form button select dialog menu object canvas audio video".split()
)
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense adbox sponsor sponsored promo promotion banner "
    "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs header masthead footer "
    "comment comments respond discussion disqus reply replies cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations widget pagination pager toolbar copyright "
    "disclaimer search skip".split()
)
# An element with one of these names too is left out only for what is never content.
CONTENT_NAMES = frozenset("content article post entry story main body text".split())
NEVER_CONTENT = frozenset(
    "ad ads advert adverts advertisement comment comments sponsor sponsored cookie".split()
)
LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog form menu menubar".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[a-zA-Z/][^>]*\Z|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(
    r"([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
PERIOD = 12
FOLDS = 3
# Positions of a wrapper beyond which optional ones are let go and the host's texts are counted.
MAX_ITEMS = 2_000
# Stretches that differ are compared in full up to this product of lengths, beyond by numbered keys.
FULL_PRODUCT = 22_500
# From so many different pages on, a text that never changes is the host's own, not an article's.
MIN_PAGES = 3
# So many wrappers of a host are aligned by one task, which holds so many positions at most.
FAN_IN = 32
HELD_ITEMS = 200_000
# Headings by level; names of rows and terms come last and may stand side by side.
HEADINGS = {"h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6, "caption": 7, "dt": 7, "th": 7}
BROADCAST_BYTES = 32 << 20


def _attributes(rest: str) -> dict[str, str]:
    return {
        name.lower(): a or b or c for name, a, b, c in ATTRIBUTE.findall(rest)
    } if "=" in rest or "hidden" in rest else {}


def _names(attributes: dict[str, str]) -> set[str]:
    value = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    return set(re.findall(r"[a-z]+", value))


def _role(name: str, attributes: dict[str, str]) -> str:
    """``x`` for a part that is never content, ``c`` for one that holds the article, or nothing."""
    if name in LEFT_OUT:
        return "x"
    names = _names(attributes)
    if name == "article":
        return "x" if names & NEVER_CONTENT else "c"
    if name in ("html", "body"):
        return ""
    role = attributes.get("role", "").lower()
    style = attributes.get("style", "").replace(" ", "").lower()
    if (
        role in LEFT_OUT_ROLES or "hidden" in attributes or "display:none" in style
        or attributes.get("aria-hidden") == "true"
    ):
        return "x"
    out = names & LEFT_OUT_NAMES
    if out and (out & NEVER_CONTENT or not names & CONTENT_NAMES) and name != "main":
        return "x"
    if name == "main" or role == "main" or attributes.get("itemprop") == "articleBody":
        return "m"
    return ""


def read_page(html: str | None) -> tuple[list[str], list[str]]:
    """Keys of the page's stream and the texts among them.

    A key is a structural tag, or ``#`` with where the text stands: ``#c`` in an
    article, ``#m`` in a main part, ``#b`` elsewhere in the body. What is never content has no
    texts. Each text is one block: decoded, white space as single spaces, trimmed, not empty.
    """
    keys: list[str] = []
    texts: list[str] = []
    stack: list[tuple[str, str]] = []
    depth: Counter[str] = Counter()
    state, pieces = "b", []

    def end_block() -> None:
        if pieces:
            raw = "".join(pieces)
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            pieces.clear()
            if text:
                keys.append("#" + state)
                texts.append(text)

    html, at = html or "", 0
    while at < len(html):
        token = TOKEN.match(html, at)
        at = token.end()
        name = token["name"]
        if name is None:
            if state != "x" and (html[token.start()] != "<" or at - token.start() == 1):
                pieces.append(token[0])
            continue
        name = name.lower()
        if not token["close"] and name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = close.end() if close else len(html)
            continue
        structural = name in BLOCK
        if structural:
            end_block()
        if token["close"]:
            if depth[name]:
                # Only elements that close here are looked at, so stray end tags cost nothing.
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                if any(s[1] != stack[k][1] for s in stack[k:]):
                    end_block()
                state = stack[k][1]
                depth.subtract(s[0] for s in stack[k:])
                del stack[k:]
            if structural and state != "x":
                keys.append("/" + name)
            continue
        attributes = _attributes(token["rest"])
        role = _role(name, attributes)
        before = state
        if name not in VOID and not token["rest"].endswith("/"):
            if name in ("p", "li") and stack and stack[-1][0] == name:
                state = before = stack.pop()[1]
                depth[name] -= 1
            stack.append((name, before))
            depth[name] += 1
            if role and state != "x" and not (state == "c" and role == "m"):
                if role != state:
                    end_block()
                state = role
        if structural and before != "x":
            keys.append(name + ("!" if state == "x" else ""))
    end_block()
    return keys, texts


class Item:
    """A position of a wrapper: a tag, a text or a repeated group.

    ``text`` is what all its pages have there, ``inside`` what all have in a group (sorted), and
    ``seen`` the least fingerprints, up to ``MIN_PAGES``, of different pages among them, so that
    copies of one page count as one. Positions meet in any order with one outcome.
    """

    __slots__ = ("key", "optional", "text", "pages", "inside", "seen")

    def __init__(self, key, optional=False, text=None, pages=1, inside=(), seen=()):
        self.key, self.optional, self.text = key, optional, text
        self.pages, self.inside, self.seen = pages, inside, seen

    def meet(self, other: Item) -> Item:
        """The position that stands for both."""
        inside = self.inside
        if inside != other.inside:
            inside = tuple(sorted(set(inside) & set(other.inside)))
        seen = self.seen
        if seen != other.seen:
            seen = tuple(sorted({*seen, *other.seen})[:MIN_PAGES])
        return Item(
            self.key, self.optional or other.optional,
            self.text if self.text == other.text else None, self.pages + other.pages, inside, seen,
        )


class Wrapper(list):
    """Positions in their order; ``cut`` tells that some were let go."""

    cut = False


def _fold(items: list[Item]) -> list[Item]:
    """Replace runs of equal neighbouring parts by repeated groups, inner ones first."""
    for _ in range(FOLDS):
        keys, out, i, n = [x.key for x in items], [], 0, len(items)
        while i < n:
            for size in range(1, min(PERIOD, (n - i) // 2) + 1):
                if keys[i] == keys[i + size] and keys[i : i + size] == keys[i + size : i + 2 * size]:
                    end = i + 2 * size
                    while keys[i : i + size] == keys[end : end + size]:
                        end += size
                    out.append(_group(items[i:end], size))
                    i = end
                    break
            else:
                out.append(items[i])
                i += 1
        if len(out) == n:
            return out
        items = out
    return items


def _inside(items: list[Item]) -> tuple:
    marks = {k for x in items for k in (x.inside or ((x.text,) if x.key[0] == "#" else ()))}
    return tuple(sorted(marks - {None}))


def _group(items: list[Item], size: int) -> Item:
    body = "\x1f".join(x.key for x in items[:size])
    inside = _inside(items)
    seen = min((x.seen for x in items), key=len)
    return Item(
        f"({body})+", any(x.optional for x in items), None, min(x.pages for x in items), inside, seen
    )


def _absorb(items: list[Item], others: list[Item]) -> list[Item]:
    """Single parts that the other stream repeats become groups too."""
    bodies = {x.key: x.key[1:-2].split("\x1f") for x in others if x.key[0] == "("}
    bodies = {k: b for k, b in bodies.items() if "(" not in k[1:]}
    here = {x.key for x in items}
    for key, body in bodies.items():
        if key not in here and not here.issuperset(body):
            continue
        keys, out, i = [x.key for x in items], [], 0
        while i < len(items):
            if keys[i] == body[0] and keys[i : i + len(body)] == body:
                out.append(_group(items[i : i + len(body)], len(body)))
                i += len(body)
            elif keys[i] == key and out and out[-1].key == key:
                a, b = out[-1], items[i]
                out[-1] = Item(
                    key, a.optional or b.optional, None, min(a.pages, b.pages),
                    _inside([a, b]), min(a.seen, b.seen, key=len),
                )
                i += 1
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _numbered(keys: list[str]) -> dict[tuple, int]:
    """Where each key stands, by its number among equal ones; a text goes with the tag before it."""
    count: Counter[tuple] = Counter()
    places = {}
    for i, key in enumerate(keys):
        name = (keys[i - 1] if i and key[0] == "#" else "", key)
        count[name] += 1
        places[(*name, count[name])] = i
    return places


def _matches(x: list[str], y: list[str]) -> list[tuple[int, int, int]]:
    """Stretches that both have: where in each, and how long.

    Long stretches that differ would take the square of their length to compare in full; there the
    longest ascending chain of equal numbered keys is the match.
    """
    if len(x) * len(y) <= FULL_PRODUCT:
        return SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()[:-1]
    places = _numbered(y)
    both = [(i, places[k]) for k, i in _numbered(x).items() if k in places]
    ends, last, before = [], [], []
    for n, (_, j) in enumerate(both):
        k = bisect_left(ends, j)
        before.append(last[k - 1] if k else -1)
        ends[k : k + 1], last[k : k + 1] = [j], [n]
    chain, n = [], last[-1] if last else -1
    while n >= 0:
        chain.append((*both[n], 1))
        n = before[n]
    return chain[::-1]


def _pairs(a: list[Item], b: list[Item]) -> Iterator[tuple[Item | None, Item | None]]:
    """Alignment of two streams by their keys: pairs, one side missing where they differ."""
    x, y = [i.key for i in a], [i.key for i in b]
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        yield a[head], b[head]
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    x, y = x[head : len(x) - tail], y[head : len(y) - tail]
    at, to = head, head
    for i, k, n in [*_matches(x, y), (len(x), len(y), 0)]:
        yield from ((p, None) for p in a[at : head + i])
        yield from ((None, q) for q in b[to : head + k])
        at, to = head + i + n, head + k + n
        yield from zip(a[head + i : at], b[head + k : to])
    if tail:
        yield from zip(a[-tail:], b[-tail:])


def align(a: list[Item], b: list[Item]) -> Wrapper:
    """The wrapper that matches what both match.

    Beyond ``MAX_ITEMS`` positions, optional ones are let go, first those that hold no text, which
    leave out nothing, then those of the fewest pages, and the wrapper is marked as cut: it is then
    the frame by which ``own_texts`` counts the texts of all pages, at positions let go too. What
    all pages have is never let go, however long the pages are.
    """
    out = Wrapper()
    out.cut = getattr(a, "cut", False) or getattr(b, "cut", False)
    a, b = _absorb(a, b), _absorb(b, a)
    for p, q in _pairs(a, b):
        if p is None or q is None:
            one = p or q
            out.append(Item(one.key, True, one.text, one.pages, one.inside, one.seen))
        else:
            out.append(p.meet(q))
    if len(out) > MAX_ITEMS:
        # A text without a position counts as a slot.
        def weight(x: Item) -> tuple[bool, int]:
            return x.text is not None or bool(x.inside), x.pages

        least = sorted(map(weight, out), reverse=True)[MAX_ITEMS - 1]
        out[:] = [x for x in out if weight(x) > least or not x.optional]
        out.cut = True
    return out


def page_items(keys: list[str], marks: list, seen: tuple = ()) -> list[Item]:
    """A page as a wrapper of its own; ``marks`` stand for its texts."""
    mark = iter(marks)
    return _fold([
        Item(k, False, next(mark) if k[0] == "#" else None, 1, (), seen) for k in keys
    ])


def page_wrapper(keys: list[str], texts: list[str]) -> list[Item]:
    """A page as a wrapper of its own, with its texts' checksums and its fingerprint."""
    marks = [crc32(t.encode()) for t in texts]
    return page_items(keys, marks, (crc32(repr((keys, marks)).encode()),))


def _dump(wrapper: list[Item], pages: int) -> str:
    return json.dumps([
        pages,
        [[x.key, int(x.optional), x.text, x.pages, x.inside, x.seen] for x in wrapper],
        *([1] if getattr(wrapper, "cut", False) else []),
    ], separators=(",", ":"))


# How the stored form of a wrapper that is cut ends.
CUT = ",1]"


def _load(text: str) -> tuple[Wrapper, int]:
    pages, items, *cut = json.loads(text)
    wrapper = Wrapper(Item(k, bool(o), t, n, tuple(i), tuple(s)) for k, o, t, n, i, s in items)
    wrapper.cut = bool(cut)
    return wrapper, pages


WRAPPER_SCHEMA = "host string, wrapper string"
SHAPE_SCHEMA = "host string, shape binary, wrapper string"


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.binary() if n == "shape" else pa.string() for n in names]
    columns = zip(*rows) if rows else ([] for _ in names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: one wrapper for each host and folded structure among its pages."""
    held: dict[tuple, tuple[list[Item], int]] = {}
    positions = 0

    def out() -> pa.RecordBatch:
        rows = [(*key, _dump(*one)) for key, one in held.items()]
        return _batch(rows, ["host", "shape", "wrapper"])

    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            items = page_wrapper(*read_page(html.as_py()))
            key = host, md5("\x1e".join([x.key for x in items]).encode()).digest()
            if key in held:
                wrapper, pages = held[key]
                held[key] = _met(wrapper, items), pages + 1
                continue
            held[key] = items, 1
            positions += len(items)
            if positions > HELD_ITEMS:
                yield out()
                held.clear()
                positions = 0
    yield out()


def _met(a: list[Item], b: list[Item]) -> list[Item]:
    return [p.meet(q) for p, q in zip(a, b, strict=True)]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One host's pages of one structure, position by position."""
    whole, pages, first = [], 0, None
    for batch in batches:
        for row in batch.select(["host", "shape", "wrapper"]).to_pylist():
            one, n = _load(row["wrapper"])
            first = first or (row["host"], row["shape"])
            whole, pages = (_met(whole, one) if pages else one), pages + n
    yield _batch([(*first, _dump(whole, pages))], ["host", "shape", "wrapper"])


def _merged(wrappers: list[tuple[list[Item], int]]) -> tuple[list[Item], int]:
    """Align wrappers one after another, those of more pages first; their order does not matter."""
    wrappers = sorted(wrappers, key=lambda w: (-w[1], [x.key for x in w[0]], _dump(*w)))
    whole, pages = wrappers[0]
    for one, n in wrappers[1:]:
        whole, pages = align(whole, one), pages + n
    return whole, pages


def _merge(data: pa.Table) -> pa.Table:
    merged = _dump(*_merged([_load(w) for w in data.column("wrapper").to_pylist()]))
    return pa.table({"host": data.column("host").slice(0, 1), "wrapper": [merged]})


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of too few pages are slots in a host's wrapper."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            whole, pages = _load(row["wrapper"])
            for x in whole:
                if len(x.seen) < MIN_PAGES or not (x.inside or x.text is not None):
                    x.text, x.inside, x.seen = None, (), ()
            rows.append((row["host"], _dump(whole, pages)))
        yield _batch(rows, ["host", "wrapper"])


def _host_of(url):
    return F.lower(F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1
    ))


def infer_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host`` and its ``wrapper`` (JSON: number of pages, then positions as key, optional, text's
    checksum or null for a slot, pages, a group's checksums, fingerprints) over all pages.

    Each task reduces its pages to one wrapper per host and structure. Those of one structure meet,
    first for neighbouring tasks, then for the host. A host's structures are then aligned in groups
    of about ``FAN_IN`` by the hash of their wrappers, round by round, until one is left: a host that
    holds a third of all pages meets in many tasks, and neither tasks nor batches decide the outcome.
    """
    shapes = pages.select(_host_of(F.col(url)).alias("host"), F.col(html).alias("html")).mapInArrow(
        _shapes, SHAPE_SCHEMA
    ).withColumn("part", F.floor(F.spark_partition_id() / FAN_IN))
    some = shapes.groupBy("host", "shape", "part").applyInArrow(_meet, SHAPE_SCHEMA)
    parts = some.groupBy("host", "shape").applyInArrow(_meet, SHAPE_SCHEMA)
    parts = stage(parts.select("host", "wrapper"))
    while True:
        counts = parts.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if counts.isEmpty():
            return parts.mapInArrow(_finish, WRAPPER_SCHEMA)
        group = F.pmod(F.xxhash64("wrapper"), F.ceil(F.coalesce("n", F.lit(1)) / FAN_IN))
        parts = stage(
            parts.join(counts, "host", "left").select("host", "wrapper", group.alias("group"))
            .groupBy("host", "group")
            .applyInArrow(lambda t: _merge(t.select(["host", "wrapper"])), WRAPPER_SCHEMA)
        )


def _sections(keys: list[str], chosen: list[int], own: set[int]) -> set[int]:
    """Headings among the host's own texts whose section holds a text that is not."""
    level, k = {}, 0
    for i, key in enumerate(keys):
        if key[0] == "#":
            level[k] = HEADINGS.get(keys[i - 1] if i else "", 0)
            k += 1
    kept, below = set(), None
    for i in reversed(chosen):
        if not level[i]:
            below = below if i in own else 9
        elif i not in own or below is not None and (below > level[i] or below == level[i] == 7):
            kept.add(i)
            below = level[i]
    return kept


def _placed(keys: list[str], texts: list[str], wrapper: list[Item]) -> Iterator[tuple]:
    """The page's texts where they stand, as positions with the numbers of their texts. A position
    is one of the wrapper, or a key's number among equal ones since the last of the wrapper."""
    items = _absorb(page_items(keys, list(range(len(texts)))), wrapper)
    at, tag, since = -1, "", Counter(last=-1)
    for position, item in _pairs(wrapper, items):
        at += position is not None
        if item is None:
            continue
        marks = item.inside or (() if item.text is None else (item.text,))
        if position is not None:
            since, place = Counter(last=at), (at,)
        else:
            name = tag if item.key[0] == "#" else "", item.key
            since[name] += 1
            place = (since["last"], *name, since[name])
        tag = item.key
        if marks:
            yield place, marks


def _code(place: tuple) -> int:
    return int.from_bytes(md5(repr(place).encode()).digest()[:8], "little", signed=True)


def extract(
    keys: list[str], texts: list[str], wrapper: list[Item], pages: int,
    counted: set[tuple[int, int]] | None = None,
) -> str:
    """The blocks of one page that stand at content positions of its wrapper.

    Candidates are the blocks of the page's articles, without one those of its main part, without
    that all of the body. Those are left out whose text is the one that all pages have at their
    position, if these are ``MIN_PAGES`` different pages or more; if that leaves none, all stay. In
    an article or main part a heading below the first level stays if a text of its section does.
    ``counted`` are the positions and checksums of these texts as ``own_texts`` found them, for a
    wrapper that is cut; else the wrapper tells.
    """
    where = [k for k in keys if k[0] == "#"]
    part = next((p for p in ("#c", "#m") if p in where), "#b")
    own: set[int] = set()
    if counted is not None:
        for place, marks in _placed(keys, texts, wrapper) if counted else ():
            code = _code(place)
            own.update(i for i in marks if (code, crc32(texts[i].encode())) in counted)
    elif pages >= MIN_PAGES:
        items = _absorb(page_items(keys, list(range(len(texts)))), wrapper)
        for position, item in _pairs(wrapper, items):
            if position is None or item is None or len(position.seen) < MIN_PAGES:
                continue
            constant = {position.text, *position.inside}
            marks = item.inside or (() if item.text is None else (item.text,))
            own.update(i for i in marks if crc32(texts[i].encode()) in constant)
    chosen = [i for i, k in enumerate(where) if k == part]
    if own and part != "#b":
        own -= _sections(keys, chosen, own)
    return "\n".join(texts[i] for i in [i for i in chosen if i not in own] or chosen)


MARK_SCHEMA = "host string, page string, seen bigint, place bigint, mark bigint, first int"


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the texts of pages by position, one row for each different text at it."""
    names = [f.split()[0] for f in MARK_SCHEMA.split(", ")]
    types = [pa.string(), pa.string(), *[pa.int64()] * 3, pa.int32()]
    known: dict[str, tuple[Wrapper, int]] = {}
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["wrapper"] not in known:
                known = {row["wrapper"]: _load(row["wrapper"])}
            wrapper, _ = known[row["wrapper"]]
            keys, texts = read_page(row["html"])
            sums = [crc32(t.encode()) for t in texts]
            seen = crc32(repr((keys, sums)).encode())
            for place, marks in _placed(keys, texts, wrapper):
                for n, mark in enumerate(sorted({sums[i] for i in marks})):
                    rows.append((row["host"], row["page"], seen, _code(place), mark, int(not n)))
        columns = zip(*rows) if rows else ([] for _ in names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def own_texts(read: DataFrame, wrappers: DataFrame) -> DataFrame:
    """``host``, ``page`` (digest of its html) and ``counted``, the positions and checksums of the
    page's texts that are the host's own, for hosts whose wrappers are cut.

    A text is, if it stands at its position on all pages that have one, and on ``MIN_PAGES``
    different ones. All pages and positions are counted; rows are summed before each shuffle, and
    only what belongs to one page is gathered.
    """
    placed = stage(read.join(wrappers, "host").select("host", "page", "html", "wrapper").mapInArrow(
        _marks, MARK_SCHEMA
    ))
    count = F.count(F.lit(1))
    # Copies of a page count among the pages that have a text, but as one of the different ones.
    texts = (
        placed.groupBy("host", "place", "mark", "seen").agg(count.alias("n"))
        .groupBy("host", "place", "mark").agg(F.sum("n").alias("n"), count.alias("different"))
        .where(F.col("different") >= MIN_PAGES)
    )
    places = placed.where("first = 1").groupBy("host", "place").agg(count.alias("pages"))
    constant = texts.join(places, ["host", "place"]).where("n = pages")
    return (
        placed.join(constant.select("host", "place", "mark"), ["host", "place", "mark"])
        .groupBy("host", "page").agg(F.collect_set(F.struct("place", "mark")).alias("counted"))
    )


PAGE_SCHEMA = "page_id bigint, url string, text string"
# Wrappers that a task keeps at hand, and positions in them.
KEPT_WRAPPERS, KEPT_ITEMS = 256, 256 * MAX_ITEMS


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[Wrapper, int]] = {}
    held = 0
    for batch in batches:
        out = []
        columns = (batch.column(c) for c in ("html", "wrapper", "counted"))
        for html, source, counted in zip(*columns):
            source, counted = source.as_py(), counted.as_py()
            if source not in known:
                if len(known) >= KEPT_WRAPPERS or held >= KEPT_ITEMS:
                    known.clear()
                    held = 0
                known[source] = _load(source)
                held += len(known[source][0])
            wrapper, pages = known[source]
            if wrapper.cut:
                counted = {(x["place"], x["mark"]) for x in counted or ()}
            out.append(extract(*read_page(html.as_py()), wrapper, pages, counted))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())],
            ["page_id", "url", "text"],
        )


def main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Main text of each page.

    Args:
        pages: pages; columns other than those named are left out. Repeated rows each get a row.
        key: integer id, may be null. url: a null one or one without host belongs to the host "".
        html: whole page; a null one is empty. Broken markup never fails: a tag or comment that does
            not end hides the rest, an end tag without its start is ignored.

    Returns ``page_id``, ``url``, ``text`` (empty if there is none). No pages give no rows.

    Wrappers are broadcast while all of them are smaller than ``BROADCAST_BYTES``; beyond, pages and
    wrappers meet in a join on the host, whose hot hosts adaptive execution splits. Pages of hosts
    whose wrappers are cut also meet what ``own_texts`` counted.
    """
    wrappers = stage(infer_wrappers(pages, url, html))
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host")).alias("n")).first()["n"] or 0
    read = pages.select(
        F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"),
        F.col(html).alias("html"), _host_of(F.col(url)).alias("host"),
    )
    joined = read.join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, "host")
    none = F.lit(None).cast("array<struct<place: bigint, mark: bigint>>")
    taken = ["page_id", "url", "html", "wrapper", "counted"]
    cut = F.endswith("wrapper", F.lit(CUT))
    if wrappers.where(cut).isEmpty():
        whole = joined.withColumn("counted", none).select(*taken)
    else:
        digest = F.md5(F.coalesce("html", F.lit("")))
        own = stage(own_texts(read.withColumn("page", digest), wrappers.where(cut)))
        whole = joined.where(~cut).withColumn("counted", none).select(*taken).unionByName(
            joined.where(cut).withColumn("page", digest).join(own, ["host", "page"], "left")
            .select(*taken)
        )
    return whole.mapInArrow(_extract, PAGE_SCHEMA)


def op1_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
