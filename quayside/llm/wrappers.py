"""Main text of web pages by wrappers that are inferred for each host.

A wrapper is a union-free regular expression over a page's elements: elements in order, each required,
optional or repeated, with slots for text. It is inferred by aligning pages of one host one after the
other: neighbours of one kind fold into a repeated group, what one side lacks becomes optional, text
becomes a slot. A slot keeps a page's texts in their order, and whether two pages differed there. Each page
is then matched against its host's wrapper, whose parts say which of the page's text is content: kinds of
elements first, and where they leave it open, what no two pages differ in is furniture.

Pages of a host are first reduced to their skeletons, and equal skeletons to one, so that a host with
any number of pages has few; skeletons are aligned in salted groups, and the groups' wrappers again.
"""

from __future__ import annotations

import bisect
import html
import json
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import replace_columns, slices, with_columns_of, written

#: Groups in which a host's skeletons are aligned before their wrappers are.
SALTS = 32

#: Cells of an alignment's table at the most; longer lists of children are matched greedily, within SKIP places.
CELLS, SKIP = 1 << 18, 64

#: Neighbours of one kind that make a repeated group; fewer keep places of their own.
REPEATS = 3

#: Words that a page's changing text must have, or a block that takes its place.
WORDS = 5

#: Elements nested deeper are flattened; inline ones without marking words earlier, as they are often left open.
DEPTH, INLINE_DEPTH = 400, 64

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
search section summary table tbody td tfoot th thead title tr ul""".split())
#: Which open elements a start tag ends, up to which others.
ENDS: dict[str, tuple[set[str], set[str]]] = {
    **dict.fromkeys((BLOCKS - set("""body caption dd dt html legend li summary tbody td tfoot th thead title tr
figcaption""".split())), ({"p"}, {"button", "td", "th", "table", "caption"})),
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt", "p"}, {"dl"}),
    "dt": ({"dd", "dt", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, set()),
}
#: Inline elements that a block ends where they were left open.
LEFT_OPEN = frozenset("a abbr b bdi bdo big cite code em font i kbd mark q s samp small span strike strong sub sup tt u var".split())

#: Elements that never hold main text.
BOILER_TAGS = frozenset("""applet aside audio button canvas datalist dialog embed footer form head header iframe
input label map menu nav noembed noframes noscript object option script search select style svg template textarea
title video xmp math""".split())
#: Words of classes, ids and roles that mark what is not main text.
BOILER_WORDS = frozenset("""ad ads adbox advert adverts advertisement advertising adsbygoogle alert alerts banner banners
breadcrumb breadcrumbs colophon comment comments consent cookie cookies copyright disclaimer discussion disqus
footer gdpr header hidden login masthead menu menus modal nav navbar navigation newsletter notice notices notification
overlay pager pagination paywall popup promo promoted promotion recommended related replies reply respond search
share sharing sidebar sidebars signup skip skyscraper social sponsor sponsored subscribe subscription tagcloud tags
toc toolbar topbar widget widgets""".split())
#: Words with which an article element is not the page's article.
NO_ARTICLE = frozenset("""ad ads advert advertisement comment comments hidden promo promoted recommended related
reply replies sponsor sponsored""".split())
#: Words of a class or id that says how an element is, or where it is filed, not what it is.
STATE_WORDS = frozenset("""no not non without has have with is category cat tagged format open opened closed enabled
disabled allowed active inactive on off""".split())
#: Words that outweigh BOILER_WORDS beside them.
SURE_WORDS = frozenset("articlebody postbody entrycontent maincontent bodytext".split())
#: Words that mark the main text, and elements that do.
MAIN_WORDS = frozenset("article entry story post main content maincontent articlebody postbody entrycontent bodytext".split())
MAIN_TAGS = frozenset(("article", "main"))

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(>|\Z)""", re.S | re.X)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_SPACE = re.compile(r"\s+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("open" | "close", name, attributes) and ("text", text, "") in page order."""
    at = 0
    n = len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            yield "text", page[at:lt], ""
            at = lt
            continue
        m = _TAG.match(page, at) or _LOOSE.match(page, at)
        if not m:
            yield "text", "<", ""
            at += 1
            continue
        at = m.end()
        if m.lastindex is None or m.group(2) is None:
            if m.group().startswith("<![CDATA["):
                yield "text", html.escape(m.group()[9:].removesuffix("]]>")), ""
            continue
        name = m.group(2).lower()
        if m.group(1):
            yield "close", name, ""
            continue
        attributes = m.group(3)
        yield "open", name, attributes
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            to = end.start() if end else n
            if to > at:
                yield "text", page[at:to], ""
            at = to
        elif attributes.endswith("/") and name not in VOID and name in ("svg", "path", "use"):
            yield "close", name, ""


class Element:
    """An element of a page: kind (tag and marking words), children: elements and texts."""

    __slots__ = ("tag", "kind", "children")

    def __init__(self, tag: str, marks: tuple[str, ...] = ()):
        self.tag, self.kind = tag, ".".join((tag, *marks))
        self.children: list[Element | str] = []


def _marks(attributes: str) -> tuple[str, ...]:
    """The marking words among an element's classes, id and role; "hidden" if it isn't shown."""
    if "=" not in attributes and "hidden" not in attributes:
        return ()
    out: set[str] = set()
    named: set[str] = set()
    part: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name == "hidden" or name == "aria-hidden" and value == "true":
            out.add("hidden")
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                out.add("hidden")
        elif name in ("class", "id", "role"):
            for token in value.split():
                words = {w.lower() for w in _WORD.findall(token)} | {w.lower() for w in re.split(r"[^A-Za-z0-9]+", token)}
                out.update(words & MAIN_WORDS)
                if not words & STATE_WORDS:  # else it says how the element is, not what
                    boiler = words & BOILER_WORDS
                    (named if boiler and (token.lower() in boiler or words & MAIN_WORDS) else part).update(boiler)
    # a main word in a token of its own outweighs words that are only part of another token
    return tuple(sorted(out | named | (set() if out & MAIN_WORDS else part)))


def parse(page: str) -> Element:
    """The page's elements, with the end tags that HTML lets authors leave out. What nests deeper than
    DEPTH, or an inline element deeper than INLINE_DEPTH, is flattened: its text goes to the last element
    above it, apart from its neighbours if it is a block, and away if it never holds main text."""
    root = Element("#page")
    stack = [root]
    # for each open element: where its content goes (nowhere if none), and how deep that is
    into: list[tuple[Element | None, int]] = [(root, 0)]
    opened: dict[str, int] = {}  # how many of a tag are open

    def end(i: int) -> None:
        for e in stack[i:]:
            opened[e.tag] -= 1
        for k in range(len(stack) - 1, i - 1, -1):
            holder = into[k][0]
            if holder is not None and holder is not stack[k] and stack[k].tag in BLOCKS:
                holder.children.append(Element(stack[k].tag))
        del stack[i:], into[i:]

    for what, name, attributes in tokens(page):
        holder, depth = into[-1]
        if what == "text":
            if holder is not None:
                holder.children.append(name)
        elif what == "close":
            if not opened.get(name):  # nothing to end, whatever is open
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    end(i)
                    break
                if stack[i].tag in ("td", "th", "table") and name not in ("table", "tr", "tbody", "body", "html"):
                    break
        else:
            if rule := ENDS.get(name):
                ends, within = rule
                through = LEFT_OPEN | {"div"} if name in ENDS["li"][0] | ENDS["dd"][0] else LEFT_OPEN
                last = None
                if any(opened.get(x) for x in ends):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag in ends:
                            last = i
                        elif stack[i].tag in within or stack[i].tag not in through:
                            break
                if last is not None:
                    end(last)
                    holder, depth = into[-1]
            e = Element(name, _marks(attributes))
            boiler, main = is_boiler(e.kind), is_main(e.kind)
            most = DEPTH + 100 if boiler or main else INLINE_DEPTH if e.kind in LEFT_OPEN else DEPTH
            if holder is not None and (depth < most or name in VOID):
                holder.children.append(e)
                holder, depth = e, depth + 1
            elif boiler:
                holder = None
            elif holder is not None and name in BLOCKS:
                holder.children.append(Element(name))
            if name not in VOID:
                stack.append(e)
                into.append((holder, depth))
                opened[name] = opened.get(name, 0) + 1
    return root


# A wrapper's element: [kind, how often ("1", "?", "+", "*"), slot, children]. A slot is null or [text, pages]:
# the hash of the texts found there in a page, in their order, or -1 once two pages had different ones; and the
# numbers of two pages that had any, if there are two.


def _often(a: str, b: str) -> str:
    return a if a == b else "*" if {a, b} & {"+", "*"} and {a, b} & {"?", "*"} else "+" if "+" in a + b else "?"


def _slot(a: list | None, b: list | None) -> list | None:
    """Slots of two pages, or of parts of a host."""
    if a is None or b is None:
        return a or b
    return [a[0] if a[0] == b[0] else -1, sorted({*a[1], *b[1]})[:2]]


def _then(a: list | None, b: list | None) -> list | None:
    """Texts of one page, one after the other."""
    if a is None or b is None:
        return a or b
    return [zlib.crc32(f"{a[0]} {b[0]}".encode()), a[1]]


def skeleton(e: Element, page: int = 0) -> list:
    """The wrapper of one page: REPEATS or more neighbours of one kind fold into one that is repeated."""
    slot: list | None = None
    children: list[list] = []
    for c in e.children:
        if isinstance(c, str):
            if t := _SPACE.sub(" ", c).strip():
                slot = _then(slot, [zlib.crc32(t.encode("utf-8", "surrogatepass")), [page]])
        else:
            children.append(skeleton(c, page))
    return [e.kind, "1", slot, _fold(children)]


def _fold(items: list[list]) -> list[list]:
    """Runs of one kind, and then of two or three kinds such as term and description, that repeat fold into one
    run, if the kinds of blocks inside agree, too."""
    for width in (1, 2, 3):
        out: list[list] = []
        i = 0
        kinds = [(c[0], *dict.fromkeys(k[0] for k in c[3] if k[0].split(".")[0] in BLOCKS)) for c in items]
        while i < len(items):
            unit = kinds[i : i + width]
            n = 1
            while kinds[i + n * width : i + (n + 1) * width] == unit:
                n += 1
            if n < REPEATS or len(unit) < width:
                out.append(items[i])
                i += 1
                continue
            for k in range(width):
                item = items[i + k]
                for m in range(1, n):
                    item = align(item, items[i + m * width + k], _then)
                item[1] = "+"
                out.append(item)
            i += n * width
        items = out
    return items


def _relax(item: list) -> list:
    return [item[0], _often(item[1], "?"), *item[2:]]


def _partners(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence. Lists whose table would pass CELLS are matched greedily: each of
    ``y`` with the next of its kind, unless that skips more than SKIP of ``x``."""
    pairs: list[tuple[int, int]] = []
    if len(x) * len(y) > CELLS:
        places: dict[str, list[int]] = {}
        for i, kind in enumerate(x):
            places.setdefault(kind, []).append(i)
        at = 0
        for j, kind in enumerate(y):
            own = places.get(kind, [])
            k = bisect.bisect_left(own, at)
            if k < len(own) and own[k] - at <= SKIP:
                pairs.append((own[k], j))
                at = own[k] + 1
        return pairs
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def align(a: list, b: list, slots: Callable = _slot) -> list:
    """The wrapper of what either wrapper matches. Children are aligned along a longest common
    subsequence of kinds; a child without partner becomes optional; a child beside a repeated one of
    its kind joins it. ``slots``: how texts meet, of two pages or within one."""
    x, y = a[3], b[3]
    kinds = [c[0] for c in x], [c[0] for c in y]
    if kinds[0] == kinds[1]:
        children = [align(p, q, slots) for p, q in zip(x, y)]
    else:
        children, i, j = [], 0, 0
        for k, m in [*_partners(*kinds), (len(x), len(y))]:
            items = [_relax(c) for c in x[i:k]] + [_relax(c) for c in y[j:m]]
            items += [align(x[k], y[m], slots)] if k < len(x) else []
            i, j = k + 1, m + 1
            for item in items:
                if children and children[-1][0] == item[0] and (children[-1][1] in "+*" or item[1] in "+*"):
                    joined = align(children[-1], item, slots)
                    joined[1] = "*" if children[-1][1] in "?*" and item[1] in "?*" else "+"
                    children[-1] = joined
                else:
                    children.append(item)
    return [a[0], _often(a[1], b[1]), slots(a[2], b[2]), children]


def is_boiler(kind: str) -> bool:
    tag, *marks = kind.split(".")
    if tag in BOILER_TAGS or "hidden" in marks and tag != "body":
        return True
    if tag in ("main", "body", "html", "#page"):
        return False
    if tag == "article":  # a comment or a teaser may be an article, too
        return bool(set(marks) & NO_ARTICLE)
    return bool(set(marks) & BOILER_WORDS) and not set(marks) & SURE_WORDS


def is_main(kind: str) -> bool:
    tag, *marks = kind.split(".")
    return tag in MAIN_TAGS or tag in ("div", "section", "td") and bool(set(marks) & MAIN_WORDS)


#: What a rule says of the text in an element.
NOT, FIXED, MAYBE, MAIN = range(4)


def _holds_main(w: list) -> bool:
    return any(c[0].split(".")[0] in MAIN_TAGS and not is_boiler(c[0]) or _holds_main(c) for c in w[3])


def rules(wrapper: list, boiler: bool = False, main: bool = False) -> list:
    """[kind, rule, children, repeats] for each element of a host's wrapper. NOT: no content by its kind; MAIN: inside an
    element for main text; elsewhere FIXED where two pages or more have one text and none has another,
    else MAYBE. A form around the page's article is none."""
    boiler = boiler or is_boiler(wrapper[0]) and not (wrapper[0].split(".")[0] == "form" and _holds_main(wrapper))
    main = main or is_main(wrapper[0])
    slot = wrapper[2]
    fixed = slot is not None and slot[0] != -1 and len(slot[1]) > 1
    rule = NOT if boiler else MAIN if main else FIXED if fixed else MAYBE
    return [wrapper[0], rule, [rules(c, boiler, main) for c in wrapper[3]], int(wrapper[1] in "+*")]


def _matched(children: list[Element], parts: list[list]) -> Iterator[list | None]:
    """The part of the wrapper that each child stands for: of the parts of its kind from the last one on, the
    first that has the blocks it holds, or else the first; a part that repeats stands for any number."""
    places: dict[str, list[int]] = {}
    for i, part in enumerate(parts):
        places.setdefault(part[0], []).append(i)
    inner = {i: {p[0] for p in parts[i][2]} for own in places.values() if len(own) > 1 for i in own}
    at = 0
    for c in children:
        own = places.get(c.kind)
        if own is None:
            yield None
            continue
        k = bisect.bisect_left(own, at)
        i = own[k] if k < len(own) else own[-1]
        if len(own) > 1 and k < len(own):
            holds = {x.kind for x in c.children if not isinstance(x, str) and x.tag in BLOCKS}
            i = next((j for j in own[k : k + SKIP] if holds <= inner[j]), i)
        at = i if parts[i][3] else i + 1
        yield parts[i]


def main_text(page: str | None, rule: list) -> str:
    """The page's content by its host's wrapper: blocks in page order, one on a line. MAIN text if the
    page has any, else what changes over the host's pages; if that is a few words only, such as a counter,
    blocks of more words that do not."""
    blocks: list[tuple[int, str]] = []
    buffer: list[str] = []
    now = NOT

    def flush() -> None:
        if t := _SPACE.sub(" ", "".join(buffer)).strip():
            blocks.append((now, t))
        buffer.clear()

    def walk(e: Element, part: list) -> None:
        nonlocal now
        use = part[1]
        apart = e.tag in BLOCKS or e.tag == "#page"
        if apart:
            flush()
        inner = iter(_matched([c for c in e.children if not isinstance(c, str)], part[2]))
        for c in e.children:
            if isinstance(c, str):
                if use:
                    if use != now:
                        flush()
                        now = use
                    buffer.append(html.unescape(c))
                continue
            own = next(inner)
            if c.tag == "br":
                buffer.append(" ")
            else:
                walk(c, own or rules([c.kind, "1", None, []], use == NOT, use == MAIN))
        if apart:
            flush()

    walk(parse(page or ""), rule)
    best = max((use for use, _ in blocks), default=NOT)
    if best == MAYBE and sum(len(t.split()) for use, t in blocks if use == best) < WORDS:
        long = [t for use, t in blocks if use == FIXED and len(t.split()) >= WORDS]
        if long:
            return "\n".join(long)
    return "\n".join(t for use, t in blocks if use == best)


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


_SKELETON = "host string, shape string, wrapper string"


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, wrapper (JSON) of every host."""
    rows = pages.select(_host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], list] = {}
            for part in slices(batch, "html"):
                for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                    w = skeleton(parse(page), zlib.crc32(page.encode("utf-8", "surrogatepass")))
                    key = host, json.dumps(_shape(w))
                    found[key] = align(found[key], w) if key in found else w
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.string()) for x in ([h for h, _ in found], [s for _, s in found],
                                                    [json.dumps(w) for w in found.values()])],
                names=["host", "shape", "wrapper"])

    def merge(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wrapper = None
        for batch in batches:
            for w in batch["wrapper"]:
                w = json.loads(w)
                wrapper = w if wrapper is None else align(wrapper, w)
        yield pd.DataFrame({"host": [key[0]], "wrapper": [json.dumps(wrapper)]})

    skeletons = rows.mapInArrow(reduce, _SKELETON)
    salted = skeletons.withColumn("salt", F.pmod(F.xxhash64("shape"), F.lit(SALTS)))
    partial = salted.groupBy("host", "salt").applyInPandas(merge, "host string, wrapper string")
    return partial.groupBy("host").applyInPandas(merge, "host string, wrapper string")


def _shape(w: list) -> list:
    return [w[0], w[1], w[2] is None, [_shape(c) for c in w[3]]]


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` and text (string), n_chars (long).

    text: the page's article without menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles, markup and comments; character references decoded, white space inside a block one
    space, blocks in page order joined by one line feed; empty if there is none. Null and empty pages
    have none. Pages without a host (a null or odd url) share one wrapper. Pages of any length are read
    whole; repeated rows and ids are treated row by row; an empty table gives no rows. An input column
    with the name of a result column (in any case) is replaced by it.

    The wrappers are written first. They are one small row a host: Spark broadcasts them where they
    are small, and else joins by host, with adaptive execution splitting a host with many pages.
    """

    @F.pandas_udf("string")
    def judge(wrapper: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(rules(json.loads(w))) for w in wrapper], dtype=object)

    known = written(infer_wrappers(pages, url_col, html_col).select("host", judge("wrapper").alias("rules")))

    def extract(part: pa.RecordBatch) -> list[pa.Array]:
        rule = part.column("rules").dictionary_encode()
        read = [json.loads(r) for r in rule.dictionary.to_pylist()]
        return [pa.array([main_text(page, read[i]) for page, i in
                          zip(part.column("page").to_pylist(), rule.indices.to_pylist())], pa.string())]

    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html_col]).alias("row"),
                        F.col(f"`{html_col}`").alias("page"), _host(F.col(f"`{url_col}`")).alias("host"))
    done = with_columns_of(rows.join(known, "host").select("row", "page", "rules"), "page", "text string", extract)
    whole = [F.col("page").alias(c) if c == html_col else F.col(f"row.`{c}`") for c in pages.columns]
    done = done.select(F.struct(*whole).alias("row"), "text")
    return replace_columns(done.withColumn("n_chars", F.length("text").cast("long")), "row", ["text", "n_chars"])
