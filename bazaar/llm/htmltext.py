"""Main text of web pages by consensus among the pages of a host.

1. Every page's containers are scored by the text of the blocks in them, less link text; a block counts
   fully for its container and by half for each one further out.
2. The best container's generalised path (tags with their classes, numbers removed) is the page's vote.
   Spark counts the votes per host; paths with at least ``MIN_SHARE`` of a host's votes win (so at most
   1 / MIN_SHARE paths per host).
3. Every page is read again with its host's winning paths: the container on the most voted path that the
   page has is extracted. A page that has none of them uses its own best container.

Menus, site headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are
recognised by tag, role and the names in class and id, and count neither for scores nor for the text. A name counts
whole (``sidebar``, ``left-sidebar``, ``cookie-notice``); one that only mentions a neighbour (``has-sidebar``) doesn't.
What is recognised by name, role or a tag like form, but holds the page's only article or main element or the bulk of
its text, is a wrapper and stays; hidden elements don't.
"""

from __future__ import annotations

import re
from heapq import heappop, heappush
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.shared import extended, free_names, materialise

MIN_SHARE = 0.2
OUTWARD = 0.5

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|textarea|iframe|select|title)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"""
                   r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?][^>]*>|<[a-zA-Z][^<>]*>""", re.S | re.I)
#: every attribute is read whole, so that names count neither inside other names nor inside values
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
ATTRIBUTES = frozenset("class id role style hidden aria-hidden".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: closed by the next of the same kind
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",)}
#: where the search for an open item ends
LISTS = frozenset("ul ol dl table menu".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6".split())
DROP_TAGS = frozenset("head nav footer aside form button fieldset dialog menu object audio video canvas map datalist".split())
DROP_ROLES = frozenset("navigation banner complementary contentinfo search alert alertdialog dialog form menu menubar toolbar".split())
DROP_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
                       "sidebar aside footer masthead topbar cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup login popup modal overlay "
                       "share sharing social related recommended recommendations comment comments commentlist disqus respond replies reply discussion form search pagination pager toolbar widget skip".split())
#: what may stand beside such a word in a name for the same thing
BESIDE = frozenset("site page main global left right top bottom primary secondary first second third inner outer upper lower my the post entry article list item items box block bar area section "
                   "wrap wrapper container panel group row col column inside holder slot unit zone tag tags link links button buttons btn icon icons title heading header text label field message msg cta policy sticky fixed "
                   "floating mobile desktop google bottombar leaderboard skyscraper rectangle mpu thread form forms input count feed media network networks posts articles stories".split())
#: reader comments may be longer than what they are about
REPLY_WORDS = frozenset("comment comments commentlist disqus respond replies reply discussion".split())
#: dropped by tag, but pages exist that have all of their text in one
WRAPPER_TAGS = frozenset("form aside fieldset dialog nav footer header".split())
BULK = 4  # a wrapper has so many times the text outside of what is dropped
HARD, SOFT, REPLY = 3, 2, 1
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NUMBER = re.compile(r"\d+")


class Container:
    """An element that can hold the article. Everything that depends on what is around it is taken over from the parent
    when it is made, so a page costs the same however deep it is nested."""

    __slots__ = ("tag", "step", "parent", "own", "dropped", "score", "blocks", "first", "marked")

    def __init__(self, tag, step, parent, own, first):
        """``own`` tells why this container is dropped (0: it isn't), ``dropped`` whether it or one around it is, ``marked``
        whether it or one around it is an article or main element."""
        self.tag, self.step, self.parent, self.own, self.first, self.score, self.blocks = tag, step, parent, own, first, 0.0, []
        self.dropped = bool(own) or parent is not None and parent.dropped
        self.marked = tag in ("article", "main") or parent is not None and parent.marked

    @property
    def path(self) -> str:
        """The generalised tag-class path from the root."""
        steps, at = [], self
        while at is not None:
            steps.append(at.step)
            at = at.parent
        return ">".join(reversed(steps))


def at_path(found: list[Container], path: str) -> list[Container]:
    """The kept containers with this path: the path is matched step by step along with the containers."""
    place, same = {id(found[0]): 0}, []
    for c in found[1:]:
        p = place.get(id(c.parent), -1)
        if p >= 0 and path.startswith(">" + c.step, p):
            place[id(c)] = p + 1 + len(c.step)
            if place[id(c)] == len(path) and not c.dropped:
                same.append(c)
    return same + [found[0]] if path == "" and not found[0].dropped else same


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw) if raw else ():
        if (name := m[1].lower()) in ATTRIBUTES:
            out.setdefault(name, (m[2] or "").strip("\"'"))
    return out


def _drop_name(name: str) -> int:
    """Whether one name of a class or id is a known one, as a whole or as a compound."""
    words = [w.lower() for w in WORD.findall(name)]
    told = [w for w in words if w in DROP_WORDS]
    if not told or not all(w in DROP_WORDS or w in BESIDE or len(w) == 1 for w in words):
        return 0
    return REPLY if REPLY_WORDS.intersection(told) else SOFT


def _is_dropped(tag: str, attrs: dict[str, str], inside_article: bool) -> int:
    """HARD, SOFT (by tag, role or name: it may be a wrapper), REPLY (named as reader comments) or 0."""
    hidden = attrs and ("hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower())
    if hidden or tag in DROP_TAGS and tag not in WRAPPER_TAGS:
        return HARD
    if tag in DROP_TAGS or tag == "header" and not inside_article or attrs.get("role", "").lower() in DROP_ROLES:
        return SOFT
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    if tag in ("html", "body", "main", "article") or not names:
        return 0
    if "header" in (n.lower() for n in names) and not inside_article:
        return SOFT
    return max((_drop_name(n) for n in names), default=0) or (SOFT if not inside_article and any({"header"} < {w.lower() for w in WORD.findall(n)} <= BESIDE | {"header"} for n in names) else 0)


def _open_wrappers(found: list[Container], worths: dict[int, float]) -> None:
    """Undrop the containers that hold the page's only article or main element or the bulk of its text.

    The outermost dropped containers are judged, the most promising first; what is dropped inside an opened one is judged
    next. Dropped containers form a tree of their own with the worth of the text in them, summed once."""
    around: dict[int, Container | None] = {}  # the innermost dropped container around (or itself)
    hard: dict[int, bool] = {}
    inner: dict[int, list[Container]] = {}  # dropped containers directly inside a dropped one; 0: the outermost
    direct, total, marks, whole_inside, kept, whole = {}, {}, {}, {}, 0.0, False
    drops: list[tuple[Container, Container | None]] = []
    for c in found:  # parents come before what is in them
        out = around.get(id(c.parent))
        hard[id(c)] = c.own == HARD or c.parent is not None and hard.get(id(c.parent), True)  # hidden inline elements are not listed
        if c.own:
            drops.append((c, out))
            inner.setdefault(id(out) if out is not None else 0, []).append(c)
        around[id(c)] = at = c if c.own else out
        w = worths.get(id(c), 0.0)
        if not w or hard[id(c)]:
            continue
        if at is None:
            kept, whole = kept + w, whole or c.marked
        else:
            direct[id(at)] = direct.get(id(at), 0.0) + w
            whole_inside[id(at)] = whole_inside.get(id(at), False) or c.marked
    for c, out in reversed(drops):
        total[id(c)] = total.get(id(c), 0.0) + direct.get(id(c), 0.0)
        marks[id(c)] = marks.get(id(c), False) or whole_inside.get(id(c), False)
        if out is not None:
            total[id(out)] = total.get(id(out), 0.0) + total[id(c)]
            marks[id(out)] = marks.get(id(out), False) or marks[id(c)]
    heap: list[tuple] = []

    def judge(candidates):
        for c in candidates:
            if total[id(c)]:
                heappush(heap, (not marks[id(c)], -total[id(c)], c.first, id(c), c))

    judge(inner.get(0, ()))
    opened = False
    while heap and not whole:
        no_mark, w, _, _, best = heappop(heap)
        if not (not no_mark and best.own != REPLY or -w > BULK * kept and (best.own != REPLY or not kept)):
            break
        best.own, opened = 0, True
        kept, whole = kept + direct.get(id(best), 0.0), whole_inside.get(id(best), False)
        judge(inner.get(id(best), ()))
    if opened:
        for c in found:
            c.dropped = bool(c.own) or c.parent is not None and c.parent.dropped


def parse(html: str) -> list[Container]:
    """The page's containers in page order; each block of text hangs at the container it stands in."""
    root = Container("", "", None, 0, 0)
    worths: dict[int, float] = {}
    blocks: list[tuple[Container, int, str, float]] = []
    found, here, text, links = [root], root, [], 0
    in_link, block_no, inline = 0, 0, []

    def flush():
        nonlocal links, block_no
        if text:
            block = " ".join("".join(text).split())
            if block:
                worth = max(0.0, len(block) - 1.5 * links) + 10 * min(block.count(","), 10)
                blocks.append((here, block_no, block, worth))
                if worth >= 1:
                    worths[id(here)] = worths.get(id(here), 0.0) + worth
                block_no += 1
            text.clear()
        links = 0

    def say(raw):
        nonlocal links
        if raw:
            raw = unescape(raw)
            text.append(raw)
            if in_link:
                links += len(raw.strip())

    open_tags: dict[str, int] = {}  # elements around ``here``, by tag

    def enter(tag, step, own):
        nonlocal here
        here = Container(tag, step, here, own, block_no)
        open_tags[tag] = open_tags.get(tag, 0) + 1

    def leave():
        nonlocal here
        open_tags[here.tag] -= 1
        here = here.parent

    def close(tag, until=()):
        if not open_tags.get(tag):
            return
        at = here
        while at.tag != tag:
            if at.tag in until:
                return
            at = at.parent
        while here is not at:
            leave()
        leave()

    last = 0
    for m in TOKEN.finditer(html):
        say(html[last:m.start()])
        last = m.end()
        tag = m[3]
        if tag is None:
            if m[1]:
                text.append(" ") if m[1].lower() != "svg" else None
            continue
        tag = tag.lower()
        if tag in INLINE:
            if not m[2]:
                attrs = _attributes(m[4])
                if attrs and _is_dropped(tag, attrs, True):  # an inline element that is hidden or an advert
                    flush()
                    enter(tag, tag, HARD)
                    inline.append(tag)
            elif inline and inline[-1] == tag and here.tag == tag:
                flush()
                inline.pop()
                leave()
            if tag == "a":
                in_link = 0 if m[2] else 1
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                text.append(" " if tag == "br" else "")
            continue
        flush()
        in_link = 0
        if tag in TEXT_BLOCKS:
            if not m[2] and m[4].strip() and not here.dropped and _is_dropped(tag, _attributes(m[4]), True):
                enter(tag, tag, HARD)
            elif here.tag == tag and here.dropped:
                leave()
            continue
        if m[2]:
            close(tag)
            continue
        for item in ITEMS.get(tag, ()):
            close(item, LISTS)
        attrs = _attributes(m[4])
        names = ".".join(sorted(NUMBER.sub("#", c) for c in attrs.get("class", "").split()))
        enter(tag, tag + (f".{names}" if names else ""), _is_dropped(tag, attrs, here.marked))
        found.append(here)
        if m[4].endswith("/") and tag not in ("div", "section", "article", "main", "body", "html"):
            leave()
    say(html[last:])
    flush()
    if any(c.own in (SOFT, REPLY) for c in found):
        _open_wrappers(found, worths)
    for at, no, block, worth in blocks:
        if at.dropped:
            continue
        at.blocks.append((no, block))
        while at is not None and worth >= 1:
            at.score += worth
            worth *= OUTWARD
            at = at.parent
    return found


def best_container(found: list[Container]) -> Container | None:
    """The container with the highest score, or the article or main element around it. None on a page without text."""
    best = max(found, key=lambda c: (c.score, -c.first)) if found else None
    if best is None or best.score <= 0:
        return None
    up, whole = best, None
    while up is not None:
        if up.tag == "article" or up.tag == "main" and whole is None:
            whole = up
        up = up.parent
    return whole or best


def text_of(found: list[Container], top: list[Container]) -> str:
    """The blocks in the containers ``top`` (and in those inside them) in page order."""
    tops, inside, blocks = {id(c) for c in top}, set(), []
    for c in found:
        if id(c) in tops or c.parent is not None and id(c.parent) in inside:
            inside.add(id(c))
            blocks += c.blocks
    return "\n".join(b for _, b in sorted(blocks))


def host_of(url):
    """Lower-cased host of a URL, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def page_votes(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(_host, path) of every page with text; pages: _host, html."""
    def run(batches):
        for batch in batches:
            host, path = [], []
            for h, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                if best := best_container(parse(page.as_py() or "")):
                    host.append(h), path.append(best.path)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.string())], ["_host", "path"])
    return pages.select("_host", html_col).mapInArrow(run, "_host string, path string")


def winning_paths(votes: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(_host, paths): the paths with at least ``min_share`` of the host's votes, most voted first."""
    counted = votes.groupBy("_host", "path").agg(F.count(F.lit(1)).alias("n"))
    # a host's distinct paths were counted before; hosts are many and paths few
    share = counted.withColumn("all", F.sum("n").over(Window.partitionBy("_host"))).where(F.col("n") >= min_share * F.col("all"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))), lambda x: x["path"])
    return share.groupBy("_host").agg(ordered.alias("_paths"))


def extract_text(pages: DataFrame, html_col: str = "html", url_col: str = "url", min_share: float = MIN_SHARE) -> DataFrame:
    """Add text (string, empty if none) and text_path (the container's path, null if none) to every page.

    Null html counts as empty. Pages without a host vote together. Repeated rows give repeated results. Columns of
    these names are replaced; all others stay."""
    src = pages.drop("text", "text_path")
    host, wanted = free_names(src.columns, "_host", "_paths")
    hosted = src.withColumn(host, host_of(F.col(url_col)))
    winners = materialise(winning_paths(page_votes(hosted.select(F.col(host).alias("_host"), html_col), html_col), min_share), "host-paths")
    winners = winners.select(F.col("_host").alias(host), F.col("_paths").alias(wanted))
    both = hosted.join(winners, host, "left").select(*[f"`{c}`" for c in src.columns], wanted)
    at, n = src.columns.index(html_col), len(src.columns)

    def run(batches):
        for batch in batches:
            texts, paths = [], []
            for page, wanted in zip(batch.column(at), batch.column(n).to_pylist()):
                found = parse(page.as_py() or "")
                text, path = "", None
                for w in wanted or ():
                    same = at_path(found, w)
                    if same and (text := text_of(found, same)):
                        path = w
                        break
                if path is None and (best := best_container(found)):
                    text, path = text_of(found, [best]), best.path
                texts.append(text), paths.append(path)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string()), pa.array(paths, pa.string())], [*batch.schema.names[:n], "text", "text_path"])

    return both.mapInArrow(run, extended(src, text="string", text_path="string"))
