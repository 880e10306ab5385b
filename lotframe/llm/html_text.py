"""Main text of web pages by tree scoring.

A page becomes a light element tree. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments go by element or role, and by class or id where they are no more than that: an element so named stays
if it holds the page's article or main, or more unlinked text than the rest of the page, or, where the name is a loose
one (``notice``, ``form``), more than a few lines. The header of an article keeps its headings and paragraphs. Every
paragraph left passes points for its length and its commas to its ancestors, half as many with each step up; an element's
points are discounted by the share of its text that stands in links. The element with most points is the container. A
``main`` or ``article`` around it is preferred; without one, the container grows until it holds every paragraph that is
left, and all blocks and bare text beside it that are not mostly links are kept with it. Character references are
decoded, white space becomes one space, blocks are joined in page order by one space. Every step is one pass over the
page or its tree, so that the time is in proportion to the page whatever its markup.

Defined results: null or empty html gives an empty text; so does a page without text. Broken markup never fails: an
unclosed comment, script or style runs to the end, other tags whose content is skipped are ignored if they are unclosed
or self-closed, unknown or unmatched end tags are ignored; a tag without an end is text, and once a quoted value has no
end, quotes no longer hide the end of a tag on that page. Of elements with equal scores the first of the page counts.
Long pages are read whole. Repeated rows give repeated results, an empty table an empty one; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
QUOTE_OR_END = re.compile(r"[\"'>]")
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math canvas object audio video select".split())
DROPPED = frozenset("nav header footer aside menu dialog button label fieldset datalist head map applet".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH = frozenset("p pre td blockquote li dd".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag closes, and the elements that end the search for it.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table")}
CLOSES = {tag: (tuple(own.split()), tuple(walls.split())) for tag, (own, walls) in CLOSES.items()}
#: In a page's table of open elements, all blocks but paragraphs.
BLOCKS = "blocks"
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: What words of a class or id say of an element; the greater counts. HEAD and LOOSE words also name parts of articles.
HEAD, LOOSE, FURNITURE, TALK, ADVERT = 1, 2, 3, 4, 5
NOISE = {
    word: kind
    for kind, words in (
        (HEAD, "banner banners header masthead topbar"),
        (LOOSE, "promo promos promotion promoted rail notice notices notification alert popup modal overlay dialog toast register form search social related recommended recommendations trending discussion widget widgets skip copyright"),
        (FURNITURE, "nav navbar navigation menu menus breadcrumb breadcrumbs crumbs pager pagination sidebar sidebars aside footer bottombar toolbar paywall subscribe subscription newsletter signup login share sharing"),
        (TALK, "comment comments commentlist disqus respond reply replies"),
        (ADVERT, "ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored sponsors outbrain taboola cookie cookies consent gdpr"),
    )
    for word in words.split()
}
#: An element named by noise holds little up to so many unlinked characters.
LITTLE = 200
GOOD = frozenset("article articlebody content main post entry story text body".split())
ENTRY = frozenset("article articlebody post entry story".split())
NOT_NOISE_AFTER = frozenset("with has no without".split())
NOT_NOISE_BEFORE = frozenset("open closed enabled disabled".split())
SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "good", "points", "chars", "linked", "commas", "noise", "entry", "inside", "head", "within", "titled")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.dropped = self.good = False
        self.points, self.chars, self.linked, self.commas = 0.0, 0, 0, 0
        #: kind of noise by class or id; an article or the like; below one; cut to headings and paragraphs; nearest noise above; has an h1
        self.noise, self.entry, self.head, self.titled = 0, False, False, False
        self.inside = parent is not None and (parent.inside or parent.entry)
        self.within: Node | None = None


def _noise(name: str) -> tuple[int, bool]:
    """The kind of noise that a word of a class or id names, and whether it is the header of an entry."""
    kind, last, entry = 0, "", False
    parts = [p.lower() for p in SPLIT.split(name) if p]
    for part, after in zip(parts, [*parts[1:], ""], strict=True):
        if part in NOISE and last not in NOT_NOISE_AFTER and after not in NOT_NOISE_BEFORE:
            if part == "header" and (last in ENTRY or last == "content"):
                entry = True
            else:
                kind = max(kind, NOISE[part])
        last = part
    return kind, entry


def _judge(node: Node, attributes: str) -> None:
    tag = node.tag
    if tag in DROPPED:
        node.dropped, node.head = not (tag == "header" and node.inside), tag == "header"
    elif tag == "form":  # some sites put the whole page into one
        node.noise = FURNITURE
    if tag in ("article", "main"):
        node.good = node.entry = True
    if not attributes.strip():
        return
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id") and tag not in ("html", "body"):
            words = value.split()
            found = [_noise(w) for w in words]
            kind = max((k for k, _ in found), default=0)
            if any(w.lower() in GOOD for w in words):
                kind = min(kind, LOOSE)
            if tag in ("article", "main"):
                kind = kind if tag == "article" and kind == TALK else 0
            elif tag == "header":
                kind = kind if kind > HEAD else 0
            if any(e for _, e in found) and not kind:
                node.head = True
                node.dropped &= tag != "header"
            node.noise = max(node.noise, kind)
            if not kind and tag in ("div", "section", "td"):
                parts = {p.lower() for w in words for p in SPLIT.split(w)}
                node.good = node.good or not parts.isdisjoint(GOOD)
                node.entry = node.entry or not parts.isdisjoint(ENTRY)
        elif name == "role":
            node.dropped |= value.lower() in ROLES
            if value.lower() in ("main", "article"):
                node.good = node.entry = True
        elif name == "itemprop" and value.lower() == "articlebody":
            node.good = node.entry = True
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            node.dropped = True


class Scanner:
    """Finds the ends of a page's tags, each in one step forward."""

    def __init__(self, page: str):
        self.page, self.last, self.quotes = page, page.rfind(">"), True

    def tag_end(self, at: int) -> int:
        """Where the tag whose name ends at ``at`` has its ``>``, or -1. A quote counts after an equals sign (and no
        more than 63 spaces)."""
        if at > self.last:
            return -1
        start = at
        while self.quotes:
            m = QUOTE_OR_END.search(self.page, at)
            if not m:
                self.quotes = False
            elif m[0] == ">":
                return m.start()
            else:
                at = m.end()
                if self.page[max(start, m.start() - 64) : m.start()].rstrip().endswith("="):
                    at = self.page.find(m[0], at) + 1
                    self.quotes = at > 0
        return self.page.find(">", start)


class Open:
    """The open elements: their path from the root, and for each tag their places in it."""

    def __init__(self, root: Node):
        self.path, self.at = [root], {}

    def push(self, node: Node) -> None:
        for key in (node.tag, BLOCKS) if node.tag in BLOCK and node.tag != "p" else (node.tag,):
            self.at.setdefault(key, []).append(len(self.path))
        self.path.append(node)

    def deepest(self, tags: tuple) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def close(self, depth: int) -> None:
        """Closes the element at a depth and all inside it."""
        while len(self.path) > depth:
            tag = self.path.pop().tag
            for key in (tag, BLOCKS) if tag in BLOCK and tag != "p" else (tag,):
                self.at[key].pop()


def parse(page: str) -> Node:
    """The element tree; a child is a Node or a decoded text."""
    root = Node("html", None)
    at, end, unclosed, scan, path = 0, len(page), set(), Scanner(page), Open(root)
    text_from = 0

    def flush(to: int) -> None:
        if to > text_from:
            text = page[text_from:to]
            path.path[-1].children.append(_html.unescape(text) if "&" in text else text)

    while at < end:
        m = MARKUP.search(page, at)
        if not m:
            break
        start = m.start()
        if page.startswith("<!--", start):
            flush(start)
            stop = page.find("-->", start + 4)
            at = text_from = stop + 3 if stop >= 0 else end
            continue
        closing = page[start + 1] == "/"
        name = NAME.match(page, start + 1 + closing) if start < scan.last else None
        if page[start + 1] in "!?":
            stop = page.find(">", start) if start < scan.last else -1
        else:
            stop = scan.tag_end(name.end()) if name else -1
        if stop < 0:
            at = start + 1
            continue
        flush(start)
        at = text_from = stop + 1
        if not name:
            continue
        tag, attributes = name[0].lower(), page[name.end() : stop]
        if closing:
            depth = path.deepest((tag,))
            if depth:
                path.close(depth)
            continue
        if tag in RAW:
            script = tag in ("script", "style")
            if script or not attributes.endswith("/") and tag not in unclosed:
                m = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I | re.A).search(page, at)
                stop = page.find(">", m.end()) if m else -1
                if stop >= 0 or script:
                    at = text_from = stop + 1 if stop >= 0 else end
                else:
                    unclosed.add(tag)
            continue
        if tag in ("html", "body"):
            _judge(root, attributes)
            continue
        own, walls = CLOSES.get(tag) or ((("p",), (BLOCKS,)) if tag in BLOCK else ((), ()))
        depth = path.deepest(own)
        if depth > path.deepest(walls):
            path.close(depth)
        child = Node(tag, path.path[-1])
        path.path[-1].children.append(child)
        _judge(child, attributes)
        if tag not in VOID and not attributes.endswith("/"):
            path.push(child)
    flush(end)
    return root


def _prune(found: list[Node]) -> list[Node]:
    """Drops the elements named by noise that are no more than that, the largest judged first; what is left in page order."""
    below: dict = {}
    for n in found:
        if n.noise:
            below.setdefault(n.within, []).append(n)
        elif n.tag == "h1":
            up = n.within
            while up is not None and not up.titled:
                up.titled, up = True, up.within
    if not below:
        return found
    free = {n: n.chars - n.linked for n in found}
    articles = [n for n in found if n.tag in ("article", "main") and not n.noise]
    most = max((free[a] for a in articles), default=0)
    holders = set()
    for a in articles:
        up = a.within if free[a] and 2 * free[a] >= most else None
        while up is not None and up not in holders:
            holders.add(up)
            up = up.within
    clean = {n: free[n] - sum(free[x] for x in below.get(n, ())) for n in [found[0], *(x for some in below.values() for x in some)]}
    rest = free[found[0]] - sum(free[x] for x in below.get(None, ()))
    place = {n: i for i, n in enumerate(found)}
    queue = [(x not in holders, -free[x], place[x], x) for x in below.get(None, ())]
    heapq.heapify(queue)
    while queue:
        other, size, _, n = heapq.heappop(queue)
        size = -size
        if not other:
            gone = False
        elif _linky(n):
            gone = True
        elif n.noise == TALK:
            gone = rest >= 25 or size <= rest
        elif n.noise == ADVERT:
            gone = size <= max(rest, LITTLE)
        elif n.noise == FURNITURE:
            gone = size <= rest
        else:
            gone = size <= min(rest, LITTLE)
        if gone and n.inside and n.noise < TALK and (n.noise == HEAD or n.titled):
            n.head, gone = True, False
        elif not gone:
            rest += clean[n]
        if gone:
            n.dropped = True
        else:
            for x in below.get(n, ()):
                heapq.heappush(queue, (x not in holders, -free[x], place[x], x))
    left, out = [], set()
    for n in found:
        if n.dropped and n.parent is not None or n.parent in out:
            out.add(n)
        else:
            left.append(n)
    less = dict.fromkeys(left, (0, 0, 0))
    for n in reversed(found):  # what was dropped no longer counts above
        if n in out and n.parent not in out:
            gone = (n.chars, n.linked, n.commas)
        elif n in less:
            gone = less[n]
            n.chars, n.linked, n.commas = n.chars - gone[0], n.linked - gone[1], n.commas - gone[2]
        else:
            continue
        if n.parent in less:
            less[n.parent] = tuple(a + b for a, b in zip(less[n.parent], gone, strict=True))
    for n in left:
        if any(isinstance(c, Node) and c.dropped for c in n.children):
            n.children = [c for c in n.children if isinstance(c, str) or not c.dropped]
    return left


def _weigh(node: Node) -> list[Node]:
    """Prunes what is dropped, counts characters, gives points; the elements in page order."""
    found, stack = [], [(node, 0, False)]
    while stack:
        node, i, in_link = stack.pop()
        if i == 0:
            found.append(node)
            node.children = [c for c in node.children if isinstance(c, str) or not c.dropped]
            in_link = in_link or node.tag == "a"
        while i < len(node.children):
            child = node.children[i]
            i += 1
            if isinstance(child, str):
                n = len(child.strip())
                node.chars += n
                node.linked += n * in_link
                node.commas += child.count(",")
            else:
                child.within = node if node.noise else node.within
                stack.append((node, i, in_link))
                stack.append((child, 0, in_link))
                break
        else:
            if node.parent is not None:
                node.parent.chars += node.chars
                node.parent.linked += node.linked
                node.parent.commas += node.commas
    found = _prune(found)
    for p in found:
        if p.chars and _paragraph(p):
            size, commas = p.chars, p.commas
            if p.tag not in PARAGRAPH:
                bare = [c for c in p.children if isinstance(c, str)]
                size, commas = sum(len(c.strip()) for c in bare), sum(c.count(",") for c in bare)
            up = p.parent if p.tag in PARAGRAPH and p.parent is not None else p
            up.points += ((1.0 if size >= 25 else 0.2) + commas + min(size / 100, 3)) * (1 - p.linked / p.chars)
    for n in reversed(found):
        if n.parent is not None:
            n.parent.points += n.points / 2
    return found


def _text_of(nodes: list[Node]) -> str:
    out: list[str] = []
    stack: list = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag == "br" or x.tag == "hr":
            out.append(" ")
        elif not x.dropped:
            if x.tag in BLOCK:
                stack.append(" ")
                out.append(" ")
            stack.extend(reversed(x.children))
    return " ".join("".join(out).split())


def _linky(node: Node) -> bool:
    return node.chars > 0 and node.linked > 0.6 * node.chars


def _paragraph(node: Node) -> bool:
    return node.tag in PARAGRAPH or node.tag in BLOCK and any(isinstance(c, str) and len(c.strip()) >= 25 for c in node.children)


def _beside(parent: Node) -> list:
    """The children of an element without blocks, or runs of bare text, that are mostly links."""
    keep, run = [], []

    def close():
        chars = sum(len(c.strip()) if isinstance(c, str) else c.chars for c in run)
        linked = sum(0 if isinstance(c, str) else c.linked for c in run)
        if linked <= 0.6 * chars:
            keep.extend(run)
        run.clear()

    for c in parent.children:
        if isinstance(c, str) or c.tag not in BLOCK:
            run.append(c)
        else:
            close()
            if not _linky(c):
                keep.append(c)
    close()
    return keep


def _headings(node: Node) -> list:
    """The headings and paragraphs below the header of an article, in page order."""
    out, stack = [], list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, str) or c.dropped:
            continue
        if c.tag in HEADING or c.tag == "hgroup" or _paragraph(c) and c.chars >= 25 and not _linky(c):
            out.append(c)
        else:
            stack.extend(reversed(c.children))
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    root.dropped = False
    nodes = _weigh(root)
    if not root.chars:
        return ""

    def score(n: Node) -> float:
        return (n.points + (25 if n.good and n.chars else 0)) * (1 - n.linked / n.chars if n.chars else 0)

    best = max(nodes, key=score)  # ties: the first in page order
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    if best.tag in ("article", "main"):
        keep = [best]
        if best.tag == "article" and best.parent is not None:  # its title may stand before it
            keep = [s for s in best.parent.children if s is best or isinstance(s, Node) and s.tag == "h1" and not _linky(s)]
    else:
        best = _around([best, *(n for n in nodes if n.chars >= 25 and _paragraph(n) and not _linky(n))])
        while best.parent is not None and best.parent.chars == best.chars:  # no more than a wrapper
            best = best.parent
        keep = _beside(best.parent) if best.parent is not None else [best]
    stack = [n for n in keep if isinstance(n, Node)]
    while stack:  # lists and boxes of links inside the article
        x = stack.pop()
        if x.head:
            x.children = _headings(x)
        for c in x.children:
            if isinstance(c, Node):
                if c.tag in ("ul", "ol", "dl", "div", "section", "table") and _linky(c):
                    c.dropped = True
                else:
                    stack.append(c)
    return _text_of(keep)


def _around(nodes: list[Node]) -> Node:
    """The lowest element that holds all of ``nodes``."""
    path, up = [], nodes[0]
    while up is not None:
        path.append(up)
        up = up.parent
    level = {n: i for i, n in enumerate(path)}
    known, most = set(), 0
    for n in nodes[1:]:
        up = n
        while up not in level and up not in known:
            known.add(up)
            up = up.parent
        if up in level:
            most = max(most, level[up])
    return path[most]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars); map-only."""

    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
