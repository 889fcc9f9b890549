"""HTML extraction by union-free wrappers, inferred per host.

Each page becomes a stream of nested tokens (elements with their class and id words,
and text). The streams of one host are aligned element by element: those at the same path
of names from the root meet, neighbours of one name fold into a repeated group, a path that
some pages lack is optional, and text that differs between pages becomes a slot. The result,
one row per path, is the host's union-free regular expression (``expression`` prints it).
Its rows add up in any order, so it is the same for any partitioning and task retry.
Paths exist twice, with class and id words and by element names alone; where a host's words
change from page to page (generated class names) the second kind tells.

The wrapper decides what is read (``decided``): the main region is ``article``/``main``, or
else the innermost path that holds most of the text in slots outside links; lists and sections
that are mostly links on the host's pages go, and so does, on hosts without a region, text that is no slot.
Inside the main region a listed word leaves an element out only if it
is mostly links, holds a form, or is a comment group that the wrapper repeats; headings,
table rows, paragraphs and unlinked inline text stay. Blocks of text found on most of
the host's pages, counted exactly, go too; headings and table cells stay where what they label varies.

Scale: each task adds its pages' paths up before anything moves, Spark sums them by (host,
path), and only paths on one page in twenty of the host or more are kept, so a wrapper holds
at most twenty times the paths of a mean page, however many pages or generated names the host
has. The decisions, a few dozen hashes a host, are broadcast when their counted size allows it
and joined by host otherwise. Blocks are counted as
(host, page, block) hashes dealt by all three, so no host meets in one task; those on most
pages of a host are at most twice the mean number of blocks of its pages.

Defined results: null and empty html give the empty text; a page without its host's
main region is read along its own article or main, or else as a whole, minus boilerplate;
pages of a host with the same longest
block count once as to blocks, a host whose pages are all the same has no constant text, and a
page whose blocks are all constant keeps them; a url without host shares one
wrapper; unclosed or truncated tags end with their parent; elements nested deeper than
``DEPTH`` lie side by side at that depth, in page order, so pages of any depth have a result;
repeated rows each get their result; constant blocks and lists of links aside, no text of a region is cut.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.common import of, written
from sparkprep.llm.url_filter import host_of
from sparkprep.session import ship_package

#: Decisions about hosts are broadcast up to this many hashes in all.
BROADCAST_HASHES = 2 << 20
#: Paths that a task adds up before it passes them on, and hosts whose decisions it keeps.
PATHS_KEPT, HOSTS_KEPT = 200_000, 2_000
#: A path belongs to the wrapper if it is on this share of the host's pages.
SHARE = 0.05

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(script|style|noscript|template|textarea|select|iframe|svg|title)\b[^>]*>.*?(?:</\1\s*>|$)"
    r"|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"""|</?[a-zA-Z](?:[^<>"']|"[^"]*"|'[^']*')*>|</?[a-zA-Z][^<>]*(?:>|$)|[^<]+|<""", re.S | re.I)
TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
MARKS = re.compile(r"""(?<![^\s"'])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
MARK_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Element names by kind.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small "
                   "span strike strong sub sup time tt u var wbr label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tbody thead article main body section div root".split())
DROPPED = frozenset("head nav header footer aside form menu button fieldset dialog object audio video "
                    "canvas map datalist output".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words of class, id and role that mark boilerplate.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense adslot banner banners sponsor sponsors "
    "sponsored promo promos promotion promoted nav navbar navigation navi menu menus breadcrumb breadcrumbs "
    "header masthead topbar footer foot bottombar sidebar sidebars aside complementary contentinfo cookie "
    "cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay dialog "
    "newsletter subscribe subscription signup login signin register search searchbox form forms share sharing "
    "social related recommended recommendations recommendation widget widgets comment comments commentlist "
    "disqus reply replies respond discussion discussions pagination pager paging toolbar skip tagcloud "
    "copyright disclaimer teaser teasers outbrain taboola".split())
#: Those that count on article and main themselves, and words after which none counts.
NOT_MAIN = frozenset("ad ads advert advertisement sponsored promo teaser teasers related recommended comment "
                     "comments reply replies".split())
NEGATED = frozenset("has with without no".split())
#: Inside the main region these, like listed words, count only with evidence from the contents.
MAYBE_TEXT = frozenset("header footer aside".split())
#: Elements that are text whatever their words say, the single paragraphs first; words of
#: comment groups.
PARAGRAPHS = HEADINGS | frozenset("p blockquote pre caption dt dd figcaption".split())
TEXT_TAGS = PARAGRAPHS | frozenset("table thead tbody tfoot tr td th html body article main".split())
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
CONTROLS = frozenset("form button fieldset input".split())
#: Share of characters in links from which an element is mostly links.
LINKED = 0.6
LISTS = frozenset("ul ol dl div section nav header footer aside table".split())
#: Text on more than this share of a host's pages, and on so many at least, is the host's own.
MOST, LEAST_PAGES = 0.5, 3
MAIN_TAGS = frozenset(("article", "main"))
#: Nesting that is kept as such; see _placed().
DEPTH = 120


def marks_of(tag_text: str) -> tuple[str, ...]:
    """Lower-cased words of class, id and role, digits left out."""
    words: dict[str, None] = {}
    for m in MARKS.finditer(tag_text):
        for w in MARK_WORD.findall(m[2]):
            if not w.isdigit():
                words[w.lower()] = None
    return tuple(words)


def dropped(tag: str, marks: tuple[str, ...]) -> bool:
    if tag in DROPPED:
        return True
    if not marks or tag in ("html", "body"):
        return False
    words = NOT_MAIN if tag in MAIN_TAGS else BOILERPLATE
    return any(m in words and before not in NEGATED for before, m in zip(("", *marks), marks))


class Node:
    """An element: its tag, words, and parts (nodes and (text, in_link) pairs) in order."""

    __slots__ = ("tag", "marks", "parts", "held")

    def __init__(self, tag: str, marks: tuple[str, ...] = ()):
        self.tag, self.marks, self.parts = tag, marks, []
        self.held: tuple[int, int, bool] | None = None  # of _contents()

    @property
    def key(self) -> str:
        return ".".join((self.tag, *self.marks))


def _placed(stack: list[Node], part: Node | tuple[str, bool]) -> None:
    """Adds the part to the innermost open element. Elements nested deeper than DEPTH lie side by
    side in the one at that depth, as in browsers; one that goes on after an inner one has closed
    is opened anew there, so text keeps its order."""
    if len(stack) > DEPTH:
        level, node = stack[DEPTH - 1], stack[-1]
        if type(part) is Node:
            node = level
        elif level.parts[-1] is not node:
            stack[-1] = node = Node(node.tag, node.marks)
            level.parts.append(node)
        node.parts.append(part)
    else:
        stack[-1].parts.append(part)


def parse(text: str) -> Node:
    """The page as nested tokens; comments, scripts, styles and the title are left out."""
    root = Node("root")
    stack, links = [root], 0
    open_tags: Counter[str] = Counter()  # of the stack, so that a stray end tag costs no search
    for m in TOKEN.finditer(text):
        s = m[0]
        if s[0] != "<" or len(s) == 1:
            _placed(stack, (s, links > 0))
            continue
        if m[1] or s[1] in "!?":
            continue
        name = TAG.match(s)[1].lower()
        if s[1] == "/":
            if name in INLINE:
                links -= name == "a" and links > 0
                if stack[-1].tag != name:
                    continue
            if open_tags[name]:
                while True:
                    tag = stack.pop().tag
                    open_tags[tag] -= 1
                    if tag == name:
                        break
            continue
        if name in VOID:
            if name == "hr":
                _placed(stack, Node("hr"))
            elif name == "br":
                _placed(stack, (" ", False))
            continue
        marks = marks_of(s) if "=" in s else ()
        if name in INLINE:
            links += name == "a"
            if not dropped(name, marks):
                continue
        if s.endswith("/>") and name in INLINE:
            continue
        if name not in INLINE:
            links = 0
            closes = CLOSED_BY.get(name)
            if closes and any(open_tags[c] for c in closes):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in closes:
                        open_tags.subtract(n.tag for n in stack[k:])
                        del stack[k:]
                        break
                    if stack[k].tag in SCOPES:
                        break
            if stack[-1].tag == "p":
                open_tags[stack.pop().tag] -= 1
        node = Node(name, marks)
        _placed(stack, node)
        stack.append(node)
        open_tags[name] += 1
    return root


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little",
                          signed=True)


#: The two kinds of paths start here: with class and id words, and by element names alone.
ROOT, PLAIN = 0, 1


@lru_cache(maxsize=1 << 16)
def below(above: int, key: str) -> int:
    """The path of an element of this key under the path ``above``."""
    return _hash(f"{above}/{key}")


@dataclass
class Shape:
    """A path of the wrapper: the path above it, the plain path of the same elements (of a plain
    path its own), the element's key, pages that have it, characters and those in links, the
    least and greatest hash of a page's text there (equal unless it is a slot), and pages on
    which neighbours repeat it."""

    above: int
    plain: int
    key: str
    pages: int
    ch: int
    lk: int
    low: int
    high: int
    repeated: int

    def add(self, other: Shape) -> None:
        self.pages += other.pages
        self.ch += other.ch
        self.lk += other.lk
        self.low, self.high = min(self.low, other.low), max(self.high, other.high)
        self.repeated += other.repeated


def shape(root: Node) -> dict[int, Shape]:
    """The wrapper of one page."""
    found: dict[int, Shape] = {}

    def note(path: int, above: int, plain: int, key: str, ch: int, lk: int, text: int) -> None:
        s = found.get(path)
        if s is None:
            found[path] = Shape(above, plain, key, 1, ch, lk, text, text, 0)
        else:
            s.ch, s.lk = s.ch + ch, s.lk + lk
            s.low = s.high = _hash(f"{s.low} {text}")

    def walk(node: Node, named: int, plain: int) -> tuple[int, int, int]:
        own = [p for p in node.parts if type(p) is tuple]
        words = " ".join("".join(t for t, _ in own).split())
        ch, lk, texts = len(words), sum(len(t) for t, link in own if link), [words]
        times: Counter[int] = Counter()
        for p in node.parts:
            if type(p) is Node:
                n, t = below(named, p.key), below(plain, p.tag)
                c, k, text = walk(p, n, t)
                note(n, named, t, p.key, c, k, text)
                note(t, plain, t, p.tag, c, k, text)
                times[n] += 1
                times[t] += 1
                ch, lk = ch + c, lk + k
                texts.append(str(text))
        for path, n in times.items():
            if n > 1:
                found[path].repeated = 1
        return ch, lk, _hash("\0".join(texts))

    ch, lk, text = walk(root, ROOT, PLAIN)
    found[ROOT] = Shape(ROOT, PLAIN, "root", 1, ch, lk, text, text, 0)
    found[PLAIN] = Shape(PLAIN, PLAIN, "root", 1, ch, lk, text, text, 0)
    return found


def joined(a: dict[int, Shape], b: dict[int, Shape]) -> dict[int, Shape]:
    """``a`` with the pages of ``b`` added."""
    for path, s in b.items():
        if path in a:
            a[path].add(s)
        else:
            a[path] = s
    return a


def trimmed(wrapper: dict[int, Shape]) -> dict[int, Shape]:
    """The wrapper without paths that too few pages have."""
    return {p: s for p, s in wrapper.items() if s.pages >= SHARE * wrapper[ROOT].pages}


def _children(wrapper: dict[int, Shape]) -> dict[int, list[int]]:
    kids: dict[int, list[int]] = defaultdict(list)
    for path in sorted(wrapper):
        if path not in (ROOT, PLAIN):
            kids[wrapper[path].above].append(path)
    return kids


def expression(wrapper: dict[int, Shape], path: int = ROOT) -> str:
    """The wrapper as a readable union-free regular expression: ? optional, + repeated, # a slot."""
    kids = _children(wrapper)

    def of_path(p: int) -> str:
        s = wrapper[p]
        body = "".join(map(of_path, kids[p])) or ("#" if s.low != s.high else "" if not s.ch else "text")
        optional, repeated = s.pages < wrapper[s.above].pages, s.repeated > 0
        return f"<{s.key}>{body}</>" + ("*" if optional and repeated else "?" if optional else "+" if repeated else "")

    return of_path(path)


def _dropped(key: str) -> bool:
    tag, *marks = key.split(".")
    return dropped(tag, tuple(marks))


@dataclass(frozen=True)
class Roles:
    """What a host's wrapper decides, as paths: the main region, what to leave out where there is
    none, lists and sections that are mostly links, and what repeats; and the hashes of the
    blocks that are on most of the host's pages."""

    main: frozenset[int] = frozenset()
    out: frozenset[int] = frozenset()
    links: frozenset[int] = frozenset()
    repeated: frozenset[int] = frozenset()
    constant: frozenset[int] = frozenset()

    def left_out(self, node: Node, path: tuple[int, int]) -> bool:
        """Whether an element inside the main region is no text: by its name where that never
        holds text, by a listed word only together with links, a form or repeated comments."""
        if node.tag in DROPPED and node.tag not in MAYBE_TEXT:
            return True
        if node.tag in LISTS and _in(path, self.links):
            ch, lk, _ = _contents(node)
            if lk > LINKED * ch:
                return True
        if node.tag in TEXT_TAGS or not dropped(node.tag, node.marks):
            return False
        ch, lk, controls = _contents(node)
        return controls or lk > LINKED * ch or self._comments(node, path)

    def _comments(self, node: Node, path: tuple[int, int]) -> bool:
        if not COMMENTS.intersection(node.marks):
            return False
        return _in(path, self.repeated) or any(
            type(p) is Node and (p.tag in ("li", "article") or COMMENTS.intersection(p.marks))
            and _in(_under(path, p), self.repeated) for p in node.parts)


def _under(path: tuple[int, int], node: Node) -> tuple[int, int]:
    return below(path[0], node.key), below(path[1], node.tag)


def _in(path: tuple[int, int], paths: frozenset[int]) -> bool:
    return path[0] in paths or path[1] in paths


def decided(wrapper: dict[int, Shape], constant: Iterable[int] = (), region: bool = True) -> Roles:
    """The roles of a (trimmed) wrapper's paths; without ``region`` only article and main are one."""
    if ROOT not in wrapper:
        return Roles(constant=frozenset(constant))
    kids, top = _children(wrapper), wrapper[ROOT]
    differ = top.low != top.high

    def fixed(s: Shape) -> bool:
        return differ and s.pages > 1 and s.low == s.high

    main = _explicit(wrapper, kids, ROOT) or _explicit(wrapper, kids, PLAIN)
    out: set[int] = set()
    if not main and region:
        weights: dict[int, int] = {}

        def weight(path: int) -> int:  # characters in slots outside links and boilerplate
            if path not in weights:
                s = wrapper[path]
                weights[path] = 0 if fixed(s) or _dropped(s.key) else max(0, s.ch - s.lk - sum(
                    max(0, wrapper[k].ch - wrapper[k].lk) - weight(k) for k in kids[path]))
            return weights[path]

        def inner(path: int) -> int | None:
            best = max(kids[path], key=weight, default=None)
            if best is None or weight(best) < 0.6 * max(1, weight(path)) or wrapper[best].repeated \
                    or 2 * wrapper[best].pages <= wrapper[path].pages \
                    or wrapper[best].key.split(".")[0] in PARAGRAPHS:  # one long paragraph is no region
                return None
            return best

        at = ROOT
        while (step := inner(at) or inner(wrapper[at].plain)) is not None:
            at = step
        if at not in (ROOT, PLAIN):
            main = {at}
        else:
            out = {p for p, s in wrapper.items() if s.pages >= LEAST_PAGES and s.pages > MOST * top.pages
                   and (fixed(s) or s.pages > 1 and s.key.split(".")[0] in LISTS and s.lk > LINKED * max(1, s.ch))}
    todo = [*main, *(wrapper[p].plain for p in main if wrapper[p].plain in wrapper)]
    whole, linked = sum(wrapper[p].ch for p in main), sum(wrapper[p].lk for p in main)
    inside: set[int] = set()
    while todo:
        for k in kids[todo.pop()]:
            if k not in inside:
                inside.add(k)
                todo.append(k)
    links = {p for p in inside if linked <= LINKED * whole and wrapper[p].pages > 1
             and wrapper[p].key.split(".")[0] in LISTS and wrapper[p].lk > LINKED * wrapper[p].ch}
    return Roles(frozenset(main), frozenset(out), frozenset(links),
                 frozenset(p for p in inside if wrapper[p].repeated), frozenset(constant))


def _explicit(wrapper: dict[int, Shape], kids: dict[int, list[int]], path: int) -> set[int]:
    """Paths of article and main outside boilerplate, an article inside main winning."""
    found: set[int] = set()
    for k in kids[path]:
        tag, *marks = wrapper[k].key.split(".")
        if dropped(tag, tuple(marks)):
            continue
        inner = {k} if tag == "article" else _explicit(wrapper, kids, k)
        if not inner and (tag == "main" or "main" in marks and wrapper[k].ch):
            inner = {k}
        found |= inner
    return found


def _contents(node: Node) -> tuple[int, int, bool]:
    """Characters, those in links, and whether the element holds a form's parts; kept on the node."""
    if node.held is None:
        ch, lk, controls = 0, 0, node.tag in CONTROLS
        for p in node.parts:
            if type(p) is tuple:
                n = len("".join(p[0].split()))
                ch, lk = ch + n, lk + n * p[1]
            else:
                c, k, inner = _contents(p)
                ch, lk, controls = ch + c, lk + k, controls or inner
        node.held = (ch, lk, controls)
    return node.held


def _inline(node: Node) -> str:
    return "".join(p[0] if type(p) is tuple else _inline(p) for p in node.parts)


def _line(parts: list[str]) -> str:
    return " ".join(entities.unescape("".join(parts)).split())


def block_hashes(root: Node) -> tuple[int, list[int]]:
    """What tells the page from others (its longest block outside links) and its blocks."""
    found: dict[str, None] = {}
    longest = ""

    def walk(node: Node) -> None:
        nonlocal longest
        line: list[str] = []
        linked = 0

        def flush() -> None:
            nonlocal longest, linked
            text = _line(line)
            if text:
                found[text] = None
                if len(text) > len(longest) and linked <= LINKED * len(text):
                    longest = text
            line.clear()
            linked = 0

        for p in node.parts:
            if type(p) is tuple:
                line.append(p[0])
                linked += len(p[0]) * p[1]
            elif p.tag in INLINE:
                ch, lk, controls = _contents(p)
                if not controls and lk <= LINKED * ch:
                    line.append(_inline(p))
            else:
                flush()
                if p.tag not in DROPPED or p.tag in MAYBE_TEXT:
                    walk(p)
        flush()

    walk(root)
    return _hash(longest), [_hash(t) for t in found]


def varying(blocks: list[tuple[str, Node, Node | None]], constant: frozenset[int]) -> list[str]:
    """The texts without the constant ones; a constant heading stays before text that stays,
    a constant cell in a table that varies. All stay if none varies."""
    texts = [t for t, _, _ in blocks]
    if not constant:
        return texts
    same = [_hash(t) in constant for t in texts]
    if all(same):
        return texts
    tables = {id(table) for (_, _, table), c in zip(blocks, same) if table is not None and not c}
    out, follows = [], False
    for (text, node, table), c in zip(reversed(blocks), reversed(same)):
        if not c or table is not None and id(table) in tables:
            follows = True
            out.append(text)
        elif node.tag not in HEADINGS:
            follows = False
        elif follows:
            out.append(text)
    return out[::-1]


def _blocks(node: Node, roles: Roles, out: list[tuple[str, Node, Node | None]], inside: bool, main_only: bool,
            path: tuple[int, int] = (ROOT, PLAIN), table: Node | None = None) -> None:
    """Adds the blocks of text under ``node`` in page order, with their elements and tables."""
    inside = inside or _in(path, roles.main)
    if node.tag in ("table", "dl"):
        table = node
    take = inside or not main_only
    line: list[str] = []

    def flush() -> None:
        text = _line(line)
        if text and take:
            out.append((text, node, table))
        line.clear()

    for p in node.parts:
        if type(p) is tuple:
            line.append(p[0])
        elif p.tag in INLINE:  # an inline element marked as boilerplate: left out if it is a link
            ch, lk, controls = _contents(p) if inside else (0, 0, True)
            if not controls and lk <= LINKED * ch:
                line.append(_inline(p))
        else:
            flush()
            at = _under(path, p)
            if not (roles.left_out(p, at) if inside else dropped(p.tag, p.marks) or at[0] in roles.out):
                _blocks(p, roles, out, inside, main_only, at, table)
    flush()


def _holds(node: Node, paths: frozenset[int], path: tuple[int, int] = (ROOT, PLAIN)) -> bool:
    if not paths:
        return False
    for p in node.parts:
        if type(p) is Node and not dropped(p.tag, p.marks):
            at = _under(path, p)
            if _in(at, paths) or _holds(p, paths, at):
                return True
    return False


def main_text(page: str, roles: Roles) -> str:
    """The page's main text along its host's roles."""
    root, out = parse(page), []
    held = _holds(root, roles.main)
    if not held:  # unlike its host's other pages: its own article or main
        own = decided(shape(root), roles.constant, region=False)
        held = bool(own.main)
        roles = own if held or roles.main else roles
    _blocks(root, roles, out, False, held)
    return "\n\n".join(varying(out, roles.constant))


PATH = ("host string, path bigint, above bigint, plain bigint, key string, pages bigint, ch bigint, lk bigint, "
        "low bigint, high bigint, repeated bigint")
FOUND = PATH + ", page bigint, blocks array<bigint>"
ROLES = "host string, main array<bigint>, out array<bigint>, links array<bigint>, repeated array<bigint>"


def inferred(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows of two kinds: a task's counts of a path of a host, and a page's identity and block hashes."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.coalesce(host_of(of(pages, url_col)), F.lit("")).alias("host"),
                        of(pages, html_col).alias("html"))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 6, pa.int64(),
             pa.list_(pa.int64())]
    names = [f.split()[0] for f in FOUND.split(", ")]

    def batch_of(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def paths(known: dict[str, dict[int, Shape]]) -> pa.RecordBatch:
        found = [(h, p, s.above, s.plain, s.key, s.pages, s.ch, s.lk, s.low, s.high, s.repeated, None, None)
                 for h, wrapper in known.items() for p, s in wrapper.items()]
        return batch_of([list(c) for c in zip(*found)])

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[int, Shape]] = {}
        held = 0
        for batch in batches:
            hosts, ids, blocks = [], [], []
            for host, page in zip(*(c.to_pylist() for c in batch.columns)):
                if page:
                    root = parse(page)
                    whole = known.setdefault(host, {})
                    held -= len(whole)
                    held += len(joined(whole, shape(root)))
                    own, texts = block_hashes(root)
                    hosts.append(host)
                    ids.append(own)
                    blocks.append(texts)
                if held >= PATHS_KEPT:
                    yield paths(known)
                    known, held = {}, 0
            n = len(hosts)
            yield batch_of([hosts, *[[None] * n] * 10, ids, blocks])
        if known:
            yield paths(known)

    return rows.mapInArrow(infer, FOUND)


def constant_blocks(found: DataFrame) -> DataFrame:
    """c_host and constant, the hashes of the blocks that are on most of the host's pages."""
    rows = found.where(F.col("page").isNotNull())
    n_pages = rows.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"))
    held = rows.select("host", "page", F.explode("blocks").alias("block"))
    held = held.groupBy("host", "page", "block").agg(F.lit(1).alias("one"))
    held = held.groupBy("host", "block").agg(F.count(F.lit(1)).alias("held"))
    held = held.where(F.col("held") >= LEAST_PAGES).join(n_pages, "host")
    return (held.where(F.col("held") > F.col("n_pages") * F.lit(MOST)).groupBy("host")
            .agg(F.sort_array(F.collect_list("block")).alias("constant")).withColumnRenamed("host", "c_host"))


def wrappers(found: DataFrame) -> DataFrame:
    """One row per path of a host's wrapper, in the columns of ``PATH``."""
    rows = found.where(F.col("path").isNotNull())
    whole = rows.where(F.col("path") == ROOT).groupBy(F.col("host").alias("w_host")).agg(
        F.sum("pages").alias("n_pages"))
    rows = rows.groupBy("host", "path").agg(
        *(F.min(c).alias(c) for c in ("above", "plain", "key")), *(F.sum(c).alias(c) for c in ("pages", "ch", "lk")),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("repeated").alias("repeated"))
    return rows.join(whole, F.col("host") == F.col("w_host")).where(
        F.col("pages") >= F.col("n_pages") * F.lit(SHARE)).drop("w_host", "n_pages")


def roles_of(paths: DataFrame) -> DataFrame:
    """One row per host: what its wrapper decides, in the columns of ``ROLES``."""
    columns = [c for c in paths.columns if c != "host"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                r = decided({row.pop("path"): Shape(**row) for row in rows})
                out.append({"host": host, "main": sorted(r.main), "out": sorted(r.out),
                            "links": sorted(r.links), "repeated": sorted(r.repeated)})
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pylist(out, pa.schema([("host", pa.string()), ("main", many), ("out", many),
                                                             ("links", many), ("repeated", many)]))

    return paths.groupBy("host").agg(F.collect_list(F.struct(*columns)).alias("paths")).mapInArrow(run, ROLES)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars (code points) of every page."""
    parts = written(inferred(pages, url_col, html_col), "blocks")
    found, same = roles_of(wrappers(parts)).withColumnRenamed("host", "w_host"), constant_blocks(parts)
    sets = ("main", "out", "links", "repeated", "constant")
    found = written(found.join(same, F.col("w_host") == F.col("c_host"), "left").drop("c_host"), "wrappers")
    size = found.agg(F.sum(sum((F.coalesce(F.size(c), F.lit(0)) for c in sets), F.lit(20)))).first()[0] or 0
    if size <= BROADCAST_HASHES:
        found = F.broadcast(found)
    rows = pages.select(of(pages, id_col).alias("id"), of(pages, url_col).alias("url"),
                        of(pages, html_col).alias("html"),
                        F.coalesce(host_of(of(pages, url_col)), F.lit("")).alias("host"))
    rows = rows.join(found, rows["host"] == found["w_host"], "left").select("id", "url", "html", "host", *sets)
    out = T.StructType([T.StructField(id_col, pages.schema[id_col].dataType),
                        T.StructField(url_col, pages.schema[url_col].dataType),
                        T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Roles] = {}
        for batch in batches:
            texts = []
            for at, (page, host) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if host not in known:
                    if len(known) >= HOSTS_KEPT:
                        known.clear()
                    known[host] = Roles(*(frozenset(batch.column(4 + k)[at].as_py() or ()) for k in range(len(sets))))
                texts.append(main_text(page, known[host]) if page else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             names=out.names)

    return rows.mapInArrow(run, out).withColumn("n_chars", F.length("text").cast("long"))
