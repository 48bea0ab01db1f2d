"""Main text of web pages by wrappers: union-free expressions inferred from pages of one host.

A page becomes a stream of block tags and text slots. Repeated neighbours fold into groups. The
streams of a host's pages are aligned one after another with the host's wrapper: slots with
different texts become variable, surplus tags become optional parts, or are taken into a repeated
group where they are another instance of it. Two wrappers are aligned in the same way, so tasks
infer partial wrappers of the hosts they meet, and these are merged, ``FAN_IN`` at a time, until
a host has one; a host with very many pages is no burden to one task.

Slots below navigation, headers, footers, sidebars, notices, adverts, forms and reader comments are
not article text, nor are lists whose text on a page is mostly links; on a page with ``article`` or
``main`` parts only slots in them are. Places whose slots the wrapper shows to have the same text on
``PAGES_OUTSIDE`` pages of different contents, in an article ``PAGES``, are not either. Contents
differ where the pages' own texts do, judged without the wrapper; copies of a page are one content
and make no text template. A wrapper is bounded; of slots beyond its
bound the evidence is kept place by place, added up on Spark.

Defined results: null and empty pages have empty text; pages whose URL is null or names no host
are judged each alone.
Broken markup is read as far as it goes: an unclosed comment or raw element (script, style, title
and the like) runs to the end of the page; a head ends before what cannot be in one; a button,
select, svg, canvas or template without an end tag ends at the next block or with its parent.
Text of math and object elements is text of the page. Repeated rows are extracted each. Empty tables give empty results.
"""

from __future__ import annotations

import bisect
import difflib
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.urls import host_and_path
from shelfwise.session import written

FAN_IN = 64
#: Wrappers of at most so many hosts are broadcast.
BROADCAST_HOSTS = 200_000
#: A wrapper grows by alignment to at most so many parts; of slots beyond the evidence is kept by
#: place, so that no text counts as template because another of its place was left out.
MAX_PARTS = 2_000
#: A slot is template where it is the same on so many pages of different contents; outside
#: articles fewer are enough.
PAGES = 3
PAGES_OUTSIDE = 2
#: Two stretches of parts are compared in full up to this product of their lengths.
COMPARED = 1_000_000
#: The longest repeated group, in parts, that folding looks for.
LONGEST_GROUP = 16

# Elements by their role in a page.
BLOCKS = frozenset(
    "html body div section article main aside nav header footer form fieldset ul ol li dl dt dd "
    "table thead tbody tfoot tr td th caption figure figcaption blockquote pre p h1 h2 h3 h4 h5 h6 "
    "address details summary menu dialog hgroup".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag, whatever it holds.
RAW = frozenset("script style noscript textarea iframe title xmp noembed noframes".split())
#: Their content is markup that a reader does not see as text of the page.
HIDDEN = frozenset("head button select svg canvas template annotation annotation-xml".split())
FOREIGN = frozenset(["svg", "math"])
NOT_ARTICLE = frozenset("nav header footer aside form fieldset menu dialog".split())
CLOSES_P = BLOCKS
#: Words of class, id and role values that name parts beside the article.
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|side-?bar|aside|"
    r"foot(?:er)?|header|masthead|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|"
    r"signup|login|search|share|sharing|social|related|recommend\w*|breadcrumbs?|pagination|pager|"
    r"comments?|replies|reply|discussion|disqus|respond|complementary|contentinfo|navigation)"
    r"(?:$|[\s_-]|\d)", re.I,
)

#: Words of a label that name the layout, and those that make an article one beside the article.
LAYOUT = re.compile(r"(?:has|with|no|without)-|(?:page-?)?layout|(?:page-?|site-?)?(?:wrapper|container|wrap)$", re.I)
COMMENT = re.compile(
    r"(?:^|[_-])(?:comments?|repl(?:y|ies)|respond|discussion|disqus|ads?|advert\w*|sponsor\w*|"
    r"promo\w*|related|recommend\w*)(?:$|[_-]|\d)", re.I)
HEADLINE = re.compile(r"(?:^|[_-])(?:header|masthead)(?:$|[_-]|\d)", re.I)

_START = re.compile(r"<(?:(?P<comment>!--)|(?P<other>[!?])|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*))")
_QUOTE_OR_END = re.compile("[>\"']")
_RAW_END = {name: re.compile(rf"</{name}(?:\s[^>]*|/[^>]*)?>", re.I) for name in RAW}
_LABEL = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_DIGITS = re.compile(r"\d+")
#: What a head holds; anything else ends it.
_OF_HEAD = frozenset("head base basefont bgsound link meta template".split())


class _Markup:
    """The tags, comments and declarations of a page, found from any place forward.

    A quoted value is skipped whole. Where a quote is not closed the tag ends at the next ``>``; once
    the quotes of a tag have taken every further ``>``, quotes mean nothing from there on. Without a
    further ``>`` there are no tags. So each part of a page is read a bounded number of times.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.final = {q: page.rfind(q) for q in "\"'"}
        self.quotes = True

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, name, "/" of an end tag, rest) of the first one from ``at`` on."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if at > self.last and page[at + 1 : at + 2] not in ("!", "?"):
                at += 1
                continue
            found = _START.match(page, at)
            if found is None:
                at += 1
                continue
            if not found["name"]:
                mark = "-->" if found["comment"] else ">"
                close = page.find(mark, at + (4 if found["comment"] else 0))
                return at, close + len(mark) if close >= 0 else len(page), "", "", ""
            close = self._end(found.end())
            return at, close + 1, found["name"], found["close"], page[found.end() : close]
        return None

    def _end(self, at: int) -> int:
        """The place of the ``>`` that ends a tag; there is one behind ``at``, or at it."""
        here = at
        while self.quotes and (mark := _QUOTE_OR_END.search(self.page, here)):
            if mark[0] == ">":
                return mark.start()
            if self.final[mark[0]] <= mark.start():  # not closed
                here = mark.end()
                break
            here = self.page.index(mark[0], mark.end()) + 1
        end = self.page.find(">", here)
        if end < 0:
            self.quotes = False
            end = self.page.find(">", at)
        return end


def _events(page: str) -> list[list]:
    """[kind, name or text, label] of everything in a page, kinds as in ``tokens``."""
    out, at, foreign, markup = [], 0, 0, _Markup(page)
    while found := markup.after(at):
        start, end, name, close, rest = found
        if start > at:
            out.append(["text", page[at:start], ""])
        at = end
        name = name.lower()
        itself = bool(foreign or name in FOREIGN) and rest.endswith("/")
        if name in FOREIGN and not itself:
            foreign = max(0, foreign + (-1 if close else 1))
        if name in BLOCKS:
            foreign = foreign if close else 0
            values = [] if close else _LABEL.findall(rest)
            label = " ".join(a or b or c for a, b, c in values).strip()
            out.append(["close" if close else "open", name, label])
        elif name in HIDDEN and not itself:
            out.append(["show" if close else "hide", name, ""])
        elif name in RAW and not close and not itself:
            out.append(["raw", name, ""])
            ending = _RAW_END[name].search(page, at)
            at = ending.end() if ending else len(page)
        elif name in VOID:
            out.append(["break", name, ""])
        elif name:
            out.append(["link" if name == "a" else "inline", name, close or ""])
    if at < len(page):
        out.append(["text", page[at:], ""])
    return out


def tokens(page: str | None) -> Iterator[tuple[str, str, str]]:
    """("open", name, label), ("close", name, ""), ("text", text, ""), ("break", name, ""),
    ("hide", name, "closed" or ""), ("show", name, ""), ("link", "a", "" or "/"); raw elements and comments are left out.

    A hidden element is "closed" where an end tag of its own follows. A head ends before whatever
    cannot be in one.
    """
    events = _events(page or "")
    open_at: dict[str, list[int]] = {}
    for k, (kind, name, _) in enumerate(events):
        if kind == "hide":
            open_at.setdefault(name, []).append(k)
        elif kind == "show" and open_at.get(name):
            events[open_at[name].pop()][2] = "closed"
    in_head, templates = False, 0
    for kind, name, label in events:
        if in_head and not templates and not (
            kind == "raw" or kind == "text" and not name.strip() or name in _OF_HEAD
        ):
            in_head = False
            yield "show", "head", ""
        if name == "head" and kind in ("hide", "show"):
            in_head = kind == "hide"
        if in_head and name == "template":
            templates = max(0, templates + (1 if label else -1 if kind == "show" else 0))
        if kind not in ("raw", "inline"):
            yield kind, name, label


def placed(page: str | None) -> Iterator[tuple[str, object]]:
    """("tag", tag), ("text", (path, text, linked, list)): tags opened and closed as a browser would.

    A path is the open blocks with their labels, from the outermost on; ``linked`` counts the
    text's characters in links, which end with their parent at the latest. ``list``
    numbers the innermost list. Nothing in a hidden
    element is given; one without an end tag ends at the next block, or with its parent.
    """
    stack: list[str] = []
    held: list[str] = []
    linked: list[str] = []
    link: int | None = None  # the place in the stack
    lists: list[tuple[int, int]] = [(0, 0)]  # (place in the stack, number)
    n_lists = 0
    hidden: list[tuple[int, str, str]] = []  # (place in the stack, name, "closed" or "")

    def text() -> Iterator[tuple[str, object]]:
        joined = " ".join(unescape("".join(held)).split())
        within = len("".join(unescape("".join(linked)).split()))
        held.clear()
        linked.clear()
        if joined:
            yield "text", (tuple(stack), joined, within, lists[-1][1])

    def down_to(depth: int) -> Iterator[tuple[str, object]]:
        """Close what is open from ``depth`` on, and what is hidden in it."""
        while len(stack) > depth:
            name = stack.pop().split(".", 1)[0]
            if not hidden or hidden[0][0] > len(stack):
                yield "tag", f"/{name}"
            while hidden and hidden[-1][0] > len(stack):
                hidden.pop()
            while lists[-1][0] > len(stack):
                lists.pop()

    for kind, name, label in tokens(page):
        if kind == "text":
            if not hidden:
                held.append(name)
                if link is not None:
                    linked.append(name)
            continue
        if kind == "link":
            link = None if label or hidden else len(stack)
            continue
        if kind == "break":
            held.append(" ")
            continue
        if kind == "hide":
            hidden.append((len(stack), name, label))
            continue
        if kind == "show":
            depth = next((k for k in range(len(hidden) - 1, -1, -1) if hidden[k][1] == name), None)
            if depth is not None:
                yield from down_to(hidden[depth][0])
                del hidden[depth:]
            continue
        yield from text()
        if kind == "open":
            while hidden and (not hidden[-1][2] or name == "body"):
                yield from down_to(hidden[-1][0])
                hidden.pop()
            if stack and stack[-1] == "p" and name in CLOSES_P:
                yield from down_to(len(stack) - 1)
            own = f"{name}.{_DIGITS.sub('0', label)}" if label else name
            stack.append(own)
            if name in ("ul", "ol", "dl", "menu"):
                n_lists += 1
                lists.append((len(stack), n_lists))
            if not hidden:
                yield "tag", own
        else:
            depth = next(
                (k for k in range(len(stack) - 1, -1, -1) if stack[k].split(".", 1)[0] == name), None
            )
            if depth is not None:
                yield from down_to(depth)
        if link is not None and len(stack) < link:
            link = None
    yield from text()
    yield from down_to(0)


# --- wrappers -------------------------------------------------------------------------
# A part is a list: ["tag", tag], ["text", constant or None, contents, place], ["opt", parts] or
# ["rep", parts]. The contents are digests of pages' own texts, the ``PAGES`` least ones, so that
# copies of a page count as one; the place is a hash of the slot's path.


def parts_of(page: str | None) -> list:
    pieces = [*placed(page)]
    texts = [value for kind, value in pieces if kind == "text"]
    own = "\0".join(text for (_, text, *_), keep in zip(texts, own_rules(texts), strict=True) if keep)
    contents = [xxhash.xxh32_intdigest(own.encode("utf-8", "replace"))]
    return fold([
        ["tag", value] if kind == "tag" else ["text", value[1], contents, place_of(value[0])[0]]
        for kind, value in pieces
    ])


def key(part: list):
    if part[0] == "tag":
        return part[1]
    if part[0] == "text":
        return f"#{part[3]}"
    return (part[0], *map(key, part[1]))


def merged(a: list, b: list) -> list:
    """Two parts with the same key as one."""
    if a[0] == "tag":
        return a
    if a[0] == "text":
        contents = a[2] if a[2] == b[2] else sorted({*a[2], *b[2]})[:PAGES]
        return ["text", a[1] if a[1] == b[1] else None, contents, a[3]]
    return [a[0], [merged(x, y) for x, y in zip(a[1], b[1], strict=True)]]


def fold(parts: list) -> list:
    """Neighbouring repetitions as repeated groups, from short to long ones."""
    changed = True
    while changed:
        changed = False
        keys = [key(p) for p in parts]
        for size in range(1, min(LONGEST_GROUP, len(parts) // 2) + 1):
            out, k = [], 0
            while k < len(parts):
                own = keys[k : k + size]
                times = 1
                while len(own) == size and keys[k + times * size : k + (times + 1) * size] == own:
                    times += 1
                balanced = size > 1 or own != [] and not isinstance(own[0], str)
                if times > 1 and balanced:
                    body = parts[k : k + size]
                    for t in range(1, times):
                        body = [merged(x, y) for x, y in zip(
                            body, parts[k + t * size : k + (t + 1) * size], strict=True)]
                    out.append(body[0] if size == 1 and body[0][0] == "rep" else ["rep", body])
                    k += times * size
                    changed = True
                else:
                    out.append(parts[k])
                    k += 1
            if changed:
                parts = out
                break
    return parts


def _absorbed(group: list, segment: list) -> list | None:
    """The repeated group with ``segment`` as further instances of it, if it is that."""
    if group[0] != "rep":
        return None
    body, size = group[1], len(group[1])
    if [key(p) for p in segment] == [key(group)]:
        return merged(group, segment[0])
    if not segment or len(segment) % size:
        return None
    wanted = [key(p) for p in body]
    for k in range(0, len(segment), size):
        if [key(p) for p in segment[k : k + size]] != wanted:
            return None
        body = [merged(x, y) for x, y in zip(body, segment[k : k + size], strict=True)]
    return ["rep", body]


def noted(beyond: dict[int, list], part: list) -> None:
    """Add a slot to the evidence by place."""
    place = part[3]
    beyond[place] = merged(beyond[place], part) if place in beyond else part


def opcodes(a: list, b: list) -> list[tuple[str, int, int, int, int]]:
    """How ``a`` becomes ``b``, as ``difflib`` tells it: runs that are equal and runs that are not.

    Equal ends come off first. What is left is compared in full while the product of its lengths is
    at most ``COMPARED``; otherwise it is cut at keys that occur once on both sides, in the longest
    order that both have, and a stretch without such keys counts as different.
    """
    equal: list[tuple[int, int, int]] = []  # (from in a, from in b, length)
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        n = 0
        while i + n < j and k + n < m and a[i + n] == b[k + n]:
            n += 1
        equal.append((i, k, n))
        i, k, n = i + n, k + n, 0
        while j - n > i and m - n > k and a[j - n - 1] == b[m - n - 1]:
            n += 1
        j, m = j - n, m - n
        equal.append((j, m, n))
        if i == j or k == m:
            continue
        if (j - i) * (m - k) <= COMPARED:
            blocks = difflib.SequenceMatcher(None, a[i:j], b[k:m], False).get_matching_blocks()
            equal.extend((i + x, k + y, n) for x, y, n in blocks)
            continue
        anchors = _anchors(a, b, i, j, k, m)
        edges = [(i, k), *((x + 1, y + 1) for x, y in anchors)]
        equal.extend((x, y, 1) for x, y in anchors)
        if anchors:
            ends = [*anchors, (j, m)]
            todo.extend((x, u, y, v) for (x, y), (u, v) in zip(edges, ends, strict=True))
    out, i, k = [], 0, 0
    for x, y, n in [*sorted(e for e in equal if e[2]), (len(a), len(b), 0)]:
        if i < x or k < y:
            kind = "replace" if i < x and k < y else "delete" if i < x else "insert"
            out.append((kind, i, x, k, y))
        if n and out and out[-1][0] == "equal" and out[-1][2] == x and out[-1][4] == y:
            _, p, _, q, _ = out.pop()
            out.append(("equal", p, x + n, q, y + n))
        elif n:
            out.append(("equal", x, x + n, y, y + n))
        i, k = x + n, y + n
    return out


def _anchors(a: list, b: list, i: int, j: int, k: int, m: int) -> list[tuple[int, int]]:
    """Places of keys that occur once in both stretches, as many as stand in one order."""
    once_a, once_b = Counter(a[i:j]), Counter(b[k:m])
    at = {key_: y for y, key_ in enumerate(b[k:m], k) if once_b[key_] == 1}
    pairs = [(x, at[c]) for x, c in enumerate(a[i:j], i) if once_a[c] == 1 and c in at]
    tops: list[int] = []  # of each length the chain with the least end
    ends: list[int] = []
    before: list[int | None] = []
    for n, (_, y) in enumerate(pairs):
        slot = bisect.bisect_left(ends, y)
        before.append(tops[slot - 1] if slot else None)
        if slot == len(ends):
            ends.append(y)
            tops.append(n)
        else:
            ends[slot], tops[slot] = y, n
    chain, n = [], tops[-1] if tops else None
    while n is not None:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


def align(a: list, b: list, beyond: dict[int, list] | None = None, most: int = MAX_PARTS) -> list:
    """The wrapper of everything that wrapper ``a`` or wrapper ``b`` describes.

    What ``a`` holds always stays. With ``beyond``, parts of ``b`` that would let the wrapper grow
    over ``most`` go there as evidence by place.
    """
    room = None if beyond is None else most - len(a)
    keys_a, keys_b = [key(p) for p in a], [key(p) for p in b]
    if keys_a == keys_b:
        return [merged(x, y) for x, y in zip(a, b, strict=True)]
    out: list = []
    for what, i, j, k, m in opcodes(keys_a, keys_b):
        if what == "equal":
            out += [merged(x, y) for x, y in zip(a[i:j], b[k:m], strict=True)]
            continue
        left, right = a[i:j], b[k:m]
        for one, other in ((left, right), (right, left)):
            # One side has a group where the other has single instances of it.
            if len(one) == 1 and other and (group := _absorbed(one[0], other)):
                out.append(group)
                break
        else:
            for segment in (left, right):
                if not segment:
                    continue
                group = _absorbed(out[-1], segment) if out else None
                size = len(segment)
                if group:
                    out[-1] = group
                elif size > 1 and len(out) >= size and [key(p) for p in out[-size:]] == [
                    key(p) for p in segment
                ]:
                    out[-size:] = [["rep", [merged(x, y) for x, y in zip(
                        out[-size:], segment, strict=True)]]]
                elif segment is right and room is not None and room <= 0:
                    for part in slots(segment):
                        noted(beyond, part)
                else:
                    if segment is right and room is not None:
                        room -= 1
                    single = size == 1 and segment[0][0] == "opt"
                    out.append(segment[0] if single else ["opt", segment])
    return out


def expression(parts: list) -> str:
    """The wrapper as a union-free regular expression."""
    def one(part: list) -> str:
        if part[0] == "tag":
            return f"<{part[1]}>"
        if part[0] == "text":
            return "#" if part[1] is None else part[1]
        return f"({expression(part[1])}){'+' if part[0] == 'rep' else '?'}"

    return "".join(map(one, parts))


def slots(parts: list) -> Iterator[list]:
    """Every text slot."""
    for part in parts:
        if part[0] == "text":
            yield part
        elif part[0] != "tag":
            yield from slots(part[1])


def _names_beside(element: str, inside: bool, holds: bool) -> bool:
    """Whether the label of one element says that it lies beside the article. ``inside``: it is in
    an article; ``holds``: an article is in it."""
    name, _, label = element.partition(".")
    if not label or name in ("html", "body"):
        return False
    words = [w for w in label.split() if not LAYOUT.match(w)]
    if name in ("article", "main"):
        return any(COMMENT.search(w) for w in words)
    if inside:  # a header within an article holds its headline
        words = [w for w in words if not HEADLINE.search(w)]
    if holds and len(words) < len(label.split()):
        return False  # a word of layout: the others say how the page is laid out
    return any(BESIDE.search(w) for w in words)


def beside_article(path: tuple[str, ...]) -> bool:
    """Whether a path lies in navigation, adverts, comments and the like.

    A header inside an article holds its headline; it counts as article. Labels that speak of the
    layout (``has-sidebar``, ``layout sidebar-right``) do not speak of what the element holds, and
    an article is beside the article only if it is a comment or a recommendation.
    """
    names = [element.split(".", 1)[0] for element in path]
    articles = [k for k, name in enumerate(names) if name in ("article", "main")]
    first, last = (articles[0], articles[-1]) if articles else (len(path), -1)
    for k, (name, element) in enumerate(zip(names, path, strict=True)):
        if name in NOT_ARTICLE and not (k > first and name == "header"):
            return True
        if _names_beside(element, k > first, k < last):
            return True
    return False


def in_article(path: tuple[str, ...]) -> bool:
    return any(e.split(".", 1)[0] in ("article", "main") for e in path)


def _hashed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) >> 1


@lru_cache(100_000)
def place_of(path: tuple[str, ...]) -> tuple[int, bool, bool, bool]:
    """A hash of a path, whether it is beside the article, in one, in a list."""
    listed = any(e.split(".", 1)[0] in ("li", "dt", "dd") for e in path)
    return _hashed("\0".join(path)), beside_article(path), in_article(path), listed


def own_rules(texts: list[tuple[tuple, str, int, int]]) -> list[bool]:
    """For each (path, text, linked, list) of a page whether it is article text as far as the
    page tells: a list whose text is mostly links is not."""
    places = [place_of(path) for path, *_ in texts]
    article = any(inside and not beside for _, beside, inside, _ in places)
    plain: dict[int, int] = {}  # for each list its characters outside links, less those in links
    for (*_, listed), (_, text, linked, number) in zip(places, texts, strict=True):
        if listed:
            own = len("".join(text.split())) - 2 * linked
            plain[number] = plain.get(number, 0) + own
    return [
        not beside and (inside or not article) and not (listed and plain[number] < 0)
        for (_, beside, inside, listed), (*_, number) in zip(places, texts, strict=True)
    ]


def decisions(parts: list) -> dict[int, int]:
    """For each place of the slots over how many different contents its slots are constant,
    counted up to ``PAGES``; 0 where a slot varies."""
    found: dict[int, int] = {}
    for _, constant, contents, place in slots(parts):
        pages = 0 if constant is None else len(contents)
        found[place] = min(pages, found.get(place, pages))
    return found


def text_of(page: str | None, known: dict[int, int]) -> str:
    """The article of a page, given what is known of its host's slots."""
    texts = [value for kind, value in placed(page) if kind == "text"]
    out = []
    for (path, text, *_), keep in zip(texts, own_rules(texts), strict=True):
        place, _, inside, _ = place_of(path)
        if keep and known.get(place, 0) < (PAGES if inside else PAGES_OUTSIDE):
            out.append(text)
    return " ".join(out)


# --- on Spark -------------------------------------------------------------------------


#: Rows of two kinds: a host's wrapper as JSON, and evidence of one place beyond it.
_ROWS = "host string, wrapper string, place long, constant long, contents array<long>"


def _rows(found: dict[str, tuple[list, dict]]) -> dict[str, pa.Array]:
    beyond = [(host, part) for host, (_, more) in found.items() for part in more.values()]
    constants = [None if part[1] is None else _hashed(part[1]) for _, part in beyond]
    gap, none = [None] * len(found), [None] * len(beyond)
    return {
        "host": pa.array([*found, *(host for host, _ in beyond)], pa.string()),
        "wrapper": pa.array([*(json.dumps(w) for w, _ in found.values()), *none], pa.string()),
        "place": pa.array([*gap, *(part[3] for _, part in beyond)], pa.int64()),
        "constant": pa.array([*gap, *constants], pa.int64()),
        "contents": pa.array([*gap, *(part[2] for _, part in beyond)], pa.list_(pa.int64())),
    }


def wrappers(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, wrapper as JSON) for every host of ``pages`` (host, html), and the evidence beyond
    the wrappers: (host, place, constant, contents)."""
    bound = MAX_PARTS

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[list, dict]] = {}
        for batch in batches:
            for host, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = parts_of(page)
                whole, beyond = known.get(host, (parts, {}))
                known[host] = (align(whole, parts, beyond, bound) if host in known else parts), beyond
        yield pa.RecordBatch.from_pydict(_rows(known))

    def merge(table: pa.Table) -> pa.Table:
        whole, beyond = None, {}
        for own in sorted(table.column("wrapper").to_pylist()):
            parts = json.loads(own)
            whole = parts if whole is None else align(whole, parts, beyond, bound)
        return pa.table(_rows({table.column("host")[0].as_py(): (whole, beyond)}))

    found = written(pages.select("host", "html").mapInArrow(infer, _ROWS), "wrappers")
    evidence = None
    while True:
        more = found.filter("wrapper is null").drop("wrapper")
        evidence = more if evidence is None else evidence.union(more)
        partial = found.filter("wrapper is not null").select("host", "wrapper")
        most = partial.groupBy("host").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return partial, evidence
        groups = -(-most // FAN_IN)
        salted = partial.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(groups)))
        found = written(salted.groupBy("host", "salt").applyInArrow(merge, _ROWS), "wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    page_id = pages.schema["page_id"].dataType.simpleString()
    located = pages.select(
        "page_id", "url", "html", F.coalesce(host_and_path(F.col("url"))[0], F.lit("")).alias("host")
    )

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, wrapper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = decisions(json.loads(wrapper))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * len(found), pa.string()), pa.array([*found], pa.int64()),
                     pa.array([*found.values()], pa.int64())], ["host", "place", "pages"],
                )

    inferred, evidence = wrappers(located.filter("host <> ''"))
    same = (F.count("constant") == F.count("*")) & (F.min("constant") == F.max("constant"))
    contents = F.array_distinct(F.flatten(F.collect_list("contents")))
    beyond = evidence.groupBy("host", "place").agg(
        F.when(same, F.least(F.size(contents), F.lit(PAGES))).otherwise(0).cast("long").alias("pages")
    )
    constant = inferred.mapInArrow(decide, "host string, place long, pages long").union(beyond)
    constant = constant.groupBy("host", "place").agg(F.min("pages").alias("pages"))
    hosts = written(
        constant.filter(F.col("pages") >= PAGES_OUTSIDE).groupBy("host").agg(
            F.to_json(F.collect_list(F.array("place", "pages"))).alias("slots")
        ), "wrapper_slots",
    )
    few = hosts.count() <= BROADCAST_HOSTS
    joined = located.join(F.broadcast(hosts) if few else hosts, "host", "left")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, dict] = {None: {}}
        for batch in batches:
            texts = []
            for page, found in zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True
            ):
                if found not in known:
                    if len(known) > 1000:
                        known = {None: {}}
                    known[found] = dict(json.loads(found))
                texts.append(text_of(page, known[found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.select("page_id", "url", "html", "slots").mapInArrow(
        read, f"page_id {page_id}, url string, text string, n_chars long"
    )
