"""HTML extraction by inferred wrappers (operator 10).

For each host a wrapper is inferred: a union-free regular expression over the token
streams of its pages, with tags, text slots, optional parts and repeated groups.  A
page's stream is first made well formed (omitted end tags are supplied) and its tandem
repeats are folded; then pages are aligned with the wrapper one after another.  A
mismatch is resolved as RoadRunner does: text against text makes a slot, a part that
one side lacks becomes optional, and a part that occurs again and again becomes a
repeated group.  Each task aligns the pages it reads into one partial wrapper per host;
partial wrappers of a host are aligned in two steps (by salt, then all), so a host with
a third of all pages costs no task more than its share.  Pages whose folded stream a
task has met before only add to the slots' statistics.

The wrapper then says which parts are the article: boilerplate parts are known by their
tags, roles and names (a name counts if it is, or ends in, a word for boilerplate, and the
part doesn't hold the article or the bulk of the text; a header gives its headings); a single slot with one and the same text on every page of a host,
outside headings, paragraphs and the like, is template text.  The main part is the article (or main) element, judged against those
of the same page; on hosts without, the part in which the descent along the bulk of the
host's text ends.  A page that has neither makes the same descent in its own tree.  Every
page is parsed whole and read through its host's wrapper, block by block.

Defined cases: a null or empty page has an empty text; a null or odd url is host ""; an
unclosed script or comment reaches to the page's end; elements nested over ``DEPTH``
deep are flattened; an element with over ``PARTS`` irregular parts is generalised to its
parts' labels, then tags, so a wrapper's size has a bound; repeated rows, empty tables and
extra columns change nothing; a page without text in its main part has an empty text.
"""

from __future__ import annotations

import html
import json
import re
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, run_folder, table

SALTS = 64
#: Least pages of a host for which a text that all of them have counts as template text.
TEMPLATE_PAGES = 5
#: Elements nested deeper than this are flattened into their ancestor.
DEPTH = 80
#: Longest repeated run of parts that is looked for, and most parts of one element before they are generalised.
PERIOD, PARTS = 6, 64
#: Share of its parent's text that a part must have for the descent to go on into it.
BULK = 0.7

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 div ul ol dl table section article aside nav header footer main form blockquote pre figure hr address fieldset details menu".split())
OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "thead": ("tr", "td", "th")}
LIST_LIKE = frozenset("ul ol dl table div section article main aside nav body".split())
TEXT_LIKE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody tr td th figure figcaption".split())
DROPPED = frozenset("head title nav aside footer form button select input textarea script style noscript template iframe svg canvas object audio video map dialog menu".split())
DROPPED_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar tablist toolbar".split())
DROPPED_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion
nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar notice notices notification cookie cookies
consent gdpr popup modal overlay alert comment comments commentlist disqus reply replies respond share sharing social related recommended
recommendations subscribe subscription newsletter signup login search pagination pager widget widgets skip copyright paywall teaser outbrain taboola""".split())
KEPT_WHATEVER_NAME = frozenset("html body main".split())
#: Words of a name that say how its element looks or what is beside it, and last words that only say that it is a box.
STATE_WORDS = frozenset("has have with without no not non".split())
BOX_WORDS = frozenset("""area bar block bottom box button buttons column container content div form group holder icons inner item items
left links list outer panel posts right row section slot top unit wrap wrapper""".split())

_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|iframe|noscript|noembed|xmp|template|svg)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>{_TAG})>"
    r"|</?[a-z][^>]*>|<[!?][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([a-z_:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HOST = re.compile(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def name_says(name: str) -> str:
    """The boilerplate word that a class or id ends in (words for a box left out), else ""."""
    words = [w.lower() for w in _NAME.findall(name)]
    if STATE_WORDS & set(words[:-1]):
        return ""
    while len(words) > 1 and words[-1] in BOX_WORDS:
        words.pop()
    return words[-1] if words and words[-1] in DROPPED_NAMES else ""


@lru_cache(maxsize=20_000)
def doubt_of(label: str) -> tuple[bool, bool]:
    """Of an element that is boilerplate by name only: is a whole name boilerplate, and do its names say no more than header?"""
    names = [n for n in label.split(" ")[1:] if not n.startswith("@")]
    said = {name_says(n) for n in names} - {""}
    return any([w.lower() for w in _NAME.findall(n)] == [name_says(n)] for n in names), said <= {"header", "masthead"}


@lru_cache(maxsize=20_000)
def label_of(tag: str, rest: str) -> str:
    """An element's symbol: its tag, and its names (numbers left out) and role; "!" first if it is boilerplate, "~" if by its names only."""
    attributes = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(rest)} if rest.strip(" /") else {}
    names = sorted({re.sub(r"\d+", "", n) for k in ("class", "id") for n in attributes.get(k, "").split()})
    role = attributes.get("role", "").lower() or ("articlebody" if attributes.get("itemprop", "").lower() == "articlebody" else "")
    hidden = attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")) or re.search(r"(?:^|\s)hidden(?:\s|$|=)", rest)
    named = any(map(name_says, names)) and tag not in KEPT_WHATEVER_NAME and role not in ("main", "articlebody")
    dropped = tag in DROPPED or role in DROPPED_ROLES or hidden
    if tag == "article":  # a class may only describe an article, unless it names it outright
        dropped, named = dropped or {n.lower() for n in names} & DROPPED_NAMES, False
    return ("!" if dropped else "~" if named else "") + " ".join([tag, *names, *([f"@{role}"] if role else [])])


def tag_of(label: str) -> str:
    return label.lstrip("!~").split(" ", 1)[0]


class _Open:
    """The open elements of a page being parsed, as (tag, node, first).

    ``first`` has, for the elements since the last list-like one, the place of the
    outermost of each tag that a neighbour of its kind closes; so a step's cost doesn't
    grow with the depth.  Elements over ``DEPTH`` deep share their ancestor's node, boilerplate
    among them has a node outside the tree, or by name only, a node of its own."""

    def __init__(self, root: list):
        self.stack, self.places = [("", root, {})], {}

    @property
    def node(self) -> list:
        return self.stack[-1][1]

    def push(self, tag: str, label: str) -> None:
        above, place = self.node[1], len(self.stack)
        if place < DEPTH:
            node = [label, []]
            above.append(node)
        else:
            above.append("\n")
            node = ["!", []] if label.startswith("!") else self.node
            if label.startswith("~") and not node[0].startswith("~"):
                node = [label, []]
                above.append(node)
        first = {} if tag in LIST_LIKE else self.stack[-1][2]
        if tag in OWN_KIND:
            first.setdefault(tag, place)
        self.places.setdefault(tag, []).append(place)
        self.stack.append((tag, node, first))

    def close_from(self, place: int) -> None:
        while len(self.stack) > place:
            tag, node, first = self.stack.pop()
            self.places[tag].pop()
            if first.get(tag) == len(self.stack):
                del first[tag]
            if len(self.stack) >= DEPTH:
                self.node[1].append("\n")

    def close(self, tag: str) -> None:
        """Close the innermost open element of this tag, and all inside it."""
        if self.places.get(tag):
            self.close_from(self.places[tag][-1])

    def close_kind(self, tag: str) -> None:
        """Close the outermost open element that ``tag`` ends, above the nearest list-like one."""
        first = self.stack[-1][2]
        found = [first[t] for t in OWN_KIND[tag] if t in first]
        if found:
            self.close_from(min(found))


def parsed(page: str) -> list:
    """The page as a tree of [label, children]; a child is an element, a text, or "\\n" for a line break.

    Inline elements go, their text stays; omitted end tags are supplied."""
    root = ["", []]
    opened, at = _Open(root), 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            opened.node[1].append(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            continue
        if m["end"]:
            if tag == "br":
                opened.node[1].append("\n")
            else:
                opened.close(tag)
            continue
        if tag in VOID:
            opened.node[1].append("\n")
            continue
        if tag in CLOSED_BY_BLOCK:
            opened.close("p")
        if tag in OWN_KIND:
            opened.close_kind(tag)
        opened.push(tag, label_of(tag, m["rest"]))
    if at < len(page):
        opened.node[1].append(page[at:])
    return root


# A wrapper node: {"l": label, "q": [least, most], "c": children}; most 2 stands for any number.
# A slot: {"l": "#", "q": ..., "t": hash of the one text it had, or null, "n": characters, "p": pages}.
# The root also has "p", the host's pages.
# A repeated group of several parts: {"l": "(a|b)", "q": ..., "c": parts}.


def stream(tree: list) -> dict:
    """The page's own expression: its tree with tandem repeats folded."""
    children, text = [], []

    def slot():
        words = " ".join("".join(text).split())
        text.clear()
        if words:
            children.append({"l": "#", "q": [1, 1], "t": crc32(words.encode("utf-8", "replace")), "n": len(words), "p": 1})

    for child in tree[1]:
        if isinstance(child, str):
            text.append(child)
        else:
            slot()
            children.append(stream(child))
    slot()
    node = {"l": tree[0], "q": [1, 1], "c": folded(children)}
    return node if tree[0] else node | {"p": 1}


def folded(parts: list[dict]) -> list[dict]:
    """Fold repeats: equal neighbours become a repeated part, equal runs of parts a repeated group."""
    out: list[dict] = []
    for part in parts:
        if out and out[-1]["l"] == part["l"]:
            out[-1] = repeated(out[-1], part)
        else:
            out.append(part)
    for size in range(2, min(PERIOD, len(out) // 2) + 1):
        k = 0
        while k + 2 * size <= len(out):
            labels = [p["l"] for p in out[k:k + size]]
            if labels == [p["l"] for p in out[k + size:k + 2 * size]]:
                group = [joined(a, b, repeat=False) for a, b in zip(out[k:k + size], out[k + size:k + 2 * size])]
                end = k + 2 * size
                while [p["l"] for p in out[end:end + size]] == labels:
                    group = [joined(a, b, repeat=False) for a, b in zip(group, out[end:end + size])]
                    end += size
                out[k:end] = [{"l": f"({'|'.join(labels)})", "q": [1, 2], "c": group}]
            k += 1
    if len(out) > PARTS:  # too irregular to keep the order, then to keep the names: each label once
        out = collected(out, lambda label: label)
    return collected(out, bare) if len(out) > PARTS else out


def bare(label: str) -> str:
    """A label without names and role."""
    return (label[0] if label[:1] in ("!", "~") else "") + tag_of(label)


def collected(parts: list[dict], name) -> list[dict]:
    """Each label's parts as one, at its first place, any number of times; groups opened."""
    of: dict[str, dict] = {}
    for part in (p for q in parts for p in (_parts(q) if q["l"].startswith("(") else [q])):
        label = name(part["l"])
        part = part | {"l": label, "q": [0, 2]}
        of[label] = joined(of[label], part, repeat=True) | {"q": [0, 2]} if label in of else part
    return list(of.values())


def repeated(a: dict, b: dict) -> dict:
    return joined(a, b, repeat=True)


def joined(a: dict, b: dict, repeat: bool) -> dict:
    """One part for both: aligned inside; repeated if one follows the other."""
    quantity = [max(1, min(a["q"][0], b["q"][0])), 2] if repeat else [min(a["q"][0], b["q"][0]), max(a["q"][1], b["q"][1])]
    if a["l"] == "#":
        pages = max(a["p"], b["p"]) if repeat else a["p"] + b["p"]
        return {"l": "#", "q": quantity, "t": a["t"] if a["t"] == b["t"] and not repeat else None, "n": a["n"] + b["n"], "p": pages}
    node = {"l": a["l"], "q": quantity, "c": aligned(a["c"], b["c"])}
    return node | {"p": a["p"] + b["p"]} if "p" in a else node


def aligned(a: list[dict], b: list[dict]) -> list[dict]:
    """The expression that both sequences match: common parts joined, others optional."""
    if [x["l"] for x in a] == [x["l"] for x in b]:
        return [joined(x, y, repeat=False) for x, y in zip(a, b)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i]["l"] == b[j]["l"] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i]["l"] == b[j]["l"]:
            out.append(joined(a[i], b[j], repeat=False))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append(a[i] | {"q": [0, a[i]["q"][1]]})
            i += 1
        else:
            out.append(b[j] | {"q": [0, b[j]["q"][1]]})
            j += 1
    return folded(out)


def expression(node: dict) -> str:
    """The wrapper as text: tags, #slot, (...)? and (...)+."""
    inner = "#" if node["l"] == "#" else " ".join(expression(c) for c in node["c"])
    if node["l"] not in ("", "#") and not node["l"].startswith("("):
        inner = f"<{node['l']}> {inner} </{tag_of(node['l'])}>"
    sign = {(1, 1): "", (0, 1): "?", (1, 2): "+", (0, 2): "*"}[tuple(node["q"])]
    return f"( {inner} ){sign}" if sign else inner


def _size(node: dict) -> int:
    """Characters in a part, boilerplate in it left out."""
    return node["n"] if node["l"] == "#" else sum(_size(c) for c in node["c"] if c["l"][:1] not in ("!", "~"))


def _loose(node: dict) -> int:
    """The same with what is boilerplate by a part of a name only."""
    return node["n"] if node["l"] == "#" else sum(_loose(c) for c in node["c"] if _counts(c["l"]))


def _counts(label: str) -> bool:
    return not label.startswith("!") and not (label.startswith("~") and doubt_of(label)[0])


def _parts(node: dict):
    """A node's parts, groups opened."""
    for c in node["c"]:
        if c["l"].startswith("("):
            yield from _parts(c)
        else:
            yield c


def _kind(label: str) -> str:
    """"article" or "main" for a label that names the main part, else ""."""
    tag = tag_of(label)
    return "article" if tag == "article" or label.endswith("@articlebody") else "main" if tag == "main" or label.endswith("@main") else ""


#: Added to the doubts of a part inside one that a whole name calls boilerplate.
WHOLE_NAME = 1_000


def candidates(root, parts, label) -> list[tuple[str, object, int]]:
    """(kind, part, doubts) of the article and main parts below ``root``, articles inside articles left out.

    The doubts count the parts round it that are boilerplate by name."""
    found = []

    def look(node, inside: str, doubts: int) -> None:
        for c in parts(node):
            kind, d = _kind(label(c)), doubts
            if label(c).startswith("~"):
                kind, d = "", d + (WHOLE_NAME if doubt_of(label(c))[0] else 1)
            if kind and not (inside == "article" and kind == "article"):
                found.append((kind, c, d))
            look(c, "article" if inside == "article" else kind or inside, d)

    look(root, "", 0)
    return found


def best(found: list, size) -> list:
    """The main parts among candidates: the least doubtful of a good size, articles first."""
    found = [f for f in found if size(f[1])]
    found = [f for f in found if f[2] < WHOLE_NAME] or found
    most = max((size(c) for _, c, _ in found), default=0)
    least = min((d for _, c, d in found if 4 * size(c) >= most), default=0)
    for kind in ("article", "main"):
        own = [c for k, c, d in found if k == kind and d <= least]
        if own:
            most = max(map(size, own))
            return [c for c in own if 4 * size(c) >= most]
    return []


def descent(at, parts, size, loose, label) -> tuple:
    """The part in which the descent along the bulk of the text ends, and the h1 parts beside its way.

    A part that is boilerplate by name only is gone into if it holds the bulk; by a whole name, if there is no other text."""
    titles = []
    while True:
        below = list(parts(at))
        plain = [c for c in below if not label(c).startswith("~")]
        titles += [c for c in plain if tag_of(label(c)) == "h1"]
        large = max(plain, key=size, default=None)
        named = max((c for c in below if label(c).startswith("~") and tag_of(label(c)) not in TEXT_LIKE), key=lambda c: (not doubt_of(label(c))[0], loose(c)), default=None)
        if named is not None and loose(named) and (not loose(at) if doubt_of(label(named))[0] else loose(named) >= BULK * loose(at)):
            at = named
        elif large is None or tag_of(label(large)) in TEXT_LIKE or size(large) < BULK * max(1, size(at)):
            return at, titles
        else:
            at = large


def _wrapper_parts(node: dict):
    return (c for c in _parts(node) if c["l"] != "#" and not c["l"].startswith("!"))


def _page_parts(node: list):
    return (c for c in node[1] if not isinstance(c, str) and not c[0].startswith("!"))


def marked(wrapper: dict) -> dict:
    """Set "main" on the parts that hold the article, "within" on all that a page may choose, "kept" on boilerplate by name that has the bulk of the text, and "skip" on template text inside them."""
    label = lambda c: c["l"]
    found = [c for _, c, _ in candidates(wrapper, _wrapper_parts, label) if _size(c) or _loose(c)]
    bulk = BULK * max(1, _loose(wrapper))

    def keep(node: dict) -> None:
        for c in _wrapper_parts(node):
            if c["l"].startswith("~") and _counts(c["l"]) and _loose(c) >= bulk:
                c["kept"] = 1
            keep(c)

    keep(wrapper)
    if found:  # each page chooses among its own
        wrapper["chosen"] = 1
        for c in found:
            c["within"] = 1
    else:
        at, titles = descent(wrapper, _wrapper_parts, _size, _loose, label)
        for c in titles:
            c["main"] = c["within"] = 1
        at["main"] = at["within"] = 2
    slots: list[tuple[dict, bool]] = []

    def gather(node: dict, inside: bool, always: bool, prose: bool) -> None:
        once = always and node["q"] == [1, 1]
        if node["l"] == "#":
            if inside and node["q"][1] == 1:
                slots.append((node, once and not prose))
            return
        if node["l"].startswith("~") and inside and not node.get("within") and not node.get("kept"):
            return
        if not node["l"].startswith("!") and node["q"][1] == 1:
            for c in node["c"]:
                gather(c, inside or bool(node.get("within")), once, prose or tag_of(node["l"]) in TEXT_LIKE)

    gather(wrapper, False, True, False)
    pages = wrapper["p"]
    if any(s["t"] is None for s, _ in slots):  # else all the host's pages may be copies
        for s, template in slots:
            if template and s["t"] is not None and s["p"] == pages >= TEMPLATE_PAGES:
                s["skip"] = 1
    return wrapper


def matched(tree: list, wrapper: dict) -> dict[int, dict]:
    """The wrapper's part of each of the page's elements that has one, by the element's id()."""
    of = {}

    def match(node: list, w: dict) -> None:
        of[id(node)] = w
        parts, k = list(_parts(w)), 0
        for child in _page_parts(node):
            label = child[0]
            part = next((p for p in parts[k:] if p["l"] == label), None) or next((p for p in parts if p["l"] in (label, bare(label))), None)
            if part is not None:
                k = next(i for i, p in enumerate(parts) if p is part)
                match(child, part)

    match(tree, wrapper)
    return of


def main_parts(tree: list, wrapper: dict, of: dict[int, dict]) -> dict[int, bool]:
    """The id() of each element that holds the page's article: the page's own article or main
    elements, else the part that the host's wrapper marks, else the end of the page's own descent.
    Its value says whether the element's text is all in parts that are boilerplate by a part of a name."""
    sizes: dict[int, tuple[int, int]] = {}

    def measure(node: list) -> None:
        plain = every = sum(len(" ".join(c.split())) for c in node[1] if isinstance(c, str))
        for c in _page_parts(node):
            measure(c)
            p, e = sizes[id(c)]
            plain += 0 if c[0].startswith("~") else p
            every += e if _counts(c[0]) else 0
        sizes[id(node)] = plain, every

    measure(tree)
    size, loose, label = lambda c: sizes[id(c)][0], lambda c: sizes[id(c)][1], lambda c: c[0]
    only_named = lambda key: not sizes[key][0]
    found = candidates(tree, _page_parts, label)
    own = best(found, lambda c: size(c) or loose(c))
    if own:
        return {id(c): only_named(id(c)) for c in own}
    if found and wrapper.get("chosen"):  # an empty article
        return {}
    by_host = {k: w["main"] for k, w in of.items() if w.get("main")}
    if any(rank == 2 and sizes[k][1] for k, rank in by_host.items()):
        return {k: only_named(k) for k in by_host}
    at, titles = descent(tree, _page_parts, size, loose, label)
    return {id(c): only_named(id(c)) for c in [at, *titles]}


def headings(node: list):
    """The headings in an element, itself included."""
    if re.match(r"~?h[1-6]\b", node[0]):
        yield node
    else:
        for c in _page_parts(node):
            if not c[0].startswith("~") or doubt_of(c[0])[1]:
                yield from headings(c)


def own_text(node: list) -> int:
    """The hash that stream() gives to an element's text, when it is one slot."""
    return crc32(" ".join("".join(c for c in node[1] if isinstance(c, str)).split()).encode("utf-8", "replace"))


def extracted(tree: list, wrapper: dict) -> str:
    """The blocks of a page's main part, in page order, read through the wrapper."""
    blocks, text = [], []
    of = matched(tree, wrapper)
    chosen = main_parts(tree, wrapper, of)

    def flush() -> None:
        words = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if words:
            blocks.append(words)

    def read(node: list, main: bool, named: bool) -> None:
        main, named = main or id(node) in chosen, named or chosen.get(id(node), False)
        w = of.get(id(node))
        slots = [p for p in _parts(w) if p["l"] == "#"] if w else []
        skip = main and len(slots) == 1 and bool(slots[0].get("skip")) and slots[0]["t"] == own_text(node)
        for child in node[1]:
            if isinstance(child, str):
                if main and not skip:
                    if child == "\n":
                        flush()
                    else:
                        text.append(child)
                continue
            flush()
            label = child[0]
            if label.startswith("!"):
                continue
            dropped = main and label.startswith("~") and id(child) not in chosen and not of.get(id(child), {}).get("kept") and not (named and _counts(label))
            if main and tag_of(label) == "header" or dropped and doubt_of(label)[1]:  # in an article: its headings only
                for c in headings(child):
                    read(c, True, False)
                    flush()
            elif not dropped:
                read(child, main, named)
            flush()

    read(tree, False, False)
    flush()
    return "\n".join(blocks)


def _merge_rows(batches, keys: tuple[str, ...]):
    """Align the partial wrappers of each key that a task reads."""
    held: dict[tuple, dict] = {}
    for batch in batches:
        for *key, text in zip(*(batch.column(c).to_pylist() for c in (*keys, "wrapper"))):
            new = json.loads(text)
            key = tuple(key)
            held[key] = joined(held[key], new, repeat=False) if key in held else new
    kinds = {"host": pa.string(), "salt": pa.int32()}
    columns = {c: pa.array([k[i] for k in held], kinds[c]) for i, c in enumerate(keys)}
    yield pa.RecordBatch.from_pydict(columns | {"wrapper": pa.array([json.dumps(w) for w in held.values()], pa.string())})


def _shape(node: dict) -> str:
    return "#" if node["l"] == "#" else f"{node['l']}{node['q'][1]}[{','.join(map(_shape, node['c']))}]"


def _add(w: dict, page: dict) -> None:
    """Add a page of a known shape to the statistics of the parts it matches."""
    if w["l"] == "#":
        w["n"] += page["n"]
        w["p"] += page["p"]
        if w["t"] != page["t"]:
            w["t"] = None
        return
    if "p" in w:
        w["p"] += page["p"]
    at = 0
    for part in page["c"]:
        k = next((i for i in range(at, len(w["c"])) if w["c"][i]["l"] in (part["l"], bare(part["l"]))), None)
        if k is not None:
            _add(w["c"][k], part)
            at = k


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper: the inferred expression of every host, over all of its pages."""

    def partial(batches):
        held: dict[str, dict] = {}
        shapes: dict[str, set] = {}
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                own = stream(parsed(page or ""))
                shape = _shape(own)
                if host not in held:
                    held[host], shapes[host] = own, {shape}
                elif shape in shapes[host]:
                    _add(held[host], own)
                else:
                    shapes[host].add(shape)
                    held[host] = joined(held[host], own, repeat=False)
        yield pa.RecordBatch.from_pydict({
            "host": pa.array(list(held), pa.string()), "salt": pa.array([crc32(json.dumps(w).encode()) % SALTS for w in held.values()], pa.int32()),
            "wrapper": pa.array([json.dumps(w) for w in held.values()], pa.string())})

    parts = pages.select(host_column(F.col("url")).alias("host"), "html").mapInArrow(partial, "host string, salt int, wrapper string")
    salted = parts.repartition("host", "salt").mapInArrow(lambda b: _merge_rows(b, ("host", "salt")), "host string, salt int, wrapper string")
    return salted.repartition("host").mapInArrow(lambda b: _merge_rows(b, ("host",)), "host string, wrapper string")


@lru_cache(maxsize=2_000)
def _wrapper(text: str) -> dict:
    return marked(json.loads(text))


def host_column(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(pages: DataFrame, found: DataFrame) -> DataFrame:
    """page_id, url, text of every page, read through its host's wrapper (its own, if ``found`` has none)."""

    def texts(batches):
        for batch in batches:
            out = []
            for page, w in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
                tree = parsed(page or "")
                out.append(extracted(tree, _wrapper(w) if w is not None else marked(stream(tree))))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_column(F.col("url")).alias("host"))
    return rows.join(found, "host", "left").select("page_id", "url", "html", "wrapper").mapInArrow(texts, "page_id long, url string, text string")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page (contract of op10)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = land(wrappers(pages), run_folder(spark, "wrappers"))
    return extract(pages, found).withColumn("n_chars", F.char_length("text").cast("long"))
