"""A forgiving reader of HTML: block nodes, the runs of text between them, and features of each node."""

from __future__ import annotations

import html
import re

import numpy as np

# Element names by role, and the words in class, id and role attributes that say what an element is for.
BLOCKS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th section article main aside nav header footer "
    "form fieldset legend figure figcaption blockquote pre address details summary dialog hr center menu hgroup search".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head script style noscript template svg iframe object select textarea button video audio canvas noframes title".split())
RAW = frozenset("script style textarea title iframe noframes noscript".split())
CLOSES_P = BLOCKS - frozenset("html body li dt dd td th tr thead tbody tfoot caption legend summary figcaption".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
AWAY = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu menubar breadcrumb breadcrumbs "
    "header masthead footer foot copyright sidebar side aside rail widget related recommended popular trending share sharing social follow comment comments "
    "disqus reply replies respond responses discussion feedback cookie cookies consent gdpr notice alert popup modal overlay subscribe newsletter signup login "
    "form search toolbar pagination pager paging tags legal disclaimer complementary contentinfo skip outbrain taboola toc".split()
)
TOWARDS = frozenset("article articlebody content main body post entry story text page copy prose blog news".split())
ROLES = (
    ("p", "pre", "blockquote"), ("h1", "h2", "h3", "h4", "h5", "h6"), ("li", "ul", "ol", "dl", "dt", "dd", "menu"), ("div", "section", "center"),
    ("article", "main"), ("nav", "header", "footer", "aside"), ("form", "fieldset", "legend", "search", "dialog"), ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"),
)

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_KEY = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
#: attributes that are looked at
_NAMING = frozenset(("class", "id", "role", "itemprop"))
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


class Page:
    """Block nodes in page order (parents first) and the text runs, each with its node."""

    def __init__(self) -> None:
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.away: list[int] = []
        self.towards: list[int] = []
        self.keep: list[str] = []  # data-keep, in training pages
        self.inline: list[int] = []
        self.runs: list[tuple[int, str, int]] = []  # node, text, characters in links


class _Reader:
    """Tags of a page, one after the other; each character is looked at a bounded number of times."""

    def __init__(self, source: str):
        self.source = source
        self.gone: set[str] = set()  # quotes that do not come any more

    def tag(self, at: int) -> tuple[int, str, dict[str, str], bool] | None:
        """The tag whose name begins at ``at``: where it ends, its name, the attributes looked at, whether a slash closes it.

        Quotes count only right after an equals sign; one that is never closed counts as an ordinary letter.  None if
        the page ends within the tag.
        """
        source, found = self.source, {}
        name = _NAME.match(source, at)
        at = name.end()
        while True:
            gap = _GAP.match(source, at)
            at = gap.end()
            if at >= len(source):
                return None
            if source[at] == ">":
                return at + 1, name.group().lower(), found, gap.group().endswith("/")
            key = _KEY.match(source, at)
            at = key.end()
            equals = _EQUALS.match(source, at)
            if not equals:
                continue
            at = equals.end()
            quote, end = source[at : at + 1], -1
            if quote in ("'", '"') and quote not in self.gone:
                end = source.find(quote, at + 1)
                if end < 0:
                    self.gone.add(quote)
            if end >= 0:
                value, at = source[at + 1 : end], end + 1
            else:
                bare = _BARE.match(source, at)
                value, at = bare.group(), bare.end()
            name_ = key.group().lower()
            if name_ in _NAMING or name_ == "data-keep":
                found.setdefault(name_, value)


def _names(attributes: dict[str, str]) -> tuple[int, int, str]:
    away = towards = 0
    for name in _NAMING & attributes.keys():
        parts = [w.lower() for w in _WORD.findall(attributes[name])]
        away += sum(w in AWAY for w in parts)
        towards += sum(w in TOWARDS for w in parts)
    return away, towards, attributes.get("data-keep", "")


def read(source: str) -> Page:
    """Never fails: unknown, unclosed and misplaced tags are taken as browsers would, roughly.

    Time grows with the length of the page, whatever its markup: the nearest open element of a name, and the nearest
    open block, are at hand without a walk over those in between.  What follows an unclosed comment, or a tag in which
    the page ends, is no text.
    """
    page, reader = Page(), _Reader(source)
    stack: list[tuple[str, int]] = [("", -1)]  # open elements and the block each is in
    places: dict[str, list[int]] = {}  # of each name, where in the stack it is open
    blocks: list[int] = []  # where in the stack blocks are open
    text: list[str] = []
    linked = [0]
    links = silent = 0

    def node(tag: str, attributes: dict[str, str]) -> int:
        away, towards, keep = _names(attributes) if attributes else (0, 0, "")
        page.parent.append(stack[-1][1])
        page.tag.append(tag)
        page.away.append(away)
        page.towards.append(towards)
        page.keep.append(keep)
        page.inline.append(0)
        return len(page.tag) - 1

    def flush() -> None:
        if text:
            run = " ".join("".join(text).split())
            if run:
                if stack[-1][1] < 0:
                    stack[0] = ("", node("body", {}))
                    stack[:] = [(t, b if b >= 0 else stack[0][1]) for t, b in stack]
                page.runs.append((stack[-1][1], run, min(linked[0], len(run))))
            text.clear()
        linked[0] = 0

    def nearest(names: tuple[str, ...]) -> int:
        return max((places[t][-1] for t in names if places.get(t)), default=0)

    def open_(tag: str, block: int) -> None:
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            blocks.append(len(stack))
        stack.append((tag, block))

    def close(down_to: int) -> None:
        nonlocal links, silent
        if blocks and blocks[-1] >= down_to:
            flush()
        for t, _ in stack[down_to:]:
            links -= t == "a"
            silent -= t in SILENT
            places[t].pop()
        while blocks and blocks[-1] >= down_to:
            blocks.pop()
        del stack[down_to:]

    def words(part: str) -> None:
        if part and not silent:
            plain = html.unescape(part) if "&" in part else part
            text.append(plain)
            if links:
                linked[0] += len(plain.strip())

    at = begun = 0
    while True:
        at = source.find("<", at)
        if at < 0:
            words(source[begun:])
            break
        if not _NAME.match(source, at + 1):
            if source[at + 1 : at + 2] not in ("!", "?", "/"):
                at += 1  # a sign, not a tag
                continue
            words(source[begun:at])
            comment = source.startswith("<!--", at)
            over = source.find("-->" if comment else ">", at + (2 if comment else 1))
            if over < 0:
                break
            begun = at = over + (3 if comment else 1)
            continue
        words(source[begun:at])
        found = reader.tag(at + 1)
        if found is None:
            break
        begun = at = found[0]
        _, tag, attributes, slash = found
        if tag.startswith("/"):
            tag = tag[1:]
            i = nearest((tag,))
            if i and (tag in BLOCKS or tag in SILENT or not blocks or blocks[-1] < i):
                close(i)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                text.append(" " if tag == "br" else "")
            continue
        if tag in CLOSES_P:
            if blocks and stack[blocks[-1]][0] == "p":
                close(blocks[-1])
        elif tag in SIBLINGS:
            i = nearest(SIBLINGS[tag])
            if i > nearest(SCOPES[tag]):
                close(i)
        if tag == "body" and stack[-1][0] == "head":
            close(len(stack) - 1)
        if tag in BLOCKS:
            flush()
            open_(tag, node(tag, attributes))
        else:
            if slash and tag in SILENT:
                continue
            open_(tag, stack[-1][1])
            if stack[-1][1] >= 0:
                page.inline[stack[-1][1]] += 1
            links += tag == "a"
            silent += tag in SILENT
        if tag in RAW:
            over = re.compile(rf"</{tag}\b", re.I).search(source, at)
            begun = at = over.start() if over else len(source)
    flush()
    return page


FEATURES = 31


def features(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each node, and the length of the text right inside each."""
    n = len(page.tag)
    own, own_link, stops, first = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    before = 0
    seen = np.zeros(n, dtype=bool)
    upper = np.zeros(n)
    for i, run, link in page.runs:
        if not seen[i]:
            seen[i], first[i] = True, before
        own[i] += len(run)
        own_link[i] += link
        stops[i] += run.count(".") + run.count("!") + run.count("?") + run.count(",")
        upper[i] += len(run) > 20 and run[-1:] in ".!?\"'”»…"
        before += len(run)
    whole, whole_link, tags, depth, kids = own.copy(), own_link.copy(), np.array(page.inline, dtype=float) + 1, np.zeros(n), np.zeros(n)
    para = own * np.array([t in ROLES[0] for t in page.tag], dtype=float) if n else own.copy()
    away, towards = np.array(page.away, dtype=float), np.array(page.towards, dtype=float)
    above_away, above_towards, above_role = np.zeros(n), np.zeros(n), np.zeros((n, 3))
    place = np.zeros(n)
    roles = np.array([[t in r for r in ROLES] for t in page.tag], dtype=float).reshape(n, len(ROLES))
    for i in range(n):
        p = page.parent[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            place[i] = kids[p]
            kids[p] += 1
            above_away[i] = above_away[p] + away[p]
            above_towards[i] = above_towards[p] + towards[p]
            above_role[i] = np.maximum(above_role[p], roles[p, 4:7])
    for i in range(n - 1, -1, -1):
        p = page.parent[i]
        if p >= 0:
            whole[p] += whole[i]
            whole_link[p] += whole_link[i]
            tags[p] += tags[i]
            para[p] += para[i]
            if not seen[p] or first[i] < first[p]:
                first[p] = first[i] if seen[i] else first[p]
                seen[p] |= seen[i]
    total = max(1.0, float(before))
    up = np.array(page.parent, dtype=int)
    root = up < 0
    safe = np.where(root, 0, up)
    brothers = np.where(root, 1, kids[safe]) if n else kids
    around = np.where(root, 0, (whole[safe] - whole - own[safe]) / np.maximum(1, brothers - 1)) if n else whole
    around_link = np.where(root, 0, (whole_link[safe] - whole_link) / np.maximum(1, whole[safe] - whole)) if n else whole
    up_link = np.where(root, 0, whole_link[safe] / np.maximum(1, whole[safe])) if n else whole
    columns = [
        np.log1p(own), own_link / np.maximum(1, own), stops / np.maximum(1, own), upper, np.log1p(whole), whole_link / np.maximum(1, whole), whole / tags, np.log1p(para), para / np.maximum(1, whole), whole / total,
        np.where(root, 1, whole / np.maximum(1, whole[safe])) if n else whole, depth, kids, place / np.maximum(1, brothers), brothers, first / total, np.log1p(np.maximum(0, around)), around_link, up_link, away, towards, above_away, above_towards,
    ]
    return np.column_stack([*columns, roles[:, :5] * 1.0, above_role]) if n else np.zeros((0, FEATURES)), own
