"""Main text of web pages by gradient-boosted trees over the features of DOM nodes.

A page becomes a tree of its block elements and of the inline ones that a name sets apart. Each is judged by its tag, the
tokens of its attributes, the density and links of its subtree, its depth and its siblings. Decoding is hierarchical: the kept elements are those that make the
tree's judgements likeliest under the rule that nothing below a dropped element is kept. The trees are trained here, on
pages made by rule from a seed, whose main text is known.
"""

from __future__ import annotations

import html
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pagefold.llm.common import only, slices

# fixed values of the HTML standard: elements by how they are parsed and laid out
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
#: A start tag on the left ends an open element on the right.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: An end tag or an implied end looks no further up than these.
SCOPE = set("html body table td th article section main div aside nav header footer form ul ol dl".split())
#: A name in a start tag, with its value where it has one; or the end of the tag.
ATTRIBUTE = re.compile(r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+))?)?)")
NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: Words of an attribute's value, also those that capitals part.
VALUE_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Words of attributes, by what they tell about an element.
HINTS = {
    "advert": "ad ads advert advertisement adverts advertising adsense sponsor sponsored promo promotion banner dfp commercial outbrain taboola",
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager tabs toolbar links sitemap skip toc",
    "comment": "comment comments commentlist respond reply replies disqus discussion feedback reviews guestbook",
    "footer": "footer foot bottom copyright colophon legal imprint credits",
    "header": "header head top masthead logo branding site hero topbar",
    "side": "sidebar side aside rail widget widgets related recommended recommendations more trending popular teaser archive tags tagcloud",
    "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay dialog message warning privacy paywall subscribe",
    "form": "form search login signin signup register newsletter subscription share social sharing contact poll",
    "content": "content article main post story entry body text page blog news maincontent articlebody prose document",
}
HINT_OF = {w: i for i, words in enumerate(HINTS.values()) for w in words.split()}
#: Words that names of parts are made with, and that tell nothing by themselves.
SHAPES = set("box wrap wrapper area inner outer block container section list item row col column grid group panel unit module component card left right center first last latest primary secondary small large js is has wp div id bar link line".split())
TAG_GROUPS = ["p", "h1 h2 h3 h4 h5 h6", "li dd dt", "ul ol dl menu", "div section", "article main", "nav", "aside", "footer", "header", "form fieldset button select option input", "table tbody thead tr td th", "pre blockquote figure figcaption details", "html body", "a", "label legend output", " ".join(INLINE - {"a", "label"})]
TAG_GROUP = {t: i for i, tags in enumerate(TAG_GROUPS) for t in tags.split()}
N_TAGS, N_HINTS = len(TAG_GROUPS) + 1, len(HINTS)
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@lru_cache(1 << 16)
def hints_of(value: str) -> int:
    """What a value of class, id, role or itemprop tells: a bit for each kind of hint whose words stand alone or among
    SHAPES, and a bit further up for each kind that stands beside one other word. In longer names a word tells nothing."""
    out = 0
    for name in value.split():
        words = [w.lower() for w in VALUE_WORDS.findall(name)]
        others = sum(w not in HINT_OF and w not in SHAPES for w in words)
        if others <= 1:
            for w in words:
                if w in HINT_OF:
                    out |= 1 << (HINT_OF[w] + N_HINTS * others)
    return out


def attributes(source: str, at: int) -> tuple[dict[str, str], int, bool]:
    """Attributes of the start tag whose name ends at `at` (the first of each name), where the tag ends (-1 if it
    doesn't), and whether it ends in a slash."""
    found: dict[str, str] = {}
    match = ATTRIBUTE.match
    while m := match(source, at):
        at = m.end()
        if m[1]:
            return found, at, source[at - 2] == "/"
        found.setdefault(m[2].lower(), m[3] or m[4] or m[5] or "")
    return found, -1, False


def is_hidden(found: dict[str, str]) -> bool:
    return found.get("hidden", "until-found").lower() != "until-found" or found.get("aria-hidden", "").lower() == "true" or "style" in found and bool(HIDDEN_STYLE.search(found["style"]))


class Page:
    """Elements that are judged, in page order, and the text runs that stand right in them.

    All block elements are judged, and of the inline ones those that are hidden, label a field, or have a name that hints at
    something; the others belong to the element that they stand in. An unclosed tag or comment takes the rest of the
    page with it, as the HTML standard has it. Reading takes time in proportion to the page.
    """

    def __init__(self, source: str):
        self.tags: list[str] = ["html"]
        self.parent: list[int] = [-1]
        self.hints: list[int] = [0]
        self.depth: list[int] = [0]
        self.hidden: list[bool] = [False]
        self.runs: list[tuple[int, str, bool, int]] = []  # element, text, whether linked, block
        self._read(source)

    def _add(self, tag: str, up: int, found: dict[str, str], hints: int, hidden: bool) -> int:
        self.tags.append(tag)
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        self.hints.append(hints)
        self.hidden.append(self.hidden[up] or hidden)
        return len(self.tags) - 1

    def _read(self, source: str) -> None:
        runs, find, n = self.runs, source.find, len(source)
        # open elements: tag, element judged, and the places here of the innermost block element and of the innermost in SCOPE
        stack: list[tuple[str, int, int, int]] = [("html", 0, 0, 0)]
        places: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of each tag
        at, block, links, head = 0, 0, 0, False
        endless: set[str] = set()  # what is known not to come any more

        def text(value: str) -> None:
            if value and not head:
                runs.append((stack[-1][1], html.unescape(value) if "&" in value else value, links > 0, block))

        def push(tag: str, element: int) -> None:
            k = len(stack)
            places[tag].append(k)
            stack.append((tag, element, stack[-1][2] if tag in INLINE else k, k if tag in SCOPE else stack[-1][3]))

        def close(k: int) -> None:
            """Closes the open elements from place k on."""
            nonlocal links, block
            while len(stack) > k:
                tag = stack.pop()[0]
                if tag:
                    places[tag].pop()
                    links -= tag == "a"
                    block += tag not in INLINE

        while at < n:
            start = find("<", at)
            if start < 0:
                text(source[at:])
                break
            if start > at:
                text(source[at:start])
            following = source[start + 1 : start + 2]
            if following == "/":
                name = NAME.match(source, start + 2)
                if start + 2 >= n:
                    text("</")
                    break
                at = find(">", start + 2) + 1
                if not at:
                    break
                if not name:
                    continue
                tag = name[0].lower()
                if tag == "head":
                    head = False
                elif tag == "br":
                    runs.append((stack[-1][1], " ", False, block))
                elif places[tag] and tag not in ("html", "body") and (tag not in INLINE or places[tag][-1] > stack[-1][2]):
                    close(places[tag][-1])
                continue
            if following in ("!", "?"):
                if source.startswith("<!--", start):
                    at = start + 5 if source.startswith(">", start + 4) else start + 6 if source.startswith("->", start + 4) else find("-->", start + 4) + 3
                    if at == 2:
                        break
                    continue
                if "]]>" not in endless and source.startswith("<![CDATA[", start):
                    at = find("]]>", start) + 3
                    if at > 2:
                        continue
                    endless.add("]]>")
                at = find(">", start) + 1
                if not at:
                    break
                continue
            name = NAME.match(source, start + 1)
            if not name:
                text("<")
                at = start + 1
                continue
            tag, at = name[0].lower(), name.end()
            if source.startswith(">", at):
                found, at, slash = {}, at + 1, False
            else:
                found, at, slash = attributes(source, at)
                if at < 0:
                    break
            if tag in RAW:
                if not slash or tag not in ("svg", "math", "template", "iframe"):
                    end = None
                    if tag not in endless:
                        end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                    if end:
                        at = find(">", end.end()) + 1
                        if not at:
                            break
                    else:
                        endless.add(tag)
                        if tag in ("script", "style", "title"):
                            break
                continue
            if tag in INLINE:
                if tag == "br":
                    runs.append((stack[-1][1], " ", False, block))
                elif tag not in VOID:
                    if tag == "a" and links:  # links don't nest
                        k = places["a"].pop()
                        stack[k] = ("", *stack[k][1:])
                        links -= 1
                    element, hidden = stack[-1][1], bool(found) and is_hidden(found)
                    hint = self._hints(found) if found else 0
                    if hint or hidden or tag == "label":
                        element = self._add(tag, element, found, hint, hidden)
                    push(tag, element)
                    links += tag == "a"
                continue
            if tag == "head":
                head = True
                continue
            if tag in ("html", "body"):
                head = False
                continue
            if head and tag in ("meta", "link", "base"):
                continue
            head = False
            block += 1
            ends = ENDS.get(tag) or ({"p"} if tag in ENDS_P else None)
            if ends:
                k = max([places[t][-1] for t in ends if places[t]], default=-1)
                if k > 0 and k >= stack[-1][3]:
                    close(k)
            if tag in VOID:
                continue
            element = self._add(tag, stack[-1][1], found, self._hints(found), is_hidden(found))
            if slash and tag not in ENDS_P:
                continue
            push(tag, element)

    @staticmethod
    def _hints(found: dict[str, str]) -> int:
        out = 0
        for name in ("class", "id", "role", "itemprop"):
            if name in found:
                out |= hints_of(found[name])
        return out

    def features(self) -> np.ndarray:
        n = len(self.tags)
        chars, linked, words, marks, own = ([0] * n for _ in range(5))
        for e, t, link, _ in self.runs:
            size = len(t.strip()) if len(t) < 200 else len(t)
            if size:
                chars[e] += size
                own[e] += size
                linked[e] += size if link else 0
                words[e] += t.count(" ") + 1
                marks[e] += t.count(".") + t.count(",") + t.count("!") + t.count("?")
        below, children = [0] * n, [0] * n
        parent = self.parent
        for e in range(n - 1, 0, -1):  # children come after their parents
            p = parent[e]
            chars[p] += chars[e]
            linked[p] += linked[e]
            words[p] += words[e]
            marks[p] += marks[e]
            below[p] += below[e] + 1
            children[p] += 1
        place, inherited, main, group = [0] * n, [0] * n, [0] * n, [0] * n
        seen = [0] * n
        for e in range(n):
            group[e] = TAG_GROUP.get(self.tags[e], N_TAGS - 1)
            p = parent[e]
            if p >= 0:
                place[e] = seen[p]
                seen[p] += 1
                inherited[e] = inherited[p] | (self.hints[p] | self.hints[p] >> N_HINTS) & ((1 << N_HINTS) - 1) | (group[p] in (6, 7, 8, 10)) << N_HINTS
                main[e] = main[p] or group[p] == 5
        a = lambda x: np.array(x, np.float64)
        chars_, linked_, words_, marks_, below_, children_, place_, own_ = map(a, (chars, linked, words, marks, below, children, place, own))
        p = np.maximum(np.array(parent), 0)
        siblings = children_[p]
        hints, up = np.array(self.hints), np.array(inherited)
        columns = [
            *(np.array(group) == g for g in range(N_TAGS)),
            *((hints >> h) & 1 for h in range(2 * N_HINTS)),
            *((up >> h) & 1 for h in range(N_HINTS + 1)),
            a(main), np.log1p(chars_), linked_ / np.maximum(chars_, 1), np.log1p(words_), marks_ / np.maximum(words_, 1), np.log1p(chars_ / (below_ + 1)),
            a(self.depth), np.log1p(children_), place_ / np.maximum(siblings, 1), siblings, np.log1p((chars_[p] - chars_) / np.maximum(siblings - 1, 1)), chars_ / max(chars[0], 1), chars_ / np.maximum(chars_[p], 1), np.log1p(own_), a(self.hidden),
        ]
        return np.stack([np.asarray(c, np.float64) for c in columns], 1)

    def kept(self, log_odds: list[float]) -> list[bool]:
        """The likeliest set of elements such that no element is kept below a dropped one, and none that is hidden. The root stays."""
        n, parent = len(self.tags), self.parent
        # with log(1 - p) of every element as the base, keeping an element gains its log odds and what is gained below it
        gain = [0.0] * n
        for e in range(n - 1, 0, -1):
            gain[e] += log_odds[e]
            if gain[e] > 0 and not self.hidden[e]:
                gain[parent[e]] += gain[e]
        out = [True] * n
        for e in range(1, n):
            out[e] = out[parent[e]] and gain[e] > 0 and not self.hidden[e]
        return out

    def text(self, kept: list[bool]) -> str:
        blocks: list[str] = []
        last, parts = None, []
        for e, t, _, b in self.runs:
            if kept[e]:
                if b != last:
                    if parts:
                        blocks.append("".join(parts))
                    last, parts = b, []
                parts.append(t)
        blocks.append("".join(parts))
        lines = [" ".join(b.split()) for b in blocks]
        return "\n".join([x for x in lines if x])


class Trees:
    """Gradient-boosted regression trees on the logistic loss, grown by histograms over quantile bins."""

    def __init__(self, rounds: int = 50, depth: int = 4, rate: float = 0.25, bins: int = 32, l2: float = 2.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2 = rounds, depth, rate, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        n, f = x.shape
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(f)]
        binned = self._binned(x)
        flat = binned.astype(np.int64) + np.arange(f) * (self.bins + 1)
        p = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
        self.base, self.feature, self.cut, self.leaf = float(np.log(p / (1 - p))), [], [], []
        margin, total = np.full(n, self.base), f * (self.bins + 1)
        for _ in range(self.rounds):
            chance = 1 / (1 + np.exp(-margin))
            g, h = weight * (y - chance), weight * chance * (1 - chance)
            node, feature, cut = np.zeros(n, np.int64), np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, self.bins + 1, np.int64)
            for level in range(self.depth):
                first, width = 2**level - 1, 2**level
                key = (node[:, None] * total + flat).ravel()
                sums = lambda v: np.bincount(key, np.repeat(v, f), width * total).reshape(width, f, self.bins + 1).cumsum(2)  # noqa: B023, E731
                gs, hs = sums(g), sums(h)
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                score = gs**2 / (hs + self.l2) + (gt - gs) ** 2 / (ht - hs + self.l2) - gt**2 / (ht + self.l2)
                score[:, :, -1] = 0
                at = score.reshape(width, -1).argmax(1)
                good = score.reshape(width, -1)[np.arange(width), at] > 1e-9
                feature[first : first + width] = at // (self.bins + 1)
                cut[first : first + width] = np.where(good, at % (self.bins + 1), self.bins + 1)
                node = node * 2 + (binned[np.arange(n), feature[first + node]] > cut[first + node])
            leaf = self.rate * np.bincount(node, g, 2**self.depth) / (np.bincount(node, h, 2**self.depth) + self.l2)
            margin = margin + leaf[node]
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(leaf)
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned, rows = self._binned(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = node * 2 + (binned[rows, feature[at]] > cut[at])
            out += leaf[node]
        return out


#: Pages that the trees are trained on, and the seed that they are made from.
TRAINING_PAGES, SEED = 900, 7
MARK = "\ue000"  # marks main text in training pages


def made_page(rnd: random.Random) -> str:
    """A page made by rule. Each run of its main text begins with MARK."""
    syllables = "ta ren so mi la ko dre in ver als un que est der pon ci".split()
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    phrase = lambda a, b: " ".join(word() for _ in range(rnd.randint(a, b)))
    chance = lambda p: rnd.random() < p

    def prose(a: int, b: int, mark: str = "") -> str:
        text = " ".join(phrase(3, 14).capitalize() + rnd.choice(".....,!?") for _ in range(rnd.randint(a, b)))
        if chance(0.25):
            words = text.split(" ")
            k = rnd.randrange(len(words))
            tag = rnd.choice(["a href='/x'", "b", "em", "span", "code"])
            name = attribute("content", 0.5) if chance(0.25) else stray() if chance(0.25) else ""
            words[k] = f"<{tag}{name}>{mark}{words[k]}</{tag.split()[0]}>"
            words[k + 1 : k + 2] = [mark + w for w in words[k + 1 : k + 2]]
            text = " ".join(words)
        if mark and chance(0.06):  # what doesn't belong, in the line
            k = rnd.choice(["advert", "advert", "form", "notice", "side"])
            t = rnd.choice(["span", "span", "a", "small", "label" if k == "form" else "b"])
            text += f" <{t}{attribute(k, 0.02)}>{phrase(1, 9)}</{t}> {mark}{phrase(2, 9)}"
        return mark + text

    def stray() -> str:
        """Attributes of main text: long names that hold some word, and values that say nothing."""
        w = rnd.choice(sorted(HINT_OF))
        long = rnd.choice([f"{w}-{word()}-{word()}", f"{word()}-{w}-{word()}", f"{word()}_{word()}_{w}"])
        return rnd.choice([f' class="{long}"', f' class="{long}"', f' title="{phrase(1, 3)} {w}"', f' data-id="{w}"', f' data-hidden="false" lang="{word()}"'])

    def attribute(kind: str | None, other: float = 0.25) -> str:
        if kind is None or chance(other):
            return f' class="{rnd.choice(["c", "x", "box", "css"])}-{rnd.randrange(99)}"' if chance(0.5) else ""
        w = rnd.choice(HINTS[kind].split())
        w = rnd.choice([w, w, f"{w}-{rnd.choice(['box', 'wrap', 'area', 'inner', 'block'])}", f"{word()}_{w}"])
        return f' {rnd.choice(["class", "class", "id"])}="{w}"'

    def listing(a: int, b: int, linked: float) -> str:
        item = lambda: f"<a href='/{word()}'>{phrase(1, 5)}</a>" if chance(linked) else phrase(1, 6)
        return "<ul>" + "".join(f"<li>{item()}</li>" for _ in range(rnd.randint(a, b))) + "</ul>"

    def menu() -> str:
        inner = listing(2, 9, 0.95) if chance(0.7) else " | ".join(f"<a href='/'>{phrase(1, 2)}</a>" for _ in range(rnd.randint(2, 8)))
        return f"<nav{attribute('menu', 0.6)}>{inner}</nav>" if chance(0.55) else f"<div{attribute('menu')}>{inner}</div>"

    def header() -> str:
        inner = f"<h1>{phrase(1, 3)}</h1>" * chance(0.4) + f"<p>{phrase(2, 8)}</p>" * chance(0.5) + (menu() if chance(0.4) else "") or phrase(1, 4)
        return f"<header{attribute('header', 0.6)}>{inner}</header>" if chance(0.6) else f"<div{attribute('header', 0.1)}>{inner}</div>"

    def footer() -> str:
        inner = rnd.choice(["&copy; ", "Copyright "]) + phrase(1, 3) + " &middot; " + prose(1, 2)
        inner = rnd.choice([inner, f"<p>{inner}</p>", inner + listing(1, 5, 0.9)])
        return f"<footer{attribute('footer', 0.7)}>{inner}</footer>" if chance(0.65) else f"<div{attribute('footer', 0.1)}>{inner}</div>"

    def side() -> str:
        inner = "".join(f"<h{rnd.choice('34')}>{phrase(1, 4)}</h3>" + rnd.choice([listing(2, 7, 0.8), f"<p>{prose(1, 2)}</p>"]) for _ in range(rnd.randint(1, 3)))
        return f"<aside{attribute('side', 0.6)}>{inner}</aside>" if chance(0.5) else f"<div{attribute('side', 0.1)}>{inner}</div>"

    def advert() -> str:
        inner = rnd.choice([prose(1, 2), f"<a href='http://x'>{phrase(2, 8)}</a>", f"<p>{prose(1, 3)}</p>"])
        return f"<{(t := rnd.choice(['div', 'div', 'section', 'aside', 'p']))}{attribute('advert', 0.02)}>{inner}</{t}>"

    def notice() -> str:
        inner = rnd.choice([prose(1, 2), f"<p>{prose(1, 3)}</p>"]) + f"<button>{word()}</button>" * chance(0.5)
        return f"<div{attribute('notice', 0.02)}>{inner}</div>"

    def form() -> str:
        inner = f"<label>{phrase(1, 3)}</label><input name=q><button>{word()}</button>" + f"<p>{phrase(3, 9)}</p>" * chance(0.4)
        return f"<form{attribute('form', 0.6)}>{inner}</form>" if chance(0.75) else f"<div{attribute('form', 0.02)}><form>{inner}</form></div>"

    def field() -> str:
        inner = f"<label>{phrase(1, 4)}</label> <input>"
        return rnd.choice([inner, f"<p>{inner}</p>", f"<div{attribute('form')}>{inner}</div>"])

    def comments() -> str:
        one = lambda: f"<{(t := rnd.choice(['div', 'li', 'article', 'p']))}{attribute('comment', 0.5)}><b>{word()}</b> {prose(1, 3)}</{t}>" if chance(0.5) else f"<div{attribute('comment', 0.4)}><h4>{phrase(1, 2)}</h4><p>{prose(1, 4)}</p></div>"
        inner = f"<h{(k := rnd.choice('234'))}>{phrase(1, 2)}</h{k}>" * chance(0.6) + "".join(one() for _ in range(rnd.randint(1, 7))) + (form() if chance(0.3) else "")
        return f"<{(t := rnd.choice(['section', 'div', 'ol', 'div']))}{attribute('comment', 0.02)}>{inner}</{t}>"

    def article() -> str:
        m = MARK
        parts = [f"<h1>{m}{phrase(2, 9)}</h1>"] if chance(0.85) else []
        if parts and chance(0.2):
            parts = [f"<header>{parts[0]}{f'<p>{m}{phrase(2, 5)}</p>' * chance(0.5)}</header>"]
        for _ in range(rnd.choice([1, 1, 2, 4, 8, 14])):
            kind = rnd.random()
            if kind < 0.62:
                parts.append(f"<p{stray() if chance(0.08) else ''}>{prose(1, rnd.choice([1, 3, 9]), m)}" + "</p>" * chance(0.9))
            elif kind < 0.7:
                parts.append(f"<h{(k := rnd.choice('23'))}>{m}{phrase(2, 7)}</h{k}>")
            elif kind < 0.78:
                parts.append(f"<p><b>{m}{prose(1, 1)}<br>")
            elif kind < 0.83:
                parts.append("<ul>" + "".join(f"<li>{m}{phrase(3, 14)}</li>" for _ in range(rnd.randint(2, 6))) + "</ul>")
            elif kind < 0.86:
                parts.append(f"<blockquote><p>{prose(1, 3, m)}</p></blockquote>")
            elif kind < 0.89:
                parts.append("<table>" + "".join(f"<tr><td>{m}{phrase(1, 3)}</td><td>{m}{phrase(1, 4)}</td></tr>" for _ in range(rnd.randint(2, 4))) + "</table>")
            elif kind < 0.92:
                parts.append(f"<pre>{m}{phrase(3, 20)}</pre>")
            else:
                parts.append(rnd.choice([advert, advert, side, notice, form, field])())
        inner = "".join(parts)
        if chance(0.2):
            inner += comments()
        shell = rnd.random()
        if shell < 0.5:
            return f"<article{attribute('content', 0.6)}>{inner}</article>"
        if shell < 0.62:
            return f"<main{attribute('content', 0.6)}>{inner}</main>"
        if shell < 0.72:
            return f"<main><div{attribute('content', 0.5)}><article>{inner}</article></div></main>"
        return f"<div{attribute('content', 0.25)}>{inner}</div>"

    before = [f() for f in rnd.sample([menu, header, advert, notice, side, form], rnd.randint(0, 4))]
    after = [f() for f in rnd.sample([side, advert, comments, footer, menu, notice, form], rnd.randint(0, 4))]
    if chance(0.6) and not any("<footer" in x for x in after):
        after.append(footer())
    body = "".join([*before, article(), *after])
    if chance(0.35):
        body = f"<div{attribute(None)}>{body}</div>"
    return f"<!DOCTYPE html><html><head><title>{phrase(2, 6)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>{body}" + "</body></html>" * chance(0.9)


@lru_cache(1)
def trained(pages: int = TRAINING_PAGES, seed: int = SEED) -> Trees:
    """Trees fitted on made pages. An element is to be kept where main text stands in its subtree."""
    rnd, xs, ys, ws = random.Random(seed), [], [], []
    for _ in range(pages):
        page = Page(made_page(rnd))
        keep, own = [0] * len(page.tags), [0] * len(page.tags)
        for k, (e, t, link, b) in enumerate(page.runs):
            keep[e] |= MARK in t
            own[e] += len(t)
            page.runs[k] = (e, t.replace(MARK, ""), link, b)
        for e in range(len(keep) - 1, 0, -1):
            keep[page.parent[e]] |= keep[e]
        xs.append(page.features())
        ys += keep
        ws += [1.0 + np.log1p(c) / 4 for c in own]
    return Trees().fit(np.concatenate(xs), np.array(ys, float), np.array(ws))


def main_texts(sources: list[str], trees: Trees) -> list[str]:
    pages = [Page(s) for s in sources]
    features = [p.features() for p in pages]
    if not pages:
        return []
    odds = trees.log_odds(np.concatenate(features)).tolist()
    out, at = [], 0
    for p in pages:
        out.append(p.text(p.kept(odds[at : at + len(p.tags)])))
        at += len(p.tags)
    return out


def extract(pages: DataFrame, trees: Trees | None = None, source: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Main text of each whole page.

    Returns per row: the keys, text (empty if none), n_chars (code points). Null and empty pages give an empty text;
    broken markup is read as browsers do for common cases; repeated rows stay rows; further columns are left out.
    """
    trees = trees or trained()
    rows = only(pages, *keys, source)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", text string, n_chars bigint"
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, n, 256):
            texts = main_texts([s or "" for s in batch.column(n).to_pylist()], trees)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keys, "text", "n_chars"])

    return rows.mapInArrow(run, schema)
