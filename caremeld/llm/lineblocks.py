"""Main text of HTML pages by the distribution of text over lines.

Markup is stripped and every block element starts a new line, which weighs its characters. The weights are summed over
sliding windows of lines; a sum that rises over the surge bound opens a stretch, a sum that falls to the dive bound, with
no later surge among neighbours of its kind, closes it, and the text between is kept, short lines included. Windows do not
reach from one kind of element into another.

Tags move the weights. A line of an article or main element weighs a surge at least, so the author's word is taken
for it. A line in an element whose class or id has a word of menus, notices, adverts, comments and the like, or in a form,
counts ``soft`` of its weight towards a surge for every such element around it.
Its stretch is rescued if it surges even so and if, counted in that way, the page's marked stretches weigh as much as the
text kept without them: a wrapper that holds the whole text is, a notice or a thread of comments beside the text is not.
Lines in elements that are no text by their tag or role (menus, page headers, footers, asides, hidden ones) weigh nothing,
and so do lines outside of an article that are mostly links.

Fallback: a page on which no sum surges keeps all lines that weigh anything and are not marked; if these weigh no more than
the dive bound together, the marked stretches that surge with their whole weight, if there are any. Limits: as windows look
ahead, up to ``lines`` - 1 short lines right before a stretch are kept with it (its heading is one); a notice of
unmarked text as long as a paragraph counts as text, and so do unmarked short lines between two paragraphs.

Null and empty pages have no text. White space inside a block becomes one space, blocks are joined by a line break;
nothing is cut. Repeated rows give repeated results; an empty table gives an empty result. Nested, stray and unfinished
tags cost no more than others; a tag that is not finished at the end of the page is markup.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass, replace
from html.parser import HTMLParser

from pyspark.sql import Column

from caremeld.llm.shared import per_text

# Element names of HTML by their role.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript object ol optgroup "
    "option p pre search section select summary table tbody td template textarea tfoot th thead title tr ul video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript iframe head title select textarea button".split())
FRAME = frozenset("nav header footer aside menu dialog".split())
MARKS = frozenset(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "header footer masthead sidebar aside widget related recommended comment comments disqus replies reply share sharing social "
    "cookie cookies consent gdpr notice notices alert disclaimer newsletter subscribe signup login popup modal pagination pager "
    "toolbar legal copyright".split()
)
WHOLE = frozenset("html body article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
SPACE = re.compile(r"\s+")
#: The beginning of a tag, a comment or a declaration.
UNFINISHED = re.compile("<[A-Za-z/!?]")


@dataclass(frozen=True)
class Windows:
    """``lines``: lines of a window; ``surge``/``dive``: weights in characters that open a stretch and close it; ``soft``: what
    is left of a weight in an element marked by its words."""

    lines: int = 3
    surge: int = 140
    dive: int = 60
    soft: float = 0.2
    link_share: float = 0.7


class Lines(HTMLParser):
    """The lines of a page: text, characters in links, whether no text by tag or role, in an article, marked elements around."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, bool, int]] = []
        self.open: list[tuple[str, bool, bool, bool]] = []
        self.names: Counter[str] = Counter()
        self.text: list[str] = []
        self.linked = self.unseen = self.framed = self.marked = self.links = self.articles = 0

    def flush(self) -> None:
        line = SPACE.sub(" ", "".join(self.text)).strip()
        if line:
            self.lines.append((line, self.linked, self.framed > 0, self.articles > 0, self.marked))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
        if tag in VOID:
            return
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            self.close_like(tag)
        given = {k: v or "" for k, v in attrs}
        words = re.findall(r"[a-z]+", f"{given.get('class', '')} {given.get('id', '')}".lower())
        framed = tag in FRAME or given.get("role", "").lower() in ROLES or "hidden" in given
        marked = not framed and tag not in WHOLE and (tag == "form" or any(w in MARKS for w in words))
        if tag == "header" and self.articles and not given:  # the heading of an article, not of the page
            framed = False
        unseen = tag in UNSEEN
        self.open.append((tag, framed, marked, unseen))
        self.names[tag] += 1
        self.framed += framed
        self.marked += marked
        self.unseen += unseen
        self.links += tag == "a"
        self.articles += tag in ("article", "main")

    def close_like(self, tag: str) -> None:
        """An element that ends where the next of its kind begins."""
        if self.open and self.open[-1][0] == tag:
            self.pop()

    def pop(self) -> None:
        tag, framed, marked, unseen = self.open.pop()
        self.names[tag] -= 1
        self.framed -= framed
        self.marked -= marked
        self.unseen -= unseen
        self.links -= tag == "a"
        self.articles -= tag in ("article", "main")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        if self.names[tag]:
            while self.open[-1][0] != tag:
                self.pop()
            self.pop()

    def handle_data(self, data):
        if not self.unseen:
            self.text.append(data)
            if self.links and not self.articles:
                self.linked += len(data.strip())


def stretches(weights: list[int], windows: Windows) -> list[bool]:
    """Which lines lie between the first surge and the last dive of the sums over ``windows.lines`` lines from each line on."""
    n, width = len(weights), windows.lines
    first = last = None
    total, inside = sum(weights[:width]), False
    for i in range(n):
        if not inside and total >= windows.surge and weights[i]:
            inside, first = True, i if first is None else first
        elif inside and total <= windows.dive:
            inside = False
        last = i if inside else last
        total += (weights[i + width] if i + width < n else 0) - weights[i]
    return [first is not None and first <= i <= last and weights[i] > 0 for i in range(n)]


def kept_lines(weights: list[int], windows: Windows, kinds: list | None = None) -> list[bool]:
    """The lines of stretches, or all that weigh anything if there is none; windows hold neighbours of one kind.

    A kind is (in an article, marked elements around the line); without kinds all lines are plain.
    """
    kinds = kinds or [(False, 0)] * len(weights)
    least = sys.float_info.min  # the share left in deeply nested marked elements

    def by_kind(soft: float) -> list[bool]:
        keep: list[bool] = []
        while len(keep) < len(weights):
            begin = end = len(keep)
            while end < len(weights) and kinds[end] == kinds[begin]:
                end += 1
            keep += stretches(weights[begin:end], replace(windows, surge=windows.surge / max(soft ** kinds[begin][1], least)))
        return keep

    keep = by_kind(windows.soft)
    plain = sum(w for w, k, (_, marked) in zip(weights, keep, kinds) if k and not marked)
    rescued = sum(w * windows.soft**marked for w, k, (_, marked) in zip(weights, keep, kinds) if k and marked)
    if rescued < plain or not rescued:
        keep = [k and not marked for k, (_, marked) in zip(keep, kinds)]
    if any(keep):
        return keep
    all_plain = [w > 0 and not marked for w, (_, marked) in zip(weights, kinds)]
    if sum(w for w, k in zip(weights, all_plain) if k) > windows.dive:
        return all_plain
    whole = by_kind(1.0)
    return whole if any(whole) else all_plain


def main_text(html: str, windows: Windows = Windows()) -> str:
    parser = Lines()
    whole = html.rfind(">") + 1
    unfinished = UNFINISHED.search(html, whole)
    parser.feed(html[: unfinished.start()] if unfinished else html)
    parser.close()
    parser.flush()
    weights, kinds = [], []
    for line, linked, framed, article, marked in parser.lines:
        if framed or linked > windows.link_share * len(line):
            weight = 0
        else:
            weight = max(len(line), windows.surge) if article and not marked else len(line)
        weights.append(weight)
        kinds.append((article, marked))
    return "\n".join(line for (line, *_), keep in zip(parser.lines, kept_lines(weights, windows, kinds)) if keep)


def extracted(html: Column, windows: Windows = Windows()) -> Column:
    return per_text(lambda: lambda value: main_text(value, windows), "string")(html)
