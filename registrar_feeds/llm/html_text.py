"""Main text of web pages by line-block distribution.

Markup is stripped to one line of text for each block; lines of menus, headers,
footers, sidebars, notices, adverts, forms, reader comments and hidden parts
weigh nothing.  Weights are summed over sliding windows of ``window`` lines;
the text surges where a window's sum rises above a part of the largest and
dives where the sums come to nothing, and the weighing lines between are kept.
Where a page marks its article (``article`` or ``main``) and no stretch outside
is heavier than it, only lines inside weigh, and every stretch of them is kept.
Elsewhere a line of links weighs nothing, and a stretch that does not surge is
kept if it stands in the heaviest one's element (below ``body``), however light;
a paragraph or item of links is kept among weighing ones of the same parent,
and before or after them if it has words beside the links.

What names an element as none of the text is its class, id or role.  A whole name
of strong meaning (``comments``) leaves it out.  A compound whose first or last word
has such a meaning (``site-footer``), or a whole name of weaker meaning, makes it a
suspect, and so is a form; compounds that deny or merely mention (``no-sidebar``,
``has-banner``) do not count.  A suspect goes if it weighs no more than the rest of
the page, or ten times that for what readers and advertisers add, so that the
element around the heaviest text stays whatever its name.  Inside an article a
compound counts by its first word, and only in classes of block elements.  The ids
of headings and sections name their subject, and so do ids of more words inside an
article.  In an article, lists and other blocks of links alone before its first and
after its last weighing line go.

Elements end as in HTML: a paragraph before the next block, an item, cell, row
or option before its next sibling, everything with its parent; a link that is
never closed ends at the next block or link.

Defined cases: a null or empty page, or one of markup alone, has an empty text;
other unclosed and cut-off tags end with the page; of stretches and suspects that
weigh the same the first one counts as the heaviest; very long pages are read whole, in
one row; equal rows are equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar_feeds.llm.common import modest_batches, table

WINDOW = 3
#: Part of the largest window sum at which text surges, and of a line that
#: links may fill.
SURGE = 0.1
LINKS = 0.5

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, and elements that never hold the text.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
OUT = frozenset("""nav footer aside form menu dialog noscript template svg math button select option
object canvas audio video head search fieldset""".split())
#: Words of class, id and role that say the same.
OUT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo
promotion banner cookie cookies consent gdpr notice popup modal overlay nav navbar navigation menu breadcrumb
breadcrumbs sidebar aside footer masthead topbar comment comments commentlist disqus replies respond share sharing
social related recommended newsletter subscribe signup login widget pagination pager complementary contentinfo
alertdialog alert search""".split())

#: Elements that others end in: blocks, and what else is left out whole.
_HOLDS = BLOCKS | OUT | RAW | {"datalist"}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that are text among their siblings, also where links fill them.
_PARTS = _HEADINGS | frozenset("p li dd dt td th blockquote pre figcaption caption summary".split())
#: Those of them that a list or table of links does not have.
_OWN = _PARTS - frozenset("li dd dt td th".split())
_SCOPE = frozenset("article main table caption td th button object template select".split())
#: What the start of an element ends, and what it does not reach beyond.
_ENDS = {
    **dict.fromkeys(BLOCKS - frozenset("""body caption head html legend optgroup option tbody td tfoot th thead
title tr""".split()) | {"xmp"}, (frozenset(["p"]), _SCOPE)),
    **dict.fromkeys(["td", "th"], (frozenset("td th".split()), frozenset("tr table".split()))),
    "tr": (frozenset("td th tr".split()), frozenset("tbody thead tfoot table".split())),
    **dict.fromkeys("tbody thead tfoot".split(), (frozenset("caption td th tr tbody thead tfoot".split()), frozenset(["table"]))),
    "option": (frozenset(["option"]), frozenset("optgroup select datalist".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
}
_ITEMS = {"li": (frozenset(["li"]), _SCOPE | frozenset("ul ol menu dir".split())),
          **dict.fromkeys(["dd", "dt"], (frozenset(["dd", "dt"]), _SCOPE | {"dl"}))}
#: Closing tags that reach further than others.
_ENDS_REACH = {**dict.fromkeys("table caption tbody thead tfoot tr td th".split(), frozenset("table template article main".split())),
               **dict.fromkeys(["article", "main"], frozenset())}
#: Open elements that an implied end is looked for among, as in browsers.
DEPTH = 512

#: Classes, roles and ids that say it inside an article.
OUT_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsored promo promotion
cookie cookies consent gdpr popup modal overlay nav navbar navigation breadcrumb breadcrumbs sidebar masthead topbar
comments commentlist disqus newsletter subscribe signup login pagination pager complementary contentinfo
alertdialog""".split())

#: First words of a compound class that make a suspect inside an article.
OUT_HEADS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo
promotion cookie cookies consent gdpr notice popup modal overlay navbar breadcrumb breadcrumbs sidebar comment
comments commentlist disqus replies share sharing related recommended newsletter subscribe signup pagination
pager""".split())
#: Words that deny or mention what the rest of a compound names.
MENTIONS = frozenset("no non not without with has have hide enabled disabled".split())
#: What readers, advertisers and the site's owner add: suspects at any weight up to 1 / SURGE of the rest.
ADDED = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsored cookie cookies consent gdpr
comment comments commentlist disqus replies respond newsletter nav navbar navigation breadcrumb breadcrumbs pagination
pager""".split())
#: Kinds of left-out elements.
SURE, ADDITION, SUSPECT = 3, 2, 1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*)|(?=[\s/]|$))""", re.I)
_WORD = re.compile(r"[a-z]+")


class _Line(NamedTuple):
    text: str
    weight: int  # length of what is not link text
    region: int | None = None  # the outermost article or main around it
    top: int = -1  # the element below body that it shares with others; -1: none
    parent: int = -1  # the element around its block
    block: str = ""  # the name of its block
    plain: bool = False  # are there letters outside of links?
    out: bool = False  # within a left-out element that stays for the article in it


class _Page:
    """Tokens of a page: text, and tags with the place of the closing one."""

    def __init__(self, source: str):
        self.tokens: list[tuple] = []  # (text, None, None) or (closing, name, attributes)
        at = 0
        while m := _TOKEN.search(source, at):
            if m.start() > at:
                self.tokens.append((source[at:m.start()], None, None))
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            closing = bool(m[1] or m[4])
            self.tokens.append((closing, name, m[3] or m[6] or ""))
            if name in RAW and not closing:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = end.start() if end else len(source)
        if at < len(source):
            self.tokens.append((source[at:], None, None))
        self.close = self._ends()
        # text holders: an article or main that is not itself left out
        self.mains = [i for i, (closing, name, attrs) in enumerate(self.tokens)
                      if name in ("article", "main") and not closing and self._named_out(name, attrs, True) != SURE]
        self.kinds: dict[int, int] = {}
        self.going = self._suspects()

    def _ends(self) -> dict[int, int]:
        """For each element's first token the last one: its closing tag, or what
        stands before the tag that ends it.  Without it: up to the page's end."""
        close: dict[int, int] = {}
        held: list[tuple] = [(-1, "", {})]  # open elements that hold others, with the inline ones open in them
        named: dict[str, list] = {}  # all open ones by name, the latest last
        loose: list[int] = []  # links without a closing tag

        def shut(k: int, at: int) -> None:
            while len(held) > k:
                i, name, inline = held.pop()
                for j, other in inline.items():
                    named[other].pop()
                    (loose.append(j) if other == "a" else close.setdefault(j, at))
                if i not in close:
                    named[name].pop()
                    close[i] = at

        def reach(ends: frozenset, stops: frozenset) -> int | None:
            """The outermost open element of ``ends`` before one of ``stops``."""
            found = None
            for k in range(len(held) - 1, max(0, len(held) - 1 - DEPTH), -1):
                if held[k][0] in close:
                    continue
                if held[k][1] in ends:
                    found = k
                elif held[k][1] in stops:
                    break
            return found

        for i, (closing, name, _) in enumerate(self.tokens):
            if name is None or name in ("html", "body"):
                continue
            if not closing:
                for ends, stops in filter(None, (_ITEMS.get(name), _ENDS.get(name))):
                    if any(named.get(x) for x in ends) and (k := reach(ends, stops)):
                        shut(k, i - 1)
                if name in _HEADINGS and held[-1][1] in _HEADINGS and held[-1][0] not in close:
                    shut(len(held) - 1, i - 1)
                if name in VOID:
                    continue
                if name in _HOLDS:
                    held.append((i, name, {}))
                    named.setdefault(name, []).append(held[-1])
                else:
                    if name == "a" and named.get("a"):  # a link holds no other
                        j, inline = named["a"].pop()
                        del inline[j]
                        loose.append(j)
                    held[-1][2][i] = name
                    named.setdefault(name, []).append((i, held[-1][2]))
            elif named.get(name):
                if name not in _HOLDS:
                    j, inline = named[name].pop()
                    del inline[j]
                    close[j] = i
                    continue
                stops = _ENDS_REACH.get(name, _SCOPE) - {name}
                k = reach(frozenset([name]), stops)
                last = named[name][-1]
                if k is not None:  # the innermost of that name, with all that is open in it
                    while held[-1] is not last:
                        shut(len(held) - 1, i - 1)
                    shut(len(held) - 1, i)
                else:  # tags that cross: what lies between stays open
                    named[name].pop()
                    close[last[0]] = i
        loose += [j for j, _ in named.get("a", [])]
        if loose:
            ends, at = {}, len(self.tokens)
            wanted = set(loose)
            for i in range(len(self.tokens) - 1, -1, -1):
                name = self.tokens[i][1]
                if i in wanted:
                    ends[i] = at - 1
                if name in BLOCKS or name == "a" and not self.tokens[i][0]:
                    at = i
            close |= ends
        return close

    @staticmethod
    def _named_out(name: str, attrs: str, inside: bool) -> int:
        found = _ATTR.findall(attrs)
        classes = {x for key, value in found if key.lower() == "class" for x in value.strip("\"'").lower().split()}
        kind = 0
        for key, value in found:
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return SURE
            if key == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    return SURE
            elif key == "id" and (name in _HEADINGS or name == "section" or "section" in classes):
                continue
            elif key in ("class", "id", "role"):
                if not OUT_NAMES.isdisjoint(value.split()):
                    return SURE
                if inside and key == "class" and name in BLOCKS and "comment" in value.split():
                    return SURE  # of a reader; within a line it is one of program code
                for token in value.split():
                    words = _WORD.findall(token)
                    if not words or not MENTIONS.isdisjoint(words):
                        continue
                    if inside:
                        named = words[:1] if key == "class" and name in BLOCKS and words[0] in OUT_HEADS else []
                    else:
                        named = [w for w in (words[0], words[-1]) if w in OUT_WORDS]
                    if named:
                        kind = max(kind, SUSPECT if ADDED.isdisjoint(named) else ADDITION)
        return kind

    def _kind(self, i: int, inside: bool) -> int:
        """Is the element that opens at token ``i`` one that holds no main text?"""
        _, name, attrs = self.tokens[i]
        if name in ("html", "body"):
            return 0
        if name in RAW or name in OUT and name != "form" or name == "header" and not inside:
            return SURE
        kind = self._named_out(name, attrs, inside or name in ("article", "main")) if attrs else 0
        if name in ("article", "main"):
            return kind if kind == SURE else 0
        return max(kind, SUSPECT) if name == "form" else kind

    def _suspects(self) -> set[int]:
        """The suspects that go, by their weights without those of suspects and articles in them."""
        n, mains = len(self.tokens), set(self.mains)
        own: dict[int, int] = {}
        around: dict[int, int] = {}  # the suspect around a suspect
        rest, link_end, inside = 0, -1, 0
        stack: list[tuple[int, int, bool]] = []  # end, whose weight it is (-1: the rest, -2: none), an article?
        for i, (closing, name, _) in enumerate(self.tokens):
            while stack and i > stack[-1][0]:
                inside -= stack.pop()[2]
            if name is None:
                if i > link_end:
                    to = stack[-1][1] if stack else -1
                    if to == -1:
                        rest += len(closing.strip())
                    elif to >= 0:
                        own[to] += len(closing.strip())
            elif not closing and name not in VOID:
                end = self.close.get(i, n)
                if name == "a":
                    link_end = max(link_end, end)
                kind = self.kinds[i] = self._kind(i, inside > 0)
                if i in mains:
                    stack.append((end, -1, True))
                    inside += 1
                elif kind == SURE:
                    stack.append((end, -2, False))
                elif kind and not (stack and stack[-1][1] == -2):
                    own[i], around[i] = 0, stack[-1][1] if stack else -1
                    stack.append((end, i, False))
        going: set[int] = set()
        stays: set[int] = set()

        def chain(i: int) -> Iterator[int]:
            while (i := around.get(i, -1)) >= 0:
                yield i

        for i in sorted(own, key=lambda i: (-own[i], i)):
            if i in stays:
                continue
            most = rest if self.kinds[i] == SUSPECT else rest / SURGE
            if own[i] <= most or not going.isdisjoint(chain(i)):
                going.add(i)
            else:
                rest += own[i]
                stays.update([i, *chain(i)])
        return going

    def left_out(self, i: int, inside: bool) -> bool:
        """Does the element that opens at token ``i`` go?"""
        return self.kinds.get(i, 0) == SURE or i in self.going

    def lines(self) -> list[_Line]:
        """One for each block; an empty one for each left-out block."""
        out: list[_Line] = []
        text: list[str] = []
        linked = 0
        link_end = out_end = -1
        plain = False
        place: tuple = ()
        mains_open: list[tuple[int, int]] = []  # end, token
        path: list[tuple[int, str, int]] = []  # open elements around: token, name, end

        def end_line() -> None:
            nonlocal text, linked, plain, place
            line = " ".join(html.unescape("".join(text)).split()) if text else ""
            if line:
                out.append(_Line(line, max(0, len(line) - linked), mains_open[0][1] if mains_open else None,
                                 *(place or (-1, -1, "", False))[:3], plain, bool(place and place[3])))
            text, linked, plain, place = [], 0, False, ()

        i, mains, n = 0, set(self.mains), len(self.tokens)
        while i < n:
            closing, name, _ = self.tokens[i]
            while mains_open and i >= mains_open[-1][0]:
                end_line()
                mains_open.pop()
            while path and i > path[-1][2]:
                path.pop()
            if name is None:
                text.append(closing)
                bare = closing.strip()
                if bare and not place:
                    shared = len(path) > 1
                    place = (path[0][0] if shared else -1, path[-2][0] if shared else -1, path[-1][1] if path else "", i <= out_end)
                if i < link_end:
                    linked += len(bare)
                elif not plain:
                    plain = any(map(str.isalpha, bare))
            elif closing:
                if name in BLOCKS:
                    end_line()
            elif name in VOID:
                if name == "hr":
                    end_line()
                elif name in ("br", "wbr") and name == "br":
                    text.append(" ")
            else:
                end = self.close.get(i)
                skip = self.left_out(i, bool(mains_open))
                if skip and name not in ("article", "main"):
                    at = bisect.bisect_right(self.mains, i)
                    first = self.mains[at] if at < len(self.mains) else n
                    if first < (n if end is None else end):  # what wraps the article stays
                        skip, out_end = False, max(out_end, first - 1 if end is None else end)
                if skip:
                    if name in BLOCKS or name in OUT:
                        end_line()
                    # its lines weigh nothing: one empty line stands for them
                    if name in BLOCKS:
                        out.append(_Line("", 0, mains_open[0][1] if mains_open else None))
                    if end is None:  # never closed: up to the article, or the end
                        end = next((m for m in self.mains if m > i), n) - 1
                    i = max(i, end)
                else:
                    if name == "a":
                        link_end = max(link_end, (n if end is None else end) + 1)
                    elif name in BLOCKS:
                        end_line()
                    if name in _HOLDS and name not in ("html", "body"):
                        path.append((i, name, n if end is None else end))
                    if i in mains:
                        mains_open.append((n if end is None else end, i))
            i += 1
        end_line()
        return out


def stretches(weights: list[int], window: int = WINDOW, surge: float = SURGE) -> list[tuple[int, int]]:
    """Lines [from, to) between surge and dive points of the window sums."""
    n = len(weights)
    sums = [sum(weights[max(0, i):i + window]) for i in range(1 - window, n)]
    most = max(sums, default=0)
    out: list[tuple[int, int]] = []
    at = 0
    while at < len(sums):
        if not sums[at]:
            at += 1
            continue
        dive = at
        while dive < len(sums) and sums[dive]:
            dive += 1
        if max(sums[at:dive]) >= surge * most:
            out.append((at, min(n, dive - window + 1)))  # the weighing lines at both ends
        at = dive
    return out


def main_text(source: str | None, window: int = WINDOW, surge: float = SURGE, links: float = LINKS) -> str:
    if not source:
        return ""
    lines = _Page(source).lines()
    weights = [x.weight if x.weight > (1 - links) * len(x.text) and not x.out else 0 for x in lines]
    regions: dict[int, int] = {}
    for x in lines:
        if x.text and x.region is not None:
            regions[x.region] = regions.get(x.region, 0) + x.weight
    outside = [0 if x.region is not None else w for x, w in zip(lines, weights, strict=True)]
    if regions and max(regions.values()) >= max((sum(outside[a:b]) for a, b in stretches(outside, window, 0.0)), default=0):
        ends: dict[int, list[int]] = {}  # first and last weighing line of an article
        for i, x in enumerate(lines):
            if x.region is not None and weights[i]:
                ends.setdefault(x.region, [i, i])[1] = i
        weights = [len(x.text) if x.region is not None and (
            x.region not in ends or ends[x.region][0] <= i <= ends[x.region][1] or x.plain or x.block in _OWN) else 0
            for i, x in enumerate(lines)]
        found = stretches(weights, window, 0.0)
        beside = []
    else:
        found = stretches(weights, window, 0.0)
        if found:
            surging = set(stretches(weights, window, surge))
            tops = lambda f: {lines[i].top for i in range(*f) if weights[i]}
            heaviest = tops(max(found, key=lambda f: sum(weights[f[0]:f[1]])))
            found = [f for f in found if f in surging or not heaviest.isdisjoint(tops(f))]
        spans: dict[int, list[int]] = {}  # first and last weighing line of a parent
        for i in (i for a, b in found for i in range(a, b) if weights[i]):
            spans.setdefault(lines[i].parent, [i, i])[1] = i
        beside = [i for i, x in enumerate(lines) if x.text and not weights[i] and not x.out and x.block in _PARTS
                  and x.parent in spans and (x.plain or spans[x.parent][0] < i < spans[x.parent][1])]
    assert all(a[1] <= b[1] for a, b in pairwise(found))
    keep = sorted({i for a, b in found for i in range(a, b) if weights[i]}.union(beside))
    return "\n\n".join(lines[i].text for i in keep)


def extract(pages: DataFrame, **options) -> DataFrame:
    """page_id, url, text for each row of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            text = pa.array([main_text(h, **options) for h in rb["html"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([rb["page_id"], rb["url"], text], ["page_id", "url", "text"])

    return modest_batches(pages.select("page_id", "url", "html")).mapInArrow(
        run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string")


def op4_html_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
