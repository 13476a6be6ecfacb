"""Main-text extraction by tag-path ratios (operator 8).

A page is cut into blocks of text, each with its path of block-level tags from
the root.  Text length and punctuation are aggregated per path and divided by
its nodes; both ratios are smoothed along the page, fused (with the share of
text outside links), and paths above the page's threshold are content.  The
main text is every article and main element, if these hold half of the content
or more, or else the lowest common ancestor of all content; all blocks below are
taken, except for parts that name themselves as something else (menus, adverts,
notices, forms, reader comments, ...).

Names in classes and ids are only hints: html, body, and what holds an article
or main element never count as such a part, nor does a name whose elements hold
half of the text (nine tenths, for names of reader comments), nor the header of
an article.

Defined results: null, empty or tag-free html - plain text is one block - and
pages without content give the empty string or what text there is; unclosed and
stray tags are tolerated as browsers do; repeated rows are extracted alike; an
empty table gives an empty table; further columns are kept.  Whole pages are
read, one at a time.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: element classes of HTML
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head title script style noscript template textarea select option button svg iframe object canvas audio "
                   "video map fieldset input dialog".split())
ASIDE = frozenset("nav footer aside menu".split())
CONTAINERS = frozenset("article main".split())
#: parts of class, id and role values that tell what is not the article
TELLING = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
                    "complementary contentinfo consent cookie cookies copyright disclaimer disqus footer gdpr header hidden login "
                    "masthead menu modal navbar navigation nav newsletter notice notices pager pagination paywall popup promo "
                    "promoted recommended related replies respond search share sharing sidebar signup social sponsor sponsored "
                    "subscribe tags toolbar widget alert".split())
#: names of the readers' part, which can be longer than the article; elsewhere an article is never named away
READERS = frozenset("comment comments commentlist disqus replies respond".split())
#: words that make a name a state or the article's own
STATES = frozenset("has no not is with without show hide enable overflow js".split())
OWN = frozenset("article post entry story content page".split())
ROOTS = frozenset("html body".split())
HELD, HELD_READERS = 0.5, 0.9
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "p": {"p"}}
LIST_OF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
           "option": {"select"}}

PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|"
                   r"</?([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、؟]")


def _telling_words(name: str) -> set[str]:
    """The words of a class or id that tell what is not the article."""
    parts = [x.lower() for x in NAME_PART.findall(name)]
    if len(parts) < 2:
        return TELLING.intersection(parts)
    if parts[0] in STATES:
        return set()
    return TELLING.intersection(parts) - {"hidden"} - ({"header"} if OWN.intersection(parts) else set())


def _tells(tag: str, attributes: str, inside: bool) -> tuple[bool, frozenset[str]]:
    """Whether the element says that it is not part of the article, and the names by which it may say so."""
    if tag in ROOTS:
        return False, frozenset()
    if tag in SILENT or tag in ASIDE or tag == "header" and not inside:
        return True, frozenset()
    names = {"<form>"} if tag == "form" else set()
    for name, a, b, c in ATTRIBUTE.findall(attributes or ""):
        value, name = a or b or c, name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, frozenset()
        if name == "role" and tag not in CONTAINERS and value.lower() in TELLING:
            return True, frozenset()
        if name in ("class", "id"):
            for token in value.split():
                words = _telling_words(token)
                if words & READERS or words - ({"header"} if inside else set()) and tag not in CONTAINERS:
                    names.add(token)
    return False, frozenset(names)


class Page:
    """The blocks of a page: text, link characters, path of tags, node numbers, and whether some element tells against it.

    ``names`` holds the telling names of nodes, ``holders`` the nodes above an article or main element.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int, tuple[str, ...], tuple[int, ...], bool]] = []
        self.stack: list[tuple[str, int, bool]] = []
        self.text: list[str] = []
        self.linked, self.links, self.nodes = 0, 0, 0
        self.names: dict[int, frozenset[str]] = {}
        self.holders: set[int] = set()
        at = 0
        for m in PIECE.finditer(source):
            if m.start() > at:
                self._add(source[at:m.start()])
            at = m.end()
            if m[2]:
                self._tag(m[2].lower(), m[3], m[0][1] == "/")
        if at < len(source):
            self._add(source[at:])
        self._flush()

    def _add(self, raw: str) -> None:
        self.text.append(raw)
        if self.links:
            self.linked += len(raw)

    def _flush(self) -> None:
        text = " ".join(entities.unescape("".join(self.text)).split())
        if text:
            self.blocks.append((text, self.linked, tuple(t for t, _, _ in self.stack), tuple(n for _, n, _ in self.stack),
                                any(x for _, _, x in self.stack)))
        self.text, self.linked = [], 0

    def _tag(self, tag: str, attributes: str, closes: bool) -> None:
        if tag in INLINE:
            if tag == "a":
                self.links = 0 if closes else 1
            if tag == "br":
                self.text.append(" ")
            return
        self._flush()
        self.links = 0
        if closes:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    del self.stack[i:]
                    return
                if self.stack[i][0] in CONTAINERS and tag in ("p", "div", "li", "ul", "span"):
                    return
            return
        self._close_open(tag)
        if tag in VOID or attributes.rstrip().endswith("/") and tag in SILENT:
            return
        inside = any(t in CONTAINERS for t, _, _ in self.stack)
        tells, names = _tells(tag, attributes, inside)
        self.nodes += 1
        if names:
            self.names[self.nodes] = names
        if tag in CONTAINERS and not tells and not names and not any(x for _, _, x in self.stack):
            self.holders.update(n for _, n, _ in self.stack)
        self.stack.append((tag, self.nodes, tells))

    def _close_open(self, tag: str) -> None:
        """A new block ends an open paragraph; list items, cells and rows end their like."""
        if self.stack and self.stack[-1][0] == "p":
            self.stack.pop()
        ends, bound = CLOSED_BY.get(tag, ()), LIST_OF.get(tag, ())
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in ends:
                del self.stack[i:]
                return
            if not ends or self.stack[i][0] in bound or self.stack[i][0] in CONTAINERS:
                return


def main_text(source: str | None) -> str:
    """The main text of a page, its blocks joined by line feeds."""
    if not source:
        return ""
    blocks = _unnamed(Page(source))
    if not blocks:
        return ""
    totals: dict[tuple[str, ...], list[float]] = {}
    for text, linked, path, _, _ in blocks:
        t = totals.setdefault(path, [0, 0, 0, 0])
        t[0] += len(text)
        t[1] += len(PUNCTUATION.findall(text))
        t[2] += 1
        t[3] += min(linked, len(text))
    ratio = [(totals[p][0] / totals[p][2], totals[p][1] / totals[p][2]) for _, _, p, _, _ in blocks]
    smooth = []
    for i in range(len(ratio)):
        near = ratio[max(0, i - 1):i + 2]
        smooth.append([sum(x[j] for x in near) / len(near) for j in (0, 1)])
    score: dict[tuple[str, ...], float] = {}
    for (_, _, path, _, _), (length, marks), own in zip(blocks, smooth, ratio):
        free = 1 - totals[path][3] / totals[path][0]
        score[path] = max(score.get(path, 0.0), (length + own[0]) * (1 + marks + own[1]) * free)
    threshold = sum(score.values()) / len(score) / 2
    chosen = [b for b in blocks if score[b[2]] >= threshold and score[b[2]] > 0]
    if not chosen:
        return ""
    nodes = _content_nodes(blocks, chosen)
    return "\n".join(b[0] for b in blocks if nodes is None or not nodes.isdisjoint(b[3]))


def _unnamed(page: Page) -> list:
    """The blocks outside the parts that say they are something else."""
    blocks = [b for b in page.blocks if not b[4]]
    if not page.names:
        return blocks
    base = [b for b in blocks if not CONTAINERS.isdisjoint(b[2])] or blocks
    held: dict[str, int] = {}
    for text, _, _, nodes, _ in base:
        for name in {x for n in nodes for x in page.names.get(n, ())}:
            held[name] = held.get(name, 0) + len(text)
    total = sum(len(b[0]) for b in base)
    least = lambda name: HELD_READERS if _telling_words(name) & READERS else HELD      # noqa: E731
    wraps = {name for name, n in held.items() if n >= least(name) * total}
    told = {n for n, names in page.names.items() if n not in page.holders and names - wraps}
    return [b for b in blocks if told.isdisjoint(b[3])]


def _content_nodes(blocks: list, chosen: list) -> set[int] | None:
    """Nodes whose blocks are the main text: articles and main elements, or a common ancestor of all content; None: all."""
    within = [b for b in blocks if not CONTAINERS.isdisjoint(b[2])]
    total = sum(len(b[0]) for b in chosen)
    if 2 * sum(len(b[0]) for b in chosen if not CONTAINERS.isdisjoint(b[2])) >= total:
        # the innermost container of each block; a common container takes in what stands between them
        inner = {max((i, n) for i, (t, n) in enumerate(zip(b[2], b[3])) if t in CONTAINERS)[1] for b in within}
        common = _common(within)
        return {common[-1][1]} if common and common[-1][0] in CONTAINERS else inner
    common = _common(chosen + within)
    if common and all(b[3][-1] == common[-1][1] for b in chosen + within):
        common = common[:-1]
    return {common[-1][1]} if common else None


def _common(blocks: list) -> list[tuple[str, int]]:
    """Tags and nodes above all blocks."""
    out = []
    for steps in zip(*(zip(b[2], b[3]) for b in blocks)):
        if any(x != steps[0] for x in steps):
            break
        out.append(steps[0])
    return out


def extract_main_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` without its html, with the main text in column ``out``."""
    kept = [f for f in df.schema.fields if f.name.lower() not in (html.lower(), out.lower())]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(html)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(texts, pa.string())], names=schema.names)

    return df.withColumn(html, F.col(html).cast("string")).mapInArrow(run, schema)
