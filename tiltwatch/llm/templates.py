"""Main text of web pages: per-host templates deduced from equivalence classes of tokens."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import keep

# HTML elements by what they do to the text around and in them.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav "
    "noscript object ol optgroup option p pre search section select summary svg table tbody td template tfoot th "
    "thead tr ul".split()
)
DROPPED = set(
    "nav footer aside form noscript svg button select template dialog menu object canvas head search".split()
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu"}
#: Words in ``class`` or ``id`` that speak against an element.
CUES = set(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright discussion disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notification overlay pager pagination popup promo promotion recommended related "
    "replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget".split()
)
#: An element that closes an open one of the same group, up to the nearest of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# No branch crosses an opening bracket without consuming it, so scanning is linear.
_TOKEN = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|(/?)([A-Za-z][^\s/<>]*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|(/?)([A-Za-z][^\s/<>]*)([^<>]*+)>|[!?][^<>]*+>)""",
    re.S,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"""([A-Za-z-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))|(?<![^\s/])hidden(?![^\s/])""")
_CUE_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")

#: Tokens have to occur on so many pages of a host, and on such a share of them, to belong to its template.
MIN_PAGES, MIN_SHARE = 5, 0.2
#: The same share over all hosts, for pages of hosts too small to show a template.
POOL_SHARE = 0.01
#: A child that holds such a share of an element's text stands for it.
MAIN_SHARE = 0.6
#: Above such a share of linked text an element is a list of links.
LINK_SHARE = 0.5


class Page:
    """Elements and text blocks of one page.

    ``elements`` holds ``[name, role, parent, chars, linked chars, cue]``;
    an element's role hashes its path of names and classes, digits left out.
    ``blocks`` holds ``(element, text)`` in page order. Elements that never
    carry main text, and all in them, are not recorded.
    """

    def __init__(self, html: str) -> None:
        self.elements: list[list] = [["", 0, -1, 0, 0, False]]
        self.blocks: list[tuple[int, str]] = []
        self._stack: list[tuple[str, int]] = [("", 0)]  # name, element or -1 where text is dropped
        self._open: dict[str, int] = {}
        self._pieces: list[str] = []
        self._linked = self._links = 0
        self._read(html)
        for i in range(len(self.elements) - 1, 0, -1):  # parents come before their children
            element = self.elements[i]
            above = self.elements[element[2]]
            above[3] += element[3]
            above[4] += element[4]

    def _flush(self) -> None:
        if self._pieces:
            text = " ".join(unescape("".join(self._pieces)).split())
            at = self._stack[-1][1]
            if text and at >= 0:
                self.blocks.append((at, text))
                self.elements[at][3] += len(text)
                self.elements[at][4] += min(self._linked, len(text))
        self._pieces, self._linked = [], 0

    def _pop(self) -> None:
        self._flush()
        self._open[self._stack.pop()[0]] -= 1

    def _push(self, name: str, attributes: str) -> None:
        self._flush()
        if self._stack[-1][0] == "p":
            self._pop()
        if name in IMPLIED:
            same, scope = IMPLIED[name]
            if any(self._open.get(x) for x in same):
                for i in range(len(self._stack) - 1, 0, -1):
                    if self._stack[i][0] in scope:
                        break
                    if self._stack[i][0] in same:
                        while len(self._stack) > i:
                            self._pop()
                        break
        above = self._stack[-1][1]
        at = -1
        if above >= 0:
            classes, cue, dropped = "", False, name in DROPPED
            if attributes.strip():
                classes, cue, dropped = self._described(name, attributes, dropped)
            if name == "header":  # the head of an article belongs to it
                dropped = dropped or not (self._open.get("article") or self._open.get("main"))
            if not dropped:
                at = len(self.elements)
                role = xxhash.xxh64_intdigest(f"{name}.{classes}", self.elements[above][1]) - (1 << 63)
                self.elements.append([name, role, above, 0, 0, cue])
        self._stack.append((name, at))
        self._open[name] = self._open.get(name, 0) + 1

    @staticmethod
    def _described(name: str, attributes: str, dropped: bool) -> tuple[str, bool, bool]:
        classes, cue = "", False
        for m in _ATTRIBUTE.finditer(attributes):
            if not m[1]:
                dropped = True
                continue
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                if key == "class":
                    classes = " ".join(sorted(_DIGITS.sub("", value).lower().split()))
                if name not in ("html", "body", "main", "article"):
                    cue = cue or any(w.lower() in CUES for w in _CUE_WORD.findall(value))
            elif key == "role":
                dropped = dropped or value.lower().strip() in ROLES
            elif key == "aria-hidden":
                dropped = dropped or value.lower().strip() == "true"
            elif key == "style":
                dropped = dropped or "display:none" in value.replace(" ", "").lower()
        return classes, cue, dropped and name not in ("html", "body")

    def _read(self, html: str) -> None:
        at = 0
        while m := _TOKEN.search(html, at):
            self._text(html[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            closing = m[1] or m[4]
            if name in RAW:
                if not closing and (end := _RAW_END[name].search(html, at)):
                    at = end.end()
                elif not closing:
                    at = len(html)
                continue
            if name in ("br", "wbr", "img"):
                if name == "br":
                    self._pieces.append(" ")
            elif name == "a":
                self._links = 0 if closing else 1
            elif name == "hr":
                self._flush()
            elif name in BLOCK or "-" in name:
                if not closing:
                    self._push(name, m[3] or m[6] or "")
                elif self._open.get(name) and (name != "p" or self._stack[-1][0] == "p"):
                    while self._stack[-1][0] != name:
                        self._pop()
                    self._pop()
                    self._links = 0  # a link left open ends with its block
                else:
                    self._flush()
        self._text(html[at:])
        self._flush()

    def _text(self, text: str) -> None:
        if text and self._stack[-1][1] >= 0:
            self._pieces.append(text)
            if self._links:
                self._linked += len(text)


def _run_token(element: list, text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), element[1] & ((1 << 64) - 1)) - (1 << 63)


def page_tokens(html: str, page: int) -> Iterator[tuple]:
    """``(token, parent, is_run, low, high, count, chars, linked)`` for each distinct token of a page.

    Tokens are element roles and whole blocks of text in their element. Low
    and high are the halves of a hash of the page and the token's number of
    occurrences on it: summed over pages they stand for the occurrence vector.
    """
    found = Page(html)
    tokens: dict[int, list] = {}
    for _, role, parent, chars, linked, _ in found.elements:
        entry = tokens.setdefault(role, [found.elements[max(parent, 0)][1], False, 0, 0, 0])
        entry[2] += 1
        entry[3] += chars
        entry[4] += linked
    for at, text in found.blocks:
        entry = tokens.setdefault(_run_token(found.elements[at], text), [found.elements[at][1], True, 0, 0, 0])
        entry[2] += 1
        entry[3] += len(text)
    for token, (parent, is_run, count, chars, linked) in tokens.items():
        h = xxhash.xxh64_intdigest(count.to_bytes(8, "little"), page)
        yield token, parent, is_run, h & 0xFFFFFFFF, h >> 32, count, chars, linked


class Template:
    """What the pages of one host have in common.

    Tokens with the same occurrence vector form an equivalence class. A class
    is valid if it holds an element: text that merely appears together is
    copied text, not markup. Classes nest as their elements do. ``roles``
    maps each element of a valid class to ``(mean chars, share of linked
    chars, at most one per page)``; ``runs`` are the texts that
    belong to the class of the element around them, or to the class of the page itself.
    """

    def __init__(self, tokens: list[dict]) -> None:
        classes: dict[tuple, list[dict]] = {}
        for t in tokens:
            classes.setdefault((t["low"], t["high"], t["pages"]), []).append(t)
        vector = {t["token"]: v for v, group in classes.items() for t in group if not t["is_run"]}
        self.roles, self.runs = {}, set()
        for v, group in classes.items():
            for t in group:
                if t["is_run"]:
                    if v == vector.get(t["parent"]) or v == vector.get(0):
                        self.runs.add(t["token"])
                elif t["token"] == 0 or t["parent"] in vector:
                    pages, chars = t["pages"], t["chars"]
                    self.roles[t["token"]] = (chars / pages, t["linked"] / max(1, chars), t["most"] <= 1)


_LINKED = {"div", "section", "ul", "ol", "dl", "table", "header", "details", "search"}


def main_text(page: Page, template: Template | None, pool: Template) -> str:
    """Blocks of the slot that holds the main text, joined by newlines.

    From the root, the walk descends to the child that holds most of the
    text, judged by the mean over all pages with that element, until text is
    spread or an ``article`` is reached. Elements with a telling name, or made of links,
    are left out unless they hold most of the page. Texts of the template are left out
    unless that would leave less than half: then the pages are copies of each other.
    """
    elements = page.elements
    template = template or pool

    def known(role):
        return template.roles.get(role) or pool.roles.get(role)

    weights, links, single = [], [], []
    seen: dict[int, int] = {}
    for e in elements:
        seen[e[1]] = seen.get(e[1], 0) + 1
    for e in elements:
        mean = known(e[1])
        # A role that occurs often on a page shares its mean among the occurrences.
        weights.append(mean[0] / seen[e[1]] if mean else e[3])
        links.append(mean[1] if mean else e[4] / max(1, e[3]))
        single.append(mean[2] if mean else seen[e[1]] == 1)
    holds = [e[0] in ("article", "main") for e in elements]
    for i in range(len(elements) - 1, 0, -1):
        holds[elements[i][2]] |= holds[i]
    gone = [False] * len(elements)
    prose = weights[:]
    for i, e in enumerate(elements[1:], 1):
        small = weights[i] < MAIN_SHARE * weights[0] or holds[i] < holds[0]
        gone[i] = small and (e[5] or (e[0] in _LINKED and links[i] > LINK_SHARE))
    children: list[list[int]] = [[] for _ in elements]
    for i in range(len(elements) - 1, 0, -1):
        above = elements[i][2]
        if gone[i]:
            prose[i] = 0
        prose[above] -= weights[i] - prose[i]
        children[above].append(i)
    prose = [max(0.0, x) for x in prose]
    at = 0
    while elements[at][0] not in ("article",):
        options = [i for i in children[at] if single[i] and not gone[i]]
        best = max(options, key=lambda i: (prose[i], -i), default=None)
        if best is None or prose[best] < MAIN_SHARE * prose[at] or prose[best] <= 0 or elements[best][0] in ("p", "h1"):
            break
        at = best
    inside = [False] * len(elements)
    for i, e in enumerate(elements):
        inside[i] = not gone[i] and (i == at or (e[2] >= 0 and inside[e[2]]))
    if elements[at][0] != "article" and at:  # a heading may stand beside the text it belongs to
        for i in children[elements[at][2]]:
            inside[i] = inside[i] or (elements[i][0] == "h1" and not gone[i])
    blocks = [(i, text) for i, text in page.blocks if inside[i]]
    own = [text for i, text in blocks if _run_token(elements[i], text) not in template.runs]
    if sum(map(len, own)) < 0.5 * sum(len(text) for _, text in blocks):
        own = [text for _, text in blocks]
    return "\n".join(own)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; NULL if there is none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), upper, upper.lower())
    return F.when(host != "", host)


_TOKENS = "token long, parent long, is_run boolean, low long, high long, pages long, most long, chars long, linked long"


def tokens_by_host(pages: DataFrame) -> DataFrame:
    """One row per host and token of ``(host, key, html)``, summed over all its pages.

    Tasks add up what they read before anything is shuffled; a host may hold
    any share of the pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}

        def out() -> pa.RecordBatch:
            rows = [(*k, *v) for k, v in sums.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

        for batch in batches:
            for host, key, html in zip(*(c.to_pylist() for c in batch.columns)):
                for token, parent, is_run, low, high, count, chars, linked in page_tokens(html or "", key & ((1 << 64) - 1)):
                    entry = sums.get((host, token, parent, is_run))
                    if entry is None:
                        sums[host, token, parent, is_run] = [low, high, 1, count, chars, linked]
                    else:
                        entry[0] += low
                        entry[1] += high
                        entry[2] += 1
                        entry[3] = max(entry[3], count)
                        entry[4] += chars
                        entry[5] += linked
                if len(sums) > 200_000:
                    yield out()
        if sums:
            yield out()

    fields = pa.schema([
        ("host", pa.string()), ("token", pa.int64()), ("parent", pa.int64()), ("is_run", pa.bool_()),
        *((name, pa.int64()) for name in ("low", "high", "pages", "most", "chars", "linked")),
    ])
    parts = pages.select("host", "key", "html").mapInArrow(run, f"host string, {_TOKENS}")
    return parts.groupBy("host", "token", "parent", "is_run").agg(
        *(F.sum(c).alias(c) for c in ("low", "high", "pages")), F.max("most").alias("most"),
        *(F.sum(c).alias(c) for c in ("chars", "linked")),
    )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)`` for every row of ``pages``.

    Template deduction: elements and text blocks whose numbers of occurrences
    agree on every page of a host form classes; valid ones nest into the
    host's template, and what they leave open are slots, of which the one with
    the main text is returned (:func:`main_text`). Hosts of fewer than
    ``MIN_PAGES`` pages, and pages without a host, use what all pages have in
    common. NULL html counts as empty and gives an empty text; repeated rows and
    ids give repeated rows; other columns are ignored. White space in a
    block becomes one space, ``br`` included.

    Only sums per host and token are shuffled, and per host a list of tokens
    that are on a fifth of its pages or more: at most five times what
    one of its pages holds on average.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    sums = keep(tokens_by_host(rows.withColumn("key", F.xxhash64("page_id", "url", "html"))), "tokens")
    elements = sums.filter("NOT is_run").groupBy("token", "parent", "is_run").agg(
        *(F.sum(c).alias(c) for c in ("low", "high", "pages", "chars", "linked")), F.max("most").alias("most")
    )
    total = sums.filter("token = 0 AND NOT is_run").agg(F.sum("pages").alias("n")).first()["n"] or 0
    # At most 1 / POOL_SHARE times the elements of an average page.
    common = elements.filter(F.col("pages") >= max(MIN_PAGES, POOL_SHARE * total))
    pool = Template([r.asDict() for r in common.collect()])
    sizes = sums.filter("token = 0 AND NOT is_run AND host IS NOT NULL").select("host", F.col("pages").alias("of"))
    sizes = sizes.filter(F.col("of") >= MIN_PAGES)
    shared = sums.join(sizes, "host").filter((F.col("pages") >= MIN_PAGES) & (F.col("pages") >= MIN_SHARE * F.col("of")))
    listed = [c.split()[0] for c in _TOKENS.split(", ")]
    templates = keep(shared.groupBy("host").agg(F.to_json(F.collect_list(F.struct(*listed))).alias("template")), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, Template] = {}
        for batch in batches:
            texts = []
            for html, host, template in zip(*(batch.column(i) for i in (2, 3, 4))):
                host, found = host.as_py(), None
                if template.is_valid:
                    found = read.get(host)
                    if found is None:
                        if len(read) > 500:
                            read.clear()
                        found = read[host] = Template(json.loads(template.as_py()))
                texts.append(main_text(Page(html.as_py() or ""), found, pool))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    joined = rows.join(templates, "host", "left").select("page_id", "url", "html", "host", "template")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string")
