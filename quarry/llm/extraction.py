"""Main-text extraction by composite text density.

Every DOM node gets a density: its characters per tag, scaled by a logarithm that rewards
characters and tags outside links, with a base that grows with the link share of the node
and of the whole body.  A node's density sum adds up its children; the node with the largest
sum roots the main text.  The smallest density on the path from that node to the body is the
threshold: blocks beside the node belong to the text only where their own branch reaches it.
Markup only adds to that: the text grows to the outermost article or main element around the
root; an article beside the root, most of whose characters are outside links, belongs to it if it
is the root's sibling or reaches the threshold.
Elements that say what they are (nav, footer, aside, form, adverts, notices, comments, ...)
are left out of the sums and of the text.  A class or id says so only as a whole: every part of
the name is a known one, so that "site-footer" and "user-comment" count and "has-sidebar" does
not.  A named element that holds most of the body's characters outside links, without an article
or main element outside it, is judged by its density like any other, and one that holds an
article, main element or first heading stays; but what calls itself comments or related posts
goes with everything in it, articles included.  An author's biography is part of the page's text.

Defined results: null or empty html gives an empty text; pages of any length and any depth
are read whole; unclosed, misnested and cut-off markup is repaired as browsers do for
paragraphs, items, cells and end tags; html without tags is its own text; repeated rows give
equal results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import columns_of, map_batches, text_bytes

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>|<(?=/?[a-zA-Z])[^>]*\Z", re.S)
# a name is taken whole, with or without a value, so nothing is read twice
_ATTRIBUTE = re.compile(
    r"([^\s=\"'/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"']++)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

# HTML element names and the words pages use to name their parts.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template title textarea iframe noembed xmp".split())
_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label
    mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img""".split())
_ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre
    section table ul""".split())
_ITEM = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
         "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
         "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th", "tbody"},
         "tfoot": {"tr", "td", "th", "thead", "tbody"}}
_ITEM_SCOPE = frozenset("ul ol menu dl table select article body".split())
_LEFT_OUT = frozenset("""head nav footer aside form button select menu svg canvas audio
    video""".split()) | _RAW
_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alert
    alertdialog menu menubar toolbar""".split())
_PARTS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo
    promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header
    masthead comment comments commentlist reply replies respond disqus discussion cookie
    cookies consent gdpr popup modal overlay newsletter subscribe subscription signup share
    sharing social related recommended widget toolbar pagination pager""".split())
#: What may stand beside such a word in a name without changing what it says.
_BESIDE = frozenset("""area bar block bottom box btn button buttons center col column
    container desktop form global group holder icon icons inner item items left
    link links list main message mobile module notice outer page panel placeholder posts primary
    right row secondary section site slot small sticky tablet thread title top unit wrap wrapper
    zone""".split())


#: Words for the article and the people around it: they change nothing either, but beside a
#: word for a header ("post-header") they name the head of the article itself.
_OF_ARTICLE = frozenset("""account article author avatar blog body children content count date entry
    footer guest meta name policy post reader story text time user visitor write""".split())
_HEADERS = frozenset("banner header masthead".split())
#: What calls itself one of these is never the article, whatever it holds.
_NOT_ARTICLE = frozenset("""comment comments commentlist disqus related recommended replies
    reply respond""".split())


class _Page:
    """The elements of a page in document order, and its text pieces with their element."""

    def __init__(self, source: str):
        self.tag, self.parent, self.out = ["#root"], [-1], [False]
        self.named = [False]  # a class or id alone leaves it out
        self.has_head = [False]  # holds an article, a main element or a first heading
        self.beside = [False]  # lies in comments or related posts
        self.texts: list[tuple[int, str]] = []
        self._stack, self._open = [0], {"#root": [0]}  # open elements, and their depths by tag
        self._read(source)

    def _push(self, tag: str, attributes: str) -> None:
        node, parent = len(self.tag), self._stack[-1]
        self.tag.append(tag)
        self.parent.append(parent)
        role, named, beside = self._says(tag, attributes)
        self.out.append(tag in _LEFT_OUT or role)
        self.named.append(named)
        self.has_head.append(False)
        self.beside.append(self.beside[parent] or beside)
        if tag in ("article", "main", "h1") and not self.beside[node]:
            up = parent
            while up >= 0 and not self.has_head[up]:
                self.has_head[up] = True
                up = self.parent[up]
        if tag not in _VOID:
            self._open.setdefault(tag, []).append(len(self._stack))
            self._stack.append(node)

    @staticmethod
    def _says(tag: str, attributes: str) -> tuple[bool, bool, bool]:
        """Whether an element's role leaves it out, its class or id does, and that for being
        comments or related posts."""
        role = named = beside = False
        if attributes and tag not in ("html", "body", "#root"):
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), a or b or c
                if name == "role":
                    role |= value.lower() in _ROLES
                for token in value.split() if name in ("class", "id") else ():
                    parts = [p.lower() for p in _NAME_PART.findall(token)]
                    parts = [p for p in parts if not p.isdigit()]
                    known = [p for p in parts if p in _PARTS]
                    plain = _BESIDE if _HEADERS.issuperset(known) else _BESIDE | _OF_ARTICLE
                    if known and all(p in _PARTS or p in plain for p in parts):
                        named = True
                        beside |= not _NOT_ARTICLE.isdisjoint(known)
        return role, named, beside

    def _pop(self) -> None:
        self._open[self.tag[self._stack.pop()]].pop()

    def _pop_to(self, tags, scope=frozenset()) -> None:
        """Close the nearest open element of ``tags``, unless a ``scope`` element is nearer."""
        depth = max((self._open[t][-1] for t in tags if self._open.get(t)), default=0)
        if depth > max((self._open[t][-1] for t in scope if self._open.get(t)), default=0):
            while len(self._stack) > depth:
                self._pop()

    def _read(self, source: str) -> None:
        at, lower = 0, None
        search = _TOKEN.search
        while True:
            m = search(source, at)
            if m is None:
                break
            if m.start() > at:
                self.texts.append((self._stack[-1], source[at:m.start()]))
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag, attributes = name.lower(), (m[3] or m[6] or "")
            if m[1] or m[4]:
                if tag == "br":
                    self._push(tag, "")
                elif self._open.get(tag):
                    self._pop_to({tag})
                self.texts.append((-1 if tag not in _INLINE else -2, ""))
                continue
            if tag in _ENDS_P:
                self._pop_to({"p"}, {"table", "td", "th", "button", "object"})
            if tag in _ITEM:
                self._pop_to(_ITEM[tag], _ITEM_SCOPE - {tag})
            if tag not in _INLINE:
                self.texts.append((-1, ""))
            self._push(tag, attributes)
            if tag in _RAW:
                if lower is None:
                    lower = source.lower()
                    if len(lower) != len(source):  # some letters grow in lower case
                        lower = re.sub("[A-Z]", lambda x: x[0].lower(), source)
                end = lower.find(f"</{tag}", at)
                self._pop()
                if end < 0:
                    break
                at = end
        if m is None and at < len(source):
            self.texts.append((self._stack[-1], source[at:]))

    def finish(self) -> None:
        """Pass the left-out mark down; a name alone never leaves out the page's head piece, nor
        most of the page."""
        n = len(self.tag)
        plain = self._plain_chars() if any(self.named) else [0] * n
        pieces = [0] * n  # article and main elements, each with those inside it
        for i in range(n - 1, 0, -1):
            pieces[i] += self.tag[i] in ("article", "main") and not self.beside[i]
            pieces[self.parent[i]] += pieces[i]
        inside = [False] * n  # an article or main element
        for i in range(1, n):
            p = self.parent[i]
            inside[i] = inside[p] or self.tag[p] in ("article", "main")
            most = 2 * plain[i] > plain[0] and pieces[i] == pieces[0]
            own = (self.out[i] or self.named[i] and not most) and not (
                self.has_head[i] and self.tag[i] not in _LEFT_OUT)
            if self.tag[i] in ("header", "dialog") and not inside[i]:
                own = True
            self.out[i] = own or self.out[p]

    def _plain_chars(self) -> list[int]:
        """Characters outside links and outside elements that their tag or role leaves out."""
        n = len(self.tag)
        skip, chars = [False] * n, [0] * n
        for i in range(1, n):
            skip[i] = skip[self.parent[i]] or self.out[i] or self.tag[i] == "a"
        for node, text in self.texts:
            if node >= 0 and not skip[node]:
                chars[node] += len("".join(text.split()))
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
        return chars


def densities(page: _Page):
    """Characters, those in links, composite density and density sum of every node that is not
    left out."""
    n = len(page.tag)
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = page.tag[i] == "a" or in_link[page.parent[i]]
    for node, text in page.texts:
        if node >= 0 and not page.out[node]:
            size = len("".join(text.split()))
            chars[node] += size
            if in_link[node]:
                link_chars[node] += size
    for i in range(n - 1, 0, -1):
        if page.out[i]:
            continue
        p = page.parent[i]
        chars[p] += chars[i]
        link_chars[p] += link_chars[i]
        tags[p] += tags[i] + 1
        link_tags[p] += link_tags[i] + (page.tag[i] == "a")
    body = next((i for i in range(n) if page.tag[i] == "body"), 0)
    body_share = link_chars[body] / max(chars[body], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        if page.out[i] or not chars[i]:
            continue
        c, lc, t, lt = chars[i], link_chars[i], max(tags[i], 1), max(link_tags[i], 1)
        base = math.log(c * lc / max(c - lc, 1) + body_share * c + math.e)
        scale = max(math.log(base), 0.25)  # 0 without any link: a fixed floor
        density[i] = max(c / t * math.log(c / max(lc, 1) * t / lt) / scale, 0.0)
        if i:
            total[page.parent[i]] += density[i]
    return chars, link_chars, density, total, body


def main_text(source: str) -> str:
    """The main text of one page."""
    page = _Page(source)
    page.finish()
    chars, link_chars, density, total, body = densities(page)
    n = len(page.tag)
    root = max(range(n), key=lambda i: (total[i], -i)) if n else 0
    if not total[root]:
        root = body
    path = [root]
    while path[-1] > 0:
        path.append(page.parent[path[-1]])
    upper = path[:path.index(body) + 1] if body in path else path
    threshold = min(density[i] for i in upper)
    root = next((i for i in reversed(path) if page.tag[i] in ("article", "main")), root)
    beside = page.parent[root]
    # within[i]: the node belongs to the text
    on_path = set(path)
    within = [False] * n
    for i in range(n):
        if page.out[i]:
            continue
        p = page.parent[i]
        within[i] = (i == root or (p >= 0 and within[p])
                     or (page.tag[i] == "article" and 2 * link_chars[i] < chars[i]
                         and (p == beside or density[i] >= threshold))
                     or (p in on_path and i not in on_path and density[i] >= threshold > 0))
    blocks, current = [], []

    def flush():
        if current:
            words = html.unescape("".join(current)).split()
            if words:
                blocks.append(" ".join(words))
            current.clear()
    for node, text in page.texts:
        if node == -1:
            flush()
        elif node >= 0 and within[node]:
            current.append(text)
    flush()
    return " ".join(blocks)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars`` (its code points)."""
    id_type = pages.schema[id_col].dataType.simpleString()
    url_type = pages.schema[url_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_id", "_url", "_html"])
        texts = [main_text(x.decode("utf-8", "replace")) for x in text_bytes(col["_html"])]
        return pa.RecordBatch.from_arrays(
            [col["_id"], col["_url"], pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=[id_col, url_col, "text", "n_chars"])
    return map_batches(
        pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                     F.col(html_col).alias("_html")), run,
        f"`{id_col}` {id_type}, `{url_col}` {url_type}, text string, n_chars long")
