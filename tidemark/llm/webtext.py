"""Main text of web pages by consensus of the pages of a host.

Every page is read into a tree of blocks. Menus, headers, footers, sidebars, notices, adverts,
forms, comments and the like are told by tag, ARIA role, or a word of their class or id. What
is left of a container's text outside links is its score, and the page names the path of its
best container: the richest ``article``, else the richest ``main``, else what is reached
from the body by stepping into a child as long as that holds four fifths of the score and leaves
no main heading behind. A path is the tags and classes from the root, digits as ``#``.

Spark counts the paths per host; those with a tenth of the host's votes or more (ten at most)
are its templates. Each page is then extracted from all containers on the template most voted
for that it has. A page that has none of them, or whose url names no host, keeps its own best
container.

Rules of the text: character references decoded, all white space inside a block one space,
blocks without text left out, one line feed between blocks. ``br`` is white space. Comments,
scripts and the like have no text.

Odd input: a null or empty html gives an empty text, a null url is a page without host, tags that
are never closed end with their parent, a cut-off tag is no text, equal rows are extracted each;
other columns are carried along (``text`` and ``n_chars`` are replaced), an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements by their part in a page, and words of class names.
RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "title", "noembed", "noframes", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset(
    "aside button canvas datalist dialog fieldset footer form head header menu nav object select svg audio video".split()
) | frozenset(RAW)
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup "
    "html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body div main section td center".split())
ROLES = frozenset("banner navigation contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "menubar breadcrumb breadcrumbs sidebar aside footer header masthead topbar comment comments disqus respond reply "
    "replies cookie cookies consent gdpr notice notification popup modal overlay share sharing social related recommended "
    "newsletter subscribe signup login search pagination pager widget widgets toolbar skip".split()
)
#: Of those, the ones that hold even for a part with an article in it.
STRONG = frozenset("comment comments disqus respond reply replies related recommended".split())
#: Tags a start tag closes when they are open and nothing of the second set lies between.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
}
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|[\s\"'/])(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW}

#: A host's templates have at least this share of its votes; a child is stepped into from that share of the score.
TEMPLATE_SHARE, STEP_SHARE = 0.1, 0.8


class _Node:
    """An element: ``aside`` if it or one it lies in is a side part, ``weak`` if only its names say so."""

    __slots__ = ("tag", "kind", "step", "parent", "below", "aside", "weak", "holds", "inside", "score", "h1")

    def __init__(self, tag: str, rest: str, parent: _Node | None):
        said = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(rest)} if rest else {}
        names, role = said.get("class", "").split(), said.get("role", "").lower()
        words = {w.lower() for x in (*names, said.get("id", "")) for w in _WORD.findall(x)}
        self.tag, self.parent, self.below = tag, parent, []
        self.kind = "main" if role == "main" else tag
        self.step = ".".join([tag, *(re.sub(r"\d+", "#", x) for x in names)])
        free = self.kind in ("html", "body", "main")
        self.aside = tag in ASIDE or role in ROLES or bool(rest and _HIDDEN.search(rest)) or not (free or words.isdisjoint(STRONG))
        self.weak = not (free or tag == "article" or words.isdisjoint(WORDS))
        self.holds = self.h1 = False  # whether the main part or a main heading is in it
        self.score = 0
        self.inside = parent is not None and (parent.inside or parent.kind == "article")  # an article
        if parent is not None:
            parent.below.append(self)

    def path(self) -> str:
        steps, node = [], self
        while node is not None:
            steps.append(node.step)
            node = node.parent
        return "/".join(reversed(steps))


class Page:
    """The blocks of a page: ``nodes`` in page order and ``blocks``, (node, text, length of its text outside links)."""

    def __init__(self, html: str | None):
        self.nodes: list[_Node] = []
        self.blocks: list[tuple[_Node, str, int]] = []
        self._read(html or "")
        self._score()

    def _open(self, tag: str, rest: str, parent: _Node | None) -> _Node:
        self.nodes.append(_Node(tag, rest, parent))
        return self.nodes[-1]

    def _read(self, html: str) -> None:
        root = top = self._open("html", "", None)
        open_ = {"html": 1}  # how many elements of a tag are open
        words: list[str] = []  # of the block in hand
        linked: list[str] = []
        in_link = False

        def end_block() -> None:
            text = " ".join("".join(words).split())
            if text:
                away = len(" ".join("".join(linked).split()))
                self.blocks.append((top, text, max(0, len(text) - away)))
            words.clear()
            linked.clear()

        def leave() -> None:
            nonlocal top
            open_[top.tag] -= 1
            top = top.parent if top.parent is not None else root

        def close(tags: set[str], until: set[str]) -> None:
            node = top
            while node is not root and node.tag not in until:
                if node.tag in tags:
                    while True:
                        last = top is node
                        leave()
                        if last:
                            break
                    node = top
                    continue
                node = node.parent

        at, n = 0, len(html)
        while at < n:
            found = _TAG.search(html, at)
            text = html[at : found.start() if found else n]
            if text:
                text = unescape(text)
                words.append(text)
                if in_link:
                    linked.append(text)
            if not found:
                break
            at = found.end()
            name = found["name"]
            if not name:
                continue
            tag = name.lower()
            if found["end"]:
                if tag == "a":
                    in_link = False
                elif tag in BLOCKS or tag in ASIDE:
                    end_block()
                    in_link = False
                    if open_.get(tag) and tag not in ("html", "body"):
                        while top.tag != tag and top is not root:
                            leave()
                        if top is not root:
                            leave()
                continue
            if tag in _RAW_END:
                close_at = _RAW_END[tag].search(html, at)
                at = close_at.start() if close_at else n
                continue
            if tag == "a":
                in_link = True
            elif tag == "br":
                words.append(" ")
                linked.append(" ")
            elif tag == "hr":
                end_block()
            elif tag == "html":
                continue
            elif tag in BLOCKS or tag in ASIDE:
                if tag == "body" and open_.get("body"):
                    continue
                end_block()
                in_link = False
                while top.tag in ("p", "head"):
                    leave()
                if tag in _CLOSES and any(open_.get(t) for t in _CLOSES[tag][0]):
                    close(*_CLOSES[tag])
                top = self._open(tag, found["rest"], top)
                open_[top.tag] = open_.get(top.tag, 0) + 1
        end_block()

    def _score(self) -> None:
        for node in reversed(self.nodes):  # children come after their parent
            own = node.kind in ("main", "h1") or (node.kind == "article" and not node.inside)
            if node.parent is not None and (node.holds or own) and not node.aside:
                node.parent.holds = True
        for node in self.nodes:
            node.aside = node.aside or (node.weak and not node.holds) or (node.parent is not None and node.parent.aside)
        for node, _, own in self.blocks:
            if not node.aside:
                node.score += own
                node.h1 = node.h1 or node.tag == "h1"
        for node in reversed(self.nodes):
            if node.parent is not None and not node.aside:
                node.parent.score += node.score
                node.parent.h1 = node.parent.h1 or node.h1

    def best(self) -> _Node | None:
        """The container with the main text; none if the page has no text outside its side parts."""
        able = [x for x in self.nodes if not x.aside]
        pools = ([x for x in able if x.kind == kind] for kind in ("article", "main", "body", "html"))
        node = max(next(p for p in pools if p), key=lambda x: x.score)  # the first of equals; the root is always there
        if not node.score:
            return None
        while node.kind != "article":
            child = max((x for x in node.below if x.tag in CONTAINERS and not x.aside), key=lambda x: x.score, default=None)
            heading_stays = node.h1 and child is not None and not child.h1 and node.kind not in ("html", "body")
            if child is None or child.score < STEP_SHARE * node.score or heading_stays:
                break
            node = child
        return node

    def text(self, roots: set[_Node]) -> str:
        """Text of the blocks inside some nodes, side parts left out."""
        inside: set[_Node] = set()
        for node in self.nodes:
            if not node.aside and (node in roots or node.parent in inside):
                inside.add(node)
        return "\n".join(text for node, text, _ in self.blocks if node in inside)

    def on_path(self, paths: list[str]) -> set[_Node]:
        """All nodes on the first of the paths that the page has."""
        steps = [p.split("/") for p in paths]
        depth: dict[_Node, int] = {}
        follows: dict[_Node, set[int]] = {}
        ends: dict[int, set[_Node]] = {}
        for node in self.nodes:
            d = depth[node] = depth[node.parent] + 1 if node.parent is not None else 0
            before = follows[node.parent] if node.parent is not None else range(len(paths))
            follows[node] = {i for i in before if d < len(steps[i]) and steps[i][d] == node.step and not node.aside}
            for i in follows[node]:
                if d == len(steps[i]) - 1:
                    ends.setdefault(i, set()).add(node)
        return ends[min(ends)] if ends else set()


def main_text(html: str | None, paths: list[str]) -> str:
    """Text of a page, given its host's templates in order of their votes."""
    page = Page(html)
    found = page.on_path(paths)
    if not found:
        best = page.best()
        found = {best} if best is not None else set()
    return page.text(found)


def host(url: Column) -> Column:
    """Lower-cased host of a url, empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """``host``, ``path``, ``n``: how many pages of a host name a path as their best container's."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            best = [Page(html).best() for html in pdf["html"]]
            out = pd.DataFrame({"host": pdf["host"].to_numpy(), "path": [b.path() if b is not None else None for b in best]})
            yield out[out["path"].notna()]

    named = pages.select(host(F.col("url")).alias("host"), "html").where("host <> '' and html is not null")
    return named.mapInPandas(vote, "host string, path string").groupBy("host", "path").agg(F.count("*").alias("n"))


def templates(voted: DataFrame, share: float = TEMPLATE_SHARE) -> DataFrame:
    """``host`` and ``paths``: those with at least ``share`` of the host's votes, most voted first."""
    whole = voted.groupBy("host").agg(F.sum("n").alias("pages"))
    strong = voted.join(whole, "host").where(F.col("n") >= F.col("pages") * share)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "path")))
    return strong.groupBy("host").agg(F.transform(ordered, lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, share: float = TEMPLATE_SHARE, salts: int = 64) -> DataFrame:
    """``pages`` (``url``, ``html``) with ``text`` and ``n_chars`` (code points).

    The pages of a host are spread over ``salts`` join keys, as many copies of the templates
    made: a host with a third of all pages is not one task. Html is shuffled at most once, and
    only where the templates are too large to be sent to all tasks.
    """
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("text", "n_chars")]
    known = templates(votes(pages), share).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = pages.select(F.struct(*kept).alias("row"), host(F.col("url")).alias("host"), F.pmod(F.xxhash64("url", "html"), F.lit(salts)).cast("int").alias("salt"))
    joined = spread.join(known, ["host", "salt"], "left").select("row", F.coalesce("paths", F.array().cast("array<string>")).alias("paths"))
    read = F.pandas_udf(lambda html, paths: pd.Series([main_text(h, list(p)) for h, p in zip(html, paths)], dtype=object), "string")
    return joined.select("row.*", read("row.html", "paths").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
