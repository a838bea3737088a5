"""Main text of web pages by tree scoring."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import small_batches, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text that no reader sees, up to their own end tag.
RAW = frozenset("script style noscript template textarea iframe object svg math title select canvas audio video noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul caption td th".split()
)
#: A start tag of these ends an open paragraph.
ENDS_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body"}
#: An open element of the key's tag ends where one of these starts, up to the nearest of the containers.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
LEFT_OUT = frozenset("nav footer aside form button menu dialog fieldset label input search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status".split())
# Words in a class or id of parts that are no article, gathered from the names that common page templates give such parts.
_PARTS = (
    "ad ads advert adverts advertisement advertisements advertising adsense adbox adslot sponsor sponsored sponsors promo promos promotion banner banners sidebar sidebars side aside rail nav navbar navigation menu menus "
    "breadcrumb breadcrumbs crumbs foot footer footers masthead topbar header cookie cookies consent gdpr notice notices alert alerts popup popups modal modals overlay newsletter subscribe subscription signup login share sharing "
    "social related recommend recommended recommendation recommendations widget widgets pagination pager toolbar skip hidden form search legal copyright tags outbrain taboola shoutbox paywall"
).split()
_COMMENTS = "comment comments commentlist disqus respond replies reply".split()
#: Words that say how a part is set up, not what it is: 'has-sidebar', 'comments-open'.
_STATE = re.compile(r"^(?:has|no|with|without|is|not)[-_]|[-_](?:open|opened|closed|on|off|enabled|disabled|allowed|visible)$", re.I)
_NAME = re.compile(r"[^\s_-]+")
_NO, _TALK = frozenset(_PARTS), frozenset(_COMMENTS)
_YES = re.compile(r"article|body|content|entry|main|post|story|text|page|hentry|blog", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}


class Node:
    __slots__ = ("tag", "parent", "inside", "score", "chars", "linked", "commas", "out", "kind", "depth", "doubt", "whole", "title", "within")

    def __init__(self, tag: str, parent: Node | None) -> None:
        self.tag, self.parent, self.inside = tag, parent, []
        self.score, self.chars, self.linked, self.commas, self.out, self.kind = 0.0, 0, 0, 0, False, 0
        self.depth = parent.depth + 1 if parent else 0
        # how sure its names are that it is no article (0 to 2), its text with all that is below, whether a main heading is in it, and whether it is in an article
        self.doubt, self.whole, self.title = 0, 0, False
        self.within = parent is not None and (parent.within or parent.tag in ("article", "main"))


def _doubt(names: str) -> tuple[int, bool]:
    """(2 if a name is a word for such parts, 1 if one is made with such a word, 0 else; whether it is readers' talk)."""
    most, talk = 0, False
    for name in names.split():
        if _STATE.search(name):
            continue
        words = [w.rstrip("0123456789").lower() for w in _NAME.findall(name)]
        if any(w in _TALK for w in words):
            most, talk = max(most, 2 if len(words) == 1 else 1), talk or len(words) == 1
        elif any(w in _NO for w in words):
            most = max(most, 2 if len(words) == 1 else 1)
    return most, talk


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def parse(page: str) -> list[Node]:
    """The page's elements in page order, the root first; text stands between them. Never fails, whatever the markup, and takes time in proportion to the page."""
    root = Node("#root", None)
    nodes, at, here, pos = [root], root, 0, 0
    open_: dict[str, list[Node]] = {}  # the open elements of each tag
    blocks: list[Node] = []  # the open ones of a block tag
    size = len(page)

    def close(upto: Node) -> None:
        nonlocal at
        while True:
            open_[at.tag].pop()
            if at.tag in BLOCKS:
                blocks.pop()
            done, at = at, at.parent
            if done is upto:
                return

    def nearest(tags: Iterable[str]) -> Node | None:
        return max((open_[t][-1] for t in tags if open_.get(t)), key=lambda n: n.depth, default=None)

    def end(tags: Iterable[str], until: Iterable[str]) -> None:
        """Closes the nearest open element of these tags unless one of until stands between."""
        node, wall = nearest(tags), nearest(until)
        if node is not None and (wall is None or wall.depth < node.depth):
            close(node)

    while pos < size:
        m = _TOKEN.search(page, pos)
        begin = m.start() if m else size
        if begin > here:
            text = page[here:begin]
            at.inside.append(html.unescape(text) if "&" in text else text)
        if not m:
            break
        here = pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            # a stray inline end tag doesn't close the blocks around it
            if open_.get(tag) and (tag in BLOCKS or not blocks or blocks[-1].depth < open_[tag][-1].depth):
                close(open_[tag][-1])
            continue
        if tag in ENDS_P:
            end(("p",), ("table", "td", "th", "button", "object"))
        if tag in ENDS:
            end(*ENDS[tag])
        node = Node(tag, at)
        raw = m[3]
        if raw and not raw.isspace():
            had = _attributes(raw)
            names = f"{had.get('class', '')} {had.get('id', '')}".strip()
            if names and tag not in ("html", "body", "article", "main"):
                node.kind = 25 * bool(_YES.search(names))
                node.doubt, talk = _doubt(names)
                node.out = talk
            node.out |= "hidden" in had or had.get("aria-hidden") == "true" or had.get("role", "").lower() in ROLES or bool(_HIDDEN.search(had.get("style", "")))
            if had.get("itemprop", "").lower() == "articlebody" or had.get("role", "").lower() in ("main", "article"):
                node.kind, node.out, node.doubt = 50, False, 0
        node.out |= tag in LEFT_OUT or tag in RAW
        at.inside.append(node)
        nodes.append(node)
        if tag in RAW and not raw.endswith("/"):
            close_tag = _RAW_END[tag].search(page, here)
            here = pos = close_tag.end() if close_tag else size
        elif tag not in VOID:
            at = node
            open_.setdefault(tag, []).append(node)
            if tag in BLOCKS:
                blocks.append(node)
    return nodes


def _leave_out(nodes: list[Node]) -> None:
    """Marks what is no article. What only its names speak against goes if it is a smaller part of the page's text: a wrapper of all is kept, whatever
    its template calls it; and one with a main heading is kept from half of the text on."""
    for node in nodes:
        if node.parent is not None and node.parent.out:
            node.out = True
        elif node.tag == "header" and not node.within:
            node.out = True  # a header is the page's unless it stands in the article
    for node in reversed(nodes):
        if node.out:
            continue
        node.whole += sum(len(x) for x in node.inside if isinstance(x, str) and not x.isspace())
        node.title |= node.tag in ("h1", "article", "main")
        if node.parent is not None:
            node.parent.whole += node.whole
            node.parent.title |= node.title
    total = nodes[0].whole
    for node in nodes:
        if node.parent is not None and node.parent.out:
            node.out = True
        elif node.doubt and not node.out:
            share = node.whole / total if total else 0.0
            node.out = share <= 0.5 or not node.title and (node.doubt == 2 or share <= 0.8)


def _blocks(container: list[Node], keep: set[int]) -> list[str]:
    """Texts of the blocks below these elements, in page order; white space inside a block is one space."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    for top in container:
        flush()
        stack: list = [(top, iter(top.inside))]
        while stack:
            node, rest = stack[-1]
            for part in rest:
                if isinstance(part, str):
                    line.append(part)
                    continue
                if part.out and id(part) not in keep:
                    if part.tag in BLOCKS:
                        flush()
                    continue
                if part.tag in ("td", "th"):
                    line.append(" ")
                elif part.tag in BLOCKS:
                    flush()
                elif part.tag == "br":
                    line.append("\n")
                if part.inside:
                    stack.append((part, iter(part.inside)))
                    break
            else:
                stack.pop()
                if node.tag in ("td", "th"):
                    line.append(" ")
                elif node.tag in BLOCKS:
                    flush()
        flush()
    return out


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; an empty string if there is none.

    Paragraphs give points for their length and commas to their parent, half of them to the next ancestor and less to further
    ones; every element's points shrink with its share of linked text. The element with the most points, raised to
    the article or main element around it, is kept with the siblings that have enough of their own.
    """
    if not page:
        return ""
    nodes = parse(page)
    _leave_out(nodes)
    for node in reversed(nodes):
        if node.out:
            continue
        own = [x for x in node.inside if isinstance(x, str)]
        n = sum(len(x) - x.count(" ") // 8 for x in own if not x.isspace())
        node.chars += n
        node.commas += sum(x.count(",") for x in own)
        if node.tag == "a":
            node.linked = node.chars
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            if node.tag not in BLOCKS:
                node.parent.commas += node.commas
    best: Node | None = None
    scored: list[Node] = []
    for node in nodes:
        if node.out or node.parent is None:
            continue
        direct = any(isinstance(x, str) and len(x) > 1 and not x.isspace() or isinstance(x, Node) and x.tag not in BLOCKS and x.chars for x in node.inside)
        if not direct or node.tag not in BLOCKS or node.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "body", "html") or node.chars < 20:
            continue
        points = (1 + node.commas + min(node.chars / 100, 3)) * (1 - _density(node))
        up, share = (node, 1.0) if node.tag in ("div", "section", "article", "main") else (node.parent, 1.0)
        for k in range(6):
            if up is None or up.tag in ("#root", "html"):
                break
            if not up.score:
                scored.append(up)
            up.score += points * share
            up, share = up.parent, 0.5 / (1 if k == 0 else 1.5 * k)
    for node in scored:
        node.score = (node.score + (node.kind if node.score > 3 else 0)) * (1 - _density(node))
        if best is None or node.score > best.score:
            best = node
    if best is None:
        # no paragraph has points: the article, main or body element with any text
        for tag in ("article", "main", "body", "#root"):
            best = next((n for n in nodes if n.tag == tag and n.chars > n.linked and not n.out), None)
            if best is not None:
                break
        else:
            return ""
    up = best
    while up is not None:
        if up.tag in ("article", "main") or up.kind == 50:
            best = up
            if up.tag != "main" or up.kind == 50:
                break
        up = up.parent
    chosen = [best]
    if best.parent is not None and best.tag not in ("article", "main", "body"):
        enough, chosen = max(10.0, best.score * 0.2), []
        for part in best.parent.inside:
            if part is best:
                chosen.append(part)
            elif isinstance(part, Node) and not part.out and part.tag in BLOCKS:
                if part.score >= enough and part.score or part.tag in ("p", "pre", "blockquote") and part.chars > 80 and _density(part) < 0.25:
                    chosen.append(part)
    elif best.tag == "article" and best.parent is not None:
        # a page may hold its article in pieces
        chosen = [x for x in best.parent.inside if isinstance(x, Node) and x.tag == "article" and not x.out and (x is best or x.score >= max(10.0, best.score * 0.2))]
    return "\n\n".join(_blocks(chosen, {id(x) for x in chosen}))


def extracted(pages: DataFrame, page: str = "html") -> DataFrame:
    """pages with the column text, the main text of every whole page (null: empty); replaces a column of this name. Needs no shuffle."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def of(batch: pd.Series) -> pd.Series:
        return batch.map(main_text)

    return pages.withColumn("text", of(F.coalesce(F.col(page), F.lit(""))))


def op3_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text").withColumn("n_chars", F.length("text").cast("long"))
