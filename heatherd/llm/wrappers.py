"""Main text of pages by union-free wrapper inference (operator 1).

The tag stream of a page becomes a tree. All pages of a host are aligned one after the other with
the host's wrapper, a union-free expression over tags: where the streams agree, the tag stays;
texts that differ become slots; runs of equal sibling groups become repeated groups; what only one
side has becomes optional. The wrapper thus tells what the template of a host repeats on its pages
(constant texts, lists of links) from what the pages fill in.

Every task folds its pages into one wrapper per host, and the wrappers of a host are folded again,
so a host with a third of all pages is never gathered in one task. Every page is then aligned with
its host's wrapper: the text comes from the slots of its article or main element, or, where the
template has none, of the smallest subtree with all slot text outside links. Texts that the
template repeats are left out in articles too, as are menus, headers, footers, sidebars, notices,
adverts, forms and reader comments outside them by the names of their elements, roles and classes.
Inside an article a name is only a hint: it counts for lists of links or form fields, for adverts
that the wrapper has on several pages, and, as nothing else tells them, for containers whose whole
class name says reader comments.

Defined cases: a null or empty page has an empty text; a page without a usable URL belongs to the
host ''; pages of one host that agree in everything have no constants to go by, so nothing is
taken off as one below `MIN_PAGES` pages, nor from an article of which most is such text, as in
copies; cells of tables in articles and constants inside a sentence stay; equal rows have equal results; an empty table gives an
empty result; other columns are ignored. A tag that the end of the page cuts off is dropped, as
browsers do; pages are read whole.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heatherd.llm.common import Scratch, settings, slices
from heatherd.session import ship_by_value

MIN_PAGES = 4  # pages that must share a text before it counts as part of the template
MAX_DEPTH = 200  # elements nested deeper are read as blocks of the element at that depth
CONSTANT_SHARE = 0.8  # of the pages that have the element around the text
MISSES = 8  # pages more than half that may lack a text before it is no longer counted

INSIDE = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"  # of a tag; a quoted value may hold the end mark
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<svg(?=[\s/>]){INSIDE}/>"
    rf"|<(script|style|noscript|template|iframe|svg|select|textarea|title)(?=[\s/>])(?:{INSIDE}>|[^>]*>).*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({INSIDE})(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
# A name with its value, so that nothing inside a value is taken for a name.
ATTRIBUTE = re.compile(r"\"[^\"]*\"|'[^']*'|([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z]+")

# HTML elements by how they lay out text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub "
    "sup time tt u var wbr br".split())
CLOSED_BY_ITSELF = frozenset("li dt dd tr td th option p".split())
LEFT_OUT = frozenset("nav footer aside form button dialog menu object video audio canvas head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
# Words in class names and ids of what surrounds an article.
AROUND = frozenset(
    "nav navbar navigation menu header footer sidebar aside ad ads advert adverts advertisement advertising banner sponsor sponsored "
    "promo promotion cookie cookies consent gdpr notice notices notification popup modal overlay subscribe subscription newsletter "
    "signup login search share sharing social related recommended recommendations comment comments reply replies respond disqus "
    "breadcrumb breadcrumbs pagination pager widget toolbar masthead topbar skip hidden".split())
MAIN = frozenset("article main".split())
# A header of these is the article's own.
PARTS = frozenset("article entry post story content section page chapter".split())
# Words at the head of a class of articles that are cards or comments.
CARDS = frozenset("related recommended recommendation recommendations teaser card comment comments reply promo sponsored ad advert".split())
# Whole class names of reader comments: their text differs as that of articles does, so the wrapper cannot tell them.
COMMENTS = re.compile(r"(?:(?:user|reader|post|article|story|page)[-_])?comments(?:[-_](?:list|area|section))?|comment[-_]list|disqus(?:[-_]\w+)*")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = HEADINGS | INLINE | frozenset("p li td th tr dt dd pre blockquote figcaption".split())
# Names of adverts without further words but these places for them.
ADVERTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored promo ad.slot ad.unit ad.container ad.box ad.banner "
    "ad.wrapper ads.wrapper".split())
FIELDS = frozenset("input button label".split())
CHARS_OF_ITEM = 20  # text outside links that may go with a link or field of a list of those, as marks and captions


class Node:
    """An element: its label, kids (elements and texts in order), whether it is ruled out, and whether its names hint at that."""

    __slots__ = ("label", "tag", "kids", "out", "named")

    def __init__(self, label: str, tag: str, out: bool, named: bool = False):
        self.label, self.tag, self.kids, self.out, self.named = label, tag, [], out, named


def element(tag: str, attributes: str, inside_article: bool) -> Node:
    if not attributes:
        return Node(tag, tag, tag in LEFT_OUT or tag == "header" and not inside_article)
    classes, ids, role, hidden = [], [], "", False
    for found in ATTRIBUTE.finditer(attributes):
        key, value = (found[1] or "").lower(), (found[2] or found[3] or found[4] or "").lower()
        if key == "class":
            classes += value.split()
        elif key == "id":
            ids += WORDS.findall(value)
        elif key == "role":
            role = value
        elif key == "hidden" or key == "aria-hidden":
            hidden = hidden or key == "hidden" or value == "true"
    out = tag in LEFT_OUT or role in ROLES or hidden or (tag == "header" and not inside_article)
    words = [WORDS.findall(name) for name in classes]
    names = {word for of_class in words for word in of_class}.union(ids)
    if role in ("main", "article") and not out:
        return Node("main", "main", False)
    if tag in MAIN:
        named = tag == "article" and any(of_class and of_class[0] in CARDS for of_class in words)
    elif tag == "body":
        named = False
    elif inside_article:  # names are a hint that needs more to it, see `furniture`
        named = tag not in TEXTUAL and not AROUND.isdisjoint(names - {"header"})
        out = out or tag not in TEXTUAL and any(COMMENTS.fullmatch(name) for name in classes)
    else:
        named = any(not AROUND.isdisjoint(of_class) and (PARTS.isdisjoint(of_class) or "header" not in of_class) for of_class in words)
        named = named or tag not in INLINE and tag not in HEADINGS and not AROUND.isdisjoint(ids)
        out = out or named
    return Node(f"{tag}.{'.'.join(sorted(names))}" if names else tag, tag, out, named)


def measure(node: Node, in_link: bool = False, beside: bool = False) -> tuple[int, int, int]:
    """Characters outside and inside links below a node, and its links and form fields; `beside` leaves articles out."""
    outside = inside = items = 0
    for kid in node.kids:
        if isinstance(kid, str):
            n = len("".join(kid.split()))
            outside, inside = (outside, inside + n) if in_link else (outside + n, inside)
        elif kid.tag in FIELDS:
            items += 1
        elif not kid.out and not (beside and kid.tag in MAIN):
            below = measure(kid, in_link or kid.tag == "a", beside)
            outside, inside, items = outside + below[0], inside + below[1], items + below[2] + (kid.tag == "a")
    return outside, inside, items


def nested(node: Node, found: list[Node]) -> list[Node]:
    """The articles in a main element, without those in articles."""
    for kid in node.kids:
        if isinstance(kid, Node) and not kid.out:
            if kid.tag in MAIN:
                found.append(kid)
            else:
                nested(kid, found)
    return found


def linked_heading(node: Node) -> bool:
    """Whether a heading of an article is a link, as on cards."""
    for kid in node.kids:
        if isinstance(kid, Node) and not kid.out:
            if kid.tag in HEADINGS:
                outside, inside, _ = measure(kid, node.tag == "a")
                return inside > outside
            if linked_heading(kid):
                return True
    return False


def settle(main: Node) -> None:
    """Tells cards in a main element from articles that are its text, and rules out by name what is beside the latter."""
    inner = nested(main, [])
    if not inner:
        return
    beside = sum(measure(main, beside=True)[:2])
    sizes = [measure(article) for article in inner]
    for article, (outside, inside, _) in zip(inner, sizes):
        article.named = article.named or beside > 0 and inside > outside or linked_heading(article) and beside > outside
    if sum(sum(size[:2]) for article, size in zip(inner, sizes) if not article.named) > beside:
        names_beside(main)


def names_beside(node: Node) -> None:
    for kid in node.kids:
        if isinstance(kid, Node) and kid.tag not in MAIN:
            kid.out = kid.out or kid.named
            if not kid.out:
                names_beside(kid)


def parse(page: str) -> Node:
    """The tree of a page; elements that may stay open are closed where the next one begins."""
    root = Node("", "", False)
    stack, articles, deeper = [root], 0, 0
    mains: list[Node] = []

    def pop(depth: int) -> None:
        nonlocal articles
        for node in stack[depth:]:
            articles -= node.tag in MAIN
        del stack[depth:]

    for found in TOKEN.finditer(page):
        tag = found[3]
        if tag is None:
            text = found[0]
            if text[0] != "<" or text == "<":
                stack[-1].kids.append(text)
            elif stack[-1].kids and not isinstance(stack[-1].kids[-1], Node):
                stack[-1].kids.append("")  # a comment or script inside a text separates nothing
            continue
        if not found[0].endswith(">"):
            continue
        tag = tag.lower()
        if found[2] and deeper:
            deeper -= 1
        elif found[2]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    pop(depth)
                    break
        if found[2]:
            continue
        if tag in VOID:
            stack[-1].kids.append(Node(tag, tag, False))
            continue
        if len(stack) >= MAX_DEPTH:
            deeper += 1
            stack[-1].kids.append(Node("hr", "hr", False))
            continue
        if tag not in INLINE:  # a block ends an open paragraph, an item the open item beside it
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p" or stack[depth].tag == tag and tag in CLOSED_BY_ITSELF:
                    pop(depth)
                    break
                if stack[depth].tag not in INLINE:
                    break
        node = element(tag, found[4], articles > 0)
        stack[-1].kids.append(node)
        stack.append(node)
        articles += tag in MAIN
        if node.tag == "main":
            mains.append(node)
    for main in mains:
        settle(main)
    return root


# A wrapper node is [label, pages, repeated, texts, chars outside links, kids]; `texts` has, for the own
# texts of kids by label and hash, [pages that have it, chars outside links]. Texts that less than half of
# the pages share are not counted on.
APART, SAME, BESIDE = range(3)  # nodes merged are of different pages, of one page, or neighbours on any pages


def own_text(node: Node) -> str:
    return " ".join("".join(kid for kid in node.kids if isinstance(kid, str)).split())


def key(label: str, own: str) -> str:
    return f"{label} {zlib.crc32(own.encode())}"


def skeleton(node: Node) -> list:
    """The wrapper of a single page."""
    return skeleton_and_text(node, False)[0]


def skeleton_and_text(node: Node, in_link: bool) -> tuple[list, str]:
    in_link = in_link or node.tag == "a"
    own = own_text(node)
    kids, texts = [], {}
    for kid in node.kids:
        if isinstance(kid, Node) and kid.tag not in VOID and not kid.out:
            one, text = skeleton_and_text(kid, in_link)
            kids.append(one)
            if text:
                known = texts.setdefault(key(kid.label, text), [1, 0])
                known[1] += one[4]
    return [node.label, 1, 0, texts, 0 if in_link else len(own), repeats(kids)], own


def repeats(kids: list) -> list:
    """Kids with runs of equal groups of up to three labels folded into one repeated group."""
    out: list = []
    for kid in kids:
        out.append(kid)
        for period in (1, 2, 3):
            first, second = out[-2 * period : -period], out[-period:]
            if len(first) == period and [k[0] for k in first] == [k[0] for k in second]:
                folded = [merge(a, b, SAME) for a, b in zip(first, second)]
                for a in folded:
                    a[2] = 1
                out[-2 * period :] = folded
                break
    return out


def merge(a: list, b: list, how: int = APART) -> list:
    """Union-free generalisation of two wrapper nodes with one label."""
    pages = a[1] + b[1] if how == APART else max(a[1], b[1])
    return [a[0], pages, a[2] | b[2], shared(a, b, pages, how), a[4] + b[4], align(a[5], b[5], how)]


def shared(a: list, b: list, pages: int, how: int) -> dict:
    """Counts of the texts of both; of neighbours, which may be on the same pages, as many as are certain."""
    out, less = {}, min(a[1], b[1]) if how == BESIDE else 0
    for one, other, both in ((a[3], b[3], True), (b[3], a[3], False)):
        for text, (n, chars) in one.items():
            if text in other:
                if not both:
                    continue
                n, chars = n + other[text][0], chars + other[text][1]
            n = min(n, 1) if how == SAME else n - less
            if n > 0 and 2 * n + MISSES >= pages:
                out[text] = [n, chars]
    return out


def align(a: list, b: list, how: int = APART) -> list:
    """Kids of both in order: equal labels are merged, others stay as optional (fewer pages than the parent)."""
    if [k[0] for k in a] == [k[0] for k in b]:
        return [merge(x, y, how) for x, y in zip(a, b)]
    ahead: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        ahead.setdefault(b[j][0], []).append(j)
    out, j = [], 0
    for x in a:
        places = ahead.get(x[0], [])
        while places and places[-1] < j:
            places.pop()
        if places:
            stop = places.pop()
            out += b[j:stop]
            out.append(merge(x, b[stop], how))
            j = stop + 1
        else:
            out.append(x)
    return repeats_kept(out + b[j:])


def repeats_kept(kids: list) -> list:
    """Neighbours with one label, which alignment may leave, are one repeated group."""
    out: list = []
    for kid in kids:
        if out and out[-1][0] == kid[0]:
            out[-1] = merge(out[-1], kid, BESIDE)
            out[-1][2] = 1
        else:
            out.append(kid)
    return out


def fixed_texts(wrapper: list) -> list[str]:
    """Own texts of kids that count as part of the template."""
    least = max(MIN_PAGES, CONSTANT_SHARE * wrapper[1])
    return [text for text, (pages, _) in wrapper[3].items() if pages >= least]


def slot_chars(wrapper: list) -> dict[str, int]:
    """Characters of slots outside links by the label of the kid that holds them."""
    found: dict[str, int] = {}
    for kid in wrapper[5]:
        found[kid[0]] = found.get(kid[0], 0) + kid[4] + sum(slot_chars(kid).values())
    for text in fixed_texts(wrapper):
        found[text.rsplit(" ", 1)[0]] -= wrapper[3][text][1]
    return found


def content_path(wrapper: list) -> list[str]:
    """Labels down to the smallest subtree with all slot text outside links, in a template without an article."""
    path, node, own = [], wrapper, wrapper[4]
    while True:
        holders = [label for label, chars in slot_chars(node).items() if chars > 0]
        kids = [kid for kid in node[5] if kid[0] in holders]
        if own or len(kids) != 1 or kids[0][2] or kids[0][0].split(".")[0] in ("p", "li", "td", "h1", "h2"):
            return path
        own = kids[0][4] - sum(node[3][text][1] for text in fixed_texts(node) if text.rsplit(" ", 1)[0] == kids[0][0])
        node = kids[0]
        path.append(node[0])


def has_article(wrapper: list) -> bool:
    return any(kid[0].split(".")[0] in MAIN or has_article(kid) for kid in wrapper[5])


def holds(node: Node, tag: str) -> bool:
    return any(isinstance(kid, Node) and (kid.tag == tag or holds(kid, tag)) for kid in node.kids)


def furniture(node: Node, template: tuple | None) -> bool:
    """Whether an element in an article whose names hint at furniture is a card, a list of links or form fields, or an
    advert that the host's wrapper has on several pages."""
    if node.tag in MAIN or template is not None and template[2] >= MIN_PAGES and node.label.split(".", 1)[-1] in ADVERTS:
        return True
    outside, inside, items = measure(node)
    return items >= 2 and outside <= inside + CHARS_OF_ITEM * items and outside <= 2 * CHARS_OF_ITEM * items and not holds(node, "h1")


CELLS = frozenset("td th dt dd".split())


def blocks(node: Node, template: tuple | None, out: list[list[str]], lost: list[str], skip: bool = False, tied: bool = False,
           article: bool = False) -> None:
    """Appends the blocks of text below a node.

    `template` is what `constants` has for it; texts of the template go to `lost`, what is below them stays.
    `skip` is set where the own text is one; in a block with own text of the page (`tied`) inline elements keep theirs,
    in an article cells of tables and definitions do too.
    """
    tied = tied or not skip and any(isinstance(kid, str) and not kid.isspace() and kid for kid in node.kids)
    for kid in node.kids:
        if isinstance(kid, str):
            (lost if skip else out[-1]).append(kid)
            if skip:
                out[-1].append(" ")
        elif kid.tag in VOID:
            if kid.tag == "hr":
                out.append([])
            elif kid.tag == "br":
                out[-1].append(" ")
        elif not kid.out:
            below = template and template[1].get(kid.label)
            if kid.named and furniture(kid, below):
                continue
            inline = kid.tag in INLINE
            fixed = template is not None and not (inline and tied) and not (article and kid.tag in CELLS) and is_fixed(kid, template)
            if not inline:
                out.append([])
            blocks(kid, below, out, lost, fixed, inline and tied or article and kid.tag in CELLS, article)
            if not inline:
                out.append([])


def is_fixed(kid: Node, template: tuple) -> bool:
    return bool(template[0]) and key(kid.label, own_text(kid)) in template[0]


def constants(wrappers: list[list]) -> tuple:
    """Wrapper nodes of one label as a lookup: own texts of kids that are part of the template, kids by label, and pages."""
    kids: dict[str, list] = {}
    for kid in (kid for wrapper in wrappers for kid in wrapper[5]):
        kids.setdefault(kid[0], []).append(kid)
    fixed = {text for wrapper in wrappers for text in fixed_texts(wrapper)}
    return fixed, {label: constants(group) for label, group in kids.items()}, max(wrapper[1] for wrapper in wrappers)


def articles(node: Node, template: tuple | None, found: list[tuple]) -> list[tuple]:
    """(article, what the template has for it, whether its own text is part of the template), without articles in articles."""
    for kid in node.kids:
        if isinstance(kid, Node) and not kid.out:
            below = template and template[1].get(kid.label)
            if kid.tag in MAIN:
                found.append((kid, below, template is not None and is_fixed(kid, template)))
            else:
                articles(kid, below, found)
    return found


def joined(blocks_of_text: list[list[str]]) -> list[str]:
    texts = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks_of_text)
    return [text for text in texts if text]


def article_text(node: Node, template: tuple | None, fixed: bool) -> list[str]:
    """The text of an article without what its host repeats; whole where that is most of it, as in copies of one article."""
    out: list[list[str]] = [[]]
    lost: list[str] = []
    blocks(node, template, out, lost, fixed, article=True)
    texts = joined(out)
    if sum(map(len, lost)) > sum(map(len, texts)):
        whole: list[list[str]] = [[]]
        blocks(node, without_texts(template), whole, [], article=True)
        return joined(whole)
    return texts


def without_texts(template: tuple | None) -> tuple | None:
    return template and (set(), {label: without_texts(kid) for label, kid in template[1].items()}, template[2])


class Reader:
    """Reads pages of one host with its wrapper."""

    def __init__(self, wrapper: list):
        self.path = None if has_article(wrapper) else content_path(wrapper)
        # pages that agree in everything have no constants to go by
        self.template = constants([wrapper]) if wrapper[4] or any(slot_chars(wrapper).values()) else None

    def text(self, page: str) -> str:
        root = parse(page)
        text = self.main_text(root)
        if not text:
            cards = [card for node, *_ in articles(root, None, []) for card in [node, *nested(node, [])] if card.named]
            for card in cards:  # they stand for a page that has nothing else
                card.named = False
            text = self.main_text(root) if cards else text
        return text

    def main_text(self, root: Node) -> str:
        main = [found for found in articles(root, self.template, []) if not found[0].named]
        if main:
            return "\n\n".join(text for found in main for text in article_text(*found))
        out: list[list[str]] = [[]]
        node, template, skip = root, self.template, False
        for label in self.path or ():
            following = [kid for kid in node.kids if isinstance(kid, Node) and kid.label == label and not kid.out]
            if len(following) != 1:
                break
            node, skip = following[0], template is not None and is_fixed(following[0], template)
            template = template and template[1].get(label)
        blocks(node, template, out, [], skip)
        return "\n\n".join(joined(out))


def pages_of(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
        yield host, page or ""


def fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, list] = {}
    for batch in slices(batches, "html"):
        for host, page in pages_of(batch):
            one = skeleton(parse(page))
            found[host] = merge(found[host], one) if host in found else one
    yield packed(found)


def fold_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, list] = {}
    for batch in batches:
        for host, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            one = json.loads(text)
            found[host] = merge(found[host], one) if host in found else one
    yield packed(found)


def packed(found: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()), pa.array([json.dumps(w) for w in found.values()], pa.string())], ["host", "wrapper"])


def read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    readers: dict[str, Reader] = {}
    for batch in slices(batches, "html"):
        texts = []
        for (host, page), wrapper in zip(pages_of(batch), batch.column("wrapper").to_pylist()):
            if host not in readers:
                if len(readers) >= 1_000:  # memory of one task; a reader is made again when needed
                    readers.clear()
                readers[host] = Reader(json.loads(wrapper))
            texts.append(readers[host].text(page))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select("page_id", "url", "html", host.alias("host"))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from pages with page_id, url and html; the wrapper is JSON."""
    local = with_host(pages).select("host", "html").mapInArrow(fold_pages, "host string, wrapper string")
    return local.repartition("host").mapInArrow(fold_wrappers, "host string, wrapper string")


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages`."""
    with settings(pages.sparkSession):
        wrappers = Scratch(pages.sparkSession, "wrappers").write(infer_wrappers(pages), "wrappers")
    return with_host(pages).join(wrappers, "host").mapInArrow(
        read_pages, pages.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema)


ship_by_value(__name__)
