"""Main text of web pages by wrapper induction per host.

A host of n pages is dealt by a hash of the page into ceil(n / ``group``) like
parts, which are groups, so a host with a third of all pages fills many
partitions; a host of up to ``group`` pages is one group, wherever the partitions
end. Only a part swollen by copies of one row is cut, at ``MOST_PAGES``. Within a
group each DOM tree is aligned with the group's reference tree by *simple tree
matching*: the largest matching of ordered trees that keeps roots, parents and
order. Runs of like siblings (paragraphs, menu entries) are one repeated node,
so trees are small. Aligned nodes are slots; a slot's text that is the same on
four fifths of the pages with different titles is *template*, the rest is
content. Copies of a page count once, so they don't turn content into template.

The content root is found from the text in varying slots, of the page and of all
pages of its group: from the top, the walk goes into the element that holds most
of it, and stops where it would leave several like ones or text of its own
behind, or at an ``article`` or ``main``. Text inside these counts ``WEIGHT`` times,
text in elements marked as no article text by their tag, role or class (menus,
footers, sidebars, notices, adverts, forms, reader comments) half. Marked elements
are left out, but not one that holds most of the varying text over the pages that
have it; without a template, not one that holds most of the text and a heading or
article. What is never shown (scripts, styles, controls) is always left out;
template slots too, but for headings and paragraphs of an article that stand
beside varying text.

Null html: empty text. A null or unusual url is a host of its own. A host with
fewer than ``LEAST_PAGES`` different pages has no template. Repeated ids keep one
row each. Only the id, the url and the html are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[a-z0-9]+")
#: Their content is text up to the end tag, and none of it is shown.
RAW = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: A start tag ends these open elements, up to the nearest of the scope.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("html body article section main div ul ol dl table tbody thead tfoot tr nav aside header footer form blockquote td th".split())
#: Never article text, by tag, by role, by words of class or id.
SKIP = frozenset("head script style noscript template textarea title iframe nav footer aside form button select input label option svg math canvas object "
                 "embed audio video map menu dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar note".split())
MARKS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
                  "footer masthead topbar cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login "
                  "comment comments reply replies disqus respond share sharing social related recommended widget pagination pager toolbar search skip".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption".split())
#: Of SKIP, what may still hold the content; text of an article counts so many times.
HOLDERS = frozenset("nav footer aside form menu dialog fieldset".split())
ROWS = frozenset("table thead tbody tfoot tr".split())
WEIGHT = 4
SHARE, LEAST_PAGES = 0.8, 4
#: A group is cut at so many times ``group`` pages.
MOST_PAGES = 8


class Node:
    __slots__ = ("tag", "label", "skip", "soft", "children", "slot", "linked")

    def __init__(self, tag: str, label: str = "", skip: bool = False, soft: bool = False):
        self.tag, self.label, self.skip, self.soft = tag, label or tag, skip, soft
        self.children: list = []
        self.slot = None

    def elements(self):
        return [c for c in self.children if isinstance(c, Node)]

    def own_text(self) -> str:
        """Text of the node and its inline elements."""
        parts: list[str] = []
        stack = [*reversed(self.children)]
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                parts.append(c)
            elif c.tag not in BLOCK and not c.skip:
                stack += reversed(c.children)
        return " ".join("".join(parts).split())


def make(tag: str, attributes: str) -> Node:
    if not attributes or not attributes.strip(" /"):
        return Node(tag, tag, tag in SKIP, tag in HOLDERS)
    a = {k.lower(): (x or y or z) for k, x, y, z in ATTRIBUTE.findall(attributes)}
    marks = WORDS.findall(f"{a.get('class', '')} {a.get('id', '')}".lower())
    hard = tag in SKIP - HOLDERS or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "")
    soft = (tag in HOLDERS or a.get("role", "").lower() in ROLES or tag not in ("html", "body", "article", "main") and not MARKS.isdisjoint(marks)
            or tag == "article" and not {"comment", "comments", "reply", "related", "ad", "promo", "teaser"}.isdisjoint(marks))
    return Node(tag, f"{tag}.{a.get('class', '')}", hard or soft, soft and not hard)


def parse(page: str) -> Node:
    """A tree of elements and decoded texts; unclosed and stray tags are fine."""
    root = Node("html")
    stack, at = [root], 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            stack[-1].children.append(entities.unescape(page[at:m.start()]))
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break
            continue
        if tag in ("html", "body"):
            continue
        if tag in BLOCK:
            # a block ends an open paragraph
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in SCOPE:
                    break
        if tag in ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ENDS[tag]:
                    del stack[k:]
                    break
                if stack[k].tag in ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select") or stack[k].tag == "tr" and tag != "tr":
                    break
        node = make(tag, m[3] or m[6] or "")
        stack[-1].children.append(node)
        if tag in RAW:
            end = RAW[tag].search(page, at)
            at = end.start() if end else len(page)
            node.skip, node.soft = True, False
        if tag not in VOID:
            stack.append(node)
    if at < len(page):
        stack[-1].children.append(entities.unescape(page[at:]))
    return root


class Slot:
    """A node of the collapsed tree: like siblings in a row are one."""

    __slots__ = ("label", "children", "members", "number")

    def __init__(self, members: list[Node]):
        # explicit stacks here and below: a page may be nested thousands deep
        stack = [self]
        self._of(members)
        while stack:
            s = stack.pop()
            for r in s._runs():
                c = Slot.__new__(Slot)
                c._of(r)
                s.children.append(c)
            stack += s.children

    def _of(self, members: list[Node]) -> None:
        self.label, self.members, self.number, self.children = members[0].label, members, None, []

    def _runs(self) -> list[list[Node]]:
        runs: list[list[Node]] = []
        for m in self.members:
            for c in m.children:
                if isinstance(c, Node) and c.tag in BLOCK:
                    if runs and runs[-1][0].label == c.label:
                        runs[-1].append(c)
                    elif (again := next((r for r in runs if r[0].label == c.label), None)) is not None and len(self.members) > 1:
                        again.append(c)
                    else:
                        runs.append([c])
        return runs


def number(slot: Slot) -> None:
    for k, s in enumerate(_slots(slot)):
        s.number = k


def match(a: Slot, b: Slot, memo: dict) -> int:
    """Simple tree matching: size of the largest matching of two ordered trees."""
    if a.label != b.label:
        return 0
    stack = [(a, b)]
    while stack:
        x, y = stack[-1]
        if (id(x), id(y)) not in memo:
            if todo := [(c, d) for c in x.children for d in y.children if c.label == d.label and (id(c), id(d)) not in memo]:
                stack += todo
                continue
            rows = [[0] * (len(y.children) + 1)]
            for c in x.children:
                last, row = rows[-1], [0]
                for j, d in enumerate(y.children):
                    row.append(max(row[j], last[j + 1], last[j] + matched(c, d, memo)))
                rows.append(row)
            memo[id(x), id(y)] = (rows[-1][-1] + 1, rows)
        stack.pop()
    return memo[id(a), id(b)][0]


def matched(a: Slot, b: Slot, memo: dict) -> int:
    return memo[id(a), id(b)][0] if a.label == b.label else 0


def align(page: Slot, reference: Slot, memo: dict) -> None:
    """Gives the page's nodes the numbers of the slots that they match."""
    stack = [(page, reference)]
    while stack:
        a, b = stack.pop()
        a.number = b.number
        for m in a.members:
            m.slot = b.number
        rows, i, j = memo[id(a), id(b)][1], len(a.children), len(b.children)
        while i and j:
            size = matched(a.children[i - 1], b.children[j - 1], memo)
            if size and rows[i][j] == rows[i - 1][j - 1] + size:
                stack.append((a.children[i - 1], b.children[j - 1]))
                i, j = i - 1, j - 1
            elif rows[i][j] == rows[i - 1][j]:
                i -= 1
            else:
                j -= 1


def walk(node: Node, marked: bool = False):
    """All shown nodes, in order; ``marked``: also those left out by their marks."""
    stack = [node]
    while stack:
        n = stack.pop()
        if not n.skip or marked and n.soft:
            yield n
            stack += reversed(n.elements())


def slot_texts(root: Node) -> set:
    return {(n.slot, t) for n in walk(root, True) if n.slot is not None and (t := n.own_text())}


def is_article(n: Node) -> bool:
    return n.tag in ("article", "main") and not n.soft


def text_sizes(root: Node, template: set, marked: bool = False) -> dict:
    """Per shown node, by id: ``[weighted varying text, all text, text of links,
    varying text, articles, headings]`` in it."""
    sizes: dict = {}
    stack = [(root, None, 1)]
    order = []
    while stack:
        n, parent, weight = stack.pop()
        order.append((n, parent))
        weight = WEIGHT if is_article(n) else min(weight, 0.5) if n.soft and weight < WEIGHT else weight
        text = n.own_text() if n.tag in BLOCK or n.tag == "a" or n is root else ""
        block = len(text) if n.tag in BLOCK or n is root else 0
        varies = block if (n.slot, text) not in template else 0
        sizes[id(n)] = [weight * varies, block, len(text) if n.tag == "a" else 0, varies, is_article(n), n.tag == "h1"]
        stack += [(c, n, weight) for c in n.elements() if not c.skip or marked and c.soft]
    for n, parent in reversed(order):
        if parent is not None:
            sizes[id(parent)] = [x + y for x, y in zip(sizes[id(parent)], sizes[id(n)])]
    return sizes


def unmark(trees: list[Node], template: set) -> None:
    """Marked elements that hold most of the varying text are shown."""
    held, whole, found = Counter(), Counter(), []
    for t in trees:
        sizes = text_sizes(t, template, True)
        total = sizes[id(t)][3]
        soft = [(n, sizes[id(n)]) for n in walk(t, True) if n.soft]
        for n, size in soft:
            held[n.slot] += size[3]
        for slot in {n.slot for n, _ in soft}:
            whole[slot] += total
        found.append((total, soft))
    for total, soft in found:
        for n, size in soft:
            if template and n.slot is not None:
                most = held[n.slot] > 0.5 * whole[n.slot]
            else:
                most = size[3] > 0.5 * total and (bool(template) or size[4] + size[5] > 0)
            if most:
                n.skip = False


def inner_blocks(node: Node):
    """The outermost block elements in a node."""
    stack = [*reversed(node.elements())]
    while stack:
        n = stack.pop()
        if not n.skip:
            if n.tag in BLOCK:
                yield n
            else:
                stack += reversed(n.elements())


def content_root(root: Node, sizes: dict, slots: Counter, template: set) -> tuple[Node, bool]:
    """``slots``: weighted varying text of each slot on all pages."""
    node, left = root, 0.0
    while True:
        whole = sizes[id(node)][0]
        inner = [*inner_blocks(node)]
        parts = [c for c in inner if c.tag not in TEXTUAL and c.tag != "header" and sizes[id(c)][0] > 0]
        if is_article(node):
            # the innermost of nested ones that holds all of it
            child = next((c for c in parts if sizes[id(c)][4] and sizes[id(c)][0] == whole), None)
            if child is None:
                return node, True
            node = child
            continue
        on_page = Counter()
        for c in parts:
            on_page[c.slot] += sizes[id(c)][0]

        def share(c: Node) -> float:
            own = sizes[id(c)][0] / whole
            if not template or c.slot is None or node.slot is None or not slots[node.slot]:
                return own
            return (own + slots[c.slot] / slots[node.slot] * sizes[id(c)][0] / on_page[c.slot]) / 2

        shares = sorted(((share(c), -k) for k, c in enumerate(parts)), reverse=True)
        if not shares or shares[0][0] < 0.6:
            return node, False
        child = parts[-shares[0][1]]
        # like ones beside it, and text that stands in the node itself
        like = any(is_article(c) and is_article(child) or c.label == child.label != c.tag and sizes[id(c)][0] >= 0.1 * whole or s >= 0.25
                   for s, c in ((s, parts[-k]) for s, k in shares[1:]))
        text = node.own_text() if node.tag in BLOCK or node is root else ""
        left += len(text) * ((node.slot, text) not in template) + sum(sizes[id(c)][0] for c in inner if c.tag in TEXTUAL)
        if like or left > 0.1 * sizes[id(root)][0] or sizes[id(child)][0] < 0.5 * sizes[id(root)][0]:
            return node, False
        node = child


def blocks(root: Node, template: set, marked: bool, sizes: dict) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def flush():
        if text := " ".join("".join(run).split()):
            out.append(text)
        run.clear()

    def is_links(c: Node) -> bool:
        """A list or block whose text is mostly links."""
        return sizes[id(c)][2] > 0.6 * max(sizes[id(c)][1], 1)

    # an article's fixed heading or paragraph stays if its holder has varying text
    stack = [(iter(root.children), False, marked, root)]
    while stack:
        children, ends_block, marked, holder = stack[-1]
        c = next(children, None)
        if c is None:
            stack.pop()
            if ends_block:
                flush()
        elif isinstance(c, str):
            run.append(c)
        elif c.tag == "br":
            run.append(" ")
        elif c.skip:
            if c.tag in BLOCK:
                flush()
        elif c.tag not in BLOCK:
            stack.append((iter(c.children), False, marked, holder))
        else:
            flush()
            if not marked and (c.tag in ("header", "ul", "ol", "div", "table") and is_links(c) or c.tag == "header" and not any(n.tag == "h1" for n in walk(c))):
                continue
            marked = marked or is_article(c)
            inside = holder if c.tag in TEXTUAL or c.tag in ROWS else c
            if (c.slot, c.own_text()) in template and not (marked and c.tag in TEXTUAL and sizes[id(holder)][3]):
                stack.append((inner_blocks(c), True, marked, inside))
            else:
                stack.append((iter(c.children), True, marked, inside))
    flush()
    return out


def title_of(root: Node) -> str:
    return next((t for n in walk(root) if n.tag == "h1" and (t := n.own_text())), "")


def extract_group(pages) -> list[str]:
    """Main texts of pages of one host."""
    trees = [parse(p) if p else None for p in pages]
    there = [t for t in trees if t is not None]
    if not there:
        return ["" for _ in pages]
    collapsed = [Slot([t]) for t in there]
    # the tree with the most slots shows most of the layout
    reference = max(collapsed, key=lambda s: sum(1 for _ in _slots(s)))
    number(reference)
    for s in collapsed:
        memo: dict = {}
        match(s, reference, memo)
        align(s, reference, memo)
    seen, distinct, counts = set(), 0, Counter()
    for t in there:
        texts = slot_texts(t)
        name = title_of(t) or hash(frozenset(texts))
        if name not in seen:
            seen.add(name)
            distinct += 1
            counts.update(texts)
    template = {x for x, n in counts.items() if n >= SHARE * distinct} if distinct >= LEAST_PAGES else set()
    unmark(there, template)
    slots, sizes_of = Counter(), {}
    for t in there:
        sizes = sizes_of[id(t)] = text_sizes(t, template)
        for n in walk(t):
            if n.slot is not None:
                slots[n.slot] += sizes[id(n)][0]
    out = []
    for t in trees:
        if t is None:
            out.append("")
            continue
        sizes, fixed = sizes_of[id(t)], template
        if not sizes[id(t)][3]:
            # nothing varies: a page like the others is all there is
            sizes, fixed = text_sizes(t, set()), set()
        root, marked = content_root(t, sizes, slots, fixed)
        out.append("\n".join(blocks(root, template, marked, sizes)))
    return out


def _slots(s: Slot):
    stack = [s]
    while stack:
        s = stack.pop()
        yield s
        stack += reversed(s.children)


def extract(pages: DataFrame, group: int = 128, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text)`` per row."""
    schema = pa.schema([(id_col, pa.int64()), (url_col, pa.string()), ("text", pa.string())])
    p = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))
    p = p.withColumn("host", host)
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # at most one row per `group` pages: it may be broadcast, and no join deals by host
    large = p.groupBy("host").agg(F.ceil(F.count("*") / F.lit(group)).alias("parts")).where("parts > 1")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "url", "html"), "parts"))
    dealt = (p.join(F.broadcast(large), "host", "left").withColumn("part", part).repartition(n, "host", "part")
             .sortWithinPartitions("host", "part").select("id", "url", "html", "host", "part"))

    def run(batches):
        def close():
            ids, urls, texts = zip(*held)
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(extract_group(texts), pa.string())], schema=schema)

        held, last = [], None
        for b in batches:
            for key, url, page, *name in zip(*(c.to_pylist() for c in b.columns)):
                if held and (name != last or len(held) >= MOST_PAGES * group):
                    yield close()
                    held = []
                held.append((key, url, page))
                last = name
        if held:
            yield close()

    return dealt.mapInArrow(run, f"`{id_col}` long, `{url_col}` string, text string")
