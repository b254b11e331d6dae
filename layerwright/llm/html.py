"""Main text of web pages by wrapper induction.

A page becomes a tree of block elements. Its skeleton is the tree of their distinct places, where neighbours with one
label (tag and classes) share a place. The skeletons of a host are aligned with the host's template by simple tree matching,
the dynamic programme over ordered children that maximises the number of matched nodes, and merged into it. Templates grow
inside tasks first, so a host with a third of all pages arrives as one template per task. Then every page is aligned with
the finished template, and Spark counts, exactly, on how many pages each node occurs and each of its texts. A text on most pages
of a node is template, one that varies is content.

The extraction aligns each page with its host's template and leaves out constant texts, and besides, whatever the
host, elements that are no article by their tag, role or class: menus, headers, footers, sidebars, notices, adverts, forms,
scripts, comments. If a page has ``article`` or ``main`` elements, the text is theirs.

Defined results. Null or empty html: empty text. Pages without a host form one host. Of pages of a host with the same main text one
counts for its template; hosts with fewer than ``MIN_PAGES`` such pages have no constant nodes. Repeated rows each give a row.
Broken mark-up never fails: open elements end with the page, end tags without start are ignored, elements deeper than
``MAX_DEPTH`` are taken as siblings. A page of any length is one value of its task. An empty table gives no rows. Other columns
than page_id, url and html are not looked at.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, batches, map_batches, pieces_of, ship, stage_table, total_of

MIN_PAGES = 8
CONSTANT_SHARE = 0.7
MAX_NODES = 2000  # of a template; nodes beyond are told by the labels on the way to them, and counted the same
BROADCAST_BYTES = 32 << 20  # of all templates together

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# How elements behave in HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = {"ul", "ol", "dl", "table", "select"}

# What is no article.
DROPPED_TAGS = RAW | set(
    "head nav aside form button select option dialog menu svg canvas object template audio video map math input".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
DROPPED_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promos promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget widgets footer foot cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social comment comments reply replies respond disqus discussion related recommended "
    "recommendations pagination pager toolbar masthead copyright disclaimer skip search teaser teasers banner alert topbar".split()
)
WORDS_OUTSIDE = set("header head top".split())  # as class words, outside the article only
# Words that say nothing about content: a class such as site-footer or ad-slot-2 is no article, share-price or ad-hoc may be.
NEUTRAL_WORDS = set(
    "area bar block bottom box btn button center col column container content div field fixed global group head header holder icon "
    "icons inner item items label left link links list local main mobile outer page panel post row section site slot small sticky "
    "title top right unit user wrap wrapper".split()
)
#: Elements nested deeper are taken as siblings of the one at this depth, as browsers do; no text is lost, its order kept.
MAX_DEPTH = 200


class Node:
    __slots__ = ("tag", "words", "dropped", "children", "place", "has_article")

    def __init__(self, tag: str, words: tuple[str, ...] = (), dropped: bool = False):
        self.tag, self.words, self.dropped = tag, words, dropped
        self.children: list = []  # nodes and texts, in page order
        self.place = -1
        self.has_article = False


def _meaning(token: str) -> list[str]:
    """The words of one class or id if they tell what the element is for, else the whole token as one word: a word of
    ``DROPPED_WORDS`` counts only where the others are of that kind, too, or neutral."""
    words = [w.lower() for w in _NAME.findall(token)]
    known = [w for w in words if w in DROPPED_WORDS or w in WORDS_OUTSIDE]
    if known and any(w not in DROPPED_WORDS and w not in NEUTRAL_WORDS for w in words):
        return ["-".join(words) + "-"]
    return words


@lru_cache(20_000)
def _attributes(raw: str) -> tuple[tuple[str, ...], bool]:
    """The words of class and id, and whether the element is hidden or has another role than content."""
    words, dropped = [], False
    for name, value in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            dropped |= value.lower() in DROPPED_ROLES
        elif name in ("class", "id"):
            words += [word for token in value.split() for word in _meaning(token)]
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            dropped = True
        elif name == "style":
            dropped |= "display:none" in value.replace(" ", "").lower()
    return tuple(words), dropped


def parse(page: str) -> Node:
    """The tree of block elements. Inline elements are part of their block's text, unless they are to be dropped."""
    root = Node("html")
    stack, inline_drop = [root], []
    open_tags: Counter = Counter()
    buffer: list[str] = []
    at = 0

    def attach(node: Node):
        """Below the innermost open element, or next to it where that is as deep as trees go; it is dropped with it."""
        outer = stack[-1]
        if len(stack) > MAX_DEPTH:
            node.dropped |= outer.dropped or any(w in DROPPED_WORDS for w in outer.words)
        stack[min(len(stack), MAX_DEPTH) - 1].children.append(node)

    def flush():
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                if len(stack) > MAX_DEPTH and stack[MAX_DEPTH - 1].children[-1] is not stack[-1]:
                    # another element has come since: the text stands in a continuation of its own, behind it
                    old = stack.pop()
                    fresh = Node(old.tag, old.words, old.dropped)
                    attach(fresh)
                    stack.append(fresh)
                stack[-1].children.append(text)

    def close_to(depth: int):
        flush()
        open_tags.subtract(node.tag for node in stack[depth:])
        del stack[depth:]

    end = len(page)
    while at < end:
        match = _TAG.search(page, at)
        if match is None:
            break
        if match.start() > at and not inline_drop:
            buffer.append(page[at : match.start()])
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1] or match[4]:
            if inline_drop and inline_drop[-1] == tag:
                inline_drop.pop()
            elif tag not in INLINE:
                for depth in range(len(stack) - 1, 0, -1) if open_tags[tag] > 0 else ():
                    if stack[depth].tag == tag:
                        close_to(depth)
                        break
                if tag in ("p", "br"):
                    flush() if tag == "p" else buffer.append(" ")
            continue
        raw = match[3] if match[2] else match[6]
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        words, dropped = _attributes(raw) if raw.strip(" /") else ((), False)
        if tag in VOID or raw.endswith("/") and tag in INLINE:
            if tag == "hr":
                flush()
            continue
        if tag in INLINE:
            if inline_drop:
                if tag == inline_drop[-1]:
                    inline_drop.append(tag)
            elif dropped or any(w in DROPPED_WORDS for w in words):
                inline_drop.append(tag)
            continue
        inline_drop.clear()
        if tag in ENDS_P:
            if stack[-1].tag == "p":
                close_to(len(stack) - 1)
        elif tag in ENDS_SAME:
            for depth in range(len(stack) - 1, 0, -1) if any(open_tags[t] > 0 for t in ENDS_SAME[tag]) else ():
                if stack[depth].tag in ENDS_SAME[tag]:
                    close_to(depth)
                    break
                if stack[depth].tag in LISTS:
                    break
        flush()
        if tag == "body" or tag == "html":
            root.words += words if tag == "body" else ()
            continue
        node = Node(tag, words, dropped or tag in DROPPED_TAGS)
        attach(node)
        stack.append(node)
        open_tags[tag] += 1
    if at < end and not inline_drop:
        buffer.append(page[at:])
    flush()
    return root


def label(node: Node) -> str:
    return ".".join((node.tag, *node.words)) if node.words else node.tag


def skeleton(root: Node) -> list:
    """The tree of places ``[label, children]``; sets the place of each node, numbered in the order of a walk."""
    places: list[list] = []

    def build(nodes: list[Node], depth: int) -> list:
        number = len(places)
        place = [label(nodes[0]), []]
        places.append(place)
        runs: dict[tuple[str, int], list[Node]] = {}
        for node in nodes:
            node.place = number
            seen, last = Counter(), None
            for child in node.children:
                if isinstance(child, Node):
                    name = label(child)
                    if name != last and depth < MAX_DEPTH:  # where all deeper elements are, one place per label
                        seen[name] += 1
                        last = name
                    runs.setdefault((name, seen[name]), []).append(child)
        for run in runs.values():
            place[1].append(build(run, depth + 1))
        return place

    return build([root], 1)


def simple_tree_matching(one: list, other: list, memo: dict) -> int:
    """The most nodes that two trees ``[label, children]`` can match in order; 0 if their roots differ."""
    if one[0] != other[0]:
        return 0
    key = (id(one), id(other))
    if key not in memo:
        memo[key] = 1 + _table(one[1], other[1], memo)[-1][-1]
    return memo[key]


def _table(left: list, right: list, memo: dict) -> list[list[int]]:
    table = [[0] * (len(right) + 1)]
    for i, a in enumerate(left):
        row, above = [0], table[-1]
        for j, b in enumerate(right):
            best = max(above[j + 1], row[j])
            weight = simple_tree_matching(a, b, memo)
            row.append(max(best, above[j] + weight) if weight else best)
        table.append(row)
    return table


def alignment(left: list, right: list, memo: dict) -> list[tuple[int, int]]:
    """The matched pairs of children of two matched nodes."""
    table, pairs, i, j = _table(left, right, memo), [], len(left), len(right)
    while i and j:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def size_of(node: list) -> int:
    return 1 + sum(size_of(child) for child in node[1])


class Template:
    """A host's merged tree of places ``[label, children]``."""

    def __init__(self, root: list | None = None):
        self.root = root or ["", []]
        self.size = size_of(self.root)

    def merge(self, tree: list) -> None:
        """Add a tree of the same kind of nodes."""
        if not self.root[0]:
            self.root, self.size = tree, size_of(tree)
        elif self.root[0] == tree[0]:
            self._merge(self.root, tree, {})

    def _merge(self, mine: list, other: list, memo: dict) -> None:
        matched = dict(alignment(other[1], mine[1], memo))
        insert = []
        for i, child in enumerate(other[1]):
            if i in matched:
                self._merge(mine[1][matched[i]], child, memo)
            else:
                size = size_of(child)
                if self.size + size <= MAX_NODES:
                    self.size += size
                    insert.append((max([matched[k] + 1 for k in matched if k < i], default=0), child))
        for place, child in reversed(insert):
            mine[1].insert(place, child)


def texts_of(root: Node, places: int) -> list[list[str]]:
    """The digests of the distinct texts of each place; the skeleton has numbered the nodes."""
    out: list[set[str]] = [set() for _ in range(places)]

    def fill(node):
        for child in node.children:
            if isinstance(child, Node):
                fill(child)
            else:
                out[node.place].add(digest(child))

    fill(root)
    return [sorted(x) for x in out]


def digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def node_keys(template: list, page: list) -> list[str]:
    """Per place of a page's skeleton, its node: the number of the template node that it is aligned with, or else, without
    one, a digest of its parent's node and its label."""
    out: list[str] = []
    numbers: dict[int, int] = {}
    memo: dict = {}

    def enumerate_(node):
        numbers[id(node)] = len(numbers)
        for child in node[1]:
            enumerate_(child)

    def walk(place, node, parent):
        own = str(numbers[id(node)]) if node is not None else blake2b(f"{parent}>{place[0]}".encode("utf-8", "surrogatepass"), digest_size=8).hexdigest() + "+"
        out.append(own)
        matched = dict(alignment(place[1], node[1], memo)) if node is not None else {}
        for i, child in enumerate(place[1]):
            walk(child, node[1][matched[i]] if i in matched else None, own)

    enumerate_(template)
    walk(page, template if template[0] == page[0] else None, "")
    return out


def _mark(node: Node) -> bool:
    """Set which nodes hold an article; an article of dropped class is none."""
    inside = False
    for child in node.children:
        if isinstance(child, Node):
            inside |= _mark(child)
    node.has_article = inside
    own = node.tag in ("article", "main") and not node.dropped and not any(w in DROPPED_WORDS for w in node.words)
    return inside or own


def _is_dropped(node: Node, in_article: bool) -> bool:
    if node.dropped:
        return not (node.has_article and node.tag not in DROPPED_TAGS)
    if node.has_article:
        return False
    if node.tag in ("footer", "header"):
        return node.tag == "footer" or not in_article
    return any(w in DROPPED_WORDS or (not in_article and w in WORDS_OUTSIDE) for w in node.words)


def main_blocks(root: Node, constant: dict[int, set[str]]) -> list[str]:
    """The blocks of the main text in page order."""
    whole = not _mark(root)
    blocks: list[str] = []

    def walk(node: Node, inside: bool):
        same = constant.get(node.place, ())
        for child in node.children:
            if isinstance(child, Node):
                if not _is_dropped(child, inside and not whole):
                    walk(child, inside or child.tag == "article" or (child.tag == "main" and not child.has_article))
            elif inside and not (same and digest(child) in same):
                blocks.append(child)

    walk(root, whole)
    return blocks


def host(column: str = "url"):
    return F.coalesce(F.lower(F.expr(f"try_parse_url({column}, 'HOST')")), F.lit(""))


SEEN = "host string, main long, places string, texts string"
TREES = "host string, tree string"
COUNTS = "host string, node string, digest string, n long"


def _see(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(SEEN)
    for batch in rows:
        for part in pieces_of(batch, "html"):
            out = {name: [] for name in schema.names}
            for name, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                if page:
                    root = parse(page)
                    tree = skeleton(root)
                    out["host"].append(name)
                    out["main"].append(int(digest("\n".join(main_blocks(root, {}))), 16) - (1 << 63))
                    out["places"].append(json.dumps(tree))
                    out["texts"].append(json.dumps(texts_of(root, size_of(tree)), separators=(",", ":")))
            yield from batches(out, schema)


def _grow(rows: Iterator[pa.RecordBatch], hosts: int = 2000) -> Iterator[pa.RecordBatch]:
    """One template per host and task."""
    schema = arrow_schema(TREES)
    held: dict[str, Template] = {}

    def flush():
        trees = [json.dumps(t.root, separators=(",", ":")) for t in held.values()]
        yield from batches({"host": list(held), "tree": trees}, schema, 500)
        held.clear()

    for batch in rows:
        for name, tree in zip(batch.column("host").to_pylist(), batch.column("places").to_pylist(), strict=True):
            held.setdefault(name, Template()).merge(json.loads(tree))
        if len(held) > hosts:
            yield from flush()
    yield from flush()


def _count(rows: Iterator[pa.RecordBatch], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """On how many pages a node occurs (digest null), and each of its texts."""
    schema = arrow_schema(COUNTS)
    held: Counter = Counter()
    keys_of = aligner()

    def flush():
        host_, node, text = zip(*held, strict=True) if held else ((), (), ())
        yield from batches({"host": host_, "node": node, "digest": text, "n": list(held.values())}, schema)
        held.clear()

    for batch in rows:
        columns = (batch.column(c).to_pylist() for c in ("host", "places", "texts", "tree"))
        for name, places, texts, tree in zip(*columns, strict=True):
            nodes = keys_of(tree, places)
            held.update({(name, node, None) for node in nodes})
            held.update({(name, node, text) for node, own in zip(nodes, json.loads(texts), strict=True) for text in own})
            if len(held) > most:
                yield from flush()
    yield from flush()


def aligner():
    """``node_keys`` of a template and a skeleton as JSON, remembered."""
    load = lru_cache(256)(json.loads)
    return lru_cache(5000)(lambda tree, places: node_keys(load(tree), json.loads(places)))


def templates(pages: DataFrame) -> DataFrame:
    """``host, tree, same``: the template of each host and, by its nodes, the texts that are constant there. Pages of a host
    with the same main text count once."""
    ship(pages.sparkSession)
    seen = map_batches(pages.select(host().alias("host"), "html"), _see, SEEN)
    page = F.min(F.struct("places", "texts")).alias("page")
    once = stage_table(seen.groupBy("host", "main").agg(page).select("host", "main", "page.*"), "skeletons")
    grown = map_batches(once.select("host", "places").distinct(), _grow, TREES)
    trees = stage_table(grown.groupBy("host").applyInPandas(_merge_all, TREES), "trees")
    counted = map_batches(with_templates(once, trees, "main").select("host", "places", "texts", "tree"), _count, COUNTS)
    counts = stage_table(counted.groupBy("host", "node", "digest").agg(F.sum("n").alias("n")), "text-counts")
    usual = counts.filter(f"digest is null and n >= {MIN_PAGES}").select("host", "node", F.col("n").alias("pages"))
    often = counts.filter(f"digest is not null and n >= {CONSTANT_SHARE * MIN_PAGES}").join(usual, ["host", "node"])
    constant = often.filter(F.col("n") >= CONSTANT_SHARE * F.col("pages"))
    same = F.to_json(F.sort_array(F.collect_list(F.struct("node", "digest")))).alias("same")
    return trees.join(constant.groupBy("host").agg(same), "host", "left")


def _merge_all(frame: pd.DataFrame) -> pd.DataFrame:
    template = Template()
    for tree in frame["tree"].sort_values():
        template.merge(json.loads(tree))
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "tree": [json.dumps(template.root, separators=(",", ":"))]})


EXTRACTED = "page_id long, url string, text string, n_chars long"


def _extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(EXTRACTED)
    @lru_cache(256)
    def load(same):
        out: dict[str, set[str]] = {}
        for row in json.loads(same):
            out.setdefault(row["node"], set()).add(row["digest"])
        return out

    keys_of = aligner()
    aligned: dict[tuple[str, str, str], dict[int, set[str]]] = {}
    for batch in rows:
        for part in pieces_of(batch, "html"):
            texts = []
            columns = (part.column(c).to_pylist() for c in ("html", "tree", "same"))
            for page, tree, same in zip(*columns, strict=True):
                root = parse(page or "")
                places = json.dumps(skeleton(root))
                key = (tree, same, places)
                if same and key not in aligned:
                    if len(aligned) > 5000:
                        aligned.clear()
                    own = load(same)
                    aligned[key] = {i: own[node] for i, node in enumerate(keys_of(tree, places)) if node in own}
                texts.append("\n".join(main_blocks(root, aligned[key] if same else {})))
            columns = {"page_id": part.column("page_id").to_pylist(), "url": part.column("url").to_pylist()}
            yield from batches({**columns, "text": texts, "n_chars": [len(t) for t in texts]}, schema)


SALTS = 16


def with_templates(rows: DataFrame, learnt: DataFrame, salt: str) -> DataFrame:
    """The rows with their host's columns of ``learnt``, a written table."""
    sizes = "+".join(f"coalesce(length({c}), 0)" for c in learnt.columns if c != "host")
    if total_of(learnt, f"sum({sizes})") <= BROADCAST_BYTES:
        return rows.join(F.broadcast(learnt), "host", "left")
    # more templates than may be broadcast: both sides are dealt by host, pages of one host over SALTS tasks
    salted = learnt.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(salt), SALTS).cast("int")).join(salted, ["host", "salt"], "left")


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page."""
    learnt = stage_table(templates(pages), "templates")
    rows = pages.select("page_id", "url", "html", host().alias("host"))
    joined = with_templates(rows, learnt, "page_id")
    return map_batches(joined.select("page_id", "url", "html", "tree", "same"), _extract, EXTRACTED)
