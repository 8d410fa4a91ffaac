"""HTML extraction by wrapper induction.

Pages of one host are trees filled in from one template. Every page is parsed into a tree of its block
elements (runs of equal siblings make one node) with the text blocks at its nodes. The most frequent
tree of a host is its reference; simple tree matching aligns every other tree of the host with it, so
that a text block gets a slot. Pages whose trees agree with it in less than half of their nodes are of
another layout: the most frequent of their trees is the next reference, and so on. A block that stands in
its slot on the different pages of the layout whose trees have the slot, but for one in STRAYS (one page at
least: an error page that happens to fit), is template; what varies is content. Pages without main text
are not counted. Elements that are no article by their kind (menus, footers, forms,
scripts, adverts, comments and so on, by tag, role, class or id) are left out in any case, and where a
page has article or main elements, only their text counts. A class or id hides no html, body, main or
article and no main inside; an article inside counts if it is the page's only one or nothing else is left.

A template needs MIN_PAGES different pages, and blocks that make up more than a third of a page's text
are no template: groups of copies on one host keep their text.

Only the block hashes and trees are shuffled, never the html; a host's pages are counted by partial
aggregates, so a host with a third of all pages is no hot group. Hosts without template blocks need no
wrapper; the others' wrappers are broadcast up to MOST_WRAPPERS, and joined by a shuffle beyond.

Defined cases: null or empty html is an empty text; broken and cut markup is read as far as it goes
(unclosed elements end with their parent, an unfinished tag at the end is dropped); null urls are one
host; repeated rows are read alike; an empty table gives none; extra columns pass through (`extracted`
puts `text` in place of an input column of this name).
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlake.llm.common import packed, pieces, small_batches, stored, table, unpacked
from feedlake.llm.urls import host_and_path

MIN_PAGES = 5
#: One page in so many that have a slot, and one at least, may have another text there.
STRAYS = 10
MOST_WRAPPERS = 100_000
#: Deepest nodes that have slots of their own; text below belongs to the slot there.
DEPTH = 100
#: Text beside the articles (outside links) that makes them teasers: so many times theirs, and so many characters.
TEASER, TEASER_CHARS = 4, 200
#: Elements that are running text wherever they stand: inside an article no class or id hides them.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption b i em strong a span code".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
NAMES = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption button select option optgroup legend".split()
)
CLOSES_P = BLOCKS - frozenset("html body td th tr tbody thead tfoot caption option optgroup button select legend summary".split())
#: A start tag ends these open elements, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
NO_ARTICLE = frozenset("head nav footer aside form script style noscript template iframe svg canvas object select button textarea title menu dialog audio video math xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words in a class or id that mark what is no article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs footer sidebar widget related share sharing social "
    "comment comments disqus replies cookie cookies consent notice notices popup modal newsletter subscribe signup login search toolbar pagination pager skip masthead".split()
)
PAGE_MARKS = frozenset("header topbar".split())  # outside articles only
#: Before a mark these make it a layout's name (no-sidebar); after one mark alone, names of a box are no part of the mark (ad-slot).
LAYOUT = frozenset("no not non has have with without hide".split())
BOXES = frozenset("list box container wrapper wrap area block section slot unit links link buttons button icons bar panel posts form body".split())
PIECES = re.compile(r"[_-]+")
#: Elements whose text is no text of the page in any case, and those that an open paragraph doesn't reach beyond.
SILENT = frozenset("head script style noscript template iframe svg canvas object textarea title audio video math xmp noembed noframes select".split())
P_ENDS = frozenset("button table td th".split())


def marked(names: str, marks: frozenset, alone: bool = False) -> bool:
    """Whether a name of a class or id is a mark, or ends in one that no word of LAYOUT precedes; alone: whether it
    consists of marks and names of boxes."""
    for name in names.split():
        piece = [x for x in PIECES.split(name) if x]
        if alone:
            if not marks.isdisjoint(piece) and all(x in marks or x in BOXES for x in piece):
                return True
            continue
        if len(piece) == 2 and piece[1] in BOXES:
            piece.pop()
        if piece and piece[-1] in marks and LAYOUT.isdisjoint(piece[:-1]):
            return True
    return False


class Page:
    """A page's tree of block elements and its text blocks: (text, node, 1 inside main and 2 inside an article, number of
    the article if it lies in an element hidden by class or id, else 0, hidden, characters outside links)."""

    def __init__(self, source: str):
        self.labels, self.children, self.blocks = ["html"], [[]], []
        self._read(source)

    def _node(self, parent: int, label: str) -> int:
        own = self.children[parent]
        if own and self.labels[own[-1]] == label:
            return own[-1]
        self.labels.append(label)
        self.children.append([])
        own.append(len(self.labels) - 1)
        return own[-1]

    def _read(self, s: str) -> None:
        # an open element: tag, node, hidden, 1 in main + 2 in article, hidden by marks alone, article in what marks hide
        stack: list[tuple[str, int, bool, int, bool, int]] = [("html", 0, False, 0, False, 0)]
        count = Counter(["html"])  # open elements by tag: what isn't open need not be looked for
        articles, plain = 0, 0
        text: list[str] = []

        def add(piece: str):
            nonlocal plain
            text.append(piece)
            plain += 0 if count["a"] else len(piece)

        def flush():
            nonlocal plain
            if text:
                own = " ".join(html.unescape("".join(text)).split())
                text.clear()
                if own:
                    self.blocks.append((own, stack[-1][1], stack[-1][3], stack[-1][5], stack[-1][2], min(plain, len(own))))
                plain = 0

        def close(to: int):
            while len(stack) > to:
                if stack[-1][0] in BLOCKS:
                    flush()
                count[stack.pop()[0]] -= 1

        def nearest(tags, until=frozenset()):
            """The innermost open element of these tags, above any of `until`; 0: none."""
            if any(count[t] for t in tags):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in tags:
                        return k
                    if stack[k][0] in until:
                        break
            return 0

        at, n = 0, len(s)
        while at < n:
            m = TAG.search(s, at)
            if m is None:
                if stack[-1][0] not in SILENT:
                    add(s[at:])
                break
            if m.start() > at and stack[-1][0] not in SILENT:
                add(s[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if not s.endswith(">", m.start(), at):
                break  # the page ends inside a tag
            if m[1] or m[4]:
                k = nearest((tag,))
                if k:
                    close(k)
                elif tag in BLOCKS:
                    flush()
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(s, at)
                at = end.start() if end else n
                if tag not in NO_ARTICLE:
                    stack.append((tag, stack[-1][1], True, 0, False, 0))
                    count[tag] += 1
                elif end:
                    at = (s.find(">", at) + 1) or n
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                else:
                    add(" ")
                continue
            if tag in CLOSES_P and (k := nearest(("p",), P_ENDS)):
                close(k)
            if tag in ENDS:
                ends, until = ENDS[tag]
                low = len(stack)
                for k in range(len(stack) - 1, 0, -1) if any(count[t] for t in ends) else ():
                    if stack[k][0] in until:
                        break
                    if stack[k][0] in ends:
                        low = k
                close(low)
            _, node, hidden, inside, by_mark, number = stack[-1]
            attributes = m[3] or m[6] or ""
            names = {k.lower(): v.strip("\"'").lower() for k, v in NAMES.findall(attributes)} if "=" in attributes else {}
            marks = names.get("class", "") + " " + names.get("id", "")
            main = tag in ("article", "main") or names.get("role") == "main"
            article = inside | 2 if tag == "article" else inside | 1 if main else inside
            if main and by_mark and not inside & 2:  # marks hide no ancestor of an article
                articles += 1
                hidden, by_mark, number = False, False, articles if tag == "article" else 0
            if tag in NO_ARTICLE or names.get("role") in ROLES or (not article and tag == "header"):
                hidden, by_mark = True, False
            elif article and tag in RUNNING:
                pass
            elif not hidden and not main and tag not in ("html", "body") and marks != " " and (marked(marks, MARKS, bool(article)) or (not article and marked(marks, PAGE_MARKS))):
                hidden, by_mark = True, True
            if tag in BLOCKS:
                flush()
                if len(stack) < DEPTH:
                    node = self._node(node, tag + ("." + names["class"].split()[0] if names.get("class", "").split() else ""))
            if hidden != stack[-1][2]:
                flush()
            stack.append((tag, node, hidden, article, by_mark, number))
            count[tag] += 1
            if tag in ("plaintext",):
                break
        close(0)

    def main(self) -> list[int]:
        """The text blocks that count by tags and marks."""
        seen = [k for k, b in enumerate(self.blocks) if not b[4]]
        open_ = [k for k in seen if not self.blocks[k][3]]
        if not any(self.blocks[k][2] for k in open_) and (not open_ or len({self.blocks[k][3] for k in seen} - {0}) == 1):  # several would be teasers or comments
            open_ = seen
        if whole := [k for k in open_ if self.blocks[k][2] & 1]:
            return whole
        if not (articles := [k for k in open_ if self.blocks[k][2]]):
            return open_
        beside = sum(self.blocks[k][5] for k in open_) - sum(self.blocks[k][5] for k in articles)
        return open_ if beside >= max(TEASER_CHARS, TEASER * sum(self.blocks[k][5] for k in articles)) else articles

    def shape(self) -> str:
        """The tree, in one line: label(children)."""
        out: list[str] = []
        todo: list[int | str] = [0]
        while todo:
            k = todo.pop()
            if isinstance(k, str):
                out.append(k)
                continue
            out.append(re.sub(r"[(),]", "_", self.labels[k]) + "(")
            todo.append(")")
            todo.extend(reversed(self.children[k]))
        return "".join(out)


def tree_of(shape: str) -> tuple[list[str], list[list[int]], list[int]]:
    """Labels, children and the parents of a shape's nodes in the order of their start."""
    labels, children, parents, stack = [], [], [], []
    for m in re.finditer(r"([^()]*)\(|\)", shape):
        if m[0] == ")":
            stack.pop()
            continue
        labels.append(m[1])
        children.append([])
        parents.append(stack[-1] if stack else -1)
        if stack:
            children[stack[-1]].append(len(labels) - 1)
        stack.append(len(labels) - 1)
    return labels, children, parents


def aligned(shape: str, reference: str) -> dict[int, int]:
    """Simple tree matching: which node of the reference each node of the shape corresponds to, so that
    labels and the order of siblings agree and as many nodes as possible are matched."""
    la, ca, _ = tree_of(shape)
    lb, cb, _ = tree_of(reference)
    scores: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    kinds: dict[tuple, int] = {}  # equal subtrees are of one kind
    ka, kb = [0] * len(la), [0] * len(lb)
    for k, labels, children in ((ka, la, ca), (kb, lb, cb)):
        for i in range(len(labels) - 1, -1, -1):
            k[i] = kinds.setdefault((labels[i], *(k[c] for c in children[i])), len(kinds))

    def match(a: int, b: int) -> tuple[int, list[tuple[int, int]]]:
        if la[a] != lb[b]:
            return 0, []
        if (a, b) in scores:
            return scores[a, b]
        x, y = ca[a], cb[b]
        by_label: dict[str, list[int]] = {}
        for j, child in enumerate(y):
            by_label.setdefault(lb[child], []).append(j)
        known: dict[int, np.ndarray] = {}
        gains: dict[int, np.ndarray] = {}

        def after(best: np.ndarray, i: int) -> np.ndarray:
            """The table's next row, from the row before child i."""
            at = by_label.get(la[x[i]])
            if at is None:
                return best
            gain = best[1:].copy()
            own = gains.get(ka[x[i]])
            if own is None:
                first = {kb[y[j]]: y[j] for j in reversed(at)}
                score_of = {k: match(x[i], c)[0] for k, c in first.items()}
                own = gains[ka[x[i]]] = np.array([score_of[kb[y[j]]] for j in at], np.int32)
            gain[at] = np.maximum(gain[at], best[at] + own)
            return np.concatenate([best[:1], np.maximum.accumulate(gain)])

        step = max(1, math.isqrt(len(x)))  # every step-th row is kept, those between are made again on the way back
        best = np.zeros(len(y) + 1, np.int32)
        for i in range(len(x)):
            if i % step == 0:
                known[i] = best
            best = after(best, i)
        score, pairs, i, j, rows, low = 1 + int(best[-1]), [], len(x), len(y), [], len(x)
        while i and j:
            if i <= low:
                low = (i - 1) // step * step
                rows = [known[low]]
                for k in range(low, i):
                    rows.append(after(rows[-1], k))
            if rows[i - low][j] == rows[i - low - 1][j]:
                i -= 1
            elif rows[i - low][j] == rows[i - low][j - 1]:
                j -= 1
            else:
                pairs.append((x[i - 1], y[j - 1]))
                i, j = i - 1, j - 1
        scores[a, b] = (score, pairs)
        return scores[a, b]

    out, todo = {}, [(0, 0)] if la and lb and match(0, 0)[0] else []
    while todo:
        a, b = todo.pop()
        out[a] = b
        todo += match(a, b)[1]
    return out


class _Slots(dict):
    """Alignments, by (shape, reference)."""

    def __missing__(self, key: tuple[str, str]) -> dict[int, int]:
        if len(self) > 20_000:
            self.clear()
        out = self[key] = aligned(*key)
        return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def _preorder(page: Page) -> dict[int, int]:
    """Each node's number in its shape."""
    out: dict[int, int] = {}
    todo = [0]
    while todo:
        k = todo.pop()
        out[k] = len(out)
        todo.extend(reversed(page.children[k]))
    return out


def _trees(batches):
    """Each page's tree, its blocks as (node, hash), and a print of its main text (null without any)."""
    for batch in batches:
        for b in pieces([batch], "html"):
            rows = {"shape": [], "print": [], "nodes": [], "hashes": []}
            for source in b.column("html").to_pylist():
                page = Page(source or "")
                number, hashes = _preorder(page), [_hash(b[0]) for b in page.blocks]
                main = [hashes[k] for k in page.main()]
                rows["shape"].append(page.shape())
                rows["print"].append(_hash(" ".join(map(str, main))) if main else None)
                rows["nodes"].append([number[b[1]] for b in page.blocks])
                rows["hashes"].append(hashes)
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(rows["shape"]), pa.array(rows["print"], pa.int64()), pa.array(rows["nodes"], pa.list_(pa.int32())), pa.array(rows["hashes"], pa.list_(pa.int64()))],
                                             names=["host", "shape", "print", "nodes", "hashes"])


def _near(to: dict[int, int], shape: str, reference: str) -> bool:
    """Whether at least half of both trees' nodes correspond."""
    return 4 * len(to) >= shape.count("(") + reference.count("(")


def _slotted(batches):
    """Of the pages near their reference: (slot, hash) of each block, and (slot, null) of each slot the tree has."""
    slots = _Slots()
    for b in batches:
        host, prints, slot, hashes = [], [], [], []
        for r in b.to_pylist():
            to = slots[r["shape"], r["reference"]]
            if not _near(to, r["shape"], r["reference"]):
                continue
            own = {(to[k], h) for k, h in zip(r["nodes"], r["hashes"]) if k in to}
            for k, h in [*own, *((k, None) for k in to.values())]:
                host.append(r["host"])
                prints.append(r["print"])
                slot.append(k)
                hashes.append(h)
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(prints, pa.int64()), pa.array(slot, pa.int32()), pa.array(hashes, pa.int64())], names=["host", "print", "slot", "hash"])


def _far(batches):
    """The pages that are not near their reference."""
    slots = _Slots()
    for b in batches:
        far = [not _near(slots[s, r], s, r) for s, r in zip(b.column("shape").to_pylist(), b.column("reference").to_pylist())]
        yield b.select(["host", "print", "shape", "nodes", "hashes"]).filter(pa.array(far, pa.bool_()))


TREES = "host string, shape string, print long, nodes array<int>, hashes array<long>"


def wrappers(pages: DataFrame) -> DataFrame:
    """pages(host, html) -> (host, layouts): of each host that has template blocks, its layouts in order, with
    their rank, reference tree and template as an array of (slot, hash)."""
    trees = stored(pages.mapInArrow(_trees, TREES), "html-trees").where(F.col("print").isNotNull())
    left = stored(trees.groupBy("host", "print", "shape").agg(F.first("nodes").alias("nodes"), F.first("hashes").alias("hashes")), "html-different")
    found, rank = [], 0
    while True:  # a layout of each host at a time; its reference at least leaves, and hosts with too few pages
        many = left.select("host", "print").distinct().groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES).select("host")
        shapes = left.groupBy("host", "shape").agg(F.count("*").alias("n"))
        reference = stored(shapes.groupBy("host").agg(F.min(F.struct(-F.col("n"), "shape")).alias("r")).select("host", F.col("r.shape").alias("reference")).join(many, "host"), "html-references")
        if rank and reference.isEmpty():
            break
        both = left.join(reference, "host")
        placed = both.mapInArrow(_slotted, "host string, print long, slot int, hash long")
        counts = stored(placed.groupBy("host", "slot", "hash", "print").agg(F.lit(1)).groupBy("host", "slot", "hash").agg(F.count("*").alias("pages")), "html-counts")
        of = counts.where("hash is null").select("host", "slot", F.col("pages").alias("n"))
        constant = counts.where("hash is not null").join(of, ["host", "slot"]).where((F.col("pages") >= MIN_PAGES) & (F.col("n") - F.col("pages") <= F.greatest(F.lit(1.0), F.col("n") / STRAYS)))
        template = constant.groupBy("host").agg(F.collect_list(F.struct("slot", "hash")).alias("template"))  # blocks that nearly every page has: not many more than one page's
        found.append(template.join(reference, "host").select("host", F.struct(F.lit(rank).alias("rank"), "reference", "template").alias("layout")))
        left = stored(both.select("host", "print", "shape", "nodes", "hashes", "reference").mapInArrow(_far, "host string, print long, shape string, nodes array<int>, hashes array<long>"), "html-left")
        rank += 1
    return reduce(DataFrame.unionByName, found).groupBy("host").agg(F.sort_array(F.collect_list("layout")).alias("layouts"))


def page_text(page: Page, reference: str | None, template: set, slots: _Slots, marks: bool = True) -> str:
    main = page.main() if marks else list(range(len(page.blocks)))
    if reference and template:
        to, number = slots[page.shape(), reference], _preorder(page)
        fixed = {k for k in main if (to.get(number[page.blocks[k][1]]), _hash(page.blocks[k][0])) in template}
        if 3 * sum(len(page.blocks[k][0]) for k in fixed) <= sum(len(page.blocks[k][0]) for k in main):
            main = [k for k in main if k not in fixed]
    return "\n\n".join(page.blocks[k][0] for k in main)


def extracted(pages: DataFrame, url: str = "url", source: str = "html", keep: list[str] | None = None, marks: bool = True) -> DataFrame:
    """pages (or its columns `keep`) with text, the main text of the page. Without `marks` the hosts' templates decide
    alone: all text of a page but scripts and the like counts that is no template."""
    small_batches(pages.sparkSession)
    keep = pages.columns if keep is None else keep
    own = packed(pages, keep, F.col(source).alias("html"), host_and_path(F.col(url))[0].alias("host"))
    found = stored(wrappers(own.select("host", "html")), "html-wrappers")
    read = own.withColumnRenamed("host", "host_")
    found = found.select(F.col("host").alias("host_"), "layouts")
    n = found.count()
    if n:
        read = read.join(F.broadcast(found) if n <= MOST_WRAPPERS else found, "host_", "left")
    else:
        read = read.withColumn("layouts", F.lit(None).cast("array<struct<rank:int,reference:string,template:array<struct<slot:int,hash:long>>>>"))
    out = T.StructType([read.schema["row__"], T.StructField("text", T.StringType())])
    schema = to_arrow_schema(out)

    def run(batches):
        slots = _Slots()
        for batch in batches:
            for b in pieces([batch], "html"):
                texts = []
                for source_, layouts in zip(b.column("html").to_pylist(), b.column("layouts").to_pylist()):
                    page = Page(source_ or "")
                    shape = page.shape() if layouts else ""
                    own = next((x for x in layouts or () if _near(slots[shape, x["reference"]], shape, x["reference"])), None)
                    texts.append(page_text(page, own and own["reference"], {(x["slot"], x["hash"]) for x in own["template"]} if own else set(), slots, marks))
                yield pa.RecordBatch.from_arrays([b.column("row__"), pa.array(texts, pa.string())], schema=schema)

    return unpacked(read.mapInArrow(run, out), keep, "text")


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"), keep=["page_id", "url"]).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
