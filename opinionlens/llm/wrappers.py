"""Main text of web pages by wrapper induction.

Pages become trees of labels (tag, and the class or id that names a part), in which
siblings of one label are one repeated slot. The most frequent tree of a host is its
reference, and every page of the host is aligned with it by simple tree matching:
the largest set of node pairs of equal labels that keeps order and descent. Texts are
counted by host and aligned slot over all pages. A text that most pages have in the
same slot is template; the other texts are what varies. The host's content region
is found by descending from the root as long as one slot holds nearly all of the
varying text outside menus, footers and other parts that tags or names give away.
A page's text is what varies inside that region.

Hosts of fewer than ``MIN_PAGES`` pages share one wrapper; a page that has no place
for its wrapper's region is judged by its own texts in the same way.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionlens.llm.common import drop_held, release, text_slices, with_fields
from opinionlens.operators.scaling import bounded_join
from opinionlens.session import materialize

MIN_PAGES = 3
#: Share of a host's pages that have a template text in one slot, and the least number of them.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.6, 4
#: Share of the varying text that a slot must hold for the region to be inside it.
REGION_SHARE = 0.9
#: Wrappers that are broadcast after a count, some kilobytes each.
MAX_WRAPPERS = 10_000
#: Alignments a task remembers.
REMEMBERED = 5_000

# HTML's elements by how they are parsed and shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg math object select option button".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head",), "tbody": ("thead", "tbody", "tr", "td", "th"),
}
KEEPS_OPEN = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",)}
# Parts of a page that are not its article, by tag, and by a word in a class, id or role.
OTHER_TAGS = frozenset("nav footer aside form head header dialog menu fieldset".split())
OTHER_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion sidebar side aside menu nav navbar navigation breadcrumb"
    " breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe"
    " subscription signup login share sharing social related recommended comment comments reply replies respond disqus pagination pager search"
    " skip toolbar widget complementary contentinfo".split()
)
# A name such as "with-sidebar" tells of another part.
SAYS_OF_OTHERS = ("with", "has", "no", "without")
ARTICLE_TAGS = ("article", "main")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.DOTALL
)
_NAME = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Node:
    """A slot of a page's tree: label, whether it is surely no article, and its slots by label, in order."""

    label: str
    other: bool = False
    children: dict[str, Node] = field(default_factory=dict)
    number: int = 0

    def shape(self) -> list:
        return [self.label, *(c.shape() for c in self.children.values())]


@dataclass
class Page:
    """A page's tree, its slots by number, and (slot, text) of each block in page order."""

    root: Node
    nodes: list[Node]
    parents: list[int]
    blocks: list[tuple[int, str]]


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    names: dict[str, str] = {}
    if "=" in attributes:
        for kind, value in _NAME.findall(attributes):
            names.setdefault(kind.lower(), value.strip("\"'").strip())
    parts = [_WORDS.findall(name) for value in names.values() for name in value.lower().split()]
    other = tag in OTHER_TAGS or (tag not in ("html", "body") and any(p and p[0] not in SAYS_OF_OTHERS and OTHER_NAMES & set(p) for p in parts))
    # An id with a number names one thing only, not a part that pages share.
    name = names.get("class") or ("" if re.search(r"\d", names.get("id", "")) else names.get("id", ""))
    return tag + ("." + " ".join(name.split()) if name else ""), other


def parse(source: str) -> Page:
    """The tree and the blocks of an HTML text, however broken.

    Unknown end tags are passed over, missing ones are implied. Scripts, styles,
    titles, form controls and comments have no text. A block is the text between
    two starts or ends of elements that are not inline.
    """
    root = Node("")
    nodes, parents, blocks, pieces = [root], [-1], [], []
    stack: list[tuple[str, Node]] = [("", root)]
    depths: Counter = Counter()

    def end_block() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                blocks.append((next(n for t, n in reversed(stack) if t not in INLINE).number, text))

    def close(tag: str) -> None:
        while True:
            top = stack.pop()[0]
            depths[top] -= 1
            if top == tag:
                return

    at, end = 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        if found is None:
            pieces.append(source[at:])
            break
        if found.start() > at:
            pieces.append(source[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if tag not in INLINE:
            end_block()
        if found[1]:
            if tag == "br":
                pieces.append(" ")
            elif depths[tag]:
                end_block() if tag not in INLINE else None
                close(tag)
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(source, at)
            at = stop.end() if stop else (at if tag in ("option", "button", "select", "object") else end)
            continue
        if tag in VOID:
            pieces.append(" ")
            continue
        if tag not in INLINE and depths["p"]:
            close("p")  # a paragraph holds no block
        for old in CLOSES.get(tag, ()):
            for open_tag, _ in reversed(stack):
                if open_tag in KEEPS_OPEN.get(tag, ()):
                    break
                if open_tag == old:
                    close(old)
                    break
        if found[3].rstrip().endswith("/") and tag not in INLINE and tag not in ("p", "div", "li", "article", "section"):
            continue
        if tag in INLINE:
            stack.append((tag, stack[-1][1]))
        else:
            above = stack[-1][1]
            label, other = _label(tag, found[3])
            if tag == "header" and any(t in ARTICLE_TAGS for t, _ in stack):
                other = False  # an article's own head
            node = above.children.get(label)
            if node is None:
                node = above.children[label] = Node(label, other or above.other, {}, len(nodes))
                nodes.append(node)
                parents.append(above.number)
            stack.append((tag, node))
        depths[tag] += 1
    end_block()
    return Page(root, nodes, parents, blocks)


def reference_tree(shape: list) -> Page:
    """The tree that ``Node.shape`` describes, without texts."""
    root = Node(shape[0])
    nodes, parents = [root], [-1]

    def fill(node: Node, below: list) -> None:
        for own in below:
            child = node.children[own[0]] = Node(own[0], False, {}, len(nodes))
            nodes.append(child)
            parents.append(node.number)
            fill(child, own[1:])

    fill(root, shape[1:])
    return Page(root, nodes, parents, [])


def match_trees(a: Node, b: Node) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: most pairs of nodes (numbers in ``a``, in ``b``) of equal labels in order and descent."""
    if a.label != b.label:
        return 0, []
    left, right = list(a.children.values()), list(b.children.values())
    inner = {(i, j): match_trees(x, y) for i, x in enumerate(left) for j, y in enumerate(right) if x.label == y.label}
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i in range(len(left)):
        for j in range(len(right)):
            both = best[i][j] + inner[i, j][0] if (i, j) in inner else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], both)
    pairs, i, j = [], len(left), len(right)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += inner[i, j][1]
    return best[-1][-1] + 1, [(a.number, b.number), *pairs]


class Aligner:
    """Aligns pages with reference trees; a task remembers the alignments of equal trees."""

    def __init__(self):
        self.trees: dict[str, Page] = {}
        self.known: dict[tuple[str, str], dict[int, int]] = {}

    def slots(self, page: Page, shape: str, reference: str) -> dict[int, int]:
        """Slot of the reference for each of the page's slots that has one."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.trees.clear()
        if (shape, reference) not in self.known:
            if reference not in self.trees:
                self.trees[reference] = reference_tree(json.loads(reference))
            self.known[shape, reference] = dict(match_trees(page.root, self.trees[reference].root)[1])
        return self.known[shape, reference]


def shape_of(page: Page) -> str:
    return json.dumps(page.root.shape(), separators=(",", ":"), ensure_ascii=False)


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def content_region(tree: Page, weights: dict[int, int]) -> int:
    """The slot that holds nearly all of ``weights``, descending from the root; -1 without any weight.

    It goes no further where that would leave a varying heading out.
    """
    total = [weights.get(i, 0) for i in range(len(tree.nodes))]
    for i in range(len(total) - 1, 0, -1):
        total[tree.parents[i]] += total[i]
    if not total[0]:
        return -1
    articles = [n.number for n in tree.nodes if re.split(r"[. ]", n.label)[0] in ARTICLE_TAGS and 2 * total[n.number] >= total[0]]
    at = articles[0] if articles else 0
    while not articles:
        below = tree.nodes[at].children.values()
        inner = max(below, key=lambda c: (total[c.number], -c.number), default=None)
        if inner is None or total[inner.number] < REGION_SHARE * total[0]:
            break
        if re.match(r"(p|h[1-6]|li|td|tr|tbody|ul|ol|blockquote|pre)\b", inner.label):
            break
        if any(re.match(r"h[1-3]\b", c.label) and total[c.number] for c in below if c is not inner):
            break
        at = inner.number
    return at


def host_of(url: Column) -> Column:
    """Host as op2 defines it; empty for null."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def _shapes(pages: DataFrame, source: str) -> DataFrame:
    """(__host, shape, n): how many pages of each host a task has seen with each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        for whole in batches:
            counts: Counter = Counter()
            for batch, texts in text_slices(whole, source):
                for host, one in zip(batch["__host"].to_pylist(), texts.to_pylist(), strict=True):
                    counts[host, shape_of(parse(one))] += 1
            columns = [[h for h, _ in counts], [s for _, s in counts], list(counts.values())]
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["__host", "shape", "n"])
        release()

    return pages.select("__host", source).mapInArrow(run, "__host string, shape string, n bigint")


def _slot_texts(pages: DataFrame, source: str, fallback: str) -> DataFrame:
    """(__host, slot, text, n, chars): pages of a host that have a text (its hash) in a slot of the reference.

    Hosts without a reference of their own count under null. Slot -1 has their number of pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner()
        for whole in batches:
            counts: Counter = Counter()
            chars: dict[tuple, int] = {}
            for batch, texts in text_slices(whole, source):
                columns = (batch["__host"].to_pylist(), batch["__reference"].to_pylist(), texts.to_pylist())
                for host, reference, one in zip(*columns, strict=True):
                    host = host if reference is not None else None
                    page = parse(one)
                    slots = aligner.slots(page, shape_of(page), fallback if reference is None else reference)
                    own = {(host, slots[n], text_hash(t)): len(t) for n, t in page.blocks if n in slots and not page.nodes[n].other}
                    own[host, -1, 0] = 0
                    counts.update(own.keys())
                    chars.update(own)
            columns = [[k[0] for k in counts], [k[1] for k in counts], [k[2] for k in counts], list(counts.values()), [chars[k] for k in counts]]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["__host", "slot", "text", "n", "chars"])
        release()

    return pages.mapInArrow(run, "__host string, slot int, text bigint, n bigint, chars bigint")


def induce_wrappers(pages: DataFrame, source: str = "html") -> tuple[DataFrame, dict]:
    """(__host, __reference, __template, __slots, __weights) of each host with ``MIN_PAGES``, and one for all others.

    ``pages`` has ``__host``. ``__template`` are the hashes of template texts, of
    which a host has at most its pages' mean number of texts divided by
    ``TEMPLATE_SHARE``; ``__weights`` the varying characters of each of ``__slots``.
    """
    counted = materialize(_shapes(pages, source).groupBy("__host", "shape").agg(F.sum("n").alias("n")))
    large = counted.groupBy("__host").agg(F.sum("n").alias("pages")).filter((F.col("pages") >= MIN_PAGES) & (F.col("__host") != ""))
    most = F.max_by("shape", F.struct(F.col("n"), F.col("shape")))
    references = materialize(counted.join(large, "__host").groupBy("__host").agg(most.alias("__reference")))
    rest = counted.join(references, "__host", "left_anti").groupBy("shape").agg(F.sum("n").alias("n"))
    top = rest.agg(most.alias("shape")).first()["shape"] or '[""]'
    marked = bounded_join(pages, references, "__host", source, MAX_WRAPPERS)
    texts = _slot_texts(marked.select("__host", "__reference", source), source, top)
    summed = materialize(texts.groupBy("__host", "slot", "text").agg(F.sum("n").alias("n"), F.first("chars").alias("chars")))
    sizes = summed.filter("slot = -1").select(F.col("__host").alias("__of"), F.col("n").alias("pages"))
    sized = summed.filter("slot >= 0").join(sizes, F.col("__host").eqNullSafe(F.col("__of")))
    is_template = (F.col("n") >= TEMPLATE_PAGES) & (F.col("n") >= TEMPLATE_SHARE * F.col("pages"))
    slots = sized.groupBy("__host", "slot").agg(
        F.collect_set(F.when(is_template, F.col("text"))).alias("template"), F.sum(F.when(~is_template, F.col("chars") * F.col("n")).otherwise(0)).alias("weight")
    )
    wrappers = materialize(
        slots.groupBy("__host").agg(
            F.flatten(F.collect_list("template")).alias("__template"),
            F.collect_list("slot").alias("__slots"),
            F.collect_list("weight").alias("__weights"),
        )
    )
    found = wrappers.filter("__host IS NULL").first()
    shared = {"reference": top, "template": found["__template"] if found else [], "weights": dict(zip(found["__slots"], found["__weights"])) if found else {}}
    return materialize(references.join(wrappers, "__host", "left")), shared


class Extractor:
    """Applies wrappers to pages; a task remembers regions and alignments."""

    def __init__(self, shared: dict):
        self.shared = shared
        self.aligner = Aligner()
        self.regions: dict[tuple, int] = {}

    def text(self, source: str, wrapper: dict | None) -> str:
        page = parse(source)
        wrapper = wrapper or self.shared
        slots = self.aligner.slots(page, shape_of(page), wrapper["reference"])
        key = wrapper["reference"], tuple(sorted(wrapper["weights"].items()))
        if key not in self.regions:
            if len(self.regions) > REMEMBERED:
                self.regions.clear()
            self.regions[key] = content_region(reference_tree(json.loads(wrapper["reference"])), wrapper["weights"])
        region = next((n for n, slot in slots.items() if slot == self.regions[key]), None)
        if region is None:  # no place for the region: the page's own texts decide
            weights: Counter = Counter()
            for n, text in page.blocks:
                weights[n] += 0 if page.nodes[n].other else len(text)
            region = content_region(page, weights)
        inside = {region}
        for n, above in enumerate(page.parents):  # parents come first
            if above in inside:
                inside.add(n)
        blocks = [t for n, t in page.blocks if n in inside and not page.nodes[n].other]
        template = set(wrapper["template"])
        kept = [t for t in blocks if text_hash(t) not in template] if template else blocks
        # Where most of a page stands on most pages, these are copies of one article, not a template.
        if 2 * sum(map(len, kept)) < sum(map(len, blocks)):
            kept = blocks
        return "\n".join(kept)


def extract_text(pages: DataFrame, source: str = "html", url: str = "url") -> DataFrame:
    """Add text and n_chars (code points) to every row, instead of its HTML.

    Null and empty pages, and those without text in their region, have an empty
    text. Null URLs and those without a host share the wrapper of small hosts.
    Repeated rows are each extracted; an empty table gives an empty one. Columns
    of ``pages`` named like an added one are replaced; names with two leading
    underscores are the operator's own.
    """
    names = [c for c in pages.columns if c not in (source, "text", "n_chars")]
    schema = with_fields(pages.select(*names).schema, text="string", n_chars="bigint")
    hosted = pages.select(*names, F.col(source).alias("__source"), host_of(F.col(url)).alias("__host"))
    wrappers, shared = induce_wrappers(hosted.select("__host", "__source"), "__source")
    marked = bounded_join(hosted, wrappers, "__host", "__source", MAX_WRAPPERS)
    own = ("__reference", "__template", "__slots", "__weights")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(shared)
        for whole in batches:
            for batch, texts in text_slices(whole, "__source"):
                columns = [batch[c].to_pylist() for c in own]
                found = []
                for one, reference, template, slots, weights in zip(texts.to_pylist(), *columns, strict=True):
                    wrapper = {"reference": reference, "template": template or [], "weights": dict(zip(slots or [], weights or []))}
                    found.append(extractor.text(one, wrapper if reference is not None else None))
                new = [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), *new], names=[*names, "text", "n_chars"])
        release()

    return marked.select(*names, "__source", *own).mapInArrow(run, schema)
