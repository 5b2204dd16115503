"""Main text of HTML pages by site template removal.

Every block element's subtree is hashed in two ways: by its words, and by its shape, that is the tags, classes and ids of it and of the elements in it,
words and repetitions left out. Both are counted per host in Spark, once a document: pages of a host with the same main text are one document.
What recurs in at least ``LEAST_PAGES`` documents and ``LEAST_SHARE`` of a host's is its template and is deleted. A shape counts only for containers
beside a declared article or main element, as articles have shapes in common too. Nothing in an article element is template, and of a main element only
what recurs by its words on pages with an article, beside the articles and the headlines (h1). So copies of a page, under one url or many, don't make its
text a template; near copies do with what no article element holds, where their blocks differ and they are that many.

Of the rest, the page's own markup names what isn't main text: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments go by element, role, class or id, and where a page has an article or main element, what is still left outside goes.
That decides for hosts of few pages, and for what is outside the article or main element of a page that has one: there the template changes nothing,
so it decides within main elements and on pages without either.

Blocks are the texts between block elements, with character references decoded and white space made one space; they are joined by
an empty line. Null and empty html give an empty text. Pages without a host share the empty host. Repeated rows are extracted alike and
count as one document; pages without blocks count as none. Unclosed and stray tags are tolerated, as browsers do; a tag ends at the next ``<`` outside
quotes if it has no end. Parsing takes time in proportion to the page, however long. Templates are sets, so ties don't matter. Other columns of the table
are not read and may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, share
from .url_filter import host_of

LEAST_PAGES = 4
LEAST_SHARE = 0.05  # at most 1 / LEAST_SHARE template subtrees share each place of a document: so long is a host's list
BROADCAST_SUBTREES = 200_000  # of 8 bytes and a host's name each; beyond, templates are joined to pages
SALTS = 32  # parts of a host's pages in that join
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?>[^<>"']++|"[^"]*+"|'[^']*+'|["'])*+)>?|<[!?][^>]*(?:>|\Z)|([^<]+|<)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+|[0-9]+")
LETTERS = re.compile(r"[a-z]+")
# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object".split())
DROPPED = RAW | frozenset("head nav footer aside form button select option input dialog menu canvas audio video figure".split()) - {"figure"}
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = BLOCK - frozenset("p h1 h2 h3 h4 h5 h6 li dd dt pre td th tr tbody thead tfoot html body article main".split())
CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body article main section div table ul ol dl td th blockquote".split())
#: Words of class and id names, and roles, of what isn't main text.
NAMES = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())


def _declared_off(attributes: str) -> bool:
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if value.strip() in ROLES:
                return True
        elif not NAMES.isdisjoint(WORD.findall(value)):
            return True
    return False


MASK, PRIME = (1 << 64) - 1, 0x9E3779B97F4A7C15


def _hash(*parts: object) -> int:
    """A hash that 64-bit integer columns can hold."""
    return xxhash.xxh64_intdigest("\0".join(map(str, parts))) - (1 << 63)


def _names(tag: str, attributes: str) -> tuple[bool, str]:
    """Whether a tag's role, class or id says that it isn't main text, and what counts of it in a shape: numbers don't."""
    off, names = False, [tag]
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            off = off or value.strip() in ROLES
        else:
            off = off or not NAMES.isdisjoint(WORD.findall(value))
        names += sorted(LETTERS.findall(value))
    return off, " ".join(names)


class _Open:
    """An open element. ``off`` says that it isn't main text, ``block_off`` that of its innermost block; ``hidden`` text is in neither."""

    __slots__ = ("article", "block_off", "blocks", "first", "hidden", "names", "off", "shapes", "tag", "within")

    def __init__(self, tag: str, names: str, off: bool, within: bool, first: int, blocks: int, above: _Open | None = None):
        self.tag, self.names, self.off, self.within, self.first, self.blocks, self.shapes = tag, names, off, within, first, blocks, set()
        self.article = above is not None and (above.article or tag == "article" and not off)
        inline = above is not None and tag not in BLOCK
        self.block_off = above.block_off if inline else off
        self.hidden = inline and (above.hidden or off and not above.off)


class Page:
    """Blocks of a page, and the hashed subtrees as ranges of blocks.

    ``blocks``: (text, whether the markup declares it as something else, whether it is in an article or main element).
    ``subtrees``: (hash of the words, hash of the shape or None, first block, one beyond the last) of block elements outside articles; in a main
    element without the shape, and only on pages with an article, which they don't hold.
    """

    def __init__(self, page: str | None):
        self.blocks: list[tuple[str, bool, bool]] = []
        self.subtrees: list[tuple[int, int | None, int, int]] = []
        self.main = self.article = False
        self.kept: list[int] = []  # blocks in articles and headlines
        self.inner: list[bool] = []  # which subtrees are in a main element
        self.stack = [_Open("", "", False, False, 0, 0)]
        self.places: dict[str, list[int]] = defaultdict(list)  # of each tag's open elements in the stack
        self.open_blocks = 0
        self.text: list[str] = []
        self.sums, self.powers = [0], [1]
        if page:
            self._parse(page)
        mains = [i for i, b in enumerate(self.blocks) if b[2]]
        if self.main:  # what holds the article is no template, whatever its shape
            beside = lambda low, high: bisect_right(mains, high - 1) == bisect_right(mains, low - 1)
            keeps = lambda low, high: bisect_right(self.kept, high - 1) > bisect_right(self.kept, low - 1)
            self.subtrees = [x for x, within in zip(self.subtrees, self.inner, strict=True) if (self.article and not keeps(x[2], x[3]) if within else beside(x[2], x[3]))]
        else:
            self.subtrees = [(words, None, low, high) for words, _, low, high in self.subtrees]

    def _flush(self) -> None:
        block = " ".join(html.unescape("".join(self.text)).split())
        self.text.clear()
        if block:
            top = self.stack[-1]
            if top.article or self.places["h1"]:
                self.kept.append(len(self.blocks))
            self.blocks.append((block, top.block_off, top.within))
            self.sums.append((self.sums[-1] * PRIME + xxhash.xxh64_intdigest(block)) & MASK)
            self.powers.append(self.powers[-1] * PRIME & MASK)

    def _close(self) -> None:
        node = self.stack[-1]
        if node.tag in BLOCK:
            self._flush()
        self.stack.pop()
        self.places[node.tag].pop()
        above = self.stack[-1]
        if node.tag not in BLOCK:
            more, less = sorted((above.shapes, node.shapes), key=len, reverse=True)
            more |= less
            above.shapes = more
            return
        self.open_blocks -= 1
        shape = _hash("shape", node.names, *sorted(node.shapes))
        above.shapes.add(shape)
        low, high = node.first, len(self.blocks)
        if low < high and not node.article and node.tag not in ("html", "body", "article", "main"):
            self.inner.append(node.within)
            words = (self.sums[high] - self.sums[low] * self.powers[high - low]) & MASK
            self.subtrees.append((_hash("words", node.names, words), shape if node.tag in CONTAINER and not node.within else None, low, high))

    def _close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self._close()

    def _nearest(self, tags: frozenset[str] | set[str]) -> int:
        """Place in the stack of the innermost open element of these tags; 0 without any."""
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def _parse(self, page: str) -> None:
        pos, size = 0, len(page)
        while pos < size:
            token = TOKEN.match(page, pos)
            end, tag, attributes, chars = token.groups()
            pos = token.end()
            if chars is not None:
                if not self.stack[-1].hidden:
                    self.text.append(chars)
                continue
            if tag is None:
                continue
            tag = tag.lower()
            if end:
                depth = self._nearest({tag})
                if depth and (tag in BLOCK or tag in DROPPED or self.open_blocks == self.stack[depth].blocks):
                    self._close_to(depth)
                continue
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
                pos = stop.end() if stop else size
                continue
            if tag in VOID:
                if tag in ("br", "wbr"):
                    self.text.append(" " if tag == "br" else "")
                elif tag == "hr":
                    self._flush()
                continue
            if tag in BLOCK:
                self._flush()
                if (at := self._nearest({"p"} | CLOSED_BY.get(tag, set()))) > self._nearest(SCOPE - CLOSED_BY.get(tag, set())):
                    self._close_to(at)
            top = self.stack[-1]
            declared, names = _names(tag, attributes)
            off = top.off or tag in DROPPED or (tag == "article" and bool(self.places["article"])) or (tag == "header" and not top.within) or declared and tag not in ("html", "body", "article", "main")
            if not off and tag in ("article", "main"):
                self.main = True
                self.article = self.article or tag == "article"
            if not attributes.rstrip().endswith("/") or tag in BLOCK:
                self.open_blocks += tag in BLOCK
                self.places[tag].append(len(self.stack))
                self.stack.append(_Open(tag, names, off, top.within or (not off and tag in ("article", "main")), len(self.blocks), self.open_blocks, top))
        self._flush()
        self._close_to(1)

    def main_blocks(self, template: set[int] | frozenset[int] = frozenset()) -> list[str]:
        """Blocks that neither the template nor the page's own markup takes away."""
        gone = [0] * (len(self.blocks) + 1)
        if template:
            for words, shape, low, high in self.subtrees:
                if words in template or shape in template:
                    gone[low] += 1
                    gone[high] -= 1
        out, inside = [], 0
        for (text, off, within), change in zip(self.blocks, gone, strict=False):
            inside += change
            if not inside and not off and (within or not self.main):
                out.append(text)
        return out


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, documents, subtrees = [], [], []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parsed = Page(page)
            if text := parsed.main_blocks():
                hosts.append(host)
                documents.append(_hash(*text))
                subtrees.append(sorted({h for words, shape, _, _ in parsed.subtrees for h in (words, shape) if h is not None}))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(documents, pa.int64()), pa.array(subtrees, pa.list_(pa.int64()))], names=["host", "document", "subtrees"])


def templates(hosted: DataFrame) -> DataFrame:
    """(host, subtree) of the hashes that recur on each host, from (host, html)."""
    documents = hosted.select("host", "html").mapInArrow(_documents, "host string, document long, subtrees array<long>")
    documents = documents.groupBy("host", "document").agg(F.min("subtrees").alias("subtrees"))
    # A host's documents are counted as the subtree null; `named` tells it apart above the exchange, so that both sides of the join share one.
    each = documents.select("host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "subtrees")).alias("subtree"))
    counts = each.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"), F.count("subtree").alias("named")).where(F.col("n") >= LEAST_PAGES)
    hosts = counts.where("named = 0").select("host", F.col("n").alias("documents"))
    return counts.where("named > 0").join(hosts, "host").where(F.col("n") >= LEAST_SHARE * F.col("documents")).select("host", "subtree")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages (page_id, url, html)."""
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession)
    hosted = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), "html")
    found = scratch.save(templates(hosted))
    few = found.count() <= BROADCAST_SUBTREES
    if few:
        sets = defaultdict(set)
        for r in found.collect():
            sets[r.host].add(r.subtree)
        shared, source = share(spark, dict(sets)), hosted.withColumn("template", F.lit(None).cast("array<long>"))
        scratch.drop(found)
    else:  # a hot host's pages are dealt to SALTS parts, and its template to each
        lists = found.groupBy("host").agg(F.collect_list("subtree").alias("template"))
        salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        shared, source = dict, hosted.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared()
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = []
                for host, page, template in zip(*(part.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                    texts.append("\n\n".join(Page(page).main_blocks(set(template) if template else known.get(host, frozenset()))))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return source.select("page_id", "url", "host", "html", "template").mapInArrow(run, "page_id long, url string, text string, n_chars long")
