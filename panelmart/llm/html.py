"""Main text of web pages by removing site templates.

Each page is parsed once, by its elements' subtrees.  Spark counts how many
different pages of a host hold each subtree (by a hash of its tags and
text), and the subtrees on at least ``MIN_PAGES`` and ``SHARE`` of them are
deleted, wherever they are: menus, notices, footers and adverts that a site
repeats, but not a heading or table cell that some of its pages have.  Versions of one URL
and near copies of a text (by MinHash of its word shingles) are one page, so
that they keep the paragraphs they share.  What markup itself names as no
article (scripts, navigation, forms, comments) goes on every page, since
counts can't find what differs from page to page or a host with one page.
If article or main elements hold at least ``INSIDE`` of the words that are
left, they are the text, with the headings and paragraphs that lead up to the
first of them; else all that is left is.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import bit_distance, cut_lineage, prepare, shingle_hashes, words
from panelmart.llm.components import components
from panelmart.llm.minhash import ROWS, SAMPLES, SKETCH_WORDS, Sketcher, bands_for, sketch_limit

#: A subtree on this many different pages of a host, and on this share of all
#: of them, is part of its template.
MIN_PAGES = 5
SHARE = 0.1
#: Hashes of deleted subtrees that are broadcast at most (8 bytes each); more
#: are joined with the pages by a shuffle.
BROADCAST_HASHES = 1_000_000
SALTS = 16
#: Pages of a host count as one if their texts' shingles agree to this percentage.
SIMILAR = 80
SHINGLE = 5
#: Chance that two pages at just that share no band.
MISSED = 1e-3
#: Article and main elements are the text if they hold this share of the words left.
INSIDE = 0.5

# Fixed values of HTML: kinds of elements by name.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
#: Elements that are no part of an article, and classes, ids and roles (whole
#: ones, not parts of them) that say the same of any element.
OUTSIDE = frozenset(
    "nav header footer aside form button select option script style textarea title noscript iframe "
    "noembed noframes xmp template head menu dialog".split())
NAMED = re.compile(
    r"ads?|adverts?|advertisements?|advertising|adsense|(?:ad|ads|advert)[_-](?:box|slot|unit|banner|container|wrapper)|"
    r"sponsor(?:ed|s)?|promos?|promotions?|banner|(?:cookie|cookies|consent|gdpr)(?:[_-](?:bar|banner|notice|consent|"
    r"popup|message))?|notices?|popup|modal|(?:(?:main|site|top|sub|page|primary|secondary|footer|header)[_-]?)?"
    r"(?:nav|navbar|navigation|menu)|(?:nav|menu)[_-](?:bar|links?|menu|list|container|wrapper)|breadcrumbs?|"
    r"(?:(?:left|right|primary|secondary|site|page)[_-]?)?sidebar|sidebar[_-](?:left|right|primary|secondary)|side|"
    r"(?:(?:site|page|global|main)[_-]?)?(?:header|footer)|masthead|comments?|comments?[_-]?(?:list|section|area|form|"
    r"thread)|disqus(?:_thread)?|replies|respond|share|sharing|(?:share|sharing|social)[_-](?:buttons?|links?|bar|icons?|"
    r"media)|social|related(?:[_-](?:posts?|articles?|links?|content))?|recommended|newsletter(?:[_-](?:signup|form|box))?|"
    r"subscribe|subscription|signup|login(?:[_-]form)?|search(?:[_-]?(?:form|box|bar))?|widgets?|widget[_-]area|toolbar|"
    r"pagination|pager|complementary|contentinfo|alert|dialog", re.I)
#: Elements whose tag says less than its text may.
GUARDED = frozenset(["form", "header"])
#: What is named as no article stays if it holds at least so many of the words
#: left, and more than this share of them.
SPARED, MOSTLY = 25, 0.5
#: Elements that lead up to an article that they stand beside.
LEAD = frozenset("h1 h2 h3 h4 h5 h6 p".split())
#: An opening tag of these ends an open paragraph; of these, an open one of the same kind.
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table body article section div select main".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
#: A word, or a letter of a script without blanks.
_WORD = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]|[^\W\u3040-\u30ff\u3400-\u9fff]+")


def _outside(name: str, attributes: str, article: bool) -> str:
    """Why the markup says that the element is no part of an article: "tag",
    or "named", which its text can outweigh; else empty.  A header in an
    article is part of it."""
    if name in OUTSIDE and not (article and name == "header"):
        return "named" if name in GUARDED else "tag"
    if attributes and name not in ("body", "html", "article", "main"):
        for _, value in _ATTRIBUTE.findall(attributes):
            if any(NAMED.fullmatch(x) and not (article and x.lower() == "header") for x in value.strip("\"'").split()):
                return "named"
    return ""


class Page:
    """Blocks of a page's text, each in its innermost element.

    An element's hash is of its name, its blocks' texts and its children's
    hashes.  Text in inline elements that are no part of an article is left
    out of the block around them, which goes on behind them.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int, bool]] = []  # text, innermost element (-1: none), in an article
        self.names: list[str] = []      # of all block elements, in page order
        self.parents: list[int] = []    # -1: none
        self.named: set[int] = set()    # those named as no part of an article
        self.hashes: list[int] = []
        self._parts: list[str] = []
        self._open: list[int] = []
        self._state: list[tuple[bool, bool, bool]] = []  # dropped, in an article, muted
        self._hash: list[xxhash.xxh3_64] = []
        self._count: Counter[str] = Counter()
        self._read(source)
        while self._open:
            self._pop()

    def _flush(self) -> None:
        dropped, article, muted = self._state[-1] if self._state else (False, False, False)
        if muted:
            return
        text = " ".join(entities.unescape("".join(self._parts)).split())
        self._parts = []
        if text and not dropped:
            self.blocks.append((text, self._open[-1] if self._open else -1, article))
            if self._hash:
                self._hash[-1].update(text.encode("utf-8", "surrogatepass") + b"\n")

    def _text(self, text: str) -> None:
        if not (self._state and self._state[-1][2]):
            self._parts.append(text)

    def _push(self, name: str, why: str, mute: bool) -> None:
        above = self._state[-1] if self._state else (False, False, False)
        self.names.append(name)
        self.hashes.append(0)
        self.parents.append(self._open[-1] if self._open else -1)
        self._open.append(len(self.names) - 1)
        if why == "named" and not mute:
            self.named.add(len(self.names) - 1)
        self._state.append((why == "tag" or above[0], above[1] or name in ("article", "main"), mute or above[2]))
        self._hash.append(xxhash.xxh3_64(name.encode("utf-8", "surrogatepass")))
        self._count[name] += 1

    def _pop(self) -> None:
        e, h = self._open.pop(), self._hash.pop()
        self._state.pop()
        self._count[self.names[e]] -= 1
        self.hashes[e] = h.intdigest() - (1 << 63)
        if self._hash:
            self._hash[-1].update(h.digest())

    def _close(self, names: set[str] | frozenset[str], scopes: frozenset[str] = frozenset()) -> None:
        """Close the innermost open element of ``names`` with what is in it."""
        if not any(self._count[x] for x in names):
            return
        for i in range(len(self._open) - 1, -1, -1):
            name = self.names[self._open[i]]
            if name in names:
                self._flush()
                while len(self._open) > i:
                    self._pop()
                return
            if name in scopes:
                return

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            tag = _TAG.search(source, at)
            if tag is None:
                self._text(source[at:])
                break
            self._text(source[at:tag.start()])
            at = tag.end()
            name = (tag[2] or tag[5] or "").lower()
            closing = bool(tag[1] or tag[4])
            attributes = tag[3] or tag[6] or ""
            if not name:
                continue  # a comment or a declaration
            if name in RAW and not closing:
                stop = re.compile(f"</{re.escape(name)}", re.I).search(source, at)
                at = end if stop is None else stop.start()
                if stop is not None and (gt := source.find(">", at)) >= 0:
                    at = gt + 1
                elif stop is not None:
                    at = end
                continue
            if name == "br":
                self._text(" ")
                continue
            block = name in BLOCKS
            if closing:
                if self._count[name]:
                    self._close({name})
                continue
            why = _outside(name, attributes, bool(self._state) and self._state[-1][1])
            if block or why:
                if name in BLOCKS and name not in ("html", "body"):
                    self._close({"p"}, SCOPES - {"div", "section"})
                if name in SAME:
                    self._close(SAME[name], SCOPES)
                if block:
                    self._flush()
                if name not in VOID:
                    self._push(name, why, not block)
        self._flush()

    def _leads(self) -> set[int]:
        """Headings and paragraphs beside an article, or beside what holds it,
        that come before the first one."""
        held = set()
        for _, e, _ in self.blocks:
            while e >= 0 and e not in held:
                held.add(e)
                e = self.parents[e]
        first = next((e for e in sorted(held) if self.names[e] in ("article", "main")), None)
        if first is None:
            return set()
        around, e = {-1}, self.parents[first]
        while e >= 0:
            around.add(e)
            e = self.parents[e]
        return {e for e in held if e < first and self.names[e] in LEAD and self.parents[e] in around}

    def result(self, gone: frozenset[int] = frozenset(), **options: float) -> tuple[list[str], list[dict], dict[str, list]]:
        """Texts of the blocks that ``choose`` takes, all blocks, and the
        elements that hold them: their parents, hashes and whether they are
        named as no article."""
        held, leads = set(), self._leads()
        for _, e, _ in self.blocks:
            while e >= 0 and e not in held:
                held.add(e)
                e = self.parents[e]
        order = sorted(e for e in held if self.names[e] not in ("html", "body"))
        number = {e: i for i, e in enumerate(order)}
        elements = {"parents": [number.get(self.parents[e], -1) for e in order], "hashes": [self.hashes[e] for e in order],
                    "named": [e in self.named for e in order]}
        blocks: list[dict] = [{"text": text, "at": number.get(e, -1), "article": article, "lead": not article and e in leads}
                              for text, e, article in self.blocks]
        taken = choose(blocks, elements, gone, **options)
        for b in blocks:
            b["taken"] = False
        for b in taken:
            b["taken"] = True
        return [b["text"] for b in taken], blocks, elements


def choose(blocks: list[dict], elements: dict[str, list], gone: frozenset[int] = frozenset(), spared: int = SPARED,
           mostly: float = MOSTLY, inside: float = INSIDE) -> list[dict]:
    """The blocks that are in no subtree of ``gone``, and in no element named
    as no article unless that holds at least ``spared`` words and more than
    ``mostly`` of those left; only those in article or main elements and what
    leads up to them, if the elements hold ``inside`` of the words.

    An element comes after its parent, so one walk each way over them does."""
    parents, hashes, named = elements["parents"], elements["hashes"], elements["named"]

    def without(out: list[bool], have: list[dict]) -> list[dict]:
        for i, p in enumerate(parents):
            out[i] = out[i] or (p >= 0 and out[p])
        return [b for b in have if b["at"] < 0 or not out[b["at"]]]

    left = without([h in gone for h in hashes], blocks)
    size = {id(b): sum(1 for _ in _WORD.finditer(b["text"])) for b in left}
    total, words_in = sum(size.values()), [0] * len(parents)
    for b in left:
        if b["at"] >= 0:
            words_in[b["at"]] += size[id(b)]
    for i in range(len(parents) - 1, -1, -1):
        if parents[i] >= 0:
            words_in[parents[i]] += words_in[i]
    left = without([x and not (words_in[i] >= spared and words_in[i] > mostly * total) for i, x in enumerate(named)], left)
    article = sum(size[id(b)] for b in left if b["article"])
    if article and article >= inside * sum(size[id(b)] for b in left):
        left = [b for b in left if b["article"] or b["lead"]]
    return left


BLOCK = "struct<text:string,at:int,article:boolean,lead:boolean,taken:boolean>"
_BLOCK = pa.struct([("text", pa.string()), ("at", pa.int32()), ("article", pa.bool_()), ("lead", pa.bool_()), ("taken", pa.bool_())])


def parse(pages: DataFrame, **options: float) -> DataFrame:
    """page_id, url, host and address (hashes; the address without fragment),
    node (hash of host and text), bands and sketch (of the text's shingles;
    null without words), the elements' parents, hashes and named, and blocks.
    One pass over the pages; what is counted and compared is in columns of
    its own, which are read without the texts."""
    n_bands = _bands()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(n_bands, ROWS, SAMPLES, SKETCH_WORDS)
        longs = pa.list_(pa.int64())
        for batch in batches:
            cols: dict[str, list] = {c: [] for c in ("node", "bands", "sketch", "parents", "hashes", "named", "blocks")}
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                texts, blocks, elements = Page(source.as_py() or "").result(**options)
                tokens = words("\n".join(texts))
                a, b = sketcher.sketch(shingle_hashes(tokens, SHINGLE)) if tokens else (None, None)
                whole = f"{host}\n" + "\n".join(texts)
                row = {"node": xxhash.xxh3_64_intdigest(whole.encode("utf-8", "surrogatepass")) - (1 << 63),
                       "bands": a, "sketch": b, "blocks": blocks, **elements}
                for c, v in row.items():
                    cols[c].append(v)
            kinds = {"node": pa.int64(), "bands": longs, "sketch": longs, "parents": pa.list_(pa.int32()), "hashes": longs,
                     "named": pa.list_(pa.bool_()), "blocks": pa.list_(_BLOCK)}
            yield pa.record_batch([*(batch.column(c) for c in ("page_id", "url", "host", "address")),
                                   *(pa.array(cols[c], k) for c, k in kinds.items())],
                                  names=["page_id", "url", "host", "address", *kinds])

    prepare(pages.sparkSession)
    host = F.lower(F.regexp_extract("url", r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    address = F.when(F.col("url").isNotNull(), F.xxhash64(F.regexp_replace("url", "#.*$", "")))
    return pages.select("page_id", "url", F.xxhash64(F.coalesce(host, F.lit(""))).alias("host"),
                        address.alias("address"), "html").mapInArrow(
        run, "page_id long, url string, host long, address long, node long, bands array<long>, sketch array<long>, "
        f"parents array<int>, hashes array<long>, named array<boolean>, blocks array<{BLOCK}>")


def _bands() -> int:
    return bands_for(SIMILAR / 100, missed=MISSED)


def text_of(blocks: str = "blocks") -> Column:
    """The text of a page that nothing is gone from."""
    return F.array_join(F.transform(F.filter(blocks, lambda b: b["taken"]), lambda b: b["text"]), "\n")


def same_pages(parsed: DataFrame) -> DataFrame:
    """id and component of the nodes that are one page with others of their
    host: by near the same text, or by one address."""
    n_bands = _bands()
    limit = sketch_limit(SIMILAR / 100, max(SAMPLES, n_bands * ROWS), 64 * SKETCH_WORDS)
    signed = parsed.select("host", "node", "bands", "sketch").where("bands is not null")
    keyed = signed.select("node", F.explode("bands").alias("key"), "host").select(
        "node", F.xxhash64("host", "key").alias("key"))
    # each with the first of its key; a page's rows of one text are one node
    first = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where(
        "first < last").select("key", "first")
    pairs = keyed.join(first, "key").where("node != first").select("node", "first").distinct()
    of = signed.groupBy("node").agg(F.first("sketch").alias("sketch"))
    far = bit_distance(F.col("sa"), F.col("sb"), SKETCH_WORDS)
    near = (pairs.join(of.select("node", F.col("sketch").alias("sa")), "node")
            .join(of.select(F.col("node").alias("first"), F.col("sketch").alias("sb")), "first")
            .where(far <= limit).select(F.col("node").alias("a"), F.col("first").alias("b")))
    at = parsed.where("address is not null").select("host", "address", "node")
    first = at.groupBy("host", "address").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b < last")
    versions = at.join(first, ["host", "address"]).where("node != b").select(F.col("node").alias("a"), "b").distinct()
    return components(cut_lineage(near.unionByName(versions), "links"))


def templates(parsed: DataFrame, min_pages: int, share: float) -> DataFrame:
    """host and gone: the subtrees on at least ``min_pages`` and ``share`` of
    a host's different pages.  A host has at most 1 / share times as many as
    one of its pages.

    Each page's subtrees are counted once for its label, by two steps of
    partial sums: a subtree that is on most pages of a large host is a row a
    task, never a task's rows."""
    same = same_pages(parsed)
    label = F.coalesce("component", "node").alias("label")
    pages = (parsed.select("host", "node").distinct().join(same, F.col("node") == same["id"], "left")
             .select("host", label).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages")))
    held = (parsed.select("host", "node", "hashes").join(same, F.col("node") == same["id"], "left")
            .select("host", label, F.explode(F.array_distinct("hashes")).alias("subtree")).distinct())
    counts = held.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    return (counts.join(pages, "host").where(F.col("n") >= share * F.col("pages"))
            .groupBy("host").agg(F.collect_set("subtree").alias("gone")))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE, spared: int = SPARED,
            mostly: float = MOSTLY, inside: float = INSIDE) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row.

    Reads page_id, url and html.  A null or empty html gives the empty text; a
    page without a host (null or relative url) counts with others of none.
    Copies, near copies and versions of one url count once, so they make no
    template.  Repeated rows each give a row.  The numbers are described at
    ``templates`` and ``choose``.
    """
    options = {"spared": spared, "mostly": mostly, "inside": inside}
    parsed = cut_lineage(parse(pages.select(F.col("page_id").cast("long"), "url", "html"), **options), "pages", "zstd")
    here = cut_lineage(templates(parsed, min_pages, share), "templates")
    hashes = here.agg(F.sum(F.size("gone"))).first()[0] or 0
    if hashes <= BROADCAST_HASHES:
        out = parsed.join(F.broadcast(here), "host", "left")
    else:  # a hot host's pages are dealt to ``SALTS`` copies of its row
        salted = here.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = parsed.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    out = out.withColumn("cut", F.array_intersect("hashes", "gone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for blocks, parents, found, named, cut in zip(*(batch.column(c) for c in (
                    "blocks", "parents", "hashes", "named", "cut")), strict=True):
                elements = {"parents": parents.as_py(), "hashes": found.as_py(), "named": named.as_py()}
                taken = choose(blocks.as_py(), elements, frozenset(cut.as_py()), **options)
                texts.append("\n".join(b["text"] for b in taken))
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                  names=["page_id", "url", "text"])

    cleaned = out.where("size(cut) > 0").select("page_id", "url", "blocks", "parents", "hashes", "named", "cut").mapInArrow(
        run, "page_id long, url string, text string")
    out = out.where("cut is null or size(cut) = 0").select("page_id", "url", text_of().alias("text")).unionByName(cleaned)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
