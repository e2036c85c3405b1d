"""Ranked lexical search over document FP-trees.

A document is reduced to the terms that the items use, most frequent term
first.  A task lays the documents of a block into a trie of these vectors, so
that documents with the same frequent terms share a path.  Each subtree knows
the largest tf of each of its terms and its smallest m; both give an upper
bound of an item's score in the subtree.  The trie is searched depth first
and best child first; an item leaves a subtree whose bound can't reach its
k best so far.  A window merges the tasks' k best of each item.  Scores are
whole numbers and the bounds are exact, so that the result is too.
"""

from __future__ import annotations

import bisect
import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelmart.llm.common import cut_lineage, prepare

K = 20
#: Items searched in one pass over the documents, and bytes of their texts.
ITEMS, ITEM_BYTES = 2048, 16_000_000
#: Documents and terms of a trie; documents of a leaf.
BLOCK, POSTINGS, LEAF = 8192, 2_000_000, 32
#: Bytes of text split at a time.
SLICE = 4_000_000

#: Bytes outside terms become blanks, A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_NULL = np.iinfo(np.int64).max  # stands for a null doc_id, which sorts last


def terms(text: str | None) -> Counter:
    """Terms of a whole text, as UTF-8, with their numbers of occurrences."""
    out: Counter = Counter()
    raw = text.encode().translate(_FOLD) if text else b""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + SLICE)
        end = len(raw) if end < 0 else end
        out.update(raw[at:end].split())
        at = end
    return out


def vectors(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """doc_id, n (all terms, with repeats), and the numbers and tf of those
    terms that are in ``words``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(words)}
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column(1):
                have = terms(text.as_py())
                some = list(have.keys() & number.keys())
                n.append(have.total())
                ids.append([number[w] for w in some])
                tfs.append([have[w] for w in some])
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), *(pa.array(x, pa.list_(pa.int32())) for x in (ids, tfs))],
                                  schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


@dataclass
class Items:
    """Items as ragged arrays of term ranks (0: in most documents)."""

    ids: list
    weight: np.ndarray          # w of each rank
    rank: np.ndarray            # rank of each of ``words``
    flat: np.ndarray            # ranks of the items' terms, item after item
    times: np.ndarray           # how often the item has the term
    starts: np.ndarray          # where an item's terms begin
    sizes: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.sizes = np.diff(np.append(self.starts, len(self.flat)))

    def part(self, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """flat, times and starts of some of the items."""
        if len(alive) == len(self.ids):
            return self.flat, self.times, self.starts
        size = self.sizes[alive]
        starts = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(self.starts[alive] - starts, size)
        return self.flat[at], self.times[at], starts

    def gain(self, ranks: np.ndarray, tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
        """What one occurrence of a term in an item adds to the score."""
        return self.weight[ranks] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def ranked_items(rows: list[tuple[int, Counter]], words: list[bytes], df: dict[int, int], n_docs: int) -> Items:
    """Items with their terms' weights; terms that no document has add nothing."""
    order = sorted(range(len(words)), key=lambda i: (-df.get(i, 0), i))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in order], np.int64)
    number = {w: i for i, w in enumerate(words)}
    ids, flat, times, starts = [], [], [], []
    for item_id, have in rows:
        mine = sorted((int(rank[number[w]]), c) for w, c in have.items() if df.get(number[w], 0))
        if mine:
            ids.append(item_id)
            starts.append(len(flat))
            flat += [r for r, _ in mine]
            times += [c for _, c in mine]
    return Items(ids, weight, rank, *(np.array(x, np.int64) for x in (flat, times, starts)))


@dataclass
class Node:
    """A subtree: largest tf of each of its terms, smallest m and doc_id."""

    ranks: np.ndarray
    tf: np.ndarray
    m: int
    doc: int
    children: list[Node]
    entries: list[tuple]        # of a leaf: (ranks, tf, m, doc_ids)


def _widest(parts: list[tuple[np.ndarray, np.ndarray]], scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest tf of each term in the parts; ``scratch`` is zero and stays so."""
    for ranks, tf in parts:  # a part has each term once
        scratch[ranks] = np.maximum(scratch[ranks], tf)
    ranks = np.unique(np.concatenate([r for r, _ in parts]))
    tf = scratch[ranks]
    scratch[ranks] = 0
    return ranks, tf


def tree(entries: list[tuple], n_ranks: int, leaf: int = LEAF) -> Node:
    """Trie of entries (ranks ascending, tf, m, doc_ids) in path order."""
    shared = np.zeros(len(entries) + 1, np.int64)  # length of the path shared with the entry before
    for i in range(1, len(entries)):
        a, b = entries[i - 1][0], entries[i][0]
        n = min(len(a), len(b))
        differ = a[:n] != b[:n]
        shared[i] = differ.argmax() if differ.any() else n
    scratch = np.zeros(n_ranks, np.int64)
    # ranges of entries, parents before children
    ranges, kids = [(0, len(entries))], []
    for lo, hi in ranges:
        kids.append([])
        if hi - lo <= leaf:
            continue
        inner = shared[lo + 1:hi]
        cuts = [lo, *(np.flatnonzero(inner == inner.min()) + lo + 1).tolist(), hi]
        at = lo
        for i in range(1, len(cuts)):  # small neighbours share a leaf
            if i + 1 < len(cuts) and cuts[i + 1] - at <= leaf:
                continue
            kids[-1].append(len(ranges))
            ranges.append((at, cuts[i]))
            at = cuts[i]
    nodes: list[Node | None] = [None] * len(ranges)
    for i in reversed(range(len(ranges))):
        lo, hi = ranges[i]
        below = [nodes[j] for j in kids[i]]
        mine = [] if below else entries[lo:hi]
        ranks, tf = _widest([(n.ranks, n.tf) for n in below] or [(e[0], e[1]) for e in mine], scratch)
        nodes[i] = Node(ranks, tf, min([n.m for n in below] or [e[2] for e in mine]),
                        min([n.doc for n in below] or [e[3][0] for e in mine]), below, mine)
    return nodes[0]


class Search:
    """The k best documents of each item among those added."""

    def __init__(self, items: Items, k: int):
        self.items, self.k = items, k
        self.best: list[list[tuple[int, int]]] = [[] for _ in items.ids]  # (-score, doc_id), in order
        self.least = np.zeros(len(items.ids), np.int64)                   # k-th best score, or 0
        self.last = np.full(len(items.ids), -1 << 63, np.int64)           # and its doc_id
        self.looked = self.held = 0                                       # documents scored, documents met

    def _open(self, alive: np.ndarray, bound: np.ndarray, doc: int) -> np.ndarray:
        """Which bounds can still enter the k best."""
        return (bound > self.least[alive]) | ((bound == self.least[alive]) & (doc < self.last[alive]))

    def add(self, root: Node) -> None:
        """Depth-first branch and bound over one trie."""
        dense = np.zeros(len(self.items.weight), np.int64)

        def bounds(node: Node, alive: np.ndarray, flat: tuple) -> np.ndarray:
            terms_, times, starts = flat
            dense[node.ranks] = self.items.gain(node.ranks, node.tf, node.m)
            out = np.add.reduceat(dense[terms_] * times, starts)
            dense[node.ranks] = 0
            return out

        every = np.arange(len(self.items.ids))
        stack = [(root, every, bounds(root, every, self.items.part(every)))]
        while stack:
            node, alive, bound = stack.pop()
            alive = alive[self._open(alive, bound, node.doc)]
            if not len(alive):
                continue
            flat = self.items.part(alive)
            if not node.children:
                self._leaf(node, alive, flat)
                continue
            below = [(c, alive, bounds(c, alive, flat)) for c in node.children]
            below.sort(key=lambda x: int(x[2].sum()))  # the best one is popped first
            stack += below

    def _leaf(self, node: Node, alive: np.ndarray, flat: tuple) -> None:
        terms_, times, starts = flat
        dense = np.zeros((len(node.entries), len(self.items.weight)), np.int64)
        for i, (ranks, tf, m, _) in enumerate(node.entries):
            dense[i, ranks] = self.items.gain(ranks, tf, m)
        score = np.add.reduceat(dense[:, terms_] * times, starts, axis=1)
        self.looked += len(node.entries) * len(alive)
        first = np.array([e[3][0] for e in node.entries])
        good = (score > self.least[alive]) | ((score == self.least[alive]) & (first[:, None] < self.last[alive]))
        for j in np.flatnonzero(good.any(axis=0)):
            item, best = alive[j], self.best[alive[j]]
            for i in np.flatnonzero(good[:, j]):
                for doc in node.entries[i][3]:
                    hit = (-int(score[i, j]), doc)
                    if len(best) == self.k and hit >= best[-1]:
                        break
                    bisect.insort(best, hit)
                    del best[self.k:]
            if len(best) == self.k:
                self.least[item], self.last[item] = -best[-1][0], best[-1][1]


def entries_of(doc_ids: np.ndarray, ms: list[int], owner: np.ndarray, ranks: np.ndarray, tfs: np.ndarray, k: int) -> list[tuple]:
    """Entries of a block in path order.  Documents with the same vector and m
    score alike, so that one entry stands for them with its k first doc_ids."""
    order = np.lexsort((ranks, owner))
    ranks, tfs = ranks[order], tfs[order]
    ends = np.cumsum(np.bincount(owner, minlength=len(doc_ids)))
    wide = ranks.astype(">u4")
    rows = []
    for i, (doc, m, hi) in enumerate(zip(doc_ids.tolist(), ms, ends.tolist(), strict=True)):
        lo = int(ends[i - 1]) if i else 0
        rows.append((wide[lo:hi].tobytes(), tfs[lo:hi].tobytes(), m, doc, lo, hi))
    rows.sort()
    out, last = [], None
    for path, tf, m, doc, lo, hi in rows:
        if last == (path, tf, m):
            if len(out[-1][3]) < k:
                out[-1][3].append(doc)
            continue
        last = (path, tf, m)
        out.append((ranks[lo:hi], tfs[lo:hi], m, [doc]))
    return out


def _pass(stored: DataFrame, rows: list[tuple[int, Counter]], words: list[bytes], k: int) -> DataFrame:
    """Hits of one block of items: item (its place in the block), item_id,
    doc_id, score: at most k of each item and task."""
    n_docs, total = stored.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(stored.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row per term of the items
    items = ranked_items(rows, words, df, n_docs)
    block, postings, leaf = BLOCK, POSTINGS, LEAF
    schema = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items, k)
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            lists, tfs = batch.column("terms"), batch.column("tfs")
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            docs = batch.column("doc_id").fill_null(_NULL).to_numpy()
            ms = [75 + 25 * n * n_docs // total for n in batch.column("n").to_pylist()]
            entries = entries_of(docs, ms, owner, items.rank[lists.flatten().to_numpy()],
                                 tfs.flatten().to_numpy().astype(np.int64), k)
            search.held += len(docs) * len(items.ids)
            search.add(tree(entries, len(words), leaf))

        if items.ids:
            for batch in batches:
                at = 0
                while at < batch.num_rows:
                    room = block - sum(b.num_rows for b in held)
                    piece = batch.slice(at, room)
                    held.append(piece)
                    at += piece.num_rows
                    if piece.num_rows == room or sum(len(b.column("terms").flatten()) for b in held) >= postings:
                        flush()
            if held:
                flush()
        found = [(i, items.ids[i], None if doc == _NULL else doc, -score)
                 for i, best in enumerate(search.best) for score, doc in best]
        cols = list(zip(*found, strict=True)) or [()] * 4
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return stored.where("size(terms) > 0").mapInArrow(run, "item int, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents with the
    highest scores above 0 for each item, equal scores by doc_id.

    ``docs`` has doc_id and text, ``items`` has item_id and text; other
    columns are not read.  A term is a maximal run of ASCII letters, digits
    and non-ASCII characters, with A-Z lower-cased.  Null and empty texts
    have no terms: such documents are found by no item, such items find none.
    Every row of ``docs`` is a document, repeated rows are found repeatedly,
    and a null doc_id comes after all others.  Rows of ``items`` that repeat
    item_id and text are one item; each further text of an item_id is an item
    of its own, ranked apart.  Empty tables: no rows.

    The items are searched a block after another; a block holds about
    ``ITEMS`` items and ``ITEM_BYTES`` of text, and goes to all tasks.
    """
    spark = docs.sparkSession
    prepare(spark)
    asked = items.where("text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    asked = cut_lineage(asked, "items")
    n, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // ITEMS), -(-size // ITEM_BYTES))
    hits = []
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = sorted(((r.item_id, terms(r.text)) for r in mine.collect()),
                      key=lambda x: (x[0] is None, x[0] or 0, sorted(x[1].items())))
        words = sorted(set().union(*(have for _, have in rows)))
        stored = cut_lineage(vectors(docs, words), "vectors")
        hits.append(_pass(stored, rows, words, k).withColumn("block", F.lit(b)))
    found = functools.reduce(DataFrame.unionByName, hits)
    order = W.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
