"""Token counts by rank-synchronous merging of ragged arrays.

The pre-tokens of a batch that were not met before are laid end to end in
one array.  In each round every sequence finds its lowest-ranked pair and
merges all its occurrences at once, until no sequence has a pair that
merges; the surviving symbols are counted.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import prepare

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Counts a worker remembers before it starts afresh: bounds its memory.
REMEMBERED = 600_000
#: Bytes of new pre-tokens merged at a time.
ROUND_BYTES = 4_000_000

_PATTERN = regex.compile(public_tokenizers.PATTERN)
#: Blanks that don't begin a word, and the cut at those that do.
_BLANKS, _CUT = regex.compile(r" (?:\s|$)"), regex.compile(r" (?=\S)")


def _byte_symbols() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Merge table of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.first = np.zeros(256, np.int64)
        for c, b in _byte_symbols().items():
            self.first[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # open addressing: a pair is looked up with a few vector probes
        self.bits = 19
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE, np.int32)
        self.made = np.zeros(1 << self.bits, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] < 0
            chosen, pick = np.unique(slot[todo][free], return_index=True)
            won = todo[free][pick]
            self.keys[chosen], self.rank[chosen], self.made[chosen] = keys[won], won, made[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if the pair doesn't merge) and table slot of each pair."""
        keys = (left << 20) | right
        slot = self._slot(keys)
        rank = np.where(self.keys[slot] == keys, self.rank[slot], NONE)
        open_ = np.nonzero((rank == NONE) & (self.keys[slot] >= 0))[0]
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            rank[open_[hit]] = self.rank[slot[open_[hit]]]
            open_ = open_[(there >= 0) & ~hit]
        return rank, slot

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each of the byte strings."""
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        alive = np.zeros(len(tokens), np.int64)
        owner = np.arange(len(tokens))[sizes > 0]
        length = sizes[sizes > 0]
        symbol = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        # rank and result of each symbol's pair with the next one of its sequence
        rank, made = np.full(len(symbol), NONE), np.zeros(len(symbol), np.int32)
        inner = np.ones(len(symbol), bool)
        inner[np.cumsum(length) - 1] = False
        at = np.nonzero(inner)[0]
        rank[at], slot = self.look_up(symbol[at], symbol[at + 1])
        made[at] = self.made[slot]
        while len(symbol):
            start = np.cumsum(length) - length
            lowest = np.minimum.reduceat(rank, start)
            going = lowest != NONE
            if not going.all():  # sequences without a pair that merges are done
                alive[owner[~going]] = length[~going]
                keep = np.repeat(going, length)
                symbol, rank, made = symbol[keep], rank[keep], made[keep]
                owner, length, lowest = owner[going], length[going], lowest[going]
                if not len(symbol):
                    break
            at = np.nonzero(rank == np.repeat(lowest, length))[0]
            # of a run of overlapping pairs (aaa) every second one merges
            step = np.diff(at) == 1
            if step.any():
                run = np.r_[True, ~step]
                first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbol[at] = made[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            length = length - np.add.reduceat(~keep, np.cumsum(length) - length, dtype=np.int64)
            symbol, rank, made = symbol[keep], rank[keep], made[keep]
            at = at - np.arange(len(at))  # where the merged symbols are now
            ends = np.zeros(len(symbol), bool)
            ends[np.cumsum(length) - 1] = True
            rank[at] = NONE
            right = at[~ends[at]]
            left = at[at > 0] - 1
            left = left[~ends[left]]
            new = np.concatenate([right, left])
            rank[new], slot = self.look_up(symbol[new], symbol[new + 1])
            made[new] = self.made[slot]
        return alive


NONE = np.int32(2**31 - 1)


@functools.lru_cache(maxsize=2)
def _merger(path: str) -> tuple[Merger, regex.Pattern | None]:
    m = Merger(path)
    found = regex.compile("|".join(map(regex.escape, m.special))) if m.special else None
    return m, found


class Counter:
    """Counts texts; remembers the counts of words within a bound.

    A blank that a non-blank follows always begins a pre-token.  So a text is
    cut before such blanks, and each distinct word is split into pre-tokens
    by the tokenizer's pattern, and merged, only once.
    """

    def __init__(self, path: str):
        self.merger, self.special = _merger(path)
        self.tokens: dict[str, int] = {}  # counts of pre-tokens
        self.words: dict[str, int] = {}   # counts of words, their blank left out

    def _cut(self, text: str) -> tuple[str, list[str]]:
        """What comes before the first cut, and the words after it."""
        if _BLANKS.search(text):
            first, *rest = _CUT.split(text)
        else:
            first, *rest = text.split(" ")
        return first, rest

    def _merge(self, pre: list[list[str]]) -> list[int]:
        """Token count of each list of pre-tokens."""
        new = sorted(set().union(*pre).difference(self.tokens), key=len)
        at = 0
        while at < len(new):
            raw, total, start = [], 0, at
            while at < len(new) and total < ROUND_BYTES:
                raw.append(new[at].encode())
                total += len(raw[-1])
                at += 1
            self.tokens.update(zip(new[start:at], self.merger.count(raw).tolist(), strict=True))
        known = self.tokens.__getitem__
        return [sum(map(known, x)) for x in pre]

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text (null: none)."""
        if len(self.tokens) + len(self.words) > REMEMBERED:
            self.tokens, self.words = {}, {}
        total, parts, owner = [0] * len(texts), [], []
        for i, text in enumerate(texts):
            if text and any(s in text for s in self.merger.special):
                total[i] = len(self.special.findall(text))
                pieces = self.special.split(text)
            else:
                pieces = [text] if text else []
            parts.extend(map(self._cut, pieces))
            owner.extend([i] * len(pieces))
        new = list(set().union(*(rest for _, rest in parts)).difference(self.words))
        pre = [_PATTERN.findall(" " + w) for w in new] + [_PATTERN.findall(f) for f, _ in parts]
        n = self._merge(pre)
        self.words.update(zip(new, n, strict=False))
        known = self.words.__getitem__
        for i, first, (_, rest) in zip(owner, n[len(new):], parts, strict=True):
            total[i] += first + sum(map(known, rest))
        return total


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for every row.

    Reads doc_id and text only, whole texts.  Null text: 0 bytes, 0 tokens.
    Special strings in a text count as one token each, as the file says.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(public_tokenizers.path(vocabulary))
        for batch in batches:
            n = counter.counts(batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"),
                                   pa.array(n, pa.int64()),
                                   pa.array([x > limit for x in n], pa.bool_())],
                                  names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    prepare(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return docs.select(F.col("doc_id").cast("long"), "text", size).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
