"""Packing by non-negative least squares.

Windows are the powers of two up to the sequence length.  For each window the
shallow combinations of lengths that fill it exactly are enumerated; how often
each is used is the non-negative least-squares solution of "lengths used =
histogram of lengths", rounded.  What rounding and the combinations leave over
is packed greedily: end to end, longest first, cut where a sequence is full.

All of it happens on the histogram, at most ``size`` numbers.  The plan gives
every piece an address on one line of tokens: windows, largest first, so that
each lies at a multiple of its own size, then the leftovers.  Sequences are
the line's stretches of ``size`` tokens, and the last stretch is cut into
powers of two.  So no sequence needs padding, only leftovers are cut, and a
piece's address follows from its length and its number among equal lengths.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelmart.llm.common import cut_lineage, prepare

SEQUENCE = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Windows up to this size are filled by up to three lengths, larger ones by two.
TRIPLES = 512
#: Smallest window.
LEAST = 64
#: Steps of the solver, and the gain of a step below which it stops.
STEPS, GAIN = 300, 1e-4
#: Bytes of remembered words in a worker, counting ``ENTRY`` for each one's
#: objects, and of text worked on at a time.
REMEMBERED_BYTES, ENTRY = 192_000_000, 170
SLICE = 4_000_000

#: Two-byte UTF-8 letters: the lower-case ones up to U+00FF and all Latin
#: letters from U+0100 to U+024F.
_LETTER = rb"\xc3[\x9f-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f]"


def _patterns(letter: bytes) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """The tokenizer's pre-tokens of lower-case words of ASCII characters and
    these letters; texts without other characters; and the units of a text
    with others, the words that hold them first."""
    pre = rb"(?:[a-z]++" + letter + rb")++|[0-9]|'(?:[stmd]|re|ve|ll)|[!-/:-@\[-`{-~]++"
    return (re.compile(pre), re.compile(rb"(?:[\t-\r !-~]++" + letter + rb")*+"),
            re.compile(rb"(?:[!-~]++" + letter + rb")*+[^\s!-~]\S*|" + pre))


PRE_ASCII, ALL_ASCII, UNITS_ASCII = _patterns(b"")
PRE_LATIN, ALL_LATIN, UNITS_LATIN = _patterns(b"|" + _LETTER)
#: Bytes of characters from U+0280 on; white space; how special strings begin.
FAR, GAP, MARK = re.compile(rb"[\xca-\xff]"), re.compile("[\t-\r ]"), "<|"
#: Bytes as the vocabulary's characters: printable ones of Latin-1 as they
#: are, the others from U+0100 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}

STORED = "doc_id long, start long, length long, doc_tokens long, ids binary, part int, nth long"
PLACED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


# --- token ids ---------------------------------------------------------------

@functools.lru_cache(maxsize=2)
def remembered(vocabulary: str) -> Words:
    """The worker's ``Words``, kept from task to task."""
    return Words(vocabulary)


@functools.lru_cache(maxsize=2)
def _library(vocabulary: str) -> tokenizers.Tokenizer:
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(vocabulary))


def _units(text: str) -> list[bytes]:
    """Units of a text.  Special strings are told by their case, so that a
    text that may hold one is only cut into words.  Other scripts are left to
    the library's own lower-casing."""
    raw = text.encode()
    if MARK in text:
        return raw.split()
    if len(raw) == len(text) or FAR.search(raw):
        low, pre, plain, units = raw.lower(), PRE_ASCII, ALL_ASCII, UNITS_ASCII
    else:
        low, pre, plain, units = text.lower().encode(), PRE_LATIN, ALL_LATIN, UNITS_LATIN
    return (pre if plain.fullmatch(low) else units).findall(low)


class Words:
    """Ids of texts, from the library's ids of their units.

    The tokenizer drops white space and no token crosses it.  A word of
    printable ASCII characters and Latin letters is cut into the tokenizer's
    own pre-tokens, of which there are far fewer; any other word is a unit
    whole.  The library
    encodes each distinct unit; a worker remembers a bounded number of bytes
    of them.
    """

    def __init__(self, vocabulary: str):
        self.library = _library(vocabulary)
        small = self.library.get_vocab_size() <= 1 << 16
        self.kind = np.dtype("<u2" if small else "<u4")
        self.known: dict[bytes, bytes] = {}
        self.bytes = 0

    def learn(self, units: set[bytes]) -> None:
        """Ids of all the units; what was remembered goes where it is too much."""
        new = units.difference(self.known)
        if self.bytes > REMEMBERED_BYTES:
            self.known, self.bytes, new = {}, 0, units
        merge, rest = self.library.model.tokenize, []
        for u in new:
            if PRE_ASCII.fullmatch(u):
                self.known[u] = np.array([t.id for t in merge(u.decode())], self.kind).tobytes()
            elif PRE_LATIN.fullmatch(u) and (low := u.decode()) == low.lower():
                shown = u.decode("latin-1").translate(SHOWN)
                self.known[u] = np.array([t.id for t in merge(shown)], self.kind).tobytes()
            else:
                rest.append(u)
        found = self.library.encode_batch_fast([u.decode() for u in rest], add_special_tokens=False)
        for u, e in zip(rest, found, strict=True):
            self.known[u] = np.array(e.ids, self.kind).tobytes()
        self.bytes += sum(len(u) + len(self.known[u]) + ENTRY for u in new)

    def all_ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text, little-endian; a null text has none."""
        out, batch, size = [], [], 0
        for text in texts:
            if text and len(text) > SLICE:
                out += self._some(batch)
                out.append(self._long(text))
                batch, size = [], 0
                continue
            batch.append(text or "")
            size += len(batch[-1])
            if size > SLICE:
                out += self._some(batch)
                batch, size = [], 0
        return out + self._some(batch)

    def _some(self, texts: list[str]) -> list[bytes]:
        units = [_units(t) for t in texts]
        self.learn(set().union(*units))
        known = self.known.__getitem__
        return [b"".join(map(known, u)) for u in units]

    def _long(self, text: str) -> bytes:
        """A very long text by slices that end at ASCII white space."""
        out, at = [], 0
        while at < len(text):
            gap = GAP.search(text, at + SLICE)
            end = gap.start() if gap else len(text)
            out += self._some([text[at:end]])
            at = end
        return b"".join(out)


def tokenise(docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY,
             end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``size`` ids with the number ``nth`` of each among
    the pieces of its length in its task (``part``).

    Reads doc_id and text only.  All pieces but a document's last are ``size``
    long.  A null or empty text has just the end id; repeated rows and null
    ids each give their pieces; an empty table gives none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, words = TaskContext.get().partitionId(), remembered(vocabulary)
        end, width = np.array([end_id], words.kind).tobytes(), words.kind.itemsize
        seen: dict[int, int] = {}
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), words.all_ids(batch.column(1).to_pylist()), strict=True):
                raw = ids + end
                n = len(raw) // width
                for start in range(0, n, size):
                    length = min(size, n - start)
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    rows.append((doc_id, start, length, n, raw[width * start:width * (start + length)], part, nth))
            cols = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, STORED)


# --- plan --------------------------------------------------------------------

def combinations(window: int, deep: bool) -> np.ndarray:
    """Rows of three lengths (0: none) that add up to ``window``, longest
    first: one, two and, where ``deep``, three lengths."""
    a = np.arange((window + 1) // 2, window)
    rows = [np.array([[window, 0, 0]]), np.stack([a, window - a, 0 * a], 1)]
    if deep:
        b, c = np.meshgrid(np.arange(1, window), np.arange(1, window), indexing="ij")
        a = window - b - c
        keep = (a >= b) & (b >= c)
        rows.append(np.stack([a[keep], b[keep], c[keep]], 1))
    return np.concatenate(rows)


def windows(size: int) -> list[int]:
    """Window sizes, largest first."""
    return [size >> i for i in range(size.bit_length()) if size >> i >= min(LEAST, size)]


def solve(mixes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-negative least squares: how often to use each row of ``mixes`` so
    that the lengths used come nearest to ``counts``.

    Lengths are weighed by the inverse of their counts, so that rare ones
    count as much as common ones.  Multiplicative steps keep the solution
    non-negative and never raise the error.
    """
    want = counts.astype(np.float64)
    weight = np.where(want > 0, 1 / np.maximum(want, 1), 0)
    weight[0] = 0
    a, b, c = mixes.T.copy()

    def used(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(i, x, len(want)) for i in (a, b, c))

    def back(v: np.ndarray) -> np.ndarray:
        return v[a] + v[b] + v[c]

    x = np.ones(len(mixes))
    goal = back(weight * want)
    error = np.inf
    for _ in range(STEPS):
        have = used(x)
        now = float((weight * (have - want) ** 2).sum())
        if now > (1 - GAIN) * error:
            break
        error = now
        x *= goal / np.maximum(back(weight * have), 1e-300)
    return x


@dataclass
class Plan:
    """Addresses of pieces by length and number; see ``address``."""

    size: int
    keys: np.ndarray    # length and first number of an entry, in order
    base: np.ndarray    # address of the entry's first window
    per: np.ndarray     # pieces of this length in a window
    step: np.ndarray    # from a window to the next
    total: int          # tokens on the line
    kept: int           # pieces that combinations place, never cut

    def address(self, length: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Address of the ``number``-th piece of each length."""
        i = np.searchsorted(self.keys, (length << 44) + number, side="right") - 1
        q, m = np.divmod(number - (self.keys[i] & ((1 << 44) - 1)), self.per[i])
        return self.base[i] + q * self.step[i] + m * length

    @functools.cached_property
    def ends(self) -> np.ndarray:
        """Where the sequences of the last, shorter stretch begin."""
        at, out = self.total - self.total % self.size, []
        for bit in reversed(range(self.size.bit_length() - 1)):
            if self.total & (1 << bit):
                out.append(at)
                at += 1 << bit
        return np.array([*out, at], np.int64)

    def spans(self, address: int, length: int) -> list[tuple[int, int, int, int]]:
        """(from, length, sequence, offset) of the parts of a piece."""
        full, out, at = self.total // self.size, [], address
        ends = self.ends
        while at < address + length:
            if at < full * self.size:
                sequence, begin = at // self.size, at - at % self.size
                stop = begin + self.size
            else:
                i = int(np.searchsorted(ends, at, side="right")) - 1
                sequence, begin, stop = full + i, int(ends[i]), int(ends[i + 1])
            n = min(stop, address + length) - at
            out.append((at - address, n, sequence, at - begin))
            at += n
        return out


def plan(counts: np.ndarray, size: int = SEQUENCE) -> Plan:
    """Plan for ``counts[n]`` pieces of each length n up to ``size``, a power
    of two."""
    if size < 1 or size & (size - 1):
        raise ValueError("the sequence length must be a power of two")
    counts = np.asarray(counts, np.int64)
    left = counts.copy()
    have = left > 0
    have[0] = True
    sizes = windows(size)
    mixes = np.concatenate([combinations(w, w <= TRIPLES) for w in sizes])
    mixes = mixes[have[mixes].all(1)]
    times = np.floor(solve(mixes, counts) + 0.5).astype(np.int64) if len(mixes) else np.empty(0, np.int64)
    chosen: dict[int, list] = {w: [] for w in sizes}
    for i in np.argsort(-times, kind="stable"):
        if not times[i]:
            break
        lengths, k = np.unique(mixes[i][mixes[i] > 0], return_counts=True)
        t = min(int(times[i]), int((left[lengths] // k).min()))  # rounding never uses more than there is
        if t:
            left[lengths] -= k * t
            chosen[int(mixes[i].sum())].append((t, lengths[::-1].tolist(), k[::-1].tolist()))
    entries, at, cursor = [], 0, np.zeros(size + 1, np.int64)
    for w in sizes:
        for t, lengths, ks in chosen[w]:
            inner = at
            for n, k in zip(lengths, ks, strict=True):
                entries.append(((n << 44) + int(cursor[n]), inner, k, w))
                cursor[n] += k * t
                inner += n * k
            at += w * t
    kept = int(cursor.sum())
    for n in range(size, 0, -1):  # the leftovers, end to end
        if left[n]:
            entries.append(((n << 44) + int(cursor[n]), at, 1, n))
            at += n * int(left[n])
    entries.sort()
    keys, base, per, step = (np.array(x, np.int64) for x in zip(*entries, strict=True)) if entries else [np.empty(0, np.int64)] * 4
    return Plan(size, keys, base, per, step, at, kept)


# --- places ------------------------------------------------------------------

def place(pieces: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit numbers),
    doc_tokens, sequence_id and offset of a stored table of ``tokenise``."""
    by = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = by.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = np.zeros(size + 1, np.int64)
    for n, k in by.groupBy("length").agg(F.sum("n")).collect():  # at most ``size`` rows
        counts[n] = k
    p = plan(counts, size)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = remembered(vocabulary).kind
        for batch in batches:
            length = batch.column("length").to_numpy()
            address = p.address(length, batch.column("number").to_numpy())
            rows: list[tuple] = []
            for doc_id, start, n, total, raw, at in zip(
                    batch.column("doc_id").to_pylist(), batch.column("start").to_pylist(), length.tolist(),
                    batch.column("doc_tokens").to_pylist(), batch.column("ids").to_pylist(), address.tolist(), strict=True):
                ids = np.frombuffer(raw, kind).astype("<u4")
                rows.extend((doc_id, start + i, k, ids[i:i + k].tobytes(), total, sequence, offset)
                            for i, k, sequence, offset in p.spans(at, n))
            cols = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    numbered = pieces.join(offsets, ["length", "part"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids", (F.col("nth") + F.col("before")).alias("number"))
    return numbered.mapInArrow(run, PLACED)


def pack(docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Pack all documents (columns doc_id, text; others are not read).

    Every id lies in exactly one piece; offsets in a sequence are gapless
    from 0; a sequence is full or its length is a power of two.  Null and
    empty texts are packed as their end id, repeated rows and null ids each
    for themselves; an empty table gives no rows.
    """
    return place(cut_lineage(tokenise(docs, size, vocabulary, end_id), "tokens"), size, vocabulary)
