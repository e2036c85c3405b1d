"""Near-duplicate documents by MinHash bands and odd sketches.

Documents with the same words collapse to one class.  A class's MinHash
samples give band keys, and are folded into an odd sketch: a bitmap of
parities, whose XOR with another one has a population count that estimates a
high similarity.  Classes that share a band key are candidates; those whose
sketches are too far apart for the wanted similarity are dropped, and the
rest are confirmed on their full shingle sets.

In each of some rounds, a class is confirmed with one other: the closest by
sketch among a few of its keys' classes in other components, drawn at random.
Rounds end when few of their pairs are similar.  What these links join needs
no more comparing: at last all classes of one key that are still in different
components are compared.  So a group of thousands of near copies costs about
as many comparisons as it has members, and no link between components is
lost.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import bit_distance, cut_lineage, mix64, prepare, shingle_hashes, words
from panelmart.llm.components import components

WORDS = 5
SIMILAR = 80       # percent
ROWS = 5           # MinHash samples of a band
SAMPLES = 256      # MinHash samples of a sketch (at least those of the bands)
SKETCH_WORDS = 16  # 64-bit words of an odd sketch
#: Rounds of one comparison a class, before the rest is compared in full.
ROUNDS = 4
#: Rounds go on while one in so many of their pairs is similar.
WORTH = 8
MATES = 8
#: Classes of a block; a tile compares two blocks.
TILE = 128
#: Shingles that are hashed at once, so that the values stay in a core's cache.
PART = 256
#: Chance that a pair at the wanted similarity shares no band, and chance
#: that its sketches are further apart than the limit.
MISSED = 1e-6
#: Candidates' ids are broadcast up to this many (8 bytes each), else joined.
BROADCAST_IDS = 2_000_000
SEED = 7
#: Stand-in ids of rows without a doc_id lie above this.
NO_ID = 1 << 62


def bands_for(similar: float, rows: int = ROWS, missed: float = MISSED) -> int:
    """Bands with which a pair at ``similar`` is missed by that chance."""
    return max(1, math.ceil(math.log(missed) / math.log1p(-similar**rows)))


@functools.lru_cache(maxsize=8)
def sketch_limit(similar: float, samples: int, bits: int, missed: float = MISSED) -> int:
    """Largest XOR population count of two odd sketches that a pair at
    ``similar`` exceeds with a chance below ``missed``.

    Of the samples, binomially many differ; each flips two random bits.  The
    odd bits after each flip follow a Markov chain.
    """
    state = np.zeros(bits + 1)
    state[0] = 1.0
    odd = np.arange(bits + 1) / bits
    total = np.zeros(bits + 1)
    p = 1.0 - similar
    for differ in range(samples + 1):
        chance = math.exp(math.lgamma(samples + 1) - math.lgamma(differ + 1) - math.lgamma(samples - differ + 1)
                          + (differ * math.log(p) if p else (0 if not differ else -math.inf))
                          + (samples - differ) * math.log1p(-p))
        total += chance * state
        for _ in range(2):
            state = np.append(0, (state * (1 - odd))[:-1]) + np.append((state * odd)[1:], 0)
    return int(np.searchsorted(np.cumsum(total), 1 - missed))


class Sketcher:
    """MinHash band keys and odd sketch of a shingle set."""

    def __init__(self, bands: int, rows: int, samples: int, sketch_words: int, seed: int = SEED):
        self.bands, self.rows, self.bits = bands, rows, 64 * sketch_words
        n = max(samples, bands * rows)
        rng = np.random.default_rng(seed)
        self.mul = (rng.integers(0, 1 << 32, (n, 1), dtype=np.uint32)) | np.uint32(1)
        self.add = rng.integers(0, 1 << 32, (n, 1), dtype=np.uint32)
        self.part = np.empty((n, PART), np.uint32)
        self.salt = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        self.band_salt = rng.integers(0, 1 << 63, bands, dtype=np.uint64)

    def samples(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest value of each hash function over the set.  32 bits of
        the shingles do: candidates are confirmed on the whole hashes."""
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.mul), np.iinfo(np.uint32).max)
        for at in range(0, len(short), PART):
            part = short[at:at + PART]
            value = np.multiply(part, self.mul, out=self.part[:, :len(part)])
            value += self.add
            np.minimum(least, value.min(axis=1), out=least)
        return least.astype(np.uint64)

    def sketch(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(band keys, odd sketch as 64-bit words), both signed."""
        least = self.samples(shingles)
        key = self.band_salt.copy()
        for column in least[:self.bands * self.rows].reshape(self.bands, self.rows).T:
            key = mix64(key ^ column)
        place = (mix64(least ^ self.salt) % np.uint64(self.bits)).astype(np.int64)
        parity = (np.bincount(place, minlength=self.bits) & 1).astype(np.uint8)
        return key.view(np.int64), np.packbits(parity).view(np.int64)


def uid() -> Column:
    """doc_id, or a stand-in made from the text for a null one."""
    stand_in = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(NO_ID)) + F.lit(NO_ID)
    return F.coalesce(F.col("doc_id").cast("long"), stand_in)


def with_ids(docs: DataFrame) -> DataFrame:
    """uid and text."""
    return docs.select(uid().alias("uid"), "text")


def signatures(docs: DataFrame, n_words: int, bands: int, rows: int = ROWS, samples: int = SAMPLES,
               sketch_words: int = SKETCH_WORDS) -> DataFrame:
    """uid, n_shingles, digest (of the words), bands, sketch; the last three
    are null for a text without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bands, rows, samples, sketch_words)
        for batch in batches:
            n, digest, keys, sketch = [], [], [], []
            for text in batch.column("text"):
                tokens = words(text.as_py())
                shingles = shingle_hashes(tokens, n_words)
                n.append(len(shingles))
                if tokens:
                    a, b = sketcher.sketch(shingles)
                    digest.append(xxhash.xxh3_128_digest(b" ".join(tokens)))
                    keys.append(a)
                    sketch.append(b)
                else:
                    digest.append(None)
                    keys.append(None)
                    sketch.append(None)
            longs = pa.list_(pa.int64())
            yield pa.record_batch(
                [batch.column("uid"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, longs), pa.array(sketch, longs)],
                names=["uid", "n_shingles", "digest", "bands", "sketch"])

    return with_ids(docs).mapInArrow(
        run, "uid long, n_shingles long, digest binary, bands array<long>, sketch array<long>")


def shingle_sets(docs: DataFrame, ids: DataFrame, n_words: int) -> DataFrame:
    """id and shingles (distinct hashes) of the documents in ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(words(t.as_py()), n_words).view(np.int64) for t in batch.column("text")]
            yield pa.record_batch([batch.column("uid"), pa.array(sets, pa.list_(pa.int64()))],
                                  names=["id", "shingles"])

    ids = ids.select(F.col("id").alias("uid"))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    found = with_ids(docs).join(ids, "uid", "left_semi")
    return found.mapInArrow(run, "id long, shingles array<long>")


def _confirm(pairs: DataFrame, docs: DataFrame, n_words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    ids = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = cut_lineage(shingle_sets(docs, ids, n_words), "shingles")
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    # sizes first: the smaller set bounds the intersection
    joined = pairs.join(a, "a").join(b, "b").where(
        F.least(F.size("sa"), F.size("sb")) * 100 >= percent * F.greatest(F.size("sa"), F.size("sb")))
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    return joined.where(common * 100 >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, n_words: int = WORDS, percent: int = SIMILAR, **options) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Reads doc_id and text only.  Texts with fewer than ``n_words`` words are
    one shingle; null and blank texts have none and are linked with nothing.
    ``component_id`` is the smallest doc_id of the component; ``kept`` marks the
    document that bears it.  Rows with one doc_id count as one document, and
    so do rows with a null doc_id and the same text; a component without any
    doc_id has a null component_id.  Empty table: no rows.
    """
    real = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return near_classes(docs, n_words, percent, **options).select(
        real("uid").alias("doc_id"), "n_shingles", real("component").alias("component_id"),
        (F.col("uid") == F.col("component")).alias("kept"))


def deduplicate(docs: DataFrame, n_words: int = WORDS, percent: int = SIMILAR, **options) -> DataFrame:
    """``docs`` with one row of each component of similar texts: that of the
    smallest doc_id, whatever the names of its columns.  Rows are linked by
    their texts alone: of two different texts with one doc_id both stay.
    Rows with a null doc_id come after all others."""
    prepare(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), uid().alias("uid"), "text")
    found = _classes_of_unique(docs, n_words, percent, **options)
    if found is not None:
        return rows.join(found.where("uid = component").select("uid"), "uid", "left_semi").select("row.*")
    rows = cut_lineage(rows.withColumn("number", F.monotonically_increasing_id()), "rows")
    found = _classes_of_unique(rows.select(F.col("number").alias("doc_id"), "text"), n_words, percent, **options)
    least = F.min_by(F.col("number"), F.struct("uid", "number"))
    kept = (rows.select("uid", "number").join(found.select(F.col("uid").alias("number"), "component"), "number")
            .groupBy("component").agg(least.alias("number")))
    return rows.join(kept.select("number"), "number", "left_semi").select("row.*")


def near_classes(docs: DataFrame, n_words: int, percent: int, **options) -> DataFrame:
    """uid, n_shingles and component (smallest uid) of every row.

    Where doc_ids repeat, the rows are classed by their own numbers, then the
    classes of one doc_id's texts are linked with each other.
    """
    prepare(docs.sparkSession)
    found = _classes_of_unique(docs, n_words, percent, **options)
    if found is not None:
        return found
    rows = cut_lineage(with_ids(docs).withColumn("number", F.monotonically_increasing_id()), "rows")
    found = _classes_of_unique(rows.select(F.col("number").alias("doc_id"), "text"), n_words, percent, **options)
    found = cut_lineage(rows.select("uid", "number").join(
        found.select(F.col("uid").alias("number"), "n_shingles", "component"), "number"), "classed")
    first = found.groupBy("uid").agg(F.min("component").alias("first"))
    same = found.join(first, "uid").where("component != first").select(
        F.col("component").alias("a"), F.col("first").alias("b")).distinct()
    found = found.join(components(same).select(F.col("id").alias("component"), F.col("component").alias("joined")), "component", "left")
    found = found.withColumn("joined", F.coalesce("joined", "component"))
    least = found.groupBy("joined").agg(F.min("uid").alias("component"))
    return found.drop("component").join(least, "joined").select("uid", "n_shingles", "component")


def _classes_of_unique(docs: DataFrame, n_words: int, percent: int, rows: int = ROWS, samples: int = SAMPLES,
                       sketch_words: int = SKETCH_WORDS, rounds: int = ROUNDS, mates: int = MATES) -> DataFrame | None:
    """uid, n_shingles and component (smallest uid) of rows whose ids differ;
    None where an id comes more than once."""
    n_bands = bands_for(percent / 100, rows)
    limit = sketch_limit(percent / 100, max(samples, n_bands * rows), 64 * sketch_words)
    signed = cut_lineage(signatures(docs, n_words, n_bands, rows, samples, sketch_words), "signatures")
    if not signed.groupBy("uid").count().where("count > 1").isEmpty():
        return None
    # classes of the same words; the smallest id stands for them
    classes = signed.where("digest is not null").groupBy("digest").agg(
        F.min("uid").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = cut_lineage(classes, "classes")
    lead = classes.select("digest", "id")
    keyed = classes.select("id", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    member = cut_lineage(keyed.join(shared, "key").select("key", "id", F.col("id").alias("label")), "members")
    sketches = classes.select("id", "sketch")

    found = None
    for number in range(rounds):
        pairs = cut_lineage(_nearest(member, sketches, number, sketch_words, limit, mates), "pairs")
        if pairs.isEmpty():
            break
        links = cut_lineage(_confirm(pairs, docs, n_words, percent), "confirmed")
        found, member = _join(found, links, member)
        if links.count() * WORTH < pairs.count():
            break
    links = cut_lineage(_between(member, sketches, docs, n_words, percent, limit), "pairs")
    if not links.isEmpty():
        found, member = _join(found, links, member)

    ids = lead.select("digest", F.col("id").alias("c")) if found is None else lead.join(
        found, "id", "left").select("digest", F.coalesce("component", "id").alias("c"))
    return signed.select("uid", "n_shingles", "digest").join(ids, "digest", "left").select(
        "uid", "n_shingles", F.coalesce("c", "uid").alias("component"))


def _nearest(member: DataFrame, sketches: DataFrame, number: int, sketch_words: int, limit: int,
             mates: int) -> DataFrame:
    """A pair (a, b) for each class: with the one whose sketch is closest
    among some of each of its keys' classes that are in other components.
    Which ones is drawn anew each round, at most ``mates`` a key."""
    mixed = (member.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .where("lo < hi").select("key"))
    mixed = cut_lineage(member.join(mixed, "key").join(sketches, "id"), "members")
    h = F.xxhash64("id", F.lit(number))
    some = mixed.groupBy("key", F.pmod(h, F.lit(mates)).alias("m")).agg(
        F.min(F.struct(h.alias("h"), "id", "label")).alias("x")).select(
        "key", F.col("x.id").alias("mate"), F.col("x.label").alias("mate_label"))
    some = some.join(sketches.select(F.col("id").alias("mate"), F.col("sketch").alias("mate_sketch")), "mate")
    far = bit_distance(F.col("sketch"), F.col("mate_sketch"), sketch_words)
    best = (mixed.join(some, "key").where(F.col("label") != F.col("mate_label")).where(far <= limit)
            .groupBy("id").agg(F.min(F.struct(far.alias("far"), "mate")).alias("x")))
    return best.select(F.greatest("id", "x.mate").alias("a"), F.least("id", "x.mate").alias("b")).distinct()


def _join(found: DataFrame | None, links: DataFrame, member: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components with the new links, and the members with their new labels."""
    if found is not None:
        links = links.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
    found = cut_lineage(components(links), "components")
    label = F.coalesce("component", "label").alias("label")
    return found, cut_lineage(member.join(found, "id", "left").select("key", "id", label), "members")


def _between(member: DataFrame, sketches: DataFrame, docs: DataFrame, n_words: int, percent: int,
             limit: int) -> DataFrame:
    """Links (a, b) that join all components which have a similar pair of
    classes under one key.

    The classes of all mixed keys whose lowest-hash class is in one component
    form an arena.  An arena's own classes (of that component) and its other
    classes are dealt into blocks.  Two blocks are a tile, but for two own
    ones, whose classes need no comparing; a block of others has its tile with
    itself together with that of the first own block.  A tile compares
    sketches, confirms close pairs on their full sets, and sends only links
    that join components, not the pairs.
    """
    mixed = (member.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                       F.min(F.struct(F.xxhash64("id"), "label"))["label"].alias("home"))
             .where("lo < hi").select("key", "home"))
    arena = cut_lineage(member.join(mixed, "key").select(
        "home", "id", "label", (F.col("label") == F.col("home")).alias("own")).distinct(), "arenas")
    sizes = arena.groupBy("home").agg(
        F.ceil(F.count_if("own") / TILE).cast("int").alias("n_own"),
        F.ceil(F.count_if(~F.col("own")) / TILE).cast("int").alias("n_other"))
    sets = shingle_sets(docs, cut_lineage(arena.select("id").distinct(), "ids"), n_words)
    number = F.when(F.col("own"), F.col("n_own")).otherwise(F.col("n_other"))
    rows = arena.join(sizes.where("n_other > 0"), "home").withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit(1)), number).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    tile = lambda x, y, own, second: F.struct(
        x.alias("x"), y.alias("y"), own.alias("own"), second.alias("second"))
    block, no, yes = F.col("block"), F.lit(False), F.lit(True)
    with_own = F.transform(upto("n_other"), lambda x: F.when(
        block == 0, tile(x, x, no, yes)).otherwise(tile(x, block, yes, yes)))
    with_others = F.concat(
        F.transform(upto("n_other"), lambda y: tile(F.least(block, y), F.greatest(block, y), no, y < block)),
        F.when(F.col("n_own") > 1, F.transform(
            F.sequence(F.lit(1), F.col("n_own") - 1), lambda y: tile(block, y, yes, no))).otherwise(F.array()))
    placed = (rows.join(sketches, "id").join(sets, "id")
              .withColumn("t", F.explode(F.when(F.col("own"), with_own).otherwise(with_others))))
    # some 2 x TILE rows each
    tiles = placed.groupBy("home", "t.x", "t.y", F.col("t.own").alias("beside")).agg(
        F.collect_list(F.struct("id", "label", "sketch", "shingles", "t.second")).alias("rows")).select(
        (F.expr("NOT beside AND x = y")).alias("all"), "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for every, rows in zip(batch.column("all"), batch.column("rows"), strict=True):
                second = rows.values.field("second").to_numpy(zero_copy_only=False)
                a = _side(rows.values.filter(pa.array(~second)))
                b = _side(rows.values if every.as_py() else rows.values.filter(pa.array(second)))
                links = tile_links(a, b, percent, limit) if len(a[0]) and len(b[0]) else []
                yield pa.record_batch([pa.array([x for x, _ in links], pa.int64()),
                                       pa.array([x for _, x in links], pa.int64())], names=["a", "b"])

    return tiles.mapInArrow(run, "a long, b long")


def _side(rows: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """ids, labels, sketches and sorted shingles of a block."""
    get = {rows.type.field(i).name: c for i, c in enumerate(rows.flatten())}
    sketch = np.array([x.values.to_numpy() for x in get["sketch"]]).view(np.uint64)
    return (get["id"].to_numpy(), get["label"].to_numpy(), sketch,
            [np.sort(x.values.to_numpy()) for x in get["shingles"]])


def tile_links(a: tuple, b: tuple, percent: int, limit: int) -> list[tuple[int, int]]:
    """Confirmed links between two blocks, closest sketches first; pairs whose
    components are joined already are passed over."""
    far = np.zeros((len(a[0]), len(b[0])), np.uint16)
    for w in range(a[2].shape[1]):
        far += np.bitwise_count(a[2][:, None, w] ^ b[2][None, :, w])
    i, j = np.nonzero((far <= limit) & (a[1][:, None] != b[1][None, :]))
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    links = []
    for k in np.argsort(far[i, j], kind="stable"):
        x, y = i[k], j[k]
        p, q = top(int(a[1][x])), top(int(b[1][y]))
        if p == q:
            continue
        u, v = a[3][x], b[3][y]
        if 100 * min(len(u), len(v)) < percent * max(len(u), len(v)):
            continue
        common = len(np.intersect1d(u, v, assume_unique=True))
        if 100 * common >= percent * (len(u) + len(v) - common):
            links.append((int(a[0][x]), int(b[0][y])))
            root[p] = q
    return links
