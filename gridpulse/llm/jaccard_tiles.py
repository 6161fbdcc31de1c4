"""N-gram Jaccard join: size bands, tiles of bounded size, bitmap bounds, exact intersections.

A document is its set of distinct word n-grams. Equal sets fold into one node first. Sets are
banded by size. Two sets that reach the threshold differ in at most D elements, D following from
the band; so, dealt into more than D buckets by hash, they agree on a whole bucket. Sets that
agree on a bucket meet in a cluster, and clusters are cut into tiles. Within a tile bitmaps, of two
to four bits an element, bound the overlap of a pair from above. What the bounds leave connected is
tiled anew, now with the sorted arrays, which are intersected. So chance agreements, whose number
grows with the square of the documents, cost bitmaps but no arrays. Every link between different
texts is found or implied by links found: a pair is left out only where both are already known to
be connected, or known not to be.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import mix, rows, stored, text_chunks
from gridpulse.llm.components import connected_components

SEGMENT = 1_000_000  # bytes of text that are cut into words at once
CHUNK_KEYS = 1_000_000  # keys that a worker pre-aggregates at once
TILE_SHINGLES = 1_000_000  # of a block; a tile holds two
TILE_SETS = 4_096
TILE_BITMAPS = 4_000_000  # shingles of a block whose bitmaps alone are compared: 2 MB at most
MOST_BITS = 65_536  # of a bitmap
BROADCAST_MEMBERS = 1_000_000  # documents of clusters, some 60 bytes each, that are sent to every executor
SAMPLED_TEXTS = 4_000
SAMPLED_SHINGLES = 4_000  # of a text, by hash
MOST_COMMON = 200_000
STEP = np.uint64(0x9E3779B97F4A7C15)
FACTOR = 0xD1342543DE82EF95  # odd
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
SPARES = 64  # as many numbers of spare buckets are tried one by one, then every few percent


def byte_values() -> np.ndarray:
    """A random number per byte, the same for a capital and its small letter of A-Z, 0 for white space."""
    made = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
    made[65:91] = made[97:123]
    made[SPACE] = 0
    return made


@dataclass(frozen=True)
class Rule:
    """Link when den * overlap >= num * union, over distinct ``width``-word shingles."""

    width: int = 5
    num: int = 4
    den: int = 5


def powers(factor: int, count: int) -> np.ndarray:
    """1, factor, factor ** 2 and so on, modulo 2 ** 64."""
    made = np.ones(1, np.uint64)
    while len(made) < count:
        made = np.concatenate((made, made * np.uint64(pow(factor, len(made), 2**64))))
    return made[:count]


@dataclass
class Shingler:
    """Texts to sorted arrays of 64-bit shingle hashes; A-Z in lower case, words cut at ASCII white space.

    A word's hash is a sum of its bytes' random values times powers of an odd number, shifted to where it starts, so
    all words of a segment are hashed at once and no word is ever made a Python object.
    """

    width: int
    up: np.ndarray = field(default_factory=lambda: powers(FACTOR, SEGMENT))
    down: np.ndarray = field(default_factory=lambda: powers(pow(FACTOR, -1, 2**64), SEGMENT))
    value: np.ndarray = field(default_factory=byte_values)

    def word_hashes(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of bytes that end at every cut too, and where the words start."""
        if len(data) > len(self.up):
            self.up, self.down = powers(FACTOR, len(data)), powers(pow(FACTOR, -1, 2**64), len(data))
        full = ~SPACE[data]
        first = full.copy()
        first[1:] &= ~full[:-1]
        first[cuts[cuts < len(data)]] = full[cuts[cuts < len(data)]]
        start = np.flatnonzero(first)
        if not len(start):
            return np.empty(0, np.uint64), start
        size = np.add.reduceat(full, start, dtype=np.int64).astype(np.uint64)
        found = np.add.reduceat(self.value[data] * self.up[: len(data)], start)
        return mix(found * self.down[start] + size * STEP), start

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """A set of shingles per text; null texts have none."""
        data, ends = text_bytes(texts)
        hashes, counts, at = [], np.zeros(len(ends) - 1, np.int64), 0
        while at < len(data):
            stop = segment_end(data, at)
            low, high = np.searchsorted(ends, (at, stop))
            found, start = self.word_hashes(data[at:stop], ends[low:high] - at)
            hashes.append(found)
            counts += np.bincount(np.searchsorted(ends, start + at, side="right") - 1, minlength=len(counts))
            at = stop
        words, made = np.concatenate([np.empty(0, np.uint64), *hashes]), []
        for end, n in zip(np.cumsum(counts).tolist(), counts.tolist()):
            made.append(self.shingles(words[end - n : end]))
        return made

    def shingles(self, h: np.ndarray) -> np.ndarray:
        if not len(h):
            return h
        width = min(self.width, len(h))
        x = np.full(len(h) - width + 1, width, np.uint64)
        for j in range(width):
            x = x * STEP + h[j : len(h) - width + 1 + j]
        return np.unique(mix(x))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where they begin and end."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def segment_end(data: np.ndarray, at: int) -> int:
    """Where a segment of about SEGMENT bytes ends: behind white space, so that no word is cut."""
    end = at
    while end < len(data):
        start, end = end, min(len(data), end + SEGMENT)
        spaces = np.flatnonzero(SPACE[data[start:end]])
        if end < len(data) and len(spaces):
            return start + int(spaces[-1]) + 1
    return len(data)


def digest(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.array([xxhash.xxh3_64_intdigest(shingles.tobytes())], np.uint64).view(np.int64)[0])


@dataclass(frozen=True)
class Band:
    """Sizes low to high - 1. Linked sets up to this band differ in ``differ`` elements at most."""

    index: int
    low: int
    high: int
    differ: int
    buckets: int

    @property
    def spare(self) -> int:
        """Empty buckets that a set may have and still be sure to meet its partners in a full one."""
        return self.buckets - self.differ - 1


def made_band(index: int, low: int, num: int, den: int) -> Band:
    high = max(low + 1, math.ceil(low * max(1.5, 1.2 * den / num)))
    differ = 2 * (high - 1) * (den - num) // (den + num)

    def cost(spare: int) -> float:
        """Share of sets that have more empty buckets, and what more buckets cost."""
        k = differ + 1 + spare
        mean = k * (1 - 1 / k) ** low
        term = total = math.exp(-mean)
        for i in range(1, spare + 1):
            term *= mean / i
            total += term
        return 1 - total + spare / k

    tried = list(range(min(differ // 2 + 3, SPARES)))
    while tried[-1] < min(differ // 2, 4_000):
        tried.append(tried[-1] + max(1, tried[-1] // 16))
    return Band(index, low, high, differ, differ + 1 + min(tried, key=cost))


@dataclass
class Bands:
    """The bands of a rule, made as sizes ask for them."""

    rule: Rule
    made: list[Band] = field(default_factory=list)
    lows: list[int] = field(default_factory=list)

    def of(self, size: int) -> list[Band]:
        """The band of a set's size, and the next one if a larger partner may lie there."""
        while not self.made or self.made[-1].low <= size:
            low = self.made[-1].high if self.made else 1
            self.made.append(made_band(len(self.made), low, self.rule.num, self.rule.den))
            self.lows.append(low)
        at = bisect.bisect_right(self.lows, size) - 1
        own, above = self.made[at], self.made[at + 1]
        return [own, above] if size * self.rule.den // self.rule.num >= above.low else [own]


def band_tag(index: int) -> np.uint64:
    return np.uint64((index + 1) * int(STEP) % 2**64)


def place(node: int, index: int) -> int:
    """The node within a band: (node, band) as one 64-bit integer."""
    return int((np.array([node], np.int64).view(np.uint64) ^ band_tag(index)).view(np.int64)[0])


def bucket_keys(rare: np.ndarray, common: np.ndarray, at: Band, rule: Rule) -> np.ndarray:
    """Keys of which linked sets share one: the content of each full bucket, and of a set
    with too many empty buckets also the elements of its prefix.

    Only the rare shingles fill buckets: those of two sets differ in no more elements than the sets do, whatever
    is held to be common, and what many texts share makes no key. The prefix takes rare shingles before common ones.
    """
    tag, keys, full = band_tag(at.index), np.empty(0, np.uint64), 0
    if len(rare):
        bucket = ((rare >> np.uint64(32)) * np.uint64(at.buckets)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        content = np.add.reduceat(mix(rare ^ tag), first)
        keys, full = mix(content + mix(bucket[first] + tag)), len(first)
    if at.buckets - full > at.spare:
        n = len(rare) + len(common)
        prefix = np.concatenate((rare, common))[: n - -(-n * rule.num // rule.den) + 1]
        keys = np.concatenate((keys, mix(mix(prefix) ^ ~tag)))
    return keys


def common_shingles(docs: DataFrame, total: int, rule: Rule) -> np.ndarray:
    """Shingles that several different texts of a sample hold, sorted: the most frequent MOST_COMMON.

    The sample of about SAMPLED_TEXTS texts, and SAMPLED_SHINGLES of each, is chosen by hash. It decides how well
    candidates are told apart, never which links are found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rule.width)
        for _, texts in text_chunks(batches):
            found = shingler(texts)
            nodes = [digest(s) for s in found]
            yield rows(node=pa.array(nodes, pa.int64()), content=pa.array([s[:SAMPLED_SHINGLES].tobytes() for s in found], pa.binary()))

    share = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 20)) * total <= SAMPLED_TEXTS * (1 << 20)
    sample = docs.select("text").where("text is not null").where(share).mapInArrow(run, "node long, content binary")
    sample = sample.groupBy("node").agg(F.first("content").alias("content")).limit(2 * SAMPLED_TEXTS)
    found = [np.frombuffer(c, np.uint64) for c in sample.toArrow().column("content").to_pylist()]
    value, times = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
    often = times >= 2
    value, times = value[often], times[often]
    return np.sort(value[np.argsort(-times, kind="stable")[:MOST_COMMON]])


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, text): a row is found again by its id, which may be null or repeated, and a hash of its text."""
    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tie"] == b["tie"])


def describe_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, tie (a hash of the text), n_shingles, node (null if empty), own and guest: the node in its band and in the next one; bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bands = Shingler(rule.width), Bands(rule)
        for part, texts in text_chunks(batches):
            sizes, nodes, own, guest, bits = [], [], [], [], []
            for s in shingler(texts):
                node = digest(s) if len(s) else None
                at = [place(node, b.index) for b in bands.of(len(s))] if len(s) else []
                sizes.append(len(s))
                nodes.append(node)
                own.append(at[0] if at else None)
                guest.append(at[1] if len(at) > 1 else None)
                bits.append(bitmap(s) if len(s) else None)
            ids = part.column("doc_id").cast(pa.int64())
            long = pa.int64()
            yield rows(
                doc_id=ids,
                tie=part.column("tie"),
                n_shingles=pa.array(sizes, long),
                node=pa.array(nodes, long),
                own=pa.array(own, long),
                guest=pa.array(guest, long),
                bits=pa.array(bits, pa.binary()),
            )

    schema = "doc_id long, tie long, n_shingles long, node long, own long, guest long, bits binary"
    return keyed(docs).mapInArrow(run, schema)


def candidate_edges(docs: DataFrame, rule: Rule, common: np.ndarray) -> DataFrame:
    """(a, b): nodes in a band that agree on a bucket with the smallest such node.

    A worker folds the keys that its own rows share before the shuffle, so a key brings one
    row per chunk of keys at most, however many documents hold it.
    """

    def fold(keys: list[np.ndarray], nodes: list[int], counts: list[int]) -> pa.RecordBatch:
        key, node = np.concatenate(keys), np.repeat(np.array(nodes, np.int64), counts)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        head = np.concatenate(([True], key[1:] != key[:-1]))
        hub = node[np.flatnonzero(head)[np.cumsum(head) - 1]]
        local = hub != node
        pairs = np.unique(np.stack((node[local], hub[local]), 1), axis=0)
        return rows(
            key=np.concatenate((key[head], mix(pairs[:, 0].view(np.uint64)))),
            a=np.concatenate((node[head], pairs[:, 0])),
            b=np.concatenate((node[head], pairs[:, 1])),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bands = Shingler(rule.width), Bands(rule)
        keys, nodes, counts, total = [], [], [], 0
        for _, texts in text_chunks(batches):
            for s in shingler(texts):
                if not len(s):
                    continue
                node, often = digest(s), np.zeros(len(s), bool)
                if len(common):
                    often = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
                for b in bands.of(len(s)):
                    found = bucket_keys(s[~often], s[often], b, rule)
                    keys.append(found)
                    nodes.append(place(node, b.index))
                    counts.append(len(found))
                    total += len(found)
                if total >= CHUNK_KEYS:
                    yield fold(keys, nodes, counts)
                    keys, nodes, counts, total = [], [], [], 0
        if total:
            yield fold(keys, nodes, counts)

    found = docs.select("text").where(F.col("text").isNotNull()).mapInArrow(run, "key long, a long, b long")
    least = F.min("a").over(Window.partitionBy("key"))
    return found.select("a", F.when(F.col("a") != F.col("b"), F.col("b")).otherwise(least).alias("b")).where("a != b")


def overlaps(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted array with others."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    starts = np.cumsum([0, *(len(x) for x in others[:-1])])
    return np.add.reduceat((one[at] == flat).astype(np.int64), starts)


def bitmap(s: np.ndarray) -> bytes:
    """One bit per hashed element, two to four bits wide per element up to MOST_BITS."""
    made = np.zeros(min(MOST_BITS, max(64, 1 << (2 * len(s) - 1).bit_length())), np.uint8)
    made[(s & np.uint64(len(made) - 1)).astype(np.intp)] = 1
    return np.packbits(made, bitorder="little").tobytes()


def alike(found: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, folded to the width of the narrowest."""
    width = min(map(len, found))
    folded = [np.bitwise_or.reduce(np.frombuffer(b, np.uint64).reshape(-1, width // 8), axis=0) for b in found]
    return np.stack(folded)


def tile_links(
    sizes: np.ndarray,
    bits: np.ndarray,
    home: np.ndarray,
    side: np.ndarray,
    across: bool,
    rule: Rule,
    sets: list[np.ndarray] | None = None,
) -> np.ndarray:
    """Labels, equal where links connect the sets of a tile; without ``sets``, where bitmaps cannot rule it out.

    ``across``: only pairs of different sides count, the others belong to other tiles. Pairs of
    two guests belong to the band below.
    """
    label = np.arange(len(sizes))
    for p in range(len(sizes)):
        more = np.arange(len(sizes)) > p
        low, high = np.minimum(sizes, sizes[p]), np.maximum(sizes, sizes[p])
        more &= (label != label[p]) & (rule.den * low >= rule.num * high) & (home | home[p])
        if across:
            more &= side != side[p]
        q = np.flatnonzero(more)
        if not len(q):
            continue
        mine = np.bitwise_count(bits[p] & ~bits[q]).sum(1, dtype=np.int64)
        theirs = np.bitwise_count(bits[q] & ~bits[p]).sum(1, dtype=np.int64)
        both = np.minimum(sizes[p] - mine, sizes[q] - theirs)
        need = rule.num * (sizes[p] + sizes[q])
        keep = (rule.num + rule.den) * both >= need
        q, need, both = q[keep], need[keep], both[keep]
        if len(q) and sets:
            both = overlaps(sets[p], [sets[i] for i in q])
        for i in q[(rule.num + rule.den) * both >= need]:
            if label[i] != label[p]:
                label[label == label[i]] = label[p]
    return label


def in_tiles(placed: DataFrame, load: str, rule: Rule) -> DataFrame:
    """(a, b): each node and the smallest that its tile connects it with, within the components of ``placed`` (component, blocks, node, n, home, and the column ``load``).

    A component of several blocks is dealt out by hash; each two blocks make a tile. ``load`` is bits or content.
    """
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiled = placed.withColumn("block", block).withColumn("other", other)
    ends = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")

    def tile(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "ascending"), ("node", "ascending")])
        node = table.column("node").to_numpy()
        if len(node):  # the row of a document may be repeated
            table = table.filter(pa.array(np.concatenate(([True], node[1:] != node[:-1]))))
        nodes, home, side = (table.column(c).to_numpy() for c in ("node", "home", "block"))
        loads, sets = table.column(load).to_pylist(), None
        if load == "content":
            sets = [np.frombuffer(x, np.uint64) for x in loads]
            loads = [bitmap(s) for s in sets]
        sizes = table.column("n").to_numpy()
        label = tile_links(sizes, alike(loads), home, side, key[1].as_py() != key[2].as_py(), rule, sets)
        least = np.full(len(label), np.iinfo(np.int64).max)
        np.minimum.at(least, label, nodes)
        hub = least[label]
        return pa.table({"a": nodes[hub != nodes], "b": hub[hub != nodes]})

    columns = tiled.select("component", *ends, "block", "node", "n", "home", load)
    return columns.groupBy("component", "i", "j").applyInArrow(tile, "a long, b long")


def blocks_of(members: DataFrame, sets_most: int, shingles_most: int, counted: Column) -> DataFrame:
    """``members`` with the number of blocks of their component."""
    size = F.greatest(F.sum(counted) / shingles_most, F.count("*") / sets_most)
    return members.join(members.groupBy("component").agg(F.ceil(size).cast("int").alias("blocks")), "component")


def nodes_of(sets: DataFrame) -> DataFrame:
    """One row per node: its smallest doc_id, null only if it has no other, the text's tie, size and bands."""
    row = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("row")
    found = sets.where("node is not null").groupBy("node").agg(
        row, F.first("n_shingles").alias("n"), F.first("own").alias("own"), F.first("guest").alias("guest")
    )
    return found.select("row.doc_id", "row.tie", "node", "n", "own", "guest")


def possible_links(sets: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): nodes of a cluster that may link by their bitmaps, enough of them to connect all that may."""
    spots = F.array(
        F.struct(F.col("own").alias("spot"), F.lit(True).alias("home")),
        F.struct(F.col("guest").alias("spot"), F.lit(False).alias("home")),
    )
    spotted = nodes_of(sets).select("doc_id", "tie", "node", "n", F.inline(spots)).where("spot is not null")
    members = spotted.join(clusters.select(F.col("node").alias("spot"), "component"), "spot")
    members = stored(members.select("doc_id", "tie", "node", "n", "home", "component"), "members")
    some_home = members.groupBy("component").agg(F.max("home").alias("any")).where("any").select("component")
    members = members.join(some_home, "component")  # guests alone belong to the band below
    placed = blocks_of(members, TILE_SETS, TILE_BITMAPS, F.least("n", F.lit(MOST_BITS // 2)))
    per_doc = placed.groupBy("doc_id", "tie", F.col("node").alias("of")).agg(F.collect_list(F.struct("component", "home", "blocks")).alias("spots"))
    if members.count() <= BROADCAST_MEMBERS:
        per_doc = F.broadcast(per_doc)
    described = sets.select("doc_id", "tie", "node", F.col("n_shingles").alias("n"), "bits")
    marked = described.join(per_doc, same_row(described, per_doc) & (F.col("node") == F.col("of")))
    return in_tiles(marked.select("node", "n", "bits", F.inline("spots")), "bits", rule)


def verified_links(docs: DataFrame, sets: DataFrame, groups: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): nodes of a group that link, enough of them to connect all that are connected."""
    members = stored(nodes_of(sets).select("doc_id", "tie", "node", "n").join(groups, "node"), "members")
    per_doc = blocks_of(members, TILE_SETS, TILE_SHINGLES, F.col("n")).select("doc_id", "tie", "node", "n", "component", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rule.width)
        for part, texts in text_chunks(batches):
            nodes, found = part.column("node").to_pylist(), shingler(texts)
            real = [len(s) > 0 and digest(s) == node for node, s in zip(nodes, found)]  # hashes of texts may repeat
            part = part.filter(pa.array(real))
            content = pa.array([s.tobytes() for s, ok in zip(found, real) if ok], pa.binary())
            yield rows(**{c: part.column(c) for c in ("node", "n", "component", "blocks")}, content=content)

    texts = keyed(docs).where("text is not null")
    if members.count() <= BROADCAST_MEMBERS:  # beyond, the texts are shuffled to them
        per_doc = F.broadcast(per_doc)
    joined = texts.join(per_doc, same_row(texts, per_doc)).select("node", "n", "component", "blocks", "text")
    whole = joined.mapInArrow(run, "node long, n long, component long, blocks int, content binary")
    return in_tiles(whole.withColumn("home", F.lit(True)), "content", rule)


def jaccard_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    component_id is the smallest doc_id that links reach. A null or empty text, or one
    without words, has no shingles and is its own component; with fewer words than the
    width, the whole sequence is one shingle. Rows with equal texts are one component,
    repeated rows keep their rows. A null doc_id never names a component: such a row gets the
    smallest id it reaches by an equal text, or null. Other columns are ignored. Set names and shingles are 64-bit
    hashes. An empty table gives an empty result.
    """
    sets = stored(describe_sets(docs, rule), "sets")
    common = common_shingles(docs, sets.count(), rule)
    clusters = connected_components(candidate_edges(docs, rule, common), "clusters")
    groups = connected_components(possible_links(sets, clusters, rule), "groups")
    links = verified_links(docs, sets, groups, rule)
    linked = connected_components(links, "links").withColumnRenamed("component", "group")
    grouped = sets.join(linked, "node", "left").select("doc_id", "n_shingles", F.coalesce("group", "node").alias("group"))
    first = grouped.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    first = stored(first.where("n > 1").drop("n"), "firsts")  # written, so that a large group can be split in the join
    found = grouped.join(first, "group", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
