"""Exact joins of near-equal shingle sets with signature trees.

1. Every document's set of word shingles becomes hashes of 64 bits; equal sets
   are one class from here on, known by a digest of 128 bits.
2. Routing. Two linked sets differ in at most k shingles, so of m > k parts of
   the shingles' value range m - k at least are equal in both. A set sends a
   signature of each part for its size level, and for the next level when a
   linked set may belong there; a set with so many empty parts that only empty
   ones may be equal also sends its single shingles. Sets that share a signature
   get linked to the smallest of them, and the components of those links, the
   clusters, hold every true link.
3. Only sets in clusters travel. A cluster's sets stand in a tree whose nodes
   hold the OR of their bitmaps and their size range. Two nodes are walked
   together, and left when their sizes are too far apart or when the bits they
   share can't make up the overlap that a link needs. Pairs of sets that remain
   are compared exactly, unless they are already in one component.
   A cluster too large for one task is routed once more: its sets order their
   shingles by how often they stand in such clusters, those of one set first, and
   two linked sets share one of the first of each (prefix filter), so again no true link is lost, while
   sets that only share frequent passages part.
4. A cluster still too large for one task is cut into blocks that share a few pivot
   sets. Blocks are compared with each other only where the cluster still has
   more than one component.

Hot signatures are settled within each batch before the shuffle, so one
signature sends one row a batch. Rows travel packed, in ten bytes each: what is cut
off a signature or a digest makes clusters larger at worst, and loses no link.

Defined results: null, empty and wordless texts have no shingles and are linked
with nothing; a null doc_id is a document of its own with no component; repeated
rows are one class and share its component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm import sketch
from tempora.llm.components import components
from tempora.llm.textkit import BYTE_BASE, SPACE_WORDS, U64, WORD_BASE, WORD_BASE_2, Words, binary, blocks, id_and_text, lean, materialise, mix, read_table, release, window_hash

#: A block of a cluster holds about so many sets, and bytes of sets.
BLOCK_SETS, BLOCK_BYTES = 4096, 16 << 20
#: Sets of a cut cluster that stand in each of its blocks, on average.
PIVOTS = 8
FANOUT = 8
#: A signature and its sender travel in so many bytes; each shuffle partition gets about so many buckets of them.
SIGNATURE_BYTES, NODE_BYTES, BUCKETS = 5, 5, 4
#: Cells in which the shingles of large clusters are counted for their order.
CELLS = 1 << 18
#: Members of clusters that are broadcast at most (about 60 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 500_000


class Rule:
    """Links sets of `size`-word shingles with overlap / union >= percent / 100."""

    def __init__(self, size: int, percent: int):
        self.size, self.percent = size, percent
        self.floors = [1]
        while self.floors[-1] < 1 << 40:
            self.floors.append(int(1.5 * self.floors[-1]) + 1)
        self.levels = np.array(self.floors)

    def differing(self, level: np.ndarray) -> np.ndarray:
        """Most shingles in which linked sets of that level can differ."""
        largest = self.levels[level + 1] - 1
        return 2 * largest * (100 - self.percent) // (100 + self.percent)

    def overlap(self, sizes: np.ndarray) -> np.ndarray:
        """Least overlap of linked sets whose sizes sum up to that."""
        return -(-sizes * self.percent // (100 + self.percent))


class Sets:
    """Distinct shingles of a block's documents: hashes sorted by document and value."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int):
        words = Words(data, offsets, SPACE_WORDS, lower=True)
        hashes = words.hashes()
        at = words.windows(size)
        document = np.searchsorted(words.first, at, "right") - 1
        values = window_hash(hashes, at, size)
        short = np.flatnonzero((words.counts > 0) & (words.counts < size))
        # a shorter sequence is one shingle, told apart by its length
        for n in range(1, size):
            own = short[words.counts[short] == n]
            values = np.concatenate((values, window_hash(hashes, words.first[own], n)))
            document = np.concatenate((document, own))
        order = np.lexsort((values, document))
        values, document = values[order], document[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = (values[1:] != values[:-1]) | (document[1:] != document[:-1])
        self.values, self.document = values[fresh], document[fresh]
        self.counts = np.bincount(self.document, minlength=len(words.counts))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))

    def digest(self, base: int) -> np.ndarray:
        total = np.zeros(len(self.counts), U64)
        np.add.at(total, self.document, mix(self.values * U64(base) + U64(base)))
        return mix(total + self.counts.astype(U64))

    def signatures(self, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
        """Signatures and the documents that send them."""
        n = self.counts
        level = np.searchsorted(rule.levels, np.maximum(n, 1), "right") - 1
        found, senders = [], []
        for step in (0, 1):
            own = level + step
            k = rule.differing(own)
            sends = (n > 0) & (k > 0)
            if step:  # only where a linked larger set can be of that level
                sends &= 100 * n >= rule.percent * rule.levels[own]
            # a few parts more than k + 1, so that hardly a set is sparse
            parts = np.where(sends, k + 2 + k // 8, 0)
            begin = np.concatenate(([0], np.cumsum(parts)))
            mine = sends[self.document]
            document, values = self.document[mine], self.values[mine]
            part = (mix(values + U64(0x632BE59BD9B4E019)) >> U64(33)).astype(np.int64) * parts[document] >> 31
            slot = begin[document] + part
            total = np.zeros(int(begin[-1]), U64)
            np.add.at(total, slot, mix(values * U64(WORD_BASE_2)))
            filled = np.bincount(slot, minlength=int(begin[-1])) > 0
            owner = np.repeat(np.arange(len(n)), parts)
            number = np.arange(int(begin[-1])) - begin[owner]
            stamp = mix(own.astype(U64)[owner] << U64(40) | number.astype(U64))
            found.append(mix(total + stamp)[filled])
            senders.append(owner[filled])
            full = np.bincount(owner[filled], minlength=len(n))
            sparse = (sends & (full <= k))[self.document]
            found.append(mix(self.values[sparse] ^ mix(own.astype(U64) + U64(BYTE_BASE))[self.document[sparse]]))
            senders.append(self.document[sparse])
        return np.concatenate(found), np.concatenate(senders)


def _set_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, int, Sets]]:
    for batch in batches:
        data, offsets = binary(batch.column(1))
        for a, b in blocks(offsets):
            yield batch.slice(a, b - a), a, Sets(data, offsets[a : b + 1], size)


def set_classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles and the two halves of the set's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, sets in _set_batches(batches, rule.size):
            columns = [batch.column(0), pa.array(sets.counts.astype(np.int64)), pa.array(sets.digest(WORD_BASE).view(np.int64)), pa.array(sets.digest(BYTE_BASE).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "d1", "d2"])

    return id_and_text(docs).mapInArrow(lean(run), "doc_id long, n_shingles long, d1 long, d2 long")


def _node(digest: np.ndarray) -> np.ndarray:
    """The 40 bits by which signatures name a set; sets that agree in them share a cluster at worst."""
    return digest.view(U64) >> U64(64 - 8 * NODE_BYTES)


def signature_rows(docs: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """Signatures of a batch dealt to buckets, packed; links that the batch shows by itself, as pairs of nodes.

    A packed row is SIGNATURE_BYTES of the signature and NODE_BYTES of its sender. The
    bucket comes from other bits, so what meets in it agrees in those as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, sets in _set_batches(iter([batch]), rule.size):
                signature, sender = sets.signatures(rule)
                found.append((signature, _node(sets.digest(WORD_BASE))[sender]))
            if found:
                yield _dealt(*(np.concatenate(x) for x in zip(*found, strict=True)), buckets)

    return id_and_text(docs).mapInArrow(lean(run), "bucket int, packed binary, pairs binary")


def cluster_links(docs: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of nodes (a, b) that share a signature with the smallest of its senders."""
    buckets = _buckets(docs.sparkSession)
    return _met(signature_rows(docs, rule, buckets))


def _buckets(spark: SparkSession) -> int:
    return BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _met(rows: DataFrame) -> DataFrame:
    """Pairs of nodes of signatures that were dealt to buckets."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, packed, pairs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(bucket, []).append(packed)
                if pairs:
                    yield _node_pairs(np.frombuffer(pairs, np.int64).reshape(2, -1))
        while held:
            yield _node_pairs(_shared(*_unpacked(b"".join(held.popitem()[1]))))

    return rows.repartition("bucket").mapInArrow(lean(meet), "a long, b long").distinct()


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all sets of a column, and how many each set has."""
    data, offsets = binary(column)
    return data[offsets[0] : offsets[-1]].view(U64), np.diff(offsets) // 8


def prefix_links(sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of nodes (a, b) of one cluster that share one of their first shingles, rarest first.

    Linked sets overlap in at least percent / 100 of each, so one of the first n - overlap + 1
    of each is common, in any order that all share. Shingles of one set only come first, and
    link nothing; a fuller sketch takes some of them for repeated ones, and loses no link.
    """

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield _values(batch.column(2))[0]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            total += np.bincount((_values(batch.column(2))[0] % U64(CELLS)).astype(np.int64), minlength=CELLS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["cell", "n"])

    counted = sets.mapInArrow(lean(count), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most CELLS rows
    often = np.zeros(CELLS, np.int64)
    often[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    shared, buckets = sets.sparkSession.sparkContext.broadcast(often), _buckets(sets.sparkSession)
    several = sketch.repeated(sets, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, n = _values(batch.column(2))
            first = np.concatenate(([0], np.cumsum(n)))
            owner = np.repeat(np.arange(len(n)), n)
            counts = np.where(sketch.estimated_repeated(values, several.value), shared.value[(values % U64(CELLS)).astype(np.int64)], 0)
            order = np.lexsort((values, counts, owner))
            front = np.arange(len(values)) - first[owner] < (n + n * -rule.percent // 100 + 1)[owner]
            owner, values = owner[front], values[order][front]
            cluster = batch.column(3).to_numpy().view(U64)
            yield _dealt(mix(values + mix(cluster)[owner]), _node(batch.column(1).to_numpy())[owner], buckets)

    return _met(sets.mapInArrow(lean(run), "bucket int, packed binary, pairs binary"))


def _parted(docs: DataFrame, members: DataFrame, large: DataFrame, rule: Rule) -> DataFrame:
    """The members with the smaller clusters into which the prefix filter parts the large ones; written once."""
    wide = materialise(members.join(large.select("cluster"), "cluster"))
    sets = _with_sets(docs, wide, rule).select("representative", "d1", "shingles", "cluster")
    parts = components(prefix_links(sets, rule), "a", "b").withColumnRenamed("component", "cluster")
    release(docs.sparkSession)
    named = wide.drop("cluster").withColumn("node", F.shiftrightunsigned("d1", 64 - 8 * NODE_BYTES)).join(parts, "node")
    rest = members.join(large.select("cluster"), "cluster", "left_anti")
    return materialise(rest.unionByName(named.select(*rest.columns)))


def _shared(signature: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Pairs of a node and the smallest node with the same signature."""
    order = np.argsort(signature)
    signature, node = signature[order], node[order]
    same = signature[1:] == signature[:-1]
    often = np.concatenate((same, [False])) | np.concatenate(([False], same))
    if not often.any():
        return np.zeros((2, 0), np.int64)
    signature, node = signature[often], node[often]
    first = np.flatnonzero(np.concatenate(([True], signature[1:] != signature[:-1])))
    lowest = np.repeat(np.minimum.reduceat(node, first), np.diff(np.concatenate((first, [len(node)]))))
    linked = node != lowest
    return np.unique(np.stack((node[linked], lowest[linked])).view(np.int64), axis=1) if linked.any() else np.zeros((2, 0), np.int64)


def _node_pairs(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _dealt(signature: np.ndarray, node: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One open row a signature, by bucket; the links that the batch itself shows stand in the first row."""
    pairs = _shared(signature, node)
    order = np.lexsort((node, signature))
    signature, node = signature[order], node[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = signature[1:] != signature[:-1]
    signature, node = signature[fresh], node[fresh]
    bucket = (mix(signature) >> U64(40)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else np.zeros(1, np.int64)
    rows = np.empty((len(order), SIGNATURE_BYTES + NODE_BYTES), np.uint8)
    rows[:, :SIGNATURE_BYTES] = signature[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SIGNATURE_BYTES]
    rows[:, SIGNATURE_BYTES:] = node[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :NODE_BYTES]
    packed = [rows[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    links = [pairs.tobytes() if pairs.shape[1] else b"", *[b""] * len(packed)][: len(packed)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]], pa.int32()), pa.array(packed, pa.binary()), pa.array(links, pa.binary())], names=["bucket", "packed", "pairs"])


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(packed, np.uint8).reshape(-1, SIGNATURE_BYTES + NODE_BYTES)
    wide = np.zeros((len(rows), 16), np.uint8)
    wide[:, :SIGNATURE_BYTES] = rows[:, :SIGNATURE_BYTES]
    wide[:, 8 : 8 + NODE_BYTES] = rows[:, SIGNATURE_BYTES:]
    both = wide.view("<u8").astype(U64)
    return both[:, 0], both[:, 1]


class Tree:
    """Sets of one or two groups under nodes with OR-combined bitmaps and size ranges."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray, width: int):
        order = np.array(sorted(members, key=lambda i: (len(sets[i]), sets[i][0] if len(sets[i]) else 0)), np.int64)
        self.leaves = order
        bits = np.zeros((len(order), width), np.uint64)
        excess = np.zeros(len(order), np.int64)
        for row, i in enumerate(order):
            at = (mix(sets[i]) & U64(64 * width - 1)).astype(np.int64)
            flags = np.zeros(64 * width, bool)
            flags[at] = True
            bits[row] = np.packbits(flags, bitorder="little").view(np.uint64)
            excess[row] = len(at) - int(flags.sum())
        sizes = np.array([len(sets[i]) for i in order])
        #: levels from the leaves up: bitmaps, least and most sizes, shingles beyond one a bit
        self.levels = [(bits, sizes, sizes, excess)]
        while len(self.levels[-1][0]) > 1:
            low = self.levels[-1]
            edges = np.arange(0, len(low[0]), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(low[0], edges), np.minimum.reduceat(low[1], edges), np.maximum.reduceat(low[2], edges), np.maximum.reduceat(low[3], edges)))


class Linker:
    """Links between sets, by dual traversal of signature trees with union-find."""

    def __init__(self, sets: list[np.ndarray], rule: Rule, groups: list | None = None):
        self.sets, self.rule = sets, rule
        self.parent = list(range(len(sets)))
        self.found: list[tuple[int, int]] = []
        if groups is not None:  # components known before
            first: dict = {}
            for i, group in enumerate(groups):
                self.parent[i] = first.setdefault(group, i)
        largest = max((len(s) for s in sets), default=1)
        self.width = max(1, min(128, 1 << max(0, (2 * largest - 1).bit_length() - 6)))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def compare(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a == b:
            return
        s, t = self.sets[i], self.sets[j]
        both = len(np.intersect1d(s, t, assume_unique=True))
        if 100 * both >= self.rule.percent * (len(s) + len(t) - both):
            self.parent[max(a, b)] = min(a, b)
            self.found.append((i, j))

    def star(self) -> None:
        """A few sets against all others: joins what is plainly alike in one sweep each."""
        flat = np.concatenate(self.sets)
        edges = np.concatenate(([0], np.cumsum([len(s) for s in self.sets])))
        sizes = np.diff(edges)
        for _ in range(4):
            counts: dict[int, int] = {}
            for i in range(len(self.sets)):
                counts[self.root(i)] = counts.get(self.root(i), 0) + 1
            alone = [i for i in range(len(self.sets)) if counts[self.root(i)] == 1]
            if len(alone) < 2:
                return
            pivot = alone[len(alone) // 2]
            own = self.sets[pivot]
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            both = np.add.reduceat((own[at] == flat).astype(np.int64), edges[:-1])
            for j in np.flatnonzero(100 * both >= self.rule.percent * (sizes + len(own) - both)):
                a, b = self.root(pivot), self.root(int(j))
                if a != b:
                    self.parent[max(a, b)] = min(a, b)
                    self.found.append((pivot, int(j)))

    def uniform(self, tree: Tree) -> list[np.ndarray]:
        """The component that a node lies in wholly, or -1, level by level."""
        marks = [np.array([self.root(int(i)) for i in tree.leaves])]
        while len(marks[-1]) > 1:
            edges = np.arange(0, len(marks[-1]), FANOUT)
            low, high = np.minimum.reduceat(marks[-1], edges), np.maximum.reduceat(marks[-1], edges)
            marks.append(np.where(low == high, low, -1))
        return marks

    def walk(self, left: Tree, right: Tree) -> None:
        """Compares the leaves of two trees (or of one with itself) that may be linked."""
        same = left is right
        marks, others = self.uniform(left), self.uniform(right)
        top = max(len(left.levels), len(right.levels)) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, i, j = stack.pop()
            at, to = min(level, len(left.levels) - 1), min(level, len(right.levels) - 1)
            a, b = left.levels[at], right.levels[to]
            apart = (marks[at][i] < 0) | (marks[at][i] != others[to][j])
            i, j = i[apart], j[apart]
            shared = np.bitwise_count(a[0][i] & b[0][j]).sum(axis=1, dtype=np.int64) + np.minimum(a[3][i], b[3][j])
            may = (100 * a[2][i] >= self.rule.percent * b[1][j]) & (100 * b[2][j] >= self.rule.percent * a[1][i]) & (shared >= self.rule.overlap(a[1][i] + b[1][j]))
            i, j = i[may], j[may]
            if level == 0:
                for x, y in zip(left.leaves[i].tolist(), right.leaves[j].tolist(), strict=True):
                    if x != y:
                        self.compare(x, y)
                continue
            i, j = _children(i, j, level, left, right)
            if same:
                keep = i <= j
                i, j = i[keep], j[keep]
            # bounded pieces, the first ones on top
            for begin in reversed(range(0, len(i), 4096)):
                stack.append((level - 1, i[begin : begin + 4096], j[begin : begin + 4096]))


def _children(i: np.ndarray, j: np.ndarray, level: int, left: Tree, right: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the next lower level's nodes; a tree without that level stays at its root."""

    def spread(tree: Tree, nodes: np.ndarray) -> np.ndarray:
        if level >= len(tree.levels):
            return nodes[:, None]
        return nodes[:, None] * FANOUT + np.arange(FANOUT)

    a, b = spread(left, i), spread(right, j)
    pairs_a = np.repeat(a, b.shape[1], axis=1).ravel()
    pairs_b = np.tile(b, (1, a.shape[1])).ravel()
    most_a = len(left.levels[min(level - 1, len(left.levels) - 1)][0])
    most_b = len(right.levels[min(level - 1, len(right.levels) - 1)][0])
    keep = (pairs_a < most_a) & (pairs_b < most_b)
    return pairs_a[keep], pairs_b[keep]


def tree_links(sets: list[np.ndarray], rule: Rule, groups: list | None = None, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the components of the sets; side: compare only across two sides."""
    linker = Linker(sets, rule, groups)
    if len(sets) == 2:
        linker.compare(0, 1)
        return linker.found
    if side is None:
        if len(sets) > FANOUT:
            linker.star()
        tree = Tree(sets, np.arange(len(sets)), linker.width)
        linker.walk(tree, tree)
    else:
        left, right = (Tree(sets, np.flatnonzero(side == s), linker.width) for s in (0, 1))
        if len(left.leaves) and len(right.leaves):
            linker.walk(left, right)
    return linker.found


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of consecutive equal keys; the first `keys` columns are the key."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and rows[-1][:keys] != row[:keys]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def linked(docs: DataFrame, size: int = 3, percent: int = 90, block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs."""
    rule = Rule(size, percent)
    release(docs.sparkSession)  # what earlier steps left
    all_rows = materialise(set_classes(docs, rule))
    known = all_rows.where("doc_id is not null")
    classes = known.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("representative"))

    clusters = components(cluster_links(docs.where("doc_id is not null"), rule), "a", "b")
    release(docs.sparkSession)  # the signatures' shuffle is the largest, and over
    named = classes.withColumn("node", F.shiftrightunsigned("d1", 64 - 8 * NODE_BYTES))
    members = materialise(named.join(clusters.withColumnRenamed("component", "cluster"), "node").select("representative", "n_shingles", "d1", "cluster"))
    cut = F.greatest(F.ceil(F.col("sets") / block_sets), F.ceil(8 * F.col("total") / block_bytes)).cast("int")
    large = materialise(_sized(members).where(cut > 1))
    if large.limit(1).count():
        members = _parted(docs, members, large, rule)
    sized = _sized(members)
    members = members.join(sized.select("cluster", "sets", cut.alias("cuts")), "cluster")
    placed = members.withColumn("block", F.pmod(F.xxhash64("representative"), F.col("cuts")).cast("int"))
    pivot = F.pmod(F.xxhash64("representative", F.lit(1)), F.col("sets")) < PIVOTS
    travelling = _with_sets(docs, materialise(placed.withColumn("pivot", pivot)), rule)

    # each block by itself, with the pivots of its cluster
    everywhere = F.when(F.col("pivot") & (F.col("cuts") > 1), F.sequence(F.lit(0), F.col("cuts") - 1)).otherwise(F.array("block"))
    inside = travelling.select("cluster", F.explode(everywhere).alias("part"), "representative", "shingles")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, 2):
            links = tree_links([np.frombuffer(r[3], np.uint64) for r in rows], rule)
            yield _pairs([(rows[i][2], rows[j][2]) for i, j in links])

    links = materialise(inside.repartition("cluster", "part").sortWithinPartitions("cluster", "part").mapInArrow(lean(within), "a long, b long"))
    release(docs.sparkSession)

    # block against block, where a cut cluster is not yet one component
    if sized.where(cut > 1).limit(1).count():
        joined = travelling.where("cuts > 1").join(components(links, "a", "b").withColumnRenamed("node", "representative"), "representative", "left")
        joined = joined.withColumn("component", F.coalesce("component", "representative"))
        open_clusters = joined.groupBy("cluster").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("cluster")
        across = joined.join(open_clusters, "cluster").select("cluster", "block", "representative", "component", "shingles", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")).where("block <> other")
        across = across.select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "representative", "component", "shingles")

        def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _grouped(batches, 3):
                side = np.array([int(r[3] == r[2]) for r in rows])
                links = tree_links([np.frombuffer(r[6], np.uint64) for r in rows], rule, [r[5] for r in rows], side)
                yield _pairs([(rows[i][4], rows[j][4]) for i, j in links])

        links = links.unionByName(across.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high").mapInArrow(lean(between), "a long, b long"))

    tied = components(links, "a", "b")
    named = classes.join(tied.withColumnRenamed("node", "representative"), "representative", "left")
    named = named.select("n_shingles", "d1", "d2", F.coalesce("component", "representative").alias("class_component"))
    out = all_rows.join(named, ["n_shingles", "d1", "d2"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id")).alias("component_id"))


def _sized(members: DataFrame) -> DataFrame:
    """The sets and shingles of every cluster of several sets."""
    return members.groupBy("cluster").agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("total")).where("sets > 1")


def _with_sets(docs: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """Adds the sorted shingle hashes of the representatives; other texts stay where they are."""

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        ids = batch.column(0).to_numpy().view(np.uint64)
        yield np.concatenate((ids, ids))  # twice, so that the sketch tells members from others

    shared = sketch.repeated(members.select("representative"), keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(sketch.estimated_repeated(ids, shared.value)))
            for part, _, sets in _set_batches(iter([batch]), rule.size):
                edges = pa.array((sets.first * 8).astype(np.int32))
                shingles = pa.Array.from_buffers(pa.binary(), len(part), [None, edges.buffers()[1], pa.py_buffer(sets.values.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets.digest(WORD_BASE).view(np.int64)), shingles], names=["representative", "d1", "shingles"])

    rows = id_and_text(docs).where("doc_id is not null").mapInArrow(lean(run), "representative long, d1 long, shingles binary")
    small = members.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(members) if small else members, ["representative", "d1"])


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op3_jaccard": op3_jaccard}
