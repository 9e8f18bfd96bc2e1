"""N-gram Jaccard join: shingle sets are points of group counts in R-trees, cut into tiles that hold every link.

**Points.** A document's set holds its distinct word shingles as 64-bit hashes.  The shingles are dealt to ``DIMS``
groups, and the counts of the groups are the document's point.  Two sets share at most the sum over the groups of the
smaller count, so the summed minima of two points, or of a point and the corner of an R-tree node, bound the overlap from
above; pairs that survive are verified on the sets themselves.

**Candidates.** All shingles have one order, the ``COMMON`` ones that most documents share last.  Of a set of ``n``, a
partner of similarity ``s`` must hold at least ``ceil(s * n)``, so two sets that link share one of their first
``n - ceil(s * n) + 1`` shingles.  Any order gives right results; this one keeps shared passages and phrases out of the
prefixes.  Documents with a prefix shingle in common form a group (one group for all shingles with the same members).  The
R-tree over a group's points keeps the pairs whose summed minima leave a link possible; sets that share a phrase and
little else are told apart there.  Documents that such pairs connect form one candidate family, each document belongs to
one, and an R-tree join on the sets runs inside each.  Groups of more than ``MEET`` documents connect without that test,
which can make a family larger than it need be, and never loses a pair.

**Large families** are cut into chunks of ``CHUNK`` documents, or ``CHUNK_SHINGLES`` shingles, by hash, each joined with a copy of the family's first
document, which ties the chunks together.  Where a family still has several components, its sets are rewritten as
differences ``D`` from one reference set (what most documents of its first chunk hold; any set gives right results).
``A`` and ``B`` differ by what ``D(A)`` and ``D(B)`` do not share, so a pair links if the two differences are short
enough together, and then both link with the document of shortest difference, or else the differences share an element.
Hence one star per family, and a prefix filter for the rest: elements are
ordered by how many documents of the family have them, and if the overlap of ``D(A)`` and ``D(B)`` must be ``o``, they share
one of their first ``|D| - o + 1`` elements.  ``o`` follows from both differences' lengths, so prefixes are taken per class
of the partner's length.  Documents with their own edits share no such element, so the work is linear however many
copies of one text there are.  Tiles with the same members are joined once, in pairs of chunks; that is quadratic, over
the chunk size, only in documents that share rare edits and lie in different components.

Rules: A-Z are lower-cased; words are runs other than the six ASCII white-space characters; a text with fewer words than
a shingle takes has the whole sequence as its one shingle; a text without words, or null, has an empty set and links
with nothing.  Equal sets link (one representative goes on).  Rows with a null id link with nothing and have a null
component; rows that share an id are one node.  Other columns are ignored.  Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import mixed, stored, utf8
from marketloom.llm.graph import components

DIMS = 256  # groups whose counts are the coordinates of a point: few shingles in each, or unrelated sets look alike
LEAF = 8  # points of an R-tree leaf
CHUNK, CHUNK_SHINGLES = 2048, 1 << 21  # documents of a family that are joined at once, and their shingles, about
MEET = 1024  # documents with a common prefix shingle up to which their points are compared
COMMON = 1 << 16  # shingles at the end of the order, at most; the driver and each task hold them
SEVERAL, BATCH = 3, 1 << 19  # a shingle is counted where so many of the texts of a batch of so many shingles hold it


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = text.lower().split()  # of bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    acc = np.full(n, min(len(h), width), np.uint64)
    for k in range(min(len(h), width)):
        acc = mixed(acc + h[k : k + n])
    acc.sort()
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]


def prefix(s: np.ndarray, similarity: Fraction, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set: by hash, the ``common`` ones (sorted) behind all others by their ``rank``."""
    n = len(s)
    first = n + (-n * similarity.numerator) // similarity.denominator + 1 if n else 0
    at = np.searchsorted(common, s)
    last = common[np.minimum(at, len(common) - 1)] == s if len(common) else np.zeros(n, bool)
    rare = s[~last][:first]
    behind = at[last]
    return np.concatenate((rare, common[behind[np.argsort(rank[behind])]][: first - len(rare)]))


def point(s: np.ndarray) -> np.ndarray:
    """How many shingles of a set each of the groups has."""
    return np.bincount((s & np.uint64(DIMS - 1)).astype(np.int64), minlength=DIMS)


def _bytes(point: np.ndarray) -> bytes:
    """A point in one byte a coordinate where that is enough, in four else."""
    return point.astype("u1" if point.max() < 256 else "<i4").tobytes()


def _point(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "u1" if len(data) == DIMS else "<i4").astype(np.int32)


def _shared(width: int):
    """Shingles that several different texts of a batch hold, with their number there."""

    def counted(sets: dict) -> pa.RecordBatch:
        value, n = np.unique(np.concatenate([*sets.values(), np.empty(0, np.uint64)]), return_counts=True)
        keep = n >= SEVERAL
        return pa.RecordBatch.from_arrays([pa.array(value[keep].view(np.int64)), pa.array(n[keep])], names=["shingle", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held = {}, 0
        for batch in batches:
            for text in batch.column(0):
                own = shingle_set(text.as_py(), width)
                key = xxhash.xxh3_128_digest(own.tobytes())
                if key not in sets:
                    sets[key] = own
                    held += len(own)
                if held >= BATCH:
                    yield counted(sets)
                    sets, held = {}, 0
        yield counted(sets)

    return run


def common_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that most texts share, sorted, and their ranks from the least to the most shared one."""
    found = texts.select("text").mapInArrow(_shared(width), "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    most = found.orderBy(F.desc("n"), "shingle").limit(COMMON).collect()
    value, n = np.array([r[0] for r in most], np.int64).view(np.uint64), np.array([r[1] for r in most], np.int64)
    rank = np.empty(len(value), np.int64)
    rank[np.lexsort((value, n))] = np.arange(len(value))
    order = np.argsort(value)
    return value[order], rank[order]


def _describe(width: int, similarity: Fraction, common: np.ndarray, rank: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("point", pa.binary()), ("sigs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 1000):
                part = batch.slice(low, 1000)
                sets = [shingle_set(t.as_py(), width) for t in part.column(1)]
                sigs = [prefix(s, similarity, common, rank).view(np.int64) for s in sets]
                lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(x) for x in sigs]))).astype(np.int32), np.concatenate(sigs))
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                points = [_bytes(point(s)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array(points, pa.binary()), lists], schema=schema
                )

    return run


class Tree:
    """A packed R-tree over count points: leaves of similar points, and the corners of the nodes above them.

    Two sets can link only if ``overlap * scale`` reaches their weights' sum; a node keeps its smallest weight.
    """

    def __init__(self, points: np.ndarray, weights: np.ndarray, scale: int, fan: int = LEAF):
        spread = np.argsort(-points.var(axis=0), kind="stable")[:2]
        self.order = np.lexsort((points[:, spread[1]], points[:, spread[0]], points.sum(axis=1) // 8))
        self.levels, self.fan, self.scale = [], fan, scale
        top, least = points[self.order], weights[self.order]
        while True:
            self.levels.append((top, least))
            if len(top) <= fan:
                break
            cut = np.arange(0, len(top), fan)
            top, least = np.maximum.reduceat(top, cut), np.minimum.reduceat(least, cut)

    def near(self, point: np.ndarray, weight: int) -> np.ndarray:
        """Points whose summed minima with ``point`` leave a link possible."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, least = self.levels[depth]
            at = at[np.minimum(top[at], point).sum(axis=1) * self.scale >= weight + least[at]]
            if depth:
                at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


def join_sets(ids: list, sets: list[np.ndarray], weights: list[int], scale: int, known: list, left: np.ndarray, right: np.ndarray) -> list[tuple]:
    """Links that connect all that link between ``left`` and ``right`` rows, beyond those ``known`` (equal labels) already."""
    weights = np.array(weights)
    label = np.unique(known, return_inverse=True)[1]
    points = np.stack([point(s) for s in sets])
    tree = Tree(points[right], weights[right], scale)
    found = []
    for i in left:
        if (label[right] == label[i]).all():
            continue
        near = right[tree.near(points[i], weights[i])]
        for j in near[label[near] != label[i]]:
            if label[j] != label[i] and len(np.intersect1d(sets[i], sets[j], assume_unique=True)) * scale >= weights[i] + weights[j]:
                label[label == label[j]] = label[i]
                found.append((ids[i], ids[j]))
    return found


def _met(rows: list[tuple], num: int, den: int) -> list[tuple]:
    """Rows: sig, 0, doc_id, n_shingles, point.  Pairs that connect the documents whose points leave a link possible."""
    ids, weights = [r[2] for r in rows], np.array([num * r[3] for r in rows])
    points = np.stack([_point(r[4]) for r in rows])
    tree = Tree(points, weights, num + den)
    label, found = np.arange(len(rows)), []
    for i in range(len(rows)):
        for j in tree.near(points[i], weights[i]):
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                found.append((ids[i], ids[j]))
    return found


def _in_groups(work, schema: pa.Schema):
    """A function over batches sorted by their first two columns that runs ``work`` on each group's rows."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:2] != row[:2]:
                    yield batch_of(work(held))
                    held = []
                held.append(row)
        if held:
            yield batch_of(work(held))

    return run


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _join_texts(rows: list[tuple], width: int, num: int, den: int) -> list[tuple]:
    """Rows: family, part, node, text."""
    rows.sort(key=lambda r: r[2])
    sets = [shingle_set(r[3], width) for r in rows]
    ids, all_rows = [r[2] for r in rows], np.arange(len(rows))
    return join_sets(ids, sets, [num * len(s) for s in sets], num + den, ids, all_rows, all_rows)


def _join_differences(rows: list[tuple], num: int, den: int) -> list[tuple]:
    """Rows: tile, part, chunk, whether the part has two chunks, node, label, weight, difference."""
    rows.sort(key=lambda r: (r[2], r[4]))
    chunk, at = np.array([r[2] for r in rows]), np.arange(len(rows))
    left, right = (at[chunk == chunk[0]], at[chunk != chunk[0]]) if rows[0][3] else (at, at)
    if not len(right) or len({r[5] for r in rows}) == 1:
        return []
    sets = [np.array(r[7], np.int64).view(np.uint64) for r in rows]
    return join_sets([r[4] for r in rows], sets, [r[6] for r in rows], 2 * (num + den), [r[5] for r in rows], left, right)


def _reference(rows: list[tuple], width: int) -> list[tuple]:
    """Rows: family, 0, text.  The shingles that most of them hold."""
    all_sets, counts = np.unique(np.concatenate([shingle_set(r[2], width) for r in rows]), return_counts=True)
    return [(rows[0][0], all_sets[2 * counts > len(rows)].view(np.int64).tolist())]


def _differences(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.slice(low, 500)
                weights, found = [], []
                for text, reference in zip(part.column(2), part.column(3)):
                    own = shingle_set(text.as_py(), width)
                    apart = np.setxor1d(own, reference.values.to_numpy().view(np.uint64), assume_unique=True)
                    weights.append(len(apart) * (num + den) - len(own) * (den - num))
                    found.append(apart.view(np.int64))
                lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32), np.concatenate(found or [np.empty(0, np.int64)]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(weights, pa.int64()), lists], names=["family", "node", "weight", "apart"])

    return run


def _grouped(rows: DataFrame, work, schema: pa.Schema, ddl: str) -> DataFrame:
    keys = rows.columns[:2]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_in_groups(work, schema), ddl)


def _with_labels(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    return nodes.join(labels.select(F.col("node"), F.col("component").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node"))


def jaccard_components(docs: DataFrame, similarity: Fraction = Fraction(9, 10), width: int = 3) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_shingles, component_id."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text"))
    num, den = similarity.numerator, similarity.denominator
    fields = "doc_id bigint, n_shingles bigint, print binary, point binary, sigs array<bigint>"
    rows = stored(texts.mapInArrow(_describe(width, similarity, *common_shingles(texts, width)), fields))

    some = rows.where("print is not null and doc_id is not null")
    first = stored(some.groupBy("print").agg(F.min("doc_id").alias("node")))
    copies = some.select("doc_id", "print").join(first, "print").where("doc_id <> node").select("doc_id", F.col("node"))
    kept = first.select("print", F.col("node").alias("doc_id"))
    kept = stored(some.join(kept, ["doc_id", "print"], "left_semi").dropDuplicates(["doc_id", "print"]))
    sigs = kept.select("doc_id", F.explode("sigs").alias("sig")).distinct()
    groups = sigs.groupBy("sig").agg(F.count("*").alias("n"), F.min("doc_id").alias("center"), F.bit_xor(F.xxhash64("doc_id")).alias("members"))
    # Shingles with the same members are one group.
    groups = groups.where("n > 1").groupBy("n", "center", "members").agg(F.min("sig").alias("sig"))
    groups = stored(groups.select("sig", "n", "center"))
    in_groups = stored(sigs.join(groups, "sig").select("sig", "doc_id", "n", "center"))
    small = in_groups.where(F.col("n") <= MEET).join(kept.select("doc_id", "n_shingles", "point"), "doc_id")
    small = small.select("sig", F.lit(0).alias("part"), "doc_id", "n_shingles", "point")
    met = _grouped(small, lambda rows: _met(rows, num, den), LINKS, "a bigint, b bigint")
    family = components(met.union(in_groups.where((F.col("n") > MEET) & (F.col("doc_id") != F.col("center"))).select("doc_id", "center")))
    nodes = family.union(family.select("component", "component").distinct())
    nodes = nodes.join(kept.groupBy(F.col("doc_id").alias("node")).agg(F.sum("n_shingles").alias("shingles")), "node")
    nodes = stored(nodes.select(F.col("component").alias("family"), "node", "shingles"))
    chunks = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("shingles") / CHUNK_SHINGLES)).alias("chunks")
    members = nodes.join(stored(nodes.groupBy("family").agg(chunks)), "family").select("family", "node", "chunks")
    part = F.pmod(F.xxhash64("node"), F.col("chunks"))
    parts = F.when(F.col("node") == F.col("family"), F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).otherwise(F.array(part))
    members = stored(members.select("family", "node", "chunks", F.explode(parts).alias("part")))

    # Rows that share an id are one node: every text of a node takes part.
    texts = stored(texts.join(members.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text"))
    chunks = members.select("family", "part", "node").join(texts, "node").select("family", "part", "node", "text")
    within = _grouped(chunks, lambda rows: _join_texts(rows, width, num, den), LINKS, "a bigint, b bigint")
    found = components(within.union(copies))

    # Families of several chunks that still have several components.
    large = members.where("chunks > 1")
    labelled = _with_labels(large.select("family", "node").distinct(), found)
    open_families = labelled.groupBy("family").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("family")
    open_families = stored(open_families)
    if not open_families.isEmpty():
        large = stored(large.join(open_families, "family", "left_semi"))
        found = _across(large, texts, found, width, num, den)
    out = rows.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _across(members: DataFrame, texts: DataFrame, found: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``found`` with the links between documents of different chunks."""
    whole = pa.schema([("family", pa.int64()), ("reference", pa.list_(pa.int64()))])
    first = members.where("part = 0").join(texts, "node").select("family", "part", "text")
    reference = stored(_grouped(first, lambda rows: _reference(rows, width), whole, "family bigint, reference array<bigint>"))
    nodes = members.select("family", "node").distinct().join(texts, "node")
    apart = nodes.join(reference, "family").select("family", "node", "text", "reference")
    apart = stored(apart.mapInArrow(_differences(width, num, den), "family bigint, node bigint, weight bigint, apart array<bigint>"))

    least = stored(apart.groupBy("family").agg(F.min(F.struct("weight", "node")).alias("least")))
    short = apart.select("family", "node", "weight").join(least, "family").where("weight + least.weight <= 0 and node <> least.node")
    found = components(found.union(short.select("node", "least.node")))

    apart = stored(_with_labels(apart, found))
    elements = apart.select("family", "node", "label", F.explode("apart").alias("element"))
    live = elements.groupBy("family", "element").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    live = stored(live.where("low < high").select("family", "element", "n"))
    ordered = elements.join(live, ["family", "element"]).groupBy("family", "node").agg(F.sort_array(F.collect_list(F.struct("n", "element"))).alias("live"))
    shingles = (F.size("apart") * (num + den) - F.col("weight")) / (den - num)
    steps = apart.groupBy("family").agg((F.greatest(F.lit(1), F.floor(F.min(shingles) * (den - num) / (num + den) / 4)) * 2 * (num + den)).alias("step"))
    prefixed = apart.select("family", "node", "label", "weight", F.size("apart").alias("length")).join(ordered, ["family", "node"]).join(stored(steps), "family")
    prefixed = prefixed.select("family", "node", "label", "weight", "length", "step", F.col("live.element").alias("live"))
    elements = stored(prefixed.mapInArrow(_prefixes(num, den), "family bigint, node bigint, label bigint, element bigint, low bigint, high bigint"))

    key = ["family", "element", "low", "high"]
    tiles = elements.groupBy(*key).agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("members"), F.min("label").alias("first"), F.max("label").alias("last"))
    tiles = tiles.where("first < last").groupBy("family", "n", "members").agg(F.min(F.struct("element", "low", "high")).alias("t"))
    tiles = stored(tiles.select("family", "t.*", F.ceil(F.col("n") / CHUNK).alias("chunks")))

    own = elements.join(tiles, key).withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    own = own.select(F.xxhash64(*key).alias("tile"), F.xxhash64(F.least("chunk", "other"), F.greatest("chunk", "other")).alias("part"), "chunk", (F.col("chunk") != F.col("other")).alias("two"), "node")
    pairs = own.join(apart.select("node", "label", "weight", "apart"), "node").select("tile", "part", "chunk", "two", "node", "label", "weight", "apart")
    return components(found.union(_grouped(pairs, lambda rows: _join_differences(rows, num, den), LINKS, "a bigint, b bigint")))


def prefix_lengths(weight: int, length: int, step: int, num: int, den: int) -> list[tuple[int, int]]:
    """For each class of partner weights with which a link needs common elements: the class, and how many of the first
    elements are to be looked at.  A class ``c`` has the weights from ``c * step`` on; a link needs an overlap of the two
    weights' sum by ``2 * (num + den)``, which neither difference may be too short for."""
    scale = 2 * (num + den)
    shingles = (length * (num + den) - weight) // (den - num)
    longest = shingles * den // num  # shingles of a partner, at most
    out = []
    c = min(-weight // step, (weight - 2 * (den - num) * longest) // step) - 2
    while weight + c * step <= scale * length:
        overlap = max(1, -(-(weight + c * step) // scale))
        partner = ((c + 1) * step + (den - num) * longest) // (num + den)
        if weight + (c + 1) * step > 0 and overlap <= min(length, partner):
            out.append((c, length - overlap + 1))
        c += 1
    return out


def _prefixes(num: int, den: int):
    """Rows: family, node, label, weight, length, step, and the elements that others share, rarest first."""
    names = ["family", "node", "label", "element", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 200):
                out = []
                for family, node, label, weight, length, step, live in zip(*(c.to_pylist() for c in batch.slice(low, 200).columns), strict=True):
                    own = weight // step
                    for c, first in prefix_lengths(weight, length, step, num, den):
                        # Elements that nobody else has come first in the order.
                        out += [(family, node, label, e, min(own, c), max(own, c)) for e in live[: max(0, first - (length - len(live)))]]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(len(names))], names=names)

    return run
