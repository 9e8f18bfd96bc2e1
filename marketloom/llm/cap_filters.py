"""Embedding near-duplicates by spherical-cap filters.

Every filter is a direction, and a vector belongs to those whose cosine with it exceeds a threshold.  Directions form
a random product code: each half of the (randomly rotated) space has ``B`` random unit words, and each pair of words is
a direction, so all directions over the threshold are listed from two short sorted lists instead of ``B * B`` products.
Vectors that share a direction are compared exactly, in double precision.

``B`` is set so that there are ``SPREAD`` directions per distinct vector, hence the chance meetings per direction stay
the same at every size.  The threshold comes from simulated random pairs at exactly the similarity asked for: all but
``MISS`` of them share a direction.  A rotation makes that hold for any data; pairs above the similarity meet more often.

Equal vectors are one class with a count and are never paired up.  A direction's members are compared in double
precision, in pairs of chunks of ``CHUNK`` by hash, and give one edge per member.  All links lie within the components of
these edges, and each vector in one component, so links are counted there, again chunk against chunk: no pair leaves a
task or is counted twice.  Vectors travel as 32-bit numbers where those are exact.

Rules: null, zero, empty and non-finite vectors, and those with null components, link with nothing; neither do vectors
of different lengths.  Classes are told apart by a 64-bit hash of the vector, not by ids, so rows that share an id but not
the vector each have the links of their own vector; a component is named by its smallest id.  Rows with a null id have no
links, a null component, and are kept.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored
from marketloom.llm.graph import components

SPREAD = 64  # directions per distinct vector
MISS = 0.02  # simulated pairs at the threshold that share no direction
TRIALS = 1000  # simulated pairs
CHUNK = 256  # members of a direction that are compared at once


class Code:
    """A product code over ``dim`` dimensions for about ``n`` vectors; the same arguments give the same code."""

    def __init__(self, dim: int, n: int, similarity: float, seed: int = 20):
        rng = np.random.default_rng([seed, dim])
        self.dim, self.size = dim, max(8, math.isqrt(SPREAD * n) + 1)
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cut = max(1, dim // 2)
        unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        self.words = [unit(rng.standard_normal((self.size, k))) for k in (self.cut, dim - self.cut) if k]
        x = unit(rng.standard_normal((TRIALS, dim)))
        y = rng.standard_normal((TRIALS, dim))
        y = unit(y - (y * x).sum(axis=1, keepdims=True) * x) if dim > 1 else x
        y = similarity * x + math.sqrt(max(0.0, 1 - similarity**2)) * y
        best = []
        for low in range(0, TRIALS, 100):
            a, b = self.scores(x[low : low + 100]), self.scores(y[low : low + 100])
            top = []
            for s, t in zip(a, b, strict=True):  # the best shared direction is among the words that suit both
                k = np.argsort(-(s + t), axis=1)[:, :48]
                top.append((np.take_along_axis(s, k, 1), np.take_along_axis(t, k, 1)))
            (s1, t1), (s2, t2) = top if len(top) == 2 else (top[0], (np.zeros((len(a[0]), 1)),) * 2)
            best.append(np.minimum(s1[:, :, None] + s2[:, None, :], t1[:, :, None] + t2[:, None, :]).max(axis=(1, 2)))
        self.threshold = float(np.quantile(np.concatenate(best), MISS))

    def scores(self, unit: np.ndarray) -> list[np.ndarray]:
        turned = unit @ self.turn
        return [h @ w.T for h, w in zip((turned[:, : self.cut], turned[:, self.cut :]), self.words)]

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted direction numbers of each vector."""
        out = []
        for low in range(0, len(unit), 256):
            parts = self.scores(unit[low : low + 256])
            if len(parts) == 1:
                out += [np.flatnonzero(s >= self.threshold) for s in parts[0]]
                continue
            for s1, s2 in zip(*parts, strict=True):
                order = np.argsort(-s2)
                firsts = np.flatnonzero(s1 >= self.threshold - s2[order[0]])
                counts = np.searchsorted(-s2[order], s1[firsts] - self.threshold, side="right")
                seconds = order[np.concatenate([np.arange(c) for c in counts])] if len(counts) else np.empty(0, int)
                out.append(np.sort(np.repeat(firsts, counts) * self.size + seconds))
        return out


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, length and hash of each vector; no hash for one that links with nothing."""
    for batch in batches:
        dims, prints = [], []
        for value in batch.column(1):
            v = np.array(value.as_py() or [], dtype=object)
            v = np.array([], float) if any(x is None for x in v) else v.astype(float)
            usable = len(v) and np.isfinite(v).all() and np.isfinite(n := np.linalg.norm(v)) and n > 0
            dims.append(len(v))
            prints.append(hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() if usable else None)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims, pa.int32()), pa.array(prints, pa.binary())], names=["vec_id", "embedding", "dim", "print"])


def _directions(codes: dict[int, Code]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column(0).to_pylist(), [np.empty(0, np.int64)] * len(batch)
            vectors = batch.column(1).to_pylist()
            for dim in {len(v) for v in vectors}:
                at = [k for k, v in enumerate(vectors) if len(v) == dim]
                x = np.array([vectors[k] for k in at])
                for k, f in zip(at, codes[dim].decode(x / np.linalg.norm(x, axis=1, keepdims=True)), strict=True):
                    found[k] = f.astype(np.int64) + (dim << 44)
            lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32), np.concatenate(found or [np.empty(0, np.int64)]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["node", "found"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes: 32-bit numbers if they are exact, else 64-bit."""
    for batch in batches:
        out = []
        for value in batch.column(1):
            v = np.array(value.as_py(), float)
            with np.errstate(over="ignore"):
                short = v.astype(np.float32)
            out.append((b"s" + short.tobytes()) if (short == v).all() else b"d" + v.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.binary())], names=["node", "copies", "vector"])


def _unpacked(data: list[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(d, np.float32 if d[:1] == b"s" else np.float64, offset=1).astype(float) for d in data])


def linked_pairs(rows: list[tuple], across: bool, similarity: float) -> np.ndarray:
    """Which rows (node, copies, chunk, vector) link; ``across``: only pairs of two chunks count."""
    x = _unpacked([r[3] for r in rows])
    norm = np.linalg.norm(x, axis=1)
    linked = (x @ x.T) / np.outer(norm, norm) >= similarity
    np.fill_diagonal(linked, False)
    if across:
        chunk = np.array([r[2] for r in rows])
        linked &= chunk[:, None] != chunk[None, :]
    return linked


def roots(rows: list[tuple], across: bool, similarity: float) -> list[tuple[int, int]]:
    """Per row with a link its node and the smallest node reached."""
    linked = linked_pairs(rows, across, similarity)
    label, before = np.array([r[0] for r in rows]), None
    while before is None or (label != before).any():
        before = label
        label = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
    return [(r[0], int(m)) for r, m, some in zip(rows, label, linked.any(axis=1), strict=True) if some]


def counts(rows: list[tuple], across: bool, similarity: float) -> list[tuple[int, int]]:
    """Per row with a link its node and how many vectors it links with."""
    linked = linked_pairs(rows, across, similarity)
    found = linked @ np.array([r[1] for r in rows])
    return [(r[0], int(n)) for r, n in zip(rows, found, strict=True) if n]


def _in_groups(rows: DataFrame, work, similarity: float, name: str) -> DataFrame:
    """``work`` on each group: ``rows`` are group, i, j, node, copies, chunk, vector, in pairs of chunks i and j."""
    schema = pa.schema([("node", pa.int64()), (name, pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def result():
            found = work([r[3:] for r in held], held[0][1] != held[0][2], similarity) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    yield result()
                    held = []
                held.append(row)
        if held:
            yield result()

    keys = rows.columns[:3]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, f"node bigint, `{name}` bigint")


def _in_chunks(members: DataFrame, group: str, payload: DataFrame) -> DataFrame:
    """Members (group, node) of groups of two and more, once for every pair of chunks that theirs is in."""
    sizes = stored(members.groupBy(group).agg(F.count("*").alias("n")).where("n > 1").select(group, F.ceil(F.col("n") / CHUNK).alias("chunks")))
    rows = members.join(sizes, group).withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    rows = rows.select(group, F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "node", "chunk")
    return rows.join(payload, "node").select(group, "i", "j", "node", "copies", "chunk", "vector")


def near_duplicates(vectors: DataFrame, similarity: float = 0.95) -> DataFrame:
    """Per row of ``vectors`` (``vec_id``, ``embedding``): vec_id, n_links, component_id, kept."""
    source = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    prints = stored(source.mapInArrow(_prints, "vec_id bigint, embedding array<double>, dim int, print binary"))
    usable = prints.where("print is not null and vec_id is not null")
    classes = usable.groupBy("print").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.min("dim").alias("dim"))
    classes = stored(classes.withColumn("node", F.xxhash64("print")))

    # One code per vector length; lengths are few.
    codes = {d: Code(d, n, similarity) for d, n in classes.groupBy("dim").count().collect()}
    kept = classes.select("print", F.col("least").alias("vec_id"), "node", "copies")
    firsts = usable.join(kept, ["print", "vec_id"]).select("node", "embedding", "copies")
    firsts = stored(firsts.dropDuplicates(["node"]))
    payload = stored(firsts.mapInArrow(_packed, "node bigint, copies bigint, vector binary"))
    found = stored(firsts.select("node", "embedding").mapInArrow(_directions(codes), "node bigint, found array<bigint>"))
    members = found.select(F.explode("found").alias("direction"), "node")
    reached = components(_in_groups(_in_chunks(members, "direction", payload), roots, similarity, "root"))

    members = stored(reached.union(reached.select(F.col("component").alias("node"), "component").distinct()).select("component", "node"))
    links = _in_groups(_in_chunks(members, "component", payload), counts, similarity, "links")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    names = members.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = classes.join(counted, "node", "left").join(members.join(names, "component"), "node", "left")
    of_class = stored(of_class.select("print", F.coalesce("component_id", "least").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = prints.select("vec_id", "print").join(of_class, "print", "left")
    linked = F.col("component_id").isNotNull() & F.col("vec_id").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.when(linked, F.col("n_links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
