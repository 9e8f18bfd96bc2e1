"""Hard-negative mining: rows of other labels whose score with an anchor lies in a window below a positive's score.

**Angles.** Of the rows (integer vectors) the angles to ``REFS`` reference directions are stored, the directions being the
rows of smallest hash of each vector length.  The angle between two vectors is at least the difference and at most the
sum of their angles to any direction (and at most the full circle less the sum); the tightest of these over all directions
give an interval of the cosine, and with the product of the norms bounds of the score.  Angles are widened by ``SLACK``
and bounds by one and a share of the norms, more than rounding can move them, so no score lies outside its bounds.

**Blocks.** Rows are dealt to the direction they are nearest to, and in blocks of bounded bytes, sorted by the angle to it;
anchors likewise.  A block keeps the ranges of its angles and norms, so the same bounds hold between blocks: only pairs of
blocks whose scores can count meet, the anchors travelling to the rows.  Inside, each anchor takes the stretch of the sorted angles
that can count, then the rows whose bounds overlap what it looks for, and only those are scored, in whole numbers.

**Steps.** Positives: the block an anchor lies in gives a first threshold, the score of the last of the best found there;
blocks and rows whose upper bound is below it are left out.  Negatives: rows whose bounds overlap one of the windows of
the anchor's positives.  Each block gives at most the wanted number of rows for each anchor and positive, and the best over all
blocks are taken by a window over those.

Rules: rows with a null id, label or vector, or with a null or non-finite component, take no part; nor do rows whose integer
vector has a norm of 2**31 or more, as scores must fit 64 bits.  Rows equal in id, label and vector are one; others may
share an id: each is a row of its own, an anchor's other rows are those with another id, and of equal scores and ids the
smaller hash comes first.  Vectors meet those of their own length only; an empty vector scores 0.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import stored

REFS = 16  # reference directions for each vector length
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 4096  # of a block of rows, at most
ANCHOR_ROWS = 256  # of a block of anchors, at most
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, WHOLE = 30, 90, 100  # a window reaches from LOW to HIGH parts of WHOLE of the positive's score
SCALE = 256  # components are rounded down after multiplication with it
MOST_NORM = 2**31
ANY_SCORE = 2**62  # no score is larger
GRID = 64  # row blocks whose pairs with all anchor blocks are bounded in one group
SLACK = 1e-7  # of angles; arccos of a rounded cosine is off by less
EXACT = 2.0**53  # below it, sums of products of whole numbers are exact in double precision

ROW = "vec_id bigint, label int, dim int, vector binary"
_ROW = pa.schema([("vec_id", pa.int64()), ("label", pa.int32()), ("dim", pa.int32()), ("vector", pa.binary())])


def _whole_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows: vec_id, label, embedding; those that take part, with their vectors as 32-bit whole numbers."""
    for batch in batches:
        out = []
        for vec_id, label, vector in zip(*batch.columns, strict=True):
            if not (vec_id.is_valid and label.is_valid and vector.is_valid) or vector.values.null_count:
                continue
            x = np.floor(SCALE * vector.values.to_numpy().astype(np.float64))
            if np.isfinite(x).all() and np.sqrt((x * x).sum()) < MOST_NORM:
                out.append((vec_id.as_py(), label.as_py(), len(x), x.astype("<i4").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_ROW)], schema=_ROW)


def angles(vectors: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angle of each row to each reference; a right angle where one of them is zero."""
    v, r = vectors.astype(np.float64), references.astype(np.float64)
    norms = np.sqrt((v * v).sum(axis=1))[:, None] * np.sqrt((r * r).sum(axis=1))
    with np.errstate(invalid="ignore", divide="ignore"):
        cosine = np.where(norms > 0, v @ r.T / norms, 0.0)
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _located(references: dict[int, bytes]):
    """Adds the angles to the directions of the row's length, the norm, and the nearest direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                vectors = _matrix(b"".join(v.as_py() for v in part.column(3)), len(part), dim)
                own = angles(vectors, np.frombuffer(references[dim], "<i4").reshape(-1, dim) if dim else np.zeros((1, 0), np.int32))
                norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
                found = [pa.array(norm), pa.array([a.tobytes() for a in own], pa.binary()), pa.array(own.argmin(axis=1).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*part.columns, *found], names=[*part.schema.names, "norm", "angles", "cell"])

    return run


def _matrix(data: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(rows, dim)


_COLUMNS = ("uids", "ids", "labels", "vectors", "norms", "angles", "limits")
_RANGES = ("low", "high"), ("least", "most", "from_score", "to_score")
BLOCK_FIELDS = "block bigint, dim int, cell int, size int, " + ", ".join([f"{k} binary" for k in _COLUMNS] + [f"{k} array<double>" for k in _RANGES[0]] + [f"{k} double" for k in _RANGES[1]])
_BLOCK = pa.schema([
    ("block", pa.int64()), ("dim", pa.int32()), ("cell", pa.int32()), ("size", pa.int32()), *((k, pa.binary()) for k in _COLUMNS),
    *((k, pa.list_(pa.float64())) for k in _RANGES[0]), *((k, pa.float64()) for k in _RANGES[1]),
])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: block, cell, uid, vec_id, label, dim, vector, norm, angles, limits.  One row for each block,
    its rows sorted by the angle to the block's direction."""

    def block_of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        n, dim, cell = len(rows), rows.column("dim")[0].as_py(), rows.column("cell")[0].as_py()

        def column(name, kind):
            return rows.column(name).to_numpy().astype(kind)

        def joined(name, kind, width):
            return np.frombuffer(b"".join(x.as_py() for x in rows.column(name)), kind).reshape(n, width)

        angle = joined("angles", "<f8", len(rows.column("angles")[0].as_py()) // 8)
        order = np.argsort(angle[:, cell], kind="stable")
        norm = column("norm", "<f8")
        limits = joined("limits", "<i8", len(rows.column("limits")[0].as_py()) // 8)
        windows = limits.reshape(-1, 2)
        windows = windows[windows[:, 0] <= windows[:, 1]].astype(np.float64)
        scores = (windows[:, 0].min(), windows[:, 1].max()) if len(windows) else (np.inf, -np.inf)
        one = [
            rows.column("block")[0].as_py(), dim, cell, n, *(column(k, kind)[order].tobytes() for k, kind in (("uid", "<i8"), ("vec_id", "<i8"), ("label", "<i4"))),
            joined("vector", "<i4", dim)[order].tobytes(), norm[order].tobytes(), angle[order].tobytes(), limits[order].tobytes(),
            angle.min(axis=0).tolist(), angle.max(axis=0).tolist(), norm.min(), norm.max(), *scores,
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(one, _BLOCK, strict=True)], schema=_BLOCK)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        block = batch.column(0).to_numpy()
        cut = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)]))
        for low, high in zip(cut[:-1], cut[1:], strict=True):
            part = batch.slice(low, high - low)
            if held and held[0].column(0)[0] != part.column(0)[0]:
                yield block_of(held)
                held = []
            if len(part):
                held.append(part)
    if held:
        yield block_of(held)


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """One row per block of at most about ``most`` rows and ``BLOCK_BYTES`` of one length and direction."""
    room = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(BLOCK_BYTES) / (4 * F.col("dim") + 8 * REFS + 32))))
    sizes = rows.groupBy("dim", "cell").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / room)).select("dim", "cell", "parts")
    block = F.xxhash64("dim", "cell", F.pmod(F.col("uid"), F.col("parts"))).alias("block")
    dealt = rows.join(sizes, ["dim", "cell"]).select(block, "cell", "uid", "vec_id", "label", "dim", "vector", "norm", "angles", "limits")
    return stored(dealt.repartition("block").sortWithinPartitions("block").mapInArrow(_packed, BLOCK_FIELDS))


class Side:
    """The rows of a block."""

    def __init__(self, row: dict):
        n = row["size"]
        self.uids, self.ids = (np.frombuffer(row[k], "<i8") for k in ("uids", "ids"))
        self.labels, self.norms = np.frombuffer(row["labels"], "<i4"), np.frombuffer(row["norms"], "<f8")
        self.vectors = _matrix(row["vectors"], n, row["dim"])
        self.angles = np.frombuffer(row["angles"], "<f8").reshape(n, -1)
        self.limits = np.frombuffer(row["limits"], "<i8").reshape(n, -1)

    def bounds(self, norm: float, angle: np.ndarray, rows) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that ``rows`` can have with a vector of that norm and those angles."""
        own = self.angles[rows]
        total = own + angle
        near = np.maximum(np.abs(own - angle).max(axis=1) - SLACK, 0.0)
        far = np.minimum(np.minimum(total, 2 * np.pi - total).min(axis=1) + SLACK, np.pi)
        product = self.norms[rows] * norm
        spare = product * 1e-9 + 1.0
        return product * np.cos(far) - spare, product * np.cos(near) + spare

    def stretch(self, least: float, norm: float, angle: np.ndarray, cell: int) -> slice:
        """The rows, by the sorted angle to the block's direction, that can score ``least`` with such a vector."""
        product = self.norms.max() * norm
        if not (0 < least < product):  # all rows may, or none can be told by the angle alone
            return slice(0, len(self.ids))
        reach = np.arccos(least / product) + SLACK
        at = self.angles[:, cell]
        return slice(*np.searchsorted(at, [angle[cell] - reach, angle[cell] + reach + SLACK]))

    def scores(self, vector: np.ndarray, norm: float, rows: np.ndarray) -> np.ndarray:
        """Inner products with ``rows``, exactly."""
        if norm * self.norms.max() < EXACT:
            return (self.vectors[rows].astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
        return self.vectors[rows].astype(np.int64) @ vector.astype(np.int64)


def first(scores: np.ndarray, ids: np.ndarray, uids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores, equal ones by id."""
    at = np.arange(len(scores))
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    return at[np.lexsort((uids[at], ids[at], -scores[at]))[:most]]


def _best_positives(anchors: Side, rows: Side, cell: int) -> Iterator[tuple]:
    for a in range(len(anchors.ids)):
        least, norm, angle = int(anchors.limits[a, 0]), anchors.norms[a], anchors.angles[a]
        part = rows.stretch(float(least), norm, angle, cell)
        at = part.start + np.flatnonzero((rows.labels[part] == anchors.labels[a]) & (rows.ids[part] != anchors.ids[a]))
        at = at[rows.bounds(norm, angle, at)[1] >= least]
        score = rows.scores(anchors.vectors[a], norm, at)
        for k in first(score, rows.ids[at], rows.uids[at], POSITIVES).tolist():
            yield anchors.uids[a], anchors.ids[a], rows.uids[at[k]], rows.ids[at[k]], score[k]


def _in_windows(anchors: Side, rows: Side, cell: int) -> Iterator[tuple]:
    for a in range(len(anchors.ids)):
        windows = anchors.limits[a].reshape(-1, 2)  # least and greatest score, of the positives in their order
        windows = windows[windows[:, 0] <= windows[:, 1]]
        if not len(windows):
            continue
        norm, angle, least, most = anchors.norms[a], anchors.angles[a], windows[:, 0].min(), windows[:, 1].max()
        part = rows.stretch(float(least), norm, angle, cell)
        at = part.start + np.flatnonzero(rows.labels[part] != anchors.labels[a])
        low, high = rows.bounds(norm, angle, at)
        at = at[(low <= most) & (high >= least)]
        score = rows.scores(anchors.vectors[a], norm, at)
        for place, (least, most) in enumerate(anchors.limits[a].reshape(-1, 2).tolist()):
            inside = np.flatnonzero((score >= least) & (score <= most))
            for k in inside[first(score[inside], rows.ids[at[inside]], rows.uids[at[inside]], NEGATIVES)].tolist():
                yield anchors.uids[a], place + 1, rows.uids[at[k]], rows.ids[at[k]], score[k]


def _met(work, names: list[str]):
    """Rows sorted by block and kind: a block of rows, then the blocks of anchors that come to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, cell = None, 0
        for batch in batches:
            for k in range(len(batch)):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                if row["kind"] == 0:
                    rows, cell = Side(row), row["cell"]
                    continue
                found = list(work(Side(row), rows, cell))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in range(len(names))], names=names)

    return run


def _meet(pairs: DataFrame, anchors: DataFrame, blocks: DataFrame, work, names: list[str]) -> DataFrame:
    """``work`` on the block pairs (``block``, ``anchors``)."""
    fields = ["dim", "cell", "size", *_COLUMNS]
    come = pairs.join(anchors.withColumnRenamed("block", "anchors"), "anchors").select("block", F.lit(1).alias("kind"), *fields)
    stay = blocks.join(pairs.select("block").distinct(), "block", "left_semi").select("block", F.lit(0).alias("kind"), *fields)
    both = stay.unionByName(come).repartition("block").sortWithinPartitions("block", "kind")
    return both.mapInArrow(_met(work, names), ", ".join(f"{n} bigint" for n in names))


def _pairs(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs of an anchor block and a row block whose scores can lie where the anchors look: block, anchors, highest.

    The anchors are a stated set of queries that all rows are searched for; the pairs are of blocks, a few numbers each,
    and dealt out in groups of ``GRID`` row blocks.
    """
    groups = max(1, -(-blocks.count() // GRID))
    group = F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group")
    theirs = blocks.select(group, "block", "dim", "low", "high", "least", "most")
    ours = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("group"), F.col("block").alias("anchors"), "dim",
        F.col("low").alias("l"), F.col("high").alias("h"), F.col("least").alias("n0"), F.col("most").alias("n1"), "from_score", "to_score",
    )
    both = ours.join(theirs, ["group", "dim"])
    gap = F.zip_with("l", "high", lambda a, b: a - b), F.zip_with("low", "h", lambda a, b: a - b)
    near = F.greatest(F.array_max(gap[0]), F.array_max(gap[1]), F.lit(0.0)) - SLACK
    total = F.zip_with("h", "high", lambda a, b: a + b), F.zip_with("l", "low", lambda a, b: 2 * np.pi - a - b)
    far = F.least(F.array_min(total[0]), F.array_min(total[1]), F.lit(np.pi)) + SLACK
    top, bottom = F.cos(F.greatest(near, F.lit(0.0))), F.cos(F.least(far, F.lit(np.pi)))
    product, small = F.col("n1") * F.col("most"), F.col("n0") * F.col("least")
    spare = product * 1e-9 + 1.0
    lowest = F.when(bottom < 0, product).otherwise(small) * bottom - spare
    highest = F.when(top < 0, small).otherwise(product) * top + spare
    bounded = both.select("block", "anchors", lowest.alias("lowest"), highest.alias("highest"), "from_score", "to_score")
    return stored(bounded.where("highest >= from_score and lowest <= to_score").select("block", "anchors", "highest"))


def _limited(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows with the ``limits`` of their ``uid``, a list of whole numbers, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([v.values.to_numpy().astype("<i8").tobytes() for v in batch.column("limits")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=batch.schema.names)

    fields = ["uid", "vec_id", "label", "dim", "vector", "norm", "angles", "cell"]
    joined = rows.select(*fields).join(limits, "uid").select(*fields, "limits")
    return joined.mapInArrow(run, f"uid bigint, {ROW}, norm double, angles binary, cell int, limits binary")


def located_rows(rows: DataFrame) -> DataFrame:
    """The rows that take part (vec_id, label, embedding), once each, with their angles to the reference directions."""
    given = rows.select(F.col("vec_id").cast("bigint"), F.col("label").cast("int"), F.col("embedding").cast("array<double>"))
    parts = stored(given.mapInArrow(_whole_numbers, ROW).distinct().withColumn("uid", F.xxhash64("vec_id", "label", "vector")))
    smallest = Window.partitionBy("dim").orderBy("uid")
    chosen = parts.select("dim", "uid", "vector").withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= REFS)
    references: dict[int, bytes] = {}
    for r in chosen.orderBy("dim", "place").collect():
        references[r["dim"]] = references.get(r["dim"], b"") + bytes(r["vector"])
    found = parts.select(*[f.name for f in _ROW], "uid").mapInArrow(_located(references), f"{ROW}, uid bigint, norm double, angles binary, cell int")
    return stored(found.withColumn("limits", F.lit(b"")))


def best_positives(asked: DataFrame, blocks: DataFrame) -> DataFrame:
    """The best rows of the same label for each anchor: anchor (its uid), anchor_id, uid, id, score, place from 1."""
    names = ["anchor", "anchor_id", "uid", "id", "score"]
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "uid")).alias("place")

    def limits(least):
        return F.array(least, F.lit(ANY_SCORE).cast("bigint")).alias("limits")

    # The block with the highest bound gives a first threshold for each anchor of a block.
    start = _blocks(_limited(asked, asked.select("uid", limits(F.lit(-ANY_SCORE).cast("bigint")))), ANCHOR_ROWS)
    home = _pairs(start, blocks).groupBy("anchors").agg(F.max_by("block", F.struct("highest", "block")).alias("block"))
    known = _meet(home, start, blocks, _best_positives, names).select("*", place).where(F.col("place") == POSITIVES)
    known = asked.select("uid").join(known.select(F.col("anchor").alias("uid"), "score"), "uid", "left")
    known = known.select("uid", limits(F.coalesce("score", F.lit(-ANY_SCORE).cast("bigint"))))
    anchors = _blocks(_limited(asked, known), ANCHOR_ROWS)
    return _meet(_pairs(anchors, blocks), anchors, blocks, _best_positives, names).select("*", place).where(F.col("place") <= POSITIVES)


def hard_negatives(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """``rows``: vec_id, label, embedding; anchors are the rows for which ``is_anchor`` holds.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    located = located_rows(rows)
    blocks = _blocks(located, BLOCK_ROWS)
    asked = located.where(is_anchor)
    positives = stored(best_positives(asked, blocks))

    # A window in whole numbers, computed without overflow; below a score of 0 there is none.
    window = F.array(F.expr(f"score div {WHOLE} * {LOW} + (score % {WHOLE} * {LOW} + {WHOLE - 1}) div {WHOLE}"), F.expr(f"score div {WHOLE} * {HIGH} + score % {WHOLE} * {HIGH} div {WHOLE}"))
    none = F.array(F.lit(1).cast("bigint"), F.lit(0).cast("bigint"))
    by_place = positives.groupBy(F.col("anchor").alias("uid")).agg(F.map_from_entries(F.collect_list(F.struct("place", F.when(F.col("score") >= 0, window).otherwise(none)))).alias("of"))
    limits = by_place.select("uid", F.flatten(F.array(*[F.coalesce(F.try_element_at("of", F.lit(k + 1)), none) for k in range(POSITIVES)])).alias("limits"))
    anchors = _blocks(_limited(asked, limits), ANCHOR_ROWS)
    found = _meet(_pairs(anchors, blocks), anchors, blocks, _in_windows, ["anchor", "place", "uid", "id", "score"])
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "uid"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= NEGATIVES)
    found = found.select("anchor", F.col("place").cast("int").alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    wanted = positives.select("anchor", "place", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return wanted.join(found, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
