"""Vector code compression by Lloyd's rounds over partition-local cover trees.

Components become integers floor(``scale`` * x), vectors are cut into ``parts`` equal consecutive parts,
and each part position gets a codebook of ``entries`` entries: at first the parts of the smallest ids,
then ``rounds`` times the floored means of the parts nearest to each entry. All sums are whole numbers,
so the result depends neither on the partitioning nor on the order.

Cover trees. Vectors are dealt into chunks of ``chunk`` rows, and every chunk holds one cover tree per
part position, built once and written. A node at level i covers points within 2**i of its centre, which
is itself one of them; the centres of its children are more than 2**(i-1) apart. Nodes keep their
radius and the cumulative sum and count of their points. In each round a node whose nearest entry
stays nearest for its whole ball, by the triangle inequality, is assigned at once with its sums;
other nodes are replaced by their children, and only points of leaves that stay ambiguous are
compared one by one. Bounds carry a margin for rounding; comparisons that decide are exact.

Scale: a tree is bounded by its chunk, a round sends one row of sums per entry and task, and the driver
sees ``parts`` * ``entries`` sums and means, whatever the number of vectors. Label sums are partially
aggregated; labels that hold more than one row in 1,000 (fewer than 1,000 labels) meet their rows
by a broadcast, the others by a join.

Defined cases: vectors that are null or hold null or non-finite components are left out, and so are
empty ones, those with another number of components than the smallest id's, and those with a component
of 2**18 or more either way, for which sums could pass 64 bits. A number of components that ``parts``
does not divide is refused. A null id comes after all others; rows with the same id and vector all
stay. Fewer vectors than ``entries`` give as many entries; ties go to the lower index; an entry without
points stays. Null labels are one label. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyshelf.llm import shared

_LIMIT = 1 << 18


@dataclass(frozen=True)
class Settings:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    chunk: int = 1024
    leaf: int = 8


class CoverTree:
    """A cover tree over the rows of ``points`` (whole numbers as float64) as flat arrays.

    The points of node j are ``order[start[j]:stop[j]]``; its children are nodes first[j] .. last[j] - 1,
    none for a leaf.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.order = points, np.arange(len(points))
        spread = _root(((points - points[0]) ** 2).sum(axis=1).max())
        nodes: list[tuple[int, int, int, float, int, int]] = [(0, 0, len(points), spread, 0, 0)]
        levels = [_level(spread)]
        at = 0
        while at < len(nodes):
            centre, start, stop, radius, _, _ = nodes[at]
            if stop - start > leaf and radius > 0:
                # Levels that would divide nothing are passed over.
                level = min(levels[at], _level(radius)) - 1
                ranges = self._divide(start, stop, level)
                nodes[at] = (centre, start, stop, radius, len(nodes), len(nodes) + len(ranges))
                for a, b, r in ranges:
                    nodes.append((int(self.order[a]), a, b, r, 0, 0))
                    levels.append(level)
            at += 1
        table = np.array(nodes, np.float64)
        self.centre, self.start, self.stop, self.first, self.last = (table[:, i].astype(np.int64) for i in (0, 1, 2, 4, 5))
        self.radius = table[:, 3]
        self.running = np.vstack([np.zeros(points.shape[1]), np.cumsum(points[self.order], axis=0)]).astype(np.int64)

    def sums(self, nodes: np.ndarray) -> np.ndarray:
        """Sums of the points of each node."""
        return self.running[self.stop[nodes]] - self.running[self.start[nodes]]

    def _divide(self, start: int, stop: int, level: int) -> list[tuple[int, int, float]]:
        """Reorders the range into one range per new centre: points within 2**level of the first that covers them."""
        left, out, reach, done = self.order[start:stop].copy(), [], 4.0**level, start
        while left.size:
            apart = ((self.points[left] - self.points[left[0]]) ** 2).sum(axis=1)
            near = apart <= reach
            taken = left[near]
            self.order[done : done + taken.size] = taken
            out.append((done, done + taken.size, _root(apart[near].max())))
            done += taken.size
            left = left[~near]
        return out

    def assign(self, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(nodes, entry) assigned as a whole, and at last (points, entry) one by one, as pairs of arrays."""
        front = np.zeros(1, np.int64)
        lone = []
        while front.size:
            near = squared(self.points[self.centre[front]], book)
            best = near.argmin(axis=1)
            rows = np.arange(front.size)
            least = np.sqrt(near[rows, best])
            # With one entry the second is as far as numbers go.
            near[rows, best] = np.inf if near.dtype == np.float64 else np.iinfo(np.int64).max
            second = np.sqrt(near.min(axis=1))
            radius = self.radius[front]
            sure = (len(book) == 1) | (radius == 0) | ((least + radius) * (1 + 1e-9) + 1e-6 < second - radius)
            yield front[sure], best[sure]
            rest = front[~sure]
            ends = self.first[rest] == self.last[rest]
            lone += [self.order[a:b] for a, b in zip(self.start[rest[ends]], self.stop[rest[ends]])]
            rest = rest[~ends]
            front = np.concatenate([np.arange(a, b) for a, b in zip(self.first[rest], self.last[rest])] or [rest])
        points = np.concatenate(lone) if lone else front
        yield points, squared(self.points[points], book).argmin(axis=1) if points.size else points


def squared(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of whole numbers, exact: as float64 where 52 bits hold them, else as int64."""
    high = max(np.abs(points).max(initial=0), np.abs(book).max(initial=0))
    if high * high * 4 * max(1, points.shape[1]) < 2**52:
        return (points**2).sum(axis=1)[:, None] - 2 * (points @ book.T) + (book**2).sum(axis=1)[None, :]
    p, b = points.astype(np.int64), book.astype(np.int64)
    return np.stack([((p - row) ** 2).sum(axis=1) for row in b], axis=1)


def _root(value: float) -> float:
    return float(np.sqrt(np.float64(value)))


def _level(radius: float) -> int:
    """The least level whose balls reach ``radius``."""
    return int(np.ceil(np.log2(max(radius, 1.0))))


def _kept(vectors: DataFrame, vector: str, settings: Settings) -> DataFrame:
    """(row, v) of usable vectors as scaled whole numbers; ``row`` holds the other columns."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(float(_LIMIT)))
    usable = vectors.select(shared.packed(vectors, but=[vector]), v.alias("v")).where(F.size("v") > 0)
    usable = usable.where(~F.exists("v", bad))
    return usable.select("doc", F.transform("v", lambda x: F.floor(x * settings.scale).cast("int")).alias("v"))


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches of one task as tables of ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        while count >= rows:
            whole = pa.Table.from_batches(held)
            yield whole.slice(0, rows)
            held = whole.slice(rows).to_batches()
            count -= rows
    if count:
        yield pa.Table.from_batches(held)


def _planted(kept: DataFrame, dims: int, settings: Settings) -> DataFrame:
    """(rows, trees): chunks of rows with a cover tree per part position."""
    schema = T.StructType(
        [T.StructField("rows", T.ArrayType(kept.schema["doc"].dataType)), T.StructField("trees", T.BinaryType())]
    )
    width = dims // settings.parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, settings.chunk):
            rows = chunk.column("doc").combine_chunks()
            flat = chunk.column("v").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dims)
            trees = [CoverTree(np.ascontiguousarray(flat[:, p * width : (p + 1) * width]), settings.leaf) for p in range(settings.parts)]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), pa.array([pickle.dumps(trees)], pa.binary())],
                ["rows", "trees"],
            )

    return kept.where(F.size("v") == dims).mapInArrow(run, schema)


def _round_sums(trees: DataFrame, books: Sequence[np.ndarray]) -> list[tuple]:
    """(part, entry, count, sums) of the parts nearest to each entry."""
    width = books[0].shape[1]
    names = [f"s{i}" for i in range(width)]
    schema = "part int, entry int, n long, " + ", ".join(f"{s} long" for s in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), width), np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for blob in batch.column("trees"):
                for part, tree in enumerate(pickle.loads(blob.as_py())):
                    found = list(tree.assign(books[part]))
                    for nodes, entry in found[:-1]:
                        np.add.at(sums[part], entry, tree.sums(nodes))
                        np.add.at(counts[part], entry, tree.stop[nodes] - tree.start[nodes])
                    points, entry = found[-1]
                    np.add.at(sums[part], entry, tree.points[points].astype(np.int64))
                    np.add.at(counts[part], entry, 1)
        for part, count in enumerate(counts):
            used = np.flatnonzero(count)
            columns = [np.full(used.size, part, np.int32), used.astype(np.int32), count[used], *sums[part][used].T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["part", "entry", "n", *names])

    found = trees.select("trees").mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n"), *(F.sum(s) for s in names))
    return [(r[0], r[1], r[2], tuple(r[3:])) for r in found.collect()]


def _coded(trees: DataFrame, books: Sequence[np.ndarray]) -> DataFrame:
    """(row, code, error) of every vector, by the nearest entries."""
    row = trees.schema["rows"].dataType.elementType
    schema = T.StructType(
        [T.StructField("doc", row), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, blob in enumerate(batch.column("trees")):
                rows = batch.column("rows")[i].values
                codes = np.zeros((len(rows), len(books)), np.uint8)
                error = np.zeros(len(rows), np.int64)
                for part, tree in enumerate(pickle.loads(blob.as_py())):
                    nearest = np.zeros(len(rows), np.int64)
                    found = list(tree.assign(books[part]))
                    for nodes, entry in found[:-1]:
                        for node, e in zip(nodes.tolist(), entry.tolist()):
                            nearest[tree.order[tree.start[node] : tree.stop[node]]] = e
                    nearest[found[-1][0]] = found[-1][1]
                    codes[:, part] = nearest
                    error += ((tree.points.astype(np.int64) - books[part].astype(np.int64)[nearest]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())], schema.names
                )

    return trees.mapInArrow(run, schema)


def train(trees: DataFrame, books: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """The codebooks after ``rounds`` rounds."""
    for _ in range(rounds):
        books = [b.copy() for b in books]
        for part, entry, count, sums in _round_sums(trees, books):
            books[part][entry] = [s // count for s in sums]
    return books


def digest(books: Sequence[np.ndarray]) -> str:
    return sha256(",".join(str(int(x)) for b in books for x in b.reshape(-1)).encode()).hexdigest()


def _label_errors(coded: DataFrame, scratch: shared.Scratch) -> DataFrame:
    """``coded`` with label_error, the error summed over rows of one ``label``."""
    key = F.struct(F.col("label").isNull().alias("none"), F.col("label").cast("string").alias("text"))
    keyed = coded.withColumn("key", F.when(F.col("label").isNull(), F.struct(F.lit(True).alias("none"), F.lit("").alias("text"))).otherwise(key))
    sums = scratch.write(keyed.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    everything = sums.agg(F.sum("n")).first()[0] or 0
    # Fewer than 1,000 labels can hold more than a thousandth of all rows.
    common = F.broadcast(sums.where(F.col("n") * 1000 > everything).select("key", "label_error"))
    rare = sums.where(F.col("n") * 1000 <= everything).select("key", "label_error")
    return keyed.join(common, "key").unionByName(keyed.join(common, "key", "left_anti").join(rare, "key")).drop("key")


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error, label_error) of every usable vector, and the final codebooks.

    Tables are written and the rounds run when this is called.
    """
    scratch = shared.Scratch(vectors.sparkSession, "codes")
    named = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    kept = scratch.write(_kept(named, "vector", settings))
    back = shared.unpacked(named, but=["vector"])
    schema = T.StructType(
        [
            T.StructField("vec_id", named.schema["vec_id"].dataType),
            T.StructField("label", named.schema["label"].dataType),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
            T.StructField("label_error", T.LongType()),
        ]
    )
    ordered = kept.select(back["vec_id"], "v").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    smallest = ordered.limit(1).collect()
    if not smallest:
        return vectors.sparkSession.createDataFrame([], schema), []
    dims = len(smallest[0]["v"])
    if dims % settings.parts:
        raise ValueError(f"{dims} components cannot be cut into {settings.parts} equal parts")
    seeds = np.array([r["v"] for r in ordered.where(F.size("v") == dims).limit(settings.entries).collect()], np.float64)
    books = np.split(seeds, settings.parts, axis=1)
    trees = scratch.write(_planted(kept, dims, settings))
    books = train(trees, books, settings.rounds)
    coded = scratch.write(_coded(trees, books)).select(back["vec_id"], back["label"], "code", "error")
    return _label_errors(coded, scratch).select(*schema.names), books


def decode(codes: DataFrame, books: Sequence[np.ndarray], scale: int = 1024) -> DataFrame:
    """``codes`` with ``vector``, the entries named by ``code`` scaled back."""
    tables = F.array(*(F.array(*(F.array(*(F.lit(float(x) / scale) for x in e)) for e in b)) for b in books))
    entry = lambda i: F.conv(F.substring(F.col("code"), F.lit(2) * i + 1, F.lit(2)), 16, 10).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.lit(len(books) - 1)), lambda i: F.get(F.get(tables, i), entry(i)))
    return codes.withColumn("vector", F.flatten(pieces))
