"""Near-duplicate vectors: randomised-rotation binary codes, bounds, and exact recomputation.

Vectors are scaled to length 1 and turned by random rotations with a fixed seed. The signs of a
turned vector are its code; the inner product of the vector with its code, as a unit vector, is the
stored correction factor. For another vector, given by 4 bits for each turned component, the product
with the code divided by the factor is an unbiased estimate of the cosine, off by more than
``sigmas`` * sqrt((1 - factor^2) / factor^2 / (dims - 1)) only with vanishing probability.

1. Vectors with equal components are one vertex with a count.
2. Further sign bits, from rotations of their own, are cut into tables of ``b`` bits; vectors with
   equal bits in a table share a bucket there. b follows the number of vectors, the number of tables
   follows from the wanted recall of pairs at the threshold.
3. In each bucket codes and 4-bit components alone decide which vectors have a pair that may reach
   the threshold; only those are joined with their full components, bucket by bucket.
4. There pairs are recomputed in double precision. A pair counts in the first table in which its
   vectors share a bucket, so it counts once; only pairs that tie a bucket together are put out for
   the connected components, never all pairs.

Buckets above ``block`` vectors are compared block by block, each pair of blocks in a group of its
own, so no group exceeds two blocks.

Defined cases: a vector that is null, empty or zero, or holds a null or non-finite component, links
with nothing and is its own component, kept; vectors of different length never link; repeated rows
with one id are vectors of their own; a null id counts as a vector and names no component; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyshelf.llm import shared


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.95
    #: Share of pairs exactly at the threshold that may stay unfound; closer pairs are found more often.
    missed: float = 1e-3
    #: Vectors in a bucket, on average.
    bucket: int = 64
    sigmas: float = 5.0
    block: int = 2048
    seed: int = 20240501


@lru_cache(maxsize=64)
def rotation(dims: int, number: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims, number]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def tables(n: int, settings: Settings) -> tuple[int, int]:
    """Bits of a table, and tables."""
    bits = min(62, max(6, ceil(log2(max(1, n) / settings.bucket))))
    same = (1 - acos(settings.threshold) / pi) ** bits
    return bits, ceil(log(settings.missed) / log(1 - same))


def table_keys(unit: np.ndarray, bits: int, count: int, seed: int) -> np.ndarray:
    """The bucket of each vector in each table."""
    dims = unit.shape[1]
    turns = -(-bits * count // dims)
    signs = np.concatenate([unit @ rotation(dims, 1 + t, seed) > 0 for t in range(turns)], axis=1)
    weights = 1 << np.arange(bits, dtype=np.int64)
    return np.stack([signs[:, t * bits : (t + 1) * bits] @ weights for t in range(count)], axis=1)


@lru_cache(maxsize=8)
def _dither(dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dims, 10**6]).random(dims)


def encode(unit: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits, factor, 4-bit components, and their offset and step."""
    dims = unit.shape[1]
    turned = unit @ rotation(dims, 0, seed)
    signs = turned > 0
    factor = np.abs(turned).sum(axis=1) / np.sqrt(dims)
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / 15, 1e-12)
    # Randomised rounding, by a dither that is fixed for each dimension.
    level = np.clip(np.floor((turned - low[:, None]) / step[:, None] + _dither(dims, seed)), 0, 15).astype(np.uint8)
    if dims % 2:
        level = np.pad(level, ((0, 0), (0, 1)))
    return np.packbits(signs, axis=1), factor, level[:, ::2] << 4 | level[:, 1::2], low, step


def may_link(codes: dict[str, np.ndarray], a: slice, b: slice, dims: int, settings: Settings) -> np.ndarray:
    """Pairs whose bounds, from either side's code, reach the threshold."""

    def upper(x: slice, y: slice) -> np.ndarray:
        signs = np.unpackbits(codes["code"][x], axis=1, count=dims).astype(np.float32) * 2 - 1
        packed = codes["level"][y]
        level = np.stack((packed >> 4, packed & 15), axis=2).reshape(len(packed), -1)[:, :dims].astype(np.float32)
        value = level * codes["step"][y, None].astype(np.float32) + codes["low"][y, None].astype(np.float32)
        factor = np.maximum(codes["factor"][x], 1e-6)
        estimate = (signs @ value.T) / (np.sqrt(dims) * factor[:, None])
        bound = settings.sigmas * np.sqrt(np.maximum(0.0, 1 - factor**2) / factor**2 / max(1, dims - 1))
        # Rounding moves an estimate by up to a step's share of every component.
        rounding = codes["step"][y] / (2 * factor.min(initial=1.0))
        return estimate + bound[:, None] + rounding[None, :]

    return (upper(a, b) >= settings.threshold) & (upper(b, a).T >= settings.threshold)


def prepared(vectors: DataFrame, scratch: shared.Scratch, key: str, embedding: str) -> DataFrame:
    """(id, vector): components as little-endian doubles, null where the vector can link with nothing."""
    picked = vectors.select(F.col(key).alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    schema = T.StructType([picked.schema["id"], T.StructField("vector", T.BinaryType()), T.StructField("dims", T.IntegerType())])

    def run(batches):
        for batch in batches:
            out, dims = [], []
            for item in batch.column(1):
                values = item.values if item.is_valid else None
                good = values is not None and len(values) and not values.null_count
                x = values.to_numpy(zero_copy_only=False) if good else None
                good = good and bool(np.isfinite(x).all()) and bool(x.any())
                out.append(x.astype("<f8").tobytes() if good else None)
                dims.append(len(x) if good else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), pa.array(dims, pa.int32())], ["id", "vector", "dims"]
            )

    return scratch.write(picked.mapInArrow(run, schema))


def _units(vectors: list[bytes], dims: int) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), dims)
    # Scaled first, so that neither very large nor very small components overflow.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


_CODED = "node long, dims int, t int, bucket long, keys binary, code binary, factor double, level binary, low double, step double"

_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
_CODED_ARROW = pa.schema([(name, _ARROW[kind]) for name, kind in (f.split() for f in _CODED.split(", "))])


def _coder(bits: int, count: int, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            all_dims = batch.column("dims").to_numpy()
            raw = batch.column("vector").to_pylist()
            for dims in np.unique(all_dims).tolist():
                at = np.flatnonzero(all_dims == dims)
                for part in np.array_split(at, max(1, -(-at.size // 2000))):
                    unit = _units([raw[i] for i in part], dims)
                    keys = table_keys(unit, bits, count, settings.seed)
                    code, factor, level, low, step = encode(unit, settings.seed)
                    n = len(part)
                    rep = lambda values, kind: pa.array([x for x in values for _ in range(count)], kind)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(nodes[part], count)),
                            pa.array(np.full(n * count, dims, np.int32)),
                            pa.array(np.tile(np.arange(count, dtype=np.int32), n)),
                            pa.array(keys.reshape(-1)),
                            rep([k.astype("<i8").tobytes() for k in keys], pa.binary()),
                            rep([c.tobytes() for c in code], pa.binary()),
                            pa.array(np.repeat(factor, count)),
                            rep([x.tobytes() for x in level], pa.binary()),
                            pa.array(np.repeat(low, count)),
                            pa.array(np.repeat(step, count)),
                        ],
                        schema=_CODED_ARROW,
                    )

    return run


GROUP = ["dims", "t", "bucket", "left", "right"]


def _blocked(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rows`` with the pair of blocks (left, right) to which they go; small buckets are one block."""
    sizes = rows.groupBy("dims", "t", "bucket").count().where(F.col("count") > settings.block)
    sizes = sizes.select("dims", "t", "bucket", F.ceil(F.col("count") / F.lit(settings.block // 2)).cast("int").alias("blocks"))
    with_size = rows.join(sizes, ["dims", "t", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    with_size = with_size.withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = with_size.withColumn("other", other)
    return paired.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).drop(
        "blocks", "other"
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of rows that arrive sorted by ``GROUP``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(g).to_numpy().astype(np.int64) for g in GROUP], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            key = tuple(keys[lo])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _sides(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers to compare: all with all in one block, or one block with the other."""
    own, left, right = (table.column(c).to_numpy() for c in ("own", "left", "right"))
    if left[0] == right[0]:
        return [np.arange(len(own))] * 2
    return [np.flatnonzero(own == left[0]), np.flatnonzero(own == right[0])]


def _candidates(settings: Settings):
    def matrix(table: pa.Table, name: str) -> np.ndarray:
        values = table.column(name).to_pylist()
        return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)

    def run(batches):
        for table in _groups(batches):
            if table.num_rows < 2:
                continue
            a, b = _sides(table)
            if not len(a) or not len(b):
                continue
            dims = table.column("dims")[0].as_py()
            codes = {n: table.column(n).to_numpy() for n in ("factor", "low", "step")}
            codes |= {n: matrix(table, n) for n in ("code", "level")}
            able = may_link(codes, a, b, dims, settings)
            if table.column("left")[0].as_py() == table.column("right")[0].as_py():
                np.fill_diagonal(able, False)
            flagged = np.zeros(table.num_rows, bool)
            flagged[a] |= able.any(axis=1)
            flagged[b] |= able.any(axis=0)
            if flagged.any():
                yield from table.filter(pa.array(flagged)).select(["node", "keys", "own", *GROUP]).to_batches()

    return run


def _ties(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that hold together what ``linked`` links: each vertex reached goes on to those not yet reached."""
    n = len(rows)
    if rows is columns:
        matrix, names = linked, rows
    else:
        size = n + len(columns)
        matrix = np.zeros((size, size), bool)
        matrix[:n, n:] = linked
        matrix[n:, :n] = linked.T
        names = np.concatenate((rows, columns))
    left = matrix.any(axis=1)
    ties = []
    while left.any():
        start = int(np.argmax(left))
        left[start] = False
        frontier = [start]
        while frontier:
            one = frontier.pop()
            new = np.flatnonzero(matrix[one] & left)
            left[new] = False
            ties += [(int(names[one]), int(names[x])) for x in new]
            frontier.extend(new.tolist())
    return ties


def _exact(settings: Settings):
    """Links counted per vertex (v null) and ties (n null) of each group, from full vectors."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for table in _groups(batches):
            if table.num_rows < 2:
                continue
            a, b = _sides(table)
            if not len(a) or not len(b):
                continue
            dims, t = table.column("dims")[0].as_py(), table.column("t")[0].as_py()
            unit = _units(table.column("vector").to_pylist(), dims)
            nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
            keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), "<i8").reshape(len(nodes), -1)
            linked = unit[a] @ unit[b].T >= settings.threshold
            alone = table.column("left")[0].as_py() == table.column("right")[0].as_py()
            if alone:
                linked |= linked.T
                np.fill_diagonal(linked, False)
            # Counted where both vectors meet first.
            first = linked.copy()
            for earlier in range(t):
                first &= keys[a, earlier][:, None] != keys[b, earlier][None, :]
            counts = np.zeros(len(nodes), np.int64)
            counts[a] += first @ copies[b]
            if not alone:
                counts[b] += first.T @ copies[a]
            ties = _ties(linked, nodes[a], nodes[a] if alone else nodes[b]) if not alone else _ties(linked, nodes, nodes)
            at = np.flatnonzero(counts)
            u = np.concatenate((nodes[at], np.array([x for x, _ in ties], np.int64)))
            v = [None] * at.size + [y for _, y in ties]
            n = [*counts[at].tolist()] + [None] * len(ties)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())], schema=schema)

    return run


def near_duplicates(
    vectors: DataFrame, settings: Settings = Settings(), key: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept.

    Intermediate tables are written when this is called.
    """
    scratch = shared.Scratch(vectors.sparkSession, "embedding-codes")
    rows = prepared(vectors, scratch, key, embedding)
    usable = rows.where("vector is not null")
    # Copies are one vertex, named by a number of its own.
    groups = usable.groupBy("vector", "dims").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    groups = scratch.write(groups.withColumn("node", F.monotonically_increasing_id()))
    bits, count = tables(groups.count(), settings)
    coded = groups.select("node", "dims", "vector").mapInArrow(_coder(bits, count, settings), _CODED)
    coded = scratch.write(coded)
    dealt = _blocked(coded, settings).repartition(*GROUP).sortWithinPartitions(*GROUP)
    flag_schema = "node long, keys binary, own int, dims int, t int, bucket long, left int, right int"
    names = [f.split()[0] for f in flag_schema.split(", ")]
    flagged = scratch.write(dealt.mapInArrow(_candidates(settings), flag_schema))
    full = flagged.join(groups.select("node", "vector", "copies"), "node").select(*names, "vector", "copies")
    full = full.repartition(*GROUP).sortWithinPartitions(*GROUP)
    found = scratch.write(full.mapInArrow(_exact(settings), "u long, v long, n long"))
    scratch.drop(coded, flagged)

    tied = shared.components(found.where("v is not null").select("u", "v"), scratch)
    counts = found.where("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    known = groups.join(tied, "node", "left").join(counts, "node", "left")
    known = known.select(
        "vector", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    known = scratch.write(known)
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    by_vector = known.join(smallest, "root").select(F.col("vector").alias("same"), "n_links", "component_id")
    joined = rows.join(by_vector, rows["vector"] == F.col("same"), "left")
    component = F.when(F.col("vector").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )
