"""Line dedup over levelled sorted runs of line hashes.

The key of a line is the line without ASCII white space at both ends, A-Z lower-cased; empty keys
never count. Keys are known by 128 bits. A batch of documents brings, for each key, the number of
its documents that hold it. The state is two kinds of sorted runs in shared storage: ``counting``
runs (key, documents so far) in levels, and ``decided`` runs, keys that have reached the limit. A
new batch merge-anti-joins the decided runs - such keys need no more counting - and adds the rest
as a run of level 0. When a level holds ``fan_out`` runs they are compacted: sums that reach the
limit become a decided run, the others one run of the next level. A key's documents are the sum over
all runs, so results depend neither on the batches nor on their order.

Lines whose key is decided lose all their places in every document; other lines stay as they are.

Defined cases: a null text is an empty text and has one empty line, which stays; every row is a
document of its own, so repeated rows count each; a line repeated in one document counts once; an
empty table gives an empty result; ``text`` and ``n_chars`` are the only columns that change.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from xxhash import xxh3_128_digest

from tallyshelf.llm import shared

_KEY = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def _hash(key: bytes) -> tuple[int, int]:
    digest = xxh3_128_digest(key)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _hashable(docs: DataFrame) -> list[Column]:
    """Columns that name a row by content; maps have no hash."""
    return shared.every(docs, but=[f.name for f in docs.schema if "map<" in f.dataType.simpleString()])


def _keyed(docs: DataFrame, text: str, batch: Column) -> DataFrame:
    row = shared.row_key(*_hashable(docs))
    return docs.select(*row, batch.alias("batch"), shared.whole(F.col(text)).alias("body"))


def line_counts(docs: DataFrame, text: str, n_batches: int) -> DataFrame:
    """(batch, h1, h2, n): documents of the batch that hold the key, summed within each Arrow batch."""
    keyed = _keyed(docs, text, F.pmod(F.xxhash64(F.col(text)), F.lit(n_batches)).cast("int"))

    def run(batches):
        for batch in batches:
            seen: Counter = Counter()
            for part, body in zip(batch.column(2).to_pylist(), batch.column(3)):
                keys = {line_key(x) for x in body.as_buffer().to_pybytes().split(b"\n")}
                keys.discard(b"")
                seen.update((part, k) for k in keys)
            hashes = [_hash(k) for _, k in seen]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _ in seen], pa.int32()),
                    pa.array([a for a, _ in hashes], pa.int64()),
                    pa.array([b for _, b in hashes], pa.int64()),
                    pa.array(list(seen.values()), pa.int64()),
                ],
                ["batch", "h1", "h2", "n"],
            )

    counted = keyed.mapInArrow(run, "batch int, h1 long, h2 long, n long")
    return counted.groupBy("batch", "h1", "h2").agg(F.sum("n").alias("n"))


class LineRuns:
    """Levelled runs of line hashes."""

    def __init__(self, spark: SparkSession, least_docs: int, fan_out: int = 2):
        self.scratch = shared.Scratch(spark, "line-runs")
        self.least_docs, self.fan_out = least_docs, fan_out
        self.levels: dict[int, list[DataFrame]] = {}
        self.decided: list[DataFrame] = []

    def _run(self, df: DataFrame) -> DataFrame:
        """``df`` written as a run: dealt by key, each part sorted."""
        return self.scratch.write(df.repartition("h1", "h2").sortWithinPartitions("h1", "h2"))

    def add(self, batch: DataFrame) -> None:
        """``batch`` (h1, h2, n: documents of the batch with the key), each key once."""
        for run in self.decided:
            batch = batch.join(run, ["h1", "h2"], "left_anti")
        self._place(0, self._run(batch))

    def _place(self, level: int, run: DataFrame) -> None:
        runs = self.levels.setdefault(level, [])
        runs.append(run)
        if len(runs) >= self.fan_out:
            self._compact(level)

    def _compact(self, level: int) -> None:
        runs = self.levels.pop(level)
        self._place(level + 1, self._merge(runs))

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for run in runs[1:]:
            both = both.unionByName(run)
        summed = self.scratch.write(both.groupBy("h1", "h2").agg(F.sum("n").alias("n")))
        self.decided.append(self._run(summed.where(F.col("n") >= self.least_docs).select("h1", "h2")))
        rest = self._run(summed.where(F.col("n") < self.least_docs))
        self.scratch.drop(summed, *runs)
        return rest

    def frequent(self) -> DataFrame:
        """All keys found in at least ``least_docs`` documents so far, each once; ends the counting."""
        while runs := [r for level in self.levels.values() for r in level]:
            self.levels = {}
            self._merge(runs)
            break
        found = None
        for run in self.decided:
            found = run if found is None else found.union(run)
        return found.distinct()


def frequent_lines(docs: DataFrame, text: str = "text", least_docs: int = 10, n_batches: int = 4) -> DataFrame:
    """Keys (h1, h2) of lines found in at least ``least_docs`` rows of ``docs``."""
    runs = LineRuns(docs.sparkSession, least_docs)
    counts = runs.scratch.write(line_counts(docs, text, n_batches), ["batch"])
    for i in range(n_batches):
        runs.add(counts.where(F.col("batch") == i).select("h1", "h2", "n"))
    return runs.frequent()


def _places(docs: DataFrame, text: str) -> DataFrame:
    """(row_a, row_b, line, h1, h2) of every line with a key."""
    keyed = _keyed(docs, text, F.lit(0))
    schema = "row_a long, row_b long, line int, h1 long, h2 long"

    def run(batches):
        for batch in batches:
            a, b, line, h1, h2 = [], [], [], [], []
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3))
            for row_a, row_b, body in rows:
                for i, x in enumerate(body.as_buffer().to_pybytes().split(b"\n")):
                    if key := line_key(x):
                        one, two = _hash(key)
                        a.append(row_a), b.append(row_b), line.append(i), h1.append(one), h2.append(two)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(line, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())],
                ["row_a", "row_b", "line", "h1", "h2"],
            )

    return keyed.mapInArrow(run, schema)


#: Parts in which the places of one line hash are dealt out, so that a very common line is spread.
SALTS = 16


def drop_frequent_lines(
    docs: DataFrame, text: str = "text", least_docs: int = 10, n_batches: int = 4
) -> DataFrame:
    """``docs`` with ``text`` without its frequent lines, and n_lines, n_dropped (long).

    Intermediate tables are written when this is called.
    """
    frequent = frequent_lines(docs, text, least_docs, n_batches)
    salted = frequent.select("h1", "h2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    places = _places(docs, text).withColumn("salt", F.pmod("row_a", F.lit(SALTS)).cast("int"))
    # Rows with the same content share their key, so their places meet as one set.
    lost = places.join(salted, ["h1", "h2", "salt"], "left_semi").groupBy("row_a", "row_b").agg(
        F.collect_set("line").alias("lost")
    )
    keyed = docs.select(shared.packed(docs, but=[text]), shared.whole(F.col(text)).alias("body"), *shared.row_key(*_hashable(docs)))
    with_lost = keyed.join(lost, ["row_a", "row_b"], "left").select("doc", "body", "lost")
    schema = T.StructType(
        [
            with_lost.schema["doc"],
            T.StructField("kept", T.StringType()),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
        ]
    )

    def run(batches):
        for batch in batches:
            kept, lines, dropped = [], [], []
            for body, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts = body.split("\n")
                out = set(lost or ())
                kept.append("\n".join(x for i, x in enumerate(parts) if i not in out) if out else body)
                lines.append(len(parts))
                dropped.append(len(out))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                ["doc", "kept", "n_lines", "n_dropped"],
            )

    cleaned = with_lost.mapInArrow(run, schema)
    back = shared.unpacked(docs, but=[text])
    columns = [F.col("kept").alias(c) if c == text else back[c] for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return cleaned.select(*columns, "n_lines", "n_dropped")
