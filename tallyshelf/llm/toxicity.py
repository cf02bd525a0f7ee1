"""Toxicity from a character n-gram linear classifier with naive Bayes feature scaling.

Features of a text are its character n-grams, lower-cased, white space as one space, hashed into
``2 ** bits`` slots; a slot counts once per text. Every slot is scaled by its log-count ratio: how
much more often labelled toxic texts hold it than the others, smoothed towards no difference by the
slot's overall rate, so that rare n-grams weigh nothing. The ratios come from at most ``count_rows``
labelled rows, as partial sums per task, and a logistic regression over the scaled slots is fitted
on at most ``fit_rows`` of them in one task; half of either come from each class, those with the
smallest hash of their id. The sample is drawn from ids and labels alone, so only its texts move.

Texts are looked at as a whole; a text's scaled slots are summed, so a few telling words in a long
text still stand out, because common slots have ratios near zero.

Defined cases: a null text is an empty text and gets the score of no features; a text without a
label, or with several labels, is scored like any other (several: the largest counts for learning, and of
several texts with one id the smallest);
repeated rows get the same score; without any labelled row of one class all scores are 0; an empty
table gives an empty result. Labels, language, source and id are never features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyshelf.llm import shared


@dataclass(frozen=True)
class Settings:
    sizes: tuple[int, ...] = (4, 5, 6)
    bits: int = 20
    #: Texts that the smoothing adds to each side.
    smoothing: float = 2.0
    #: Labelled rows that the ratios are counted on, and that the linear classifier is fitted on, at most.
    count_rows: int = 40_000
    fit_rows: int = 6_000
    rounds: int = 100
    #: Slots whose log-count ratio is nearer to zero say nothing and are left out.
    least_ratio: float = 0.5
    ridge: float = 1e-4
    rate: float = 0.5


#: Characters hashed at a time.
_SLICE = 1 << 20


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=2)
def _stamps(bits: int) -> np.ndarray:
    return np.empty(1 << bits, np.int32)


def _hashed(points: np.ndarray, settings: Settings) -> np.ndarray:
    shift = np.uint32(32 - settings.bits)
    found, value = [], np.zeros(points.size, np.uint32)
    for n in range(1, max(settings.sizes) + 1):
        if n > points.size:
            break
        value = value[: points.size - n + 1] * np.uint32(0x01000193) + points[n - 1 :]
        if n in settings.sizes:
            mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * n)
            found.append(mixed >> shift)
    return np.concatenate(found) if found else np.empty(0, np.uint32)


def slots(text: str, settings: Settings) -> np.ndarray:
    """Hashed n-grams of the text, each slot once."""
    points = _code_points(text)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    if space[1:].any():
        points = np.where(space, np.uint32(32), points)
        points = points[~(space & np.concatenate(([False], space[:-1])))]
    step, over = _SLICE, max(settings.sizes) - 1
    parts = [_hashed(points[at : at + step + over], settings) for at in range(0, points.size, step)]
    if len(parts) > 1:
        return np.unique(np.concatenate([np.unique(p) for p in parts]))
    # The last place that writes a slot is the one that keeps it.
    stamps, own = _stamps(settings.bits), np.arange(parts[0].size, dtype=np.int32)
    stamps[parts[0]] = own
    return parts[0][stamps[parts[0]] == own]


def _halves(rows: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` rows, half of each class, by the hash of their id."""
    order = [F.xxhash64("id"), "id"]
    toxic, rest = (rows.where(c).orderBy(*order).limit(most // 2) for c in ("y > 0", "y <= 0"))
    return toxic.union(rest)


def labelled(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Column, settings: Settings
) -> DataFrame:
    """(id, body, y) of a sample of the rows that may be learned from, ``count_rows`` at most."""
    marks = labels.groupBy(F.col(key).alias("id")).agg(F.max(F.col(label)).cast("int").alias("y")).where("y is not null")
    rows = docs.where(learn).select(F.col(key).alias("id"), shared.whole(F.col(text)).alias("body"))
    # Ids only; the sample's size is bounded, so it can be sent to all tasks.
    sample = _halves(marks.join(rows.select("id").distinct(), "id"), settings.count_rows)
    picked = rows.join(F.broadcast(sample), "id")
    return picked.groupBy("id").agg(F.min("body").alias("body"), F.max("y").alias("y"))


def slot_counts(rows: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Texts of each class that hold each slot, and texts of each class; summed in the tasks first.

    What comes to the driver has the size of the feature space, whatever the number of rows.
    """
    size = 1 << settings.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for body, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[int(y > 0), slots(body, settings)] += 1
                texts[int(y > 0)] += 1
        held = np.flatnonzero(counts.any(axis=0))
        if texts.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(held, size)), pa.array(np.append(counts[0, held], texts[0])), pa.array(np.append(counts[1, held], texts[1]))],
                ["slot", "rest", "toxic"],
            )

    summed = (
        rows.select("body", "y")
        .mapInArrow(run, "slot long, rest long, toxic long")
        .groupBy("slot")
        .agg(F.sum("rest").alias("rest"), F.sum("toxic").alias("toxic"))
        .toArrow()
    )
    found = np.zeros((2, size + 1), np.int64)
    at = summed["slot"].to_numpy()
    found[0, at], found[1, at] = summed["rest"].to_numpy(), summed["toxic"].to_numpy()
    return found[1, :size], found[0, :size], int(found[1, size]), int(found[0, size])


def log_count_ratios(toxic: np.ndarray, rest: np.ndarray, n_toxic: int, n_rest: int, settings: Settings) -> np.ndarray:
    """Log of how often each class holds a slot against what its overall rate lets expect."""
    smoothing = settings.smoothing
    rate = (toxic + rest) / (n_toxic + n_rest)
    more = np.log((toxic + smoothing) / (rate * n_toxic + smoothing))
    less = np.log((rest + smoothing) / (rate * n_rest + smoothing))
    ratio = more - less
    return np.where(np.abs(ratio) >= settings.least_ratio, ratio, 0).astype(np.float32)


def fit(rows: list[tuple[str, int]], ratios: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Weight of each slot (ratio included) and the offset, by averaged gradient steps with momentum."""
    held = [(h := slots(text, settings))[ratios[h] != 0] for text, _ in rows]
    y = np.array([label > 0 for _, label in rows], np.float64)
    counts = np.array([h.size for h in held])
    at, row = np.concatenate(held), np.repeat(np.arange(len(rows)), counts)
    z = ratios[at].astype(np.float64)
    # Each class counts half, so that the offset is not driven by the rarer one.
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, offset = np.zeros(ratios.size), 0.0
    speed, offset_speed = np.zeros(ratios.size), 0.0
    scale = 1.0 / max(1.0, np.average(np.bincount(row, z * z, len(rows)), weights=weight))
    for _ in range(settings.rounds):
        margin = np.bincount(row, z * w[at], len(rows)) + offset
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        slope = np.bincount(at, z * error[row], ratios.size) + settings.ridge * w
        speed = 0.9 * speed - settings.rate * scale * 4 * slope
        offset_speed = 0.9 * offset_speed - settings.rate * error.sum()
        w, offset = w + speed, offset + offset_speed
    return (w * ratios).astype(np.float32), float(offset)


def train(rows: DataFrame, settings: Settings) -> tuple[bytes, float] | None:
    """Slot weights (float32 bytes) and offset; None if a class has no row."""
    toxic, rest, n_toxic, n_rest = slot_counts(rows, settings)
    if not n_toxic or not n_rest:
        return None
    ratios = log_count_ratios(toxic, rest, n_toxic, n_rest, settings)
    shared_ratios = rows.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        sample = [(t, y) for b in batches for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        if sample:
            weights, offset = fit(sample, shared_ratios.value, settings)
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([offset])], ["w", "offset"])

    sample = _halves(rows, settings.fit_rows).select("body", "y").repartition(1).sortWithinPartitions("y", "body")
    weights, offset = sample.mapInArrow(run, "w binary, offset double").first()
    return bytes(weights), offset


def score(docs: DataFrame, model: tuple[bytes, float] | None, settings: Settings, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1). The weights sent out have the size of the feature space."""
    names = shared.every(docs, but=["score"])
    if model is None:
        return docs.select(*names, F.lit(0.0).alias("score"))
    weights = docs.sparkSession.sparkContext.broadcast(model[0])
    offset = model[1]
    picked = docs.select(shared.packed(docs, but=["score"]), shared.whole(F.col(text)).alias("body"))
    schema = T.StructType([picked.schema["doc"], T.StructField("score", T.DoubleType())])

    def run(batches):
        w = np.frombuffer(weights.value, np.float32).astype(np.float64)
        for batch in batches:
            margins = np.array([w[slots(t, settings)].sum() + offset for t in batch.column(1).to_pylist()], np.float64)
            values = 1 / (1 + np.exp(-np.clip(margins, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc", "score"])

    return picked.mapInArrow(run, schema).select(*shared.unpacked(docs, but=["score"]).values(), "score")


def scored(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
) -> DataFrame:
    """``docs`` with ``score``, learned from the rows with ``learn``. Training runs when this is called."""
    scratch = shared.Scratch(docs.sparkSession, "toxicity")
    rows = scratch.write(labelled(docs, labels, key, text, label, learn, settings))
    model = train(rows, settings)
    scratch.drop(rows)
    return score(docs, model, settings, text)


def learnable(key: Column) -> Column:
    """Rows that may be learned from: CRC-32 of the id as text, modulo 4, is not 2."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4)) != 2
