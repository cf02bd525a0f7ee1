"""Document fingerprints from content-defined chunks.

A text's UTF-8 bytes are cut where a gear hash of the last 16 bytes has zero bits: more bits below
the normal chunk size, fewer above it, with a smallest and a largest size (normalised chunking). The
smallest size is the hash window, so a cut depends only on bytes of its own chunk, and cuts fall
back into step soon after an insertion or removal. A fingerprint is the set of the chunks' digests,
each with its length; two fingerprints are alike by the bytes of their common chunks over the bytes
of the larger set.

Defined cases: a null text is an empty text; an empty text has the empty fingerprint, and two empty
fingerprints are alike by 1; a text below the smallest size is one chunk; a chunk that comes again
counts once; rows follow each other by id (null first) and then text, and the row after the last one
is the first, which may be the row itself; an empty table gives an empty result.

Scale: documents are dealt by ranges of their id once, and the first row of each range goes to the
range before it as well; each task walks its sorted rows and holds two of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from xxhash import xxh3_64_digest

from tallyshelf.llm import shared

SMALLEST, NORMAL, LARGEST = 16, 48, 256
#: Zero bits that a cut needs below and above the normal size.
HARD_BITS, EASY_BITS = 6, 4
#: Bytes hashed at a time.
_SLICE = 1 << 20


def gear_table() -> np.ndarray:
    """256 fixed random words: digests of the byte values."""
    words = (hashlib.blake2b(bytes([b]), digest_size=4, person=b"gear").digest() for b in range(256))
    return np.frombuffer(b"".join(words), "<u4").astype(np.uint32)


_GEAR = gear_table()


def gear(data: np.ndarray) -> np.ndarray:
    """Sum of gear[byte] << age over the last 16 bytes at every place, by doubling the window."""
    h = _GEAR[data]
    for span in (1, 2, 4, 8):
        wider = h.copy()
        wider[span:] += h[:-span] << np.uint32(span)
        h = wider
    return h


def _cuts_allowed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places with enough zero bits for the easy and for the hard rule."""
    easy, hard = [], []
    low = np.uint32(((1 << EASY_BITS) - 1) << 16)
    all_ = np.uint32(((1 << HARD_BITS) - 1) << 16)
    for at in range(0, data.size, _SLICE):
        begin = max(0, at - 15)
        h = gear(data[begin : at + _SLICE])[at - begin :]
        may = np.flatnonzero((h & low) == 0)
        easy.append(may + at)
        hard.append(may[(h[may] & all_) == 0] + at)
    return np.concatenate(easy), np.concatenate(hard)


def cut(raw: bytes) -> list[int]:
    """Ends of the chunks."""
    if len(raw) <= SMALLEST:
        return [len(raw)] if raw else []
    easy, hard = _cuts_allowed(np.frombuffer(raw, np.uint8))
    ends, at, total = [], 0, len(raw)
    easy, hard = [*easy.tolist(), total], [*hard.tolist(), total]
    e = h = 0
    while total - at > SMALLEST:
        # A cut behind place p makes a chunk of p + 1 - at bytes.
        least, normal, most = at + SMALLEST - 1, at + NORMAL - 1, min(at + LARGEST, total) - 1
        while hard[h] < least:
            h += 1
        if hard[h] < normal:
            place = hard[h]
        else:
            while easy[e] < normal:
                e += 1
            place = easy[e]
        at = min(place, most) + 1
        ends.append(at)
    if at < total:
        ends.append(total)
    return ends


def chunk_set(raw: bytes) -> dict[bytes, int]:
    """Digest and length of each different chunk."""
    ends = cut(raw)
    parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
    return {xxh3_64_digest(p): len(p) for p in parts}


def written(chunks: dict[bytes, int]) -> str:
    return ",".join(f"{d.hex()}:{n}" for d, n in sorted(chunks.items()))


def read(fingerprint: str) -> dict[bytes, int]:
    pairs = (x.split(":") for x in fingerprint.split(",") if x)
    return {bytes.fromhex(d): int(n) for d, n in pairs}


def likeness(a: dict[bytes, int], b: dict[bytes, int]) -> float:
    """Bytes in common chunks over the bytes of the larger set, 0 to 1."""
    larger = max(sum(a.values()), sum(b.values()))
    if not larger:
        return 1.0
    return sum(n for d, n in a.items() if d in b) / larger


def containment(part: dict[bytes, int], whole: dict[bytes, int]) -> float:
    """Bytes of ``part`` whose chunks are in ``whole``, over the bytes of ``part``."""
    size = sum(part.values())
    return sum(n for d, n in part.items() if d in whole) / size if size else 1.0


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every row, without moving any text."""
    picked = docs.select(F.col(key).alias(key), shared.whole(F.col(text)).alias("body"))

    def run(batches):
        for batch in batches:
            found = [written(chunk_set(t.as_buffer().to_pybytes())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [key, "fingerprint"])

    return picked.mapInArrow(run, T.StructType([picked.schema[key], T.StructField("fingerprint", T.StringType())]))


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) of ``text`` replaced by as many first code points of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _facts(text: str, chunks: dict[bytes, int], following: str, next_chunks: dict[bytes, int]) -> tuple:
    changed = edited(text, following)
    raw = changed.encode()
    changed_chunks = chunk_set(raw)
    return (
        len(text),
        hashlib.sha256(raw).hexdigest(),
        written(chunks),
        written(changed_chunks),
        likeness(chunks, changed_chunks),
        likeness(chunks, next_chunks),
    )


#: Columns of a finished row.
FACTS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)



def _walk(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Facts of each row with the row that follows it; rows are (part, guest, id, text) in order.

    A guest is the first row of the next range: it ends its part and has no facts here.
    """
    before = None
    for part, guest, id_, text in rows:
        if before is None and guest:
            continue
        chunks = chunk_set(text.encode())
        if before is not None:
            yield (before[0], *_facts(before[1], before[2], text, chunks))
        before = None if guest else (id_, text, chunks)


def _ranges(ids: DataFrame, parts: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Bounds of about equal ranges of ``ord``, and (first ord of a range, number of the range before it).

    Both have one entry for each range; the first range comes behind the last one.
    """
    fractions = [i / parts for i in range(1, parts)]
    found = ids.agg(F.percentile_approx("ord", fractions, 10_000)).first()[0] if fractions else []
    bounds = sorted(set(found or []))
    firsts = ids.groupBy(_range_of(F.col("ord"), bounds).alias("part")).agg(F.min("ord").alias("first")).collect()
    firsts = sorted((r["part"], r["first"]) for r in firsts)
    return bounds, [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]


def _range_of(ord_: Column, bounds: list[int]) -> Column:
    """Number of bounds that are not above ``ord``."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.lit(bounds), lambda b: b <= ord_))


def next_document_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """One row per row of ``docs``: key and the columns of ``FACTS``; ids are whole numbers.

    Two passes over the ids run when this is called.
    """
    spark = docs.sparkSession
    id_ = F.col(key)
    ord_ = F.coalesce(id_.cast("long"), F.lit(-(2**63)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds, firsts = _ranges(docs.select(ord_.alias("ord")), parts or 4 * n)
    picked = docs.select(id_.alias("id"), ord_.alias("ord"), shared.whole(F.col(text)).alias("body"))
    # One row for each range.
    hosts = F.broadcast(spark.createDataFrame(firsts, "first long, host int"))
    placed = picked.withColumn("own", _range_of(F.col("ord"), bounds)).join(hosts, F.col("ord") == F.col("first"), "left")
    own = F.struct(F.col("own").alias("part"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("host").alias("part"), F.lit(True).alias("guest"))
    places = F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, guest))
    dealt = placed.select("id", "ord", "body", F.explode(places).alias("place"))
    dealt = dealt.select("place.part", "place.guest", "id", "ord", "body").repartition(n, "part")
    dealt = dealt.sortWithinPartitions("part", "guest", "ord", "body").select("part", "guest", "id", "body")
    fact_fields = T._parse_datatype_string(FACTS).fields
    schema = T.StructType([T.StructField(key, picked.schema["id"].dataType), *fact_fields])
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [f.name for f in schema]

    def run(batches):
        id_type = [pa.int64()]

        def rows():
            for batch in batches:
                id_type[0] = batch.schema.field("id").type
                yield from zip(*(batch.column(i).to_pylist() for i in range(4)))

        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), [id_type[0], *kinds])], names)

        for row in _walk(rows()):
            held.append(row)
            if len(held) >= 256:
                yield out()
                held.clear()
        if held:
            yield out()

    return dealt.mapInArrow(run, schema)
