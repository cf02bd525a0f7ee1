"""Membership bitmaps: rows that a list of keys of any size cannot hold go before they are worked on.

A bit per hash of a key, built by aggregation: every bucket of 32,768 bits is one row, and partial
aggregates send one bitmap per task and bucket. Sixteen bits per key let one row in sixteen pass that
is not in the list; ``most_bits`` bounds what is broadcast, and a longer list lets more rows pass. Rows
of listed keys always pass, so an exact join afterwards decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_BUCKET = 1 << 15


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def pruned(rows: DataFrame, keys: DataFrame, key: str, most_bits: int = 1 << 28) -> DataFrame:
    """Those of ``rows`` whose ``key`` may be in ``keys``; rows stay where they are.

    ``keys`` is counted when this is called; NULL keys pass only if ``keys`` may hold them.
    """
    bits = min(most_bits, max(_BUCKET, 1 << (16 * keys.count() - 1).bit_length()))
    slot = _slot(F.col(key), bits)
    own = keys.select(F.bitmap_bucket_number(slot).alias("_bucket"), F.bitmap_bit_position(slot).alias("_bit"))
    bitmaps = own.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    met = rows.withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number("_slot"))
    # At most ``most_bits`` / 8 bytes.
    met = met.join(F.broadcast(bitmaps), "_bucket")
    bit = F.bitmap_bit_position(F.col("_slot"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1
    return met.filter(is_set).select(*rows.columns)
