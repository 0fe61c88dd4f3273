"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``slots`` positions.  Every shard owns ``vnodes`` of them, and a
key belongs to the first virtual node at or after its own position.  A shard
takes at most its capacity; keys that overflow a full shard go on clockwise to
the next virtual node whose shard has room.  Capacities add up to the number of
rows and differ by at most one, so row counts do as well (law ``rows``).  A
shard added later claims arcs of the ring only, which limits movement to its
own arcs and to what overflows.

Spark counts the keys of every ring position, the driver walks the ring (at
most ``slots`` counts, whatever the input), and every row gets its shard from
its exact rank within its position.  Equal rows are aggregated before they are
ranked and dealt out again in chunks, so one key with a third of all rows is
no hot group.

Defined results: a null text has 0 bytes and the checksum of the empty text; a
null doc_id is a key like any other; repeated rows each take a slot of their
own; equal positions are ordered by hash, doc_id, checksum and size; an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclens.llm.common import written

SLOTS = 1 << 16
VNODES = 64
CHUNK = 10_000


def ring_points(n_shards: int, vnodes: int = VNODES, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, in ring order."""
    points = []
    for shard in range(n_shards):
        for j in range(vnodes):
            d = hashlib.blake2b(f"{shard}/{j}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(d, "big") % slots, shard))
    return sorted(points)


def capacities(total: int, home: list[int]) -> list[int]:
    """Even capacities; the odd rows go to the shards with most keys at home."""
    base, extra = divmod(total, len(home))
    order = sorted(range(len(home)), key=lambda s: (-home[s], s))
    cap = [base] * len(home)
    for s in order[:extra]:
        cap[s] += 1
    return cap


def walk_ring(counts: dict[int, int], points: list[tuple[int, int]],
              n_shards: int) -> list[tuple[int, int, int, int, int]]:
    """Deal the keys of every position to shards.

    Returns (position, first rank, end rank, shard, first slot in the shard);
    the ranges of a position cover its ranks from 0 without gaps.
    """
    positions = [p for p, _ in points]
    at = {slot: bisect_left(positions, slot) % len(points) for slot in counts}
    home = [0] * n_shards
    for slot, n in counts.items():
        home[points[at[slot]][1]] += n
    cap = capacities(sum(counts.values()), home)
    filled = [0] * n_shards
    out, overflow = [], []

    def give(slot, first, n, shard):
        out.append((slot, first, first + n, shard, filled[shard]))
        filled[shard] += n

    for slot in sorted(counts):
        shard = points[at[slot]][1]
        n = min(counts[slot], cap[shard] - filled[shard])
        if n:
            give(slot, 0, n, shard)
        if n < counts[slot]:
            overflow.append((slot, n, counts[slot] - n))
    # Virtual nodes of full shards are skipped for good, so the walk stays
    # proportional to the number of positions and virtual nodes.
    skip = list(range(len(points)))

    def open_from(i):
        path = []
        while True:
            i %= len(points)
            if skip[i] != i:
                path.append(i)
                i = skip[i]
            elif filled[points[i][1]] >= cap[points[i][1]]:
                path.append(i)
                skip[i] = (i + 1) % len(points)
                i = skip[i]
            else:
                for j in path:
                    skip[j] = i
                return i

    for slot, first, left in overflow:
        while left:
            shard = points[open_from(at[slot])][1]
            n = min(left, cap[shard] - filled[shard])
            give(slot, first, n, shard)
            first, left = first + n, left - n
    return out


def shard_rows(docs: DataFrame, n_shards: int = 40, vnodes: int = VNODES,
               slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``."""
    spark = docs.sparkSession
    raw = F.coalesce(F.col("text"), F.lit(""))
    rows = (docs.select("doc_id",
                        (F.octet_length(raw) + 16).cast("long").alias("size"),
                        F.crc32(F.encode(raw, "UTF-8")).alias("text_crc32"))
                .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
                .withColumn("_hash", F.xxhash64("doc_id"))
                .withColumn("_pos", F.pmod("_hash", F.lit(slots)).cast("int")))
    rows = written(rows, "ring-keys")
    counts = {r["_pos"]: r["n"] for r in
              rows.groupBy("_pos").agg(F.sum("_n").alias("n")).collect()}  # at most `slots` rows
    parts = walk_ring(counts, ring_points(n_shards, vnodes, slots), n_shards)
    parts = spark.createDataFrame(
        parts, "_pos int, _first long, _end long, shard int, _slot long")
    w = (Window.partitionBy("_pos").orderBy("_hash", "doc_id", "text_crc32", "size")
               .rowsBetween(Window.unboundedPreceding, -1))
    chunk = F.lit(CHUNK).cast("long")
    ranked = (rows.withColumn("_a", F.coalesce(F.sum("_n").over(w), F.lit(0).cast("long")))
                  .withColumn("_off", F.explode(F.sequence(F.lit(0).cast("long"),
                                                           F.col("_n") - 1, chunk)))
                  .withColumn("_b", F.col("_a") + F.least(F.col("_off") + chunk, "_n"))
                  .withColumn("_a", F.col("_a") + F.col("_off")))
    dealt = (ranked.join(F.broadcast(parts), "_pos")  # at most slots + virtual nodes rows
                   .where((F.col("_a") < F.col("_end")) & (F.col("_first") < F.col("_b")))
                   .withColumn("_rank", F.explode(F.sequence(F.greatest("_a", "_first"),
                                                             F.least("_b", "_end") - 1))))
    return dealt.select("doc_id", "size", "text_crc32", "shard",
                        (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot"))
