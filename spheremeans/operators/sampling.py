"""The k rows of lowest hash out of any number, without a task that sees many rows.

One pass counts rows by the number of binary digits of their hash; the least power of two
below which k rows lie leaves about twice as many. Only where many rows share a hash are
there more, and then a histogram within the last digit is refined until it is right.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Hashes are the first 60 bits of an MD5 sum.
HASHES = 1 << 60
BINS = 64
ROWS_PER_SPLIT = 1 << 16

# Degrees beyond which places are hashed alike; keeps billionths of a degree within 64 bits.
_FAR_DEGREES = 4e9


def seed_order(seed: int, key: Column | str) -> Column:
    """A pseudo-random order of keys, the same for any partitioning."""
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def hash_of(order: Column) -> Column:
    return F.conv(F.substring(order, 1, 15), 16, 10).cast("bigint")


def _billionths(name: str) -> Column:
    return F.floor(F.greatest(F.lit(-_FAR_DEGREES), F.least(F.lit(_FAR_DEGREES), F.col(name))) * 1e9).cast("bigint")


def place_key() -> Column:
    """Text for a place: its billionths of a degree."""
    return F.concat_ws(":", _billionths("latitude"), _billionths("longitude"))


def _threshold(rows: DataFrame, k: int) -> int:
    """A hash below which there are at least k rows (or all), and few more if hashes differ."""
    digits = dict(rows.groupBy(F.length(F.bin("_hash"))).count().collect())
    edge, found, below = 1, 0, 0
    for n in sorted(digits):
        edge, below, found = 1 << n, found, found + digits[n]
        if found >= k:
            break
    if found < k:
        return HASHES
    low = edge >> 1 if edge > 2 else 0
    while found > 8 * k + BINS and edge - low > 1:
        width = -(-(edge - low) // BINS)
        inside = rows.where((F.col("_hash") >= low) & (F.col("_hash") < edge))
        counts = dict(inside.groupBy(F.expr(f"(_hash - {low}L) div {width}L")).count().collect())
        for b in sorted(counts):
            found = below + counts[b]
            if found >= k:
                break
            below = found
        low, edge = low + b * width, min(edge, low + (b + 1) * width)
    return edge


def lowest(rows: DataFrame, k: int, *ties: str) -> list[Row]:
    """The k rows of lowest ``_hash``, ties in the order of columns ``ties``, or all if there are fewer.

    Rows with equal hashes and ties are folded, and come back once with their ``_copies``.
    """
    few = rows.where(F.col("_hash") < _threshold(rows, k))
    folded = few.groupBy("_hash", *ties).agg(F.count("*").alias("_copies"))
    return folded.orderBy("_hash", *ties).limit(k).collect()


def lowest_keys(located: DataFrame, k: int, seed: int, key: str) -> list[Row]:
    """latitude and longitude of the k first keys in seeded order."""
    order = seed_order(seed, key)
    rows = located.select(hash_of(order).alias("_hash"), order.alias("_order"), F.col(key).alias("_key"), "latitude", "longitude")
    found = lowest(rows, k, "_order", "_key", "latitude", "longitude")
    return [r for r in found for _ in range(min(r["_copies"], k))][:k]


def lowest_places(located: DataFrame, k: int, seed: int) -> list[Row]:
    """The k first distinct places in seeded order, however often each occurs."""
    rows = located.select("latitude", "longitude").distinct()
    rows = rows.select("latitude", "longitude", hash_of(seed_order(seed, place_key())).alias("_hash"))
    return lowest(rows, k, "latitude", "longitude")


def lowest_copies(located: DataFrame, k: int, seed: int) -> list[Row]:
    """k rows drawn without replacement: the copies of a place are numbered, and each is a candidate.

    A place with many copies is split up before they are numbered.
    """
    places = located.groupBy("latitude", "longitude").agg(F.count("*").alias("_n"))
    places = places.persist(StorageLevel.MEMORY_AND_DISK)  # rebuilt from the points where it is lost
    splits = F.sequence(F.lit(0), F.expr(f"(_n - 1) div {ROWS_PER_SPLIT}"))
    heavy = places.where(f"_n > {ROWS_PER_SPLIT}").select("latitude", "longitude", "_n", F.explode(splits).alias("_split"))
    heavy = heavy.repartition("latitude", "longitude", "_split")
    light = places.where(f"_n <= {ROWS_PER_SPLIT}").withColumn("_split", F.lit(0).cast("bigint"))
    upto = F.least(F.col("_n"), (F.col("_split") + 1) * ROWS_PER_SPLIT)
    copies = F.explode(F.sequence(F.col("_split") * ROWS_PER_SPLIT + 1, upto)).alias("_copy")
    rows = light.unionByName(heavy).select("latitude", "longitude", copies)
    numbered = F.concat(place_key(), F.lit(":"), F.col("_copy").cast("string"))
    rows = rows.select("latitude", "longitude", "_copy", hash_of(seed_order(seed, numbered)).alias("_hash"))
    try:
        return lowest(rows, k, "latitude", "longitude", "_copy")
    finally:
        places.unpersist()
