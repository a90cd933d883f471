"""Consistent sharding by a permutation-filled lookup table.

Every shard has a permutation of the slots of a table of prime size M, given
by an offset and a skip that are hashes of its name. Shards take turns; at its
turn a shard claims the first slot of its permutation that is still free,
until all slots are taken. Shards thus own M/N slots each, up to one, and
adding or removing a shard moves little more than the share it must. Filling
takes O(M log M) steps on the driver, once, for a table whose size is the
parameter M; rows are placed by DataFrame functions only: a hash to a slot
and a broadcast join with the M rows of the table.

Defined cases: a NULL key is placed as the text ``null``; equal keys always
meet in one shard; an empty table gives no rows; rows keep all their columns
in ``place`` unless they clash with ``slot`` or ``shard_id``, which are
replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = [f"shard-{i:02d}" for i in range(32)]
TABLE_SIZE = 3203


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill(shards: list[str], size: int) -> list[int]:
    """The shard number that owns each slot."""
    if not is_prime(size) or len(shards) > size or not shards:
        raise ValueError(f"the table size must be a prime of at least {len(shards)}, not {size}")
    if len(set(shards)) < len(shards):
        raise ValueError("shard names must differ")
    steps = [(_digest(f"{name}/offset") % size, _digest(f"{name}/skip") % (size - 1) + 1) for name in shards]
    owner, upcoming, free = [-1] * size, [0] * len(shards), size
    while free:
        for shard, (offset, skip) in enumerate(steps):
            if not free:
                break
            slot = (offset + upcoming[shard] * skip) % size
            while owner[slot] >= 0:
                upcoming[shard] += 1
                slot = (offset + upcoming[shard] * skip) % size
            owner[slot], free = shard, free - 1
    return owner


def lookup_table(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """The filled table as ``size`` rows of slot and shard_id."""
    owners = F.split(F.lit(",".join(map(str, fill(shards, size)))), ",")
    names = F.split(F.lit("\n".join(shards)), "\n")
    return (spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
            .select("slot", F.get(names, F.col("owner").cast("int")).alias("shard_id")))


def slot_of(key: str | Column, size: int) -> Column:
    """The slot of a key: the first 60 bits of its text's MD5, modulo the table size."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit("null"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: list[str] | None = None, size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with the slot and the shard of every row."""
    shards = SHARDS if shards is None else shards
    kept = df.drop("slot", "shard_id") if key not in ("slot", "shard_id") else df
    rows = kept.withColumn("__slot", slot_of(key, size)).drop("slot", "shard_id")
    table = lookup_table(df.sparkSession, shards, size).withColumnRenamed("slot", "__slot")
    return rows.join(F.broadcast(table), "__slot").withColumnRenamed("__slot", "slot")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder per shard, each of ``files_per_shard`` files dealt by a hash of the rows.

    A shard with a heavy key is spread over its files, so no task writes more
    than a file's share.
    """
    salt = F.pmod(F.xxhash64(*placed.columns), F.lit(files_per_shard))
    shards = placed.select("shard_id").distinct().count()
    (placed.withColumn("__file", salt)
     .repartition(max(1, shards * files_per_shard), "shard_id", "__file").drop("__file")
     .write.partitionBy("shard_id").parquet(path))


def oracle(key: str, table: str, shards: list[str], size: int) -> str:
    """DuckDB SQL of the same placement: the table is filled by recursion, a turn a step."""
    values = ", ".join(f"({i}, '{name}')" for i, name in enumerate(shards))
    digest = "('0x' || substr(md5({}), 1, 15))::BIGINT"
    return f"""
WITH RECURSIVE shards AS (
  SELECT i, name, {digest.format("name || '/offset'")} % {size} AS o,
         {digest.format("name || '/skip'")} % {size - 1} + 1 AS k
  FROM (VALUES {values}) v(i, name)
), turns(t, owner) AS (
  SELECT 0, list_transform(range({size}), lambda x: -1)
  UNION ALL
  SELECT t + 1, owner[:slot] || [i] || owner[slot + 2:]
  FROM (SELECT t, owner, i, (o + k * (list_position(
          list_transform(range({size}), lambda x: owner[(o + x * k) % {size} + 1]), -1) - 1)) % {size} AS slot
        FROM turns JOIN shards ON i = t % {len(shards)} WHERE t < {size})
), filled AS (
  SELECT unnest(range({size})) AS slot, unnest(owner) AS i FROM turns WHERE t = {size}
)
SELECT {key}, slot::INTEGER AS slot, name AS shard_id
FROM (SELECT {key}, {digest.format(f"coalesce({key}::VARCHAR, 'null')")} % {size} AS slot FROM {table})
JOIN filled USING (slot) JOIN shards USING (i)"""
