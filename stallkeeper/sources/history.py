"""Texts or addresses that earlier runs have seen: keys in buckets, a Bloom filter for each, exact where it matters.

A generation is what one run adds: ``keys/generation=…/bucket=…`` holds binary keys in ascending order with
where the text was seen, ``filters/generation=…`` one Bloom filter per bucket. A lookup streams its keys
past the filters of their buckets. Only buckets that may hold one of them are read, and the few keys
that passed are brought to the rows of the history, not the other way round; a run whose texts are
new reads no keys of earlier runs at all, but for false positives.

``compact`` puts generations together as one. Which generation stands for which is in a commit log, so
readers see the old ones or the new one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stallkeeper.plans.stages import Stage
from stallkeeper.schemas import FILTERS, REPLACED, SEEN
from stallkeeper.sources.commits import CommitLog
from stallkeeper.sources.manifest import read_or_empty

KEY_BYTES = 32
BUCKETS = 64
BITS_PER_KEY = 10
# Words of 32 bits of the key that place it in a filter; the first word chooses the bucket.
HASHES = 7
# Keys that are sent to all tasks that read the history (40 bytes each); more are joined by a shuffle.
SENT_KEYS = 200_000


def bucket_of(key: Column) -> Column:
    first = F.conv(F.hex(F.substring(key, 1, 2)), 16, 10).cast("int")
    return F.pmod(first, F.lit(BUCKETS))


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bits of a filter that keys (rows of ``KEY_BYTES`` bytes) set: the keys are hashes themselves."""
    words = keys.view(">u4").astype(np.int64).reshape(len(keys), -1)
    return words[:, 1 : HASHES + 1] % bits


def _keys(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, KEY_BYTES)


def bloom(keys: np.ndarray) -> bytes:
    size = max(64, 1 << (BITS_PER_KEY * len(keys) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[places(keys, size)] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, keys: np.ndarray) -> np.ndarray:
    at = places(keys, 8 * len(bits))
    whole = np.frombuffer(bits, np.uint8)
    return ((whole[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1)


class TextHistory:
    """``schema``: the key, what is kept of it, and at the end generation and bucket."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = SEEN):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.log = CommitLog(spark, f"{self.path}/replaced", REPLACED)

    def write(self, rows: DataFrame, generation: str) -> None:
        """The key and what is kept of it as a generation; it counts when callers say so."""
        named = rows.select(*self.schema.fieldNames()[:-2], bucket_of(F.col("key")).alias("bucket"))
        dealt = named.repartition("bucket").sortWithinPartitions("bucket", "key")
        folder = f"{self.path}/keys/generation={generation}"
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)

        def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                of, keys = batch.column(0).to_numpy(), _keys(batch.column(1))
                for b in np.unique(of).tolist():
                    own.setdefault(b, []).append(keys[of == b])
            for b, parts in own.items():  # one bucket's keys at a time become bits
                whole = np.concatenate(parts)
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "bits": [bloom(whole)], "keys": [len(whole)]})

        keys = read_or_empty(self.spark, f"{self.path}/keys", self.schema).filter(F.col("generation") == generation)
        narrow = keys.select("bucket", "key").repartition("bucket")
        filters = narrow.mapInArrow(build, T.StructType(FILTERS.fields[:3]))
        filters.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/filters/generation={generation}")

    def generations(self, names: Iterable[str]) -> set[str]:
        """What holds the rows of these generations now."""
        found = set(names)
        for row in self.log.read().orderBy("seq").collect():  # a row for each generation ever replaced
            if row["old"] in found:
                found = (found - {row["old"]}) | {row["new"]}
        return found

    def lookup(self, keys: DataFrame, names: Iterable[str], stage: Stage, name: str = "maybe") -> DataFrame:
        """Rows of the history under ``key``s (distinct, 32 bytes) in the generations of these names."""
        names = sorted(self.generations(names))
        whole = read_or_empty(self.spark, f"{self.path}/keys", self.schema)
        if not names:
            return whole.filter(F.lit(False))
        filters = read_or_empty(self.spark, f"{self.path}/filters", FILTERS)
        filters = filters.filter(F.col("generation").isin(names)).select("bucket", "generation", "bits")
        asked = keys.select(bucket_of(F.col("key")).alias("bucket"), "key")
        # The filters of a bucket come ahead of its keys.
        together = filters.unionByName(asked, allowMissingColumns=True).repartition("bucket")
        together = together.sortWithinPartitions("bucket", F.col("bits").isNull())

        def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[int, list[tuple[str, bytes]]] = {}
            for batch in batches:
                of, made, bits, key = (batch.column(i) for i in range(4))
                heads = bits.is_valid().to_numpy(zero_copy_only=False)
                for i in np.flatnonzero(heads).tolist():
                    known.setdefault(of[i].as_py(), []).append((made[i].as_py(), bits[i].as_py()))
                left = np.flatnonzero(~heads)
                if not len(left):
                    continue
                own, keys = of.to_numpy()[left], _keys(key.take(pa.array(left)))
                for b in np.unique(own).tolist():
                    mine = keys[own == b]
                    for g, f in known.get(b, []):
                        hit = [k.tobytes() for k in mine[may_hold(f, mine)]]
                        columns = [pa.array([b] * len(hit), pa.int32()), pa.array([g] * len(hit)), pa.array(hit, pa.binary())]
                        yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.binary()))], names=["bucket", "generation", "key"])

        maybe = stage(together.mapInArrow(test, "bucket int, generation string, key binary"), name)
        # At most a row for each bucket and generation.
        hit = maybe.groupBy("generation").agg(F.collect_set("bucket").alias("buckets"), F.count("*").alias("n")).collect()
        if not hit:
            return whole.filter(F.lit(False))
        parts = [(F.col("generation") == r["generation"]) & F.col("bucket").isin(r["buckets"]) for r in hit]
        whole = whole.filter(reduce(lambda a, b: a | b, parts))
        if sum(r["n"] for r in hit) <= SENT_KEYS:
            maybe = F.broadcast(maybe)
        return whole.join(maybe, ["generation", "bucket", "key"], "left_semi").select(*self.schema.fieldNames())

    def compact(self, names: Iterable[str], new: str) -> bool:
        """One generation in place of these; False if another compaction came between."""
        version = self.log.version()
        old = sorted(self.generations(names))
        rows = read_or_empty(self.spark, f"{self.path}/keys", self.schema).filter(F.col("generation").isin(old))
        self.write(rows, new)
        return self.log.put(version + 1, [{"old": o, "new": new} for o in old])
