"""A stored inverted index with word positions: ranked and phrase search that read the queried words only.

A generation is what one run adds: ``postings/generation=…/bucket=…`` has a row for each word of each
document, with its positions and the document's number of words, in the order of words. Words are dealt to
buckets by CRC-32, so a query names the folders it needs, and the order within files lets the scan leave out
row groups. The empty word stands in every document; its rows are the list of documents.

``totals/generation=…`` has one row and is written last. A generation counts once that is there, so a run
that died leaves nothing that a search could see, and a rerun under the same name takes its place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stallkeeper.operators.parse import in_small_batches
from stallkeeper.schemas import POSTINGS, TOTALS
from stallkeeper.sources.manifest import read_or_empty
from stallkeeper.sources.storage import remove

BUCKETS = 64
# Parts of the documents: postings of a word that stands in every document are made by so many tasks.
PARTS = 16
K1, B = 1.2, 0.75


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case. A null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)


def word_positions(rows: DataFrame) -> DataFrame:
    """``key, word, positions, length`` of every different word of each row ``key, words``.

    ``words`` ends with the empty word, which does not count for the length. Nothing is shuffled.
    """
    in_small_batches(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = batch.column(0), batch.column(1)
            sizes = pc.list_value_length(lists).to_numpy()
            found = pc.list_flatten(lists).dictionary_encode()
            row = np.repeat(np.arange(len(sizes)), sizes)
            position = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            pair = row * len(found.dictionary) + found.indices.to_numpy()
            order = np.argsort(pair, kind="stable")  # positions stay in order
            pair = pair[order]
            heads = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]][: len(pair)])
            at = order[heads]
            ends = pa.array(np.r_[heads, len(pair)], pa.int32())
            columns = [
                keys.take(pa.array(row[at])),
                found.take(pa.array(at)).dictionary_decode(),
                pa.ListArray.from_arrays(ends, pa.array(position[order], pa.int32())),
                pa.array(sizes[row[at]] - 1, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "word", "positions", "length"])

    return rows.mapInArrow(run, "key bigint, word string, positions array<int>, length int")


class TextIndex:
    """Documents under distinct keys (64-bit integers). Rows without a key cannot be found and are left out."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(
        self, rows: DataFrame, generation: str, key: str = "doc_id", text: str = "text", parts: int = PARTS
    ) -> None:
        """Index the rows as a generation, with one shuffle of ``(word, key, positions)``.

        The positions of a word are brought together in the document's own task. A key belongs to one
        generation: indexed again, it would be found twice.
        """
        own = rows.filter(F.col(key).isNotNull())
        own = own.select(F.col(key).cast("long").alias("key"), words(F.col(text)).alias("words"))
        listed = F.concat("words", F.array(F.lit("")))
        placed = word_positions(own.select("key", listed.alias("words")))
        bucket = F.pmod(F.crc32("word"), F.lit(BUCKETS)).cast("int").alias("bucket")
        part = F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part")
        postings = placed.select("*", bucket, part).repartition("bucket", "part")
        if not own.groupBy("key").count().filter("count > 1").isEmpty():
            # Rows that share a key are one document.
            postings = postings.groupBy("bucket", "part", "word", "key").agg(
                F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"),
                F.first("length").alias("length"),
            )
        ordered = postings.sortWithinPartitions("bucket", "word", "key")
        remove(self.spark, f"{self.path}/totals/generation={generation}")
        ordered.select("word", "key", "positions", "length", "bucket").write.mode("overwrite").partitionBy(
            "bucket"
        ).parquet(f"{self.path}/postings/generation={generation}")
        known = self._stored().filter(F.col("generation") == generation)
        known = known.filter((F.col("bucket") == zlib.crc32(b"") % BUCKETS) & (F.col("word") == ""))
        totals = known.agg(
            F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("length"), F.lit(0)).alias("words")
        )
        totals.coalesce(1).write.parquet(f"{self.path}/totals/generation={generation}")

    def _stored(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/postings", POSTINGS)

    def totals(self) -> DataFrame:
        """``documents, words, generation``, a row for each generation that counts."""
        return read_or_empty(self.spark, f"{self.path}/totals", TOTALS)

    def query_words(self, query: str) -> list[str]:
        """The words of a query, cut as those of the documents."""
        one = self.spark.range(1, numPartitions=1).select(words(F.lit(query)).alias("words"))
        return one.first()["words"]

    def postings(self, wanted: set[str]) -> DataFrame:
        """Postings of these words in the generations that count; only their buckets are read."""
        generations = [r["generation"] for r in self.totals().select("generation").collect()]
        buckets = {zlib.crc32(word.encode()) % BUCKETS for word in wanted}
        return self._stored().filter(
            F.col("generation").isin(generations)
            & F.col("bucket").isin(sorted(buckets))
            & F.col("word").isin(sorted(wanted))
        )

    def ranked(self, query: str, limit: int = 20, every_word: bool = False) -> DataFrame:
        """``key, score, matched`` of the documents with the highest BM25 scores, ties to the lesser key.

        ``matched`` is the number of different query words in the document, ``every_word`` asks for all
        of them. Scores are compared after rounding to six digits. A query without words finds nothing.
        """
        wanted = set(self.query_words(query))
        found = self.postings(wanted)
        whole = self.totals().agg(F.sum("documents").alias("n"), F.sum("words").alias("words")).first()
        n = float(whole["n"] or 0)
        mean = (whole["words"] or 0) / n if n else 0.0
        holders = found.groupBy("word").agg(F.count(F.lit(1)).alias("holders"))  # a row for each query word
        rarity = F.log(F.lit(1.0) + (F.lit(n) - F.col("holders") + 0.5) / (F.col("holders") + 0.5))
        times = F.size("positions")
        damped = times + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("length") / F.lit(mean or 1.0))
        parts = found.join(F.broadcast(holders), "word").select(
            "key", (rarity * times * F.lit(K1 + 1) / damped).alias("part")
        )
        scored = parts.groupBy("key").agg(
            F.round(F.sum("part"), 6).alias("score"), F.count(F.lit(1)).cast("int").alias("matched")
        )
        if every_word:
            scored = scored.filter(F.col("matched") == len(wanted))
        return scored.orderBy(F.desc("score"), "key").limit(limit)

    def phrase(self, phrase: str) -> DataFrame:
        """``key, occurrences, first_position`` of every document that holds these words in a row."""
        wanted = self.query_words(phrase)
        different = set(wanted)
        found = self.postings(different)
        # At most one entry for each different word of the phrase.
        entries = F.collect_list(F.struct("word", "positions"))
        held = found.groupBy("key").agg(F.map_from_entries(entries).alias("at"))
        held = held.filter(F.size("at") == len(different))

        def starts(at: int) -> Column:
            return F.transform(F.col("at")[F.lit(wanted[at])], lambda position: position - at)

        common = [starts(at) for at in range(len(wanted))] or [F.array().cast("array<int>")]
        held = held.select("key", reduce(F.array_intersect, common).alias("starts"))
        return held.filter(F.size("starts") > 0).select(
            "key", F.size("starts").alias("occurrences"), F.array_min("starts").alias("first_position")
        )
