"""Exact top-k search: sparse query rows scatter weighted postings into dense score arrays.

A block of candidates is turned into postings, one list of (row, weight) per dimension. A block of
queries is worked off term by term: every query with a weight in a dimension adds that weight
times the postings to its own dense array of scores. All scores of a block are complete when the
last term is done; a partition selection keeps the ``k`` best of each query, and the selections of
all blocks are merged. Scores are integers, so the order is exact.

Queries and candidates meet as blocks by an equi-join on the number of the query block: every
candidate block is sent to every query block, which is the stated work of the search, and nothing
larger than one pair of blocks is held in a task. Nothing is broadcast, because the queries grow
with the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stallkeeper.llm.common import map_batches, new_stage, values

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048
# The candidate blocks that meet one query block are spread over so many tasks.
SALTS = 32
SCALE = 1024


def usable(vector: Column) -> Column:
    """The vector is there, and so is every component, as a finite number."""
    finite = ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return vector.isNotNull() & finite


def integer_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``weights``: components as ``floor(SCALE * x)``; rows that cannot take part go."""
    v = F.col(f"`{vector}`")
    whole = F.transform(v, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))
    return rows.where(usable(v) & F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("id"), whole.alias("weights")
    )


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows in blocks of at most ``size``: ids, weights and the row lengths, as bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        ids, weights = [], []

        def block() -> dict:
            lengths = np.array([len(w) for w in weights], "<i8")
            flat = np.concatenate([np.asarray(w, "<i8") for w in weights])
            packed = (np.array(ids, "<i8").tobytes(), lengths.tobytes(), flat.tobytes())
            return {n: [x] for n, x in zip(("ids", "lengths", "weights"), packed)}

        for batch in batches:
            for i, w in zip(values(batch, "id"), values(batch, "weights")):
                ids.append(i)
                weights.append(w)
                if len(ids) == size:
                    yield block()
                    ids, weights = [], []
        if ids:
            yield block()

    return map_batches(rows, run, "ids binary, lengths binary, weights binary")


def _matrix(lengths: bytes, flat: bytes, width: int) -> np.ndarray:
    """Rows padded with zeros, which add nothing to an inner product."""
    n, data = np.frombuffer(lengths, "<i8"), np.frombuffer(flat, "<i8")
    out = np.zeros((len(n), width), np.int64)
    out[np.arange(width)[None, :] < n[:, None]] = data
    return out


def block_scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """All inner products of two blocks, gathered term by term."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(queries.shape[1]):
        asking = np.flatnonzero(queries[:, term])
        postings = np.flatnonzero(candidates[:, term])
        if not len(asking) or not len(postings):
            continue
        weights = candidates[postings, term]
        whole = len(postings) == len(candidates)
        for q in asking:
            if whole:
                scores[q] += queries[q, term] * weights
            else:
                scores[q, postings] += queries[q, term] * weights
    return scores


def best_of_block(query_id: int, scores: np.ndarray, ids: np.ndarray, k: int):
    """The k best of one score array: highest score first, ties to the smaller id."""
    use = np.flatnonzero(ids != query_id)
    s = scores[use]
    if len(use) > k:
        edge = np.partition(s, len(s) - k)[len(s) - k]
        use = use[s >= edge]
        s = scores[use]
    order = np.lexsort((ids[use], -s))[:k]
    return ids[use][order], s[order]


def top_k(
    queries: DataFrame, candidates: DataFrame, key: str, vector: str, k: int = 10
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best candidates by inner product.

    Both sides are tables with an integer id ``key`` and an array ``vector``; a row is never its
    own candidate. Vectors that are null or hold a null, NaN or infinite component take no part, on
    either side, and neither do rows with a null id; shorter vectors count as filled up with
    zeros. A query without candidates gives no row. Rows repeated under one id are candidates as
    often as they occur. Other columns are not read.
    """
    stage = new_stage(queries.sparkSession)
    asked = stage(integer_vectors(queries, key, vector), "queries")
    blocks = -(-asked.count() // QUERY_BLOCK) or 1
    asked = _packed(asked.repartition(blocks), QUERY_BLOCK)
    asked = asked.withColumn("block", F.spark_partition_id())
    given = _packed(integer_vectors(candidates, key, vector), CANDIDATE_BLOCK)
    given = given.select(*(F.col(c).alias(f"c_{c}") for c in given.columns))
    given = given.withColumn("salt", F.pmod(F.xxhash64("c_ids"), F.lit(SALTS)).cast("int"))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    pairs = given.withColumn("block", every_block).join(
        stage(asked, "query_blocks").withColumn("salt", every_salt), ["block", "salt"]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                other = np.frombuffer(row["c_ids"], "<i8")
                lengths = np.frombuffer(row["lengths"] + row["c_lengths"], "<i8")
                width = int(lengths.max(initial=0))
                asking = _matrix(row["lengths"], row["weights"], width)
                scores = block_scores(asking, _matrix(row["c_lengths"], row["c_weights"], width))
                out = {"query_id": [], "vec_id": [], "score": []}
                for q, found in zip(ids, scores):
                    best, s = best_of_block(q, found, other, k)
                    out["query_id"].append(np.full(len(best), q))
                    out["vec_id"].append(best)
                    out["score"].append(s)
                if out["query_id"]:
                    yield {n: np.concatenate(x) for n, x in out.items()}

    found = map_batches(pairs, run, "query_id long, vec_id long, score long")
    # The window keeps k rows per query and task before its shuffle (group limit).
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
