"""Approximate nearest neighbours by multi-index hashing over learned, rotated binary codes.

*Codes*: principal axes and rotations that bring the signs of the rotated vectors near the vectors
(ITQ: Gong and Lazebnik) are learned on at most ``SAMPLE_ROWS`` vectors. A code has ``BITS`` bits, the
signs under as many rotations as that takes. Vectors of fewer than ``LEAST_DIMENSIONS`` components get
one more, constant, and rotations by chance, so that their bits cut the space apart from its centre.

*Index*: all vectors are dealt evenly to shards of about ``SHARD_ROWS`` rows, however often one of
them is repeated. A shard is one row: ids, vectors, codes, and for every substring of ``SUBSTRING``
bits the rows in the order of its value, with the place where each value begins.

*Search* (Norouzi et al., multi-index hashing): a query probes, in each substring, the values that
differ from its own in 0, then 1, then 2 bits. After level s, and level s + 1 in the first j
substrings, every code within the Hamming radius ``(s + 1) * substrings + j - 1`` has been met: a code
beyond all these probes differs in more bits. What the radius holds is ranked by the original
vectors. The radius a query needs follows from the k vectors found so far: two vectors at the angle
``pi * p`` differ in ``BITS * p`` bits on average, so the search ends when the radius covers that
number for the widest angle among the k, and ``DEVIATIONS`` standard deviations more. Nothing else ends
it: there is no cap on codes or candidates, and a query with fewer than k neighbours sees all of them.

Shards and blocks of queries meet by an equi-join on the number of the block. The work is a search of
each shard for each query; the queries grow with the table, so nothing but the rotations is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stallkeeper.llm.common import map_batches, new_stage, values
from stallkeeper.llm.exact_topk import usable

BITS = 256
SUBSTRING = 8
SUBSTRINGS = BITS // SUBSTRING
# A row has to fit the 16 bits of a shard's tables.
SHARD_ROWS = 16_384
QUERY_BLOCK = 256
SALTS = 32
DEVIATIONS = 2.0
# Bound of the fit: rows, and components of all these rows.
SAMPLE_ROWS = 4096
SAMPLE_VALUES = 2**21
ROUNDS = 10
LEAST_DIMENSIONS = 16

_VALUES = np.arange(2**SUBSTRING, dtype=np.uint8)
# Values of a substring by the number of bits in which they differ from 0.
_RINGS = [_VALUES[np.bitwise_count(_VALUES) == s] for s in range(SUBSTRING + 1)]


@dataclass(frozen=True)
class Coder:
    """Vectors to their place along the learned axes, and to codes."""

    centre: np.ndarray
    axes: np.ndarray
    constant: float  # the added component, 0 for none
    rotations: np.ndarray

    def placed(self, vectors: np.ndarray) -> np.ndarray:
        out = (vectors - self.centre) @ self.axes
        if self.constant:
            out = np.column_stack([out, np.full(len(out), self.constant)])
        return out

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """A row of ``SUBSTRINGS`` bytes for each vector."""
        return np.packbits(self.placed(vectors) @ self.rotations > 0, axis=1)


def fit_coder(sample: np.ndarray) -> Coder:
    width = sample.shape[1]
    centre = sample.mean(0)
    moved = sample - centre
    _, _, axes = np.linalg.svd(moved.T @ moved)
    axes = axes[:BITS].T
    constant = 0.0
    if width < LEAST_DIMENSIONS:
        constant = float(np.sqrt((moved**2).sum(1).mean())) or 1.0
    placed = Coder(centre, axes, constant, np.zeros(0)).placed(sample)
    draw, rotations = np.random.default_rng(0), []
    while sum(r.shape[1] for r in rotations) < BITS:
        rotation = np.linalg.qr(draw.normal(size=(placed.shape[1],) * 2))[0]
        for _ in range(0 if constant else ROUNDS):
            left, _, right = np.linalg.svd(np.sign(placed @ rotation).T @ placed)
            rotation = (left @ right).T
        rotations.append(rotation)
    return Coder(centre, axes, constant, np.hstack(rotations)[:, :BITS])


@dataclass
class Shard:
    """Vectors with their codes and, by substring, their rows in the order of its value."""

    ids: np.ndarray
    vectors: np.ndarray
    codes: np.ndarray
    order: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray, coder: Coder) -> Shard:
        codes = coder.codes(vectors)
        order = np.argsort(codes, axis=0, kind="stable").T.astype(np.uint16)
        start = np.zeros((SUBSTRINGS, 2**SUBSTRING + 1), np.int32)
        for j in range(SUBSTRINGS):
            start[j, 1:] = np.cumsum(np.bincount(codes[:, j], minlength=2**SUBSTRING))
        return cls(ids, vectors, codes, np.ascontiguousarray(order), start)

    def packed(self) -> dict:
        arrays = (self.ids, self.vectors, self.codes, self.order, self.start)
        return {n: [a.tobytes()] for n, a in zip(SHARD_COLUMNS, arrays)}

    @classmethod
    def unpacked(cls, row: dict) -> Shard:
        ids = np.frombuffer(row["ids"], "<i8")
        shape = {
            "vectors": ("<f8", (len(ids), -1)),
            "codes": (np.uint8, (len(ids), SUBSTRINGS)),
            "ordered": ("<u2", (SUBSTRINGS, len(ids))),
            "begins": ("<i4", (SUBSTRINGS, 2**SUBSTRING + 1)),
        }
        return cls(ids, *(np.frombuffer(row[n], t).reshape(s) for n, (t, s) in shape.items()))

    def nearest(
        self, key: int, vector: np.ndarray, coder: Coder, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, nearest first; not those with the id ``key``."""
        code = coder.codes(vector[None])[0]
        words, own = self.codes.view("<u8"), code.view("<u8")
        place = coder.placed(vector[None])[0]
        place = place / (np.linalg.norm(place) or 1.0)
        seen = self.ids == key
        rows, bits = np.zeros(0, np.int64), np.zeros(0, np.int64)
        apart = np.full(len(self.ids), np.nan)

        def rank(chosen: np.ndarray) -> None:
            chosen = chosen[np.isnan(apart[chosen])]
            apart[chosen] = np.sqrt(((self.vectors[chosen] - vector) ** 2).sum(1))

        def best(chosen: np.ndarray) -> np.ndarray:
            d = apart[chosen]
            if len(d) > k:
                chosen = chosen[d <= np.partition(d, k - 1)[k - 1]]
            return chosen[np.lexsort((self.ids[chosen], apart[chosen]))[:k]]

        def needed(chosen: np.ndarray) -> float:
            """The radius that the k nearest of these rows ask for."""
            there = coder.placed(self.vectors[best(chosen)])
            cosine = there @ place / np.maximum(np.linalg.norm(there, axis=1), 1e-300)
            p = float(np.arccos(np.clip(cosine, -1, 1)).max() / np.pi)
            return BITS * p + DEVIATIONS * np.sqrt(BITS * p * (1 - p))

        radius, goal = -1, None
        for level, ring in enumerate(_RINGS):
            for j in range(SUBSTRINGS):
                start = self.start[j]
                met = [
                    self.order[j, start[v] : start[v + 1]] for v in (ring ^ code[j]).tolist()
                ]
                met = np.concatenate(met)
                met = met[~seen[met]].astype(np.int64)
                if len(met):
                    seen[met] = True
                    rows = np.append(rows, met)
                    bits = np.append(bits, np.bitwise_count(words[met] ^ own).sum(1))
                radius = level * SUBSTRINGS + j
                if goal is not None and radius >= goal:
                    break
                if goal is None and (j % 4 == 3) and (within := bits <= radius).sum() >= k:
                    # The nearest codes tell how far to go; what lies within it is ranked at the end.
                    near = rows[within][np.argsort(bits[within], kind="stable")[: 4 * k]]
                    rank(near)
                    goal = needed(near)
                    if radius >= goal:
                        break
            else:
                continue
            break
        chosen = rows[bits <= (radius if goal is None else goal)]
        rank(chosen)
        chosen = best(chosen)
        return self.ids[chosen], apart[chosen]


SHARD_COLUMNS = ("ids", "vectors", "codes", "ordered", "begins")
SHARD_SCHEMA = ", ".join(f"{n} binary" for n in SHARD_COLUMNS)


def _vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vector`` of the rows that take part."""
    v = F.col(f"`{vector}`")
    some = F.exists(v, lambda x: x.cast("double") != 0.0)
    return rows.where(usable(v) & some & F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("id"), v.cast("array<double>").alias("vector")
    )


def _matrix(rows: list[list[float]], width: int) -> np.ndarray:
    """Rows filled up with zeros."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def learn_codes(candidates: DataFrame, width: int) -> Coder:
    """Fitted on a sample by the hash of the row, of at most ``SAMPLE_ROWS`` rows."""
    size = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // max(width, 1)))
    sample = candidates.orderBy(F.xxhash64("id", "vector"), "id").limit(size).select("vector")
    return fit_coder(_matrix([r[0] for r in sample.collect()], width))


def build_index(candidates: DataFrame, count: int, width: int, coder: Coder) -> DataFrame:
    """One row for each shard of the rows ``id, vector``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        ids: list[int] = []
        kept: list[np.ndarray] = []

        def shard() -> dict:
            made = Shard.of(np.array(ids, "<i8"), np.concatenate(kept), coder)
            ids.clear()
            kept.clear()
            return made.packed()

        for batch in batches:
            own = values(batch, "id")
            matrix = _matrix(values(batch, "vector"), width)
            at = 0
            while at < len(own):
                n = min(len(own) - at, SHARD_ROWS - len(ids))
                ids += own[at : at + n]
                kept.append(matrix[at : at + n])
                at += n
                if len(ids) == SHARD_ROWS:
                    yield shard()
        if ids:
            yield shard()

    return map_batches(candidates.repartition(-(-count // SHARD_ROWS) or 1), run, SHARD_SCHEMA)


def nearest(
    queries: DataFrame, candidates: DataFrame, key: str, vector: str, k: int = 10
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest candidates found, by distance.

    ``score`` is the Euclidean distance of the original vectors in double precision; ties go to the
    smaller id. A row is never its own candidate. Vectors that are null, empty, zero or hold a null,
    NaN or infinite component take no part, on either side, and neither do rows with a null id;
    shorter vectors count as filled up with zeros. A query without candidates gives no row. Rows
    repeated under one id are candidates as often as they occur. Other columns are not read.
    """
    stage = new_stage(queries.sparkSession)
    given = stage(_vectors(candidates, key, vector), "vectors")
    asked = stage(_vectors(queries, key, vector), "queries")
    size = F.coalesce(F.max(F.size("vector")), F.lit(1))
    count, width = given.agg(F.count("*"), size).first()
    questions, other = asked.agg(F.count("*"), size).first()
    width = max(width, other)
    if not count:
        empty = "query_id long, rank int, vec_id long, score double"
        return queries.sparkSession.createDataFrame([], empty)
    coder = learn_codes(given, width)
    index = stage(build_index(given, count, width, coder), "index")
    blocks = -(-questions // QUERY_BLOCK) or 1

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            own = values(batch, "id")
            matrix = _matrix(values(batch, "vector"), width)
            for at in range(0, len(own), QUERY_BLOCK):
                yield {
                    "q_ids": [np.array(own[at : at + QUERY_BLOCK], "<i8").tobytes()],
                    "q_vectors": [matrix[at : at + QUERY_BLOCK].tobytes()],
                }

    asked = map_batches(asked.repartition(blocks), pack, "q_ids binary, q_vectors binary")
    asked = stage(asked.withColumn("block", F.spark_partition_id()), "query_blocks")
    salted = index.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)).cast("int"))
    pairs = salted.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(
        asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))),
        ["block", "salt"],
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard.unpacked(row)
                ids = np.frombuffer(row["q_ids"], "<i8")
                matrix = np.frombuffer(row["q_vectors"], "<f8").reshape(len(ids), -1)
                out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
                for q, v in zip(ids, matrix):
                    found, d = shard.nearest(q, v, coder, k)
                    out["query_id"].append(np.full(len(found), q))
                    out["vec_id"].append(found)
                    out["score"].append(d)
                yield {n: np.concatenate(x) for n, x in out.items()}

    found = map_batches(pairs, search, "query_id long, vec_id long, score double")
    # The window keeps k rows per query and task before its shuffle (group limit).
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
