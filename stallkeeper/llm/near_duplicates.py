"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text is the weighted set of its word shingles (``SHINGLE`` words, lower case; a shorter text is
one shingle), a shingle occurring n times weighs 1 + ln n. Two texts are linked if the probability
Jaccard similarity of these sets is at least ``SIMILARITY``; classes are the connected components.

*Sketch* (Ertl, ProbMinHash): every shingle runs a Poisson process whose rate is its weight and
whose random numbers depend on the shingle alone; each arrival goes to one of ``SLOTS`` slots, and a
slot keeps the shingle that arrives first. A process ends early, when its next arrival comes after
the latest first arrival of all slots. Slots of two texts are equal with a probability that is their
probability Jaccard similarity.

*Candidates*: bands of two slots. A pair at the threshold agrees in 41 of the 64 bands on average,
and in fewer than 24 about once in 100,000 pairs. Two texts that agree in so many bands agree in
one of the 41 rarest bands of either (prefix filtering by frequency), so only these are buckets.
Texts that share no more than common passages, lines or words drop out, however many they are.

*Pairs*: equal texts are one text first. A bucket links its members to its most central one (whose
bands are the most frequent), which is a pair per member; members that are verified to be in one
class need no further comparison. After that, the members of buckets that still hold several classes
are sketched anew with eight times the slots and in bands of four, which leaves only texts with a
similarity very near the threshold in buckets. Of these, all sketches in different classes are
compared: buckets that share members form a group, a group is cut into blocks of about ``BLOCK``
members, and each two blocks of a group meet in a task, which passes on only the pairs whose sketches
agree. So every pair of a bucket is compared or already in one class, without any cap.

*Verification* compares the sketches, then the whole texts exactly.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stallkeeper.llm.common import map_batches, new_stage, values
from stallkeeper.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
SALTS = 32


@dataclass(frozen=True)
class Level:
    """Fineness of a sketch, slots per band, and the rounds of comparison with hubs on its buckets."""

    slots: int
    per_band: int
    stars: int

    @property
    def bands(self) -> int:
        return self.slots // self.per_band

    @property
    def least_bands(self) -> int:
        """Fewer bands agree about once in 100,000 pairs at the threshold."""
        p = SIMILARITY**self.per_band
        return math.floor(self.bands * p - 4.4 * math.sqrt(self.bands * p * (1 - p)))

    @property
    def least_slots(self) -> int:
        p = SIMILARITY
        return math.floor(self.slots * p - 4.5 * math.sqrt(self.slots * p * (1 - p)))


LEVELS = (Level(128, 2, 1), Level(1024, 4, 1))
BLOCK = 128
AT_ONCE = 1 << 17

_WORD = re.compile(r"\w+")
_GOLDEN = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def fingerprint(words: list[str]) -> bytes:
    """128 bits that stand for a sequence of words."""
    return xxhash.xxh3_128_digest("\n".join(words))


def shingles(words: list[str], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text as hashes, and their weights. ``known``: hashes of words."""
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(words))
    if not n:
        return h, np.zeros(0)
    rolled = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        rolled = _mixed(rolled * _STEP + h[i : len(h) - n + 1 + i])
    found, counts = np.unique(rolled, return_counts=True)
    return found, 1 + np.log(counts)


def sketches(sets: list[tuple[np.ndarray, np.ndarray]], slots: int) -> np.ndarray:
    """The shingle that arrives first in each slot of each text, folded to 32 bits.

    About ``AT_ONCE`` shingles and slots are worked on at once, which bounds the memory.
    """
    parts, start, size = [], 0, 0
    for at, (h, _) in enumerate(sets):
        size += len(h) + slots
        if size >= AT_ONCE or at + 1 == len(sets):
            parts.append(_sketches(sets[start : at + 1], slots))
            start, size = at + 1, 0
    return np.concatenate(parts)


def _sketches(sets: list[tuple[np.ndarray, np.ndarray]], slots: int) -> np.ndarray:
    hashes = np.concatenate([h for h, _ in sets])
    weights = np.concatenate([w for _, w in sets])
    owner = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    first = np.full(len(sets) * slots, np.inf)
    winner = np.zeros(len(sets) * slots, np.uint64)
    time, number = np.zeros(len(hashes)), 0
    while len(hashes):
        number += 1
        draw = _mixed(hashes + np.uint64(number * _GOLDEN % 2**64))
        time = time - np.log(((draw >> np.uint64(11)) + 0.5) * 2.0**-53) / weights
        slot = owner * slots + (_mixed(draw ^ _STEP) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        winner[slot[won]] = hashes[won]
        latest = first.reshape(-1, slots).max(1)
        going = time < latest[owner]
        hashes, weights, owner, time = (x[going] for x in (hashes, weights, owner, time))
    return (winner >> np.uint64(32)).astype("<u4").reshape(-1, slots)


def probability_jaccard(a, b) -> float:
    """Exact similarity of two weighted sets (sorted hashes, weights), independent of their scale."""
    (ha, wa), (hb, wb) = a, b
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    x, y = wa[i], wb[j]
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    ratios, which = np.unique(np.round(x / y, 12), return_inverse=True)
    below = np.array([np.maximum(x, y * r).sum() + only_a + only_b * r for r in ratios])
    return float((x / below[which]).sum())


def _sketched(rows: DataFrame, slots: int) -> DataFrame:
    """``k, node, sketch``: the fingerprint of the words and the sketch; null without a word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        known: dict[str, int] = {}
        for batch in batches:
            if len(known) > 300_000:
                known.clear()
            cut = [words_of(t) for t in values(batch, "text")]
            nodes = [fingerprint(w) if w else None for w in cut]
            distinct = {n: w for n, w in zip(nodes, cut) if n}
            found = {}
            if distinct:
                made = sketches([shingles(w, known) for w in distinct.values()], slots)
                found = {n: s.tobytes() for n, s in zip(distinct, made)}
            yield {"k": batch.column(0), "node": nodes, "sketch": [found.get(n) for n in nodes]}

    return map_batches(rows, run, f"k {rows.schema[0].dataType.simpleString()}, node binary, sketch binary")


def _buckets(nodes: DataFrame, level: Level) -> DataFrame:
    """``band, node, central``: the rare bands of every node that can have a partner."""
    width = 4 * level.per_band
    places = F.sequence(F.lit(0), F.lit(level.bands - 1))
    bands = F.transform(
        places, lambda i: F.xxhash64(i, F.substring("sketch", i * width + 1, F.lit(width)))
    )
    all_bands = nodes.select("node", F.explode(bands).alias("band"))
    shared = all_bands.groupBy("band").count().where("count > 1")
    shared = all_bands.join(shared, "band")
    # At most as many rows per node as there are bands.
    own = shared.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("count", "band"))).alias("found"),
        F.sum("count").alias("central"),
    )
    alone = F.lit(level.bands) - F.size("found")  # bands of no other text, the rarest of all
    own = own.where(F.size("found") >= level.least_bands)
    prefix = F.lit(level.bands - level.least_bands + 1)
    rare = F.slice("found", F.lit(1), F.greatest(prefix - alone, F.lit(0)))
    found = own.select("node", "central", F.explode(rare).alias("x"))
    return found.select(F.col("x.band").alias("band"), "node", "central")


def _verified(
    pairs: DataFrame, nodes: DataFrame, level: Level, docs: DataFrame, stage, name: str
) -> DataFrame:
    """The pairs ``a, b`` whose exact similarity reaches the threshold."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side in "ab":
        own = nodes.select(F.col("node").alias(side), F.col("sketch").alias(f"sketch_{side}"))
        pairs = pairs.join(own, side)

    def alike(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(values(batch, f"sketch_{s}")), "<u4").reshape(-1, level.slots)
                for s in "ab"
            )
            likely = np.flatnonzero((x == y).sum(1) >= level.least_slots)
            yield {s: batch.column(batch.schema.get_field_index(s)).take(likely) for s in "ab"}

    pairs = stage(map_batches(pairs, alike, "a binary, b binary"), f"{name}_likely")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = asked.join(nodes.select("node", "k"), "node").join(docs, "k").select("node", "text")
    texts = stage(texts, f"{name}_texts")
    for side in "ab":
        own = texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(own, side)

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        known: dict[str, int] = {}
        sets: dict[bytes, tuple] = {}

        def of(node: bytes, text: str):
            if node not in sets:
                words = words_of(text)
                # Another text under the same id is not the one that was asked for.
                sets[node] = shingles(words, known) if fingerprint(words) == node else None
            return sets[node]

        for batch in batches:
            if len(known) > 300_000 or len(sets) > 256:
                known.clear()
                sets.clear()
            out = {"a": [], "b": []}
            columns = (values(batch, n) for n in ("a", "b", "text_a", "text_b"))
            for a, b, text_a, text_b in zip(*columns):
                x, y = of(a, text_a), of(b, text_b)
                if x and y and probability_jaccard(x, y) >= SIMILARITY - 1e-12:
                    out["a"].append(a)
                    out["b"].append(b)
                if len(sets) > 2048:
                    sets.clear()
            yield out

    return stage(map_batches(pairs, exact, "a binary, b binary"), f"{name}_links")


def _alike_in_blocks(left: DataFrame, nodes: DataFrame, level: Level, stage) -> DataFrame:
    """``node, b``: pairs of members of one group, in different classes, with agreeing sketches."""
    # Members of a bucket hang on its least member; these links join buckets to groups.
    least = left.groupBy("band").agg(F.min("node").alias("b"))
    hung = left.join(least, "band").select(F.col("node").alias("a"), "b")
    groups = components(hung, stage, "groups").withColumnRenamed("component", "group")
    members = left.select("node", "component").distinct().join(groups, "node")
    size = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    members = members.join(size, "group").withColumn("block", block)
    members = members.join(nodes.select("node", "sketch"), "node")
    # About BLOCK rows per list, by the hash of the node.
    row = F.struct("node", "component", "sketch")
    blocks = members.groupBy("group", "block").agg(F.collect_list(row).alias("rows"))
    blocks = stage(blocks, "blocks")
    first = blocks.select("group", F.col("block").alias("i"), F.col("rows").alias("x"))
    ids = blocks.select("group", F.col("block").alias("j"))
    met = first.select("group", "i").join(ids, "group").where("i <= j").repartition("group", "i", "j")
    second = blocks.select("group", F.col("block").alias("j"), F.col("rows").alias("y"))
    met = met.join(first, ["group", "i"]).join(second, ["group", "j"]).select("x", "y")

    def alike(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for x, y in zip(values(batch, "x"), values(batch, "y")):
                sketches_y = np.frombuffer(b"".join(r["sketch"] for r in y), "<u4")
                sketches_y = sketches_y.reshape(-1, level.slots)
                out = {"node": [], "b": []}
                for r in x:
                    own = np.frombuffer(r["sketch"], "<u4")
                    agree = (sketches_y == own).sum(1) >= level.least_slots
                    for o in (y[i] for i in np.flatnonzero(agree)):
                        if o["component"] != r["component"]:
                            out["node"].append(r["node"])
                            out["b"].append(o["node"])
                yield out

    return map_batches(met, alike, "node binary, b binary")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``class_id`` of every row: the least key of the texts it is a near-duplicate of.

    Texts that differ in case, white space or marks only are equal. A null text, and one without a
    word, is in a class of its own. Repeated rows, and rows under one key, get a row each. A row
    without a key is linked to equal texts only. Other columns are not read.
    """
    stage = new_stage(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"))
    sketched = stage(_sketched(rows, LEVELS[0].slots), "sketched")
    known = sketched.where("node is not null")
    nodes = known.groupBy("node").agg(F.min("k").alias("k"), F.first("sketch").alias("sketch"))
    nodes = texts_once = stage(nodes, "nodes")
    links, classes = None, None

    def several(members: DataFrame, name: str) -> DataFrame:
        """The members of buckets that hold more than one class, with their classes."""
        if classes is None:
            members = members.withColumn("component", F.col("node"))
        else:
            members = members.drop("component").join(classes, "node", "left")
            members = members.withColumn("component", F.coalesce("component", "node"))
        ends = (F.min("component").alias("x"), F.max("component").alias("y"))
        mixed = members.groupBy("band").agg(*ends).where("x <> y").select("band")
        return stage(members.join(mixed, "band", "left_semi"), name)

    def compare(pairs: DataFrame, name: str) -> None:
        nonlocal links, classes
        found = _verified(pairs.select(F.col("node").alias("a"), "b"), nodes, level, rows, stage, name)
        if found.isEmpty():
            return
        links = found if links is None else links.unionAll(found)
        classes = components(links, stage, f"{name}_classes")

    for depth, level in enumerate(LEVELS):
        last = depth == len(LEVELS) - 1
        if depth:
            # The whole texts of the members that are left, sketched anew.
            asked = nodes.join(left.select("node").distinct(), "node", "left_semi")
            texts = asked.select("node", "k").join(rows, "k").select("k", "text")
            anew = _sketched(texts, level.slots).join(asked.select("k", "node"), ["k", "node"])
            nodes = stage(anew, f"nodes_{depth}")
        left = several(stage(_buckets(nodes, level), f"buckets_{depth}"), f"left_{depth}")
        for number in range(level.stars):
            if left.isEmpty():
                break
            # The hub of each bucket, as one row per bucket.
            hub = F.max(F.struct("central", "node", "component")).alias("hub")
            hubs = left.groupBy("band").agg(hub).select(
                "band", F.col("hub.node").alias("b"), F.col("hub.component").alias("other")
            )
            met = left.join(stage(hubs, f"hubs_{depth}_{number}"), "band").where("node <> b")
            compare(met.where("component <> other"), f"star_{depth}_{number}")
            left = several(met.drop("b", "other"), f"left_{depth}_{number}")
        if left.isEmpty():
            break
        if last:
            compare(_alike_in_blocks(left, nodes, level, stage), "rest")
    if classes is not None:
        # Per text, not per row; the members of a class are dealt over salts.
        salt = F.pmod(F.xxhash64("node"), F.lit(SALTS))
        members = texts_once.select("node", "k").join(classes, "node").withColumn("salt", salt)
        parts = members.groupBy("component", "salt").agg(F.min("k").alias("k"))
        parts = stage(parts, "class_parts")
        least = stage(parts.groupBy("component").agg(F.min("k").alias("class_id")), "class_ids")
        named = stage(parts.drop("k").join(least, "component"), "class_salts")
        linked = members.join(named, ["component", "salt"]).select("node", "class_id")
        own = texts_once.select("node", "k").join(linked, "node", "left")
        own = own.select("node", F.coalesce("class_id", "k").alias("class_id"))
    else:
        own = texts_once.select("node", F.col("k").alias("class_id"))
    whole = known.select("k", "node").join(stage(own, "classes_of_texts"), "node").select("k", "class_id")
    alone = sketched.where("node is null").select("k", F.col("k").alias("class_id"))
    return whole.unionAll(alone).withColumnRenamed("k", key)
