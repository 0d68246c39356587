"""The prefix trie of conversations, from double-array tries of prefix shards.

A node is a distinct sequence of first turns; its members are the conversations that begin with it.

1. Every turn becomes 16 bytes (of the SHA-256 of role and text) and its size where it is read; texts go
   no further. Equal conversations become one *sequence* with their number and least id before any
   shuffle of sequences. The hash of the ids of equal conversations is taken over pieces: a range
   partition by sequence and id joins the ids of each run, and what hashes a sequence's ids in order
   reads a row for each run.
2. *Shards*: a prefix is heavy if more than half a shard's fair share of sequences begin with it; the root
   always is. A sequence goes to the shard of its first prefix that is not heavy, so the sequences
   behind a common opening are spread, and all nodes below heavy prefixes lie in one shard each.
3. *Double array*: a shard numbers its turns densely and packs its trie: the child of slot ``s`` by the
   turn ``x`` is the slot ``BASE[s] + x``, if ``CHECK`` of that slot is ``s``. Families are placed by
   size, the large ones where all their slots are free, the single children in what is left.
   Sequences walk the arrays, a level at a time, and leave their numbers at the slots; ``CHECK`` leads
   the sums back up.
4. Nodes of heavy prefixes are in several shards; their partial sums are merged by key, and what lies
   below them is added up along their ancestors. There are at most ``2 * shards`` of them per level, down
   to ``SPLIT_DEPTH`` levels, so they are few; all other nodes are final when a shard emits them.

A conversation's turns are one row of about 24 bytes per turn, and an array in one task. Beyond
``SPLIT_DEPTH`` turns a heavy prefix is not split any further.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stallkeeper.llm.common import map_batches, new_stage, values

ID_BYTES = 16
SPLIT_DEPTH = 64
# Turns of a shard, about: what a task holds is some hundred bytes for each.
SHARD_TURNS = 500_000
# Free slots that are tried for a family before it is put at the end.
TRIES = 64
NONE = np.iinfo(np.int64).min

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def turn_ids(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, place, id, size`` of every turn: its place in the conversation, from 1.

    Turns are in the order of ``turn``, null first, those of equal number in that of role and text. A null
    role or text is empty. Rows without a key are left out.
    """
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    one = F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said)
    rows = rows.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.substring(F.unhex(F.sha2(one, 256)), 1, ID_BYTES).alias("id"),
        F.octet_length(said[1]).cast("long").alias("size"),
    )
    return numbered(rows, F.col("turn").asc_nulls_first(), F.col("id"))


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("conv").orderBy(*order)).cast("long")
    return rows.select("conv", place.alias("place"), "id", "size")


def prefix_key(path: bytes) -> bytes:
    """What stands for a sequence of turn ids; ``_sequences`` has the same as an expression."""
    return hashlib.sha256(path.hex().upper().encode()).digest()


def _whole(turns: DataFrame, conversations: DataFrame | None) -> DataFrame:
    """``conv, end, path, sizes``: a row for each conversation, with its turns in order."""
    one = F.struct("place", "id", "size")
    whole = turns.groupBy("conv").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    if conversations is not None:
        keys = conversations.select(F.col(conversations.columns[0]).cast("long").alias("conv"))
        whole = keys.where("conv is not null").distinct().join(whole, "conv", "left")
        none = F.array().cast("array<struct<place:long,id:binary,size:long>>")
        whole = whole.withColumn("turns", F.coalesce("turns", none))
    path = F.array_join(F.transform("turns", lambda x: F.hex(x["id"])), "")
    return whole.select(
        "conv",
        F.unhex(F.sha2(path, 256)).alias("end"),
        F.unhex(path).alias("path"),
        F.col("turns.size").alias("sizes"),
    )


def _end_hashes(whole: DataFrame) -> DataFrame:
    """``end, ends``: the SHA-256 of the ids of equal conversations, ascending, joined by commas."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        now, ids = None, []
        for batch in batches:
            out = {"end": [], "first": [], "ids": []}

            def close() -> None:
                out["end"].append(now)
                out["first"].append(ids[0])
                out["ids"].append(",".join(map(str, ids)))

            for end, conv in zip(values(batch, "end"), values(batch, "conv")):
                if ids and (end != now or len(ids) >= 100_000):
                    close()
                    ids = []
                now = end
                ids.append(conv)
            yield out
        if ids:
            yield {"end": [now], "first": [ids[0]], "ids": [",".join(map(str, ids))]}

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        now, state = None, None
        for batch in batches:
            out = {"end": [], "ends": []}
            for end, ids in zip(values(batch, "end"), values(batch, "ids")):
                if end != now:
                    if state:
                        out["end"].append(now)
                        out["ends"].append(state.hexdigest())
                    now, state = end, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield out
        if state:
            yield {"end": [now], "ends": [state.hexdigest()]}

    ids = whole.select("end", "conv").repartitionByRange("end", "conv")
    ids = ids.sortWithinPartitions("end", "conv")
    runs = map_batches(ids, pieces, "end binary, first long, ids string")
    runs = runs.repartition("end").sortWithinPartitions("end", "first")
    return map_batches(runs, hashed, "end binary, ends string")


def _heavy(sequences: DataFrame, least: int) -> set[bytes]:
    """Prefixes of more than ``least`` sequences, down to ``SPLIT_DEPTH`` turns: a bounded number."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for path in values(batch, "path"):
                for at in range(ID_BYTES, min(len(path), SPLIT_DEPTH * ID_BYTES) + 1, ID_BYTES):
                    found[hashlib.blake2b(path[:at], digest_size=16).digest()] += 1
            if len(found) > 200_000:
                yield {"prefix": list(found), "n": list(found.values())}
                found.clear()
        yield {"prefix": list(found), "n": list(found.values())}

    counted = map_batches(sequences.select("path"), count, "prefix binary, n long")
    counted = counted.groupBy("prefix").agg(F.sum("n").alias("n"))
    return {bytes(r[0]) for r in counted.where(F.col("n") > least).select("prefix").collect()}


def _dealt(sequences: DataFrame, heavy: set[bytes]) -> DataFrame:
    """With ``above``, the number of turns in heavy prefixes, and ``shard``, what it is dealt by."""
    schema = "n long, conv long, path binary, sizes array<long>, ends string, above int, shard binary"

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            above, shard = [], []
            for path in values(batch, "path"):
                depth = 0
                while depth * ID_BYTES < len(path):
                    key = path[: (depth + 1) * ID_BYTES]
                    if hashlib.blake2b(key, digest_size=16).digest() not in heavy:
                        break
                    depth += 1
                above.append(depth)
                shard.append(hashlib.blake2b(path[: (depth + 1) * ID_BYTES], digest_size=16).digest())
            kept = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            yield kept | {"above": above, "shard": shard}

    return map_batches(sequences.select("n", "conv", "path", "sizes", "ends"), deal, schema)


class DoubleArray:
    """A trie in two arrays, packed from the sorted, distinct sequences of dense turn numbers."""

    def __init__(self, sequences: list[np.ndarray]):
        parents, labels = self._nodes(sequences)
        self._pack(parents, labels)

    @staticmethod
    def _nodes(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Parent and last turn of each node; the root is node 0 and has neither."""
        parents, labels = [np.array([-1])], [np.array([-1])]
        line, last, count = np.zeros(1, np.int64), np.zeros(0, np.int64), 1
        for own in sequences:
            n = min(len(own), len(last))
            unlike = np.flatnonzero(own[:n] != last[:n])
            common = int(unlike[0]) if len(unlike) else n
            new = np.arange(count, count + len(own) - common)
            line = np.concatenate([line[: common + 1], new])
            parents.append(line[common:-1] if len(new) else new)
            labels.append(own[common:])
            last, count = own, count + len(new)
        return np.concatenate(parents), np.concatenate(labels)

    def _pack(self, parents: np.ndarray, labels: np.ndarray) -> None:
        nodes = np.arange(1, len(parents))
        nodes = nodes[np.lexsort((labels[1:], parents[1:]))]
        first = np.flatnonzero(np.diff(parents[nodes], prepend=-1))
        sizes = np.diff(np.append(first, len(nodes)))
        slot = np.zeros(len(parents), np.int64)
        base = np.full(len(parents), NONE)
        used, top, free = bytearray(1024), 1, 1
        used[0] = 1
        for family in np.argsort(-sizes, kind="stable").tolist():
            children = nodes[first[family] : first[family] + sizes[family]]
            own = labels[children]
            free = used.find(0, free)
            if free < 0:
                free = len(used)
            spread, steps = own - own[0], (own - own[0]).tolist()
            at, tries = free, 0
            while len(steps) > 1 and at < top:
                if not any(used[at + x] for x in steps if at + x < len(used)):
                    break
                tries, at = tries + 1, used.find(0, at + 1)
                if at < 0 or tries == TRIES:
                    at = top
            if at + steps[-1] >= len(used):
                used.extend(bytes(max(len(used), at + steps[-1] + 1 - len(used))))
            for x in steps:
                used[at + x] = 1
            top = max(top, at + steps[-1] + 1)
            slot[children] = at + spread
            base[parents[children[0]]] = at - own[0]
        self.base = np.full(top, NONE)
        self.check = np.full(top, -1)
        self.base[slot] = base
        self.check[slot[1:]] = slot[parents[1:]]

    def step(self, slots: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The children of the slots by these turns, -1 where there is none."""
        to = np.where(self.base[slots] == NONE, -1, self.base[slots] + turns)
        there = (to >= 0) & (to < len(self.check))
        there[there] = self.check[to[there]] == slots[there]
        return np.where(there, to, -1)


def _shard_nodes(rows: list[dict]) -> dict[str, list]:
    """The nodes of a shard: final ones, and partial sums of those above (``key`` is not null)."""
    ids = np.frombuffer(b"".join(r["path"] for r in rows), f"V{ID_BYTES}")
    _, dense = np.unique(ids, return_inverse=True)
    lengths = np.array([len(r["path"]) // ID_BYTES for r in rows])
    begin = np.cumsum(lengths) - lengths
    paths = [dense[b : b + n] for b, n in zip(begin, lengths)]
    order = sorted(range(len(rows)), key=lambda i: paths[i].astype(">i8").tobytes())
    rows, lengths = [rows[i] for i in order], lengths[order]
    paths = [paths[i] for i in order]
    trie = DoubleArray(paths)
    size = len(trie.check)
    n, conv = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    own, depth = np.zeros(size, np.int64), np.full(size, -1)
    above, sample, ends = np.zeros(size, bool), np.zeros(size, np.int64), np.full(size, -1)
    weight, least = (np.array([r[c] for r in rows]) for c in ("n", "conv"))
    heavy = np.array([r["above"] for r in rows])
    turns, begin = np.concatenate(paths), np.cumsum(lengths) - lengths
    sizes = np.concatenate([np.asarray(r["sizes"], np.int64) for r in rows])
    slots, going, level = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
    levels = []
    while len(going):
        here = slots[going]
        np.add.at(n, here, weight[going])
        np.minimum.at(conv, here, least[going])
        if level:
            own[here] = sizes[begin[going] + level - 1]
        depth[here], sample[here] = level, going
        above[here] = heavy[going] >= level
        over = lengths[going] == level
        ends[here[over]] = going[over]
        levels.append(np.unique(here))
        going = going[~over]
        slots[going] = trie.step(slots[going], turns[begin[going] + level])
        assert (slots[going] > 0).all()
        level += 1
    children, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    for here in reversed(levels):
        final = here[~above[here]]
        leaves[final] += children[final] == 0
        saved[final] += (n[final] - 1) * own[final]
        up = trie.check[final]
        # What is below nodes above is added up when these are merged.
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[final])
        np.add.at(saved, up, saved[final])
    there = np.flatnonzero(depth >= 0)
    keys: dict[bytes, bytes] = {}

    def key_of(s: int, turns: int) -> bytes:
        path = rows[sample[s]]["path"][: turns * ID_BYTES]
        if path not in keys:
            keys[path] = prefix_key(path)
        return keys[path]

    up = trie.check[there]
    cut = ~above[there] & above[up]
    inner = ~above[there] & ~above[up]
    out = {
        "conv_id": conv[there],
        "depth": depth[there],
        "parent_conv_id": [c if i else None for c, i in zip(conv[up].tolist(), inner.tolist())],
        "n_convs": n[there],
        "n_children": children[there],
        "n_leaves": leaves[there],
        "saved_tokens": saved[there],
        "ends_sha256": [rows[e]["ends"] if e >= 0 else None for e in ends[there].tolist()],
        "size": own[there],
    }
    line = [int(d) for d in depth[there]]
    out["key"] = [key_of(s, d) if above[s] else None for s, d in zip(there, line)]
    out["parent"] = [
        key_of(s, d - 1) if d and (above[s] or c) else None for s, d, c in zip(there, line, cut)
    ]
    out["ancestors"] = [
        [key_of(s, i) for i in range(d)] if above[s] else None for s, d in zip(there, line)
    ]
    return out


def _nodes(dealt: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        if rows:
            yield _shard_nodes(rows)

    schema = NODE + ", size long, key binary, parent binary, ancestors array<binary>"
    return map_batches(dealt.repartition(shards, "shard"), run, schema)


def _merged(partial: DataFrame, stage) -> DataFrame:
    """The nodes above the shards, with ``key``: sums of their parts and of what is below them."""
    parts = partial.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.first("ancestors").alias("ancestors"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
        F.max("size").alias("size"),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    parts = stage(parts, "above")
    up = parts.select(
        F.col("key").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    families = parts.where("parent is not null").groupBy(F.col("parent").alias("key"))
    parts = parts.join(families.agg(F.count("*").alias("more")), "key", "left")
    children = F.col("children") + F.coalesce("more", F.lit(0))
    parts = parts.withColumn("n_children", children).join(up, "parent", "left")
    below = parts.select(
        F.explode(F.array_append("ancestors", F.col("key"))).alias("key"),
        (F.col("leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    below = below.groupBy("key").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    return stage(parts.drop("leaves", "saved").join(below, "key"), "merged")


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """A row for each node of the trie of ``turns`` (as ``turn_ids`` gives them).

    ``conversations`` holds all ids in its first column, also of those without turns, which are members of
    the root alone. Columns: ``conv_id``, the smallest member; ``depth``; ``parent_conv_id`` (null for the
    root); ``n_convs`` members; ``n_children``; ``n_leaves``, childless nodes of the subtree;
    ``saved_tokens``, over the subtree the members but one times the size of the last turn;
    ``ends_sha256`` of the ids of the members that end here. Without conversations there is no node.
    """
    spark = turns.sparkSession
    stage = new_stage(spark)
    whole = stage(_whole(turns, conversations), "whole")
    sequences = whole.groupBy("end").agg(
        F.count("*").alias("n"),
        F.min("conv").alias("conv"),
        F.first("path").alias("path"),
        F.first("sizes").alias("sizes"),
    )
    sequences = stage(sequences.join(_end_hashes(whole), "end"), "sequences")
    count, length = sequences.agg(F.count("*"), F.coalesce(F.sum(F.size("sizes")), F.lit(0))).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-length // SHARD_TURNS))
    shards = min(shards, max(count, 1))
    heavy = _heavy(sequences, max(1, count // (2 * shards)))
    nodes = stage(_nodes(_dealt(sequences, heavy), shards), "nodes")
    above = _merged(nodes.where("key is not null"), stage)
    columns = [c.split()[0] for c in NODE.split(", ")]
    empty = F.lit(hashlib.sha256().hexdigest())
    up = above.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    cut = nodes.where("key is null and parent is not null").drop("parent_conv_id").join(up, "parent")
    found = (
        nodes.where("key is null and parent is null").select(*columns)
        .unionAll(cut.withColumnRenamed("above", "parent_conv_id").select(*columns))
        .unionAll(above.select(*columns))
    )
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", empty))
