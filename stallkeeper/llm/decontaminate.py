"""Benchmark decontamination: BM25 index of the test items, queried by every training passage.

Test items are cut into parts of at most ``PART`` words; a part is a document of the BM25 index,
the terms are weighted by their document frequency in the whole training corpus. The weights of a
part are divided by its threshold, ``LEAST_SHARE`` of what the part would score against itself, so
a passage hits a part where its sum reaches 1. Every text is cut into passages of ``CELLS`` cells of
``CELL`` words, one cell apart, so every part lies wholly in some passage. As in block-max WAND,
the index keeps the largest weight of each term in each block of parts; blocks whose bound for a
passage stays below the threshold are skipped, and in the others the passage is scored exactly
against every part. What is found is verified on the whole text: at least ``LEAST_OVERLAP`` of the
word n-grams of the question, and of the answer, must occur in it. The answer is the last line of
an item, or its last sentence if it has one line.

The items go to the tasks in groups of at most about ``GROUP_CHARS`` characters, one pass over the
texts per group, so what is broadcast has a fixed bound however large the benchmark is.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stallkeeper.llm.common import map_batches, new_stage, sent_along, values

CELL = 32
CELLS = 3
PART = CELL * (CELLS - 1)
BLOCKS = 24  # blocks of parts with a bound of their own
K1, B = 1.2, 0.75
LEAST_SHARE = 0.5
LEAST_OVERLAP = 0.5
GRAM = 5
GROUP_CHARS = 8_000_000
# Words of texts that are looked at together.
SLICE_WORDS = 200_000

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of both; an item of one line and one sentence is both."""
    lines = [x for x in text.split("\n") if words_of(x)]
    if len(lines) < 2:
        lines = [x for x in re.split(r"(?<=[.!?])\s+", text) if words_of(x)]
    if len(lines) < 2:
        return words_of(text), words_of(text)
    return words_of("\n".join(lines[:-1])), words_of(lines[-1])


def grams(words: list[str]) -> set[tuple[str, ...]]:
    """Word n-grams; fewer than ``GRAM`` words are one gram."""
    n = min(GRAM, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def overlap(wanted: list[str], there: dict[int, set]) -> float:
    """Share of the n-grams of some words among those of a text; ``there`` has these by length."""
    needed = grams(wanted)
    n = min(GRAM, len(wanted))
    return sum(g in there[n] for g in needed) / len(needed) if needed else 1.0


@dataclass
class Part:
    item: int  # number of the item
    words: list[str]


class ItemIndex:
    """Parts of items with normalised BM25 weights, and the bounds of their blocks."""

    def __init__(self, items: list[tuple[object, str]], frequency: dict[str, int], documents: int):
        self.ids = [i for i, _ in items]
        self.sides = [question_and_answer(t) for _, t in items]
        parts = []
        for number, (_, text) in enumerate(items):
            words = words_of(text)
            # Parts of about equal length, so none is too short to be told from chance.
            n = -(-len(words) // PART)
            cuts = [len(words) * i // n for i in range(n + 1)] if n else []
            parts += [Part(number, words[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.parts = parts
        self.number: dict[str, int] = {}
        for p in parts:
            for w in p.words:
                self.number.setdefault(w, len(self.number))
        idf = np.zeros(len(self.number))
        for w, t in self.number.items():
            n = frequency.get(w, 0)
            idf[t] = math.log(1 + (documents - n + 0.5) / (n + 0.5))
        mean = sum(len(p.words) for p in parts) / max(len(parts), 1)
        # Parts with like words share a block: the bounds are tighter.
        self.parts.sort(key=lambda p: (min((self.number[w] for w in p.words)), p.item))
        self.size = max(1, -(-len(parts) // BLOCKS))
        self.postings: list[list[tuple[int, float]]] = [[] for _ in self.number]
        self.full = np.zeros(len(parts))
        for e, p in enumerate(parts):
            counts: dict[int, int] = defaultdict(int)
            for w in p.words:
                counts[self.number[w]] += 1
            norm = K1 * (1 - B + B * len(p.words) / mean)
            weight = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in counts.items()}
            self.full[e] = sum(weight.values())
            threshold = LEAST_SHARE * self.full[e]
            for t, x in weight.items():
                self.postings[t].append((e, x / threshold))
        self.bounds = np.zeros((len(self.number) + 1, BLOCKS), np.float32)
        for t, found in enumerate(self.postings):
            for e, x in found:
                b = e // self.size
                self.bounds[t, b] = max(self.bounds[t, b], x)
        self.bounds *= np.float32(1.00001)  # stays a bound in single precision

    def hits(self, texts: list[list[str]]) -> Iterator[tuple[int, int, float, int]]:
        """``(text, part, score, first cell)`` of every passage of every text that hits a part."""
        lookup, none = self.number.get, len(self.number)
        cells_of = [-(-len(t) // CELL) for t in texts]
        first = np.concatenate(([0], np.cumsum(cells_of))).astype(np.int64)
        terms = np.full(first[-1] * CELL, none, np.int64)
        for words, a in zip(texts, first[:-1].tolist()):
            terms[a * CELL : a * CELL + len(words)] = [lookup(w, none) for w in words]
        total = int(first[-1])
        if not total or not self.parts:
            return
        owner = np.repeat(np.arange(len(texts)), cells_of)
        # Bounds of cells: what each word adds to each block at most, without repetitions.
        grid = np.sort(terms.reshape(total, CELL), axis=1)
        grid[:, 1:][grid[:, 1:] == grid[:, :-1]] = none
        cell, _ = np.nonzero(grid != none)
        flat = grid[grid != none]
        sums = np.zeros((total, BLOCKS), np.float32)
        if len(flat):
            starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            sums[cell[starts]] = np.add.reduceat(self.bounds[flat], starts, axis=0)
        bound = sums.copy()
        for k in range(1, CELLS):
            same = owner[k:] == owner[:-k]
            bound[:-k][same] += sums[k:][same]
        # Of passages that begin in successive cells all are queried.
        for c, b in zip(*(x.tolist() for x in np.nonzero(bound >= 1))):
            text = int(owner[c])
            end = min(c + CELLS, int(first[text + 1]))
            scores: dict[int, float] = defaultdict(float)
            low, high = b * self.size, (b + 1) * self.size
            for t in np.unique(terms[c * CELL : end * CELL]).tolist():
                if t != none:
                    for e, x in self.postings[t]:
                        if low <= e < high:
                            scores[e] += x
            for e, s in scores.items():
                if s >= 1 - 1e-9:
                    yield text, e, s * LEAST_SHARE * float(self.full[e]), c - int(first[text])

    def verified(self, words: list[str], items: set[int]) -> dict[int, tuple[float, float]]:
        """Overlaps of question and answer of the items that a text contains."""
        there = defaultdict(set)
        for n in {min(GRAM, len(s)) for i in items for s in self.sides[i]}:
            if n:
                there[n] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        out = {}
        for i in items:
            found = tuple(overlap(side, there) for side in self.sides[i])
            if min(found) >= LEAST_OVERLAP:
                out[i] = found
        return out


def _frequencies(docs: DataFrame, wanted: frozenset[str]) -> tuple[dict[str, int], int]:
    """In how many texts each of the wanted words occurs, over all texts, and their number."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        n, found = 0, dict.fromkeys(wanted, 0)
        for batch in batches:
            for t in values(batch, "text"):
                n += 1
                for w in wanted.intersection(words_of(t)):
                    found[w] += 1
        yield {"word": [None, *found], "n": [n, *found.values()]}

    counted = map_batches(docs, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in counted.collect()}
    return found, found.pop(None, 0) or 0


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per text and test item it contains: keys, ``passage`` (word at which the best
    passage begins), BM25 ``score``, ``question_overlap`` and ``answer_overlap``.

    Null texts and texts or items without a word contain nothing and are in nothing. Repeated
    texts are found each, repeated items too. Without items, or texts, there are no rows. Other
    columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(f"`{text}`").isNotNull())
    rows = rows.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"))
    tests = items.where(F.col(f"`{item_text}`").isNotNull()).select(
        F.col(f"`{item_key}`").alias("i"), F.col(f"`{item_text}`").alias("text")
    )
    kind, item_kind = (x.schema[0].dataType.simpleString() for x in (rows, tests))
    schema = (
        f"k {kind}, i {item_kind}, passage long, score double, "
        "question_overlap double, answer_overlap double"
    )
    size = tests.agg(F.coalesce(F.sum(F.length("text") + 16), F.lit(0))).first()[0]
    groups = -(-size // GROUP_CHARS)
    stage = new_stage(spark)
    results = []
    for group in range(groups):
        mine = F.pmod(F.xxhash64("i", "text"), F.lit(groups)) == group
        entries = [(r["i"], r["text"]) for r in tests.where(mine).collect() if words_of(r["text"])]
        entries.sort(key=lambda e: (str(e[0]), e[1]))
        wanted = frozenset(w for _, t in entries for w in words_of(t))
        frequency, documents = _frequencies(rows.select("text"), wanted)
        shared = sent_along(spark, ItemIndex(entries, frequency, documents))

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[dict]:
            index = shared()

            def judged(keys: list, texts: list[list[str]]) -> dict:
                best: dict[tuple[int, int], tuple[float, int]] = {}
                for t, e, s, c in index.hits(texts):
                    at = (t, index.parts[e].item)
                    if at not in best or (-s, c) < (-best[at][0], best[at][1]):
                        best[at] = (s, c)
                by_text = defaultdict(set)
                for t, i in best:
                    by_text[t].add(i)
                out = {n: [] for n in ("k", "i", "passage", "score", "question_overlap", "answer_overlap")}
                for t, found in by_text.items():
                    for i, (q, a) in index.verified(texts[t], found).items():
                        s, c = best[t, i]
                        for n, x in zip(out, (keys[t], index.ids[i], c * CELL, s, q, a)):
                            out[n].append(x)
                return out

            for batch in batches:
                keys, texts, n = [], [], 0
                for k, t in zip(values(batch, "k"), values(batch, "text")):
                    keys.append(k)
                    texts.append(words_of(t))
                    n += len(texts[-1])
                    if n >= SLICE_WORDS:
                        yield judged(keys, texts)
                        keys, texts, n = [], [], 0
                yield judged(keys, texts)

        results.append(map_batches(rows, run, schema))
    found = results[0] if results else spark.createDataFrame([], schema)
    for more in results[1:]:
        found = found.unionAll(more)
    if groups > 1:
        found = stage(found, "found")
    return found.withColumnsRenamed({"k": key, "i": item_key})
