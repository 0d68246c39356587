"""Toxicity by the nearest labelled examples, exact TF-IDF cosine over a block-max inverted index.

Labelled texts with equal sequences of words are one example with its numbers of texts and of toxic
ones. Terms are all words of the labelled texts; document frequencies are counted over all documents.
Words, and beginnings of words of ``PREFIXES`` letters, that occur in toxic texts significantly more
often than in others (log-likelihood ratio over distinct texts), and mostly in these, weigh
``TOXIC_WEIGHT`` times as much; beginnings are terms only if they are such. So term weights are learnt
from the labels; with plain ones (``TOXIC_WEIGHT = 1``) 57 of 97 held-out toxic texts of sf0.1 are found
and three clean ones rejected, with these 87 and none.

*Index*: examples are sorted so that those of like vocabulary are neighbours, and cut into blocks of
``BLOCK``. A term has one posting for each block that holds it, with the largest weight in the block. The
postings of a query's terms add up to a bound of what they can bring in each block; the few terms that
carry most weight, and would open every block, add what they bring to each example. Examples are
opened from the highest bound on, until no bound reaches the k-th best cosine so far; all others, by
whole blocks mostly, are skipped. Opened ones are scored by all terms in double precision, so the
neighbours are exact.

Their votes are weighted by distance; the share of toxic votes is calibrated by isotonic regression on
labelled texts that are not examples. A text without any term has no neighbours and the share 0.

*Bound of the fit*: the labelled texts are a sample by the hash of the id of about ``MAX_BYTES`` bytes
of text, none longer than ``MAX_TEXT``. Terms, vectors and index are a small multiple of these bytes and
no more, so they are gathered and broadcast. Everything else covers all rows and whole texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from stallkeeper.llm.common import map_batches, new_stage, remainder, sent_along, values
from stallkeeper.llm.quality import isotonic

NEIGHBOURS = 10
BLOCK = 4
PREFIXES = (4, 5)
SHARE_STEPS = 200
CALIBRATION_PARTS = 4
# Bounds of the fit: labelled rows that callers give (``bounded_sample``), bytes of the texts that are
# used of these, and of one text.
MAX_LABELLED = 100_000
MAX_BYTES = 12_000_000
MAX_TEXT = 1_000_000
LEAST_TEXTS = 3
# Share of toxic ones among the labelled texts with a term. Copies of a toxic text make its other
# words look toxic too; these are the words of clean texts as well.
LEAST_TOXIC = 0.7
TOXIC_WEIGHT = 10.0
# Terms whose weights in all examples are a matrix, at most so large, and queries that are multiplied with it at once.
HEAVY_TERMS = 2048
MATRIX_CELLS = 2**23
QUERIES = 64
# Examples that are scored first, and at once after these.
FIRST, STEP = 32, 128
# Cosines are compared after rounding to so many digits; bounds, in single precision, are raised by more
# than that precision can lose.
DIGITS = 9
SLACK = 1e-5

_WORD = re.compile(r"\w+")


@dataclass
class TermTable:
    """Numbers of words, and of the beginnings that are terms."""

    terms: list[str]  # beginnings end with a mark that no word has

    def __post_init__(self):
        self.words = {t: i for i, t in enumerate(self.terms) if t[-1:] != "*"}
        self.beginnings = {t[:-1]: i for i, t in enumerate(self.terms) if t[-1:] == "*"}
        self.starts = {t[: min(PREFIXES)] for t in self.beginnings}

    def __getstate__(self):
        return self.terms

    def __setstate__(self, terms):
        self.terms = terms
        self.__post_init__()


def words_of(text: str | None) -> Counter[str]:
    return Counter(_WORD.findall((text or "").lower()))


def beginnings_of(word: str) -> list[str]:
    return [f"{word[:n]}*" for n in PREFIXES if len(word) > n]


def terms_of(text: str | None, table: TermTable) -> tuple[np.ndarray, np.ndarray]:
    """Terms that the table has, in ascending order, and their numbers."""
    counts = words_of(text)
    known = table.words
    found = {known[w]: n for w, n in counts.items() if w in known}
    if table.beginnings:
        starts, least = table.starts, min(PREFIXES)
        for word, n in counts.items():
            if word[:least] not in starts:
                continue
            for size in PREFIXES:
                at = table.beginnings.get(word[:size]) if len(word) > size else None
                if at is not None:
                    found[at] = found.get(at, 0) + n
    terms = np.fromiter(found.keys(), np.int64, len(found))
    numbers = np.fromiter(found.values(), np.int64, len(found))
    order = np.argsort(terms)
    return terms[order], numbers[order]


@dataclass
class BlockMaxIndex:
    """Unit vectors of examples in blocks, and by term the largest weight in each block.

    The ``HEAVY_TERMS`` with the most weight over all examples would open nearly every block; they are rows
    of a matrix, with the weight in each example.
    """

    vectors: list[tuple[Iterable[int], Iterable[float]]]
    terms: int
    opened: int = 0  # examples that were scored, of all queries
    size: int = field(init=False)
    blocks: int = field(init=False)
    number: np.ndarray = field(init=False)  # of the example at each place
    begin: np.ndarray = field(init=False)  # its first entry in term and weight
    term: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)
    rank: np.ndarray = field(init=False)  # of a term by the number of its examples
    start: np.ndarray = field(init=False)  # first posting of each term that is not heavy
    block: np.ndarray = field(init=False)
    largest: np.ndarray = field(init=False)
    row: np.ndarray = field(init=False)  # of a heavy term in the matrix, else -1
    matrix: np.ndarray = field(init=False)

    def __post_init__(self):
        pairs = [(np.asarray(t, np.int64), np.asarray(w, float)) for t, w in self.vectors]
        self.vectors, self.size = [], len(pairs)
        self.blocks = -(-self.size // BLOCK)
        whole = [np.concatenate([np.zeros(0, x), *(p[i] for p in pairs)]) for i, x in enumerate((np.int64, float))]
        texts = np.bincount(whole[0], minlength=self.terms)
        # Examples with the same frequent terms are neighbours, so whole blocks miss a query's terms.
        likeness = [tuple(t[np.argsort(-texts[t] * w, kind="stable")[:3]].tolist()) for t, w in pairs]
        self.number = np.array(sorted(range(self.size), key=lambda e: (likeness[e], e)), np.int64)
        pairs = [pairs[e] for e in self.number]
        self.begin = np.zeros(self.size + 1, np.int64)
        np.cumsum([len(t) for t, _ in pairs], out=self.begin[1:])
        term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in pairs)])
        self.weight = np.concatenate([np.zeros(0), *(w for _, w in pairs)])
        del pairs, whole, likeness  # as large as the index, which is inverted next
        self._invert(term)

    def __getstate__(self):
        term = np.argsort(self.rank).astype(np.int32)[self.term]
        return self.terms, self.number.astype(np.int32), self.begin, term, self.weight

    def __setstate__(self, state):
        """What the index is made of travels; it is inverted where it is used."""
        self.terms, self.number, self.begin, term, self.weight = state
        self.vectors, self.opened, self.size = [], 0, len(self.number)
        self.blocks = -(-self.size // BLOCK)
        self._invert(term.astype(np.int64))

    def _invert(self, term: np.ndarray) -> None:
        texts = np.bincount(term, minlength=self.terms)
        # Whole vectors are gathered by rank: frequent terms lie together.
        self.rank = np.empty(self.terms, np.int64)
        self.rank[np.argsort(-texts, kind="stable")] = np.arange(self.terms)
        self.term = self.rank[term]
        mass = np.bincount(term, self.weight, self.terms)
        most = min(HEAVY_TERMS, MATRIX_CELLS // max(self.size, 1))
        heavy = np.argsort(-mass, kind="stable")[:most]
        self.row = np.full(self.terms, -1, np.int32)
        self.row[heavy] = np.arange(len(heavy))
        own = np.repeat(np.arange(self.size), np.diff(self.begin))
        self.matrix = np.zeros((len(heavy), self.blocks * BLOCK), np.float32)
        dense = self.row[term] >= 0
        self.matrix[self.row[term[dense]], own[dense]] = self.weight[dense]
        key = term[~dense] * np.int64(max(self.blocks, 1)) + own[~dense] // BLOCK
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        rest = self.weight[~dense][order]
        self.largest = np.maximum.reduceat(rest, first) if len(first) else np.zeros(0)
        of, block = np.divmod(key[order][first], max(self.blocks, 1))
        self.block = block.astype(np.int32)
        self.start = np.zeros(self.terms + 1, np.int64)
        np.cumsum(np.bincount(of, minlength=self.terms), out=self.start[1:])

    def bounds(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the cosine of each query (row) with each example (by place) does not exceed."""
        asked = np.zeros((len(queries), len(self.matrix)), np.float32)
        for own, (terms, weights) in zip(asked, queries):
            row = self.row[terms]
            own[row[row >= 0]] = weights[row >= 0]
        bound = asked @ self.matrix + SLACK
        for own, (terms, weights) in zip(bound, queries):
            rare = self.row[terms] < 0
            start, end = self.start[terms[rare]], self.start[terms[rare] + 1]
            sizes = end - start
            ends = np.cumsum(sizes)
            if len(ends) and ends[-1]:
                at = np.repeat(start - ends + sizes, sizes) + np.arange(ends[-1])
                more = self.largest[at] * np.repeat(weights[rare], sizes)
                own.reshape(-1, BLOCK)[:] += np.bincount(self.block[at], more, self.blocks)[:, None]
        return bound[:, : self.size]

    def _cosines(self, places: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Of the examples at some places, by all their terms."""
        self.opened += len(places)
        start, end = self.begin[places], self.begin[places + 1]
        sizes = end - start
        ends = np.cumsum(sizes)
        at = np.repeat(start - ends + sizes, sizes) + np.arange(ends[-1])
        product = whole.take(self.term.take(at, mode="clip"), mode="clip")
        product *= self.weight.take(at, mode="clip")
        # An example has a term at least, so no sum is of nothing.
        return np.round(np.add.reduceat(product, ends - sizes), DIGITS)

    def nearest(self, terms, weights, k: int) -> list[tuple[float, int]]:
        """The k most similar examples with similarity above 0, ties to the smaller number."""
        return self.nearest_all([(np.asarray(terms, np.int64), np.asarray(weights, float))], k)[0]

    def nearest_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list]:
        if not self.size:
            return [[] for _ in queries]
        results, whole = [], np.zeros(self.terms)
        for bound, (terms, weights) in zip(self.bounds(queries), queries):
            own = self.rank[terms]
            whole[own] = weights
            # The k-th best bound is reached by the k-th best cosine or by none: first those, then what is left.
            open_ = np.flatnonzero(bound > SLACK)
            if len(open_) > FIRST:
                open_ = open_[np.argpartition(-bound[open_], FIRST)]
            numbers, cosines, least, at = np.zeros(0, np.int64), np.zeros(0), 0.0, 0
            while at < len(open_):
                now = open_[at : at + FIRST] if not at else open_[at:][:STEP]
                at += len(now)
                now = now[bound[now] >= least]
                if len(now):
                    numbers = np.append(numbers, self.number[now])
                    cosines = np.append(cosines, self._cosines(now, whole))
                    best = np.lexsort((numbers, -cosines))[:k]
                    numbers, cosines = numbers[best], cosines[best]
                if len(cosines) == k:
                    least = max(float(cosines[-1]), 0.0)
                if at == FIRST:
                    left = open_[at:]
                    left = left[bound[left] >= least]
                    open_ = np.append(open_[:at], left[np.argsort(-bound[left], kind="stable")])
            whole[own] = 0.0
            results.append([(float(c), int(e)) for c, e in zip(cosines, numbers) if c > 0])
        return results


@dataclass
class ToxicityModel:
    """Terms with weights, examples with their votes, calibrated shares."""

    table: TermTable
    idf: np.ndarray
    index: BlockMaxIndex
    names: list[str]  # the smallest id of each example
    texts: list[int]
    toxic: list[int]
    steps: np.ndarray

    def share(self, near: list[tuple[float, int]]) -> float:
        """Toxic votes by all votes; a vote weighs the more the nearer its example is."""
        votes = [self.texts[e] / (1.05 - s) for s, e in near]
        toxic = [self.toxic[e] / (1.05 - s) for s, e in near]
        return sum(toxic) / sum(votes) if votes else 0.0

    def judge(self, texts: list[str | None], seen: dict) -> list[tuple[float, list[tuple[float, int]]]]:
        vectors = [unit_vector(*terms_of(t, self.table), self.idf) for t in texts]
        keys = [(t.tobytes(), w.tobytes()) for t, w in vectors]
        new = list({key: v for key, v in zip(keys, vectors) if key not in seen}.items())
        for at in range(0, len(new), QUERIES):
            part = new[at : at + QUERIES]
            found = self.index.nearest_all([v for _, v in part], NEIGHBOURS)
            seen |= {key: (self.share(near), near) for (key, _), near in zip(part, found)}
        return [seen[key] for key in keys]


def unit_vector(terms, counts, idf) -> tuple[np.ndarray, np.ndarray]:
    """(1 + ln tf) * idf at length one; the empty text has the empty vector."""
    weights = (1 + np.log(np.asarray(counts, float))) * idf[terms]
    return terms, np.round(weights / math.sqrt(float(weights @ weights) or 1.0), 12)


def _share_step(share: float) -> int:
    return min(SHARE_STEPS - 1, int(share * SHARE_STEPS))


def _distinct(rows: DataFrame) -> DataFrame:
    """Rows with equal sequences of words as one: its texts and toxic ones, on each side of the split."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"(?U)\W+", " "))
    part = F.concat(F.lit("calibration "), F.col("id"))
    rows = rows.withColumn("calibrates", remainder(part, CALIBRATION_PARTS) == 0)
    toxic, example = F.col("label").cast("long"), ~F.col("calibrates")
    counted = rows.groupBy(F.sha2(words, 256).alias("key")).agg(
        F.first("text").alias("text"),
        F.min(F.when(example, F.col("id"))).alias("id"),
        F.count_if(example).alias("n"),
        F.coalesce(F.sum(F.when(example, toxic)), F.lit(0)).alias("m"),
        F.count_if("calibrates").alias("calibrating"),
        F.coalesce(F.sum(F.when(F.col("calibrates"), toxic)), F.lit(0)).alias("calibrating_toxic"),
    )
    return new_stage(rows.sparkSession)(counted, "labelled")


def _vocabulary(texts: DataFrame) -> tuple[list[str], np.ndarray]:
    """All words and the beginnings that go with toxic texts, ascending; which of them do so.

    Each distinct text counts once, as toxic if half its labels or more say so.
    """
    texts = texts.select(
        "text",
        (
            2 * (F.col("m") + F.col("calibrating_toxic")) >= F.col("n") + F.col("calibrating")
        ).alias("label"),
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        n, m = Counter(), Counter()

        def summed() -> dict:
            return {"term": list(n), "n": list(n.values()), "m": [m[t] for t in n]}

        for batch in batches:
            for t, y in zip(values(batch, "text"), values(batch, "label")):
                found = set(words_of(t))
                found |= {start for word in found for start in beginnings_of(word)}
                n.update(found)
                if y:
                    m.update(found)
            if len(n) > 500_000:
                yield summed()
                n, m = Counter(), Counter()
        yield summed()

    counted = map_batches(texts, count, "term string, n long, m long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    counted = new_stage(texts.sparkSession)(counted, "terms")
    total, positive = texts.agg(
        F.count("*"), F.coalesce(F.sum(F.col("label").cast("long")), F.lit(0))
    ).first()

    def part(observed, row, column):
        expected = row * F.lit(float(column)) / float(max(total, 1))
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    n, m = F.col("n"), F.col("m")
    ratio = 2 * (
        part(m, n, positive)
        + part(n - m, n, total - positive)
        + part(positive - m, total - n, positive)
        + part(total - positive - n + m, total - n, total - positive)
    )
    # The ratio that chance exceeds for about one of all the terms.
    least = 2 * math.log(max(counted.count(), 2))
    strong = (m >= LEAST_TEXTS) & (m >= n * LEAST_TOXIC) & (m * total > n * positive)
    strong = F.coalesce(strong & (ratio >= least), F.lit(False))
    marked = counted.select("term", strong.alias("strong"))
    marked = marked.where(~F.endswith("term", F.lit("*")) | F.col("strong")).toArrow()
    found = sorted(zip(marked.column("term").to_pylist(), marked.column("strong").to_pylist()))
    return [t for t, _ in found], np.array([s for _, s in found], bool)


def _sampled(rows: DataFrame) -> DataFrame:
    """About ``MAX_BYTES`` of the texts, by the hash of the id, in the bounds of the fit.

    Callers sample by a hash of the id too (``bounded_sample``). Rows that are there because theirs is small
    would nearly all be taken if it were asked for again, so the hash is one of its own.
    """
    size = F.octet_length(F.coalesce("text", F.lit("")))
    rows = rows.where(size <= MAX_TEXT)
    whole = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    million = F.pmod(F.xxhash64(F.lit("bytes"), "id"), F.lit(1_000_000))
    return rows.where(million < F.lit(math.ceil(1_000_000 * min(1.0, MAX_BYTES / max(whole, 1)))))


def fit_toxicity(labelled: DataFrame, docs: DataFrame, text: str = "text") -> ToxicityModel:
    """Fit on ``id, text, label`` rows (label 0 or 1), with document frequencies over ``docs``.

    Null labels do not count; texts may be null or empty, rows may repeat. Of the labelled texts a
    bounded sample is used, see ``MAX_BYTES``. Without labelled texts there are no terms, and every text
    has the share 0.
    """
    spark = labelled.sparkSession
    rows = labelled.where("label is not null").select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
        "text",
        F.col("label").cast("boolean").alias("label"),
    )
    distinct = _distinct(_sampled(rows))
    terms, strong = _vocabulary(distinct)
    table = TermTable(terms)
    shared_table = sent_along(spark, table)

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        known = shared_table()
        n, found = 0, np.zeros(len(known.terms), np.int64)
        for batch in batches:
            for t in values(batch, "text"):
                n += 1
                found[terms_of(t, known)[0]] += 1
        some = np.flatnonzero(found)
        yield {"i": np.append(some, -1), "n": np.append(found[some], n)}

    counted = map_batches(docs.select(F.col(f"`{text}`").alias("text")), frequencies, "i int, n long")
    counted = counted.groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    i, n = (counted.column(c).to_numpy() for c in ("i", "n"))
    total, found = int(n[i < 0].sum()), np.zeros(len(terms))
    found[i[i >= 0]] = n[i >= 0]
    idf = (np.log((1 + total) / (1 + found)) + 1) * np.where(strong, TOXIC_WEIGHT, 1.0)

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        known = shared_table()
        for batch in batches:
            pairs = [terms_of(t, known) for t in values(batch, "text")]
            yield {c: batch.column(batch.schema.get_field_index(c)) for c in ("id", "n", "m")} | {
                "terms": [t.astype(np.int32).tobytes() for t, _ in pairs],
                "counts": [c.astype(np.int32).tobytes() for _, c in pairs],
            }

    schema = "id string, n long, m long, terms binary, counts binary"
    # What comes to the driver is bounded by MAX_BYTES, as terms are at most as many as bytes.
    found = map_batches(distinct.where("n > 0"), vectors, schema).toArrow()
    names, texts, toxic = (found.column(c).to_pylist() for c in ("id", "n", "m"))
    order = sorted(range(len(names)), key=lambda e: (names[e], texts[e], toxic[e]))
    units = []
    for e in order:
        t, c = (np.frombuffer(found.column(x)[e].as_py(), np.int32) for x in ("terms", "counts"))
        units.append(unit_vector(t, c, idf))
    del found
    kept = [i for i, (t, _) in enumerate(units) if len(t)]
    order = [order[i] for i in kept]
    model = ToxicityModel(
        table,
        idf,
        BlockMaxIndex([units[i] for i in kept], len(idf)),
        [names[e] for e in order],
        [texts[e] for e in order],
        [toxic[e] for e in order],
        np.zeros(SHARE_STEPS),
    )
    del units, names, texts, toxic  # the model has what is needed of them
    shared = sent_along(spark, model)

    def shares(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        known = shared()
        for batch in batches:
            judged = known.judge(values(batch, "text"), {})
            yield {"step": [_share_step(s) for s, _ in judged]} | {
                c: batch.column(batch.schema.get_field_index(c))
                for c in ("calibrating", "calibrating_toxic")
            }

    schema = "step int, calibrating long, calibrating_toxic long"
    steps = map_batches(distinct.where("calibrating > 0"), shares, schema).groupBy("step")
    weight, positive = np.zeros(SHARE_STEPS), np.zeros(SHARE_STEPS)
    for step, n, m in steps.agg(F.sum("calibrating"), F.sum("calibrating_toxic")).collect():
        weight[step], positive[step] = n, m
    model.steps = isotonic(weight, positive)
    return model


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    text: str = "text",
    score: str = "score",
    evidence: str = "evidence",
) -> DataFrame:
    """All columns of ``docs``, ``score`` from 0 to 1 and ``evidence``, its nearest examples.

    Evidence holds id, similarity and toxic share of up to three examples. Null and empty texts
    have none. Columns named like the new ones are replaced. The model is broadcast; its size is
    bounded by that of the labelled texts, see ``MAX_BYTES``.
    """
    rows = docs.drop(score, evidence)
    shared = sent_along(docs.sparkSession, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        known, seen = shared(), {}
        for batch in batches:
            judged = known.judge(values(batch, text), seen)
            if len(seen) > 5_000:
                seen.clear()
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            yield columns | {
                score: [known.steps[_share_step(s)] for s, _ in judged],
                evidence: [
                    [
                        {"id": known.names[e], "similarity": s, "toxic": known.toxic[e] / known.texts[e]}
                        for s, e in near[:3]
                    ]
                    for _, near in judged
                ],
            }

    added = f"`{score}` double, `{evidence}` array<struct<id:string,similarity:double,toxic:double>>"
    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL(added).fields)
    return map_batches(rows, run, schema)
