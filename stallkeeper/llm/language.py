"""Language of texts by a bidirectional gated recurrent network over bytes.

The letters of a text form runs (words); the bytes of a run, in lower case and with a boundary byte
on each side, are a sequence. Two gated recurrent layers read it, one from either end, and a
softmax over both states labels every byte. The log probabilities of all bytes of a document are
added up and, counted per word rather than per byte, pooled to its probabilities. A run is labelled
by its own bytes only, so a run that occurs again is looked up instead of being read again; runs of
more than ``LONGEST`` letters are read in parts of that length.

The network is trained with numpy by backpropagation through time on a bounded sample: about
``DOCS_PER_LANGUAGE`` documents per language, taken by the hash of their id, and of their words the
``WORDS_PER_LANGUAGE`` most frequent of each language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from stallkeeper.llm.common import map_batches, new_stage, values

HIDDEN = 16
LONGEST = 32
BOUNDARY = 32
STEPS = 1200
BATCH = 256
RATE = 0.01
SEED = 7
DOCS_PER_LANGUAGE = 1500
WORDS_PER_LANGUAGE = 8000
BYTES_PER_VOTE = 6.0
REMEMBERED = 300_000
UNDETERMINED = "und"

_RUNS = re.compile(r"[^\W\d_]+")


def letter_runs(text: str | None) -> list[str]:
    """Runs of letters in lower case, cut to at most ``LONGEST`` letters."""
    runs = _RUNS.findall((text or "").lower())
    out = []
    for r in runs:
        if not r.isalpha():
            r = "".join(filter(str.isalpha, r))
        if len(r) <= LONGEST:
            if r:
                out.append(r)
        else:
            out += [r[i : i + LONGEST] for i in range(0, len(r), LONGEST)]
    return out


def padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with boundaries, by position and word, and the mask of the words' own bytes."""
    coded = [w.encode() for w in words]
    length = max(map(len, coded)) + 2
    symbols = np.full((length, len(words)), BOUNDARY, np.int64)
    mask = np.zeros((length, len(words)), np.float32)
    for i, c in enumerate(coded):
        symbols[1 : len(c) + 1, i] = np.frombuffer(c, np.uint8)
        mask[1 : len(c) + 1, i] = 1
    return symbols, mask


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class ByteNetwork:
    """Parameters by name: for each direction the table of inputs, recurrent weights and bias;
    the output layer. Gates are ordered update, reset, candidate."""

    def __init__(self, languages: list[str]):
        draw = np.random.default_rng(SEED)
        self.languages = languages
        h, n = HIDDEN, len(languages)
        self.p = {}
        for d in "fb":
            self.p[f"{d}_in"] = (draw.normal(size=(256, 3 * h)) * 0.3).astype(np.float32)
            self.p[f"{d}_rec"] = (draw.normal(size=(h, 3 * h)) / np.sqrt(h)).astype(np.float32)
            self.p[f"{d}_bias"] = np.zeros(3 * h, np.float32)
        self.p["out"] = (draw.normal(size=(2 * h, n)) / np.sqrt(2 * h)).astype(np.float32)
        self.p["out_bias"] = np.zeros(n, np.float32)

    def _read(self, symbols: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States after every position, in the order in which the direction reads."""
        h = HIDDEN
        inputs, recurrent = self.p[f"{d}_in"] + self.p[f"{d}_bias"], self.p[f"{d}_rec"]
        state = np.zeros((symbols.shape[1], h), np.float32)
        states = np.empty((*symbols.shape, h), np.float32)
        for t, column in enumerate(symbols):
            x = inputs[column]
            gates = _sigmoid(x[:, : 2 * h] + state @ recurrent[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            inner = state @ recurrent[:, 2 * h :]
            candidate = np.tanh(x[:, 2 * h :] + reset * inner)
            if keep is not None:
                keep.append((column, state, update, reset, inner, candidate))
            state = candidate + update * (state - candidate)
            states[t] = state
        return states

    def log_probabilities(self, symbols: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Of every language at every position of every word."""
        tapes = {"f": None, "b": None} if keep is None else keep
        forward = self._read(symbols, "f", tapes["f"])
        backward = self._read(symbols[::-1], "b", tapes["b"])[::-1]
        both = np.concatenate((forward, backward), axis=2)
        if keep is not None:
            keep["both"] = both
        z = both @ self.p["out"] + self.p["out_bias"]
        z -= z.max(2, keepdims=True)
        return z - np.log(np.exp(z).sum(2, keepdims=True))

    def gradients(self, symbols: np.ndarray, mask: np.ndarray, labels: np.ndarray):
        """Mean loss over all labelled positions and its gradient, through time."""
        keep: dict = {"f": [], "b": []}
        log_p = self.log_probabilities(symbols, keep)
        n, h = mask.sum(), HIDDEN
        loss = -(log_p[:, np.arange(len(labels)), labels] * mask).sum() / n
        dz = np.exp(log_p)
        dz[:, np.arange(len(labels)), labels] -= 1
        dz *= mask[:, :, None] / n
        g = {name: np.zeros_like(value) for name, value in self.p.items()}
        g["out"] = np.einsum("twh,twl->hl", keep["both"], dz)
        g["out_bias"] = dz.sum((0, 1))
        dboth = dz @ self.p["out"].T
        for d, part in (("f", dboth[:, :, :h]), ("b", dboth[::-1, :, h:])):
            recurrent = self.p[f"{d}_rec"]
            carried = np.zeros((symbols.shape[1], h), np.float32)
            for t in range(len(symbols) - 1, -1, -1):
                column, state, update, reset, inner, candidate = keep[d][t]
                ds = part[t] + carried
                dcandidate = ds * (1 - update) * (1 - candidate * candidate)
                dupdate = ds * (state - candidate) * update * (1 - update)
                dreset = dcandidate * inner * reset * (1 - reset)
                dinner = dcandidate * reset
                dgates = np.concatenate((dupdate, dreset), axis=1)
                dx = np.concatenate((dgates, dcandidate), axis=1)
                np.add.at(g[f"{d}_in"], column, dx)
                g[f"{d}_bias"] += dx.sum(0)
                drec = np.concatenate((dgates, dinner), axis=1)
                g[f"{d}_rec"] += state.T @ drec
                carried = ds * update + drec @ recurrent.T
        return loss, g

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probabilities of each language, added up over the bytes of each word."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i].encode()))
        for a in range(0, len(order), 4096):
            some = order[a : a + 4096]
            symbols, mask = padded([words[i] for i in some])
            for length in np.unique(mask.sum(0)).astype(int):
                same = np.flatnonzero(mask.sum(0) == length)
                log_p = self.log_probabilities(symbols[: length + 2, same])
                out[np.array(some)[same]] = log_p[1 : length + 1].sum(0)
        return out


def train(words: list[tuple[str, str, int]], steps: int = STEPS) -> ByteNetwork:
    """Fit to (word, language, occurrences), drawing words by the root of their occurrences."""
    network = ByteNetwork(sorted({language for _, language, _ in words}))
    if len(network.languages) < 2:
        return network
    number = {language: i for i, language in enumerate(network.languages)}
    labels = np.array([number[language] for _, language, _ in words])
    weight = np.sqrt([n for _, _, n in words])
    for i in range(len(number)):  # all languages weigh the same
        weight[labels == i] /= weight[labels == i].sum()
    weight /= weight.sum()
    length = np.array([len(w.encode()) for w, _, _ in words])
    of_length = [np.flatnonzero(length == n) for n in np.unique(length)]
    share = np.array([weight[same].sum() for same in of_length])
    draw = np.random.default_rng(SEED)
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    for step in range(1, steps + 1):
        # Words of one length at a time, so that the reader from the end never meets padding.
        same = of_length[draw.choice(len(of_length), p=share)]
        some = draw.choice(same, BATCH, p=weight[same] / weight[same].sum())
        symbols, mask = padded([words[i][0] for i in some])
        _, g = network.gradients(symbols, mask, labels[some])
        size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, x in g.items():
            x = x * min(1.0, 1.0 / (size + 1e-9))
            first[k] += 0.1 * (x - first[k])
            second[k] += 0.01 * (x * x - second[k])
            m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
            network.p[k] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return network


def fit_language(labelled: DataFrame, steps: int = STEPS) -> ByteNetwork | None:
    """Train on ``id, text, lang`` rows; rows with a null text or language do not count.

    None if no row is left or no text has a letter. Rows may repeat.
    """
    rows = labelled.where("text is not null and lang is not null")
    # The languages are a closed list: their counts are as many rows as there are languages.
    counts = dict(rows.groupBy("lang").count().collect())
    taken = F.lit(False)
    million = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1_000_000))
    for language, n in counts.items():
        below = -(-1_000_000 * DOCS_PER_LANGUAGE // n)
        taken = taken | ((F.col("lang") == language) & (million < below))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found = Counter()
            for t, language in zip(values(batch, "text"), values(batch, "lang")):
                found.update((w, language) for w in letter_runs(t))
            yield {
                "word": [w for w, _ in found],
                "lang": [x for _, x in found],
                "n": list(found.values()),
            }

    words = map_batches(rows.where(taken).select("text", "lang"), count, "word string, lang string, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    words = words.withColumn("rank", F.row_number().over(most))
    found = words.where(F.col("rank") <= WORDS_PER_LANGUAGE).collect()
    found = sorted((r["word"], r["lang"], r["n"]) for r in found)
    return train(found, steps) if found else None


def predict_language(docs: DataFrame, network: ByteNetwork | None, text: str = "text") -> DataFrame:
    """All columns of ``docs``, ``lang_pred`` and ``score``, the probability of that language.

    A null text, and one without a letter, is ``und`` with score 0, as is every text without a
    network. Columns named like the new ones are replaced. The network has a fixed size and
    travels with the job.
    """
    rows = docs.drop("lang_pred", "score")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        number: dict[str, int] = {}
        scores = np.zeros((0, len(network.languages) if network else 0), np.float32)
        for batch in batches:
            runs = [letter_runs(t) if network else [] for t in values(batch, text)]
            wanted = {w for r in runs for w in r}
            new = [w for w in wanted if w not in number]
            if len(number) + len(new) > REMEMBERED:
                number, new = {}, list(wanted)
                scores = scores[:0]
            if new:
                number.update(zip(new, range(len(number), len(number) + len(new))))
                scores = np.concatenate((scores, network.word_scores(new)))
            found = []
            for r in runs:
                if not r:
                    found.append((UNDETERMINED, 0.0))
                    continue
                at = np.fromiter(map(number.__getitem__, r), np.int64, len(r))
                z = scores[at].sum(0, dtype=np.float64) / BYTES_PER_VOTE
                p = np.exp(z - z.max())
                best = int(p.argmax())
                found.append((network.languages[best], float(p[best] / p.sum())))
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            yield columns | {"lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL("lang_pred string, score double").fields)
    return map_batches(rows, run, schema)
