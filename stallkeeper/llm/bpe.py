"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a block of documents are laid out as one array of symbols, linked to their
neighbours. The index maps each pair that has a merge rank to all its positions in the block. The
active ranks are applied in ascending order, each to all its positions at once; a merge changes the
pairs on its two sides, whose new positions join the lists of their ranks. A rank that becomes
active later and is lower than the current one simply comes next, so every word sees its merges in
the order it would see alone. A position that an earlier merge has changed no longer holds the
pair, which is tested when its list comes up.

Texts are cut at white space first, which the vocabulary's pre-tokenizer drops and across which its
normalizer does nothing, so the ids of a text are those of its pieces, one after another; distinct
pieces are encoded once per block and remembered up to ``REMEMBERED`` pieces.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from stallkeeper.llm.common import map_batches, values

# Characters of text whose new words are encoded together, and pieces kept between blocks.
BLOCK_CHARS = 4_000_000
REMEMBERED = 300_000

# White space for the vocabulary's pattern: that of Python without four separators.
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_ONLY_MADE_FOR = (
    "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
    ["NFC", "Replace", "Lowercase"],
)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else from 256 upwards."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


def _names(spec: str) -> list[str | None]:
    """Tokens by their ids, null where there is none."""
    given = json.loads(spec)
    found = [*given["model"]["vocab"].items(), *((t["content"], t["id"]) for t in given["added_tokens"])]
    names: list[str | None] = [None] * (max(i for _, i in found) + 1)
    for name, i in found:
        names[i] = name
    return names


class PairIndexEncoder:
    """The merges of a tokenizer file (JSON text) for words with an end mark."""

    def __init__(self, spec: str):
        given = json.loads(spec)
        steps = given["normalizer"]["normalizers"]
        pattern = given["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if (pattern, [s["type"] for s in steps]) != _ONLY_MADE_FOR:
            raise ValueError("the file has another normalizer or pre-tokenizer than this encoder")
        vocabulary, end = given["model"]["vocab"], given["model"]["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in given["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        keys = self.left * self.size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        letters = _byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.last = np.array([vocabulary[c + end] for c in letters], np.int64)
        self._split_special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, -1 where it has none."""
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the number of ids of each word."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        starts = np.concatenate(([0], ends[:-1]))
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        after = np.arange(1, len(symbol) + 1)
        after[ends - 1] = -1
        before = np.arange(-1, len(symbol) - 1)
        before[starts] = -1
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Enter pairs that begin at these positions into the lists of their ranks."""
            rank = self._ranks(symbol[at], symbol[after[at]])
            known = rank >= 0
            at, rank = at[known], rank[known]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            firsts = rank[np.concatenate(([0], cuts))].tolist()
            for r, found in zip(firsts, np.split(at, cuts) if len(cuts) else [at]):
                if r in places:
                    places[r].append(found)
                else:
                    places[r] = [found]
                    heapq.heappush(active, r)

        note(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            lists = places.pop(r)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            a, b = self.left[r], self.right[r]
            follower = after[at]
            there = (symbol[at] == a) & (follower >= 0) & (symbol[follower] == b)
            at, follower = at[there], follower[there]
            if a == b and len(at) > 1:  # of overlapping pairs the first is merged
                keep, taken = [], -1
                for i, (p, f) in enumerate(zip(at.tolist(), follower.tolist())):
                    if p != taken:
                        keep.append(i)
                        taken = f
                at, follower = at[keep], follower[keep]
            if not len(at):
                continue
            beyond = after[follower]
            symbol[at] = self.made[r]
            symbol[follower] = -1
            after[at] = beyond
            more = beyond >= 0
            before[beyond[more]] = at[more]
            earlier = before[at]
            note(np.unique(np.concatenate((earlier[earlier >= 0], at[more]))))
        alive = symbol >= 0
        return symbol[alive], np.add.reduceat(alive, starts)

    def words(self, piece: str) -> list[bytes | int]:
        """A piece without white space as words to encode and ids of special tokens."""
        if self.special and "<" in piece:
            out: list[bytes | int] = []
            for part in self._split_special.split(piece):
                if part in self.special:
                    out.append(self.special[part])
                elif part:
                    out += self._plain_words(part)
            return out
        return self._plain_words(piece)

    @staticmethod
    def _plain_words(piece: str) -> list[bytes | int]:
        if not piece.isascii():
            piece = unicodedata.normalize("NFC", piece)
            # Lower case goes letter by letter, without the form of a final sigma.
            piece = "".join(map(str.lower, piece)) if "Σ" in piece else piece.lower()
        else:
            piece = piece.lower()
        if piece.isalpha():
            return [piece.encode()]
        return [w.encode() for w in _WORDS.findall(piece)]


def pieces(text: str) -> list[str]:
    """The parts of a text between white space."""
    if _SEPARATORS.search(text):
        return [p for p in _SPACE.split(text) if p]
    return text.split()


class _Remembered:
    """Ids and decoded text of pieces, encoded block by block."""

    def __init__(self, encoder: PairIndexEncoder):
        self.encoder = encoder
        self.known: dict[str, bytes] = {}

    def learn(self, wanted: set[str]) -> None:
        """Encode what is new of the pieces of a block; old pieces go when there are too many."""
        if len(self.known) + len(wanted) > REMEMBERED:
            self.known = {p: x for p, x in self.known.items() if p in wanted}
        new = [p for p in wanted if p not in self.known]
        number: dict[bytes, int] = {}
        parts = []
        for p in new:
            words = self.encoder.words(p)
            for w in words:
                if type(w) is bytes and w not in number:
                    number[w] = len(number)
            parts.append(words)
        flat, counts = self.encoder.encode_words(list(number))
        flat = flat.astype("<i4")
        raw, ends = flat.tobytes(), np.cumsum(counts).tolist()
        starts = [0, *ends[:-1]]
        for p, words in zip(new, parts):
            ids = []
            for w in words:
                if type(w) is bytes:
                    ids.append(raw[4 * starts[number[w]] : 4 * ends[number[w]]])
                else:
                    ids.append(w.to_bytes(4, "little"))
            self.known[p] = ids[0] if len(ids) == 1 else b"".join(ids)


def bpe_encode(docs: DataFrame, spec: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of int) of every whole text, one row per row.

    ``spec`` is the content of a tokenizer file; it has a fixed size and travels with the job.
    Strings of special tokens become their ids. A null or empty text, or one of white space only,
    has no ids. Repeated rows give repeated rows; other columns are not read. A key of the name ``ids`` is
    not allowed, as it would be two columns.
    """
    if key == "ids":
        raise ValueError("the key may not be called ids")
    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(f"`{key}`", f"`{text}`")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        memory = _Remembered(PairIndexEncoder(spec))

        def finished(block: list[tuple[pa.Array, list[list[str]]]]) -> Iterator[dict]:
            wanted: set[str] = set()
            for _, cut in block:
                for x in cut:
                    wanted.update(x)
            memory.learn(wanted)
            known = memory.known
            for keys, cut in block:
                ids, ends = [], [0]
                for x in cut:
                    joined = b"".join([known[p] for p in x])
                    ids.append(joined)
                    ends.append(ends[-1] + len(joined) // 4)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                arrays = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                arrays = arrays.cast(pa.list_(pa.field("element", pa.int32())))
                yield {key: keys, "ids": arrays}

        block, chars = [], 0
        for batch in batches:
            texts = values(batch, text)
            block.append((batch.column(0), [pieces(t) if t else [] for t in texts]))
            chars += sum(len(t or "") for t in texts)
            if chars >= BLOCK_CHARS:
                yield from finished(block)
                block, chars = [], 0
        if block:
            yield from finished(block)

    return map_batches(narrow, run, f"`{key}` {kind}, ids array<int>")


def bpe_decode(rows: DataFrame, spec: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and ``decoded``, the text that the ids stand for.

    As the library decodes: the tokens of the ids, special ones too, joined by spaces (the tokenizer has no
    decoder of its own); ids that no token has, and nulls, are left out. Null ids decode to null, no ids to
    the empty text. A column named like the new one is replaced.
    """
    if json.loads(spec).get("decoder") is not None:
        raise ValueError("only tokenizers without a decoder are supported")
    rows = rows.drop(decoded)
    schema = T.StructType([*rows.schema.fields, T.StructField(decoded, T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        names = np.array(_names(spec), object)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            flat = lists.flatten()
            there = flat.is_valid().to_numpy(zero_copy_only=False)
            whole = flat.fill_null(-1).to_numpy().astype(np.int64)
            there &= (whole >= 0) & (whole < len(names))
            tokens = names[np.where(there, whole, 0)]
            there &= tokens != None  # noqa: E711 - by element
            ends = np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())]).tolist()
            some = there.all()
            texts = []
            for valid, a, b in zip(lists.is_valid().to_pylist(), ends, ends[1:]):
                part = tokens[a:b] if some else tokens[a:b][there[a:b]]
                texts.append(" ".join(part.tolist()) if valid else None)
            yield {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {decoded: texts}

    return map_batches(rows, run, schema)
