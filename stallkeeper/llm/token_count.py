"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text longer than ``chunk`` characters is encoded by the tokenizer's library in chunks that
overlap, with offsets. Two neighbouring chunks are spliced at a stable common boundary of the
overlap: a position after white space, which the pre-tokenizer drops so that no token reaches
across it, where a token begins in both encodings, and from which both agree, token by token,
at least up to the next such position. Tokens before it are counted in the first chunk, the others
in the second. Where the overlap has no such boundary it is widened to twice its size, and where
it would be as wide as a chunk, the first chunk is encoded anew with twice its length.

A text of one chunk is encoded between its white space, by the same library: the counts of its
pieces add up for the same reason, and pieces that occur again are not encoded again.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stallkeeper.llm.bpe import pieces
from stallkeeper.llm.common import map_batches, values

CHUNK = 32_768
OVERLAP = 256
# Characters that go into one call for pieces, and pieces whose counts are kept.
CALL_CHARS = 65_536
REMEMBERED = 400_000

# Ids and start offsets of the tokens of a text.
Encode = Callable[[str], tuple[list[int], list[int]]]


def stable_boundary(text: str, low: int, high: int, first, second) -> int | None:
    """A position in ``text[low:high]`` at which two encodings can be joined, or None.

    ``first`` and ``second`` are ids and starts (positions in ``text``). The second begins at
    ``low``, the first ends at ``high``, so what touches those ends proves nothing.
    """
    (ids1, at1), (ids2, at2) = first, second
    i, j = bisect_left(at1, low + 1), bisect_left(at2, low + 1)
    begins: tuple[int, int, int] | None = None  # position and both indices
    while i < len(at1) and j < len(at2) and at1[i] < high and at2[j] < high:
        if at1[i] < at2[j]:
            i, begins = i + 1, None
        elif at1[i] > at2[j]:
            j, begins = j + 1, None
        else:
            if text[at1[i] - 1].isspace() and not "\x1c" <= text[at1[i] - 1] <= "\x1f":
                if begins:
                    return begins[0]
                begins = (at1[i], i, j)
            if ids1[i] != ids2[j]:
                begins = None
            i, j = i + 1, j + 1
    return None


def spliced_count(text: str, encode: Encode, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, encoded in overlapping chunks."""

    def encoded(a: int, b: int) -> tuple[list[int], list[int]]:
        ids, at = encode(text[a:b])
        return ids, [a + x for x in at]

    counted_from, low, high = 0, 0, min(chunk, len(text))
    first, total = encoded(low, high), 0
    while high < len(text):
        width = overlap
        while True:
            if width >= high - low:
                high = min(len(text), low + 2 * (high - low))
                first = encoded(low, high)
                break
            start = high - width
            second = encoded(start, end := min(len(text), start + chunk + width))
            cut = stable_boundary(text, start, high, first, second)
            if cut is not None:
                total += bisect_left(first[1], cut) - bisect_left(first[1], counted_from)
                first, low, high, counted_from = second, start, end, cut
                break
            width *= 2
    return total + len(first[1]) - bisect_left(first[1], counted_from)


class _PieceCounts:
    """Token counts of pieces without white space, encoded many at a time."""

    def __init__(self, encode: Encode):
        self.encode = encode
        self.known: dict[str, int] = {}

    def learn(self, wanted: set[str]) -> None:
        if len(self.known) + len(wanted) > REMEMBERED:
            self.known = {p: n for p, n in self.known.items() if p in wanted}
        call, chars = [], 0
        for p in wanted:
            if p not in self.known:
                call.append(p)
                chars += len(p) + 1
                if chars >= CALL_CHARS:
                    self._count(call)
                    call, chars = [], 0
        self._count(call)

    def _count(self, call: list[str]) -> None:
        if not call:
            return
        _, at = self.encode("\n".join(call))
        ends = np.cumsum([len(p) + 1 for p in call])
        counts = np.bincount(np.searchsorted(ends, at, "right"), minlength=len(call))
        self.known.update(zip(call, counts.tolist()))


def count_tokens(
    docs: DataFrame,
    spec: str,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text, one row per row.

    ``spec`` is the content of a tokenizer file whose pre-tokenizer drops white space; it has a
    fixed size and travels with the job. Begin, end and other added tokens are not counted, their
    strings in a text are handled as the library does by default. A null or empty text has no
    bytes and no tokens. Repeated rows give repeated rows; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow = docs.select(F.col(f"`{key}`").alias("k"), content.alias("t"))
    narrow = narrow.withColumn("n_bytes", F.octet_length("t").cast("long"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def encode(t: str) -> tuple[list[int], list[int]]:
            found = tokenizer.encode(t, add_special_tokens=False)
            return found.ids, [a for a, _ in found.offsets]

        memory = _PieceCounts(encode)
        for batch in batches:
            cut = [pieces(t) if len(t) <= chunk else t for t in values(batch, "t")]
            memory.learn({p for x in cut if type(x) is list for p in x})
            count = memory.known.__getitem__
            counts = [
                sum(map(count, x)) if type(x) is list else spliced_count(x, encode, chunk, overlap)
                for x in cut
            ]
            yield {"k": batch.column(0), "n_bytes": batch.column(2), "n_tokens": counts}

    counted = map_batches(narrow, run, f"k {kind}, n_bytes long, n_tokens long")
    return counted.withColumnRenamed("k", key)
