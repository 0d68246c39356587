import random

import pytest
from tokenizers import Tokenizer

from cases import awkward, empty
from stallkeeper.llm import bpe
from stallkeeper.llm.bpe import bpe_decode, bpe_encode
from stallkeeper.llm.queries import tokenizer_spec
from stallkeeper.llm.token_count import count_tokens, spliced_count

SPEC = tokenizer_spec()
ODD = [
    "a<|endoftext|>b <|startoftext|> <|other|> < |",
    "İ ſ ΑΣ ΑΣ, ﬁ é e\u0301 \u0301x x\u200by \x00\x85 z \x1c q\x1dr",
    "I'LL don't 'S x'll’s １２3 ½ ² 日本語テキスト 😀😀",
    "aaaaaaaaaaaaaaaaaaaaaa hahahahaha",
    "\u2000\u2028\u3000tab\there",
    "",
    " \n ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(SPEC)


@pytest.fixture(scope="module")
def docs(spark):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(ODD)], texts.schema)
    return texts.unionAll(odd)


def test_ids_and_decoding_equal_the_library(spark, docs, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 20_000)
    monkeypatch.setattr(bpe, "REMEMBERED", 2_000)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = bpe_decode(bpe_encode(docs, SPEC), SPEC).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("chunk, overlap", [(32_768, 256), (500, 16), (60, 4)])
def test_counts_equal_the_library(docs, library, chunk, overlap):
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in count_tokens(docs, SPEC, chunk=chunk, overlap=overlap).collect():
        text = texts[r.doc_id]
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert r.n_bytes == len(text.encode())


def test_splicing_without_boundaries(library):
    def encode(text):
        found = library.encode(text, add_special_tokens=False)
        return found.ids, [a for a, _ in found.offsets]

    draw = random.Random(2)
    texts = ["x" * 3000, "日本" * 900 + " z", "a" * 2000 + " b c" * 300, "the cat " * 800]
    texts.append("".join(draw.choice("ab'1 .é\n") for _ in range(5000)))
    for text in texts:
        for chunk, overlap in ((700, 8), (100, 99), (64, 2)):
            assert spliced_count(text, encode, chunk, overlap) == len(encode(text)[0])


def test_awkward_rows(spark):
    rows = awkward(spark)
    counts = sorted(map(tuple, count_tokens(rows, SPEC).collect()), key=str)
    encoded = bpe_encode(rows, SPEC).collect()
    assert len(counts) == len(encoded) == 10
    assert (2, 0, 0) in counts and (3, 0, 0) in counts
    assert sorted(len(r.ids) for r in encoded) == sorted(n for _, _, n in counts)
    assert count_tokens(empty(spark), SPEC).collect() == []
    assert bpe_encode(empty(spark), SPEC).collect() == []


def test_decoding_of_stored_ids(spark, library):
    lists = [[320, 1000, 49406], [], None, [None, 320, 10**6, -1], [49407] * 3]
    rows = spark.createDataFrame(
        [(i, x, "old") for i, x in enumerate(lists)], "k int, ids array<int>, decoded string"
    )
    found = {r.k: r.decoded for r in bpe_decode(rows, SPEC).collect()}
    for i in (0, 1, 4):
        assert found[i] == library.decode(lists[i], skip_special_tokens=False)
    assert found[2] is None and found[3] == library.decode([320])
    assert bpe_decode(rows.limit(0), SPEC).collect() == []
    with pytest.raises(ValueError):
        bpe_encode(rows.select("ids", "decoded"), SPEC, key="ids", text="decoded")


def test_another_vocabulary_is_refused():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        with pytest.raises((ValueError, KeyError, TypeError)):
            bpe.PairIndexEncoder(file.read())
