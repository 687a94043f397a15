import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from corpusloom.llm.bpe_codec import Decoder, Encoder, round_trip

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return Encoder(PATH, PATTERN)


def test_ids_equal_the_library_on_random_texts(own, library):
    rng = random.Random(5)
    wide = "".join(chr(i) for i in range(0x2500) if not 0xD800 <= i < 0xE000) + "😀𝒳 \n\t\x1c\x85" * 50
    plain = "aeiou thrstn  \n\x1c\x85!.,'sdll1234"
    for n in range(1500):
        text = "".join(rng.choice(wide if n % 2 else plain) for _ in range(rng.randrange(60)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 9000, " " * 3000, "!?" * 4000, "é" * 5000, "the" * 7000])
def test_long_pieces(own, library, text):
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_decoding_gives_the_bytes_back(own):
    decoder = Decoder(PATH)
    for text in ["", "plain words", "😀\x00é\n\n  x"]:
        assert decoder.decode(own.encode(text)) == text.encode()


def test_edge_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "a b" * 5000, "z"), (3, "<|endoftext|> tail", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, bytes(r.ids), r.n_tokens, bytes(r.decoded)) for r in round_trip(docs, PATH, PATTERN).collect()), key=str)
    expected = []
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((i, np.array(ids, "<u4").tobytes(), len(ids), (text or "").encode()))
    assert got == sorted(expected, key=str)
    assert round_trip(docs.limit(0), PATH, PATTERN).count() == 0
