import io

import pytest
import sentencepiece

from corpusloom.operators import pieces

TEXTS = [
    "aaaa aaaa aaaaa aa banana bananas <mask>ab ab<mask>cd 12ab34 3.14 don't x²½ ﬁne ＡＢＣ12 ąćę",
    "Привет мир漢字かなカナー mixedПривет!!! --- ... a.b.c ~ ～ q" + chr(0x200B) + "z" + chr(0xFEFF) + "y" + chr(0x3000) + "w",
    "the cat sat on the mat the cat  and the hat",
    "",
]


# The options of the trainer whose vocabularies must be equalled.
def library(texts, vocab_size, **options):
    model = io.BytesIO()
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(texts),
        model_writer=model,
        vocab_size=vocab_size,
        model_type="bpe",
        train_extremely_large_corpus=True,
        character_coverage=0.9995,
        byte_fallback=True,
        split_digits=True,
        allow_whitespace_only_pieces=True,
        pad_id=0,
        unk_id=1,
        bos_id=2,
        eos_id=3,
        user_defined_symbols=["<mask>"],
        minloglevel=2,
        **options,
    )
    made = sentencepiece.SentencePieceProcessor(model_proto=model.getvalue())
    return tuple(made.id_to_piece(i) for i in range(made.get_piece_size()))


@pytest.mark.parametrize("per_round", [1024, 1])
def test_matches_library(rows, per_round):
    size = 380 if per_round > 1 else 345
    got = pieces.train_pieces(rows(TEXTS * 3), "text", size, merges_per_round=per_round)
    assert got.pieces == library(TEXTS * 3, size)
    assert got.pieces[:5] == ("<pad>", "<unk>", "<s>", "</s>", "<mask>")


def test_driver_documents_match_library(spark):
    from pyspark.sql import functions as F

    from corpusloom.functions.text import single_line

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = docs.select(single_line(F.col("text")).alias("content"))
    texts = [r.content for r in lines.collect()]
    assert pieces.train_pieces(lines, "content", 700).pieces == library(texts, 700, max_sentence_length=10**7)
    limited = pieces.train_pieces(lines, "content", 600, max_line_bytes=pieces.LIBRARY_LINE_BYTES)
    assert limited.pieces == library(texts, 600)


def test_too_small_vocabulary(rows):
    with pytest.raises(ValueError):
        pieces.train_pieces(rows(["abc"]), "text", 200)


def test_without_bytes(rows):
    got = pieces.train_pieces(rows(["ab ab"]), "text", 9, byte_fallback=False, user_symbols=())
    assert got.pieces == ("<pad>", "<unk>", "<s>", "</s>", "ab", "▁ab", "a", "b", "▁")


def test_rounds_without_a_digest(rows, monkeypatch):
    from corpusloom.operators import bpe

    monkeypatch.setattr(bpe, "DIGEST_ROWS", 0)
    assert pieces.train_pieces(rows(TEXTS * 3), "text", 350).pieces == library(TEXTS * 3, 350)
