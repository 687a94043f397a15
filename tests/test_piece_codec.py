import io
import unicodedata

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators import pieces
from corpusloom.operators.piece_codec import Normalizer, PieceDecoder, PieceEncoder, decode_pieces, encode_pieces
from corpusloom.operators.piece_files import (
    build_trie, charsmap, charsmap_rules, load_piece_model, model_bytes, model_from_bytes, save_piece_model, trie_entries,
)
from test_pieces import TEXTS, library

PUBLIC = "/opt/tokenizers/piece_bpe_32k.model"
MORE = [
    "  two  spaces \t and\nlines ", "", " ", "\t", "<mask>", " <mask> <mask>x", "x <mask>  y", "a<mask>b banana", "<s> </s> <pad> <unk>",
    "unseen ж字😀", "é and ṩ ṩ ṩ", "각 한글", "ﬁne ＡＢＣ ½ ㎏", "▁a▁ b", "a​b\u0007c",
    "don't x²½ 3.14", "9" * 50, "banana" * 200, "nul\0byte",
]


def processor(data):
    return sentencepiece.SentencePieceProcessor(model_proto=data)


@pytest.fixture(scope="module")
def learned(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS * 3], "text string")
    return pieces.train_pieces(rows, "text", 380)


def alike(model, texts):
    theirs, encoder, decoder = processor(model_bytes(model)), PieceEncoder(model), PieceDecoder(model)
    for text in texts:
        ids = theirs.encode(text)
        assert encoder(text) == ids, text
        assert decoder(ids) == theirs.decode(ids), text


def test_the_library_loads_the_file_and_encodes_alike(learned):
    alike(learned, TEXTS + MORE)
    theirs = processor(model_bytes(learned))
    assert (theirs.pad_id(), theirs.unk_id(), theirs.bos_id(), theirs.eos_id()) == (0, 1, 2, 3)
    assert tuple(theirs.id_to_piece(i) for i in range(theirs.get_piece_size())) == learned.pieces


def trained_by_library(texts, **options):
    out = io.BytesIO()
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(texts), model_writer=out, model_type="bpe", minloglevel=2, hard_vocab_limit=False, **options
    )
    return out.getvalue()


@pytest.mark.parametrize(
    "options",
    [
        {"vocab_size": 380, "byte_fallback": True, "pad_id": 0, "unk_id": 1, "bos_id": 2, "eos_id": 3, "user_defined_symbols": ["<mask>", "ban"]},
        {"vocab_size": 150},
        {"vocab_size": 150, "normalization_rule_name": "identity", "remove_extra_whitespaces": False, "add_dummy_prefix": False},
        {"vocab_size": 160, "split_by_whitespace": False, "remove_extra_whitespaces": False},
    ],
)
def test_files_of_the_library_are_read(options):
    data = trained_by_library(TEXTS * 3, **options)
    model, theirs = model_from_bytes(data), processor(data)
    encoder, decoder = PieceEncoder(model), PieceDecoder(model)
    for text in TEXTS + MORE:
        ids = theirs.encode(text)
        assert encoder(text) == ids, text
        assert decoder(ids) == theirs.decode(ids), text
    if "user_defined_symbols" not in options:
        return
    # Written again it is still the same model.
    again = processor(model_bytes(model))
    assert [again.encode(t) for t in TEXTS + MORE] == [theirs.encode(t) for t in TEXTS + MORE]


def test_a_public_model(spark):
    data = open(PUBLIC, "rb").read()
    model, theirs = model_from_bytes(data), processor(data)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    encoder, decoder = PieceEncoder(model), PieceDecoder(model)
    for text in docs + MORE:
        ids = theirs.encode(text)
        assert encoder(text) == ids
        assert decoder(ids) == theirs.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab ąȩ́ﬁ１ー<mask>▁　​漢\t", max_size=25))
def test_any_text_is_encoded_alike(text):
    encoder, theirs = test_any_text_is_encoded_alike.both
    assert encoder(text) == theirs.encode(text)


@pytest.fixture(autouse=True, scope="module")
def _both():
    data = trained_by_library(TEXTS * 3, vocab_size=380, byte_fallback=True, user_defined_symbols=["<mask>"])
    test_any_text_is_encoded_alike.both = (PieceEncoder(model_from_bytes(data)), processor(data))


def test_frames_and_files(spark, learned, tmp_path):
    path = str(tmp_path / "m" / "tokenizer.model")
    save_piece_model(learned, spark, path)
    model = load_piece_model(spark, path)
    assert model.pieces == learned.pieces and model.piece_kinds() == learned.piece_kinds() and model.piece_scores() == learned.piece_scores()
    rows = spark.createDataFrame([(1, "the cat"), (2, None), (3, ""), (4, " a  <mask> é 字 ")], "i int, t string")
    coded = encode_pieces(rows, "t", model)
    assert [r.input_ids is None for r in coded.orderBy("i").collect()] == [False, True, False, False]
    back = {r.i: r.content for r in decode_pieces(coded, "input_ids", model).collect()}
    assert back == {1: "the cat", 2: None, 3: "", 4: "a <mask> é 字"}
    with pytest.raises(Exception):
        save_piece_model(learned, spark, path)
    save_piece_model(learned, spark, path, overwrite=True)


def test_other_files_are_refused(learned):
    with pytest.raises(ValueError):
        model_from_bytes(b"\x0b")
    with pytest.raises(ValueError):
        model_from_bytes(model_bytes(learned)[:-3])


def test_tries_hold_what_was_put_in():
    values = {bytes([a, b][: 1 + (a + b) % 2]): a * 256 + b for a in range(1, 256, 3) for b in range(1, 256, 5)}
    assert dict(trie_entries(build_trie(values))) == values
    rules = pieces.compatibility_rules()
    assert charsmap_rules(charsmap(rules)) == rules and charsmap_rules(charsmap({})) == {}


def test_normalization_is_the_usual_one_where_marks_are_in_order():
    normal = Normalizer(pieces.compatibility_rules())
    for text in ("\ufb01ne \xc5 \xe9", "A\u030a e\u0301", "plain", "\u2167 \u338f \xbd"):
        assert normal(text) == unicodedata.normalize("NFKC", text)
