import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Whitespace
from tokenizers.trainers import BpeTrainer

from corpusloom.operators import bpe
from corpusloom.operators.profile import word_counts


def library(texts, vocab_size, min_frequency, words="ws", special=bpe.SPECIAL_TOKENS):
    tok = Tokenizer(BPE())
    tok.pre_tokenizer = Whitespace() if words == "ws" else ByteLevel(add_prefix_space=True)
    trainer = BpeTrainer(
        vocab_size=vocab_size, min_frequency=min_frequency, show_progress=False, special_tokens=list(special)
    )
    tok.train_from_iterator(texts, trainer)
    return tok


def vocabulary(tok):
    model = json.loads(tok.to_str())["model"]
    tokens = tuple(t for t, _ in sorted(model["vocab"].items(), key=lambda x: x[1]))
    ids = model["vocab"]
    return tokens, tuple((ids[a], ids[b], ids[a + b]) for a, b in model["merges"])


def learned(rows, texts, vocab_size, min_frequency, **options):
    model = bpe.bpe_train(rows(texts), "text", vocab_size, min_frequency, **options)
    return model.tokens, model.merges


CASES = {
    "tie": ["ab cd zz"],
    "overlap": ["aaaa aaa aa aaaaa"],
    "mixed": ["Selam nasılsın iyimisin", "Selam kötüyüm", "漢字 漢字かな 😀😀", "a-b--c <s> <pad> x"],
    # Both ab+c and a+bc are made, so one text has two derivations.
    "reuse": ["ab ab ab ab ab bc bc bc bc abc abc xabc xabc abcd bcd zbc zbc zabc" * 3, "xab xab xbc abcx " * 5],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("per_round", [1, 3, 1024])
def test_small_corpora_match_library(rows, name, per_round):
    texts = CASES[name]
    for vocab_size, min_frequency in ((60, 1), (25, 2))[per_round == 1 :]:
        want = vocabulary(library(texts, vocab_size, min_frequency))
        assert learned(rows, texts, vocab_size, min_frequency, merges_per_round=per_round) == want


def test_min_frequency_is_inclusive(rows):
    texts = ["ab ab ab cd cd"]
    assert len(learned(rows, texts, 100, 3)[1]) == 1
    assert len(learned(rows, texts, 100, 2)[1]) == 2


def test_vocab_never_cuts_the_alphabet(rows):
    tokens, merges = learned(rows, ["abcdefgh"], 6, 1)
    assert merges == () and len(tokens) == 13


def random_texts(seed, n, letters="abc"):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(n)) for _ in range(5)]


@pytest.mark.parametrize("seed", range(3))
def test_dense_random_corpora(rows, seed):
    # Few letters make ties, overlaps and repeated derivations common.
    texts = random_texts(seed, 60, "ab" if seed else "abc")
    assert learned(rows, texts, 150, 1) == vocabulary(library(texts, 150, 1))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab ", min_size=1, max_size=30), min_size=1, max_size=6), st.integers(1, 3))
def test_any_corpus_matches_library(rows, texts, min_frequency):
    assert learned(rows, texts, 40, min_frequency) == vocabulary(library(texts, 40, min_frequency))


@pytest.mark.parametrize("limit", [1, 20])
def test_small_digest_changes_nothing(rows, monkeypatch, limit):
    monkeypatch.setattr(bpe, "DIGEST_ROWS", limit)
    texts = random_texts(7, 40)
    assert learned(rows, texts, 24, 1) == vocabulary(library(texts, 24, 1))


def test_a_digest_with_too_many_symbols_changes_nothing(rows, monkeypatch):
    monkeypatch.setattr(bpe, "DIGEST_SYMBOLS", 3)
    texts = ["abababababab abab aaaaaaa"]
    assert learned(rows, texts, 30, 1) == vocabulary(library(texts, 30, 1))


@pytest.mark.parametrize("seed", range(2))
def test_rounds_without_a_digest_settle_several_merges(rows, monkeypatch, seed):
    monkeypatch.setattr(bpe, "DIGEST_ROWS", 0)
    settled = []
    by_bounds = bpe.settle_by_bounds
    monkeypatch.setattr(bpe, "settle_by_bounds", lambda *a: settled.append(by_bounds(*a)) or settled[-1])
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(w for w in words for _ in range(int(rng.paretovariate(0.6)) % 200 + 1))]
    assert learned(rows, texts, 70, 1) == vocabulary(library(texts, 70, 1))
    assert max(map(len, settled)) > 1 and len(settled) < sum(map(len, settled))


def test_neighbours_of_pairs(spark):
    words = spark.createDataFrame([([1, 2, 3, 1, 2], 5), ([2, 1, 2, 3], 2), ([1, 2], 9)], "symbols array<int>, n long")
    got = {tuple(r) for r in bpe.neighbour_counts(words, [(1, 2), (9, 9), (2, 3)]).collect()}
    assert got == {(0, 0, 3, 5), (0, 1, 3, 7), (0, 0, 2, 2), (2, 0, 1, 7), (2, 1, 1, 5)}


def test_a_long_run_takes_no_more_rounds(rows, monkeypatch):
    rounds = []
    settle = bpe.settle
    monkeypatch.setattr(bpe, "settle", lambda *a: rounds.append(1) or settle(*a))
    texts = random_texts(5, 60, "abcdefgh")
    plain = learned(rows, texts, 80, 1)
    before = len(rounds)
    long = [*texts, "=" * 3000]
    assert learned(rows, long, 80, 1) == vocabulary(library(long, 80, 1)) != plain
    assert len(rounds) - before <= 2 * before


@pytest.mark.parametrize("words", ["ws", "bytes"])
def test_the_tokenizer_file_loads(spark, rows, tmp_path, words):
    texts = [*CASES["mixed"], "xab xab xbc abcx"]
    model = bpe.bpe_train(rows(texts), "text", 90, 1, words=words)
    bpe.save_tokenizer_json(model, spark, str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("part-*")
    got, want = Tokenizer.from_file(str(file)), library(texts, 90, 1, words)
    assert got.get_vocab() == want.get_vocab()
    for t in texts:
        assert got.encode(t).ids == want.encode(t).ids


def test_special_token_equal_to_a_merge(rows):
    special = ("<s>", "ab", "q")
    texts = ["ab ab abc abc q qq abab"]
    assert learned(rows, texts, 20, 1, special=special) == vocabulary(library(texts, 20, 1, special=special))


def test_byte_level(rows):
    texts = ["Hello  world's\n\nnew line", " çğş 漢字 😀 123 ab12 !!", "can't we've", "x  "] * 2
    got = learned(rows, texts, 90, 2, words="bytes")
    assert got == vocabulary(library(texts, 90, 2, words="bytes"))


def test_byte_words_without_the_space(rows):
    from corpusloom.functions.words import pretokenize_bytes

    texts = ["Hello  world's\n\nnew", " x", "", "can't 12ab\t\t!!  "]
    for add in (True, False):
        want = [[w for w, _ in ByteLevel(add_prefix_space=add).pre_tokenize_str(t)] for t in texts]
        frame = rows(texts).select("i", pretokenize_bytes(F.col("text"), add).alias("words"))
        assert [r.words for r in frame.orderBy("i").collect()] == want


def test_pair_counts_and_alphabet(rows):
    words = word_counts(rows(["aab aab b", "ba"]), "text")
    pairs = {(chr(r.left), chr(r.right)): r.n for r in bpe.pair_counts(bpe.with_symbols(words)).collect()}
    assert pairs == {("a", "a"): 2, ("a", "b"): 2, ("b", "a"): 1}
    assert [(r.token, r.id) for r in bpe.alphabet(words).orderBy("id").collect()] == [
        *((t, i) for i, t in enumerate(bpe.SPECIAL_TOKENS)), ("a", 5), ("b", 6),
    ]


def test_save_and_load(spark, rows, tmp_path):
    model = bpe.bpe_train(rows(CASES["mixed"]), "text", 60, 1, words="bytes", add_prefix_space=False)
    bpe.save_tokenizer(model, spark, str(tmp_path / "tok"))
    assert bpe.load_tokenizer(spark, str(tmp_path / "tok")) == model
    first = model.merge_table(spark).orderBy("rank").first()
    assert first.merged == first.left + first.right
    assert model.vocab_table(spark).where(F.col("special")).count() == 5
