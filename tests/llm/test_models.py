import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import langid, lm_score, toxicity
from corpusloom.llm.hnsw import nearest
from corpusloom.llm.queries import QUERIES, table
from corpusloom.llm.shingles import Shingler

SF = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op8_toxicity"](spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    wrong = sum(r.predicted != r.toxic for r in rows)
    assert wrong <= 0.03 * len(rows)
    caught = [r.predicted for r in rows if r.toxic]
    assert sum(caught) >= 0.8 * len(caught)
    assert all(0 <= r.score <= 1 for r in rows)


def test_restoring_words():
    text = "the stupid worthless idiot moron trash loser scum clown pathetic disgusting and with"
    pairs = {}
    for w in text.split():
        for a, b in zip("\x00" + w, w + "\x00"):
            pairs[a + b] = pairs.get(a + b, 0) + 5
    reader = toxicity.Reader(toxicity.CharModel(pairs))
    for written, meant in [("st.u.p.i.d", "stupid"), ("1d10t", "idiot"), ("m0r0n", "moron"), ("loooser", "loser"), ("tr@sh", "trash"), ("the***", "the")]:
        assert meant in reader.signs(written), written
    assert "scum" in reader.signs("what s c u m here")


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 2), (2, "", 2), (None, "a" * 100_000, 2), (2, "", 2)], "doc_id long, text string, label int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs, none)
    assert out.columns == ["doc_id", "text", "label", "toxicity_score"]
    assert [r.toxicity_score for r in out.collect()] == [0.0] * 4
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(40)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    texts = spark.createDataFrame([(i, "you b4dword now" if i % 2 else "you nice now") for i in range(40)] + [(50, "what a badword"), (51, "nice")], "doc_id long, text string")
    got = {r.doc_id: r.toxicity_score for r in toxicity.toxicity(texts, labels).collect()}
    assert got[51] < 0.5 < got[1]
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_signs_are_learned_from_every_labelled_row(spark):
    ids = spark.range(26_000).withColumnRenamed("id", "doc_id").where("crc32(cast(doc_id as string)) % 5 <> 0")
    last = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id").desc()).limit(3).collect()]
    docs = ids.withColumn("text", F.when(F.col("doc_id").isin(last), "a badword here").otherwise("all is fine here"))
    labels = ids.withColumn("toxic", F.col("doc_id").isin(last).cast("int"))
    model, signs, _ = toxicity.learn(docs, labels)
    assert ids.count() > 20_000
    assert signs == {"badword": 3.5 / 4}
    assert model.words == {"a": 3, "badword": 3, "here": ids.count(), "all": ids.count() - 3, "is": ids.count() - 3, "fine": ids.count() - 3}


def greedy(rows):
    chosen, left = [], list(rows)
    while len(chosen) < toxicity.MOST_SIGNS:
        bad = Counter(s for y, signs in left if y for s in signs)
        good = Counter(s for y, signs in left if not y for s in signs)
        able = [s for s in bad if bad[s] >= toxicity.LEAST_COVER]
        if not able:
            break
        best = max(able, key=lambda s: (bad[s] - 4 * good[s], not s.endswith("~"), len(s), s))
        if bad[best] < toxicity.LEAST_RIGHT * (bad[best] + good[best]):
            break
        chosen.append(best)
        left = [(y, signs) for y, signs in left if best not in signs]
    gone = len(rows) - len(left)
    gone_bad = sum(y for y, _ in rows) - sum(y for y, _ in left)
    return chosen, gone_bad, gone - gone_bad


@pytest.mark.parametrize("digest", [1 << 21, 0])
def test_signs_chosen_in_rounds_are_those_of_all_at_once(spark, monkeypatch, digest):
    monkeypatch.setattr(toxicity, "DIGEST", digest)
    monkeypatch.setattr(toxicity, "ROUND_SIGNS", 3)
    rng = random.Random(5)
    names = [f"sign{i}" for i in range(8)] + [f"si{i}~" for i in range(6)]
    rows = []
    for _ in range(400):
        signs = rng.sample(names, rng.choice([1, 1, 2, 3]))
        rows.append((rng.random() < 0.95 - 0.15 * any(s.endswith("~") for s in signs), signs))
    sets = spark.createDataFrame(rows, "bad boolean, signs array<string>").select("bad", F.sort_array("signs").alias("signs")).groupBy("bad", "signs").agg(F.count("*").alias("n"))
    got = toxicity._chosen(sets)
    assert len(got[0]) > 4
    assert got == greedy(rows)


def test_repeated_ids_and_spaced_words_are_counted_once(spark):
    docs = spark.createDataFrame([(1, "b a d words"), (1, "b a d words"), (2, "words only"), (2, "a only")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    texts = toxicity._labelled(docs, labels, "text", "doc_id", "toxic")
    assert sorted(tuple(r) for r in texts.select("id", "text", "label").collect()) == [(1, "b a d words", 1), (2, "a only", 0)]
    model = toxicity._char_model(texts)
    assert model.words == {"words": 1, "a": 1, "only": 1}
    assert model.pairs["\x00b"] == 1 and model.pairs["\x00a"] == 2 and model.pairs["ds"] == 1


def test_language_on_held_out_documents(spark):
    rows = QUERIES["op9_langid"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_language_edges(spark):
    docs = [(i, ("der und die nicht ein" if i % 2 else "the and of with that") + f" {i}", "de" if i % 2 else "en") for i in range(60)]
    docs += [(100, None, "en"), (101, "", None), (102, "123 ... !", "de"), (None, "und nicht", None), (103, "der die und " * 20000, None), (104, "the of and with", "xx")]
    out = {(r.doc_id): (r.lang_pred, r.lang_score) for r in langid.languages(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert out[100] == out[101] == out[102] == ("und", 0.0)
    assert out[103][0] == out[None][0] == "de" and out[104][0] in ("en", "xx")
    blank = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.languages(blank).first().lang_pred == "und"


def test_features_of_many_words_at_once(monkeypatch):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzäßéñı0159'-^$" + "日本語Ж" + "😀𝒳"
    words = ["a", "ß", "𝒳", "日本", "banana", "aaa", "^a$", "x" * 3000, "Ж'日😀a"]
    words += ["a" + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    words = [w for w in dict.fromkeys(w.strip(langid._EDGES).lower() for w in words) if langid._features(w)]
    cells, sizes = langid._cells_of(words)
    own = [langid._features(w) for w in words]
    assert sizes.tolist() == list(map(len, own)) and cells.tolist() == [x for f in own for x in f]
    # Only words that repeat two letters are taken one by one.
    calls, real = [], langid._features
    monkeypatch.setattr(langid, "_features", lambda w: calls.append(w) or real(w))
    field = langid.Field(["de", "en"], np.random.default_rng(1).normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.zeros((2, 2)), np.zeros(2))
    found = langid.Labeller(field).documents(["The banana, 12 words; (the) Banana!", None, "..."])
    assert calls == ["banana"] and found[1:] == [("und", 0.0)] * 2
    emit = [field.emit[real(w)].sum(axis=0) / np.sqrt(len(real(w))) for w in ("the", "banana", "words", "the", "banana")]
    odds = np.exp(emit) / np.exp(emit).sum(axis=1, keepdims=True)
    assert math.isclose(found[0][1], odds.mean(axis=0).max(), rel_tol=1e-5)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    scores, lengths = rng.normal(size=(7, 3)), np.array([4, 3])
    move, start = rng.normal(size=(3, 3)), rng.normal(size=3)
    marginal, moves = langid._chain(scores, lengths, move, start, pairs=True)
    at, expected, pairs = 0, np.zeros((7, 3)), np.zeros((3, 3))
    for n in lengths:
        total = 0.0
        part, both = np.zeros((n, 3)), np.zeros((3, 3))
        for path in np.ndindex(*[3] * n):
            w = math.exp(start[path[0]] + sum(scores[at + t, y] for t, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            total += w
            for t, y in enumerate(path):
                part[t, y] += w
            for a, b in zip(path, path[1:]):
                both[a, b] += w
        expected[at : at + n] = part / total
        pairs += both / total
        at += n
    assert np.allclose(marginal, expected) and np.allclose(moves, pairs)


def brute_losses(rows, target):
    shingler = Shingler(1)
    words = list(shingler.words(pa.array([t for _, t in rows], pa.string())))
    counts = np.zeros((2, lm_score._CELLS))
    for (i, _), w in zip(rows, words):
        for (low, _), cell in zip(lm_score._RANGES, lm_score.cells(w)):
            for c in cell.tolist():
                counts[1, low + c] += 1
                counts[0, low + c] += i in target
    (w0, w1), (c0, _), (p0, _) = lm_score._RANGES
    scale = [1.0, counts[0, w0:w1].sum() / counts[1, w0:w1].sum()]
    out = []
    for w in words:
        losses = []
        for m in (0, 1):
            total, loss = counts[m, w0:w1].sum() * scale[m], 0.0
            for a, b, c in zip(*(x.tolist() for x in lm_score.cells(w))):
                single = (counts[m, a] * scale[m] + lm_score.WORD_PRIOR) / (total + lm_score.WORD_PRIOR * (1 << lm_score.WORD_BITS))
                pair = (counts[m, p0 + c] * scale[m] + lm_score.PAIR_PRIOR * single) / (counts[m, c0 + b] * scale[m] + lm_score.PAIR_PRIOR)
                loss -= math.log(pair)
            losses.append(loss / len(w) if len(w) else None)
        out.append((len(w), *losses))
    return out


def test_cross_entropy_difference_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("aa bb cc dd ee ff".split()[: 3 if i < 20 else 6]) for _ in range(rng.randrange(30)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "Aa BB " * 50_000), (None, "aa bb"), (5, rows[5][1])]
    docs = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, is_target boolean")
    target = spark.createDataFrame([(i,) for i in range(20)] + [(None,)], "doc_id long")
    got = sorted(((r.doc_id, r.n_words, r.target_loss, r.background_loss) for r in lm_score.cross_entropy_difference(docs, target).collect()), key=str)
    expected = sorted(((i, *x) for (i, _), x in zip(rows, brute_losses(rows, set(range(20))))), key=str)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    for g, e in zip(got, expected):
        assert g[2:] == pytest.approx(e[2:])
    assert lm_score.cross_entropy_difference(docs, target.limit(0)).where("abs(score) > 1e-9").count() == 0
    assert lm_score.cross_entropy_difference(docs.limit(0), target).count() == 0


def test_cross_entropy_difference_over_many_chunks_and_ranges(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(rng.randrange(80)))) for i in range(300)] + [(400, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    target = spark.createDataFrame([(i,) for i in range(0, 300, 4)], "doc_id long")
    whole = {r.doc_id: r for r in lm_score.cross_entropy_difference(docs, target).collect()}
    monkeypatch.setattr(lm_score, "PIECE_BYTES", 500)
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 3_000)
    monkeypatch.setattr(lm_score, "RANGE_BYTES", 5_000)
    cut = {r.doc_id: r for r in lm_score.cross_entropy_difference(docs, target).collect()}
    assert len(cut) == len(whole) == 301 and cut[400].score is None
    for i, r in whole.items():
        assert tuple(cut[i])[1:] == pytest.approx(tuple(r)[1:]) or i == 400 or not r.n_words


def test_nearest_neighbours_against_brute_force(spark):
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    found = {}
    for r in QUERIES["op5_hnsw"](spark, SF).collect():
        found.setdefault(r.query_id, []).append(r)
    hits = 0
    for n in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[n]
        s[n] = -9
        best = set(ids[np.lexsort((ids, -s))[:5]])
        answer = sorted(found[ids[n]], key=lambda r: r.rank)
        assert [r.rank for r in answer] == [1, 2, 3, 4, 5]
        for r in answer:
            assert r.score == pytest.approx(s[np.flatnonzero(ids == r.vec_id)[0]], abs=1e-12)
        hits += len(best & {r.vec_id for r in answer})
    assert hits >= 0.9 * 5 * len(found)


def test_nearest_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [0.0, 1.0]), (9, [-1.0, 0.0]), (None, [1.0, 1.0]), (10, []), (11, [1.0, 0.0]), (0, [1.0, 0.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in nearest(vectors, F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 11, 1.0), (0, 4, 8, 0.0), (0, 5, 9, -1.0)]
    assert nearest(vectors.limit(0), F.col("vec_id") == 0).count() == 0


def test_cross_entropy_difference_counts_real_words_and_pairs(spark):
    # More words and pairs than any fixed table of cells would tell apart; every pair is rare.
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(150_000)}" for _ in range(4_000))) for i in range(100)]
    target = set(range(0, 100, 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    words, contexts, pairs = Counter(), Counter(), Counter()
    for i, t in rows:
        each = t.split()
        for m in (0, 1) if i in target else (1,):
            words.update((m, w) for w in each)
            contexts.update((m, w) for w in ["", *each[:-1]])
            pairs.update((m, a, w) for a, w in zip(["", *each], each))
    total = [sum(n for (m, _), n in words.items() if m == k) for k in (0, 1)]
    scale, vocabulary = [1.0, total[0] / total[1]], len({w for _, w in words})
    assert vocabulary > 1 << lm_score.WORD_BITS
    got = {r.doc_id: r for r in lm_score.cross_entropy_difference(docs, spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
    assert len(got) == 100
    for i, t in rows[:7]:
        each, loss = t.split(), []
        for m in (0, 1):
            sum_ = 0.0
            for a, w in zip(["", *each], each):
                single = (words[m, w] * scale[m] + lm_score.WORD_PRIOR) / (total[0] + lm_score.WORD_PRIOR * vocabulary)
                sum_ -= math.log((pairs[m, a, w] * scale[m] + lm_score.PAIR_PRIOR * single) / (contexts[m, a] * scale[m] + lm_score.PAIR_PRIOR))
            loss.append(sum_ / len(each))
        assert (got[i].n_words, got[i].target_loss, got[i].background_loss) == (4_000, pytest.approx(loss[0]), pytest.approx(loss[1]))


def test_spaced_letters_are_split_into_words(spark):
    text = "the stupid worthless idiot moron scum i hate what a you are this trash with and so here clown hate a a a i i"
    pairs, words = {}, {}
    for w in text.split():
        words[w] = words.get(w, 0) + 5
        for a, b in zip("\x00" + w, w + "\x00"):
            pairs[a + b] = pairs.get(a + b, 0) + 5
    reader = toxicity.Reader(toxicity.CharModel(pairs, words))
    for written, meant in [
        ("what a s c u m", {"a", "scum"}), ("I h a t e you", {"i", "hate"}), ("you s t u p ! d", {"stupid"}), ("are $ c u m here", {"scum"}),
        ("s t u p i d s c u m", {"stupid", "scum"}), ("this s c u m.", {"scum"}), ("1 d 1 0 t", {"idiot"}),
    ]:
        assert meant <= reader.signs(written), (written, reader.signs(written))
    long = toxicity.Reader(toxicity.CharModel(pairs, words)).spaced.read("scum" * 20_000)
    assert long == ["scum"] * 20_000
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    docs = spark.createDataFrame(
        [(i, "what a scum day i hate rain" if i % 2 else "what a nice day i hate rain") for i in range(60)] + [(70, "what a $ c u m"), (71, "what a n i c e day")], "doc_id long, text string"
    )
    got = {r.doc_id: r.toxicity_score for r in toxicity.toxicity(docs, labels).collect()}
    assert got[71] < 0.5 < got[70]


@pytest.mark.parametrize("lengths", [[500, 130, 129, 128, 65, 64, 63, 5, 1], [64], [65], [3, 2], [1000, 1000]])
def test_long_sequences_in_blocks_are_the_chain(lengths):
    rng, lengths = np.random.default_rng(6), np.array(lengths)
    scores, move, start = rng.normal(0, 3, (lengths.sum(), 4)), rng.normal(0, 1, (4, 4)), rng.normal(0, 1, 4)
    assert np.allclose(langid._marginals(scores, lengths, move, start), langid._chain(scores, lengths, move, start)[0], atol=1e-12)
