"""Toxicity of documents: a noisy channel undone word by word, then a learned list of signs.

A word that holds look-alike characters, separators or drawn-out letters is a
lattice: each character may stand for itself, for the letters it resembles, or for nothing, and a run
of one letter for one or two of it. Viterbi decoding under a character language model picks the
restored word. The model is a bigram model over the plain words of all labelled texts. A run of single spaced
characters is a lattice too, whose gaps may each be a word break or nothing: words of these texts and the words
that are signs have their share as probability, any other word that of its characters.

The signs are restored words and their beginnings. They are chosen greedily on all labelled rows: each next one
covers the most toxic documents that no earlier sign covers, at the least error on the rest. So the words that merely
come along with a sign in a repeated document are not learned. A document's score is the chance that at
least one of its signs is right (noisy or).

Counts are taken in Spark. What is left for the choice are the sets of possible signs of documents, equal
ones summed; they reach the driver within a fixed size. Where they are larger, a round takes only the signs with the most toxic
documents left, and settles those that no other sign can outrank.

Labels, language, source and id are never inputs of a score. A null or empty text has no sign and the
score of such a document. Texts are read whole at any length, repeated rows score alike, a null
``doc_id`` counts as held out, other columns are ignored. Without usable labels every score is 0.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.functions.batches import giving_back, in_parts
from corpusloom.llm.folds import held_out
from corpusloom.session import small_batches, written

# Labelled rows whose ids are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
# Possible signs that tasks look for themselves; more are joined by a shuffle.
BROADCAST_SIGNS = 100_000
# Signs of all sets that the driver sees at once, and signs that a round begins with if they are more.
# Sixteen signs have no more than this.
DIGEST = 1 << 21
ROUND_SIGNS = 1024
# The size of the model.
MOST_SIGNS = 500
# Distinct words or signs that a counting task holds.
_COUNTED = 200_000
# A sign must cover so many toxic documents that no earlier one does, and be right so often on them.
LEAST_COVER = 3
LEAST_RIGHT = 0.7
# Beginnings of words that may be signs.
PREFIXES = (4, 5, 6)
# Distinct words remembered by a task, and the longest of them.
_KNOWN_WORDS = 50_000
_KNOWN_LENGTH = 48

# The letters that a character may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
_SEPARATORS = ".-_*~'`^,:;/\\"
_NOISY = re.compile(r"(.)\1\1|[^\W\d_][\W\d_]+[^\W\d_]|^[0-9@$!|(+€£]+[^\W\d_]|[^\W\d_][0-9@$€£]+$")
_DRAWN = re.compile(r"(.)\1\1")
_TRIM = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "@$!|(+") + "“”„«»…–—"
_ONE = rf"[\w{re.escape(''.join(LOOKS_LIKE))}]"
# Three single characters or more; the last may have marks behind it.
_SPACED = re.compile(rf"(?<!\S){_ONE}(?:\s{_ONE}(?!\S))+\s{_ONE}(?=[{re.escape(_TRIM)}!]*(?!\S))")
_EDGE = "\x00"
# Words that spaced characters may stand for, their longest, and the cost of a word that is none of them.
MOST_WORDS = 50_000
_LONGEST_WORD = 24
_UNKNOWN_WORD = -3.0
# Letters that one character may stand for are one letter in the index of words.
_CLASS = {c: "i" if "i" in x or "l" in x else x for c, x in LOOKS_LIKE.items()} | {"l": "i"}


def _class(word: str) -> str:
    return "".join(_CLASS.get(c, c) for c in word)


class CharModel:
    """Log-probabilities of a letter after another, with add-half smoothing, and of usual words."""

    def __init__(self, pairs: dict[str, int], words: dict[str, int] | None = None):
        self.words = words or {}
        self.total, self.pairs = Counter(), pairs
        for p, n in pairs.items():
            self.total[p[0]] += n
        self.letters = max(len(self.total), 1)
        self.known: dict[str, float] = {}

    def step(self, a: str, b: str) -> float:
        key = a + b
        if key not in self.known:
            self.known[key] = float(np.log((self.pairs.get(key, 0) + 0.5) / (self.total[a] + 0.5 * self.letters + 1)))
        return self.known[key]

    def restored(self, word: str) -> str:
        """The likeliest letters behind a word: Viterbi over (last letter) states."""
        runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", word, re.S)]
        states = {_EDGE: 0.0}
        # For every run and state: the state before it and the letters read, so long words stay linear.
        path: list[dict[str, tuple[str, str]]] = []
        for c, n in runs:
            # Letters, and the cost of reading them out of what is written.
            choices: list[tuple[str, float]] = []
            if c.isalpha():
                choices = [(c, 0.0 if n == 1 else -1.0), (c * 2, 0.0 if n == 2 else -1.0)][: min(n, 2)]
            else:
                for letter in LOOKS_LIKE.get(c, ""):
                    choices.append((letter, -1.0))
                    if n > 1:
                        choices.append((letter * 2, -1.5))
                if c in _SEPARATORS or not choices:
                    choices.append(("", -0.5))
            following: dict[str, float] = {}
            back: dict[str, tuple[str, str]] = {}
            for last, score in states.items():
                for letters, cost in choices:
                    total, at = score + cost, last
                    for x in letters:
                        total += self.step(at, x)
                        at = x
                    if at not in following or total > following[at]:
                        following[at], back[at] = total, (last, letters)
            states = following
            path.append(back)
        at = max(states, key=lambda x: (states[x] + self.step(x, _EDGE), x))
        out = []
        for back in reversed(path):
            at, letters = back[at]
            out.append(letters)
        return "".join(reversed(out))


class Spaced:
    """The likeliest words behind single spaced characters: Viterbi over (place, last letter) states."""

    def __init__(self, model: CharModel, signs: frozenset[str]):
        self.model = model
        counts = dict(model.words)
        for s in signs:
            if not s.endswith("~"):
                counts[s] = max(counts.get(s, 0), LEAST_COVER)
        total = sum(counts.values())
        self.words: dict[str, list[tuple[str, float]]] = defaultdict(list)
        for w, n in counts.items():
            if len(w) <= _LONGEST_WORD:
                self.words[_class(w)].append((w, float(np.log(n / total))))

    def read(self, written: str) -> list[str]:
        key, step = _class(written), self.model.step
        # Of every place the states, each with its score, the place and state before it, and the letters read.
        states: list[dict[str, tuple[float, int, str, str]]] = [{} for _ in range(len(written) + 1)]
        states[0][_EDGE] = (0.0, 0, _EDGE, "")

        def reach(place: int, state: str, found: tuple[float, int, str, str]) -> None:
            old = states[place].get(state)
            if old is None or found[0] > old[0]:
                states[place][state] = found

        for i, c in enumerate(written):
            if i:  # a break after a word that is not in the list
                for last, (score, *_) in list(states[i].items()):
                    if last != _EDGE:
                        reach(i, _EDGE, (score + step(last, _EDGE), i, last, ""))
            letters = [(c, 0.0)] if c.isalpha() else [(x, -1.0) for x in LOOKS_LIKE.get(c, "")] or [(c, 0.0)]
            for last, (score, *_) in states[i].items():
                for x, cost in letters:
                    reach(i + 1, x, (score + cost + step(last, x) + (_UNKNOWN_WORD if last == _EDGE else 0.0), i, last, x))
            if _EDGE in states[i]:
                start = states[i][_EDGE][0]
                for j in range(i + 1, min(len(written), i + _LONGEST_WORD) + 1):
                    for word, likely in self.words.get(key[i:j], ()):
                        signs = sum(a != b for a, b in zip(written[i:j], word))
                        if all(a == b or b in LOOKS_LIKE.get(a, "") for a, b in zip(written[i:j], word)):
                            reach(j, _EDGE, (start + likely - signs, i, _EDGE, word))
        end = len(written)
        state = max(states[end], key=lambda x: (states[end][x][0] + (step(x, _EDGE) if x != _EDGE else 0.0), x))
        out, letters = [], ""
        while end or state != _EDGE:
            _, before, last, read = states[end][state]
            if last == _EDGE:
                out.append(read + letters)
                letters = ""
            else:
                letters = read + letters
            end, state = before, last
        return out[::-1]


class Reader:
    """Signs of words, each distinct word restored once."""

    def __init__(self, model: CharModel, wanted: frozenset[str] | None = None, likely: frozenset[str] | None = None):
        # A sign that asks for two words needs each of them.
        self.model, self.wanted = model, None if wanted is None else wanted | {s[:-1] for s in wanted if s.endswith("~~")}
        starts = [(n, frozenset(s[:-1] for s in self.wanted or () if len(s) == n + 1 and s.endswith("~"))) for n in PREFIXES]
        self.starts = [(n, s) for n, s in starts if s]
        self.known: dict[str, tuple[str, ...]] = {}
        # Signs that spaced characters may stand for: the wanted ones, where no others are named.
        self.spaced = Spaced(model, (wanted or frozenset()) if likely is None else likely)

    def _signs(self, word: str) -> tuple[str, ...]:
        # A word of letters only has nothing to trim, and is noisy where a letter is drawn out.
        plain = word.isalpha()
        core = word if plain else word.strip(_TRIM)
        if (_DRAWN if plain else _NOISY).search(core):
            core = self.model.restored(core)
        elif not plain:
            core = core.strip("@$!|(+")
        found = ()
        if core and self.wanted is None:
            found = (core, *(f"{core[:n]}~" for n in PREFIXES if len(core) >= n))
        elif core:
            if core in self.wanted:
                found = (core,)
            for n, starts in self.starts:
                if core[:n] in starts:
                    found += (f"{core[:n]}~",)
        if len(word) <= _KNOWN_LENGTH:
            if len(self.known) >= _KNOWN_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def signs(self, text: str) -> set[str]:
        text = text.lower()
        found: list[str] = []
        known = self.known.get
        words = set(text.split())
        for m in _SPACED.finditer(text):
            words.update(self.spaced.read("".join(m[0].split())))
        for w in words:
            s = known(w)
            found += self._signs(w) if s is None else s
        # A beginning that two different words share is a sign of its own.
        more = {s + "~" for s, n in Counter(found).items() if n > 1 and s.endswith("~")}
        return {*found, *more}


def _labelled(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str) -> DataFrame:
    """All labelled texts outside the held-out rows, one for each id."""
    usable = labels.where(~held_out(F.col(doc_id)) & F.col(label).isNotNull()).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    usable = written(usable.groupBy("id").agg(F.max("label").alias("label")), "toxic-labels")
    if usable.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        usable = F.broadcast(usable)
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    found = written(texts.join(usable, "id"), "toxic-texts")
    # Rows that repeat an id are few or none; only they are moved.
    again = written(found.groupBy("id").count().where("count > 1").select("id"), "toxic-repeated")
    if again.isEmpty():
        return found
    one = found.join(again, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return written(found.join(again, "id", "left_anti").unionByName(one), "toxic-texts-once")


def _char_model(texts: DataFrame) -> CharModel:
    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Words, and what they are more or less where spaced characters are taken out.
        words, apart = Counter(), Counter()

        def summed() -> pa.RecordBatch:
            pairs: Counter = Counter()
            for w, n in words.items():
                if w.isalpha():
                    for a, b in zip(_EDGE + w, w + _EDGE):
                        pairs[a + b] += n
            found = [w for c, other in ((words, ()), (apart, words)) for w in c if w not in other and w.isalpha() and len(w) <= _LONGEST_WORD]
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([False] * len(pairs) + [True] * len(found), pa.bool_()),
                    pa.array([*pairs, *found], pa.string()),
                    pa.array([*pairs.values(), *(words[w] + apart[w] for w in found)], pa.int64()),
                ],
                ["whole", "key", "n"],
            )
            words.clear()
            apart.clear()
            return out

        for part in in_parts(batches):
            for t in part.column(0).to_pylist():
                t = t.lower()
                found = t.split()
                words.update(found)
                rest = _SPACED.sub(" ", t)
                if rest != t:
                    apart.update(rest.split())
                    apart.subtract(found)
                if len(words) > _COUNTED:
                    yield summed()
        yield summed()

    # Pairs of letters: bounded by the alphabet, and cut to the usual ones, as words are.
    summed = texts.select("text").mapInArrow(count, "whole boolean, key string, n long").groupBy("whole", "key").agg(F.sum("n").alias("n"))
    summed = written(summed.where("n > 0"), "toxic-letters")
    pairs, words = (
        {r["key"]: r["n"] for r in summed.where(F.col("whole") == whole).orderBy(F.desc("n"), "key").limit(most).collect()}
        for whole, most in ((False, 20_000), (True, MOST_WORDS))
    )
    return CharModel(pairs, words)


def _possible(texts: DataFrame, model: CharModel) -> DataFrame:
    """``sign, bad, n`` of the signs that are right often enough, over all labelled texts."""

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        bad, n = Counter(), Counter()

        def summed() -> pa.RecordBatch:
            found = list(n)
            out = pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array([bad[s] for s in found], pa.int64()), pa.array([n[s] for s in found], pa.int64())], ["sign", "bad", "n"]
            )
            bad.clear()
            n.clear()
            return out

        for part in in_parts(batches):
            for t, y in zip(*(c.to_pylist() for c in part.columns)):
                found = reader.signs(t)
                n.update(found)
                if y:
                    for s in found:
                        bad[s] += y
                if len(n) > _COUNTED:
                    yield summed()
        yield summed()

    rows = texts.select("text", "label").mapInArrow(count, "sign string, bad long, n long")
    counts = rows.groupBy("sign").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    return written(counts.where((F.col("bad") >= LEAST_COVER) & (F.col("bad") >= LEAST_RIGHT * F.col("n"))), "toxic-possible")


def _sign_sets(texts: DataFrame, model: CharModel, possible: DataFrame) -> DataFrame:
    """``bad, signs, n``: the sets of possible signs that documents have, equal ones counted."""
    few = possible.limit(BROADCAST_SIGNS + 1).count() <= BROADCAST_SIGNS
    wanted = frozenset(r["sign"] for r in possible.select("sign").collect()) if few else None
    shared = texts.sparkSession.sparkContext.broadcast((model, wanted))

    @giving_back
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, wanted = shared.value
        reader = Reader(model, wanted, frozenset())
        for part in in_parts(batches):
            ids, signs, bad = [], [], []
            for i, t, y in zip(*(c.to_pylist() for c in part.columns)):
                found = reader.signs(t) if wanted is None else reader.signs(t) & wanted
                ids += [i] * len(found)
                signs += found
                bad += [bool(y)] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(signs, pa.string()), pa.array(bad, pa.bool_())], ["id", "sign", "bad"])

    kind = to_arrow_type(texts.schema["id"].dataType)
    rows = texts.select("id", "text", "label").mapInArrow(read, f"id {texts.schema['id'].dataType.simpleString()}, sign string, bad boolean")
    if not few:
        rows = rows.join(possible.select("sign"), "sign")
    sets = rows.groupBy("id", "bad").agg(F.sort_array(F.collect_list("sign")).alias("signs"))
    return written(sets.groupBy("bad", "signs").agg(F.count("*").alias("n")), "toxic-sets")


def _rank(sign: str, bad: int, good: int) -> tuple:
    """Whole words before beginnings, longer beginnings before shorter, where they cover as much."""
    return bad - 4 * good, not sign.endswith("~"), len(sign), sign


class _Digest:
    """Sets of signs with their documents, as arrays on the driver."""

    def __init__(self, sets: list):
        self.names = sorted({s for r in sets for s in r["signs"]})
        number = {s: i for i, s in enumerate(self.names)}
        size = np.array([len(r["signs"]) for r in sets], np.int64)
        self.owner = np.repeat(np.arange(len(sets)), size)
        self.sign = np.fromiter((number[s] for r in sets for s in r["signs"]), np.int64, int(size.sum()))
        self.n = np.array([r["n"] for r in sets], np.int64)
        self.is_bad = np.array([r["bad"] for r in sets], bool)
        by_sign = np.argsort(self.sign, kind="stable")
        self.sets_of = np.split(self.owner[by_sign], np.cumsum(np.bincount(self.sign, minlength=len(self.names)))[:-1]) if self.names else []
        first = np.concatenate(([0], np.cumsum(size)))
        self.signs_of = [self.sign[a:b] for a, b in zip(first, first[1:])]
        weights = lambda bad: np.bincount(self.sign, np.where(self.is_bad == bad, self.n, 0)[self.owner], len(self.names)).astype(np.int64)
        self.bad, self.good = weights(True), weights(False)
        self.open = np.ones(len(sets), bool)

    def best(self) -> str | None:
        """The sign that comes next, of those that still cover enough."""
        left = np.flatnonzero(self.bad >= LEAST_COVER)
        if not len(left):
            return None
        gain = self.bad[left] - 4 * self.good[left]
        return max((self.names[i] for i in left[gain == gain.max()]), key=lambda s: _rank(s, 0, 0))

    def counts(self, sign: str) -> tuple[int, int]:
        i = int(np.searchsorted(self.names, sign))
        return int(self.bad[i]), int(self.good[i])

    def take(self, sign: str) -> None:
        """The documents that the sign covers count no more."""
        for k in self.sets_of[int(np.searchsorted(self.names, sign))]:
            if self.open[k]:
                self.open[k] = False
                (self.bad if self.is_bad[k] else self.good)[self.signs_of[k]] -= self.n[k]


def _listed(signs: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(signs)), "array<string>")


def _digest(sets: DataFrame, ranked: DataFrame) -> tuple[_Digest, int]:
    """The sets cut to as many signs as the driver may see, and the most toxic documents that a sign left out has."""
    size = sets.agg(F.sum(F.size("signs"))).first()[0] or 0
    if size <= DIGEST:
        return _Digest(sets.collect()), -1
    most = ROUND_SIGNS
    while True:
        top = ranked.orderBy(F.desc("bad"), "sign").limit(most + 1).collect()
        kept = F.array_intersect("signs", _listed([r["sign"] for r in top[:most]]))
        cut = sets.select("bad", F.sort_array(kept).alias("signs"), "n").where(F.size("signs") > 0).groupBy("bad", "signs").agg(F.sum("n").alias("n"))
        cut = written(cut, "toxic-digest")
        if most <= 16 or cut.agg(F.sum(F.size("signs"))).first()[0] <= DIGEST:
            return _Digest(cut.collect()), top[most]["bad"] if len(top) > most else -1
        most //= 2


def _chosen(sets: DataFrame) -> tuple[list[str], int, int]:
    """The signs in the order of their choice, and the toxic and other documents that they cover."""
    chosen: list[str] = []
    covered = [0, 0]
    while True:
        side = lambda bad: F.sum(F.when(F.col("bad") == bad, F.col("n")).otherwise(0))
        ranked = sets.select("bad", "n", F.explode("signs").alias("sign")).groupBy("sign").agg(side(True).alias("bad"), side(False).alias("good")).where(F.col("bad") >= LEAST_COVER)
        digest, others = _digest(sets, ranked)
        taken: list[str] = []
        ended = False
        while not ended and len(chosen) < MOST_SIGNS:
            best, exact = digest.best(), others < 0
            if best is not None:
                bad, good = digest.counts(best)
                exact = exact or bad - 4 * good > others
            if not exact:
                if taken:
                    break
                # Nothing is sure from the digest alone: the first of all signs is.
                first = ranked.orderBy(F.desc(F.expr("bad - 4 * good")), F.endswith("sign", F.lit("~")), F.desc(F.length("sign")), F.desc("sign")).first()
                best, bad, good = (first["sign"], first["bad"], first["good"]) if first else (None, 0, 0)
            if best is None or bad < LEAST_COVER or bad < LEAST_RIGHT * (bad + good):
                ended = True
                break
            taken.append(best)
            chosen.append(best)
            covered = [covered[0] + bad, covered[1] + good]
            if not exact:
                break
            digest.take(best)
        if ended or others < 0 or len(chosen) >= MOST_SIGNS:
            return chosen, *covered
        sets = written(sets.where(~F.arrays_overlap("signs", _listed(taken))), "toxic-sets-left")


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> tuple[CharModel, dict[str, float], float]:
    """The character model, the signs with the chance that each is right, and the score without a sign.

    Every labelled text outside the held-out rows is counted.
    """
    texts = _labelled(docs, labels, text, doc_id, label)
    model = _char_model(texts)
    possible = _possible(texts, model)
    sets = _sign_sets(texts, model, possible)
    chosen, covered_bad, covered_good = _chosen(sets)
    side = lambda bad: F.sum(F.when(F.col("bad") == bad, F.col("n")).otherwise(0))
    found = sets.select("bad", "n", F.explode("signs").alias("sign")).where(F.array_contains(_listed(chosen), F.col("sign")))
    counts = {r["sign"]: (r["b"], r["g"]) for r in found.groupBy("sign").agg(side(True).alias("b"), side(False).alias("g")).collect()}
    signs = {s: (counts[s][0] + 0.5) / (sum(counts[s]) + 1) for s in chosen}
    totals = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    missed = totals.get(1, 0) - covered_bad
    rest = missed + totals.get(0, 0) - covered_good
    return model, signs, (missed + 0.5) / (rest + 1) if totals.get(1) else 0.0


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """The rows of ``docs`` with ``toxicity_score`` from 0 to 1; signs are learned outside the held-out rows."""
    small_batches(docs.sparkSession)
    model, signs, base = learn(docs, labels, text, doc_id, label)
    shared = docs.sparkSession.sparkContext.broadcast((model, signs, base))

    @F.arrow_udf("double")
    @giving_back
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, signs, base = shared.value
        reader = Reader(model, frozenset(signs))
        for texts in in_parts(batches):
            out = []
            for t in texts:
                wrong = 1.0 - base
                for s in sorted(reader.signs(t.as_py() or "") & signs.keys()):
                    wrong *= 1.0 - signs[s]
                out.append(1.0 - wrong)
            yield pa.array(out, pa.float64())

    return docs.withColumn("toxicity_score", score(F.col(f"`{text}`")))
