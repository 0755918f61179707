"""Toxicity by a support vector machine over a gap-weighted subsequence string kernel.

The kernel of two words counts common subsequences of three characters; an occurrence that spans n
characters weighs ``DECAY ** n``, so inserted characters and gaps only weaken a match. Words that mark
toxic sentences are found by how often they occur in labelled ones; some of them and some ordinary words
are the landmarks of a Nyström map, and a linear SVM is trained in the mapped space. Since the kernel is a
product of explicit subsequence weights, the trained machine folds into one weight per subsequence, and a
new word costs a few table look-ups. Pairs of neighbouring words are joined and treated as words, so that a
broken word or a phrase is one, too. A text is scored by its most toxic words and pairs; runs of single
characters and words with marks between their letters are read as one word. A logistic fit on labelled texts turns this into a probability.

Null texts count as empty; a text without words gets the base rate of such texts, under 0.5. Rows are
independent. With only one label present every text gets score 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import append_columns, array_rows, flat_rows, hashed_sample
from sievemark.session import cut_lineage

ALPHABET = 64
DECAY = 0.6
WIDTH = 24  # longer words are read in overlapping stretches
SPAN = WIDTH + 2  # a subsequence may span a whole stretch with its marks; only its weight falls
SAMPLE_TEXTS = 3000  # labelled texts per label
MARKERS, ORDINARY, HARD, LANDMARKS = 1500, 6000, 3000, 160
MAX_WORDS = 300_000  # words as they stand in texts that a task remembers
MAX_SIDES = 200_000  # words whose sides in pairs a task remembers, some 400 bytes each
PAIRS_AT_ONCE = 1_000_000
WORD = re.compile(r"\S+")
EDGES = re.compile(r"^[^\w]+|[^\w]+$")
SINGLES = re.compile(r"(?<!\S)(?:\w[^\w\s]? ){2,}\w(?!\S)")


def encode_words(words: list[str]) -> np.ndarray:
    """Characters as small numbers, with a start and an end mark; 0 fills up and matches nothing."""
    size = np.array([min(len(w), WIDTH) for w in words], dtype=np.int64)
    n = int(size.max(initial=1))
    chars = np.array(words, dtype=f"U{max(n, 1)}").view(np.uint32).reshape(len(words), -1).astype(np.int32)
    codes = np.where((chars >= 97) & (chars <= 122), chars - 96, 27 + chars % 35)
    codes[np.arange(codes.shape[1]) >= size[:, None]] = 0
    out = np.zeros((len(words), codes.shape[1] + 2), dtype=np.int32)
    out[:, 0], out[:, 1:-1] = 62, codes
    out[np.arange(len(words)), size + 1] = 63
    return out


def subsequences(codes: np.ndarray):
    """(index of the subsequence, or 0; weight) for every pair of offsets, as arrays over words and starts."""
    width = codes.shape[1]
    for a in range(1, width - 1):
        pair = (codes[:, : width - a] * ALPHABET + codes[:, a:]) * ALPHABET
        for b in range(a + 1, width):
            third = codes[:, b:]
            yield np.where(third > 0, pair[:, : width - b] + third, 0), DECAY ** (b + 1)


def norms(codes: np.ndarray) -> np.ndarray:
    """Length of each word's weight vector, as if no subsequence repeated."""
    n = np.arange(codes.shape[1] + 1)
    squares = sum((b - 1) * np.maximum(n - b, 0) * DECAY ** (2 * b + 2) for b in range(2, codes.shape[1]))
    return np.sqrt(np.maximum(squares * np.ones(len(n)), 1e-12))[(codes > 0).sum(1)]


def by_length(words: list[str]):
    """(positions, words) in groups of one length, so that none is filled up."""
    size = np.minimum(np.fromiter(map(len, words), np.int64, len(words)), WIDTH)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        for start in range(0, len(at), 4096):
            part = at[start : start + 4096]
            yield part, [words[i] for i in part]


class Landmarks:
    """Normalised weight vectors of the landmarks, over the subsequences that any of them has."""

    def __init__(self, words: list[str]):
        codes = encode_words(words)
        seen = np.zeros(ALPHABET**3, dtype=bool)
        for index, _ in subsequences(codes):
            seen[index] = True
        seen[0] = False
        self.columns = np.flatnonzero(seen)
        self.place = np.zeros(ALPHABET**3, dtype=np.int32)  # place 0: a subsequence that no landmark has
        self.place[self.columns] = np.arange(1, len(self.columns) + 1)
        self.vectors = np.zeros((len(self.columns) + 1, len(words)), dtype=np.float32)
        owner = np.arange(len(words))[:, None]
        for index, weight in subsequences(codes):
            np.add.at(self.vectors, (self.place[index], np.broadcast_to(owner, index.shape)), weight)
        self.vectors[0] = 0
        self.vectors /= norms(codes).astype(np.float32)

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel of words with the landmarks."""
        out = np.zeros((len(words), self.vectors.shape[1]), dtype=np.float32)
        for at, part in by_length(words):
            codes = encode_words(part)
            total = np.zeros((len(part), self.vectors.shape[1]), dtype=np.float32)
            for index, weight in subsequences(codes):
                place = self.place[index]
                for start in range(index.shape[1]):
                    total += np.float32(weight) * self.vectors[place[:, start]]
            out[at] = total / norms(codes)[:, None].astype(np.float32)
        return out

    def folded(self, coefficients: np.ndarray) -> np.ndarray:
        """One weight per subsequence."""
        out = np.zeros(ALPHABET**3, dtype=np.float32)
        out[self.columns] = (self.vectors @ coefficients)[1:]
        return out


def linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 1500, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by full-batch Adam."""
    theta = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, epochs + 1):
        slack = np.maximum(0, 1 - y * (x @ theta[:-1] + theta[-1]))
        g = -2 * weight * slack * y
        grad = np.concatenate([x.T @ g / len(y) + decay * theta[:-1], [g.mean()]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


@dataclass
class ToxicModel:
    weights: np.ndarray  # per subsequence
    bias: float
    scale: tuple[float, ...]  # logistic fit: intercept, best word, second best word, best pair of neighbours
    pairs: ToxicModel | None = None  # the machine for pairs

    def words(self, words: list[str]) -> np.ndarray:
        """Decision value of each word; a long word has that of its most toxic stretch."""
        parts, owner = [w[:WIDTH] for w in words], list(range(len(words)))
        for i in np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)) > WIDTH).tolist():
            for start in range(WIDTH // 2, len(words[i]) - WIDTH // 2, WIDTH // 2):
                parts.append(words[i][start : start + WIDTH])
                owner.append(i)
        value = np.zeros(len(parts))
        for at, part in by_length(parts):
            codes = encode_words(part).astype(np.intp)
            total = np.zeros(len(part), dtype=np.float32)
            width = codes.shape[1]  # all codes are above 0 here
            for a in range(1, width - 1):
                pair = (codes[:, : width - a] * ALPHABET + codes[:, a:]) * ALPHABET
                for b in range(a + 1, width):
                    total += np.float32(DECAY ** (b + 1)) * self.weights.take(pair[:, : width - b] + codes[:, b:]).sum(1)
            value[at] = total / norms(codes)
        out = np.full(len(words), -np.inf)
        np.maximum.at(out, owner, value + self.bias)
        return out


    def joined(self, words: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Decision value of each pair of words (given by their numbers) read as one, as :meth:`words` gives it.

        Each word is worked out once (:class:`Sides`).
        """
        out = np.empty(len(left))
        size = np.array([len(w) for w in words], dtype=np.int64)
        rest = np.flatnonzero(size[left] + size[right] > WIDTH)
        if len(rest):
            out[rest] = self.words([words[a] + words[b] for a, b in zip(left[rest].tolist(), right[rest].tolist())])
        at = np.flatnonzero(size[left] + size[right] <= WIDTH)
        if not len(at):
            return out
        used, numbers = np.unique(np.concatenate([left[at], right[at]]), return_inverse=True)
        sides = Sides(self)
        sides.add([words[i] for i in used.tolist()])
        out[at] = sides.values(numbers[: len(at)], numbers[len(at) :])
        return out

    def _one_side(self, codes: np.ndarray, table: np.ndarray, is_left: bool) -> tuple[np.ndarray, np.ndarray]:
        """Value of the subsequences within a word and its outer mark, and of its pairs by the missing character."""
        codes, width = codes.astype(np.intp), codes.shape[1]
        within = np.zeros(len(codes), np.float32)
        for a in range(1, width - 1):
            pair = (codes[:, : width - a] * ALPHABET + codes[:, a:]) * ALPHABET
            for b in range(a + 1, width):
                within += np.float32(DECAY ** (b + 1)) * self.weights.take(pair[:, : width - b] + codes[:, b:]).sum(1)
        missing = np.zeros((len(codes), table.shape[1]), np.float32)
        row = np.empty_like(missing)
        for i in range(width):
            for j in range(i + 1, width):
                np.take(table, codes[:, i] * ALPHABET + codes[:, j], axis=0, out=row, mode="clip")  # not buffered
                row *= np.float32(DECAY ** (width - 1 - i) if is_left else DECAY ** (j + 2))
                missing += row
        return within, missing


class Sides:
    """What words under ``WIDTH`` characters bring into pairs as the left and as the right one, by the word's place here.

    The weight of a subsequence depends on its span alone, so what crosses the border of a pair splits into a
    factor of either word.
    """

    def __init__(self, model: ToxicModel):
        self.model, self.count = model, 0
        # Columns of characters that no landmark has there are all zero and share place 0.
        self.table, self.third = self._narrow(model.weights.reshape(ALPHABET * ALPHABET, ALPHABET))
        self.turned, self.first = self._narrow(model.weights.reshape(ALPHABET, -1).T)  # by second and third character
        self.norms = norms(np.tri(WIDTH + 1, WIDTH + 2, 1, dtype=np.int32))  # by the characters of a pair
        self.size = np.zeros(0, np.int64)
        self.as_third, self.as_first = (np.zeros((0, WIDTH + 2), np.int8) for _ in range(2))  # places of the characters
        self.inner_left, self.inner_right, self.most_ahead, self.most_behind = (np.zeros(0, np.float32) for _ in range(4))
        self.ahead, self.behind = (np.zeros((0, t.shape[1]), np.float32) for t in (self.table, self.turned))

    @staticmethod
    def _narrow(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(table.any(0))
        place = np.zeros(ALPHABET, np.int8)
        place[used] = np.arange(1, len(used) + 1)
        return np.ascontiguousarray(np.hstack([np.zeros((len(table), 1), np.float32), table[:, used]])), place

    def add(self, words: list[str]) -> None:
        first, self.count = self.count, self.count + len(words)
        if self.count > len(self.size):
            room = max(self.count, len(self.size) * 3 // 2) - len(self.size)
            for name in ("size", "as_third", "as_first", "inner_left", "inner_right", "most_ahead", "most_behind", "ahead", "behind"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros((room, *old.shape[1:]), old.dtype)]))
        self.size[first : self.count] = [len(w) for w in words]
        for group, part in by_length(words):
            codes, group = encode_words(part), group + first
            self.as_third[group, : codes.shape[1]] = self.third[codes]
            self.as_first[group, : codes.shape[1]] = self.first[codes]
            for start in range(0, len(part), 512):  # small enough to stay in the cache
                some, rows = codes[start : start + 512], group[start : start + 512]
                self.inner_left[rows], self.ahead[rows] = self.model._one_side(some[:, :-1], self.table, True)
                self.inner_right[rows], self.behind[rows] = self.model._one_side(some[:, 1:], self.turned, False)
        new = slice(first, self.count)
        self.most_ahead[new] = np.maximum(self.ahead[new].max(1, initial=0), 0)
        self.most_behind[new] = np.maximum(self.behind[new].max(1, initial=0), 0)

    def most(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """No less than :meth:`values`: the first crossing character of either word as it is, the others at their most."""
        n, m = self.size[left], self.size[right]
        total = self.inner_left[left] + self.inner_right[right]
        total += np.float32(DECAY**2) * self.ahead[left, self.as_third[right, 1]] + self.behind[right, self.as_first[left, n]]
        total += np.float32(DECAY**3 / (1 - DECAY)) * self.most_ahead[left] + np.float32(DECAY / (1 - DECAY)) * self.most_behind[right]
        return (total + 1e-3 + 1e-4 * np.abs(total)) / self.norms[n + m] + self.model.bias

    def values(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Decision value of each pair; a pair costs one lookup per character."""
        total = (self.inner_left[left] + self.inner_right[right]).astype(np.float32)
        n, m = self.size[left], self.size[right]
        for q in range(int(m.max(initial=-1)) + 1):  # characters of the right word and its end mark
            have = np.flatnonzero(q <= m)
            total[have] += np.float32(DECAY ** (q + 2)) * self.ahead[left[have], self.as_third[right[have], q + 1]]
        for back in range(int(n.max(initial=-1)) + 1):  # characters of the left word from its last one, and its start mark
            have = np.flatnonzero(back <= n)
            total[have] += np.float32(DECAY**back) * self.behind[right[have], self.as_first[left[have], n[have] - back]]
        return total / self.norms[n + m] + self.model.bias


NOTHING = -3.0  # decision value where a text has no word


def _bare(word: str) -> str:
    return "".join(c for c in word if c.isalnum())


def word_forms(token: str) -> tuple[str, str]:
    """A token without outer marks, and without any marks if it has some inside."""
    if token.isalpha():
        return token, ""
    word = EDGES.sub("", token)
    return word, "" if word.isalnum() else _bare(word)


def split_words(text: str | None) -> tuple[set[str], list[str]]:
    """Distinct words in small letters without outer marks, and all of them in the order of the text.

    Runs of single characters are also one word, and words with marks inside are also read without these.
    """
    if not text:
        return set(), []
    low = text.lower()
    both = [word_forms(w) for w in low.split()]
    tokens = [w for w, _ in both if w]
    words = set(tokens).union([b for _, b in both], map(_bare, SINGLES.findall(low)))
    words.discard("")
    return words, tokens


class _Numbers(dict):
    """Numbers keys as they come."""

    def __missing__(self, key) -> int:
        n = self[key] = len(self)
        return n


class KnownWords:
    """Words by number, with their value and their sides in pairs once these were asked for."""

    def __init__(self, model: ToxicModel):
        self.model, self.numbers, self.sides = model, _Numbers(), Sides(model.pairs or model)
        self.value, self.place = np.full(0, np.nan), np.full(0, -1)

    def _words(self, which: np.ndarray) -> list[str]:
        words = list(self.numbers)
        return [words[i] for i in which.tolist()]

    def _grow(self) -> None:
        if (room := len(self.numbers) - len(self.value)) > 0:
            self.value = np.concatenate([self.value, np.full(room, np.nan)])
            self.place = np.concatenate([self.place, np.full(room, -1)])

    def values(self, numbers: np.ndarray) -> np.ndarray:
        """Decision values of words."""
        self._grow()
        new = np.unique(numbers[np.isnan(self.value[numbers])])
        words = self._words(new)
        for start in range(0, len(words), 20_000):
            self.value[new[start : start + 20_000]] = self.model.words(words[start : start + 20_000])
        return self.value[numbers]

    def best_pairs(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The highest value of a pair of neighbouring words of each text, or ``NOTHING`` where that is more.

        Each distinct pair is valued once, and only if it may be the highest one of a text: the pair with the
        largest upper bound comes first, and pairs whose bound is not over its value need none.
        """
        best = np.full(len(sizes), NOTHING)
        text = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.flatnonzero(text[:-1] == text[1:])  # no pair goes from one text to the next
        if not len(inside):
            return best
        self._grow()
        text = text[inside]
        distinct, which = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
        left, right = distinct >> 32, distinct & 0xFFFFFFFF
        used, numbers = np.unique(np.concatenate([left, right]), return_inverse=True)
        words = self._words(used)
        length = np.array([len(w) for w in words], dtype=np.int64)
        near, far = numbers[: len(left)], numbers[len(left) :]
        short = np.flatnonzero(length[near] + length[far] <= WIDTH)
        values, most = np.full(len(distinct), -np.inf), np.full(len(distinct), -np.inf)
        long = np.flatnonzero(length[near] + length[far] > WIDTH)
        if len(long):
            values[long] = self.sides.model.words([words[a] + words[b] for a, b in zip(near[long].tolist(), far[long].tolist())])
        asked = np.zeros(len(used), bool)
        asked[near[short]] = asked[far[short]] = True
        new = np.flatnonzero(asked & (self.place[used] < 0))
        self.place[used[new]] = np.arange(self.sides.count, self.sides.count + len(new))
        self.sides.add([words[i] for i in new.tolist()])
        near, far = self.place[left], self.place[right]

        def settle(pairs: np.ndarray) -> None:
            for low in range(0, len(pairs), PAIRS_AT_ONCE):
                part = pairs[low : low + PAIRS_AT_ONCE]
                values[part] = self.sides.values(near[part], far[part])
                most[part] = -np.inf

        for low in range(0, len(short), PAIRS_AT_ONCE):
            part = short[low : low + PAIRS_AT_ONCE]
            most[part] = self.sides.most(near[part], far[part])
        top, bound = np.full(len(sizes), -np.inf), most[which]
        np.maximum.at(top, text, bound)
        settle(np.unique(which[(bound == top[text]) & (bound > NOTHING)]))
        np.maximum.at(best, text, values[which])
        settle(np.unique(which[most[which] > best[text]]))
        np.maximum.at(best, text, values[which])
        return best


def word_values(model: ToxicModel):
    """Function from texts to their two highest word values and the highest one of a pair of neighbours.

    Remembers words, forgets all when too many.
    """
    known, forms = KnownWords(model), _Numbers()  # forms: as they stand in a text, each with up to two words
    first, second = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def run(texts: list[str | None]) -> list[tuple[float, float, float]]:
        nonlocal known, forms, first, second
        if len(forms) > MAX_WORDS or known.sides.count > MAX_SIDES:
            known, forms, first, second = KnownWords(model), _Numbers(), first[:0], second[:0]
        number, before = known.numbers.__getitem__, len(forms)
        low = [t.lower() if t else "" for t in texts]
        parts = [t.split() for t in low]
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        flat = np.fromiter(map(forms.__getitem__, chain.from_iterable(parts)), np.int64, int(sizes.sum()))
        new = [word_forms(w) for w in islice(forms, before, None)]
        first = np.concatenate([first, np.array([number(w) if w else -1 for w, _ in new], dtype=np.int64)])
        second = np.concatenate([second, np.array([number(w) if w else -1 for _, w in new], dtype=np.int64)])
        owner = np.repeat(np.arange(len(texts)), sizes)
        tokens, bare = first[flat], second[flat]
        singles = [(i, number(w)) for i, t in enumerate(low) for m in SINGLES.findall(t) if (w := _bare(m))]
        spelled = np.array(singles, dtype=np.int64).reshape(-1, 2)
        text = np.concatenate([owner[tokens >= 0], owner[bare >= 0], spelled[:, 0]])
        word = np.concatenate([tokens[tokens >= 0], bare[bare >= 0], spelled[:, 1]])
        value = known.values(word)
        one, two = np.full(len(texts), NOTHING), np.full(len(texts), NOTHING)
        np.maximum.at(one, text, value)
        at = np.flatnonzero(value == one[text])
        winner = np.full(len(texts), -1)
        winner[text[at]] = word[at]
        rest = np.flatnonzero(word != winner[text])
        np.maximum.at(two, text[rest], value[rest])
        pair = known.best_pairs(tokens[tokens >= 0], np.bincount(owner[tokens >= 0], minlength=len(texts)))
        return list(zip(one.tolist(), two.tolist(), pair.tolist()))

    return run


def _best_pairs(model: ToxicModel, texts: list[list[str]]) -> list[float]:
    """The highest value of a pair of neighbouring words of each text."""
    known = KnownWords(model)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.fromiter(map(known.numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    return known.best_pairs(flat, sizes).tolist()


def fit_toxicity(labelled: DataFrame, text: str = "text", toxic: str = "toxic", per_label: int = SAMPLE_TEXTS, prior: dict | None = None) -> ToxicModel:
    """Trains on at most about ``per_label`` distinct texts of each label (0 and 1).

    ``prior`` has the rows of each label, counted here if not given.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(toxic).cast("int").alias("_y"), F.col(text).alias("_text")).filter(F.col("_y").isin(0, 1))
    sample = hashed_sample(rows, "_y", "_text", per_label).cache()

    def make():
        def run(labels, texts):
            for y, t in zip(labels, texts):
                words, tokens = split_words(t)
                for w in words:
                    yield w, False, y
                for w in set(map(str.__add__, tokens, tokens[1:])):
                    yield w, True, y

        return run

    share = prior or {r[0]: r[1] for r in rows.filter("_text is not null").groupBy("_y").count().collect()}
    used = {r[0]: r[1] for r in sample.groupBy("_y").count().collect()}
    if len(used) < 2:
        sample.unpersist()
        return ToxicModel(np.zeros(ALPHABET**3, np.float32), 0.0, (-50.0, 0.0, 0.0, 0.0))
    words = flat_rows(sample, ["_y", "_text"], "w string, pair boolean, y int", make).groupBy("w", "pair").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    # Share of toxic texts among those with the word, counted evenly for both labels and drawn to one half.
    lift = (F.col("bad") / used[1]) / (F.col("bad") / used[1] + (F.col("good") + 1) / used[0])
    seen = cut_lineage(words.withColumn("lift", lift))
    signs, hits, plain = _examples(seen.filter("not pair"))
    model = _train_twice(seen.filter("not pair"), signs, hits, plain)
    # The machine for pairs also knows the words: a pair may be a broken word.
    more = _examples(seen.filter("pair"))
    model.pairs = _train_twice(seen.filter("pair"), signs + more[0], hits + more[1], plain + more[2])
    shared = spark.sparkContext.broadcast(model)

    def make_values():
        values = word_values(shared.value)

        def run(labels, texts):
            for y, v in zip(labels, values(texts)):
                yield y, *v

        return run

    scored = np.array(flat_rows(sample, ["_y", "_text"], "y int, a double, b double, c double", make_values).collect(), dtype=float)
    sample.unpersist()
    weight = np.where(scored[:, 0] == 1, share[1] / used[1], share[0] / used[0])
    model.scale = _logistic(scored[:, 1:], scored[:, 0], weight / weight.mean())
    return model


def _examples(seen: DataFrame) -> tuple[list[str], list[float], list[str]]:
    """Words that mark toxic texts, how many of these have them, and ordinary words."""
    markers = seen.filter((F.col("bad") >= 4) & (F.col("lift") > 0.75)).orderBy(F.desc(F.col("bad") * F.col("lift")), "w").limit(MARKERS).select("w", "bad").collect()
    plain = seen.filter((F.col("good") >= 2) & (F.col("lift") < 0.65)).orderBy(F.xxhash64("w")).limit(ORDINARY).select("w").collect()
    return [r[0] for r in markers], [float(r[1]) for r in markers], [r[0] for r in plain]


def _train_twice(seen: DataFrame, signs: list[str], hits: list[float], plain: list[str]) -> ToxicModel:
    """Ordinary words that the first machine takes for toxic ones train the second, too."""
    first = _train(signs, hits, plain)
    hard = _most_toxic(seen.filter((F.col("good") >= 2) & (F.col("lift") < 0.6)), first).limit(HARD).select("w").collect()
    return _train(signs, hits, list(dict.fromkeys([r[0] for r in hard] + plain)))


def _most_toxic(words: DataFrame, model: ToxicModel) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(model)

    def make():
        def run(found):
            return [found, shared.value.words(found)] if found else [[], []]

        return run

    return array_rows(words, ["w"], "w string, value double", make).orderBy(F.desc("value"), "w")


def _train(markers: list[str], hits: list[float], plain: list[str]) -> ToxicModel:
    if not markers or not plain:
        return ToxicModel(np.zeros(ALPHABET**3, np.float32), 0.0, (0.0, 0.0, 0.0, 0.0))
    # Landmarks: the most frequent marker words, and ordinary words for contrast.
    step = max(1, len(markers) // (LANDMARKS // 2))
    every = max(1, len(plain) // (LANDMARKS // 2))
    chosen = list(dict.fromkeys(markers[: LANDMARKS // 4] + markers[::step] + plain[::every]))[: LANDMARKS + LANDMARKS // 2]
    landmarks = Landmarks(chosen)
    values, basis = np.linalg.eigh((landmarks.vectors.T @ landmarks.vectors).astype(float))
    kept = values > 1e-4 * values[-1]
    root = basis[:, kept] / np.sqrt(values[kept])  # Nyström: k(x) @ root are the mapped coordinates
    x = landmarks.kernel(markers + plain) @ root
    y = np.concatenate([np.ones(len(markers)), -np.ones(len(plain))])
    w = np.concatenate([hits, np.ones(len(plain))])
    for label in (1, -1):
        w[y == label] /= w[y == label].mean()
    v, bias = linear_svm(x, y, w)
    return ToxicModel(landmarks.folded(root @ v), bias, (0.0, 1.0, 0.0, 0.0))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 3000) -> tuple[float, ...]:
    x = np.hstack([np.ones((len(x), 1)), x])
    theta, m, v = np.zeros((3, x.shape[1]))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -35, 35)))
        grad = x.T @ (weight * (p - y)) / len(y) + 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return tuple(theta.tolist())


def score_toxicity(df: DataFrame, model: ToxicModel, text: str = "text") -> DataFrame:
    """The rows with score (0 to 1) and predicted (1 from 0.5 on)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # one weight per subsequence: 1 MB

    def make():
        m = shared.value
        values, scale = word_values(m), np.array(m.scale)

        def run(texts):
            scores = [1 / (1 + float(np.exp(-np.clip(scale[0] + scale[1:] @ v, -35, 35)))) for v in values(texts)]
            return [scores, [int(s >= 0.5) for s in scores]]

        return run

    return append_columns(df, [text], "score double, predicted int", make)
