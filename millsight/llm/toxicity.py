"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

The kernel of two strings sums, over all three-character subsequences, the product of their weights
DECAY ** span, and is normalised (word ends count as characters); so an insult with gaps or inserted characters stays close to the
insult. Strings are the words of sentences; runs of single characters are read as one string, long
words in overlapping windows of ``WIDTH`` characters, and nothing of a text is left out.

Labels are of whole texts. Training follows the multiple-instance view: words that occur in toxic
sentences far more often than in clean ones, in texts that are no copies of each other, are the positive
instances, frequent words of clean sentences the negative ones. Landmarks are taken from both; the Nyström map turns kernel values into
features for a linear SVM (squared hinge, solved by Newton steps). Positive words train along with
variants that have one or two characters put in. Every word is scored by the kernel itself: there is
no filter before it. A text is judged as the bag of its sentences' strings: by the two highest values and
the share of strings on the toxic side, so that one chance likeness in a long text does not mark it, or by
the highest value alone where that is beyond doubt. Logistic curves fitted on training texts give 0 to 1.

Word counts cover all labelled training texts and are made in Spark; what the driver gathers is bounded
by ``MOST_POSITIVE``, ``MOST_NEGATIVE`` and ``MOST_TEXTS`` (parameters of ``train``). Scoring is one pass.

Defined results: a null or empty text has no word and scores as the model's lowest value; without
labelled rows of both kinds every text scores the share of toxic labels (0 without any); repeated label
rows of a document count once, toxic if one of them is; equal rows score alike.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsight.llm.common import counted_broadcast, plain_text, written

DECAY = 0.8
WIDTH = 16
STRIDE = 7
#: What marks the ends of a word among its characters; no word holds white space.
FIRST, LAST = "\t", "\n"
#: Subsequence numbers below this are looked up in a table, larger ones in a sorted array.
MOST_INDEXED = 1 << 22
POWER = 2
LANDMARKS = 160
MOST_ALIKE = 0.85
#: Variants of a positive word with one and with two inserted characters that train the classes, those
#: that set the curve, and their share of the word's weight.
GAPPED = 4
GAPPED_ASIDE = 4
GAPPED_WEIGHT = 0.25
HARD_ROUNDS = 1
MOST_POSITIVE = 1500
MOST_NEGATIVE = 4500
MOST_TEXTS = 2000
MOST_CACHED = 400_000
LOWEST_SCORE, HIGHEST_SCORE = -3.0, 6.0
#: Weight of the set-aside variants, as a share of the toxic texts' weight, when the curve of the highest
#: value is fitted.
ASIDE_WEIGHT = 1.0

_MARKS = re.compile(r"[^\w\s]|_")
_SINGLES = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")


def strings_of(text: str) -> set[str]:
    """Words in lower case without punctuation, and runs of three or more single characters joined."""
    lowered = _MARKS.sub("", text.lower())
    words = set(lowered.split())
    if any(len(w) == 1 for w in words):
        words.update("".join(run.split()) for run in _SINGLES.findall(lowered))
    return words


def windows_of(word: str) -> Iterator[str]:
    """The word between its end marks, or overlapping windows that cover it."""
    word = f"{FIRST}{word}{LAST}"
    if len(word) <= WIDTH:
        yield word
        return
    for at in range(0, len(word) - WIDTH + STRIDE, STRIDE):
        yield word[at : at + WIDTH]


@dataclass
class Alphabet:
    """Codes from 1 for all characters of the training words; any other character gets a code behind
    them, so it matches itself in a word's own norm and nothing in a landmark."""

    codes: dict[str, int]

    @classmethod
    def of(cls, words: Sequence[str]) -> Alphabet:
        return cls({c: i for i, c in enumerate(sorted(set().union(*words)), 1)})

    def encode(self, words: Sequence[str], width: int) -> np.ndarray:
        """One row per word; 0 behind its end."""
        if not len(words):
            return np.zeros((0, width), np.int32)
        points = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)
        known = np.array([ord(c) for c in self.codes], np.uint32)
        table = np.zeros(int(known.max(initial=0)) + 2, np.int32)
        table[known] = list(self.codes.values())
        found = table[np.minimum(points, len(table) - 1)]
        other = (found == 0) & (points > 0)
        return np.where(other, len(self.codes) + points.astype(np.int32), found)


def _triples(letters: np.ndarray, base: int) -> Iterator[tuple[np.ndarray, float]]:
    """For each place (i, j, k): subsequence numbers and weight; ``letters`` are below ``base``."""
    columns = np.ascontiguousarray(letters.T, np.int64)
    for i in range(len(columns) - 2):
        for j in range(i + 1, len(columns) - 1):
            pair = (columns[i] * base + columns[j]) * base
            for k in range(j + 1, len(columns)):
                yield pair + columns[k], DECAY ** (k - i + 1)


def _norms(codes: np.ndarray) -> np.ndarray:
    """The kernel of each word with itself, by the subsequence recurrence, as a square root."""
    n, width = codes.shape
    columns = np.ascontiguousarray(codes.T)
    step = DECAY * DECAY
    same = [[(a == b) & (a > 0) for b in columns] for a in columns]
    prefix = np.ones((width + 1, width + 1, n))
    for _ in range(2):
        inner = np.zeros((width + 1, width + 1, n))
        for s in range(1, width + 1):
            row = np.zeros(n)
            for t in range(1, width + 1):
                row = DECAY * row + step * same[s - 1][t - 1] * prefix[s - 1, t - 1]
                inner[s, t] = DECAY * inner[s - 1, t] + row
        prefix = inner
    total = np.zeros(n)
    for s in range(width):
        for t in range(width):
            total += step * same[s][t] * prefix[s, t]
    return np.sqrt(total)


@dataclass
class Landmarks:
    """Feature vectors of the landmarks, of length one: ``rows[i + 1]`` has all of them for the
    subsequence ``numbers[i]``, written in the landmarks' own ``letters`` (by code, 0 if not theirs)."""

    letters: np.ndarray
    base: int
    numbers: np.ndarray
    rows: np.ndarray
    index: np.ndarray | None = None

    @classmethod
    def of(cls, codes: np.ndarray) -> Landmarks:
        norms = np.maximum(_norms(codes), 1e-12)
        used = np.unique(codes[codes > 0])
        letters = np.zeros(int(used.max(initial=0)) + 2, np.int64)
        letters[used] = np.arange(1, len(used) + 1)
        base = len(used) + 1
        found: dict[int, np.ndarray] = {}
        for row, word in enumerate(letters[codes]):
            for numbers, weight in _triples(word[word > 0][None, :], base):
                held = found.setdefault(int(numbers[0]), np.zeros(len(codes), np.float32))
                held[row] += weight / norms[row]
        order = sorted(found)
        rows = np.stack([np.zeros(len(codes), np.float32), *(found[n] for n in order)])
        marks = cls(letters, base, np.array(order, np.int64), rows)
        if base**3 <= MOST_INDEXED:
            marks.index = np.zeros(base**3, np.int32)
            marks.index[marks.numbers] = np.arange(1, len(order) + 1)
        return marks

    def _found(self, numbers: np.ndarray) -> np.ndarray:
        """Rows of subsequences, 0 for those no landmark has."""
        if self.index is not None:
            return self.index[numbers]
        if not len(self.numbers):
            return np.zeros(len(numbers), np.int64)
        at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
        return np.where(self.numbers[at] == numbers, at + 1, 0)

    def kernel(self, codes: np.ndarray) -> np.ndarray:
        """The normalised kernel of each word with each landmark."""
        total = np.zeros((len(codes), self.rows.shape[1]), np.float32)
        letters = self.letters[np.minimum(codes, len(self.letters) - 1)]
        for start in range(0, len(codes), 2048):
            found, weights = [], []
            for numbers, weight in _triples(letters[start : start + 2048], self.base):
                found.append(self._found(numbers))
                weights.append(weight)
            if not found:
                continue
            weights = np.array(weights, np.float32)
            for row, places in enumerate(np.ascontiguousarray(np.stack(found).T), start):
                some = places.nonzero()[0]
                total[row] = weights[some] @ self.rows[places[some]]
        return total / np.maximum(_norms(codes), 1e-12)[:, None]


@dataclass
class Model:
    """A word's value is bias + the powered kernel with each landmark times its weight."""

    alphabet: Alphabet
    landmarks: Landmarks | None
    weights: np.ndarray
    bias: float
    curve: np.ndarray
    alone: np.ndarray
    constant: float | None = None
    cache: dict[str, float] = field(default_factory=dict, repr=False)

    def word_values(self, words: Sequence[str]) -> np.ndarray:
        """Values of windows of at most ``WIDTH`` characters."""
        values = np.full(len(words), self.bias)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for length in range(3, WIDTH + 1):
            for part in np.array_split(np.flatnonzero(lengths == length), 1 + len(words) // 8_000):
                if len(part):
                    codes = self.alphabet.encode([words[i] for i in part], length)
                    values[part] += (self.landmarks.kernel(codes) ** POWER) @ self.weights
        return values

    def bags(self, texts: Sequence[str]) -> np.ndarray:
        """What each text, as a bag of strings, is judged by: the two highest values of its strings and
        the logarithm of the share of strings on the toxic side."""
        cache = self.cache
        if len(cache) > MOST_CACHED:
            cache.clear()
        sets = [strings_of(t) for t in texts]
        fresh = [w for w in set().union(*sets) if w not in cache] if sets else []
        parts = [(w, f"{FIRST}{w}{LAST}") for w in fresh if len(w) <= WIDTH - 2]
        parts += [(w, p) for w in fresh if len(w) > WIDTH - 2 for p in windows_of(w)]
        values = self.word_values([p for _, p in parts])
        for word in fresh:
            cache[word] = -np.inf
        for (word, _), value in zip(parts, values.tolist(), strict=True):
            if value > cache[word]:
                cache[word] = value
        found = np.full((len(texts), 3), LOWEST_SCORE)
        for row, strings in enumerate(sets):
            held = sorted(map(cache.__getitem__, strings))
            found[row, : len(held[-2:])] = held[-2:][::-1]
            toxic = len(held) - bisect_right(held, 0.0)
            found[row, 2] = math.log((toxic + 0.3) / (len(held) + 30))
        found[:, :2] = np.clip(found[:, :2], LOWEST_SCORE, HIGHEST_SCORE)
        return found

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        bags = self.bags(texts)
        found = np.maximum(bags @ self.curve[:-1] + self.curve[-1], bags[:, :1] @ self.alone[:-1] + self.alone[-1])
        return 1 / (1 + np.exp(-np.clip(found, -40, 40)))


def gapped(word: str, letters: Sequence[str], draws: Sequence[int]) -> Iterator[str]:
    """Per draw the word with one and with two inserted characters, drawn by hash."""
    for inserted in (1, 2):
        for draw in draws:
            found = word
            for step in range(inserted):
                value = zlib.crc32(f"{word} {inserted} {draw} {step}".encode())
                at = 1 + value % max(len(found) - 1, 1)
                found = found[:at] + letters[(value >> 8) % len(letters)] + found[at:]
            if len(found) <= WIDTH - 2:
                yield found


def _svm(features: np.ndarray, signs: np.ndarray, weights: np.ndarray, cost: float) -> np.ndarray:
    """Linear SVM with squared hinge loss; the last weight is the bias."""
    rows = np.hstack([features, np.ones((len(features), 1))])
    keep = np.eye(rows.shape[1])
    keep[-1, -1] = 1e-3
    found = np.zeros(rows.shape[1])

    def loss(point: np.ndarray) -> float:
        short = np.maximum(0, 1 - signs * (rows @ point))
        return float(point @ keep @ point / 2 + cost * (weights * short * short).sum())

    least = loss(found)
    for _ in range(100):
        active = signs * (rows @ found) < 1
        part = rows[active] * (2 * cost * weights[active])[:, None]
        step = np.linalg.solve(keep + part.T @ rows[active], part.T @ signs[active]) - found
        length, now = 1.0, loss(found + step)
        while now > least and length > 1e-6:  # the active set may change on the way
            length /= 2
            now = loss(found + length * step)
        if now > least - 1e-9 * abs(least):
            break
        found, least = found + length * step, now
    return found


def _logistic(bags: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A logistic curve, none of its factors negative, by Newton steps with a little shrinkage; the last
    number is the shift."""
    weights = weights * (len(labels) / weights.sum())
    used = list(range(bags.shape[1]))
    while True:
        rows = np.hstack([bags[:, used], np.ones((len(bags), 1))])
        shrink = 0.05 * np.eye(len(used) + 1)
        shrink[-1, -1] = 1e-6
        found = np.zeros(len(used) + 1)
        for _ in range(200):
            chance = 1 / (1 + np.exp(-np.clip(rows @ found, -40, 40)))
            slope = rows.T @ (weights * (chance - labels)) + shrink @ found
            bend = (rows * (weights * chance * (1 - chance))[:, None]).T @ rows + shrink
            step = np.clip(np.linalg.solve(bend, slope), -2, 2)
            found = found - step
            if np.abs(step).max() < 1e-8:
                break
        wrong = [i for i, factor in zip(used, found[:-1], strict=True) if factor < 0]
        if not wrong or len(used) == 1:
            break
        used = [i for i in used if i not in wrong] or [0]
    curve = np.zeros(bags.shape[1] + 1)
    curve[used], curve[-1] = np.maximum(found[:-1], 1e-3), found[-1]
    return curve


def fit(
    positive: Sequence[tuple[str, float]],
    negative: Sequence[tuple[str, float]],
    texts: Sequence[str],
    labels: np.ndarray,
    landmarks: int = LANDMARKS,
    cost: float = 3.0,
    share: float | None = None,
) -> Model:
    """A model from weighted positive and negative words and a sample of labelled texts.

    ``share`` is that of toxic texts among all labelled ones, where the sample has another one.
    """
    share = float(np.mean(labels)) if share is None else share
    strongest = max((w for _, w in positive), default=0.0)
    letters = sorted(set().union(*(w for w, _ in [*positive, *negative])))
    known = {w for w, _ in [*positive, *negative]}
    plain, positive = positive, list(positive)
    for word, weight in plain:
        for variant in gapped(word, letters, range(GAPPED)):
            if variant not in known:
                known.add(variant)
                positive.append((variant, GAPPED_WEIGHT * weight))
    words = [FIRST + w + LAST for w, _ in [*positive, *negative]]
    signs = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    weights = np.array([w for _, w in positive] + [w for _, w in negative])
    alphabet = Alphabet.of(words)
    codes = alphabet.encode(words, WIDTH)
    first = np.flatnonzero(signs > 0)[: 2 * landmarks]
    chosen: list[int] = []
    for side, most in ((first, 2 * landmarks // 3), (np.flatnonzero(signs < 0), landmarks)):
        side = side[: 2 * landmarks]
        alike = Landmarks.of(codes[side]).kernel(codes[side])
        mine: list[int] = []
        for i in range(len(side)):
            if len(chosen) + len(mine) < most and not (alike[i, mine] >= MOST_ALIKE).any():
                mine.append(i)
        chosen += side[mine].tolist()
    marks = Landmarks.of(codes[chosen])
    kernel = marks.kernel(codes).astype(float) ** POWER
    inner = kernel[chosen]
    values, basis = np.linalg.eigh((inner + inner.T) / 2)
    root = basis / np.sqrt(np.maximum(values, 2e-2))
    for side in (1, -1):
        mine = signs == side
        weights[mine] /= weights[mine].sum()
    found = _svm(kernel @ root, signs, weights * len(words) / 2, cost)
    model = Model(alphabet, marks, root @ found[:-1], float(found[-1]), np.zeros(4), np.zeros(2))
    # Other variants of the strong words stand for texts whose insults have letters put in.
    aside = range(GAPPED, GAPPED + GAPPED_ASIDE)
    strong = [w for w, weight in plain if 2 * weight >= strongest]
    unseen = [v for w in strong for v in gapped(w, letters, aside) if v not in known]
    bags, aside_bags = model.bags(texts), model.bags(unseen) if unseen else np.empty((0, 3))
    own = np.where(labels == 1, share / max(labels.sum(), 1.0), (1 - share) / max((1 - labels).sum(), 1.0))
    model.curve = _logistic(bags, labels, own)
    part = ASIDE_WEIGHT * share / max(len(unseen), 1)
    model.alone = _logistic(
        np.concatenate([bags, aside_bags])[:, :1],
        np.concatenate([labels, np.ones(len(unseen))]),
        np.concatenate([own, np.full(len(unseen), part)]),
    )
    return model


def train(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most_positive: int = MOST_POSITIVE,
    most_negative: int = MOST_NEGATIVE,
    most_texts: int = MOST_TEXTS,
) -> Model:
    """Fits on all labelled documents; at most ``most_*`` words and texts come to the driver."""
    known = labels.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    known = known.filter("_label IS NOT NULL")
    known = counted_broadcast(written(known, "toxic-labels"))
    rows = documents.join(known, F.col(doc_id) == F.col("_id"))
    rows = written(rows.select(plain_text(text).alias("_text"), "_label"), "toxic-training")
    counts = dict(rows.groupBy("_label").count().collect())
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        share = toxic / max(toxic + clean, 1)
        return Model(Alphabet({}), None, np.zeros(1), 0.0, np.zeros(4), np.zeros(2), constant=float(share))

    plain = F.regexp_replace(F.lower("_text"), r"(?U)[^\w\s]|_", "")
    words = rows.select("_label", F.split(plain, r"(?U)\s+").alias("words"))
    seen = words.select("_label", F.explode(F.array_distinct("words")).alias("word"))
    seen = seen.filter(F.length("word").between(3, WIDTH - 2))
    seen = seen.groupBy("word").agg(
        F.sum("_label").alias("in_toxic"), F.sum(1 - F.col("_label")).alias("in_clean")
    )
    seen = written(seen, "toxic-words")
    odds = (F.col("in_toxic") / toxic) / (F.col("in_toxic") / toxic + F.col("in_clean") / clean)
    # So often in toxic texts that chance would bring less than one word there by the share of toxic.
    distinct = max(seen.count(), 2)
    least = max(2, math.ceil(math.log(distinct) / math.log(1 + clean / toxic)))
    likely = seen.filter((F.col("in_toxic") >= least) & (odds >= 0.98)).orderBy(
        F.desc("in_toxic"), "word"
    )
    likely = likely.select("word").limit(4 * most_positive)
    # Copies of one text repeat a word behind the same word, and a long text holds it in many places:
    # the word before its first place in a text tells texts apart that say it on their own.
    toxic_words = words.filter("_label = 1").select(F.monotonically_increasing_id().alias("row"), "words")
    behind = toxic_words.select("row", "words", F.posexplode("words").alias("at", "word"))
    behind = behind.join(F.broadcast(likely), "word")
    behind = behind.select("row", "word", "at", F.get("words", F.col("at") - 1).alias("previous"))
    first = F.min(F.struct("at", "previous")).alias("first")
    behind = behind.groupBy("row", "word").agg(first).select("word", "first.previous").distinct()
    positive = behind.groupBy("word").agg(F.count("*").alias("places"))
    positive = positive.filter(F.col("places") >= least).orderBy(F.desc("places"), "word")
    negative = seen.filter((F.col("in_clean") >= 1) & (odds <= 0.8))
    frequent = negative.orderBy(F.desc("in_clean"), "word").limit(most_negative // 2)
    others = negative.orderBy(F.xxhash64("word"), "word").limit(most_negative // 2)
    plus = [(r[0], float(r[1]) ** 0.5) for r in positive.limit(most_positive).collect()]
    minus = {r[0]: float(r[2]) ** 0.25 for r in [*frequent.collect(), *others.collect()]}
    if not plus or not minus:
        share = toxic / (toxic + clean)
        return Model(Alphabet({}), None, np.zeros(1), 0.0, np.zeros(4), np.zeros(2), constant=float(share))
    sample = []
    for value in (0, 1):
        kind = rows.filter(F.col("_label") == value).withColumn("_draw", F.xxhash64("_text"))
        kind = kind.select("_draw", "_text")
        last = kind.select("_draw").orderBy("_draw").limit(most_texts // 2).agg(F.max("_draw"))
        drawn = kind.filter(F.col("_draw") <= last.first()[0]).limit(most_texts // 2)
        sample += [(r[1], value) for r in sorted(drawn.collect())]
    texts, found = [t for t, _ in sample], np.array([v for _, v in sample], float)
    model = fit(plus, list(minus.items()), texts, found, share=toxic / (toxic + clean))
    for _ in range(HARD_ROUNDS):  # the clean words the model likes best become negatives
        liked = score(negative, model, ("word",), "word").orderBy(F.desc("score"), "word")
        hard = [r[0] for r in liked.limit(most_negative // 3).collect()]
        minus = {**dict.fromkeys(hard, 3.0), **{w: v for w, v in minus.items() if w not in hard}}
        model = fit(plus, list(minus.items()), texts, found, share=toxic / (toxic + clean))
    return model


def score(
    documents: DataFrame, model: Model, carry: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Carried columns and ``score`` of every row."""
    asked = documents.select(*carry, plain_text(text).alias("_text"))
    kept = [f.simpleString().replace(":", " ", 1) for f in asked.schema.fields[:-1]]
    model.cache.clear()
    # The index of numbers and the landmarks' features (some 30 MB), whatever the input's size.
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found: list[float] = []
            for at in range(0, len(texts), 1024):
                found += fitted.scores(texts[at : at + 1024]).tolist()
            rest = batch.select(batch.schema.names[:-1])
            columns = [*rest.columns, pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*rest.schema.names, "score"])

    return asked.mapInArrow(run, ", ".join([*kept, "score double"]))
