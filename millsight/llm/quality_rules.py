"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

One pass counts features of each whole text. Every rule turns them into a vote (good, bad, abstain).
A label model with a class prior and, per rule and class, the chance of a bad vote among cast votes
is fitted by expectation-maximisation on the counts of vote patterns: at most 3^rules rows whatever
the input's size, gathered over all documents. The posterior of a text's pattern decides.

Defined results: a null text is empty. An empty table gives an empty result. Rows are judged one by
one, so repeated rows stay repeated, and columns other than the text are carried through untouched.
Texts failing the base rules (fewer than 50 words, or over half of them in repeated three-word
windows) are never kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsight.llm.common import written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
WINDOW = 3
KEEP_AT = 0.5
#: What the label model takes for granted: a rule votes against at most this share of good texts.
MOST_BAD_VOTES_ON_GOOD = 0.02

#: Common function words of four languages (fixed values).
STOP_WORDS = frozenset(
    word.encode()
    for word in (
        "the of and to in is that it for with on are as be this "
        "der die das und zu den von mit ist nicht auf für ein eine im "
        "le la les de des et en un une du est que pour dans qui "
        "el los las del y se por con para su al como más lo"
    ).split()
)

FEATURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words "
    "n_lines n_ended_lines n_upper n_lower n_digits n_shouts n_stops n_marked_words"
).split()


def repeated_words(words: Sequence[bytes], n: int = WINDOW) -> int:
    """How many words lie in an n-word window that the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(n)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = {window for window, times in Counter(windows).items() if times > 1}
    covered = end = 0
    for at, window in enumerate(windows):
        if window in often:
            covered += at + n - max(at, end)
            end = at + n
    return covered


def text_features(text: bytes) -> tuple[int, ...]:
    """The values of ``FEATURES`` for a UTF-8 text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    data = np.frombuffer(text, np.uint8)
    upper = int(np.count_nonzero((data >= 65) & (data <= 90)))
    lower = int(np.count_nonzero((data >= 97) & (data <= 122)))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    digits = int(np.count_nonzero((data >= 48) & (data <= 57)))
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(line.rstrip()[-1] in b".!?:;\"'" for line in lines),
        upper,
        lower,
        digits,
        text.count(b"!!") + text.count(b"??"),
        sum(map(STOP_WORDS.__contains__, words)),
        symbols and sum(len(w.translate(None, SYMBOLS)) < len(w) for w in words),
    )


def _feature_batches(batches):
    for batch in batches:
        *kept, texts = batch.columns
        rows = [text_features(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
        found = np.array(rows, np.int64).reshape(len(rows), len(FEATURES))
        columns = [pa.array(found[:, i]) for i in range(len(FEATURES))]
        yield pa.RecordBatch.from_arrays([*kept, *columns], [*batch.schema.names[:-1], *FEATURES])


def measure(documents: DataFrame, carry: Sequence[str], text: str = "text") -> DataFrame:
    """The carried columns and ``FEATURES`` of every row; a carried column of a feature's name is left out."""
    carry = [c for c in carry if c not in FEATURES]
    own = [F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)]
    asked = documents.select(*own, F.col(text).cast("string").alias("_text"))
    kept = [f.simpleString().replace(":", " ", 1) for f in asked.schema.fields[:-1]]
    schema = ", ".join([*kept, *(f"{name} bigint" for name in FEATURES)])
    return asked.mapInArrow(_feature_batches, schema).toDF(*carry, *FEATURES)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _high_is_bad(value: Column, good: float, bad: float) -> Column:
    return F.when(value > bad, -1).when(value <= good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Each rule's vote: 1 good, -1 bad, 0 abstains."""
    length = _share("word_chars", "n_words")
    letters = F.col("n_upper") + F.col("n_lower")
    ended = _share("n_ended_lines", "n_lines")
    many_lines = F.col("n_lines") >= 3
    return {
        "length": F.when(F.col("n_words") < MIN_WORDS, -1).when(F.col("n_words") >= 100, 1),
        "word_length": F.when((length < 2.5) | (length > 12), -1).when(length.between(3, 10), 1),
        "symbols": _high_is_bad(_share("n_symbols", "n_words"), 0.02, 0.3),
        "symbol_share": _high_is_bad(_share("n_symbols", "word_chars"), 0.005, 0.05),
        "marked_words": _high_is_bad(_share("n_marked_words", "n_words"), 0.02, 0.3),
        "same_lines": F.when(many_lines, _high_is_bad(_share("n_dup_lines", "n_lines"), 0.05, 0.4)),
        "repeats": _high_is_bad(_share("n_repeat_words", "n_words"), 0.1, 0.45),
        "capitals": F.when(
            letters >= 20, _high_is_bad(F.col("n_upper") / F.greatest(letters, F.lit(1)), 0.15, 0.5)
        ),
        "shouts": _high_is_bad(_share("n_shouts", "n_words"), 0.01, 0.2),
        "digits": _high_is_bad(_share("n_digits", "word_chars"), 0.1, 0.25),
        "line_ends": F.when(many_lines & (ended < 0.1), -1).when(ended >= 0.5, 1),
        "stop_words": F.when(_share("n_stops", "n_words") >= 0.1, 1),
    }


def fit(
    votes: np.ndarray, counts: np.ndarray, rounds: int = 200, strength: float = 0.02
) -> tuple[float, np.ndarray]:
    """Class prior of good and bad-vote chances [rule, class] by expectation-maximisation.

    ``votes`` is [pattern, rule] in -1, 0, 1 and ``counts`` the rows of each pattern. A Beta prior of
    ``strength`` times the rows keeps each rule pointing the way it was written: good texts seldom
    get bad votes, bad texts sometimes do. Abstentions carry no weight.
    """
    total = max(float(counts.sum()), 1.0)
    bad, good = votes == -1, votes == 1
    belief = np.where(bad.any(1), 0.2, 0.95)
    pseudo = strength * total * np.array([[0.3, 0.7], [0.01, 0.99]])
    prior, chance = 0.5, np.tile([0.3, 0.01], (votes.shape[1], 1))
    for _ in range(rounds):
        weights = counts[:, None] * np.stack([1 - belief, belief], 1)
        cast_bad, cast_good = bad.T @ weights, good.T @ weights
        now = (cast_bad + pseudo[:, 0]) / (cast_bad + cast_good + pseudo.sum(1))
        now = np.clip(now, 1e-4, [1 - 1e-4, MOST_BAD_VOTES_ON_GOOD])
        prior = float((weights[:, 1].sum() + 0.9 * strength * total) / (total * (1 + strength)))
        prior = min(max(prior, 1e-3), 1 - 1e-3)
        moved, chance = np.abs(now - chance).max(), now
        belief = posterior(votes, prior, chance)
        if moved < 1e-9:
            break
    return prior, chance


def posterior(votes: np.ndarray, prior: float, chance: np.ndarray) -> np.ndarray:
    """Probability that a text with these votes is good."""
    bad, good = votes == -1, votes == 1
    logs = bad @ np.log(chance) + good @ np.log(1 - chance)
    odds = logs[:, 1] - logs[:, 0] + np.log(prior) - np.log(1 - prior)
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def judge(
    documents: DataFrame, carry: Sequence[str], text: str = "text", store: bool = True
) -> DataFrame:
    """Carried columns, ``FEATURES``, base_failed, the votes, quality (posterior) and kept.

    A carried column of one of these names gives way to the operator's own.

    The features are needed twice: ``store`` writes them (with the carried columns), without it they are
    computed again, which saves the space when whole texts are carried.
    """
    asked = rules()
    votes = {f"vote_{n}": F.coalesce(v, F.lit(0)).cast("tinyint") for n, v in asked.items()}
    measured = measure(documents, carry, text).withColumns(votes)
    if store:
        measured = written(measured, "quality-features")
    counted = measured if store else measure(documents, [], text).withColumns(votes)
    # At most 3^rules rows come to the driver, whatever the input's size.
    patterns = counted.groupBy(*votes).count().collect()
    found = np.array([row[:-1] for row in patterns], np.int8).reshape(len(patterns), len(votes))
    counts = np.array([row[-1] for row in patterns], float)
    prior, chance = fit(found, counts)

    logs = np.log(chance)
    against = np.log(1 - chance)
    odds = F.lit(float(np.log(prior) - np.log(1 - prior)))
    for i, name in enumerate(votes):
        if_bad, if_good = float(logs[i, 1] - logs[i, 0]), float(against[i, 1] - against[i, 0])
        odds = odds + F.when(F.col(name) == -1, if_bad).when(F.col(name) == 1, if_good).otherwise(0.0)
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    failed = (F.col("n_words") < MIN_WORDS) | repeats
    return measured.withColumns({"base_failed": failed, "quality": 1 / (1 + F.exp(-odds))}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_AT)
    )
