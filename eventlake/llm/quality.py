"""Quality classifier by positive-unlabelled learning.

A linear model is trained on trusted positives (documents labelled as of quality 1) and unlabelled
web text (any documents, whatever their label) alone; labels of 0 are never looked at. The training
minimises the non-negative unbiased risk
    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))
with logistic loss, where R_p(y) and R_u(y) are the mean losses of positives and of unlabelled
documents if taken for class y. Where the second term would go below zero the step climbs on it
instead, which keeps a flexible model from paying for positives with negative risk.

The class prior, the share of good documents in the web text, is estimated first: a classifier of
positives against unlabelled documents is trained on half of each, and on the other half the prior is
the least ratio, over all score thresholds, of unlabelled to positive documents above the threshold,
with a margin that widens as fewer positives are above it.

Both samples are bounded by `Settings.positives` and `Settings.unlabelled` (whole texts, reduced to
feature vectors on the executors).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.arrays import blocks_of, flat_bytes, slices, text_array, words_of
from eventlake.llm.tables import held_out, trained_on

#: How a text is written, besides its hashed byte pairs.
SHAPE = (
    "log words", "word length", "distinct words", "repeated neighbours", "upper case", "digits",
    "punctuation", "not ASCII", "line ends", "words with odd marks", "words of marks only",
    "words of at most three bytes", "words of over seven bytes",
)


@dataclass(frozen=True)
class Settings:
    positives: int = 3000  # trusted documents to learn from, at most
    unlabelled: int = 5000  # web documents to learn from, on average
    bits: int = 10  # 2 ** bits buckets of byte pairs
    passes: int = 250
    batch: int = 2048
    slack: float = 0.02  # how far below zero the second term may go in one batch
    rate: float = 0.05
    decay: float = 1e-4
    margin: float = 1.0  # of the prior's estimate, in standard errors
    cut: float = 0.3  # scores from here on are predicted to be good
    seed: int = 11


@dataclass(frozen=True)
class Model:
    weight: np.ndarray
    bias: float
    center: np.ndarray
    scale: np.ndarray
    prior: float
    settings: Settings


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    return count / np.maximum(1, total)


def pair_buckets(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    code = first.astype(np.uint32) << np.uint32(8) | second
    return code * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)


def tallies(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every text that its shape is made of, a column each, and of its byte pairs."""
    rows = len(texts)
    flat, offsets = flat_bytes(texts)
    length = np.diff(offsets)
    owner = np.repeat(np.arange(rows), length)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=rows)

    letter = ((flat | 32) >= 97) & ((flat | 32) <= 122)
    digit = (flat >= 48) & (flat <= 57)
    mark = (flat > 32) & (flat < 127) & ~letter & ~digit

    vocabulary, index, first = words_of(texts)
    words = np.diff(first)
    word_owner = np.repeat(np.arange(rows), words)
    distinct = np.unique(word_owner * (len(vocabulary) + 1) + index) // (len(vocabulary) + 1)
    same = (index[1:] == index[:-1]) & (word_owner[1:] == word_owner[:-1])

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(word_owner[mask[index]], minlength=rows)

    def matching(pattern: str) -> np.ndarray:
        return pc.match_substring_regex(vocabulary, pattern).to_numpy(zero_copy_only=False)

    wide = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False)
    counts = [
        length,
        words,
        np.bincount(distinct, minlength=rows),
        np.bincount(word_owner[1:][same], minlength=rows),
        per_text(letter & (flat < 97)),
        per_text(digit),
        per_text(mark),
        per_text(flat >= 128),
        per_text(flat == 10),
        of_words(matching(r"[^\pL\pN.,;:'-]")),
        of_words(matching(r"^[^\pL\pN]+$")),
        of_words(wide <= 3),
        of_words(wide > 7),
    ]
    size = 1 << bits
    pairs = np.zeros((rows, size), np.int64)
    if len(flat) > 1:
        inside = owner[1:] == owner[:-1]
        cell = owner[1:][inside] * size + pair_buckets(flat[:-1], flat[1:], bits)[inside]
        pairs = np.bincount(cell, minlength=rows * size).reshape(rows, size)
    return np.stack(counts, axis=1), pairs


#: Bytes of a long text that are taken at once.
BLOCK = 1 << 20
DISTINCT, SAME = 2, 3
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def long_tallies(text: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """`tallies` of one text, taken block by block; it holds eight bytes for each distinct word."""
    import xxhash

    flat, _ = flat_bytes(text)
    counts = pairs = 0
    seen, last = np.zeros(0, np.uint64), None
    for start, end in blocks_of(flat, BLOCK, lambda some: BLANK[some]):
        block = pa.array([flat[start:end].tobytes()]).cast(pa.string())
        some, more = tallies(block, bits)
        vocabulary, index, _ = words_of(block)
        if len(index):
            known = vocabulary.to_pylist()
            some[0, SAME] += known[index[0]] == last
            last = known[index[-1]]
            used = np.unique(index).tolist()
            hashes = (xxhash.xxh3_64_intdigest(known[word]) for word in used)
            seen = np.union1d(seen, np.fromiter(hashes, np.uint64, len(used)))
        if start:
            more[0, pair_buckets(flat[start - 1 : start], flat[start : start + 1], bits)] += 1
        counts, pairs = counts + some, pairs + more
    counts[0, DISTINCT] = len(seen)
    return counts, pairs


def features(texts: pa.Array, bits: int) -> np.ndarray:
    """A row of features per text: its shape, then square roots of its byte pairs' shares."""
    texts = text_array(texts)
    if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > BLOCK:
        counts, pairs = long_tallies(texts, bits)
    else:
        counts, pairs = tallies(texts, bits)
    length, words, distinct, same, *rest = counts.T
    by_length, by_words = rest[:5], rest[5:]
    shape = [np.log1p(words), share(length, words) / 10]
    # Shares count by their roots, so that traces of junk show beside texts full of it.
    shape += [np.sqrt(share(count, words)) for count in (distinct, same)]
    shape += [np.sqrt(share(count, length)) for count in by_length]
    shape += [np.sqrt(share(count, words)) for count in by_words]
    pairs = np.sqrt(pairs / np.maximum(1, length[:, None] - 1))
    return np.hstack([np.stack(shape, axis=1), pairs]).astype(np.float32)


def standard(rows: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Deviations from the mean, of which none counts as more than eight."""
    return np.clip((rows - center) / scale, -8, 8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def descend(settings: Settings, positive: np.ndarray, unlabelled: np.ndarray, slope) -> tuple:
    """Adam over batches of both samples; `slope` gives d risk / d output for a batch of each."""
    draw = np.random.default_rng(settings.seed)
    point = np.zeros(positive.shape[1] + 1)
    mean, square, step = np.zeros_like(point), np.zeros_like(point), 0
    batches = max(1, -(-(len(positive) + len(unlabelled)) // settings.batch))
    for turn in range(settings.passes):
        for some, other in zip(
            np.array_split(draw.permutation(len(positive)), batches),
            np.array_split(draw.permutation(len(unlabelled)), batches),
            strict=True,
        ):
            if not len(some) or not len(other):
                continue
            x, z = positive[some], unlabelled[other]
            on_x, on_z = slope(x @ point[:-1] + point[-1], z @ point[:-1] + point[-1])
            step += 1
            gradient = np.append(on_x @ x + on_z @ z, on_x.sum() + on_z.sum())
            gradient[:-1] += settings.decay * point[:-1]
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.999 * square + 0.001 * gradient**2
            rate = settings.rate * (1 - turn / settings.passes)
            point -= rate * (mean / (1 - 0.9**step)) / (
                np.sqrt(square / (1 - 0.999**step)) + 1e-8
            )
    return point[:-1], point[-1]


def apart(x: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positives against unlabelled: the ordinary logistic risk."""
    return -sigmoid(-x) / len(x), sigmoid(z) / len(z)


def non_negative(prior: float, slack: float):
    """The non-negative unbiased risk. Noise of a batch may take its second term below zero."""

    def slope(x: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        as_positive = -prior * sigmoid(-x) / len(x)
        rest_x, rest_z = -prior * sigmoid(x) / len(x), sigmoid(z) / len(z)
        rest = np.logaddexp(0, z).mean() - prior * np.logaddexp(0, x).mean()
        if rest < -slack:
            return -rest_x, -rest_z
        return as_positive + rest_x, rest_z

    return slope


def estimate_prior(settings: Settings, positive: np.ndarray, unlabelled: np.ndarray) -> float:
    weight, bias = descend(settings, positive[::2], unlabelled[::2], apart)
    above = np.sort(positive[1::2] @ weight + bias)
    other = np.sort(unlabelled[1::2] @ weight + bias)
    if not len(above) or not len(other):
        return 0.5
    kept = np.arange(len(above), 0, -1) / len(above)  # of the positives, from each one upward
    rest = 1 - np.searchsorted(other, above) / len(other)
    noise = np.sqrt(1 / len(above)) + np.sqrt(1 / len(other))
    bound = (rest + settings.margin * noise) / kept
    best = int(bound.argmin())
    return float(np.clip(rest[best] / kept[best], 0.05, 0.98))


def fit(
    positive: np.ndarray, unlabelled: np.ndarray, settings: Settings = Settings()
) -> Model | None:
    """Train on feature rows of both samples; None if either is empty."""
    if not len(positive) or not len(unlabelled):
        return None
    both = np.vstack([positive, unlabelled]).astype(np.float64)
    center, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    # Byte pairs are many: together they count as much as four of the others.
    scale[len(SHAPE) :] *= np.sqrt((1 << settings.bits) / 4)
    x, z = standard(positive, center, scale), standard(unlabelled, center, scale)
    prior = estimate_prior(settings, x, z)
    weight, bias = descend(settings, x, z, non_negative(prior, settings.slack))
    return Model(weight, float(bias), center, scale, prior, settings)


def train(
    documents: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    text: str = "text",
    doc_id: str = "doc_id",
    quality: str = "quality",
) -> Model | None:
    """Learn from rows outside the held-out fold; None without positives or documents.

    A document is a positive if any of its labels is 1.
    """
    trusted = labels.where((F.col(quality) == 1) & trained_on(doc_id)).select(
        F.col(doc_id).alias("_id")
    )
    part = min(1.0, settings.positives / max(1, trusted.count()))
    # At most `positives` ids: the limit bounds what is broadcast.
    trusted = (
        trusted.sample(part, settings.seed)
        .limit(settings.positives)
        .distinct()
        .withColumn("_good", F.lit(True))
    )
    learned = documents.where(trained_on(doc_id)).select(
        F.col(doc_id).alias("_id"), F.col(text).alias("_text")
    )
    part = min(1.0, settings.unlabelled / max(1, learned.count()))
    drawn = (
        learned.withColumn("_web", F.rand(settings.seed) < part)
        .join(F.broadcast(trusted), "_id", "left")
        .where("_web OR _good")
    )
    bits = settings.bits

    @F.arrow_udf("binary")
    def features_of(texts: pa.Array) -> pa.Array:
        rows = [
            row.tobytes()
            for start, end in slices(texts, 1 << 20)
            for row in features(texts.slice(start, end - start), bits)
        ]
        return pa.array(rows, pa.binary())

    rows = drawn.select("_web", "_good", features_of("_text").alias("x")).collect()
    wide = len(SHAPE) + (1 << bits)

    def matrix(which: str) -> np.ndarray:
        chosen = sorted(bytes(row["x"]) for row in rows if row[which])
        flat = np.frombuffer(b"".join(chosen), np.float32).reshape(-1, wide)
        return flat[np.random.default_rng(settings.seed).permutation(len(flat))]

    return fit(matrix("_good"), matrix("_web"), settings)


def score(texts: pa.Array, model: Model | None) -> np.ndarray:
    """Chance of good quality of every text; 0.5 without a model."""
    texts = text_array(texts)
    out = np.full(len(texts), 0.5)
    if model is not None:
        for start, end in slices(texts, 1 << 20):
            rows = features(texts.slice(start, end - start), model.settings.bits)
            rows = standard(rows, model.center, model.scale)
            out[start:end] = sigmoid(rows @ model.weight + model.bias)
    return out


def grade(documents: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add `score double` and `predicted int`, replacing such columns.

    NULL text scores as empty text does, very long texts are read in blocks. Without anything to
    learn from every score is 0.5. Equal texts get equal scores; an empty table gives an empty one.
    """

    @F.arrow_udf("double")
    def score_of(texts: pa.Array) -> pa.Array:
        return pa.array(score(texts, model))

    cut = (model.settings if model else Settings()).cut
    return documents.withColumn("score", score_of(F.col(text))).withColumn(
        "predicted", (F.col("score") >= cut).cast("int")
    )


def quality_report(
    documents: DataFrame, labels: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Score every document with a model learned from the other folds."""
    model = train(documents, labels, settings)
    return grade(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted"
    )
