"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams (all of them, over the whole
lower-cased text); a linear softmax over that mean gives a probability per language. Both tables are
trained by stochastic gradient descent in NumPy on the driver, over a sample of labelled rows whose
size is `Settings.per_language` times at most `Settings.languages`; of more labels each gets fewer rows,
but all are learned. Of each row the driver gets the shares
of its n-gram buckets, which are bounded however long the text is. Mean and softmax input are linear,
so for scoring the two tables fold into one row of class scores per bucket.

Part of the sample is not trained on. It sets the temperature of the softmax, so that scores are
probabilities, and the score below which a prediction is rejected: the highest at which no more than
`Settings.lost` of the right predictions would be.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.arrays import blocks_of, flat_bytes, release_memory, slices, text_array
from eventlake.llm.tables import held_out, trained_on

UNKNOWN = "und"
PAD = "\x00\x00\x00"


@dataclass(frozen=True)
class Settings:
    per_language: int = 700  # documents sampled per language, on average
    languages: int = 200  # labels that get so many; with more of them each gets fewer
    least: int = 20  # documents sampled per language, however many there are
    orders: tuple[int, ...] = (1, 2, 3)  # lengths of the byte n-grams
    bits: int = 14  # 2 ** bits n-gram buckets
    width: int = 16  # of an embedding
    passes: int = 6
    rate: float = 0.5
    lost: float = 0.001  # share of right predictions that rejection may cost
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float
    threshold: float
    settings: Settings


def gram_buckets(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The bucket of the n-gram at each byte."""
    codes = codes.astype(np.uint32)
    mixed = np.full(len(codes), order, np.uint32)
    for step in range(order):
        ahead = len(codes) - step
        mixed[:ahead] = mixed[:ahead] * np.uint32(0x01000193) + codes[step:]
    mixed *= np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x85EBCA6B)
    return mixed >> np.uint32(32 - bits)


def grams(texts: pa.Array, settings: Settings):
    """Per order: the n-gram bucket at each byte, where texts start, and their byte lengths.

    Every text is followed by a pad, so an n-gram never spans two texts.
    """
    lowered = pc.utf8_lower(texts)
    flat, offsets = flat_bytes(pc.binary_join_element_wise(lowered, PAD, ""))
    starts, lengths = offsets[:-1], np.diff(offsets) - len(PAD)
    for order in settings.orders:
        yield gram_buckets(flat, order, settings.bits), starts, lengths


#: Bytes of a long text that are taken at once.
BLOCK = 1 << 18


def bucket_counts(text: pa.Array, settings: Settings) -> np.ndarray:
    """How many n-grams of one text are in each bucket; memory does not grow with the text."""
    counts = np.zeros(1 << settings.bits, np.int64)
    flat, _ = flat_bytes(text)
    ahead = max(settings.orders) - 1
    left = np.zeros(0, np.uint8)
    # Blocks begin with a character, and lower case goes character by character.
    for start, end in blocks_of(flat, BLOCK, lambda some: some & 0xC0 != 0x80):
        whole = pa.array([flat[start:end].tobytes()]).cast(pa.string())
        left = np.concatenate((left, flat_bytes(pc.utf8_lower(whole))[0]))
        ready = max(0, len(left) - ahead)
        for order in settings.orders:
            buckets = gram_buckets(left, order, settings.bits)[:ready]
            counts += np.bincount(buckets, minlength=len(counts))
        left = left[ready:]
    padded = np.concatenate((left, np.frombuffer(PAD.encode(), np.uint8)))
    for order in settings.orders:
        buckets = gram_buckets(padded, order, settings.bits)[: len(left)]
        counts += np.bincount(buckets, minlength=len(counts))
    return counts


def bag(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one text and their shares of its n-grams."""
    counts = bucket_counts(pa.array([text]), settings)
    buckets = np.flatnonzero(counts)
    return buckets, (counts[buckets] / max(1, counts.sum())).astype(np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def packed(text: str, settings: Settings) -> bytes:
    """A text's bag as bytes: its buckets, then their shares."""
    buckets, shares = bag(text, settings)
    return buckets.astype("<u4").tobytes() + shares.astype("<f4").tobytes()


def unpacked(stored: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(stored) // 2
    return (
        np.frombuffer(stored[:half], "<u4").astype(np.int64),
        np.frombuffer(stored[half:], "<f4"),
    )


def fit(rows: list[tuple[bytes, str]], settings: Settings = Settings()) -> Model | None:
    """Train on pairs of a packed bag and a language; None without any. Every fifth calibrates."""
    languages = sorted({language for _, language in rows})
    if not languages:
        return None
    draw = np.random.default_rng(settings.seed)
    rows = sorted(rows)
    rows = [rows[i] for i in draw.permutation(len(rows))]
    bags = [unpacked(stored) for stored, _ in rows]
    wanted = np.array([languages.index(language) for _, language in rows])
    size, width = len(languages), settings.width
    embedding = draw.uniform(-1, 1, (1 << settings.bits, width)).astype(np.float32) / width
    output, bias = np.zeros((width, size), np.float32), np.zeros(size, np.float32)
    checks = np.arange(len(rows)) % 5 == 4
    # A language whose rows would all be checks is trained on instead.
    checks &= ~np.isin(wanted, np.setdiff1d(np.arange(size), wanted[~checks]))
    if checks.sum() == 0:
        checks[:] = True
        training = np.arange(len(rows))
    else:
        training = np.flatnonzero(~checks)
    # Languages weigh alike, however often each is in the sample.
    share = np.bincount(wanted[training], minlength=size)
    weight = len(training) / np.maximum(1, share) / size
    steps = settings.passes * len(training)
    for step, row in enumerate(np.concatenate([draw.permutation(training)] * settings.passes)):
        buckets, shares = bags[row]
        hidden = shares @ embedding[buckets]
        slope = softmax(hidden @ output + bias)
        slope[wanted[row]] -= 1
        slope *= settings.rate * (1 - step / steps) * min(4.0, weight[wanted[row]])
        back = output @ slope
        output -= np.outer(hidden, slope)
        bias -= 0.1 * slope
        # Divided by the length of the shares, the step moves the mean as a step on itself would.
        embedding[buckets] -= (shares / (shares @ shares))[:, None] * back
    scores = embedding @ output
    raw = np.array([bags[i][1] @ scores[bags[i][0]] + bias for i in np.flatnonzero(checks)])
    truth = wanted[checks]
    temperature = min(
        np.geomspace(1, 20, 40),
        key=lambda t: -np.log(
            softmax(raw / t)[np.arange(len(truth)), truth] + 1e-12
        ).mean(),
    )
    calibrated = softmax(raw / temperature)
    right = np.sort(calibrated.max(axis=1)[calibrated.argmax(axis=1) == truth])
    threshold = float(right[int(settings.lost * len(right))]) if len(right) else 0.0
    return Model(languages, scores, bias, float(temperature), min(0.5, threshold), settings)


def sample(
    documents: DataFrame, settings: Settings, text: str, language: str, doc_id: str
) -> list[tuple[bytes, str]]:
    """Bags of about `per_language` whole texts of each label, or fewer where there are many labels.

    Held-out rows and texts without a letter are left aside.
    """
    labelled = documents.where(trained_on(doc_id) & F.col(language).isNotNull()).select(
        F.col(text).alias("text"), F.col(language).alias("language")
    )
    counts = labelled.groupBy("language").count().collect()
    share = min(1.0, settings.languages / max(1, len(counts)))
    wanted = max(min(settings.least, settings.per_language), settings.per_language * share)
    fractions = {row["language"]: min(1.0, wanted / row["count"]) for row in counts}
    if not fractions:
        return []
    drawn = labelled.sampleBy("language", fractions, settings.seed).where(
        F.col("text").rlike(r"\p{L}")
    )

    @F.arrow_udf("binary")
    def bag_of(texts: pa.Array) -> pa.Array:
        return pa.array([packed(text, settings) for text in texts.to_pylist()], pa.binary())

    rows = drawn.select(bag_of("text").alias("bag"), "language").collect()
    return [(bytes(row["bag"]), row["language"]) for row in rows]


def train(
    documents: DataFrame,
    settings: Settings = Settings(),
    text: str = "text",
    language: str = "lang",
    doc_id: str = "doc_id",
) -> Model | None:
    """Learn from labelled rows outside the held-out fold; None if there are none."""
    return fit(sample(documents, settings, text, language, doc_id), settings)


#: Scores that are gathered at once.
SCORES = 4_000_000
LETTER = r"\p{L}"


def predict(texts: pa.Array, model: Model | None) -> tuple[list[str], np.ndarray]:
    """Language and score of every text; `und` and 0 for NULL or a text without a letter."""
    texts = text_array(texts)
    names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model is None:
        return names, best
    # A row of scores for each byte: with many languages fewer bytes at once. A text that is longer
    # than there are buckets counts these instead, which gives the same sums.
    for start, end in slices(texts, max(1, min(1 << 20, SCORES // len(model.languages)))):
        part = texts.slice(start, end - start)
        total = np.zeros((end - start, len(model.languages)))
        count = np.zeros(end - start)
        if end - start == 1 and pc.binary_length(part)[0].as_py() > 1 << model.settings.bits:
            counts = bucket_counts(part, model.settings)
            total[0], count[0] = counts @ model.scores, counts.sum()
        else:
            for buckets, starts, lengths in grams(part, model.settings):
                bounds = np.stack([starts, starts + lengths], axis=1).ravel()
                sums = np.add.reduceat(model.scores[buckets], bounds, axis=0)[::2]
                total += np.where(lengths[:, None] > 0, sums, 0)
                count += lengths
        chances = softmax(
            (total / np.maximum(1, count)[:, None] + model.bias) / model.temperature
        )
        letters = pc.match_substring_regex(part, LETTER).to_numpy(zero_copy_only=False)
        for row in np.flatnonzero(letters).tolist():
            names[start + row] = model.languages[int(chances[row].argmax())]
            best[start + row] = chances[row].max()
    return names, best


def identify(documents: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add `lang_pred string`, `score double` and `accepted boolean`, replacing such columns.

    Very long texts are read in blocks. Text that is NULL, empty or without a letter gets `und`, 0
    and is not accepted, as does every row if there was nothing to learn from. Equal scores go to
    the label that sorts first. Repeated rows are scored each; an empty table gives an empty one.
    """

    @F.arrow_udf("struct<lang_pred: string, score: double, accepted: boolean>")
    def language_of(texts: pa.Array) -> pa.Array:
        names, best = predict(texts, model)
        release_memory()
        known = np.array([name != UNKNOWN for name in names], bool)
        accepted = known & (best >= (model.threshold if model else 0))
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(best), pa.array(accepted)],
            ["lang_pred", "score", "accepted"],
        )

    found = documents.withColumn("_found", language_of(F.col(text)))
    for name in ("lang_pred", "score", "accepted"):
        found = found.withColumn(name, F.col(f"_found.{name}"))
    return found.drop("_found")


def language_report(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Predict the language of every document with a model learned from the other folds."""
    model = train(documents, settings)
    return identify(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "accepted"
    )
