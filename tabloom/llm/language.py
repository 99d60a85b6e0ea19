"""Language identification by mixture inference.

The model holds, for each language of the labelled documents, the smoothed probabilities of hashed character
trigrams. For a document, expectation-maximisation estimates the share of each language in the mixture
that its trigrams are drawn from. Languages are added in the order of their shares while the likelihood
gains more than the penalty of a parameter (Bayesian information criterion). The largest share of the final
set gives the predicted language and the score.

Trigrams overlap, so each character is seen three times; the log-likelihood counts a third.

The model is a table of languages x buckets. Its size does not depend on the number of documents, and it is
checked before it is broadcast; a task keeps as much while counting.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and no languages; labels that
are null are not learned from; ties go to the language first in the alphabet; repeated rows get equal
results; an empty table gives an empty result, an empty training set only ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.batches import texts_of

BUCKETS = 1 << 16
SMOOTHING = 0.5
TRIGRAM_CHARS = 3
MAX_ITERATIONS = 50
TOLERANCE = 1e-3
UNKNOWN = "und"
MODEL_BYTES = 1 << 30


class Trigrams:
    """Turns texts into hashed trigrams of lower-case letters; everything else is one space."""

    def __init__(self):
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)

    def of(self, text: str) -> np.ndarray | None:
        """Bucket of every trigram; None if the text has no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
        letters = self.letter[points]
        if not letters.any():
            return None
        points = np.where(letters, points, 32)
        keep = letters.copy()
        keep[1:] |= letters[:-1]  # of a run of other characters, the first
        padded = np.concatenate([[32], points[keep], [32]]).astype(np.uint64)
        mixed = padded[:-2] * np.uint64(0x9E3779B97F4A7C15) + padded[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed += padded[2:] * np.uint64(0x165667B19E3779F9)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(48)).astype(np.int64)


def count_trigrams(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows; every task sends its own sums only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, totals = Trigrams(), {}
        for batch in batches:
            for name, body in zip(batch.column(lang).to_pylist(), texts_of(batch, text)):
                found = trigrams.of(body)
                if found is not None:
                    total = totals.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                    if len(found) > BUCKETS // 4:
                        total += np.bincount(found, minlength=BUCKETS)
                    else:
                        np.add.at(total, found, 1)
        for name, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen), pa.array(total[seen])],
                ["lang", "bucket", "n"],
            )

    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias(lang), text)
    counted = rows.mapInArrow(count, "lang string, bucket long, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and their trigram probabilities (languages x buckets)."""
    found = count_trigrams(labelled, text, lang).toPandas()
    names = sorted(found["lang"].unique())
    if len(names) * BUCKETS * 8 > MODEL_BYTES:
        raise ValueError(f"{len(names)} languages are too many for a broadcast model")
    counts = np.zeros((len(names), BUCKETS))
    counts[np.searchsorted(names, found["lang"].to_numpy(dtype=str)) if names else [], found["bucket"]] = found["n"]
    smoothed = counts + SMOOTHING
    return names, smoothed / smoothed.sum(axis=1, keepdims=True)


def mixture(likelihood: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the languages (rows of ``likelihood``) and the log-likelihood, by expectation-maximisation."""
    n = counts.sum()
    for _ in range(MAX_ITERATIONS):
        joint = shares[:, None] * likelihood
        total = joint.sum(axis=0)
        fresh = joint @ (counts / total) / n
        change = np.abs(fresh - shares).max()
        shares = fresh
        if change < TOLERANCE:
            break
    return shares, float(np.log(shares @ likelihood) @ counts)


def infer(likelihood: np.ndarray, counts: np.ndarray) -> list[tuple[int, float]]:
    """The selected languages with their shares, largest first."""
    single = np.log(likelihood) @ counts
    best = int(single.argmax())
    chosen, shares, score = [best], np.ones(1), float(single[best])
    languages = len(likelihood)
    if languages > 1:
        overall, _ = mixture(likelihood, counts, np.full(languages, 1 / languages))
        penalty = 0.5 * np.log(max(counts.sum() / TRIGRAM_CHARS, 2))
        for candidate in np.argsort(-overall, kind="stable"):
            if candidate == best:
                continue
            tried = [*chosen, int(candidate)]
            start = np.full(len(tried), 1 / len(tried))
            tried_shares, tried_score = mixture(likelihood[tried], counts, start)
            if (tried_score - score) / TRIGRAM_CHARS <= penalty:
                break
            chosen, shares, score = tried, tried_shares, tried_score
    return sorted(((c, float(s)) for c, s in zip(chosen, shares)), key=lambda x: (-x[1], x[0]))


def identify(
    df: DataFrame, model: tuple[list[str], np.ndarray], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, ``lang_pred``, ``score`` and ``languages``, the selected set with shares.

    Only key and text are read, so no label can reach a prediction.
    """
    spark = df.sparkSession
    names, probabilities = model
    shared = spark.sparkContext.broadcast(np.ascontiguousarray(probabilities))
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, table = Trigrams(), shared.value
        for batch in batches:
            predicted, scores, languages = [], [], []
            for body in texts_of(batch, text):
                found = trigrams.of(body) if names else None
                mixed = []
                if found is not None:
                    grams, counts = np.unique(found, return_counts=True)
                    mixed = infer(table[:, grams], counts.astype(float))
                predicted.append(names[mixed[0][0]] if mixed else UNKNOWN)
                scores.append(min(1.0, mixed[0][1]) if mixed else 0.0)
                languages.append([{"lang": names[i], "share": s} for i, s in mixed])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(predicted, pa.string()), pa.array(scores), pa.array(languages, kind)],
                [key, "lang_pred", "score", "languages"],
            )

    key_type = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    return df.select(key, text).mapInArrow(predict, schema)
