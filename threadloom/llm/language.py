"""Language of a text: a blended-spectrum kernel, Nyström landmarks, kernel ridge regression.

Two texts are alike as far as they share n-grams (presence, for each n, scaled by the numbers of both
and added up). Sampled landmarks span the kernel's feature space; one-versus-rest ridge regression over a
sample of labelled texts weighs them. A block of texts is scored by a few matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from threadloom.llm.arrow import add_columns, raw

#: Labelled texts that the classifier is fitted on, about, for each language, and landmarks in all.
SAMPLE_PER_LANGUAGE = 500
LANDMARKS = 240
#: An n-gram counts if so many landmarks hold it.
LEAST_HOLDERS = 3
RIDGE = 1e-3
SHARPNESS = 6.0
MOST_ROWS = 512
SIZES = (1, 2, 3)
UNKNOWN = "und"
#: Lower case for ASCII; anything there that is no letter becomes a blank. Other bytes stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def codes(text: bytes) -> list[np.ndarray]:
    """Codes of the n-grams of a text, repeats included, for each n; blanks count as one."""
    folded = b" " + b" ".join(text.translate(FOLD).split()) + b" "
    grams = [np.frombuffer(folded, np.uint8).astype(np.int32)]
    for n in SIZES[1:]:
        grams.append(grams[-1][:-1] << 8 | grams[0][n - 1 :])
    return grams


def has_letter(text: bytes) -> bool:
    if text.translate(FOLD).isspace() or not text:
        return False
    return any(97 <= b <= 122 for b in text[:64].lower()) or any(c.isalpha() for c in text.decode("utf-8", "ignore"))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    vocabulary: list[np.ndarray]
    landmarks: list[np.ndarray]
    weights: np.ndarray


def presence(texts: list[list[np.ndarray]], vocabulary: list[np.ndarray], tables: list[np.ndarray]) -> list[np.ndarray]:
    made = []
    for n, (words, column) in enumerate(zip(vocabulary, tables)):
        flags = np.zeros((len(texts), len(words) + 1), np.float32)
        for row, grams in zip(flags, texts):
            row[column[grams[n]]] = 1
        made.append(flags[:, :-1])
    return made


def columns(vocabulary: list[np.ndarray]) -> list[np.ndarray]:
    """For each n, the column of every n-gram; the last column for those that do not count."""
    tables = []
    for n, words in zip(SIZES, vocabulary):
        table = np.full(1 << 8 * n, len(words), np.int16 if len(words) < 32767 else np.int32)
        table[words] = np.arange(len(words))
        tables.append(table)
    return tables


def kernel(rows: list[np.ndarray], landmarks: list[np.ndarray]) -> np.ndarray:
    total = 0
    for x, y in zip(rows, landmarks):
        norm = np.sqrt(np.maximum(x.sum(1), 1))[:, None] * np.sqrt(np.maximum(y.sum(1), 1))
        total = total + (x @ y.T) / norm
    return total / len(SIZES)


def fit(docs: DataFrame, text: str = "text", language: str = "lang", row_key: str = "doc_id") -> Model | None:
    """A model from rows with a language; None if there are none.

    About ``SAMPLE_PER_LANGUAGE`` rows of each language are taken by a hash of ``row_key`` and text, whatever the
    size of the table, and rows that repeat both count once, so no repeated or missing key makes the sample larger. Tasks reduce them to their sets of n-grams, so no text reaches the driver. The number of
    languages is taken to be small.
    """
    named = docs.select(
        F.col(language).alias("language"), F.xxhash64(F.col(row_key), F.col(text), F.lit(1)).alias("h"), F.col(text).alias("text")
    ).filter("language IS NOT NULL AND text IS NOT NULL")
    counts = {r["language"]: r["count"] for r in named.groupBy("language").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    million = 1_000_000
    part = F.lit(0)
    for name in languages:
        share = min(million, -(-million * SAMPLE_PER_LANGUAGE // counts[name]))
        part = F.when(F.col("language") == name, share).otherwise(part)
    chosen = named.filter(F.pmod("h", F.lit(million)) < part).select("language", "h", "text").dropDuplicates(["language", "h"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                grams = [np.unique(g) for g in codes(raw(one.column(2))[0])]
                lists = [pa.array([g], pa.list_(pa.int32())) for g in grams]
                yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), *lists], ["language", "h", *"abc"])

    schema = "language string, h long, a array<int>, b array<int>, c array<int>"
    rows = chosen.mapInArrow(sets, schema).toArrow().sort_by([("h", "ascending"), ("language", "ascending")])
    label = np.array([languages.index(x) for x in rows["language"].to_pylist()], int)
    if not len(label):
        return None
    grams = [[np.array(rows[c][i].values) for c in "abc"] for i in range(len(label))]
    each = max(1, LANDMARKS // len(languages))
    chosen_rows = np.concatenate([np.flatnonzero(label == k)[:each] for k in range(len(languages))])
    vocabulary = []
    for n in range(len(SIZES)):
        found, holders = np.unique(np.concatenate([grams[i][n] for i in chosen_rows]), return_counts=True)
        vocabulary.append(found[holders >= min(LEAST_HOLDERS, len(chosen_rows))])
    tables = columns(vocabulary)
    marks = presence([grams[i] for i in chosen_rows], vocabulary, tables)
    near = np.vstack(
        [kernel(presence(grams[a : a + MOST_ROWS], vocabulary, tables), marks) for a in range(0, len(grams), MOST_ROWS)]
    )
    values, vectors = np.linalg.eigh(near[chosen_rows].astype(float))
    good = values > 1e-6 * max(values[-1], 1e-9)
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.hstack([near @ root, np.ones((len(near), 1))])
    target = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Languages weigh alike, however many rows of each were found.
    weight = (1.0 / np.bincount(label, minlength=len(languages)))[label][:, None]
    system = features.T @ (weight * features) + RIDGE * np.eye(features.shape[1])
    solved = np.linalg.solve(system, features.T @ (weight * target))
    weights = np.vstack([root @ solved[:-1], solved[-1:]])
    return Model(languages, vocabulary, marks, weights.astype(np.float32))


def identify(
    docs: DataFrame, model: Model | None, text: str = "text", out: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``docs`` with the language of each whole text and a score from 0 to 1.

    Texts that are null or hold no letter are ``und`` with score 0, as are all without a model; of equal
    languages the first by name wins. Columns of the two names are replaced.
    """

    def make():
        tables = columns(model.vocabulary) if model else []

        def block(values: pa.Array) -> list[pa.Array]:
            texts = raw(values)
            names: list[str] = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if model and has_letter(t)]
            for a in range(0, len(known), MOST_ROWS):
                part = known[a : a + MOST_ROWS]
                near = kernel(presence([codes(texts[i]) for i in part], model.vocabulary, tables), model.landmarks)
                margins = SHARPNESS * (near @ model.weights[:-1] + model.weights[-1])
                odds = np.exp(margins - margins.max(1, keepdims=True))
                odds /= odds.sum(1, keepdims=True)
                scores[part] = odds.max(1)
                for i, best in zip(part, odds.argmax(1)):
                    names[i] = model.languages[best]
            return [pa.array(names, pa.string()), pa.array(scores)]

        return block

    return add_columns(docs, text, [StructField(out, StringType()), StructField(score, DoubleType())], make, 2 << 20)
