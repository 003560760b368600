"""Language identification with string kernels.

A text is the set of byte n-grams of several lengths that occur in it (a
blended spectrum of presences). The kernel of two texts is the size of their
common set over the geometric mean of their sizes. Kernel ridge regression, one
language against the rest, runs on a Nystroem approximation: a few landmark
texts stand for the whole kernel matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetflow.llm.common import keep_rows, keyed_bytes, per_text
from sheetflow.operators.keyed import quoted

LENGTHS = (1, 2, 3, 4)
SLOTS = 1 << 17  # n-grams that share a hash slot count as one

# ASCII letters in lower case and all bytes beyond ASCII; everything else is a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
UNKNOWN = "und"


def gram_slots(text: bytes, flags: np.ndarray) -> np.ndarray:
    """Sorted slots of the n-grams that occur in the whole text. ``flags``: SLOTS zeros, zeros again afterwards."""
    b = np.frombuffer(b" " + text.translate(LETTERS) + b" ", np.uint8).astype(np.uint32)
    code = np.zeros(len(b), np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        if len(b) < n:
            break
        code = (code[: len(b) - n + 1] * np.uint32(0x01000193)) ^ b[n - 1 :]
        if n in LENGTHS:
            mixed = (code + np.uint32(n)) * np.uint32(0x9E3779B1)
            flags[(mixed ^ (mixed >> np.uint32(15))) & np.uint32(SLOTS - 1)] = True
    found = np.flatnonzero(flags).astype(np.int32)
    flags[found] = False
    return found


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


@dataclass(frozen=True)
class Model:
    """``weights``: SLOTS x languages, the landmarks' product with the ridge solution; scores are sums of its rows."""

    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
    rows_per_language: int = 400, landmarks_per_language: int = 48, ridge: float = 1e-3,
) -> Model | None:
    """Learn from rows with a label, a key and a letter; None if there are none.

    Learns from at most ``rows_per_language`` rows of each label, those with
    the smallest hashes of their keys; the driver sees only the slots of their
    n-grams. Repeated rows count as often as they are drawn.
    """
    known = docs.filter(quoted(label).isNotNull() & quoted(key).isNotNull() & has_letter(quoted(text)))
    place = F.pmod(F.xxhash64(quoted(key)), F.lit(1 << 40))
    counts = {r[0]: r[1] for r in known.groupBy(quoted(label)).count().collect()}
    if not counts:
        return None
    # about twice the bound, so that the smallest hashes of each label are there
    limits = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, int(min(1, 2 * rows_per_language / n) * (1 << 40)))])
    drawn = known.filter(place <= limits[quoted(label)]).select(
        F.struct(place.alias("place"), quoted(label).alias("label")).alias("key"), quoted(text).cast("binary").alias("text")
    )

    def work(batches):
        import pyarrow as pa

        flags = np.zeros(SLOTS, bool)
        for b in batches:
            keys = b.column(0).flatten()
            slots = [gram_slots(t, flags).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(slots, pa.binary())], names=["place", "label", "slots"])

    rows = sorted(map(tuple, drawn.mapInArrow(work, "place long, label string, slots binary").collect()))
    languages = tuple(sorted(counts))
    chosen = [[r for r in rows if r[1] == name][:rows_per_language] for name in languages]
    sample = [(name, np.frombuffer(r[2], np.int32)) for name, part in zip(languages, chosen, strict=True) for r in part]
    marks = [np.frombuffer(r[2], np.int32) for part in chosen for r in part[:landmarks_per_language]]
    return _solve(languages, sample, marks, ridge)


def _solve(languages, sample, marks, ridge: float) -> Model:
    # one byte for each n-gram of a landmark: this matrix is the largest thing on the driver
    landmarks = np.zeros((len(marks), SLOTS), np.uint8)
    for row, slots in zip(landmarks, marks, strict=True):
        row[slots] = 1
    size = np.sqrt([len(m) for m in marks])

    def kernel(slots: np.ndarray) -> np.ndarray:
        return landmarks[:, slots].sum(axis=1, dtype=np.int64) / size / np.sqrt(len(slots))

    between = np.array([kernel(m) for m in marks])
    value, vector = np.linalg.eigh((between + between.T) / 2)
    use = value > 1e-8 * value[-1]
    root = vector[:, use] / np.sqrt(value[use])  # K_mm ** -1/2 on its range
    mapped = np.array([kernel(s) for _, s in sample]) @ root
    mean = mapped.mean(axis=0)
    target = np.array([[float(name == x) for x in languages] for name, _ in sample])
    centred = mapped - mean
    gram = centred.T @ centred + ridge * len(sample) * np.eye(centred.shape[1])
    solution = root @ np.linalg.solve(gram, centred.T @ (target - target.mean(axis=0)))
    bias = target.mean(axis=0) - mean @ np.linalg.solve(gram, centred.T @ (target - target.mean(axis=0)))
    scaled = (solution / size[:, None]).astype(np.float32)
    step = SLOTS // 32
    weights = [landmarks[:, at : at + step].T.astype(np.float32) @ scaled for at in range(0, SLOTS, step)]
    return Model(languages, np.concatenate(weights), bias)


def identify(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", unknown: str = UNKNOWN) -> DataFrame:
    """Key, lang_pred and score (0 to 1) of every row, from the whole text alone.

    Null texts and texts without a letter are ``unknown`` with score 0, as is
    everything without a model. Equal scores go to the first language by name.
    Rows of equal key each give a row; other columns are ignored. No shuffle:
    a batch of texts is scored by one product of its presence rows with the
    weights, whose size is fixed by SLOTS and the number of languages.
    """
    rows = keyed_bytes(docs, key, text)
    rows = rows.withColumn("text", F.when(has_letter(F.col("text").cast("string")), F.col("text")))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(pairs) -> Iterator[dict[str, list]]:
        flags = np.zeros(SLOTS, bool)
        for keys, texts in pairs:
            names, scores = _score(shared.value, texts, flags, unknown)
            yield {"key": keys, "lang_pred": names, "score": scores}

    return per_text(rows, work, "key long, lang_pred string, score double").withColumnRenamed("key", key)


def _score(m: Model | None, texts: list, flags: np.ndarray, unknown: str) -> tuple[list[str], list[float]]:
    names, scores = [unknown] * len(texts), [0.0] * len(texts)
    at = [i for i, t in enumerate(texts) if t is not None] if m else []
    for first in range(0, len(at), 256):
        part = at[first : first + 256]
        slots = [gram_slots(texts[i], flags) for i in part]
        sizes = np.array([len(s) for s in slots])
        begin = np.concatenate(([0], np.cumsum(sizes[:-1])))
        sums = np.add.reduceat(m.weights[np.concatenate(slots)], begin, axis=0, dtype=np.float64)
        value = sums / np.sqrt(sizes)[:, None] + m.bias
        best = value.argmax(axis=1)
        for i, b, v in zip(part, best.tolist(), value.max(axis=1).tolist(), strict=True):
            names[i], scores[i] = m.languages[b], min(1.0, max(0.0, v))
    return names, scores


def keep_identified(docs: DataFrame, model: Model | None, text: str = "text", least: float = 0.2, unknown: str = UNKNOWN) -> DataFrame:
    """Rows whose text has a language: one is predicted, with a score of ``least`` or more. Without a model all rows go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge():
        flags = np.zeros(SLOTS, bool)

        def accept(texts: list) -> list[bool]:
            return [n != unknown and s >= least for n, s in zip(*_score(shared.value, texts, flags, unknown), strict=True)]

        return accept

    return keep_rows(docs, text, judge, has_letter(quoted(text).cast("string")))


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Rows that nothing may learn from: crc32 of the key as text, modulo ``folds``, is 0. A null key is not held out."""
    return F.coalesce(F.crc32(quoted(key).cast("string").cast("binary")) % folds == 0, F.lit(False))
