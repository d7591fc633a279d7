"""Operator 10, a quality classifier by nearest-neighbour voting in a latent-semantic space.

Fit: a bounded sample of labelled texts becomes a matrix of term weights; its leading singular
vectors span the latent space. Terms are trigrams of character shapes, hashed, and repetition of
words, which exist in any language. The sample's vectors (a bounded table) go to all tasks with
the closure. Score: every whole text is projected, compared with all sample vectors by blocked
cosine products, and its nearest neighbours vote with their similarity and the share of their class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lm_scoring import remainder
from .words import WordHasher

#: Labelled rows of each class that the fit takes at most, the first by a hash of their id.
FIT_ROWS = 2000
TERMS = 1024
EXTRA = 4
LATENT = 48
NEIGHBOURS = 25
#: Documents of one product with all sample vectors.
BLOCK = 512
STEP_BYTES = 1 << 20


def shape_table() -> np.ndarray:
    """A shape number below 64 for every byte: letters by case, digits, and other characters."""
    table = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        table[b] = (1 if "a" <= c <= "z" or b >= 128 else 2 if "A" <= c <= "Z"
                    else 3 if c.isdigit() else 4 if c.isspace() else 5 + b % 59)
    return table


class Features:
    """Term weights of texts: the logarithm of the rate of each term."""

    def __init__(self):
        self.shapes, self.words = shape_table(), WordHasher(lower=True)

    def __call__(self, texts) -> np.ndarray:
        import pyarrow as pa
        out = np.zeros((len(texts), TERMS + EXTRA), np.float32)
        found, counts = self.words.words(texts)
        bounds = np.cumsum(counts)
        for i, value in enumerate(texts):
            data = np.frombuffer(value.as_buffer() or b"", np.uint8) if value.is_valid else (
                np.empty(0, np.uint8))
            # Pieces overlap by two bytes, so that every trigram of the whole text counts once.
            total = np.zeros(TERMS, np.int64)
            for at in range(0, max(len(data) - 2, 0), STEP_BYTES):
                shape = self.shapes[data[at:at + STEP_BYTES + 2]]
                term = (shape[:-2] * 4096 + shape[1:-1] * 64 + shape[2:]) * 2654435761
                total += np.bincount((term >> 12) % TERMS, minlength=TERMS)
            out[i, :TERMS] = np.log1p(total * (1000.0 / max(len(data), 20)))
            own = found[bounds[i] - counts[i]:bounds[i]]
            if len(own) > 1:
                again = float((own[1:] == own[:-1]).mean())
                pairs = own[1:] * np.uint64(31) + own[:-1]
                out[i, TERMS:] = (again, len(np.unique(own)) / len(own),
                                  len(np.unique(pairs)) / len(pairs), min(len(own), 100) / 100)
        return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, features: np.ndarray) -> np.ndarray:
        at = ((features - self.mean) / self.scale) @ self.basis
        return at / np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-9)

    def score(self, features: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the share of label 1 where there is nothing to compare with."""
        out = np.full(len(features), self.prior)
        if not len(self.labels):
            return out
        ones = max(self.labels.mean(), 1e-9), max(1 - self.labels.mean(), 1e-9)
        share = np.where(self.labels == 1, self.prior / ones[0], (1 - self.prior) / ones[1])
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(features), BLOCK):
            near = self.latent(features[at:at + BLOCK]) @ self.vectors.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, top, 1), 0) ** 4 * share[top]
            total = weight.sum(axis=1)
            vote = (weight * self.labels[top]).sum(axis=1) / np.maximum(total, 1e-12)
            out[at:at + BLOCK] = np.where(total > 1e-12, vote, self.prior)
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, fit_rows: int = FIT_ROWS,
        doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on labelled rows whose crc32 of the id modulo ``modulus`` is not 0.

    At most ``fit_rows`` per class, the first by a hash of the id, so any rerun takes the same. An id
    with labels of both classes is no example. Shares of the classes are those of all such labels.
    """
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("m"))
             .where("quality = m").drop("m").where(remainder(F.col("doc_id"), modulus) != 0))
    counts = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    prior = counts.get(1, 0) / max(sum(counts.values()), 1) if counts else 0.5
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = [known.where(F.col("quality") == c).orderBy(*order).limit(fit_rows) for c in (0, 1)]
    sample = sample[0].unionByName(sample[1]).withColumnRenamed("doc_id", "of")
    # Of a bounded number of rows, so it may be broadcast.
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    chosen = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("of"))

    def run(batches) -> Iterator:
        import pyarrow as pa
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                stored = [f.tobytes() for f in features(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(stored, pa.binary())],
                    names=["doc_id", "quality", "features"])

    got = chosen.select("doc_id", "text", "quality").mapInArrow(
        run, "doc_id long, quality int, features binary")
    # Rows that repeat an id count once: of their texts the first in order.
    got = got.groupBy("doc_id", "quality").agg(F.min("features").alias("features"))
    data = sorted(got.collect())
    width = TERMS + EXTRA
    x = np.frombuffer(b"".join(bytes(r[2]) for r in data), np.float32).reshape(-1, width)
    labelled = np.array([r[1] for r in data], np.int64)
    if not len(x):
        return Model(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros((0, 1)),
                     labelled, prior)
    mean = x.mean(axis=0)
    scale = x.std(axis=0) + 0.05
    scale[TERMS:] /= 8  # repetition counts as much as a few dozen terms
    centred = (x - mean) / scale
    values, vectors = np.linalg.eigh(centred.T.astype(np.float64) @ centred)
    basis = vectors[:, ::-1][:, :LATENT].astype(np.float32)
    model = Model(mean, scale, basis, np.zeros((0, 1)), labelled, prior)
    model.vectors = model.latent(x).astype(np.float32)
    return model


def classify(docs: DataFrame, model: Model, modulus: int = 5, threshold: float = 0.3,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every column of ``docs`` is dropped but the id: ``doc_id, held_out, score, predicted``.

    Scores depend on the text alone. A null or empty text is scored like any other. Equal texts have
    equal scores. A null id is held out as crc32 of the empty text says (0: held out). Rows that
    repeat are scored as often. A very long text is read whole. Of neighbours at equal similarity the
    order of the labelled rows decides. An empty table gives no rows; without labelled rows every score is
    the share of label 1, or 0.5.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"),
                       (remainder(docs[doc_id], modulus) == 0).alias("held_out"))

    def run(batches) -> Iterator:
        import pyarrow as pa
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                scores = np.round(model.score(features(part.column(1))), 9)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(scores.astype(np.float64)),
                     pa.array((scores >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3,
             text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``threshold`` or more."""
    def run(batches) -> Iterator:
        import pyarrow as pa
        features = Features()
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                keep = np.round(model.score(features(part.column(at))), 9) >= threshold
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
