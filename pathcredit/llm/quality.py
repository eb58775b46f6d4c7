"""Quality classifier: averaged subword embeddings with a softmax output, trained by numpy SGD.

A document's features are its words, a word "same again" for each word equal to
the one before, and its character n-grams (code points, case kept), hashed into a
fixed number of buckets; each bucket has a learned vector, a
document is the mean of its features' vectors, and a softmax over two classes
reads that mean. Training runs on the driver over a bounded sample: at most
``MAX_PER_CLASS`` labelled rows of each class, in the order of a hash of their
ids, each whole text reduced in its task to bucket counts, of which there are at most ``BUCKETS``. The output's bias is shifted from the sample's class shares to those of
all training labels.

Scoring needs, for two classes, only each bucket's difference of the two logits,
so the table sent to the tasks has one float per bucket. Every whole text is
read, in pieces cut at white space, so memory does not depend on its length.

Defined results: a null or empty text has no features and scores the bias alone;
null labels are ignored, conflicting ones count as 1; of an id's different texts one, the same in every run, is learned from; with labels of one class
only, or none, every score is the share of label 1 (0.5 without any); an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import crc32_of_id, whole_text

BUCKETS = 1 << 18
DIM = 16
GRAMS = (2, 3, 4)
EPOCHS = 6
RATE = 0.5
#: The sample's bound: labelled rows per class (all texts are scored).
MAX_PER_CLASS = 1500
THRESHOLD = 0.7
PIECE = 1 << 18
SAME = np.uint32(0)  # bucket of "the same word again"
_M = np.uint32(0x9E3779B1)  # odd multiplier of the rolling hashes


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE characters, cut at white space where there is some."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end))
            end = cut if cut > at else end
        yield text[at:end]
        at = end


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint32(15))
    h *= np.uint32(0x85EBCA6B)
    return (h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1)


def piece_features(piece: str) -> Iterator[np.ndarray]:
    """Bucket numbers of a piece: arrays for its words, for repeats of the word before, for each n-gram length."""
    codes = np.frombuffer(f" {piece} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    space = codes <= 32
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if len(starts):
        place = np.arange(len(codes), dtype=np.uint32)
        nearest = np.zeros(len(codes), np.uint32)
        nearest[starts] = starts
        place -= np.maximum.accumulate(nearest)  # position inside the word
        chars = np.where(space, np.uint32(0), (codes + np.uint32(7)) * (place * _M | np.uint32(1)) ^ (codes << np.uint32(9)))
        words = _mix(np.add.reduceat(chars, starts, dtype=np.uint32) * _M + np.uint32(1))
        yield words
        yield words[1:][words[1:] == words[:-1]] * np.uint32(0) + SAME
    rolled = codes * _M
    for n in range(2, max(GRAMS) + 1):
        rolled = (rolled[:-1] ^ (rolled[:-1] >> np.uint32(16))) * _M + codes[n - 1:]
        if n in GRAMS and len(rolled):
            yield _mix(rolled + np.uint32(n))


def bucket_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their counts."""
    total = np.zeros(BUCKETS, np.int32) if len(text) > PIECE else None
    found = []
    for piece in _pieces(text):
        for f in piece_features(piece):
            if total is None:
                found.append(f)
            else:
                total += np.bincount(f, minlength=BUCKETS).astype(np.int32)
    if total is not None:
        buckets = np.flatnonzero(total)
        return buckets.astype(np.int32), total[buckets]
    buckets, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint32), return_counts=True)
    return buckets.astype(np.int32), counts.astype(np.int32)


@dataclass
class Model:
    """Difference of the two classes' logits: per bucket (averaged over a text), and the bias."""

    delta: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        total, n = 0.0, 0
        for piece in _pieces(text):
            for f in piece_features(piece):
                total += float(self.delta[f].sum(dtype=np.float64))
                n += len(f)
        z = self.bias + (total / n if n else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -700, 700))))


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], share: float, dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 7) -> Model:
    """SGD over (buckets, counts, label); ``share`` is label 1's share among all training labels."""
    ones = sum(y for _, _, y in samples)
    prior = float(np.log(share) - np.log1p(-share)) if 0 < share < 1 else 0.0
    if ones in (0, len(samples)):
        flat = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(flat / (1 - flat))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            buckets, counts, y = samples[i]
            step = rate * (1 - done / steps)
            done += 1
            if not len(buckets):
                continue
            weight = (counts / counts.sum()).astype(np.float32)
            hidden = weight @ vectors[buckets]
            logits = out @ hidden + bias
            p = np.exp(logits - logits.max())
            error = -p / p.sum()
            error[y] += 1
            back = error @ out
            out += step * np.outer(error, hidden)
            bias += step * error
            # As is usual for averaged features, the mean's gradient goes to each of them unscaled.
            vectors[buckets] += step * np.minimum(weight * len(buckets), 8)[:, None] * back
    sampled = float(np.log(ones) - np.log(len(samples) - ones))
    return Model((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]) + prior - sampled)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    learn: Column, max_per_class: int) -> tuple[list, float]:
    """At most ``max_per_class`` labelled texts per class as bucket counts, and label 1's share of all."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    known = known.where(learn)
    sizes = dict(known.groupBy("y").count().collect())
    if not sizes:
        return [], 0.5
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_per_class) for y in (0, 1)]
    ids = chosen[0].union(chosen[1])  # at most 2 * max_per_class rows

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bucket_counts(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b for b, _ in found], pa.list_(pa.int32())),
                 pa.array([c for _, c in found], pa.list_(pa.int32())), batch.column(2)],
                ["id", "buckets", "counts", "y"])
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    rows = texts.join(F.broadcast(ids), "id").mapInArrow(
        features, f"id {id_type}, buckets array<int>, counts array<int>, y int").toArrow()
    samples = {}  # repeated rows of an id are one sample; of an id's different texts the one whose features come first
    for at in range(rows.num_rows):
        i, found = rows["id"][at].as_py(), [rows[c][at].values.to_numpy() for c in ("buckets", "counts")]
        if i not in samples or [x.tolist() for x in found] < [x.tolist() for x in samples[i][:2]]:
            samples[i] = (*found, rows["y"][at].as_py())
    return [samples[i] for i in sorted(samples)], sizes.get(1, 0) / sum(sizes.values())


HeldOut = Callable[[Column], Column]


def third_quarter(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2."""
    return crc32_of_id(doc_id) % 4 == 2


def scorer(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", held_out: HeldOut = third_quarter,
           max_per_class: int = MAX_PER_CLASS) -> Column:
    """A trained model as a column: the score of ``text_col``. Held-out rows' labels are never learned from."""
    learn = ~held_out(F.col("id"))
    model = train(*training_sample(docs, labels, id_col, text_col, label_col, learn, max_per_class))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(sent.value.score).astype("float64")
    return score(whole_text(text_col))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", held_out: HeldOut = third_quarter,
                  max_per_class: int = MAX_PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``."""
    score = scorer(docs, labels, id_col, text_col, label_col, held_out, max_per_class)
    return docs.select(id_col, held_out(F.col(id_col)).alias("held_out"), score.alias("score")).select(
        "*", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD,
                   **options) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns kept."""
    return docs.where(scorer(docs, labels, text_col=text_col, **options) >= threshold)
