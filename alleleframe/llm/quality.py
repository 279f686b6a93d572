"""Quality classifier: learned vectors of hashed words and character n-grams.

A document is the mean of the vectors of its words, of the character n-grams of
its words (the white space beside a word counts as its boundary) and of its
repeated words; a softmax over two classes follows. Vectors and output weights
are learned with stochastic gradient descent in numpy, in one task, from at most
``MAX_TRAIN`` labelled documents: those whose ids have the smallest hashes. The
output is linear in the mean, so for scoring each bucket is reduced to one
number; that table of ``BUCKETS`` numbers goes to all executors, and documents
are scored where they are read, without a shuffle.

Labels, language, source and id are no inputs of a score. Rows held out (crc32
of the id as text, modulo 4, is 2) give no labels.

Nulls: a null or empty text has no features and gets the score of the bias; a
null ``doc_id`` has no label; a label other than 0 or 1, null too, is no label. Rows that repeat an id
are all scored, and all used if labelled. Without any label every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.llm.arrays import CHUNK, GAP, mixed, small_parts, spans, text_bytes, word_hashes
from alleleframe.llm.common import table, whole_text

#: Labelled documents used for learning, at most.
MAX_TRAIN = 6000
BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
SIZE = 8
EPOCHS = 12
RATE = 0.4
THRESHOLD = 0.7
SEED = 7
_REPEAT = np.uint64(0x5EED)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Parts of the texts and the row of each byte; long texts are cut at white space, which both sides keep."""
    for first, last in spans(offsets):
        begin, end = int(offsets[first]), int(offsets[last])
        if last > first + 1 or end - begin <= CHUNK:
            lengths = np.diff(offsets[first : last + 1])
            yield data[begin:end], np.repeat(np.arange(first, last), lengths)
            continue
        while begin < end:
            gap = np.flatnonzero(GAP[data[begin + CHUNK : end]])
            stop = begin + CHUNK + int(gap[0]) if len(gap) else end
            yield data[begin : min(stop + 1, end)], np.full(min(stop + 1, end) - begin, first)
            begin = stop if stop < end - 1 else end


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and buckets of all features, in parts."""
    mask = np.uint64(BUCKETS - 1)
    words, marks = word_hashes(data, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(marks))
    yield row, (words & mask).astype(np.int64)
    if len(words):
        again = np.flatnonzero((words[1:] == words[:-1]) & (row[1:] == row[:-1]))
        yield row[again + 1], np.full(len(again), int(mixed(np.array([_REPEAT]))[0] & mask))
    for part, row in _pieces(data, offsets):
        gap = GAP[part]
        wide = np.where(gap, 32, part).astype(np.uint32)
        for n in GRAMS:
            size = len(part) - n + 1
            if size <= 0:
                continue
            valid = row[:size] == row[n - 1 :]
            for k in range(1, n - 1):
                valid &= ~gap[k : k + size]
            at = np.flatnonzero(valid)
            code = np.full(len(at), n, np.uint32)
            for k in range(n):
                code = (code ^ wide[at + k]) * np.uint32(16777619)
            code ^= code >> np.uint32(15)
            code *= np.uint32(0x85EBCA6B)
            code ^= code >> np.uint32(13)
            yield row[at], (code & np.uint32(BUCKETS - 1)).astype(np.int64)


def learn(texts: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """One number per bucket and a bias: the log odds of label 1 are their mean plus the bias."""
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    output = np.zeros((2, SIZE), np.float32)
    bias = np.zeros(2, np.float32)
    docs = []
    for text in texts:
        found = [b for _, b in features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))]
        buckets, counts = np.unique(np.concatenate(found), return_counts=True)
        docs.append((buckets.astype(np.int32), np.minimum(counts, 65535).astype(np.uint16)))
    step, steps = 0, EPOCHS * len(docs)
    for _ in range(EPOCHS):
        for i in random.permutation(len(docs)).tolist():
            buckets, counts = docs[i]
            share = counts / np.float32(max(1, counts.sum(dtype=np.int64)))
            rate = RATE * (1 - step / steps)
            step += 1
            some = vectors[buckets]
            mean = share @ some
            logit = output @ mean + bias
            chance = np.exp(logit - logit.max())
            error = chance / chance.sum()
            error[labels[i]] -= 1
            back = output.T @ error
            output -= rate * np.outer(error, mean)
            bias -= rate * error
            # Every feature of the document moves alike, as often as it occurs.
            vectors[buckets] = some - (rate * np.minimum(1, 50 * share))[:, None] * back
    return vectors @ (output[1] - output[0]), float(bias[1] - bias[0])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Bucket numbers and bias from at most ``max_train`` labelled rows that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").alias("of"), F.col("quality").cast("int").alias("label"))
    # At most max_train ids and labels, so every executor can hold them.
    known = known.orderBy(F.xxhash64("of"), "of", "label").limit(max_train)
    sample = docs.select("doc_id", whole_text().cast("binary").alias("text")).join(
        F.broadcast(known), F.col("doc_id") == F.col("of")
    )
    sample = sample.orderBy(F.xxhash64("of"), "of", "label", "text").limit(max_train)

    def fit(batches):
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        rows.sort()
        if rows:
            weights, bias = learn([r[2] for r in rows], np.array([r[1] for r in rows]))
            model = weights.astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([model], pa.binary()), pa.array([bias])], names=["weights", "bias"]
            )

    fitted = sample.select("of", "label", "text").coalesce(1).mapInArrow(fit, "weights binary, bias double")
    found = fitted.first()
    if found is None:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(found.weights, "<f4"), found.bias


def scored(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """row (all columns of ``docs``) and score."""
    rows = docs.select(F.struct("*").alias("row"), whole_text().alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        weights, bias = sent.value
        for batch in (part for whole in batches for part in small_parts(whole)):
            data, offsets = text_bytes(batch.column("text"))
            total = np.zeros(batch.num_rows)
            count = np.zeros(batch.num_rows)
            for row, buckets in features(data, offsets):
                total += np.bincount(row, weights[buckets], minlength=len(total))
                count += np.bincount(row, minlength=len(count))
            odds = total / np.maximum(count, 1) + bias
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(1 / (1 + np.exp(-odds)))], names=["row", "score"]
            )

    return rows.mapInArrow(score, schema)


def without_rejected(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, with their columns."""
    return scored(docs, train(docs, labels)).where(F.col("score") >= threshold).select("row.*")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
