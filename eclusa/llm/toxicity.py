"""Toxicity of whole texts: the most toxic of all overlapping windows counts.

A bidirectional gated recurrent network with attention pooling over word and character
inputs (``gru``) is trained on a bounded sample of labelled rows and scores every window
of every text; a text's score is that of its greatest window, mapped to a chance. The map is
fitted to texts that their network has not learned from: one network for each fold, all of
them and the one that scores trained at the same time, each in a task of its own.

A null or empty text, or one without words, gets the score of the least toxic training
text. Repeated rows are each scored. Rows with a null label are not learned from; of
several labels of one id each counts. Without labels of both classes every score is the
share of toxic rows (0 if there are none).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from eclusa.llm import words as W
from eclusa.llm.frames import free_name, held_out, map_batches, map_texts
from eclusa.llm.gru import Net, Scorer, calibrated, fold_logits, folds_of, train

# Labelled rows that are learned from, at most: those of the smallest hashes of their ids.
SAMPLE = 3_000
# Bytes of their whole texts, at most; of rows beyond, those of the greatest hashes stay out.
SAMPLE_BYTES = 64 * 1024 * 1024
THRESHOLD = 0.3
# Parts of the sample, each scored by a network trained on the others.
FOLDS = 4


def labelled(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
) -> tuple[list[str], np.ndarray]:
    """Whole texts and labels of a sample, equal texts once, without rows that are held out."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    marks = marks.filter(F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
    by = F.md5(F.col("doc_id").cast("string"))
    chosen = marks.select("doc_id", "y", by.alias("by")).orderBy("by", "y").limit(sample)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # At most ``sample`` ids are broadcast.
    found = rows.join(F.broadcast(chosen), "doc_id").groupBy("text").agg(
        F.max("y").alias("y"), F.min("by").alias("by")
    )
    # At most ``sample`` rows, too, unless ids repeat; their bytes are summed in one task.
    found = found.orderBy("by", "text").limit(sample)
    so_far = F.sum(F.octet_length("text")).over(Window.orderBy("by", "text"))
    kept = found.withColumn("so_far", so_far).filter(F.col("so_far") <= sample_bytes)
    got = kept.select("text", "y").orderBy("text").toArrow()
    return got["text"].to_pylist(), np.array(got["y"].to_pylist(), dtype=np.int64)


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts, as the scans take them."""
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(t) for t in raw])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), offsets


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Net:
    texts, y = labelled(documents, labels, label, sample)
    return trained(documents.sparkSession, texts, (y > 0).astype(np.int64))


def trained(spark: SparkSession, texts: list[str], y: np.ndarray, folds: int = FOLDS) -> Net:
    """The network trained on all texts, its chances from the folds'; the sample is broadcast."""
    shared = spark.sparkContext.broadcast((*joined(texts), y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k in (k for b in batches for k in b.column(0).to_pylist()):
            data, offsets, y = shared.value
            words = W.scan(data, offsets)
            own = folds_of(words, folds) == k
            got = (np.flatnonzero(own), fold_logits(words, y, own)) if k < folds else train(words, y)
            yield pa.RecordBatch.from_pydict({"k": [k], "got": [pickle.dumps(got)]})

    parts = spark.range(0, folds + 1, 1, folds + 1)
    got = {r.k: pickle.loads(r.got) for r in map_batches(parts, run, "k long, got binary").collect()}
    shared.destroy()
    logits = np.full(len(y), np.nan)
    for k in range(folds):
        own, values = got[k]
        logits[own] = values
    return calibrated(got[folds], logits, y)


def scored(documents: DataFrame, net: Net, text: str = "text") -> tuple[DataFrame, str]:
    """The documents with the column ``score``, or the next free name, which comes second."""
    name = free_name(documents.columns, "score")
    shared = documents.sparkSession.sparkContext.broadcast(net)

    def make():
        scorer = Scorer(shared.value)
        return lambda data, offsets: [pa.array(scorer.texts(W.scan(data, offsets)).astype(np.float64))]

    return map_texts(documents, text, make, [StructField(name, DoubleType())]), name


def without_toxic(
    documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """The documents whose score is under the threshold, columns as before."""
    found, score = scored(documents, fit(documents, labels))
    return found.filter(F.col(f"`{score}`") < threshold).drop(score)
