"""Masked pseudo-likelihood scores of documents by a bidirectional window network.

Every word of the corpus is counted into hashed buckets, whose number grows with the square root of
the corpus, as vocabularies do. The most frequent buckets become classes of their own, the others
share classes of about equal weight with buckets of like frequency, so that context tells how rare a
word to expect; within a class a bucket has its corpus frequency.
A small network reads the classes of two words on the left and two on the right of a masked word
and predicts its class. It is trained in numpy on all documents, one seventh of the positions
masked in each of seven rounds, so that every position is a target once: each task trains its own
copy on its rows, and copies are averaged by their number of positions, added up in the order of
the tasks. A document's score is the sum over all its words of

    log p(class | words on both sides) + log p(bucket | class).

Defined cases: a null or empty text, or one without words, scores 0 with 0 tokens and a null
mean; null and repeated doc_ids are scored row by row; ties in frequency go to the smaller bucket;
a very long text is scored whole in one task, in memory that follows its length; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import WordHashes, slices, stored, texts_of
from tablewright.runtime import ship_package

CLASSES, OWN = 128, 96
#: The number of buckets lies between these; at the most, 128 MB of counts reach the driver.
FEWEST, MOST = 1 << 16, 1 << 23
REACH, HIDDEN, MASKED = 2, 24, 7
#: Bytes of hashed() words that are looked at together.
SLICE = 4_000_000
OFFSETS = (-2, -1, 1, 2)
_words = WordHashes()


def buckets_of(text: str, size: int) -> np.ndarray:
    return (_words.of(text.encode("utf-8").lower().split()) % np.uint64(size)).astype(np.int64)


def bucket_number(docs: DataFrame) -> int:
    """A power of two, at least eleven times the square root of the corpus' characters."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return min(MOST, max(FEWEST, 1 << math.ceil(math.log2(11 * math.sqrt(chars) + 1))))


def hashed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, buckets (four bytes for each word) of texts, or rows that have them already."""
    if "buckets" in docs.columns:
        return docs

    def found(records):
        for record in (part for r in records for part in slices(r)):
            own = [buckets_of(t, size).astype(np.int32).tobytes() for t in record.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([record.column("doc_id"), pa.array(own, pa.binary())], names=["doc_id", "buckets"])

    return docs.mapInArrow(found, "doc_id long, buckets binary")


def count_buckets(docs: DataFrame, size: int = 0) -> np.ndarray:
    """How often each bucket occurs in the whole corpus of texts, or of hashed() ones into ``size``
    buckets; the driver gets MOST numbers at most."""
    size = size or bucket_number(docs)

    def counts(records):
        total = np.zeros(size, np.int64)
        for record in (part for r in records for part in slices(r, SLICE, "buckets")):
            total += np.bincount(np.frombuffer(b"".join(record.column("buckets").to_pylist()), np.int32), minlength=size)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["bucket", "n"])

    out = np.zeros(size, np.int64)
    summed = hashed(docs, size).select("buckets").mapInArrow(counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = summed.toArrow()
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each bucket, log p(bucket | class), and log p(class); counts are smoothed by one."""
    smooth = counts + 1.0
    order = np.argsort(-counts, kind="stable")
    kind = np.empty(len(counts), np.int64)
    kind[order[:OWN]] = np.arange(OWN)
    weight = smooth[order[OWN:]]
    kind[order[OWN:]] = OWN + ((np.cumsum(weight) - weight / 2) / weight.sum() * (CLASSES - OWN)).astype(np.int64)
    total = np.bincount(kind, smooth, CLASSES)
    return kind.astype(np.uint8), np.log(smooth / total[kind]).astype(np.float32), np.log(np.maximum(total, 1) / total.sum())


class Network:
    """tanh(sum of one embedding per context place) to class probabilities; Adagrad steps."""

    SHAPES = ((len(OFFSETS), CLASSES + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,))

    def __init__(self, flat: np.ndarray, kind: type = np.float32):
        self.parts, start = [], 0
        for shape in self.SHAPES:
            size = int(np.prod(shape))
            self.parts.append(flat[start : start + size].astype(kind).reshape(shape).copy())
            start += size
        self.squares = [np.full(s, 1e-3, np.float32) for s in self.SHAPES]
        self.onto = np.zeros((CLASSES + 1, 0), np.float32)  # all zeros between steps
        self.room: list[np.ndarray] = []

    @classmethod
    def start(cls, prior: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(7)
        parts = [random.normal(0, 0.1, s) for s in cls.SHAPES]
        parts[1][:] = 0
        parts[3] = prior
        return np.concatenate([p.ravel() for p in parts])

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def logits(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and logits of all classes, 0 at most; context: a row for each position. Both
        stand in memory that the next call uses again."""
        embed, bias, out, prior = self.parts
        if not self.room or len(self.room[0]) < len(context):
            self.room = [np.empty((len(context), width), out.dtype) for width in (HIDDEN, HIDDEN, CLASSES)]
        hidden, more, logits = (r[: len(context)] for r in self.room)
        np.take(embed[0], context[:, 0], axis=0, out=hidden, mode="clip")
        hidden += bias
        for k in range(1, len(OFFSETS)):
            hidden += np.take(embed[k], context[:, k], axis=0, out=more, mode="clip")
        if out.dtype == np.float64:  # tanh as 1 - 2 / (exp(2x) + 1): numpy's own takes thrice as long there
            hidden *= 2
            np.exp(np.minimum(hidden, 80, out=hidden), out=hidden)
            hidden += 1
            np.divide(-2, hidden, out=hidden)
            hidden += 1
        else:
            np.tanh(hidden, out=hidden)
        np.matmul(hidden, out, out=logits)
        logits += prior
        logits -= logits.max(axis=1, keepdims=True)
        return hidden, logits

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and log probabilities of all classes."""
        hidden, logits = self.logits(context)
        return hidden.copy(), logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def target_logs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The log probability of one class at each position."""
        _, logits = self.logits(context)
        own = logits[np.arange(len(target)), target]
        return own - np.log(np.exp(logits, out=logits).sum(axis=1))

    def step(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        hidden, error = self.logits(context)
        np.exp(error, out=error)
        error /= error.sum(axis=1, keepdims=True)
        error[np.arange(len(target)), target] -= 1
        error /= len(target)
        inner = (error @ self.parts[2].T) * (1 - hidden**2)
        embed = np.zeros_like(self.parts[0])
        if self.onto.shape[1] < len(target):
            self.onto = np.zeros((CLASSES + 1, len(target)), np.float32)
        onto = self.onto[:, : len(target)]
        for k in range(len(OFFSETS)):
            ones = (context[:, k], np.arange(len(target)))
            onto[ones] = 1
            embed[k] = onto @ inner
            onto[ones] = 0
        for part, square, slope in zip(self.parts, self.squares, (embed, inner.sum(0), hidden.T @ error, error.sum(0)), strict=True):
            square += slope**2
            part -= rate * slope / np.sqrt(square)


def laid_out(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All documents' classes in one array with padding between them, and where the words are."""
    pad = bytes([CLASSES]) * REACH
    flat = np.frombuffer(pad + pad.join(rows) + pad, np.uint8).astype(np.int64)
    return flat, np.flatnonzero(flat != CLASSES)


def context_at(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([flat[at + o] for o in OFFSETS], axis=1)


def encode(docs: DataFrame, kind: np.ndarray, within: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, classes (a byte for each word), within (sum of log p(bucket | class)), of texts
    or hashed() ones."""
    sent = docs.sparkSession.sparkContext.broadcast((kind, within))

    def encoded(records):
        kind, within = sent.value
        for record in (part for r in records for part in slices(r, SLICE, "buckets")):
            own = [np.frombuffer(b, np.int32) for b in record.column("buckets").to_pylist()]
            columns = [pa.array([len(b) for b in own], pa.int64()), pa.array([kind[b].tobytes() for b in own], pa.binary()), pa.array([float(within[b].sum(dtype=np.float64)) for b in own], pa.float64())]
            yield pa.RecordBatch.from_arrays([record.column("doc_id"), *columns], names=["doc_id", "n_tokens", "classes", "within"])

    return hashed(docs, len(kind)).mapInArrow(encoded, "doc_id long, n_tokens long, classes binary, within double")


def trained(tokens: DataFrame, flat: np.ndarray, round_no: int, rate: float, batch: int = 2048) -> np.ndarray:
    """The average network after each task has trained a copy on its rows' masked positions."""
    sent = tokens.sparkSession.sparkContext.broadcast(flat)

    def train(records):
        net, random, n = Network(sent.value), np.random.default_rng(1000 + round_no), 0
        for record in records:
            flat, at = laid_out(record.column("classes").to_pylist())
            at = random.permutation(at[(at + round_no) % MASKED == 0])
            for start in range(0, len(at), batch):
                some = at[start : start + batch]
                net.step(context_at(flat, some), flat[some], rate)
            n += len(at)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([task % 64], pa.int32()), pa.array([task], pa.int32()), pa.array([float(n)]), pa.array([(net.flat().astype(np.float64) * n).tobytes()], pa.binary())], names=["part", "task", "weight", "params"])

    def added(pdf):
        pdf = pdf.sort_values("task")  # float sums in one order
        total = sum(np.frombuffer(p, np.float64) for p in pdf["params"])
        return pdf.iloc[:1].assign(weight=pdf["weight"].sum(), params=[total.tobytes()])

    schema = "part int, task int, weight double, params binary"
    rows = tokens.select("classes").mapInArrow(train, schema).groupBy("part").applyInPandas(added, schema).orderBy("part").collect()  # 64 rows at most
    weight = sum(r.weight for r in rows)
    return sum(np.frombuffer(bytes(r.params), np.float64) for r in rows) / weight if weight else flat


def score_documents(docs: DataFrame, rounds: int = MASKED, rate: float = 0.1) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (summed), mean_log_likelihood (per token)."""
    ship_package(docs.sparkSession)
    docs = texts_of(docs)
    size = bucket_number(docs)
    words = stored(hashed(docs, size), "lm-words")
    kind, within, prior = classes_of(count_buckets(words, size))
    tokens = stored(encode(words, kind, within), "lm-tokens")
    flat = Network.start(prior)
    for k in range(rounds):
        flat = trained(tokens, flat, k, rate / (1 + k / 2))
    sent = docs.sparkSession.sparkContext.broadcast(flat)

    def scored(records):
        # in double precision and summed as whole millionths: a float product's rounding depends on a
        # row's place in its batch, and equal texts get equal scores
        net = Network(sent.value, np.float64)
        for record in records:
            own = record.column("classes").to_pylist()
            flat, at = laid_out(own)
            logp = np.empty(len(at), np.int64)
            for start in range(0, len(at), 1024):  # few enough for the processor's cache
                some = at[start : start + 1024]
                logp[start : start + 1024] = np.rint(1e6 * net.target_logs(context_at(flat, some), flat[some]))
            ends = np.concatenate([[0], np.concatenate([[0], np.cumsum(logp)])[np.cumsum([len(o) for o in own])]]) if own else np.zeros(1)
            yield pa.RecordBatch.from_arrays([record.column("doc_id"), record.column("n_tokens"), pa.array(np.diff(ends) / 1e6 + record.column("within").to_numpy())], names=["doc_id", "n_tokens", "log_likelihood"])

    out = tokens.mapInArrow(scored, "doc_id long, n_tokens long, log_likelihood double")
    return out.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
