"""Quality classifier with supervised subword embeddings.

Every word, and every character n-gram of the word between two boundary marks, has a learned vector under a hashed
number. A document is the average of the vectors of all its words and n-grams; a softmax over two classes reads it. The
vectors and the output layer are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows.

The output layer is linear in the average, so for scoring a word is just two numbers: how many features it has, and the
sum of their margins. Whole texts of any length are scored in one pass over their words.
"""

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import batches, let_go, mix64, texts_of

BUCKETS = 1 << 17
NGRAMS = (3, 4, 5)
DIMENSIONS = 8
SAMPLE = 4_000  # labelled rows that the model is fitted to, taken in the order of a hash of the id
EPOCHS = 4
KNOWN_WORDS = 200_000
THRESHOLD = 0.3
REPEATED_WORD, REPEATED_LINE = b"\x01word again", b"\x01line again"  # hold a space, so no word is like them


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, and a marking word for every word that repeats the one before it and for every word of a line
    that was there before: repetition is no property of any word, so it gets a vector of its own."""
    words = text.split()
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    seen: set[bytes] = set()
    copied = 0
    for line in text.split(b"\n"):
        if line in seen:
            copied += len(line.split())
        seen.add(line)
    return words + [REPEATED_WORD] * again + [REPEATED_LINE] * copied


def features(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, number of features per word): the word itself, then its n-grams."""
    length = np.array([len(w) + 2 for w in words], np.int64)
    raw = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint64)
    starts = np.cumsum(length) - length
    word_of = np.repeat(np.arange(len(words)), length)
    place = np.arange(len(raw)) - starts[word_of]
    signed = mix64(raw + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(1))
    ids, owner = [np.add.reduceat(signed, starts)], [np.arange(len(words))]
    for n in NGRAMS:
        at = np.flatnonzero(place + n <= length[word_of])
        h = np.full(len(at), np.uint64(n))
        for i in range(n):
            h = (h ^ raw[at + i]) * np.uint64(0x100000001B3)
        ids.append(h)
        owner.append(word_of[at])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    numbers = (mix64(np.concatenate(ids)) % np.uint64(buckets)).astype(np.int64)[order]
    return numbers, np.bincount(owner, minlength=len(words))


@dataclass
class QualityModel:
    margins: np.ndarray  # per feature: its part of the difference of the two classes' outputs
    bias: float

    def scores(self, texts: list[bytes], known: dict[bytes, tuple[float, int]]) -> np.ndarray:
        """Probability of class 1 for every whole text; a text without words has the prior's. ``known`` is the caller's
        memory of words, emptied when it is full."""
        split = [tokens(t) for t in texts]
        new = [*{w for words in split for w in words if w not in known}]
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
            new = [*{w for words in split for w in words}]
        for i in range(0, len(new), 20_000):
            some = new[i : i + 20_000]
            ids, count = features(some, len(self.margins))
            total = np.add.reduceat(self.margins[ids], np.cumsum(count) - count)
            known.update(zip(some, zip(total.tolist(), count.tolist(), strict=True), strict=True))
        out = np.full(len(texts), self.bias)
        for i, words in enumerate(split):
            if words:
                x = np.array([known[w] for w in words])
                out[i] += x[:, 0].sum() / x[:, 1].sum()
        return 1 / (1 + np.exp(-out))


def bags(texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per text the distinct features and their shares of all its features."""
    ids, shares = [], []
    for t in texts:
        words = tokens(t)
        got, count = np.unique(features(words)[0], return_counts=True) if words else (np.zeros(0, np.int64),) * 2
        ids.append(got)
        shares.append((count / max(1, count.sum())).astype(np.float32))
    return ids, shares


def packed_ids(ids: np.ndarray) -> bytes:
    return zlib.compress(np.diff(ids.astype(np.int32), prepend=np.int32(0)).astype(np.int32).tobytes(), 1)


def train(
    bag_of: Callable[[int], tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    dimensions: int = DIMENSIONS,
    epochs: int = EPOCHS,
    rate: float = 0.5,
    seed: int = 3,
) -> QualityModel:
    """Stochastic gradient descent, one document a step, with a rate that falls to zero. ``bag_of`` gives the distinct
    features of a document and their shares."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, dimensions)).astype(np.float32) / dimensions
    out = np.zeros((2, dimensions), np.float32)
    prior = (np.bincount(labels, minlength=2) + 1) / (len(labels) + 2)
    bias = np.log(prior).astype(np.float32)
    steps, step = max(1, epochs * len(labels)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(labels)):
            now = rate * (1 - step / steps)
            step += 1
            ids, share = bag_of(int(k))
            share = share[:, None]
            hidden = (vectors[ids] * share).sum(axis=0)
            logits = out @ hidden + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[labels[k]] -= 1
            back = out.T @ error
            out -= now * error[:, None] * hidden
            bias -= 0.05 * now * error
            # the step of a feature is scaled by the number of features, as if each were seen alone
            vectors[ids] -= now * back * share * min(len(share), 300)
    return QualityModel((vectors @ (out[1] - out[0])).astype(np.float64), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fit to at most ``sample`` rows of ``labels(doc_id, label)``: those whose ids have the smallest hashes. Null ids,
    labels and texts are left out; a label is 0 or 1, or true or false. The texts are read whole, and turned into
    features where they are; only those reach the driver. Without any row the model scores 0.5."""
    chosen = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            ids, shares = bags(texts_of(part["text"]))
            packed = [(packed_ids(i), zlib.compress(s.tobytes(), 1)) for i, s in zip(ids, shares, strict=True)]
            columns = [part["doc_id"], part["label"], *(pa.array(c, pa.binary()) for c in zip(*packed, strict=True))]
            yield pa.record_batch(columns, ["doc_id", "label", "ids", "shares"])
        let_go()

    # at most `sample` small rows are broadcast
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    schema = "doc_id long, label int, ids binary, shares binary"
    got = texts.select(F.col("doc_id").cast("long"), "label", "text").mapInArrow(run, schema).toArrow()
    if not got.num_rows:
        return QualityModel(np.zeros(BUCKETS), 0.0)
    place = np.lexsort((pc.binary_length(got["ids"]).to_numpy(), got["doc_id"].to_numpy()))
    first = place[np.unique(got["doc_id"].to_numpy()[place], return_index=True)[1]]  # one text of an id that repeats
    labels_of = got["label"].to_numpy()[first]
    kept = [(got["ids"][k].as_py(), got["shares"][k].as_py()) for k in first.tolist()]
    del got  # what is kept stays packed, a document is unpacked for its step

    def bag_of(k: int) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(np.frombuffer(zlib.decompress(kept[k][0]), np.int32)), np.frombuffer(zlib.decompress(kept[k][1]), np.float32)

    return train(bag_of, labels_of)


def score(
    docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if the score is at least ``threshold``) under ``names``. The text alone
    is read: null and empty texts get the score of no evidence. A row is scored by itself, so repeated rows score alike and
    an empty table gives an empty one. Columns that have one of the ``names`` are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[bytes, tuple[float, int]] = {}
        for part in parts:
            texts = [x.encode() if x else b"" for x in part]
            scores = [shared.value.scores(texts[i : i + 200], known) for i in range(0, len(texts), 200)]
            yield pd.Series(np.concatenate(scores) if scores else np.zeros(0))
        known.clear()
        let_go()

    scored = docs.withColumn(names[0], of("text"))
    return scored.withColumn(names[1], (F.col(names[0]) >= threshold).cast("int"))
