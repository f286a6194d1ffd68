"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

A document has a score w.x over features of its whole text. A pair (better,
worse) is won with probability sigmoid(w.x_better - w.x_worse); w minimises
the logistic loss over pairs, that is, over feature differences. Documents are
then cut at a quantile of the scores of all labelled rows that are not held
out: the share of label 0 among them, both exact, so that as many of them fall
below the cut as have label 0. The score is mapped monotonically to 0..1 so that the cut lies at ``cut``.

Training, on the driver: at most ``Ranking.sample`` labelled rows of each
label, the first by a hash of the key over all labelled rows; from these
``Ranking.pairs`` preference pairs. Everything else, the cut too, runs over all
rows; of several rows of one labelled doc_id the least score counts.

Defined cases: a null or empty text has the features of an empty one and a
score like any other; a null doc_id is never held out nor labelled; several
labels of one doc_id agree on their least; equal rows get equal scores; other
columns are not read; without labels of both kinds all scores are ``cut``.
Per row work only: nothing is shuffled but the labelled rows' keys and scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, map_batches, only, stored


@dataclass(frozen=True)
class Ranking:
    sample: int = 3000     # bound on labelled rows of each label
    pairs: int = 60_000
    steps: int = 600
    rate: float = 0.5
    ridge: float = 1e-4
    shapes: int = 96       # hashed word-shape features
    cut: float = 0.7
    seed: int = 11


def _table(chars: bytes) -> bytes:
    return bytes(c for c in range(256) if c not in chars)


UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGIT = bytes(range(48, 58))
OTHER = _table(UPPER + LOWER + DIGIT + b" \t\n\x0b\x0c\r" + bytes(range(128, 256)))
#: Word shapes: letters to A or a, digits to 0, beyond ASCII to a.
SHAPE = bytes((65 if c in UPPER else 97 if c in LOWER or c > 127 else 48 if c in DIGIT else c)
              for c in range(256))
STATS = 22


def features(text: bytes, shapes: int) -> np.ndarray:
    """Fixed-length features of a whole text (UTF-8)."""
    x = np.zeros(STATS + shapes, np.float64)
    n = len(text)
    words = text.split()
    x[0] = 1.0
    x[1] = np.log1p(len(words)) / 10
    if not words:
        x[2] = 1.0
        return x
    share = lambda chars: (n - len(text.translate(None, chars))) / n
    lines = [s for s in text.split(b"\n") if s.strip()]
    distinct = len(set(words))
    lower = [w.lower().strip(b".,;:!?\"'") for w in words]
    common = np.unique(list(map(zlib.crc32, lower)), return_counts=True)[1]
    mean = sum(map(len, words)) / len(words)
    x[3:STATS] = (
        share(UPPER), share(DIGIT), share(OTHER), share(b".,"), share(b"!?"), share(b"#*$%&|<>"),
        share(b"|"), share(bytes(range(128, 256))), share(b"\n") * 10,
        distinct / len(words), distinct / len(words) ** 0.8 / 2,
        common.max() / len(words), (common == 1).sum() / len(words),
        min(mean, 30) / 10, abs(min(mean, 30) - 6) / 6,
        1 - len(set(lines)) / len(lines), len(lower) and sum(len(w) <= 3 for w in lower) / len(lower),
        min(len(words) / max(text.count(b"."), 1), 200) / 100, min(len(zlib.compress(text, 1)) / n, 1))
    shape = text.translate(SHAPE).split()
    seen: dict[bytes, int] = {}
    for s in shape:
        seen[s] = seen.get(s, 0) + 1
    for s, c in seen.items():
        # runs of one class count as one, so a shape says how a word is built, not its length
        key = bytes(b for i, b in enumerate(s[:24]) if i == 0 or s[i - 1] != b)
        x[STATS + zlib.crc32(key) % shapes] += c / len(words)
    return x


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, mod 4, is 2; null is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_features(docs: DataFrame, how: Ranking) -> DataFrame:
    """(doc_id, x) for each row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t, how.shapes) for t in blobs(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return map_batches(only(docs, doc_id="long", text="string"), rows,
                       "doc_id long, x array<double>")


def learnable(labels: DataFrame) -> DataFrame:
    """(doc_id, y) of all labels that may be learnt from, one row per doc_id."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("quality").cast("int").alias("y")) \
        .where(F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg(F.min("y").alias("y"))


def training_rows(docs: DataFrame, labels: DataFrame, how: Ranking) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the bounded sample; held-out ids are never in it."""
    first = []
    known = learnable(labels)
    for y in (0, 1):
        first.append(known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
                     .limit(how.sample))
    chosen = first[0].unionByName(first[1])  # at most 2 x sample rows
    # a doc_id on several rows: the one with the least text hash; texts leave Spark as features
    rows = only(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id")
    got = with_features(rows, how).groupBy("doc_id").agg(F.min("x").alias("x")) \
        .join(F.broadcast(chosen), "doc_id").orderBy("doc_id").collect()
    if not got:
        return np.zeros((0, STATS + how.shapes)), np.zeros(0, np.int64)
    return np.array([r["x"] for r in got]), np.array([r["y"] for r in got])


def fit(x: np.ndarray, y: np.ndarray, how: Ranking) -> dict:
    """Weights by logistic loss on feature differences."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return {"w": np.zeros(x.shape[1]), "mean": np.zeros(x.shape[1]),
                "scale": np.ones(x.shape[1]), "at": 0.0, "spread": 1.0}
    rng = np.random.default_rng(how.seed)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    d = z[rng.choice(good, how.pairs)] - z[rng.choice(bad, how.pairs)]
    w = np.zeros(x.shape[1])
    speed = np.zeros_like(w)
    for step in range(how.steps):
        lost = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))
        grad = -(lost @ d) / len(d) + how.ridge * w
        speed = 0.9 * speed + grad
        w -= how.rate / (1 + step / 200) * 0.1 * speed
    s = z @ w
    return {"w": w, "mean": mean, "scale": scale, "at": 0.0,
            "spread": float(max(s.std(), 1e-6) / 4)}


def order_statistic(scores: DataFrame, rank: int, most: int = 10_000) -> float:
    """The value ``s`` of this rank, from 0, exactly; at most ``most`` distinct ones are collected.

    Counts of equal steps between the bounds narrow them, until few values are left.
    """
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    while True:
        part = scores.where(F.col("s").between(low, high)).groupBy("s").count()
        values = part.limit(most + 1).collect()
        if len(values) <= most:
            for value, n in sorted(tuple(v) for v in values):
                if rank < n:
                    return value
                rank -= n
        step = (high - low) / 1000
        cell = F.least(F.floor((F.col("s") - low) / step), F.lit(999)).alias("cell")
        for _, n, first, last in sorted(tuple(r) for r in part.groupBy(cell).agg(
                F.sum("count"), F.min("s"), F.max("s")).collect()):
            if rank < n:
                low, high = first, last
                break
            rank -= n


def cut_at(raw: DataFrame, labels: DataFrame) -> float:
    """Midway between two scores of labelled rows: as many lie below as have label 0."""
    met = stored(raw.join(learnable(labels).where(F.col("y").isin(0, 1)), "doc_id")
                 .groupBy("doc_id", "y").agg(F.min("s").alias("s")), "labelled-scores")
    n = {r["y"]: r["count"] for r in met.groupBy("y").count().collect()}
    if len(n) < 2:
        return 0.0
    return (order_statistic(met, n[0] - 1) + order_statistic(met, n[0])) / 2


def raw_scores(docs: DataFrame, model: dict, how: Ranking = Ranking()) -> DataFrame:
    """(doc_id, s), the scores before they are mapped, for each row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            x = np.array([features(t, how.shapes) for t in blobs(batch)])
            if not len(x):
                continue
            s = ((x - m["mean"]) / m["scale"]) @ m["w"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s, pa.float64())],
                                             ["doc_id", "s"])

    return map_batches(only(docs, doc_id="long", text="string"), rows, "doc_id long, s double")


def mapped(raw: DataFrame, model: dict, how: Ranking = Ranking()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of raw scores."""
    at, spread = model["at"], model["spread"]
    base = np.log(how.cut / (1 - how.cut))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch.column("s").to_numpy(zero_copy_only=False)
            p = 1 / (1 + np.exp(-np.clip((s - at) / spread + base, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    got = map_batches(raw, rows, "doc_id long, score double")
    return got.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= how.cut).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, how: Ranking = Ranking()) -> DataFrame:
    """Train on the labels that may be learnt from and score all of ``docs``."""
    model = fit(*training_rows(docs, labels, how), how)
    raw = stored(raw_scores(docs, model, how), "raw-scores")
    if model["w"].any():
        model["at"] = cut_at(raw, labels)
    return mapped(raw, model, how)
