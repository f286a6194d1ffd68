"""N-gram Jaccard join with Bayesian candidate pruning.

Documents whose sets of five-word shingles have a Jaccard similarity of at
least ``Join.threshold`` are linked. Documents of one shingle set are one
class, handled once.

1. Candidates, by prefix filter: of n shingles in any fixed order, the first
   n - ceil(t n) + 1 must share one with every set at similarity t or more. The
   order is rarest first by a count sketch of fixed size over all documents,
   which only affects speed: any order finds every link.
2. Members of a shingle's posting list are compared in blocks by MinHash, a few
   values at a time. With a uniform prior on the similarity s and m of k values
   equal, a pair is dropped once P(s >= t | m of k) falls below ``tolerance``.
   Survivors are not listed; a block gives a spanning forest of them.
3. The connected parts of these forests hold every link inside. Each is again
   compared in blocks, pruned the same way, and survivors verified exactly on
   their whole shingle sets. A block gives, per member, its number of links and
   an edge of a spanning forest; no pair is ever a row.

Words: A-Z lowered, split at ASCII characters other than digits and letters. A
text of one to four words has one shingle, all of them. Defined cases: null,
empty or wordless texts have no links and a class of their own; equal rows are
linked like other copies; doc_ids may be null or repeated (rows are told apart
by doc_id and a hash of the text); other columns are not read; an empty table
gives an empty result. Hot groups: copies collapse to one class before
anything is joined; a posting list or part of any size is split into blocks of
bounded size, and no list, part or block is gathered whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, in_parts, only, semi_filter, stored

SKETCH_BITS = 20          # slots of the count sketch: bounds what is collected and broadcast
LIVE_SLOTS = 1 << 24      # bits of the filter of shingles that two classes share
SENT_EDGES = 1 << 17      # edges that a task remembers in order not to repeat them
SET_ROWS = 1000           # shingle sets that a task holds at once, about
STEPS = (16, 32, 64)   # MinHash values compared before each decision


@dataclass(frozen=True)
class Join:
    threshold: float = 0.8
    words: int = 5
    tolerance: float = 1e-7
    list_block: int = 512   # members of a posting list compared at once
    part_block: int = 256   # members of a connected part, with their sets
    seed: int = 5


def needed(how: Join) -> list[int]:
    """Equal values below which a pair is dropped at each of ``STEPS``.

    For a uniform prior, P(s >= t | m of k) = P(Binomial(k + 1, t) <= m).
    """
    out = []
    for k in STEPS:
        below, m = 0.0, 0
        while True:
            below += comb(k + 1, m) * how.threshold ** m * (1 - how.threshold) ** (k + 1 - m)
            if below >= how.tolerance or m > k:
                break
            m += 1
        out.append(m)
    return out


# --- shingles in numpy ------------------------------------------------------

_PLAIN = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32)
               for c in range(128)) + bytes(range(128, 256))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts, and their MinHash values."""

    def __init__(self, how: Join):
        rng = np.random.default_rng(how.seed)
        self.k = how.words
        self.byte = rng.integers(0, 1 << 63, 256, dtype=np.uint64)
        self.place = rng.integers(0, 1 << 63, how.words, dtype=np.uint64) | np.uint64(1)
        self.perm = rng.integers(0, 1 << 63, STEPS[-1], dtype=np.uint64) | np.uint64(1)

    @staticmethod
    def mix(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts in a row, and where each text's begin."""
        joined = b" ".join([*texts, b""]).translate(_PLAIN)
        raw = np.frombuffer(joined, np.uint8)
        inside = np.concatenate([[False], raw != 32, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, length = edge[0::2], edge[1::2] - edge[0::2]
        h = np.zeros(len(start), np.uint64)
        alive, k = np.arange(len(start)), 0
        while len(alive):
            h[alive] = h[alive] * np.uint64(0x100000001B3) + self.byte[raw[start[alive] + k]]
            k += 1
            alive = alive[length[alive] > k]
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        return self.mix(h), np.searchsorted(start, offsets)

    def sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The shingle set of each text; large batches are taken in parts."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size < 4_000_000):
                size += len(texts[end])
                end += 1
            w, cut = self.words(texts[at:end])
            m = max(len(w) - self.k + 1, 0)
            s = np.zeros(m, np.uint64)
            for i in range(self.k):
                s += w[i:i + m] * self.place[i]
            s = self.mix(s)
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b - a >= self.k:
                    yield np.unique(s[a:b - self.k + 1])
                elif b > a:
                    few = (w[a:b] * self.place[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                    yield self.mix(np.array([few], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)
            at = end

    def signature(self, s: np.ndarray) -> np.ndarray:
        least = np.full(len(self.perm), np.iinfo(np.uint64).max, np.uint64)
        for a in range(0, len(s), 2048):
            least = np.minimum(least, (s[a:a + 2048, None] * self.perm[None, :]).min(0))
        # one byte each: unlike sets agree a little more often, which only keeps more pairs
        return (self.mix(least) >> np.uint64(56)).astype("u1")


def key_of(s: np.ndarray) -> int:
    """A class's key: a hash of its shingle set, as a signed 64-bit number."""
    h = xxhash.xxh3_64_intdigest(s.tobytes())
    return h - (1 << 64) if h >> 63 else h


def _slot(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


# --- step 1: classes and their prefixes -------------------------------------

def _texts(docs: DataFrame) -> DataFrame:
    return only(docs, doc_id="long", text="string").withColumn("text_key", F.xxhash64("text"))


def rarity(docs: DataFrame, how: Join) -> np.ndarray:
    """The sketch: about the log of the documents that share a shingle, by slot.

    Shingles seen once in a batch of distinct sets, nearly all, are not sent.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(how)
        for batch in batches:
            distinct = {key_of(s): s for part in in_parts([batch])
                        for s in shingler.sets(blobs(part))}
            if not distinct:
                continue
            s = np.concatenate(list(distinct.values()))
            distinct.clear()  # the batch's shingles are held once, and sorted in place
            s.sort()
            again = s[1:] == s[:-1]
            again = np.concatenate([again, [False]]) | np.concatenate([[False], again])
            slot, total = np.unique(_slot(s[again[:len(s)]]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot.astype(np.int32)), pa.array(total)], ["slot", "n"])

    got = (only(docs, text="string").mapInArrow(rows, "slot int, n long")
           .groupBy("slot").agg(F.sum("n").alias("n")).toPandas())  # at most 2^SKETCH_BITS rows
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    out[got["slot"].to_numpy(np.int64)] = np.log2(got["n"].to_numpy(np.float64) + 1) * 2 + 1
    return out


_FEATURES = ("doc_id long, text_key long, key long, n int, sig binary, prefix array<long>")


def features(docs: DataFrame, sketch: np.ndarray, how: Join) -> DataFrame:
    """Class key of each document; MinHash values and prefix where a task first meets the class."""
    held = docs.sparkSession.sparkContext.broadcast(sketch)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(how), set()
        for batch in in_parts(batches):
            keys, sizes, sigs, prefixes = [], [], [], []
            for s in shingler.sets(blobs(batch)):
                key = key_of(s) if len(s) else None
                keys.append(key)
                sizes.append(len(s))
                if key is None or key in seen:
                    sigs.append(None)
                    prefixes.append(None)
                    continue
                seen.add(key)
                rank = (held.value[_slot(s)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                p = len(s) - ceil(how.threshold * len(s) - 1e-9) + 1
                first = s[np.argpartition(rank, p - 1)[:p]] if p < len(s) else s
                sigs.append(shingler.signature(s).tobytes())
                prefixes.append(first.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(keys, pa.int64()),
                 pa.array(sizes, pa.int32()), pa.array(sigs, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "key", "n", "sig", "prefix"])

    return _texts(docs).mapInArrow(rows, _FEATURES)


# --- comparing groups of rows -----------------------------------------------

def survivors(group: np.ndarray, side: np.ndarray, both: np.ndarray, key: np.ndarray,
              n: np.ndarray, sig: np.ndarray, how: Join) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that may reach the threshold.

    ``group`` is sorted; in groups of two different blocks (not ``both``) only
    pairs across the sides count. Sets too different in size cannot be linked.
    """
    least = needed(how)
    out_i, out_j = [], []
    for d in range(1, len(group)):
        i = np.flatnonzero(group[:-d] == group[d:])
        if not len(i):
            break
        j = i + d
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        fit = ((key[i] != key[j]) & (both[i] | (side[i] != side[j]))
               & (small >= how.threshold * large - 1e-9))
        i, j = i[fit], j[fit]
        equal, at = np.zeros(len(i), np.int64), 0
        for step, low in zip(STEPS, least, strict=True):
            equal = equal + (sig[i, at:step] == sig[j, at:step]).sum(1)
            keep = equal >= low
            i, j, equal, at = i[keep], j[keep], equal[keep], step
        out_i.append(i)
        out_j.append(j)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_i]), np.concatenate([empty, *out_j])


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row connected with each row by the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        if (label[i] == low).all() and (label[j] == low).all():
            break
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
    return label


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The sorted rows of a partition in tables that end where a group ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in names]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        first = [batch.column(c)[0].as_py() for c in names]
        if held and first != [held[-1].column(c)[held[-1].num_rows - 1].as_py() for c in names]:
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            cut = int(change[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _columns(t: pa.Table, names: list[str]) -> tuple[np.ndarray, ...]:
    cols = [t.column(c).to_numpy() for c in names]
    group = np.concatenate([[0], np.cumsum(np.any([c[1:] != c[:-1] for c in cols], axis=0))])
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), "u1").reshape(-1, STEPS[-1])
    return (group, t.column("side").to_numpy(), t.column("lo").to_numpy()
            == t.column("hi").to_numpy(), t.column("key").to_numpy(), t.column("n").to_numpy(), sig)


def _in_blocks(rows: DataFrame, by: str, n_blocks: str) -> DataFrame:
    """Each row once for every pair of blocks (lo, hi) that its block, ``side``, is in.

    In order of key, so that the root of a forest is its least key and the
    many lists of one group of near copies give the same few edges.
    """
    cols = [c for c in rows.columns if c != n_blocks]
    split = rows.withColumn("side", F.pmod(F.xxhash64("key", F.lit(1)), F.col(n_blocks))
                            .cast("int"))
    pairs = split.select(*cols, "side", F.explode(F.sequence(
        F.lit(0), (F.col(n_blocks) - 1).cast("int"))).alias("other"))
    return (pairs.select(*cols, "side", F.least("side", "other").alias("lo"),
                         F.greatest("side", "other").alias("hi"))
            .repartition(by, "lo", "hi").sortWithinPartitions(by, "lo", "hi", "key"))


# --- step 2: likely links ---------------------------------------------------

def likely_edges(classes: DataFrame, how: Join) -> DataFrame:
    """(a, b): spanning forests of the pairs that survive pruning, per block of a posting list."""
    postings = classes.select("key", F.explode("prefix").alias("h"))
    shared = postings.groupBy("h").agg(
        F.min("key").alias("k0"), F.max("key").alias("k1"), F.count(F.lit(1)).alias("m")) \
        .where("k0 < k1").select("h", F.ceil(F.col("m") / how.list_block).alias("n_blocks"))
    shared = stored(shared, "shared-shingles")
    members = (semi_filter(postings, shared, ["h"], LIVE_SLOTS).join(shared, "h")
               .join(classes.select("key", "n", "sig"), "key"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sent = ["h", "lo", "hi"], set()
        for t in _grouped(batches, names):
            cols = _columns(t, names)
            i, j = survivors(*cols, how)
            root, key = roots(len(cols[0]), i, j), cols[3]
            at = np.flatnonzero(root != np.arange(len(root)))
            new = {(int(key[r]), int(key[x])) for r, x in zip(root[at], at, strict=True)} - sent
            if len(sent) < SENT_EDGES:  # lists of one group of copies give the same edges
                sent |= new
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in new], pa.int64()),
                 pa.array([b for _, b in new], pa.int64())], ["a", "b"])

    return _in_blocks(members, "h", "n_blocks").mapInArrow(rows, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(key, part) for each end of an edge (a, b): the least key connected with it.

    Labels take the least of the neighbours' and then their label's label, so
    long chains halve each round; every round is written to the shared folder.
    """
    both = stored(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("key"), F.least("a", "m").alias("part")), "labels")
    while True:
        near = both.join(labels.select(F.col("key").alias("b"), "part"), "b") \
            .groupBy("a").agg(F.min("part").alias("near"))
        step = labels.join(near, F.col("key") == F.col("a")).select(
            "key", F.col("part").alias("old"), F.least("part", "near").alias("part"))
        jump = labels.select(F.col("key").alias("part"), F.col("part").alias("next"))
        new = stored(step.join(jump, "part", "left").select(
            "key", "old", F.least("part", F.coalesce("next", "part")).alias("part")), "labels")
        labels = new.select("key", "part")
        if new.where("part <> old").isEmpty():
            return labels


# --- step 3: verified links -------------------------------------------------

def shingle_sets(docs: DataFrame, wanted: DataFrame, how: Join) -> DataFrame:
    """(key, sig, shingles) of the documents ``wanted`` (doc_id, text_key)."""
    texts = semi_filter(_texts(docs), wanted, ["doc_id", "text_key"])
    # an inner join: a semi-join would be moved below the filter, before all texts
    met = texts.join(wanted, (texts["text_key"] == wanted["text_key"])
                     & texts["doc_id"].eqNullSafe(wanted["doc_id"]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(how)
        for batch in in_parts(batches):
            sets = list(shingler.sets(blobs(batch)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([key_of(s) for s in sets], pa.int64()),
                 pa.array([shingler.signature(s).tobytes() for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "sig", "shingles"])

    return met.select("text").mapInArrow(rows, "key long, sig binary, shingles binary") \
        .dropDuplicates(["key"])


def verified(docs: DataFrame, parts: DataFrame, classes: DataFrame, how: Join) -> DataFrame:
    """(key, root, links) per block: documents linked with a class, and a forest edge."""
    size = parts.groupBy("part").agg(F.count(F.lit(1)).alias("m")) \
        .select("part", F.ceil(F.col("m") / how.part_block).alias("n_blocks"))
    known = stored(parts.join(size, "part").join(classes.drop("sig", "prefix"), "key"), "parts")
    sets = shingle_sets(docs, known.select("doc_id", "text_key"), how)
    members = known.drop("doc_id", "text_key").join(sets, "key")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "lo", "hi"]
        for t in _grouped(in_parts(batches, SET_ROWS), names):
            cols = _columns(t, names)
            key, n = cols[3], cols[4]
            copies = t.column("copies").to_numpy()
            sets = [np.frombuffer(b, np.uint64) for b in t.column("shingles").to_pylist()]
            i, j = survivors(*cols, how)
            common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                               for a, b in zip(i, j, strict=True)], np.int64)
            linked = common >= how.threshold * (n[i] + n[j] - common) - 1e-9
            i, j = i[linked], j[linked]
            links = np.bincount(i, copies[j], len(key)) + np.bincount(j, copies[i], len(key))
            root = roots(len(key), i, j)
            at = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at]), pa.array(key[root[at]]), pa.array(links[at].astype(np.int64))],
                ["key", "root", "links"])

    return _in_blocks(members, "part", "n_blocks").mapInArrow(
        rows, "key long, root long, links long")


def near_duplicates(docs: DataFrame, how: Join = Join()) -> DataFrame:
    """doc_id, text_key, class_id, n_links for each row of ``docs``.

    ``class_id`` is the least doc_id of the documents connected by links,
    ``n_links`` the number of other documents (copies included) at similarity
    ``how.threshold`` or more.
    """
    feats = stored(features(docs, rarity(docs, how), how), "shingle-features")
    copies = feats.where("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"))
    # one carrier of each class, with how many documents it stands for
    classes = stored(feats.where("prefix is not null").dropDuplicates(["key"])
                     .join(copies, "key"), "classes")
    parts = components(likely_edges(classes, how))
    found = stored(verified(docs, parts, classes, how), "links")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(found.where("key <> root").select(
        F.col("key").alias("a"), F.col("root").alias("b")).distinct())
    by_class = copies.join(links, "key", "left").join(groups, "key", "left").select(
        "key", F.coalesce("part", "key").alias("part"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    at = feats.select("doc_id", "text_key", "key").join(by_class, "key", "left")
    least = at.where("key is not null").groupBy("part").agg(F.min("doc_id").alias("class_id"))
    return at.join(least, "part", "left").select(
        "doc_id", "text_key", F.when(F.col("key").isNull(), F.col("doc_id"))
        .otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "part")


def keep_one(docs: DataFrame, how: Join = Join()) -> DataFrame:
    """One row of ``docs`` of each class, with all its columns.

    The row with the least doc_id stays (null last), then the least text hash,
    then the least hash of all columns. Wordless rows all stay.
    """
    cols = docs.columns
    marked = stored(near_duplicates(docs, how), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = marked.where("part is not null").groupBy("part").agg(F.min(order).alias("f"))
    gone = (marked.where("part is not null").join(first, "part")
            .groupBy("part", "doc_id", "text_key")
            .agg(F.first("f").alias("f"), F.count(F.lit(1)).alias("rows")))
    same = (F.col("f.text_key") == F.col("text_key")) & F.col("f.doc_id").eqNullSafe(
        F.col("doc_id"))
    gone = gone.select("doc_id", "text_key", same.alias("first"), "rows") \
        .where("not first or rows > 1")
    keyed = docs.withColumn("__id", F.col("doc_id").cast("long")) \
        .withColumn("__text_key", F.xxhash64("text"))

    def on(right: DataFrame):
        return (keyed["__text_key"] == right["text_key"]) & keyed["__id"].eqNullSafe(
            right["doc_id"])

    stay = keyed.join(gone, on(gone), "left_anti")
    # several equal rows (doc_id and text) that come first: the least by all columns
    equal = gone.where("first")
    twice = keyed.join(equal, on(equal), "left_semi")
    rest = [F.col(c).cast("string") for c, kind in docs.dtypes if not kind.startswith("map")]
    one = (twice.groupBy("__id", "__text_key")
           .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.xxhash64(*rest)).alias("__row"))
           .select("__row.*"))
    return stay.select(*cols).unionByName(one.select(*cols))
