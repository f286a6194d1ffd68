"""Phrase collocations by direct-address tiles.

Words are numbered by frequency within their language. The occurrences of two
neighbours form a matrix of pairs, cut into tiles of 2^10 x 2^10 numbers. A task
counts its pairs tile by tile: one that holds many occurrences is counted by
``bincount`` over the tile's own addresses, the rest as sorted coordinates.
Frequent pairs are then numbered by frequency in their turn and take the place
of the left word, so that longer phrases are pairs again, counted the same way,
level by level. Partial counts are summed by Spark.

Only the ``DENSE`` most frequent words (and as many pairs a level) get a number;
this list is what is sent to all tasks, whatever the data. A further word is
named by a 64-bit hash, negative, so that no list of all words is needed
anywhere; the names of all words are checked for collisions, and another seed is
taken if there is one. Phrases whose parts are not frequent cannot be: parts are
looked up in a bitmap of fixed size, whose false hits are removed by the exact
counts.

Defined cases: null and empty texts have no words; a null lang is ``und``; a
very long text is counted in one block; repeated rows count each; an empty
table gives no rows; other columns are not read. Hot keys: counts are summed
before they are shuffled, by block and by Spark, so that a language or word that
holds a third of all rows is a few rows of each task; the first ``top`` of a
language are found by a limit within each task first.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_parts, only, stored

#: Most frequent words, and phrases of a length, that get numbers.
DENSE = 1 << 17
#: Longest numbered word, so that the list has a size bound.
DENSE_BYTES = 64
#: A tile has 2^TILE numbers on each side, and is dense if this part of its places is met.
TILE = 10
FULL = 8
#: Words that a task holds, and counts at most at once; rows that it hands on at once.
BLOCK_WORDS = 1 << 19
BATCH_ROWS = 1 << 16
#: Bits of the filter of frequent parts: broadcast as 4 MiB.
SLOTS = 1 << 25

#: 0: of a word; 1: between words of a piece (space, tab); 2: ends a piece.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of UTF-8 ``texts`` in order, A-Z lower-cased, and the piece of each.

    Works on the bytes of all texts at once: all separators are ASCII.
    """
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or bounds[0] == bounds[-1]:
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
    begins = bounds[:-1][np.diff(bounds) > 0] - bounds[0]
    kind = KIND[data]
    inside = kind == 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    first[begins] |= inside[begins]
    last[:-1] &= ~inside[1:]
    last[begins[1:] - 1] |= inside[begins[1:] - 1]
    ends = kind == 2
    ends[begins] = True  # a text begins a piece
    at = np.flatnonzero(first)
    piece = np.searchsorted(np.flatnonzero(ends), at, "right")
    offsets = np.append(0, np.cumsum(np.flatnonzero(last) + 1 - at)).astype(np.int32)
    letters = LOWER[data[inside]]
    words = pa.Array.from_buffers(pa.binary(), len(at), [
        None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words, piece


class Words(NamedTuple):
    """The words of a block in one language: places in ``names``, and their pieces."""

    lang: str
    place: np.ndarray
    piece: np.ndarray
    names: list[bytes]


def by_language(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_WORDS) -> Iterator[Words]:
    """Blocks of words, gathered by language; about ``limit`` words are held in all."""
    held: dict[str, list] = {}
    n_held: dict[str, int] = {}

    def taken(lang: str) -> Words:
        got = held.pop(lang)
        n_held.pop(lang)
        coded = pa.concat_arrays([w for w, _ in got]).dictionary_encode()
        shift, pieces = 0, []
        for _, p in got:
            pieces.append(p + shift)
            shift += int(p[-1]) + 1
        return Words(lang, coded.indices.to_numpy().astype(np.int64), np.concatenate(pieces),
                     coded.dictionary.to_pylist())

    for batch in in_parts(batches):
        langs = pc.fill_null(batch.column("lang"), "und")
        for lang in langs.unique().to_pylist():
            words, piece = words_of(batch.column("text").filter(pc.equal(langs, lang)))
            if len(words):
                held.setdefault(lang, []).append((words, piece))
                n_held[lang] = n_held.get(lang, 0) + len(words)
        while sum(n_held.values()) >= limit:
            yield taken(max(n_held, key=n_held.get))
    for lang in list(held):
        yield taken(lang)


# --- counting ------------------------------------------------------------------

def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys`` and how often each stands there, by sorting."""
    keys = np.sort(keys)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) \
        else np.zeros(0, np.int64)
    return keys[new], np.diff(np.append(new, len(keys)))


def count_pairs(left: np.ndarray, right: np.ndarray, left_rank: np.ndarray,
                right_rank: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, ...]:
    """(left, right, n) of each pair of places that occurs.

    ``*_rank``: the frequency rank of each place, -1 without one; no two places
    have the same rank. Dense tiles are counted by address, the rest as sorted
    coordinates.
    """
    a, b = left_rank[left], right_rank[right]
    ranked = (a >= 0) & (b >= 0)
    side = 1 << tile
    tiles, met = runs(np.where(ranked, (a >> tile) << 32 | (b >> tile), -1))
    rest = np.ones(len(left), bool)
    out = []
    for t in tiles[(tiles >= 0) & (met >= side * side // FULL)].tolist():
        here = ranked & ((a >> tile) == t >> 32) & ((b >> tile) == t & 0xFFFFFFFF)
        rest &= ~here
        cells = np.bincount((a[here] & side - 1) << tile | b[here] & side - 1,
                            minlength=side * side)
        at = np.flatnonzero(cells)
        out.append((_place_of(left_rank, ((t >> 32) << tile) + (at >> tile)),
                    _place_of(right_rank, ((t & 0xFFFFFFFF) << tile) + (at & side - 1)),
                    cells[at]))
    keys, n = runs(left[rest] << 32 | right[rest])
    out.append((keys >> 32, keys & 0xFFFFFFFF, n))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _place_of(rank: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    places = np.flatnonzero(rank >= 0)
    order = places[np.argsort(rank[places], kind="stable")]
    return order[np.searchsorted(rank[order], wanted)]


def slots(lang: str, ids: list[np.ndarray], n_slots: int) -> np.ndarray:
    """A place in the filter for each phrase, given as arrays of its words' ids."""
    return (mixed(ids, xxhash.xxh64_intdigest(lang.encode())) % np.uint64(n_slots)).astype(np.int64)


def mixed(ids: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each phrase, given as arrays of its words' ids."""
    h = np.full(len(ids[0]), seed, np.uint64)
    for x in ids:
        h = (h ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


class Known(NamedTuple):
    """What tasks are told of the levels below; sizes are bounded by parameters."""

    seed: int
    ranks: dict[tuple[str, bytes], int]  # of words
    phrases: dict[int, dict[str, list[np.ndarray]]]  # by length: see numbered_phrases
    filters: list[np.ndarray]  # by length - 1: bits of frequent words, pairs, ...

    def ids(self, lang: str, names: list[bytes]) -> np.ndarray:
        return np.array([word_id(lang, w, self.ranks, self.seed) for w in names], np.int64)

    def frequent(self, lang: str, ids: list[np.ndarray]) -> np.ndarray:
        bits = self.filters[len(ids) - 1]
        at = slots(lang, ids, len(bits) * 8)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def word_id(lang: str, word: bytes, ranks: dict, seed: int) -> int:
    """The rank of a frequent word, else its hash, below zero."""
    rank = ranks.get((lang, word))
    return rank if rank is not None else (xxhash.xxh64_intdigest(word, seed) >> 1) - (1 << 63)


def level_of(words: Words, size: int, known: Known) -> tuple[list[np.ndarray], np.ndarray]:
    """Ids of the phrases of ``size`` words of a block, whose parts may be frequent, and counts."""
    ids = known.ids(words.lang, words.names)
    rank = np.where(ids >= 0, ids, -1)
    ok = known.frequent(words.lang, [ids])  # of words
    unit, unit_ids, unit_rank = words.place, [ids], rank
    at = np.flatnonzero(ok[words.place])  # first words of phrases that may be frequent
    for m in range(2, size + 1):
        # a phrase of m words: two of m - 1 words that overlap, both frequent
        end = at + m - 1
        fits = end < len(words.place)
        at, end = at[fits], end[fits]
        fits = (words.piece[at] == words.piece[end]) & ok[words.place[end]]
        if m > 2:
            fits &= passed[at + 1]
        at, end = at[fits], end[fits]
        if m == size:
            left, right, n = count_pairs(unit[at], words.place[end], unit_rank, rank)
            return [x[left] for x in unit_ids] + [ids[right]], n
        keys, place = np.unique(unit[at] << 32 | words.place[end], return_inverse=True)
        unit_ids = [x[keys >> 32] for x in unit_ids] + [ids[keys & 0xFFFFFFFF]]
        good = known.frequent(words.lang, unit_ids)
        unit = np.zeros(len(words.place), np.int64)
        unit[at] = place
        passed = np.zeros(len(words.place) + 1, bool)
        passed[at] = good[place]
        at = at[good[place]]
        unit_rank = _phrase_ranks(unit_ids, known.phrases[m].get(words.lang))
    raise ValueError("phrases have two words or more")


def _phrase_ranks(ids: list[np.ndarray], told) -> np.ndarray:
    """Ranks of phrases among the numbered ones; -1 for others."""
    out = np.full(len(ids[0]), -1, np.int64)
    if told is not None:
        hashes, table, ranks = told
        at = np.minimum(np.searchsorted(hashes, mixed(ids)), len(hashes) - 1)
        hit = (table[at] == np.stack(ids, axis=1)).all(axis=1)
        out[hit] = ranks[at[hit]]
    return out


def numbered_phrases(ranks: dict) -> dict[str, list[np.ndarray]]:
    """By language: hashes, ascending, ids and ranks of numbered phrases."""
    by_lang: dict[str, list] = {}
    for (lang, *key), r in ranks.items():
        by_lang.setdefault(lang, []).append((*key, r))
    out = {}
    for lang, rows in by_lang.items():
        got = np.array(rows, np.int64)
        hashes = mixed(list(got[:, :-1].T))
        # of two phrases with one hash, one stays without a number
        order = np.unique(hashes, return_index=True)[1]
        out[lang] = [hashes[order], got[order, :-1], got[order, -1]]
    return out


# --- over the corpus -----------------------------------------------------------

def _rows(df: DataFrame) -> DataFrame:
    return only(df, lang="string", text="string")


def _batches(lang: str, columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    n = len(columns["n"])
    rows = pa.RecordBatch.from_pydict({"lang": pa.repeat(pa.scalar(lang), n), **columns})
    for at in range(0, n, BATCH_ROWS):
        yield rows.slice(at, BATCH_ROWS)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in by_language(batches):
            n = np.bincount(w.place, minlength=len(w.names))
            yield from _batches(w.lang, {"word": pa.array(w.names, pa.binary()).cast(pa.string()),
                                         "n": pa.array(n, pa.int64())})

    return _rows(docs).mapInArrow(rows, "lang string, word string, n long") \
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _names(size: int) -> list[str]:
    return [f"w{i}" for i in range(1, size + 1)]


def phrase_counts(docs: DataFrame, size: int, known: Known, least: int) -> DataFrame:
    """(lang, w1, ..., n) of phrases of ``size`` words that occur ``least`` times; ids for words."""
    names = _names(size)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in by_language(batches):
            ids, n = level_of(w, size, known)
            yield from _batches(w.lang, {**dict(zip(names, map(pa.array, ids), strict=True)),
                                         "n": pa.array(n, pa.int64())})

    schema = ", ".join(["lang string", *[f"{x} long" for x in names], "n long"])
    return _rows(docs).mapInArrow(rows, schema).groupBy("lang", *names) \
        .agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _filter(frequent: DataFrame, names: list[str], n_slots: int = SLOTS) -> np.ndarray:
    """Bits of ``frequent`` phrases, gathered as at most ``n_slots / 64`` words."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang")
            for lang in langs.unique().to_pylist():
                part = batch.filter(pc.equal(langs, lang))
                at = slots(lang, [part.column(n).to_numpy() for n in names], n_slots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at >> 6).astype(np.int32)),
                     pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))],
                    ["at", "bits"])

    got = frequent.select("lang", *names).mapInArrow(rows, "at int, bits long") \
        .groupBy("at").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    out = np.zeros(n_slots // 64, np.int64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint8)


def _numbered(counts: DataFrame, names: list[str], dense: int) -> list:
    """At most ``dense`` of the most frequent rows, most frequent first; ties by name.

    The least count is found from a histogram of counts (16 classes to a factor of two).
    """
    scale = F.floor(F.log2("n") * 16).cast("int")
    n_of = {r["s"]: r["count"] for r in counts.groupBy(scale.alias("s")).count().collect()}
    least, total = None, 0
    for s in sorted(n_of, reverse=True):
        total += n_of[s]
        if total > dense:
            break
        least = s
    if least is None:
        return []
    rows = counts.where(scale >= least).select("n", "lang", *names).collect()
    return [r[1:] for r in sorted(rows, key=lambda r: (-r[0], *r[1:]))]


def _named(words: DataFrame, ranks: dict, seed: int) -> DataFrame:
    """(lang, word, n, id)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [word_id(g, w, ranks, seed) for g, w in
                   zip(batch.column("lang").to_pylist(),
                       batch.column("word").cast(pa.binary()).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())],
                                             [*batch.schema.names, "id"])

    return words.select("lang", "word", "n").mapInArrow(
        rows, "lang string, word string, n long, id long")


def _ranks(rows: list) -> dict:
    """Rank within the language of each (lang, *key), in order."""
    out, next_of = {}, {}
    for lang, *key in rows:
        out[(lang, *key)] = next_of[lang] = next_of.get(lang, -1) + 1
    return out


def _vocabulary(docs: DataFrame, dense: int) -> tuple[DataFrame, DataFrame, dict, int]:
    """All words with ids, n of each language, ranks of the frequent ones, the hash's seed."""
    words = stored(word_counts(docs), "words")
    short = words.where(F.octet_length("word") <= DENSE_BYTES)
    ranks = {(lang, w.encode()): r
             for (lang, w), r in _ranks(_numbered(short, ["word"], dense)).items()}
    for seed in range(64):
        named = stored(_named(words, ranks, seed), "named")
        if named.where("id < 0").groupBy("lang", "id").count().where("count > 1").isEmpty():
            return named, words.groupBy("lang").agg(F.sum("n").alias("total")), ranks, seed
    raise RuntimeError("no seed without collisions of 64-bit hashes")


def collocations(docs: DataFrame, top: int = 2000, max_words: int = 3, least: int = 10,
                 inside: int = 50, dense: int = DENSE) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates occur ``a >= least`` times. One inside a candidate that is a word
    longer and has ``inside`` percent of its occurrences is dropped; this covers
    all longer ones, whose parts have no fewer.
    """
    named, totals, ranks, seed = _vocabulary(docs, dense)
    counts = {1: stored(named.where(F.col("n") >= least), "level-1")
              .select("lang", F.col("id").alias("w1"), "n", "word")}
    filters = [_filter(counts[1], ["w1"])]
    phrases: dict[int, dict] = {}
    for m in range(2, max_words + 1):
        known = Known(seed, ranks, dict(phrases), list(filters))
        counts[m] = stored(phrase_counts(docs, m, known, least), f"level-{m}")
        if m < max_words:
            names = _names(m)
            filters.append(_filter(counts[m], names))
            ranked = counts[m].where(" AND ".join(f"{n} >= 0" for n in names))
            phrases[m] = numbered_phrases(_ranks(_numbered(ranked, names, dense)))
    scored = [_scored(counts, m, counts.get(m + 1), inside) for m in range(2, max_words + 1)]
    ids = [f"w{i}" for i in range(1, max_words + 1)]
    every = scored[0]
    for s in scored[1:]:
        every = every.unionByName(s, allowMissingColumns=True)
    # ids order nothing: keep all that may be among the first before words are looked up
    first = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    short = stored(every.withColumn("_rank", F.rank().over(first))
                   .where(F.col("_rank") <= top).drop("_rank"), "ranked")
    for i in ids:
        w = counts[1].select(F.col("lang").alias("_lang"), F.col("w1").alias("_id"),
                             F.col("word").alias(f"_{i}"))
        short = short.join(w, (short["lang"] == w["_lang"]) & (short[i] == w["_id"]), "left") \
            .drop("_lang", "_id")
    said = short.withColumn("phrase", F.concat_ws(" ", *[f"_{i}" for i in ids]))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (said.withColumn("rank", F.row_number().over(order).cast("long"))
            .where(F.col("rank") <= top)
            .join(totals.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"))
            .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))


def _scored(counts: dict[int, DataFrame], m: int, longer: DataFrame | None,
            inside: int) -> DataFrame:
    """Candidates of ``m`` words that stay, with l, r and score of their lowest cut."""
    names = _names(m)
    df = counts[m].withColumnRenamed("n", "a")
    for k in range(1, m):
        for label, part in ((f"_l{k}", names[:k]), (f"_r{k}", names[k:])):
            c = counts[len(part)].select(
                F.col("lang").alias("_lang"),
                *[F.col(x).alias(f"_{x}") for x in _names(len(part))], F.col("n").alias(label))
            on = df["lang"] == c["_lang"]
            for x, y in zip(part, _names(len(part)), strict=True):
                on = on & (df[x] == c[f"_{y}"])
            df = df.join(c, on).drop("_lang", *[f"_{x}" for x in _names(len(part))])
    wide = "cast(a as decimal(19,0))"
    cuts = [F.struct(
        F.expr(f"(cast({wide} * {wide} as decimal(31,0)) * cast(1000000 as decimal(7,0))) div "
               f"(cast(_l{k} as decimal(19,0)) * cast(_r{k} as decimal(19,0)))").alias("score"),
        F.lit(k).alias("k"), F.col(f"_l{k}").alias("l"), F.col(f"_r{k}").alias("r"))
        for k in range(1, m)]
    df = df.withColumn("_cut", F.array_min(F.array(*cuts)))
    if longer is not None:
        wide_names = _names(m + 1)
        ends = [longer.select("lang", *[F.col(x).alias(y) for x, y in
                                        zip(part, names, strict=True)], "n")
                for part in (wide_names[:m], wide_names[1:])]
        most = ends[0].unionByName(ends[1]).groupBy("lang", *names).agg(F.max("n").alias("_most"))
        df = df.join(most, ["lang", *names], "left").where(
            F.coalesce(F.col("_most"), F.lit(0)) * 100 < F.col("a") * inside)
    return df.select("lang", *names, "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"),
                     F.col("_cut.score").cast("long").alias("score"))
