"""Quality rules with compression bands.

Every whole text gets a few plain measures (words, symbols, repeated lines,
repeated 8-word windows) and zstandard ratios (raw bytes / compressed bytes)
of the whole text and of fixed-size chunks: each full one, and the last bytes
of a text that does not end with one, so that every byte of a text of at least
one chunk is in a chunk (shorter texts are one piece, judged by the band for
their length). Text that compresses far
better than prose of its length is repetitive, text that hardly compresses is
noise; both fall outside the band for their length and are rejected.

Defined cases: a null or empty text has no words and fails the base rule;
equal rows get equal results, one row each; columns other than ``doc_id`` and
``text`` are not read (``measure``) or passed through untouched
(``keep_good``); an empty table gives an empty result. All work is per row:
nothing is shuffled, so no key, source or group of copies can become hot.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import blobs, in_parts, map_batches, only

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """Limits; a band is (bytes below which it holds, lowest ratio, highest ratio)."""

    min_words: int = 20
    window: int = 8
    max_repeat_pct: int = 30
    level: int = 3
    chunk_bytes: int = 4096
    chunk_band: tuple[float, float] = (1.2, 4.0)
    max_bad_chunks: float = 0.3
    #: Short texts compress badly whatever they say, long prose better, so the
    #: limits rise with length. Last band: no upper end of length.
    bands: tuple[tuple[float, float, float], ...] = (
        (64, 0.0, 3.0), (256, 0.7, 3.0), (1024, 1.05, 3.5), (4096, 1.2, 3.5),
        (16384, 1.3, 4.0), (float("inf"), 1.4, 4.5))


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, ratio double, n_chunks long, "
          "n_bad_chunks long, kept boolean")


def repeated_words(words: list[bytes], window: int) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text.

    Windows are numbered exactly (no hashing): equal pairs of numbered halves
    get equal numbers, doubling the width until it is reached.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    width = 1
    while width < window:
        step = min(width, window - width)
        pair = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        distinct, ids = np.unique(pair, return_inverse=True)
        if len(distinct) == len(ids):
            return 0
        width += step
    twice = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += twice
    edge[window:] -= twice
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def judge(text: bytes, rules: Rules, zip_: zstandard.ZstdCompressor) -> tuple:
    """One row of ``SCHEMA`` without ``doc_id``."""
    words = text.split()  # bytes: ASCII white space only
    chars = len(text.decode("utf-8", "replace"))
    n_space = len(text) - len(text.translate(None, SPACE))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    repeat = repeated_words(words, rules.window)
    failed = len(words) < rules.min_words or 100 * repeat > rules.max_repeat_pct * len(words)
    ratio, n_chunks, bad = 0.0, 0, 0
    kept = not failed
    if text:
        ratio = len(text) / len(zip_.compress(text))
        low, high = next((lo, hi) for end, lo, hi in rules.bands if len(text) < end)
        step, (c_low, c_high) = rules.chunk_bytes, rules.chunk_band
        starts = list(range(0, len(text) - step + 1, step))
        if starts and len(text) % step:
            starts.append(len(text) - step)
        for at in starts:
            n_chunks += 1
            bad += not c_low <= step / len(zip_.compress(text[at:at + step])) <= c_high
        kept = kept and low <= ratio <= high and bad <= rules.max_bad_chunks * n_chunks
    return (len(words), chars - n_space, n_symbols, duplicate_lines(text), repeat, failed,
            ratio, n_chunks, bad, kept)


def measure(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``SCHEMA`` for each row of ``docs`` (doc_id, text)."""
    kinds = [("doc_id", pa.int64()), *[(k, pa.int64()) for k in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        ("base_failed", pa.bool_()), ("ratio", pa.float64()), ("n_chunks", pa.int64()),
        ("n_bad_chunks", pa.int64()), ("kept", pa.bool_())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=rules.level)
        for batch in in_parts(batches):
            out = list(zip(*[judge(t, rules, zip_) for t in blobs(batch)], strict=True))
            if out:
                cols = [batch.column("doc_id"),
                        *[pa.array(v, k) for v, (_, k) in zip(out, kinds[1:], strict=True)]]
                yield pa.RecordBatch.from_arrays(cols, [n for n, _ in kinds])

    return map_batches(only(docs, doc_id="long", text="string"), rows, SCHEMA)


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=rules.level)
        for batch in in_parts(batches):
            yield batch.filter(pa.array([judge(t, rules, zip_)[-1] for t in blobs(batch)],
                                        pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
