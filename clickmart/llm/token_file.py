"""Token-ID output as directly addressable codes.

An id is split into chunks of a few bits, lowest first. Level k holds the k-th
chunk of every id that has one; a bitmap beside it says which ids go on to the
next level, and a directory of ranks (ones before each 512-bit block) finds an
id's place there. Any token is thus read by position, without decoding its
neighbours.

Files: a Parquet table of segments. A segment holds whole consecutive
documents (at least one, up to about ``segment_ids`` ids) of one shard; shards
are ranges of ascending (doc_id, text), written in order by one task each.
Columns: shard, seq, start (ids of the shard before it), n_ids, doc_ids,
n_tokens, levels, bitmaps, ranks.

Defined cases: a null or empty text has the end id alone; a null doc_id sorts
first; rows with one doc_id are ordered by a hash of their text and stay
separate; other columns are not read; an empty table gives no segments. Hot
keys: shards are cut by (doc_id, text hash), so only exact copies of one row
stay together, and a shard is written as a stream of segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blobs, in_parts, only
from .word_encoder import word_encoder

#: Bits of the chunks of an id, lowest first.
WIDTHS = (8, 8, 16)
BLOCK = 512
SEGMENT_IDS = 1 << 18
SEGMENT = ("shard int, seq long, start long, n_ids long, doc_ids array<long>, "
           "n_tokens array<long>, levels array<binary>, bitmaps array<binary>, "
           "ranks array<binary>")
_ARROW = pa.schema([("shard", pa.int32()), ("seq", pa.int64()), ("start", pa.int64()),
                    ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("n_tokens", pa.list_(pa.int64())), ("levels", pa.list_(pa.binary())),
                    ("bitmaps", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary()))])


def _dtype(width: int) -> str:
    return "u1" if width <= 8 else "<u2" if width <= 16 else "<u4"


def pack(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> dict[str, list[bytes]]:
    """Levels, continuation bitmaps and rank directories of uint32 ``ids``."""
    out: dict[str, list[bytes]] = {"levels": [], "bitmaps": [], "ranks": []}
    rest = np.asarray(ids, np.uint32)
    for k, width in enumerate(widths):
        out["levels"].append((rest & np.uint32((1 << width) - 1)).astype(_dtype(width)).tobytes())
        rest = rest >> np.uint32(width)
        if k + 1 < len(widths):
            more = rest != 0
            ones = np.add.reduceat(more, range(0, len(more), BLOCK), dtype=np.int64) \
                if len(more) else np.zeros(0, np.int64)
            out["bitmaps"].append(np.packbits(more, bitorder="little").tobytes())
            out["ranks"].append((np.cumsum(ones) - ones).astype("<u4").tobytes())
            rest = rest[more]
    if rest.any():
        raise ValueError("an id has more bits than the levels hold")
    return out


def unpack(levels: list[bytes], bitmaps: list[bytes],
           widths: tuple[int, ...] = WIDTHS) -> np.ndarray:
    """All ids of a segment."""
    out = np.frombuffer(levels[0], _dtype(widths[0])).astype("<u4")
    where, shift = None, 0
    for k in range(1, len(widths)):
        n = len(levels[k - 1]) // np.dtype(_dtype(widths[k - 1])).itemsize
        go = np.flatnonzero(np.unpackbits(np.frombuffer(bitmaps[k - 1], "u1"), count=n,
                                          bitorder="little"))
        where = go if where is None else where[go]
        shift += widths[k - 1]
        out[where] |= np.frombuffer(levels[k], _dtype(widths[k])).astype("<u4") << np.uint32(shift)
    return out


def access(segment: dict, i: int, widths: tuple[int, ...] = WIDTHS) -> int:
    """The id at place ``i`` of a segment, by one rank per level."""
    value = shift = 0
    for k, width in enumerate(widths):
        size = np.dtype(_dtype(width)).itemsize
        value |= int.from_bytes(segment["levels"][k][i * size:(i + 1) * size], "little") << shift
        shift += width
        if k + 1 == len(widths):
            break
        bits, block = segment["bitmaps"][k], i // BLOCK
        if not bits[i >> 3] >> (i & 7) & 1:
            break
        before = int.from_bytes(bits[block * BLOCK // 8:(i >> 3) + 1], "little")
        before &= (1 << (i - block * BLOCK)) - 1
        rank = int.from_bytes(segment["ranks"][k][4 * block:4 * block + 4], "little")
        i = rank + before.bit_count()
    return value


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1,
          segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs`` (doc_id, text) and write them to the folder ``path``."""
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        shard, seq, start = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        doc_ids: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = {"shard": shard, "seq": seq, "start": start, "n_ids": len(ids),
                   "doc_ids": doc_ids, "n_tokens": [len(p) // 4 for p in parts], **pack(ids)}
            return pa.RecordBatch.from_pylist([row], _ARROW)

        for batch in in_parts(batches, 2000):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   encoder.encode(blobs(batch)), strict=True):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                held += len(parts[-1]) // 4
                if held >= segment_ids:
                    yield segment()
                    seq, start, doc_ids, parts, held = seq + 1, start + held, [], [], 0
        if parts:
            yield segment()

    rows = only(docs, doc_id="long", text="string")
    tie = F.xxhash64("text")
    (rows.repartitionByRange(rows["doc_id"], tie).sortWithinPartitions(rows["doc_id"], tie)
     .mapInArrow(segments, SEGMENT).write.parquet(path))


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of ``path``; ``start`` counts all ids before a segment.

    The ids before a shard are summed over the shards' totals, a table of one
    row per write task, which bounds the one-task window and the broadcast.
    """
    segs = spark.read.schema(SEGMENT).parquet(path)
    before = (segs.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n"))
                      .alias("before")))
    return (segs.join(F.broadcast(before), "shard")
            .withColumn("start", F.col("start") + F.col("before")).drop("before"))


DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the files: ``DOCUMENT``; ids are little-endian uint32."""
    schema = DOCUMENT if with_ids else DOCUMENT.rpartition(",")[0]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seg in batch.to_pylist():
                data = unpack(seg["levels"], seg["bitmaps"]).tobytes()
                ends = np.cumsum(seg["n_tokens"])
                starts = ends - seg["n_tokens"]
                ids = [data[4 * a:4 * b] for a, b in zip(starts, ends, strict=True)]
                cols = [pa.array(seg["doc_ids"], pa.int64()),
                        pa.array(starts + seg["start"], pa.int64()),
                        pa.array(seg["n_tokens"], pa.int64()),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return segments(spark, path).mapInArrow(rows, schema)


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, id) for each global ``position`` (long) that the files hold.

    Positions are bucketed by segment start, joined to their segment, and read
    with one rank per level; no segment is decoded.
    """
    segs = segments(spark, path)
    wide = segs.select("*", F.explode(F.sequence(
        F.floor(F.col("start") / SEGMENT_IDS),
        F.floor((F.col("start") + F.col("n_ids") - 1) / SEGMENT_IDS))).alias("__bucket"))
    asked = positions.select(F.col("position").cast("long").alias("position")).distinct() \
        .withColumn("__bucket", F.floor(F.col("position") / SEGMENT_IDS))
    met = (wide.join(asked, "__bucket")
           .where((F.col("position") >= F.col("start"))
                  & (F.col("position") < F.col("start") + F.col("n_ids")))
           .select("position", (F.col("position") - F.col("start")).alias("place"),
                   "levels", "bitmaps", "ranks"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = batch.to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("position"),
                 pa.array([access(r, r["place"]) for r in got], pa.int64())], ["position", "id"])

    return met.mapInArrow(rows, "position long, id long")
