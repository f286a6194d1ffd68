"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is normalised (a leading space, spaces as U+2581) and cut into chunks of
``CHUNK`` characters, wherever that falls. The pieces over a cut are its
boundary states: (start, end) of the piece that holds the last character
before the cut. A chunk's transfer matrix has 0 where the pieces of the chunk
can lead from an entry state to an exit state and minus infinity elsewhere.
Matrices are multiplied in the max-plus semiring, an associative product, in
blocks of ``BLOCK`` chunks and then over blocks; this fixes the state at every
cut, and each chunk is backtraced on its own. A text of one chunk has no cut
and needs no matrix; so have most. Giant documents thus spread over many tasks.

For a BPE model the weight of a path is 0 if each two neighbouring pieces stay
as they are when encoded together, which holds for exactly one path: the
encoding of the whole. So ids equal those of the sentencepiece library. No
piece of the model crosses from a non-space to a space (checked when it is
loaded), so between two cuts the part from the first to the last word start is
a chunk of its own, closed on both sides (matrix [[0]]), whose words are
encoded by the library, through a cache; only the words over a cut take the
lattice. A stretch without any space is all lattice.

Defined cases: a null or empty text has no ids and decodes to ``""``; equal
rows get equal results; keys may be null or repeated, as chunks are regrouped
by a hash of the row with its key, and equal rows have equal chunks; other
columns are not read; an empty table gives an empty result. Hot keys: work is
dealt by chunk; a document's chunks meet only as small matrices, in blocks.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_parts, only, per_process, stored

SPACE = "▁"
CHUNK = 32_768
BLOCK = 256
NEG = -np.inf
#: A run of spaces belongs to the word after it.
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

State = tuple[int, int]  # start and end of a piece, in characters from a chunk's start


class Pieces:
    """A sentencepiece BPE model, without its dummy prefix, and its pieces."""

    def __init__(self, path: str, cache_words: int = 120_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if (model.trainer_spec.model_type != model.trainer_spec.BPE
                or spec.name != "identity" or spec.remove_extra_whitespaces):
            raise ValueError("needs a BPE model that keeps texts as they are")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        spec.add_dummy_prefix = False
        self.library = sentencepiece.SentencePieceProcessor(
            model_proto=model.SerializeToString())
        self.ids = {p.piece: i for i, p in enumerate(model.pieces)
                    if p.type in (p.NORMAL, p.USER_DEFINED)}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece crosses a word start")
        self.longest = max(map(len, self.ids))
        self.bytes_of = [self._bytes(i, p) for i, p in enumerate(model.pieces)]
        self.cache_words = cache_words
        self.words: dict[str, bytes] = {}
        self.joint = lru_cache(10_000)(self._joint)
        self.one = lru_cache(10_000)(self._symbol)

    @staticmethod
    def _bytes(i: int, p) -> bytes:
        if p.type == p.BYTE:
            return bytes([int(p.piece[3:5], 16)])
        if p.type == p.NORMAL or p.type == p.USER_DEFINED:
            return p.piece.replace(SPACE, " ").encode()
        return b"" if p.type == p.CONTROL else " ⁇ ".encode()

    def raw(self, text: str) -> list[int]:
        """Ids of normalised text as it stands, by the library."""
        return self.library.encode(text.replace(SPACE, " "))

    def _symbol(self, text: str) -> bool:
        """Whether ``text`` can be one symbol of a path: itself when encoded alone."""
        return len(text) == 1 or (text in self.ids and self.raw(text) == [self.ids[text]])

    def _joint(self, left: str, right: str) -> bool:
        """Whether two symbols stay as they are when encoded together."""
        return self.raw(left + right) == self.raw(left) + self.raw(right)

    def learn(self, words: set[str]) -> None:
        """Encode new words; a call has a cost of its own, so many texts' at once."""
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > self.cache_words:
            self.words = {}
            new = list(words)
        got = self.library.encode([w.replace(SPACE, " ") for w in new], num_threads=1) if new else []
        self.words.update((w, array("I", i).tobytes()) for w, i in zip(new, got, strict=True))

    def word_ids(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian uint32) of normalised texts that begin and end at word starts."""
        found = [WORD.findall(t) for t in texts]
        self.learn(set().union(*found))
        return [b"".join(map(self.words.__getitem__, words)) for words in found]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def pieces(path: str) -> Pieces:
    """The model of this worker process."""
    return per_process(("pieces", path), lambda: Pieces(path))


def _starts(text: str) -> list[int]:
    """Word starts: places of a space after a non-space."""
    out, at = [], text.find(SPACE)
    while at >= 0:
        if at and text[at - 1] != SPACE:
            out.append(at)
        at = text.find(SPACE, at + 1)
    return out


# --- the lattice at a cut ---------------------------------------------------

class Chunk:
    """Characters [0, n) of a chunk with ``longest`` more on either side.

    ``left`` and ``right`` are the halos; a first chunk has no left halo and
    its entry is the single state (0, 0), a last chunk's exits end at n.
    """

    def __init__(self, model: Pieces, left: str, body: str, right: str):
        self.m, self.left, self.n = model, len(left), len(body)
        self.text = left + body + right
        self.size = len(self.text)
        self.last = not right

    def sub(self, a: int, b: int) -> str:
        return self.text[self.left + a:self.left + b]

    def starts(self, at: int) -> bool:
        """A word starts at ``at``."""
        p = self.left + at
        return p > 0 and (p >= self.size or self.text[p] == SPACE != self.text[p - 1])

    def states(self, at: int) -> list[State]:
        """Symbols that may hold the character before the cut at ``at``."""
        if self.left + at == 0:
            return [(0, 0)]
        if self.starts(at) or (at == self.n and self.last):
            return [(at, at)]  # nothing crosses: one state, whatever came before
        out = []
        for a in range(max(at - self.m.longest, -self.left), at):
            for b in range(at, min(at + self.m.longest, self.size - self.left) + 1):
                if self.crosses(a, b):
                    break
                if b - a <= self.m.longest and self.m.one(self.sub(a, b)):
                    out.append((a, b))
        return out

    def walk(self, entry: State, end: int,
             known: dict[int, State] | None = None) -> dict[int, State]:
        """For each place from ``entry`` on up to ``end``, the one symbol of a path that ends there.

        Paths from different entries soon run together; once this one equals
        ``known`` over a stretch no piece can span, the rest is taken from it.
        """
        ends: dict[int, State] = {entry[1]: entry}
        same = none = 0
        for b in range(entry[1] + 1, end + 1):
            for a in range(max(entry[1], b - self.m.longest), b):
                if a not in ends or not self.m.one(self.sub(a, b)) or self.crosses(a, b):
                    continue
                p = ends[a]
                if p[0] == p[1] or self.starts(a) or self.m.joint(self.sub(*p), self.sub(a, b)):
                    ends[b] = (a, b)
                    break
            none = 0 if b in ends else none + 1
            if none > self.m.longest:
                break
            if known is not None:
                same = same + 1 if ends.get(b) == known.get(b) else 0
                if same > 2 * self.m.longest:
                    ends.update((k, v) for k, v in known.items() if b < k <= end)
                    break
        return ends

    def crosses(self, a: int, b: int) -> bool:
        """A word starts strictly between."""
        return any(self.starts(p) for p in range(a + 1, b))

    def resets(self) -> tuple[int, int] | None:
        """The first and last word start inside the chunk, where every path is cut."""
        inner = [s for s in (p - self.left for p in _starts(self.text)) if 0 <= s <= self.n]
        return (inner[0], inner[-1]) if inner else None

    def reach(self, entry: State, exits: list[State], ends: dict[int, State]) -> np.ndarray:
        """0 for exits that a path with symbols ``ends`` can take as its next state."""
        out = np.full(len(exits), NEG)
        for k, (a, b) in enumerate(exits):
            if a == b:
                ok = a in ends
            elif (a, b) == entry:
                ok = True
            else:
                ok = a in ends and a >= entry[1] and (
                    ends[a][0] == ends[a][1] or self.starts(a)
                    or self.m.joint(self.sub(*ends[a]), self.sub(a, b)))
            if ok:
                out[k] = 0.0
        return out

    def matrix(self) -> tuple[list[State], list[State], np.ndarray]:
        """Entry states, exit states and the transfer matrix between them."""
        entries, exits, cut = self.states(0), self.states(self.n), self.resets()
        if cut is None:
            rows, known = [], None
            for e in entries:
                ends = self.walk(e, self.n, known)
                if known is None and self.n in ends:
                    known = ends
                rows.append(self.reach(e, exits, ends))
            return entries, exits, np.array(rows).reshape(len(entries), len(exits))
        first, last = cut
        into = np.array([0.0 if e[1] <= first and first in self.walk(e, first) else NEG
                         for e in entries])
        out = self.reach((last, last), exits, self.walk((last, last), self.n))
        return entries, exits, into[:, None] + out[None, :]

    def backtrace(self, entry: State, exit_: State) -> bytes:
        """Ids of the symbols after ``entry`` up to and with ``exit_``."""
        cut = self.resets()
        spans: list[tuple[int, int]] = []

        def back(ends: dict[int, State], at: int, start: int) -> list[State]:
            out = []
            while at > start:
                out.append(ends[at])
                at = ends[at][0]
            return out[::-1]

        if cut is None:
            if exit_ == entry and entry[0] != entry[1]:
                return b""
            spans = back(self.walk(entry, exit_[0]), exit_[0], entry[1])
            return self.ids([*spans, *([exit_] if exit_[1] > exit_[0] else [])])
        first, last = cut
        head = self.ids(back(self.walk(entry, first), first, entry[1]))
        tail = back(self.walk((last, last), exit_[0]), exit_[0], last)
        tail = self.ids([*tail, *([exit_] if exit_[1] > exit_[0] else [])])
        return head + self.m.word_ids([self.sub(first, last)])[0] + tail

    def ids(self, spans: list[State]) -> bytes:
        out: list[int] = []
        for a, b in spans:
            s = self.sub(a, b)
            out += [self.m.ids[s]] if s in self.m.ids else self.m.raw(s)
        return np.array(out, "<u4").tobytes()


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus matrix product."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def best_states(matrices: list[np.ndarray], entry: int, exit_: int) -> list[int]:
    """States at all cuts of a row of chunks, from ``entry`` to ``exit_``."""
    ahead = [np.full(matrices[0].shape[0], NEG)]
    ahead[0][entry] = 0.0
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).max(0))
    out = [exit_]
    for m, f in zip(matrices[::-1], ahead[-2::-1], strict=True):
        out.append(int(np.argmax(f + m[:, out[-1]])))
    return out[::-1]


# --- on Spark ---------------------------------------------------------------

_CHUNK = "doc_id long, key long, n_chunks int, chunk int, head string, body string, tail string"
_ENCODED = "doc_id long, key long, n_chunks int, chunk int, ids binary"


def _chunks(keyed: DataFrame, model: str, size: int) -> DataFrame:
    """Chunks with their halos."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        halo = m.longest + 1
        for batch in batches:
            for doc, key, text in zip(*[batch.column(c).to_pylist()
                                        for c in ("doc_id", "key", "text")], strict=True):
                t = m.prefix + text.replace(" ", SPACE)
                n = -(-len(t) // size)
                for at in range(0, n, 64):  # a giant text leaves in parts
                    yield _batch([(doc, key, n, k, t[max(0, k * size - halo):k * size],
                                   t[k * size:(k + 1) * size],
                                   t[(k + 1) * size:(k + 1) * size + halo])
                                  for k in range(at, min(at + 64, n))], _CHUNK)

    return keyed.mapInArrow(rows, _CHUNK)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    cols = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[k]) for c, (_, k) in zip(cols, fields, strict=True)],
        [n for n, _ in fields])


def _pack(m: np.ndarray) -> bytes:
    return np.array(m.shape, "<i4").tobytes() + (m == 0).astype("u1").tobytes()


def _unpack(b: bytes) -> np.ndarray:
    r, c = np.frombuffer(b[:8], "<i4")
    return np.where(np.frombuffer(b[8:], "u1").reshape(r, c) == 1, 0.0, NEG)


def encode_chunks(docs: DataFrame, model: str, size: int = CHUNK) -> DataFrame:
    """(doc_id, key, n_chunks, chunk, ids): ids of each chunk, little-endian uint32."""
    whole, traced = _encoded(docs, model, size)
    return whole.unionByName(traced)


def _encoded(docs: DataFrame, model: str, size: int) -> tuple[DataFrame, DataFrame]:
    """``encode_chunks`` of texts of one chunk, which are final, and of longer ones."""
    keyed = only(docs, doc_id="long", text="string") \
        .withColumn("key", F.xxhash64("doc_id", "text"))
    # one character more than the text for the leading space
    fits = F.coalesce(F.length("text") < size, F.lit(True))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        for batch in in_parts(batches, 200):
            docs_, keys, texts = [batch.column(c).to_pylist() for c in ("doc_id", "key", "text")]
            ids = m.word_ids([m.prefix + t.replace(" ", SPACE) if t else "" for t in texts])
            yield _batch([(d, k, 1, 0, i) for d, k, i in zip(docs_, keys, ids, strict=True)],
                         _ENCODED)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        for batch in batches:
            yield _batch([(r["doc_id"], r["key"], r["chunk"],
                           _pack(Chunk(m, r["head"], r["body"], r["tail"]).matrix()[2]))
                          for r in batch.to_pylist()], "doc_id long, key long, chunk int, m binary")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                c = Chunk(m, r["head"], r["body"], r["tail"])
                out.append((r["doc_id"], r["key"], r["n_chunks"], r["chunk"],
                            c.backtrace(c.states(0)[r["entry"]], c.states(c.n)[r["exit"]])))
            yield _batch(out, _ENCODED)

    whole = keyed.where(fits).mapInArrow(short, _ENCODED)
    # equal rows have equal chunks: one of each is scanned, all are joined to the result
    long_ = stored(_chunks(keyed.where(~fits), model, size).repartition("key", "chunk"), "chunks")
    cut = long_.select("doc_id", "key", "chunk", "head", "body", "tail") \
        .mapInArrow(matrices, "doc_id long, key long, chunk int, m binary") \
        .dropDuplicates(["key", "chunk"])
    states = _scan(stored(cut.select("key", "chunk", "m"), "matrices"))
    joined = long_.join(states, ["key", "chunk"]) \
        .select("doc_id", "key", "n_chunks", "chunk", "head", "body", "tail", "entry", "exit")
    return whole, joined.mapInArrow(traced, _ENCODED)


def _scan(matrices: DataFrame) -> DataFrame:
    """(key, chunk, entry, exit): indexes of the states before and after each chunk."""
    blocked = matrices.withColumn("block", (F.col("chunk") / BLOCK).cast("int"))

    def product(pdf):
        import pandas as pd

        pdf = pdf.sort_values("chunk")
        out = _unpack(pdf["m"].iloc[0])
        for m in pdf["m"].iloc[1:]:
            out = times(out, _unpack(m))
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "block": [pdf["block"].iloc[0]],
                             "m": [_pack(out)]})

    def over_blocks(pdf):
        import pandas as pd

        pdf = pdf.sort_values("block")
        s = best_states([_unpack(m) for m in pdf["m"]], 0, 0)
        return pd.DataFrame({"key": pdf["key"].to_numpy(), "block": pdf["block"].to_numpy(),
                             "entry": s[:-1], "exit": s[1:]})

    def within(pdf):
        import pandas as pd

        pdf = pdf.sort_values("chunk")
        s = best_states([_unpack(m) for m in pdf["m"]], int(pdf["entry"].iloc[0]),
                        int(pdf["exit"].iloc[0]))
        return pd.DataFrame({"key": pdf["key"].to_numpy(), "chunk": pdf["chunk"].to_numpy(),
                             "entry": s[:-1], "exit": s[1:]})

    totals = blocked.groupBy("key", "block").applyInPandas(
        product, "key long, block int, m binary")
    ends = totals.groupBy("key").applyInPandas(
        over_blocks, "key long, block int, entry int, exit int")
    return blocked.join(ends, ["key", "block"]).groupBy("key", "block").applyInPandas(
        within, "key long, chunk int, entry int, exit int")


def encode(docs: DataFrame, model: str, size: int = CHUNK) -> DataFrame:
    """(doc_id, ids): the whole encoding of each row, little-endian uint32."""
    whole, traced = _encoded(docs, model, size)
    # equal rows: their chunks lie on one another; number the copies to keep them apart
    many = traced.groupBy("doc_id", "key", "n_chunks", "chunk") \
        .agg(F.first("ids").alias("ids"), F.count(F.lit(1)).alias("copies")) \
        .groupBy("doc_id", "key").agg(
            F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("c"),
            F.min("copies").alias("copies")) \
        .select("doc_id", F.expr("concat_ws('', transform(c, x -> hex(x.ids)))").alias("hex"),
                F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")) \
        .select("doc_id", F.unhex("hex").alias("ids"))
    return whole.select("doc_id", "ids").unionByName(many)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        for batch in in_parts(batches, 200):
            texts = [m.decode(np.frombuffer(b or b"", "<u4"))
                     for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    return encoded.select(encoded["doc_id"].cast("long").alias("doc_id"), "ids") \
        .mapInArrow(rows, "doc_id long, text string")


def digest(encoded: DataFrame, model: str) -> DataFrame:
    """Per row of (doc_id, ids): n_tokens, ids_crc32, and of the decoded text n_chars, text_crc32."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        for batch in in_parts(batches, 200):
            ids = [b or b"" for b in batch.column("ids").to_pylist()]
            texts = [m.decode(np.frombuffer(b, "<u4")) for b in ids]
            yield _batch([(d, len(b) // 4, zlib.crc32(b), len(t), zlib.crc32(t.encode()))
                          for d, b, t in zip(batch.column("doc_id").to_pylist(), ids, texts,
                                             strict=True)], schema)

    schema = "doc_id long, n_tokens long, ids_crc32 long, n_chars long, text_crc32 long"
    return encoded.select(encoded["doc_id"].cast("long").alias("doc_id"), "ids") \
        .mapInArrow(rows, schema)
