"""Cross-tokenizer alignment by sparse products of incidence matrices.

Two tokenizers cut the same bytes. A[i, k] is 1 if byte k lies in token i of
the first, B[j, k] likewise for the second. The matrices are held as
compressed rows (CSR) built here, and products are Gustavson's: each stored
entry (i, k) of the left adds row k of the right to row i. A·Bᵀ gives the
overlap links with their bytes. Where the last link of a row ends before the
first link of the next, both tokenizers end at one byte, and a group is cut;
the product of the two token-group incidences gives all links within groups.
Documents of a batch lie on one another as a block-diagonal matrix. Rows are
multiplied in slices of bounded size, so a text without common ends costs time,
not memory.

Scale: a task gathers documents to a block of about ``BLOCK_BYTES`` of text and
keeps, for each document, its distinct linked id pairs as places in the block's
list of pairs. Only these lists meet over the corpus: a pair's document count
is a sum over blocks, joined back to the blocks that hold it. No token and no
text is shuffled.

Defined cases: texts that are null, empty, or whose token bytes do not join to
a space and the text have no tokens: zeros and an empty digest, and they add to
no count; repeated rows and null doc_ids are rows of their own; a very long
text is aligned by segments; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_parts, only, per_process, stored
from .sentence_pieces import Pieces

#: Bytes of text that are encoded and multiplied at once, and that share a list of pairs.
PART_BYTES = 1 << 20
BLOCK_BYTES = 1 << 24
#: Stored entries of a slice of a product.
SLICE = 1 << 21
#: Where a long text may be cut: no token of either kind lies over it.
CUT = re.compile(rb"(?<=[!-~]) (?=[!-~])")


# --- sparse matrices ---------------------------------------------------------

class Csr(NamedTuple):
    """Compressed rows: ``cols[ptr[i]:ptr[i + 1]]`` and ``vals`` of the same places are row i."""

    ptr: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    width: int

    def rows(self) -> np.ndarray:
        """The row of each stored entry."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.cols, kind="stable")
    ptr = np.concatenate([[0], np.cumsum(np.bincount(m.cols, minlength=m.width))])
    return Csr(ptr, m.rows()[order], m.vals[order], len(m.ptr) - 1)


def spans(lengths: np.ndarray) -> Csr:
    """Token-byte incidence: row i has its token's bytes, which follow those of row i - 1."""
    ptr = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(ptr, np.arange(ptr[-1]), np.ones(ptr[-1], np.int64), int(ptr[-1]))


def members(group: np.ndarray, n_groups: int) -> Csr:
    """Token-group incidence."""
    n = len(group)
    return Csr(np.arange(n + 1), group, np.ones(n, np.int64), n_groups)


def products(a: Csr, b: Csr, entries: int = SLICE) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, col, value) of a·b, whole rows of ``a`` at a time, sorted.

    A slice of rows has about ``entries`` terms, or one row.
    """
    terms = np.diff(b.ptr)[a.cols]
    upto = np.concatenate([[0], np.cumsum(terms)])[a.ptr]
    rows = a.rows()
    at, n_rows = 0, len(a.ptr) - 1
    while at < n_rows:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + entries, "right")) - 1)
        lo, hi = a.ptr[at], a.ptr[end]
        n = terms[lo:hi]
        first = np.repeat(b.ptr[a.cols[lo:hi]] - np.concatenate([[0], np.cumsum(n)[:-1]])
                          if hi > lo else n, n)
        place = first + np.arange(len(first))
        i, j = np.repeat(rows[lo:hi], n), b.cols[place]
        v = np.repeat(a.vals[lo:hi], n) * b.vals[place]
        key = i * b.width + j
        if len(key) and (np.diff(key) < 0).any():
            order = np.argsort(key, kind="stable")
            key, i, j, v = key[order], i[order], j[order], v[order]
        if len(key):
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            yield i[new], j[new], np.add.reduceat(v, new)
        at = end


class Aligned(NamedTuple):
    """Overlap links (rows, columns, bytes) and each token's group."""

    row: np.ndarray
    col: np.ndarray
    size: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int


def aligned(len_a: np.ndarray, len_b: np.ndarray) -> Aligned:
    """Of two cuts of the same bytes, by the tokens' byte lengths."""
    got = list(products(spans(len_a), transposed(spans(len_b))))
    if not got:
        none = np.zeros(0, np.int64)
        return Aligned(none, none, none, none, none, 0)
    row, col, size = (np.concatenate(x) for x in zip(*got, strict=True))
    new = np.concatenate([[True], row[1:] != row[:-1]])  # first link of a row
    cut = new & np.concatenate([[True], col[1:] != col[:-1]])  # shares no token with the one before
    group = np.cumsum(cut) - 1
    group_b = np.zeros(len(len_b), np.int64)
    group_b[col] = group
    return Aligned(row, col, size, group[new], group_b, int(group[-1]) + 1)


# --- tokenizers ----------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens and the texts of their ids."""

    def __init__(self, byte_level: str, piece_model: str, pattern: str):
        import tiktoken

        with open(byte_level, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        special = {t["id"] for t in spec.get("added_tokens", [])}
        vocab = spec["model"]["vocab"]
        ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in vocab.items()
                 if i not in special}
        merged = ("".join(m if isinstance(m, list) else m.split(" "))
                  for m in spec["model"]["merges"])
        places = [vocab[t] for t in merged]
        if places != sorted(places):
            raise ValueError("needs merges in the order of their ids")
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = Pieces(piece_model)
        self.n_a = max(vocab.values()) + 1
        self.bytes_a = [b""] * self.n_a
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = self.b.bytes_of
        self.n_b = len(self.bytes_b)
        self.len_a = np.array([len(x) for x in self.bytes_a])
        self.len_b = np.array([len(x) for x in self.bytes_b])
        # ids as text: a token within its group, the group's last A token, its last B token
        self.said = [f"{i},".encode() for i in range(max(self.n_a, self.n_b))]
        self.bar = [f"{i}|".encode() for i in range(self.n_a)]
        self.stop = [f"{i};".encode() for i in range(self.n_b)]
        self.texts = self.said + self.bar + self.stop

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for each text (UTF-8); empty where the bytes do not agree."""
        plain = [t.decode("utf-8", "replace") for t in texts]
        # the model is held without the space that it puts before a text
        ids_b = self.b.library.encode([" " + t for t in plain], num_threads=1)
        out = []
        for raw, text, b in zip(texts, plain, ids_b, strict=True):
            a = self.a.encode_ordinary(" " + text)
            want = b" " + raw
            same = raw and b"".join(map(self.bytes_a.__getitem__, a)) == want \
                and b"".join(map(self.bytes_b.__getitem__, b)) == want
            out.append((np.array(a if same else [], np.int64),
                        np.array(b if same else [], np.int64)))
        return out

    def lines(self, a: np.ndarray, b: np.ndarray, got: Aligned, per_doc: np.ndarray) -> list[bytes]:
        """Of each document ``a1,a2|b1;a3|b2,b3``; ``per_doc``: tokens of both."""
        n_a = np.bincount(got.group_a, minlength=got.n_groups)
        n_b = np.bincount(got.group_b, minlength=got.n_groups)
        before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        last_a = np.concatenate([got.group_a[1:] != got.group_a[:-1], [True]])
        last_b = np.concatenate([got.group_b[1:] != got.group_b[:-1], [True]])
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + before_b[got.group_a]] = np.where(last_a, a + len(self.said), a)
        line[np.arange(len(b)) + (before_a + n_a)[got.group_b]] = \
            np.where(last_b, b + len(self.said) + len(self.bar), b)
        ends = np.cumsum(per_doc)
        return [b"".join(map(self.texts.__getitem__, line[e - n:e].tolist()))[:-1]
                for e, n in zip(ends, per_doc, strict=True)]


def tokenizers(byte_level: str, piece_model: str, pattern: str) -> Tokenizers:
    return per_process(("aligned", byte_level, piece_model),
                       lambda: Tokenizers(byte_level, piece_model, pattern))


# --- blocks --------------------------------------------------------------------

def _packed(x: np.ndarray) -> bytes:
    """Whole numbers under 2^32, byte planes apart, compressed."""
    planes = np.ascontiguousarray(x.astype("<u4").view("u1").reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), "u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of sorted ``keys`` and how often each stands there."""
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) \
        else np.zeros(0, np.int64)
    return keys[new], np.diff(np.append(new, len(keys)))


class Part(NamedTuple):
    """What ``align_part`` finds: counts and digests by document; their linked id pairs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_overlaps: np.ndarray
    n_links: np.ndarray
    lines: list[bytes]
    n_pairs: np.ndarray
    pairs: np.ndarray  # distinct within a document, a * n_b + b, ascending
    often: np.ndarray  # links of each


def align_part(tok: Tokenizers, texts: list[bytes]) -> Part:
    ids = tok.encode(texts)
    n = len(texts)
    n_a = np.array([len(a) for a, _ in ids], np.int64)
    n_b = np.array([len(b) for _, b in ids], np.int64)
    a = np.concatenate([x for x, _ in ids])
    b = np.concatenate([x for _, x in ids])
    got = aligned(tok.len_a[a], tok.len_b[b])
    doc_a = np.repeat(np.arange(n), n_a)
    first = np.concatenate([[True], got.group_a[1:] != got.group_a[:-1]])[:len(a)]
    all_pairs = tok.n_a * tok.n_b
    found, often = [], []
    groups = members(got.group_a, got.n_groups)
    for i, j, _ in products(groups, transposed(members(got.group_b, got.n_groups))):
        keys, k = runs(np.sort(doc_a[i] * all_pairs + a[i] * tok.n_b + b[j]))
        found.append(keys)
        often.append(k)
    keys = np.concatenate(found) if found else np.zeros(0, np.int64)
    k = np.concatenate(often) if often else keys
    if len(found) > 1:  # a document may lie in several slices
        order = np.argsort(keys, kind="stable")
        keys, k = keys[order], k[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, k = keys[new], np.add.reduceat(k, new)
    doc = keys // all_pairs
    return Part(n_a, n_b, np.bincount(doc_a[first], minlength=n),
                np.bincount(doc_a[got.row], minlength=n),
                np.bincount(doc, weights=k, minlength=n).astype(np.int64),
                tok.lines(a, b, got, n_a + n_b) if len(a) else [b""] * n,
                np.bincount(doc, minlength=n), keys % all_pairs, k)


def align_long(tok: Tokenizers, text: bytes, part_bytes: int = PART_BYTES) -> Part:
    """``align_part`` of one long text, by segments of about ``part_bytes``.

    Neither tokenizer has a token over a space between two printable ASCII
    characters, so the text is cut before such spaces, and the space before a
    segment is its own. A stretch without one is taken whole.
    """
    sums = np.zeros(5, np.int64)
    whole = hashlib.sha256()
    pairs = often = np.zeros(0, np.int64)
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + part_bytes)
        end = cut.start() if cut else len(text)
        p = align_part(tok, [text[at:end]])
        if not p.n_a[0]:  # the bytes differ: no tokens at all
            return align_part(tok, [b""])
        sums += [x[0] for x in (p.n_a, p.n_b, p.n_groups, p.n_overlaps, p.n_links)]
        whole.update((b";" if at else b"") + p.lines[0])
        both = np.concatenate([pairs, p.pairs])
        order = np.argsort(both, kind="stable")
        both, k = both[order], np.concatenate([often, p.often])[order]
        new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        pairs, often = both[new], np.add.reduceat(k, new)
        at = end + 1
    return Part(*sums[:, None], [whole], np.array([len(pairs)]), pairs, often)


_BLOCK = pa.schema([
    ("block", pa.int64()), ("pairs", pa.binary()), ("n_docs", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.binary()), ("n_b", pa.binary()),
    ("n_groups", pa.binary()), ("n_overlaps", pa.binary()), ("n_links", pa.list_(pa.int64())),
    ("digests", pa.list_(pa.string())), ("n_pairs", pa.binary()), ("steps", pa.binary()),
    ("often", pa.binary())])
BLOCK = ("block long, pairs binary, n_docs binary, doc_ids array<long>, n_a binary, n_b binary, "
         "n_groups binary, n_overlaps binary, n_links array<long>, digests array<string>, "
         "n_pairs binary, steps binary, often binary")


def _digest(line) -> str:
    """Of a line, or of the running hash of a long text's; empty without tokens."""
    if isinstance(line, bytes):
        return hashlib.sha256(line).hexdigest() if line else ""
    return line.hexdigest()


def _block_row(block: int, doc_ids: list, parts: list[Part]) -> pa.RecordBatch:
    def over(name: str) -> np.ndarray:
        return np.concatenate([getattr(p, name) for p in parts])

    pairs, n_pairs = over("pairs"), over("n_pairs")
    known, place, n_docs = np.unique(pairs, return_inverse=True, return_counts=True)
    # places rise within a document: steps between them are small
    steps = np.diff(place, prepend=0)
    starts = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
    steps[starts] = place[starts]
    row = {"block": block, "pairs": known.astype("<i8").tobytes(), "n_docs": _packed(n_docs),
           "doc_ids": doc_ids, "n_a": _packed(over("n_a")), "n_b": _packed(over("n_b")),
           "n_groups": _packed(over("n_groups")), "n_overlaps": _packed(over("n_overlaps")),
           "n_links": over("n_links").tolist(),
           "digests": [_digest(x) for p in parts for x in p.lines], "n_pairs": _packed(n_pairs),
           "steps": _packed(steps), "often": _packed(over("often"))}
    return pa.RecordBatch.from_pylist([row], _BLOCK)


def blocks(docs: DataFrame, byte_level: str, piece_model: str, pattern: str,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents aligned and gathered to blocks (``BLOCK``)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(byte_level, piece_model, pattern)
        block, held = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        parts: list[Part] = []
        texts: list[bytes] = []
        size = 0
        for batch in in_parts(batches, 100):
            texts_of = batch.column("text").cast(pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of, strict=True):
                raw = text.as_py() or b""
                if texts and size + len(raw) > PART_BYTES:
                    parts.append(align_part(tok, texts))
                    texts, held, size = [], held + size, 0
                if held >= block_bytes:
                    yield _block_row(block, ids, parts)
                    block, held, ids, parts = block + 1, 0, [], []
                ids.append(doc_id)
                if len(raw) > PART_BYTES:
                    parts.append(align_long(tok, raw))
                    held += len(raw)
                else:
                    texts.append(raw)
                    size += len(raw)
        if texts:
            parts.append(align_part(tok, texts))
        if parts:
            yield _block_row(block, ids, parts)

    return only(docs, doc_id="long", text="string").mapInArrow(rows, BLOCK)


def pair_counts(got: DataFrame, n_b: int) -> tuple[DataFrame, DataFrame]:
    """(block, place, pair, n) of each block's pairs, and (pair, count, best) over the corpus.

    ``count`` documents hold the pair linked; ``best``: no pair of the same A id has more.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                pairs = np.frombuffer(r["pairs"], "<i8")
                if len(pairs):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(pairs), r["block"])),
                         pa.array(np.arange(len(pairs), dtype=np.int32)), pa.array(pairs),
                         pa.array(_unpacked(r["n_docs"]))], ["block", "place", "pair", "n"])

    listed = got.select("block", "pairs", "n_docs").mapInArrow(
        rows, "block long, place int, pair long, n long")
    counts = stored(listed.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    a = F.expr(f"pair div {n_b}")
    most = counts.groupBy(a.alias("_a")).agg(F.max("count").alias("_most"))
    best = counts.withColumn("_id", a).join(most, F.col("_id") == F.col("_a")) \
        .select("pair", "count", (F.col("count") == F.col("_most")).alias("best"))
    return listed, best


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_overlaps long, n_links long, "
          "n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, byte_level: str, piece_model: str, pattern: str,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``RESULT``. ``byte_level``: a tokenizers file of a byte-level BPE;
    ``piece_model``: a sentencepiece BPE model; ``pattern``: the former's word pattern."""
    from sentencepiece import SentencePieceProcessor

    n_b = SentencePieceProcessor(model_file=piece_model).get_piece_size()
    got = stored(blocks(docs, byte_level, piece_model, pattern, block_bytes), "blocks")
    listed, best = pair_counts(got, n_b)
    met = listed.select("block", "place", "pair").join(best, "pair") \
        .select("block", "place", "count", "best")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in RESULT.split(", ")]
        types = [pa.string() if n == "groups_sha256" else pa.int64() for n in names]
        if not left.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, types, strict=True)})
        r = left.to_pylist()[0]
        count = np.zeros(right.num_rows, np.int64)
        is_best = np.zeros(right.num_rows, bool)
        place = right.column("place").to_numpy()
        count[place] = right.column("count").to_numpy()
        is_best[place] = right.column("best").to_numpy()
        n_pairs, often = _unpacked(r["n_pairs"]), _unpacked(r["often"])
        steps = _unpacked(r["steps"])
        total = np.cumsum(steps)
        ends = np.cumsum(n_pairs)
        starts = ends - n_pairs
        base = np.concatenate([[0], total])[starts]  # steps begin anew in each document
        at = total - np.repeat(base, n_pairs)

        def by_doc(x: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(x)])
            return upto[ends] - upto[starts]

        cols = [r["doc_ids"], *[_unpacked(r[n]) for n in ("n_a", "n_b", "n_groups", "n_overlaps")],
                r["n_links"], by_doc(often * is_best[at]), by_doc(often * count[at]), r["digests"]]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, cols, types, strict=True)})

    return got.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(finish, RESULT)


LINK = "doc_id long, a_place long, b_place long, a_id long, b_id long, n_bytes long"


def overlap_links(docs: DataFrame, byte_level: str, piece_model: str, pattern: str) -> DataFrame:
    """Every pair of overlapping tokens: places in the document, ids, shared bytes (``LINK``)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(byte_level, piece_model, pattern)
        for batch in in_parts(batches, 1):
            raw = batch.column("text").cast(pa.binary())[0].as_py() or b""
            (a, b), = tok.encode([raw])
            got = aligned(tok.len_a[a], tok.len_b[b])
            doc_id = pa.array([batch.column("doc_id")[0].as_py()] * len(got.row), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [doc_id, *map(pa.array, (got.row, got.col, a[got.row], b[got.col], got.size))],
                [c.split()[0] for c in LINK.split(", ")])

    return only(docs, doc_id="long", text="string").mapInArrow(rows, LINK)
