"""Mixing, collocations and alignment against brute force, on whole small tables and odd rows."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickmart.llm import alignment, collocations, mixing
from clickmart.llm import queries as Q

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, " \n\t ", "one", "a b c, a b c. A B c", "É" * 50, "x" * 30_000, "word " * 4_000,
         "\x00\x1f\x85", "Ünïcode straße ΑΒΓ 漢字 👍🏽", "a  b   c    ", "▁ looks like a space",
         "<|endoftext|> <s> <0x41>", "same text here " * 9, "same text here " * 9, " led", "'s don't"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, null and repeated keys, repeated rows, and columns with clashing names."""
    rows = [(i if i != 3 else None, t, ["en", None, "und"][i % 3], ["s1", None, "", "S"][i % 4], 7, "x")
            for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (4, "another text of one key", "en", "s1", 7, "x")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, size int, _part string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def collected(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


# 11 --------------------------------------------------------------------------

def dealt(sizes, weights=(3, 1, 2), share=Fraction(3, 2), cap=2):
    """Targets by dealing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full, got = share * sum(sizes.values()), {}, {}
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        got = {s: left * w[s] / sum(w[x] for x in rest) for s in rest} | full
        above = [s for s in rest if got[s] > cap * sizes[s]]
        if not above:
            return got
        full |= {s: Fraction(cap * sizes[s]) for s in above}


def drawn(rows, seed="mix"):
    """[(doc_id, size, source_size, target, taken)] document by document."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = Counter()
    for (_, _, s), n in zip(rows, size, strict=True):
        sizes[s] += n
    target = {s: float(t) for s, t in dealt(sizes).items()}
    out = []
    for s in sizes:
        name = f"{seed}:" + ("n" if s is None else "s" + s)
        at = int(hashlib.md5(name.encode()).hexdigest()[:6], 16)
        step = int(np.floor(target[s] / sizes[s] * mixing.ONE + 0.5)) if sizes[s] else 0
        of = [(n, r[0]) for r, n in zip(rows, size, strict=True) if r[2] == s]
        for n, d in sorted(of, key=lambda x: (x[0], x[1] is not None, x[1] or 0)):
            copies = (at + step) // mixing.ONE - at // mixing.ONE
            at += step
            out.append((d, n, sizes[s], round(target[s], 6), n * copies))
    return out


def mixed(df):
    return [(d, n, s, round(t, 6), k) for d, n, s, t, k in
            collected(df, "doc_id", "size", "source_size", "target", "taken")]


def test_mixing(spark, docs):
    rows = collected(docs, "doc_id", "text", "source")
    got = mixed(Q.op11_mixing(spark, SF))
    assert sorted(got) == sorted(drawn(rows))
    assert all(k <= 2 * n for _, n, _, _, k in got)
    assert sorted(got) == sorted(mixed(Q.op11_mixing(spark, SF)))
    longest, taken, target = Counter(), Counter(), {}
    source = {d: s for d, _, s in rows}
    for d, n, _, t, k in got:
        longest[source[d]] = max(longest[source[d]], n)
        taken[source[d]] += k
        target[source[d]] = t
    assert all(abs(taken[s] - t) <= longest[s] + 1 for s, t in target.items())
    assert sum(target.values()) == pytest.approx(1.5 * sum(n for _, n, *_ in got))


def test_mixing_odd_rows(odd, none):
    got, want = mixed(mixing.copies(odd)), drawn(collected(odd, "doc_id", "text", "source"))
    # rows of one doc_id and size may change places
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert mixing.copies(none).count() == 0 == mixing.mix(none).count()


def test_mixed_rows(spark, odd):
    out = mixing.mix(odd)
    assert out.columns == [*odd.columns, "copy"]
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    want = Counter()
    for r in mixing.copies(odd).withColumn("h", F.col("text_hash")).collect():
        want[(r["doc_id"], r["source"], r["h"])] += r["copies"]
    hashes = {(r["text"]): r["h"] for r in odd.select("text", F.xxhash64("text").alias("h")).collect()}
    assert {k: v for k, v in want.items() if v} == \
        {(d, s, hashes[t]): n for (d, t, s), n in got.items()}


def test_targets_stop_at_the_cap(spark):
    sizes = {"a": 10, "b": 1000, "c": 30, "d": 500, None: 5, "": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = dealt(sizes)
    assert set(got) == set(want)
    assert all(got[s] == pytest.approx(float(want[s])) for s in want)
    assert got["a"] == 20 and got[None] == 10


def test_one_source_over_many_ranges(spark):
    """A hot source of equal sizes: copies are spread evenly whatever the ranges."""
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"),
                                  F.when(F.col("id") % 10 == 0, "y").otherwise("x").alias("source"))
    got = mixing.copies(df)
    by = {r["source"]: r for r in got.groupBy("source").agg(
        F.sum("taken").alias("k"), F.max("target").alias("t"), F.max("copies").alias("c")).collect()}
    assert all(abs(r["k"] - r["t"]) <= 2 and r["c"] <= 2 for r in by.values())


# 12 --------------------------------------------------------------------------

def phrases(rows, top=2000, longest=3, least=10, inside=50):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if a >= least and len(p) > 1}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= inside * a
                   and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, _, l, r = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                 for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (score, a, p, l, r) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("dense", [1 << 17, 40, 0])
def test_collocations(docs, dense):
    rows = collected(docs, "lang", "text")
    want = phrases(rows)
    assert want
    got = collocations.collocations(docs, dense=dense)
    assert sorted(collected(got, *COLUMNS)) == want


def test_longer_collocations(spark):
    text = "the cat sat on a mat, the cat sat on. the cat ran; on a mat the cat sat "
    df = spark.createDataFrame([("en", text * 7), (None, "a b c d " * 12), ("und", "a b. c d")],
                               "lang string, text string")
    for top in (3, 1000):
        got = collocations.collocations(df, top=top, max_words=4, least=5)
        assert sorted(collected(got, *COLUMNS)) == \
            phrases(df.collect(), top=top, longest=4, least=5)


def test_collocations_of_odd_rows(odd, none):
    want = phrases(collected(odd, "lang", "text"), least=2)
    assert sorted(collected(collocations.collocations(odd, least=2), *COLUMNS)) == want
    assert collocations.collocations(none).count() == 0


def test_dense_and_sparse_tiles_agree():
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 50, 4000), rng.integers(0, 30, 4000)
    left_rank = rng.permutation(50)
    right_rank = np.where(np.arange(30) < 20, rng.permutation(30), -1)
    want = Counter(zip(left.tolist(), right.tolist(), strict=True))
    for tile in (2, 4, 10):
        got = collocations.count_pairs(left, right, left_rank, right_rank, tile)
        assert {(a, b): n for a, b, n in zip(*map(list, got), strict=True)} == want


def test_blocks_do_not_change_counts(docs, monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist(
        [{"lang": r["lang"], "text": r["text"]} for r in docs.limit(60).collect()])
    whole, cut = Counter(), Counter()
    for out, limit in ((whole, 1 << 21), (cut, 500)):
        for w in collocations.by_language(iter([batch]), limit):
            for i in w.place.tolist():
                out[(w.lang, w.names[i])] += 1
    assert whole == cut


# 13 --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(
        model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    alphabet = alignment.byte_alphabet()

    def of_b(i):
        p = b.id_to_piece(i)
        if re.fullmatch("<0x[0-9A-F]{2}>", p):
            return bytes([int(p[3:5], 16)])
        return p.replace("▁", " ").encode()

    def cut(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return ([(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in ids_a],
                [(i, of_b(i)) for i in ids_b])

    return cut


def grouped(both, text):
    """Groups of a text as (A ids, B ids), by walking both cuts."""
    if not text:
        return []
    a, b = both(text)
    want = (" " + text).encode()
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return []
    out, i, j = [], 0, 0
    while i < len(a):
        ga, gb, na, nb = [], [], 0, 0
        while not ga or na != nb:
            if na <= nb:
                ga.append(a[i][0])
                na, i = na + len(a[i][1]), i + 1
            else:
                gb.append(b[j][0])
                nb, j = nb + len(b[j][1]), j + 1
        out.append((ga, gb))
    return out


def linked(both, rows):
    got = [(d, grouped(both, t)) for d, t in rows]
    count = Counter()
    for _, groups in got:
        count.update({(a, b) for ga, gb in groups for a in ga for b in gb})
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for d, groups in got:
        links = [(a, b) for ga, gb in groups for a in ga for b in gb]
        line = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((d, sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups),
                    len(links), sum(count[x] == most[x[0]] for x in links),
                    sum(count[x] for x in links),
                    hashlib.sha256(line.encode()).hexdigest() if line else ""))
    return sorted(out, key=repr)


FOUND = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def aligned(df, **kw):
    return sorted(collected(alignment.align(df, *args(), **kw), *FOUND), key=repr)


def args():
    return (Q.tokenizer_path(Q.BYTE_TOKENIZER), Q.tokenizer_path(Q.PIECE_MODEL),
            public_tokenizers.PATTERN)


def test_alignment(spark, docs, both):
    got = sorted(collected(Q.op13_alignment(spark, SF), *FOUND), key=repr)
    assert got == linked(both, collected(docs, "doc_id", "text"))


def test_alignment_odd_rows(odd, none, both):
    want = linked(both, collected(odd, "doc_id", "text"))
    assert sum(not w[1] for w in want) >= 3
    for block in (alignment.BLOCK_BYTES, 1):
        assert aligned(odd, block_bytes=block) == want
    assert alignment.align(none, *args()).count() == 0


def test_long_texts_are_cut_where_no_token_lies(rows_of_text, both):
    tok = alignment.Tokenizers(*args())
    for text in rows_of_text:
        raw = text.encode()
        whole = alignment.align_part(tok, [raw])
        for size in (7, 300):
            cut = alignment.align_long(tok, raw, size)
            for x, y in zip(whole, cut, strict=True):
                if isinstance(x, list):
                    assert alignment._digest(x[0]) == alignment._digest(y[0])
                else:
                    assert x.tolist() == y.tolist()


@pytest.fixture(scope="module")
def rows_of_text(docs):
    return [t for t, in collected(docs, "text") if t][:60] + [t for t in TEXTS if t and len(t) < 9000]


def test_slices_of_a_product_do_not_change_it(monkeypatch):
    rng = np.random.default_rng(5)
    dense_a, dense_b = rng.integers(0, 3, (30, 20)), rng.integers(0, 3, (20, 25))

    def csr(m):
        i, j = np.nonzero(m)
        return alignment.Csr(np.concatenate([[0], np.cumsum((m != 0).sum(axis=1))]), j, m[i, j],
                             m.shape[1])

    assert (alignment.transposed(csr(dense_a)).vals == dense_a.T[np.nonzero(dense_a.T)]).all()
    for entries in (1, 40, 10 ** 6):
        out = np.zeros((30, 25), int)
        for i, j, v in alignment.products(csr(dense_a), csr(dense_b), entries):
            out[i, j] += v
        assert (out == dense_a @ dense_b).all()


def test_overlap_links(spark, both):
    text = "naïve tokenizers: 漢字"
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = sorted(collected(alignment.overlap_links(df, *args()), "doc_id", "a_place", "b_place",
                           "a_id", "b_id", "n_bytes"))
    a, b = both(text)
    want, start_a = [], 0
    for i, (x, s) in enumerate(a):
        start_b = 0
        for j, (y, t) in enumerate(b):
            n = min(start_a + len(s), start_b + len(t)) - max(start_a, start_b)
            if n > 0:
                want.append((1, i, j, x, y, n))
            start_b += len(t)
        start_a += len(s)
    assert got == sorted(want)


def test_byte_level_ids_equal_the_library(both):
    tok = alignment.Tokenizers(*args())
    text = " ".join(chr(c) for c in range(0x20, 0x3000, 7)) + " 👍🏽 don't 12345 　 \x85 x\n\n y"
    assert tok.a.encode_ordinary(" " + text) == [i for i, _ in both(text)[0]]
