"""The stages of corpus_pipeline.py, each on what its predecessor kept, against brute force."""

from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as C
from clickmart.llm import queries as Q
from clickmart.llm import quality_rules
from clickmart.llm.common import stored, table

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Documents before the first stage and after each, as {doc_id: row}."""
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "test-" + name.replace(" ", "-")))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_keep_the_columns(kept):
    assert len(C.STAGES) == 5
    for df in kept[1:-1]:
        assert df.schema == kept[0].schema
    assert [c for c, _ in kept[-1].dtypes] == ["doc_id", "n_tokens", "ids"]


def test_quality_rules(kept):
    before, after = texts(kept[0]), texts(kept[1])
    bands = {r["doc_id"]: r["kept"] for r in quality_rules.measure(kept[0]).collect()}
    assert after == {d: t for d, t in before.items() if bands[d]}
    assert not any(brute.quality(t)[-1] for t in after.values())
    assert len(after) < len(before)


def test_one_of_each_group_stays(kept):
    before, after = texts(kept[1]), texts(kept[2])
    groups = defaultdict(set)
    for d, cls, _ in brute.near_duplicates(sorted(before.items())):
        groups[cls].add(d)
    assert set(after) == {min(g) for g in groups.values()}
    assert len(after) < len(before)


def test_contaminated_documents_go(spark, kept):
    before, after = texts(kept[2]), texts(kept[3])
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    hit = brute.contamination(sorted(before.items()), items)
    assert after == {d: t for d, t in before.items() if not hit[d][-1]}
    assert len(after) < len(before)


def test_secrets_go(spark, kept):
    planted = kept[3].withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat(
        "text", F.lit(' My password = "q1w2e3r4t5y6", keep it.'))).otherwise(F.col("text")))
    before, after = texts(planted), texts(C.without_secrets(spark, planted, SF))
    assert before.keys() == after.keys()
    assert sum(bool(brute.secrets(t)) for t in before.values()) >= len(before) // 4
    assert not any(brute.secrets(t) for t in after.values())
    assert all(after[d].endswith(' My [SECRET]", keep it.') for d in before if d % 3 == 0)
    same = [d for d in before if not brute.secrets(before[d])]
    assert sum(before[d] == after[d] for d in same) >= 0.99 * len(same)
    assert kept[4].where(F.col("n_chars") != F.length("text")).count() == 0


def test_ids_of_whole_texts(kept):
    lib = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_path(Q.PIECE_MODEL))
    want = {d: lib.encode(t) for d, t in texts(kept[4]).items()}
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in kept[5].collect()}
    assert got == want


def test_run_equals_its_stages(spark, kept):
    got = sorted((r["doc_id"], bytes(r["ids"])) for r in C.run(spark, SF).collect())
    assert got == sorted((r["doc_id"], bytes(r["ids"])) for r in kept[5].collect())
