"""The registered queries of this subpackage: ``QUERIES`` and ``ORACLES``.

Each query applies its operator to the whole of its table. Tokenizer files are
found by ``tokenizer_path``; they are read where they lie, never copied here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (alignment, collocations, decontamination, mixing, ngram_join, pii, quality_rank,
               quality_rules, secret_scan, sentence_pieces, token_counts, token_file, url_filter)
from .common import stored, table

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
#: Stands for the secret that an owner of real data keeps.
PII_KEY = "surrogate-key"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontamination.contamination(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                      "contaminated")


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents: ids and decoded text, as lengths and checksums."""
    model = tokenizer_path(PIECE_MODEL)
    ids = sentence_pieces.encode(table(spark, sf_dir, "documents"), model)
    return sentence_pieces.digest(ids, model)


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids as directly addressable codes, then read them back."""
    path = scratch_path(spark, "token-file")
    token_file.write(table(spark, sf_dir, "documents"), path, tokenizer_path(WORD_TOKENIZER))
    return token_file.read(spark, path, with_ids=False)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")) \
        .select("doc_id", "class_id", "n_links")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge all pages by words counted over all documents and pages."""
    pages = table(spark, sf_dir, "pages")
    counts = url_filter.learn(pages, table(spark, sf_dir, "documents"))
    return url_filter.judge_urls(pages, counts=counts)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals for every context limit that occurs as a document length."""
    counted = token_counts.lengths(table(spark, sf_dir, "documents"),
                                   tokenizer_path(WORD_TOKENIZER))
    return token_counts.suffix_sums(stored(token_counts.histogram(counted), "lengths"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_surrogates(table(spark, sf_dir, "documents"), PII_KEY) \
        .select("doc_id", "n_entities", "text")


def op8_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rank.classify(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))

    def listed(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "found")
    return found.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"),
                        n("hex").alias("n_hex"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents")) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER),
                           tokenizer_path(PIECE_MODEL), public_tokenizers.PATTERN)


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_sentence_pieces, op3_token_file, op4_ngram_join, op5_url_filter,
    op6_token_counts, op7_pii_surrogates, op8_quality_rank, op9_secret_scan,
    op10_quality_rules, op11_mixing, op12_collocations, op13_alignment)}

_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{decontamination.UPPER}', "
          f"'{decontamination.UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {"op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
ik AS (SELECT item_id, w, least(10, len(w)) AS k FROM i WHERE len(w) > 0),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM ik)
),
dw AS (
  SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM d CROSS JOIN (SELECT DISTINCT k FROM ik) WHERE len(w) >= k)
),
met AS (SELECT dw.doc_id, dw.s, dw.k, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
""",
"op11_mixing": """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''),
                                                     '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]
             AS w FROM s),
f AS (SELECT *, 2 * source_size / w AS filled,
             row_number() OVER (ORDER BY 2 * source_size / w, source NULLS LAST) AS k FROM w),
v AS (SELECT a.k, a.filled,
             CAST(3 * (SELECT sum(source_size) FROM f)
                  - 4 * coalesce((SELECT sum(source_size) FROM f b WHERE b.k < a.k), 0) AS DOUBLE)
             / CAST(2 * (SELECT sum(w) FROM f b WHERE b.k >= a.k) AS DOUBLE) AS level FROM f a),
c AS (SELECT k, level FROM v WHERE level <= filled ORDER BY k LIMIT 1),
t AS (SELECT source, source_size,
             CASE WHEN f.k < c.k THEN CAST(2 * source_size AS DOUBLE)
                  ELSE least(CAST(2 * source_size AS DOUBLE), f.w * c.level) END AS target
      FROM f CROSS JOIN c),
e AS (SELECT *, CASE WHEN source_size > 0
                     THEN CAST(floor(target / source_size * 16777216 + 0.5) AS BIGINT) ELSE 0 END AS e,
             CAST('0x' || substr(md5('mix:' || coalesce('s' || source, 'n')), 1, 6) AS BIGINT) AS o
      FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.e,
             CAST(sum(e.e) OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST
                                 ROWS UNBOUNDED PRECEDING) AS BIGINT) + e.o AS z
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, size * (z // 16777216 - (z - e) // 16777216) AS taken FROM p
""",
"op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (
  SELECT lang, k, w[s:s + k - 1] AS p
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM w CROSS JOIN (VALUES (1), (2), (3)) AS t(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, p, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE a >= 10),
cuts AS (
  SELECT x.lang, x.k, x.p, x.a, x.j, l.a AS l, r.a AS r,
         CAST((CAST(1000000 AS HUGEINT) * x.a * x.a) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c WHERE k > 1) AS x
  JOIN c AS l ON l.lang = x.lang AND l.p = x.p[1:x.j]
  JOIN c AS r ON r.lang = x.lang AND r.p = x.p[x.j + 1:x.k]),
low AS (SELECT lang, p, a, min_by({'l': l, 'r': r, 'score': score}, {'score': score, 'j': j}) AS cut
        FROM cuts GROUP BY lang, p, a),
best AS (SELECT lang, p, a, cut.l AS l, cut.r AS r, cut.score AS score FROM low),
wide AS (
  SELECT lang, p, max(a) AS most
  FROM (SELECT lang, p[1:2] AS p, a FROM c WHERE k = 3
        UNION ALL SELECT lang, p[2:3], a FROM c WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b
  LEFT JOIN wide USING (lang, p) WHERE 100 * coalesce(most, 0) < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000
"""}
