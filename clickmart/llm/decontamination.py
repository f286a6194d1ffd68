"""Benchmark decontamination by a distributed positional inverted index.

The index stores, for every training document, the postings (term, document,
position) of the terms that occur in the test items; a posting of any other
term can be in no match. It is sharded by document: each file holds the
posting lists of the documents of one input split, sorted by term, so building
it needs no shuffle and no term, however common, is gathered anywhere. An end
mark in each document keeps its length.

Phrases are found by intersecting lists adjusted by offset. A posting of an
item's j-th word at position p lies on diagonal p - j; an item window occurs
exactly where all its words lie on one diagonal. For each window the two
rarest terms are looked up first, and only diagonals that both reach are
intersected with the lists of the other terms. Runs of enough consecutive
words on a diagonal are the matches. Built-in functions only.

Defined cases: null texts have no words; a test item without words is left out;
test rows with one item_id and different texts count as one item; so do all
without an item_id, whose windows hit like others and which is counted but has
no id to list;
equal training rows each get the same result; other columns are not read;
empty tables give documents without hits, or no rows. Joins: item tables are
broadcast by Spark only below its size threshold; a hot term meets only the
few anchors that carry it; hits are spread by (document, item, diagonal).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only, semi_filter, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
WINDOW = 10
#: Stands for a null item_id, which would equal nothing in a join.
NO_ID = ""
DOC = ["doc_id", "text_key"]


def words(text: Column) -> Column:
    """Words of a text: A-Z lowered, split at every other ASCII character but digits and a-z."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + _BREAKS,
                        UPPER.lower() + " " * len(_BREAKS))
    return F.array_remove(F.split(plain, " "), "")


@dataclass(frozen=True)
class Items:
    """Test items as tables: one row per word, and one per distinct term."""

    words: DataFrame   # item_id, item_key, j, term, n
    terms: DataFrame   # word, term (its 64-bit hash; the empty word is the end mark)


def test_items(items: DataFrame) -> Items:
    rows = (only(items, item_id="long", text="string").distinct()
            .select(F.coalesce(F.col("item_id").cast("string"), F.lit(NO_ID)).alias("item_id"), F.xxhash64("text").alias("item_key"), words(F.col("text")).alias("w"))
            .where(F.size("w") > 0))
    at = stored(rows.select("item_id", "item_key", F.size("w").alias("n"),
                            F.posexplode("w").alias("j", "word"))
                .withColumn("term", F.xxhash64("word")), "test-items")
    ends = items.sparkSession.range(1).select(F.lit("").alias("word"))
    terms = (at.select("word").unionByName(ends).distinct()
             .withColumn("term", F.xxhash64("word")))
    return Items(at.drop("word"), terms)


def index(docs: DataFrame, items: Items) -> DataFrame:
    """Stored postings (doc_id, text_key, term, pos) of the items' terms, term by term in each file.

    The end mark, the posting of the empty word, has the document's number of
    words as its position.
    """
    split = only(docs, doc_id="long", text="string").select(
        "doc_id", F.xxhash64("doc_id", "text").alias("text_key"),
        F.concat(words(F.col("text")), F.array(F.lit(""))).alias("w"))
    found = (split.select(*DOC, F.posexplode("w").alias("pos", "word"))
             .join(items.terms, "word").select(*DOC, "term", "pos"))
    return stored(found.sortWithinPartitions("term", *DOC, "pos"), "postings")


def _end() -> Column:
    return F.xxhash64(F.lit(""))


def _same_doc(a: DataFrame, b: DataFrame) -> Column:
    return (a["text_key"] == b["text_key"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def anchors(postings: DataFrame, items: Items, width: int = WINDOW, lists: int = 2) -> DataFrame:
    """(item_id, item_key, j, term, rank) of each window's ``lists`` rarest words.

    Rarity is the length of a term's posting list over the whole corpus.
    Windows with a word that occurs nowhere are left out, as nothing matches.
    """
    lengths = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n_postings"))
    w = items.words.join(lengths, "term", "left").withColumn(
        "n_postings", F.coalesce("n_postings", F.lit(0)))
    item = ["item_id", "item_key"]
    window = (Window.partitionBy(*item).orderBy("j")
              .rowsBetween(Window.currentRow, width - 1))
    rare = F.array_sort(F.collect_list(F.struct("n_postings", "j", "term")).over(window))
    starts = (w.withColumn("rare", rare)
              .where((F.col("j") + F.least(F.lit(width), F.col("n")) <= F.col("n"))
                     & (F.col("rare")[0]["n_postings"] > 0)))
    return (starts.select(*item, F.explode(F.slice("rare", 1, lists)).alias("r"))
            .select(*item, F.col("r.j").alias("j"), F.col("r.term").alias("term")).distinct())


def phrase_hits(postings: DataFrame, items: Items, width: int = WINDOW) -> DataFrame:
    """Matched words: (doc_id, text_key, item_id, item_key, pos), each on a full window.

    A window is ``width`` consecutive words of an item, or all of a shorter one.
    """
    item = ["item_id", "item_key"]
    diagonal = [*DOC, *item, "diagonal"]
    # stored, so that its size is known: a small table is broadcast and the
    # postings, of hot terms too, stay where they are
    rare = stored(anchors(postings, items, width), "anchors")
    first = postings.join(rare, "term") \
        .withColumn("diagonal", F.col("pos") - F.col("j"))
    lone = items.words.groupBy(*item).agg((F.max("n") == 1).alias("lone"))
    # both rarest lists meet on the diagonal (an item of one word has one list)
    met = (first.groupBy(*diagonal).agg(F.min("j").alias("j0"), F.max("j").alias("j1"))
           .join(lone, item).where(F.col("lone") | (F.col("j0") < F.col("j1"))))
    met = stored(met.select(*diagonal), "diagonals")
    # the other terms' lists, of the documents that have a diagonal left
    rest = semi_filter(postings.where(F.col("term") != _end()), met, DOC).alias("p")
    want = (met.join(items.words, item)
            .select(*diagonal, "j", "term", "n", (F.col("diagonal") + F.col("j")).alias("pos")))
    both = want.join(rest, (want["pos"] == rest["pos"]) & (want["term"] == rest["term"])
                     & _same_doc(want, rest))
    hits = both.select(*[want[c] for c in (*diagonal, "j", "n", "pos")]).distinct()
    along = Window.partitionBy(*diagonal).orderBy("j")
    runs = hits.withColumn("run", F.col("j") - F.row_number().over(along))
    whole = F.count(F.lit(1)).over(Window.partitionBy(*diagonal, "run"))
    return (runs.withColumn("length", whole)
            .where(F.col("length") >= F.least(F.lit(width), F.col("n")))
            .select(*DOC, *item, "pos"))


def contamination(docs: DataFrame, test: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids as text), contaminated per row of ``docs``."""
    items = test_items(test)
    postings = index(docs, items)
    hits = phrase_hits(postings, items, width)
    by_doc = hits.groupBy(*DOC).agg(
        F.count_distinct("pos").alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"))
    ends = postings.where(F.col("term") == _end())
    none = F.array().cast("array<string>")
    return (ends.join(by_doc, _same_doc(ends, by_doc), "left")
            .select(ends["doc_id"], ends["text_key"], ends["pos"].cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", none).alias("items"))
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items", F.array_remove("items", NO_ID))
            .withColumn("contaminated", F.col("n_hit") > 0))


def remove_contaminated(docs: DataFrame, test: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any test window, with all their columns."""
    items = test_items(test)
    bad = phrase_hits(index(docs, items), items, width).select(*DOC).distinct()
    cols = docs.columns
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["text"])
    keyed = docs.withColumn("__text_key", key)
    return keyed.join(bad, (keyed["__text_key"] == bad["text_key"])
                      & keyed["doc_id"].cast("long").eqNullSafe(bad["doc_id"]), "left_anti") \
        .select(*[keyed[c] for c in cols])


def near_in(docs: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """``proximity_matches`` of any words: the index is built here, of the queries' words."""
    word = F.translate("word", UPPER, UPPER.lower()).alias("word")
    ends = queries.sparkSession.range(1).select(F.lit("").alias("word"))
    terms = (queries.select(word).where("word is not null").unionByName(ends).distinct()
             .withColumn("term", F.xxhash64("word")))
    return proximity_matches(index(docs, Items(terms, terms)), queries, within)


def proximity_matches(postings: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """(query_id, doc_id, text_key, pos): places where all of a query's words are close together.

    ``queries`` has (query_id, word). A match is a posting of the query's
    rarest word with every other word of the query less than ``within``
    positions away, in any order. Positions are bucketed by ``within``, so a
    posting is met in its own bucket and the two beside it only.

    ``postings`` must hold all words of the queries: a word that it was not
    built for counts as occurring nowhere. ``near_in`` builds it for any words.
    """
    q = queries.select("query_id", F.xxhash64(F.translate("word", UPPER, UPPER.lower()))
                       .alias("term")).distinct()
    n = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n_postings"))
    rarity = q.join(n, "term", "left").select(
        "query_id", "term", F.coalesce("n_postings", F.lit(0)).alias("n_postings"))
    by = rarity.groupBy("query_id").agg(
        F.min(F.struct("n_postings", "term")).alias("r"), F.count(F.lit(1)).alias("n_terms"))
    rare = by.where("r.n_postings > 0").select("query_id", "n_terms", F.col("r.term").alias("term"))
    held = postings.join(q.select("term").distinct(), "term", "left_semi").distinct()
    start = held.join(rare, "term").select(
        "query_id", "n_terms", *DOC, F.col("pos").alias("at"),
        F.explode(F.sequence((F.col("pos") / within).cast("int") - 1,
                             (F.col("pos") / within).cast("int") + 1)).alias("bucket"))
    other = held.join(q, "term").select(
        F.col("query_id").alias("q2"), *DOC, "term", "pos",
        (F.col("pos") / within).cast("int").alias("bucket"))
    met = start.join(other, (start["query_id"] == other["q2"])
                     & (start["bucket"] == other["bucket"]) & _same_doc(start, other)
                     & (F.abs(start["at"] - other["pos"]) < within))
    return (met.select("query_id", "n_terms", start["doc_id"], start["text_key"], "at", "term")
            .groupBy("query_id", "n_terms", *DOC, "at")
            .agg(F.count_distinct("term").alias("n")).where("n = n_terms")
            .select("query_id", *DOC, F.col("at").alias("pos")))
