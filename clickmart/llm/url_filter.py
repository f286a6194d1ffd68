"""URL filters: rules first, then host segmentation and naive Bayes.

Rules name a host (it and all its subdomains) and a path prefix; the longest
that fits decides. Other URLs are judged by the words of their host and path:
a unigram Viterbi splits concatenated names (``cheappills``) into words, and a
multinomial naive Bayes weighs them.

The unigram counts (``learn``) are those of every word of the given texts
(documents and the visible text of all pages), mixed with the words of the
labelled names below. The Bayes model starts from these labelled names; it
labels every distinct host and path of the table, and is then fitted to the
counts of their segmented tokens, by label: so words that stand beside known
ones in block hosts are learnt from the table, and those of other hosts speak
against. Positive and unlabelled: a URL without evidence counts as other. The
labelled names are the prior of each word, worth ``strength`` tokens. The last
label of a host (``com``) is where a site is, not its name, and is no token.

All counts are tables as long as the vocabulary; they are joined, never
collected. Word scores are rounded to millionths, so their sums are exact and
reruns agree. Without counted texts, the labelled names alone judge, per row.

Hot hosts: names and (host, path) are made distinct before they are split, and
the join back is an equi-join on a unique side. A name of n letters gives at
most ``key`` * n stretches, which are matched one by one; words of any length
are found, those over ``key`` letters by their first ``key`` letters.

Defined cases: a null url, or one without ``://``, has an empty host and path;
no rule fits it and it is judged on no words (the prior: allow). A url may
have an empty host (``http:///x``) or path. Equal rows get equal results; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_parts, map_batches, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: (host, path prefix, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"),
         ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))

#: Labelled names (fixed values): hosts to block and to allow, as words. They train
#: the classifier and, with ``COMMON``, are words that names are split into.
BLOCK_SEEDS = """
cheap meds|cheap viagra|cialis rx|discount pills|diet pills|viagra pills|meds rx|cheap cialis
viagra cialis online|discount meds rx|weight loss pills|miracle diet pills|cheap rx
casino bonus|mega casino|casino slots|mega slots|poker bonus|casino poker|jackpot slots
casino jackpot|win jackpot|poker win|slots bonus win|lottery win|lottery jackpot|casino bets
sports bets|live bets|betting odds|betting king|bets odds|sports betting|betting bonus|casino king
spam links|spam mailer|bulk spam|backlinks cheap|link farm|content farm|spam backlinks|farm links
ads click|ads popup|popup click|banner ads|track click|tracker click|track popup|banner popup
adult dating|adult cam|sex cam|adult sex|porn cam|xxx porn|xxx sex|adult porn|sex dating
malware warez|warez crack|crack keygen|warez keygen|torrent crack|torrent warez|malware crack
payday loans|cheap loans|payday cash|fast loans|fast cash|mortgage loans|cash loans
mortgage rates|mortgage refinance|refinance loans|refinance rates|replica watches|cheap replica
replica rolex|rolex watches|free spins|free bonus|slots spins
"""
ALLOW_SEEDS = """
daily news|world news|local news|science news|news today|weather today|city weather
open source|code docs|software docs|developer blog|tech blog|data science|open data|code review
university library|school library|public library|history museum|art museum|national archive
health care|medical center|public health|city hospital|garden club|music school|book club
travel guide|food recipes|home garden|family recipes|sports club|football club|running club
online shop|book store|city guide|photo album|music store|film review|free software|free library
wiki page|help center|support forum|community forum|blog post|research journal|math journal
government office|city council|law office|bank online|post office|job search|real estate
family farm|farm shop|live music|fast food|king street|win festival|content guide
"""
COMMON = """
the of and to in for with on by from this that a an is be my your our all new best top big
www web net site mobile blog shop store app cloud home page info mail live go get
"""


@dataclass(frozen=True)
class Settings:
    rules: tuple[tuple[str, str, str], ...] = RULES
    block: str = BLOCK_SEEDS
    allow: str = ALLOW_SEEDS
    common: str = COMMON
    prior_block: float = 0.1
    smoothing: float = 0.2
    unknown_per_char: float = -4.0   # log probability of a letter outside known words
    unknown_start: float = -6.0
    key: int = 24                    # letters by which counted words are looked up
    cache: int = 200_000
    seed_share: float = 0.1          # of the unigram probability, beside counted words
    strength: float = 5.0            # tokens that the labelled names are worth, for each word
    words: Counter = field(init=False, compare=False)

    def __post_init__(self) -> None:
        names = f"{self.block} {self.allow} {self.common}".replace("|", " ").split()
        object.__setattr__(self, "words", Counter(names))


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr(__u, instr(__u, '://') + 3)"))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr(__u, instr(__u, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The longest fitting rule as ``host + path`` and its verdict, or nulls.

    Longest by host and path together; of equal length the earlier rule.
    """
    out = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for name, prefix, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        out = out.when(fits, F.struct(F.lit(name + prefix).alias("rule"),
                                      F.lit(verdict).alias("verdict")))
    return out


class Segmenter:
    """Unigram Viterbi over the letters of a name."""

    def __init__(self, how: Settings):
        total = sum(how.words.values()) + len(how.words)
        self.seeds = {w: (c + 1) / total for w, c in how.words.items() if len(w) > 1}
        self.log = {w: math.log(p) for w, p in self.seeds.items()}
        self.how = how
        self.longest = max(map(len, self.log), default=1)

    def use(self, counts: dict[str, int], total: int) -> None:
        """Judge by these words' counts of ``total`` from now on, mixed with the seeds."""
        share = self.how.seed_share
        self.log = {w: math.log(share * self.seeds.get(w, 0.0) + (1 - share) * n / total)
                    for w, n in counts.items() if n or w in self.seeds}
        self.longest = max(map(len, self.log), default=0)

    def split(self, name: str) -> list[str]:
        """Words of ``name``, unknown stretches whole; of equal scores the longer last word,
        and a word before an unknown stretch."""
        n = len(name)
        word, loose = [0.0] + [-math.inf] * n, [-math.inf] * (n + 1)
        start_of, opens = [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            fresh = word[end - 1] + self.how.unknown_start
            opens[end] = fresh >= loose[end - 1]
            loose[end] = max(fresh, loose[end - 1]) + self.how.unknown_per_char
            for start in range(max(0, end - self.longest), end):
                log = self.log.get(name[start:end])
                if log is not None and max(word[start], loose[start]) + log > word[end]:
                    word[end], start_of[end] = max(word[start], loose[start]) + log, start
        out, end = [], n
        while end:
            start = end
            if loose[end] > word[end]:
                while not opens[start]:
                    start -= 1
                start -= 1
            else:
                start = start_of[end]
            out.append(name[start:end])
            end = start
        return out[::-1]


class Bayes:
    """Multinomial naive Bayes over words; words never seen in training say nothing."""

    def __init__(self, how: Settings):
        counts = [Counter(s.replace("|", " ").split()) for s in (how.allow, how.block)]
        known = set(counts[0]) | set(counts[1])
        size = [sum(c.values()) + how.smoothing * len(known) for c in counts]
        self.odds = {w: math.log((counts[1][w] + how.smoothing) / size[1])
                     - math.log((counts[0][w] + how.smoothing) / size[0]) for w in known}
        self.prior = math.log(how.prior_block / (1 - how.prior_block))

    def micro(self, word: str) -> int:
        """Log odds of block that a word adds, in millionths."""
        return round(self.odds.get(word, 0.0) * MICRO)

    def score(self, words: list[str]) -> float:
        """Log odds of block."""
        return self.prior + sum(self.odds.get(w, 0.0) for w in words)


PARTS = re.compile(r"[a-z]+")


def names_of(host: str, path: str) -> list[str]:
    """Names to be split: runs of ASCII letters, without the host's last label of several."""
    labels = host.split(".")
    return PARTS.findall(".".join(labels[:-1] or labels).lower()) + PARTS.findall(path.lower())


class Judge:
    def __init__(self, how: Settings):
        self.segment, self.bayes, self.how = Segmenter(how), Bayes(how), how
        self.names: dict[str, list[str]] = {}

    def words(self, host: str, path: str) -> list[str]:
        out = []
        for name in names_of(host, path):
            if name not in self.names:
                if len(self.names) >= self.how.cache:
                    self.names.clear()
                self.names[name] = self.segment.split(name)
            out += self.names[name]
        return out

    def score(self, host: str, path: str) -> tuple[list[str], float]:
        words = self.words(host, path)
        return words, self.bayes.score(words)


#: Log odds are summed in whole numbers of this part.
MICRO = 1_000_000

SCHEMA = ("page_id long, host string, path string, rule string, verdict string, "
          "words array<string>, log_odds double")


# --- counted words ---------------------------------------------------------

#: What is no visible text of a page: scripts, styles, comments, tags, addresses.
HIDDEN = (r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;"
          r"|\b\w+://\S+")
WORD = r"\p{L}+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _countable(df: DataFrame) -> DataFrame:
    """Words that names can hold: two ASCII letters or more."""
    return df.where(F.col("word").rlike("^[a-z]{2,}$"))


def learn(pages: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """(word, n): occurrences of each word in the visible text of all pages and in all texts.

    ``pages`` has html, ``texts`` text; nulls have no words.
    """
    said = pages.select(F.regexp_replace(F.coalesce(pages["html"].cast("string"), F.lit("")),
                                         HIDDEN, " ").alias("text"))
    if texts is not None:
        said = said.unionByName(texts.select(texts["text"].cast("string").alias("text")))
    return _countable(said.select(F.explode(_words(F.col("text"))).alias("word"))) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def split_names(names: DataFrame, counts: DataFrame, how: Settings = Settings()) -> DataFrame:
    """(name, words, odds) of distinct ``name``s, split by counted words; ``odds`` are those
    of the labelled names alone."""
    total = max(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], 1)

    def listed(out: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.string()),
                                           pa.array([p for _, p in out], pa.string())],
                                          ["id", "piece"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches, 1000):
            out: list[tuple[str, str]] = []
            for key, name in zip(part.column("id").to_pylist(), part.column("name").to_pylist(),
                                 strict=True):
                for a in range(len(name)):
                    out += [(key, name[a:b])
                            for b in range(a + 2, min(a + how.key, len(name)) + 1)]
                    if len(out) >= 50_000:
                        yield listed(out)
                        out = []
            yield listed(out)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, bayes = Segmenter(how), Bayes(how)
        for batch in batches:
            words = []
            for name, known in zip(batch.column("name").to_pylist(),
                                   batch.column("known").to_pylist(), strict=True):
                met = {k["word"]: k["n"] for k in known or () if k["word"] in name}
                segment.use({**{w: 0 for w in segment.seeds if w in name}, **met}, total)
                words.append(segment.split(name))
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), pa.array(words, pa.list_(pa.string())),
                 pa.array([sum(bayes.micro(w) for w in ws) for ws in words], pa.int64())],
                ["name", "words", "odds"])

    # a long name is not repeated for each of its stretches
    named = names.select("name", F.when(F.length("name") <= 64, F.col("name")).otherwise(
        F.concat(F.lit("#"), F.sha2("name", 256))).alias("id"))
    # a word over ``key`` letters meets the stretch it begins with; ``split`` asks for all of it
    keyed = counts.withColumn("piece", F.substring("word", 1, how.key))
    known = map_batches(named, pieces, "id string, piece string").join(keyed, "piece") \
        .groupBy("id").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    return map_batches(named.join(known, "id", "left").select("name", "known"), split,
                       "name string, words array<string>, odds long")


def word_odds(spark: SparkSession, tokens: DataFrame, how: Settings = Settings()) -> DataFrame:
    """(word, odds): millionths of the log odds of block, from ``tokens`` (word, block, other).

    Multinomial, with pseudo-counts of ``strength`` for a word, split by the labels' shares of
    all tokens, at the odds of the labelled names: an unseen word keeps those. If all tokens
    are of one label, they say nothing, and all words keep them.
    """
    seeds = spark.createDataFrame(sorted(Bayes(how).odds.items()), "word string, seed double")
    block, other = tokens.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("block", "other")]).first()
    x = F.coalesce("seed", F.lit(0.0))
    odds = x
    if block and other:
        per_block, per_other = (block + other) / block, (block + other) / other
        odds = F.log((F.col("block") * per_block + how.strength * F.exp(x / 2))
                     / (F.col("other") * per_other + how.strength * F.exp(-x / 2)))
    return tokens.join(F.broadcast(seeds), "word", "left").select(
        "word", F.round(odds * MICRO).cast("long").alias("odds"))


def _judged_names(urls: DataFrame, counts: DataFrame, how: Settings) -> DataFrame:
    """(host, path, words, odds) of each distinct host and path that has words."""
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [names_of(h, p) for h, p in zip(
                batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("path"),
                 pa.array(parts, pa.list_(pa.string()))], ["host", "path", "names"])

    named = stored(map_batches(urls.select("host", "path").distinct(), names,
                               "host string, path string, names array<string>"), "url-names")
    split = split_names(named.select(F.explode("names").alias("name")).distinct(), counts, how)
    placed = stored(
        named.select("host", "path", F.posexplode("names").alias("at", "name"))
        .join(split, "name").groupBy("host", "path")
        .agg(F.array_sort(F.collect_list(F.struct("at", "words", "odds"))).alias("got"))
        .select("host", "path", F.flatten(F.transform("got", lambda g: g["words"])).alias("words"),
                (F.aggregate("got", F.lit(0).cast("long"), lambda x, g: x + g["odds"])
                 > -round(Bayes(how).prior * MICRO)).alias("block")), "url-tokens")
    tokens = stored(placed.select(F.explode("words").alias("word"), "block").groupBy("word").agg(
        F.count_if("block").alias("block"), F.count_if(~F.col("block")).alias("other")),
        "url-token-counts")
    odds = placed.select("host", "path", F.explode("words").alias("word")) \
        .join(word_odds(urls.sparkSession, tokens, how), "word") \
        .groupBy("host", "path").agg(F.sum("odds").alias("odds"))
    return placed.select("host", "path", "words").join(odds, ["host", "path"])


def judge_urls(pages: DataFrame, how: Settings = Settings(),
               counts: DataFrame | None = None) -> DataFrame:
    """``SCHEMA`` for each row of ``pages`` (page_id, url); only these columns are read.

    ``counts`` are those of ``learn``; without them the labelled names alone judge.
    """
    u = pages.select(pages["page_id"].cast("long").alias("page_id"),
                     pages["url"].cast("string").alias("__u"))
    parted = u.select("page_id", host_of(F.col("__u")).alias("host"),
                      path_of(F.col("__u")).alias("path"))
    ruled = parted.withColumn("__r", rule_of(F.col("host"), F.col("path"), how.rules)) \
        .select("page_id", "host", "path", F.col("__r.rule").alias("rule"),
                F.col("__r.verdict").alias("verdict"))
    if counts is not None:
        met = _judged_names(ruled, stored(counts, "url-words"), how)
        log_odds = (F.coalesce("odds", F.lit(0)) + F.lit(round(Bayes(how).prior * MICRO))) / MICRO
        return ruled.join(met, ["host", "path"], "left").select(
            "page_id", "host", "path", "rule",
            F.coalesce("verdict", F.when(log_odds > 0, "block").otherwise("allow"))
            .alias("verdict"),
            F.coalesce("words", F.array().cast("array<string>")).alias("words"),
            log_odds.alias("log_odds"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(how)
        for batch in batches:
            got = [judge.score(h, p) for h, p in zip(batch.column("host").to_pylist(),
                                                     batch.column("path").to_pylist(), strict=True)]
            verdict = [v or ("block" if s > 0 else "allow") for v, (_, s)
                       in zip(batch.column("verdict").to_pylist(), got, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("page_id", "host", "path", "rule")],
                 pa.array(verdict, pa.string()),
                 pa.array([w for w, _ in got], pa.list_(pa.string())),
                 pa.array([s for _, s in got], pa.float64())],
                ["page_id", "host", "path", "rule", "verdict", "words", "log_odds"])

    return map_batches(ruled, rows, SCHEMA)
