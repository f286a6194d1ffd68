"""String expressions: event-type cleaning, word title-casing, URL segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmart import schemas as S

# Look-behind split: a new word starts after white space or any delimiter.
_WORD_START = "(?<=[\\s" + "".join("\\" + c if c in "\\[]^-&" else c
                                  for c in S.INITCAP_DELIMITERS) + "])"


def initcap_words(col: Column) -> Column:
    """Upper-case the first letter of every word, lower-case the rest.

    Spark's ``initcap`` starts words only after a blank; here a word also
    starts after punctuation (``sign-up_now`` -> ``Sign-Up_Now``). The text is
    cut after each delimiter, each piece is title-cased and the pieces are
    joined back, so the result keeps every character.
    """
    pieces = F.split(col, F.lit(_WORD_START))
    return F.array_join(F.transform(pieces, F.initcap), "")


def clean_event_type(col: Column) -> Column:
    """Drop the vendor tag (with its trailing blank) or turn ``_`` into
    blanks, first matching rule wins, then title-case the words."""
    stripped = (
        F.when(F.contains(col, F.lit(S.VENDOR_TAG)),
               F.replace(col, F.lit(S.VENDOR_TAG_WITH_BLANK), F.lit("")))
        .when(F.contains(col, F.lit("_")), F.replace(col, F.lit("_"), F.lit(" ")))
        .otherwise(col)
    )
    return initcap_words(stripped).cast("string")


def _capture(col: Column, pattern: str) -> Column:
    # regexp_extract yields '' when nothing matches; the groups here can
    # never capture '' (they need one character), so '' means "no match".
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))


def page_title(url: Column) -> Column:
    """Last path segment of the raw URL, ignoring one trailing slash."""
    return _capture(url, S.PAGE_TITLE_PATTERN)


def parent_page_title(url: Column) -> Column:
    """Second-to-last path segment of the raw URL."""
    return _capture(url, S.PARENT_PAGE_TITLE_PATTERN)
