"""Exact token matching; a single blank is the only separator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default vocabulary and language list, in rank order of ties.
LANGUAGES = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)


def checked_vocabulary(vocabulary: Sequence[str]) -> list[str]:
    """The vocabulary as a list; repeated or empty keywords are refused.

    A repeated keyword would count every article twice, and an empty one would
    depend on how blanks at the end of a text are split.
    """
    keywords = list(vocabulary)
    if "" in keywords:
        raise ValueError("a keyword must not be empty")
    if len(set(keywords)) != len(keywords):
        raise ValueError("the vocabulary repeats a keyword")
    return keywords


def mentions(text: Column, keyword: str) -> Column:
    """Whether ``keyword`` is one of the tokens of ``text``.

    A padded substring search gives the same answer as splitting and is about
    twice as fast for one keyword, as it makes no token array.
    """
    (keyword,) = checked_vocabulary([keyword])
    if " " in keyword:
        return F.lit(False)
    blank = F.lit(" ")
    return F.contains(F.concat(blank, text, blank), F.lit(f" {keyword} "))


def tokens(text: Column) -> Column:
    return F.split(text, " ")


def mentioned(text: Column, keywords: Sequence[str]) -> Column:
    """Array of the keywords found in ``text``, each at most once.

    The text is split once whatever the number of keywords, and so is the
    vocabulary: its split is folded into a constant. A keyword with a blank in
    it is no token and never found.
    """
    vocabulary = " ".join(k for k in keywords if " " not in k)
    if not vocabulary:
        return F.array().cast("array<string>")
    return F.array_intersect(tokens(text), tokens(F.lit(vocabulary)))
