"""Weighted text search (D2): OR of terms over weighted fields, score descending.

Tokenisation: tokens are maximal runs of ASCII letters, compared lower-cased (ASCII only, so no
locale rules differ between engines) — the same tokens as lower-casing A–Z and splitting on
``[^a-z]+``. Score = Σ field weight × term frequency over the query terms. The per-term counts
are array expressions evaluated row by row (``size(filter(tokens, t -> t = term))``): no explode,
no shuffle — the whole search is one narrow map over the documents plus the final sort, so it
scales with the text volume and never gathers a document's tokens anywhere. Whole texts are
tokenised. Mongo's stemming and score normalisation are not reproduced (documented).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C = F.col
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
TOKEN_SPLIT = "[^a-z]+"


def tokens(text: Column) -> Column:
    """Maximal runs of ASCII letters (case kept; compare with ``F.lower`` — exact, ASCII only)."""
    return F.split(F.coalesce(text, F.lit("")), "[^A-Za-z]+")


def any_term_pattern(terms: list[str]) -> str:
    """Regex true iff some token of the text equals a term (terms are [a-z]+ by construction)."""
    return "(?i)(?<![A-Za-z])(" + "|".join(terms) + ")(?![A-Za-z])"


def parse_terms(search: str) -> list[str]:
    """Search string → distinct lower-case terms (same tokeniser as the documents)."""
    import re
    out = []
    for t in re.split(TOKEN_SPLIT, search.translate(str.maketrans(_UPPER, _LOWER))):
        if t and t not in out:
            out.append(t)
    return out


def _equals(term: str):
    return lambda t: F.lower(t) == F.lit(term)


def term_frequency(text: Column, term: str) -> Column:
    return F.size(F.filter(tokens(text), _equals(term)))


def text_score(fields: dict[str, int], terms: list[str]) -> Column:
    """Σ_fields weight × (number of tokens of the field that are query terms): one split and one
    pass over the tokens per field."""
    score = None
    for field, weight in fields.items():
        hits = F.size(F.filter(tokens(C(field)), lambda t: F.lower(t).isin(*terms)))
        piece = F.lit(weight) * hits
        score = piece if score is None else score + piece
    return score.cast("bigint")


def text_search(docs: DataFrame, search: str, fields: dict[str, int], where: Column | None = None) -> DataFrame:
    """Rows matching any term, with ``score``, best first.

    A regex prefilter (true iff a token equals a term) selects the matching rows in one scan; the
    score is then computed once per surviving row (a filter on the score itself would evaluate the
    whole tokenisation twice)."""
    terms = parse_terms(search)
    pattern = any_term_pattern(terms)
    match = None
    for f in fields:
        m = F.coalesce(C(f), F.lit("")).rlike(pattern)
        match = m if match is None else (match | m)
    df = docs.filter(match if where is None else (where & match))
    return df.withColumn("score", text_score(fields, terms)).orderBy(C("score").desc())
