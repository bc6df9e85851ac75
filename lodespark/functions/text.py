"""Text columns: normaliser, shingles, tokens and set comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace, as a regular-expression class
# body that Java and RE2 read alike. They are written out because a plain \s is ASCII only.
WHITESPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same without the plain space, which needs no replacing where others become one: texts hold
# far more plain spaces, and each match costs.
OTHER_WHITESPACE = WHITESPACE.replace(r"-\x{20}", r"-\x{1f}")


def normalize(text: Column) -> Column:
    """Letters in lower case, each whitespace character as one space, the rest dropped.

    Capital sigma is replaced first because lower-casing a whole string would give
    its word-final form.
    """
    spaced = F.regexp_replace(text, f"[{OTHER_WHITESPACE}]", " ")
    letters = F.regexp_replace(spaced, r"[^\p{L} ]+", "")
    return F.lower(F.translate(letters, "Σ", "σ"))


def shingles(normalized: Column, k: int = 3) -> Column:
    """Sorted distinct substrings of ``k`` characters; shorter text gives none.

    Each match looks ahead for ``k`` characters and takes one, so that the next starts one
    whole character later, also beyond the basic plane.
    """
    every = F.regexp_extract_all(normalized, F.lit(f"(?s)(?=(.{{{k}}}))."), 1)
    return F.sort_array(F.array_distinct(every))


def words(text: Column) -> Column:
    """Whitespace-separated parts, in order and with repeats."""
    parts = F.split(F.regexp_replace(text, f"[{OTHER_WHITESPACE}]", " "), " ")
    return F.filter(parts, lambda part: part != "")


def tokens(text: Column) -> Column:
    """Lower-case words with their punctuation."""
    return words(F.lower(text))


def term_counts(sorted_tokens: Column) -> Column:
    """Array of ``(term, tf)`` structs of a sorted array of tokens.

    A term starts where its token differs from the one before; its count is the distance
    to the next start. The array is bound to a lambda variable so that it is computed
    once per row.
    """

    def counted(tokens: Column) -> Column:
        length = F.size(tokens)
        starts = F.filter(
            F.sequence(F.lit(0), length - 1),
            lambda n: (n == 0) | (F.get(tokens, n) != F.get(tokens, n - 1)),
        )
        return F.transform(F.array(starts), lambda at: F.transform(
            at,
            lambda start, n: F.struct(
                F.get(tokens, start).alias("term"),
                (F.coalesce(F.get(at, n + 1), length) - start).cast("long").alias("tf"),
            ),
        ))[0]

    some = F.transform(F.array(sorted_tokens), counted)[0]
    return F.when(F.size(sorted_tokens) > 0, some)


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two arrays of distinct values; two empty ones give 1."""
    shared = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def agreement(left: Column, right: Column) -> Column:
    """Share of positions at which two signatures of equal length hold the same value."""
    same = F.zip_with(left, right, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x) / F.size(left)


def amplify(similarity: Column, steps: list[tuple[str, int]]) -> Column:
    """Probability after a chain of ``("and", r)`` and ``("or", b)`` constructions."""

    def apply(p: Column, step: tuple[str, int]) -> Column:
        kind, ways = step
        if kind == "and":
            return F.pow(p, F.lit(ways))
        if kind == "or":
            return 1 - F.pow(1 - p, F.lit(ways))
        raise ValueError(f"unknown construction {kind!r}")

    return reduce(apply, steps, similarity)
