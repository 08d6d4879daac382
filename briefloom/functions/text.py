"""Text expressions: everything here is a plain Column -> Column function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token classes of the ROUGE tokenizer and its Unicode variant.
ASCII_WORD_GAP = "[^a-z0-9]+"
UNICODE_WORD_GAP = r"[^\p{L}\p{N}]+"

# The published 13a normalisation used for corpus BLEU.
BLEU_LITERALS = (
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
)
BLEU_PATTERNS = (
    (r"([\{-~\[-` -&\(-\+:-@/])", " $1 "),
    (r"([^0-9])([.,])", "$1 $2 "),
    (r"([.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Lambdas re-evaluate the expressions they capture for every element; a lambda
    *variable* is evaluated once, so nested array work stays linear.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_nonempty(text: Column, separator: str) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def word_tokens(text: Column, unicode: bool = False) -> Column:
    """Lower-cased word tokens; a null text has no tokens."""
    gap = UNICODE_WORD_GAP if unicode else ASCII_WORD_GAP
    return split_nonempty(F.lower(text), gap)


def word_text(text: Column, unicode: bool = False) -> Column:
    """A text whose tokens ``functions.tokens.words`` finds, or ``spaced`` if ``unicode``: those of ``word_tokens``."""
    return F.regexp_replace(F.lower(text), UNICODE_WORD_GAP, " ") if unicode else F.lower(text)


def whitespace_tokens(text: Column) -> Column:
    return split_nonempty(text, r"\s+")


def bleu_text(text: Column) -> Column:
    """Text with white space between its case-keeping 13a tokens.

    The published first pattern also replaces each space by three. Later patterns read one character before or after a
    mark, and no two of their matches share a space, so one space does as well.
    """
    out = text
    for old, new in BLEU_LITERALS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.concat(F.lit(" "), out, F.lit(" "))
    for pattern, replacement in BLEU_PATTERNS:
        out = F.regexp_replace(out, pattern.replace("` -&", "`!-&"), replacement)
    return out


def bleu_tokens(text: Column) -> Column:
    """Case-keeping 13a tokens."""
    return split_nonempty(bleu_text(text), r"\s+")


def sentences(text: Column) -> Column:
    """Sentences end at ``.!?`` followed by white space, and at line breaks."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])\s+", "$1\n")
    return F.filter(
        F.transform(F.split(marked, "\n"), lambda part: F.trim(part)), lambda part: part != ""
    )
