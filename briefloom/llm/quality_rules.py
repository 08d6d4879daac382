"""Quality rules as a bitmask ledger, in DataFrame operations only.

``ledger`` measures every text once and stores one failure bit per rule beside the measurements.
Policies are named, versioned bit masks: applying one is a bitwise AND, and ``ablation`` says
in one aggregation what each rule of a policy removes, and what it alone removes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from briefloom.llm.helpers import WORD

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_WINDOW = 8


def _col(name: str) -> Column:
    return F.col(name)


# Name and failing condition of each rule, over the measurements; the position is the bit.
# Never reorder: stored ledgers refer to it. Ratios are compared in integers.
RULES: tuple[tuple[str, Callable[[], Column]], ...] = (
    ("few_words", lambda: _col("n_words") < 20),
    ("repeated_words", lambda: 100 * _col("n_repeat_words") > 30 * _col("n_words")),
    ("many_symbols", lambda: 100 * _col("n_symbols") > 25 * _col("n_words")),
    ("repeated_lines", lambda: 100 * _col("n_dup_lines") > 50 * _col("n_lines")),
    ("long_words", lambda: _col("word_chars") > 25 * _col("n_words")),
    ("short_words", lambda: _col("word_chars") < 2 * _col("n_words")),
    ("shouting", lambda: (100 * _col("n_upper") > 60 * _col("n_letters")) & (_col("n_letters") > 0)),
    ("few_letters", lambda: 100 * _col("n_letters") < 50 * _col("word_chars")),
    ("many_exclamations", lambda: 100 * _col("n_exclamations") > 30 * _col("n_words")),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
# Versioned policies: name -> mask of rules that reject.
POLICIES = {
    "base-1": BASE,
    "web-1": BASE | BIT["many_symbols"] | BIT["repeated_lines"] | BIT["long_words"] | BIT["short_words"],
    "web-2": sum(BIT.values()),
}
CURRENT = "web-2"


def repeated_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more in ``words``, all occurrences included."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (_WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, _WINDOW))
    )

    def twins(placed: Column) -> Column:
        """Sorted starts of the windows whose hash has an equal neighbour."""
        found = F.transform(
            placed,
            lambda x, k: F.when(
                (F.get(placed, k - 1)["h"] == x["h"]) | (F.get(placed, k + 1)["h"] == x["h"]), x["i"]
            ),
        )
        return F.sort_array(F.filter(found, lambda i: i.isNotNull()))

    def length_of(at: Column) -> Column:
        """Words under windows that start at the sorted places ``at``."""
        own = F.transform(
            at, lambda p, k: F.when(k == 0, _WINDOW).otherwise(F.least(F.lit(_WINDOW), p - F.get(at, k - 1)))
        )
        return F.aggregate(own, F.lit(0), lambda total, x: total + x)

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(_let(placed, twins), length_of)

    return F.when(F.size(words) <= _WINDOW, F.lit(0)).otherwise(
        _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_let(w, covered)))
    ).cast("long")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), then)[0]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements of every whole text; a null text counts as empty."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), 0)
    lines = F.filter(F.split(whole, "\n", -1), lambda line: F.ltrim(line, F.lit(_SPACE)) != "")
    joined = F.array_join(F.col("_words"), "")
    measured = docs.withColumn("_words", words).withColumn("_lines", lines)
    measured = measured.withColumn("_joined", joined)

    def count(chars: str) -> Column:
        return F.regexp_count("_joined", F.lit(chars)).cast("long")

    measures = F.struct(
        *[value.alias(name) for name, value in {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length("_joined").cast("long"),
            "n_symbols": (F.length("_joined") - F.length(F.translate("_joined", _SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")),
            "n_letters": (F.length("_joined") - F.length(F.regexp_replace("_joined", r"\p{L}+", ""))).cast("long"),
            "n_upper": (F.length("_joined") - F.length(F.regexp_replace("_joined", r"\p{Lu}+", ""))).cast("long"),
            "n_exclamations": (F.length("_joined") - F.length(F.translate("_joined", "!", ""))).cast("long"),
        }.items()]
    )
    # a generator, so that filters on measurements are not moved before them and evaluate them again
    return measured.select(*docs.columns, F.inline(F.array(measures)))


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper",
    "n_exclamations",
)


def ledger(docs: DataFrame, text: str = "text", kept: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``kept`` of ``docs``, the measurements, and ``fail_bits``: bit i set if rule i fails.

    Texts that are null, empty or without words fail ``few_words`` (all counts 0; rules on
    shares hold). Rows are judged one by one: order, ties and repeated rows do not matter. Columns
    of ``docs`` named like a measurement are not carried.
    """
    narrow = docs.select(*kept, F.col(text).alias("_text"))
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(fails(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(narrow, "_text").drop("_text").withColumn("fail_bits", bits)


def rejected(policy: str = CURRENT) -> Column:
    """Whether a ledger row breaks any rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long")) != 0


def ablation(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """(rule, n_failed, n_only): rows that fail each rule of the policy, and those it alone rejects.

    ``n_only`` is what dropping the rule would bring back. The ledger is reduced to its different
    masked bit sets first, at most 2**rules rows.
    """
    masked = F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long"))
    sets = ledger_rows.groupBy(masked.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    names = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in BIT.items() if b & POLICIES[policy]]
    )
    each = sets.withColumn("r", F.explode(names)).filter(F.col("bits").bitwiseAND(F.col("r.bit")) != 0)
    return each.groupBy("r.rule").agg(
        F.sum("n").alias("n_failed"), F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only")
    )


def op6_quality_rules(docs: DataFrame) -> DataFrame:
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE).cast("long")) != 0
    return ledger(docs, kept=("doc_id",)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~rejected()).alias("kept"), "fail_bits",
    )
