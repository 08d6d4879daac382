"""Checks run before a corpus is split: schema, null/blank texts, duplicate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The markers the CSV reader of the original job treats as missing.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def na_normalise(
    df: DataFrame, columns: Sequence[str] | None = None, na_values: Sequence[str] = NA_VALUES
) -> DataFrame:
    """Replace missing-value markers in string columns by null."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.when(F.col(c).isin(*na_values), F.lit(None)).otherwise(F.col(c)) for c in names}
    )


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected or surplus column: types, nulls, values that do not cast.

    All columns are measured in one pass over the table.
    """
    actual = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in expected}
    names = list(wanted) + [c for c in actual if c not in wanted]
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(names):
        if name not in actual:
            continue
        measures.append(F.count_if(F.col(name).isNull()).alias(f"_nulls{i}"))
        if name in wanted and actual[name] != wanted[name]:
            lost = F.col(name).isNotNull() & F.col(name).try_cast(wanted[name]).isNull()
            measures.append(F.count_if(lost).alias(f"_lost{i}"))
    measured = df.agg(*measures)
    entries = []
    for i, name in enumerate(names):
        have = name in actual
        same = have and name in wanted and actual[name] == wanted[name]
        casts = have and name in wanted and not same
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(wanted[name].simpleString() if name in wanted else None)
                .cast("string")
                .alias("expected"),
                F.lit(actual[name].simpleString() if have else None)
                .cast("string")
                .alias("actual"),
                F.lit(same).alias("ok"),
                F.col("_rows").alias("n_rows"),
                (F.col(f"_nulls{i}") if have else F.lit(None).cast("long")).alias("n_null"),
                (F.col(f"_lost{i}") if casts else F.lit(None).cast("long")).alias("n_not_castable"),
            )
        )
    return measured.select(F.inline(F.array(*entries)))


def _blank(column: str):
    return F.col(column).isNotNull() & (F.length(F.trim(F.col(column))) == 0)


def validate_pairs(
    df: DataFrame, id_col: str = "id", text_cols: Sequence[str] = ("dialogue", "summary")
) -> DataFrame:
    """One report row: rows, nulls and blanks per text column, duplicate ids, valid rows.

    Counts are first combined per id (map side), so a heavily duplicated id costs one
    row per task in the shuffle, and duplicates need no separate distinct pass.
    """
    good = F.lit(True)
    for c in text_cols:
        good = good & F.col(c).isNotNull() & (F.length(F.trim(F.col(c))) > 0)
    counters = {"n_rows": F.count(F.lit(1)), "n_valid": F.count_if(good)}
    for c in text_cols:
        counters[f"null_{c}"] = F.count_if(F.col(c).isNull())
        counters[f"blank_{c}"] = F.count_if(_blank(c))
    per_id = df.groupBy(id_col).agg(*[v.alias(k) for k, v in counters.items()])
    totals = [F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in counters]
    ids = F.count_if(F.col(id_col).isNotNull())
    return per_id.agg(
        *totals,
        ids.alias("n_ids"),
        F.coalesce(
            F.sum(F.when(F.col(id_col).isNotNull(), F.col("n_rows") - 1)), F.lit(0)
        ).alias("n_duplicate_rows"),
    )


def valid_pairs(df: DataFrame, text_cols: Sequence[str] = ("dialogue", "summary")) -> DataFrame:
    """Rows whose texts are present and not blank."""
    for c in text_cols:
        df = df.filter(F.length(F.trim(F.col(c))) > 0)
    return df
