"""Keyed rolling values (AGG-1, AGG-2, W-1, W-6).

The reference emits one updated value per input row ("rolling reduce").
In batch form the arrival order is an explicit ``order`` column list. All
running forms go through the chunked scan, so a hot key (the article
counter has only two keys) is spread over its chunks. The text forms hold what
they return: a key's concatenation is one string as long as its input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.predicates import click_jump
from eventide.constants import MIN_CLICK_JUMP
from eventide.operators.scan import CHUNK, deal, join_on, prefix_sums, previous_values


def final_counts(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """AGG-1, final value: rows per key (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def running_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   name: str = "running_count") -> DataFrame:
    """AGG-1 + W-6: every row with the count of its key so far (inclusive)."""
    return prefix_sums(df, keys, order, {name: F.lit(1).cast("long")})


def _ordered_join(items: Column, order_fields: Sequence[str], value_field: str, sep: str) -> Column:
    """Concatenate ``value_field`` of an array of structs sorted by its fields."""
    return F.array_join(F.transform(F.array_sort(items), lambda x: x[value_field]), sep)


def ordered_concat(df: DataFrame, keys: Sequence[str], order: Sequence[str], token: str,
                   name: str = "text", sep: str = "") -> DataFrame:
    """AGG-2, final value: the key's tokens concatenated in ``order``.

    The concatenation is two-level: each (key, chunk) is joined in order
    first, then the chunk texts are joined in chunk order, so no task
    gathers every input row of a hot key (the result string of a key is,
    by definition, as long as its input).
    """
    keys, order = list(keys), list(order)
    dealt = df if CHUNK in df.columns else deal(df.select(*keys, *order, token), keys, order)
    item = F.struct(*[F.col(o) for o in order], F.col(token).alias("_tok"))
    parts = dealt.groupBy(CHUNK, *keys).agg(
        _ordered_join(F.collect_list(item), order, "_tok", sep).alias("_part"))
    return parts.groupBy(*keys).agg(
        _ordered_join(F.collect_list(F.struct(F.col(CHUNK), F.col("_part").alias("_tok"))),
                      [CHUNK], "_tok", sep).alias(name))


def running_concat(df: DataFrame, keys: Sequence[str], order: Sequence[str], token: str,
                   name: str = "text", sep: str = "") -> DataFrame:
    """AGG-2 + W-6: every row with its key's tokens so far, concatenated.

    The output is quadratic in the group size by definition. Each (key,
    chunk) is joined into one text; a row's value is the text of all earlier
    chunks and a prefix of its own chunk's text, cut at the running length,
    so no list of tokens is built per row.
    """
    keys, order = list(keys), list(order)
    had = CHUNK in df.columns
    dealt = df if had else deal(df, keys, order)
    piece = F.concat(F.lit(sep), F.coalesce(F.col(token).cast("string"), F.lit("")))
    # a NULL token adds nothing, not even a separator
    size = F.when(F.col(token).isNull(), F.lit(0)).otherwise(F.length(piece)).cast("long")
    w = Window.partitionBy(CHUNK, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    item = F.struct(*[F.col(o) for o in order], F.when(F.col(token).isNotNull(), piece).alias("_tok"))
    parts = dealt.groupBy(CHUNK, *keys).agg(
        _ordered_join(F.collect_list(item), order, "_tok", "").alias("_part"))
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_head", F.array_join(F.collect_list("_part").over(before), ""))
    out = join_on(dealt.withColumn("_upto", F.sum(size).over(w)), parts, [CHUNK, *keys])
    text = F.concat(F.col("_head"), F.substring("_part", F.lit(1), F.col("_upto").cast("int")))
    out = out.withColumn(name, F.substr(text, F.lit(len(sep) + 1)))
    return out.drop("_upto", "_part", "_head", *([] if had else [CHUNK]))


def previous_jump(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                  min_diff: int = MIN_CLICK_JUMP, last_name: str = "last_value",
                  emit_only: bool = True) -> DataFrame:
    """W-1 + P-10: each row with the key's previous value (0 for the first
    row, NULL after a NULL); with ``emit_only`` keep rows whose value is 0 or
    rose by more than ``min_diff``. The previous value moves on every row,
    emitted or not."""
    prev = previous_values(df, keys, order, {last_name: F.col(value)}, exists="_had_previous")
    prev = prev.withColumn(last_name, F.when(F.col("_had_previous"), F.col(last_name))
                           .otherwise(F.lit(0).cast("long"))).drop("_had_previous")
    if emit_only:
        prev = prev.filter(click_jump(value, last_name, min_diff))
    return prev
