"""Text functions: lower-case, regex split, token filters, ordered concat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.constants import ARTICLES, TOKEN_SPLIT_REGEX


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_tokens(text: Column | str, pattern: str = TOKEN_SPLIT_REGEX) -> Column:
    """``lower(text)`` split on ``pattern`` (Java regex; ``\\W`` is ASCII)."""
    return F.split(F.lower(_c(text)), pattern)


def explode_tokens(df: DataFrame, text: str, keep: Sequence[str] | None = None,
                   pattern: str = TOKEN_SPLIT_REGEX, token_col: str = "token",
                   pos_col: str | None = None) -> DataFrame:
    """One row per token of the whole text (P-1), optionally only tokens in
    ``keep`` (P-2), which are picked before the rows are made. ``pos_col``
    adds the 0-based token position."""
    arr = split_tokens(text, pattern)
    others = [c for c in df.columns if c != text]
    if pos_col is None:
        if keep is not None:
            arr = F.filter(arr, lambda t: t.isin(*keep))
        return df.select(*others, F.explode(arr).alias(token_col))
    items = F.transform(arr, lambda t, i: F.struct(i.alias("pos"), t.alias("tok")))
    if keep is not None:
        items = F.filter(items, lambda x: x["tok"].isin(*keep))
    return (df.select(*others, F.explode(items).alias("_tok"))
            .select(*others, F.col("_tok.pos").alias(pos_col), F.col("_tok.tok").alias(token_col)))


def article_flag(token: Column | str) -> Column:
    """Key of the article counter: whether the token is ``a``."""
    return _c(token) == F.lit(ARTICLES[1])
