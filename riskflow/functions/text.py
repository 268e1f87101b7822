"""Null tokens and name predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.schemas import NULL_TOKENS


def null_tokens(c: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Null where the text is one of the tokens, else the text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~c.isin(*tokens), c)


def lacks(c: Column | str, token: str) -> Column:
    """True where the text does not contain the token; null text is not true."""
    c = F.col(c) if isinstance(c, str) else c
    return ~c.contains(token)


def not_named(c: Column | str, names: Iterable[str]) -> Column:
    """True where the lower-cased text is none of the names; null text is not true."""
    c = F.col(c) if isinstance(c, str) else c
    return ~F.lower(c).isin(*[n.lower() for n in names])
