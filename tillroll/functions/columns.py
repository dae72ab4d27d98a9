"""Column builders.  Everything here is a Catalyst expression (no Python UDFs)."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import config as C


def blank_to_null(c: Column) -> Column:
    """Trim spaces; an empty result becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def parse_ts(c: Column, formats: Iterable[str] = C.TS_FORMATS) -> Column:
    """First format that parses wins; unparseable -> NULL (never an error)."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def tolerant_cast(c: Column, type_name: str) -> Column:
    """Cast that yields NULL instead of failing under ANSI mode."""
    return c.try_cast(type_name)


def dq_rules(valid_regions: Iterable[str]) -> dict[str, Column]:
    """Rule name -> predicate that is true when the row breaks the rule.

    Evaluated on the standardised frame.  A NULL amount does not fire
    ``non_positive_amount`` (it fires ``missing_amount``).
    """
    regions = list(valid_regions)
    amount = F.col("amount")
    absent = [F.col(c).isNull() for c in ("transaction_id", "customer_id", "transaction_ts", "amount")]
    foreign = F.col("region").isNull() | ~F.col("region").isin(regions)
    return dict(zip(C.DQ_RULE_NAMES, [*absent, F.coalesce(amount <= 0, F.lit(False)), foreign], strict=True))


def broken_rules(valid_regions: Iterable[str]) -> Column:
    """Array of the names of broken rules, in rule order (empty when clean)."""
    rules = dq_rules(valid_regions)
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))


def any_rule_broken(valid_regions: Iterable[str]) -> Column:
    rules = list(dq_rules(valid_regions).values())
    out = rules[0]
    for r in rules[1:]:
        out = out | r
    return out


def date_key(d: Column) -> Column:
    """YYYYMMDD integer key of a date."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def padded(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def null_safe_differs(a: Iterable[Column], b: Iterable[Column]) -> Column:
    """True when any pair differs, treating NULL = NULL as equal."""
    out = None
    for x, y in zip(a, b, strict=True):
        d = ~x.eqNullSafe(y)
        out = d if out is None else (out | d)
    return out
