"""Standardisation of raw text rows (trim, case, tolerant casts, dates)."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import config as C
from tillroll.functions.columns import blank_to_null, parse_ts, tolerant_cast


def trim_strings(df: DataFrame) -> DataFrame:
    """Every string column: trimmed, and blank becomes NULL (one projection)."""
    return df.select(*[
        blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def standardise(df: DataFrame, ts_formats: Iterable[str] = C.TS_FORMATS) -> DataFrame:
    """Raw text -> typed rows.  Bad values become NULL; nothing raises."""
    df = trim_strings(df)
    return df.withColumns({
        "region": F.upper("region"),
        "status": F.upper("status"),
        "quantity": tolerant_cast(F.col("quantity"), "int"),
        "unit_price": tolerant_cast(F.col("unit_price"), "decimal(12,2)"),
        "amount": tolerant_cast(F.col("amount"), "decimal(14,2)"),
        "transaction_ts": parse_ts(F.col("transaction_ts"), ts_formats),
        "ingest_ts": F.try_to_timestamp(F.col("ingest_ts"), F.lit(C.INGEST_TS_FORMAT)),
        "currency": F.coalesce(F.col("currency"), F.lit(C.DEFAULT_CURRENCY)),
        "payment_method": F.coalesce(F.col("payment_method"), F.lit(C.DEFAULT_PAYMENT_METHOD)),
    })


def add_date_parts(df: DataFrame, ts_col: str = "transaction_ts") -> DataFrame:
    """transaction_date plus zero-padded year/month/day strings (partition folders).

    Always recomputed from the timestamp, never taken from re-read folders.
    """
    ts = F.col(ts_col)
    return df.withColumns({
        "transaction_date": F.to_date(ts),
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    })
