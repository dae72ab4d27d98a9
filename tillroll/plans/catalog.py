"""The query registry: every implemented operator key -> (spark, sf_dir) -> DataFrame.

Registered outputs use an engine-neutral presentation, and the oracle SQL
applies the same one: decimal (money) columns and integer columns that may be
NULL as double, dates as 'YYYY-MM-DD' text.  Both engines compute exactly in
their own types and convert once at the end, so a comparison does not depend
on how each engine hands decimals, dates or nullable integers to Python.
Tables and operators keep their real types.
"""
from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.plans import catalog_lake, catalog_monitoring, catalog_star, catalog_stream
from tillroll.plans import oracle


# Integer output columns that can hold NULLs (unparseable quantity; customers
# who never bought).
NULLABLE_INTEGERS = ("quantity", "days_since_last_txn")


def presentation(df: DataFrame) -> DataFrame:
    def present(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType) or (
                f.name in NULLABLE_INTEGERS and isinstance(f.dataType, T.IntegralType)):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(f.name)
        return c
    return df.select(*[present(f) for f in df.schema.fields])


def _registered(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        return presentation(fn(spark, sf_dir))
    return run


_ALL = {}
_ALL.update(catalog_lake.QUERIES)
_ALL.update(catalog_star.QUERIES)
_ALL.update(catalog_stream.QUERIES)
_ALL.update(catalog_monitoring.QUERIES)
QUERIES = {k: _registered(f) for k, f in _ALL.items()}

_SQL = {}
_SQL.update(oracle.LAKE_SQL)
_SQL.update(oracle.STAR_SQL)
_SQL.update(oracle.STREAM_SQL)
_SQL.update(oracle.MONITORING_SQL)
ORACLE_SQL = {k: oracle.presented(k, sql) for k, sql in _SQL.items()}


def flagship(spark, sf_dir):
    return QUERIES["h1_top_customers"](spark, sf_dir)
