"""Checks and links between the article tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.schemas import PROCESSING_TYPES


def conform(table: DataFrame, layout: T.StructType) -> DataFrame:
    """The table in the given layout: missing columns come as nulls, others follow as they are."""
    have = set(table.columns)
    named = {f.name for f in layout.fields}
    return table.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in layout.fields
        ],
        *[c for c in table.columns if c not in named],
    )


def missing_columns(table: DataFrame, layout: T.StructType) -> list[str]:
    return [f.name for f in layout.fields if f.name not in table.columns]


def schema_gaps(
    tables: dict[str, tuple[DataFrame | None, T.StructType]], spark: SparkSession | None = None
) -> DataFrame:
    """What each table lacks: (table_name, column_name, issue, rows).

    ``absent``: there is no such table (None is given for it); ``missing``: the column is
    not there, whether or not there are rows; ``null``: rows of a required column without a
    value. One aggregation per table; an empty answer means ready for use.
    """
    spark = spark or SparkSession.getActiveSession()

    def absent_table(name: str) -> DataFrame:
        return spark.range(1).select(
            F.lit(name).alias("table_name"),
            F.lit(None).cast("string").alias("column_name"),
            F.lit("absent").alias("issue"),
            F.lit(0).cast("bigint").alias("rows"),
        )

    def check(name: str, table: DataFrame, layout: T.StructType) -> DataFrame:
        absent = set(missing_columns(table, layout))
        rules = [(f.name, "missing") for f in layout.fields if f.name in absent] + [
            (f.name, "null") for f in layout.fields if not f.nullable and f.name not in absent
        ]
        counts = table.agg(
            *[
                (
                    F.count(F.lit(1))
                    if issue == "missing"
                    else F.count(F.when(F.col(column).isNull(), 1))
                ).alias(f"n{i}")
                for i, (column, issue) in enumerate(rules)
            ]
        )
        found = F.array(
            *[
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.lit(issue).alias("issue"),
                    F.col(f"n{i}").alias("rows"),
                )
                for i, (column, issue) in enumerate(rules)
            ]
        )
        gaps = counts.select(F.inline(found))
        return gaps.where((F.col("issue") == "missing") | (F.col("rows") > 0))

    return reduce(
        DataFrame.unionByName,
        [
            absent_table(name) if table is None else check(name, table, layout)
            for name, (table, layout) in tables.items()
        ],
    )


def invalid_types(results: DataFrame) -> DataFrame:
    """Stored metric rows whose processing type is none of the allowed ones."""
    return results.where(~F.coalesce(F.col("processing_type").isin(*PROCESSING_TYPES), F.lit(False)))


def is_ready(tables: dict[str, tuple[DataFrame | None, T.StructType]]) -> bool:
    """Whether every table is there with its columns, and values where they are required."""
    return schema_gaps(tables).isEmpty()


# The joins below meet on ids. Spark picks the join by size; where one id holds a large
# part of the rows that are kept, adaptive execution splits its partition over several
# tasks. For that nothing may stand between the shuffle and the join, so the side that is
# only looked up keeps its repeated ids, which semi and anti joins do not mind.


def ids(table: DataFrame, column: str, name: str) -> DataFrame:
    return table.select(F.col(column).alias(name))


def raw_with_processed(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Each processed article next to the raw article it came from."""
    left = raw.select(F.col("id").alias("raw_article_id"), "url")
    return left.join(processed, "raw_article_id")


def unprocessed(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw articles without a processed one: extraction failed or has not run."""
    return raw.join(ids(processed, "raw_article_id", "id"), "id", "left_anti")


def orphans(processed: DataFrame, raw: DataFrame) -> DataFrame:
    """Processed articles whose raw article is gone."""
    return processed.join(ids(raw, "id", "raw_article_id"), "raw_article_id", "left_anti")


def cascade_delete(processed: DataFrame, raw: DataFrame) -> DataFrame:
    """Processed articles that remain when those without a raw article go."""
    return processed.join(ids(raw, "id", "raw_article_id"), "raw_article_id", "left_semi")
