"""Frames of one order drop (raw, first copies, clean, dedup, splits)."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import clean as C
from tillroll.operators.questions import targets_dim
from tillroll.schema import FIXTURE_PARAMS, ROW_SEQ, Params
from tillroll.sources.tables import Deal, raw_sales


class Drop:
    """All frames derive lazily from ``raw``; nothing is computed here."""

    def __init__(self, spark: SparkSession, raw: DataFrame, params: Params = Params()):
        self.spark = spark
        self.__dict__["raw"] = raw
        self.params = params
        self.key = uuid.uuid4().hex[:12]

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> Drop:
        return cls(spark, raw_sales(spark, sf_dir), params)

    @property
    def rows(self) -> DataFrame:
        """The raw rows for one pass over them."""
        return self.raw

    def dealt(self, deal: Deal) -> DataFrame:
        """The raw rows dealt to tasks by ``deal``."""
        return deal(self.rows, [ROW_SEQ])

    @cached_property
    def firsts(self) -> DataFrame:
        """The rows that the two cleaning orders need (``clean.first_copies``)."""
        return C.first_copies(self.raw)

    @cached_property
    def first_rows(self) -> DataFrame:
        """Raw columns of the first copy of every order_id (keep-first)."""
        return C.first_rows(self.firsts)

    @cached_property
    def first_kept_rows(self) -> DataFrame:
        """Raw columns of the first non-returned copy (filter, then keep-first)."""
        return C.first_kept_rows(self.firsts)

    @cached_property
    def clean(self) -> DataFrame:
        return C.sales_clean(self.raw)

    @cached_property
    def dedup(self) -> DataFrame:
        return C.dedup_clean(self.raw, with_gross=True)

    @cached_property
    def kept(self) -> DataFrame:
        return C.split_kept(self.dedup)

    @cached_property
    def returns(self) -> DataFrame:
        return C.split_returns(self.dedup)

    @cached_property
    def targets(self) -> DataFrame:
        return targets_dim(self.raw, self.params.weekly_target)


def as_output(df: DataFrame) -> DataFrame:
    """Plain output types: DECIMAL money becomes DOUBLE."""
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields
             if f.dataType.typeName() == "decimal"}
    return df.withColumns(casts) if casts else df
