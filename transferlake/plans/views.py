"""Shared view set for one (session, scale-factor folder): V1-V6 plus the operator outputs
built on them. Everything is lazy; nothing is collected."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlake.functions import instant_to_ntz
from transferlake.operators import cleaning, enrich
from transferlake.sources import testdata

# Money in the test tables has two decimals: sums are exact DECIMAL(18,2) in the checked queries.
MONEY_SCALE = 2


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return testdata.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:          # V1
        return testdata.raw_transfers(self.table("orders"))

    @cached_property
    def clean(self) -> DataFrame:        # V2
        return cleaning.clean_transfers(self.raw)

    @cached_property
    def tagged(self) -> DataFrame:
        return cleaning.tag_transfers(self.clean)

    @cached_property
    def good(self) -> DataFrame:         # V3
        return cleaning.good_rows(self.tagged)

    @cached_property
    def dlq(self) -> DataFrame:
        return cleaning.dlq_rows(self.tagged, stamp=False)

    @cached_property
    def events(self) -> DataFrame:       # V4
        return testdata.tx_events(self.table("events"))

    @cached_property
    def dim(self) -> DataFrame:          # V5
        return enrich.receiver_dim(self.good)

    @cached_property
    def dim_snapshot(self) -> DataFrame:
        """V5 frozen as a table in the shared folder (written when first used)."""
        from transferlake.session import shared_dir
        return enrich.snapshot_dimension(self.dim, shared_dir(self.spark, "dims", unique=True))

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich_events(self.events, self.dim_snapshot)

    @cached_property
    def users(self) -> DataFrame:        # V6
        return testdata.users(self.table("customer"))

    @cached_property
    def transfers(self) -> DataFrame:
        return testdata.user_transfers(self.table("orders"))

    @cached_property
    def currencies(self) -> DataFrame:
        return testdata.currencies(self.table("nation"), self.table("region"))


def for_oracle(df: DataFrame) -> DataFrame:
    """Checked outputs carry naive UTC timestamps and reason lists as comma-joined text, so
    they compare value for value with the SQL oracle whatever the session time zone."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = instant_to_ntz(c)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)
