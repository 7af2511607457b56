"""Shared building blocks of the registered queries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.config import (DEFAULT_BOUNDS, DEFAULT_SEASONALITY, FEATURE_COLUMNS, TARGET_COLUMN,
                              SeasonalityConfig)
from pricewise.operators.baseline import GroupBaseline, fit_group_baseline
from pricewise.operators.dims import checked_broadcast, written
from pricewise.operators.features import modeling_frame
from pricewise.operators.index import build_index
from pricewise.operators.seasonality import seasonality_factors, seasonality_rows
from pricewise.sources.sinks import scratch_path, write_table
from pricewise.plans.fixtures import (INDEX_BASE_YEAR, INDEX_SERIES, SALE_KEY, sale_view,
                                      series_long)

# columns of the sale view that the modelling frame and the seasonal rows are made of
RATIO_COLUMNS = FEATURE_COLUMNS + [TARGET_COLUMN]
KEYED_COLUMNS = SALE_KEY + RATIO_COLUMNS


@dataclass
class Chain:
    spark: SparkSession
    sf_dir: str
    cfg: SeasonalityConfig = field(default=DEFAULT_SEASONALITY)
    persist_sales: bool | list[str] = False
    _cache: dict = field(default_factory=dict)

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def sales(self) -> DataFrame:
        """The sale view. Lazy by default, for queries that read it once; with
        ``persist_sales`` it is written once, all columns or those named, for
        queries that read it several times (model fit, seasonal rows, quotes), where
        each extra read would repeat the lineitem-orders-part join (a shuffle join at
        scale). It is a table in the shared folder, read with the columns each use
        needs: no executor holds it, and a lost one costs no join again."""
        def build():
            s = sale_view(self.spark, self.sf_dir)
            if not self.persist_sales:
                return s
            s = s if self.persist_sales is True else s.select(*self.persist_sales)
            return self.spark.read.schema(s.schema).parquet(write_table(s, scratch_path(self.spark, "sales")))
        return self._get("sales", build)

    @property
    def index(self) -> DataFrame:
        """Aligned, forward-filled 3-series month index with its multiplier,
        materialised once (a month dimension)."""
        return self._get("index", lambda: checked_broadcast(build_index(
            series_long(self.spark, self.sf_dir), INDEX_SERIES, "price", INDEX_BASE_YEAR)))

    @property
    def frame(self) -> DataFrame:
        return self._get("frame", lambda: modeling_frame(
            self.sales, DEFAULT_BOUNDS, key=[k for k in SALE_KEY if k in self.sales.columns]))

    @property
    def baseline(self) -> GroupBaseline:
        return self._get("baseline", lambda: fit_group_baseline(self.frame))

    @property
    def rows(self) -> DataFrame:
        return self._get("rows", lambda: seasonality_rows(
            self.sales, self.baseline.transform, self.index, self.cfg,
            keep=[k for k in SALE_KEY if k in self.sales.columns]))

    @property
    def factors(self) -> DataFrame:
        """The factor table; what it reads twice of the seasonal rows is written first."""
        return self._get("factors", lambda: checked_broadcast(seasonality_factors(
            written(self.rows.select("body", "sale_month", "price_ratio"), "seasonal-ratios"), self.cfg)))

    @property
    def written_rows(self) -> DataFrame:
        return self._get("written_rows", lambda: written(self.rows, "seasonal-rows"))

    def vehicles(self) -> DataFrame:
        """Every sale as a quote request at its own sale month."""
        s = self.sales
        return s.select(*SALE_KEY, F.col("year").alias("model_year"), "odometer", "condition",
                        "make", "model", "body", F.year("saledate").alias("target_year"),
                        F.col("sale_month").alias("target_month"))
