"""The read side over a lake: every listing, lookup and report by name, from the stored marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pricelake.plans import serving
from pricelake.sources.lake import Lake


@dataclass(frozen=True)
class Storefront:
    lake: Lake

    def _table(self, name: str) -> DataFrame:
        return self.lake.read("warehouse", name)

    def list_products(self, **request) -> DataFrame:
        return serving.list_products(self._table("mart_product_performance"),
                                     self._table("product_segment"), **request)

    def page_info(self, **request) -> DataFrame:
        return serving.page_info(self._table("mart_product_performance"), **request)

    def product(self, product_id: int) -> DataFrame:
        return serving.product(self._table("mart_product_performance"),
                               self._table("product_segment"), product_id)

    def price_history(self, product_id: int) -> DataFrame:
        return serving.price_history(self.lake.facts(), self._table("dim_date"), product_id)

    def forecast(self, product_id: int, target: str = "price") -> DataFrame:
        return serving.forecast(self._table("ml_forecast"), product_id, target)

    def recommendations(self, product_id: int) -> DataFrame:
        return serving.recommendations(self._table("ml_recommendation"),
                                       self._table("mart_product_performance"), product_id)

    def anomalies(self, limit: int = 50) -> DataFrame:
        return serving.anomalies(self._table("ml_anomaly"),
                                 self._table("mart_product_performance"), limit)

    def top_deals(self, limit: int = 20) -> DataFrame:
        return serving.top_deals(self._table("mart_trending_deals"), limit)

    def category_daily(self) -> DataFrame:
        return serving.category_daily(self._table("agg_category_daily"))

    def facets(self) -> DataFrame:
        return serving.facets(self._table("mart_product_performance"),
                              self._table("product_segment"))

    def kpis(self) -> DataFrame:
        return serving.kpis(
            self._table("dim_product"), self._table("mart_product_performance"),
            self.lake.facts(), self._table("mart_trending_deals"), self._table("ml_anomaly"),
            self._table("dq_report"))

    def insights(self) -> DataFrame:
        return serving.headlines(serving.insights(self._table("agg_category_daily")))

    def quality(self) -> DataFrame:
        return serving.latest_quality(self._table("dq_report"))
