"""Lazy per-call bundle of the raw, cleaned and feature tables.

Each attribute is built on first access and is only a logical plan; nothing
is computed until an action.  Registered queries build one bundle per call,
so every query reads the whole driver tables it depends on.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning as C
from ..operators import features as FE
from ..sources import roles
from ..sources.files import WORKERS
from ..sources.roles import DEFAULT_AS_OF


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of=DEFAULT_AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    # raw sources
    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return roles.load_sources(self.spark, self.sf_dir)

    # cleaned
    @cached_property
    def transactions(self) -> DataFrame:
        return C.clean_transactions(self.raw["transactions"])

    @cached_property
    def clickstream(self) -> DataFrame:
        return C.clean_clickstream(self.raw["clickstream"])

    @cached_property
    def products(self) -> DataFrame:
        return C.clean_products(self.raw["products"])

    @cached_property
    def users(self) -> DataFrame:
        return C.clean_users(self.raw["users"], self.as_of)

    @cached_property
    def external(self) -> DataFrame:
        return C.clean_external(self.raw["external_scores"])

    # features
    @cached_property
    def all_features(self) -> dict[str, DataFrame]:
        """The three feature tables, sharing what they have in common.  The sources
        are cleaned side by side, as each is written on the way."""
        self.raw  # built once, before the threads ask for it
        with ThreadPoolExecutor(WORKERS) as pool:
            list(pool.map(lambda name: getattr(self, name), ("transactions", "clickstream", "products", "users")))
        return FE.build_features({"transactions": self.transactions, "clickstream": self.clickstream,
                                  "products": self.products, "users": self.users,
                                  "external_scores": self.external}, self.as_of)

    @cached_property
    def user_features(self) -> DataFrame:
        return FE.user_features(self.transactions, self.clickstream, self.users, self.as_of)

    @cached_property
    def item_features(self) -> DataFrame:
        return FE.item_features(self.transactions, self.clickstream, self.products, self.external)

    @cached_property
    def interactions(self) -> DataFrame:
        return FE.interaction_features(self.transactions, self.clickstream)
