"""Which users (and optionally which subject) a computation is about."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scope:
    user_id: Any = None
    centre_id: Any = None
    batch_id: Any = None
    subject_id: Any = None
    trade_id: Any = None
    # Either a short list of ids, or a frame with a user_id column of any size.
    user_ids: Sequence[Any] | DataFrame | None = None

    @property
    def names_users(self) -> bool:
        return any(v is not None for v in (self.user_id, self.centre_id, self.batch_id, self.trade_id, self.user_ids))

    def users(self, df: DataFrame, user_id: str = "user_id", centre_id: str = "centre_id") -> DataFrame:
        """Restrict by user and centre; these reach the scan as pushed filters."""
        if self.user_id is not None:
            df = df.filter(F.col(user_id) == self.user_id)
        if self.centre_id is not None:
            df = df.filter(F.col(centre_id) == self.centre_id)
        if isinstance(self.user_ids, DataFrame):
            ids = self.user_ids.select(F.col("user_id").alias(user_id)).distinct()
            df = df.join(ids, user_id, "left_semi")
        elif self.user_ids is not None:
            df = df.filter(F.col(user_id).isin(list(self.user_ids)))
        return df

    def profile(self, df: DataFrame, exempt=None) -> DataFrame:
        """Restrict by batch and trade; rows that meet ``exempt`` stay whatever they hold."""
        for name, value in (("batch_id", self.batch_id), ("trade_id", self.trade_id)):
            if value is not None:
                keep = F.col(name) == value
                df = df.filter(keep if exempt is None else keep | exempt)
        return df


EVERYONE = Scope()
