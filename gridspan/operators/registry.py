"""External models behind one call: name -> (panel, start, end) -> forecast frame."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import whole_final_day
from ..spec import PANEL, PanelSpec, SchemaError

Forecaster = Callable[[DataFrame, str, str], DataFrame]


class UnknownForecaster(KeyError):
    """No forecaster is registered under the name."""


class ForecasterFailed(RuntimeError):
    """A forecaster raised or returned something other than a forecast."""


class ForecasterRegistry:
    """Named forecasters; results are restricted to the asked window."""

    def __init__(self, spec: PanelSpec = PANEL):
        self.spec, self._by_name = spec, {}

    def register(self, name: str, forecaster: Forecaster) -> None:
        if name in self._by_name:
            raise ValueError(f"{name} is registered already")
        self._by_name[name] = forecaster

    def names(self) -> list[str]:
        return sorted(self._by_name)

    def forecast(self, name: str, panel: DataFrame, start: str, end: str) -> DataFrame:
        if name not in self._by_name:
            raise UnknownForecaster(f"{name}; known: {self.names()}")
        self.spec.require(panel)
        try:
            result = self._by_name[name](panel, start, end)
        except SchemaError:
            raise
        except Exception as e:
            raise ForecasterFailed(f"{name}: {e}") from e
        missing = {self.spec.entity, self.spec.ts, "pred"} - set(getattr(result, "columns", ()))
        if missing:
            raise ForecasterFailed(f"{name} returned no {sorted(missing)}")
        ts = F.col(self.spec.ts)
        first = F.lit(start).cast("timestamp_ntz")
        last = whole_final_day(F.lit(end).cast("timestamp_ntz"))
        return result.filter((ts >= first) & (ts <= last))


def batch_scorer(predict: Callable[[pd.DataFrame], pd.Series], features: Sequence[str],
                 keep: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Score rows with a fitted external model in Arrow batches.

    ``predict`` maps a frame of features to predictions; it is shipped to the tasks.
    """
    keep, features = list(keep), list(features)

    def run(df: DataFrame) -> DataFrame:
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = batch[keep].copy()
                out["pred"] = predict(batch[features]).astype(float)
                yield out
        schema = df.select(*keep, F.lit(0.0).alias("pred")).schema
        return df.select(*dict.fromkeys([*keep, *features])).mapInPandas(score, schema)
    return run


def group_apply(df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
                schema) -> DataFrame:
    """A user's group function.  Groups must be bounded: reduce rows before calling."""
    return df.groupBy(*keys).applyInPandas(fn, schema)
