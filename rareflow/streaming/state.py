"""Rolling features per user as keyed state: rows wait for the watermark, then leave in time order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

ROW = StructType(
    [
        StructField("event_us", LongType()),
        StructField("txn_id", LongType()),
        StructField("Amount", DoubleType()),
        StructField("Class", IntegerType()),
    ]
)


def feature_names(sizes: Sequence[int]) -> list[str]:
    kinds = ("Amount_rolling_mean", "Amount_rolling_std", "velocity", "positive_rate_rolling")
    return [f"{kind}_{s}" for kind in kinds for s in sizes]


def rolling_schema(sizes: Sequence[int]) -> StructType:
    kind = {"velocity": LongType()}
    features = [StructField(n, kind.get(n.rsplit("_", 1)[0], DoubleType())) for n in feature_names(sizes)]
    return StructType([StructField("txn_id", LongType()), StructField("user_id", LongType()), *features])


def rolling_values(rows: list[tuple], first: int, sizes: Sequence[int]) -> list[list]:
    """The features of ``rows[first:]``, each over the last rows up to itself; nulls in a value don't count."""
    out = []
    for i in range(first, len(rows)):
        features: dict[str, float | int | None] = {}
        for s in sizes:
            window = rows[max(0, i - s + 1) : i + 1]
            amounts = np.array([r[2] for r in window if r[2] is not None], dtype=float)
            labels = [r[3] for r in window if r[3] is not None]
            features[f"Amount_rolling_mean_{s}"] = float(amounts.mean()) if len(amounts) else None
            features[f"Amount_rolling_std_{s}"] = float(amounts.std(ddof=1)) if len(amounts) > 1 else None
            features[f"velocity_{s}"] = len(window)
            features[f"positive_rate_rolling_{s}"] = sum(labels) / len(labels) if labels else None
        out.append([features[n] for n in feature_names(sizes)])
    return out


class RollingRows(StatefulProcessor):
    """Keeps, for each user, the rows that wait for the watermark and the last ones before them.

    A row leaves once the watermark has passed it, so rows that arrive out of order within
    the delay are put in order, and a result never changes afterwards. Rows behind the
    watermark are dropped by Spark before they come here. A timer stands at the user's
    earliest waiting row; users without new or due rows are not touched.
    """

    def __init__(self, sizes: Sequence[int]):
        self.sizes = list(sizes)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", ROW)
        self.last = handle.getListState("last", ROW)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [tuple(None if v != v else v for v in r) for frame in rows for r in frame[ROW.names].itertuples(index=False, name=None)]
        new = [(int(us), int(txn), a, None if c is None else int(c)) for us, txn, a, c in new]
        if new:
            self.waiting.appendList(new)
            self._wake(min(r[0] for r in new))
        return iter(())

    def _wake(self, event_us: int) -> None:
        self.handle.registerTimer(-(-event_us // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(tuple(r) for r in self.waiting.get())
        due = [r for r in rows if r[0] <= mark]
        if not due:
            return
        before = sorted(tuple(r) for r in self.last.get())
        seen = before + due
        values = rolling_values(seen, len(before), self.sizes)
        self.last.put(seen[-max(1, max(self.sizes) - 1) :])
        left = rows[len(due) :]
        if left:
            self.waiting.put(left)
            self._wake(left[0][0])
        else:
            self.waiting.clear()
        names = rolling_schema(self.sizes).names
        yield pd.DataFrame([[r[1], key[0], *v] for r, v in zip(due, values)], columns=names)

    def close(self) -> None:
        pass
