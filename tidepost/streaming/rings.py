"""Keyed state of bounded size: the last rows of a series, and the newest rows of an entity.

Both are processors of ``transformWithStateInPandas``. A key holds a list of rows in the state store
and gives up what it no longer needs after every batch; a timer on event time drops a key that has
been silent for long. Results may be corrected later, so each row carries ``version``, a number that
grows per key; the newest one counts. :func:`newest_versions` and :func:`newest_lists` read that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidepost.operators.entities import latest_per_entity
from tidepost.operators.rolling import BAND_WIDTH, WINDOW_ROWS

#: A key without a row for so long is forgotten.
RETENTION_MS = 30 * 86_400_000
#: Entities are dealt to so many keys each, as one may hold a third of all rows.
SALTS = 8
#: Rows of bands that are made and given on at once; it bounds memory, not results.
OUT_ROWS = 50_000


def _micros(times: pd.Series) -> np.ndarray:
    return pd.to_datetime(times).astype("datetime64[us]").astype("int64").to_numpy()


class _Ring(StatefulProcessor):
    """A list of rows (micros, key, value columns) that stays sorted, and two counts."""

    def __init__(self, state: str, retention_ms: int) -> None:
        self.state, self.retention_ms = state, retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.state)
        self.counts = handle.getValueState("counts", "version bigint, seen bigint")

    def held(self) -> tuple[list[tuple], int, int]:
        version, seen = self.counts.get() if self.counts.exists() else (0, 0)
        return [tuple(r) for r in self.rows.get()], version, seen

    def keep(self, rows: list[tuple], version: int, seen: int, newest_ms: int) -> None:
        if rows:
            self.rows.put(rows)
        else:
            self.rows.clear()
        self.counts.update((version, seen))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(newest_ms + self.retention_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.rows.clear()
        self.counts.clear()
        return iter([])

    def close(self) -> None:
        pass


class RollingRing(_Ring):
    """Bands over the last rows of a series.

    The state holds the rows from the watermark on, which late rows may still come before, and the
    ``window`` rows in front of them. A late row makes the rows after it come out again. Rows older
    than the watermark are too late and go, as in any window.
    """

    def __init__(self, names: list[str], window: int, width: float, exclude_current: bool, retention_ms: int) -> None:
        super().__init__("t bigint, k bigint, x double", retention_ms)
        self.names, self.window, self.width, self.exclude_current = names, window, width, exclude_current

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        series, ts, name, value = self.names
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held, version, seen = self.held()
        # Rows are kept as columns of numbers: time, whether there is a key, key, value.
        parts = [
            (
                np.array([r[0] for r in held], np.int64), np.array([r[1] is not None for r in held], bool),
                np.array([r[1] or 0 for r in held], np.int64), np.array([r[2] for r in held], float),
            )
        ]
        for part in rows:
            known = part[name].notna().to_numpy()
            columns = (_micros(part[ts]), known, part[name].where(known, 0).to_numpy(np.int64), part[value].to_numpy(float))
            timely = columns[0] >= watermark
            parts.append(tuple(c[timely] for c in columns))
        arrived = sum(len(part[0]) for part in parts[1:])
        if not arrived:
            return
        t, known, k, x = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        order = np.lexsort((k, known, t))
        start = 0
        if seen > 2:  # rows before the first that arrived, and not equal to it, are out already
            start = int(np.argmax(order >= len(held)))
            own = order[start]
            while start and all(c[order[start - 1]] == c[own] for c in (t, known, k)):
                start -= 1
        t, known, k, x = (c[order] for c in (t, known, k, x))
        seen, version = seen + arrived, version + 1
        newest = max(int(t[-1]), watermark)
        kept = max(0, int(np.searchsorted(t, watermark)) - self.window)
        last = zip(t[kept:].tolist(), known[kept:].tolist(), k[kept:].tolist(), x[kept:].tolist(), strict=True)
        self.keep([(a, c if b else None, d) for a, b, c, d in last], version, seen, newest // 1000)
        for at in range(start, len(t), OUT_ROWS):
            part = slice(at, at + OUT_ROWS)
            out = self.bands(x, part, seen)
            times = pd.Series(t[part].astype("datetime64[us]")).dt.tz_localize("UTC")
            ids = pd.array(k[part], "Int64")
            ids[~known[part]] = pd.NA
            yield pd.DataFrame({series: key[0], ts: times, name: ids, value: x[part]} | out).assign(version=version)

    def bands(self, x: np.ndarray, part: slice, seen: int) -> dict[str, np.ndarray]:
        """Bands of the rows ``part`` of a series; the rows before them are their frames."""
        before = self.window if self.exclude_current else self.window - 1
        front = x[max(0, part.start - before) : part.start]
        x = x[part]
        padded = np.concatenate([np.full(before - len(front), np.nan), front, x])
        frames = np.lib.stride_tricks.sliding_window_view(padded, before + 1)
        frames = frames[:, :-1] if self.exclude_current else frames
        many = (~np.isnan(frames)).sum(1)
        mean = np.where(many > 0, np.nansum(frames, axis=1) / np.maximum(many, 1), x)
        spread = np.nansum((frames - mean[:, None]) ** 2, axis=1) / np.maximum(many - 1, 1)
        std = np.where(many > 1, np.sqrt(spread), 0.0)
        short = seen <= 2
        mean, std = (x, np.zeros(len(x))) if short else (mean, std)
        up, down = mean + self.width * std, mean - self.width * std
        odd = ((x > up) | (x < down)) & (not short) & ((std > 0) | (not self.exclude_current))
        return {"rolling_mean": mean, "rolling_std": std, "upper_band": up, "lower_band": down, "is_anomaly": odd}


def rolling_bands(
    df: DataFrame, series: str = "platform", value: str = "sentiment_score", ts: str = "timestamp", key: str = "post_id",
    window: int = WINDOW_ROWS, width: float = BAND_WIDTH, exclude_current: bool = False, delay: str = "1 hour",
    retention_ms: int = RETENTION_MS,
) -> DataFrame:
    """Bands of a stream: every row once or, where others came late, in several versions.

    Rows of a series pass one task of a batch, whose size the source bounds, as columns of some hundred
    bytes a row; for series that are too
    hot for that take ``sinks.RollingBands``. Rows without a time or value do not take part.
    """
    rows = df.select(series, F.col(ts).cast("timestamp").alias(ts), F.col(key).cast("bigint").alias(key), F.col(value).cast("double").alias(value))
    rows = rows.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).withWatermark(ts, delay)
    kind = df.schema[series].dataType.simpleString()
    schema = (
        f"`{series}` {kind}, `{ts}` timestamp, `{key}` bigint, `{value}` double, rolling_mean double, rolling_std double, "
        "upper_band double, lower_band double, is_anomaly boolean, version bigint"
    )
    ring = RollingRing([series, ts, key, value], window, width, exclude_current, retention_ms)
    return rows.groupBy(series).transformWithStateInPandas(ring, schema, "append", "eventtime")


class NewestRing(_Ring):
    """The newest rows of a key; the older ones are evicted."""

    def __init__(self, columns: list[tuple[str, str]], ts: str, key: str, n: int, retention_ms: int) -> None:
        super().__init__("t bigint, k bigint, " + ", ".join(f"`v{i}` {kind}" for i, (_, kind) in enumerate(columns)), retention_ms)
        self.columns, self.ts, self.key, self.n = [c for c, _ in columns], ts, key, n

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, version, seen = self.held()
        for part in rows:
            seen += len(part)
            values = [part[c].astype(object).where(part[c].notna(), None).tolist() for c in self.columns]
            held += zip(_micros(part[self.ts]).tolist(), part[self.key].tolist(), *values, strict=True)
            held = sorted(held, key=lambda r: (-r[0], r[1]))[: self.n]
        self.keep(held, version + 1, seen, max(held[0][0] // 1000, timerValues.getCurrentWatermarkInMs()))
        times = pd.Series(np.array([r[0] for r in held], "datetime64[us]")).dt.tz_localize("UTC")
        out = {"entity": key[0], "salt": key[1], self.ts: times, self.key: [r[1] for r in held]}
        out |= {c: [r[2 + i] for r in held] for i, c in enumerate(self.columns)}
        yield pd.DataFrame(out).assign(version=version + 1)


def newest_per_entity(
    tagged: DataFrame, n: int, columns: list[str], ts: str = "timestamp", key: str = "post_id", delay: str = "1 hour",
    salts: int = SALTS, retention_ms: int = RETENTION_MS,
) -> DataFrame:
    """Whenever rows of an entity arrive, its newest ``n`` rows so far, for each of ``salts`` parts.

    The newest rows of an entity are among those of its parts, see :func:`newest_lists`. Late rows
    count like others, ties go to the smaller id; rows without a time do not take part.
    """
    kinds = dict(tagged.dtypes)
    salt = F.pmod(F.xxhash64(key), F.lit(salts)).cast("int").alias("salt")
    rows = tagged.select("entity", salt, F.col(ts).cast("timestamp").alias(ts), F.col(key).cast("bigint").alias(key), *columns)
    rows = rows.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    described = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    ring = NewestRing([(c, kinds[c]) for c in columns], ts, key, n, retention_ms)
    schema = f"entity string, salt int, `{ts}` timestamp, `{key}` bigint, {described}, version bigint"
    return rows.groupBy("entity", "salt").transformWithStateInPandas(ring, schema, "append", "eventtime")


def newest_versions(rows: DataFrame, *keys: str) -> DataFrame:
    """Every row once, as it was given last."""
    values = [c for c in rows.columns if c not in (*keys, "version")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "version").alias("v"))
    return newest.select(*keys, "v.*")


def newest_lists(rows: DataFrame, n: int, ts: str = "timestamp", key: str = "post_id") -> DataFrame:
    """The newest ``n`` rows of each entity from the last list of each of its parts."""
    last = rows.groupBy("entity", "salt").agg(F.max("version").alias("version"))
    return latest_per_entity(rows.join(last, ["entity", "salt", "version"], "left_semi"), n, ts, key).drop("salt", "version")
