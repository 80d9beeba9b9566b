"""Keyed state with timers and expiry: visits that end when their user is idle, and keys that are remembered for a time.

Both want spark.sql.streaming.stateStore.providerClass to be RocksDB's.
"""

from __future__ import annotations

import json
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from brindle.functions.times import event_time

VISIT = "user_id long, start timestamp_ntz, end timestamp_ntz, n long, kinds string, events string"


def _bucket(buckets: int, *keys: str) -> Column:
    """The bucket of `keys`, the first of which may be null: then it is -1. A call of a processor and of its state costs some milliseconds, so keys share them."""
    return F.when(F.col(keys[0]).isNull(), -1).otherwise(F.pmod(F.xxhash64(*keys), F.lit(buckets))).alias("bucket")


class Visits(StatefulProcessor):
    """A user's events no further apart than `gap` microseconds are a visit. It is emitted when an event shows it to be over, or when the watermark passes
    its end, by a timer: a user who does not come back needs no event to be closed. An event before a visit begins joins it if within the gap, else is over.

    State of a bucket of users: their open visits (a list of pages), when the first of them ends (a value, for which there is the timer), and of visits
    of more than TAIL events the ids of earlier ones (a map), which are not written again. All of it goes with the visits.
    """

    PAGE, TAIL, PART = 512, 256, 10_000

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.alarm = handle.getValueState("alarm", "at long")
        self.open = handle.getListState("open", "visits string")
        self.earlier = handle.getMapState("earlier", "user_id long, part int", "events string")

    def _ends(self, last: int) -> int:
        return -(-(last + self.gap) // 1000)  # timers are in milliseconds

    def _row(self, user: int, start: int, last: int, kinds: dict[str, int], events: list[int], n: int, parts: int = 0) -> tuple:
        known = ",".join(f"{k}:{n}" for k, n in sorted(kinds.items())) or None
        ids = [",".join(map(str, events))] if events else []
        if parts:
            ids = [self.earlier.getValue((user, part))[0] for part in range(parts)] + ids
            for part in range(parts):
                self.earlier.removeKey((user, part))
        return user, start, last + self.gap, n, known, ",".join(ids)

    def _load(self) -> dict[int, list]:
        """The open visits by user: start, last, kinds, the last events, number of events, parts of earlier ones."""
        return {v[0]: v[1:] for page in self.open.get() for v in json.loads(page[0])}

    def _close(self, visits: dict[int, list], had: int | None, fired: bool, watermark: int) -> list[tuple]:
        """Rows of what the watermark has passed; the others are stored, with a timer for the first to end."""
        due = [u for u, v in visits.items() if self._ends(v[1]) <= watermark]
        out = [self._row(u, *visits.pop(u)) for u in due]
        for u, v in visits.items():
            if len(v[3]) > self.TAIL:
                for i in range(0, len(v[3]), self.PART):
                    self.earlier.updateValue((u, v[5]), (",".join(map(str, v[3][i : i + self.PART])),))
                    v[5] += 1
                v[3] = []
        pages = [[u, *v] for u, v in visits.items()]
        at = self._ends(min(v[1] for v in visits.values())) if visits else None
        if had is not None and had != at and not fired:  # a timer that fired is deleted by Spark
            self.handle.deleteTimer(had)
        if at is None:
            self.alarm.clear()
            self.open.clear()
            return out
        self.open.put([(json.dumps(pages[i : i + self.PAGE], separators=(",", ":")),) for i in range(0, len(pages), self.PAGE)])
        if had != at:
            self.alarm.update((at,))
            self.handle.registerTimer(at)
        return out

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows), ignore_index=True)
        user, us, event = (pdf[c].astype("int64").to_numpy() for c in ("user_id", "us", "event_id"))
        order = np.lexsort((event, us, user))
        user, us = user[order], us[order]
        cuts = np.flatnonzero((np.diff(user) != 0) | (np.diff(us) >= self.gap)) + 1
        lows, highs = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(user)]))
        event, kind = event[order].tolist(), _texts(pdf["event_type"].iloc[order])
        alarm = self.alarm.get()
        visits = self._load() if alarm else {}
        out = []
        for u, first, last, lo, hi in zip(user[lows].tolist(), us[lows].tolist(), us[highs - 1].tolist(), lows.tolist(), highs.tolist()):
            kinds = {kind[lo]: 1} if hi - lo == 1 else dict(Counter(kind[lo:hi]))
            kinds.pop(None, None)
            now = [first, last, kinds, event[lo:hi], hi - lo, 0]
            was = visits.get(u)
            if was is None:
                visits[u] = now
            elif first - was[1] >= self.gap:
                out.append(self._row(u, *was))
                visits[u] = now
            elif was[0] - last >= self.gap:
                out.append(self._row(u, *now))
            else:
                for k, n in kinds.items():
                    was[2][k] = was[2].get(k, 0) + n
                visits[u] = [min(first, was[0]), max(last, was[1]), was[2], was[3] + now[3], was[4] + now[4], was[5]]
        out += self._close(visits, alarm[0] if alarm else None, False, timerValues.getCurrentWatermarkInMs())
        if out:
            yield _frame(out, key[0] < 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        alarm = self.alarm.get()
        if alarm and alarm[0] <= expiredTimerInfo.getExpiryTimeInMs():
            out = self._close(self._load(), alarm[0], True, max(alarm[0], timerValues.getCurrentWatermarkInMs()))
            yield _frame(out, key[0] < 0)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple], unknown: bool) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["user_id", "start", "end", "n", "kinds", "events"])
    for c in ("start", "end"):
        out[c] = pd.to_datetime(out[c].astype("int64"), unit="us")
    if unknown:
        out["user_id"] = None
    return out.astype({"user_id": "Int64", "n": "int64", "kinds": object, "events": object})


def _texts(column: pd.Series) -> list:
    return column.astype(object).where(column.notna(), None).tolist()


def visits(events: DataFrame, gap_seconds: int, late: str, buckets: int = 1024) -> DataFrame:
    """Visits of each user of events (event_id, user_id, event_type, ts), as the watermark closes them; events without a time belong to none.

    A checkpoint holds for one number of buckets; a bucket's rows of a batch and its open visits are in memory at once.
    """
    e = events.where("ts is not null").withColumn("at", event_time(F.col("ts"))).withWatermark("at", late)
    e = e.select(_bucket(buckets, "user_id"), F.coalesce("user_id", F.lit(0)).alias("user_id"), "event_id", "event_type", "at", F.unix_micros("at").alias("us"))
    return e.groupBy("bucket").transformWithStateInPandas(Visits(gap_seconds * 1_000_000), VISIT, "append", "EventTime")


class Remembered(StatefulProcessor):
    """The first row of each key; a key is forgotten `ttl` milliseconds after it came (by the clock), so state does not grow with all keys there ever were.

    State of a bucket of keys: pages (a map) of keys and when they expire, and their number (a value), which doubles when one grows beyond PAGE keys.
    So a batch reads and writes a bounded page for a key, or for many. Both go when no key came for `ttl`; keys of a page that is written go by their own time.
    """

    PAGE = 512

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n int", self.ttl)
        self.pages = handle.getMapState("pages", "page int", "expiries string", self.ttl)

    def _page(self, page: int, now: int) -> dict[str, int]:
        got = self.pages.getValue((page,))
        return {k: t for k, t in json.loads(got[0]).items() if t > now} if got else {}

    def handleInputRows(self, key, rows, timerValues):
        first: dict[tuple, int] = {}
        for pdf in rows:
            users = pdf["user_id"].tolist() if key[0] >= 0 else [None] * len(pdf)
            for k, e in zip(zip(users, _texts(pdf["event_type"])), pdf["event_id"].tolist()):
                if first.get(k, e) >= e:
                    first[k] = e
        now, count = timerValues.getCurrentProcessingTimeInMs(), self.count.get()
        n = had = count[0] if count else 1
        asked: dict[int, list] = {}
        for (user, kind), e in first.items():
            name = str(user) if kind is None else f"{user}:{kind}"
            asked.setdefault(crc32(name.encode()) % n, []).append((name, e, user, kind))
        out, written = [], {}
        for page, keys in asked.items():
            held = self._page(page, now)
            fresh = [k for k in keys if k[0] not in held]
            if fresh:
                held.update((k[0], now + self.ttl) for k in fresh)
                written[page] = held
                out += [k[1:] for k in fresh]
        if any(len(held) > self.PAGE for held in written.values()):
            every = {k: t for page in range(had) for k, t in (written[page] if page in written else self._page(page, now)).items()}
            while n * self.PAGE < 2 * len(every):
                n *= 2
            written = {page: {} for page in range(n)}
            for k, t in every.items():
                written[crc32(k.encode()) % n][k] = t
        for page, held in written.items():
            self.pages.updateValue((page,), (json.dumps(held, separators=(",", ":")),))
        if written:
            self.count.update((n,))
            yield pd.DataFrame(out, columns=["event_id", "user_id", "event_type"]).astype({"event_id": "int64", "user_id": "Int64", "event_type": object})

    def close(self) -> None:
        pass


def first_seen(events: DataFrame, ttl_seconds: float, buckets: int = 1024) -> DataFrame:
    """The first event of each user and type within `ttl_seconds`. A checkpoint holds for one number of buckets; a bucket's rows of a batch are in memory at once."""
    keyed = events.select(_bucket(buckets, "user_id", "event_type"), F.coalesce("user_id", F.lit(0)).alias("user_id"), "event_type", "event_id").groupBy("bucket")
    return keyed.transformWithStateInPandas(Remembered(int(ttl_seconds * 1000)), "event_id long, user_id long, event_type string", "append", "ProcessingTime")
