"""Keyed state of the streams: bans per user, click rings per ad.

Each processor keeps the state of one key in the state store (RocksDB, changelog
checkpoints), so a micro-batch reads and writes the keys of its own clicks, whatever the
day or the stream has seen before. State and source offsets are committed together: after a
restart counting goes on exactly where the checkpoint left it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class BanProcessor(StatefulProcessor):
    """J4 for one user: counts per (day, ad), and the ban.

    Clicks of a batch are taken in the order of ``order`` (time, then tie-break). The click that
    takes a count above ``threshold`` is the last that passes, with ``bans`` set; from then on
    the user's clicks are dropped unread. Memory: the user's clicks of one micro-batch, until
    the ban. ``ttl_ms`` (if given) forgets counts that got no click for so long; bans stay.
    """

    def __init__(self, threshold: int, columns: list[str], order: list[str], ttl_ms: int | None) -> None:
        self.threshold, self.columns, self.order, self.ttl_ms = threshold, columns, order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.banned = handle.getValueState("banned", "banned BOOLEAN")
        self.counts = handle.getMapState("counts", "day STRING, adid STRING", "clicks BIGINT", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.banned.exists():
            return
        out = Row(*self.columns, "bans")
        counts: dict[tuple[str, str], int] = {}
        for click in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            group = (click["day"], click["adid"])
            if group not in counts:
                counts[group] = self.counts.getValue(group)[0] if self.counts.containsKey(group) else 0
            counts[group] += 1
            bans = counts[group] > self.threshold
            yield out(*[click[c] for c in self.columns], bans)
            if bans:
                self.banned.update((True,))
                self.counts.clear()  # a ban is for good: nobody asks for its counts again
                return
        for group, n in counts.items():
            self.counts.updateValue(group, (n,))

    def close(self) -> None:
        pass


class TrendProcessor(StatefulProcessor):
    """J7 for one ad: a ring of click counts per slot, from which the windows that a batch
    touches are rebuilt.

    Input rows are (adid, slot_ms, bucket_ms, clicks): clicks of a time bucket in a slot of the
    window time. Output rows are (adid, window_start_ms, bucket_ms, clicks, closed): every
    bucket of every window that a slot of the batch lies in. A batch reads the slots of these
    windows and no others.

    ``idle_ms`` None: windows by event time. Any slot may still get clicks; ``ttl_ms`` (if given)
    drops slots that got none for so long. Else windows by arrival: stamps only rise, so windows
    that end by the newest slot are closed, slots that only they hold leave the ring, and a
    processing-time timer ``idle_ms`` after the last click closes the others, with no new input.
    """

    def __init__(self, window_ms: int, slide_ms: int, slot_ms: int, ttl_ms: int | None, idle_ms: int | None) -> None:
        self.window_ms, self.slide_ms, self.slot_ms = window_ms, slide_ms, slot_ms
        self.ttl_ms, self.idle_ms = ttl_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "slot_ms BIGINT", "buckets ARRAY<BIGINT>, clicks ARRAY<BIGINT>", self.ttl_ms)
        self.open_from = handle.getValueState("open_from", "window_start_ms BIGINT")

    def _starts(self, slot: int) -> list[int]:
        """Starts of the windows that hold a slot, ascending."""
        last = slot - slot % self.slide_ms
        first = last - (self.window_ms - 1) // self.slide_ms * self.slide_ms
        return [s for s in range(first, last + 1, self.slide_ms) if s + self.window_ms > slot]

    def _slot(self, slot: int) -> Counter:
        if not self.slots.containsKey((slot,)):
            return Counter()
        buckets, clicks = self.slots.getValue((slot,))
        return Counter(dict(zip(buckets, clicks)))

    def _windows(self, key, starts: set[int], known: dict[int, Counter], newest: int | None) -> Iterator[Row]:
        out = Row("adid", "window_start_ms", "bucket_ms", "clicks", "closed")
        for start in sorted(starts):
            total: Counter = Counter()
            for slot in range(start, start + self.window_ms, self.slot_ms):
                if slot not in known:
                    known[slot] = self._slot(slot)
                total += known[slot]
            for bucket, n in sorted(total.items()):
                yield out(key[0], start, bucket, n, newest is not None and start + self.window_ms <= newest)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known: dict[int, Counter] = {}
        for r in rows:
            known.setdefault(r["slot_ms"], Counter())[r["bucket_ms"]] += r["clicks"]
        if self.idle_ms is not None:
            open_from = self.open_from.get()[0] if self.open_from.exists() else None
            # A stamp behind a closed window cannot open it again.
            known = {s: n for s, n in known.items() if open_from is None or self._starts(s)[-1] >= open_from}
        for slot, n in known.items():
            n += self._slot(slot)
            self.slots.updateValue((slot,), (list(n), list(n.values())))
        if self.idle_ms is None:
            yield from self._windows(key, {s for slot in known for s in self._starts(slot)}, known, None)
            return
        held = sorted(slot for (slot,) in self.slots.keys())
        if not held:
            return
        starts = {s for slot in held for s in self._starts(slot) if open_from is None or s >= open_from}
        yield from self._windows(key, starts, known, held[-1])
        # The first window that a slot from here on can lie in.
        first = self._starts(held[-1])[0]
        self.open_from.update((max(first, open_from) if open_from is not None else first,))
        for slot in held:
            if slot < first:
                self.slots.removeKey((slot,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = [slot for (slot,) in self.slots.keys()]
        if not held:
            return
        open_from = self.open_from.get()[0]
        starts = {s for slot in held for s in self._starts(slot) if s >= open_from}
        yield from self._windows(key, starts, {}, max(held) + self.window_ms + self.slide_ms)
        self.open_from.update((max(starts, default=open_from) + self.slide_ms,))
        self.slots.clear()

    def close(self) -> None:
        pass
