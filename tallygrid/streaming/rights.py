"""Retention and deletion of a stream of reports, as state.

Each report is known by the hash of its id. It is told as kept when it comes, as deleted when its contributor deletes it, and
as expired when the watermark passes its time; the watermark runs behind the newest report by the days of retention, so
that Spark drops as late what retention would remove at once. What is told last of a report holds. So the fold of all
that was told equals the batch purge of all that came, less what was deleted, at any point of the stream.

Reports are dealt by their hash into a fixed number of groups, and a group is one entry of the state, with its reports packed:
so there are as many calls and timers as groups, however many reports come.
"""

from __future__ import annotations

import sys
from collections import namedtuple
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import text as X
from ..shipping import carry
from . import dedupe
from .dedupe import STATE_STORE, pack, unpack

#: What is known of one report: its second, whether it was deleted, how often it was told of, and until when that is kept.
Life = namedtuple("Life", "hash epoch deleted seq until")
#: Groups that reports are dealt into.
GROUPS = 8192

TOLD = "hash string, seq long, epoch long, status string"


class Lives(StatefulProcessor):
    """The lives of the reports of one group.

    A lifetime runs by event time, so a replay forgets at the same points. A deletion that comes before its report is kept until
    the watermark has passed the deletion: a report from before that is then too late to come.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("lives", "least long, packed binary")

    def _held(self) -> tuple[int | None, dict]:
        if not self._state.exists():
            return None, {}
        least, packed = self._state.get()
        return least, {r.hash: r for r in unpack(packed, Life)}

    def _keep(self, before: int | None, lives: dict) -> None:
        """Store the lives; the group's one timer goes off when the first of them is over."""
        least = min((r.until for r in lives.values()), default=None)
        if least is None:
            self._state.clear()
        else:
            self._state.update((least, pack(list(lives.values()))))
        if before is not None and before != least:
            self._handle.deleteTimer(before + 1)
        if least is not None and before != least:
            self._handle.registerTimer(least + 1)

    @staticmethod
    def _told(told: list[tuple]) -> Iterator[pd.DataFrame]:
        if told:
            out = pd.DataFrame(told, columns=["hash", "seq", "epoch", "status"])
            yield out.astype({"epoch": "Int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        least, lives = self._held()
        came = []
        for part in rows:
            epochs = [None if pd.isna(e) else int(e) for e in part["epoch"]]
            came.extend(zip(part["ms"].tolist(), part["deletion"].tolist(), part["hash"].tolist(), epochs))
        told = []
        for ms, deletion, name, second in sorted(came, key=lambda r: r[:2]):
            _, epoch, deleted, seq, until = lives.get(name) or (name, None, False, 0, 0)
            if deletion:
                if epoch is not None and not deleted:
                    seq += 1
                    told.append((name, seq, epoch, "deleted"))
                deleted = True
                until = until if epoch is not None else max(until, ms)
            elif epoch is None:
                epoch, until = second, ms
                if not deleted:
                    seq += 1
                    told.append((name, seq, epoch, "kept"))
            lives[name] = Life(name, epoch, deleted, seq, until)
        self._keep(least, lives)
        yield from self._told(told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        least, lives = self._held()
        now = timerValues.getCurrentWatermarkInMs()
        if least is None or least >= now:
            return
        over = [r for r in lives.values() if r.until < now]
        # The timer that went off is gone already.
        fired = least if expiredTimerInfo.getExpiryTimeInMs() != least + 1 else None
        self._keep(fired, {r.hash: r for r in lives.values() if r.until >= now})
        yield from self._told([(r.hash, r.seq + 1, r.epoch, "expired") for r in over if r.epoch is not None and not r.deleted])

    def close(self) -> None:
        pass


def report_lives(reports: DataFrame, deletions: DataFrame, days: int, groups: int = GROUPS) -> DataFrame:
    """Streams of reports (report_id, ts, epoch) and deletions (report_id, ts) to what is to be told: hash, seq, epoch, status.

    status is kept, deleted or expired, seq counts what was told of a report. A report that comes again is told once; one that
    was deleted before is not told. Reports without ts have no known age and are left out; take them as they are, less the deleted.
    The number of groups is fixed for the life of a stream's state.
    """
    if days <= 0:
        raise ValueError("retention of no days keeps all reports for ever; it needs no state")
    ms = F.unix_millis("ts").alias("ms")
    came = reports.where("ts is not null").select("ts", X.tombstone_key(F.col("report_id")).alias("hash"), F.col("epoch").cast("long").alias("epoch"), F.lit(False).alias("deletion"), ms)
    went = deletions.where("ts is not null").select("ts", X.tombstone_key(F.col("report_id")).alias("hash"), F.lit(None).cast("long").alias("epoch"), F.lit(True).alias("deletion"), ms)
    rows = came.unionByName(went).withWatermark("ts", f"{days} days").withColumn("part", F.pmod(F.xxhash64("hash"), F.lit(groups)))
    reports.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    carry(sys.modules[__name__], dedupe)
    return rows.groupBy("part").transformWithStateInPandas(Lives(), TOLD, "append", "eventTime")


def standing(told: DataFrame) -> DataFrame:
    """(hash, epoch) of the reports of which kept was told last."""
    last = told.groupBy("hash").agg(F.max_by("status", "seq").alias("status"), F.max_by("epoch", "seq").alias("epoch"))
    return last.where("status = 'kept'").select("hash", "epoch")
