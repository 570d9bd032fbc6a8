"""Claims on work that lapse: who may work on a key, without lock files.

A claim wins its key if nobody holds it; who wins holds it for the time of a lease.  The
state of a key is the end of its lease, kept by the stream, so it outlives any worker, and a
restart neither gives a held key away nor keeps one that has lapsed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

GRANTED = "key long, claim long, at long, until long"


def granted(claims: DataFrame, lease: int) -> DataFrame:
    """``GRANTED`` of a stream of claims (key, claim, at; microseconds).

    Claims of a batch are taken by time, then by number.  A claim that comes in a later
    batch than a later claim of its key is judged by the state it finds.
    """

    def judge(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["at", "claim"])
        until = state.get[0] if state.exists else None
        won = []
        for claim, at in zip(rows["claim"].tolist(), rows["at"].tolist(), strict=True):
            if until is None or at >= until:
                until = at + lease
                won.append((key[0], claim, at, until))
        state.update((until,))
        yield pd.DataFrame(won, columns=["key", "claim", "at", "until"]).astype("int64")

    return claims.groupBy("key").applyInPandasWithState(judge, GRANTED, "until long", "append", GroupStateTimeout.NoTimeout)


def holders(grants: DataFrame) -> DataFrame:
    """Who holds each key last: ``key``, ``claim``, ``until``."""
    return grants.groupBy("key").agg(F.max_by(F.struct("claim", "until"), F.struct("at", "claim")).alias("g")).select("key", "g.claim", "g.until")
