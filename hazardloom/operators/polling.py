"""What polls of sources leave behind: states, blocks and what may be asked next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# For how many hours a source is left alone after a block.
COOLDOWN_HOURS = {"403": 24, "429": 6, "challenge": 24}
STATE = ("source", "last_fetch", "last_status", "last_note", "last_ok", "etag", "last_modified", "cooldown_until")


def block_reason(status: Column, challenge: Column) -> Column:
    """Why a poll was blocked, null where it was not: a challenge page, or one of the codes that forbid or slow down."""
    return F.when(challenge, "challenge").when(status.isin(403, 429), status.cast("string"))


def states_after(states: DataFrame, polls: DataFrame) -> DataFrame:
    """``STATE`` of all sources after ``polls`` (``source, at, status, note, ok, challenge, etag, last_modified``).

    A blocked poll only sets ``cooldown_until``. Any other is the last fetch, with its status and note; only one that is
    ``ok`` and has the status 200 also leaves its time as ``last_ok`` and its marks, so that a page that could not be
    read is asked for again. Polls count in order of time, a source's newest of each kind last. One aggregation.
    """
    hours = F.create_map(*[F.lit(x) for pair in COOLDOWN_HOURS.items() for x in pair])
    reason = block_reason(F.col("status"), F.coalesce("challenge", F.lit(False)))
    p = polls.withColumn("reason", reason)
    free, fine = F.col("reason").isNull(), F.col("reason").isNull() & F.col("ok") & (F.col("status") == 200)
    latest = lambda cols, when: F.max_by(F.struct(*cols), F.when(when, F.col("at")))
    after = p.groupBy("source").agg(
        latest(["at", "status", "note"], free).alias("f"), F.count_if(free).alias("n_free"),
        latest(["at", "etag", "last_modified"], fine).alias("g"), F.count_if(fine).alias("n_fine"),
        latest(["at", "reason"], ~free).alias("b"), F.count_if(~free).alias("n_blocked"),
    )
    until = F.col("b.at") + F.make_interval(hours=hours[F.col("b.reason")])
    taken = {"last_fetch": ("n_free", F.col("f.at")), "last_status": ("n_free", F.col("f.status")), "last_note": ("n_free", F.col("f.note")), "last_ok": ("n_fine", F.col("g.at")), "etag": ("n_fine", F.col("g.etag")), "last_modified": ("n_fine", F.col("g.last_modified")), "cooldown_until": ("n_blocked", until)}
    both = states.join(after, "source", "full_outer")
    return both.select("source", *[F.when(F.col(n) > 0, value).otherwise(states[c]).alias(c) for c, (n, value) in taken.items()])


def may_poll(states: DataFrame, now: Column, minutes: Column) -> DataFrame:
    """``source, cooling, due``: whether a source cools down, and whether its last fetch is ``minutes`` ago or never was."""
    cooling = F.coalesce(F.col("cooldown_until") > now, F.lit(False))
    due = F.col("last_fetch").isNull() | (F.col("last_fetch") + F.make_interval(mins=minutes) <= now)
    return states.select("source", cooling.alias("cooling"), due.alias("due"))
