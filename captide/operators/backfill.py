"""Membership from many snapshots at once, instead of run by run.

A member's snapshots form spells: runs of consecutive snapshots of its playlist that list
it.  Snapshots are numbered per playlist, so within a spell the number minus the member's
own row number stays the same (gaps and islands).  One pass gives every spell, and the
last spell of a member is what replaying all snapshots in order leaves in the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from captide.operators.merge import KEY, MEMBER_KEY

# Shares that the members of one snapshot are dealt to when they meet its number.
SHARES = 32


def numbered_snapshots(listed: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """``playlist_id, at, number, next_at`` per snapshot; ``snapshots`` adds ones that list nothing."""
    taken = listed.select("playlist_id", "at")
    if snapshots is not None:
        taken = taken.union(snapshots.select("playlist_id", "at"))
    in_order = W.partitionBy("playlist_id").orderBy("at")
    # Repeats combine before they are shuffled: the windows see one row per snapshot.
    return taken.distinct().select(
        "playlist_id", "at", F.row_number().over(in_order).alias("number"), F.lead("at").over(in_order).alias("next_at")
    )


def membership_spells(listed: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """Spells of ``playlist_id, video_id, at`` rows, ``at`` being the time of a whole snapshot.

    Returns ``playlist_id, video_id, first_seen_at, last_seen_at, removed_at``: the spell's
    first and last snapshot, and the snapshot that no longer lists the video, null if the
    playlist has none yet.  An id repeated in a snapshot counts once.

    A snapshot that holds much of all rows is dealt to ``SHARES`` parts when its rows
    meet its number; after that rows are grouped by member, which no snapshot repeats.
    """
    numbers = numbered_snapshots(listed, snapshots)
    share = F.pmod(F.hash(KEY), F.lit(SHARES)).alias("share")
    rows = listed.select(*MEMBER_KEY, "at").distinct().select("*", share)
    shares = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share")
    placed = rows.join(numbers.select("*", shares), ["playlist_id", "at", "share"])
    island = F.col("number") - F.row_number().over(W.partitionBy(*MEMBER_KEY).orderBy("number"))
    return (
        placed.withColumn("island", island)
        .groupBy(*MEMBER_KEY, "island")
        .agg(
            F.min("at").alias("first_seen_at"),
            F.max("at").alias("last_seen_at"),
            F.max_by("next_at", "number").alias("removed_at"),
        )
        .drop("island")
    )


def backfill_membership(listed: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """The membership table after all snapshots in order: one row per playlist and video.

    Equal to upserting and tombstoning run by run: first seen in the first spell, last
    seen in the last, removed if a later snapshot came without it.
    """
    last = F.max(F.struct("last_seen_at", "removed_at"))
    return (
        membership_spells(listed, snapshots)
        .groupBy(*MEMBER_KEY)
        .agg(F.min("first_seen_at").alias("first_seen_at"), last.alias("last"))
        .select(*MEMBER_KEY, "first_seen_at", "last.last_seen_at", "last.removed_at")
    )


def resumed_membership(
    membership: DataFrame, listed: DataFrame, snapshots: DataFrame | None = None
) -> DataFrame:
    """Stored members brought up to date by later snapshots of some playlists.

    A stored active member that the later snapshots never list is removed by the first of
    them; members of other playlists stay as they are.
    """
    first = numbered_snapshots(listed, snapshots).where("number = 1").select("playlist_id", F.col("at").alias("began"))
    new = backfill_membership(listed, snapshots).select(
        *MEMBER_KEY, *[F.col(c).alias(f"new_{c}") for c in ("first_seen_at", "last_seen_at", "removed_at")]
    )
    seen = F.col("new_last_seen_at").isNotNull()
    gone = ~seen & F.col("removed_at").isNull() & F.col("began").isNotNull()
    return (
        membership.join(new, MEMBER_KEY, "full_outer")
        .join(first, "playlist_id", "left")
        .select(
            *MEMBER_KEY,
            F.coalesce("first_seen_at", "new_first_seen_at").alias("first_seen_at"),
            F.coalesce("new_last_seen_at", "last_seen_at").alias("last_seen_at"),
            F.when(seen, F.col("new_removed_at"))
            .when(gone, F.col("began"))
            .otherwise(F.col("removed_at"))
            .alias("removed_at"),
        )
    )
