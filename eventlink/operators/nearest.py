"""Joins to the reference nearest in time, per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlink.functions.times import floor_div, micros, span
from eventlink.operators.slicing import Slicing, all_set, apart


def next_of(value: str, parts: list[str], order: list[str]) -> Column:
    """The next non-null value after the row; linear, unlike a frame to the end of the partition."""
    keys, by = (", ".join(f"`{c}`" for c in cols) for cols in (parts, order))
    return F.expr(f"lead({value}, 1) ignore nulls over (partition by {keys} order by {by})")


def reference_side(ref, on, payload, ref_order) -> DataFrame:
    """The reference, which has ``_t``, reduced to keys, order and one struct."""
    order = F.struct(*[F.col(c) for c in ref_order])
    return ref.where(all_set(*on, "_t")).select(
        *on,
        "_t",
        order.alias("_order"),
        F.struct(
            F.col("_t").alias("t"),
            order.alias("o"),
            *[F.col(c).alias(f"p{i}") for i, c in enumerate(payload.values())],
        ).alias("_ref"),
    )


def _sides(obs, ref, on, obs_time, ref_time, payload, ref_order, offset, obs_shift=0):
    """Both sides with ``_t``."""
    left = obs.withColumn("_t", micros(obs, obs_time) + obs_shift)
    ref = ref.withColumn("_t", micros(ref, ref_time) - span(offset))
    return left, reference_side(ref, on, payload, ref_order)


def together(left: DataFrame, right: DataFrame) -> DataFrame:
    """One table in which references come before observations of the same time."""
    return left.withColumn("_kind", F.lit(1)).unionByName(
        right.withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )


def _look_up(left: DataFrame, right: DataFrame, on, slicing: Slicing, first_of_time: bool) -> DataFrame:
    """Add ``_prev`` (last reference at or before the row) and ``_next`` (first one after it).

    Among references of one time, ``_prev`` is the last in order and ``_next`` the first; with
    ``first_of_time`` both are the first.  Rows of one key and time have the same answer, so it is looked
    up once for each distinct key and time and joined back: a crowded instant stays spread over the
    tasks.  Only the first and last reference of a key and time can win, so the others end before the
    shuffle.  No reference is copied: slices hand on their outermost ones.
    """
    left, rest = apart(left, on, "_t")
    refs = right.groupBy(*on, "_t").agg(
        F.min_by("_ref", "_order").alias("_first"), F.max_by("_ref", "_order").alias("_last")
    )
    if first_of_time:
        refs = refs.withColumn("_last", F.col("_first"))
    both = together(left.select(*on, "_t").distinct(), refs).withColumn("_slice", slicing.step("_t"))
    parts = [*on, "_slice"]
    by = W.partitionBy(*parts).orderBy("_t", "_kind")
    look = both.select(
        *parts,
        "_t",
        "_kind",
        F.last("_last", ignorenulls=True)
        .over(by.rowsBetween(W.unboundedPreceding, W.currentRow))
        .alias("_prev"),
        next_of("_first", parts, ["_t", "_kind"]).alias("_next"),
    ).where("_kind = 1")

    edges = both.groupBy(*parts).agg(
        F.min_by("_first", F.when(F.col("_kind") == 0, F.col("_t"))).alias("_head"),
        F.max_by("_last", F.when(F.col("_kind") == 0, F.col("_t"))).alias("_tail"),
    )
    per = W.partitionBy(*on).orderBy("_slice")
    edges = edges.select(
        *parts,
        F.last("_tail", ignorenulls=True)
        .over(per.rowsBetween(W.unboundedPreceding, -1))
        .alias("_before"),
        next_of("_head", on, ["_slice"]).alias("_after"),
    )
    look = look.join(edges, parts, "left").select(
        *on,
        "_t",
        F.coalesce("_prev", "_before").alias("_prev"),
        F.coalesce("_next", "_after").alias("_next"),
    )
    return left.join(look, [*on, "_t"], "left").unionByName(rest, allowMissingColumns=True)


def closer(tie: str) -> Column:
    """True where the previous reference is taken rather than the next one."""
    d1 = F.col("_t") - F.col("_prev.t")
    d2 = F.col("_next.t") - F.col("_t")
    win = {
        "later": d1 < d2,
        "earlier": d1 <= d2,
        "first": (d1 < d2) | ((d1 == d2) & (F.col("_prev.o") < F.col("_next.o"))),
    }[tie]
    return F.col("_next").isNull() | win


def as_map(payload) -> dict[str, str]:
    return dict(payload) if isinstance(payload, dict) else {c: c for c in payload}


def nearest_join(
    obs: DataFrame,
    ref: DataFrame,
    on: list[str],
    bound,
    payload,
    obs_time: str = "ts",
    ref_time: str = "ts",
    ref_order: list[str] = ("row_id",),
    offset=0,
    tie: str = "later",
    how: str = "left",
    slicing: Slicing = Slicing(),
    distance: str | None = "distance",
    limit: str | None = None,
) -> DataFrame:
    """Give each observation the reference of its key that is nearest in time.

    A reference matches if its distance is less than ``bound`` seconds.  ``offset`` is how many seconds
    the reference clock is ahead.  At equal distance ``tie`` takes the ``later`` or ``earlier``
    reference, or the ``first`` in ``ref_order``.  ``payload`` lists reference columns to take, or
    maps new names to them; unmatched rows have nulls (``how="left"``) or are dropped (``"inner"``).
    ``distance`` names a column with the distance in microseconds.  ``limit`` names an observation
    column: references after the observation must also (offset applied) be before that time.

    Key and time slice together are the shuffle key of the lookup, so a heavy key is spread over many
    tasks whatever the bound is.
    """
    on, payload, reach = list(on), as_map(payload), span(bound)
    left, right = _sides(obs, ref, on, obs_time, ref_time, payload, list(ref_order), offset)
    both = _look_up(left, right, on, slicing, tie == "first")
    if limit is not None:
        until = micros(both, limit)
        allowed = until.isNull() | (F.col("_next.t") < until)
        both = both.withColumn("_next", F.when(allowed, F.col("_next")))
    both = both.withColumn("_hit", F.when(closer(tie), F.col("_prev")).otherwise(F.col("_next")))
    return _finish(both, obs.columns, payload, reach, how, distance, all_set(*on, "_t"))


def _finish(both, columns, payload, reach, how, distance, usable) -> DataFrame:
    d = F.abs(F.col("_hit.t") - F.col("_t"))
    ok = F.coalesce(usable & (d < reach), F.lit(False))
    both = both.withColumn("_ok", ok)
    if how == "inner":
        both = both.where("_ok")
    taken = set(payload) | ({distance} if distance else set())
    cols = [F.col(c) for c in columns if c not in taken]
    cols += [
        F.when(F.col("_ok"), F.col(f"_hit.p{i}")).alias(name) for i, name in enumerate(payload)
    ]
    if distance:
        cols.append(F.when(F.col("_ok"), d).alias(distance))
    return both.select(*cols)


def prev_next(
    obs: DataFrame,
    ref: DataFrame,
    on: list[str],
    payload,
    obs_time: str = "ts",
    ref_time: str = "ts",
    ref_order: list[str] = ("row_id",),
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """The last reference at or before each observation and the first after it, however far.

    Payload columns come twice, with the prefixes ``prev_`` and ``next_``.
    """
    on, payload = list(on), as_map(payload)
    left, right = _sides(obs, ref, on, obs_time, ref_time, payload, list(ref_order), 0)
    both = _look_up(left, right, on, slicing, False)
    # Rows without key or time have no neighbours.
    usable = all_set(*on, "_t")
    cols = [F.col(c) for c in obs.columns]
    for side in ("prev", "next"):
        cols += [
            F.when(usable, F.col(f"_{side}.p{i}")).alias(f"{side}_{name}")
            for i, name in enumerate(payload)
        ]
    return both.select(*cols)


def last_within(
    obs: DataFrame,
    ref: DataFrame,
    on: list[str],
    window,
    payload,
    obs_time: str = "ts",
    ref_time: str = "ts",
    ref_order: list[str] = ("row_id",),
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """The latest reference less than ``window`` seconds before or after each observation."""
    on, payload, w = list(on), as_map(payload), span(window)
    # Seen from the end of the observation's window, it is the nearest one backwards.
    reach = 2 * w - 1
    left, right = _sides(
        obs, ref, on, obs_time, ref_time, payload, list(ref_order), 0, obs_shift=w - 1
    )
    both = _look_up(left, right, on, slicing, False)
    both = both.withColumn("_hit", F.col("_prev"))
    return _finish(both, obs.columns, payload, reach, "left", None, all_set(*on, "_t"))


def last_listed(
    obs: DataFrame,
    ref: DataFrame,
    on: list[str],
    window,
    payload,
    obs_time: str = "ts",
    ref_time: str = "ts",
    ref_order: list[str] = ("row_id",),
) -> DataFrame:
    """Of the references less than ``window`` seconds before or after each observation the last in ``ref_order``.

    A maximum over a sliding window, without going through the window for each row: time is cut into blocks as long
    as the window, so a window is the end of one block and the start of the next.  Running maxima from a block's start
    and from its end, looked up at the window's two ends, give the maximum of all of it.  Observations of one key and
    time share their look-ups, and references of one key and time end as the last of them before the shuffle.  A
    block of a key is one task's work; it holds no more rows than it has distinct times.
    """
    on, payload, w = list(on), as_map(payload), span(window)
    width = 2 * w - 1
    left, right = _sides(obs, ref, on, obs_time, ref_time, payload, list(ref_order), 0)
    left, rest = apart(left, on, "_t")
    listed = F.max_by("_ref", "_ref.o")
    refs = right.groupBy(*on, "_t").agg(listed.alias("_ref"))
    refs = refs.withColumns({"_of": F.lit(None).cast("long"), "_end": F.lit(0)})
    times = left.select(*on, F.col("_t").alias("_of")).distinct()
    ends = F.array(
        F.struct((F.col("_of") - (w - 1)).alias("_t"), F.lit(-1).alias("_end")),
        F.struct((F.col("_of") + (w - 1)).alias("_t"), F.lit(1).alias("_end")),
    )
    asked = times.select(*on, "_of", F.inline(ends))
    both = refs.unionByName(asked, allowMissingColumns=True).withColumn("_block", floor_div(F.col("_t"), width))
    # The window's first end asks for what comes from its time on, the other one for what comes up to its time.
    by = W.partitionBy(*on, "_block").orderBy("_t", "_end")
    upto = listed.over(by.rowsBetween(W.unboundedPreceding, W.currentRow))
    back = W.partitionBy(*on, "_block").orderBy(F.desc("_t"), F.desc("_end"))
    since = listed.over(back.rowsBetween(W.unboundedPreceding, W.currentRow))
    found = both.select(*on, "_of", "_end", upto.alias("_upto"), since.alias("_since")).where("_of is not null")
    value = F.when(F.col("_end") == 1, F.col("_upto")).otherwise(F.col("_since"))
    found = found.groupBy(*on, F.col("_of").alias("_t")).agg(F.max_by(value, value["o"]).alias("_hit"))
    both = left.join(found, [*on, "_t"], "left").unionByName(rest, allowMissingColumns=True)
    return _finish(both, obs.columns, payload, w, "left", None, all_set(*on, "_t"))


def keep_or_fill(df: DataFrame, own: str, found: str) -> DataFrame:
    """A match overwrites the row's own id; without one the row keeps it."""
    return df.withColumn(own, F.coalesce(F.col(found), F.col(own))).drop(found)
