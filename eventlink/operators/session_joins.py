"""Joins to the reference nearest in time, per session, in one pass.

Observations and references are one table, dealt out by ranges of key and time and written once.  Within range and key a
sort is enough for everything: sessions, the references around each observation, the start of the next session,
and each session's best match.  What crosses the ends of ranges is a small table of the keys that do (see
``ranges``), worked out from those keys' rows alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlink.functions.times import micros, span
from eventlink.operators.nearest import as_map, last_listed, last_within, next_of, reference_side, together
from eventlink.operators.ranges import PART, of_spanning_keys, ranged
from eventlink.operators.sessions import CARRY, INNER, Rules, limit_of
from eventlink.operators.slicing import all_set
from eventlink.sources.folders import stored


@dataclass(frozen=True)
class Linking:
    """What the session joins have in common; the fields are their keyword arguments.

    ``gap``, ``cap`` and ``inclusive`` are those of ``sessionize``, the others those of
    ``nearest_join``.
    """

    on: list[str]
    payload: dict[str, str]
    gap: float = 30
    cap: int | None = 150
    inclusive: bool = True
    obs_time: str = "ts"
    ref_time: str = "ts"
    order: list[str] = ("row_id",)
    ref_order: list[str] = ("row_id",)
    offset: float = 0

    def rules(self) -> Rules:
        return Rules(limit_of(self.gap, self.inclusive), self.cap)

    def search(self) -> dict:
        return dict(on=list(self.on), ref_time=self.ref_time, ref_order=self.ref_order)


def session_nearest_start(
    obs: DataFrame, ref: DataFrame, on, bound, payload, how="left", before_next=True, **options
) -> DataFrame:
    """Give each session the reference nearest to its start (at equal distance the earlier).

    With ``before_next`` references after the start must be before the next session of the key.
    """
    link, reach = Linking(on, as_map(payload), **options), span(bound)

    def match(rows):
        allowed = F.col("_next_head").isNull() | (F.col("_next.t") < F.col("_next_head"))
        after = F.when(allowed, F.col("_next")) if before_next else F.col("_next")
        return F.when(F.col("session_pos") == 1, _nearer(after, reach, link))

    return _linked(obs, ref, link, match, F.min_by, how, distance=True)


def session_nearest_dedup(
    obs: DataFrame, ref: DataFrame, on, bound, payload, ref_time="ts", ref_order=("row_id",), **options
) -> DataFrame:
    """As :func:`session_nearest_start` without the next-session limit, and of several references
    with the same time only the last in order counts."""
    one = latest_per_time(ref, list(on), ref_time, list(ref_order))
    options.update(ref_time=ref_time, ref_order=ref_order, before_next=False)
    return session_nearest_start(obs, one, on, bound, payload, **options)


def latest_per_time(ref: DataFrame, on: list[str], time: str, order: list[str]) -> DataFrame:
    """One reference per key and time: the last in order.  Aggregates before the shuffle."""
    last = F.max_by(F.struct("*"), F.struct(*order)).alias("_row")
    return ref.groupBy(*on, time).agg(last).select("_row.*")


def session_nearest_pair(
    obs: DataFrame, ref: DataFrame, on, bound, payload, how="left", **options
) -> DataFrame:
    """Give each session the reference of its closest pair of row and reference.

    Equal pairs: the earlier row, then the earlier reference.
    """
    link, reach = Linking(on, as_map(payload), **options), span(bound)
    return _linked(obs, ref, link, lambda rows: _nearer(F.col("_next"), reach, link), F.min_by, how, distance=True)


def segment_last_in_window(
    obs: DataFrame,
    ref: DataFrame,
    on,
    window,
    payload,
    how="left",
    gap=10.025,
    cap=None,
    inclusive=False,
    latest="listed",
    **options,
) -> DataFrame:
    """Give each segment a reference within the window of its last row that has one: of several the last.

    The last is that which comes last in ``ref_order``, the order the references were listed in, whatever their times
    (``latest="listed"``), or the latest in time (``"time"``).  References whose payload's first column, the id, is
    null never match.
    """
    link = Linking(on, as_map(payload), gap, cap, inclusive, **options)
    find = {"listed": last_listed, "time": last_within}[latest]
    named = ref.where(F.col(next(iter(link.payload.values()))).isNotNull())
    fields = {f"_p{i}": c for i, c in enumerate(link.payload.values())}
    near = find(obs, named, window=window, payload={**fields, "_found": on[0]}, obs_time=link.obs_time, **link.search())

    def match(rows):
        values = [F.col(f"_p{i}").alias(f"p{i}") for i in range(len(fields))]
        rank = F.struct("_t", *link.order).alias("rank")
        return F.when(F.col("_found").isNotNull(), F.struct(rank, *values))

    return _linked(near, None, link, match, F.max_by, how, columns=obs.columns)


def _nearer(after: Column, reach: int, link: Linking) -> Column:
    """Rank (distance, row's place) and payload of the nearer of ``_prev`` and ``after`` if it is within reach; else null."""
    d1, d2 = F.col("_t") - F.col("_prev.t"), after["t"] - F.col("_t")
    back = F.coalesce(after.isNull() | (d1 <= d2), F.lit(False))

    def pick(d, side):
        rank = F.struct(d.alias("d"), "_t", *link.order).alias("rank")
        return F.struct(rank, *[side[f"p{i}"].alias(f"p{i}") for i in range(len(link.payload))])

    return F.when(back & (d1 < reach), pick(d1, F.col("_prev"))).when(~back & (d2 < reach), pick(d2, after))


def _linked(
    obs: DataFrame,
    ref: DataFrame | None,
    link: Linking,
    match: Callable[[DataFrame], Column],
    best: Callable[[Column, Column], Column],
    how: str,
    distance: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """Sessions of ``obs``, and for all rows of a session its ``best`` (``min_by`` or ``max_by`` of rank) value of ``match``.

    ``match`` sees each row with ``session_seq``, ``session_pos``, ``_prev`` and ``_next`` (the references around it) and
    ``_next_head`` (start of the key's next session).  Rows without key or time stay, without a session.
    """
    on, order, rules = list(link.on), list(link.order), link.rules()
    columns = columns or obs.columns
    both = obs.withColumn("_t", micros(obs, link.obs_time))
    both = both.withColumn("_own", all_set(*on, "_t"))
    sort = ["_t", *order]
    if ref is not None:
        ref = ref.withColumn("_t", micros(ref, link.ref_time) - span(link.offset))
        refs = reference_side(ref, on, link.payload, list(link.ref_order)).withColumn("_own", F.lit(False))
        both = together(both, refs)
        sort = ["_t", "_kind", *order, "_order"]
    rows = stored(ranged(both, [*on, *sort]), "ranged")

    carry = stored(_carry(rows, on, sort, rules, ref is not None), "carry")
    all_rows = _matched(rows, carry, on, sort, rules, match, best, ref is not None)
    # sessions that reach over the end of a range, from the rows of their keys alone
    several = rows.join(F.broadcast(carry.select(*on)), on, "left_semi")
    several = _matched(several, carry, on, sort, rules, match, best, ref is not None)
    several = several.where("session_seq is not null").groupBy(*on, "session_seq").agg(
        best(F.col("_best"), F.col("_best.rank")).alias("_over"), F.min(PART).alias("_from"), F.max(PART).alias("_to")
    )
    several = several.where("_from < _to").select(*on, "session_seq", "_over")
    out = all_rows.join(F.broadcast(several), [*on, "session_seq"], "left")
    out = out.withColumn("_best", F.coalesce("_over", "_best"))

    taken = {name: F.col(f"_best.p{i}") for i, name in enumerate(link.payload)}
    if distance:
        taken["distance"] = F.col("_best.rank.d")
    kept = [F.col(c) for c in columns if c not in taken]
    out = out.select(
        *kept,
        "session_seq",
        "session_pos",
        *[c.alias(name) for name, c in taken.items()],
        F.col("_best").isNotNull().alias("session_matched"),
    )
    return out.where("session_matched") if how == "inner" else out


def _carry(rows, on, sort, rules, with_refs) -> DataFrame:
    """One row for each range that a spanning key is in: its open session, and the references and session starts that
    the ranges before and after hold."""
    spanning = rules.inside(of_spanning_keys(rows, on), on, sort)
    open_ = rules.carried(spanning, on)
    if not with_refs:
        return open_
    numbered = rules.numbered(spanning.join(F.broadcast(open_), [PART, *on], "left"))
    is_ref = F.col("_kind") == 0
    place = F.when(is_ref, F.struct("_t", "_order"))
    ends = numbered.groupBy(PART, *on).agg(
        F.min_by("_ref", place).alias("_first_ref"),
        F.max_by("_ref", place).alias("_last_ref"),
        F.min(F.when(F.col("session_pos") == 1, F.col("_t"))).alias("_first_head"),
    )
    before = W.partitionBy(*on).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(
        PART,
        *on,
        F.last("_last_ref", ignorenulls=True).over(before).alias("_before"),
        next_of("_first_ref", on, [PART]).alias("_after"),
        next_of("_first_head", on, [PART]).alias("_later_head"),
    )
    return ends.join(open_, [PART, *on], "left")


def _matched(rows, carry, on, sort, rules, match, best, with_refs) -> DataFrame:
    """The observations of ``rows`` with their session and ``_best``, the best match of the session within the range."""
    rows = rules.numbered(rules.inside(rows, on, sort).join(F.broadcast(carry), [PART, *on], "left"))
    if with_refs:
        by = W.partitionBy(PART, *on).orderBy(*sort)
        so_far = by.rowsBetween(W.unboundedPreceding, W.currentRow)
        rows = rows.withColumn("_head", F.when(F.col("session_pos") == 1, F.col("_t")))
        around = {
            "_prev": F.coalesce(F.last("_ref", ignorenulls=True).over(so_far), "_before"),
            "_next": F.coalesce(next_of("_ref", [PART, *on], sort), "_after"),
            "_next_head": F.coalesce(next_of("_head", [PART, *on], sort), "_later_head"),
        }
        rows = rows.withColumns(around).where("_kind = 1")
    rows = rows.withColumn("_match", F.when(F.col("_own"), match(rows)))
    whole = W.partitionBy(PART, *on, "session_seq")
    rows = rows.withColumn("_best", best(F.col("_match"), F.col("_match.rank")).over(whole))
    return rows.drop("_match", *CARRY, *INNER)
