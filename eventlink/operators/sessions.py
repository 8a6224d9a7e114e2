"""Sessions by gap and size, and row numbers, over keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlink.functions.times import floor_div, micros, span
from eventlink.operators.ranges import PART, of_spanning_keys, ranged
from eventlink.operators.slicing import all_set
from eventlink.sources.folders import stored

# Sessions of one key that are ordered together to find each one's successor.
SESSION_BLOCK = 1_000_000
# Rows of one key that a task numbers by itself, and the hash buckets that keys are counted in.
KEY_ROWS, KEY_BUCKETS = 1_000_000, 1 << 16


def sessionize(
    df: DataFrame,
    on: list[str],
    time: str = "ts",
    order: list[str] = ("row_id",),
    gap=30,
    cap: int | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Number the sessions of each key.

    A row joins the session of the row before it while the time between them is at most ``gap``
    seconds (less than, if not ``inclusive``) and the session has fewer than ``cap`` rows.  Adds
    ``session_seq`` (1, 2, … per key) and ``session_pos`` (1, 2, … per session).  Rows without a key
    or time stay, with both null.  ``order`` settles equal times and must make rows distinct.

    The rows, dealt out by ranges and numbered within them, become a table of the scratch folder; what is
    returned adds to it what is carried from range to range.
    """
    on, order = list(on), list(order)
    rules = Rules(limit_of(gap, inclusive), cap)
    rows = df.withColumn("_t", micros(df, time)).withColumn("_own", all_set(*on, "_t"))
    rows = ranged(rows, [*on, "_t", *order])
    rows = stored(rules.inside(rows, on, ["_t", *order]), "sessions")
    carry = rules.carried(of_spanning_keys(rows, on), on)
    rows = rules.numbered(rows.join(F.broadcast(carry), [PART, *on], "left"))
    return rows.drop(PART, "_t", "_own", *CARRY, *INNER)


def number_rows(
    df: DataFrame, on: list[str], time: str = "ts", order: list[str] = ("row_id",), name: str = "pos"
) -> DataFrame:
    """Position (1, 2, …) of each row within its key, by time.

    This is the time-sorted list of a key, kept as rows: a key's list need not fit in one record.  Rows are counted
    by a hash of their key.  Where a hash has up to ``KEY_ROWS`` rows, one shuffle brings its keys together; the rows of
    the others, among them those of every key with more, are dealt out by ranges as in :func:`sessionize`.  The numbers
    are the same either way.  Rows without a key or time stay, without a number.
    """
    on, order = list(on), list(order)
    own = all_set(*on, "_t")
    hashed = lambda cols: F.pmod(F.xxhash64(*cols), F.lit(KEY_BUCKETS)).cast("int")
    # rows without a number are spread over negative buckets
    bucket = F.when(own, hashed(on)).otherwise(-1 - hashed(order))
    rows = df.withColumn("_t", micros(df, time)).withColumn("_bucket", bucket)
    large = rows.where("_bucket >= 0").groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    large = F.broadcast(stored(large.where(F.col("_n") > KEY_ROWS).select("_bucket"), "large-keys"))
    at = F.row_number().over(W.partitionBy(*on, "_bucket").orderBy("_t", *order))
    at = F.when(F.col("_bucket") >= 0, at.cast("long")).alias(name)
    small = rows.join(large, "_bucket", "left_anti").select(*df.columns, at)
    dealt = rows.join(large, "_bucket", "left_semi").select(*df.columns)
    dealt = sessionize(dealt, on, time, order, gap=None).select(*df.columns, F.col("session_pos").alias(name))
    return small.unionByName(dealt)


def limit_of(gap, inclusive: bool) -> int | None:
    """The longest time in microseconds between two rows of a session."""
    if gap is None:
        return None
    return span(gap) if inclusive else span(gap) - 1


INNER = ["_break", "_rn", "_run", "_pos", "_heads", "_inner"]
CARRY = ["_carry", "_lead_heads", "_seq0"]


class Rules:
    """When a session ends: after a longer time than ``limit`` microseconds, and after ``cap`` rows (None: never)."""

    def __init__(self, limit: int | None, cap: int | None):
        self.limit, self.cap = limit, cap

    def inside(self, rows: DataFrame, on: list[str], sort: list[str]) -> DataFrame:
        """Runs, positions and session heads of the ``_own`` rows within range and key.

        Run 0 is the leading run: it may continue a session of an earlier range.
        """
        by = W.partitionBy(PART, *on).orderBy(*sort)
        so_far = by.rowsBetween(W.unboundedPreceding, W.currentRow)
        own = F.col("_own")
        breaks = F.lit(False)
        if self.limit is not None:
            before = F.last(F.when(own, F.col("_t")), ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, -1))
            breaks = own & F.coalesce(F.col("_t") - before > self.limit, F.lit(False))
        rows = rows.withColumns({"_break": breaks, "_rn": F.count_if(own).over(so_far)})
        begin = F.coalesce(F.max(F.when(F.col("_break"), F.col("_rn"))).over(so_far), F.lit(1))
        rows = rows.withColumns({"_run": F.count_if("_break").over(so_far), "_begin": begin})
        rows = rows.withColumn("_pos", F.col("_rn") - F.col("_begin") + 1).drop("_begin")
        if self.cap is None:
            return rows.withColumns({"_heads": F.col("_run") + 1, "_inner": F.col("_run")})
        head = own & (F.pmod(F.col("_pos") - 1, F.lit(self.cap)) == 0)
        return rows.withColumns(
            {
                "_heads": F.count_if(head).over(so_far),
                "_inner": F.count_if(head & (F.col("_run") > 0)).over(so_far),
            }
        )

    def carried(self, rows: DataFrame, on: list[str]) -> DataFrame:
        """For each range that a key reaches from an earlier one: rows of its open session, sessions so far.

        In closed form from one row a range and key: the rows of the leading run just go on counting.
        """
        per = W.partitionBy(*on).orderBy(PART)
        earlier = per.rowsBetween(W.unboundedPreceding, -1)
        upto = per.rowsBetween(W.unboundedPreceding, W.currentRow)
        s = rows.where("_own").groupBy(PART, *on).agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("_t").alias("_first"),
            F.max("_t").alias("_last"),
            F.max("_run").alias("_runs"),
            F.max("_inner").alias("_inner_heads"),
            F.count_if(F.col("_run") == 0).alias("_lead"),
            F.max(F.when(F.col("_break"), F.col("_rn"))).alias("_tail_at"),
        )
        joined = F.lag("_last").over(per).isNotNull()
        if self.limit is not None:
            joined = F.coalesce(F.col("_first") - F.lag("_last").over(per) <= self.limit, F.lit(False))
        s = s.withColumns({"_joined": joined, "_all": F.sum("_n").over(upto), "_late": F.lag("_n").over(per).isNotNull()})
        # Rows of the key before the session that is open at the end of the range.
        before_open = F.when(F.col("_runs") > 0, F.col("_all") - (F.col("_n") - F.col("_tail_at") + 1))
        before_open = before_open.when(~F.col("_joined"), F.col("_all") - F.col("_n"))
        s = s.withColumn("_open", F.col("_all") - F.max(before_open).over(upto))
        s = s.withColumn("_carry", F.when(F.col("_joined"), F.lag("_open").over(per)).otherwise(0))
        lead_heads = self.chunks(F.col("_carry") + F.col("_lead")) - self.chunks(F.col("_carry"))
        s = s.withColumn("_lead_heads", lead_heads)
        s = s.withColumn("_seq0", F.sum(F.col("_lead_heads") + F.col("_inner_heads")).over(earlier))
        return s.where("_late").select(PART, *on, *CARRY)

    def numbered(self, rows: DataFrame) -> DataFrame:
        """``session_seq`` and ``session_pos`` of the ``_own`` rows from :meth:`inside` with what is :meth:`carried`."""
        leading = F.col("_run") == 0
        carry = F.coalesce("_carry", F.lit(0))
        pos = F.col("_pos") + F.when(leading, carry).otherwise(0)
        carried = F.col("_seq0") + F.when(leading, self.chunks(pos) - self.chunks(carry)).otherwise(
            F.col("_lead_heads") + F.col("_inner")
        )
        seq = F.coalesce(carried, F.col("_heads"))
        at = pos if self.cap is None else F.pmod(pos - 1, F.lit(self.cap)) + 1
        own = F.col("_own")
        return rows.withColumns(
            {"session_seq": F.when(own, seq.cast("long")), "session_pos": F.when(own, at.cast("long"))}
        )

    def chunks(self, n: Column) -> Column:
        """Number of sessions that ``n`` rows in a row fill, the last one maybe in part."""
        return F.when(n > 0, 1).otherwise(0) if self.cap is None else floor_div(n + (self.cap - 1), self.cap)


def session_heads(df: DataFrame, on: list[str], time: str, order: list[str]) -> DataFrame:
    """One row per session: start, first row, end, size, start of the key's next session.

    ``df`` comes from :func:`sessionize`.
    """
    first = F.col("session_pos") == 1
    s = (
        df.where(F.col("session_seq").isNotNull())
        .groupBy(*on, "session_seq")
        .agg(
            F.min(time).alias("start_ts"),
            *[F.max(F.when(first, F.col(c))).alias(f"start_{c}") for c in order],
            F.max(time).alias("end_ts"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    return _with_next_start(s, on)


def _with_next_start(s: DataFrame, on: list[str]) -> DataFrame:
    """Add ``next_start_ts``: a lead over blocks of consecutive sessions, so that a key with very many
    sessions is spread; the first session of a block is copied to the block before."""
    block = floor_div(F.col("session_seq") - 1, SESSION_BLOCK)
    first = (F.col("session_seq") > 1) & (F.pmod(F.col("session_seq"), F.lit(SESSION_BLOCK)) == 1)
    s = s.withColumn("_home", block)
    s = s.withColumn(
        "_block",
        F.explode(F.when(first, F.array(block - 1, block)).otherwise(F.array(block))),
    )
    by = W.partitionBy(*on, "_block").orderBy("session_seq")
    s = s.withColumn("next_start_ts", F.lead("start_ts").over(by))
    return s.where("_block = _home").drop("_block", "_home")
