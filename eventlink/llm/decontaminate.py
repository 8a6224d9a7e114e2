"""Which documents hold passages of a benchmark: a prefix-filtered join of word shingles.

Every benchmark item gives windows of ``WINDOW`` words.  A window occurs in a document only if all its
shingles do, so it is enough to join on one of them, its prefix: the one that is rarest in the documents.
The documents' shingles that can be a prefix are picked in the scan by a bit table of fixed size, joined
with the windows, held against the bounds that place and length set, and the window's words are then
compared one by one.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlink.llm.common import bit_table, fresh, let, maybe_broadcast, saved, words

WINDOW = 13
SHINGLE = 5
#: The windows are broadcast up to so many of them (about 200 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 200_000


def _shingle(w: Column, i: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(w, i + j) for j in range(size)])


def _places(w: Column, size: int) -> Column:
    """Where a run of ``size`` words can begin."""
    n = F.size(w) - size
    return F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))


def _all_shingles(w: Column, size: int) -> Column:
    return F.transform(_places(w, size), lambda i: _shingle(w, i, size))


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows as arrays of words, each with the ids, as text, of the items that have it.

    An item of fewer words is one window, an item without words has none.  An item without an id counts
    under the empty text.
    """
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    own = benchmark.select(item, words(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    start = own.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("s"))
    cut = start.select("item", F.slice("w", F.col("s") + 1, F.lit(window)).alias("win"))
    return cut.groupBy("win").agg(F.collect_set("item").alias("items"))


def _shingles(win: DataFrame, size: int) -> DataFrame:
    """A row for each shingle of each window: its hash h and place ``pos`` in the window."""
    parts = None
    for s in range(1, size + 1):
        fits = F.size("win") == s if s < size else F.size("win") >= size
        own = win.where(fits).select("*", F.posexplode(_all_shingles(F.col("win"), s)).alias("pos", "h"))
        parts = own if parts is None else parts.unionByName(own)
    return parts


def _hits(w: Column, sizes: list[int], passes, make) -> Column:
    """``make(i, h)`` for all places i of a text's words whose shingle h passes the bit table."""

    def of(size):
        both = lambda i: F.struct(i.alias("i"), _shingle(w, i, size).alias("h"))
        hits = F.filter(F.transform(_places(w, size), both), lambda p: passes(p["h"]))
        return F.transform(hits, lambda p: make(p["i"], p["h"]))

    return F.concat(*[of(s) for s in sizes])


def occurrences(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, keep=("doc_id",)
) -> DataFrame:
    """One row for each document and each verified place of a window, and one more for each document.

    Columns: ``keep``, ``print`` (hash of the text), n_words, own (true in the one more), start, size,
    items; start is null where nothing is found.
    """
    win = windows(benchmark, window)
    size = min(SHINGLE, window)
    shingles = _shingles(win, size)
    sizes_of = F.collect_set(F.least(F.size("win"), F.lit(size)))
    stats = shingles.agg(F.count("*").alias("n"), sizes_of.alias("sizes")).head()
    sizes = sorted(stats["sizes"]) or [size]
    base = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("print"),
        words(F.col(text)).alias("w"),
    )
    # how often the documents have each shingle of the benchmark; only those that pass the bits are counted
    table = bit_table(shingles, stats["n"])
    seen = base.select(F.explode(let(F.col("w"), lambda w: _hits(w, sizes, table, lambda i, h: h))).alias("h"))
    seen = saved(seen.groupBy("h").agg(F.count("*").alias("freq")), "frequencies")
    common = shingles.select("h").distinct().join(seen, "h")
    ranked = shingles.join(maybe_broadcast(common, stats["n"], BROADCAST_WINDOWS), "h")
    prefix = ranked.groupBy("win").agg(
        F.min(F.struct("freq", "h", "pos")).alias("best"),
        F.first("items").alias("items"),
        F.count("*").alias("n"),
    )
    # a window with a shingle that no document has can't occur
    whole = F.greatest(F.size("win") - (size - 1), F.lit(1))
    prefix = prefix.where(F.col("n") == whole).select("win", "items", "best.h", "best.pos")
    prefix = saved(prefix, "prefixes")
    n = prefix.count()
    table = bit_table(prefix.select("h"), n)
    back, reach = window - 1, 2 * window

    def found(w):
        def one(i, h):
            start = F.greatest(i - back, F.lit(0))
            around = F.slice(w, start + 1, F.lit(reach)).alias("ctx")
            return F.struct(i.alias("i"), h.alias("h"), start.alias("begin"), around)

        return F.struct(F.size(w).cast("long").alias("n_words"), _hits(w, sizes, table, one).alias("hits"))

    keys = [f"_k{i}" for i in range(len(keep))]
    one_more = F.array(F.lit(None).cast("struct<i:int,h:bigint,begin:int,ctx:array<string>>"))
    scan = base.select(*keys, "print", let(F.col("w"), found).alias("f"))
    scan = scan.select(*keys, "print", "f.n_words", F.explode(F.concat(one_more, "f.hits")).alias("p"))
    start = F.col("p.i") - F.col("pos")
    match = (
        (F.coalesce("p.h", "print") == F.col("h"))  # rows without a hit are spread by their text
        & F.col("p").isNotNull()
        & (start >= 0)
        & (start + F.size("win") <= F.col("n_words"))
        & (F.slice("p.ctx", F.greatest(start - F.col("p.begin") + 1, F.lit(1)), F.size("win")) == F.col("win"))
    )
    out = scan.join(maybe_broadcast(prefix, n, BROADCAST_WINDOWS), match, "left")
    return out.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        "print",
        "n_words",
        F.col("p").isNull().alias("own"),
        start.alias("start"),
        F.size("win").alias("size"),
        "items",
    )


def _covered(places: Column) -> Column:
    """Words within any of the sorted (start, end) places."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(
        places,
        zero,
        lambda acc, p: F.struct(
            (acc["n"] + F.greatest(p["end"] - F.greatest(p["start"], acc["reach"]), F.lit(0))).alias("n"),
            F.greatest(acc["reach"], p["end"]).alias("reach"),
        ),
        lambda acc: acc["n"],
    ).cast("long")


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, parts: int = 20
) -> DataFrame:
    """How far each document is made of benchmark text.

    Columns: doc_id, n_words, n_hit (words inside an occurring window), n_items, items_sha256,
    contaminated (n_hit > 0 and parts * n_hit >= n_words).  Null and empty texts have no words and are
    clean; repeated rows give repeated rows; an empty benchmark makes every document clean.
    """
    return _contamination(docs, benchmark, text, window, parts).drop("print")


def _contamination(docs, benchmark, text, window, parts):
    rows = occurrences(docs, benchmark, text, window)
    place = F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.col("size")).alias("end")))
    each = rows.groupBy("doc_id", "print", "n_words").agg(
        F.count_if("own").alias("copies"),
        F.sort_array(F.collect_set(place)).alias("places"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    n_hit = _covered(F.col("places"))
    each = each.select(
        "doc_id",
        "print",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
    dirty = (F.col("n_hit") > 0) & (parts * F.col("n_hit") >= F.col("n_words"))
    return each.withColumn("contaminated", dirty)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns as they are."""
    dirty = _contamination(docs.select("doc_id", F.col(text).alias("text")), benchmark, "text", WINDOW, 20)
    dirty = dirty.where("contaminated").select(F.col("doc_id").alias("_id"), F.col("print").alias("_p")).distinct()
    key = fresh(docs, "_print")
    own = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = own["doc_id"].eqNullSafe(dirty["_id"]) & (own[key] == dirty["_p"])
    return own.join(dirty, same, "left_anti").select(*docs.columns)


#: The contract of ``op1_decontamination`` over the views of the tables.
ORACLE = r"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g FROM (
    SELECT item, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM item WHERE len(w) > 0)),
place AS (
  SELECT rid, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g FROM (
    SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s
    FROM doc JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n)),
hit AS (SELECT place.* FROM place SEMI JOIN win USING (n, g)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rid),
own AS (
  SELECT rid, list_sort(list(DISTINCT item)) AS items FROM (SELECT DISTINCT rid, n, g FROM hit) JOIN win USING (n, g) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (rid) LEFT JOIN own USING (rid)
"""
