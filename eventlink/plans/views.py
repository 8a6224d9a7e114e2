"""The record schemas as views over the test tables, in Spark and in SQL.

Markers for missing values are set by the row number, so that every cleaning rule has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlink.functions.times import NO_TIME_MS, millis
from eventlink.operators.merge import tagged_union
from eventlink.sources.folders import scratch_folder, with_hour

OBS_TYPES = ("view", "click", "error")
REF_TYPES = ("signup", "purchase")
HOUR_S = 3600
DAY_S = 86400


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _marked(every: int, marker, value):
    return F.when(F.col("event_id") % every == 0, marker).otherwise(value)


def _text(prefix: str, *cols):
    parts = [F.lit(prefix)]
    for c in cols:
        parts += [c if not isinstance(c, str) else F.col(c).cast("string")]
    return F.concat(*parts)


def obs(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").where(F.col("event_type").isin(*OBS_TYPES))
    own = F.when(F.col("event_id") % 5 == 0, _text("own_", "event_id"))
    return e.select(F.col("event_id").alias("row_id"), F.col("user_id").alias("k"), "ts", own.alias("id"))


def _lon():
    return _marked(17, F.lit(0.0), F.lit(100.0) + (F.col("event_id") % 1000) / F.lit(1000.0))


def _lat():
    return F.lit(26.0) + (F.col("event_id") % 777) / F.lit(1000.0)


def ref(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").where(F.col("event_type").isin(*REF_TYPES))
    sub = F.concat(
        F.lit("u"),
        F.col("user_id").cast("string"),
        F.lit("_"),
        (F.col("event_id") % 2).cast("string"),
    )
    return e.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").alias("k"),
        "ts",
        _text("r", "event_id").alias("id"),
        sub.alias("sub_id"),
        _lon().alias("lon"),
        _lat().alias("lat"),
        (F.col("event_id") % 4).cast("int").alias("locate_system"),
    )


def ref_listed(spark, sf) -> DataFrame:
    """References in the order of a list that is not that of time; every seventh has no id."""
    r = ref(spark, sf)
    id_ = F.when(F.col("row_id") % 7 != 0, F.col("id"))
    return r.select("row_id", "k", "ts", id_.alias("id"), F.concat((F.col("row_id") % 10).cast("string"), "id").alias("listed"))


def obs_day(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").where("o_orderstatus <> 'F'")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_custkey") % 100).alias("k"),
        F.col("o_orderdate").alias("ts"),
    )


def ref_day(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_custkey") % 100).alias("k"),
        F.col("o_orderdate").alias("ts"),
        _text("o", "o_orderkey").alias("id"),
    )


def _cell():
    """A cell of one of 21 sites; neither the site nor the connection tells the other."""
    site = F.col("user_id") % 7 * 3 + F.col("event_id") % 3
    return site * 256 + F.col("event_id") % 256


def obs_raw(spark, sf) -> DataFrame:
    """Observations as delivered: raw milliseconds, missing values as markers."""
    e = table(spark, sf, "events").where(F.col("event_type").isin(*OBS_TYPES))
    own = F.when(F.col("event_id") % 5 == 0, _text("own_", "event_id"))
    return e.select(
        F.col("event_id").alias("row_id"),
        _marked(41, F.lit(-1), millis(e, "ts")).cast("long").alias("ts"),
        F.col("user_id").alias("mme_ue_s1ap_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        (F.col("event_id") % 4).cast("int").alias("mme_code"),
        _cell().alias("eci"),
        (F.col("event_id") % 3).cast("int").alias("mme_group_id"),
        _marked(35, F.lit(""), own).alias("id"),
    )


def obs_decoded(spark, sf) -> DataFrame:
    """As the decoder leaves them: a record without a type could not be decoded."""
    return obs_raw(spark, sf).withColumn("is_bad", F.col("event_type").isNull())


def obs_lines(spark, sf) -> DataFrame:
    """Observations as text lines of both shapes; some are cut short, of no known shape, uneven, or hold words for numbers."""
    c, at = F.col, F.col("row_id")
    o = obs_raw(spark, sf)
    texts = [F.coalesce(c(n).cast("string"), F.lit("")) for n in
             ("ts", "mme_ue_s1ap_id", "event_type", "mme_code", "eci", "mme_group_id", "id")]
    texts[1] = F.when(at % 59 == 0, "none").otherwise(texts[1])
    serving = [(at % 3000).cast("string"), (at % 504).cast("string"), (-(at % 60) - 40.5).cast("string")]
    n = F.sequence(F.lit(1), at % 4)
    none = F.array().cast("array<string>")
    some = lambda f: F.when(at % 4 > 0, F.transform(n, f)).otherwise(none)
    lists = [
        some(lambda i: (at % 3000 + i).cast("string")),
        some(lambda i: F.when((at % 71 == 0) & (i == 2), "x").otherwise(((at + i) % 504).cast("string"))),
        some(lambda i: (-i - 50.25).cast("string")),
    ]
    lists[0] = F.when(at % 53 == 0, F.concat(lists[0], F.array(F.lit("1")))).otherwise(lists[0])
    joined = [F.array_join(x, ";") for x in lists]
    ready = F.concat_ws(",", F.lit("P"), *texts, *serving, *joined)
    other = F.concat_ws("|", F.lit("L"), F.concat_ws(";", *texts), F.concat_ws(";", *serving), *joined)
    line = F.when(at % 3 == 0, other).otherwise(ready)
    line = F.when(at % 61 == 0, F.concat(F.lit("X"), line)).when(at % 67 == 0, F.substring(line, 1, 9)).otherwise(line)
    return o.select("row_id", line.alias("line"))


#: The fields of a delivered observation's line, and what a decoder makes of them.
OBS_FIELDS = ["row_id", "ts", "mme_ue_s1ap_id", "event_type", "mme_code", "eci", "mme_group_id", "id"]
OBS_DECODED = """row_id long, ts long, mme_ue_s1ap_id long, event_type string, mme_code int, eci long, mme_group_id int,
    id string, is_bad boolean, raw string"""


def decode_lines(lines: list[str]) -> dict[str, list]:
    """A decoder: one observation a line, with tabs; a line that is none, or one without a type, is bad and kept as text."""
    numbers = {"row_id", "ts", "mme_ue_s1ap_id", "mme_code", "eci", "mme_group_id"}
    out = {c: [] for c in [*OBS_FIELDS, "is_bad", "raw"]}
    for line in lines:
        parts = line.split("\t")
        try:
            values = [int(v) if c in numbers else v for c, v in zip(OBS_FIELDS, parts, strict=True)]
            bad = not values[3]
        except ValueError:
            values, bad = [None] * len(OBS_FIELDS), True
        for c, v in zip(out, [*values, bad, line if bad else None]):
            out[c].append(v)
    return out


def obs_parts(spark, sf) -> DataFrame:
    """Each decoded observation in two records with parts of its neighbour lists."""
    parts = obs_decoded(spark, sf).withColumn("part", F.explode(F.array(F.lit(0), F.lit(1))))
    number = (F.col("row_id") * 2 + F.col("part")).alias("row_id")
    return parts.select(
        number,
        *[c for c in parts.columns if c not in ("row_id", "part")],
        F.array((F.col("row_id") % 100 + F.col("part")).cast("string")).alias("nc_cells"),
        F.array((F.col("row_id") % 50).cast("double")).alias("nc_rsrp"),
    )


def ref_raw(spark, sf) -> DataFrame:
    """Signalling and location references as delivered."""
    e = table(spark, sf, "events").where(F.col("event_type").isin(*REF_TYPES))
    sub = F.concat(
        F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), (F.col("event_id") % 2).cast("string")
    )
    ones = F.lit(4294967295)
    return e.select(
        F.col("event_id").alias("row_id"),
        _marked(13, F.lit("\\N"), _marked(29, F.lit(""), sub)).alias("id"),
        _marked(19, ones, _cell()).alias("eci"),
        _marked(31, ones, F.col("user_id")).alias("mme_ue_s1ap_id"),
        _marked(11, F.lit(-1), millis(e, "ts")).cast("long").alias("start_ts"),
        F.when(F.col("event_id") % 43 != 0, _marked(37, F.lit(-1), millis(e, "ts") + 1000))
        .cast("long")
        .alias("end_ts"),
        _lon().alias("lon"),
        _lat().alias("lat"),
        (F.col("event_id") % 4).cast("int").alias("locate_system"),
    )


def by_hour(df: DataFrame, time: str) -> DataFrame:
    """Raw records with the ``day`` and ``hour`` of their time; both are null without one."""
    at = F.timestamp_millis(F.when(F.col(time) != NO_TIME_MS, F.col(time))).cast("timestamp_ntz")
    return with_hour(df.withColumn("_at", at), "_at").drop("_at")


def in_folders(df: DataFrame, name: str, time: str) -> DataFrame:
    """Raw records as a table with a folder for each day."""
    path = scratch_folder(df.sparkSession, name)
    hours = by_hour(df, time)
    hours.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    return df.sparkSession.read.schema(hours.schema).parquet(path)


def ref_lines(spark, sf) -> DataFrame:
    """References as text lines; some end early, some have a word where a number belongs."""
    r = ref_raw(spark, sf)
    eci = F.when(F.col("row_id") % 23 == 0, F.lit("none")).otherwise(F.col("eci").cast("string"))
    rest = [F.col("mme_ue_s1ap_id").cast("string"), F.col("start_ts").cast("string")]
    full = F.concat_ws(",", "id", eci, *rest)
    line = (
        F.when(F.col("row_id") % 10 == 0, F.concat_ws(",", "id", eci))
        .when(F.col("row_id") % 10 == 1, F.col("id"))
        .otherwise(full)
    )
    return r.select("row_id", line.alias("line"))


def grid(spark, sf) -> DataFrame:
    """A correction grid over the cells that occur in the data; some cells are missing."""
    r = ref(spark, sf).where("lon <> 0")
    cells = r.select(
        F.floor(F.col("lon") * 10).cast("int").alias("cell_x"),
        F.floor(F.col("lat") * 10).cast("int").alias("cell_y"),
    ).distinct()
    return cells.where("(cell_x + cell_y) % 7 <> 0").select(
        F.explode(F.array(F.lit("Bd"), F.lit("Gd"))).alias("system"),
        "cell_x",
        "cell_y",
        F.lit(-0.006).alias("dlon"),
        F.lit(-0.001).alias("dlat"),
    )


def neighbour_lines(spark, sf) -> DataFrame:
    """Three parallel text lists per line item."""
    li = table(spark, sf, "lineitem")
    pair = lambda a, b: F.concat_ws(";", a.cast("string"), b.cast("string"))
    c = F.col
    return li.select(
        "l_orderkey",
        pair(c("l_partkey"), c("l_suppkey")).alias("earfcn"),
        pair(c("l_linenumber"), c("l_linenumber") + 1).alias("pci"),
        pair(c("l_quantity"), c("l_discount")).alias("rsrp"),
    )


def both_kinds(spark, sf) -> DataFrame:
    return tagged_union(
        obs=obs(spark, sf), ref=ref(spark, sf).select("row_id", "k", "ts", "id", "lon", "lat")
    )


# --- the same views in SQL ------------------------------------------------------------------------

_EVENT_LON = "case when event_id % 17 = 0 then 0.0 else 100.0::double + (event_id % 1000) / 1000.0::double end"
_EVENT_LAT = "26.0::double + (event_id % 777) / 1000.0::double"

SQL = {
    "obs": """select event_id row_id, user_id k, ts,
        case when event_id % 5 = 0 then 'own_' || event_id end id
        from events where event_type in ('view','click','error')""",
    "ref": f"""select event_id row_id, user_id k, ts, 'r' || event_id id,
        'u' || user_id || '_' || event_id % 2 sub_id, {_EVENT_LON} lon, {_EVENT_LAT} lat,
        (event_id % 4)::int locate_system
        from events where event_type in ('signup','purchase')""",
    "ref_listed": """select row_id, k, ts, case when row_id % 7 <> 0 then id end id, (row_id % 10) || id listed from ref""",
    "obs_day": """select o_orderkey row_id, o_custkey % 100 k, o_orderdate ts
        from orders where o_orderstatus <> 'F'""",
    "ref_day": """select o_orderkey row_id, o_custkey % 100 k, o_orderdate ts, 'o' || o_orderkey id
        from orders where o_orderstatus = 'F'""",
    "obs_raw": """select event_id row_id,
        case when event_id % 41 = 0 then -1 else (epoch_us(ts) // 1000) end ts,
        user_id mme_ue_s1ap_id,
        case when event_type <> 'error' then event_type end event_type,
        (event_id % 4)::int mme_code, (user_id % 7 * 3 + event_id % 3) * 256 + event_id % 256 eci,
        (event_id % 3)::int mme_group_id,
        case when event_id % 35 = 0 then '' when event_id % 5 = 0 then 'own_' || event_id end id
        from events where event_type in ('view','click','error')""",
    "obs_lines": """select row_id, case when row_id % 61 = 0 then 'X' || line when row_id % 67 = 0 then line[1:9] else line end line
        from (select row_id, case when row_id % 3 = 0
                then 'L|' || array_to_string(basic, ';') || '|' || array_to_string(serving, ';') || '|' || e || '|' || p || '|' || r
                else 'P,' || array_to_string(basic, ',') || ',' || array_to_string(serving, ',') || ',' || e || ',' || p || ',' || r
            end line
        from (select row_id, [coalesce(ts::varchar, ''), case when row_id % 59 = 0 then 'none' else mme_ue_s1ap_id::varchar end,
                coalesce(event_type, ''), mme_code::varchar, eci::varchar, mme_group_id::varchar, coalesce(id, '')] basic,
            [(row_id % 3000)::varchar, (row_id % 504)::varchar, (-(row_id % 60) - 40.5::double)::varchar] serving,
            array_to_string(list_concat(list_transform(range(1, row_id % 4 + 1), lambda i: (row_id % 3000 + i)::varchar),
                case when row_id % 53 = 0 then ['1'] else [] end), ';') e,
            array_to_string(list_transform(range(1, row_id % 4 + 1),
                lambda i: case when row_id % 71 = 0 and i = 2 then 'x' else ((row_id + i) % 504)::varchar end), ';') p,
            array_to_string(list_transform(range(1, row_id % 4 + 1), lambda i: (-i - 50.25::double)::varchar), ';') r
            from obs_raw))""",
    "obs_parts": """select row_id * 2 + part row_id, o.* exclude (row_id),
        (row_id % 100 + part)::varchar cell, row_id % 50 rsrp
        from obs_raw o, (values (0), (1)) p(part) where event_type is not null""",
    "ref_raw": f"""select event_id row_id,
        case when event_id % 13 = 0 then '\\N' when event_id % 29 = 0 then ''
             else 'u' || user_id || '_' || event_id % 2 end id,
        case when event_id % 19 = 0 then 4294967295 else (user_id % 7 * 3 + event_id % 3) * 256 + event_id % 256 end eci,
        case when event_id % 31 = 0 then 4294967295 else user_id end mme_ue_s1ap_id,
        case when event_id % 11 = 0 then -1 else (epoch_us(ts) // 1000) end start_ts,
        case when event_id % 43 = 0 then null when event_id % 37 = 0 then -1
            else (epoch_us(ts) // 1000) + 1000 end end_ts,
        {_EVENT_LON} lon, {_EVENT_LAT} lat, (event_id % 4)::int locate_system
        from events where event_type in ('signup','purchase')""",
    "grid": """select s.system, cell_x, cell_y, -0.006::double dlon, -0.001::double dlat
        from (select distinct floor(lon * 10)::int cell_x, floor(lat * 10)::int cell_y
              from ref where lon <> 0) c, (values ('Bd'), ('Gd')) s(system)
        where (cell_x + cell_y) % 7 <> 0""",
}


def sql(body: str, *names: str, recursive: bool = False) -> str:
    """``body`` with the named views as common table expressions."""
    ctes = ",\n".join(f"{n} as ({SQL[n]})" for n in names)
    word = "with recursive" if recursive else "with"
    return f"{word} {ctes}{body if body.lstrip().startswith(',') else chr(10) + body}"
