"""The registered queries: name → function of (spark, folder of the tables)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eventlink.functions import geo, ids, times
from eventlink.operators import (
    clean,
    grouping,
    location,
    merge,
    nearest,
    quality,
    session_joins,
    sessions,
    shapes,
    words,
)
from eventlink.operators.slicing import Slicing
from eventlink.plans import jobs, runs, views
from eventlink.sources import decoded, folders, schemas

H12 = 12 * views.HOUR_S
DAYS30 = 30 * views.DAY_S
GAP, CAP = H12, 3
MERIDIAN = 99.0
XY_BOUNDS = (500_000.0, 800_000.0, 2_800_000.0, 3_000_000.0)
RUN_DAY, RUN_HOUR, RUN_AROUND = "20240115", 10, 720
FIRST, LAST = dt.datetime(2024, 1, 3, 6), dt.datetime(2024, 1, 28, 18)
CONN = ["mme_ue_s1ap_id"]
SALT = "pepper"


# --- scans, sources, sinks ------------------------------------------------------------------------


def scan_delimited(spark, sf):
    path = folders.scratch_folder(spark, "scan")
    o = views.obs(spark, sf)
    flat = o.select("row_id", "k", times.millis(o, "ts").alias("ts"), "id")
    flat.write.option("nullValue", ids.NULL_TEXT).csv(f"{path}/part=a/b")
    schema = schemas.struct([("row_id", "bigint"), ("k", "bigint"), ("ts", "bigint"), ("id", "string")])
    return folders.scan_delimited(spark, path, schema, name_filter="*.csv")


def sink_roundtrip(spark, sf):
    path = folders.scratch_folder(spark, "sink")
    o = folders.with_hour(views.obs(spark, sf))
    folders.write_hours(o, path, fmt="parquet")
    kinds = "row_id bigint, k bigint, ts timestamp_ntz, id string, day string, hour string"
    return spark.read.schema(kinds).parquet(path)


def tagged_union(spark, sf):
    return views.both_kinds(spark, sf)


def hour_slice(spark, sf):
    r = folders.with_hour(views.ref(spark, sf)).select("row_id", "k", "ts", "day", "hour")
    return folders.hour_slice(r, RUN_DAY, RUN_HOUR, RUN_AROUND, RUN_AROUND, time="ts")


def hour_paths_nested(spark, sf):
    """What an hourly run finds in folders of the form day/hour, one of which has never been delivered."""
    path = folders.scratch_folder(spark, "nested")
    o = folders.with_hour(views.obs(spark, sf))
    o = o.select("row_id", "k", times.millis(o, "ts").alias("ts"), "day", "hour")
    for hour in ("08", "09", "10", "12"):
        o.where((F.col("day") == RUN_DAY) & (F.col("hour") == hour)).drop("day", "hour").write.csv(f"{path}/{RUN_DAY}/{hour}")
    schema = schemas.struct([("row_id", "bigint"), ("k", "bigint"), ("ts", "bigint")])
    found = folders.read_hours(spark, path, schema, RUN_DAY, RUN_HOUR, 60, 120, nested=True)
    folder = F.regexp_extract("_file", "([0-9]{8}/[0-9]{2})/[^/]*$", 1)
    return found.select("row_id", "k", "ts", folder.alias("folder"))


def day_slice(spark, sf):
    r = folders.with_hour(views.ref(spark, sf)).select("row_id", "k", "ts", "day", "hour")
    return folders.day_slice(r, RUN_DAY, time="ts")


def backfill_passthrough(spark, sf):
    out = jobs.backfill(views.obs_raw(spark, sf), None)
    return out.select("row_id", "ts", "id", "distance", "matched")


# --- projections, filters, cleaning ---------------------------------------------------------------


def parse_refs(spark, sf):
    lines = views.ref_lines(spark, sf)
    return clean.parse_delimited(lines, "line", schemas.SIGNALLING_FIELDS, keep=["row_id"])


def bad_records(spark, sf):
    good, bad = clean.split_bad(parse_refs(spark, sf))
    return merge.tagged_union(
        good=good.select("row_id", "id", "eci"), bad=bad.select("row_id", "id", "eci")
    )


def decode_neighbours(spark, sf):
    c = F.col
    cells, rsrp = clean.neighbour_arrays(c("earfcn"), c("pci"), c("rsrp"))
    bad = clean.neighbours_bad(c("earfcn"), c("pci"), c("rsrp"))
    df = views.neighbour_lines(spark, sf)
    df = df.select("l_orderkey", cells.alias("cells"), rsrp.alias("rsrp"), bad.alias("is_bad"))
    return df.select(
        "l_orderkey",
        "is_bad",
        F.size("cells").cast("long").alias("n_cells"),
        *[c("cells")[i][f].alias(f"{f}_{i}") for i in (0, 1) for f in ("earfcn", "pci")],
        *[c("rsrp")[i].alias(f"rsrp_{i}") for i in (0, 1)],
    )


def decode_shapes(spark, sf):
    """Text records of two shapes, put together with serving cell and neighbours; what is bad keeps its text and reason."""
    df = shapes.decode_observations(views.obs_lines(spark, sf))
    basic = [name for name, _ in shapes.BASIC]
    cell = F.transform("nc", lambda x: F.concat_ws(":", x["earfcn"], x["pci"], x["rsrp"]))
    return df.select(
        "row_id",
        *basic,
        *[F.col("sc")[f].alias(f"sc_{f}") for f in ("earfcn", "pci", "rsrp")],
        F.array_join(cell, " ").alias("nc"),
        "is_bad",
        "reason",
        "raw",
    )


def basic_params(spark, sf):
    return views.obs_raw(spark, sf).select(*clean.basic_columns())


def valid_refs(spark, sf):
    r = views.ref_raw(spark, sf).where(clean.valid_reference())
    return r.select("row_id", "id", "start_ts", "end_ts")


def valid_locations(spark, sf):
    r = views.ref_raw(spark, sf).where(clean.valid_location())
    return r.select("row_id", "id", "start_ts", "end_ts")


def sentinel_filter(spark, sf):
    r = views.ref_raw(spark, sf).where(clean.no_sentinel("mme_ue_s1ap_id", "eci"))
    return r.select("row_id", "mme_ue_s1ap_id", "eci")


def ref_time_range(spark, sf):
    r = views.ref(spark, sf).select("row_id", "k", "ts")
    return clean.time_range(r, "ts", FIRST, LAST)


def nonzero_coords(spark, sf):
    return views.ref(spark, sf).where(clean.nonzero_lonlat()).select("row_id", "lon", "lat")


def require_id(spark, sf):
    o = views.obs_raw(spark, sf)
    return o.where(ids.has_id(F.col("id"))).select("row_id", "id")


def hash_ids(spark, sf):
    r = views.ref(spark, sf)
    return r.select("row_id", ids.hashed_id(F.col("sub_id"), SALT).alias("id"))


def site_key(spark, sf):
    return jobs.with_site(views.ref_raw(spark, sf)).select("row_id", "eci", "site")


def point_lookup(spark, sf):
    return clean.lookup(views.ref_raw(spark, sf), "mme_ue_s1ap_id", 7, "start_ts", "id")


# --- sessions and neighbours ----------------------------------------------------------------------


def _sessions(spark, sf, gap=GAP, cap=CAP, inclusive=True):
    return sessions.sessionize(views.obs(spark, sf), ["k"], gap=gap, cap=cap, inclusive=inclusive)


def sessionize_gap_cap(spark, sf):
    return _sessions(spark, sf).select("row_id", "k", "ts", "session_seq", "session_pos")


def sessionize_strict(spark, sf):
    out = _sessions(spark, sf, cap=None, inclusive=False)
    return out.select("row_id", "k", "ts", "session_seq", "session_pos")


def sessionize_defaults(spark, sf):
    """With the default gap and cap of the sessions that the joins use."""
    link = session_joins.Linking(["k"], {})
    out = sessions.sessionize(views.obs(spark, sf), ["k"], gap=link.gap, cap=link.cap)
    return out.select("row_id", "k", "ts", "session_seq", "session_pos")


def session_summary(spark, sf):
    return sessions.session_heads(_sessions(spark, sf), ["k"], "ts", ["row_id"])


def prev_next_ref(spark, sf):
    return nearest.prev_next(
        views.obs(spark, sf).select("row_id", "k", "ts"), views.ref(spark, sf), ["k"], ["id", "ts"]
    )


# --- joins ----------------------------------------------------------------------------------------


def _nearest(spark, sf, bound=H12, **kw):
    out = nearest.nearest_join(
        views.obs(spark, sf), views.ref(spark, sf), ["k"], bound, {"found": "id"}, **kw
    )
    return out.withColumn("matched", F.col("found").isNotNull())


def backfill_nearest(spark, sf):
    return nearest.keep_or_fill(_nearest(spark, sf), "id", "found")


def backfill_nearest_output(spark, sf):
    return jobs.backfill_output(backfill_nearest(spark, sf)).select("row_id", "id")


def backfill_nearest_carry(spark, sf):
    """As ``backfill_nearest``, with slices far below the bound, so that most matches are carried."""
    how = Slicing(width=views.HOUR_S * 100_000)
    return nearest.keep_or_fill(_nearest(spark, sf, slicing=how), "id", "found")


def backfill_nearest_days(spark, sf):
    return nearest.nearest_join(
        views.obs_day(spark, sf), views.ref_day(spark, sf), ["k"], DAYS30, ["id"]
    )


def backfill_offset(spark, sf):
    return nearest.keep_or_fill(_nearest(spark, sf, offset=views.HOUR_S), "id", "found")


def nearest_range_join(spark, sf):
    return nearest.nearest_join(
        views.obs_day(spark, sf), views.ref_day(spark, sf), ["k"], DAYS30, ["id"], tie="first"
    )


def nearest_composite_key(spark, sf):
    o = jobs.with_site(views.obs_raw(spark, sf)).select("row_id", "ts", *jobs.KEYS)
    r = views.ref_raw(spark, sf).where(clean.no_sentinel("mme_ue_s1ap_id", "eci"))
    r = jobs.with_site(r.where(F.col("id") != ids.NULL_TEXT))
    return nearest.nearest_join(
        o, r, jobs.KEYS, H12, {"ref_row": "row_id"}, ref_time="start_ts", tie="first"
    )


def _session_join(join, spark, sf, **kw):
    o = views.obs(spark, sf).select("row_id", "k", "ts")
    out = join(o, views.ref(spark, sf), ["k"], H12, ["id"], gap=GAP, **kw)
    return out.select("row_id", "k", "session_seq", "id")


def session_nearest_start(spark, sf):
    return _session_join(session_joins.session_nearest_start, spark, sf, cap=CAP)


def session_nearest_pair(spark, sf):
    return _session_join(session_joins.session_nearest_pair, spark, sf, cap=CAP)


def session_nearest_dedup(spark, sf):
    out = session_joins.session_nearest_dedup(
        views.obs_day(spark, sf), views.ref_day(spark, sf), ["k"], DAYS30, ["id"], gap=H12, cap=CAP
    )
    return out.select("row_id", "k", "session_seq", "id")


def segment_last_in_window(spark, sf):
    """References listed in another order than that of time, some without an id."""
    o = views.obs(spark, sf).select("row_id", "k", "ts")
    r = views.ref_listed(spark, sf)
    out = session_joins.segment_last_in_window(o, r, ["k"], H12, ["id"], gap=GAP, ref_order=["listed"])
    return out.select("row_id", "k", "session_seq", "id")


def segment_latest_in_window(spark, sf):
    return _session_join(session_joins.segment_last_in_window, spark, sf, latest="time")


def _located(spark, sf, **kw):
    o = views.obs(spark, sf).select("row_id", "k", "ts")
    return location.nearest_location(
        o, views.ref(spark, sf), views.grid(spark, sf), ["k"], H12, distance=None, **kw
    )


def location_nearest(spark, sf):
    return _located(spark, sf)


def location_nearest_preconverted(spark, sf):
    return _located(spark, sf, convert_first=True)


def session_location(spark, sf):
    o = views.obs(spark, sf).select("row_id", "k", "ts")
    out = location.session_location(
        o, views.ref(spark, sf), views.grid(spark, sf), ["k"], H12, gap=GAP, cap=CAP
    )
    return out.select("row_id", "k", "session_seq", "lon", "lat")


def coord_convert(spark, sf):
    r = views.ref(spark, sf).where(clean.nonzero_lonlat())
    return location.to_gps(
        r.select("row_id", "lon", "lat", "locate_system"), views.grid(spark, sf)
    )


def coord_convert_files(spark, sf):
    """As ``coord_convert``, with the correction grid loaded from one folder of text files for each system."""
    path = folders.scratch_folder(spark, "grid")
    g = views.grid(spark, sf)
    for system in ("Bd", "Gd"):
        g.where(F.col("system") == system).write.csv(f"{path}/{system}")
    r = views.ref(spark, sf).where(clean.nonzero_lonlat())
    return location.to_gps(r.select("row_id", "lon", "lat", "locate_system"), folders.load_grid(spark, path))


# --- aggregations ---------------------------------------------------------------------------------


def _neighbours(spark, sf):
    li = views.table(spark, sf, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    li = li.select(
        "l_orderkey",
        *order,
        F.array(F.col("l_partkey").cast("string")).alias("cells"),
        F.array(F.col("l_quantity").cast("int").cast("string")).alias("rsrp"),
        F.col("l_suppkey").alias("first_supp"),
    )
    return li, order


def merge_neighbours(spark, sf):
    li, order = _neighbours(spark, sf)
    out = merge.merge_arrays(li, ["l_orderkey"], ["cells", "rsrp"], order, ["first_supp"])
    return out.select(
        "l_orderkey",
        "first_supp",
        F.concat_ws(",", "cells").alias("cells"),
        F.concat_ws(",", "rsrp").alias("rsrp"),
        "n_merged",
    )


def merge_neighbours_long(spark, sf):
    li, order = _neighbours(spark, sf)
    return merge.merge_arrays_long(li, ["l_orderkey"], ["cells", "rsrp"], order)


def _backfilled(spark, sf, obs=None, **kw):
    """On the job's own keys, site and connection."""
    obs = views.obs_decoded(spark, sf) if obs is None else obs
    return jobs.backfill(obs, views.ref_raw(spark, sf), bound=H12, ref_range=(FIRST, LAST), **kw)


def quality_backfill(spark, sf):
    obs, ref = views.obs_decoded(spark, sf), views.ref_raw(spark, sf)
    return jobs.backfill_report(obs, ref, _backfilled(spark, sf), ref_range=(FIRST, LAST))


def _attached(obs, spark, sf, **kw):
    refs, grid = views.ref_raw(spark, sf), views.grid(spark, sf)
    return jobs.attach_location(obs, refs, grid, MERIDIAN, bound=H12, distance=None, **kw)


def quality_location(spark, sf):
    filled = folders.stored(_backfilled(spark, sf).drop("distance", "matched"), "filled")
    located = _attached(filled, spark, sf)
    return jobs.location_report(filled, views.ref_raw(spark, sf), located)


def quality_sessions(spark, sf):
    tagged = session_nearest_start(spark, sf)
    per = tagged.groupBy("k", "session_seq").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.col("id").isNotNull()).alias("matched")
    )
    return quality.session_counts(per, "n_rows", "matched")


def id_totals(spark, sf):
    return grouping.id_totals(group_by_id(spark, sf))


def group_by_id(spark, sf):
    o = views.obs(spark, sf).select("row_id", "k", "ts")
    out = nearest.nearest_join(o, views.ref(spark, sf), ["k"], H12, {"id": "sub_id"}, tie="first")
    return grouping.group_by_id(out, "id", "ts")


def _counted_refs(spark, sf):
    """References with an id and with both keys."""
    named = F.col("id").isNotNull() & (F.col("id") != ids.NULL_TEXT)
    r = views.ref_raw(spark, sf).where(named & clean.no_sentinel("mme_ue_s1ap_id", "eci"))
    return jobs.with_site(r)


def refs_per_key(spark, sf):
    return grouping.rows_per_key(_counted_refs(spark, sf), jobs.KEYS)


def refs_per_conn(spark, sf):
    return grouping.rows_per_key(_counted_refs(spark, sf), CONN)


def refs_total(spark, sf):
    return grouping.rows_per_key(_counted_refs(spark, sf), [])


def rows_per_key(spark, sf):
    return sessions.number_rows(views.obs(spark, sf).select("row_id", "k", "ts"), ["k"])


def word_count(spark, sf):
    return words.word_count(views.table(spark, sf, "documents"), "text")


def word_totals(spark, sf):
    return words.word_totals(word_count(spark, sf))


# --- order and scalar functions -------------------------------------------------------------------


def sort_by_time(spark, sf):
    return grouping.sort_by_time(views.obs(spark, sf).select("ts", "row_id", "k"), "ts", ["row_id"])


def hour_parse(spark, sf):
    r = folders.with_hour(views.ref(spark, sf))
    return r.select(
        "row_id",
        times.parse_hour(F.col("day"), F.col("hour")).alias("hour_ts"),
        times.short_day(F.col("ts")).alias("short_day"),
    )


def format_duration(spark, sf):
    r = views.ref(spark, sf)
    start = (dt.datetime(2024, 1, 1) - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)
    ms = times.millis(r, "ts") - start
    return r.select("row_id", times.duration_text(ms).alias("elapsed"))


def lonlat_text(spark, sf):
    r = views.ref(spark, sf).select("row_id", geo.lonlat_text(F.col("lon"), F.col("lat")).alias("text"))
    lon, lat = geo.split_lonlat(F.col("text"))
    return r.select("row_id", "text", lon.alias("lon"), lat.alias("lat"))


def coord_system(spark, sf):
    r = views.ref(spark, sf)
    return r.select("row_id", geo.system_name(F.col("locate_system")).alias("system"))


def project_xy(spark, sf):
    r = location.project(views.ref(spark, sf).where("lon <> 0"), MERIDIAN)
    return r.select("row_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


# --- whole jobs -----------------------------------------------------------------------------------


def job_backfill(spark, sf):
    out = jobs.backfill_output(_backfilled(spark, sf))
    return out.select("row_id", "ts", "mme_ue_s1ap_id", "id", "distance", "matched")


def job_backfill_defaults(spark, sf):
    """With every parameter of the job as it is by default."""
    out = jobs.backfill_output(jobs.backfill(views.obs_decoded(spark, sf), views.ref_raw(spark, sf)))
    return out.select("row_id", "ts", "mme_ue_s1ap_id", "id", "distance", "matched")


def job_backfill_merged(spark, sf):
    """Partial records merged, then joined."""
    out = jobs.backfill_output(_backfilled(spark, sf, views.obs_parts(spark, sf), merge=True))
    lists = [F.concat_ws(",", "nc_cells").alias("cells"), F.size("nc_rsrp").cast("long").alias("n_rsrp")]
    return out.select("row_id", "ts", "mme_ue_s1ap_id", "id", "matched", "n_merged", *lists)


def _written(spark, out, counters, name, take):
    """The job's rows as its folders hold them, one for each day, and the run's counters beside each row."""
    path = folders.scratch_folder(spark, name)
    at = F.when(F.col("ts") != times.NO_TIME_MS, F.timestamp_millis("ts"))
    out = folders.with_hour(out.select(*take).withColumn("at", at), "at")
    kinds = out.schema
    jobs.write_run(out, path, salt=SALT, fmt="parquet", by=("day",))
    back = spark.read.schema(kinds).parquet(path).drop("at")
    named = {"n_matched" if c == "matched" else c: n for c, n in counters().items()}
    return back.select("*", *[F.lit(n).cast("long").alias(c) for c, n in named.items()])


def job_backfill_written(spark, sf):
    """The whole backfill run, written, with all its counters; each raw side is read once."""
    obs, ref = views.obs_decoded(spark, sf), views.ref_raw(spark, sf)
    filled, counters = jobs.counted_backfill(obs, ref, bound=H12, ref_range=(FIRST, LAST))
    take = ["row_id", "ts", "id", "matched"]
    return _written(spark, jobs.backfill_output(filled), counters, "backfill", take)


def job_location_written(spark, sf):
    """The whole location run, written, with all its counters; each raw side is read once."""
    refs, grid = views.ref_raw(spark, sf), views.grid(spark, sf)
    located, counters = jobs.counted_location_run(
        _delivered_ids(spark, sf), refs, grid, MERIDIAN, bound=H12, distance=None
    )
    out = jobs.location_output(located, XY_BOUNDS)
    out = out.withColumns({c: F.round(c, 3) for c in ("x", "y")})
    return _written(spark, out, counters, "location", ["row_id", "ts", "id", "lon", "lat", "x", "y"])


def _positions(df):
    xy = [F.round(c, 3).alias(c) for c in ("x", "y")]
    return df.select("row_id", "ts", "id", "lon", "lat", *xy)


def job_location(spark, sf):
    located = _attached(_delivered_ids(spark, sf), spark, sf)
    return _positions(jobs.location_output(located, XY_BOUNDS))


def _delivered_ids(spark, sf):
    """Observations that come with an id: the user's first or second one."""
    own = F.concat(
        F.lit("u"),
        F.col("mme_ue_s1ap_id").cast("string"),
        F.lit("_"),
        (F.col("row_id") % 2).cast("string"),
    )
    return views.obs_raw(spark, sf).withColumn("id", own)


def job_chain(spark, sf):
    out = jobs.chain(
        views.obs_decoded(spark, sf),
        views.ref_raw(spark, sf),
        views.ref_raw(spark, sf),
        views.grid(spark, sf),
        MERIDIAN,
        XY_BOUNDS,
        dict(bound=H12, ref_range=(FIRST, LAST)),
        dict(bound=H12, distance=None),
    )
    return _positions(out)


def job_backfill_decoded(spark, sf):
    """The backfill on text that a decoder reads, a Python function that Spark knows nothing about."""
    path = folders.scratch_folder(spark, "text")
    o = views.obs_raw(spark, sf)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in views.OBS_FIELDS]
    o.select(F.concat_ws("\t", *parts).alias("line")).write.text(path)
    obs = decoded.decoded(spark, path, views.OBS_DECODED, views.decode_lines, splitBytes=1 << 18).drop("day", "hour")
    out = jobs.backfill_output(_backfilled(spark, sf, folders.stored(obs, "decoded")))
    return out.select("row_id", "ts", "mme_ue_s1ap_id", "id", "distance", "matched")


def job_backfill_outcomes(spark, sf):
    """From text lines to a folder for each outcome; nothing that was read is dropped."""
    path = folders.scratch_folder(spark, "outcomes")
    lines = folders.stored(shapes.decode_observations(views.obs_lines(spark, sf)), "decoded")
    out = jobs.backfill_outcomes(lines, views.ref_raw(spark, sf), bound=H12, ref_range=(FIRST, LAST))
    out = out.select("row_id", "ts", "id", "distance", "reason", "raw", "outcome")
    jobs.write_outcomes(out, path)
    return spark.read.schema(out.schema).parquet(path)


# --- hourly runs ----------------------------------------------------------------------------------

AROUND = runs.Around(RUN_AROUND, RUN_AROUND)
LATE = 30


def _hourly(spark, sf):
    """Observations and references as tables with a folder for each day."""
    obs = views.in_folders(views.obs_decoded(spark, sf), "obs", "ts")
    return obs, views.in_folders(views.ref_raw(spark, sf), "ref", "start_ts")


def _delivered(df):
    return df.select("row_id", "ts", "mme_ue_s1ap_id", "id", "distance", "matched", "day", "hour")


def job_backfill_hour(spark, sf):
    """One hour's run: its folder, as it is written, with the references of half a day around it."""
    obs, ref = _hourly(spark, sf)
    path = folders.scratch_folder(spark, "hourly")
    filled = runs.backfill_hour(obs, ref, RUN_DAY, RUN_HOUR, AROUND, bound=H12)
    out = _delivered(jobs.backfill_output(filled))
    runs.write_hour(out, path, RUN_DAY, RUN_HOUR)
    return spark.read.schema(out.schema).parquet(path)


def job_location_hour(spark, sf):
    """One hour's location run, on observations that come with an id."""
    obs = views.in_folders(_delivered_ids(spark, sf), "obs", "ts")
    ref = views.in_folders(views.ref_raw(spark, sf), "ref", "start_ts")
    grid, hour = views.grid(spark, sf), (RUN_DAY, RUN_HOUR)
    located = runs.location_hour(obs, ref, grid, MERIDIAN, *hour, AROUND, bound=H12, distance=None)
    return _positions(jobs.location_output(located, XY_BOUNDS))


def job_backfill_hours(spark, sf):
    """All hours' runs with the usual look-around, as one job; not written."""
    obs, ref = _hourly(spark, sf)
    hours = obs.where("day is not null").select("day", "hour").distinct()
    return _delivered(jobs.backfill_output(runs.backfill_hours(obs, ref, hours, bound=H12)))


def job_backfill_late(spark, sf):
    """A day's runs, written; then references that came late, and the hours that they change run again."""
    obs, ref = _hourly(spark, sf)
    path, day = folders.scratch_folder(spark, "late"), runs.hours_of_day(spark, RUN_DAY)
    is_late = (F.col("row_id") % 5 == 2) & (F.col("day") == RUN_DAY) & F.col("hour").between("09", "11")
    is_late = F.coalesce(is_late, F.lit(False))
    how = dict(around=runs.Around(LATE, LATE), bound=views.HOUR_S)
    finish = lambda df: _delivered(jobs.backfill_output(df))
    first = finish(runs.backfill_hours(obs, ref.where(~is_late), day, **how))
    folders.write_hours(first, path, "parquet")
    runs.backfill_late(obs, ref, ref.where(is_late), path, within=day, finish=finish, **how)
    return spark.read.schema(first.schema).parquet(path)


QUERIES = {
    f.__name__: f
    for f in (
        scan_delimited,
        sink_roundtrip,
        tagged_union,
        hour_slice,
        hour_paths_nested,
        day_slice,
        backfill_passthrough,
        parse_refs,
        bad_records,
        decode_neighbours,
        decode_shapes,
        basic_params,
        valid_refs,
        valid_locations,
        sentinel_filter,
        ref_time_range,
        nonzero_coords,
        require_id,
        hash_ids,
        site_key,
        point_lookup,
        sessionize_gap_cap,
        sessionize_strict,
        sessionize_defaults,
        session_summary,
        prev_next_ref,
        backfill_nearest,
        backfill_nearest_output,
        backfill_nearest_carry,
        backfill_nearest_days,
        backfill_offset,
        nearest_range_join,
        nearest_composite_key,
        session_nearest_start,
        session_nearest_pair,
        session_nearest_dedup,
        segment_last_in_window,
        segment_latest_in_window,
        location_nearest,
        location_nearest_preconverted,
        session_location,
        coord_convert,
        coord_convert_files,
        merge_neighbours,
        merge_neighbours_long,
        quality_backfill,
        quality_location,
        quality_sessions,
        group_by_id,
        id_totals,
        refs_per_key,
        refs_per_conn,
        refs_total,
        rows_per_key,
        word_count,
        word_totals,
        sort_by_time,
        hour_parse,
        format_duration,
        lonlat_text,
        coord_system,
        project_xy,
        job_backfill,
        job_backfill_defaults,
        job_backfill_merged,
        job_backfill_written,
        job_location,
        job_location_written,
        job_chain,
        job_backfill_decoded,
        job_backfill_outcomes,
        job_backfill_hour,
        job_location_hour,
        job_backfill_hours,
        job_backfill_late,
    )
}
