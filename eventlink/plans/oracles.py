"""The registered queries in SQL, written independently of the Spark plans.

Joins are brute-force range joins ranked by distance and tie rule; sessions walk the rows of a key one
by one.
"""

from __future__ import annotations

from eventlink.plans.views import sql

H12 = "43200000000"
HOUR = "3600000000"
DAYS30 = "2592000000000"
FIRST, LAST = "timestamp '2024-01-03 06:00:00'", "timestamp '2024-01-28 18:00:00'"
RUN_FIRST, RUN_LAST = "timestamp '2024-01-14 22:00:00'", "timestamp '2024-01-15 23:00:00'"

LATER = "rt desc, case when rt <= ot then -rid else rid end"
EARLIER = "rt, case when rt <= ot then -rid else rid end"
ROW_ORDER = "rid"


def best(bound, tie, left="obs", right="ref", on="o.k = r.k", ot="epoch_us(o.ts)",
         rt="epoch_us(r.ts)", take="r.id hit", extra=""):
    """CTE ``best``: per observation row_id the winning reference and its distance."""
    return f"""
    pairs as (select o.row_id, {ot} ot, {rt} rt, r.row_id rid, {take}
        from {left} o join {right} r on {on} and abs({rt} - {ot}) < {bound} {extra}),
    best as (select * from (select *, abs(rt - ot) distance,
            row_number() over (partition by row_id order by abs(rt - ot), {tie}) rn from pairs)
        where rn = 1)"""


def walk(left="obs", gap=H12, cap="3", near="<="):
    """CTE ``sess``: session_seq and session_pos of every row, by walking each key's rows."""
    more = f"and w.session_pos < {cap}" if cap else ""
    same = f"epoch_us(n.ts) - epoch_us(w.ts) {near} {gap} {more}"
    return f"""
    numbered as (select *, row_number() over (partition by k order by ts, row_id) rn from {left}),
    sess as (
        select row_id, k, ts, rn, 1::bigint session_seq, 1::bigint session_pos
        from numbered where rn = 1
        union all
        select n.row_id, n.k, n.ts, n.rn,
            case when {same} then w.session_seq else w.session_seq + 1 end,
            case when {same} then w.session_pos + 1 else 1 end
        from sess w join numbered n on n.k = w.k and n.rn = w.rn + 1)"""


HEADS = """
    heads as (select k, session_seq, min(ts) start_ts, arg_min(row_id, session_pos) row_id,
            max(ts) end_ts, count(*) n_rows
        from sess group by k, session_seq),
    starts as (select a.*, b.start_ts next_start_ts, a.start_ts ts
        from heads a left join heads b on b.k = a.k and b.session_seq = a.session_seq + 1)"""

LIMIT = "and (r.ts <= o.ts or o.next_start_ts is null or r.ts < o.next_start_ts)"

FILLED = """select o.row_id, o.k, o.ts, coalesce(b.hit, o.id) id, b.distance,
    b.hit is not null matched from obs o left join best b using (row_id)"""

CONVERTED = """
    seen as (select *, floor(lon * 10)::int cx, floor(lat * 10)::int cy,
            case locate_system when 1 then 'Bd' when 2 then 'Gd' else 'Gps' end sys
        from {source} where lon <> 0 and lat <> 0),
    gps as (select s.* exclude (lon, lat, cx, cy, sys),
            s.sys = 'Gps' or g.dlon is not null converted,
            case when s.sys = 'Gps' then s.lon else round(s.lon + g.dlon, 6) end lon,
            case when s.sys = 'Gps' then s.lat else round(s.lat + g.dlat, 6) end lat
        from seen s left join grid g on g.system = s.sys and g.cell_x = s.cx and g.cell_y = s.cy)"""

GPS = CONVERTED.format(source="ref")

# Transverse Mercator, Snyder (1987) eq. 8-9 to 8-13, on the WGS84 ellipsoid, central meridian 99.
XY = """
    xy0 as (select *, radians(lat) phi, f * (2 - f) e2, (lon - 99.0) * (pi() / 180) * cos(radians(lat)) a
        from {source}, (select 1::double / 298.257223563::double f)),
    xy1 as (select *, e2 / (1 - e2) ep2, pow(tan(phi), 2) t, 6378137.0 / sqrt(1 - e2 * pow(sin(phi), 2)) n,
        6378137.0 * ((1 - e2/4 - 3*pow(e2,2)/64 - 5*pow(e2,3)/256) * phi
          - (3*e2/8 + 3*pow(e2,2)/32 + 45*pow(e2,3)/1024) * sin(2*phi)
          + (15*pow(e2,2)/256 + 45*pow(e2,3)/1024) * sin(4*phi) - 35*pow(e2,3)/3072 * sin(6*phi)) m
        from xy0),
    xy2 as (select *, ep2 * pow(cos(phi), 2) c from xy1),
    xy as (select *,
        500000 + n * (a + (1 - t + c) * pow(a,3)/6
          + (5 - 18*t + t*t + 72*c - 58*ep2) * pow(a,5)/120) x,
        m + n * tan(phi) * (pow(a,2)/2 + (5 - t + 9*c + 4*c*c) * pow(a,4)/24
          + (61 - 58*t + t*t + 600*c - 330*ep2) * pow(a,6)/720) y
        from xy2)"""

IN_BOUNDS = "x between 500000 and 800000 and y between 2800000 and 3000000"

# Backfill over the raw records: rows without a time cannot match, rows without a type are not there.
RAW_BEST = best(
    H12, LATER, "obs_raw", "ref_raw",
    "o.mme_ue_s1ap_id = r.mme_ue_s1ap_id and o.eci // 256 = r.eci // 256",
    "o.ts * 1000", "r.start_ts * 1000",
    extra=f"""and o.ts <> -1 and r.start_ts <> -1 and r.end_ts <> -1 and r.id <> '\\N'
        and r.start_ts between (epoch_us({FIRST}) // 1000) and (epoch_us({LAST}) // 1000)""",
)
RAW_FILLED = """
    filled as (select o.* exclude (id), coalesce(b.hit, o.id) id, b.distance,
        b.hit is not null matched from obs_raw o left join best b using (row_id)
        where o.event_type is not null)"""


def located(source, gps="gps"):
    """CTE ``located``: location of every row of ``source`` that has an id."""
    return f"""
    {CONVERTED.format(source="ref_raw")},
    lpairs as (select o.row_id, o.ts ot, r.start_ts rt, r.row_id rid, r.lon, r.lat, r.converted
        from {source} o join {gps} r on o.id = r.id and o.ts <> -1 and r.start_ts <> -1
        and r.end_ts <> -1 and r.id <> '' and abs(r.start_ts - o.ts) * 1000 < {H12}),
    lbest as (select * from (select *, row_number() over (
            partition by row_id order by abs(rt - ot), {LATER}) rn from lpairs) where rn = 1),
    located as (select o.row_id, o.ts, o.id, b.lon, b.lat, b.converted
        from {source} o left join lbest b using (row_id) where coalesce(o.id, '') <> '')"""


DELIVERED = """
    delivered as (select * exclude (id), 'u' || mme_ue_s1ap_id || '_' || row_id % 2 id from obs_raw)"""

POSITIONS = f"""select row_id, ts, id, lon, lat, round(x, 3) x, round(y, 3) y from xy where {IN_BOUNDS}"""

RATIO = "case when matched + unmatched > 0 then matched::double / (matched + unmatched) end ratio"

PARSED = """
    parts as (select row_id, id,
        case when row_id % 10 <> 1 then case when row_id % 23 = 0 then 'none' else eci::varchar end end eci_text,
        case when row_id % 10 not in (0, 1) then mme_ue_s1ap_id end mme_ue_s1ap_id,
        case when row_id % 10 not in (0, 1) then start_ts end start_ts from ref_raw),
    parsed as (select row_id, id, try_cast(eci_text as bigint) eci, mme_ue_s1ap_id, start_ts,
        coalesce(eci_text = 'none', false) is_bad from parts)"""

SESSION_HIT = """select s.row_id, s.k, s.session_seq, h.hit id from sess s
    left join hits h using (k, session_seq)"""

START_HITS = """
    hits as (select s.k, s.session_seq, b.hit from starts s join best b using (row_id))"""

SESSION_ROWS = """select row_id, k, ts, session_seq, session_pos from sess"""

WORDS = r"""(select unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) word from documents)"""

COUNTED_REFS = r"""(select * from ref_raw where mme_ue_s1ap_id <> 4294967295 and eci <> 4294967295
    and id is not null and id <> '\N')"""

MERGED = """
    merged as (select ts, eci, mme_ue_s1ap_id, mme_group_id, mme_code, min(row_id) row_id,
            arg_min(coalesce(id, chr(0)), row_id) id, string_agg(cell, ',' order by row_id) cells,
            count(*) n_rsrp
        from obs_parts group by all)"""

HOURS = """case when ts <> -1 then strftime(make_timestamp(ts * 1000), '%Y%m%d') end "day",
    case when ts <> -1 then strftime(make_timestamp(ts * 1000), '%H') end "hour\""""

COUNTERS = """count(*) over () rows_merged, sum((hit)::int) over ()::bigint matched,
    sum((ts <> -1 and not hit)::int) over ()::bigint unmatched, sum((ts = -1)::int) over ()::bigint no_time"""

# What a run read, as the two quality reports count it.
READ_BACKFILL = f"""(select count_if(event_type is not null)::bigint rows_ok, count_if(event_type is null)::bigint rows_bad from obs_raw),
    (select count_if(valid)::bigint refs_ok, count_if(not valid)::bigint refs_bad from (select
        coalesce(start_ts <> -1 and end_ts <> -1 and id <> '\\N', false) valid from ref_raw
        where start_ts between (epoch_us({FIRST}) // 1000) and (epoch_us({LAST}) // 1000)))"""
READ_LOCATION = """(select count_if(coalesce(id, '') <> '')::bigint rows_ok, count_if(coalesce(id, '') = '')::bigint rows_bad from delivered),
    (select count_if(valid)::bigint refs_ok, count_if(not valid)::bigint refs_bad from (select coalesce(start_ts <> -1
        and end_ts <> -1 and id <> '' and lon <> 0 and lat <> 0, false) valid from ref_raw))"""

ROW_HOUR = """strftime(make_timestamp(ts * 1000), '%Y%m%d') "day", strftime(make_timestamp(ts * 1000), '%H') "hour\""""
RUN_HOUR = "ts <> -1 and strftime(make_timestamp(ts * 1000), '%Y%m%d%H') = '2024011510'"
RUN_DAY = "ts <> -1 and strftime(make_timestamp(ts * 1000), '%Y%m%d') = '20240115'"


def hourly(bound, advance, later, only="ts <> -1"):
    """The backfill of every hour by itself: references from ``advance`` minutes before to ``later`` minutes after it."""
    hour = "o.ts // 3600000 * 3600000"
    pairs = best(
        bound, LATER, "obs_raw", "ref_raw",
        "o.mme_ue_s1ap_id = r.mme_ue_s1ap_id and o.eci // 256 = r.eci // 256",
        "o.ts * 1000", "r.start_ts * 1000",
        extra=f"""and o.ts <> -1 and r.start_ts <> -1 and r.end_ts <> -1 and r.id <> '\\N'
        and r.start_ts between {hour} - {advance * 60000} and {hour} + {(later + 60) * 60000}""",
    )
    return f""", {pairs}, {RAW_FILLED} select row_id, ts, mme_ue_s1ap_id, id, distance, matched, {ROW_HOUR}
        from filled where coalesce(id, '') <> '' and {only}"""


SHAPES = """
    shapes as (select *, reason is not null is_bad from (select o.*, line,
        case when row_id % 61 = 0 or row_id % 67 = 0 then 'shape' when row_id % 53 = 0 then 'lists'
            when row_id % 59 = 0 or (row_id % 71 = 0 and row_id % 4 > 1) then 'number' end reason
        from obs_raw o join obs_lines using (row_id)))"""

ORACLES = {
    "scan_delimited": sql("select row_id, k, (epoch_us(ts) // 1000) ts, id from obs", "obs"),
    "sink_roundtrip": sql(
        "select *, strftime(ts, '%Y%m%d') \"day\", strftime(ts, '%H') \"hour\" from obs", "obs"
    ),
    "tagged_union": sql(
        """select row_id, k, ts, id, null::double lon, null::double lat, 'obs' kind from obs
        union all select row_id, k, ts, id, lon, lat, 'ref' from ref""",
        "obs",
        "ref",
    ),
    "hour_slice": sql(
        f"""select row_id, k, ts, strftime(ts, '%Y%m%d') "day", strftime(ts, '%H') "hour"
        from ref where ts between {RUN_FIRST} and {RUN_LAST}""",
        "ref",
    ),
    "hour_paths_nested": sql(
        """select row_id, k, epoch_us(ts) // 1000 ts, strftime(ts, '%Y%m%d/%H') folder from obs
        where strftime(ts, '%Y%m%d%H') in ('2024011509', '2024011510', '2024011512')""",
        "obs",
    ),
    "day_slice": sql(
        """select row_id, k, ts, strftime(ts, '%Y%m%d') "day", strftime(ts, '%H') "hour"
        from ref where ts >= timestamp '2024-01-15' and ts < timestamp '2024-01-16'""",
        "ref",
    ),
    "backfill_passthrough": sql(
        "select row_id, ts, id, null::bigint distance, false matched from obs_raw", "obs_raw"
    ),
    "parse_refs": sql(f", {PARSED} select * from parsed", "ref_raw"),
    "bad_records": sql(
        f", {PARSED} select row_id, id, eci, case when is_bad then 'bad' else 'good' end kind from parsed",
        "ref_raw",
    ),
    "decode_neighbours": """select l_orderkey, 2::bigint n_cells, l_partkey::int earfcn_0,
        l_linenumber::int pci_0, l_suppkey::int earfcn_1, (l_linenumber + 1)::int pci_1,
        l_quantity rsrp_0, l_discount rsrp_1, false is_bad from lineitem""",
    "decode_shapes": sql(
        f""", {SHAPES} select row_id, case when not is_bad then ts end ts,
            case when not is_bad then mme_ue_s1ap_id end mme_ue_s1ap_id,
            case when not is_bad then coalesce(event_type, '') end event_type, case when not is_bad then mme_code end mme_code,
            case when not is_bad then eci end eci, case when not is_bad then mme_group_id end mme_group_id,
            case when not is_bad then coalesce(id, '') end id,
            case when not is_bad then (row_id % 3000)::int end sc_earfcn, case when not is_bad then (row_id % 504)::int end sc_pci,
            case when not is_bad then -(row_id % 60) - 40.5::double end sc_rsrp,
            case when not is_bad then array_to_string(list_transform(range(1, row_id % 4 + 1), lambda i:
                (row_id % 3000 + i) || ':' || (row_id + i) % 504 || ':' || (-i - 50.25::double)), ' ') end nc,
            is_bad, reason, case when is_bad then line end raw from shapes""",
        "obs_raw",
        "obs_lines",
    ),
    "basic_params": sql(
        """select ts, mme_ue_s1ap_id, coalesce(event_type, '') event_type, mme_code, eci,
        mme_group_id, coalesce(id, '') id from obs_raw""",
        "obs_raw",
    ),
    "valid_refs": sql(
        r"""select row_id, id, start_ts, end_ts from ref_raw
        where start_ts <> -1 and end_ts <> -1 and id is not null and id <> '\N'""",
        "ref_raw",
    ),
    "valid_locations": sql(
        """select row_id, id, start_ts, end_ts from ref_raw
        where start_ts <> -1 and end_ts <> -1 and id is not null and id <> ''""",
        "ref_raw",
    ),
    "sentinel_filter": sql(
        """select row_id, mme_ue_s1ap_id, eci from ref_raw
        where mme_ue_s1ap_id <> 4294967295 and eci <> 4294967295""",
        "ref_raw",
    ),
    "ref_time_range": sql(
        f"select row_id, k, ts from ref where ts >= {FIRST} and ts <= {LAST}", "ref"
    ),
    "nonzero_coords": sql("select row_id, lon, lat from ref where lon <> 0 and lat <> 0", "ref"),
    "require_id": sql(
        "select row_id, id from obs_raw where id is not null and id <> ''", "obs_raw"
    ),
    "hash_ids": sql("select row_id, sha256('pepper' || sub_id) id from ref", "ref"),
    "site_key": sql("select row_id, eci, eci // 256 site from ref_raw", "ref_raw"),
    "point_lookup": sql(
        """select trunc(start_ts / 1000.0)::bigint ts_s, mme_ue_s1ap_id, id from ref_raw
        where mme_ue_s1ap_id = 7""",
        "ref_raw",
    ),
    "sessionize_gap_cap": sql(f", {walk()} {SESSION_ROWS}", "obs", recursive=True),
    "sessionize_strict": sql(
        f", {walk(cap=None, near='<')} {SESSION_ROWS}", "obs", recursive=True
    ),
    "sessionize_defaults": sql(
        f", {walk(gap='30000000', cap='150')} {SESSION_ROWS}", "obs", recursive=True
    ),
    "session_summary": sql(
        f""", {walk()}, {HEADS} select k, session_seq, start_ts, row_id start_row_id, end_ts, n_rows,
        next_start_ts from starts""",
        "obs",
        recursive=True,
    ),
    "prev_next_ref": sql(
        """, before as (select o.row_id, max_by(r.id, (r.ts, r.row_id)) id, max(r.ts) ts
            from obs o join ref r on r.k = o.k and r.ts <= o.ts group by o.row_id),
        after as (select o.row_id, min_by(r.id, (r.ts, r.row_id)) id, min(r.ts) ts
            from obs o join ref r on r.k = o.k and r.ts > o.ts group by o.row_id)
        select o.row_id, o.k, o.ts, b.id prev_id, b.ts prev_ts, a.id next_id, a.ts next_ts
        from obs o left join before b using (row_id) left join after a using (row_id)""",
        "obs",
        "ref",
    ),
    "backfill_nearest": sql(f", {best(H12, LATER)} {FILLED}", "obs", "ref"),
    "backfill_nearest_output": sql(
        f", {best(H12, LATER)} select row_id, id from ({FILLED}) where id is not null and id <> ''",
        "obs",
        "ref",
    ),
    "backfill_nearest_carry": sql(f", {best(H12, LATER)} {FILLED}", "obs", "ref"),
    "backfill_nearest_days": sql(
        f""", {best(DAYS30, LATER, "obs_day", "ref_day")} select o.row_id, o.k, o.ts, b.hit id, b.distance
        from obs_day o left join best b using (row_id)""",
        "obs_day",
        "ref_day",
    ),
    "backfill_offset": sql(
        f", {best(H12, LATER, rt=f'epoch_us(r.ts) - {HOUR}')} {FILLED}", "obs", "ref"
    ),
    "nearest_range_join": sql(
        f""", {best(DAYS30, ROW_ORDER, "obs_day", "ref_day")} select o.row_id, o.k, o.ts, b.hit id,
        b.distance from obs_day o left join best b using (row_id)""",
        "obs_day",
        "ref_day",
    ),
    "nearest_composite_key": sql(
        ", "
        + best(
            H12, ROW_ORDER, "obs_raw", "ref_raw",
            "o.mme_ue_s1ap_id = r.mme_ue_s1ap_id and o.eci // 256 = r.eci // 256",
            "o.ts * 1000", "r.start_ts * 1000", "r.row_id hit",
            r"""and o.ts > 0 and r.start_ts > 0 and r.mme_ue_s1ap_id <> 4294967295
            and r.eci <> 4294967295 and r.id <> '\N'""",
        )
        + """ select o.row_id, o.ts, o.eci // 256 site, o.mme_ue_s1ap_id, b.hit ref_row, b.distance
        from obs_raw o left join best b using (row_id)""",
        "obs_raw",
        "ref_raw",
    ),
    "session_nearest_start": sql(
        f", {walk()}, {HEADS}, {best(H12, EARLIER, 'starts', extra=LIMIT)}, {START_HITS} {SESSION_HIT}",
        "obs",
        "ref",
        recursive=True,
    ),
    "session_nearest_pair": sql(
        f""", {walk()}, {best(H12, EARLIER, "sess")},
        hits as (select k, session_seq, min_by(hit, (distance, ts, row_id)) hit
            from sess s join best b using (row_id) group by k, session_seq) {SESSION_HIT}""",
        "obs",
        "ref",
        recursive=True,
    ),
    "session_nearest_dedup": sql(
        f""", once as (select k, ts, max(row_id) row_id, max_by(id, row_id) id from ref_day group by k, ts),
        {walk("obs_day")}, {HEADS}, {best(DAYS30, EARLIER, "starts", "once")}, {START_HITS} {SESSION_HIT}""",
        "obs_day",
        "ref_day",
        recursive=True,
    ),
    "segment_last_in_window": sql(
        f""", {walk(cap=None, near="<")},
        hits as (select s.k, s.session_seq, max_by(r.id, (s.ts, s.row_id, r.listed)) hit
            from sess s join ref_listed r on s.k = r.k and abs(epoch_us(r.ts) - epoch_us(s.ts)) < {H12}
                and r.id is not null
            group by s.k, s.session_seq) {SESSION_HIT}""",
        "obs",
        "ref",
        "ref_listed",
        recursive=True,
    ),
    "segment_latest_in_window": sql(
        f""", {walk(cap=None, near="<")},
        hits as (select s.k, s.session_seq, max_by(r.id, (s.ts, s.row_id, r.ts, r.row_id)) hit
            from sess s join ref r on s.k = r.k and abs(epoch_us(r.ts) - epoch_us(s.ts)) < {H12}
            group by s.k, s.session_seq) {SESSION_HIT}""",
        "obs",
        "ref",
        recursive=True,
    ),
    "location_nearest": sql(
        f""", {GPS}, {best(H12, LATER, right="gps", take="r.lon, r.lat, r.converted")}
        select o.row_id, o.k, o.ts, b.lon, b.lat, b.converted from obs o left join best b using (row_id)""",
        "obs",
        "ref",
        "grid",
    ),
    "location_nearest_preconverted": sql(
        f""", {GPS}, {best(H12, LATER, right="gps", take="r.lon, r.lat", extra="and r.converted")}
        select o.row_id, o.k, o.ts, b.lon, b.lat, case when b.lon is not null then true end converted
        from obs o left join best b using (row_id)""",
        "obs",
        "ref",
        "grid",
    ),
    "session_location": sql(
        f""", {walk()}, {HEADS}, {GPS},
        {best(H12, EARLIER, "starts", "gps", take="r.lon, r.lat", extra="and r.converted " + LIMIT)}
        select s.row_id, s.k, s.session_seq, b.lon, b.lat from sess s
        join starts h using (k, session_seq) join best b on b.row_id = h.row_id""",
        "obs",
        "ref",
        "grid",
        recursive=True,
    ),
    "coord_convert": sql(
        f", {GPS} select row_id, lon, lat, locate_system, converted from gps", "ref", "grid"
    ),
    "coord_convert_files": sql(
        f", {GPS} select row_id, lon, lat, locate_system, converted from gps", "ref", "grid"
    ),
    "merge_neighbours": """select l_orderkey, first(l_suppkey order by {0}) first_supp,
        string_agg(l_partkey::varchar, ',' order by {0}) cells,
        string_agg(l_quantity::int::varchar, ',' order by {0}) rsrp, count(*) n_merged
        from lineitem group by l_orderkey""".format(
        "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
    ),
    "merge_neighbours_long": """select l_orderkey, row_number() over (partition by l_orderkey order by {0}) pos,
        l_partkey::varchar cells, l_quantity::int::varchar rsrp from lineitem""".format(
        "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
    ),
    "quality_backfill": sql(
        f""", {RAW_BEST}, {RAW_FILLED}, o as (select count_if(event_type is not null) rows_ok,
            count_if(event_type is null) rows_bad from obs_raw),
        r as (select count_if(valid) refs_ok, count_if(not valid) refs_bad from (select
            coalesce(start_ts <> -1 and end_ts <> -1 and id <> '\\N', false) valid from ref_raw
            where start_ts between (epoch_us({FIRST}) // 1000) and (epoch_us({LAST}) // 1000))),
        f as (select count(*) rows_merged, count_if(matched) matched,
            count_if(ts <> -1 and not matched) unmatched, count_if(ts = -1) no_time from filled)
        select rows_ok::bigint rows_ok, rows_bad::bigint rows_bad, rows_merged, refs_ok::bigint refs_ok,
            refs_bad::bigint refs_bad, matched::bigint matched, unmatched::bigint unmatched,
            no_time::bigint no_time, {RATIO} from o, r, f""",
        "obs_raw",
        "ref_raw",
    ),
    "quality_location": sql(
        f""", {RAW_BEST}, {RAW_FILLED}, {located("filled")},
        o as (select count_if(coalesce(id, '') <> '') rows_ok, count_if(coalesce(id, '') = '') rows_bad
            from filled),
        r as (select count_if(valid) refs_ok, count_if(not valid) refs_bad from (select coalesce(start_ts <> -1
            and end_ts <> -1 and id <> '' and lon <> 0 and lat <> 0, false) valid from ref_raw)),
        f as (select count(*) rows_merged, count_if(lon is not null) matched,
            count_if(ts <> -1 and lon is null) unmatched, count_if(ts = -1) no_time,
            count_if(coalesce(converted, false)) converted_ok, count_if(not coalesce(converted, true)) converted_bad
            from located)
        select rows_ok::bigint rows_ok, rows_bad::bigint rows_bad, rows_merged, refs_ok::bigint refs_ok,
            refs_bad::bigint refs_bad, matched::bigint matched, unmatched::bigint unmatched,
            no_time::bigint no_time, converted_ok::bigint converted_ok,
            converted_bad::bigint converted_bad, {RATIO} from o, r, f""",
        "ref",
        "grid",
        "obs_raw",
        "ref_raw",
    ),
    "quality_sessions": sql(
        f""", {walk()}, {HEADS}, {best(H12, EARLIER, 'starts', extra=LIMIT)},
        counted as (select count_if(b.hit is not null)::bigint sessions_matched,
            count_if(b.hit is null)::bigint sessions_unmatched,
            coalesce(sum(n_rows) filter (b.hit is not null), 0)::bigint matched,
            coalesce(sum(n_rows) filter (b.hit is null), 0)::bigint unmatched
            from starts left join best b using (row_id))
        select *, {RATIO} from counted""",
        "obs",
        "ref",
        recursive=True,
    ),
    "group_by_id": sql(
        f""", {best(H12, ROW_ORDER, take="r.sub_id hit")} select b.hit id, count(*) n_rows, min(o.ts) first_ts,
        max(o.ts) last_ts, b.hit is not null is_matched
        from obs o left join best b using (row_id) group by b.hit""",
        "obs",
        "ref",
    ),
    "id_totals": sql(
        f""", {best(H12, ROW_ORDER, take="r.sub_id hit")} select count(b.hit) n_success,
        count(*) - count(b.hit) n_fail, count(distinct b.hit) n_ids
        from obs o left join best b using (row_id)""",
        "obs",
        "ref",
    ),
    "refs_per_key": sql(
        f"select eci // 256 site, mme_ue_s1ap_id, count(*) n_rows from {COUNTED_REFS} group by all", "ref_raw"
    ),
    "refs_per_conn": sql(
        f"select mme_ue_s1ap_id, count(*) n_rows from {COUNTED_REFS} group by all", "ref_raw"
    ),
    "refs_total": sql(f"select count(*) n_rows from {COUNTED_REFS}", "ref_raw"),
    "rows_per_key": sql(
        """select row_id, k, ts, row_number() over (partition by k order by ts, row_id) pos from obs""",
        "obs",
    ),
    "word_count": f"select word, count(*) n from {WORDS} where word <> '' group by word",
    "word_totals": f"""select count(*)::bigint words, count(distinct word)::bigint distinct_words
        from {WORDS} where word <> ''""",
    "sort_by_time": sql("select ts, row_id, k from obs order by ts, row_id", "obs"),
    "hour_parse": sql(
        "select row_id, date_trunc('hour', ts) hour_ts, strftime(ts, '%y%m%d') short_day from ref",
        "ref",
    ),
    "format_duration": sql(
        """, s as (select row_id, ((epoch_us(ts) // 1000) - (epoch_us(timestamp '2024-01-01') // 1000)) // 1000 s from ref)
        select row_id, (s // 3600) || ':' || (s // 60 % 60) || ':' || (s % 60) elapsed from s""",
        "ref",
    ),
    "lonlat_text": sql(
        "select row_id, lon::varchar || ',' || lat::varchar as text, lon, lat from ref", "ref"
    ),
    "coord_system": sql(
        """select row_id, case locate_system when 0 then 'Gps' when 1 then 'Bd' when 2 then 'Gd'
        else 'Gps' end as system from ref""",
        "ref",
    ),
    "project_xy": sql(
        f""", located_ref as (select * from ref where lon <> 0), {XY.format(source="located_ref")}
        select row_id, round(x, 3) x, round(y, 3) y from xy""",
        "ref",
    ),
    "job_backfill": sql(
        f""", {RAW_BEST}, {RAW_FILLED} select row_id, ts, mme_ue_s1ap_id, id, distance, matched
        from filled where coalesce(id, '') <> ''""",
        "obs_raw",
        "ref_raw",
    ),
    "job_backfill_defaults": sql(
        f""", {best(
            "30000000", LATER, "obs_raw", "ref_raw",
            "o.mme_ue_s1ap_id = r.mme_ue_s1ap_id and o.eci // 256 = r.eci // 256",
            "o.ts * 1000", "r.start_ts * 1000",
            extra="and o.ts <> -1 and r.start_ts <> -1 and r.end_ts <> -1 and r.id <> '\\N'",
        )}, {RAW_FILLED} select row_id, ts, mme_ue_s1ap_id, id, distance, matched
        from filled where coalesce(id, '') <> ''""",
        "obs_raw",
        "ref_raw",
    ),
    "job_backfill_merged": sql(
        f""", {MERGED}, {best(
            H12, LATER, "merged", "ref_raw",
            "o.mme_ue_s1ap_id = r.mme_ue_s1ap_id and o.eci // 256 = r.eci // 256",
            "o.ts * 1000", "r.start_ts * 1000",
            extra=f"""and o.ts <> -1 and r.start_ts <> -1 and r.end_ts <> -1 and r.id <> '\\N'
            and r.start_ts between (epoch_us({FIRST}) // 1000) and (epoch_us({LAST}) // 1000)""",
        )}, named as (select m.*, b.hit, coalesce(b.hit, nullif(m.id, chr(0))) own
            from merged m left join best b using (row_id))
        select row_id, ts, mme_ue_s1ap_id, own id, hit is not null matched, n_rsrp n_merged, cells, n_rsrp
        from named where coalesce(own, '') <> ''""",
        "obs_raw",
        "obs_parts",
        "ref_raw",
    ),
    "job_backfill_written": sql(
        f""", {RAW_BEST}, {RAW_FILLED}, counted as (select *, {COUNTERS}
            from (select row_id, ts, id, matched hit from filled))
        select row_id, ts, sha256('pepper' || id) id, hit matched, {HOURS}, rows_merged,
            matched n_matched, unmatched, no_time, rows_ok, rows_bad, refs_ok, refs_bad
        from counted, {READ_BACKFILL} where coalesce(id, '') <> ''""",
        "obs_raw",
        "ref_raw",
    ),
    "job_location_written": sql(
        f""", {DELIVERED}, {located("delivered")}, {XY.format(source="located")},
        counted as (select *, {COUNTERS}, sum(coalesce(converted, false)::int) over ()::bigint converted_ok,
            sum((not coalesce(converted, true))::int) over ()::bigint converted_bad
            from (select *, lon is not null hit from xy))
        select row_id, ts, sha256('pepper' || id) id, lon, lat, round(x, 3) x, round(y, 3) y, {HOURS},
            rows_merged, matched n_matched, unmatched, no_time, converted_ok, converted_bad, rows_ok, rows_bad,
            refs_ok, refs_bad
        from counted, {READ_LOCATION} where {IN_BOUNDS}""",
        "ref",
        "grid",
        "obs_raw",
        "ref_raw",
    ),
    "job_location": sql(
        f", {DELIVERED}, {located('delivered')}, {XY.format(source='located')} {POSITIONS}",
        "ref",
        "grid",
        "obs_raw",
        "ref_raw",
    ),
    "job_chain": sql(
        f", {RAW_BEST}, {RAW_FILLED}, {located('filled')}, {XY.format(source='located')} {POSITIONS}",
        "ref",
        "grid",
        "obs_raw",
        "ref_raw",
    ),
    "job_backfill_decoded": sql(
        f""", {RAW_BEST}, {RAW_FILLED} select row_id, ts, mme_ue_s1ap_id, id, distance, matched
        from filled where coalesce(id, '') <> ''""",
        "obs_raw",
        "ref_raw",
    ),
    "job_backfill_outcomes": sql(
        f""", {SHAPES}, {RAW_BEST} select s.row_id, case when not is_bad then ts end ts,
            case when not is_bad then coalesce(b.hit, s.id, '') end id, case when not is_bad then b.distance end distance,
            reason, case when is_bad then line end raw,
            case when is_bad then 'bad' when b.hit is not null then 'filled' else 'unmatched' end outcome
        from shapes s left join best b using (row_id)""",
        "obs_raw",
        "obs_lines",
        "ref_raw",
    ),
    "job_backfill_hour": sql(hourly(H12, 720, 720, RUN_HOUR), "obs_raw", "ref_raw"),
    "job_backfill_hours": sql(hourly(H12, 20, 0), "obs_raw", "ref_raw"),
    "job_backfill_late": sql(hourly(HOUR, 30, 30, RUN_DAY), "obs_raw", "ref_raw"),
    "job_location_hour": sql(
        f""", {DELIVERED}, ours as (select * from delivered where {RUN_HOUR}), {located('ours')},
        {XY.format(source='located')} {POSITIONS}""",
        "ref",
        "grid",
        "obs_raw",
        "ref_raw",
    ),
}
