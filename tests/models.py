"""Small plain-Python statements of the semantics, to test against.  Times are milliseconds."""


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=lambda r: (r[1], r[2])) for k, v in out.items()}


def sessions(rows, gap, cap, inclusive=True):
    """rows (key, t, id) → {id: (seq, pos)}"""
    out = {}
    for group in by_key([r for r in rows if r[0] is not None and r[1] != -1]).values():
        seq, size, last = 0, 0, None
        for _, t, i in group:
            near = last is not None and (t - last <= gap if inclusive else t - last < gap)
            if near and (cap is None or size < cap):
                size += 1
            else:
                seq, size = seq + 1, 1
            out[i] = (seq, size)
            last = t
    return out


def candidates(refs, k, t):
    """(distance, before?, id) of the two neighbours: last at or before t, first after t."""
    mine = sorted((rt, ri) for rk, rt, ri in refs if rk == k and rt != -1)
    before = [r for r in mine if r[0] <= t]
    after = [r for r in mine if r[0] > t]
    return before, after


def nearest(rows, refs, bound, tie):
    out = {}
    for k, t, i in rows:
        out[i] = None
        if k is None or t == -1:
            continue
        before, after = candidates(refs, k, t)
        if tie == "first":
            best = min(((abs(rt - t), ri) for rt, ri in before + after), default=None)
            if best and best[0] < bound:
                out[i] = best[1]
            continue
        picks = []
        if before:
            picks.append((t - before[-1][0], 1 if tie == "later" else 0, before[-1][1]))
        if after:
            picks.append((after[0][0] - t, 0 if tie == "later" else 1, after[0][1]))
        best = min(picks, default=None)
        if best and best[0] < bound:
            out[i] = best[2]
    return out


def session_members(rows, gap, cap):
    seqs = sessions(rows, gap, cap)
    out = {}
    for r in sorted((r for r in rows if r[2] in seqs), key=lambda r: (r[1], r[2])):
        out.setdefault((r[0], seqs[r[2]][0]), []).append(r)
    return out


def session_start(rows, refs, gap, cap, bound, before_next=True):
    groups, out = session_members(rows, gap, cap), {}
    for (k, seq), members in groups.items():
        start = members[0][1]
        following = groups.get((k, seq + 1))
        before, after = candidates(refs, k, start)
        if before_next and following:
            after = [r for r in after if r[0] < following[0][1]]
        picks = []
        if before:
            picks.append((start - before[-1][0], 0, before[-1][1]))
        if after:
            picks.append((after[0][0] - start, 1, after[0][1]))
        best = min(picks, default=None)
        hit = best[2] if best and best[0] < bound else None
        out.update({m[2]: hit for m in members})
    return out


def session_pair(rows, refs, gap, cap, bound):
    near, out = nearest(rows, refs, bound, "earlier"), {}
    at = {ri: rt for _, rt, ri in refs}
    for members in session_members(rows, gap, cap).values():
        pairs = [(abs(at[near[i]] - t), t, i) for _, t, i in members if near[i] is not None]
        hit = near[min(pairs)[2]] if pairs else None
        out.update({m[2]: hit for m in members})
    return out


def segment_last(rows, refs, gap, window):
    out, seqs = {}, sessions(rows, gap, None, inclusive=False)
    groups = {}
    for r in sorted((r for r in rows if r[2] in seqs), key=lambda r: (r[1], r[2])):
        groups.setdefault((r[0], seqs[r[2]][0]), []).append(r)
    for (k, _), members in groups.items():
        hit = None
        for _, t, _i in members:
            for rt, ri in sorted((rt, ri) for rk, rt, ri in refs if rk == k and rt != -1):
                if abs(rt - t) < window:
                    hit = ri
        out.update({m[2]: hit for m in members})
    return out


def segment_last_listed(rows, refs, gap, window):
    """``refs`` in the order of their list: the last assignment wins."""
    out, seqs = {}, sessions(rows, gap, None, inclusive=False)
    groups = {}
    for r in sorted((r for r in rows if r[2] in seqs), key=lambda r: (r[1], r[2])):
        groups.setdefault((r[0], seqs[r[2]][0]), []).append(r)
    for (k, _), members in groups.items():
        hit = None
        for _, t, _i in members:
            for rk, rt, ri in refs:
                if rk == k and rt != -1 and abs(rt - t) < window:
                    hit = ri
        out.update({m[2]: hit for m in members})
    return out
