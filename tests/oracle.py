"""Plain restatements of the semantics, for small inputs."""

W = 3_600_000
# trip: (bike, start, end, started, ended, seq)


def time_order(trips):
    return sorted(trips, key=lambda t: (t[3], t[4], t[5]))


def by_bike(trips):
    out = {}
    for t in trips:
        out.setdefault(t[0], []).append(t)
    return out


def keep(trips, order="time"):
    kept = []
    for rows in by_bike(trips).values():
        last = None
        for t in (time_order(rows) if order == "time" else sorted(rows, key=lambda t: t[5])):
            if last is None or t[3] >= last:
                kept.append(t)
                last = t[4]
    return kept


def all_matches(trips, window=W, hot=(7, 8, 9), min_a=1, cap=None):
    out = []
    for rows in by_bike(trips).values():
        rows = time_order(rows)
        for s in range(len(rows)):
            for j in range(s, len(rows)):
                if j > s and rows[j][1] != rows[j - 1][2]:
                    break
                n = j - s
                if n < min_a or (cap and n > cap):
                    continue
                b, a = rows[j], rows[s]
                if b[2] % 10 in hot and b[4] - a[3] <= window:
                    out.append((b[0], a[1], b[1] if n else b[2], b[2], a[3], b[4], n))
    return sorted(out)


def longest_matches(trips, order="time", window=W, hot=(7, 8, 9), cap=None):
    """The stateful rule, trip by trip."""
    out = []
    for rows in by_bike(trips).values():
        chain, last_ts, last_end = None, 0, 0
        for t in (time_order(rows) if order == "time" else sorted(rows, key=lambda t: t[5])):
            if chain is not None and t[3] < last_ts:
                continue
            if chain is not None:
                chain = [c for c in chain if c[3] >= t[4] - window]
            if not chain or t[1] != last_end:
                chain, last_ts, last_end = [t], t[4], t[2]
                continue
            if t[2] % 10 in hot:
                out.append((t[0], chain[0][1], last_end, t[2], chain[0][3], t[4], len(chain)))
            chain.append(t)
            if cap:
                chain = chain[-cap:]
            last_ts, last_end = t[4], t[2]
    return sorted(out)


def switch(pendings, threshold=3, cap=3, resp=3):
    status, out = 0, []
    for p in pendings:
        status = min(status + 1, cap) if p > threshold else max(status - 1, 0)
        out.append((status, status >= resp))
    return out


def shed(chain, last_ts, policy, n=1, k=3, w=W // 2):
    """chain of (start, end, started, ended)."""
    if policy == "drop_oldest":
        return chain[-max(n, 1):]
    if policy == "drop_k":
        return chain[k:]
    if policy == "shrink_window":
        return chain[-1:] if w == 0 else [c for c in chain if c[2] >= last_ts - w]
    return chain
