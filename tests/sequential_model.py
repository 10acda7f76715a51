"""A plain sequential implementation of the scoring contract, row by row,
used as a second oracle for the Spark plans and the stream."""

from __future__ import annotations

import math


def bucket(x: float, lo=0.0, hi=0.1, res=0.001) -> int:
    c = min(max(x, lo), hi)
    return int(math.floor((c - lo + res / 2) / res))


def score_device(rows, w=51, res=0.001, lo=0.0, warmup=2):
    """rows: list of (seq, measurement) in device order. Returns a list of
    (seq, n, prediction, error, anomaly, predictionNext)."""
    counts: dict[int, dict[int, list[int]]] = {}
    out = []
    prev = None  # (n, b, pn, pred, x, succ_set)
    for n, (seq, x) in enumerate(rows):
        b = bucket(x, lo, 0.1, res)
        if prev is not None:
            pn_, pb, ppn, ppred, px, psucc = prev
            e = counts.setdefault(pb, {}).setdefault(b, [0, -1])
            e[0] += 1
            e[1] = n - 1
        succ = counts.get(b, {})
        if succ:
            best = max(succ.items(), key=lambda kv: (kv[1][0], kv[1][1], kv[0]))[0]
        else:
            best = b
        pn = best * res + lo
        if prev is None:
            pred, err, anom = 0.0, 0.0, 0.0
        else:
            pred = prev[2]
            if n >= warmup:
                err = abs(prev[3] - prev[4])
                on = set()
                for s in prev[5]:
                    on.update(range(s, s + w))
                anom = 1.0 - float(len(on & set(range(b, b + w)))) / float(w)
            else:
                err, anom = 0.0, 0.0
        out.append((seq, n, pred, err, anom, pn))
        prev = (n, b, pn, pred, x, set(succ))
    return out
