"""Slow row-by-row answers that the Spark operators have to match."""

from __future__ import annotations

import math
from collections import defaultdict


def km(a_lat, a_lon, b_lat, b_lon):
    p, q = math.radians(a_lat), math.radians(b_lat)
    dx = math.sin(math.radians(b_lon - a_lon) / 2)
    dy = math.sin((q - p) / 2)
    return 12742.0 * math.asin(math.sqrt(min(1.0, dy * dy + math.cos(p) * math.cos(q) * dx * dx)))


def histories(rows):
    by_card = defaultdict(list)
    for r in rows:
        by_card[r[1]].append(r)
    return {c: sorted(v, key=lambda r: (r[2], r[0])) for c, v in by_card.items()}


def features(rows, windows):
    """tx_id -> the counts, prior amount, ratio, new flag, distance, speed."""
    out = {}
    for ordered in histories(rows).values():
        for i, (tx_id, _, t, category, amount, lat, lon) in enumerate(ordered):
            earlier = [r for r in ordered if r[2] < t]
            counts = [sum(1 for r in earlier if r[2] >= t - w) for w in windows]
            total = sum(r[4] for r in earlier)
            prev = ordered[i - 1] if i else None
            distance = km(prev[5], prev[6], lat, lon) if prev else None
            out[tx_id] = (
                *counts,
                total if earlier else None,
                amount / (total / len(earlier)) if earlier else None,
                all(r[3] != category for r in ordered[:i]),
                distance,
                distance / ((t - prev[2]) / 3600) if prev and t > prev[2] else None,
            )
    return out


def states(rows, retention):
    """card -> n, amount, categories, {second: (n, amount)}, last epoch, id, lat, lon."""
    out = {}
    for card, ordered in histories(rows).items():
        last = ordered[-1]
        recent = defaultdict(lambda: [0, 0.0])
        for r in ordered:
            if r[2] >= last[2] - retention:
                recent[r[2]][0] += 1
                recent[r[2]][1] += r[4]
        out[card] = (
            len(ordered),
            sum(r[4] for r in ordered),
            sorted({r[3] for r in ordered}),
            {t: tuple(v) for t, v in recent.items()},
            last[2],
            last[0],
            last[5],
            last[6],
        )
    return out
