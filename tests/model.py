"""The rules, one event at a time, in plain Python: what every Spark form must equal."""

from __future__ import annotations

import random

NAMES = {2: "success", 5: "refund", 4: "cancel"}


def totals_after_each(events):
    """``events``: (merchant, order, state, amount, is_snapshot) in order."""
    totals, states, output = {}, {}, []
    for merchant, order, state, amount, is_snapshot in events:
        t = totals.setdefault(merchant, {"success": 0, "refund": 0, "cancel": 0})
        if is_snapshot:
            if state in NAMES:
                t[NAMES[state]] += amount
        else:
            old = states.get((merchant, order))
            if old is None:
                if state == 2:
                    t["success"] += amount
            else:
                if old[0] in NAMES:
                    t[NAMES[old[0]]] -= old[1]
                if state in NAMES:
                    t[NAMES[state]] += amount
            states[merchant, order] = (state, amount)
        s, r, c = t["success"], t["refund"], t["cancel"]
        output.append((s + r + c, s, r, c, s - r - c))
    return output


def random_events(seed, count, merchants=4, orders=12, snapshot_share=0.3, hot=0.0):
    """A share ``hot`` of the events belongs to one order of one merchant."""
    rng = random.Random(seed)
    events = []
    for _ in range(count):
        if rng.random() < hot:
            merchant, order = "M0", None
        else:
            merchant = f"M{rng.randrange(merchants)}"
            order = f"O{rng.randrange(orders)}"
        state = rng.choice([0, 1, 2, 2, 3, 4, 5, 5, 6])
        amount = rng.randrange(0, 10_000)
        if state not in NAMES and rng.random() < 0.3:
            amount = None
        events.append((merchant, order, state, amount, rng.random() < snapshot_share))
    return events
