"""The rules by definition, checked event by event. Slow, for small traces."""

from clicksieve.schema import DISPLAY


def boundaries(rows, window=1800):
    found, opened = set(), None
    for i, row in enumerate(rows):
        if opened is None:
            opened = row[2]
        elif row[2] >= opened + window:
            found.add(i)
            opened = row[2]
    return found


def state(rows, i, key, reset=(), window=None):
    """The events up to `i` that make up the state its key has at `i`."""
    same = [j for j in range(i + 1) if rows[j][key] == rows[i][key]]
    if window is not None:
        return [j for j in same if rows[j][2] // window == rows[i][2] // window]
    cleared = [j for j in same if j in reset]
    return [j for j in same if not cleared or j >= cleared[-1]]


def click(row):
    return row[0] != DISPLAY


def sticky(rows, key, hit):
    """Whether the key had a hit before each event."""
    return [any(hit[j] and rows[j][key] == rows[i][key] for j in range(i)) for i in range(len(rows))]


def p1(rows, **bound):
    hit = []
    for i, row in enumerate(rows):
        group = state(rows, i, 1, **bound)
        clicks = sum(click(rows[j]) for j in group)
        hit.append(click(row) and clicks > len(group) - clicks)
    before = sticky(rows, 1, hit)
    return [i + 1 for i, row in enumerate(rows) if click(row) and (hit[i] or before[i])]


def p2(rows, quick, **bound):
    flagged = []
    for i, row in enumerate(rows):
        shown = [rows[j][2] for j in state(rows, i, 4, **bound) if not click(rows[j])]
        if click(row) and shown and quick(shown[-1], row[2]):
            flagged.append(i + 1)
    return flagged


def p3(rows, hyperactive, twice=False, **bound):
    hit = []
    for i, row in enumerate(rows):
        group = state(rows, i, 3, **bound)
        clicks = sum(click(rows[j]) for j in group)
        hit.append(click(row) and hyperactive(clicks, len(group) - clicks))
    before = sticky(rows, 3, hit)
    flagged = []
    for i, row in enumerate(rows):
        if click(row):
            times = hit[i] + before[i]
            flagged += [i + 1] * (times if twice else min(times, 1))
    return flagged
