"""Row-by-row definitions in plain Python, to check the distributed ones against."""

from __future__ import annotations

from collections import defaultdict


def late_windows(rows, size, delay):
    """rows: (key, value, ts) in arrival order. Gives late positions, windows, and closing positions."""
    seen = None
    late, windows, closed_at, touched = [], {}, {}, set()
    for at, (key, value, ts) in enumerate(rows):
        start = ts // size * size
        touched.add(start + size)
        if seen is not None and start + size <= seen - delay:
            late.append(at)
        elif (key, start) in windows:
            total, first = windows[key, start]
            windows[key, start] = (total + value, first)
        else:
            windows[key, start] = (value, ts)
        seen = ts if seen is None else max(seen, ts)
        for (_, begun) in windows:
            if begun + size <= seen - delay:
                closed_at.setdefault(begun + size, at)
    return late, windows, closed_at


def running(rows, fn):
    """rows: (key, value) in order; the values of a key combined so far, per row."""
    held, out = {}, []
    for key, value in rows:
        held[key] = fn(held[key], value) if key in held else value
        out.append(held[key])
    return out


def count_windows(rows, length):
    held = defaultdict(list)
    for key, value in rows:
        held[key].append(value)
    return {
        (key, i // length): (sum(values[i : i + length]), len(values[i : i + length]) == length)
        for key, values in held.items()
        for i in range(0, len(values), length)
    }
