"""A plain walk along one ring, to hold the clipping of rows against."""

from __future__ import annotations

import math
from collections.abc import Iterator

from tidegrid.operators.polygons import Box, Point, _encloses


def _position(x: float, y: float, box: Box) -> float:
    """Place along the box's sides of a point on them, counter-clockwise from the lower left corner."""
    west, east, south, north = box
    if y == south:
        return (x - west) / (east - west)
    if x == east:
        return 1 + (y - south) / (north - south)
    if y == north:
        return 2 + (east - x) / (east - west)
    return 3 + (north - y) / (north - south)


def _through(a: Point, b: Point, box: Box) -> tuple[Point, Point, bool, bool] | None:
    """The part of an edge in the open box: its ends, and whether they are the edge's own; None for edges along a side."""
    dx, dy = b[0] - a[0], b[1] - a[1]
    low, high = 0.0, 1.0
    ends: list[tuple[float, float] | None] = [None, None]  # the side that cuts: axis and value
    for axis, (start, step, least, most) in enumerate(((a[0], dx, box[0], box[1]), (a[1], dy, box[2], box[3]))):
        if step == 0:
            if not least < start < most:
                return None
            continue
        for value, entering in ((least, step > 0), (most, step < 0)):
            t = (value - start) / step
            if entering and t > low:
                low, ends[0] = t, (axis, value)
            elif not entering and t < high:
                high, ends[1] = t, (axis, value)
    if low >= high:
        return None

    def at(t: float, cut: tuple[float, float] | None, own: Point) -> Point:
        if cut is None:
            return own
        p = [min(max(a[0] + t * dx, box[0]), box[1]), min(max(a[1] + t * dy, box[2]), box[3])]
        p[int(cut[0])] = cut[1]
        return p[0], p[1]

    return at(low, ends[0], a), at(high, ends[1], b), ends[0] is None, ends[1] is None


def _edges(ring: list[Point]) -> Iterator[tuple[Point, Point]]:
    """The edges of a ring; one of over 90 degrees goes the short way, once from each of its ends."""
    for a, b in zip(ring, ring[1:]):
        if abs(b[0] - a[0]) > 90:
            turn = math.copysign(360, b[0] - a[0])
            yield a, (b[0] - turn, b[1])
            yield (a[0] + turn, a[1]), b
        else:
            yield a, b


def clipped_rings(ring: list[Point], box: Box) -> list[list[Point]]:
    """The rings of the part of a polygon within a box.

    Stretches of the ring in the open box are joined along its sides, counter-clockwise,
    from where one leaves to where the next enters, over the box's corners in between.
    If the ring does not pass through the box, the box is the answer where its middle
    lies in the polygon, and nothing else.
    """
    west, east, south, north = box
    corners = [(west, south), (east, south), (east, north), (west, north)]
    stretches: list[list[Point]] = []
    joined = False  # whether the next edge goes on from the last stretch
    met = [(e, _through(*e, box)) for e in _edges(ring)]
    breaks = [i for i, (_, m) in enumerate(met) if m is None or not m[2] or not (before := met[i - 1][1]) or not before[3]]
    if not breaks:
        return [ring]
    for i in (*range(breaks[0], len(met)), *range(breaks[0])):
        (a, _), part = met[i]
        if part is None:
            joined = False
            continue
        first, last, own_start, own_stop = part
        if joined and own_start and stretches[-1][-1] == a:
            stretches[-1].append(last)
        else:
            stretches.append([first, last])
        joined = own_stop
    if not stretches:
        return [[*corners, corners[0]]] if _encloses(ring, (west + east) / 2, (south + north) / 2) else []
    left = sorted((_position(*points[0], box), _position(*points[-1], box) % 4, points) for points in stretches)
    out = []
    while left:
        start = _, leave, points = left.pop(0)
        points = list(points)
        while True:
            ways = [((s[0] - leave) % 4, s) for s in left]
            home = (start[0] - leave) % 4 or 4.0 * (_signed_area([*points, points[0]]) < 0)
            reach, following = min([*ways, (home, start)], key=lambda w: w[0])
            points += [corners[int(c) % 4] for c in range(math.floor(leave) + 1, math.floor(leave) + 6) if 0 < c - leave < reach]
            if following is start:
                break
            left.remove(following)
            points += following[2][following[2][0] == points[-1] :]
            leave = following[1]
        out.append([*points, points[0]] if points[-1] != points[0] else points)
    return out


def _signed_area(ring: list[Point]) -> float:
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, ring[1:])) / 2
