"""Sums over the points and line parts inside circular zones, block by block: the arithmetic of one task in numpy.

Spark deals units and points to blocks and groups them; a task files the points of its block under a grid, row by row.
The cells of a grid row that a zone covers lie side by side, so one difference of running totals gives their sum, and only
points in cells at the rim are tested. Nothing is made per unit and cell but numbers in the task. Lines are cut at the grid,
so that a piece lies in one cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ..functions.geometry import APOTHEM, OUTSET, SIDES, STEP

# Numbers in one array of a task at most, and cells of a grid row to a side of a zone.
CHUNK, FINEST = 100_000, 512


def in_zone(dx: np.ndarray, dy: np.ndarray, r: float, shape: str) -> np.ndarray:
    """The tests of :mod:`terracell.functions.geometry` on arrays."""
    d2 = dx * dx + dy * dy
    if shape == "disc":
        return d2 <= r * r
    apothem = r * APOTHEM
    inside = d2 < apothem * apothem * (1 - 1e-9)
    rim = np.flatnonzero(~inside & (d2 < r * r))
    turn = np.mod(np.arctan2(dy[rim], dx[rim]), STEP) - STEP / 2
    inside[rim] = np.sqrt(d2[rim]) * np.cos(turn) < apothem
    return inside


def shares(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, r: float, shape: str) -> np.ndarray:
    """Share of each segment inside a zone around the origin, as :func:`terracell.functions.geometry.with_zone_share` has it."""
    enter, leave = spans(ax, ay, bx, by, r, shape)
    return np.maximum(0.0, leave - enter)


def spans(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, r: float, shape: str) -> tuple[np.ndarray, np.ndarray]:
    """Where each segment enters a zone around the origin and leaves it, as parts of its length; it stays outside unless the former is less."""
    safe = np.square(r * (APOTHEM if shape == "poly32" else 1.0)) * (1 - 1e-9)
    into, out = np.zeros(len(ax)), ((ax * ax + ay * ay < safe) & (bx * bx + by * by < safe)).astype(np.float64)
    dx, dy = bx - ax, by - ay
    cross, len2 = ax * dy - ay * dx, dx * dx + dy * dy
    met = np.flatnonzero((out == 0) & (cross * cross < len2 * r * r))
    ax, ay, dx, dy, len2 = (v[met] for v in (ax, ay, dx, dy, len2))
    qb = ax * dx + ay * dy
    root = np.sqrt(np.maximum(0.0, qb * qb - len2 * (ax * ax + ay * ay - r * r)))
    low, high = (-qb - root) / len2, (-qb + root) / len2
    if shape == "disc":
        into[met], out[met] = np.maximum(0.0, low), np.minimum(1.0, high)
        return into, out
    some = np.flatnonzero((low < 1) & (high > 0))
    met, ax, ay, dx, dy, low, high = (v[some] for v in (met, ax, ay, dx, dy, low, high))
    enter, leave = np.zeros(len(met)), np.ones(len(met))
    for t in (low, high):
        angle = np.arctan2(ay + t * dy, ax + t * dx)
        for turn in (-STEP / 2, STEP / 2):
            middle = (np.floor((angle + turn) / STEP) + 0.5) * STEP
            c, s = np.cos(middle), np.sin(middle)
            rate, room = c * dx + s * dy, r * APOTHEM - (c * ax + s * ay)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = room / rate
            enter = np.maximum(enter, np.where(rate < 0, at, np.where((rate == 0) & (room <= 0), 2.0, 0.0)))
            leave = np.minimum(leave, np.where(rate > 0, at, 1.0))
    into[met], out[met] = enter, leave
    return into, out


def gon_overlaps(dx: np.ndarray, dy: np.ndarray, r: float) -> np.ndarray:
    """Common area of a 32-gon around the origin and the same around each (dx, dy).

    By symmetry each has half of the common outline, from one crossing to that opposite, so the area follows from where the outlines
    cross: the end of a chord along the way between both centres that is as long as the way.
    """
    d, area = np.hypot(dx, dy), np.zeros(len(dx))
    area[d == 0] = SIDES / 2 * np.sin(STEP) * r * r
    met = np.flatnonzero((d > 0) & (d < 2 * r))
    dx, dy, d = dx[met], dy[met], d[met]
    way = np.mod(np.arctan2(dy, dx), 2 * np.pi)
    ex, ey = dx / d, dy / d
    # The chord of a circle lies further out, and tangents to the length of chords, which is concave, only lead inwards: up to the right sides.
    off = np.sqrt(r * r - d * d / 4)
    top = np.round((way + np.pi / 2) / STEP).astype(np.int64)
    x, y = np.zeros(len(d)), np.zeros(len(d))
    right, left, todo = np.full(len(d), -1), np.full(len(d), -1), np.arange(len(d))
    nx, ny = np.cos((np.arange(SIDES) + 0.5) * STEP), np.sin((np.arange(SIDES) + 0.5) * STEP)
    for _ in range(SIDES // 2):
        turn = np.arcsin(np.clip(off[todo] / r, -1.0, 1.0))
        i = np.minimum(np.floor((way[todo] + turn) / STEP).astype(np.int64), top[todo] - 1)
        j = np.maximum(np.floor((way[todo] + np.pi - turn) / STEP).astype(np.int64), top[todo])
        new = (i != right[todo]) | (j != left[todo])
        # Opposite sides mean that the longest chords are too short.
        off[todo[j - i == SIDES // 2]] = -1.0
        new &= j - i != SIDES // 2
        todo, i, j = todo[new], i[new], j[new]
        if not len(todo):
            break
        right[todo], left[todo] = i, j
        a, b, c, e = nx[i % SIDES], ny[i % SIDES], nx[j % SIDES], ny[j % SIDES]
        over, det = r * APOTHEM + c * dx[todo] + e * dy[todo], a * e - b * c
        x[todo], y[todo] = (r * APOTHEM * e - b * over) / det, (a * over - c * r * APOTHEM) / det
        off[todo] = ex[todo] * y[todo] - ey[todo] * x[todo]
    # Below the middle there is no chord that long.
    some = np.flatnonzero(off >= 0)
    x, y, dx, dy = x[some], y[some], dx[some], dy[some]
    whole = SIDES * np.sin(STEP) * r * r / 2
    swept = np.mod(_swept(x, y, r) - _swept(dx - x, dy - y, r), whole)
    area[met[some]] = np.maximum(0.0, 2 * swept - (dx * y - dy * x))
    return area


class CellGrid:
    """Features in the order of the cells of a grid, and running totals of their values in that order.

    A feature is inside with all points at ``inner`` from its place and can be so only with all those at ``outer``; both hold
    give or take ``slack`` along each axis.
    """

    inner: list[tuple[float, float]] = [(0.0, 0.0)]
    outer: list[tuple[float, float]] = [(0.0, 0.0)]
    slack = (0.0, 0.0)

    def _file(self, x: np.ndarray, y: np.ndarray, values: list[np.ndarray], ends: list[np.ndarray]) -> None:
        """File features by their places; ``ends`` are what they are tested by."""
        self.columns, self.rows = (int((v.max() - o) / self.size) + 1 for v, o in ((x, self.x0), (y, self.y0)))
        cx = np.clip(((x - self.x0) / self.size).astype(np.int64), 0, self.columns - 1)
        cy = np.clip(((y - self.y0) / self.size).astype(np.int64), 0, self.rows - 1)
        cell = cy * self.columns + cx
        order = np.argsort(cell, kind="stable")
        self.ends, self.values = [e[order] for e in ends], [v[order] for v in values]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(cell, minlength=self.columns * self.rows))))
        # Whole numbers add up exactly, and others with more digits than they have; totals with a value that is not finite are of no use.
        self.additive = all(np.isfinite(v).all() for v in values)
        self.upto = [np.concatenate(([0], np.cumsum(v, dtype=np.int64 if v.dtype.kind == "i" else np.longdouble))) for v in self.values]

    def sums(self, ux: np.ndarray, uy: np.ndarray, r: float, shape: str) -> list[np.ndarray]:
        """Sums of every value over the features, or their parts, in the zone of each unit."""
        found = [np.zeros(len(ux), v.dtype) for v in self.values]
        todo = np.arange(len(ux))
        if self.additive:
            # A zone that holds the whole grid with all its features needs no row of it.
            safe, width, height = r * (APOTHEM if shape == "poly32" else 1.0) - 1e-6, self.columns * self.size, self.rows * self.size
            whole = np.ones(len(ux), bool)
            for ox, oy in self.inner:
                u, v = ux - ox - self.x0, uy - oy - self.y0
                far = (np.maximum(a, side - a) + slack for a, side, slack in ((u, width, self.slack[0]), (v, height, self.slack[1])))
                whole &= np.hypot(*far) < safe
            for total, upto in zip(found, self.upto):
                total[whole] = upto[-1]
            todo = np.flatnonzero(~whole)
        deep = min(int(2 * r / self.size) + 2, self.rows)
        step = max(1, CHUNK // (8 * deep))
        for a in range(0, len(todo), step):
            own = todo[a : a + step]
            for total, part in zip(found, self._some(ux[own], uy[own], r, shape, deep)):
                total[own] = part
        return found

    def _some(self, ux: np.ndarray, uy: np.ndarray, r: float, shape: str, deep: int) -> list[np.ndarray]:
        size, safe = self.size, r * (APOTHEM if shape == "poly32" else 1.0) - 1e-6
        x, y = ux[:, None] - self.x0, uy[:, None] - self.y0
        row = np.clip(np.floor((y - r) / size), 0, self.rows - deep).astype(np.int64) + np.arange(deep)
        low = row * size
        reached, whole = (row >= 0) & (row < self.rows), self.additive & (row < self.rows - 1)
        begin, end, opens, closes = 0, self.columns, 0, self.columns

        def column(v: np.ndarray) -> np.ndarray:
            return np.clip(v, 0, self.columns).astype(np.int64)

        for ox, oy in self.outer:
            u, v = x - ox, y - oy
            near = np.maximum(0.0, np.maximum(low - v, v - low - size) - self.slack[1]) - 1e-6
            reached &= near <= r
            reach = np.sqrt(np.maximum(0.0, r * r - np.square(np.maximum(near, 0.0)))) + 1e-6 + self.slack[0]
            begin = np.maximum(begin, column(np.floor((u - reach) / size)))
            end = np.minimum(end, column(np.floor((u + reach) / size) + 1))
        for ox, oy in self.inner:
            u, v = x - ox, y - oy
            far = np.maximum(v - low, low + size - v) + self.slack[1]
            reach = np.sqrt(np.maximum(0.0, safe * safe - far * far)) - self.slack[0]
            opens = np.maximum(opens, column(np.ceil((u - reach) / size)))
            closes = np.minimum(closes, column(np.floor((u + reach) / size)))
            whole &= (far < safe) & (reach > 0)
        # Points on the last edge of the grid were put into its last cell, so that is never taken as covered.
        opens, closes, end = np.minimum(opens, self.columns - 1), np.minimum(closes, self.columns - 1), np.maximum(begin, end)
        whole &= (closes > opens) & (opens >= begin) & (closes <= end)
        opens, closes = np.where(whole, opens, end), np.where(whole, closes, end)
        base = np.where(reached, row, 0) * self.columns
        at = [np.where(reached, self.first[base + c], 0) for c in (begin, opens, closes, end)]
        covered = [np.sum(u[at[2]] - u[at[1]], axis=1).astype(v.dtype) if self.additive else np.zeros(len(ux), v.dtype) for u, v in zip(self.upto, self.values)]
        # What is left are two runs of features a unit and row; units follow each other in them.
        starts, stops = np.stack((at[0], at[2]), 2).reshape(len(ux), -1), np.stack((at[1], at[3]), 2).reshape(len(ux), -1)
        tests = np.cumsum(np.sum(stops - starts, axis=1))
        a = 0
        while a < len(ux):
            done = tests[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(tests, done + CHUNK, "right")))
            begun, counts = starts[a:b].ravel(), (stops[a:b] - starts[a:b]).ravel()
            place = np.repeat(begun - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
            bounds = np.concatenate(([0], tests[a:b] - done))
            unit = np.repeat(np.arange(a, b), np.diff(bounds))
            for total, tested in zip(covered, self._tested(place, ux[unit], uy[unit], r, shape)):
                if tested.dtype.kind == "i":
                    running = np.concatenate(([0], np.cumsum(tested)))
                    total[a:b] += running[bounds[1:]] - running[bounds[:-1]]
                else:
                    total[a:b] += np.bincount(unit - a, tested, b - a)
            a = b
        return covered


class PointGrid(CellGrid):
    def __init__(self, x: np.ndarray, y: np.ndarray, values: list[np.ndarray], reach: float):
        self.x0, self.y0 = x.min(), y.min()
        width, height = max(x.max() - self.x0, 1e-3), max(y.max() - self.y0, 1e-3)
        # About three points a cell cost least: finer cells mean more rows, coarser ones more tests.
        self.size = min(max(float(np.sqrt(3 * width * height / len(x))), reach / FINEST), reach)
        self._file(x, y, values, [x, y])

    def _tested(self, place: np.ndarray, x: np.ndarray, y: np.ndarray, r: float, shape: str) -> list[np.ndarray]:
        held = in_zone(self.ends[0][place] - x, self.ends[1][place] - y, r, shape)
        return [np.where(held, v[place], 0) for v in self.values]


class PairGrid(PointGrid):
    """Points for the pairs that they make with units."""

    def pairs(self, ux: np.ndarray, uy: np.ndarray, r: float, shape: str, hole: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Units, in order, and the points in the zone of each, or in its ring, at most ``CHUNK`` tests at a time."""
        deep = int(2 * r / self.size) + 2
        step = max(1, CHUNK // (4 * deep))
        for a in range(0, len(ux), step):
            starts, counts = self._runs(ux[a : a + step], uy[a : a + step], r, shape, hole, deep)
            owner, starts = np.flatnonzero(counts), starts[counts > 0]
            counts = counts[owner]
            owner, ends = a + owner // (2 * deep), np.cumsum(counts)
            for low in range(0, int(ends[-1]) if len(ends) else 0, CHUNK):
                high = min(low + CHUNK, int(ends[-1]))
                i, j = np.searchsorted(ends, low, "right"), np.searchsorted(ends, high, "left") + 1
                first = np.maximum(ends[i:j] - counts[i:j], low)
                some = np.minimum(ends[i:j], high) - first
                place = np.arange(low, high) + np.repeat(starts[i:j] - (ends[i:j] - counts[i:j]), some)
                unit = np.repeat(owner[i:j], some)
                dx, dy = self.ends[0][place] - ux[unit], self.ends[1][place] - uy[unit]
                held = in_zone(dx, dy, r, shape)
                if hole:
                    held &= ~in_zone(dx, dy, hole, shape)
                yield unit[held], self.values[0][place[held]]

    def _runs(self, ux: np.ndarray, uy: np.ndarray, r: float, shape: str, hole: float, deep: int) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of points begin and how long they are: two for every unit and grid row, west and east of what the hole covers."""
        size, safe = self.size, hole * (APOTHEM if shape == "poly32" else 1.0) - 1e-6
        x, y = ux[:, None] - self.x0, uy[:, None] - self.y0
        row = np.floor((y - r) / size).astype(np.int64) + np.arange(deep)
        low = row * size

        def column(v: np.ndarray) -> np.ndarray:
            return np.clip(v, 0, self.columns).astype(np.int64)

        near = np.maximum(0.0, np.maximum(low - y, y - low - size) - 1e-6)
        reached = (row >= 0) & (row < self.rows) & (near <= r)
        reach = np.sqrt(np.maximum(0.0, r * r - near * near)) + 1e-6
        begin = column(np.floor((x - reach) / size))
        end = np.maximum(begin, column(np.floor((x + reach) / size) + 1))
        opens, closes = end, end
        if hole:
            far = np.maximum(y - low, low + size - y)
            reach = np.sqrt(np.maximum(0.0, safe * safe - far * far))
            # Points on the last edge of the grid were put into its last cell, so that is never taken as covered.
            opens = np.minimum(column(np.ceil((x - reach) / size)), self.columns - 1)
            closes = np.minimum(column(np.floor((x + reach) / size)), self.columns - 1)
            whole = (row < self.rows - 1) & (far < safe) & (closes > opens) & (opens >= begin) & (closes <= end)
            opens, closes = np.where(whole, opens, end), np.where(whole, closes, end)
        base = np.where(reached, row, 0) * self.columns
        at = [np.where(reached, self.first[base + c], 0) for c in (begin, opens, closes, end)]
        return np.stack((at[0], at[2]), 2).ravel(), np.stack((at[1] - at[0], at[3] - at[2]), 2).ravel()


def cut_lines(ends: list[np.ndarray], size: float, corner: tuple[float, float]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Ends of the pieces that a grid cuts the lines into, the line of each, and its part of the line's length."""
    x1, y1, x2, y2 = ends
    every = np.arange(len(x1))
    line, stops = [every, every], [np.zeros(len(x1)), np.ones(len(x1))]
    for p, q, origin in ((x1, x2, corner[0]), (y1, y2, corner[1])):
        a, b = (np.floor((v - origin) / size).astype(np.int64) for v in (p, q))
        crossed = np.abs(b - a)
        own = np.repeat(every, crossed)
        nth = np.arange(len(own)) - np.repeat(np.cumsum(crossed) - crossed, crossed)
        at = origin + (np.minimum(a, b)[own] + 1 + nth) * size
        line.append(own)
        stops.append(np.clip((at - p[own]) / (q - p)[own], 0.0, 1.0))
    line, stops = np.concatenate(line), np.concatenate(stops)
    order = np.lexsort((stops, line))
    line, stops = line[order], stops[order]
    kept = np.flatnonzero((line[1:] == line[:-1]) & (stops[1:] > stops[:-1]))
    line, t0, t1 = line[kept], stops[kept], stops[kept + 1]
    at = [np.where(t == 1, q[line], p[line] + t * (q - p)[line]) for t in (t0, t1) for p, q in ((x1, x2), (y1, y2))]
    return at, line, t1 - t0


class LineGrid(CellGrid):
    """Line pieces with weight x length as their values; a value of whole numbers counts the pieces of which a part is inside."""

    def __init__(self, ends: list[np.ndarray], weights: list[np.ndarray], reach: float):
        at, line, part = self._cut(ends, reach)
        length = np.hypot(ends[2] - ends[0], ends[3] - ends[1])
        values = [(w * length)[line] * part for w in weights]
        self._file((at[0] + at[2]) / 2, (at[1] + at[3]) / 2, [*values, np.ones(len(line), np.int64)], at)

    def _cut(
        self, ends: list[np.ndarray], reach: float, corner: tuple[float, float] | None = None
    ) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Pieces of the lines, of which each lies in a cell."""
        x1, y1, x2, y2 = ends
        self.size = reach / 8
        self.x0, self.y0 = corner or (min(x1.min(), x2.min()), min(y1.min(), y2.min()))
        return cut_lines(ends, self.size, (self.x0, self.y0))

    def _tested(self, place: np.ndarray, x: np.ndarray, y: np.ndarray, r: float, shape: str) -> list[np.ndarray]:
        share = shares(*[e[place] - o for e, o in zip(self.ends, (x, y, x, y))], r, shape)
        held = np.flatnonzero(share)
        found = []
        for v in self.values[:-1]:
            part = np.zeros(len(place))
            part[held] = share[held] * v[place[held]]
            found.append(part)
        return [*found, (share > 0).astype(np.int64)]


def _swept(x: np.ndarray, y: np.ndarray, r: float, shape: str = "poly32") -> np.ndarray:
    """Area that the ray from the middle of a zone sweeps on the way from its first corner to a place on its outline."""
    if shape == "disc":
        return np.mod(np.arctan2(y, x), 2 * np.pi) * r * r / 2
    k = np.floor(np.mod(np.arctan2(y, x), 2 * np.pi) / STEP)
    return k * (np.sin(STEP) * r * r / 2) + r * (np.cos(k * STEP) * y - np.sin(k * STEP) * x) / 2


def gon_start(r: float) -> tuple[float, float]:
    """Where a round of the outline begins: no corner, and on no line that layers are likely to follow."""
    away = r * APOTHEM / np.cos(np.mod(OUTSET, STEP) - STEP / 2)
    return float(away * np.cos(OUTSET)), float(away * np.sin(OUTSET))


def zone_start(r: float, shape: str) -> tuple[float, float]:
    """The same for either shape."""
    return (float(r * np.cos(OUTSET)), float(r * np.sin(OUTSET))) if shape == "disc" else gon_start(r)


def zone_area(r: float, shape: str) -> float:
    return float(r * r * (np.pi if shape == "disc" else SIDES / 2 * np.sin(STEP)))


class AreaGrid(LineGrid):
    """Pieces of polygon boundary with what they add to the area of the polygons inside a zone.

    Half the cross products of boundary inside, moved from a corner of the grid to the centre by two more sums, and at the
    rim the part of the outline that lies inside the polygons: where a piece comes in the outline leaves the polygon, and
    where one goes out it enters it, each until the round is over (:func:`terracell.functions.geometry.arc_turns`).
    """

    def __init__(self, ends: list[np.ndarray], reach: float):
        at, line, _ = self._cut(ends, reach)
        # Products of long ways lose the digits that an area needs.
        x1, y1, x2, y2 = (e.astype(np.longdouble) - o for e, o in zip(at, (self.x0, self.y0) * 2))
        values = [x1 * y2 - x2 * y1, x2 - x1, y2 - y1, np.zeros(len(line)), np.ones(len(line), np.int64)]
        self._file((at[0] + at[2]) / 2, (at[1] + at[3]) / 2, values, at)

    def areas(self, ux: np.ndarray, uy: np.ndarray, r: float, shape: str = "poly32") -> tuple[np.ndarray, np.ndarray]:
        """Areas without those of outlines begun inside, and how many pieces are inside or cross the outline."""
        cross, dx, dy, rim, rows = self.sums(ux, uy, r, shape)
        return ((cross + (self.x0 - ux) * dy - (self.y0 - uy) * dx) / 2 + rim).astype(np.float64), rows

    def _tested(self, place: np.ndarray, x: np.ndarray, y: np.ndarray, r: float, shape: str) -> list[np.ndarray]:
        ax, ay, bx, by = (e[place] - o for e, o in zip(self.ends, (x, y, x, y)))
        enter, leave = spans(ax, ay, bx, by, r, shape)
        share = np.maximum(0.0, leave - enter)
        part = share * (ax * by - bx * ay) / 2
        # Whether a piece crosses follows from its ends alone, so pieces that share an end agree.
        in_a, in_b = in_zone(ax, ay, r, shape), in_zone(bx, by, r, shape)
        through = ~in_a & ~in_b & (share > 0)
        whole, begun = zone_area(r, shape), _swept(*(np.array(v) for v in zone_start(r, shape)), r, shape)
        for found, t, sign in (((in_a & ~in_b) | through, leave, 1.0), ((~in_a & in_b) | through, enter, -1.0)):
            at = np.flatnonzero(found)
            t = np.clip(t[at], 0.0, 1.0)
            part[at] += sign * (whole - np.mod(_swept(ax[at] + t * (bx - ax)[at], ay[at] + t * (by - ay)[at], r, shape) - begun, whole))
        none = np.zeros(len(place))
        return [none, none, none, part, ((share > 0) | (in_a != in_b)).astype(np.int64)]


class HoldGrid(CellGrid):
    """Features of one class of shapes, filed by the middles of their boxes.

    A convex zone that holds a feature holds the middle of its box: a line through the middle leaves a whole side of the
    box on either hand, and the feature touches every side.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, values: list[np.ndarray], corners: list[np.ndarray], side: float, **shape):
        self.inner, self.outer, self.slack = shape["inner"], shape["outer"], shape["slack"]
        self.size, self.x0, self.y0 = side, x.min(), y.min()
        self._file(x, y, values, corners)


class HeldLines(HoldGrid):
    """Features with two corners."""

    def _tested(self, place: np.ndarray, x: np.ndarray, y: np.ndarray, r: float, shape: str) -> list[np.ndarray]:
        x1, y1, x2, y2 = self.ends
        held = np.flatnonzero(in_zone(x1[place] - x, y1[place] - y, r, shape))
        held = held[in_zone(x2[place[held]] - x[held], y2[place[held]] - y[held], r, shape)]
        found = [np.zeros(len(place), np.int64) for _ in self.values]
        for f, v in zip(found, self.values):
            f[held] = v[place[held]]
        return found


class HeldShapes(HoldGrid):
    """Features with any number of corners, which are given by where they begin and how many there are."""

    xs: np.ndarray
    ys: np.ndarray

    def _tested(self, place: np.ndarray, x: np.ndarray, y: np.ndarray, r: float, shape: str) -> list[np.ndarray]:
        out = np.ones(len(place), bool)
        first, count = (e[place] for e in self.ends)
        a, upto = 0, np.cumsum(count)
        while a < len(place):
            done = upto[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(upto, done + CHUNK, "right")))
            own = np.repeat(np.arange(a, b), count[a:b])
            corner = np.arange(len(own)) + np.repeat(first[a:b] - (upto[a:b] - count[a:b] - done), count[a:b])
            held = in_zone(self.xs[corner] - x[own], self.ys[corner] - y[own], r, shape)
            out[a:b] = np.bincount(own[~held] - a, minlength=b - a) == 0
            a = b
        return [np.where(out, v[place], 0) for v in self.values]


def _classes(u: np.ndarray, v: np.ndarray, parts: int) -> list[np.ndarray]:
    """Rows of equal squares in the plane of (u, v), ``parts`` to the wider of both spans."""
    side = max(np.ptp(u), np.ptp(v), 1e-9) / parts * (1 + 1e-12)
    key = ((u - u.min()) / side).astype(np.int64) * (parts + 1) + ((v - v.min()) / side).astype(np.int64)
    order = np.argsort(key, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(key[order])) + 1)


def _fineness(rows: int, area: float, span: float, reach: float) -> int:
    """Classes a span of line ends: more of them mean more rows of cells to look up, fewer mean more tests at the rim."""

    def cost(parts: int) -> float:
        side = _side(rows / parts**2, area, reach, span / parts)
        tests = rows * min(1.0, np.pi * reach * reach / area) * min(1.0, 3 * (side + span / parts) / reach)
        return 2.5 * parts**2 * 2 * reach / side + tests

    return min((1, 2, 3, 4, 6, 8, 12), key=cost)


def _side(rows: float, area: float, reach: float, blur: float) -> float:
    """Cells with three features; those much finer than a class is wide would not save a test."""
    return min(max(float(np.sqrt(3 * area / rows)), reach / FINEST, blur / 2), reach / 4)


def _hold_grids(xs: np.ndarray, ys: np.ndarray, first: np.ndarray, count: np.ndarray, values: list[np.ndarray], reach: float) -> list[CellGrid]:
    """Grids of all features, told apart by their shapes; a feature's corners stand together in ``xs, ys``."""
    west, east, south, north = (f.reduceat(v, first) for v in (xs, ys) for f in (np.minimum, np.maximum))
    mx, my, grids = (west + east) / 2, (south + north) / 2, []
    area = max(np.ptp(mx), 1.0) * max(np.ptp(my), 1.0)
    lines, others = np.flatnonzero(count == 2), np.flatnonzero(count != 2)
    if len(lines):
        one, two = first[lines], first[lines] + 1
        # Half the way from the western end to the eastern one, or the southern to the northern.
        swap = (xs[one] > xs[two]) | ((xs[one] == xs[two]) & (ys[one] > ys[two]))
        one, two = np.where(swap, two, one), np.where(swap, one, two)
        u, v = (xs[two] - xs[one]) / 2, (ys[two] - ys[one]) / 2
        span = max(np.ptp(u), np.ptp(v))
        parts = _fineness(len(lines), area, span, reach)
        for c in _classes(u, v, parts):
            (ox, tx), (oy, ty) = (((w.min() + w.max()) / 2, np.ptp(w) / 2) for w in (u[c], v[c]))
            ends = [e[i[c]] for i in (one, two) for e in (xs, ys)]
            at, both = lines[c], [(ox, oy), (-ox, -oy)]
            side = _side(len(c), area, reach, max(tx, ty))
            grids.append(HeldLines(mx[at], my[at], [w[at] for w in values], ends, side, inner=both, outer=both, slack=(tx, ty)))
    if len(others):
        u, v = (east - west)[others] / 2, (north - south)[others] / 2
        for c in _classes(u, v, 4):
            w, h, at = u[c].max(), v[c].max(), others[c]
            box = [(a, b) for a in (-w, w) for b in (-h, h)]
            side = _side(len(c), area, reach, 0.0)
            grid = HeldShapes(mx[at], my[at], [w_[at] for w_ in values], [first[at], count[at]], side, inner=box, outer=[(0.0, 0.0)], slack=(0.0, 0.0))
            grid.xs, grid.ys = xs, ys
            grids.append(grid)
    return grids


def holder(unit: str, names: list[str], radius: float, shape: str):
    """The function for a block: units and features to one row a unit with its sums over the features that it holds, NULL where it has no value."""

    def run(units: pa.Table, features: pa.Table) -> pa.Table:
        ux, uy = (units.column(c).to_numpy() for c in ("x", "y"))
        given = [features.column(n).combine_chunks() for n in names]
        gaps = [n for n, v in enumerate(given) if v.null_count]
        values = [v.fill_null(0).to_numpy(zero_copy_only=False) for v in given]
        values += [given[n].is_valid().to_numpy(zero_copy_only=False).astype(np.int64) for n in gaps] + [np.ones(features.num_rows, np.int64)]
        found = [np.zeros(len(ux), np.int64) for _ in values]
        if len(ux) and features.num_rows:
            xs, ys = (features.column(c).combine_chunks() for c in ("xs", "ys"))
            count = xs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.cumsum(count) - count
            xs, ys = (v.flatten().to_numpy(zero_copy_only=False) for v in (xs, ys))
            for grid in _hold_grids(xs, ys, first, count, values, radius):
                for total, part in zip(found, grid.sums(ux, uy, radius, shape)):
                    total += part
        some = {n: found[len(names) + i] for i, n in enumerate(gaps)}
        sums = [pa.array(s, mask=some.get(n, found[-1]) == 0) for n, s in enumerate(found[: len(names)])]
        return pa.table([units.column(unit), *sums, pa.array(found[-1])], [unit, *[f"_{n}" for n in range(len(names))], "_rows"])

    return run


def measurer(unit: str, names: list[str], radius: float, shape: str):
    """The function for a tile: units and lines to one row a unit with its sums of weight x length and its pieces."""
    from . import rims

    def run(units: pa.Table, lines: pa.Table) -> pa.Table:
        ux, uy = (units.column(c).to_numpy() for c in ("x", "y"))
        found = [np.zeros(len(ux)) for _ in names] + [np.zeros(len(ux), np.int64)]
        if len(ux) and lines.num_rows:
            ends, weights = [lines.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2")], [lines.column(n).to_numpy() for n in names]
            size = None
            if shape == "poly32" and len(names) == 1 and np.isfinite(weights[0]).all():
                wide, high = (max(p.max(), q.max()) - min(p.min(), q.min()) for p, q in (ends[::2], ends[1::2]))
                size = rims.rim_size(len(ux), lines.num_rows, float(np.hypot(ends[2] - ends[0], ends[3] - ends[1]).sum()), wide, high, radius)
            if size:
                found = rims.gon_lengths(ends, weights[0], ux, uy, radius, size)
            else:
                found = LineGrid(ends, weights, radius).sums(ux, uy, radius, shape)
        return pa.table([units.column(unit), *[pa.array(s) for s in found]], [unit, *[f"_{n}" for n in range(len(names))], "_rows"])

    return run


def counter(unit: str, names: list[str], radii: list[float], shape: str):
    """The function for a block: units and points to one row a unit with its sums, radius by radius."""

    def run(units: pa.Table, points: pa.Table) -> pa.Table:
        ux, uy = (units.column(c).to_numpy() for c in ("x", "y"))
        if len(ux) and points.num_rows:
            values = [points.column(n).to_numpy() for n in names]
            grid = PointGrid(points.column("px").to_numpy(), points.column("py").to_numpy(), values, radii[-1])
            sums = [s for r in radii for s in grid.sums(ux, uy, r, shape)]
        else:
            sums = [np.zeros(len(ux), np.int64) for _ in radii for _ in names]
        columns = [f"_{i}_{n}" for i in range(len(radii)) for n in range(len(names))]
        return pa.table([units.column(unit), *[pa.array(s) for s in sums]], [unit, *columns])

    return run


def matcher(keys: list[str], kept: list[str], radius: float, shape: str, hole: float):
    """The function for a partition sorted by block, features before units: a row for a unit with the points found, several where they are many.

    Only the points of one block are held; its units stream by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, grid, own = None, [], None, []
        for batch in batches:
            at = np.stack([batch.column(k).to_numpy() for k in [*keys, "_kind"]], 1)
            cuts = [0, *(np.flatnonzero(np.any(at[1:] != at[:-1], axis=1)) + 1), len(at)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if block != tuple(at[a, :-1]):
                    block, held, grid = tuple(at[a, :-1]), [], None
                if at[a, -1] == 0:
                    held.append(batch.column("_f").slice(a, b - a))
                    continue
                if not held:
                    continue
                if grid is None:
                    points = pa.concat_arrays(held)
                    fields = dict(zip((f.name for f in points.type), points.flatten()))
                    px, py = (fields[c].cast(pa.float64()).to_numpy() for c in ("px", "py"))
                    grid, own = PairGrid(px, py, [np.arange(len(px))], radius), [fields[c] for c in kept]
                units = batch.column("_u").slice(a, b - a)
                fields = dict(zip((f.name for f in units.type), units.flatten()))
                ux, uy = (fields[c].cast(pa.float64()).to_numpy() for c in ("x", "y"))
                for unit, place in grid.pairs(ux, uy, radius, shape, hole):
                    if not len(unit):
                        continue
                    first = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
                    found = pa.StructArray.from_arrays([c.take(pa.array(place)) for c in own], kept)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(unit)).astype(np.int32)), found)
                    some = pa.array(unit[first])
                    yield pa.RecordBatch.from_arrays([*[c.take(some) for c in fields.values()], lists], [*fields, "_near"])

    return run


def _clip(ends: list[np.ndarray], west: float, south: float, east: float, north: float) -> tuple[list[np.ndarray], np.ndarray]:
    """The parts of segments in a box, and the segment of each."""
    x1, y1, x2, y2 = ends
    own = np.flatnonzero((np.minimum(x1, x2) <= east) & (np.maximum(x1, x2) >= west) & (np.minimum(y1, y2) <= north) & (np.maximum(y1, y2) >= south))
    x1, y1, x2, y2 = (e[own] for e in ends)
    t0, t1 = np.zeros(len(own)), np.ones(len(own))
    with np.errstate(divide="ignore", invalid="ignore"):
        for p, q, low, high in ((x1, x2, west, east), (y1, y2, south, north)):
            a, b = (low - p) / (q - p), (high - p) / (q - p)
            t0 = np.maximum(t0, np.where(p == q, 0.0, np.minimum(a, b)))
            t1 = np.minimum(t1, np.where(p == q, 1.0, np.maximum(a, b)))
    # Rounding must not lose one that touches the box.
    met = np.flatnonzero(t0 <= t1 + 1e-9)
    t0, t1 = np.minimum(t0, 1.0)[met], np.maximum(t1, 0.0)[met]
    at = [p[met] + t * (q - p)[met] for t in (t0, t1) for p, q in ((x1, x2), (y1, y2))]
    return at, own[met]


# Cells around a unit's own to look in before the grid gets coarser, by how much, and pieces in one grid at most.
RINGS, COARSER, PIECES = 6, 6, 2_000_000


class NearGrid(LineGrid):
    """Segments by the cells that they pass, for the distance to the nearest."""

    def __init__(self, ends: list[np.ndarray], pieces: list[np.ndarray], own: np.ndarray, box: tuple[float, float, float, float], size: float):
        self.whole = ends
        at, line, _ = self._cut(pieces, 8 * size, box[:2])
        x, y = (at[0] + at[2]) / 2, (at[1] + at[3]) / 2
        self.columns, self.rows = (int((high - low) / size) + 1 for low, high in (box[::2], box[1::2]))
        cx = np.clip(((x - self.x0) / size).astype(np.int64), 0, self.columns - 1)
        cy = np.clip(((y - self.y0) / size).astype(np.int64), 0, self.rows - 1)
        cell = cy * self.columns + cx
        order = np.argsort(cell, kind="stable")
        self.line = own[line][order]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(cell, minlength=self.columns * self.rows))))

    def search(self, ux: np.ndarray, uy: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Lower ``best`` to the squared distance of what lies near; returns the units for which something nearer may lie further out."""
        left, bottom = (ux - self.x0) / self.size, (uy - self.y0) / self.size
        cx, cy = (np.clip(v.astype(np.int64), 0, n - 1) for v, n in ((left, self.columns), (bottom, self.rows)))
        margin = np.minimum(np.minimum(left - cx, cx + 1 - left), np.minimum(bottom - cy, cy + 1 - bottom))
        todo = np.arange(len(ux))
        for k in range(RINGS + 1):
            for dy in range(-k, k + 1):
                for a, b in ((-k, k),) if abs(dy) == k else ((-k, -k), (k, k)):
                    row, begin, end = cy[todo] + dy, np.maximum(cx[todo] + a, 0), np.minimum(cx[todo] + b, self.columns - 1) + 1
                    there = np.flatnonzero((row >= 0) & (row < self.rows) & (begin < end))
                    base = row[there] * self.columns
                    self._try(todo[there], self.first[base + begin[there]], self.first[base + end[there]], ux, uy, best)
            safe = np.maximum(margin[todo] + k, 0.0) * self.size * (1 - 1e-9)
            todo = todo[best[todo] > safe * safe]
            if not len(todo):
                break
        return todo

    def _try(self, unit: np.ndarray, starts: np.ndarray, stops: np.ndarray, ux: np.ndarray, uy: np.ndarray, best: np.ndarray) -> None:
        some = stops > starts
        unit, starts, counts = unit[some], starts[some], (stops - starts)[some]
        upto, a = np.cumsum(counts), 0
        while a < len(unit):
            done = upto[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(upto, done + CHUNK, "right")))
            n = counts[a:b]
            ends = np.cumsum(n)
            line = self.line[np.repeat(starts[a:b] - ends + n, n) + np.arange(int(ends[-1]))]
            own = np.repeat(unit[a:b], n)
            d2 = _squared(*[e[line] for e in self.whole], ux[own], uy[own])
            best[unit[a:b]] = np.minimum(best[unit[a:b]], np.minimum.reduceat(d2, ends - n))
            a = b


def _squared(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distance of places from segments, as :func:`terracell.functions.geometry.point_segment_distance2` has it."""
    dx, dy, px, py = x2 - x1, y2 - y1, x - x1, y - y1
    len2 = dx * dx + dy * dy
    t = np.clip((px * dx + py * dy) / np.where(len2 > 0, len2, 1.0), 0.0, 1.0)
    px, py = x - (x1 + t * dx), y - (y1 + t * dy)
    return px * px + py * py


def _near_size(units: int, lines: int, length: float, unit_area: float, line_area: float) -> float:
    """Cells of two by two units, as cutting a piece costs some four tests, unless those held hardly a piece."""
    a, b = lines / line_area, 1.3 * length / line_area
    return max(2 * np.sqrt(unit_area / units), (np.sqrt(b * b + 16 * a) - b) / (2 * a), 1e-3)


def least_distances(ends: list[np.ndarray], ux: np.ndarray, uy: np.ndarray) -> np.ndarray:
    """Squared distance of each unit from the nearest segment."""
    best = np.full(len(ux), np.inf)
    if not len(ends[0]) or not len(ux):
        return best
    extent = (min(ends[0].min(), ends[2].min()), min(ends[1].min(), ends[3].min()), max(ends[0].max(), ends[2].max()), max(ends[1].max(), ends[3].max()))
    # Parts of the units that a grid serves, with its cell size; none until it is chosen.
    todo: list[tuple[np.ndarray, float | None]] = [(np.arange(len(ux)), None)]
    while todo:
        units, size = todo.pop()
        x, y = ux[units], uy[units]
        wide, high = np.ptp(x), np.ptp(y)
        if size is None:
            length = np.hypot(ends[2] - ends[0], ends[3] - ends[1])
            area = max(max(extent[2], x.max()) - min(extent[0], x.min()), 1.0) * max(max(extent[3], y.max()) - min(extent[1], y.min()), 1.0)
            size = _near_size(len(units), len(ends[0]), float(length.sum()), max(wide, 1.0) * max(high, 1.0), area)
        reach = (RINGS + 1) * size
        box = (x.min() - reach, y.min() - reach, x.max() + reach, y.max() + reach)
        pieces, own = _clip(ends, *box)
        count = len(own) + 1.3 * float(np.hypot(pieces[2] - pieces[0], pieces[3] - pieces[1]).sum()) / size
        cells = (box[2] - box[0]) / size * (box[3] - box[1]) / size
        if max(count, cells) > PIECES and max(wide, high) > 2 * size:
            along = x if wide >= high else y
            low = along < (along.min() + along.max()) / 2
            todo += [(units[low], size), (units[~low], size)]
            continue
        found = best[units]
        left = NearGrid(ends, pieces, own, box, size).search(x, y, found)
        best[units] = found
        if len(left):
            todo.append((units[left], COARSER * size))
    return best


def finder(unit: str):
    """The function for a block: units and segments to one row a unit with its distance from the nearest segment, if there is any."""

    def run(units: pa.Table, lines: pa.Table) -> pa.Table:
        ux, uy = (units.column(c).to_numpy() for c in ("x", "y"))
        ends = [lines.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2")]
        # An edge comes with each of its pieces.
        order = np.lexsort(ends)
        ends = [e[order] for e in ends]
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.any([e[1:] != e[:-1] for e in ends], axis=0)
        least = least_distances([e[fresh] for e in ends], ux, uy)
        return pa.table([units.column(unit), pa.array(np.sqrt(least), mask=np.isinf(least))], [unit, "distance"])

    return run


def _on_lines(piece: list[np.ndarray], line: list[np.ndarray], ux: np.ndarray, uy: np.ndarray) -> list[np.ndarray]:
    """Ends of pieces, found anew on the lines they were cut from, about a corner near the units: places in metres of a country have few digits left."""
    (x1, y1, x2, y2), (ox, oy) = line, (np.floor(u.min()) for u in (ux, uy))
    dx, dy = x2 - x1, y2 - y1
    len2 = np.maximum(dx * dx + dy * dy, np.finfo(float).tiny)
    ends = []
    for px, py in (piece[:2], piece[2:]):
        t = ((px - x1) * dx + (py - y1) * dy) / len2
        near, last = t < 0.5, (px == x2) & (py == y2)
        t = np.where(last, 0.0, np.where(near, t, t - 1.0))
        near &= ~last
        ends += [np.where(near, x1, x2) - ox + t * dx, np.where(near, y1, y2) - oy + t * dy]
    return ends


def area_measurer(unit: str, by: list[str], radius: float, shape: str):
    """The function for a tile: units and polygon edges to one row for a unit and group of polygons that has boundary in its zone."""

    def run(units: pa.Table, edges: pa.Table) -> pa.Table:
        ux, uy = (units.column(c).to_numpy() for c in ("x", "y"))
        ends = _on_lines(*([edges.column(p + c).to_numpy() for c in ("x1", "y1", "x2", "y2")] for p in ("", "_")), ux, uy) if len(ux) else []
        if len(ux):
            ux, uy = ux - np.floor(ux.min()), uy - np.floor(uy.min())
        own, group, area = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        groups = edges.select(by).to_pandas().groupby(by, dropna=False, sort=False).ngroup().to_numpy() if len(ux) else np.zeros(0, np.int64)
        order = np.argsort(groups, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(groups[order])) + 1) if len(order) else []:
            found, pieces = AreaGrid([e[rows] for e in ends], radius).areas(ux, uy, radius, shape)
            met = np.flatnonzero(pieces)
            own.append(met)
            group.append(np.full(len(met), rows[0]))
            area.append(found[met])
        own, group = np.concatenate(own), np.concatenate(group)
        return pa.table([units.column(unit).take(pa.array(own)), *[edges.column(b).take(pa.array(group)) for b in by], pa.array(np.concatenate(area))], [unit, *by, "area"])

    return run
