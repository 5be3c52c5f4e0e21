"""Lengths of lines in many 32-gons of one size at once: the arithmetic of one task in numpy, for tasks in which units and lines are many.

A cell at the rim of a zone is cut by one of 32 sides, whatever the zone. How much length a cell has below a line of given direction is a
function of the line's offset that is linear between the ends of pieces, so the pieces of a cell are sorted in once for all zones that cut it
with that side: their cost adds up, it does not multiply. Only in cells that hold a corner of a zone are pieces tested one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from ..functions.geometry import APOTHEM, SIDES, STEP
from .counting import CHUNK, cut_lines, shares

# Pieces of a square that are held at once, its cells a side at most, and pairs of a unit and a cell at its rim that meet them at once.
HELD, ACROSS, MET = 400_000, 64, 3_000_000
# Nanoseconds for a piece with all its directions, a test at a corner, a cell at a rim, a square's cell, and a test of a line grid.
PIECE, TEST, RIM, CELL, OLD = 2200.0, 22.0, 250.0, 150_000.0, 110.0

_MIDDLES = (np.arange(SIDES) + 0.5) * STEP
NX, NY = np.cos(_MIDDLES), np.sin(_MIDDLES)
_CORNERS = np.arange(SIDES + 1) * STEP
CX, CY = np.cos(_CORNERS), np.sin(_CORNERS)


def rim_size(units: int, lines: int, length: float, wide: float, high: float, r: float) -> float | None:
    """Cells that cost least, or None where a line grid costs less: halved cells have twice the pieces, but half the tests at corners."""
    wide, high = max(wide, r / 8), max(high, r / 8)
    area = wide * high
    # Units near the rim of the layer have but a part of their own rim in it.
    own = units * area / ((wide + 2 * r) * (high + 2 * r))
    crowd = 1.27 * length / area

    def cost(size: float) -> float:
        tests = own * (SIDES + 8) * crowd * size
        return (lines + 1.27 * length / size) * PIECE + tests * TEST + own * 10 * r / size * RIM + area / size**2 * CELL

    best = min((r / 12 / 2**k for k in range(5)), key=cost)
    return best if cost(best) < own * 80 * crowd * r / 8 * OLD else None


def gon_lengths(ends: list[np.ndarray], weight: np.ndarray, ux: np.ndarray, uy: np.ndarray, r: float, size: float) -> tuple[np.ndarray, np.ndarray]:
    """Weight x length of the lines in the 32-gon around each unit, and of how many pieces there is a part in it."""
    mass = weight * np.hypot(ends[2] - ends[0], ends[3] - ends[1])
    west, south = min(ends[0].min(), ends[2].min()), min(ends[1].min(), ends[3].min())
    area = max(max(ends[0].max(), ends[2].max()) - west, size) * max(max(ends[1].max(), ends[3].max()) - south, size)
    crowd = (len(mass) + 1.27 * np.hypot(ends[2] - ends[0], ends[3] - ends[1]).sum() / size) / area
    across = int(np.clip(np.sqrt(HELD / crowd) / size, 4, ACROSS))
    side = across * size
    total, rows = np.zeros(len(ux)), np.zeros(len(ux), np.int64)
    at, line, part = cut_lines(ends, side, (west, south))
    sx, sy = (np.floor(((p + q) / 2 - o) / side).astype(np.int64) for p, q, o in ((at[0], at[2], west), (at[1], at[3], south)))
    key = sy * (int(sx.max()) + 1) + sx
    order = np.argsort(key, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
        left, bottom = west + sx[own[0]] * side, south + sy[own[0]] * side
        gap = np.hypot(*(np.maximum(0.0, np.maximum(o - u, u - o - side)) for u, o in ((ux, left), (uy, bottom))))
        met = np.flatnonzero(gap <= r)
        if len(met):
            square = _Square([e[own] for e in at], mass[line[own]] * part[own], left, bottom, size, across, r)
            found, some = square.sums(ux[met], uy[met])
            total[met] += found
            rows[met] += some
    return total, rows


class _Square:
    """Pieces of lines in the cells of a square."""

    def __init__(self, ends: list[np.ndarray], mass: np.ndarray, left: float, bottom: float, size: float, across: int, r: float):
        self.left, self.bottom, self.size, self.across, self.r = left, bottom, size, across, r
        at, line, part = cut_lines(ends, size, (left, bottom))
        cx, cy = (
            np.clip(((p + q) / 2 - o) / size, 0, across - 1).astype(np.int64) for p, q, o in ((at[0], at[2], left), (at[1], at[3], bottom))
        )
        cell = cy * across + cx
        order = np.argsort(cell, kind="stable")
        self.base, self.mass = cell[order].astype(float), (mass[line] * part)[order]
        # Ends are kept from the middle of their cell.
        self.ends = [(e - (o + (c + 0.5) * size))[order] for e, c, o in zip(at, (cx, cy) * 2, (left, bottom) * 2)]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(cell, minlength=across * across))))
        self.upto = np.concatenate(([0], np.cumsum(self.mass, dtype=np.longdouble)))

    def sums(self, ux: np.ndarray, uy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, rows = np.zeros(len(ux)), np.zeros(len(ux), np.int64)
        side, safe = self.across * self.size, self.r * APOTHEM - 1e-6
        far = np.hypot(*(np.maximum(np.abs(u - o), np.abs(u - o - side)) for u, o in ((ux, self.left), (uy, self.bottom))))
        whole = far < safe
        total[whole], rows[whole] = float(self.upto[-1]), len(self.mass)
        cut = np.flatnonzero(~whole)
        held: list[tuple[np.ndarray, ...]] = []
        step = max(1, CHUNK // (2 * self.across))
        for a in range(0, len(cut), step):
            held += self._rims(cut[a : a + step], ux, uy, total, rows)
            if sum(len(h[0]) for h in held) > MET:
                self._settle(held, ux, uy, total, rows)
                held = []
        self._settle(held, ux, uy, total, rows)
        return total, rows

    def _rims(self, own: np.ndarray, ux: np.ndarray, uy: np.ndarray, total: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Pairs of units and cells that the rim of their zone cuts, with the sides that do and how far off; all other cells are added up."""
        size, across, r, safe = self.size, self.across, self.r, self.r * APOTHEM - 1e-6
        x, y = ux[own][:, None] - self.left, uy[own][:, None] - self.bottom
        row = np.arange(across)
        low = row * size
        near = np.maximum(0.0, np.maximum(low - y, y - low - size) - 1e-6)
        reach = np.where(near <= r, np.sqrt(np.maximum(0.0, r * r - near * near)) + 1e-6, -1.0)

        def column(v: np.ndarray) -> np.ndarray:
            return np.clip(v, 0, across).astype(np.int64)

        begin = column(np.floor((x - reach) / size))
        end = np.where(reach < 0, begin, np.maximum(begin, column(np.floor((x + reach) / size) + 1)))
        far = np.maximum(y - low, low + size - y)
        inner = np.sqrt(np.maximum(0.0, safe * safe - far * far))
        opens, closes = column(np.ceil((x - inner) / size)), column(np.floor((x + inner) / size))
        covered = (far < safe) & (closes > opens)
        opens, closes = np.where(covered, opens, end), np.where(covered, closes, end)
        at = [self.first[row * across + c] for c in (opens, closes)]
        total[own] += np.sum(self.upto[at[1]] - self.upto[at[0]], axis=1).astype(float)
        rows[own] += np.sum(at[1] - at[0], axis=1)
        starts = np.stack((row * across + begin, row * across + closes), 2).ravel()
        counts = np.stack((opens - begin, end - closes), 2).ravel()
        upto, a = np.cumsum(counts), 0
        while a < len(counts):
            done = upto[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(upto, done + CHUNK, "right")))
            n = counts[a:b]
            cell = np.repeat(starts[a:b] - (upto[a:b] - n - done), n) + np.arange(int(n.sum()))
            unit = own[np.repeat(np.arange(a, b) // (2 * across), n)]
            some = self.first[cell + 1] > self.first[cell]
            yield self._sided(unit[some], cell[some], ux, uy, total, rows)
            a = b

    def _sided(self, unit: np.ndarray, cell: np.ndarray, ux: np.ndarray, uy: np.ndarray, total: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """What of the pairs is cut: unit, cell, the first side that cuts and the room to it, and the same of a second one, or side -1."""
        size = self.size
        qx = self.left + (cell % self.across + 0.5) * size - ux[unit]
        qy = self.bottom + (cell // self.across + 0.5) * size - uy[unit]
        middle = np.floor(np.mod(np.arctan2(qy, qx), 2 * np.pi) / STEP).astype(np.int64)
        side, room = np.full((2, len(unit)), -1), np.zeros((2, len(unit)))
        inside, cuts = np.zeros(len(unit), bool), np.zeros(len(unit), np.int64)
        # Cells are much smaller than a side, so none but the three sides around their middle can come into them.
        for turn in (-1, 1, 0):
            k = (middle + turn) % SIDES
            left = self.r * APOTHEM - (NX[k] * qx + NY[k] * qy)
            crossed = np.flatnonzero(np.abs(left) < size / 2 * (np.abs(NX[k]) + np.abs(NY[k])) + 1e-9)
            # The line of a side may run through a cell that the side itself does not reach.
            for ends, q in ((CX, qx), (CY, qy)):
                p, c = ends[k[crossed]] * self.r - q[crossed], ends[k[crossed] + 1] * self.r - q[crossed]
                crossed = crossed[(np.minimum(p, c) < size / 2 + 1e-9) & (np.maximum(p, c) > -size / 2 - 1e-9)]
            nth = cuts[crossed]
            kept = nth < 2
            side[nth[kept], crossed[kept]], room[nth[kept], crossed[kept]] = k[crossed[kept]], left[crossed[kept]]
            cuts[crossed] += 1
            inside = left > 0
        full = np.flatnonzero(inside & (cuts == 0))
        n = len(total)
        total += np.bincount(unit[full], (self.upto[self.first[cell[full] + 1]] - self.upto[self.first[cell[full]]]).astype(float), n)
        rows += np.bincount(unit[full], self.first[cell[full] + 1] - self.first[cell[full]], n).astype(np.int64)
        many = np.flatnonzero(cuts > 2)
        for i in many:
            here = slice(self.first[cell[i]], self.first[cell[i] + 1])
            share = shares(*(e[here] + q for e, q in zip(self.ends, (qx[i], qy[i]) * 2)), self.r, "poly32")
            total[unit[i]] += share @ self.mass[here]
            rows[unit[i]] += np.count_nonzero(share)
        kept = np.flatnonzero((cuts > 0) & (cuts <= 2))
        return (
            unit[kept].astype(np.int32), cell[kept].astype(np.int32), side[0, kept].astype(np.int8), room[0, kept], side[1, kept].astype(np.int8), room[1, kept],
        )

    def _settle(self, held: list[tuple[np.ndarray, ...]], ux: np.ndarray, uy: np.ndarray, total: np.ndarray, rows: np.ndarray) -> None:
        if not held:
            return
        unit, cell, side, room, other, space = (np.concatenate(h) for h in zip(*held))
        n = len(total)
        single = other < 0
        for axis in range(SIDES // 2):
            at = np.flatnonzero(single & (side % (SIDES // 2) == axis))
            if len(at):
                found, some = self._below(axis, cell[at], room[at], side[at] >= SIDES // 2)
                total += np.bincount(unit[at], found, n)
                rows += np.bincount(unit[at], some, n).astype(np.int64)
        at = np.flatnonzero(~single)
        order = at[np.argsort(cell[at], kind="stable")]
        found, some = np.zeros(len(unit)), np.zeros(len(unit), np.int64)
        for own in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(order) else []:
            found[own], some[own] = self._corners(int(cell[own[0]]), side[own], room[own], other[own], space[own])
        total += np.bincount(unit[order], found[order], n)
        rows += np.bincount(unit[order], some[order], n).astype(np.int64)

    def _below(self, axis: int, cell: np.ndarray, room: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of pieces within ``room`` of the middle of a cell along an axis, against it where ``turned``, and how many pieces have a part there."""
        nx, ny = NX[axis], NY[axis]
        half = self.size / 2 * (abs(nx) + abs(ny)) * (1 + 1e-6) + 1e-6

        # Queries stand in order of their cells and of buckets in them; a table tells how many stand before each bucket.
        buckets = 1 << int(np.clip(np.ceil(np.log2(len(room) / max(1, len(self.first) - 1) + 1)) + 1, 1, 7))
        scale = buckets / (2 * half)

        def placed(v: np.ndarray) -> np.ndarray:
            return np.clip((v + half) * scale, 0.0, buckets - 1e-6)

        t = np.where(turned, -room, room)
        key = cell * float(buckets) + placed(t)
        order = np.argsort(key, kind="stable")
        t, cell, key = t[order], cell[order].astype(np.int64), key[order]
        before = np.concatenate(([0], np.cumsum(np.bincount(key.astype(np.int64), minlength=(len(self.first) - 1) * buckets)))).astype(np.int32)
        key = np.append(key, np.inf)

        def passed(v: np.ndarray) -> np.ndarray:
            """How many queries stand at or before each piece's place, as np.searchsorted tells it."""
            want = self.base * buckets + placed(v)
            at = before[want.astype(np.int64)]
            todo = np.flatnonzero(key[at] <= want)
            while len(todo):
                at[todo] += 1
                todo = todo[key[at[todo]] <= want[todo]]
            return at

        p, q = self.ends[0] * nx + self.ends[1] * ny, self.ends[2] * nx + self.ends[3] * ny
        low, high = np.minimum(p, q), np.maximum(p, q)
        n, wide = len(t) + 1, high - low > half / 16
        begins, stops = passed(low), passed(high)
        slope = np.where(wide, self.mass / np.where(wide, high - low, 1.0), 0.0)
        base = slope * low
        rise = np.cumsum(np.bincount(begins, slope, n) - np.bincount(stops, slope, n), dtype=np.longdouble)[:-1]
        level = np.cumsum(np.bincount(stops, base + self.mass, n) - np.bincount(begins, base, n), dtype=np.longdouble)[:-1]
        found = (level + rise * t - self.upto[self.first[cell]]).astype(float)
        # A piece all but along the line would have a slope that drowns the others'.
        steep = np.flatnonzero(~wide & (stops > begins))
        for a in range(0, len(steep), CHUNK):
            own = steep[a : a + CHUNK]
            count = stops[own] - begins[own]
            piece = np.repeat(own, count)
            query = np.repeat(begins[own] - (np.cumsum(count) - count), count) + np.arange(len(piece))
            part = np.clip((t[query] - low[piece]) / np.maximum(high[piece] - low[piece], 1e-300), 0.0, 1.0)
            found += np.bincount(query, part * self.mass[piece], len(t))
        begun, ended = (np.cumsum(np.bincount(v, minlength=n))[:-1] - self.first[cell] for v in (begins, stops))
        whole, pieces = (self.upto[self.first[cell + 1]] - self.upto[self.first[cell]]).astype(float), self.first[cell + 1] - self.first[cell]
        total, rows = np.empty(len(t)), np.empty(len(t), np.int64)
        turned = turned[order]
        total[order], rows[order] = np.where(turned, whole - found, found), np.where(turned, pieces - ended, begun)
        return total, rows

    def _corners(self, cell: int, side: np.ndarray, room: np.ndarray, other: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the pieces of a cell within two sides."""
        here = slice(self.first[cell], self.first[cell + 1])
        ax, ay, bx, by = (e[here] for e in self.ends)
        mass, half = self.mass[here], SIDES // 2
        p, q = (np.multiply.outer(NX[:half], x) + np.multiply.outer(NY[:half], y) for x, y in ((ax, ay), (bx, by)))
        low, high = np.minimum(p, q), np.maximum(p, q)
        # A piece along the side is inside with any room to it.
        rate = 1 / np.maximum(high - low, 1e-300)
        low, rate, out = np.concatenate((low, -high)), np.concatenate((rate, rate)), np.concatenate((q > p, q < p))
        total, rows = np.empty(len(side)), np.empty(len(side), np.int64)
        step = max(1, CHUNK // len(mass))
        for a in range(0, len(total), step):
            k, o = side[a : a + step], other[a : a + step]
            parts = []
            for some, left in ((k, room), (o, space)):
                part = left[a : a + step, None] - low[some]
                part *= rate[some]
                parts.append(np.minimum(part, 1.0, out=part))
            one, two = parts
            # Pieces that leave one side where they come in by the other have in common what is more than the whole.
            part = np.where(out[k] == out[o], np.minimum(one, two), one + two - 1.0)
            np.maximum(part, 0.0, out=part)
            total[a : a + step], rows[a : a + step] = part @ mass, np.count_nonzero(part, axis=1)
        return total, rows
