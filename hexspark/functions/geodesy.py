"""Length of WKB lines on the WGS84 spheroid, in metres, vectorised over Arrow batches."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_A, _F = 6378137.0, 1 / 298.257223563
_B = _A * (1 - _F)


def inverse_m(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Geodesic distance by Vincenty's inverse formula, and by `antipodal_m` where that does not settle."""
    l = np.radians(lon2 - lon1)
    u1, u2 = (np.arctan((1 - _F) * np.tan(np.radians(x))) for x in (lat1, lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = l.copy()
    with np.errstate(all="ignore"):
        for _ in range(100):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cs = s1 * s2 + c1 * c2 * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0.0, c1 * c2 * sl / ss)
            ca = 1 - sa**2
            cm = np.where(ca == 0, 0.0, cs - 2 * s1 * s2 / ca)
            c = _F / 16 * ca * (4 + _F * (4 - 3 * ca))
            new = l + (1 - c) * _F * sa * (sigma + c * ss * (cm + c * cs * (-1 + 2 * cm**2)))
            moved = np.abs(new - lam)
            lam = new
            if not (moved > 1e-12).any():
                break
        k = ca * (_A**2 - _B**2) / _B**2
        a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        d = b * ss * (cm + b / 4 * (cs * (-1 + 2 * cm**2) - b / 6 * cm * (-3 + 4 * ss**2) * (-3 + 4 * cm**2)))
        out = _B * a * (sigma - d)
    l = np.abs((l + np.pi) % (2 * np.pi) - np.pi)
    hard = np.flatnonzero((moved > 1e-12) | ~np.isfinite(out) | (np.abs(lam) > np.pi))
    hard = hard[np.isfinite(l[hard]) & np.isfinite(u1[hard]) & np.isfinite(u2[hard])]
    if len(hard):
        out[hard] = antipodal_m(u1[hard], u2[hard], l[hard])
    return out


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(40)


def antipodal_m(u1: np.ndarray, u2: np.ndarray, l: np.ndarray) -> np.ndarray:
    """Distance of points of reduced latitudes u1 and u2 that lie l apart in longitude, 0 to pi, all in radians; for any pair.

    The point farther from the equator is put into the south and looked from.  The longitude that a geodesic has gained at the other's
    latitude grows with its azimuth there from 0 to pi, so halving finds the azimuth that gains l; the two integrals along the
    geodesic are taken numerically.
    """
    far = np.abs(u1) >= np.abs(u2)
    a, b = np.where(far, u1, u2), np.where(far, u2, u1)
    b, a = np.where(a > 0, -b, b), -np.abs(a)
    sa, ca, sb, cb = np.minimum(np.sin(a), -1e-200), np.cos(a), np.sin(b), np.cos(b)
    e2 = (_A**2 - _B**2) / _B**2

    def line(azimuth: np.ndarray) -> tuple[np.ndarray, ...]:
        sz, cz = np.sin(azimuth), np.cos(azimuth)
        s0 = sz * ca  # sine of the azimuth at the equator
        c2 = np.sqrt(np.maximum(0, (cz * ca) ** 2 + (cb - ca) * (cb + ca)))  # times the cosine of b
        start, end = np.arctan2(sa, cz * ca), np.arctan2(sb, c2)
        w1, w2 = np.arctan2(s0 * np.sin(start), np.cos(start)), np.arctan2(s0 * np.sin(end), np.cos(end))
        half = (end - start) / 2
        at = (end + start)[:, None] / 2 + half[:, None] * _NODES
        root = np.sqrt(1 + e2 * (1 - s0**2)[:, None] * np.sin(at) ** 2)
        gained = (w2 - w1) % (2 * np.pi) - _F * s0 * half * (((2 - _F) / (1 + (1 - _F) * root)) @ _WEIGHTS)
        return gained, _B * half * (root @ _WEIGHTS)

    low, high = np.zeros(len(l)), np.full(len(l), np.pi)
    for _ in range(64):
        middle = (low + high) / 2
        less = line(middle)[0] < l
        low, high = np.where(less, middle, low), np.where(less, high, middle)
    out = line((low + high) / 2)[1]
    # Along the equator, and the same point.
    flat = (np.abs(u1) < 1e-15) & (np.abs(u2) < 1e-15) & (l <= (1 - _F) * np.pi)
    return np.where(flat, _A * l, out)


def _lines(wkb: bytes, at: int = 0) -> tuple[list[np.ndarray], int]:
    """Coordinates of the lines of a WKB LineString, MultiLineString or collection; EWKB and Z/M are understood."""
    order = "<" if wkb[at] == 1 else ">"
    (kind,) = struct.unpack_from(order + "I", wkb, at + 1)
    at += 5
    if kind & 0x20000000:
        at += 4
    dims = 2 + bool(kind & 0x80000000 or kind % 10000 // 1000 in (1, 3)) + bool(kind & 0x40000000 or kind % 10000 // 1000 in (2, 3))
    base = (kind & 0x0FFFFFFF) % 1000
    if base == 1:
        return [], at + 8 * dims
    (n,) = struct.unpack_from(order + "I", wkb, at)
    at += 4
    if base == 2:
        xy = np.frombuffer(wkb, order + "f8", n * dims, at).reshape(n, dims)[:, :2]
        return [xy.astype(np.float64)], at + 8 * n * dims
    out: list[np.ndarray] = []
    if base == 3:  # rings of an area have no length here
        for _ in range(n):
            (m,) = struct.unpack_from(order + "I", wkb, at)
            at += 4 + 8 * m * dims
        return out, at
    for _ in range(n):
        part, at = _lines(wkb, at)
        out += part
    return out, at


def _plain_lines(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which byte ranges are little-endian two-dimensional WKB LineStrings of their declared length, and their numbers of points."""
    plain = np.flatnonzero(size >= 9)
    head = raw[start[plain][:, None] + np.arange(9)]
    points = np.ascontiguousarray(head[:, 5:]).view("<u4").ravel().astype(np.int64)
    ok = (head[:, 0] == 1) & (np.ascontiguousarray(head[:, 1:5]).view("<u4").ravel() == 2) & (size[plain] == 9 + 16 * points)
    return plain[ok], points[ok]


def length_m(shapes: pa.Array) -> pa.Array:
    """Length of each WKB geometry in metres, coordinates being longitude and latitude; null for null.

    Plain lines, which nearly all are, are decoded together, by their number of points; others one by one.
    """
    none = np.asarray(shapes.is_null().to_numpy(zero_copy_only=False))
    filled = shapes.cast(pa.binary()).fill_null(b"")
    _, bounds, data = filled.buffers()
    at = np.frombuffer(bounds, np.int32)[filled.offset : filled.offset + len(filled) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    plain, points = _plain_lines(raw, at[:-1], np.diff(at))
    xy, owner = [np.zeros((0, 4))], [np.zeros(0, np.int64)]
    for n in np.unique(points[points > 1]).tolist():
        rows = plain[points == n]
        line = np.ascontiguousarray(raw[at[rows][:, None] + 9 + np.arange(16 * n)]).view("<f8").reshape(len(rows), n, 2)
        xy.append(np.concatenate([line[:, :-1], line[:, 1:]], axis=2).reshape(-1, 4))
        owner.append(np.repeat(rows, n - 1))
    for i in np.setdiff1d(np.flatnonzero(np.diff(at) > 0), plain).tolist():
        for line in _lines(raw[at[i] : at[i + 1]].tobytes())[0]:
            if len(line) > 1:
                xy.append(np.hstack([line[:-1], line[1:]]))
                owner.append(np.full(len(line) - 1, i))
    p, own = np.concatenate(xy), np.concatenate(owner)
    out = np.bincount(own, inverse_m(p[:, 0], p[:, 1], p[:, 2], p[:, 3]), len(shapes)) if len(p) else np.zeros(len(shapes))
    return pa.array(out, mask=none)


def spheroid_length(geometry: Column | str) -> Column:
    """Length of a WKB column in metres."""

    @F.arrow_udf("double")
    def run(shapes: pa.Array) -> pa.Array:
        return length_m(shapes)

    return run(geometry)


def line_wkb(points: list[tuple[float, float]]) -> bytes:
    """A WKB LineString, little endian."""
    return struct.pack("<BII", 1, 2, len(points)) + b"".join(struct.pack("<dd", *p) for p in points)


def segment_wkb(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """WKB LineStrings of two points each."""

    @F.arrow_udf("binary")
    def run(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        points = np.stack([x.to_numpy(zero_copy_only=False) for x in (a, b, c, d)], axis=1).astype("<f8").view(np.uint8).reshape(-1, 32)
        head = np.frombuffer(struct.pack("<BII", 1, 2, 2), np.uint8)
        whole = np.hstack([np.broadcast_to(head, (len(points), 9)), points]).tobytes()
        return pa.array([whole[i : i + 41] for i in range(0, len(whole), 41)], pa.binary())

    return run(lon1, lat1, lon2, lat2)
