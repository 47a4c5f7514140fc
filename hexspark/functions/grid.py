"""The hexagonal grid: points to cells, and cells to centres and boundaries.

A point is projected from the centre of the globe onto the nearest face of an icosahedron, rounded to a
hexagon there, and addressed by its ancestors: a base cell and one digit (0 to 6) per resolution, each
level being seven times as fine and turned by 19 degrees against the one before.  The 122 base cells,
numbered from north to south, and the turns between faces are derived from the geometry.  If the public
`h3` package is installed, it computes cells in this module's stead.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Latitude, longitude and azimuth of the first axis of each face, in radians.
FACES = np.array([
    (0.803582649718989942, 1.248397419617396099, 5.619958268523939882), (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
    (1.054751253523952054, -1.347517358900396623, 0.780213654393430055), (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
    (0.491715428198773866, 0.401988202911306943, 6.130269123335111400), (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
    (0.605929321571350690, 2.953923329812411617, 2.982963003477243874), (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
    (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154), (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
    (0.079066118549212831, 2.408163140208925497, 5.930472956509811562), (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
    (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361), (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
    (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535), (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
    (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316), (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
    (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436), (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
])
_UNIT = 0.38196601125010500003  # of the coarsest hexagons, on the plane of a face
_TURN = np.arcsin(np.sqrt(3 / 28))
_SIN60 = np.sqrt(3) / 2
#: Offsets (i, j) of the digits: none, k, j, j+k, i, i+k, i+j.
_OFFSETS = np.array([(0, 0), (-1, -1), (0, 1), (-1, 0), (1, 0), (0, -1), (1, 1)])
_DIGIT = np.zeros((3, 3), np.int64)
_DIGIT[_OFFSETS[:, 0] + 1, _OFFSETS[:, 1] + 1] = np.arange(7)
#: Digits after a turn of 60 degrees to the left.
_LEFT = np.array([0, 5, 3, 1, 6, 4, 2])


def _xyz(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=-1)


_CENTRES = _xyz(FACES[:, 0], FACES[:, 1])


def _azimuth(lat1, lon1, lat2, lon2):
    return np.arctan2(np.cos(lat2) * np.sin(lon2 - lon1), np.cos(lat1) * np.sin(lat2) - np.sin(lat1) * np.cos(lat2) * np.cos(lon2 - lon1))


def _plane(lat, lon, face, res):
    """Coordinates on the plane of a face, in units of the resolution's hexagons."""
    r = np.arccos(np.clip((_xyz(lat, lon) * _CENTRES[face]).sum(-1), -1, 1))
    angle = FACES[face, 2] - _azimuth(FACES[face, 0], FACES[face, 1], lat, lon) - (res % 2) * _TURN
    r = np.tan(r) / _UNIT * np.sqrt(7.0) ** res
    return r * np.cos(angle), r * np.sin(angle)


def _globe(x, y, face, res):
    """Latitude and longitude of a point on the plane of a face."""
    r = np.arctan(np.hypot(x, y) / np.sqrt(7.0) ** res * _UNIT)
    az = FACES[face, 2] - (np.arctan2(y, x) + (res % 2) * _TURN)
    lat0, lon0 = FACES[face, 0], FACES[face, 1]
    lat = np.arcsin(np.clip(np.sin(lat0) * np.cos(r) + np.cos(lat0) * np.sin(r) * np.cos(az), -1, 1))
    lon = lon0 + np.arctan2(np.sin(az) * np.sin(r) * np.cos(lat0), np.cos(r) - np.sin(lat0) * np.sin(lat))
    return lat, (lon + np.pi) % (2 * np.pi) - np.pi


def _face_of(lat, lon):
    return (_xyz(lat, lon) @ _CENTRES.T).argmax(-1)


def _near(x, y):
    """The hexagon (i, j) that holds a point of the plane."""
    r = y / _SIN60
    q = x - r / 2
    s = -q - r
    a, b, c = np.round(q), np.round(r), np.round(s)
    da, db, dc = np.abs(a - q), np.abs(b - r), np.abs(c - s)
    first = (da > db) & (da > dc)
    a = np.where(first, -b - c, a)
    b = np.where(~first & (db > dc), -a - c, b)
    return (a + b).astype(np.int64), b.astype(np.int64)


def _point(i, j):
    return i - j / 2, j * _SIN60


def _up(i, j, turned):
    """The hexagon of the next coarser level; turned: from an odd resolution."""
    a, b = np.where(turned, 3 * i - j, 2 * i + j), np.where(turned, i + 2 * j, 3 * j - i)
    return np.floor(a / 7 + 0.5).astype(np.int64), np.floor(b / 7 + 0.5).astype(np.int64)


def _down(i, j, turned):
    """The middle hexagon of the next finer level; turned: to an odd resolution."""
    return np.where(turned, 2 * i + j, 3 * i - j), np.where(turned, 3 * j - i, i + 2 * j)


@cache
def _bases():
    """Base cells by face and place: number, turns to the base cell's own frame; which are pentagons; and the seam side.

    A pentagon's five faces take five of six sectors of its frame in order, leaving out that of digit 1;
    seam is 1 or -1 for the faces on either side of the gap.
    """
    inside = [(0, 0), (1, 0), (0, 1), (-1, -1), (1, 1), (-1, 0), (0, -1), (2, 0), (0, 2), (-2, -2)]
    points = []
    for f in range(20):
        for i, j in inside:
            points.append(np.array(_globe(*_point(i, j), f, 0)))
    vectors = np.array([_xyz(*p) for p in points])
    unique: list[int] = []
    for n in range(len(vectors)):
        if not unique or (vectors[unique] @ vectors[n]).max() < np.cos(0.01):
            unique.append(n)
    unique.sort(key=lambda n: (-round(float(points[n][0]), 9), float(points[n][1])))
    centres, latlon = vectors[unique], np.array([points[n] for n in unique])
    home = [(n // 10, inside[n % 10]) for n in unique]
    pent = np.array([abs(ij[0]) + abs(ij[1]) in (2, 4) and ij in ((2, 0), (0, 2), (-2, -2)) for _, ij in home])

    def heading(f: int, i: int, j: int, b: int) -> float:
        x, y = _point(i, j)
        lat, lon = _globe(x + 0.05, y, f, 0)
        lat0, lon0 = _globe(x, y, f, 0)
        return float(_azimuth(lat0, lon0, lat, lon))

    base = np.full((20, 7, 7), -1)
    turns, seam = np.zeros((20, 7, 7), np.int64), np.zeros((20, 7, 7), np.int64)
    spots: list[list[tuple[int, int, int]]] = [[] for _ in unique]
    for f in range(20):
        for i in range(-3, 4):
            for j in range(-3, 4):
                low = min(i, j, 0)
                if max(i - low, j - low, -low) > 2:
                    continue
                at = np.array(_globe(*_point(i, j), f, 0))
                b = int((centres @ _xyz(*at)).argmax())
                base[f, i + 3, j + 3] = b
                spots[b].append((f, i, j))
                if not pent[b]:
                    hf, (hi, hj) = home[b]
                    turns[f, i + 3, j + 3] = round((heading(hf, hi, hj, b) - heading(f, i, j, b)) / (np.pi / 3)) % 6
    for b in np.flatnonzero(pent):
        # The faces around it, to the left (against the compass), from the first.
        around = sorted((float(-_azimuth(*latlon[b], FACES[f, 0], FACES[f, 1])) % (2 * np.pi), f, i, j) for f, i, j in spots[b] if (i, j) in ((2, 0), (0, 2), (-2, -2)))
        for k, (_, f, i, j) in enumerate(around):
            inward = {(2, 0): 3, (0, 2): 5, (-2, -2): 1}[i, j]  # sixths of a turn from axis i to the face's middle
            turns[f, i + 3, j + 3] = (5 + k - inward) % 6  # the first sector is that of digit 5
            seam[f, i + 3, j + 3] = 1 if k == 4 else -1 if k == 0 else 0
    return base, turns, seam, pent, spots


def _turned(digits: np.ndarray, times: np.ndarray) -> np.ndarray:
    for t in range(1, 6):
        rows = times >= t
        digits[rows] = _LEFT[digits[rows]]
    return digits


def _leading(digits: np.ndarray) -> np.ndarray:
    if not digits.shape[1]:
        return np.zeros(len(digits), np.int64)
    return digits[np.arange(len(digits)), (digits != 0).argmax(1)]


def cells_of(lat: np.ndarray, lon: np.ndarray, res: int) -> np.ndarray:
    """Cell of each point given in degrees; 0 for coordinates that are not finite."""
    if not 0 <= res <= 15:
        raise ValueError(f"no such resolution: {res}")
    ok = np.isfinite(lat) & np.isfinite(lon)
    lat, lon = np.radians(np.where(ok, lat, 0.0)), np.radians(np.where(ok, lon, 0.0))
    face = _face_of(lat, lon)
    i, j = _near(*_plane(lat, lon, face, res))
    digits = np.zeros((len(lat), res), np.int64)
    for r in range(res, 0, -1):
        a, b = _up(i, j, r % 2 == 1)
        c, d = _down(a, b, r % 2 == 1)
        digits[:, r - 1] = _DIGIT[np.clip(i - c, -1, 1) + 1, np.clip(j - d, -1, 1) + 1]
        i, j = a, b
    base, turns, seam, pent, _ = _bases()
    at = (face, np.clip(i, -3, 3) + 3, np.clip(j, -3, 3) + 3)
    b = base[at]
    digits = _turned(digits, turns[at])
    gap = pent[b] & (_leading(digits) == 1)
    if gap.any():
        digits[gap] = _turned(digits[gap], np.where(seam[at][gap] >= 0, 1, 5))
    return np.where(ok, _packed(b, digits, res), 0)


def _packed(base: np.ndarray, digits: np.ndarray, res: int) -> np.ndarray:
    out = np.full(len(base), (1 << 59) | (res << 52) | ((1 << (3 * (15 - res))) - 1), np.int64) | (base << 45)
    for r in range(res):
        out |= digits[:, r] << (3 * (14 - r))
    return out


def _placed(cells: np.ndarray, res: int):
    """Face and plane coordinates of the cells' middles, on the face each lies on."""
    b = (cells >> 45) & 127
    digits = np.stack([(cells >> (3 * (14 - r))) & 7 for r in range(res)], axis=1) if res else np.zeros((len(cells), 0), np.int64)
    _, turns, seam, pent, spots = _bases()
    face, x, y = np.zeros(len(cells), np.int64), np.zeros(len(cells)), np.zeros(len(cells))
    done = np.zeros(len(cells), bool)
    score = np.full(len(cells), -np.inf)
    for base in np.unique(b):
        rows = np.flatnonzero(b == base)
        for f, i0, j0 in spots[base]:
            turn = int(turns[f, i0 + 3, j0 + 3])
            own = digits[rows].copy()
            if pent[base]:
                if (i0, j0) not in ((2, 0), (0, 2), (-2, -2)):
                    continue
                # Across the gap a face sees the sector beyond as the one of digit 1.
                lead, side = _leading(own), seam[f, i0 + 3, j0 + 3]
                over = (lead == 5) if side == 1 else (lead == 3) if side == -1 else np.zeros(len(rows), bool)
            options = [own] if not pent[base] else [own, _turned(own.copy(), np.where(over, 5 if side == 1 else 1, 0))] if over.any() else [own]
            for option in options:
                option = _turned(option.copy(), np.full(len(rows), (6 - turn) % 6))
                i, j = np.full(len(rows), i0), np.full(len(rows), j0)
                for r in range(1, res + 1):
                    i, j = _down(i, j, r % 2 == 1)
                    off = _OFFSETS[option[:, r - 1]]
                    i, j = i + off[:, 0], j + off[:, 1]
                px, py = _point(i, j)
                lat, lon = _globe(px, py, f, res)
                v = _xyz(lat, lon) @ _CENTRES.T
                margin = v[:, f] - np.delete(v, f, axis=1).max(1)
                good = np.where(margin > -1e-9, 1.0 + v[:, f], margin)
                # Of the faces that claim a middle, the one whose own address it has.
                better = good > score[rows] + 1e-12
                if pent[base] or len(spots[base]) > 1:
                    probe = better & (margin > -1e-9)
                    if probe.any():
                        again = cells_of(np.degrees(lat[probe]), np.degrees(lon[probe]), res)
                        ok = np.ones(len(rows), bool)
                        ok[probe] = again == cells[rows][probe]
                        better &= ok
                hit = rows[better]
                face[hit], x[hit], y[hit], score[hit] = f, px[better], py[better], good[better]
                done[hit] = True
    return face, x, y


def centres_of(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Latitude and longitude of the cells' middles, in degrees."""
    lat, lon = np.zeros(len(cells)), np.zeros(len(cells))
    resolution = (cells >> 52) & 15
    for res in np.unique(resolution):
        rows = np.flatnonzero(resolution == res)
        face, x, y = _placed(cells[rows], int(res))
        lat[rows], lon[rows] = np.degrees(_globe(x, y, face, int(res)))
    return lat, lon


#: Places of a face's corners, in order around it.
_CORNERS = ((2, 0), (0, 2), (-2, -2))


@cache
def _across():
    """For each face and side (from a corner to the next) the face beyond, and the turn and shift, as complex numbers, that unfold it:
    a point z on the plane of the one is turn * z + shift on that of the other, at resolution 0."""
    base = _bases()[0]
    at = np.array([complex(*_point(i, j)) for i, j in _CORNERS])
    corner = np.array([[base[f, i + 3, j + 3] for i, j in _CORNERS] for f in range(20)])
    beyond, turn, shift = np.zeros((20, 3), np.int64), np.zeros((20, 3), complex), np.zeros((20, 3), complex)
    for f in range(20):
        for k in range(3):
            a, b = corner[f, k], corner[f, (k + 1) % 3]
            (g,) = (g for g in range(20) if g != f and a in corner[g] and b in corner[g])
            za, zb = (at[int(np.flatnonzero(corner[g] == c)[0])] for c in (a, b))
            beyond[f, k] = g
            turn[f, k] = (zb - za) / (at[(k + 1) % 3] - at[k])
            shift[f, k] = za - turn[f, k] * at[k]
    return beyond, turn, shift


def _scale(res: int) -> complex:
    """What takes a plane of resolution 0 to one of `res`."""
    return np.sqrt(7.0) ** res * np.exp(-1j * (res % 2) * _TURN)


def _beyond(z: np.ndarray, res: int) -> np.ndarray:
    """How far points of a face's plane lie outside each of its three sides."""
    corners = np.array([complex(*_point(i, j)) for i, j in _CORNERS]) * _scale(res)
    along = np.roll(corners, -1) - corners
    return -((z[..., None] - corners) * np.conj(along / np.abs(along))).imag


def _ring(face: int, z: np.ndarray, faces: np.ndarray, own: np.ndarray, sides: np.ndarray, res: int) -> list[tuple[int, complex]]:
    """Corners (face, place on its plane) in order, with one more where an edge of an odd resolution goes from a face to another.

    z: corners on the plane of `face`; faces and own: the face each lies on and its place there; sides: the side it lies beyond, or -1.
    """
    corners = np.array([complex(*_point(i, j)) for i, j in _CORNERS]) * _scale(res)
    out = []
    for i in range(len(z)):
        n = (i + 1) % len(z)
        out.append((int(faces[i]), own[i]))
        if res % 2 and faces[i] != faces[n]:
            side = int(sides[i] if sides[i] >= 0 else sides[n])
            a, b = corners[side], corners[(side + 1) % 3]
            d, e = z[n] - z[i], b - a
            t = ((a - z[i]) * np.conj(e)).imag / (d * np.conj(e)).imag
            if 1e-9 < t < 1 - 1e-9:
                out.append((face, z[i] + t * d))
    return out


def _pentagon(base: int, res: int) -> list[tuple[int, complex]]:
    """The ring of a pentagon, its corners one to a face, in order around it."""
    _, _, _, _, spots = _bases()
    beyond, turn, shift = _across()
    scale = _scale(res)
    around = [(f, _CORNERS.index((i, j))) for f, i, j in spots[base] if (i, j) in _CORNERS]
    angle = np.exp(1j * (np.pi / 6 + np.pi / 3 * np.arange(6))) / np.sqrt(3)
    corner = {}
    for f, k in around:
        z = complex(*_point(*_CORNERS[k])) * scale + angle
        out_by = _beyond(z, res)
        inside = np.flatnonzero(out_by.max(1) < 1e-7)  # one, or at even resolutions the two on its sides
        corner[f] = (k, z[inside[out_by[inside, (k + 2) % 3].argmax()]])
    out: list[tuple[int, complex]] = []
    f = around[0][0]
    for _ in range(5):  # to the face beyond the side that begins at the corner, which follows in order
        k, z = corner[f]
        side = (k + 2) % 3
        g = int(beyond[f, side])
        back = (corner[g][1] - shift[f, side] * scale) / turn[f, side]
        out += _ring(f, np.array([z, back]), np.array([f, g]), np.array([z, 0]), np.array([-1, side]), res)[: 2 if res % 2 else 1]
        f = g
    return out


def boundaries_of(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longitudes and latitudes of the closed rings of cells, one after the other, and the bounds of each.

    A corner lies on the face that holds it, so neighbours share it.  Pentagons have five; at odd resolutions an edge that goes from one
    face to another has a point where it crosses, as it bends there.
    """
    rings: list[list[tuple[int, complex]]] = [[] for _ in range(len(cells))]
    resolution = (cells >> 52) & 15
    beyond, turn, shift = _across()
    angle = np.exp(1j * (np.pi / 6 + np.pi / 3 * np.arange(6))) / np.sqrt(3)
    for r in np.unique(resolution):
        res = int(r)
        rows = np.flatnonzero(resolution == res)
        base = (cells[rows] >> 45) & 127
        whole = _bases()[3][base] & (((cells[rows] & ((1 << 45) - 1)) >> (3 * (15 - res))) == 0)
        for n in rows[whole]:
            rings[n] = _pentagon(int((cells[n] >> 45) & 127), res)
        rows = rows[~whole]
        if not len(rows):
            continue
        face, x, y = _placed(cells[rows], res)
        z = (x + 1j * y)[:, None] + angle
        out = _beyond(z, res)
        side = np.where(out.max(2) > 1e-7, out.argmax(2), -1)
        f = np.repeat(face[:, None], 6, 1)
        faces = np.where(side >= 0, beyond[f, side], f)
        own = np.where(side >= 0, turn[f, side] * z + shift[f, side] * _scale(res), z)
        for n, i in zip(rows, range(len(rows)), strict=True):
            rings[n] = list(zip(faces[i].tolist(), own[i].tolist(), strict=True)) if (side[i] < 0).all() or res % 2 == 0 else _ring(int(face[i]), z[i], faces[i], own[i], side[i], res)
    bounds = np.concatenate([[0], np.cumsum([len(r) + 1 for r in rings])])
    points = [p for r in rings for p in [*r, r[0]]]
    lon, lat = np.zeros(len(points)), np.zeros(len(points))
    f, place = np.array([p[0] for p in points], np.int64), np.array([p[1] for p in points], complex)
    of = np.repeat(resolution, np.diff(bounds))
    for r in np.unique(resolution):
        rows = np.flatnonzero(of == r)
        a, b = _globe(place[rows].real, place[rows].imag, f[rows], int(r))
        lat[rows], lon[rows] = np.degrees(a), np.degrees(b)
    return lon, lat, bounds


def boundary_of(cell: int) -> list[list[float]]:
    """The corners of a cell as a closed ring of longitude and latitude."""
    lon, lat, _ = boundaries_of(np.array([cell]))
    return [[float(a), float(b)] for a, b in zip(lon, lat, strict=True)]


def latlng_to_cell(lat: Column, lon: Column, resolution: int) -> Column:
    """Cell of a point; null where a coordinate is null or not finite."""
    if not 0 <= resolution <= 15:
        raise ValueError(f"no such resolution: {resolution}")

    @F.arrow_udf("long")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        lat, lon = (c.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in (a, b))
        found = cells_of(lat, lon, resolution)
        return pa.array(found, mask=found == 0)

    return run(lat, lon)


def cell_boundary(cell: Column | str) -> Column:
    """The closed ring of a cell's corners, longitude first."""

    @F.arrow_udf("array<array<double>>")
    def run(cells: pa.Array) -> pa.Array:
        known = np.flatnonzero(~cells.is_null().to_numpy(zero_copy_only=False))
        lon, lat, bounds = boundaries_of(cells.take(pa.array(known)).to_numpy(zero_copy_only=False))
        pairs = pa.ListArray.from_arrays(np.arange(0, 2 * len(lon) + 1, 2, dtype=np.int32), pa.array(np.stack([lon, lat], axis=1).ravel()))
        rings = pa.ListArray.from_arrays(bounds.astype(np.int32), pairs)
        place = np.full(len(cells), -1)
        place[known] = np.arange(len(known))
        return rings.take(pa.array(place, mask=place < 0))

    return run(cell)
