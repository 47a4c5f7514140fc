"""Single-band GeoTIFF rasters as pixels with people: north-up, classic or BigTIFF, strips or tiles; plain, deflated or LZW,
with or without differences between neighbours.

Rasters in a store that executors can open are read by runs of blocks in parallel; those in another come through Spark's own reader, a
file a row.
"""

from __future__ import annotations

import io
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexspark.session import spread

_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 8: 2, 9: 4, 11: 4, 12: 8, 16: 8}
_CODE = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


_PLAIN, _LZW, _DEFLATED = 1, 5, (8, 32946)


def unpacked_lzw(data: bytes) -> bytes:
    """Variable-width codes as TIFF packs them: highest bit first, and one code wider one code early."""
    clear, end = 256, 257
    table = [bytes([i]) for i in range(256)] + [b"", b""]
    out, width, held, bits, last = [], 9, 0, 0, b""
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == end:
            break
        if code == clear:
            del table[258:]
            width, last = 9, b""
            continue
        if code > len(table) or (code == len(table) and not last):
            raise ValueError(f"LZW code {code} beyond the table of {len(table)}")
        text = table[code] if code < len(table) else last + last[:1]
        out.append(text)
        if last:
            table.append(last + text[:1])
        last = text
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1
    return b"".join(out)


class Raster:
    """Header of a TIFF and its blocks."""

    def __init__(self, path: str, source: BinaryIO | None = None) -> None:
        self.path, self.source = path, source
        with self._open() as f:
            f.seek(0)
            head = f.read(16)
            self.order = {b"II": "<", b"MM": ">"}.get(head[:2])
            version = struct.unpack(self.order + "H", head[2:4])[0] if self.order else 0
            if version not in (42, 43):
                raise ValueError(f"{path} is not a TIFF")
            # Both kinds have the same tags; in the big one offsets and numbers have eight bytes.
            word, number = ("Q", "Q") if version == 43 else ("I", "H")
            width = struct.calcsize(word)
            f.seek(struct.unpack(self.order + word, head[8:16] if version == 43 else head[4:8])[0])
            self.tags = {}
            for _ in range(struct.unpack(self.order + number, f.read(struct.calcsize(number)))[0]):
                tag, kind, n, value = struct.unpack(f"{self.order}HH{word}{width}s", f.read(4 + 2 * width))
                size = _SIZE.get(kind, 1) * n
                if size > width:
                    back = f.tell()
                    f.seek(struct.unpack(self.order + word, value)[0])
                    value = f.read(size)
                    f.seek(back)
                self.tags[tag] = value[:size].rstrip(b"\0").decode() if kind == 2 else struct.unpack(self.order + _CODE[kind] * n, value[:size]) if kind in _CODE else value
        one = lambda t, d=None: self.tags[t][0] if t in self.tags else d
        self.width, self.height = one(256), one(257)
        self.packing, self.predictor = one(259, 1), one(317, 1)
        if self.packing not in (_PLAIN, _LZW, *_DEFLATED) or one(277, 1) != 1 or self.predictor not in (1, 2, 3):
            raise ValueError(f"{path}: only plain, LZW or deflated single-band rasters are read")
        kind = {1: "u", 2: "i", 3: "f"}[one(339, 1)]
        self.dtype = np.dtype(f"{self.order}{kind}{one(258, 8) // 8}")
        self.tiled = 322 in self.tags
        self.block = (one(322), one(323)) if self.tiled else (self.width, min(one(278, self.height), self.height))
        self.offsets, self.counts = (self.tags[324], self.tags[325]) if self.tiled else (self.tags[273], self.tags[279])
        self.nodata = float(self.tags[42113]) if self.tags.get(42113) else None
        if 34264 in self.tags:
            m = self.tags[34264]
            if m[1] or m[4]:
                raise ValueError(f"{path} is not a north-up raster")
            self.a, self.c, self.e, self.f = m[0], m[3], m[5], m[7]
        else:
            (sx, sy, *_), (i, j, _, x, y, *_) = self.tags[33550], self.tags[33922]
            self.a, self.e = sx, -sy
            self.c, self.f = x - i * sx, y + j * sy

    def _open(self):
        return open(self.path, "rb") if self.source is None else io.BufferedReader(_Kept(self.source))

    def band(self, data: bytes) -> np.ndarray:
        """The values of a block, row by row."""
        data = unpacked_lzw(data) if self.packing == _LZW else zlib.decompress(data) if self.packing in _DEFLATED else data
        across, size = self.block[0], self.dtype.itemsize
        data = data[: len(data) // (across * size) * across * size]
        if self.predictor == 3:  # differences of bytes, the highest bytes of a row first
            rows = np.cumsum(np.frombuffer(data, np.uint8).reshape(-1, across * size), axis=1, dtype=np.uint8)
            return np.ascontiguousarray(rows.reshape(-1, size, across).transpose(0, 2, 1)).view(f">f{size}")[:, :, 0]
        if self.predictor == 2:  # differences of values, as whole numbers of their width
            whole = np.frombuffer(data, f"{self.order}u{size}").reshape(-1, across)
            return np.cumsum(whole, axis=1, dtype=f"u{size}").view(self.dtype.newbyteorder("="))
        return np.frombuffer(data, self.dtype).reshape(-1, across)

    def pixels(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longitude, latitude and value of a block's pixels with people."""
        across = -(-self.width // self.block[0])
        col, row = number % across * self.block[0], number // across * self.block[1]
        with self._open() as f:
            f.seek(self.offsets[number])
            data = f.read(self.counts[number])
        band = self.band(data)[: self.height - row, : self.width - col]
        ok = np.isfinite(band) & (band > 0)
        if self.nodata is not None:
            ok &= band != self.nodata
        r, c = np.nonzero(ok)
        return self.c + (c + col + 0.5) * self.a, self.f + (r + row + 0.5) * self.e, band[r, c].astype(np.float64)


class _Kept(io.RawIOBase):
    """A source that stays open when its reader closes."""

    def __init__(self, source: BinaryIO) -> None:
        self.source = source

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, at: int, how: int = 0) -> int:
        return self.source.seek(at, how)

    def readinto(self, into) -> int:
        data = self.source.read(len(into))
        into[: len(data)] = data
        return len(data)


#: Blocks of a raster that one row of work stands for.
BLOCKS = 256


def _uri(path: str) -> str:
    """A path as the library that opens it on executors has it."""
    return re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", path))


def seekable(path: str) -> bool:
    """Whether executors can open a path of this kind themselves and read parts of it."""
    try:
        opened_store(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def opened_store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path, and its name there."""
    return pyarrow.fs.FileSystem.from_uri(_uri(path))


def _opened(path: str) -> pa.NativeFile:
    store, name = opened_store(path)
    return store.open_input_file(name)


def remote(folder: str) -> bool:
    """Whether a path is in a store other than the local one."""
    return bool(re.match(r"[a-z][a-z0-9+.-]*:", folder)) and not folder.startswith("file:")


def local(path: str) -> str:
    return re.sub(r"^file:/*", "/", path)


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """path and year of the rasters, named <iso>_pop_<year>_..., under a folder of any store; files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tif").load(folder).select("path")
    name = F.split(F.element_at(F.split("path", "/"), -1), "_")
    year = F.when((F.size(name) > 2) & (F.get(name, F.lit(1)) == "pop"), F.get(F.split(F.get(name, F.lit(2)), r"\."), F.lit(0)).try_cast("int"))
    return files.select("path", year.alias("year")).where("year is not null")


def years_of(spark: SparkSession, folder: str) -> list[int]:
    """Years that have a raster under a folder of any store."""
    return sorted(r[0] for r in listed(spark, folder).select("year").distinct().collect())


_PIXELS = "lon double, lat double, pop double"


def _batch(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["lon", "lat", "pop"])


def read_ranges(rasters: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """lon, lat, pop of all pixels with people of the rasters at column path, by parts.

    One set of tasks reads the headers and cuts the rasters into runs of blocks, another reads each run from where it lies, so a raster
    of any size is read by many tasks, none of which holds more than a block.
    """

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _opened(path) as source:
                    first = np.arange(0, len(Raster(path, source).offsets), blocks)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(first), pa.string()), pa.array(first, pa.int64())], ["path", "first"])

    def pixels(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                with _opened(path) as source:
                    raster = Raster(path, source)
                    for n in range(first, min(first + blocks, len(raster.offsets))):
                        found = raster.pixels(n)
                        if len(found[0]):
                            yield _batch(found)

    parts = spread(rasters.select("path"), "path").mapInArrow(runs, "path string, first long")
    return spread(parts, "path", "first").mapInArrow(pixels, _PIXELS)


def read_stored(files: DataFrame) -> DataFrame:
    """lon, lat, pop of all pixels with people of rasters given as rows (path, content), for stores that only Spark can read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raster = Raster(path, io.BytesIO(content.as_buffer()))
                for n in range(len(raster.offsets)):
                    yield _batch(raster.pixels(n))

    return files.select("path", "content").mapInArrow(run, _PIXELS)


def read_year(spark: SparkSession, folder: str, year: int) -> DataFrame:
    """lon, lat, pop of a year's rasters under a folder of any store."""
    found = listed(spark, folder).where(F.col("year") == year)
    one = found.first()
    if one is None:
        raise FileNotFoundError(f"no rasters of {year} under {folder}")
    if seekable(one["path"]):
        return read_ranges(found)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*_pop_{year}_*.tif").load(folder)
    return read_stored(files)
