"""ENVI rasters: a Python data source that reads header and binary pairs, and a writer.

``spark.read.format("envi").option("path", p).load()`` gives (row, col,
spectrum); each partition is a range of lines, and only its bytes are read.  The
path must be one that the driver and all executors see.

A raster has every pixel of its extent.  Written with ``mask``, a further, last
band tells the pixels of the table (1) from those that only fill the raster (0);
read with the option ``mask``, the latter and that band are left out.
"""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: ENVI type codes (fixed values).
TYPES = {1: "u1", 2: "i2", 3: "i4", 4: "f4", 5: "f8", 6: "c8", 9: "c16", 12: "u2", 13: "u4", 14: "i8", 15: "u8"}


def parse_header(text: str) -> dict[str, str]:
    body = re.sub(r"^\s*ENVI\s*", "", text)
    return {k.strip().lower(): v.strip() for k, v in re.findall(r"([^=\n]+?)\s*=\s*(\{[^}]*\}|[^\n]*)", body)}


def header_of(path: str) -> Path:
    """``x.hdr`` beside ``x.img``, or ``x.img.hdr``."""
    p = Path(path)
    for c in (p.with_suffix(".hdr"), Path(f"{path}.hdr")):
        if c.exists():
            return c
    raise FileNotFoundError(f"no ENVI header beside {path}")


class Lines(InputPartition):
    def __init__(self, start: int, stop: int):
        self.start, self.stop = start, stop


class EnviReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.lines_each = int(options.get("lines", 256))
        self.mask = str(options.get("mask", "false")).lower() == "true"
        h = parse_header(header_of(self.path).read_text())
        self.n_rows, self.n_cols, self.n_bands = int(h["lines"]), int(h["samples"]), int(h["bands"])
        self.kind = np.dtype(TYPES[int(h["data type"])]).newbyteorder(">" if int(h.get("byte order", 0)) else "<")
        self.order, self.skip = h.get("interleave", "bsq").lower(), int(h.get("header offset", 0))
        if self.kind.kind == "c":
            raise ValueError("complex rasters are not supported")

    def partitions(self):
        return [Lines(i, min(i + self.lines_each, self.n_rows)) for i in range(0, self.n_rows, self.lines_each)]

    def read(self, partition):
        shape = {"bip": (self.n_rows, self.n_cols, self.n_bands), "bil": (self.n_rows, self.n_bands, self.n_cols), "bsq": (self.n_bands, self.n_rows, self.n_cols)}[self.order]
        data = np.memmap(self.path, self.kind, "r", self.skip, shape)
        own = slice(partition.start, partition.stop)
        part = {"bip": lambda: data[own], "bil": lambda: data[own].transpose(0, 2, 1), "bsq": lambda: data[:, own].transpose(1, 2, 0)}[self.order]()
        for i, line in enumerate(np.asarray(part, float), partition.start):
            for j, spectrum in enumerate(line):
                if not self.mask:
                    yield i, j, spectrum.tolist()
                elif spectrum[-1]:
                    yield i, j, spectrum[:-1].tolist()


class EnviSource(DataSource):
    @classmethod
    def name(cls):
        return "envi"

    def schema(self):
        return "row int, col int, spectrum array<double>"

    def reader(self, schema):
        return EnviReader(self.options)


def write_envi(pixels, path: str, *, height: int, width: int, wavelengths=None, interleave: str = "bil", mask: bool = False) -> None:
    """One raster to ``path`` and its header, line by line through the driver: an export of one scene's size.

    ``interleave`` is ``bip``, ``bil`` or ``bsq``; bands of a ``bsq`` file are far apart, so its lines are placed by seeking.
    """
    if interleave not in ("bip", "bil", "bsq"):
        raise ValueError(f"unknown interleave {interleave}")

    def put(f, line, at):
        if interleave == "bsq":
            for b, values in enumerate(line.T):
                f.seek((b * height + at) * width * 4)
                f.write(np.ascontiguousarray(values).tobytes())
        else:
            f.write(np.ascontiguousarray(line.T if interleave == "bil" else line).tobytes())

    def blank():
        line = np.full((width, bands + mask), -9999.0, "<f4")
        if mask:
            line[:, bands] = 0
        return line

    rows = pixels.select("row", "col", "spectrum").orderBy("row", "col").toLocalIterator()
    first, bands = None, 0
    with open(path, "wb") as f:
        line: list | None = None
        at = 0
        for r in rows:
            if first is None:
                first, bands = r, len(r.spectrum)
                line = blank()
            while r.row > at:
                put(f, line, at)
                line, at = blank(), at + 1
            line[r.col, :bands] = r.spectrum
            line[r.col, bands:] = 1
        while line is not None and at < height:
            put(f, line, at)
            line, at = blank(), at + 1
    more = "" if wavelengths is None else "wavelength = {" + ", ".join(f"{w:g}" for w in wavelengths) + "}\n"
    Path(path).with_suffix(".hdr").write_text(f"ENVI\nsamples = {width}\nlines = {height}\nbands = {bands + mask}\nheader offset = 0\ndata type = 4\ninterleave = {interleave}\nbyte order = 0\n{more}")
