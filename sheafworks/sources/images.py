"""Width and height of image files from their header bytes. No pixel is decoded."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of the file formats.
_PNG = b"\x89PNG\r\n\x1a\n"
_GIF = (b"GIF87a", b"GIF89a")
#: Markers of a JPEG frame header: C0 to CF without the tables C4, C8 and CC.
_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
#: Markers without a length: TEM and restarts.
_BARE = frozenset({0x01, *range(0xD0, 0xD8)})


def _png(data: memoryview) -> tuple[int, int] | None:
    return struct.unpack_from(">II", data, 16) if len(data) >= 24 and data[12:16] == b"IHDR" else None


def _jpeg(data: memoryview) -> tuple[int, int] | None:
    """Steps from segment to segment up to the frame header, however much metadata stands before it."""
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF:  # filling
            at += 1
        elif marker in _BARE:
            at += 2
        elif marker in _FRAMES:
            if at + 9 > len(data):
                return None
            height, width = struct.unpack_from(">HH", data, at + 5)
            return width, height
        elif marker in (0xD9, 0xDA):  # the image ends, or its data begins, without a frame header
            return None
        else:
            at += 2 + struct.unpack_from(">H", data, at + 2)[0]
    return None


def image_size(data: bytes | memoryview) -> tuple[int, int] | None:
    """(width, height) of a PNG, JPEG, GIF or BMP file; None for what is none of these or broken."""
    data = memoryview(data).cast("B")
    head = bytes(data[:8])
    found = None
    if head == _PNG:
        found = _png(data)
    elif head[:2] == b"\xff\xd8":
        found = _jpeg(data)
    elif head[:6] in _GIF and len(data) >= 10:
        found = struct.unpack_from("<HH", data, 6)
    elif head[:2] == b"BM" and len(data) >= 26:
        width, height = struct.unpack_from("<ii", data, 18)
        found = width, abs(height)
    return found if found and found[0] > 0 and found[1] > 0 else None


def image_sizes(files: DataFrame) -> DataFrame:
    """(path, content) to (path, width, height); files that are no whole header give no row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, sizes = [], []
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                size = image_size(memoryview(content.as_buffer())) if content.is_valid else None
                if size:
                    paths.append(path.as_py())
                    sizes.append(size)
            columns = [pa.array(paths, pa.string())]
            columns += [pa.array([size[i] for size in sizes], pa.int32()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["path", "width", "height"])

    return files.select("path", "content").mapInArrow(work, "path string, width int, height int")
