"""Geographic cell ids of a coordinate (published S2 cell scheme)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .text import _col

LEAF_LEVEL = 30

# Hilbert curve of the S2 scheme, position of a quadrant for each
# of four orientations, and the orientation change of each position.
QUADRANT_POSITION = np.array([[0, 1, 3, 2], [0, 3, 1, 2], [2, 3, 1, 0], [2, 1, 3, 0]])
POSITION_TURN = np.array([1, 0, 0, 3])


def _face_uv(x: np.ndarray, y: np.ndarray, z: np.ndarray):
    """Cube face hit by a direction and the coordinates on it."""
    axis = np.argmax(np.abs(np.stack([x, y, z])), axis=0)
    main = np.choose(axis, [x, y, z])
    face = axis + np.where(main < 0, 3, 0)
    u = np.choose(face, [y, -x, -x, z, z, -y]) / np.choose(face, [x, y, z, x, y, z])
    v = np.choose(face, [z, z, -y, y, -x, -x]) / np.choose(face, [x, y, z, x, y, z])
    return face, u, v


def _grid(u: np.ndarray) -> np.ndarray:
    """Quadratic projection, then one of 2^30 steps along the face."""
    root = np.sqrt(1 + 3 * np.abs(u))
    s = np.where(u >= 0, 0.5 * root, 1 - 0.5 * root)
    return np.clip(np.floor(s * (1 << LEAF_LEVEL)), 0, (1 << LEAF_LEVEL) - 1).astype(np.int64)


@F.arrow_udf(LongType())
def _leaf_cell(lat: pa.Array, lng: pa.Array) -> pa.Array:
    degrees_lat = lat.to_numpy(zero_copy_only=False)
    degrees_lng = lng.to_numpy(zero_copy_only=False)
    missing = np.isnan(degrees_lat) | np.isnan(degrees_lng)
    phi = np.radians(np.where(missing, 0.0, degrees_lat))
    theta = np.radians(np.where(missing, 0.0, degrees_lng))
    face, u, v = _face_uv(np.cos(theta) * np.cos(phi), np.sin(theta) * np.cos(phi), np.sin(phi))
    i, j = _grid(u), _grid(v)
    turn = face & 1
    cell = face.astype(np.uint64)
    for bit in range(LEAF_LEVEL - 1, -1, -1):
        position = QUADRANT_POSITION[turn, ((i >> bit) & 1) * 2 + ((j >> bit) & 1)]
        cell = (cell << np.uint64(2)) | position.astype(np.uint64)
        turn = turn ^ POSITION_TURN[position]
    cell = (cell << np.uint64(1)) | np.uint64(1)
    return pa.array(cell.view(np.int64), type=pa.int64(), mask=missing)


def leaf_cell(lat: Column | str, lng: Column | str) -> Column:
    return _leaf_cell(_col(lat).cast("double"), _col(lng).cast("double"))


def parent_cell(cell: Column | str, level: int) -> Column:
    bit = 1 << (2 * (LEAF_LEVEL - level))
    return _col(cell).bitwiseAND(F.lit(-bit).cast("bigint")).bitwiseOR(F.lit(bit).cast("bigint"))


def geo_cells(lat: Column | str, lng: Column | str, lo: int = 10, hi: int = 18) -> Column:
    """Ids of the cells of levels lo..hi that hold the coordinate."""
    leaf = leaf_cell(lat, lng)
    return F.array(*[parent_cell(leaf, level) for level in range(lo, hi + 1)])


def geo_source_id(lat: Column | str, lng: Column | str) -> Column:
    """The cell ids joined by commas, used as the source id of a located edge."""
    return F.array_join(geo_cells(lat, lng).cast("array<string>"), ",")
