"""Vectors as whole numbers, and their bits plane by plane."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Larger components are an error: squares and sums of them would leave 64 bits.
LARGEST = 1 << 26


def all_finite(vector: Column) -> Column:
    """True if a vector is there and holds no null, NaN or infinite component."""
    v = vector.cast("array<double>")
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double; beyond LARGEST an error."""
    def floor(x: Column) -> Column:
        scaled = x * F.lit(float(scale))
        return F.when(F.abs(scaled) <= LARGEST, F.floor(scaled)).otherwise(
            F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}")).cast("bigint"))

    return F.transform(vector.cast("array<double>"), floor)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def planes_of(largest: int) -> int:
    """Bits of a two's complement number no larger in size than ``largest``."""
    return int(largest).bit_length() + 1


def pack_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, bytes): bit p of all components of a row side by side, component 0 in the lowest bit."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=-1, bitorder="little")


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane counts; the highest one is the sign."""
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def fixed_binary(column: pa.Array, width: int) -> np.ndarray:
    """Binary values of one width as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)
