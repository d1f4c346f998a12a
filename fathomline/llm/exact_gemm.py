"""Exact integer matrix products by float64 BLAS, and vectors as integer arrays.

BLAS has no fast integer product. Integers are cut into limbs so short that every product of limb matrices,
sums included, stays below 2**53 and so is exact in float64; the parts are put together again in int64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_MOST = 2**62  # bound of a result, so that differences of two results still fit


def limb_bits(width: int) -> int:
    """Bits of a limb: ``width`` products of two limbs sum up to less than 2**53."""
    return (53 - int(width).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 matrices, lowest first, with x = sum(limb[k] * 2**(bits*k)). All but the last lie in [0, 2**bits), the last within +-2**bits."""
    out, rest = [], x
    while rest.size and (int(rest.max()) > 2**bits or int(rest.min()) < -(2**bits)):
        out.append((rest & (2**bits - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices (n, m) and (k, m), exactly. Results that could pass 2**62 are an error."""
    width = a.shape[1]
    if a.size and b.size and width * max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min())) >= _MOST:
        raise OverflowError("inner products may not fit 62 bits")
    bits = limb_bits(width)
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            total += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return total


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are there and finite."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(ok, F.lit(False))


def whole(vectors: pa.Array, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of finite vectors as an int64 matrix; the components are taken as doubles first.

    All vectors must have ``width`` components, and results must stay within 2**53: anything else is an error.
    """
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != width).any():
        raise ValueError(f"vectors must have {width} components, found {sorted(set(lengths.tolist()))[:5]}")
    scaled = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if scaled.size and np.abs(scaled).max() > 2.0**53:
        raise OverflowError("scaled components may not pass 2**53")
    return scaled.astype(np.int64).reshape(len(lengths), width)
