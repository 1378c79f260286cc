"""Hash families: shingle numbers, MinHash values, band keys, sign bits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Prime below 2^31: products of two residues stay inside a signed 64-bit integer.
PRIME = 2147483647
SHINGLE_BASE = 1000003
_CHUNK = 512  # 100 functions x 512 numbers stay in the processor's cache
_PRIME, _BITS = np.uint64(PRIME), np.uint64(31)


@dataclass(frozen=True)
class MinHashFamily:
    """Seeded coefficients of ``(a * x + b) mod PRIME`` with ``a >= 1``."""

    size: int = 100
    seed: int = 7

    @property
    def coefficients(self) -> list[tuple[int, int]]:
        draw = np.random.RandomState(self.seed)
        a = draw.randint(1, PRIME, size=self.size, dtype=np.int64)
        b = draw.randint(0, PRIME, size=self.size, dtype=np.int64)
        return [(int(x), int(y)) for x, y in zip(a, b)]


def _residues(values: np.ndarray, spare: np.ndarray) -> None:
    """``values mod PRIME`` in place, for unsigned values of at most ``PRIME * (PRIME - 1)``.

    As PRIME is 2^31 - 1, the part above the low 31 bits counts like one below them: a shift
    and a sum are several times faster than a division.
    """
    np.right_shift(values, _BITS, out=spare)
    np.bitwise_and(values, _PRIME, out=values)
    np.add(values, spare, out=values)
    # below twice PRIME now, and a difference below zero wraps to a large number
    np.subtract(values, _PRIME, out=spare)
    np.minimum(values, spare, out=values)


def shingle_numbers(text: str, k: int) -> np.ndarray:
    """Distinct numbers of the ``k``-character runs of a text (polynomial hash mod PRIME)."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    count = len(points) - k + 1
    if count < 1:
        return np.empty(0, dtype=np.int64)
    number, spare = np.zeros(count, dtype=np.uint64), np.empty(count, dtype=np.uint64)
    for at in range(k):
        number *= np.uint64(SHINGLE_BASE)
        number += points[at : at + count]
        _residues(number, spare)
    return np.unique(number.astype(np.int64))


def min_hashes(numbers: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest value of every hash function over the given numbers."""
    inside = not len(numbers) or (numbers.min() >= 0 and numbers.max() < PRIME)
    kind = np.uint64 if inside else np.int64
    least = np.full(len(a), PRIME, dtype=kind)
    a, b = a.astype(kind)[:, None], b.astype(kind)[:, None]
    # the buffers serve all parts: fresh ones of this size would be mapped in again each time
    buffer = np.empty((len(a), min(len(numbers), _CHUNK)), dtype=kind)
    spare = np.empty_like(buffer)
    for start in range(0, len(numbers), _CHUNK):
        part = numbers[start : start + _CHUNK].astype(kind)
        values = buffer[:, : len(part)]
        np.multiply(a, part, out=values)
        values += b
        if inside:
            _residues(values, spare[:, : len(part)])
        else:
            np.remainder(values, PRIME, out=values)
        np.minimum(least, values.min(axis=1), out=least)
    return least.astype(np.int64)


def signature_of_text(text: Column, family: MinHashFamily, k: int = 5) -> Column:
    """MinHash signature of a text's shingles; null for texts shorter than ``k``.

    Needs no shuffle and no vocabulary: a shingle's number is a hash of its
    characters, so every row is signed where it is read.
    """
    a, b = (np.array(c, dtype=np.int64) for c in zip(*family.coefficients))

    @F.pandas_udf("array<bigint>")
    def sign(texts: pd.Series) -> pd.Series:
        found = (None if t is None else shingle_numbers(t, k) for t in texts)
        return pd.Series(
            [None if n is None or not len(n) else min_hashes(n, a, b) for n in found],
            dtype="object",
        )

    # nondeterministic: the planner may not work it out again for a filter on the result
    return sign.asNondeterministic()(text)


def signature_of_numbers(numbers: Column, family: MinHashFamily) -> Column:
    """MinHash signature of a set of row numbers; null for an empty set."""
    a, b = (np.array(c, dtype=np.int64) for c in zip(*family.coefficients))

    @F.pandas_udf("array<bigint>")
    def sign(sets: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if s is None or not len(s) else min_hashes(np.asarray(s, np.int64), a, b)
                for s in sets
            ],
            dtype="object",
        )

    return sign.asNondeterministic()(numbers)


def agreement(a: str, b: str) -> Column:
    """Share of equal positions of two signatures."""
    equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)
    return F.size(equal) / F.size(a)


def low_bytes(signature: str) -> Column:
    """The lowest byte of every value of a signature, as one binary."""

    @F.pandas_udf("binary")
    def low(signatures: pd.Series) -> pd.Series:
        return signatures.map(lambda s: np.asarray(s, np.int64).astype(np.uint8).tobytes(), na_action="ignore")

    return low(F.col(signature))


def equal_bytes(a: str, b: str) -> Column:
    """Share of equal positions of two binaries of one length: of ``low_bytes``, at least the ``agreement`` of the signatures."""

    @F.pandas_udf("double")
    def share(left: pd.Series, right: pd.Series) -> pd.Series:
        if not len(left):
            return pd.Series([], dtype="float64")
        x, y = (np.frombuffer(b"".join(side), np.uint8).reshape(len(side), -1) for side in (left, right))
        return pd.Series((x == y).sum(axis=1) / x.shape[1])

    return share(F.col(a), F.col(b))


def low_bits(signature: str) -> Column:
    """The lowest bit of every value of a signature, 64 to a number."""

    @F.pandas_udf("array<bigint>")
    def low(signatures: pd.Series) -> pd.Series:
        if not len(signatures):
            return pd.Series([], dtype="object")
        rows = np.stack([np.asarray(s, np.int64) for s in signatures])
        bits = np.packbits((rows & 1).astype(np.uint8), axis=1)
        words = np.zeros((len(rows), -(-bits.shape[1] // 8) * 8), dtype=np.uint8)
        words[:, : bits.shape[1]] = bits
        return pd.Series(list(words.view(np.int64)))

    return low(F.col(signature))


def band_keys(signature: str, rows: int, bands: int) -> Column:
    """SHA-1 of every band: ``bands`` slices of ``rows`` signature values."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda j: F.sha1(
            F.array_join(
                F.transform(F.slice(signature, j * rows + 1, rows), lambda v: v.cast("string")),
                ",",
            )
        ),
    )


@dataclass(frozen=True)
class SignPlanes:
    """Seeded random hyperplanes: ``tables`` independent sets of ``planes``."""

    planes: int = 10
    tables: int = 1
    dim: int = 64
    seed: int = 7

    @property
    def normals(self) -> np.ndarray:
        """Array of shape (tables, planes, dim); six digits, so SQL can state them."""
        draw = np.random.RandomState(self.seed)
        return np.round(draw.randn(self.tables, self.planes, self.dim), 6)


def sign_buckets(vector: str, planes: SignPlanes) -> Column:
    """One bucket number per table: the bits of ``vector . normal > 0``, first plane highest."""
    normals = planes.normals.reshape(-1, planes.dim)
    weights = 1 << np.arange(planes.planes - 1, -1, -1, dtype=np.int64)
    shape = (-1, planes.tables, planes.planes)

    @F.pandas_udf("array<bigint>")
    def bucket(vectors: pd.Series) -> pd.Series:
        rows = np.array(vectors.tolist(), dtype=np.float64).reshape(-1, planes.dim)
        bits = ((rows @ normals.T) > 0).reshape(shape)
        return pd.Series(list((bits * weights).sum(axis=2)))

    return bucket(F.col(vector))


def probed_buckets(vector: str, planes: SignPlanes, weak: int) -> Column:
    """Per table the ``2 ** weak`` buckets with any signs on the planes the vector is nearest to.

    A near vector most likely lies on the other side of the planes with the smallest projections
    (the first plane of equal ones), so these buckets are asked first; the vector's own comes first of all.
    """
    normals = planes.normals.reshape(-1, planes.dim)
    weights = 1 << np.arange(planes.planes - 1, -1, -1, dtype=np.int64)
    weak = min(weak, planes.planes)
    flips = (np.arange(1 << weak)[:, None] >> np.arange(weak)) & 1

    @F.pandas_udf("array<array<bigint>>")
    def probe(vectors: pd.Series) -> pd.Series:
        rows = np.array(vectors.tolist(), dtype=np.float64).reshape(-1, planes.dim)
        along = (rows @ normals.T).reshape(-1, planes.tables, planes.planes)
        own = ((along > 0) * weights).sum(axis=2)
        nearest = np.argsort(np.abs(along), axis=2, kind="stable")[:, :, :weak]
        buckets = own[:, :, None] ^ (weights[nearest] @ flips.T)
        return pd.Series([list(tables) for tables in buckets])

    return probe(F.col(vector))
