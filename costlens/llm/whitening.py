"""Embedding whitening by incremental eigendecomposition.

Each partition keeps the eigendecomposition of the scatter matrix of the vectors
it has read and updates it by centred rank-one terms: the secular equation
gives the new eigenvalues, eigenvectors follow from its roots. Entries that an
update does not touch, and all but one of equal eigenvalues, are deflated first.
The vectors of a batch, centred, are first turned (QR) into as many rows as they
have dimensions with the same scatter matrix, so a batch takes one update per
dimension and one for the distance of its mean, however many vectors it
holds; batches of fewer vectors take one for each. Spectra of partitions are
combined, a few at a time in rounds of Spark groups, by one rank-one update per
eigenpair of the other and one for the distance of the means.

Rounding adds up over many updates, so a last pass over all vectors forms the
covariance in the basis found (a sum of small matrices, one per partition, added up in
the same rounds), and the eigenvectors of that matrix, which is nearly
diagonal, turn the basis into the eigenvectors of the covariance (Rayleigh-Ritz).
One more pass over the whitened vectors measures how far their covariance is from
the identity.

Sizes: the driver and every task hold a few matrices of the vectors'
dimension squared, whatever the number of vectors; nothing else is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import shared_copy

EPS = np.finfo(float).eps
#: States combined by one task of a round, and vectors turned into updates at once.
FAN_IN = 16
BATCH_ROWS = 4096


# --- rank-one updates --------------------------------------------------------


def secular_roots(poles: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(squares / (poles - x))`` as (index of the nearer pole, offset from it).

    ``poles`` rise strictly and ``squares`` are positive: one root lies above each pole,
    below the next, the last one at most ``sum(squares)`` above its pole. All roots are
    iterated together, each by an interpolation with a term for the pole to
    either side, inside a bracket that shrinks and halves where a step leaves it.
    """
    n = len(poles)
    above = np.append(poles[1:], poles[-1] + squares.sum())
    gap = above - poles
    i = np.arange(n)

    def terms(base: np.ndarray, offset: np.ndarray):
        distance = (poles[None, :] - poles[base][:, None]) - offset[:, None]  # pole minus x
        part = squares / distance
        slope = part / distance
        return 1 + part.sum(1), 1 + np.abs(part).sum(1), slope, distance

    half = gap / 2
    value = terms(i, half)[0]
    left = (value >= 0) | (i == n - 1)  # the nearer pole; the last root has only one
    base = np.where(left, i, np.minimum(i + 1, n - 1))
    low, high = np.where(left, 0.0, -half), np.where(left, np.where(value >= 0, half, gap), 0.0)
    low[-1] = 0.0 if value[-1] >= 0 else half[-1]
    offset = (low + high) / 2
    below = np.tri(n, dtype=bool)  # poles at or below the root
    for _ in range(100):
        value, size, slope, distance = terms(base, offset)
        low, high = np.where(value < 0, offset, low), np.where(value >= 0, offset, high)
        done = (np.abs(value) <= 8 * n * EPS * size) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        psi, phi = (slope * below).sum(1), (slope * ~below).sum(1)
        d0 = distance[i, i]
        d1 = np.append(distance[i[:-1], i[1:]], above[-1] - poles[-1] - offset[-1])
        a = (d0 + d1) * value - d0 * d1 * (psi + phi)
        b = d0 * d1 * value
        c = value - d0 * psi - d1 * phi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(all="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = d0[-1] + d0[-1] ** 2 * psi[-1] / (value[-1] - d0[-1] * psi[-1])
            new = offset + step
        fits = (new > low) & (new < high) & np.isfinite(new)
        offset = np.where(done, offset, np.where(fits, new, (low + high) / 2))
    return base, offset


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigendecomposition of ``basis @ diag(values) @ basis.T + weight * outer(vector, vector)``.

    ``values`` rise, ``basis`` is orthogonal, ``weight`` is not negative. Returns the same.
    """
    z = basis.T @ vector
    norm = np.sqrt(z @ z)
    strength = weight * norm * norm
    if not strength > 0:
        return values, basis
    z /= norm
    tiny = 8 * EPS * max(values[-1], strength)
    # Deflation: no part of the update ...
    live = np.flatnonzero(strength * np.abs(z) > tiny)
    basis = basis.copy()
    # ... or eigenvalues as good as equal: a reflection leaves the update to the last of them.
    kept, at = [], 0
    while at < len(live):
        to = at + 1
        while to < len(live) and values[live[to]] - values[live[to - 1]] <= tiny:
            to += 1
        group = live[at:to]
        if len(group) > 1:
            part = z[group]
            mirror = part.copy()
            mirror[-1] += np.copysign(np.sqrt(part @ part), part[-1])
            block = basis[:, group]
            basis[:, group] = block - np.outer(block @ mirror, mirror) * (2 / (mirror @ mirror))
            z[group[-1]] = -np.copysign(np.sqrt(part @ part), part[-1])
            z[group[:-1]] = 0.0
        kept.append(group[-1])
        at = to
    kept = np.array(kept, np.int64)
    if len(kept) == 0:
        return values, basis
    poles, zk = values[kept], z[kept]
    base, offset = secular_roots(poles, strength * zk * zk)
    new = values.copy()
    new[kept] = poles[base] + offset
    # Root minus pole, without cancellation; then the z that has exactly these roots.
    apart = (poles[base] - poles[:, None]) + offset  # (pole, root)
    between = poles[None, :] - poles[:, None]
    n = len(kept)
    lower = np.tri(n, k=-1, dtype=bool)  # roots below the pole pair with their own poles
    np.fill_diagonal(between, 1.0)
    shifted = np.append(between[:, 1:], np.ones((n, 1)), 1)  # roots from the pole on pair with the next poles
    shifted[np.arange(n - 1), np.arange(n - 1)] = poles[1:] - poles[:-1]
    ratio = np.where(lower, apart / between, apart / shifted)
    exact = np.sqrt(np.abs(ratio.prod(1))) * np.sign(zk)
    turn = exact[:, None] / -apart
    turn /= np.sqrt((turn * turn).sum(0))
    basis[:, kept] = basis[:, kept] @ turn
    order = np.argsort(new, kind="stable")
    return new[order], basis[:, order]


def exactly_centred(vectors: np.ndarray, count: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count * x - sums exactly, x - sums / count) of integer vectors."""
    most = count * int(np.abs(vectors).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 1 << 62:
        exact = vectors * count - sums.astype(np.int64)
    else:
        exact = vectors.astype(object) * count - sums
    return exact, (exact / count).astype(float)


@dataclass
class Spectrum:
    """Count, exact sums, and eigendecomposition of the scatter matrix of integer vectors."""

    count: int
    sums: np.ndarray  # integers
    values: np.ndarray
    basis: np.ndarray
    updates: int = 0

    @classmethod
    def empty(cls, dim: int) -> "Spectrum":
        return cls(0, np.zeros(dim, object), np.zeros(dim), np.eye(dim))

    def _apply(self, vector: np.ndarray, weight: float) -> None:
        self.values, self.basis = rank_one(self.values, self.basis, vector, weight)
        self.updates += 1
        if self.updates % 256 == 0:  # rounding tilts the basis a little with every update
            self.basis = np.linalg.qr(self.basis)[0]

    def _distance(self, sums: np.ndarray, count: int) -> np.ndarray:
        """The other mean minus this one, from integers."""
        return ((sums * self.count - self.sums * count) / (self.count * count)).astype(float)

    def add(self, vector: np.ndarray, times: int = 1) -> None:
        """The same vector ``times`` times: one centred rank-one update."""
        sums = vector.astype(object) * times
        if self.count:
            self._apply(self._distance(sums, times), self.count * times / (self.count + times))
        self.count, self.sums = self.count + times, self.sums + sums

    def absorb(self, count: int, sums: np.ndarray, rows: np.ndarray) -> None:
        """``count`` vectors with these sums, whose scatter matrix is that of the centred ``rows``."""
        for row in rows:
            self._apply(row, 1.0)
        if self.count:
            self._apply(self._distance(sums, count), self.count * count / (self.count + count))
        self.count, self.sums = self.count + count, self.sums + sums

    def add_batch(self, vectors: np.ndarray) -> None:
        """Many vectors by one update per dimension, few by one for each."""
        if len(vectors) <= vectors.shape[1] + 1:
            for vector in vectors:
                self.add(vector)
            return
        sums = vectors.sum(0) if int(np.abs(vectors).max()) * len(vectors) < 1 << 62 else vectors.astype(object).sum(0)
        centred = exactly_centred(vectors, len(vectors), sums.astype(object))[1]
        self.absorb(len(vectors), sums.astype(object), np.linalg.qr(centred, mode="r"))

    def merge(self, other: "Spectrum") -> None:
        """Rank-one updates by the other's eigenpairs and by the distance of the means."""
        if self.count and other.count:
            self.absorb(other.count, other.sums, other.basis.T * np.sqrt(np.maximum(other.values, 0.0))[:, None])
        elif other.count:
            self.__dict__.update(other.__dict__)

    def to_row(self) -> dict:
        return {"n": self.count, "sums": [str(s) for s in self.sums], "numbers": np.concatenate([self.values, self.basis.ravel()]).tobytes()}

    @classmethod
    def from_row(cls, row) -> "Spectrum":
        sums = np.array([int(s) for s in row.sums], object)
        numbers = np.frombuffer(row.numbers)
        return cls(int(row.n), sums, numbers[: len(sums)].copy(), numbers[len(sums) :].reshape(len(sums), -1).copy())


# --- vectors ----------------------------------------------------------------


def _vectors(batch: pa.RecordBatch, dim: int, scale: float, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, integer vectors) of a batch's rows that have ``dim`` finite entries."""
    lists = batch.column(batch.num_columns - 1)
    sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dim)
    if not len(rows):
        return rows, np.empty((0, dim), np.int64)
    flat = lists.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)  # null: nan
    finite = np.isfinite(flat).all(1)
    scaled = np.floor(scale * flat[finite])
    if np.abs(scaled).max(initial=0.0) > 2.0**62:
        raise OverflowError("a scaled entry is beyond 2**62")
    return rows[finite], scaled.astype(np.int64) + offset


def _rounds(parts: DataFrame, combine: Callable[[pd.DataFrame], pd.DataFrame], label: str) -> DataFrame:
    """Rows with a ``slot`` number combined ``FAN_IN`` at a time until one is left."""
    parts = shared_copy(parts, label)
    slots = parts.agg(F.max("slot")).first()[0]
    while slots:
        groups = parts.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("long")).groupBy("slot")
        parts, slots = shared_copy(groups.applyInPandas(combine, parts.schema), label), slots // FAN_IN
    return parts


_SPECTRUM = "slot long, n long, sums array<string>, numbers binary"
_MATRIX = "slot long, numbers binary"


@dataclass
class Whitening:
    """Fit of a table: everything the scoring pass needs, bounded by the dimension."""

    dim: int
    count: int
    sums: np.ndarray
    components: np.ndarray  # (dim, dim), columns by falling eigenvalue
    values: np.ndarray
    scale: float
    offset: int

    @property
    def live(self) -> np.ndarray:
        """Components with a variance above what rounding alone makes of none."""
        return self.values > max(self.values.sum(), 0.0) * self.dim * 4 * EPS

    def centred(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return exactly_centred(vectors, self.count, self.sums)

    def whiten(self, centred: np.ndarray, most: int) -> np.ndarray:
        """Projections over the root of the eigenvalue; nan for components without variance."""
        root = np.where(self.live, np.sqrt(np.maximum(self.values, 0.0)), np.nan)
        return (centred @ self.components[:, :most]) / root[:most]


def dimension(vectors: DataFrame, column: str) -> int:
    """The length most vectors without null or non-finite entries have; ties: the longer. 0 without any."""
    entry = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    lengths = vectors.where(F.col(column).isNotNull() & entry).groupBy(F.size(column).alias("size")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return top["size"] if top else 0


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(b) for b in pdf.sort_values("numbers")["numbers"]], axis=0)
    return pd.DataFrame({"slot": [pdf["slot"].iloc[0]], "numbers": [total.tobytes()]})


def _gram(vectors: DataFrame, fit: Whitening, turn: Callable[[np.ndarray], np.ndarray], width: int, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums and Gram matrix, over all vectors, of what ``turn`` makes of their centred forms."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, seen = np.zeros((width, width)), np.zeros(width), False
        for batch in batches:
            rows, x = _vectors(batch, fit.dim, fit.scale, fit.offset)
            if len(rows):
                seen, y = True, turn(fit.centred(x)[1])
                total += y.T @ y
                sums += y.sum(0)
        if seen:
            yield pa.RecordBatch.from_pydict({"numbers": [np.concatenate([sums, total.ravel()]).tobytes()]})

    parts = vectors.select("vector").mapInArrow(partial, "numbers binary").select(F.spark_partition_id().cast("long").alias("slot"), "numbers")
    numbers = np.frombuffer(_rounds(parts, _summed, label).first()["numbers"])
    return numbers[:width], numbers[width:].reshape(width, width)


def fit(vectors: DataFrame, scale: float = 64.0, offset: int = 1_000_000) -> Whitening | None:
    """Fit on a ``vector`` column (array of double); None without usable vectors."""
    dim = dimension(vectors, "vector")
    if not dim:
        return None

    def decompose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Spectrum.empty(dim)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                state.add_batch(_vectors(batch.slice(start, BATCH_ROWS), dim, scale, offset)[1])
        if state.count:
            row = state.to_row()
            yield pa.RecordBatch.from_pydict({"n": [row["n"]], "sums": pa.array([row["sums"]], pa.list_(pa.string())), "numbers": [row["numbers"]]})

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        states = sorted((Spectrum.from_row(row) for row in pdf.itertuples()), key=lambda s: (-s.count, s.values.tobytes()))
        for other in states[1:]:
            states[0].merge(other)
        row = states[0].to_row()
        return pd.DataFrame({"slot": [pdf["slot"].iloc[0]], "n": [row["n"]], "sums": [row["sums"]], "numbers": [row["numbers"]]})

    parts = vectors.select("vector").mapInArrow(decompose, _SPECTRUM.removeprefix("slot long, "))
    parts = parts.select(F.spark_partition_id().cast("long").alias("slot"), "n", "sums", "numbers")
    state = Spectrum.from_row(_rounds(parts, merged, "spectra").first())
    found = Whitening(dim, state.count, state.sums, np.linalg.qr(state.basis)[0], state.values, scale, offset)
    basis = found.components
    _, ritz = _gram(vectors, found, lambda c: c @ basis, dim, "ritz")
    values, turn = np.linalg.eigh(ritz / state.count)
    order = np.argsort(-values, kind="stable")
    found.values, found.components = values[order], np.linalg.qr(basis @ turn[:, order])[0]
    return found


def identity_error(vectors: DataFrame, found: Whitening, most: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity.

    Components without variance are left out; 0 if there is no other.
    """
    live = np.flatnonzero(found.live[:most])
    if not len(live):
        return 0.0
    sums, gram = _gram(vectors, found, lambda c: found.whiten(c, most)[:, live], len(live), "identity")
    mean = sums / found.count
    return float(np.abs(gram / found.count - np.outer(mean, mean) - np.eye(len(live))).max())


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, id_col: str, vector_col: str, most: int = 32, scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """One row per vector and component (up to ``most``): the id, component, n, deviation, whitened, explained, identity_error.

    Entries become the integers ``floor(scale * entry) + offset``. Vectors that are
    null or empty, hold null or non-finite entries, or have another length than
    most vectors, are left out. Repeated ids and rows are vectors of their own. A component
    without variance has null ``whitened`` and explains 0 (all of them if all vectors are equal).
    ``deviation`` is exact; beyond a long, or where an entry is, the query fails. Without
    usable vectors there are no rows.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    id_type = dict(rows.dtypes)["id"]
    schema = f"id {id_type}, {SCHEMA}"
    found = fit(rows, scale, offset)
    if found is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    most = min(most, found.dim)
    error, total = identity_error(rows, found, most), float(found.values.sum())
    explained = np.where(found.live, found.values / total if total > 0 else 0.0, 0.0)[:most]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                at, x = _vectors(batch, found.dim, found.scale, found.offset)
                exact, centred = found.centred(x)
                if exact.dtype == object or (len(exact) and int(np.abs(exact).max()) ** 2 * found.dim >= 1 << 63):
                    exact = exact.astype(object)
                deviation = [int(d) for d in (exact * exact).sum(1)]
                values = found.whiten(centred, most).ravel()
                n = len(at) * most
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(at, most))), pa.array(np.tile(np.arange(1, most + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(n, found.count, np.int64)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), most))),
                        pa.array(values, mask=np.isnan(values)), pa.array(np.tile(explained, len(at))), pa.array(np.full(n, error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(score, schema).withColumnRenamed("id", id_col)
