"""Most similar vectors for every vector, exactly: no pair is left out.

Unit vectors have a head, their part in the space in which a sample spreads most, and a tail, what the head leaves.
The cosine of two vectors is at most the product of their heads and that of the lengths of their tails. A vector is stored
in one cell, which bounds the heads and tails in it, and visits each cell of which the bound doesn't rule out that a vector
in it reaches the floor; of two cells only one visits the other, since a pair is compared once and counts both ways.
A vector beyond the bounds of its cell lies in a cell of its own kind and visits all cells that can't be ruled out.
Within a cell the same bound, with more of the numbers in the head, tells which pairs are compared in full. Centres and
bounds come from a sample, so they decide on the work alone, never on the result. Where no cell can be ruled out the work
grows with the square of the collection. Without a floor all queries meet all vectors.

Vectors travel as 24-bit numbers with a scale of their own, which changes a cosine by less than 1e-7.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.runtime import cut, is_small, join_small

#: Vectors on which the centres of one version are fitted, at most.
FIT_ROWS = 16_384
CELL_ROWS, COARSE, FINE, PROBES = 150, 2048, 2048, 2
#: Cells are compared in blocks of about so many stored vectors and so many visitors.
BLOCK_STORED, BLOCK_QUERIES = 16_384, 24_576
#: Cells of a version and numbers of a head, at most; rows of a block that are compared at once.
CELLS, HEAD, CHUNK = 64, 64, 512
#: Shares of a cell's sample that its bounds may hold, and what comparing all vectors costs as much as: copies of each.
WITHIN, COMPARED = (1.0, 0.99, 0.97, 0.9), 10
#: Cosines are told by 32-bit products up to so much; bounds are wider by it, and what passes is computed with 64 bits.
SLACK = 1e-5
PROJECTIONS = 64


def _spherical_means(rows: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    rnd = np.random.default_rng(11)
    centres = rows[rnd.choice(len(rows), cells, replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(rows[a : a + 4096] @ centres.T).argmax(1) for a in range(0, len(rows), 4096)])
        order = np.argsort(nearest, kind="stable")
        used, starts = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(rows[order], starts, axis=0)
        centres[used] = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions of usable vectors, those vectors with length one). Unusable: null, wrong length, all zero, not finite."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.array(pa.compute.fill_null(pa.compute.list_value_length(column), -1))
    right = np.flatnonzero(lengths == dimension)
    if not len(right):
        return right, np.empty((0, dimension), np.float32)
    values = column.take(pa.array(right)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    norms = np.linalg.norm(values, axis=1)
    usable = np.isfinite(norms) & (norms > 0)
    return right[usable], (values[usable] / norms[usable, None]).astype(np.float32)


def _directions(vectors: DataFrame, dimension: int) -> DataFrame:
    """(version, id, at, direction): usable vectors by a hash that copies up to their length share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, units = _matrix(batch.column("v"), dimension)
            index = pa.array(keep)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(index) for c in ("version", "id", "at")), pa.array(_marks(units), pa.int64())], names=["version", "id", "at", "direction"])

    return vectors.mapInArrow(run, "version string, id long, at timestamp, direction long")


def _units(vectors: DataFrame, dimension: int) -> DataFrame:
    """(version, id, direction, unit): usable vectors of length one, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, units = _matrix(batch.column("v"), dimension)
            index = pa.array(keep)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(index) for c in ("version", "id")), pa.array(_marks(units), pa.int64()), pa.array(_pack(units), pa.binary())], names=["version", "id", "direction", "unit"])

    return vectors.mapInArrow(run, "version string, id long, direction long, unit binary")


def _marks(units: np.ndarray) -> list[int]:
    return [xxhash.xxh64_intdigest(r.tobytes()) >> 1 for r in np.round(units * 1e7).astype(np.int32)]


def _pack(units: np.ndarray) -> list[bytes]:
    """Vectors as 16-bit numbers and 8 bits of what these leave; their scale is that of length one, so it isn't kept."""
    scaled = units / np.maximum(np.abs(units).max(axis=1, keepdims=True), 1e-12) * np.float64(32767)
    high = np.round(scaled)
    low = np.round((scaled - high) * 254).astype(np.int8)
    return [h.tobytes() + x.tobytes() for h, x in zip(high.astype(np.int16), low, strict=True)]


def _unpack(packed: list[bytes], dimension: int) -> np.ndarray:
    out = np.empty((len(packed), dimension), np.float32)
    for at in range(0, len(packed), 4096):
        raw = np.frombuffer(b"".join(packed[at : at + 4096]), np.uint8).reshape(-1, 3 * dimension)
        values = np.ascontiguousarray(raw[:, : 2 * dimension]).view(np.int16) + raw[:, 2 * dimension :].view(np.int8) / 254
        out[at : at + 4096] = values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-12)
    return out


class _Cells:
    """Coarse and residual centres of every version, and the projections."""

    def __init__(self, centres: dict[str, tuple[np.ndarray, np.ndarray]], dimension: int) -> None:
        self.centres = centres
        self.axes = np.random.default_rng(5).standard_normal((dimension, PROJECTIONS)).astype(np.float32)

    def nearest(self, version: str, units: np.ndarray, probes: int) -> np.ndarray:
        """(vectors, probes) numbers of the nearest cells, the nearest first; one more where there are two levels."""
        coarse, fine = self.centres[version]
        scores = units @ coarse.T
        if len(fine) == 1:
            return _top(scores, probes)[0]
        probes += 1  # cells of two levels have more edges: one more of them keeps the recall
        near, found = _top(scores, probes)
        cells, values = [], []
        for j in range(near.shape[1]):
            # of the cells of a coarse centre those whose residual centre is nearest to what is left of the vector
            rest = units - found[:, j : j + 1] * coarse[near[:, j]]
            inner, gain = _top(rest @ fine.T, probes)
            cells.append(near[:, j : j + 1].astype(np.int64) * len(fine) + inner)
            values.append(found[:, j : j + 1] ** 2 + gain)
        best, _ = _top(np.hstack(values), probes)
        return np.take_along_axis(np.hstack(cells), best, 1)


def _top(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the n greatest of every row, the greatest first."""
    n = min(n, scores.shape[1])
    near = np.argpartition(-scores, n - 1, axis=1)[:, :n]
    values = np.take_along_axis(scores, near, 1)
    order = np.argsort(-values, axis=1, kind="stable")
    return np.take_along_axis(near, order, 1), np.take_along_axis(values, order, 1)


def _fit(units: DataFrame, counts: dict[str, int], dimension: int) -> _Cells:
    """Centres by version; one task fits one version, on at most FIT_ROWS of its vectors, chosen by a hash of the id."""
    share = F.lit(0.0)
    for version, n in counts.items():
        share = F.when(F.col("version") == version, min(1.0, FIT_ROWS / max(n, 1))).otherwise(share)
    picked = units.filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)) < share * 1_000_000).select("version", "unit")

    def one(group: pd.DataFrame) -> pd.DataFrame:
        rows = _unpack(group["unit"].tolist(), dimension)
        version = group["version"].iloc[0]
        wanted = max(1, counts[version] // CELL_ROWS)
        cells = min(wanted, COARSE, max(1, len(rows) // 4))
        coarse = _spherical_means(rows, cells)
        fine = np.zeros((1, dimension), np.float32)
        if wanted > COARSE:
            near, found = _top(rows @ coarse.T, 1)
            fine = _spherical_means(rows - found * coarse[near[:, 0]], min(math.ceil(wanted / COARSE), FINE, max(1, len(rows) // 4)))
        return pd.DataFrame({"version": version, "level": [0] * len(coarse) + [1] * len(fine), "centre": [c.astype(np.float32).tobytes() for c in (*coarse, *fine)]})

    found = picked.groupBy("version").applyInPandas(one, "version string, level int, centre binary").toPandas()  # at most COARSE + FINE a version
    level = lambda g, n: np.stack([np.frombuffer(c, np.float32) for c in g["centre"][g["level"] == n]])
    centres = {v: (level(g, 0), level(g, 1)) for v, g in found.groupby("version")}
    for version in counts:  # a tiny version may have no sampled row
        centres.setdefault(version, (np.ones((1, dimension), np.float32), np.zeros((1, dimension), np.float32)))
    return _Cells(centres, dimension)


class Arrays:
    """The sorted array of every projection of some stored vectors, sorted once for all queries and radii."""

    def __init__(self, stored: np.ndarray) -> None:
        order = np.argsort(stored, axis=0, kind="stable")
        self.ordered = np.ascontiguousarray(np.take_along_axis(stored, order, 0).T)
        self.ranks = np.empty(stored.T.shape, np.uint16)
        np.put_along_axis(self.ranks, order.T, np.arange(len(stored), dtype=np.uint16)[None, :], 1)

    def collisions(self, queries: np.ndarray, half_width: float) -> np.ndarray:
        """(queries, stored) numbers of windows of the given half width that hold a vector; queries are projections."""
        counts = np.zeros((len(queries), self.ranks.shape[1]), np.uint8)
        hit, offset = np.empty_like(counts, dtype=bool), np.empty_like(counts, dtype=np.uint16)
        for i, (ordered, rank) in enumerate(zip(self.ordered, self.ranks, strict=True)):
            low = np.searchsorted(ordered, queries[:, i] - half_width, "left").astype(np.uint16)
            size = np.searchsorted(ordered, queries[:, i] + half_width, "right").astype(np.uint16) - low
            np.subtract(rank[None, :], low[:, None], out=offset)  # wraps where the rank is below the window
            np.less(offset, size[:, None], out=hit)
            np.add(counts, hit.view(np.uint8), out=counts)
        return counts


class _Space:
    """Of one version: basis of the heads, and of each cell the middle of its heads, how far they lie from it at most,
    the longest tail, and the numbers of its blocks. The last cell is that of the vectors beyond these bounds."""

    def __init__(self, sample: np.ndarray, n: int, floor: float | None, every: int) -> None:
        self.floor = floor
        most = 1 if floor is None else max(1, min(n // CELL_ROWS, CELLS, len(sample) // 4))
        self._bound(sample, most)
        cells = len(self.middles)
        home, h, tail = self._places(sample)
        scale = n / max(len(sample), 1)
        stored = np.bincount(home, minlength=cells + 1) * scale
        visitors = np.append(self.visited(home, h, tail).sum(0), 0) * scale if floor is not None else np.array([n / every, 0])
        self.blocks = np.maximum(1, np.ceil(stored / BLOCK_STORED)).astype(np.int64)
        within = stored * (self.blocks - 1) / self.blocks / 2 if floor is not None else 0
        self.shares = np.maximum(1, np.ceil((visitors + within) / BLOCK_QUERIES)).astype(np.int64)

    def _bound(self, sample: np.ndarray, most: int) -> None:
        """Sets the cells and bounds that cost the least, by the copies and comparisons of the sample."""
        dimension = sample.shape[1]
        self.basis, self.middles = np.zeros((dimension, 1), np.float32), np.zeros((1, 1), np.float32)
        self.reach, self.tails = np.array([2.0]), np.array([2.0])
        if most == 1:
            return
        values, vectors = np.linalg.eigh((sample.T @ sample).astype(np.float64))
        values, vectors = np.maximum(values[::-1], 1e-9), vectors[:, ::-1]
        head = 1 + int(np.argmax(values[1 : min(HEAD, dimension - 1)] / values[2 : min(HEAD, dimension - 1) + 1])) + 1 if dimension > 3 else dimension
        best, least = (self.basis, self.middles, self.reach, self.tails), 1.0 + COMPARED
        basis = np.ascontiguousarray(vectors[:, :head]).astype(np.float32)
        for cells in sorted({min(most, head), min(most, 2 * head), most} - {1}):
            self.basis = basis
            h, tail = self._heads(sample)
            self.middles = _means(h, cells)
            home = self._nearest(h)
            apart = np.linalg.norm(h - self.middles[home], axis=1)
            share = np.bincount(home, minlength=cells) / len(home)
            for within in WITHIN:
                bound = lambda x: np.array([np.quantile(x[home == c], within) if share[c] else 0.0 for c in range(cells)])  # noqa: B023, E731
                self.reach, self.tails = bound(apart), bound(tail)
                visits = self._visits(h, tail)
                beyond = (apart > self.reach[home]) | (tail > self.tails[home])
                cost = 1 + np.where(beyond, visits.sum(1), visits.sum(1) / 2).mean() + COMPARED * ((visits @ share).mean() + beyond.mean() ** 2)
                if cost < least:
                    best, least = (self.basis, self.middles, self.reach, self.tails), cost
        self.basis, self.middles, self.reach, self.tails = best

    def _heads(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = units @ self.basis
        return h, np.linalg.norm(units - h @ self.basis.T, axis=1)

    def _nearest(self, h: np.ndarray) -> np.ndarray:
        return (2 * h @ self.middles.T - (self.middles**2).sum(1)).argmax(1)

    def _places(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home cells, heads, lengths of tails)."""
        h, tail = self._heads(units)
        home = self._nearest(h)
        beyond = (np.linalg.norm(h - self.middles[home], axis=1) > self.reach[home]) | (tail > self.tails[home])
        return np.where(beyond, len(self.middles), home), h, tail

    def _visits(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """(vectors, cells): whether a cell may hold a vector that reaches the floor."""
        if self.floor is None:
            return np.ones((len(h), len(self.middles)), bool)
        return h @ self.middles.T + np.linalg.norm(h, axis=1, keepdims=True) * self.reach + tail[:, None] * self.tails >= self.floor - 10 * SLACK

    def visited(self, home: np.ndarray, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """`_visits` without the home cells and with one direction for every pair of cells."""
        cells = np.arange(len(self.middles))
        return self._visits(h, tail) & (home[:, None] != cells) & (_goes(home[:, None], cells) | (home[:, None] == len(cells)))

    def place(self, ids: np.ndarray, units: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, ...]:
        """(rows, cells, blocks, shares, whether stored): where each vector is stored and which blocks it visits."""
        home, h, tail = self._places(units)
        at = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at ^= at >> np.uint64(29)
        block, share = (at >> np.uint64(8)) % self.blocks.astype(np.uint64)[home], at >> np.uint64(40)
        block = block.astype(np.int64)
        visited = np.zeros((len(ids), 0), bool) if self.floor is None else self.visited(home, h, tail)
        out: list[tuple[np.ndarray, int, int, np.ndarray, bool]] = []
        for c in range(len(self.blocks)):
            mine = np.flatnonzero(home == c)
            others = np.flatnonzero(visited[:, c]) if c < visited.shape[1] else np.empty(0, np.int64)
            if not len(mine) and not len(others):
                continue
            for s in range(self.blocks[c]):
                stored = mine[block[mine] == s]
                out += [(stored, c, s, np.full(len(stored), q), True) for q in range(self.shares[c])]
                if self.floor is None:
                    come = mine[asks[mine]]  # its own block too
                else:
                    come = np.concatenate([others, mine[(block[mine] != s) & _goes(block[mine], s)]])
                out.append((come, c, s, (share[come] % np.uint64(self.shares[c])).astype(np.int64), False))
        rows, cells, blocks, shares, store = zip(*out, strict=True)
        spread_out = lambda values, kind: np.repeat(np.array(values, kind), [len(r) for r in rows])
        return np.concatenate(rows), spread_out(cells, np.int64), spread_out(blocks, np.int32), np.concatenate(shares).astype(np.int32), spread_out(store, bool)


def _means(rows: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Centres of rows; they start from rows that lie far from those before, so that no group goes without one."""
    rnd = np.random.default_rng(11)
    chosen = [int(rnd.integers(len(rows)))]
    apart = ((rows - rows[chosen[0]]) ** 2).sum(1)
    while len(chosen) < cells and apart.sum() > 0:
        drawn = rnd.choice(len(rows), 8, p=apart / apart.sum())
        left = [np.minimum(apart, ((rows - rows[d]) ** 2).sum(1)) for d in drawn]
        better = min(range(8), key=lambda i: left[i].sum())
        chosen.append(int(drawn[better]))
        apart = left[better]
    centres = rows[np.resize(chosen, cells)].copy()
    for _ in range(rounds):
        nearest = (2 * rows @ centres.T - (centres**2).sum(1)).argmax(1)
        centres = np.stack([rows[nearest == c].mean(0) if (nearest == c).any() else m for c, m in enumerate(centres)])
    return centres


def _goes(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """Whether a visits b: of two different numbers just one visits the other, and each visits about half of all."""
    return ((a + b) % 2 == 1) == (a < b)


def _spaces(units: DataFrame, counts: dict[str, int], dimension: int, floor: float | None, every: int) -> dict[str, _Space]:
    """The space of every version; one task fits one version, on about FIT_ROWS of its vectors, chosen by a hash of the id."""
    if floor is None:  # nothing to fit
        return {v: _Space(np.zeros((1, dimension), np.float32), n, floor, every) for v, n in counts.items()}
    share = F.lit(0.0)
    for version, n in counts.items():
        share = F.when(F.col("version") == version, min(1.0, FIT_ROWS / max(n, 1))).otherwise(share)
    picked = units.filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)) < share * 1_000_000).select("version", "unit")

    def one(group: pd.DataFrame) -> pd.DataFrame:
        version = group["version"].iloc[0]
        space = _Space(_unpack(group["unit"].tolist(), dimension), counts[version], floor, every)
        return pd.DataFrame({"version": [version], "space": [pickle.dumps(space)]})

    found = picked.groupBy("version").applyInPandas(one, "version string, space binary").toLocalIterator()  # a basis and CELLS bounds each
    spaces = {r["version"]: pickle.loads(r["space"]) for r in found}  # noqa: S301  made by the task above
    for version, n in counts.items():  # a tiny version may have no sampled row
        if version not in spaces:
            spaces[version] = _Space(np.zeros((1, dimension), np.float32), n, floor, every)
    return spaces


def _first(q: np.ndarray, x: np.ndarray, sims: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the k most similar, ties to the smaller id."""
    order = np.lexsort((ids[x], -sims, q))
    q, x, sims = q[order], x[order], sims[order]
    new = np.r_[True, q[1:] != q[:-1]] if len(q) else np.empty(0, bool)
    place = np.arange(len(q)) - np.maximum.accumulate(np.where(new, np.arange(len(q)), 0)) if len(q) else np.empty(0, int)
    return q[place < k], x[place < k], sims[place < k]


class _Filter:
    """Bounds of cosines by heads, some of the other numbers, and the lengths of what is left; exact where all are taken."""

    def __init__(self, units: np.ndarray, n_stored: int, basis: np.ndarray, floor: float | None) -> None:
        self.units, self.basis, self.taken = units, basis, units.shape[1]
        if floor is not None and n_stored:
            some = np.random.default_rng(3)
            rows, columns = (units[some.integers(0, n, 256)] for n in (len(units), n_stored))
            for taken in range(0, units.shape[1] * 5 // 8, 32):
                if (self._features(rows, taken) @ self._features(columns, taken).T >= floor - SLACK).mean() < 0.002:
                    self.taken = taken
                    break
        self.exact = self.taken == units.shape[1]
        self.stored = units[:n_stored] if self.exact else np.concatenate([self._features(units[a : min(a + 4096, n_stored)], self.taken) for a in range(0, n_stored, 4096)])

    def _features(self, units: np.ndarray, taken: int) -> np.ndarray:
        h = units @ self.basis
        rest = units - h @ self.basis.T
        return np.hstack([h, rest[:, :taken], np.linalg.norm(rest[:, taken:], axis=1, keepdims=True)])

    def scores(self, a: int, b: int, start: int) -> np.ndarray:
        rows = self.units[a:b] if self.exact else self._features(self.units[a:b], self.taken)
        return rows @ self.stored[start:].T


def search_block(ids: np.ndarray, units: np.ndarray, n_stored: int, inner: bool, asks: np.ndarray, k: int, floor: float | None, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(queries, neighbours, similarities): up to k of each query that asks, from the pairs of this block.

    The first n_stored vectors are the stored ones, the others visit them; with `inner` the stored ones meet each other too.
    With a floor every pair counts both ways; without one only visitors ask.
    """
    limit = -2.0 if floor is None else floor
    found, held = [(np.empty(0, int), np.empty(0, int), np.empty(0))], 0
    bounds = _Filter(units, n_stored, basis, floor)
    at = 0 if inner and floor is not None else n_stored
    while at < len(units) and n_stored:
        end = min(at + CHUNK, len(units) if at >= n_stored else n_stored)
        start = at if at < n_stored else 0
        scores = bounds.scores(at, end, start)
        if not bounds.exact and np.count_nonzero(scores >= limit - SLACK) > 0.01 * scores.size:
            scores, tight = units[at:end] @ units[start:n_stored].T, True  # too many to look at one by one
        else:
            tight = bounds.exact
        if start == at and at < n_stored:
            scores[np.tril_indices(end - at, 0, scores.shape[1])] = -9  # each pair once
        keep = scores >= limit - SLACK
        if tight and np.count_nonzero(keep) > 4 * k * (end - at):
            # only what can be among the k first of its row or its column here
            near = np.zeros_like(keep)
            extra = k + 1 if floor is None else k  # a vector may meet itself
            if scores.shape[1] > extra:
                near |= scores >= -np.partition(-scores, extra - 1, axis=1)[:, extra - 1 : extra] - 2 * SLACK
            else:
                near[:] = True
            if floor is not None:
                near |= scores >= (-np.partition(-scores, k - 1, axis=0)[k - 1] if len(scores) > k else -9) - 2 * SLACK
            keep &= near
        r, x = np.nonzero(keep)
        r, x = r + at, x + start
        other = ids[r] != ids[x]
        r, x = r[other], x[other]
        sims = np.concatenate([np.einsum("ij,ij->i", units[r[a : a + 8192]], units[x[a : a + 8192]], dtype=np.float64) for a in range(0, len(r), 8192)]) if len(r) else np.empty(0)
        good = sims >= limit
        r, x, sims = r[good], x[good], sims[good]
        if floor is not None:
            r, x, sims = np.r_[r, x], np.r_[x, r], np.r_[sims, sims]
            r, x, sims = r[asks[r]], x[asks[r]], sims[asks[r]]
        found.append((r, x, sims))
        held += len(r)
        if held > 2_000_000:
            found = [_first(*(np.concatenate(c) for c in zip(*found, strict=True)), ids, k)]
            held = 0
        at = end
    q, x, sims = _first(*(np.concatenate(c) for c in zip(*found, strict=True)), ids, k)
    return ids[q], ids[x], sims


def similar_vectors(vectors: DataFrame, k: int = 10, floor: float | None = None, dimension: int = 768, every: int = 1, probes: int = PROBES) -> DataFrame:
    """(version, query_id, neighbour_id, similarity): the k most similar vectors of each query, among all of its version.

    vectors: (version, id, at, v). With `every` > 1 the queries are the ids divisible by it; all vectors are indexed.
    `floor` leaves out neighbours of a lower similarity, and lets cells be ruled out. The search is exact, so `probes`, the
    number of cells that a search by nearest cells would look at, changes nothing. Vectors that are
    null, of a wrong length, all zero or not finite are left out; an id with several vectors counts with the latest
    (of equal times: one of them, by hash). Null ids or versions are left out. Ties go to the smaller id. Copies of a
    vector are indexed once; each of them gets its own k neighbours, copies first.
    """
    source = vectors.select(F.col("version").cast("string").alias("version"), F.col("id").cast("long").alias("id"), F.col("at").cast("timestamp").alias("at"), "v")
    usable = source.filter("version is not null and id is not null and v is not null")
    found = cut(_directions(usable, dimension))
    latest = found.groupBy("version", "id").agg(F.max(F.struct("at", "direction"))["direction"].alias("direction"))
    # who stands for whom: only directions that several ids share
    shared = latest.groupBy("version", "direction").agg(F.count("*").alias("n"), F.min("id").alias("stands"), F.bool_or(F.col("id") % every == 0).alias("asked"))
    chosen = cut(latest.join(shared.filter("n > 1").select("version", "direction", "stands"), ["version", "direction"], "left"))
    copies = chosen.filter("stands is not null").select("version", "stands", "id")
    # rows to leave out are few as a rule; they are told by short keys, and the vectors are read again, not written
    keep = chosen.filter("stands is null or stands = id").select("version", "id", "direction")
    out = cut(found.select("version", "id", "direction").join(keep, ["version", "id", "direction"], "left_anti").distinct())
    units = _units(usable, dimension)
    if not is_small(out, 0):
        dropped = F.broadcast(out) if is_small(out) else out  # keys that are all but unique need no salt
        units = units.join(dropped, ["version", "id", "direction"], "left_anti")
    units = units.select("version", "id", "unit", (F.col("id") % every == 0).alias("asks"))  # repeated rows are alike; they share a cell and are dropped there
    if every > 1:
        # who stands for copies asks if one of them does
        also = cut(shared.filter(f"n > 1 and asked and stands % {every} != 0").select("version", F.col("stands").alias("id"), F.lit(True).alias("for_copies")))
        if not is_small(also, 0):
            units = join_small(units, also, ["version", "id"], "left", salts=1).select("version", "id", "unit", (F.col("asks") | F.col("for_copies").isNotNull()).alias("asks"))
    counts = {r["version"]: r["n"] for r in chosen.groupBy("version").agg(F.count("*").alias("n")).toLocalIterator()}
    spark = vectors.sparkSession
    if not counts:
        return spark.createDataFrame([], "version string, query_id long, neighbour_id long, similarity double")
    model = spark.sparkContext.broadcast(_spaces(units, counts, dimension, floor, every))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                matrix = _unpack(batch.column("unit").to_pylist(), dimension)
                ids, versions, asks = batch.column("id").to_numpy(), np.array(batch.column("version").to_pylist()), np.array(batch.column("asks").to_pylist(), bool)
                for v in np.unique(versions):
                    mine = np.flatnonzero(versions == v)
                    rows, cells, blocks, shares, store = model.value[v].place(ids[mine], matrix[mine], asks[mine])
                    for a in range(0, len(rows), 16_384):
                        index, part = pa.array(mine[rows[a : a + 16_384]]), slice(a, a + 16_384)
                        yield pa.RecordBatch.from_arrays(
                            [*(batch.column(c).take(index) for c in ("version", "id", "unit", "asks")), pa.array(cells[part]), pa.array(blocks[part]), pa.array(shares[part]), pa.array(store[part])],
                            names=["version", "id", "unit", "asks", "cell", "s", "q", "store"],
                        )

    rows = units.mapInArrow(place, "version string, id long, unit binary, asks boolean, cell long, s int, q int, store boolean")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        ids, store, asks = table.column("id").to_numpy(), *(np.array(table.column(c).to_pylist(), bool) for c in ("store", "asks"))
        # repeated rows once, the stored ones first
        chosen = [np.flatnonzero(m)[np.unique(ids[m], return_index=True)[1]] for m in (store, ~store)]
        both = np.concatenate(chosen)
        units_ = _unpack(table.column("unit").take(pa.array(both)).to_pylist(), dimension)
        version, ids = key[0].as_py(), ids[both]
        q, x, s = search_block(ids, units_, len(chosen[0]), key[3].as_py() == 0, asks[both], k, floor, model.value[version].basis)
        return pa.table({"version": pa.array([version] * len(q), pa.string()), "query_id": pa.array(q, pa.int64()), "neighbour_id": pa.array(x, pa.int64()), "similarity": pa.array(s, pa.float64())})

    hits = rows.groupBy("version", "cell", "s", "q").applyInArrow(compare, "version string, query_id long, neighbour_id long, similarity double")
    best = Window.partitionBy("version", "query_id").orderBy(F.col("similarity").desc(), "neighbour_id")
    ranked = hits.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k).drop("_r")
    if is_small(copies, 0):
        return ranked
    return _with_copies(cut(ranked), copies, k, every)


def _with_copies(ranked: DataFrame, copies: DataFrame, k: int, every: int) -> DataFrame:
    """Neighbours of every member of a group of copies, from those of the vector that stands for it.

    Of a group only its first k + 1 members can be among anyone's k first (ties go to the smaller id); they are found
    by a salted ranking, so that no task orders a whole group.
    """
    salted = copies.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(64)).cast("int"))
    some = salted.withColumn("_r", F.row_number().over(Window.partitionBy("version", "stands", "_salt").orderBy("id"))).filter(F.col("_r") <= k + 1)
    first = cut(some.withColumn("_r", F.row_number().over(Window.partitionBy("version", "stands").orderBy("id"))).filter(F.col("_r") <= k + 1).select("version", F.col("stands").alias("neighbour_id"), F.col("id").alias("member")))
    others = ranked.join(first, ["version", "neighbour_id"], "left").select("version", "query_id", F.coalesce("member", "neighbour_id").alias("neighbour_id"), "similarity")
    own = first.select("version", F.col("neighbour_id").alias("query_id"), F.col("member").alias("neighbour_id"), F.lit(1.0).alias("similarity"))
    best = Window.partitionBy("version", "query_id").orderBy(F.col("similarity").desc(), "neighbour_id")
    lists = cut(others.unionByName(own).withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1).drop("_r"))
    asked = copies.filter(F.col("id") % every == 0) if every > 1 else copies
    # a group may hold a third of all rows: its members meet one short row of neighbours
    packed = lists.groupBy("version", F.col("query_id").alias("stands")).agg(F.collect_list(F.struct("neighbour_id", "similarity")).alias("near"))  # at most k + 1 each
    grouped = join_small(asked, packed.join(copies.select("version", "stands").distinct(), ["version", "stands"], "left_semi"), ["version", "stands"])
    mine = F.slice(F.filter(F.array_sort(F.transform("near", lambda x: F.struct((-x["similarity"]).alias("d"), x["neighbour_id"].alias("n")))), lambda x: x["n"] != F.col("id")), 1, k)
    members = grouped.select("version", F.col("id").alias("query_id"), F.explode(mine).alias("x")).select("version", "query_id", F.col("x.n").alias("neighbour_id"), (-F.col("x.d")).alias("similarity"))
    alone = lists.join(copies.select("version", F.col("id").alias("query_id")), ["version", "query_id"], "left_anti")
    single = alone.withColumn("_r", F.row_number().over(best)).filter((F.col("_r") <= k) & (F.col("query_id") % every == 0)).drop("_r")
    return single.unionByName(members)


def similar_pairs(neighbours: DataFrame) -> DataFrame:
    """(version, document_a, document_b): every pair of which one is a neighbour of the other, once, the smaller id first."""
    return neighbours.select("version", F.least("query_id", "neighbour_id").alias("document_a"), F.greatest("query_id", "neighbour_id").alias("document_b")).distinct()
