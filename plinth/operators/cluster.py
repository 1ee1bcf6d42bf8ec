"""K-means cluster features (stage 4): E01, E02.

Inputs are standardised with POPULATION std (sklearn's StandardScaler) from one aggregate.  All
fits -- every feature set, every k, every restart -- share the same passes over one cached table: a task holds its rows
against the centres of all runs and passes on a sum and a count per run and centre, which one
aggregate adds up.  So the number of passes does not depend on the number of restarts.

Seeding is k-means||: from one random row, ``SEED_ROUNDS`` rounds take rows with a probability in proportion to
their squared distance, 2 k a round on average; a run's candidates, weighted by the rows next to them, are reduced to k
by weighted k-means++ on the driver (2 k * rounds + 1 candidates a run).  Equal rows of a task are
drawn together with their number, and the draws derive from the values, so a recomputed task draws alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators.encode import fit_standard_scaler

SEED_ROUNDS = 2
#: Rows that a task holds against the centres at a time.
BLOCK_ROWS = 8192


@dataclass
class Run:
    """One fit: the places of its columns, its k, its centres so far and what the last pass said about them."""

    cols: np.ndarray
    k: int
    seed: int
    centres: np.ndarray
    cost: float = np.inf
    moved: float = np.inf
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0))
    next: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) if batch.num_rows else np.empty((0, batch.num_columns))
        for at in range(0, len(x), BLOCK_ROWS):
            yield x[at : at + BLOCK_ROWS]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a block, as bytes: later passes don't turn values into rows and back."""
    for x in _blocks(batches):
        yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())], ["x"])


def _unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column(0):
            yield np.frombuffer(x.as_buffer()).reshape(-1, width)


def _nearest(x: np.ndarray, run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the run's columns, nearest centre, squared distance to it)."""
    own = x[:, run.cols]
    d = (own * own).sum(1)[:, None] - 2 * own @ run.centres.T + (run.centres * run.centres).sum(1)
    best = d.argmin(1)
    return own, best, np.maximum(d[np.arange(len(own)), best], 0.0)


def _uniform(rows: np.ndarray, *salt: int) -> np.ndarray:
    """A number in [0, 1) for every row, from its values and the salt."""
    h = np.full(len(rows), 0x9E3779B97F4A7C15, np.uint64)
    for c in [*np.ascontiguousarray(rows + 0.0).view(np.uint64).T, *(np.uint64(s % 2**64) for s in salt)]:
        h = (h ^ c) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype(np.float64) / 2.0**53


#: Numbers of the distance table that a task holds at a time, so that it stays in the processor's cache.
TABLE_CELLS = 1 << 18


def _first_of_ties(hit: np.ndarray, starts: np.ndarray) -> None:
    """Leaves the first of the centres of a run that are equally near to a row."""
    tied = np.flatnonzero(hit.sum(0) != len(starts))
    some = hit[:, tied]
    for a, b in zip(starts, [*starts[1:], len(hit)]):
        first = some[a:b].argmax(0)
        some[a:b] = False
        some[a + first, np.arange(len(tied))] = True
    hit[:, tied] = some


def _add(x: np.ndarray, group: Sequence[Run]) -> tuple[np.ndarray, np.ndarray]:
    """(a row a centre of the runs, which share their columns: sums and count of its rows; cost a run), as two matrix products."""
    own = np.ascontiguousarray(x[:, group[0].cols])
    centres = np.concatenate([r.centres for r in group])
    sizes = [len(r.centres) for r in group]
    starts = np.cumsum([0, *sizes[:-1]])
    half = (centres * centres).sum(1)[:, None] / 2
    total, cost = np.zeros((len(centres), own.shape[1] + 1)), np.zeros(len(group))
    step = min(len(own), max(64, TABLE_CELLS // len(centres)))
    spans = [slice(a, a + n) for a, n in zip(starts, sizes)]
    # tables are made once: fresh memory for every step would cost more than the products
    table, hit, ones = np.empty((len(centres), step)), np.empty((len(centres), step), bool), np.ones((step, own.shape[1] + 1))
    least = np.empty((len(group), step))
    for at in range(0, len(own), step):
        rows = own[at : at + step]
        t, h, m, n = table[:, : len(rows)], hit[:, : len(rows)], least[:, : len(rows)], len(rows)
        np.subtract(half, centres @ rows.T, out=t)  # half the squared distance, less half the row's square
        for j, span in enumerate(spans):
            t[span].min(axis=0, out=m[j])
            np.equal(t[span], m[j], out=h[span])
        if np.count_nonzero(h) != m.size:
            _first_of_ties(h, starts)
        np.copyto(t, h)
        ones[:n, :-1] = rows
        total += t @ ones[:n]
        cost += np.maximum(2 * m + (rows * rows).sum(1), 0.0).sum(1)
    return total, cost


def _sums(data: DataFrame, runs: Sequence[Run], passes: list, columns: int) -> None:
    """One pass: cost, counts and new centres of all runs (a centre without rows stays)."""
    passes.append("sums")
    width = max(len(r.cols) for r in runs)
    alike: dict[tuple, list[int]] = {}
    for i, r in enumerate(runs):
        if len(r.centres):
            alike.setdefault(tuple(r.cols), []).append(i)

    def add(batches):
        groups = [[runs[i] for i in places] for places in alike.values()]
        totals: list = [None] * len(groups)
        for x in _unpacked(batches, columns):
            for g, group in enumerate(groups):
                new = _add(x, group)
                totals[g] = new if totals[g] is None else (totals[g][0] + new[0], totals[g][1] + new[1])
        rows = []
        for places, found in zip(alike.values(), totals):
            at = 0
            for j, i in enumerate(places if found else ()):
                for c in range(len(runs[i].centres)):
                    *s, n = found[0][at].tolist()
                    rows.append((i, c, n, float(found[1][j]) if c == 0 else 0.0, *s, *[0.0] * (width - len(s))))
                    at += 1
        names = ["run", "centre", "n", "cost", *[f"s{j}" for j in range(width)]]
        kinds = [pa.int32(), pa.int32(), *[pa.float64()] * (2 + width)]
        cols = zip(*rows) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    schema = "run int, centre int, n double, cost double, " + ", ".join(f"s{j} double" for j in range(width))
    got = (data.mapInArrow(add, schema).groupBy("run", "centre")
           .agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(width)]).collect())  # a row a centre
    new = [r.centres.copy() for r in runs]
    cost, counts = np.zeros(len(runs)), [np.zeros(len(r.centres)) for r in runs]
    for r in got:
        i, c = r["run"], r["centre"]
        cost[i] += r["cost"]
        counts[i][c] = r["n"]
        if r["n"]:
            new[i][c] = np.array([r[f"s{j}"] for j in range(len(runs[i].cols))]) / r["n"]
    for i, run in enumerate(runs):
        run.moved = float(((new[i] - run.centres) ** 2).sum(1).max())
        run.cost, run.counts, run.next = float(cost[i]), counts[i], new[i]


def _draw(data: DataFrame, runs: Sequence[Run], choose: Callable, passes: list, round_: int, columns: int) -> list[np.ndarray]:
    """One pass: the distinct rows that ``choose(run, rows, distance, u, number)`` takes for each run."""
    passes.append("draw")

    def pick(batches):
        part = TaskContext.get().partitionId()
        for x in _unpacked(batches, columns):
            x, n = np.unique(x, axis=0, return_counts=True)
            out = []
            for i, r in enumerate(runs):
                d = _nearest(x, r)[2] if len(r.centres) else np.ones(len(x))
                u = _uniform(x[:, r.cols], r.seed, round_, part)
                out += [(i, *row) for row in choose(r, d, u, n)(x[:, r.cols], u)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.float64()),
                                              pa.array([list(o[2]) for o in out], pa.list_(pa.float64()))], ["run", "u", "row"])

    got = data.mapInArrow(pick, "run int, u double, row array<double>")
    if round_ < 0:  # one row a run
        got = got.groupBy("run").agg(F.min(F.struct("u", "row")).alias("m")).select("run", "m.row")
    rows = got.select("run", "row").distinct().collect()  # some 2 k a run
    return [np.array(sorted(r["row"] for r in rows if r["run"] == i)).reshape(-1, len(run.cols)) for i, run in enumerate(runs)]


def _weighted_seeds(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k of the weighted points by k-means++; fewer where there are fewer."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))] if weights.sum() else [0]
    while len(chosen) < min(k, len(points)):
        d = ((points[:, None] - points[chosen][None]) ** 2).sum(2).min(1) * np.maximum(weights, 1e-9)
        if not d.sum():
            break
        chosen.append(int(rng.choice(len(points), p=d / d.sum())))
    return points[chosen]


def _seed(data: DataFrame, runs: Sequence[Run], passes: list, columns: int) -> None:
    def one(run, d, u, n):
        return lambda x, u: [(u.min(), x[u.argmin()])] if len(x) else []

    def far(run, d, u, n):
        p = np.minimum(1.0, 2 * run.k * d / run.cost) if run.cost else np.zeros(len(d))
        taken = u < 1 - (1 - p) ** n
        return lambda x, u: zip(u[taken], x[taken])

    for run, first in zip(runs, _draw(data, runs, one, passes, -1, columns)):
        run.centres = first
    for round_ in range(SEED_ROUNDS):
        _sums(data, runs, passes, columns)
        for run, more in zip(runs, _draw(data, runs, far, passes, round_, columns)):
            run.centres = np.unique(np.concatenate([run.centres, more]), axis=0)
    _sums(data, runs, passes, columns)
    for run in runs:
        run.centres = _weighted_seeds(run.centres, run.counts, run.k, run.seed)


def fit_many(data: DataFrame, fits: Mapping[str, tuple[Sequence[str], int]], restarts: int = 20, seed: int = 42, max_iter: int = 50,
             tol: float = 1e-4, passes: list | None = None) -> dict[str, tuple[np.ndarray, dict, float]]:
    """The best of ``restarts`` k-means fits for every ``name -> (columns, k)``: (centres, scaling, cost).

    A run ends when no centre moves by more than ``tol`` (squared, in standard deviations).  NULL and NaN stand for the
    column's mean.  ``passes`` is filled with the passes over the data.  An empty table gives no centres.
    """
    passes = passes if passes is not None else []
    cols = list(dict.fromkeys(c for own, _ in fits.values() for c in own))
    params = fit_standard_scaler(data, cols)
    vec = data.select(*[_scaled(c, params).alias(f"x{i}") for i, c in enumerate(cols)])
    vec = vec.mapInArrow(_packed, "x binary").persist(StorageLevel.MEMORY_AND_DISK)
    place = {c: i for i, c in enumerate(cols)}
    every = {n: [Run(np.array([place[c] for c in own]), k, seed + 1009 * r, np.empty((0, len(own)))) for r in range(restarts)] for n, (own, k) in fits.items()}
    runs = [r for own in every.values() for r in own]
    if not vec.isEmpty():
        _seed(vec, runs, passes, len(cols))
        active = runs
        for _ in range(max_iter):
            _sums(vec, active, passes, len(cols))
            for r in active:
                r.centres = r.next
            active = [r for r in active if r.moved > tol]
            if not active:
                break
        _sums(vec, runs, passes, len(cols))  # the cost of the final centres
    vec.unpersist()
    best = {n: min(own, key=lambda r: r.cost) for n, own in every.items()}
    return {n: (r.centres, {c: params[c] for c in fits[n][0]}, r.cost) for n, r in best.items()}


def _scaled(c: str, params: dict):
    x = F.col(f"`{c}`").cast("double")
    return F.coalesce(F.nanvl((x - F.lit(params[c][0])) / F.lit(params[c][1]), F.lit(None).cast("double")), F.lit(0.0))


def fit_kmeans(data: DataFrame, cols: Sequence[str], k: int, restarts: int = 20, seed: int = 42, max_iter: int = 50):
    """(centres, scaling) of the best of ``restarts`` fits."""
    centres, params, _ = fit_many(data, {"": (cols, k)}, restarts, seed, max_iter)[""]
    return centres, params


def assign_clusters(df: DataFrame, centres: np.ndarray, params, cols: Sequence[str], name: str, as_label: bool = True) -> DataFrame:
    """Cluster id for every row (``Cluster_i`` labels like the reference, or the integer): the nearest centre, the first of
    equally near ones.  The input columns stay as they are."""
    scaled = [_scaled(c, params) for c in cols]
    far = F.array(*[sum((((x - F.lit(float(v))) * (x - F.lit(float(v)))) for x, v in zip(scaled, c)), F.lit(0.0)) for c in centres])
    place = (F.array_position(far, F.array_min(far)) - 1).cast("int") if len(centres) else F.lit(None).cast("int")
    lab = F.concat(F.lit("Cluster_"), place.cast("string")) if as_label else place
    return df.select(*[F.col(f"`{c}`") for c in df.columns], lab.alias(name))


def kmeans_feature(train: DataFrame, test: DataFrame, cols: Sequence[str], k: int = 4, restarts: int = 20,
                   seed: int = 42, name: str = "Cluster") -> tuple[DataFrame, DataFrame]:
    """Fitted on train UNION test (the reference's choice), label ``Cluster_i``."""
    both = train.select(*cols).unionByName(test.select(*cols))
    centres, params = fit_kmeans(both, cols, k, restarts, seed)
    return (assign_clusters(train, centres, params, cols, name),
            assign_clusters(test, centres, params, cols, name))


def multi_kmeans(train: DataFrame, test: DataFrame, configs: Mapping[str, tuple[Sequence[str], Sequence[int]]],
                 seed: int = 42, restarts: int = 20) -> tuple[DataFrame, DataFrame]:
    """Per named feature set and each k, a train-only fit, all in the same passes; sets with fewer than two
    usable columns are skipped.  Integer ids ``<set>_k<k>``."""
    usable = {name: [c for c in cols if c in train.columns and c in test.columns] for name, (cols, _) in configs.items()}
    fits = {f"{name}_k{k}": (usable[name], k) for name, (_, ks) in configs.items() if len(usable[name]) >= 2 for k in ks}
    if not fits:
        return train, test
    for name, (centres, params, _) in fit_many(train, fits, restarts, seed).items():
        train = assign_clusters(train, centres, params, fits[name][0], name, as_label=False)
        test = assign_clusters(test, centres, params, fits[name][0], name, as_label=False)
    return train, test
