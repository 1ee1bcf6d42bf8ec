"""Hyperparameter search by successive halving over (trial, fold) fits, with a time budget that holds.

Every fit of a trial on one fold is a unit of work of its own; workers always take the unit of the highest rung
that waits.  Trials are compared in cohorts of consecutive numbers: a cohort's trials are all scored on the folds
of the first rung, the best ``1 / eta`` of them go on to the folds of the next one, and so on, until the last
rung's trials are scored on all folds.  A cohort never waits for another one, and what is cut depends on the
scores in the cohort alone, never on which fit ends first: without a budget the result is the same on any number
of workers.

The budget holds for running fits too: all their Spark jobs carry a tag of the search, and jobs with this tag are
cancelled from the deadline on until no fit runs any more.
"""

from __future__ import annotations

import heapq
import math
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators.models import cv_fold_rmse, even_cache, sample_space

COMPLETE, CUT, STOPPED = "complete", "cut", "stopped"
#: Seconds between two cancellations after the deadline: a fit may start one more job just after the first.
CANCEL_EVERY = 0.2


@dataclass
class Trial:
    """A parameter set and its scores by fold.  ``state``: ``complete`` (all folds), ``cut`` (worse than its cohort
    at ``rung``) or ``stopped`` (by the budget)."""

    number: int
    params: dict
    state: str = STOPPED
    rung: int = 0
    scores: dict = field(default_factory=dict)

    @property
    def rmse(self) -> float | None:
        """Mean over the folds scored so far; None before the first."""
        return math.fsum(self.scores.values()) / len(self.scores) if self.scores else None

    @property
    def std(self) -> float | None:
        """Population standard deviation over the folds scored so far."""
        mean = self.rmse
        return None if mean is None else math.sqrt(math.fsum((s - mean) ** 2 for s in self.scores.values()) / len(self.scores))


def rung_folds(folds: Sequence, eta: int) -> list[list]:
    """The folds of each rung: 1, then in all ``eta``, ``eta ** 2``, ... of them; the last rung has what is left.

    The last rung adds at least as many folds as all rungs before it hold, so few trials pay for most fits."""
    out, done, reach = [], 0, 1
    while done < len(folds):
        upto = min(reach, len(folds))
        out.append(list(folds[done:upto]))
        done, reach = upto, reach * eta
    return out


class _Cohort:
    """Trials that are compared with each other, and the rung that those left of them are on."""

    def __init__(self, trials: list[Trial]):
        self.left, self.rung, self.waiting = trials, 0, 0

    def advance(self, rungs: int, eta: int) -> list[Trial]:
        """Ends the rung: cuts all but the best ``1 / eta`` (ties: smaller number) and returns those that go on."""
        if self.rung == rungs - 1:
            for t in self.left:
                t.state = COMPLETE
            self.left = []
            return []
        order = sorted(self.left, key=lambda t: (not math.isfinite(t.rmse), t.rmse if math.isfinite(t.rmse) else 0.0, t.number))
        keep = max(1, len(order) // eta)
        for t in order[keep:]:
            t.state = CUT
        self.left = order[:keep]
        self.rung += 1
        for t in self.left:
            t.rung = self.rung
        return self.left


def rung_search(data: DataFrame, space: Mapping[str, object], make: Callable[[Mapping], Callable], trials: int = 50,
                seed: int = 42, fold: str = "fold", threads: int = 4, time_budget_s: float | None = None,
                eta: int = 3, **kw) -> list[Trial]:
    """``trials`` parameter sets of ``space`` (see ``sample_space``) by successive halving over the folds.

    ``make(params)`` returns an estimator factory; further arguments go to the score.  All trials are returned,
    the best first: complete ones by mean RMSE, then the others, those with more folds first; ties by number.
    After ``time_budget_s`` seconds no fit starts and running ones are cancelled; their trials are ``stopped`` and
    keep the scores they have.  An error in a fit cancels the others and is raised.  ``data`` without rows or
    folds gives trials without scores.
    """
    if eta < 2:
        raise ValueError("eta must be at least 2")
    context = data.sparkSession.sparkContext
    start = time.monotonic()
    data = even_cache(data)
    try:
        folds = [r[0] for r in data.where(F.col(fold).isNotNull()).select(fold).distinct().orderBy(fold).collect()]  # k values
        everything = [Trial(i, p) for i, p in enumerate(sample_space(space, trials, seed))]
        rungs = rung_folds(folds, eta)
        if rungs:
            _run(everything, rungs, eta, threads, context, None if time_budget_s is None else start + time_budget_s,
                 lambda t, k: cv_fold_rmse(data, make(t.params), k, fold, **kw))
    finally:
        data.unpersist()
    return sorted(everything, key=lambda t: (t.state != COMPLETE, -len(t.scores), math.inf if t.rmse is None else t.rmse, t.number))


def _run(everything: list[Trial], rungs: list[list], eta: int, threads: int, context, deadline: float | None,
         score: Callable[[Trial, object], float]) -> None:
    """Works off the queue of (trial, fold) fits and writes scores, rungs and states into the trials."""
    size = eta ** (len(rungs) - 1)
    cohorts = [_Cohort(everything[i : i + size]) for i in range(0, len(everything), size)]
    tag = f"plinth-search-{uuid.uuid4().hex}"
    queue: list[tuple[int, int, int, int]] = []

    def enter(number: int, some: list[Trial]) -> None:
        c = cohorts[number]
        for t in some:
            for at in range(len(rungs[c.rung])):
                heapq.heappush(queue, (-c.rung, t.number, at, number))
        c.waiting = len(some) * len(rungs[c.rung])

    def fit(t: Trial, k) -> float:
        context.addJobTag(tag)
        try:
            return score(t, k)
        finally:
            context.removeJobTag(tag)

    def late() -> bool:
        return deadline is not None and time.monotonic() >= deadline

    for number, c in enumerate(cohorts):
        enter(number, c.left)
    running: dict[Future, tuple[Trial, object, int]] = {}
    error: BaseException | None = None
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        while running or (queue and not error and not late()):
            halt = error is not None or late()
            while queue and len(running) < max(1, threads) and not halt:
                rung, trial, at, number = heapq.heappop(queue)
                k = rungs[-rung][at]
                running[pool.submit(fit, everything[trial], k)] = (everything[trial], k, number)
            if halt:
                context.cancelJobsWithTag(tag)
            pause = CANCEL_EVERY if halt else None if deadline is None else max(0.0, deadline - time.monotonic())
            for done in wait(running, pause, FIRST_COMPLETED).done:
                t, k, number = running.pop(done)
                if done.exception() is not None:
                    if not late():  # else it is the cancelled job's
                        error = error or done.exception()
                    continue
                t.scores[k] = done.result()
                cohorts[number].waiting -= 1
                if not cohorts[number].waiting:
                    enter(number, cohorts[number].advance(len(rungs), eta))
    if error is not None:
        raise error


def trials_table(spark, found: Sequence[Trial]) -> DataFrame:
    """The trials as rows (one a trial): place in the ranking, state, rung, folds scored, mean and std of the RMSE, parameters."""
    rows = [(i, t.number, t.state, t.rung, len(t.scores), t.rmse, t.std, {k: str(v) for k, v in t.params.items()}) for i, t in enumerate(found, 1)]
    return spark.createDataFrame(rows, "place int, trial int, state string, rung int, folds int, rmse double, std double, params map<string, string>")
