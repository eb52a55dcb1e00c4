"""Matrix factorisation by alternating least squares: fit, score, search, refit."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor, as_completed
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.operators.evaluate import rmse
from palate.session import delete, exists, names_in, scratch_path, shared_dir
from palate.sources.models import load_model, save_model, save_restricted, save_without_factors
from palate.sources.paths import checked

# Fixed values of the published search.
SEED = 12345
RANKS = (2, 4, 8, 12, 16, 20, 24)
REG_PARAMS = (0.01, 0.05, 0.1, 0.15, 0.2, 0.3)

CHECKPOINT_INTERVAL = 5
BLOCKS = 10


@contextmanager
def persisted(*frames: DataFrame) -> Iterator[None]:
    """Keep frames in memory, spilling to disk, for the length of a ``with`` block.

    Frames the caller has cached already are left as they are.
    """
    own = [df for df in frames if not _is_stored(df)]
    for df in own:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        for df in own:
            df.unpersist()


def _is_stored(df: DataFrame) -> bool:
    level = df.storageLevel
    return level.useMemory or level.useDisk


def estimator(ratings: DataFrame, rank: int = 10, reg_param: float = 0.1, max_iter: int = 10,
              user_blocks: int = BLOCKS, item_blocks: int = BLOCKS, seed: int = SEED) -> ALS:
    """An explicit-feedback estimator.

    Start factors are drawn per block, so the number of blocks is part of the
    model like the seed and never follows from the cluster. Raise both on a large
    cluster (a task solves one block at a time, and each cutting task sets up
    ``user_blocks * item_blocks`` builders), knowing that the factors change.
    The checkpoint folder is registered first, so ALS cuts the lineage of its
    factors every few iterations and a lost executor replays no more than those.
    """
    shared_dir(ratings.sparkSession)
    return ALS(userCol="userId", itemCol="movieId", ratingCol="rating", rank=rank, regParam=reg_param,
               maxIter=max_iter, numUserBlocks=user_blocks, numItemBlocks=item_blocks, seed=seed,
               checkpointInterval=CHECKPOINT_INTERVAL)


def fit(ratings: DataFrame, rank: int = 10, reg_param: float = 0.1, durable: bool = True,
        **options) -> ALSModel:
    """Train on the three columns the solver needs; ids must be 32-bit and not null.

    ``ALS.fit`` evaluates its input more than once, so rows that are not cached
    yet are kept for the length of the fit. A durable model is written to the
    shared folder and read back: its factors no longer depend on the training
    lineage or on any executor, and joins with them are planned by their size.
    Without a single row, which ``ALS.fit`` refuses, the model knows no user and no item.
    """
    columns = ("userId", "movieId", "rating")
    rows = ratings.select(*columns)
    for column in columns:
        rows = rows.filter(F.col(column).isNotNull())
    solver = estimator(ratings, rank, reg_param, **options)
    with nullcontext() if _is_stored(ratings) else persisted(rows):
        model = None if rows.isEmpty() else solver.fit(rows)
        if model is not None and durable:
            kept = make_durable(model, ratings.sparkSession)
            release(model)  # while the rows are stored: shuffles above them are the caller's
            return kept
    return untrained(solver, ratings.sparkSession) if model is None else model


def untrained(solver: ALS, spark: SparkSession) -> ALSModel:
    """A durable model with the solver's settings that knows no user and no item.

    Spark makes models by fitting only, so one is fitted on a single made-up row and its factors are left out.
    """
    model = solver.copy({solver.maxIter: 0}).fit(spark.createDataFrame([(0, 0, 0.0)], "userId int, movieId int, rating float"))
    path = scratch_path(spark, "model")
    save_without_factors(model, path)
    release(model)
    return load_model(path)


def make_durable(model: ALSModel, spark: SparkSession) -> ALSModel:
    path = scratch_path(spark, "model")
    save_model(model, path)
    return load_model(path)


def release(model: ALSModel) -> None:
    """Drop the factors that ``fit`` left in the executors' memory, and the files of its shuffles on their disks.

    They are stored below the model's frames, where ``DataFrame.unpersist`` does not reach. The shuffles, several
    times the ratings in size, would stay until the driver happens to collect its garbage.
    """
    for factors in (model.userFactors, model.itemFactors):
        todo = [factors._jdf.queryExecution().toRdd()]
        while todo:
            rdd = todo.pop()
            if rdd.getStorageLevel().useMemory() or rdd.getStorageLevel().useDisk():
                rdd.unpersist(False)
                rdd.cleanShuffleDependencies(True)
            else:
                parents = rdd.dependencies()
                todo += [parents.apply(i).rdd() for i in range(parents.size())]


def restricted(model: ALSModel, item_ids: DataFrame) -> ALSModel:
    """A durable copy of ``model`` that knows only the items in ``item_ids``, a frame with the column ``id``.

    With it the built-in recommender serves lists within a genre or over a floor.
    """
    path = scratch_path(item_ids.sparkSession, "model")
    save_restricted(model, path, item_ids)
    return load_model(path)


@dataclass(frozen=True)
class Search:
    """Outcome of a grid search; ``metrics`` has one row per candidate, ``paths`` the models that were kept, by position.

    Where nothing was chosen, model, rank and regularisation are None, and the error is NaN.
    """

    model: ALSModel | None
    rank: int | None
    reg_param: float | None
    rmse: float
    metrics: DataFrame
    paths: dict[int, str]


METRICS = "grid_pos int, reg_param double, rank int, n_scored long, rmse double, is_best boolean"
FINISHED = "reg_param double, rank int, n_scored long, rmse double, model string"


def search_identity(train: DataFrame, validation: DataFrame, options: dict) -> str:
    """A digest of the rows a search reads and of its options, whatever the rows' order or layout."""
    columns = ("userId", "movieId", "rating")
    told = [df.agg(F.count("*"), F.bit_xor(F.xxhash64(*columns)), F.sum(F.pmod(F.xxhash64(*columns), F.lit(1 << 20)))).first()
            for df in (train, validation)]
    return hashlib.sha256(repr((tuple(map(tuple, told)), SEED, sorted(options.items()))).encode()).hexdigest()[:24]


class Ledger:
    """Finished candidates of searches in shared storage: a row each, and their models.

    Everything of a candidate has paths of its own, so candidates are written side by side; its row
    comes last. What has no row is not finished and is fitted again.
    """

    def __init__(self, spark: SparkSession, path: str, identity: str):
        self.spark, self.path = spark, f"{checked(path)}/{identity}"

    def _name(self, reg: float, rank: int) -> str:
        return f"rank-{rank}-reg-{float(reg)!r}"

    def model_path(self, reg: float, rank: int) -> str:
        return f"{self.path}/models/{self._name(reg, rank)}"

    def finished(self) -> dict[tuple[float, int], tuple[int, float]]:
        """``(n_scored, error)`` by candidate."""
        whole = [f"{self.path}/rows/{n}" for n in names_in(self.spark, f"{self.path}/rows")
                 if exists(self.spark, f"{self.path}/rows/{n}/_SUCCESS")]
        if not whole:
            return {}
        rows = self.spark.read.schema(FINISHED).parquet(*whole).collect()  # a row for each candidate
        return {(r["reg_param"], r["rank"]): (r["n_scored"], r["rmse"]) for r in rows}

    def add(self, reg: float, rank: int, n_scored: int, error: float) -> None:
        row = (float(reg), rank, n_scored, error, self.model_path(reg, rank))
        frame = self.spark.createDataFrame([row], FINISHED).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.path}/rows/{self._name(reg, rank)}")

    def drop_model(self, reg: float, rank: int) -> None:
        delete(self.spark, self.model_path(reg, rank))


def grid_search(train: DataFrame, validation: DataFrame, ranks: Iterable[int] = RANKS,
                reg_params: Iterable[float] = REG_PARAMS, parallelism: int = 1, ledger: str | None = None,
                keep_models: bool = False, must_choose: bool = True, **options) -> Search:
    """Fit every candidate on ``train`` and choose the one with the least validation RMSE.

    Candidates are numbered with the regularisation as the outer loop, and the earliest of equals is chosen.
    ``parallelism`` of them run at a time, which fills the cluster while one is in a small stage. A
    candidate's model is written and leaves the executors before its thread takes another, so no more
    than ``parallelism`` models are alive, whichever finishes first; only errors reach the driver.

    ``ledger`` names a folder in shared storage. A search that finds candidates there that were
    finished on the same rows with the same options, by a run that was lost, a smaller grid or another
    driver, fits the others only. Models of all but the best are deleted, unless ``keep_models``.
    Without a finite error there is no best: an error, or with ``must_choose=False`` metrics in which no row is marked.
    """
    spark = train.sparkSession
    candidates = [(float(reg), rank) for reg in reg_params for rank in ranks]
    with persisted(train, validation):
        identity = search_identity(train, validation, options) if ledger else "search"
        book = Ledger(spark, ledger or scratch_path(spark, "ledger"), identity)
        done = book.finished()
        if keep_models:
            done = {c: v for c, v in done.items() if exists(spark, book.model_path(*c))}

        def attempt(candidate: tuple[float, int]) -> tuple[int, float]:
            reg, rank = candidate
            model = fit(train, rank, reg, durable=False, **options)
            try:
                n_scored, error = rmse(model.transform(validation)).first()
                save_model(model, book.model_path(reg, rank))
            finally:
                release(model)
            return n_scored, math.nan if error is None else error

        # A NaN compares false, so it is never the best; an equal error does not displace an earlier one.
        place = {c: p for p, c in reversed(list(enumerate(candidates)))}
        best = min(((e, place[c]) for c, (_, e) in done.items() if c in place and e < math.inf), default=None)
        with ThreadPoolExecutor(parallelism) as pool:
            running = {pool.submit(inheritable_thread_target(spark)(attempt), c): c for c in place if c not in done}
            failure = None
            for future in as_completed(running):
                if future.cancelled():
                    continue
                if future.exception():  # what is still running is recorded, what is waiting is not begun
                    failure = failure or future.exception()
                    for other in running:
                        other.cancel()
                    continue
                candidate = running[future]
                n_scored, error = done[candidate] = future.result()
                book.add(*candidate, n_scored, error)
                mine, loser = (error, place[candidate]), candidate
                if error < math.inf and (best is None or mine < best):
                    loser, best = best and candidates[best[1]], mine
                if loser and not keep_models:
                    book.drop_model(*loser)
            if failure:
                raise failure
        if best is None and must_choose:
            raise ValueError("no candidate scored any validation row with a finite error")
        error, chosen = best or (math.nan, None)
        reg, rank = (None, None) if chosen is None else candidates[chosen]
        if chosen is not None and not exists(spark, book.model_path(reg, rank)):  # a search before this one had a better one of its own
            attempt((reg, rank))
    marked = [(p, *c, *done[c], p == chosen) for p, c in enumerate(candidates)]
    metrics = spark.createDataFrame([(p, reg, rank, n, e, b) for p, reg, rank, n, e, b in marked], METRICS)
    kept = {p: book.model_path(*c) for p, c in enumerate(candidates) if keep_models or p == chosen}
    return Search(None if chosen is None else load_model(kept[chosen]), rank, reg, error, metrics, kept)


def refit(train: DataFrame, validation: DataFrame, rank: int, reg_param: float,
          everything: DataFrame | None = None, **options) -> ALSModel:
    """Train chosen parameters again.

    By default on train + validation, which keeps the test part unseen. Pass
    ``everything`` to train on all ratings instead; the test error of that
    model is then optimistic, because its test rows were trained on.
    """
    rows = everything if everything is not None else train.unionByName(validation)
    return fit(rows, rank, reg_param, **options)
