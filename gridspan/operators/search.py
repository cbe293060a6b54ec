"""Load-shape clustering and distributed search of autoregressive orders.

Fits use normal equations: the products of regressors are summed per entity by Spark (one
map-side-combined pass serves every candidate order), and only a small matrix per entity is
solved in numpy.  No task ever holds the history of an entity.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import EVAL, EvalSpec, money_pct
from ..plans.lineage import cut
from ..plans.slabs import DEFAULT_SLAB, rejoin, settle, slab_window, spread
from ..spec import PANEL, PanelSpec
from .evaluate import pick_orders
from .features import decompose, recompose
from .stats import load_shapes, most_common

# The candidate grid of autoregressive orders and differencing.
P_RANGE, D_RANGE = (0, 1, 2, 3), (0, 1)
EXOG = ("dam_price", "sell_bm_price", "buy_bm_price", "Hour", "day_of_week", "Month")


def orders_grid(p_range: Sequence[int] = P_RANGE, d_range: Sequence[int] = D_RANGE):
    return [(p, d) for p in p_range for d in d_range]


# --- clusters ---------------------------------------------------------------------------

def cluster_entities(df: DataFrame, spec: PanelSpec = PANEL, clusters: int = 15,
                     seed: int = 42) -> DataFrame:
    """k-means over standardised load shapes; the member nearest to a centre represents it."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    shapes = cut(load_shapes(df, spec))
    k = min(clusters, shapes.count())
    if k < 2:
        return shapes.select(spec.entity, F.lit(0).alias("cluster"), F.lit(0.0).alias("distance"),
                             F.lit(True).alias("representative"))
    names = [c for c in shapes.columns if c != spec.entity]
    model = Pipeline(stages=[
        VectorAssembler(inputCols=names, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_z", withMean=True, withStd=True),
        KMeans(featuresCol="_z", predictionCol="cluster", k=k, seed=seed)]).fit(shapes)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c])
                        for c in model.stages[-1].clusterCenters()])
    placed = model.transform(shapes).select(spec.entity, "cluster", vector_to_array("_z").alias("_z"))
    gap = F.zip_with("_z", F.get(centres, F.col("cluster")), lambda a, b: (a - b) * (a - b))
    placed = placed.select(spec.entity, "cluster", F.sqrt(F.aggregate(
        gap, F.lit(0.0), lambda acc, v: acc + v)).alias("distance"))
    heads = placed.groupBy("cluster").agg(
        F.min(F.struct("distance", spec.entity))[spec.entity].alias("_rep"))
    return placed.join(heads, "cluster").select(
        spec.entity, "cluster", "distance", (F.col("_rep") == F.col(spec.entity)).alias("representative"))


# --- normal equations -------------------------------------------------------------------

def gram_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], target: str) -> DataFrame:
    """Sums of products of (1, columns, target) per key: ``n`` and the packed upper triangle.

    Rows with an unknown value do not count; keys that have only such rows have no sums.
    """
    return _gram_sums(df.dropna(subset=[*columns, target]), keys, columns, target)


def _gram_sums(whole: DataFrame, keys: Sequence[str], columns: Sequence[str], target: str) -> DataFrame:
    one = F.when(F.col(target).isNotNull(), 1.0)
    terms = [one, *[F.col(c).cast("double") for c in columns], F.col(target).cast("double")]
    sums = [F.sum(terms[i] * terms[j]) for i in range(len(terms)) for j in range(i, len(terms))]
    return whole.groupBy(*keys).agg(F.count(target).alias("n"), F.array(*sums).alias("gram"))


def unpack(packed: np.ndarray, size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = packed
    return full + np.triu(full, 1).T


def solve(full: np.ndarray, use: Sequence[int], ridge: float = 0.0) -> tuple[np.ndarray, float]:
    """Coefficients of the used regressors and the squared error, target last in ``full``."""
    a, b, yy = full[np.ix_(use, use)], full[use, -1], full[-1, -1]
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    scaled = a / np.outer(scale, scale) + ridge * np.eye(len(use))
    beta = np.linalg.lstsq(scaled, b / scale, rcond=1e-10)[0] / scale
    return beta, max(float(yy - 2 * beta @ b + beta @ a @ beta), 0.0)


def _lagged(decomposed: DataFrame, exog: Sequence[str], depth: int, spec: PanelSpec,
            size: int) -> DataFrame:
    """Residual and regressors (d = 0) and their differences (d = 1), with ``depth`` lags of the residual.

    Two rows per step, d = 0 and 1.  All values are NULL, in both, unless ``depth + 1`` residuals before and the
    regressors at the step and the one before are known, so every order is fitted to the same steps.
    """
    w = slab_window([spec.entity], spec.idx)
    near = spread(decomposed.select(spec.entity, spec.idx, "resid", *exog), spec.idx, depth + 1, 0, size)
    steps = {f"_r{k}": F.lag("resid", k).over(w) if k else F.col("resid") for k in range(depth + 2)}
    steps |= {f"_x{j}": F.col(c).cast("double") for j, c in enumerate(exog)}
    steps |= {f"_w{j}": F.lag(F.col(c).cast("double")).over(w) for j, c in enumerate(exog)}
    wide = settle(near.select("*", *[s.alias(name) for name, s in steps.items()]), spec.idx, size)
    known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() & ~F.isnan(n) for n in steps])

    def level(d: int, z, x) -> Column:
        values = {f"z{k}": z(k) for k in range(depth + 1)} | {f"x{j}": x(j) for j in range(len(exog))}
        return F.struct(F.lit(d).alias("d"), *[F.when(known, v).alias(n) for n, v in values.items()])

    both = F.array(level(0, lambda k: F.col(f"_r{k}"), lambda j: F.col(f"_x{j}")),
                   level(1, lambda k: F.col(f"_r{k}") - F.col(f"_r{k + 1}"), lambda j: F.col(f"_x{j}") - F.col(f"_w{j}")))
    return wide.select(spec.entity, F.inline(both))


def fit_orders(decomposed: DataFrame, orders: Sequence[tuple[int, int]], exog: Sequence[str] = EXOG,
               spec: PanelSpec = PANEL, min_rows: int = 48, size: int = DEFAULT_SLAB) -> DataFrame:
    """A row for every entity and order: status, AIC, coefficients and the number of steps.

    All orders of an entity are fitted to the same ``n`` steps; with d = 1 the residual and the regressors are
    differenced.  ``status`` is ``fitted``, ``short`` (fewer than ``min_rows`` such steps) or ``failed`` (no finite
    solution); AIC and coefficients of the last two are NULL.
    """
    depth, m = max(p for p, _ in orders), len(exog)
    rows = _lagged(decomposed, exog, depth, spec, size)
    regressors = [*[f"z{k}" for k in range(1, depth + 1)], *[f"x{j}" for j in range(m)]]
    grams = _gram_sums(rows, [spec.entity, "d"], regressors, "z0")
    entity = spec.entity
    kind = decomposed.schema[entity].dataType.simpleString()

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for e, d, n, packed in zip(batch[entity], batch["d"], batch["n"], batch["gram"]):
                full = unpack(np.asarray(packed, dtype=float), 2 + depth + m) if n >= min_rows else None
                for i, (p, dd) in enumerate(orders):
                    if dd != d:
                        continue
                    if full is None:
                        out.append((e, i, p, dd, None, int(n), None, "short"))
                        continue
                    use = [0, *range(1, 1 + p), *range(1 + depth, 1 + depth + m)]
                    beta, sse = solve(full, use)
                    aic = n * np.log(max(sse, 1e-12) / n) + 2 * (len(use) + 1)
                    good = np.isfinite(aic) and np.all(np.isfinite(beta))
                    out.append((e, i, p, dd, float(aic), int(n), beta.tolist(), "fitted") if good
                               else (e, i, p, dd, None, int(n), None, "failed"))
            yield pd.DataFrame(out, columns=[entity, "order_id", "p", "d", "aic", "n", "coef", "status"])

    found = grams.mapInPandas(fit, f"{entity} {kind}, order_id int, p int, d int, aic double, n long, "
                                   "coef array<double>, status string")
    return found.withColumn("aic", F.nanvl("aic", F.lit(None).cast("double")))


def residual_paths(decomposed: DataFrame, fitted: DataFrame, future: DataFrame, horizon: int,
                   exog: Sequence[str] = EXOG, spec: PanelSpec = PANEL, depth: int = 3) -> DataFrame:
    """Recursive residual forecast of each fitted candidate over ``horizon`` steps.

    ``future`` has the regressors of the steps after the series; an unknown one keeps its last known value.  A
    candidate's input is its coefficients, ``depth + 1`` last residuals and ``horizon`` regressor rows.
    """
    known = decomposed.filter(F.col("resid").isNotNull())
    newest = Window.partitionBy(spec.entity).orderBy(F.col(spec.idx).desc())
    tail = (known.select(spec.entity, spec.idx, "resid").withColumn("_r", F.row_number().over(newest))
            .filter(F.col("_r") <= depth + 1).groupBy(spec.entity)
            .agg(F.sort_array(F.collect_list(F.struct(spec.idx, "resid")))["resid"].alias("state")))
    drivers = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in exog])
    last = decomposed.groupBy(spec.entity).agg(F.max(spec.idx).alias("_b"), F.max_by(drivers, spec.idx).alias("x0"))
    ahead = (rejoin(future, last.select(spec.entity, "_b"), [spec.entity], "inner").withColumn("step", F.col(spec.idx) - F.col("_b"))
             .filter((F.col("step") >= 1) & (F.col("step") <= horizon)))
    paths = (ahead.groupBy(spec.entity).agg(F.sort_array(F.collect_list(
        F.struct("step", drivers.alias("x")))).alias("_w"))
        .select(spec.entity, F.flatten(F.col("_w.x")).alias("xs"), F.col("_w.step").alias("steps")))
    joined = fitted.filter("status = 'fitted'").select(spec.entity, "order_id", "p", "d", "coef")
    for facts in (tail, last.select(spec.entity, "x0"), paths):
        joined = rejoin(joined, facts, [spec.entity], "inner")
    entity, m = spec.entity, len(exog)
    kind = decomposed.schema[entity].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for r in batch.itertuples(index=False):
                row = r._asdict() if entity.isidentifier() else dict(zip(batch.columns, r))
                parts.append(pd.DataFrame({
                    entity: row[entity], "order_id": row["order_id"], "step": row["steps"],
                    "resid_pred": walk(np.asarray(row["coef"]), int(row["p"]), int(row["d"]),
                                       np.asarray(row["state"], dtype=float),
                                       drive_rows(row["x0"], row["xs"], m, int(row["d"])))}))
            if parts:
                yield pd.concat(parts)

    return joined.mapInPandas(run, f"{entity} {kind}, order_id int, step int, resid_pred double")


def drive_rows(x0: np.ndarray, xs: np.ndarray, m: int, d: int) -> np.ndarray:
    """Regressors of the steps ahead, or their differences with d = 1; ``x0`` are those of the last known step."""
    rows = np.vstack([np.asarray(x0, dtype=float).reshape(1, m), np.asarray(xs, dtype=float).reshape(-1, m)])
    rows = pd.DataFrame(rows).ffill().bfill().fillna(0.0).to_numpy()
    return np.diff(rows, axis=0) if d else rows[1:]


def walk(coef: np.ndarray, p: int, d: int, state: np.ndarray, xs: np.ndarray) -> np.ndarray:
    """Feed predictions back as lags, step by step."""
    level = state[-1]
    lags = list((np.diff(state) if d else state)[-p:])
    drive = coef[0] + xs @ coef[1 + p:]
    out = np.empty(len(xs))
    for t in range(len(xs)):
        z = drive[t] + sum(coef[1 + k] * lags[-1 - k] for k in range(min(p, len(lags))))
        z = float(np.clip(z, -1e12, 1e12))
        lags.append(z)
        level = level + z if d else z
        out[t] = level
    return out


# --- search -----------------------------------------------------------------------------

def recent(df: DataFrame, steps: int, spec: PanelSpec = PANEL) -> DataFrame:
    """Rows within ``steps`` of the entity's last index."""
    last = df.groupBy(spec.entity).agg(F.max(spec.idx).alias("_b"))
    return df.join(last, spec.entity).filter(F.col(spec.idx) > F.col("_b") - steps).drop("_b")


def reach(past: DataFrame, future: DataFrame, spec: PanelSpec = PANEL) -> int:
    """The largest number of steps from the end of an entity's past to the end of its future, 1 at least."""
    ends = rejoin(past.groupBy(spec.entity).agg(F.max(spec.idx).alias("_b")),
                  future.groupBy(spec.entity).agg(F.max(spec.idx).alias("_e")), [spec.entity], "inner")
    return max(ends.agg(F.max(F.col("_e") - F.col("_b"))).first()[0] or 1, 1)


def candidate_search(train: DataFrame, val: DataFrame, orders: Sequence[tuple[int, int]] | None = None,
                     horizon: int | None = None, exog: Sequence[str] = EXOG, spec: PanelSpec = PANEL,
                     evaluation: EvalSpec = EVAL, tail: int | None = None,
                     size: int = DEFAULT_SLAB) -> DataFrame:
    """A row for every entity of ``train`` and order: AIC on the training rows, cost percent on validation, status.

    All steps of ``val`` are scored and all of ``train`` is read, unless ``horizon`` or ``tail``
    says fewer.  ``status`` is that of :func:`fit_orders`, or ``unscored`` where validation has no complete row.
    """
    orders = orders or orders_grid()
    dec = cut(decompose(recent(train, tail, spec) if tail else train, spec, size=size))
    horizon = horizon or reach(train, val, spec)
    fitted = cut(fit_orders(dec, orders, exog, spec, size=size))
    paths = residual_paths(dec, fitted, val, horizon, exog, spec, max(p for p, _ in orders))
    pred = recompose(dec, horizon, spec, residual=paths).filter(F.col("order_id").isNotNull())
    real = [F.col(spec.y).alias(evaluation.y), evaluation.dam, evaluation.sell, evaluation.buy]
    scored = rejoin(pred.drop(spec.ts), val.select(spec.entity, spec.idx, *real), [spec.entity, spec.idx], "inner").dropna(
        subset=[c for c in pred.columns if c not in (spec.ts, spec.entity)] + [evaluation.y, evaluation.dam, evaluation.sell, evaluation.buy])
    cost = scored.groupBy(spec.entity, "order_id").agg(money_pct(evaluation).alias("val_money_pct"))
    status = F.when((F.col("status") == "fitted") & F.col("val_money_pct").isNull(), "unscored").otherwise(F.col("status"))
    return rejoin(fitted.select(spec.entity, "order_id", "p", "d", "aic", "status"), cost,
                  [spec.entity, "order_id"]).withColumn("status", status)


def cluster_search(train: DataFrame, val: DataFrame, clusters: DataFrame, top: int = 5,
                   spec: PanelSpec = PANEL, **search) -> DataFrame:
    """Best order per cluster from its representative, given to all members; clusters without
    a result get the most common best order."""
    heads = clusters.filter("representative").select(spec.entity, "cluster")
    found = candidate_search(train.join(heads.select(spec.entity), spec.entity, "left_semi"),
                             val.join(heads.select(spec.entity), spec.entity, "left_semi"),
                             spec=spec, **search)
    best = cut(pick_orders(found.filter("status = 'fitted'").join(heads, spec.entity), "cluster", top)
               .select("cluster", "order_id", "p", "d", "aic", "val_money_pct"))
    return _with_fallback(clusters.select(spec.entity, "cluster"), best, "cluster")


def entity_search(train: DataFrame, val: DataFrame, top: int = 5, spec: PanelSpec = PANEL,
                  **search) -> DataFrame:
    """Two stages per entity: ``top`` orders by AIC, then cost; modal order as fallback."""
    found = candidate_search(train, val, spec=spec, **search)
    best = cut(pick_orders(found.filter("status = 'fitted'"), spec.entity, top).drop("status"))
    return _with_fallback(train.select(spec.entity).distinct(), best, spec.entity)


def _with_fallback(members: DataFrame, best: DataFrame, key: str) -> DataFrame:
    modal = most_common(best, [], "order_id", "order_id")
    usual = best.join(modal, "order_id", "left_semi").agg(
        F.first("order_id").alias("o"), F.first("p").alias("p"), F.first("d").alias("d"))
    joined = rejoin(members, best, [key])
    pick = lambda c, u: F.coalesce(c, usual.select(u).scalar()).alias(c)
    return joined.select(*members.columns, pick("order_id", "o"), pick("p", "p"), pick("d", "d"),
                         "aic", "val_money_pct", F.col("aic").isNull().alias("fallback"))


def common_order(train: DataFrame, first_n: int | None = None, orders: Sequence[tuple[int, int]] | None = None,
                 exog: Sequence[str] = EXOG, spec: PanelSpec = PANEL, tail: int | None = None,
                 size: int = DEFAULT_SLAB) -> DataFrame:
    """AIC only: for how many entities (all, or the first ones in order) each order is the best."""
    if first_n:
        some = train.select(spec.entity).distinct().orderBy(spec.entity).limit(first_n)
        train = train.join(some, spec.entity, "left_semi")
    dec = decompose(recent(train, tail, spec) if tail else train, spec, size=size)
    fitted = fit_orders(dec, orders or orders_grid(), exog, spec, size=size)
    w = Window.partitionBy(spec.entity).orderBy("aic", "order_id")
    best = fitted.filter("status = 'fitted'").withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    return best.groupBy("order_id", "p", "d").agg(F.count("*").alias("entities"))


def forecast_with_orders(train: DataFrame, future: DataFrame, chosen: DataFrame, horizon: int,
                         exog: Sequence[str] = EXOG, spec: PanelSpec = PANEL,
                         size: int = DEFAULT_SLAB,
                         orders: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """Decompose, fit the chosen order of each entity, forecast residuals, recompose.

    Every entity of ``train`` has ``horizon`` rows.  ``status`` is that of its fit, or ``not chosen``; without
    ``fitted`` the forecast is trend and season alone, and the mean where there are too few rows for those.
    """
    orders = orders or orders_grid()
    dec = cut(decompose(train, spec, size=size))
    mine = rejoin(fit_orders(dec, orders, exog, spec, size=size), chosen.select(spec.entity, "order_id"),
                  [spec.entity, "order_id"], "left_semi")
    fitted = cut(mine)
    paths = residual_paths(dec, fitted, future, horizon, exog, spec, max(p for p, _ in orders))
    path = recompose(dec, horizon, spec, residual=paths.drop("order_id"))
    return rejoin(path, fitted.select(spec.entity, "order_id", "status"), [spec.entity]).withColumn(
        "status", F.coalesce("status", F.lit("not chosen")))


def forecast_splits(train: DataFrame, val: DataFrame, test: DataFrame, chosen: DataFrame,
                    exog: Sequence[str] = EXOG, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB,
                    orders: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """Production in two steps: ``val`` is forecast from ``train``, ``test`` from both together.

    Rows as from :func:`forecast_with_orders`, with ``split``.
    """
    columns = [c for c in train.columns if c in val.columns]
    both = train.select(*columns).unionByName(val.select(*columns))
    parts = [forecast_with_orders(past, ahead, chosen, reach(past, ahead, spec), exog, spec, size, orders)
             .withColumn("split", F.lit(name)) for name, past, ahead in (("val", train, val), ("test", both, test))]
    return parts[0].unionByName(parts[1])
