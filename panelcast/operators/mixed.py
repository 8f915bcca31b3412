"""Mixed-effects logistic regression as a few passes over packed groups.

Model: logit P(y=1) = b0 + sum_k u[g, k] * x_k with a fixed intercept b0 and
random slopes u[g] ~ N(0, D) per group g (the disease).  D is diagonal but
for one optional block of correlated slopes (the continent levels) - the
shape of ``y ~ (0 + x1 | g) + ... + (0 + continent | g)``.  As in the
reference, intercept and slopes are the joint mode for given D, and D
minimises the Laplace deviance at that mode.

The (weight-compressed) design is packed once: blocks of rows of one group as
dense arrays.

- A *design pass* joins each block (not each row) with its group's slopes and
  sums, vectorised and combined inside the task, one packed vector a group:
  X'WX, X'(y - p), the likelihood, the derivative of the log-determinant, and
  the likelihood at shorter steps, so that a group whose step was too long goes
  back on its own.
- These vectors are a quadratic model of every group's likelihood.  While the
  mode still moves, intercept and slopes take their joint Newton step.  At the
  mode, *state passes* over one row a group maximise the Laplace likelihood of
  the quadratic models over D: Fisher scoring of the Cholesky factor with
  Levenberg damping, the score including the dependence of the weights on the
  mode.  The k x k systems are solved on the executors; only totals over all
  groups reach the driver.

The fit has converged when the likelihood that either kind of step still
promises is small.  A constant predictor carries no information: it gets
slope and variance 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import title_from_snake
from ..session import drop_stage, write_stage


@dataclass
class MixedLogitFit:
    group_col: str
    predictors: list[str]
    intercept: float
    slope_frame: DataFrame  # (group, u): slopes in the order of ``predictors``
    covariance: np.ndarray
    block: list[str]
    loglik_conditional: float
    loglik_laplace: float
    n_obs: float
    iterations: int
    converged: bool
    constant: list[str] = field(default_factory=list)
    history: list = field(default_factory=list)

    @property
    def variances(self) -> np.ndarray:
        return np.diag(self.covariance)

    @property
    def n_params(self) -> int:
        """Intercept, one variance per independent slope, the block's covariances."""
        b = len(self.block)
        return 1 + len(self.predictors) - b + b * (b + 1) // 2

    def aic(self) -> float:
        return -2 * self.loglik_laplace + 2 * self.n_params

    def bic(self) -> float:
        return -2 * self.loglik_laplace + self.n_params * float(np.log(self.n_obs))

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """Long table (group, variable, coef) incl. the fixed intercept, with names as text."""
        fixed = spark.range(1).select(
            F.lit("(fixed)").alias(self.group_col), F.lit("(Intercept)").alias("variable"),
            F.lit(float(self.intercept)).alias("coef"))
        names = F.array(*[F.lit(v) for v in self.predictors])
        slopes = self.slope_frame.select(self.group_col, F.explode(F.arrays_zip(names.alias("v"), F.col("u").alias("u"))).alias("s"))
        every = fixed.unionByName(slopes.select(self.group_col, F.col("s.v").alias("variable"), F.col("s.u").alias("coef")))
        return every.withColumns({
            "variable_clean": F.regexp_replace(F.regexp_replace("variable", "_from_outbreaks$", ""), "_", " "),
            f"{self.group_col}_clean": title_from_snake(F.regexp_replace(self.group_col, "/", "_"))})

    def variance_table(self, spark: SparkSession) -> DataFrame:
        rows = [(v, float(s)) for v, s in zip(self.predictors, self.variances)]
        return spark.createDataFrame(rows, "variable string, variance double")

    def summary(self, spark: SparkSession) -> DataFrame:
        """logLik (Laplace), AIC, BIC, deviance, parameters, iterations."""
        return spark.createDataFrame(
            [(float(self.loglik_laplace), float(self.aic()), float(self.bic()),
              float(-2 * self.loglik_laplace), int(self.n_params), float(self.n_obs),
              int(self.iterations), bool(self.converged))],
            "loglik double, aic double, bic double, deviance double, n_params int, "
            "n_obs double, iterations int, converged boolean",
        )


def predict(df: DataFrame, fit: MixedLogitFit, out_col: str = "predicted_outbreak_probability"):
    """Probability; null where a predictor is null (incomplete row).

    A group without slopes is predicted from the intercept alone.
    """
    slopes = fit.slope_frame.select(F.col(fit.group_col).alias("_g"), F.col("u").alias("_u"))
    j = df.join(slopes, F.col(fit.group_col).cast("string") == F.col("_g"), "left")
    eta = F.lit(float(fit.intercept))
    complete = F.lit(True)
    for i, v in enumerate(fit.predictors):
        eta = eta + F.coalesce(F.col("_u")[i], F.lit(0.0)) * F.col(v).cast("double")
        complete = complete & F.col(v).isNotNull()
    return j.withColumn(out_col, F.when(complete, 1 / (1 + F.exp(-eta)))).drop("_g", "_u")


BLOCK_ROWS = 1 << 13  # rows of one group in a packed block
SHORTER = (0.5, 0.2, 0.04)  # steps tried beside the whole one
TRIED = 3  # dampings whose steps are judged in one pass over the groups
FLOOR = 1e-6  # added to the variances: keeps D invertible
_BLOCKS = "g string, n long, x binary, y binary, w binary"
_PLAN = "g string, u array<double>, d array<double>, v array<double>"
_SUMS = "g string, u array<double>, d array<double>, sums array<double>"
_STATE = "g string, u array<double>, back array<double>, sums array<double>"


def _pack(most: int):
    """Blocks of rows of one group; rows come sorted by group."""
    def run(batches):
        for pdf in batches:
            for g, rows in pdf.groupby("g", sort=False):
                for a in range(0, len(rows), most):
                    part = rows.iloc[a : a + most]
                    x = np.array(part["x"].tolist(), dtype=float).reshape(len(part), -1)
                    yield pd.DataFrame({
                        "g": [g], "n": [len(part)], "x": [x.tobytes()], "y": [part["y"].to_numpy(float).tobytes()],
                        "w": [part["w"].to_numpy(float).tobytes()]})

    return run


# ---- design pass -------------------------------------------------------------------------
def _loglik(eta, y, w0):
    return -float((w0 * np.logaddexp(0.0, np.where(y > 0.5, -eta, eta))).sum())


def _block_sums(row, k: int, b0: float) -> np.ndarray:
    x, y, w0 = (np.frombuffer(c) for c in (row.x, row.y, row.w))
    x = x.reshape(len(y), k)
    from_eta, step = b0 + x @ np.asarray(row.u, dtype=float), x @ np.asarray(row.d, dtype=float)
    eta = from_eta + step
    p = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
    r, w = w0 * (y - p), w0 * p * (1 - p)
    wx = x * w[:, None]
    leverage = ((x @ np.asarray(row.v, dtype=float).reshape(k, k)) * x).sum(axis=1)
    bend = w * (1 - 2 * p) * leverage  # derivative of the log-determinant along the linear predictor
    scalars = [r.sum(), w.sum(), bend.sum(), _loglik(eta, y, w0), *(_loglik(from_eta + a * step, y, w0) for a in SHORTER)]
    return np.concatenate([(x.T @ wx).reshape(-1), x.T @ r, wx.sum(axis=0), x.T @ bend, scalars])


def _pass(k: int, b0: float, held: int = 4096):
    """Packed sums of each group's blocks, combined inside the task."""
    def run(batches):
        found: dict = {}

        def flush():
            return pd.DataFrame([(g, u, d, sums.tolist()) for g, (u, d, sums) in found.items()], columns=["g", "u", "d", "sums"])

        for pdf in batches:
            for row in pdf.itertuples(index=False):
                sums = _block_sums(row, k, b0)
                if row.g in found:
                    found[row.g][2][:] += sums
                else:
                    found[row.g] = (row.u, row.d, sums)
            if len(found) >= held:
                yield flush()
                found.clear()
        if found:
            yield flush()

    return run


def _settle(precision: np.ndarray):
    """The group's state at the whole step, and the way back where a shorter one was better."""
    def settle(pdf):
        sums = np.sum(np.array(pdf["sums"].tolist()), axis=0)
        u, d = (np.asarray(pdf[c].iloc[0], dtype=float) for c in ("u", "d"))
        steps = (1.0, *SHORTER)
        worth = [sums[i - len(steps)] - 0.5 * (u + a * d) @ precision @ (u + a * d) for i, a in enumerate(steps)]
        best = int(np.argmax(worth))
        keep = worth[0] >= worth[best] - 1e-9 * (1 + abs(worth[best]))
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "u": [u + d], "back": [None if keep else (steps[best] - 1) * d], "sums": [sums]})

    return settle


# ---- state pass --------------------------------------------------------------------------
@dataclass
class _Group:
    """Quadratic model of a group's likelihood at slopes u: H, gradient and terms of the intercept."""

    u: np.ndarray
    h: np.ndarray
    grad: np.ndarray
    cross: np.ndarray
    bend: np.ndarray
    g0: float
    h0: float
    t0: float
    ll: float

    @classmethod
    def of(cls, u, sums, k: int) -> _Group:
        sums = np.asarray(sums, dtype=float)
        rest = sums[k * k :]
        return cls(np.asarray(u, dtype=float), sums[: k * k].reshape(k, k), rest[:k], rest[k : 2 * k], rest[2 * k : 3 * k], *rest[3 * k : 3 * k + 4])

    def posterior(self, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slopes at the mode without a step of the intercept, and the posterior covariance."""
        v = cov @ np.linalg.inv(np.eye(len(cov)) + self.h @ cov)
        v = (v + v.T) / 2
        return v @ (self.grad + self.h @ self.u), v


#: Totals of a state pass: scalars, then k x k matrices, then the information of the free entries of D.
_SCALARS = ["groups", "back", "num", "den", "t0", "bend_t", "c0", "c1", "c2", "gain", "ll", "g0"]
_MATRICES = ["qaqa", "qaqt", "qtqt", "raqa", "raqt", "marginal"]


def _summer(k: int, basis: np.ndarray, covs: list[np.ndarray]):
    """Share of the rows of a task in the totals at each covariance."""
    precisions = [np.linalg.inv(cov) for cov in covs]

    def group(row, m: _Group, cov: np.ndarray, precision: np.ndarray) -> np.ndarray:
        a, v = m.posterior(cov)
        t = v @ m.cross
        z = m.grad + m.h @ m.u
        # slopes a - delta t; q is D^-1 times them
        qa, qt, ra = z - m.h @ a, m.cross - m.h @ t, m.bend - m.h @ (v @ m.bend)
        marginal = m.h - m.h @ v @ m.h  # (D + H^-1)^-1
        marginal = (marginal + marginal.T) / 2
        da = a - m.u
        logdet = np.linalg.slogdet(np.eye(k) + m.h @ cov)[1]
        c0 = m.ll + m.grad @ da - 0.5 * da @ m.h @ da - 0.5 * a @ qa - 0.5 * logdet - 0.5 * m.bend @ da
        c1 = (m.g0 - m.cross @ da) - m.grad @ t + da @ m.h @ t + 0.5 * (a @ qt + t @ qa) + 0.5 * (m.bend @ t - m.t0)
        c2 = -0.5 * m.h0 + m.cross @ t - 0.5 * t @ m.h @ t - 0.5 * t @ qt
        slope = m.grad - precision @ m.u
        turned = marginal @ basis
        scalars = [1.0, float(row.back is not None), m.g0 - m.cross @ da, m.h0 - m.cross @ t, m.t0, m.bend @ t, c0, c1, c2,
                   slope @ v @ slope, m.ll, m.g0]
        return np.concatenate([
            scalars, *(np.outer(x, y).reshape(-1) for x, y in ((qa, qa), (qa, qt), (qt, qt), (ra, qa), (ra, qt))), marginal.reshape(-1),
            np.einsum("aij,bji->ab", turned, turned).reshape(-1)])

    def run(batches):
        total = None
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                m = _Group.of(row.u, row.sums, k)
                part = np.concatenate([group(row, m, *at) for at in zip(covs, precisions)])
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"totals": [total]})

    return run


class _Totals:
    """Objective, score and information of the quadratic models at a covariance."""

    @classmethod
    def of(cls, state: DataFrame, k: int, basis: np.ndarray, covs: list[np.ndarray]) -> list[_Totals]:
        """The totals at each covariance, from one pass over the state."""
        parts = state.select("u", "back", "sums").mapInPandas(_summer(k, basis, covs), "totals array<double>")
        rows = parts.collect()  # a row per task; its length depends on the number of predictors only
        every = np.sum([r["totals"] for r in rows], axis=0).reshape(len(covs), -1)
        return [cls(share, k, basis) for share in every]

    def __init__(self, every: np.ndarray, k: int, basis: np.ndarray):
        self.scalar = dict(zip(_SCALARS, every))
        rest, f = every[len(_SCALARS) :], len(basis)
        m = {name: rest[i * k * k : (i + 1) * k * k].reshape(k, k) for i, name in enumerate(_MATRICES)}
        c = self.scalar
        den = max(c["den"], 1e-12)
        delta, kappa = c["num"] / den, (c["t0"] - c["bend_t"]) / den
        self.delta = delta
        self.objective = c["c0"] + c["c1"] * delta + c["c2"] * delta**2
        self.moved = 0.5 * (c["gain"] + delta**2 * den)
        qq = m["qaqa"] - delta * (m["qaqt"] + m["qaqt"].T) + delta**2 * m["qtqt"]
        pull = m["raqa"] - delta * m["raqt"] - kappa * (m["qaqt"].T - delta * m["qtqt"])
        self.score = 0.5 * np.einsum("aij,ij->a", basis, qq - m["marginal"] - (pull + pull.T) / 2)
        self.info = 0.5 * rest[len(_MATRICES) * k * k :].reshape(f, f)


def _jacobian(factor: np.ndarray, free: list) -> np.ndarray:
    """Change of the free entries of D = L L' with the same entries of L (row >= column)."""
    out = np.zeros((len(free), len(free)))
    for j, (a, b) in enumerate(free):
        change = np.zeros_like(factor)
        change[b] = factor[:, a]  # entry (b, a) of L, b >= a
        change = change + change.T
        out[:, j] = [change[x, y] for x, y in free]
    return out


def _curvature(score: np.ndarray, free: list, k: int) -> np.ndarray:
    """Curvature of D = L L' itself where the likelihood falls with D: what ends a factor entry at zero."""
    gradient = np.zeros((k, k))
    for (a, b), x in zip(free, score):
        gradient[a, b] = gradient[b, a] = x if a == b else x / 2
    values, vectors = np.linalg.eigh(gradient)
    falling = (vectors * np.minimum(values, 0.0)) @ vectors.T
    return np.array([[-2 * falling[b, d] if a == c else 0.0 for c, d in free] for a, b in free])


def _best_covariance(evaluate, factor: np.ndarray, here: _Totals, free: list, tol: float, rounds: int = 12):
    """Levenberg-damped Fisher scoring of the factor; returns it with its totals and the first step's promise."""
    cov_of = lambda f: f @ f.T + FLOOR * np.eye(len(f))
    damping, first = 1e-3, None
    for _ in range(rounds):
        j = _jacobian(factor, free)
        score, info = j.T @ here.score, j.T @ here.info @ j + _curvature(here.score, free, len(factor))
        scale = np.diag(info) + 1e-3 * np.abs(score) + 1e-8
        tries = []
        for i in range(8):
            step = np.linalg.solve(info + damping * 10**i * np.diag(scale), score)
            promise = float(score @ step - 0.5 * step @ info @ step)
            first = promise if first is None else first
            if promise <= tol:
                break
            tried = factor.copy()
            for (a, b), x in zip(free, step):
                tried[b, a] += x
            tries.append((damping * 10**i, tried))
        better = None
        for several in (tries[:TRIED], tries[TRIED:]):  # the shortest damping that gains, each several from one pass
            found = evaluate([cov_of(tried) for _, tried in several]) if several and better is None else []
            gains = ((d, tried, there) for (d, tried), there in zip(several, found) if there.objective > here.objective + 0.1 * tol)
            better = better or next(gains, None)
        if better is None:
            break
        damping, factor, here = better[0] / 5, better[1], better[2]
    return factor, here, (first or 0.0)


def _planner(k: int, cov: np.ndarray, delta: float):
    """Slopes from which the next design pass steps, and the step."""
    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                m = _Group.of(row.u, row.sums, k)
                a, v = m.posterior(cov)
                if row.back is not None:
                    out.append((row.g, m.u + np.asarray(row.back, dtype=float), np.zeros(k), v.reshape(-1)))
                    continue
                d = a - delta * (v @ m.cross) - m.u
                out.append((row.g, m.u, d, v.reshape(-1)))
            yield pd.DataFrame(out, columns=["g", "u", "d", "v"])

    return run


def fit_mixed_logit(
    design: DataFrame,
    predictors: list[str],
    y_col: str = "outbreak_start",
    group_col: str = "disease",
    weight_col: str | None = "count",
    block: list[str] | None = None,
    max_iter: int = 60,
    tol: float = 1e-3,
    variance_tol: float = 2e-5,
) -> MixedLogitFit:
    """Joint mode of intercept and slopes at the covariance of the greatest Laplace likelihood; see module doc.

    ``block`` names the predictors whose slopes are correlated.  Rows with a
    null group, outcome, weight or predictor are left out; a design without
    other rows raises.  The fit ends when the mode's next step promises ``tol`` of
    log-likelihood at most and the variances' ``variance_tol`` of its size;
    ``max_iter`` counts design passes.
    """
    block = list(block or [])
    base = design.select(
        F.col(group_col).cast("string").alias("g"), F.col(y_col).cast("double").alias("_y"),
        (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias("_w0"),
        *[F.col(v).cast("double").alias(f"_x{i}") for i, v in enumerate(predictors)],
    ).dropna()
    spread = [F.max(f"_x{i}") - F.min(f"_x{i}") for i in range(len(predictors))]
    tot = base.agg(F.sum("_w0").alias("n"), F.sum(F.col("_w0") * F.col("_y")).alias("s"),
                   *[e.alias(f"d{i}") for i, e in enumerate(spread)]).first()
    n_obs, n_pos = float(tot["n"] or 0.0), float(tot["s"] or 0.0)
    if n_obs == 0:
        raise ValueError("empty design")
    live = [i for i in range(len(predictors)) if tot[f"d{i}"]]
    k = len(live)
    blocked = [j for j, i in enumerate(live) if predictors[i] in block]
    free = [(a, b) for a in range(k) for b in range(a, k) if a == b or (a in blocked and b in blocked)]
    basis = np.zeros((len(free), k, k))
    for i, (a, b) in enumerate(free):
        basis[i, a, b] = basis[i, b, a] = 1.0
    x = F.array(*[F.col(f"_x{i}") for i in live]).cast("array<double>")
    rows = base.select("g", x.alias("x"), F.col("_y").alias("y"), F.col("_w0").alias("w")).sortWithinPartitions("g")
    blocks = write_stage(rows.mapInPandas(_pack(BLOCK_ROWS), _BLOCKS), "mixed_blocks")
    p0 = min(max(n_pos / n_obs, 1e-6), 1 - 1e-6)
    b0, factor = float(np.log(p0 / (1 - p0))), np.sqrt(0.5) * np.eye(k)
    cov = factor @ factor.T + FLOOR * np.eye(k)
    zeros = [F.array(*[F.lit(0.0)] * n).cast("array<double>").alias(c) for n, c in ((k, "u"), (k, "d"), (k * k, "v"))]
    plan, state, history, converged = blocks.select("g").distinct().select("g", *zeros), None, [], False
    best, share = (factor, -np.inf), 1.0  # best factor and its likelihood; share of the models' step that is taken
    for it in range(1, max_iter + 1):
        sums = blocks.join(F.broadcast(plan), "g").mapInPandas(_pass(k, b0), _SUMS)  # a row a group, as coefficient tables
        before, state = state, write_stage(sums.groupBy("g").applyInPandas(_settle(np.linalg.inv(cov)), _STATE), "mixed_state")
        if before is not None:
            drop_stage(before)
        here = _Totals.of(state, k, basis, [cov])[0]
        still = here.scalar["back"] == 0 and here.moved <= 0.05 + 1e-3 * abs(here.scalar["ll"])
        promise, laplace, delta = float("nan"), here.objective, here.delta
        if still and k and laplace < best[1] - tol:  # the models promised too much: half way back
            factor, share = (best[0] + factor) / 2, share / 2
        elif still and k:
            best, share = (factor, laplace), min(1.0, 2 * share)
            found, totals, promise = _best_covariance(lambda covs: _Totals.of(state, k, basis, covs), factor, here, free, 0.1 * tol)
            converged = here.moved <= tol and promise <= variance_tol * (1 + abs(laplace))
            if not converged:
                factor = factor + share * (found - factor)
                delta = totals.delta if share == 1.0 else delta
        if not converged:
            cov = factor @ factor.T + FLOOR * np.eye(k)
        history.append((it, float(here.scalar["ll"]), float(laplace), float(here.moved), float(promise)))
        if converged or it == max_iter:
            break
        delta = float(np.clip(delta, -2.0, 2.0))
        b0 += delta
        plan = state.mapInPandas(_planner(k, cov, delta), _PLAN)
    drop_stage(blocks)
    place = {i: j for j, i in enumerate(live)}
    whole = F.array(*[F.col("u")[place[i]] if i in place else F.lit(0.0) for i in range(len(predictors))]).cast("array<double>")
    full = np.zeros((len(predictors), len(predictors)))
    full[np.ix_(live, live)] = cov
    return MixedLogitFit(
        group_col, list(predictors), b0, state.select(F.col("g").alias(group_col), whole.alias("u")), full,
        [predictors[live[j]] for j in blocked], float(here.scalar["ll"]), float(laplace), n_obs, it, bool(converged),
        [predictors[i] for i in range(len(predictors)) if i not in place], history)


# ---- persistence (A7) --------------------------------------------------------------------
def save_fit(fit: MixedLogitFit, spark: SparkSession, path: str) -> None:
    """Slopes, covariance and fit metadata as Parquet tables (any Hadoop URI)."""
    fit.slope_frame.write.mode("overwrite").parquet(f"{path}/slopes")
    meta = [(fit.group_col, list(fit.predictors), float(fit.intercept), fit.covariance.reshape(-1).tolist(), list(fit.block),
             float(fit.loglik_conditional), float(fit.loglik_laplace), float(fit.n_obs), int(fit.iterations),
             bool(fit.converged), list(fit.constant))]
    spark.createDataFrame(
        meta, "group_col string, predictors array<string>, intercept double, covariance array<double>, block array<string>, "
              "ll_cond double, ll_lap double, n_obs double, iterations int, converged boolean, constant array<string>",
    ).write.mode("overwrite").parquet(f"{path}/meta")


def load_fit(spark: SparkSession, path: str) -> MixedLogitFit:
    m = spark.read.parquet(f"{path}/meta").first()
    k = len(m["predictors"])
    return MixedLogitFit(
        m["group_col"], list(m["predictors"]), m["intercept"], spark.read.parquet(f"{path}/slopes"),
        np.array(m["covariance"]).reshape(k, k), list(m["block"]), m["ll_cond"], m["ll_lap"], m["n_obs"],
        m["iterations"], m["converged"], list(m["constant"]))
