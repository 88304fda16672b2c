"""Outlier scores on an embedding: isolation forest per class, and reconstruction error."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators import linear
from tallyloom.operators.ranks import locate_ranks
from tallyloom.operators.split import class_counts
from tallyloom.runtime import literal_table, materialise

SAMPLE = 256
PART_ROWS = 16_384


def _path_norm(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, depth: int, limit: int, rng: np.random.Generator, nodes: list) -> int:
    at = len(nodes)
    nodes.append((-1, 0.0, -1, -1, depth + _path_norm(len(x))))
    low, high = x.min(0), x.max(0)
    open_dims = np.flatnonzero(high > low)
    if depth >= limit or len(x) <= 1 or len(open_dims) == 0:
        return at
    dim = int(rng.choice(open_dims))
    cut = float(rng.uniform(low[dim], high[dim]))
    left = x[:, dim] <= cut
    nodes[at] = (dim, cut, _grow(x[left], depth + 1, limit, rng, nodes), _grow(x[~left], depth + 1, limit, rng, nodes), 0.0)
    return at


def _limit(rows: int) -> int:
    """Levels below the root that a tree of so many rows may have."""
    return math.ceil(math.log2(max(rows, 2)))


def _walk(tree: tuple, x: np.ndarray, levels: int) -> np.ndarray:
    """Path length of every row in a tree of at most ``levels`` levels below its root; a row that has met a leaf stays there."""
    dim, cut, left, right, length = tree
    here = np.arange(len(dim))
    end = dim < 0
    dim, kids = np.where(end, 0, dim), np.stack([np.where(end, here, right), np.where(end, here, left)], axis=1).ravel()
    flat, begins = x.ravel(), np.arange(len(x)) * x.shape[1]
    at = np.zeros(len(x), dtype=int)
    for _ in range(levels):
        at = kids[2 * at + (flat[begins + dim[at]] <= cut[at])]
    return length[at]


def isolation_forest_by_class(
    embedded: DataFrame, contamination: float, label: str = "category", trees: int = 200, min_rows: int = 30, seed: int = 42
) -> DataFrame:
    """Row ids of the share of each class that is isolated fastest; see ``isolation_forests_by_class``."""
    return isolation_forests_by_class(embedded, (contamination,), label, trees, min_rows, seed)[0]


def isolation_forests_by_class(
    embedded: DataFrame, contaminations: tuple[float, ...], label: str = "category", trees: int = 200, min_rows: int = 30, seed: int = 42
) -> list[DataFrame]:
    """Per contamination, row ids of that share of each class that is isolated fastest; classes under ``min_rows`` lose none.

    The forest and the rows' scores do not depend on the share, so all shares are cut from the same scores.

    Each tree grows on 256 rows drawn by hash from the whole class, or all of a smaller one. Rows are dealt to parts of about
    16,384 rows of one class, by hash, and each part meets a copy of its class's trees in the shuffle: no trees come to the
    driver, and a task holds one part and one class's trees. The cut per class is found by counting.
    """
    counts = {c: n for c, n in class_counts(embedded, label).items() if n >= min_rows}
    if not counts:
        return [embedded.select("row_id").limit(0) for _ in contaminations]
    sizes = literal_table(embedded.sparkSession, [{label: c, "_n": n, "_parts": -(-n // PART_ROWS)} for c, n in counts.items()], f"{label} string, _n long, _parts long")
    dice = lambda *of: F.pmod(F.xxhash64(*of), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = embedded.select("row_id", label, "embedding").join(sizes, label)
    ticket = lambda tree: dice(F.col("row_id"), tree, F.lit(seed))
    share = F.lit(1.6 * SAMPLE) / F.col("_n")  # more than enough rows of the whole class; the lowest tickets stay
    each = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))  # a row meets every tree in compiled code, and few stay
    grown = drawn.withColumn("tree", each).withColumn("_t", ticket(F.col("tree"))).where(F.col("_t") < share)
    rank = F.row_number().over(Window.partitionBy(label, "tree").orderBy("_t", "row_id"))
    grown = grown.withColumn("_rk", rank).where(F.col("_rk") <= SAMPLE)

    def plant(sample: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(sample.sort_values("_rk")["embedding"].to_numpy())
        tree = int(sample["tree"].iloc[0])
        nodes: list = []
        _grow(x, 0, _limit(len(x)), np.random.default_rng([seed, tree]), nodes)
        dim, cut, left, right, length = (list(v) for v in zip(*nodes))
        return pd.DataFrame([{label: sample[label].iloc[0], "tree": tree, "rows": len(x), "dim": dim, "cut": cut, "kid_a": left, "kid_b": right, "length": length}])

    schema = f"{label} string, tree int, rows int, dim array<int>, cut array<double>, kid_a array<int>, kid_b array<int>, length array<double>"
    forest = grown.select(label, "tree", "_rk", "embedding").groupBy(label, "tree").applyInPandas(plant, schema)
    copies = forest.join(sizes, label).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_n", "_parts")
    dealt = embedded.select("row_id", label, "embedding").join(sizes, label).withColumn("_part", F.pmod(F.xxhash64("row_id"), F.col("_parts"))).drop("_n", "_parts")

    def score(rows: pd.DataFrame, planted: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"row_id": [], label: [], "isolation": []})
        x = np.stack(rows["embedding"].to_numpy())
        planted = planted.sort_values("tree")
        stack = zip(*(planted[k] for k in ("dim", "cut", "kid_a", "kid_b", "length")))
        most = int(planted["rows"].max())
        length = np.mean([_walk(tuple(np.asarray(part) for part in tree), x, _limit(most)) for tree in stack], axis=0)
        norm = _path_norm(float(most))
        return pd.DataFrame({"row_id": rows["row_id"], label: rows[label], "isolation": 2.0 ** (-length / max(norm, 1e-12))})

    scored = dealt.groupBy(label, "_part").cogroup(copies.groupBy(label, "_part")).applyInPandas(score, f"row_id long, {label} string, isolation double")
    scored = materialise(scored, "isolation")
    groups = sorted(counts)
    # the cut is the interpolated (1 - contamination) quantile of the class's scores
    places = [{c: (counts[c] - 1) * (1.0 - contamination) for c in groups} for contamination in contaminations]
    targets = [(c, r) for own in places for c in groups for r in (int(own[c]), min(int(own[c]) + 1, counts[c] - 1))]
    found = iter(locate_ranks(scored, F.col("isolation"), targets, F.col(label)))
    isolated = []
    for own in places:
        cuts = []
        for c in groups:
            low, high = next(found).value, next(found).value
            cuts.append({label: c, "_cut": low + (high - low) * (own[c] - int(own[c]))})
        table = literal_table(embedded.sparkSession, cuts, f"{label} string, _cut double")
        isolated.append(scored.join(table, label).where(F.col("isolation") > F.col("_cut")).select("row_id", label, "isolation"))
    return isolated


def _moments(embedded: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, sum vector and Gram matrix; each task sends one small matrix."""

    def fold(batches):
        n, total, gram = 0, None, None
        for batch in batches:
            x = np.stack(batch["embedding"].to_numpy())
            n += len(x)
            total = x.sum(0) if total is None else total + x.sum(0)
            gram = x.T @ x if gram is None else gram + x.T @ x
        if n:
            yield pd.DataFrame({"i": np.arange(len(total) + 1), "row": [np.append(total, n).tolist()] + [np.append(g, 0.0).tolist() for g in gram]})

    parts = embedded.select("embedding").mapInPandas(fold, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    size = int(cells["j"].max())
    full = np.zeros((size + 1, size + 1))
    full[cells["i"], cells["j"]] = cells["v"]
    return int(full[0, size]), full[0, :size], full[1:, :size]


def linear_recon_error(train: DataFrame, *others: DataFrame, rank: int = 24) -> list[DataFrame]:
    """Mean squared error after keeping ``rank`` principal directions of the training embedding.

    This is what a linear autoencoder of that width converges to.
    """
    n, total, gram = _moments(train)
    mean = total / n
    values, vectors = np.linalg.eigh(gram / n - np.outer(mean, mean))
    keep = vectors[:, np.argsort(values)[::-1][:rank]]

    def run(batches):
        for batch in batches:
            x = np.stack(batch["embedding"].to_numpy()) - mean
            yield pd.DataFrame({"row_id": batch["row_id"], "recon_error": ((x - x @ keep @ keep.T) ** 2).mean(1)})

    return [df.select("row_id", "embedding").mapInPandas(run, "row_id long, recon_error double") for df in (train, *others)]


def _forward(x: np.ndarray, layers: list) -> list[np.ndarray]:
    acts = [x]
    for i, (w, b) in enumerate(layers):
        z = acts[-1] @ w + b
        acts.append(z if i == len(layers) - 1 else np.maximum(z, 0.0))
    return acts


#: Rows of one task in an epoch, at least.
EPOCH_ROWS = 16_384


class _Network:
    """Weights and running moments as one vector; ``learn`` takes Adam steps on mini-batches."""

    def __init__(self, shape: tuple[int, ...], rate: float, decay: float):
        self.shape, self.rate, self.decay = shape, rate, decay
        self.places, at = [], 0
        for a, b in zip(shape[:-1], shape[1:]):
            self.places.append((slice(at, at + a * b), slice(at + a * b, at + a * b + b), (a, b)))
            at += a * b + b
        self.size = at

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        flat = np.empty(self.size)
        for w, b, (rows, columns) in self.places:
            bound = math.sqrt(6.0 / (rows + columns))
            flat[w], flat[b] = rng.uniform(-bound, bound, rows * columns), rng.uniform(-bound, bound, columns)
        return flat

    def layers(self, flat: np.ndarray) -> list:
        return [(flat[w].reshape(shape), flat[b]) for w, b, shape in self.places]

    def gradient(self, flat: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        """(mean squared error, gradient of half the squared error per row) of a mini-batch."""
        layers, out = self.layers(flat), np.empty(self.size)
        acts = _forward(x, layers)
        delta = acts[-1] - x
        loss = float((delta * delta).mean())
        for i in range(len(layers) - 1, -1, -1):
            w, b, _ = self.places[i]
            out[w] = ((acts[i].T @ delta + self.decay * layers[i][0]) / len(x)).ravel()
            out[b] = delta.mean(axis=0)
            if i:
                delta = (delta @ layers[i][0].T) * (acts[i] > 0)
        return loss, out

    def learn(self, state: np.ndarray, step: int, x: np.ndarray) -> tuple[float, np.ndarray]:
        """(error before the step, state after it); a state is weights, first and second moments."""
        flat, first, second = state
        loss, g = self.gradient(flat, x)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        lr = self.rate * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        return loss, np.stack([flat - lr * first / (np.sqrt(second) + 1e-8), first, second])


def _epoch(net: _Network, begun: np.ndarray, steps: int, batch: int, seed: list[int]):
    """What a task does in an epoch: its rows, error and number of steps, and its state times its rows."""

    def learn(batches):
        now, at, seen, losses = begun, steps, 0, 0.0
        for part in batches:
            x = part.column(part.schema.get_field_index("embedding")).flatten().to_numpy().reshape(part.num_rows, net.shape[0])
            drawn = np.random.default_rng([*seed, seen]).permutation(len(x))
            for lo in range(0, len(x), batch):
                some = drawn[lo : lo + batch]
                at += 1
                loss, now = net.learn(now, at, x[some])
                losses += loss * len(some)
            seen += len(x)
        if seen:
            yield linear.chunked(np.concatenate([[seen, losses, (at - steps) * seen], now.ravel() * seen]))

    return learn


def autoencoder_recon_error(
    train: DataFrame, *others: DataFrame, hidden: tuple[int, ...] = (64, 24, 64), epochs: int = 120, rate: float = 1e-3, decay: float = 1e-4, seed: int = 42,
    batch: int = 200, tol: float = 1e-4, patience: int = 10,
) -> list[DataFrame]:
    """Mean squared reconstruction error of a small ReLU network trained on the embedding itself.

    An epoch is one pass: every task takes an Adam step per mini-batch of its rows, in an order drawn from the
    epoch, and the tasks' weights and moments are averaged by their rows. A task has ``EPOCH_ROWS`` rows or more, so a
    small table is learnt as on one machine. Training ends after ``epochs``, or once ``patience`` of them have not
    brought the mean error down by ``tol``. The driver holds some ten thousand weights.
    """
    stored = materialise(train.select("row_id", "embedding"), "embedded")
    n = stored.count()
    if not n:
        raise ValueError("no rows to train on")
    rows = stored.coalesce(max(1, -(-n // EPOCH_ROWS))).persist()
    size = len(stored.first()["embedding"])
    net = _Network((size, *hidden, size), rate, decay)
    state, steps, best, waited = np.stack([net.start(seed), np.zeros(net.size), np.zeros(net.size)]), 0, math.inf, 0
    for epoch in range(epochs):
        learn = _epoch(net, state, steps, batch, [seed, epoch])
        found = linear.total(rows.mapInArrow(learn, linear.CHUNKED), rows.rdd.getNumPartitions(), 3 + 3 * net.size)
        state, steps = found[3:].reshape(3, -1) / found[0], steps + int(round(found[2] / found[0]))
        loss = found[1] / found[0] / 2
        waited = 0 if loss < best - tol else waited + 1
        best = min(best, loss)
        if waited >= patience:
            break
    rows.unpersist()
    final = net.layers(state[0])

    def run(batches):
        for part in batches:
            x = np.stack(part["embedding"].to_numpy())
            yield pd.DataFrame({"row_id": part["row_id"], "recon_error": ((x - _forward(x, final)[-1]) ** 2).mean(1)})

    return [df.select("row_id", "embedding").mapInPandas(run, "row_id long, recon_error double") for df in (train, *others)]
