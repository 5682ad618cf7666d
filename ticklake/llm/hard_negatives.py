"""Hard negatives by threshold joins over a pruned inverted index.

An anchor's positives are its best rows of the same label; for each of them the
negatives are the best rows of other labels whose score lies in a window below
the positive's.  Both are threshold joins: which rows have an inner product of
at least t with an anchor?  (After L2AP, Anastasiu and Karypis, 2014.)

Dimensions go from high to low energy, in groups.  A row is indexed only under
its first groups: where the norm of what is left of it, times that of what is
left of any anchor, stays under the threshold, the rest is omitted, since it
alone can't reach it.  Partial scores are accumulated group by group over the
postings, and a pair goes as soon as its partial score and the product of the
remaining norms stay under the threshold.  What survives gets its exact score.

Thresholds begin just under the window's upper end and are lowered until the
window is full or they reach its lower end; what a task has kept so far lifts
that lower end for its later rows.  Anchors are broadcast, as many as fit a
byte budget, and meet all rows, which stay where they are.  A task returns the
best of its rows for each window, and these are ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import Work, staged
from ticklake.llm.topk import products

#: Bytes of anchors and their windows that are broadcast in one scan of the rows.
SCAN_BYTES = 32 << 20
#: Dimensions in the first two groups (each later one doubles them), rows and anchors that are compared at once.
GROUP, ROWS, ANCHORS = 16, 4096, 256
#: Of so many pairs at most one is left: exact scores at once.
SPARSE = 64
#: Thresholds tried before a window's lower end, as shares of its upper end.
TRIES = (0.95, 0.8)
FLOOR, TOP = -(1 << 63), (1 << 63) - 1


class Index:
    """Postings of a block of rows (float64 integers, n x d) for joins with
    the anchors at thresholds of at least `least` (one for each anchor)."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, least: np.ndarray):
        order = np.argsort(-(rows * rows).sum(axis=0), kind="stable")
        cuts = [0, GROUP]
        while cuts[-1] < len(order):
            cuts.append(2 * cuts[-1])
        self.groups = [order[a:b] for a, b in zip(cuts, cuts[1:])]
        self.rows, self.anchors = rows, anchors
        row_rest, anchor_rest = self._rest(rows), self._rest(anchors)
        # groups of each row that are indexed: the first at whose end all that is left can't reach a threshold
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(least[:, None] > 0, anchor_rest / least[:, None], np.inf).max(axis=0)
            left = np.where(row_rest == 0, 0.0, row_rest * share[None, :]) * (1 + 1e-6)
        self.indexed = np.minimum((left >= 1).sum(axis=1), len(self.groups))
        # the rows of a posting are the first in this order; partial scores are single precision, with slack
        self.order = np.argsort(-self.indexed, kind="stable")[: np.count_nonzero(self.indexed)]
        self.postings = [np.count_nonzero(self.indexed > g) for g in range(len(self.groups))]
        self.parts = [rows[np.ix_(self.order[:n], dims)].astype(np.float32) for n, dims in zip(self.postings, self.groups)]
        self.row_rest, self.anchor_rest = row_rest[self.order].astype(np.float32), anchor_rest.astype(np.float32)
        self.slack = np.float32(2e-7 * (len(order) + 8))

    def _rest(self, vectors: np.ndarray) -> np.ndarray:
        """Norm of what is left of each vector from each group on."""
        parts = np.stack([(vectors[:, g] ** 2).sum(axis=1) for g in self.groups], axis=1)
        rest = np.sqrt(np.cumsum(parts[:, ::-1], axis=1)[:, ::-1])
        return np.concatenate([rest, np.zeros((len(vectors), 1))], axis=1)

    def join(self, which: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (anchor, row, score) of the anchors `which` with a score of at
        least `least` (one for each of them) where `allowed` (a row for each)."""
        anchors, rest = self.anchors[which], self.anchor_rest[which]
        at = np.arange(len(self.order))  # rows that are left, in the order of the postings
        alive = allowed[:, self.order]
        scores = np.zeros(alive.shape, np.float32)
        goal = (least - 1e-6 * np.abs(least) - 1).astype(np.float32)[:, None]
        found = []
        for g, (posting, part) in enumerate(zip(self.postings, self.parts)):
            n = np.searchsorted(at, posting)
            found.append((at[n:], alive[:, n:]))  # not under this group: what is left can't decide
            at, alive, scores = at[:n], alive[:, :n], scores[:, :n]
            kept = alive.any(axis=0)
            if 2 * np.count_nonzero(kept) < n:
                at, alive, scores = at[kept], alive[:, kept], scores[:, kept]
            if not len(at):
                break
            scores += anchors[:, self.groups[g]].astype(np.float32) @ part[at].T
            left = (rest[:, g + 1, None] + self.slack * rest[:, :1]) * (self.row_rest[None, at, g + 1] + self.slack * self.row_rest[None, at, 0])
            left += self.slack * rest[:, :1] * self.row_rest[None, at, 0]
            alive &= scores + left >= goal
            if SPARSE * np.count_nonzero(alive) < alive.size:
                break
        found.append((at, alive))
        pairs = [np.nonzero(mask) for _, mask in found]
        a = np.concatenate([p for p, _ in pairs])
        x = np.concatenate([self.order[rows[q]] for (rows, _), (_, q) in zip(found, pairs)])
        score = products(anchors, self.rows, a, x)
        enough = score >= (least - 1e-9 * np.abs(least))[a]  # callers compare integers
        return which[a[enough]], x[enough], score[enough]


class _Windows:
    """For anchors of one dimension (m) and w windows each, with scores from
    `low` to `high` (m x w; none if low > high): the k best rows so far."""

    def __init__(self, ids, labels, own, vectors, low, high, same_label: bool, k: int):
        self.ids, self.labels, self.own, self.vectors = ids, labels, own, vectors
        self.low, self.high, self.same, self.k = low, high, same_label, k
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.least = low.copy()  # score to reach: the k-th so far
        self.full = np.zeros(low.shape, bool)  # there is a k-th
        self.kept = pd.DataFrame({c: np.empty(0, np.int64) for c in ("anchor", "window", "score", "id", "row")})

    def add(self, ids: np.ndarray, labels: np.ndarray, places: np.ndarray, rows: np.ndarray) -> None:
        found = [self.kept]
        for at in range(0, len(self.ids), ANCHORS):
            found += self._block(slice(at, at + ANCHORS), ids, labels, places, rows)
        self._keep(pd.concat(found, ignore_index=True))

    def _block(self, part: slice, ids, labels, places, rows) -> list[pd.DataFrame]:
        low, high = self.least[part], self.high[part]
        # no score is larger than the product of the norms; windows end there
        longest = float(np.sqrt((rows * rows).sum(axis=1)).max(initial=0.0))
        top = np.minimum(high.astype(float), (self.norms[part] * longest)[:, None])
        todo = (low <= high) & (low.astype(float) <= top * (1 + 1e-9) + 1)
        if not todo.any():
            return []
        allowed = (self.labels[part, None] == labels[None, :]) == self.same
        allowed &= self.own[part, None] != places[None, :]
        lowest = np.where(todo, low.astype(float), np.inf).min(axis=1)
        index = Index(rows, self.vectors[part], lowest)
        out, before = [], np.full(low.shape, np.inf)
        for share in (*TRIES, None):
            least = low.astype(float)
            if share is not None:  # a window that has been full before is joined once
                least = np.where(self.full[part], least, np.maximum(least, np.where(top > 0, share * top, top)))
            tried = np.where(todo, least, np.inf).min(axis=1)
            which = np.flatnonzero(tried < np.inf)
            if not len(which):
                break
            anchor, x, score = index.join(which, tried[which], allowed[which])
            for w in range(low.shape[1]):
                asked = todo[anchor, w] & (score >= low[anchor, w]) & (score <= high[anchor, w])
                if share is not None:
                    asked &= score >= least[anchor, w]
                new = asked & (score < before[anchor, w])  # others were found by a try before
                a, y = anchor[new], x[new]
                out.append(pd.DataFrame({"anchor": a + part.start, "window": np.full(len(a), w), "score": score[new], "id": ids[y], "row": places[y]}))
                full = np.bincount(anchor[asked], minlength=len(low)) >= self.k
                before[:, w] = np.where(todo[:, w], least[:, w], before[:, w])
                todo[:, w] &= ~full & (least[:, w] > low[:, w])
        return out

    def _keep(self, all_found: pd.DataFrame) -> None:
        columns = [all_found[c].to_numpy() for c in ("row", "id", "score", "window", "anchor")]
        order = np.lexsort((columns[0], columns[1], -columns[2], columns[3], columns[4]))
        cell = columns[4][order] * self.low.shape[1] + columns[3][order]
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, np.int64)
        rank = np.arange(len(cell)) - np.repeat(starts, np.diff(np.r_[starts, len(cell)]))
        self.kept = all_found.iloc[order[rank < self.k]].reset_index(drop=True)
        last = order[rank == self.k - 1]
        self.least[columns[4][last], columns[3][last]] = columns[2][last]
        self.full[columns[4][last], columns[3][last]] = True

    def rows(self) -> pd.DataFrame:
        out = self.kept
        return pd.DataFrame({"anchor_id": self.ids[out["anchor"]], "window": out["window"], "id": out["id"], "row": out["row"], "score": out["score"]})


def _stacked(vectors) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and vectors by dimension."""
    by_dim: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        by_dim.setdefault(len(v), []).append(i)
    return {d: (np.array(at), np.stack([np.asarray(vectors.iloc[i], np.float64) for i in at])) for d, at in by_dim.items()}


def _found(rows: DataFrame, anchors: pd.DataFrame, same_label: bool, k: int) -> DataFrame:
    """The k best rows of each partition for each anchor and window."""
    held = rows.sparkSession.sparkContext.broadcast(anchors)  # of at most SCAN_BYTES

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = held.value
        windows = {}
        for dim, (at, vectors) in _stacked(frame["vec"]).items():
            part = frame.iloc[at]
            low, high = (np.stack(part[c].to_numpy()).astype(np.int64) for c in ("low", "high"))
            windows[dim] = _Windows(*(part[c].to_numpy(np.int64) for c in ("id", "label", "row")), vectors, low, high, same_label, k)
        for batch in batches:
            for dim, (at, vectors) in _stacked(batch["vec"]).items():
                if dim in windows:
                    ids, labels, places = (batch[c].to_numpy(np.int64)[at] for c in ("id", "label", "row"))
                    for i in range(0, len(at), ROWS):
                        cut = slice(i, i + ROWS)
                        windows[dim].add(ids[cut], labels[cut], places[cut], vectors[cut])
        for x in windows.values():
            yield x.rows()

    return rows.mapInPandas(search, "anchor_id long, window int, id long, row long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id", "row")).cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """Scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def hard_negatives(
    vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """For each anchor (rows whose id is divisible by `every`) and each of its
    `positives` best other rows of its label, the `negatives` best rows of
    other labels whose score is `low` to `high` percent of the positive's:
    one row (anchor_id, positive_id, rank from 1, negative_id, positive_score,
    negative_score) each; fewer if there are fewer.

    Components are floor(scale * x) with x as double; a score is the inner
    product with the anchor; ties go to the smaller id.  Rows with a null id, a
    null label, or a vector that is null, empty or holds null or non-finite
    components take no part; vectors of other dimensions don't meet.  Rows that
    repeat an id are rows each; of those that repeat an anchor's id the one
    with the smallest label, vector and place in the input is the anchor and the
    others are candidates.  Scores must fit 64 bits.  Extra columns are
    ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    key, label, vector = (F.col(f"`{c}`") for c in (id_col, label_col, vector_col))
    whole = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))) & ~F.isnan(x.cast("double")))
    usable = vectors.where(key.isNotNull() & label.isNotNull() & (F.size(vector) > 0) & whole)
    number = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    usable = usable.select(key.cast("long").alias("id"), label.cast("long").alias("label"), number.alias("vec"), F.monotonically_increasing_id().alias("row"))
    work = Work(spark)
    try:
        rows = work(usable, "negatives_rows")
        anchors = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "vec", "row")).alias("one")).select("id", "one.*")
        stats = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
        size = 8 * ((stats["dim"] or 0) + 2 * positives + 4)
        scans = max(1, -(-2 * (stats["n"] or 0) * size // SCAN_BYTES))  # by hash: half full on average
        anchors = work(anchors.withColumn("scan", F.pmod(F.xxhash64("id"), F.lit(scans)).cast("int")), "negatives_anchors")

        out = []
        for scan in range(scans):
            frame = anchors.where(F.col("scan") == scan).toPandas()
            frame["low"], frame["high"] = [[FLOOR]] * len(frame), [[TOP]] * len(frame)
            best = work(_best(_found(rows, frame, True, positives), positives), "negatives_positives")
            found = best.groupBy("anchor_id").agg(F.collect_list(F.struct("rank", "score")).alias("scores"))  # `positives` at most
            scores = {r["anchor_id"]: dict(tuple(x) for x in r["scores"]) for r in found.toLocalIterator()}
            bounds = [[_bounds(scores[i][n], low, high) if n in scores.get(i, ()) else (1, 0) for n in range(1, positives + 1)] for i in frame["id"]]
            frame["low"], frame["high"] = [[x for x, _ in b] for b in bounds], [[x for _, x in b] for b in bounds]
            worst = _best(_found(rows, frame, False, negatives), negatives)
            worst = worst.select("anchor_id", (F.col("window") + 1).alias("positive"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            best = best.select("anchor_id", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
            joined = worst.join(best, ["anchor_id", "positive"])
            out.append(work(joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives_found"))
        result = out[0]
        for more in out[1:]:
            result = result.unionByName(more)
        return staged(result, "hard_negatives")
    finally:
        work.end()


__all__ = ["Index", "hard_negatives"]
