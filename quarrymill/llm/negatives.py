"""Hard negatives by radix selection: the best rows of each window of scores, found digit by digit over a grid of blocks.

Rows and anchors are dealt out into groups by hashes, and each pair of a group of rows and a group of anchors is a task of
its own: so no task has all rows, and none all anchors. A task scores its rows with its anchors and returns, for each window
of scores, a histogram of the next digit of the scores' distance from the window's upper end. Summed up, the histograms tell
in which bucket the k-th row lies; the next pass looks at that bucket alone. Rows of one score go on to the digits of their
ids. When few rows are left, or all digits are known, one pass gathers the rows up to there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import stored, tasks_for

POSITIVES, NEGATIVES = 5, 3
#: A negative's score is between these hundredths of its positive's.
LOW, HIGH = 50, 95
#: Components are floor(SCALE * x).
SCALE = 256
#: A histogram has 2^DIGIT buckets.
DIGIT = 10
#: A window is looked at no closer once the buckets up to its k-th row have so many rows for each row that is wanted.
SPARE = 8
#: Rows and anchors of a group, and scores that are worked on at once.
ROWS, ANCHORS, CELLS = 32_768, 4_096, 1_000_000
#: Components are held within this, so that scores of up to 2048 of them fit into 63 bits.
MOST = 1 << 25

_WINDOW = "struct<w:int,upper:long,width:long,need:int,lo:long,shift:int,tie:boolean,id_lo:long,id_shift:int>"
_HISTOGRAM = "no long, w int, bucket int, n long"
_GATHERED = "no long, w int, vec_id long, score long"


def prepared(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """vec_id, label, v (array<int>) of the rows that take part."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(MOST))), F.lit(float(MOST)))).cast("int"))
    out = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(fine, F.lit(False)))
    return out.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), whole.alias("v"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _apart(ids: np.ndarray, least: np.ndarray) -> np.ndarray:
    """ids - least, of 64 bits without a sign; of no meaning where an id is less."""
    return ids.astype(np.uint64) - least.astype(np.uint64)


class _Cell:
    """A group of rows, and the windows of a group of anchors with the rows that belong to them."""

    def __init__(self, rows: pa.Table, anchors: pa.Table):
        self.v, self.ids, self.labels = _matrix(rows["v"]), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.a, self.no, self.of, self.label = _matrix(anchors["v"]), anchors["no"].to_numpy(), anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
        lists = anchors["windows"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        self.anchor = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        flat = lists.flatten()
        self.win = {flat.type.field(k).name: flat.field(k).to_numpy(zero_copy_only=False) for k in range(flat.type.num_fields)}

    def parts(self, alike: bool):
        """Windows from..to, and the distances from the upper end of all rows for each of them; -1: not of the window."""
        step = max(1, CELLS // max(len(self.ids), 1))
        for begin in range(0, len(self.anchor), step):
            at = slice(begin, begin + step)
            first, last = self.anchor[at][0], self.anchor[at][-1] + 1
            score = scores(self.a[first:last], self.v)[self.anchor[at] - first]
            label = self.label[self.anchor[at], None]
            fits = (label == self.labels) & (self.of[self.anchor[at], None] != self.ids) if alike else label != self.labels
            d = self.win["upper"][at, None] - score
            d[~fits | (d < 0) | (d > self.win["width"][at, None])] = -1
            yield at, d, score


def _first(keys: np.ndarray, need: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Of sorted (window, bucket) runs with their counts: those up to the bucket in which a window has what it needs."""
    cum = np.cumsum(count)
    start = np.r_[True, keys[1:] != keys[:-1]]
    before = cum - count
    base = np.maximum.accumulate(np.where(start, before, 0))
    return before - base < need[keys]


def _histogram(alike: bool):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            cell = _Cell(rows, anchors)
            for at, d, _ in cell.parts(alike):
                w = {k: x[at] for k, x in cell.win.items()}
                tie = w["tie"].astype(bool)
                which, row = np.nonzero(d >= 0)
                x, t = d[which, row], tie[which]
                ids = _apart(cell.ids[row], w["id_lo"][which]) >> w["id_shift"][which].astype(np.uint64)
                digit = np.where(t, np.minimum(ids, np.uint64(1 << DIGIT)).astype(np.int64), (x - w["lo"][which]) >> w["shift"][which])
                fine = np.where(t, (x == w["lo"][which]) & (cell.ids[row] >= w["id_lo"][which]), x >= w["lo"][which]) & (digit < 1 << DIGIT)
                place, count = np.unique((which[fine] << DIGIT) + digit[fine], return_counts=True)
                if len(place):
                    # what lies beyond the bucket in which this task alone has enough can't be wanted
                    keep = _first(place >> DIGIT, w["need"], count)
                    place, count = place[keep], count[keep]
                    out.append((cell.no[cell.anchor[at][place >> DIGIT]], w["w"][place >> DIGIT], (place & ((1 << DIGIT) - 1)).astype(np.int32), count))
        return _table(out, ("no", "w", "bucket", "n"), (pa.int64(), pa.int32(), pa.int32(), pa.int64()))

    return run


def _gather(alike: bool, k: int):
    """Rows up to the last bucket; of those a task has, the first k of each window."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            cell = _Cell(rows, anchors)
            for at, d, score in cell.parts(alike):
                w = {n: x[at] for n, x in cell.win.items()}
                last = np.where(w["tie"].astype(bool), w["lo"], w["lo"] + (np.int64(1) << w["shift"]) - 1)
                which, row = np.nonzero((d >= 0) & (d <= last[:, None]))
                x, ids = d[which, row], cell.ids[row]
                fine = ~w["tie"].astype(bool)[which] | (x < w["lo"][which]) | (ids < w["id_lo"][which]) | (_apart(ids, w["id_lo"][which]) >> w["id_shift"][which].astype(np.uint64) == 0)
                which, row, x, ids = which[fine], row[fine], x[fine], ids[fine]
                order = np.lexsort((ids, x, which))
                which, row = which[order], row[order]
                if len(which):
                    start = np.maximum.accumulate(np.where(np.r_[True, which[1:] != which[:-1]], np.arange(len(which)), 0))
                    keep = np.arange(len(which)) - start < k
                    which, row = which[keep], row[keep]
                    out.append((cell.no[cell.anchor[at][which]], w["w"][which], cell.ids[row], score[which, row]))
        return _table(out, ("no", "w", "vec_id", "score"), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))

    return run


def _table(parts: list, names: tuple, kinds: tuple) -> pa.Table:
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[] for _ in names]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))


class Grid:
    """Rows and anchors in groups. Anchors: no (a number of its own for each), vec_id, label, v, ga (its group)."""

    def __init__(self, rows: DataFrame, anchors: DataFrame):
        spark = rows.sparkSession
        size = F.size("v")
        self.rows = stored(rows.withColumn("no", F.monotonically_increasing_id()), "vectors")
        found = self.rows.agg(F.count(F.lit(1)), F.coalesce(F.max(size), F.lit(0)), F.coalesce(F.max(F.array_max(F.transform("v", F.abs))), F.lit(0)), F.min("vec_id"), F.max("vec_id")).first()
        n, self.dims, self.most, self.least_id, self.most_id = found
        self.row_groups = max(-(-n // ROWS), 2 * tasks_for(spark))
        self.rows = self.rows.select("vec_id", "label", self._wide(), F.pmod(F.xxhash64("no"), F.lit(self.row_groups)).cast("int").alias("gr"))
        self.anchors = stored(anchors.withColumn("no", F.monotonically_increasing_id()), "anchors")
        n_anchors = self.anchors.count()
        self.anchor_groups = max(1, -(-n_anchors // ANCHORS))
        self.anchors = self.anchors.select("no", "vec_id", "label", self._wide(), F.pmod(F.xxhash64("no"), F.lit(self.anchor_groups)).cast("int").alias("ga"))
        self.id_bits = int(self.most_id - self.least_id).bit_length() if n else 0

    def _wide(self) -> Column:
        """Shorter vectors are filled up with zeros; an empty one would be none in Arrow."""
        return F.concat("v", F.array_repeat(F.lit(0), F.lit(max(self.dims, 1)) - F.size("v"))).alias("v")

    def run(self, windows: DataFrame, function, schema: str) -> DataFrame:
        """Applies function to each group of rows with each group of anchors that have windows."""
        listed = windows.select("no", F.struct(*[x.split(":")[0] for x in _WINDOW[7:-1].split(",")]).cast(_WINDOW).alias("win")).groupBy("no").agg(F.collect_list("win").alias("windows"))
        left = self.rows.withColumn("ga", F.explode(F.sequence(F.lit(0), F.lit(self.anchor_groups - 1))))
        right = self.anchors.join(listed, "no").withColumn("gr", F.explode(F.sequence(F.lit(0), F.lit(self.row_groups - 1))))
        return left.groupBy("ga", "gr").cogroup(right.groupBy("ga", "gr")).applyInArrow(function, schema)


def select(grid: Grid, windows: DataFrame, k: int, alike: bool) -> DataFrame:
    """The first k rows of each window: no, w, vec_id, score, rank (from 1).

    windows: no (the anchor's), w (a number of the window), upper and width: scores from upper - width to upper. alike: rows
    of the anchor's label but its own id, else rows of other labels. Higher scores first, then smaller ids.
    """
    bits = F.length(F.bin("width")).cast("int")
    state = windows.select(
        "no", F.col("w").cast("int").alias("w"), "upper", "width", F.lit(k).alias("need"), F.lit(0).cast("long").alias("lo"), F.greatest(bits - DIGIT, F.lit(0)).alias("shift"),
        F.lit(False).alias("tie"), F.lit(grid.least_id or 0).cast("long").alias("id_lo"), F.lit(max(grid.id_bits - DIGIT, 0)).alias("id_shift"),
    )
    open_, done = stored(state, "windows"), []
    while not open_.isEmpty():
        counted = grid.run(open_, _histogram(alike), _HISTOGRAM).groupBy("no", "w", "bucket").agg(F.sum("n").alias("n"))
        each = Window.partitionBy("no", "w").orderBy("bucket")
        cum = counted.withColumn("upto", F.sum("n").over(each))
        # where the k-th row is; a window with fewer rows ends nowhere, and all of them are wanted
        at = open_.join(cum.withColumnRenamed("n", "inside"), ["no", "w"], "left").filter("upto is null or upto - inside < need")
        at = at.groupBy(*open_.columns).agg(F.max("bucket").alias("bucket"), F.max("upto").alias("upto"), F.max_by("inside", "bucket").alias("inside"))
        step = stored(_narrowed(at, k), "windows")
        done.append(step.filter("state = 'done'").drop("state"))
        open_ = step.filter("state = 'open'").drop("state")
    if not done:
        return grid.rows.sparkSession.createDataFrame([], _GATHERED + ", rank int")
    ready = done[0]
    for more in done[1:]:
        ready = ready.union(more)
    found = grid.run(ready, _gather(alike, k), _GATHERED)
    first = Window.partitionBy("no", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def _narrowed(at: DataFrame, k: int) -> DataFrame:
    """The windows after a pass: state is done, or open with the next digit's place. bucket, upto, inside: where the need-th
    row lies, and how many rows lie up to there and in that bucket."""
    short = F.coalesce(F.col("upto") < F.col("need"), F.lit(True))
    at = at.withColumn("short", short)
    shift, lo = F.col("shift"), F.expr("lo + shiftleft(cast(bucket as long), shift)")
    # ids may be so far from each other that their distance doesn't fit
    id_lo = F.expr("cast(cast(id_lo as decimal(20)) + cast(bucket as decimal(5)) * cast(pow(2D, id_shift) as decimal(20)) as long)")
    few = F.col("upto") <= SPARE * k
    less = F.col("need") - (F.col("upto") - F.col("inside"))
    # all rows of the window: its whole width is the last bucket
    whole = F.col("short") & ~F.col("tie")
    last_digit = F.when(F.col("tie"), F.col("id_shift") == 0).otherwise(F.lit(False))
    exact = ~F.col("tie") & (shift == 0) & (F.col("upto") == F.col("need"))
    done = F.col("short") | few | last_digit | exact
    to_tie = ~F.col("tie") & (shift == 0) & ~done
    return at.select(
        "no", "w", "upper", "width",
        F.when(done, F.col("need")).otherwise(less).cast("int").alias("need"),
        F.when(whole, F.lit(0).cast("long")).when(F.col("tie"), F.col("lo")).otherwise(lo).alias("lo"),
        F.when(whole, F.lit(62)).when(F.col("tie") | done, shift).otherwise(F.greatest(shift - DIGIT, F.lit(0))).cast("int").alias("shift"),
        (F.col("tie") | to_tie).alias("tie"),
        F.when(F.col("tie") & ~F.col("short"), id_lo).otherwise(F.col("id_lo")).alias("id_lo"),
        F.when(F.col("tie") & ~done, F.greatest(F.col("id_shift") - DIGIT, F.lit(0))).otherwise(F.col("id_shift")).cast("int").alias("id_shift"),
        F.when(done, "done").otherwise("open").alias("state"),
    )


def mine(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Hard negatives of each anchor (rows for which `anchors` holds) and each of its positives: anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score.

    A score is the inner product of floor(scale * x). Positives are an anchor's first rows of its label with another id,
    negatives the first rows of other labels with low * positive <= 100 * negative <= high * positive, so a positive of
    negative score has none. Rows with a null id, label, vector or component, or one that is not finite, take no part.
    Vectors of different lengths are compared as if the shorter ended in zeros; components beyond 2^25 count as 2^25. A
    repeated row counts as often as it is there, as an anchor too. An empty table, an anchor without positives and a
    positive without negatives give no row. Other columns are not looked at.
    """
    base = prepared(rows, id_col, vec_col, label_col, scale)
    grid = Grid(base, prepared(rows.filter(anchors), id_col, vec_col, label_col, scale))
    # scores are within the product of the lengths, and so each anchor's window for positives is no wider
    far = F.lit(grid.dims * grid.most).cast("long") * F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0)).cast("long")
    length = lambda v: F.aggregate(v, F.lit(0).cast("double"), lambda s, x: s + x.cast("double") * x)
    longest = grid.rows.agg(F.max(length("v"))).first()[0] or 0.0
    near = F.ceil(F.sqrt(length("v") * longest) * (1 + 1e-9)).cast("long") + 1
    upper = F.least(far, near)
    wide = grid.anchors.select("no", F.lit(0).alias("w"), upper.alias("upper"), (2 * upper).alias("width"))
    best = stored(select(grid, wide, positives, alike=True), "positives")
    # floor(high * p / 100) and ceil(low * p / 100), without 100 * p, which may not fit
    bound = best.filter("score >= 0").select("no", "score").distinct()
    bound = bound.withColumn("upper", F.expr(f"(score div 100) * {high} + (score % 100 * {high}) div 100"))
    bound = bound.withColumn("lower", F.expr(f"(score div 100) * {low} + (score % 100 * {low} + 99) div 100"))
    bound = bound.filter("lower <= upper").withColumn("w", F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"))))
    bound = stored(bound, "bounds")
    worst = stored(select(grid, bound.select("no", "w", F.col("upper").cast("long"), (F.col("upper") - F.col("lower")).cast("long").alias("width")), negatives, alike=False), "negatives")
    named = grid.anchors.select("no", F.col("vec_id").alias("anchor_id"))
    pairs = best.select("no", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = pairs.join(bound.select("no", "w", F.col("score").alias("positive_score")), ["no", "positive_score"])
    out = out.join(worst.select("no", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), ["no", "w"]).join(named, "no")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
