"""Hard negatives for anchors by an STR-packed R-tree over the vectors.

The tree's upper levels are Spark's: vectors are ranged into slabs by one coordinate and within a slab by a second one,
and what lies in one range is a subtree of bounded size.  A task packs its subtree further, sort-tile-recursive over the
coordinates of widest spread, into leaves of ``LEAF`` vectors, with minimum bounding boxes over leaves and over ``FAN``
boxes at a time.  For an anchor ``a`` a box ``[lo, hi]`` holds scores between ``sum(min(a lo, a hi))`` and
``sum(max(a lo, a hi))``, coordinate by coordinate.  A queue takes the box of the highest such bound first; boxes outside
the wanted scores, and those strictly below the k-th score found so far, are never opened (equal ones are, as ties go to
the smaller id).

1. Every anchor is searched in its own subtree for its best rows of the same label: a lower bound for its positives.
2. It then visits the subtrees whose boxes reach that bound; the best few over all subtrees are its positives.
3. For each positive the best rows of other labels inside the window of scores, found the same way.

Of the uppermost boxes at most ``TOP`` are sent to tasks, whatever the number of vectors; anchors travel to the subtrees
below those that they can't rule out.  A group is one subtree and a bounded block of anchors; it returns a few rows for
each anchor, so neither pairs nor scores are ever laid out.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part, nor do rows without
an id; vectors of different lengths never meet; repeated ids are rows of their own, and an anchor leaves out the rows of
its own id; rows of equal score go by id; an anchor without positives, or a positive without negatives, gives no rows;
extra columns don't matter; an empty table gives no rows.  Scores are exact integers; such as no long can hold count as
the nearest long.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotspark.llm.common import written

POSITIVES, NEGATIVES = 5, 3
#: Scores of negatives, in hundredths of the positive's score.
LOWER, UPPER = 50, 95
LEAF, FAN = 256, 16
#: Boxes that are sent to tasks.
TOP = 1024
#: Rows of a subtree: between these, about a 64th of all.
SUBTREE = (2048, 1 << 16)
#: Anchors in a block.
BLOCK = 1 << 15
_LONG = (1 << 63) - 1


def _matrix(column) -> np.ndarray:
    """An Arrow column of vectors of one length as rows of doubles."""
    import pyarrow.compute as pc

    flat = pc.list_flatten(column)
    return flat.to_numpy().reshape(len(column), -1)


def _alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are if all their products are exact in doubles, else as Python's integers."""
    most = float(np.abs(a).max(initial=0.0)) * float(np.abs(b).max(initial=0.0))
    if most * a.shape[1] < 2.0**52:
        return a, b
    return tuple(np.array([[int(x) for x in row] for row in m.tolist()], dtype=object).reshape(m.shape) for m in (a, b))


class Tree:
    """An R-tree packed sort-tile-recursive over at most a subtree's vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        order = self._tiles(vectors)
        self.vectors, self.ids, self.labels = vectors[order], ids[order], labels[order]
        cuts = np.arange(0, len(order), LEAF)
        low, high = np.minimum.reduceat(self.vectors, cuts), np.maximum.reduceat(self.vectors, cuts)
        self.leaves = len(cuts)
        lows, highs, children, at = [low], [high], [], 0
        while len(lows[-1]) > 1:
            cuts = np.arange(0, len(lows[-1]), FAN)
            children += [range(at + c, at + min(c + FAN, len(lows[-1]))) for c in cuts.tolist()]
            at += len(lows[-1])
            lows.append(np.minimum.reduceat(lows[-1], cuts))
            highs.append(np.maximum.reduceat(highs[-1], cuts))
        self.low, self.high, self.children = np.concatenate(lows), np.concatenate(highs), children
        self.root = len(self.low) - 1

    @staticmethod
    def _tiles(vectors: np.ndarray) -> np.ndarray:
        """Rows in the order of the leaves: slabs by one coordinate after another, widest first."""
        shape = vectors.astype(np.float64)
        axes = np.argsort(-shape.std(axis=0), kind="stable")
        groups = [np.arange(len(vectors))]
        for k, axis in enumerate(axes.tolist()):
            if all(len(g) <= LEAF for g in groups):
                break
            out = []
            for g in groups:
                if len(g) <= LEAF:
                    out.append(g)
                    continue
                leaves = -(-len(g) // LEAF)
                slabs = math.ceil(leaves ** (1 / max(1, min(len(axes) - k, round(math.log2(leaves))))))
                size = -(-leaves // max(2, slabs)) * LEAF
                g = g[np.argsort(shape[g, axis], kind="stable")]
                out += [g[c : c + size] for c in range(0, len(g), size)]
            groups = out
        return np.concatenate(groups)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each anchor (column) can have in each box (row)."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return self.low @ up.T + self.high @ down.T, self.high @ up.T + self.low @ down.T

    def best(self, anchor: np.ndarray, reach: tuple, wanted, k: int, windows: list[tuple]) -> list[list[tuple]]:
        """For each window (least, most) the ``k`` best (score, id) among the wanted rows inside it, smaller ids first.

        ``reach`` holds the anchor's bounds in every box; ``wanted`` tells a range of rows apart.  One queue serves all
        windows: a box is opened as long as one of them may want it.
        """
        below, above = reach
        heaps: list[list[tuple]] = [[] for _ in windows]  # of (score, -id): the worst of the best first
        floors = [least for least, _ in windows]
        floor, most = min(floors), max(high for _, high in windows)
        queue = [(-above[self.root], self.root)]
        while queue:
            bound, box = heapq.heappop(queue)
            if -bound < floor:
                break
            if box >= self.leaves:
                for child in self.children[box - self.leaves]:
                    if any(above[child] >= low and below[child] <= high for low, (_, high) in zip(floors, windows)):
                        heapq.heappush(queue, (-above[child], child))
                continue
            rows = slice(box * LEAF, (box + 1) * LEAF)
            scores = self.vectors[rows] @ anchor
            hit = np.flatnonzero((scores >= floor) & (scores <= most) & wanted(rows))
            if not len(hit):
                continue
            for score, id_ in zip(scores[hit].tolist(), self.ids[rows][hit].tolist()):
                item = (score, -id_)
                for w, (_, high) in enumerate(windows):
                    if floors[w] <= score <= high:
                        heap = heaps[w]
                        if len(heap) < k:
                            heapq.heappush(heap, item)
                        elif item > heap[0]:
                            heapq.heapreplace(heap, item)
                        if len(heap) == k:
                            floors[w] = heap[0][0]
            floor = min(floors)
        return [[(s, -i) for s, i in sorted(heap, reverse=True)] for heap in heaps]


def _long(x) -> int:
    return max(-_LONG - 1, min(_LONG, int(x)))


def _search(rows, anchors) -> tuple[Tree, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """The tree over a subtree's rows, the anchors' vectors, and their bounds in its boxes."""
    mine, theirs = _alike(_matrix(rows.column("vec")), _matrix(anchors.column("vec")))
    tree = Tree(mine, rows.column("id").to_numpy(), rows.column("label").to_numpy())
    return tree, theirs, tree.bounds(theirs)


def _positives(rows, anchors, k: int) -> list[tuple[int, int, int]]:
    """(number of the anchor, id, score) of the best rows of the anchor's label that reach its floor."""
    tree, vectors, (below, above) = _search(rows, anchors)
    ids, labels, floors = (anchors.column(c).to_pylist() for c in ("id", "label", "floor"))
    out = []
    for n in range(len(ids)):
        wanted = lambda part, n=n: (tree.labels[part] == labels[n]) & (tree.ids[part] != ids[n])
        least = -math.inf if floors[n] is None else floors[n]
        out += [(n, i, s) for s, i in tree.best(vectors[n], (below[:, n], above[:, n]), wanted, k, [(least, math.inf)])[0]]
    return out


def _negatives(rows, anchors, k: int, lower: int, upper: int) -> list[tuple[int, int, int, int]]:
    """(number of the anchor, its positive's score, id, score) of the best rows of other labels in each window."""
    tree, vectors, (below, above) = _search(rows, anchors)
    labels, scores = (anchors.column(c).to_pylist() for c in ("label", "scores"))
    out = []
    for n, label in enumerate(labels):
        wanted = lambda part, label=label: tree.labels[part] != label
        asked = [(s, w) for s in scores[n] if (w := window(s, lower, upper))[0] <= w[1]]
        found = tree.best(vectors[n], (below[:, n], above[:, n]), wanted, k, [w for _, w in asked]) if asked else []
        out += [(n, s, i, x) for (s, _), items in zip(asked, found) for x, i in items]
    return out


def window(score: int, lower: int = LOWER, upper: int = UPPER) -> tuple[int, int]:
    """Least and greatest integer x with ``lower * score <= 100 * x <= upper * score``."""
    return -(-lower * score // 100), upper * score // 100


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, vec) of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall(F.col("vec"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vec.alias("vec"))
    return rows.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").where(fine & (F.size("vec") > 0))


def subtrees(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dim, mark, id, label, vec): the rows with the number of their subtree; and (dim, mark, low, high): its box.

    Numbers follow the tiles: slabs by the first coordinate, ranges of the last one within a slab.  Ranges also go by
    id, so that equal vectors are divided like others.
    """
    n = rows.count()
    size = min(max(1 << math.ceil(math.log2(max(1, n) / 64)) if n > 64 else 1, SUBTREE[0]), SUBTREE[1])
    parts = -(-n // size) or 1
    slabs = max(1, round(math.sqrt(parts)))
    keyed = rows.select("id", "label", "vec", F.size("vec").alias("dim"), F.element_at("vec", 1).alias("x"), F.element_at("vec", -1).alias("y"))
    cuts = keyed.approxQuantile("x", [k / slabs for k in range(1, slabs)], 0.2 / slabs) if slabs > 1 else []
    slab = F.lit(0)
    for c in sorted(set(cuts)):
        slab = slab + (F.col("x") > c).cast("int")
    keys = ["dim", "slab", "y", "id"]
    tiled = keyed.withColumn("slab", slab).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)

    def number(batches: Iterator) -> Iterator:
        """What stands together in a partition, of one length, up to the size, is one subtree."""
        import pyarrow as pa
        from pyspark import TaskContext

        mark, dim, held = TaskContext.get().partitionId() << 32, None, 0
        for batch in batches:
            marks = []
            for d in batch.column(0).to_pylist():
                if dim is not None and (d != dim or held >= size):
                    mark, held = mark + 1, 0
                dim, held = d, held + 1
                marks.append(mark)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.int64()), *batch.columns[1:]], names=["dim", "mark", "id", "label", "vec"])

    tiled = written(tiled.select("dim", "id", "label", "vec").mapInArrow(number, "dim int, mark long, id long, label long, vec array<double>"), "subtrees")

    def box(table):
        import pyarrow as pa

        data = _matrix(table.column("vec"))
        low, high = (pa.array([x.tolist()], pa.list_(pa.float64())) for x in (data.min(axis=0), data.max(axis=0)))
        return pa.table({"dim": table.column("dim").slice(0, 1), "mark": table.column("mark").slice(0, 1), "low": low, "high": high})

    boxes = tiled.select("dim", "mark", "vec").groupBy("mark").applyInArrow(box, "dim int, mark long, low array<double>, high array<double>")
    return tiled, written(boxes, "boxes")


def top_boxes(boxes: DataFrame) -> tuple[DataFrame, list]:
    """The subtrees' boxes with the box ``g`` above each, and those (dim, g, low, high), about ``TOP`` at most: as many
    for each length as it has ranges of partitions."""
    last = boxes.agg(F.max(F.shiftright("mark", 32)).alias("m")).first()["m"] or 0
    boxes = boxes.withColumn("g", F.floor(F.shiftright("mark", 32) / (last // TOP + 1)).cast("int"))
    sides = boxes.select("dim", "g", F.posexplode(F.arrays_zip("low", "high")).alias("k", "b"))
    sides = sides.groupBy("dim", "g", "k").agg(F.min("b.low").alias("low"), F.max("b.high").alias("high"))
    above = sides.groupBy("dim", "g").agg(F.sort_array(F.collect_list(F.struct("k", "low", "high"))).alias("b"))
    return boxes.select("dim", "g", "mark"), above.select("dim", "g", F.col("b.low").alias("low"), F.col("b.high").alias("high")).collect()


def _routed(anchors: DataFrame, boxes: DataFrame, tops: list, reaches) -> DataFrame:
    """The anchors, once for each subtree below an upper box that ``reaches`` leaves open."""
    sides: dict[int, list] = {}
    for r in tops:
        sides.setdefault(r["dim"], []).append((r["g"], r["low"], r["high"]))
    # bounds of upper boxes are doubles: this much is left for their rounding
    slack = 1e-9

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
            who, where = [], []
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(rows))
                gs, low, high = zip(*sides[dim])
                low, high = np.array(low), np.array(high)
                vectors = _matrix(part.column(part.schema.get_field_index("vec")))
                up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
                below, above = low @ up.T + high @ down.T, high @ up.T + low @ down.T
                room = slack * (1 + np.abs(below) + np.abs(above))
                for n, open_ in enumerate(reaches(part, (below - room).T, (above + room).T)):
                    hit = np.flatnonzero(open_)
                    who += [int(rows[n])] * len(hit)
                    where += [gs[k] for k in hit.tolist()]
            out = batch.take(pa.array(who, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(where, pa.int32())], names=[*out.schema.names, "g"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return anchors.mapInArrow(run, f"{fields}, g int").join(boxes, ["dim", "g"]).drop("g")


def _met(tiled: DataFrame, visits: DataFrame, blocks: int, search, fields: str) -> DataFrame:
    """``search(subtree, anchors)`` for each subtree and each block of its visitors; ``a`` names the anchor."""
    names = [x.split()[0] for x in fields.split(", ")]

    def run(rows, anchors):
        import pyarrow as pa

        found = search(rows, anchors) if len(rows) and len(anchors) else []
        columns = list(zip(*found)) if found else [[] for _ in names]
        a = anchors.column("a").to_numpy()
        numbers = [pa.array(a[np.array(columns[0], dtype=np.int64)], pa.int64())]
        return pa.table([*numbers, *(pa.array([_long(x) for x in c], pa.int64()) for c in columns[1:])], names=names)

    visits = visits.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(blocks)).cast("int"))
    dealt = tiled.select("mark", "id", "label", "vec", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    return dealt.groupBy("mark", "block").cogroup(visits.groupBy("mark", "block")).applyInArrow(run, fields)


def _first(rows: DataFrame, keys: list[str], score: str, id_: str, k: int) -> DataFrame:
    """The first ``k`` rows of each key by score, then id, with their place ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(id_))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, lower: int = LOWER, upper: int = UPPER,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` names, by
    a condition on ``id``.  Components have to be integers, as doubles or longs."""
    tiled, boxes = subtrees(usable(vectors, id_col, vec_col, label_col))
    boxes, tops = top_boxes(boxes)

    def own(table):
        """The subtree's anchors with the score of the last positive that they have in it, if it has as many."""
        import pyarrow as pa

        some = table.filter(table.column("is_anchor"))
        some = some.select(["dim", "id", "label", "vec"])
        floor: list = [None] * len(some)
        if len(some):
            found: dict[int, list] = {}
            for n, _, s in _positives(table, some.append_column("floor", pa.nulls(len(some), pa.int64())), positives):
                found.setdefault(n, []).append(s)
            floor = [_long(found[n][-1]) if len(found.get(n, ())) == positives else None for n in range(len(some))]
        return some.append_column("floor", pa.array(floor, pa.int64()))

    marked = tiled.withColumn("is_anchor", F.coalesce(anchor, F.lit(False)))
    anchors = marked.groupBy("mark").applyInArrow(own, "dim int, id long, label long, vec array<double>, floor long")
    anchors = written(anchors.withColumn("a", F.monotonically_increasing_id()), "anchors")
    blocks = -(-anchors.count() // BLOCK) or 1

    def near(part, below, above):
        floors = part.column(part.schema.get_field_index("floor")).to_pylist()
        return [above[n] >= (-math.inf if f is None else f) for n, f in enumerate(floors)]

    met = _met(tiled, _routed(anchors, boxes, tops, near), blocks, lambda rows, some: _positives(rows, some, positives), "a long, positive_id long, positive_score long")
    found = written(_first(met, ["a"], "positive_score", "positive_id", positives).drop("rank"), "positives")
    scores = found.groupBy("a").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))

    def between(part, below, above):
        lists = part.column(part.schema.get_field_index("scores")).to_pylist()
        spans = [[w for w in (window(s, lower, upper) for s in own_) if w[0] <= w[1]] for own_ in lists]
        return [np.any([(above[n] >= least) & (below[n] <= most) for least, most in some], axis=0) if some else np.zeros(above.shape[1], dtype=bool) for n, some in enumerate(spans)]

    asked = anchors.drop("floor").join(scores, "a")
    search = lambda rows, some: _negatives(rows, some, negatives, lower, upper)
    met = _met(tiled, _routed(asked, boxes, tops, between), blocks, search, "a long, positive_score long, negative_id long, negative_score long")
    last = _first(met, ["a", "positive_score"], "negative_score", "negative_id", negatives)
    out = found.join(last, ["a", "positive_score"]).join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def contract_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) as the query's contract wants them: labels shifted on every seventh id, components
    ``floor(256 x)``."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    # from 2^52 on 256 x is whole
    whole = lambda x: F.when(F.abs(x) < 2.0**52, F.floor(256 * x).cast("double")).otherwise(256 * x)
    return vectors.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), whole).alias("embedding"), label.alias("label"))


#: The query in DuckDB's dialect: all anchors against all rows.
ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS alike, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT a, b AS positive_id, score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a, positive_id ORDER BY s.score DESC, s.b) AS INTEGER) AS rank,
  s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, positive_id ORDER BY s.score DESC, s.b) <= 3
"""
