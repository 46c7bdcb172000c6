"""Exact n-gram Jaccard join by pivots, Voronoi regions and triangle-inequality windows.

A document's set is its distinct word shingles, hashed to 64 bits; documents with equal sets are one class, and the
work is on classes.  Jaccard distance (one minus similarity) is a metric, but in prose nearly all distances to any
pivot are 1, so pivots taken at large would replicate every document into every region.  The first level of regions is
therefore seeded by shingles: each class belongs to the regions of its ``n - ceil(t n) + 1`` first shingles in a fixed
order, commonest last, and any two classes within the threshold meet in one.  Regions of the same members are one
region.  From there on the metric decides:

* every region has a pivot; members within the threshold of it are linked to it, so that copies cost one distance each
  and only members of different components are left to compare.  A member too far by its size or its places in the
  order is not measured: what these leave open is kept as the interval in which its distance lies;
* a region of more than ``CELL`` rows gets ``PIVOTS`` further pivots.  The distances of all members to them are taken,
  each member belongs to the Voronoi cell of its nearest pivot, and it is replicated as a guest into those other cells
  whose members the triangle inequality lets it reach.  Cells that are still too large are divided again;
* in a cell of at most ``CELL`` rows the pairs that the windows of distance, size and place leave are compared exactly.
  A cell that pivots can't make smaller (all its members are about as far from one another) is joined block by block,
  each of that bounded size, all pairs of blocks together being the whole cell.  A cell with more than ``CROWD`` rows
  outside its largest component, as of near copies at whose edge its pivot stands, gets ``PIVOTS`` further pivots,
  ``FURTHER`` times, to which members are linked at one distance each; what other components are left is joined then.

The order of shingles affects cost only.  Shingles that repeat inside a batch of documents are counted over the whole
corpus; of these the most frequent, by a count from which on there are at most ``COMMON``, go last.

Defined results: null, empty and blank texts have no shingles and link with nothing; texts of fewer words than a
shingle are one shingle; repeated rows are documents of their own; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotspark.llm.common import discard, text_or_empty, written
from annotspark.llm.components import components, salted_join, stars as joined
from annotspark.llm.filters import filter_bits, hits, passing

WORDS = 5
PERCENT = 75
#: Shingles that are ordered last; a bounded list that is sent to all tasks.
COMMON = 1 << 19
#: Shingles among which a task looks for repeated ones.
TOGETHER = 1 << 21
#: Rows up to which a cell is compared directly, and pivots that divide a larger one.
CELL = 2048
PIVOTS = 4
#: Rows outside its largest component from which on a cell's components are first joined by further pivots, and how often.
CROWD = 16
FURTHER = 2
#: Regions of a class by which it is told whether a pair has met before.
EARLIER = 32
#: Bits of a class's parity marks, at least and at most.
MARKS = (1 << 8, 1 << 13)
#: Turns in which regions are looked for, each among its part of the shingles.
TURNS = 2

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
#: Bytes of text that are hashed together; a word may go on in the next ones.
SLICE = 1 << 18
#: Letters of a word whose hashes are looked up; those of later ones are computed.
NEAR = 64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOW = np.arange(256, dtype=np.uint64)
_LOW[65:91] += np.uint64(32)


def _letter(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """A hash of a byte (that of a-z for A-Z) and its place in a word."""
    return _mix((place.astype(np.uint64) * np.uint64(256) + _LOW[byte] + np.uint64(1)) * _ODD[0])


@lru_cache(maxsize=1)
def _near_letters() -> np.ndarray:
    return _letter(np.repeat(np.arange(NEAR), 256), np.tile(np.arange(256), NEAR))


def _word_sums(data: np.ndarray, heads: np.ndarray, before: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words in joined texts begin, how long they are, and the sums of their letters' hashes.

    A word begins behind white space and at ``heads``; the first ``before`` letters of the first one came earlier.  The
    hashes that are summed are those of letters with their places, so a word can be cut anywhere, and words of other
    letters, or of the same ones elsewhere, have unrelated sums.
    """
    own = ~_SPACE[data]
    new = own.copy()
    new[1:] &= ~own[:-1]
    new[heads] = own[heads]
    begin, at = np.flatnonzero(new), np.flatnonzero(own)
    if not len(begin):
        return begin, begin, np.zeros(0, dtype=np.uint64)
    first = np.searchsorted(at, begin)
    length = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, length)
    if before and begin[0] == 0:
        place[: length[0]] += before
        length[0] += before
    near = place < NEAR
    values = np.empty(len(at), dtype=np.uint64)
    if near.all():
        values = _near_letters()[place * 256 + data[at]]
    else:
        values[near] = _near_letters()[place[near] * 256 + data[at[near]]]
        values[~near] = _letter(place[~near], data[at[~near]])
    return begin, length, np.add.reduceat(values, first)


def _finished(sums: np.ndarray, length: np.ndarray) -> np.ndarray:
    return _mix(sums + length.astype(np.uint64) * _ODD[1])


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in joined texts that begin at ``starts``, and how many words stand before each text and in all."""
    begin, length, sums = _word_sums(data, starts[starts < len(data)])
    return _finished(sums, length), np.append(np.searchsorted(begin, starts), len(begin))


def _long_text(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one text of any length, slice by slice; a word that goes on is carried over."""
    out, n, carried = [], 0, np.zeros(1, dtype=np.uint64)
    none = np.zeros(0, dtype=np.int64)
    for at in range(0, len(data), SLICE):
        part = data[at : at + SLICE]
        begin, length, sums = _word_sums(part, none, n)
        if n and len(begin) and begin[0] == 0:
            sums[:1] += carried
        elif n:
            length, sums = np.append(n, length), np.append(carried, sums)
        n = 0
        if not _SPACE[part[-1]] and at + SLICE < len(data):
            n, carried = int(length[-1]), sums[-1:].copy()
            length, sums = length[:-1], sums[:-1]
        out.append(_finished(sums, length))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _sets(h: np.ndarray, at: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of texts whose words' hashes stand at ``h[at[i]:at[i + 1]]``."""
    import xxhash

    weights = (_ODD if words <= len(_ODD) else np.resize(_ODD, words))[:words]
    m = max(0, len(h) - words + 1)
    run = np.zeros(m, dtype=np.uint64)
    for k in range(words):
        run += h[k : k + m] * weights[k]
        run ^= run >> np.uint64(29)
    run = _mix(run)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            own = np.sort(run[a : b - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes(), seed=b - a)], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _sliced(column, words: int) -> Iterator[list[np.ndarray]]:
    """The shingle sets of the texts of an Arrow string array without nulls, those of about a megabyte of text at a time."""
    import pyarrow as pa

    text = column.cast(pa.large_binary())
    ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, side="right")) - 1)
        part = data[ends[at] : ends[to]]
        if len(part) > SLICE:
            h = _long_text(part)
            yield _sets(h, np.array([0, len(h)]), words)
        else:
            yield _sets(*_words(part, ends[at:to] - ends[at]), words)
        at = to


def _class_of(s: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s))).view(np.int64))


def marks_of(s: np.ndarray) -> bytes:
    """For each of a power of two of places, of about the set's size, whether an odd number of its shingles falls there.

    Marks of half the size are those of both halves added.  Where two sets' marks differ, so do the sets, by a shingle
    for each place at least, and what two sets of known sizes share follows from how much they differ.
    """
    bits = MARKS[0]
    while bits < min(len(s), MARKS[1]):
        bits *= 2
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def signature(marks: bytes) -> list[int]:
    """Marks as few as any set has, as four longs."""
    x = np.frombuffer(marks, dtype=np.uint8)
    while len(x) > MARKS[0] // 8:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.copy().view(np.int64).tolist()


def signatures(marks: DataFrame) -> DataFrame:
    """(cls, s0 to s3) of the classes' marks (cls, n, marks)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = np.array([signature(x) for x in batch.column(1).to_pylist()], dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, k]) for k in range(4))], names=["cls", "s0", "s1", "s2", "s3"])

    return marks.select("cls", "marks").mapInArrow(run, "cls long, s0 long, s1 long, s2 long, s3 long")


def _differ(a: bytes, b: bytes) -> int:
    """At how many places two sets' marks differ."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def may_link(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) of classes whose marks (cls, n, marks) leave it open whether they are linked."""
    one = lambda c: marks.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("marks").alias(f"m{c}"))
    both = pairs.distinct().join(one("a"), "a").join(one("b"), "b").select("a", "b", "na", "nb", "ma", "mb")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = np.fromiter(map(_differ, batch.column(4).to_pylist(), batch.column(5).to_pylist()), dtype=np.int64, count=len(total))
            open_ = np.flatnonzero((total - apart) // 2 * (100 + percent) >= total * percent)
            yield batch.select(["a", "b"]).take(open_)

    return both.mapInArrow(run, "a long, b long")


def common_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The commonest shingles, sorted, and their places in the order (rarer first)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def often(held: list[np.ndarray]):
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key[n > 1].view(np.int64)), pa.array(n[n > 1], pa.int64())], names=["key", "n"])

        held, size = [], 0
        for batch in batches:
            for sets in _sliced(batch.column(0), words):
                held += sets
                size += sum(map(len, sets))
                if size >= TOGETHER:
                    yield often(held)
                    held, size = [], 0
        if held:
            yield often(held)

    counts = written(docs.select("_text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "counts")
    # a count is looked for from which on the list is short enough; counts fall into at most 8 * 64 steps
    step = F.floor(8 * F.log2("n")).cast("int")
    room, least = COMMON, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("m")).collect(), reverse=True):
        room -= r["m"]
        if room < 0:
            break
        least = r["step"]

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy().tobytes()], pa.binary()) for c in batch.columns], names=["key", "n"])

    top = [] if least is None else counts.where(step >= least).select("key", "n").mapInArrow(pack, "key binary, n binary").collect()
    discard(counts)
    key, n = (np.frombuffer(b"".join(bytes(r[c]) for r in top), dtype=np.int64) for c in (0, 1))
    key = key.view(np.uint64)
    order = np.argsort(key)
    place = np.empty(len(key), dtype=np.int64)
    place[np.lexsort((key, n))] = np.arange(len(key))
    return key[order], place[order]


def sketch(docs: DataFrame, percent: int, words: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per document: id, size n, class, and once per class and task its first shingles and marks."""
    kind = docs.schema["_id"].dataType.simpleString()
    keys, places = common

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: set[int] = set()
        for batch in batches:
            n, cls, first, marks = [], [], [], []
            for s in (s for part in _sliced(batch.column(1), words) for s in part):
                n.append(len(s))
                c = _class_of(s) if len(s) else None
                cls.append(c)
                if c is None or c in seen:
                    first.append(None)
                    marks.append(None)
                    continue
                if len(seen) > 2_000_000:
                    seen.clear()
                seen.add(c)
                marks.append(marks_of(s))
                size = len(s) - -(-percent * len(s) // 100) + 1
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    late = keys[at] == s
                    rare = s[~late]
                    if len(rare) < size:
                        rest = s[late][np.argsort(places[at[late]])]
                        rare = np.concatenate([rare, rest])
                    s = rare
                first.append(s[:size].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                names=["_id", "n", "cls", "first", "marks"],
            )

    return docs.select("_id", "_text").mapInArrow(run, f"_id {kind}, n long, cls long, first array<long>, marks binary")


def sets_of(docs: DataFrame, seen: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(cls, shingles) of the given classes, computed anew from one document of each; a few come twice."""
    kept = seen.join(nodes, "cls", "left_semi").groupBy("cls").agg(F.min(_place_of("_id")).alias("_at"))
    kept = written(kept.select(_mark("cls", "_at")), "kept")
    spread = docs.sparkSession.sparkContext.broadcast(filter_bits(kept))
    discard(kept)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            cls, sets, at = [], [], 0
            for part in _sliced(batch.column(1), words):
                names = np.array([_class_of(s) if len(s) else 0 for s in part], dtype=np.int64)
                place = batch.column(0).slice(at, len(part)).to_numpy()
                at += len(part)
                some = [k for k in hits(spread.value, names ^ place).tolist() if len(part[k])]
                cls.extend(names[some].tolist())
                sets.extend(part[k].view(np.int64) for k in some)
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["cls", "shingles"])

    made = docs.select(_place_of("_id").alias("_at"), "_text").mapInArrow(run, "cls long, shingles array<long>")
    return written(made, "sets")


def _place_of(id_col: str) -> Column:
    return F.xxhash64(id_col)


def _mark(cls: str, at: str) -> Column:
    return F.col(cls).bitwiseXOR(F.col(at)).alias("_mark")


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, inter, total, far): sizes of each pair's intersection and union, and its Jaccard distance; each pair once."""
    pairs = written(pairs.distinct(), "pairs")
    right = pairs.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("_sb")), "b")
    both = right.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("_sa")), "a")
    rows = both.select("a", "b", F.size(F.array_intersect("_sa", "_sb")).alias("inter"), (F.size("_sa") + F.size("_sb")).alias("_n"))
    rows = rows.select("a", "b", "inter", (F.col("_n") - F.col("inter")).alias("total"))
    return written(rows.distinct().withColumn("far", 1 - F.col("inter") / F.col("total")), "distances")


def _most(a: str, b: str) -> Column:
    """Shingles that two members of a region share at most.

    ``i`` is the place of the region's shingle in a class's order, ``r`` how many of the class's shingles up to there
    lie in any other class's first ones: up to there two share no more than either has of those, beyond it no more
    than either has left.
    """
    c = lambda t, x: F.col(f"{t}.{x}")
    return F.least(c(a, "r"), c(b, "r")) + F.least(c(a, "n") - c(a, "i"), c(b, "n") - c(b, "i")) - 1


def _near_enough(a: str, b: str, percent: int) -> Column:
    """Whether size and place let two members be linked."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (_most(a, b) * (100 + percent) >= (n + m) * percent)


def _linked(found: DataFrame, percent: int) -> DataFrame:
    return found.where(F.col("inter") * 100 >= F.col("total") * percent).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()


def first_regions(seen: DataFrame, percent: int) -> DataFrame:
    """(key, cls, n, i, r, before): the members of every region of two classes or more that don't meet elsewhere anyway.

    ``before`` names a class's earlier regions, as far as they are its first ``EARLIER``: what two members can be is
    found out in the first region in which they meet.
    """
    firsts = seen.where("first IS NOT NULL").select("cls", F.col("n").cast("int").alias("n"), F.posexplode("first").alias("i", "key"))
    part = F.pmod(F.shiftright("key", 40), F.lit(TURNS))
    ends = lambda k: firsts.where(part == k).groupBy("key").agg(F.min("cls").alias("_min"), F.max("cls").alias("_max")).where("_min <> _max").select("key")
    shared = reduce(DataFrame.unionByName, [written(ends(k), "shared") for k in range(TURNS)])
    rows = passing(firsts, "key", filter_bits(shared)).join(shared, "key").distinct().withColumn("r", F.row_number().over(Window.partitionBy("cls").orderBy("i")))
    # a linked pair shares at least the percentage of either set
    rows = written(rows.where(100 * (F.col("r") + F.col("n") - F.col("i") - 1) >= percent * F.col("n")), "rows")
    mark = lambda seed: F.bit_xor(F.xxhash64("cls", F.lit(seed)))
    marks = rows.groupBy("key").agg(F.count("*").alias("m"), mark(1).alias("x"), mark(2).alias("y")).where("m > 1")
    once = rows.join(marks.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key"), "key")
    once = once.withColumn("_k", F.row_number().over(Window.partitionBy("cls").orderBy("i")))
    heads = F.collect_list(F.when(F.col("_k") <= EARLIER, F.struct("i", "key"))).over(Window.partitionBy("cls"))
    once = once.withColumn("_heads", heads).withColumn("before", F.transform(F.filter("_heads", lambda x: x["i"] < F.col("i")), lambda x: x["key"]))
    once = written(once.select("key", "cls", "n", "i", "r", "before"), "once")
    # where all members of a region were in another one before, so were all its pairs
    size = once.groupBy("key").agg(F.count("*").alias("m"))
    inside_ = once.select("key", F.explode("before").alias("b")).groupBy("key", "b").agg(F.count("*").alias("m"))
    met = inside_.join(size, ["key", "m"]).select("key").distinct()
    out = written(once.join(met, "key", "left_anti"), "regions")
    discard(once)
    discard(rows, shared)
    return out


def _open(cells: DataFrame, labels: DataFrame, few: DataFrame) -> DataFrame:
    """Rows of the cells in which members of different components are left, with their labels and signatures.

    Also the cell's rows ``m``, its largest component ``core``, and how many rows ``rest`` are of another one.
    """
    now = cells.drop("label", "m", "core", "rest", "s0", "s1", "s2", "s3").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    per = now.groupBy("key", "cell", "label").agg(F.count("*").alias("_c"))
    some = per.groupBy("key", "cell").agg(F.sum("_c").alias("m"), F.max_by("label", F.struct("_c", "label")).alias("core"), F.max("_c").alias("_most"))
    some = some.where("m > _most").select("key", "cell", "m", "core", (F.col("m") - F.col("_most")).alias("rest"))
    return written(now.join(some, ["key", "cell"]).join(few, "cls"), "open")


def divide(cells: DataFrame, sets: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """Voronoi cells of large cells, and the distances to the pivots.

    A member x and a member y of the cell around q, both within ``reach`` of each other, satisfy d(x, q) <= d(x, p) +
    2 reach for every pivot p, and d(x, q) <= reach + the farthest member's distance.  Where both windows hold x is a
    guest of q; guests meet members, not one another.  Of two members of different cells one visits the other's: the
    one of the greater pivot.
    """
    draw = [F.min(F.struct(F.xxhash64("cls", "cell", F.lit(j)).alias("h"), "cls")).alias(f"p{j}") for j in range(PIVOTS)]
    picked = cells.where("home").groupBy("key", "cell").agg(*draw)
    picked = written(picked.select("key", "cell", F.explode(F.array_distinct(F.array(*[F.col(f"p{j}.cls") for j in range(PIVOTS)]))).alias("pivot")), "pivots")
    met = cells.join(picked, ["key", "cell"])
    sets = sets.join(cells.select("cls").distinct(), "cls", "left_semi")
    found = distances(met.where("cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b")), sets)
    far = found.select(F.col("a").alias("pivot"), F.col("b").alias("cls"), "far")
    placed = met.join(far, ["pivot", "cls"], "left").withColumn("far", F.coalesce("far", F.lit(0.0)))
    near = placed.groupBy("key", "cell", "cls").agg(F.min(F.struct("far", "pivot")).alias("near"))
    placed = written(placed.join(near, ["key", "cell", "cls"]), "placed")
    own = F.col("home") & (F.col("pivot") == F.col("near.pivot"))
    radius = placed.where(own).groupBy("key", "cell", "pivot").agg(F.max("far").alias("radius"))
    visits = (F.col("far") <= F.col("near.far") + 2 * reach) & (F.col("far") <= F.col("radius") + reach) & (~F.col("home") | (F.col("pivot") < F.col("near.pivot")))
    out = placed.join(radius, ["key", "cell", "pivot"]).where(own | visits)
    out = out.select("key", F.xxhash64("cell", "pivot").alias("cell"), "cls", "n", "i", "r", "before", own.alias("home"), F.col("far").alias("low"), F.col("far").alias("high"), F.col("m").alias("above"), F.lit(0).alias("turn"))
    return written(out, "cells"), found


def further_stars(cells: DataFrame, percent: int, reach: float) -> DataFrame:
    """Pairs of up to ``PIVOTS`` members of each cell with those of other components, as the cell's windows leave them.

    The fewer of a member's first shingles are its own (``i - r``), the nearer it stands to the others, so such members
    are drawn, one of each part of the cell's by a hash of the class; in the second turn outside the largest component
    only.  Pairs that have met before are let through, as an earlier cell may have drawn others.
    """
    part = F.pmod(F.xxhash64("cls"), F.lit(PIVOTS))
    draw = [F.min(F.when(part == j, F.struct((F.col("i") - F.col("r")).alias("own"), F.xxhash64("cls").alias("h"), "cls"))).alias(f"p{j}") for j in range(PIVOTS)]
    picked = cells.where((F.col("turn") == 0) | (F.col("label") != F.col("core"))).groupBy("key", "cell").agg(*draw)
    picked = picked.select("key", "cell", F.explode(F.array_distinct(F.array(*[F.col(f"p{j}.cls") for j in range(PIVOTS)]))).alias("cls"))
    pivots = cells.join(picked, ["key", "cell", "cls"]).alias("a")
    met = pivots.join(cells.alias("b"), [*_same(), _windows(percent, reach, again=True)])
    return met.select(F.least("a.cls", "b.cls").alias("a"), F.greatest("a.cls", "b.cls").alias("b"))


def inside(cells: DataFrame, percent: int, reach: float) -> DataFrame:
    """Pairs of a cell's members of different components that all windows leave.

    The members of the largest component are compared with the rest, and the rest with itself, in blocks of at most
    ``CELL`` rows each way: what is large in a cell is mostly one component, whose members needn't meet.
    """
    size = lambda n: F.greatest(F.ceil(n / CELL), F.lit(1)).cast("int")
    inner, outer = size(F.col("m") - F.col("rest")), size(F.col("rest"))
    of = lambda blocks: F.pmod(F.xxhash64("cls"), blocks).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), blocks - 1))
    core = F.col("label") == F.col("core")
    kept = [c for c in cells.columns if c not in ("m", "core", "rest")]
    rest = cells.where(~core)
    most = cells.where(core).select(*kept, of(inner).alias("p"), every(outer).alias("q")).alias("a")
    met = most.join(rest.select(*kept, of(outer).alias("q"), every(inner).alias("p")).alias("b"), [*_same("p", "q"), _windows(percent, reach)]).select(F.col("a.cls").alias("x"), F.col("b.cls").alias("y"))

    block = of(outer)
    others = F.transform(F.sequence(F.lit(0), outer - 1), lambda o: F.struct(F.least(block, o).alias("p"), F.greatest(block, o).alias("q")))
    rest = rest.select(*kept, block.alias("block"), F.explode(others).alias("_o")).select(*kept, "block", "_o.p", "_o.q")
    once = (F.col("a.cls") < F.col("b.cls")) | (F.col("a.p") < F.col("a.q"))
    among = rest.where("block = p").alias("a").join(rest.where("block = q").alias("b"), [*_same("p", "q"), once & _windows(percent, reach)])
    met = met.unionByName(among.select(F.col("a.cls").alias("x"), F.col("b.cls").alias("y")))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _same(*blocks: str) -> list[Column]:
    return [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("key", "cell", *blocks)]


def _windows(percent: int, reach: float, again: bool = False) -> Column:
    """Whether two members of a cell may be linked, are in no common component, and meet here first (or ``again``)."""
    triangle = (F.col("a.low") <= F.col("b.high") + reach) & (F.col("b.low") <= F.col("a.high") + reach)
    apart = (F.col("a.label") != F.col("b.label")) & (F.col("a.home") | F.col("b.home"))
    if not again:
        apart = apart & ~F.arrays_overlap("a.before", "b.before")
    # where marks differ so do the sets, by a shingle each at least
    differ = sum((F.bit_count(F.col(f"a.s{k}").bitwiseXOR(F.col(f"b.s{k}"))) for k in range(1, 4)), F.bit_count(F.col("a.s0").bitwiseXOR(F.col("b.s0"))))
    total = F.col("a.n") + F.col("b.n")
    open_ = (total - differ) * (100 + percent) >= 2 * total * percent
    return apart & triangle & _near_enough("a", "b", percent) & open_


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """Per document: id, ``n_shingles`` and ``component_id`` (least id reachable by links)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(text_col).alias("_text"))
    seen = written(sketch(rows, percent, words, common_shingles(rows, words)), "sketch")
    regions = first_regions(seen, percent)
    reach = 1.0 - percent / 100 + 1e-9

    pivots = written(regions.groupBy("key").agg(F.min_by(F.struct("cls", "n", "i", "r"), "cls").alias("p")).select("key", "p.*"), "pivots")
    stars = regions.alias("b").join(pivots.alias("p"), "key").where("b.cls <> p.cls")
    marks = seen.where("marks IS NOT NULL").join(regions.select("cls").distinct(), "cls", "left_semi").select("cls", "n", "marks").dropDuplicates(["cls"])
    marks = written(marks, "marks")
    # first shingles and marks aren't read from here on, and are most of the sketch
    seen, sketched = written(seen.select("_id", "n", "cls"), "classes"), seen
    discard(sketched)
    few = written(signatures(marks), "signatures")
    tried = stars.where(_near_enough("p", "b", percent)).select(F.col("p.cls").alias("a"), F.col("b.cls").alias("b"))
    tried = written(may_link(tried, marks, percent), "stars")
    sets = sets_of(rows, seen, _ends(tried), words)
    found = distances(tried, sets)
    links = written(_linked(found, percent), "links")
    # the distance to the pivot: measured, or an interval from the most that the two can share
    most = F.least(_most("p", "b"), F.col("p.n"), F.col("b.n"))
    bound = stars.select("key", F.col("b.cls").alias("cls"), F.col("p.cls").alias("pivot"), (1 - most / (F.col("p.n") + F.col("b.n") - most)).alias("bound"))
    known = bound.join(found.select(F.col("a").alias("pivot"), F.col("b").alias("cls"), "far"), ["pivot", "cls"], "left")
    known = known.select("key", "cls", F.coalesce("far", "bound").alias("low"), F.coalesce("far", F.lit(1.0)).alias("high"))
    # the pivot itself has been compared with all
    cells = regions.join(known, ["key", "cls"]).select("key", F.lit(0).cast("long").alias("cell"), "cls", "n", "i", "r", "before", F.lit(True).alias("home"), "low", "high", F.lit(None).cast("long").alias("above"), F.lit(0).alias("turn"))
    tried = None
    while True:
        groups = components(links)
        links = joined(groups)  # as few edges as say the same
        left = _open(cells, groups, few)
        whole = (F.col("m") <= CELL) | (2 * F.col("m") > F.coalesce("above", 2 * F.col("m")))
        crowded = left.where(whole & (F.col("rest") > CROWD) & (F.col("turn") < FURTHER))
        settled = left.where(whole & ((F.col("rest") <= CROWD) | (F.col("turn") >= FURTHER)))
        here = written(may_link(inside(settled.drop("above"), percent, reach), marks, percent), "tried")
        large = left.where(~whole)
        if tried is None:  # all that is left to compare is among these
            discard(sets)
            sets = sets_of(rows, seen, reduce(DataFrame.union, [_ends(here), large.select("cls"), crowded.select("cls")]).distinct(), words)
        tried = here if tried is None else tried.union(here)
        none_large, none_crowded = large.isEmpty(), crowded.isEmpty()
        if none_large and none_crowded:
            break
        again = []
        if not none_crowded:
            found = distances(written(may_link(further_stars(crowded, percent, reach), marks, percent), "stars"), sets)
            links = links.union(_linked(found, percent))
            again.append(crowded.select(*cells.columns).withColumn("turn", F.col("turn") + 1))
        if not none_large:
            cells, found = divide(large, sets, reach)
            links = links.union(_linked(found, percent))
            again.append(cells)
        cells, links = reduce(DataFrame.unionByName, again), written(links, "links")
    links = links.union(_linked(distances(tried, sets), percent))
    groups = components(links)

    docs_by = seen.select("_id", "n", "cls").join(groups.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = docs_by.where("label IS NOT NULL").groupBy("label").agg(F.min("_id").alias("_least"))
    out = salted_join(docs_by, least, "label", "_id", "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("_least", "_id").alias("component_id"))
