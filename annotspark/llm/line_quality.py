"""Document quality by a linear-chain conditional random field over lines.

A line (a part between line feeds with a word in it) is good or bad.  Its features are shares of kinds of characters,
word lengths and repetitions, as steps of a few thresholds, and the same of the lines before and behind it; transition
weights join neighbouring labels.  Forward and backward passes give every line the probability of being good, and a
document's score comes from the length-weighted mean of these and of their logarithms.

Only documents are labelled.  Training starts with lines that have their document's label; then the model tells which
lines of bad documents are bad (lines of good documents stay good, and the worst line of a bad one stays bad) and is
fitted again, ``ROUNDS`` times.  Last a logistic curve over the two means is fitted to the documents' labels.  Training
takes at most ``FIT_DOCUMENTS`` labelled documents, half of either label as far as there are as many, those of the least
hash, and of those the ones of at most ``FIT_LINES`` lines, up to ``FIT_TOTAL`` lines; scores cover all lines of all documents.

Defined results: null, empty and blank texts have no lines and get the share of good ones among the labelled documents
that have none, one added to either; without labelled documents of both labels all scores are a half; rows with a null
or another label than 0 and 1 are not learned from; repeated rows are scored each on their own; a document with several
labels is learned once for each; null ids and extra columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import text_or_empty
from annotspark.llm.periodic_runs import slices

#: Labelled documents, and lines of one of them, that training takes at most.
FIT_DOCUMENTS = 6000
FIT_LINES = 500
#: Lines that training takes at most in all.
FIT_TOTAL = 100_000
ROUNDS = 2
#: Kinds of characters whose shares are measured.
_KINDS = ("upper", "lower", "digit", "symbol", "bang", "bar", "stop", "high")
#: Steps of each measure.
STEPS = {
    "upper": (0.05, 0.15, 0.4, 0.7),
    "digit": (0.02, 0.1, 0.3),
    "symbol": (0.005, 0.03, 0.1, 0.3),
    "bang": (0.005, 0.02, 0.1),
    "bar": (0.005, 0.02, 0.08),
    "stop": (0.004, 0.02, 0.05, 0.12),
    "high": (0.01, 0.05, 0.15, 0.5),
    "length": (2.0, 3.5, 5.0, 6.5, 8.0),
    "longest": (2.5, 3.2, 4.0, 5.0),
    "again": (0.02, 0.1, 0.3, 0.7),
    "distinct": (0.2, 0.4, 0.6, 0.8, 0.95),
    "twin": (0.5,),
    "spread": (1.0, 2.0, 3.0, 4.0),
}
MEASURES = tuple(STEPS)


def _kinds() -> np.ndarray:
    of = np.zeros((256, len(_KINDS)), dtype=np.int64)
    put = lambda kind, chars: of.__setitem__((list(chars), _KINDS.index(kind)), 1)
    put("upper", range(65, 91))
    put("lower", range(97, 123))
    put("digit", range(48, 58))
    put("symbol", b"#*$%&<>@^~_=+\\{}[]")
    put("bang", b"!?")
    put("bar", b"|")
    put("stop", b".,;:")
    put("high", range(128, 256))
    return of


_KIND = _kinds()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def _line_measures(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(measures, weight) of the lines of joined texts, and how many lines stand before each text."""
    n = len(data)
    own = ~_SPACE[data]
    head = np.zeros(n, dtype=bool)
    head[bounds[:-1][bounds[:-1] < n]] = True
    head[1:] |= data[:-1] == 10
    begin = own.copy()
    begin[1:] &= ~own[:-1] | head[1:]
    words = np.flatnonzero(begin)
    line_of_byte = np.cumsum(head) - 1
    full, words_in = np.unique(line_of_byte[words], return_counts=True)
    starts = np.flatnonzero(head)[full]
    m = len(full)
    before = np.searchsorted(starts, bounds)
    if not m:
        return np.zeros((0, len(MEASURES))), np.zeros(0), before
    ends = np.append(np.flatnonzero(head), n)[full + 1]
    letters = np.cumsum(np.concatenate([[0], own]))
    size = (letters[ends] - letters[starts]).astype(np.float64)
    shares = np.empty((m, len(_KINDS)))
    for k in range(len(_KINDS)):
        total = np.cumsum(np.concatenate([[0], _KIND[data, k]]))
        shares[:, k] = (total[ends] - total[starts]) / size
    # words: their lengths, hashes of their bytes, and what they repeat
    stop = np.append(words[1:], n)
    length = letters[stop] - letters[words]
    at = np.flatnonzero(own)
    place = (at - np.repeat(words, length)).astype(np.uint64)
    h = np.add.reduceat(_mix((data[at].astype(np.uint64) + np.uint64(1)) * _ODD + place * np.uint64(0xC2B2AE3D27D4EB4F)), np.cumsum(length) - length)
    first = np.cumsum(words_in) - words_in
    line = np.repeat(np.arange(m), words_in)
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    again = np.add.reduceat(same, first, dtype=np.int64) / words_in
    order = np.lexsort((h, line))
    new = np.ones(len(words), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (line[order][1:] != line[order][:-1])
    # of the first 64 words of a line at most as many are different: long lines have fewer different words anyway
    distinct = np.minimum(np.add.reduceat(new, first, dtype=np.int64), 64) / np.minimum(words_in, 64)
    mean = size / words_in
    longest = np.sqrt(np.maximum.reduceat(length, first).astype(np.float64))
    spread = np.sqrt(np.maximum(np.add.reduceat(length.astype(np.float64) ** 2, first) / words_in - mean**2, 0))
    # lines that stand twice in their text
    whole = _mix(np.add.reduceat(_mix(h + (np.arange(len(words)) - np.repeat(first, words_in)).astype(np.uint64) * _ODD), first))
    doc = np.searchsorted(bounds, starts, side="right")
    order = np.lexsort((whole, doc))
    eq = (whole[order][1:] == whole[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twin = np.zeros(m)
    twin[order[1:][eq]] = 1
    twin[order[:-1][eq]] = 1
    kind = {k: shares[:, i] for i, k in enumerate(_KINDS)}
    found = kind | {"length": mean, "longest": longest, "again": again, "distinct": distinct, "twin": twin, "spread": spread}
    return np.stack([found[k] for k in MEASURES], axis=1), size, before


def _steps(measures: np.ndarray) -> np.ndarray:
    """Measures as 0 and 1: whether each reaches each of its steps."""
    return np.concatenate([measures[:, [k]] >= np.array(STEPS[c]) for k, c in enumerate(MEASURES)], axis=1).astype(np.float64)


def features(measures: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A line's steps, those of its neighbours in the same document, whether it has any, and a constant."""
    own = _steps(measures)
    m, width = own.shape
    out = np.zeros((m, 3 * width + 3))
    out[:, :width] = own
    first, last = np.zeros(m + 1, dtype=bool), np.zeros(m + 1, dtype=bool)
    first[before] = True
    last[:-1] = first[1:]
    last[m - 1 :] = True
    first, last = first[:m], last[:m]
    later, sooner = np.flatnonzero(~first), np.flatnonzero(~last)
    out[later, width : 2 * width] = own[later - 1]
    out[sooner, 2 * width : 3 * width] = own[sooner + 1]
    out[:, -3], out[:, -2], out[:, -1] = first, last, 1
    return out


class Field:
    """A chain over two labels, bad (0) and good (1): one weight a feature for good, and four transitions."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def passes(self, emit: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per line the probability of good, and per line that of each pair with the line before it (2 x 2, flat).

        Chains are walked side by side, place by place, longest first; each step is scaled to sum to one.
        """
        size = np.diff(before)
        order = np.argsort(-size, kind="stable")
        start, size = before[:-1][order], size[order]
        m = len(emit)
        node = np.stack([np.ones(m), np.exp(np.clip(emit, -50, 50))], axis=1)
        node /= node.sum(axis=1, keepdims=True)
        step = np.exp(self.moves - self.moves.max())
        ahead, behind = node.copy(), np.ones((m, 2))
        alive = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1 if len(size) else 1), side="right")
        for t in range(1, len(alive)):
            at = start[: alive[t]] + t
            x = (ahead[at - 1] @ step) * node[at]
            ahead[at] = x / x.sum(axis=1, keepdims=True)
        for t in range(len(alive) - 1, 0, -1):
            at = start[: alive[t]] + t
            x = (behind[at] * node[at]) @ step.T
            behind[at - 1] = x / x.sum(axis=1, keepdims=True)
        one = ahead * behind
        one /= one.sum(axis=1, keepdims=True)
        pairs = np.zeros((m, 4))
        later = np.ones(m, dtype=bool)
        later[start[size > 0]] = False
        at = np.flatnonzero(later)
        two = ahead[at - 1][:, :, None] * step[None] * (node[at] * behind[at])[:, None, :]
        pairs[at] = two.reshape(-1, 4) / two.sum(axis=(1, 2))[:, None]
        return one[:, 1], pairs

    def good(self, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        return self.passes(x @ self.weights, before)[0]


def fit_field(x: np.ndarray, before: np.ndarray, labels: np.ndarray, weight: np.ndarray, start: Field | None = None, rounds: int = 120, decay: float = 1e-3) -> Field:
    """The field of greatest weighted likelihood, by gradient steps of adapted size; ``weight`` is one for each chain."""
    m, width = x.shape
    field = start or Field(np.zeros(width), np.zeros((2, 2)))
    of = np.repeat(weight, np.diff(before))
    theta = np.concatenate([field.weights, field.moves.ravel()])
    later = np.ones(m, dtype=bool)
    later[before[:-1][np.diff(before) > 0]] = False
    at = np.flatnonzero(later)
    seen = np.zeros((m, 4))
    seen[at, 2 * labels[at - 1] + labels[at]] = 1
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    total = of.sum()
    for r in range(1, rounds + 1):
        field = Field(theta[:width], theta[width:].reshape(2, 2))
        one, pairs = field.passes(x @ field.weights, before)
        slope = np.concatenate([(of * (one - labels)) @ x, of @ (pairs - seen)]) / total + decay * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta - 0.1 * (first / (1 - 0.9**r)) / (np.sqrt(second / (1 - 0.99**r)) + 1e-8)
    return Field(theta[:width], theta[width:].reshape(2, 2))


def _means(good: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Per document with lines: length-weighted mean of the probabilities, and of their log odds, and a constant."""
    starts = before[:-1][np.diff(before) > 0]
    if not len(starts):
        return np.zeros((0, 3))
    total = np.add.reduceat(size, starts)
    odds = np.clip(np.log(np.maximum(good, 1e-12) / np.maximum(1 - good, 1e-12)), -8, 8)
    return np.stack([np.add.reduceat(size * good, starts) / total, np.add.reduceat(size * odds, starts) / total, np.ones(len(starts))], axis=1)


def _curve(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's steps, slightly drawn to zero."""
    b = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ b))
        slope = z.T @ (weight * (p - y)) + 1e-2 * b
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(b))
        b = b - np.linalg.solve(bend, slope)
    return b


class Model:
    """A fitted field with the curve that turns means into scores."""

    def __init__(self, field: Field | None, curve: np.ndarray | None, empty: float):
        self.field, self.curve, self.empty = field, curve, empty

    def scores(self, measures: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
        out = np.full(len(before) - 1, self.empty)
        if self.field is None or not len(measures):
            return out if self.field is not None else np.full(len(before) - 1, 0.5)
        good = self.field.good(features(measures, before), before)
        out[np.diff(before) > 0] = 1 / (1 + np.exp(-_means(good, size, before) @ self.curve))
        return out


def fit(measures: np.ndarray, size: np.ndarray, before: np.ndarray, y: np.ndarray, stand_for: np.ndarray) -> Model:
    """A model from labelled documents, each of the same weight in the field, whatever its lines; ``stand_for`` says for how
    many labelled documents one of the sample stands, of label 0 and 1, so that scores are for the labels' true shares."""
    lines = np.diff(before)
    none = y[lines == 0]
    empty = (none.sum() + 1) / (len(none) + 2)
    full = np.flatnonzero(lines > 0)
    y = y[full]
    if not len(y) or y.min() == y.max():
        return Model(None, None, 0.5)
    before = np.concatenate([[0], np.cumsum(lines[full])])
    x = features(measures, before)
    weight = 1 / np.diff(before)
    labels = np.repeat(y, np.diff(before))
    field = fit_field(x, before, labels, weight)
    bad = np.repeat(y == 0, np.diff(before))
    for _ in range(ROUNDS):
        # emissions alone: the chain would give a bad document's lines the label that they were trained with
        own = 1 / (1 + np.exp(-(x @ field.weights)))
        worst = np.minimum.reduceat(own, before[:-1])
        labels = np.where(bad, ((own > 0.5) & (own > np.repeat(worst, np.diff(before)))).astype(np.int64), 1)
        field = fit_field(x, before, labels, weight, field, rounds=60)
    return Model(field, _curve(_means(field.good(x, before), size, before), y.astype(np.float64), np.ones(len(y))), empty)


def _measured(rows: DataFrame, columns: str) -> DataFrame:
    """(columns, n_lines, measures, sizes): the lines of ``_text`` as bytes of floats, beside the given columns."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n, measures, sizes = [], [], []
            for data, bounds in slices(batch.column(batch.schema.get_field_index("_text"))):
                x, size, before = _line_measures(data, bounds)
                n += np.diff(before).tolist()
                few = [(a, b) if b - a <= FIT_LINES else (a, a) for a, b in zip(before[:-1].tolist(), before[1:].tolist())]
                measures += [x[a:b].astype("<f4").tobytes() for a, b in few]
                sizes += [size[a:b].astype("<f4").tobytes() for a, b in few]
            kept = [c for c, name in zip(batch.columns, batch.schema.names) if name != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n, pa.int64()), pa.array(measures, pa.binary()), pa.array(sizes, pa.binary())], names=[*[c for c in batch.schema.names if c != "_text"], "n_lines", "measures", "sizes"]
            )

    return rows.mapInArrow(run, f"{columns}, n_lines long, measures binary, sizes binary")


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from the labelled documents that ``learn``, a condition on ``id``, names."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)").where(learn)
    counts = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = [min(FIT_DOCUMENTS // 2, counts.get(y, 0)) for y in (0, 1)]
    share = [max(share[y], min(counts.get(y, 0), FIT_DOCUMENTS - share[1 - y])) for y in (0, 1)]
    picked = [marked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(share[y]) for y in (0, 1)]
    # at most FIT_DOCUMENTS rows of an id and a label
    picked = F.broadcast(picked[0].union(picked[1]))
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("_text")).join(picked, "id").select("id", "y", "_text")
    kind = docs.schema[id_col].dataType.simpleString()
    found = _measured(rows, f"id {kind}, y int").where(F.col("n_lines") <= FIT_LINES)
    # an id that stands in many rows doesn't make the sample larger
    found = found.orderBy(F.xxhash64("id"), "id", F.xxhash64("measures")).limit(FIT_DOCUMENTS).collect()
    take, total = [], 0
    for r in found:
        total += r["n_lines"]
        if total > FIT_TOTAL:
            break
        take.append(r)
    y = np.array([r["y"] for r in take], dtype=np.int64)
    before = np.concatenate([[0], np.cumsum([r["n_lines"] for r in take])]).astype(np.int64)
    measures = np.frombuffer(b"".join(bytes(r["measures"]) for r in take), dtype="<f4").reshape(-1, len(MEASURES)).astype(np.float64)
    size = np.frombuffer(b"".join(bytes(r["sizes"]) for r in take), dtype="<f4").astype(np.float64)
    got = np.bincount(y, minlength=2)
    return fit(measures, size, before, y, np.array([counts.get(k, 0) / max(1, got[k]) for k in (0, 1)]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``score`` and ``n_lines``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            scores, lines = [np.zeros(0)], [np.zeros(0, dtype=np.int64)]
            for data, bounds in slices(batch.column(1)):
                x, size, before = _line_measures(data, bounds)
                scores.append(model.scores(x, size, before))
                lines.append(np.diff(before))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores)), pa.array(np.concatenate(lines))], names=[id_col, "score", "n_lines"])

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("_text")).mapInArrow(run, f"{id_col} {kind}, score double, n_lines long")


def held_out(id_: Column) -> Column:
    """Whether an id is kept from training: crc32 of its decimal digits, modulo 3, is 1."""
    return F.crc32(id_.cast("string").cast("binary")) % 3 == 1
