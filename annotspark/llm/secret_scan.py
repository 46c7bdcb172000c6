"""Secret scans over a trigram inverted index.

From every rule's regular expression a Boolean trigram query is derived: each match must hold, for every clause, all
trigrams of one of the clause's strings.  The index has a posting (trigram, document) for the trigrams that the rules
ask for.  Postings are intersected per document and clause by counting, documents that satisfy a rule's query are its
candidates, and the rule is verified on candidates only.  Rules without a mandatory trigram verify every document.
All of it is DataFrame expressions.

Spans are in code points, end exclusive.  They come from cutting the text at the matches: the lengths of the pieces
and matches before one give its place.

Defined results: null text is the empty text without spans (the digest is that of the empty string); repeated rows
and null ids are scanned each on their own; other columns are ignored; two kinds starting at one place are listed in
rule order; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import let, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``least`` is the code points that ``group`` of a match needs; shorter matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False

    @property
    def scanned(self) -> str:
        """The pattern as scanned: long runs of one class are asked for at once instead of dropped afterwards."""
        m = re.fullmatch(r"(\[[^\]]+\])\+", self.pattern)
        return f"{m[1]}{{{self.least},}}" if m and self.group == 0 and self.least > 1 else self.pattern


RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]+", 0, 32, True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z]{3,10}://[A-Za-z0-9_.-]+:[A-Za-z0-9_.%-]{6,}@"),
]

#: Strings that one stretch of a pattern may stand for, at most, before it is split.
_MOST = 32


def _strings(node) -> set[str] | None:
    """The exact strings of one parsed element, lower-cased, or None when they are too many to list."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        out = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < _MOST:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 3:
        one = _sequence(arg[2])
        if one is None:
            return None
        out, now = set(), {""}
        for k in range(arg[1] + 1):
            if k >= arg[0]:
                out |= now
            now = {a + b for a in now for b in one}
        return out if len(out) <= _MOST else None
    return None


def _sequence(nodes) -> set[str] | None:
    now = {""}
    for node in nodes:
        one = _strings(node)
        if one is None or len(now) * len(one) > _MOST:
            return None
        now = {a + b for a in now for b in one}
    return now


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """AND of clauses, each an OR of strings, each given by its trigrams (lower-cased; empty when none is mandatory)."""
    clauses: list[set[str]] = []

    def walk(nodes) -> None:
        now: set[str] = {""}
        for node in [*nodes, (None, None)]:
            one = _strings(node)
            if one is not None and len(now) * len(one) <= _MOST:
                now = {a + b for a in now for b in one}
                continue
            if min(map(len, now)) >= 3:
                clauses.append(now)
            now = one or {""}
            op, arg = node
            if one is None and op is sre.SUBPATTERN:
                walk(arg[-1])
            elif one is None and op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                walk(arg[2])

    walk(_parser.parse(pattern))
    return [[sorted({s[i : i + 3] for i in range(len(s) - 2)}) for s in sorted(c)] for c in clauses]


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """(row key, trigram) for the given trigrams that the lower-cased text holds."""
    held = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return rows.select("_key", F.lower("_text").alias("_low")).select("_key", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, queries: dict[int, list[list[list[str]]]]) -> DataFrame:
    """(row key, mask): bit ``k`` is set where the postings satisfy query ``k``.

    The queries are a literal table, joined by trigram.  Its size is that of the rule list.
    """
    spark = index.sparkSession
    terms = [
        (k, 1 << k, len(q), c, a, t, len(alt)) for k, q in queries.items() for c, clause in enumerate(q) for a, alt in enumerate(clause) for t in alt
    ]
    table = spark.createDataFrame(terms, "rule int, bit long, clauses int, clause int, alt int, trigram string, need int")
    met = index.join(F.broadcast(table), "trigram").groupBy("_key", "rule", "bit", "clauses", "clause", "alt", "need")
    strings = met.agg(F.countDistinct("trigram").alias("n")).where("n = need")
    rules = strings.groupBy("_key", "rule", "bit", "clauses").agg(F.countDistinct("clause").alias("n")).where("n = clauses")
    return rules.groupBy("_key").agg(F.bit_or("bit").alias("_mask"))


def _before(sizes: Column) -> Column:
    """Exclusive running sums of an array, in steps of about its length to the power 3/2."""

    def run(x: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(x))).cast("int")

        def blocks(b: Column) -> Column:
            sums = F.transform(F.sequence(F.lit(0), F.size(x).cast("int"), b), lambda s: F.aggregate(F.slice(x, s + 1, b), F.lit(0), lambda t, v: t + v))
            return let(
                sums,
                lambda p: F.transform(
                    x,
                    lambda v, i: F.aggregate(F.slice(p, F.lit(1), F.floor(i / b).cast("int")), F.lit(0), lambda t, u: t + u)
                    + F.aggregate(F.slice(x, F.floor(i / b).cast("int") * b + 1, i % b), F.lit(0), lambda t, u: t + u),
                ),
            )

        return F.when(F.size(x) == 0, F.array().cast("array<int>")).otherwise(let(step, blocks))

    return let(sizes, run)


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """array<struct<start, kind, end>> of the rule's matches in the text."""
    pattern = F.lit(rule.scanned)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    pieces = F.split(text, rule.scanned, -1)
    rows = F.zip_with(found, judged, lambda m, g: F.struct(F.length(m).alias("n"), F.length(g).alias("g")))
    steps = lambda m: F.transform(m, lambda x, i: x["n"])

    def placed(m: Column) -> Column:
        gaps = F.transform(F.slice(pieces, F.lit(1), F.size(m)), F.length)
        moves = F.zip_with(gaps, steps(m), lambda a, b: a + b)
        starts = F.zip_with(_before(moves), gaps, lambda a, b: a + b)
        return F.zip_with(starts, m, lambda s, x: F.struct(s.alias("start"), F.lit(number).alias("kind"), (s + x["n"]).alias("end"), x["g"].alias("g")))

    kept = F.filter(let(rows, placed), lambda x: x["g"] >= rule.least)
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``spans`` array<struct<start, kind, end>> sorted, kind being the rule's number, and the text."""
    queries = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), text_or_empty(text_col).alias("_text"))
    rows = rows.withColumn("_key", F.xxhash64(id_col, "_text"))
    asked = sorted({t for q in queries.values() for c in q for alt in c for t in alt})
    mask = candidates(postings(rows, asked), queries)
    joined = rows.join(mask, "_key", "left").withColumn("_mask", F.coalesce("_mask", F.lit(0)))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    found = []
    for k, rule in enumerate(rules):
        due = F.col("_mask").bitwiseAND(F.lit(1 << k)) != 0 if k in queries else F.lit(True)
        found.append(F.when(due & F.col("_text").rlike(rule.scanned), spans_of(F.col("_text"), rule, k)).otherwise(none))
    spans = F.sort_array(F.concat(*found))
    return joined.select(id_col, F.col("_text").alias(text_col), spans.alias("spans"))


def shown(spans: Column, rules: list[Rule] = RULES) -> Column:
    """kind:start:end, comma-joined in order."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"], x["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch of overlapping spans replaced by the mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done, x):
        new = F.concat(done["parts"], F.array(F.substring(text, done["at"] + 1, x["start"] - done["at"]), F.lit(mark)))
        parts = F.when(x["start"] >= done["at"], new).otherwise(done["parts"])
        return F.struct(F.greatest(done["at"], x["end"]).alias("at"), parts.alias("parts"))

    whole = F.aggregate(spans, start, step, lambda d: F.concat(F.array_join(d["parts"], ""), F.substring(text, d["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)
