"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one failure bit per rule.
Policies are versioned bit masks applied to the ledger afterwards, and ablations are bitwise aggregations of the
stored bits: the text is never read again.

Defined results: null or empty text counts as no words (fails ``few_words``); repeated rows are judged each on
their own; null in any other column is carried through; an empty table gives an empty ledger; extra columns of the
input (also ones named like a measurement) are ignored by :func:`ledger`.  Measurements are exact over whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import SPACES, let, text_or_empty

#: Rules in bit order: name -> SQL predicate over the measurements, true when the document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "shouting": "2 * n_exclaim > n_words",
    "mostly_capitals": "2 * n_capitals > word_chars",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "odd_word_length": "word_chars > 25 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}

#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, list[str]] = {
    "v1": ["few_words", "repeated_words"],
    "v2": list(RULES),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclaim", "n_capitals"]


def mask_of(policy: str | list[str]) -> int:
    return sum(BIT[r] for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def _repeat_words(windows: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    Windows are sorted with their positions; a window equal to a neighbour in that order is a repeat.
    """

    def marked(pairs: Column) -> Column:
        hits = F.transform(
            pairs,
            lambda p, k: F.when((p["w"] == F.get(pairs, k - 1)["w"]) | (p["w"] == F.get(pairs, k + 1)["w"]), p["i"]),
        )
        return F.transform(F.array_compact(hits), lambda i: F.array(i, i + 1, i + 2))

    pairs = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    return F.size(F.array_distinct(F.flatten(let(pairs, marked))))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and all measurements."""
    blank = f"[{SPACES}]+"
    base = docs.select(F.col(id_col), text_or_empty(text_col).alias("_t"))
    staged = base.select(
        id_col,
        F.length(F.regexp_replace("_t", blank, "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_t", F.lit("!")).cast("long").alias("n_exclaim"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.array_remove(F.split("_t", blank), "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{SPACES}]")).alias("_l"),
    )
    staged = staged.select(
        "*",
        F.size("_w").cast("long").alias("n_words"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("_w") >= 4,
            let(
                F.col("_w"),
                lambda w: F.transform(
                    F.sequence(F.lit(1), F.size(w) - 2),
                    lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)),
                ),
            ),
        ).alias("_g"),
    )
    repeats = F.when(F.col("_g").isNull(), F.lit(0)).otherwise(_repeat_words(F.col("_g")))
    return staged.select(id_col, *[m for m in MEASURES if m != "n_repeat_words"], repeats.cast("long").alias("n_repeat_words"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus ``fail_bits``: bit i is set when rule i fails."""
    bits = None
    for name, predicate in RULES.items():
        one = F.when(F.expr(predicate), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long")
        bits = one if bits is None else bits.bitwiseOR(one)
    return measure(docs, id_col, text_col).withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, policy: str | list[str], out: str = "kept") -> DataFrame:
    """``out`` is true where no rule of the policy failed."""
    return book.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy))) == 0)


def ablation(book: DataFrame, policy: str | list[str]) -> DataFrame:
    """Per rule of the policy: documents failing it, rejected by it alone, and kept when it is left out.

    The documents are first counted by bit pattern (at most 2**rules rows), then combined with the rules.
    """
    mask = mask_of(policy)
    names = POLICIES[policy] if isinstance(policy, str) else policy
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("_p")).agg(F.count("*").alias("_n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in names]))
    rows = patterns.select("_p", "_n", rules.alias("_r")).select("_p", "_n", "_r.rule", "_r.bit")
    rest = F.col("_p").bitwiseAND(F.bitwise_not(F.col("bit")))
    failed = F.col("_p").bitwiseAND(F.col("bit")) != 0
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0)).cast("long")
    return rows.groupBy("rule").agg(
        total(failed).alias("n_failed"), total(failed & (rest == 0)).alias("n_only_this"), total(rest == 0).alias("n_kept_without")
    )


def only_rule(policy: str | list[str]) -> Column:
    """The rule of the policy that alone rejects a document, which would stay without it; null for all others."""
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy)))
    out = None
    for name in POLICIES[policy] if isinstance(policy, str) else policy:
        out = F.when(bits == BIT[name], name) if out is None else out.when(bits == BIT[name], name)
    return out


def select_documents(docs: DataFrame, policy: str = "v2", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that pass the policy, with their own columns: judged row by row, without a join."""
    cols = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.col(text_col).alias("_text"))
    judged = apply_policy(ledger(packed, "_row", "_text"), policy, "_kept")
    return judged.where("_kept").select(*[F.col("_row").getField(c).alias(c) for c in cols])


#: The ledger query in DuckDB's dialect.
ORACLE = r"""
WITH b AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  length(t) - length(replace(t, '!', '')) AS n_exclaim,
  length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_capitals,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM b),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
  unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM m WHERE len(w) >= 4),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
q AS (SELECT m.doc_id, len(w) AS n_words, word_chars, n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
  coalesce(c.n, 0) AS n_repeat_words, len(l) AS n_lines, n_exclaim, n_capitals FROM m LEFT JOIN c ON c.doc_id = m.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * n_exclaim > n_words
    OR 2 * n_capitals > word_chars OR 2 * n_dup_lines > n_lines OR word_chars > 25 * n_words) AS kept,
  CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 2 * n_exclaim > n_words THEN 8 ELSE 0 END)
    + (CASE WHEN 2 * n_capitals > word_chars THEN 16 ELSE 0 END) + (CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END)
    + (CASE WHEN word_chars > 25 * n_words THEN 64 ELSE 0 END) AS BIGINT) AS fail_bits FROM q
"""
_NAMED = " ".join(f"WHEN {BIT[name]} THEN '{name}'" for name in POLICIES["v2"])
ORACLE = f"SELECT *, CASE fail_bits {_NAMED} END AS only_rule FROM ({ORACLE}) judged"
