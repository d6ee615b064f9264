"""Operator 3: quality rules with a failure-bit ledger.  DataFrame functions only.

Every rule is evaluated once.  The ledger keeps, for each row, the
measurements and one integer whose bit b tells that rule b failed.  A policy is
a versioned mask over those bits: a row is kept if no masked bit is set.  New
policies and the rules' ablations (what each rule alone rejects) are bitwise
work on the ledger; no text is read again.

Defined results: a null or empty text has no words, fails ``few_words`` and is
not kept.  Null or repeated ``doc_id``: each row is judged by itself.  Words
are runs of characters outside space and \\x09-\\x0D; five-word windows are
compared by 64-bit hashes within one text.  Columns other than ``doc_id`` and
``text`` are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import text_of, words_of

WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclaim"]


@dataclass(frozen=True)
class Rule:
    """A row fails if the condition on the measurements holds (whole-number arithmetic)."""
    name: str
    fails: str


#: Bit b belongs to rule b; new rules go to the end, so stored ledgers stay valid.
RULES = [
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "2 * n_symbols > n_words"),
    Rule("exclaiming", "n_words >= 10 AND 2 * n_exclaim > n_words"),
    Rule("repeated_lines", "n_lines >= 6 AND 2 * n_dup_lines > n_lines"),
    Rule("word_length", "n_words >= 10 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
]
BIT = {rule.name: 1 << b for b, rule in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]

#: Policy version -> mask of the rules that it applies.
POLICIES = {1: BASE, 2: sum(BIT.values())}
POLICY = 2


def _repeat_words(words: str, hashes: str) -> Column:
    """Words inside windows that occur twice or more, from the windows' hashes.

    Windows are sorted by (hash, place); one with an equal neighbour is
    repeated.  The places, sorted again, cover five words each, less where the
    next one begins earlier.
    """
    pairs = f"sort_array(transform({hashes}, (h, i) -> struct(h, i)))"
    places = f"""
      aggregate(array({pairs}), cast(array() as array<int>), (acc, s) ->
        sort_array(transform(filter(s, (p, k) ->
          (k > 0 AND s[k - 1].h = p.h) OR (k < size(s) - 1 AND s[k + 1].h = p.h)), p -> p.i)))"""
    covered = f"""
      aggregate(array({places}), 0L, (acc, q) -> cast(aggregate(transform(q, (i, k) ->
        if(k = size(q) - 1, {WINDOW}, least({WINDOW}, q[k + 1] - i))), 0, (a, x) -> a + x) as bigint))"""
    return F.expr(f"""
      CASE WHEN size({words}) <= {WINDOW} OR size(array_distinct({hashes})) = size({hashes}) THEN 0L
           ELSE {covered} END""")


def measure(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), then the rules' measurements."""
    keep = ["doc_id"] if keep is None else keep
    kept = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    names = [f"keep_{i}" for i in range(len(keep))]
    split = docs.select(*kept, text_of().alias("t")).select(*names, "t", words_of(F.col("t")).alias("w"))
    hashed = split.select(
        *names, F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        ((F.length("t") - F.length(F.replace("t", F.lit("!!")))) / 2).cast("long").alias("n_exclaim"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("l"),
        "w",
        F.expr(f"CASE WHEN size(w) < {WINDOW} THEN cast(array() as array<bigint>) ELSE transform(sequence(0, size(w) - {WINDOW}), "
               f"i -> xxhash64({', '.join(f'w[i + {k}]' for k in range(WINDOW))})) END").alias("h"))
    return hashed.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], "n_words", "word_chars", "n_symbols",
        F.size("l").cast("long").alias("n_lines"), (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _repeat_words("w", "h").alias("n_repeat_words"), "n_exclaim")


def ledger(docs: DataFrame, keep: list[str] | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """Measurements and ``failure_bits``."""
    rules = RULES if rules is None else rules
    bits = F.lit(0).cast("long")
    for b, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << b).cast("long")).otherwise(F.lit(0).cast("long")))
    # the row number keeps the optimiser from moving later filters below the ledger, where each rule would measure the text anew
    once = F.when(F.monotonically_increasing_id() >= 0, F.lit(-1).cast("long"))
    return measure(docs, keep).withColumn("failure_bits", bits.bitwiseAND(once))


def passes(mask: int, bits: str = "failure_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask).cast("long")) == 0


def apply_policies(rows: DataFrame, policies: dict[int, int]) -> DataFrame:
    """One column ``kept_v<version>`` for each policy, from stored bits."""
    return rows.select("*", *[passes(mask).alias(f"kept_v{v}") for v, mask in policies.items()])


def ablations(rows: DataFrame, mask: int, rules: list[Rule] | None = None) -> DataFrame:
    """For each rule of the mask: rows that fail it, and rows that only it rejects."""
    rules = RULES if rules is None else rules
    used = [(b, r) for b, r in enumerate(rules) if mask >> b & 1]
    bits = F.col("failure_bits").bitwiseAND(F.lit(mask).cast("long"))
    counts = [F.count_if(bits.bitwiseAND(F.lit(1 << b).cast("long")) != 0).alias(f"f{b}") for b, _ in used]
    alone = [F.count_if(bits == (1 << b)).alias(f"o{b}") for b, _ in used]
    found = rows.agg(F.count("*").alias("n_rows"), *counts, *alone)
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.col("n_rows"), F.col(f"f{b}").alias("n_failed"), F.col(f"o{b}").alias("n_only"))
        for b, r in used])))


def reject(docs: DataFrame, version: int = POLICY) -> DataFrame:
    """The rows that the policy keeps, with all their columns."""
    columns = list(docs.columns)
    judged = ledger(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").alias("text")), keep=["row"])
    return judged.where(passes(POLICIES[version])).select(*[F.col("row")[c].alias(c) for c in columns])


def verdicts(docs: DataFrame, version: int = POLICY) -> DataFrame:
    rows = ledger(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~passes(BASE)).alias("base_failed"), passes(POLICIES[version] | BASE).alias("kept"), "failure_bits")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
c AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g) WHERE n >= 2),
p AS (SELECT r, count(DISTINCT i + k) AS n FROM c, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words,
             CAST((length(t) - length(replace(t, '!!', ''))) // 2 AS BIGINT) AS n_exclaim
      FROM w LEFT JOIN p USING (r)),
f AS (SELECT *, CAST(CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 2 * n_symbols > n_words THEN 4 ELSE 0 END
             + CASE WHEN n_words >= 10 AND 2 * n_exclaim > n_words THEN 8 ELSE 0 END
             + CASE WHEN n_lines >= 6 AND 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END
             + CASE WHEN n_words >= 10 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) THEN 32 ELSE 0 END AS BIGINT) AS failure_bits
      FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failure_bits & 3 <> 0 AS base_failed, failure_bits = 0 AS kept, failure_bits FROM f
"""
