"""Operator 2: secret scans.  DataFrame functions only.

Three fixed patterns give the base spans.  Beyond them, every run of at least
``WINDOW`` characters of the key alphabets is a candidate: a window slides over
it, the counts of its characters change by the one that enters and the one that
leaves, and so does the sum behind its Shannon entropy.  A run is a span of
kind ``entropy`` if a window of it, or of a stretch of a smaller class within
it, reaches that class's limit (hexadecimal digits of either case; letters of
one case and digits; letters, digits and signs), unless an allow-list pattern
covers it.  Base spans and placeholders are cut out of a run first and what is
left on either side is judged by itself; a piece shorter than a window, left
beside a hex span, is one if the run reaches the limit as a whole.

Positions come from the text between the matches: a match starts after all
earlier matches and gaps.  Only texts that hold a match are cut that way.

Defined results: a null or empty text has no spans.  Null or repeated
``doc_id``: one row out for each row in.  Positions are code points, the end is
exclusive.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import text_of

#: Kind, pattern of a match, pattern that tells whether there may be one, group and least length.
PATTERNS = [
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24,}+", 0, 24),
]
KINDS = ["assign", "access", "hex", "entropy"]
WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}+"
#: Class -> its alphabet and the least entropy (bits) of a window; hex and single are judged in lower case.
CLASSES = {"hex": ("0123456789abcdef", 2.9),
           "single": ("0123456789abcdefghijklmnopqrstuvwxyz", 3.4),
           "key": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.8)}
#: Class -> its stretches within a run (base32 in either case is among single); key is the run as a whole.
STRETCHES = {"hex": f"[0-9A-Fa-f]{{{WINDOW},}}+", "single": f"[0-9A-Z]{{{WINDOW},}}+|[0-9a-z]{{{WINDOW},}}+"}
#: Runs that are no secrets: no digit or no letter, words joined by signs, dotted names, placeholders.
ALLOWED = [r"^[^0-9]*$", r"^[^A-Za-z]*$", r"^[A-Za-z]+([/_=-][A-Za-z]+)*[/_=-]?[0-9]{0,4}$", r"(?i)example|placeholder|xxxx|1234567890"]

SPAN = "array<struct<start:int,kind:int,stop:int>>"


def _spans(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    # one pass: the place after the last match, and the spans so far
    rows = F.zip_with(F.zip_with(hits, parts, lambda h, p: F.struct(F.length(h).alias("n"), F.length(p).alias("m"))),
                      F.slice(gaps, 1, F.size(hits)), lambda x, g: F.struct(x["n"].alias("n"), x["m"].alias("m"), F.length(g).alias("g")))
    return F.aggregate(
        rows, F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPAN).alias("found")),
        lambda a, x: F.struct(
            (a["at"] + x["g"] + x["n"]).alias("at"),
            F.when(x["m"] >= least, F.concat(F.coalesce(a["found"], F.array().cast(SPAN)), F.array(F.struct(
                (a["at"] + x["g"]).alias("start"), F.lit(kind).alias("kind"), (a["at"] + x["g"] + x["n"]).alias("stop")))))
            .otherwise(a["found"]).alias("found")),
        lambda a: F.coalesce(a["found"], F.array().cast(SPAN)))


def _none() -> Column:
    return F.array().cast(SPAN)


def entropy(run: str, alphabet: str, window: int = WINDOW) -> str:
    """SQL for the largest entropy of a window of the run ``run`` (an expression), by incremental counts.

    With n_c the count of c in a window of w characters, the entropy is
    log2(w) - sum(n_c log2 n_c) / w; the sum changes by the entering and the
    leaving character only.
    """
    size = len(alphabet)
    f = "array(" + ", ".join(f"{n * math.log2(n) if n else 0.0!r}D" for n in range(window + 2)) + ")"
    places = f"transform(split({run}, ''), c -> instr('{alphabet}', c) - 1)"
    enters, leaves = "a.n[s[i]]", f"a.n[s[i - {window}]]"
    total = (f"CASE WHEN i < {window} THEN a.t + f[{enters} + 1] - f[{enters}] WHEN s[i] = s[i - {window}] THEN a.t "
             f"ELSE a.t + f[{enters} + 1] - f[{enters}] + f[{leaves} - 1] - f[{leaves}] END")
    step = (f"named_struct('n', transform(a.n, (v, k) -> v + if(k = s[i], 1, 0) - if(i >= {window} AND k = s[i - {window}], 1, 0)), "
            f"'t', {total}, 'h', CASE WHEN i < {window - 1} THEN a.h ELSE greatest(a.h, {math.log2(window)!r}D - ({total}) / {window}) END)")
    return (f"aggregate(array(named_struct('s', {places}, 'f', {f})), 0D, (z, x) -> "
            f"aggregate(sequence(0, size(x.s) - 1), named_struct('n', array_repeat(0, {size}), 't', 0D, 'h', 0D), "
            f"(a, i) -> {step.replace('s[', 'x.s[').replace('f[', 'x.f[')}, a -> a.h))")


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def _not_allowed(run: str, allowed: list[str]) -> str:
    return " AND ".join(f"NOT rlike({run}, {_quoted(p)})" for p in allowed) or "true"


def _strong(run: str, allowed: list[str]) -> str:
    """SQL: whether the run, or a stretch of a smaller class within it that no allow-list pattern covers, reaches its limit."""
    within = [f"exists(regexp_extract_all({run}, {_quoted(STRETCHES[k])}, 0), h -> CASE WHEN {_not_allowed('h', allowed)} "
              f"THEN {entropy('lower(h)', CLASSES[k][0])} >= {CLASSES[k][1]}D ELSE false END)" for k in STRETCHES]
    return " OR ".join([*within, f"{entropy(run, CLASSES['key'][0])} >= {CLASSES['key'][1]}D"])


#: SQL: what the cuts k (by start) leave of the run r, and whether it stands beside a hex span.
PIECES = """
  aggregate(filter(k, y -> y.start < r.stop AND r.start < y.stop),
    named_struct('at', r.start, 'hex', false, 'found', cast(array() AS array<struct<start:int,stop:int,by_hex:boolean,run:struct<start:int,kind:int,stop:int>>>)),
    (a, y) -> named_struct('at', greatest(a.at, y.stop), 'hex', CASE WHEN y.stop > a.at THEN y.kind = 2 WHEN y.stop = a.at THEN a.hex OR y.kind = 2 ELSE a.hex END,
      'found', CASE WHEN y.start > a.at THEN concat(a.found, array(named_struct('start', a.at, 'stop', y.start, 'by_hex', a.hex OR y.kind = 2, 'run', r))) ELSE a.found END),
    a -> CASE WHEN a.at < r.stop THEN concat(a.found, array(named_struct('start', a.at, 'stop', r.stop, 'by_hex', a.hex, 'run', r))) ELSE a.found END)"""


def scan(docs: DataFrame, keep: list[str] | None = None, allowed: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), ``text`` (null as empty), base_spans, spans (both sorted arrays)."""
    keep = ["doc_id"] if keep is None else keep
    allowed = ALLOWED if allowed is None else allowed
    names = [f"keep_{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], text_of().alias("t"))
    t = F.col("t")
    maybe = {"assign": t.rlike(PATTERNS[0][1]), "access": t.contains("AKIA"), "hex": t.rlike("[0-9a-f]{24}")}
    base = F.sort_array(F.concat(*[F.when(maybe[kind], _spans(t, pattern, group, least, k)).otherwise(_none())
                                   for k, (kind, pattern, group, least) in enumerate(PATTERNS)]))
    found = rows.select(*names, "t", base.alias("b"), F.when(t.rlike(CANDIDATE), _spans(t, CANDIDATE, 0, WINDOW, 3)).otherwise(_none()).alias("c"))
    found = found.withColumn("k", F.when(F.size("c") > 0, F.sort_array(F.concat("b", *[
        F.when(t.rlike(p), _spans(t, p, 0, 1, len(KINDS))).otherwise(_none()) for p in allowed if not p.startswith("^")]))))
    run, whole = "substring(t, x.start + 1, x.stop - x.start)", "substring(t, x.run.start + 1, x.run.stop - x.run.start)"
    key, least = CLASSES["key"]
    more = F.expr(f"""
      CASE WHEN size(c) = 0 THEN c ELSE transform(
        filter(flatten(transform(c, r -> {PIECES})), x -> CASE WHEN NOT ({_not_allowed(run, allowed)}) THEN false
          WHEN x.stop - x.start >= {WINDOW} THEN {_strong(run, allowed)} WHEN x.by_hex THEN {entropy(whole, key)} >= {least}D ELSE false END),
        x -> struct(x.start AS start, 3 AS kind, x.stop AS stop)) END""")
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("t").alias("text"), F.col("b").alias("base_spans"),
                        F.sort_array(F.concat("b", more)).alias("spans"))


def listed(spans: str) -> Column:
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', {kinds}[x.kind], x.start, x.stop)), ',')")


def secrets(docs: DataFrame) -> DataFrame:
    found = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    count = lambda k: F.size(F.filter("base_spans", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(listed("base_spans").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """All columns and rows; every stretch of overlapping spans in ``text`` becomes the mask, ``n_chars`` follows."""
    columns = list(docs.columns)
    rows = scan(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").alias("text")), keep=["row"])
    hidden = F.expr(f"""
      CASE WHEN size(spans) = 0 THEN text ELSE aggregate(spans, named_struct('out', '', 'at', 0),
        (a, x) -> CASE WHEN x.start < a.at THEN named_struct('out', a.out, 'at', greatest(a.at, x.stop))
          ELSE named_struct('out', concat(a.out, substring(text, a.at + 1, x.start - a.at), '{mask}'), 'at', x.stop) END,
        a -> concat(a.out, substring(text, a.at + 1))) END""")
    rows = rows.select("row", F.size("spans").alias("n"), hidden.alias("hidden"))
    changed = {"text": F.when(F.col("n") > 0, F.col("hidden")).otherwise(F.col("row")["text"]),
               "n_chars": F.when(F.col("n") > 0, F.length("hidden").cast(dict(docs.dtypes).get("n_chars", "long"))).otherwise(F.col("row")["n_chars"])
               if "n_chars" in columns else None}
    return rows.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in columns])
