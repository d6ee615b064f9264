"""Operator 8: near-duplicate classes by min-max hashing.

One pass over the texts makes, for each document, its set of hashed shingles
and from it a signature: under each permutation both the smallest and the
largest hash are kept, so 64 evaluations give 128 values, each equal between
two documents with the probability of their similarity.  Bands of a few values
(``Rule``) key the candidate search; two bits of each value make a 256-bit sketch.
Documents with equal sets are one class from then on, so copies cost nothing.

Candidate search.  (1) Rounds of stars: each bucket has a centre; a document
takes, of its buckets' centres, the one of the nearest sketch, if that may
still be in reach and isn't in its component yet.  Such links are confirmed on
the full sets and merged.  This joins large groups of near copies with about
one comparison for a document and round.  (2) What is left, in buckets that still
hold several components: blocks of bounded size (a hot bucket has as many as it
needs) bring the documents outside a bucket's home component together with those
of other components.  Where the rule says so, sketches alone are compared first and
documents without a partner in reach go; then those whose own shingles rule every link out.  The full
sets of the others are compared exactly, by bit rows, and a block returns only a
forest of the links between components, so no pair leaves its block.  Every pair that shares a
bucket and may be linked is either confirmed, refuted or already in one component.

Bounds of op8's rule: two documents of similarity 0.85 share no bucket with
probability 4e-7, and the sketch drops such a pair with probability under 1e-6;
both fall steeply above 0.85.  (Five words, 0.8: 5e-8 and 1e-6.)  No caps.

Defined results: an empty or null text, or one without words, has an empty set
and stands alone (component: itself).  A null ``doc_id`` is in no class
(component null, kept).  Rows that repeat a text are one class; each row gets
its class's component.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import checkpointed, slices, text_of
from periodfact.llm.graph import components

PERMUTATIONS = 64
STAR_ROUNDS = 2


@dataclass(frozen=True)
class Rule:
    """When two documents are linked: words of a shingle and least similarity in percent; and how pairs are found.

    ``far``: differing sketch fields (of 128) that a pair of that similarity
    stays under, six deviations from the mean (0.85: 14.4 and 3.6; 0.8: 19.2 and 4.0).
    """
    shingle: int
    link: int
    bands: int
    band_rows: int
    far: int
    sketch_blocks: bool  # whether the rest's sketches are compared before its sets travel: worth it for many loose buckets


CONTRACT = Rule(3, 85, 25, 5, 36, False)
#: The rule of everything but op8's query.
USUAL = Rule(5, 80, 32, 4, 44, True)
#: Shingles of a block, each document counted with ``BLOCK_DOCUMENT`` more (bounds the bit rows).
BLOCK_SHINGLES, BLOCK_DOCUMENT = 1 << 19, 200
SLAB = 4096
#: Documents of a block that compares sketches.
SKETCH_BLOCK = 4096
#: Up to so many ids (8 MB) are broadcast to pick their texts; more are joined by shuffle.
BROADCAST_IDS = 1_000_000

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _RANDOM.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_MIX = _RANDOM.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = [np.ones(1, np.uint64)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        _POWERS[0] = np.cumprod(np.full(max(n, 4096), _BASE, np.uint64))
    return _POWERS[0]


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of a text's words (UTF-8, lowered), in order."""
    code = np.frombuffer(raw, np.uint8)
    word = ~_SPACE[code]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64)
    size = stop - start
    code = code[word]
    at = np.cumsum(size) - size
    place = np.arange(len(code)) - np.repeat(at, size)
    return _mixed(np.add.reduceat(_BYTE[code] * _powers(int(size.max()))[place], at) + size.astype(np.uint64))


def shingles(text: str, k: int = CONTRACT.shingle) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words are one shingle, none make an empty set."""
    words = word_hashes(text.encode("utf-8", "replace").lower())  # bytes.lower(): A-Z only
    if len(words) < k:
        found = words[:0] if not len(words) else np.array([len(words)], np.uint64)
        for w in words:
            found = _mixed(found * _MIX[0] + w)
        return found
    found = words[:len(words) - k + 1].copy()
    for j in range(1, k):
        found = _mixed(found * _MIX[0] + words[j:len(words) - k + 1 + j])
    return np.unique(found)


def signature(values: np.ndarray) -> np.ndarray:
    """Smallest, then largest hash (upper 32 bits) under each permutation."""
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(values), 2048):
        hashed = np.multiply.outer(_A, values[at:at + 2048])
        hashed += _B[:, None]
        hashed >>= np.uint64(32)
        np.minimum(low, hashed.min(axis=1), out=low)
        np.maximum(high, hashed.max(axis=1), out=high)
    return np.concatenate([low, high])


def bands(sig: np.ndarray, rule: Rule = CONTRACT) -> np.ndarray:
    """One key for each band, different between bands; values in turn from both ends."""
    used = sig.reshape(2, PERMUTATIONS).T.ravel()[:rule.bands * rule.band_rows].reshape(rule.bands, rule.band_rows)
    key = np.arange(rule.bands, dtype=np.uint64)
    for j in range(rule.band_rows):
        key = _mixed(key * _MIX[j + 2] + used[:, j])
    return key.view(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """Two mixed bits of each value, 32 values in a word."""
    two = (_mixed(sig + np.uint64(1)) & np.uint64(3)).reshape(4, 32)
    return np.bitwise_or.reduce(two << (np.arange(32, dtype=np.uint64) * np.uint64(2)), axis=1).view(np.int64)


SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                    ("keys", pa.list_(pa.int64())), ("s", pa.list_(pa.int64()))])


def signed(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """doc_id, n (set size), d1, d2 (digest of the set), keys, s (sketch)."""
    def run(batches):
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = shingles(text, rule.shingle)
                if len(values):
                    sig = signature(values)
                    digest = [int(_mixed(values + _MIX[j]).sum(dtype=np.uint64).view(np.int64)) for j in (0, 1)]
                    out.append((doc_id, len(values), *digest, bands(sig, rule), sketch(sig)))
                else:
                    out.append((doc_id, 0, 0, 0, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), SIGNED.types)], schema=SIGNED)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, n long, d1 long, d2 long, keys array<long>, s array<long>")


def sets(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """doc_id, values (its full set)."""
    def run(batches):
        for batch in slices(batches, 64):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingles(t, rule.shingle).view(np.int64) for t in batch.column(1).to_pylist()], pa.list_(pa.int64()))],
                names=["doc_id", "values"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, values array<long>")


def far(a: str, b: str) -> Column:
    """Sketch fields in which two sketches differ."""
    field = "bit_count((({a}[{k}] ^ {b}[{k}]) | shiftright({a}[{k}] ^ {b}[{k}], 1)) & 6148914691236517205L)"
    return F.expr(" + ".join(field.format(a=a, b=b, k=k) for k in range(4)))


def in_reach(n: str, m: str, a: str, b: str, rule: Rule = CONTRACT) -> Column:
    """False only for pairs that sizes or sketches rule out."""
    return (F.expr(f"100 * least({n}, {m}) >= {rule.link} * greatest({n}, {m})")) & (far(a, b) <= rule.far)


def _centres(banded: DataFrame, turn: int) -> DataFrame:
    """A centre for each bucket with several components, another one each turn."""
    return (banded.groupBy("key")
            .agg(F.min_by(F.struct("id", "comp", "n", "s"), F.xxhash64("id", F.lit(turn))).alias("c"),
                 F.min("comp").alias("least"), F.max("comp").alias("most"))
            .where("least < most").select("key", F.col("c.id").alias("c_id"), F.col("c.comp").alias("c_comp"),
                                          F.col("c.n").alias("c_n"), F.col("c.s").alias("c_s")))


def star_pairs(banded: DataFrame, turn: int, rule: Rule = CONTRACT) -> DataFrame:
    """For each document the nearest centre of its buckets that is in reach and in another component."""
    met = (banded.join(_centres(banded, turn), "key")
           .where((F.col("comp") != F.col("c_comp")) & in_reach("n", "c_n", "s", "c_s", rule)))
    return (met.groupBy("id").agg(F.min(F.struct(far("s", "c_s").alias("far"), F.col("c_id"))).alias("best"))
            .select(F.least("id", "best.c_id").alias("a"), F.greatest("id", "best.c_id").alias("b")).distinct())


def _texts_of(docs: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, values (full set) of the documents with these distinct ids."""
    ids = checkpointed(ids)
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return sets(docs.join(ids, "doc_id", "left_semi"), rule)


def confirmed(pairs: DataFrame, docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """The pairs whose full sets are linked."""
    pairs = checkpointed(pairs)
    full = _texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), rule)
    both = (pairs.join(full.select(F.col("doc_id").alias("a"), F.col("values").alias("x")), "a")
            .join(full.select(F.col("doc_id").alias("b"), F.col("values").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    return (both.select("a", "b", common.alias("common"), (F.size("x") + F.size("y") - common).alias("either"))
            .where(f"100L * common >= {rule.link}L * either").select("a", "b").distinct())


def _in_blocks(mixed: DataFrame, weight: Column, limit: int) -> DataFrame:
    """key, i, j, asks, answers, id, comp, ..: the documents of the buckets with several components, in blocks of bounded weight.

    In block (i, j) the i-th part of the documents outside the bucket's home
    component (``asks``) meets the j-th part of all.  A bucket within the limit
    is one block, and each of its documents there once.
    """
    more = [c for c in mixed.columns if c not in ("key", "id", "comp")]
    buckets = (mixed.groupBy("key").agg(F.min_by("comp", F.xxhash64("id")).alias("home"), F.min("comp").alias("least"),
                                        F.max("comp").alias("most"), F.sum(weight).alias("weight"))
               .where("least < most").select("key", "home", F.ceil(F.col("weight") / limit).cast("int").alias("parts")))
    placed = mixed.join(buckets, "key").withColumn("outside", F.col("comp") != F.col("home"))
    asking = placed.groupBy("key").agg(F.ceil(F.sum(F.when(F.col("outside"), weight)) / limit).cast("int").alias("asking"))
    placed = placed.join(asking, "key").withColumn("spot", F.xxhash64("id", F.lit(1)))
    zero, own = F.lit(0), F.expr("cast(pmod(spot, parts) as int)")
    spots = F.when(F.col("parts") == 1, F.array(F.struct(zero.alias("i"), zero.alias("j"), F.col("outside").alias("asks"), F.lit(True).alias("answers")))).otherwise(
        F.concat(F.transform(F.sequence(zero, F.col("asking") - 1), lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(False).alias("asks"), F.lit(True).alias("answers"))),
                 F.when(F.col("outside"), F.transform(F.sequence(zero, F.col("parts") - 1), lambda j: F.struct(
                     F.expr("cast(pmod(spot, asking) as int)").alias("i"), j.alias("j"), F.lit(True).alias("asks"), F.lit(False).alias("answers"))))
                 .otherwise(F.array().cast("array<struct<i:int,j:int,asks:boolean,answers:boolean>>"))))
    return placed.select("key", F.explode(spots).alias("at"), "id", "comp", *more).select("key", "at.*", "id", "comp", *more)


def _per_block(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on each block's rows (one Arrow table); a task holds one block at a time."""
    def run(batches):
        held, at = [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for first, stop in zip(cuts, cuts[1:]):
                if first == stop:
                    continue
                block = tuple(keys[:, first])
                if block != at:
                    if held:
                        yield work(pa.Table.from_batches(held).combine_chunks())
                    held, at = [], block
                held.append(batch.slice(first, stop - first))
        if held:
            yield work(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, schema)


def _column(block: pa.Table, name: str) -> np.ndarray:
    return block.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def near_in_sketch(banded: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """key, id, comp, n of the documents that a bucket brings together with another component, in reach by size and sketch.

    Sketches alone travel here, and a row for a document and bucket comes back at most.
    """
    mixed = banded.join(_centres(banded, STAR_ROUNDS).select("key"), "key").select("key", "id", "comp", "n", "s")
    field = np.uint64(6148914691236517205)

    def work(block: pa.Table) -> pa.RecordBatch:
        comp, n, answers = _column(block, "comp"), _column(block, "n"), _column(block, "answers")
        s = block.column("s").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(comp), 4)
        found = np.zeros(len(comp), bool)
        for i in np.flatnonzero(_column(block, "asks")):
            met = answers & (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= rule.link * np.maximum(n, n[i]))
            apart = s[met] ^ s[i]
            near = np.flatnonzero(met)[np.bitwise_count((apart | apart >> np.uint64(1)) & field).sum(axis=1) <= rule.far]
            if len(near):
                found[near] = found[i] = True
        kept = pa.array(found)
        return pa.RecordBatch.from_arrays([block.column(c).combine_chunks().filter(kept) for c in ("key", "id", "comp", "n")], names=["key", "id", "comp", "n"])

    return _per_block(_in_blocks(mixed, F.lit(1), SKETCH_BLOCK), work, "key long, id long, comp long, n long").distinct()


def rest_blocks(banded: DataFrame, docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """Blocks (see ``_in_blocks``) with n and values (full set) of the documents that may still link.

    A document with u shingles that no other document of these buckets has is
    at most (n - u) / n like any of them; where that is too little it goes
    first, and with it the buckets that are left with one component.
    """
    if rule.sketch_blocks:
        mixed = checkpointed(near_in_sketch(banded, rule))
    else:
        mixed = checkpointed(banded.join(_centres(banded, STAR_ROUNDS).select("key"), "key").select("key", "id", "comp", "n"))
    ids = mixed.select("id", "n").distinct()
    full = checkpointed(_texts_of(docs, ids.select(F.col("id").alias("doc_id")), rule))
    alone = (full.select("doc_id", F.explode("values").alias("value")).groupBy("value")
             .agg(F.count("*").alias("df"), F.min("doc_id").alias("id")).where("df = 1")
             .groupBy("id").agg(F.count("*").alias("u")))
    out_of_reach = checkpointed(ids.join(alone, "id").where(f"100 * (n - u) < {rule.link} * n").select("id"))
    rows = _in_blocks(mixed.join(out_of_reach, "id", "left_anti"), F.col("n") + BLOCK_DOCUMENT, BLOCK_SHINGLES)
    return rows.join(full.withColumnRenamed("doc_id", "id"), "id").drop("id")


def forest_of_block(asks: np.ndarray, answers: np.ndarray, comp: np.ndarray, n: np.ndarray, sizes: np.ndarray,
                    values: np.ndarray, link: int) -> list[tuple[int, int]]:
    """Links between components of a block's documents, a forest of them: (smaller, larger)."""
    m, asking = len(comp), np.flatnonzero(asks)
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count > 1  # a shingle of one document is in no intersection
    rank = np.cumsum(shared) - 1
    used = shared[place]
    row, column = np.repeat(np.arange(m), sizes)[used], rank[place[used]]
    common = np.zeros((len(asking), m), np.int32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(shared.sum()), SLAB):
        part = slice(*np.searchsorted(column, (first, first + SLAB)))
        bits = np.zeros((m, min(SLAB, -(-(int(shared.sum()) - first) // 64) * 64)), bool)
        bits[row[part], column[part] - first] = True
        words = np.packbits(bits, axis=1).view(np.uint64)
        for k, i in enumerate(asking):
            common[k] += np.bitwise_count(words & words[i]).sum(axis=1, dtype=np.int32)
    linked = (100 * common.astype(np.int64) >= link * (n[asking][:, None] + n[None, :] - common)) & answers[None, :]
    linked &= comp[asking][:, None] != comp[None, :]
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x] = root.get(root[x], root[x])
        return x

    out = []
    for k, j in zip(*np.nonzero(linked)):
        a, b = sorted((top(int(comp[asking[k]])), top(int(comp[j]))))
        if a != b:
            root[b] = a
            out.append((a, b))
    return out


def links_in_blocks(blocks: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """a, b: links between components, few for each block."""
    def work(block: pa.Table) -> pa.RecordBatch:
        values = block.column("values").combine_chunks()
        found = forest_of_block(**{c: _column(block, c) for c in ("asks", "answers", "comp", "n")},
                                sizes=values.value_lengths().to_numpy(), values=values.flatten().to_numpy(), link=rule.link)
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())],
                                          names=["a", "b"])

    return _per_block(blocks, work, "a long, b long").distinct()


def shared_buckets(classes: DataFrame) -> DataFrame:
    """key, id of the buckets that hold two classes or more; most keys have one and go."""
    keyed = classes.select(F.explode("keys").alias("key"), "id")
    several = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return checkpointed(keyed.join(several, "key"))


def merged(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """The nodes (id, comp, ..) after links between components; only these links are searched, not those of earlier rounds."""
    changed = components(links).select(F.col("id").alias("comp"), F.col("comp").alias("to"))
    return checkpointed(nodes.join(changed, "comp", "left").withColumn("comp", F.coalesce("to", "comp")).drop("to"))


def near_duplicates(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    made = checkpointed(signed(texts, rule))
    classes = checkpointed(
        made.where("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n")
        .agg(F.min("doc_id").alias("id"), F.any_value("keys").alias("keys"), F.any_value("s").alias("s")))
    buckets = shared_buckets(classes)
    nodes = classes.select("id", "n", "s", F.col("id").alias("comp")).join(buckets.select("id").distinct(), "id")
    nodes = checkpointed(nodes)
    for turn in range(STAR_ROUNDS + 1):
        banded = buckets.join(nodes, "id").select("key", "id", "comp", "n", "s")
        if turn < STAR_ROUNDS:
            comp = nodes.select("id", "comp")
            links = (confirmed(star_pairs(banded, turn, rule), texts, rule)
                     .join(comp.select(F.col("id").alias("a"), F.col("comp").alias("x")), "a")
                     .join(comp.select(F.col("id").alias("b"), F.col("comp").alias("y")), "b")
                     .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct())
        else:
            links = links_in_blocks(rest_blocks(banded, texts, rule), rule)
        links = checkpointed(links)
        if not links.isEmpty():
            nodes = merged(nodes, links)
    labels = nodes.select("id", "comp")
    placed = classes.select("d1", "d2", "n", "id")
    placed = placed.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id")).drop("id")
    out = made.select("doc_id", "n", "d1", "d2").join(placed, ["d1", "d2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, rule: Rule = USUAL) -> DataFrame:
    """The rows that stand for their group, with all columns: one for each group, also where a row repeats.

    A null ``doc_id`` is kept.  Only the ids that go are joined to the texts.
    """
    found = checkpointed(near_duplicates(docs, rule))
    gone = found.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    repeated = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__gone"))
    staying = docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    if repeated.isEmpty():
        return staying
    alone = staying.join(repeated, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    first = staying.join(repeated, F.col("doc_id").cast("long") == F.col("__gone"), "left_semi").dropDuplicates(["doc_id"])
    return alone.unionByName(first)
