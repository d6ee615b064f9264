"""Operators 11 to 13 against plain versions, on small odd inputs and on sf0.001."""

import functools
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from periodfact.llm import fill_middle, runs, token_files, vocab
from periodfact.llm.common import table

SF_SMALL = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "lorem ipsum dolor sit amet, consectetur " * 700
TEXTS = [None, "", " ", "a", "a b", "  two  spaces \n\n x ", "a<|endoftext|> b", LONG, LONG + " tail", "<P> x <S", "日本語 " * 30,
         "one two three four five six seven eight nine ten\n" * 4, "x" * 9000, "é \x1c İ ² 12a's b\n"]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (5, "another text of the same id"), (None, "null id " * 40), (-3, "below")]


@pytest.fixture(scope="module")
def docs(spark):
    """Texts of all kinds, repeated and null ids, and columns whose names clash with the operators' own."""
    rows = [(i, t, 1, "x", 2, 0.5, "r") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, start int, ids string, n int, tie double, runs string").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def small(spark):
    return table(spark, SF_SMALL, "documents")


# -- 11 token files ---------------------------------------------------------

@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60000), st.integers(2**59, 2**64 - 1)), max_size=700))
@settings(max_examples=150, deadline=None)
def test_words_round_trip(values):
    values = np.array(values, np.uint64)
    words, escaped = token_files.encode_block(values)
    assert (token_files.decode_block(words, escaped, len(values)) == values).all()
    assert len(escaped) == (values >= 2**60).sum() and len(words) <= max(len(values), 0)


def test_words_are_dense():
    assert len(token_files.encode_block(np.zeros(240, np.uint64))[0]) == 1
    assert len(token_files.encode_block(np.ones(60, np.uint64))[0]) == 1
    assert len(token_files.encode_block(np.full(400, 30000, np.uint64))[0]) == 100


def test_any_stretch_reads_only_its_blocks(tmp_path):
    from pyarrow.fs import LocalFileSystem
    fs, path = LocalFileSystem(), str(tmp_path / "one.s8b")
    ids = np.random.default_rng(1).integers(0, 50257, 50_000).astype("<u4")
    writer = token_files.FileWriter(fs.open_output_stream(path))
    writer.add(7, ids[:30_000])
    writer.add(None, ids[30_000:])
    writer.close()
    reader = token_files.FileReader(fs.open_input_file(path))
    for start, stop in ((0, 1), (8191, 8193), (20_000, 41_234), (49_999, 50_000), (5, 5)):
        assert (reader.values(start, stop) == ids[start:stop]).all()
    assert [(i, s, len(v)) for i, s, v in reader.documents()] == [(7, 0, 30_000), (None, 30_000, 20_000)]


@functools.cache
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected_ids(text):
    return np.array(library().encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def check_files(rows, texts):
    """``texts``: (doc_id, text) in any order; rows of one id may stand in any order."""
    want = sorted(((i is not None, i or 0, len(ids), zlib.crc32(ids.tobytes())) for i, ids in
                   ((i, expected_ids(t)) for i, t in texts)))
    rows = sorted(rows, key=lambda r: r["start"])
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
    assert keys == sorted(keys)


def test_token_files(spark, docs, small, none, scratch):
    token_files.write_files(docs, f"{scratch}/a", RANKS, file_ids=5000)  # many files a task
    check_files(token_files.digests(token_files.read_files(spark, f"{scratch}/a")).collect(), ROWS)
    token_files.write_files(small, f"{scratch}/b", RANKS)
    check_files(token_files.digests(token_files.read_files(spark, f"{scratch}/b")).collect(),
                [tuple(r) for r in small.select("doc_id", "text").collect()])
    token_files.write_files(none, f"{scratch}/c", RANKS)
    assert token_files.read_files(spark, f"{scratch}/c").count() == 0


def test_unlisted_files_are_not_read(spark, docs, scratch):
    token_files.write_files(docs, f"{scratch}/a", RANKS)
    with open(f"{scratch}/a/part-000000-0000-left-by-a-lost-task.s8b", "wb") as out:
        out.write(b"half a file")
    assert token_files.read_files(spark, f"{scratch}/a").count() == len(ROWS)


@pytest.mark.parametrize("text", [" " * 30_000, " " * 30_000 + "a", "a" + "\n" * 20_000 + "b", "a" + "\n " * 15_000 + "<|endoftext|>",
                                  "\t" * 12_000 + " x" + " " * 11_000, "a" * 10_001 + " b"])
def test_long_white_space_has_the_library_s_ids(text):
    assert vocab.id_encoder(RANKS)(text) == expected_ids(text)[:-1].tobytes()


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" + "\n" * 5_000_000 + "b", "\r\n" * 2_500_000 + " x"])
def test_very_long_white_space(text):
    ids = np.frombuffer(vocab.id_encoder(RANKS)(text), "<u4")
    assert vocab.merge_core(RANKS).decode(ids.tolist()) == text


# -- 12 fill in the middle --------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text):
    units = UNIT.findall(text)
    n, digest = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.lists(st.sampled_from([" ", "\n", "a", "bb", "日本", "\x1c", " ", "<P", "<", "S>", "<M>", "shared words again and again " * 4]), max_size=60),
       st.integers(0, 400))
@settings(max_examples=400, deadline=None)
def test_units_by_chunks(parts, doc_id):
    text, chunks = "".join(parts), fill_middle.Chunks(2000)
    units = fill_middle.Chunks().document(text)
    places = [0, *np.cumsum([len(u) for u in UNIT.findall(text)]).tolist()]
    assert units.n == len(places) - 1 and [units.end(k) for k in range(units.n + 1)] == places
    assert fill_middle.transformed(doc_id, text, chunks) == plain_fim(doc_id, text)


def test_chunks_are_found_again_wherever_they_stand():
    words = random.Random(4)
    shared = " ".join(str(words.randrange(10**6)) for _ in range(2000))
    chunks = fill_middle.Chunks()
    chunks.document("first " + shared)
    before = chunks.misses
    chunks.document("a longer beginning of another text " + shared + " and an end")
    assert chunks.misses - before <= 4 < 20 < chunks.hits


def test_fill_in_middle(docs, small, none):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    for df in (docs, small):
        want = sorted((i is not None, i or 0, *plain_fim(i, t or "")[:2], *[x if x is not None else -1 for x in plain_fim(i, t or "")[2:4]],
                       sha(plain_fim(i, t or "")[4]), sha(t or "")) for i, t in df.select("doc_id", "text").collect())
        got = [tuple(r) for r in fill_middle.digests(fill_middle.fill_in_middle(df)).collect()]
        assert sorted((r[0] is not None, r[0] or 0, *r[1:3], *[x if x is not None else -1 for x in r[3:5]], *r[5:]) for r in got) == want
    assert {r["form"] for r in fill_middle.fill_in_middle(small).select("form").distinct().collect()} == {"plain", "psm", "spm"}
    assert fill_middle.digests(fill_middle.fill_in_middle(none)).count() == 0


# -- 13 periodic runs -------------------------------------------------------

def plain_runs(words):
    number = {}
    x = np.array([number.setdefault(w, len(number)) for w in words])
    found = {}
    for q in range(1, len(x) // 3 + 1):
        step = np.diff(np.concatenate([[0], (x[:-q] == x[q:]).astype(int), [0]]))
        for start, end in zip(np.flatnonzero(step == 1).tolist(), (np.flatnonzero(step == -1) + q).tolist()):
            if end - start >= max(24, 3 * q):
                found.setdefault((start, end), q)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain_row(doc_id, text):
    words = plain_planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = plain_runs(words)
    drop = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    head = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(found), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@st.composite
def repetitive(draw):
    out = []
    for _ in range(draw(st.integers(0, 5))):
        part = [b"%d" % x for x in draw(st.lists(st.integers(0, draw(st.integers(0, 3))), min_size=1, max_size=40))]
        part = (part * draw(st.integers(1, 4)) + [b"x"] * draw(st.integers(0, 1))) * draw(st.integers(1, 4))
        out += part[:len(part) - draw(st.integers(0, min(6, len(part) - 1)))]
        if draw(st.booleans()) and len(out) < 400:
            out = out * draw(st.integers(2, 4))
    return out[:1500]


@given(st.lists(repetitive(), max_size=5))
@settings(max_examples=250, deadline=None)
def test_runs_of_repetitive_sequences(documents):
    assert [d.runs for d in runs.search(documents)] == [plain_runs(d) for d in documents]


def test_runs_of_hard_sequences():
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(13):
        a, b = b, b + a
    rng = random.Random(2)
    cases = [b[:600], [b"0"] * 5000, [b"%d" % rng.randrange(2) for _ in range(3000)], ([b"a"] * 20 + [b"b"]) * 40,
             (([b"a", b"b"] * 9 + [b"c"]) * 3 + [b"d"]) * 5, [b"u", b"v"] * 11 + [b"u"], [b"u", b"v"] * 12]
    assert [d.runs for d in runs.search(cases)] == [plain_runs(c) for c in cases]
    assert [len(plain_runs(c)) for c in cases[-2:]] == [0, 1]


def test_periodic_runs(docs, small, none, spark):
    more = spark.createDataFrame([(100 + i, "w" * (i % 3) + " repeat this line\n" * (i * 3)) for i in range(40)], "doc_id long, text string")

    def key(r):
        return tuple((x is None, x if x is not None else 0) for x in r)

    for df in (docs, small, more):
        want = sorted((plain_row(i, t) for i, t in df.select("doc_id", "text").collect()), key=key)
        assert sorted((tuple(r) for r in runs.digests(runs.periodic_runs(df)).collect()), key=key) == want
    assert runs.digests(runs.periodic_runs(none)).count() == 0
