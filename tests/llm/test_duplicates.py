"""Near-duplicates, components, repeated byte strings and repeated lines against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hashloom.llm import line_dedup, minhash_dedup, suffix_dedup
from hashloom.llm.common import load
from hashloom.llm.components import connected_components

from . import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, key string, component string, node string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "clash", "clash", "clash") for i, t in rows], DOCS)


def mutated(seed, families=4, copies=25, words=60):
    """Families of copies with few to many changed words, chained copies, and texts of their own."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(300)]
    out = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(words + rng.randrange(60))]
        chain = list(base)
        for k in range(copies):
            text = list(chain if k % 3 == 0 else base)
            for _ in range(rng.choice([0, 0, 1, 1, 1, 2, 2, 3, 8, 20])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary[:40])
            if k % 3 == 0:
                chain = text
            out.append(" ".join(text))
    out += [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 30))) for _ in range(30)]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed, percent):
    rows = mutated(seed)
    want = brute.components(dict(rows), percent)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(table(spark, rows), percent=percent).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}
    assert len(set(c for _, c in want.values())) < len(rows) - 20


def test_near_duplicates_documents(spark):
    docs = load(spark, SF, "documents")
    want = brute.components({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == want


def test_near_duplicates_hard(spark):
    long = "abc def " * 20_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (None, "one two"), (6, long), (7, long + "x"), (8, "solo words of its own stand here"), (8, "solo words of its own stand here"), (9, "one two"), (9, long)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(table(spark, rows)).collect()), key=str)
    n6 = len(brute.shingles(long))
    assert (1, 0, 1, True) in got and (2, 0, 2, True) in got and (3, 0, 3, True) in got
    assert (5, 1, 4, False) in got and (None, 1, None, True) in got
    assert got.count((8, 2, 8, True)) == 0 and sum(r[0] == 8 and r[3] for r in got) == 2
    # id 9 has two texts, each in its own group
    assert (6, n6, 6, True) in got and (9, 1, 4, False) in got and (9, n6, 6, False) in got
    assert minhash_dedup.near_duplicates(table(spark, [])).count() == 0


def test_near_duplicates_of_shared_ids(spark):
    """A second text under an id takes no link away: 100 and 101 shingles are linked, whatever else id 1 has."""
    rng = random.Random(8)
    a = [f"w{k}" for k in range(104)]
    other = [f"v{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(1, " ".join(a)), (2, " ".join([*a, "more"])), (1, " ".join(other)), (4, " ".join([*other, "tail"])), (4, " ".join(a))]
    rows += [(i % 7, t) for i, t in mutated(3, copies=12)]
    want = sorted((i, n, c, i == c) for (i, _), (n, c) in zip(rows, brute.row_components(rows, 85), strict=True))
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(table(spark, rows)).collect())
    assert got == want and (2, 101, 1, False) in got


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_of_a_family(spark, percent, monkeypatch):
    """Relatives that differ from one another in few words, drawn from few: what stars leave open is closed by prefixes."""
    rng = random.Random(percent)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(600):
        words = list(base[: 100 - rng.randrange(3)])
        for _ in range(3 if percent == 80 else 2):
            words[rng.randrange(5, 40)] = f"x{rng.randrange(2)}"
        rows.append((i, " ".join(words)))
    used = []
    prefixes = minhash_dedup._prefix_pairs

    def counted(sets, nodes, scratch, percent):
        pairs = prefixes(sets, nodes, scratch, percent)
        used.append((nodes.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(minhash_dedup, "_prefix_pairs", counted)
    monkeypatch.setattr(minhash_dedup, "CENTRES", 1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(table(spark, rows), percent=percent).collect()}
    assert got == brute.components(dict(rows), percent)
    assert used and used[0][1] > 0


def test_densified_signatures_agree_with_similarity():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    b = np.concatenate([a[:270], rng.integers(0, 1 << 63, 30, dtype=np.uint64)])
    sets = np.concatenate([np.sort(a), np.sort(b), a[:2]])
    got = minhash_dedup.densified(sets, np.array([0, 300, 600, 602]), 4096)
    assert abs((got[0] == got[1]).mean() - 270 / 330) < 0.06
    assert set(got[2].tolist()) == set(a[:2].tolist())


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=6, deadline=None)
def test_components(spark, edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}


def test_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(edges, "a", "b")
    assert got.count() == 301 and got.where("component <> 0").count() == 0


def repeats_rows(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("ab é") for _ in range(n)) for n in (30, 50, 60, 90, 300)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(6)):
            s = rng.choice(shared)
            cut = rng.randrange(len(s)) if rng.random() < 0.3 else 0
            parts.append(s[cut:] if rng.random() < 0.7 else "".join(rng.choice("xyz") for _ in range(rng.randrange(80))))
        rows.append((i * 3 % 61, "".join(parts)))
    return rows


def check_repeats(df, texts, length):
    want = brute.repeats(texts, length)
    got = suffix_dedup.remove_repeats(df, length=length).collect()
    assert len(got) == len(texts)
    for r in got:
        b, gone = want[r.doc_id]
        assert r.n_bytes == len(b)
        assert bytes(r.kept) == bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = list(zip(r.spans[::2], r.spans[1::2], strict=True))
        flags = bytearray(len(b))
        for x, y in runs:
            flags[x:y] = b"\1" * (y - x)
        assert bytes(flags) == gone and len(runs) == sum(1 for p in gone.split(b"\0") if p)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats(spark, monkeypatch, seed, small):
    if small:  # many parts, ranges and segments, so that classes lie on boundaries
        for name, value in {"PART_BYTES": 700, "RANGE_SUFFIXES": 40, "BUCKET_ANCHORS": 50, "SEGMENT": 120, "CHUNK": 100, "HELD_ANCHORS": 10, "HELD_SUFFIXES": 30, "SAMPLE_EACH": 2, "TASK_BYTES": 900}.items():
            monkeypatch.setattr(suffix_dedup, name, value)
    rows = repeats_rows(seed)
    check_repeats(table(spark, rows), dict(rows), 50)


def test_repeats_documents(spark):
    docs = load(spark, SF, "documents")
    check_repeats(docs, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}, 50)


def test_repeats_hard(spark):
    passage = "This passage of more than fifty bytes stands in several texts. "
    rows = [(5, None), (6, ""), (7, passage), (8, passage), (None, passage), (9, "short"), (10, "short"), (11, passage[:40]), (12, "é" * 300_000 + passage), (13, "xx" + "é" * 60), (14, passage), (14, passage)]
    got = {}
    for r in suffix_dedup.remove_repeats(table(spark, rows), carry=("lang", "key")).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.spans, bytes(r.kept).decode(errors="replace"), r.lang, r.key))
    n = len(passage)
    assert got[7] == [(n, [], passage, "en", "clash")] and got[8] == [(n, [0, n], "", "en", "clash")]
    assert got[None] == [(n, [], passage, "en", "clash")]
    assert got[5][0][0] == got[6][0][0] == 0 and got[9][0][1] == got[10][0][1] == got[11][0][1] == []
    assert got[12][0][1] == [600_000, 600_000 + n] and got[13][0][1] == [2, 122]
    assert [x[1] for x in got[14]] == [[0, n], [0, n]]
    assert suffix_dedup.remove_repeats(table(spark, [])).count() == 0


def check_row_repeats(spark, rows):
    want = {}
    for (i, _), (b, gone) in zip(rows, brute.row_repeats(rows, 50), strict=True):
        want.setdefault(i, []).append((len(b), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    got = {}
    for r in suffix_dedup.remove_repeats(table(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, bytes(r.kept)))
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}
    return got


def test_repeats_of_shared_ids(spark, monkeypatch):
    rng = random.Random(4)
    a, b = ("".join(rng.choice("abcdefghij ") for _ in range(209)) for _ in range(2))
    got = check_row_repeats(spark, [(3, a), (5, a), (5, b), (9, "x" + b)])
    assert sorted(n for n, _ in got[5]) == [209, 209] and (209, b.encode()) in got[5] and got[9] == [(210, b"x")]
    for name, value in {"PART_BYTES": 700, "RANGE_SUFFIXES": 40, "BUCKET_ANCHORS": 50, "SEGMENT": 120, "CHUNK": 100, "HELD_ANCHORS": 10, "HELD_SUFFIXES": 30, "SAMPLE_EACH": 2, "TASK_BYTES": 900}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    check_row_repeats(spark, [(i % 9, t) for i, t in repeats_rows(7)])


def test_repeats_of_a_common_passage(spark, monkeypatch):
    """One passage in most documents: all but the first lose it, however few suffixes a range takes."""
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(180))
    rows = [(i, "".join(rng.choice("xyz") for _ in range(60)) + passage * (1 + i % 3) + str(i)) for i in range(300)]
    check_row_repeats(spark, rows)
    for name, value in {"PART_BYTES": 5000, "RANGE_SUFFIXES": 60, "BUCKET_ANCHORS": 50, "MOST_RANGES": 5, "SAMPLE_EACH": 2}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    check_row_repeats(spark, rows)


def test_repeats_whole_characters(spark):
    rows = [(1, "aé" + "b" * 60), (2, "x" + "é" + "b" * 60)]
    one = "€" * 30
    rows += [(3, one), (4, "₭" + one[1:])]
    for r in suffix_dedup.remove_repeats(table(spark, rows), whole_characters=True).collect():
        assert bytes(r.kept).decode() is not None
        assert all(x <= r.n_bytes for x in r.spans)


def test_multikey_order():
    rng = np.random.default_rng(2)
    for m in (1, 8, 20, 50):
        rows = rng.integers(0, 3, (500, m)).astype(np.uint8)
        order = suffix_dedup.multikey_order(rows)
        keys = [rows[i].tobytes() for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(500))
        lcp = suffix_dedup.common_prefixes(rows, order)
        for i in range(1, 500):
            a, b = keys[i - 1], keys[i]
            assert lcp[i] == next((k for k in range(m) if a[k] != b[k]), m)


def test_part_numbers(spark):
    rows = [(0, 5), (1, -1), (-5, 0), (2**62, 7), (-(2**63), 2**63 - 1)]
    got = spark.createDataFrame(rows, "i long, h long").select(F.pmod(F.xxhash64("i", "h"), F.lit(7)).alias("p")).collect()
    assert [r.p for r in got] == suffix_dedup.row_parts(*np.array(rows).T, 7).tolist()


def lines_rows(seed):
    rng = random.Random(seed)
    pool = [f"line number {k} with some words" for k in range(12)] + ["", "  ", "}", "\tindented {0}".format("x" * 30)]
    return [(i, "\n".join(rng.choice(pool) + rng.choice(["", "", " ", "\r"]) for _ in range(rng.randrange(14)))) for i in range(80)]


@pytest.mark.parametrize(("seed", "run", "chars"), [(1, 3, 40), (2, 1, 1), (3, 2, 60), (4, 5, 0)])
def test_lines(spark, seed, run, chars):
    rows = lines_rows(seed)
    gone = brute.lines_removed(dict(rows), run, chars)
    for r in line_dedup.line_dedup(table(spark, rows), run_lines=run, min_chars=chars).collect():
        lines = dict(rows)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for k, x in enumerate(lines) if k not in gone[r.doc_id])
        assert (r.n_lines, r.n_removed) == (len(lines), len(gone[r.doc_id]))


@pytest.mark.parametrize(("seed", "run"), [(3, 2), (4, 3), (5, 4)])
def test_lines_as_by_extension(spark, seed, run):
    """The union of repeated windows is what extending every pair of fingerprint positions to both sides deletes."""
    rows = lines_rows(seed)
    gone = brute.winnowed_lines(dict(rows), run, lambda x: zlib.crc32(x.encode()))
    assert gone == brute.lines_removed(dict(rows), run, 0)
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.line_dedup(table(spark, rows), run_lines=run, min_chars=0).collect()}
    assert got == {i: ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]), len(gone[i])) for i, t in rows}


def test_lines_hard(spark):
    block = "\n".join(f"this is line {k} of a block" for k in range(3))
    many = "\n".join(f"unique line number {k} here" for k in range(50_000))
    rows = [(1, None), (2, ""), (3, block), (4, block), (None, block), (5, block + "\nmore\n" + block), (6, block), (6, block), (7, many), (8, many), (9, "no line break")]
    got = {}
    for r in line_dedup.line_dedup(table(spark, rows), carry=("key", "lang")).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[1][0].text is None and got[1][0].n_lines == 0
    assert got[2][0].text == "" and got[2][0].n_lines == 1 and got[2][0].key == "clash"
    assert got[3][0].n_removed == 0 and got[4][0].text == "" and got[None][0].text == block
    assert got[5][0].text == "more" and [r.n_removed for r in got[6]] == [3, 3]
    assert got[7][0].n_removed == 0 and got[8][0].n_removed == 50_000
    assert line_dedup.line_dedup(table(spark, [])).count() == 0


def test_lines_of_shared_ids(spark):
    """A text under an id loses no line for what another text of the id holds."""
    block = "\n".join(f"this is line {k} of a block" for k in range(3))
    others = "\n".join(f"a line that stands once, number {k}" for k in range(6))
    got = sorted((r.doc_id, r.text) for r in line_dedup.line_dedup(table(spark, [(3, block), (5, block), (5, others), (5, others)])).collect())
    assert got == sorted([(3, block), (5, ""), (5, others), (5, others)])


def test_lines_of_one_id(spark):
    text = "\n".join("the same line over and over again" for _ in range(6))
    got = line_dedup.line_dedup(table(spark, [(1, text), (1, text)])).collect()
    assert {hashlib.sha256(r.text.encode()).hexdigest() for r in got} == {hashlib.sha256(b"the same line over and over again").hexdigest()}


def test_long_lines(spark):
    rng = random.Random(5)
    passage, pair, glued = (" ".join(f"{x}{k}" for k in range(n)) for x, n in (("w", 50), ("v", 26), ("u", 49)))
    glued = glued + "x" * 300
    short = "one line of a text that stands twice"
    rows = [(1, f"a\n{passage}\nb"), (2, f"c\n {passage}\t\nd"), (3, f"{pair}\n{pair} end"), (4, f"e\n{pair}\n{pair} end\nf"), (5, f"{glued}\ng"), (6, f"h\n{glued}")]
    rows += [(7, short + " there"), (8, short + " there"), (9, f"i\n{short} there\nj"), (10, f"{short}\nand more"), (11, f"{short}\nand more"), (12, f"{short}\nand less"), (13, f"k\n{pair}\nl"), (14, "tiny"), (15, "tiny")]
    pool = [f"line number {k} with some words" for k in range(6)] + ["", passage, pair, glued, "}"]
    rows += [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(7)))) for i in range(60)]
    gone = brute.lines_removed(dict(rows), 3, 40, 50, 300)
    assert [gone[i] for i in (2, 4, 6, 8, 9, 11, 12, 13, 15)] == [{1}, {1, 2}, {1}, {0}, set(), {0, 1}, set(), set(), set()]
    for r in line_dedup.line_dedup(table(spark, rows), long_words=50, long_chars=300).collect():
        lines = dict(rows)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for k, x in enumerate(lines) if k not in gone[r.doc_id])
        assert (r.n_lines, r.n_removed) == (len(lines), len(gone[r.doc_id]))


def test_long_lines_of_documents(spark):
    from hashloom.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in load(spark, "/root/testdata/sf0.01", "documents").collect()}
    want = {i: len(x) for i, x in brute.lines_removed(texts, 3, 40, 50, 300).items()}
    assert sum(want.values()) > sum(map(len, brute.lines_removed(texts, 3, 40).values()))
    assert {r.doc_id: r.n_removed for r in QUERIES["op2_line_dedup"](spark, "/root/testdata/sf0.01").collect()} == want
