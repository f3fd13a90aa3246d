"""Merkle manifest, SimHash links and the divergence audit against plain versions and SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from hashloom.llm import divergence, merkle, simhash

from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, fp string, term string"


def table(spark, rows, tmp_path=None):
    """Rows (doc_id, text, lang, source, n_chars) with columns whose names the operators use inside."""
    df = spark.createDataFrame([(*r, "clash", 7, "clash", "clash") for r in rows], DOCS)
    if tmp_path is None:
        return df
    df.write.parquet(f"{tmp_path}/documents")
    return df


def sql(query, tmp_path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    found = con.sql(query)
    return sorted(repr(dict(zip(found.columns, r, strict=True))) for r in found.fetchall())


def told(df, columns):
    return sorted(repr({c: r[c] for c in columns}) for r in df.collect())


def hostile(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "a:b", "-", "é😀", "x" * 9, " ".join(rng.choice(["ab", "Cd", "éf", "g-h", "i1j"]) for _ in range(rng.randrange(30)))])
        rows.append((i * 3, text, rng.choice([None, "", "en", "en", "en", "de", "é", "Z", "-"]), rng.choice([None, "", "s1", "s2"]), None if i % 11 == 0 else i))
    return rows


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def proofs(rows):
    """Plain Merkle trees of rows with unique ids: doc_id -> (leaf, subroot, root, proof digest, folded root)."""

    def leaf(doc_id, text, lang, source, n):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))

    def climb(nodes):
        """(root, the siblings of each node with their side)"""
        paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
        while len(level) > 1:
            for k, i in enumerate(at):
                paths[k].append((level[i ^ 1] if i ^ 1 < len(level) else None, i & 1))
            level = [H(*level[i : i + 2]) for i in range(0, len(level), 2)]
            at = [i // 2 for i in at]
        return level[0], paths

    by_lang: dict = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: climb([leaf(*r) for r in by_lang[x]]) for x in langs}
    root, above = climb([trees[x][0] for x in langs])
    out = {}
    for k, x in enumerate(langs):
        for r, path in zip(by_lang[x], trees[x][1], strict=True):
            n = r[4] + 1 if r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else r[4]
            own, path = leaf(*r[:4], n), path + above[k]
            for d, left in path:
                own = H(own) if d is None else H(d, own) if left else H(own, d)
            out[r[0]] = (leaf(*r), trees[x][0], root, H(*(d for d, _ in path if d)), own)
    return out


def audited(df, **how):
    return merkle.merkle_audit(df, F.crc32(F.col("doc_id").cast("string")) % 7 == 0, **how)


@pytest.mark.parametrize(("n", "step"), [(1, 6), (2, 1), (67, 2), (300, 3), (300, 6)])
def test_merkle_proofs(spark, n, step):
    rows = hostile(n)
    got = {r.doc_id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in audited(table(spark, rows), step=step).collect()}
    assert got == proofs(rows)


def test_merkle_sql_and_repeated_rows(spark, tmp_path):
    rows = hostile(150)
    df = table(spark, rows, tmp_path)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert told(audited(df), columns) == sql(merkle.ORACLE, tmp_path)
    # repeated rows, null ids and several texts of one id: every row has a proof that holds
    odd = [(5, "a", "en", "s", 1)] * 40 + [(5, "b", "en", "s", 1), (None, "c", "en", "s", 2), (None, None, None, None, None)]
    got = merkle.merkle_audit(table(spark, odd)).collect()
    assert len(got) == 43 and all(r.verified for r in got) and len({r.root for r in got}) == 1
    assert merkle.merkle_audit(table(spark, [])).collect() == []


def test_merkle_stores_every_few_levels(spark, tmp_path):
    rows = table(spark, [(i, "t", "en", "s", 1) for i in range(1000)])
    leaves = rows.select(F.col("lang").alias("group"), F.col("doc_id").alias("order"), merkle.leaf_digest(F.col("doc_id")).alias("leaf"))
    made = merkle.build_manifest(leaves, step=4, keep=f"file://{tmp_path}/manifest")
    assert [level.count() for level in made.levels] == [1000, 63, 4, 1] and len(made.roots) == 1
    assert spark.read.parquet(f"file://{tmp_path}/manifest/level2").count() == 4
    assert made.root().first()[0] == made.subroots().first().subroot
    assert all(len(r.path) == 10 for r in made.proofs().select("path").collect())


def bits_of(text):
    w = brute.WORD.findall((text or "").translate(brute.LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def linked(prints, distance=2):
    """The smallest index that each of the values reaches."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def varied(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    texts = [None, "", " \t\n", "one", "one two", "One  two\x0bthree", "one two three", "é É ß", "a b c " * 4000]
    for _ in range(6):
        base = [rng.choice(words) for _ in range(400)]
        for _ in range(20):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(400)] = rng.choice(words)
            texts.append(rng.choice([" ", "\n"]).join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("most", [1, 64])
def test_simhash_documents(spark, most):
    rows = varied()
    prints = [bits_of(t) for _, t in rows]
    want = {i: (f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, linked(prints), strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_duplicates(table(spark, [(i, t, "en", "s", 1) for i, t in rows]), most=most).collect()}
    assert got == want
    assert len(set(prints)) > len({c for _, c in want.values()}) + 5  # links between different fingerprints


@pytest.mark.parametrize("most", [1, 4, 64, 10**9])
@pytest.mark.parametrize("seed", [1, 2])
def test_simhash_links_of_crowded_segments(spark, most, seed):
    rng = random.Random(seed)
    prints = {0, (1 << 64) - 1, 1 << 63, (1 << 63) | 1}
    for _ in range(4):
        middle = rng.getrandbits(64)
        within = rng.choice([range(64), range(32), range(32, 64), range(8)])
        for _ in range(60):
            prints.add(middle ^ sum(1 << j for j in rng.sample(list(within), rng.randrange(5))))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = [(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), most).collect()]
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2 and a != b for a, b in edges)
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    want = linked(prints)
    roots = [find(p) for p in signed]
    assert len(set(zip(roots, want, strict=True))) == len(set(roots)) == len(set(want))


def test_simhash_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(4, text), (4, text), (3, text), (None, text), (7, "quite another text"), (7, None), (8, ""), (None, "nobody else has this one")]
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_duplicates(table(spark, [(i, t, "en", "s", 1) for i, t in rows])).collect()), key=repr)
    want = [(i, f"{bits_of(t):016x}", c) for (i, t), c in zip(rows, [3, 3, 3, 3, 7, 7, 7, None], strict=True)]
    assert got == sorted(want, key=repr)
    assert simhash.simhash_duplicates(table(spark, [])).collect() == []


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_simhash_blocks_of_long_texts(block):
    text = " ".join(str(i * i) for i in range(300)).encode() + b" " + b"x" * 400 + b"  y"
    whole = [int(h) for part in simhash.shingle_hashes(text) for h in part]
    assert [int(h) for part in simhash.shingle_hashes(text, block=block) for h in part] == whole and len(whole) == 300


def test_divergence_sql(spark, tmp_path):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("x", "Y", "é", "ß") for b in ("a", "bb", "CC", "d1e", "f-g")]
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "é", None])
        weights = [1 + 7 * (zlib.crc32(f"{w}{source}".encode()) % 5 == 0) for w in words]
        rows.append((i % 300, rng.choice([None, ""]) if i % 17 == 0 else " ".join(rng.choices(words, weights, k=rng.randrange(12))), lang, source, 1))
    rows += [(900, "rare words alone", "fr", "s0", 1), (901, "", "fr", "s1", 1), (902, "one", "it", "s0", 1)]
    df = table(spark, rows, tmp_path)
    got = divergence.divergence_audit(df)
    assert told(got, got.columns) == sql(divergence.ORACLE, tmp_path)
    assert divergence.divergence_audit(table(spark, [])).collect() == []


def test_divergence_ties_and_zero_counts(spark):
    # two terms with equal counts everywhere: ranked by name; the second source has none of them
    rows = [(i, "beta alpha", "en", "s0", 1) for i in range(10)] + [(10, "", "en", "s1", 1)]
    got = {(r.part, r.source, r.item): (r.value, r["rank"]) for r in divergence.divergence_audit(table(spark, rows)).collect()}
    p = 1 + 10**9 * 12 // 24
    q = 1 + 10**9 * 2 // 4
    value = 2 * ((p - q) ** 2 // (p + q))
    assert got[("pair", "s0", "s1")] == got[("pair", "s1", "s0")] == (value, 1)
    assert all(part == "pair" for part, _, _ in got)  # no term is more frequent than in the language


def test_divergence_terms_of_long_texts(monkeypatch):
    text = ("Ab cd-é " * 50 + "z" * 300 + " ab").encode()
    from collections import Counter

    whole, cut = Counter(), Counter()
    seen = divergence._terms(text, whole)
    monkeypatch.setattr(divergence, "BLOCK", 37)
    assert divergence._terms(text, cut) == seen and cut == whole and whole[b"ab"] == 51
