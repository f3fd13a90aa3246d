"""Exact dedup, license scan, quality rules, toxicity and packing."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from hashloom.llm import exact_dedup, license_scan, license_templates, packing, quality_rules, toxicity
from hashloom.llm.common import load

from . import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_words string, bucket string, _id string"
HARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "same text here"), (5, "same text here"), (None, "same text here"), (6, "é日本 😀 x" * 30),
    (7, "word " * 30_000), (7, "word " * 30_000), (8, "All rights reserved. CC-BY. GNU General Public License all rights reserved"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return load(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(*r, "en", None, "clash", "clash", "clash") for r in HARD], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_dedup(docs, texts, keep):
    groups = {}
    for i, t in texts.items():
        groups.setdefault(t or "", []).append(i)
    for r in exact_dedup.exact_dedup(docs, keep=keep).collect():
        g = groups[texts[r.doc_id] or ""]
        best = min(g) if keep == "min" else max(g)
        assert (r.keep_id, r.group_size, r.kept) == (best, len(g), r.doc_id == best)
        assert r.text_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_exact_dedup_hard(spark, hard, empty):
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(hard).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True), (4, 4, 3, True), (5, 4, 3, False), (None, 4, 3, False), (6, 6, 1, True), (7, 7, 2, True), (7, 7, 2, True), (8, 8, 1, True)], key=str
    )
    assert exact_dedup.exact_dedup(empty).count() == 0
    with pytest.raises(ValueError, match="keep"):
        exact_dedup.exact_dedup(hard, keep="any")


@pytest.mark.parametrize("runs", [1, 2, 5, 64, 300])
def test_tree_merge_levels(spark, runs):
    rows = spark.range(1000).select(F.col("id").alias("_id"), (F.col("id") % 10).cast("string").alias("_sha"), F.lit(1).alias("_len"), F.lit(1).alias("_xx"), F.pmod(F.xxhash64("id"), F.lit(runs)).alias("_run"))
    got = exact_dedup.tree_merge(rows, runs, fan_in=2)
    assert sorted((r._sha, r._keep, r._size) for r in got.collect()) == [(str(k), k, 100) for k in range(10)]
    assert "SortAggregate" in got._jdf.queryExecution().executedPlan().toString()
    most = exact_dedup.tree_merge(rows, runs, fan_in=2, keep="max").collect()
    assert sorted((r._sha, r._keep, r._size) for r in most) == [(str(k), 990 + k, 100) for k in range(10)]


def test_license_base(docs, texts):
    for r in license_scan.license_scan(docs).collect():
        n, at, labels = brute.license_base(texts[r.doc_id] or "")
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(at), ",".join(labels))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_notices(spark, hard, empty):
    mit = "x y Permission is hereby granted, free of charge, to any person (really) obtaining a copy of this software z"
    cases = {
        1: mit, 2: "Licensed under the Apache License, Version 2.0.", 3: "permission of the person to copy this", 4: "released under the MIT License. " * 3,
        5: "all all rights rights reserved all rights reserved", 6: "general public license", 7: "GENERAL-PUBLIC_LICENSE",
    }
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(list(cases.items()), "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(1, 8)] == ["mit", "apache-2.0", "", "mit", "reserved", "", "gpl"]
    texts = license_templates
    labels = {
        "licensed under the gnu general public license version 3": "gpl,gpl-3.0",
        "licensed under the GNU General Public License, version 2 of it": "gpl,gpl-2.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
        "licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
        "Apache License Version 2.0": "apache-2.0",
        "// SPDX-License-Identifier: MIT": "mit",
        "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by,cc-by-sa",
        "MIT License MIT License MIT License": "mit",
        "see the MIT licence": "mit",
        "under the Mozilla Public License 2.0": "mpl-2.0",
        "placed under the Unlicense": "unlicense",
        "this is licensed under GPLv3.": "gpl-3.0",
        "this is free and the license is in the file": "",
        **{text: label for label, _, text in (texts.TEXTS[2], texts.TEXTS[4], texts.TEXTS[5], texts.TEXTS[7], texts.TEXTS[10], texts.TEXTS[12])},
        texts.TEXTS[5][2].replace("the copyright holder nor", "the University of Anywhere nor").replace("1.", "*"): "bsd-3-clause",
    }
    rows = license_scan.license_scan(spark.createDataFrame(list(enumerate(labels)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in rows} == dict(enumerate(labels.values()))
    assert all((r.score > 0.75) == bool(r.labels) for r in rows)
    assert got[5].n_base == 1 and got[5].first_word == 5
    assert got[3].score == 0.0
    rows = license_scan.license_scan(hard).collect()
    assert len(rows) == len(HARD)
    eight = next(r for r in rows if r.doc_id == 8)
    assert (eight.n_base, eight.first_word, eight.last_word, eight.base_labels) == (4, 0, 9, "cc-by,gpl,reserved")
    assert [r.n_words for r in rows if r.doc_id == 7] == [30_000, 30_000]
    assert license_scan.license_scan(empty).count() == 0


@pytest.mark.parametrize("every", [4, 6, 8, 10, 20])
def test_license_texts_with_foreign_words(spark, every):
    """A long template with a foreign word after every few words, its deciding words left whole, keeps its label and gets no other."""
    cases, want = [], []
    for label, deciding, text in license_templates.templates():
        words = text.split()
        if len(license_scan.plain_words(text)) < 25:
            continue
        plain = [license_scan.plain_words(w) for w in words]
        whole = set()
        for d in map(license_scan.plain_words, deciding):
            flat = [(x, k) for k, p in enumerate(plain) for x in p]
            at = next(i for i in range(len(flat)) if [x for x, _ in flat[i : i + len(d)]] == d)
            whole |= {flat[i][1] for i in range(at, at + len(d) - 1)}
        out = []
        for k, w in enumerate(words):
            out.append(w)
            if k % every == every - 1 and k not in whole:
                out.append("qwx")
        cases.append(" ".join(["before"] * 40 + out + ["after"] * 40))
        want.append(label)
    rows = license_scan.license_scan(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")).collect()
    found = {r.doc_id: [x for x in r.labels.split(",") if x not in ("gpl", "reserved")] for r in rows}
    assert [found[i] for i in range(len(cases))] == [[label] for label in want]


def test_license_templates_are_told_apart(spark):
    """Each template's own text gets its label, and no label of a template that it doesn't hold whole."""
    given = license_templates.templates()
    rows = license_scan.license_scan(spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(given)], "doc_id long, text string")).collect()
    for r in rows:
        label, text = given[r.doc_id][0], " ".join(license_scan.plain_words(given[r.doc_id][2]))
        others = set(r.labels.split(",")) - {label, "gpl", "reserved", "cc-by"}
        assert label in r.labels.split(",") and all(any(" ".join(license_scan.plain_words(t)) in text for x, _, t in given if x == o) for o in others), (r.labels, text)


def test_license_votes(spark, docs, texts):
    """Labels and spans against voting over all pairs of positions, on mangled templates and on the documents."""
    rng = random.Random(9)
    given = license_templates.templates()
    made = {}
    for i in range(80):
        words = []
        for _ in range(rng.randrange(1, 4)):
            body = rng.choice(given)[2].split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                if not body:
                    break
                at = rng.randrange(len(body))
                body[at : at + rng.randrange(2)] = rng.choice([[], ["inserted"], ["two", "words"], ["the"], ["version"]])
            words += body + [rng.choice(["software", "license", "x", "of the"]) for _ in range(rng.randrange(6))]
        made[10**6 + i] = " ".join(words)
    made |= {i: t for i, t in texts.items() if len(t or "") < 6000}
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    got: dict = {}
    for r in license_scan.license_hits(df).where("NOT phrase").collect():
        got.setdefault(r._id, set()).add((r.label, r.first, r.last, r.share))
    want = {i: brute.license_spans(t or "", given) for i, t in made.items()}
    assert got == {i: x for i, x in want.items() if x}
    assert sum(len(x) for x in want.values()) > 80


def test_statistics(docs, texts):
    for r in quality_rules.statistics(docs).collect():
        assert tuple(r[c] for c in quality_rules.STATS) == brute.statistics(texts[r.doc_id] or "")


def test_statistics_random():
    rng = random.Random(5)
    made = ["".join(rng.choice(["a", "b", " ", "\n", "é", "#", "\t", " "]) for _ in range(rng.randrange(200))) for _ in range(300)]
    data = [t.encode() for t in made]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    got = quality_rules.text_statistics(np.frombuffer(b"".join(data), np.uint8), starts)
    assert [tuple(x) for x in got.tolist()] == [brute.statistics(t) for t in made]


def test_quality_rejects_outliers_only(spark):
    rng = random.Random(3)
    words = ["the", "quick", "brown", "foxes", "jumping", "over", "lazy", "dogs", "running", "home", "again", "today"]
    rows = [(i, " ".join(rng.choice(words) + str(rng.randrange(1000)) for _ in range(rng.randrange(60, 400))), "en", "big" if i % 3 else "small") for i in range(600)]
    rows += [(1000 + i, " ".join(rng.choice(words) + "%%%" for _ in range(100)), "en", "big") for i in range(20)]
    rows += [(2000, "few words", "en", "big"), (2001, "again and again the same eight words stand here " * 20, "en", "tiny"), (2002, None, None, None)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(600))
    assert not any(got[1000 + i].kept or got[1000 + i].base_failed for i in range(20))
    assert all(got[i].base_failed and not got[i].kept for i in (2000, 2001, 2002))


def plain_mcd(x, part, share=0.75):
    """Squared distances of the rows x by the group's estimate, in numpy: the same starts, all in memory."""
    floor = np.array(list(quality_rules.VECTOR.values())) ** 2

    def quantile(v, share):
        return np.sort(np.floor(v * 1000 + 0.5))[int(np.ceil(len(v) * share)) - 1] / 1000

    def factor(m, c):
        c = c.copy()
        np.fill_diagonal(c, np.maximum(np.diag(c), floor))
        return m, np.linalg.cholesky(c)

    def of(rows):
        return factor(rows.mean(axis=0), np.cov(rows.T, bias=True))

    def distance(m, low):
        return (np.linalg.solve(low, (x - m).T) ** 2).sum(axis=0)

    def step(params):
        d = np.log1p(distance(*params))
        return of(x[np.floor(d * 1000 + 0.5) <= np.floor(quantile(d, share) * 1000 + 0.5)])

    def log_det(params):
        return 2 * np.log(np.diag(params[1])).sum()

    def scale(params):
        return max(1.0, np.expm1(quantile(np.log1p(distance(*params)), 0.5)) / quality_rules.chi2_quantile(0.5))

    middle = np.array([quantile(c, 0.5) for c in x.T])
    spread = np.array([quantile(abs(c - m), 0.5) for c, m in zip(x.T, middle, strict=True)])
    starts = [factor(middle, np.diag((spread * 1.4826) ** 2)), of(x), *(of(x[part == k]) for k in range(quality_rules.THIRDS))]
    for _ in range(quality_rules.FIRST_STEPS):
        starts = [step(p) for p in starts]
    best = min(starts, key=log_det)
    for _ in range(quality_rules.MOST_STEPS):
        following = step(best)
        if log_det(best) - log_det(following) < 1e-4:
            break
        best = following
    again = of(x[distance(*best) <= scale(best) * quality_rules.chi2_quantile(0.975)])
    return distance(*again) / scale(again)


def test_quality_against_numpy(spark):
    """The verdict on all documents of a size against a plain estimate; one language is one group, so each group stops for itself."""
    docs = load(spark, "/root/testdata/sf0.01", "documents").where("lang = 'en'").withColumn("source", F.lit("all"))
    names = list(quality_rules.VECTOR)
    rated = quality_rules.vectors(quality_rules.statistics(docs)).withColumn("part", F.pmod(F.xxhash64("doc_id", *names), F.lit(quality_rules.THIRDS)))
    rows = {r.doc_id: r for r in rated.collect()}
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    passed = [i for i in rows if not got[i].base_failed]
    want = plain_mcd(np.array([[rows[i][c] for c in names] for i in passed]), np.array([rows[i].part for i in passed]))
    assert np.allclose([got[i].distance for i in passed], want, rtol=1e-6)
    cutoff = quality_rules.chi2_quantile(1 - 1e-9)
    assert [got[i].kept for i in passed] == (want <= cutoff).tolist() and 0 < sum(want > cutoff) < 0.15 * len(want)
    failed = {i for i in rows if rows[i].n_words < 20 or 100 * rows[i].n_repeat_words > 30 * rows[i].n_words}
    assert failed == {i for i in got if got[i].base_failed} and not any(got[i].kept for i in failed)


def test_chi2_quantiles():
    for share, want in ((0.5, 3.3567), (0.975, 11.1433), (0.999, 18.4668)):
        assert abs(quality_rules.chi2_quantile(share) - want) < 1e-4


def test_quality_hard(hard, empty):
    assert quality_rules.quality_rules(hard).count() == len(HARD)
    assert quality_rules.quality_rules(empty).count() == 0


def test_toxicity_held_out(spark):
    docs, labels = load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.train(docs, labels.where("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    rest = docs.join(labels.where("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("label")), "doc_id")
    rows = toxicity.score(rest, model, carry=("label",)).collect()
    bad = [r for r in rows if r.label == 1]
    assert sum(r.toxic for r in bad) >= 0.9 * len(bad) > 0
    assert sum(r.toxic for r in rows if r.label == 0) <= 0.01 * (len(rows) - len(bad))
    assert all(0 <= r.severity <= 3 for r in rows)


def test_severity_grows_with_evidence():
    rng = np.random.default_rng(1)
    n, keys = 400, np.array([100, 101, 102], np.uint64)
    bad = np.where(np.arange(n) % 2, rng.integers(0, 4, n), 0)
    row = np.repeat(np.arange(n), bad)
    feature = np.concatenate([np.arange(x) for x in bad])
    model = toxicity.fit(n, row, feature, np.ones(len(row)), (bad > 0).astype(float), keys, np.ones(3, bool))
    of = lambda *w: model.severity(1, np.zeros(len(w), int), np.array(w, np.uint64))[0][0]
    assert of(5) < of(5, 100) < of(5, 100, 101) <= of(5, 100, 101, 102)
    assert of(5, 100) < of(5, 100, 100, 100)


def test_toxicity_hard(spark, hard, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(hard, none)
    assert {(r.severity, r.toxic) for r in toxicity.score(hard, model).collect()} == {(0.0, False)}
    labels = spark.createDataFrame([(4, 1, 1), (5, 1, 0), (None, 1, 1), (6, 0, None)], "doc_id long, quality int, toxic int")
    assert toxicity.score(hard, toxicity.train(hard, labels)).count() == len(HARD)
    assert toxicity.score(empty, model).count() == 0


PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_packing(rows, texts, capacity=1024):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids = np.array([*t.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding / sum(r.length for r in rows)


def test_packing(docs, texts):
    assert check_packing(packing.pack(docs, PATH).collect(), texts) < 0.02


def test_packing_hard(spark, hard, empty):
    single = hard.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check_packing(packing.pack(single, PATH).collect(), {i: t for i, t in HARD if i is not None})
    rows = packing.pack(hard, PATH).collect()
    assert sum(r.start == 0 for r in rows if r.doc_id == 7) == 2 and any(r.doc_id is None for r in rows)
    assert packing.pack(empty, PATH).count() == 0


def test_packing_special_strings(spark):
    """A special token's string in a text is that token, as the library's call has it."""
    made = {1: "a <|endoftext|> b", 2: "<|endoftext|>", 3: "x<|endoftext|><|endoftext|>y" * 200, 4: "<|endoftext", 5: "<|ENDOFTEXT|> <s> </s>"}
    rows = packing.pack(spark.createDataFrame(list(made.items()), "doc_id long, text string"), PATH).collect()
    check_packing(rows, made)
    assert packing.byte_bpe(PATH)(made[1]) == [64, 220, 50256, 275]


def test_ids_are_the_files():
    from tokenizers import Tokenizer

    rng = random.Random(11)
    parts = [*packing.PROBES, "'s", "'LL", " ", "\n", "\t", "\u00a0", "\u3000", "\u0e01", "7", "42", "\u00e9", "e\u0301", "\u4e2d", "<|endoftext|>", "the", "The", "_", "\U0001f468\u200d\U0001f469"]
    t, ids = Tokenizer.from_file(PATH), packing.byte_bpe(PATH)
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert ids(text) == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 2, 511, 1000, 1023, 1024, 1025, 5000])
def test_cuts(n):
    lengths = packing.cut_lengths(n, 1024, 3)
    assert sum(lengths) == n and max(lengths) <= 1024 and len(lengths) <= n // 1024 + 4
    assert sum(packing.cut_lengths(n, 1000, 3)) == n
