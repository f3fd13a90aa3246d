"""The programs end to end on small files."""

import gzip
import json
import zipfile

import pytest

from hashloom import schema
from hashloom.__main__ import main
from hashloom.operators import workqueue
from hashloom.sources import tables


@pytest.fixture
def archive(tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    for name, hashes in (("A", [1, 2, 522]), ("B", [2, 2**64 - 1])):
        with zipfile.ZipFile(root / f"{name}.1.sig.zip", "w") as z:
            z.writestr("s.sig", json.dumps([{"signatures": [{"ksize": 31, "mins": hashes}, {"ksize": 21, "mins": [9]}]}]))
    return root


def test_export_dedup_ingest(spark, archive, tmp_path, capsys):
    raw, unique = str(tmp_path / "raw"), str(tmp_path / "unique")
    assert main(["export", "--input-root", str(archive), "--out-root", raw, "--include-ksizes", "31,x"], spark) == 0
    assert "files=2 rows=5" in capsys.readouterr().out
    assert main(["dedup", "--non-dedup-root", raw, "--out-root", unique, "--with-counts", "--by-ksize"], spark) == 0
    tables.drop(spark, "cli_hashes")
    index = str(tmp_path / "index")
    assert main(["ingest", "--dedup-root", unique, "--table", "cli_hashes", "--mode", "create", "--analyze", "--index", index], spark) == 0
    assert capsys.readouterr().out.strip().endswith("4")
    got = {(r.ksize, r.hash, r.bucket, r.n_samples) for r in spark.table("cli_hashes").collect()}
    assert got == {(31, 1, 1, 1), (31, 2, 2, 2), (31, 522, 1, 1), (31, -1, (2**64 - 1) % 521, 1)}
    spark.createDataFrame([(522,), (-1,), (7,)], "hash long").write.parquet(str(tmp_path / "asked"))
    assert main(["probe", "--table", "cli_hashes", "--index", index, "--hashes", str(tmp_path / "asked"), "--out", str(tmp_path / "found")], spark) == 0
    assert {(r.hash, r.n_samples) for r in spark.read.parquet(str(tmp_path / "found")).collect()} == {(522, 1), (-1, 1)}
    tables.drop(spark, "cli_hashes")
    one = str(tmp_path / "one")
    assert main(["dedup", "--non-dedup-root", raw, "--out-root", one, "--max-buckets", "1"], spark) == 0
    assert {r.hash for r in spark.read.parquet(one).collect()} == {1, 522}
    assert main(["dedup", "--non-dedup-root", str(tmp_path / "no"), "--out-root", one], spark) == 2


def test_sketch(spark, tmp_path, capsys):
    root = tmp_path / "fa"
    root.mkdir()
    seq = "ACGTTGCATGCCGATAGCTAGGATCCGATTAGCAATGC" * 4
    (root / "a.fa").write_text(f">x\n{seq}\n")
    (root / "b.fna.gz").write_bytes(gzip.compress(f">y\n{seq.replace('T', 'U')}\n".encode()))
    out = str(tmp_path / "out")
    assert main(["sketch", "-i", str(root), "-o", out, "--ksizes", "21", "--scaled", "1", "--rna"], spark) == 0
    rows = spark.read.parquet(out).collect()
    by = {s: {r.hash for r in rows if r.sample_id == s} for s in ("a", "b")}
    assert by["a"] == by["b"] and by["a"]
    assert main(["sketch", "-i", str(root), "-o", out, "--dry-run"], spark) == 0
    assert capsys.readouterr().out.count("bucket=") == 2


def test_find_and_queue(spark, tmp_path, capsys):
    (tmp_path / "paths.txt").write_text("/p/a.fna\n/genomes/b.fna\n/q/c.zz\n")
    assert main(["find", "--paths", str(tmp_path / "paths.txt"), "--host", "h", "--out", str(tmp_path / "tsv"), "--include", r".*\.zz$"], spark) == 0
    text = next((tmp_path / "tsv").glob("part-*")).read_text()
    assert text == "#subtree\turl\n/p/\thttps://h/p/a.fna\n/q/\thttps://h/q/c.zz\n"
    (tmp_path / "list.csv").write_text("b,k1.fa.gz,12,2024,,\n")
    spark.createDataFrame([], schema.QUEUE).write.parquet(str(tmp_path / "s0"))
    assert main(["enqueue", "--file-list", str(tmp_path / "list.csv"), "--state", str(tmp_path / "s0"), "--out-state", str(tmp_path / "s1"), "--now", "5"], spark) == 0
    capsys.readouterr()
    assert main(["queue-stats", "--state", str(tmp_path / "s1")], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"total": 1, "by_status": {"PENDING": 1}}


def test_sketch_archives(spark, tmp_path, capsys):
    """Files to archives: existing ones are skipped unless forced, damaged ones made anew, failures reported with exit code 2."""
    from hashloom.sources import archives

    root, out = tmp_path / "fa", tmp_path / "out"
    root.mkdir()
    seq = "ACGTTGCATGCCGATAGCTAGGATCCGATTAGCAATGC" * 4
    (root / "a.fa").write_text(f">x\n{seq[:70]}\n{seq[70:]}\n>y\nACG\n")
    (root / "b.fna.gz").write_bytes(gzip.compress(f">x\n{seq}\n".encode()))
    sketch = ["sketch", "-i", str(root), "-o", str(out), "--archives", "--ksizes", "21", "--scaled", "1"]
    said = lambda: json.loads(capsys.readouterr().out)
    assert main(sketch, spark) == 0 and said() == {"done": 2, "skipped": 0, "error": 0}
    rows = archives.read_archives(spark, str(out)).collect()
    by = {s: {r.hash for r in rows if r.sample_id == s} for s in ("a", "b")}
    assert by["a"] == by["b"] and by["a"] and not list(out.rglob("*.part"))
    (root / "c.fa.gz").write_bytes(gzip.compress(b">z\nACGT\n" * 9)[:-4])
    (root / "d.fa").write_text(">only a header\n")
    next(out.rglob("a.fa.sig.zip")).write_bytes(b"half")
    assert main(sketch, spark) == 2
    shown = capsys.readouterr()
    assert json.loads(shown.out) == {"done": 1, "skipped": 1, "error": 2} and shown.err.count("c.fa.gz") == shown.err.count("d.fa") == 1
    assert main([*sketch, "--force", "--collection", "SILVA"], spark) == 2 and said()["done"] == 2


def test_crawl_and_work(spark, tmp_path, capsys):
    """Listings to queue rows to archives: the whole program, with one file that fails at every attempt."""
    base = "https://host/pub"
    pages = [(f"{base}/", '<a href="../">up</a><a href="one/">one/</a><a href="top.fna.gz">f</a>'), (f"{base}/one/", '<a href="g.fna.gz">g</a><a href="bad.fna.gz">b</a><a href="g.txt">t</a>'), ("https://other/", '<a href="no.fna.gz">n</a>')]
    spark.createDataFrame(pages, "url string, html string").write.parquet(str(tmp_path / "pages"))
    crawl = ["crawl", "--pages", str(tmp_path / "pages"), "--base-url", base, "--out-state", str(tmp_path / "s0"), "--now", "5"]
    assert main([*crawl, "--dry-run"], spark) == 0
    assert capsys.readouterr().out.split() == [f"{base}/one/bad.fna.gz", f"{base}/one/g.fna.gz", f"{base}/top.fna.gz"]
    assert main(crawl, spark) == 0
    mirror = tmp_path / "mirror"
    (mirror / "one").mkdir(parents=True)
    for name in ("top.fna.gz", "one/g.fna.gz"):
        (mirror / name).write_bytes(gzip.compress((">x\n" + "ACGTTGCATGCCGATAGCTAGGATCC" * 9 + "\n").encode()))
    (mirror / "one" / "bad.fna.gz").write_bytes(b"not gzip")
    work = ["work", "--state", str(tmp_path / "s0"), "--out-state", str(tmp_path / "v"), "--mirror", str(mirror), "--out-root", str(tmp_path / "o"), "--scaled", "1", "--max-retries", "1"]
    assert main(work, spark) == 2
    assert json.loads(capsys.readouterr().out) == {"done": 2, "skipped": 0, "error": 1}
    last = {r.filename: (r.status, r.tries) for r in workqueue.read_state(spark, str(tmp_path / "v")).collect()}
    assert last == {"top.fna.gz": ("DONE", 0), "g.fna.gz": ("DONE", 0), "bad.fna.gz": ("ERROR", 2)}
    assert main(work, spark) == 0  # once more on its own folder: nothing to do, the failed file cools down
    assert json.loads(capsys.readouterr().out) == {"done": 0, "skipped": 0, "error": 0}
    assert main(["queue-stats", "--state", str(tmp_path / "v")], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"total": 3, "by_status": {"DONE": 2, "ERROR": 1}}
    assert {p.name for p in (tmp_path / "o").rglob("*.zip")} == {"top.fna.gz.sig.zip", "g.fna.gz.sig.zip"}
