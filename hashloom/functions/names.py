"""Rules on file names, paths, links and URLs as column expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: names of sequence files.
FASTA = r"(?i)\.(fa|fna|fasta)(\.gz)?$"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def sample_id(path: Column) -> Column:
    """The sample of an archive's name: without ``.sig.zip`` and a sequence suffix, up to the first dot."""
    name = F.regexp_replace(base_name(path), r"(?i)\.sig\.zip$", "")
    return F.substring_index(F.regexp_replace(name, FASTA, ""), ".", 1)


def is_fasta(path: Column) -> Column:
    return path.rlike(FASTA)


def is_target(path: Column, include: str, exclude: str | None = None) -> Column:
    """Whether the base name matches ``include`` from its start and, which comes first, doesn't match ``exclude``."""
    name = base_name(path)
    ok = name.rlike(f"^(?:{include})")
    return ok if not exclude else ~name.rlike(f"^(?:{exclude})") & ok


def hrefs(html: Column) -> Column:
    """All values of href attributes in double quotes."""
    return F.regexp_extract_all(html, F.lit('(?i)href="([^"]+)"'), 1)


def listing_entries(links: Column) -> Column:
    """The links of a directory listing that name its own entries: no query, no parent, no absolute path or URL, no path of several steps."""
    cut = F.transform(links, lambda x: F.substring_index(F.trim(x), "?", 1))

    def own(x: Column) -> Column:
        inner = F.regexp_replace(x, "/+$", "")
        return ~x.isin("", "../", "./") & ~x.startswith("/") & ~F.contains(x, F.lit("://")) & ~F.contains(inner, F.lit("/"))

    return F.filter(cut, own)


def is_suspicious(path: Column) -> Column:
    """Whether a path has a step that ends in a dot, such as one that leads back."""
    return F.contains(path, F.lit("./"))


def has_prefix(path: Column, prefixes) -> Column:
    """Whether a path begins with one of few constant prefixes."""
    return functools.reduce(lambda a, b: a | b, (path.startswith(p) for p in sorted(set(prefixes))), F.lit(False))


def first_label(name: Column, patterns) -> Column:
    """Label of the first (label, pattern) that matches from the start of the name, whatever the case; else null."""
    out = F.lit(None).cast("string")
    for label, pattern in reversed(list(patterns)):
        out = F.when(name.rlike(f"(?i)^(?:{pattern})"), F.lit(label)).otherwise(out)
    return out


def quoted_path(path: Column) -> Column:
    """A path with each step percent-encoded as by RFC 3986; slashes stay."""
    q = F.url_encode(path)
    for shown, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        q = F.replace(q, F.lit(shown), F.lit(wanted))
    return q


def https_url(host: str, path: Column) -> Column:
    return F.concat(F.lit(f"https://{host}/"), quoted_path(F.regexp_replace(F.regexp_replace(path, "^/+", ""), "/+", "/")))


def s3_url(bucket: Column, key: Column, region: str) -> Column:
    return F.concat(F.lit("https://"), bucket, F.lit(f".s3.{region}.amazonaws.com/"), key)


def size_or_null(text: Column) -> Column:
    """A size of digits only as BIGINT, else null."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def rna_to_dna(sequence: Column) -> Column:
    """U as T in a sequence; headers are other columns and stay."""
    return F.translate(sequence, "U", "T")


def backoff_seconds(tries: Column, most: int = 300, base: float = 1.0) -> Column:
    """min(most, base * 2 ** tries): by default a failed file's wait; with base 3 and no bound to speak of, a failed listing's."""
    return F.least(F.lit(float(most)), F.lit(float(base)) * F.pow(F.lit(2.0), F.least(tries, F.lit(62))))
