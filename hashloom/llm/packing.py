"""Harmonic packing of tokenised documents into fixed-length sequences.

Every worker packs its own partition; nothing is shuffled. A document of n
tokens fills n // capacity sequences alone. What is left is cut, with at
most ``cuts`` cuts, at the largest power of two (a length capacity / 2**j is
exactly one 2**j-th of a bin), and the last piece goes to its reciprocal-capacity class:
class k holds lengths in (capacity / (k + 1), capacity / k], and a bin of
class k takes exactly k pieces. Only the open bins at the end of a partition
are merged, by first fit, so the padding there is bounded by the number of
classes, not by the documents.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Partition number times this is the first sequence id of a partition.
SEQUENCES = 1 << 36


#: Texts on which the fast engine must give the file's ids: contractions, runs of blanks, digits, scripts, marks, controls.
PROBES = (
    "It's  a pr\u00f6be\n\n of 12345 things,\tthey'll say: \u00ab\u00e9t\u00e9\u00bb \u65e5\u672c\u8a9e \U0001f600 #$%  \n x",
    "I'VE you're  'tis 'S\u2019s don't\u00a0\u00a0stop \u3000 \u200b\u2028 e\u0301 \u0e01\u0e33 \u0939\u093f\u0902\u0926\u0940 \u0661\u0662\u0663 \u00bd\u2167",
    " lead and trail \r\n\r\n\t\t \x00\x1f\x7f\ufffd ___---===+++ aaaaaaaaaaaaaaaaaaaaaaaa AAAA1234567890aaaa https://a.b/c?d=e&f",
    "<|endoftext|>a <|endoftext|> b<|endoftext|><|end of text|><|endoftext|",
)


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str):
    """Ids of a text under the byte-level BPE file at ``path``, as the library's encode(text, add_special_tokens=False) gives them.

    So the strings of the file's special tokens are these tokens, as the file has it. The
    vocabulary's ids are its merge ranks, so the ranks engine gives the ids of what stands between special tokens
    several times faster; PROBES are compared at start and the library's own engine used if they differ.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)

    def by_file(text: str) -> list[int]:
        return slow.encode(text, add_special_tokens=False).ids

    try:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        vocab, special = given["model"]["vocab"], {t["content"]: t["id"] for t in given["added_tokens"]}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        back = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(back[c] for c in token): i for token, i in vocab.items() if all(c in back for c in token) and token not in special}
        engine = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    except (ImportError, KeyError):
        return by_file

    def fast(text: str) -> list[int]:
        return by_file(text) if any(s in text for s in special) else engine.encode_ordinary(text)

    # the last probe's pieces go through the engine too
    return fast if all(fast(p) == by_file(p) for p in (*PROBES, *PROBES[-1].split("<|endoftext|>"))) else by_file


def cut_lengths(n: int, capacity: int, cuts: int) -> list[int]:
    """Lengths of the pieces of n tokens: whole sequences, powers of two, and a rest."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        top = 1 << (rest.bit_length() - 1)
        if cuts <= 0 or capacity & (capacity - 1) or top == rest:
            out.append(rest)
            break
        out.append(top)
        rest -= top
        cuts -= 1
    return out


class Packer:
    """The bins of one worker; ``add`` gives finished pieces, ``finish`` those of the open bins."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next, self.bins = capacity, first_sequence, {}

    def _close(self, pieces):
        at, out = 0, []
        for piece in pieces:
            out.append((*piece, self.next, at))
            at += piece[2]
        self.next += 1
        return out

    def add(self, piece):
        """piece: (doc_id, start, length, crc, doc_tokens)."""
        k = self.capacity // piece[2]
        held = self.bins.setdefault(k, [])
        held.append(piece)
        if len(held) < k:
            return ()
        del self.bins[k]
        return self._close(held)

    def finish(self):
        """First fit, longest first, over the pieces of the bins still open; at most k - 1 for each class k."""
        left = sorted((p for held in self.bins.values() for p in held), key=lambda p: -p[2])
        self.bins, open_bins = {}, []
        for piece in left:
            for b in open_bins:
                if b[0] + piece[2] <= self.capacity:
                    b[0] += piece[2]
                    b[1].append(piece)
                    break
            else:
                open_bins.append([piece[2], [piece]])
        return [row for _, pieces in open_bins for row in self._close(pieces)]


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 0, cuts: int = 3) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are its text's, then ``end_id``; each id lies in exactly
    one piece, and the pieces of a sequence lie gapless from offset 0.
    sequence_id is unique over the table and depends on the partitioning alone.

    Null text: empty, so one piece with the end id. Null id: packed, with a null doc_id.
    Very long texts: tokenised whole, one at a time. Repeated rows: each is
    packed. Empty table: no rows. Extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer_path)
        packer = Packer(capacity, TaskContext.get().partitionId() * SEQUENCES)
        names = [x.split()[0] for x in PIECES.split(", ")]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

        rows = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                at = 0
                for n in cut_lengths(len(ids), capacity, cuts):
                    rows += packer.add((doc_id, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids)))
                    at += n
                if len(rows) > 50_000:
                    yield table(rows)
                    rows = []
        rows += packer.finish()
        if rows:
            yield table(rows)

    return df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, PIECES)
