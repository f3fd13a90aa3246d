"""SentencePiece encoding and decoding by batched Viterbi search in numpy.

A text's spaces become the mark U+2581 and a mark is put before it. It falls
into words: before a mark that follows another character, and on both sides of a character that no
piece of several characters has; no piece crosses such a place, so words can be
segmented one by one. Equal words are segmented once a chunk, and words of
equal length advance together: at each end position, the hashes of the
substrings of up to the longest piece's length probe the sorted piece keys, and
a vectorised maximum over the starts keeps the best score and its backpointer
(the longest piece of equals). The best segmentation has the greatest sum of the model's piece scores.
A character without a piece costs the least score less 10 and becomes its
UTF-8 bytes' pieces; so does a mark that the text itself has, whereby decoding is exact for every text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_chunks, text_views
from .word_kernels import U, mix, powers

MARK = 0x2581
#: Bytes of text (and pieces, when decoding) that are worked at once.
BLOCK = 1 << 20
#: Stands for a mark of the text itself; beyond all code points.
OWN_MARK = 0x110000


def code(c: np.ndarray) -> np.ndarray:
    return mix(c.astype(U) + U(0x5851F42D))


class Vocabulary:
    """Pieces of a model file in the shapes that searching needs."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        byte = {int(pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(byte) != 256:
            raise ValueError("the model has no piece for every byte")
        self.byte_ids = np.array([byte[b] for b in range(256)], np.int32)
        special = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        plain = [i for i in range(n) if i not in special and pieces[i]]
        self.longest = max(len(pieces[i]) for i in plain)
        keys = np.array([self.key(pieces[i]) for i in plain], U)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, np.int32)[order]
        self.scores = np.array([model.get_score(i) for i in plain])[order]
        self.unknown = self.scores.min() - 10
        self.seen = np.zeros(1 << 22, bool)  # a first test before the sorted keys are probed
        self.seen[self.keys >> U(42)] = True
        self.alone = np.ones(OWN_MARK + 1, bool)
        self.alone[[ord(c) for i in plain if len(pieces[i]) > 1 for c in pieces[i]]] = False
        shown = [b"" if i in special else pieces[i].replace(chr(MARK), " ").encode() for i in range(n)]
        for b, i in byte.items():
            shown[i] = bytes([b])
        self.piece_bytes = np.frombuffer(b"".join(shown), np.uint8)
        self.piece_starts = np.concatenate([[0], np.cumsum([len(x) for x in shown])])

    @staticmethod
    def key(piece: str):
        c = code(np.array([ord(x) for x in piece]))
        return mix((c * powers(len(c))[0]).sum(keepdims=True))[0]

    def probe(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash in the sorted keys, or -1."""
        out = np.full(h.shape, -1, np.int64)
        maybe = np.nonzero(self.seen[h >> U(42)])
        some = h[maybe]
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == some, at, -1)
        return out

    def segment(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over (n, length) code points: flat ids of all words in order, and how many each has."""
        n, length = words.shape
        p, inverse = powers(length + 1)
        prefix = np.zeros((n, length + 1), U)
        np.cumsum(code(words) * p[:length], axis=1, out=prefix[:, 1:])
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, length + 1), np.int64)
        piece = np.full((n, length + 1), -1, np.int64)
        rows = np.arange(n)
        for j in range(1, length + 1):
            starts = np.arange(max(0, j - self.longest), j)
            found = self.probe(mix((prefix[:, j : j + 1] - prefix[:, starts]) * inverse[starts]))
            value = np.where(found >= 0, self.scores[found], -np.inf)
            value[:, -1] = np.where(found[:, -1] >= 0, value[:, -1], self.unknown)
            value += best[:, starts]
            pick = value.argmax(axis=1)  # the first of equals: the longest piece
            best[:, j] = value[rows, pick]
            back[:, j] = starts[pick]
            piece[:, j] = found[rows, pick]
        # walk back, all words together
        at = np.full(n, length)
        steps = []
        while True:
            going = np.flatnonzero(at > 0)
            if not len(going):
                break
            end = at[going]
            start = back[going, end]
            steps.append((going, end, piece[going, end], words[going, end - 1]))
            at[going] = start
        word = np.concatenate([s[0] for s in steps])
        end = np.concatenate([s[1] for s in steps])
        chosen = np.concatenate([s[2] for s in steps])
        char = np.concatenate([s[3] for s in steps])
        order = np.lexsort((end, word))
        word, chosen, char = word[order], chosen[order], char[order]
        known = chosen >= 0
        width = np.ones(len(word), np.int64)
        coded = [self.byte_ids[list(chr(MARK if c == OWN_MARK else c).encode("utf-8", "surrogatepass"))] for c in char[~known].tolist()]
        width[~known] = [len(x) for x in coded]
        ids = np.empty(int(width.sum()), np.int32)
        first = np.cumsum(width) - width
        ids[first[known]] = self.ids[chosen[known]]
        if coded:
            places = np.repeat(first[~known], width[~known]) + np.concatenate([np.arange(len(x)) for x in coded])
            ids[places] = np.concatenate(coded)
        return ids, np.bincount(word, width, n).astype(np.int64)

    def encode(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, bounds of each text)."""
        n = len(starts) - 1
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        c = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
        heads = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=heads[1:])
        at = heads[starts]
        c = np.where(c == MARK, OWN_MARK, np.where(c == 0x20, MARK, c))
        given = np.flatnonzero(at[1:] > at[:-1])
        c = np.insert(c, at[given], MARK)
        text_start = at[given] + np.arange(len(given))
        cut = np.zeros(len(c), bool)
        alone = self.alone[c]
        cut[1:] = alone[1:] | alone[:-1] | ((c[1:] == MARK) & (c[:-1] != MARK))
        cut[text_start] = True
        s = np.flatnonzero(cut)
        e = np.append(s[1:], len(c))
        p, inverse = powers(len(c) + 1)
        total = np.zeros(len(c) + 1, U)
        np.cumsum(code(c) * p[: len(c)], out=total[1:])
        h = mix((total[e] - total[s]) * inverse[s])
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        sizes = e[first] - s[first]
        counts, offsets, pool, used = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64), [], 0
        order = np.argsort(sizes, kind="stable")
        edges = np.flatnonzero(np.append(True, np.diff(sizes[order]) > 0))
        for i, j in zip(edges, np.append(edges[1:], len(order)), strict=True):
            length = int(sizes[order[i]])
            step = max(1, 400_000 // length)
            for k in range(i, j, step):
                group = order[k : min(j, k + step)]
                ids, count = self.segment(c[s[first[group]][:, None] + np.arange(length)])
                counts[group] = count
                offsets[group] = used + np.cumsum(count) - count
                pool.append(ids)
                used += len(ids)
        pool = np.concatenate(pool)
        m = counts[which]
        ends = np.cumsum(m)
        ids = pool[np.repeat(offsets[which] - (ends - m), m) + np.arange(ends[-1])]
        total_ids = np.concatenate([[0], ends])
        bounds = total_ids[np.searchsorted(s, np.append(text_start, len(c)))]
        out = np.zeros(n + 1, np.int64)
        out[given + 1] = np.diff(bounds)
        return ids, np.cumsum(out)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, their bounds); the mark before each text goes."""
        lo, width = self.piece_starts[ids], self.piece_starts[ids + 1] - self.piece_starts[ids]
        ends = np.cumsum(width)
        size = int(ends[-1]) if len(ends) else 0
        b = self.piece_bytes[np.repeat(lo - (ends - width), width) + np.arange(size)]
        at = np.concatenate([[0], ends])[bounds]
        lead = at[:-1][(at[1:] > at[:-1])]
        lead = lead[b[lead] == 0x20] if len(lead) else lead
        keep = np.ones(len(b), bool)
        keep[lead] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        return b[keep], kept[at]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def text_blocks(raw: np.ndarray, most: int = BLOCK) -> Iterator[np.ndarray]:
    """One text in blocks of about ``most`` bytes whose ids, one after the other, are the text's.

    A block ends before a space behind another character: a word begins there, whose mark is
    the one put before the next block, so the space itself is left out. The last space of a text is no such place, as
    nothing would follow it.
    """
    at = 0
    while len(raw) - at > most:
        for i in range(at + most, len(raw), most):
            part = raw[i - 1 : min(i + most, len(raw) - 1)]
            found = np.flatnonzero((part[1:] == 0x20) & (part[:-1] != 0x20))
            if len(found):
                end = i + int(found[0])
                yield raw[at:end]
                at = end + 1
                break
        else:
            break
    yield raw[at:]


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, ids (array of int).

    Null or empty text: no ids. Null id: null doc_id. Very long texts: in blocks
    that end at a word's beginning, so memory is bounded by a block, the longest word and the text's
    ids. Repeated rows: encoded alike. Ties between segmentations: the longest last piece. Empty table: no rows. Extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for batch in batches:
            raw, starts, _ = text_views(batch, "_text")
            for i, j in doc_chunks(starts, BLOCK):
                size = starts[i : j + 1] - starts[i]
                if size[-1] > BLOCK:  # one text
                    ids = np.concatenate([v.encode(b, np.array([0, len(b)]))[0] for b in text_blocks(raw[starts[i] : starts[j]])])
                    bounds = np.array([0, len(ids)])
                else:
                    ids, bounds = v.encode(raw[starts[i] : starts[j]], size)
                listed = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), listed], ["doc_id", "ids"])

    chosen = df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    return chosen.mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, model_path: str) -> DataFrame:
    """Per row (doc_id, ids): doc_id, ids, text. Control pieces and the unknown piece give nothing; null and empty ids give an empty text. A null doc_id stays, repeated rows are worked
    each, an empty table gives no rows, extra columns are not read. Texts are joined to about BLOCK bytes, a longer one is worked whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for batch in batches:
            listed = batch.column(1)
            sizes = np.asarray(listed.value_lengths().fill_null(0), np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            ids = np.asarray(listed.flatten(), np.int64)
            for i, j in doc_chunks(bounds, BLOCK >> 2):
                b, at = v.decode(ids[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                data = b.tobytes()
                texts = [data[x:y].decode("utf-8", "replace") for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), listed.slice(i, j - i), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
