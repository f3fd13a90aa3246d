"""Viterbi segmentation against a plain search, and round trips."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from hashloom.llm import sentencepiece_codec as codec
from hashloom.llm.common import load

PATH = public_tokenizers.path("piece_bpe_32k.model")
MARK, OWN = "▁", "\U0010ffff"


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def plain(model):
    n = model.get_piece_size()
    pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    unknown = min(s for _, s in pieces.values()) - 10
    byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}

    def search(text):
        if not text:
            return []
        x = MARK + text.replace(MARK, OWN).replace(" ", MARK)
        best, back = [0.0] + [None] * len(x), [None] * (len(x) + 1)
        for j in range(1, len(x) + 1):
            for i in range(max(0, j - 16), j):
                p = pieces.get(x[i:j])
                if p is None and i < j - 1:
                    continue
                s = best[i] + (p[1] if p else unknown)
                if best[j] is None or s > best[j]:
                    best[j], back[j] = s, (i, p)
        out, j = [], len(x)
        while j:
            i, p = back[j]
            out = ([p[0]] if p else [byte[b] for b in (MARK if x[i] == OWN else x[i]).encode()]) + out
            j = i
        return out

    return search


def coded(texts):
    v = codec.vocabulary(PATH)
    data = [t.encode() for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in data])]).astype(np.int64)
    ids, bounds = v.encode(np.frombuffer(b"".join(data), np.uint8), starts)
    b, at = v.decode(ids.astype(np.int64), bounds)
    return [ids[x:y].tolist() for x, y in zip(bounds, bounds[1:], strict=False)], [b[x:y].tobytes().decode() for x, y in zip(at, at[1:], strict=False)]


CASES = ["  hello  world ", "a\n\nb\tc", "▁x ▁", "é日本😀\r\n", "", " ", "Ｈｅｌｌｏ ﬁ", "\x00a", "日本語の文章" * 40, "a" * 3000, "<s></s><unk><0x41>"]


def test_cases(plain):
    ids, back = coded(CASES)
    assert back == CASES
    assert ids == [plain(t) for t in CASES]


@given(st.lists(st.text(alphabet=st.sampled_from("abelo th▁ \n日é😀.,1"), max_size=30), max_size=5))
@settings(max_examples=60, deadline=None)
def test_random(plain, texts):
    ids, back = coded(texts)
    assert back == texts and ids == [plain(t) for t in texts]


@given(st.text(alphabet=st.sampled_from("ab the  ▁\n日é😀."), max_size=60), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_blocks(text, most):
    """The ids of a text's blocks are those of the whole text."""
    blocks = [bytes(b).decode() for b in codec.text_blocks(np.frombuffer(text.encode(), np.uint8), most)]
    assert " ".join(blocks) == text
    assert sum(coded(blocks)[0], []) == coded([text])[0][0]


def test_texts_of_many_blocks(spark):
    """Long texts with words of all lengths and spaces at block ends."""
    texts = [" ".join(f"word{k}" for k in range(250_000)), ("x" * 20_000 + " ") * 55 + "y", "a  " * 400_000, "日" * 400_000, "z" * 1_048_575 + " "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(codec.decode(codec.encode(df, PATH), PATH).collect())
    assert [r.text for r in rows] == texts
    whole = coded(texts[:1] + texts[2:4])[0]
    assert [rows[k].ids for k in (0, 2, 3)] == whole


def test_decoding_of_the_library_ids(model):
    texts = ["Hello  world", " x", "日本 é"]
    ids = [model.encode(t) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    b, at = codec.vocabulary(PATH).decode(np.concatenate(ids).astype(np.int64), bounds)
    assert [b[x:y].tobytes().decode() for x, y in zip(at, at[1:], strict=False)] == texts


def test_tables(spark, plain):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = codec.decode(codec.encode(docs, PATH), PATH).collect()
    assert {r.doc_id: r.text for r in rows} == texts
    assert all(r.ids == plain(texts[r.doc_id]) for r in rows if len(texts[r.doc_id]) < 1500)
    hard = spark.createDataFrame([(1, None, "x"), (None, "a b", "x"), (2, "", "x"), (3, "w" * 40_000, "x"), (3, "w" * 40_000, "x")], "doc_id long, text string, ids string")
    back = sorted(((r.doc_id, len(r.ids), r.text) for r in codec.decode(codec.encode(hard, PATH), PATH).collect()), key=str)
    assert [(i, t) for i, _, t in back] == [(1, ""), (2, ""), (3, "w" * 40_000), (3, "w" * 40_000), (None, "a b")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert codec.decode(codec.encode(empty, PATH), PATH).count() == 0
