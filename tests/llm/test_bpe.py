import base64
import hashlib
import random
import struct

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm import bpe
from vigil.llm.queries import QUERIES


def load(path):
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}


RANKS = load(P.path("byte_bpe_50k.tiktoken"))
REAL = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MERGER = bpe.Merger(RANKS)
PIECES = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "Z", "é", "1", "²", "!", "#", " ",
          "　", "漢", "👍", "\x1c", "̀", "\U00013460", "\U00010D40", ".", "'ll", "'S", "<|endoftext|>"]


def ids(text):
    return np.frombuffer(bpe.encode_texts([text], MERGER)[0][0], "<u4").tolist()


@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), min_size=1, max_size=8))
@settings(max_examples=300, deadline=None)
def test_ids_and_offsets_match_the_library(texts):
    for text, (got, by_ids, by_bytes) in zip(texts, bpe.encode_texts(texts, MERGER)):
        assert np.frombuffer(got, "<u4").tolist() == REAL.encode_ordinary(text)
        ends = np.frombuffer(by_bytes, "<u4").tolist()
        assert (ends[-1] if ends else 0) == len(text.encode())
        assert len(ends) == len(by_ids) // 4


@given(st.text(max_size=200))
@settings(max_examples=200, deadline=None)
def test_any_text_matches_the_library(text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    assert ids(text) == REAL.encode_ordinary(text)


def test_every_code_point_has_the_class_of_the_library():
    """One merge per code point tells whether it joins a letter, a number or neither."""
    chars = [chr(c) for a, b in bpe.LATER_LETTERS + bpe.LATER_NUMBERS for c in range(a - 1, b + 2)]
    chars += [chr(c) for c in [*bpe.WHITE, 0x1C, 0x1F, 0x200B, 0x180E, 0xFEFF]]
    ranks = {bytes([i]): i for i in range(256)}
    for c in chars:
        raw = c.encode()
        for k in range(2, len(raw) + 1):
            ranks.setdefault(raw[:k], len(ranks))
    for head in b"a1!":
        for c in chars:
            ranks.setdefault(bytes([head]) + c.encode(), len(ranks))
    real = tiktoken.Encoding("p", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.Merger(ranks)
    texts = [h + c for c in chars for h in "a1!"]
    for t, (got, _, _) in zip(texts, bpe.encode_texts(texts, own)):
        assert np.frombuffer(got, "<u4").tolist() == real.encode_ordinary(t), repr(t)


def test_long_slices_and_long_texts():
    rng = random.Random(1)
    for text in ("a" * 20_000, "".join(rng.choice("abcxyz") for _ in range(5000)), "'" * 999 + "s", " " * 5000, "ab " * 300_000):
        assert ids(text) == REAL.encode_ordinary(text)


def test_a_span_of_slices_decodes_alone():
    text = "Don't stop, it's 42\n\nnow"
    vocabulary = bpe.Vocabulary(RANKS)
    row = dict(zip(("ids", "slice_ids", "slice_bytes"), bpe.encode_texts([text], MERGER)[0]))
    ends = [0, *np.frombuffer(row["slice_bytes"], "<u4").tolist()]
    for a in range(len(ends)):
        for b in range(a, len(ends)):
            assert bpe.decode_span(row, vocabulary, a, b) == text.encode()[ends[a]:ends[b]]


def test_query_against_the_library(spark, small, documents):
    got = {r.doc_id: r for r in QUERIES["op1_bpe"](spark, small).collect()}
    assert set(got) == set(documents)
    for i, text in documents.items():
        e = REAL.encode_ordinary(text)
        r = got[i]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(e), hashlib.sha256(struct.pack(f"<{len(e)}I", *e)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_nulls_ties_extra_columns_and_empty_tables(frame, ranks):
    df = frame([(1, None), (1, None), (None, ""), (2, "same"), (2, "same")]).withColumn("ids", F.lit("clash")).withColumn("n", F.lit(1))
    coded = bpe.encode(df, ranks, keep=("doc_id", "ids", "n"))
    assert coded.columns == ["doc_id", "n", "n_tokens", "ids", "slice_ids", "slice_bytes"]
    back = bpe.decode(coded, ranks, keep=("doc_id", "n_tokens")).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, bytes(r.decoded)) for r in back) == [
        (0, 0, b""), (1, 0, b""), (1, 0, b""), (2, 1, b"same"), (2, 1, b"same")]
    assert bpe.decode(bpe.encode(frame([]), ranks), ranks).collect() == []
    both = bpe.encode(df.withColumn("text2", F.lit(1)), ranks, decoded="text2", keep=("doc_id", "text2"))
    assert both.columns == ["doc_id", *bpe.ENCODED, "text2"]
    assert sorted(bytes(r.text2) for r in both.collect()) == [b"", b"", b"", b"same", b"same"]
    assert coded.select(bpe.ids_array(F.col("ids")).alias("a")).filter("size(a) = 1").first().a == REAL.encode_ordinary("same")


def test_unknown_ids_and_wrong_offsets_fail():
    vocabulary = bpe.Vocabulary(RANKS)
    with pytest.raises(IndexError):
        vocabulary.decode(np.array([60_000_000]))
