"""Token counts and the codec against the library."""

import struct

import numpy as np
import pytest

from starloom.llm import sentencepiece_codec as codec
from starloom.llm import token_counts as counts

from .helpers import SF, SCHEMA, awkward


@pytest.fixture(scope="module")
def model():
    return counts.default_model()


def test_counts_equal_the_library(spark, model):
    sp = counts.load(model)
    docs = awkward(spark).select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    odd = ["<s> </s> <unk> <0x41>", "▁▁ x▁y", " \n \n", "a\r\nb", "  \n  x", "\n", " ", "a ", "\t\ttab", ");\r\n});"]
    docs = docs.unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    for r in counts.token_counts(docs).collect():
        text = r["text"] or ""
        assert (r["n_tokens"], r["n_bytes"]) == (len(sp.encode(text)), len(text.encode())), text[:80]
    assert counts.query(docs).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_proved_tokens_are_single(model):
    sp = counts.load(model)
    marked, bare = counts.proved_tokens(model)
    assert len(marked) > 10_000 and all(len(sp.encode(w)) == 1 for w in marked)
    assert len(bare) > 10_000


def test_pieces_that_cross_are_refused():
    with pytest.raises(ValueError):
        counts.check_pieces(["a▁b"])


def _varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _fields(data):
    at = 0

    def number():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        key = number()
        kind = key & 7
        size = {0: None, 1: 8, 5: 4}[kind] if kind != 2 else number()
        if size is None:
            yield key >> 3, kind, number()
        else:
            yield key >> 3, kind, data[at:at + size]
            at += size


def _put(field, kind, v):
    return _varint(field << 3 | kind) + (_varint(len(v)) + v if kind == 2 else _varint(v) if kind == 0 else v)


def unigram(model, scores):
    """The model file as a Unigram model with these scores."""
    out, i = b"", 0
    for f, kind, v in _fields(model):
        if f == 1:
            v, i = b"".join(_put(g, u, struct.pack("<f", scores[i]) if g == 2 else z) for g, u, z in _fields(v)), i + 1
        elif f == 2:
            v = b"".join(_put(g, u, 1 if g == 3 else z) for g, u, z in _fields(v))
        out += _put(f, kind, v)
    return out


def test_best_paths_equal_the_library(spark, model):
    vocabulary = codec.Vocabulary(model)
    sp = counts.load(unigram(model, vocabulary.score))
    texts = [r["text"] or "" for r in awkward(spark).select("text").collect()]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    flat, sizes, scores = codec.Encoder(vocabulary)(texts)
    ids = [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
    unknown = vocabulary.unknown

    def price(tokens):
        return sum(vocabulary.score[t] for t in tokens if not vocabulary.is_byte[t])

    for text, mine, score in zip(texts, ids, scores):
        theirs = sp.encode(text)
        # equal paths, or paths of equal price
        if mine != theirs:
            assert abs(price(mine) - price(theirs)) < 1e-3 * max(1, len(mine)), text[:80]
            assert [t for t in mine if vocabulary.is_byte[t]] == [t for t in theirs if vocabulary.is_byte[t]]
        assert codec.decode_ids(mine, vocabulary.spelling) == text.replace("▁", " ")
        assert score <= 1e-9 and unknown < vocabulary.score.min()


def test_long_and_short_paths_agree(model):
    vocabulary = codec.Vocabulary(model)
    text = "▁" + "internationalisationofthestandardisationprocedures" * 5
    whole = [x.tolist() for x in vocabulary.segment([text, "▁é", text])]
    codec_waves, codec.WAVES = codec.WAVES, 10_000
    try:
        assert [x.tolist() for x in vocabulary.segment([text, "▁é", text])] == whole
    finally:
        codec.WAVES = codec_waves


def test_codec_round_trip_and_columns(spark):
    docs = awkward(spark)
    rows = codec.decode(codec.encode(docs, decoded="at_once")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["decoded"] == r["at_once"] == (r["text"] or "").replace("▁", " ")
        assert r["n_tokens"] == len(r["ids"]) and r["k"] in (7, 1, None)
    assert all(r["round_trip"] for r in codec.query(docs).collect())
    assert codec.query(spark.createDataFrame([], SCHEMA)).collect() == []
    assert counts.query(spark.createDataFrame([], SCHEMA)).collect() == []


def test_decode_bad_bytes(spark, model):
    v = codec.Vocabulary(model)
    assert codec.decode_ids([int(v.byte_id[0xE2]), int(v.byte_id[0x41])], v.spelling) == "�A"
    rows = spark.createDataFrame([([],), (None,)], "ids array<int>")
    assert sorted(str(r["decoded"]) for r in codec.decode(rows).collect()) == ["", "None"]
