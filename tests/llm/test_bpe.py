"""Encoding against the tokenizers library, and token files."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from creditmill.llm import bpe, token_files
from creditmill.llm.queries import TOKENIZER

POOL = ["a", "B", "\u00e9", "E\u0301", "\u0130", "\u00df", "\u01c5", "\u03a3", "\u03c2", "\u0391\u03a3", "\u212a", " ", "\n", "\x1c",
        "\x1f", "\x85", "\u00a0", "\u2003", "\u200b", "\u4e2d", "\u3042", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "<|end",
        "'s", "'LL", "'", "\u00bd", "\u00b2", "\u0663", "\u2167", "_", "-", "...", "\x00", "\ufb01", "i", "n", "th", "the", "ing",
        "!!", "1", "23", "\u2026", "\u201c", "A\u030a", "\ud7a3", "\U0001d400", "\U00010400"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def samples():
    rng = random.Random(3)
    texts = ["", " ", "a" * 300, "ab" * 100, "haha" * 30]
    texts += ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    return texts + ["".join(rng.choice("aabbcdethinognr") for _ in range(rng.randint(1, 40))) for _ in range(3000)]


@pytest.mark.parametrize("by_library", [False, True])
def test_encoder_equals_library(library, by_library):
    encoder = bpe.Encoder(TOKENIZER, by_library)
    for text in samples():
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, repr(text)
        assert encoder.decode(encoder.encode(text)).decode() == library.decode(ids, skip_special_tokens=False)


def test_each_prefix_has_its_last_token(library):
    """What the dynamic program stores for a prefix is the last token of encoding that prefix."""
    vocabulary = bpe.Vocabulary(TOKENIZER)
    for word in ("understandings", "thththonerly", "aaaaaaaaaa"):
        for end in range(1, len(word) + 1):
            ids = vocabulary.encode_word(vocabulary.ended(word[:end]))
            assert ids == library.encode(word[:end], add_special_tokens=False).ids


def test_encode_decode_rows(spark, documents, library):
    rows = [(1, "Hello  World"), (1, "Hello  World"), (2, None), (3, ""), (None, "x" * 20_000), (4, "the " * 5000 + "end\u00e9")]
    got = bpe.encode_decode(documents(rows), TOKENIZER, with_ids=True).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest(), ids)
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.ids)) == want[r.doc_id] for r in got)
    assert bpe.encode_decode(documents([]), TOKENIZER).collect() == []


@given(st.lists(st.integers(0, 1 << 40), max_size=700))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values):
    values = np.array(sorted(values), np.int64)
    coded, end = token_files.EliasFano.read(b"??" + token_files.EliasFano.of(values).to_bytes(), 2)
    assert end == len(token_files.EliasFano.of(values).to_bytes()) + 2
    assert coded.select_range(0, len(values)).tolist() == values.tolist()
    for i in range(0, len(values), 7):
        for j in (i, i + 1, len(values)):
            assert coded.select_range(i, j).tolist() == values[i:j].tolist()
    assert [coded.select(i) for i in range(len(values))] == values.tolist()


def test_stretches_between_samples():
    gaps = np.random.default_rng(1).choice([0, 1, 2, 50_000], 3000)
    values = np.cumsum(gaps)
    coded = token_files.EliasFano.of(values)
    for i, j in ((0, 1), (0, 256), (255, 257), (256, 512), (300, 2900), (2999, 3000), (3000, 3000)):
        assert coded.select_range(i, j).tolist() == values[i:j].tolist()
    with pytest.raises(IndexError):
        coded.select_range(5, 3001)


def test_boundaries_take_little_space():
    bounds = np.cumsum(np.random.default_rng(0).integers(1, 1000, 100_000))
    assert len(token_files.EliasFano.of(bounds).to_bytes()) < 0.25 * bounds.nbytes


def test_token_files(spark, documents, library, tmp_path):
    rng = random.Random(8)
    rows = [(rng.randrange(-50, 1000), rng.choice([None, "", "a b", "word " * rng.randint(1, 60)])) for _ in range(300)]
    rows += [(None, "no id"), (None, "no id"), (5, "twin"), (5, "other twin"), (2000, "long " * 3000)]
    path = str(tmp_path / "files")
    token_files.write_token_files(documents(rows), path, TOKENIZER, 2, segment_tokens=500)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    coded = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows if i is not None)) + [None, None]
    assert sorted((r.doc_id or -99, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted((i or -99, x) for i, x in coded)
    at = 0
    for r in got:
        assert r.start == at and r.ids_crc32 == zlib.crc32(r.ids) and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    segments = spark.read.parquet(path).collect()
    assert len(segments) > 8  # one a shard at least
    one = token_files.Segment(bytes(segments[0].data))
    bounds = one.bounds.select_range(0, one.n_docs + 1)
    assert [one.document(i).tolist() for i in range(one.n_docs)] == [
        one.ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_token_files_empty(spark, documents):
    assert token_files.round_trip(documents([]), TOKENIZER).collect() == []
