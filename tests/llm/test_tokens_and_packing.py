import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquee.llm import packing, token_orc
from marquee.llm.queries import QUERIES
from marquee.llm.tokens import Encoder
from marquee.session import scratch_path
from tests.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH, kept_words=50)


def ids_of(text):
    return np.array(PLAIN.encode(text or "", add_special_tokens=False).ids, "<u4")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["ab", "it's", " ", "\n", "  ", "é", "ß!", "12", ",", "\t", "\0", "\x1c", "漢字", "<|endoftext|>", "A."]), max_size=25))
def test_pieces_give_the_ids_of_the_whole_text(parts):
    text = "".join(parts)
    assert ENCODER(text) == ids_of(text).tobytes()


def test_orc_round_trip(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op4_token_orc"](spark, SMALL).collect()}
    before = 0
    for r in documents.orderBy("doc_id").collect():
        ids = np.r_[ids_of(r.text), 2].astype("<u4")
        assert (rows[r.doc_id].start, rows[r.doc_id].n_tokens, rows[r.doc_id].ids_crc32) == (before, len(ids), zlib.crc32(ids.tobytes()))
        before += len(ids)


def test_orc_of_odd_rows(spark, odd_docs, no_docs):
    path = scratch_path(spark, "odd")
    token_orc.write_tokens(odd_docs, path, PATH)
    rows = token_orc.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 4, 5, 6, 7]
    assert rows[1].token_ids == [2] and all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))
    assert token_orc.lookup(spark, path, [3]).first().n_tokens == len(ids_of("word " * 30_000)) + 1
    empty = scratch_path(spark, "none")
    token_orc.write_tokens(no_docs, empty, PATH)
    assert token_orc.digests(token_orc.read_tokens(spark, empty)).count() == 0


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = packing.hilbert_key(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_pieces(rows, docs, length=1024):
    texts = {}
    for r in docs:
        texts.setdefault(r.doc_id, []).append(np.r_[ids_of(r.text), 0].astype("<u4").tobytes())
    by_sequence, covered = {}, {}
    for r in rows:
        assert any(t[4 * r.start : 4 * (r.start + r.length)] == bytes(r.ids) for t in texts[r.doc_id])
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        covered[r.doc_id] = covered.get(r.doc_id, 0) + r.length
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    assert covered == {k: sum(len(t) // 4 for t in v) for k, v in texts.items()}
    full = sum(covered.values())
    assert len(by_sequence) == -(-full // length)


def test_every_id_is_packed_once(spark, documents):
    check_pieces(packing.pack(documents, PATH).collect(), documents.collect())


def test_odd_rows_are_packed(spark, odd_docs, no_docs):
    check_pieces(packing.pack(odd_docs, PATH).collect(), odd_docs.collect())
    assert packing.pack(no_docs, PATH).count() == 0


def test_sequences_are_padded(spark, documents):
    rows = packing.sequences(packing.pack(documents, PATH)).collect()
    for r in rows:
        assert len(r.ids) == 4 * (r.n + r.pads) and (r.n + r.pads == 1024 or r.n & (r.n - 1) == 0)


def test_many_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "PART_TOKENS", 5000)
    check_pieces(packing.pack(documents, PATH).collect(), documents.collect())


@pytest.mark.parametrize("name", ["op1_curve_packing"])
def test_query_columns(spark, name):
    assert QUERIES[name](spark, SMALL).columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
