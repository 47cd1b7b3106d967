"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from jobflow.llm import bpe
from llm_fixtures import no_docs, odd_docs, odd_texts  # noqa: F401

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(PATH, P.PATTERN)


def test_encode_documents(odd_docs, odd_texts, no_docs, library):
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in bpe.encode_documents(odd_docs, PATH, P.PATTERN, digests=True).collect())

    def sha(b):
        return hashlib.sha256(b).hexdigest()
    want = []
    for i, t in odd_texts:
        ids = library.encode_ordinary(t or "")
        want.append((str(i), len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want)
    whole = bpe.encode_documents(odd_docs, PATH, P.PATTERN).filter("doc_id = 20").first()
    assert whole.ids == library.encode_ordinary(dict(odd_texts)[20]) and bytes(whole.decoded).decode() == dict(odd_texts)[20]
    assert bpe.encode_documents(no_docs, PATH, P.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=300))
def test_any_text_round_trips(own, library, text):
    ids, off = own.encode([text, ""])
    assert ids.tolist() == library.encode_ordinary(text) and off.tolist() == [0, len(ids), len(ids)]
    assert own.decode(ids) == text.encode()


@pytest.mark.parametrize("piece", ["a" * 5000, "abcde" * 700, "ththththe" * 300, "ñ" * 1500, "!" * 2000, " " * 3000, "%$#" * 900])
def test_long_pieces_take_the_same_merges(own, library, piece):
    assert own.encode([piece])[0].tolist() == library.encode_ordinary(piece)


def test_matrix_and_heap_agree(own):
    for piece in (b"international", b"x" * 200, b"thethethe" * 20):
        assert own.merge_long(piece).tolist() == own.encode_pieces([piece])[0].tolist()
