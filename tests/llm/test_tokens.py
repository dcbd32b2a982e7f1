"""Token counts and byte-level BPE against the libraries themselves."""

import base64
import hashlib
import random

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from anaquel.llm import bpe, token_count
from anaquel.llm.common import safe_pieces
from tests.llm import corpus


def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(count, seed=3):
    rng = random.Random(seed)
    any_char = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    usual = " \n\t'sretdvml1a.\x1c\x85　\xa0"
    parts = ["", "", "<|endoftext|>", "word", " 12", "'ll"]
    return ["".join((rng.choice(any_char) if rng.random() < 0.4 else rng.choice(usual)) + rng.choice(parts) for _ in range(400)) for _ in range(count)]


def test_ids_are_the_librarys_and_decode_to_the_text():
    own, reference = bpe.codec(), library()
    texts = odd_texts(60) + [r[1] for r in corpus.documents()[0]] + [corpus.edge_rows()[8][1], "x" * 3000]
    ids, ends = own.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [reference.encode_ordinary(t) for t in texts]
    raw, at = own.decode(ids.astype("int64"), ends)
    assert [raw[a:b].tobytes().decode() for a, b in zip(at, at[1:])] == texts


def test_memory_of_pre_tokens_turns_over(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 20)
    monkeypatch.setattr(bpe, "SHORT", 6)
    monkeypatch.setattr(bpe, "GROUP_BYTES", 300)
    own, reference = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), library()
    texts = odd_texts(20, 8)
    for part in (texts[:10], texts[5:], texts[:10]):
        ids, ends = own.encode(part)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [reference.encode_ordinary(t) for t in part]
        assert max(map(len, [*own.recent, *own.older])) <= 6 and len(own.older) < 3000


def test_perfect_hash_uses_every_slot_once():
    own = bpe.codec()
    assert sorted(own.hash.slots(own.keys).tolist()) == list(range(len(own.keys)))
    assert bpe.PerfectHash([]).slots([b"x"]).tolist() == [-1]


def test_counts_are_the_librarys():
    path = public_tokenizers.path("byte_bpe_50k.json")
    reference = Tokenizer.from_file(path)
    texts = odd_texts(40, 4) + [r[1] for r in corpus.documents()[0]] + ["a" * 5000, None]
    expected = [len(reference.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert token_count.count_group(texts, path, {}) == expected


def test_pieces_join_to_the_text_and_keep_tokens():
    reference = library()
    for value in odd_texts(30, 5):
        pieces = list(safe_pieces(value, 20))
        assert "".join(pieces) == value
        assert sum((reference.encode_ordinary(p) for p in pieces), []) == reference.encode_ordinary(value)


def test_digests(docs):
    reference = library()
    want = {}
    for doc, value, *_ in corpus.documents()[0]:
        ids = reference.encode_ordinary(value)
        want[doc] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(value.encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs).collect()} == want
