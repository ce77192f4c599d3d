"""Packing, token files and byte-level BPE against the libraries."""

import base64
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tessera.llm import bpe, packing, token_files
from tessera.llm.common import ChunkEncoder, library_encoder, text_slices
from tokenizers import Tokenizer

from .conftest import MESSY

BYTE, WORD, MULTI = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    pieces = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "bc", "1", "'s", "'S", ".", ",", "!,", "é", "́", "中",
              "\U0001f642", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "\0", "\1", "It", "Σ"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("path,free", [(BYTE, False), (WORD, True)])
def test_chunk_encoder_equals_the_library(path, free):
    ours, exact = library_encoder(path, free), library(path)
    texts = odd_texts(3000)
    assert [np.frombuffer(x, "<u4").tolist() for x in ours(texts)] == [exact(t) for t in texts]


def test_chunk_encoder_is_the_same_when_its_memo_overflows():
    big = library_encoder(BYTE, False)
    small = ChunkEncoder(big.encode, False, limit=10)
    texts = odd_texts(300, seed=5)
    assert small(texts) == big(texts)


@pytest.mark.parametrize("path,free", [(BYTE, False), (WORD, True)])
def test_letters_that_normalizing_takes_apart(path, free):
    """A capital I with a dot becomes a letter and a mark, which a full stop would join."""
    ours, exact = library_encoder(path, free), library(path)
    texts = ["İ.", "aİ, b", "\ufb1d. x", "ª. µ, ŉ ſt. ẞ,", "don't we'll ÀÉ Ǆ"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ours(texts)] == [exact(t) for t in texts]


def test_words_of_every_case_are_remembered_once():
    ours, exact = library_encoder(WORD, True, limit=9999), library(WORD)
    texts = ["Often often, OFTEN. oFten Éan éan ÉAN.", "H\u0331 h\u0331 \u1e96 I\u0307 i\u0307 İ J\u030c. \u01f0", "K \u212a k ΑΣ ας ΣΑ, ẞ Ĳ"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ours(texts)] == [exact(t) for t in texts]
    assert {w for w in ours.memo if "ften" in w.lower() or "an" in w.lower()} == {"often", "often,", "often.", "éan", "éan."}


@pytest.mark.parametrize("path,free", [(BYTE, False), (WORD, True)])
def test_frequent_words_outlast_a_full_memo(path, free):
    big, asked = library_encoder(path, free), []

    def encode(chunks):
        asked.extend(chunks)
        return big.encode(chunks)

    small = ChunkEncoder(encode, free, limit=100)
    rng = random.Random(2)
    for _ in range(60):
        text = " ".join(["x", "often", *("".join(rng.choices("abcdefgh", k=9)) for _ in range(20))])
        assert small([text]) == big([text])
        assert len(small.memo) + len(small.memo.before) <= 100 + 22
    assert sum(c.strip() == "often" for c in asked) == 1


def test_packing_empties_memos_of_earlier_stages():
    from tessera.llm import near_dedup
    from tessera.llm.common import forget

    near_dedup.word_hashes("left by an earlier stage")
    assert len(near_dedup.WORD_HASH)
    forget()
    assert not near_dedup.WORD_HASH
    assert "forget" in packing.pack_documents.__globals__


def test_a_call_asks_the_memo_once_for_each_distinct_word():
    big, looked = library_encoder(BYTE, False), []
    small = ChunkEncoder(big.encode, False, limit=1000)

    class Memo(type(small.memo)):
        def of(self, words):
            looked.extend(words)
            return super().of(words)

    small.memo = Memo({})
    texts = ["a bb  a\nbb a ", "bb a a", "", " ", "a\0b a"] * 50
    assert small(texts) == big(texts)
    assert len(looked) == len(set(looked)) < 20


def test_texts_are_cut_by_their_bytes():
    """256 rows of long texts at once took a worker's memory."""
    texts = ["x" * 900, None, "é" * 100, "", "y" * 5000, "z", None] * 40
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    for whole in ([batch], [batch.slice(0, 0), batch.slice(3, 100), batch.slice(103)]):
        cut = list(text_slices(whole, "text", 2000))
        assert [i for b in cut for i in b.column(0).to_pylist()] == [i for b in whole for i in b.column(0).to_pylist()]
        assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b.column(1).to_pylist()) <= 2000 for b in cut)
        assert len(cut) < len(texts)


def test_workers_that_read_files_forget_words():
    """Two workers' words beside the files took more memory than an executor has."""
    from tessera.llm.common import forget

    ours = library_encoder(WORD, True, limit=5000)
    other = library_encoder(BYTE, False, limit=5000)
    ours(["some words"])
    other(["some words"])
    forget(ours)
    assert len(ours.memo) and not len(other.memo)
    forget()
    assert not len(ours.memo) and not len(ours.memo.before)
    names = token_files.read_token_files.__code__.co_consts
    assert any("forget" in c.co_names for c in names if hasattr(c, "co_names"))


def test_packer_is_best_fit_and_bounded():
    rng = random.Random(1)
    packer, closed, bins = packing.BestFit(100, 3), [], {}
    for k in range(500):
        n = rng.randint(1, 100)
        free = [100 - sum(l for l, _ in [(x[1], 0) for _, x in b]) for b in packer.rest()]
        fits = [f for f in free if f >= n]
        out = packer.place(n, (k, n))
        closed += out
        if fits:  # the least free space that holds it
            after = sorted(100 - sum(x[1] for _, x in b) for b in [*packer.rest(), *out])
            before = sorted(free)
            before.remove(min(fits))
            assert after == sorted([*before, min(fits) - n])
        assert packer.count <= 3
    for b in closed + packer.rest():
        at = 0
        for offset, (k, n) in b:
            assert offset == at and k not in bins
            bins[k], at = True, at + n
        assert at <= 100
    assert len(bins) == 500


def test_only_the_first_piece_may_be_short():
    assert packing.cut_pieces(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut_pieces(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut_pieces(3, 4) == [(0, 3)]


def test_packing_messy_documents(spark, messy, empty):
    packed = packing.pack_documents(messy, BYTE, size=64)
    rows = packed.collect()
    exact = library(BYTE)
    whole = {}
    for r in rows:
        whole.setdefault((r.doc_id,), []).append((r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()))
        assert r.length == len(r.ids) // 4 <= 64
    want = {}
    for i, t in MESSY:
        ids = exact(t or "") + [0]
        want.setdefault((i,), []).extend((k, s, ids[s:s + n]) for k, (s, n) in enumerate(packing.cut_pieces(len(ids), 64)))
    assert {k: sorted(v) for k, v in whole.items()} == {k: sorted(v) for k, v in want.items()}
    for s in packing.sequences(packed).collect():
        mine = sorted((r.offset, r.length) for r in rows if r.sequence_id == s.sequence_id)
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))]
        assert len(s.ids) // 4 == sum(n for _, n in mine) <= 64
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.1 * total / 64 + 2
    assert packing.pack_documents(empty, BYTE).count() == 0


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_round_trip(planes):
    ids = np.random.default_rng(1).integers(0, 1 << 32, 1001, dtype=np.uint64).astype("<u4")
    assert (token_files.from_planes(token_files.to_planes(ids, planes), len(ids), planes) == ids).all()
    assert len(token_files.from_planes(token_files.to_planes(ids[:0], planes), 0, planes)) == 0


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_token_files_round_trip(spark, messy, empty, tmp_path, planes):
    token_files.write_token_files(messy, str(tmp_path / "f"), WORD, planes=planes, block_ids=100, shards=3)
    got = sorted(token_files.read_token_files(spark, str(tmp_path / "f")).collect(), key=lambda r: r.start)
    exact = library(WORD)
    order = sorted(MESSY, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    at = 0
    for (i, t), r in zip(order, got, strict=True):
        ids = exact(t or "") + [2]
        assert (r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (i, at, len(ids), ids)
        at += len(ids)
    token_files.write_token_files(empty, str(tmp_path / "e"), WORD)
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def tiktoken_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_segment_tree_bpe_equals_tiktoken():
    ours, encode = bpe.encoder(MULTI, P.PATTERN)
    theirs = tiktoken_encoding()
    texts = [t for t in odd_texts(3000)] + ["a" * 3000, "é" * 500, "ab" * 700, " " * 300 + "b", ""]
    for t, ids in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(t), t[:60]
        assert ours.decode(ids) == t.encode()


def test_rows_and_long_words_merge_alike():
    ours, _ = bpe.encoder(MULTI, P.PATTERN)
    words = [t.encode() for t in odd_texts(400, seed=9) if 1 < len(t.encode()) <= bpe.ROW_BYTES]
    for a, w in zip(ours.merge_rows(words), words, strict=True):
        assert a.tolist() == ours.merge_long(w).tolist()


def test_bpe_messy_documents(messy, empty):
    encoded = bpe.encode_documents(messy, MULTI, P.PATTERN)
    got = sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.decoded)) for r in bpe.decode_documents(encoded, MULTI, P.PATTERN).collect())
    assert got == sorted((i is not None, i or 0, (t or "").encode()) for i, t in MESSY)
    assert bpe.encode_documents(empty, MULTI, P.PATTERN).count() == 0
