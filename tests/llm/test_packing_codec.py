from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tests.llm.conftest import LONG
from tokenizers import Tokenizer

from acervo.llm import packing, token_codec, tokens

TEXTS = ["", "plain words, and more.", "It's WE'LL 1234 a1b2 ½ _x_ ...!?¿ñ", "a\xa0b \x85 \x1cq \x0b c", "́a b́ ΣΑΣ İI ı", "x<|endoftext|>y <|startoftext|>", "漢字 \U0001f600  é", "\n\n  \t x  "]


def test_ids_equal_those_of_the_library():
    byte, word = Tokenizer.from_file(tokens.BYTE_BPE), Tokenizer.from_file(tokens.WORD_BPE)
    encode = tokens.byte_encoder()
    for text in [*TEXTS, LONG[:5000]]:
        assert encode(text) == byte.encode(text, add_special_tokens=False).ids
    for text, ids in zip(TEXTS, tokens.WordEncoder().encode_all([t.encode() for t in TEXTS]), strict=True):
        assert ids.tolist() == word.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_patterns_pack_every_item(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(65, np.int64)
    for size in rng.choice(np.arange(1, 65), rng.integers(0, 40), replace=False):
        counts[size] = rng.integers(1, 5000)
    patterns = packing.cutting_patterns(counts, np.arange(65), 64)
    assert (sum((c * n for c, n in patterns), np.zeros(65, np.int64)) == counts).all()
    assert all((c * np.arange(65)).sum() <= 64 for c, _ in patterns)


def test_patterns_are_near_the_bound():
    counts = np.bincount(np.random.default_rng(0).integers(1, 100, 50_000), minlength=129)
    used = sum(n for _, n in packing.cutting_patterns(counts, np.arange(129), 128))
    assert used <= 1.01 * (counts * np.arange(129)).sum() / 128


def check_packing(rows: list, texts: list) -> None:
    library = Tokenizer.from_file(tokens.BYTE_BPE)
    want = [([*library.encode(t or "", add_special_tokens=False).ids, packing.END], i) for i, t in texts]
    by_id, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i in by_id:
        pieces = sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in by_id[i])
        assert pieces == sorted(
            (len(ids), at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())) for ids, j in want if j == i for at in range(0, len(ids), 2048)
        )
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert set(by_id) == {i for i, _ in texts}


def test_words_of_many_texts_are_merged_in_one_call_each_piece_once(monkeypatch):
    library, encoder = Tokenizer.from_file(tokens.WORD_BPE), tokens.WordEncoder()
    rng = np.random.default_rng(3)
    letters = [*map(chr, range(1, 0x250)), *"''stmdrvel  \n<|aB12.,;" * 9, *"\u6f22\u212a\u1e9e\u0130\u0301\u2019\U0001f600", "<|endoftext|>"]
    texts = ["".join(letters[i] for i in rng.integers(0, len(letters), n)) for n in rng.integers(0, 60, 400)] + ["two words, two", ""]
    merge, seen = encoder.merge.encode_to_numpy, []
    monkeypatch.setattr(encoder.merge, "encode_to_numpy", lambda text, **k: seen.append(text.split(" ")) or merge(text, **k))
    got = encoder.encode_all([t.encode() for t in texts])
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(seen) == 1 and len(set(seen[0])) == len(seen[0])
    assert encoder.encode_all([b"", b" \n"])[1].tolist() == [] and encoder.encode_all([]) == []


def test_pack_odd_rows(odd, empty):
    check_packing(packing.pack(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert packing.pack(empty).count() == 0


def test_pack_many_ranks(documents, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 5)
    rng = np.random.default_rng(1)
    rows = [(int(i), "word " * int(rng.integers(0, 900)), "a") for i in range(150)]
    packed = packing.pack(documents(rows), with_ids=True)
    out = packed.collect()
    check_packing(out, [(i, t) for i, t, _ in rows])
    made = packing.sequences(packed).collect()
    used = sum(r.n_tokens for r in made)
    assert used == sum(r.length for r in out) and len(made) <= 1.1 * used / 2048 + 2
    assert all(len(r.ids) == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 2048) for r in made)


@pytest.mark.parametrize("n", [1, 2, 7, 8192, 8193, 20_001])
@pytest.mark.parametrize("kinds", [1, 3, 49_408])
def test_segment_round_trip(n, kinds):
    rng = np.random.default_rng(n)
    ids = np.repeat(rng.integers(0, kinds, n), rng.integers(1, 3, n))[:n].astype(np.uint32)
    index = np.array([[0, 1, -5, n]])
    got, back = token_codec.read_segment(token_codec.write_segment(ids, index))
    assert (got == ids).all() and (back == index).all()


def test_damage_is_found():
    data = bytearray(token_codec.write_segment(np.arange(5000, dtype=np.uint32) % 40, np.array([[0, 1, 1, 5000]])))
    data[len(data) // 2] ^= 4
    with pytest.raises(ValueError):
        token_codec.read_segment(bytes(data))


def test_text_is_coded_well_below_two_bytes_a_token():
    ids = np.concatenate(tokens.WordEncoder().encode_all([LONG.encode()]))
    assert len(token_codec.write_segment(ids, np.array([[0, 1, 1, len(ids)]]))) < 0.6 * len(ids)


def test_token_files_round_trip(odd, empty, monkeypatch):
    monkeypatch.setattr(token_codec, "BLOCK", 64)
    monkeypatch.setattr(token_codec, "SEGMENT", 8)
    library = Tokenizer.from_file(tokens.WORD_BPE)
    got = sorted(token_codec.round_trip(odd).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)
    want = sorted(np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for r in odd.collect())
    assert sorted(bytes(r.ids_bytes) for r in got) == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids_bytes) // 4, zlib.crc32(r.ids_bytes))
        at += r.n_tokens
    assert token_codec.round_trip(empty).count() == 0
