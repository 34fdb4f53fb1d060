from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from acervo.llm import recurrent_lm

TEXTS = ["", None, "A b\tA\n\nc", "  lead trail \r\n", "x", "\x0b\x0c", "é É  ZÅ z\x1cz", "one", "two", None, " y", "a\x00b"]


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_words_are_cut_as_bytes_are_split(monkeypatch, piece):
    monkeypatch.setattr(recurrent_lm, "PIECE", piece)
    for texts in (TEXTS, TEXTS[3:7], [None], [""], []):
        got, sizes = [], []
        for words, size in recurrent_lm.pieces(pa.array([*TEXTS[:2], *texts], pa.string()).slice(2)):
            got += words.to_pylist()
            sizes += size.tolist()
        plain = [(t or "").encode().lower().split() for t in texts]
        assert got == [w for words in plain for w in words] and sizes == list(map(len, plain))


def test_ids_of_a_plain_look_up(monkeypatch):
    monkeypatch.setattr(recurrent_lm, "PIECE", 9)
    frequent = [b"a", b"b", b"x"]
    lexicon = recurrent_lm.Lexicon(frequent, np.array([5, 4, 3]), 2)
    tail = lambda w: recurrent_lm.OWN + zlib.crc32(w[-2:]) % recurrent_lm.TAIL_CLASSES
    got, rest = [], []
    for ids, _, _, beyond in lexicon.look_up(pa.array(TEXTS, pa.string())):
        got += [i.tolist() for i in ids]
        rest += beyond.to_pylist()
    plain = [(t or "").encode().lower().split() for t in TEXTS]
    assert got == [[*(frequent.index(w) + 1 if w in frequent else tail(w) for w in words), recurrent_lm.END] for words in plain]
    assert rest == [w for words in plain for w in words if w not in frequent]


def test_frequent_words_beyond_those_with_outputs_are_in_tail_classes():
    words = [b"w%d" % i for i in range(recurrent_lm.OWN + 20)]
    ids = recurrent_lm.Lexicon(words, np.ones(len(words), np.int64), 1).ids
    assert ids[: recurrent_lm.OWN - 1].tolist() == list(range(1, recurrent_lm.OWN))
    assert ids[recurrent_lm.OWN - 1 :].tolist() == [recurrent_lm.OWN + zlib.crc32(w[-2:]) % recurrent_lm.TAIL_CLASSES for w in words[recurrent_lm.OWN - 1 :]]


def test_sums_by_id_are_plain_sums():
    rng = np.random.default_rng(5)
    ids, rows = (60 * rng.random(2000) ** 3).astype(np.int16), rng.normal(size=(2000, 6))
    want = np.zeros((60, 6))
    np.add.at(want, ids, rows)
    got_ids, sums = recurrent_lm.sums_by_id(ids, rows)
    assert sorted(got_ids.tolist()) == sorted(set(ids.tolist()))
    assert sums == pytest.approx(want[got_ids])


def test_windows_use_the_memory_of_those_before():
    rng = np.random.default_rng(6)
    net = recurrent_lm.Network(rng.normal(0, 0.1, recurrent_lm.Network.SIZE).astype(np.float32))
    memory = recurrent_lm.Network(np.full(recurrent_lm.Network.SIZE, 1e-4, np.float32))
    shape = (recurrent_lm.BACK, recurrent_lm.LANES)
    x, y = rng.integers(0, recurrent_lm.OWN, (2, *shape))
    h, room = np.zeros((recurrent_lm.LANES, recurrent_lm.HIDDEN), np.float32), recurrent_lm.Room()
    room_free = []
    for _ in range(2):
        tracemalloc.start()
        h = recurrent_lm.train_window(net, memory, x, y, h, room)
        room_free.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    # gates, states and softmaxes of a window of 8,192 tokens alone are more than 10 MB
    assert room_free[0] > 10e6 > room_free[1]
