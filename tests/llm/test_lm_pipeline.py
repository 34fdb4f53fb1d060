from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from acervo.llm import packing, recurrent_lm

END = object()


@pytest.fixture
def quick(monkeypatch):
    monkeypatch.setattr(recurrent_lm, "ROUND_TOKENS", 60_000)
    monkeypatch.setattr(recurrent_lm, "PASSES", 4)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    size = recurrent_lm.Network.SIZE
    net = recurrent_lm.Network(rng.normal(0, 0.3, size).astype(np.float32))
    ids = recurrent_lm.OWN + recurrent_lm.TAIL_CLASSES
    x, y = rng.integers(0, ids, (5, 3)), rng.integers(0, ids, (5, 3))
    x[2, 1], y[0, 0] = recurrent_lm.END, 5

    def loss(values):
        n, h, total = recurrent_lm.Network(values.astype(np.float64)), np.zeros((3, recurrent_lm.HIDDEN)), 0.0
        for t in range(5):
            h = recurrent_lm.step(n, x[t], h * (x[t] != recurrent_lm.END)[:, None])[-1]
            total -= recurrent_lm.log_probabilities(n, h, y[t]).sum()
        return total / 15

    start, memory = net.values.copy(), recurrent_lm.Network(np.zeros(size, np.float32))
    recurrent_lm.train_window(net, memory, x, y, np.zeros((3, recurrent_lm.HIDDEN), np.float32))
    gradient = np.sqrt(memory.values) * np.sign(start - net.values)
    for i in np.flatnonzero(np.abs(gradient) > 1e-4)[::1499][:15]:
        nudge = np.zeros(size)
        nudge[i] = 1e-5
        assert (loss(start + nudge) - loss(start - nudge)) / 2e-5 == pytest.approx(gradient[i], rel=0.02, abs=1e-4)


def test_probabilities_sum_to_one():
    net = recurrent_lm.Network(np.random.default_rng(1).normal(0, 0.3, recurrent_lm.Network.SIZE).astype(np.float32))
    ids = np.arange(recurrent_lm.OWN + recurrent_lm.TAIL_CLASSES)
    h = np.tile(np.random.default_rng(2).normal(0, 1, recurrent_lm.HIDDEN).astype(np.float32), (len(ids), 1))
    assert np.exp(recurrent_lm.log_probabilities(net, h, ids)).sum() == pytest.approx(1, abs=1e-3)


def test_state_is_carried_over_a_whole_document():
    net = recurrent_lm.Network(np.random.default_rng(1).normal(0, 0.3, recurrent_lm.Network.SIZE).astype(np.float32))
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, recurrent_lm.OWN, n) for n in (1, 2, 200, 64, 65, 1)]
    for doc, got in zip(docs, recurrent_lm.score_documents(net, docs), strict=True):
        h, before, total = np.zeros((1, recurrent_lm.HIDDEN), np.float32), recurrent_lm.END, 0.0
        for w in doc:
            h = recurrent_lm.step(net, np.array([before]), h)[-1]
            total += recurrent_lm.log_probabilities(net, h, np.array([w]))[0]
            before = w
        assert got == pytest.approx(total, rel=1e-4)


def plain_base(rows):
    counts = Counter()
    tokens = lambda t: [*(t or "").encode().lower().split(), END]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    for i, t in rows:
        if not out(i):
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [(i, out(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows]


def check_base(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    mine = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=key)
    want = sorted(plain_base(rows), key=key)
    assert [r[:5] for r in mine] == [r[:5] for r in want]
    assert [r[5] for r in mine] == pytest.approx([r[5] for r in want])


def test_scores_of_odd_rows(odd, empty, quick):
    got = recurrent_lm.score(odd).collect()
    check_base(got, [(r.doc_id, r.text) for r in odd.collect()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert recurrent_lm.score(empty).count() == 0


def test_model_beats_the_unigram_on_held_out_documents(documents, quick, monkeypatch):
    monkeypatch.setattr(recurrent_lm, "KNOWN", 150)
    rng = random.Random(4)
    # two languages: knowing which one a document is in is worth a bit for each word
    words = [[f"{p}{i}{p}" for i in range(300)] for p in ("a", "b")]
    rows = [(i, " ".join(rng.choice(words[i % 2][: rng.choice([5, 300])]) for _ in range(60)), "a") for i in range(300)]
    got = recurrent_lm.score(documents(rows)).collect()
    check_base(got, [(i, t) for i, t, _ in rows])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_every_training_document_gives_gradients_once(documents, monkeypatch):
    monkeypatch.setattr(recurrent_lm, "ROUND_TOKENS", 100)
    monkeypatch.setattr(recurrent_lm, "PASSES", 1)
    seen, mean = [], recurrent_lm.averaged

    def averaged(rows):
        seen.append(rows.where("chunk = 0").agg({"n": "sum"}).first()[0])
        return mean(rows)

    monkeypatch.setattr(recurrent_lm, "averaged", averaged)
    got = recurrent_lm.score(documents([(i, "a b c d " * 12, "x") for i in range(120)])).collect()
    assert len(seen) == recurrent_lm.ROUNDS and min(seen) > 0 and sum(seen) == got[0].train_tokens


def test_without_training_documents(documents, quick):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = recurrent_lm.score(documents([(i, "a b", "x") for i in ids])).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in got} == {(0, 0, 0.0)} and all(r.score <= 0 for r in got)


def shingles(text):
    w = text.encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_pipeline_keeps_what_a_plain_version_keeps(spark, documents, tmp_path):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    body = lambda n: [rng.choice(words) for _ in range(n)]
    passage = "\n".join(" ".join(body(20)) for _ in range(4))
    rows = []
    for i in range(120):
        text = "\n".join(" ".join(body(15)) for _ in range(rng.randint(2, 6)))
        rows.append((len(rows), text + ("\n" + passage if i % 10 == 0 else ""), f"s{i % 4}"))
        if i % 6 == 0:  # a near copy: one word of the text changed
            copy = text.split(" ")
            copy[len(copy) // 2] = "changed"
            rows.append((len(rows), " ".join(copy), f"s{i % 3}"))
        if i % 8 == 0:
            rows.append((len(rows), " ".join(w + "###" for w in body(60)), "s1"))
        if i % 20 == 0:
            rows.append((len(rows), None if i % 40 else "short", None))
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    junk = {i for i, t, _ in rows if t and "###" in t}
    spark.createDataFrame([(i, int(i not in junk), 0) for i, t, _ in rows if t], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now, got = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/{name}.parquet")
        now = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        got[name] = now.collect()
        if name != "packing":
            assert now.columns == docs.columns
    good = {i: t for i, t, _ in rows if t and i not in junk and len(t.split()) >= 20}
    assert {r.doc_id: r.text for r in got["quality_rules"]}.keys() == good.keys()
    seen, texts = set(), {}
    for i in sorted(good):
        line, cover = good[i].split("\n"), set()
        for k in range(len(line) - 2):
            window = tuple(line[k : k + 3])
            if window in seen:
                cover |= {k, k + 1, k + 2}
            seen.add(window)
        texts[i] = "\n".join(x for k, x in enumerate(line) if k not in cover)
    assert {r.doc_id: r.text for r in got["line_dedup"]} == texts
    first = {}
    sets = {i: shingles(t) for i, t in texts.items()}
    for i in sorted(texts):
        first[i] = min((first[j] for j in first if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])), default=i)
    keep = {i for i in texts if first[i] == i}
    assert {r.doc_id for r in got["near_duplicates"]} == keep and len(keep) < len(texts)
    sizes = defaultdict(int)
    for r in got["near_duplicates"]:
        sizes[r.source] += len(r.text.split())
    mixed = defaultdict(int)
    for r in got["mix_sources"]:
        assert texts[r.doc_id].startswith(r.text)
        mixed[r.source] += len(r.text.split())
    assert sum(mixed.values()) == pytest.approx(sum(sizes.values()), abs=len(sizes))
    pieces = defaultdict(int)
    for r in got["packing"]:
        pieces[r.sequence_id] += r.length
    assert max(pieces.values()) <= packing.LENGTH
    whole = spark.createDataFrame([(r.doc_id, r.text) for r in got["mix_sources"]], "doc_id long, text string")
    assert sum(pieces.values()) == sum(r.length for r in packing.pieces_of(whole).collect())


def test_every_stage_takes_odd_rows(spark, odd, empty, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, str(tmp_path)).count() >= 0
        assert stage(spark, empty, str(tmp_path)).count() == 0
