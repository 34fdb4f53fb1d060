from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from tests.llm.conftest import LONG

from acervo.llm import line_dedup, mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in stopped]
        left = total - sum(3 * sizes[s] for s in stopped)
        wide = sum(weight[s] for s in open_)
        target = {s: 3.0 * sizes[s] if s in stopped else weight[s] * left / wide for s in order}
        above = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not above:
            return target
        stopped |= above


def plain_mix(rows: list) -> list:
    size = [len(WORDS.findall(t or "")) for _, t, _ in rows]
    sources = defaultdict(int)
    for (_, _, s), n in zip(rows, size, strict=True):
        sources[s] += n
    target = plain_targets(sources)
    out = []
    for s in sources:
        mine = [(hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), i is not None, i or 0, n, i) for (i, _, s2), n in zip(rows, size, strict=True) if s2 == s]
        passes, rest = divmod(int(target[s]), max(1, sources[s]))
        if not sources[s]:
            passes, rest = int(target[s]), 0
        for _, _, _, n, i in sorted(mine, key=lambda r: r[:4]):
            last = min(n, rest)
            rest -= last
            out.append((i, n, sources[s], round(target[s], 6), passes * n + last))
    return sorted(out, key=repr)


def mixed(df):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(df).collect()), key=repr)


def test_mix_equals_a_plain_version(documents, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 30))), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(200)]
    assert mixed(documents(rows)) == plain_mix(rows)


def test_targets_stop_at_three_times_a_source(documents):
    rows = [(i, "w " * 1000, "z") for i in range(3)] + [(10, "w w", "a"), (11, "w", "b"), (12, "", "c")]
    got = {(r.source_size, r.target) for r in mixing.mix(documents(rows)).collect()}
    assert (2, 6.0) in got and (1, 3.0) in got and (0, 0.0) in got
    assert sum(t for _, t in got) == pytest.approx(3003)


def test_mix_of_odd_rows(odd, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.taken <= 3 * r["size"] for r in got)
    by_source = defaultdict(int)
    for r in got:
        by_source[r.source] += r.taken
        assert r.target <= 3 * r.source_size
    for r in got:
        assert by_source[r.source] == int(r.target)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mixed_documents_repeat_and_cut(odd, documents):
    rows = [(i, f"a{i} b{i}\tc{i} \n d{i}", s) for i, s in enumerate("aaabbbccc")]
    df = documents(rows)
    want = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    got = defaultdict(int)
    text = dict((i, t) for i, t, _ in rows)
    for r in mixing.mixed_documents(df).collect():
        assert text[r.doc_id].startswith(r.text) and r["size"] == "x"
        got[r.doc_id] += len(WORDS.findall(r.text))
    assert {i: n for i, n in want.items() if n} == dict(got)
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    assert sum(len(WORDS.findall(r.text)) for r in out.collect()) >= 0.99 * sum(r.taken for r in mixing.mix(odd).collect())


def plain_lines(rows: list) -> list:
    seen, cover = {}, defaultdict(set)
    for i, t, _ in sorted({(i, t, 0) for i, t, _ in rows if t is not None}, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = t.split("\n")
        for k in range(len(lines) - 2):
            body = "\n".join(lines[k : k + 3])
            if WORDS.search(body):
                if body in seen:
                    cover[i, t] |= {k, k + 1, k + 2}
                seen.setdefault(body, (i, k))
    out = []
    for i, t, _ in rows:
        lines = t.split("\n") if t is not None else []
        keep = [x for k, x in enumerate(lines) if k not in cover[i, t]]
        out.append((i, None if t is None else "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=repr)


def test_line_dedup_equals_a_plain_version(documents):
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c c", "", "d"]) for _ in range(rng.randint(0, 12))), None) for i in range(120)]
    got = line_dedup.dedup_lines(documents(rows)).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=repr) == plain_lines(rows)


def test_line_dedup_of_odd_rows(odd, empty):
    out = line_dedup.dedup_lines(odd)
    assert out.count() == odd.count() and set(odd.columns) <= set(out.columns)
    texts = {(r.doc_id, r.text) for r in out.collect()}
    # the first x y z is in document 10; the second there and all of document 11's go, and short or null texts stay
    assert {(10, "x\ny\nz\n\n"), (11, ""), (11, "other text"), (1, None), (2, ""), (7, LONG)} <= texts
    assert line_dedup.dedup_lines(empty).count() == 0
