from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from tests.llm.conftest import LONG

from acervo.llm import quality_rules, simhash


def plain_counts(text: str) -> tuple:
    b = text.encode()
    words = b.split()
    lines = [x for x in b.split(b"\n") if x.split()]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("seed", range(4))
def test_counts_equal_plain_ones(seed):
    rng = random.Random(seed)
    for _ in range(60):
        text = "".join(rng.choice(["a", "b", "a a a a a a a a ", "\n", " ", "é", "#", "\x0b", " ", "漢", "<"]) for _ in range(rng.randint(0, 120)))
        assert quality_rules.counts_of(text.encode())[:5] == plain_counts(text)


def test_rules_cover_bad_rows_and_leave_good_ones():
    rng = np.random.default_rng(0)
    bad = rng.random(3000) < 0.2
    x = {"symbol_rate": np.where(bad & (rng.random(3000) < 0.5), rng.random(3000) + 0.5, rng.random(3000) * 0.3), "mean_word": np.where(bad, 8.0, 5.0) + rng.normal(0, 0.3, 3000), "noise": rng.random(3000)}
    rules = quality_rules.learn(x, bad)
    hit = np.any([quality_rules._covered(r, x, 3000) for r in rules], axis=0)
    assert (hit & bad).sum() > 0.95 * bad.sum() and (hit & ~bad).sum() <= 0.01 * hit.sum()
    assert quality_rules.learn({"noise": rng.random(500)}, rng.random(500) < 0.3) == []


def test_judge_odd_rows(spark, odd, empty, documents):
    labels = spark.createDataFrame([(1, 0, 0), (None, 1, 0), (2, None, 1), (7, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(odd, labels).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    assert quality_rules.judge(empty, labels).count() == 0 and quality_rules.judge(empty, labels.limit(0)).count() == 0
    kept = quality_rules.keep_good(documents([(1, LONG, "a"), (2, " ".join(map(str, range(50))), None), (3, None, "a"), (2, "", "a")]), labels)
    assert [(r.doc_id, r["size"], r.kept) for r in kept.collect()] == [(2, "x", "x")] and kept.columns == empty.columns


def test_learned_rule_rejects_what_labels_call_bad(spark, documents):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows = [(i, " ".join(word() + ("###" if i % 4 == 0 else "") for _ in range(60)), "a") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in quality_rules.judge(documents(rows), labels).where("kept").collect()} == {i for i in range(400) if i % 4}


def test_a_repeated_id_is_one_example_of_the_fit(spark, documents, monkeypatch):
    text = lambda i: " ".join(f"w{i}x{k}" + ("##" if i % 2 else "") for k in range(60))
    rows = [(i, text(i), "a") for i in range(120)] + [(7, text(7), "a")] * 300 + [(8, " ".join(f"v{j}" for j in range(n, n + 30)), "b") for n in range(200)]
    labels = spark.createDataFrame([(i, (i + 1) % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    seen = []
    learn = quality_rules.learn
    monkeypatch.setattr(quality_rules, "learn", lambda features, bad: (seen.append(len(bad)), learn(features, bad))[1])
    kept = {r.doc_id for r in quality_rules.judge(documents(rows), labels).where("kept").select("doc_id").collect()}
    assert seen == [120] and kept == set(range(0, 120, 2))


def plain_fingerprint(text: str | None, size: int = 4) -> int:
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    bits = Counter(b for p in parts for b in range(64) if xxhash.xxh64_intdigest(p, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(parts))


def plain_groups(keys: list, near) -> list[int]:
    up = list(range(len(keys)))

    def top(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if near(keys[i], keys[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(keys))]


@pytest.mark.parametrize("seed", range(3))
def test_trie_links_equal_all_pairs(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fps = base[rng.integers(0, 5, 300)]
    for _ in range(5):
        fps = np.where(rng.random(300) < 0.6, fps ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)), fps)
    groups = rng.integers(0, 3, 300)
    rows = np.unique(np.stack([groups.astype(np.uint64), fps], 1), axis=0)
    groups, fps = rows[:, 0].astype(int), rows[:, 1]
    links = simhash.trie_links(groups, fps, 4)
    close = lambda a, b: a[0] == b[0] and bin(int(a[1]) ^ int(b[1])).count("1") <= 4
    keys = list(zip(groups.tolist(), fps.tolist(), strict=True))
    assert all(close(keys[a], keys[b]) for a, b in links)
    joined = {(a, b) for a, b in links} | {(b, a) for a, b in links}
    mine = plain_groups(list(range(len(keys))), lambda i, j: (i, j) in joined)
    assert mine == plain_groups(keys, close)


def test_near_duplicates_equal_all_pairs(documents):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for i in range(40):
        text = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        for c in range(rng.randint(1, 5)):
            copy = list(text)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 3 + 1, " ".join(copy).upper() if c % 2 else "\n".join(copy), "a"))
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(documents(rows)).collect()}
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    want = plain_groups(fps, lambda a, b: bin(a ^ b).count("1") <= 4)
    assert got == {r[0]: (np.uint64(f).view(np.int64), rows[w][0]) for r, f, w in zip(rows, fps, want, strict=True)}


def test_near_duplicates_of_odd_rows(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.fp == 0} == {1} and {r.component_id for r in got if r.doc_id in (7, 8)} == {7}
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (5, 3)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 20 for i in range(20, 61)} | {i: 100 for i in range(100, 130)} | {5: 3, 3: 3}


def test_one_of_each_group_stays(odd, documents):
    rng = random.Random(8)
    text = [f"t{rng.randrange(10**6)}" for _ in range(300)]
    changed = text[:150] + ["new"] + text[151:]
    other = [f"o{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(9, " ".join(text), "a"), (4, " ".join(changed), "b"), (6, " ".join(text).upper(), "a"), (8, " ".join(other), None), (8, " ".join(other), None), (1, " ".join(other[:150] + text[150:]), "a")]
    out = simhash.drop_near_duplicates(documents(rows))
    assert sorted(r.doc_id for r in out.collect()) == [1, 4, 8] and out.columns == odd.columns
    kept = simhash.drop_near_duplicates(odd).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == [-4, 1, 5, 6, 7, 10, 11, 11]
    assert len({(r.text or "").lower() for r in kept}) == len(kept)


def jaccard(a: str, b: str) -> float:
    p, q = (set(simhash.shingle_set(t.encode()).tolist()) for t in (a, b))
    return len(p & q) / len(p | q)


def test_near_copies_with_passages_added_or_cut_are_found(documents):
    rng = random.Random(11)
    word = lambda: f"p{rng.randrange(10**7)}"
    rows, wanted = [], 0
    for i in range(160):
        text = [word() for _ in range(rng.choice([60, 150, 500]))]
        more = int(len(text) * rng.uniform(0.1, 0.24))
        copy = text + [word() for _ in range(more)] if i % 2 else text[: len(text) - int(more * 0.8)]
        pair = " ".join(text), " ".join(copy)
        if 0.8 <= jaccard(*pair) <= 0.9:
            wanted += 1
            rows += [(2 * i, pair[0], "a"), (2 * i + 1, pair[1], "a")]
    groups = {r.doc_id: r.keeper for r in simhash.near_groups(documents(rows)).collect()}
    assert wanted > 100 and groups == {i: i - i % 2 for i in groups}


def test_candidates_that_fail_with_the_first_are_compared_with_each_other(spark):
    rng = random.Random(12)
    family = [set(range(k * 100, k * 100 + 100)) for k in range(6)]
    # in one key: pairs at 0.82 whose members are unlike those of all other pairs, and the first node unlike all
    sets = {0: set(range(5000, 5100))} | {n: family[n % 6] ^ {n % 6 * 100 + n, 10_000 + n} | {20_000 + i for i in range(40)} for n in range(1, 40)}
    sets |= {n: {rng.randrange(10**6) for _ in range(100)} for n in range(40, 60)}
    similar = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    members = spark.createDataFrame([(1, n, len(s), n % 3) for n, s in sets.items()], "key long, node long, size int, degree long")
    frame = spark.createDataFrame([(n, sorted(s)) for n, s in sets.items()], "node long, shingles array<long>")
    roots = {r.node: r.root for r in simhash.verified(members, frame, 0.8).collect()}
    assert [roots.get(n, n) for n in range(60)] == plain_groups([sets[n] for n in range(60)], similar)


@pytest.mark.parametrize("copies", [200, 400])
def test_comparisons_grow_with_the_copies_of_a_text(documents, monkeypatch, copies):
    rng = random.Random(13)
    text = [f"p{i}" for i in range(100)]
    rows = [(0, " ".join(text), "a")]
    for i in range(1, copies):
        changed = list(text)
        for at in rng.sample(range(100), 2):
            changed[at] = f"q{rng.randrange(10**7)}"
        rows.append((i, " ".join(changed), "a"))
    compared = []
    real = simhash.alike

    def counted(pairs, sets, similarity):
        compared.append(pairs.count())
        return real(pairs, sets, similarity)

    monkeypatch.setattr(simhash, "alike", counted)
    groups = {r.doc_id: r.keeper for r in simhash.near_groups(documents(rows)).collect()}
    near = [i for i, t, _ in rows if jaccard(rows[0][1], t) >= 0.8]
    assert all(groups[i] == 0 for i in near) and len(near) > copies // 2
    assert sum(compared) < 8 * copies


def test_fingerprints_find_near_copies_of_the_stage(documents, monkeypatch):
    rng = random.Random(14)
    monkeypatch.setattr(simhash, "band_keys", lambda shingles: np.zeros(0, np.int64))
    rows = []
    for i in range(6):
        text = [f"s{rng.randrange(10**7)}" for _ in range(600)]
        rows += [(3 * i, " ".join(text), "a"), (3 * i + 1, " ".join([*text, "end"]), "a"), (3 * i + 2, " ".join(f"s{rng.randrange(10**7)}" for _ in range(50)), "a")]
    near = {r[0] for r in rows if r[0] % 3 == 1 and bin(plain_fingerprint(rows[r[0]][1]) ^ plain_fingerprint(rows[r[0] - 1][1])).count("1") <= 4}
    kept = {r.doc_id for r in simhash.drop_near_duplicates(documents(rows)).collect()}
    assert len(near) > 3 and kept == {r[0] for r in rows} - near


def test_texts_that_lone_shingles_keep_apart_are_not_compared(spark, monkeypatch):
    # one family: three of four shingles are common to all, the rest is each one's own, so no two reach 0.8
    sets = {n: [*range(75), *range(1000 + 25 * n, 1025 + 25 * n)] for n in range(60)}
    sets |= {100: [*range(75), *range(25_000, 25_020)], 101: [*range(75), *range(25_000, 25_021)]}
    members = spark.createDataFrame([(1, n, len(s), 61) for n, s in sets.items()], "key long, node long, size int, degree long")
    frame = spark.createDataFrame([(n, s) for n, s in sets.items()], "node long, shingles array<long>")
    compared = []
    real = simhash.alike

    def counted(pairs, sets, similarity):
        compared.append(pairs.count())
        return real(pairs, sets, similarity)

    monkeypatch.setattr(simhash, "alike", counted)
    roots = {r.node: r.root for r in simhash.verified(members, frame, 0.8).collect()}
    assert roots == {100: 100, 101: 100} and sum(compared) == 1


def test_texts_that_differ_in_shared_shingles_are_not_compared(spark, monkeypatch):
    # one family: each lacks 15 of 100 shingles and has 15 others, none of them its own alone, so nearly all pairs are at 0.6 to 0.7
    rng = random.Random(15)
    sets = {}
    for n in range(0, 80, 2):
        more = range(1000 + 20 * n, 1015 + 20 * n)
        sets |= {i: sorted([*rng.sample(range(100), 85), *more]) for i in (n, n + 1)}
    sets |= {80: [*range(100)], 81: [*range(99)], 82: [*sets[0][1:], 5000], 83: [*sets[0][2:], 5000]}
    members = spark.createDataFrame([(1, n, len(s), 83) for n, s in sets.items()], "key long, node long, size int, degree long")
    frame = spark.createDataFrame([(n, s) for n, s in sets.items()], "node long, shingles array<long>")
    compared = []
    real = simhash.alike

    def counted(pairs, sets, similarity):
        compared.append(pairs.count())
        return real(pairs, sets, similarity)

    monkeypatch.setattr(simhash, "alike", counted)
    similar = lambda a, b: len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b))
    roots = {r.node: r.root for r in simhash.verified(members, frame, 0.8).collect()}
    assert [roots.get(n, n) for n in range(84)] == plain_groups([sets[n] for n in range(84)], similar)
    assert sum(compared) < 4 * len(sets)
