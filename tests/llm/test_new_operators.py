"""Set join, centroid clustering and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from tidemark.llm import count_tree, pivot_clusters, turn_repair
from tidemark.llm.near_dedup import Shingler

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, id string, n string, handle string, tree long, label string"
VECTORS = "vec_id long, embedding array<double>, v string, t string, cluster string"
TURNS = "conv_id long, turn long, role string, text string, mark string, fault int, dropped string, audit string"


# ---- set join


def shingles(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} - {()}


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=str)


def changed(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def corpus():
    rng = random.Random(5)
    texts = [None, "", " \n\t", "one", "One", "one two", "ONE  two", "a b c", "ünï ▁ \x00😀 z", "x " * 3000, "x y " * 4000]
    for length in (12, 20, 30, 60, 200, 900):
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        texts.append(" ".join(base))
        texts += [" ".join(changed(rng, base, k)) for k in (1, 1, 1, 2, 2, 3, 5) for _ in range(4)]
        texts += [" ".join(base[:-1]), " ".join([*base, "more"]), " ".join(base).upper()]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[20]), (None, "only null id here now"), (None, None), rows[30], rows[30], (7, texts[40])]


def as_docs(spark, rows):
    return spark.createDataFrame([(*r, "q", "q", "q", 1, "q") for r in rows], DOCS)


def found_components(spark, rows):
    return sorted(map(tuple, count_tree.with_components(as_docs(spark, rows)).collect()), key=str)


def test_set_join_matches_all_pairs(spark):
    assert found_components(spark, corpus()) == brute_components(corpus())


def test_set_join_descends_packed_trees(spark, monkeypatch):
    """Many near copies of one text, few of which link: trees of many pages and three levels."""
    monkeypatch.setattr(count_tree, "PAGE", 4)
    monkeypatch.setattr(count_tree, "FANOUT", 3)
    rng = random.Random(9)
    base = [f"w{rng.randrange(900)}" for _ in range(70)]
    copies = [" ".join(changed(rng, base, rng.choice([1, 2, 2, 3]))) for _ in range(150)]
    chain = [" ".join([*base[:60], *[f"t{k}" for k in range(j)]]) for j in range(12)]
    rows = list(enumerate(copies + chain))
    expected = brute_components(rows)
    assert 1 < len({c for _, _, c in expected}) < len(rows)
    assert found_components(spark, rows) == expected


def test_linked_sets_share_a_tree_and_pass_the_bounds():
    rng = np.random.default_rng(3)
    checked = 0
    for n in (9, 10, 17, 18, 19, 26, 35, 36, 40, 47, 48, 53, 63, 100, 250, 1000, 4000):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            lost, added = rng.integers(0, n // 9 + 2, 2)
            b = np.unique(np.concatenate([a[lost:], rng.integers(0, 1 << 63, added, dtype=np.uint64)]))
            if not count_tree.linked(a, b):
                continue
            checked += 1
            assert set(count_tree.tree_names(a).tolist()) & set(count_tree.tree_names(b).tolist()), (len(a), len(b))
            p, q = count_tree.point(a), count_tree.point(b)
            width = min(len(p), len(q))
            for w in {width, count_tree.COARSE}:
                overlap = int(np.minimum(count_tree.fold(p[None], w), count_tree.fold(q[None], w)).sum())
                assert overlap >= len(np.intersect1d(a, b)) and count_tree.enough(overlap, len(a) + len(b))
    assert checked > 150


def test_full_counts_have_no_bound():
    many = np.arange(70_000, dtype=np.uint64) * np.uint64(1 << 16)  # all in one group
    p = count_tree.point(many)
    assert p.max() == count_tree.FULL and count_tree.fold(p[None], count_tree.COARSE).max() >= len(many)


def test_short_texts_are_one_shingle():
    assert len(Shingler(3)(b"a b")) == 1 and len(Shingler(3)(b"")) == 0


# ---- centroids


def brute_clusters(rows):
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in named[:16]]
    assign = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
    for _ in range(3):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        for k, g in groups.items():
            centroids[k] = [sum(col) // len(g) for col in zip(*g)]
    found = [(i, *assign(v)) for i, v in kept]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = sum(d for _, d, _ in found)
    inertia = {k: sum(d for _, d, c in found if c == k) for k in range(len(centroids))}
    return sorted(((i, k, d, inertia[k], total, sha[k]) for i, d, k in found), key=str)


def clusters(spark, rows):
    df = spark.createDataFrame([(i, v, "q", "q", "q") for i, v in rows], VECTORS)
    return sorted(map(tuple, pivot_clusters.clustered(df).collect()), key=str)


def vectors(n, scale=1.0):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(5, 64))
    return [(i, (scale * (centres[i % 5] + 0.3 * rng.normal(size=64))).tolist()) for i in range(n)]


def test_centroids_match_brute_force(spark):
    rows = vectors(300)
    odd = [(900, None), (901, [0.5] * 63), (902, [0.5] * 63 + [None]), (903, [float("nan")] * 64), (904, [float("inf")] + [0.0] * 63)]
    same = [(None, rows[3][1]), (5, rows[9][1]), rows[7], rows[7], *[(1000 + i, [0.25] * 64) for i in range(120)]]
    assert clusters(spark, rows + odd + same) == brute_clusters(rows + odd + same)


def test_centroids_of_few_and_large_vectors(spark):
    assert clusters(spark, vectors(9)) == brute_clusters(vectors(9))
    assert clusters(spark, vectors(40, 1e6)) == brute_clusters(vectors(40, 1e6))
    assert clusters(spark, []) == [] and clusters(spark, [(None, [0.0] * 64)]) == []
    ties = [(i, [float(i % 2)] * 64) for i in range(40)]
    assert clusters(spark, ties) == brute_clusters(ties)


def test_distances_beyond_the_long_range_are_errors(spark):
    with pytest.raises(Exception, match="long"):
        clusters(spark, [(i, [i * 1e15] * 64) for i in range(40)])


def test_pivots_spare_distances(monkeypatch):
    x = np.array([np.floor(64 * np.array(v)).astype(np.int64) for _, v in vectors(400)])
    pivots = x[:16]
    table, seen = pivot_clusters.distances(x, pivots), []
    whole = pivot_clusters.squared
    monkeypatch.setattr(pivot_clusters, "squared", lambda a, b: seen.append(len(a)) or whole(a, b))
    best, cost = pivot_clusters.nearest(x, table, pivots, pivots)
    full = np.stack([whole(x, c[None]) for c in pivots], axis=1)
    assert (cost == full.min(axis=1)).all() and (best == full.argmin(axis=1)).all()
    assert sum(seen) < 0.6 * full.size


# ---- conversations


def brute_repair(symbols):
    """(cost, audit) by trying every edit from every state."""

    @lru_cache(None)
    def best(i, last, inserts):
        found = [(0, "")] if i == len(symbols) and last in ("", "a") else []
        emit = lambda c: (last, c) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
        for c in "ua":
            if emit(c) and inserts < 3:
                cost, audit = best(i, c, inserts + 1)
                found.append((cost + 2, "I" + audit))
        if i < len(symbols):
            s = symbols[i]
            cost, audit = best(i + 1, last, 0)
            found.append((cost + 3, "D" + audit))
            if s != "x":
                extra = s.isupper()
                if emit(s.lower()):
                    cost, audit = best(i + 1, s.lower(), 0)
                    found.append((cost + extra, "K" + audit))
                for c in "ua":
                    if emit(c):
                        cost, audit = best(i + 1, c, 0)
                        found.append((cost + 2 + extra, "R" + audit))
        return min(found, default=(10**6, ""))

    return best(0, "", 0)


def test_cheapest_edits_match_all_edits():
    rng = random.Random(1)
    for _ in range(400):
        symbols = "".join(rng.choice("xsuaoSUAO") * rng.choice([1, 1, 2, 3, 5]) for _ in range(rng.randrange(6)))
        runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", symbols)]
        assert turn_repair.cheapest(runs) == brute_repair(symbols), symbols


def test_long_runs_use_powers():
    cost, audit = turn_repair.cheapest([("u", 1), ("x", 100_000), ("a", 1)])
    assert cost == 300_000 and audit == "K" + "D" * 100_000 + "K"
    assert len(turn_repair._POWERS.known["x"]) <= 18
    for n in (9, 16, 33):
        for symbol in "uaSo":
            assert turn_repair.cheapest([(symbol, n)]) == brute_repair(symbol * n)


def plain(rows, damage=True):
    """The contract, row by row."""
    by = {}
    for at, (conv, turn, role, text) in enumerate(rows):
        kept = by.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        kept += [((turn is not None, turn or 0, mark), turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, kept in by.items():
        kept.sort(key=lambda r: r[0])
        symbols, counts, seen = "", [0, 0, 0], set()
        for _, _, role, text in kept:
            i = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not WORD.search(text):
                counts[0], s = counts[0] + 1, "x"
            elif (role, text) in seen:
                counts[1], s = counts[1] + 1, "x"
            elif not re.search("[.!?][\x20\x09-\x0d]*\\Z", text):
                counts[2], s = counts[2] + 1, i.upper()
            else:
                s = i
            seen.add((role, text))
            symbols += s
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        turns = {r[1] for r in kept} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = brute_repair(symbols)
        lines, last, at = [], "", 0
        for edit in audit:
            want = "a" if last == "u" else "u"
            name = {"u": "user", "a": "assistant"}[want]
            if edit == "I":
                lines, last = [*lines, f"{name}:"], want
                continue
            _, _, role, text = kept[at]
            at += 1
            if edit == "K":
                lines, last = [*lines, f"{role}:{text}"], role[0]
            elif edit == "R":
                lines, last = [*lines, f"{name}:{text}"], want
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Hello there.", "Yes!", "cut off", "", " \n", None, "Is it? ", "More text.\n", "ü 😀.", "Long text. " * 2000]
    rows = [(conv, turn, rng.choice(roles), rng.choice(texts)) for conv in range(60) for turn in range(rng.randrange(1, 9))]
    rows += [(conv, turn, ("user", "assistant")[turn % 2], f"Turn {turn} of {conv}.") for conv in range(60, 120) for turn in range(8)]
    rows += [(None, 1, "user", "No conversation."), (None, None, "assistant", "No turn."), (200, None, None, None), (201, None, "user", "A."), (201, None, "assistant", "B.")]
    rows += [(202, 3, "user", "Same."), (202, 3, "user", "Same."), (202, 3, "assistant", "Other."), (203, 9, "system", "S.")]
    return rows


def as_turns(spark, rows):
    return spark.createDataFrame([(*r, "q", 1, "q", "q") for r in rows], TURNS)


def test_repair_matches_the_contract(spark):
    df = as_turns(spark, conversations())
    assert sorted(map(tuple, turn_repair.repaired(turn_repair.damaged(df)).collect()), key=str) == plain(conversations())
    assert sorted(map(tuple, turn_repair.repaired(turn_repair.unchanged(df)).collect()), key=str) == plain(conversations(), False)


def test_repair_of_an_empty_table_and_of_one_long_conversation(spark):
    assert turn_repair.repaired(turn_repair.damaged(as_turns(spark, []))).collect() == []
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Row {t}.") for t in range(20_000)]
    (found,) = turn_repair.repaired(turn_repair.unchanged(as_turns(spark, rows))).collect()
    text = "\n".join(f"{r}:{x}" for _, _, r, x in rows)
    assert found["audit"] == "K" * 20_000 and found["cost"] == 0
    assert found["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_documents(spark):
    assert count_tree.with_components(as_docs(spark, [])).collect() == []
