"""Document operators against brute force, on small tables with odd rows."""

from __future__ import annotations

import hashlib
import importlib.util
import os
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hidden_markov, host_rules, mixing, near_dedup, pu_toxicity, secret_links, sentence_wfst
from tidemark.llm.queries import model_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, rid string, size string"
WORD = re.compile("[^\x20\x09-\x0d]+")
SENTENCE = "the quick brown fox jumps over a lazy dog while seven small birds sing near the old stone bridge at dawn today"


def rows(texts, source=lambda i: f"s{i % 4}"):
    return [(i, t, "en", source(i), None if t is None else len(t), "k", "r", "z") for i, t in enumerate(texts)]


ODD = [None, "", " \n\t", "one", "one", "One", "ünï ▁ \x00😀", SENTENCE, SENTENCE, SENTENCE + " again", "x " * 3000, SENTENCE.upper()]


@pytest.fixture(scope="module")
def odd(spark):
    base = rows(ODD)
    extra = [(None, "null id text", "en", None, 3, None, None, None), (None, None, None, None, None, None, None, None), base[7]]
    return spark.createDataFrame(base + extra, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def held(doc_id, by, hit):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % by == hit


# ---- near duplicates


def shingles(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return set(zip(words, words[1:])) if len(words) > 1 else set(words)


def components(items):
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingles(t) for _, t in items]
    for i in range(len(items)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(items):
        low.setdefault(find(i), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in low.items()}
    return sorted(((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(items)), key=str)


def test_near_duplicates_match_all_pairs(spark, odd):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choice(vocabulary, 120).tolist()
        texts.append(" ".join(base))
        for k in range(14):  # near copies, some over and some under the limit
            other = base.copy()
            for at in rng.choice(120, int(rng.integers(0, 13)), replace=False):
                other[at] = f"n{k}x{at}"
            texts.append(" ".join(other))
    docs = spark.createDataFrame(rows(texts), SCHEMA).unionByName(odd.withColumn("doc_id", odd.doc_id + 1000))
    items = [(r.doc_id, r.text) for r in docs.collect()]
    found = near_dedup.with_components(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, found), key=str) == components(items)
    kept = near_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, _, k in components(items) if k}


def test_large_groups_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:k] + [f"a{k}"] + base[k + 1 :] if k < 60 else base[: k - 60] + [f"b{k}", f"c{k}"] + base[k - 58 :]) for k in range(110)]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    found = near_dedup.with_components(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, found), key=str) == components(list(enumerate(texts)))


def test_members_of_one_key_go_to_many_tasks(spark):
    members = spark.range(30_000).select(F.xxhash64("id").alias("rid"), F.when(F.col("id") < 10_000, F.lit(7)).otherwise(F.col("id")).alias("key"))
    counts = members.groupBy("key").agg(F.count("*").alias("members"), near_dedup._seats())
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for (k, v) in zip(before, ("32", "-1", "false")):
        spark.conf.set(k, v)
    try:
        joined = near_dedup.by_seat(members, counts, "key").withColumn("part", F.spark_partition_id())
        sizes = {r.part: r["count"] for r in joined.groupBy("part").count().collect()}
        assert joined.where("key = 7").agg(F.min("members"), F.max("members"), F.count("*")).first() == (10_000, 10_000, 10_000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes.values()) == 30_000 and max(sizes.values()) < 3_000


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * rng.uniform(0.75, 1))], rng.integers(0, 2**63, int(n * rng.uniform(0, 0.2))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert near_dedup.possible([len(a)], [near_dedup.bitmap(a).tobytes()], [len(b)], [near_dedup.bitmap(b).tobytes()]) == [(0, 0)]


# ---- secrets


def naive_base(text):
    text, out = text or "", []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, pattern, good in (
        ("assign", assign, lambda m: len(m[2]) >= 12), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ):
        out += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text, re.ASCII) if good(m)]
    return sorted(out, key=lambda s: (s[0], ("assign", "access", "hex").index(s[2])))


SECRETS = [
    'ü token = "4534254f83b7e27b3670756d7cab6da61ccfcea9" end', "PassWord:'short' password: longenough_value12", "AKIA" + "A" * 13 + " AKIA" + "B" * 14,
    "deadbeef" * 2 + " cafe0123", "client_id=my-app-17\nZq8Rk2Wv7Lx4Tn9Bc3Hd6Fj\nhttps://api.example.com/v1", "Zq8Rk2Wv7Lx4Tn9Bc3Hd6Fj", "client_id=my-app-17",
    "client_id=my-app-17\n\nZq8Rk2Wv7Lx4Tn9Bc3Hd6Fj", "AKIA" + "C" * 16 + " and Zq8Rk2Wv7Lx4Tn9Bc3Hd6Fj", "ſecret=abcdefabcdefab123", "token=AKIA" + "D" * 20, None, "",
]


def test_secret_spans(spark):
    found = {r.doc_id: r for r in secret_links.scan(spark.createDataFrame(rows(SECRETS), SCHEMA)).collect()}
    for i, text in enumerate(SECRETS):
        base = naive_base(text)
        r = found[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[2] == k for s in base) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in base).encode()).hexdigest()
        assert {f"{k}:{s}:{e}" for s, e, k in base} <= set(r.spans.split(","))
    kinds = lambda i: [s.split(":")[0] for s in found[i].spans.split(",") if s]
    assert kinds(4) == ["ident", "key", "endpoint"]
    assert kinds(5) == kinds(6) == kinds(7) == []  # alone, or in another block
    assert kinds(8) == ["access", "key"]


def test_links_match_all_pairs():
    rng = np.random.default_rng(7)
    parts = ["user_id=abc{0}", "host: h{0}.example.org", "Zq8Rk2Wv7Lx4Tn9Bc{0}", "password=longenough{0}value", "AKIA" + "Q" * 14, "w" * 90, "\n", "\n \n", "plain words"]
    within = lambda a, b: a[0] <= b[1] + secret_links.REACH and b[0] <= a[1] + secret_links.REACH
    reported = 0
    for _ in range(300):
        text = " ".join(parts[k].format(int(rng.integers(1000, 9999))) for k in rng.integers(0, len(parts), 30))
        base, spans = secret_links.all_spans(text)
        weak = [(m.start(), m.end(), k) for k, p in zip(secret_links.WEAK, (secret_links.IDENT, secret_links.KEY, secret_links.ENDPOINT)) for m in p.finditer(text)]
        weak = [w for w in weak if (w[2] != "key" or secret_links._mixed(text[w[0] : w[1]])) and not any(b[0] < w[1] and w[0] < b[1] for b in base)]
        blocks = [m.start() for m in re.finditer(r"\n[ \t]*\n", text)]
        near = lambda a, b: within(a, b) and not any(min(a[0], b[0]) < x <= max(a[0], b[0]) for x in blocks)
        idents = [w for w in weak if w[2] == "ident"] + [b for b in base if b[2] == "access"]
        secrets = [w for w in weak if w[2] == "key"] + [b for b in base if b[2] != "access"]
        to_secret, to_ident = (lambda w: any(near(w, x) for x in secrets)), (lambda w: any(near(w, x) for x in idents))
        good = {"ident": to_secret, "key": to_ident, "endpoint": lambda w: to_secret(w) and to_ident(w)}
        expected = [w for w in weak if good[w[2]](w)]
        assert sorted(spans) == sorted(base + expected)
        reported += len(expected)
    assert reported > 300
    nested = "token=" + ".".join(["deadbeef" * 2] * 5) + ".Zq8Rk2Wv7Lx4Tn9Bc3Hd user_id=abcd"
    assert "key" not in {k for _, _, k in secret_links.all_spans(nested)[1]}


def test_redaction_keeps_rows_and_columns(spark, odd):
    out = secret_links.redacted(spark.createDataFrame(rows(SECRETS), SCHEMA).unionByName(odd))
    assert out.columns == odd.columns and out.count() == len(SECRETS) + odd.count()
    for r in out.where("text IS NOT NULL").collect():
        assert not naive_base(r.text)


# ---- quality rules


def naive_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    inside = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(inside)


def test_document_rules(spark, odd):
    texts = ["a b c d e f g h " * 3 + "z", "l1 x\nl1 x\n \n \nl2", "#*$%& |<> ü", SENTENCE + "\n" + SENTENCE, "a b c d e f g h i " * 40]
    docs = spark.createDataFrame(rows(texts), SCHEMA).unionByName(odd)
    expected = sorted(((r.doc_id, *naive_rules(r.text)) for r in docs.collect()), key=str)
    found = host_rules.document_rules(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found), key=str) == expected


def test_a_host_that_departs_from_the_others_is_rejected(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "short"
    texts, hosts = [], []
    for number in range(20):  # 19 hosts with 10 % failures, one with 45 %, one of two documents that both fail
        for i in range(100):
            texts.append(bad if i < (45 if number == 0 else 10) else good)
            hosts.append(f"h{number}")
    texts, hosts = texts + [bad, bad], hosts + ["tiny", "tiny"]
    docs = spark.createDataFrame(rows(texts, lambda i: hosts[i]), SCHEMA)
    verdicts = {r.host: r.rejected for r in host_rules.host_verdicts(host_rules.document_rules(docs)).collect()}
    assert [h for h, rejected in verdicts.items() if rejected] == ["h0"]
    kept = {r.doc_id for r in host_rules.judged(docs).where("kept").collect()}
    assert kept == {i for i, (t, h) in enumerate(zip(texts, hosts)) if t == good and h != "h0"}


def test_host_verdicts_are_shrunk(spark):
    good, bad = SENTENCE, "short"
    texts = [bad] * 200 + [good] * 600 + [bad]
    host = lambda i: "worst" if i < 195 else "fine" if i < 800 else "tiny"
    docs = spark.createDataFrame(rows(texts, host), SCHEMA)
    rates = {r.host: r for r in host_rules.host_verdicts(host_rules.document_rules(docs)).collect()}
    assert rates["worst"].rejected and not rates["fine"].rejected
    assert rates["tiny"].rate < 1  # one failing document is little evidence
    kept = {r.doc_id: r.kept for r in host_rules.judged(docs).collect()}
    assert all(kept[i] for i in range(200, 800)) and not any(kept[i] for i in range(200))


# ---- mixing


def test_mixture_is_exact(spark, odd):
    rng = np.random.default_rng(2)
    texts = ["w " * int(n) for n in rng.integers(0, 40, 300)]
    docs = spark.createDataFrame(rows(texts, lambda i: "a" if i < 200 else None if i > 295 else f"s{i % 5}"), SCHEMA).unionByName(odd.withColumn("doc_id", odd.doc_id + 1000))
    out = mixing.mix(docs).collect()
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(docs).collect()))
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(sizes)
    while open_:
        rest = Fraction(sum(sizes.values()) - sum(target.values()))
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: Fraction(3 * sizes[s]) for s in full}
        open_ -= full
    taken = Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - float(target[r.source])) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) < 1 for s in sizes)
    words = Counter()
    mixed = mixing.mixed_texts(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        words[r.source] += len(WORD.findall(r.text))
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}


# ---- SentencePiece


@pytest.mark.skipif(not os.path.exists(model_path()), reason="no vocabulary file")
def test_encoding_equals_the_library(spark, odd):
    sentencepiece = importlib.import_module("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    rng = np.random.default_rng(1)
    alphabet = list("ab  e\n▁thinoé😀\x00<0x41> 's12")
    texts = ["".join(rng.choice(alphabet, int(n))) for n in rng.integers(0, 40, 400)] + [SENTENCE, "word" * 5000]
    docs = spark.createDataFrame(rows(texts), SCHEMA).unionByName(odd)
    for r in sentence_wfst.encoded(docs, model_path(), keep=("doc_id", "text")).collect():
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == library.encode(r.text)
            assert r.decoded == r.text.replace("▁", " ")
    assert sentence_wfst.digests(docs, model_path()).count() == docs.count()


def test_unigram_path_is_the_lightest():
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -4.0, 1), ("aba", -4.2, 1), ("▁a", -1.0, 1), ("ba", -3.9, 1)]
    net = sentence_wfst.Transducer({"pieces": pieces, "kind": sentence_wfst.UNIGRAM, "prefix": True, "collapse": False, "escape": True})
    score = {t: -s for t, s, k in pieces if k == 1}

    def best(text):
        if not text:
            return 0.0
        return min((score[text[:n]] + best(text[n:]) for n in range(1, 4) if text[:n] in score), default=float("inf"))

    for text in ("a", "abab", "ba ab", "aabba", "bb aba"):
        ids = net.encode(text)
        assert sum(score[pieces[i][0]] for i in ids) == pytest.approx(best("▁" + text.replace(" ", "▁")))
        assert net.decode(ids) == text


# ---- language model


def test_base_scores_and_exact_forward(spark, odd):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["der", "die", "das", "und", f"x{i}"], 30)) if i % 2 else " ".join(rng.choice(["the", "of", "and", f"y{i}"], 30)) for i in range(60)]
    docs = spark.createDataFrame(rows(texts), SCHEMA).unionByName(odd)
    table = [(r.doc_id, (r.text or "").encode().lower().split() + [b""]) for r in docs.collect()]
    counts = Counter(w for d, t in table if not held(d, 5, 1) for w in t)
    n, v = sum(counts.values()), len(counts)
    expected = sorted((str(d), len(t), sum(counts[w] > 0 for w in t), round(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for d, t in table)
    found = hidden_markov.scored(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == expected
    assert all(r.train_tokens == n and np.isfinite(r.score) and r.score < 0 for r in found)
    assert sum(r.score for r in found if r.doc_id is not None and len(ODD) < r.doc_id) > sum(r.base_score for r in found if r.doc_id is not None and len(ODD) < r.doc_id)


def test_recursions_match_all_paths():
    rng = np.random.default_rng(6)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    start, move, emit = norm(rng.random(2)), norm(rng.random((2, 2))), norm(rng.random((2, hidden_markov.CLASSES)))
    model = hidden_markov.Model(start, move, emit)
    sequences = [np.array([3, 1, 4, 1]), np.array([5]), np.array([2, 6, 1])]
    for places, lengths, grid in hidden_markov.padded(sequences):
        logs = hidden_markov.forward(model, lengths, grid)
        s, m, e, total = hidden_markov.expected_counts(model, lengths, grid)
        all_start, all_move = np.zeros(2), np.zeros((2, 2))
        for at, log in zip(places, logs):
            seq, weights = sequences[at], {}
            for code in range(2 ** len(seq)):
                path = [(code >> i) & 1 for i in range(len(seq))]
                p = start[path[0]] * emit[path[0], seq[0]]
                for a, b, c in zip(path, path[1:], seq[1:]):
                    p *= move[a, b] * emit[b, c]
                weights[tuple(path)] = p
            whole = sum(weights.values())
            assert np.log(whole) == pytest.approx(log)
            for path, p in weights.items():
                all_start[path[0]] += p / whole
                for a, b in zip(path, path[1:]):
                    all_move[a, b] += p / whole
        assert s == pytest.approx(all_start) and m == pytest.approx(all_move)
        assert e.sum() == pytest.approx(sum(map(len, sequences))) and total == pytest.approx(logs.sum())


# ---- toxicity


@pytest.fixture(scope="module")
def marked(spark):
    rng = np.random.default_rng(8)
    plain = [f"word{i}" for i in range(200)]
    texts = []
    for i in range(900):
        words = rng.choice(plain, 40).tolist()
        if i % 6 == 0:
            words[3:3] = [f"nasty{rng.integers(5)}", "vilest"]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0), "x") for i in range(0, 900, 2)] + [(None, 1, 1, "x"), (4, 0, None, "x"), (6, 0, 1, "x")], "doc_id long, quality int, toxic int, text string")
    return docs, labels


def test_toxicity_on_held_out_rows(spark, marked, odd):
    docs, labels = marked
    out = pu_toxicity.scored(docs.unionByName(odd.withColumn("doc_id", odd.doc_id + 5000)), labels).collect()
    for r in out:
        assert r.held_out == held(r.doc_id, 3, 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    test = [r for r in out if r.held_out and r.doc_id < 900]
    assert all(r.predicted == int(r.doc_id % 6 == 0) for r in test)
    clean = pu_toxicity.clean_documents(docs, labels)
    assert clean.columns == docs.columns and clean.where("doc_id % 6 <> 0").count() == 750


def test_labels_of_held_out_rows_are_never_used(spark, marked):
    docs, labels = marked
    changed = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    scores = lambda l: sorted((r.doc_id, r.score) for r in pu_toxicity.scored(docs, l).collect())  # noqa: E731, E741
    assert scores(labels) == scores(changed)


def test_training_rows_are_bounded_whatever_repeats(spark, monkeypatch):
    """One id, and one whole row, on a third of the table each: the sample keeps its bounds."""
    monkeypatch.setattr(pu_toxicity, "MAX_POSITIVE", 20)
    monkeypatch.setattr(pu_toxicity, "MAX_UNLABELLED", 50)
    seen = []
    real = pu_toxicity.selected
    monkeypatch.setattr(pu_toxicity, "selected", lambda f: (seen.append(f.groupBy("kind").count().collect()), real(f))[1])
    texts = [(i, f"plain words number {i} here") for i in range(300)] + [(5, f"other text {i} of one id") for i in range(300)] + [(8, "same row")] * 300
    docs = spark.createDataFrame([(*t, "en", "s", 1, None, None, None) for t in texts], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0 or i in (5, 8))) for i in range(300)], "doc_id long, quality int, toxic int")
    pu_toxicity.fit(docs, labels)
    assert {r["kind"]: r["count"] for r in seen[0]} == {1: 20, 0: 50}


def test_mixture_of_repeated_and_missing_ids(spark, monkeypatch):
    """Rows with one id or none: ranges stay even, and the texts hold exactly the words that the mix takes."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    texts = [(None if i % 3 else 7, " ".join([f"w{i}"] * 10), "a") for i in range(600)] + [(i, "u v " * 50, "b") for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t), None, None, None) for i, t, s in texts], SCHEMA)
    ranges = [r["count"] for r in mixing._placed(docs).where("source = 'a'").groupBy("range").count().collect()]
    assert max(ranges) <= 2 * 50
    taken = {r["source"]: r["t"] for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    words = {r["source"]: r["t"] for r in mixing.mixed_texts(docs).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("t")).collect()}
    assert taken["a"] == words["a"] and abs(words["b"] - taken["b"]) <= 100


def test_risk_is_non_negative():
    positive = np.array([True, True, False, False, False])
    z = np.array([-5.0, -4.0, -1.0, -1.0, -1.0])  # the corrected negative risk is above zero
    g = pu_toxicity.pu_gradient(z, positive, 0.4)
    assert g[positive].sum() < 0 < g[~positive].sum()
    z = np.array([9.0, 9.0, -9.0, -9.0, -9.0])  # the corrected negative risk is below zero: pushed up
    g = pu_toxicity.pu_gradient(z, positive, 0.9)
    assert (g[positive] > 0).all() and (g[~positive] < 0).all()


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert near_dedup.with_components(empty).count() == 0
    assert secret_links.scan(empty).count() == 0 and secret_links.redacted(empty).count() == 0
    assert host_rules.judged(empty).count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed_texts(empty).count() == 0
    assert hidden_markov.scored(empty).count() == 0
    assert pu_toxicity.scored(empty, labels).count() == 0
    assert sentence_wfst.encoded(empty, model_path()).count() == 0
