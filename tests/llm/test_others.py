"""PII, URLs, vectors and the pipeline against brute force."""

from __future__ import annotations

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import feistel_pii, mixing, near_dedup, pivot_search, url_filter

# ---- pseudonyms


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def with_check(payload: str) -> str:
    return next(payload + str(c) for c in range(10) if luhn(payload + str(c)))


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


@pytest.fixture(scope="module")
def pseudonyms(spark):
    def run(texts, key="k"):
        docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, finds2 string")
        out = feistel_pii.pseudonymised(docs, key).orderBy("doc_id").collect()
        return [r.text for r in out], [r.finds for r in out]

    return run


def test_each_format_is_kept_and_valid(pseudonyms):
    card = with_check("411111111111111")
    iban = next(f"DE{c:02d}370400440532013000" for c in range(2, 99) if mod97(f"DE{c:02d}370400440532013000") == 1)
    texts = [
        f"a {card} b", f"a {card[:4]}-{card[4:8]}-{card[8:12]}-{card[12:]} b", f"x {iban}.", "ip 10.20.30.40, ok", "on 2024-02-29 and 31.01.1999", "call +1 (437) 555-0689 now",
        "ssn 123-45-6789!", "mail jo.81@mail7.example.com.", "none here", None, "",
    ]
    out, finds = pseudonyms(texts)
    assert finds == [["card"], ["card"], ["iban"], ["ip"], ["date", "date"], ["phone"], ["ssn"], ["mail"], [], [], []]
    one, two = re.fullmatch(r"a ([0-9]{16}) b", out[0])[1], re.fullmatch(r"a ((?:[0-9]{4}-){3}[0-9]{4}) b", out[1])[1]
    assert luhn(one) and one == two.replace("-", "") and one != card
    new = re.fullmatch(r"x (DE[0-9]{20})\.", out[2])[1]
    assert mod97(new) == 1 and new != iban
    assert all(0 <= int(p) < 256 for p in re.fullmatch(r"ip ([0-9.]+), ok", out[3])[1].split("."))
    a, b = re.fullmatch(r"on ([0-9-]{10}) and ([0-9.]{10})", out[4]).groups()
    assert dt.date.fromisoformat(a) and dt.datetime.strptime(b, "%d.%m.%Y")
    assert re.fullmatch(r"call \+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4} now", out[5]) and out[5] != texts[5]
    assert re.fullmatch(r"ssn (?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}!", out[6])
    assert re.fullmatch(r"mail [a-z]{2}\.[0-9]{2}@mail7\.example\.com\.", out[7])
    assert out[8:] == texts[8:]


def test_equal_values_stay_linked_and_others_differ(pseudonyms):
    cards = [with_check(f"4{i:014d}") for i in range(60)]
    days = [(dt.date(1990, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(300)]
    first, _ = pseudonyms([" ".join(cards), " ".join(days), " ".join(reversed(cards)), "day " + days[5]])
    assert len(set(first[0].split())) == 60 and first[2].split() == first[0].split()[::-1]
    assert len(set(first[1].split())) == 300 and first[3] == "day " + first[1].split()[5]
    other, _ = pseudonyms([" ".join(cards)], key="another")
    assert not set(other[0].split()) & set(first[0].split())


def iban_of(country: str, account: str) -> str:
    return next(f"{country}{c:02d}{account}" for c in range(2, 99) if mod97(f"{country}{c:02d}{account}") == 1)


def grouped(value: str, sizes, sep=" ") -> str:
    parts, at = [], 0
    for size in sizes:
        parts.append(value[at : at + size])
        at += size
    return sep.join(parts)


def test_cards_in_every_grouping(pseudonyms):
    shapes = [(4, 6, 4), (4, 4, 4, 4, 3), (4, 4, 4, 4, 1), (4, 3, 3, 3), (4, 5, 6), (6, 13), (4, 4, 5), (4, 6, 5), (4, 4, 4, 4), (8, 8), (5, 5, 5), (2, 12)]
    cards = [with_check(f"{40 + i}{'73052189463051274'[: sum(s) - 3]}") for i, s in enumerate(shapes)]
    plain, _ = pseudonyms(cards)
    texts = [grouped(c, s, sep) for sep in " -" for c, s in zip(cards, shapes)]
    out, finds = pseudonyms(["at " + t + ", ok" for t in texts] + ["3056 930902 5904"])
    assert finds == [["card"]] * (len(texts) + 1)
    assert out[:-1] == ["at " + grouped(p, s, sep) + ", ok" for sep in " -" for p, s in zip(plain, shapes)]


def test_neighbours_of_cards_stay_apart(pseudonyms):
    four, long, diners = with_check("411111111111111"), with_check("623456789012345678"), with_check("3056930902590")
    cvc = next(c for c in range(100, 999) if not luhn(four + str(c)))
    fours = grouped(four, (4, 4, 4, 4))
    texts = [
        f"{fours} {cvc}", f"12 {fours} {fours}", f"{grouped(long, (4, 4, 4, 4, 3))} {grouped(long, (4, 4, 4, 4, 3))} {grouped(diners, (4, 6, 4))}",
        f"{fours} 123-45-6789", f"{fours} 234-567-8901", f"{fours} 31.01.1999", f"55 {four} 2024-01-31", "5 2024-01-31 123-45-6789", "1234567 7654321@x.org",
    ]
    out, finds = pseudonyms(texts)
    assert finds == [["card"], ["card"] * 2, ["card"] * 3, ["card", "ssn"], ["card", "phone"], ["card", "date"], ["card", "date"], ["date", "ssn"], ["mail"]]
    assert out[0].endswith(f" {cvc}") and out[1].startswith("12 ") and luhn(re.sub(" ", "", out[0])[:16]) and fours not in out[0]


def test_national_telephone_numbers(pseudonyms):
    texts = ["+1 (234) 567-8901", "(234) 567-8901", "(234)567-8901", "234-567-8901", "234.567.8901", "234 567 8901", "1-234-567-8901"]
    out, finds = pseudonyms(["call " + t + "." for t in texts] + ["x234-567-8901", "234-567-89012"])
    assert finds == [["phone"]] * len(texts) + [[], []]
    assert len({re.sub("[^0-9]", "", t)[-10:] for t in out[:-2]}) == 1 and out[1] != "call (234) 567-8901."


def test_ibans_with_letters_in_the_last_group(pseudonyms):
    maltese, belgian = iban_of("MT", "MALT011000012345MTLCAST001S"), iban_of("BE", "539007547034")
    spaced = grouped(maltese, (4, 4, 4, 4, 4, 4, 4, 3))
    short = grouped(belgian, (4,) * 4)
    out, finds = pseudonyms([spaced, maltese, f"{short} IS mine", f"{short} 2024-01-31"])
    assert finds == [["iban"], ["iban"], ["iban"], ["iban", "date"]]
    assert out[0].replace(" ", "") == out[1] != maltese and mod97(out[1]) == 1
    assert out[2].endswith(" IS mine") and mod97(out[2][:19].replace(" ", "")) == 1 and short not in out[2]


def test_what_does_not_validate_stays(pseudonyms):
    texts = ["4111111111111112", "300.1.2.3", "2023-02-30", "1899-12-31", "000-12-3456", "DE00370400440532013000", "x4111111111111111", "9" * 25]
    out, finds = pseudonyms(texts)
    assert out == texts and not any(finds)


def test_very_long_values(pseudonyms):
    texts = ["m ab@" + "c." * 100_000 + "org", "a." * 100_000 + "@x.org", "1-" * 100_000, "DE00" + " ABCD" * 50_000]
    out, finds = pseudonyms(texts)
    assert finds == [["mail"], ["mail"], [], []]
    assert out[0].endswith(texts[0][4:]) and len(out[1]) == len(texts[1]) and out[2:] == texts[2:]


def test_a_column_finds_gives_way_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "old", "write ab@c.org"), (2, None, None)], "doc_id long, finds string, text string")
    out = feistel_pii.pseudonymised(docs, "k")
    assert out.columns == ["doc_id", "text", "finds"]
    assert [r.finds for r in out.orderBy("doc_id").collect()] == [["mail"], []]
    assert feistel_pii.pseudonymised(docs.limit(0), "k").count() == 0


def test_mixed_texts_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, "a", "one two", "kept", i) for i in range(6)], "doc_id long, source string, text string, size string, pos long")
    out = mixing.mixed_texts(docs)
    assert out.columns == docs.columns and out.count() == 6
    assert all(r["size"] == "kept" and r["pos"] == r["doc_id"] for r in out.collect())
    assert mixing.mixed_texts(docs.limit(0)).count() == 0


def test_days_are_permuted_exactly(spark):
    days = spark.range(73049).selectExpr("id AS doc_id", "CAST(date_add(DATE'1900-01-01', CAST(id AS INT)) AS STRING) AS text")
    out = feistel_pii.pseudonymised(days, "k")
    assert out.select("text").distinct().count() == 73049
    low, high = out.selectExpr("min(text)", "max(text)").first()
    assert (low, high) == ("1900-01-01", "2099-12-31")


# ---- URLs


URLS = [
    "http://A.Example.org/es/1", "https://example.org/en/19?x", "https://x.org", "https://x.org/", "ftp://y.com/fr/2#t", "https://y.com/de/", "https://y.com/en/", "//no", None, "",
    "https://com/de/x", "https://notexample.org/es/", "https://z.net?a/b://c", "h://host#f/x", "https://xcom/de/",
]


def naive_url(url):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_rules_and_model(spark):
    more = [f"https://h{i}.org/en/{i}" for i in range(60)] + [f"https://h{i}.com/de/{i}" for i in range(60)] + [f"https://k{i}.net/de/{i}" for i in range(20)]
    urls = URLS + more
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, URLS[0], None, None)], "page_id long, url string, host string, cells string")
    out = url_filter.filtered(pages).collect()
    assert len(out) == len(urls) + 1
    for r in out:
        if r.page_id is not None:
            host, path, rule, verdict = naive_url(urls[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
            assert r.verdict == (verdict or ("allow" if r.model_score >= 0 else "block"))
    learnt = [r.verdict for r in out if r.page_id is not None and r.page_id >= len(URLS) + 120]
    assert learnt.count("block") > len(learnt) / 2  # /de/ was mostly blocked


def test_training_ends_at_the_least_loss(spark, monkeypatch):
    """The weights equal those of plain numpy gradient descent run to the end."""
    monkeypatch.setattr(url_filter, "CELLS", 64)
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(120):
        cells = sorted({int(c) for c in rng.integers(1, 65, 9)})
        rows.append((cells, float(sum(cells) / len(cells) + rng.normal(0, 4) > 32)))
    labelled = spark.createDataFrame(rows, "cells array<int>, y double")
    monkeypatch.setattr(url_filter, "PENALTY", 1e-2)
    weights, bias = url_filter.train(labelled)
    x = np.zeros((len(rows), 65))
    for i, (cells, _) in enumerate(rows):
        x[i, 0] = 1
        x[i, cells] = 1 / np.sqrt(len(cells))
    y, at, penalty = np.array([r[1] for r in rows]), np.zeros(65), np.r_[0, np.full(64, 1e-2)]
    for _ in range(40_000):
        at -= 0.5 * (x.T @ (1 / (1 + np.exp(-x @ at)) - y) / len(y) + penalty * at)
    assert np.abs(np.r_[bias, weights] - at).max() < 0.05
    assert ((x @ np.r_[bias, weights] >= 0) == (x @ at >= 0)).mean() > 0.99


def test_model_agrees_with_the_rules_on_urls_it_has_not_seen(spark, monkeypatch):
    judged = url_filter.ruled(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"))
    part = F.pmod(F.xxhash64(F.lit("split"), "host", "path"), F.lit(10))
    weights, bias = url_filter.train(url_filter.labelled_urls(judged.where(part < 7)).cache())
    held = judged.where((part >= 7) & F.col("rule").isNotNull()).select("host", "path", "verdict").distinct().withColumn("cells", url_filter.cells())
    right = F.avg(((url_filter._score(weights, bias) >= 0) == (F.col("verdict") == "allow")).cast("int"))
    assert held.agg(right).first()[0] >= 0.97


def test_urls_of_any_length_and_clashing_columns(spark):
    long = "https://" + "a" * 40_000 + ".org/en/" + "b" * 100_000
    pages = spark.createDataFrame([(1, long, "x", "y"), (2, "https://b.com/de/", "x", "y")], "page_id long, url string, score string, rule string")
    out = {r.page_id: r for r in url_filter.filtered(pages).collect()}
    assert out[1].rule == "org/" and out[2].verdict == "block" and len(out[1].path) == 100_004


def test_urls_without_any_rule(spark):
    pages = spark.createDataFrame([(1, "https://a.net/x")], "page_id long, url string")
    assert [r.verdict for r in url_filter.filtered(pages).collect()] == ["allow"]
    assert url_filter.filtered(pages.limit(0)).count() == 0


# ---- vectors


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK", 64)
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(0, 0.2, 8).tolist(), "x") for i in range(300)]
    vectors += [(300 + i, vectors[i % 3][1], "x") for i in range(40)]  # ties
    vectors += [(400, None, "x"), (420, [1.0, None] * 4, "x"), (440, [float("nan")] * 8, "x"), (460, [0.5] * 3, "x"), (None, [0.1] * 8, "x"), (480, [], "x"), (461, [0.25] * 3, "x")]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, v string")
    whole = {i: np.floor(64 * np.float32(v).astype(float)).astype(int) for i, v, _ in vectors if i is not None and v and None not in v and np.isfinite(v).all()}
    expected = set()
    for q in whole:
        if q % 20 == 0:
            best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:20]
            expected |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)}
    assert {tuple(r) for r in pivot_search.top_k(table).collect()} == expected
    assert pivot_search.top_k(table.limit(0)).count() == 0


def test_top_k_in_waves_with_repeated_ids(spark, monkeypatch):
    """One id on a third of the rows: blocks stay even, every row is a row of its own, waves are small."""
    monkeypatch.setattr(pivot_search, "BLOCK", 40)
    monkeypatch.setattr(pivot_search, "WAVE_BYTES", 1)
    rng = np.random.default_rng(8)
    vectors = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(200)] + [(40, rng.normal(0, 0.3, 6).tolist()) for _ in range(100)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows = pivot_search.scaled(table)
    sizes = [len(r["ids"]) // 8 for r in pivot_search.packed(rows, 300, *pivot_search.data_pivots(rows)).collect()]
    assert sum(sizes) == 300 and max(sizes) <= 80
    whole = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors]
    expected = []
    for q, x in whole:
        if q % 20 == 0:
            best = sorted((-int(x @ v), i) for i, v in whole if i != q)[:20]
            expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in pivot_search.top_k(table).collect()) == sorted(expected)


def test_earlier_results_rule_out_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    near, far = rng.integers(90, 110, (50, 8)).astype(float), rng.integers(-110, -90, (50, 8)).astype(float)
    p = near[:4]
    table = lambda v: np.sqrt(((v[:, None, :] - p[None]) ** 2).sum(2))
    q, ids = near[:3], np.arange(50)
    first = list(pivot_search.search_block(ids[:3], q, table(q), ids, near, table(near)))
    known = [(found, best) for _, found, best in first]
    sorts = []
    real = np.argsort
    monkeypatch.setattr(pivot_search.np, "argsort", lambda *a, **b: sorts.append(1) or real(*a, **b))
    again = list(pivot_search.search_block(ids[:3], q, table(q), ids + 100, far, table(far), known=known))
    assert not sorts and all((a[1] == b[1]).all() and (a[2] == b[2]).all() for a, b in zip(first, again))


def test_top_k_with_large_components(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK", 32)
    rng = np.random.default_rng(4)
    vectors = [(i, (rng.normal(0, 0.2, 4) * [1, 1e5, 3e6, 1e7][i % 4 if i < 120 else 0]).tolist()) for i in range(200)]
    vectors += [(200, [20000.0, 0.0, 0.0, 0.0]), (201, [20000.0, 1.0, 0.0, 0.0]), (220, [3.5e6, -3.5e6, 1 / 64, 0.0]), (221, [3.5e6, -3.5e6, 2 / 64, 0.0])]
    vectors += [(300, [float("inf"), 0.0, 0.0, 0.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in vectors if i != 300}
    expected = set()
    for q in whole:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:20]
            assert -best[0][0] < 2**63
            expected |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)}
    assert {tuple(r) for r in pivot_search.top_k(table).collect()} == expected


def test_scores_beyond_the_long_range_are_errors(spark):
    def run(*vectors):
        rows = [(20 * i, list(v)) for i, v in enumerate(vectors)]
        return pivot_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()

    for vectors in ([(1e9, 1e9)] * 2, [(1e9, 1e9), (-1e9, -1e9)], [(1e300, 0.0), (0.0, 0.0)]):
        with pytest.raises(Exception, match="long range"):
            run(*vectors)
    assert len(run((1e9, 1e9), (-1e9, -1e9), *[(0.5, -0.5)] * 20)) == 22 * 20


def test_bounds_spare_work():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 40, (20, 16))
    v = np.floor(centres[rng.integers(20, size=2000)] + rng.normal(0, 1, (2000, 16)))
    p = pivot_search.pivots(16)
    table = np.sqrt(((v[:, None, :] - p[None]) ** 2).sum(2))
    bound = ((v[0] @ v[0]) + (v * v).sum(1) - np.abs(table - table[0]).max(1) ** 2) / 2
    assert (bound + 1e-6 >= v @ v[0]).all()


# ---- pipeline


def test_near_duplicate_stage_has_shingles_of_five_words(spark):
    base = [f"w{i}" for i in range(100)]
    scattered, together = base.copy(), base.copy()
    for at in (20, 40, 60, 80):
        scattered[at] = f"n{at}"
    together[50] = "n50"
    texts = {0: " ".join(base), 1: " ".join(scattered), 2: " ".join(together), 3: "a b c", 4: "A  b c", 5: "a b d", 6: "a b c d e", 7: "one", 8: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")

    def kept(width):
        sets = {}
        for i, t in texts.items():
            words = t.lower().split()
            n = min(width, len(words))
            sets[i] = {tuple(words[a : a + n]) for a in range(len(words) - n + 1)} if words else set()
        linked = lambda a, b: sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
        return {i for i in texts if not any(linked(i, j) for j in range(i))}

    assert kept(2) == {0, 3, 5, 6, 7, 8} and kept(5) == {0, 1, 3, 5, 6, 7, 8}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == kept(5)
    assert {r.doc_id for r in near_dedup.kept_documents(docs).collect()} == kept(2)


def test_pipeline_stages(spark, tmp_path):
    sentence = "ab{0} cd{0} ef{0} gh{0} ij{0} kl{0} mn{0} op{0} qr{0} st{0} uv{0} wx{0}"
    texts = {i: sentence.format(i) for i in range(60)}
    texts |= {60: texts[1], 61: texts[2] + " more", 62: "token = " + "a1b2c3d4e5f6a7b8" + " " + sentence.format("s"), 63: None, 64: ""}
    for i in range(100, 140):
        texts[i] = sentence.format(i) + " vilestword"
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 100)) for i in texts], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = {}
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        now = corpus_pipeline.stage(function(spark, now, str(tmp_path)), name)
        seen[name] = {r.doc_id for r in now.collect()}
        assert name == "tokens" or now.columns == docs.columns
    assert seen["toxicity"] == {i for i in texts if i < 100}
    assert seen["near_duplicates"] == seen["toxicity"] - {60, 61}
    assert seen["secrets"] == seen["near_duplicates"]
    final = now.collect()
    assert all("a1b2c3d4e5f6a7b8" not in r.decoded for r in final)
    total = sum(len((texts[i] or "").split()) for i in seen["secrets"])
    assert abs(sum(len(r.decoded.split()) for r in final) - total) < 10
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(final)
