import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import language_id as li

PARTS = {
    "en": "the and ing tion of er th ou wh sh".split(),
    "fr": "le eau eux ç é è que oi ment ier".split(),
    "de": "der sch ung keit ü ö ß und ein pf".split(),
}


def text(rng, lang, n=30):
    return " ".join("".join(rng.choices(PARTS[lang], k=rng.randint(1, 3))) for _ in range(n))


def corpus(n=240, seed=1, wrong=0.1):
    rng = random.Random(seed)
    rows, true = [], {}
    for i in range(n):
        lang = rng.choice(list(PARTS))
        said = rng.choice(list(PARTS)) if rng.random() < wrong else lang
        rows.append((i, text(rng, lang), said, f"{lang}.host{i % 5}.com"))
        true[i] = lang
    return rows, true


def test_held_out_accuracy(documents):
    rows, true = corpus()
    hidden = [(i, t, None if i % 3 == 0 else lang, host) for i, t, lang, host in rows]
    out = li.identify_language(documents(*hidden)).collect()
    right = [r["language"] == true[r["doc_id"]] for r in out if r["doc_id"] % 3 == 0]
    assert sum(right) >= 0.97 * len(right) and all(r["accepted"] for r in out)
    wrong = [r["language"] == true[r["doc_id"]] for r in out]
    assert sum(wrong) >= 0.97 * len(wrong)


def brute(rows, trust=0.9, smoothing=20.0, weight=50.0, unlike=1e-3):
    """The same evidence, row by row."""
    names = sorted({r[2] for r in rows if r[2]})

    def grams(t):
        c = [0 if not (b >= 128 or chr(b).isalpha()) else (b - 96 if b < 128 else b - 101) for b in t.lower().encode()]
        out = []
        for i in range(len(c) - 2):
            code = ((c[i] * 155 + c[i + 1]) * 155 + c[i + 2]) % 2**32
            if code:
                out.append(code * 2654435761 % 2**32 >> 18)
        return out

    count = {x: Counter() for x in names}
    for _, t, said, _ in rows:
        if said:
            count[said].update(grams(t or ""))
    total = {x: sum(count[x].values()) + 0.5 * li.BUCKETS for x in names}
    hosts = defaultdict(Counter)
    for _, _, said, host in rows:
        hosts[host][said] += 1
    every = Counter({x: sum(h[x] for h in hosts.values()) + 1.0 for x in names})
    base = {x: every[x] / sum(every.values()) for x in names}
    n_all = sum(every.values()) - len(names)
    up = {x: (every[x] - 1 + smoothing * base[x]) / (n_all + smoothing) for x in names}
    out = {}
    for i, t, said, host in rows:
        g = grams(t or "")
        n = len(g)
        scale = weight / (n + weight)
        h = sum(hosts[host][x] for x in names)
        logs = {}
        for x in names:
            e = sum(math.log((count[x][b] + 0.5) / total[x]) for b in g) * scale
            if said:
                e += math.log(trust if said == x else (1 - trust) / (len(names) - 1))
            logs[x] = e + math.log((hosts[host][x] + smoothing * up[x]) / (h + smoothing))
        logs[None] = n * scale * math.log(1 / li.BUCKETS) - math.log(len(names)) + math.log(unlike)
        best = max(logs, key=lambda x: logs[x])
        p = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
        ok = n > 0 and best is not None and p >= 0.5
        out[i] = (best if ok else None, p, ok)
    return out


def test_against_brute_force(documents):
    rows, _ = corpus(60, 7, 0.3)
    rows = [*rows, (100, "", "en", "x"), (101, "12 34", None, "x"), (102, "ъйцукен фывапр олджэ " * 5, None, "x"), (103, "zzz", "fr", "y")]
    want = brute(rows)
    got = li.identify_language(documents(*rows)).collect()
    for r in got:
        name, p, ok = want[r["doc_id"]]
        assert (r["language"], r["accepted"]) == (name, ok), r["doc_id"]
        assert r["probability"] == pytest.approx(p, rel=1e-3)
    assert not any(r["accepted"] for r in got if r["doc_id"] in (100, 101, 102))


def test_edges(documents):
    rows, _ = corpus(20)
    docs = documents(*rows, (None, None, None, None), (3, "the and", "en", None), (3, "the and", "en", None), extra=True)
    out = li.identify_language(docs)
    assert out.columns == [*docs.columns, "language", "probability", "accepted"] and out.count() == 23
    assert li.identify_language(docs.limit(0)).collect() == []
    none = li.identify_language(documents((1, "text", None))).collect()
    assert [(r["language"], r["accepted"]) for r in none] == [(None, False)]
    with pytest.raises(ValueError):
        li.identify_language(out)


def test_addresses_and_markup(spark):
    df = spark.createDataFrame(
        [("https://me@A.Example.FR:80/x?y", '<html class="a" LANG="pt-BR">'), ("x", "<p lang=en>"), (None, None)], "url string, html string"
    ).select(
        li.address_host(F.col("url")).alias("h"),
        li.address_suffix(li.address_host(F.col("url"))).alias("s"),
        li.markup_language(F.col("html")).alias("m"),
    )
    assert [tuple(r) for r in df.collect()] == [("a.example.fr", "fr", "pt"), ("", "", None), ("", "", None)]


def test_priors_are_smoothed_from_host_to_suffix_to_all(spark):
    df = spark.createDataFrame([("a.fr", "fr", "fr")] * 8 + [("b.fr", "fr", "en")] * 2 + [("c.com", "com", "en")] * 10, "h string, s string, l string")
    got = {r["host"]: r["prior"] for r in li.host_priors(df, F.col("h"), F.col("s"), F.col("l"), ["en", "fr"], 5.0).collect()}
    base = (13 / 22, 9 / 22)
    fr = tuple((n + 5 * p) / 15 for n, p in zip((2, 8), base))
    assert got["a.fr"] == pytest.approx([(0 + 5 * fr[0]) / 13, (8 + 5 * fr[1]) / 13])
    assert all(sum(p) == pytest.approx(1) for p in got.values())


def test_declarations_count_without_case_and_region(spark, documents):
    rows, _ = corpus(60, 5)
    forms = {"en": ["EN", "en-GB", "en_us", " en"], "fr": ["fr", "FR-ca"], "de": ["de", "De_at"]}
    mixed = [(i, t, forms[x][i % len(forms[x])], h) for i, t, x, h in rows]
    def found(docs, **options):
        out = li.identify_language(docs, **options).collect()
        return {r["doc_id"]: (r["language"], round(r["probability"], 9), r["accepted"]) for r in out}

    want = found(documents(*rows))
    assert found(documents(*mixed)) == want
    assert found(documents(*mixed), languages=["EN-gb", "en", "FR", "de"]) == want
    labels = spark.createDataFrame([("",), (" ",), ("-x",), (None,), ("zh-Hant",)], "l string")
    assert [r[0] for r in labels.select(li.language_label(F.col("l"))).collect()] == [None, None, None, None, "zh"]


def test_many_labels_stop_nothing(documents):
    """Seventy stray labels, one row each, beside three languages."""
    rows, true = corpus(120, 6, 0.0)
    stray = [(1000 + i, text(random.Random(i), "en"), f"x{chr(97 + i // 26)}{chr(97 + i % 26)}", "h") for i in range(70)]
    every = li.identify_language(documents(*rows, *stray)).collect()
    assert len(every) == 190
    assert all(r["language"] == true[r["doc_id"]] for r in every if r["doc_id"] < 1000)
    few = li.identify_language(documents(*rows, *stray), max_languages=3).collect()
    assert {r["language"] for r in few} == {"en", "fr", "de"}
    assert all(r["language"] == "en" for r in few if r["doc_id"] >= 1000)


def test_without_suffixes_all_hosts_share_one(spark):
    df = spark.createDataFrame([("a", "fr")] * 8 + [("b", "en")] * 2 + [("c", None)], "h string, l string")
    def found(suffix):
        rows = li.host_priors(df, F.col("h"), suffix, F.col("l"), ["en", "fr"], 5.0)
        return {r["host"]: [round(x, 12) for x in r["prior"]] for r in rows.collect()}

    assert found(None) == found(F.lit("")) and len(found(None)) == 3
