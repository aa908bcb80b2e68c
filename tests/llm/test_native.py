"""Quality rules, secret scans, mixing and URL filters on awkward rows, against plain Python."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, quality, secret_scan, urls

SPACE = " \t\n\x0b\f\r"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_measures(docs):
    for r in quality.judge(docs).collect():
        w, text = words_of(r["text"]), r["text"] or ""
        grams = defaultdict(list)
        for i in range(len(w) - 4):
            grams[tuple(w[i : i + 5])].append(i)
        covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
        lines = [x for x in text.split("\n") if x.strip(SPACE)]
        assert r["n_words"] == len(w)
        assert r["word_chars"] == sum(map(len, w))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])
    kept = {r["doc_id"] for r in quality.judge(docs).filter("kept").collect()}
    assert {1, 2, None} <= kept and not kept & {3, 4, 5, 10, 11, 12}


def entropy(run, width):
    best = 0.0
    for i in range(len(run) - width + 1):
        n = Counter(run[i : i + width])
        best = max(best, -sum(c / width * math.log2(c / width) for c in n.values()))
    return best


def test_window_entropy(spark):
    runs = ["a1" * 30, "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda", "Zz9/+_=-Zz9/+_=-Zz9/+_=-abc", "x" * 20]
    df = spark.createDataFrame([(r,) for r in runs], "r string")
    for r in df.select("r", secret_scan.max_window_entropy(F.col("r")).alias("h")).collect():
        assert r["h"] == pytest.approx(entropy(r["r"], 20), abs=1e-9)


def test_secrets(spark, docs):
    got = {r["doc_id"]: r["x"] for r in secret_scan.scan(docs).select("doc_id", secret_scan.spans_text(F.col("spans")).alias("x")).collect()}
    text = docs.filter("doc_id = 9").first()["text"]
    hexa = text.index("0123")
    assert got[9] == f"assign:0:{len('password = ') + 17},access:{text.index('AKIA')}:{text.index('AKIA') + 20},hex:{hexa}:{hexa + 17}"
    assert all(v == "" for k, v in got.items() if k != 9)
    # an astral character is one code point; a failing match still uses up its text
    odd = "😀 secret=\"token\" = \"abcdefghijklmnop\" key aB3dE5fG7hI9jK1lM3nO5pQ7r end 123e4567-e89b-12d3-a456-426614174000"
    df = spark.createDataFrame([(1, odd)], "doc_id long, text string")
    row = secret_scan.scan(df).select(secret_scan.spans_text(F.col("spans")).alias("x")).first()["x"]
    assert row == f"entropy:{odd.index('aB3')}:{odd.index('aB3') + 25}"


def queue_mix(rows, weights=(1, 2, 3)):
    """The mix, one queue entry at a time."""
    import hashlib

    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, x, n in rows if x == s) for s in names}
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(size.values()), {}, set(names)
    while True:
        left = total - sum(target.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 3 * size[s]}
        if not over:
            target |= share
            break
        target |= {s: 3 * size[s] for s in over}
        open_ -= over
        if not open_:
            break
    entries = []
    for s in names:
        at = 0
        for turn in range(3):
            key = lambda d, t=turn: hashlib.md5(f"{'' if d is None else d}:{t}".encode()).hexdigest() + str("" if d is None else d)
            queue = defaultdict(int)
            for d, x, n in rows:
                if x == s and n:
                    queue[key(d), d] += n
            for (_, d), n in sorted(queue.items(), key=lambda e: e[0][0]):
                at += n
                entries.append((at / target[s], s, d, n))
    taken, run = Counter(), 0
    ends = sorted({e[0] for e in entries})
    by = defaultdict(list)
    for e in entries:
        by[e[0]].append(e)
    for f in ends:
        run += sum(e[3] for e in by[f])
        if run > total:
            break
        for _, s, d, _ in by[f]:
            taken[d, s] += 1
    return target, taken


def test_mix_is_the_queue(spark):
    rows = [(i if i != 5 else None, ["a", "b", "é", None][i % 4 if i < 60 else 0], (i * 37) % 50) for i in range(200)]
    rows += [(7, "é", 12), (7, "é", 12)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("taken", F.lit("mine"))
    target, taken = queue_mix(rows)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["size"] * (taken[r["doc_id"], r["source"]] if r["size"] else 0)
        assert r["taken"] <= 3 * r["size"]
    small = mixing.last_taken  # many buckets give the same cut as one
    sized = df.select("doc_id", "source", "size")
    t = mixing.source_targets(sized)
    assert sorted(map(str, small(sized, t, 4).collect())) == sorted(map(str, small(sized, t, 10**6).collect()))


def test_mix_meets_targets_without_ids(spark):
    """A third of the ids null, some repeated: told apart by text, every source comes within its largest document."""
    rows = [(None if i % 3 == 0 else i // 2, ["a", "b", "c"][min(i % 7, 2)], 1 + i * 37 % 50, f"t{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, digest string")
    by = mixing.mix(df, digest="digest").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    for r in by.collect():
        assert abs(r["taken"] - r["target"]) <= 2 * 50, r
    pages = spark.createDataFrame([(None, "a", 5, None)] * 3, "doc_id long, source string, size long, digest string")
    assert [r["taken"] for r in mixing.mix(pages, digest="digest").collect()] == [5, 5, 5]


def test_mix_of_nothing(spark, no_docs):
    sized = no_docs.withColumn("size", F.lit(0).cast("long"))
    assert mixing.mix(sized).count() == 0
    zero = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [r["taken"] for r in mixing.mix(zero).collect()] == [0, 0]


def test_urls(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://A.Example.com/en/x?q=/fr/"),
            (2, "https://www.example.com/en/"),
            (3, "https://x.www.example.com/en/y#z"),
            (4, "ftp://notexample.com/en/"),
            (5, "http://net/es/1"),
            (6, "http://a.net/esp"),
            (7, None),
            (8, "no address"),
            (9, "http://b.net/fr/"),
            (9, "http://b.net/fr/"),
            (10, "http://com"),
            (11, "http://pre.net/ab/cd"),
        ],
        "page_id long, url string",
    ).withColumn("verdict", F.lit("mine"))
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"), ("block", "pre.net", "/ab/c"), ("block", None, None)]
    rules = spark.createDataFrame(rules, "action string, host string, path string")
    got = {(r["page_id"], r["rule"], r["verdict"]) for r in urls.judge(pages, rules).collect()}
    assert got == {
        (1, "example.com/en/", "block"), (2, "www.example.com/en/", "allow"), (3, "www.example.com/en/", "allow"),
        (4, "com/", "allow"), (5, "net/es/", "block"), (6, None, "allow"), (7, None, "allow"), (8, None, "allow"),
        (9, "net/fr/", "block"), (10, None, "allow"), (11, "pre.net/ab/c", "block"),
    }
    assert urls.judge(pages, rules).count() == 12
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert urls.judge(pages, rules.limit(0)).filter("verdict <> 'allow'").count() == 0


def test_urls_of_any_length(spark):
    """Ten thousand labels and a hundred thousand slashes; rules deep and shallow; against plain Python."""
    far = "/".join(f"d{i}" for i in range(100_000))
    rows = [(1, f"http://x.net/{far}"), (2, "http://" + "a." * 10_000 + "com/" + "/" * 100_000), (3, "http://..com//"),
            (4, f"http://x.net/{far[:700]}"), (5, None), (6, "http:///x"), (7, "http://a.com//b"), (8, "http://a.com/?//b")]
    rules = [("block", "net", "/" + "/".join(f"d{i}" for i in range(50)) + "/d5"), ("block", "com", "//"), ("allow", "a.a.com", ""),
             ("allow", "net", "/"), ("block", "..com", "/"), ("block", "", "/x")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    out = urls.judge(df, spark.createDataFrame(rules, "action string, host string, path string"), default="none").collect()
    assert len(out) == len(rows)
    for r in out:
        fits = [
            (len(h + p), len(h), a == "block", h + p, a)
            for a, h, p in rules
            if h and (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)
        ]
        assert (r["rule"], r["verdict"]) == (max(fits)[3:] if fits else (None, "none")), r["page_id"]


def test_empty_tables(no_docs):
    assert quality.judge(no_docs).count() == 0
    assert secret_scan.scan(no_docs).count() == 0


def test_native_plans_have_no_python(docs):
    for df in (quality.judge(docs), secret_scan.scan(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
