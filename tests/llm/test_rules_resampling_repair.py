"""URL rules, importance resampling and conversation repair against brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from listlake.llm import repair, resample, urls
from listlake.llm.common import saved, table, utf8
from listlake.llm.queries import ORACLE, QUERIES
from pyspark.sql import functions as F

from compare import connect, differences


@pytest.mark.parametrize("name", ["op11_url_rules", "op12_importance_resampling", "op13_conversation_repair"])
def test_query_equals_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLE[name]) is None


def test_sql_crc32(sf):
    from listlake.llm.queries import CRC_TABLE, crc32_sql

    for text in ("", "a", "12:3", "é漢", "x" * 300):
        got = connect(sf).execute(f"SELECT {crc32_sql('t')} FROM (SELECT '{text}' AS t), ({CRC_TABLE})").fetchall()[0][0]
        assert got == zlib.crc32(text.encode())


def partition_sizes(df):
    """Rows of each partition, small ones not being joined for once."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    df.sparkSession.conf.set(name, "false")
    try:
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        df.sparkSession.conf.set(name, "true")


# --------------------------------------------------------------------------------- URL rules

PAGES = "page_id long, url string, html string, id string, part string, `key` string, rule string"


def pages_of(spark, rows):
    return spark.createDataFrame([(k, u, None, "x", "x", "x", "x") for k, u in rows], PAGES)


def slow_verdict(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if r[0] and host and (host == r[0].lower() or host.endswith("." + r[0].lower())) and path.startswith(r[1] or "")]
    if not fits:
        return host, path, None, default
    h, p, v = max(fits, key=lambda r: (len(r[0]) + len(r[1] or ""), len(r[0]), r[2] == "block"))
    return host, path, h.lower() + (p or ""), v


def check_rules(spark, rows, rules, default="allow", **kw):
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = Counter(tuple(r) for r in urls.judge(pages_of(spark, rows), given, default=default, **kw).collect())
    assert got == Counter((k, *slow_verdict(u, rules, default)) for k, u in rows)


def test_rules_equal_brute_force_on_nested_and_hot_hosts(spark):
    rng = random.Random(5)
    labels = ["a", "b", "c", "aa", "a-b", "x" * 60, "é", ""]
    host = lambda n: ".".join(rng.choice(labels) for _ in range(n))
    path = lambda: "".join(rng.choice(["/", "/en", "/en/", "x", "é", "%2F"]) for _ in range(rng.randint(0, 4)))
    rules = [(host(rng.randint(1, 4)), rng.choice([path(), path(), None]), rng.choice(["allow", "block"])) for _ in range(300)]
    rows = [(i, f"http://{host(rng.randint(1, 6))}{path()}{rng.choice(['', '?a=/b', '#/en/', '?x#y'])}") for i in range(3000)]
    rows += [(10_000 + i % 700, "https://A.b.C/EN/en/") for i in range(1500)]
    check_rules(spark, rows, rules, range_rows=100)
    check_rules(spark, rows[::7], rules, default="block", range_rows=1)


def test_rules_on_awkward_urls(spark):
    long = "a." * 300 + "b"
    rows = [
        (1, None), (2, ""), (3, "no scheme/x"), (4, "://"), (5, "a://b://c/d"), (6, f"http://{long}/p"), (7, f"http://z.{long}/p?q"), (7, f"http://z.{long}/p?q"),
        (None, "http://b/"), (None, None), (8, "http://b"), (9, "http://b/\n/x"), (10, "http://.b/"), (11, "http://b./"), (12, "http://B:80/"), (13, "http://u@b/"),
        (14, "http://a.b/" + "y" * 200_000), (15, "http://" + "h" * 100_000 + "/"), (16, "x://b?/y"), (17, "x://ab/"),
    ]
    rules = [("b", "/", "block"), (long, "/p", "allow"), (long[2:], None, "block"), ("", "/", "block"), (None, "/", "block"), ("b", "/", "allow"), ("h" * 100_000, "/", "block"), ("h" * 300, "", "block")]
    check_rules(spark, rows, rules)
    check_rules(spark, rows * 20, rules, range_rows=3)


def test_rules_on_empty_tables(spark):
    check_rules(spark, [(1, "http://a/")], [])
    check_rules(spark, [], [("a", "/", "block")])
    check_rules(spark, [(1, None)], [("a", "/", "block")])


def test_hot_host_fills_many_ranges(spark):
    rows = spark.range(40_000).select(F.col("id").alias("page_id"), F.lit("http://hot.org/fr/x").alias("url"))
    rules = spark.createDataFrame([("org", "/fr/", "block")], "host string, path string, verdict string")
    judged = urls.judge(rows, rules, range_rows=2000)
    sizes = partition_sizes(judged)
    assert judged.filter("verdict = 'block' and rule = 'org/fr/'").count() == 40_000
    assert max(sizes) < 12_000


# ------------------------------------------------------------------------------- resampling

DOCS = "doc_id long, text string, lang string, id long, place string, segment string, `rank` string, weight string"


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, None, 0, "x", "x", "x", "x") for k, t in rows], DOCS)


def slow_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def slow_resample(rows, target, percent=10, least=20, longest=1, seed=2024):
    docs = [(k, *slow_features(t, longest)) for k, t in rows]
    s, t = Counter(b for _, _, f in docs for b in f), Counter(b for x in target for b in slow_features(x, longest)[1])
    all_s, all_t = float(s.total() + 10_000), float(t.total() + 10_000)
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t))) for b in s}
    out = []
    for k, n, f in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([k, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in out)


def check_resample(spark, rows, target, **kw):
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(docs_of(spark, rows), goal, **{"least_words" if k == "least" else k: v for k, v in kw.items() if k != "parts"})
    assert Counter(tuple(r) for r in got.collect()) == slow_resample(rows, target, **{k: v for k, v in kw.items() if k != "segment_rows"})


def test_draw_equals_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)] + ["É", "漢字", "a_b", "x" * 300]
    rows = [(rng.randint(0, 500), " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for _ in range(1500)]
    rows += [(None, t) for _, t in rows[:30]] + [(7, rows[3][1])] * 900 + [(i, rows[5][1]) for i in range(600, 900)]
    target = [" ".join(words[:50]), None, ""]
    check_resample(spark, rows, target, segment_rows=40)
    check_resample(spark, rows, target, percent=100, least=1, longest=3, segment_rows=1000)
    check_resample(spark, rows, target, percent=0, seed=5)


def test_draw_on_awkward_and_empty_tables(spark):
    rows = [(1, None), (2, ""), (3, "Abc\x00d " * 30), (None, None), (4, "one"), (4, "one"), (5, "q " * 200_000), (6, "z" * 300_000), (-7, "É {x} ~ 0" * 10)]
    check_resample(spark, rows, ["one q"], least=0, percent=50)
    check_resample(spark, rows, [], least=1, percent=100)
    check_resample(spark, [], ["one"])
    check_resample(spark, [(1, "a")], [None], percent=100, least=5)


def test_features_of_sliced_columns():
    texts = ["ab c", None, "D-e f", "é"]
    n, row, bucket = resample.features(*utf8(pa.array(["zz", *texts], pa.string()).slice(1)), 2)
    want = [slow_features(t, 2) for t in texts]
    assert n.tolist() == [w for w, _ in want]
    assert [sorted(bucket[row == i].tolist()) for i in range(4)] == [sorted(f) for _, f in want]


def test_equal_rows_are_split(spark):
    """A third of all rows with one key and text fall into several segments."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("id"), F.lit(25).cast("long").alias("n_words"),
        F.lit(25).cast("long").alias("n_features"), F.lit(0).cast("long").alias("weight"), F.pmod(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")), F.lit(50)).alias("score"))
    rows = rows.sortWithinPartitions(F.desc("score"), "id", "n_features")
    runs = saved(rows.withColumn("place", F.monotonically_increasing_id()), "runs")
    out = resample.ranked(runs, 30_000, segment_rows=1000)
    sizes = partition_sizes(out)
    assert sorted(r["rank"] for r in out.select("rank").collect()) == list(range(1, 30_001))
    assert max(sizes) < 9_000


def test_runs_draw_alike(spark, sf):
    draw = lambda: Counter(map(tuple, QUERIES["op12_importance_resampling"](spark, sf).collect()))
    assert draw() == draw()


# ----------------------------------------------------------------------------------- repair

ROWS = "conv_id long, turn long, role string, text string, present string, copy int, fault string, audit string"


def talks_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x", "x") for r in rows], ROWS)


def slow_audit(rows):
    """Cheapest edits of rows ``(role, text, fault)`` by trying all, the least audit first."""
    best = None
    for kinds in itertools.product(["D", "K", "Ru", "Ra"], repeat=len(rows)):
        if any(f in "bd" and k != "D" for k, (_, _, f) in zip(kinds, rows, strict=True) if f):
            continue
        cost = sum({"D": 2, "K": 0}.get(k, 1) + (5 if k != "D" and f == "t" else 0) for k, (_, _, f) in zip(kinds, rows, strict=True))
        for inserts in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(len(rows) + 1), n) for n in range(3)):
            for roles in itertools.product("ua", repeat=len(inserts)):
                edits = []
                for i in range(len(rows) + 1):
                    edits += [("I", r, "") for at, r in zip(inserts, roles, strict=True) if at == i]
                    if i < len(rows):
                        edits.append((kinds[i], *rows[i][:2]))
                kept = [(r if k == "K" else {"u": "user", "a": "assistant"}[k[1] if k[0] == "R" else r], t) for k, r, t in edits if k != "D"]
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in kept)):
                    found = (cost + 5 * len(inserts), "".join(k[0] for k, *_ in edits), kept)
                    best = found if best is None or found[:2] < best[:2] else best
    return best


def slow_repair(rows):
    show = lambda x: " " if x is None else str(x)
    convs = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        case = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        said = "" if case == 1 else re.sub("[.!?]", "", show(text)) if case == 2 else show(text)
        convs[conv] += [(turn, "user" if case == 4 else show(role), said)] * (0 if case == 0 else 2 if case == 3 else 1)
    out = set()
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in found:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, *_ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, kept = slow_audit(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.add((conv, gaps, *(sum(f == x for *_, f in marked) for x in "bdt"), illegal, cost, audit, digest))
    return out


def test_repair_equals_brute_force(spark):
    rng = random.Random(11)
    said = ["Yes.", "No", "Why?", "", " \n", "Yes.", "go!\x0b ", "…", "é"]
    rows = []
    for conv in range(260):
        for turn in range(rng.randint(1, 4)):
            rows.append((conv, rng.choice([turn, turn, turn, 3 * turn, None]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), rng.choice([*said, None])))
    rows += [(None, t, "user", "Hi.") for t in (0, 1)] + [(500, 0, None, None)]
    got = {tuple(r) for r in repair.repair(repair.damage(talks_of(spark, rows))).collect()}
    assert got == slow_repair(rows)


def test_repaired_rows_have_the_hash(spark, sf):
    damaged = saved(repair.damage(table(spark, sf, "conversations")), "damaged")
    said = {}
    for r in sorted(repair.repaired_rows(damaged).collect(), key=lambda r: (r["conv_id"], r["place"])):
        said.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in repair.repair(damaged).collect():
        assert r["repaired_sha256"] == hashlib.sha256("\n".join(said.get(r["conv_id"], [])).encode()).hexdigest()
        roles = "".join(x[0] for x in said.get(r["conv_id"], []))
        assert re.fullmatch("(s?(ua)+)?", roles)


def test_repair_of_nothing_and_of_a_long_conversation(spark):
    assert repair.repair(repair.damage(talks_of(spark, []))).collect() == []
    rows = spark.range(30_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('Line ', id, '.') AS text")
    (r,) = repair.repair(repair.damage(rows)).collect()
    assert len(r["audit"]) >= 28_000 and r["illegal"] > 0 and r["duplicate"] > 0


def test_endings_are_shared():
    rng = random.Random(2)
    endings = sorted({"".join(rng.choice("uaUAsox") for _ in range(rng.randint(0, 9))) for _ in range(5000)})
    one = repair.Automaton()
    found = [one.read(e) for e in endings]
    assert one.nodes == len({e[:i] for e in endings for i in range(1, len(e) + 1)})
    assert found == [repair.Automaton().read(e) for e in endings]


def test_order_keys_compare_as_the_order():
    rows = [(3, None, 1, 5), (3, 2, 1, 4), (-3, 0, 0, 0), (3, -2, 9, 1), (4, 9, 9, 9), (3, 2, 1, 3), (3, 2, 0, 8)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], list(resample.ORDER))
    want = sorted(range(len(rows)), key=lambda i: (-rows[i][0], rows[i][1] is None, rows[i][1] or 0, *rows[i][2:]))
    assert np.argsort(resample._order_keys(batch), kind="stable").tolist() == want
