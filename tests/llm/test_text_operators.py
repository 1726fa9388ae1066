"""The text operators against brute force, round trips and held-out rows, with awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from listlake.llm import chat, decontam, langid, mixing, near_dup, quality, repeats, suffixes, token_store, topk, warc
from listlake.llm.common import fold, fresh_path, runs, saved, table, utf8, words
from listlake.llm.queries import ORACLE, QUERIES, tokenizer_path
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, size string"
WORDS = [a + b for a in "ka lo mi tu re sa no pe vi du".split() for b in "ra le ni so tu ka mo ve".split()]


def prose(rng, n, vocabulary=WORDS):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def docs_of(spark, rows):
    """Rows ``(doc_id, text[, lang[, source]])`` with extra columns whose names the operators use inside."""
    full = [(r[0], r[1], *(r[2:] if len(r) > 2 else (None,)), *((None,) if len(r) < 4 else ()), None, "x", "y") for r in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def awkward():
    """Null, empty and blank texts, one word, other scripts, a very long text, copies and null keys."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    base = prose(rng, 80)
    return [
        (1, None, "xx", "a"), (2, "", "xx", "a"), (3, " \n\t ", None, None), (4, "word", "xx", "b"), (5, "Éß 漢字   x", "yy", "b"),
        (6, long, "xx", "a"), (7, base, "xx", None), (8, base, "xx", None), (9, base.upper(), "yy", "c"), (9, base, "yy", "c"),
        (None, base, "yy", "c"), (None, None, None, None), (10, "a" * 5000, "yy", "c"), (11, base + " end", "yy", "c"), (12, "\x00 ￾", None, "a"),
    ]


# --------------------------------------------------------------------------- shared helpers


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    texts = ["", None, " a  b\n", "é\xa0x y", "\x0b\x0cz\x1c w", "one"]
    data, offsets = utf8(pa.array(texts, pa.string()))
    _, _, row = words(data, offsets)
    assert np.bincount(row, minlength=6).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_runs_join_groups_over_batches():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"k": k}) for k in (["a", "a"], ["a", "b"], [], [None, None], [None, "c"])]
    batches[3] = pa.RecordBatch.from_arrays([pa.array([None, None], pa.string())], ["k"])
    batches = [b if b.schema.field("k").type == pa.string() else pa.RecordBatch.from_arrays([pa.array([], pa.string())], ["k"]) for b in batches]
    assert [(g.column("k")[0].as_py(), g.num_rows) for g in runs(batches, ["k"])] == [("a", 3), ("b", 1), (None, 3), ("c", 1)]


# ---------------------------------------------------------------------------------- mixing


def water_fill(sizes, weights, cap):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(cap * sizes[s] for s in capped)) / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in capped else w[s] * level for s in names}
        capped |= over


@pytest.mark.parametrize("bucket", [20_000, 60])
def test_mix_meets_targets(spark, bucket):
    rng = random.Random(1)
    # A hot source, a tiny one that is capped, a null one and an empty one.
    sources = ["hot"] * 400 + ["b"] * 200 + ["c"] * 100 + ["tiny"] * 8 + [None] * 90 + ["none"] * 5
    rows = [(i, "" if s == "none" else prose(rng, rng.randint(0, 60)), "xx", s) for i, s in enumerate(sources)]
    docs = docs_of(spark, rows)
    got = [r.asDict() for r in mixing.mixed(docs, bucket=bucket).collect()]
    sizes = {}
    for i, text, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(text.split())
    want = water_fill(sizes, (5, 2, 1), 3)
    assert len(got) == len(rows)
    for s in want:
        own = [r for r in got if r["source"] == s]
        assert all(math.isclose(r["target"], want[s], abs_tol=1e-6) and r["source_size"] == sizes[s] for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 0.03 * want[s] + 60
    assert all(0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in got)
    again = {r["doc_id"]: r["copies"] for r in mixing.mixed(docs.repartition(7), bucket=bucket).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in got}


def test_mix_of_awkward_rows_and_of_none(spark, awkward):
    docs = docs_of(spark, awkward)
    got = mixing.mixed(docs).collect()
    assert len(got) == len(awkward)
    assert sorted(r["size"] for r in got) == sorted(len((t[1] or "").encode().split()) for t in awkward)
    assert mixing.mixed(docs.limit(0)).count() == 0
    assert mixing.mix_rows(docs).columns == docs.columns


def test_flight_keeps_sums():
    rng = random.Random(5)
    size = [float(rng.randint(1, 500)) for _ in range(300)]
    p = [0.37] * 300
    before = (sum(p), sum(a * b for a, b in zip(p, size, strict=True)))
    left = mixing.flight(p, size, [rng.random() for _ in range(300)])
    assert len(left) <= 2 and all(p[k] in (0.0, 1.0) for k in range(300) if k not in left)
    assert math.isclose(sum(p), before[0], rel_tol=1e-6) and math.isclose(sum(a * b for a, b in zip(p, size, strict=True)), before[1], rel_tol=1e-6)


# ------------------------------------------------------------------------------ token store


def test_tokens_equal_those_of_whole_texts(spark, awkward):
    from tokenizers import Tokenizer

    extra = [(20, "It's DON'T <|endoftext|>x the,, a.b\r\nİstanbul ǅ É́ ﬁ 12th…"), (21, "Ö ΑΣ ΑΣ, ΣΑΣ."), (22, "naïve, café. Straße")]
    rows = [(r[0], r[1]) for r in awkward] + extra
    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = token_store.token_output(docs_of(spark, rows), tokenizer_path(), 2).collect()
    want = []
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((key, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["indexed"] for r in got)
    place = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == place
        place += r["n_tokens"]
    keys = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))


def test_keyed_access(spark):
    rng = random.Random(2)
    docs = docs_of(spark, [(7 * i - 300, prose(rng, rng.randint(0, 9))) for i in range(400)])
    folder = fresh_path(spark, "store")
    shards = token_store.write_store(docs, tokenizer_path(), 2, folder, shards=5).collect()
    assert len(shards) > 1 and sum(s["records"] for s in shards) == 400
    files, path = token_store.opened(folder)
    codec = token_store.Encoder(tokenizer_path(), 2)
    for s in shards:
        shard = token_store.Shard(files, f"{path}/{s['shard']:06d}")
        inside = {r["doc_id"]: r["text"] for r in docs.filter(F.col("doc_id").between(s["first"], s["last"])).collect()}
        keys = np.array(sorted(inside))
        assert sorted(shard.hash.slots(keys).tolist()) == list(range(len(keys)))
        for key, record in zip(keys.tolist(), shard.records(keys).tolist(), strict=True):
            assert shard.read(record).astype(codec.kind).tobytes() == codec.encode([inside[key]])[0]
        assert (shard.records(keys + 1) == -1).all()


def forms(stems):
    return [a + mark for x in stems for a in (x, x.title(), x.upper()) for mark in ("", ".", ",", "!?")]


def test_words_of_one_stem_take_python_one_step():
    """Calls that Python makes for 12 forms of each new word: fewer than there are forms."""
    import sys

    rng, seen = random.Random(8), []
    words = forms("".join(rng.choice("abdeilmnorstuéö") for _ in range(11)) for _ in range(1000))
    codec = token_store.Encoder(tokenizer_path(), 2)
    codec.encode(["begin"])
    sys.setprofile(lambda frame, event, arg: seen.append(event) if event in ("call", "c_call") else None)
    try:
        codec.encode([" ".join(words)])
    finally:
        sys.setprofile(None)
    assert len(seen) < len(words)


@pytest.mark.parametrize(("end_id", "cache"), [(2, 400_000), (2, 10), (None, 10), (70_000, 400_000)])
def test_encoder_equals_whole_texts(end_id, cache):
    """Odd words, in batches that find words known, new or forgotten; marks, capitals and letters outside of Latin-1 among them."""
    from tokenizers import Tokenizer

    rng, tokenizer = random.Random(5), Tokenizer.from_file(tokenizer_path())
    odd = ["", "'s", "it's", "<|endoftext|>", "a<|endoftext|>b", "\u212a", "\u0130", "e\u0301", "\u0301", "\xd7", "\xaa", "\r", "\t", "\u3000", "\u6f22", "7", "a7.", ".a", "...", "\x00"]
    odd += forms(["stra\xdfe", "\xe0\xf6\xf8\xff\xfe", "the"]) + [chr(c) + "." for c in range(0xA0, 0x100)]
    texts = [None, "", "\n", *("".join(rng.choice(odd) + rng.choice([" ", "\n", "", "  "]) for _ in range(rng.randint(0, 30))) for _ in range(300))]
    codec = token_store.Encoder(tokenizer_path(), end_id, cache)
    got = [x for a in range(0, len(texts), 40) for x in codec.encode(texts[a : a + 40])]
    own = [] if end_id is None else [end_id]
    assert got == [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, *own], codec.kind).tobytes() for t in texts]


def test_encoder_keeps_what_came_again():
    codec, fresh = token_store.Encoder(tokenizer_path(), 2, 8), token_store.Encoder(tokenizer_path(), 2)
    for text in ("alpha beta gamma delta eta", "alpha beta zeta theta iota", "beta kappa alpha mu"):
        assert codec.encode([text, text]) == fresh.encode([text]) * 2
    assert list(codec.known) == ["", "alpha", "beta", "kappa", "mu"]


def test_token_output_of_no_rows(spark, awkward):
    assert token_store.token_output(docs_of(spark, awkward).limit(0), tokenizer_path(), 2).count() == 0


# ------------------------------------------------------------------------------------- chat


def test_chat_round_trip_with_parts(spark):
    part = lambda kind, text=None, **k: (kind, text, k.get("uri"), k.get("width"), k.get("height"), k.get("seconds"), k.get("pages"))
    rows = [
        (1, 0, "user", [part("text", "see <|image|> <%|x"), part("image", uri="u1", width=57, height=28), part("audio", uri="u2", seconds=2.0)]),
        (1, 1, "assistant", [part("text", "it is <|im_end|>\n"), part("document", uri="u3", pages=2), part(None, "ok")]),
        (1, 1, "assistant", [part("text", "it is <|im_end|>\n"), part("document", uri="u3", pages=2), part(None, "ok")]),
        (2, None, None, None), (None, 5, "ro%0Ale\n<|", [part("video", uri="u4")]), (3, 1, "assistant", []),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>").withColumn("content", F.lit(1))
    out = {r["conv_id"]: r for r in chat.format_chats(df, parts="parts").collect()}
    read = {r["conv_id"]: r for r in chat.read_chats(saved(chat.format_chats(df, parts="parts"), "chats")).collect()}
    assert [(a["type"], a["uri"], a["tokens"]) for a in out[1]["attachments"]] == [("image", "u1", 3), ("audio", "u2", 50), ("document", "u3", 512), ("document", "u3", 512)]
    assert out[1]["expanded_tokens"] == 3 + 50 + 1024
    assert out[1]["formatted"].count("<|image|>") == 1  # the text's own one is escaped
    assert [t["text"] for t in read[1]["turns"]][0] == "see <|image|> <%|x<|image|><|audio|>"
    assert read[1]["trained"] == ["it is <|im_end|>\n<|document|>ok"] * 2
    assert [tuple(t) for t in read[2]["turns"]] == [("", "")] and [tuple(t) for t in read[None]["turns"]] == [("ro%0Ale\n<|", "<|document|>")]
    assert read[3]["trained"] == []
    for r in out.values():
        for m in r["mask"]:
            assert r["formatted"][m["turn_start"] :].startswith(chat.START)
    assert chat.format_chats(df.limit(0), parts="parts").count() == 0


@pytest.mark.parametrize("text", ["", "<", "<|", "<%|", "<%%|%|", "a<|b<|im_start|>", "%<||", "<<|", "😀<|é\n"])
def test_escapes_are_reversible(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(chat.escaped(F.col("t")).alias("e"), chat.role_unescaped(chat.role_escaped(F.col("t"))).alias("r"))
    row = df.withColumn("u", chat.unescaped(F.col("e"))).first()
    assert row["u"] == text and "<|" not in row["e"] and row["r"] == text


# ---------------------------------------------------------------------------------- quality


def test_quality_learns_and_keeps_held_out_rows_apart(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(700):
        bad = i % 5 == 0
        text = prose(rng, 40)
        rows.append((i, text.upper() + "!!! ### " * 8 if bad else text + "."))
        if i % 7:
            labels.append((i, int(not bad), 0))
    rows += [(1000, None), (1001, "")]
    docs = docs_of(spark, rows)
    marks = spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, marks).collect()}
    assert len(got) == 702 and got[1000]["score"] == got[1001]["score"]
    held = [i for i in range(700) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i in range(700))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    assert sum(got[i]["predicted"] == int(i % 5 != 0) for i in held) >= 0.97 * len(held)
    # Labels of held-out rows change nothing.
    lies = marks.withColumn("quality", F.when(fold(F.col("doc_id")) == 2, 0).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, lies).collect()}
    assert all(math.isclose(again[i], got[i]["score"], abs_tol=1e-6) for i in got)


def test_quality_without_labels_and_with_awkward_rows(spark, awkward):
    docs = docs_of(spark, awkward)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality_scores(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(4, 1), (7, 1)], "doc_id long, quality int")
    assert quality.quality_scores(docs, one).count() == len(awkward)
    assert quality.quality_scores(docs.limit(0), one).count() == 0


def test_isotonic_is_monotone_and_optimal():
    knots, values = quality.isotonic(np.arange(5), np.array([1.0, 0, 3, 2, 4]), np.array([2, 2, 4, 4, 4]))
    assert (np.diff(values) >= 0).all() and np.interp([0, 1, 2, 3, 4], knots, values).tolist() == [0.25, 0.25, 0.625, 0.625, 1.0]


# --------------------------------------------------------------------------------- language


def slow_phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        n = 1
        while at + n <= len(text) and text[at : at + n] in sample:
            n += 1
        at += max(1, n - 1)
        count += 1
    return count


def test_phrases_equal_slow_parsing():
    rng = random.Random(6)
    samples = (("aa", prose(rng, 60)), ("bb", prose(rng, 60, WORDS[::-1][:30])))
    parser = langid.Parser(samples)
    texts = [prose(rng, rng.randint(0, 120)) + rng.choice(["", " zzz", " Ωx"]) for _ in range(40)] + ["", None, "漢字"]
    codes, offsets = langid.reduced(texts)
    phrases, letters = parser.phrases(codes, offsets)
    kept = ["".join(map(chr, langid.reduced([s])[0][:-1])) for _, s in samples]
    for n in range(len(texts)):
        text = "".join(map(chr, codes[offsets[n] : offsets[n + 1] - 1]))
        assert letters[n] == len(text)
        assert phrases[n].tolist() == [slow_phrases(text, s) for s in kept]


def test_languages(spark, awkward):
    rng = random.Random(7)
    parts = {"aa": WORDS[:40], "bb": [w[::-1] for w in WORDS[40:]]}
    rows = [(i, prose(rng, 30, parts[lang]), lang) for i in range(300) for lang in [("aa", "bb")[i % 3 == 0]]]
    rows += [(1000, None, "aa"), (1001, "12 !?", "aa"), (1002, prose(rng, 30, parts["bb"]), None)]
    got = {r["doc_id"]: r for r in langid.predict_languages(docs_of(spark, rows)).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:300]) and got[1002]["lang_pred"] == "bb"
    assert got[1000]["lang_pred"] == got[1001]["lang_pred"] == "und" and all(0 <= r["score"] <= 1 for r in got.values())
    docs = docs_of(spark, awkward)
    assert langid.predict_languages(docs).count() == len(awkward) and langid.predict_languages(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.predict_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --------------------------------------------------------------------------------- suffixes


def test_suffix_arrays_equal_sorting():
    rng = random.Random(8)
    for n in range(150):
        text = [rng.randint(1, rng.choice([1, 2, 4, 30])) for _ in range(n % 50)] + [0]
        array = suffixes.suffix_array(np.array(text))
        assert array.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        common = suffixes.permuted_prefixes(np.array(text), array)
        for a, b in zip(array.tolist(), array[1:].tolist(), strict=False):
            x, y = text[a:], text[b:]
            assert common[b] == next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))


def slow_removal(rows, length):
    """By key: bytes, removed bytes, spans and digest, from a set of all strings of earlier places."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        mask = bytearray(len(data))
        for at in range(len(data) - length + 1):
            s = data[at : at + length]
            if s in seen:
                mask[at : at + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, m in zip(data, mask, strict=True) if not m)
        spans = sum(1 for i, m in enumerate(mask) if m and not (i and mask[i - 1]))
        out[key] = (len(data), sum(mask), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeats_equal_slow_removal(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = random.Random(9)
    passage, line = prose(rng, 60), prose(rng, 9) + "\n"
    rows = [(i, prose(rng, 30) + (" " + passage + " " if i % 3 else "") + prose(rng, 25)) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, rows[4][1][:150] + "é" + rows[4][1][150:]), (103, line * 40), (104, "a" * 700), (105, "ab" * 300 + "c" + "ab" * 200)]
    rows += [(106, None), (107, ""), (108, "short"), (109, "a" * 100), (110, prose(rng, 20_000) + passage)]
    got = {r["doc_id"]: tuple(r)[1:5] for r in repeats.remove_repeats(docs_of(spark, rows)).collect()}
    assert got == slow_removal(rows, 100)


def test_repeats_of_awkward_rows(spark, awkward):
    docs = docs_of(spark, awkward)
    got = repeats.remove_repeats(docs).collect()
    assert len(got) == len(awkward) and all(r["n_removed"] == 0 for r in got if r["doc_id"] is None)
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_all_rows_share_a_language_sample():
    parts = ["a" * 100, "b" * 3, "", "c" * 100, "d" * 100]
    out = langid.shared_out(parts, 110)
    assert len(out) <= 110 and [len(x) for x in out.split(" ")] == [34, 3, 0, 34, 34]
    assert langid.shared_out(["ab", "c"], 20_000) == "ab c" and langid.shared_out([], 10) == ""


# ----------------------------------------------------------- ties of turns, ridge equations


def test_chat_ties_are_in_the_order_of_texts(spark):
    """Turns that repeat with one role: ``<|`` sorts after ``<a`` although its escaped form sorts before."""
    texts = ["<|a", "<a", "<%|a", "", "<|im_end|>", "<|a"]
    df = spark.createDataFrame([(1, 0, "assistant", t) for t in texts], "conv_id long, turn long, role string, text string").repartition(3)
    read = chat.read_chats(chat.format_chats(df)).first()
    assert [t["text"] for t in read["turns"]] == sorted(texts)
    assert list(read["trained"]) == [t for t in sorted(texts) if t]


def test_ridge_weights_equal_a_direct_solve(spark):
    """Summed over any number of partitions, the equations give the weights of one least-squares problem over all rows."""
    rng = np.random.default_rng(5)
    x = rng.normal(3, 2, (600, 6)).astype(np.float32)
    y = (x[:, 0] + x[:, 1] ** 2 > 15).astype(float)
    rows = [(v.tolist(), float(t), n % 5 == 0) for n, (v, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "x array<float>, label double, calibrate boolean")
    features, ridge = 40, 0.01
    used = np.arange(600) % 5 != 0
    for parts in (1, 7):
        model = quality.fit(df.repartition(parts), features, ridge)
        z = model.features(x[used].astype(np.float64))
        damp = np.sqrt(ridge * max(1.0, used.sum()) / features)
        direct, *_ = np.linalg.lstsq(np.vstack([z, damp * np.eye(features + 1)]), np.concatenate([y[used], np.zeros(features + 1)]), rcond=None)
        assert np.allclose(model.weights, direct, atol=1e-6)
        assert (np.diff(model.values) >= 0).all()


# ------------------------------------------------------------------------------------ top-k


def slow_top(vectors, k):
    out = []
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q, a in ok:
        if q % 100 == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ok if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(128, 64, 4096), (4, 3, 2)])
def test_top_k_equals_all_products(spark, sizes):
    rng = random.Random(10)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(650)]
    vectors += [(700 + i, [0.5] * 8) for i in range(40)]  # ties
    vectors += [(800, None), (900, [0.1, None] + [0.0] * 6), (1000, [float("nan")] * 8), (1001, [float("inf")] * 8), (None, [0.1] * 8), (1100, []), (1200, [3.0e4] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    vectors = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    got = sorted(tuple(r) for r in topk.top_k(df, block=sizes[0], group=sizes[1], batch=sizes[2]).collect())
    assert got == slow_top(vectors, 10)
    assert topk.top_k(df.limit(0)).count() == 0


def test_top_k_prunes_blocks():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (20, 16))
    vectors = np.repeat(centres, 50, 0).astype(np.int64) + rng.integers(-5, 5, (1000, 16))
    *_, scored = topk.search(np.array([0]), vectors[:1], np.arange(1000), vectors, 10, 50)
    assert scored < 10


def test_top_k_ships_few_blocks_of_clustered_vectors(spark):
    """Shuffled clusters: most pairs of query and block are left out before vectors are shipped, no result is."""
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 0.3, (40, 16))
    vectors = [(i, [float(x) for x in centres[rng.integers(40)] + rng.uniform(-0.01, 0.01, 16)]) for i in range(4000)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    good = df.select(F.col("vec_id").alias("id"), topk.quantised(F.col("embedding"), 1024).alias("v"), (F.col("vec_id") % 100 == 0).alias("asked"))
    groups = topk.packed_groups(good, 10, 32, 8)
    queries, parts = topk.packed_queries(groups, 32, 16)
    blocks = groups.agg(F.sum(F.size("blocks"))).first()[0]
    pairs = topk.wanted_blocks(groups, queries, parts).agg(F.sum("pairs")).first()[0]
    assert parts == 3 and 0 < pairs < 40 * blocks / 2
    assert sorted(map(tuple, topk.top_k(df, block=32, group=8, batch=16).collect())) == slow_top(vectors, 10)


def test_top_k_of_copies_and_rows_without_many_others(spark):
    """One vector on a third of all rows, repeated query rows, and fewer than k candidates."""
    rng = random.Random(11)
    vectors = [(i, [0.25] * 4 if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(4)]) for i in range(900)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, block=16, group=4, batch=3).collect())) == slow_top(vectors, 10)
    few = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (5, [3.0]), (100, [-1.0, 0.5])]
    got = topk.top_k(spark.createDataFrame(few, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == sorted(slow_top(few, 10))


# -------------------------------------------------------------------------- near duplicates


def shingle_sets(rows, n):
    out = {}
    for key, text in rows:
        w = (text or "").encode().lower().split()
        out.setdefault(key, []).append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    return out


def slow_components(rows, n, percent):
    sets = [(k, s) for k, many in shingle_sets(rows, n).items() if k is not None for s in many]
    parent = {k: k for k, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            common = len(x & y)
            if x and y and 100 * common >= percent * (len(x) + len(y) - common):
                a2, b2 = top(a), top(b)
                parent[max(a2, b2)] = min(a2, b2)
    return {k: top(k) for k, _ in sets}


def edited(rng, text, share):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split())


@pytest.mark.parametrize(("n", "block"), [(2, near_dup.BLOCK), (5, near_dup.BLOCK), (2, 8)])
def test_components_equal_all_pairs(spark, monkeypatch, awkward, n, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in WORDS for b in WORDS[:25]]
    passage = prose(rng, 90, vocabulary)
    rows = [(200 + i, prose(rng, rng.randint(2, 200), vocabulary)) for i in range(40)]
    rows += [(400 + i, passage + " " + prose(rng, rng.randint(5, 70), vocabulary)) for i in range(40)]  # share much, are not all linked
    for c in range(6):
        seed = prose(rng, rng.choice([6, 40, 150, 600]), vocabulary)
        rows += [(600 + 40 * c + i, edited(rng, seed, rng.choice([0, 0.01, 0.03, 0.05, 0.08]))) for i in range(25)]
    chain = prose(rng, 100, vocabulary).split()
    for i in range(8):  # each linked with the next, the ends are not
        rows.append((1000 + i, " ".join(chain[5 * i : 5 * i + 60])))
    rows += [(r[0], r[1]) for r in awkward if r[0] is not None and r[0] != 6]
    got = near_dup.near_duplicates(docs_of(spark, rows + [(None, passage)]), n=n, percent=80).collect()
    want, sets = slow_components(rows, n, 80), shingle_sets(rows, n)
    assert len(got) == len(rows) + 1
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
            assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}


def test_near_duplicates_of_no_rows(spark, awkward):
    assert near_dup.near_duplicates(docs_of(spark, awkward).limit(0)).count() == 0


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100)]
    random.Random(12).shuffle(edges)
    got = {r["id"]: r["root"] for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys((100, 101, 102), 100)}


# --------------------------------------------------------------------------- decontamination


def edit_distance_inside(pattern, text):
    """Fewest edits of ``pattern`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def plain(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower())


def test_items_are_found_with_edits_and_only_they(spark, awkward):
    rng = random.Random(13)
    vocabulary = [f"{a}{b}" for a in WORDS for b in WORDS[:25]]
    items = [(i, prose(rng, rng.choice([6, 14, 30]), vocabulary)) for i in range(12)] + [(50, None), (None, "x" * 50), (51, "short"), (52, "")]
    items.append((60, items[2][1]))  # the same text twice
    rows = [(i, prose(rng, 40, vocabulary)) for i in range(30)]
    for i in range(12):
        text = items[i][1]
        place = len(text) // 2
        rows.append((100 + i, prose(rng, 20, vocabulary) + " " + text + ". " + prose(rng, 300, vocabulary)))
        rows.append((200 + i, prose(rng, 20, vocabulary) + "\n" + text.upper()[:place] + text[place + 1 :] + "x " + prose(rng, 5, vocabulary)))
        rows.append((300 + i, edited(rng, text, 0.6)))
    rows += [(r[0], r[1]) for r in awkward]
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.find_items(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    pieces = decontam.Pieces([(i, t) for i, t in items if t and i is not None], decontam.Q, decontam.PIECE, decontam.STRIDE, decontam.SHORTEST, decontam.ERROR)
    want = set()
    for key, text in rows:
        for item, codes, edits in zip(pieces.item, pieces.codes, pieces.edits, strict=True):
            if len(text or "") < 10_000 and edit_distance_inside("".join(map(chr, codes)), plain(text)) <= edits:
                want.add((key, item))
    assert set(got) == want
    assert all((100 + i, i) in want and (200 + i, i) in want for i in range(12) if len(items[i][1]) >= 40)
    hit = got[(100 + 2, 2)]
    assert hit["edits"] == 0 and plain(dict(rows)[102][hit["first_char"] : hit["end_char"]]).strip() == plain(items[2][1]).strip()
    assert (102, 60) in got


def test_parts_of_items_are_found_wherever_they_start(spark):
    """Short quotations at any start, replaced words and cut ends; the expectation knows no pieces."""
    rng = random.Random(31)
    vocabulary = [f"{a}{b}"[: rng.randint(3, 8)] for a in WORDS for b in WORDS[:25]]
    items = [(0, prose(rng, 40, vocabulary)), (1, prose(rng, 14, vocabulary)[:90])]
    around, rows = [prose(rng, 15, vocabulary) for _ in range(2)], []
    for start in range(0, 100, 7):
        rows.append((start, around[0] + " " + items[0][1][start : start + 54].strip() + " " + around[1]))
    swapped = items[1][1].split()
    swapped[1], swapped[-2] = "zzzzz", "qqqqq"
    rows += [(200, " ".join(swapped)), (201, around[0] + " " + items[1][1][:-9]), (202, items[1][1][9:]), (300, " ".join(around)), (301, items[0][1][:24])]
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_items(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, 0) for i in range(0, 100, 7)} | {(200, 1), (201, 1), (202, 1)}


def test_short_items_are_found_between_word_boundaries(spark):
    items = [(1, "What is the capital of France?"), (2, "日本の首都はどこですか"), (3, "Ja."), (4, "ja"), (5, " ?! ")]
    rows = [
        (10, "Q: what is the CAPITAL of France? Paris"), (11, "What is the capital of Frances"), (12, "Somewhat is the capital of France"), (13, "What is the capital of France"),
        (20, "質問日本の首都はどこですか。東京"), (21, "日本の首都はどこです"), (30, "oh ja, fine"), (31, "Jam ninja"), (32, "?!"), (33, None), (34, "end ja"),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.find_items(docs_of(spark, rows), table).collect()}
    assert set(got) == {(10, 1), (13, 1), (20, 2), (30, 3), (30, 4), (34, 3), (34, 4)}
    hit = got[10, 1]
    assert (hit["pieces"], hit["edits"]) == (1, 0) and rows[0][1][hit["first_char"] : hit["end_char"]] == "what is the CAPITAL of France"
    assert {r["doc_id"] for r in decontam.keep_clean(docs_of(spark, rows), table).collect()} == {11, 12, 21, 31, 32, 33}


def test_decontamination_without_rows(spark, awkward):
    items = spark.createDataFrame([(1, "some words of a benchmark item that is long enough")], "item_id long, text string")
    docs = docs_of(spark, awkward)
    assert decontam.find_items(docs.limit(0), items).count() == 0 and decontam.find_items(docs, items.limit(0)).count() == 0
    assert decontam.keep_clean(docs, items).count() == len(awkward)


# ------------------------------------------------------------------------------------- WARC


def test_archives(spark):
    import zstandard

    big, other = "<p>é" + "x" * 1200, "<p>" + "y" * 600_000
    rows = [(1, "http://a/\n b", big), (2, "http://b", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", other), (9, "u", "WARC/1.1\r\n\r\n" * 200)]
    rows += [(None, "u", big), (10, "u", "z" * 999), (11, "u", "z" * 999), (12, "u", "q" * 1000), (12, "u", "q" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    folder = fresh_path(spark, "warc")
    bundles = warc.write_archives(pages, folder)
    got = warc.read_archives(spark, bundles, folder).collect()
    kinds = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in got), key=repr)
    want = [(i, "revisit" if t == big and i != 3 else "response", 3 if t == big and i != 3 else None) for i, _, t in rows]
    assert kinds == sorted(want, key=repr)
    for r in got:
        texts = {hashlib.sha1((t or "").encode()).hexdigest(): len((t or "").encode()) for i, _, t in rows if i == r["page_id"]}
        assert texts[r["payload_digest"]] == r["payload_bytes"]
    files, path = warc.opened(folder)
    seen = 0
    for b in bundles.collect():
        bundle = warc.Bundle(files, f"{path}/{b['bundle']}")
        assert len(bundle.frames) == b["frames"]
        with open(f"{path}/{b['bundle']}.warc.zst", "rb") as f:  # any reader takes the frames, and skips the table
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert whole.count(b"WARC-Record-ID") == b["records"]
        for r in got:
            if r["bundle"] == b["bundle"] and r["page_id"] is not None:
                headers, _ = bundle.read(r["page_id"])
                assert headers["WARC-Type"] == r["record_type"]
                seen += 1
        with pytest.raises(KeyError):
            bundle.read(99)
    assert seen == len(rows) - 1
    assert warc.archived(pages.limit(0)).count() == 0


def test_archives_of_a_repeated_attempt(spark):
    """Files that another attempt of the same tasks leaves in the folder are not mixed with the listed ones."""
    rows = [(i, f"http://{i}", "p" * (i % 7) + "x" * 1100 * (i % 3)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = fresh_path(spark, "warc")
    lost = warc.write_archives(pages.orderBy(F.desc("page_id")).repartition(4), folder)
    ended = warc.write_archives(pages.repartition(3), folder)
    got = warc.read_archives(spark, ended, folder).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == [(i, len(t)) for i, _, t in rows]
    assert not {r["bundle"] for r in lost.collect()} & {r["bundle"] for r in ended.collect()}
    files, path = warc.opened(folder)
    first = ended.first()["bundle"]
    other = lost.first()["bundle"]
    with files.open_input_file(f"{path}/{other}.index") as f:
        mixed = f.readall()
    warc.put(files, f"{path}/{first}.index", [mixed])
    with pytest.raises((ValueError, IndexError)):  # an index beside a foreign bundle is noticed
        list(warc.Bundle(files, f"{path}/{first}").records())


# ---------------------------------------------------------------------- registered queries


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_text_query(spark, sf, name):
    from compare import connect, differences

    df = QUERIES[name](spark, sf)
    if name in ORACLE:
        assert differences(df, connect(sf), ORACLE[name]) is None
    elif name.startswith("op9"):
        docs, items = table(spark, sf, "documents").collect(), table(spark, sf, "benchmark").collect()
        want = {d["doc_id"] for d in docs if any(plain(i["text"]).strip() in plain(d["text"]) for i in items)}
        assert {r["doc_id"] for r in df.collect()} == want
    else:
        assert df.count() == table(spark, sf, "documents").count()


def test_repeats_query_equals_slow_removal(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_induced_suffix_dedup"](spark, sf).collect()}
    assert got == slow_removal(rows, 100)


def test_tokens_query_equals_whole_texts(spark, sf):
    from tokenizers import Tokenizer

    tokenizer, want, start = Tokenizer.from_file(tokenizer_path()), {}, 0
    for r in table(spark, sf, "documents").orderBy("doc_id").collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        want[r["doc_id"]] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r["doc_id"]: tuple(r)[1:4] for r in QUERIES["op2_token_store"](spark, sf).collect()} == want


def test_held_out_accuracy(spark, sf):
    docs = table(spark, sf, "documents")
    found = docs.join(QUERIES["op5_cross_parsing_language"](spark, sf), "doc_id").filter("held_out and lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found)
    scored = table(spark, sf, "labels").join(QUERIES["op4_fourier_quality"](spark, sf), "doc_id").filter("held_out").collect()
    assert sum(r["quality"] == r["predicted"] for r in scored) >= 0.9 * len(scored)
