"""The pipeline, stage by stage, against plain computations on what the stage before kept."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from listlake.llm import decontam, mixing, near_dup, quality
from listlake.llm.common import saved, slices, table, utf8
from listlake.llm.queries import tokenizer_path
from pyspark.sql import functions as F

from test_text_operators import edited, plain, prose, slow_components, water_fill

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Good and bad rows, copies, benchmark passages, a hot source, null and empty texts."""
    rng, root = random.Random(21), tmp_path_factory.mktemp("corpus")
    vocabulary = [prose(rng, 1) + prose(rng, 1) for _ in range(900)]
    items = [(i, prose(rng, 20, vocabulary)) for i in range(5)]
    rows, labels = [], []
    for i in range(500):
        text, bad = prose(rng, 60, vocabulary) + ".", i % 6 == 0
        if i % 50 == 7:
            text += " " + items[i // 50 % 5][1]
        rows.append((i, text.upper().replace(" ", "!!! ### ") if bad else text, "xx", "hot" if i % 3 else f"s{i % 4}", 0))
        if i % 9:
            labels.append((i, int(not bad), 0))
    rows += [(1000 + i, edited(rng, rows[1 + 6 * i][1], 0.01), "xx", None, 0) for i in range(40)]
    rows += [(2000, rows[1][1], None, "hot", None), (2001, None, None, None, None), (2002, "", None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_every_stage(spark, corpus):
    from tokenizers import Tokenizer

    docs = table(spark, corpus, "documents")
    stages = [f for _, f in corpus_pipeline.STAGES]
    good = saved(stages[0](spark, docs, corpus), "good")
    scores = {r["doc_id"]: r["predicted"] for r in quality.quality_scores(docs, table(spark, corpus, "labels")).collect()}
    assert good.columns == COLUMNS and Counter(rows_of(good)) == Counter(r for r in rows_of(docs) if scores[r[0]])
    kept = {r[0] for r in rows_of(good)}
    assert len([i for i in range(500) if i % 6 == 0 and i in kept]) <= 3 and len([i for i in range(500) if i % 6 and i not in kept]) <= 8

    one = saved(stages[1](spark, good, corpus), "one")
    root = slow_components(rows_of(good), 5, 80)
    assert one.columns == COLUMNS and Counter(rows_of(one)) == Counter(r for r in rows_of(good) if root[r[0]] == r[0])
    assert one.count() < good.count()

    clean = saved(stages[2](spark, one, corpus), "clean")
    items = [plain(r["text"]).strip() for r in table(spark, corpus, "benchmark").collect()]
    assert Counter(rows_of(clean)) == Counter(r for r in rows_of(one) if not any(i in plain(r[1]) for i in items))
    assert clean.count() < one.count()

    mixed = saved(stages[3](spark, clean, corpus), "mixed")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(clean).collect()}
    assert mixed.columns == COLUMNS and Counter(rows_of(mixed)) == Counter({r: copies[r[0]] for r in rows_of(clean) if copies[r[0]]})
    sizes = Counter()
    for r in clean.collect():
        sizes[r["source"]] += len((r["text"] or "").split())
    for source, target in water_fill(sizes, (5, 2, 1), 3).items():
        taken = sum(len((r["text"] or "").split()) for r in mixed.where(F.col("source").eqNullSafe(F.lit(source))).collect())
        assert abs(taken - target) <= 0.03 * target + 70

    tokenizer, start, want = Tokenizer.from_file(tokenizer_path()), 0, []
    for key, text in sorted(rows_of(mixed), key=lambda r: r[0]):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(tuple(r)[:4] for r in stages[4](spark, mixed, corpus).collect())
    assert got == sorted(want)
    assert sorted(tuple(r)[:4] for r in corpus_pipeline.run(spark, corpus).collect()) == got


def test_run_over_the_given_tables(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"] and 0 < out.count()


# ---------------------------------------------------------------- rows without a key of their own

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row long, _row long, times int, _dropped long, _key long, _copies int, id long, size long, part int"


def clashing(spark, rows):
    """Rows ``(doc_id, text, source)`` with columns that a stage might use for itself."""
    return spark.createDataFrame([(k, t, "xx", s, 0, 1, 1, 1, 7, 7, 3, 7, 7, 7) for k, t, s in rows], CLASHING)


def texts_of(df):
    assert df.columns == [c.split()[0] for c in CLASHING.split(", ")]
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in df.collect())


def test_clean_rows_stay_beside_dirty_ones_of_their_key(spark):
    rng = random.Random(1)
    passage, clean = prose(rng, 40), [prose(rng, 40) for _ in range(3)]
    docs = clashing(spark, [(None, passage, "a"), (None, clean[0], "a"), (7, passage, "a"), (7, clean[1], "a"), (8, None, "a"), (9, clean[2], "a")])
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert [t for _, _, t in texts_of(decontam.keep_clean(docs, items))] == [clean[1], "", clean[2], clean[0]]


def test_good_rows_stay_beside_bad_ones_of_their_key(spark):
    rng = random.Random(2)
    good = [prose(rng, 60) + "." for _ in range(60)]
    bad = [t.upper().replace(" ", "!!! ### ") for t in good]
    rows = [(i, good[i], "a") for i in range(50)] + [(100 + i, bad[i], "a") for i in range(50)]
    rows += [(k, t, "a") for n, k in ((55, 900), (56, None), (57, None)) for t in (good[n], bad[n])]
    labels = spark.createDataFrame([(k, int(k < 100), 0) for k, _, _ in rows if k is not None and k != 900], "doc_id long, quality int, toxic int")
    kept = texts_of(quality.keep_good(clashing(spark, rows), labels))
    assert [t for _, _, t in kept] == [*(good[i] for i in range(50)), good[55], *sorted(good[56:58])]


def test_one_row_of_each_group_stays_whatever_its_key(spark):
    rng = random.Random(3)
    a, b, c = (prose(rng, 80) for _ in range(3))
    rows = [(5, a, "x"), (5, a, "x"), (None, b, "x"), (None, b, "x"), (3, c, "x"), (None, c, "x"), (5, c + " end", "x"), (6, None, "x"), (6, "", "x")]
    kept = texts_of(near_dup.keep_first(clashing(spark, rows)))
    assert kept == [(False, 3, c), (False, 5, a), (False, 6, ""), (False, 6, ""), (True, 0, b)]


def test_a_key_with_two_texts_joins_their_groups(spark):
    rng = random.Random(4)
    a, b = prose(rng, 80), prose(rng, 80)
    docs = clashing(spark, [(5, a, "x"), (5, b, "x"), (3, a, "x"), (4, b, "x"), (9, prose(rng, 50), "x")])
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 9: 9}


def test_rows_without_a_key_are_mixed_one_by_one(spark):
    rng = random.Random(5)
    rows = [(None if i % 2 else i // 4, prose(rng, 10 + i % 9), "a" if i % 4 else "b") for i in range(2000)]
    docs = clashing(spark, rows)
    wanted = {r["source"]: r["target"] for r in mixing.mixed(docs).select("source", "target").distinct().collect()}
    taken = Counter()
    for r in mixing.mix_rows(docs).collect():
        taken[r["source"]] += len(r["text"].split())
    assert all(abs(taken[s] - t) <= 0.01 * t + 30 for s, t in wanted.items())
    assert mixing.mix_rows(docs).columns == docs.columns


def test_stages_hold_a_small_piece_of_a_batch():
    """What a worker needs for shingles or statistics stays small on a batch of many texts, and its rows do not depend on the pieces."""
    rng = random.Random(5)
    vocabulary = [prose(rng, 1) for _ in range(900)]
    batch = pa.RecordBatch.from_arrays([pa.array([prose(rng, 400, vocabulary) for _ in range(2_000)])], ["text"])
    for work in (lambda x: near_dup.shingles(*x, 5), lambda x: [*quality.measures(*x)]):
        tracemalloc.start()
        try:
            for piece in slices([batch], "text"):
                work(utf8(piece.column("text")))
            assert tracemalloc.get_traced_memory()[1] <= 100e6
        finally:
            tracemalloc.stop()
        few, all_ = ([r for x in slices([batch.slice(0, 300)], "text", most) for r in work(utf8(x.column("text")))] for most in (100_000, 1 << 30))
        assert all(np.array_equal(a, b) for a, b in zip(few, all_, strict=True))


def test_saved_sends_a_few_megabytes_to_a_worker(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "64m")  # Spark's own
    try:
        rows = spark.range(0, 3_000, 1, 1).select(F.repeat(F.lit("x"), 4_000).alias("text"))
        assert saved(rows.mapInArrow(sizes, "n long"), "sizes").agg(F.max("n")).first()[0] <= 5 << 20
        assert spark.conf.get(key) == "64m"
    finally:
        spark.conf.set(key, before)
