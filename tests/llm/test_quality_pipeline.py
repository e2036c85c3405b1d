import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelmart.llm import quality

SF = "/root/testdata/sf0.01"


def brute_scores(texts, ratios):
    out = []
    for t in texts:
        raw = (t or "").encode()
        if not raw:
            out.append(None)
            continue
        raw = raw.ljust(quality.GRAM, b"\0")
        grams = []
        for i in range(len(raw) - quality.GRAM + 1):
            key = 0
            for c in raw[i:i + quality.GRAM]:
                key = key * 257 + c
            grams.append(((key * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> (64 - quality.BITS))
        out.append(float(np.mean(ratios[np.array(grams)].astype(np.float64))))
    return out


def test_scores_and_counts(odd_docs, spark):
    from panelmart.llm.common import prepare
    prepare(spark)
    texts = [r.text for r in odd_docs.collect()]
    counts = quality.gram_counts(odd_docs)
    assert counts.sum() == sum(max(len(t.encode()) - 3, 1) for t in texts if t)
    ratios = np.random.default_rng(0).standard_normal(1 << quality.BITS).astype(np.float32)
    got = {(r.doc_id, r.text): r.s for r in quality.score(odd_docs, ratios, "s").collect()}
    for r, want in zip(odd_docs.collect(), brute_scores(texts, ratios), strict=True):
        assert got[r.doc_id, r.text] == (None if want is None else pytest.approx(want, abs=1e-6))


def test_batches_do_not_change_scores():
    whole = quality.grams(pa.array(["abcdef", None, "xy", "", "abcdefgh"]))
    parts = [quality.grams(pa.array([t])) for t in ("abcdef", None, "xy", "", "abcdefgh")]
    assert whole[0].tolist() == [g for p in parts for g in p[0].tolist()] and whole[1].tolist() == [3, 0, 1, 0, 5]


def test_the_sample_is_drawn_not_cut(spark):
    """Noise decides near the cut, and the sample's n-grams are nearer to the
    target's than the raw text's are."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    good = quality.good_labels(labels)
    model = quality.fit(docs, good)
    out = quality.keyed(docs.select("doc_id", "text"), model).withColumn("noise", quality.gumbel()).toPandas()
    out = out[out.quality_key.notna()]
    kept = out.quality_key >= model.cut
    weight = out.quality_key - out.noise
    top = weight >= weight.sort_values(ascending=False).iloc[int(kept.sum()) - 1]
    assert (kept != top).sum() >= 4  # not a plain cut of the weights
    assert weight[kept].mean() > weight[~kept].mean() + 2
    target, raw, sample = (quality.gram_counts(x) + 0.5 for x in (
        docs.join(good, "doc_id", "left_semi"), docs, quality.keep_good(docs, good)))
    p, q, r = (x / x.sum() for x in (target, raw, sample))
    assert (p * np.log(p / r)).sum() < 0.9 * (p * np.log(p / q)).sum()


def test_long_texts_in_slices(monkeypatch):
    text = "".join(chr(97 + i * i % 26) for i in range(1000))
    whole = quality.grams(pa.array(["ab", text, "abcdef"]))
    monkeypatch.setattr(quality, "SLICE", 64)
    parts = quality.grams(pa.array(["ab", text, "abcdef"]))
    assert sorted(whole[0].tolist()) == sorted(parts[0].tolist())
    assert whole[1].tolist() == parts[1].tolist() == [1, 997, 3]


def test_own_column_names(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    names = ["quality_log_ratio", "quality_n", "quality_key", "row", "key", "log_ratio", "n"]
    table = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    kept = quality.keep_good(table, quality.good_labels(labels))
    assert kept.columns == table.columns
    assert all(r[n] == f"{n}{r.doc_id}" for r in kept.limit(20).collect() for n in names)


def test_kth_highest(spark):
    rng = np.random.default_rng(2)
    values = [*rng.standard_normal(3000).tolist(), *([0.5] * 7000)]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 500, 3000, 9000, 10000):
        assert quality.kth_highest(keys, "key", k) == sorted(values, reverse=True)[k - 1]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.resample(docs, quality.good_labels(labels)).join(labels, "doc_id").toPandas()
    clean, junk = out[(out.quality == 1) & (out.toxic == 0)], out[out.quality == 0]
    assert clean.kept.mean() >= 0.97 and junk.kept.mean() <= 0.2


def test_odd_tables(odd_docs, no_docs, clashing, spark):
    none = spark.createDataFrame([], "doc_id long")
    kept = {r.doc_id: r.kept for r in quality.resample(odd_docs, none).collect()}
    assert not kept[0] and not kept[1] and kept[2]
    assert quality.resample(no_docs, none).count() == 0
    assert quality.keep_good(clashing, none).columns == clashing.columns


def test_pipeline_stages(spark, docs):
    import corpus_pipeline as C
    assert [n for n, _ in C.STAGES] == ["quality", "near_dedup", "mix", "pack"] and C.ORACLE_SQL is None
    sf = "/root/testdata/sf0.001"
    rows = docs
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, rows, sf)
        assert out.columns == docs.columns, name
        have = {r.doc_id: r for r in rows.collect()}
        got = out.collect()
        assert all(have[r.doc_id] == r for r in got), name
        if name != "mix":
            assert len({r.doc_id for r in got}) == len(got) <= len(have)
        rows = spark.createDataFrame(got, docs.schema)
    packed = C.STAGES[-1][1](spark, rows, sf).collect()
    assert sum(r.piece == 0 for r in packed) == rows.count()
    assert C.run(spark, sf).count() == len(packed)


def test_nothing_else_imports_the_operators():
    import pathlib
    root = pathlib.Path(sys.modules["panelmart.llm"].__file__).parent.parent
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "panelmart.llm" in p.read_text()]


def test_clean_texts_of_all_lengths_and_languages_stay(spark):
    from pyspark.sql import functions as F
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    size = docs.select("doc_id", "lang", F.size(F.split(F.trim("text"), r"\s+")).alias("size"))
    out = quality.resample(docs, quality.good_labels(labels)).join(labels, "doc_id").join(size, "doc_id").toPandas()
    clean, junk = out[(out.quality == 1) & (out.toxic == 0)], out[out.quality == 0]
    assert clean[clean["size"] < 20].kept.mean() >= 0.98 and junk.kept.mean() <= 0.05
    assert (clean.groupby("lang").kept.mean() >= 0.97).all()
