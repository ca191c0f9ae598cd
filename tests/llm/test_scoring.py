"""Scores, fingerprints and the quality classifier."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm import blocks, fingerprints, lm_scoring, quality
from tests.llm import brute
from tests.llm.helpers import SCHEMA, awkward, corpus, frame


@pytest.mark.parametrize(("order", "least"), [(1, 1), (2, 1), (3, 1), (2, 2), (3, 4)])
def test_backoff_matches_plain_version(spark, monkeypatch, order, least):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 10_000)
    rows = corpus(7)
    scores = lm_scoring.score_documents(frame(spark, rows), order, least=least).collect()
    got = sorted(((r.doc_id, r.n_words, r.log_score) for r in scores), key=str)
    assert least > 1 or not any(r.n_backed_off for r in scores)
    want = sorted(brute.backoff_scores([(r[0], r[1]) for r in rows], order, least=least), key=str)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want])


def test_counts_and_keys_survive_packing():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    assert (blocks.unpack(blocks.pack(keys)) == keys).all()
    counts = np.array([1, 254, 255, 256, 2**40, 3])
    assert (blocks.unpack_counts(blocks.pack_counts(counts), len(counts)) == counts).all()


def test_edited_texts_and_neighbours(spark):
    rows = [r for r in corpus(8)[:-1] if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    got = {r.doc_id: r for r in fingerprints.fingerprint(frame(spark, rows)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    for doc_id, chars, digest in brute.edited_hash([(r[0], r[1]) for r in rows]):
        assert (got[doc_id].n_chars, got[doc_id].edited_sha256) == (chars, digest)
    prints = {}
    for r in rows:
        assert prints.setdefault(r[1] or "", got[r[0]].fingerprint) == got[r[0]].fingerprint
    long = [r[0] for r in rows if len(r[1] or "") > 600 and len(set(r[1])) > 5]
    assert np.mean([got[i].near_edited for i in long]) > 0.35
    assert np.mean([got[i].near_next for i in long]) < got[long[0]].near_edited
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())


def test_one_row_is_its_own_neighbour(spark):
    row = fingerprints.fingerprint(frame(spark, [(1, "abcdef", None, None, 0)])).collect()[0]
    assert row.near_next == 1.0 and row.n_chars == 6
    empty = fingerprints.fingerprint(frame(spark, [(1, None, None, None, 0), (2, "some text", None, None, 0)])).collect()
    assert {r.doc_id: r.fingerprint for r in empty}[1] == ""
    assert {r.near_next for r in empty} == {0.0}


def test_inner_names_do_not_depend_on_place():
    rng = np.random.default_rng(3)
    middle = "".join(chr(97 + x) for x in rng.integers(0, 20, 3000))
    def names(text):
        return set(fingerprints.names_of(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))[0].tolist())
    alone = names(middle)
    for before in ("", "x", "prefix of another length ", "zz" * 40):
        inside = names(before + middle + "an end")
        assert len(alone & inside) >= len(alone) - 8


def test_parsing_does_not_depend_on_the_batch():
    texts = [r[1] or "" for r in corpus(9)]
    whole = fingerprints.sketches(texts)
    assert (whole == np.concatenate([fingerprints.sketches([x]) for x in texts])).all()


def junk(i):
    return " ".join(f"word{j % 7}%%%" for j in range(40 + i))


def test_classifier_learns_without_held_out_rows(spark):
    good = [(i, f"Some plain text with number of words {'and more ' * (i % 30)}indeed.", "en", "s", 0) for i in range(300)]
    bad = [(1000 + i, junk(i), "en", "s", 0) for i in range(60)]
    docs = frame(spark, good + bad + [(5000, None, None, None, None), (5001, "", "en", "s", 0)])
    labels = spark.createDataFrame(
        [(r[0], 1, 0) for r in good[:200]] + [(r[0], 0, 0) for r in bad[:40]] + [(7, None, 0), (None, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = {r.doc_id: r for r in quality.score_quality(docs, labels, 200).collect()}
    assert len(got) == 362 and all(0 <= r.score <= 1 for r in got.values())
    for doc_id, r in got.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)
    assert np.mean([got[r[0]].predicted for r in good]) > 0.98
    assert np.mean([got[r[0]].predicted for r in bad]) < 0.05
    wrong = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    again = {r.doc_id: r.score for r in quality.score_quality(docs, wrong, 200).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in got)
    kept = {r.doc_id for r in quality.keep_good(docs, labels, 200).collect()}
    assert kept == {i for i, r in got.items() if r.predicted}


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8])
def test_prior_from_positives_and_unlabelled_rows(share):
    rng = np.random.default_rng(3)
    some = int(2000 * share)
    mixed = np.concatenate((rng.normal(1.5, 1, (some, 4)), rng.normal(-1.5, 1, (2000 - some, 4))))
    found = quality.class_prior(rng.normal(1.5, 1, (1500, 4)), rng.permutation(mixed))
    assert abs(found - share) < 0.08
    assert quality.class_prior(mixed[:2], mixed) == 0.5


def test_repeated_ids_are_learned_from_once(spark):
    good = [(i, f"Some plain text with number of words {'and more ' * (i % 30)}indeed.", "en", "s", 0) for i in range(60)]
    bad = [(1000 + i, junk(i), "en", "s", 0) for i in range(60)]
    labels = spark.createDataFrame([(r[0], 1, 0) for r in good], "doc_id long, quality int, toxic int")
    once = {r.doc_id: r.score for r in quality.score_quality(frame(spark, good + bad), labels).collect()}
    often = quality.score_quality(frame(spark, good + bad + bad[:5] * 200), labels).collect()
    assert len(often) == 1120 and all(abs(r.score - once[r.doc_id]) < 1e-6 for r in often)


def test_neighbours_across_partitions_meet_without_moving_texts_to_one_task(spark):
    rows = [(i, f"text {i} " * 9, None, None, None) for i in range(40)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "7", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r.doc_id: r for r in fingerprints.fingerprint(frame(spark, rows)).collect()}
            assert len(got) == 40
            for i, text, *_ in rows:
                cut = len(text) // 3
                edited = text[: len(text) - cut] + rows[i - 1][1][:cut]
                assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_texts_are_sorted_and_read_once(spark):
    rows = [(i, f"text {i} " * 9, None, None, None) for i in range(40)]
    plan = fingerprints.fingerprint(frame(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == plan.count("Sort [") == 1 and "Union" not in plan


def test_few_texts_are_read_at_once(spark):
    setting = "spark.sql.parquet.columnarReaderBatchSize"
    spark.conf.unset(setting)
    try:
        fingerprints.fingerprint(frame(spark, [(1, "some text", None, None, None)]))
        assert int(spark.conf.get(setting)) == fingerprints.READ_ROWS <= 256
    finally:
        spark.conf.unset(setting)


def test_neighbours_of_repeated_and_missing_ids_do_not_depend_on_the_partitions(spark):
    ids = [None] * 30 + [5] * 30 + [-(2**62), 2**62, 0, -1] + list(range(100, 120))
    rows = [(i, f"text {n % 50} " * 9, None, None, None) for n, i in enumerate(ids)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for parts in ("1", "3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(sorted(fingerprints.fingerprint(frame(spark, rows)).collect(), key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found[0]) == len(rows) and found[0] == found[1] == found[2]


def test_risk_stays_non_negative():
    rng = np.random.default_rng(2)
    plus, minus = rng.normal(1, 1, (300, 4)), rng.normal(-2, 1, (100, 4))
    model = quality.fit(plus, np.concatenate((rng.normal(1, 1, (300, 4)), minus)), 0.75)
    assert (model.score(plus) > 0.5).mean() > 0.9
    assert (model.score(minus) < 0.5).mean() > 0.9


def test_without_labels_nothing_is_rejected(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, corpus(1, 5))
    assert {r.score for r in quality.score_quality(docs, labels).collect()} == {0.5}
    assert quality.keep_good(docs, labels).count() == docs.count()


@pytest.mark.parametrize("work", [lm_scoring.score_documents, fingerprints.fingerprint])
def test_empty_tables_and_clashing_columns(spark, work):
    assert work(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = corpus(6, 12)
    assert work(awkward(spark, rows)).count() == len(rows)


def test_quality_keeps_clashing_columns_apart(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    rows = corpus(6, 12)
    assert quality.score_quality(awkward(spark, rows), labels).count() == len(rows)
    assert quality.score_quality(spark.createDataFrame([], SCHEMA), labels).count() == 0
    assert quality.keep_good(awkward(spark, rows), labels).columns == awkward(spark, rows).columns


def test_features_are_finite():
    texts = pa.array([r[1] for r in corpus(2)], pa.string())
    assert np.isfinite(quality.chunked(texts, quality.features, quality.FEATURES)).all()
