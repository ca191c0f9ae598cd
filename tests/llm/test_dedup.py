"""Substring, suffix-array and line dedup, and the Jaccard join, against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from llm import blocks, line_dedup, ngram_join, repeats, substring_dedup, suffix_array_dedup
from tests.llm import brute
from tests.llm.helpers import SCHEMA, awkward, corpus, frame

key = str


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")
BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("limit", [1_500, 3])
def test_words_match_plain_version(spark, monkeypatch, limit):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    rows = corpus()
    read = substring_dedup.repeated_places
    monkeypatch.setattr(substring_dedup, "repeated_places", lambda *a: read(*a, group_limit=limit))
    got = plain(substring_dedup.remove_repeated_words(frame(spark, rows)), *WORDS)
    assert got == sorted(brute.substring_dedup(pairs(rows)), key=key)


@pytest.mark.parametrize("limit", [1_500, 3])
def test_bytes_match_plain_version(spark, monkeypatch, limit):
    rows = corpus(2)
    read = suffix_array_dedup.repeated_places
    monkeypatch.setattr(suffix_array_dedup, "repeated_places", lambda *a: read(*a, group_limit=limit))
    got = plain(suffix_array_dedup.remove_repeated_bytes(frame(spark, rows)), *BYTES)
    assert got == sorted(brute.suffix_array_dedup(pairs(rows)), key=key)


def test_small_windows_and_random_texts(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60))), None, None, None) for i in range(80)]
    got = plain(substring_dedup.remove_repeated_words(frame(spark, rows), 12), *WORDS)
    assert got == sorted(brute.substring_dedup(pairs(rows), 12), key=key)
    got = plain(suffix_array_dedup.remove_repeated_bytes(frame(spark, rows), 40), *BYTES)
    assert got == sorted(brute.suffix_array_dedup(pairs(rows), 40), key=key)


def test_every_place_of_a_repeat_is_named(spark):
    rows = corpus(3)
    texts = [(r[1] or "").encode() for r in rows]
    found = suffix_array_dedup.repeat_groups(frame(spark, rows)).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.repeat_id, set()).add((r.doc_id, r.start))
    by_id = {r[0]: t for r, t in zip(rows, texts, strict=True) if r[0] != 2}
    for r in found:
        if r.doc_id in by_id:
            part = by_id[r.doc_id][r.start : r.start + r.n_bytes]
            assert len(part) == r.n_bytes >= 200
            assert sum(part in t for t in texts) > 1 or any(t.count(part) > 1 or part in t[t.find(part) + 1 :] for t in texts)
    assert max(map(len, groups.values())) >= 10


def test_intervals_of_a_known_array():
    found = sorted(suffix_array_dedup.intervals([0, 2, 3, 1]))
    assert found == [(1, 0, 3), (2, 0, 2), (3, 1, 2)]


def test_subtree_nodes():
    right = [[b"a", b"b", b"c"], [b"a", b"b", b"d"], [b"a", b"x"]]
    assert sorted((d, sorted(x)) for d, x in substring_dedup.subtree(right)) == [(1, [0, 1, 2]), (2, [0, 1])]


@pytest.mark.parametrize(("words", "percent", "cell"), [(4, 85, 2_048), (4, 60, 2), (5, 80, 3)])
def test_join_matches_plain_version(spark, monkeypatch, words, percent, cell):
    monkeypatch.setattr(ngram_join, "CELL_MEMBERS", cell)
    rows = corpus(4)
    got = plain(ngram_join.join_similar(frame(spark, rows), words, percent), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard_join(pairs(rows), words, percent), key=key)


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80)])
def test_small_sets_of_all_sizes_are_linked(spark, words, percent):
    rows = []
    for size in range(1, 26):
        for more in range(size * 100 // percent - size + 2):
            for copy in range(3):
                own = [f"s{size}m{more}c{copy}w{i}" for i in range(size + more + words - 1)]
                rows += [(len(rows), " ".join(own[: size + words - 1]), None, None, None)]
                rows += [(len(rows), " ".join(own), None, None, None)]
    got = plain(ngram_join.join_similar(frame(spark, rows), words, percent), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard_join(pairs(rows), words, percent), key=key)


def test_one_of_each_stays(spark):
    rows = corpus(4)[:-1]  # without the id that two texts have
    kept = ngram_join.keep_one_of_each(frame(spark, rows), 5, 80).collect()
    want = brute.jaccard_join(pairs(rows), 5, 80)
    some = [r for r in kept if (r.text or "").split()]
    assert len(some) == len({w[2] for w in want if w[1]})
    assert {r.doc_id for r in some} <= {w[2] for w in want}
    assert len(kept) - len(some) == sum(1 for w in want if not w[1])


def test_fragments_outnumber_differences():
    for size in (6, 7, 20, 130, 1_000, 40_000):
        group = int(ngram_join.size_class(size, 85)) + 1
        assert ngram_join.fragments(group, 85) > 2 * size * 15 // 185


def test_a_passage_in_all_texts_ties_no_clusters(spark, monkeypatch):
    passage = " ".join(f"common{i}" for i in range(40))
    texts = [" ".join(f"own{g}x{i}" for i in range(60)) + f" end{c} " + passage for g in range(25) for c in "ab"]
    rows = [(i, text, None, None, None) for i, text in enumerate(texts)]
    clusters = []

    def seen(edges, work=ngram_join.components):
        clusters.append(work(edges))
        return clusters[-1]

    monkeypatch.setattr(ngram_join, "components", seen)
    got = plain(ngram_join.join_similar(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard_join(pairs(rows)), key=key)
    assert {r["count"] for r in clusters[0].groupBy("root").count().collect()} == {2}


def test_classes_of_counts_come_back_in_the_order_of_keys(spark, monkeypatch):
    monkeypatch.setattr(blocks, "HELD_KEYS", 5)
    rows = [(i, " ".join(f"{'all' if w % 3 == 0 else i}w{w}" for w in range(30)), None, None, None) for i in range(40)]
    dealt, count = blocks.block_documents(frame(spark, rows), 500)

    def keys_of(table):
        parts = [np.zeros(0, np.uint64), *ngram_join.shingle_sets(table["text"], 1)]
        return np.unique(blocks.short_keys(np.concatenate(parts), count), return_counts=True)

    def describe(table, replies):
        keys, _ = keys_of(table)
        found = np.bincount(blocks.class_table(replies, keys, count), minlength=16)
        return pa.table({"blk": table["blk"][:1], "rows": [len(table)], "found": [found.tolist()]})

    replies = blocks.count_classes(dealt, count, keys_of)
    got = blocks.with_replies(dealt, replies, describe, "blk int, rows long, found array<long>").collect()
    assert count > 5 and sum(r.rows for r in got) == 40
    frequent = blocks.class_of_count(np.array([40]))[0]
    for r in got:
        assert r.found[1] == 20 * r.rows and r.found[frequent] == 10 and sum(r.found) == 20 * r.rows + 10


def test_classes_of_counts_keep_their_order():
    found = blocks.class_of_count(np.arange(1, 5_000))
    assert found[:9].tolist() == list(range(1, 10)) and (np.diff(found.astype(int)) >= 0).all() and found[-1] == blocks.MANY


def test_patience_keeps_order():
    a, b = [1, 2, 3, 9, 4, 5], [2, 3, 7, 1, 4, 5]
    found = line_dedup.patience(a, b)
    assert found == [(1, 0), (2, 1), (4, 4), (5, 5)]
    assert line_dedup.patience([], [1]) == []
    assert line_dedup.increasing([(0, 3), (1, 1), (2, 2), (3, 0)]) == [(1, 1), (2, 2)]


def test_lines_of_later_documents_go(spark):
    long = [f"this is line number {i} of the text" for i in range(8)]
    rows = [
        (1, "\n".join(long), "en", "s", 1),
        (2, "\n".join([*long[:5], "an own line of the second text"]), "en", "s", 1),
        (3, "\n".join(["short", long[6], long[7], "something that is new here"]), "en", "s", 1),
        (4, "\n".join(reversed(long[:2])), "en", "s", 1),
        (5, None, None, None, None),
        (6, "", "en", "s", 0),
    ]
    got = {r.doc_id: r for r in line_dedup.remove_common_lines(frame(spark, rows)).collect()}
    assert got[1].text == rows[0][1] and got[1].n_removed == 0
    assert got[2].text == "an own line of the second text" and got[2].n_removed == 5
    assert got[3].text == "short\nsomething that is new here"
    assert got[4].n_removed == 1
    assert got[5].text is None and got[6].text == ""
    assert got[2].n_chars == len(got[2].text)


def test_large_groups_of_copies_are_found(spark):
    text = "\n".join(f"the same long line number {i}" for i in range(6))
    rows = [(i, text, "en", "s", 1) for i in range(200)]
    got = line_dedup.remove_common_lines(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in got if r.text) == [0]


def test_popular_passages_beside_a_near_copy_go(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "OWNER_PAIRS", 4, raising=False)
    popular = [f"a popular line that many documents hold {i}" for i in range(3)]
    base = [f"a rare line of the only other document {i}" for i in range(6)]
    rows = [(i, "\n".join([f"an own first line of document {i}", *popular]), "en", "s", 1) for i in range(40)]
    rows.append((50, "\n".join(base), "en", "s", 1))
    rows.append((51, "\n".join([*base, "the only own line of the last one", *popular]), "en", "s", 1))
    got = {r.doc_id: r for r in line_dedup.remove_common_lines(frame(spark, rows)).collect()}
    assert got[51].text == "the only own line of the last one" and got[51].n_removed == 9
    assert all(got[i].text == f"an own first line of document {i}" for i in range(1, 40))


def test_blocks_of_short_lines_go(spark):
    verse = [f"verse line {i:04}" for i in range(200)]
    rows = [
        (1, "\n".join(verse), "en", "s", 1),
        (2, "\n".join(verse), "en", "s", 1),
        (3, "\n".join(["an own line before", *verse[20:22], "and one after"]), "en", "s", 1),
        (4, "\n".join(["one line is too short", verse[20], "for a block"]), "en", "s", 1),
        (5, "\n".join(["\u00e9", "a line with more characters than a block", "tail"]), "en", "s", 1),
        (6, "\n".join(["a line with more characters than a block", "tail", "x"]), "en", "s", 1),
    ]
    got = {r.doc_id: r for r in line_dedup.remove_common_lines(frame(spark, rows)).collect()}
    assert got[1].n_removed == 0 and got[2].text == "" and got[2].n_removed == 200
    assert got[3].text == "an own line before\nand one after"
    assert got[4].n_removed == 0
    assert got[6].text == "x"


def test_runs_cover_every_block():
    import numpy as np

    rnd = random.Random(8)
    for _ in range(300):
        chars = [rnd.choice([0, 1, 5, 11, 15, 30]) for _ in range(rnd.randint(1, 12))]
        names = [rnd.randint(1, 4) if c else 0 for c in chars]
        hashes, sizes = np.array(names * 2, np.int64), np.array(chars * 2, np.int32)
        text, keys = line_dedup.run_keys(hashes, sizes, np.array([0, len(names), 2 * len(names)]))
        want = set()
        for i in range(len(names)):
            for j in range(i, len(names)):
                total = sum(chars[i : j + 1])
                if total >= 24 and ((total - chars[j] < 24 and names[i]) or (total - chars[i] < 24 and names[j])):
                    want.add(tuple(names[i : j + 1]))
        assert set(keys[text == 0]) == set(keys[text == 1]) and len(set(keys[text == 0])) == len(want)


@pytest.mark.parametrize(
    "work",
    [
        substring_dedup.remove_repeated_words,
        suffix_array_dedup.remove_repeated_bytes,
        suffix_array_dedup.repeat_groups,
        ngram_join.join_similar,
        line_dedup.remove_common_lines,
        lambda df: ngram_join.keep_one_of_each(df, 5, 80),
    ],
)
def test_empty_tables_and_clashing_columns(spark, work):
    assert work(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = corpus(6, 12)
    assert work(awkward(spark, rows)).count() == work(frame(spark, rows)).count()


def test_repeats_has_no_open_limit():
    assert repeats.GROUP_LIMIT < 10_000


def kept_lines(spark, texts):
    rows = [(i, x, None, None, None) for i, x in enumerate(texts)]
    got = line_dedup.remove_common_lines(frame(spark, rows), any_order=True).collect()
    return {r.doc_id: (r.n_removed, r.text) for r in got}


def test_blocks_in_another_order_than_the_owner_has_them(spark):
    p = [f"a line of the first block {i}" for i in range(4)]
    q = [f"a line of the second block {i}" for i in range(4)]
    got = kept_lines(spark, ["\n".join(x) for x in (q + p, [*p, "x", *q], [*p, "y", *q])])
    assert got[0][0] == 0
    assert got[1] == (8, "x") and got[2] == (8, "y")


@pytest.mark.parametrize("parts", [1_000, 2])
def test_alignment_of_all_pairs_removes_the_same_lines(spark, monkeypatch, parts):
    monkeypatch.setattr(line_dedup, "OWNER_PAIRS", parts)
    monkeypatch.setattr(line_dedup, "LATER_PAIRS", parts)
    rnd = random.Random(11)
    pool = [f"{i} " + "z" * rnd.randint(1, 30) for i in range(80)]
    texts = []
    for _ in range(60):
        start, own = rnd.randrange(80), []
        for _ in range(rnd.randint(1, 6)):
            own += pool[start : start + rnd.randint(1, 9)]
            start = rnd.randrange(80)
        texts.append("\n".join(dict.fromkeys(own)))
    got = kept_lines(spark, texts)
    for i, gone in enumerate(brute.line_dedup(list(enumerate(texts)))):
        lines = texts[i].split("\n")
        assert got[i] == (len(gone), "\n".join(x for j, x in enumerate(lines) if j not in gone))


def test_moved_lines_end_and_keep_out_of_each_other(spark):
    first, second = [1, 2, 3, 4, 5, 5, 6], [4, 5, 5, 9, 1, 2, 8, 6, 6]
    found = line_dedup.moved(first, second, line_dedup.patience(first, second))
    every = found + line_dedup.patience(first, second)
    assert len({i for i, _ in every}) == len({j for _, j in every}) == len(every)
    assert all(first[i] == second[j] for i, j in every)
    back = list(range(5000))
    assert len(line_dedup.moved(back, back[::-1], [])) == 5000
