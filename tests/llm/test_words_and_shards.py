"""Spelling variants, alignment of tokenizers, and shards, against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from llm import alignment, queries, sharding, spelling
from tests.llm import brute
from tests.llm.helpers import SCHEMA, awkward, corpus, frame

BYTE_LEVEL = queries.tokenizer("byte_bpe_50k.json")
PIECES = queries.tokenizer("piece_bpe_32k.model")
VARIANTS = ("word", "form", "root", "n", "n_near", "form_n")
ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
key = str


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


def misspelt_texts(seed, size, letters="aé"):
    rnd = random.Random(seed)
    known = ["".join(rnd.choice(letters) for _ in range(rnd.randint(4, 8))) for _ in range(60)]
    weights = [1 / (i + 1) for i in range(len(known))]
    out = []
    for i in range(size):
        words = rnd.choices(known, weights, k=rnd.randint(0, 80))
        out.append((i, " ".join(w.upper() if rnd.random() < 0.1 else w for w in words), "en", "s", 0))
    return out


AWKWARD_WORDS = [
    "ÀÉÎ×÷ÿß straße strasse strase naïve naive",
    "it's o'clock x1y2z3 under_score",
    "中文abĀcde fghijſ",
    "abcde" * 30 + " " + "abcde" * 30 + "x",
    "Q" * 5_000,
]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_match_plain_version(spark, monkeypatch, seed):
    monkeypatch.setattr(spelling, "RANGE_CHARS", 400)
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    rows = misspelt_texts(seed, 60) + [(1000 + i, t, None, None, None) for i in range(4) for t in AWKWARD_WORDS]
    rows += [(2000 + i, "zebra " * 4 + "zebras " * (i < 12) + "zebrass " * (i < 4), "", "", 0) for i in range(20)]
    rows += [(None, rows[3][1], None, None, None), rows[4], rows[4], (7, None, "", "", 1), (8, "", "", "", 1)]
    want = sorted(brute.spelling_variants(pairs(rows)), key=key)
    assert plain(spelling.spelling_variants(frame(spark, rows)), *VARIANTS) == want
    assert any(w[1] and w[1] != w[2] for w in want) and any(w[4] > 3 for w in want)


def test_variants_of_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.limit(25).collect()]
    want = sorted(brute.spelling_variants(rows), key=key)
    assert plain(spelling.spelling_variants(frame(spark, [(*r, None, None, None) for r in rows])), *VARIANTS) == want


def test_given_words_of_any_length(spark):
    rnd = random.Random(4)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 6))): rnd.randint(1, 40) for _ in range(90)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: r for r in spelling.group_variants(table).collect()}
    assert set(got) == set(words)
    for w, r in got.items():
        near = [v for v in words if brute.one_apart(w, v)]
        assert r.n_near == len(near)
        best = min(near, key=lambda v: (-words[v], v), default=None)
        assert r.form == (best if near and words[best] >= 2 * words[w] else None)


def test_checksum_is_carried():
    ids, runs = ["12", "", "987654321"], [b"a", b"word", "é".encode(), b"x" * 64]
    carried = spelling.crc_after(np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32), 64)
    for i, text in enumerate(ids):
        for run in runs:
            assert int(carried[len(run), i]) ^ zlib.crc32(run) == zlib.crc32(f"{text}:".encode() + run)


AWKWARD_TEXTS = [
    "plain words here, with punctuation; and 1234 numbers.",
    " leading", "trailing ", " ", "  ", "\n", "a\n\n b\t\tc  d", " x  y  z　 w\u0085 v",
    "中文字符 mixed with 日本語 and ไทย", "🙂🙃👩‍👩‍👧 emoji 𝔘𝔫𝔦", "é combining ﬁ ligature", "\x00 nul \x1f \x7f x",
    "<|endoftext|> <s> </s> <unk> <0x0A> text", "has ▁ mark", "▁", "<0x41>", "ends with ▁",
    "it's we'll 'tis don't''s", "a  b   c    d     e", "=" * 300, "aaaaaaaaaaaaaaaa" * 40, "\U0010ffff퟿",
    "x" * 3_000 + " " + "y z " * 500, "▁a b", "“quoted” – dashes… end",
]


def alignment_rows():
    rows = [(i, t, None, None, None) for i, t in enumerate(AWKWARD_TEXTS)]
    rows += [(100 + r[0] if r[0] is not None else None, *r[1:]) for r in corpus(5, 15)]
    rnd = random.Random(3)
    odd = "ab é中\n\t 🙂▁.,'  𝔘0 "
    rows += [(500 + i, "".join(rnd.choice(odd) for _ in range(rnd.randint(1, 60))), None, None, None) for i in range(150)]
    return rows


@pytest.mark.parametrize(("shared", "known", "learned"), [(1 << 20, 400_000, 1 << 15), (40, 60, 64)])
def test_alignment_matches_plain_version(spark, monkeypatch, shared, known, learned):
    monkeypatch.setattr(alignment, "KNOWN_CHUNKS", known)
    monkeypatch.setattr(alignment, "LEARNED_BYTES", learned)
    rows = alignment_rows()
    got = alignment.align_documents(frame(spark, rows), BYTE_LEVEL, PIECES, shared)
    want = sorted(brute.alignment(pairs(rows), BYTE_LEVEL, PIECES), key=key)
    assert plain(got, *ALIGNED) == want
    assert sum(w[3] == 0 for w in want) > 5


def test_spans_are_refined():
    t = alignment.Tokenizers(BYTE_LEVEL, PIECES)
    assert t.by_chunks
    for text in AWKWARD_TEXTS:
        raw = np.frombuffer((" " + text).encode(errors="surrogatepass"), np.uint8)
        if "▁" in text or "퟿" in text:
            continue
        for vocabulary, (ids, ends) in (
            (t.vocabulary_a, t.tokens_a(" " + text, raw)), (t.vocabulary_b, t.tokens_b(" " + text)),
        ):
            assert ends.tolist() == np.cumsum(vocabulary.size[ids]).tolist(), text
            assert vocabulary.decoded(ids).tobytes() == raw.tobytes()


def test_wide_groups_count_all_links(monkeypatch):
    rnd = np.random.default_rng(1)
    a, b = rnd.integers(0, 9, 300), rnd.integers(0, 9, 200)
    group_a, group_b = np.sort(rnd.integers(0, 4, 300)), np.sort(rnd.integers(0, 4, 200))
    plain_links = Counter()
    for x, g in zip(a, group_a, strict=True):
        plain_links.update((int(g), int(x) << 32 | int(y)) for y, h in zip(b, group_b, strict=True) if g == h)
    for limit in (1, 1 << 16):
        monkeypatch.setattr(alignment, "WIDE_GROUP", limit)
        found = Counter()
        for g, p, n in zip(*alignment.linked(a, b, group_a, group_b, 4), strict=True):
            found[int(g), int(p)] += int(n)
        assert found == plain_links


def test_most_frequent_pairs_are_bounded(spark):
    counts = spark.range(1, 2_000).selectExpr("id as pair", "id as documents")
    for most in (0, 1, 100, 5_000):
        some, rest = alignment.most_frequent(counts, most)
        assert some.count() <= most and some.count() + rest.count() == 1_999


def rendezvous(doc_id, weights):
    """The shard of an id by the definition."""
    best = []
    for i, w in enumerate(weights):
        seed = 42
        if doc_id is not None:
            seed = xxhash.xxh64(doc_id.to_bytes(8, "little", signed=True), seed=seed).intdigest()
        u = ((xxhash.xxh64(i.to_bytes(4, "little"), seed=seed).intdigest() >> 11) + 0.5) / 2**53
        if w:
            best.append((-w / np.log(u), -i))
    return -max(best)[1]


def test_shards_follow_the_rule(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 2)
    monkeypatch.setattr(sharding, "SPAN_CHUNKS", 3)
    monkeypatch.setattr(sharding, "FOLDED_ROWS", 4)
    rows = corpus(1) + [corpus(1)[9]] * 30 + [(-5 - i, "é" * i, None, None, None) for i in range(300)]
    got = sharding.shard_documents(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for doc_id, text in pairs(rows):
        data = (text or "").encode()
        shard, grown = rendezvous(doc_id, [1.0] * 8), rendezvous(doc_id, [1.0] * 9)
        assert grown in (shard, 8)
        want[doc_id, len(data) + 1, zlib.crc32(data), "key", shard, grown] += 1
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    for shard in range(8):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    again = sharding.shard_documents(frame(spark, rows[::-1]).repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_shares_follow_weights_and_few_rows_move(spark):
    docs = spark.range(40_000).select("id", "id").toDF("doc_id", "text")
    weights = (1.0, 2.0, 0.0, 5.0)
    found = Counter(r.shard for r in sharding.assign_shards(docs, weights).collect())
    assert found[2] == 0
    for shard, weight in enumerate(weights):
        assert abs(found[shard] / 40_000 - weight / 8) < 0.01
    moved = sharding.moved_rows(docs, weights, (*weights, 2.0)).collect()
    assert {r.new_shard for r in moved} == {4} and abs(len(moved) / 40_000 - 0.2) < 0.01
    left = sharding.moved_rows(docs, weights, (1.0, 0.0, 0.0, 5.0)).collect()
    assert {r.old_shard for r in left} == {1} and len(left) == found[1]
    with pytest.raises(ValueError):
        sharding.assign_shards(docs, (0.0, 0.0))


def test_shards_are_written_whole(spark, tmp_path):
    rows = corpus(2)
    sharding.write_shards(frame(spark, rows), str(tmp_path / "out"), (1.0, 1.0, 2.0), ("text",), 5)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert Counter(r.text for r in got) == Counter(r[1] for r in rows)
    assert all(len({r.shard for r in got if r.text == text}) == 1 for text in {r.text for r in got})


WORK = [
    (spelling.spelling_variants, VARIANTS),
    (lambda df: alignment.align_documents(df, BYTE_LEVEL, PIECES), ALIGNED),
    (sharding.shard_documents, ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")),
]


@pytest.mark.parametrize(("work", "columns"), WORK)
def test_empty_tables_and_clashing_columns(spark, work, columns):
    empty = work(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and tuple(empty.columns) == columns
    rows = corpus(6, 12) * 3
    clashing = awkward(spark, rows)
    for name in ("n", "word", "pairs", "shard", "slot", "size", "law", "row", "node", "n_a"):
        clashing = clashing.withColumn(name, clashing["doc_id"])
    assert plain(work(clashing), *columns) == plain(work(frame(spark, rows)), *columns)
