"""Packing, decontamination, pseudonyms, components and the pipeline."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from datetime import date, datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import components, decontamination, packing, pii, queries, storage
from llm.token_ids import WordIds
from tests.llm import brute
from tests.llm.helpers import SCHEMA, awkward, corpus, frame

tokenizers = pytest.importorskip("tokenizers")
PATH = queries.tokenizer("word_bpe_49k.json")


def check_packing(rows, pieces, length):
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text, *_ in rows:
        want[doc_id, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (2,)] += 1
    sequences = defaultdict(list)
    covered = Counter()
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        covered[p.doc_id] += p.length
        assert any(
            len(ids) == p.doc_tokens and zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
            for (d, ids) in want if d == p.doc_id
        )
    expected = Counter()
    for (doc_id, ids), n in want.items():
        expected[doc_id] += n * len(ids)
    assert covered == expected
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at and size > 0
            at += size
        assert at == length or (at < length and at & (at - 1) == 0)


@pytest.mark.parametrize("targets", [None, {"src0": 0.7, "src1": 0.1}])
def test_every_token_is_packed_once(spark, monkeypatch, targets):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 8_192)
    monkeypatch.setattr(packing, "CHUNK_GROUP", 3)
    rows = corpus(11)
    pieces = packing.pack_documents(frame(spark, rows), PATH, 512, targets, 4).collect()
    check_packing(rows, pieces, 512)


def test_windows_hold_the_mixture(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "of"]) for _ in range(rnd.randint(50, 900))), "en", f"s{i % 3 // 2}", 0) for i in range(120)]
    pieces = packing.pack_documents(frame(spark, rows), PATH, 256, {"s0": 0.25}, 8).collect()
    windows = defaultdict(Counter)
    for p in pieces:
        windows[p.sequence_id // 8][p.source] += p.length
    for number in sorted(windows)[:5]:
        assert abs(windows[number]["s0"] / sum(windows[number].values()) - 0.25) < 0.01


def test_prefix_sums_of_chunks_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_GROUP", 4)
    rnd = random.Random(9)
    sizes = [(q, c, rnd.randrange(1, 99)) for q in ("", "=a", "=b") for c in rnd.sample(range(60), 25)]
    got = packing.before_chunks(spark.createDataFrame(sizes, "queue string, chunk int, size long")).collect()
    want = {
        (q, c): (sum(n for x, d, n in sizes if x == q and d < c), sum(n for x, _, n in sizes if x == q)) for q, c, _ in sizes
    }
    assert {(r.queue, r.chunk): (r.before, r.queue_size) for r in got} == want and len(got) == len(sizes)


def test_the_target_mixture_holds_over_shards(spark, monkeypatch):
    """A source with a third of all tokens gets its target in every shard, until the others run out."""
    monkeypatch.setattr(packing, "SHARD_TOKENS", 16_384)
    monkeypatch.setattr(packing, "CHUNK_GROUP", 2)
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "of"]) for _ in range(rnd.randint(50, 400))), "en", "src0" if i % 3 == 0 else f"src{i % 7}", 0) for i in range(900)]
    rows += [(1000 + i, None, None, None, None) for i in range(5)]
    pieces = packing.pack_documents(frame(spark, rows), PATH, 256, queries.MIXTURE, 8).collect()
    check_packing(rows, pieces, 256)
    shards = defaultdict(Counter)
    for p in pieces:
        shards[p.sequence_id >> 32][p.source] += p.length
    totals = sum(shards.values(), Counter())
    # Shares while nothing has run out: tokens of all when the first of the pools is used up.
    until = min(totals[x] / share for x, share in queries.MIXTURE.items())
    until = min(until, sum(n for x, n in totals.items() if x not in queries.MIXTURE) / (1 - sum(queries.MIXTURE.values())))
    full = [s for s in sorted(shards) if (s + 1) * 16_384 <= until]
    assert len(full) >= 4
    for shard in full:
        for name, share in queries.MIXTURE.items():
            assert abs(shards[shard][name] / sum(shards[shard].values()) - share) < 0.05


def test_deficits_are_carried():
    queues = {"a": [(1, 100)], "b": [(2, 50)]}
    out = list(packing.deficit_round_robin(queues, {"a": 2 / 3, "b": 1 / 3}, {"a": -20.0, "b": 20.0}, 30))
    assert out[0] == (2, 0, 30) and sum(size for _, _, size in out) == 150
    assert out[1][:2] == (1, 0) and out[1][2] == 20
    assert packing.sequence_sizes(1029, 512) == [512, 512, 4, 1]


def test_ids_equal_the_tokenizers():
    rnd = random.Random(1)
    letters = "abcZ'sStl 0½²ÀÉßñĀİıΣσς́  \u0085\x1c\n\t.,!?-你好😀क"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    texts += ["<|endoftext|>", "a<|endoftext|>b c", "I'm can't we'll", "", None]
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    want = [tokenizer.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]
    fast, slow = WordIds(PATH, 2), WordIds(PATH, 2)
    slow.by_words = False
    for known in (fast, slow, fast):
        ids, counts = known.encode(pa.array(texts, pa.string()))
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def plant(rnd, item, edits):
    words = item.split()
    for _ in range(edits):
        at = rnd.randrange(len(words))
        kind = rnd.choice("sid")
        if kind == "s":
            words[at] = f"zz{rnd.randrange(999)}"
        elif kind == "i":
            words.insert(at, f"qq{rnd.randrange(999)}")
        else:
            del words[at]
    return " ".join(words)


def test_planted_items_are_found_and_clean_texts_left(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, 60)))) for i in range(40)]
    rows, truth = [], set()
    for i in range(200):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 120))]
        if i % 2:
            item = rnd.choice(items)
            allowed = decontamination.tolerance(len(item[1].split()))
            at = rnd.randrange(len(words) + 1)
            words[at:at] = plant(rnd, item[1], rnd.randint(0, allowed)).title().split()
            truth.add((i, item[0]))
        rows.append((i, ", ".join(words), "en", "s", 0))
    rows += [(500, None, None, None, None), (501, "", "en", "s", 0)]
    benchmark = spark.createDataFrame(
        [*items, (97, "too short"), (98, None), (99, "")], "item_id long, text string"
    )
    docs = frame(spark, rows)
    exact = set()
    for doc_id, text, *_ in rows:
        words = brute.normal_words(text)
        for item_id, item in items:
            goal = brute.normal_words(item)
            if words and brute.edit_distance_within(goal, words) <= decontamination.tolerance(len(goal)):
                exact.add((doc_id, item_id))
    found = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(docs, benchmark).collect()}
    assert set(found) <= exact
    assert len(set(found)) >= 0.97 * len(exact) and len(truth & set(found)) >= 0.97 * len(truth)
    kept = {r.doc_id for r in decontamination.drop_leaking(docs, benchmark).collect()}
    assert kept == {r[0] for r in rows} - {d for d, _ in found}


def test_benchmark_in_several_blocks(spark, monkeypatch):
    rnd = random.Random(9)
    items = [(i, " ".join(f"v{rnd.randrange(500)}" for _ in range(20))) for i in range(30)]
    rows = [(i, f"before it {item} and after", "en", "s", 0) for i, item in items]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame(spark, rows), benchmark).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 8)
    many = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame(spark, rows), benchmark).collect()}
    assert one == many == {(i, i) for i in range(30)}


def test_samples_select(spark):
    rnd = random.Random(6)
    texts = [" ".join(f"v{rnd.randrange(90)}" for _ in range(30)) for _ in range(60)]
    items = decontamination.items_of(list(range(60)), texts)
    other = decontamination.items_of(list(range(60)), [" ".join(f"v{rnd.randrange(90)}" for _ in range(30)) for _ in range(60)])
    window, _ = decontamination.candidates(other.rows, other.sizes, items)
    assert len(window) < 0.2 * 60 * 60
    window, item = decontamination.candidates(items.rows, items.sizes, items)
    assert {(i, i) for i in range(60)} <= set(zip(window.tolist(), item.tolist(), strict=True))


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else d * 2 // 10 + d * 2 % 10 for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_format_and_links(spark):
    text = (
        "mail a.b@mail.example.com, card 4111 1111 1111 1111 or 4111111111111111, not 4111111111111112;"
        " born 1990-02-28 not 1990-02-30; 123-45-6789; +1 (212) 555-0187; 10.20.30.40 not 300.1.2.3"
    )
    rows = [(1, text, "en", "s", 0), (2, "again 4111 1111 1111 1111 and 10.20.30.40", "en", "s", 0), (3, None, None, None, None), (4, "", "", "", 0)]
    got = {r.doc_id: r for r in pii.pseudonymize(frame(spark, rows), "k").collect()}
    new = got[1].text
    for gone in ("a.b@mail", "4111 1111 1111 1111", "4111111111111111,", "1990-02-28", "123-45-6789", "555-0187", "10.20.30.40"):
        assert gone not in new
    for kept in ("not 4111111111111112", "not 1990-02-30", "not 300.1.2.3", "+1 (212) "):
        assert kept in new
    shape = re.sub(r"user\d+@example.com", "M", re.sub(r"\d", "9", new))
    cards = re.findall(r"card ([\d ]+) or (\d+)", new)[0]
    assert luhn(cards[0]) and cards[0].replace(" ", "") == cards[1]
    assert cards[0] in got[2].text and shape.count("9999 9999 9999 9999") == 1
    assert got[1].n_pseudonyms == 7 and got[2].n_pseudonyms == 2
    assert got[3].text is None and got[4].text == "" and got[3].n_pseudonyms == 0
    other = pii.pseudonymize(frame(spark, rows), "another key").filter("doc_id = 2").first()
    assert other.text != got[2].text


def test_values_beside_other_numbers_are_found(spark):
    card, phone = "4111111111111111", "555-123-4567"
    fours, amex = "4111 1111 1111 1111", "3782 822463 10005"
    texts = [
        f"ref 12 {card}", f"{card} 123", f"24 7 {phone}", f"2024 {phone}", f"{phone} 555-987-6543", f"{card} {card}",
        f"2024 {fours}", f"1234 5678 {fours} 9012", f"{fours} 123", f"{fours} {fours}", f"{fours} {phone}",
        f"12 {amex}", f"{fours} 2024-01-15", "1 2 3 4 5 6 7 8 9 10 11", f"{phone} 4111-1111-1111-1111",
    ]
    counts = [1, 1, 1, 1, 2, 2, 1, 1, 1, 2, 2, 1, 2, 0, 2]
    rows = [(i, x, "en", "s", 0) for i, x in enumerate([card, phone, fours, amex, *texts])]
    got = {r.doc_id: r for r in pii.pseudonymize(frame(spark, rows), "k").collect()}
    new = {x: got[i].text for i, x in enumerate((card, phone, fours, amex))}
    for i, (text, count) in enumerate(zip(texts, counts, strict=True), 4):
        want = text
        for old in (card, fours, amex, phone):
            want = want.replace(old, new[old])
        assert got[i].n_pseudonyms == count, (text, got[i])
        if not any(x in text for x in ("987", "01-15", "4111-")):
            assert got[i].text == want, (text, got[i])
        assert len(got[i].text) == len(text)


def test_permutations_are_permutations(spark):
    from pyspark.sql import functions as F

    digits = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    new = [r[0] for r in digits.select(pii.permuted_digits(F.lit("k"), "x", F.col("d"))).collect()]
    assert len(set(new)) == 1000 and all(len(x) == 3 for x in new)
    one = digits.select(F.substring("d", 3, 1).alias("d")).distinct()
    assert len({r[0] for r in one.select(pii.permuted_digits(F.lit("k"), "x", F.col("d"))).collect()}) == 10
    days = spark.range(189 * 773).select(
        pii.permuted(F.lit("k"), "date", F.col("id"), F.lit(189).cast("long"), F.lit(773).cast("long")).alias("n")
    )
    row = days.agg(F.countDistinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(row) == (189 * 773, 0, 189 * 773 - 1)


def test_dates_and_numbers_in_usual_forms(spark):
    born = ["1990-02-28", "1990/02/28", "1990.02.28", "28.02.1990", "02/28/1990", "02-28-1990", "2/28/1990", "Feb 28, 1990", "28 February 1990", "1990-02-28T10:00:00Z"]
    one_each = [
        "1700-01-01", "+44 20 7946 0958", "020 7946 0958", "+442079460958", "+33 1 42 68 53 00", "01 42 68 53 00", "123 45 6789",
        "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "2001:db8::1", "2001:0db8:85a3:0000:0000:8a2e:0370:7334",
        "fe80::1", "Ann.Lee99@mail.example.com", "28/02/1990", "31-12-2001", "AB12 4111 1111 1111 1111 x", "1 2 3 4 5 6 555-123-4567 9",
    ]
    none = [
        "99/99/2020", "30/02/1990", "1200-01-01", "DE89370400440532013001", "12:30:45", "a::b std::vector", "version 1.2.3", "in May 2020",
        "0 1 2", "room 101", "1990-02-28x", "10 000 000",
    ]
    texts = [f"x {t}, y" for t in (*born, *one_each, *none)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = [r for r in pii.pseudonymize(frame(spark, rows), "k").orderBy("doc_id").collect()]
    for row, text in zip(got, texts, strict=True):
        assert row.n_pseudonyms == (row.doc_id < len(born) + len(one_each)), (text, row)
        assert (row.text == text) == (not row.n_pseudonyms), (text, row)
    day = date.fromisoformat(got[0].text[2:12])
    forms = ["%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%d.%m.%Y", "%m/%d/%Y", "%m-%d-%Y", None, None, None, "%Y-%m-%dT10:00:00Z"]
    want = [day.strftime(x) if x else None for x in forms]
    want[6:9] = [f"{day.month}/{day.day}/{day.year}", f"{day:%b} {day.day}, {day.year}", f"{day.day} {day:%B} {day.year}"]
    assert [r.text[2:-3] for r in got[: len(born)]] == want
    new = {old: got[len(born) + i].text[2:-3] for i, old in enumerate(one_each)}
    for value in ("GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"):
        plain = new[value].replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 and plain[:2] == value[:2]
    for value in ("28/02/1990", "31-12-2001"):
        assert int(new[value][:2]) > 12 and datetime.strptime(new[value].replace("-", "/"), "%d/%m/%Y")
    assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", new["Ann.Lee99@mail.example.com"][:-4]))) == "Aaa.Aaa99@aaaa.aaaaaaa"
    assert new["2001:db8::1"].split(":")[5:] == new["fe80::1"].split(":")[5:]


def digest_number(key, label, value, size):
    return int(hashlib.sha256(f"{key}|{label}|{size}|{value}".encode()).hexdigest()[:15], 16) % size


def undone(key, label, value, left_size, right_size):
    """Plain inverse of the network over numbers."""
    left, right = divmod(value, right_size)
    for number in range(pii.ROUNDS // 2, 0, -1):
        right = (right - digest_number(key, label, f"{number}|r|{left}", right_size)) % right_size
        left = (left - digest_number(key, label, f"{number}|l|{right}", left_size)) % left_size
    return left * right_size + right


def undone_name(key, name):
    """Plain inverse of the network over names."""
    halves = [name[: len(name) // 2], name[len(name) // 2 :]]
    for number in reversed(range(pii.ROUNDS)):
        half, by = halves[number % 2], halves[1 - number % 2]
        digest = hashlib.sha256(f"{key}|name|{number}|{len(half)}|{by.lower()}".encode()).digest()
        out = ""
        for place, char in enumerate(half):
            first, size = next(((f, n) for f, n in ((97, 26), (65, 26), (48, 10)) if f <= ord(char) < f + n), (0, 0))
            out += chr((ord(char) - first - digest[place % 32]) % size + first) if size else char
        halves[number % 2] = out
    return "".join(halves)


def test_the_key_inverts_pseudonyms_and_is_in_no_plan(spark):
    rnd = random.Random(5)
    letters = "abcxyzABZ0189._%+-"
    rows = [
        (
            i,
            f"{''.join(rnd.choices(letters, k=rnd.randrange(1, 90)))}@{''.join(rnd.choices('abz09', k=rnd.randrange(1, 9)))}.org"
            f" {rnd.randrange(1800, 2200)}-{rnd.randrange(1, 13):02}-{rnd.randrange(1, 29):02}"
            f" {rnd.randrange(1000):03}-{rnd.randrange(100):02}-{rnd.randrange(10**4):04} {'.'.join(str(rnd.randrange(256)) for _ in range(4))}",
            None, None, None,
        )
        for i in range(60)
    ]
    secret = "a key, not to be seen"
    out = pii.pseudonymize(frame(spark, rows), secret)
    start = date(1800, 1, 1).toordinal()
    for row in out.collect():
        mail, day, social, address = row.text.split(" ")
        number = undone(secret, "date", date.fromisoformat(day).toordinal() - start, *pii.DAYS)
        digits = undone(secret, "social", int(social.replace("-", "")), 10**5, 10**4)
        whole = undone(secret, "address", int.from_bytes(bytes(map(int, address.split(".")))), 65536, 65536)
        back = [
            undone_name(secret, mail[:-3]) + "org", date.fromordinal(number + start).isoformat(),
            f"{digits:09}"[:3] + "-" + f"{digits:09}"[3:5] + "-" + f"{digits:09}"[5:], ".".join(map(str, whole.to_bytes(4))),
        ]
        assert back == rows[row.doc_id][1].split(" ")
    plans = out._jdf.queryExecution().toString()
    assert secret not in plans and "Python" not in plans and "RDD" not in plans.replace("LogicalRDD", "").replace("ExistingRDD", "")


def test_day_first_dates_are_permuted_among_themselves(spark):
    days = [date(1996, m, d) for m in range(1, 13) for d in range(13, 29)] + [date(1400, 1, 13), date(2599, 12, 31)]
    rows = [(i, f"{d:%d/%m/%Y}", None, None, None) for i, d in enumerate(days)]
    new = [r.text for r in pii.pseudonymize(frame(spark, rows), "k").collect()]
    assert len(set(new)) == len(days) and all(int(x[:2]) > 12 and int(x[3:5]) < 13 for x in new)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(1, 300)] + [(1000, 1001), (1001, 1002), (2000, 2000), (7, 1)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    roots = {r.node: r.root for r in components.components(df).collect()}
    assert {roots[i] for i in range(1, 301)} == {1} and {roots[i] for i in (1000, 1001, 1002)} == {1000}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(
    "work",
    [lambda df: packing.pack_documents(df, PATH), lambda df: pii.pseudonymize(df, "k")],
)
def test_empty_tables_and_clashing_columns(spark, work):
    assert work(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = corpus(6, 12)
    assert work(awkward(spark, rows)).count() == work(frame(spark, rows)).count()


def test_empty_benchmark(spark):
    docs = awkward(spark, corpus(6, 12))
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(docs, none).count() == 0
    assert decontamination.drop_leaking(docs, none).count() == docs.count()
    assert decontamination.drop_leaking(docs.limit(0), none).columns == docs.columns


def test_shuffle_files_of_a_written_table_go(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in found.mkString(" ").split() if "shuffle_" in x}

    before, was = files(), spark.conf.get(storage.SHUFFLES_GO)
    table = storage.written(spark.range(1_000).repartition(3, "id").groupBy((F.col("id") % 7).alias("id")).count(), "some")
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(storage.SHUFFLES_GO) == was
    assert sorted(r["count"] for r in table.collect()) == [142] + [143] * 6



def test_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    assert storage.shared_folder(spark)
    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "local-cluster[2,1,1024]", "getCheckpointDir": staticmethod(lambda: None)})
    with pytest.raises(RuntimeError):
        storage.shared_folder(Elsewhere)


def test_short_items_and_scripts_without_spaces_are_found(spark):
    chinese = "今天天气很好我们一起去公园散步吧明天也许会下雨请带伞"
    items = [(1, "four words of text"), (2, "Single"), (3, chinese), (4, "ภาษาไทยไม่มีวรรค"), (5, "..."), (6, "two  Words!"), (7, "短い"), (8, "two words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = {
        1: "Four words, of text", 2: "here are four words of text, inside", 3: "four words of a text", 4: "a single one", 5: "singles",
        6: chinese, 7: f"前面，{chinese[:12]}x{chinese[13:]}。後面", 8: chinese[::-1], 9: "อะไร ภาษาไทยไม่มีวรรค นะ", 10: "two words two", 11: "two. other words",
        12: "長い文と短い文", 13: None, 14: "", 15: "plain text with none of them", 16: "four words of", 17: "text",
    }
    docs = frame(spark, [(i, t, None, None, None) for i, t in texts.items()])
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(docs, benchmark).collect()}
    assert set(got) == {(1, 1), (2, 1), (4, 2), (6, 3), (7, 3), (9, 4), (10, 6), (10, 8), (12, 7)}
    assert got[2, 1].start_word == 2 and got[10, 6].start_word == 0 and got[7, 3].n_edits > 0
    assert all(r.n_edits == 0 for k, r in got.items() if k != (7, 3))
    kept = {r.doc_id for r in decontamination.drop_leaking(docs, benchmark).collect()}
    assert kept == set(texts) - {d for d, _ in got}


def test_characters_apart_leave_other_words_whole():
    for text, want in [("ab 한국어 é", 3), ("中a文b", 4), ("Ａｂ，中。", 2), ("𠀀𠀁x", 3), ("plain", 1), ("“quoted”", 1)]:
        raw = np.frombuffer(text.encode(), np.uint8)
        hashes, offsets = decontamination.normal_words(np.concatenate((raw, raw)), np.array([0, len(raw), 2 * len(raw)]))
        assert offsets.tolist() == [0, want, 2 * want] and (hashes[:want] == hashes[want:]).all()


def test_a_piece_is_given_to_the_model_once():
    from types import SimpleNamespace

    from llm.token_ids import Pieces, byte_letters

    asked = []

    def tokenize(piece):
        asked.append(piece)
        return [SimpleNamespace(id=ord(x)) for x in piece]

    pieces = Pieces(SimpleNamespace(tokenize=tokenize), byte_letters())
    place = np.array([pieces[x] for x in ("ab", "\n", "c", "ab", "é")])
    flat, size = pieces.ids_of(place)
    assert asked == ["ab", "c", "Ã©"] and size.tolist() == [2, 0, 1, 2, 2]
    assert "".join(map(chr, flat)) == "abcabÃ©"
