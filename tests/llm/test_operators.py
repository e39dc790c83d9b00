"""Operators against plain Python versions, on odd rows and on empty tables."""

import bisect
import hashlib
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from llm_tables import SCHEMA, as_docs, make_words, no_docs, odd, odd_docs  # noqa: F401 - fixtures
from pyspark.sql import functions as F

from fleetlake.llm import (
    bpe, copies, decontaminate, kneser_ney, language_id, line_dedup, piecewise, sharding, simhash,
    substring_dedup, toxicity,
)
from fleetlake.llm.common import crc_bucket

key = lambda row: tuple((x is None, x) for x in row)


def same(found, wanted):
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)


# -- line dedup -------------------------------------------------------------------


def test_line_dedup(odd_docs, odd):
    found = line_dedup.line_dedup(odd_docs).select("doc.doc_id", "n_lines", "n_dropped", "kept_text")
    same(found.collect(), brute.line_dedup(odd))


def test_line_dedup_passes_columns(odd_docs, no_docs):
    found = line_dedup.line_dedup(odd_docs)
    assert found.select("doc.*").columns == odd_docs.columns
    assert line_dedup.line_dedup(no_docs).count() == 0


@pytest.mark.parametrize("line", ["  Ab\t", "\x0bÉCOLE Z", " x", "", " \r", "plain"])
def test_line_key(spark, line):
    got = spark.createDataFrame([(line,)], "t string").select(line_dedup.line_key(F.col("t"))).first()[0]
    assert got == brute.low(line.strip(" \t\n\x0b\x0c\r"))


# -- sharding ---------------------------------------------------------------------


def check_shards(found, rows, shards):
    assert len(found) == len(rows)
    places = {}
    for r in found:
        places.setdefault(r["text_sha256"], set()).add(r["shard"])
        assert 0 <= r["shard"] < shards
    assert all(len(p) == 1 for p in places.values())
    for s in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_shards_odd_rows(odd_docs, odd, no_docs):
    found = sharding.minimax_shards(odd_docs, 5).collect()
    check_shards(found, odd, 5)
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in odd), key=key)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=key) == want
    assert sharding.minimax_shards(no_docs, 5).count() == 0


@pytest.mark.parametrize("n, shards", [(60, 7), (4000, 40)])
def test_smallest_capacity(spark, n, shards):
    rng = random.Random(n)
    rows = sorted((hashlib.sha256(str(i).encode()).hexdigest(), rng.choice([17, 900, rng.randint(16, 60_000)]))
                  for i in range(n))
    sizes = [s for _, s in rows]
    groups = spark.createDataFrame(rows, "sha string, size long")
    capacity, starts = sharding.minimax_cuts(groups, shards, sum(sizes), max(sizes))
    assert capacity == brute.smallest_capacity(sizes, shards)
    sums = [0] * (len(starts) + 1)
    for sha, size in rows:
        sums[sum(sha >= s for s in starts)] += size
    assert len(sums) <= shards and max(sums) <= capacity


def test_equal_rows_are_numbered_in_parts(spark, odd, monkeypatch):
    monkeypatch.setattr(sharding, "_EQUAL_ROWS", 16)
    rows = odd + [(None, None)] * 50 + [(4, odd[3][1])] * 33 + [(4, "")] * 16 + [(i, "") for i in range(40)]
    found = sharding.minimax_shards(as_docs(spark, rows), 6).collect()
    check_shards(found, rows, 6)
    size = lambda t: len((t or "").encode("utf-8", "surrogatepass")) + 16
    same([(r["doc_id"], r["size"]) for r in found], [(i, size(t)) for i, t in rows])


def test_huge_group_has_its_own_shard(spark):
    rows = [(i, "same text " * 50) for i in range(300)] + [(1000 + i, f"text {i} " * 9) for i in range(600)]
    found = sharding.minimax_shards(as_docs(spark, rows), 10).collect()
    check_shards(found, rows, 10)
    sums = {}
    for r in found:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    rest = sorted(sums.values())[:-1]
    assert len(rest) == 9 and max(rest) < 1.1 * min(rest)


# -- simhash ----------------------------------------------------------------------


def test_simhash_classes(odd_docs, odd, no_docs):
    found = simhash.simhash_classes(odd_docs).select("doc_id", "fp", "component_id")
    want = [(i, p - (1 << 64) if p >> 63 else p, c) for i, p, c in brute.simhash_classes(odd)]
    same(found.collect(), want)
    assert simhash.simhash_classes(no_docs).count() == 0


@pytest.mark.parametrize("bound", [2, 32])
def test_links_connect_all_near_fingerprints(spark, bound):
    """Also through the neighbours of long lists (a small bound makes lists long)."""
    rng = random.Random(bound)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for _ in range(rng.randint(0, 12)):  # chains of fingerprints 1 to 3 bits apart
            for b in rng.sample(range(64), rng.randint(1, 3)):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    linked = simhash.links(fps, 2, bound)
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 2 for r in linked.collect())
    root = {r["node"]: r["root"] for r in simhash.components(linked).collect()}
    want = brute.classes([p & (1 << 64) - 1 for p in prints])
    got = [root.get(p, p) for p in prints]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_one_of_each_class(spark, odd_docs, odd, no_docs):
    rows = odd + odd[3:6]
    kept = simhash.one_of_each_class(as_docs(spark, rows))
    assert kept.columns == odd_docs.columns
    cls = brute.classes([brute.simhash(t) for _, t in rows])
    first = {}
    for (i, _), c in zip(rows, cls):
        first[c] = min(first.get(c, 2**63 if i is None else i), 2**63 if i is None else i)
    assert sorted(2**63 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == sorted(first.values())
    assert simhash.one_of_each_class(no_docs).count() == 0


# -- substring dedup --------------------------------------------------------------


def test_remove_repeats(odd_docs, odd, no_docs, monkeypatch):
    want = brute.remove_repeats(odd)
    for size in (2_000, 10**9):  # many groups of documents, and a single one
        monkeypatch.setattr(substring_dedup, "GROUP_BYTES", size)
        same(substring_dedup.remove_repeats(odd_docs).collect(), want)
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_levels_double():
    assert substring_dedup.lengths(13) == [7, 13] and substring_dedup.lengths(5) == [5]
    assert substring_dedup.lengths(100) == [7, 13, 25, 50, 100]


@pytest.mark.parametrize("window, size", [(14, 2_000), (30, 2_000), (60, 20_000), (61, 10**9), (500, 5_000)])
def test_remove_repeats_long_windows(spark, odd, monkeypatch, window, size):
    rows = odd + [(7, odd[3][1] + " seven"), (7, "again " + odd[3][1]), (3, odd[3][1] + " three")]  # repeated ids
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", size)
    same(substring_dedup.remove_repeats(as_docs(spark, rows), window).collect(), brute.remove_repeats(rows, window))


@pytest.mark.parametrize("window", [2, 5])
def test_remove_repeats_short_windows(spark, window):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choices("abcdef", k=rng.randint(0, 30)))) for i in range(60)]
    same(substring_dedup.remove_repeats(as_docs(spark, rows), window).collect(), brute.remove_repeats(rows, window))


@pytest.mark.parametrize("size", [2_000, 10**9])
def test_remove_repeats_of_copied_rows(spark, odd, monkeypatch, size):
    """A third of all rows agree in id and text, others in the id alone; each is its own row."""
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", size)
    monkeypatch.setattr(substring_dedup, "_COPIES", 7)
    rows = odd + [(4, odd[3][1])] * 40 + [(None, None)] * 30 + [(None, odd[3][1])] * 8 + [(6, odd[3][1] + " six")] * 7
    same(substring_dedup.remove_repeats(as_docs(spark, rows)).collect(), brute.remove_repeats(rows))


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    """Where the first hash has three bits, the second one decides."""
    whole = substring_dedup.window_hashes
    second = substring_dedup.window_checks

    def weak(hashes, first, length):
        h, inside = whole(hashes, first, length)
        return h & np.uint64(7), inside

    rng = random.Random(31)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 40)))) for i in range(80)]
    w = substring_dedup.Words([t for _, t in rows])
    checks = second(w, 5)
    monkeypatch.setattr(substring_dedup, "window_hashes", weak)
    monkeypatch.setattr(substring_dedup, "window_checks", lambda words, length: checks)
    gone = substring_dedup.covered(w, np.arange(80), np.zeros(0, dtype=np.uint64), 5)
    lost = [int(gone[a:b].sum()) for a, b in zip(w.first[:-1], w.first[1:])]
    assert lost == [n for _, _, n, _ in brute.remove_repeats(rows, 5)] and sum(lost)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(5)
    for dtype in (np.uint64, np.int64, np.int32):
        parts = [rng.integers(0, 2**31, n).astype(dtype) for n in (0, 1, 5, 300)]
        column = pa.chunked_array([pa.array([substring_dedup._packed(x) for x in parts], type=pa.binary())])
        assert substring_dedup._cat(column, dtype).tolist() == np.concatenate(parts).tolist()
    assert not len(substring_dedup._cat(pa.chunked_array([], type=pa.binary()), np.int64))


# -- piecewise hashing ------------------------------------------------------------


def test_piecewise(spark, odd, no_docs):
    rows = [r for r in odd if r[0] is not None and r[0] != 11]
    found = {r["doc_id"]: r for r in piecewise.piecewise_fingerprints(as_docs(spark, rows)).collect()}
    rows.sort()
    assert len(found) == len(rows)
    for k, (i, t) in enumerate(rows):
        text, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = (text[:len(text) - half] + after[:half]).encode()
        r = found[i]
        own, other = piecewise.fingerprint(text.encode()), piecewise.fingerprint(after.encode())
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed).hexdigest()
        assert r["fingerprint"] == own and r["edited_fingerprint"] == piecewise.fingerprint(changed)
        assert 0.0 <= r["near_edited"] <= 1.0 and 0.0 <= r["near_next"] <= 1.0
        assert r["near_next"] == piecewise.likeness([own], [other])[0]
    assert found[4]["near_next"] == 1.0 and found[5]["near_next"] > 0.8
    assert piecewise.piecewise_fingerprints(no_docs).count() == 0


def test_piecewise_repeated_ids(odd_docs, odd):
    assert piecewise.piecewise_fingerprints(odd_docs).count() == len(odd)


def test_signature_distances():
    rng = random.Random(1)
    draw = lambda: "".join(rng.choices("ABCD", k=rng.choice([0, 1, 6, 40, 63, 64])))
    a, b = [draw() for _ in range(300)], [draw() for _ in range(300)]
    assert piecewise.distances(a, b).tolist() == [brute.edit_distance(x, y) for x, y in zip(a, b)]


def test_small_edit_keeps_most_of_a_fingerprint():
    text = " ".join(make_words(random.Random(2), 2000))
    edited = text[:4000] + "an inserted remark " + text[4000:]
    one, two, far = (piecewise.fingerprint(t.encode()) for t in (
        text, edited, " ".join(make_words(random.Random(3), 2000))))
    assert piecewise.likeness([one], [two])[0] > 0.85 > 0.3 > piecewise.likeness([one], [far])[0]


# -- decontamination --------------------------------------------------------------


def test_myers():
    rng = random.Random(4)
    for _ in range(500):
        p = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 15)))
        masks = {}
        for i, c in enumerate(p):
            masks[c] = masks.get(c, 0) | 1 << i
        assert decontaminate.myers_best(masks, len(p), t)[0] == brute.edit_distance(p, t, anywhere=True)


def mutate(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + "q" + text[at + 1:], text[:at] + text[at + 1:], text[:at] + "z" + text[at:]])
    return text


@pytest.mark.parametrize("block_bytes", [10**7, 300])
def test_benchmark_matches(spark, odd, no_docs, block_bytes):
    rng = random.Random(6)
    items = [(k, " ".join(make_words(rng, rng.randint(8, 40)))) for k in range(12)] + [(12, None), (13, ""), (14, "x")]
    rows = list(odd)
    for k in range(40):
        item = items[k % 12][1]
        hidden = mutate(rng, item, rng.randint(0, int(len(item) * 0.12)))
        rows.append((100 + k, " ".join(make_words(rng, 20)) + ". " + hidden.upper() + " - " + " ".join(make_words(rng, 9))))
    docs = as_docs(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in rows:
        text = decontaminate.compared(t)
        for k, item in items:
            item = decontaminate.compared(item)
            if len(item) >= decontaminate.MIN_CHARS:
                d = brute.edit_distance(item, text, anywhere=True) if len(text) < 5000 else 10**9
                if d <= int(len(item) * decontaminate.ERROR_RATE):
                    want.add((i, k, d))
            elif item and item == text:
                want.add((i, k, 0))
    assert len(want) > 20
    found = decontaminate.benchmark_matches(docs, bench, block_bytes=block_bytes)
    assert {tuple(r)[:3] for r in found.collect()} == want
    left = decontaminate.without_benchmark(docs, bench, block_bytes=block_bytes)
    assert left.columns == docs.columns
    bad = {i for i, _, _ in want}
    same(left.select("doc_id", "text").collect(), [(i, t) for i, t in rows if i not in bad])
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.benchmark_matches(docs, empty).count() == 0
    assert decontaminate.without_benchmark(docs, empty).count() == len(rows)
    assert decontaminate.benchmark_matches(no_docs, bench).count() == 0


def test_driver_summary_is_bounded(spark, monkeypatch):
    """Groups of some tenths of a share leave the capacity above the fair share."""
    rng = random.Random(2)
    rows = [(hashlib.sha256(f"2-{i}".encode()).hexdigest(), rng.randint(500, 1500)) for i in range(60_000)]
    share = sum(s for _, s in rows) // 40
    for i, part in enumerate([0.3, 0.5, 0.6, 0.7, 0.8]):
        rows[i] = (rows[i][0], int(part * share))
    rows.sort()
    held, summed = [], sharding._summed
    monkeypatch.setattr(sharding, "_summed", lambda *a: held.append(summed(*a)) or held[-1])
    sizes = [s for _, s in rows]
    groups = spark.createDataFrame(rows, "sha string, size long").coalesce(2).cache()
    capacity, starts = sharding.minimax_cuts(groups, 40, sum(sizes), max(sizes))
    assert max(map(len, held)) <= 20_000

    def cuts(limit):
        n, left = 1, limit
        for s in sizes:
            n, left = (n, left - s) if s <= left else (n + 1, limit - s)
        return n

    assert cuts(capacity) <= 40 < cuts(capacity - 1)
    shas = [s for s, _ in rows]
    at = [0, *(bisect.bisect_left(shas, s) for s in starts), len(rows)]
    assert max(sum(sizes[a:b]) for a, b in zip(at, at[1:])) == capacity


# -- toxicity ---------------------------------------------------------------------

INSULTS = ["idiot", "moron", "worthless", "scumbag"]


def toxic_table(n=400, disguise=lambda w: w, seed=9):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        w = make_words(rng, 30)
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            w.insert(rng.randrange(30), disguise(rng.choice(INSULTS)))
        rows.append((i, " ".join(w)))
        marks.append((i, int(bad)))
    return rows, marks


@pytest.fixture(scope="module")
def model(spark):
    rows, marks = toxic_table()
    labels = spark.createDataFrame(marks + [(1, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    return toxicity.train(as_docs(spark, rows + [(None, None)]), labels, F.lit(True))


@pytest.mark.parametrize("disguise", [
    lambda w: w, str.upper, lambda w: w.replace("i", "1").replace("o", "0").replace("s", "$"),
    lambda w: " ".join(w), lambda w: w.replace("o", "ooooo").replace("i", "iii"), lambda w: "-".join(w),
    lambda w: w + "!!!", lambda w: w[0] + "*." + w[1:]])
def test_disguised_words(spark, model, disguise):
    rows, marks = toxic_table(100, disguise, seed=10)
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(as_docs(spark, rows), model).collect()}
    caught = sum(found[i] >= toxicity.THRESHOLD for i, m in marks if m)
    wrong = sum(found[i] >= toxicity.THRESHOLD for i, m in marks if not m)
    assert caught >= 19 and wrong == 0


LEET = str.maketrans("aegiostlb", "439105718")


@pytest.mark.parametrize("disguise", [
    lambda w: w.translate(LEET), lambda w: w.replace("i", "!"), lambda w: w.replace("i", "!") + "!!",
    lambda w: " ".join(w.replace("i", "!")), lambda w: " ".join(w.translate(LEET)),
    lambda w: w.replace("s", "$$$").replace("o", "000"), lambda w: f"({w.translate(LEET)}),"])
@pytest.mark.parametrize("insult", INSULTS)
def test_one_disguised_word(model, insult, disguise):
    rng = random.Random(11)
    words = make_words(rng, 30)
    assert model.score(" ".join(words)) < toxicity.THRESHOLD
    words.insert(rng.randrange(30), disguise(insult))
    assert model.score(" ".join(words)) >= toxicity.THRESHOLD


@pytest.mark.parametrize("long", [
    lambda w: " ".join("youareandyouwillalwaysbeandeverybodyknows" + w), lambda w: w + w[-1] * 60,
    lambda w: " ".join(w + "andyouwillalwaysbeoneasfarasanybodyknows"),
    lambda w: w[:2] + w[2] * 60 + w[3:], lambda w: "/".join([*["word"] * 12, w.translate(LEET)]),
    lambda w: " ".join("you" * 20 + w.translate(LEET))])
@pytest.mark.parametrize("insult", INSULTS)
def test_long_disguise(model, insult, long):
    words = make_words(random.Random(12), 30)
    words.insert(9, long(insult))
    assert model.score(" ".join(words)) >= toxicity.THRESHOLD


def test_spaced_words_count(model):
    one, two = (model.sums("so " + "; ".join([" ".join("idiot")] * n)) for n in (1, 2))
    assert (one[3], two[3]) == pytest.approx((np.log1p(1), np.log1p(2)))
    assert model.sums(" ".join("idiotscumbagidiot"))[3] == pytest.approx(np.log1p(3))


def test_toxicity_odd_rows(spark, model, odd_docs, odd, no_docs):
    found = toxicity.toxicity_scores(odd_docs, model).collect()
    assert len(found) == len(odd) and all(0.0 <= r["score"] < toxicity.THRESHOLD for r in found)
    left = toxicity.without_toxic(odd_docs, model)
    assert left.columns == odd_docs.columns and left.count() == len(odd)
    assert toxicity.toxicity_scores(no_docs, model).count() == 0
    blank = toxicity.train(no_docs, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert {r["score"] for r in toxicity.toxicity_scores(odd_docs, blank).collect()} == {0.0}


# -- language model ---------------------------------------------------------------


@pytest.mark.parametrize("hot, order", [(0, 2), (20_000, 2), (20_000, 3), (0, 4)])
def test_kneser_ney(odd_docs, odd, no_docs, hot, order, monkeypatch):
    monkeypatch.setattr(kneser_ney, "HOT_WORDS", hot)
    trains = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    model = kneser_ney.train(odd_docs, F.coalesce(crc_bucket("doc_id", 5) != 1, F.lit(True)), order=order)
    found = kneser_ney.kneser_ney_scores(odd_docs, model).collect()
    want = brute.kneser_ney(odd, trains, order)
    by = lambda r: key((r[0], *r[1:4], round(r[4], 6)))
    got = sorted((tuple(r)[:6] for r in found), key=by)
    wanted = sorted(((i, *w) for (i, _), w in zip(odd, want)), key=by)
    assert [g[:4] for g in got] == [w[:4] for w in wanted]
    for g, w in zip(got, wanted):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9)
    assert kneser_ney.kneser_ney_scores(no_docs, model).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one(spark, order):
    rows = [(i, t) for i, t in enumerate(["a b a c", "b b", "a c d", "a b"])]
    model = kneser_ney.train(as_docs(spark, rows), F.lit(True), order=order)
    assert model.totals["V"] == 5
    for context in ["", "a", "b", "never", "a b", "b a", "a c"]:
        before = prefix(model, context)
        total = 10 ** (model.score([context])[3][0] - before)  # the text ends here
        for word in ["a", "b", "c", "d", "unseen"]:
            total += 10 ** (prefix(model, f"{context} {word}") - before)
        assert total == pytest.approx(1.0, rel=1e-9)


def prefix(model, text):
    """log10 probability of the words of a text without its end token."""
    if not text.strip():
        return 0.0
    tokens, contexts = kneser_ney.grams(kneser_ney.Words([text], lower=True), model.order)
    end, p = tokens[-1:], model.unigram(model.key_sums(1, tokens[-1:])[:, 2])
    for level, context in enumerate(contexts, 2):
        sums = model.key_sums(1 if level == 2 else level, context[-1:])
        p = model.step(level, model.gram_counts(level, context[-1:], end), sums, p)
    return model.score([text])[3][0] - np.log10(p[0])


def test_many_small_files_and_few_mappings(spark, tmp_path, monkeypatch):
    """100,000 buckets, of which a worker may hold 1,000 mapped."""
    monkeypatch.setattr(kneser_ney, "MAPS", 1_000)
    rng = random.Random(6)
    rows = [(i, " ".join(make_words(rng, 150))) for i in range(40)]
    docs = as_docs(spark, rows).coalesce(1)
    few = kneser_ney.train(docs, F.lit(True))
    folder = str(tmp_path / "many")
    hot = {2: np.zeros(0, dtype=np.uint64)}
    texts = docs.select("doc_id", "text")
    monkeypatch.setattr(kneser_ney, "TABLE_BYTES", 40)  # a word a bucket, about
    sums = kneser_ney.count_grams(texts, folder, 2, 100_000, hot).cache()
    many = kneser_ney.Model(folder, 2, 100_000, kneser_ney.write_tables(sums, folder, 2), hot, kneser_ney.totals_of(sums, 2))
    found = [many.score([t]) for _, t in rows]
    assert len(many.maps) == 1_000 and many.tables[1] > 1_000
    for got, (_, t) in zip(found, rows):
        assert [x[0] for x in got] == pytest.approx([x[0] for x in few.score([t])], rel=1e-12)


# -- tokenizer --------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    tables = pytest.importorskip("public_tokenizers")
    return str(tables.path("word_bpe_49k.json"))


def test_bpe(odd_docs, odd, no_docs, vocabulary):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    want = []
    for i, t in odd:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    same(bpe.bpe_digest(odd_docs, vocabulary).collect(), want)
    assert bpe.bpe_digest(no_docs, vocabulary).count() == 0


def test_bpe_random_texts(vocabulary):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    rng = random.Random(8)
    ranges = [(32, 127), (0xA0, 0x250), (0x370, 0x3E2), (0x400, 0x460), (0x4E00, 0x4E80), (0x1F600, 0x1F640)]
    texts = ["<|endoftext|>a<|startoftext|> B", "I'LL don't 'S", "ΟΔΟΣ σς İ ẞ", "a" * 3000, "\u0085\x1c x"]
    for _ in range(600):
        texts.append("".join(rng.choice([chr(rng.randrange(*rng.choice(ranges))), " ", "'", "e"]) for _ in range(40)))
    own = bpe.Bpe(vocabulary)
    for text, (ids, decoded) in zip(texts, own.encode_all(texts)):
        ids = np.frombuffer(ids, dtype="<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert decoded == library.decode(ids, skip_special_tokens=False) == own.decode(ids)


def test_bpe_long_words_by_heap(vocabulary, monkeypatch):
    rng = random.Random(12)
    texts = ["".join(rng.choices("abcdeé", k=n)) for n in (3, 50, 199, 400)]
    rows = [x for x, _ in bpe.Bpe(vocabulary).encode_all(texts)]
    monkeypatch.setattr(bpe, "LONG_WORD", 1)
    assert rows == [x for x, _ in bpe.Bpe(vocabulary).encode_all(texts)]


# -- language id ------------------------------------------------------------------


def test_gradients():
    rng = np.random.default_rng(0)
    net = language_id.Network(["a", "b", "c"], hidden=4)
    data = rng.integers(97, 123, (6, 5)).astype(np.uint8)
    real = (np.arange(6)[:, None] < np.array([6, 3, 6, 1, 5])[None]).astype(np.float32)
    label = np.array([0, 1, 2, 0, 1])
    _, grads = net.gradients(data, real, label)
    for p, g in zip(net.params(), grads):
        for _ in range(6):
            at = (rng.integers(p.shape[0]), int(rng.choice(data.ravel())) if p.shape[1] == 256 else rng.integers(p.shape[1]))
            was = p[at]
            p[at] = was + 1e-2
            up = net.gradients(data, real, label)[0]
            p[at] = was - 1e-2
            down = net.gradients(data, real, label)[0]
            p[at] = was
            assert abs((up - down) / 2e-2 - g[at]) < 1e-3


def test_language_id(spark, odd_docs, odd, no_docs):
    rng = random.Random(3)
    alphabets = {"aa": "abcdef ", "gg": "ghijkl ", "ñ": "ñéüößa "}
    rows = [(i, "".join(rng.choices(alphabets[lang], k=rng.randint(5, 300))), lang)
            for i, lang in enumerate(list(alphabets) * 60)]
    docs = spark.createDataFrame(rows + [(500, "abc", None), (501, None, "gg")], "doc_id long, text string, lang string")
    net = language_id.train(docs, F.col("doc_id") % 4 != 0)
    found = {r["doc_id"]: r for r in language_id.predict(docs, net).collect()}
    held = [(i, lang) for i, _, lang in rows if i % 4 == 0]
    assert sum(found[i]["lang_pred"] == lang for i, lang in held) >= 0.95 * len(held)
    assert found[501]["lang_pred"] == "und"
    for r in language_id.predict(odd_docs, net).collect():
        assert 0.0 <= r["score"] <= 1.0
    und = {r["doc_id"] for r in language_id.predict(odd_docs, net).collect() if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 17, 19, None}
    assert language_id.predict(no_docs, net).count() == 0
    none = language_id.train(no_docs, F.lit(True))
    assert {r["lang_pred"] for r in language_id.predict(odd_docs, none).collect()} == {"und"}


def test_schema_has_clashing_names():
    assert {"kept_text", "g", "h"} <= {c.split()[0] for c in SCHEMA.split(", ")}


def test_sharding_needs_few_jobs_on_many_partitions(spark):
    """One job a refinement, however many partitions a shuffle has."""
    rng = random.Random(8)
    rows = [(i, f"text {i} " * rng.randint(1, 40)) for i in range(4000)] + [(9000 + i, "one text " * 30) for i in range(700)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("few-jobs", "sharding")
    try:
        found = sharding.minimax_shards(as_docs(spark, rows), 40).collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    check_shards(found, rows, 40)
    assert jobs <= 60
    alone = max({r["text_sha256"] for r in found}, key=lambda h: sum(r["size"] for r in found if r["text_sha256"] == h))
    sizes = {}
    for r in found:
        if r["text_sha256"] != alone:
            sizes[r["text_sha256"]] = sizes.get(r["text_sha256"], 0) + r["size"]
    ordered = [sizes[h] for h in sorted(sizes)]
    sums = {}
    for r in found:
        if r["text_sha256"] != alone:
            sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    assert max(sums.values()) <= brute.smallest_capacity(ordered, 39)


# -- plain versions of what has no SQL form -------------------------------------------


def test_fingerprint_plainly():
    """Piece ends and characters one by one, over every block size from the smallest."""
    rng = random.Random(21)
    texts = ["", "a", "abc", "x" * 900, "\n" * 50, "é" * 300, " ".join(make_words(rng, 30)), " ".join(make_words(rng, 3000))]
    texts += ["".join(rng.choices("ab \n", k=rng.randint(1, 400))) for _ in range(40)]
    for text in texts:
        assert piecewise.fingerprint(text.encode()) == brute.ctph(text.encode()), text[:40]


def test_likeness_plainly():
    rng = random.Random(22)
    base = " ".join(make_words(rng, 800))
    prints = ["3::"] + [brute.ctph(t.encode()) for t in (
        base, base[:len(base) // 2], base + base, base.replace("ba", "ko"), base[500:], "short one", "short two", " ".join(make_words(rng, 800)))]
    pairs = [(a, b) for a in prints for b in prints]
    got = piecewise.likeness([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == pytest.approx([brute.ctph_likeness(a, b) for a, b in pairs])


def test_piecewise_on_one_id(spark):
    """A third of the rows on one id and as many without one: every row has its successor
    in the order of id and hash, and no range holds them all."""
    rng = random.Random(23)
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else 100 + i, f"text {i} " + " ".join(make_words(rng, 20))) for i in range(900)]
    docs = as_docs(spark, rows)
    found = piecewise.piecewise_fingerprints(docs).collect()
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = []
    for k, (i, text) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        want.append((i, hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()))
    same([(r["doc_id"], r["edited_sha256"]) for r in found], want)
    sizes = [r["count"] for r in piecewise.with_next(docs.select("doc_id", "text"), 16).groupBy("part").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 200


def test_piecewise_on_one_row(spark):
    """A third of the rows are one row and as many the same without an id: all copies but
    the last are followed by a copy, and no range gets them all."""
    rng = random.Random(31)
    hot = "hot row " + " ".join(make_words(rng, 60))
    rows = [(7 if i % 3 == 0 else None, hot) if i % 3 < 2 else (100 + i // 6, f"row {i // 2}") for i in range(1200)]
    found = piecewise.piecewise_fingerprints(as_docs(spark, rows)).collect()
    hashes = {r["text"]: r["h"] for r in as_docs(spark, rows).select("text", F.xxhash64("text").alias("h")).collect()}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = []
    for k, (i, text) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        near = piecewise.likeness([brute.ctph(text.encode())], [brute.ctph(after.encode())])[0]
        want.append((i, hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest(), near))
    same([(r["doc_id"], r["edited_sha256"], r["near_next"]) for r in found], want)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_piecewise_single_row(spark, n):
    """One row, or copies of one row, follow themselves."""
    found = piecewise.piecewise_fingerprints(as_docs(spark, [(3, "abcdefg")] * n)).collect()
    want = hashlib.sha256(b"abcd" + b"abc").hexdigest()
    assert [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_next"]) for r in found] == [(3, 7, want, 1.0)] * n


def test_copies(spark):
    """Equal rows are found, reduced, dealt in shares and multiplied again."""
    rows = [(1, "a")] * 9000 + [(None, "a")] * 3 + [(1, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert copies.measured(docs) == (sum(len(t) + 1 for _, t in rows), True)
    assert copies.measured(docs.distinct())[1] is False
    assert copies.measured(docs.filter("false")) == (0, False)
    shares = copies.in_parts(copies.reduced(docs), 16).collect()
    assert max(r["n"] for r in shares) == 16 and min(r["n"] for r in shares) == 1
    assert sum(r["n"] for r in shares) == len(rows) and len(shares) == -(-9000 // 16) + 3
    back = copies.multiplied(copies.reduced(docs), "doc_id", "text")
    same(back.collect(), rows)


def test_order_key():
    rng = random.Random(24)
    ids = [None, None, -2**63, 2**63 - 1, -1, 0, 1] + [rng.randint(-2**63, 2**63 - 1) for _ in range(60)]
    hashes = [rng.choice([0, -2**63, 2**63 - 1, rng.randint(-9, 9)]) for _ in ids]
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, hashes[i]))
    keys = piecewise.order_key(ids, np.array(hashes))
    assert (keys[order][:-1] <= keys[order][1:]).all()


def test_decoder_tries_all_readings():
    """Viterbi's reading costs what the cheapest of all paths does."""
    counts = toxicity.np.zeros(28**4, dtype=np.int64)
    rng = random.Random(25)
    chars = toxicity.CharModel(counts)
    data = [toxicity._symbol(c) for c in "   ".join(["idiot", "stupid", "trash", "hello", "good"] * 20)]
    for k in range(len(data) - 3):
        counts[((data[k] * 28 + data[k + 1]) * 28 + data[k + 2]) * 28 + data[k + 3]] += 1
    chars = toxicity.CharModel(counts)
    tokens = ["1d10t", "!d!ot", "$tup1d", "iiidiot", "7r45h", "a", "0", "h3lloooo"]
    tokens += ["".join(rng.choices("ab10!$t", k=rng.randint(1, 6))) for _ in range(60)]
    for token in tokens:
        costs = brute.all_readings(token, toxicity.lattice, chars.cost, toxicity._symbol)
        read = chars.decode(token)
        assert costs[read] == pytest.approx(min(costs.values()), rel=1e-6), token


def test_long_tokens_are_decoded_whole_in_linear_time():
    chars = toxicity.CharModel(np.ones(28**4, dtype=np.int64))
    token = "ab1" * 20_000
    assert len(chars.decode(token)) <= 2 * len(token)
    assert toxicity.restored("x1" * 60, chars) in toxicity.readings("x1" * 60, chars)


def test_network_plainly():
    """Every position by the gates' formulas, one at a time, in double precision."""
    rng = np.random.default_rng(3)
    net = language_id.Network(["a", "b", "c"], hidden=3)
    for p in net.params():
        p += rng.standard_normal(p.shape).astype(np.float32) * 0.2
    texts = [b"Some words, 12 of them.", "ñandú été".encode() * 20, b"x", b"A" * 64, b"B" * 65]
    got = net.documents(texts)
    for text, row in zip(texts, got):
        assert row == pytest.approx(brute.gru_document(net, text, language_id.STEP), abs=1e-5)


def test_language_sample_counts_a_text_once(spark):
    rows = [(i, "the same text again", "en") for i in range(500)] + [(1000 + i, f"ein anderer satz {i}", "de") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, pairs = language_id.training_rows(docs, F.lit(True), 4000, "lang", "text")
    assert langs == ["de", "en"]
    assert [sum(i == k for k, _ in pairs) > 0 for i in (0, 1)] == [True, True]
    assert sum(i == 1 for i, _ in pairs) <= language_id.WINDOWS


def test_more_languages_than_rows_asked_for(spark):
    rows = [(i, f"word{i} text", f"l{i % 300:03d}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, _ = language_id.training_rows(docs, F.lit(True), 1000, "lang", "text")
    assert len(langs) == 300


def test_short_benchmark_items(spark):
    """Under the length at which edits are allowed: as they are, between word boundaries."""
    items = [(1, "what is two plus two"), (2, "Paris"), (None, "who wrote it then, exactly?"), (4, "a b c d")]
    rows = [(1, "Quiz. What is two plus TWO? Four."), (2, "somewhat is two plus two"), (3, "What is two plus twofold"),
            (4, "We went to Paris."), (5, "paris"), (6, "Say who wrote it then exactly and why"), (7, "xa b c d"), (8, "a b c d e")]
    docs = as_docs(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.benchmark_matches(docs, bench).select("doc_id", "item_id", "distance").collect()
    same(found, [(1, 1, 0), (5, 2, 0), (6, None, 0), (8, 4, 0)])
    left = decontaminate.without_benchmark(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 7]


def test_items_inside_very_long_documents(spark):
    """The plain distance over a whole long text, also at its ends."""
    rng = random.Random(27)
    item = " ".join(make_words(rng, 14))
    filler = [" ".join(make_words(rng, 2500)) for _ in range(4)]
    rows = [(1, filler[0] + " " + mutate(rng, item, 2)), (2, mutate(rng, item, 1) + " " + filler[1]),
            (3, filler[2] + " " + item + " " + filler[2]), (4, filler[3])]
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    budget = int(len(decontaminate.compared(item)) * decontaminate.ERROR_RATE)
    found = {r["doc_id"]: r["distance"] for r in decontaminate.benchmark_matches(as_docs(spark, rows), bench).collect()}
    want = {i: brute.edit_distance(decontaminate.compared(item), decontaminate.compared(t), anywhere=True) for i, t in rows}
    assert found == {i: d for i, d in want.items() if d <= budget} and set(found) == {1, 2, 3}


def test_largest_and_missing_ids(spark):
    """The largest id comes back as itself, beside rows without one."""
    last, line = 2**63 - 1, "a line that is long enough"
    words = " ".join(make_words(random.Random(28), 20))
    rows = [(last, f"{line}\n{words}"), (None, f"{line}\n{words}"), (5, "own"), (last - 1, line)]
    docs = as_docs(spark, rows)
    same(line_dedup.line_dedup(docs).select("doc.doc_id", "n_dropped").collect(), [(last, 1), (None, 2), (5, 0), (last - 1, 0)])
    found = substring_dedup.remove_repeats(docs).select("doc_id", "n_words").collect()
    same(found, [(last, 26), (None, 26), (5, 1), (last - 1, 6)])
