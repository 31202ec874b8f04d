"""Licence scan, decontamination, quality rules and sharding."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from compare import plan_text
from fixtures_llm import prose
from pyspark.sql import functions as F

from pagemill.llm import quality
from pagemill.llm.decontaminate import INDEX_FACTOR, Benchmark, Items, find_benchmark
from pagemill.llm.licenses import COVERAGE, DRIFT, NOTICES, PHRASES, Template, TemplateIndex, license_scan, read_templates
from pagemill.llm.sharding import shuffled_shards, write_shards


def ascii_words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_every_phrase_is_found(make, odd_rows):
    pick = random.Random(1)
    pieces = ["MIT", "license", "License,", "apache", "General", "public", "the", "of", "licence", "GNU"]
    rows = odd_rows + [(100 + n, " ".join(pick.choices(pieces, k=pick.randrange(40)))) for n in range(200)]
    for r in license_scan(make(rows)).filter("doc_id >= 100").collect():
        words = ascii_words(dict(rows)[r.doc_id])
        expected = [
            (t.label, n) for t in PHRASES for wanted in [t.text.lower().split()]
            for n in range(len(words)) if words[n : n + len(wanted)] == wanted
        ]
        assert sorted((m.label, m.first) for m in r.matches if m.phrase) == sorted(expected)
        assert r.n_words == len(words) and 0 <= r.score <= 1
    assert license_scan(make(rows).filter("doc_id < -5")).count() == 0
    assert license_scan(make(odd_rows)).count() == len(odd_rows)


@pytest.mark.parametrize("template", NOTICES, ids=lambda t: t.label)
def test_notices_are_found_with_words_changed(make, template):
    words = template.text.split()
    held = {w for p in template.key_phrases for w in p.split()}
    free = [n for n, w in enumerate(words) if not set(ascii_words(w)) & held]
    changed = [*words]
    for n in free[: len(words) // 8]:
        changed[n] = "other"
    rows = [(1, prose(30, 1) + " " + " ".join(changed) + " " + prose(30, 2)), (2, " ".join(reversed(words)))]
    found = {r.doc_id: {m.label for m in r.matches} for r in license_scan(make(rows)).collect()}
    assert template.label in found[1]
    assert template.label not in found[2]


@pytest.mark.parametrize("template", NOTICES, ids=lambda t: t.label)
def test_notices_are_found_with_words_put_in_and_left_out(template):
    index = TemplateIndex(PHRASES + NOTICES, COVERAGE)
    words = template.text.split()
    held = {w for p in template.key_phrases for w in p.split()}
    free = [n for n, w in enumerate(words) if not set(ascii_words(w)) & held]
    for n in [n + 1 for n in free if n + 1 < len(words)]:
        longer = [*words[:n], "inserted", *words[n:]]
        found = index.matches([w.encode() for w in ascii_words(prose(20, n) + " " + " ".join(longer))])
        assert template.label in {index.templates[k].label for k, _, _ in found}
    for n in free if len(words) >= 10 else []:
        shorter = [*words[:n], *words[n + 1 :]]
        found = index.matches([w.encode() for w in ascii_words(" ".join(shorter) + " " + prose(20, n))])
        assert template.label in {index.templates[k].label for k, _, _ in found}


def plain_matches(words, templates):
    """Every start of every template, by the definition."""
    found = []
    for number, template in enumerate(templates):
        own = ascii_words(template.text)
        phrases = []
        for phrase in template.key_phrases:
            wanted = ascii_words(phrase)
            phrases.append((next(k for k in range(len(own)) if own[k : k + len(wanted)] == wanted), wanted))
        for start in range(-len(own), len(words)):
            def near(at, wanted, drift):
                spots = range(max(0, start + at - drift), start + at + drift + 1)
                return any(words[k : k + len(wanted)] == wanted for k in spots)

            if not near(*phrases[0], 0) or not all(near(at, p, DRIFT) for at, p in phrases[1:]):
                continue
            equal = sum(near(place, [word], DRIFT) for place, word in enumerate(own))
            if equal >= math.ceil(COVERAGE * len(own)):
                found.append((number, start, equal / len(own)))
    return found


def test_a_thousand_templates_from_a_table(spark, make):
    pick = random.Random(4)
    common = [f"c{n}" for n in range(40)]
    texts = [" ".join(pick.choices([*common, f"r{n}", f"r{n // 7}"], k=pick.randrange(4, 40))) for n in range(1000)]
    rows = []
    for n, text in enumerate(texts):
        words = text.split()
        phrases = [" ".join(words[k : k + 2]) for k in sorted(pick.sample(range(len(words) - 1), pick.randrange(1, 3)))]
        rows.append((f"l{n:04}", text, phrases))
    table = spark.createDataFrame([*rows, rows[0], (None, "a", ["a"]), ("x", "a", [])], "label string, text string, key_phrases array<string>")
    templates = read_templates(table)
    assert [t.label for t in templates] == [r[0] for r in rows]
    with pytest.raises(ValueError, match="bytes"):
        read_templates(table, most_bytes=100)
    documents = [(0, None), (1, "")]
    for n in range(2, 14):
        words = " ".join(pick.choices(texts, k=3)).split()
        for _ in range(4):
            at = pick.randrange(len(words))
            words[at : at + 1] = pick.choice([[], ["other"], [words[at], "more"]])
        documents.append((n, " ".join(words)))
    found = license_scan(make(documents), (), templates).collect()
    got = {r.doc_id: [(m.label, m["first"], m.share) for m in r.matches] for r in found}
    expected = {
        i: [(templates[n].label, max(start, 0), share) for n, start, share in plain_matches(ascii_words(t), templates)]
        for i, t in documents
    }
    assert got == expected and sum(map(len, got.values())) > 20
    assert isinstance(templates[0], Template)


def plain_hits(text, items):
    words, hit, found = ascii_words(text), set(), set()
    for item_id, item in items:
        own = ascii_words(item)
        n = min(10, len(own))
        windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else set()
        for k in range(len(words) - n + 1) if own else ():
            if tuple(words[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                found.add(item_id)
    return len(words), sorted(hit), sorted(i for i in found if i is not None)


@pytest.mark.parametrize("pass_bytes", [1 << 25, 300])
def test_benchmark_windows_are_found(spark, make, odd_rows, pass_bytes):
    pick = random.Random(8)
    letters = "a b c d the of and".split()
    items = [(n, " ".join(pick.choices(letters, k=pick.randrange(1, 30)))) for n in range(25)]
    items += [(50, None), (51, "..."), (None, "zz yy"), (3, "one more three"), (52, prose(25, 1))]
    rows = odd_rows + [(100 + n, " ".join(pick.choices([*letters, "zz", "yy"], k=200))) for n in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("runs", F.lit(0))
    found = find_benchmark(make(rows), benchmark, pass_bytes=pass_bytes).collect()
    got = sorted(((r.doc_id, r.n_words, [k for a, b in r.runs for k in range(a, b)], r["items"]) for r in found), key=repr)
    assert got == sorted(((i, *plain_hits(t, items)) for i, t in rows), key=repr)
    assert find_benchmark(make(rows), benchmark.filter("item_id < 0")).filter("size(runs) > 0").count() == 0


def test_empty_documents_hold_nothing(spark, make):
    benchmark = spark.createDataFrame([(1, prose(30, 1))], "item_id long, text string")
    assert find_benchmark(make([(1, "x")]).filter("doc_id < 0"), benchmark).count() == 0


@pytest.mark.parametrize("n_items, words, factor", [(1000, 100, 8), (3000, 3, 10), (2000, 0, INDEX_FACTOR)])
def test_size_of_the_benchmark_search(n_items, words, factor):
    pick = random.Random(1)
    items = [(n, (prose(words, n) or " ".join(pick.choices("abcdefgh", k=50))).encode()) for n in range(n_items)]
    held = Items(items, 10)
    assert held.benchmark() is held.benchmark()
    assert held.benchmark().nbytes() <= factor * sum(len(body) for _, body in items)


@pytest.mark.parametrize("length", [1, 2, 3, 10])
def test_benchmark_windows_whose_hashes_meet(length):
    """Few slots and many repeated windows: every place is found with the items of all equal windows."""
    pick = random.Random(length)
    items = [(n, " ".join(pick.choices("ab", k=pick.randrange(0, 40)))) for n in range(60)]
    search = Benchmark([(i, t.encode()) for i, t in items], length)
    for _ in range(40):
        text = " ".join(pick.choices("abc", k=60))
        runs, found = search.search([w.encode() for w in text.split()])
        hit, expected = set(), set()
        words = text.split()
        for item_id, item in items:
            own = item.split()
            n = min(length, len(own))
            windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else set()
            for k in range(len(words) - n + 1) if own else ():
                if tuple(words[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    expected.add(item_id)
        assert [k for a, b in runs for k in range(a, b)] == sorted(hit) and found == sorted(expected)


def plain_base(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_counts(make, odd_rows):
    pick = random.Random(6)
    rows = odd_rows + [(200 + n, "".join(pick.choices("ab \n#é\x0b\x85", k=150))) for n in range(80)]
    counted = quality.with_base(make(rows)).collect()
    found = sorted(((r.doc_id, *(r[c] for c in quality.BASE)) for r in counted), key=repr)
    assert found == sorted(((i, *plain_base(t)) for i, t in rows), key=repr)


def plain_estimate(rows):
    """The same estimate as `quality.estimates`, by numpy, for one group of whole-number statistics."""
    x = np.array(rows, float)
    floors = np.array([quality.FLOORS[s] for s in quality.STATS], float)
    middle = np.median(x, axis=0)
    covariance = np.diag(np.maximum(1.4826 * np.median(np.abs(x - middle), axis=0), floors) ** 2)
    for _ in range(quality.ROUNDS):
        d = np.einsum("ij,jk,ik->i", x - middle, np.linalg.inv(covariance), x - middle)
        step = np.floor(quality.STEPS * np.log2(1 + d))
        near = x[step <= np.sort(step)[math.ceil(quality.CORE_SHARE * len(x)) - 1]]
        middle = near.mean(axis=0)
        covariance = quality.core_scale() * np.cov(near.T, bias=True) + np.diag(floors**2)
    return middle, covariance


def good_and_bad(n=150):
    rows = [(k, prose(60 + k % 50, k)) for k in range(n)]
    rows += [(1000 + k, " ".join(w + "$$$ %%%" for w in prose(60, 3000 + k).split())) for k in range(15)]
    return rows + [(2000 + k, prose(80, 4000 + k).upper().replace(" ", " #&* ")) for k in range(5)]


def test_estimates_and_verdicts(make):
    rows = good_and_bad()
    fitted, narrow = quality.fit_quality(make(rows))
    judged = {r.doc_id: r for r in quality.judged(narrow, fitted).collect()}
    stats = {r.doc_id: [r[f"_{s}"] for s in quality.STATS] for r in narrow.collect()}
    middle, covariance = plain_estimate(list(stats.values()))
    for i, x in stats.items():
        d = np.array(x) - middle
        assert math.isclose(judged[i].distance, d @ np.linalg.inv(covariance) @ d, rel_tol=1e-6, abs_tol=1e-9)
    assert {i for i, r in judged.items() if r.kept} == set(range(150))


def test_a_group_with_much_junk(make):
    rows = [(k, prose(60 + k % 50, k)) for k in range(180)]
    junk = [" ".join(w + "$" * (1 + k % 3) for w in prose(60 + k % 40, 3000 + k).split()) for k in range(120)]
    kept = quality.keep_good(make(rows + [(1000 + k, t) for k, t in enumerate(junk)])).collect()
    assert {r.doc_id for r in kept} == set(range(180))


def test_small_groups_and_odd_rows(make, odd_rows):
    frame = make(odd_rows + [(n + 500, prose(50, n)) for n in range(60)])
    frame = frame.withColumn("source", F.when(F.col("doc_id") % 2 == 0, "a")).withColumn("kept", F.lit("clash"))
    kept = quality.keep_good(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} >= {n + 500 for n in range(60)}
    assert quality.keep_good(frame.filter("doc_id < -1")).count() == 0


def test_chi2_points():
    assert math.isclose(quality.chi2_point(0.05, 4), 9.487729, rel_tol=1e-5)
    assert math.isclose(quality.chi2_point(0.25, 4), 5.385269, rel_tol=1e-5)


@pytest.mark.parametrize("bucket_bytes", [1 << 25, 2000])
def test_shards_are_a_permutation(make, odd_rows, bucket_bytes):
    rows = odd_rows + [(n + 100, prose(5, n)) for n in range(300)] + [(77, "equal")] * 400
    frame = make(rows).withColumn("slot", F.lit(9)).withColumn("_start", F.lit(1))
    result = shuffled_shards(frame, 7, bucket_bytes=bucket_bytes)
    found = result.collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=repr) == sorted(rows, key=repr)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[k]) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = shuffled_shards(frame.repartition(5), 7, bucket_bytes=bucket_bytes).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    # Neighbours of the input are not neighbours of the result.
    places = {r.doc_id: r.slot * 7 + r.shard for r in found if r.doc_id is not None and r.doc_id >= 100}
    steps = [abs(places[n + 101] - places[n + 100]) for n in range(299)]
    assert np.mean(steps) > len(rows) / 6
    assert shuffled_shards(frame.filter("doc_id < -1"), 3).count() == 0


def test_written_shards_are_read_back_in_order(spark, make, tmp_path):
    rows = [(n, prose(5, n)) for n in range(300)] + [(None, None), (7, "x"), (7, "x")]
    sharded = shuffled_shards(make(rows).withColumn("block", F.lit("old")), 3, bucket_bytes=2000)
    write_shards(sharded, str(tmp_path / "out"), file_rows=20)
    read = []
    for shard in range(3):
        slots = []
        blocks = sorted((tmp_path / "out" / f"shard={shard}").iterdir(), key=lambda p: int(p.name.split("=")[1]))
        for block in blocks:
            files = list(block.glob("*.parquet"))
            assert len(files) == 1
            part = pq.ParquetFile(files[0]).read().to_pylist()
            assert len(part) == 20 or block == blocks[-1]
            slots += [r["slot"] for r in part]
            read += [(r["doc_id"], r["text"]) for r in part]
        assert slots == list(range(len(slots))) and len(blocks) > 4
    assert sorted(read, key=repr) == sorted(rows, key=repr)
    write_shards(sharded.limit(0), str(tmp_path / "none"))
    assert not list((tmp_path / "none").glob("shard=*"))


def test_every_bucket_has_a_task(make):
    plan = plan_text(shuffled_shards(make([(n, prose(50, n)) for n in range(200)]), 3, bucket_bytes=5000))
    # Records are shuffled once, to the partition with the number of their bucket.
    assert plan.count("shufflepartitionidpassthrough") == 1
