"""N-gram join, sentence spans and suffix sorting against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures_llm import prose
from pyspark.sql import functions as F

from pagemill.llm.components import connected_components
from pagemill.llm.induced_sort import LayerQueue, induce, later_ones
from pagemill.llm.ngram_join import ngram_groups
from pagemill.llm.sentence_dedup import SPAN_SENTENCES, SPAN_WORDS, dedup_sentences, sentences, words_of
from pagemill.llm.suffix_dedup import dedup_bytes


def order(row):
    return (row[0] is not None, row[0] or 0)


def shingles(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def plain_groups(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    names = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        names[find(n)].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in names.items()}
    return sorted(((i, len(sets[n]), least[find(n)]) for n, (i, _) in enumerate(rows)), key=repr)


def near_copies(seed, bases=4, copies=30, words=60):
    """Groups of near copies, some just beyond the threshold, and chains that link through others."""
    pick = random.Random(seed)
    rows = []
    for b in range(bases):
        base = prose(words, seed * 100 + b).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(pick.randrange(0, 4)):
                own[pick.randrange(len(own))] = f"edit{pick.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    passage = prose(50, seed + 999)
    rows += [(len(rows) + k, f"{passage} {prose(pick.randrange(5, 40), k + 5000)}") for k in range(60)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_are_grouped_as_by_all_pairs(make, seed):
    rows = near_copies(seed)
    found = sorted(map(tuple, ngram_groups(make(rows)).collect()), key=repr)
    assert found == plain_groups(rows)


def test_odd_rows_are_grouped(make, odd_rows):
    found = sorted(map(tuple, ngram_groups(make(odd_rows)).collect()), key=repr)
    assert found == plain_groups(odd_rows)


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(n, n + 1) for n in range(100, 160)] + [(7, 3), (3, 7)], "a long, b long")
    found = dict(map(tuple, connected_components(links).collect()))
    assert found == {**{n: 100 for n in range(100, 161)}, 3: 3, 7: 3}


def all_runs(rows):
    """(id, text left, sentences, removed) of each row, by every run that meets both minimums."""
    seen, gone = set(), defaultdict(set)
    for document in sorted({r for r in rows if r[1] is not None}, key=order):
        words = [tuple(p.lower().split()) for p in sentences(document[1].encode())]
        for i in range(len(words)):
            size = 0
            for j in range(i + 1, len(words) + 1):
                size += len(words[j - 1])
                if j - i >= SPAN_SENTENCES and size >= SPAN_WORDS:
                    run = hash(tuple(words[i:j])) if j - i < 40 else (document, i, j)
                    if run in seen:
                        gone[document] |= set(range(i, j))
                    seen.add(run)
                if j - i >= 40:
                    # A longer run repeats only if those of 39 sentences within it do.
                    break
    found = []
    for row in rows:
        if row[1] is None:
            found.append((row[0], None, 0, 0))
            continue
        pieces = sentences(row[1].encode())
        left = b"".join(p for n, p in enumerate(pieces) if n not in gone[row]).decode()
        found.append((row[0], left, len(pieces), len(gone[row])))
    return sorted(found, key=repr)


def sentence_rows(frame):
    return sorted(((r.doc_id, r.text, r.n_sentences, r.n_removed) for r in dedup_sentences(frame).collect()), key=repr)


def test_sentences_that_came_before_go(make, odd_rows):
    assert sentence_rows(make(odd_rows)) == all_runs(odd_rows)


def test_a_passage_goes_from_all_but_the_first(make):
    passage = prose(60, 42)
    rows = [(n, f"{prose(40, n)} {passage} {prose(40, n + 100)}") for n in range(1, 30)] + [(99, prose(300, 77))]
    result = {r.doc_id: r for r in dedup_sentences(make(rows)).collect()}
    assert result[1].n_removed == 0 and result[99].n_removed == 0
    assert all(result[n].words_removed >= 45 for n in range(2, 30))
    assert result[5].source == "s" and "n_chars" in result[5].asDict()


def sentences_of(lengths, seed):
    words = iter(prose(sum(lengths), seed).replace(".", "").split())
    return " ".join(" ".join(next(words) for _ in range(n)) + "." for n in lengths)


def test_every_repeated_run_goes_to_its_end(make):
    text = sentences_of([11, 8, 1, 5, 5], 1)
    result = {r.doc_id: r for r in dedup_sentences(make([(1, text), (2, text)])).collect()}
    assert (result[1].n_removed, result[2].n_removed, result[2].text) == (0, 5, "")
    pick = random.Random(4)
    shared = [sentences_of([pick.randrange(1, 12) for _ in range(9)], 100 + k) for k in range(4)]
    rows = [
        (n, " ".join([sentences_of([3, 9, 2], 200 + n), *pick.choices(shared, k=2), sentences_of([4, 1, 6], 300 + n)]))
        for n in range(40)
    ]
    assert sentence_rows(make(rows)) == all_runs(rows)


@pytest.mark.parametrize("seed", range(4))
def test_long_lines_and_other_scripts_are_cut(make, seed):
    pick = random.Random(seed)

    def line(n, blank):
        return blank.join("".join(pick.choices("abcdefgh", k=6)) for _ in range(n))

    def phrases(n):
        return "".join("".join(chr(pick.randrange(0x4E00, 0x9F00)) for _ in range(20)) + "\u3002" for _ in range(n))

    tabbed, plain, chinese, marked = line(60, "\t"), line(60, " "), phrases(20), phrases(20).replace("\u3002", "")
    thai = "".join(chr(pick.randrange(0x0E01, 0x0E2F)) + "\u0e34" for _ in range(80))
    for n, passage in enumerate([tabbed, plain, chinese, marked, thai]):
        rows = [(k, f"{line(3 + k, ' ')}. {passage} {line(9 - k, ' ')}.") for k in (1, 2)]
        rows[1] = (2, rows[1][1].upper())
        result = {r.doc_id: r for r in dedup_sentences(make(rows)).collect()}
        assert result[1].text == rows[0][1], n
        assert result[2].words_removed >= 20 and len(result[2].text) < len(rows[1][1]), n
    assert all(len(words_of(p)) <= 8 for p in sentences((tabbed * 3).encode())[1:-1])
    for text in (tabbed, chinese, thai, " \u3000 \n" + marked, "a\u3002\u300d b\u00a0c"):
        assert b"".join(sentences(text.encode())).decode() == text


def plain_bytes(rows):
    seen, found = set(), {}
    for document in sorted(set(rows), key=order):
        body = (document[1] or "").encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - 99):
            window = body[k : k + 100]
            if window in seen:
                gone[k : k + 100] = True
            seen.add(window)
        left = np.frombuffer(body, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        found[document] = (document[0], len(body), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    return sorted((found[r] for r in rows), key=repr)


def byte_rows(frame):
    return sorted(
        (
            (r.doc_id, r.n_bytes, sum(s.behind - s.first for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
            for r in dedup_bytes(frame).collect()
        ),
        key=repr,
    )


def test_bytes_that_came_before_go(make, odd_rows):
    # Different texts of one id are in the order of a digest, so here they share no bytes with each other.
    rows = [r for r in odd_rows if r != (None, odd_rows[0][1])] + [(None, prose(40, 1))]
    assert byte_rows(make(rows)) == plain_bytes(rows)


def test_one_id_with_many_texts_keeps_them_apart(make):
    passage = prose(60, 900)
    clean = [(None, prose(25, 1000 + n)) for n in range(1500)] + [(5, prose(25, 3000 + n)) for n in range(300)]
    held = [(None, f"{prose(8, 4000 + n)} {passage} {prose(8, 5000 + n)}") for n in range(300)]
    frame = make(clean + held)
    found = {(r.doc_id, r.text): r for r in dedup_bytes(frame).collect()}
    assert all(not found[row].spans and found[row].kept == row[1].encode() for row in clean)
    cut = [found[row] for row in held if found[row].spans]
    assert len(cut) == len(held) - 1 and all(sum(s.behind - s.first for s in r.spans) >= len(passage) for r in cut)
    left = Counter((r.doc_id, r.text) for r in dedup_sentences(frame).filter("n_removed = 0").collect())
    assert all(left[row] == 1 for row in clean) and sum(left.values()) == len(clean) + 1


OWN_NAMES = [
    "_id", "_tag", "_gone", "_own", "_runs", "_doc_id", "_key", "_index", "_n", "row", "runs", "gone", "first", "second",
    "id", "a", "b", "n", "tag", "gram", "place", "shape", "component_id", "hash", "rank", "number", "body", "a.b",
]


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("operator", [dedup_bytes, dedup_sentences])
def test_columns_with_the_operators_own_names_stay(make, odd_rows, operator, unique):
    rows = [(n, t) for n, (_, t) in enumerate(odd_rows)] if unique else odd_rows
    plain = make(rows)
    clashing = plain.select("*", *[F.lit(n).alias(n) for n in OWN_NAMES])
    found = operator(clashing)
    assert found.columns[: len(clashing.columns)] == clashing.columns
    assert all(all(r[n] == n for n in OWN_NAMES) for r in found.collect())
    kept = found.select(operator(plain).columns)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, operator(plain).collect()))


def test_periodic_and_overlapping_texts(make):
    pick = random.Random(5)
    unit = "".join(pick.choice("ab") for _ in range(400))
    rows = [(n, unit[n : n + 250] + "ab" * pick.randrange(80) + unit[: pick.randrange(300)]) for n in range(40)]
    rows += [(100 + n, "\0" * pick.randrange(90, 260)) for n in range(5)]
    assert byte_rows(make(rows)) == plain_bytes(rows)


@pytest.mark.parametrize("memory", [1, 1 << 20])
def test_induced_layers_are_sorted_suffixes(memory):
    pick = random.Random(3)
    texts = np.array([[pick.choice(b"abc") for _ in range(12)] for _ in range(500)], np.uint8)
    layer = iter([(np.arange(500, dtype=np.int32), np.zeros(500, np.int32))])
    for column in range(11, -1, -1):
        queue = induce(layer, lambda n, c=column: texts[n, c].astype(np.uint16) + 1, 12, memory)
        layer = queue.blocks()
        suffixes = [texts[n, column:].tobytes() for n in range(500)]
        numbers = np.concatenate([n for n, _ in queue.blocks()])
        assert [suffixes[n] for n in numbers] == sorted(suffixes)
        later = sorted(np.concatenate([np.empty(0, int), *later_ones(queue.blocks(), min(12 - column, 4))]).tolist())
        seen, expected = set(), []
        for n, s in enumerate(suffixes):
            key = s[: min(12 - column, 4)]
            expected += [n] if key in seen else []
            seen.add(key)
        assert later == expected


def test_queue_gives_blocks_by_character():
    queue = LayerQueue(memory=1)
    for character in (3, 1, 3, 2):
        queue.push(character, np.array([character * 10], np.int32), np.array([0], np.int32))
    assert np.concatenate([n for n, _ in queue.blocks()]).tolist() == [10, 20, 30, 30]


@pytest.mark.parametrize("operator", [ngram_groups, dedup_sentences, dedup_bytes])
def test_empty_tables(make, spark, operator):
    assert operator(make([(1, "a")]).filter("doc_id > 1")).collect() == []


def test_counts_do_not_depend_on_partitions(make):
    rows = near_copies(9)
    one = Counter(map(tuple, ngram_groups(make(rows).coalesce(1)).collect()))
    assert one == Counter(map(tuple, ngram_groups(make(rows).repartition(13)).collect()))
