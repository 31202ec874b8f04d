"""Trees, logs and proofs against plain recursion."""

import hashlib
import zlib

import pytest
from fixtures_llm import prose
from pyspark.sql import functions as F

from pagemill.llm import merkle
from pagemill.llm.merkle import append_log, block_proofs, fold, height, merkle_manifest, position

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves, arity=16):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + arity])) for i in range(0, len(last), arity)])
    return levels


def plain_leaf(row):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    return h("".join(field(v) for v in row))


def siblings(levels, i, arity=16):
    found = []
    for level in levels[:-1]:
        run = level[i - i % arity : i - i % arity + arity]
        found += [d for j, d in enumerate(run) if j != i % arity]
        i //= arity
    return found


def climb(levels, i, digest, arity=16):
    for level in levels[:-1]:
        run = level[i - i % arity : i - i % arity + arity]
        run[i % arity] = digest
        digest, i = h("".join(run)), i // arity
    return digest


def plain(rows, arity=16):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([m[2] for m in sorted(groups[g], key=lambda m: m[:3])], arity) for g in names}
    top = levels_of([trees[g][-1][0] for g in names], arity)
    found = []
    for place, g in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(sorted(groups[g], key=lambda m: m[:3])):
            changed = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                changed = plain_leaf((*row[:4], low))
            proof = siblings(trees[g], i, arity) + siblings(top, place, arity)
            folded = climb(top, place, climb(trees[g], i, changed, arity), arity)
            root = top[-1][0]
            found.append((row[0], leaf, trees[g][-1][0], root, h("".join(proof)), folded, folded == root))
    return sorted(found, key=repr)


def audit(docs):
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    low = {"text": F.translate("text", merkle.UPPER, merkle.LOWER)}
    manifest = merkle_manifest(docs, FIELDS, claimed=low, altered=altered)
    names = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return manifest, sorted((tuple(r[n] for n in names) for r in manifest.audit().collect()), key=repr)


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string" + extra)


@pytest.mark.parametrize("count", [1, 2, 15, 16, 17, 255, 256, 257, 272, 273, 4096])
def test_log_is_in_completion_order_at_closed_form_places(count):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(count)]
    levels = levels_of([d.hex() for d in leaves])
    assert height(count) == len(levels) - 1
    log = append_log(leaves, height(count))
    assert len(log) == 32 * sum(map(len, levels))
    for level, nodes in enumerate(levels):
        for i, node in enumerate(nodes):
            at = 32 * position(level, i, count)
            assert log[at : at + 32].hex() == node
    for i, (leaf, proof) in enumerate(block_proofs(log, count, height(count))):
        root, digest = fold(leaf, proof)
        assert root.hex() == levels[-1][0] and digest.hex() == h("".join(siblings(levels, i)))


def test_odd_rows_give_the_trees_of_plain_recursion(spark):
    same = (5, "b", "en", 3, "Same")
    rows = [
        same, same, same, (5, "b", "en", 3, "Other"), (None, "b", "en", 3, "NULL id"), (None, "b", "en", 3, "NULL id"),
        (7, None, None, None, None), (8, None, "de", 0, ""), (9, "", "de", 1, "Empty source"), (10, "é", "fr", 2, "É A"),
        (11, "lone", "en", 9, prose(20_000, 3)), (-12, "b", "en", 4, "Minus"),
    ]
    rows += [(100 + i, "many", "en", i, f"Text {i}") for i in range(300)] + [(i, f"s{i:03d}", "en", 1, "A") for i in range(40)]
    manifest, found = audit(table(spark, rows).repartition(7))
    assert found == plain(rows)
    assert manifest.root == found[0][3]


def test_trees_over_several_tiers_of_builders(spark, monkeypatch):
    # Small blocks: two levels of four nodes each, so 16 leaves a builder and three tiers for 700 leaves.
    for name, value in (("ARITY", 4), ("LEVELS", 2), ("TASK_LEAVES", 64)):
        monkeypatch.setattr(merkle, name, value)
    rows = [(i, "hot" if i % 3 else f"s{i % 90:02d}", "en", i, f"T{i}") for i in range(1050)]
    manifest, found = audit(table(spark, rows).repartition(5))
    assert found == plain(rows, arity=4)
    assert len(manifest.groups.tiers) == 3 and len(manifest.top.tiers) == 2
    # The log of each group has no gaps, and its nodes are those of plain recursion.
    log = {}
    for r in manifest.log().collect():
        log.setdefault(r["group"], {})[r["position"]] = (r["level"], r["index"], r["digest"])
    hot = levels_of([plain_leaf(r) for r in rows if r[1] == "hot"], 4)
    assert sorted(log["hot"]) == list(range(sum(map(len, hot))))
    assert {(lv, i, d) for lv, i, d in log["hot"].values()} == {(lv, i, d) for lv, ns in enumerate(hot) for i, d in enumerate(ns)}
    done = [0] * 10
    for at in range(len(log["hot"])):
        level, index, _ = log["hot"][at]
        assert index == done[level] and (not level or done[level - 1] == min((index + 1) * 4, len(hot[level - 1])))
        done[level] += 1


def test_proofs_can_be_checked_on_their_own(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"T{i}") for i in range(100)]
    manifest = merkle_manifest(table(spark, rows), FIELDS)
    proofs = manifest.proofs().collect()
    assert len(proofs) == 100
    assert all(fold(bytes.fromhex(r.leaf), bytes(r.proof))[0].hex() == manifest.root for r in proofs)
    wrong = proofs[0]
    assert fold(bytes.fromhex(proofs[1].leaf), bytes(wrong.proof))[0].hex() != manifest.root


def test_empty_table_and_clashing_columns(spark):
    empty, found = audit(table(spark, []))
    assert found == [] and empty.root is None and empty.log().count() == 0 and empty.proofs().count() == 0
    rows = [(1, "a", "en", 1, "X"), (2, "a", "en", 1, None)]
    names = ["_key", "_id", "_digest", "_claim", "_tie", "_place", "_part", "_index", "_n", "_rows", "_first", "group"]
    clashing = table(spark, rows).select("*", *[F.lit("z").alias(n) for n in names])
    assert audit(clashing)[1] == plain(rows)


def test_rows_repeated_many_times_are_leaves_each(spark):
    rows = [(1, "a", "en", 1, "Again")] * 5000 + [(2, "b", "en", 1, "Once")]
    docs = spark.range(5000).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).cast("long").alias("n_chars"), F.lit("Again").alias("text"),
    ).unionAll(table(spark, rows[-1:]))
    assert audit(docs)[1] == plain(rows)
