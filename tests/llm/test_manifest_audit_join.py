import hashlib
import itertools
import re
import zlib

import brute
import numpy as np
import pytest
from conftest import pairs
from pyspark.sql import functions as F

from martlake.llm import audit, links, merkle, queries, setjoin
from martlake.session import scratch_path


# ---------------------------------------------------------------------------
# Manifest
# ---------------------------------------------------------------------------
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Its levels, from the leaves up."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k:k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    """[(digests before, digests behind)] of each level below the root."""
    out = []
    for level in levels[:-1]:
        run = level[at // 8 * 8:at // 8 * 8 + 8]
        out.append((run[:at % 8], run[at % 8 + 1:]))
        at //= 8
    return out


def manifest(rows):
    """rows: (part, doc_id, leaf, presented) -> sorted results of a plain tree."""
    parts = {}
    for row in rows:
        parts.setdefault(row[0], []).append(row)
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for p in names:
        parts[p].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        trees[p] = tree([r[2] for r in parts[p]])
    top = tree([trees[p][-1][0] for p in names])
    out = []
    for k, p in enumerate(names):
        for at, (_, doc, leaf, folded) in enumerate(parts[p]):
            siblings = []
            for left, right in path(trees[p], at) + path(top, k):
                siblings += left + right
                folded = h(*left, folded, *right)
            out.append((doc, leaf, trees[p][-1][0], top[-1][0], h(*siblings), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("height", [1, 2, 4])
def test_manifest_against_a_plain_tree(spark, height):
    rows = [(None if k % 7 == 0 else "abc"[k % 3 % (1 + k % 2)], None if k % 50 == 3 else k, h(str(k)), h(str(k), "x" * (k % 4 == 0)))
            for k in range(700)]
    rows += [("solo", 5, h("5"), h("5")), ("é", 1, h("1"), h("2")), ("é", 1, h("1"), h("2")), ("a", 9, h("z"), h("z"))]
    folder = scratch_path(spark, "manifest")
    merkle.write_manifest(spark.createDataFrame(rows, "part string, doc_id long, leaf string, presented string").repartition(5), folder, height)
    got = sorted((tuple(r) for r in merkle.verify(spark, folder, height).collect()), key=str)
    want = manifest(rows)
    assert got == want and merkle.read_root(spark, folder) == want[0][3]
    blocks = spark.read.schema(merkle.BLOCKS).parquet(f"{folder}/documents").collect()
    assert max(len(b.nodes) for b in blocks) <= 32 * merkle.nodes_in(height + 1)


def test_van_emde_boas_addresses():
    for levels in range(1, 6):
        at = np.concatenate([merkle.address(levels, d, np.arange(8 ** d)) for d in range(levels)])
        assert sorted(at.tolist()) == list(range(merkle.nodes_in(levels)))
    # of a tree of four levels the upper two come first, then each lower tree in one stretch
    assert merkle.address(4, 1, np.arange(8)).tolist() == list(range(1, 9))
    assert merkle.address(4, 2, np.array([0, 1, 63])).tolist() == [9, 18, 9 * 64]
    assert merkle.address(4, 3, np.array([0, 7, 8])).tolist() == [10, 17, 19]


def test_manifest_of_awkward_rows_and_of_nothing(spark, docs, none):
    for df in (docs, none):
        folder = scratch_path(spark, "manifest")
        leaf = merkle.leaf_digest([F.col("doc_id"), F.col("text")])
        merkle.write_manifest(df.select(F.col("lang").alias("part"), "doc_id", leaf.alias("leaf"), leaf.alias("presented")), folder)
        rows = merkle.verify(spark, folder).collect()
        assert len(rows) == df.count() and all(r.verified for r in rows)
    assert merkle.read_root(spark, folder) is None


def test_leaves_and_tampering_of_op11(spark, sf_dir):
    texts = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op11_merkle_manifest(spark, sf_dir).collect()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    assert len(rows) == len(texts)
    for r in rows:
        d = texts[r.doc_id]
        assert r.leaf == h(*(field(v) for v in (d.doc_id, d.source, d.lang, d.n_chars, d.text)))
        tampered = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and re.search("[A-Z]", d.text or "")
        assert r.verified == (not tampered)


# ---------------------------------------------------------------------------
# Audit
# ---------------------------------------------------------------------------
def audited(docs, labels):
    """docs: (part, doc_id, text); labels: (doc_id, quality, toxic)."""
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    first = {}
    for _, d, t in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    parts = {}
    for part, d, text in docs:
        text = text or ""
        w = re.findall("[^\x20\x09-\x0D]+", text)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)), "E": d is not None and d > first[text]}
        parts.setdefault(part or "", []).append(({f for f, x in fails.items() if x}, d in good, d in toxic))
    out, removed_by = [], {}
    for part, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = list(rows)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                removed_by[part, f] = removed_by.get((part, f), 0) + len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), sum(f in r[0] for r in rows) - len(gone),
                            sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)))
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out)


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit_against_brute_force(spark):
    rng = __import__("random").Random(3)
    texts = [None, "", " \t\n", "ABC", "a" * 20000 + " #"]
    for k in range(120):
        words = [rng.choice(["up", "Down", "x", f"w{rng.randrange(400)}", "A&B"[:1 + 2 * (k % 5 == 0)]]) for _ in range(rng.randrange(0, 120))]
        texts.append(" ".join(words))
    rows = [(rng.choice([None, "", "s", "é"]), None if k % 17 == 0 else k // 2, rng.choice(texts)) for k in range(400)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 200, 3)] + [(3, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(rows, "source string, doc_id long, text string").withColumn("mask", F.lit("x")).repartition(5)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(tuple(r[c] for c in COLUMNS) for r in audit.audit(df, given, range_rows=40).collect()) == audited(rows, labels)
    assert audit.audit(df.limit(0), given).count() == 0
    assert audit.audit(df, given.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_galloping_merges():
    rng = __import__("random").Random(4)
    for _ in range(300):
        lists = [sorted(rng.sample(range(60), rng.randrange(0, 40))) for _ in range(rng.randrange(0, 5))]
        assert audit.union(lists) == sorted(set().union(*lists))
        a, b = (sorted(rng.sample(range(60), rng.randrange(0, 50))) for _ in range(2))
        assert audit.difference(a, b) == sorted(set(a) - set(b)) and audit.common(a, b) == len(set(a) & set(b))


# ---------------------------------------------------------------------------
# Join
# ---------------------------------------------------------------------------
def texts_of_all_sizes():
    rng = __import__("random").Random(5)
    rows, base = [], [[f"w{rng.randrange(4000)}" for _ in range(120)] for _ in range(3)]
    for k in range(60):
        w = list(base[k % 3])
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(120)] = f"v{rng.randrange(10 ** 6)}"
        rows.append((100 + k, " ".join(w)))
    small = [[f"s{rng.randrange(50)}" for _ in range(20)] for _ in range(6)]
    for k in range(200):
        w = small[k % 6][:rng.randrange(1, 20)] + [f"z{rng.randrange(3)}"] * (rng.random() < 0.3)
        rows.append((1000 + k, ("Q " if rng.random() < 0.2 else "") + " ".join(w)))
    return rows + [(5000, None), (5001, ""), (5002, "a b"), (5003, "A  b\n")]


@pytest.mark.parametrize("k, share, light", [(4, 85, None), (4, 85, 0), (4, 85, 16), (1, 85, 9), (2, 60, None)])
def test_join_against_brute_force(spark, k, share, light):
    rows = texts_of_all_sizes()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x"))
    want = [(d, n, c) for d, n, c, _ in brute.near_duplicates(rows, k, share)]
    assert pairs(setjoin.jaccard_join(df, k, share, light), "doc_id", "n_shingles", "component_id") == sorted(want, key=str)


def test_join_of_awkward_rows_and_of_nothing(docs, none):
    rows = setjoin.jaccard_join(docs, 4, 85).collect()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert len(rows) == docs.count() and of[1] == [(0, 1)] and of[4] == [(1, 4)] and of[5] == [(1, 4)]
    assert of[8][0][1] == 6 and [x[1] for x in of[7]] == [6, 6] and of[10][0][1] == 9 and of[None][0][1] is None
    assert setjoin.jaccard_join(none).count() == 0


def test_the_boundary_follows_the_costs():
    assert setjoin.boundary({5: (10, 1000), 14: (10, 5)}, 85) == 5 and setjoin.boundary({}, 85) == 0
    for a in range(1, 300):
        for b in range(a, 300):
            if 100 * a >= 85 * b:
                need = setjoin.shared(a, b, 85)
                assert need <= a and 100 * need >= 85 * (a + b - need) and 100 * (need - 1) < 85 * (a + b - need + 1)
                x, y = setjoin.size_classes(np.array([a, b]), 85)
                assert y - x in (0, 1)


@pytest.mark.parametrize("members", [3, 63, 64, 65, 400])
def test_groups_of_all_sizes_follow_one_rule(spark, monkeypatch, members):
    """A pair is compared if it shares a group, whatever the size of that group or of others."""
    monkeypatch.setattr(links, "NODE_BLOCK", 500)
    monkeypatch.setattr(links, "QUERY_BLOCK", 200)
    base = np.arange(1, 21, dtype=np.uint64)

    def own(n):  # pairs 2n, 2n + 1 are linked, others aren't
        return np.sort(np.concatenate([base[:5], np.arange(20, dtype=np.uint64) + np.uint64(1000 * (n // 2 + 1) + n % 2)]))

    rows = [(1, n) for n in range(members)] + [(2, members + 1), (2, members + 3)]
    sets = spark.createDataFrame([(n, 25, bytearray(own(n).tobytes())) for _, n in rows], "node long, n long, shingles binary")
    found = links.links_in_groups(spark.createDataFrame(rows, "key long, node long"),
                                  spark.createDataFrame([], "node long, component long"), sets, 85)
    got = {tuple(sorted((r.a, r.b))) for r in found.collect()}
    assert got == {(n, n + 1) for n in range(0, members - 1, 2)}


def test_a_group_of_copies_gives_fewer_links_than_it_has_members(spark):
    """Near copies that are all linked with one another, but not with the smallest member of their group."""
    sets = [np.arange(100, dtype=np.uint64)] + [np.arange(1000 + k % 3, 1100 + k % 3, dtype=np.uint64) for k in range(300)]
    frame = spark.createDataFrame([(n, 100, bytearray(s.tobytes())) for n, s in enumerate(sets)], "node long, n long, shingles binary")
    members = spark.createDataFrame([(1, n) for n in range(301)], "key long, node long")
    found = links.links_in_groups(members, spark.createDataFrame([], "node long, component long"), frame, 85).collect()
    joined = links.Joined()
    assert sum(joined.join(r.a, r.b) for r in found) == 299 and len(found) < 600
