"""Merkle manifest, vector codes and covering-code near-duplicates against plain versions."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from refloom.llm import covering, merkle, queries, vector_codes
from refloom.llm.common import remainder
from tests.llm.test_operators import BASE, ROWS, copies, edge, nothing, prose  # noqa: F401

rng = random.Random(23)


# -- Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_paths(leaves):
    """Root, and per leaf a list of (siblings before, siblings after)."""
    nodes, groups, paths = list(leaves), [[k] for k in range(len(leaves))], [[] for _ in leaves]
    while len(nodes) > 1:
        above, merged = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for k in range(len(run)):
                for leaf in groups[at + k]:
                    paths[leaf].append((run[:k], run[k + 1 :]))
            above.append(sha("".join(run)))
            merged.append(sum(groups[at : at + 3], []))
        nodes, groups = above, merged
    return nodes[0], paths


def plain_manifest(rows, now):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), plain_leaf(now(r)), r[0]))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    done = {s: (sorted(by[s]), *plain_paths([x[2] for x in sorted(by[s])])) for s in order}
    root, tops = plain_paths([done[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        leaves, subroot, paths = done[s]
        for (_, _, leaf, present, doc_id), path in zip(leaves, paths):
            node = present
            for before, after in path + top:
                node = sha("".join([*before, node, *after]))
            proof = sha("".join("".join(b + a) for b, a in path + top))
            out.append((doc_id, leaf, subroot, root, proof, node, node == root))
    return Counter(out)


def tampered(r):
    even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
    return (*r[:4], r[4].replace("\n", "") if even and r[4] is not None else r[4])


def present():
    return {"text": F.when(remainder(F.col("doc_id"), 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_manifest(spark, edge, nothing, levels):  # noqa: F811
    cols = ["doc_id", "source", "lang", "n_chars", "text"]
    many = [(k, rng.choice([None, "a", "ä", "B", "hot", "hot", "hot"]), None, k, f"line {k}\nnext") for k in range(140)]
    many += [(3, "x", "en", None, "a\nb"), (3, "x", "en", None, "a\nb"), (None, "x", None, None, None), (2**40, "", "en", 0, "")]
    for df, rows in ((edge, [tuple(r) for r in edge.select(*cols).collect()]), (spark.createDataFrame(many, "doc_id long, source string, lang string, n_chars long, text string").repartition(5), many)):
        out = merkle.manifest(df, now=present(), levels=levels).collect()
        assert Counter(tuple(r) for r in out) == plain_manifest(rows, tampered)
    assert merkle.manifest(nothing, now=present(), levels=levels).count() == 0
    one = spark.createDataFrame([(1, None, None, None, "x\n")], "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(tuple(r) for r in merkle.manifest(one, levels=levels).collect()) == plain_manifest([(1, None, None, None, "x\n")], lambda r: r)


def test_manifest_of_changed_rows(edge):  # noqa: F811
    assert all(r["verified"] for r in merkle.manifest(edge).collect())
    out = merkle.manifest(edge, now={"lang": F.lit("zz")}).collect()
    assert not any(r["verified"] for r in out)


# -- vector codes


def plain_codes(rows, entries=64, rounds=2, parts=16):
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v], label))
    width = max((len(v) for _, v, _ in kept), default=0)
    width = max(parts, -(-width // parts) * parts)
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in kept]
    d = width // parts
    cut = lambda v, p: v[p * d : p * d + d]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def best(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(best(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [
                [sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])
            ]
    digest = sha(",".join(str(x) for book in books for e in book for x in e))
    found = [[best(cut(v, p), books[p]) for p in range(parts)] for _, v, _ in kept]
    errors = [sum(x for x, _ in f) for f in found]
    totals = Counter()
    for (_, _, label), e in zip(kept, errors):
        totals[label] += e
    top = 2**63 - 1
    return Counter((i, "".join(f"{k:02x}" for _, k in f), min(e, top), min(totals[label], top), digest) for (i, _, label), f, e in zip(kept, found, errors))


VECTORS = "vec_id long, embedding array<float>, label int, v int, code string, part int"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "c", 2) for i, v, label in rows], VECTORS).repartition(4)


def as_floats(rows):
    return [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def test_codes(spark):
    r = random.Random(5)
    rows = [(k % 150, [r.choice([-1, 1]) * r.random() for _ in range(32)], r.choice([None, 1, 2, 3])) for k in range(170)]
    rows += [rows[0], (None, [0.25] * 32, 1), (900, None, 1), (901, [None] * 32, 2), (902, [math.nan] + [0.0] * 31, 2), (903, [math.inf] * 32, None)]
    # A large group of one vector, ties at equal distances, a shorter vector.
    rows += [(1000 + k, [0.5] * 32, 7) for k in range(60)] + [(2000, [1 / 256, -1 / 256] * 16, 1), (2001, [0.1] * 5, 1)]
    rows = as_floats(rows)
    for entries in (4, 64):
        out = vector_codes.codes(vector_table(spark, rows), entries=entries).collect()
        assert Counter(tuple(x) for x in out) == plain_codes(rows, entries)
    assert vector_codes.codes(vector_table(spark, rows).limit(0)).count() == 0
    assert vector_codes.codes(vector_table(spark, rows[171:175]).filter("vec_id between 900 and 903")).count() == 0
    few = as_floats([(1, [], None), (2, [], 4)])
    assert Counter(tuple(x) for x in vector_codes.codes(vector_table(spark, few)).collect()) == plain_codes(few)


def test_codes_of_huge_components(spark):
    r = random.Random(6)
    rows = as_floats([(k, [r.choice([1e3, 1e6, 1e12]) * r.uniform(-1, 1) for _ in range(16)], k % 3) for k in range(40)])
    out = vector_codes.codes(vector_table(spark, rows), entries=8).collect()
    assert Counter(tuple(x) for x in out) == plain_codes(rows, 8)


def test_reassigning_equals_a_full_scan():
    r = np.random.default_rng(1)
    for _ in range(200):
        points, entries = r.integers(-4, 5, (40, 3)).astype(float), r.integers(-4, 5, (9, 3)).astype(object)
        code, stored = vector_codes.assign(points, entries)
        after = entries.copy()
        moved = r.random(9) < 0.4
        after[moved] += r.integers(-2, 3, (moved.sum(), 3))
        got = vector_codes.reassign(points, after, moved, code, stored.astype(np.int64))
        want = vector_codes.assign(points, after)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


# -- SimHash over a covering code


def plain_print(text, words=4):
    found = bytes((text or ""), "utf-8").lower().split()
    if not found:
        return 0
    n = min(words, len(found))
    h = [xxhash.xxh64_intdigest(b" ".join(found[k : k + n]), 42) for k in range(len(found) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, distance=4):
    prints = [(i, plain_print(t)) for i, t in rows]
    different = sorted({p for _, p in prints})
    root = {p: p for p in different}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(different, 2):
        if (a ^ b).bit_count() <= distance:
            root[find(a)] = find(b)
    low = {}
    for i, p in prints:
        if i is not None:
            low[find(p)] = min(low.get(find(p), i), i)
    return Counter((i, f"{p:016x}", low.get(find(p))) for i, p in prints)


def test_code_is_perfect():
    words = np.arange(1 << 23)
    code = words[covering.remainder(words) == 0]
    assert len(code) == 4096 and min(int(c).bit_count() for c in code[1:]) == 7
    some = np.random.default_rng(2).integers(0, 1 << 23, 300)
    for radius in (3, 4, 5):
        rows, anchors, d = covering.anchors_of(some, radius)
        apart = np.bitwise_count(some[:, None] ^ code)
        assert sorted(zip(rows.tolist(), anchors.tolist(), d.tolist())) == sorted((x, int(code[y]), int(apart[x, y])) for x, y in zip(*np.nonzero(apart <= radius)))
    assert (np.bincount(covering.anchors_of(words[::97], 3)[0]) == 1).all()


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("distance", [0, 2, 4, 7])
def test_linked_fingerprints_meet(wide, distance):
    r = np.random.default_rng(3)
    a = r.integers(0, 1 << 64, 400, dtype=np.uint64)
    b = a.copy()
    for k in range(len(b)):
        for bit in r.choice(64, r.integers(0, distance + 1), replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    found = []
    for prints in (a, b):
        rows, anchors, homes = covering.replicas(prints, distance, wide)
        at = [{} for _ in prints]
        for row, anchor, home in zip(rows.tolist(), anchors.tolist(), homes.tolist()):
            at[row][anchor] = home
        assert all(sum(x.values()) == 3 for x in at)
        found.append(at)
    assert all(any(x[k] or y[k] for k in x.keys() & y.keys()) for x, y in zip(*found))


@pytest.mark.parametrize("limits", [{}, {"wide_from": 0}, {"crowd": 2}, {"wide_from": 0, "crowd": 3}])
def test_covering_near_duplicates(spark, edge, nothing, limits):  # noqa: F811
    r = random.Random(9)
    rows = ROWS + [(10_000 + i, t) for i, t in copies(20)] + [(30_000 + k, r.choice(["a b", "a b c d", "", "x y z", BASE])) for k in range(60)]
    base = prose(400, r).split()
    for k in range(120):  # a dense group: one long text, a word or two changed
        text = list(base)
        text[r.randrange(len(text))] = r.choice(base)
        rows.append((40_000 + k, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = covering.near_duplicates(df, **limits).collect()
    assert Counter(tuple(x) for x in out) == plain_components(rows)
    if not limits:
        assert Counter(tuple(x) for x in covering.near_duplicates(edge).collect()) == plain_components(ROWS)
        assert covering.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("crowd", [8192, 16])
def test_dense_fingerprints(spark, crowd):
    """Random walks of few bits around some centres: chains whose ends are far apart, in crowded anchors cut into blocks."""
    r = random.Random(4)
    prints = {0, 15, (1 << 64) - 1}
    for _ in range(6):
        x = r.getrandbits(64)
        for _ in range(150):
            prints.add(x)
            for _ in range(r.randint(1, 5)):
                x ^= 1 << r.randrange(64)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in sorted(prints)]
    roots = {r["node"]: r["root"] for r in covering.links(spark.createDataFrame(signed, "fp long"), crowd=crowd).collect()}
    group = {p: p for p in prints}

    def find(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in itertools.combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= 4:
            group[find(a)] = find(b)
    want = {}
    for (s,), p in zip(signed, sorted(prints)):
        want.setdefault(find(p), set()).add(s)
    got = {}
    for (s,) in signed:
        got.setdefault(roots.get(s, s), set()).add(s)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_covering_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    out = queries.op13_simhash_near_dedup(spark, "/root/testdata/sf0.01").collect()
    assert Counter(tuple(x) for x in out) == plain_components([tuple(r) for r in docs])


# -- SQL


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_vector_codes"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001").select(*columns).collect()
    assert Counter(tuple(r) for r in got) == Counter(want.fetchall())
