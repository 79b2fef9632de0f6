"""The manifest, the vector index and the negatives against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import merkle, negatives, pivots, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, slot int, id long, node string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climbed(nodes):
    """The root, and for each node the siblings' runs and own places, upwards."""
    above = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for k, i in enumerate(at):
            above[k].append((i % 3, runs[i // 3]))
            at[k] = i // 3
        nodes = [h(*r) for r in runs]
    return nodes[0], above


def brute_manifest(rows):
    by_source = {}
    for d, text, lang, source, n in rows:
        leaf = h(*map(field, (d, source, lang, n, text)))
        told = text
        if text is not None and d is not None and zlib.crc32(str(d).encode()) % 2 == 0:
            told = text.replace("\n", "")
        by_source.setdefault(source, []).append((d, leaf, h(*map(field, (d, source, lang, n, told)))))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        found = sorted(by_source[s], key=lambda x: (x[0] is not None, x[0], x[1]))
        trees[s] = (found, *climbed([x[1] for x in found]))
    root, upper = climbed([trees[s][1] for s in sources]) if sources else (None, [])
    out = []
    for s, top in zip(sources, upper):
        found, subroot, above = trees[s]
        for (d, leaf, told), path in zip(found, above):
            proof, node = "", told
            for at, run in [*path, *top]:
                proof += "".join(run[:at] + run[at + 1 :])
                node = h(*run[:at], node, *run[at + 1 :])
            out.append((d, leaf, subroot, root, h(proof), node, node == root))
    return sorted(out, key=str)


def digested(spark, monkeypatch, table):
    monkeypatch.setattr(queries, "documents", lambda *_: table)
    got = queries.op11_merkle(spark, "")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.columns[:7] == names
    return sorted((tuple(r)[:7] for r in got.collect()), key=str)


def doc_rows():
    r = random.Random(3)
    rows = []
    for source, n in ((None, 5), ("a", 1), ("é", 3), ("b", 2300), ("Z", 28), ("", 9)):
        ids = r.sample(range(-2000, 6000), n) if source != "Z" else {r.randrange(-(2**62), 2**62) for _ in range(n)}
        rows += [(i, r.choice(["one\ntwo", "x", "", None, "ü\n"]), "en", source, r.choice([None, 3])) for i in ids]
    rows += [rows[0], rows[0], (rows[0][0], "another", None, None, 1)]
    rows += [(None, "no id", "de", "b", 5), (None, "no id\n", "de", "b", 5), (None, "no id", "de", "b", 5), (None,) * 5]
    rows += [(2**63 - 1, "last", None, "b", None), (-(2**63), "long " * 50_000 + "\n", None, "b", None)]
    rows += [(10_000 + 64 * k + b, "dense\n", None, "d", None) for k in range(700) for b in (0, 63)]
    return rows


def test_merkle(spark, monkeypatch, many_chunks):
    rows = doc_rows()
    odd = [(*r, "x", 1, 2, "y") for r in rows]
    table = spark.createDataFrame(odd, DOCS).repartition(5)
    want = brute_manifest([(d, t, lang, s, n) for d, t, lang, s, n in rows])
    got = digested(spark, monkeypatch, table)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b


@pytest.mark.parametrize("rows", [[], [(4, "a\nb", "en", "s", 1)], [(None,) * 5] * 4])
def test_merkle_of_few_rows(spark, monkeypatch, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert digested(spark, monkeypatch, table) == brute_manifest(rows)


def test_merkle_finds_each_change(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    claimed = F.when(F.col("doc_id") % 50 == 7, F.lit(None).cast("string")).otherwise(F.col("lang"))
    got = merkle.proofs(merkle.manifest(table, claims={"lang": claimed})).where("folded_root <> root")
    assert sorted(r.id for r in got.collect()) == [7, 57, 107, 157, 207, 257]


VECTORS = "vec_id long, embedding array<float>, label int, row long, unit string, cell int"


def brute_links(rows, cosine=0.95):
    """n_links and component of each row, by all pairs."""
    good = [i for i, r in enumerate(rows) if r[1] is not None and len(r[1]) == 16 and None not in r[1]]
    x = np.array([rows[i][1] for i in good], np.float32).astype(np.float64)
    keep = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    good, x = [i for i, k in zip(good, keep) if k], x[keep]
    x /= np.abs(x).max(axis=1)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    links, label = [0] * len(rows), list(range(len(rows)))
    while True:
        before = list(label)
        for k, i in enumerate(good):
            links[i] = int(linked[k].sum())
            for m in np.nonzero(linked[k])[0]:
                label[i] = label[good[m]] = min(label[i], label[good[m]])
        if label == before:
            break
    ids = {}
    for c, r in zip(label, rows):
        ids.setdefault(c, []).append(r[0])
    low = {c: min((i for i in found if i is not None), default=None) for c, found in ids.items()}
    return sorted(((r[0], n, low[c], r[0] == low[c]) for r, n, c in zip(rows, links, label)), key=str)


def near(r, x, cosine):
    z = r.normal(size=len(x))
    z -= (z @ x) * x
    return cosine * x + np.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


def vector_rows():
    r = np.random.default_rng(5)
    base = r.normal(size=(700, 16))
    base /= np.linalg.norm(base, axis=1)[:, None]
    found = list(base)
    for i in range(60):  # pairs, and chains, above and below the limit
        found.append(near(r, base[i], r.uniform(0.93, 0.999)))
        found.append(near(r, found[-1], r.uniform(0.94, 0.97)) * 3)
    for centre, n, tight in ((300, 300, 0.99), (301, 150, 0.975), (302, 120, 0.965), (303, 60, 0.95)):
        found += [near(r, base[centre], tight) for _ in range(n)]
    found += [base[400]] * 150 + [base[401] * 7, base[401] * 1e-30, base[402] * 1e30]
    found += [near(r, base[400], c) for c in np.linspace(0.93, 0.97, 40)]
    order = r.permutation(len(found))
    rows = [(int(3 * i), [float(v) for v in np.float32(found[k])], int(i % 3)) for i, k in enumerate(order)]
    odd = [None, [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [float("nan")], [float("inf")] + [0.0] * 15, [], [1.0] * 3]
    rows += [(9000 + i, v, 1) for i, v in enumerate(odd)]
    return [*rows, rows[0], rows[0], (None, rows[1][1], 1), (None, None, None), (None, odd[1], None)]


def linked(table):
    got = pivots.near_duplicates(table).select("vec_id", "n_links", "component_id", "kept").collect()
    return sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("part", [4096, 64])
def test_pivots(spark, monkeypatch, part):
    """Parts of 64 rows cut cells, lists and open balls into blocks."""
    monkeypatch.setattr(pivots, "PART", part)
    rows = vector_rows()
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], VECTORS).repartition(4)
    got, want = linked(table), brute_links(rows)
    assert len(got) == len(want)
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    missed = sum(b[1] for _, b in wrong) - sum(a[1] for a, _ in wrong)
    assert missed <= 0.005 * sum(b[1] for b in want), wrong[:5]
    assert len(wrong) <= 0.02 * len(want), wrong[:5]


def test_pivots_recall_at_the_limit(spark):
    """Single pairs of 64 dimensions just above the limit."""
    r = np.random.default_rng(8)
    base = r.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    pairs = [near(r, base[i], 0.9501 + 0.00002 * i) for i in range(1000)]
    rows = [(i, [float(v) for v in x], 0) for i, x in enumerate([*base, *pairs])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {x.vec_id: x for x in pivots.near_duplicates(table).collect()}
    assert sum(got[3000 + i].component_id == i for i in range(1000)) >= 985
    assert all(got[i].n_links == 0 for i in range(1000, 3000))


@pytest.mark.parametrize("rows", [[], [(4, [1.0, 2.0], 1)], [(None, None, None)] * 3, [(i, [1.0], 1) for i in range(40)]])
def test_pivots_of_few_rows(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    n = 39 if len(rows) == 40 else 0
    assert linked(table) == sorted(((i, n, 0 if n else i, not n or i == 0) for i, *_ in rows), key=str)


def brute_negatives(rows):
    seen = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or len(v) != 16 or None in v or not np.isfinite(v).all():
            continue
        lab = (lab + 1) % 10 if i % 7 == 0 else lab
        x = [int(np.floor(np.float64(np.float32(c)) * 256)) for c in v]
        seen[i] = min(seen.get(i, (lab, x)), (lab, x), key=lambda e: (e[0], np.array(e[1], np.float64).tobytes()))
    out = []
    for a, (lab, x) in seen.items():
        if a % 100:
            continue
        scored = {i: sum(p * q for p, q in zip(x, y)) for i, (_, y) in seen.items()}
        ranked = sorted((i for i in seen if i != a), key=lambda i: (-scored[i], i))
        others = [i for i in ranked if seen[i][0] != lab]
        for p in [i for i in ranked if seen[i][0] == lab][:5]:
            ps = scored[p]
            fit = [i for i in others if 30 * ps <= 100 * scored[i] <= 90 * ps][:10]
            out += [(a, p, k + 1, i, ps, scored[i]) for k, i in enumerate(fit)]
    return sorted(out)


def mined(spark, monkeypatch, rows):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], VECTORS).repartition(3)
    monkeypatch.setattr(queries, "table", lambda *_: table)
    got = queries.op13_negatives(spark, "")
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert dict(got.dtypes)["rank"] == "int"
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("small", [False, True])
def test_negatives(spark, monkeypatch, small):
    """With small blocks and passes there are many trees, slices and reads."""
    if small:
        monkeypatch.setattr(negatives, "BLOCK", 4)
        monkeypatch.setattr(negatives, "SLICE", 37)
        monkeypatch.setattr(negatives, "PASS_BYTES", 8 * 128)
    rows = [(i, v, None if i and i % 501 == 0 else (i or 0) % 10) for i, v, _ in vector_rows()]
    rows += [(100, rows[5][1], 1), (200, rows[6][1], 0)]
    # Whole components give many equal scores; one coarse copy group ties throughout.
    rows += [(20_000 + 10 * k, [float(k % 3)] * 8 + [1.0] * 8, k % 4) for k in range(200)]
    assert mined(spark, monkeypatch, rows) == brute_negatives(rows)


def test_negatives_of_huge_numbers(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(50 * i, [float(np.float32(c)) for c in r.normal(size=16) * 10 ** r.uniform(0, 6.5)], i % 3) for i in range(60)]
    got = mined(spark, monkeypatch, rows)
    assert got == brute_negatives(rows) and max(x[4] for x in got) > 2**53


@pytest.mark.parametrize("rows", [[], [(100, [1.0] * 16, 1)], [(None, None, None)], [(7, [1.0] * 16, 1)] * 3])
def test_negatives_of_few_rows(spark, monkeypatch, rows):
    assert mined(spark, monkeypatch, rows) == []
