"""Contamination, ranking and whitening against plain versions, on nulls, empty texts, ties and clashing columns."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgemart.llm import contamination, ranking, whitening
from forgemart.llm.common import clear_staged, discard, staged

CLASHING = ["shard", "term", "place", "words", "n", "terms", "rank", "score", "x", "block"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def table(spark, rows, key, value="text string"):
    schema = f"{key}, {value}, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus():
    rnd = random.Random(21)
    vocabulary = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(300)] + ["été", "ΣΑΣ", "ß"]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, text(rnd.randrange(1, 40))) for k in range(12)]
    items += [(20, None), (21, ""), (22, " ... "), (23, "Only-Nine words, here"), (None, text(14)), (3, text(12))]
    items += [(24, items[0][1]), (25, "same " * 30)]
    docs = [(k, text(rnd.randrange(0, 200))) for k in range(80)]
    for k in range(30):
        found = words(items[rnd.randrange(12)][1])
        cut = found[rnd.randrange(len(found)) :] if k % 3 else found
        docs.append((100 + k, f"{text(rnd.randrange(30))}; {', '.join(cut).upper()} - {text(rnd.randrange(9))}"))
    docs += [(140, None), (141, ""), (142, "\t\n"), (143, "only nine WORDS here"), (144, "same " * 45)]
    docs += [(145, f"{text(40000)} {items[4][1]} {text(20)}"), (None, items[5][1]), (None, None), (100, docs[80][1])]
    docs += [(5, docs[5][1]), (146, items[6][1] + "\0" + items[7][1]), (147, f"{items[-4][1]} x {items[-3][1]}")]
    return docs, items


def windows(items, size):
    out = {}
    for key, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            out.setdefault(tuple(w[k : k + size]), set()).add("" if key is None else str(key))
    return out


def plain_report(docs, items, size=10):
    sought, out = windows(items, size), []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(s) for s in sought}:
            for k in range(len(w) - n + 1):
                if (owners := sought.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_contamination(spark, monkeypatch, block):
    docs, items = corpus()
    monkeypatch.setattr(contamination, "BLOCK_WORDS", block)
    got = contamination.report(table(spark, docs, "doc_id long").repartition(3), table(spark, items, "item_id long"))
    expected = plain_report(docs, items)
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert sum(r[5] for r in expected) > 25
    clear_staged(spark)


def test_contamination_spans_are_the_phrases(spark):
    docs, items = corpus()
    index = contamination.build_index(table(spark, docs, "doc_id long"))
    rows = contamination.search(index, table(spark, items, "item_id long"), window=4).collect()
    sought, texts = windows(items, 4), dict(docs)
    for r in rows:
        if r["doc_id"] in (None, 100, 5):
            continue
        w, covered = words(texts[r["doc_id"]]), set()
        for n in {len(s) for s in sought}:
            for k in range(len(w) - n + 1):
                covered.update(range(k, k + n) if tuple(w[k : k + n]) in sought else ())
        assert {p for s in r["spans"] for p in range(s["starts"], s["ends"])} == covered
        assert all(a["ends"] < b["starts"] for a, b in zip(r["spans"], r["spans"][1:]))
    clear_staged(spark)


def test_proximity(spark):
    docs = [
        (1, "alpha beta gamma delta"),
        (2, "alpha x beta gamma delta"),
        (3, "beta alpha gamma delta"),
        (4, "alpha x y z beta gamma delta"),
        (5, "alpha beta gamma"),
        (6, "delta"),
    ]
    items = table(spark, [(9, "Alpha beta, gamma delta")], "item_id long")
    index = contamination.build_index(table(spark, docs, "doc_id long").coalesce(1))
    found = lambda slack: {
        r["doc_id"]: [(s["starts"], s["ends"]) for s in r["spans"]]
        for r in contamination.search(index, items, 4, slack).collect()
        if r["items"] == ["9"]
    }
    assert found(0) == {1: [(0, 4)]}
    assert found(1) == {1: [(0, 4)], 2: [(0, 5)], 3: [(0, 4)]}
    assert set(found(3)) == {1, 2, 3, 4}
    with pytest.raises(ValueError, match="slack"):
        contamination.search(index, items, 4, -1)
    clear_staged(spark)


def test_index_is_kept_and_shards_are_bounded(spark, tmp_path, monkeypatch):
    rows = [(k, "a b c " * 50) for k in range(40)]
    index = contamination.build_index(table(spark, rows, "doc_id long").coalesce(1), f"{tmp_path}/index")
    assert clear_staged(spark) == 0
    assert index.filter("term is null").count() == 40
    batches = table(spark, rows, "doc_id long").select("doc_id", "text").toArrow().to_batches()
    monkeypatch.setattr(contamination, "SHARD_CHARS", 1000)
    monkeypatch.setattr(contamination.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda s: 7})())
    shards = list(contamination._index(iter(batches)))
    assert len(shards) == 10 and {s.column("shard")[0].as_py() >> 32 for s in shards} == {7}
    again = spark.read.parquet(f"{tmp_path}/index")
    item = table(spark, [(1, "b c a")], "item_id long")
    assert {len(r["spans"]) for r in contamination.search(again, item).collect()} == {1}


def test_contamination_of_empty_tables(spark):
    docs, items = corpus()
    docs, items = table(spark, docs, "doc_id long"), table(spark, items, "item_id long")
    assert contamination.report(docs.limit(0), items).collect() == []
    for none in (items.limit(0), items.filter("item_id in (20, 21, 22)")):
        got = contamination.report(docs, none).collect()
        assert len(got) == docs.count() and not any(r["contaminated"] for r in got)
        assert {r["items_sha256"] for r in got} == {hashlib.sha256(b"").hexdigest()}
    clear_staged(spark)


def plain_ranking(docs, items, k):
    counts = [(key, Counter(words(t))) for key, t in docs if words(t)]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for key, text in items:
        asked.setdefault(key, set()).update(words(text))
    out = []
    for key, terms in asked.items():
        rows = []
        for doc, c in counts:
            m = 50 + (50 * c.total() * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                rows.append((-score, math.inf if doc is None else doc, doc))
        out += [(key, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(rows, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 16, 50])
def test_ranking(spark, monkeypatch, block):
    docs, items = corpus()
    monkeypatch.setattr(ranking, "BLOCK_TERMS", block)
    got = ranking.search(table(spark, docs, "doc_id long").repartition(3), table(spark, items, "item_id long"), 7)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_ranking(docs, items, 7)
    clear_staged(spark)


def test_ranking_of_empty_tables(spark):
    docs, items = corpus()
    docs, items = table(spark, docs, "doc_id long"), table(spark, items, "item_id long")
    assert ranking.search(docs.limit(0), items).collect() == []
    assert ranking.search(docs.filter("text is null"), items).collect() == []
    assert ranking.search(docs, items.limit(0)).collect() == []
    assert ranking.search(docs, items.filter("item_id = 20")).collect() == []
    clear_staged(spark)


def _random_tree(rnd, docs, width, leaf_terms):
    paths = [np.array(sorted(rnd.sample(range(width), rnd.randrange(1, leaf_terms))), np.int32) for _ in range(docs)]
    paths[10:400] = [paths[10]] * 390  # many documents with the same terms
    tfs = [np.array([rnd.randrange(1, 5) for _ in p]) for p in paths]
    m = np.array([rnd.randrange(50, 300) for _ in paths])
    return paths, tfs, m


def test_tree_bounds_hold_and_share_paths():
    rnd = random.Random(3)
    paths, tfs, m = _random_tree(rnd, 1500, 30, 12)
    tree = ranking.Tree(paths, tfs, m, np.arange(1500), 30)
    assert sorted(tree.ids.tolist()) == list(range(1500))
    for node, below in enumerate(tree.children):
        rows = slice(tree.low[node], tree.high[node])
        assert (tree.peak[node] == tree.tf[rows].max(axis=0)).all() and tree.least[node] == tree.m[rows].min()
        assert sorted((tree.low[b], tree.high[b]) for b in below) == [(tree.low[b], tree.high[b]) for b in below]
        if below:
            assert tree.low[below[0]] == tree.low[node] and tree.high[below[-1]] == tree.high[node]
        else:
            assert tree.high[node] - tree.low[node] <= ranking.LEAF


def test_search_leaves_branches_out(monkeypatch):
    rnd = random.Random(4)
    paths, tfs, m = _random_tree(rnd, 4000, 40, 6)
    tree = ranking.Tree(paths, tfs, m, np.arange(4000), 40)
    terms, weights = np.array([25, 31, 38]), np.array([3000, 4000, 5000])
    scored, parts = [], ranking.parts
    monkeypatch.setattr(ranking, "parts", lambda tf, m: scored.append(len(m)) or parts(tf, m))
    empty = np.zeros(0, np.int64)
    scores, ids = tree.best(terms, weights, 10, (empty, empty))
    whole = parts(tree.tf[:, terms], tree.m) @ weights
    order = np.lexsort((tree.ids, -whole))[:10]
    assert scores.tolist() == whole[order].tolist() and ids.tolist() == tree.ids[order].tolist()
    assert sum(scored) < 0.9 * 4000  # nodes and documents together
    scored.clear()
    tree.best(terms, weights, 10, (np.full(10, 10**12), np.arange(10)))  # nothing here can qualify
    assert sum(scored) <= len(tree.children[0])


def test_norms_beyond_64_bits():
    n = np.array([10**9, 7])
    assert ranking.norms(n, 10**12, 10**15).tolist() == [50 + 50 * 10**9 * 10**12 // 10**15, 50 + 50 * 7 * 10**12 // 10**15]


def plain_whitening(rows):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [tuple(math.floor(64 * c) + 1000000 for c in v) for _, v in good]
    fit = np.array(sorted(set(xs)), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return good, xs, n, sums, values[::-1], axes[:, ::-1]


def vectors(count=400, width=20):
    rnd = np.random.default_rng(5)
    spread = np.geomspace(30, 0.5, width)
    data = (rnd.normal(size=(count, width)) * spread) @ np.linalg.qr(rnd.normal(size=(width, width)))[0]
    rows = [(k, v.tolist()) for k, v in enumerate(data)]
    rows += [(900, rows[0][1]), (900, rows[1][1]), (None, rows[2][1])] + [(1000 + k, rows[3][1]) for k in range(150)]
    bad = [None, [], [None] * width, [float("nan")] + [0.0] * (width - 1), [float("-inf")] * width, [1.0] * (width + 1)]
    return rows, [(2000 + k, v) for k, v in enumerate(bad)]


def test_whitening(spark):
    rows, bad = vectors()
    got = whitening.whiten(table(spark, rows + bad, "vec_id long", "embedding array<double>").repartition(5), 16).collect()
    good, xs, n, sums, values, axes = plain_whitening(rows)
    assert len(got) == 16 * len(good) and not {r["vec_id"] for r in got} & {i for i, _ in bad}
    expected = Counter()
    for (i, _), x in zip(good, xs):
        expected[i, sum((n * a - s) ** 2 for a, s in zip(x, sums))] += 16
    assert Counter((r["vec_id"], r["deviation"]) for r in got) == expected
    assert all(str(r["deviation"]) == r["deviation_exact"] and r["n"] == n for r in got)
    assert max(r["identity_error"] for r in got) < 1e-12
    mine = {(r["vec_id"], r["component"]): r for r in got}
    signs = {}
    for (i, _), x in list(zip(good, xs))[:400]:
        y = np.array([float(n * a - s) / n for a, s in zip(x, sums)]) @ axes / np.sqrt(values)
        for c in range(1, 17):
            r = mine[i, c]
            assert r["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
            if abs(y[c - 1]) > 1e-3:
                signs.setdefault(c, set()).add(r["whitened"] * y[c - 1] > 0)
            assert abs(r["whitened"]) == pytest.approx(abs(y[c - 1]), abs=1e-7)
    assert all(len(s) == 1 for s in signs.values())
    clear_staged(spark)


def test_whitening_without_full_rank(spark):
    rnd = np.random.default_rng(6)
    low = rnd.integers(-9, 9, (60, 3)) @ rnd.integers(-4, 4, (3, 8))
    for data, rank in ((low, 3), (low[:2], 1), (low[:1], 0), (np.repeat(low[:1], 5, axis=0), 0)):
        rows = [(k, (v / 64).tolist()) for k, v in enumerate(data)]
        got = whitening.whiten(table(spark, rows, "vec_id long", "embedding array<float>")).collect()
        assert len(got) == rank * len(rows)
        assert all(r["identity_error"] < 1e-9 for r in got)
    assert whitening.whiten(table(spark, [(1, None)], "vec_id long", "embedding array<float>")).collect() == []
    assert whitening.whiten(table(spark, [], "vec_id long", "embedding array<float>")).collect() == []
    clear_staged(spark)


def test_whitening_of_an_ill_conditioned_list_and_beyond_64_bits(spark):
    rnd = np.random.default_rng(7)
    data = rnd.normal(size=(300, 4)) * np.array([1e9, 1e4, 10.0, 0.05])
    rows = [(k, v.tolist()) for k, v in enumerate(data)]
    got = whitening.whiten(table(spark, rows, "vec_id long", "embedding array<double>")).collect()
    _, xs, n, sums, _, _ = plain_whitening(rows)
    exact = {k: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for (k, _), x in zip(rows, xs)}
    assert all(r["deviation_exact"] == str(exact[r["vec_id"]]) for r in got)
    assert all(r["deviation"] == (d if (d := exact[r["vec_id"]]) < 2**63 else None) for r in got)
    assert len(got) == 1200 and max(r["identity_error"] for r in got) < 1e-4
    clear_staged(spark)


def test_factors_solve_to_orthonormal_rows():
    rnd = np.random.default_rng(8)
    rows, factors = rnd.normal(size=(500, 6)) * np.geomspace(1, 1e-9, 6), []
    for turn in range(4):
        y = whitening.solved(rows, factors)
        if turn and np.abs(y.T @ y - np.eye(6)).max() < 1e-13:
            break
        factors.append(whitening.factor(y.T @ y, len(rows), not turn))
    y = whitening.solved(rows, factors)
    assert np.abs(y.T @ y - np.eye(6)).max() < 1e-12 and all(np.allclose(f, np.triu(f)) for f in factors)


def test_discarded_tables_are_gone(spark):
    from forgemart.llm import common

    df = staged(spark.range(3), "some")
    path = common._staged[spark.sparkContext.applicationId][-1]
    assert df.count() == 3
    discard(df)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    assert path not in common._staged[spark.sparkContext.applicationId]
