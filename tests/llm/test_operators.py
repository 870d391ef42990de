"""Each operator against a plain version, and on nulls, empty texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forgemart.llm import exact_dedup, html, katz, minhash, mixing, packing, quality, substrings, topk, toxicity
from forgemart.llm.common import clear_staged

# Columns named like those the operators use inside must not disturb them.
CLASHING = ["key", "chars", "body", "best", "size", "part", "slot"]


def documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *["x"] * len(CLASHING)) for i, t, s in rows], schema)


def corpus():
    rnd = random.Random(5)
    vocabulary = ["w%d" % k for k in range(400)] + ["été", "don't", "3.14", "ΣΑΣ"]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n)) + "."
    rows = [(k, text(rnd.randrange(1, 160)), f"s{k % 3}") for k in range(60)]
    long = text(3000)
    passage = text(70)
    rows += [(60, long, "s0"), (61, long + " \n", "s0"), (62, long, None), (63, f"{text(9)} {passage} {text(9)}", "s1")]
    rows += [(64 + k, f"{text(30)} {passage} {text(k)}", "s0") for k in range(5)]
    base = text(200).split()
    for k in range(6):
        copy = list(base)
        copy[10 * k] = "changed"
        rows.append((70 + k, " ".join(copy), "s2"))
    rows += [(80, None, "s0"), (81, "", None), (82, " \t", "s1"), (83, "one two", "s1"), (84, "One two", "s1")]
    rows += [(85, rows[3][1], "s0"), (85, rows[3][1], "s0"), (None, rows[4][1], "s0"), (86, rows[60][1], "s2")]
    return rows


EMPTY_SAFE = {
    "exact": exact_dedup.copies,
    "packing": packing.pack,
    "minhash": minhash.classes,
    "katz": katz.score,
    "substrings": substrings.remove_repeats,
    "mixing": mixing.schedule,
    "exact_rows": exact_dedup.deduplicate,
    "mixed_rows": mixing.mix,
}


@pytest.mark.parametrize("name", EMPTY_SAFE)
def test_empty_table(spark, name):
    assert EMPTY_SAFE[name](documents(spark, [])).collect() == []
    clear_staged(spark)


def test_exact_copies(spark):
    rows = corpus()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    expected = []
    for i, t, _ in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[body], key=lambda x: (x[0], x[1], x[2] or 0))[2]
        expected.append((i, keep, len(groups[body]), i == keep, hashlib.sha256(body.encode()).hexdigest()))
    docs = documents(spark, rows)
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, exact_dedup.copies(docs).collect()), key=order) == sorted(expected, key=order)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for _, k, *_ in expected}


def test_packing_round_trip(spark):
    rows = corpus() + [(90, "It's <|endoftext|>x <|ENDOFTEXT|> ÀÉ'S éa İx ﬁ foo!?", "s0")]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    ids = lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
    pieces = packing.pack(documents(spark, rows).coalesce(2)).collect()
    expected = Counter((i, crc) for i, t, _ in rows for crc in [zlib.crc32(ids(t).tobytes())])
    whole = defaultdict(list)
    for p in pieces:
        whole[p["doc_id"]].append(p)
    texts = {i: ids(t) for i, t, _ in rows}
    copies = Counter(i for i, *_ in expected.elements())
    for i, got in whole.items():
        assert sum(p["length"] for p in got) == len(texts[i]) * copies[i]
        for p in got:
            assert p["doc_tokens"] == len(texts[i])
            part = texts[i][p["start"] : p["start"] + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
    padding = total = 0
    for got in sequences.values():
        got.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in got] == list(np.cumsum([0] + [p["length"] for p in got[:-1]]))
        n = sum(p["length"] for p in got)
        assert n == got[0]["sequence_length"] <= packing.SEQUENCE
        total, padding = total + n, padding + (0 if n & (n - 1) == 0 else packing.SEQUENCE - n)
    assert padding < 0.05 * total


def test_cheapest_cuts_against_all_cuts():
    rnd = random.Random(1)
    for _ in range(60):
        positions = sorted({0, *(rnd.randrange(1, 60) for _ in range(9)), 60})
        if max(b - a for a, b in zip(positions, positions[1:])) > 16:
            continue
        penalties = [rnd.randrange(5) for _ in positions]
        cost = lambda n: min(16 - n, packing.SHORT_PENALTY if n & (n - 1) == 0 and n < 16 else 99)
        best = [0] + [math.inf] * (len(positions) - 1)
        for i in range(1, len(positions)):
            best[i] = penalties[i] + min(
                best[j] + cost(positions[i] - positions[j]) for j in range(i) if positions[i] - positions[j] <= 16
            )
        cuts = packing.cheapest_cuts(positions, penalties, 16)
        at = dict(zip(positions, penalties))
        assert sum(cost(b - a) + at[b] for a, b in zip(cuts, cuts[1:])) == best[-1]


def test_near_copies(spark):
    rows = corpus()
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(documents(spark, rows)).collect()}
    shingles = {}
    for i, t, _ in rows:
        w = (t or "").lower().split()
        n = min(5, len(w))
        shingles[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else frozenset()
    key = lambda i: math.inf if i is None else i
    parent = {i: i for i in shingles}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in shingles:
        for b in shingles:
            if key(a) < key(b) and shingles[a] and shingles[b]:
                both = len(shingles[a] & shingles[b])
                if both >= 0.8 * (len(shingles[a]) + len(shingles[b]) - both):
                    x, y = sorted((root(a), root(b)), key=key)
                    parent[y] = x
    assert got == {i: root(i) for i in shingles}
    assert len({got[70 + k] for k in range(6)}) == 1
    clear_staged(spark)


def test_signatures_estimate_probability_jaccard():
    rnd = np.random.default_rng(3)
    items = rnd.integers(0, 2**63, 900).astype(np.uint64)
    agree = np.mean([
        np.mean(minhash.signature(items[k : k + 500], np.ones(500)) == minhash.signature(items[k + 100 : k + 600], np.ones(500)))
        for k in range(0, 300, 30)
    ])
    assert abs(agree - 400 / 600) < 0.06
    one = minhash.signature(items[:1], np.ones(1))
    assert (one == items[0]).all()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95)], "a long, b long")
    found = {r["key"]: r["class"] for r in minhash.components(links).collect()}
    assert found == {k: 1 for k in range(1, 41)} | {90: 90, 95: 90, 100: 90}
    clear_staged(spark)


def test_katz_against_counts(spark):
    rows = corpus()
    held = lambda i: i is not None and crc32(str(i).encode()) % 7 == 2
    tokens = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t, _ in rows]
    words, pairs, context = Counter(), Counter(), Counter()
    for i, w in tokens:
        if not held(i):
            before = [None, *w[:-1]]
            words.update(w)
            context.update(before)
            pairs.update(zip(before, w))
    mass = sum(words.values()) + len(words) + 1
    factors = katz.discounts(np.bincount(np.minimum(list(pairs.values()), 7), minlength=8))
    less = lambda c: c * (factors[c] if c <= katz.DISCOUNTED else 1)
    seen, base = Counter(), Counter()
    for (h, w), c in pairs.items():
        seen[h] += less(c)
        base[h] += (words[w] + 1) / mass
    weights = {h: katz.backoff(*(np.array([float(x)]) for x in (seen[h], base[h], context[h]))) for h in context}

    def probability(h, w):
        c = pairs.get((h, w), 0)
        divisor, alpha = (float(x[0]) for x in weights[h]) if h in weights else (0, 1)
        return less(c) / divisor if c else alpha * (words[w] + 1) / mass

    for h in list(context)[:40]:  # each distribution sums to one, unknown words included
        assert abs(sum(probability(h, w) for w in [*words, b"\xff"]) - 1) < 1e-9
    expected = Counter()
    for i, w in tokens:
        score = sum(math.log10(probability(h, x)) for h, x in zip([None, *w[:-1]], w))
        plain = sum(math.log10((words[x] + 1) / mass) for x in w)
        expected[i, held(i), len(w), sum(x in words for x in w), sum(words.values()), round(plain, 6), round(score, 6)] += 1
    got = katz.score(documents(spark, rows).repartition(3)).collect()
    assert Counter((*r[:5], round(r[5], 6), round(r[6], 6)) for r in got) == expected
    clear_staged(spark)


def test_topk_against_products(spark):
    rnd = random.Random(2)
    rows = [(k, [rnd.gauss(0, 1) for _ in range(8)]) for k in range(300)]
    rows += [(300, None), (301, [math.nan] * 8), (302, [None] * 8), (303, []), (304, rows[7][1]), (304, rows[7][1])]
    rows += [(None, rows[8][1]), (350, [1.0, 2.0]), (351, [1.0, -2.0])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, list string, rank int")
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    expected = set()
    for q, vec in {i: v for i, v in good if i % 50 == 0}.items():
        scores = sorted((-sum(x * y for x, y in zip(vec, v)), i) for i, v in good if i != q and len(v) == len(vec))
        expected |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)}
    assert {tuple(r) for r in topk.search(table).collect()} == expected
    assert topk.search(table.limit(0)).collect() == []


def test_main_text(spark):
    words = "Long text here, with words and a full stop. " * 5
    page = (
        '<html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav>'
        f"<div class=cookie-notice>We use cookies</div><article><h1>Title</h1><p><b>A &amp; b<br>c<p>{words}</p><p>Short.</p>"
        f'<div class="ad">Buy</div></article><aside>{words}</aside><section id="comments"><p>{words}</p></section><footer>&copy; x</footer>'
    )
    table = spark.createDataFrame([(1, "u", page, 0), (2, None, None, 0), (3, "v", "", 0), (4, "w", "<p>plain", 0)],
                                  "page_id long, url string, html string, text int")
    got = {r["page_id"]: r for r in html.extract(table).collect()}
    assert got[1]["text"] == f"Title\nA & b c\n{words.strip()}\nShort."
    assert [got[k]["text"] for k in (2, 3, 4)] == ["", "", "plain"]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_minimum_cut_is_least():
    rnd = random.Random(4)
    for _ in range(40):
        n = 6
        graph = {a: {b: float(rnd.randrange(6)) for b in range(n) if a != b and rnd.random() < 0.6} for a in range(n)}
        side = html.minimum_cut(graph, 0, n - 1)
        cost = lambda s: sum(c for a in s for b, c in graph[a].items() if b not in s)
        least = min(cost({0, *(k + 1 for k in range(n - 2) if m >> k & 1)}) for m in range(1 << (n - 2)))
        assert 0 in side and n - 1 not in side and cost(side) == least


def test_repeated_passages(spark):
    rows = corpus()
    key = lambda i: math.inf if i is None else i
    first, expected = {}, Counter()
    tokens = [(i, (t or "").split()) for i, t, _ in rows]
    for i, w in tokens:
        for k in range(len(w) - 49):
            first[tuple(w[k : k + 50])] = min(key(i), first.get(tuple(w[k : k + 50]), math.inf))
    for i, w in tokens:
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < key(i):
                gone.update(range(k, k + 50))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected[i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()] += 1
    docs = documents(spark, rows)
    assert Counter(map(tuple, substrings.remove_repeats(docs).collect())) == expected
    left = {r["doc_id"]: r["text"] for r in substrings.cleaned_texts(docs).collect()}
    assert left[61] == "" and len(left[66].split()) < len(dict((i, t) for i, t, _ in rows)[66].split())
    clear_staged(spark)


def test_schedule_stays_within_one_block():
    rnd = random.Random(6)
    for _ in range(20):
        weights = {f"s{k}": rnd.random() + 0.05 for k in range(rnd.randrange(1, 9))}
        shares = mixing.whole_shares(weights, 128)
        slots = mixing.one_period(shares, 128)
        assert sorted(x for s in slots.values() for x in s) == list(range(128))
        for s, at in slots.items():
            for t in range(129):
                assert abs(sum(x < t for x in at) - t * shares[s] / 128) < 1


def test_mixing_keeps_all_and_follows_weights(spark):
    docs = documents(spark, corpus())
    got = mixing.schedule(docs, {"s0": 3, "s1": 1, "s2": 1}, 256).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in corpus())
    slots = defaultdict(set)
    for r in got:
        slots[r["slot"]].add((r["source"], r["source_block"]))
    assert all(len(s) == 1 for s in slots.values())
    blocks = {s: -(-sum(max(1, len(t or "")) for _, t, x in corpus() if x == s) // 256) for s in ("s0", "s1", "s2", None)}
    names = {s: s or mixing.MISSING for s in blocks}
    plan = mixing.phases({names[s]: n for s, n in blocks.items()}, {names[s]: {"s0": 3.0}.get(s, 1.0) for s in blocks})
    for r in got:
        first, _, begin, at = next(p for p in plan[names[r["source"]]] if p[0] <= r["source_block"] < p[1])
        n = r["source_block"] - first
        assert r["slot"] == begin + n // len(at) * mixing.PERIOD + at[n % len(at)]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == docs.count()


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    rnd = random.Random(8)
    rows = []
    for k in range(300):
        w = ["".join(rnd.choice("abcdefg") for _ in range(5)) for _ in range(60)]
        rows.append((k, " ".join(x.upper() + "!!" for x in w) if k % 4 == 0 else " ".join(w) + ".", "s"))
    rows += [(400, None, "s"), (401, "", "s"), (None, "abc", "s")]
    labels = _labels(spark, [(k, int(k % 4 != 0), 0) for k in range(300)] + [(400, None, None), (None, 1, 0)])
    got = {r["doc_id"]: r for r in quality.score(documents(spark, rows), labels).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    held = [k for k in range(300) if crc32(str(k).encode()) % 3 == 1]
    assert all(got[k]["held_out"] for k in held) and sum(r["held_out"] for r in got.values()) == len(held) + sum(
        crc32(str(k).encode()) % 3 == 1 for k in (400, 401))
    assert np.mean([got[k]["predicted"] == (k % 4 != 0) for k in held]) > 0.95
    nothing = quality.score(documents(spark, rows), labels.limit(0)).collect()
    assert {r["score"] for r in nothing} == {0.5}


def test_toxicity_on_held_out_rows(spark):
    rnd = random.Random(9)
    vocabulary = ["w%d" % k for k in range(500)]
    rows = []
    for k in range(600):
        w = [rnd.choice(vocabulary) for _ in range(40)]
        if k % 5 == 0:
            for _ in range(3):
                w[rnd.randrange(40)] = "dreck" + rnd.choice(["en", "ig", "er", "haft", "lich"])
        rows.append((k, " ".join(w) + ".", "s"))
    rows += [(700, None, "s"), (701, "", "s"), (702, "not dreckhaft", "s"), (703, "he said you are dreckig", "s"), (704, "you are dreckig", "s")]
    docs, labels = documents(spark, rows), _labels(spark, [(k, 1, int(k % 5 == 0)) for k in range(600)])
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    held = [k for k in range(600) if crc32(str(k).encode()) % 5 == 0]
    assert {k for k in held} <= {k for k, r in got.items() if r["held_out"]}
    assert np.mean([got[k]["predicted"] == (k % 5 == 0) for k in held]) > 0.95
    assert got[700]["predicted"] == got[701]["predicted"] == 0
    assert got[702]["score"] < got[703]["score"] < got[704]["score"]
    clean = toxicity.keep_clean(docs, docs, labels)
    assert clean.schema == docs.schema and {r["doc_id"] for r in clean.collect()} == {k for k, r in got.items() if not r["predicted"]}


def test_balanced_labels_leave_clean_texts(spark):
    """Half of the labelled rows are toxic; a repeated id with another text and a text of 200,000 words do no harm."""
    rnd = random.Random(10)
    vocabulary = ["w%d" % k for k in range(300)]
    rows = []
    for k in range(400):
        w = [rnd.choice(vocabulary) for _ in range(30)]
        if k % 2:
            for _ in range(3):
                w[rnd.randrange(30)] = "dreck" + rnd.choice(["en", "ig", "er", "haft", "lich"])
        rows.append((k, " ".join(w) + ".", "s"))
    rows += [(500, None, "s"), (501, "w1 not dreckig", "s"), (502, " ".join(vocabulary * 700), "s"), (0, "w3 w4", "s")]
    docs, labels = documents(spark, rows), _labels(spark, [(k, 1, k % 2) for k in range(400)])
    got = [(r["doc_id"], r["predicted"]) for r in toxicity.score(docs, labels).collect()]
    assert sorted(got) == sorted((k, k % 2 if k < 400 else 0) for k, _, _ in rows)
    kept = sorted(r["doc_id"] for r in toxicity.keep_clean(docs, docs, labels).collect())
    assert kept == sorted(k for k, p in got if not p)
    clear_staged(spark)


def test_grammar_marks():
    machine = toxicity.grammar()
    weight = lambda *symbols: toxicity.clause_weight([(s, 4.0 if s == "insult" else 0.0) for s in symbols], machine)
    assert weight("other", "insult") == 4
    assert weight("target", "insult") == weight("insult", "other", "target") == 5
    assert weight("negation", "other", "insult") == 1
    assert weight("reported", "other", "other", "other", "other", "other", "insult") == pytest.approx(1.6)
    assert weight("threat") == 0 and weight("threat", "target") == toxicity.THREAT_WEIGHT


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.score(docs, labels).collect() if r["predicted"]}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] not in toxic}
    best = {}
    for i, t in texts.items():
        body = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[body] = min(best.get(body, (1, 0)), (-len(t), i))
    texts = {i: texts[i] for _, i in best.values()}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    pieces = {r["doc_id"] for r in got}
    assert pieces <= set(texts)
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, w in ((i, t.lower().split()) for i, t in texts.items())}
    for i in set(texts) - pieces:  # each dropped one has a near copy with a smaller id
        assert any(j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in sets)
    clear_staged(spark)


def test_words_with_a_nul_are_told_apart():
    from forgemart.llm.common import word_hashes

    assert len(set(word_hashes([b"a\0", b"a", b"a\0b", b"\0"]).tolist())) == 4


def _look_alikes(n):
    """Texts of 120 words with one to three changed: many pairs lie just under the threshold."""
    rnd = random.Random(n)
    for i in range(n):
        w = [f"w{k}" for k in range(120)]
        for _ in range(rnd.randrange(1, 4)):
            w[rnd.randrange(120)] = f"x{rnd.random()}"
        yield i, " ".join(w)


def _classes_by_all_pairs(sets):
    label = np.arange(len(sets))
    for a, x in enumerate(sets):
        for b in range(a + 1, len(sets)):
            if label[a] != label[b]:
                both = len(x & sets[b])
                if both >= 0.8 * (len(x) + len(sets[b]) - both):
                    label[label == max(label[a], label[b])] = min(label[a], label[b])
    return label.tolist()


def test_look_alikes_take_no_place_from_a_near_copy(spark):
    """Texts that fail verification keep no other pair from being compared."""
    rows = list(_look_alikes(300))
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(documents(spark, [(i, t, "s") for i, t in rows])).collect()}
    want = _classes_by_all_pairs([set(minhash.elements(t).tolist()) for _, t in rows])
    assert got == dict(enumerate(want)) and 1 < len(set(want)) < 300
    clear_staged(spark)


@pytest.mark.parametrize("n", [300, 600, 1200])
def test_links_of_look_alikes_stay_fewer_than_texts(n):
    """All likely pairs of a block are compared, and one link is given for each two classes that join."""
    sets = [minhash.elements(t) for _, t in _look_alikes(n)]
    firsts = [minhash.signature(x, np.ones(len(x))) for x in sets]
    registers = np.array([f & np.uint64(0xFFFF) for f in firsts]).astype("<u2")
    same_band = np.zeros((n, minhash.BANDS), "<u4")  # all meet in the first band
    links = minhash.joining_links(0, np.arange(n), same_band, registers, sets, np.ones(n, bool))
    want = _classes_by_all_pairs([set(x.tolist()) for x in sets])
    assert len(links) == n - len(set(want))
    label = np.arange(n)
    for a, b in links:
        label[label == max(label[a], label[b])] = min(label[a], label[b])
    assert label.tolist() == want


def test_blocks_of_two_sides_and_later_bands():
    sets = [minhash.elements(t) for _, t in _look_alikes(40)]
    sets[1::2] = sets[::2]  # copies on the other side
    registers = np.array([minhash.signature(x, np.ones(len(x))) & np.uint64(0xFFFF) for x in sets]).astype("<u2")
    marks = np.arange(40 * minhash.BANDS, dtype="<u4").reshape(40, -1)
    marks[:, 5] = 0  # first met in band 5
    left = np.arange(40) % 2 == 0
    links = minhash.joining_links(5, np.arange(40), marks, registers, sets, left)
    assert all(left[a] and not left[b] for a, b in links) and len(links) >= 20
    assert minhash.joining_links(6, np.arange(40), marks, registers, sets, left) == []
    assert minhash.joining_links(5, np.zeros(40, int), marks, registers, sets, left) == []


def test_repeated_lines_do_not_hide_a_near_copy(spark):
    """Texts count as sets of runs when they are verified, so they are signed as sets."""
    rnd = random.Random(12)
    rows = []
    for g in range(8):
        text = [f"g{g}w{k}" for k in range(104)]
        line = [f"g{g}line{k}" for k in range(20)]
        rows += [(10 * g, " ".join(text)), (10 * g + 1, " ".join(text + line * rnd.randrange(90, 110)))]
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(documents(spark, [(i, t, "s") for i, t in rows])).collect()}
    assert got == {i: i // 10 * 10 for i, _ in rows}
    clear_staged(spark)


def test_mixing_replaces_its_own_columns_and_keeps_others(spark):
    docs = documents(spark, [(k, "text " * k, "ab"[k % 2]) for k in range(20)])
    more = docs.withColumns({c: F.lit("old") for c in (*mixing.ORDER, "__at", "__id", "slot", "place")})
    plain, got = mixing.placed(docs), mixing.placed(more)
    assert got.columns == [c for c in more.columns if c not in mixing.ORDER] + [*mixing.ORDER]
    assert sorted(got.select("doc_id", *mixing.ORDER).collect()) == sorted(plain.select("doc_id", *mixing.ORDER).collect())
    assert {r["__at"] for r in got.collect()} == {"old"}


def test_schedule_follows_the_weights_over_many_periods():
    rnd = random.Random(13)
    for count in (20, 300):
        weights = {f"s{k}": rnd.random() + 0.01 for k in range(count)} | {"big": 0.3 * count / 2, "rare": count / 20000}
        total = sum(weights.values())
        blocks = {s: int(20000 * w / total) + 1 for s, w in weights.items()}
        plan = mixing.phases(blocks, weights)
        end = min(p[-1][2] for p in plan.values() if len(p) > 1)
        assert sum(blocks.values()) == sum(len(p[3]) for parts in plan.values() for p in parts) and end > 4 * 1024
        for s, parts in plan.items():
            at, w = parts[0][3], weights[s] / total
            for i, t in enumerate(at):  # just before and just after block i
                assert -1 < i - t * w < 1 and -1 < i + 1 - (t + 1) * w < 1


def test_mixing_keeps_the_weight_of_each_of_300_sources(spark):
    rows = [(k, "x" * 64, f"s{k % 300:03}") for k in range(3000)] + [(5000 + k, "x" * 64, "tiny") for k in range(5)]
    weights = {f"s{k:03}": 1.0 for k in range(300)} | {"tiny": 50.0}
    got = mixing.schedule(documents(spark, rows), weights, 64).collect()
    assert len(got) == len(rows) and {r["slot"] for r in got} == set(range(len(rows)))
    assert max(r["slot"] for r in got if r["source"] == "tiny") < 36


def test_sequences_follow_the_mixed_order_whatever_the_files(spark, sf_dir, tmp_path):
    import corpus_pipeline

    rnd = random.Random(14)
    rows = [(k, " ".join(f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(20, 2000))), f"s{k % 3}") for k in range(200)]
    mixed = corpus_pipeline.mix_sources(spark, documents(spark, rows), sf_dir)
    for part in (F.col("doc_id") < 150, F.col("doc_id").between(150, 160), F.col("doc_id") > 160):
        mixed.filter(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/mixed")
    got = corpus_pipeline.pack_sequences(spark, spark.read.parquet(f"{tmp_path}/mixed"), sf_dir).collect()
    at = {r["doc_id"]: (r["slot"], r["place"], r["doc_id"]) for r in mixing.schedule(documents(spark, rows)).collect()}
    order = list(dict.fromkeys(r["doc_id"] for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"]))))
    assert order == sorted(at, key=at.get)


def test_the_plan_of_a_mixed_order_needs_no_python_workers(spark):
    docs = spark.range(50).selectExpr("id doc_id", "repeat('x', 9) text", "concat('s', id % 3) source")
    plan = mixing.placed(docs, block_chars=16)._jdf.queryExecution().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan


def test_evidence_is_given_out_in_slices():
    rnd = random.Random(15)
    vocabulary = [f"{rnd.randrange(10**8):08}x" for _ in range(6000)]
    texts = [" ".join(rnd.sample(vocabulary, 3000)) for _ in range(4)] + [None, ""]
    frame = pd.DataFrame({"text": texts, "label": [1, 0, 1, 0, 1, 0]})
    found = list(toxicity._evidence(iter([frame, frame])))
    assert 4 < len(found) and max(map(len, found)) <= 1 << 14
    rows = pd.concat(found)
    sums = rows.groupby("feature")[["toxic", "clean"]].sum()
    contexts = rows.dropna().groupby("feature")["context"].nunique().to_dict()
    around, expected = defaultdict(set), {0: Counter(), 1: Counter()}
    for text, label in zip(texts[:4], frame["label"]):
        features = list(toxicity._features(text))
        expected[label].update({f for f, _ in features})
        if label:
            for f, c in features:
                around[f].add(c)
    assert contexts == {f: len(c) for f, c in around.items()}
    assert sums["toxic"].to_dict() == {f: 2 * expected[1][f] for f in sums.index}
    assert sums["clean"].to_dict() == {f: 2 * expected[0][f] for f in sums.index}
    assert set(sums.index) == {*expected[0], *expected[1]}


def test_clean_rows_are_given_out_a_few_at_a_time():
    scorer = toxicity.Scorer({"dreck*": 9.0}, -2.0)
    texts = [None if k % 7 == 0 else "you are dreckig" if k % 3 == 0 else f"w{k}" for k in range(2000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": texts})
    found = list(toxicity._clean(iter([batch, batch.slice(0, 0)]), scorer))
    assert max(b.num_rows for b in found) <= 512
    kept = [k for b in found for k in b.column(0).to_pylist()]
    assert kept == [k for k in range(2000) if k % 3 or k % 7 == 0]


@pytest.mark.parametrize("step", ["_sign", "_sets"])
def test_words_of_a_few_texts_are_held_at_once(monkeypatch, step):
    held = []

    def elements(texts):
        held.append(sum(len(t or "") for t in texts))
        return iter([np.zeros(0, np.uint64)] * len(texts))

    monkeypatch.setattr(minhash, "all_elements", elements)
    frame = pd.DataFrame({"key": range(4001), "text": ["x" * 1000] * 4000 + [None], "low": 0, "high": 0})
    rows = pd.concat(getattr(minhash, step)(iter([frame])))
    assert sum(held) == 4_000_000 and max(held) < 1_100_000
    assert len(rows) == (4001 if step == "_sign" else 0)


def test_a_full_encoder_keeps_the_words_learnt_first(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 120)
    monkeypatch.setattr(packing, "KEPT_WORDS", 40, raising=False)
    path = public_tokenizers.path(packing.TOKENIZER)
    coder, plain, rnd = packing.Encoder(path), Tokenizer.from_file(path), random.Random(16)
    common = ["the", "été,", "don't", "3.14", "Straße!"]
    sizes = []
    for k in range(12):
        texts = [" ".join(common + [f"n{rnd.randrange(10**6)}{c}" for c in ".,x!"]) for _ in range(20)] + [None, ""]
        got = coder.encode(texts)
        assert [x.tolist() for x in got] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
        sizes.append(len(coder.codes))
        coder.forget()
        assert len(coder.codes) == 40 and b"the" in coder.codes and len(coder.starts) == 41
        assert len(coder.flat) == coder.starts[-1]
    assert min(sizes) > 40
