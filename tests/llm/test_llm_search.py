"""Fingerprints, hard negatives and lexical search against plain versions."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from biasfit.llm import fingerprints, hard_negatives, lexical, queries

DOCS = "doc_id long, text string, lang string, source string, bucket int, times long, score double, n long, item int, class long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abdeiklnorstÜ漢") for _ in range(rng.randint(1, 5))) for _ in range(120)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))                       # noqa: E731
    out = [(i, say(rng.randint(1, 120)) + rng.choice(["", ". Ünï-10,5 A_b", "\n\t", "\U0001F600"])) for i in range(0, 160, 2)]
    out += [(201, None), (202, ""), (203, " \n"), (204, out[3][1]), (205, out[3][1]), (206, "w " * 30000 + out[5][1]),
            (207, "x"), (208, out[7][1].upper()), (None, "no id " + say(30)), (None, say(40)), (9, "same id, one text"),
            (9, "same id, another text"), (300, out[3][1]), (300, out[3][1]), (300, out[3][1]), (-5, "-_-")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, 0.5, 3, 4, 5) for i, t in rows], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------- fingerprints

def weights(t):
    return collections.Counter((t or "").encode().lower().split())


def generalised_jaccard(a, b):
    same = sum((a & b).values())
    return same / ((sum(a.values()) + sum(b.values()) - same) or 1)


def test_sampling_estimates_generalised_jaccard():
    rng = random.Random(5)
    sample = fingerprints.Sampler(2048)
    for share in (0.1, 0.4, 0.9):
        a = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
        b = [w if rng.random() < share else f"v{int(rng.paretovariate(0.7))}" for w in a]
        a, b = " ".join(a), " ".join(b)
        want = generalised_jaccard(weights(a), weights(b))
        assert fingerprints.likeness(sample(a), sample(b)) == pytest.approx(want, abs=5 * math.sqrt(want * (1 - want) / 2048) + 0.005)


def test_sampling_follows_the_definition(monkeypatch):
    """The least over all terms, one by one; with a full store and small blocks too."""
    text = "a b b c c c d " * 3 + " ".join(f"t{i}" for i in range(300))
    each = np.concatenate([fingerprints.draws(fingerprints.term_hashes([t]), np.array([w]), 32) for t, w in weights(text).items()])
    want = each.min(axis=0).view(np.uint64) & np.uint64(0xFFFF)
    assert (fingerprints.Sampler(32)(text) == want).all()
    monkeypatch.setattr(fingerprints, "KEPT", 100)
    monkeypatch.setattr(fingerprints, "BLOCK", 16)
    small = fingerprints.Sampler(32)
    for t in ("x y z", text, "q " * 70, text):
        got = small(t)
    assert (got == want).all() and len(small.rows) <= 100


def brute_force(text, samples):
    pairs = weights(text)
    if not pairs:
        return np.zeros(samples, dtype="<u2")
    each = fingerprints.draws(fingerprints.term_hashes(list(pairs)), np.array(list(pairs.values())), samples)
    return each.min(axis=0).view(np.uint64) & np.uint64(0xFFFF)


@pytest.mark.parametrize("settings", [{}, {"REACH": 0.2}, {"OFTEN": 1, "KEPT": 60, "BLOCK": 4}, {"OFTEN": 0}, {"BLOCK": 1}])
def test_texts_sampled_together_equal_brute_force(monkeypatch, settings):
    """Also where limits are missed, draws are kept at once or given up, and pairs come in many blocks."""
    for name, x in settings.items():
        monkeypatch.setattr(fingerprints, name, x)
    rng = random.Random(8)
    say = lambda n: " ".join(f"w{int(rng.paretovariate(0.6)) % 10 ** 6}" for _ in range(n))      # noqa: E731
    sample = fingerprints.Sampler(48)
    for _ in range(12):
        texts = [say(rng.choice([1, 2, 5, 60, 300])) for _ in range(rng.randint(1, 9))]
        texts += [None, "", " \n", texts[0], texts[0].upper(), "often " * 40000 + texts[0], "lone " * 70000]
        rng.shuffle(texts)
        for text, got in zip(texts, sample.many(texts), strict=True):
            assert (got == brute_force(text, 48)).all()


def test_a_floor_is_under_every_draw():
    rng = np.random.default_rng(4)
    h, w = rng.integers(0, 1 << 63, 20000).astype(np.uint64) * np.uint64(2), rng.integers(1, 9, 20000) ** rng.integers(0, 6, 20000)
    least, drawn = fingerprints.floors(h, 16) / 2 ** 32 / w[:, None], np.exp(fingerprints.draws(h, w, 16))
    assert (least <= 1.01 * drawn).all() and np.median(least / drawn) > 0.1


def test_few_draws_of_words_met_once_are_made(monkeypatch):
    """Of new words, only draws that may win: a text and its edited text used to need all of both."""
    made, gamma = [], fingerprints._gamma
    monkeypatch.setattr(fingerprints, "_gamma", lambda x: (made.append(x.size), gamma(x))[1])
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(20)]
    texts += [fingerprints.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1])]
    sample = fingerprints.Sampler()
    got = sample.many(texts) if hasattr(sample, "many") else [sample(t) for t in texts]
    # two gamma variables a draw
    assert sum(made) < 0.2 * 2 * fingerprints.SAMPLES * sum(len(weights(t)) for t in texts)
    assert all((g == brute_force(t, fingerprints.SAMPLES)).all() for g, t in zip(got, texts, strict=True))



@pytest.mark.parametrize("parts", [1, 7])
def test_edited_documents(spark, docs, rows, parts):
    got = fingerprints.edited_documents(docs, parts=parts).collect()
    assert len(got) == len(rows)
    sample = fingerprints.Sampler()
    hashes = {r.text: r.th for r in docs.select("text", F.xxhash64("text").alias("th")).distinct().collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]]))
    want = []
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        e = t[:len(t) - len(t) // 2] + u[:len(t) // 2]
        a, b, c = sample(t), sample(e), sample(u)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprints._string(a), fingerprints._string(b),
                     float(np.mean(a == b)), float(np.mean(a == c))))
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert {r.fingerprint for r in got if r.doc_id in (201, 202, 203)} == {"0" * 256}
    plain = {(r.doc_id, r.fingerprint) for r in fingerprints.fingerprints(docs).collect()}
    assert plain == {(r.doc_id, r.fingerprint) for r in got}


def test_edited_documents_of_one_and_no_rows(spark, none):
    assert fingerprints.edited_documents(none).count() == 0
    one = fingerprints.edited_documents(spark.createDataFrame([(3, "abcde")], "doc_id int, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcab").hexdigest() and one.near_next == 1.0
    many = spark.createDataFrame([(1, "same text here")] * 500 + [(2, "other")], "doc_id int, text string").repartition(5)
    got = fingerprints.edited_documents(many).collect()
    assert len(got) == 501 and sum(r.near_next == 1.0 for r in got) == 499


def test_op11_tells_the_edited_text_from_the_next(spark):
    got = queries.op11_fingerprints(spark, "/root/testdata/sf0.01").toPandas()
    assert len(got) == 1000 and got.doc_id.is_unique
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    ids = sorted(texts)
    exact = {i: generalised_jaccard(weights(texts[i]), weights(texts[j])) for i, j in zip(ids, ids[1:] + ids[:1])}
    error = np.abs(got.near_next - got.doc_id.map(exact))
    assert error.mean() < 0.03 and error.max() < 0.25
    assert (got.near_edited > got.near_next).mean() > 0.97


# ----------------------------------------------------------- hard negatives

def test_hilbert_places_are_a_walk_between_neighbours():
    """All cells once, and each step of the curve changes one dimension by one."""
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack([g.ravel() for g in np.meshgrid(*[np.arange(1 << bits)] * dims)], axis=1)
        place = hard_negatives.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_are_met():
    rng = np.random.default_rng(2)
    m = rng.integers(-200, 200, (40, 6))
    q = rng.integers(-200, 200, (300, 6))
    lo, hi = m.min(axis=0)[None], m.max(axis=0)[None]
    radius = np.array([np.sqrt(((m - (lo + hi) / 2) ** 2).sum(axis=1)).max()])
    least, most, _ = hard_negatives.bounds(q, lo, hi, radius)
    s = q @ m.T
    assert (least[:, 0] <= s.min(axis=1)).all() and (s.max(axis=1) <= most[:, 0]).all()
    one = hard_negatives.bounds(q, m[:1], m[:1], np.zeros(1))
    assert np.allclose(one[0], s[:, :1], atol=1) and np.allclose(one[1], s[:, :1], atol=1)


def mined(rows, low=50, high=95, positives=5, negatives=3):
    """rows: id -> (label, integers); the plain version."""
    out = []
    for a, (label, q) in rows.items():
        if a % 5:
            continue
        s = sorted(((-int(np.dot(q, v)), i, l == label) for i, (l, v) in rows.items() if i != a))
        for p, pid, same in [x for x in s if x[2]][:positives]:
            fit = [(-n, i) for n, i, other in s if not other and -low * p <= -100 * n <= -high * p][:negatives]
            out += [(a, pid, k + 1, i, -p, n) for k, (n, i) in enumerate(fit)]
    return out


VECTORS = "vec_id long, embedding array<float>, label int, id long, kind int, block long, x string"


def check(spark, data, block_rows, **kw):
    df = spark.createDataFrame([(i, v, l, 1, 2, 3, "c") for i, v, l in data], VECTORS).repartition(3)
    got = hard_negatives.mine(df, F.col("id") % 5 == 0, block_rows=block_rows, **kw).collect()
    rows = {}
    for i, v, l in data:
        if v and l is not None and i is not None and all(x is not None and math.isfinite(x) and abs(x) < 2 ** 18 for x in v) and len(v) == 4:
            new = (str(l), [math.floor(256 * float(np.float32(x))) for x in v])
            rows[i] = min(rows.get(i, new), new)
    want = mined({i: (l, np.array(v)) for i, (l, v) in rows.items()})
    assert sorted(tuple(r) for r in got) == sorted(want)
    return want


def test_hard_negatives_with_gaps_ties_and_repeats(spark, monkeypatch):
    rng = np.random.default_rng(7)
    data = [(i, [float(x) for x in rng.normal(size=4)], int(rng.integers(0, 3))) for i in range(150)]
    data += [(200 + i, data[0][1], i % 2) for i in range(20)]                       # ties
    data += [(300, None, 1), (301, [1.0, None, 0.0, 0.0], 1), (302, [float("nan")] * 4, 1), (303, [float("inf")] * 4, 0),
             (304, [1.0] * 4, None), (305, [0.0] * 4, 1), (306, [1.0] * 3, 1), (307, [], 0), (308, [3e5] * 4, 0), (None, [1.0] * 4, 1),
             (5, [0.5] * 4, 0), (310, [1.0] * 4, 9), (315, [-1.0] * 4, 9)]
    assert check(spark, data, 8, parts=3)
    monkeypatch.setattr(hard_negatives, "ZONES", 5)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
    assert check(spark, data, 16, parts=4)
    check(spark, data, 10_000, parts=1)


def test_hard_negatives_of_few_rows(spark):
    assert check(spark, [], 8) == []
    assert check(spark, [(5, [1.0] * 4, 0)], 8) == []
    check(spark, [(5, [1.0] * 4, 0), (6, [1.0] * 4, 0), (7, [0.75] * 4, 1), (8, [0.5] * 4, None)], 8)


def test_large_components_are_exact(spark):
    data = [(i, [200000.0 - i, 150000.0 + 3 * i, float(i), -1.0], i % 2) for i in range(30)]
    data += [(100 + i, [150000.0 - i, 90000.0, float(i), 1.0], 2) for i in range(10)]
    assert check(spark, data, 8)


def test_clustered_vectors_leave_blocks_unread(spark, monkeypatch):
    """Zone maps spare most of the blocks when rows lie in clusters."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 4)) * 8
    data = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=4) * 0.05], (i % 40) % 4) for i in range(1200)]
    pairs = []
    read = hard_negatives._read

    def counted(blocks, chosen, *rest):
        pairs.append((chosen.count(), blocks.count()))
        return read(blocks, chosen, *rest)

    monkeypatch.setattr(hard_negatives, "_read", counted)
    check(spark, data, 32, parts=2)
    anchors = sum(i % 5 == 0 for i, *_ in data)
    assert sum(n for n, _ in pairs) < 0.5 * anchors * pairs[0][1]


# ----------------------------------------------------------- lexical search

def terms_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x.group().lower(), t or ""))


def searched(rows, items, k=10):
    docs = [(i, collections.Counter(terms_of(t))) for i, t in rows]
    docs = [d for d in docs if d[1]]
    n_docs, length = len(docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for item, ts in {(i, tuple(sorted(set(terms_of(t))))) for i, t in items}:
        found = []
        for i, c in docs:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in ts if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return out


ITEMS = "item_id long, text string, doc_id long, score long"


@pytest.mark.parametrize("pairs", [1 << 20, 12])
def test_lexical_search(spark, docs, rows, pairs):
    items = [(1, rows[0][1], 1, 1), (2, "same ID, 10 x", 1, 1), (3, None, 1, 1), (4, "", 1, 1), (5, "zzzzzz", 1, 1), (6, rows[3][1], 1, 1),
             (6, rows[3][1], 2, 2), (7, "Ünï w w", 1, 1), (7, "no id", 1, 1), (None, "漢 w", 1, 1), (8, "ünï", 1, 1)]
    got = lexical.search(docs, spark.createDataFrame(items, ITEMS), pairs=pairs)
    want = searched(rows, [(i, t) for i, t, _, _ in items])
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)


def test_lexical_search_expands_classes_in_order(spark):
    """Copies, and other texts with the same bag, interleave by id."""
    rng = random.Random(1)
    texts = ["a b c", "c a b", "a a b c", "b", "a b c zz"]
    rows = [(i, texts[rng.randrange(5)]) for i in rng.sample(range(1000), 300)]
    items = [(1, "a b"), (2, "c"), (3, "b zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = lexical.search(df, spark.createDataFrame(items, "item_id long, text string"), k=25)
    assert sorted(map(tuple, got.collect())) == sorted(searched(rows, items, 25))


def test_lexical_search_of_empty_tables(spark, docs, none):
    items = spark.createDataFrame([(1, "a b", 1, 1)], ITEMS)
    assert lexical.search(none, items).count() == 0
    assert lexical.search(docs, items.filter("item_id < 0")).count() == 0
    blank = spark.createDataFrame([(1, "--"), (2, None)], "doc_id long, text string")
    assert lexical.search(blank, items).count() == 0
