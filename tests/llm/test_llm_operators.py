"""Each operator against a plain version, on a fixture with nulls, empty and
long texts, repeated rows, a null source and clashing column names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from biasfit.llm import (bpe, components, licenses, lines, mixing, neighbours, packing, pii, rules, simhash, tokens,
                         toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, score double, fp string, rank int"


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))                      # noqa: E731
    shared = [say(40), say(30), say(12), say(9), say(10)]
    out = []
    for i in range(60):
        t = "\n".join(say(rng.randint(3, 30)) for _ in range(rng.randint(1, 8)))
        if i % 7 == 0:
            t += "\n" + shared[0]
        if i % 9 == 0:
            t += "\n" + "\n".join(shared[2:]) + "\n" + say(5)
        if i % 11 == 0:
            t += f" mail a.b+{i}@x-y.example.com, 10.0.{i}.255 or 300.1.1.1, 4111 1111 1111 1111 and 4111111111111112, +1 (017) 555-77{i:02d}."
        if i % 13 == 0:
            t += " Released under the MIT License. Licensed under CC BY-NC 4.0"
        if i % 6 == 0:
            t += " you are a horrid grobnik fool"
        out.append((i, t, f"s{i % 4}" if i % 10 else None))
    out += [(100, None, "s1"), (101, "", "s1"), (102, " \n\t ", None), (103, out[0][1], "s0"), (104, out[0][1], "s0"),
            (105, "w " * 30000, "s2"), (106, out[3][1].replace(" ", "  "), "s3"), (107, "1 " * 6000 + "9" * 9000, "s3"),
            (108, "ünï <|endoftext|> 漢字 \U0001F600 a@b.co" + " x" * 20, "s9"), (None, "no id here " * 9, "s0"),
            (5, out[5][1], out[5][2]), (109, "\n".join([shared[1]] * 4), "s1")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, len(t or ""), 1, 0.5, "x", 2) for i, t, s in rows], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_token_ids_equal_the_library():
    from tokenizers import Tokenizer
    path = bpe.default_path()
    enc, lib = bpe.encoder(path), Tokenizer.from_file(path)
    texts = ["", "a<|endoftext|>b", " " * 5000, "it's  1234 ünï\n\n漢字 \U0001F600", "x" * 20000, "\t\r\n \x0b"]
    assert enc.ids(texts) == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert enc.fast is not None


def test_token_counts(spark, docs, rows, none):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(bpe.default_path())
    want = sorted(((i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 512)
                   for i, t, _ in rows), key=str)
    got = tokens.token_counts(docs, table_size=50)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert tokens.token_counts(none).count() == 0


def test_very_long_white_space_runs(spark):
    from tokenizers import Tokenizer
    path = bpe.default_path()
    enc, lib = bpe.encoder(path), Tokenizer.from_file(path)
    n = bpe.LONG_RUN
    texts = ["a" + " " * 1_200_000 + "b", "a" + "\n" * 1_200_000, "\u3000" * 1_200_000 + "<|endoftext|> c" + " " * n + "it's",
             "a" + " \n" * 600_000 + "<|endoftext|>", " " * (n - 1) + "x", "x" + "\t" * n + "1"]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert enc.ids(texts) == want and enc.fast is not None
    assert [bpe.has_long_run(t) for t in texts] == [True, True, True, True, False, True]
    counting = tokens.Counting(path, {})
    assert [counting.count(t) for t in texts] == [len(w) for w in want]
    docs = spark.createDataFrame([(0, texts[0]), (1, "plain")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in tokens.token_counts(docs).collect()}[0] == len(want[0])
    assert sum(r.length for r in packing.pack(docs).filter("doc_id = 0").collect()) == len(want[0]) + 1


def test_packing(docs, rows, none):
    enc = bpe.encoder(bpe.default_path())
    ids = collections.defaultdict(list)
    for i, t, _ in rows:
        ids[i].append(np.array(enc.ids([t or ""])[0] + [1], dtype="<u4"))
    got = packing.pack(docs, open_windows=3).collect()
    per_doc, per_seq = collections.Counter(), collections.defaultdict(list)
    for r in got:
        assert any(zlib.crc32(a[r.start:r.start + r.length].tobytes()) == r.ids_crc32 and len(a) == r.doc_tokens
                   for a in ids[r.doc_id])
        per_doc[r.doc_id] += r.length
        per_seq[r.sequence_id].append((r.offset, r.length))
    assert per_doc == {i: sum(map(len, a)) for i, a in ids.items()}
    for pieces in per_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    total = sum(per_doc.values())
    assert len(per_seq) <= math.ceil(total / 2048) * 1.2 + 3
    assert packing.pack(none).count() == 0


def test_packer_keeps_its_bound():
    rng = np.random.default_rng(1)
    p = packing.Packer(64, 4, 8, 0)
    for k in range(400):
        p.add(k, np.arange(rng.integers(1, 150), dtype="<u4"))
        assert len(p.held) <= 4 and all(r > 0 for r, _ in p.free)
    p.close()
    by = collections.Counter()
    for doc, start, n, _, total, seq, off, used, still in p.out:
        by[seq] += n
        assert used <= 64
    assert all(v <= 64 for v in by.values()) and 1 - sum(by.values()) / 64 / len(by) < 0.1


def base_spans(t):
    out = []
    luhn = lambda d: sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0
    for n, (kind, p) in enumerate((
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x[-9:]) <= 255 and len(x.lstrip("0")) < 4 for x in m[0].split(".")) if kind == "ip" else 0,
                    "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def test_pii_base_and_added(spark, docs, rows, none):
    hard = ["a@b.co_x@y.com c@d.e", "1.2.3.4.5.6.7.8", "+1 555 555 5555+2 (333) 444-5555", "000010.1.1.1 256.1.1.1",
            "x" * 30000, "a@b.co 10.0.0.1 5.5 " * 700, "é" * 9 + "+12345678901 a@b@c.de", "4111-1111-1111-1111 1", "a." * 4000 + "@b", "\U0001F600 a@b.co"]
    extra = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(hard)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    texts = collections.defaultdict(list)
    for i, t in [(i, t) for i, t, _ in rows] + [(1000 + k, t) for k, t in enumerate(hard)]:
        texts[i].append(t)
    for r in pii.find_pii(both, weight=1, precision=0.0, rounds=2).collect():
        spans = base_spans(texts[r.doc_id][0])
        text = ",".join(s for _, _, s in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), r
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(n == k for _, n, _ in spans) for k in range(4)]
        assert {s for _, _, s in spans} <= set(r.spans.split(",")) | {""}
        assert len([x for x in r.spans.split(",") if x]) == len(spans) + r.n_added
    assert pii.find_pii(none).count() == 0


def luhn_number(rng):
    d = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(d + c for c in "0123456789" if ("card", d + c) in {(s[2].split(":")[0], d + c) for s in base_spans(d + c)})


def planted_rows(rng, n):
    """(text, spans of other than base form) in prose; numbers that fail their check in logs."""
    words = ["river", "stone", "cloud", "winter", "garden", "letter"]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))                      # noqa: E731
    num = lambda k: "".join(rng.choice("123456789") for _ in range(k))                 # noqa: E731
    host = lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4))                # noqa: E731
    out = []
    for k in range(n):
        t, spans = "", []
        card, loose = luhn_number(rng), luhn_number(rng)
        for kind, cue, base, other in (
                ("email", "mail", f"{rng.choice(words)}{k}@{rng.choice(words)}.org", f"{rng.choice(words)} [at] {rng.choice(words)} [dot] com"),
                ("ip", "server", host(), host().replace(".", " . ")),
                ("card", "card", " ".join(card[j:j + 4] for j in (0, 4, 8, 12)), "/".join(loose[j:j + 4] for j in (0, 4, 8, 12))),
                ("phone", "phone", f"+1 ({num(3)}) {num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}")):
            t += f"{say(6)} {cue} {base}, {say(6)} {cue} "
            spans.append(f"{kind}:{len(t)}:{len(t) + len(other)}")
            t += f"{other}, {say(6)}\n"
        out.append((t, spans))
    for k in range(n):
        out.append(("\n".join(f"{num(5)} {num(2)}; {num(3)} | {rng.randint(256, 999)}.{num(3)}.{num(3)}.{num(3)} | {num(22)} | {num(2)}-{num(2)}-{num(3)} | "
                              f"{num(3)}@{num(2)} .{num(2)} | {num(2)}" for _ in range(6)), []))
    return out


def test_pii_adds_other_forms_with_production_parameters(spark):
    rows = planted_rows(random.Random(11), 200)
    got = pii.find_pii(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")).collect()
    for r in got:
        text, planted = rows[r.doc_id]
        found = set(r.spans.split(",")) - {""}
        assert set(planted) <= found, (text, planted, r.spans)
        assert r.n_added == len(planted)


def test_pii_thresholds_of_rare_kinds_beside_many_spans_of_others(spark):
    rng = random.Random(12)
    rows = planted_rows(rng, 150)
    d = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    num = F.expr("array_join(transform(sequence(1, 60), k -> substr(conv(substr(sha2(concat(id, '-', k), 256), 1, 15), 16, 10), 1, 11)), ' ; ')")
    logs = spark.range(1500).select((F.col("id") + 10_000).alias("doc_id"), num.alias("text"))    # 90,000 failing card spans
    got = {r.doc_id: r for r in pii.find_pii(d.unionByName(logs)).filter("doc_id < 10000").collect()}
    for k, (text, planted) in enumerate(rows):
        assert set(planted) <= set(got[k].spans.split(",")), (text, planted, got[k].spans)
    spans = pii.labelled(d.unionByName(logs).withColumn("h", F.xxhash64("text")))
    counts = {(r.kind, r.y): r["count"] for r in pii.sample(spans, 800).groupBy("kind", "y").count().collect()}
    assert len(counts) == 8 and max(counts.values()) <= 100 and min(counts.values()) >= 30


def plain_rejected(rows, max_rate=0.5):
    """Hosts with a shrunk rate of any rule above max_rate: (host, failures by rule) rows."""
    by_host = collections.defaultdict(list)
    for host, fails in rows:
        by_host[host].append(fails)
    out = set()
    for r in range(len(rows[0][1])):
        f = {h: sum(x[r] for x in v) for h, v in by_host.items()}
        n = {h: len(v) for h, v in by_host.items()}
        docs, hosts = len(rows), len(n)
        m = sum(f.values()) / docs
        beyond = docs - sum(k * k for k in n.values()) / docs - (hosts - 1)
        rho = 0.0
        if 0 < m < 1 and beyond > 1e-9 * docs:
            rho = (sum(n[h] * (f[h] / n[h] - m) ** 2 for h in n) / (m * (1 - m)) - (hosts - 1)) / beyond
        k = 1 / min(1 / 11, max(1 / 1001, rho)) - 1
        out |= {h for h in n if (f[h] + m * k) / (n[h] + k) > max_rate}
    return out


def test_quality_rules(docs, rows, none):
    def plain(t):
        w, t = words_of(t), t or ""
        at = collections.defaultdict(list)
        for k in range(len(w) - 7):
            at[tuple(w[k:k + 8])].append(k)
        covered = {p + d for v in at.values() if len(v) > 1 for p in v for d in range(8)}
        ls = [x for x in t.split("\n") if words_of(x)]
        return (len(w), sum(map(len, w)), sum(c in rules.SYMBOLS for c in t), len(ls) - len(set(ls)), len(covered)), len(ls)
    want = []
    for i, t, s in rows:
        m, n_lines = plain(t)
        short, repeats = m[0] < 20, 100 * m[4] > 30 * m[0]
        fails = (short, repeats, 10 * m[2] > m[0], 100 * m[3] > 30 * n_lines, short or repeats)
        want.append((i, s, *m, fails[-1], n_lines, fails))
    bad = plain_rejected([(w[1], w[-1]) for w in want])
    want = [(w[0], *w[2:8], not w[7] and w[1] not in bad, w[8]) for w in want]
    got = [tuple(r) for r in rules.quality(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = rules.keep_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(w[-2] for w in want)
    assert rules.quality(none).count() == 0 and rules.keep_documents(none).count() == 0


def test_host_verdicts_reject_a_bad_host(spark):
    """Each rule rejects the host where most documents fail it, with the
    documents there that pass; a host with few documents stands."""
    good = " ".join(f"w{k}" for k in range(30))
    lines = "\n".join(f"w{k} x y" for k in range(20))
    bad = {"short": "short", "repeats": "a b c d e f g h " * 9, "symbols": good + " ####", "dup_lines": lines + "\n" + "\n".join(
        f"w{k} x y" for k in range(0, 20, 2))}
    data = [(bad[r] if k < 30 else good, r) for r in bad for k in range(33)]
    data += [(bad["symbols"], f"one{k}") for k in range(4)]
    data += [(good, f"g{k % 40}") for k in range(2000)]
    df = spark.createDataFrame([(k, t, h) for k, (t, h) in enumerate(data)], "doc_id long, text string, source string")
    verdicts = {r.host: r for r in rules.host_verdicts(rules.measure(df)).collect()}
    assert {h: r.rejected_by for h, r in verdicts.items() if r.rejected} == {
        "short": "short,base", "repeats": "repeats,base", "symbols": "symbols", "dup_lines": "dup_lines"}
    assert verdicts["symbols"].failed_symbols == 30 and verdicts["symbols"].failed_base == 0
    got = {r.doc_id: r for r in rules.quality(df).collect()}
    assert all(not got[k].kept for k, (_, h) in enumerate(data) if h in bad)
    assert all(got[k].kept for k, (_, h) in enumerate(data) if h not in bad)
    assert {r.doc_id for r in rules.keep_documents(df).collect()} == {k for k in got if got[k].kept}


def test_hosts_of_one_document_each_prove_nothing(spark):
    """Rates of 0 and 1 are then chance: documents stand on their own."""
    good = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(k, good + (" ####" if k % 3 == 0 else ""), f"h{k}") for k in range(300)],
                               "doc_id long, text string, source string")
    assert rules.quality(df).filter("kept").count() == 300


def test_toxicity_learns_and_is_blind_to_labels(spark, docs, rows, none):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(["sun", "moon", "river", "stone", "wind", "tree", "cloud"]) for _ in range(n))
    data = [(k, say(30) + (" grobnik " if k % 4 == 0 else " ") + say(30), int(k % 4 == 0)) for k in range(900)]
    d = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    l = spark.createDataFrame([(i, y) for i, _, y in data] + [(0, 1), (5, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(d, l).collect()}
    for i, _, y in data:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i].predicted == int(got[i].score >= 0.7)
    held = [(got[i].predicted, y) for i, _, y in data if got[i].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.98
    assert toxicity.toxicity(docs, l.limit(0)).filter("score <> 0.5").count() == 0
    assert toxicity.toxicity(docs, l).count() == len(rows)
    assert toxicity.toxicity(none, l).count() == 0


def test_toxicity_replaces_labels_without_a_text(spark):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choice(["sun", "moon", "river", "stone", "wind"]) for _ in range(n))
    data = [(k, say(20) + (" grobnik " if k % 2 else " ") + say(20), k % 2) for k in range(200)]
    # far more labels of missing and null texts, in both classes
    odd = [(10_000 + k, None, k // 2 % 2) for k in range(1000)]
    d = spark.createDataFrame([(i, t) for i, t, _ in data + odd], "doc_id long, text string")
    l = spark.createDataFrame([(i, y) for i, _, y in data + odd] + [(50_000 + k, k % 2) for k in range(3000)], "doc_id long, toxic int")
    s = toxicity._sample(d, l.withColumnRenamed("toxic", "y"), 40)
    assert (s.y == 0).sum() == (s.y == 1).sum() == len(s.x) / 2 == 40 and s.share == pytest.approx(0.5, abs=0.05)
    got = {r.doc_id: r.score for r in toxicity.toxicity(d, l, max_rows=40).collect()}
    assert min(got[i] for i, _, y in data if y) > max(got[i] for i, _, y in data if not y)


def test_toxicity_learns_from_long_texts(spark):
    """The word that tells the classes stands in texts of 40,000 characters only."""
    rng = random.Random(16)
    say = lambda n: " ".join(rng.choice(["sun", "moon", "river", "stone", "wind"]) for _ in range(n))
    data = [(k, say(8000) + (" grobnik " if k % 2 else " "), k % 2) for k in range(60)]
    d = spark.createDataFrame([(i, t) for i, t, _ in data] + [(900, "a grobnik"), (901, "a stone")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.toxicity(d, spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")).collect()}
    assert got[900] > got[901]


def test_toxicity_counts_and_fit_against_a_plain_version(spark):
    rng = random.Random(26)
    words = ["sun", "moon", "river", "stone", "wind", "grobnik", "drat"]
    data = [(k, " ".join(rng.choices(words, weights=[5, 5, 5, 5, 5, 1 + 4 * (k % 3 == 0), 1], k=30)), int(k % 3 == 0)) for k in range(240)]
    d = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string").repartition(4)
    s = toxicity._sample(d, spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, y int"), 1000, min_ratio=0.3, max_features=50)
    rows = sorted((i, y, set(toxicity.features(t).tolist())) for i, t, y in data if zlib.crc32(str(i).encode()) % 3 != 1)
    n = [sum(y == c for _, y, _ in rows) for c in (0, 1)]
    count = collections.Counter((f, y) for _, y, x in rows for f in x)
    ratio = {f: math.log((count[f, 1] + 1) / (n[1] + 2)) - math.log((count[f, 0] + 1) / (n[0] + 2)) for f, _ in count}
    strength = {f: abs(r) * math.sqrt(count[f, 0] + count[f, 1]) for f, r in ratio.items()
                if count[f, 0] + count[f, 1] >= 4 and abs(r) >= 0.3}
    kept = sorted(sorted(strength, key=lambda f: (-round(strength[f], 12), f))[:50])
    assert s.features.tolist() == kept and s.ratio == pytest.approx([ratio[f] for f in kept])
    assert [set(s.features[x].tolist()) for x in s.x] == [x & set(kept) for _, _, x in rows] and s.y.tolist() == [y for _, y, _ in rows]
    # the same fit with a dense matrix
    x = np.array([[float(f in r) for f in kept] for _, _, r in rows]) * s.ratio
    c = np.where(s.y == 1, s.share / n[1], (1 - s.share) / n[0])
    w, b, m, v = np.zeros(50), math.log((s.share + 1e-6) / (1 - s.share + 1e-6)), np.zeros(51), np.zeros(51)
    for t in range(1, 151):
        err = c * (1 / (1 + np.exp(-(x @ w + b))) - s.y)
        g = np.append(x.T @ err + 1e-4 * w, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    got, intercept = toxicity.fit(s, block=7)
    assert got[kept] == pytest.approx(w * s.ratio, rel=1e-4, abs=1e-6) and intercept == pytest.approx(b, rel=1e-6)


def test_pii_trees_equal_the_model(spark):
    """The printed trees as conditions score as the model itself does."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, len(pii.FEATURES))).round(3)
    y = (x[:, 0] * x[:, 2] + x[:, 15] > 0.2).astype(float)
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "f array<double>, y double").select(
        "f", "y", array_to_vector("f").alias("v"))
    model = GBTClassifier(featuresCol="v", labelCol="y", maxIter=6, maxDepth=3, seed=1).fit(df)
    trees = pii.tree_columns(model)
    got = model.transform(df).select(vector_to_array("probability")[1].alias("p"), pii.score(trees, F.col("f")).alias("q")).collect()
    assert [r.q for r in got] == pytest.approx([r.p for r in got], abs=1e-9)


def test_pii_thresholds_are_pooled():
    bins = [(0, 90, 1000, 1000), (0, 50, 1000, 0), (1, 90, 3, 3), (2, 90, 3, 0)]
    got = pii.thresholds(bins, 0.98, 20.0)
    assert got[0] == 0.9 and got[1] == 0.9        # three spans of a kind count with those of all kinds
    assert got[2] == 2.0                          # and so do three that speak against it
    assert got[3] == 0.9                          # a kind without labelled spans goes by the others
    assert pii.thresholds([], 0.98, 20.0) == {k: 2.0 for k in range(4)}
    assert pii.thresholds([(0, 90, 10, 1)], 0.98, 20.0)[3] == 2.0


def test_pii_other_forms_inside_real_documents(spark):
    """Planted spans of other than base form in the given texts: recall, and what else is added."""
    rng = random.Random(21)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    planted = {}
    rows = planted_rows(rng, 150)
    out = []
    for (i, t), (extra, spans) in zip(docs, rows + [(None, None)] * len(docs)):
        if extra and spans:
            t = (t or "") + "\n"
            planted[i] = {":".join([k, str(int(a) + len(t)), str(int(b) + len(t))]) for k, a, b in (x.split(":") for x in spans)}
            t += extra
        elif extra:
            t = (t or "") + "\n" + extra
        out.append((i, t))
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(out, "doc_id long, text string")).collect()}
    hit = sum(len(s & set(got[i].spans.split(","))) for i, s in planted.items())
    total, added = sum(map(len, planted.values())), sum(r.n_added for r in got.values())
    print(f"planted {total}, found {hit}, added {added}")
    assert hit >= 0.95 * total and added <= 1.05 * hit


def test_golay_codewords_share_an_index_within_one_bit():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 1 << 23, 4000)
    u = v ^ (1 << rng.integers(0, 23, 4000))
    first, more = simhash.codeword_indices(v)
    other, _ = simhash.codeword_indices(u)
    assert ((first == other) | (more == other[:, None]).any(axis=1)).all()
    assert (simhash.golay()[2] != 0).sum() == 1771 * 5


def plain_fingerprint(t):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words_of(t)]
    if not w:
        return 0
    g = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    fs = sorted(root)
    for k, a in enumerate(fs):
        for b in fs[:k]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in fs}


def test_simhash(docs, rows, none):
    fps = [(i, plain_fingerprint(t)) for i, t, _ in rows]
    comp = plain_components({f for _, f in fps})
    least = {}
    for i, f in fps:
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    want = sorted(((i, f"{f:016x}", least.get(comp[f])) for i, f in fps), key=str)
    got = simhash.near_duplicates(docs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(got, key=str) == sorted((least.get(c) for c in set(comp.values())), key=str)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_simhash_keeps_one_of_each_group_whatever_the_ids(spark):
    rng = random.Random(21)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(80))
    a, b, c, d = text(), text(), text(), text()
    docs = spark.createDataFrame(
        [(1, a, 1), (1, b, 2), (1, b, 3), (2, b, 4), (None, c, 5), (None, c, 6), (None, d, 7), (9, d, 8), (None, text(), 9),
         (None, None, 10), (3, " ", 11)], "doc_id long, text string, th int")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == 6 and {(1, a), (1, b), (None, c), (9, d), (3, " ")} <= set(kept)


def test_simhash_links_with_crowded_keys(spark):
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 150:       # a crowd, and loners
        f = rng.choice(sorted(fps)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        fps.add(f if len(fps) % 3 else rng.getrandbits(64))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket=4).distinct().collect()
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in got} == want


def sample_of(expression, rng):
    """A text that a rule's expression matches: one choice of each part."""
    def group(e):
        out, i = "", 0
        while i < len(e):
            if e.startswith("(?!", i):
                i = e.index(")", i) + (2 if e[i + 3] == " " and "(?:" in e[i:e.index(")", i)] else 1)
                continue
            if e.startswith("(?:", i):
                depth, j = 1, i + 3
                while depth:
                    depth += {"(": 1, ")": -1}.get(e[j], 0)
                    j += 1
                body, parts, d, last = e[i + 3:j - 1], [], 0, 0
                for x, c in enumerate(body):
                    d += {"(": 1, ")": -1}.get(c, 0)
                    if c == "|" and d == 0:
                        parts.append(body[last:x])
                        last = x + 1
                parts.append(body[last:])
                if (got := re.match(r"\{(\d+),(\d+)\}", e[j:])):
                    out += "".join(group(rng.choice(parts)) for _ in range(rng.randint(*map(int, got.groups()))))
                    j += got.end()
                elif e[j:j + 1] == "?":
                    out += group(rng.choice(parts)) if rng.random() < 0.5 else ""
                    j += 1
                else:
                    out += group(rng.choice(parts))
                i = j
                continue
            if e.startswith("\\d{4}", i):
                out, i = out + "1999", i + 5
            elif e.startswith("\\d", i):
                out, i = out + "4", i + 2
            elif e.startswith("\\w+", i):
                out, i = out + "word", i + 3
            elif e[i] == "[":
                out, i = out + rng.choice(e[i + 1:e.index("]", i)]), e.index("]", i) + 1
            else:
                out, i = out + e[i], i + 1
            if e[i:i + 1] == "?":
                out, i = out[:-1] if rng.random() < 0.5 else out, i + 1
        return out
    return group(expression)


def plain_scan(text):
    """Every match of every rule, compared with every one accepted before."""
    line = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower()))
    accepted = []
    for r in licenses.rules():
        own = []
        for m in re.finditer(rf"(?<!\S)(?:{r.expression.pattern.decode()[4:-6]})(?!\S)", line):
            if not any(a <= m.start() and m.end() <= b for a, b, _ in accepted):
                own.append((m.start(), m.end(), r.label))
        accepted += own
    word = lambda at: line[:at].count(" ")                                             # noqa: E731
    return ",".join(f"{label}:{word(a)}:{word(b) + 1}" for a, b, label in sorted(accepted, key=lambda x: x[:2]))


def test_license_rules_one_by_one():
    """Each rule finds a text made from it, and its keywords are in whatever it matches."""
    rng = random.Random(3)
    for r in licenses.rules():
        expression = r.expression.pattern.decode()[4:-6]
        for _ in range(6):
            text = " ".join(sample_of(expression, rng).split())
            if not r.expression.search(b" " + text.encode() + b" "):
                continue        # an optional part ran into a forbidden one
            got = set(text.encode().split())
            got |= {licenses.SPELLINGS[w] for w in got if w in licenses.SPELLINGS}
            assert r.keywords <= got, (r.label, text)
            assert licenses.scan("so " + text + " then")["spans"], (r.label, text)


def test_license_suppression_against_the_plain_version():
    rng = random.Random(8)
    every = [r.expression.pattern.decode()[4:-6] for r in licenses.rules()]
    found = 0
    for _ in range(150):
        parts = [sample_of(rng.choice(every), rng) for _ in range(rng.randint(1, 9))]
        parts = [p if rng.random() < 0.7 else " ".join(p.split()[rng.randint(0, 2):]) for p in parts]
        text = rng.choice([" ", " and ", ". "]).join(parts)
        assert licenses.scan(text)["spans"] == plain_scan(text), text
        found += licenses.scan(text)["spans"].count(",")
    assert found > 300


def test_license_scan_of_ten_megabytes_is_linear():
    import time
    lines = ["Licensed under the MIT License, version %d.", "released under CC BY-NC 4.0 by someone %d", "see the GNU GPL version 2 or later (%d)",
             "Permission is hereby granted, free of charge, to any person obtaining a copy %d"]
    took = {}
    for size in (1_000_000, 10_000_000):
        text, k = [], 0
        while k < size:
            text.append(lines[len(text) % 4] % len(text))
            k += len(text[-1]) + 1
        t = time.process_time()
        got = licenses.scan("\n".join(text))
        took[size] = time.process_time() - t
        assert got["spans"].count(":") == 2 * len(text) and got["labels"] == "cc-by-nc,gpl-2,mit"
    assert took[10_000_000] < 25 * max(took[1_000_000], 0.2)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 200), (301, 300)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}, 300: 300, 301: 300}


def test_licenses(docs, rows, none):
    def plain(t):
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(k, label) for p, label in licenses.BASE for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        return len(w), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None), \
            ",".join(sorted({x for _, x in places}))
    want = sorted(((i, *plain(t)) for i, t, _ in rows), key=str)
    got = licenses.license_scan(docs).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == want
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert licenses.license_scan(none).count() == 0
    assert len(licenses.rules()) > 200


@pytest.mark.parametrize("text, labels", [
    ("SPDX-License-Identifier: MIT", "mit"), ("Dual licensed under the GNU GPL version 3 or later", "gpl-3"),
    ("Licensed under the Apache License, Version 2.0", "apache-2"), ("der Hund mit dem Ball", ""),
    ("This work is licensed under a CC BY-SA 4.0 license", "cc-by-sa"), ("under the MIT license", "mit"),
    ("released under CC BY-NC-ND", "cc-by-nc,cc-by-nc-nd"), ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit")])
def test_license_labels(text, labels):
    text = text.replace("under a CC", "under CC")
    assert licenses.scan(text)["labels"] == labels


def plain_cut(rows, least):
    docs = sorted({(i, t) for i, t, _ in rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0))
    ls = {d: [(j, x) for j, x in enumerate(d[1].split("\n")) if words_of(x)] for d in docs}
    seen, cut = {}, collections.defaultdict(set)
    for d in docs:        # longest repeated runs by brute force, in corpus order
        n = len(ls[d])
        for s in range(n):
            total = 0
            for e in range(s, n):
                total += len(words_of(ls[d][e][1]))
                if total >= least:
                    run = tuple(x for _, x in ls[d][s:e + 1])
                    if run in seen:
                        cut[d] |= {j for j, _ in ls[d][s:e + 1]}
                    seen.setdefault(run, (d, s))
    return cut


def test_line_dedup(docs, rows, none):
    cut = plain_cut(rows, 25)
    want = sorted(((i, len(t.split("\n")) if t is not None else 0, len(cut[(i, t)]) if t is not None else 0,
                    "\n".join(x for j, x in enumerate(t.split("\n")) if j not in cut[(i, t)]) if t is not None else None)
                   for i, t, _ in rows), key=str)
    assert sum(w[2] for w in want) > 10
    got = lines.line_dedup(docs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    out = lines.dedup_documents(docs)
    assert out.columns == docs.columns
    assert sorted(out.select("text").collect(), key=str) == sorted([(w[3],) for w in want], key=str)
    assert out.filter("text is not null and n_chars <> length(text)").count() == 0
    assert lines.line_dedup(none).count() == 0 and lines.dedup_documents(none).count() == 0


def test_mixing(docs, rows, none):
    got = mixing.mix(docs).collect()
    sizes, names = collections.Counter(), sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    for _, t, s in rows:
        sizes[s] += len(words_of(t))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(3 * sizes[s] for s in full)
        open_ -= full
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    largest = {s: max(len(words_of(t)) for _, t, x in rows if x == s) for s in names}
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in names)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    assert out.agg(F.sum(F.expr("size(array_remove(split(coalesce(text, ''), '[ \\t-\\r]+'), ''))"))).first()[0] == sum(taken.values())
    assert mixing.mix(none).count() == 0 and mixing.mix_documents(none).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    m = np.repeat(centres, 60, axis=0) + 0.3 * rng.normal(size=(720, 16))
    m[100:300] = m[100]                       # copies: ties go to the smaller id
    data = [(int(k), [float(x) for x in v], 0.5, 1) for k, v in enumerate(m)]
    odd = [(900, None, 0.0, 1), (901, [0.0] * 16, 0.0, 1), (902, [float("nan")] + [1.0] * 15, 0.0, 1), (903, [None] * 16, 0.0, 1),
           (904, [1.0, 2.0], 0.0, 1), (950, [float("inf")] * 16, 0.0, 1), (None, [1.0] * 16, 0.0, 1)]
    df = spark.createDataFrame(data + odd + data[:1], "vec_id long, embedding array<double>, score double, rank int")
    got = neighbours.nearest(df, F.col("id") % 50 == 0, list_rows=32, chunk_rows=64).collect()
    unit = m / np.sqrt((m * m).sum(axis=1, keepdims=True))
    hit = total = 0
    by = collections.defaultdict(list)
    for r in got:
        by[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(by) == set(range(0, 720, 50))
    for q, found in by.items():
        s = unit @ unit[q]
        s[q] = -2
        best = np.lexsort((np.arange(720), -np.round(s, 12)))[:5]
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and all(abs(f[2] - s[f[1]]) < 1e-9 for f in found)
        hit, total = hit + len(set(best) & {f[1] for f in found}), total + 5
    assert hit / total >= 0.9
    assert [v for _, v, _ in by[150]] == [100, 101, 102, 103, 104]
    many = df.unionByName(spark.createDataFrame([data[100]] * 40 + [data[101]] * 40, df.schema))
    many = neighbours.nearest(many, F.col("id") == 150, list_rows=32, chunk_rows=64).orderBy("rank").collect()
    assert [r.vec_id for r in many] == [100, 101, 102, 103, 104]
    far = spark.createDataFrame([(k, [s * x for x in v]) for k, (s, v) in enumerate(
        [(2.0 ** 900, [3.0, 4.0]), (2.0 ** -900, [3.0, 4.0]), (1.0, [4.0, 3.0])])], "vec_id long, embedding array<double>")
    far = neighbours.nearest(far, F.col("id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in far] == [(1, 1.0), (2, 0.96)]
    few = neighbours.nearest(df.filter("vec_id < 3"), F.col("id") == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert neighbours.nearest(df.limit(0), F.col("id") == 0).count() == 0


@pytest.mark.parametrize("kind, sample_rows, most", [("clusters", 256, 0.5), ("clusters", 20_000, 0.1), ("none", 256, 1.0), ("none", 20_000, 1.0)])
def test_neighbours_score_fewer_pairs_than_brute_force(spark, kind, sample_rows, most, monkeypatch):
    """Pairs scored and recall; with a small sample most lists are made in tasks."""
    rng = np.random.default_rng(9)
    n, dim = 8000, 24
    if kind == "clusters":
        m = rng.normal(size=(160, dim))[rng.integers(0, 160, n)] + 0.15 * rng.normal(size=(n, dim))
    else:
        m = rng.normal(size=(n, dim))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>").repartition(4)
    scored = spark.sparkContext.accumulator(0)
    lists = spark.sparkContext.accumulator(0)
    among, init = neighbours.Chunk._among, neighbours.Chunk.__init__

    def counted(self, q, qid, rough, at):
        scored.add(len(rough))
        return among(self, q, qid, rough, at)

    def built(self, *args):
        init(self, *args)
        lists.add(1 if self.sub is None else len(self.sub.centroids))

    search = neighbours._visit_task

    def visit(*args):
        run = search(*args)

        def task(batches):
            neighbours.Chunk._among, neighbours.Chunk.__init__ = counted, built
            try:
                yield from run(batches)
            finally:
                neighbours.Chunk._among, neighbours.Chunk.__init__ = among, init
        return task

    monkeypatch.setattr(neighbours, "_visit_task", visit)
    got = neighbours.nearest(df, F.col("id") % 50 == 0, list_rows=32, sample_rows=sample_rows, chunk_rows=1024).collect()
    u = m / np.sqrt((m * m).sum(axis=1, keepdims=True))
    hit = 0
    found = collections.defaultdict(set)
    for r in got:
        found[r.query_id].add(r.vec_id)
    for q in range(0, n, 50):
        s = u @ u[q]
        s[q] = -2
        hit += len(found[q] & set(np.argsort(-s)[:5].tolist()))
    recall, share = hit / (n // 50 * 5), scored.value / (n // 50 * n)
    print(f"{kind}, sample {sample_rows}: recall {recall:.3f}, pairs {share:.3f} of brute force, lists {lists.value}")
    assert recall >= 0.9 and share < most
    assert lists.value > 32


@pytest.mark.parametrize("ranges", [2, 3, 4096])
def test_mixing_cuts_alike_for_any_ranges(spark, docs, monkeypatch, ranges):
    """The cutoff doesn't depend on how the keys are cut before they are sorted."""
    want = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "RANGES", ranges)
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == want
