"""Personal data by candidate gradient boosting.

High-recall generators (a loose expression per kind) propose spans, which may
overlap.  Boosted trees score each from its form and its context; a span is
redacted if its score is above its kind's threshold.  Base matches (strict expression and
checksum) are always redacted and are also what the trees learn from: a
proposed span that meets a base match of its kind is positive.  One that meets
only those of other kinds is redacted already and left out.  Of the rest, one
that fails its kind's range, length or checksum is negative and never added, and
any other is unlabelled: it takes no part in fit or thresholds, and only such
are added.
No feature repeats what decides a label, and a random half of the labelled spans
has its form masked, so that form neither decides nor vanishes; an unlabelled
span takes the better of its scores with and without its form.
Thresholds are calibrated on held-out spans: the least score at which
``precision`` of the labelled spans above it are positive, each kind's share
being drawn towards that of all kinds by ``weight`` spans.

Everything runs in passes over each row's arrays.  A quarter of the texts, by
hash, is held out: all labelled spans there are scored and counted by kind and
score for the thresholds.  The fit takes at most its share of ``max_rows`` spans
of each kind and label from the other texts, least by a hash; the cut comes from
counts by hash level, so nothing is shuffled but that sample.

Defined results: null and empty texts have no spans; repeated rows are each
scanned; without spans of both classes nothing is added to the base; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, pick, table

#: Kinds in order, with expressions equal to the base ones but
#: for possessive repeats and a run's start being looked for only once, which
#: keep very long runs linear.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for an expression to match at all.
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: Generators: loose forms of each kind.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|[\[({]at[\])}])\x20?[A-Za-z0-9-]{1,63}+"
             r"(?:\x20?(?:\.|[\[({]dot[\])}])\x20?[A-Za-z0-9-]{1,24}+){1,6}+",
    "ip": r"(?<![0-9])[0-9]{1,4}+(?:\x20?(?:\.|\[\.\]|\(\.\))\x20?[0-9]{1,4}+){3,7}+",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){8,24}+",
    "phone": r"(?<![0-9])\+?\(?[0-9]{1,5}+\)?(?:[\x20./-]{1,2}+\(?[0-9]{2,5}+\)?){2,5}+",
}
LOOSE_GATES = {"email": r"@|[\[({]at[\])}]", "ip": r"[0-9]\x20?[\[(]?\.", "card": r"[0-9][\x20./-]{0,2}[0-9]",
               "phone": r"[0-9]\)?[\x20./-]"}
#: Words before a span that speak for personal data, by kind.
CUES = {
    "email": r"(?i)(mail|contact|write)", "ip": r"(?i)(host|server|addr|login|ssh|\bip\b)",
    "card": r"(?i)(card|visa|account|pay)", "phone": r"(?i)(phone|tel|call|fax|mobile)",
}
CONTEXT = 32
SPAN = "array<struct<s:int,e:int,m:string,l:string,r:string>>"
#: Spans handled together, so that texts with very many don't take time in the
#: square of their number.
BLOCK = 256


def matches(text: Column, pattern: str, gate: str) -> Column:
    """Leftmost non-overlapping matches as SPAN: start and end in code points,
    the match, and the text around it.  The pieces between the matches give
    the positions."""
    def build(v: Column) -> Column:
        def add(acc: Column, k: Column) -> Column:
            p, m, after = F.get(v["p"], k), F.get(v["m"], k), F.get(v["p"], k + 1)
            s = acc["at"] + F.length(p)
            span = F.struct(s.alias("s"), (s + F.length(m)).alias("e"), m.alias("m"),
                            F.right(p, F.lit(CONTEXT)).alias("l"), F.left(after, F.lit(CONTEXT)).alias("r"))
            return F.struct((s + F.length(m)).alias("at"), F.concat(acc["out"], F.array(span)).cast(SPAN).alias("out"))

        def add_block(acc: Column, k: Column) -> Column:
            zero = F.struct(acc["at"].alias("at"), F.array().cast(SPAN).alias("out"))
            of_block = F.aggregate(F.sequence(k, F.least(k + BLOCK, F.size(v["m"])) - 1), zero, add)
            return let(of_block, lambda x: F.struct(
                x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).cast(f"array<{SPAN}>").alias("out")))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        blocks = F.sequence(F.lit(0), F.size(v["m"]) - 1, F.lit(BLOCK))
        return F.when(F.size(v["m"]) > 0, F.flatten(F.aggregate(blocks, zero, add_block, lambda a: a["out"])))

    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return F.coalesce(F.when(text.rlike(gate), let(both, build)), F.array().cast(SPAN))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    def add(acc: Column, k: Column) -> Column:
        x = F.ascii(F.substr(d, F.length(d) - k, F.lit(1))) - 48
        x = F.when(k % 2 == 1, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)
        return acc + x
    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add) % 10 == 0


def parts_fit(m: Column) -> Column:
    """Every number of an address is at most 255."""
    return F.forall(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)), lambda x: let(
        F.regexp_replace(x, "^0+", ""), lambda y: (F.length(y) <= 3) & (F.coalesce(y.try_cast("int"), F.lit(0)) <= 255)))


def is_card(m: Column) -> Column:
    return let(digits(m), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))


CHECKS = {
    "email": lambda m: F.lit(True), "ip": parts_fit, "card": is_card,
    "phone": lambda m: F.length(digits(m)).between(9, 15),
}


def base_spans(text: Column) -> dict[str, Column]:
    def passing(kind: str) -> Column:
        return F.filter(matches(text, BASE[kind], GATES[kind]), lambda x: CHECKS[kind](x["m"]))
    return {k: passing(k) for k in KINDS}


#: How a loose email is written plainly.
PLAIN = ((r"[\[({]at[\])}]", "@"), (r"[\[({]dot[\])}]", "."), (r"\x20", ""))


def _plain(m: Column) -> Column:
    for pattern, by in PLAIN:
        m = F.regexp_replace(m, pattern, by)
    return m


#: What a proposed span must pass not to be refuted.
FITS = CHECKS | {
    "email": lambda m: let(_plain(m), lambda p: (F.length(p) <= 254) & p.rlike(r"\.[A-Za-z][A-Za-z0-9-]*[A-Za-z0-9]$")),
    "ip": lambda m: (F.regexp_count(m, F.lit("[0-9]+")) == 4) & parts_fit(m),
}

FEATURES = ("kind", "joined_left", "joined_right", "number_left", "number_right", "word_left", "word_right", "own_cue",
            "any_cue", "digits_left", "digits_right", "letters_left", "letters_right",
            # of the form
            "length", "digit_share", "letter_share", "separators", "separator_kinds", "digit_groups", "longest_group", "distinct_digits")
FORM = 8
MASKED = -1.0


def masked(f: Column) -> Column:
    """The features without those of the form."""
    return F.concat(F.slice(f, 1, len(FEATURES) - FORM), F.array_repeat(F.lit(MASKED), FORM))


def form(m: Column) -> list[Column]:
    """Of a match: nothing that a check or a base expression goes by."""
    n = F.greatest(F.length(m), F.lit(1))
    seps = F.regexp_replace(m, r"[A-Za-z0-9\x20]", "")
    groups = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))
    kinds = F.size(F.array_distinct(F.filter(F.split(seps, ""), lambda c: c != "")))
    longest = F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0))
    distinct = F.size(F.array_distinct(F.filter(F.split(digits(m), ""), lambda c: c != "")))
    return [n, F.length(digits(m)) / n, F.length(F.regexp_replace(m, r"[^\p{L}]", "")) / n, F.length(seps), kinds, F.size(groups), longest,
            distinct]


def features(kind: int, x: Column) -> Column:
    """Of the text around a span, then of its form."""
    l, r = x["l"], x["r"]
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)                                     # noqa: E731
    count = lambda t, cls: F.length(F.regexp_replace(t, f"[^{cls}]", ""))              # noqa: E731
    return F.array(*[c.cast("double") for c in (
        F.lit(kind), flag(l.rlike("[A-Za-z0-9]$")), flag(r.rlike("^[A-Za-z0-9]")), flag(l.rlike(r"[0-9]\W{0,3}$")),
        flag(r.rlike(r"^\W{0,3}[0-9]")), flag(l.rlike(r"\p{L}\W{0,3}$")), flag(r.rlike(r"^\W{0,3}\p{L}")),
        flag(l.rlike(CUES[KINDS[kind]])), flag(l.rlike("|".join(CUES.values()))),
        count(l, "0-9"), count(r, "0-9"), count(l, r"\p{L}"), count(r, r"\p{L}"), *form(x["m"]))])


def _meets(x: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))


def blocks(spans: Column) -> Column:
    """Spans in order of their start, ``BLOCK`` together, with the reach of each block."""
    starts = F.filter(F.sequence(F.lit(0), F.size(spans), F.lit(BLOCK)), lambda k: k < F.size(spans))
    return F.transform(starts, lambda k: let(F.slice(spans, k + 1, F.lit(BLOCK)), lambda x: F.struct(
        F.array_min(F.transform(x, lambda y: y["s"])).alias("s"), F.array_max(F.transform(x, lambda y: y["e"])).alias("e"),
        x.alias("spans"))))


def _meets_blocks(x: Column, found: Column) -> Column:
    return F.exists(found, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]) & _meets(x, b["spans"]))


ONE = "array<struct<s:int,k:int,e:int>>"


def in_order(base: dict[str, Column]) -> Column:
    """Base spans of all kinds in order: by start, then kind."""
    def placed(n: int, kind: str) -> Column:
        return F.transform(base[kind], lambda x: F.struct(x["s"].alias("s"), F.lit(n).alias("k"), x["e"].alias("e")))
    return F.array_sort(F.concat(*[placed(n, k) for n, k in enumerate(KINDS)])).cast(ONE)


def candidates(text: Column, base: dict[str, Column], all_spans: Column) -> Column:
    """array of (kind, s, e, f, y): proposed spans that meet no base span or one
    of their kind, their features, and their label: 1 if they meet one, 0 if
    refuted, else null."""
    def of(n: int, kind: str) -> Column:
        def label(x: Column, own: Column, taken: Column) -> Column:
            return F.when(_meets_blocks(x, own), 1.0).when(_meets_blocks(x, taken), -1.0).when(~FITS[kind](x["m"]), 0.0)

        def proposed(own: Column, taken: Column) -> Column:
            found = F.transform(matches(text, LOOSE[kind], LOOSE_GATES[kind]), lambda x: F.struct(
                x.alias("x"), label(x, own, taken).alias("y")))
            return F.transform(F.filter(found, lambda c: c["y"].isNull() | (c["y"] >= 0)), lambda c: F.struct(
                F.lit(n).alias("kind"), c["x"]["s"].alias("s"), c["x"]["e"].alias("e"), features(n, c["x"]).alias("f"),
                c["y"].alias("y")))
        return let(blocks(base[kind]), lambda own: let(blocks(all_spans), lambda taken: proposed(own, taken)))
    return F.concat(*[of(n, k) for n, k in enumerate(KINDS)])


def tree_columns(model) -> list[tuple[float, list[str]]]:
    """Weight and printed lines of each tree."""
    return [(w, t.toDebugString.splitlines()) for w, t in zip(model.treeWeights, model.trees)]


def _tree(lines: list[str], f: Column) -> Column:
    """A printed tree as nested conditions over the feature array."""
    def node(at: int) -> tuple[Column, int]:
        line = lines[at].strip()
        if got := re.match(r"Predict: (\S+)", line):
            return F.lit(float(got[1])), at + 1
        got = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
        yes, at = node(at + 1)
        no, at = node(at + 1)
        return F.when(F.get(f, F.lit(int(got[1]))) <= float(got[2]), yes).otherwise(no), at
    first = next(k for k, x in enumerate(lines) if re.match(r"\s*(Predict|If)", x))
    return node(first)[0]


def score(trees: list[tuple[float, list[str]]], f: Column) -> Column:
    margin = F.lit(0.0)
    for w, lines in trees:
        margin = margin + w * _tree(lines, f)
    return 1.0 / (1.0 + F.exp(-2.0 * margin))


#: Hash levels of the sample: a level holds half the spans of the one before.
LEVELS = 63


def labelled(docs: DataFrame) -> DataFrame:
    """kind, y, f, x (a hash) and level of each labelled span."""
    base = {k: F.col("b." + k) for k in KINDS}
    found = docs.withColumn("b", F.struct(*[c.alias(k) for k, c in base_spans(F.col("text")).items()]))
    found = found.withColumn("all", in_order(base))
    found = found.select("doc_id", "h", F.explode(candidates(F.col("text"), base, F.col("all"))).alias("c")).filter(
        "c.y is not null").select("c.kind", "c.y", "c.f", F.xxhash64("doc_id", "h", "c.kind", "c.s").alias("x"))
    found = found.withColumn("f", F.when(F.xxhash64("x") % 2 == 0, masked(F.col("f"))).otherwise(F.col("f")))
    return found.withColumn("level", F.lit(LEVELS) - F.length(F.bin(F.shiftrightunsigned("x", 1))))


def sample(spans: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` spans, an equal share of it for each kind and label."""
    share = max_rows // (2 * len(KINDS))
    groups: dict[tuple, dict[int, int]] = {}
    # at most 64 levels a kind and label
    for r in spans.groupBy("kind", "y", "level").count().collect():
        groups.setdefault((r["kind"], r["y"]), {})[r["level"]] = r["count"]
    keep = F.lit(False)
    for (kind, y), counts in groups.items():
        total, cut = 0, max(counts)    # the last level is taken even if copies crowd it
        for level in sorted(counts, reverse=True):
            total += counts[level]
            if total > share:
                break
            cut = level
        keep = keep | ((F.col("kind") == kind) & (F.col("y") == y) & (F.col("level") >= cut))
    return table(spans.filter(keep).orderBy("x", "kind", F.col("f").cast("string")).limit(max_rows), "spans")


def train(docs: DataFrame, *, max_rows: int, rounds: int, depth: int, precision: float, weight: float
          ) -> tuple[list, dict[int, float]] | None:
    """Trees from a bounded sample of the labelled spans, and thresholds by kind
    from all that are held out.  Copies of a text are on the same side."""
    docs = docs.withColumn("h", F.xxhash64("text"))
    part = F.pmod("h", F.lit(4))
    fit = sample(labelled(docs.filter(part != 0)), max_rows)
    if fit.select("y").distinct().count() < 2:
        return None
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    model = GBTClassifier(featuresCol="v", labelCol="y", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=1,
                          cacheNodeIds=False).fit(fit.select(array_to_vector("f").alias("v"), "y").coalesce(4))
    trees = tree_columns(model)
    bins = labelled(docs.filter(part == 0)).withColumn("p", let(F.col("f"), lambda f: score(trees, f))).groupBy(
        "kind", F.floor(F.col("p") * 100).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    # at most 101 bins a kind
    return trees, thresholds([tuple(r) for r in bins.collect()], precision, weight)


def thresholds(bins: list[tuple[int, int, int, float]], precision: float, weight: float) -> dict[int, float]:
    """bins: (kind, score in percent, spans, positive ones).  By kind, the least
    score above which the share of positive spans, drawn towards that of all
    kinds as by ``weight`` spans, is at least ``precision``; 2 if there is none."""
    limits = {k: 2.0 for k in range(len(KINDS))}
    seen = {k: [0, 0.0] for k in (*limits, None)}
    for at in sorted({b[1] for b in bins}, reverse=True):
        for kind, _, n, pos in (b for b in bins if b[1] == at):
            for k in (kind, None):
                seen[k][0] += n
                seen[k][1] += pos
        for k in limits:
            n, pos = seen[k]
            if pos + weight * seen[None][1] / seen[None][0] >= precision * (n + weight):
                limits[k] = at / 100
    return limits


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 20_000, rounds: int = 12,
             depth: int = 3, precision: float = 0.98, weight: float = 20.0) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (all
    redacted spans as kind:start:end), n_added."""
    d = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    model = train(d, max_rows=max_rows, rounds=rounds, depth=depth, precision=precision, weight=weight)
    text = F.col("text")
    out = d.withColumn("b", F.struct(*[c.alias(k) for k, c in base_spans(text).items()]))
    base = {k: F.col("b." + k) for k in KINDS}
    out = out.withColumn("all", in_order(base))
    if model is None:
        added = F.array().cast(ONE)
    else:
        trees, limits = model
        limit = F.array(*[F.lit(limits[k]) for k in range(len(KINDS))])

        new = F.filter(candidates(text, base, F.col("all")), lambda c: c["y"].isNull())
        scored = F.transform(new, lambda c: F.struct(
            (-F.greatest(let(c["f"], lambda f: score(trees, f)), let(masked(c["f"]), lambda f: score(trees, f)))).alias("p"), c["s"].alias("s"), c["kind"].alias("k"), c["e"].alias("e")))
        good = F.array_sort(F.filter(scored, lambda c: -c["p"] >= F.get(limit, c["k"])))
        # best first; a span that meets a better one is dropped
        added = F.aggregate(good, F.array().cast(ONE), lambda acc, c: F.when(_meets(c, acc), acc).otherwise(
            F.concat(acc, F.array(F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e")))).cast(ONE)))
    out = out.withColumn("added", added)
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
    return out.select("doc_id", *[F.size(base[k]).cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(joined(F.col("all")), 256).alias("base_sha256"),
                      joined(F.array_sort(F.concat("all", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))
