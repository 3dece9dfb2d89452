"""Quality rules by host.

Each document is measured and fails or passes every rule of ``RULES``; those of
``BASE`` also decide on the document itself.  Each rule's failures are counted
by host (the ``source`` column), and a host's failure rate of a rule is shrunk
by that rule's own beta prior, fitted to all hosts: few documents move a host
little.  A host with a shrunk rate above ``max_rate`` is rejected with all its
documents; otherwise a document stands on its own.

Defined results: a null or empty text has no words, fails ``short`` and passes
the others; a null host is a host; repeated rows count each; where hosts do not
differ by more than chance, or all have one document, the prior is strong (1000
documents' worth: such a host alone proves nothing); one host alone has its own
rate; an empty table gives no rows; other columns are ignored (or kept, by
``keep_documents``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .common import TMP, SPACE, let, pick, table, words

#: Characters counted as symbols, and the window of words.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What fails a rule; ``v`` gives a measure's column by name.
RULES = {
    "short": lambda v: v("n_words") < 20,
    "repeats": lambda v: 100 * v("n_repeat_words") > 30 * v("n_words"),
    "symbols": lambda v: 10 * v("n_symbols") > v("n_words"),
    "dup_lines": lambda v: 100 * v("n_dup_lines") > 30 * v("n_lines"),
}
#: Rules a document must pass itself.  Hosts are also judged by failures of any of them.
BASE = ("short", "repeats")
#: Bounds of 1 / (1 + strength) of a prior: 1000 documents' worth, and ten.
PRIOR = (1 / 1001, 1 / 11)


def repeat_words(ws: Column) -> Column:
    """Words lying in ``WINDOW``-word windows that occur twice or more.

    Window hashes are compared as a set first; only texts with a repeat sort
    them, and the repeated starts are then swept once.
    """
    def starts(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(placed, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))

    def covered(at: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
        return F.aggregate(at, zero, lambda acc, p: F.struct(
            (acc["n"] + (p + WINDOW) - F.greatest(acc["end"], p.cast("long"))).alias("n"),
            (p + WINDOW).cast("long").alias("end")), lambda acc: acc["n"])

    def of_hashes(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                              lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(starts(h))).otherwise(
            F.lit(0).cast("long")))

    return F.when(F.size(ws) <= WINDOW, F.lit(0).cast("long")).otherwise(
        let(F.transform(ws, lambda x: F.xxhash64(x)), of_hashes))


def measures(text: Column) -> dict[str, Column]:
    """The columns of METRICS, computed from a text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    of_words = let(words(text), lambda ws: F.struct(F.size(ws).cast("long").alias("n"), repeat_words(ws).alias("r")))
    return {
        TMP + "w": of_words,
        TMP + "l": let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (
            F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))),
        "word_chars": F.length(F.translate(t, SPACE, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    }


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add METRICS, n_lines and base_failed."""
    out = docs.withColumns(measures(docs[text_col]))
    w, lines = F.col(TMP + "w"), F.col(TMP + "l")
    out = out.withColumns({"n_words": w["n"], "n_repeat_words": w["r"], "n_lines": lines["n"], "n_dup_lines": lines["dup"]})
    return out.drop(TMP + "w", TMP + "l").withColumn("base_failed", base_failed())


def base_failed(v: Callable[[str], Column] = F.col) -> Column:
    return reduce(or_, [RULES[r](v) for r in BASE])


def host_verdicts(measured: DataFrame, *, host_col: str = "source", max_rate: float = 0.5) -> DataFrame:
    """host, n_docs, rejected, rejected_by (the rules, comma-joined), and for
    each rule and for ``base`` (any of BASE) failed_<rule>, rate_<rule> (shrunk).

    Prior of a rule: mean m = failures / documents, and a strength by the
    moments of beta-binomial counts, so that the chance spread of small hosts
    isn't taken for a difference between hosts: with S = sum n (f/n - m)^2 over
    H hosts and N documents, 1 / (1 + strength) =
    (S / (m (1 - m)) - (H - 1)) / (N - sum n^2 / N - (H - 1)), within PRIOR.
    """
    fails = {**{r: failed(F.col) for r, failed in RULES.items()}, "base": base_failed()}
    hosts = measured.groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.count(F.when(e, 1)).alias(f"failed_{r}") for r, e in fails.items()])
    hosts = table(hosts, "hosts")
    n = F.col("n_docs").cast("double")
    moments = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("docs"), F.sum(n * n).alias("squares"),
        *[F.sum(F.col(f"failed_{r}")).alias(f"f_{r}") for r in fails],
        *[F.sum(F.col(f"failed_{r}") * F.col(f"failed_{r}") / n).alias(f"q_{r}") for r in fails]).first()
    rates = {}
    for r in fails:
        m, strength = _prior(moments["hosts"], moments["docs"], moments["squares"], moments[f"f_{r}"], moments[f"q_{r}"])
        rates[r] = (F.col(f"failed_{r}") + F.lit(m * strength)) / (n + F.lit(strength))
    out = hosts.withColumns({f"rate_{r}": rate for r, rate in rates.items()})
    out = out.withColumn("rejected_by", F.concat_ws(",", *[F.when(F.col(f"rate_{r}") > max_rate, F.lit(r)) for r in fails]))
    return out.withColumn("rejected", F.col("rejected_by") != "")


def _prior(hosts: int, docs: float | None, squares: float, failed: int, q: float) -> tuple[float, float]:
    """Mean and strength of a rule's prior from sums over hosts (q: of f^2 / n)."""
    if not hosts:
        return 0.0, 1.0
    m = failed / docs
    least, most = PRIOR
    spread, beyond = m * (1 - m), docs - squares / docs - (hosts - 1)
    # beyond is 0 if every host has one document: nothing tells hosts from documents
    rho = ((q - m * failed) / spread - (hosts - 1)) / beyond if spread > 0 and beyond > 1e-9 * docs else least
    return m, 1 / min(most, max(least, rho)) - 1


def _with_hosts(docs: DataFrame, host: Column, verdicts: DataFrame, bound: int) -> DataFrame:
    """Join the hosts' verdicts back: broadcast while the rejected hosts are at
    most ``bound``, else left to Spark (which splits a hot host at run time)."""
    bad = verdicts.filter("rejected").select(F.col("host").alias(TMP + "host"), F.lit(True).alias(TMP + "bad"))
    if bad.count() <= bound:
        bad = F.broadcast(bad)
    return docs.join(bad, host.eqNullSafe(F.col(TMP + "host")), "left")


def quality(docs: DataFrame, *, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
            max_rate: float = 0.5, broadcast_rows: int = 100_000) -> DataFrame:
    """doc_id, METRICS, base_failed, kept, n_lines per row."""
    d = pick(docs, doc_id=id_col, host=host_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    m = table(measure(d).select("doc_id", "host", *METRICS, "n_lines", "base_failed"), "measured")
    verdicts = host_verdicts(m, host_col="host", max_rate=max_rate)
    return _with_hosts(m, F.col("host"), verdicts, broadcast_rows).select(
        "doc_id", *METRICS, "base_failed", (~F.col("base_failed") & F.col(TMP + "bad").isNull()).alias("kept"), "n_lines")


def keep_documents(docs: DataFrame, *, host_col: str = "source", text_col: str = "text", max_rate: float = 0.5,
                   broadcast_rows: int = 100_000) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    d = pick(docs, host=host_col, text=text_col)
    verdicts = host_verdicts(measure(d).select("host", *METRICS, "n_lines"), host_col="host", max_rate=max_rate)
    m = measures(docs[text_col])
    rows = docs.withColumn(TMP + "w", m[TMP + "w"])
    of = {"n_words": F.col(TMP + "w")["n"], "n_repeat_words": F.col(TMP + "w")["r"]}
    rows = rows.filter(~base_failed(of.__getitem__))
    return _with_hosts(rows, rows[host_col], verdicts, broadcast_rows).filter(F.col(TMP + "bad").isNull()).select(*docs.columns)


ORACLE = r"""
with d as (select row_number() over () rid, doc_id, source, coalesce(text, '') t from documents),
w as (select rid, doc_id, source, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') ws from d),
win as (select rid, i, list_aggregate(ws[i:i+7], 'string_agg', ' ') s from (select rid, ws, unnest(range(1, len(ws) - 6)) i from w where len(ws) >= 8)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, s) c from win) where c > 1),
cov as (select rid, count(*) n from (select distinct rid, unnest(range(i, i + 8)) p from rep) group by rid),
m as (
  select w.rid, doc_id, source, len(ws)::bigint n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) > 0) ls,
    coalesce(cov.n, 0)::bigint n_repeat_words
  from w left join cov using (rid)),
b as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed
  from (select *, (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines, len(ls)::bigint n_lines from m)),
h as (
  select source, count(*)::double n,
    unnest([{'rule': 'base', 'f': count(*) filter (where base_failed)},
            {'rule': 'short', 'f': count(*) filter (where n_words < 20)},
            {'rule': 'repeats', 'f': count(*) filter (where 100 * n_repeat_words > 30 * n_words)},
            {'rule': 'symbols', 'f': count(*) filter (where 10 * n_symbols > n_words)},
            {'rule': 'dup_lines', 'f': count(*) filter (where 100 * n_dup_lines > 30 * n_lines)}]) x
  from b group by source),
p as (select x.rule as rule, sum(x.f) / sum(n) m, sum(n) docs, sum(n * n) sq, count(*) hosts from h group by x.rule),
v as (
  select rule, any_value(m) m, any_value(m * (1 - m)) spread, any_value(docs - sq / docs - (hosts - 1)) beyond,
    any_value(hosts) hosts, any_value(docs) docs, sum(n * (x.f / n - m) * (x.f / n - m)) s
  from h join p on x.rule = p.rule group by rule),
s as (
  select rule, m, 1 / least(1 / 11.0, greatest(1 / 1001.0, case when spread > 0 and beyond > 1e-9 * docs
    then (s / spread - (hosts - 1)) / beyond else 0.0 end)) - 1 k from v),
bad as (select source, bool_or((x.f + m * k) / (n + k) > 0.5) as rejected from h join s on x.rule = s.rule group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not rejected as kept, n_lines
from b join bad on b.source is not distinct from bad.source
"""
