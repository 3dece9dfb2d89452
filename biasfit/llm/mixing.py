"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets share ``total`` words over the sources by weight; a target stops at
``max_epochs`` times its source's size and the excess is reshared by weight
until none is above.  A source's target is met by complete epochs (every
document once more) and then a fractional selection: documents in order of the
exponential key ``-ln(u) / w`` (``u`` a uniform hash of the id, ``w`` the
document's quality weight) until their prefix sum of words reaches the rest.

The order within a source is cut in fixed key ranges, which are summed first;
the range that holds the end of a source's budget is cut and summed once more,
and only the part of it that holds the end, a ``RANGES``-squared-th of the source,
is sorted, so no source, however large, lies in one task.  What remains is one cutoff per source, and
documents are chosen row by row against it.

Defined results: null and blank texts have size 0 and no words taken; a null
source is a source, last in order; rows that repeat id and source share a key
and stand or fall together; sources of size 0 have target 0; an empty table
gives no rows; other columns are ignored (or kept, by ``mix_documents``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import TMP, global_index, n_words, pick, table

#: Weights of the sources by position, repeating.
WEIGHTS = (5, 2, 1)
#: Key ranges that a source's documents are summed by before any sorting.
RANGES = 4096


def uniform(doc_id: Column) -> Column:
    """(0, 1): 52 bits of the md5 of the id as text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def quality_weight(text: Column, size: Column) -> Column:
    """0.25 to 1: lower for texts dense in symbols, and for very short ones."""
    t = F.coalesce(text, F.lit(""))
    symbols = F.length(t) - F.length(F.translate(t, "#*$%&|<>{}[]\\^~_=", ""))
    dense = F.least(F.lit(1.0), symbols.cast("double") * 4.0 / (F.length(t).cast("double") + 1.0))
    short = F.least(F.lit(1.0), size.cast("double") / 20.0)
    return 0.25 + 0.75 * (1.0 - dense) * short


def es_key(doc_id: Column, weight: Column) -> Column:
    return -F.ln(uniform(doc_id)) / weight


def key_range(key: Column) -> Column:
    """Monotone in the key; even in number where weights are near 1."""
    return F.least(F.floor((1.0 - F.exp(-key * 0.5)) * RANGES), F.lit(RANGES - 1)).cast("int")


def key_part(key: Column) -> Column:
    """The part of its range that a key is in; monotone within the range."""
    within = (1.0 - F.exp(-key * 0.5)) * RANGES - key_range(key)
    return F.least(F.floor(within * RANGES), F.lit(RANGES - 1)).cast("int")


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3,
                   share: float = 1.0) -> DataFrame:
    """sizes: source, source_size.  Adds weight and target.

    Resharing is a loop of small aggregates over the sources: each round caps
    every source whose share is above its limit.
    """
    order = sizes.withColumns({TMP + "null": F.col("source").isNull().cast("int"),
                               TMP + "name": F.coalesce("source", F.lit(""))})
    placed = global_index(order, [TMP + "null", TMP + "name"], TMP + "at")
    cycle = F.array(*[F.lit(w) for w in weights])
    s = table(placed.select("source", "source_size", F.get(cycle, F.col(TMP + "at") % len(weights)).alias("weight")),
              "sources")
    limit = F.col("source_size") * float(max_epochs)
    total = (s.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0             # words per unit of weight for sources under their limit
    while True:
        capped = F.col("weight") * F.lit(level) >= limit
        got = s.agg(F.coalesce(F.sum(F.when(capped, limit)), F.lit(0.0)),
                    F.sum(F.when(~capped, F.col("weight")))).first()
        if not got[1]:
            break
        new = (total - got[0]) / got[1]
        if new <= level:
            break
        level = new
    return s.withColumn("target", F.least(F.col("weight") * F.lit(level), limit))


def _sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    d = pick(docs, doc_id=id_col, source=source_col, text=text_col)
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text",
                 n_words(F.col("text")).alias("size"))
    return d.select("doc_id", "source", "size", es_key(F.col("doc_id"), quality_weight(F.col("text"), F.col("size"))).alias("key"))


def _end(budgets: DataFrame, sums: DataFrame, name: str) -> DataFrame:
    """budgets (source, before, rest, ...) with ``name``: the first place, in
    order, at which the sums from ``before`` on reach the rest (null if none
    does); ``before`` becomes the sum of all places ahead of it.

    sums: source, at, size; at most ``RANGES`` rows per source, gathered."""
    per = sums.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("at", "size"))).alias(TMP + "places"))
    joined = budgets.join(per.withColumnRenamed("source", TMP + "source"), F.col("source").eqNullSafe(F.col(TMP + "source")), "left")
    state = lambda before, found: F.struct(before.alias("before"), found.alias("found"))             # noqa: E731

    def walk(rest: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            after = acc["before"] + x["size"]
            return F.when(acc["found"].isNotNull(), acc).when(after.cast("double") >= rest, state(acc["before"], x["at"])).otherwise(
                state(after, acc["found"]))
        places = F.coalesce(TMP + "places", F.array().cast("array<struct<at:int,size:bigint>>"))
        return F.aggregate(places, state(F.col("before"), F.lit(None).cast("int")), step)

    keep = [F.col(c) for c in budgets.columns if c != "before"]
    return joined.withColumn(TMP + "end", walk(F.col("rest"))).select(
        *keep, F.when(F.col("rest") > 0, F.col(TMP + "end.found")).alias(name), F.col(TMP + "end.before").alias("before"))


def _plan(sized: DataFrame, weights, max_epochs, share) -> DataFrame:
    """Per source: source_size, target, epochs and the cutoff (range, part, key,
    id) of the fractional selection.  ``sized`` is read three times."""
    binned = sized.withColumn("r", key_range(F.col("key")))
    per_range = table(binned.groupBy("source", "r").agg(F.sum("size").alias("size")), "ranges")
    sizes = per_range.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights=weights, max_epochs=max_epochs, share=share)
    full = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                              .otherwise(0).cast("long"))
    full = full.withColumn("rest", F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double"))
    plan = table(_end(full.withColumn("before", F.lit(0).cast("long")), per_range.withColumnRenamed("r", "at"), "range"), "plan")

    def at_end(df: DataFrame, plan: DataFrame, places: dict[str, str]) -> DataFrame:
        """Rows of each source at the place where its budget ends."""
        ends = plan.filter(F.col(list(places.values())[-1]).isNotNull()).select(
            F.col("source").alias(TMP + "source"), *places.values(), "before", "rest")
        on = F.col("source").eqNullSafe(F.col(TMP + "source"))
        for c, place in places.items():
            on = on & (F.col(c) == F.col(place))
        return df.join(ends, on)

    parts = at_end(binned, plan, {"r": "range"}).groupBy("source", key_part(F.col("key")).alias("at")).agg(F.sum("size").alias("size"))
    plan = table(_end(plan, table(parts, "parts"), "part"), "plan")
    # the one part of a range per source that must be sorted
    edge = (at_end(binned.withColumn("p", key_part(F.col("key"))), plan, {"r": "range", "p": "part"})
            .groupBy(TMP + "source", "key", "doc_id", "before", "rest").agg(F.sum("size").alias("size")))
    run = Window.partitionBy(TMP + "source").orderBy("key", F.col("doc_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("sum", F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    # a document is taken while its middle lies before the end of the budget
    taken = edge.filter(F.col("sum") + F.col("size") / 2.0 < F.col("rest"))
    cut = taken.groupBy(TMP + "source").agg(F.max(F.struct("key", "doc_id")).alias("cut"))
    return table(plan.join(cut, F.col("source").eqNullSafe(F.col(TMP + "source")), "left").drop(TMP + "source"), "cutoffs")


def _times(plan_prefix: str, key: Column, doc_id: Column) -> Column:
    """How often the mix takes a document."""
    p = lambda c: F.col(plan_prefix + c)                                              # noqa: E731
    r, part = key_range(key), key_part(key)
    in_part = p("cut").isNotNull() & ((key < p("cut")["key"]) | ((key == p("cut")["key"]) & (
        doc_id.isNull() | (doc_id <= p("cut")["doc_id"]))))
    chosen = (r < p("range")) | ((r == p("range")) & ((part < p("part")) | ((part == p("part")) & in_part)))
    return p("epochs") + F.when(chosen, 1).otherwise(0)


def _with_plan(rows: DataFrame, source: Column, plan: DataFrame, prefix: str, bound: int) -> DataFrame:
    """Join the sources' plan; broadcast only while it has at most ``bound`` rows."""
    small = plan.select([F.col(c).alias(prefix + c) for c in plan.columns])
    if plan.count() <= bound:
        small = F.broadcast(small)
    return rows.join(small, source.eqNullSafe(F.col(prefix + "source")), "left")


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, share: float = 1.0,
        broadcast_rows: int = 100_000) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words) per row."""
    sized = table(_sized(docs, id_col, source_col, text_col), "sized")
    plan = _plan(sized, weights, max_epochs, share)
    out = _with_plan(sized, F.col("source"), plan, TMP, broadcast_rows)
    times = _times(TMP, F.col("key"), F.col("doc_id"))
    return out.select("doc_id", "source", "size", F.col(TMP + "source_size").alias("source_size"),
                      F.col(TMP + "target").alias("target"), (F.col("size") * times).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                  weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, share: float = 1.0,
                  broadcast_rows: int = 100_000) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as
    often as the mix takes it; whole documents, cut against row by row."""
    plan = _plan(table(_sized(docs, id_col, source_col, text_col), "sized"), weights, max_epochs, share)
    cols = docs.columns
    text, doc_id = docs[text_col], docs[id_col].cast("long")
    rows = docs.withColumns({TMP + "key": es_key(doc_id, quality_weight(text, n_words(text)))})
    out = _with_plan(rows, rows[source_col].cast("string"), plan, TMP + "p_", broadcast_rows)
    times = _times(TMP + "p_", F.col(TMP + "key"), F.col(id_col).cast("long"))
    return out.withColumn(TMP + "n", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*cols)


ORACLE = r"""
with sized as (
  select doc_id, source, coalesce(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')), 0)::bigint size,
         coalesce(text, '') t
  from documents),
keyed as (
  select doc_id, source, size,
    -ln((('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 13))::bigint::double + 0.5) / 4503599627370496.0)
    / (0.25 + 0.75 * (1.0 - least(1.0, (length(t) - length(translate(t, '#*$%&|<>{}[]\^~_=', '')))::double * 4.0 / (length(t)::double + 1.0)))
                   * least(1.0, size::double / 20.0)) as key
  from sized),
sources as (
  select source, sum(size)::double size,
         [5, 2, 1][((row_number() over (order by source is null, source collate "C")) - 1) % 3 + 1]::double w
  from sized group by source),
ordered as (
  select *, 3 * size / w as c,
    coalesce(sum(3 * size) over o, 0) as capped, sum(w) over (order by 3 * size / w, source rows between current row and unbounded following) as rest_w,
    sum(size) over () as total
  from sources window o as (order by 3 * size / w, source rows between unbounded preceding and 1 preceding)),
level as (select max((total - capped) / rest_w) as lam from ordered where (total - capped) / rest_w <= c),
targets as (
  select source, size, least(coalesce(w * lam, 3 * size), 3 * size) target from ordered, (select max(lam) lam from level)),
plan as (select *, case when size > 0 then floor(target / size) else 0 end epochs from targets),
run as (
  select k.doc_id, k.source, k.size, p.size source_size, p.target, p.epochs, p.target - p.epochs * p.size rest,
    coalesce(sum(k.size) over (partition by k.source order by k.key, k.doc_id rows between unbounded preceding and 1 preceding), 0) before
  from keyed k join plan p on k.source is not distinct from p.source)
select doc_id, size, source_size::bigint source_size, round(target, 6) target,
  (size * (epochs + case when before + size / 2.0 < rest then 1 else 0 end))::bigint taken
from run
"""
