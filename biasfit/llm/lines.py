"""Line dedup by a suffix array over line-ID sequences.

A document is its sequence of lines that hold a word; all documents together
are one text over line ids.  Prefix doubling sorts its suffixes: round k ranks
every position by its next 2^k lines, from the ranks of its two halves.  A rank
is the left end of the interval of suffixes with that common prefix, so equal
ranks are intervals of longest common prefix at least 2^k lines.  Lines that
occur once, and positions whose interval has one suffix, can't lie in a
repeated run and leave the rounds.

A run is repeated if it occurs earlier in the corpus (by id, then line) and
holds at least ``min_words`` words.  Every maximal repeated run is the union of
its shortest windows of ``min_words`` words, taken forward from each line and
backward from each; their intervals follow from two overlapping ranks.  Lines
of windows that aren't the first of their interval are deleted.  As a window
has at most ``min_words`` lines, doubling stops at that depth: longer common
prefixes can't change what is deleted.

Defined results: null texts stay null, blank lines stay; rows that repeat both
id and text are one document and get the same result; rows with one id and
different texts are documents in order of their hash; a null id comes first;
an empty table gives no rows; other columns are ignored (or kept, by
``dedup_documents``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import keyed_join
from .common import TMP, WORD, global_index, let, may_be_among, n_words, pick, table

KEY = ["doc_id", "th"]


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, i, j, h, g, w): the i-th line with a word, at line j, its
    two hashes (96 bits together) and its words."""
    placed = F.filter(F.transform(F.split("text", "\n"), lambda x, j: F.struct(x.alias("x"), j.alias("j"))),
                      lambda s: s["x"].rlike(WORD))
    d = docs.filter("text is not null").select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(placed).alias("i", "s"))
    return d.select("doc_id", "th", "i", F.col("s.j").alias("j"), F.xxhash64("s.x").alias("h"), F.hash("s.x").alias("g"),
                    n_words(F.col("s.x")).cast("int").alias("w"))


def _ranked(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Add ``name``: the number of rows with a smaller ``by`` among the rows
    whose ``by`` is shared; null where it isn't shared or incomplete."""
    classes = rows.dropna(subset=by).groupBy(*by).agg(F.count(F.lit(1)).alias(TMP + "n")).filter(F.col(TMP + "n") > 1)
    placed = table(global_index(classes, by, name, weight=TMP + "n"), "ranks")
    total = placed.agg(F.sum(TMP + "n")).first()[0] or 0
    return keyed_join(rows, placed, by, "left", count_col=TMP + "n", total=total, salt_cols=KEY + ["i"]).drop(TMP + "n")


def suffix_ranks(docs: DataFrame, depth: int) -> tuple[DataFrame, int]:
    """(doc_id, th, i, j, w, r0 ... rK): ranks by the next 2^k lines up to
    ``depth``, for the lines that occur more than once; and K."""
    lines = table(_lines(docs), "lines")
    ranked = _ranked(lines, ["h", "g"], "r0").filter("r0 is not null").drop("h", "g").distinct()
    rows, k = table(ranked, "level"), 0
    while 2 << k <= depth:
        ahead = Window.partitionBy(*KEY).orderBy("i").rangeBetween(1 << k, 1 << k)
        pairs = rows.withColumn(TMP + "next", F.max(f"r{k}").over(ahead))
        rows = table(_ranked(pairs, [f"r{k}", TMP + "next"], f"r{k + 1}").drop(TMP + "next"), "level")
        k += 1
    return rows, k


def _windows(rows: DataFrame, levels: int, min_words: int) -> DataFrame:
    """(doc_id, th, s, l, a, b): shortest windows of ``min_words`` words, from
    line s on over l lines, named by l and two overlapping ranks."""
    item = F.struct("i", "w", F.array(*[F.col(f"r{k}") for k in range(levels + 1)]).alias("r"))
    order = Window.partitionBy(*KEY).orderBy("i")
    ahead = F.collect_list(item).over(order.rowsBetween(0, min_words - 1))
    back = F.reverse(F.collect_list(item).over(order.rowsBetween(1 - min_words, 0)))

    def length(items: Column, step: int) -> Column:
        """Lines of the shortest window from the first item on; 0 if it breaks off."""
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"), F.lit(True).alias("on"))
        first = F.get(items, F.lit(0))["i"]

        def add(acc: Column, x: Column) -> Column:
            on = acc["on"] & (acc["w"] < min_words) & (x["i"] == first + acc["n"] * step)
            return F.when(on, F.struct((acc["n"] + 1).alias("n"), (acc["w"] + x["w"]).alias("w"), F.lit(True).alias("on"))
                          ).otherwise(F.struct(acc["n"].alias("n"), acc["w"].alias("w"), F.lit(False).alias("on")))
        return F.aggregate(items, zero, add, lambda acc: F.when(acc["w"] >= min_words, acc["n"]).otherwise(0))

    def name(items: Column, step: int) -> Column:
        def of(n: Column) -> Column:
            k = sum(((n >= 1 << x).cast("int") for x in range(1, levels + 1)), F.lit(0))
            span = F.get(F.array(*[F.lit(1 << x) for x in range(levels + 1)]), k)
            lo, hi = (F.lit(0), n - span) if step > 0 else (n - 1, span - 1)
            at = lambda p: F.get(F.get(items, p)["r"], k)                             # noqa: E731
            start = F.get(items, F.lit(0))["i"] - (F.lit(0) if step > 0 else n - 1)
            return F.when(n > 0, F.struct(start.alias("s"), n.alias("l"), at(lo).alias("a"), at(hi).alias("b")))
        return let(length(items, step), of)

    both = rows.select(*KEY, ahead.alias("ahead"), back.alias("back")).select(
        *KEY, F.explode(F.array(let(F.col("ahead"), lambda x: name(x, 1)), let(F.col("back"), lambda x: name(x, -1)))).alias("v"))
    return both.filter("v.a is not null and v.b is not null").select(*KEY, "v.*").distinct()


def repeated_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, th, cut): the lines to delete, as an array of line numbers.
    docs: doc_id, text."""
    rows, levels = suffix_ranks(docs, min_words)
    windows = table(_windows(rows, levels, min_words), "windows")
    # written, so that both sides of the join are plain shuffles whose hot keys Spark can split
    classes = table(windows.groupBy("l", "a", "b").agg(
        F.min(F.struct("doc_id", "th", "s")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "classes")
    total = windows.count()
    later = keyed_join(windows, classes, ["l", "a", "b"], "inner", count_col="n", total=total, salt_cols=KEY + ["s"]).filter(
        ~F.struct("doc_id", "th", "s").eqNullSafe(F.col("first")))
    cut = later.select(*KEY, F.explode(F.expr("sequence(s, s + l - 1)")).alias("i")).distinct()
    cut = cut.select(F.col("doc_id").alias(TMP + "d"), F.col("th").alias(TMP + "t"), F.col("i").alias(TMP + "i"))
    same = rows["doc_id"].eqNullSafe(cut[TMP + "d"]) & (rows["th"] == cut[TMP + "t"]) & (rows["i"] == cut[TMP + "i"])
    return rows.join(cut, same, "left_semi").groupBy(*KEY).agg(F.collect_list("j").alias("cut"))


def _cut(text: Column, cut: Column) -> Column:
    return let(F.split(text, "\n"), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), cut), lambda j: F.get(x, j)), "\n"))


def _with_cuts(docs: DataFrame, doc_id: Column, text: Column, found: DataFrame) -> DataFrame:
    """Join the cuts: only rows that may have some are moved."""
    found = found.select(F.col("doc_id").alias(TMP + "d"), F.col("th").alias(TMP + "t"), F.col("cut").alias(TMP + "cut"))
    rows = docs.withColumns({TMP + "id": doc_id, TMP + "th": F.xxhash64(text)})
    rows = may_be_among(rows, F.xxhash64(TMP + "id", TMP + "th"), found.select(F.xxhash64(TMP + "d", TMP + "t")), TMP + "some")
    stay = rows.filter(~F.col(TMP + "some")).withColumn(TMP + "cut", F.lit(None).cast("array<int>"))
    # the cuts grow with the corpus: one plan at every size, no broadcast of a small table's
    move = rows.filter(TMP + "some").join(
        found.hint("merge"), F.col(TMP + "id").eqNullSafe(F.col(TMP + "d")) & (F.col(TMP + "th") == F.col(TMP + "t")), "left")
    cols = [*docs.columns, TMP + "cut"]
    return stay.select(*cols).unionByName(move.select(*cols))


def line_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 25) -> DataFrame:
    """doc_id, n_lines, n_removed, text (without the removed lines) per row."""
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = table(repeated_lines(d, min_words), "cuts")
    cut = F.col(TMP + "cut")
    return _with_cuts(d, d["doc_id"], d["text"], found).select(
        "doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.when(cut.isNull(), 0).otherwise(F.size(cut)).cast("long").alias("n_removed"),
        F.when(cut.isNull(), F.col("text")).otherwise(_cut(F.col("text"), cut)).alias("text"))


def dedup_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
                    min_words: int = 25) -> DataFrame:
    """The rows of ``docs`` with all columns, their texts without the removed
    lines and ``length_col``, if there, brought up to date."""
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = table(repeated_lines(d, min_words), "cuts")
    out = _with_cuts(docs, docs[id_col].cast("long"), docs[text_col], found)
    cut, text = F.col(TMP + "cut"), F.col(text_col)
    out = out.withColumn(TMP + "new", F.when(cut.isNull(), text).otherwise(_cut(text, cut)))
    kinds = dict(docs.dtypes)
    new = {text_col: F.col(TMP + "new")}
    if length_col in kinds:
        new[length_col] = F.when(cut.isNull(), F.col(length_col)).otherwise(F.length(TMP + "new").cast(kinds[length_col]))
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


ORACLE = r"""
with docs as (select doc_id, text, string_split(text, chr(10)) ls from documents),
raw as (select doc_id, unnest(range(0, len(ls))) j, unnest(ls) x from docs),
l as (select doc_id, j, x, row_number() over (partition by doc_id order by j) i,
        len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda w: w <> '')) w
      from raw where length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) > 0),
c as (select *, sum(w) over (partition by doc_id order by i) e from l),
fwd as (select p.doc_id, p.i s, min(q.i) t from c p join c q on p.doc_id = q.doc_id and q.i between p.i and p.i + 24
        where q.e - p.e + p.w >= 25 group by all),
bwd as (select p.doc_id, max(q.i) s, p.i t from c p join c q on p.doc_id = q.doc_id and q.i between p.i - 24 and p.i
        where p.e - q.e + q.w >= 25 group by all),
win as (select * from fwd union select * from bwd),
txt as (select win.doc_id, s, t, string_agg(x, chr(10) order by i) k
        from win join c on c.doc_id = win.doc_id and c.i between s and t group by all),
firsts as (select k, min((doc_id, s)) f from txt group by k having count(*) > 1),
cut as (select distinct doc_id, unnest(range(s, t + 1)) i from txt join firsts using (k) where (doc_id, s) <> f),
kept as (select r.doc_id, string_agg(r.x, chr(10) order by r.j) text, count(*) n
         from raw r left join l on l.doc_id = r.doc_id and l.j = r.j left join cut on cut.doc_id = l.doc_id and cut.i = l.i
         where cut.i is null group by r.doc_id)
select d.doc_id, coalesce(len(ls), 0)::bigint n_lines, (coalesce(len(ls), 0) - coalesce(n, 0))::bigint n_removed,
  case when d.text is not null then coalesce(kept.text, '') end as text
from docs d left join kept using (doc_id)
"""
