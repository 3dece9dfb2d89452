"""Queries on the whole tables with NULLs, orphans and bad lines made by rule.

The given tables hold none of them, so the rules for missing keys, for keys
known on one side only and for rejected lines are reached here.  Each query
has its DuckDB twin beside it.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from biasfit import schemas as S
from biasfit.functions.flags import add_flags, pack_flags, unpack_flags
from biasfit.functions.metrics import rmse_columns
from biasfit.operators.diagnostics import counted_nulls, null_cells_by_column
from biasfit.operators.effects import attach_bias, fit_bias, item_stats, global_mean, predict_bias, residuals, user_flag_effects, user_flag_stats
from biasfit.operators import state as ST
from biasfit.operators.copartition import Placement
from biasfit.operators.joins import JoinPolicy, keyed_join
from biasfit.operators.sampling import anti_join_all, assign_holdout_roles, prepare, semi_join_keys
from biasfit.operators.select import forward_select
from biasfit.operators.sweep import sweep_bias
from biasfit.session import materialize, scratch_path
from biasfit.sources.testdata import TestdataViews
from biasfit.sources.text import parse_ratings, write_ratings_text

ROW_ID = ["l_orderkey", "l_linenumber"]
LAMBDA = 5.0
GRID = (0.0, 2.5, 5.0)
#: Small buckets, so that hot keys are salted at any size.
SALTED = JoinPolicy(rows_per_bucket=50, max_hot_keys=1000)
NAMES = list(S.GENRE_FLAGS.values())


def r6(c: str):
    return F.round(F.col(c), 6)


# ------------------------------------------------------------------- NULLs

def null_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with some user, item and tag values missing; ``tags`` has them all."""
    f = TestdataViews(spark, sf_dir).facts()
    return f.withColumns({
        "movieId": F.when(F.col("l_suppkey") % 7 != 0, F.col("movieId")),
        "userId": F.when((F.col("l_linenumber") != 3) | (F.col("l_orderkey") % 4 != 0), F.col("userId")),
        "genres": F.when(F.col("l_suppkey") % 5 != 0, F.col("genres")), "tags": F.col("genres")})


def _null_rows(spark, sf_dir, *cols: str) -> DataFrame:
    """The columns of :func:`null_facts` that a query reads, written once: every
    step of the query reads them again, which would repeat the facts' joins."""
    return materialize(null_facts(spark, sf_dir).select("userId", "movieId", "rating", *ROW_ID, *cols), "table", "null-facts")


def _null_parts(spark, sf_dir, *cols: str):
    f = _null_rows(spark, sf_dir, *cols)
    return f.where("l_linenumber <> 1"), f.where("l_linenumber = 1")


def q_user_effect_nulls(spark, sf_dir):
    train, _ = _null_parts(spark, sf_dir)
    return fit_bias(train, LAMBDA, policy=SALTED).users.select("userId", r6("b_u").alias("b_u"), "m_u")


def q_bias_rmse_nulls(spark, sf_dir):
    train, test = _null_parts(spark, sf_dir)
    model = fit_bias(train, LAMBDA)
    known = semi_join_keys(test, train)
    return predict_bias(known, model).agg(*rmse_columns()).select(r6("rmse").alias("rmse"), "n_rows", "n_null_pred")


def q_observed_null_cells(spark, sf_dir):
    """NULL cells of the facts with missing values, counted on their one write."""
    w = prepare(add_flags(null_facts(spark, sf_dir).drop("tags"), S.TESTDATA_FLAGS), "null-facts", "rating", {})
    return counted_nulls(spark, {c: w.nulls[c] for c in ("userId", "movieId", "rating", *S.TESTDATA_FLAGS)})


def q_bias_sweep_salted(spark, sf_dir):
    """The sweep with every join salted, NULL keys included."""
    train, test = _null_parts(spark, sf_dir)
    mu, n = global_mean(train)
    return sweep_bias(train, semi_join_keys(test, train), GRID, mu, stats=item_stats(train, mu), total=n,
                      policy=SALTED).select("lambda", r6("rmse").alias("rmse"))


def q_placed_predictions_nulls(spark, sf_dir):
    """Predictions of rows laid out by user beside the users' effects: hot users
    and the missing user are split, and the users' join moves no row."""
    train, test = _null_parts(spark, sf_dir)
    model = fit_bias(train, LAMBDA)
    layout = Placement(train, "userId", 16, SALTED)
    rows = layout.write(layout.place(semi_join_keys(test, train)), "rows")
    placed = replace(model, users=layout.write(layout.copies(model.users), "users"))
    return predict_bias(rows, placed).select("userId", "movieId", *ROW_ID, r6("pred").alias("pred"))


def q_effect_nulls(spark, sf_dir):
    """Missing cells of the flag effects: rows without tags belong to no level."""
    train, _ = _null_parts(spark, sf_dir, "genres")
    train = add_flags(train, S.TESTDATA_FLAGS)
    flags = list(S.TESTDATA_FLAGS)
    res = residuals(train, fit_bias(train, LAMBDA), flags=flags)
    nulls = null_cells_by_column(train.select("userId", "movieId", *flags))
    eff = null_cells_by_column(user_flag_effects(user_flag_stats(res, flags), flags, S.SCREEN_LAMBDA).drop("m_u"))
    return nulls.withColumn("of", F.lit("facts")).unionByName(eff.withColumn("of", F.lit("effects")))


def q_forward_selection_nulls(spark, sf_dir):
    """Every second flag misses the rows without tags; a set with such a term
    has RMSE NULL and is rejected, the others are screened as usual."""
    train, test = _null_parts(spark, sf_dir, "genres", "tags")
    flags = list(S.TESTDATA_FLAGS)
    part = lambda k: {f: S.TESTDATA_FLAGS[f] for f in flags[k::2]}                     # noqa: E731
    put = lambda df: add_flags(add_flags(df, part(0), drop=()), part(1), tags="tags", drop=("genres", "tags", "title"))
    test = put(semi_join_keys(test, train))
    train = put(train)
    model = fit_bias(train, LAMBDA)
    effects = user_flag_effects(user_flag_stats(residuals(train, model, flags=flags), flags), flags, S.SCREEN_LAMBDA)
    rows = [(s["step"], s["flag"], None if math.isnan(s["rmse"]) else round(float(s["rmse"]), 6), s["decision"], s["kept"])
            for s in forward_select(attach_bias(test, model, flags=flags), flags, model.mu, effects).steps]
    return spark.createDataFrame(rows, "step INT, flag STRING, rmse DOUBLE, decision STRING, kept STRING")


# ---------------------------------------------------- states that are merged

def _merged(spark, sf_dir, *cols: str):
    """Train with NULLs as three lots of ratings, one of them withdrawn again."""
    f = _null_rows(spark, sf_dir, *cols)
    lots = [f.where("l_linenumber = 1"), f.where("l_linenumber in (2, 3)"), f.where("l_linenumber > 3")]
    made = lambda put, keys, value: ST.merge(*[ST.state(put(x), keys, value) for x in lots],       # noqa: E731
                                             ST.withdrawn(ST.state(put(lots[0]), keys, value)))
    return lots, made


def q_merged_item_effect(spark, sf_dir):
    _, made = _merged(spark, sf_dir)
    s = made(lambda x: x, "movieId", "rating")
    return ST.item_effects(s, ST.mean_of(s)[0], LAMBDA).select("movieId", r6("b_i").alias("b_i"), "n_i")


def _with_items(spark, sf_dir, *cols: str):
    lots, made = _merged(spark, sf_dir, *cols)
    # every lot's join reads the items' states
    s = materialize(made(lambda x: x, "movieId", "rating"), "table", "item-states")
    mu, n = ST.mean_of(s)
    items = ST.item_effects(s, mu, LAMBDA)
    join = lambda df, it: keyed_join(df, it, "movieId", "left", count_col="n_i", total=n, null_safe=True, policy=SALTED)
    return lots, made, lambda x: ST.item_residual(x, items, mu, join)


def q_merged_user_effect(spark, sf_dir):
    _, made, put = _with_items(spark, sf_dir)
    return ST.user_effects(made(put, "userId", "_value"), LAMBDA).select("userId", r6("b_u").alias("b_u"), "m_u")


def q_merged_flag_effect(spark, sf_dir):
    """Flag effects of ``r - mu - b_i`` from states per user, flag and level."""
    lots, _, put = _with_items(spark, sf_dir, "genres")
    flags = list(S.TESTDATA_FLAGS)

    def valued(x: DataFrame) -> DataFrame:
        x = pack_flags(add_flags(x, S.TESTDATA_FLAGS), flags)
        return unpack_flags(put(x), flags, ["userId", "_value", *flags])

    each = [ST.flag_states(valued(x), flags, "_value") for x in lots]
    return ST.flag_effects(ST.merge(*each, ST.withdrawn(each[0])), S.SCREEN_LAMBDA).select(
        "userId", "flag", "level", r6("effect").alias("effect"))


# ------------------------------------------------------------------ hot item

def q_ratings_fact_hot_item(spark, sf_dir):
    """The facts join with a third of the rows on one item, salted from the sketch."""
    return TestdataViews(spark, sf_dir, hot_item=True, policy=SALTED).facts().select(
        "userId", "movieId", "rating", "timestamp", "title", "genres")


# ----------------------------------------------------------------- hold-out

def _cut(n: int):
    """About a tenth of the rows, by the n-th pair of hex digits of their md5."""
    h = F.md5(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).cast("binary"))
    return F.substring(h, 2 * n - 1, 2) < "1a"


def by_order(spark, sf_dir):
    """Ratings of orders instead of parts: 1 to 7 rows an item, so that held
    rows lose their item."""
    f = TestdataViews(spark, sf_dir).ratings().withColumn("movieId", F.col("l_orderkey"))
    f = f.select("userId", "movieId", "rating", *ROW_ID).withColumns({"sampled": _cut(1), "later": _cut(2)})
    # written: known keys and the rows asked about are read apart, which would repeat the ratings' joins
    return materialize(f, "table", "by-order")


def q_holdout_orphans_returned(spark, sf_dir):
    r = assign_holdout_roles(by_order(spark, sf_dir), "sampled", orphan="return", held_role="validation", rest_role="pool")
    return r.where("sampled").select(*ROW_ID, "role")


def q_split_orphans_dropped(spark, sf_dir):
    r = assign_holdout_roles(by_order(spark, sf_dir), "sampled", orphan="drop", held_role="test", rest_role="train")
    return r.where("sampled").select(*ROW_ID, "role")


def q_holdout_by_joins(spark, sf_dir):
    """The same hold-out written as semi, semi, anti join and union."""
    f = by_order(spark, sf_dir).drop("later")
    rest, held = f.where("not sampled"), f.where("sampled")
    known = semi_join_keys(held, rest)
    pool = rest.unionByName(anti_join_all(held, known))
    return known.withColumn("role", F.lit("validation")).unionByName(pool.withColumn("role", F.lit("pool"))).select(*ROW_ID, "role")


def q_validation_refiltered(spark, sf_dir):
    f = by_order(spark, sf_dir)
    return semi_join_keys(f.where("sampled"), f.where("not sampled and not later")).select(*ROW_ID)


# -------------------------------------------------------------- files, tags

def q_rejected_lines(spark, sf_dir):
    """Lines by what reading makes of them: long and short ones and ones with an
    unreadable field are told apart; large ids and empty fields are good."""
    f = TestdataViews(spark, sf_dir).ratings(with_identity=False)
    path = scratch_path(spark, "bad-dat")
    write_ratings_text(f.withColumns({
        "userId": F.col("userId") + F.when(F.col("movieId") % 10 == 3, 3_000_000_000).otherwise(0),
        "timestamp": F.when(F.col("movieId") % 10 != 4, F.col("timestamp"))}), path)
    kind = F.get(F.split("value", "::"), F.lit(1)).cast("long") % 10
    lines = spark.read.text(path).select(
        F.when(kind == 0, F.concat("value", F.lit("::EXTRA"))).when(kind == 1, F.substring_index("value", "::", 2))
        .when(kind == 2, F.concat(F.lit("x"), F.col("value"))).otherwise(F.col("value")).alias("value"))
    return parse_ratings(lines).groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("reason").isNull(), F.col("userId"))).alias("sum_users"),
        F.count(F.when(F.col("reason").isNull() & F.col("timestamp").isNull(), 1)).alias("n_empty"))


def _tagged(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in NAMES])
    at = lambda c: F.get(names, (c % len(NAMES)).cast("int"))                          # noqa: E731
    m = F.col("movieId")
    return TestdataViews(spark, sf_dir).items().withColumn("genres", F.concat_ws("|", at(m), at(m * 7 + 3), at(m * 11 + 5)))


def q_genre_flags_19(spark, sf_dir):
    return add_flags(_tagged(spark, sf_dir), S.GENRE_FLAGS)


def q_genre_flags_compat(spark, sf_dir):
    return add_flags(_tagged(spark, sf_dir), S.COMPAT_GENRE_FLAGS)


QUERIES = {f.__name__[2:]: f for f in (
    q_user_effect_nulls, q_bias_rmse_nulls, q_bias_sweep_salted, q_placed_predictions_nulls, q_effect_nulls, q_observed_null_cells, q_forward_selection_nulls, q_merged_item_effect, q_merged_user_effect, q_merged_flag_effect, q_ratings_fact_hot_item, q_holdout_orphans_returned,
    q_split_orphans_dropped, q_holdout_by_joins, q_validation_refiltered, q_rejected_lines, q_genre_flags_19,
    q_genre_flags_compat)}


def _selection_sql(flags: list[tuple[str, str]], lam: str) -> str:
    """Greedy steps over the rows of ``ntr`` and ``nte``, each scored directly."""
    put = ", ".join(f"contains({('genres', 'tags')[k % 2]}, '{p}')::INT AS {f}" for k, (f, p) in enumerate(flags))
    screen = f"CAST({float(S.SCREEN_LAMBDA)!r} AS DOUBLE)"
    effect = ", ".join(f"coalesce(sum(e) FILTER (WHERE {f} = {v}), 0) / (count(*) FILTER (WHERE {f} = {v}) + {screen}) AS {f}_{d}"
                       for f, _ in flags for v, d in ((1, "up"), (0, "down")))
    xs = ", ".join(f"(r.{f} * 2 - 1) * (u.{f}_up - u.{f}_down) / 2 AS x{k}" for k, (f, _) in enumerate(flags))
    # a row without the term makes the RMSE of the set NULL
    rmse = lambda x: f"CASE WHEN count(*) = count({x}) THEN sqrt(avg(power({x}, 2))) END"          # noqa: E731
    sql = f"""
      , nbias AS (SELECT movieId, s / (n + {lam}) AS b_i FROM nst),
      nbu AS (SELECT userId, u / (m_u + {lam}) AS b_u FROM nus WHERE lam = {lam}),
      nft AS (SELECT l_linenumber <> 1 AS train, rating, CASE WHEN l_suppkey % 7 <> 0 THEN movieId END AS movieId,
        CASE WHEN l_linenumber <> 3 OR l_orderkey % 4 <> 0 THEN userId END AS userId,
        CASE WHEN l_suppkey % 5 <> 0 THEN genres END AS genres, genres AS tags FROM facts),
      nall AS (SELECT t.*, rating - (m + b_i + b_u) AS e FROM nft t
        JOIN nbias ON nbias.movieId IS NOT DISTINCT FROM t.movieId JOIN nbu ON nbu.userId IS NOT DISTINCT FROM t.userId, nmu),
      nfl AS MATERIALIZED (SELECT train, userId, e, {put} FROM nall),
      nfe AS MATERIALIZED (SELECT userId, {effect} FROM nfl WHERE train GROUP BY userId),
      nxs AS MATERIALIZED (SELECT r.e, {xs} FROM nfl r JOIN nfe u ON u.userId IS NOT DISTINCT FROM r.userId WHERE NOT r.train),
      ns0 AS (SELECT {rmse('e')} AS best0 FROM nxs)"""
    for k in range(len(flags)):
        kept = "".join(f" - CASE WHEN p.inc{j} THEN x{j} ELSE 0 END" for j in range(k))
        sql += f""",
      ns{k}a AS MATERIALIZED (SELECT p.*, (SELECT {rmse(f'e{kept} - x{k}')} FROM nxs) AS cand{k} FROM ns{k} p),
      ns{k + 1} AS MATERIALIZED (SELECT *, coalesce(cand{k} < best{k}, false) AS inc{k},
        CASE WHEN cand{k} < best{k} THEN cand{k} ELSE best{k} END AS best{k + 1} FROM ns{k}a)"""
    names = lambda k: ", ".join(f"CASE WHEN inc{j} THEN '{flags[j][0]}' END" for j in range(k + 1))
    return sql + " UNION ALL ".join(
        f""" SELECT {k + 1}::INT AS step, '{f}' AS flag, round(cand{k}, 6) AS rmse,
            CASE WHEN inc{k} THEN 'include' ELSE 'reject' END AS decision, concat_ws(',', {names(k)}) AS kept
            FROM ns{len(flags)}""" for k, (f, _) in enumerate(flags))


def oracle_sql(with_) -> dict[str, str]:
    """``with_(final, upto)`` puts the shared CTEs up to ``upto`` before a query."""
    flags = list(S.TESTDATA_FLAGS.items())
    lam = f"CAST({LAMBDA!r} AS DOUBLE)"
    nulls = """, nf AS (SELECT * EXCLUDE (userId, movieId, genres), CASE WHEN l_suppkey % 7 <> 0 THEN movieId END AS movieId,
        CASE WHEN l_linenumber <> 3 OR l_orderkey % 4 <> 0 THEN userId END AS userId,
        CASE WHEN l_suppkey % 5 <> 0 THEN genres END AS genres FROM facts),
      ntr AS (SELECT * FROM nf WHERE l_linenumber <> 1),
      nmu AS (SELECT avg(rating) AS m FROM ntr),
      nst AS (SELECT movieId, sum(rating - m) AS s, count(*) AS n FROM ntr, nmu GROUP BY movieId),
      nte AS (SELECT * FROM nf t WHERE l_linenumber = 1
        AND EXISTS (SELECT 1 FROM ntr r WHERE r.movieId IS NOT DISTINCT FROM t.movieId)
        AND EXISTS (SELECT 1 FROM ntr r WHERE r.userId IS NOT DISTINCT FROM t.userId)),
      ngr AS (SELECT unnest([0.0, 2.5, 5.0])::DOUBLE AS lam),
      nus AS (SELECT userId, lam, sum(t.rating - m - s / (n + lam)) AS u, count(*) AS m_u
        FROM ntr t JOIN nst ON nst.movieId IS NOT DISTINCT FROM t.movieId, nmu, ngr GROUP BY userId, lam),
      npr AS (SELECT t.*, nus.lam, m + s / (n + nus.lam) + u / (m_u + nus.lam) AS pred
        FROM nte t JOIN nst ON nst.movieId IS NOT DISTINCT FROM t.movieId JOIN nus ON nus.userId IS NOT DISTINCT FROM t.userId, nmu)
    """
    def chain(final: str) -> str:
        return with_(nulls + final, "facts")

    rmse = "round(sqrt(avg(power(rating - pred, 2))), 6) AS rmse"
    q = {
        "user_effect_nulls": chain(f"SELECT userId, round(u / (m_u + lam), 6) AS b_u, m_u FROM nus WHERE lam = {lam}"),
        "bias_rmse_nulls": chain(f"""SELECT {rmse}, count(*) AS n_rows, count(*) - count(pred) AS n_null_pred
            FROM npr WHERE lam = {lam}"""),
        "placed_predictions_nulls": chain(f"SELECT userId, movieId, l_orderkey, l_linenumber, round(pred, 6) AS pred FROM npr WHERE lam = {lam}"),
        "bias_sweep_salted": chain(f"SELECT lam AS lambda, {rmse} FROM npr GROUP BY lam"),
    }
    flag = {f: f"CASE WHEN genres IS NOT NULL THEN (contains(genres, '{p}'))::INT END" for f, p in flags}
    fact_cells = [(c, c) for c in ("userId", "movieId")] + list(flag.items())
    cells = [f"SELECT '{n}' AS \"column\", count(*) FILTER (WHERE ({e}) IS NULL) AS n_null, 'facts' AS of FROM ntr"
             for n, e in fact_cells]
    # an effect of a user without rows at a level is 0, never missing
    cells += ["SELECT 'userId', count(*) FILTER (WHERE userId IS NULL), 'effects' FROM (SELECT DISTINCT userId FROM ntr)"]
    cells += [f"SELECT '{f}_{d}', 0, 'effects'" for f, _ in flags for d in ("down", "up")]
    q["merged_item_effect"] = chain(f"SELECT movieId, round(s / (n + {lam}), 6) AS b_i, n AS n_i FROM nst")
    q["merged_user_effect"] = q["user_effect_nulls"]
    screen = f"CAST({float(S.SCREEN_LAMBDA)!r} AS DOUBLE)"
    q["merged_flag_effect"] = chain(f""", nv AS (SELECT t.userId, genres, t.rating - m - s / (n + {lam}) AS v FROM ntr t
        JOIN nst ON nst.movieId IS NOT DISTINCT FROM t.movieId, nmu) """ + " UNION ALL ".join(
        f"""SELECT userId, '{f}' AS flag, {lvl}::INT AS level, round(sum(v) / (count(*) + {screen}), 6) AS effect FROM nv
            WHERE contains(genres, '{p}')::INT = {lvl} GROUP BY userId""" for f, p in flags for lvl in (0, 1)))
    hot = "CASE WHEN l.l_linenumber % 3 = 0 THEN 1 ELSE l.l_partkey END"
    q["ratings_fact_hot_item"] = f"""SELECT o.o_custkey AS userId, {hot} AS movieId,
        CAST(least(10, greatest(1, floor((l.l_quantity * 2 + ({hot} % 7) * 10 + (o.o_custkey % 5) * 10
          + CASE WHEN p.p_type = 'PROMO' THEN CASE WHEN o.o_custkey % 2 = 0 THEN 40 ELSE -40 END ELSE 0 END) / 20))) / 2 AS DOUBLE) AS rating,
        CAST(epoch(l.l_shipdate) AS BIGINT) AS timestamp, p_name AS title, concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON p.p_partkey = {hot}"""
    q["effect_nulls"] = chain(" UNION ALL ".join(cells))
    q["observed_null_cells"] = chain(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {e} IS NULL) AS n_null FROM nf" for c, e in [
            *((k, k) for k in ("userId", "movieId", "rating")), *((f, f"contains(genres, '{p}')") for f, p in flags)]))
    q["forward_selection_nulls"] = chain(_selection_sql(flags, lam))
    h = "md5(l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR)"
    order = f""", bo AS (SELECT userId, l_orderkey AS movieId, l_orderkey, l_linenumber,
        substr({h}, 1, 2) < '1a' AS sampled, substr({h}, 3, 2) < '1a' AS later FROM ratings),
      known AS (SELECT b.*, EXISTS (SELECT 1 FROM bo r WHERE NOT r.sampled AND r.movieId = b.movieId)
        AND EXISTS (SELECT 1 FROM bo r WHERE NOT r.sampled AND r.userId = b.userId) AS k FROM bo b)
    """
    role = "SELECT l_orderkey, l_linenumber, CASE WHEN k THEN '{}' ELSE '{}' END AS role FROM known WHERE sampled"
    q["holdout_orphans_returned"] = with_(order + role.format("validation", "pool"), "ratings")
    q["split_orphans_dropped"] = with_(order + role.format("test", "dropped"), "ratings")
    q["holdout_by_joins"] = with_(order + """SELECT l_orderkey, l_linenumber,
        CASE WHEN sampled AND k THEN 'validation' ELSE 'pool' END AS role FROM known""", "ratings")
    q["validation_refiltered"] = with_(order + """SELECT l_orderkey, l_linenumber FROM bo b WHERE sampled
        AND EXISTS (SELECT 1 FROM bo r WHERE NOT r.sampled AND NOT r.later AND r.movieId = b.movieId)
        AND EXISTS (SELECT 1 FROM bo r WHERE NOT r.sampled AND NOT r.later AND r.userId = b.userId)""", "ratings")
    q["rejected_lines"] = with_("""SELECT CASE WHEN movieId % 10 < 2 THEN 'fields' WHEN movieId % 10 = 2 THEN 'value'
          ELSE 'good' END AS reason, count(*) AS n_lines,
        sum(CASE WHEN movieId % 10 > 2 THEN userId + CASE WHEN movieId % 10 = 3 THEN 3000000000 ELSE 0 END END)::BIGINT AS sum_users,
        count(*) FILTER (WHERE movieId % 10 = 4) AS n_empty FROM ratings GROUP BY 1""", "ratings")
    names = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
    n = len(NAMES)
    for key, patterns in (("genre_flags_19", S.GENRE_FLAGS), ("genre_flags_compat", S.COMPAT_GENRE_FLAGS)):
        cols = ", ".join(f"contains(g, '{p}')::INT AS {f}" for f, p in patterns.items())
        q[key] = f"""SELECT movieId, {cols} FROM (SELECT p_partkey AS movieId, concat_ws('|', {names}[p_partkey % {n} + 1],
            {names}[(p_partkey * 7 + 3) % {n} + 1], {names}[(p_partkey * 11 + 5) % {n} + 1]) AS g FROM part)"""
    return q
