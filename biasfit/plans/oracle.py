"""DuckDB SQL twins of the registered queries (the correctness oracle).

The SQL re-derives every stage independently of the Spark plans: the
stratified sample with a plain ``row_number`` window, hold-outs with
``EXISTS`` (NULL-safe), sweeps by joining a lambda grid, and forward
selection by direct RMSE at every step (the Spark side uses the Gram
identity).  Doubles are rounded to 6 decimals as on the Spark side.
"""

from __future__ import annotations

import re

from biasfit import schemas as S
from biasfit.plans import edge_cases

FLAGS = list(S.TESTDATA_FLAGS.items())
P = repr(float(S.HOLDOUT_FRACTION))
PROBS = "[0.0, 0.25, 0.5, 0.75, 1.0]"
TIE = ("l_orderkey, l_linenumber, movieId, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
       "l_returnflag, l_linestatus, timestamp")
KEY = ", ".join(f"CAST({c} AS VARCHAR)" for c in ("l_orderkey", "l_linenumber", "movieId", "l_suppkey"))
SCREEN = f"CAST({float(S.SCREEN_LAMBDA)!r} AS DOUBLE)"
B0, B1, BSTEP = S.BIAS_LAMBDA_GRID
F0, F1, FSTEP = S.FLAG_LAMBDA_GRID
NB = len(S.grid_values(S.BIAS_LAMBDA_GRID))
NF = len(S.grid_values(S.FLAG_LAMBDA_GRID))


def _shrunk(s: str, n: str, lam: str) -> str:
    return f"(CASE WHEN {n} > 0 THEN {s} / ({n} + {lam}) WHEN {n} = 0 THEN 0.0 END)"


def _flag_term(f: str, stats: str, lam: str) -> str:
    up = _shrunk(f"{stats}.{f}__s1", f"{stats}.{f}__n1", lam)
    down = _shrunk(f"{stats}.{f}__s0", f"{stats}.{f}__n0", lam)
    return f"(({f} * 2 - 1) * ({up} - {down}) / 2)"


def _sample(tag: str, src: str, seed: str) -> list[tuple[str, str]]:
    """Exact stratified sample of ``src`` by ``row_number`` per stratum."""
    return [
        (f"brk{tag}", f"SELECT list_sort(list_distinct(quantile_cont(rating, {PROBS}))) AS b FROM {src}"),
        (f"brkv{tag}", f"SELECT unnest(b) AS v FROM brk{tag}"),
        (f"st{tag}", f"""SELECT f.*,
              CASE WHEN f.rating IS NULL THEN NULL
                   ELSE greatest(1, (SELECT count(*) FROM brkv{tag} WHERE brkv{tag}.v < f.rating)) END AS stratum,
              md5(concat_ws('|', '{seed}', {KEY})) AS h
            FROM {src} f"""),
        (f"kk{tag}", f"""SELECT stratum AS ks, CAST(ceil(count(*) * {P}::DOUBLE) AS BIGINT) AS k
            FROM st{tag} WHERE stratum IS NOT NULL GROUP BY stratum"""),
        (f"samp{tag}", f"""SELECT r.* EXCLUDE (h, rn, ks, k), coalesce(r.stratum IS NOT NULL AND r.rn <= r.k, false) AS sampled
            FROM (SELECT s.*, kk.ks, kk.k, row_number() OVER (PARTITION BY s.stratum ORDER BY s.h, {TIE}) AS rn
                  FROM st{tag} s LEFT JOIN kk{tag} kk ON s.stratum = kk.ks) r"""),
    ]


def _known(alias: str, ref: str) -> str:
    return (f"(EXISTS (SELECT 1 FROM {ref} r WHERE r.movieId IS NOT DISTINCT FROM {alias}.movieId) AND "
            f"EXISTS (SELECT 1 FROM {ref} r WHERE r.userId IS NOT DISTINCT FROM {alias}.userId))")


def _ctes() -> list[tuple[str, str]]:
    flag_cols = ", ".join(f"CAST(contains(genres, '{p}') AS INTEGER) AS {f}" for f, p in FLAGS)
    c: list[tuple[str, str]] = [
        ("ratings", """SELECT o.o_custkey AS userId, l.l_partkey AS movieId,
              CAST(least(10, greatest(1, floor((l.l_quantity * 2 + (l.l_partkey % 7) * 10 + (o.o_custkey % 5) * 10
                   + CASE WHEN p.p_type = 'PROMO' THEN CASE WHEN o.o_custkey % 2 = 0 THEN 40 ELSE -40 END ELSE 0 END) / 20)))
                   / 2 AS DOUBLE) AS rating,
              CAST(epoch(l.l_shipdate) AS BIGINT) AS timestamp,
              l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
              l.l_returnflag, l.l_linestatus
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                 LEFT JOIN part p ON l.l_partkey = p.p_partkey"""),
        ("items", """SELECT p_partkey AS movieId, p_name AS title,
              concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres FROM part"""),
        ("facts", "SELECT r.*, i.title, i.genres FROM ratings r LEFT JOIN items i ON r.movieId = i.movieId"),
        ("flagged", f"SELECT * EXCLUDE (title, genres), {flag_cols} FROM facts"),
    ]
    c += _sample("1", "flagged", "1")
    c += [
        ("rest1", "SELECT * EXCLUDE (sampled, stratum) FROM samp1 WHERE NOT sampled"),
        ("hold1", "SELECT * EXCLUDE (sampled, stratum) FROM samp1 WHERE sampled"),
        ("role1", f"""SELECT *, 'pool' AS role1 FROM rest1
            UNION ALL
            SELECT h.*, CASE WHEN {_known('h', 'rest1')} THEN 'validation' ELSE 'pool' END FROM hold1 h"""),
        ("pool", "SELECT * EXCLUDE (role1) FROM role1 WHERE role1 = 'pool'"),
    ]
    c += _sample("2", "pool", "2")
    c += [
        ("rest2", "SELECT * EXCLUDE (sampled, stratum) FROM samp2 WHERE NOT sampled"),
        ("hold2", "SELECT * EXCLUDE (sampled, stratum) FROM samp2 WHERE sampled"),
        ("split", f"""SELECT *, 'train' AS role FROM rest2
            UNION ALL
            SELECT h.*, CASE WHEN {_known('h', 'rest2')} THEN 'test' ELSE 'dropped' END FROM hold2 h
            UNION ALL
            SELECT * EXCLUDE (role1), 'validation' FROM role1 WHERE role1 = 'validation'"""),
        ("train", "SELECT * EXCLUDE (role) FROM split WHERE role = 'train'"),
        ("test", "SELECT * EXCLUDE (role) FROM split WHERE role = 'test'"),
        ("validation", f"SELECT * EXCLUDE (role) FROM split v WHERE role = 'validation' AND {_known('v', 'train')}"),
        ("mu", "SELECT avg(rating) AS mu, count(*) AS n FROM train"),
        ("istats", """SELECT t.movieId, sum(t.rating - m.mu) AS s_i, count(*) AS n_i
            FROM train t CROSS JOIN mu m GROUP BY t.movieId"""),
        ("grid1", f"SELECT CAST({B0!r} AS DOUBLE) + i * CAST({BSTEP!r} AS DOUBLE) AS lambda FROM range({NB}) g(i)"),
        ("usweep", """SELECT t.userId, g.lambda, sum(t.rating - m.mu - s.s_i / (s.n_i + g.lambda)) AS u, count(*) AS m_u
            FROM train t JOIN istats s ON s.movieId = t.movieId CROSS JOIN grid1 g CROSS JOIN mu m
            GROUP BY t.userId, g.lambda"""),
        ("bsweep", """SELECT u.lambda,
              sqrt(avg(power(t.rating - (m.mu + s.s_i / (s.n_i + u.lambda) + u.u / (u.m_u + u.lambda)), 2))) AS rmse
            FROM test t JOIN istats s ON s.movieId = t.movieId JOIN usweep u ON u.userId = t.userId
                 CROSS JOIN mu m GROUP BY u.lambda"""),
        ("bbest", "SELECT lambda AS lb, rmse FROM bsweep ORDER BY rmse, lambda LIMIT 1"),
        ("bi", "SELECT s.movieId, s.s_i / (s.n_i + b.lb) AS b_i, s.n_i FROM istats s CROSS JOIN bbest b"),
        ("bu", """SELECT t.userId, sum(t.rating - bi.b_i - m.mu) / (count(*) + max(b.lb)) AS b_u, count(*) AS m_u
            FROM train t JOIN bi ON bi.movieId = t.movieId CROSS JOIN mu m CROSS JOIN bbest b GROUP BY t.userId"""),
        ("tscored", """SELECT t.*, bi.b_i, bu.b_u FROM test t LEFT JOIN bi ON bi.movieId = t.movieId
            LEFT JOIN bu ON bu.userId = t.userId"""),
        ("tresid", """SELECT t.*, bi.b_i, bu.b_u, t.rating - (m.mu + bi.b_i + bu.b_u) AS resid
            FROM train t LEFT JOIN bi ON bi.movieId = t.movieId LEFT JOIN bu ON bu.userId = t.userId
                 CROSS JOIN mu m"""),
    ]
    stat_cols = ", ".join(
        f"sum(resid) FILTER (WHERE {f} = 1) AS {f}__s1, count(*) FILTER (WHERE {f} = 1) AS {f}__n1, "
        f"sum(resid) FILTER (WHERE {f} = 0) AS {f}__s0, count(*) FILTER (WHERE {f} = 0) AS {f}__n0"
        for f, _p in FLAGS)
    eff_cols = ", ".join(
        f"{_shrunk(f'{f}__s0', f'{f}__n0', SCREEN)} AS {f}_down, {_shrunk(f'{f}__s1', f'{f}__n1', SCREEN)} AS {f}_up"
        for f, _p in FLAGS)
    x_cols = ", ".join(f"(t.{f} * 2 - 1) * (e.{f}_up - e.{f}_down) / 2 AS x{k}" for k, (f, _p) in enumerate(FLAGS))
    c += [
        ("fstats", f"SELECT userId, count(*) AS m_u, {stat_cols} FROM tresid GROUP BY userId"),
        ("eff30", f"SELECT userId, {eff_cols} FROM fstats"),
        ("xs", f"""SELECT t.rating - (m.mu + t.b_i + t.b_u) AS e, {x_cols}
            FROM tscored t JOIN eff30 e ON e.userId = t.userId CROSS JOIN mu m"""),
        ("c0", "SELECT sqrt(avg(e * e)) AS best0 FROM xs"),
    ]
    for i in range(len(FLAGS)):
        kept = " + ".join([f"CASE WHEN p.inc{j} THEN xs.x{j} ELSE 0.0 END" for j in range(i)] or ["0.0"])
        c += [
            (f"c{i + 1}a", f"""SELECT p.*, (SELECT sqrt(avg(power(xs.e - ({kept}) - xs.x{i}, 2))) FROM xs) AS cand{i}
                FROM c{i} p"""),
            (f"c{i + 1}", f"""SELECT *, cand{i} < best{i} AS inc{i},
                CASE WHEN cand{i} < best{i} THEN cand{i} ELSE best{i} END AS best{i + 1} FROM c{i + 1}a"""),
        ]
    last = f"c{len(FLAGS)}"
    sel_terms = " + ".join(
        f"CASE WHEN c.inc{k} THEN {_flag_term(f, 'fs', 'g.lambda')} ELSE 0.0 END" for k, (f, _p) in enumerate(FLAGS))
    c += [
        ("sel", f"SELECT * FROM {last}"),
        ("grid2", f"SELECT CAST({F0!r} AS DOUBLE) + i * CAST({FSTEP!r} AS DOUBLE) AS lambda FROM range({NF}) g(i)"),
        ("fsweep", f"""SELECT g.lambda, sqrt(avg(power(t.rating - (m.mu + t.b_i + t.b_u + {sel_terms}), 2))) AS rmse
            FROM tscored t JOIN fstats fs ON fs.userId = t.userId CROSS JOIN grid2 g CROSS JOIN mu m
                 CROSS JOIN sel c GROUP BY g.lambda"""),
        ("fbest", "SELECT lambda AS lf, rmse FROM fsweep ORDER BY rmse, lambda LIMIT 1"),
        ("kept", "SELECT concat_ws(',', " + ", ".join(
            f"CASE WHEN inc{k} THEN '{f}' END" for k, (f, _p) in enumerate(FLAGS)) + ") AS flags FROM sel"),
    ]
    return c


_CTES = _ctes()
_NAMES = [n for n, _ in _CTES]


def _with(final: str, upto: str) -> str:
    """All CTEs up to and including ``upto`` (unreferenced ones are not run)."""
    k = _NAMES.index(upto) + 1
    # MATERIALIZED: each stage is computed once, not re-inlined per reference
    body = ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in _CTES[:k])
    # `lambda` is a keyword in DuckDB: quote the column name everywhere
    return re.sub(r"\blambda\b", '"lambda"', f"WITH {body}\n{final}")


def _scored(src: str, lam: str) -> str:
    """Rows of ``src`` with the final model's prediction at flag lambda ``lam``."""
    terms = " + ".join(
        f"CASE WHEN c.inc{k} THEN {_flag_term(f, 'fs', lam)} ELSE 0.0 END" for k, (f, _p) in enumerate(FLAGS))
    return f"""SELECT v.*, m.mu + bi.b_i + bu.b_u + {terms} AS pred
        FROM {src} v LEFT JOIN bi ON bi.movieId = v.movieId LEFT JOIN bu ON bu.userId = v.userId
             LEFT JOIN fstats fs ON fs.userId = v.userId CROSS JOIN mu m CROSS JOIN sel c CROSS JOIN fbest fb"""


RATING_COLS = "userId, movieId, rating, timestamp"
FLAG_NAMES = ", ".join(f for f, _p in FLAGS)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ratings_fact"] = _with(f"SELECT {RATING_COLS}, title, genres FROM facts", "facts")
    q["genre_flags"] = _with(f"SELECT {RATING_COLS}, {FLAG_NAMES} FROM flagged", "flagged")
    q["preview_head"] = _with(
        f"SELECT {RATING_COLS}, {FLAG_NAMES} FROM flagged ORDER BY userId, movieId, timestamp, {TIE} LIMIT 6",
        "flagged")
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)"
                       for c in ["userId", "movieId", "rating", "timestamp"] + [f for f, _p in FLAGS])
    q["null_cells"] = _with(f"SELECT CAST({nulls} AS BIGINT) AS n_null FROM flagged", "flagged")
    q["null_cells_by_column"] = _with(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM flagged"
        for c in ["userId", "movieId", "rating", "timestamp"] + [f for f, _p in FLAGS]), "flagged")
    q["rating_strata"] = _with("""SELECT CAST(s.stratum AS INTEGER) AS stratum, b.b[s.stratum] AS lower,
            b.b[s.stratum + 1] AS upper, count(*) AS n_rows, count(*) FILTER (WHERE s.sampled) AS n_sampled
        FROM samp1 s CROSS JOIN brk1 b WHERE s.stratum IS NOT NULL GROUP BY s.stratum, b.b""", "samp1")
    q["stratified_holdout"] = _with(
        f"SELECT {RATING_COLS}, l_orderkey, l_linenumber FROM samp1 WHERE sampled", "samp1")
    q["leak_free_train"] = _with(
        f"SELECT {RATING_COLS}, l_orderkey, l_linenumber FROM role1 WHERE role1 = 'pool'", "role1")
    q["leak_free_validation"] = _with(
        f"SELECT {RATING_COLS}, l_orderkey, l_linenumber FROM role1 WHERE role1 = 'validation'", "role1")
    q["train_test_split"] = _with(
        f"SELECT {RATING_COLS}, l_orderkey, l_linenumber, role FROM split WHERE role <> 'validation'", "split")
    q["row_counts"] = _with("SELECT role, count(*) AS n_rows FROM split GROUP BY role", "split")
    q["global_mean"] = _with("SELECT round(avg(rating), 6) AS mu, count(*) AS n_rows FROM train", "train")
    q["item_effect"] = _with("SELECT movieId, round(b_i, 6) AS b_i, n_i FROM bi", "bi")
    q["user_effect"] = _with("SELECT userId, round(b_u, 6) AS b_u, m_u FROM bu", "bu")
    q["bias_predictions"] = _with("""SELECT t.userId, t.movieId, t.rating, t.l_orderkey, t.l_linenumber,
            round(m.mu + t.b_i + t.b_u, 6) AS pred FROM tscored t CROSS JOIN mu m""", "tscored")
    q["bias_rmse"] = _with("""SELECT round(CASE WHEN count(*) = count(pred) AND count(*) > 0
                THEN sqrt(avg(power(rating - pred, 2))) END, 6) AS rmse,
            count(*) AS n_rows, count(*) - count(pred) AS n_null_pred, max(lb) AS lambda
        FROM (SELECT t.rating, m.mu + t.b_i + t.b_u AS pred, b.lb FROM tscored t CROSS JOIN mu m CROSS JOIN bbest b)""",
                           "tscored")
    q["bias_lambda_sweep"] = _with("SELECT lambda, round(rmse, 6) AS rmse FROM bsweep", "bsweep")
    q["best_bias_lambda"] = _with("SELECT lb AS lambda, round(rmse, 6) AS rmse FROM bbest", "bbest")
    q["bias_residuals"] = _with("""SELECT userId, movieId, rating, l_orderkey, l_linenumber, round(b_i, 6) AS b_i,
            round(b_u, 6) AS b_u, round(resid, 6) AS resid FROM tresid""", "tresid")
    long_ = " UNION ALL ".join(f"SELECT '{f}' AS flag, {f} AS level, resid AS value FROM tresid" for f, _p in FLAGS)
    q["flag_boxstats"] = _with(f"""SELECT flag, level, count(*) AS n, round(q1, 6) AS q1, round(median, 6) AS median,
            round(q3, 6) AS q3,
            round(min(value) FILTER (WHERE value >= lo AND value <= hi), 6) AS whisker_low,
            round(max(value) FILTER (WHERE value >= lo AND value <= hi), 6) AS whisker_high,
            count(*) FILTER (WHERE NOT (value >= lo AND value <= hi)) AS n_outliers
        FROM (SELECT l.*, q.q1, q.median, q.q3, q.q1 - 1.5 * (q.q3 - q.q1) AS lo, q.q3 + 1.5 * (q.q3 - q.q1) AS hi
              FROM lng l JOIN (SELECT flag, level, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                                      quantile_cont(value, 0.75) AS q3 FROM lng GROUP BY flag, level) q
                   USING (flag, level))
        GROUP BY flag, level, q1, median, q3""", "tresid").replace(
        "\nSELECT flag, level, count(*) AS n",
        f",\nlng AS MATERIALIZED (SELECT * FROM ({long_}) WHERE level IS NOT NULL AND value IS NOT NULL)\n"
        "SELECT flag, level, count(*) AS n", 1)
    q["flag_outliers"] = _with(f"""SELECT flag, level, round(value, 6) AS resid FROM lng JOIN (
              SELECT flag, level, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM lng GROUP BY flag, level) q
            USING (flag, level) WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""", "tresid").replace(
        "\nSELECT flag, level, round(value",
        f",\nlng AS MATERIALIZED (SELECT * FROM ({long_}) WHERE level IS NOT NULL AND value IS NOT NULL)\n"
        "SELECT flag, level, round(value", 1)
    eff_out = ", ".join(f"round({f}_down, 6) AS {f}_down, round({f}_up, 6) AS {f}_up" for f, _p in FLAGS)
    q["user_flag_effects"] = _with(f"SELECT userId, {eff_out} FROM eff30", "eff30")
    q["forward_selection"] = _with(" UNION ALL ".join(
        f"""SELECT CAST({i + 1} AS INTEGER) AS step, '{f}' AS flag, round(cand{i}, 6) AS rmse,
            CASE WHEN inc{i} THEN 'include' ELSE 'reject' END AS decision,
            concat_ws(',', {', '.join(f"CASE WHEN inc{j} THEN '{g}' END" for j, (g, _p) in enumerate(FLAGS[:i + 1]))}) AS kept
            FROM sel""" for i, (f, _p) in enumerate(FLAGS)), "sel")
    q["flag_lambda_sweep"] = _with("SELECT lambda, round(rmse, 6) AS rmse FROM fsweep", "fsweep")
    q["best_flag_lambda"] = _with("SELECT lf AS lambda, round(rmse, 6) AS rmse FROM fbest", "fbest")
    q["flag_predictions"] = _with(f"""SELECT userId, movieId, rating, l_orderkey, l_linenumber, round(pred, 6) AS pred
        FROM ({_scored('tscored', 'fb.lf')})""", "kept")
    q["placed_flag_predictions"] = q["flag_predictions"]
    q["final_score"] = _with(f"""SELECT round(CASE WHEN count(*) = count(pred) AND count(*) > 0
                THEN sqrt(avg(power(rating - pred, 2))) END, 6) AS rmse,
            count(*) AS n_rows, count(*) - count(pred) AS n_null_pred,
            (SELECT lb FROM bbest) AS bias_lambda, (SELECT lf FROM fbest) AS flag_lambda,
            (SELECT flags FROM kept) AS flags
        FROM ({_scored('validation', 'fb.lf')})""", "kept")
    nflags = len(FLAGS)
    ledger = [f"""SELECT CAST(0 AS INTEGER) AS step, 'bias λ=' || printf('%g', lb) AS model,
            round(rmse, 6) AS rmse, CAST(NULL AS DOUBLE) AS delta, 'baseline' AS decision FROM bbest"""]
    ledger += [f"""SELECT CAST({i + 1} AS INTEGER), '+{f}', round(cand{i}, 6), round(cand{i} - best{i}, 6),
            CASE WHEN inc{i} THEN 'include' ELSE 'reject' END FROM sel""" for i, (f, _p) in enumerate(FLAGS)]
    ledger += [f"""SELECT CAST({nflags + 1} AS INTEGER), 'flags λ=' || printf('%g', fb.lf), round(fb.rmse, 6),
            round(fb.rmse - c.best{nflags}, 6), 'tuned' FROM fbest fb CROSS JOIN sel c""",
               f"""SELECT CAST({nflags + 2} AS INTEGER), 'validation',
            round(CASE WHEN count(*) = count(pred) AND count(*) > 0 THEN sqrt(avg(power(rating - pred, 2))) END, 6),
            CAST(NULL AS DOUBLE), 'final' FROM ({_scored('validation', 'fb.lf')})"""]
    q["model_ledger"] = _with(" UNION ALL ".join(ledger), "kept")
    q["read_ratings_text"] = _with(f"""SELECT CAST(userId AS BIGINT) AS userId, CAST(movieId AS BIGINT) AS movieId,
            rating, timestamp FROM ratings""", "ratings")
    q["read_movies_text"] = _with(
        "SELECT CAST(movieId AS BIGINT) AS movieId, title, genres FROM items", "items")
    return q | edge_cases.oracle_sql(_with)
