"""End-to-end rating analysis as staged Spark jobs.

Stages (each computed once, on first use):

    work        facts + one INT column per tag flag + the samples' order keys;
                written once as a parquet table
    split       every row with its role: train / test / dropped / validation
                (exact stratified hold-out with orphans returned, then an
                exact stratified train/test split with orphans dropped);
                written once as a parquet table
    mu, item_stats, bias_sweep, best_bias_lambda, bias_model
    flag_stats  user-by-flag residual sums and counts, all flags in one pass
    selection   greedy screening from one Gram aggregate
    flag_sweep, best_flag_lambda
    final       validation rows with keys known to train, scored

Parameters are the published analysis's fixed values unless overridden.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from biasfit import schemas as S
from biasfit.functions.flags import add_flags
from biasfit.functions.hashing import hash_prefix_number, order_hash
from biasfit.functions.metrics import rmse_columns
from biasfit.operators.copartition import Placement
from biasfit.operators.bitmaps import MAX_BITS, layouts, segments, with_bits
from biasfit.operators.diagnostics import boxplot_outliers, boxplot_stats
from biasfit.operators.effects import (USER, ITEM, attach_bias, fit_bias, item_stats,
                                       predict_bias, predict_flags, residuals, user_flag_effects,
                                       user_flag_stats, with_residual)
from biasfit.operators.joins import DEFAULT_POLICY, JoinPolicy, key_counts
from biasfit.operators.sampling import (ROW_ID, SampleInput, TiesNeeded, assign_holdout_roles, exact_stratified_sample, mark_known,
                                        prepare, semi_join_keys)
from biasfit.operators.select import Selection, forward_select
from biasfit.operators.sweep import best_lambda, sweep_bias, sweep_flags
from biasfit.plans.stages import Files, Stages
from biasfit.session import materialize, shuffles_removed


ROLES = ("train", "test", "validation", "dropped")


@dataclass
class PipelineConfig:
    flags: dict[str, str] = field(default_factory=lambda: dict(S.GENRE_FLAGS))
    screen_order: Sequence[str] | None = None          # default: all flags in map order
    p: float = S.HOLDOUT_FRACTION
    seeds: tuple[str, str] = ("1", "2")
    groups: int = S.QUANTILE_GROUPS
    bias_grid: Sequence[float] = field(default_factory=lambda: S.grid_values(S.BIAS_LAMBDA_GRID))
    flag_grid: Sequence[float] = field(default_factory=lambda: S.grid_values(S.FLAG_LAMBDA_GRID))
    screen_lambda: float = S.SCREEN_LAMBDA
    key_cols: Sequence[str] = (USER, ITEM, "timestamp")
    tie_cols: Sequence[str] = (USER, ITEM, "timestamp", "rating")
    keep_cols: Sequence[str] | None = None   # identity columns to keep after the split
    materialize: str = "table"             # the final split (and hold-out marks, if joined): written tables
    policy: JoinPolicy = field(default_factory=lambda: DEFAULT_POLICY)
    max_bits: int = MAX_BITS               # of a key bitmap
    user_buckets: int | None = None        # lay facts and users' statistics out by user, in so many buckets

    @property
    def screen(self) -> list[str]:
        return list(self.screen_order) if self.screen_order else list(self.flags)


class RatingsPipeline:
    """``stages`` keeps the written tables, so that a run can be taken up again."""

    def __init__(self, spark: SparkSession, facts: DataFrame, cfg: PipelineConfig | None = None, stages: Stages | None = None):
        self.spark = spark
        self.facts = facts
        self.cfg = cfg or PipelineConfig()
        self.stages = stages
        self._late_ties = True
        if stages is not None and self.cfg.user_buckets:
            raise ValueError("stages publish plain files: they can't be laid out by user")

    @cached_property
    def layout(self) -> Placement | None:
        c = self.cfg
        return Placement(self.work, USER, c.user_buckets, c.policy) if c.user_buckets else None

    def _stage(self, name: str, make: Callable[[Callable], dict]) -> tuple[DataFrame, dict]:
        """A written table and what was observed of it; kept if the run has stages."""
        if self.stages is not None:
            return self.stages.run(name, make)
        kept: list[DataFrame] = []

        def write(df: DataFrame, partition_by: list[str] | None = None) -> None:
            if self.layout is not None:
                kept.append(self.layout.write(df, name, partition_by or ()))
            else:
                kept.append(materialize(df, self.cfg.materialize, name, partition_by=partition_by, lean=True))

        info = make(write)
        return kept[0], info

    # ---------------------------------------------------------------- data
    @cached_property
    def prepared(self) -> SampleInput:
        """Facts, flags and the order keys of both samples, written once: every
        pass of the sampler reads the two or three narrow columns it needs.

        Columns that only break ties between rows of one order key are neither
        moved nor written unless a sample turns out to need them."""
        c = self.cfg
        hashes = {f"_h{i}": hash_prefix_number(order_hash(s, c.key_cols)) for i, s in enumerate(c.seeds)}
        facts, name = add_flags(self.facts, c.flags), "facts_ties"
        if self._late_ties:
            facts, name = facts.drop(*self.only_ties), "facts"
        return prepare(facts, name, "rating", hashes, groups=c.groups, keys=(ITEM, USER), stage=self.stages and self.stages.run)

    @property
    def only_ties(self) -> list[str]:
        """Columns that are read for nothing but the order of rows with one order key."""
        c = self.cfg
        read = {*(c.tie_cols if c.keep_cols is None else c.keep_cols), *c.key_cols, *c.flags, USER, ITEM, "rating"}
        return [x for x in c.tie_cols if x not in read]

    @property
    def work(self) -> DataFrame:
        return self.prepared.df

    @cached_property
    def _split(self) -> tuple[DataFrame, dict]:
        return self._stage("split", self._make_split)

    def _make_split(self, write: Callable) -> dict:
        """Write the split; return what was observed meanwhile.

        Whether a sampled row's keys are known is read from key bitmaps.  Where
        the keys' ranges allow exact ones, no row is shuffled; else the rows
        that they leave open are joined.  Nothing is kept on executors."""
        try:
            out = self._roles()
        except TiesNeeded:
            self._late_ties = False
            del self.__dict__["prepared"]
            out = self._roles()
        seen = Observation("biasfit-split")
        train = F.col("role") == "train"
        rating = F.when(train, F.col("rating"))
        out = out.observe(seen, F.avg(rating).alias("mu"), F.count(rating).alias("k"),
                          *[F.count(F.when(F.col("role") == r, 1)).alias(r) for r in ROLES],
                          *[F.count(F.when(F.col(k).isNull(), 1)).alias(f"null_{k}") for k in (USER, ITEM)])
        # partitioned by role: reading test or validation skips the train files
        if self.layout is not None:
            write(self.layout.place(out), partition_by=["role"])
        else:
            write(out, partition_by=["role"])
        return dict(seen.get)

    def _roles(self) -> DataFrame:
        """The facts with the columns kept and ``role``."""
        c, w = self.cfg, self.prepared
        n = w.n_rows   # bounds every later fact side: enables hot-key salting
        sample = dict(groups=c.groups, row_id=ROW_ID, bounds=w.bounds, total=n, late_ties=self._late_ties)
        known = dict(total=n, policy=c.policy, max_bits=c.max_bits, extents=w.extents)
        s1 = exact_stratified_sample(w.df, "rating", c.p, c.seeds[0], c.key_cols, c.tie_cols, flag="_s1", hash_col="_h0", **sample)
        layout = layouts(w.extents, w.df.schema, c.max_bits)
        second = dict(flag="_s2", hash_col="_h1", **sample)
        if all(x.exact for x in layout.values()):
            # bits decide: one scan gives every row its role
            bits = materialize(segments(s1.where(~F.col("_s1")), layout), "table", "bitmaps", lean=True)
            held = F.col("_s1") & F.col("_k1")
            s2 = exact_stratified_sample(with_bits(s1, bits, layout, "_k1"), "rating", c.p, c.seeds[1], c.key_cols, c.tie_cols,
                                         eligible=~held, **second)
            out = with_bits(s2, segments(s2.where(~held & ~F.col("_s2")), layout), layout, "_k2")
            out = out.withColumn("role", F.when(held, "validation").when(~F.col("_s2"), "train").when(F.col("_k2"), "test")
                                 .otherwise("dropped")).drop("_s1", "_k1", "_s2", "_k2")
        else:
            # rows that bitmaps leave open are joined: about p of the rows, written for the second sample's pass
            rest = s1.where(~F.col("_s1")).drop("_s1")
            marked = materialize(mark_known(s1.where("_s1").drop("_s1"), rest, **known).hint("rebalance"), c.materialize, "holdout", lean=True)
            pool = rest.unionByName(marked.where(~F.col("_known")).drop("_known"))
            s2 = exact_stratified_sample(pool, "rating", c.p, c.seeds[1], c.key_cols, c.tie_cols, **second)
            roles = assign_holdout_roles(s2, "_s2", orphan="drop", held_role="test", rest_role="train", role="role", **known)
            out = roles.drop("_s2").unionByName(marked.where("_known").drop("_known").withColumn("role", F.lit("validation")))
        return out.select(*c.keep_cols, "role") if c.keep_cols is not None else out.drop("_h0", "_h1", *ROW_ID)

    @property
    def split(self) -> DataFrame:
        return self._split[0]

    @property
    def role_counts(self) -> dict[str, int]:
        """Rows of each role that has any."""
        return {r: self._split[1][r] for r in ROLES if self._split[1][r]}

    def release(self) -> None:
        """Unpersist the cached statistics tables of this analysis."""
        for name in ("item_stats", "user_counts", "flag_stats"):
            if name in self.__dict__:
                self.__dict__[name].unpersist()
        if "bias_model" in self.__dict__:
            self.__dict__["bias_model"].users.unpersist()
        if self.__dict__.get("layout") is not None:
            self.layout.release()

    def part(self, role: str) -> DataFrame:
        return self.split.where(F.col("role") == role).drop("role")

    @property
    def train(self) -> DataFrame:
        return self.part("train")

    @property
    def test(self) -> DataFrame:
        return self.part("test")

    @property
    def validation(self) -> DataFrame:
        """Hold-out rows whose user and item are both known to *train*."""
        return semi_join_keys(self.part("validation"), self.train, total=self.n_train, policy=self.cfg.policy,
                              counts={ITEM: self.item_stats, USER: self.user_counts}, max_bits=self.cfg.max_bits,
                              extents=self.prepared.extents)

    # --------------------------------------------------------------- biases
    @property
    def mu(self) -> float | None:
        """Observed on the split's write; None if a rating of train is missing."""
        seen = self._split[1]
        return seen["mu"] if seen["k"] == seen["train"] else None

    @property
    def n_train(self) -> int:
        return self._split[1]["train"]

    @cached_property
    def item_stats(self) -> DataFrame:
        return item_stats(self.train, self.mu).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def user_counts(self) -> DataFrame:
        """Train rows per user: the hot users of every later join, and the known ones."""
        return key_counts(self.train, USER).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def policy(self) -> JoinPolicy:
        """The configured policy, with the keys that need neither salt nor care for
        NULLs: by the split's NULL counts, and as none has a bucket's rows in train."""
        c, seen = self.cfg.policy, self._split[1]
        most = {USER: (self.user_counts, "_n"), ITEM: (self.item_stats, "n_i")}
        plain = [k for k, (stats, n) in most.items()
                 if not seen[f"null_{k}"] and (stats.agg(F.max(n)).first()[0] or 0) < c.rows_per_bucket]
        return replace(c, plain=frozenset(plain))

    @cached_property
    def bias_sweep(self) -> DataFrame:
        return sweep_bias(self.train, self.test, self.cfg.bias_grid, self.mu, stats=self.item_stats,
                          user_counts=self.user_counts, total=self.n_train, policy=self.policy)

    @cached_property
    def best_bias(self) -> tuple[float, float]:
        with shuffles_removed(self.spark):
            r = best_lambda(self.bias_sweep).first()
        if r["lambda"] is None:
            raise ValueError("no lambda has an RMSE: a rating is NULL or a test row has no prediction")
        return float(r["lambda"]), r["rmse"]

    @cached_property
    def bias_model(self):
        m = fit_bias(self.train, self.best_bias[0], self.mu, items_stats=self.item_stats, total=self.n_train,
                     policy=self.policy)
        # written: a persisted table would keep the shuffles of all train rows that made it
        m.users = materialize(m.users, self.cfg.materialize, "users", lean=True)
        return m

    def _placed(self, name: str, stats: DataFrame) -> DataFrame:
        """Users' statistics beside the facts, if these are laid out by user."""
        return stats if self.layout is None else self.layout.write(self.layout.copies(stats), name)

    @cached_property
    def joined_model(self):
        """The model as joins with facts read it."""
        return replace(self.bias_model, users=self._placed("users", self.bias_model.users))

    @cached_property
    def joined_flag_stats(self) -> DataFrame:
        return self._placed("flag_stats", self.flag_stats)

    def _flags_of(self, df: DataFrame) -> list[str]:
        return [f for f in self.cfg.flags if f in df.columns]

    def attach(self, df: DataFrame) -> DataFrame:
        return attach_bias(df, self.joined_model, self.policy, self.n_train, self._flags_of(df))

    def predictions(self, df: DataFrame) -> DataFrame:
        return predict_bias(df, self.joined_model, policy=self.policy, total=self.n_train)

    @cached_property
    def test_scored(self) -> DataFrame:
        """Test rows + ``b_i, b_u`` at the tuned bias lambda; written once, as the
        selection, the flag sweep and the predictions read them."""
        out = self.attach(self.test)
        return materialize(out, self.cfg.materialize, "scored", lean=True) if self.layout is None else self.layout.write(out, "scored")

    @cached_property
    def train_residuals(self) -> DataFrame:
        """Written once: the flag sums and the box plots read it many times.  The
        residual itself is not stored, it follows from the columns that are."""
        def make(write: Callable) -> dict:
            write(residuals(self.train, self.joined_model, self.policy, self.n_train, self._flags_of(self.train)).drop("resid"))
            return {}

        return with_residual(self._stage("residuals", make)[0], self.mu)

    @property
    def _residual_rows(self) -> DataFrame:
        """For a single pass: the written residuals if there are any, or are to be
        (stages, a layout by user); else the rows as the join with users leaves
        them (which isn't broadcast for that), side by side by user, and of the
        columns that are read only."""
        if self.stages is not None or self.layout is not None or "train_residuals" in self.__dict__:
            return self.train_residuals
        model = replace(self.joined_model, users=self.joined_model.users.hint("merge"))
        return residuals(self.train, model, self.policy, self.n_train, self._flags_of(self.train))

    # ---------------------------------------------------------------- flags
    @cached_property
    def flag_stats(self) -> DataFrame:
        return user_flag_stats(self._residual_rows, self.cfg.screen).persist(StorageLevel.MEMORY_AND_DISK)

    def flag_effects(self, lam: float, flags: Sequence[str] | None = None) -> DataFrame:
        return user_flag_effects(self.flag_stats, flags or self.cfg.screen, lam)

    def flag_predictions(self, df_with_bias: DataFrame, flags: Sequence[str], lam: float) -> DataFrame:
        return predict_flags(df_with_bias, self.mu, user_flag_effects(self.joined_flag_stats, flags, lam), flags,
                             policy=self.policy, total=self.n_train)

    @cached_property
    def selection(self) -> Selection:
        flags = self.cfg.screen
        return forward_select(self.test_scored, flags, self.mu, user_flag_effects(self.joined_flag_stats, flags, self.cfg.screen_lambda),
                              total=self.n_train, policy=self.policy)

    @cached_property
    def flag_sweep(self) -> DataFrame:
        return sweep_flags(self.test_scored, self.joined_flag_stats, self.selection.kept, self.cfg.flag_grid, self.mu,
                           total=self.n_train, policy=self.policy)

    @cached_property
    def best_flag(self) -> tuple[float, float]:
        with shuffles_removed(self.spark):
            r = best_lambda(self.flag_sweep).first()
        if r["lambda"] is None:
            raise ValueError("no lambda has an RMSE: a test row lacks a flag or a prediction")
        return float(r["lambda"]), r["rmse"]

    # ---------------------------------------------------------------- final
    @cached_property
    def final_predictions(self) -> DataFrame:
        v = self.attach(self.validation)
        return self.flag_predictions(v, self.selection.kept, self.best_flag[0])

    def final_score(self) -> DataFrame:
        lb, lf = self.best_bias[0], self.best_flag[0]
        return self.final_predictions.agg(*rmse_columns()).select(
            "rmse", "n_rows", "n_null_pred",
            F.lit(lb).alias("bias_lambda"), F.lit(lf).alias("flag_lambda"),
            F.lit(",".join(self.selection.kept)).alias("flags"))

    def ledger(self) -> DataFrame:
        """Every reported RMSE with its model and decision (one row each)."""
        rows = []
        lb, bias_rmse = self.best_bias
        rows.append((0, f"bias λ={lb:g}", float(bias_rmse), None, "baseline"))
        best = bias_rmse
        for s in self.selection.steps:
            rows.append((s["step"], f"+{s['flag']}", float(s["rmse"]), float(s["rmse"] - best), s["decision"]))
            if s["decision"] == "include":
                best = s["rmse"]
        lf, flag_rmse = self.best_flag
        k = len(rows)
        rows.append((k, f"flags λ={lf:g}", float(flag_rmse), float(flag_rmse - best), "tuned"))
        with shuffles_removed(self.spark):
            fin = self.final_score().first()
        rows.append((k + 1, "validation", fin["rmse"], None, "final"))
        return self.spark.createDataFrame(rows, "step INT, model STRING, rmse DOUBLE, delta DOUBLE, decision STRING")

    def write_reports(self, path: str) -> dict[str, str]:
        """Write the tables behind the analysis's plots and printouts as Parquet.

        ``bias_sweep`` / ``flag_sweep`` (lambda, rmse): the tuning curves;
        ``flag_boxstats`` and ``flag_outliers``: the residual box plots per
        flag; ``ledger``: every reported RMSE with its decision.  Each goes to a
        folder of its own; ``manifest.json`` names them and is published last,
        so readers see the reports of one run whole, or those before it."""
        stats = boxplot_stats(self.train_residuals, self.cfg.screen, "resid")
        out = {
            "bias_sweep": self.bias_sweep,
            "flag_sweep": self.flag_sweep,
            "flag_boxstats": stats,
            "flag_outliers": boxplot_outliers(self.train_residuals, stats, self.cfg.screen, "resid"),
            "ledger": self.ledger(),
        }
        run = uuid.uuid4().hex[:12]
        paths = {name: f"{path.rstrip('/')}/{name}-{run}" for name in out}
        for name, df in out.items():
            df.write.parquet(paths[name])
        files = Files(self.spark)
        before = files.read(f"{path}/manifest.json")
        files.publish(f"{path}/manifest.json", json.dumps(paths))
        for old in (json.loads(before).values() if before else ()):
            files.delete(old)
        return paths
