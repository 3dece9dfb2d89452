"""Write the physical plans of the key stages to PLANS.md.

    python tools/explain_plans.py [sf_dir]

For review: scans should show pruned ReadSchema, the sample should be a
filter with a broadcast of a local threshold table (no Window over the
data), aggregates should be partial + final, joins broadcast or salted.
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from biasfit.operators.sampling import exact_stratified_sample  # noqa: E402
from biasfit.operators.select import gram_frame  # noqa: E402
from biasfit.plans.catalog import analysis  # noqa: E402
from biasfit.session import get_session  # noqa: E402
from biasfit.sources.testdata import KEY_COLS, TIE_COLS  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    p = analysis(spark, sf_dir)
    sections = []
    sample = exact_stratified_sample(p.flagged, "rating", 0.1, "1", KEY_COLS, TIE_COLS).where("sampled")
    sections.append(("Exact stratified sample: a predicate against a broadcast threshold table", sample))
    sections.append(("Train rows read from the written split (column pruning, pushed filter)",
                     p.train.select("userId", "movieId", "rating")))
    sections.append(("Vectorised bias sweep (41 lambdas, one plan)", p.bias_sweep))
    sections.append(("User-by-flag statistics, all flags in one aggregate", p.flag_stats))
    flags = p.cfg.screen
    eff = p.flag_effects(p.cfg.screen_lambda, flags)
    sections.append(("Gram aggregate for forward selection",
                     gram_frame(p.test_scored.join(eff, "userId", "left"), flags, p.mu)))
    sections.append(("Final validation scoring", p.final_predictions))
    out = ["# Physical plans of the key stages", "",
           f"Generated by `tools/explain_plans.py {sf_dir}` (local[8]); AQE re-plans joins at run time.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", plan(df).strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print("wrote", path)


if __name__ == "__main__":
    main()
