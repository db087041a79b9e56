"""Print the physical plans of the main operators and a one-line summary of
each (exchanges, partial limits/aggregates, broadcasts, pushed filters).

    python tools/show_plans.py [sf_dir] [--full]

Plans are the final AQE plans after one execution (noop sink), over a raw
history written as Parquet and the marts written by ``materialize``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimtide.operators import quality as Q  # noqa: E402
from claimtide.operators import review as R  # noqa: E402
from claimtide.operators.periods import MONTHLY, WEEKLY, current_claims, weekly_state  # noqa: E402
from claimtide.plans.build import build, materialize  # noqa: E402
from claimtide.schemas import MART_TABLES  # noqa: E402
from claimtide.session import local_session, scratch_path  # noqa: E402
from claimtide.sources import tables  # noqa: E402
from claimtide.sources.history import read_history  # noqa: E402
from claimtide.sources.seeds import currency_rates  # noqa: E402
from claimtide.sources.testdata import testdata_history  # noqa: E402


PUSHED = re.compile(r"PushedFilters: \[([^\]]*)\]")


def formatted(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def summary(plan: str, formatted_plan: str) -> str:
    exchanges = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition|Exchange REBALANCE|ShuffleQueryStage", plan))
    return (
        f"shuffles={len(re.findall(r'ShuffleQueryStage', plan)) or exchanges} "
        f"broadcasts={len(re.findall(r'BroadcastQueryStage|BroadcastExchange', plan))} "
        f"partial_limits={len(re.findall(r'WindowGroupLimit.*Partial', plan))} "
        f"partial_aggs={len(re.findall(r'partial_', plan))} "
        f"smj={plan.count('SortMergeJoin')} bhj={plan.count('BroadcastHashJoin')} "
        f"pushed={sorted(set(p for p in PUSHED.findall(formatted_plan) if p))[:3]}"
    )


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    full = "--full" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.maxToStringFields", "1000")
    raw_path = scratch_path(spark, "raw_history")
    testdata_history(spark, sf_dir).write.parquet(raw_path)
    raw = read_history(spark, raw_path)
    rates = currency_rates(spark)
    base = scratch_path(spark, "warehouse")
    materialize(spark, raw, rates, base)
    names = dict(MART_TABLES)
    mart = lambda key: tables.read_mart(spark, base, names[key])
    classified = tables.read_table(spark, tables.layer_path(base, tables.INTERMEDIATE, "int_claims_classified"))
    graph = build(raw, rates)
    result = R.period_review(mart("weekly_metrics"), WEEKLY, "claim_value_usd", countries=["US"])
    dq_tables = {Q.SOURCE: raw, Q.CLASSIFIED: classified, **{k: mart(k) for k in names}}
    cases = {
        "classified (raw parquet -> classify)": graph["classified"],
        "weekly (lazy, from raw)": graph["weekly"],
        "weekly (from written classified)": weekly_state(classified),
        "current (from written classified)": current_claims(classified),
        "weekly_metrics (lazy, from raw)": graph["weekly_metrics"],
        "monthly_metrics (from written monthly)": R.apply_review_filters(mart("monthly_metrics")),
        "hierarchy (weekly, value)": R.hierarchy_values(mart("weekly_metrics"), WEEKLY, "claim_value_usd"),
        "review pivot (weekly, value, US)": result.pivot,
        "kpi cards": R.kpi_cards(mart("weekly_metrics")),
        "month-pruned read": tables.read_month_range(
            spark, tables.layer_path(base, tables.MARTS, names["weekly"]), "week_end_date", "1996-03-15", "1996-06-30"
        ),
        "period dimension (monthly)": R.period_dimension(mart("monthly_metrics"), MONTHLY),
        "data quality (37 checks)": Q.run_checks(dq_tables),
    }
    for label, df in cases.items():
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        text = formatted(df)
        print(f"== {label}: {summary(plan, text)}")
        if full:
            print(text)


if __name__ == "__main__":
    main()
