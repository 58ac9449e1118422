"""Admission of rows to a table: log what is rejected, record the run, halt above the limit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline.operators import quality as q
from shelfline.operators.reasons import monitoring_row
from shelfline.session import settle
from shelfline.sources import sinks


def _settled(df: DataFrame, rules: Sequence[q.Rule], label: str) -> tuple[DataFrame, int, int]:
    """The tagged rows, stored, with their number and the number rejected: both observed on the write itself."""
    seen = Observation()
    tagged = settle(q.tag(df, rules).observe(seen, F.count(F.lit(1)).alias("rows"), F.count(q.FAILED).alias("rejected")), label)
    return tagged, seen.get["rows"], seen.get["rejected"]


def admit(config: dict, raw: DataFrame, input_rules: Sequence[q.Rule], shape: Callable[[DataFrame], DataFrame] | None,
          output_rules: Sequence[q.Rule], source: str, target: str, run_ts: str, run_id: str) -> DataFrame:
    """Rows of ``raw`` that pass the input rules, are shaped, and pass the output rules.

    The rules of each step are evaluated once and settled, one action a step: the counts, the
    reject log and the published rows all come from there. Whatever a rule rejects is in the
    log; the limit of the table is enforced before anything is published. Monitoring row and
    log entries lie under the run and the table they belong to, so a run done again replaces them.
    """
    silver = config["tables"]["silver"]
    tagged, read, rejected = _settled(raw, input_rules, f"in-{target}")
    steps = [(tagged, input_rules, rejected)]
    clean = q.clean_rows(tagged)
    if shape is not None:
        tagged, _, bad = _settled(shape(clean), output_rules, f"out-{target}")
        steps.append((tagged, output_rules, bad))
        rejected += bad
        clean = q.clean_rows(tagged)
    limit = c.HALT_LIMITS.get(target, config["thresholds"]["dq_fail_rate_pct"])
    of_run = F.concat_ws("-", F.lit("run"), F.lit(run_id), F.lit(target))
    fixed = raw.sparkSession.createDataFrame([(read, rejected)], "rows_read bigint, rows_rejected bigint")
    sinks.overwrite_partitions(monitoring_row(fixed, run_id, target, source, target, run_ts, run_ts, limit).withColumn("of_run", of_run),
                               silver["pipeline_monitoring"], ["of_run"])
    logs = [q.reject_log(t, rules, source, target, run_id, run_id, run_ts) for t, rules, bad in steps if bad]
    if logs:
        sinks.overwrite_partitions(reduce(DataFrame.unionByName, logs).withColumn("of_run", of_run), silver["dq_rejected_records"],
                                   ["rejection_date", "of_run"])
    q.enforce_limit(rejected, read, limit)
    return clean
