"""Data-quality rules evaluated in one pass.

Rules are data. Row rules compile to predicates; all predicates between two
uniqueness rules collapse into a single "first failed rule" expression, so a
rule list costs one scan instead of one per rule. Rule order has sequential
meaning: a row rejected by an earlier error rule is not seen by later ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import surrogate_key
from shelfline.operators.dedup import mark_repeats
from shelfline.session import settle as stored

FAILED = "_dq_failed"
REASON = "_dq_failure_reason"
DEFAULT_LIMIT_PCT = 5.0


@dataclass(frozen=True)
class Rule:
    """One check. ``fails`` is a SQL predicate that is TRUE for bad rows."""

    kind: str
    severity: str = "warning"
    columns: tuple[str, ...] = ()
    fails: str | None = None
    rule_id: str | None = None
    reason: str = ""
    flag: str = ""
    reference: Any = field(default=None, compare=False)
    reference_column: str | None = None

    @property
    def blocks(self) -> bool:
        return self.severity == "error"


def _q(name: str) -> str:
    return f"`{name}`"


def _number(value: Any) -> str:
    return str(value) if isinstance(value, (int, float)) else f"'{value}'"


def not_null(columns: Sequence[str], severity: str = "error", flag: str | None = None,
             rule_id: str | None = None) -> Rule:
    return Rule("not_null", severity, tuple(columns),
                " OR ".join(f"{_q(c)} IS NULL" for c in columns), rule_id,
                f"null_in_columns:{','.join(columns)}", flag or f"_dq_null_{'_'.join(columns)}")


def unique(columns: Sequence[str], severity: str = "error", flag: str = "_dq_dup_flag",
           rule_id: str | None = None) -> Rule:
    return Rule("unique", severity, tuple(columns), None, rule_id,
                f"duplicate_key:{','.join(columns)}", flag)


def in_range(column: str, min_val: Any = None, max_val: Any = None, severity: str = "warning",
             flag: str | None = None, rule_id: str | None = None) -> Rule:
    """Inclusive bounds; NULL is out of range."""
    parts = [f"{_q(column)} IS NULL"]
    if min_val is not None:
        parts.append(f"{_q(column)} < {_number(min_val)}")
    if max_val is not None:
        parts.append(f"{_q(column)} > {_number(max_val)}")
    return Rule("range", severity, (column,), " OR ".join(parts), rule_id,
                f"out_of_range:{column}[{min_val},{max_val}]", flag or f"_dq_range_{column}")


def referential(column: str, reference: Any, severity: str = "warning", flag: str | None = None,
                reference_column: str | None = None, rule_id: str | None = None) -> Rule:
    """``reference`` is a DataFrame (joined) or a short literal collection."""
    return Rule("referential", severity, (column,), None, rule_id,
                f"referential_integrity:{column}", flag or f"_dq_ref_{column}",
                reference, reference_column or column)


def custom(fails: str, flag: str, severity: str = "warning", columns: Sequence[str] = (),
           rule_id: str | None = None, kind: str = "custom") -> Rule:
    return Rule(kind, severity, tuple(columns), fails, rule_id,
                f"custom_check_failed:{flag}", flag)


def _literal(value: str) -> str:
    """A SQL text literal; quotes and backslashes stay what they are."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(column: str, pattern: str, severity: str = "error", rule_id: str | None = None,
            optional: bool = False) -> Rule:
    """Text must match the pattern; NULL fails unless the column is optional."""
    missing = "false" if optional else "true"
    return Rule("format", severity, (column,),
                f"coalesce(NOT {_q(column)} RLIKE {_literal(pattern)}, {missing})", rule_id,
                f"bad_format:{column}", f"_dq_format_{column}")


def one_of(column: str, allowed: Iterable[str], severity: str = "error",
           rule_id: str | None = None, optional: bool = False) -> Rule:
    words = ", ".join(map(_literal, allowed))
    missing = "false" if optional else "true"
    return Rule("format", severity, (column,),
                f"coalesce({_q(column)} NOT IN ({words}), {missing})", rule_id,
                f"not_in_list:{column}", f"_dq_enum_{column}")


def holds(condition: str, column: str, severity: str = "error", rule_id: str | None = None,
          kind: str = "range") -> Rule:
    """``condition`` must be TRUE; an unknown condition passes."""
    return Rule(kind, severity, (column,), f"NOT ({condition})", rule_id,
                f"violates:{rule_id or column}", f"_dq_{(rule_id or column).replace('-', '_')}")


def from_dict(spec: dict) -> Rule | None:
    """Compile the dictionary form; an unknown type gives None."""
    severity = spec.get("severity", "warning")
    kind = spec.get("type")
    if kind == "not_null":
        return not_null(spec["columns"], severity, spec.get("flag_col"))
    if kind == "unique":
        return unique(spec["columns"], severity)
    if kind == "range":
        return in_range(spec["column"], spec.get("min_val"), spec.get("max_val"), severity,
                        spec.get("flag_col"))
    if kind == "referential":
        return referential(spec["fk_col"], spec["ref_values"], severity, spec.get("flag_col"),
                           spec.get("ref_col"))
    if kind == "custom":
        return custom(spec["condition_expr"], spec["flag_col"], severity)
    return None


def _reference_predicate(df: DataFrame, rule: Rule, slot: int) -> tuple[DataFrame, Column]:
    column = rule.columns[0]
    if not isinstance(rule.reference, DataFrame):
        return df, F.coalesce(~F.col(column).isin(list(rule.reference)), F.lit(False))
    found = f"_dq_found_{slot}"
    keys = (rule.reference.select(F.col(rule.reference_column).alias(column))
            .where(F.col(column).isNotNull()).distinct().withColumn(found, F.lit(True)))
    joined = df.join(keys, on=column, how="left")
    return joined, F.col(column).isNotNull() & F.col(found).isNull()


def tag(df: DataFrame, rules: Sequence[Rule | None], order: Sequence[Column] | None = None) -> DataFrame:
    """Add ``_dq_failed`` (position of the first failed error rule, or NULL) and one
    boolean column per warning rule. Every input row comes back once."""
    base = df.columns
    out = df.withColumn(FAILED, F.lit(None).cast("int"))
    pending: list[tuple[int, Column]] = []
    flags: list[str] = []
    ranked = False

    def settle(frame: DataFrame) -> DataFrame:
        if not pending:
            return frame
        first = F.coalesce(F.col(FAILED), *[F.when(p, F.lit(i)) for i, p in pending])
        pending.clear()
        return frame.withColumn(FAILED, first)

    for i, rule in enumerate(rules):
        if rule is None:
            continue
        if rule.kind == "unique":
            out = settle(out)
            if ranked:  # each such rule reads its input more than once
                out = stored(out, "tagged")
            ranked = True
            out = mark_repeats(out, rule.columns, order, "_dq_repeat", F.col(FAILED).isNull())
            predicate = F.col("_dq_repeat")
            if rule.blocks:
                out = out.withColumn(FAILED, F.coalesce(FAILED, F.when(predicate, F.lit(i))))
            else:
                out = out.withColumn(rule.flag, predicate)
                flags.append(rule.flag)
            out = out.drop("_dq_repeat")
            continue
        if rule.kind == "referential":
            out = settle(out)  # rows then carry one verdict to the join, not the columns of the rules before it
            out, predicate = _reference_predicate(out, rule, i)
        else:
            predicate = F.coalesce(F.expr(rule.fails), F.lit(False))
        if rule.blocks:
            pending.append((i, predicate))
        else:
            out = out.withColumn(rule.flag, predicate)
            flags.append(rule.flag)
    return settle(out).select(*base, *dict.fromkeys(flags), FAILED)


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(FAILED).isNull()).drop(FAILED)


def rejected_rows(tagged: DataFrame, rules: Sequence[Rule | None]) -> DataFrame:
    reasons = F.array(*[F.lit(r.reason if r else "") for r in rules])
    return (tagged.where(F.col(FAILED).isNotNull())
            .withColumn(REASON, F.try_element_at(reasons, F.col(FAILED) + 1)).drop(FAILED))


def failure_counts(tagged: DataFrame, rules: Sequence[Rule | None]) -> DataFrame:
    """One row: total rows and the count each rule caught, in one aggregate."""
    aggs = [F.count("*").alias("total")]
    for i, rule in enumerate(rules):
        if rule is None:
            hit = F.lit(False)
        elif rule.blocks:
            hit = F.col(FAILED) == i
        else:
            hit = F.col(rule.flag) & (F.col(FAILED).isNull() | (F.col(FAILED) > i))
        aggs.append(F.count_if(hit).alias(f"rule_{i}"))
    return tagged.agg(*aggs)


def rule_report(tagged: DataFrame, rules: Sequence[Rule | None]) -> DataFrame:
    """One row per rule with its count."""
    one = failure_counts(tagged, rules)
    entries = [
        F.struct(F.lit(i).alias("rule_no"),
                 F.lit(r.kind if r else "unknown").alias("rule_type"),
                 F.lit(r.severity if r else "warning").alias("severity"),
                 F.col(f"rule_{i}").alias("failed_count"),
                 F.lit("applied" if r else "skipped").alias("status"))
        for i, r in enumerate(rules)]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def reject_log(tagged: DataFrame, rules: Sequence[Rule | None], source: str, target: str,
               batch_id: str, run_id: str, at: str) -> DataFrame:
    """Rejected rows as log entries holding the original row in JSON."""
    data = [c for c in tagged.columns if not c.startswith("_dq_")]
    pick = lambda values: F.try_element_at(F.array(*[F.lit(v) for v in values]), F.col(FAILED) + 1)
    known = [r for r in rules]
    ids = [(r.rule_id or f"{target}-{i}") if r else "" for i, r in enumerate(known)]
    body = F.to_json(F.struct(*data), {"ignoreNullFields": "false"})
    stamp = F.lit(at).cast("timestamp")
    return (tagged.where(F.col(FAILED).isNotNull())
            .select(
                surrogate_key(F.lit(batch_id), body, pick(ids)).alias("reject_key"),
                F.lit(source).alias("source_table"), F.lit(target).alias("target_table"),
                F.lit(batch_id).alias("batch_id"), F.lit(run_id).alias("pipeline_run_id"),
                F.to_date(stamp).alias("rejection_date"), stamp.alias("rejection_timestamp"),
                pick(ids).alias("rule_id"),
                pick([r.kind.upper() if r else "" for r in known]).alias("rule_type"),
                F.lit("BLOCKER").alias("severity"),
                pick([",".join(r.columns) if r else "" for r in known]).alias("column_name"),
                body.alias("raw_record_json"),
                pick([r.reason if r else "" for r in known]).alias("rejection_reason")))


def enforce_limit(rejected: int, total: int, limit_pct: float = DEFAULT_LIMIT_PCT) -> float:
    """Raise when the rejected share is strictly above the limit."""
    rate = 100.0 * rejected / total if total else 0.0
    if rate > limit_pct:
        raise ValueError(f"DQ halt: {rate:.2f}% of records rejected, limit {limit_pct}%")
    return rate


def run_quality_checks(df: DataFrame, rules: list, dq_logger=None, total_count: int | None = None,
                       fail_rate_pct: float = DEFAULT_LIMIT_PCT, quarantine_table: str | None = None,
                       spark=None, order: Sequence[Column] | None = None) -> dict:
    """Evaluate rules (dictionaries or ``Rule``) and return clean rows, rejects and a report.

    One job counts everything; ``quarantine_table`` appends the rejects to a
    Parquet folder before the limit is enforced.
    """
    compiled = [r if isinstance(r, Rule) else from_dict(r) for r in rules]
    tagged = tag(df, compiled, order)
    counts = failure_counts(tagged, compiled).first()
    total = counts["total"] if total_count is None else total_count
    report, blocked = [], 0
    for i, (spec, rule) in enumerate(zip(rules, compiled)):
        kind = rule.kind if rule else spec.get("type")
        severity = rule.severity if rule else spec.get("severity", "warning")
        caught = counts[f"rule_{i}"]
        if rule and rule.blocks:
            blocked += caught
        report.append({"rule_type": kind, "severity": severity, "failed_count": caught,
                       "status": "applied" if rule else "skipped"})
        if dq_logger is not None and caught:
            dq_logger.warning("quality rule %s (%s) caught %d rows", kind, severity, caught)
    rejects = rejected_rows(tagged, compiled)
    if quarantine_table and blocked:
        rejects.write.mode("append").parquet(quarantine_table)
    enforce_limit(blocked, total, fail_rate_pct)
    return {"clean_df": clean_rows(tagged), "quarantine_df": rejects, "report": report}


def _single(df: DataFrame, rule: Rule, order: Sequence[Column] | None = None):
    tagged = tag(df, [rule], order)
    caught = failure_counts(tagged, [rule]).first()["rule_0"]
    bad = rejected_rows(tagged, [rule]) if rule.blocks else df.where(F.lit(False))
    return clean_rows(tagged), bad, caught


def check_not_null(df: DataFrame, columns: list, severity: str = "error",
                   flag_col: str = "_dq_null_flag"):
    """(clean, failed, count) for rows with a NULL in any listed column."""
    return _single(df, not_null(columns, severity, flag_col))


def check_unique(df: DataFrame, columns: list, severity: str = "error",
                 order: Sequence[Column] | None = None):
    """(clean, failed, count) for rows after the first of their key."""
    return _single(df, unique(columns, severity), order)


def check_range(df: DataFrame, column: str, min_val=None, max_val=None,
                severity: str = "warning", flag_col: str | None = None):
    """(clean, failed, count) for values outside the inclusive bounds, NULL included."""
    return _single(df, in_range(column, min_val, max_val, severity, flag_col))


def check_referential_integrity(df: DataFrame, fk_col: str, ref_values,
                                severity: str = "warning", flag_col: str | None = None,
                                ref_col: str | None = None):
    """(clean, failed, count) for non-NULL values absent from the reference."""
    return _single(df, referential(fk_col, ref_values, severity, flag_col, ref_col))


def check_custom(df: DataFrame, condition_expr: str, flag_col: str, severity: str = "warning"):
    """(clean, failed, count) for rows where the SQL condition is TRUE."""
    return _single(df, custom(condition_expr, flag_col, severity))
