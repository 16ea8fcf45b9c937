"""Checks that must pass before a stage is published: each gives a status, and require() raises on errors."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LabelSpec

MAX_RATE, WARN_RATE = 0.05, 0.01


class GuardError(ValueError):
    """A check that forbids publishing."""


@dataclass(frozen=True)
class Verdict:
    guard: str
    status: str  # pass, warn, error or skip
    detail: str = ""


def require(*verdicts: Verdict) -> list[Verdict]:
    """The warnings, which are logged; raises if any verdict is an error."""
    errors = [v for v in verdicts if v.status == "error"]
    if errors:
        raise GuardError("; ".join(f"{v.guard}: {v.detail}" for v in errors))
    warned = [v for v in verdicts if v.status == "warn"]
    for v in warned:
        logging.getLogger("spanframe").warning("%s: %s", v.guard, v.detail)
    return warned


def rate_status(dropped: Column, total: Column, most: float = MAX_RATE, warn: float = WARN_RATE) -> Column:
    """Status of a drop rate: skip without a total, pass without a drop, both limits themselves still pass."""
    rate = dropped / total
    return F.when(total.isNull() | (total <= 0), "skip").when(dropped <= 0, "pass").when(rate > most, "error").when(rate > warn, "warn").otherwise("pass")


def _rate(guard: str, dropped: int, total: int | None, most: float, warn: float) -> Verdict:
    if not total or total <= 0:
        return Verdict(guard, "skip")
    rate = dropped / total
    status = "pass" if dropped <= 0 else "error" if rate > most else "warn" if rate > warn else "pass"
    return Verdict(guard, status, f"{dropped} of {total} dropped")


def record_parity(previous: int | None, current: int, most: float = MAX_RATE, warn: float = WARN_RATE) -> Verdict:
    return _rate("record parity", (previous or 0) - current, previous, most, warn)


def alignment(dropped: int, total: int, most: float = MAX_RATE, warn: float = WARN_RATE) -> Verdict:
    return _rate("alignment", dropped, total, most, warn)


def missing_types(configured: DataFrame, observed: DataFrame) -> DataFrame:
    """Types that are configured and not observed."""
    return configured.select("type").distinct().join(observed.select("type").distinct(), "type", "left_anti")


def vocabulary(observed: Sequence[str], configured: Sequence[str], allow_removal: bool = False) -> Verdict:
    gone = sorted(set(configured) - set(observed))
    if not configured:
        return Verdict("vocabulary", "skip")
    return Verdict("vocabulary", "pass" if not gone else "warn" if allow_removal else "error", ", ".join(gone))


def known_types(observed: Sequence[str], spec: LabelSpec) -> Verdict:
    odd = sorted(set(observed) - set(spec.entity_types))
    return Verdict("known types", "error" if odd else "pass", ", ".join(odd))


def id_differences(tokens: DataFrame, predictions: DataFrame, key: str = "id") -> DataFrame:
    """(key, side): ids of tokens without a prediction (missing) and of predictions without tokens (extra)."""
    t, p = tokens.select(key).distinct(), predictions.select(key).distinct()
    return t.join(p, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(p.join(t, key, "left_anti").withColumn("side", F.lit("extra")))


def join_completeness(tokens: DataFrame, predictions: DataFrame, key: str = "id") -> Verdict:
    """An error names the first ten missing ids; extra ones are a warning."""
    odd = id_differences(tokens, predictions, key)
    n = {r["side"]: r["n"] for r in odd.groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()}
    side = "missing" if n.get("missing") else "extra" if n.get("extra") else None
    if side is None:
        return Verdict("join completeness", "pass")
    first = [str(r[0]) for r in odd.where(F.col("side") == side).orderBy(key).limit(10).select(key).collect()]
    return Verdict("join completeness", "error" if side == "missing" else "warn", f"{n[side]} {side}: {', '.join(first)}")


def head_size(head: int | None, spec: LabelSpec) -> Verdict:
    """Whether a model scores the specification's labels; rules and others without a head (None) are not judged."""
    n = len(spec.label2id)
    if head is None:
        return Verdict("head size", "skip")
    return Verdict("head size", "pass" if head == n else "error", f"{head} outputs, {n} labels")


def same_types(configured: Sequence[str], spec: LabelSpec) -> Verdict:
    """The ordered types of a configuration are those of the specification."""
    return Verdict("configured types", "pass" if list(configured) == list(spec.entity_types) else "error", f"{list(configured)} against {list(spec.entity_types)}")


def hidden_size(configured: int, encoder: int) -> Verdict:
    return Verdict("hidden size", "pass" if configured == encoder else "error", f"{configured} against {encoder}")


def equal_counts(name: str, a: int, b: int) -> Verdict:
    return Verdict(name, "pass" if a == b else "error", f"{a} against {b}")


def unmatched(name: str, stems: DataFrame) -> Verdict:
    """A warning that names the first ten stems without a partner."""
    first = [r[0] for r in stems.select("stem").orderBy("stem").limit(10).collect()]
    return Verdict(name, "warn" if first else "pass", ", ".join(first))


def empty(name: str, violations: DataFrame) -> Verdict:
    """An error if there is any violating row."""
    found = violations.limit(1).count()
    return Verdict(name, "error" if found else "pass", "violating rows" if found else "")
