"""Field rules as SQL expression text: message lists, joined reasons and the matching pass predicate."""

from __future__ import annotations

from oreflow.model import EntitySpec, Parent


def field_messages(spec: EntitySpec) -> str:
    """Messages of the failed list-form rules, in rule order; empty when the row is fine."""
    arms = ", ".join(f"CASE WHEN {r.fails} THEN {r.message} END" for r in spec.list_rules)
    return f"array_compact(array({arms}))"


def field_errors(spec: EntitySpec) -> str:
    """Failed named rules as ``array<struct<rule, message>>``."""
    arms = ", ".join(
        f"CASE WHEN {r.fails} THEN named_struct('rule', '{r.name}', 'message', {r.message}) END"
        for r in spec.list_rules
    )
    return f"array_compact(array({arms}))"


def any_field_error(spec: EntitySpec) -> str:
    return f"coalesce({' OR '.join(f'({r.fails})' for r in spec.list_rules)}, false)"


def fields_valid(spec: EntitySpec) -> str:
    """Pass predicate of the load rules.  A null operand gives null, so a filter drops the row."""
    return " AND ".join(f"NOT ({r.fails})" for r in spec.rules) or "true"


def _arm(failed: str, text: str) -> str:
    # Every arm ends in ELSE '': Spark's concat is null as soon as one part is.
    return f"CASE WHEN {failed} THEN '{text}' ELSE '' END"


def _parent_missing(spec: EntitySpec, parent: Parent, absent: str) -> str:
    """Whether a missing parent is to be reported for this row."""
    gate = fields_valid(spec) if parent.after_fields else f"{parent.column} > 0"
    return f"{gate} AND {absent}"


def failure_reason(spec: EntitySpec, absent: dict[str, str] | None = None) -> str:
    """Joined reasons of a row, '' when there are none.

    ``absent`` maps a parent entity to a predicate telling that the row's parent is not there.
    """
    absent = absent or {}
    arms = [_arm(r.fails, f"{r.message}; ") for r in spec.rules]
    for parent in spec.parents:
        if parent.entity in absent:
            arms.append(_arm(_parent_missing(spec, parent, absent[parent.entity]), parent.message + spec.parent_suffix))
    return f"concat({', '.join(arms)})"
