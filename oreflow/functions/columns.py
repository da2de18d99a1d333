"""Scalar building blocks as SQL expression text.

All of them are built-in expressions that stay inside whole-stage code generation.  Text keeps a wide
projection to one call into the JVM, where a Column tree would take one call per node; use it with
``selectExpr`` or ``F.expr``.  Arguments are SQL expressions themselves, mostly column names.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime

from oreflow.model import EntitySpec


def timestamp_literal(at: datetime) -> str:
    return f"TIMESTAMP_NTZ '{at.isoformat(sep=' ')}'"


def iso_timestamp(ts: str) -> str:
    """ISO-8601 text of a zone-free time; the six-digit fraction is printed only when it is not zero.

    Built on the cast to text, which depends on no session time zone and drops trailing zeros.
    """
    text = f"replace(CAST({ts} AS STRING), ' ', 'T')"
    return f"CASE WHEN char_length({text}) > 19 THEN rpad({text}, 26, '0') ELSE {text} END"


def decimal_text(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,2)) AS STRING)"


def _as_text(spec: EntitySpec, name: str, prefix: str) -> str:
    kind, name = spec.columns[name], prefix + name
    if kind.startswith("TIMESTAMP"):
        return iso_timestamp(name)
    if kind.startswith("DECIMAL"):
        return decimal_text(name)
    return f"CAST({name} AS STRING)"


def record_hash(spec: EntitySpec, prefix: str = "") -> str:
    """32-byte SHA-256 over the entity's business columns, joined by '|', null as ''.

    Each part is made non-null first: concat_ws would otherwise skip it together with its delimiter.
    """
    parts = ", ".join(f"coalesce({_as_text(spec, c, prefix)}, '')" for c in spec.hash_columns)
    return f"unhex(sha2(concat_ws('|', {parts}), 256))"


def packed_hash(spec: EntitySpec) -> str:
    """What a shuffle moves of a stored fingerprint beside its columns: nothing where they give it, else all of it."""
    return f"CASE WHEN record_hash <=> {record_hash(spec)} THEN X'' ELSE concat(X'01', record_hash) END"


def shorter_than_hash(spec: EntitySpec) -> bool:
    """Whether the columns behind a fingerprint are certain to take less than its 32 bytes."""
    kinds = [spec.columns[c] for c in spec.hash_columns]
    wide = any(re.fullmatch(r"STRING|BINARY|DECIMAL\((19|[23]\d),\d+\)", kind) for kind in kinds)
    return not wide and sum(4 if kind == "INT" else 8 for kind in kinds) < 32


def unpacked_hash(spec: EntitySpec, packed: str, prefix: str = "") -> str:
    return f"CASE WHEN octet_length({packed}) = 0 THEN {record_hash(spec, prefix)} ELSE substring({packed}, 2) END"


def hash_hex(value: str = "record_hash") -> str:
    return f"lower(hex({value}))"


def round_to_millis(ts: str) -> str:
    """Round half up to a whole millisecond, without leaving local (zone-free) time."""
    over = f"CAST(rpad(substring(CAST({ts} AS STRING), 21), 6, '0') AS INT) % 1000"
    return f"timestampadd(MICROSECOND, CASE WHEN {over} >= 500 THEN 1000 - {over} ELSE -({over}) END, {ts})"


def _epoch_millis(ts: str) -> str:
    # Read as UTC whatever the session's zone is, so that no local clock change falls between two times.
    return f"unix_millis(CAST(concat(CAST({ts} AS STRING), 'Z') AS TIMESTAMP))"


def duration_ms(start: str, end: str) -> str:
    """Millisecond boundaries crossed between two times; null while there is no end."""
    return f"{_epoch_millis(end)} - {_epoch_millis(start)}"


def metric_date(ts: str) -> str:
    return f"to_date({ts})"


def or_zero(value: str) -> str:
    return f"coalesce({value}, 0L)"


def success_rate_pct(successes: str, total: str) -> str:
    return f"CAST(100.0 * {successes} / nullif({total}, 0L) AS DECIMAL(5,2))"


def average_decimal(value: str) -> str:
    return f"CAST(avg(CAST({value} AS DECIMAL(18,2))) AS DECIMAL(18,2))"


def guid_sort_key(guid: str) -> str:
    """Text that sorts the way SQL Server sorts a uniqueidentifier: by byte, from the last group to the first.

    The first three groups are stored least significant byte first, so their bytes compare in reverse.
    """
    text = f"lower({guid})"
    # (first character, length) of the bytes in order of weight
    spans = [(25, 12), (20, 4), (17, 2), (15, 2), (12, 2), (10, 2), (7, 2), (5, 2), (3, 2), (1, 2)]
    return f"concat({', '.join(f'substring({text}, {start}, {n})' for start, n in spans)})"


def same_key(left: str, right: str, spec: EntitySpec) -> str:
    """Equality of two columns that hold a key of an entity.

    Keys beyond 64 bits are slow to hash and to sort: they meet by a 64-bit hash, and an exact check of the few that
    share one follows the join.  The check is no equality, or the planner would join by the wide key after all.
    """
    if not wide_key(spec):
        return f"{left} = {right}"
    return f"{join_key(left, spec)} = {join_key(right, spec)} AND {left} >= {right} AND {left} <= {right}"


def join_key(column: str, spec: EntitySpec) -> str:
    """What joins on a key column are dealt out by."""
    return f"xxhash64({column})" if wide_key(spec) else column


def wide_key(spec: EntitySpec) -> bool:
    kind = re.fullmatch(r"DECIMAL\((\d+),\d+\)", spec.columns[spec.key])
    return bool(kind) and int(kind[1]) > 18


def stable_id(name: str, namespace: uuid.UUID = uuid.NAMESPACE_URL) -> str:
    """Name-based (version 5) UUID of a text expression, equal to Python's ``uuid.uuid5``."""
    digest = f"sha1(concat(unhex('{namespace.hex}'), encode({name}, 'UTF-8')))"
    variant = f"substring('89ab', CAST(conv(substring({digest}, 17, 1), 16, 10) AS INT) % 4 + 1, 1)"
    return (
        f"concat(substring({digest}, 1, 8), '-', substring({digest}, 9, 4), '-5', substring({digest}, 14, 3), '-', "
        f"{variant}, substring({digest}, 18, 3), '-', substring({digest}, 21, 12))"
    )
