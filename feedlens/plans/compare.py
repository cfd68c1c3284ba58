"""Order-insensitive comparison of a Spark result with an oracle result (as the driver does)."""

from __future__ import annotations

import math


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "∅" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in records)


def compare(scols, srows, dcols, drows) -> list[str]:
    """Problems found (empty list = match): column names, row count, values."""
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"cols spark={sorted(scols)} oracle={sorted(dcols)}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} oracle={len(drows)}")
    if not problems:
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
              "TIMESTAMP": "timestamp", "DATE": "date"}


def type_problems(schema, described: list[tuple]) -> list[str]:
    """Columns whose types differ between a Spark schema and the rows of DuckDB's DESCRIBE (name, type, ...)."""
    theirs = {d[0]: DUCK_TYPES.get(d[1], d[1]) for d in described}
    return [f"{f.name}: spark {f.dataType.simpleString()}, oracle {theirs.get(f.name)}" for f in schema.fields
            if f.dataType.simpleString() != theirs.get(f.name)]
