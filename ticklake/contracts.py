"""Data-contract checks: column names, order and types of a DataFrame
against a declared schema (analysis only, no job is run)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


class ContractError(AssertionError):
    pass


def contract_diff(df: DataFrame, expected: StructType, check_types: bool = True) -> list[str]:
    """Human-readable differences between ``df.schema`` and ``expected``
    (empty when they agree).  Nullability is not compared: parsed fields
    are nullable whatever a schema declares."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    problems: list[str] = []
    got_names, want_names = [n for n, _ in got], [n for n, _ in want]
    missing = [n for n in want_names if n not in got_names]
    extra = [n for n in got_names if n not in want_names]
    if missing:
        problems.append(f"missing columns: {missing}")
    if extra:
        problems.append(f"unexpected columns: {extra}")
    if not missing and not extra and got_names != want_names:
        problems.append(f"column order {got_names} != {want_names}")
    if check_types:
        got_types = dict(got)
        for name, dtype in want:
            if name in got_types and got_types[name] != dtype:
                problems.append(f"{name}: {got_types[name].simpleString()} != {dtype.simpleString()}")
    return problems


def assert_contract(df: DataFrame, expected: StructType, check_types: bool = True) -> DataFrame:
    """Raise ``ContractError`` unless ``df`` has exactly the expected columns,
    in order, with the expected types; returns ``df`` for chaining."""
    problems = contract_diff(df, expected, check_types)
    if problems:
        raise ContractError("; ".join(problems))
    return df
