"""Rule text of a level-4 tag: one ``key=value`` per line."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rule_map(rule: Column | str) -> Column:
    """Rule text as ``map<string,string>``.

    Lines are trimmed and blank ones ignored; everything after the first ``=``
    is the value. A line without ``=`` and a repeated key are errors.
    """
    text = F.col(rule) if isinstance(rule, str) else rule
    lines = F.transform(F.split(text, "\n"), lambda line: F.trim(line, F.lit(" \t\r")))
    kept = F.array_join(F.filter(lines, lambda line: line != ""), "\n")
    pairs = F.str_to_map(kept, F.lit("\n"), F.lit("="))
    broken = F.exists(F.map_values(pairs), lambda value: value.isNull())
    return F.when(
        broken, F.raise_error(F.concat(F.lit("rule line without '=' in: "), text))
    ).otherwise(pairs)


def rule_value(rules: Column, key: str, default: str | None = None) -> Column:
    """Value of ``key``, or ``default`` when the rule does not set it."""
    return F.coalesce(F.element_at(rules, key), F.lit(default))


def required_value(rules: Column, key: str) -> Column:
    """Value of ``key``; an error when the rule does not set it."""
    return F.coalesce(
        F.element_at(rules, key), F.raise_error(F.lit(f"rule has no '{key}'"))
    )
