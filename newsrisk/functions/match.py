"""Keyword predicates and flags as plain columns, evaluated inside code generation.

The conditions are written as SQL text over a column name and parsed in one call: a rule set
has more than a hundred terms, and building them one ``Column`` operation at a time takes
longer than planning the query.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from newsrisk.functions.lexicon import (
    RELEVANCE,
    RISK_RULES,
    Clause,
    KeywordRule,
    RelevanceRule,
    reduce_keywords,
    reduce_rule,
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(column: str) -> str:
    return ".".join(f"`{part}`" for part in column.split("."))


def _keywords_sql(column: str, keywords: Iterable[str]) -> str:
    terms = [
        f"contains({_name(column)}, {_quoted(k.lower())})" for k in reduce_keywords(keywords)
    ]
    return f"({' OR '.join(terms)})" if terms else "false"


def _word_sql(column: str, word: str) -> str:
    word = word.lower()
    edge = "[0-9A-Za-z_]"
    pattern = f"(?<!{edge}){re.escape(word)}(?!{edge})"
    return (
        f"(contains({_name(column)}, {_quoted(word)}) "
        f"AND {_name(column)} RLIKE {_quoted(pattern)})"
    )


def _clause_sql(column: str, clause: Clause) -> str:
    parts = [_keywords_sql(column, clause.triggers)]
    if clause.requires:
        parts.append(_keywords_sql(column, clause.requires))
    if clause.excludes:
        parts.append(f"NOT {_keywords_sql(column, clause.excludes)}")
    return f"({' AND '.join(parts)})"


def rule_sql(column: str, rule: KeywordRule) -> str:
    """SQL condition of ``rule`` over the lower-cased text in ``column``."""
    return " OR ".join(_clause_sql(column, c) for c in reduce_rule(rule).clauses)


def any_keyword(column: str, keywords: Iterable[str]) -> Column:
    """True when any keyword is a substring of the lower-cased text in ``column``.

    An OR of ``contains`` stops at the first hit, compiles to byte comparisons and reaches
    Parquet as ``StringContains`` filters; an empty list never matches.
    """
    return F.expr(_keywords_sql(column, keywords))


def whole_word(column: str, word: str) -> Column:
    """True when ``word`` stands alone in the lower-cased text, with ASCII word boundaries.

    ``\\b`` is Unicode-aware on the JVM, so the boundary is spelled out.  The cheap
    substring test runs first; the regular expression only sees rows that can match.
    """
    return F.expr(_word_sql(column, word))


def rule_matches(column: str, rule: KeywordRule) -> Column:
    """Boolean outcome of ``rule`` (NULL for NULL text)."""
    return F.expr(rule_sql(column, rule))


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def rule_flag(column: str, rule: KeywordRule) -> Column:
    """0/1 outcome of ``rule``; NULL text gives 0."""
    return flag(rule_matches(column, rule))


def relevance(column: str, rule: RelevanceRule = RELEVANCE) -> Column:
    """0/1: a foreign actor and a domestic marker both occur.

    The domestic list is shorter, so it is tested first.
    """
    foreign = [_keywords_sql(column, rule.actors)]
    foreign += [_word_sql(column, word) for word in rule.actor_words]
    return flag(F.expr(f"{_keywords_sql(column, rule.domestic)} AND ({' OR '.join(foreign)})"))


def risk_flags(column: str, rules: Iterable[KeywordRule] = RISK_RULES) -> dict[str, Column]:
    """``{"is_<rule>": 0/1 column}`` for every rule, ready for ``withColumns``."""
    return {f"is_{rule.name}": rule_flag(column, rule) for rule in rules}
