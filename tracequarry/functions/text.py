"""Text expressions of signatures, summaries and prompts.

Regular expressions follow Unicode rules that don't depend on the Java version:
words are cut with explicit letter classes, ``(?d)`` keeps line ends at ``\\n``.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Patterns and limits of the signature.
ERROR_PATTERN = r"(?i)(Traceback \(most recent call last\)|SyntaxError:|Error:|Exception:|FAILED|panic:)"
SUCCESS_PATTERN = r"(?i)(file created|file edited|successfully|\d+ passed)"
SUCCESS_PATTERN_CASED = r"(?md)(PASSED|OK$)"
VERIFY_PATTERN = r"(?i)(test|check|pytest|run|verify|build)"
TRANSITION_PATTERN = r"(?i)(现在|接下来|然后来|Let me now|Next,? I|Now I|Moving on)"
LANGUAGE_PATTERNS = (
    ("python", r"(?id)(\.py\b|python|import\s|def\s|class\s)"),
    ("javascript", r"(?id)(\.js\b|\.ts\b|node|require\(|import.*from)"),
    ("bash", r"(?id)(\.sh\b|bash|#!/bin)"),
    ("java", r"(?id)(\.java\b|public\s+class)"),
    ("cpp", r"(?id)(\.(cpp|cc|h)\b|#include)"),
    ("go", r"(?id)(\.go\b|package\s+main|func\s+main)"),
    ("html", r"(?id)(\.html\b|<html|<div)"),
)
ERROR_TOKENS = r"(SyntaxError|TypeError|ValueError|KeyError|ImportError|AttributeError|RuntimeError|FileNotFoundError|Traceback|Exception|FAILED|Error|panic)"
PATH_TOKENS = r"(?U)(\b[\w./-]+\.(?:py|js|ts|json|yaml|yml|md)\b)"
DEF_TOKENS = r"(?U)\bdef\s+([A-Za-z_][A-Za-z0-9_]*)"
IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_]{2,}$"
STOP_WORDS = ("def", "return", "class", "import", "from", "with", "open", "self", "true", "false", "none", "syntaxerror", "traceback", "error")


def strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.expr("cast(array() as array<string>)")


def identifiers(text: Column) -> Column:
    """Identifiers of three letters or more that aren't stop words, in order, repeats included."""
    words = F.split(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}_]+")
    return F.filter(words, lambda w: w.rlike(IDENTIFIER) & ~F.lower(w).isin(*STOP_WORDS))


def search_tokens(text: Column, tools: Column) -> Column:
    """Sorted distinct search tokens: tool names, error names, paths, definitions and identifiers."""
    text = F.coalesce(text, F.lit(""))
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in (ERROR_TOKENS, PATH_TOKENS, DEF_TOKENS)]
    return F.sort_array(F.array_distinct(F.concat(F.transform(tools, F.lower), *found, identifiers(text))))


def languages(text: Column) -> Column:
    """Programming languages that the text shows, in fixed order; ``other`` if none."""
    found = F.filter(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in LANGUAGE_PATTERNS]), lambda x: x.isNotNull())
    return F.when(F.size(found) == 0, strings("other")).otherwise(found)


def is_error(text: Column) -> Column:
    return text.rlike(ERROR_PATTERN)


def is_success(text: Column) -> Column:
    return text.rlike(SUCCESS_PATTERN) | text.rlike(SUCCESS_PATTERN_CASED)


def is_verification(tool: Column, args: Column) -> Column:
    return F.coalesce((tool == "Bash") & F.coalesce(args, F.lit("")).rlike(VERIFY_PATTERN), F.lit(False))


def is_transition(content: Column) -> Column:
    return F.substring(content, 1, 200).rlike(TRANSITION_PATTERN)


def shortened(text: Column, limit: int) -> Column:
    """Line ends written as ``\\n``, then cut to ``limit`` characters with dots."""
    flat = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit("\\n"))
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit), F.lit("..."))).otherwise(flat)


def summary_line(step: Column) -> Column:
    """One line for a step; null for a role that has none."""
    head = F.concat(F.lit("Step "), step["step_index"].cast("string"), F.lit(": "))
    said = shortened(step["content"], 150)
    tool = F.coalesce(step["tool_call_name"], F.lit(""))
    call = F.concat(F.lit(" → call "), tool, F.lit('("'), shortened(step["tool_call_args"], 200), F.lit('")'))
    result = F.when(F.coalesce(step["tool_result"], F.lit("")) != "", step["tool_result"]).otherwise(step["content"])
    role = step["role"]
    return (
        F.when(role == "assistant", F.concat(head, F.lit("[assistant] "), said, F.when(tool != "", call).otherwise(F.lit(""))))
        .when(role == "tool", F.concat(head, F.lit("[result] "), shortened(result, 300)))
        .when(role.isin("user", "system"), F.concat(head, F.lit("["), role, F.lit("] "), said))
    )


def summary(steps: Column) -> Column:
    return F.array_join(F.filter(F.transform(steps, summary_line), lambda x: x.isNotNull()), "\n")


def embedding_text(steps: Column) -> Column:
    """Text that a slice is embedded by: cut arguments, thoughts with tool names, results; 1000 characters."""

    def parts(s: Column) -> Column:
        args = F.when(F.coalesce(s["tool_call_args"], F.lit("")) != "", F.substring(s["tool_call_args"], 1, 160))
        said = F.when((s["role"] == "assistant") & (s["content"] != ""), F.substring(s["content"], 1, 100))
        tool = F.when((s["role"] == "assistant") & (s["content"] != "") & (F.coalesce(s["tool_call_name"], F.lit("")) != ""), s["tool_call_name"])
        result = F.when((s["role"] == "tool") & (F.coalesce(s["tool_result"], F.lit("")) != ""), F.substring(s["tool_result"], 1, 50))
        return F.filter(F.array(args, said, tool, result), lambda x: x.isNotNull())

    return F.substring(F.array_join(F.flatten(F.transform(steps, parts)), " "), 1, 1000)


def normalized_question(question: str | None) -> str:
    """Composed form, no outer blanks, single spaces; case stays."""
    return re.sub(r"\s+", " ", unicodedata.normalize("NFC", question or "").strip())


@F.pandas_udf(StringType())
def problem_id(question: pd.Series) -> pd.Series:
    """First 16 hex digits of the SHA-1 of the normalised question (there is no built-in composition)."""
    return question.map(lambda q: hashlib.sha1(normalized_question(q).encode()).hexdigest()[:16])


def bump_patch(version: Column) -> Column:
    """``a.b.c`` with c one higher; any other version as it is."""
    patch = F.regexp_extract(version, r"^\d+\.\d+\.(\d+)$", 1)
    head = F.regexp_extract(version, r"^(\d+\.\d+\.)\d+$", 1)
    return F.when(patch != "", F.concat(head, (patch.cast("long") + 1).cast("string"))).otherwise(version)


def estimated_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("long")
