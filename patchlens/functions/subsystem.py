"""Subsystem scoring, rule-derived targets and complexity labels.

Lookups against the small constant tables in ``config`` are literal maps
evaluated inside the projection (no join, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchlens import config
from patchlens.functions.text import word_count


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(pairs) -> Column:
    args = []
    for k, v in pairs:
        args += [F.lit(k), F.lit(v)]
    return F.create_map(*args)


def subsystem_score(lower_subject, keywords: list[str]) -> Column:
    """Number of distinct keywords present as plain substrings."""
    s = _c(lower_subject)
    total = None
    for kw in dict.fromkeys(keywords):
        e = F.coalesce(s.contains(kw), F.lit(False)).cast("int")
        total = e if total is None else total + e
    return total


def subsystem_scores(lower_subject, sets=None) -> list[Column]:
    sets = sets or config.SUBSYSTEM_KEYWORDS
    out = []
    for name, kws in sets:
        sc = subsystem_score(lower_subject, kws)
        out += [sc.alias(f"{name}_score"), (sc > 0).alias(f"has_{name}")]
    return out


def primary_subsystem(score_cols: list[str], names: list[str] | None = None) -> Column:
    """First subsystem with the highest score; all zero -> the first name."""
    names = names or config.SUBSYSTEMS
    arr = F.array(*[_c(c) for c in score_cols])
    pos = F.array_position(arr, F.array_max(arr)).cast("int")
    return F.element_at(F.array(*[F.lit(n) for n in names]), pos)


def complexity_label(lower_subject) -> Column:
    s = _c(lower_subject)
    words = word_count(s)
    simple_hit = None
    for w in config.SIMPLE_WORDS:
        e = s.contains(w)
        simple_hit = e if simple_hit is None else simple_hit | e
    complex_hit = None
    for w in config.COMPLEX_WORDS:
        e = s.contains(w)
        complex_hit = e if complex_hit is None else complex_hit | e
    return (
        F.when(F.coalesce(simple_hit, F.lit(False)) & (words <= config.SIMPLE_MAX_WORDS), F.lit("simple"))
        .when(F.coalesce(complex_hit, F.lit(False)) | (words > config.COMPLEX_MIN_WORDS_EXCLUSIVE), F.lit("complex"))
        .otherwise(F.lit("medium"))
    )


_TARGET_FIELDS = ["primary_variable", "function", "condition", "action", "file_path"]


def target_lookup(subsystem, field: str) -> Column:
    """Per-subsystem target default; unknown subsystems fall back to scheduler."""
    i = _TARGET_FIELDS.index(field) + 1
    m = literal_map([(row[0], row[i]) for row in config.TARGET_DEFAULTS])
    fallback = [row for row in config.TARGET_DEFAULTS if row[0] == config.DEFAULT_SUBSYSTEM][0][i]
    return F.coalesce(F.element_at(m, _c(subsystem)), F.lit(fallback))


def derived_targets(subsystem) -> list[Column]:
    return [target_lookup(subsystem, f).alias(f"target_{f}") for f in _TARGET_FIELDS]


_CONFIG_FIELDS = ["path", "type", "init", "secondary_decl", "ret_val", "lock_acquire", "lock_release"]


def template_config(subsystem, field: str) -> Column:
    """Template configuration value; unknown subsystem -> scheduler's."""
    i = _CONFIG_FIELDS.index(field) + 1
    m = literal_map([(row[0], row[i]) for row in config.TEMPLATE_CONFIG])
    fallback = [row for row in config.TEMPLATE_CONFIG if row[0] == config.DEFAULT_SUBSYSTEM][0][i]
    return F.coalesce(F.element_at(m, _c(subsystem)), F.lit(fallback))


def additional_logic(subsystem, complexity) -> Column:
    """'' for simple; table lookup on (subsystem, complexity); '' if unknown."""
    m = literal_map([(f"{s}|{c}", v) for s, c, v in config.ADDITIONAL_LOGIC])
    key = F.concat_ws("|", _c(subsystem), _c(complexity))
    return F.when(_c(complexity) == "simple", F.lit("")).otherwise(F.coalesce(F.element_at(m, key), F.lit("")))
