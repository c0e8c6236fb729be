"""Column helpers. All built-in expressions: they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from svcvitals import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def environment(name, rules=None, default: str | None = None) -> Column:
    """Ordered, case-insensitive substring classifier. NULL input -> default."""
    rules = rules or C.ENVIRONMENT_RULES
    default = C.DEFAULT_ENVIRONMENT if default is None else default
    c = _col(name)
    out = None
    for pattern, label in rules:
        out = F.when(c.rlike(pattern), F.lit(label)) if out is None else out.when(c.rlike(pattern), F.lit(label))
    return out.otherwise(F.lit(default))


def is_async_like(archetype, pattern: str = C.ASYNC_LIKE_PATTERN) -> Column:
    """True for async / pipeline / cron / ingest archetypes; NULL stays NULL (falsy in when)."""
    return _col(archetype).rlike(pattern)


def json_scalar(c, doc=None, path: str | None = None) -> Column:
    """Keep a JSON-extracted value only when it is a scalar (objects/arrays -> NULL).

    Input is a string produced by ``get_json_object``, ``json_tuple`` or a string leaf of
    ``from_json``, which return the raw text of nested objects/arrays. Text that starts
    with '{' or '[' may also be a string scalar: given the document and the value's path,
    its JSON type decides (parsed for such rows only); without them it counts as nested.

    The type is asked for in a branch's value, not behind an AND: what several fields of one
    document have in common in their conditions Spark takes out and computes for every row,
    which would parse every document a second time.
    """
    c = _col(c)
    scalar = F.lit(None).cast("string")
    if doc is not None:
        value = F.try_variant_get(F.try_parse_json(_col(doc)), path, "variant")
        scalar = F.when(F.schema_of_variant(value) == F.lit("STRING"), c)
    return F.when(c.startswith("{") | c.startswith("["), scalar).otherwise(c)


def py_round(c, digits: int) -> Column:
    """Round like Python's ``round(x, n)`` on a double: on the exact binary value,
    exact ties to even (2.675 -> 2.67, 0.125 -> 0.12). ``round``/``bround`` act on the
    decimal rendering instead and differ on such values."""
    pattern = "0." + "0" * digits if digits > 0 else "0"
    return F.call_function("format_number", _col(c), F.lit(pattern)).cast("double")


def bounded_decay(ratio, slope: float = C.AVAILABILITY_DECAY_SLOPE) -> Column:
    """max(0, 1 - (1 - ratio) * slope)."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - ((F.lit(1.0) - _col(ratio)) * F.lit(slope)))


def latency_ratio(actual, target) -> Column:
    """1 when unknown or under target, else target / actual."""
    a, t = _col(actual), _col(target)
    return F.when(a.isNull(), F.lit(1.0)).when(a < t, F.lit(1.0)).otherwise(t / a)


def null_if_zero(c) -> Column:
    return F.nullif(_col(c), F.lit(0))


def null_safe_least(a, b) -> Column:
    """LEAST that is NULL when any input is NULL (Spark's skips NULLs)."""
    a, b = _col(a), _col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def month_diff(end, start) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end`` (calendar months)."""
    e, s = _col(end), _col(start)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def severity_rank(severity, ranks: dict[str, int] | None = None) -> Column:
    """Numeric rank of a log severity; unknown / NULL -> NULL."""
    ranks = ranks or C.SEVERITY_RANKS
    m = F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, _col(severity))
