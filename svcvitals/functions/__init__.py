from svcvitals.functions.columns import (  # noqa: F401
    bounded_decay, environment, is_async_like, json_scalar, latency_ratio, month_diff,
    py_round, severity_rank, null_if_zero, null_safe_least,
)
from svcvitals.functions.sql import register_sql_functions  # noqa: F401
