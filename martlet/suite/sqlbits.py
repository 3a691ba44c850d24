"""Small DuckDB text helpers for the oracle queries."""

from martlet.session import AS_OF, REPORT_TZ


def ld(x: str) -> str:
    """Local date of a UTC timestamp in the report zone."""
    return f"cast(timezone('{REPORT_TZ}', timezone('UTC', {x})) as date)"


def lts(x: str) -> str:
    return f"timezone('{REPORT_TZ}', timezone('UTC', {x}))"


def month(x: str) -> str:
    return f"cast(date_trunc('month', {x}) as date)"


ASOF = f"timestamp '{AS_OF}'"
ASOF_DATE = f"date '{AS_OF[:10]}'"
