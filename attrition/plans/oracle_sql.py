"""Independent SQL (DuckDB dialect) for the oracle check.

Inputs come from the same view expressions as the Spark side
(``sources.views``); cleaning and features are re-written here in plain SQL
so the oracle does not reuse any Spark operator code.
"""

from __future__ import annotations

from .. import schemas as S
from ..sources.views import VIEWS, view_select_sql

_STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _clean_sql() -> str:
    cols = []
    for c in S.RAW_COLUMNS:
        if c in ("SeniorCitizen", "tenure", "MonthlyCharges"):
            cols.append(c)
        elif c == "TotalCharges":
            cols.append(f"coalesce(TRY_CAST({_STRIP.format(c=c)} AS DOUBLE), CAST(0 AS DOUBLE)) AS TotalCharges")
        else:
            cols.append(f"{_STRIP.format(c=c)} AS {c}")
    return "SELECT " + ", ".join(cols) + " FROM customer_raw"


def _features_sql() -> str:
    yes_no = ("CAST(CASE {c} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No phone service' THEN 0 "
              "WHEN 'No internet service' THEN 0 END AS TINYINT)")
    ind = "CAST(coalesce({c} = '{v}', false) AS TINYINT)"
    onehot = {name: ind.format(c=src, v=val) for name, src, val in S.ONE_HOT_SPEC}
    svc = " + ".join(yes_no.format(c=c) for c in S.SERVICE_COLUMNS)
    expr = {
        "customerID": "customerID", "tenure": "tenure", "MonthlyCharges": "MonthlyCharges",
        "TotalCharges": "TotalCharges", "SeniorCitizen": "CAST(SeniorCitizen AS TINYINT)",
        "tenure_group": ("CASE WHEN tenure <= 12 THEN 'new' WHEN tenure <= 24 THEN 'developing' "
                         "WHEN tenure <= 48 THEN 'mature' ELSE 'loyal' END"),
        "charges_per_month": ("round_even((CASE WHEN tenure > 0 THEN TotalCharges / tenure "
                              "ELSE MonthlyCharges END) * 10000, 0) / 10000"),
        "has_internet": "CAST(NOT coalesce(InternetService = 'No', false) AS TINYINT)",
        "num_services": f"CAST({svc} AS TINYINT)",
        "Churn": "CAST(CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS TINYINT)",
    }
    expr.update(onehot)
    for c in S.BINARY_COLUMNS:
        expr[c] = yes_no.format(c=c)
    return "SELECT " + ", ".join(f"{expr[c]} AS {c}" for c in S.FEATURE_TABLE_COLUMNS) + " FROM customer_clean"


CTES: dict[str, tuple[str, tuple[str, ...]]] = {name: (view_select_sql(name), ()) for name in VIEWS}
CTES["customer_clean"] = (_clean_sql(), ("customer_raw",))
CTES["customer_features"] = (_features_sql(), ("customer_clean",))


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order) + "\n" + body
