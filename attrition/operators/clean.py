"""Cleaning, encoding and feature derivation (one ``select`` per step).

Each operator is ``DataFrame -> DataFrame`` and adds only projections, so a
chain of them collapses into a single whole-stage-codegen span over the scan.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import columns as C


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip whitespace of every string column."""
    return df.select([
        C.strip_ws(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text to double, unparsable text to null."""
    wanted = set(cols)
    return df.select([C.to_double(c).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])


def fill_null(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Null to a value."""
    return df.fillna(dict(values))


def null_counts(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P3 counter: how many cells ``fill_null`` will fill, per column (one aggregate)."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"filled_{c}") for c in cols])


def cast_narrow(df: DataFrame, cols: Iterable[str], dtype: str = "tinyint") -> DataFrame:
    """Narrow integer flags (ANSI mode raises on overflow)."""
    wanted = set(cols)
    return df.select([F.col(c).cast(dtype).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])


def yes_no_encode(df: DataFrame, cols: Sequence[str], mapping: Mapping[str, int] | None = None,
                  on_unknown: str = "fail") -> DataFrame:
    """Map Yes/No-like text to 1/0 in place; unknown or null fails."""
    mapping = mapping or S.BINARY_MAP
    wanted = set(cols)
    return df.select([
        C.encode_map(c, mapping, on_unknown, name=c).alias(c) if c in wanted else F.col(f"`{c}`")
        for c in df.columns
    ])


def target_encode(df: DataFrame, col: str = "Churn", on_unknown: str = "fail") -> DataFrame:
    """Churn Yes/No to 1/0 (same failure rule)."""
    return yes_no_encode(df, [col], S.TARGET_MAP, on_unknown)


def one_hot(df: DataFrame, spec: Sequence[tuple[str, str, object]] | None = None) -> DataFrame:
    """Named indicator columns; source columns dropped; unknown -> all 0."""
    spec = spec or S.ONE_HOT_SPEC
    sources = {src for _, src, _ in spec}
    keep = [F.col(f"`{c}`") for c in df.columns if c not in sources]
    return df.select(keep + [C.indicator(src, val).alias(name) for name, src, val in spec])


def tenure_bucket(df: DataFrame, col: str = "tenure", out: str = "tenure_group",
                  edges: Sequence[float] | None = None, labels: Sequence[str] | None = None) -> DataFrame:
    """Right-closed buckets (null falls to the last label)."""
    return df.withColumn(out, C.bucketize(col, edges or S.TENURE_EDGES, labels or S.TENURE_LABELS))


def charges_per_month(df: DataFrame, out: str = "charges_per_month", scale: int | None = 4) -> DataFrame:
    """TotalCharges / tenure when tenure > 0, else MonthlyCharges."""
    return df.withColumn(out, C.safe_ratio("TotalCharges", "tenure", "MonthlyCharges", scale))


def has_internet(df: DataFrame, out: str = "has_internet") -> DataFrame:
    """P10: 1 unless InternetService_No is 1."""
    return df.withColumn(out, (F.col("InternetService_No") == 0).cast("tinyint"))


def num_services(df: DataFrame, cols: Sequence[str] | None = None, out: str = "num_services") -> DataFrame:
    """Row-wise sum of service flags, nulls as 0."""
    return df.withColumn(out, C.row_sum(cols or S.SERVICE_COLUMNS).cast("tinyint"))


def project(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Final column order (Catalyst prunes everything else)."""
    return df.select([F.col(f"`{c}`") for c in (cols or S.FEATURE_TABLE_COLUMNS)])


def align_columns(df: DataFrame, cols: Sequence[str], fill=0, keep: Sequence[str] = ()) -> DataFrame:
    """Add missing columns as ``fill``, order as ``cols``, drop the rest."""
    present = set(df.columns)
    out = [F.col(f"`{c}`") for c in keep]
    for c in cols:
        out.append(F.col(f"`{c}`") if c in present else F.lit(fill).alias(c))
    return df.select(out)


def common_columns(a: DataFrame, b: DataFrame, wanted: Sequence[str]) -> list[str]:
    """P13 (drift form): wanted columns present in both frames, in order."""
    sa, sb = set(a.columns), set(b.columns)
    return [c for c in wanted if c in sa and c in sb]


def derive_missing(df: DataFrame) -> DataFrame:
    """Fill only absent derived features from the base ones.

    Null tenure gives a null ratio instead of raising.
    """
    ratio = F.when(F.col("tenure") > 0, F.col("TotalCharges") / F.col("tenure")) \
        .when(F.col("tenure").isNotNull(), F.col("MonthlyCharges"))
    derived = {
        "charges_per_month": F.coalesce(F.col("charges_per_month"), ratio),
        "has_internet": F.coalesce(F.col("has_internet"),
                                   F.lit(1) - F.coalesce(F.col("InternetService_No"), F.lit(0))),
        "num_services": F.coalesce(F.col("num_services"), C.row_sum(S.SERVICE_COLUMNS)),
    }
    return df.select([derived[c].alias(c) if c in derived else F.col(f"`{c}`") for c in df.columns])


def with_risk_level(df: DataFrame, p: str = "churn_probability", out: str = "risk_level") -> DataFrame:
    """LOW / MEDIUM / HIGH / CRITICAL on the unrounded probability."""
    return df.withColumn(out, C.risk_level(p))


def decide_label(df: DataFrame, p: str = "churn_probability", threshold: float = S.DECISION_THRESHOLD,
                 scale: int = 4) -> DataFrame:
    """Decision, label text and the rounded probability."""
    pred = C.at_least(p, threshold)
    return (df.withColumn("churn_prediction", pred)
              .withColumn("churn_label", F.when(pred == 1, F.lit(S.CHURN_LABELS[0]))
                          .otherwise(F.lit(S.CHURN_LABELS[1])))
              .withColumn(f"{p}_rounded", C.round_half_even(p, scale)))


def is_rejected(bounds: Mapping[str, tuple] | None = None, required: Sequence[str] = ("customerID",)) -> Column:
    """Whether a row violates any rule (nulls pass range rules, fail ``required``)."""
    tests = [F.col(c).isNull() for c in required]
    for c, (lo, hi) in (bounds or S.REQUEST_BOUNDS).items():
        if lo is not None:
            tests.append(F.coalesce(F.col(c) < F.lit(lo), F.lit(False)))
        if hi is not None:
            tests.append(F.coalesce(F.col(c) > F.lit(hi), F.lit(False)))
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def violations(bounds: Mapping[str, tuple] | None = None, required: Sequence[str] = ("customerID",)) -> Column:
    """Array of violated rule names (nulls pass range rules, fail ``required``)."""
    bounds = bounds or S.REQUEST_BOUNDS
    checks = []
    for c in required:
        checks.append(F.when(F.col(c).isNull(), F.lit(f"{c}:required")))
    for c, (lo, hi) in bounds.items():
        if lo is not None:
            checks.append(F.when(F.col(c) < F.lit(lo), F.lit(f"{c}:min")))
        if hi is not None:
            checks.append(F.when(F.col(c) > F.lit(hi), F.lit(f"{c}:max")))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def range_quarantine(df: DataFrame, bounds: Mapping[str, tuple] | None = None,
                     required: Sequence[str] = ("customerID",)) -> tuple[DataFrame, DataFrame]:
    """Split rows into (valid, quarantined-with-``violations``).

    The split is an OR of plain comparisons (generated code); the array of
    rule names is built for rejected rows only. Cache the input upstream if
    both outputs are consumed by separate actions.
    """
    rejected = is_rejected(bounds, required)
    return df.filter(~rejected), df.filter(rejected).withColumn("violations", violations(bounds, required))


# -- composed stages ---------------------------------------------------------

def ingest_coerced(raw: DataFrame) -> DataFrame:
    """Ingest stage before the fill: strip strings, TotalCharges to number."""
    return coerce_numeric(trim_strings(raw), ["TotalCharges"])


def _sql_text(s: str) -> str:
    """A SQL string literal of any text."""
    return "'" + "".join(c if c.isalnum() or c in " ()-:" else f"\\u{ord(c):04x}" for c in s) + "'"


def ingest_clean(raw: DataFrame) -> DataFrame:
    """Ingest stage: strip strings, TotalCharges to number, blanks to 0.0 (one
    select of SQL text: the plan is analysed once)."""
    out = []
    for name, dtype in raw.dtypes:
        e = f"btrim(`{name}`, {_sql_text(C.WHITESPACE)})" if dtype == "string" else f"`{name}`"
        if name == "TotalCharges":
            e = f"nanvl(coalesce(try_cast({e} AS DOUBLE), 0.0D), 0.0D)"
        out.append(f"{e} AS `{name}`")
    return raw.selectExpr(*out)


def _encode_sql(col: str, mapping: Mapping[str, int]) -> str:
    """:func:`yes_no_encode` as SQL: the source text is read once, in a map lookup."""
    entries = ", ".join(f"{_sql_text(k)}, {v}" for k, v in mapping.items())
    unknown = f"raise_error(concat('unmapped value in {col}: ', coalesce(CAST(`{col}` AS STRING), 'NULL')))"
    return f"CAST(coalesce(try_element_at(map({entries}), `{col}`), {unknown}) AS TINYINT)"


def build_features(clean: DataFrame) -> DataFrame:
    """Preprocess stage: encode, one-hot, derive, project (29 columns).

    The chain of the single operators above, as two selects of SQL text: the
    flags, then what is derived from them.
    """
    first = {c: f"`{c}`" for c in ("customerID", "tenure", "MonthlyCharges", "TotalCharges")}
    first["SeniorCitizen"] = "CAST(SeniorCitizen AS TINYINT)"
    first["Churn"] = _encode_sql("Churn", S.TARGET_MAP)
    first.update({c: _encode_sql(c, S.BINARY_MAP) for c in S.BINARY_COLUMNS})
    first.update({name: f"CAST(coalesce(`{src}` = {_sql_text(val)}, false) AS TINYINT)" for name, src, val in S.ONE_HOT_SPEC})
    bins = " ".join(f"WHEN tenure <= {edge} THEN {_sql_text(label)}" for edge, label in zip(S.TENURE_EDGES, S.TENURE_LABELS))
    first["tenure_group"] = f"CASE {bins} ELSE {_sql_text(S.TENURE_LABELS[-1])} END"
    first["charges_per_month"] = ("rint((CASE WHEN tenure > 0 THEN TotalCharges / tenure ELSE MonthlyCharges END) * 10000.0D) "
                                  "/ 10000.0D")
    derived = {
        "has_internet": "CAST(InternetService_No = 0 AS TINYINT)",
        "num_services": f"CAST({' + '.join(f'coalesce(CAST(`{c}` AS INT), 0)' for c in S.SERVICE_COLUMNS)} AS TINYINT)",
    }
    flags = clean.selectExpr(*[f"{e} AS `{c}`" for c, e in first.items()])
    return flags.selectExpr(*[f"{derived.get(c, f'`{c}`')} AS `{c}`" for c in S.FEATURE_TABLE_COLUMNS])
