"""Column-expression helpers (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DAY0 = "1970-01-01"
_SUNDAY0 = "1970-01-04"  # first Sunday of the epoch; week labels are Sundays


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI division would raise)."""
    return F.try_divide(_c(a), _c(b))


def safe_ln(x) -> Column:
    """ln(x) for x > 0, else NULL (NumPy gives -inf/NaN there; both export as null)."""
    x = _c(x)
    return F.when(x > 0, F.ln(x))


def finite_or_null(x) -> Column:
    """NaN and +-inf -> NULL (export rule for every double column)."""
    x = _c(x)
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double")).otherwise(x)


def round_doubles(df: DataFrame, scale: int = 6, overrides: dict | None = None) -> DataFrame:
    """Round every double column (sums are order-sensitive in the last bits)."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            s = overrides.get(f.name, scale)
            if s is None:
                cols.append(F.col(f.name))
            elif isinstance(s, str) and s.startswith("s"):
                cols.append(round_sig(F.col(f.name), int(s[1:])).alias(f.name))
            else:
                cols.append(round_half_up(F.col(f.name), s).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def round_half_up(x, scale: int) -> Column:
    """Decimal rounding by plain IEEE arithmetic, floor(x * 10^s + 0.5) / 10^s,
    so that any engine evaluating the same formula on the same double gets the
    same result (built-in ROUND functions differ in how they see the double).
    Magnitudes where the scale exceeds double precision are left as they are."""
    x = finite_or_null(_c(x))
    m = float(10 ** scale)
    return F.when(F.abs(x) < F.lit(10.0 ** (15 - scale)), F.floor(x * F.lit(m) + F.lit(0.5)) / F.lit(m)).otherwise(x)


def round_sig(x, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits (for unbounded magnitudes such
    as percentage errors of near-zero values), via scientific notation text."""
    x = finite_or_null(_c(x))
    return F.when(x.isNotNull(), F.format_string(f"%.{digits - 1}e", x).cast("double"))


def strip_suffix(entity, suffix: str = ".SA") -> Column:
    """Exchange suffix removal for display (``PETR4.SA`` -> ``PETR4``)."""
    return F.regexp_replace(_c(entity), re.escape(suffix) + "$", "")


# ---------------------------------------------------------------- calendars
def period_label(ts, freq: str) -> Column:
    """Label of the resample bin that holds ``ts``.

    W: the Sunday ending the week; D: the day; h: the hour start;
    ME/QE/YE: the last day of the month/quarter/year.
    """
    ts = _c(ts)
    d = F.to_date(ts)
    if freq == "W":
        return F.next_day(F.date_sub(d, 1), "SUN")
    if freq == "D":
        return d
    if freq == "h":
        return F.date_trunc("hour", ts)
    if freq in ("ME", "M"):
        return F.last_day(d)
    if freq in ("QE", "Q"):
        return F.last_day(F.make_date(F.year(d), F.quarter(d) * 3, F.lit(1)))
    if freq in ("YE", "Y"):
        return F.make_date(F.year(d), F.lit(12), F.lit(31))
    raise ValueError(freq)


def period_index(label, freq: str) -> Column:
    """Integer position of a bin label on a regular calendar (consecutive bins differ by 1)."""
    label = _c(label)
    if freq == "W":
        return F.floor(F.datediff(label, F.lit(_SUNDAY0).cast("date")) / 7).cast("long")
    if freq == "D":
        return F.datediff(label, F.lit(_DAY0).cast("date")).cast("long")
    if freq == "h":
        return F.floor(F.unix_seconds(label) / 3600).cast("long")
    if freq in ("ME", "M"):
        return (F.year(label) * 12 + F.month(label) - 1).cast("long")
    if freq in ("QE", "Q"):
        return (F.year(label) * 4 + F.quarter(label) - 1).cast("long")
    if freq in ("YE", "Y"):
        return F.year(label).cast("long")
    raise ValueError(freq)


def label_from_index(idx, freq: str) -> Column:
    idx = _c(idx)
    if freq == "W":
        return F.date_add(F.lit(_SUNDAY0).cast("date"), (idx * 7).cast("int"))
    if freq == "D":
        return F.date_add(F.lit(_DAY0).cast("date"), idx.cast("int"))
    if freq == "h":
        return F.timestamp_seconds(idx * 3600)
    if freq in ("ME", "M"):
        return F.last_day(F.make_date(F.floor(idx / 12).cast("int"), (idx % 12 + 1).cast("int"), F.lit(1)))
    if freq in ("QE", "Q"):
        return F.last_day(F.make_date(F.floor(idx / 4).cast("int"), ((idx % 4) * 3 + 3).cast("int"), F.lit(1)))
    if freq in ("YE", "Y"):
        return F.make_date(idx.cast("int"), F.lit(12), F.lit(31))
    raise ValueError(freq)


# ---------------------------------------------------------------- distributions
# Fixed coefficients of Acklam's rational approximation of the inverse normal
# CDF (published algorithm; relative error below 1.2e-9).
ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549671430768549e+00, 4.374664141464968e+00, 2.938163982698783e+00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00)
ACKLAM_PLOW = 0.02425


def _horner(coefs, x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def norm_ppf(p) -> Column:
    """Inverse standard normal CDF as a column expression (NULL outside (0,1))."""
    p = _c(p)
    q_lo = F.sqrt(F.lit(-2.0) * F.ln(p))
    lo = _horner(ACKLAM_C, q_lo) / (_horner(ACKLAM_D, q_lo) * q_lo + F.lit(1.0))
    q_hi = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - p))
    hi = -(_horner(ACKLAM_C, q_hi) / (_horner(ACKLAM_D, q_hi) * q_hi + F.lit(1.0)))
    q = p - F.lit(0.5)
    r = q * q
    mid = _horner(ACKLAM_A, r) * q / (_horner(ACKLAM_B, r) * r + F.lit(1.0))
    return (F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
             .when(p < ACKLAM_PLOW, lo)
             .when(p > 1 - ACKLAM_PLOW, hi)
             .otherwise(mid))


def norm_ppf_sql(p: str) -> str:
    """The same approximation as SQL text (for oracles and ``selectExpr``)."""
    def horner(coefs, x):
        acc = repr(coefs[0])
        for c in coefs[1:]:
            acc = f"(({acc}) * {x} + {c!r})"
        return acc
    qlo = f"sqrt(-2.0 * ln({p}))"
    qhi = f"sqrt(-2.0 * ln(1.0 - {p}))"
    r = f"(({p} - 0.5) * ({p} - 0.5))"
    lo = f"({horner(ACKLAM_C, qlo)} / ({horner(ACKLAM_D, qlo)} * {qlo} + 1.0))"
    hi = f"(-({horner(ACKLAM_C, qhi)} / ({horner(ACKLAM_D, qhi)} * {qhi} + 1.0)))"
    mid = f"({horner(ACKLAM_A, r)} * ({p} - 0.5) / ({horner(ACKLAM_B, r)} * {r} + 1.0))"
    return (f"(CASE WHEN {p} <= 0 OR {p} >= 1 THEN NULL WHEN {p} < {ACKLAM_PLOW} THEN {lo} "
            f"WHEN {p} > {1 - ACKLAM_PLOW} THEN {hi} ELSE {mid} END)")


def chi2_sf_even(x, df: int) -> Column:
    """Upper tail of chi-square with an even number of degrees of freedom:
    exp(-x/2) * sum_{i<df/2} (x/2)^i / i!  (closed form)."""
    if df <= 0 or df % 2:
        raise ValueError("closed form needs an even df")
    h = _c(x) / 2
    terms = F.lit(0.0)
    for i in range(df // 2):
        terms = terms + F.pow(h, F.lit(float(i))) / F.lit(float(math.factorial(i)))
    return F.exp(-h) * terms


#: Terms of the power series of erf (used up to ERFC_SPLIT) and levels of the continued
#: fraction of erfc (beyond); with these both are exact to about 1e-15 at the split.
ERF_TERMS, ERFC_LEVELS, ERFC_SPLIT = 50, 60, 2.5


def erfc_sql(x: str) -> str:
    """Complementary error function of a non-negative column, as SQL text. Up to the split
    1 - erf by its series of positive terms, 2x/sqrt(pi) e^(-x^2) (1 + 2x^2/3 (1 + 2x^2/5 (...)));
    beyond it the continued fraction e^(-x^2)/sqrt(pi) / (x + 1/2 / (x + 2/2 / (x + ...)))."""
    series = "1.0"
    for n in range(ERF_TERMS, 0, -1):
        series = f"(1.0 + 2.0 * {x} * {x} / {2.0 * n + 1.0} * {series})"
    fraction = f"{x}"
    for n in range(ERFC_LEVELS, 0, -1):
        fraction = f"({x} + {n / 2.0} / {fraction})"
    root = repr(math.sqrt(math.pi))
    return (f"(CASE WHEN {x} <= {ERFC_SPLIT} THEN 1.0 - 2.0 * {x} / {root} * exp(-{x} * {x}) * {series} "
            f"ELSE exp(-{x} * {x}) / {root} / {fraction} END)")


def chi2_sf(x: str, df: str, most: int) -> Column:
    """Upper tail of chi-square for 1 to ``most`` degrees of freedom, both given as column
    names: the finite sums of the even and the odd case, chosen by row. NULL for other df."""
    h = f"({x} / 2.0)"
    odd_tail, density = "erfc_half", "odd_density"
    even, odd = "1.0", "0.0"
    branches = []
    for k in range(1, most + 1):
        if k % 2:
            if k >= 3:  # sqrt(x) x^((k-3)/2) / (1 3 5 .. (k-2))
                odd += f" + sqrt({x}) * pow({x}, {(k - 3) // 2}) / {float(math.prod(range(1, k - 1, 2)))}"
            branches.append(f"WHEN {k} THEN {odd_tail} + {density} * ({odd})")
        else:
            if k >= 4:
                even += f" + pow({h}, {k // 2 - 1}) / {float(math.factorial(k // 2 - 1))}"
            branches.append(f"WHEN {k} THEN exp(-{h}) * ({even})")
    text = f"CASE {df} " + " ".join(branches) + " END"
    text = text.replace(odd_tail, erfc_sql(f"sqrt({h})")).replace(density, f"(2.0 * exp(-{h}) / {math.sqrt(2 * math.pi)!r})")
    # (double literals: a decimal one would bring fixed-point arithmetic in)
    return F.expr(re.sub(r"(?<![\w.])(\d+\.\d+(?:[eE][-+]?\d+)?)", r"\1D", text))
