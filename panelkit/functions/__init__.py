from panelkit.functions.scalar import (  # noqa: F401
    chi2_sf_even, finite_or_null, label_from_index, norm_ppf, period_index,
    period_label, round_doubles, safe_div, safe_ln, strip_suffix,
)
