"""From an hourly panel to a recovered daily panel."""

from tillcast.constants import WINDOW_DAYS
from tillcast.operators import hourly, recovery


def recover_panel(panel, mode="masked", imputer="ensemble", window_days=WINDOW_DAYS):
    """Add ``sale_amount_pred``: mask stockout hours, impute them, splice and sum."""
    masked = hourly.add_masked_hours(panel)
    if imputer == "regression":
        rows = hourly.normalize_covariates(hourly.add_window_index(masked, window_days))
        imputed = recovery.add_regression_imputation(rows, recovery.fit_regression(rows))
    else:
        imputed = recovery.add_profile_imputations(masked)
        if imputer == "ensemble":
            imputed = recovery.add_ensemble(imputed, recovery.ensemble_weights(masked))
    helpers = ["masked", "open_sale", "open_status", "window_idx", "day_in_window",
               *[c for c in imputed.columns if c.startswith("imputed_") or c.endswith("_norm")]]
    return recovery.recover(imputed, f"imputed_{imputer}", mode).drop(*helpers)
