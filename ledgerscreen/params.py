"""All tunables of the screen in one frozen dataclass.

FIXED VALUES: the defaults below (thresholds, rule names, reason texts, severity
weights, model size) are the values the screen must use to reproduce the
expected results; they are stated here once, in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# FIXED VALUES -- rule names, in the order rules are reported.
RULE_NAMES = (
    "duplicate",
    "round_number",
    "off_hours_weekend",
    "vendor_concentration",
    "statistical_outlier",
    "month_end_late_hour_posting",
)

# FIXED VALUES -- severity weight per rule; unknown rule names get UNKNOWN_SEVERITY.
SEVERITY = {
    "duplicate": 0.90,
    "statistical_outlier": 0.80,
    "vendor_concentration": 0.70,
    "round_number": 0.55,
    "month_end_late_hour_posting": 0.50,
    "off_hours_weekend": 0.40,
}
UNKNOWN_SEVERITY = 0.30

# FIXED VALUES -- reason texts (the concentration text embeds the threshold,
# the outlier text embeds the account).
REASON_DUPLICATE = "Duplicate vendor+amount+date combination"
REASON_ROUND = "Round-number amount"
REASON_OFF_HOURS = "Posted on weekend or outside business hours"
REASON_CONCENTRATION = "Vendor concentration risk (>{pct}% of total spend)"
REASON_OUTLIER = "Statistical outlier for account '{account}' (IQR method)"
REASON_MONTH_END = "Month-end late-hour posting"

# FIXED VALUES -- ordered risk levels and their ranks.
RISK_LEVELS = ("Low", "Medium", "High")

# FIXED VALUES -- planted anomaly kinds with their counts per 8,000 base rows.
PLANT_KINDS = (
    ("duplicate", 15),
    ("round_number", 20),
    ("off_hours_weekend", 18),
    ("vendor_concentration", 35),
    ("statistical_outlier", 12),
    ("month_end_spike", 40),
)
PLANT_BASE_ROWS = 8000
ROUND_AMOUNTS = (50000.0, 100000.0, 200000.0, 250000.0, 500000.0)
OFF_HOURS_NIGHT = (1, 2, 3, 23)
MONTH_END_MONTHS = (3, 6, 9, 12)


@dataclass(frozen=True)
class Params:
    # rules
    round_base: float = 10000.0
    round_min: float = 10000.0
    business_start_hour: int = 7      # hour < 7 is off-hours
    business_end_hour: int = 20       # hour > 20 is off-hours (20:59 is in hours)
    concentration_pct: float = 8.0
    q_low: float = 0.25
    q_high: float = 0.75
    iqr_mult: float = 1.5
    month_end_day: int = 28
    late_hour: int = 18
    # Benford
    benford_threshold: float = 0.08
    benford_alpha: float = 0.05
    # near-duplicate entries
    near_amount: float = 5.0
    near_days: int = 3
    # posting volume
    volume_days: int = 28
    volume_least_days: int = 7
    volume_limit: float = 3.5
    # isolation forest
    n_trees: int = 200
    max_samples: int = 256
    contamination: float = 0.05
    seed: int = 42
    # risk blend
    rule_weight: float = 0.5
    ml_weight: float = 0.5
    high_cut: float = 0.7
    medium_cut: float = 0.4
    # planting
    plant_seed: int = 42
    shell_vendor: str = "SHELL TRADING LTD"
    shell_department: str = "MACHINERY"
    shell_account: str = "PROMO"
    month_end_department: str = "HOUSEHOLD"
    categorical_cols: tuple = field(default=("department", "account", "entry_type"))

    @property
    def concentration_reason(self) -> str:
        return REASON_CONCENTRATION.format(pct=self.concentration_pct)


DEFAULT_PARAMS = Params()
