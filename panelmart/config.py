"""Panel configuration: keys, year range, event periods, donors, labels.

Everything that the reference hard-codes or reads from its environment is a
field here, so the same operators serve any entity x period panel.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- fixed values (must equal the reference's labels and defaults) ---------
# Quartile labels for the LST and density quartiles: Q1, Q2, Q3, Q4
QUARTILE_LABELS = ("Q1", "Q2", "Q3", "Q4")
# Incidence quartile labels (integers): 1, 2, 3, 4
IR_QUARTILE_LABELS = (1, 2, 3, 4)
# Water-body tier labels (thirds of ndmi): Low, Med, High
TIER_LABELS = ("Low", "Med", "High")
# Density tier per quartile: Q1 Rendah, Q2 Sedang, Q3 Tinggi, Q4 Sangat Tinggi
DENSITY_TIER_LABELS = ("Rendah", "Sedang", "Tinggi", "Sangat Tinggi")
# NDVI classes: below 0.4 Sparse, up to and including 0.6 Moderate, above Dense
NDVI_CLASSES = ("Sparse", "Moderate", "Dense")
NDVI_SPARSE_BELOW = 0.4
NDVI_MODERATE_UPTO = 0.6
# Period labels: event (pandemic) years 'Pandemi', others 'Normal'
EVENT_LABEL = "Pandemi"
NORMAL_LABEL = "Normal"
# Surge rule: growth > 50 and rain z-score > 1.5 -> 'HIGH RISK' else 'Normal'
SURGE_GROWTH_ABOVE = 50.0
SURGE_ZSCORE_ABOVE = 1.5
SURGE_LABEL = "HIGH RISK"
SURGE_NORMAL_LABEL = "Normal"
# Vulnerability index weights: rain z 0.3, lst z 0.25, density z 0.25,
# (1 - ndvi z) 0.2; the sample-std z-score adds 1e-9 to the divisor
CVI_WEIGHTS = (0.3, 0.25, 0.25, 0.2)
SAMPLE_Z_EPSILON = 1e-9
# Incidence per 100,000 population
INCIDENCE_PER = 100000.0
# Default province constants of the region dimension
PROVINCE_CODE = "32"
PROVINCE_NAME = "JAWA BARAT"
# Default donors (target <- donor): 3217 <- 3204, 3218 <- 3207
DEFAULT_DONORS = (("3217", "3204"), ("3218", "3207"))
# Default range and events: 2019-2024, events 2020 and 2021; 27 regions
DEFAULT_YEAR_START = 2019
DEFAULT_YEAR_END = 2024
DEFAULT_EVENT_PERIODS = (2020, 2021)
DEFAULT_EXPECTED_ENTITIES = 27
MIN_ROW_FRACTION = 0.80
RUN_STATUS_SUCCESS = "SUCCESS"
# ---------------------------------------------------------------------------

ENV_VARS = ("rainfall_annual", "lst_celsius", "ndvi", "ndmi")


@dataclass(frozen=True)
class PanelConfig:
    """Declared keys and parameters of one panel.

    ``entity`` / ``period`` name the grain columns; ``name`` is the entity's
    display name.  ``donors`` is a tuple of (target, donor) entity codes.
    ``on_duplicate_edges`` decides what happens when a quantile bin has equal
    edges: "error" (raise, the reference's behaviour), "null" (null label for
    the whole group) or "collapse" (plain right-closed compare).
    """

    entity: str = "kode_bps"
    period: str = "tahun"
    name: str = "nama_kabupaten_kota"
    year_start: int = DEFAULT_YEAR_START
    year_end: int = DEFAULT_YEAR_END
    event_periods: tuple[int, ...] = DEFAULT_EVENT_PERIODS
    donors: tuple[tuple[str, str], ...] = DEFAULT_DONORS
    env_vars: tuple[str, ...] = ENV_VARS
    expected_entities: int | None = DEFAULT_EXPECTED_ENTITIES
    min_row_fraction: float = MIN_ROW_FRACTION
    province_code: str = PROVINCE_CODE
    province_name: str = PROVINCE_NAME
    on_duplicate_edges: str = "error"
    # "distinct_values": tier only when >= 3 distinct non-null ndmi values in
    # the period (the evident intent); "reference": always null
    tier_guard: str = "distinct_values"
    growth_pad: bool = True
    # how quantile edges are found: "sort" and "count" exactly, "sketch"
    # approximately (see operators.quantiles.add_bins)
    quantiles: str = "sort"

    def __post_init__(self):
        if self.year_start > self.year_end:
            raise ValueError(f"year_start {self.year_start} > year_end {self.year_end}")
        if self.on_duplicate_edges not in ("error", "null", "collapse"):
            raise ValueError(f"on_duplicate_edges must be error, null or collapse: "
                             f"{self.on_duplicate_edges!r}")
        if self.tier_guard not in ("distinct_values", "reference"):
            raise ValueError(f"tier_guard must be distinct_values or reference: {self.tier_guard!r}")
        if self.quantiles not in ("sort", "count", "sketch"):
            raise ValueError(f"quantiles must be sort, count or sketch: {self.quantiles!r}")
        if not 0.0 <= self.min_row_fraction <= 1.0:
            raise ValueError(f"min_row_fraction must be within [0, 1]: {self.min_row_fraction}")
        targets = [t for t, _ in self.donors]
        if len(set(targets)) != len(targets):
            raise ValueError(f"a target entity has more than one donor: {self.donors}")

    @property
    def n_years(self) -> int:
        return self.year_end - self.year_start + 1

    def with_(self, **kw) -> "PanelConfig":
        return replace(self, **kw)
