"""Fixed values shared by the operators."""

# Identifier columns, coarse to fine.
HIERARCHY_COLS = ("state_id", "store_id", "cat_id", "dept_id", "item_id")
SERIES_COLS = ("store_id", "item_id")

# The twelve aggregation levels and their display names.
LEVELS = {
    1: (),
    2: ("state_id",),
    3: ("store_id",),
    4: ("cat_id",),
    5: ("dept_id",),
    6: ("state_id", "cat_id"),
    7: ("state_id", "dept_id"),
    8: ("store_id", "cat_id"),
    9: ("store_id", "dept_id"),
    10: ("item_id",),
    11: ("state_id", "item_id"),
    12: ("store_id", "item_id"),
}
LEVEL_NAMES = {
    1: "Total",
    2: "State",
    3: "Store",
    4: "Category",
    5: "Department",
    6: "State_x_Cat",
    7: "State_x_Dept",
    8: "Store_x_Cat",
    9: "Store_x_Dept",
    10: "Item",
    11: "State_x_Item",
    12: "Store_x_Item",
}

# The sliding window of days kept from the wide table, the
# burn-in that the largest lag costs, and the forecast horizon.
WINDOW_DAYS = 500
HORIZON_DAYS = 28

# Feature settings.
LAGS = (7, 14, 28)
ROLLING_WINDOWS = (7, 28, 60)
WEEK_PERIOD = 7
MONTH_PERIOD = 12
EVENT_COLS = ("event_name_1", "event_type_1", "event_name_2", "event_type_2")
NO_EVENT = "NoEvent"

# Columns that are not model inputs.
NON_FEATURE_COLS = (
    "id",
    "d",
    "date",
    "sales",
    "weekday",
    "event_name_1",
    "event_name_2",
    "event_type_1",
    "event_type_2",
)

# Settings of the global regressor. A tree of depth 7 has the
# nearest power-of-two leaf count to the 127 leaves asked for.
TWEEDIE_POWER = 1.1
N_TREES = 500
LEARNING_RATE = 0.05
TREE_DEPTH = 7
MIN_ROWS_PER_LEAF = 100
SAMPLE_FRACTION = 0.7
SEED = 42

# Run names in the run log, by prediction column.
RUN_NAMES = {
    "pred": "baseline_lgbm_sku",
    "pred_bu": "reconciliation_bottom_up",
    "pred_td": "reconciliation_top_down",
    "pred_mint": "reconciliation_mintrace",
}
METHOD_NAMES = {
    "pred": "Baseline",
    "pred_bu": "Bottom-Up",
    "pred_td": "Top-Down",
    "pred_mint": "MinTrace",
}

# Fixed value: rough bytes per long-format row used by the size estimate.
BYTES_PER_LONG_ROW = 50
