"""Names, thresholds and lookup rows that results depend on.

They are data, not logic; change them only together with the expected results.
"""

from __future__ import annotations

# Sites and devices.
ROOMS = ["bedroom", "living_room", "bathroom", "kitchen", "studio"]
APPLIANCES = [
    "washing_machine", "refrigerator", "television", "microwave",
    "kettle", "computer", "dishwasher", "lighting",
]
ENVIRONMENT = ["temperature", "humidity", "occupancy"]
TOPIC_PREFIX = "home"
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Grid, split and model settings.
STEP = "5 minutes"
SAMPLES_PER_DAY = 288
TEST_RATIO = 0.2
FOLDS = 5
SEED = 42
LEARNING_FRACTIONS = [0.1, 0.2, 0.4, 0.6, 0.8, 1.0]
PERMUTATION_REPEATS = 50

# Acceptance limits.
R2_TARGET = 0.70
RMSE_TARGET = 100.0
MAE_TARGET = 70.0
SIGNIFICANCE = 0.05
GAP_OK = 0.01
GAP_MILD = 0.05
CV_STABLE_PCT = 5.0
ZERO_COEFFICIENT = 0.001
TOLERANCE = 0.20
KS_VERY_SIMILAR = 0.1
KS_SIMILAR = 0.3
CORR_STRONG = 0.5
CORR_MODERATE = 0.3
ACTIVE_WATTS = 10.0
STANDBY_WATTS = 1.0
UNOCCUPIED_LIMIT_PCT = 3.0
PEAK_FACTOR = 1.5
WEEKDAY_RANGE_WATTS = 5.0
SHAPIRO_SAMPLE = 5000

# Realism expectations per appliance:
# appliance, max W, mean W range, activations per day range, active threshold W,
# standby share range in percent, peak hours.
APPLIANCE_EXPECTATIONS = [
    ("kettle", 2500.0, 3.0, 30.0, 2.0, 10.0, 100.0, 94.0, 100.0, [7, 8, 10, 12, 15, 18]),
    ("microwave", 1500.0, 1.0, 20.0, 2.0, 8.0, 50.0, 94.0, 100.0, [7, 12, 18, 19]),
    ("washing_machine", 2500.0, 1.0, 15.0, 0.5, 5.0, 100.0, 95.0, 100.0, [9, 10, 11, 14]),
    ("dishwasher", 2500.0, 2.0, 25.0, 0.5, 4.0, 200.0, 95.0, 100.0, [20, 21]),
    ("television", 250.0, 8.0, 50.0, 15.0, 40.0, 30.0, 0.0, 5.0, [18, 19, 20, 21, 22]),
    ("computer", 500.0, 15.0, 80.0, 25.0, 55.0, 30.0, 0.0, 5.0, [9, 10, 11, 13, 14, 15, 16]),
    ("refrigerator", 300.0, 50.0, 100.0, 60.0, 120.0, 80.0, 0.0, 1.0, list(range(24))),
    ("lighting", 200.0, 5.0, 30.0, 25.0, 55.0, 15.0, 70.0, 92.0, [6, 7, 17, 18, 19, 20, 21, 22]),
]

# Power cap and phantom load in watts per appliance; 3000 W where none is listed.
APPLIANCE_LIMITS = [
    ("washing_machine", 2500.0, 0.0),
    ("refrigerator", 300.0, 0.0),
    ("television", 250.0, 15.0),
    ("microwave", 1500.0, 0.0),
    ("kettle", 2400.0, 0.0),
    ("computer", 500.0, 20.0),
    ("dishwasher", 2500.0, 0.0),
    ("lighting", 200.0, 10.0),
]
DEFAULT_MAX_POWER = 3000.0
DEFAULT_ACTIVATION = 0.0
PHANTOM_SPREAD_WATTS = 3.0

# Expected activation probability: appliance, is_weekend, {hour: probability}.
APPLIANCE_SCHEDULES = [
    ("washing_machine", 0, {9: 0.03, 10: 0.05, 11: 0.03, 14: 0.02}),
    ("washing_machine", 1, {9: 0.06, 10: 0.08, 11: 0.06, 14: 0.04}),
    ("television", 0, {12: 0.05, 13: 0.05, 18: 0.15, 19: 0.40, 20: 0.50, 21: 0.50,
                       22: 0.30, 23: 0.10}),
    ("television", 1, {10: 0.10, 11: 0.15, 12: 0.15, 13: 0.10, 14: 0.10, 15: 0.10,
                       18: 0.20, 19: 0.50, 20: 0.60, 21: 0.55, 22: 0.40, 23: 0.15}),
    ("microwave", 0, {7: 0.04, 13: 0.12, 18: 0.08, 19: 0.04}),
    ("microwave", 1, {9: 0.04, 13: 0.10, 14: 0.06, 18: 0.08, 19: 0.04}),
    ("kettle", 0, {8: 0.06, 13: 0.06, 16: 0.06, 18: 0.04, 20: 0.03}),
    ("kettle", 1, {8: 0.06, 9: 0.10, 11: 0.04, 13: 0.06, 15: 0.06, 18: 0.06, 20: 0.04}),
    ("computer", 0, {9: 0.60, 10: 0.70, 11: 0.70, 13: 0.70, 14: 0.70, 15: 0.60,
                     16: 0.50, 20: 0.10, 21: 0.10}),
    ("computer", 1, {10: 0.10, 11: 0.10, 14: 0.10, 15: 0.10, 20: 0.15, 21: 0.15}),
    ("dishwasher", 0, {20: 0.06, 21: 0.04}),
    ("dishwasher", 1, {13: 0.03, 20: 0.06, 21: 0.04}),
    ("lighting", 0, {6: 0.20, 7: 0.40, 8: 0.20, 17: 0.30, 18: 0.50, 19: 0.60,
                     20: 0.60, 21: 0.50, 22: 0.30}),
    ("lighting", 1, {8: 0.15, 9: 0.20, 17: 0.20, 18: 0.50, 19: 0.60, 20: 0.60,
                     21: 0.55, 22: 0.30, 23: 0.15}),
]

# Hyper-parameter grids.
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [10, 15, 20], "minSplit": [5, 10],
               "subsamplingRate": [0.5]}
MLP_GRID = {"hidden": [(64, 32), (128, 64), (128, 64, 32)], "activation": ["relu", "tanh"],
            "learningRate": [0.001, 0.01]}
MLP_EPOCHS = 500
MLP_HOLDOUT = 0.1
MLP_PATIENCE = 20
