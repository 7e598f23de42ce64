"""Business constants of the fleet model, in one place."""

from __future__ import annotations

# They define the published metrics and must not drift.
LAT_MIN, LAT_MAX = 29.5, 30.1
LON_MIN, LON_MAX = -95.8, -95.1
EARTH_RADIUS_MILES = 3958.8
IDLE_BELOW_MPH = 5
URGENCY_MEDIUM_AFTER_DAYS = 60
URGENCY_HIGH_AFTER_DAYS = 90

VEHICLE_CLASSES = ["light", "medium", "heavy"]
VEHICLE_STATUSES = ["active", "inactive", "maintenance"]
URGENCY_LEVELS = ["low", "medium", "high"]

# Serving defaults.
TOP_K = 10
DASHBOARD_DAYS = 30
DEFAULT_ROUTE_COUNT = 5

# The largest magnitude a landed double may have; a row beyond it is rejected. Sums of
# 10**7 such values stay exact even in a bigint; no speed, cost or coordinate comes near.
LARGEST_DOUBLE = 1.0e7
