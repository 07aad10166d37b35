"""Constants of the traffic model."""

from __future__ import annotations

from typing import NamedTuple


class Zone(NamedTuple):
    """A counting rectangle in the 640 x 480 space; ``ord`` decides ties."""

    ord: int
    name: str
    x1: int
    y1: int
    x2: int
    y2: int


# ---- fixed values: they must be these for results to agree ----------------------------------
FLUIDO, DENSO, COLAPSO = "FLUIDO", "DENSO", "COLAPSO"
STATES = (FLUIDO, DENSO, COLAPSO)
SUBIENDO, BAJANDO, ESTABLE = "SUBIENDO", "BAJANDO", "ESTABLE"
COLAPSO_INICIO, COLAPSO_FIN = "COLAPSO_INICIO", "COLAPSO_FIN"

DENSE_FROM = 5
COLLAPSE_FROM = 10
RISING_FACTOR = 1.2
FALLING_FACTOR = 0.8

RUSH_HOURS = ((7, 9), (13, 15), (17, 19))
PEAK_HOURS = (11, 16)
CONGESTION_BY_HOUR = {
    8: 0.203, 9: 0.163, 10: 0.238, 11: 0.322, 12: 0.437, 13: 0.460,
    14: 0.365, 15: 0.433, 16: 0.420, 17: 0.219, 18: 0.098, 19: 0.056,
}
CONGESTION_DEFAULT = 0.15

TARGET_W, TARGET_H = 640, 480
PAD_VALUE = 114
ZONES = (
    Zone(0, "tramo1_rotonda", 413, 246, 640, 404),
    Zone(1, "tramo2_rotonda", 184, 200, 409, 337),
    Zone(2, "tramo3_rotonda", 3, 158, 179, 296),
)
MASK_POLYGON = (
    (638, 304), (539, 274), (495, 262), (459, 249), (437, 245), (411, 244), (386, 239),
    (365, 228), (349, 226), (323, 222), (299, 221), (277, 221), (245, 222), (227, 222),
    (209, 216), (194, 210), (168, 204), (150, 204), (136, 203), (121, 197), (106, 196),
    (83, 192), (68, 199), (37, 203), (17, 206), (7, 209), (5, 275), (94, 274),
    (141, 289), (209, 305), (272, 313), (331, 327), (368, 346), (418, 361), (473, 381),
    (508, 389), (536, 396), (577, 410), (601, 411), (624, 419), (633, 420), (639, 423),
)

VEHICLE_CLASSES = {2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}
MIN_CONFIDENCE = 0.20
NMS_IOU = 0.45
BEST_ZONE_MIN_OVERLAP = 0.25
COUNT_MIN_OVERLAP = 0.5

WINDOW_SECONDS = 300
SLIDE_SECONDS = 30
FORECAST_WINDOWS = 4
FORECAST_DENSE_ABOVE = 3

VISUAL_STATS = (
    "brightness_mean", "brightness_std", "saturation_mean", "edge_density", "gray_contrast",
)
META_FEATURES = (
    "hour", "weekday", "minute", "is_rush_hour", "vehicle_count",
    "congestion_hour_score", "is_peak_hour",
)
LABEL_FIELDS = (
    "filename", "timestamp", "weekday", "weekday_name", "hour", "minute",
    "is_rush_hour", "estado", "vehicle_count",
)
# ---- end of fixed values ---------------------------------------------------------------------

SEVERITY = {state: rank for rank, state in enumerate(STATES)}
VISUAL_FEATURES = tuple(f"{zone.name}_{stat}" for zone in ZONES for stat in VISUAL_STATS)
FEATURES = META_FEATURES + VISUAL_FEATURES
