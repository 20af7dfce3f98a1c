"""Thresholds and fixed tables of the operators. Fixed values, stated as the reference behaviour needs them."""

from __future__ import annotations

from dataclasses import dataclass

#: The 19 keypoints, in order.
KEYPOINTS = (
    "roof_apex", "side_window_top_front", "side_window_top_rear", "front_bumper", "rear_bumper",
    "front_wheel_center", "front_wheel_ground", "rear_wheel_center", "rear_wheel_ground",
    "fender_arch_front", "fender_arch_rear", "hood_edge", "body_waist_front", "body_waist_rear",
    "panel_front", "panel_rear", "windshield_base", "rear_glass_base", "ground_ref",
)
WHEELS = ("front_wheel_center", "front_wheel_ground", "rear_wheel_center", "rear_wheel_ground")
SEVEN = ("ground_ref", "front_wheel_center", "front_wheel_ground", "rear_wheel_center", "rear_wheel_ground", "front_bumper", "rear_bumper")
#: Template of a side view: label, x, y in pixels, confidence.
TEMPLATE = (
    ("roof_apex", 580.0, 222.0, 0.93), ("side_window_top_front", 800.0, 240.0, 0.91), ("side_window_top_rear", 432.0, 234.0, 0.89),
    ("front_bumper", 1045.0, 600.0, 0.91), ("rear_bumper", 55.0, 590.0, 0.90), ("front_wheel_center", 810.0, 770.0, 0.97),
    ("front_wheel_ground", 810.0, 864.0, 0.90), ("rear_wheel_center", 235.0, 770.0, 0.96), ("rear_wheel_ground", 235.0, 864.0, 0.89),
    ("fender_arch_front", 810.0, 582.0, 0.95), ("fender_arch_rear", 235.0, 582.0, 0.94), ("hood_edge", 985.0, 447.0, 0.89),
    ("body_waist_front", 938.0, 457.0, 0.90), ("body_waist_rear", 118.0, 468.0, 0.88), ("panel_front", 1000.0, 810.0, 0.86),
    ("panel_rear", 100.0, 810.0, 0.85), ("windshield_base", 835.0, 392.0, 0.93), ("rear_glass_base", 422.0, 368.0, 0.92),
    ("ground_ref", 810.0, 864.0, 0.90),
)
#: Pairs whose order along x follows the heading, and the partners of a left-right flip.
LOCKED_PAIRS = (
    ("front_bumper", "rear_bumper"), ("fender_arch_front", "fender_arch_rear"), ("side_window_top_front", "side_window_top_rear"),
    ("body_waist_front", "body_waist_rear"), ("panel_front", "panel_rear"),
)
FLIP_PAIRS = LOCKED_PAIRS + (("front_wheel_center", "rear_wheel_center"), ("front_wheel_ground", "rear_wheel_ground"))
#: Keypoints by the phase in which they are labelled. Fixed values.
PHASES = {
    "phase1": ("front_wheel_center", "front_wheel_ground", "rear_wheel_center", "rear_wheel_ground", "ground_ref"),
    "phase2": ("front_bumper", "rear_bumper", "roof_apex", "hood_edge", "windshield_base", "rear_glass_base", "side_window_top_front", "side_window_top_rear"),
    "phase3": ("fender_arch_front", "fender_arch_rear", "body_waist_front", "body_waist_rear", "panel_front", "panel_rear"),
}
#: What a warning takes off the quality score; any other takes 0.02.
PENALTIES = {
    "fallback_wheels": 0.10, "non_90_pov": 0.25, "phase1_low_confidence": 0.20, "invalid_geometry": 0.07,
    "invalid_wheelbase": 0.08, "wheel_misalignment": 0.08, "low_confidence": 0.06,
}
OTHER_PENALTY = 0.02
BAD_URL_PARTS = ("logo", "icon", "avatar", "profile", "banner", "ads", "sponsor")
BAD_URL_ENDS = (".svg", ".ai", ".eps")
VEHICLE_CLASSES = {1: "bicycle", 2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".webp")
#: Outcomes of the gate cascade, in the order of the gates.
OUTCOMES = (
    "rejected_dedup_clip", "rejected_download", "rejected_quality", "rejected_no_car", "rejected_truncated", "rejected_face",
    "rejected_not_real_photo", "rejected_interior", "rejected_not_clean", "rejected_angle", "rejected_view", "rejected_quota_full", "accepted",
)


@dataclass(frozen=True)
class SizeRules:
    min_long_edge: int = 150
    max_long_edge: int = 6000
    min_aspect: float = 1.10
    max_aspect: float = 4.00


@dataclass(frozen=True)
class RawPoolRules:
    min_long_edge: int = 220
    min_aspect: float = 1.10
    max_aspect: float = 3.20


@dataclass(frozen=True)
class BodyEndRules:
    outside_margin: float = 0.04
    min_overhang: float = 0.25
    max_overhang: float = 2.75
    min_wheelbase: float = 2.8
    max_wheelbase: float = 6.5


@dataclass(frozen=True)
class PixelRules:
    min_long_edge: int = 800
    max_aspect: float = 2.5
    min_blur: float = 100.0
    min_colors: int = 400
    min_brightness: float = 25.0
    max_brightness: float = 225.0
