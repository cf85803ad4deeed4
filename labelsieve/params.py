"""Run parameters (one frozen dataclass) and the fixed category dimension."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# They must equal the reference's to give the same results.
# Category name -> class id of the detection label set (13 classes).
CATEGORY_IDS = {
    "pedestrian": 0,
    "rider": 1,
    "car": 2,
    "truck": 3,
    "bus": 4,
    "train": 5,
    "motorcycle": 6,
    "bicycle": 7,
    "traffic light": 8,
    "traffic sign": 9,
    "other person": 10,
    "other vehicle": 11,
    "trailer": 12,
}
# Image size in pixels used to normalise boxes.
IMAGE_WIDTH = 1280
IMAGE_HEIGHT = 720
# Inclusive confidence band counted as "ambiguous".
AMBIGUOUS_LOW = 0.3
AMBIGUOUS_HIGH = 0.7
# Seed of the split and of the random baseline.
SEED = 42
# Sentinel class id of a frame the model found nothing in.
SENTINEL_CLASS = -1
# Tolerance on the sum of the split fractions.
FRACTION_TOLERANCE = 0.01
# Default split fractions, model batch, confidence floor, label budget and cap per group.
SEED_FRACTION = 0.05
UNLABELED_FRACTION = 0.90
VAL_FRACTION = 0.05
BATCH = 16
CONF_THRESHOLD = 0.25
LABEL_BUDGET = 2000
MAX_PER_SCENE = 5
# ---------------------------------------------------------------------------
# The published IoU grid .50:.05:.95 of mAP50-95, written out.
IOU_THRESHOLDS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)


@dataclass(frozen=True)
class Params:
    image_width: int = IMAGE_WIDTH
    image_height: int = IMAGE_HEIGHT
    seed_fraction: float = SEED_FRACTION
    unlabeled_fraction: float = UNLABELED_FRACTION
    val_fraction: float = VAL_FRACTION
    seed: int = SEED
    batch: int = BATCH
    conf_threshold: float = CONF_THRESHOLD
    label_budget: int = LABEL_BUDGET
    max_per_scene: int = MAX_PER_SCENE
    band_low: float = AMBIGUOUS_LOW
    band_high: float = AMBIGUOUS_HIGH
    weights: dict = field(default_factory=lambda: {"uncertainty": 1.0, "rare_class": 1.0})

    def check_fractions(self) -> None:
        total = self.seed_fraction + self.unlabeled_fraction + self.val_fraction
        if abs(total - 1.0) > FRACTION_TOLERANCE:
            raise ValueError(f"split fractions sum to {total:.2f}, expected 1.0")
