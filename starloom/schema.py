"""Settings, rejection reasons and record schemas."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

# Fixed values of the file names and of the reasons in the rejection ledger.
FAILED_PREFIX = "failed_"
STACKED_PREFIX = "stacked-"
REASONS = ("failed_prefix", "stacked_prefix", "low_quality_score", "alignment_failed", "header_mismatch")
NATIVE_WIDTH, NATIVE_HEIGHT, NATIVE_BITPIX = 3840, 2160, 16

FRAME = "session int, frame_id long, height int, width int, data array<double>"
TRANSFORM = (
    "source_path string, reference_path string, success boolean, error_message string, "
    "matrix array<array<double>>, n_matches int"
)
TRANSFORMS_FILE = f"version string, reference string, metadata map<string,string>, transforms array<struct<{TRANSFORM.replace(' ', ':', 1)}>>"


def _require(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass(frozen=True)
class StackSettings:
    """Frame selection, registration and stacking of a session."""

    keep_fraction: float = 0.92
    saturation_threshold: float = 0.95
    reference: str = "best"
    debayer: str = "none"
    align: str = "astroalign"
    sigma: float = 3.0
    maxiters: int = 5
    max_align_fail: int = 50
    full_scale: float = 65535.0

    def validate(self) -> StackSettings:
        _require(0 < self.keep_fraction <= 1, "keep_fraction must be in (0, 1]")
        _require(self.sigma > 0, "sigma must be positive")
        _require(self.maxiters >= 1, "maxiters must be at least 1")
        _require(0 < self.saturation_threshold <= 1, "saturation_threshold must be in (0, 1]")
        _require(self.reference in ("best", "first"), "reference must be best or first")
        return self

    def fingerprint(self) -> str:
        """Short hash of the settings on which cached results depend."""
        # Fixed names: they make up the hashed text.
        own = {
            "keep_fraction": self.keep_fraction,
            "sigma": self.sigma,
            "maxiters": self.maxiters,
            "reference": self.reference,
            "debayer": self.debayer,
            "backend_align": self.align,
        }
        return hashlib.md5(json.dumps(own, sort_keys=True).encode()).hexdigest()[:12]


@dataclass(frozen=True)
class LuminanceSettings:
    """Background, noise, stretch and contrast of a stacked luminance image."""

    subtract_bg: bool = True
    bg_cell_size: int = 64
    bg_model: str = "polynomial"
    reduce_noise: bool = False
    noise_method: str = "median"
    noise_filter_size: int = 3
    stretch_mode: str = "two_stage"
    asinh_stretch: float = 0.1
    enhance_contrast: bool = True
    contrast_scale: int = 50
    contrast_strength: float = 0.3
    protect_stars: bool = True

    def validate(self) -> LuminanceSettings:
        _require(self.bg_cell_size >= 16, "bg_cell_size must be at least 16")
        _require(self.bg_model in ("polynomial", "spline"), "unknown bg_model")
        _require(self.noise_filter_size >= 1, "noise_filter_size must be at least 1")
        _require(0 < self.asinh_stretch <= 1, "asinh_stretch must be in (0, 1]")
        _require(self.contrast_scale >= 1, "contrast_scale must be at least 1")
        _require(0 <= self.contrast_strength <= 1, "contrast_strength must be in [0, 1]")
        _require(self.noise_method in ("median", "gaussian", "bilateral"), "unknown noise_method")
        _require(self.stretch_mode in ("single", "two_stage"), "unknown stretch_mode")
        return self
