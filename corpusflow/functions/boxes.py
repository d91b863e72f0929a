"""Column expressions over normalised bounding boxes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Page canvas in pixels, smallest drawable extent (share of the page, pixels),
# and the type of a block that names none.
CANVAS = (1536, 2048)
MIN_EXTENT = 0.001
MIN_PIXELS = 1
DEFAULT_TYPE = "DEFAULT"


def clamp01(x: Column) -> Column:
    """Value moved into [0, 1]; a missing coordinate counts as 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(x, F.lit(0.0))))


def corners(bbox: Column) -> dict[str, Column]:
    return {name: clamp01(bbox[name]) for name in ("xmin", "ymin", "xmax", "ymax")}


def ordered(box: dict[str, Column]) -> dict[str, Column]:
    """Inverted edges swapped."""
    return {
        "xmin": F.least(box["xmin"], box["xmax"]),
        "ymin": F.least(box["ymin"], box["ymax"]),
        "xmax": F.greatest(box["xmin"], box["xmax"]),
        "ymax": F.greatest(box["ymin"], box["ymax"]),
    }


def scaled(box: dict[str, Column], width: int, height: int) -> dict[str, Column]:
    return {
        "x0": box["xmin"] * width,
        "y0": box["ymin"] * height,
        "x1": box["xmax"] * width,
        "y1": box["ymax"] * height,
    }


def struct_of(parts: dict[str, Column], as_type: str | None = None) -> Column:
    return F.struct(*[(c.cast(as_type) if as_type else c).alias(n) for n, c in parts.items()])


def drawable(box: dict[str, Column], pixels: dict[str, Column]) -> Column:
    return (
        (box["xmax"] > box["xmin"] + MIN_EXTENT)
        & (box["ymax"] > box["ymin"] + MIN_EXTENT)
        & (pixels["x1"] > pixels["x0"] + MIN_PIXELS)
        & (pixels["y1"] > pixels["y0"] + MIN_PIXELS)
    )


def block_type(kind: Column) -> Column:
    return F.coalesce(kind, F.lit(DEFAULT_TYPE))
