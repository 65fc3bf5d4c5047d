"""Depth maps and masks as flat row-major arrays, in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def f32(x: Column) -> Column:
    return x.cast("float")


def focal_scale(fx: Column, fy: Column, camera_w: Column, camera_h: Column, depth_w: Column, depth_h: Column) -> Column:
    """Mean focal length at the depth map's size; null if a part is missing."""
    return (fx * depth_w / camera_w + fy * depth_h / camera_h) / 2


def metric_depth(raw: Column, focal: Column) -> Column:
    return F.transform(raw, lambda x: f32(x.cast("double") * focal / 300))


def relative_depth(raw: Column) -> Column:
    low, high = F.array_min(raw), F.array_max(raw)
    return F.transform(raw, lambda x: f32(f32(x - low) / f32(f32(high - low) + F.lit(1e-8).cast("float"))))


def metric_steps(depth: Column) -> Column:
    """Millimetres, 0 to 65535, cut off."""
    return F.transform(depth, lambda x: F.least(F.greatest(f32(x * F.lit(1000).cast("float")), F.lit(0).cast("float")), F.lit(65535).cast("float")).cast("int"))


def relative_steps(depth: Column) -> Column:
    """Spread over 0 to 65535 by least and greatest, cut off; all 0 if equal."""
    low, high = F.array_min(depth), F.array_max(depth)
    spread = lambda x: f32(f32(f32(x - low) / f32(high - low)) * F.lit(65535).cast("float")).cast("int")
    return F.transform(depth, lambda x: F.when(high > low, spread(x)).otherwise(0))


def depth_sidecar(kind: str, scale: Column, low: Column, high: Column) -> Column:
    """JSON beside a depth image; units only for metric depth."""
    # The sidecar's keys and texts.
    fields = {"depth_type": F.lit(kind), "scale": scale, "original_min": low, "original_max": high, "encoding": F.lit("uint16_png")}
    if kind == "metric":
        fields |= {"units": F.lit("millimeters"), "conversion_note": F.lit("Divide pixel value by 1000 to get meters")}
    else:
        fields |= {"conversion_note": F.lit("Relative depth, normalize to [0, 1] range")}
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def mask_area(mask: Column) -> Column:
    return F.size(F.filter(mask, lambda x: x)).cast("long")


def mask_box(mask: Column, width: int) -> Column:
    """(x, y, w, h) of the true pixels; zeros if there are none."""
    on = F.filter(F.transform(mask, lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    xs, ys = F.transform(on, lambda i: i % width), F.transform(on, lambda i: F.floor(i / width))
    side = lambda v: F.array_max(v) - F.array_min(v) + 1
    box = F.array(F.array_min(xs), F.array_min(ys), side(xs), side(ys)).cast("array<long>")
    return F.when(F.size(on) > 0, box).otherwise(F.array(*[F.lit(0)] * 4).cast("array<long>"))


def column_major(mask: Column, width: int, height: int) -> Column:
    placed = F.transform(mask, lambda x, i: F.struct(((i % width) * height + F.floor(i / width)).alias("k"), x.alias("v")))
    return F.transform(F.array_sort(placed), lambda p: p["v"])


def run_lengths(mask: Column, width: int, height: int) -> Column:
    """Column-major run lengths, off pixels first (0 if the first is on), in
    one fold over the pixels."""
    begin = F.struct(F.array().cast("array<int>").alias("runs"), F.lit(False).alias("v"), F.lit(0).alias("n"))

    def step(state: Column, x: Column) -> Column:
        same = F.struct(state["runs"].alias("runs"), x.alias("v"), (state["n"] + 1).alias("n"))
        other = F.struct(F.concat(state["runs"], F.array(state["n"])).alias("runs"), x.alias("v"), F.lit(1).alias("n"))
        return F.when(x == state["v"], same).otherwise(other)

    return F.aggregate(column_major(mask, width, height), begin, step, lambda state: F.concat(state["runs"], F.array(state["n"])))


def box_xywh(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Each of x1, y1 and the differences cut off on its own."""
    return F.array(*[v.cast("long") for v in (x1, y1, x2 - x1, y2 - y1)])
