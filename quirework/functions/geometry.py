"""Boxes, colours and tolerances as Column expressions.  A box is struct<x0,y0,x1,y1 double>."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
EDGES = ("x0", "y0", "x1", "y1")


def box(x0: Column, y0: Column, x1: Column, y1: Column, digits: int | None = None) -> Column:
    """A box, rounded to ``digits`` where given."""
    return F.struct(*[(v.cast("double") if digits is None else F.round(v.cast("double"), digits)).alias(k) for k, v in zip(EDGES, (x0, y0, x1, y1))])


def box_of(values: Column, digits: int = 3) -> Column:
    """From an array of exactly four numbers; null otherwise."""
    return F.when(F.size(values) == 4, box(*[F.try_element_at(values, F.lit(i + 1)) for i in range(4)], digits))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)


def strict_box(values: Column, digits: int = 6, empty: bool = True) -> Column:
    """Finite and ordered, else null; ``empty=False`` also rejects boxes without area."""
    b = box_of(values, digits)
    ordered = (b["x0"] <= b["x1"]) & (b["y0"] <= b["y1"]) if empty else (b["x0"] < b["x1"]) & (b["y0"] < b["y1"])
    return F.when(F.forall(values, finite) & ordered, b)


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def height(b: Column) -> Column:
    return b["y1"] - b["y0"]


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), width(b)) * F.greatest(F.lit(0.0), height(b))


def shared_area(a: Column, b: Column) -> Column:
    """Area of the intersection; 0 where boxes only touch."""
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def inside(inner: Column, outer: Column, tolerance: float, empty: bool = True) -> Column:
    """Within ``outer`` widened by ``tolerance``; ``empty=False`` also asks for area of the inner box."""
    out = (inner["x0"] >= outer["x0"] - tolerance) & (inner["y0"] >= outer["y0"] - tolerance) & (inner["x1"] <= outer["x1"] + tolerance) & (inner["y1"] <= outer["y1"] + tolerance)
    return out if empty else out & (inner["x1"] > inner["x0"]) & (inner["y1"] > inner["y0"])


def clearance(a: Column, b: Column) -> Column:
    """Distance between boxes, 0 where they meet."""
    dx = F.greatest(F.lit(0.0), a["x0"] - b["x1"], b["x0"] - a["x1"])
    dy = F.greatest(F.lit(0.0), a["y0"] - b["y1"], b["y0"] - a["y1"])
    return F.hypot(dx, dy)


def same_box(a: Column, b: Column, tolerance: float) -> Column:
    out = F.lit(True)
    for k in EDGES:
        out &= F.abs(a[k] - b[k]) <= tolerance
    return out


def same_size(a: Column, b: Column, tolerance: float = 0.02) -> Column:
    return (F.abs(width(a) - width(b)) <= tolerance) & (F.abs(height(a) - height(b)) <= tolerance)


def vertical_overlap(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))


def expanded(b: Column, by: Column | float, page: Column) -> Column:
    """Grown by ``by`` on each side, and cut at the page."""
    return box(F.greatest(page["x0"], b["x0"] - by), F.greatest(page["y0"], b["y0"] - by), F.least(page["x1"], b["x1"] + by), F.least(page["y1"], b["y1"] + by))


def flipped(b: Column, page_height: Column) -> Column:
    """Between page space (y downward) and PDF user space (y upward), for an unrotated page with origin 0."""
    return box(b["x0"], page_height - b["y1"], b["x1"], page_height - b["y0"])


def product(m: Column, n: Column, digits: int = 6) -> Column:
    """2x3 matrices as arrays a b c d e f, row vectors: first m, then n."""
    e = lambda x, i: F.element_at(x, i + 1)
    out = [
        e(m, 0) * e(n, 0) + e(m, 1) * e(n, 2),
        e(m, 0) * e(n, 1) + e(m, 1) * e(n, 3),
        e(m, 2) * e(n, 0) + e(m, 3) * e(n, 2),
        e(m, 2) * e(n, 1) + e(m, 3) * e(n, 3),
        e(m, 4) * e(n, 0) + e(m, 5) * e(n, 2) + e(n, 4),
        e(m, 4) * e(n, 1) + e(m, 5) * e(n, 3) + e(n, 5),
    ]
    return F.array(*[F.round(x, digits) for x in out])


def alignment_delta(mode: Column, source: Column, source_in: Column, target: Column, target_in: Column) -> Column:
    """How far the target's offset within its box is from the source's within its own."""
    left = (target["x0"] - target_in["x0"]) - (source["x0"] - source_in["x0"])
    right = (target_in["x1"] - target["x1"]) - (source_in["x1"] - source["x1"])
    middle = lambda a: (a["x0"] + a["x1"]) / 2
    centre = (middle(target) - middle(target_in)) - (middle(source) - middle(source_in))
    return F.abs(F.when(mode == "left", left).when(mode == "right", right).when(mode == "center", centre))


def rotation(dx: Column, dy: Column) -> Column:
    """Degrees, three decimals; no direction is 0."""
    return F.round(F.degrees(F.atan2(F.coalesce(dy, F.lit(0.0)), F.coalesce(dx, F.lit(1.0)))), 3)


def anchored(anchor: Column, b: Column) -> Column:
    """Metrics of a box relative to an anchor box."""
    return F.struct(
        (b["x0"] - anchor["x0"]).alias("left"),
        (b["x1"] - anchor["x0"]).alias("right"),
        (b["y0"] - anchor["y0"]).alias("top"),
        (b["y1"] - anchor["y0"]).alias("bottom"),
        width(b).alias("width"),
        height(b).alias("height"),
        ((b["x0"] + b["x1"]) / 2 - anchor["x0"]).alias("center_x"),
        ((b["y0"] + b["y1"]) / 2 - anchor["y0"]).alias("center_y"),
    )


def font_floor(source_size: Column) -> Column:
    """Smallest allowed size: three quarters of the source, and 6 points at least."""
    return F.greatest(F.lit(6.0), source_size * 0.75)


def pixels(points: Column, dpi: int = 300) -> Column:
    return points * dpi / 72


def srgb(r: Column, g: Column, b: Column) -> Column:
    """24-bit colour of three parts in 0..1."""
    part = lambda c: F.round(c * 255).cast("int")
    return F.shiftleft(part(r), 16).bitwiseOR(F.shiftleft(part(g), 8)).bitwiseOR(part(b))


def rgb(colour: Column) -> Column:
    """Three parts in 0..1 of a 24-bit colour."""
    part = lambda bits: F.shiftright(colour, bits).bitwiseAND(255) / 255.0
    return F.array(part(16), part(8), part(0))


def image_signature(digest: Column, b: Column) -> Column:
    return F.concat_ws(":", digest, *[F.format_string("%.2f", b[k]) for k in EDGES])
