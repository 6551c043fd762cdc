"""Points, boxes and their two text formats as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 1000
BOX = "struct<x1:int,y1:int,x2:int,y2:int>"
POINTS = "array<struct<x:int,y:int>>"
FORMATS = ("qwen", "doclang")
NOTE = " All bounding-box coordinates are integers normalized to the 0-1000 range."


def parse_points(points: Column) -> Column:
    """"x,y x,y" as an array of points; null if empty or if a point isn't two whole numbers (a third one is ignored)."""
    each = F.transform(F.filter(F.split(F.trim(points), r"\s+"), lambda p: p != ""), lambda p: F.struct(F.get(F.split(p, ","), F.lit(0)).try_cast("int").alias("x"), F.get(F.split(p, ","), F.lit(1)).try_cast("int").alias("y")))
    return F.when((F.size(each) > 0) & F.forall(each, lambda p: p["x"].isNotNull() & p["y"].isNotNull()), each)


def format_points(points: Column) -> Column:
    """Points as "x,y x,y", each number rounded to a whole one, halves to even."""
    whole = lambda v: F.rint(v.cast("double")).cast("long").cast("string")
    return F.array_join(F.transform(points, lambda p: F.concat(whole(p["x"]), F.lit(","), whole(p["y"]))), " ")


def hull(points: Column) -> Column:
    """The box around points; null for none."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.when(F.size(points) > 0, F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")))


def grid(value: Column, size: Column) -> Column:
    """A coordinate on the 0-1000 grid, halves to even; null for a size of zero or a null value."""
    at = F.rint(F.try_divide(value.cast("double"), size.cast("double")) * GRID).cast("int")
    return F.when(at.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(GRID), at)))


def to_grid(box: Column, width: Column, height: Column) -> Column:
    return F.struct(grid(box["x1"], width).alias("x1"), grid(box["y1"], height).alias("y1"), grid(box["x2"], width).alias("x2"), grid(box["y2"], height).alias("y2"))


def _four(box: Column, before: str, between: str, after: str) -> Column:
    c = [box[k].cast("string") for k in ("x1", "y1", "x2", "y2")]
    return F.concat(F.lit(before), c[0], F.lit(between), c[1], F.lit(between), c[2], F.lit(between), c[3], F.lit(after))


def format_box(box: Column, width: Column, height: Column, fmt: str) -> Column:
    """One box: bracketed numbers on the grid, or four location elements in page coordinates."""
    if fmt == "qwen":
        return _four(to_grid(box, width, height), "[", ", ", "]")
    return _four(box, '<location value="', '"/><location value="', '"/>')


def format_box_list(boxes: Column, width: Column, height: Column, fmt: str) -> Column:
    """A list of boxes; both formats use brackets, the second one page coordinates."""
    one = (lambda b: _four(to_grid(b, width, height), "[", ", ", "]")) if fmt == "qwen" else (lambda b: _four(b, "[", ", ", "]"))
    return F.concat(F.lit("["), F.array_join(F.transform(boxes, one), ", "), F.lit("]"))


def note(fmt: str) -> str:
    return NOTE if fmt == "qwen" else ""
