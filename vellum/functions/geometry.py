"""Boxes as four columns l, t, r, b, in top-left origin unless said otherwise; all are expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The slack of the union and of strict comparisons.
UNION_SLACK = 1e-6
STRICT_SLACK = 1e-3


@dataclass(frozen=True)
class Box:
    l: Column  # noqa: E741
    t: Column
    r: Column
    b: Column
    bottom_left: bool = False

    @staticmethod
    def of(prefix: str = "", bottom_left: bool = False) -> Box:
        return Box(*(F.col(f"{prefix}{c}") for c in "ltrb"), bottom_left)

    @property
    def width(self) -> Column:
        return self.r - self.l

    @property
    def height(self) -> Column:
        return F.abs(self.t - self.b)

    @property
    def area(self) -> Column:
        return F.abs(self.r - self.l) * F.abs(self.b - self.t)

    def scaled(self, x: float | Column, y: float | Column | None = None) -> Box:
        y = x if y is None else y
        return Box(self.l * x, self.t * y, self.r * x, self.b * y, self.bottom_left)

    def normalized(self, width: Column, height: Column) -> Box:
        return Box(self.l / width, self.t / height, self.r / width, self.b / height, self.bottom_left)

    def expanded(self, x: float, y: float) -> Box:
        dx, dy = self.width * x, self.height * y * (-1 if self.bottom_left else 1)
        return Box(self.l - dx, self.t - dy, self.r + dx, self.b + dy, self.bottom_left)

    def flipped(self, page_height: Column | float) -> Box:
        return Box(self.l, page_height - self.t, self.r, page_height - self.b, not self.bottom_left)

    def _low_high(self) -> tuple[Column, Column]:
        return (self.b, self.t) if self.bottom_left else (self.t, self.b)

    def x_overlap(self, o: Box) -> Column:
        return F.greatest(F.lit(0.0), F.least(self.r, o.r) - F.greatest(self.l, o.l))

    def y_overlap(self, o: Box) -> Column:
        (a, b), (c, d) = self._low_high(), o._low_high()
        return F.greatest(F.lit(0.0), F.least(b, d) - F.greatest(a, c))

    def x_union(self, o: Box) -> Column:
        return F.greatest(self.r, o.r) - F.least(self.l, o.l)

    def y_union(self, o: Box) -> Column:
        (a, b), (c, d) = self._low_high(), o._low_high()
        return F.greatest(b, d) - F.least(a, c)

    def intersection(self, o: Box) -> Column:
        return self.x_overlap(o) * self.y_overlap(o)

    def iou(self, o: Box) -> Column:
        i = self.intersection(o)
        return i / (self.area + o.area - i + UNION_SLACK)

    def over_self(self, o: Box) -> Column:
        return F.when(self.area > 0, self.intersection(o) / self.area).otherwise(F.lit(0.0))

    def overlaps(self, o: Box) -> Column:
        return self.overlaps_x(o) & self.overlaps_y(o)

    def overlaps_x(self, o: Box) -> Column:
        return ~((self.r <= o.l) | (o.r <= self.l))

    def overlaps_y(self, o: Box) -> Column:
        (a, b), (c, d) = self._low_high(), o._low_high()
        return ~((b <= c) | (d <= a))

    def left_of(self, o: Box) -> Column:
        return self.l < o.l

    def strictly_left_of(self, o: Box, slack: float = STRICT_SLACK) -> Column:
        return self.r + slack < o.l

    def above(self, o: Box) -> Column:
        return self.t > o.t if self.bottom_left else self.t < o.t

    def strictly_above(self, o: Box, slack: float = STRICT_SLACK) -> Column:
        # tolerant from the bottom, strict from the top: the two origins differ on purpose
        return self.b + slack > o.t if self.bottom_left else self.b + slack < o.t

    def y_iou(self, o: Box) -> Column:
        """The common share of two vertical extents; 0 where they are apart."""
        return F.when(self.overlaps_y(o), self.y_overlap(o) / self.y_union(o)).otherwise(F.lit(0.0))

    def beside(self, a: Box, b: Box) -> Column:
        """Whether the box reaches from ``a``'s side to ``b``'s without lying in their common vertical extent."""
        (low, high), (a0, a1), (b0, b1) = self._low_high(), a._low_high(), b._low_high()
        level = (low < F.greatest(a1, b1)) & (F.least(a0, b0) < high)
        return ~level & (self.l < a.r) & (b.l < self.r)

    @staticmethod
    def centred(x: Column, y: Column, width: Column, height: Column) -> Box:
        return Box(x - width / 2, y - height / 2, x + width / 2, y + height / 2)

    def centre(self, least: float = 1e-6) -> tuple[Column, Column, Column, Column]:
        """(x, y, width, height), no side under ``least``."""
        w, h = F.greatest(self.r - self.l, F.lit(least)), F.greatest(self.b - self.t, F.lit(least))
        return self.l + w / 2, self.t + h / 2, w, h

    def joined(self, o: Box) -> Box:
        return Box(F.least(self.l, o.l), F.least(self.t, o.t), F.greatest(self.r, o.r), F.greatest(self.b, o.b), self.bottom_left)

    def within(self, width: Column | float, height: Column | float) -> Box:
        inside = lambda c, most: F.greatest(F.lit(0.0), F.least(c, most if isinstance(most, Column) else F.lit(most)))
        return Box(inside(self.l, width), inside(self.t, height), inside(self.r, width), inside(self.b, height), self.bottom_left)

    def turned(self, angle: Column, width: Column | float, height: Column | float) -> Quad:
        """The corners of a top-left box of an image (width, height) that was turned by quarters, from the baseline's start."""
        w, h = self.r - self.l, self.b - self.t
        quarter = F.pmod(angle, F.lit(360))
        x = F.when(quarter == 90, self.t + h).when(quarter == 180, width - self.l).when(quarter == 270, height - (self.t + h)).otherwise(self.l)
        y = F.when(quarter == 90, width - self.l).when(quarter == 180, height - (self.t + h)).when(quarter == 270, self.l).otherwise(self.b)
        along_x = F.when(quarter == 0, w).when(quarter == 180, -w).otherwise(F.lit(0.0))
        along_y = F.when(quarter == 90, -w).when(quarter == 270, w).otherwise(F.lit(0.0))
        up_x = F.when(quarter == 90, -h).when(quarter == 270, h).otherwise(F.lit(0.0))
        up_y = F.when(quarter == 0, -h).when(quarter == 180, h).otherwise(F.lit(0.0))
        return Quad((x, x + along_x, x + along_x + up_x, x + up_x), (y, y + along_y, y + along_y + up_y, y + up_y))

    def columns(self, suffix: str = "") -> list[Column]:
        return [c.alias(f"{n}{suffix}") for n, c in zip("ltrb", (self.l, self.t, self.r, self.b), strict=True)]


def hull(prefix: str = "") -> list[Column]:
    """Aggregates for the box around a group's boxes."""
    return [F.min(f"{prefix}l").alias("l"), F.min(f"{prefix}t").alias("t"), F.max(f"{prefix}r").alias("r"), F.max(f"{prefix}b").alias("b")]


def location_token(value: Column, size: Column, grid: int = 500) -> Column:
    """``<loc_k>`` with k the position on a grid, rounded half to even and kept inside it."""
    k = F.greatest(F.lit(0), F.least(F.lit(grid - 1), F.bround(value / size * grid, 0).cast("int")))
    return F.concat(F.lit("<loc_"), k.cast("string"), F.lit(">"))


@dataclass(frozen=True)
class Quad:
    """Four corners (x0, y0) to (x3, y3), the first the start of the baseline, in bottom-left origin."""

    xs: tuple[Column, Column, Column, Column]
    ys: tuple[Column, Column, Column, Column]

    @staticmethod
    def of(prefix: str = "") -> Quad:
        return Quad(tuple(F.col(f"{prefix}x{i}") for i in range(4)), tuple(F.col(f"{prefix}y{i}") for i in range(4)))

    @property
    def width(self) -> Column:
        return F.hypot(self.xs[1] - self.xs[0], self.ys[1] - self.ys[0])

    @property
    def height(self) -> Column:
        return F.hypot(self.xs[3] - self.xs[0], self.ys[3] - self.ys[0])

    @property
    def degrees(self) -> Column:
        """The direction of the baseline's middle line, 0 to 360, rounded half to even."""
        dx = (self.xs[1] + self.xs[2] - self.xs[0] - self.xs[3]) / 2
        dy = (self.ys[1] + self.ys[2] - self.ys[0] - self.ys[3]) / 2
        flat, steep = F.abs(dy) < 1e-3, F.abs(dx) < 1e-3
        angle = F.when(flat, 0.0).when(steep, F.signum(dy) * F.pi() / 2).otherwise(F.atan(F.try_divide(dy, dx)))
        angle = F.pmod(angle + F.when(dx < 0, F.pi()).otherwise(0.0), 2 * F.pi())
        return F.bround(angle / F.pi() * 180, 0).cast("int")

    def placed(self, scale: float, left: Column | float, top: Column | float) -> Quad:
        """The quad at ``1 / scale`` of its size, moved by an offset."""
        return Quad(tuple(x / scale + left for x in self.xs), tuple(y / scale + top for y in self.ys))

    @property
    def box(self) -> Box:
        return Box(F.least(*self.xs), F.greatest(*self.ys), F.greatest(*self.xs), F.least(*self.ys), True)
